"""Web archives with a shared Zstandard dictionary, each record compressed by itself.

An archive begins with a skippable frame that holds the dictionary; every record is a frame of its
own, so any record can be read with the dictionary and its offset alone.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from autostrata.llm.common import with_row_key
from autostrata.staging import materialize, staging_path

# Fixed value: magic number of the skippable frame that holds a dictionary.
DICTIONARY_FRAME = 0x184D2A5D

# Bounds of the sample that the dictionary is built from (payloads, and bytes of each), and its size.
SAMPLE_RECORDS = 2_000
SAMPLE_BYTES = 16_384
DICTIONARY_BYTES = 65_536

LEVEL = 6
# An archive is closed when it has grown to this.
ARCHIVE_BYTES = 64 << 20
DATE = "1970-01-01T00:00:00Z"

SUFFIX = ".warc.zst"
_STEP = 1 << 14


def payload_digest(payload: bytes) -> str:
    """SHA-1 in upper-case base32."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(kind: str, name: str, url: str | None, digest: str, body: bytes,
           refers_to: str | None = None, date: str = DATE) -> bytes:
    """A WARC record. ``response`` carries a payload, ``revisit`` only its digest and reference."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    http += b"Content-Length: %d\r\n\r\n" % len(body)
    content = http + body if kind == "response" else b""
    fields = [
        ("WARC-Type", kind),
        ("WARC-Record-ID", f"<{name}>"),
        ("WARC-Date", date),
        ("WARC-Target-URI", quote(url or "", safe="!#$%&'()*+,/:;=?@[]~")),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
    ]
    if kind == "revisit":
        fields += [
            ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
            ("WARC-Refers-To", f"<{refers_to}>"),
        ]
    fields += [
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(content))),
    ]
    head = "".join(f"{k}: {v}\r\n" for k, v in fields)
    return b"WARC/1.1\r\n" + head.encode() + b"\r\n" + content + b"\r\n\r\n"


def parse(data: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields of a record, and its payload (empty for a revisit)."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    content = rest[: int(fields["Content-Length"])]
    return fields, content.partition(b"\r\n\r\n")[2]


def frames(data: bytes) -> Iterator[bytes]:
    """The records of an archive, decompressed by the dictionary in its first frame."""
    magic, size = struct.unpack_from("<II", data)
    if magic != DICTIONARY_FRAME:
        raise ValueError("the archive does not begin with a dictionary")
    dictionary = zstandard.ZstdCompressionDict(data[8 : 8 + size]) if size else None
    reader, at = zstandard.ZstdDecompressor(dict_data=dictionary), 8 + size
    while at < len(data):
        stream, parts = reader.decompressobj(), []
        while not stream.eof:
            piece = data[at : at + _STEP]
            if not piece:
                raise ValueError("the archive ends within a record")
            parts.append(stream.decompress(piece))
            at += len(piece) - len(stream.unused_data)
        yield b"".join(parts)


def build_dictionary(
    pages: DataFrame,
    id: str = "page_id",
    url: str = "url",
    html: str = "html",
    records: int = SAMPLE_RECORDS,
    size: int = DICTIONARY_BYTES,
) -> bytes:
    """A Zstandard dictionary from the records of at most ``records`` pages, chosen by hash among
    those whose payload has 1 to ``SAMPLE_BYTES`` bytes. Empty if there is too little to learn from.

    The pages are chosen by their hashes alone, of equal payloads one; then these pages, a bounded
    number of bounded size, are collected as they will be archived.
    """
    keyed, key = with_row_key(pages.select(id, url, html), id)
    fitting = keyed.where(F.octet_length(html).between(1, SAMPLE_BYTES))
    chosen = (
        fitting.groupBy(F.xxhash64(html).alias("_hash"))
        .agg(F.max(key).alias(key))
        .orderBy("_hash")
        .limit(records)
        .select(key)
    )
    sample = keyed.join(F.broadcast(chosen), key, "left_semi").select(
        _name(key).alias("name"), F.col(url).alias("url"), F.col(html).alias("html")
    )
    bodies = ((r["name"], r["url"], r["html"].encode()) for r in sample.collect())
    texts = [record("response", name, address, payload_digest(b), b) for name, address, b in bodies]
    try:
        return zstandard.train_dictionary(size, texts, level=LEVEL).as_bytes()
    except zstandard.ZstdError:
        return b""


def _write(
    batches: Iterator[pa.RecordBatch], folder: str, dictionary: bytes
) -> Iterator[pa.RecordBatch]:
    """Archives of one task. Names hold the attempt, so a repeated task disturbs no other; only
    archives of attempts that end are listed."""
    fs, root = pyarrow.fs.FileSystem.from_uri(folder)
    task = TaskContext.get()
    stem = f"part-{task.partitionId():06d}-{task.taskAttemptId()}"
    compressor = zstandard.ZstdCompressor(
        level=LEVEL,
        write_checksum=True,
        dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None,
    )
    out, number, size = None, 0, 0

    def closed() -> pa.RecordBatch:
        out.close()
        name = f"{stem}-{number:05d}{SUFFIX}"
        return pa.RecordBatch.from_arrays([pa.array([f"{folder}/{name}"])], ["path"])

    for batch in batches:
        for row in range(batch.num_rows):
            name, url, body, keeper = (batch.column(c)[row].as_py() for c in range(4))
            if out is None:
                out = fs.open_output_stream(f"{root}/{stem}-{number:05d}{SUFFIX}", compression=None)
                size = out.write(struct.pack("<II", DICTIONARY_FRAME, len(dictionary)) + dictionary)
            body = body.encode()
            kind = "response" if keeper is None else "revisit"
            data = record(kind, name, url, payload_digest(body), body, keeper)
            size += out.write(compressor.compress(data))
            if size >= ARCHIVE_BYTES:
                yield closed()
                out, number = None, number + 1
    if out is not None:
        yield closed()


def _records(data: bytes) -> Iterator[pa.RecordBatch]:
    rows, size = [], 0
    for one in frames(data):
        fields, payload = parse(one)
        revisit = fields["WARC-Type"] == "revisit"
        digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
        if not revisit and payload_digest(payload) != digest:
            raise ValueError(f"the payload of {fields['WARC-Record-ID']} is damaged")
        rows.append((
            fields["WARC-Record-ID"][1:-1],
            fields["WARC-Target-URI"],
            fields["WARC-Type"],
            fields["WARC-Refers-To"][1:-1] if revisit else None,
            digest,
            None if revisit else payload,
        ))
        size += len(one)
        if size >= 4 << 20:
            yield _rows(rows)
            rows, size = [], 0
    if rows:
        yield _rows(rows)


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    names = ["record_id", "url", "record_type", "refers_to", "payload_digest", "payload"]
    kinds = [pa.string()] * 5 + [pa.binary()]
    columns = [pa.array(c, k) for c, k in zip(zip(*rows), kinds)]
    return pa.RecordBatch.from_arrays(columns, names)


def write_archives(
    pages: DataFrame,
    folder: str | None = None,
    id: str = "page_id",
    url: str = "url",
    html: str = "html",
    at_least: int = 0,
) -> DataFrame:
    """Archive every page and return the archives' ``path``s, once they are written.

    Of pages with equal payloads of at least ``at_least`` bytes the one with the largest id is a
    response and all others revisit it; smaller payloads are all responses. Payloads are compared
    by SHA-256 and length, counted in each task before they meet, so any share of the pages may
    hold the same. Record names are ``urn:page:<id>:<row>``, where the row tells repeated ids
    apart. NULL payloads are empty and a NULL URL is empty; other columns are ignored; an empty
    table makes no archive.

    ``folder`` has to be reachable from all executors; by default it is made in the shared
    folder. Any file system that pyarrow knows will do.
    """
    spark = pages.sparkSession
    folder = made(spark, folder or staging_path(spark, "archives"))
    dictionary = build_dictionary(pages, id, url, html)
    keyed, key = with_row_key(pages.select(id, url, html), id)
    body = F.coalesce(F.col(html), F.lit(""))
    rows = keyed.select(
        F.col(key).alias("key"),
        F.col(url).alias("url"),
        body.alias("html"),
        F.octet_length(body).alias("size"),
        F.sha2(body, 256).alias("digest"),
    )
    known = materialize(rows.select("key", "size", "digest"), "payloads")
    groups = materialize(
        known.where(F.col("size") >= at_least)
        .groupBy("digest", "size")
        .agg(F.max("key").alias("keeper"), F.count("*").alias("n"))
        .where("n > 1")
        .select("digest", "size", "keeper"),
        "equal",
    )
    refers = F.when(F.col("keeper") != F.col("key"), _name("keeper"))
    # Without the pages' bodies: which row refers to which.
    decided = materialize(
        known.join(groups, ["digest", "size"]).select("key", refers.alias("keeper")).dropna(),
        "decided",
    )
    written = (
        rows.select("key", "url", "html")
        .join(decided, "key", "left")
        .select(_name("key").alias("name"), "url", "html", "keeper")
        .mapInArrow(lambda batches: _write(batches, folder, dictionary), "path string")
    )
    return materialize(written, "manifest")


def made(spark: SparkSession, folder: str) -> str:
    """Make the folder; its URI, with the scheme that Hadoop takes a bare path for."""
    context = spark.sparkContext
    path = context._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(context._jsc.hadoopConfiguration())
    fs.mkdirs(path)
    folder = fs.makeQualified(path).toString()
    # Hadoop writes file:/x, pyarrow reads file:///x.
    return re.sub("^([a-z0-9]+):/(?!/)", r"\1:///", folder)


def _name(key: str) -> Column:
    """A record's name from its row's key: the id, and a number made from file and position."""
    id = F.coalesce(F.col(f"{key}.id").cast("string"), F.lit(""))
    row = F.md5(F.concat_ws("/", F.col(f"{key}.file"), F.col(f"{key}.row")).cast("binary"))
    return F.concat(F.lit("urn:page:"), id, F.lit(":"), row)


def read_archives(spark: SparkSession, archives: DataFrame) -> DataFrame:
    """The records of archives given by ``path``: ``record_id``, ``url``, ``record_type``,
    ``refers_to``, ``payload_digest`` and ``payload`` (NULL for revisits, which have none).

    An archive is read by one task; the writer bounds its size.
    """

    def opened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                fs, name = pyarrow.fs.FileSystem.from_uri(path)
                with fs.open_input_file(name) as file:
                    yield from _records(file.read())

    return archives.select("path").repartition("path").mapInArrow(
        opened,
        "record_id string, url string, record_type string, refers_to string, "
        "payload_digest string, payload binary",
    )


def page_of(record_id: str) -> Column:
    """The id in a record's name."""
    return F.regexp_extract(record_id, "^urn:page:(.*):[^:]*$", 1)

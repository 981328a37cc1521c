"""Archives: an exact round trip, and the layout of a file."""

import base64
import hashlib
import random
import struct

import pytest

import pyarrow.fs
import zstandard

from autostrata.llm import warc
from autostrata.staging import staging_path


def _digest(data):
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _pages(spark):
    random.seed(9)
    words = [f"<p>word{i}</p>" for i in range(300)]
    rows = [(i, f"http://x/{i}", "".join(random.choices(words, k=40))) for i in range(80)]
    rows += [(200, None, rows[3][2]), (201, "u", rows[3][2]), (300, "a b\né", None), (301, "u", "")]
    rows += [(400, "u", "\r\n\r\nWARC/1.1\r\n\r\n é"), (500, "u", "twice"), (500, "u", "twice")]
    return spark.createDataFrame(
        [(i, u, t, "n", 1) for i, u, t in rows], "page_id long, url string, html string, name string, key int"
    ), rows


def _read(spark, archives):
    return {r.record_id: r for r in warc.read_archives(spark, archives).collect()}


def test_round_trip(spark):
    pages, rows = _pages(spark)
    archives = warc.write_archives(pages)
    records = _read(spark, archives)
    assert len(records) == len(rows)
    keepers = {}
    for id, _, text in rows:
        keepers[text or ""] = max(id, keepers.get(text or "", id))
    for record in records.values():
        id = int(record.record_id.split(":")[2])
        text = next(t or "" for i, _, t in rows if i == id)
        assert record.payload_digest == _digest(text.encode())
        if record.record_type == "response":
            assert record.payload == text.encode() and keepers[text] == id
        else:
            target = records[record.refers_to]
            assert target.record_type == "response" and target.payload == text.encode()
    kinds = [r.record_type for r in records.values()]
    # Two pages of one text, one empty page and one copy of a repeated row refer to another record.
    assert kinds.count("revisit") == 4


def test_small_payloads_are_all_responses(spark):
    pages, rows = _pages(spark)
    records = _read(spark, warc.write_archives(pages, at_least=6))
    kinds = [r.record_type for r in records.values()]
    assert kinds.count("revisit") == 2


def test_layout_of_a_file(spark):
    pages, _ = _pages(spark)
    path = warc.write_archives(pages).first()[0]
    fs, name = pyarrow.fs.FileSystem.from_uri(path)
    with fs.open_input_file(name) as file:
        data = file.read()
    magic, size = struct.unpack_from("<II", data)
    assert magic == 0x184D2A5D and size > 0 and path.endswith(".warc.zst")
    dictionary = zstandard.ZstdCompressionDict(data[8 : 8 + size])
    first = zstandard.ZstdDecompressor(dict_data=dictionary).decompressobj().decompress(data[8 + size :])
    assert first.startswith(b"WARC/1.1\r\n")


def test_empty_table(spark):
    pages, _ = _pages(spark)
    assert _read(spark, warc.write_archives(pages.limit(0))) == {}


def test_archives_are_closed_when_large(spark):
    folder = warc.made(spark, staging_path(spark, "archives"))
    rows = [("urn:a", "u", "text", None), ("urn:b", None, "text", "urn:a"), ("urn:c", "u", "", None)]
    frame = spark.createDataFrame(rows, "name string, url string, html string, keeper string")
    paths = frame.coalesce(1).mapInArrow(_writer(folder), "path string").collect()
    assert len({r.path for r in paths}) == 3
    records = _read(spark, spark.createDataFrame(paths))
    assert {k: r.record_type for k, r in records.items()} == {"urn:a": "response", "urn:b": "revisit", "urn:c": "response"}


def test_a_damaged_record_is_told(spark):
    body = b"<html>some page</html>"
    wrong = warc.record("response", "urn:page:1:x", "u", warc.payload_digest(b"other"), body)
    with pytest.raises(ValueError, match="damaged"):
        list(warc._records(struct.pack("<II", warc.DICTIONARY_FRAME, 0) + zstandard.compress(wrong)))
    good = warc.record("response", "urn:page:1:x", "u", warc.payload_digest(body), body)
    frame = bytearray(zstandard.ZstdCompressor(level=0, write_checksum=True).compress(good))
    frame[-1] ^= 1
    with pytest.raises(zstandard.ZstdError):
        list(warc._records(struct.pack("<II", warc.DICTIONARY_FRAME, 0) + bytes(frame)))


def test_dictionary_is_built_from_true_records(spark, monkeypatch):
    rows = [(i, f"http://h/{i}", f"<p>page {i}</p>" * 20) for i in range(300)]
    rows += [(1000 + i, "u", rows[0][2]) for i in range(50)] + [(2000, "u", "x" * 20_000), (None, None, None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    given = []
    train = zstandard.train_dictionary
    monkeypatch.setattr(
        warc.zstandard, "train_dictionary", lambda size, texts, **o: given.extend(texts) or train(size, texts, **o)
    )
    assert warc.build_dictionary(pages)
    parsed = [warc.parse(text) for text in given]
    assert len(parsed) == 300 and len({payload for _, payload in parsed}) == 300
    for fields, payload in parsed:
        assert fields["WARC-Payload-Digest"] == f"sha1:{warc.payload_digest(payload)}"
        assert any(r[2] and r[2].encode() == payload and r[1] == fields["WARC-Target-URI"] for r in rows)


def test_a_bare_folder_gets_hadoops_scheme(spark, tmp_path):
    assert warc.made(spark, str(tmp_path / "a b")).startswith("file:///")
    assert (tmp_path / "a b").is_dir()


def _writer(folder):
    def write(batches):
        from autostrata.llm import warc as module

        module.ARCHIVE_BYTES = 1
        yield from module._write(batches, folder, b"")

    return write

"""The training-data operators as named queries over the test tables, with SQL where it can say it."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from autostrata.llm import html_extract, toxicity, warc
from autostrata.llm.common import read, whole
from autostrata.llm.credentials import SecretScan
from autostrata.llm.decontaminate import PositionalIndex
from autostrata.llm.exact_dedup import exact_groups
from autostrata.llm.minhash import near_duplicates
from autostrata.llm.packing import pack
from autostrata.llm.periodic_runs import periodic_runs
from autostrata.llm.quality_forest import judge_documents
from autostrata.llm.sharding import shard_documents
from autostrata.llm.suffix_dedup import remove_repeats
from autostrata.llm.token_alignment import link_statistics
from autostrata.staging import materialize


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of identical texts with the row that stays of each."""
    docs = read(spark, sf_dir, "documents")
    return exact_groups(docs, carry={"text_sha256": F.sha2(whole("text"), 256)})


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity scores of all documents by a model that no row of the held-out fourth has shaped."""
    docs, labels = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    model = toxicity.fit(docs, labels.where(toxicity.crc_remainder("doc_id") != 2))
    scored = toxicity.score(docs.select("doc_id", "text"), model, spans="spans")
    places = F.transform("spans", lambda s: F.concat_ws(":", s["start"], s["end"]))
    return scored.select(
        "doc_id",
        (toxicity.crc_remainder("doc_id") == 2).alias("held_out"),
        "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
        F.array_join(places, ",").alias("offending"),
    )


def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of all pages by a model trained on those that declare their main part."""
    pages = read(spark, sf_dir, "pages")
    texts = html_extract.extract(pages, html_extract.fit(pages))
    n_chars = F.char_length("text").cast("bigint").alias("n_chars")
    return texts.select("page_id", "url", "text", n_chars)


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 24 shards of equal counts, equal texts together as far as there is room."""
    placed = shard_documents(read(spark, sf_dir, "documents"), shards=24)
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in all documents, with weak parts where they complete a credential."""
    found = SecretScan(read(spark, sf_dir, "documents")).findings()
    return found.select(
        F.col("id").alias("doc_id"), "n_assign", "n_access", "n_hex", "base_sha256", "spans"
    )


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 512 to 4096 words."""
    return pack(read(spark, sf_dir, "documents"))


def op6_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents with 85 % of their five-word shingles in common."""
    return near_duplicates(read(spark, sf_dir, "documents"), similarity=0.85)


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages archived and read back. A revisit's size is that of the response it refers to."""
    archives = warc.write_archives(read(spark, sf_dir, "pages"))
    records = materialize(
        warc.read_archives(spark, archives).select(
            "record_id",
            "record_type",
            "refers_to",
            "payload_digest",
            F.octet_length("payload").cast("bigint").alias("size"),
        ),
        "records",
    )
    responses = records.where("record_type = 'response'").select(
        F.col("record_id").alias("refers_to"), F.col("size").alias("referred")
    )
    revisits = records.where("record_type = 'revisit'").join(responses, "refers_to", "left")
    both = records.where("record_type = 'response'").withColumn("referred", F.col("size"))
    return both.unionByName(revisits).select(
        warc.page_of("record_id").try_cast("bigint").alias("page_id"),
        F.col("referred").alias("payload_bytes"),
        "payload_digest",
        "record_type",
        warc.page_of("refers_to").try_cast("bigint").alias("refers_to"),
    )


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of each document inside ten-word windows of benchmark items."""
    index = PositionalIndex(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return index.contamination().select(
        F.col("id").alias("doc_id"),
        "n_words",
        "n_hit",
        F.size("item_ids").cast("bigint").alias("n_items"),
        F.sha2(F.concat_ws(",", "item_ids"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the passages of 100 bytes that occurred before."""
    left = remove_repeats(read(spark, sf_dir, "documents"))
    n_spans = F.size("spans").cast("bigint").alias("n_spans")
    return left.select("doc_id", "n_bytes", "n_removed", n_spans, "kept_sha256")


def _repeating(text: pd.Series, checksum: pd.Series) -> pd.Series:
    """The text from some word on repeating itself; which word and how often, the checksum says."""

    def repeated(value: str | None, number: int) -> str | None:
        words = value.encode().split() if value else []
        if not words:
            return value
        g = number // 10
        at = g % len(words)
        period = 1 + (len(words) - at) // (3 + g % 8)
        rest = words[at : at + period] * (len(words) // period + 1)
        return b" ".join(words[:at] + rest[: len(words) - at]).decode()

    return pd.Series([repeated(v, int(n)) for v, n in zip(text, checksum)], dtype=object)


def with_planted_period(docs: DataFrame) -> DataFrame:
    """Documents, of which every tenth by its id's checksum repeats itself from some word on."""
    checksum = F.crc32(F.col("doc_id").cast("string"))
    planted = F.when(checksum % 10 == 0, F.col("text"))
    repeating = F.pandas_udf(_repeating, "string")
    text = F.when(checksum % 10 == 0, repeating(planted, checksum)).otherwise(F.col("text"))
    return docs.select(*(text.alias(c) if c == "text" else c for c in docs.columns))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of words in all documents, a tenth of which have a planted one."""
    docs = with_planted_period(read(spark, sf_dir, "documents").select("doc_id", "text"))
    found = periodic_runs(docs, keep_text=False)
    # Greatest exponent, compared without division; of equal ones the first, as runs are sorted.
    best = F.reduce(
        F.slice("runs", 2, F.greatest(F.size("runs") - 1, F.lit(0))),
        F.try_element_at("runs", F.lit(1)),
        lambda top, run: F.when(
            run["length"] * top["period"] > top["length"] * run["period"], run
        ).otherwise(top),
    )
    listed = F.array_join(
        F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])),
        "\n",
    )
    listed = F.when(F.size("runs") > 0, F.concat(listed, F.lit("\n"))).otherwise("")
    return found.select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        best.alias("_best"),
        F.sha2(listed, 256).alias("runs_sha256"),
        "collapsed_sha256",
    ).select(
        "doc_id",
        "n_runs",
        "_best.start",
        "_best.length",
        "_best.period",
        F.floor(1000 * F.col("_best.length") / F.col("_best.period")).alias("exponent_milli"),
        "runs_sha256",
        "collapsed_sha256",
    )


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of all documents by two tokenizers, aligned, with the corpus counts of their links."""
    found = link_statistics(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"
    )


def op13_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule statistics of all documents, and a verdict that no row of the held-out fourth has shaped."""
    docs, labels = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    judged = judge_documents(
        docs.select("doc_id", "text"), labels.where(toxicity.crc_remainder("doc_id") != 2)
    )
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "anomaly",
    )


QUERIES = {
    "op1_toxicity": op1_toxicity,
    "op2_html_extraction": op2_html_extraction,
    "op3_sharding": op3_sharding,
    "op4_secret_scan": op4_secret_scan,
    "op5_best_fit_packing": op5_best_fit_packing,
    "op6_minhash": op6_minhash,
    "op7_warc": op7_warc,
    "op8_decontamination": op8_decontamination,
    "op9_exact_dedup": op9_exact_dedup,
    "op10_suffix_dedup": op10_suffix_dedup,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_token_alignment": op12_token_alignment,
    "op13_quality_rules": op13_quality_rules,
}

ORACLE = {
    "op6_minhash": """
        WITH RECURSIVE word AS (
            SELECT doc_id, list_filter(string_split_regex(
                translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[\\x20\\x09-\\x0D]+'
            ), lambda w: w <> '') AS words
            FROM documents
        ), shingle AS (
            SELECT DISTINCT doc_id, words[i + 1 : i + 5] AS s
            FROM (SELECT *, unnest(range(greatest(len(words) - 4, 1))) AS i FROM word WHERE len(words) > 0)
        ), sized AS (
            SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id
        ), common AS (
            SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n
            FROM shingle a JOIN shingle b ON a.s = b.s AND a.doc_id < b.doc_id
            GROUP BY ALL
        ), link AS (
            SELECT common.a, common.b
            FROM common JOIN sized x ON x.doc_id = a JOIN sized y ON y.doc_id = b
            WHERE 100 * common.n >= 85 * (x.n + y.n - common.n)
        ), both_ways AS (
            SELECT a, b FROM link UNION ALL SELECT b, a FROM link
        ), reach AS (
            SELECT doc_id, doc_id AS other FROM documents
            UNION
            SELECT doc_id, b FROM reach JOIN both_ways ON other = a
        )
        SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
        FROM (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
        LEFT JOIN sized USING (doc_id)
    """,
    "op9_exact_dedup": """
        SELECT doc_id,
               max(doc_id) OVER same AS keep_id,
               count(*) OVER same AS group_size,
               doc_id = max(doc_id) OVER same AS kept,
               sha256(coalesce(text, '')) AS text_sha256
        FROM documents
        WINDOW same AS (PARTITION BY coalesce(text, ''))
    """,
    "op11_periodic_runs": """
        WITH digits AS (
            SELECT doc_id, text, list_transform(
                string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT)
            ) AS bytes
            FROM documents
        ), checked AS (
            SELECT doc_id, text, xor(list_reduce(
                bytes,
                lambda acc, byte: xor(acc >> 8, list_reduce(
                    range(8),
                    lambda v, step: CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END,
                    xor(acc, byte) & 255
                )),
                4294967295::BIGINT
            ), 4294967295) AS h
            FROM digits
        ), plain AS (
            SELECT doc_id, h, h // 10 AS g, coalesce(list_filter(
                string_split_regex(text, '[\\x20\\x09-\\x0D]+'), lambda w: w <> ''
            ), []) AS words
            FROM checked
        ), planned AS (
            SELECT *, len(words) AS n, g % nullif(len(words), 0) AS a,
                   1 + (len(words) - g % nullif(len(words), 0)) // (3 + g % 8) AS p
            FROM plain
        ), word AS (
            SELECT doc_id, n, i, words[1 + CASE WHEN h % 10 <> 0 OR i < a THEN i ELSE a + (i - a) % p END] AS w
            FROM (SELECT *, unnest(range(n)) AS i FROM planned)
        ), three AS (
            SELECT doc_id, n, i, hash(w, w2, w3) AS t, w, w2, w3
            FROM (
                SELECT *, lead(w) OVER (PARTITION BY doc_id ORDER BY i) AS w2,
                       lead(w, 2) OVER (PARTITION BY doc_id ORDER BY i) AS w3
                FROM word
            )
            WHERE w3 IS NOT NULL
        ), often AS (
            SELECT * FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, t) AS times FROM three)
            WHERE times > 2
        ), equal AS (
            SELECT a.doc_id, a.i, b.i - a.i AS q
            FROM often a JOIN often b
              ON a.doc_id = b.doc_id AND a.t = b.t AND a.w = b.w AND a.w2 = b.w2 AND a.w3 = b.w3
             AND b.i > a.i AND 4 * (b.i - a.i) <= a.n
        ), stretch AS (
            SELECT doc_id, q, min(i) AS start, count(*) + 2 + q AS length
            FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM equal)
            GROUP BY doc_id, q, island
            HAVING count(*) + 2 + q >= greatest(6, 4 * q)
        ), run AS (
            SELECT * FROM stretch s
            WHERE NOT EXISTS (
                FROM stretch o
                WHERE o.doc_id = s.doc_id AND o.q < s.q AND o.start <= s.start
                  AND o.start + o.length >= s.start + s.length
            )
        ), listed AS (
            SELECT doc_id, count(*) AS n_runs,
                   string_agg(concat(start, ',', length, ',', q, chr(10)), '' ORDER BY start, q) AS runs,
                   arg_max({'start': start, 'length': length, 'q': q},
                           {'exponent': length / q, 'start': -start, 'q': -q}) AS best
            FROM run GROUP BY doc_id
        ), dropped AS (
            SELECT DISTINCT doc_id, unnest(range(start + q, start + length)) AS i FROM run
        ), kept AS (
            SELECT doc_id, string_agg(w, ' ' ORDER BY i) AS text
            FROM word ANTI JOIN dropped USING (doc_id, i) GROUP BY doc_id
        )
        SELECT doc_id, coalesce(n_runs, 0) AS n_runs,
               CAST(best.start AS BIGINT) AS start, CAST(best.length AS BIGINT) AS length,
               CAST(best.q AS BIGINT) AS period,
               CAST(1000 * best.length // best.q AS BIGINT) AS exponent_milli,
               sha256(coalesce(runs, '')) AS runs_sha256,
               sha256(coalesce(kept.text, '')) AS collapsed_sha256
        FROM documents LEFT JOIN listed USING (doc_id) LEFT JOIN kept USING (doc_id)
    """,
    "op8_decontamination": """
        WITH item AS (
            SELECT item_id, list_filter(string_split_regex(
                translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'
            ), lambda w: w <> '') AS words
            FROM benchmark
        ), part AS (
            SELECT DISTINCT item_id, least(len(words), 10) AS n, words[i + 1 : i + least(len(words), 10)] AS s
            FROM (
                SELECT *, unnest(range(greatest(len(words) - 9, least(len(words), 1)))) AS i FROM item
            )
        ), doc AS (
            SELECT doc_id, coalesce(list_filter(string_split_regex(
                translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'
            ), lambda w: w <> ''), []) AS words
            FROM documents
        ), place AS (
            SELECT doc_id, n, i, words[i + 1 : i + n] AS s
            FROM (
                SELECT doc_id, words, n, unnest(range(len(words) - n + 1)) AS i
                FROM doc, (SELECT DISTINCT n FROM part)
            )
        ), found AS (
            SELECT doc_id, i, place.n, item_id FROM place JOIN part ON place.n = part.n AND place.s = part.s
        ), hit AS (
            SELECT doc_id, count(*) AS n_hit
            FROM (SELECT DISTINCT doc_id, unnest(range(i, i + n)) FROM found) GROUP BY doc_id
        ), items AS (
            SELECT doc_id, count(*) AS n_items, string_agg(name, ',' ORDER BY name) AS names
            FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS name FROM found) GROUP BY doc_id
        )
        SELECT doc_id, len(words) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
               sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
        FROM doc LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)
    """,
    "op10_suffix_dedup": """
        WITH doc AS (
            SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, strlen(coalesce(text, '')) AS n
            FROM documents
        ), place AS (
            SELECT doc_id, i, substr(h, 2 * i + 1, 200) AS s
            FROM (SELECT *, unnest(range(n - 99)) AS i FROM doc)
        ), again AS (
            SELECT doc_id, i FROM (
                SELECT doc_id, i, row_number() OVER (PARTITION BY s ORDER BY doc_id, i) AS k FROM place
            ) WHERE k > 1
        ), stretch AS (
            SELECT doc_id, min(i) AS start, max(i) + 100 AS stop
            FROM (
                SELECT *, sum(CAST(fresh AS INTEGER)) OVER (PARTITION BY doc_id ORDER BY i) AS island
                FROM (
                    SELECT *, coalesce(i - lag(i) OVER (PARTITION BY doc_id ORDER BY i) > 100, true) AS fresh
                    FROM again
                )
            )
            GROUP BY doc_id, island
        ), gap AS (
            SELECT doc_id, start, stop FROM stretch
        ), kept AS (
            SELECT doc_id, lag(stop, 1, 0) OVER (PARTITION BY doc_id ORDER BY start) AS start, start AS stop FROM gap
            UNION ALL
            SELECT doc_id, coalesce(max(gap.stop), 0), any_value(n) FROM doc LEFT JOIN gap USING (doc_id) GROUP BY doc_id
        ), text AS (
            SELECT doc_id, string_agg(substr(h, 2 * start + 1, 2 * (stop - start)), '' ORDER BY start) AS h
            FROM kept JOIN doc USING (doc_id) GROUP BY doc_id
        ), removed AS (
            SELECT doc_id, sum(stop - start) AS n_removed, count(*) AS n_spans FROM gap GROUP BY doc_id
        )
        SELECT doc_id, n AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
               coalesce(n_spans, 0) AS n_spans, sha256(unhex(text.h)) AS kept_sha256
        FROM doc LEFT JOIN removed USING (doc_id) LEFT JOIN text USING (doc_id)
    """,
}

"""Registered queries of the training-data operators (driver contract)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm import ann, bpe, chat, dialogues, langid, licenses, mixing, search, secrets, simhash, syncmers, toxicity, warc
from tidewater.llm.common import shared_path
from tidewater.sources.tables import read_table


def op1_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learnt from the rows that are not held out."""
    docs = read_table(spark, sf_dir, "documents", ["doc_id", "text", "lang"])
    return langid.predict(docs, langid.fit(docs)).select(
        "doc_id", F.coalesce(langid.fold() == 1, F.lit(False)).alias("held_out"), "lang_pred", "score", "rate")


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to WARC archives in the shared folder and read back."""
    path = shared_path(spark, "warc")
    warc.write_archives(read_table(spark, sf_dir, "pages", ["page_id", "url", "html"]), path)
    back = warc.reassemble(warc.read_records(spark, path))
    return back.select(
        warc.page_of(F.col("record_id")).alias("page_id"), "payload_bytes",
        F.when(F.col("fault").isNull(), F.coalesce("found", "digest")).alias("payload_digest"),
        "record_type", warc.page_of(F.col("refers_to")).alias("refers_to"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learnt from labelled rows that are not held out."""
    docs = read_table(spark, sf_dir, "documents", ["doc_id", "text", "lang"])
    net = toxicity.fit(docs, read_table(spark, sf_dir, "labels", ["doc_id", "toxic"]))
    return toxicity.score(docs, net).select(
        "doc_id", F.coalesce(toxicity.fold() == 0, F.lit(False)).alias("held_out"), "score", "predicted")


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document: base patterns and the token-efficiency test."""
    return secrets.span_digests(secrets.find_secrets(read_table(spark, sf_dir, "documents", ["doc_id", "text"])))


def op5_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest vectors of every hundredth one."""
    return ann.search(read_table(spark, sf_dir, "embeddings", ["vec_id", "embedding"]), F.col("vec_id") % 100 == 0)


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's SimHash fingerprint and its component of near-duplicates."""
    groups = simhash.near_duplicates(read_table(spark, sf_dir, "documents", ["doc_id", "text"]))
    return groups.select("doc_id", simhash.hex_digits().alias("fingerprint"), "component_id")


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's byte-level BPE ids and their decoded text, as digests."""
    return bpe.encode_digests(read_table(spark, sf_dir, "documents", ["doc_id", "text"]))


def op8_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases and passages of every document."""
    return licenses.summary(licenses.scan(read_table(spark, sf_dir, "documents", ["doc_id", "text"])))


def op9_syncmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's fingerprint against its edited text's and the next document's."""
    return syncmers.compare_neighbours(read_table(spark, sf_dir, "documents", ["doc_id", "text"]))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Copies of every document in a mix of all sources at weights 5, 2, 1, ..."""
    return mixing.mix(read_table(spark, sf_dir, "documents", ["doc_id", "source", "text"])).select(
        "doc_id", "size", "source_size", "target", "taken", "source", "copies")


def op11_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation, damaged and repaired at the least cost."""
    turns = read_table(spark, sf_dir, "conversations", ["conv_id", "turn", "role", "text"])
    return dialogues.summary(dialogues.damage(turns), turns.select("conv_id"))


def op12_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation, and one full of control strings, formatted and read back."""
    hard = r"\### Assistant: </turn> ok"
    planted = spark.createDataFrame([(-7, 0, "user", hard), (-7, 1, "assistant", hard)],
                                    "conv_id bigint, turn bigint, role string, text string")
    return chat.read_back(read_table(spark, sf_dir, "conversations", ["conv_id", "turn", "role", "text"]).union(planted))


def op13_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents of every benchmark item."""
    return search.search(read_table(spark, sf_dir, "documents", ["doc_id", "text"]),
                         read_table(spark, sf_dir, "benchmark", ["item_id", "text"]))


QUERIES = {
    "op1_langid": op1_langid,
    "op2_warc": op2_warc,
    "op3_toxicity": op3_toxicity,
    "op4_secrets": op4_secrets,
    "op5_ann": op5_ann,
    "op6_simhash": op6_simhash,
    "op7_bpe": op7_bpe,
    "op8_licenses": op8_licenses,
    "op9_syncmers": op9_syncmers,
    "op10_mixing": op10_mixing,
    "op11_repair": op11_repair,
    "op12_chat": op12_chat,
    "op13_search": op13_search,
}

SQL: dict[str, str] = {}

SQL["op2_warc"] = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS body, sha1(encode(coalesce(html, ''))) AS hex FROM pages
), bits AS (
  SELECT page_id, body, hex, array_to_string(list_transform(range(1, 41), lambda j:
    ['0000','0001','0010','0011','0100','0101','0110','0111','1000','1001','1010','1011','1100','1101','1110','1111']
    [position(substr(hex, j, 1) IN '0123456789abcdef')]), '') AS b
  FROM p
), firsts AS (
  SELECT hex, min(page_id) AS first FROM p GROUP BY hex
)
SELECT b.page_id, CAST(octet_length(encode(b.body)) AS BIGINT) AS payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + 16 * CAST(substr(b.b, 5 * i + 1, 1) AS INT) + 8 * CAST(substr(b.b, 5 * i + 2, 1) AS INT)
      + 4 * CAST(substr(b.b, 5 * i + 3, 1) AS INT) + 2 * CAST(substr(b.b, 5 * i + 4, 1) AS INT)
      + CAST(substr(b.b, 5 * i + 5, 1) AS INT), 1)), '') AS payload_digest,
  CASE WHEN b.page_id IS NOT NULL AND b.page_id <= f.first OR f.first IS NULL THEN 'response' ELSE 'revisit' END
    AS record_type,
  CASE WHEN b.page_id IS NULL OR b.page_id > f.first THEN f.first END AS refers_to
FROM bits b JOIN firsts f ON b.hex = f.hex
"""

SQL["op13_search"] = r"""
WITH words AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents
), tf AS (
  SELECT doc_id, term, count(*) AS tf FROM words GROUP BY ALL
), size AS (
  SELECT doc_id, CAST(sum(tf) AS BIGINT) AS n FROM tf GROUP BY ALL
), total AS (
  SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS length FROM size
), weight AS (
  SELECT term, CAST(floor(1000 * ln((2 * any_value(docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM tf, total GROUP BY term
), asked AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark
), scored AS (
  SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * docs) // length))))
    AS BIGINT) AS score
  FROM asked JOIN tf USING (term) JOIN weight USING (term) JOIN size USING (doc_id), total GROUP BY ALL
)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INT) AS rank, doc_id, score
FROM scored WHERE score > 0
QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) <= 10
"""

SQL["op12_chat"] = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), read AS (
  SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
    coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn NULLS FIRST, role, text), '') AS loss,
    CAST(sum(15 + length(role) + length(text) + (length(text) - length(replace(text, '### ', ''))) // 4
      + (length(text) - length(replace(text, '</turn>', ''))) // 7) AS BIGINT) AS formatted_chars
  FROM turns GROUP BY conv_id
)
SELECT conv_id, n_turns, turns_sha256, CAST(length(loss) AS BIGINT) AS loss_chars, sha256(loss) AS loss_sha256,
  formatted_chars FROM read
"""

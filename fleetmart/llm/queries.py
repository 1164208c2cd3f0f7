"""One query per numbered operator over the test tables, with its SQL twin where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetmart.llm import (
    chat, decontamination, fill_in_middle, html_extraction, language, near_dup, nearest, packing, periodic_runs, quality,
    sharding, token_counts, toxicity,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(run: Query) -> Query:
    QUERIES[run.__name__] = run
    return run


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query
def op1_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents"))


@query
def op2_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontamination.matches(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query
def op3_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts.token_counts(table(spark, folder, "documents"))


@query
def op4_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    found = html_extraction.extract(table(spark, folder, "pages"))
    return found.withColumn("n_chars", F.length("text").cast("long"))


@query
def op5_language_id(spark: SparkSession, folder: str) -> DataFrame:
    return language.identify(table(spark, folder, "documents"))


@query
def op6_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.classify(table(spark, folder, "documents"), table(spark, folder, "labels"))


SHARDS = [f"shard-{k:05d}" for k in range(sharding.SHARDS)]


@query
def op7_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.assign(table(spark, folder, "documents").select("doc_id"), SHARDS)


@query
def op8_simhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = near_dup.near_duplicates(table(spark, folder, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query
def op9_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality.rate(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query
def op10_chat_formatting(spark: SparkSession, folder: str) -> DataFrame:
    return chat.format_chats(table(spark, folder, "conversations"))


def with_loops(docs: DataFrame) -> DataFrame:
    """(doc_id, text): in about a tenth of the documents, by the checksum of the id, the words from a place on repeat."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = docs.select("doc_id", "text", h.alias("_h"), F.regexp_extract_all("text", F.lit(r"([^\x20\x09-\x0D]+)"), F.lit(0)).alias("_words"))
    n, g = F.size("_words"), F.floor(F.col("_h") / 10)
    placed = words.select("doc_id", "text", "_words", (F.coalesce(F.col("_h") % 10 == 0, F.lit(False)) & (n > 0)).alias("_looped"), n.alias("_n"), g.alias("_g"))
    start = (F.col("_g") % F.col("_n")).cast("int")
    rest = F.col("_n") - start
    period = (1 + F.floor(rest / (3 + F.col("_g") % 8))).cast("int")
    times = F.ceil(rest / period).cast("int")
    loop = F.slice(F.flatten(F.array_repeat(F.slice("_words", start + 1, period), times)), F.lit(1), rest)
    text = F.array_join(F.concat(F.slice("_words", F.lit(1), start), loop), " ")
    return placed.select("doc_id", F.when(F.col("_looped"), text).otherwise(F.col("text")).alias("text"))


@query
def op11_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    found = periodic_runs.periodic_runs(with_loops(table(spark, folder, "documents")))
    none = F.lit(None).cast("struct<start:bigint,length:bigint,period:bigint>")
    # Exponents are compared as fractions; of equal ones the first stays.
    longer = lambda best, r: F.when(best.isNull() | (r["length"] * best["period"] > best["length"] * r["period"]), r).otherwise(best)
    lines = F.transform("runs", lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n")))
    digests = found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.aggregate("runs", none, longer).alias("best"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
    milli = F.expr("1000 * best.length div best.period").alias("exponent_milli")
    return digests.select("doc_id", "n_runs", "best.*", milli, "runs_sha256", "collapsed_sha256")


@query
def op12_nearest_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    return nearest.nearest(table(spark, folder, "embeddings"), lambda vec_id: vec_id % 20 == 0)


@query
def op13_fill_in_middle(spark: SparkSession, folder: str) -> DataFrame:
    cut = fill_in_middle.fill_in_middle(table(spark, folder, "documents"))
    whole = fill_in_middle.restored(F.col("output"), F.col("form"))
    return cut.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"), F.sha2(whole, 256).alias("restored_sha256"),
    )


# The shards' claims, one turn after the other; free says of every slot whether it still is.
ORACLES["op7_sharding"] = f"""
WITH RECURSIVE shards AS (
    SELECT k, 'shard-' || lpad(k::VARCHAR, 5, '0') AS shard FROM range({sharding.SHARDS}) r(k)
), drawn AS (
    SELECT k, ('0x' || substr(md5(shard || ' start'), 1, 15))::BIGINT % {sharding.SLOTS} AS start,
           ('0x' || substr(md5(shard || ' stride'), 1, 15))::BIGINT % {sharding.SLOTS - 1} + 1 AS stride
    FROM shards
), orders AS MATERIALIZED (
    SELECT k, list(((start + j * stride) % {sharding.SLOTS})::INTEGER ORDER BY j) AS preferred FROM drawn, range({sharding.SLOTS}) r(j) GROUP BY k
), turns AS (
    SELECT 0::BIGINT AS turn, NULL::BIGINT AS slot, NULL::BIGINT AS k, repeat('1', {sharding.SLOTS})::BIT AS free
    UNION ALL
    SELECT turn + 1, now, k, set_bit(free, now::INTEGER, 0)
    FROM (
        SELECT turn, o.k, free, preferred[list_position(list_transform(preferred, lambda s: get_bit(free, s)), 1)] AS now
        FROM turns JOIN orders o ON o.k = turn % {sharding.SHARDS} WHERE turn < {sharding.SLOTS}
    )
)
SELECT doc_id, t.slot::INTEGER AS slot, shard
FROM (SELECT doc_id, ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT % {sharding.SLOTS} AS slot FROM documents) d
JOIN turns t ON t.slot = d.slot JOIN shards s ON s.k = t.k
"""

ORACLES["op10_chat_formatting"] = f"""
WITH turns AS (
    SELECT *, CASE WHEN conv_id IS NULL THEN row_number() OVER () END AS own FROM (SELECT DISTINCT conv_id, turn, role, text FROM conversations)
), whole AS (
    SELECT conv_id, list(struct_pack(role := role, text := text) ORDER BY turn NULLS FIRST) AS said FROM turns GROUP BY conv_id, own
), once AS (
    SELECT said, min(conv_id) AS conv_id FROM whole GROUP BY said
), prefixes AS (
    SELECT DISTINCT said[1:n] AS said FROM once, unnest(range(1, len(said))) r(n)
)
SELECT conv_id, len(said)::BIGINT AS n_turns,
       list_aggregate(list_transform(said, lambda t: '{chat.BEGIN}' || coalesce(t.role, '') || chr(10) || coalesce(t.text, '') || '{chat.END}' || chr(10)), 'string_agg', '') AS text
FROM once ANTI JOIN prefixes USING (said)
"""

ORACLES["op13_fill_in_middle"] = f"""
WITH docs AS (
    SELECT doc_id, coalesce(text, '') AS text, length(coalesce(text, '')) AS n, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS drawn FROM documents
), numbers AS (
    SELECT *, list_transform([1, 9, 17, 25], lambda k: ('0x' || substr(drawn, k, 8))::BIGINT) AS h FROM docs
), cuts AS (
    SELECT *, least(h[1] % (n + 1), h[2] % (n + 1)) AS a, greatest(h[1] % (n + 1), h[2] % (n + 1)) AS b,
           CASE WHEN text = '' OR regexp_matches(text, '<[PSM]>') OR h[3] % 100 >= {fill_in_middle.CUT} THEN 'plain'
                WHEN h[4] % 100 < {fill_in_middle.SUFFIX_FIRST} THEN 'spm' ELSE 'psm' END AS form
    FROM numbers
), parts AS (
    SELECT *, substr(text, 1, a) AS prefix, substr(text, a + 1, b - a) AS middle, substr(text, b + 1) AS suffix FROM cuts
)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'spm' THEN '<S>' || suffix || '<P>' || prefix || '<M>' || middle
              ELSE '<P>' || prefix || '<S>' || suffix || '<M>' || middle END) AS output_sha256, sha256(text) AS restored_sha256
FROM parts
"""

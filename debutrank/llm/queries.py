"""The registered queries of this package, with their SQL where there is one."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from debutrank.llm import (
    byte_bpe, decontam, line_chunks, lm_bloom, mixing, near_dup, periodic, pii, quality, sharding, substring, suffix_array,
    variants,
)
from debutrank.testbed.registry import Registry

R = Registry()

SHARDS = 8


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")


@R.query("op2_entropy_mix")
def op2(spark, sf_dir):
    sizes = mixing.word_counts(documents(spark, sf_dir).select("doc_id", "source", "text"))
    mixed = mixing.take(sizes, "doc_id")
    taken = (F.col("copies") * F.col("size")).alias("taken")
    return mixed.select("doc_id", "size", "source_size", "target", taken, "copies", "rate")


@R.query("op3_byte_shards")
def op3(spark, sf_dir):
    narrow = documents(spark, sf_dir).select(
        "doc_id", sharding.text_bytes().alias("_bytes"), F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32")
    )
    placed = sharding.shard_by_bytes(narrow, ["doc_id", "text_crc32"], SHARDS, F.col("_bytes"))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@R.query("op7_compression_bands")
def op7(spark, sf_dir):
    return quality.rate(documents(spark, sf_dir).select("doc_id", "text")).drop("text")


_FOLD = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_SPLIT = rf"list_filter(regexp_split_to_array(coalesce({_FOLD}, ''), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '')"

OP10_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {_SPLIT} AS words FROM documents),
it AS (SELECT item_id, {_SPLIT} AS words FROM benchmark),
win AS (
  SELECT DISTINCT item_id, least(len(words), {decontam.WINDOW}) AS k,
         list_slice(words, i + 1, i + least(len(words), {decontam.WINDOW})) AS w
  FROM (SELECT item_id, words, unnest(range(0, greatest(len(words) - {decontam.WINDOW}, 0) + 1)) AS i
        FROM it WHERE len(words) > 0)),
ks AS (SELECT DISTINCT k FROM win),
dw AS (SELECT rid, i, k, list_slice(words, i + 1, i + k) AS w
       FROM (SELECT rid, words, k, unnest(range(0, len(words) - k + 1)) AS i FROM d, ks)),
hit AS (SELECT rid, i, dw.k, item_id FROM dw JOIN win ON dw.k = win.k AND dw.w = win.w),
cover AS (SELECT rid, count(DISTINCT p) AS n_hit
          FROM (SELECT rid, unnest(range(i, i + k)) AS p FROM hit) GROUP BY rid),
names AS (SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
          FROM (SELECT DISTINCT rid, CAST(item_id AS VARCHAR) AS item FROM hit) GROUP BY rid)
SELECT d.doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
       coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN cover USING (rid) LEFT JOIN names USING (rid)
"""


@R.query("op10_prefix_decontamination", OP10_SQL)
def op10(spark, sf_dir):
    benchmark = spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet")
    found = decontam.contamination(documents(spark, sf_dir), benchmark)
    return found.select(
        "doc_id", "n_words", "n_hit", "n_items",
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


@R.query("op5_tensored_minhash")
def op5(spark, sf_dir):
    found = near_dup.near_duplicates(documents(spark, sf_dir))
    return found.select("doc_id", "n_shingles", F.col("component").alias("component_id"), "kept")


@R.query("op4_suffix_automata")
def op4(spark, sf_dir):
    cut = substring.remove_repeats(documents(spark, sf_dir))
    return cut.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


@R.query("op9_difference_cover")
def op9(spark, sf_dir):
    cut = suffix_array.remove_repeats(documents(spark, sf_dir))
    return cut.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@R.query("op1_log_frequency_bloom")
def op1(spark, sf_dir):
    scored = lm_bloom.score(documents(spark, sf_dir))
    return scored.select(
        "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )


@R.query("op8_line_chunks")
def op8(spark, sf_dir):
    cut = line_chunks.remove_chunks(documents(spark, sf_dir))
    return cut.select("doc_id", "n_lines", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


SECRET = "a fixed secret, so that reruns agree"


@R.query("op6_surrogates")
def op6(spark, sf_dir):
    return pii.surrogate(documents(spark, sf_dir).select("doc_id", "text"), SECRET)


@R.query("op12_scanned_byte_bpe")
def op12(spark, sf_dir):
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    tokens = byte_bpe.encode(documents(spark, sf_dir).select("doc_id", "text"), ranks)
    tokens = tokens.select("doc_id", "n_tokens", F.sha2("packed", 256).alias("ids_sha256"), "ids", "starts")
    back = byte_bpe.decode(tokens, ranks)
    return back.select("doc_id", "n_tokens", "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256"))


def with_periods(docs: DataFrame) -> DataFrame:
    """(doc_id, text): in a tenth of the texts, chosen by the id, the words from one on repeat the first of them."""
    hashed = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.filter(F.split(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    docs = docs.select("doc_id", "text", hashed.alias("h"), F.floor(hashed / 10).alias("g"))
    plain = docs.filter("h IS NULL OR h % 10 <> 0").select("doc_id", "text")
    chosen = docs.filter("h % 10 = 0").withColumn("words", words).withColumn("n", F.size("words"))
    chosen = chosen.withColumn("a", F.expr("int(coalesce(g % nullif(n, 0), 0))"))
    chosen = chosen.withColumn("p", F.expr("int(1 + floor((n - a) / (3 + g % 8)))"))
    repeated = F.expr(
        "array_join(concat(slice(words, 1, a),"
        " slice(flatten(array_repeat(slice(words, a + 1, p), int(ceil((n - a) / p)))), 1, n - a)), ' ')"
    )
    return plain.unionByName(chosen.select("doc_id", repeated.alias("text")))


@R.query("op13_dyadic_squares")
def op13(spark, sf_dir):
    found = periodic.periodic_runs(with_periods(documents(spark, sf_dir)))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    listed = F.array_join(F.transform(lines, lambda line: F.concat(line, F.lit("\n"))), "")
    return found.select(
        "doc_id", "n_runs", "start", "length", "period", "exponent_milli",
        F.sha2(listed.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


def typed(docs: DataFrame) -> DataFrame:
    """(word): all runs of letters; one run of 199, chosen by the id and the run, lacks a code point. A null id is empty."""
    runs = variants.runs(docs.select("doc_id", "text"))
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    runs = runs.select("run", F.crc32(F.concat_ws(":", key, "run").cast("binary")).alias("h"))
    lost = F.expr("concat(substring(run, 1, int(h % length(run))), substring(run, int(h % length(run)) + 2))")
    return runs.select(F.when(F.expr("h % 199 = 0"), lost).otherwise(F.col("run")).alias("word"))


@R.query("op11_variable_grams")
def op11(spark, sf_dir):
    return variants.group(variants.counted(typed(documents(spark, sf_dir))))

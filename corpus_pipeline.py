"""A corpus from raw documents: language, boilerplate lines, near duplicates, benchmark leaks, tokens.

Stages judge rows, not ids, and may be given any columns beside those of documents: names of their own never meet them.
Every stage takes an empty table to an empty one.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tagloom.llm import base, bpe, langid, leaks, lines, neardup

#: Share of the best language below which a document is rejected.
LEAST_SHARE = 0.5
#: Keys of rows without an id of their own start here, above all ids.
BEYOND = 1 << 62


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents whose language is recognised; those without a letter (null and empty texts too), or between languages, go.

    A row is judged by its text alone, so repeated rows share their fate, and null ids don't matter. If no row has a
    language to learn from, none is recognised.
    """
    base.small_batches(spark)
    lang, score, ambiguous = base.fresh(docs, *langid.NAMES)
    guess = langid.annotate(docs, langid.fit(docs), names=(lang, score, ambiguous))
    return guess.where((F.col(lang) != langid.UNKNOWN) & (F.col(score) >= LEAST_SHARE)).select(*base.quoted(docs.columns))


def boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut lines that stand on many sites; a document that had text and is left with none goes.

    Null and empty texts stay as they are, and so do rows without an id. Rows that repeat id and text are cut alike; rows
    of one id with other texts are documents of their own. n_chars follows the text where lines were cut.
    """
    base.small_batches(spark)
    seen, n_cut, kept = base.fresh(docs, *lines.NAMES)
    met = lines.cut(docs, names=(seen, n_cut, kept)).where((F.col(n_cut) == 0) | (F.trim(kept) != ""))
    n_chars = F.when(F.col(n_cut) > 0, F.length(kept)).otherwise(F.col("n_chars"))
    return met.withColumns({"n_chars": n_chars, "text": F.col(kept)}).select(*base.quoted(docs.columns))


def duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates (five-word shingles, 0.8) the row of smallest id stays.

    Of rows that repeat id and text, one stays, that whose columns are smallest as JSON's hash. Rows without an id, or
    that share one with another text, count as documents of their own that come after all others. Null and wordless texts are copies
    of nothing but rows of the same id.
    """
    base.small_batches(spark)
    key, twin, many = base.fresh(docs, "row_key", "row_twin", "row_many")
    every = base.quoted(docs.columns)
    own = F.pmod(F.xxhash64("doc_id", "text"), F.lit(BEYOND)) + F.lit(BEYOND)
    # ids that don't name one row, and whether their texts differ
    of = F.xxhash64("text")
    odd = docs.where("doc_id is not null").groupBy(F.col("doc_id").alias(twin)).agg(F.count("*").alias("n"), (F.min(of) != F.max(of)).alias(many)).where("n > 1").drop("n")
    odd, nameless = base.materialise(odd), docs.where("doc_id is null")
    if odd.isEmpty() and nameless.isEmpty():
        rows = docs.withColumn(key, F.col("doc_id").cast("long"))
    else:
        named = docs.where("doc_id is not null").join(odd, F.col("doc_id") == F.col(twin), "left")
        named = named.withColumn(key, F.when(F.col(many), own).otherwise(F.col("doc_id").cast("long")))
        place = F.row_number().over(Window.partitionBy(key).orderBy(F.xxhash64(F.to_json(F.struct(*every)))))
        repeated = named.where(F.col(twin).isNotNull()).drop(twin, many).unionByName(nameless.withColumn(key, own))
        repeated = repeated.withColumn(many, place).where(F.col(many) == 1).drop(many)
        rows = base.materialise(named.where(F.col(twin).isNull()).drop(twin, many).unionByName(repeated))
    gone = neardup.groups(rows.select(key, "text"), id_col=key).where("not kept").select(key).distinct()
    return rows.join(gone, key, "left_anti").select(*every)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go.

    Rows are judged by id and text: repeated rows share their fate, null ids are judged like others, null and empty texts
    hold nothing and stay. An empty benchmark removes nothing.
    """
    base.small_batches(spark)
    row = F.struct(F.col("doc_id").alias("id"), F.xxhash64("text").alias("of"))
    found = leaks.find(docs.select(row.alias("row"), "text"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"), id_col="row")
    gone, (their_id, their_of) = found.select("row").distinct(), base.fresh(docs, "leak_id", "leak_of")
    gone = gone.select(F.col("row.id").alias(their_id), F.col("row.of").alias(their_of))
    return docs.join(gone, F.col("doc_id").eqNullSafe(F.col(their_id)) & (F.xxhash64("text") == F.col(their_of)), "left_anti").select(*base.quoted(docs.columns))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of what is left, and what they decode to: a row for each row, null texts as empty ones, null ids carried along."""
    base.small_batches(spark)
    return bpe.encode(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [("language", language), ("boilerplate", boilerplate), ("duplicates", duplicates), ("decontaminate", decontaminate), ("tokens", tokens)]
#: Learned languages, tokens and latent retrieval have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to documents, each written to the shared folder and read again; what only earlier stages read is deleted."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        path = f"{base.shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
        with base.scratch(spark):
            stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before:
            base.remove(spark, before)
        before = path
    return docs

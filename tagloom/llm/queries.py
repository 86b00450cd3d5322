"""The eleven registered queries: each operator over its whole table with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    from tagloom.llm import base

    base.small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from tagloom.llm import bpe

    return bpe.encode(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, keep_ids=False)


def op9_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from tagloom.llm import langid

    docs = _table(spark, sf_dir, "documents")
    held_out = langid.remainder("doc_id", 5) == 0
    model = langid.fit(docs.where(~F.coalesce(held_out, F.lit(False))))
    return langid.predict(docs, model).withColumn("held_out", F.coalesce(held_out, F.lit(False)))


def op6_hmm(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tagloom.llm import hmm, langid

    return hmm.score(_table(spark, sf_dir, "documents"), langid.remainder("doc_id", 7) == 2)


def op4_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tagloom.llm import urls

    return urls.judge(_table(spark, sf_dir, "pages"))


def op2_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tagloom.llm import substrings

    return substrings.dedup(_table(spark, sf_dir, "documents"), keep_text=False)


def op3_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tagloom.llm import neardup

    return neardup.groups(_table(spark, sf_dir, "documents"), size=2)


def op10_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tagloom.llm import neighbours

    return neighbours.search(_table(spark, sf_dir, "embeddings"), "id % 20 = 0")


def op1_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tagloom.llm import licences

    return licences.scan(_table(spark, sf_dir, "documents"))


def op5_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from tagloom.llm import lines

    return lines.dedup(_table(spark, sf_dir, "documents")).select("doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("kept", F.lit("")), 256).alias("kept_sha256"))


def op7_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tagloom.llm import leaks

    return leaks.find(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {
    "op1_licences": op1_licences,
    "op2_substrings": op2_substrings,
    "op3_neardup": op3_neardup,
    "op4_urls": op4_urls,
    "op5_lines": op5_lines,
    "op6_hmm": op6_hmm,
    "op7_leaks": op7_leaks,
    "op8_bpe": op8_bpe,
    "op9_langid": op9_langid,
    "op10_neighbours": op10_neighbours,
    "pipeline": pipeline,
}

ORACLE_SQL: dict[str, str] = {
    "op5_lines": r"""
        WITH lines AS (
            SELECT doc_id, source, i - 1 AS place, regexp_replace(parts[i], '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g') AS line
            FROM (SELECT doc_id, source, string_split(text, chr(10)) AS parts FROM documents), unnest(range(1, len(parts) + 1)) AS t(i)
        ), common AS (SELECT line, min((doc_id, place)) AS first FROM lines WHERE line <> '' GROUP BY line HAVING count(DISTINCT source) >= 10),
        gone AS (SELECT l.doc_id, l.place FROM lines l JOIN common c USING (line) WHERE (l.doc_id, l.place) <> c.first)
        SELECT d.doc_id, coalesce(len(string_split(d.text, chr(10))), 0) AS n_lines, (SELECT count(*) FROM gone g WHERE g.doc_id = d.doc_id) AS n_removed,
            sha256((SELECT coalesce(string_agg(x, chr(10) ORDER BY i), '') FROM (SELECT unnest(string_split(d.text, chr(10))) AS x, generate_subscripts(string_split(d.text, chr(10)), 1) - 1 AS i)
                WHERE i NOT IN (SELECT place FROM gone g WHERE g.doc_id = d.doc_id))) AS kept_sha256
        FROM documents d
    """,
}

"""Table sources and sinks: delimited files with odd encodings, nested text, flat exports, write-through."""

from __future__ import annotations

import json
import os
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tagloom.functions import price


def write_through(df: DataFrame) -> DataFrame:
    """Write a table to the folder in spark.checkpoint.dir and read it again, so that lost executors cost no recomputation."""
    spark = df.sparkSession
    root = spark.conf.get("spark.checkpoint.dir", None) or _local(spark)
    path = f"{root}/through-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _local(spark: SparkSession) -> str:
    held = spark.sparkContext._jsc.sc().getCheckpointDir()
    if held.isDefined():
        return held.get()
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tagloom-"))
    return spark.sparkContext._jsc.sc().getCheckpointDir().get()


def sniff(spark: SparkSession, path: str) -> str:
    """The commonest of `,`, `;` and tab in the first line."""
    first = spark.read.text(path).limit(1).collect()
    line = first[0][0] if first else ""
    return max((",", ";", "\t"), key=lambda d: (line.count(d), d == ","))


def read_delimited(spark: SparkSession, path: str, sep: str | None = None, encodings: tuple[str, ...] = ("UTF-8", "windows-1251"), limit: int | None = None) -> DataFrame:
    """A file of strings with a header. The first encoding in which the head has no replacement characters is taken; a byte-order mark goes."""
    sep = sep or sniff(spark, path)
    for encoding in encodings:
        df = spark.read.option("header", True).option("sep", sep).option("encoding", encoding).option("multiLine", False).csv(path)
        head = df.limit(1000).collect()
        if not any("�" in str(v) for row in head for v in row) and not any("�" in c for c in df.columns):
            break
    df = df.toDF(*[c.strip().lstrip("﻿") for c in df.columns])
    return df.limit(limit) if limit else df


def column(df: DataFrame, *names: str) -> Column | None:
    """The first of some columns that a table has, whatever its case."""
    have = {c.lower().strip(): c for c in df.columns}
    return next((F.col(f"`{have[n.lower()]}`") for n in names if n.lower() in have), None)


def read_catalog(spark: SparkSession, path: str, name: str = "name", max_rows: int | None = 250_000) -> DataFrame:
    """A product catalog: row, name, item_id, brand, price and the other columns as strings. The cap counts rows as read; blank names then go."""
    raw = read_delimited(spark, path, limit=max_rows)
    raw = raw.withColumn("row", F.monotonically_increasing_id())
    number = column(raw, "price", "price_regular", "cost")
    out = raw.withColumn("price_number", price.tolerant_double(number) if number is not None else F.lit(None).cast("double"))
    return out.where(F.trim(F.col(name)) != "")


def read_overflowing(spark: SparkSession, path: str) -> DataFrame:
    """Coordinates whose last field may be unquoted (`6085,id_1,10,20,110,220`): frame_idx, tr_id, xyxy, row."""
    lines = spark.read.text(path).withColumn("row", F.monotonically_increasing_id()).where(F.trim("value") != "")
    parts = F.split(F.regexp_replace("value", r'["\[\]]', ""), r"[,;\t]\s*", 3)
    return lines.select(*[F.get(parts, F.lit(i)).alias(n) for i, n in enumerate(("frame_idx", "tr_id", "xyxy"))], "row").where(F.col("frame_idx").try_cast("double").isNotNull())


OCR_ITEM = T.ArrayType(T.StructType([T.StructField("text", T.StringType()), T.StructField("conf", T.DoubleType()), T.StructField("box", T.ArrayType(T.ArrayType(T.DoubleType())))]))


def parse_ocr(x: Column) -> Column:
    """Recognised items of nested JSON in either usual form (parallel lists, or [box, [text, conf]] entries), without exact repeats."""
    mapping = F.from_json(x, "rec_texts array<string>, rec_scores array<double>, rec_polys array<array<array<double>>>")
    by_map = F.transform(F.arrays_zip(mapping["rec_texts"].alias("t"), mapping["rec_scores"].alias("s"), mapping["rec_polys"].alias("p")), lambda z: F.struct(z["t"].alias("text"), z["s"].alias("conf"), z["p"].alias("box")))
    entries = F.from_json(x, "array<array<string>>")
    by_list = F.transform(F.filter(entries, lambda e: F.size(e) == 2), lambda e: F.struct(F.get(F.from_json(e[1], "array<string>"), F.lit(0)).alias("text"), F.get(F.from_json(e[1], "array<string>"), F.lit(1)).try_cast("double").alias("conf"), F.from_json(e[0], "array<array<double>>").alias("box")))
    items = F.when(mapping["rec_texts"].isNotNull(), by_map).otherwise(by_list)
    items = F.filter(items, lambda i: F.trim(i["text"]) != "")
    return F.array_distinct(F.transform(items, lambda i: F.struct(i["text"].alias("text"), F.round(i["conf"], 4).alias("conf"), i["box"].alias("box"))))


def flat(df: DataFrame) -> DataFrame:
    """Every column as text: nested values as JSON, null as empty."""
    cell = lambda f: F.to_json(f"`{f.name}`") if isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)) else F.col(f"`{f.name}`").cast("string")
    return df.select(*[F.coalesce(cell(f), F.lit("")).alias(f.name) for f in df.schema.fields])


def write_delimited(df: DataFrame, path: str, sep: str = ",", mark: bool = False) -> None:
    """Delimited files with a header, one for each partition; with `mark` the header of each begins with a byte-order mark."""
    out = flat(df)
    if mark and out.columns:
        out = out.withColumnRenamed(out.columns[0], "﻿" + out.columns[0])
    out.write.mode("overwrite").option("header", True).option("sep", sep).option("emptyValue", "").csv(path)


def write_json_records(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def schema_wrapper(df: DataFrame, name: str) -> str:
    """The JSON head `{schema, count}` of an export; the rows are in the files beside it."""
    return json.dumps({"schema": name, "columns": df.columns, "count": df.count()}, ensure_ascii=False)


def write_outputs(tracks: DataFrame, frames: DataFrame, task: DataFrame, out_dir: str) -> dict[str, str]:
    """All exports of a run: Parquet for later use, delimited text for people."""
    paths = {name: os.path.join(out_dir, name) for name in ("tracks", "frames", "task")}
    for name, df in (("tracks", tracks), ("frames", frames), ("task", task)):
        df.write.mode("overwrite").parquet(f"{paths[name]}.parquet")
        write_delimited(df, f"{paths[name]}.tsv", "\t", mark=name == "task")
    return paths


def histogram(df: DataFrame, value: str, bins: int | None = None) -> DataFrame:
    """(bin, low, high, n) between the least and largest value; the number of bins follows the rows, from 3 to 14."""
    stats = df.where(F.col(value).isNotNull()).agg(F.min(value).alias("lo"), F.max(value).alias("hi"), F.count(value).alias("n"))
    k = F.lit(bins) if bins else F.least(F.lit(14), F.greatest(F.lit(3), F.col("n"))).cast("int")
    at = F.when(F.col("hi") > F.col("lo"), F.least(k - 1, F.floor((F.col(value) - F.col("lo")) / (F.col("hi") - F.col("lo")) * k).cast("int"))).otherwise(0)
    wide = (F.col("hi") - F.col("lo")) / k
    binned = df.where(F.col(value).isNotNull()).join(F.broadcast(stats)).select(at.alias("bin"), (F.col("lo") + at * wide).alias("low"), (F.col("lo") + (at + 1) * wide).alias("high"))
    return binned.groupBy("bin").agg(F.first("low").alias("low"), F.first("high").alias("high"), F.count("*").alias("n"))


def status_counts(df: DataFrame, column_name: str = "status") -> DataFrame:
    return df.groupBy(F.col(column_name).alias("status")).agg(F.count("*").alias("n"))

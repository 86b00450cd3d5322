"""Frames from a file hierarchy root/sequence/track/frame.ext, found by Spark's file source."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

# Endings of image files.
ENDINGS = ("jpg", "jpeg", "png", "bmp", "webp", "tif", "tiff")


def natural_key(x: Column) -> Column:
    """Sorts digit runs as numbers: runs become fixed-width texts."""
    runs = F.regexp_extract_all(F.lower(x), F.lit(r"(\d+|\D+)"), F.lit(1))
    return F.array_join(F.transform(runs, lambda r: F.when(r.rlike(r"^\d+$"), F.lpad(F.regexp_replace(r, "^0+(?=.)", ""), 20, "0")).otherwise(r)), "")


def list_images(spark: SparkSession, root: str, recursive: bool = True, content: bool = False) -> DataFrame:
    """path, length (and content) of the image files; contents are read only if asked for."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", recursive).load(root)
    files = files.where(F.lower(F.element_at(F.split("path", r"\."), -1)).isin(*ENDINGS))
    return files.select("path", "length", *(["content"] if content else []))


def frame_index(name: Column, ordinal: Column, mode: str = "auto", pattern: str = r"(\d+)", strict: bool = False) -> Column:
    """A frame's number from its file name: the stem, its first number, a pattern's group, or its place."""
    stem = F.regexp_replace(name, r"\.[^.]*$", "")
    got = {
        "filename_stem": F.when(stem.rlike(r"^\d+$"), stem.try_cast("int")), "first_number": F.regexp_extract(stem, r"(\d+)", 1).try_cast("int"), "regex": F.regexp_extract(stem, pattern, 1).try_cast("int"), "enumerate": ordinal.cast("int"),
    }
    got["auto"] = F.coalesce(got["filename_stem"], got["first_number"])
    other = F.raise_error(F.concat(F.lit("no frame number in "), name)).cast("int") if strict else ordinal.cast("int")
    return F.coalesce(got[mode], other)


def tracks(files: DataFrame, least: int = 1, mode: str = "auto", skip_hidden: bool = True) -> DataFrame:
    """sequence_name, track_id, track_key, file_name, frame_index, ord, image_path: frames in natural order; small and hidden tracks left out.

    Frames that repeat an index get `index * 100000 + place`, as many as needed to tell them apart.
    """
    parts = F.split("path", "/")
    f = files.select(F.element_at(parts, -3).alias("sequence_name"), F.element_at(parts, -2).alias("track_id"), F.element_at(parts, -1).alias("file_name"), F.col("path").alias("image_path"), "length")
    if skip_hidden:
        f = f.where(~F.col("sequence_name").startswith(".") & ~F.col("track_id").startswith(".") & ~F.col("file_name").startswith("."))
    track = Window.partitionBy("sequence_name", "track_id")
    f = f.withColumn("ordinal", F.row_number().over(track.orderBy(natural_key(F.col("file_name")), "file_name")) - 1).withColumn("n", F.count("*").over(track)).where(F.col("n") >= least)
    f = f.withColumn("number", frame_index(F.col("file_name"), F.col("ordinal"), mode))
    repeat = F.row_number().over(Window.partitionBy("sequence_name", "track_id", "number").orderBy("ordinal"))
    f = f.withColumn("frame_index", F.when(repeat > 1, F.col("number").cast("long") * 100_000 + F.col("ordinal")).otherwise(F.col("number").cast("long")))
    order = F.row_number().over(track.orderBy("frame_index", natural_key(F.col("file_name")), "file_name")) - 1
    return f.select("sequence_name", "track_id", F.concat_ws("/", "sequence_name", "track_id").alias("track_key"), "file_name", "frame_index", order.alias("ord"), "image_path", "length")

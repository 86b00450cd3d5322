"""Full-frame coordinates looked up for observations under any spelling of their track id."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tagloom.functions import geometry, price


def variants(track: Column, sequence: Column) -> Column:
    """Spellings of a track id in order of preference: as given, last path part, with its sequence, bare, digits, id_N, track_N."""
    last = F.element_at(F.split(track, "/"), -1)
    bare = F.regexp_replace(last, r"^(?:id|track)_", "")
    digits = F.regexp_extract(last, r"(\d+)", 1)
    named = lambda p: F.when(digits != "", F.concat(F.lit(p), digits))
    return F.array_distinct(F.array_compact(F.array(track, last, F.concat(sequence, F.lit("/"), last), bare, F.nullif(digits, F.lit("")), named("id_"), named("track_"))))


def lookup(observations: DataFrame, coords: DataFrame, id_col: str = "observation_id", keep_first: bool = True) -> DataFrame:
    """Adds original_bbox and bbox_source (`csv`, else `crop` with the observation's own bbox).

    Both sides explode to (frame, key); equal keys of the table keep their first row (`row`), or their last. The
    observation's first spelling that is found wins. An equi-join; Spark sends the table along if it is small enough.
    """
    keyed = coords.select("frame_index", F.explode(variants(F.col("track_id"), F.lit(None).cast("string"))).alias("key"), "row", F.col("bbox").alias("found"))
    pick = F.min_by if keep_first else F.max_by
    keyed = keyed.groupBy("frame_index", "key").agg(pick("found", "row").alias("found"))
    asked = observations.select(id_col, "frame_index", F.posexplode(variants(F.col("track_id"), F.col("sequence_name"))).alias("place", "key"))
    best = asked.join(keyed, ["frame_index", "key"]).groupBy(id_col).agg(F.min_by("found", "place").alias("found"))
    out = observations.join(best, id_col, "left")
    return out.withColumns({"original_bbox": F.coalesce("found", "bbox"), "bbox_source": F.when(F.col("found").isNotNull(), "csv").otherwise("crop")}).drop("found")


def attach(observations: DataFrame, translate: bool = False) -> DataFrame:
    """The looked-up box as the observation's; a cell's box may be moved by its parent's corner."""
    if not translate:
        return observations.withColumn("bbox", F.coalesce("original_bbox", "bbox"))
    o, b = F.col("original_bbox"), F.col("bbox")
    return observations.withColumn("bbox", F.when(o.isNull(), b).otherwise(F.struct((b["x1"] + o["x1"]).alias("x1"), (b["y1"] + o["y1"]).alias("y1"), (b["x2"] + o["x1"]).alias("x2"), (b["y2"] + o["y1"]).alias("y2"))))


def parse(raw: DataFrame) -> DataFrame:
    """(frame_index, track_id, bbox, row) of a table of strings, under any usual column names; rows without all three are left out."""
    have = {c.lower().strip(): c for c in raw.columns}
    find = lambda *names: next((F.col(f"`{have[n]}`") for n in names if n in have), F.lit(None).cast("string"))
    whole = geometry.parse_xyxy(find("xyxy", "bbox", "box"))
    n = [price.tolerant_int(find(*names)).cast("int") for names in (("x_min", "xmin", "x1", "left"), ("y_min", "ymin", "y1", "top"), ("x_max", "xmax", "x2", "right"), ("y_max", "ymax", "y2", "bottom"))]
    apart = F.when(n[0].isNotNull() & n[1].isNotNull() & n[2].isNotNull() & n[3].isNotNull(), geometry.box(*n))
    row = F.col("row") if "row" in have else F.monotonically_increasing_id()
    out = raw.select(price.tolerant_int(find("frame_idx", "frame_index", "frame", "idx")).cast("int").alias("frame_index"), F.trim(find("tr_id", "track_id", "track", "id", "object_id")).alias("track_id"), F.coalesce(whole, apart).alias("bbox"), row.alias("row"))
    return out.where("frame_index is not null and track_id <> '' and bbox is not null")

"""Line dedup by distinct-site spread.

A line that occurs less often than the threshold can't spread to it, so counts settle most lines. Each other line hash
gathers a HyperLogLog sketch of its sites; sketches merge by aggregation, on the map side first. Lines whose estimate is
clearly under or over the threshold are settled by it; those near it get exact distinct counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tagloom.llm import base

#: Sites from which on a line is boilerplate, log2 of a sketch's buckets, and how far from the threshold an estimate decides.
SITES, LOG_BUCKETS, NEAR = 10, 8, 0.35
#: Lots in which a line's sketches are merged first.
MERGES = 64
NAMES = ("lines_seen", "lines_cut", "lines_kept")
_BLANKS = " \t\n\x0b\x0c\r"


def line_hashes(df: DataFrame) -> DataFrame:
    """(id, of, site, place, h, h2): each line of (id, of, site, text) by a 128-bit hash, white space at its ends left out; blank lines not at all."""
    at = df.select("id", "of", F.xxhash64("site").alias("site"), F.col("site").isNull().alias("nowhere"), F.posexplode(F.split("text", "\n")).alias("place", "line"))
    at = at.withColumn("line", F.btrim("line", F.lit(_BLANKS))).where("line <> ''")
    return at.select("id", "of", F.when(~F.col("nowhere"), F.col("site")).alias("site"), "place", F.xxhash64("line").alias("h"), F.xxhash64(F.lit(1), "line").alias("h2"))


def boilerplate(lines: DataFrame, sites: int = SITES) -> DataFrame:
    """(h, h2) of the lines that lie on at least `sites` distinct sites. A null site is none.

    A very common line has a sketch in every task; these merge in two steps, so that no task meets them all.
    """
    placed = lines.where("site is not null").select("h", "h2", "site")
    often = base.materialise(placed.groupBy("h", "h2").count().where(F.col("count") >= sites).select("h", "h2"))
    spread = placed.join(often, ["h", "h2"], "left_semi").groupBy("h", "h2", F.pmod(F.spark_partition_id(), F.lit(MERGES)).alias("lot"))
    spread = spread.agg(F.hll_sketch_agg("site", F.lit(LOG_BUCKETS)).alias("sketch")).groupBy("h", "h2").agg(F.hll_union_agg("sketch").alias("sketch"))
    guess = base.materialise(spread.select("h", "h2", F.hll_sketch_estimate("sketch").alias("n")))
    sure = guess.where(F.col("n") > sites * (1 + NEAR)).select("h", "h2")
    near = guess.where((F.col("n") <= sites * (1 + NEAR)) & (F.col("n") >= sites * (1 - NEAR))).select("h", "h2")
    exact = placed.join(near, ["h", "h2"], "left_semi").groupBy("h", "h2").agg(F.count_distinct("site").alias("n")).where(F.col("n") >= sites)
    return base.materialise(sure.union(exact.select("h", "h2")))


def cut(df: DataFrame, sites: int = SITES, id_col: str = "doc_id", text_col: str = "text", site_col: str = "source", names: tuple[str, ...] = NAMES) -> DataFrame:
    """`df` with three columns more, under `names` (`base.fresh` finds such that it doesn't have): lines, lines cut, the text without boilerplate. See `dedup`."""
    key, of = F.col(id_col).cast("long"), F.xxhash64(F.col(text_col))
    docs = df.where(key.isNotNull()).select(key.alias("id"), of.alias("of"), F.col(text_col).alias("text"), F.col(site_col).cast("string").alias("site"))
    lines = base.materialise(line_hashes(docs))
    met = lines.select("id", "of", "place", "h", "h2").join(boilerplate(lines, sites), ["h", "h2"])
    first = met.groupBy("h", "h2").agg(F.min(F.struct("id", "of", "place")).alias("first"))
    gone = met.join(first, ["h", "h2"]).where(F.struct("id", "of", "place") != F.col("first"))
    their_id, their_of, places = base.fresh(df, "id_", "of_", "places_")
    gone = gone.groupBy(F.col("id").alias(their_id), F.col("of").alias(their_of)).agg(F.collect_set("place").alias(places))
    text, cuts = F.col(text_col), F.col(f"`{places}`")

    def rest(parts: Column) -> Column:
        return F.array_join(F.transform(F.array_except(F.sequence(F.lit(0), F.size(parts) - 1), cuts), lambda i: F.get(parts, i)), "\n")

    seen = F.when(text.isNull(), 0).otherwise(F.size(F.split(text, "\n"))).cast("long")
    kept = F.when(cuts.isNull(), text).otherwise(F.get(F.transform(F.array(F.split(text, "\n")), rest), F.lit(0)))
    known = df.where(key.isNotNull()).join(gone, (key == F.col(f"`{their_id}`")) & (of == F.col(f"`{their_of}`")), "left")
    known = known.withColumns({names[0]: seen, names[1]: F.when(cuts.isNull(), 0).otherwise(F.size(cuts)).cast("long"), names[2]: kept}).drop(their_id, their_of, places)
    # rows without an id meet nothing: apart, so that the join has no hot null
    return known.union(df.where(key.isNull()).withColumns({names[0]: seen, names[1]: F.lit(0).cast("long"), names[2]: text}))


def dedup(df: DataFrame, sites: int = SITES, id_col: str = "doc_id", text_col: str = "text", site_col: str = "source") -> DataFrame:
    """Remove boilerplate lines: id_col, n_lines, n_removed, kept (the text without them).

    A line is boilerplate if it stands, but for white space at its ends, on at least `sites` distinct sites. Its first
    occurrence (smallest id, then place) stays, so that no content leaves the corpus. Blank lines always stay. One row for
    each row of `df`; a null text stays null with no lines, an empty one has one blank line. Rows that repeat id and text
    are judged alike; rows of one id with other texts are documents of their own. Rows without an id have no place in the
    order: they keep all lines and count towards no spread. Rows without a site count towards none either, but lose
    boilerplate. Other columns are left behind.
    """
    got = cut(df.select(id_col, text_col, site_col), sites, id_col, text_col, site_col)
    return got.select(F.col(id_col), F.col("lines_seen").alias("n_lines"), F.col("lines_cut").alias("n_removed"), F.col("lines_kept").alias("kept"))

"""Registered queries over the star-schema tables, each beside the SQL that gives the same rows.

The tables hold no label readings, so each operator runs on columns of the same shape: an order is a track, its lines
are frames, a part is a catalog row, a user's events are a sequence.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tagloom.functions import geometry, price, scores, text
from tagloom.operators import catalog, consensus, coords, export, pairs, readings, sequences, tracks, votes
from tagloom.sources import tables
from tagloom.streaming import assign

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}
FLAGSHIP = "task_output"


def query(sql: str | None = None):
    def add(f: Callable) -> Callable:
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def read(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def observations(spark: SparkSession, d: str) -> DataFrame:
    """Lines of orders as observations of tracks: all fields that the track operators read."""
    line, part = read(spark, d, "lineitem"), read(spark, d, "part").select("p_partkey", "p_name", "p_retailprice", "p_size")
    o = line.join(part, line.l_partkey == part.p_partkey, "left")
    size, x = F.coalesce("p_size", F.lit(1)), F.col("l_linenumber") * 20
    return o.select(
        F.concat(F.lit("orders/"), F.col("l_orderkey").cast("string")).alias("track_key"), F.lit("orders").alias("sequence_name"), F.col("l_orderkey").cast("string").alias("track_id"),
        (F.col("l_linenumber").cast("long") * 1_000_000_000 + F.col("l_partkey") * 1000 + F.col("l_suppkey") % 1000).alias("ord"), F.col("l_linenumber").alias("frame_index"), F.concat_ws(":", "l_orderkey", "l_linenumber").alias("observation_id"), F.concat(F.lit("frame_"), F.col("l_linenumber").cast("string")).alias("image_path"),
        geometry.box(x, F.lit(0), x + size + 40, size + 30).alias("bbox"), F.lit("single_tag").alias("mode"), F.lit(None).cast("double").alias("score"), price.two_decimals(F.floor(F.col("l_extendedprice") / 1000)).alias("main_price"), (1 - F.col("l_discount")).alias("price_confidence"),
        F.col("p_name").alias("product_name"), F.lit("шт").alias("unit"), F.when(F.col("l_discount") >= 0.03, F.concat(F.round(F.col("l_discount") * 100).cast("int").cast("string"), F.lit("%"))).alias("discount_percent_raw"), F.lit(None).cast("string").alias("old_price"), F.lit(None).cast("string").alias("stock_status"),
        (F.col("l_returnflag") == "R").alias("needs_review"), F.when(F.col("l_linestatus") == "O", "shelf_red_promo").otherwise("shelf_white_regular").alias("template_name"), (0.5 + F.col("l_tax")).alias("template_confidence"), (F.col("l_quantity") * 4).alias("blur"), F.col("l_tax").alias("over_ratio"), F.col("l_discount").alias("under_ratio"),
        F.concat_ws(" ", F.col("p_name"), F.col("l_returnflag")).alias("ocr_text"), F.struct(F.when(F.col("l_returnflag") == "A", "matched").otherwise("weak_match").alias("status"), F.col("l_partkey").cast("string").alias("item_id"), F.lit(0.8).alias("score"), F.lit(0.7).alias("text_score")).alias("product_match"),
        F.array().cast("array<string>").alias("price_only_candidates"),
    )


@query()
def task_output(spark: SparkSession, d: str) -> DataFrame:
    """All of it: votes, best frames, validation, gate and the task table (its parts have SQL of their own)."""
    t = tracks.aggregate(observations(spark, d))
    extra = {"ocr_text": F.col("product"), "qr_payload": F.when(F.col("item").isNotNull(), F.concat(F.lit("b="), F.col("item"), F.lit(";p1="), F.col("price"))), "barcode": F.lit(None).cast("string"), "color": F.lit(None).cast("string")}
    return export.task_rows(t.withColumns(extra))


@query()
def track_rows(spark: SparkSession, d: str) -> DataFrame:
    return export.track_rows(tracks.aggregate(observations(spark, d)))


@query()
def frame_rows(spark: SparkSession, d: str) -> DataFrame:
    return export.frame_rows(tracks.scored(observations(spark, d)))


_PRICE_SQL = "printf('%d.00', CAST(floor(l_extendedprice / 1000) AS BIGINT))"
_LEADERS = "row_number() OVER (PARTITION BY k ORDER BY w DESC, first, value) AS place"


@query(f"""
    WITH s AS (SELECT l_orderkey AS k, l_returnflag AS value, sum(CAST(l_quantity AS DECIMAL(18,6))) AS w, min(l_linenumber) AS first FROM lineitem GROUP BY ALL),
    r AS (SELECT *, {_LEADERS} FROM s),
    t AS (SELECT k, sum(CAST(w AS DOUBLE)) FILTER (place <= 5) AS total, max(CAST(w AS DOUBLE)) FILTER (place = 1) AS w1, max(CAST(w AS DOUBLE)) FILTER (place = 2) AS w2, max(value) FILTER (place = 1) AS winner FROM r GROUP BY k)
    SELECT k AS l_orderkey, winner, round(w1, 4) AS weight, coalesce(w2 >= 0.84 * w1, false) AS ambiguous, CASE WHEN total > 0 THEN round(w1 / total, 6) ELSE 0.0 END AS ratio FROM t
""")
def weighted_vote(spark: SparkSession, d: str) -> DataFrame:
    return votes.weighted_vote(read(spark, d, "lineitem"), ["l_orderkey"], "l_returnflag", "l_quantity", "l_linenumber").drop("candidates")


_ALIAS_SQL = """
    WITH raw AS (SELECT l_orderkey AS k, l_quantity AS q, l_linenumber AS i, CAST(floor(l_extendedprice / 100) AS BIGINT) AS n FROM lineitem),
    said AS (SELECT k, q, i, CASE i % 4 WHEN 0 THEN printf('%d.00', n) WHEN 1 THEN printf('%d,00 р', n) WHEN 2 THEN CAST(n AS VARCHAR) ELSE printf('%d.%02d', n // 100, n % 100) END AS said FROM raw),
    clean AS (SELECT k, q, i, replace(regexp_replace(said, '[^0-9.,]', '', 'g'), ',', '.') AS c FROM said),
    normal AS (SELECT k, q, i, printf('%.2f', CAST(CASE WHEN NOT contains(c, '.') AND length(c) >= 4 THEN left(c, length(c) - 2) || '.' || right(c, 2) ELSE c END AS DOUBLE)) AS value FROM clean),
    v AS (SELECT k, value, sum(CAST(q AS DECIMAL(18,6))) AS w, min(i) AS first FROM normal GROUP BY ALL),
    keyed AS (SELECT *, CAST(value AS DOUBLE) AS amount, right(value, 2) = '00' AS whole,
          CASE WHEN right(value, 2) = '00' THEN ltrim(split_part(value, '.', 1), '0') WHEN CAST(value AS DOUBLE) < 100 THEN ltrim(ltrim(split_part(value, '.', 1), '0') || right(value, 2), '0') ELSE ltrim(split_part(value, '.', 1), '0') || right(value, 2) END AS shift FROM v),
    g AS (SELECT k, CASE WHEN length(shift) <= 4 THEN translate(shift, '69', 'gg') ELSE shift END AS alias, sum(w) AS w, min(first) AS first, arg_max(value, {'w': w, 'a': amount}) AS heaviest,
          arg_max(value, amount) FILTER (whole AND amount >= 5) AS largest, coalesce(bool_or(whole AND amount >= 5), false) AND bool_or(amount < 5 AND amount > 0) AS shifted, count(DISTINCT shift) > 1 AS flipped FROM keyed GROUP BY ALL),
    c AS (SELECT k, CASE WHEN shifted THEN largest ELSE heaviest END AS value, w, first, bool_or(shifted) OVER (PARTITION BY k) AS shift_resolved, bool_or(flipped) OVER (PARTITION BY k) AS flip_resolved FROM g),
    r AS (SELECT *, %s FROM c),
    t AS (SELECT k, sum(CAST(w AS DOUBLE)) FILTER (place <= 5) AS total, max(CAST(w AS DOUBLE)) FILTER (place = 1) AS w1, max(CAST(w AS DOUBLE)) FILTER (place = 2) AS w2, max(value) FILTER (place = 1) AS winner,
          bool_or(shift_resolved) AS shift_resolved, bool_or(flip_resolved) AS flip_resolved FROM r GROUP BY k)
    SELECT k AS l_orderkey, winner, round(w1, 4) AS weight, coalesce(w2 >= 0.84 * w1, false) AS ambiguous, CASE WHEN total > 0 THEN round(w1 / total, 6) ELSE 0.0 END AS ratio, shift_resolved, flip_resolved FROM t
""".replace("%s", _LEADERS)


@query(_ALIAS_SQL)
def price_alias_vote(spark: SparkSession, d: str) -> DataFrame:
    n = F.floor(F.col("l_extendedprice") / 100)
    said = F.concat(n.cast("string"), F.when(F.col("l_linenumber") % 4 == 0, ".00").when(F.col("l_linenumber") % 4 == 1, ",00 р").otherwise(""))
    said = F.when(F.col("l_linenumber") % 4 == 3, F.concat(F.floor(n / 100).cast("string"), F.lit("."), F.lpad((n % 100).cast("string"), 2, "0"))).otherwise(said)
    return votes.price_vote(read(spark, d, "lineitem").withColumn("p", said), ["l_orderkey"], "p", "l_quantity", "l_linenumber").drop("candidates")


@query()
def leader_cluster_vote(spark: SparkSession, d: str) -> DataFrame:
    part = read(spark, d, "part")
    return votes.text_vote(part, ["p_brand", "p_size"], "p_name", "p_retailprice", "p_partkey").select("p_brand", "p_size", "winner", "weight", "ambiguous", "ratio")


@query("""
    WITH s AS (SELECT l_orderkey, l_linenumber, l_quantity * (1 - l_discount) AS score FROM lineitem),
    r AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY score DESC, l_linenumber) AS n FROM s)
    SELECT l_orderkey, l_linenumber, score FROM r WHERE n = 1
""")
def best_frame(spark: SparkSession, d: str) -> DataFrame:
    line = read(spark, d, "lineitem").withColumn("score", F.col("l_quantity") * (1 - F.col("l_discount")))
    return votes.best_row(line, ["l_orderkey"], F.col("score"), "l_linenumber", ["l_linenumber", "score"])


@query("""
    WITH s AS (SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_extendedprice DESC, l_orderkey * 10 + l_linenumber) AS place FROM lineitem)
    SELECT l_suppkey, place, l_extendedprice FROM s WHERE place <= 3
""")
def recovery_top(spark: SparkSession, d: str) -> DataFrame:
    line = read(spark, d, "lineitem").withColumn("ord", F.col("l_orderkey") * 10 + F.col("l_linenumber"))
    return votes.top_rows(line, ["l_suppkey"], F.col("l_extendedprice"), "ord", 3).select("l_suppkey", "place", "l_extendedprice")


@query("""
    SELECT l_orderkey, count(l_returnflag) AS observed, count(DISTINCT l_returnflag) AS distinct_values, min(l_quantity) AS min_score, max(l_quantity) AS max_score, round(avg(l_quantity), 6) AS mean_score FROM lineitem GROUP BY l_orderkey
""")
def vote_diagnostics(spark: SparkSession, d: str) -> DataFrame:
    return votes.diagnostics(read(spark, d, "lineitem"), ["l_orderkey"], "l_returnflag", "l_quantity")


@query("""
    WITH c AS (SELECT o_custkey, o_orderpriority AS value, count(*) AS n, min(o_orderkey) AS first FROM orders GROUP BY ALL),
    r AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY n DESC, first, value) AS place FROM c)
    SELECT o_custkey, place, value, n FROM r WHERE place <= 2
""")
def mode_counts(spark: SparkSession, d: str) -> DataFrame:
    return votes.modes(read(spark, d, "orders"), ["o_custkey"], "o_orderpriority", "o_orderkey", 2)


@query("""
    WITH s AS (SELECT user_id, count(*) AS frames, count(*) FILTER (event_type = 'error') AS hits FROM events GROUP BY user_id),
    f AS (SELECT *, hits / frames AS r, (hits / frames >= 0.5) OR (frames <= 2 AND hits > 0) AS dominant FROM s)
    SELECT user_id, frames, hits, round(r, 6) AS ratio, dominant, CASE WHEN dominant THEN round(0.50 + 0.45 * r, 6) ELSE 0.0 END AS confidence FROM f
""")
def stockout(spark: SparkSession, d: str) -> DataFrame:
    return votes.stockout(read(spark, d, "events"), ["user_id"], F.col("event_type") == "error")


@query("""
    SELECT l_orderkey, l_linenumber, l_partkey, round(least(1.0, greatest(0.0, 0.42 * least(1.0, l_quantity * 4 / 160.0) + 0.22 * greatest(0.0, 1 - 1.6 * greatest(l_tax, l_discount)) + 0.20 * (0.5 + l_tax)
        + CASE WHEN l_extendedprice > 20000 THEN 0.20 ELSE 0.0 END + CASE WHEN l_linestatus = 'O' THEN 0.10 ELSE 0.0 END - CASE WHEN l_returnflag = 'R' THEN 0.12 ELSE 0.0 END)), 4) AS score FROM lineitem
""")
def frame_quality(spark: SparkSession, d: str) -> DataFrame:
    q = scores.frame_quality(F.col("l_quantity") * 4, F.col("l_tax"), F.col("l_discount"), 0.5 + F.col("l_tax"), F.col("l_extendedprice") > 20000, F.col("l_linestatus") == "O", F.col("l_returnflag") == "R")
    return read(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", q.alias("score"))


@query("""
    SELECT l_orderkey, l_linenumber, l_partkey, round(l_tax * (0.85 + 0.25 * least(1.0, greatest(0.0, l_discount * 20))) * CASE WHEN l_quantity > 25 THEN 1.08 ELSE 1.0 END * 1.30, 6) AS price_weight,
        round(l_tax * least(1.25, 0.85 + length(l_returnflag || l_linestatus) / 80.0) * 1.10, 6) AS product_weight FROM lineitem
""")
def vote_weights(spark: SparkSession, d: str) -> DataFrame:
    p = scores.price_weight(F.col("l_tax"), F.col("l_discount") * 20, F.col("l_quantity") > 25)
    n = scores.product_weight(F.col("l_tax"), F.concat("l_returnflag", "l_linestatus"))
    return read(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", F.round(p, 6).alias("price_weight"), F.round(n, 6).alias("product_weight"))


@query("""
    SELECT o_orderkey, CASE WHEN c_custkey IS NULL THEN 'crop' ELSE 'csv' END AS bbox_source, coalesce(c_nationkey, 0) AS x1 FROM orders LEFT JOIN customer ON o_custkey = c_custkey AND c_nationkey < 20
""")
def coord_lookup(spark: SparkSession, d: str) -> DataFrame:
    zero = geometry.box(F.lit(0), F.lit(0), F.lit(1), F.lit(1))
    o = read(spark, d, "orders").select("o_orderkey", (F.col("o_custkey") % 7).cast("int").alias("frame_index"), F.concat(F.lit("id_"), F.col("o_custkey").cast("string")).alias("track_id"), F.lit("seq").alias("sequence_name"), zero.alias("bbox"))
    c = read(spark, d, "customer").where("c_nationkey < 20").select((F.col("c_custkey") % 7).cast("int").alias("frame_index"), F.col("c_custkey").cast("string").alias("track_id"), geometry.box(F.col("c_nationkey"), F.lit(0), F.col("c_nationkey") + 10, F.lit(5)).alias("bbox"), F.col("c_custkey").alias("row"))
    return coords.lookup(o, c, "o_orderkey").select("o_orderkey", "bbox_source", F.col("original_bbox.x1").alias("x1"))


def _catalog(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    part = read(spark, d, "part")
    rows = part.groupBy(F.col("p_name").alias("name")).agg(F.min("p_partkey").alias("row"), F.min("p_retailprice").alias("price"))
    return part.select(F.col("p_partkey").alias("q"), F.concat("p_name", F.lit(" "), F.lower("p_type")).alias("text"), F.col("p_retailprice").alias("price")), rows


_BLOCK_SQL = """
    WITH cat AS (SELECT p_name AS name, min(p_partkey) AS row, min(p_retailprice) AS price FROM part GROUP BY 1),
    qs AS (SELECT p_partkey AS q, p_name || ' ' || lower(p_type) AS text, p_retailprice AS price FROM part),
    ct AS (SELECT row, unnest(list_distinct(regexp_extract_all(lower(name), '[0-9a-z]+'))) AS key FROM cat), qt AS (SELECT q, unnest(list_distinct(regexp_extract_all(lower(text), '[0-9a-z]+'))) AS key FROM qs),
    hits AS (SELECT q, row, CASE WHEN length(key) >= 5 THEN 2.0 ELSE 1.0 END AS w FROM qt JOIN ct USING (key) WHERE length(key) >= 3
        UNION ALL SELECT q, row, 1.4 FROM qs JOIN cat ON round_even(cat.price, 0) BETWEEN round_even(qs.price, 0) - 2 AND round_even(qs.price, 0) + 2),
    blocks AS (SELECT q, row, CAST(sum(CAST(w AS DECIMAL(18,2))) AS DOUBLE) AS block FROM hits GROUP BY ALL)
"""


@query(_BLOCK_SQL + "SELECT q, row, block FROM blocks")
def catalog_blocking(spark: SparkSession, d: str) -> DataFrame:
    return catalog.block(*_catalog(spark, d))


_BAND = "CAST(CASE WHEN far <= 0.005 THEN 1.0 WHEN far <= 0.015 THEN 0.92 WHEN far <= 0.05 THEN 0.74 WHEN far <= 0.12 THEN 0.42 ELSE 0.0 END AS DOUBLE)"


@query(_BLOCK_SQL + f""",
    met AS (SELECT q, row, list_distinct(list_filter(regexp_extract_all(lower(qs.text), '[0-9a-z]+'), lambda t: length(t) >= 2)) AS a, list_distinct(list_filter(regexp_extract_all(lower(name), '[0-9a-z]+'), lambda t: length(t) >= 2)) AS b,
        lower(qs.text) AS x, lower(name) AS y, abs(cat.price - qs.price) / greatest(1.0, abs(cat.price), abs(qs.price)) AS far FROM blocks JOIN qs USING (q) JOIN cat USING (row)),
    f AS (SELECT *, list_transform(a, lambda t: CASE WHEN length(t) >= 5 THEN 1.25 ELSE 1.0 END) AS ws, list_transform(a, lambda t: CASE WHEN list_contains(b, t) THEN 1.0 ELSE coalesce(list_max(list_transform(b, lambda n:
        CASE WHEN abs(length(t) - length(n)) > greatest(3, floor(0.55 * greatest(length(t), length(n)))) THEN 0.0 WHEN length(t) >= 3 AND (contains(t, n) OR contains(n, t)) THEN least(0.96, 0.72 + 0.04 * least(length(t), length(n)))
        ELSE 1 - levenshtein(t, n) / greatest(length(t), length(n)) END)), 0.0) END) AS ss FROM met),
    h AS (SELECT *, len(list_filter(ss, lambda s: s >= 0.74)) AS hits, list_sum(list_transform(list_zip(ws, ss), lambda z: CASE WHEN z[2] >= 0.74 THEN z[1] * z[2] ELSE 0.0 END)) / list_sum(ws) AS fuzzy FROM f),
    s AS (SELECT *, len(list_intersect(a, b)) AS both_, len(list_distinct(list_concat(a, b))) AS any_, greatest(len(list_intersect(a, b)) / len(a), fuzzy) AS cover, 1 - levenshtein(x, y) / greatest(length(x), length(y), 1) AS r, {_BAND} AS p FROM h),
    t AS (SELECT *, CASE WHEN both_ > 0 OR hits > 0 THEN least(1.0, 0.66 * cover + 0.14 * both_ / any_ + 0.20 * CASE WHEN cover >= 0.16 OR both_ >= 2 OR hits >= 2 THEN r ELSE 0.0 END) WHEN length(x) >= 7 AND (contains(x, y) OR contains(y, x)) THEN 0.34 ELSE 0.0 END AS ts FROM s),
    u AS (SELECT q, row, ts, p, ts >= 0.26 AS is_text, round(CASE WHEN ts >= 0.26 THEN 0.78 * ts + 0.22 * p ELSE least(1.0, 0.22 + 0.60 * p + 0.18 * ts) END, 6) AS score FROM t WHERE ts >= 0.26 OR p >= 0.98),
    w AS (SELECT *, row_number() OVER (PARTITION BY q, is_text ORDER BY score DESC, row) AS n FROM u),
    z AS (SELECT *, row_number() OVER (PARTITION BY q ORDER BY is_text DESC, n) AS place FROM w WHERE is_text OR n <= 5)
    SELECT q, row, place, CASE WHEN is_text THEN 'text' ELSE 'price' END AS kind, score, round(ts, 6) AS text_score, p AS price_score FROM z WHERE place <= 8
""")
def catalog_match(spark: SparkSession, d: str) -> DataFrame:
    return catalog.match(*_catalog(spark, d))


@query(f"""
    WITH m AS (SELECT l_orderkey, l_linenumber, l_partkey, abs(p_retailprice - l_extendedprice / l_quantity) / greatest(1.0, abs(p_retailprice), abs(l_extendedprice / l_quantity)) AS far FROM lineitem JOIN part ON l_partkey = p_partkey)
    SELECT l_orderkey, l_linenumber, l_partkey, {_BAND} AS band FROM m
""")
def catalog_price_bands(spark: SparkSession, d: str) -> DataFrame:
    met = read(spark, d, "lineitem").join(read(spark, d, "part"), F.col("l_partkey") == F.col("p_partkey"))
    return met.select("l_orderkey", "l_linenumber", "l_partkey", catalog.price_band(F.col("p_retailprice"), F.col("l_extendedprice") / F.col("l_quantity")).alias("band"))


@query("""
    WITH w AS (SELECT p_partkey, p_brand, p_size, list_distinct(string_split(p_name, ' ')) AS t FROM part)
    SELECT a.p_partkey AS a, b.p_partkey AS b, len(list_intersect(a.t, b.t)) / least(len(a.t), len(b.t)) AS overlap FROM w a JOIN w b ON a.p_brand = b.p_brand AND a.p_size = b.p_size AND a.p_partkey < b.p_partkey
""")
def token_overlap(spark: SparkSession, d: str) -> DataFrame:
    p = read(spark, d, "part").select("p_partkey", "p_brand", "p_size", text.blank_words(F.col("p_name")).alias("words"))
    return pairs.scored(p, ["p_brand", "p_size"], "p_partkey", "words", text.shared, 0.0).withColumnRenamed("score", "overlap")


@query("""
    WITH m AS (SELECT user_id, event_id, event_type, CASE WHEN lag(event_type) OVER w IS NOT DISTINCT FROM event_type AND row_number() OVER w > 1 THEN 0 ELSE 1 END AS new FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id)),
    n AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY event_id) AS island FROM m)
    SELECT user_id, CAST(island AS BIGINT) AS island, any_value(event_type) AS value, count(*) AS n, min(event_id) AS first, max(event_id) AS last FROM n GROUP BY user_id, island
""")
def gap_islands(spark: SparkSession, d: str) -> DataFrame:
    return sequences.islands(read(spark, d, "events"), ["user_id"], "event_type", ["event_id"])


@query("""
    WITH g AS (SELECT user_id, event_id, epoch_us(ts) / 1000000.0 AS t FROM events),
    m AS (SELECT *, CASE WHEN t - lag(t) OVER (PARTITION BY user_id ORDER BY event_id) <= 43200 THEN 0 ELSE 1 END AS new FROM g),
    n AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY event_id) AS session FROM m)
    SELECT user_id, CAST(session AS BIGINT) AS session, count(*) AS n FROM n GROUP BY user_id, session
""")
def session_tracks(spark: SparkSession, d: str) -> DataFrame:
    at = F.unix_micros(F.col("ts").cast("timestamp")) / 1000000.0
    return sequences.sessions(read(spark, d, "events"), ["user_id"], at, 43200.0, ["event_id"]).groupBy("user_id", "session").agg(F.count("*").alias("n"))


@query("SELECT user_id, event_id, count(*) OVER (PARTITION BY user_id, event_type ORDER BY event_id DESC) AS ahead FROM events")
def future_support(spark: SparkSession, d: str) -> DataFrame:
    return sequences.support_ahead(read(spark, d, "events"), ["user_id"], "event_type", ["event_id"]).select("user_id", "event_id", "ahead")


@query("""
    WITH b AS (SELECT l_orderkey, CAST(l_linenumber AS BIGINT) * 1000000000 + l_partkey * 1000 + l_suppkey % 1000 AS ord, l_linenumber * 20 AS x1, l_linenumber * 20 + p_size + 40 AS x2, p_size + 30 AS y2 FROM lineitem JOIN part ON l_partkey = p_partkey),
    p AS (SELECT l_orderkey, x1, x2, y2, lag(x1) OVER w AS a1, lag(x2) OVER w AS a2, lag(y2) OVER w AS b2 FROM b WINDOW w AS (PARTITION BY l_orderkey ORDER BY ord)),
    i AS (SELECT *, greatest(0, least(x2, a2) - greatest(x1, a1)) * least(y2, b2) AS inter, (x2 - x1) * y2 AS area, (a2 - a1) * b2 AS area2, sqrt(pow((x1 + x2) / 2 - (a1 + a2) / 2, 2) + pow(y2 / 2 - b2 / 2, 2)) AS far FROM p),
    s AS (SELECT l_orderkey, a1, inter / (area + area2 - inter) AS iou, greatest(0.0, 1 - far / greatest(1.0, 0.85 * sqrt(greatest(area, area2)))) AS near FROM i)
    SELECT l_orderkey, coalesce(bool_or(a1 IS NOT NULL AND (CASE WHEN iou < 0.0 AND near < 0.22 THEN 0.0 ELSE greatest(iou, 0.65 * near + 0.35 * iou) END) < 0.12), false) AS jump FROM s GROUP BY l_orderkey
""")
def bbox_jumps(spark: SparkSession, d: str) -> DataFrame:
    o = observations(spark, d).where("product_name is not null")
    return sequences.bbox_jumps(o, ["track_id"], "bbox", "ord").select(F.col("track_id").cast("long").alias("l_orderkey"), "jump")


@query("""
    WITH p AS (SELECT user_id, quantile_cont(value, 0.1) AS a, quantile_cont(value, 0.9) AS b, min(value) AS lo, max(value) AS hi FROM events GROUP BY user_id),
    q AS (SELECT user_id, CASE WHEN a = b THEN lo ELSE a END AS lo, CASE WHEN a = b THEN hi ELSE b END AS hi FROM p)
    SELECT event_id, round(CASE WHEN hi > lo THEN greatest(0.85 * least(1.0, greatest(0.0, (value - lo) / (hi - lo))), 0.35 * least(1.0, greatest(0.0, value))) WHEN value > 0 THEN 0.65 ELSE 0.0 END, 6) AS focus FROM events JOIN q USING (user_id)
""")
def focus_norm(spark: SparkSession, d: str) -> DataFrame:
    return tracks.focus_norm(read(spark, d, "events"), ["user_id"], "value").select("event_id", "focus")


@query("""
    WITH p AS (SELECT a.vec_id AS a, b.vec_id AS b, round(list_cosine_similarity(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])), 9) AS score FROM embeddings a JOIN embeddings b ON a.label = b.label AND a.vec_id <> b.vec_id),
    r AS (SELECT *, row_number() OVER (PARTITION BY a ORDER BY score DESC, b) AS place FROM p)
    SELECT a, place, b, score FROM r WHERE place <= 4
""")
def cosine_topk(spark: SparkSession, d: str) -> DataFrame:
    return pairs.nearest(read(spark, d, "embeddings"), "label", "vec_id", "embedding", 4)


@query("SELECT p_partkey AS id, min(p_partkey) OVER (PARTITION BY p_brand, p_type, p_size) AS component FROM part QUALIFY count(*) OVER (PARTITION BY p_brand, p_type, p_size) > 1")
def cluster_components(spark: SparkSession, d: str) -> DataFrame:
    before = F.lag("p_partkey").over(Window.partitionBy("p_brand", "p_type", "p_size").orderBy("p_partkey"))
    edges = read(spark, d, "part").select(F.col("p_partkey").alias("a"), before.alias("b")).where("b is not null")
    return consensus.components(edges)


@query("""
    SELECT page_id, nullif(regexp_extract(url, '[?&]page=([^&#]*)', 1), '') AS page, nullif(regexp_extract(url, '[?&]ref=([^&#]*)', 1), '') AS ref, nullif(regexp_extract(url, '[?&]utm_source=([^&#]*)', 1), '') AS source FROM pages
""")
def qr_parse(spark: SparkSession, d: str) -> DataFrame:
    m = read(spark, d, "pages").withColumn("m", geometry.parse_payload(F.col("url")))
    return m.select("page_id", *[F.try_element_at("m", F.lit(k)).alias(n) for k, n in (("page", "page"), ("ref", "ref"), ("utmsource", "source"))])


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def json_props(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "events").select("event_id", F.expr("try_variant_get(try_parse_json(props), '$.k', 'bigint')").alias("k"))


@query("""
    WITH s AS (SELECT o_orderkey, CAST(floor(o_totalprice) AS BIGINT) % 99999 AS r, CAST(floor(o_totalprice * 7) AS BIGINT) % 100 AS k FROM orders)
    SELECT o_orderkey, CASE WHEN r >= 1 THEN r + k / 100.0 END AS value, CASE WHEN r >= 1 THEN 0.75 END AS confidence FROM s
""")
def price_extract(spark: SparkSession, d: str) -> DataFrame:
    r, k = F.floor("o_totalprice") % 99999, F.floor(F.col("o_totalprice") * 7) % 100
    label = F.concat(F.lit("цена "), r.cast("string"), F.lit(" - "), F.lpad(k.cast("string"), 2, "0"), F.lit(" ₽"))
    c = F.get(price.candidates(label, compact=False), F.lit(0))
    return read(spark, d, "orders").select("o_orderkey", c["value"].alias("value"), c["confidence"].alias("confidence"))


@query("""
    WITH s AS (SELECT o_orderkey, CAST(floor(o_totalprice) AS BIGINT) AS n FROM orders)
    SELECT o_orderkey, CASE WHEN n >= 1000 THEN printf('%d.%02d', n // 100, n % 100) ELSE printf('%d.00', n) END AS compact, printf('%d.50', n) AS comma FROM s
""")
def price_normalize(spark: SparkSession, d: str) -> DataFrame:
    n = F.floor("o_totalprice").cast("string")
    return read(spark, d, "orders").select("o_orderkey", price.normalize(n).alias("compact"), price.normalize(F.concat(n, F.lit(",50 руб"))).alias("comma"))


@query(f"""
    WITH v AS (SELECT l_orderkey, l_linenumber, l_partkey, {_PRICE_SQL} AS p, ltrim(split_part({_PRICE_SQL}, '.', 1), '0') AS shift FROM lineitem)
    SELECT l_orderkey, l_linenumber, l_partkey, p AS price, shift AS shift_key, CASE WHEN length(shift) <= 4 THEN translate(shift, '69', 'gg') ELSE shift END AS alias_key FROM v
""")
def price_keys(spark: SparkSession, d: str) -> DataFrame:
    p = F.col("price")
    line = read(spark, d, "lineitem").withColumn("price", price.two_decimals(F.floor(F.col("l_extendedprice") / 1000)))
    return line.select("l_orderkey", "l_linenumber", "l_partkey", "price", price.shift_key(p).alias("shift_key"), price.alias_key(p).alias("alias_key"))


@query("""
    SELECT p_partkey, p_size || ' г' AS volume, p_size || '%' AS percent, CASE WHEN p_size BETWEEN 3 AND 95 THEN p_size || '%' END AS discount, CASE WHEN p_size > 40 THEN 'out_of_stock' END AS stock FROM part
""")
def label_text(spark: SparkSession, d: str) -> DataFrame:
    n = F.col("p_size").cast("string")
    label = F.concat(F.col("p_name"), F.lit(" "), n, F.lit(" гр, скидка "), n, F.lit("%"), F.when(F.col("p_size") > 40, ", товар закончился").otherwise(""))
    return read(spark, d, "part").select("p_partkey", text.volume(label).alias("volume"), text.percent(label).alias("percent"), text.discount_percent(label).alias("discount"), text.sold_out(label)["status"].alias("stock"))


@query("""
    WITH n AS (SELECT o_orderkey, greatest(0, least(10 + o_custkey % 50, 60) - greatest(o_custkey % 50, 0)) AS w FROM orders)
    SELECT o_orderkey, w * 10 / (100.0 + 600.0 - w * 10) AS iou FROM n
""")
def bbox_iou(spark: SparkSession, d: str) -> DataFrame:
    x = (F.col("o_custkey") % 50).cast("int")
    a, b = geometry.box(x, F.lit(0), x + 10, F.lit(10)), geometry.box(F.lit(0), F.lit(0), F.lit(60), F.lit(10))
    return read(spark, d, "orders").select("o_orderkey", geometry.iou(a, b).alias("iou"))


@query("""
    SELECT o_orderkey, CAST(round_even(1000.0 * (o_custkey % 97) / 30, 0) AS BIGINT) AS frame_timestamp FROM orders
""")
def frame_timestamp(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "orders").select("o_orderkey", geometry.frame_timestamp(F.lit(None).cast("long"), F.lit("a.jpg"), F.col("o_custkey") % 97, F.lit(30)).alias("frame_timestamp"))


@query("""
    WITH v AS (SELECT l_orderkey AS k, count(DISTINCT l_returnflag) AS prices, count(DISTINCT l_linestatus) AS products, max(l_discount) * 10 AS r, max(l_tax) * 12 AS q, min(l_extendedprice) / 5000 AS p, max(l_tax) * 10 AS c FROM lineitem GROUP BY 1),
    s AS (SELECT k, round(least(1.0, CASE WHEN prices >= 4 AND r < 0.58 THEN 0.42 ELSE 0.0 END + CASE WHEN NOT (prices >= 4 AND r < 0.58) AND prices >= 2 AND r < 0.58 THEN 0.24 ELSE 0.0 END + CASE WHEN products >= 2 AND q < 0.72 THEN 0.18 ELSE 0.0 END
        + CASE WHEN p < 2.0 THEN 0.22 ELSE 0.0 END + CASE WHEN c < 0.5 THEN 0.26 ELSE 0.0 END + CASE WHEN products >= 2 THEN 0.12 ELSE 0.0 END), 4)::DOUBLE AS score, prices >= 4 AND r < 0.58 AS unstable FROM v)
    SELECT k AS l_orderkey, score, CASE WHEN score >= 0.68 THEN 'rejected_false_candidate' WHEN unstable THEN 'mixed_track_review' WHEN score >= 0.45 THEN 'needs_review' ELSE 'ok' END AS status FROM s
""")
def track_review(spark: SparkSession, d: str) -> DataFrame:
    v = read(spark, d, "lineitem").groupBy("l_orderkey").agg(F.count_distinct("l_returnflag").alias("prices"), F.count_distinct("l_linestatus").alias("products"), (F.max("l_discount") * 10).alias("r"), (F.max("l_tax") * 12).alias("q"), (F.min("l_extendedprice") / 5000).alias("p"), (F.max("l_tax") * 10).alias("c"))
    got = scores.review(F.col("prices"), F.col("r"), F.col("products"), F.col("q"), F.lit(True), F.lit(0.0), F.col("p").cast("string"), F.col("c"), F.lit(True), F.lit(False))
    return v.select("l_orderkey", got["score"].alias("score"), got["status"].alias("status"))


@query("""
    WITH v AS (SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'matched' ELSE 'weak_match' END AS s, CAST(o_custkey AS VARCHAR) AS item, (o_custkey % 10) / 10.0 AS r FROM orders),
    w AS (SELECT *, s = 'matched' AND (r < 0.62 OR r < 0.50) AS out FROM v)
    SELECT o_orderkey, CASE WHEN out THEN 'rejected_by_track_evidence' ELSE s END AS status, CASE WHEN NOT out THEN item END AS item_id, CASE WHEN out THEN item END AS rejected_item_id FROM w
""")
def match_gate(spark: SparkSession, d: str) -> DataFrame:
    r = (F.col("o_custkey") % 10) / 10.0
    g = scores.gate(F.when(F.col("o_orderstatus") == "F", "matched").otherwise("weak_match"), F.col("o_custkey").cast("string"), F.lit("ok"), F.array().cast("array<string>"), r, F.lit(1.0), r)
    return read(spark, d, "orders").select("o_orderkey", g["status"].alias("status"), g["item_id"].alias("item_id"), g["rejected_item_id"].alias("rejected_item_id"))


@query("""
    WITH v AS (SELECT p_partkey, p_size AS n, p_size % 4 AS sep, (p_size % 10) / 10.0 AS width, (p_size % 7) / 2.0 AS aspect FROM part),
    s AS (SELECT *, least(0.28, 0.10 + 0.06 * (n - 1)) + CASE WHEN width >= 0.42 THEN 0.16 ELSE 0 END + 0.08 + 0.07 + 0.12 + CASE WHEN sep >= 1 THEN least(0.22, 0.12 + 0.04 * sep) WHEN aspect >= 2.65 THEN 0.10 ELSE 0 END + 0.07 AS l FROM v)
    SELECT p_partkey, CASE WHEN n < 2 THEN 'single_tag' WHEN l >= 0.58 THEN 'price_rail' ELSE 'single_tag' END AS mode FROM s
""")
def structure_router(spark: SparkSession, d: str) -> DataFrame:
    n, no = F.col("p_size"), F.lit(False)
    likely = scores.rail_likelihood(n, (n % 10) / 10.0, F.lit(0.05), F.lit(0.2), F.lit("hough"), n % 4, (n % 7) / 2.0, F.lit(0.5), no, no, no, F.lit(0.5))
    return read(spark, d, "part").select("p_partkey", scores.route(n, likely, F.lit(0.0)).alias("mode"))


@query("""
    SELECT p_partkey, CAST(round_even(0.25 * (p_size * 10), 0) AS INT) AS x1, CAST(round_even(0.38 * 200, 0) AS INT) AS y1, CAST(round_even(0.82 * (p_size * 10), 0) AS INT) AS x2, CAST(round_even(0.78 * 200, 0) AS INT) AS y2 FROM part
""")
def zone_layout(spark: SparkSession, d: str) -> DataFrame:
    zones = readings.zone_boxes(F.lit("shelf_white_regular"), F.col("p_size") * 10, F.lit(200), F.lit(0.5))
    main = F.get(F.filter(zones, lambda z: z["zone"] == "main_price"), F.lit(0))
    return read(spark, d, "part").select("p_partkey", *[main[c].alias(c) for c in ("x1", "y1", "x2", "y2")])


@query("SELECT o_orderstatus AS status, count(*) AS n FROM orders GROUP BY 1")
def status_counts(spark: SparkSession, d: str) -> DataFrame:
    return tables.status_counts(read(spark, d, "orders"), "o_orderstatus")


@query("""
    WITH s AS (SELECT min(o_totalprice) AS lo, max(o_totalprice) AS hi FROM orders)
    SELECT CAST(least(13, floor((o_totalprice - lo) / (hi - lo) * 14)) AS INT) AS bin, count(*) AS n FROM orders, s GROUP BY 1
""")
def histogram(spark: SparkSession, d: str) -> DataFrame:
    return tables.histogram(read(spark, d, "orders"), "o_totalprice").select("bin", "n")


@query("""
    SELECT o_orderkey, coalesce(nullif(trim(c_name), ''), 'нет') AS customer, coalesce(nullif(trim(n_name), ''), 'нет') AS nation, CASE WHEN o_orderstatus = 'F' THEN o_orderpriority ELSE '' END AS code
    FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey
""")
def task_projection(spark: SparkSession, d: str) -> DataFrame:
    o, c, n = (read(spark, d, t) for t in ("orders", "customer", "nation"))
    met = o.join(c, F.col("o_custkey") == F.col("c_custkey"), "left").join(n, F.col("c_nationkey") == F.col("n_nationkey"), "left")
    code = F.coalesce(F.when(F.col("o_orderstatus") == "F", F.col("o_orderpriority")), F.lit(""))
    return met.select("o_orderkey", export.absent(F.col("c_name")).alias("customer"), export.absent(F.col("n_name")).alias("nation"), code.alias("code"))


@query("""
    WITH p AS (SELECT l_orderkey, count(DISTINCT CASE WHEN l_quantity >= 20 THEN l_linenumber END) AS products, count(DISTINCT l_linenumber) AS prices FROM lineitem GROUP BY 1)
    SELECT l_orderkey, products < 2 AS recover, CASE WHEN products = 0 THEN 'price_without_product' WHEN products < 2 THEN 'few_product_frames' END AS reason, products, prices FROM p
""")
def recovery_need(spark: SparkSession, d: str) -> DataFrame:
    none = F.struct(F.lit("weak_match").alias("status"), F.lit(0.0).alias("score"))
    o = read(spark, d, "lineitem").select("l_orderkey", F.col("l_linenumber").alias("frame_index"), F.lit("9.00").alias("main_price"), F.when(F.col("l_quantity") >= 20, "long product name").alias("product_name"), none.alias("product_match"))
    return tracks.needs_recovery(o, "l_orderkey")


@query("SELECT count(DISTINCT l_suppkey) AS sequences, count(DISTINCT l_orderkey) AS tracks, count(*) AS frames, count(*) FILTER (l_returnflag = 'R') AS errors, count(DISTINCT l_orderkey) AS ok FROM lineitem")
def run_summary(spark: SparkSession, d: str) -> DataFrame:
    line = read(spark, d, "lineitem")
    t = line.select(F.col("l_orderkey")).distinct().withColumn("status", F.lit("ok"))
    return tracks.run_summary(t, line.select(F.col("l_suppkey").alias("sequence_name"), F.when(F.col("l_returnflag") == "R", "x").alias("error")))


@query()
def split_segments(spark: SparkSession, d: str) -> DataFrame:
    o = tracks.scored(observations(spark, d))
    return sequences.split_tracks(o, "track_key", ["frame_index", "ord"], "main_price", "product_name", "score", 0.5, 0.5)


@query()
def assign_tracks(spark: SparkSession, d: str) -> DataFrame:
    e = read(spark, d, "events")
    x = (F.col("value") * 3).cast("int")
    o = e.select(F.col("user_id").cast("string").alias("sequence_name"), F.col("event_id").cast("string").alias("observation_id"), (F.unix_seconds(F.col("ts").cast("timestamp")) / 3600).cast("long").alias("frame_index"), x.alias("x1"), F.lit(0).alias("y1"), (x + 60).alias("x2"), F.lit(40).alias("y2"), F.lit(None).cast("string").alias("main_price"), F.col("event_type").alias("product_name"))
    return assign.assign(o)


@query()
def visual_consensus(spark: SparkSession, d: str) -> DataFrame:
    e = read(spark, d, "embeddings").select(F.col("vec_id"), F.col("embedding").cast("array<double>").alias("feature"))
    o = tracks.scored(observations(spark, d)).withColumn("vec_id", F.abs(F.hash("product_name")) % 500).join(e, "vec_id", "left").withColumn("focus", F.col("blur") / 200.0)
    return consensus.visual_consensus(o).select("track_key", "ord", "cluster", "size", "selected", "reference", F.round("cluster_score", 6).alias("cluster_score"))

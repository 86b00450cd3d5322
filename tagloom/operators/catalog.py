"""Matching label texts with a product catalog: blocking by tokens and price buckets, scoring, decision."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from tagloom.functions import text

# Relative differences and what they are worth, for the two presets.
BANDS, LOOSE_BANDS = ((0.005, 1.0), (0.015, 0.92), (0.05, 0.74), (0.12, 0.42)), ((0.01, 1.0), (0.05, 0.80), (0.12, 0.45))
#: Worth of a token pair from which on it counts.
FUZZY = 0.74
ACCEPTED = ("matched", "accepted", "csv_catalog_corrected")


def price_band(a: Column, b: Column, bands: tuple = BANDS) -> Column:
    """What two prices' relative difference is worth."""
    far = F.abs(a - b) / F.greatest(F.lit(1.0), F.abs(a), F.abs(b))
    out = F.lit(0.0)
    for limit, value in reversed(bands):
        out = F.when(far <= limit, value).otherwise(out)
    return F.coalesce(out, F.lit(0.0))


def best_price(columns: Column, observed: Column, bands: tuple = BANDS) -> Column:
    """struct<score, column>: the best band over a catalog row's prices and the observed ones; the first column wins ties."""
    scored = F.transform(columns, lambda c, i: F.struct(F.coalesce(F.array_max(F.transform(observed, lambda o: price_band(c, o, bands))), F.lit(0.0)).alias("score"), (-i).alias("down"), c.alias("price")))
    best = F.array_max(scored)
    return F.struct(best["score"].alias("score"), (-best["down"]).alias("column"), best["price"].alias("price"))


def block(queries: DataFrame, catalog: DataFrame, limit: int | None = 20_000, reach: int = 2) -> DataFrame:
    """Candidate rows (q, row, block): a shared token of three letters counts 1 (2 from five on), a near price bucket 1.4.

    `queries` has q, text, price; `catalog` row, name, price. Both sides explode to keys and meet in equi-joins. A token's
    or a bucket's list of catalog rows, and a query's of candidates, is cut at `limit`, as the semantics ask; None keeps all.
    """
    cut = lambda t: t if limit is None else t.withColumn("place", in_list).where(F.col("place") <= limit).drop("place")
    words = lambda x: F.explode(F.filter(text.content_tokens(x), lambda t: F.length(t) >= 3))
    in_list = F.row_number().over(Window.partitionBy("key").orderBy("row"))
    listed = cut(catalog.select("row", words(F.col("name")).alias("key")))
    by_word = queries.select("q", words(F.col("text")).alias("key")).join(listed, "key").select("q", "row", F.when(F.length("key") >= 5, 2.0).otherwise(1.0).alias("w"))
    near = F.explode(F.sequence(F.rint("price").cast("long") - reach, F.rint("price").cast("long") + reach))
    priced = cut(catalog.where("price is not null").select("row", F.rint("price").cast("long").alias("key")))
    by_price = queries.where("price is not null").select("q", near.alias("key")).join(priced, "key").select("q", "row", F.lit(1.4).alias("w"))
    sums = by_word.union(by_price).groupBy("q", "row").agg(F.sum(F.col("w").cast("decimal(18,2)")).alias("block"))
    if limit is None:
        return sums.select("q", "row", F.col("block").cast("double").alias("block"))
    place = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("block"), "row"))
    return sums.withColumn("place", place).where(F.col("place") <= limit).select("q", "row", F.col("block").cast("double").alias("block"))


#: Token pairs that a worker remembers; beyond this it starts afresh.
MOST_PAIRS = 500_000


def _distance(a: str, b: str) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
    return row[-1]


def _worth(t: str, n: str) -> float:
    """What a query's token is worth against a name's: `text.fuzzy_cover` of one pair."""
    short, long = sorted((len(t), len(n)))
    if long - short > max(3, int(0.55 * long)):
        return 0.0
    if len(t) >= 3 and (t in n or n in t):
        return min(0.96, 0.72 + 0.04 * short)
    return 1 - _distance(t, n) / long


def _covers(q: pd.Series, n: pd.Series) -> pd.DataFrame:
    """`text.fuzzy_cover` of token lists, a batch at a time. Tokens of a corpus repeat, so each pair is compared once."""
    known: dict[tuple[str, str], float] = {}
    out = []
    for tokens, names in zip(q, n, strict=True):
        whole = hit = 0.0
        hits, names = 0, [] if names is None else names.tolist()
        for t in () if tokens is None else tokens:
            weight = 1.25 if len(t) >= 5 else 1.0
            whole += weight
            best = 1.0 if t in names else 0.0
            for x in names if not best else ():
                worth = known.get((t, x))
                if worth is None:
                    if len(known) >= MOST_PAIRS:
                        known.clear()
                    worth = known[t, x] = _worth(t, x)
                best = max(best, worth)
            if best >= FUZZY:
                hit += weight * best
                hits += 1
        out.append((hit / whole if whole else 0.0, hits))
    return pd.DataFrame(out, columns=["share", "hits"])


def _once(x: Column) -> Column:
    """A column that is worked out once a row: the (always true) condition keeps the optimiser from writing it into filters and projections above."""
    return F.when(F.rand(0) >= 0, x)


def match(queries: DataFrame, catalog: DataFrame, top: int = 8, price_only: int = 5, least_text: float = 0.26) -> DataFrame:
    """The best catalog rows of each query: q, row, place, kind (text or price), score, text_score, price_score.

    Text hits come first, by .78 text + .22 price; rows without one follow if their price agrees, at most `price_only`.
    """
    tokens = lambda x, mark: (text.content_tokens(F.col(x)).alias(f"{mark}_tokens"), text.normal_start(F.col(x)).alias(f"{mark}_norm"))
    met = block(queries, catalog).join(queries.select("q", *tokens("text", "q"), F.col("price").alias("q_price")), "q").join(catalog.select("row", *tokens("name", "c"), F.col("price").alias("c_price")), "row")
    # tokens come from both sides of the join, and what is used more than once has a column of its own
    met = met.withColumn("fuzzy", _once(F.pandas_udf(_covers, "share double, hits int")(F.col("q_tokens"), F.col("c_tokens"))))
    t = text.similarity_of(F.col("q_tokens"), F.col("c_tokens"), F.col("q_norm"), F.col("c_norm"), F.col("fuzzy"))
    met = met.withColumn("text_score", _once(t)).withColumn("price_score", F.coalesce(price_band(F.col("c_price"), F.col("q_price")), F.lit(0.0)))
    is_text = F.col("text_score") >= least_text
    score = F.when(is_text, 0.78 * F.col("text_score") + 0.22 * F.col("price_score")).otherwise(F.least(F.lit(1.0), 0.22 + 0.60 * F.col("price_score") + 0.18 * F.col("text_score")))
    kept = met.where(is_text | (F.col("price_score") >= 0.98)).withColumns({"kind": F.when(is_text, "text").otherwise("price"), "score": F.round(score, 6)})
    within = F.row_number().over(Window.partitionBy("q", "kind").orderBy(F.desc("score"), "row"))
    kept = kept.withColumn("n", within).where((F.col("kind") == "text") | (F.col("n") <= price_only))
    place = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("kind"), "n"))
    return kept.withColumn("place", place).where(F.col("place") <= top).select("q", "row", "place", "kind", "score", F.round("text_score", 6).alias("text_score"), "price_score")


def match_all(queries: DataFrame, catalog: DataFrame, top: int = 8, least_text: float = 0.30) -> DataFrame:
    """The second preset, without blocking: the (small, checked) catalog goes to every query: .82 text + .18 price."""
    if catalog.count() > 200_000:
        raise ValueError("a catalog of over 200,000 rows is matched with `match`")
    met = queries.select("q", F.col("text").alias("q_text"), F.col("price").alias("q_price")).join(F.broadcast(catalog.select("row", "name", F.col("price").alias("c_price"))))
    t, p = text.similarity_loose(F.col("q_text"), F.col("name")), price_band(F.col("c_price"), F.col("q_price"), LOOSE_BANDS)
    met = met.withColumns({"text_score": t, "score": F.round(0.82 * t + 0.18 * F.coalesce(p, F.lit(0.0)), 6)}).where(F.col("text_score") >= least_text)
    place = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "row"))
    return met.withColumn("place", place).where(F.col("place") <= top).select("q", "row", "place", "score", F.round("text_score", 6).alias("text_score"))


def same_family(a: Column, b: Column, least_name: float = 0.72, least_price: float = 0.92) -> Column:
    """Whether two candidates (structs with item_id, name, brand, price_score) are one product or sizes of it."""
    share = text.overlap(a["name"], b["name"])
    return (a["item_id"] == b["item_id"]) | ((a["price_score"] >= least_price) & (b["price_score"] >= least_price) & ((share >= least_name) | ((share >= 0.62) & (a["brand"] == b["brand"]))))


def decide(first: Column, second: Column, weak_query: Column, stockout: Column, has_catalog: Column | None = None, soft: tuple = (0.90, 0.42), strong: float = 0.48, floor: float = 0.56, close: float = 0.04) -> Column:
    """The status of a label's best two candidates (structs with score, text_score, price_score, kind, and family's fields)."""
    t, p = first["text_score"], first["price_score"]
    family = F.coalesce(same_family(first, second), F.lit(False))
    tied = second.isNotNull() & (first["score"] - second["score"] < close)
    return (
        F.when(F.lit(False) if has_catalog is None else ~has_catalog, "catalog_unavailable").when(stockout, "stockout_service_tag").when(weak_query, "query_too_weak").when(first.isNull(), "not_found").when(first["kind"] == "price", "price_only_candidates")
        .when(tied & ~family, "ambiguous").when((p >= soft[0]) & (t >= soft[1]), "matched").when((t >= strong) & (family | (t >= floor)), "matched").otherwise("weak_match")
    )


def corrected_price(main: Column, catalog: Column, observed: Column, tolerance: float = 0.015) -> Column:
    """struct<price, conflict>: the catalog's price replaces the main one if that is missing or an observed price is near."""
    near = F.exists(observed, lambda o: F.abs(catalog - o) / F.greatest(F.lit(1.0), F.abs(catalog), F.abs(o)) <= tolerance)
    take = main.isNull() | F.coalesce(near, F.lit(False))
    return F.struct(F.when(catalog.isNotNull() & take, catalog).otherwise(main).alias("price"), (catalog.isNotNull() & ~take & (F.abs(catalog - main) > 0.005)).alias("conflict"))


def valid_choice(item_id: Column, candidates: Column, least: float = 0.56) -> Column:
    """Whether a chosen item is among the candidates with a score high enough."""
    return F.exists(candidates, lambda c: (c["item_id"] == item_id) & (c["score"] >= least))

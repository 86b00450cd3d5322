"""Approximate nearest neighbours by a forest of hash prefixes.

Each tree gives every vector a long string of bits (sides of random hyperplanes); the strings of a tree form one sorted
array, dealt out in ranges. A query descends in every tree to its longest-prefix matches, which are neighbours in that
array, and all trees ascend together, a bit at a time, until they hold enough candidates between them. Candidates are
scored exactly where they lie: a query goes to every range that its prefix reaches into. How many are enough is measured: a bounded sample of queries is answered by brute force,
and the smallest number that finds RECALL of their neighbours is taken.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tagloom.llm import base

#: Trees, bits of a string, recall aimed at, queries it is measured on, rows of a range.
TREES, BITS, RECALL, SAMPLE, RANGE_ROWS = 8, 32, 0.96, 200, 100_000


def _planes(dim: int, seed: int = 17) -> np.ndarray:
    return np.random.default_rng(seed).normal(size=(dim + 1, TREES * BITS)).astype(np.float32)


def strings(x: np.ndarray, planes: np.ndarray, extra: np.ndarray) -> np.ndarray:
    """(rows, TREES) bit strings with the tree's number above them. `extra` is the coordinate that makes all norms equal."""
    side = (np.concatenate((x, extra[:, None]), 1).astype(np.float32) @ planes > 0).reshape(len(x), TREES, BITS)
    keys = np.zeros((len(x), TREES), np.int64)
    for b in range(BITS):
        keys = keys << 1 | side[:, :, b]
    return keys | np.arange(TREES, dtype=np.int64) << BITS


def crossing(starts: np.ndarray) -> np.ndarray:
    """Codes of the prefixes that hold rows of more than one range; `starts` are the first keys of all ranges."""
    inner = starts[starts & ((1 << BITS) - 1) > 0]
    levels = np.arange(BITS + 1, dtype=np.int64)[:, None]
    low = inner >> levels << levels
    return np.unique(_code(low, levels)[low < inner])


def _code(low: np.ndarray, level: np.ndarray | int) -> np.ndarray:
    """A number for the prefix whose smallest key is `low` and that leaves `level` bits open."""
    return low | np.int64(level) << np.int64(BITS + 16)


def _matrix(column: pa.Array) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 1))


def valid(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id, vec) of the vectors that take part: of the commonest length, all components finite, not all zero."""
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("vec"))
    rows = rows.where("id is not null and size(vec) > 0 and forall(vec, x -> x is not null and not isnan(x) and abs(x) < double('Infinity')) and exists(vec, x -> x <> 0)")
    dim = rows.groupBy(F.size("vec").alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()
    return rows.where(F.size("vec") == (dim[0].d if dim else 0)).withColumn("dim", F.lit(dim[0].d if dim else 0))


def best(rows: DataFrame, k: int, by: str) -> DataFrame:
    """The k best (score, then smaller id) rows of each `by`; Spark keeps k of each before it shuffles."""
    w = Window.partitionBy(by).orderBy(F.desc("score"), "id")
    return rows.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def exact(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products row by row: a pair's score is the same whichever rows it is worked out with."""
    return (a * b).sum(1)


def _scored(keys: np.ndarray, sample: np.ndarray, ids: np.ndarray, x: np.ndarray, k: int) -> pa.RecordBatch:
    s = x @ sample.T
    top = np.argsort(-s, 0, kind="stable")[:k]
    who = np.tile(np.arange(len(sample)), len(top))
    return pa.RecordBatch.from_arrays([pa.array(keys[who]), pa.array(ids[top.ravel()]), pa.array(s[top.ravel(), who])], names=["q", "id", "score"])


def search(df: DataFrame, is_query: str, k: int = 20, id_col: str = "vec_id", vec_col: str = "embedding", recall: float = RECALL) -> DataFrame:
    """The k nearest by inner product of each row where the SQL condition `is_query` on `id` holds, among all other rows.

    Returns query_id, rank (from 1), vec_id, score (double precision, on the vectors as given), nearest first, ties to the
    smaller id, all candidates if there are fewer than k. Vectors that are null, zero, of an odd length, or hold null or
    non-finite components take no part; nor do rows without an id. Equal vectors are searched once: of each set of equal
    ones the k + 1 smallest ids stand for all. Rows that repeat id and vector count once. Other columns are left behind.
    """
    spark = df.sparkSession
    rows = valid(df, id_col, vec_col).distinct()
    head = rows.select("dim").limit(1).collect()
    dim = head[0].dim if head else 1
    # equal vectors: the k + 1 smallest ids of each
    ranked = rows.withColumn("place", F.row_number().over(Window.partitionBy("vec").orderBy("id"))).where(F.col("place") <= k + 1)
    points = base.materialise(ranked.groupBy("vec").agg(F.array_sort(F.collect_list("id")).alias("ids")).select(F.element_at("ids", 1).alias("id"), "vec", "ids").withColumn("norm", F.expr("aggregate(vec, double(0), (a, x) -> a + x * x)")))
    asked = base.materialise(rows.where(is_query).withColumnRenamed("id", "query_id").join(points.select("vec", F.col("id").alias("q")), "vec").select("query_id", "q"))
    probes = points.join(asked.select(F.col("q").alias("id")).distinct(), "id", "left_semi").select("id", "vec", "norm")
    top = points.agg(F.max("norm"), F.count("*")).first()
    longest, n_points = float(top[0] or 1.0), int(top[1])
    planes = spark.sparkContext.broadcast(_planes(dim))

    def hashed(query: bool):
        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                x, norm = _matrix(batch.column(1)), batch.column(2).to_numpy(zero_copy_only=False)
                if query:
                    x, extra = x / np.sqrt(norm)[:, None], np.zeros(len(x))
                else:
                    x, extra = x / np.sqrt(longest), np.sqrt(np.maximum(0, 1 - norm / longest))
                for t, keys in enumerate(strings(x, planes.value, extra).T):
                    yield pa.RecordBatch.from_arrays([pa.array(keys), batch.column(0), pa.array(np.full(len(x), query)), batch.column(1)], names=["key", "id", "asks", "vec"])

        return work

    shape = "key long, id long, asks boolean, vec array<double>"
    # by the table's size alone: each range gives every query that reaches it k + 1 rows, so more ranges are more rows
    n_ranges = TREES * max(1, -(-n_points // RANGE_ROWS))
    # first keys of the ranges: those of the trees, and between them quantiles of about 50 keys a range
    some = points.where(F.pmod(F.xxhash64("id", F.lit(9)), F.lit(max(1, n_points * TREES // (n_ranges * 50)))) == 0)
    drawn_keys = np.sort(some.select("id", "vec", "norm").mapInArrow(hashed(False), shape).select("key").toArrow()["key"].to_numpy())
    first = np.arange(TREES, dtype=np.int64) << BITS
    trees = np.split(drawn_keys, np.searchsorted(drawn_keys, first[1:]))
    starts = np.unique(np.concatenate([first, *[t[np.arange(1, n_ranges // TREES) * len(t) // (n_ranges // TREES)] for t in trees if len(t)]]))
    ends = np.append(starts[1:], np.int64(TREES) << BITS)
    across = crossing(starts)

    def part(key: np.ndarray) -> np.ndarray:
        return (np.searchsorted(starts, key, "right") - 1).astype(np.int32)

    def shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """How many vectors are below the prefixes that ranges share."""
        level = across >> np.int64(BITS + 16)
        low = across & ((1 << (BITS + 16)) - 1)
        total = np.zeros(len(across), np.int64)
        for batch in hashed(False)(batches):
            keys = np.sort(batch.column(0).to_numpy())
            total += np.searchsorted(keys, low + (np.int64(1) << level)) - np.searchsorted(keys, low)
        yield pa.RecordBatch.from_arrays([pa.array(np.flatnonzero(total)), pa.array(total[total > 0])], names=["prefix", "n"])

    below = np.zeros(len(across), np.int64)
    if len(across):
        for at, n in points.select("id", "vec", "norm").mapInArrow(shared, "prefix long, n long").groupBy("prefix").agg(F.sum("n")).collect():
            below[at] = n

    def ranges(t: DataFrame):
        return t.repartition(n_ranges, "part").groupBy("part")

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.append_column("part", pa.array(part(batch.column(0).to_numpy())))

    def forest(queries: DataFrame) -> DataFrame:
        every = points.select("id", "vec", "norm").mapInArrow(hashed(False), shape)
        every = every.union(queries.select("id", "vec", "norm").mapInArrow(hashed(True), shape))
        return every.select("key", "id", "asks").mapInArrow(dealt, "key long, id long, asks boolean, part int")

    def held(table: pa.Table) -> tuple[pa.Table, np.ndarray, np.ndarray, np.ndarray]:
        table = table.take(pa.array(np.lexsort((table["id"].to_numpy(), table["key"].to_numpy()))))
        return table, table["key"].to_numpy(), table["id"].to_numpy(), table["asks"].to_numpy()

    def count(got: pa.Table) -> pa.Table:
        """For each query how many vectors share all but the last s bits, s from 0 to BITS, in all ranges."""
        at = got["part"][0].as_py()
        _, keys, ids, asks = held(got)
        data, mine = keys[~asks], keys[asks]
        levels = []
        for s in range(BITS + 1):
            low = mine >> s << s
            n = np.searchsorted(data, low + (1 << s)) - np.searchsorted(data, low)
            out = (low < starts[at]) | (low + (1 << s) > ends[at])
            n[out] = below[np.searchsorted(across, _code(low[out], s))]
            levels.append(pa.array(n))
        return pa.table([pa.array(ids[asks]), *levels], names=["q", *[f"n{s}" for s in range(BITS + 1)]])

    names = [f"n{s}" for s in range(BITS + 1)]
    counts = ranges(forest(probes)).applyInArrow(count, "q long, " + ", ".join(f"{c} long" for c in names))
    counts = base.materialise(counts.groupBy("q").agg(*[F.sum(c).alias(c) for c in names]))

    # how many candidates are enough
    drawn = probes.orderBy(F.xxhash64("id", F.lit(5)), "id").limit(SAMPLE).toPandas()
    enough = 0
    if len(drawn):
        sample, keys = np.stack(drawn["vec"]), drawn["id"].to_numpy()

        def brute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                x = _matrix(batch.column(1))
                if len(x):
                    yield _scored(keys, sample, batch.column(0).to_numpy(), x, k + 1)

        truth = best(points.select("id", "vec").mapInArrow(brute, "q long, id long, score double").where("q <> id"), k, "q")
        truth = truth.join(points.select("id", "vec", "norm"), "id").select("q", "vec", "norm").toPandas()
        levels = counts.join(F.broadcast(spark.createDataFrame([(int(i),) for i in keys], "q long")), "q").toPandas().set_index("q")[names].loc[keys].to_numpy()
        if len(truth):
            norm = truth["norm"].to_numpy()
            found = strings(np.stack(truth["vec"]) / np.sqrt(longest), planes.value, np.sqrt(np.maximum(0, 1 - norm / longest)))
            own = strings(sample / np.sqrt(drawn["norm"].to_numpy())[:, None], planes.value, np.zeros(len(sample)))
            at = np.searchsorted(np.sort(keys), truth["q"].to_numpy())
            at = np.argsort(keys)[at]
            differ = (found ^ own[at]).min(1)
            needs = np.where(differ > 0, np.floor(np.log2(np.maximum(differ, 1))).astype(int) + 1, 0)
            enough = TREES * k
            while enough < TREES * max(n_points, 1):
                level = np.argmax(np.concatenate((levels >= enough, np.ones((len(levels), 1), bool)), 1), 1)
                if (needs <= level[at]).mean() >= recall:
                    break
                enough = int(enough * 1.15) + 1
    level = F.lit(BITS)
    for s in range(BITS - 1, -1, -1):
        level = F.when(F.col(f"n{s}") >= enough, s).otherwise(level)
    depth = counts.select(F.col("q").alias("id"), level.cast("int").alias("level"))

    def gather(got: pa.Table) -> pa.Table:
        table, keys, ids, asks = held(got)
        x, data, own = _matrix(table["vec"].filter(pa.array(~asks))), keys[~asks], ids[~asks]
        mine, who, q = keys[asks], ids[asks], _matrix(table["vec"].filter(pa.array(asks)))
        shift = table["level"].to_numpy(zero_copy_only=False)[asks].astype(np.int64)
        if not len(mine) or not len(data):
            return none
        low = mine >> shift << shift
        lo, hi = np.searchsorted(data, low), np.searchsorted(data, low + (np.int64(1) << shift))
        out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        order = np.lexsort((hi, lo))
        cut = np.flatnonzero(np.concatenate(([True], (lo[order][1:] != lo[order][:-1]) | (hi[order][1:] != hi[order][:-1]), [True])))
        for a, b in zip(cut[:-1], cut[1:], strict=True):  # queries that see the same range
            lot, begin, end = order[a:b], lo[order[a]], hi[order[a]]
            for part in range(0, len(lot) if end > begin else 0, 64):
                some = lot[part : part + 64]
                s = q[some] @ x[begin:end].T
                m = min(k + 1, end - begin)
                if m < end - begin:  # all that tie with the last one stay in, so that ties go by id
                    least = -np.partition(-s, m - 1, 1)[:, m - 1 : m]
                    r, c = np.nonzero(s >= least - 1e-9 * np.abs(least))
                else:
                    r, c = (x.ravel() for x in np.indices(s.shape))
                out.append((who[some][r], own[begin:end][c], exact(q[some][r], x[begin:end][c])))
        return pa.table([pa.array(np.concatenate([o[i] for o in out])) for i in range(3)], names=["q", "id", "score"]) if out else none

    none = pa.table({"q": pa.array([], pa.int64()), "id": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
    planted = _with_level(points, probes.join(depth, "id"), hashed, part)
    near = ranges(planted).applyInArrow(gather, "q long, id long, score double")
    near = best(near.distinct(), k + 1, "q").select("q", "id", "score")
    # back to all ids of equal vectors, and to all queries that share a vector
    spelled = near.join(points.select("id", "ids"), "id").select("q", F.explode("ids").alias("id"), "score")
    spelled = best(spelled, k + 1, "q").select("q", "id", "score")
    final = asked.join(spelled, "q").where("query_id <> id").select("query_id", "id", "score")
    return best(final, k, "query_id").select("query_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("vec_id"), "score")


def _with_level(points: DataFrame, probes: DataFrame, hashed, part) -> DataFrame:
    """The forest's rows with their vectors and ranges; queries carry the level they ascend to, and are in all ranges it reaches."""
    shape = "key long, id long, asks boolean, vec array<double>, level int, part int"

    def plain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in hashed(False)(batches):
            yield batch.append_column("level", pa.array(np.zeros(batch.num_rows, np.int32))).append_column("part", pa.array(part(batch.column(0).to_numpy())))

    def asking(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            level = batch.column(3).to_numpy().astype(np.int64)
            for made in hashed(True)(iter([batch])):
                low = made.column(0).to_numpy() >> level << level
                begin, end = part(low), part(low + (np.int64(1) << level) - 1)
                for j in range(int((end - begin).max()) + 1 if len(low) else 0):
                    some = pa.array(np.flatnonzero(begin + j <= end))
                    yield made.append_column("level", batch.column(3)).append_column("part", pa.array(begin + np.int32(j))).take(some)

    return points.select("id", "vec", "norm").mapInArrow(plain, shape).union(probes.select("id", "vec", "norm", "level").mapInArrow(asking, shape))

"""Work on pairs of rows that share a key: scores of all pairs, and the nearest vectors of each row.

The number of pairs grows with the square of a key's rows, so whatever depends on one row, or on its value only, is
worked out before the pairs are made; a key with many rows is cut into chunks, whose pairs are tasks of their own.
"""

from __future__ import annotations

from collections.abc import Callable
from decimal import ROUND_HALF_UP, Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tagloom.operators import votes

#: Rows of a key for which there is one chunk: of all pairs, and of vectors. Rows that are multiplied at once.
PAIR_CHUNK, VECTOR_CHUNK, QUERY_BLOCK, BLOCK = 1024, 8192, 1024, 512
#: Decimals of a cosine; keys (cosines in units of the last decimal) of pairs without a number, of null vectors, and of no pair.
DECIMALS = 9
UNIT = 10**DECIMALS
NAN, NULL, NONE = 4 * UNIT, -4 * UNIT, -(1 << 62)


def _chunked(df: DataFrame, keys: list[str], id_col: str, rows: int) -> DataFrame:
    """Rows with all keys and an id, each with `chunks`, the number of its key's chunks, and `chunk`, its own (equal ids share one)."""
    whole = df.dropna(subset=[*keys, id_col])
    sizes = whole.groupBy(*keys).agg(F.ceil(F.count("*") / rows).cast("int").alias("chunks"))
    return whole.join(sizes, keys).withColumn("chunk", F.pmod(F.xxhash64(id_col), "chunks").cast("int"))


def scored(df: DataFrame, keys: list[str], id_col: str, value: str, score: Callable[[Column, Column], Column], b_null: float | None = None) -> DataFrame:
    """(a, b, score): all pairs of rows that share the keys, a < b. The (symmetric) score is worked out once for each two distinct values.

    A null value is a value too; `b_null` is the score where b's alone is null.
    Rows of one value and chunk are one unit, with an array of their ids; units meet, and their ids are paired last.
    """
    units = _chunked(df, keys, id_col, PAIR_CHUNK).groupBy(*keys, "chunks", "chunk", value).agg(F.collect_list(id_col).alias("ids"))
    one = units.select(*keys, F.struct(F.col(value).alias("value"), "chunk").alias("u"), F.col("ids").alias("x"), F.col("chunk").alias("part"))
    two = units.select(*keys, F.struct(F.col(value).alias("value"), "chunk").alias("v"), F.col("ids").alias("y"), F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("part"))
    met = one.repartition(*keys, "part").join(two.repartition(*keys, "part"), [*keys, "part"]).where("u <= v")
    met = met.select((F.col("u") == F.col("v")).alias("same"), "x", "y", score(F.col("u.value"), F.col("v.value")).alias("score"), (F.col("u.value").isNull() & F.col("v.value").isNotNull()).alias("lone"))
    each = met.select("same", "y", "score", "lone", F.explode("x").alias("x")).select("same", "x", "score", "lone", F.explode("y").alias("y")).where("x < y or (x > y and not same)")
    turned = F.col("lone") & (F.col("x") > F.col("y"))  # nulls sort first, so that only u's can meet a filled one
    return each.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"), F.when(turned, F.lit(b_null)).otherwise(F.col("score")).alias("score"))


def nearest(df: DataFrame, key: str, id_col: str, vector: str, k: int) -> DataFrame:
    """(a, place, b, score): each row's k others of largest cosine, to DECIMALS decimals, among rows of its key; ties go to the smaller id.

    Exact: products of whole chunks leave out only what can't be among the k, the rest is worked out in double precision,
    term by term. A cosine with a vector of no length or of no finite length is NaN, which is largest; a null vector (or one with a null),
    or vectors of different lengths, give null, which is last.
    """
    rows = _chunked(df.select(F.col(key).alias("key"), F.col(id_col).alias("id"), F.col(vector).cast("array<double>").alias("v")), ["key"], "id", VECTOR_CHUNK)
    dealt = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    dealt = dealt.select("key", F.least("chunk", "other").alias("lo"), F.greatest("chunk", "other").alias("hi"), "chunk", "id", "v")

    def work(tile: pa.Table) -> pa.Table:
        chunk, lo, hi = tile["chunk"].to_numpy(), tile["lo"][0].as_py(), tile["hi"][0].as_py()
        sides = [_Vectors(tile.filter(pa.array(chunk == c))) for c in sorted({lo, hi})]
        if lo < hi and len(sides[1].ids) * len(sides[0].ids) == 0:
            found = []
        else:
            found = [_search(sides[0], sides[0], k, True)] if lo == hi else [_search(sides[0], sides[1], k, False), _search(sides[1], sides[0], k, False)]
        a, b, score = (np.concatenate([np.zeros(0, t), *[f[i] for f in found]]) for i, t in enumerate((np.int64, np.int64, np.int64)))
        number = np.where(score == NAN, np.nan, score / UNIT)
        return pa.table({"a": pa.array(a), "b": pa.array(b), "score": pa.array(number, mask=score == NULL, from_pandas=False)})

    found = dealt.groupBy("key", "lo", "hi").applyInArrow(work, "a long, b long, score double")
    return votes.top_rows(found, ["a"], F.col("score"), "b", k).select("a", "place", "b", "score")


class _Vectors:
    """The vectors of a chunk by id: values by dimension, lengths, and rows of length 1."""

    def __init__(self, rows: pa.Table):
        rows = rows.sort_by("id").combine_chunks()
        self.ids = rows["id"].to_numpy().astype(np.int64)
        lists = rows["v"].combine_chunks()
        size = np.array(lists.value_lengths().fill_null(0))
        flat = lists.flatten()
        at = np.repeat(np.arange(len(size)), size), np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)
        self.by_dim = np.zeros((int(size.max(initial=0)), len(size)))
        self.by_dim[at[1], at[0]] = flat.fill_null(0.0).to_numpy(zero_copy_only=False)
        self.size, self.null = size, np.array(lists.is_null())
        if flat.null_count:
            self.null = self.null | (np.bincount(at[0], np.array(flat.is_null()), len(size)) > 0)
        with np.errstate(all="ignore"):
            square = np.zeros(len(size))
            for x in self.by_dim:
                square += x * x
            self.norm = np.sqrt(square)
            self.odd = ~((self.norm > 0) & (self.norm < np.inf))
            self.unit = np.where(self.odd, 0.0, self.by_dim / self.norm)

    def pad(self, dims: int) -> np.ndarray:
        return np.vstack((self.unit, np.zeros((dims - len(self.unit), len(self.ids)))))


def _search(a: _Vectors, b: _Vectors, k: int, same: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids of a, ids of b, keys: of each of a's vectors the k best of b's, other ids only."""
    dims, out = max(len(a.by_dim), len(b.by_dim)), []
    ours, theirs = np.ascontiguousarray(a.pad(dims).T), b.pad(dims)
    odd, mixed = bool(a.odd.any() or b.odd.any()), bool(len(set(a.size) | set(b.size)) > 1 or a.null.any() or b.null.any())
    left, right = np.searchsorted(b.ids, a.ids, "left"), np.searchsorted(b.ids, a.ids, "right")
    most = int((right - left).max(initial=0)) if same else 0

    for q0 in range(0, len(a.ids), QUERY_BLOCK):
        q1 = min(len(a.ids), q0 + QUERY_BLOCK)
        best, who = np.full((q1 - q0, k), NONE, np.int64), np.zeros((q1 - q0, k), np.int64)
        for c0 in range(0, len(b.ids), BLOCK):  # by rising id, so that a tie with what is held changes nothing
            c1 = min(len(b.ids), c0 + BLOCK)
            near = ours[q0:q1] @ theirs[:, c0:c1]
            if odd:
                near[a.odd[q0:q1, None] | b.odd[None, c0:c1]] = NAN / UNIT
            if mixed:
                near[(a.size[q0:q1, None] != b.size[None, c0:c1]) | a.null[q0:q1, None] | b.null[None, c0:c1]] = NULL / UNIT
            for r in range(most):
                own = left[q0:q1] + r
                hit = np.flatnonzero((own < right[q0:q1]) & (own >= c0) & (own < c1))
                near[hit, own[hit] - c0] = -np.inf
            least = np.where(best[:, -1] > NONE, (best[:, -1] + 0.5) / UNIT - 1e-12, -10.0)
            if c0 == 0 and c1 > k:
                least = np.maximum(least, np.partition(near, c1 - k, 1)[:, c1 - k] - 1.5 / UNIT)
            q, c = np.nonzero(near >= least[:, None])
            if len(q):
                _merge(best, who, q, _exact(a, b, q0 + q, c0 + c, near[q, c]), b.ids[c0 + c])
        q, place = np.nonzero(best > NONE)
        out.append((a.ids[q0 + q], who[q, place], best[q, place]))
    return tuple(np.concatenate([o[i] for o in out]) if out else np.zeros(0, np.int64) for i in range(3))


def _exact(a: _Vectors, b: _Vectors, q: np.ndarray, c: np.ndarray, near: np.ndarray) -> np.ndarray:
    """Keys of pairs: cosines summed term by term, rounded half up as decimals."""
    total = np.zeros(len(q))
    with np.errstate(all="ignore"):
        for x, y in zip(a.by_dim, b.by_dim, strict=False):
            total += x[q] * y[c]
        cosine = total / (a.norm[q] * b.norm[c])
        special = np.abs(near) > 2
        cosine[special] = 0.0
        size = np.abs(cosine) * UNIT
        key = np.floor(size + 0.5)
        for i in np.flatnonzero(np.abs(size - np.floor(size) - 0.5) < 1e-5):
            key[i] = int(Decimal(repr(float(abs(cosine[i])))).scaleb(DECIMALS).quantize(Decimal(1), ROUND_HALF_UP))
    return np.where(special, np.where(near > 0, NAN, NULL), (np.sign(cosine) * key).astype(np.int64))


def _merge(best: np.ndarray, who: np.ndarray, q: np.ndarray, key: np.ndarray, ids: np.ndarray) -> None:
    """Put new pairs among the best of their rows."""
    k, rows = best.shape[1], np.unique(q)
    q, key, ids = np.concatenate((np.repeat(rows, k), q)), np.concatenate((best[rows].ravel(), key)), np.concatenate((who[rows].ravel(), ids))
    order = np.lexsort((ids, -key, q))
    q, key, ids = q[order], key[order], ids[order]
    place = np.arange(len(q)) - np.searchsorted(q, q, "left")
    kept = place < k
    best[q[kept], place[kept]], who[q[kept], place[kept]] = key[kept], ids[kept]

"""Near duplicates by MinHash with tensored banding, and connected components.

Two small collections of keys are made for each text, each key from a few minhashes. Every pair of a key of the first
and a key of the second collection is a table key, so m + m keys give m * m tables. Texts that share a table key are
candidates.

A bucket of n texts doesn't become n * n pairs. Each member is compared with the bucket's first text (a star). Once
components are known, only members that aren't in their first text's component are left over; these are compared,
in blocks, with the star's members of other components. So two texts that share a bucket end up compared, or in one
component already.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tagloom.llm import base

#: Keys in each of the two collections, and minhashes in each key. A link of similarity 0.8 is missed with a chance of 7e-5.
KEYS, DEPTH = 10, 2
#: Left-over members, and members they are compared with, in a block, and about how many bytes of text of each.
BLOCK_LEFT, BLOCK_ALL, BLOCK_BYTES = 256, 1024, 1 << 23

_SEEDS = np.random.default_rng(99).integers(1, 1 << 63, 2 * KEYS * DEPTH, dtype=np.uint64) | np.uint64(1)


def shingles(words: base.Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes of `size`-word shingles, sorted within each text, and the first of each text (texts + 1).

    A text of fewer words has its whole sequence as its one shingle; a text without words has none.
    """
    h = words.hashes()
    full = base.mix(base.windows(h, size)) if len(h) >= size else np.zeros(0, np.uint64)
    whole = base.inside(words, size)
    doc, got = words.doc[: len(full)][whole], full[whole]
    few = np.flatnonzero((words.count > 0) & (words.count < size))
    if len(few):
        rest = []
        for k in few:
            own = h[words.first[k] : words.first[k + 1]]
            rest.append(base.mix(base.windows(own, len(own)) + np.uint64(len(own)))[0])
        doc, got = np.concatenate((doc, few)), np.concatenate((got, np.array(rest, np.uint64)))
    order = np.lexsort((got, doc))
    doc, got = doc[order], got[order]
    if len(got):
        new = np.concatenate(([True], (doc[1:] != doc[:-1]) | (got[1:] != got[:-1])))
        doc, got = doc[new], got[new]
    return got, np.searchsorted(doc, np.arange(len(words.count) + 1))


def sketch(got: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each text with shingles: 2 * KEYS keys, and two hashes of the whole set."""
    start = first[:-1][np.diff(first) > 0]
    if not len(start):
        return np.zeros((0, 2 * KEYS), np.uint64), np.zeros((0, 2), np.uint64)
    low = [np.minimum.reduceat(got * seed ^ (got >> np.uint64(31)), start) for seed in _SEEDS]
    keys = []
    for k in range(2 * KEYS):
        h = np.full(len(start), k + 1, np.uint64)
        for d in range(DEPTH):
            h = base.mix(h * np.uint64(base.STEP) + low[k * DEPTH + d])
        keys.append(h)
    one, two = np.add.reduceat(base.mix(got), start), np.bitwise_xor.reduceat(base.mix(got + np.uint64(77)), start)
    return np.stack(keys, 1), np.stack((one, two), 1)


def sketches(df: DataFrame, size: int) -> DataFrame:
    """(id, n, u, v, one, two) of a table (id, text); u, v, one, two are null for a text without words."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, raw = base.text_buffer(batch.column(1))
            for i, j in base.chunks(at):
                got, first = shingles(base.Words(at[i : j + 1], raw, lower=True), size)
                n = np.diff(first)
                keys, pair = sketch(got, first)
                none = n == 0
                place = np.cumsum(~none) - 1
                cuts = pa.array(np.append((place + none) * KEYS, len(keys) * KEYS).astype(np.int32), mask=np.append(none, False))
                lists = [pa.ListArray.from_arrays(cuts, pa.array(base.signed(np.ascontiguousarray(keys[:, a : a + KEYS]).ravel()))) for a in (0, KEYS)]
                ends = [pa.array(base.signed(pair[place, c]) if len(pair) else np.zeros(len(n), np.int64), mask=none) for c in (0, 1)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), pa.array(n.astype(np.int64)), *lists, *ends], names=["id", "n", "u", "v", "one", "two"])

    return df.mapInArrow(work, "id long, n long, u array<long>, v array<long>, one long, two long")


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """100 * intersection >= percent * union, of sorted sets."""
    if min(len(a), len(b)) * 100 < percent * max(len(a), len(b)):
        return False
    both = np.concatenate((a, b))
    both.sort()
    same = int((both[1:] == both[:-1]).sum())
    return 100 * same >= percent * (len(a) + len(b) - same)


def _sets(texts: list[str], size: int) -> list[np.ndarray]:
    at, raw = base.text_buffer(pa.array(texts, pa.large_string()))
    out = []
    for i, j in base.chunks(at):
        got, first = shingles(base.Words(at[i : j + 1], raw, lower=True), size)
        out += [got[first[k] : first[k + 1]] for k in range(j - i)]
    return out


def verify(pairs: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """Of pairs (a, b), those whose full sets are similar enough. `texts` is (id, text)."""
    one = texts.select(F.col("id").alias("b"), F.col("text").alias("b_text")).hint("merge")
    two = texts.select(F.col("id").alias("a"), F.col("text").alias("a_text")).hint("merge")
    both = pairs.join(one, "b").join(two, "a").select("a", "b", "a_text", "b_text")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, kept = None, None
        for batch in batches:
            a, b = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for start in range(0, len(a), 256):
                part = slice(start, start + 256)
                second = _sets(batch.column(3)[part].to_pylist(), size)
                stay = []
                for k, x in enumerate(a[part]):
                    if x != held:
                        held, kept = x, _sets([batch.column(2)[start + k].as_py()], size)[0]
                    stay.append(similar(kept, second[k], percent))
                yield pa.RecordBatch.from_arrays([pa.array(a[part], pa.int64()), pa.array(b[part], pa.int64()), pa.array(stay)], names=["a", "b", "linked"])

    return both.mapInArrow(work, "a long, b long, linked boolean")


def components(edges: DataFrame) -> DataFrame:
    """(id, component): the smallest id that each id of `edges` (a, b) reaches, by alternating large and small stars.

    Every round is written to the shared folder; a round's only results on the driver are a count and a checksum.
    """
    mark = lambda e: e.agg(F.count("*"), F.sum(F.xxhash64("a", "b") % 1_000_000_007)).first()
    edges = base.materialise(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct())
    before = None
    while (now := mark(edges)) != before:
        before = now
        # large stars: neighbours above a node go to its smallest neighbour, itself included
        ways = edges.union(edges.select("b", "a"))
        least = ways.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        edges = ways.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        # small stars: a node and its neighbours below go to the smallest of them
        least = edges.groupBy("a").agg(F.min("b").alias("m"))
        met = edges.join(least, "a")
        edges = base.materialise(met.select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").union(met.select("a", F.col("m").alias("b"))).distinct())
    return edges.select(F.col("a").alias("id"), F.col("b").alias("component")).union(edges.select("b", "b").distinct())


def _left_over(stars: DataFrame, comp: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """Links (a, b) between components that meet in a star but weren't compared with each other. `stars` is (a, b)."""
    named = stars.join(comp.select(F.col("id").alias("b"), F.col("component").alias("b_in")), "b", "left").join(comp.select(F.col("id").alias("a"), F.col("component").alias("a_in")), "a", "left")
    members = named.select(F.col("a").alias("star"), F.coalesce("a_in", "a").alias("home"), F.col("b").alias("id"), F.coalesce("b_in", "b").alias("component"))
    members = members.withColumn("left", F.col("home") != F.col("component"))
    lengths = texts.groupBy("id").agg(F.sum(F.octet_length("text").cast("long")).alias("size"))
    of_left = lambda x: F.sum(F.when(F.col("left"), x).otherwise(0))
    busy = members.groupBy("star").agg(of_left(F.lit(1)).alias("n_left"), F.count("*").alias("n")).where("n_left > 0 and n > 1")
    members = base.materialise(members.join(busy.select("star"), "star").join(lengths.hint("merge"), "id"))
    sizes = members.groupBy("star").agg(of_left(F.lit(1)).alias("n_left"), F.count("*").alias("n"), of_left(F.col("size")).alias("b_left"), F.sum("size").alias("b"))
    cells = lambda n, most, size: F.ceil(F.greatest(F.col(n) / most, F.col(size) / BLOCK_BYTES))
    sizes = sizes.select("star", cells("n_left", BLOCK_LEFT, "b_left").alias("lefts"), cells("n", BLOCK_ALL, "b").alias("alls"))
    sizes = base.materialise(sizes)  # so that the join below is by itself, and Spark can split a large star
    members = base.materialise(members.join(sizes, "star").select("star", "id", "component", "left", "lefts", "alls"))
    every = members.withColumns({"block": F.pmod(F.xxhash64("id"), "alls"), "chunk": F.explode(F.sequence(F.lit(0).cast("long"), F.col("lefts") - 1))})
    left = members.where("left").withColumns({"chunk": F.pmod(F.xxhash64("id", F.lit(3)), "lefts"), "block": F.explode(F.sequence(F.lit(0).cast("long"), F.col("alls") - 1))})
    cells = ("star", "chunk", "block")  # renamed on one side: both come from one table
    with_text = lambda x, mark: x.join(texts, "id").select(*[F.col(c).alias(c + mark) for c in (*cells, "id", "component", "text")]).groupBy(*[c + mark for c in cells])
    both = with_text(left, ""), with_text(every, "_2")

    def work(left: pd.DataFrame, every: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(left) and len(every):
            sets = _sets(list(left["text"]), size)
            sizes, comps, ids = np.array([len(s) for s in sets]), left["component"].to_numpy(), left["id"].to_numpy()
            tokens, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), sizes)
            order = np.argsort(tokens, kind="stable")
            tokens, owner = tokens[order], owner[order]
            for x, c, own in zip(every["id_2"], every["component_2"], _sets(list(every["text_2"]), size), strict=True):
                lo, hi = np.searchsorted(tokens, own, "left"), np.searchsorted(tokens, own, "right")
                n = hi - lo
                at = np.repeat(lo - np.cumsum(n) + n, n) + np.arange(n.sum())
                same = np.bincount(owner[at], minlength=len(sets))
                for k in np.flatnonzero((100 * same >= percent * (sizes + len(own) - same)) & (comps != c)):
                    out.append((ids[k], x, comps[k], c))
        frame = pd.DataFrame(out, columns=["a", "b", "one", "two"], dtype="int64")
        return frame.drop_duplicates(["one", "two"])[["a", "b"]]

    left, every = both
    return left.cogroup(every).applyInPandas(work, "a long, b long")


def groups(df: DataFrame, size: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Connected components of near duplicates: id_col, n_shingles, component_id, kept (the component's smallest id).

    A text's set is that of its distinct `size`-word shingles, A-Z lower-cased. Two texts are linked where
    100 * intersection >= percent * union; links are confirmed on full sets. A text without words is linked with nothing,
    a null one likewise. One row for each row of `df`; rows that repeat an id are one document if their texts agree. A row
    without an id can't be in a component and is left out. Other columns are left behind.
    """
    docs = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).where(F.col("id").isNotNull())
    made = base.materialise(sketches(docs, size))
    sets = made.where("n > 0")
    classes = sets.groupBy("one", "two", "n").agg(F.min("id").alias("rep"))
    firsts = sets.join(classes.select("rep").distinct().withColumnRenamed("rep", "id"), "id", "left_semi").dropDuplicates(["id", "one", "two"])
    keys = firsts.select("id", F.explode(F.expr("flatten(transform(u, x -> transform(v, y -> xxhash64(x, y))))")).alias("key"))
    # a bucket's first text is its centre; the sorted stream holds no bucket in memory
    first = F.first("id").over(Window.partitionBy("key").orderBy("id").rowsBetween(Window.unboundedPreceding, 0))
    stars = base.materialise(keys.withColumn("a", first).where("a <> id").select("a", F.col("id").alias("b")).distinct())
    involved = stars.select(F.col("a").alias("id")).union(stars.select("b")).distinct()
    # texts always meet ids by a shuffle: a plan that broadcasts while there are few ids would change with size
    texts = base.materialise(docs.join(involved.hint("merge"), "id", "left_semi"))
    linked = base.materialise(verify(stars, texts, size, percent).where("linked").select("a", "b").distinct())
    comp = components(linked)
    more = base.materialise(_left_over(stars, comp, texts, size, percent))
    if not more.isEmpty():
        comp = components(linked.union(more))
    named = classes.join(comp.select(F.col("id").alias("rep"), "component"), "rep", "left").select("one", "two", "n", F.coalesce("component", "rep").alias("component"))
    back = made.select("id", "n", "one", "two").join(named, ["one", "two", "n"], "left").select("id", "n", F.coalesce("component", "id").alias("component"))
    return back.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"), (F.col("id") == F.col("component")).alias("kept"))

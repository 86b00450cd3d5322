"""Repeated passages by level-wise doubling.

A window of 2n words can only repeat if the windows of n words in it do. So the corpus is asked about short windows
first, and only windows that hold a repeated short one are extended to twice that length and asked about again, until
the wanted length is reached or no candidate survives.

Not every window of a level is asked about: of the short windows in each window of the wanted length, the one of
smallest hash stands for it. Equal windows choose equal ones, so no repeat is lost; of the windows of 5 words about one in
eight travels, of those of 10 one in six at most.

Before anything is shuffled, a task settles what it can from its own texts: of equal windows in one chunk of texts only
the first travels, and of those that it remembers from earlier chunks none but the first two. A window that a third of
all documents share is thus about two rows for each task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tagloom.llm import base

#: Bytes of text among which a task settles repeats by itself.
CHUNK_BYTES = 1 << 20
#: Bits of the number of windows that a task remembers from chunk to chunk; of two that meet in a place the later one is kept.
SLOT_BITS = 18


def _slot(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(64 - SLOT_BITS)).astype(np.int64)


def levels(length: int, least: int = 5) -> list[int]:
    """Window lengths: the wanted one, halved while it stays even and at least `least`; smallest first."""
    out = [length]
    while out[0] % 2 == 0 and out[0] // 2 >= least:
        out.insert(0, out[0] // 2)
    return out


def _leaders(h: np.ndarray, span: int) -> np.ndarray:
    """Of every `span` consecutive hashes, the place of the smallest (the first such)."""
    n = len(h) - span + 1
    best, at = h.copy(), np.arange(len(h))
    width = 1
    while width < span:
        step = min(width, span - width)
        m = len(best) - step
        later = best[step:] < best[:m]
        best = np.where(later, best[step:], best[:m])
        at = np.where(later, at[step:], at[:m])
        width += step
    return at[:n]


def _leading(words: base.Words, length: int, short: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the short windows, which windows of `length` lie in one text, and the place of each one's leader."""
    plain = words.hashes()
    h = base.mix(base.windows(plain, short))
    whole = base.inside(words, length)
    return h, whole, _leaders(h, length - short + 1) if len(whole) else np.zeros(0, int)


def _survive(words: base.Words, place: np.ndarray, hashes: np.ndarray, lists: pa.Array, i: int, j: int) -> np.ndarray:
    """Which of the leaders at `place` are among the repeated ones of their text."""
    cuts, flat = lists.offsets.to_numpy(), lists.values.to_numpy(zero_copy_only=False)
    known = flat[cuts[i] : cuts[j]].view(np.uint64)
    of = np.repeat(np.arange(j - i), np.diff(cuts[i : j + 1]))
    tag = lambda doc, x: base.mix(x + doc.astype(np.uint64) * np.uint64(base.STEP))
    return np.isin(tag(words.doc[place], hashes[place]), tag(of, known))


def shared_leaders(docs: DataFrame, length: int, short: int, before: int = 0) -> DataFrame:
    """(id, hs): of each text, the leaders (windows of `short` words) that occur elsewhere too or twice in it.

    With `before`, `docs` has the repeated leaders of that length as `hs`; windows of `length` words whose leader of that
    length isn't among them are left out. Of the rows that a chunk of texts has settled, only the first asks on behalf of
    the others; of those that a task has settled, the first of two chunks.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, times = np.zeros(1 << SLOT_BITS, np.uint64), np.zeros(1 << SLOT_BITS, np.int8)
        for batch in batches:
            at, raw = base.text_buffer(batch.column(1))
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for i, j in base.chunks(at, CHUNK_BYTES):
                words = base.Words(at[i : j + 1], raw)
                h, whole, lead = _leading(words, length, short)
                if before and len(whole):
                    lower, _, leads = _leading(words, length, before)
                    whole = whole & _survive(words, leads, lower, batch.column(2), i, j)
                lead = np.unique(lead[whole])
                doc, h = words.doc[lead], h[lead]
                order = np.lexsort((doc, h))
                doc, h = doc[order], h[order]
                none = np.zeros(len(h), bool)
                new = np.concatenate(([True], h[1:] != h[:-1])) if len(h) else none
                alone = new & np.append(new[1:], True) if len(h) else none
                sure, at_slot = ~alone, _slot(h[new])
                often = np.where(asked[at_slot] == h[new], times[at_slot], 0)
                asked[at_slot], times[at_slot] = h[new], np.minimum(often + 1, 2)
                sure[new] |= often >= 2
                asks = new.copy()
                asks[new] = often < 2
                fresh = new | np.concatenate(([True], doc[1:] != doc[:-1])) if len(h) else none  # one row for each text and hash
                yield pa.RecordBatch.from_arrays([pa.array(ids[i:j][doc[fresh]]), pa.array(base.signed(h[fresh])), pa.array(asks[fresh]), pa.array(sure[fresh])], names=["id", "h", "asks", "sure"])

    rows = docs.select("id", "text", *(["hs"] if before else [])).mapInArrow(work, "id long, h long, asks boolean, sure boolean")
    rows = rows.withColumn("key", F.when(F.col("asks"), F.col("h")).otherwise(F.xxhash64("id")))
    w = Window.partitionBy("key", "asks").orderBy("id")
    rows = rows.withColumns({"one": F.lag("h").over(w), "other": F.lead("h").over(w)})
    return rows.where("sure or not asks or one is not null or other is not null").groupBy("id").agg(F.collect_set("h").alias("hs"))


def later_windows(docs: DataFrame, length: int, short: int) -> DataFrame:
    """(id, start, size): runs of windows that start earlier too, as starts `start` to `start + size - 1`. `docs` has id, text, hs."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, first_id, first_start = (np.zeros(1 << SLOT_BITS, x) for x in (np.uint64, np.int64, np.int64))
        for batch in batches:
            at, raw = base.text_buffer(batch.column(1))
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for i, j in base.chunks(at, CHUNK_BYTES):
                words = base.Words(at[i : j + 1], raw)
                h, whole, lead = _leading(words, length, short)
                live = whole & _survive(words, lead, h, batch.column(2), i, j) if len(whole) else whole
                place = np.flatnonzero(live)
                plain = base.windows(words.hashes(), length)[place]
                doc = words.doc[place]
                start = place - words.first[doc]
                key = base.mix(plain)
                order = np.lexsort((start, ids[i:j][doc], key))
                doc, start, key = doc[order], start[order], key[order]
                if len(key):
                    new = np.concatenate(([True], key[1:] != key[:-1]))
                    head = np.flatnonzero(new)[np.cumsum(new) - 1]
                    own = ids[i:j][doc]
                    late = (own != own[head]) | (start != start[head])
                    # what an earlier chunk of this task has asked about
                    at_slot, my_id, my_start = _slot(key[new]), own[new], start[new]
                    known = asked[at_slot] == key[new]
                    after = known & ((first_id[at_slot] < my_id) | ((first_id[at_slot] == my_id) & (first_start[at_slot] < my_start)))
                    late[np.flatnonzero(new)[after]] = True
                    new[np.flatnonzero(new)[after]] = False
                    at_slot, my_id, my_start = at_slot[~after], my_id[~after], my_start[~after]
                    asked[at_slot], first_id[at_slot], first_start[at_slot] = key[new], my_id, my_start
                else:
                    new = late = np.zeros(0, bool)
                yield pa.RecordBatch.from_arrays([pa.array(ids[i:j][doc[new]]), pa.array(base.signed(key[new])), pa.array(start[new]), pa.array(np.ones(int(new.sum()), np.int64)), pa.array(np.zeros(int(new.sum()), bool))], names=["id", "h", "start", "size", "sure"])
                back = np.lexsort((start[late], doc[late]))
                d, s = doc[late][back], start[late][back]
                if len(d):
                    begin = np.concatenate(([True], (d[1:] != d[:-1]) | (s[1:] > s[:-1] + 1)))
                    head = np.flatnonzero(begin)
                    stop = s[np.append(head[1:], len(s)) - 1]
                    yield pa.RecordBatch.from_arrays([pa.array(ids[i:j][d[head]]), pa.array(base.signed(base.mix(d[head].astype(np.uint64) * np.uint64(base.STEP) + s[head].astype(np.uint64)))), pa.array(s[head]), pa.array(stop - s[head] + 1), pa.array(np.ones(len(head), bool))], names=["id", "h", "start", "size", "sure"])

    rows = docs.select("id", "text", "hs").mapInArrow(work, "id long, h long, start long, size long, sure boolean")
    w = Window.partitionBy("h", "sure").orderBy("id", "start")
    return rows.withColumn("place", F.rank().over(w)).where(F.col("sure") | (F.col("place") > 1)).select("id", "start", "size")


def dedup(df: DataFrame, length: int = 20, least: int = 5, id_col: str = "doc_id", text_col: str = "text", keep_text: bool = True) -> DataFrame:
    """Remove each word covered by a window of `length` words whose sequence also starts earlier.

    Earlier means in a row of smaller id or earlier in the same text; windows are judged on the input. Words are runs of
    bytes other than space and 0x09-0x0D. Returns id_col, n_words, n_removed, kept_sha256 (of the kept words joined by one
    space), kept (that text, unless keep_text is false), one row for each row of `df`. A null or empty text has no words.
    Rows that repeat an id count as one text where their words agree. A row without an id has no place in the order and
    is left out. Other columns are left behind. Sequences are told apart by 64-bit hashes.
    """
    docs = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).where(F.col("id").isNotNull())
    tiers = levels(length, least)
    tiers = tiers if len(tiers) > 1 else [length, length]
    dealt = docs.repartition("id")
    known = shared_leaders(docs.where("text is not null"), length, tiers[0])
    for before, short in zip(tiers[:-2], tiers[1:-1], strict=True):
        known = shared_leaders(dealt.join(known, "id"), length, short, before)
    late = later_windows(dealt.join(known, "id"), length, tiers[-2])
    runs = late.groupBy("id").agg(F.collect_list(F.struct("start", "size")).alias("runs"))
    joined = dealt.join(runs, "id", "left").select("id", "text", F.expr("transform(runs, r -> r.start)").alias("starts"), F.expr("transform(runs, r -> r.size)").alias("sizes"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, raw = base.text_buffer(batch.column(1))
            starts, sizes = batch.column(2), batch.column(3)
            n, gone, sha, kept = [], [], [], []
            for i, j in base.chunks(at):
                words = base.Words(at[i : j + 1], raw)
                data = words.raw.tobytes()
                for k in range(i, j):
                    a, b = words.first[k - i], words.first[k - i + 1]
                    stay = np.ones(b - a, bool)
                    if starts[k].is_valid and b > a:
                        s = np.asarray(starts[k].values)
                        edge = np.zeros(b - a + 1, np.int64)
                        np.add.at(edge, s, 1)
                        np.add.at(edge, np.minimum(s + np.asarray(sizes[k].values) + length - 1, b - a), -1)
                        stay = np.cumsum(edge)[:-1] == 0
                    text = b" ".join([data[x:y] for x, y in zip(words.start[a:b][stay].tolist(), words.end[a:b][stay].tolist(), strict=True)])
                    n.append(b - a)
                    gone.append(int((~stay).sum()))
                    sha.append(hashlib.sha256(text).hexdigest())
                    kept.append(text.decode("utf-8"))
            columns = [batch.column(0), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(sha, pa.string()), *([pa.array(kept, pa.string())] if keep_text else [])]
            yield pa.RecordBatch.from_arrays(columns, names=[id_col, "n_words", "n_removed", "kept_sha256", *(["kept"] if keep_text else [])])

    return joined.mapInArrow(work, f"`{id_col}` long, n_words long, n_removed long, kept_sha256 string{', kept string' if keep_text else ''}")

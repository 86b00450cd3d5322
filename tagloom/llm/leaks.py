"""Benchmark decontamination by latent semantic retrieval.

Benchmark items are cut into passages, weighted by TF-IDF (passage frequencies over the whole corpus), and a randomised
SVD, whose products with the passage matrix are summed across partitions, gives their latent space. A large benchmark is
searched in parts, each with a space of its own in which every passage keeps a stated share of its norm. Windows of
several lengths over every document are projected into it; where the cosine to an item's passage is high, the text around is compared with the
whole item by longest common subsequence of words, and what is left in between is settled by the item's answer.
"""

from __future__ import annotations

import functools
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from tagloom.llm import base

#: Buckets of words, latent dimensions, extra random directions, power iterations.
BUCKETS, RANK, OVERSAMPLE, POWER = 1 << 15, 128, 16, 2
#: Words of half a passage (a passage is two halves in a row), cosine from which on a passage is a candidate (of what it keeps of its norm).
HALF, COSINE = 24, 0.25
#: Passages of a part, least share of its norm that a passage keeps in its part's space, parts that are searched in one go.
PART, KEPT, AT_ONCE = 256, 0.6, 16
#: Words from one window of a document to the next, and windows' lengths in such steps.
STEP, LENGTHS = 12, (2, 3, 4)
#: Share of an item's words in common order: from COPY on it is a leak; from PARAPHRASE on if ANSWER of its answer's rare words are there.
COPY, PARAPHRASE, ANSWER = 0.7, 0.5, 0.75
#: About how many passages the driver holds at a time (a larger benchmark is taken in slices, by item); a task holds AT_ONCE parts of PART passages.
MOST_PASSAGES = 100_000

_FOLD = base.LOWER.copy()
_FOLD[:128][[not chr(i).isalnum() for i in range(128)]] = 32


def _words(at: np.ndarray, raw: np.ndarray) -> tuple[base.Words, np.ndarray]:
    """Words of letters and digits, lower-cased, and their hashes."""
    lo = int(at[0])
    words = base.Words(at - lo, _FOLD[raw[lo : int(at[-1])]])
    return words, words.hashes()


def _bucket(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(49)).astype(np.int64)


def _halves(words: base.Words) -> tuple[np.ndarray, np.ndarray]:
    """Number of the half passage that each word is in, and first half of each text (rows + 1)."""
    halves = -(-words.count // HALF)
    first = np.concatenate(([0], np.cumsum(halves)))
    return first[words.doc] + (np.arange(len(words.doc)) - words.first[words.doc]) // HALF, first


def frequencies(texts: DataFrame) -> np.ndarray:
    """In how many half passages each bucket occurs, and last their number, over all texts of a one-column table."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS + 1, np.int64)
        for batch in batches:
            at, raw = base.text_buffer(batch.column(0))
            for i, j in base.chunks(at):
                words, h = _words(at[i : j + 1], raw)
                half, first = _halves(words)
                seen = half * BUCKETS + _bucket(h)
                if first[-1] * BUCKETS < 1 << 31:
                    seen = seen.astype(np.int32)
                seen.sort()
                seen = seen[np.concatenate(([True], seen[1:] != seen[:-1]))] if len(seen) else seen
                total[:-1] += np.bincount(seen & (BUCKETS - 1), minlength=BUCKETS)
                total[-1] += first[-1]
        yield pa.RecordBatch.from_arrays([pa.array(np.flatnonzero(total).astype(np.int32)), pa.array(total[total > 0])], names=["bucket", "n"])

    got = texts.mapInArrow(work, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toPandas()
    total = np.zeros(BUCKETS + 1)
    total[got["bucket"].to_numpy()] = got["n"].to_numpy()
    return total


def weights(total: np.ndarray) -> np.ndarray:
    return np.log((total[-1] + 1) / (total[:-1] + 1)).astype(np.float32) + np.float32(0.01)


def _passages(text: str, idf: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """TF-IDF rows (buckets, values of length 1) of an item's passages: two halves each, or what there is."""
    words, h = _words(*base.text_buffer(pa.array([text])))
    bucket, out = _bucket(h), []
    for start in range(0, max(1, len(bucket) - HALF), HALF):
        at, n = np.unique(bucket[start : start + 2 * HALF], return_counts=True)
        value = n * idf[at]
        if len(at):
            out.append((at, value / np.sqrt(value @ value)))
    return out


def latent_space(items: DataFrame, idf: np.ndarray, rank: int = RANK, seed: int = 1, tasks: int = 8) -> np.ndarray:
    """Right singular vectors (buckets x rank) of the passages of a table (item, text), by randomised subspace iteration.

    Only buckets with words of the table have rows on the way. A task sends a (rank + OVERSAMPLE) sum for each of them at
    most, and there are few tasks, so the driver's share is bounded.
    """
    dealt = base.materialise(items.select("text").where("text is not null").repartition(tasks))
    width = rank + OVERSAMPLE

    def product(basis: tuple[np.ndarray, np.ndarray] | None, square: bool) -> tuple[np.ndarray, np.ndarray]:
        """Rows and values of A'(A basis), or with `square` of basis' A' A basis. Without a basis, of a random one."""
        width_ = basis[1].shape[1] if basis else width

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            place, own = np.arange(BUCKETS), basis[1] if basis else np.random.default_rng(seed).normal(size=(BUCKETS, width_)).astype(np.float32)
            if basis:
                place[basis[0]] = np.arange(len(own))
            total = np.zeros((width_ if square else len(own), width_), np.float32)
            for batch in batches:
                for text in batch.column(0).to_pylist():
                    for at, value in _passages(text, idf):
                        at = place[at]
                        y = value @ own[at]
                        if square:
                            total += np.outer(y, y)
                        else:
                            total[at] += np.outer(value, y)
            for row in np.flatnonzero(total.any(1)):
                yield pa.RecordBatch.from_arrays([pa.array([basis[0][row] if basis and not square else row], pa.int32()), pa.array([total[row].tobytes()], pa.binary())], names=["row", "x"])

        got = dealt.mapInArrow(work, "row int, x binary").toPandas()
        rows = np.arange(width_) if square else np.unique(got["row"].to_numpy())
        out = np.zeros((len(rows), width_))
        for at, x in zip(np.searchsorted(rows, got["row"].to_numpy()), got["x"], strict=True):
            out[at] += np.frombuffer(x, np.float32)
        return rows, out

    basis = None
    for _ in range(POWER):
        rows, sums = product(basis, False)
        basis = rows, np.linalg.qr(sums)[0].astype(np.float32)
    value, vector = np.linalg.eigh(product(basis, True)[1])
    keep = np.argsort(-value)[:rank]
    keep = keep[value[keep] > 1e-6 * max(value.max(initial=0), 1e-12)]
    space = np.zeros((BUCKETS, len(keep)), np.float32)
    space[basis[0]] = basis[1] @ vector[:, keep].astype(np.float32)
    return space


def common(a: list[bytes], b: list[bytes]) -> int:
    """Length of the longest common subsequence, a row of it at a time as the bits of a number."""
    places: dict[bytes, int] = {}
    for i, word in enumerate(a):
        places[word] = places.get(word, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for word in b:
        if (hit := places.get(word)) is not None:
            both = row & hit
            row = (row + both | row - both) & full
    return len(a) - row.bit_count()


class Benchmark:
    """Items of one part, ready to be compared with texts."""

    def __init__(self, rows: list[tuple], idf: np.ndarray, space: np.ndarray):
        self.ids, self.words, self.rare, rows_of, owner = [], [], [], [], []
        self.idf = idf
        for item, text, answer in rows:
            words, h = _words(*base.text_buffer(pa.array([text or ""])))
            data = words.raw.tobytes()
            got = [data[s:e] for s, e in zip(words.start, words.end, strict=True)]
            if not got:
                continue
            for at, value in _passages(text, idf):
                rows_of.append((at, value))
                owner.append(len(self.ids))
            self.ids.append(item)
            self.words.append(got)
            self.rare.append(self._rare(answer or text.strip().rpartition("\n")[2]))
        latent = np.array([value @ space[at] for at, value in rows_of], np.float32).reshape(len(owner), space.shape[1])
        self.kept = np.linalg.norm(latent, axis=1)
        self.latent = latent / np.maximum(self.kept[:, None], 1e-9)
        self.owner = np.array(owner, np.int64)
        # only words of the benchmark have a place in the space: its rows, and their numbers by bucket
        used = np.unique(np.concatenate([at for at, _ in rows_of])) if rows_of else np.zeros(0, np.int64)
        self.space = (space[used] * idf[used][:, None]).astype(np.float32)
        self.place = np.full(BUCKETS, -1, np.int32)
        self.place[used] = np.arange(len(used))

    def _rare(self, answer: str) -> set[bytes]:
        """The half of the answer's distinct words that are rarest in the corpus."""
        words, h = _words(*base.text_buffer(pa.array([answer])))
        data = words.raw.tobytes()
        ranked = sorted({(-float(self.idf[b]), data[s:e]) for b, s, e in zip(_bucket(h), words.start, words.end, strict=True)})
        return {w for _, w in ranked[: -(-len(ranked) // 2)]}

    def candidates(self, words: base.Words, h: np.ndarray, idf: np.ndarray) -> Iterator[tuple[int, int, int, float]]:
        """(row, item, first word of the window in its text, cosine), by row."""
        steps = -(-words.count // STEP)
        first = np.concatenate(([0], np.cumsum(steps)))
        step = first[words.doc] + (np.arange(len(words.doc)) - words.first[words.doc]) // STEP
        n, longest, bucket = int(first[-1]), max(LENGTHS), _bucket(h)
        size = np.bincount(step, idf[bucket] ** 2, n + longest)
        doc = np.concatenate((np.repeat(np.arange(len(steps)), steps), np.full(longest, -1)))
        place = self.place[bucket]
        there = np.flatnonzero(place >= 0)
        place, step = place[there], step[there]
        least = COSINE * self.kept
        for start in range(0, n, 1024):  # some steps more, for the windows that go on
            m = min(1024, n - start)
            a, b = np.searchsorted(step, (start, start + m + longest - 1))
            x = np.zeros((m + longest - 1, self.space.shape[1]), np.float32)
            if a < b:
                begin = np.flatnonzero(np.concatenate(([True], step[a + 1 : b] != step[a : b - 1])))
                x[step[a:b][begin] - start] = np.add.reduceat(self.space[place[a:b]], begin, 0)
            vector, norm2, found = x[:m].copy(), size[start : start + m].copy(), []
            for j in range(1, longest + 1):
                if j > 1:
                    same = doc[start + j - 1 : start + j - 1 + m] == doc[start : start + m]
                    other = np.flatnonzero(~same)
                    kept = vector[other]  # windows that would leave their text stay as they are
                    vector += x[j - 1 : j - 1 + m]
                    vector[other] = kept
                    norm2 += size[start + j - 1 : start + j - 1 + m] * same
                if j in LENGTHS:
                    norm = np.sqrt(np.maximum(norm2, 1e-9)).astype(np.float32)
                    near = np.flatnonzero(np.einsum("ij,ij->i", vector, vector) >= (least.min(initial=1) * (1 - 1e-5) * norm) ** 2)
                    cosine = vector[near] @ self.latent.T / norm[near][:, None]
                    r, c = np.nonzero(cosine >= least)
                    found.append((near[r], self.owner[c], cosine[r, c]))
            k, item, cosine = (np.concatenate([f[i] for f in found]) for i in range(3))
            order = np.lexsort((-cosine, item, k))  # of a window's lengths the best
            k, item, cosine = k[order], item[order], cosine[order]
            new = np.concatenate(([True], (k[1:] != k[:-1]) | (item[1:] != item[:-1]))) if len(k) else np.zeros(0, bool)
            at = start + k[new]
            yield from zip(doc[at].tolist(), item[new].tolist(), ((at - first[doc[at]]) * STEP).tolist(), cosine[new].tolist(), strict=True)

    def possible(self, item: int, there: set[bytes]) -> bool:
        """Whether enough of the item's words are there to be in common order."""
        own = self.words[item]
        return sum(w in there for w in own) >= PARAPHRASE * len(own)

    def compare(self, item: int, text: list[bytes], passage: int) -> tuple[float, bool]:
        """Share of the item in the text around a passage, and whether it is a leak."""
        own = self.words[item]
        around = text[max(0, passage - len(own)) : passage + 2 * HALF + len(own)]
        there = set(around)
        if not self.possible(item, there):
            return 0.0, False
        share = common(own, around) / len(own)
        if share >= COPY or share < PARAPHRASE:
            return share, share >= COPY
        return share, bool(self.rare[item]) and sum(w in there for w in self.rare[item]) >= ANSWER * len(self.rare[item])


def parts(rows: list[tuple], idf: np.ndarray) -> Iterator[list[tuple]]:
    """The items (item, text, answer) in lots of PART passages, or of one longer item."""
    lot, size = [], 0
    for row in rows:
        n = len(_passages(row[1] or "", idf))
        if lot and size + n > PART:
            yield lot
            lot, size = [], 0
        lot.append(row)
        size += n
    if lot:
        yield lot


def prepare(spark: SparkSession, rows: list[tuple], idf: np.ndarray) -> Benchmark:
    """A part with the smallest rank, in steps of RANK / 2, at which all its passages keep KEPT of their norm."""
    items, rank = spark.createDataFrame([(text,) for _, text, _ in rows], "text string"), RANK
    tasks = max(1, min(8, -(-sum(len(_passages(text or "", idf)) for _, text, _ in rows) // PART)))  # one, but for an item longer than a part
    while True:
        part = Benchmark(rows, idf, latent_space(items, idf, rank, tasks=tasks))
        if part.kept.min(initial=1) >= KEPT or rank >= len(part.owner):
            return part
        rank += RANK // 2


def find(df: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", answer_col: str | None = None) -> DataFrame:
    """Benchmark items that leak into documents: id_col, item_col, cosine, coverage, kind (copy or paraphrase).

    One row for each document row and item; coverage is the largest share of the item's words in common order with the
    text around a candidate passage, cosine that of the best candidate. The answer is `answer_col`, or else the item's
    last line. Null or wordless texts and items match nothing; repeated document rows each give their rows, repeated
    items count once by (id, text); null ids are carried along. Other columns are left behind. No text is shuffled.
    """
    spark = df.sparkSession
    answer = F.col(answer_col).cast("string") if answer_col else F.lit(None).cast("string")
    items = items.select(F.col(item_col).alias("item"), F.col(item_text).cast("string").alias("text"), answer.alias("answer")).distinct()
    size = items.agg(F.sum(F.length("text") / 2 / HALF + 1)).first()[0] or 0
    texts = df.select(F.col(text_col).cast("string").alias("text"))
    idf = weights(frequencies(texts))
    slices = int(-(-size // MOST_PASSAGES)) or 1
    kind, item_kind = dict(df.select(id_col).dtypes)[id_col], dict(items.dtypes)["item"]
    item_type = items.limit(0).toArrow().schema.field("item").type

    def search(shared):
        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                at, raw = base.text_buffer(batch.column(1))
                for i, j in base.chunks(at):
                    words, h = _words(at[i : j + 1], raw)
                    data = words.raw.tobytes()
                    for bench in shared.value:
                        best = {}
                        text_of: dict[int, list[bytes]] = {}
                        for doc, item, passage, cosine in bench.candidates(words, h, idf) if bench.ids else ():
                            if doc not in text_of:
                                a, b = words.first[doc], words.first[doc + 1]
                                text_of = {doc: [data[s:e] for s, e in zip(words.start[a:b].tolist(), words.end[a:b].tolist(), strict=True)]}
                                every, may = set(text_of[doc]), {}
                            if item not in may:  # what the whole text lacks, no passage of it has
                                may[item] = bench.possible(item, every)
                            if not may[item]:
                                continue
                            share, leak = bench.compare(item, text_of[doc], passage)
                            if leak:
                                old = best.get((doc, item), (0.0, 0.0))
                                best[doc, item] = max(old[0], cosine), max(old[1], share)
                        keys = sorted(best)
                        yield pa.RecordBatch.from_arrays(
                            [batch.column(0).take(pa.array([i + d for d, _ in keys], pa.int64())), pa.array([bench.ids[k] for _, k in keys], item_type), pa.array([best[k][0] for k in keys], pa.float64()), pa.array([best[k][1] for k in keys], pa.float64()), pa.array(["copy" if best[k][1] >= COPY else "paraphrase" for k in keys], pa.string())],
                            names=[id_col, item_col, "cosine", "coverage", "kind"],
                        )

        return df.select(F.col(id_col), F.col(text_col).cast("string")).mapInArrow(work, f"`{id_col}` {kind}, `{item_col}` {item_kind}, cosine double, coverage double, kind string")

    found = []
    for k in range(slices):
        some = items.where(F.pmod(F.xxhash64("item", "text"), F.lit(slices)) == k)
        lots = parts(sorted(some.toPandas().itertuples(index=False, name=None), key=repr), idf)
        while held := [prepare(spark, lot, idf) for lot in itertools.islice(lots, AT_ONCE)]:
            got = search(spark.sparkContext.broadcast(held))
            found.append(got if slices == 1 else base.materialise(got))  # so that one slice's items are held at a time
    return functools.reduce(DataFrame.union, found) if found else search(spark.sparkContext.broadcast([]))

"""Language identification by error-correcting output codes.

Each language has a codeword. For each bit a logistic classifier on hashed byte n-grams says which side a text is on;
the language whose codeword loses least, bits weighted by how well they did in training, is chosen. A text whose two
best codewords are about as near is flagged as ambiguous.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from tagloom.llm import base

#: Buckets of n-grams; bits of a codeword at least; rows of each language fitted on (expected number, rows chosen by the hash of their id).
BUCKETS, BITS, FIT_ROWS = 4096, 15, 1500
#: Rows of the sample that the fit takes in full precision at once.
BLOCK = 256
#: Most languages (ISO 639-3 has fewer codes), and about how many rows are fitted on in all (at least one a language), so that what the task that fits holds is bounded (8 KB a row).
MOST_LANGUAGES, MOST_ROWS = 10_000, 12_000
UNKNOWN, NAMES = "und", ("lang_pred", "score", "ambiguous")
#: Posterior distance of the two best languages below which a text is ambiguous.
AMBIGUOUS = 0.2

_FOLD = base.LOWER.copy()
_FOLD[:128][[not chr(i).isalpha() for i in range(128)]] = 32


def features(raw: np.ndarray) -> np.ndarray:
    """Unit vector of log counts of the hashed two- and three-byte n-grams of a text; digits, signs and white space count as one blank."""
    b = _FOLD[raw].astype(np.uint32)
    if len(b) > 1:
        keep = np.ones(len(b), bool)
        keep[1:] = (b[1:] != 32) | (b[:-1] != 32)
        b = b[keep]
    b = np.concatenate(([np.uint32(32)], b, [np.uint32(32)])).astype(np.uint32)
    two = (b[:-1] << np.uint32(8)) | b[1:]
    three = (two[:-1] << np.uint32(8)) | b[2:]
    grams = np.concatenate((two | np.uint32(1 << 25), three)) * np.uint32(0x9E3779B1) >> np.uint32(20)
    x = np.log1p(np.bincount(grams, minlength=BUCKETS).astype(np.float32))
    return x / max(float(np.sqrt(x @ x)), 1e-9)


def has_letter(raw: np.ndarray) -> bool:
    if (((raw | 32) >= 97) & ((raw | 32) <= 122)).any():
        return True
    return bool((raw >= 128).any()) and any(map(str.isalpha, raw.tobytes().decode("utf-8", "replace").replace("�", " ")))


def codewords(n: int, seed: int = 7) -> np.ndarray:
    """n words of -1 and 1: of some random tables without a constant column, that of the largest least distance."""
    rng, bits = np.random.default_rng(seed), max(BITS, int(np.ceil(10 * np.log2(max(n, 2)))))
    best, best_far = None, -1
    for _ in range(300):
        table = rng.choice(np.array([-1.0, 1.0]), (n, bits))
        if n > 1:
            flat = np.abs(table.sum(0)) == n
            table[0, flat] *= -1
        far = int(((bits - table @ table.T) / 2 + np.eye(n) * bits).min())
        if far > best_far:
            best, best_far = table, far
    return best


def train_bits(x: list[np.ndarray], y: np.ndarray, rounds: int = 150, rate: float = 20.0, decay: float = 1e-5) -> tuple[np.ndarray, np.ndarray]:
    """Logistic regression of every column of y (-1, 1) on the rows of the blocks x by accelerated gradient descent: weights, biases."""
    n = max(1, len(y))
    w, b = np.zeros((BUCKETS, y.shape[1]), np.float32), np.zeros(y.shape[1], np.float32)
    vw, vb = np.zeros_like(w), np.zeros_like(b)
    sides = np.split(y.astype(np.float32), np.cumsum([len(block) for block in x])[:-1])
    for step in range(rounds):
        go = step / (step + 3)
        aw, ab = w + go * vw, b + go * vb
        sum_w, sum_b = np.zeros_like(w), np.zeros_like(b)
        for block, side in zip(x, sides, strict=True):
            block = block.astype(np.float32)
            pull = side / (1 + np.exp(np.clip(side * (block @ aw + ab), -30, 30))) / n
            sum_w += block.T @ pull
            sum_b += pull.sum(0)
        nw, nb = aw + rate * (sum_w - decay * aw), ab + rate * 0.2 * sum_b
        vw, vb, w, b = nw - w, nb - b, nw, nb
    return w, b


class Model:
    """Classifiers of the codewords' bits, fitted on the rows of the blocks x (any float type), in the order of `labels`."""

    def __init__(self, langs: list[str], x: list[np.ndarray], labels: np.ndarray):
        self.langs = langs
        self.code = codewords(len(langs))
        y = self.code[labels]
        share = np.bincount(labels, minlength=len(langs)).astype(np.float32)
        self.w, self.b = train_bits(x, y)
        right = (np.concatenate([block.astype(np.float32) @ self.w + self.b for block in x]) * y > 0) / share[labels][:, None] / len(langs)
        self.weight = np.clip(2 * right.sum(0) - 1, 0.05, 1.0)

    def posterior(self, x: np.ndarray) -> np.ndarray:
        """Of each text, a share for each language: exp(-weighted loss), normalised."""
        f = x @ self.w + self.b
        f = np.clip(f, -30, 30)
        up, down = np.log1p(np.exp(-f)) * self.weight, np.log1p(np.exp(f)) * self.weight  # loss of each bit where the codeword has 1 and -1
        loss = up @ (self.code > 0).T + down @ (self.code < 0).T
        p = np.exp(loss.min(1, keepdims=True) - loss)
        return p / p.sum(1, keepdims=True)


def fit(train: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model | None:
    """Fit on whole texts of a bounded sample: of each language, FIT_ROWS rows are expected. None if no row has a language.

    The sample meets in one task, which fits; only the model reaches the driver.
    """
    rows = train.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    counts = {r[0]: r[1] for r in rows.groupBy(lang_col).count().orderBy(F.desc("count"), lang_col).limit(MOST_LANGUAGES + 1).collect()}
    if len(counts) > MOST_LANGUAGES:
        raise ValueError(f"{lang_col} has more than {MOST_LANGUAGES} values, so it doesn't hold languages")
    if not counts:
        return None
    each = max(1.0, min(FIT_ROWS, MOST_ROWS / len(counts)))
    share = F.create_map(*[x for k, n in counts.items() for x in (F.lit(k), F.lit(min(1.0, each / n)))])[F.col(lang_col)]
    drawn = F.pmod(F.xxhash64(F.col(id_col).cast("string"), F.lit(11)), F.lit(1 << 30)) < share * F.lit(float(1 << 30))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, raw = base.text_buffer(batch.column(0))
            made = [features(raw[at[i] : at[i + 1]]).astype(np.float16).tobytes() if has_letter(raw[at[i] : at[i + 1]]) else None for i in range(batch.num_rows)]
            yield pa.RecordBatch.from_arrays([batch.column(1), batch.column(2), pa.array(made, pa.binary())], names=["key", "lang", "x"])

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, x = [], []
        for batch in batches:
            found += batch.column(0).to_pylist()
            for at in range(0, batch.num_rows, BLOCK):  # held as it came, in half precision
                x.append(np.frombuffer(b"".join(batch.column(1)[at : at + BLOCK].to_pylist()), np.float16).reshape(-1, BUCKETS))
        if x:
            langs, labels = np.unique(np.array(found, object), return_inverse=True)
            yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(Model(langs.tolist(), x, labels))], pa.binary())], names=["model"])

    sample = rows.where(drawn).select(F.col(text_col), F.col(id_col).cast("string"), F.col(lang_col)).mapInArrow(work, "key string, lang string, x binary").where("x is not null")
    made = sample.repartition(1).sortWithinPartitions("lang", "key", "x").select("lang", "x").mapInArrow(learn, "model binary").collect()
    return pickle.loads(made[0][0]) if made else None


def predict(df: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The language of each text, from the text alone: id_col, lang_pred, score (share of the best language, 0 to 1), ambiguous.

    One row for each row of `df`, repeated rows and null ids included. A null text, one without a letter, or any text
    where there is no model: `und`, score 0, not ambiguous. Ties go to the language that sorts first. No shuffle. Other
    columns are left behind; `annotate` keeps them.
    """
    return _guess(df, model, text_col, [id_col], NAMES)


def annotate(df: DataFrame, model: Model | None, text_col: str = "text", names: tuple[str, ...] = NAMES) -> DataFrame:
    """`df` with three columns more, as `predict` has them, under `names`, which it must not have yet (`base.fresh` finds such)."""
    return _guess(df, model, text_col, df.columns, names)


def _guess(df: DataFrame, model: Model | None, text_col: str, keep: list[str], names: tuple[str, ...]) -> DataFrame:
    shared = df.sparkSession.sparkContext.broadcast(model)
    added = [T.StructField(name, kind) for name, kind in (("lang_", T.StringType()), ("score_", T.DoubleType()), ("unsure_", T.BooleanType()))]

    wide, place = len(keep), keep.index(text_col) if text_col in keep else len(keep)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            at, raw = base.text_buffer(batch.column(place))
            n = batch.num_rows
            lang, score, unsure = np.full(n, UNKNOWN, object), np.zeros(n), np.zeros(n, bool)
            for start in range(0, n if model else 0, 512):
                rows = [i for i in range(start, min(n, start + 512)) if has_letter(raw[at[i] : at[i + 1]])]
                if not rows:
                    continue
                p = model.posterior(np.stack([features(raw[at[i] : at[i + 1]]) for i in rows]))
                top = np.sort(p, 1)
                lang[rows] = np.array(model.langs, object)[p.argmax(1)]
                score[rows] = p.max(1)
                if p.shape[1] > 1:
                    unsure[rows] = top[:, -1] - top[:, -2] < AMBIGUOUS
            yield pa.RecordBatch.from_arrays([*batch.columns[:wide], pa.array(lang, pa.string()), pa.array(np.clip(score, 0, 1)), pa.array(unsure)], names=[*batch.schema.names[:wide], *(f.name for f in added)])

    # numbered on the way: mapInArrow can't take names with dots
    sent = list(dict.fromkeys([*keep, text_col]))
    rows = df.select(*base.quoted(sent)).toDF(*(f"c{i}" for i in range(len(sent))))
    return rows.mapInArrow(work, T.StructType([*rows.schema.fields[: len(keep)], *added])).toDF(*keep, *names)


def remainder(id_col: str, of: int) -> Column:
    """crc32 of the id as text, modulo `of`; a null id has none."""
    return F.crc32(F.col(id_col).cast("string")) % of

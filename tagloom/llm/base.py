"""What the text operators share: tables cut from their lineage, whole-batch word hashing, small numeric helpers.

Texts reach Python as Arrow batches. A batch's texts lie in one byte buffer, so words are found and hashed for
the whole buffer with numpy; no Python object is made for a word.
"""

from __future__ import annotations

import contextlib
import contextvars
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

#: Bytes that end a word: space and 0x09-0x0D.
BLANKS = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)
#: Bytes of text that are worked on at once; a longer document is a chunk of its own.
CHUNK_BYTES = 1 << 20

_rng = np.random.default_rng(20240607)
_BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = int(_rng.integers(1 << 61, 1 << 63, dtype=np.uint64)) | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
#: Multiplier of the hashes of word sequences.
STEP = int(_rng.integers(1 << 61, 1 << 63, dtype=np.uint64)) | 1
_BLANK = np.zeros(256, bool)
_BLANK[list(BLANKS)] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_powers: dict[int, np.ndarray] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir, which all executors see. Where it is unset: a local one in local mode (tests), else an error."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        held = spark.sparkContext._jsc.sc().getCheckpointDir()
        root = held.get() if held.isDefined() else None
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        root = tempfile.mkdtemp(prefix="tagloom-")
        spark.sparkContext.setCheckpointDir(root)
    return root


def small_batches(spark: SparkSession, rows: int = 500) -> None:
    """Let texts reach Python in batches of few rows, as one batch of Spark's usual size can hold gigabytes of long texts."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(name)) > rows:
        spark.conf.set(name, rows)


def materialise(df: DataFrame) -> DataFrame:
    """Write a table to the shared folder and read it again: later jobs neither recompute it nor need its executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/tagloom-{uuid.uuid4().hex}"
    if (made := _scratch.get()) is not None:
        made.append(path)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_scratch: contextvars.ContextVar[list[str] | None] = contextvars.ContextVar("scratch", default=None)


@contextlib.contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Delete on the way out what `materialise` wrote meanwhile; whatever reads it must have been written elsewhere by then."""
    made: list[str] = []
    token = _scratch.set(made)
    try:
        yield
    finally:
        _scratch.reset(token)
        for path in made:
            remove(spark, path)


def remove(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """The names, each with underscores behind it until `df` has no such column."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def quoted(names: list[str]) -> list[str]:
    """Column names that mean themselves, whatever signs they hold."""
    return ["`" + name.replace("`", "``") + "`" for name in names]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h = h ^ (h >> np.uint64(32))
    return h * np.uint64(0xD6E8FEB86659FD93) ^ (h >> np.uint64(29))


def _power(base: int, n: int) -> np.ndarray:
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = max(n, 1 << 16)
        have = np.full(size, base, np.uint64)
        have[0] = 1
        np.multiply.accumulate(have, out=have)
        if size <= 4 * CHUNK_BYTES:
            _powers[base] = have
    return have[:n]


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets (rows + 1) and bytes of a string column; a null text has no bytes."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return at, raw


def chunks(offsets: np.ndarray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows with at most `limit` bytes together, or one longer row."""
    n, start = len(offsets) - 1, 0
    while start < n:
        end = int(np.searchsorted(offsets, offsets[start] + limit, "right")) - 1
        end = min(max(end, start + 1), n)
        yield start, end
        start = end


class Words:
    """The words of some texts: `start` and `end` in `raw`, `doc` (row of each word), `first` (first word of each row, rows + 1)."""

    def __init__(self, offsets: np.ndarray, raw: np.ndarray, lower: bool = False):
        base = int(offsets[0])
        raw = raw[base : int(offsets[-1])]
        self.raw = LOWER[raw] if lower else raw
        at = offsets - base
        word = ~_BLANK[self.raw]
        begins = word.copy()
        begins[1:] &= ~word[:-1]
        ends = word.copy()
        ends[:-1] &= ~word[1:]
        inner = at[1:-1]
        inner = inner[(inner > 0) & (inner < len(raw))]
        begins[inner] = word[inner]
        ends[inner - 1] = word[inner - 1]
        self.start, self.end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
        self.first = np.searchsorted(self.start, at)
        self.count = np.diff(self.first)
        self.doc = np.repeat(np.arange(len(at) - 1), self.count)

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word's bytes."""
        n = len(self.raw)
        if not len(self.start):
            return np.zeros(0, np.uint64)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(_BYTE[self.raw] * _power(_BASE, n), out=sums[1:])
        return mix((sums[self.end] - sums[self.start]) * _power(_INVERSE, n)[self.start])


def widen(h: np.ndarray, n: int, more: np.ndarray, m: int) -> np.ndarray:
    """Hashes of n + m words from those of n words and, n words on, of m words; too short an end is left out."""
    return h[: max(0, len(more) - n)] * np.uint64(pow(STEP, m, 1 << 64)) + more[n:]


def windows(h: np.ndarray, n: int) -> np.ndarray:
    """Hashes of every n consecutive words (not yet mixed); windows may cross documents, which the caller leaves out."""
    out, have, part, size = None, 0, h, 1
    while True:
        if n & size:
            out, have = (part, size) if out is None else (widen(out, have, part, size), have + size)
        if have == n:
            return out[: max(0, len(h) - n + 1)]
        part, size = widen(part, size, part, size), 2 * size


def inside(words: Words, n: int) -> np.ndarray:
    """Which of the windows of n words lie in one document."""
    m = max(0, len(words.doc) - n + 1)
    return words.doc[:m] == words.doc[n - 1 :] if m else np.zeros(0, bool)


def signed(h: np.ndarray) -> np.ndarray:
    return h.astype(np.uint64).view(np.int64)

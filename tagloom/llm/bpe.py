"""Byte-level BPE by prefix dynamic programming.

Of every byte prefix of a piece exactly one vocabulary token can be the last token of its encoding. That token is
stored for each prefix. A prefix one byte longer needs only the tokens that end there and the stored tokens of
shorter prefixes, so appending bytes never changes what is stored, and an edit needs work only from the edit on.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tagloom.llm import base

#: Pieces and token pairs that a worker remembers; beyond this it starts afresh, so its memory is bounded.
KEPT_PIECES, KEPT_PAIRS = 250_000, 200_000
#: Bits of the number of pairs in the table that many pairs are looked up in; longest piece (bytes), and pieces, that are encoded together.
SLOT_BITS, LONG, LOT = 20, 48, 16_384
#: Largest vocabulary sent to the executors.
MOST_TOKENS = 1_000_000


def load_ranks(path: str) -> dict[bytes, int]:
    """The ranks in a file of lines `base64 rank`."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}


class PrefixEncoder:
    """Encodes pieces of bytes with a table of ranks that holds all single bytes."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.tokens = {v: k for k, v in ranks.items()}
        self.pairs: dict[tuple[int, int], bool] = {}
        self.longest = max(map(len, ranks))
        self.backward: dict = {}
        for token, rank in ranks.items():
            node = self.backward
            for byte in reversed(token):
                node = node.setdefault(byte, {})
            node[-1] = rank
        self._arrays()

    def _arrays(self) -> None:
        """The tree of reversed tokens as arrays: sorted (node, byte) keys with the node they lead to, and each node's token."""
        keys, child, token, nodes = [], [], [], [self.backward]
        for number, node in enumerate(nodes):  # grows while it is read
            token.append(node.get(-1, -1))
            for byte, below in node.items():
                if byte >= 0:
                    keys.append(number << 8 | byte)
                    child.append(len(nodes))
                    nodes.append(below)
        order = np.argsort(keys)
        self.keys, self.child, self.token = np.array(keys, np.int64)[order], np.array(child, np.int64)[order], np.array(token, np.int64)
        self.size = np.zeros(max(self.tokens) + 1, np.int64)
        for rank, token in self.tokens.items():
            self.size[rank] = len(token)
        self.whole = np.where(self.size == 1, 1, -1).astype(np.int8)  # whether BPE makes a token of its bytes; -1: not known yet
        self.slot_key, self.slot_fits = np.full(1 << SLOT_BITS, -1, np.int64), np.zeros(1 << SLOT_BITS, bool)

    def merge(self, piece: bytes) -> list[int]:
        """Plain BPE of a few bytes: always the merge of lowest rank, leftmost first."""
        parts = [piece[i : i + 1] for i in range(len(piece))]
        while len(parts) > 1:
            best, where = None, -1
            for i in range(len(parts) - 1):
                rank = self.ranks.get(parts[i] + parts[i + 1])
                if rank is not None and (best is None or rank < best):
                    best, where = rank, i
            if best is None:
                break
            parts[where : where + 2] = [parts[where] + parts[where + 1]]
        return [self.ranks[p] for p in parts]

    def fits(self, left: int, right: int) -> bool:
        """Whether BPE leaves these two tokens side by side."""
        known = self.pairs.get((left, right))
        if known is None:
            if len(self.pairs) >= KEPT_PAIRS:
                self.pairs.clear()
            known = self.pairs[left, right] = self.merge(self.tokens[left] + self.tokens[right]) == [left, right]
        return known

    def _fit(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """`fits` of many pairs; answers are remembered in a table of fixed size."""
        key = left << np.int64(32) | right
        slot = (base.mix(key.view(np.uint64)) >> np.uint64(64 - SLOT_BITS)).astype(np.int64)
        out = self.slot_fits[slot]
        new = np.flatnonzero(self.slot_key[slot] != key)
        if len(new):
            asked, back = np.unique(key[new], return_inverse=True)
            out[new] = np.array([self.fits(k >> 32, k & 0xFFFFFFFF) for k in asked.tolist()])[back]
            self.slot_key[slot[new]], self.slot_fits[slot[new]] = key[new], out[new]
            mixed = np.flatnonzero(self.slot_key[slot[new]] != key[new])  # two pairs met in a slot: the one whose key it holds must own the answer
            if len(mixed):
                self.slot_key[slot[new[mixed]]] = -1
        return out

    def encode_many(self, pieces: list[bytes]) -> tuple[list[int], list[int]]:
        """The tokens of all pieces in a row, and where each piece's begin (pieces + 1). All pieces grow by a byte at a time together."""
        n = len(pieces)
        length = np.fromiter(map(len, pieces), np.int64, n)
        order = np.argsort(-length, kind="stable")
        begin, data = (np.cumsum(length) - length)[order], np.frombuffer(b"".join(pieces), np.uint8).astype(np.int64)
        length = length[order]
        top = int(length[0]) if n else 0
        live = np.searchsorted(-length, -np.arange(top), "left")
        last = np.zeros((top, n), np.int64)
        for at in range(top):
            who, node, found = np.arange(live[at]), np.zeros(live[at], np.int64), []
            for back in range(min(at + 1, self.longest)):  # back through the tokens that end here
                key = node << 8 | data[begin[who] + (at - back)]
                place = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
                hit = self.keys[place] == key
                who, node = who[hit], self.child[place[hit]]
                if not len(who):
                    break
                token = self.token[node]
                ends = token >= 0
                found.append((back + 1, who[ends], token[ends]))
            waits = np.ones(live[at], bool)
            for size, who, token in reversed(found):
                left = waits[who]
                who, token = who[left], token[left]
                if not len(who):
                    continue
                if size <= at:
                    good = self._fit(last[at - size, who], token)
                else:
                    good = self.whole[token] == 1
                    if size > 1 and (new := np.unique(token[self.whole[token] < 0])).size:
                        self.whole[new] = [self._whole(t) for t in new.tolist()]
                        good = self.whole[token] == 1
                who = who[good]
                last[at, who] = token[good]
                waits[who] = False
        # read back from the ends
        parts, who, end = [], np.arange(n), length.copy()
        while len(who):
            token = last[end - 1, who]
            parts.append((who, token))
            end = end - self.size[token]
            who, end = who[end > 0], end[end > 0]
        owner = order[np.concatenate([w for w, _ in parts])] if parts else np.zeros(0, np.int64)
        step = np.concatenate([np.full(len(w), -k) for k, (w, _) in enumerate(parts)]) if parts else owner
        token = np.concatenate([t for _, t in parts]) if parts else owner
        flat = np.lexsort((step, owner))
        return token[flat].tolist(), np.searchsorted(owner[flat], np.arange(n + 1)).tolist()

    def extend(self, piece: bytes, last: list[tuple[int, int]], done: int, end: int | None = None) -> None:
        """Give `last`, which holds (length, token) of the first `done` prefixes, the others' (up to `end` bytes)."""
        del last[done:]
        pairs, fits, place, root = self.pairs, self.fits, last.append, self.backward
        for at in range(done, len(piece) if end is None else end):
            node, i, found = root, at, []
            while i >= 0:  # back through the tokens that end here
                node = node.get(piece[i])
                if node is None:
                    break
                token = node.get(-1)
                if token is not None:
                    found.append((at + 1 - i, token))
                i -= 1
            for size, token in reversed(found):
                if size <= at:
                    pair = (last[at - size][1], token)
                    known = pairs.get(pair)
                    if known if known is not None else fits(*pair):
                        place((size, token))
                        break
                elif size == 1 or self._whole(token):
                    place((size, token))
                    break

    def _whole(self, token: int) -> bool:
        known = self.pairs.get((token, -1))
        if known is None:
            known = self.pairs[token, -1] = self.merge(self.tokens[token]) == [token]
        return known

    @staticmethod
    def read(last: list[tuple[int, int]], end: int) -> list[int]:
        """The tokens of the prefix of `end` bytes."""
        out = []
        while end:
            size, token = last[end - 1]
            out.append(token)
            end -= size
        out.reverse()
        return out

    def encode_sorted(self, pieces: list[bytes]) -> Iterator[list[int]]:
        """The tokens of sorted pieces; what a piece shares with the one before it is not worked out again."""
        last: list[tuple[int, int]] = []
        before = b""
        for piece in pieces:
            same, most = 0, min(len(piece), len(before))
            while same < most and piece[same] == before[same]:
                same += 1
            token = self.ranks.get(piece)
            if token is not None and len(piece) <= self.longest:  # a piece that is a token is that token, as in tiktoken
                yield [token]
                continue
            self.extend(piece, last, same)
            before = piece
            yield self.read(last, len(piece))

    def encode(self, pieces: list[bytes]) -> list[list[int]]:
        """The tokens of each piece."""
        whole = [self.ranks.get(p) for p in pieces]  # a piece that is a token is that token, as in tiktoken
        short = [k for k, p in enumerate(pieces) if whole[k] is None and len(p) <= LONG]
        long = sorted((p, k) for k, p in enumerate(pieces) if whole[k] is None and len(p) > LONG)
        got: list = [None if t is None else (t,) for t in whole]
        flat, first = self.encode_many([pieces[k] for k in short])
        for j, k in enumerate(short):
            got[k] = flat[first[j] : first[j + 1]]
        for (_, k), tokens in zip(long, self.encode_sorted([p for p, _ in long]), strict=True):
            got[k] = tokens
        return got


#: The pattern that has a quicker form of its own.
SPACED = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def splitter(pattern: str):
    """What splits a text into the matches of `pattern`. SPACED is spelled out with the characters of its classes, which `re` is
    quicker with: those of ASCII for ASCII texts, those up to U+FFFF for texts without later ones."""
    import re

    import regex

    general = regex.compile(pattern).findall
    if pattern != SPACED:
        return general

    def spelled(every: str):
        runs = {name: regex.findall(f"{name}+", every) for name in (r"\s", r"\p{L}", r"\p{N}")}
        white, letter, number = ("".join(f"{re.escape(run[0])}-{re.escape(run[-1])}" for run in found) for found in runs.values())
        return re.compile(f"'s|'t|'re|'ve|'m|'ll|'d| ?[{letter}]+| ?[{number}]+| ?[^{white}{letter}{number}]+|[{white}]+(?![^{white}])|[{white}]+").findall

    plain, wide = spelled("".join(map(chr, range(128)))), spelled("".join(map(chr, [*range(0xD800), *range(0xE000, 0x10000)])))
    beyond = re.compile("[\ud800-\udfff\U00010000-\U0010ffff]").search
    return lambda text: plain(text) if text.isascii() else general(text) if beyond(text) else wide(text)


class Document:
    """A piece that is edited: appends and replacements keep what is stored for the bytes before them."""

    def __init__(self, encoder: PrefixEncoder, piece: bytes = b""):
        self.encoder, self.piece, self.last = encoder, b"", []
        self.append(piece)

    def append(self, more: bytes) -> None:
        self.piece += more
        self.encoder.extend(self.piece, self.last, len(self.last))

    def replace(self, start: int, end: int, by: bytes) -> int:
        """Put `by` in place of the bytes from start to end, and return how many prefixes were worked out again.

        What is stored for a prefix depends on its last `longest` bytes and on what is stored for the `longest` prefixes
        before it. So once that many behind the edit agree with the old ones, all later ones do.
        """
        old, shift, agree = self.last[:], len(by) - (end - start), 0
        self.piece = self.piece[:start] + by + self.piece[end:]
        for at in range(start, len(self.piece)):
            self.encoder.extend(self.piece, self.last, at, at + 1)
            agree = agree + 1 if at >= start + len(by) and self.last[at] == old[at - shift] else 0
            if agree > self.encoder.longest:
                self.last += old[at + 1 - shift :]
                return at + 1 - start
        del self.last[len(self.piece) :]
        return len(self.piece) - start

    def tokens(self) -> list[int]:
        return self.encoder.read(self.last, len(self.piece))


class Codec:
    """Texts to token ids and back. Ids are held as decimal text, which is also how they are hashed."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.encoder = PrefixEncoder(ranks)
        self.split = splitter(pattern)
        self.ids: dict[str, str] = {}
        self.name = {rank: str(rank) for rank in ranks.values()}
        self.token = {str(rank): token for token, rank in ranks.items()}

    def learn(self, new: list[str]) -> None:
        """Work out the ids of pieces."""
        own, name = self.ids, self.name.__getitem__
        for k in range(0, len(new), LOT):
            lot = new[k : k + LOT]
            for piece, tokens in zip(lot, self.encoder.encode([x.encode("utf-8", "surrogatepass") for x in lot]), strict=True):
                own[piece] = " ".join(map(name, tokens))

    def encode(self, texts: list[str]) -> Iterator[str]:
        """The ids of each text, joined by one space."""
        size, lot = 0, []
        for text in texts:
            lot.append(text)
            size += len(text)
            if size >= 1 << 22:
                yield from self._encode(lot)
                size, lot = 0, []
        yield from self._encode(lot)

    def _encode(self, texts: list[str]) -> Iterator[str]:
        if len(self.ids) > KEPT_PIECES:
            self.ids.clear()
        split = [self.split(text) for text in texts]
        new: set[str] = set()
        for pieces in split:
            new.update(pieces)
        new.difference_update(self.ids.keys())
        self.learn(list(new))
        ids = self.ids.__getitem__
        for pieces in split:
            yield " ".join(map(ids, pieces))

    def decode(self, ids: str) -> bytes:
        return b"".join(map(self.token.__getitem__, ids.split(" "))) if ids else b""


_codecs: dict[str, Codec] = {}


def _codec(key: str, ranks: dict[bytes, int], pattern: str) -> Codec:
    if key not in _codecs:
        _codecs.clear()
        _codecs[key] = Codec(ranks, pattern)
    return _codecs[key]


def _shared(df: DataFrame, path: str, pattern: str) -> tuple[object, str]:
    ranks = load_ranks(path)
    if len(ranks) > MOST_TOKENS:
        raise ValueError(f"a vocabulary of {len(ranks)} tokens is larger than {MOST_TOKENS}")
    key = hashlib.sha256(repr((sorted(ranks.items()), pattern)).encode()).hexdigest()
    return df.sparkSession.sparkContext.broadcast(ranks), key


def encode(df: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = True) -> DataFrame:
    """Token ids of each text, and the bytes that they stand for.

    Returns id_col, n_tokens, ids (array<int>, unless keep_ids is false), ids_sha256 (of the decimal ids joined by one
    space), decoded_sha256 (of the decoded bytes). One row for each row of `df`, repeated rows and null ids included;
    a null text is an empty one, without tokens. Other columns of `df` are left behind. There is no shuffle; a task
    holds a batch of texts and a bounded memory of pieces.
    """
    shared, key = _shared(df, path, pattern)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(key, shared.value, pattern)
        for batch in batches:
            at, _ = base.text_buffer(batch.column(1))
            for i, j in base.chunks(at):
                texts = [x or "" for x in batch.column(1).slice(i, j - i).to_pylist()]
                encoded = list(codec.encode(texts))
                n = [ids.count(" ") + 1 if ids else 0 for ids in encoded]
                sha = [hashlib.sha256(ids.encode()).hexdigest() for ids in encoded]
                back = [hashlib.sha256(codec.decode(ids)).hexdigest() for ids in encoded]
                columns = {id_col: batch.column(0).slice(i, j - i), "n_tokens": pa.array(n, pa.int64()), "ids_sha256": pa.array(sha), "decoded_sha256": pa.array(back)}
                if keep_ids:
                    flat = np.fromstring(" ".join(filter(None, encoded)), np.int32, sep=" ")
                    columns["ids"] = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(n))).astype(np.int32)), pa.array(flat))
                yield pa.RecordBatch.from_pydict(columns)
        codec.ids.clear()  # a worker that goes on to other work gives this up

    kind = dict(df.select(id_col).dtypes)[id_col]
    return df.select(F.col(id_col), F.col(text_col)).mapInArrow(work, f"`{id_col}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string{', ids array<int>' if keep_ids else ''}")


def decode(df: DataFrame, path: str, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """Adds the bytes of each array of ids; a null array gives null, an id outside the vocabulary fails the row's task."""
    shared, _ = _shared(df, path, "")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token = {rank: token for token, rank in shared.value.items()}
        for batch in batches:
            back = [None if ids is None else b"".join(map(token.__getitem__, ids)) for ids in batch.column(ids_col).to_pylist()]
            yield batch.append_column(out_col, pa.array(back, pa.binary()))

    from pyspark.sql import types as T

    return df.mapInArrow(work, T.StructType([*df.schema.fields, T.StructField(out_col, T.BinaryType())]))

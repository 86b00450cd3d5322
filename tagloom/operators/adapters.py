"""Where readers, super-resolution, code decoders and language models plug in; the null ones find nothing."""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator
from typing import Protocol

import pandas as pd
from pyspark.sql import DataFrame


class TextReader(Protocol):
    def recognize_batch(self, images: list[bytes]) -> list[list[dict]]: ...


class CodeReader(Protocol):
    def decode(self, image: bytes) -> list[dict]: ...


class Enhancer(Protocol):
    def variants(self, image: bytes, zone: str) -> list[tuple[str, bytes]]: ...


class NullReader:
    """Finds no text, no codes and no better picture."""

    def recognize_batch(self, images: list[bytes]) -> list[list[dict]]:
        return [[] for _ in images]

    def decode(self, image: bytes) -> list[dict]:
        return []

    def variants(self, image: bytes, zone: str) -> list[tuple[str, bytes]]:
        return [("original", image)]


def recognize(images: DataFrame, make: Callable[[], TextReader], batch: int = 16) -> DataFrame:
    """path, lines (JSON), error: the reader is made once for each task; a batch that fails is read one by one, and a picture that fails is a row."""

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        reader = make()
        for frame in frames:
            for start in range(0, len(frame), batch):
                part = frame.iloc[start : start + batch]
                data = [bytes(x) if x is not None else b"" for x in part["content"]]
                try:
                    got, errors = reader.recognize_batch(data), [None] * len(data)
                except Exception:  # noqa: BLE001  tried one by one below
                    got, errors = [], []
                    for x in data:
                        try:
                            got.append(reader.recognize_batch([x])[0])
                            errors.append(None)
                        except Exception as e:  # noqa: BLE001
                            got.append([])
                            errors.append(f"{type(e).__name__}: {e}")
                yield pd.DataFrame({"path": part["path"].to_numpy(), "lines": [json.dumps(g, ensure_ascii=False) for g in got], "error": errors})

    return images.select("path", "content").mapInPandas(work, "path string, lines string, error string")


def decode_codes(images: DataFrame, make: Callable[[], CodeReader]) -> DataFrame:
    """path, kind, payload, fmt: one row for each code read."""

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        reader = make()
        for frame in frames:
            rows = [(p, c.get("kind"), c.get("payload"), c.get("fmt")) for p, x in zip(frame["path"], frame["content"], strict=True) for c in reader.decode(bytes(x))]
            yield pd.DataFrame(rows, columns=["path", "kind", "payload", "fmt"])

    return images.select("path", "content").mapInPandas(work, "path string, kind string, payload string, fmt string")


def enhance(images: DataFrame, make: Callable[[], Enhancer], zone: str, allow: tuple[str, ...] = ("*",), deny: tuple[str, ...] = ()) -> DataFrame:
    """path, variant, content: variants of pictures whose zone is allowed (shell patterns); others are passed on."""
    from fnmatch import fnmatch

    wanted = any(fnmatch(zone, p) for p in allow) and not any(fnmatch(zone, p) for p in deny)

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        maker = make() if wanted else NullReader()
        for frame in frames:
            rows = [(p, name, data) for p, x in zip(frame["path"], frame["content"], strict=True) for name, data in maker.variants(bytes(x), zone)]
            yield pd.DataFrame(rows, columns=["path", "variant", "content"])

    return images.select("path", "content").mapInPandas(work, "path string, variant string, content binary")


def first_json(s: str | None) -> dict | None:
    """The first JSON object in a text, fenced or bare."""
    if not s:
        return None
    fenced = re.search(r"```(?:json)?\s*(\{.*?\})\s*```", s, re.S)
    text, decoder = fenced[1] if fenced else s, json.JSONDecoder()
    for m in re.finditer(r"\{", text):
        try:
            got, _ = decoder.raw_decode(text, m.start())
        except ValueError:
            continue
        if isinstance(got, dict):
            return got
    return None


def correct(evidence: DataFrame, make: Callable[[], Callable[[str], str]], key: str = "path") -> DataFrame:
    """key, answer (JSON object or null), error: asks a model about each row's `prompt`."""

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ask = make()
        for frame in frames:
            answers, errors = [], []
            for prompt in frame["prompt"]:
                try:
                    got = first_json(ask(prompt))
                    answers.append(None if got is None else json.dumps(got, ensure_ascii=False))
                    errors.append(None)
                except Exception as e:  # noqa: BLE001  one bad answer isn't the task's end
                    answers.append(None)
                    errors.append(f"{type(e).__name__}: {e}")
            yield pd.DataFrame({key: frame[key].to_numpy(), "answer": answers, "error": errors})

    return evidence.select(key, "prompt").mapInPandas(work, f"`{key}` {dict(evidence.dtypes)[key]}, answer string, error string")

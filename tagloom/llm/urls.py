"""URL filter: rules first, then logistic regression on hashed character n-grams of host and path.

The model is trained from a small labelled table of URLs. The one built here follows a rule (topics of block lists and of
ordinary sites in common shapes of hosts and paths), so that it needs no corpus; any table with `url` and `bad` can take
its place.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

#: Buckets of n-grams, their lengths, and the most labelled rows that are fitted on.
BUCKETS, SIZES, MOST_ROWS = 1 << 15, (3, 4, 5), 50_000
#: Fixed values: (host, path prefix, verdict).
RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))
#: What block lists name, by topic, and what ordinary sites are called.
UNWANTED = {
    "gambling": "casino poker roulette blackjack jackpot slots bets betting bookmaker lottery bingo wager gamble",
    "pharmacy": "pills viagra cialis meds steroids xanax tramadol weightloss potency dietpills painkiller",
    "adult": "adult xxx porn sex escort nude webcam erotic hookup fetish",
    "money": "payday loans forex quickcash getrich bitcoinprofit cashback debtrelief replica",
    "piracy": "warez torrent crack keygen nulled serialz freedownload",
    "malware": "malware phish spyware trojan ransom exploit fakelogin",
    "promotion": "ads adserver banner popunder tracker clickbait linkfarm spam backlinks doorway giveaway prize sweepstake",
}
ORDINARY = {
    "public": "news library school university museum city council court police parliament health hospital weather transport embassy",
    "culture": "music theatre cinema gallery photo poetry letters journal archive history review reader stories festival",
    "knowledge": "science wiki docs manual tutorial course research method astronomy biology physics language dictionary maps",
    "home": "garden recipes kitchen travel hotel hiking family sports football cycling fishing pets birds knitting",
    "trade": "market shop books furniture bakery dental lawyer architect engineering software studio station repair cars",
    "talk": "forum blog mail chat think other within about people voices opinion community",
}


def labelled(n: int = 8000, seed: int = 3) -> pd.DataFrame:
    """A labelled URL table made by rule: one in two names a topic of UNWANTED in its host, or now and then in its path only.

    Names are a word alone, with another word, or with made-up syllables; hosts have the usual subdomains and endings;
    paths are directories, dates, numbers and files.
    """
    rng = np.random.default_rng(seed)
    bad_words, good_words = (" ".join(topics.values()).split() for topics in (UNWANTED, ORDINARY))

    def pick(xs):
        return xs[int(rng.integers(len(xs)))]

    def syllables() -> str:
        return "".join(pick("bcdfghjklmnprstvwz") + pick("aeiou") + pick(("", "", "n", "r", "s", "l", "th", "ck")) for _ in range(int(rng.integers(1, 5))))

    def name(words: list[str], plain: float) -> str:
        shape, word = rng.random(), pick(words)
        if shape < 0.35:
            return word
        other = syllables() if rng.random() < plain else pick(good_words)
        one, two = (word, other) if rng.random() < 0.5 else (other, word)
        return one + pick(("-", "", "")) + two + pick(("", "", "", "24", "online", "365"))

    def path(words: list[str]) -> str:
        parts = [pick((str(rng.integers(1990, 2030)), str(rng.integers(1, 99_999)), syllables(), pick(words), pick(("en", "de", "fr", "es", "it", "ru", "img", "static", "tag", "p")))) for _ in range(int(rng.integers(0, 4)))]
        return "/" + "/".join(parts) + pick(("", "", "/", ".html", ".php", ".jpg"))

    rows = []
    for k in range(n):
        bad = k % 2 == 1
        in_host = rng.random() < 0.85
        host = name(bad_words, 0.5) if bad and in_host else syllables() if rng.random() < 0.5 else name(good_words, 0.5)
        host = pick(("", "", "", "www.", "m.", "shop.", "cdn.", syllables() + ".")) + host + pick((".com", ".net", ".org", ".info", ".co.uk", ".de", ".io", ".example.com", ".example.org", ".example.net"))
        where = path(good_words)
        if bad and not in_host:
            where = "/" + name(bad_words, 0.5) + where
        rows.append((pick(("http://", "https://")) + host + where, int(bad)))
    return pd.DataFrame(rows, columns=["url", "bad"])


def parts(url: Column) -> tuple[Column, Column]:
    """Host and path. The host is what lies between the first `://` and `/`, `?`, `#` or the end, A-Z lower-cased; the path goes on to `?`, `#` or the end."""
    cut = F.instr(url, "://")
    rest = F.coalesce(F.when(cut > 0, F.substring(url, cut + 3, F.length(url))), F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def features(hosts: list[str], paths: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Row and bucket of every distinct n-gram of host and path (which have n-grams of their own)."""
    rows, buckets = [], []
    for i, (host, path) in enumerate(zip(hosts, paths, strict=True)):
        got = []
        for salt, text in ((1, f"^{host}$"), (2, f"{path}$")):
            b = np.frombuffer(text.encode("utf-8", "replace"), np.uint8).astype(np.uint64)
            for n in SIZES:
                if len(b) >= n:
                    h = np.full(len(b) - n + 1, salt * 31 + n, np.uint64)
                    for k in range(n):
                        h = h * np.uint64(0x100000001B3) + b[k : len(b) - n + 1 + k]
                    h = (h ^ (h >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15)
                    got.append((h >> np.uint64(49)).astype(np.int64))
        one = np.unique(np.concatenate(got)) if got else np.zeros(0, np.int64)
        rows.append(np.full(len(one), i))
        buckets.append(one)
    return (np.concatenate(rows), np.concatenate(buckets)) if rows else (np.zeros(0, int), np.zeros(0, int))


def _split(url: str) -> tuple[str, str]:
    import re

    found = re.match(r"(?s)([^/?#]*)([^?#]*)", url.partition("://")[2])
    return re.sub("[A-Z]+", lambda m: m[0].lower(), found[1]), found[2]


class Model:
    """Weights of buckets and a bias; `probability` is that of a bad URL."""

    def __init__(self, table: pd.DataFrame, rounds: int = 200, rate: float = 0.15, decay: float = 1e-5):
        table = table.dropna(subset=["url", "bad"])
        table = table if len(table) <= MOST_ROWS else table.sample(MOST_ROWS, random_state=0)
        y = table["bad"].to_numpy(np.float64)
        split = [_split(u) for u in table["url"]]
        row, bucket = features([h for h, _ in split], [p for _, p in split])
        n = len(y)
        scale = 1 / np.sqrt(np.maximum(np.bincount(row, minlength=n), 1))
        self.w, self.b = np.zeros(BUCKETS), 0.0
        squares = np.full(BUCKETS, 1e-6)
        for _ in range(rounds if n else 0):  # full batches, each bucket at its own pace
            z = np.bincount(row, self.w[bucket], n) * scale + self.b
            pull = (y - 1 / (1 + np.exp(-z))) / n
            g = np.bincount(bucket, (pull * scale)[row], BUCKETS) - decay * self.w
            squares += g * g
            self.w += rate * g / np.sqrt(squares)
            self.b += 2.0 * pull.sum()

    def probability(self, hosts: list[str], paths: list[str]) -> np.ndarray:
        row, bucket = features(hosts, paths)
        n = len(hosts)
        scale = 1 / np.sqrt(np.maximum(np.bincount(row, minlength=n), 1))
        return 1 / (1 + np.exp(-(np.bincount(row, self.w[bucket], n) * scale + self.b)))


def rule_of(host: Column, path: Column, rules: tuple = RULES) -> tuple[Column, Column]:
    """The longest rule that fits (longest host and path together; ties: the one given first), and its verdict; else null."""
    fits = lambda h: (host == h) | host.endswith(f".{h}")
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for h, p, v in sorted(rules, key=lambda r: len(r[0] + r[1])):
        hit = fits(h) & path.startswith(p)
        name, verdict = F.when(hit, h + p).otherwise(name), F.when(hit, v).otherwise(verdict)
    return name, verdict


def judge(df: DataFrame, table: pd.DataFrame | None = None, rules: tuple = RULES, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """A verdict for each row of `df`: id_col, host, path, rule, verdict (allow or block), score (probability of a bad URL).

    `table` has `url` and `bad` (0 or 1); of more than MOST_ROWS rows an even sample of that many is fitted on, and without a
    table that of `labelled` is. Where no rule fits, the model decides: block from 0.5 on. A null url, or one without `://`, has empty host and path and
    is judged by the model like any other. Repeated rows and null ids are kept; only the id and the url are read.
    """
    model = Model(labelled() if table is None else table)
    shared = df.sparkSession.sparkContext.broadcast(model)
    rows = df.select(F.col(id_col), F.col(url_col).cast("string").alias("url"))
    host, path = parts(F.col("url"))
    rows = rows.withColumns({"host": host, "path": path})

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hosts, paths = batch.column("host").to_pylist(), batch.column("path").to_pylist()
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column("host"), batch.column("path"), pa.array(shared.value.probability(hosts, paths))], names=[id_col, "host", "path", "score"])

    kind = dict(df.select(id_col).dtypes)[id_col]
    scored = rows.select(id_col, "host", "path").mapInArrow(work, f"`{id_col}` {kind}, host string, path string, score double")
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    return scored.select(id_col, "host", "path", rule.alias("rule"), F.coalesce(verdict, F.when(F.col("score") >= 0.5, "block").otherwise("allow")).alias("verdict"), "score")

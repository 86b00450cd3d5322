"""Each operator against a plain version, and its hard cases: nulls, empty and long texts, repeated rows, empty tables, other columns."""

import collections
import hashlib
import math
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tagloom.llm import base, bpe, hmm, langid, leaks, licences, lines, neardup, neighbours, substrings, urls

WORDS = [f"{a}{b}{c}" for a in ("ba", "ko", "mi", "tu") for b in ("ra", "le", "no", "si") for c in ("", "x", "n", "th")]


def prose(seed, n):
    rnd = random.Random(seed)
    return " ".join(rnd.choice(WORDS) for _ in range(n))


def docs(spark, rows):
    """Documents with a column whose names operators use inside."""
    return spark.createDataFrame([(i, t, None, "s") for i, t in rows], "doc_id long, text string, h string, source string")


HARD = [(1, None), (2, ""), (3, "  \n\t "), (4, "one"), (5, "one"), (6, "one two"), (7, prose(1, 30)), (8, prose(1, 30)), (9, prose(2, 3000)), (9, prose(2, 3000)), (10, prose(1, 30) + " " + prose(3, 40))]


# op 2
def removed(rows, n):
    seen, out = {}, {}
    for i, t in sorted({(i, t) for i, t in rows}, key=lambda r: r[0]):
        w = (t or "").encode().split()
        gone = [False] * len(w)
        for k in range(len(w) - n + 1):
            if seen.setdefault(tuple(w[k : k + n]), (i, k)) != (i, k):
                gone[k : k + n] = [True] * n
        kept = b" ".join(x for x, g in zip(w, gone) if not g)
        out[i] = (len(w), sum(gone), hashlib.sha256(kept).hexdigest())
    return out


@pytest.mark.parametrize(("length", "least"), [(20, 10), (8, 2), (5, 10)])
def test_substrings(spark, length, least):
    rows = [*HARD, *((20 + k, prose(k % 4, 25) + " " + prose(100 + k, 15) + " " + prose(k % 3, 12)) for k in range(30))]
    got = substrings.dedup(docs(spark, rows), length, least).collect()
    want = removed(rows, length)
    assert len(got) == len(rows)
    assert all((r.n_words, r.n_removed, r.kept_sha256) == want[r.doc_id] for r in got)
    assert substrings.dedup(docs(spark, [])).count() == 0


# op 3
def near(rows, size, percent=80):
    sets = {}
    for i, t in rows:
        w = (t or "").encode().lower().split()
        sets[i] = frozenset(tuple(w[k : k + size]) for k in range(len(w) - size + 1)) or (frozenset([tuple(w)]) if w else frozenset())
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            x, y = sets[a], sets[b]
            if a < b and x and y and 100 * len(x & y) >= percent * len(x | y):
                p, q = find(a), find(b)
                root[max(p, q)] = min(p, q)
    return {i: (len(sets[i]), find(i)) for i in ids}


def test_neardup(spark):
    rows = list(HARD)
    for g in range(4):
        body = prose(500 + g, 120).split()
        for k in range(25):
            rnd, copy = random.Random(g * 100 + k), list(body)
            for _ in range(k // 2):
                copy[rnd.randrange(len(copy))] = f"new{rnd.random()}"
            rows.append((1000 + g * 100 + k, " ".join(copy)))
    for size in (2, 5):
        got = neardup.groups(docs(spark, rows), size=size).collect()
        want = near(rows, size)
        assert len(got) == len(rows)
        assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want
        assert all(r.kept == (r.doc_id == r.component_id) for r in got)
    assert neardup.groups(docs(spark, [])).count() == 0


def test_components(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 200), (300, 200), (500, 500)]
    got = {r.id: r.component for r in neardup.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(61), 0), 100: 100, 200: 100, 300: 100}


# op 8
RANKS = None


def codec():
    import public_tokenizers

    global RANKS
    RANKS = RANKS or bpe.load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return bpe.Codec(RANKS, public_tokenizers.PATTERN)


def test_bpe_is_exact(spark):
    import public_tokenizers
    import tiktoken

    c, rnd = codec(), random.Random(4)
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})
    marks = " \n\t\r\x1c\x85\u00a0\u3000aZé'st.,1²٣漢🙂\u200b_"
    texts = ["", prose(3, 200), "Éauoir l'été — don't  stop\n\n now ", *("".join(rnd.choice(marks) for _ in range(rnd.randint(0, 30))) for _ in range(800))]
    ids = list(c.encode(texts))
    assert [list(map(int, x.split())) for x in ids] == [own.encode_ordinary(t) for t in texts]
    assert [c.decode(x) for x in ids] == [t.encode() for t in texts]
    d = bpe.Document(c.encoder, b"thetion")
    d.append(b"ing of the")
    d.replace(3, 5, b"ATI")
    assert d.tokens() == c.encoder.merge(d.piece)
    got = bpe.encode(docs(spark, [*HARD, (None, "a b")]), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    back = bpe.decode(got, public_tokenizers.path("byte_bpe_50k.tiktoken")).collect()
    assert len(back) == len(HARD) + 1
    texts = dict(HARD)
    for r in back:
        assert bytes(r.decoded).decode() == ("a b" if r.doc_id is None else texts[r.doc_id] or "")
        assert r.n_tokens == len(r.ids)


# op 9
def test_langid(spark):
    rows = [(k, " ".join(random.Random(k).choice(ws) for _ in range(30)), lang) for k in range(300) for lang, ws in [(("aa", ["tha", "thing", "wash"]), ("bb", ["lée", "eaux", "ñou"]), ("cc", ["zwisch", "über", "keit"]))[k % 3]]]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.fit(table.where("doc_id % 5 <> 0"))
    got = {r.doc_id: r for r in langid.predict(table, model).collect()}
    assert all(got[i].lang_pred == lang and 0 <= got[i].score <= 1 for i, _, lang in rows)
    odd = langid.predict(docs(spark, [*HARD, (None, "12 !?")]), model).collect()
    assert len(odd) == len(HARD) + 1
    assert {r.doc_id for r in odd if r.lang_pred == "und"} == {1, 2, 3, None}
    assert langid.fit(table.where("false")) is None
    assert {r.lang_pred for r in langid.predict(table, None).collect()} == {"und"}
    assert langid.annotate(table.limit(2), model).columns == ["doc_id", "text", "lang", "lang_pred", "score", "ambiguous"]


# op 6
def test_hmm_base_and_likelihood(spark, monkeypatch):
    monkeypatch.setattr(hmm, "HOT", 30)
    rows = [*HARD, *((100 + k, prose(k, 40)) for k in range(60))]
    got = hmm.score(docs(spark, rows), langid.remainder("doc_id", 7) == 2).collect()
    assert len(got) == len(rows)
    tokens = lambda t: [*(t or "").encode().lower().split(), None]
    counts = collections.Counter(w for i, t in rows if zlib.crc32(str(i).encode()) % 7 != 2 for w in tokens(t))
    n, v, texts = sum(counts.values()), len(counts), dict(rows)
    for r in got:
        t = tokens(texts[r.doc_id])
        assert r.n_tokens == len(t) and r.n_known == sum(counts[w] > 0 for w in t) and r.train_tokens == n
        assert r.base_score == pytest.approx(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in t))
        assert r.score < 0 and math.isfinite(r.score)
    assert hmm.score(docs(spark, []), F.lit(False)).count() == 0


def test_hmm_recursion():
    rng = np.random.default_rng(0)
    share = lambda *s: (lambda x: x / x.sum(-1, keepdims=True))(rng.random(s))
    m = hmm.Model(share(3), share(3, 3), share(3, 5).T)
    cls, first = rng.integers(0, 5, 9).astype(np.int32), np.array([0, 4, 9])
    want = []
    for a, b in ((0, 4), (4, 9)):
        p = m.start * m.emit[cls[a]]
        for t in range(a + 1, b):
            p = (p @ m.move) * m.emit[cls[t]]
        want.append(math.log10(p.sum()))
    assert hmm.likelihood(m, cls, first) == pytest.approx(want)
    c = hmm.Counts(3, 5)
    c.add(m, cls, first)
    assert c.start.sum() == pytest.approx(2) and c.move.sum() == pytest.approx(7) and c.emit.sum() == pytest.approx(9)


# op 4
def test_urls(spark):
    rows = [(1, "HTTP://WWW.Example.NET/en/a?x"), (2, "http://example.com/de/1"), (3, "https://a.org/fr/x#y"), (4, None), (5, "no scheme"), (6, "http://casino-win.example.org/en/1"), (7, "http://garden.example.org?q=/fr/"), (8, "http://notexample.net/en/"), (8, "http://notexample.net/en/"), (9, "ftp://x://Y/z"), (10, "")]
    got = {r.page_id: r for r in urls.judge(spark.createDataFrame(rows, "page_id long, url string").withColumn("host", F.lit(1))).collect()}
    assert (got[1].host, got[1].path, got[1].rule, got[1].verdict) == ("www.example.net", "/en/a", "example.net/en/", "allow")
    assert (got[2].rule, got[2].verdict) == ("example.com/de/", "block")
    assert (got[3].rule, got[3].verdict) == ("org/fr/", "allow")
    assert (got[4].host, got[4].path, got[5].host, got[10].path) == ("", "", "", "")
    assert (got[6].rule, got[6].verdict) == (None, "block")
    assert (got[7].path, got[7].rule, got[7].verdict) == ("", None, "allow")
    assert (got[8].rule, got[8].verdict) == ("net/", "block")
    assert (got[9].host, got[9].path) == ("x:", "//Y/z")


# op 5
def test_lines(spark):
    rows = [(k, f"own {k}\n  shared footer \n\nnine" if k < 9 else f"own {k}\nshared footer", f"s{k}") for k in range(12)] + [(50, None, "s1"), (51, "", None), (52, "shared footer", None), (53, "own 1\nown 1", "s1")]
    got = {r.doc_id: r for r in lines.dedup(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    assert len(got) == len(rows)
    assert got[0].kept == "own 0\n  shared footer \n\nnine" and got[0].n_removed == 0
    assert got[3].kept == "own 3\n\nnine" and got[11].kept == "own 11" and got[52].kept == ""
    assert (got[50].kept, got[50].n_lines, got[51].n_lines, got[53].n_removed) == (None, 0, 1, 0)


# op 1
def test_licences(spark):
    mit = licences.TEMPLATES["MIT"][0]
    broken = mit.split()
    del broken[10:13]
    broken[40] = "SOMETHING"
    rows = [*HARD, (100, prose(5, 50) + "\n" + mit + " " + prose(6, 9)), (101, " ".join(broken)), (102, "x\nLicensed under CC BY-NC 4.0.\nAll rights reserved. y"), (103, prose(7, 20) + " permission is hereby granted"), (104, "été Released under the MIT License.")]
    got = licences.scan(docs(spark, rows)).collect()
    by = collections.defaultdict(list)
    for r in got:
        by[r.doc_id].append(r)
    assert set(by) == {100, 101, 102, 104}
    text = dict(rows)
    assert text[100][by[100][0].start : by[100][0].end] == mit and by[100][0].coverage == 1
    assert by[101][0].licence == "MIT" and 0.9 < by[101][0].coverage < 1
    assert sorted(r.licence for r in by[102]) == ["CC-BY-NC-4.0", "proprietary"]
    assert text[104][by[104][0].start : by[104][0].end] == "Released under the MIT License."


# op 7
def test_leaks(spark):
    items = spark.createDataFrame([(k, prose(900 + k, 45)) for k in range(12)] + [(50, None), (51, "")], "item_id long, text string")
    item = prose(903, 45).split()
    changed = [w if k % 8 else "changed" for k, w in enumerate(item)]
    rows = [*HARD, (100, prose(1, 200) + " " + prose(902, 45) + " " + prose(2, 200)), (101, "x, " + " ".join(changed) + "!"), (102, prose(77, 400)), (103, prose(904, 45).upper())]
    other = [(200 + k, prose(2000 + k, 150) + f" only{k}") for k in range(60)]
    got = {(r.doc_id, r.item_id) for r in leaks.find(docs(spark, rows + other), items).collect()}
    assert got == {(100, 2), (101, 3), (103, 4)}
    assert leaks.find(docs(spark, []), items).count() == 0
    assert leaks.find(docs(spark, rows), items.where("false")).count() == 0
    assert leaks.common(b"a b c d".split(), b"x a c y d".split()) == 3


def test_leaks_of_many_items(spark):
    rnd = random.Random(5)
    vocabulary = [f"w{k}" for k in range(6000)]
    draw = lambda n: " ".join(rnd.choice(vocabulary) for _ in range(n))
    texts = [draw(rnd.randrange(15, 60)) for _ in range(1500)]
    items = spark.createDataFrame(list(enumerate(texts)), "item_id long, text string")
    rows = [(k, draw(rnd.randrange(200)) + " " + texts[k] + " " + draw(100)) for k in range(0, 1500, 5)]
    assert {(r.doc_id, r.item_id) for r in leaks.find(docs(spark, rows), items).where("kind = 'copy'").collect()} == {(k, k) for k, _ in rows}


def test_leaks_of_short_paraphrases(spark):
    rnd = random.Random(6)
    vocabulary = [f"w{k}" for k in range(6000)]
    draw = lambda n: " ".join(rnd.choice(vocabulary) for _ in range(n))
    items, rows = [], []
    for k in range(200):
        words = draw(15 + k % 11).split()
        items.append((k, " ".join(words[:-2]) + "\n" + " ".join(words[-2:])))
        for at in rnd.sample(range(len(words) - 2), int(0.48 * len(words))):
            words[at] = rnd.choice(vocabulary)
        rows.append((k, draw(rnd.randrange(200)) + " " + " ".join(words) + " " + draw(100)))
    got = leaks.find(docs(spark, rows), spark.createDataFrame(items, "item_id long, text string"))
    assert {(r.doc_id, r.item_id) for r in got.where("kind = 'paraphrase'").collect()} == {(k, k) for k in range(200)}


# op 10
def test_neighbours(spark):
    rng = np.random.default_rng(1)
    vectors = rng.normal(size=(700, 16)).round(3)
    vectors[0] *= 4  # so that its copies are its nearest
    rows = [(k, [float(x) for x in v]) for k, v in enumerate(vectors)] + [(1000 + k, [float(x) for x in vectors[0]]) for k in range(60)]
    rows += [(2000, None), (2020, [0.0] * 16), (2040, [1.0] * 15 + [float("nan")]), (2060, [1.0, None] * 8), (2080, [1.0] * 3), (None, [1.0] * 16)]
    got = collections.defaultdict(list)
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    for r in sorted(neighbours.search(table, "id % 20 = 0").collect(), key=lambda r: (r.query_id, r.rank)):
        got[r.query_id].append((r.vec_id, r.score))
    good = {i: np.array(v) for i, v in rows[:760]}
    found = total = 0
    assert set(got) == {i for i in good if i % 20 == 0}
    for q, near_ in got.items():
        want = sorted(((-float(good[q] @ v), i) for i, v in good.items() if i != q))[:20]
        assert len(near_) == 20 and near_ == sorted(near_, key=lambda x: (-x[1], x[0]))
        assert all(s == pytest.approx(float(good[q] @ good[i])) for i, s in near_)
        found, total = found + len({i for i, _ in near_} & {i for _, i in want}), total + 20
    assert found / total >= 0.9
    assert [i for i, _ in got[0]][:2] == [1000, 1001]
    assert neighbours.search(table.where("false"), "id % 20 = 0").count() == 0


def test_neighbours_across_ranges(spark, monkeypatch):
    rng = np.random.default_rng(3)
    vectors = rng.normal(size=(1500, 16)).round(3)
    table = spark.createDataFrame([(k, [float(x) for x in v]) for k, v in enumerate(vectors)], "vec_id long, embedding array<double>")

    def found():
        return {(r.query_id, r.rank, r.vec_id, r.score) for r in neighbours.search(table, "id % 20 = 0").collect()}

    whole = found()
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    try:
        assert found() == whole
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    monkeypatch.setattr(neighbours, "RANGE_ROWS", 100)
    assert found() == whole
    want = {(q, int(i)) for q in range(0, 1500, 20) for i in np.argsort(-(vectors @ vectors[q] - 1e9 * (np.arange(1500) == q)), kind="stable")[:20]}
    assert len(want & {(q, i) for q, _, i, _ in whole}) >= 0.93 * len(want)


def test_bpe_edits_far_from_the_end():
    c, rnd = codec(), random.Random(8)
    piece = prose(4, 400).replace(" ", "").encode()
    d = bpe.Document(c.encoder, piece)
    for _ in range(10):
        start = rnd.randrange(len(d.piece) - 10)
        again = d.replace(start, start + rnd.randrange(6), rnd.choice((b"", b"the", b"zq9")))
        assert d.last == bpe.Document(c.encoder, d.piece).last
        assert start > len(d.piece) - 600 or again < 600  # not up to the end
    assert d.tokens() == list(next(c.encoder.encode_sorted([d.piece])))


def test_latent_space_in_little_memory(spark):
    import tracemalloc

    rows = [(" ".join(f"w{k}x{i}" for i in range(60)),) for k in range(12)]
    tracemalloc.start()
    space = leaks.latent_space(spark.createDataFrame(rows, "text string"), np.ones(leaks.BUCKETS, np.float32))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    passages = [p for (t,) in rows for p in leaks._passages(t, np.ones(leaks.BUCKETS, np.float32))]
    assert space.shape[0] == leaks.BUCKETS and peak < 40e6  # rows of all buckets took over 100 MB of the driver
    assert all(np.linalg.norm(value @ space[at]) == pytest.approx(1, abs=1e-3) for at, value in passages)
    assert leaks.latent_space(spark.createDataFrame([("",)], "text string"), np.ones(leaks.BUCKETS, np.float32)).shape == (leaks.BUCKETS, 0)


def test_leaks_windows_stay_in_their_text():
    rng = np.random.default_rng(8)
    texts = [" ".join(f"w{w}" for w in rng.integers(0, 300, n)) for n in (5, 300, 0, 40, 25, 2000, 13)]
    idf, space = np.ones(leaks.BUCKETS, np.float32), rng.normal(size=(leaks.BUCKETS, 16)).astype(np.float32)
    bench = leaks.Benchmark([(k, t, None) for k, t in enumerate(texts)], idf, space)
    found = lambda some: [(d, i, p, round(c, 4)) for d, i, p, c in bench.candidates(*leaks._words(*base.text_buffer(pa.array(some))), idf)]
    assert found(texts) == [(d, i, p, c) for d, t in enumerate(texts) for _, i, p, c in found([t])]


def test_hmm_lots_of_texts_together():
    rng = np.random.default_rng(2)
    m = hmm.Model(np.full(3, 1 / 3), rng.dirichlet(np.ones(3), 3), rng.dirichlet(np.ones(9), 3).T)
    lots = [(rng.integers(0, 9, sum(n)).astype(np.int32), np.concatenate(([0], np.cumsum(n)))) for n in ([3, 1, 200], [1], [40, 7])]
    cls, first = hmm._joined(lots)
    assert hmm.likelihood(m, cls, first) == pytest.approx(np.concatenate([hmm.likelihood(m, *lot) for lot in lots]))
    apart, joined = hmm.Counts(3, 9), hmm.Counts(3, 9)
    for lot in lots:
        apart.add(m, *lot)
    joined.add(m, cls, first)
    assert joined.cells() == pytest.approx(apart.cells())


def test_langid_fit_in_little_memory(spark):
    import tracemalloc

    table = spark.range(1500).selectExpr("id doc_id", "if(id % 2 = 0, 'aa', 'bb') lang", "concat(if(id % 2 = 0, 'tha wash ', 'eaux zwi '), id) text")
    tracemalloc.start()
    model = langid.fit(table)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 5e6  # the sample on the driver took over 30 MB
    assert model.langs == ["aa", "bb"]
    assert langid.predict(table, model).join(table, "doc_id").where("lang_pred <> lang").count() == 0


def test_train_bits_by_blocks():
    rng = np.random.default_rng(3)
    x, y = rng.random((70, langid.BUCKETS)).astype(np.float16), rng.choice([-1.0, 1.0], (70, 5))
    x /= np.linalg.norm(x.astype(np.float32), axis=1)[:, None].astype(np.float16)
    (w, b), (w2, b2) = langid.train_bits([x], y, 20), langid.train_bits([x[:1], x[1:33], x[33:]], y, 20)
    assert np.allclose(w, w2, atol=1e-3) and np.allclose(b, b2, atol=1e-3)


def test_latent_space_by_tasks(spark):
    items, idf = spark.createDataFrame([(" ".join(f"w{k}x{i}" for i in range(60)),) for k in range(12)], "text string"), np.ones(leaks.BUCKETS, np.float32)
    one, two = leaks.latent_space(items, idf, tasks=1), leaks.latent_space(items, idf)
    assert one.shape == two.shape
    assert np.allclose(one @ (one.T @ two), two, atol=1e-3)  # the same space

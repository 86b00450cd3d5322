"""The stages on any columns, null ids, repeated rows and empty tables; the whole pipeline on the smallest tables."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tagloom.llm import bpe

D = "/root/testdata/sf0.001"
STAGES = dict(corpus_pipeline.STAGES)
#: Names that operators give to columns of their own.
CLASHES = ("score", "lang_pred", "ambiguous", "lines_id", "lines_kept", "lines_cut", "lines_seen", "id_", "of_", "row_key", "row_times", "leak_id", "kept", "id", "key", "a.b")


def words(seed, n):
    rnd = random.Random(seed)
    return " ".join(rnd.choice(("baron", "kole", "minor", "tusk", "bale", "koran", "milen", "turn", "basin", "kolth")) + str(rnd.randrange(300)) for _ in range(n))


@pytest.fixture(scope="module")
def hard(spark):
    text = words(1, 60)
    rows = [(1, text, "en"), (1, text, "en"), (2, text + " more", "en"), (3, words(3, 50), "en"), (3, text, "en"), (None, words(4, 40), "en"), (None, words(4, 40), "en"), (4, None, None), (5, "", None), (6, words(6, 30000), None)]
    rows += [(100 + k, f"{words(100 + k, 30)}\nshared line of many sites", "en" if k < 8 else None) for k in range(15)]
    rows += [(200, "  shared line of many sites ", "en"), (None, "own\nshared line of many sites", "en")]
    docs = spark.createDataFrame([(i, t, lang, f"site{n}", len(t or "")) for n, (i, t, lang) in enumerate(rows)], "doc_id long, text string, lang string, source string, n_chars long")
    return docs.withColumns({c: F.lit("x") for c in CLASHES})


def run(spark, name, docs):
    return [(r.doc_id, r.text) for r in STAGES[name](spark, docs, D).collect()]


def test_stages_keep_all_columns(spark, hard):
    for name in list(STAGES)[:-1]:
        out = STAGES[name](spark, hard, D)
        assert out.columns == hard.columns
        assert all(r[c] == "x" for r in out.collect() for c in CLASHES)
        assert STAGES[name](spark, hard.where("false"), D).count() == 0


def test_language(spark, hard):
    got = run(spark, "language", hard)
    assert len(got) == hard.count() - 2  # the null and the empty text
    assert run(spark, "language", hard.withColumn("lang", F.lit(None).cast("string"))) == []


def test_boilerplate(spark, hard):
    got = run(spark, "boilerplate", hard)
    assert len(got) == hard.count() - 1  # document 200 was nothing else
    kept = dict(got)
    assert "shared" in kept[100] and all("shared" not in kept[100 + k] for k in range(1, 15))
    assert (None, "own\nshared line of many sites") in got and (4, None) in got and (5, "") in got


def test_duplicates(spark, hard):
    got = run(spark, "duplicates", hard)
    text = words(1, 60)
    assert sorted(i for i, t in got if t and t.startswith(text)) == [1]  # copies under 1, 2 and 3 go, the other text under 3 stays
    assert [t for i, t in got if i == 3] == [words(3, 50)]
    assert sum(i is None for i, _ in got) == 2
    assert {4, 5, 6}.issubset({i for i, _ in got})


def test_duplicates_of_plain_ids(spark, hard):
    some = hard.where("doc_id >= 4")
    assert sorted(run(spark, "duplicates", some), key=str) == sorted(((r.doc_id, r.text) for r in some.collect()), key=str)


def test_decontaminate(spark, hard):
    item = spark.read.parquet(f"{D}/benchmark.parquet").orderBy("item_id").first().text
    leak = hard.limit(1).withColumns({"text": F.lit(f"{words(7, 30)} {item} {words(8, 30)}"), "doc_id": F.lit(None).cast("long")})
    twin = leak.withColumn("doc_id", F.lit(3).cast("long"))
    got = run(spark, "decontaminate", hard.union(leak).union(twin))
    assert sorted(got, key=str) == sorted(((r.doc_id, r.text) for r in hard.collect()), key=str)


def test_tokens(spark, hard):
    import public_tokenizers

    out = STAGES["tokens"](spark, hard, D)
    back = bpe.decode(out, public_tokenizers.path("byte_bpe_50k.tiktoken")).collect()
    assert sorted(str((r.doc_id, bytes(r.decoded).decode())) for r in back) == sorted(str((r.doc_id, r.text or "")) for r in hard.collect())


def test_run(spark):
    docs = spark.read.parquet(f"{D}/documents.parquet")
    got = corpus_pipeline.run(spark, D)
    ids = [r.doc_id for r in got.collect()]
    assert len(set(ids)) == len(ids) > 100 and set(ids) <= {r.doc_id for r in docs.select("doc_id").collect()}

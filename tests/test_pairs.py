"""Queries whose rows meet in pairs, against their SQL on tables with copies, and on sizes where every pair is dear."""

import duckdb
import numpy as np
import pytest

import __spark_entry__ as entry
from tagloom.operators import pairs


def against_sql(spark, tmp_path, name, table, columns, rows):
    spark.createDataFrame(rows, columns).write.parquet(f"{tmp_path}/{table}.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{tmp_path}/{table}.parquet/*.parquet'")
    want = con.execute(entry.oracle_sql()[name])
    names = [c[0] for c in want.description]
    return sorted(map(repr, (tuple(r) for r in entry.queries()[name](spark, str(tmp_path)).select(*names).collect()))), sorted(map(repr, want.fetchall()))


def test_tokens_of_two_texts(spark, tmp_path):
    rows = [(25 * 10 + c, c, 2450.0) for c in (0, 1, 100, 203, 300)] + [(1, 7, 99.0), (2, 0, 99999.0)]
    got, want = against_sql(spark, tmp_path, "price_logic", "orders", "o_orderkey long, o_custkey long, o_totalprice double", rows)
    assert got == want


def test_overlap_of_distinct_values(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(pairs, "PAIR_CHUNK", 7)
    names = ["large ring", "ring large", "small bolt", "large bolt steel"]
    rows = [(k, names[k * 7 % 4], f"b{k % 2}", k % 3 if k % 3 else None) for k in range(90)]
    got, want = against_sql(spark, tmp_path, "token_overlap", "part", "p_partkey long, p_name string, p_brand string, p_size int", rows)
    assert got == want and len(got) > 400
    # two names make three scores, however many rows have them: millions of pairs
    spark.range(6000).selectExpr("id AS p_partkey", "if(id % 2 = 0, 'large ring', 'small ring') AS p_name", "'b' AS p_brand", "1 AS p_size").write.parquet(f"{tmp_path}/many/part.parquet")
    many = entry.queries()["token_overlap"](spark, f"{tmp_path}/many")
    assert "words" not in many._jdf.queryExecution().optimizedPlan().toString().split("Generate")[0]
    assert {(r.overlap, r.n) for r in many.groupBy("overlap").agg({"*": "count"}).toDF("overlap", "n").collect()} == {(1.0, 2 * (3000 * 2999 // 2)), (0.5, 3000 * 3000)}


def test_overlap_of_odd_names(spark, tmp_path, monkeypatch):
    """Words of one letter, signs, case, other scripts, blanks and null names: each pair of a brand and size has the SQL's overlap."""
    monkeypatch.setattr(pairs, "PAIR_CHUNK", 20)
    names = ["A B", "a c", "A", "7 7", "", " ", "x  y", "x ", None, "Large ring", "large-ring", "large ring.", "ring\tlarge", "ёлка", "елка", "é è", "日本 茶", "茶"]
    rows = [(k // 2 if k % 5 == 0 else k, names[k % 18], f"b{k % 2}" if k % 13 else None, k % 7 if k % 7 else None) for k in range(400)]
    got, want = against_sql(spark, tmp_path, "token_overlap", "part", "p_partkey long, p_name string, p_brand string, p_size int", rows)
    assert got == want and len(got) > 4000


def test_cosines_in_chunks(spark, tmp_path, monkeypatch):
    rng = np.random.default_rng(3)
    near = rng.normal(size=(60, 8)).round(2)
    rows = [(k, [float(x) for x in near[k % 60] * (1 + k // 60 % 2)], k % 2 if k % 11 else None) for k in range(400)]
    got = []
    for chunk, block in ((8192, 512), (50, 16)):
        monkeypatch.setattr(pairs, "VECTOR_CHUNK", chunk)
        monkeypatch.setattr(pairs, "BLOCK", block)
        one, want = against_sql(spark, tmp_path / str(chunk), "cosine_topk", "embeddings", "vec_id long, embedding array<float>, label int", rows)
        assert one == want
        got.append(one)
    assert got[0] == got[1]


def test_cosines_of_odd_vectors(spark, tmp_path):
    rows = [(1, [1.0, 2.0], 0), (2, [0.0, 0.0], 0), (3, None, 0), (4, [2.0, 1.0], 0), (5, [float("nan"), 1.0], 0), (6, [1.0, 1.0], 1), (7, [1.0, 1.0], None), (None, [1.0, 1.0], 0)]
    got, want = against_sql(spark, tmp_path, "cosine_topk", "embeddings", "vec_id long, embedding array<float>, label int", rows)
    assert got == want


def test_cosines_of_many_vectors(spark):
    """30,000 vectors of one label are 900 million pairs."""
    x = np.random.default_rng(4).normal(size=(30_000, 8)).astype(np.float32)
    df = spark.createDataFrame([(k, v.tolist(), 1) for k, v in enumerate(x)], "id long, v array<float>, label int")
    got = pairs.nearest(df, "label", "id", "v", 4).where("a % 1000 = 0").collect()
    unit = x.astype(float) / np.linalg.norm(x.astype(float), axis=1)[:, None]
    for q in range(0, 30_000, 1000):
        near = unit @ unit[q]
        near[q] = -2
        best = np.argsort(-near)[:4]
        mine = sorted((r.place, r.b, r.score) for r in got if r.a == q)
        assert [b for _, b, _ in mine] == best.tolist() and [s for _, _, s in mine] == pytest.approx(near[best], abs=1e-9)

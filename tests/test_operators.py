"""Operators on small tables, the order-dependent ones against plain loops."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tagloom.operators import adapters, catalog, consensus, coords, export, images, readings, sequences, tracks, votes
from tagloom.plans import registry
from tagloom.sources import config, frames, tables
from tagloom.streaming import assign


def test_votes(spark):
    rows = [("a", "179.00", 1.0, k) for k in range(3)] + [("a", "1.79", 1.2, 3 + k) for k in range(2)] + [("b", "66.00", 2.0, 0), ("b", "99.00", 3.0, 1), ("c", "10.00", 1.0, 1), ("c", "20.00", 1.0, 0), ("d", " ", 1.0, 0), ("d", None, 1.0, 1)]
    df = spark.createDataFrame(rows, "k string, v string, w double, o int")
    got = {r.k: r for r in votes.price_vote(df, ["k"], "v", "w", "o").collect()}
    assert (got["a"].winner, got["a"].weight, got["a"].shift_resolved) == ("179.00", 5.4, True)
    assert (got["b"].winner, got["b"].weight, got["b"].flip_resolved) == ("99.00", 5.0, True)
    assert got["c"].winner == "20.00" and got["c"].ambiguous and "d" not in got
    plain = {r.k: r.winner for r in votes.weighted_vote(df, ["k"], "v", "w", "o").collect()}
    assert plain == {"a": "179.00", "b": "99.00", "c": "20.00"}
    assert votes.weighted_vote(df.where("false"), ["k"], "v", "w", "o").count() == 0


def test_text_vote(spark):
    rows = [("a", "red big bolt", 1.0, 0), ("a", "red big bolt steel", 1.0, 1), ("a", "green nut", 1.5, 2), ("a", "", 9.0, 3)]
    got = votes.text_vote(spark.createDataFrame(rows, "k string, v string, w double, o int"), ["k"], "v", "w", "o").first()
    assert (got.winner, got.weight) == ("red big bolt steel", 2.0)


def test_segments(spark):
    rows = [("t", k, k, p, None, 0.9) for k, p in enumerate(["10.00"] * 3 + ["500.00"] * 3)] + [("g", k, k, p, None, 0.9) for k, p in enumerate(["10.00", "10.00", "500.00", "10.00"])]
    df = spark.createDataFrame(rows, "track string, frame int, ord int, price string, product string, score double")
    got = {(r.track, r.frame): (r.segment, r.reason, r.segment_key) for r in sequences.split_tracks(df, "track", ["frame", "ord"], "price", "product", "score").collect()}
    assert got["t", 2] == (0, None, "t__split_01") and got["t", 3] == (1, "price", "t__split_02")
    assert all(got["g", k] == (0, None, "g") for k in range(4))


def test_gap_clusters(spark):
    c = sequences.gap_clusters(F.array(*map(F.lit, (30.0, 1.0, 2.0, 3.0, 31.0))), 5.0)
    assert spark.range(1).select(c.alias("v")).first().v == [[1.0, 2.0, 3.0], [30.0, 31.0]]


def test_coordinates(spark, tmp_path):
    (tmp_path / "c.csv").write_text("frame_idx;tr_id;xyxy\n6085;id_28;100,220,480,390\n6085;28;1,1,2,2\nx;1;1,2,3,4\n7;sequence_001/id_5;[9, 8, 1, 2]\n", encoding="utf-8")
    (tmp_path / "o.csv").write_text("frame_idx,tr_id,xyxy\n6085,id_1,10,20,110,220\n", encoding="utf-8")
    raw = tables.read_delimited(spark, str(tmp_path / "c.csv"))
    table = coords.parse(raw.withColumn("row", F.monotonically_increasing_id()))
    assert table.count() == 3
    assert tuple(coords.parse(tables.read_overflowing(spark, str(tmp_path / "o.csv"))).first().bbox) == (10, 20, 110, 220)
    zero = F.struct(*[F.lit(0).alias(c) for c in ("x1", "y1", "x2", "y2")])
    obs = spark.createDataFrame([("a", 6085, "track_28", "s"), ("b", 7, "5", "sequence_001"), ("c", 1, "28", "s")], "observation_id string, frame_index int, track_id string, sequence_name string").withColumn("bbox", zero)
    got = {r.observation_id: (tuple(r.original_bbox), r.bbox_source) for r in coords.lookup(obs, table).collect()}
    assert got == {"a": ((100, 220, 480, 390), "csv"), "b": ((1, 2, 9, 8), "csv"), "c": ((0, 0, 0, 0), "crop")}


def test_catalog_decision(spark):
    make = lambda **k: F.struct(*[F.lit(v).alias(n) for n, v in {"item_id": "1", "name": "red bolt", "brand": "x", "score": 0.9, "text_score": 0.6, "price_score": 1.0, "kind": "text", **k}.items()])
    none = F.when(F.lit(False), make())
    v = lambda c: spark.range(1).select(c.alias("v")).first().v
    no = F.lit(False)
    assert v(catalog.decide(make(), none, no, no)) == "matched"
    assert v(catalog.decide(make(), make(item_id="2", name="other thing"), no, no)) == "ambiguous"
    assert v(catalog.decide(none, none, no, no)) == "not_found"
    assert v(catalog.decide(make(kind="price"), none, no, no)) == "price_only_candidates"
    assert v(catalog.decide(make(text_score=0.3, price_score=0.0), none, no, no)) == "weak_match"
    assert v(catalog.decide(make(), none, F.lit(True), no)) == "query_too_weak"
    assert tuple(v(catalog.corrected_price(F.lit(100.0), F.lit(150.0), F.array(F.lit(100.0))))) == (100.0, True)


def test_readings(spark):
    lines = [("Молоко домик", 0.9, 10, 5, 200, 30), ("129", 0.9, 20, 100, 120, 180), ("99", 0.8, 125, 100, 160, 140), ("4601234567890", 0.9, 10, 190, 150, 200)]
    df = spark.createDataFrame([(lines,)], f"lines {readings.LINE}")
    got = df.select(readings.fields(F.col("lines"), F.lit("shelf_red_promo"), F.lit(220), F.lit(210), F.lit(90)).alias("f")).first().f
    assert (got.main_price, got.product_name) == ("129.99", "Молоко домик")
    stack = spark.createDataFrame([([("129", 0.9, 0, 0, 30, 10), ("99", 0.9, 2, 20, 28, 30), ("45", 0.9, 3, 40, 27, 50)],)], f"lines {readings.LINE}").select(readings.vertical_stack(F.col("lines")).alias("s")).first().s
    assert stack.n == 3 and stack.suspicious


def test_consensus():
    feature = np.array([1.0, 0.0])
    row = lambda p, s, f=feature: {"score": s, "price": p, "product": "red bolt", "template": "t", "text": f"red bolt {p}", "feature": f, "focus": 0.5}
    got = consensus.cluster([row("10.00", 0.9), row("10.00", 0.8), row("99.00", 0.7, np.array([0.0, 1.0]))])
    assert [g["selected"] for g in got] == [True, True, False] and got[0]["reference"]


def test_components(spark):
    edges = spark.createDataFrame([(k, k + 1) for k in range(20)] + [(50, 60)], "a long, b long")
    assert {r.id: r.component for r in consensus.components(edges).collect()} == {**dict.fromkeys(range(21), 0), 50: 50, 60: 50}


def test_images(spark):
    picture = np.zeros((80, 120, 3), np.uint8)
    picture[:, :, 0] = 220
    picture[20:40, 30:60] = 255
    data = b"P6 120 80 255\n" + picture.tobytes()
    got = {r.path: r for r in images.measure(spark.createDataFrame([("a", bytearray(data)), ("b", bytearray(b"junk")), ("c", None)], "path string, content binary")).collect()}
    assert (got["a"].quality.width, got["a"].color, got["a"].error) == (120, "red", None)
    assert got["b"].error == got["c"].error == "unreadable" and sum(got["a"].regions["full"].values()) == pytest.approx(1)
    assert images.runs(np.array([0, 1, 1, 0, 1], bool)) == [(1, 3), (4, 5)]
    assert images.peaks(np.array([0, 5, 0, 4, 0, 9.0]), 3, 1) == [1, 3, 5]
    rail = np.full((40, 300, 3), 200, np.uint8)
    rail[:, 98:102] = rail[:, 198:202] = 0
    assert len(images.split_rail(rail, 100)) == 3


def test_adapters(spark):
    df = spark.createDataFrame([("a", bytearray(b"x")), ("b", bytearray(b"bad"))], "path string, content binary")

    class Reader:
        def recognize_batch(self, data):
            if b"bad" in data:
                raise ValueError("bad")
            return [[{"text": "1", "conf": 1.0}] for _ in data]

    got = {r.path: r for r in adapters.recognize(df, Reader).collect()}
    assert got["a"].error is None and got["b"].error == "ValueError: bad"
    assert adapters.decode_codes(df, adapters.NullReader).count() == 0
    assert adapters.first_json('noise {"a": 1} {"b": 2}') == {"a": 1}


def test_frames(spark, tmp_path):
    for name in ("s1/id_7/6085.jpg", "s1/id_7/5895.jpg", "s1/id_7/05895.jpg", "s1/id_7/notes.txt", "s1/.cache/1.jpg", "s1/x/cover.png"):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_bytes(b"x")
    got = [(r.track_key, r.frame_index, r.ord) for r in frames.tracks(frames.list_images(spark, str(tmp_path))).orderBy("track_key", "ord").collect()]
    assert got == [("s1/id_7", 5895, 0), ("s1/id_7", 6085, 1), ("s1/id_7", 589500001, 2), ("s1/x", 0, 0)]


def test_config(tmp_path):
    (tmp_path / "c.yaml").write_text("a:\n  b: 2\n")
    c = config.load(str(tmp_path / "c.yaml"), {"a": {"b": 1, "c": 3}}, {"a.d": 4, "a.c": None})
    assert c == {"a": {"b": 2, "c": 3, "d": 4}} and config.get(c, "a.x", 9) == 9


def test_export(spark, tmp_path):
    got = registry.task_output(spark, "/root/testdata/sf0.001")
    assert got.columns == list(export.TASK_FIELDS) and got.count() > 100
    tables.write_delimited(got.limit(5), str(tmp_path / "t"), "\t", mark=True)
    assert next((tmp_path / "t").glob("part-*")).read_text(encoding="utf-8").startswith("\ufeff")
    t = registry.track_rows(spark, "/root/testdata/sf0.001")
    assert t.columns == list(export.TRACK_FIELDS) and len(t.columns) == 35 and t.count() == got.count()
    f = registry.frame_rows(spark, "/root/testdata/sf0.001")
    assert f.columns == list(export.FRAME_FIELDS) and len(f.columns) == 25 and f.count() == 6000
    nested = spark.createDataFrame([(1, [1, 2], None)], "a int, b array<int>, c string")
    assert tuple(tables.flat(nested).first()) == ("1", "[1,2]", "")


def test_ocr_json(spark):
    rows = [('{"rec_texts": ["a", "a", ""], "rec_scores": [0.5, 0.5, 0.9], "rec_polys": [[[0,0]], [[0,0]], [[1,1]]]}',), ('[[[[0,0],[1,1]], ["b", 0.7]]]',), (None,)]
    got = [r.v for r in spark.createDataFrame(rows, "j string").select(tables.parse_ocr(F.col("j")).alias("v")).collect()]
    assert [x.text for x in got[0]] == ["a"] and [x.text for x in got[1]] == ["b"] and got[2] is None


def test_assignment_batch_and_stream(spark, tmp_path):
    rows = [("s", f"{k}a", k, 10 * k, 0, 10 * k + 100, 50, "10.00", "bolt") for k in range(6)] + [("s", f"{k}b", k, 900, 0, 1000, 50, "20.00", "nut") for k in range(6)] + [("s", "40a", 40, 10, 0, 110, 50, "10.00", "bolt")]
    schema = "sequence_name string, observation_id string, frame_index int, x1 int, y1 int, x2 int, y2 int, main_price string, product_name string"
    df = spark.createDataFrame(rows, schema)
    want = {r.observation_id: r.track for r in assign.assign(df).collect()}
    assert len({want[f"{k}a"] for k in range(6)}) == len({want[f"{k}b"] for k in range(6)}) == 1 and want["40a"] == 3
    df.coalesce(1).write.parquet(str(tmp_path / "in"))
    q = assign.assign_stream(spark.readStream.schema(schema).parquet(str(tmp_path / "in"))).writeStream.format("memory").queryName("assigned").option("checkpointLocation", str(tmp_path / "state")).start()
    q.processAllAvailable()
    q.stop()
    assert {r.observation_id: r.track for r in spark.table("assigned").collect()} == want


def test_recovery(spark):
    o = registry.observations(spark, "/root/testdata/sf0.001")
    picked = tracks.recovery_frames(tracks.scored(o), "track_key")
    assert picked.groupBy("track_key").count().agg(F.max("count")).first()[0] <= 3
    assert tracks.recovered(o, o.limit(1)).count() == o.count() + 1


def test_more_readings(spark):
    v = lambda c: spark.range(1).select(c.alias("v")).first().v
    code = lambda payload, fmt="qr", decoded=True: F.struct(F.lit("code").alias("kind"), F.lit(decoded).alias("decoded"), F.lit(payload).alias("payload"), F.lit(fmt).alias("fmt"), F.array(*map(F.lit, (1, 2, 3, 4))).alias("bbox"))
    codes = F.array(code("4601234567890", "ean"), code("b=1", "qr"), code("b=1", "qr"), code("", "qr", False))
    assert len(v(readings.codes_of(codes))) == 3
    assert (v(readings.qr_payload(codes)), v(readings.barcode(codes)), v(readings.has_code(codes))) == ("b=1", "4601234567890", True)
    assert v(readings.observed_prices(F.array(F.lit("1299"), F.lit("x")), F.array(F.lit("12,99")))) == ["12.99"]
    assert v(readings.select_name(F.array(F.lit("129"), F.lit("Молоко домик в деревне 900 мл")))) == "Молоко домик в деревне 900 мл"
    band = lambda s, a, b: F.struct(F.lit(s).alias("score"), F.lit(a).alias("lo"), F.lit(b).alias("hi"))
    assert [(b.lo, b.hi) for b in v(readings.merge_bands(F.array(band(0.5, 10.0, 20.0), band(0.9, 12.0, 22.0), band(0.7, 80.0, 90.0)), F.lit(100.0)))] == [(10.0, 22.0), (80.0, 90.0)]
    assert v(readings.flat_regions(F.create_map(F.lit("top"), F.create_map(F.lit("red"), F.lit(0.5))))) == {"cn.top.red": 0.5}
    assert [t for t in v(readings.text_sources(F.lit("a"), F.lit(""), F.lit("a"), F.lit("b")))] == ["a", "b"]
    got = v(readings.price_only(F.lit("1.79"), F.create_map(F.lit("main_price"), F.array(F.lit("179.00"))), F.array(F.lit("179")), F.lit(None).cast("array<string>"), F.array().cast(readings.LINE)))
    assert got[0].value == "179.00" and {c.value for c in got} == {"179.00", "1.79"}


def test_more_images():
    a = np.full((60, 120, 3), 120, np.uint8)
    a[20:24], a[40:44] = 10, 10
    assert abs(images.tilt(images.turn(a, 7.0)) + 7.0) <= 1.0
    a[5:8, 5:8] = 250
    assert images.tame_glare(a)[6, 6].max() < 200
    assert images.crop(a, -5, -5, 10, 10).shape == (10, 10, 3) and images.enlarge(a, 100).shape == (120, 240, 3)
    red = np.full((100, 50, 3), 230, np.uint8)
    red[55:] = (220, 20, 20)
    assert images.warm_panels(red) == [(0, 55, 50, 100)] and images.split_line(red) == 0.55

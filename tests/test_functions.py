"""Scalar functions on values whose results follow from the rules."""

import pytest
from pyspark.sql import functions as F

from tagloom.functions import geometry, price, scores, text


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


@pytest.mark.parametrize(
    ("given", "want"),
    [("1299", "12.99"), ("179", "179.00"), ("12,5", "12.50"), ("1.299.50", "1.29"), ("nan", None), ("", None), (None, None), ("99 руб", "99.00"), ("-5", "5.00"), ("abc", None)],
)
def test_normalize(spark, given, want):
    assert value(spark, price.normalize(F.lit(given).cast("string"))) == want


def test_prices(spark):
    v = lambda c: value(spark, c)
    assert v(price.integer_rubles(F.lit("1З9"))) == "139.00"
    assert [tuple(x) for x in v(price.candidates(F.lit("129 99 ₽ 1250"), True))] == [(129.99, 0.75), (1.29, 0.55), (12.5, 0.55)]
    assert v(price.shift_key(F.lit("179.00"))) == v(price.shift_key(F.lit("1.79"))) == "179"
    assert v(price.alias_key(F.lit("66.00"))) == v(price.alias_key(F.lit("99.00"))) == "gg"
    assert v(price.compatible(F.lit("100.00"), F.lit("115.00"))) and not v(price.compatible(F.lit("100.00"), F.lit("250.00")))
    assert v(price.resolve_shift(F.lit("1.79"), F.array(F.lit("179.00"), F.lit("80.00")))) == "179.00"
    assert v(price.repair_kopecks(F.lit("129.00"), F.lit("всего 129 99 за шт"))) == "129.99"
    assert v(price.badge_price(F.array(F.lit("x"), F.lit("28%129 99")))) == "129.99"
    assert v(price.badge_price(F.array(F.lit("x")))) is None
    assert v(price.suspicious_default(F.lit("5.00"), F.lit("100.00"), F.lit(True)))
    assert v(price.from_compact(F.lit("12999")))["price"] == "129.99"
    assert v(price.tolerant_int(F.lit("frame 17b"))) == 17
    assert v(price.has_flips(F.array(F.lit("66.00"), F.lit("99.00"))))
    assert [x.value for x in v(price.dedupe_candidates(F.array(*[F.struct(F.lit(a).alias("value"), F.lit(b).alias("confidence")) for a, b in ((1.0, 0.5), (2.0, 0.9), (1.0, 0.7))])))] == [2.0, 1.0]


def test_texts(spark):
    v = lambda c: value(spark, c)
    assert v(text.volume(F.lit("Сыр 900гр."))) == "900 г"
    assert v(text.country(F.lit("чай (Китай), Россия"))) == "Китай"
    assert v(text.discount_percent(F.lit("скидка до 28%"))) == "28%"
    assert v(text.alcohol_percent(F.lit("вино красное 12,5%"))) == "12.5%"
    assert v(text.sold_out(F.lit("Упс, товар закончился")))["status"] == "out_of_stock"
    assert v(text.content_tokens(F.lit("Цена Сыр 12 345 сыр"))) == ["сыр", "345"]
    assert v(text.overlap(F.lit("red big bolt"), F.lit("bolt red"))) == 1.0
    assert v(text.similarity(F.lit("red bolt"), F.lit("red bolt"))) == pytest.approx(1.0)
    assert v(text.similarity(F.lit("aaaa"), F.lit("zzzz"))) == 0.0
    assert v(text.query_guard(F.lit("ab")))["weak"] and not v(text.query_guard(F.lit("молоко простоквашино")))["weak"]
    assert v(text.shorten(F.lit("abcdef"), 4)) == "abc…"
    assert v(text.product_type(F.lit("пиво"), F.lit(""), F.lit(None), F.lit(None), F.lit(None))) == "alcohol"
    assert v(text.repair(F.lit("MOлoко"))) == "молоко"
    assert v(text.name_quality(F.lit("товар закончился"))) == 0.0 < v(text.name_quality(F.lit("Молоко домик в деревне 900 мл")))


def test_geometry(spark):
    v = lambda c: value(spark, c)
    a, b = geometry.box(*map(F.lit, (0, 0, 10, 10))), geometry.box(*map(F.lit, (15, 10, 5, 0)))
    assert v(geometry.iou(a, b)) == pytest.approx(50 / 150)
    assert tuple(v(geometry.parse_xyxy(F.lit("[4, 3, 1.5, 2]")))) == (1, 2, 4, 3)
    assert v(geometry.parse_xyxy(F.lit("1,2"))) is None
    assert v(geometry.parse_payload(F.lit("https://x/?b=460&p1=99&p1=98&aC=7#z"))) == {"b": "460", "p1": "98", "ac": "7"}
    p = geometry.parse_payload(F.lit("barcode=460;price1=119.99"))
    assert (v(geometry.payload_field(p, "barcode")), v(geometry.payload_field(p, "price1")), v(geometry.payload_field(p, "price2"))) == ("460", "119.99", None)
    assert v(geometry.cosine(F.array(F.lit(1.0), F.lit(0.0)), F.array(F.lit(1.0), F.lit(1.0)))) == pytest.approx(0.5**0.5)
    assert v(geometry.frame_timestamp(F.lit(None).cast("long"), F.lit("a/ts_77.jpg"), F.lit(5), F.lit(25))) == 77
    assert sum(v(geometry.softmax_near(F.array(F.lit(1.0), F.lit(2.0)), 1.0))) == pytest.approx(1)
    assert [e.key for e in v(geometry.top_entries(F.create_map(F.lit("a"), F.lit(1), F.lit("b"), F.lit(3), F.lit("c"), F.lit(2)), 2))] == ["b", "c"]


def test_scores(spark):
    v = lambda c: value(spark, c)
    red = F.create_map(F.lit("full"), F.create_map(F.lit("red"), F.lit(0.5), F.lit("white"), F.lit(0.5)), F.lit("bottom"), F.create_map(F.lit("red"), F.lit(0.9)), F.lit("lower_left"), F.create_map(F.lit("red"), F.lit(0.9)))
    got = v(scores.classify(red, F.lit(1.2), F.lit(False)))
    assert got.template == "shelf_red_promo" and 0 < got.confidence <= 1
    assert v(scores.classify(F.create_map().cast("map<string,map<string,double>>"), F.lit(9.0), F.lit(False))).template == "small_blurry_or_unknown"
    assert v(scores.frame_quality(F.lit(160.0), F.lit(0.0), F.lit(0.0), F.lit(1.0), F.lit(True), F.lit(True), F.lit(False))) == 1.0
    assert v(scores.visual_doubt(F.lit(0.5), F.lit(200_000), F.lit(0.6), F.lit(0.5), F.lit(0.5), F.lit(0.1))) == 0.72

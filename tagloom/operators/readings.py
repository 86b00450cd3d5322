"""Recognised text lines of one tag, as array<struct<text, conf, x1, y1, x2, y2>>: prices, anchors, names, stacks (no shuffle)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tagloom.functions import geometry, price, text

LINE = "array<struct<text:string,conf:double,x1:int,y1:int,x2:int,y2:int>>"
PAIR = "array<struct<score:double,price:string,kind:string,x1:int,y1:int,x2:int,y2:int>>"


def product_lines(lines: Column, red_top: Column, width: Column, height: Column) -> Column:
    """Lines that can belong to the product's name."""
    small = lambda n: text.mostly_numeric(n["text"]) & (F.length(text.digits_only(n["text"])) <= 3)
    corner = lambda n: text.mostly_numeric(n["text"]) & (n["x1"] > 0.58 * width) & (n["y2"] < 0.45 * height)
    return F.filter(lines, lambda n: (n["y2"] <= red_top - 5) & (n["conf"] >= 0.35) & ~text.barcode_like(n["text"]) & ~F.lower(n["text"]).rlike(rf"(?U){text.SERVICE_WORDS}") & ~small(n) & ~corner(n))


def anchor(lines: Column, words: str) -> Column:
    """The first line that has one of the words (a pattern)."""
    return F.get(F.filter(lines, lambda n: F.lower(n["text"]).rlike(words)), F.lit(0))


def price_of(lines: Column, line: Column) -> Column:
    """struct<score, price, kind, box> for a line of rubles: with the kopecks to its right, or compact, or whole."""
    h, w = line["y2"] - line["y1"], line["x2"] - line["x1"]
    right = F.filter(lines, lambda k: text.kopeck_candidate(k["text"], k["conf"]) & (k["x1"] >= line["x1"] + 0.5 * w) & (k["x1"] <= line["x2"] + 1.2 * w) & (k["y1"] >= line["y1"] - 0.6 * h) & (k["y2"] <= line["y2"] + 0.4 * h) & ((k["y2"] - k["y1"]) <= 0.95 * h))
    rated = F.transform(right, lambda k, i: F.struct((k["conf"] - F.abs(k["x1"] - line["x2"]) / F.greatest(F.lit(1), w).cast("double") * 0.5).alias("fit"), (-i).alias("down"), k.alias("k")))
    best = F.array_max(rated)["k"]
    digits = text.digits_only(line["text"])
    rubles = digits.try_cast("int")
    make = lambda score, value, kind, other: F.struct(score.cast("double").alias("score"), value.alias("price"), F.lit(kind).alias("kind"), F.least(line["x1"], other["x1"]).alias("x1"), F.least(line["y1"], other["y1"]).alias("y1"), F.greatest(line["x2"], other["x2"]).alias("x2"), F.greatest(line["y2"], other["y2"]).alias("y2"))
    return F.when(best.isNotNull() & (F.length(digits) <= 4), make(line["conf"] + 0.25, price.pair_text(rubles, text.digits_only(best["text"]).try_cast("int")), "pair", best)).when(
        F.length(digits).between(4, 5), make(line["conf"] * 0.85, price.from_compact(line["text"])["price"], "compact", line)
    ).when(F.length(digits).between(2, 3), make(line["conf"] * 0.7, F.concat(rubles.cast("string"), F.lit(".00")), "whole", line))


def price_pairs(lines: Column, most_overlap: float = 0.25) -> Column:
    """Prices that the lines make, best first; of overlapping ones the best stays."""
    rubles = F.filter(lines, lambda n: text.ruble_candidate(n["text"], n["conf"]))
    found = F.filter(F.transform(rubles, lambda n: price_of(lines, n)), lambda p: p.isNotNull())
    return keep_best(found, most_overlap, PAIR)


def keep_best(boxes: Column, most_overlap: float, kind: str) -> Column:
    """Greedy suppression: boxes by falling score (their first field), each kept unless it overlaps one kept before."""
    ordered = F.reverse(F.array_sort(F.transform(boxes, lambda b, i: F.struct(b["score"].alias("score"), (-i).alias("down"), b.alias("b")))))
    return F.aggregate(ordered, F.array().cast(kind), lambda kept, o: F.when(F.exists(kept, lambda k: geometry.iou(k, o["b"]) > most_overlap), kept).otherwise(F.concat(kept, F.array(o["b"]))).cast(kind))


def near_anchor(pairs: Column, anchor_: Column, side: str, width: Column, height: Column) -> Column:
    """The price nearest an anchor on one side of it (left, right or any), nearness and score together."""
    cx, cy = (anchor_["x1"] + anchor_["x2"]) / 2, (anchor_["y1"] + anchor_["y2"]) / 2
    mid = lambda p: (p["x1"] + p["x2"]) / 2
    gate = {"left": lambda p: mid(p) <= cx + 0.12 * width, "right": lambda p: mid(p) >= cx - 0.12 * width, "any": lambda p: F.lit(True)}[side]
    fit = lambda p: p["score"] - F.sqrt(F.pow((mid(p) - cx) / width, 2) + F.pow(((p["y1"] + p["y2"]) / 2 - cy) / height, 2)) + F.when(p["y1"] >= anchor_["y1"], 0.10).otherwise(0.0)
    rated = F.transform(F.filter(pairs, gate), lambda p: F.struct(fit(p).alias("fit"), p.alias("p")))
    return F.array_max(rated)["p"]


def main_price(pairs: Column, width: Column, height: Column) -> Column:
    """The price of a promotion tag: large, low and to the right."""
    size = lambda p: geometry.area(p) / (width * height).cast("double")
    rated = F.transform(pairs, lambda p, i: F.struct((3.0 * size(p) + 0.35 * p["y2"] / height + 0.15 * p["x2"] / width + 0.25 * p["score"]).alias("fit"), (-i).alias("down"), p.alias("p")))
    return F.array_max(rated)["p"]


def vertical_stack(lines: Column) -> Column:
    """The largest group of two- or three-digit lines above one another: struct<n, texts, suspicious>."""
    digits = F.filter(lines, lambda n: F.length(text.digits_only(n["text"])).between(2, 3) & text.mostly_numeric(n["text"]))
    mid = lambda n: (n["x1"] + n["x2"]) / 2
    groups = F.transform(digits, lambda a: F.filter(digits, lambda b: F.abs(mid(a) - mid(b)) <= F.greatest(F.lit(24.0), 0.35 * (a["x2"] - a["x1"]))))
    best = F.array_max(F.transform(groups, lambda g, i: F.struct(F.size(g).alias("n"), (-i).alias("down"), F.transform(g, lambda n: text.digits_only(n["text"])).alias("texts"))))
    rows = F.coalesce(best["n"], F.lit(0))
    two, three = F.exists(best["texts"], lambda t: F.length(t) == 2), F.exists(best["texts"], lambda t: F.length(t) == 3)
    return F.struct(rows.alias("n"), F.coalesce(best["texts"], F.array().cast("array<string>")).alias("texts"), F.coalesce((rows >= 3) & two & three, F.lit(False)).alias("suspicious"))


def fields(lines: Column, template: Column, width: Column, height: Column, red_top: Column) -> Column:
    """struct<main_price, card_price, default_price, product_name, discount> of a tag's lines by its template."""
    pairs = price_pairs(lines)
    card, plain = anchor(lines, "с карт"), anchor(lines, "без карт|обычн|старая")
    name = F.array_join(F.transform(product_lines(lines, red_top, width, height), lambda n: n["text"]), " ")
    joined = F.array_join(F.transform(lines, lambda n: n["text"]), " | ")
    promo = template.isin("shelf_red_promo", "progressive_price_tag", "progressive_yellow", "hanging_yellow_promo_large")
    default = F.when(promo & plain.isNotNull(), near_anchor(pairs, plain, "any", width, height)["price"])
    return F.struct(
        main_price(pairs, width, height)["price"].alias("main_price"), F.when(promo & card.isNotNull(), near_anchor(pairs, card, "any", width, height)["price"]).alias("card_price"), default.alias("default_price"),
        text.clean_name(name).alias("product_name"), F.when(promo, text.percent(joined)).alias("discount"),
    )


def mean_confidence(lines: Column) -> Column:
    return F.when(F.size(lines) > 0, F.aggregate(lines, F.lit(0.0), lambda s, n: s + n["conf"]) / F.size(lines))


def price_only(main: Column, by_zone: Column, spatial: Column, parsed: Column, lines: Column) -> Column:
    """Price candidates of a result from all its sources, best score for each value, best first, at most six.

    `main` price text, `by_zone` map of zone to prices, `spatial` and `parsed` price texts, `lines` the tag's lines.
    """
    one = lambda t, s, source: F.struct(price.normalize(t).alias("value"), F.lit(s).cast("double").alias("score"), F.lit(source).alias("source"))
    listed = lambda xs, s, source: F.transform(F.coalesce(xs, F.array().cast("array<string>")), lambda t: one(t, s, source))
    zones = F.flatten(F.transform(F.map_entries(F.coalesce(by_zone, F.create_map().cast("map<string,array<string>>"))), lambda e: F.transform(F.slice(e["value"], 1, 3), lambda t: F.struct(price.normalize(t).alias("value"), F.when(e["key"].startswith("main_price"), 0.70).otherwise(0.58).alias("score"), F.lit("by_zone").alias("source")))))
    clean = F.filter(lines, lambda n: ~F.contains(n["text"], F.lit("%")) & ~F.lower(n["text"]).rlike("qr|ean|штрих|баркод|barcode|номер|код"))
    direct = F.transform(clean, lambda n: F.struct(F.coalesce(price.first_price(n["text"]), price.integer_rubles(n["text"])).alias("value"), (0.78 + F.least(F.lit(0.12), F.greatest(F.lit(0.0), n["conf"] - 0.70) * 0.20) + F.when(n["text"].rlike(r"\d[.,]\d\d\b"), 0.05).when(n["text"].rlike(r"^\s*\d{2,3}\s*$"), 0.08).otherwise(0.02)).alias("score"), F.lit("line").alias("source")))
    every = F.filter(F.concat(F.array(one(main, 0.74, "main")), zones, listed(spatial, 0.80, "spatial"), listed(parsed, 0.72, "parsed"), direct), lambda c: c["value"].isNotNull())
    rated = F.reverse(F.array_sort(F.transform(every, lambda c, i: F.struct(F.greatest(F.lit(0.50), F.least(F.lit(0.96), c["score"])).alias("score"), (-i).alias("down"), c["value"].alias("value"), c["source"].alias("source")))))
    firsts = F.filter(F.transform(rated, lambda c, i: F.struct(c["value"].alias("value"), c["score"].alias("score"), c["source"].alias("source"), i.alias("i"))), lambda c: ~F.exists(F.slice(rated, F.lit(1), c["i"]), lambda o: o["value"] == c["value"]))
    large = F.filter(firsts, lambda c: price.is_integer_rubles(c["value"]) & (c["value"].try_cast("double") >= 5))
    top = F.get(firsts, F.lit(0))
    lead = F.when((top["value"].try_cast("double") < 5) & (F.size(large) > 0), F.get(large, F.lit(0))).otherwise(top)
    ordered = F.concat(F.filter(F.array(lead), lambda c: c.isNotNull()), F.filter(firsts, lambda c: c["i"] != lead["i"]))
    return F.transform(F.slice(ordered, 1, 6), lambda c: F.struct(c["value"].alias("value"), F.round(c["score"], 4).alias("score"), c["source"].alias("source")))


def zone_boxes(template: Column, width: Column, height: Column, split_y: Column) -> Column:
    """array<struct<zone, x1, y1, x2, y2>> of a template's zones in pixels; `split_y` is a fraction."""
    s = split_y
    low = lambda a, b: F.least(F.lit(a), s + b)
    high = lambda a, b: F.greatest(F.lit(a), s + b)
    zones = {  # fixed values: fractions of width and height
        "hanging_yellow_promo_large": {"promo_header": (0.03, 0.02, 0.97, 0.24), "product_name": (0.04, 0.24, 0.64, 0.42), "scale_number": (0.78, 0.23, 0.98, 0.50), "old_price": (0.05, 0.43, 0.43, 0.76), "main_price": (0.56, 0.40, 0.98, 0.92), "main_price_rubles": (0.60, 0.48, 0.86, 0.90), "main_price_kopeeks": (0.83, 0.43, 0.97, 0.74), "footer_note": (0.02, 0.84, 0.45, 0.98)},
        "shelf_red_promo": {"product_name": (0.055, 0.055, 0.565, high(0.28, -0.055)), "qr": (0.595, 0.045, 0.885, high(0.31, -0.09)), "card_small": (0.345, high(0.24, -0.165), 0.545, low(0.52, 0.015)), "no_card_small": (0.585, high(0.24, -0.165), 0.875, low(0.52, 0.015)), "promo_label": (0.04, s + 0.03, 0.325, low(0.80, 0.34)), "main_price": (0.50, s + 0.045, 0.91, low(0.79, 0.34)), "main_price_rubles": (0.545, s + 0.075, 0.755, low(0.775, 0.325)), "main_price_kopeeks": (0.735, s + 0.055, 0.91, low(0.70, 0.235)), "barcode": (0.42, high(0.78, 0.37), 0.845, 0.915), "digits": (0.35, 0.855, 0.95, 0.985), "article": (0.045, 0.74, 0.335, 0.905)},
        "progressive_price_tag": {"product_name": (0.045, 0.045, 0.62, high(0.30, -0.045)), "qr": (0.585, 0.04, 0.90, high(0.30, -0.065)), "card_small": (0.06, high(0.28, -0.12), 0.38, low(0.58, 0.06)), "no_card_small": (0.38, high(0.28, -0.12), 0.69, low(0.58, 0.06)), "main_price": (0.16, s + 0.03, 0.90, low(0.86, 0.38)), "main_price_rubles": (0.23, s + 0.065, 0.72, low(0.84, 0.36)), "main_price_kopeeks": (0.69, s + 0.04, 0.91, low(0.74, 0.25)), "unit": (0.045, low(0.78, 0.34), 0.485, 0.965), "barcode": (0.43, low(0.78, 0.34), 0.90, 0.945)},
        "shelf_white_regular": {"product_name": (0.04, 0.04, 0.72, 0.42), "qr": (0.60, 0.04, 0.90, 0.42), "main_price": (0.25, 0.38, 0.82, 0.78), "unit": (0.03, 0.65, 0.50, 0.94), "barcode": (0.38, 0.72, 0.82, 0.92)},
        "other": {"full_tag_text": (0.03, 0.03, 0.97, 0.97)},
    }
    px = lambda v, size: F.bround((v if isinstance(v, Column) else F.lit(v)) * size).cast("int")
    made = {t: F.array(*[F.struct(F.lit(z).alias("zone"), px(a, width).alias("x1"), px(b, height).alias("y1"), px(c, width).alias("x2"), px(d, height).alias("y2")) for z, (a, b, c, d) in boxes.items()]) for t, boxes in zones.items()}
    out = made["other"]
    for t in ("shelf_white_regular", "shelf_red_promo", "hanging_yellow_promo_large"):
        out = F.when(template == t, made[t]).otherwise(out)
    return F.when(template.startswith("progressive"), made["progressive_price_tag"]).otherwise(out)


def replace_weak(base: Column, new: Column, least: float = 0.5) -> Column:
    """Boxes (with zone and conf) of `base`, those of low confidence replaced by detected ones of their zone; other detected zones are added."""
    found = lambda z: F.get(F.filter(new, lambda n: n["zone"] == z), F.lit(0))
    kept = F.transform(base, lambda b: F.when((b["conf"] < least) & found(b["zone"]).isNotNull(), found(b["zone"])).otherwise(b))
    return F.concat(kept, F.filter(new, lambda n: ~F.exists(base, lambda b: b["zone"] == n["zone"])))


def codes_of(*sources: Column, most: int = 16) -> Column:
    """Codes of all sources (structs with kind, decoded, payload, fmt, bbox), decoded ones distinct by kind, format and payload, others by place."""
    every = F.concat(*[F.coalesce(s, F.array()) for s in sources])
    mark = lambda c: F.when(c["decoded"], F.concat_ws("|", c["kind"], c["fmt"], c["payload"])).otherwise(F.concat_ws("|", F.lit("box"), F.transform(c["bbox"], lambda v: F.floor(v / 12).cast("string"))))
    marked = F.transform(every, lambda c, i: F.struct(c.alias("c"), mark(c).alias("m"), i.alias("i")))
    firsts = F.filter(marked, lambda x: ~F.exists(F.slice(marked, F.lit(1), x["i"]), lambda o: o["m"] == x["m"]))
    return F.slice(F.transform(firsts, lambda x: x["c"]), 1, most)


def qr_payload(codes: Column) -> Column:
    """The payload of the first QR-like decoded code, else of the first decoded one."""
    read = F.filter(codes, lambda c: c["decoded"] & (F.coalesce(c["payload"], F.lit("")) != ""))
    return F.coalesce(F.get(F.filter(read, lambda c: F.lower(F.concat_ws(" ", c["kind"], c["fmt"])).contains("qr")), F.lit(0))["payload"], F.get(read, F.lit(0))["payload"])


def barcode(codes: Column) -> Column:
    """The first decoded code of 8 to 14 digits."""
    return F.get(F.filter(codes, lambda c: c["decoded"] & c["payload"].rlike(r"^\d{8,14}$")), F.lit(0))["payload"]


def text_sources(*texts: Column) -> Column:
    """Distinct texts in order; the first 500 characters tell them apart."""
    every = F.filter(F.array(*texts), lambda t: F.coalesce(F.trim(t), F.lit("")) != "")
    indexed = F.transform(every, lambda t, i: F.struct(t.alias("t"), i.alias("i")))
    return F.transform(F.filter(indexed, lambda x: ~F.exists(F.slice(every, F.lit(1), x["i"]), lambda o: F.substring(o, 1, 500) == F.substring(x["t"], 1, 500))), lambda x: x["t"])


def observed_prices(*sources: Column, most: int = 20) -> Column:
    """Distinct prices of all sources (arrays of text) at cents, in order of first sight, `most` at most."""
    every = F.flatten(F.array(*[F.coalesce(s, F.array().cast("array<string>")) for s in sources]))
    return F.slice(F.array_distinct(F.filter(F.transform(every, price.normalize), lambda p: p.isNotNull())), 1, most)


def select_name(candidates: Column, least: float = 0.35) -> Column:
    """Of some texts the one that looks most like a product name (the first such), cleaned; null if none does."""
    rated = F.transform(candidates, lambda c, i: F.struct(text.name_quality(c).alias("score"), (-i).alias("down"), text.clean_name(c).alias("name")))
    best = F.array_max(F.filter(rated, lambda r: (r["score"] >= least) & r["name"].isNotNull()))
    return text.candidate_name(best["name"])


def has_code(codes: Column) -> Column:
    """Whether any code was decoded to something."""
    return F.coalesce(F.exists(codes, lambda c: c["decoded"] & (F.coalesce(c["payload"], F.lit("")) != "")), F.lit(False))


def regions_to_read(regions: Column, width: Column, height: Column, most: int = 8) -> Column:
    """Regions (structs with score, hint and a box) to look for codes in: hints first, then large and central ones, `most` in all."""
    central = lambda r: 1 - F.abs((r["x1"] + r["x2"]) / 2 - width / 2) / width
    worth = lambda r: F.when(r["hint"], 2.0).otherwise(0.0) + r["score"] + geometry.area(r) / (width * height).cast("double") + 0.2 * central(r)
    ordered = F.reverse(F.array_sort(F.transform(regions, lambda r, i: F.struct(worth(r).alias("worth"), (-i).alias("down"), r.alias("r")))))
    return F.transform(F.slice(ordered, 1, most), lambda o: o["r"])


def merge_bands(bands: Column, height: Column) -> Column:
    """Bands (structs score, lo, hi) by falling score, each merged into a kept one it overlaps by .45 or lies within .06 of the height of."""
    kind = "array<struct<score:double,lo:double,hi:double>>"
    near = lambda k, b: (F.least(k["hi"], b["hi"]) - F.greatest(k["lo"], b["lo"]) > 0.45 * F.least(k["hi"] - k["lo"], b["hi"] - b["lo"])) | (F.abs(k["lo"] + k["hi"] - b["lo"] - b["hi"]) / 2 < 0.06 * height)
    join = lambda k, b: F.struct(k["score"].alias("score"), F.least(k["lo"], b["lo"]).alias("lo"), F.greatest(k["hi"], b["hi"]).alias("hi"))
    step = lambda kept, b: F.when(F.exists(kept, lambda k: near(k, b)), F.transform(kept, lambda k: F.when(near(k, b), join(k, b)).otherwise(k))).otherwise(F.concat(kept, F.array(b))).cast(kind)
    return F.aggregate(F.reverse(F.array_sort(bands.cast(kind))), F.array().cast(kind), step)


def flat_regions(regions: Column) -> Column:
    """map `cn.region.color` -> share out of a map of maps."""
    return F.map_from_entries(F.flatten(F.transform(F.map_entries(regions), lambda r: F.transform(F.map_entries(r["value"]), lambda c: F.struct(F.concat_ws(".", F.lit("cn"), r["key"], c["key"]).alias("key"), c["value"].alias("value"))))))


def asks_model(forced: Column, template: Column, warned: Column, lines: Column, least: float = 0.55, templates: tuple = ("small_blurry_or_unknown",)) -> Column:
    """Whether a result should go to a language model: forced, a hard template, a quality warning, weak reading, or stacked prices."""
    weak = F.coalesce(mean_confidence(lines) < least, F.lit(True))
    return forced | template.isin(*templates) | warned | weak | vertical_stack(lines)["suspicious"]


def evidence(lines: Column, main: Column, candidates: Column) -> Column:
    """What a model is told about a tag, as JSON."""
    return F.to_json(F.struct(F.transform(lines, lambda n: n["text"]).alias("texts"), main.alias("main_price"), candidates.alias("catalog")))


def prompt(evidence_: Column) -> Column:
    return F.concat(F.lit("Read the shelf label. Answer with one JSON object with the keys product_name, main_price, item_id. Evidence: "), evidence_)


def rule_card(main: Column, names: Column, candidate: Column, least: float = 0.56) -> Column:
    """struct<product_name, main_price, item_id, source>: the card without a model; a good catalog candidate gives name and item."""
    good = F.coalesce(candidate["score"] >= least, F.lit(False))
    return F.struct(F.when(good, candidate["name"]).otherwise(select_name(names)).alias("product_name"), main.alias("main_price"), F.when(good, candidate["item_id"]).alias("item_id"), F.when(good, "catalog").otherwise("rules").alias("source"))

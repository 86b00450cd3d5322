"""Assigning observations to live tracks, frame by frame: in batch for each stream in order, and on streaming state.

Each decision changes what the next is compared with, so a stream is one key. Frames older than the last one seen are
late: they are compared like others (their gap is small), which is also what the batch form does after sorting.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tagloom.operators.grouped import ordered_groups
from tagloom.operators.sequences import words_overlap

#: Frames after which a track is closed, and the score from which on an observation joins one.
GAP, ACCEPT = 12, 0.38
STATE = "tracks string, next long"


def geometry_score(a: tuple, b: tuple, least_iou: float = 0.04, jump: float = 0.45) -> float:
    w, h = max(0, min(a[2], b[2]) - max(a[0], b[0])), max(0, min(a[3], b[3]) - max(a[1], b[1]))
    size = lambda r: max(0, r[2] - r[0]) * max(0, r[3] - r[1])
    union = size(a) + size(b) - w * h
    iou = w * h / union if union > 0 else 0.0
    far = (((a[0] + a[2]) / 2 - (b[0] + b[2]) / 2) ** 2 + ((a[1] + a[3]) / 2 - (b[1] + b[3]) / 2) ** 2) ** 0.5
    near = max(0.0, 1 - far / max(1.0, jump * max(size(a), size(b)) ** 0.5))
    return 0.0 if iou < least_iou and near < 0.22 else max(iou, 0.65 * near + 0.35 * iou)


class Tracker:
    """Live tracks of one stream: id, last frame, last box, price, product."""

    def __init__(self, tracks: list | None = None, following: int = 1):
        self.tracks, self.following = tracks or [], following

    def add(self, frame: int, box: tuple, price: str | None, product: str | None) -> int:
        """The track that an observation joins, a new one if none fits."""
        best, best_score = None, 0.0
        for t in self.tracks:
            if frame == t["frame"] or frame - t["frame"] > GAP:
                continue
            same = max(1.0 if price and price == t["price"] else 0.0, words_overlap(product, t["product"]))
            score = 0.72 * geometry_score(box, tuple(t["box"])) + 0.28 * same
            if score > best_score:
                best, best_score = t, score
        if best is None or best_score < ACCEPT:
            best = {"id": self.following}
            self.following += 1
            self.tracks.append(best)
        best.update(frame=frame, box=list(box), price=price, product=product)
        return best["id"]

    def forget(self, frame: int) -> None:
        """Drop tracks that no later frame can join, so that the state is bounded by what is live."""
        self.tracks = [t for t in self.tracks if frame - t["frame"] <= GAP]


def _run(tracker: Tracker, rows: list[dict]) -> list[int]:
    out = []
    for r in rows:
        clean = lambda v: None if v is None or v != v else v
        tracker.forget(int(r["frame_index"]))
        out.append(tracker.add(int(r["frame_index"]), (r["x1"], r["y1"], r["x2"], r["y2"]), clean(r["main_price"]), clean(r["product_name"])))
    return out


_IN = ("observation_id", "frame_index", "x1", "y1", "x2", "y2", "main_price", "product_name")


def assign(observations: DataFrame, stream: str = "sequence_name") -> DataFrame:
    """stream, observation_id, track: a batch of observations, each stream in order of frame and id."""
    kinds = dict(observations.dtypes)

    def work(name: object, rows: list[dict]) -> list[dict]:
        return [{stream: name, "observation_id": r["observation_id"], "track": t} for r, t in zip(rows, _run(Tracker(), rows), strict=True)]

    return ordered_groups(observations, stream, ["frame_index", "observation_id"], list(_IN[2:]), work, f"`{stream}` {kinds[stream]}, observation_id {kinds['observation_id']}, track long")


def assign_stream(observations: DataFrame, stream: str = "sequence_name") -> DataFrame:
    """The same on a stream: live tracks are the state of each key."""
    kinds = dict(observations.dtypes)

    def work(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        held = state.get if state.exists else ("[]", 1)
        tracker = Tracker(json.loads(held[0]), int(held[1]))
        rows = pd.concat(list(batches)).sort_values(["frame_index", "observation_id"], kind="stable")
        ids = _run(tracker, rows.to_dict("records"))
        state.update((json.dumps(tracker.tracks, default=float), tracker.following))
        yield pd.DataFrame({stream: [key[0]] * len(rows), "observation_id": rows["observation_id"].to_numpy(), "track": ids})

    return observations.select(stream, *_IN).groupBy(stream).applyInPandasWithState(work, f"`{stream}` {kinds[stream]}, observation_id {kinds['observation_id']}, track long", STATE, "append", GroupStateTimeout.NoTimeout)


def observations_of(results: DataFrame) -> DataFrame:
    """Observations of image results: a rail's cells, or the result itself where it has none."""
    cells = results.withColumn("cell", F.explode_outer("cell_results"))
    pick = lambda c: F.coalesce(F.col(f"cell.{c}"), F.col(c)).alias(c)
    rank = F.coalesce(F.col("cell.rail_cell"), F.lit(0))
    return cells.select("sequence_name", "frame_index", F.concat_ws(":", "image_path", rank.cast("string")).alias("observation_id"), *[pick(c) for c in ("x1", "y1", "x2", "y2", "main_price", "product_name")])


def windowed_counts(events: DataFrame, at: str, late: str, wide: str, *keys: str) -> DataFrame:
    """Counts of tumbling windows with a watermark, for monitoring a stream of observations."""
    w = F.window(at, wide)
    return events.withWatermark(at, late).groupBy(w, *keys).agg(F.count("*").alias("n")).select(F.col("window.start").alias("start"), *keys, "n")

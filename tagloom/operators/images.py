"""Pixel measures in numpy behind Arrow functions. A decoder turns bytes into an array; PPM, PGM and NPY are built in."""

from __future__ import annotations

import io
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

Decoder = Callable[[bytes], np.ndarray | None]
REGIONS = {"full": (0, 0, 1, 1), "top": (0, 0, 1, 0.33), "middle": (0, 0.25, 1, 0.75), "bottom": (0, 0.55, 1, 1), "left": (0, 0, 0.5, 1), "right": (0.5, 0, 1, 1), "upper_left": (0, 0, 0.5, 0.5), "upper_right": (0.5, 0, 1, 0.5), "lower_left": (0, 0.5, 0.5, 1), "lower_right": (0.5, 0.5, 1, 1)}
QUALITY = "width int, height int, sharpness double, mean double, std double, under double, over double, status string, warnings array<string>"


def decode(data: bytes | None) -> np.ndarray | None:
    """height x width x 3 bytes of a PPM, PGM or NPY file; null if it isn't one."""
    try:
        if data and data[:6] == b"\x93NUMPY":
            a = np.load(io.BytesIO(data), allow_pickle=False)
        elif data and data[:2] in (b"P5", b"P6"):
            head = data.split(maxsplit=4)
            w, h = int(head[1]), int(head[2])
            deep = 3 if data[:2] == b"P6" else 1
            a = np.frombuffer(data[len(data) - w * h * deep :], np.uint8).reshape(h, w, deep)
        else:
            return None
        a = a if a.ndim == 3 else a[:, :, None]
        return np.ascontiguousarray(np.repeat(a, 3, 2) if a.shape[2] == 1 else a[:, :, :3]).astype(np.uint8)
    except (ValueError, IndexError):
        return None


def gray(a: np.ndarray) -> np.ndarray:
    return a.astype(np.float64) @ np.array([0.299, 0.587, 0.114])


def laplacian(g: np.ndarray) -> np.ndarray:
    p = np.pad(g, 1, mode="reflect") if min(g.shape) > 1 else np.pad(g, 1, mode="edge")
    return p[:-2, 1:-1] + p[2:, 1:-1] + p[1:-1, :-2] + p[1:-1, 2:] - 4 * g


def quality(a: np.ndarray | None, least_width: int = 60, least_height: int = 40, least_sharpness: float = 45.0) -> dict:
    """Size, sharpness, brightness and what is wrong with a picture."""
    if a is None:
        return {"width": None, "height": None, "sharpness": None, "mean": None, "std": None, "under": None, "over": None, "status": "unreadable", "warnings": ["unreadable"]}
    g = gray(a)
    under, over, sharp = float((g < 35).mean()), float((g > 245).mean()), float(laplacian(g).var())
    checks = (("too_small", a.shape[1] < least_width or a.shape[0] < least_height), ("blurry", sharp < least_sharpness), ("underexposed", under > 0.45), ("overexposed", over > 0.35))
    warnings = [name for name, bad in checks if bad]
    return {"width": a.shape[1], "height": a.shape[0], "sharpness": sharp, "mean": float(g.mean()), "std": float(g.std()), "under": under, "over": over, "status": "warn" if warnings else "ok", "warnings": warnings}


def focus(a: np.ndarray) -> float:
    """How well a picture is focused, 0 to 1, from edges, contrast and entropy."""
    g = gray(a)
    sat = lambda x, k: x / (x + k)
    dy, dx = np.gradient(g) if min(g.shape) > 1 else (np.zeros_like(g), np.zeros_like(g))
    steps = g[:, 2:] - g[:, :-2] if g.shape[1] > 2 else np.zeros((1, 1))
    share = np.bincount(g.astype(np.uint8).ravel(), minlength=256) / g.size
    entropy = float(-(share[share > 0] * np.log2(share[share > 0])).sum())
    score = 0.28 * sat(float(laplacian(g).var()), 850) + 0.24 * sat(float((64 * (dx * dx + dy * dy)).mean()), 18000) + 0.18 * sat(float((steps * steps).mean()), 260) + 0.14 * sat(float(np.sqrt((dx * dx).mean() + (dy * dy).mean())), 42) + 0.08 * min(1.0, max(0.0, (entropy - 4.2) / 3)) + 0.08 * min(1.0, float(g.std()) / 64)
    return float(min(1.0, score * (0.82 if (g < 90).mean() < 0.015 else 1.0)))


def hue_names(a: np.ndarray) -> np.ndarray:
    """Index into `COLORS` of each pixel, by value, saturation and hue."""
    x = a.astype(np.float64) / 255
    hi, lo = x.max(2), x.min(2)
    d = hi - lo
    r, g, b = x[..., 0], x[..., 1], x[..., 2]
    with np.errstate(divide="ignore", invalid="ignore"):
        hue = np.where(hi == r, ((g - b) / d) % 6, np.where(hi == g, (b - r) / d + 2, (r - g) / d + 4)) * 60
        sat = np.where(hi > 0, d / hi, 0)
    hue = np.nan_to_num(hue)
    bounds = ((15, "red"), (40, "orange"), (70, "yellow"), (170, "green"), (255, "blue"), (290, "purple"), (335, "pink"), (361, "red"))
    out = np.full(hue.shape, COLORS.index("red"))
    for limit, name in reversed(bounds):
        out[hue < limit] = COLORS.index(name)
    out[(out == COLORS.index("orange")) & (hi < 0.6)] = COLORS.index("brown")
    pale = sat < 0.18
    out[pale] = COLORS.index("gray")
    out[pale & (hi > 0.82)] = COLORS.index("white")
    out[hi < 0.2] = COLORS.index("black")
    return out


COLORS = ("black", "blue", "brown", "gray", "green", "orange", "pink", "purple", "red", "white", "yellow")


def color_regions(a: np.ndarray, most: int = 80_000) -> dict[str, dict[str, float]]:
    """Shares of eleven colours in ten regions; a large picture is thinned out first."""
    step = int(np.ceil(np.sqrt(a.shape[0] * a.shape[1] / most)))
    names = hue_names(a[::step, ::step] if step > 1 else a)
    h, w = names.shape
    out = {}
    for region, (x1, y1, x2, y2) in REGIONS.items():
        part = names[int(y1 * h) : max(int(y1 * h) + 1, int(y2 * h)), int(x1 * w) : max(int(x1 * w) + 1, int(x2 * w))]
        share = np.bincount(part.ravel(), minlength=len(COLORS)) / max(1, part.size)
        out[region] = dict(zip(COLORS, map(float, share), strict=True))
    return out


def look(a: np.ndarray, size: int = 64) -> list[float]:
    """Unit vector of equalised brightness and gradient over a grid."""
    g = gray(a)
    rows, cols = (np.linspace(0, n - 1, size).round().astype(int) for n in g.shape)
    small = g[np.ix_(rows, cols)]
    rank = np.searchsorted(np.sort(small.ravel()), small.ravel()).reshape(small.shape) / small.size
    dy, dx = np.gradient(rank)
    v = np.concatenate((rank.ravel() - rank.mean(), np.hypot(dx, dy).ravel()))
    n = np.sqrt(v @ v)
    return (v / n if n else v).tolist()


def main_color(a: np.ndarray) -> str:
    """The commonest colour of the lower part that isn't black, white or gray; white if there is none."""
    names = hue_names(a[int(0.42 * a.shape[0]) :])
    counts = np.bincount(names.ravel(), minlength=len(COLORS)).astype(float)
    for plain in ("black", "gray", "white"):
        counts[COLORS.index(plain)] = 0
    return COLORS[int(counts.argmax())] if counts.max() >= 0.12 * names.size else "white"


def measure(files: DataFrame, decoder: Decoder = decode) -> DataFrame:
    """path, quality, focus, regions, feature, color, error for each picture; one that can't be read is a row with an error, not a failure."""
    schema = "path string, quality struct<" + ", ".join(": ".join(f.strip().split(" ", 1)) for f in QUALITY.split(",")) + ">, focus double, regions map<string,map<string,double>>, feature array<double>, color string, error string"

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for path, data in zip(batch["path"], batch["content"], strict=True):
                a, error = None, None
                try:
                    a = decoder(bytes(data)) if data is not None else None
                except Exception as e:  # noqa: BLE001  a broken file is data
                    error = f"{type(e).__name__}: {e}"
                ok = a is not None
                rows.append((path, quality(a), focus(a) if ok else None, color_regions(a) if ok else None, look(a) if ok else None, main_color(a) if ok else None, error or (None if ok else "unreadable")))
            yield pd.DataFrame(rows, columns=["path", "quality", "focus", "regions", "feature", "color", "error"])

    return files.select("path", "content").mapInPandas(work, schema)


def fuse(stack: list[np.ndarray], weights: list[float], median: bool = False) -> np.ndarray:
    """Aligned pictures of one size as one: weighted mean or weighted median."""
    a, w = np.stack(stack).astype(np.float64), np.asarray(weights, float)
    if not median:
        return np.rint(np.tensordot(w / w.sum(), a, 1)).astype(np.uint8)
    order = np.argsort(a, 0, kind="stable")
    share = np.cumsum(w[order], 0)
    at = (share < w.sum() / 2).sum(0)
    return np.take_along_axis(np.take_along_axis(a, order, 0), at[None], 0)[0].astype(np.uint8)


def smooth(x: np.ndarray, k: int) -> np.ndarray:
    """Gaussian smoothing of a signal with an odd window of about k."""
    k = max(1, k | 1)
    t = np.arange(k) - k // 2
    w = np.exp(-0.5 * (t / max(k / 6, 1e-9)) ** 2)
    return np.convolve(np.pad(x, k // 2, mode="edge"), w / w.sum(), "valid")


def runs(mask: np.ndarray) -> list[tuple[int, int]]:
    """Ranges (end exclusive) in which a mask is true."""
    edge = np.flatnonzero(np.diff(np.concatenate(([0], mask.astype(int), [0]))))
    return list(zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True))


def peaks(x: np.ndarray, least: float, distance: int) -> list[int]:
    """Local maxima of at least `least`, highest first chosen, none within `distance` of one chosen before; in order of place."""
    tops = [i for i in range(len(x)) if x[i] >= least and x[i] >= x[max(0, i - 1)] and x[i] >= x[min(len(x) - 1, i + 1)]]
    kept: list[int] = []
    for i in sorted(tops, key=lambda i: (-x[i], i)):
        if all(abs(i - j) > distance for j in kept):
            kept.append(i)
    return sorted(kept)


def best_window(x: np.ndarray, width: int) -> int:
    """Start of the window of largest sum (the first such)."""
    sums = np.convolve(x, np.ones(min(width, len(x))), "valid")
    return int(sums.argmax())


def split_rail(a: np.ndarray, expected: float, beam: int = 12, slack: float = 0.45) -> list[tuple[int, int]]:
    """Cells of a rail of tags: boundaries at brightness edges, chosen by beam search for even widths and strong edges."""
    g = smooth(np.abs(np.diff(gray(a).mean(0), prepend=gray(a).mean(0)[0])), 5)
    width = a.shape[1]
    cues = sorted({0, width, *peaks(g, float(g.mean() + g.std()), max(3, int(0.15 * expected)))})
    paths: list[tuple[float, list[int]]] = [(0.0, [0])]
    done: list[tuple[float, list[int]]] = []
    while paths:
        grown = []
        for score, path in paths:
            for x in cues:
                w = x - path[-1]
                if (1 - slack) * expected <= w <= (1 + slack) * expected:
                    worth = score + float(np.exp(-0.5 * ((w - expected) / (0.35 * expected)) ** 2)) + (0.3 if x < width else 0.0)
                    (done if x == width else grown).append((worth, [*path, x]))
        paths = sorted(grown, key=lambda p: (-p[0], p[1]))[:beam]
    best = max(done, key=lambda p: (p[0] / (len(p[1]) - 1), -len(p[1])), default=(0.0, [0, width]))[1]
    return list(zip(best[:-1], best[1:], strict=True))


def color_table(data: bytes) -> np.ndarray:
    """32,768 rows of eleven colour shares out of an NPY file: not below 0, each row's sum 1."""
    table = np.maximum(np.load(io.BytesIO(data), allow_pickle=False).astype(np.float64), 0)
    if table.shape != (32_768, len(COLORS)):
        raise ValueError(f"a colour table has 32,768 rows of {len(COLORS)}, not {table.shape}")
    return table / np.maximum(table.sum(1, keepdims=True), 1e-12)


def table_shares(a: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Mean colour shares of a picture by a colour table, five bits a channel."""
    x = a.astype(np.int64) >> 3
    return table[(x[..., 0] + 32 * x[..., 1] + 1024 * x[..., 2]).ravel()].mean(0)


def crop(a: np.ndarray, x1: int, y1: int, x2: int, y2: int) -> np.ndarray:
    """The part of a picture in a box, clipped; one pixel at least."""
    h, w = a.shape[:2]
    x1, y1 = min(max(0, x1), w - 1), min(max(0, y1), h - 1)
    return a[y1 : max(y1 + 1, min(h, y2)), x1 : max(x1 + 1, min(w, x2))]


def enlarge(a: np.ndarray, least: int) -> np.ndarray:
    """Whole-number enlargement until the shorter side has `least` pixels."""
    k = max(1, -(-least // min(a.shape[:2])))
    return a.repeat(k, 0).repeat(k, 1)


def tame_glare(a: np.ndarray, bright: int = 240, reach: int = 3) -> np.ndarray:
    """Very bright, colourless spots replaced by the median of what is around them."""
    spot = (a.min(2) >= bright) & (a.max(2) - a.min(2) <= 12)
    out = a.copy()
    if 0 < spot.mean() < 0.35:
        for y, x in zip(*np.nonzero(spot), strict=True):
            part = crop(a, x - reach, y - reach, x + reach + 1, y + reach + 1).reshape(-1, 3)
            calm = part[part.min(1) < bright]
            if len(calm):
                out[y, x] = np.median(calm, 0)
    return out


def turn(a: np.ndarray, degrees: float) -> np.ndarray:
    """A picture turned about its middle, nearest pixels, edges repeated."""
    h, w = a.shape[:2]
    t, cy, cx = np.deg2rad(degrees), (h - 1) / 2, (w - 1) / 2
    y, x = np.mgrid[:h, :w]
    sx = np.cos(t) * (x - cx) + np.sin(t) * (y - cy) + cx
    sy = -np.sin(t) * (x - cx) + np.cos(t) * (y - cy) + cy
    return a[np.clip(np.rint(sy), 0, h - 1).astype(int), np.clip(np.rint(sx), 0, w - 1).astype(int)]


def tilt(a: np.ndarray, most: float = 35.0) -> float:
    """The angle at which rows of text stand out most (variance of row sums): whole degrees, then fifths."""
    step = int(np.ceil(max(a.shape[:2]) / 320))
    small = a[::step, ::step]
    sharp = lambda d: float(gray(turn(small, d)).sum(1).var())
    best = max(np.arange(-most, most + 1, 1.0), key=lambda d: (sharp(d), -abs(d)))
    return float(round(max(np.arange(best - 1, best + 1.01, 0.2), key=lambda d: (sharp(d), -abs(d))), 1))


def warm_panels(a: np.ndarray, least: float = 0.03) -> list[tuple[int, int, int, int]]:
    """Boxes of bands of red, orange or brown that hold at least a share of the picture, largest first."""
    names = hue_names(a)
    warm = np.isin(names, [COLORS.index(c) for c in ("red", "orange", "brown", "pink")])
    out = []
    for y1, y2 in runs(warm.mean(1) > 0.25):
        for x1, x2 in runs(warm[y1:y2].mean(0) > 0.25):
            if (x2 - x1) * (y2 - y1) >= least * names.size:
                out.append((x1, y1, x2, y2))
    return sorted(out, key=lambda b: -(b[2] - b[0]) * (b[3] - b[1]))


def split_line(a: np.ndarray, low: float = 0.42, high: float = 0.62) -> float:
    """Where a promotion tag's coloured lower part begins, as a fraction of its height."""
    panels = [p for p in warm_panels(a) if p[3] > 0.5 * a.shape[0]]
    return float(min(high, max(low, panels[0][1] / a.shape[0]))) if panels else 0.5


def separators(a: np.ndarray, least: float = 0.6) -> list[int]:
    """Columns that are dark or bright edges over most of a picture's height."""
    g = gray(a)
    edge = np.abs(np.diff(g, axis=1)) > 40
    return peaks(np.concatenate((edge.mean(0), [0.0])), least, max(3, a.shape[1] // 50))

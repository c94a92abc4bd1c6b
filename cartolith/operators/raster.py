"""Pixel operators: grey images as rows (id, w, h, pixels: one byte each, rows first).

Images are looked at one by one inside Arrow batches; nothing is exchanged. Column expressions stay
outside wherever pixels aren't needed.
"""

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The step of a rotation sweep, in degrees, and the likeness beyond which a rotated
#: template is the same as the unrotated one.
SWEEP, SAME = 23, 0.65


def array_of(w: int, h: int, pixels: bytes) -> np.ndarray:
    return np.frombuffer(pixels, np.uint8).reshape(h, w)


def likeness(image: np.ndarray, template: np.ndarray) -> np.ndarray:
    """The correlation of the template with every part of the image of its size, both freed of their
    means, from -1 to 1; 0 where either is flat."""
    t = template.astype(float) - template.mean()
    parts = np.lib.stride_tricks.sliding_window_view(image.astype(float), template.shape)
    n = template.size
    mean = parts.sum((2, 3)) / n
    cross = np.einsum("ijkl,kl->ij", parts, t)
    spread = np.einsum("ijkl,ijkl->ij", parts, parts) - n * mean**2
    scale = np.sqrt(np.maximum(spread, 0) * (t * t).sum())
    return np.divide(cross, scale, out=np.zeros_like(cross), where=scale > 1e-9)


def rotated(template: np.ndarray, degrees: float, fill: int = 255) -> np.ndarray:
    """The template turned about its middle, by nearest pixels; corners that come in are filled."""
    h, w = template.shape
    a, (cy, cx) = np.radians(degrees), ((h - 1) / 2, (w - 1) / 2)
    y, x = np.mgrid[:h, :w]
    sx = np.rint(np.cos(a) * (x - cx) - np.sin(a) * (y - cy) + cx).astype(int)
    sy = np.rint(np.sin(a) * (x - cx) + np.cos(a) * (y - cy) + cy).astype(int)
    inside = (sx >= 0) & (sx < w) & (sy >= 0) & (sy < h)
    out = np.full_like(template, fill)
    out[inside] = template[sy[inside], sx[inside]]
    return out


def labelled(mask: np.ndarray) -> np.ndarray:
    """Numbers from 1 for the 4-connected parts of a mask, each the place of its first pixel: runs
    along the rows, united where they touch the row above."""
    before = np.zeros_like(mask)
    before[:, 1:] = mask[:, :-1]
    starts = mask & ~before
    run = np.cumsum(starts).reshape(mask.shape) - 1
    up = np.arange(int(starts.sum()))

    def top(x: int) -> int:
        while up[x] != x:
            up[x] = x = up[up[x]]
        return x

    touch = mask[1:] & mask[:-1]
    for a, b in np.unique(np.stack([run[:-1][touch], run[1:][touch]], 1), axis=0):
        x, y = sorted((top(a), top(b)))
        up[y] = x
    first = np.flatnonzero(starts) + 1
    of = first[[top(x) for x in range(len(up))]] if len(up) else first
    return np.where(mask, of[np.where(mask, run, 0)], 0) if len(up) else np.zeros(mask.shape, int)


def largest_part(mask: np.ndarray) -> np.ndarray:
    """The largest connected part of a mask; of equal ones the first."""
    parts = labelled(mask)
    names, sizes = np.unique(parts[parts > 0], return_counts=True)
    return parts == names[sizes.argmax()] if len(names) else mask & False


def grown(mask: np.ndarray, by: int) -> np.ndarray:
    """A mask widened by so many pixels on all sides."""
    out = mask.copy()
    for axis in (0, 1):
        base = out.copy()
        for step in range(1, by + 1):
            low, high = [slice(None)] * 2, [slice(None)] * 2
            low[axis], high[axis] = slice(step, None), slice(None, -step)
            out[tuple(low)] |= base[tuple(high)]
            out[tuple(high)] |= base[tuple(low)]
    return out


def gamma(pixels: np.ndarray, value: float) -> np.ndarray:
    """Brightness by a power of its share of the range."""
    table = np.rint(255 * (np.arange(256) / 255) ** value).astype(np.uint8)
    return table[pixels]


def template_matches(images: DataFrame, template: np.ndarray, least: float, step: int = SWEEP) -> DataFrame:
    """(id, rotation, x, y, score): parts of an image that are like the template at some turn of the
    sweep; turns under which the template is much like itself are left out."""
    turns = [d for d in range(0, 360, step) if d == 0 or likeness(rotated(template, d), template).max() <= SAME]

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for i, w, h, pixels in zip(b["id"], b["w"], b["h"], b["pixels"], strict=True):
                image = array_of(w, h, pixels)
                if h < template.shape[0] or w < template.shape[1]:
                    continue
                for d in turns:
                    like = likeness(image, rotated(template, d))
                    y, x = np.nonzero(like >= least)
                    out += [(i, d, int(p), int(q), float(like[q, p])) for q, p in zip(y, x, strict=True)]
            yield pd.DataFrame(out, columns=["id", "rotation", "x", "y", "score"])

    return images.select("id", "w", "h", "pixels").mapInPandas(work, "id long, rotation int, x int, y int, score double")


def best_turns(matches: DataFrame) -> DataFrame:
    """(id, x, y, rotation, score): the turn of the highest score at each place, the first of equals."""
    best = F.max_by(F.struct("rotation", "score"), F.struct(F.col("score"), -F.col("rotation"))).alias("b")
    return matches.groupBy("id", "x", "y").agg(best).select("id", "x", "y", "b.*")


def cleaned_templates(images: DataFrame, limit: int = 128) -> DataFrame:
    """(id, n_dark, n_kept): dark pixels, and those of the largest connected part."""

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            masks = [array_of(w, h, p) < limit for w, h, p in zip(b["w"], b["h"], b["pixels"], strict=True)]
            yield pd.DataFrame({"id": b["id"], "n_dark": [int(m.sum()) for m in masks], "n_kept": [int(largest_part(m).sum()) for m in masks]})

    return images.select("id", "w", "h", "pixels").mapInPandas(work, "id long, n_dark long, n_kept long")


def region_masks(regions: DataFrame, share: float = 0.03, most: int = 150) -> DataFrame:
    """(id, pixels): a mask (0 or 255) of an image's regions, each widened by a share of its longer
    side, `most` pixels at most: regions(id, w, h, boxes array<struct<x0, y0, x1, y1>>)."""

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for w, h, boxes in zip(b["w"], b["h"], b["boxes"], strict=True):
                mask, by = np.zeros((h, w), np.uint8), int(min(most, max(w, h) * share))
                for r in boxes:
                    mask[max(r["y0"] - by, 0) : r["y1"] + by + 1, max(r["x0"] - by, 0) : r["x1"] + by + 1] = 255
                out.append(mask.tobytes())
            yield pd.DataFrame({"id": b["id"], "pixels": out})

    return regions.select("id", "w", "h", "boxes").mapInPandas(work, "id long, pixels binary")


def colour_range(value: Column, spread: int) -> Column:
    """From and to around a colour value, within a byte."""
    return F.struct(F.greatest(value - spread, F.lit(0)).alias("low"), F.least(value + spread, F.lit(255)).alias("high"))


def cropped(pixels: np.ndarray, mask: np.ndarray, margin: int = 5, fill: int = 255) -> np.ndarray:
    """The part of an image that holds its foreground, with a margin filled with the background."""
    y, x = np.nonzero(mask)
    if not len(y):
        return pixels
    out = np.full((y.max() - y.min() + 1 + 2 * margin, x.max() - x.min() + 1 + 2 * margin), fill, np.uint8)
    out[margin : out.shape[0] - margin, margin : out.shape[1] - margin] = pixels[y.min() : y.max() + 1, x.min() : x.max() + 1]
    return out


def whitened(pixels: np.ndarray, low: int, high: int) -> np.ndarray:
    """Pixels outside a range of brightness become white."""
    return np.where((pixels >= low) & (pixels <= high), pixels, 255).astype(np.uint8)


def outlined(pixels: np.ndarray, boxes: list, level: int = 0) -> np.ndarray:
    """An image with the edges of boxes (x0, y0, x1, y1) drawn on it, as far as they lie on it."""
    out = pixels.copy()
    h, w = out.shape
    for x0, y0, x1, y1 in boxes:
        a, b = max(x0, 0), min(x1, w - 1)
        c, d = max(y0, 0), min(y1, h - 1)
        if a > b or c > d:
            continue
        for y in (y0, y1):
            if 0 <= y < h:
                out[y, a : b + 1] = level
        for x in (x0, x1):
            if 0 <= x < w:
                out[c : d + 1, x] = level
    return out


def resized(pixels: np.ndarray, w: int, h: int) -> np.ndarray:
    """An image of another size, by nearest pixels."""
    y, x = (np.minimum((np.arange(n) + 0.5) * m / n, m - 1).astype(int) for n, m in ((h, pixels.shape[0]), (w, pixels.shape[1])))
    return pixels[y[:, None], x]


def mapped(images: DataFrame, change, *columns: str) -> DataFrame:
    """images(id, w, h, pixels) through change(array, *columns) -> array."""

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = [change(array_of(w, h, p), *more) for w, h, p, *more in zip(b["w"], b["h"], b["pixels"], *(b[c] for c in columns), strict=True)]
            yield pd.DataFrame({"id": b["id"], "w": [o.shape[1] for o in out], "h": [o.shape[0] for o in out], "pixels": [np.ascontiguousarray(o).tobytes() for o in out]})

    return images.select("id", "w", "h", "pixels", *columns).mapInPandas(work, "id long, w int, h int, pixels binary")

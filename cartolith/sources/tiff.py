"""Plain TIFF images: one uncompressed strip of 8-bit samples, grey or RGB."""

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

#: Fixed values of the format: tags of the fields that are written.
WIDTH, HEIGHT, BITS, COMPRESSION, KIND, STRIP, SAMPLES, ROWS, LENGTH = 256, 257, 258, 259, 262, 273, 277, 278, 279


def encode(pixels: np.ndarray) -> bytes:
    """An array (height, width) or (height, width, 3) of bytes as a TIFF file."""
    height, width = pixels.shape[:2]
    bands = 1 if pixels.ndim == 2 else 3
    data, depth_at = np.ascontiguousarray(pixels, np.uint8).tobytes(), 8 + 2 + 9 * 12 + 4
    start = depth_at + 2 * bands
    depth = (3, 1, 8) if bands == 1 else (3, 3, depth_at)
    fields = {WIDTH: (4, 1, width), HEIGHT: (4, 1, height), BITS: depth, COMPRESSION: (3, 1, 1), KIND: (3, 1, 1 if bands == 1 else 2), STRIP: (4, 1, start), SAMPLES: (3, 1, bands), ROWS: (4, 1, height), LENGTH: (4, 1, len(data))}
    body = b"".join(struct.pack("<HHII", tag, *fields[tag]) for tag in sorted(fields))
    return b"II*\0" + struct.pack("<IH", 8, len(fields)) + body + b"\0" * 4 + struct.pack("<H", 8) * bands + data


def decode(content: bytes) -> np.ndarray:
    """The pixels of a file as encode() writes them."""
    if content[:4] != b"II*\0":
        raise ValueError("no TIFF file of this kind")
    (at,) = struct.unpack_from("<I", content, 4)
    (n,) = struct.unpack_from("<H", content, at)
    f = {tag: value for tag, _, _, value in (struct.unpack_from("<HHII", content, at + 2 + 12 * k) for k in range(n))}
    if f[COMPRESSION] != 1:
        raise ValueError("a compressed TIFF file")
    flat = np.frombuffer(content, np.uint8, f[LENGTH], f[STRIP])
    return flat.reshape(f[HEIGHT], f[WIDTH]) if f[SAMPLES] == 1 else flat.reshape(f[HEIGHT], f[WIDTH], 3)


def normal(samples: np.ndarray) -> np.ndarray:
    """Samples of any kind as RGB bytes: fractions are scaled to 0 ... 255, grey goes into three bands."""
    if samples.dtype.kind == "f":
        top = samples.max(initial=0)
        samples = samples * (255 / top) if top > 0 else samples
    out = np.clip(samples, 0, 255).astype(np.uint8)
    return np.repeat(out[..., None], 3, 2) if out.ndim == 2 else out[..., :3]


def encoded(rows: DataFrame) -> DataFrame:
    """rows(name, width, height, samples: an array of bytes or fractions) as (name, content): always TIFF in RGB,
    whatever the name ends in."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = [encode(normal(np.array(s).reshape(h, w))) for w, h, s in zip(*(b[c].to_pylist() for c in ("width", "height", "samples")), strict=True)]
            yield pa.RecordBatch.from_arrays([b["name"], pa.array(out, pa.binary())], names=["name", "content"])

    return rows.select("name", "width", "height", "samples").mapInArrow(work, "name string, content binary")


def decoded(rows: DataFrame) -> DataFrame:
    """rows(name, content) as (name, width, height, samples: the first band's); null for no content."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            images = [None if c is None else decode(c) for c in b["content"].to_pylist()]
            cols = [[None if i is None else i.shape[1] for i in images], [None if i is None else i.shape[0] for i in images], [None if i is None else i[..., 0].ravel().tolist() for i in images]]
            yield pa.RecordBatch.from_arrays([b["name"], *[pa.array(c, t) for c, t in zip(cols, (pa.int32(), pa.int32(), pa.list_(pa.int32())), strict=True)]], names=["name", "width", "height", "samples"])

    return rows.select("name", "content").mapInArrow(work, "name string, width int, height int, samples array<int>")

"""Image functions in numpy, batched through Arrow; decoders and models are passed in where a pipeline has them."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Bounds of the hue bins (the last joins the first), and where saturation and value are split.
HUE = (0, 11.5, 23, 35.5, 78, 93.5, 139.5, 165.5, 180)
SATURATION, VALUE = 0.65, 0.7
# The mean of each colour, blue first.
MEAN_BGR = (104.0, 117.0, 123.0)


def resize(image: np.ndarray, height: int, width: int) -> np.ndarray:
    """Bilinear, pixel centres aligned."""
    h, w = image.shape[:2]
    y, x = (np.arange(height) + 0.5) * h / height - 0.5, (np.arange(width) + 0.5) * w / width - 0.5
    y, x = np.clip(y, 0, h - 1), np.clip(x, 0, w - 1)
    y0, x0 = np.floor(y).astype(int), np.floor(x).astype(int)
    y1, x1 = np.minimum(y0 + 1, h - 1), np.minimum(x0 + 1, w - 1)
    extra = (1,) * (image.ndim - 2)
    fy, fx = (y - y0).reshape(-1, 1, *extra), (x - x0).reshape(1, -1, *extra)
    im = image.astype(np.float64)
    top = im[y0][:, x0] * (1 - fx) + im[y0][:, x1] * fx
    low = im[y1][:, x0] * (1 - fx) + im[y1][:, x1] * fx
    return top * (1 - fy) + low * fy


def crop(image: np.ndarray, first: int, last: int) -> np.ndarray:
    return image[first:last, first:last]


def centre_crop(image: np.ndarray, height: int, width: int) -> np.ndarray:
    top, left = max(0, (image.shape[0] - height) // 2), max(0, (image.shape[1] - width) // 2)
    return image[top : top + height, left : left + width]


def grey(image: np.ndarray) -> np.ndarray:
    return image if image.ndim == 2 else image[..., :3].astype(np.float64) @ np.array([0.299, 0.587, 0.114])


def phash(image: np.ndarray, size: int = 4, factor: int = 4) -> str:
    """Perceptual hash: the low frequencies of the cosine transform of the small grey image against their median, as
    hexadecimal digits, row by row."""
    n = size * factor
    a = resize(grey(image), n, n)
    k = np.arange(n)
    dct = np.cos(np.pi * (2 * k[None, :] + 1) * k[:, None] / (2 * n)) * 2
    low = (dct @ a @ dct.T)[:size, :size]
    bits = (low > np.median(low)).ravel()
    return f"{int(''.join('1' if b else '0' for b in bits), 2):0{-(-size * size // 4)}x}"


def hsv(image: np.ndarray) -> np.ndarray:
    """RGB bytes -> hue in 0 .. 180, saturation and value in 0 .. 1."""
    c = image[..., :3].astype(np.float64) / 255
    top, low = c.max(axis=-1), c.min(axis=-1)
    d = top - low
    safe = np.where(d == 0, 1, d)
    r, g, b = c[..., 0], c[..., 1], c[..., 2]
    hue = np.select([d == 0, top == r, top == g], [0 * d, ((g - b) / safe) % 6, (b - r) / safe + 2], (r - g) / safe + 4)
    return np.stack([hue * 30, np.where(top == 0, 0, d / np.where(top == 0, 1, top)), top], axis=-1)


def histogram(image: np.ndarray) -> np.ndarray:
    """11 counts: seven hues, the two ends of the circle together, two saturations and two values."""
    x = hsv(image)
    hue, _ = np.histogram(x[..., 0], HUE)
    s, _ = np.histogram(x[..., 1], (0, SATURATION, 1))
    v, _ = np.histogram(x[..., 2], (0, VALUE, 1))
    return np.r_[hue[0] + hue[-1], hue[1:-1], s, v].astype(np.float64)


def network_input(image: np.ndarray, size: int = 256, cropped: int = 224) -> np.ndarray:
    """Resized, blue first, means subtracted, cropped at the centre, channels first."""
    a = resize(image, size, size)[..., ::-1] - np.array(MEAN_BGR)
    return centre_crop(a, cropped, cropped).transpose(2, 0, 1).astype(np.float32)


def pixels(raw: bytes, h: int, w: int, c: int) -> np.ndarray:
    return np.frombuffer(raw, np.uint8).reshape(h, w, c)


def frame_features(frames: DataFrame, crop_rows: tuple[int, int] | None = None) -> DataFrame:
    """(vid, pos, raw, h, w, c) -> (vid, pos, hash, feature)."""

    def run(batches: Iterator) -> Iterator:
        import pandas as pd

        for pdf in batches:
            images = [pixels(r.raw, r.h, r.w, r.c) for r in pdf.itertuples()]
            yield pd.DataFrame({"vid": pdf["vid"], "pos": pdf["pos"], "hash": [phash(crop(i, *crop_rows) if crop_rows else i) for i in images], "feature": [histogram(i) for i in images]})

    return frames.mapInPandas(run, f"vid {frames.schema['vid'].dataType.simpleString()}, pos int, hash string, feature array<double>")


def decoded(files: DataFrame, decode: Callable[[bytes], Iterator[np.ndarray]], batch_bytes: int = 8 << 20) -> DataFrame:
    """(path, content) -> (vid, pos, raw, h, w, c), with a decoder that yields a video's frames in order; frames travel in
    batches of about batch_bytes, so that a task holds those and one file."""

    def run(batches: Iterator) -> Iterator:
        import pandas as pd

        names = ["vid", "pos", "raw", "h", "w", "c"]
        rows, size = [], 0
        for pdf in batches:
            for path, content in zip(pdf["path"], pdf["content"], strict=True):
                for i, f in enumerate(decode(content)):
                    raw = np.ascontiguousarray(f, np.uint8).tobytes()
                    rows.append((path, i, raw, f.shape[0], f.shape[1], f.shape[2] if f.ndim > 2 else 1))
                    size += len(raw)
                    if size >= batch_bytes:
                        yield pd.DataFrame(rows, columns=names)
                        rows, size = [], 0
        if rows:
            yield pd.DataFrame(rows, columns=names)

    return files.select("path", "content").mapInPandas(run, "vid string, pos int, raw binary, h int, w int, c int")


def scored(frames: DataFrame, load: Callable[[], Callable[[np.ndarray], np.ndarray]]) -> DataFrame:
    """Adds p, the probabilities that the model gives each frame; load() is called once a task."""

    def run(batches: Iterator) -> Iterator:
        model = load()
        for pdf in batches:
            x = [network_input(pixels(r.raw, r.h, r.w, r.c)) for r in pdf.itertuples()]
            yield pdf[["vid", "pos"]].assign(p=list(model(np.stack(x)).astype(np.float64)) if x else [])

    return frames.mapInPandas(run, f"vid {frames.schema['vid'].dataType.simpleString()}, pos int, p array<double>")

"""Measures of grey images as arrays: difference hash, sharpness, brightness. Decoding is pluggable; BMP and PGM are built in."""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

#: A grey image of a file's bytes, or (image, whether the file was cut short).
Decoder = Callable[[bytes], "np.ndarray | tuple[np.ndarray, bool]"]
#: Longest sides on which sharpness and brightness are measured.
SHARPNESS_SIDE, BRIGHTNESS_SIDE = 640, 320


def _weights(old: int, new: int) -> np.ndarray:
    """new x old weights of the Lanczos filter with three lobes, widened when shrinking."""
    scale = old / new
    wide = max(scale, 1.0)
    centre = (np.arange(new) + 0.5) * scale
    x = (np.arange(old)[None, :] + 0.5 - centre[:, None]) / wide
    w = np.where(np.abs(x) < 3, np.sinc(x) * np.sinc(x / 3), 0.0)
    return w / w.sum(axis=1, keepdims=True)


def resized(grey: np.ndarray, rows: int, columns: int) -> np.ndarray:
    """An eight-bit image on another grid: across, rounded, then down, rounded."""
    across = np.clip(np.floor(grey.astype(np.float64) @ _weights(grey.shape[1], columns).T + 0.5), 0, 255)
    return np.clip(np.floor(_weights(grey.shape[0], rows) @ across + 0.5), 0, 255).astype(np.uint8)


def thumbnail(grey: np.ndarray, most: int) -> np.ndarray:
    """grey with a longer side of `most` at most, its shape kept; very large ones are averaged in blocks before."""
    rows, columns = grey.shape
    if max(rows, columns) <= most:
        return grey
    share = most / max(rows, columns)
    to = max(1, round(rows * share)), max(1, round(columns * share))
    fy, fx = max(1, rows // to[0] // 2), max(1, columns // to[1] // 2)
    if fy > 1 or fx > 1:
        whole = grey[: rows // fy * fy, : columns // fx * fx].astype(np.float64)
        grey = np.floor(whole.reshape(rows // fy, fy, columns // fx, fx).mean(axis=(1, 3)) + 0.5).astype(np.uint8)
    return resized(grey, *to)


def difference_hash(grey: np.ndarray, size: int = 8) -> int:
    """64 bits, row by row, first highest: whether a cell is darker than its right neighbour. Signed."""
    small = resized(grey, size, size + 1)
    bits = (small[:, :-1] < small[:, 1:]).reshape(-1)
    value = int("".join("1" if b else "0" for b in bits), 2)
    return value - (1 << 64) if value >> 63 else value


def sharpness(grey: np.ndarray) -> float:
    """Variance of the Laplacian, clipped to eight bits; the outermost pixels stay as they are."""
    g = thumbnail(grey, SHARPNESS_SIDE).astype(np.int32)
    if min(g.shape) > 2:
        lap = g[:-2, 1:-1] + g[2:, 1:-1] + g[1:-1, :-2] + g[1:-1, 2:] - 4 * g[1:-1, 1:-1]
        g[1:-1, 1:-1] = np.clip(lap, 0, 255)
    return float(g.var())


def brightness(grey: np.ndarray) -> float:
    return float(thumbnail(grey, BRIGHTNESS_SIDE).mean())


def pgm(data: bytes) -> np.ndarray:
    """Decoder of binary PGM."""
    kind, width, height, top, body = data.split(maxsplit=4)
    if kind != b"P5" or int(top) > 255:
        raise ValueError("no eight-bit PGM")
    return np.frombuffer(body, dtype=np.uint8, count=int(width) * int(height)).reshape(int(height), int(width))


def bmp(data: bytes) -> tuple[np.ndarray, bool]:
    """Decoder of uncompressed 24-bit BMP; rows that a cut file lacks are black."""
    if data[:2] != b"BM" or len(data) < 54:
        raise ValueError("no BMP")
    start, (width, height) = int.from_bytes(data[10:14], "little"), np.frombuffer(data, "<i4", 2, 18).tolist()
    depth, packed = int.from_bytes(data[28:30], "little"), int.from_bytes(data[30:34], "little")
    if depth != 24 or packed or width <= 0 or height == 0:
        raise ValueError("no uncompressed 24-bit BMP")
    line = -(-3 * width // 4) * 4
    body = data[start : start + line * abs(height)]
    short = line * abs(height) - len(body)
    raw = np.frombuffer(body + bytes(short), dtype=np.uint8).reshape(abs(height), line)[:, : 3 * width].reshape(abs(height), width, 3).astype(np.uint32)
    # Luma of ITU-R 601 in 16-bit fixed point; pixels are blue, green, red.
    grey = (raw[:, :, 2] * 19595 + raw[:, :, 1] * 38470 + raw[:, :, 0] * 7471 + 0x8000 >> 16).astype(np.uint8)
    return (grey[::-1] if height > 0 else grey), short > 0


def plain(data: bytes) -> np.ndarray | tuple[np.ndarray, bool]:
    """Decoder of the formats that need no library: BMP and PGM."""
    return bmp(data) if data[:2] == b"BM" else pgm(data)


def measured(files: DataFrame, decode: Decoder = plain, key: str = "doc_id") -> DataFrame:
    """key, width, height, dhash, blur, brightness, truncated and error per file; a file that can't be decoded has its error alone."""
    names = [key, "width", "height", "dhash", "blur", "brightness", "truncated", "error"]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for doc, content in zip(frame[key], frame["content"]):
                try:
                    image = decode(content)
                    grey, cut = image if isinstance(image, tuple) else (image, False)
                    rows.append((doc, grey.shape[1], grey.shape[0], difference_hash(grey), sharpness(grey), brightness(grey), cut, None))
                except Exception as e:  # noqa: BLE001  the error is the row's result
                    rows.append((doc, None, None, None, None, None, None, f"undecodable:{type(e).__name__}"))
            # By column: a frame of rows would turn integers beside nulls into doubles, which lose bits of a hash.
            kinds = {"width": "Int32", "height": "Int32", "dhash": "Int64", "truncated": "boolean"}
            yield pd.DataFrame({n: pd.array(c, dtype=kinds.get(n, "Float64" if n in ("blur", "brightness") else "object")) for n, c in zip(names, zip(*rows) if rows else [()] * len(names))})

    return files.select(key, "content").mapInPandas(run, f"{key} string, width int, height int, dhash bigint, blur double, brightness double, truncated boolean, error string")


def to_bmp(grey: np.ndarray) -> tuple[str, bytes]:
    """(media type, bytes) of an uncompressed 24-bit BMP: the one encoder that needs no library."""
    rows, columns = grey.shape
    line = np.zeros((rows, -(-3 * columns // 4) * 4), dtype=np.uint8)
    line[:, : 3 * columns] = np.repeat(grey[::-1], 3, axis=1)
    number = lambda n, size=4: int(n).to_bytes(size, "little")
    head = b"BM" + number(54 + line.size) + bytes(4) + number(54) + number(40) + number(columns) + number(rows) + number(1, 2) + number(24, 2) + bytes(24)
    return "image/bmp", head + line.tobytes()


def encoded(files: DataFrame, decode: Decoder = plain, encode: Callable[[np.ndarray], tuple[str, bytes]] = to_bmp, key: str = "doc_id") -> DataFrame:
    """key, media_type, body (base64), image_px and image_kb of files (key, content, max_dim), shrunk to a longer side of max_dim at most.

    The longer side decides what a model charges. Files that can't be decoded give no row.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for doc, content, most in zip(frame[key], frame["content"], frame["max_dim"]):
                try:
                    image = decode(content)
                except Exception:  # noqa: BLE001  screening has told why
                    continue
                small = thumbnail(image[0] if isinstance(image, tuple) else image, int(most))
                kind, data = encode(small)
                rows.append((doc, kind, base64.b64encode(data).decode(), f"{small.shape[1]}x{small.shape[0]}", round(len(data) / 1024, 1)))
            yield pd.DataFrame(rows, columns=[key, "media_type", "body", "image_px", "image_kb"])

    return files.select(key, "content", "max_dim").mapInPandas(run, f"{key} string, media_type string, body string, image_px string, image_kb double")

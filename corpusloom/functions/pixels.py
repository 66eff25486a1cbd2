"""Pixel kernels in numpy: headers, decoding of PNG, colour modes, resizing, sharpness."""

from __future__ import annotations

import struct
import zlib
from collections.abc import Callable

import numpy as np

PNG_MAGIC = b"\x89PNG\r\n\x1a\n"


def image_size(data: bytes | None) -> tuple[int, int] | None:
    """Width and height from the header of a PNG, JPEG, GIF, BMP or TIFF file; None if it has none."""
    if not data or len(data) < 10:
        return None
    try:
        if data[:8] == PNG_MAGIC:
            return struct.unpack(">II", data[16:24])
        if data[:6] in (b"GIF87a", b"GIF89a"):
            return struct.unpack("<HH", data[6:10])
        if data[:2] == b"BM":
            w, h = struct.unpack("<ii", data[18:26])
            return w, abs(h)
        if data[:4] in (b"II*\0", b"MM\0*"):
            return _tiff_size(data)
        if data[:2] == b"\xff\xd8":
            at = 2
            while at + 9 < len(data):
                if data[at] != 0xFF:
                    at += 1
                    continue
                marker = data[at + 1]
                if 0xC0 <= marker <= 0xCF and marker not in (0xC4, 0xC8, 0xCC):
                    h, w = struct.unpack(">HH", data[at + 5 : at + 9])
                    return w, h
                at += 2 if marker in (0x01, 0xFF) or 0xD0 <= marker <= 0xD9 else 2 + struct.unpack(">H", data[at + 2 : at + 4])[0]
    except struct.error:
        return None
    return None


def loadable_size(data: bytes | None) -> tuple[int, int] | None:
    """The size of an image whose file is whole; None for other data.

    Of a PNG, the checksums of the chunks that make its picture are compared; of a JPEG, its end mark is looked for.
    """
    if data and data[:8] == PNG_MAGIC and not _whole_png(data):
        return None
    if data and data[:2] == b"\xff\xd8" and b"\xff\xd9" not in data[-65536:]:
        return None
    return image_size(data)


def _whole_png(data: bytes) -> bool:
    """Whether the chunks up to the end are there and the critical ones undamaged."""
    at, view = 8, memoryview(data)
    while at + 12 <= len(data):
        length, kind = int.from_bytes(view[at : at + 4], "big"), bytes(view[at + 4 : at + 8])
        end = at + 12 + length
        if end > len(data):
            return False
        if kind[:1].isupper() and zlib.crc32(view[at + 4 : end - 4]) != int.from_bytes(view[end - 4 : end], "big"):
            return False
        if kind == b"IEND":
            return True
        at = end
    return False


def _tiff_size(data: bytes) -> tuple[int, int] | None:
    """Width and height of a TIFF file's first image."""
    order = "<" if data[:2] == b"II" else ">"
    (at,) = struct.unpack_from(order + "I", data, 4)
    (entries,) = struct.unpack_from(order + "H", data, at)
    found = {}
    for k in range(entries):
        tag, kind = struct.unpack_from(order + "HH", data, at + 2 + 12 * k)
        if tag in (256, 257) and kind in (3, 4):
            (found[tag],) = struct.unpack_from(order + ("H" if kind == 3 else "I"), data, at + 10 + 12 * k)
    return (found[256], found[257]) if len(found) == 2 else None


def encode_png(pixels: np.ndarray) -> bytes:
    """A PNG file of gray (h, w) or colour (h, w, 3 or 4) bytes."""
    pixels = np.ascontiguousarray(pixels, np.uint8)
    h, w = pixels.shape[:2]
    colour = {1: 0, 3: 2, 4: 6}[1 if pixels.ndim == 2 else pixels.shape[2]]
    rows = np.concatenate([np.zeros((h, 1), np.uint8), pixels.reshape(h, -1)], axis=1)
    chunk = lambda kind, body: struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))
    head = struct.pack(">IIBBBBB", w, h, 8, colour, 0, 0, 0)
    return PNG_MAGIC + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(rows.tobytes())) + chunk(b"IEND", b"")


def decode_png(data: bytes | None) -> np.ndarray | None:
    """Pixels (h, w, 3) of an 8-bit PNG without interlacing, transparency dropped; None if it is not one."""
    try:
        if not data or data[:8] != PNG_MAGIC:
            return None
        at, body, palette, head = 8, b"", None, None
        while at < len(data):
            n, kind = struct.unpack(">I4s", data[at : at + 8])
            part = data[at + 8 : at + 8 + n]
            if struct.unpack(">I", data[at + 8 + n : at + 12 + n])[0] != zlib.crc32(kind + part):
                return None
            if kind == b"IHDR":
                head = struct.unpack(">IIBBBBB", part)
            elif kind == b"PLTE":
                palette = np.frombuffer(part, np.uint8).reshape(-1, 3)
            elif kind == b"IDAT":
                body += part
            at += 12 + n
        w, h, depth, colour, _, _, interlace = head
        if depth != 8 or interlace:
            return None
        channels = {0: 1, 2: 3, 3: 1, 4: 2, 6: 4}[colour]
        raw = np.frombuffer(zlib.decompress(body), np.uint8).reshape(h, 1 + w * channels)
        out = np.zeros((h, w * channels), np.uint8)
        for y in range(h):
            out[y] = _unfiltered(int(raw[y, 0]), raw[y, 1:], out[y - 1] if y else np.zeros(w * channels, np.uint8), channels)
        return to_rgb(out.reshape(h, w, channels), palette)
    except (struct.error, zlib.error, ValueError, KeyError, TypeError, IndexError):
        return None


def _unfiltered(kind: int, row: np.ndarray, above: np.ndarray, step: int) -> np.ndarray:
    if kind == 0:
        return row
    if kind == 2:
        return row + above
    out = np.zeros(len(row), np.int64)
    for x in range(len(row)):
        left = out[x - step] if x >= step else 0
        up, corner = int(above[x]), int(above[x - step]) if x >= step else 0
        if kind == 1:
            guess = left
        elif kind == 3:
            guess = (left + up) // 2
        elif kind == 4:
            p = left + up - corner
            guess = min((left, up, corner), key=lambda v: abs(p - v))
        else:
            raise ValueError("unknown filter")
        out[x] = (int(row[x]) + guess) & 255
    return out.astype(np.uint8)


def to_rgb(pixels: np.ndarray, palette: np.ndarray | None = None) -> np.ndarray:
    """Gray, gray with alpha, palette or RGBA pixels as RGB bytes."""
    pixels = np.asarray(pixels)
    if pixels.ndim == 2:
        pixels = pixels[:, :, None]
    pixels = pixels.astype(np.uint8)
    if palette is not None:
        return palette[pixels[:, :, 0]]
    if pixels.shape[2] in (1, 2):
        return np.repeat(pixels[:, :, :1], 3, axis=2)
    return pixels[:, :, :3]


def to_gray(rgb: np.ndarray) -> np.ndarray:
    """Luma of RGB pixels, rounded (weights are fixed values: 299, 587, 114 thousandths)."""
    r, g, b = (rgb[:, :, k].astype(np.int64) for k in range(3))
    return ((299 * r + 587 * g + 114 * b + 500) // 1000).astype(np.uint8)


def _sinc(x: np.ndarray) -> np.ndarray:
    return np.sinc(x)


#: Resampling kernels by name: how far each reaches, and its value at a distance.
KERNELS: dict[str, tuple[float, Callable[[np.ndarray], np.ndarray]]] = {
    "box": (0.5, lambda x: ((x > -0.5) & (x <= 0.5)).astype(float)),
    "bilinear": (1.0, lambda x: np.maximum(0.0, 1 - np.abs(x))),
    "hamming": (1.0, lambda x: np.where(np.abs(x) < 1, _sinc(x) * (0.54 + 0.46 * np.cos(np.pi * x)), 0.0)),
    "bicubic": (2.0, lambda x: _cubic(np.abs(x))),
    "lanczos": (3.0, lambda x: np.where(np.abs(x) < 3, _sinc(x) * _sinc(x / 3), 0.0)),
}


def _cubic(x: np.ndarray, a: float = -0.5) -> np.ndarray:
    near = ((a + 2) * x - (a + 3)) * x * x + 1
    far = a * (((x - 5) * x + 8) * x - 4)
    return np.where(x < 1, near, np.where(x < 2, far, 0.0))


def resize(pixels: np.ndarray, width: int, height: int, kind: str = "lanczos") -> np.ndarray:
    """Resampled first along rows, then along columns; kernels widen with the scale when shrinking."""
    if kind == "nearest":
        y, x = (((np.arange(n) + 0.5) * old / n).astype(int) for n, old in ((height, pixels.shape[0]), (width, pixels.shape[1])))
        return pixels[y][:, x]
    out = pixels
    for axis, size in ((1, width), (0, height)):
        if out.shape[axis] != size:
            wide = np.moveaxis(np.tensordot(_weights(out.shape[axis], size, kind), out.astype(float), axes=(1, axis)), 0, axis)
            out = np.clip(np.floor(wide + 0.5), 0, 255).astype(np.uint8)
    return out


def _weights(old: int, new: int, kind: str) -> np.ndarray:
    """What each of ``old`` pixels contributes to each of ``new``."""
    reach, kernel = KERNELS[kind]
    scale = old / new
    stretch = max(scale, 1.0)
    centre = (np.arange(new)[:, None] + 0.5) * scale
    place = np.arange(old)[None, :]
    first = np.maximum(0, np.floor(centre - reach * stretch + 0.5))
    end = np.minimum(old, np.floor(centre + reach * stretch + 0.5))
    w = np.where((place >= first) & (place < end), kernel((place - centre + 0.5) / stretch), 0.0)
    return w / w.sum(1, keepdims=True)


def laplacian(gray: np.ndarray) -> np.ndarray:
    """The four-neighbour Laplacian, borders reflected without repeating the edge."""
    p = np.pad(gray.astype(float), 1, mode="reflect") if min(gray.shape) > 1 else np.pad(gray.astype(float), 1, mode="edge")
    return p[:-2, 1:-1] + p[2:, 1:-1] + p[1:-1, :-2] + p[1:-1, 2:] - 4 * p[1:-1, 1:-1]


def circle_mask(height: int, width: int, ratio: float = 0.8) -> np.ndarray:
    """The pixels within ``ratio`` of half the shorter side from the centre."""
    y, x = np.ogrid[:height, :width]
    return (y - height // 2) ** 2 + (x - width // 2) ** 2 <= (ratio * min(height, width) / 2) ** 2


def masked_sharpness(gray: np.ndarray, mask: np.ndarray) -> float:
    return float(laplacian(gray)[mask].var())


def grid_sharpness(gray: np.ndarray, rows: int = 4, columns: int = 7) -> tuple[float, float]:
    """Least and mean variance of the Laplacian over the tiles of a grid."""
    edges = laplacian(gray)
    values = [tile.var() for band in np.array_split(edges, rows, 0) for tile in np.array_split(band, columns, 1)]
    return float(min(values)), float(np.mean(values))


def remap(pixels: np.ndarray, map_x: np.ndarray, map_y: np.ndarray) -> np.ndarray:
    """Pixels taken at fractional places, linearly interpolated, zero outside."""
    h, w = pixels.shape[:2]
    x0, y0 = np.floor(map_x).astype(int), np.floor(map_y).astype(int)
    out = np.zeros((*map_x.shape, *pixels.shape[2:]))
    for dy in (0, 1):
        for dx in (0, 1):
            x, y = x0 + dx, y0 + dy
            inside = (x >= 0) & (x < w) & (y >= 0) & (y < h)
            weight = (1 - np.abs(map_x - x)) * (1 - np.abs(map_y - y)) * inside
            value = pixels[np.clip(y, 0, h - 1), np.clip(x, 0, w - 1)].astype(float)
            out += value * (weight if value.ndim == 2 else weight[..., None])
    return np.rint(out).astype(np.uint8)

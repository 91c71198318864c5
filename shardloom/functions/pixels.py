"""Pixel kernels in numpy, on uint8 arrays of height x width x 3 in BGR order."""

from __future__ import annotations

import struct
import zlib

import numpy as np

PAD = 114


def from_row(data: bytes, height: int, width: int, channels: int) -> np.ndarray:
    """A Spark image row's bytes as BGR; gray is repeated, alpha dropped."""
    a = np.frombuffer(data, np.uint8).reshape(height, width, channels)
    return np.repeat(a, 3, axis=2) if channels == 1 else a[:, :, :3]


def gray(a: np.ndarray) -> np.ndarray:
    """Luma of BGR with the usual weights in 14-bit fixed point."""
    b, g, r = (a[:, :, i].astype(np.int32) for i in range(3))
    return ((b * 1868 + g * 9617 + r * 4899 + 8192) >> 14).astype(np.uint8)


def _weights(n_in: int, n_out: int, kind: str) -> np.ndarray:
    """The matrix (n_out, n_in) that resamples one axis."""
    out = np.zeros((n_out, n_in))
    scale = n_in / n_out
    if kind == "nearest":
        out[np.arange(n_out), np.minimum((np.arange(n_out) * scale).astype(int), n_in - 1)] = 1
    elif kind == "area" and scale >= 1:
        for i in range(n_out):
            lo, hi = i * scale, (i + 1) * scale
            j = np.arange(int(lo), min(n_in, int(np.ceil(hi))))
            out[i, j] = np.minimum(j + 1, hi) - np.maximum(j, lo)
    else:
        reach = {"cubic": 2, "lanczos": 4}.get(kind, 1)
        at = (np.arange(n_out) + 0.5) * scale - 0.5
        base = np.floor(at).astype(int)
        for k in range(1 - reach, 1 + reach):
            d = np.abs(at - (base + k))
            if kind == "cubic":
                a = -0.75
                w = np.where(d <= 1, (a + 2) * d**3 - (a + 3) * d**2 + 1, np.where(d < 2, a * (d**3 - 5 * d**2 + 8 * d - 4), 0))
            elif kind == "lanczos":
                w = np.where(d < 4, np.sinc(d) * np.sinc(d / 4), 0)
            else:
                w = np.maximum(0, 1 - d)
            np.add.at(out, (np.arange(n_out), np.clip(base + k, 0, n_in - 1)), w)
    return out / out.sum(axis=1, keepdims=True)


def resized(a: np.ndarray, width: int, height: int, kind: str = "area") -> np.ndarray:
    """Separable resampling; an unknown kind is area."""
    kind = kind if kind in ("nearest", "bilinear", "area", "cubic", "lanczos") else "area"
    y, x = _weights(a.shape[0], height, kind), _weights(a.shape[1], width, kind)
    out = np.tensordot(y, a.astype(np.float64), axes=(1, 0))
    out = np.moveaxis(np.tensordot(x, out, axes=(1, 1)), 0, 1)
    return np.clip(np.rint(out), 0, 255).astype(np.uint8)


def difference_hash(g: np.ndarray, size: int = 16) -> np.ndarray:
    """size x size comparisons of horizontal neighbours, row by row, as 64-bit words; the first bit is the lowest."""
    s = resized(g, size + 1, size).astype(int)
    bits = (s[:, 1:] > s[:, :-1]).ravel()
    bits = np.pad(bits, (0, -len(bits) % 64))
    return np.packbits(bits, bitorder="little").view("<i8")


def blur_score(g: np.ndarray) -> float:
    """Variance of the Laplacian, with the border mirrored without its edge."""
    a = np.pad(g.astype(np.int32), 1, mode="reflect") if min(g.shape) > 1 else np.pad(g.astype(np.int32), 1, mode="edge")
    return float((a[:-2, 1:-1] + a[2:, 1:-1] + a[1:-1, :-2] + a[1:-1, 2:] - 4 * a[1:-1, 1:-1]).var())


def metrics(a: np.ndarray, hash_size: int = 16) -> dict:
    """All that validation, deduplication, quality and normalisation ask of one decoded image."""
    g = gray(a)
    flat = a.reshape(-1, 3)[:, ::-1].astype(np.float64) / 255  # RGB
    return {"blur": blur_score(g), "brightness": float(g.mean()), "contrast": float(g.std()), "words": difference_hash(g, hash_size).tolist(), "mean": flat.mean(0).tolist(), "std": flat.std(0).tolist()}


def letterbox(a: np.ndarray, width: int, height: int, kind: str = "area", fill: int = PAD) -> tuple[np.ndarray, dict]:
    h, w = a.shape[:2]
    scale = min(width / w, height / h)
    nw, nh = max(1, int(w * scale)), max(1, int(h * scale))
    left, top = (width - nw) // 2, (height - nh) // 2
    out = np.full((height, width, 3), fill, np.uint8)
    out[top : top + nh, left : left + nw] = resized(a, nw, nh, kind)
    return out, {"scale_x": scale, "scale_y": scale, "pad_x": left, "pad_y": top}


def center_crop(a: np.ndarray, width: int, height: int, kind: str = "area") -> tuple[np.ndarray, dict]:
    h, w = a.shape[:2]
    side = min(h, w)
    y, x = (h - side) // 2, (w - side) // 2
    return resized(a[y : y + side, x : x + side], width, height, kind), {"scale_x": None, "scale_y": None, "pad_x": None, "pad_y": None}


def stretch(a: np.ndarray, width: int, height: int, kind: str = "area") -> tuple[np.ndarray, dict]:
    h, w = a.shape[:2]
    return resized(a, width, height, kind), {"scale_x": width / w, "scale_y": height / h, "pad_x": 0, "pad_y": 0}


def mosaic_regions(width: int, height: int, xc: int, yc: int) -> list[tuple[int, int, int, int]]:
    return [(0, 0, xc, yc), (xc, 0, width, yc), (0, yc, xc, height), (xc, yc, width, height)]


def mosaic(images: list[np.ndarray], width: int, height: int, xc: int, yc: int) -> tuple[np.ndarray, list[tuple[int, int, int, int]]]:
    """Four images, each fitted and centred in its region; also where each came to lie (left, top, width, height)."""
    out, at = np.full((height, width, 3), PAD, np.uint8), []
    for a, (x0, y0, x1, y1) in zip(images, mosaic_regions(width, height, xc, yc)):
        h, w = a.shape[:2]
        scale = min((x1 - x0) / w, (y1 - y0) / h)
        nw, nh = max(1, int(w * scale)), max(1, int(h * scale))
        left, top = x0 + (x1 - x0 - nw) // 2, y0 + (y1 - y0 - nh) // 2
        out[top : top + nh, left : left + nw] = resized(a, nw, nh)
        at.append((left, top, nw, nh))
    return out, at


def mixup(a: np.ndarray, b: np.ndarray, share: float) -> np.ndarray:
    b = b if b.shape == a.shape else resized(b, a.shape[1], a.shape[0])
    return (a * share + b * (1 - share)).astype(np.uint8)


def cutout(a: np.ndarray, x: float, y: float, size: float = 0.2) -> np.ndarray:
    """One hole of a fifth of each side at a relative place."""
    h, w = a.shape[:2]
    hh, hw = int(h * size), int(w * size)
    top, left = int(y * max(0, h - hh)), int(x * max(0, w - hw))
    out = a.copy()
    out[top : top + hh, left : left + hw] = PAD
    return out


def tile(a: np.ndarray, x: int, y: int, width: int, height: int) -> np.ndarray:
    part = a[y : y + height, x : x + width]
    out = np.full((height, width, 3), PAD, np.uint8)
    out[: part.shape[0], : part.shape[1]] = part
    return out


def png(a: np.ndarray) -> bytes:
    """The image as an RGB PNG."""
    rows = np.zeros((a.shape[0], 1 + 3 * a.shape[1]), np.uint8)
    rows[:, 1:] = a[:, :, ::-1].reshape(a.shape[0], -1)
    chunk = lambda kind, body: struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))
    head = struct.pack(">IIBBBBB", a.shape[1], a.shape[0], 8, 2, 0, 0, 0)
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(rows.tobytes(), 6)) + chunk(b"IEND", b"")


def header_size(head: bytes) -> tuple[int, int] | None:
    """Width and height from the first bytes of a PNG, BMP or JPEG file, without decoding."""
    if head[:8] == b"\x89PNG\r\n\x1a\n" and len(head) >= 24:
        return struct.unpack(">II", head[16:24])
    if head[:2] == b"BM" and len(head) >= 26:
        w, h = struct.unpack("<ii", head[18:26])
        return w, abs(h)
    at = 2
    while head[:2] == b"\xff\xd8" and at + 9 <= len(head) and head[at] == 0xFF:
        kind, size = head[at + 1], struct.unpack(">H", head[at + 2 : at + 4])[0]
        if 0xC0 <= kind <= 0xCF and kind not in (0xC4, 0xC8, 0xCC):
            h, w = struct.unpack(">HH", head[at + 5 : at + 9])
            return w, h
        at += 2 + size
    return None

"""Pixels of images: decoding, what the image filter asks about, and what makes scans easier to read. All with numpy.

PNG (8 bits a sample, not interlaced) and BMP (24 or 32 bits) are decoded here; other formats if Pillow is installed.
"""

from __future__ import annotations

import io
import struct
import zlib

import numpy as np

CHANNELS = {0: 1, 2: 3, 3: 1, 4: 2, 6: 4}


def decode(data: bytes) -> np.ndarray:
    """Height × width × 3 bytes of an image; ``ValueError`` if it cannot be decoded."""
    if data[:8] == b"\x89PNG\r\n\x1a\n":
        return decode_png(data)
    if data[:2] == b"BM":
        return decode_bmp(data)
    try:
        from PIL import Image
    except ImportError:
        raise ValueError("only PNG and BMP can be decoded without Pillow") from None
    return np.array(Image.open(io.BytesIO(data)).convert("RGB"))


def decode_png(data: bytes) -> np.ndarray:
    at, body, palette = 8, b"", None
    width = height = kind = 0
    while at + 8 <= len(data):
        size, name = struct.unpack(">I4s", data[at : at + 8])
        part = data[at + 8 : at + 8 + size]
        at += 12 + size
        if name == b"IHDR":
            width, height, bits, kind, _, _, interlaced = struct.unpack(">IIBBBBB", part)
            if bits != 8 or interlaced or kind not in CHANNELS:
                raise ValueError("only PNG of 8 bits without interlacing")
        elif name == b"PLTE":
            palette = np.frombuffer(part, np.uint8).reshape(-1, 3)
        elif name == b"IDAT":
            body += part
    n = CHANNELS.get(kind, 0)
    raw = np.frombuffer(zlib.decompress(body), np.uint8).reshape(height, 1 + width * n)
    rows = np.zeros((height + 1, width, n), np.uint8)
    for y in range(height):
        line = raw[y, 1:].reshape(width, n)
        up = rows[y]
        match raw[y, 0]:
            case 0:
                rows[y + 1] = line
            case 1:
                rows[y + 1] = np.cumsum(line, 0, dtype=np.uint8)
            case 2:
                rows[y + 1] = line + up
            case filter_:
                here, now = np.zeros(n, np.int64), rows[y + 1]
                before = np.zeros(n, np.int64)
                for x in range(width):
                    above = up[x].astype(np.int64)
                    if filter_ == 3:
                        guess = (here + above) // 2
                    else:
                        p = here + above - before
                        a, b, c = abs(p - here), abs(p - above), abs(p - before)
                        guess = np.where((a <= b) & (a <= c), here, np.where(b <= c, above, before))
                    before = above
                    here = (line[x] + guess) % 256
                    now[x] = here
    pixels = rows[1:]
    if kind == 3:
        return palette[pixels[:, :, 0]]
    return np.repeat(pixels[:, :, :1], 3, 2) if kind in (0, 4) else pixels[:, :, :3].copy()


def decode_bmp(data: bytes) -> np.ndarray:
    start, = struct.unpack("<I", data[10:14])
    width, height, _, bits = struct.unpack("<iiHH", data[18:30])
    n = bits // 8
    if n not in (3, 4):
        raise ValueError("only BMP of 24 or 32 bits")
    stride = -(-width * n // 4) * 4
    rows = np.frombuffer(data, np.uint8, stride * abs(height), start).reshape(abs(height), stride)[:, : width * n].reshape(abs(height), width, n)
    rows = rows[:, :, 2::-1]
    return rows[::-1].copy() if height > 0 else rows.copy()


def grey(pixels: np.ndarray) -> np.ndarray:
    return (pixels.astype(float) @ [0.299, 0.587, 0.114]).round().astype(np.uint8)


def _shift(a: np.ndarray, dy: int, dx: int) -> np.ndarray:
    """``a`` moved so that each place holds its neighbour at (dy, dx); edges repeat."""
    p = np.pad(a, 1, "edge")
    return p[1 + dy : 1 + dy + a.shape[0], 1 + dx : 1 + dx + a.shape[1]]


def edge_map(g: np.ndarray, low: float = 100.0, high: float = 200.0) -> np.ndarray:
    """Edges with two thresholds (Canny, 1986): ridges of the gradient over ``low`` that hang together with one over ``high``."""
    a = g.astype(float)
    d = {(y, x): _shift(a, y, x) for y in (-1, 0, 1) for x in (-1, 0, 1)}
    gx = d[-1, 1] + 2 * d[0, 1] + d[1, 1] - d[-1, -1] - 2 * d[0, -1] - d[1, -1]
    gy = d[1, -1] + 2 * d[1, 0] + d[1, 1] - d[-1, -1] - 2 * d[-1, 0] - d[-1, 1]
    size = abs(gx) + abs(gy)
    flat, steep = abs(gy) <= 0.4142 * abs(gx), abs(gy) > 2.4142 * abs(gx)
    same = (gx * gy) >= 0
    ridge = np.zeros(size.shape, bool)
    for where, (y, x) in ((flat, (0, 1)), (steep, (1, 0)), (~flat & ~steep & same, (1, 1)), (~flat & ~steep & ~same, (1, -1))):
        ridge |= where & (size > _shift(size, -y, -x)) & (size >= _shift(size, y, x))
    weak, strong = ridge & (size > low), ridge & (size > high)
    while True:
        grown = strong.copy()
        for y in (-1, 0, 1):
            for x in (-1, 0, 1):
                grown |= _shift(strong, y, x)
        grown &= weak
        if (grown == strong).all():
            return strong
        strong = grown


def features(data: bytes) -> dict:
    """Width, height, share of edge pixels and number of colours (at most 256 are told apart) of an image."""
    p = decode(data)
    codes = p.astype(np.int64) @ [65536, 256, 1]
    return {"width": p.shape[1], "height": p.shape[0], "edge_density": float(edge_map(grey(p)).mean()), "colours": int(min(257, len(np.unique(codes))))}


def otsu(g: np.ndarray) -> int:
    """The threshold that parts the grey values best (Otsu, 1979)."""
    n = np.bincount(g.ravel(), minlength=256).astype(float)
    below, total = np.cumsum(n), n.sum()
    sums = np.cumsum(n * np.arange(256))
    with np.errstate(divide="ignore", invalid="ignore"):
        between = (sums[-1] * below / total - sums) ** 2 / (below * (total - below))
    return int(np.nan_to_num(between, nan=0.0, posinf=0.0).argmax())


def enhanced(g: np.ndarray, window: int = 11, offset: float = 2.0) -> np.ndarray:
    """A grey scan made black and white by the Gaussian mean around each pixel, without specks, and turned upright."""
    sigma = 0.3 * ((window - 1) * 0.5 - 1) + 0.8
    k = np.exp(-((np.arange(window) - window // 2) ** 2) / (2 * sigma * sigma))
    k /= k.sum()
    r = window // 2
    p = np.pad(g.astype(float), r, "edge")
    p = sum(w * p[i : i + g.shape[0]] for i, w in enumerate(k))
    mean = sum(w * p[:, i : i + g.shape[1]] for i, w in enumerate(k))
    binary = np.where(g > mean - offset, 255, 0).astype(np.uint8)
    clear = np.median(np.stack([_shift(binary, y, x) for y in (-1, 0, 1) for x in (-1, 0, 1)]), 0).astype(np.uint8)
    return turned(clear, skew(clear))


def skew(binary: np.ndarray, most: float = 5.0) -> float:
    """The angle in degrees, within ``most``, at which the rows of dark pixels stand out most; 0 without any gain."""
    y, x = np.nonzero(binary == 0)
    if not len(y):
        return 0.0

    def contrast(angle: float) -> float:
        rows = np.round(y - x * np.tan(np.radians(angle))).astype(np.int64)
        n = np.bincount(rows - rows.min())
        return float((n.astype(float) ** 2).sum())

    angles = sorted(np.arange(-most, most + 0.25, 0.5), key=abs)
    return float(max(angles, key=contrast))


def turned(binary: np.ndarray, angle: float) -> np.ndarray:
    """``binary`` turned by ``-angle`` degrees around its middle; what comes in from outside is white."""
    if abs(angle) < 0.5:
        return binary
    h, w = binary.shape
    t = np.radians(angle)
    y, x = np.mgrid[:h, :w]
    cy, cx = (h - 1) / 2, (w - 1) / 2
    sy = np.round(cy + (y - cy) * np.cos(t) + (x - cx) * np.sin(t)).astype(np.int64)
    sx = np.round(cx + (x - cx) * np.cos(t) - (y - cy) * np.sin(t)).astype(np.int64)
    inside = (sy >= 0) & (sy < h) & (sx >= 0) & (sx < w)
    return np.where(inside, binary[sy.clip(0, h - 1), sx.clip(0, w - 1)], 255).astype(np.uint8)

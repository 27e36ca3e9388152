"""PNG coding in NumPy: any bit depth, colour type and interlacing in, 8 or 16 bits out."""

from __future__ import annotations

import struct
import zlib

import numpy as np

# Fixed values of the PNG specification.
SIGNATURE = b"\x89PNG\r\n\x1a\n"
CHANNELS = {0: 1, 2: 3, 3: 1, 4: 2, 6: 4}
COLOUR_TYPES = {1: 0, 2: 4, 3: 2, 4: 6}
ADAM7 = [(0, 0, 8, 8), (0, 4, 8, 8), (4, 0, 8, 4), (0, 2, 4, 4), (2, 0, 4, 2), (0, 1, 2, 2), (1, 0, 2, 1)]


def _paeth(left, up, corner):
    p = left + up - corner
    a, b, c = abs(p - left), abs(p - up), abs(p - corner)
    return np.where((a <= b) & (a <= c), left, np.where(b <= c, up, corner))


def _guesses(left, up, corner) -> list:
    return [np.zeros_like(left), left, up, (left + up) >> 1, _paeth(left, up, corner)]


def _unfiltered(kinds: np.ndarray, lines: np.ndarray, step: int) -> np.ndarray:
    """
    Lines of bytes without their filters. A byte needs those to the left, above and above left, so all places of an
    anti-diagonal are done at once.
    """
    if len(kinds) and kinds.max() > 4:
        raise ValueError("PNG: unknown filter")
    h, w = len(lines), lines.shape[1] // step
    raw = lines.reshape(h, w, step).astype(np.int16)
    x = np.zeros((h + 1, w + 1, step), np.int16)
    if not kinds.any():
        return lines
    for d in range(h + w - 1):
        ys = np.arange(max(0, d - w + 1), min(h, d + 1))
        xs = d - ys
        guess = np.choose(kinds[ys][:, None], _guesses(x[ys + 1, xs], x[ys, xs + 1], x[ys, xs]))
        x[ys + 1, xs + 1] = (raw[ys, xs] + guess) & 255
    return x[1:, 1:].astype(np.uint8).reshape(h, -1)


def _samples(lines: np.ndarray, w: int, channels: int, depth: int) -> np.ndarray:
    if depth == 16:
        return np.ascontiguousarray(lines).view(">u2").astype(np.uint16).reshape(len(lines), w, channels)
    if depth < 8:
        bits = np.unpackbits(lines, axis=1)[:, : w * depth].reshape(len(lines), w, depth)
        lines = (bits << np.arange(depth - 1, -1, -1, dtype=np.uint8)).sum(2, dtype=np.uint8)
    return lines.reshape(len(lines), w, channels)


def _chunks(content: bytes):
    at = len(SIGNATURE)
    while at < len(content):
        if len(content) < at + 12:
            raise ValueError("PNG: cut short")
        (n,), kind = struct.unpack(">I", content[at : at + 4]), content[at + 4 : at + 8]
        body, crc = content[at + 8 : at + 8 + n], content[at + 8 + n : at + 12 + n]
        if crc != struct.pack(">I", zlib.crc32(kind + body)):
            raise ValueError("PNG: wrong checksum")
        yield kind, body
        at += 12 + n


def decode(content: bytes) -> np.ndarray:
    """(h, w, c) of 8 or 16 bits: gray, gray with alpha, RGB or RGBA. Palettes become colours, fewer bits 8 bits. Damaged data is a ValueError."""
    if content[:8] != SIGNATURE:
        raise ValueError("not a PNG")
    found: dict[bytes, bytes] = {}
    data = []
    for kind, body in _chunks(content):
        if kind == b"IDAT":
            data.append(body)
        else:
            found.setdefault(kind, body)
    if b"IHDR" not in found or b"IEND" not in found:
        raise ValueError("PNG: cut short")
    w, h, depth, colour, _, _, interlaced = struct.unpack(">IIBBBBB", found[b"IHDR"])
    channels = CHANNELS[colour]
    try:
        plain = np.frombuffer(zlib.decompress(b"".join(data)), np.uint8)
    except zlib.error as e:
        raise ValueError("PNG: damaged data") from e
    out = np.zeros((h, w, channels), np.uint16 if depth == 16 else np.uint8)
    at, step = 0, max(1, channels * depth // 8)
    for top, left, down, across in ADAM7 if interlaced else [(0, 0, 1, 1)]:
        ph, pw = -(-(h - top) // down), -(-(w - left) // across)
        if ph <= 0 or pw <= 0:
            continue
        size = 1 + -(-pw * channels * depth // 8)
        if len(plain) < at + ph * size:
            raise ValueError("PNG: cut short")
        lines = plain[at : at + ph * size].reshape(ph, size)
        at += ph * size
        out[top::down, left::across] = _samples(_unfiltered(lines[:, 0], lines[:, 1:], step), pw, channels, depth)
    if colour == 3:
        palette = np.frombuffer(found[b"PLTE"], np.uint8).reshape(-1, 3)
        if b"tRNS" in found:
            alpha = np.full(len(palette), 255, np.uint8)
            given = np.frombuffer(found[b"tRNS"], np.uint8)
            alpha[: len(given)] = given
            palette = np.column_stack([palette, alpha])
        if out.size and out.max() >= len(palette):
            raise ValueError("PNG: colour outside the palette")
        return palette[out[:, :, 0]]
    return out * np.uint8(255 // (2**depth - 1)) if depth < 8 else out


def encode(x: np.ndarray, level: int = 1) -> bytes:
    """x: (h, w) or (h, w, c) of uint8 or uint16, 1 to 4 channels; each line has the filter with the least sum of absolute differences."""
    x = x[:, :, None] if x.ndim == 2 else x
    h, w, c = x.shape
    if c not in COLOUR_TYPES or x.dtype not in (np.uint8, np.uint16) or not h * w:
        raise ValueError(f"PNG: {x.dtype} of {x.shape}")
    wide = x.dtype.itemsize
    raw = np.frombuffer(x.astype(">u2" if wide == 2 else np.uint8).tobytes(), np.uint8).reshape(h, w, c * wide).astype(np.int16)
    around = np.zeros((h + 1, w + 1, c * wide), np.int16)
    around[1:, 1:] = raw
    tries = np.stack([(raw - g) & 255 for g in _guesses(around[1:, :-1], around[:-1, 1:], around[:-1, :-1])]).astype(np.uint8).reshape(5, h, -1)
    best = np.minimum(tries, 256 - tries.astype(np.int32)).sum(2).argmin(0)
    lines = np.column_stack([best.astype(np.uint8), tries[best, np.arange(h)]])
    header = struct.pack(">IIBBBBB", w, h, 8 * wide, COLOUR_TYPES[c], 0, 0, 0)
    parts = [(b"IHDR", header), (b"IDAT", zlib.compress(lines.tobytes(), level)), (b"IEND", b"")]
    return SIGNATURE + b"".join(struct.pack(">I", len(b)) + k + b + struct.pack(">I", zlib.crc32(k + b)) for k, b in parts)


def as_flag(x: np.ndarray, flag: str) -> np.ndarray:
    """color: RGB of 8 bits; grayscale: BT.601 luma of 8 bits in 14-bit fixed point; unchanged: what is stored."""
    if flag == "unchanged":
        return x
    x = (x >> 8).astype(np.uint8) if x.dtype == np.uint16 else x
    x = x[:, :, :-1] if x.shape[2] in (2, 4) else x
    if flag == "color":
        return np.repeat(x, 3, 2) if x.shape[2] == 1 else x
    if flag == "grayscale":
        return x if x.shape[2] == 1 else ((x.astype(np.int32) @ np.array([4899, 9617, 1868]) + 8192) >> 14).astype(np.uint8)[:, :, None]
    raise ValueError(f"unknown flag {flag}")

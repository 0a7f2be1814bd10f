"""Lossless WebP (VP8L, RFC 9649): a complete decoder, and an encoder for every feature that it reads.

Images are numpy arrays of 32-bit ARGB pixels. The decoder takes prefix codes
(simple, normal, several groups), back-references, the colour cache, and the
predictor, cross-colour, subtract-green and palette transforms. ``media``
decodes many images of a plainer form at once.
"""

from __future__ import annotations

import heapq
import struct

import numpy as np

# Fixed values of the format.
PREDICTOR, CROSS_COLOUR, SUBTRACT_GREEN, PALETTE = 0, 1, 2, 3
LENGTH_ORDER = (17, 18, 0, 1, 2, 3, 4, 5, 16, 6, 7, 8, 9, 10, 11, 12, 13, 14, 15)
LENGTH_SYMBOLS, DISTANCE_SYMBOLS, CACHE_FACTOR = 24, 40, 0x1E35A7BD
# Neighbours (columns to the left, rows up) that the first 120 distance codes stand for.
NEIGHBOURS = (
    (0, 1), (1, 0), (1, 1), (-1, 1), (0, 2), (2, 0), (1, 2), (-1, 2),
    (2, 1), (-2, 1), (2, 2), (-2, 2), (0, 3), (3, 0), (1, 3), (-1, 3),
    (3, 1), (-3, 1), (2, 3), (-2, 3), (3, 2), (-3, 2), (0, 4), (4, 0),
    (1, 4), (-1, 4), (4, 1), (-4, 1), (3, 3), (-3, 3), (2, 4), (-2, 4),
    (4, 2), (-4, 2), (0, 5), (3, 4), (-3, 4), (4, 3), (-4, 3), (5, 0),
    (1, 5), (-1, 5), (5, 1), (-5, 1), (2, 5), (-2, 5), (5, 2), (-5, 2),
    (4, 4), (-4, 4), (3, 5), (-3, 5), (5, 3), (-5, 3), (0, 6), (6, 0),
    (1, 6), (-1, 6), (6, 1), (-6, 1), (2, 6), (-2, 6), (6, 2), (-6, 2),
    (4, 5), (-4, 5), (5, 4), (-5, 4), (3, 6), (-3, 6), (6, 3), (-6, 3),
    (0, 7), (7, 0), (1, 7), (-1, 7), (5, 5), (-5, 5), (7, 1), (-7, 1),
    (4, 6), (-4, 6), (6, 4), (-6, 4), (2, 7), (-2, 7), (7, 2), (-7, 2),
    (3, 7), (-3, 7), (7, 3), (-7, 3), (5, 6), (-5, 6), (6, 5), (-6, 5),
    (8, 0), (4, 7), (-4, 7), (7, 4), (-7, 4), (8, 1), (8, 2), (6, 6),
    (-6, 6), (8, 3), (5, 7), (-5, 7), (7, 5), (-7, 5), (8, 4), (6, 7),
    (-6, 7), (7, 6), (-7, 6), (8, 5), (7, 7), (-7, 7), (8, 6), (8, 7),
)
CODE_OF_NEIGHBOUR = {n: k + 1 for k, n in enumerate(NEIGHBOURS)}


class Bits:
    """Bits of a byte string, least significant first."""

    def __init__(self, data: bytes, at: int = 0):
        self.data, self.at = data, at

    def read(self, n: int) -> int:
        i = self.at >> 3
        value = int.from_bytes(self.data[i : i + 5], "little") >> (self.at & 7) & ((1 << n) - 1)
        self.at += n
        return value


class BitWriter:
    def __init__(self):
        self.value, self.size, self.parts = 0, 0, []

    def write(self, value: int, n: int) -> None:
        self.value |= value << self.size
        self.size += n
        if self.size >= 4096:
            whole = self.size // 8
            self.parts.append((self.value & ((1 << 8 * whole) - 1)).to_bytes(whole, "little"))
            self.value >>= 8 * whole
            self.size -= 8 * whole

    def bytes(self) -> bytes:
        return b"".join(self.parts) + self.value.to_bytes((self.size + 7) // 8, "little")


def reverse(code: int, n: int) -> int:
    return int(format(code, f"0{n}b")[::-1], 2) if n else 0


def canonical(lengths: list[int]) -> dict[int, tuple[int, int]]:
    """symbol -> (code as it stands in the stream, length)."""
    code, out = 0, {}
    for n in range(1, 16):
        code <<= 1
        for symbol, length in enumerate(lengths):
            if length == n:
                out[symbol] = (reverse(code, n), n)
                code += 1
    return out


class Prefix:
    """A prefix code for reading; a lone symbol takes no bits."""

    def __init__(self, lengths: list[int]):
        used = [s for s, n in enumerate(lengths) if n]
        self.lone = used[0] if len(used) == 1 else None
        if not used:
            self.lone = 0
        if self.lone is None:
            if sum(1 << (15 - lengths[s]) for s in used) != 1 << 15:
                raise ValueError("incomplete prefix code")
            self.table = {(n, code): s for s, (code, n) in canonical(lengths).items()}
            self.least = min(lengths[s] for s in used)

    def read(self, bits: Bits) -> int:
        if self.lone is not None:
            return self.lone
        i = bits.at >> 3
        window = int.from_bytes(bits.data[i : i + 3], "little") >> (bits.at & 7)
        n = self.least
        while True:
            symbol = self.table.get((n, window & ((1 << n) - 1)))
            if symbol is not None:
                bits.at += n
                return symbol
            n += 1
            if n > 15:
                raise ValueError("no such code")


def read_lengths(bits: Bits, alphabet: int) -> list[int]:
    lengths = [0] * alphabet
    if bits.read(1):
        two = bits.read(1)
        wide = bits.read(1)
        lengths[bits.read(8 if wide else 1)] = 1
        if two:
            lengths[bits.read(8)] = 1
        return lengths
    of_lengths = [0] * 19
    for k in range(4 + bits.read(4)):
        of_lengths[LENGTH_ORDER[k]] = bits.read(3)
    most = 2 + bits.read(2 + 2 * bits.read(3)) if bits.read(1) else alphabet
    code, at, last = Prefix(of_lengths), 0, 8
    while at < alphabet and most:
        most -= 1
        s = code.read(bits)
        if s < 16:
            lengths[at] = s
            at += 1
            last = s or last
            continue
        value, times = {16: (last, 3 + bits.read(2)) if s == 16 else None, 17: (0, 3 + bits.read(3)) if s == 17 else None, 18: (0, 11 + bits.read(7)) if s == 18 else None}[s]
        if at + times > alphabet:
            raise ValueError("too many code lengths")
        lengths[at : at + times] = [value] * times
        at += times
    return lengths


def _copy_value(symbol: int, bits: Bits) -> int:
    if symbol < 4:
        return symbol + 1
    extra = (symbol - 2) >> 1
    return ((2 + (symbol & 1)) << extra) + bits.read(extra) + 1


def copy_symbol(value: int) -> tuple[int, int, int]:
    """(symbol, extra bits, their number) of a length or distance code."""
    v = value - 1
    if v < 4:
        return v, 0, 0
    top = v.bit_length() - 1
    second = v >> (top - 1) & 1
    extra = top - 1
    return 2 * top + second, v & ((1 << extra) - 1), extra


def _blocks(size: int, bits: int) -> int:
    return (size + (1 << bits) - 1) >> bits


def _decode_pixels(bits: Bits, width: int, height: int, main: bool) -> np.ndarray:
    cache_bits = bits.read(4) if bits.read(1) else 0
    groups_of, block_bits, n_groups = None, 0, 1
    if main and bits.read(1):
        block_bits = bits.read(3) + 2
        groups_of = _decode_pixels(bits, _blocks(width, block_bits), _blocks(height, block_bits), False) >> 8 & 0xFFFF
        n_groups = int(groups_of.max()) + 1
    sizes = (256 + LENGTH_SYMBOLS + (1 << cache_bits if cache_bits else 0), 256, 256, 256, DISTANCE_SYMBOLS)
    groups = [[Prefix(read_lengths(bits, n)) for n in sizes] for _ in range(n_groups)]
    cache = [0] * (1 << cache_bits) if cache_bits else []
    out, total, per_row = [], width * height, _blocks(width, block_bits)
    group = groups[0]

    def keep(pixel: int) -> None:
        if cache_bits:
            cache[(CACHE_FACTOR * pixel & 0xFFFFFFFF) >> (32 - cache_bits)] = pixel

    while len(out) < total:
        if groups_of is not None:
            y, x = divmod(len(out), width)
            group = groups[groups_of.flat[(y >> block_bits) * per_row + (x >> block_bits)]]
        s = group[0].read(bits)
        if s < 256:
            red, blue, alpha = group[1].read(bits), group[2].read(bits), group[3].read(bits)
            out.append(alpha << 24 | red << 16 | s << 8 | blue)
            keep(out[-1])
        elif s < 256 + LENGTH_SYMBOLS:
            length = _copy_value(s - 256, bits)
            code = _copy_value(group[4].read(bits), bits)
            if code > len(NEIGHBOURS):
                distance = code - len(NEIGHBOURS)
            else:
                dx, dy = NEIGHBOURS[code - 1]
                distance = max(1, dx + dy * width)
            if distance > len(out) or len(out) + length > total:
                raise ValueError("back-reference out of the image")
            for _ in range(length):
                out.append(out[-distance])
                keep(out[-1])
        else:
            out.append(cache[s - 256 - LENGTH_SYMBOLS])
            keep(out[-1])
    return np.array(out, np.uint32).reshape(height, width)


def _channels(p: np.ndarray) -> np.ndarray:
    """(..., 4) alpha, red, green, blue."""
    return np.stack([p >> s & 0xFF for s in (24, 16, 8, 0)], -1).astype(np.int64)


def _joined(c: np.ndarray) -> np.ndarray:
    c = (c & 0xFF).astype(np.uint32)
    return c[..., 0] << 24 | c[..., 1] << 16 | c[..., 2] << 8 | c[..., 3]


def predict(mode: int, left, top, top_left, top_right) -> list[int]:
    """A pixel's prediction from its neighbours' channels."""
    avg = lambda a, b: [(x + y) >> 1 for x, y in zip(a, b)]
    clamp = lambda v: min(255, max(0, v))
    if mode == 0 or mode > 13:
        return [255, 0, 0, 0]
    if mode == 11:
        near_left = sum(abs(t - tl) for t, tl in zip(top, top_left))
        near_top = sum(abs(le - tl) for le, tl in zip(left, top_left))
        return left if near_left < near_top else top
    if mode == 12:
        return [clamp(a + b - c) for a, b, c in zip(left, top, top_left)]
    if mode == 13:
        return [clamp(a + int((a - c) / 2)) for a, c in zip(avg(left, top), top_left)]
    return {
        1: lambda: left,
        2: lambda: top,
        3: lambda: top_right,
        4: lambda: top_left,
        5: lambda: avg(avg(left, top_right), top),
        6: lambda: avg(left, top_left),
        7: lambda: avg(left, top),
        8: lambda: avg(top_left, top),
        9: lambda: avg(top, top_right),
        10: lambda: avg(avg(left, top_left), avg(top, top_right)),
    }[mode]()


def _predictions(c: list, x: int, y: int, width: int, mode: int) -> list[int]:
    if y == 0:
        return [255, 0, 0, 0] if x == 0 else c[y][x - 1]
    if x == 0:
        return c[y - 1][0]
    right = c[y - 1][x + 1] if x + 1 < width else c[y][0]
    return predict(mode, c[y][x - 1], c[y - 1][x], c[y - 1][x - 1], right)


def undo_predictor(p: np.ndarray, modes: np.ndarray, bits: int) -> np.ndarray:
    h, w = p.shape
    mode = np.unique(modes >> np.uint32(8) & np.uint32(0xF))
    if len(mode) == 1 and mode[0] in (1, 2):  # running sums
        c = _channels(p).astype(np.uint8)
        c[0, 0, 0] += 255
        if mode[0] == 1:
            c[:, 0] = np.cumsum(c[:, 0], 0, dtype=np.uint8)
            return _joined(np.cumsum(c, 1, dtype=np.uint8).astype(np.int64))
        c[0] = np.cumsum(c[0], 0, dtype=np.uint8)
        return _joined(np.cumsum(c, 0, dtype=np.uint8).astype(np.int64))
    c = _channels(p).tolist()
    for y in range(h):
        for x in range(w):
            guess = _predictions(c, x, y, w, int(modes[y >> bits, x >> bits]) >> 8 & 0xF)
            c[y][x] = [(a + b) & 0xFF for a, b in zip(c[y][x], guess)]
    return _joined(np.array(c))


def do_predictor(p: np.ndarray, modes: np.ndarray, bits: int) -> np.ndarray:
    h, w = p.shape
    c = _channels(p).tolist()
    out = [[[(a - b) & 0xFF for a, b in zip(c[y][x], _predictions(c, x, y, w, int(modes[y >> bits, x >> bits]) >> 8 & 0xF))] for x in range(w)] for y in range(h)]
    return _joined(np.array(out))


def cross_colour(p: np.ndarray, blocks: np.ndarray, bits: int, sign: int) -> np.ndarray:
    """Adds (sign 1) or takes away (-1) what the blocks' factors predict of red and blue."""
    h, w = p.shape
    c = _channels(p)
    b = blocks[np.arange(h)[:, None] >> bits, np.arange(w)[None, :] >> bits]
    signed = lambda v: ((v & 0xFF).astype(np.int64) ^ 0x80) - 0x80
    part = lambda factor, colour: signed(factor) * signed(colour) >> 5
    green, red = c[..., 2], c[..., 1]
    new_red = red + sign * part(b, green) & 0xFF
    original_red = new_red if sign == 1 else red
    c[..., 3] += sign * (part(b >> 8, green) + part(b >> 16, original_red))
    c[..., 1] = new_red
    return _joined(c)


def _green(p: np.ndarray, sign: int) -> np.ndarray:
    c = _channels(p)
    c[..., 1] += sign * c[..., 2]
    c[..., 3] += sign * c[..., 2]
    return _joined(c)


def _bundle_bits(colours: int) -> int:
    return 3 if colours <= 2 else 2 if colours <= 4 else 1 if colours <= 16 else 0


def undo_palette(p: np.ndarray, palette: np.ndarray, width: int) -> np.ndarray:
    bits = _bundle_bits(len(palette))
    each = 8 >> bits
    x = np.arange(width)
    index = (p >> 8 & 0xFF)[:, x >> bits] >> (x & (1 << bits) - 1) * each & (1 << each) - 1
    full = np.zeros(256, np.uint32)
    full[: len(palette)] = palette
    return full[index]


def read_head(bits: Bits) -> tuple[int, int, int, list, int]:
    """(width, height, alpha flag, transforms to undo, width of the coded image); each transform is (kind, width, block bits, data)."""
    if bits.read(8) != 0x2F:
        raise ValueError("no VP8L signature")
    width, height = bits.read(14) + 1, bits.read(14) + 1
    has_alpha, version = bits.read(1), bits.read(3)
    if version:
        raise ValueError("unknown version")
    undo, w = [], width
    while bits.read(1):
        kind = bits.read(2)
        if kind in (PREDICTOR, CROSS_COLOUR):
            size = bits.read(3) + 2
            undo.append((kind, w, size, _decode_pixels(bits, _blocks(w, size), _blocks(height, size), False)))
        elif kind == PALETTE:
            n = bits.read(8) + 1
            table = _joined(np.cumsum(_channels(_decode_pixels(bits, n, 1, False)[0]), 0))
            undo.append((kind, w, 0, table))
            w = _blocks(w, _bundle_bits(n))
        else:
            undo.append((kind, w, 0, None))
    return width, height, has_alpha, undo, w


def undo_transforms(p: np.ndarray, undo: list) -> np.ndarray:
    """The image that the transforms, last one first, were applied to."""
    for kind, w, size, extra in reversed(undo):
        if kind == PREDICTOR:
            p = undo_predictor(p, extra, size)
        elif kind == CROSS_COLOUR:
            p = cross_colour(p, extra, size, 1)
        elif kind == SUBTRACT_GREEN:
            p = _green(p, 1)
        else:
            p = undo_palette(p, extra, w)
    return p


def decode_stream(data: bytes) -> np.ndarray:
    """Pixels of a VP8L chunk's data."""
    bits = Bits(data)
    _, height, has_alpha, undo, w = read_head(bits)
    p = undo_transforms(_decode_pixels(bits, w, height, True), undo)
    return p if has_alpha else p | np.uint32(0xFF000000)


def streams(data: bytes) -> list[bytes]:
    """The VP8L chunks of a file, one for each frame."""
    if data[:4] != b"RIFF" or data[8:12] != b"WEBP":
        raise ValueError("no WebP file")
    out = []

    def walk(at: int, end: int) -> None:
        while at + 8 <= end:
            name, size = data[at : at + 4], int.from_bytes(data[at + 4 : at + 8], "little")
            if name == b"VP8L":
                out.append(data[at + 8 : at + 8 + size])
            elif name == b"ANMF":
                walk(at + 8 + 16, at + 8 + size)
            at += 8 + size + (size & 1)

    walk(12, 8 + int.from_bytes(data[4:8], "little"))
    return out


def decode(data: bytes) -> list[np.ndarray]:
    """All frames of a file."""
    return [decode_stream(s) for s in streams(data)]


def _chunk(name: bytes, data: bytes) -> bytes:
    return name + struct.pack("<I", len(data)) + data + b"\0" * (len(data) & 1)


def container(frames: list[tuple[bytes, int, int]]) -> bytes:
    """A file of (VP8L data, width, height) frames: a plain one for a single frame, else an animation."""
    if len(frames) == 1:
        body = _chunk(b"VP8L", frames[0][0])
    else:
        w, h = max(f[1] for f in frames), max(f[2] for f in frames)
        three = lambda v: struct.pack("<I", v)[:3]
        parts = [_chunk(b"VP8X", b"\x02\0\0\0" + three(w - 1) + three(h - 1)), _chunk(b"ANIM", b"\0\0\0\0\0\0")]
        for data, fw, fh in frames:
            parts.append(_chunk(b"ANMF", three(0) + three(0) + three(fw - 1) + three(fh - 1) + three(1) + b"\x02" + _chunk(b"VP8L", data)))
        body = b"".join(parts)
    return b"RIFF" + struct.pack("<I", 4 + len(body)) + b"WEBP" + body


# The encoder, one pixel at a time: for images that need the transforms.


def code_lengths(counts: list[int], most: int = 15) -> list[int]:
    """Huffman code lengths, flattened until none is over ``most``."""
    used = [s for s, n in enumerate(counts) if n]
    lengths = [0] * len(counts)
    if len(used) < 2:
        for s in used:
            lengths[s] = 1
        return lengths
    weights = {s: counts[s] for s in used}
    while True:
        heap = [(weights[s], k, (s,)) for k, s in enumerate(used)]
        heapq.heapify(heap)
        depth, k = dict.fromkeys(used, 0), len(heap)
        while len(heap) > 1:
            a, b = heapq.heappop(heap), heapq.heappop(heap)
            for s in a[2] + b[2]:
                depth[s] += 1
            heapq.heappush(heap, (a[0] + b[0], k, a[2] + b[2]))
            k += 1
        if max(depth.values()) <= most:
            for s in used:
                lengths[s] = depth[s]
            return lengths
        weights = {s: (w + 1) // 2 for s, w in weights.items()}


def _write_code(out: BitWriter, lengths: list[int]) -> dict[int, tuple[int, int]]:
    used = [s for s, n in enumerate(lengths) if n]
    if len(used) <= 2 and all(s < 256 for s in used):
        used = used or [0]
        out.write(1, 1)
        out.write(len(used) - 1, 1)
        out.write(1, 1)
        for s in used:
            out.write(s, 8)
        return {used[0]: (0, 0)} if len(used) == 1 else {used[0]: (0, 1), used[1]: (1, 1)}
    tokens, at = [], 0
    while at < len(lengths):
        run = 1
        while at + run < len(lengths) and lengths[at + run] == lengths[at] and run < 138:
            run += 1
        if lengths[at] == 0 and run >= 11:
            tokens.append((18, run - 11, 7))
        elif lengths[at] == 0 and run >= 3:
            run = min(run, 10)
            tokens.append((17, run - 3, 3))
        elif run >= 4:
            run = min(run, 7)
            tokens += [(lengths[at], 0, 0), (16, run - 4, 2)]
        else:
            run = 1
            tokens.append((lengths[at], 0, 0))
        at += run
    counts = [0] * 19
    for t in tokens:
        counts[t[0]] += 1
    of_lengths = code_lengths(counts, 7)
    out.write(0, 1)
    out.write(15, 4)
    for s in LENGTH_ORDER:
        out.write(of_lengths[s], 3)
    out.write(0, 1)
    lone = sum(n > 0 for n in of_lengths) == 1
    codes = canonical(of_lengths)
    for s, value, n in tokens:
        if not lone:
            out.write(*codes[s])
        out.write(value, n)
    return {s: (0, 0) for s in used} if len(used) == 1 else canonical(lengths)


def _write_pixels(out: BitWriter, p: np.ndarray, main: bool, cache_bits: int = 0, copies: bool = True, group_bits: int | None = None) -> None:
    h, w = p.shape
    flat = [int(v) for v in p.reshape(-1)]
    groups_of, per_row, n_groups = None, 0, 1
    if main and group_bits is not None:
        per_row = _blocks(w, group_bits)
        grid = np.add.outer(np.arange(_blocks(h, group_bits)), np.arange(per_row)) % 2
        groups_of, n_groups = grid.reshape(-1), int(grid.max()) + 1
    tokens, cache, seen, at = [], {}, {}, 0
    while at < len(flat):
        length = 0
        if copies and at + 3 <= len(flat):
            key = tuple(flat[at : at + 3])
            if key in seen:
                start = seen[key]
                while at + length < len(flat) and length < 4096 and flat[start + length] == flat[at + length]:
                    length += 1
        if length >= 3:
            distance = at - seen[key]
            code = next((c for (dx, dy), c in CODE_OF_NEIGHBOUR.items() if max(1, dx + dy * w) == distance), distance + len(NEIGHBOURS))
            tokens.append((at, "copy", length, code))
            step = length
        else:
            pixel = flat[at]
            slot = (CACHE_FACTOR * pixel & 0xFFFFFFFF) >> (32 - cache_bits) if cache_bits else 0
            tokens.append((at, "cache", slot, 0) if cache_bits and cache.get(slot, 0 if slot in cache else None) == pixel else (at, "pixel", pixel, 0))
            step = 1
        for k in range(at, at + step):
            if cache_bits:
                cache[(CACHE_FACTOR * flat[k] & 0xFFFFFFFF) >> (32 - cache_bits)] = flat[k]
            seen[tuple(flat[k : k + 3])] = k
        at += step
    sizes = (256 + LENGTH_SYMBOLS + (1 << cache_bits if cache_bits else 0), 256, 256, 256, DISTANCE_SYMBOLS)
    counts = [[[0] * n for n in sizes] for _ in range(n_groups)]
    parts = []
    for at, kind, a, b in tokens:
        g = 0 if groups_of is None else int(groups_of[(at // w >> group_bits) * per_row + (at % w >> group_bits)])
        if kind == "pixel":
            fields = [(0, a >> 8 & 0xFF, 0, 0), (1, a >> 16 & 0xFF, 0, 0), (2, a & 0xFF, 0, 0), (3, a >> 24, 0, 0)]
        elif kind == "cache":
            fields = [(0, 256 + LENGTH_SYMBOLS + a, 0, 0)]
        else:
            s, value, n = copy_symbol(a)
            t, far, m = copy_symbol(b)
            fields = [(0, 256 + s, value, n), (4, t, far, m)]
        for channel, symbol, _, _ in fields:
            counts[g][channel][symbol] += 1
        parts.append((g, fields))
    out.write(1 if cache_bits else 0, 1)
    if cache_bits:
        out.write(cache_bits, 4)
    if main:
        out.write(0 if groups_of is None else 1, 1)
        if groups_of is not None:
            out.write(group_bits - 2, 3)
            _write_pixels(out, (groups_of.astype(np.uint32) << 8 | np.uint32(0xFF000000)).reshape(-1, per_row), False)
    codes = [[_write_code(out, code_lengths(c)) for c in group] for group in counts]
    for g, fields in parts:
        for channel, symbol, value, n in fields:
            out.write(*codes[g][channel][symbol])
            out.write(value, n)


def encode_stream(p: np.ndarray, transforms: tuple[int, ...] = (), bits: int = 2, cache_bits: int = 0, copies: bool = True, group_bits: int | None = None, modes: np.ndarray | None = None) -> bytes:
    """VP8L data of an image; ``transforms`` are applied in order, each at most once."""
    h, w = p.shape
    out = BitWriter()
    out.write(0x2F, 8)
    out.write(w - 1, 14)
    out.write(h - 1, 14)
    out.write(int((p >> 24 != 255).any()), 1)
    out.write(0, 3)
    for kind in transforms:
        out.write(1, 1)
        out.write(kind, 2)
        if kind in (PREDICTOR, CROSS_COLOUR):
            out.write(bits - 2, 3)
            shape = (_blocks(p.shape[0], bits), _blocks(p.shape[1], bits))
            if kind == PREDICTOR:
                extra = (np.resize(np.arange(14) if modes is None else modes, shape).astype(np.uint32) << 8) | np.uint32(0xFF000000)
                p = do_predictor(p, extra, bits)
            else:
                extra = np.resize(np.array([0xFF0510F0, 0xFFE020A0, 0xFF00FF7F], np.uint32), shape)
                p = cross_colour(p, extra, bits, -1)
            _write_pixels(out, extra, False)
        elif kind == PALETTE:
            colours, index = np.unique(p, return_inverse=True)
            index = index.reshape(p.shape)
            n = _bundle_bits(len(colours))
            out.write(len(colours) - 1, 8)
            steps = np.diff(_channels(colours), axis=0, prepend=0)
            _write_pixels(out, _joined(steps)[None, :], False)
            packed = np.zeros((h, _blocks(p.shape[1], n)), np.uint32)
            for x in range(p.shape[1]):
                packed[:, x >> n] |= index[:, x].astype(np.uint32) << np.uint32((x & (1 << n) - 1) * (8 >> n))
            p = packed << np.uint32(8) | np.uint32(0xFF000000)
        else:
            p = _green(p, -1)
    out.write(0, 1)
    _write_pixels(out, p, True, cache_bits, copies, group_bits)
    return out.bytes()

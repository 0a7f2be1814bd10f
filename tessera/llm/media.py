"""Texts as lossless WebP files, many at a time.

A text's payload is an RGB image 64 pixels wide; more than ``TILE_ROWS`` rows
make several frames of an animation, so that no image is long. For each image
the encoder picks what promises the fewest bits: no transform, subtract-green,
a predictor (left or top), cross-colour, or a palette with bundled pixels; and
a colour cache or none. Back-references copy periodic stretches.

The images of a batch are encoded and decoded together, all at the same pixel:
prefix codes are built and read as arrays over images, each image has a row of
the colour caches, back-references copy whole runs, and the transforms are
undone image by image as array operations. Streams with several prefix-code
groups, an alpha channel, or codes of more than ``LIMIT`` bits go to the
complete decoder in ``webp``; the encoder here writes none.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import webp
from .scratch import Scratch, ship

UNIT, WIDTH = 192, 64
TILE_ROWS = 64
#: Samples encoded or decoded together; the arrays in use take some fifty times as many bytes.
BATCH_BYTES = 1 << 20
#: A tile counts as at least so many samples: its codes take memory, too.
LEAST_TILE = 2048
LIMIT = 11
#: Bytes of files that a writer of the stored table holds.
ROW_GROUP = 16 << 20
#: Back-references: distances in pixels that are tried, and the least run.
DISTANCES, LEAST_RUN, LONGEST_RUN = 24, 24, 4096
#: Bits of a colour cache's slots.
CACHE = 6
_SLOTS = 256 + webp.LENGTH_SYMBOLS
_GREEN = _SLOTS + (1 << CACHE)
#: Transforms that an image may get, in the order of the estimates; and what a transform's head takes.
PLAIN, GREEN, LEFT, TOP, CROSS = range(5)
_HEAD_BITS = 72
_REVERSED = np.array([webp.reverse(i, LIMIT) for i in range(1 << LIMIT)], np.uint16)
_NIBBLE = np.array([webp.reverse(i, 4) for i in range(16)], np.uint8)
#: Code lengths of code lengths: each of 0 to 15 in four bits, no repeats.
_FLAT = sum((4 if s < 16 else 0) << 3 * k for k, s in enumerate(webp.LENGTH_ORDER))


def payload(text: bytes) -> bytes:
    """The text, filled up with blanks to a positive multiple of 192 bytes."""
    return text + b" " * (max(1, -(-len(text) // UNIT)) * UNIT - len(text))


def code_lengths(counts: np.ndarray) -> np.ndarray:
    """Complete prefix codes of at most ``LIMIT`` bits for each row of counts; a lone symbol gets one bit."""
    used = counts > 0
    total = counts.sum(1, keepdims=True)
    with np.errstate(divide="ignore", invalid="ignore"):
        ideal = np.ceil(np.log2(total / counts))
    lengths = np.where(used, np.clip(np.where(used, ideal, 0), 1, LIMIT), 0).astype(np.int64)
    several = used.sum(1) > 1
    order = np.argsort(-counts, axis=1, kind="stable")
    rows = np.arange(len(counts))
    share = np.where(lengths > 0, 1 << (LIMIT - lengths), 0)
    room = (1 << LIMIT) - share.sum(1)
    width = int(used.sum(1).max(initial=0))
    while (bad := np.flatnonzero((room < 0) & several)).size:  # too short: lengthen rare symbols
        for k in range(width - 1, -1, -1):
            at = bad[room[bad] < 0]
            if not at.size:
                break
            s = order[at, k]
            ok = (lengths[at, s] > 0) & (lengths[at, s] < LIMIT)
            at, s = at[ok], s[ok]
            room[at] += 1 << (LIMIT - lengths[at, s] - 1)
            lengths[at, s] += 1
    while (bad := np.flatnonzero((room > 0) & several)).size:  # incomplete: shorten frequent symbols
        for k in range(width):
            if not bad.size:
                break
            s = order[bad, k]
            n = lengths[bad, s]
            ok = (n > 1) & (room[bad] >= 1 << (LIMIT - n))
            at = bad[ok]
            room[at] -= 1 << (LIMIT - n[ok])
            lengths[at, s[ok]] -= 1
            bad = bad[room[bad] > 0]
    del rows
    return lengths


def codes(lengths: np.ndarray) -> np.ndarray:
    """Each symbol's code as it stands in the stream; lone symbols have length 0 there."""
    out = np.zeros(lengths.shape, np.int64)
    first = np.zeros(len(lengths), np.int64)
    for n in range(1, LIMIT + 1):
        first <<= 1
        has = lengths == n
        rank = np.cumsum(has, 1) - 1
        value = _REVERSED[((first[:, None] + rank) & ((1 << n) - 1)) << (LIMIT - n)]
        out = np.where(has, value, out)
        first += has.sum(1)
    return out


def _runs(pixels: np.ndarray, image: np.ndarray) -> list[tuple[int, int, int]]:
    """Disjoint (start, length, distance) of periodic stretches, in order."""
    found = []
    for d in range(1, DISTANCES + 1):
        same = (pixels[d:] == pixels[:-d]) & (image[d:] == image[:-d])
        edge = np.flatnonzero(np.diff(same, prepend=False, append=False))
        start, stop = edge[::2], edge[1::2]
        for k in np.flatnonzero(stop - start >= LEAST_RUN):
            found.append((int(start[k]) + d, int(stop[k]) + d, d))
    out, at = [], 0
    for start, stop, d in sorted(found):
        start = max(start, at)
        while stop - start >= LEAST_RUN:
            n = min(stop - start, LONGEST_RUN)
            out.append((start, n, d))
            start += n
        at = max(at, start)
    return out


def _pack(values: np.ndarray, sizes: np.ndarray, at: np.ndarray, n_bytes: int) -> np.ndarray:
    """Fields of up to 57 bits, written at ascending bit positions."""
    words = np.zeros(n_bytes // 8 + 2, np.uint64)
    keep = sizes > 0
    values, at = values[keep].astype(np.uint64), at[keep]
    if len(values):
        word, shift = at >> 6, (at & 63).astype(np.uint64)
        first = np.flatnonzero(np.diff(word, prepend=-1))
        words[word[first]] |= np.bitwise_or.reduceat(values << shift, first)
        over = np.where(shift > 0, values >> (np.uint64(64) - np.maximum(shift, np.uint64(1))), np.uint64(0))
        words[word[first] + 1] |= np.bitwise_or.reduceat(over, first)
    return words.view(np.uint8)


def _entropy(owner: np.ndarray, symbols: list[np.ndarray], n: int, width: int, times: float = 1.0, distinct: np.ndarray | None = None) -> np.ndarray:
    """Bits of each image's symbols under the best codes of their own, ``times`` over, and of the lists of these codes.

    ``distinct`` gets the greatest number of different symbols in a channel.
    """
    total = np.zeros(n)
    for s in symbols:
        c = np.bincount(owner * width + s, minlength=n * width).reshape(n, width)
        used = c > 0
        with np.errstate(divide="ignore", invalid="ignore"):
            total += times * np.where(used, c * np.log2(c.sum(1, keepdims=True) / c), 0).sum(1)
        if distinct is not None:
            np.maximum(distinct, used.sum(1), out=distinct)
        total += np.where(used.sum(1) > 1, 4 * (width - np.argmax(used[:, ::-1], 1)), 0)
    return total


def _form(raw: np.ndarray, place: np.ndarray, at: np.ndarray, kind: int) -> np.ndarray:
    """Channels of the pixels ``at`` under a transform; ``place`` counts pixels within the image."""
    own = raw[at]
    r, g, b = own[:, 0], own[:, 1], own[:, 2]
    if kind == PLAIN:
        return own
    if kind == GREEN:
        return np.stack([r - g, g, b - g], 1)
    if kind == CROSS:
        return np.stack([r - g, g, b - r], 1)
    where = place[at]
    back = np.where(where % WIDTH == 0, WIDTH, 1) if kind == LEFT else np.where(where < WIDTH, 1, WIDTH)
    guess = raw[np.maximum(at - back, 0)]
    guess[where == 0] = 0
    return own - guess


def _section(kind: int) -> tuple[int, int]:
    """(bits, their number) that announce a transform."""
    out = webp.BitWriter()
    if kind != PLAIN:
        out.write(1, 1)
        out.write({GREEN: webp.SUBTRACT_GREEN, LEFT: webp.PREDICTOR, TOP: webp.PREDICTOR, CROSS: webp.CROSS_COLOUR}[kind], 2)
    if kind in (LEFT, TOP, CROSS):
        out.write(7, 3)  # one block of 512 by 512 pixels, whose pixel holds the mode or the factors
        pixel = {LEFT: 0xFF000100, TOP: 0xFF000200, CROSS: 0xFF200020}[kind]
        webp._write_pixels(out, np.array([[pixel]], np.uint32), False)
    return int.from_bytes(b"".join(out.parts) + out.value.to_bytes(out.size // 8 + 1, "little"), "little"), out.size + 8 * sum(map(len, out.parts))


_SECTIONS = [_section(k) for k in range(5)]


def _bundled(pixels: np.ndarray) -> tuple[np.ndarray, int, tuple[int, int]] | None:
    """(bundled green values, width, bits that announce the palette) of an image with up to 16 colours, else None."""
    colours, index = np.unique(pixels, return_inverse=True)
    if len(colours) > 16:
        return None
    n = webp._bundle_bits(len(colours))
    out = webp.BitWriter()
    out.write(1, 1)
    out.write(webp.PALETTE, 2)
    out.write(len(colours) - 1, 8)
    steps = np.diff(webp._channels(colours | np.uint32(0xFF000000)), axis=0, prepend=0)
    webp._write_pixels(out, webp._joined(steps)[None, :], False)
    each = 8 >> n
    shift = (np.arange(WIDTH) & (1 << n) - 1) * each
    packed = (index.reshape(-1, WIDTH) << shift).reshape(-1, WIDTH >> n, 1 << n).sum(2)
    section = int.from_bytes(b"".join(out.parts) + out.value.to_bytes(out.size // 8 + 1, "little"), "little"), out.size + 8 * sum(map(len, out.parts))
    return packed.reshape(-1).astype(np.uint8), WIDTH >> n, section


def encode_tiles(tiles: list[bytes]) -> list[bytes]:
    """VP8L data of each tile (a positive multiple of 192 bytes)."""
    n = len(tiles)
    raw = np.frombuffer(b"".join(tiles), np.uint8).reshape(-1, 3)
    size = np.array([len(t) // 3 for t in tiles], np.int64)
    height = size // WIDTH
    image = np.repeat(np.arange(n, dtype=np.int32), size)
    begin = np.cumsum(size) - size
    place = np.arange(len(raw)) - np.repeat(begin, size)
    # The estimates look at every fourth pixel; the choice changes the size of a file, never what it decodes to.
    probe = np.flatnonzero(place % 4 == (place // WIDTH) % 4)
    shown = image[probe]
    cost, distinct = np.empty((5, n)), np.zeros(n, np.int64)
    for k in range(5):
        f = _form(raw, place, probe, k)
        cost[k] = _entropy(shown, [f[:, 0], f[:, 1], f[:, 2]], n, 256, 4.0, distinct if k == PLAIN else None) + (k > PLAIN) * _HEAD_BITS
    kind = cost.argmin(0)
    # Where copies do most of it already, the image stays as it is.
    alpha = np.full(n, 255)
    packed_pixels = lambda: raw[:, 0].astype(np.uint32) << 16 | raw[:, 1].astype(np.uint32) << 8 | raw[:, 2] | alpha.astype(np.uint32)[image] << np.uint32(24)
    pixels = packed_pixels()
    copies = _runs(pixels, image)
    covered = np.zeros(n, np.int64)
    for start, length, _ in copies:
        covered[image[start]] += length
    kind[2 * covered > size] = PLAIN
    if kind.any():
        coded = raw.copy()
        for k in range(1, 5):
            at = np.flatnonzero(kind[image] == k)
            coded[at] = _form(raw, place, at, k)
        raw = coded
        alpha[(kind == LEFT) | (kind == TOP)] = 0
        pixels = packed_pixels()
        copies = _runs(pixels, image)
    sections = [_SECTIONS[k] for k in kind]
    width = np.full(n, WIDTH)
    # Few colours, and copies wouldn't do much: pixels are bundled.
    found = {}
    for k in np.flatnonzero((distinct <= 16) & (4 * covered <= size)).tolist():
        c = np.frombuffer(tiles[k], np.uint8).reshape(-1, 3).astype(np.uint32)
        got = _bundled(c[:, 0] << 16 | c[:, 1] << 8 | c[:, 2])
        if got is not None and got[2][1] + len(got[0]) * 8 < cost.min(0)[k]:
            found[k] = got
    if found:
        parts, at = [], 0
        for k in sorted(found):
            packed, w, section = found[k]
            parts.append(raw[at : begin[k]])
            parts.append(np.stack([np.zeros_like(packed), packed, np.zeros_like(packed)], 1))
            at = int(begin[k] + size[k])
            size[k], width[k], alpha[k], sections[k] = len(packed), w, 255, section
        raw = np.concatenate([*parts, raw[at:]])
        image = np.repeat(np.arange(n, dtype=np.int32), size)
        pixels = packed_pixels()
        copies = _runs(pixels, image)
    literal, heads = np.ones(len(pixels), bool), np.zeros(len(pixels), bool)
    for start, length, _ in copies:
        literal[start : start + length] = False
        heads[start] = True
    # What a cache would hold at each pixel: the last one before it in its slot.
    slot = (np.uint32(webp.CACHE_FACTOR) * pixels) >> np.uint32(32 - CACHE)
    key = image.astype(np.uint32) << np.uint32(CACHE) | slot
    order = np.argsort(key.astype(np.uint16) if n <= 1 << 16 - CACHE else key, kind="stable")
    hit = np.zeros(len(pixels), bool)
    hit[order[1:]] = (key[order[1:]] == key[order[:-1]]) & (pixels[order[1:]] == pixels[order[:-1]])
    some = np.flatnonzero(literal)
    owner = image[some]
    without = _entropy(owner, [raw[some, 1], raw[some, 0], raw[some, 2]], n, 256)
    missed = some[~hit[some]]
    green = np.where(hit[some], slot[some].astype(np.int64) + 256, raw[some, 1])
    within = _entropy(owner, [green], n, 256 + (1 << CACHE)) + _entropy(image[missed], [raw[missed, 0], raw[missed, 2]], n, 256) + 4 * webp.LENGTH_SYMBOLS
    cached = within < without
    hit &= literal & cached[image]
    token = np.flatnonzero(literal | heads)
    is_copy, is_hit = heads[token], hit[token]
    owner = image[token].astype(np.int64)
    copy_fields = [(webp.copy_symbol(length), webp.copy_symbol(d + len(webp.NEIGHBOURS))) for _, length, d in copies]
    symbols = [raw[token, 1].astype(np.int64), raw[token, 0].astype(np.int64), raw[token, 2].astype(np.int64), np.zeros(len(token), np.int64)]
    extra, extra_size = np.zeros((2, len(token)), np.int64), np.zeros((2, len(token)), np.int64)
    where = np.flatnonzero(is_copy)
    if len(where):
        symbols[0][where] = [256 + a[0] for a, _ in copy_fields]
        symbols[3][where] = [b[0] for _, b in copy_fields]
        for j in range(2):
            extra[j, where] = [f[j][1] for f in copy_fields]
            extra_size[j, where] = [f[j][2] for f in copy_fields]
    symbols[0][is_hit] = _SLOTS + slot[token[is_hit]].astype(np.int64)
    counts = np.zeros((n, 4, _GREEN), np.int64)
    plain = ~is_copy & ~is_hit
    for c in range(4):
        part = np.ones(len(token), bool) if c == 0 else is_copy if c == 3 else plain
        counts[:, c] = np.bincount(owner[part] * _GREEN + symbols[c][part], minlength=n * _GREEN).reshape(n, _GREEN)
    counts = counts.reshape(-1, _GREEN)
    lengths = code_lengths(counts)
    lone = (counts > 0).sum(1) <= 1
    stream_code = codes(lengths)
    stream_size = np.where(lone[:, None], 0, lengths)

    # The head of each stream: sizes, transforms, flags, then the five codes.
    field = lambda v, k: (np.broadcast_to(np.asarray(v, np.int64), (n,))[:, None], np.broadcast_to(np.asarray(k, np.int64), (n,))[:, None])
    parts = [field(0x2F, 8), field(WIDTH - 1, 14), field(height - 1, 14), field(0, 1 + 3)]
    for at in range(0, max(k for _, k in sections), 32):
        parts.append(field([v >> at & 0xFFFFFFFF for v, _ in sections], [min(32, max(0, k - at)) for _, k in sections]))
    parts += [field(0, 1), field(np.where(cached, 1 | CACHE << 1, 0), np.where(cached, 5, 1)), field(0, 1)]
    of = lengths.reshape(n, 4, _GREEN)
    single, which = lone.reshape(n, 4), counts.reshape(n, 4, _GREEN).argmax(2)
    last = _GREEN - np.argmax(of[:, :, ::-1] > 0, 2)
    for c in (0, 1, 2, None, 3):
        if c is None:
            parts.append(field(0b101 | alpha << 3, 11))  # alpha: a lone symbol
            continue
        one = single[:, c]
        parts.append((np.where(one, 0b101 | which[:, c] << 3, 15 << 1)[:, None], np.where(one, 11, 5)[:, None]))
        parts.append((np.where(one, 0, _FLAT & (1 << 30) - 1)[:, None], np.where(one, 0, 30)[:, None]))
        parts.append((np.where(one, 0, _FLAT >> 30)[:, None], np.where(one, 0, 27)[:, None]))
        parts.append((np.where(one, 0, 1 | 4 << 1 | (last[:, c] - 2) << 4)[:, None], np.where(one, 0, 14)[:, None]))
        alphabet = webp.DISTANCE_SYMBOLS if c == 3 else _GREEN if c == 0 else 256
        listed = (np.arange(alphabet)[None, :] < last[:, c, None]) & ~one[:, None]
        parts.append((np.where(listed, _NIBBLE[of[:, c, :alphabet]], 0), np.where(listed, 4, 0)))
    head, head_size = (np.concatenate(x, 1) for x in zip(*parts))

    rows = [owner * 4 + c for c in range(4)]
    got = [stream_code[rows[c], symbols[c]] for c in range(4)]
    bits = [stream_size[rows[c], symbols[c]] for c in range(4)]
    # A literal is green, red, blue; a copy is length, its extra bits, distance, its extra bits.
    second = np.where(is_copy, extra[0], np.where(is_hit, 0, got[1]))
    second_size = np.where(is_copy, extra_size[0], np.where(is_hit, 0, bits[1]))
    third = np.where(is_copy, got[3], np.where(is_hit, 0, got[2]))
    third_size = np.where(is_copy, bits[3], np.where(is_hit, 0, bits[2]))
    shift = bits[0] + second_size
    body = got[0] | second << bits[0] | third << shift | extra[1] << (shift + third_size)
    body_size = shift + third_size + extra_size[1]

    head_bits = head_size.sum(1)
    ends = np.cumsum(body_size)
    tokens_of = np.bincount(owner, minlength=n)
    first = np.cumsum(tokens_of) - tokens_of
    body_before = ends - body_size
    total = head_bits + np.add.reduceat(body_size, first)
    n_bytes = (total + 7) // 8
    begin = np.cumsum(n_bytes) - n_bytes
    head_at = begin[:, None] * 8 + np.cumsum(head_size, 1) - head_size
    body_at = (begin * 8 + head_bits - body_before[first])[owner] + body_before
    whole = int(n_bytes.sum())
    out = _pack(head.reshape(-1), head_size.reshape(-1), head_at.reshape(-1), whole) | _pack(body, body_size, body_at, whole)
    data = out[:whole].tobytes()
    return [data[b : b + k] for b, k in zip(begin.tolist(), n_bytes.tolist())]


def _lengths_of(bits: webp.Bits, alphabet: int, row: np.ndarray) -> bool:
    """Code lengths of the next code into ``row``; True for a lone symbol. Four-bit lists are read at once."""
    at = bits.at
    if bits.read(1) == 0 and bits.read(4) == 15 and bits.read(30) == _FLAT & (1 << 30) - 1 and bits.read(27) == _FLAT >> 30 and bits.read(4) == 1 | 4 << 1:
        n = 2 + bits.read(10)
        i, shift = bits.at >> 3, bits.at & 7
        value = int.from_bytes(bits.data[i : i + n // 2 + 2], "little") >> shift
        raw = np.frombuffer((value & (1 << 4 * n) - 1).to_bytes((n + 1) // 2, "little"), np.uint8)
        row[: 2 * len(raw) : 2] = _NIBBLE[raw & 15]
        row[1 : 2 * len(raw) : 2] = _NIBBLE[raw >> 4]
        row[n:alphabet] = 0
        bits.at += 4 * n
        return False
    bits.at = at
    got = webp.read_lengths(bits, alphabet)
    row[:alphabet] = got
    return sum(g > 0 for g in got) <= 1


def decode_tiles(data: list[bytes]) -> list[bytes]:
    """RGB bytes of each VP8L stream."""
    n = len(data)
    lengths = np.zeros((n, 4, _GREEN), np.uint8)
    lone = np.zeros((n, 4), bool)
    position, size, plain = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n, bool)
    width, cache, alpha = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n, np.uint32)
    heads = []
    for k, stream in enumerate(data):
        bits = webp.Bits(stream)
        head = webp.read_head(bits)
        heads.append(head)
        cache[k] = bits.read(4) if bits.read(1) else 0
        if head[2] or cache[k] > CACHE or bits.read(1):  # alpha, a large cache, groups
            continue
        for c in (0, 1, 2, None, 3):
            if c is None:
                used = webp.read_lengths(bits, 256)
                if sum(u > 0 for u in used) > 1:
                    break
                alpha[k] = np.argmax(used)
            else:
                lone[k, c] = _lengths_of(bits, webp.DISTANCE_SYMBOLS if c == 3 else _SLOTS + (1 << cache[k] if cache[k] else 0) if c == 0 else 256, lengths[k, c])
        else:
            plain[k] = int(lengths[k].max()) <= LIMIT
            position[k], width[k], size[k] = bits.at, head[4], head[4] * head[1]
    out: list[bytes] = [b""] * n
    for k in np.flatnonzero(~plain):
        out[k] = _rgb(webp.decode_stream(data[k]))
    order = np.flatnonzero(plain)
    order = order[np.argsort(-size[order], kind="stable")]
    if len(order):
        for k, pixels in zip(order, _decode_plain([data[k] for k in order], lengths[order], lone[order], position[order], size[order], width[order], cache[order], alpha[order])):
            undo, w = heads[k][3], int(width[k])
            out[k] = _rgb(webp.undo_transforms(pixels.reshape(-1, w), undo) if undo else pixels)
    return out


def _rgb(p: np.ndarray) -> bytes:
    return np.ascontiguousarray(p.reshape(-1).astype(">u4").view(np.uint8).reshape(-1, 4)[:, 1:]).tobytes()


def _tables(lengths: np.ndarray, lone: np.ndarray) -> np.ndarray:
    """(rows, 2**LIMIT) of symbol * 16 + bits, by the next bits as they stand."""
    rows = len(lengths)
    key = np.where(lengths > 0, lengths.astype(np.int32), 99) * 512 + np.arange(lengths.shape[1], dtype=np.int32)
    order = np.argsort(key, axis=1, kind="stable")
    n = np.take_along_axis(lengths, order, 1).astype(np.int64)
    span = np.where(n > 0, 1 << (LIMIT - np.minimum(n, LIMIT)), 0)
    none = span.sum(1) == 0
    span[lone | none] = 0
    span[lone | none, 0] = 1 << LIMIT
    if (span.sum(1) != 1 << LIMIT).any():
        raise ValueError("incomplete prefix code")
    entry = order * 16 + np.where(lone[:, None], 0, n)
    entry[none] = 0
    table = np.repeat(entry.reshape(-1).astype(np.uint16), span.reshape(-1)).reshape(rows, 1 << LIMIT)
    return table[:, _REVERSED]


def _decode_plain(data, lengths, lone, position, size, width, cache, alpha) -> list[np.ndarray]:
    n = len(data)
    sizes = np.array([len(d) for d in data], np.int64)
    begin = np.cumsum(sizes) - sizes
    buffer = np.frombuffer(b"".join(data) + b"\0" * 8, np.uint8)
    window = buffer[:-3].astype(np.uint32)
    for k in range(1, 4):
        window |= buffer[k : len(buffer) - 3 + k].astype(np.uint32) << np.uint32(8 * k)
    table = [_tables(lengths[:, c], lone[:, c]).reshape(-1) for c in range(4)]
    at = begin * 8 + position
    first = np.cumsum(size) - size
    pixels = np.zeros(int(size.sum()), np.uint32)
    done = np.zeros(n, np.int64)  # pixels written so far
    base = np.arange(n, dtype=np.int64) << LIMIT
    mask = (1 << LIMIT) - 1
    alpha = alpha << np.uint32(24)
    slots = np.zeros(n << CACHE, np.uint32)
    rows = np.arange(n, dtype=np.int64) << CACHE
    shift = (32 - cache).astype(np.uint64)
    caching = bool(cache.any())

    def symbol(c: int, who):
        where = at[who]
        entry = table[c][base[who] + (window[where >> 3] >> (where & 7).astype(np.uint32) & mask)]
        at[who] = where + (entry & 15)
        return entry >> 4

    def slot(value, i):
        return rows[i] + ((value * np.uint32(webp.CACHE_FACTOR)).astype(np.uint64) >> shift[i]).astype(np.int64)

    live = np.arange(n)
    while len(live):
        who = slice(0, len(live)) if live[-1] == len(live) - 1 else live
        green = symbol(0, who)
        special = np.flatnonzero(green >= 256)
        if len(special):
            what = green[special]
            for k in special[what < _SLOTS]:
                i = int(live[k])
                stream = webp.Bits(data[i], int(at[i] - begin[i] * 8))
                length = webp._copy_value(int(green[k]) - 256, stream)
                at[i] = begin[i] * 8 + stream.at
                code = int(symbol(3, np.array([i]))[0])
                stream.at = int(at[i] - begin[i] * 8)
                code = webp._copy_value(code, stream)
                at[i] = begin[i] * 8 + stream.at
                if code > len(webp.NEIGHBOURS):
                    d = code - len(webp.NEIGHBOURS)
                else:
                    d = max(1, webp.NEIGHBOURS[code - 1][0] + webp.NEIGHBOURS[code - 1][1] * int(width[i]))
                p = int(first[i] + done[i])
                if d > done[i] or done[i] + length > size[i]:
                    raise ValueError("back-reference out of the image")
                copied = np.resize(pixels[p - d : p], length)
                pixels[p : p + length] = copied
                if cache[i]:
                    slots[slot(copied, np.full(length, i))] = copied  # the last of a slot stays
                done[i] += length
            kept = special[what >= _SLOTS]
            if len(kept):  # pixels out of the caches, where they are already
                i = live[kept]
                pixels[first[i] + done[i]] = slots[rows[i] + green[kept] - _SLOTS]
                done[i] += 1
            plain = np.flatnonzero(green < 256)
            who, green = live[plain], green[plain]
        if len(green):
            value = green.astype(np.uint32) << np.uint32(8)
            value |= symbol(1, who).astype(np.uint32) << np.uint32(16)
            value |= symbol(2, who)
            value |= alpha[who]
            pixels[first[who] + done[who]] = value
            if caching:
                slots[slot(value, who)] = value
            done[who] += 1
        more = done[live] < size[live]
        if not more.all():
            live = live[more]
    return [pixels[f : f + k] for f, k in zip(first.tolist(), size.tolist())]


def _spans(sizes: list[int], limit: int):
    """(first, end) of consecutive items of about ``limit`` together."""
    first, held = 0, 0
    for k, n in enumerate(sizes):
        held += n
        if held >= limit:
            yield first, k + 1
            first, held = k + 1, 0
    if first < len(sizes):
        yield first, len(sizes)


def _alike(sizes: list[int]):
    """Indices in batches of bounded size, items of like size together, so that none waits long for the longest."""
    order = sorted(range(len(sizes)), key=sizes.__getitem__)
    for i, j in _spans([max(LEAST_TILE, sizes[k]) for k in order], BATCH_BYTES):
        yield order[i:j]


def store(payloads: list[bytes]) -> list[bytes]:
    """A WebP file for each payload."""
    tiles, owner = [], []
    step = TILE_ROWS * UNIT
    for k, p in enumerate(payloads):
        for at in range(0, len(p), step):
            tiles.append(p[at : at + step])
            owner.append(k)
    frames: list[list] = [[] for _ in payloads]
    made: list[bytes] = [b""] * len(tiles)
    for some in _alike([len(t) for t in tiles]):
        for k, stream in zip(some, encode_tiles([tiles[k] for k in some])):
            made[k] = stream
    for k, tile, stream in zip(owner, tiles, made):
        frames[k].append((stream, WIDTH, len(tile) // UNIT))
    return [webp.container(f) for f in frames]


def load(files: list[bytes]) -> list[bytes]:
    """The payload of each file."""
    streams, owner = [], []
    for k, f in enumerate(files):
        got = webp.streams(f)
        streams += got
        owner += [k] * len(got)
    parts: list[list[bytes]] = [[] for _ in files]
    # A stream's header tells its size.
    sizes = [3 * ((int.from_bytes(x[1:5], "little") & 0x3FFF) + 1) * ((int.from_bytes(x[1:5], "little") >> 14 & 0x3FFF) + 1) for x in streams]
    got: list[bytes] = [b""] * len(streams)
    for some in _alike(sizes):
        for k, rgb in zip(some, decode_tiles([streams[k] for k in some])):
            got[k] = rgb
    for k, rgb in zip(owner, got):
        parts[k].append(rgb)
    return [b"".join(p) for p in parts]


def feature(data: bytes) -> str:
    """Shares of the samples in 16 equal ranges, in thousandths, and their mean."""
    samples = np.frombuffer(data, np.uint8)
    share = np.bincount(samples >> 4, minlength=16) * 1000 // len(samples)
    return " ".join(map(str, share.tolist())) + f" {int(samples.sum(dtype=np.int64)) * 1000 // len(samples)}"


def media(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_bytes, media): each text's WebP file.

    Null text is empty; an empty text is stored as 192 blanks; equal texts
    give equal files; any length works, in frames.
    """
    ship(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for ids, texts in _parts(batch):
                files = store([payload(t) for t in texts])
                yield pa.RecordBatch.from_arrays([ids, pa.array([len(t) for t in texts], pa.int64()), pa.array(files, pa.binary())], names=[id_col, "n_bytes", "media"])

    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, n_bytes long, media binary")


def _parts(batch, limit: int = 4 << 20):
    """(ids, texts) of a batch in parts of bounded size."""
    column = batch.column(1).cast(pa.large_binary())
    first, texts, held = 0, [], 0
    for k in range(batch.num_rows):
        t = column[k].as_py() or b""
        texts.append(t)
        held += len(t) + UNIT
        if held >= limit or k == batch.num_rows - 1:
            yield batch.column(0).slice(first, len(texts)), texts
            first, texts, held = k + 1, [], 0


_DIGESTS = "payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"


def _digests(stored: list[bytes]) -> list[pa.Array]:
    """What ``_DIGESTS`` names, from the samples that the stored files decode to."""
    got = load(stored)
    return [
        pa.array([len(p) for p in got], pa.int64()),
        pa.array([hashlib.sha256(p).hexdigest() for p in got], pa.string()),
        pa.array([zlib.crc32(p[-16:]) for p in got], pa.int64()),
        pa.array([len(m) for m in stored], pa.int64()),
        pa.array([hashlib.sha256(m).hexdigest() for m in stored], pa.string()),
        pa.array([feature(p) for p in got], pa.string()),
    ]


_NAMES = ["n_bytes", *[f.split()[0] for f in _DIGESTS.split(", ")]]


def read_back(files: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(id, n_bytes, payload and media digests, feature) of a table of files as ``media`` gives it."""
    ship(files.sparkSession)
    kind = files.schema[id_col].dataType.simpleString()

    def run(batches):
        for batch in batches:
            column = batch.column(2)
            for at, end in _spans([len(column[k].as_buffer()) for k in range(len(column))], 4 << 20):
                digests = _digests(column.slice(at, end - at).to_pylist())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, end - at), batch.column(1).slice(at, end - at), *digests], names=[id_col, *_NAMES])

    return files.select(id_col, "n_bytes", "media").mapInArrow(run, f"`{id_col}` {kind}, n_bytes long, {_DIGESTS}")


def round_trip(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``read_back`` of the files that ``media`` gives, stored as a table in between."""
    scratch = Scratch(docs.sparkSession, "media")
    files = scratch.put(media(docs, id_col, text_col), "files", ROW_GROUP)
    result = scratch.put(read_back(files, id_col), "digests")
    scratch.keep("digests")
    return result

"""The WebP codec: round trips of every feature, and of batches."""

import hashlib
import itertools
import zlib
from collections import Counter

import numpy as np
import pytest

from tessera.llm import media, webp


def image(rng, h, w, colours=None, alpha=False):
    if colours:
        p = rng.integers(0, 1 << 32, colours, dtype=np.uint32)[rng.integers(0, colours, (h, w))]
    else:
        p = rng.integers(0, 1 << 32, (h, w), dtype=np.uint32)
        p[:, w // 2 :] = p[:, : w - w // 2]
    return p if alpha else p | np.uint32(0xFF000000)


TRANSFORMS = [(), (webp.SUBTRACT_GREEN,), (webp.PREDICTOR,), (webp.CROSS_COLOUR,), (webp.PALETTE,), (webp.PREDICTOR, webp.CROSS_COLOUR, webp.SUBTRACT_GREEN), (webp.PALETTE, webp.PREDICTOR)]
CODES = [(0, True, None), (5, True, None), (9, False, 2), (0, False, None)]


@pytest.mark.parametrize("size", [(1, 1), (3, 5), (17, 23), (9, 64)])
@pytest.mark.parametrize("transforms", TRANSFORMS)
def test_every_feature(size, transforms):
    rng = np.random.default_rng(sum(size))
    for colours, (cache, copies, groups), alpha in itertools.product((1, 2, 3, 9, 40, 256, None), CODES, (False, True)):
        if colours is None and webp.PALETTE in transforms:
            continue
        p = image(rng, *size, colours, alpha)
        data = webp.encode_stream(p, transforms, cache_bits=cache, copies=copies, group_bits=groups)
        assert (webp.decode_stream(data) == p).all()


@pytest.mark.parametrize("mode", range(14))
def test_predictor_modes(mode):
    p = image(np.random.default_rng(mode), 8, 11, 30)
    assert (webp.decode_stream(webp.encode_stream(p, (webp.PREDICTOR,), modes=np.array([mode]))) == p).all()


def test_predictions_by_hand():
    left, top, tl, tr = [10, 20, 30, 40], [50, 10, 0, 200], [20, 15, 10, 100], [1, 2, 3, 4]
    assert webp.predict(7, left, top, tl, tr) == [30, 15, 15, 120]
    assert webp.predict(12, left, top, tl, tr) == [40, 15, 20, 140]
    assert webp.predict(13, left, top, tl, tr) == [35, 15, 17, 130]
    assert webp.predict(11, left, top, tl, tr) == top  # |top - tl| sums to 145, |left - tl| to 95


def test_broken_streams():
    with pytest.raises(ValueError):
        webp.decode_stream(b"\x00" * 10)
    with pytest.raises(ValueError):
        webp.streams(b"nope")
    with pytest.raises(ValueError):
        webp.Prefix([1, 2, 0, 0])


def test_batches():
    rng = np.random.default_rng(7)
    texts = [b"", b"a", b"ab " * 900, bytes(rng.integers(0, 256, 40_000, dtype=np.uint8)), b"\xff" * 50_000, "日本 text ".encode() * 300] + [bytes(rng.integers(97, 123, int(n), dtype=np.uint8)) for n in rng.integers(0, 9000, 60)]
    payloads = [media.payload(t) for t in texts]
    assert all(len(p) % 192 == 0 and p for p in payloads)
    files = media.store(payloads)
    assert media.load(files) == payloads
    for p, f in list(zip(payloads, files))[:8]:  # the complete decoder reads them, too
        got = webp.decode(f)
        assert b"".join(np.stack([x >> 16 & 255, x >> 8 & 255, x & 255], -1).astype(np.uint8).tobytes() for x in got) == p
    assert media.store(payloads[::-1])[::-1] == files  # a file depends on its text alone
    assert len(files[2]) < len(payloads[2]) / 10  # back-references are used


def features_of(files):
    """How many streams use each transform (predictors by mode), the cache, or neither."""
    found = Counter()
    for f in files:
        for stream in webp.streams(f):
            bits = webp.Bits(stream)
            undo = webp.read_head(bits)[3]
            for kind, _, _, data in undo:
                found[kind if kind != webp.PREDICTOR else (kind, int(data.flat[0]) >> 8 & 15)] += 1
            found["cache" if bits.read(1) else "no cache"] += 1
    return found


def test_files_use_every_feature():
    """What the encoder of the query chooses, by kind of image, and that the batch decoder undoes it."""
    rng = np.random.default_rng(3)
    steps = rng.integers(-2, 3, (9000, 3), dtype=np.int64)
    noise = rng.integers(0, 256, (40, 192), dtype=np.uint8)
    grey = np.repeat(rng.integers(0, 256, (4000, 1), dtype=np.uint8), 3, 1)
    pairs = rng.integers(0, 256, (4000, 2), dtype=np.uint8)
    colours = rng.integers(0, 256, (11, 3), dtype=np.uint8)
    texts = {
        (webp.PREDICTOR, 1): np.cumsum(steps, 0).astype(np.uint8).tobytes(),
        (webp.PREDICTOR, 2): (noise[:1] + np.cumsum(rng.integers(0, 3, (40, 192)), 0)).astype(np.uint8).tobytes(),
        webp.SUBTRACT_GREEN: grey.tobytes(),
        webp.CROSS_COLOUR: np.stack([pairs[:, 0], pairs[:, 0] + rng.integers(0, 2, 4000, dtype=np.uint8), pairs[:, 0] * 1], 1).tobytes(),
        webp.PALETTE: colours[rng.integers(0, 11, 4000)].tobytes(),
        "cache": (b"some words and other words and some more of them, " + b"".join(b"%d words " % (k % 7) for k in rng.integers(0, 9, 900))),
    }
    for feature, text in texts.items():
        files = media.store([media.payload(text)] * 2)
        assert media.load(files) == [media.payload(text)] * 2
        got = features_of(files)
        assert got[feature] or (feature == webp.CROSS_COLOUR and got[webp.SUBTRACT_GREEN])
    red = rng.integers(0, 256, 4096, dtype=np.uint8)
    text = np.stack([red, rng.integers(0, 4, 4096, dtype=np.uint8), red], 1).tobytes()  # blue follows red
    files = media.store([media.payload(text)])
    assert features_of(files)[webp.CROSS_COLOUR] and media.load(files) == [media.payload(text)]
    everything = [media.payload(t) for t in texts.values()] + [media.payload(text)]
    files = media.store(everything)
    assert media.load(files) == everything
    for p, f in zip(everything, files):
        assert b"".join(media._rgb(x) for x in webp.decode(f)) == p  # as the complete decoder reads them


def plain_feature(p):
    share = Counter(b >> 4 for b in p)
    return " ".join(str(share[k] * 1000 // len(p)) for k in range(16)) + f" {sum(p) * 1000 // len(p)}"


def test_other_streams_in_a_batch():
    """Streams with transforms or a cache among plain ones."""
    p = image(np.random.default_rng(1), 6, 64, 20)
    rgb = np.stack([p >> 16 & 255, p >> 8 & 255, p & 255], -1).astype(np.uint8).tobytes()
    plain = media.encode_tiles([rgb])[0]
    streams = [plain, webp.encode_stream(p, (webp.PREDICTOR, webp.SUBTRACT_GREEN), cache_bits=4), webp.encode_stream(p), webp.encode_stream(p, (webp.PALETTE,))]
    assert media.decode_tiles(streams) == [rgb] * 4


def test_code_lengths_are_complete():
    rng = np.random.default_rng(5)
    counts = rng.integers(0, 3, (200, 280)) * rng.integers(0, 10_000, (200, 280)) ** 2
    counts[0] = 0
    counts[0, :2] = 1, 1 << 40
    lengths = media.code_lengths(counts)
    assert ((lengths > 0) == (counts > 0)).all() and lengths.max() <= media.LIMIT
    assert (np.where(lengths > 0, 0.5**lengths, 0).sum(1) == 1).all()


def test_query_rows(edge, edge_rows, nothing):
    got_rows = media.read_back(media.media(edge)).collect()
    got = {(r.doc_id, r.payload_sha256): r for r in got_rows}
    for i, t in edge_rows:
        data = (t or "").encode()
        p = media.payload(data)
        r = got[i, hashlib.sha256(p).hexdigest()]
        assert (r.n_bytes, r.payload_bytes, r.tail_crc32) == (len(data), len(p), zlib.crc32(p[-16:]))
        stored = media.store([p])[0]
        assert (r.media_bytes, r.media_sha256, r.feature) == (len(stored), hashlib.sha256(stored).hexdigest(), plain_feature(p))
    assert sorted(map(repr, media.round_trip(edge).collect())) == sorted(map(repr, got_rows))
    assert media.round_trip(nothing).count() == 0 and media.read_back(media.media(nothing)).count() == 0

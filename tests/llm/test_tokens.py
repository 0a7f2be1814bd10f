"""Packing, token counts and the BPE transducer against the library."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tessera.llm import packing, token_counts, transducer, vocab

PATH = vocab.vocabulary_path()


@pytest.fixture(scope="module")
def library():
    return vocab.library(PATH)


def test_round_trip_edges(edge, edge_rows, library):
    got = transducer.round_trip(edge).collect()
    want = []
    for i, t in edge_rows:
        ids = library.encode(t or "", add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        want.append((i, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()))
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


def test_empty_tables(nothing):
    assert transducer.round_trip(nothing).count() == 0
    assert token_counts.token_counts(nothing).count() == 0
    assert packing.pack(nothing).count() == 0


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("abthinge'slr .,!<|>0９ßÉéΣσİı́ẞ\x1f日😀　\n")), max_size=60))
def test_chunks_equal_library(text):
    words = vocab.load(PATH)
    machine = _machine(words)
    ids = [i for c in text.encode().split() for i in machine.chunk(c)]
    assert ids == vocab.library(PATH).encode(text, add_special_tokens=False).ids


_machines = []


def _machine(words):
    if not _machines:
        _machines.append(transducer.Transducer(words))
    return _machines[0]


def test_streaming_equals_whole():
    machine = _machine(vocab.load(PATH))
    rng = random.Random(2)
    for _ in range(30):
        word = "".join(rng.choice("thinaerou") for _ in range(rng.randint(700, 2500))).encode()
        symbols = [machine.words.inner[b] for b in word[:-1]] + [machine.words.final[word[-1]]]
        assert list(machine.stream(symbols)) == machine.merge(list(symbols))


def test_lookahead_is_sufficient():
    """On a small merge list: tokens that end the lookahead before a cut never depend on what follows."""
    rng = random.Random(1)
    for _ in range(20):
        ids = {c: k for k, c in enumerate("abc")}
        merges, tokens = [], ["a", "b", "c"]
        for _ in range(8):
            a, b = rng.choice(tokens), rng.choice(tokens)
            if a + b not in ids and len(a + b) < 7:
                ids[a + b] = len(ids)
                tokens.append(a + b)
                merges.append((ids[a], ids[b], ids[a + b]))
        machine = transducer.Transducer.__new__(transducer.Transducer)
        machine.rules = {(a, b): (r, c) for r, (a, b, c) in reversed(list(enumerate(merges)))}
        size = {v: len(k) for k, v in ids.items()}
        far = transducer.sufficient_lookahead(merges)
        for _ in range(60):
            whole = [rng.randrange(3) for _ in range(40)]
            cut = rng.randint(far + 1, 39)
            ends = lambda seq: np.cumsum([size[t] for t in seq]).tolist()
            part, full = machine.merge(list(whole[:cut])), machine.merge(list(whole))
            stable = [e for e in ends(part) if e <= cut - far]
            assert ends(full)[: len(stable)] == stable


def test_byte_level_decoder():
    """The incremental decoder, fed id by id, equals the library on a byte-level file."""
    path = vocab.vocabulary_path("byte_bpe_50k.json")
    tok = vocab.library(path)
    strings = {i: s for s, i in tok.get_vocab(with_added_tokens=True).items()}
    text = "naïve 😀 日本 plain"
    ids = tok.encode(text, add_special_tokens=False).ids
    ids = ids + ids[5:6]  # ends inside a character, maybe
    machine = transducer.Decoder(strings, byte_level=True)
    assert "".join([machine.feed([i]) for i in ids]) + machine.finish() == tok.decode(ids, skip_special_tokens=False)


def test_counts_equal_library(edge, edge_rows, library):
    got = sorted(map(tuple, token_counts.token_counts(edge, limit=100).collect()), key=repr)
    want = []
    for i, t in edge_rows:
        n = len(library.encode(t or "", add_special_tokens=False).ids)
        want.append((i, len((t or "").encode()), n, n > 100))
    assert got == sorted(want, key=repr)


def test_small_blocks(edge, edge_rows, library, monkeypatch):
    """Many blocks, and texts counted slice by slice, give the same counts."""
    monkeypatch.setattr(token_counts, "BLOCK_BYTES", 1)
    monkeypatch.setattr(token_counts, "LONG_TEXT", 100)
    words, splitter = vocab.load(PATH), token_counts._Splitter(vocab.load(PATH))
    encode = vocab.library_encoder(PATH)
    pieces = vocab.pieces_of
    monkeypatch.setattr(vocab, "pieces_of", lambda text: pieces(text, 64))
    for _, t in edge_rows:
        block = token_counts._Block(splitter)
        block.add(1, (t or "").encode())
        row = block.row(0)
        listed = [w for _, part in row["vocabulary"] for w in zlib.decompress(part).split(b"\n")]
        items = np.cumsum(token_counts._unpack(row["items"], np.uint32), dtype=np.uint32)
        freqs = token_counts._unpack(row["freqs"], np.uint32)
        count = sum(int(n) * (1 if listed[k].decode() in words.specials else len(encode(listed[k]))) for k, n in zip(items, freqs))
        assert count == len(library.encode(t or "", add_special_tokens=False).ids)


def test_slices_are_whole():
    """Slices go on to white space; a text without any is one slice, in time that grows with it."""
    rng = random.Random(3)
    for _ in range(40):
        text = "".join(rng.choice("ab \t\n\x0b\r\x0c") for _ in range(400)).encode()
        for limit in (1, 7, 100, 1000):
            assert [w for words in vocab.pieces_of(text, limit) for w in words] == text.split()
    text = b"x" * (3 << 20) + b" y " + b"z" * (2 << 20)
    assert [len(w) for words in vocab.pieces_of(text) for w in words] == [3 << 20, 1, 2 << 20]


@pytest.mark.parametrize("text", ["thinaerou" * 8000 + "'s<|endoftext|>X1 9'll", "é日本" * 20_000, " a b " + "x1" * 30_000 + "<|endoftext|>" * 3000 + " end", "q" * 70_000, "a " * 700_000])
def test_long_chunks_equal_library(text, library):
    """Chunks whose tokens are never listed at once, and texts of more than one slice."""
    codec = transducer._Codec(PATH)
    ids = library.encode(text, add_special_tokens=False).ids
    decoded = library.decode(ids, skip_special_tokens=False)
    assert codec.digest(text.encode()) == (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest())
    sizes = [len(b) for c in text.encode().split() if len(c) > transducer.LONG_CHUNK for b in codec.transducer.batches(c)]
    assert max(sizes, default=0) <= 4096 + 200


def test_packing_is_whole(edge, edge_rows, library):
    rows = packing.pack(edge).collect()
    by_id, sequences = {}, {}
    for r in rows:
        by_id.setdefault(r.doc_id, []).append(r)
        sequences.setdefault(r.sequence_id, []).append(r)
    for seq in sequences.values():
        at = 0
        for r in sorted(seq, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= packing.WINDOW
    for i, t in edge_rows:
        ids = np.array(library.encode(t or "", add_special_tokens=False).ids + [packing.END_ID], "<u4")
        mine = [r for r in by_id[i] if r.doc_tokens == len(ids)]
        copies = sum(1 for j, u in edge_rows if j == i and u == t)
        assert sum(r.length for r in mine) == copies * len(ids)
        for r in mine:
            assert zlib.crc32(ids[r.start : r.start + r.length].tobytes()) == r.ids_crc32


@pytest.mark.parametrize("seed", [0, 1, 2])
def test_plan_uses_every_piece(seed):
    rng = np.random.default_rng(seed)
    histogram = np.zeros(65, np.int64)
    histogram[1:] = rng.poisson(rng.uniform(0, 60, 64))
    left = histogram.copy()
    for shape, repeats in packing.plan(histogram, 3):
        assert sum(shape) <= 64 and repeats > 0
        for b in shape:
            left[b] -= repeats
    assert not left.any()
    assert packing.plan(np.zeros(65, np.int64)) == []


def test_nnls_solves():
    rng = np.random.default_rng(3)
    a, x = rng.uniform(0, 1, (20, 60)), np.zeros(60)
    x[[3, 17, 40]] = 1, 2, 0.5
    got = packing.nnls(a, a @ x)
    assert got.min() >= 0 and np.abs(a @ got - a @ x).max() < 1e-4

"""Token counts without token ids.

A piece count belongs to a pre-token, and a pre-token's count is computed once
for the whole corpus. Documents are turned into blocks: each row of the block
table holds, for the documents of one block, their pre-token frequencies as
positions in the block's own vocabulary. The vocabularies go out by pre-token
bucket; a bucket sees each of its distinct pre-tokens once, counts its pieces,
and answers every block with the counts in the block's order. Joined back by
block, a document's count is the sum of frequency times count. What moves is
one entry per block and distinct pre-token, so neither a frequent word nor a
long document makes a hot key.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import vocab
from .scratch import Scratch, ship

#: Buckets of the pre-token exchange, and bytes of text in a block.
BUCKETS = 4096
BLOCK_BYTES = 24 << 20
#: Texts longer than this are counted slice by slice.
LONG_TEXT = 1 << 20

_pre_tokens: dict[str, object] = {}
_counters: dict[str, object] = {}


def _pack(a: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(a.tobytes())


def _unpack(b: bytes, dtype) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(b), dtype)


class _Splitter(dict):
    """chunk -> its pre-tokens as bytes (a special token as its string)."""

    def __init__(self, words: vocab.WordVocabulary):
        super().__init__()
        self.words = words

    def __missing__(self, chunk: bytes):
        if len(self) >= vocab.MEMO_ENTRIES:
            self.clear()
        got = [self.words.strings[p].encode() if isinstance(p, int) else p for p in self.words.pre_tokens(chunk)]
        if len(chunk) <= 64:
            self[chunk] = got
        return got


class _Block:
    """Gathers documents; ``row`` gives the block's row."""

    def __init__(self, splitter: _Splitter):
        self.splitter = splitter
        self.chunks: dict[bytes, int] = {}
        self.ids, self.n_bytes, self.codes, self.size = [], [], [], 0

    def add(self, doc_id, text: bytes) -> None:
        at = self.chunks
        parts = []
        for words in vocab.pieces_of(text):
            get = at.setdefault
            part = np.fromiter((get(w, len(at)) for w in words), np.uint32, len(words))
            parts.append(np.unique(part, return_counts=True) if len(text) > LONG_TEXT else (part, None))
        if len(parts) > 1 or (parts and parts[0][1] is not None):
            code = np.concatenate([p[0] for p in parts])
            count = np.concatenate([p[1] if p[1] is not None else np.ones(len(p[0]), np.int64) for p in parts])
            self.codes.append((code, count))
        else:
            self.codes.append((parts[0][0] if parts else np.zeros(0, np.uint32), None))
        self.ids.append(doc_id)
        self.n_bytes.append(len(text))
        self.size += len(text) + 64

    def row(self, block: int) -> dict:
        words: dict[bytes, int] = {}
        ends, flat = [], []
        for chunk in self.chunks:
            for p in self.splitter[chunk]:
                flat.append(words.setdefault(p, len(words)))
            ends.append(len(flat))
        buckets = np.fromiter((zlib.crc32(w) % BUCKETS for w in words), np.int64, len(words))
        order = np.argsort(buckets, kind="stable")
        place = np.empty(len(order), np.uint64)
        place[order] = np.arange(len(order), dtype=np.uint64)
        flat = place[np.array(flat, np.int64)] if flat else np.zeros(0, np.uint64)
        stop = np.array(ends, np.int64)
        start = np.concatenate([[0], stop[:-1]]).astype(np.int64) if len(stop) else stop
        keys, counts = [], []
        for k, (code, count) in enumerate(self.codes):
            n = (stop[code] - start[code]) if len(code) else np.zeros(0, np.int64)
            total = int(n.sum())
            at = np.repeat(start[code] - np.concatenate([[0], np.cumsum(n)[:-1]]).astype(np.int64), n) + np.arange(total) if total else np.zeros(0, np.int64)
            doc = np.sort(flat[at]) if count is None else flat[at]
            if count is None:
                first = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]])) if total else np.zeros(0, np.int64)
                keys.append(doc[first].astype(np.uint32))
                counts.append(np.diff(np.concatenate([first, [total]])).astype(np.uint32) if total else np.zeros(0, np.uint32))
            else:
                kinds, back = np.unique(doc, return_inverse=True)
                keys.append(kinds.astype(np.uint32))
                counts.append(np.bincount(back, weights=np.repeat(count, n).astype(np.float64), minlength=len(kinds)).astype(np.uint32))
        sizes = np.array([len(k) for k in keys], np.uint32)
        items = np.concatenate(keys) if keys else np.zeros(0, np.uint32)
        gaps = np.diff(items, prepend=np.uint32(0)).astype(np.uint32)  # wraps at each document's start; undone by a running sum
        listed = list(words)
        sorted_words = [listed[i] for i in order]
        used, firsts = np.unique(buckets[order], return_index=True)
        lasts = np.append(firsts[1:], len(sorted_words))
        vocabulary = [(int(b), zlib.compress(b"\n".join(sorted_words[i:j]), 1)) for b, i, j in zip(used, firsts, lasts)]
        return {"block": block, "docs": self.ids, "n_bytes": self.n_bytes, "sizes": _pack(sizes), "items": _pack(gaps), "freqs": _pack(np.concatenate(counts) if counts else np.zeros(0, np.uint32)), "vocabulary": vocabulary}


def _schema(kind: str) -> str:
    return f"block long, docs array<{kind}>, n_bytes array<long>, sizes binary, items binary, freqs binary, vocabulary array<struct<bucket:int,words:binary>>"


def blocks(docs: DataFrame, id_col: str, text_col: str, path: str) -> DataFrame:
    """The block table: per-document pre-token frequencies, and each block's vocabulary by bucket."""
    source = docs.select(id_col, text_col)
    id_type = source.schema[id_col].dataType

    def run(batches):
        from pyspark import TaskContext

        words = vocab.load(path)
        if path not in _pre_tokens:
            _pre_tokens[path] = _Splitter(words)
        splitter, base, n = _pre_tokens[path], TaskContext.get().partitionId() << 32, 0
        block, kind = _Block(splitter), None

        def out():
            vocabulary = pa.list_(pa.struct([("bucket", pa.int32()), ("words", pa.binary())]))
            schema = pa.schema([("block", pa.int64()), ("docs", pa.list_(kind)), ("n_bytes", pa.list_(pa.int64())), ("sizes", pa.binary()), ("items", pa.binary()), ("freqs", pa.binary()), ("vocabulary", vocabulary)])
            row = block.row(base + n)
            row["vocabulary"] = [{"bucket": b, "words": w} for b, w in row["vocabulary"]]
            return pa.RecordBatch.from_pylist([row], schema=schema)

        for batch in batches:
            kind = batch.schema.field(0).type
            ids, texts = batch.column(0).to_pylist(), batch.column(1).cast(pa.large_binary())
            for k in range(len(ids)):
                block.add(ids[k], texts[k].as_py() or b"")
                if block.size >= BLOCK_BYTES:
                    yield out()
                    n += 1
                    block = _Block(splitter)
        if block.ids:
            yield out()

    return source.mapInArrow(run, _schema(id_type.simpleString()))


def piece_counts(vocabularies: DataFrame, path: str) -> DataFrame:
    """(bucket, block, words) -> (block, bucket, counts): each distinct pre-token of a bucket counted once."""

    def run(batches):
        if path not in _counters:
            _counters[path] = (vocab.library_encoder(path), {s.encode() for s in vocab.load(path).specials})
        encode, specials = _counters[path]
        bucket, known = None, {}
        for batch in batches:
            out = []
            for b, words in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
                if b != bucket:
                    bucket, known = b, {}
                listed = zlib.decompress(words).split(b"\n")
                for w in listed:
                    if w not in known:
                        known[w] = 1 if w in specials else len(encode(w))
                out.append(zlib.compress(np.fromiter(map(known.__getitem__, listed), np.uint32, len(listed)).tobytes(), 1))
            yield pa.RecordBatch.from_arrays([batch.column(1), batch.column(0), pa.array(out, pa.binary())], names=["block", "bucket", "counts"])

    placed = vocabularies.repartition("bucket").sortWithinPartitions("bucket", "block")
    return placed.select("bucket", "block", "words").mapInArrow(run, "block long, bucket int, counts binary")


def token_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", limit: int = 2048, path: str | None = None) -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit) per row.

    Null text counts as empty; an empty or blank text has no tokens; repeated
    rows give repeated results; an empty table gives an empty table.
    """
    spark = docs.sparkSession
    ship(spark)
    path = path or vocab.vocabulary_path()
    scratch = Scratch(spark, "token-counts")
    table = scratch.put(blocks(docs, id_col, text_col, path), "blocks")
    words = table.select("block", F.inline("vocabulary"))
    counts = piece_counts(words, path)
    counts = counts.groupBy("block").agg(F.array_sort(F.collect_list(F.struct("bucket", "counts"))).alias("counts"))
    joined = table.drop("vocabulary").join(counts, "block", "left").select("docs", "n_bytes", "sizes", "items", "freqs", "counts.counts")
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                docs_k = batch.column(0).slice(k, 1).flatten()
                n_bytes = batch.column(1).slice(k, 1).flatten()
                sizes = _unpack(batch.column(2)[k].as_py(), np.uint32).astype(np.int64)
                items = np.cumsum(_unpack(batch.column(3)[k].as_py(), np.uint32), dtype=np.uint32)
                freqs = _unpack(batch.column(4)[k].as_py(), np.uint32)
                given = batch.column(5)[k].as_py() or []
                pieces = np.frombuffer(b"".join(map(zlib.decompress, given)), np.uint32)
                sums = np.concatenate([[0], np.cumsum(pieces[items].astype(np.int64) * freqs)]) if len(items) else np.zeros(1, np.int64)
                ends = np.cumsum(sizes)
                n = sums[ends] - sums[ends - sizes]
                yield pa.RecordBatch.from_arrays([docs_k, n_bytes, pa.array(n, pa.int64()), pa.array(n > limit, pa.bool_())], names=[id_col, "n_bytes", "n_tokens", "over_limit"])

    result = scratch.put(joined.mapInArrow(run, f"`{id_col}` {kind}, n_bytes long, n_tokens long, over_limit boolean"), "counts")
    scratch.keep("counts")
    return result

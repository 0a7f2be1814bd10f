"""LM scoring by deleted interpolation.

Bigram, unigram and uniform estimates are mixed with weights that depend on
how often the context was seen (a bucket for each power of two). Training
texts are split once more: maximum-likelihood counts of the retained part are
mixed to predict the held-out part, and expectation-maximisation finds each
bucket's weights. The final model has these weights over the counts of all
training texts.

Counts are gathered by block. A block is some millions of tokens in a row of
the block table; its distinct n-grams, as sorted 64-bit keys, go out by key
range with their counts. A range sums each key over all blocks and answers
every block in the block's own order. A frequent word is one entry per block,
never a hot key. EM needs only the number of held-out tokens for each bucket
and (logarithmically rounded) pair of estimates, a histogram of bounded size.

Defined results: null text is empty; a text always has its end token, so an
empty one scores the end after the start; a null id counts as empty text for
the split (held out); with no training text every estimate is uniform;
repeated rows are counted and scored as often as they occur.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import Scratch, one_a_batch, release, ship
from .shingles import WordHashes, mix, word_hashes

BLOCK_TOKENS = 2_500_000
#: Tokens of a block that are scored at once.
SLICE_TOKENS = 1 << 18
FOLDS, TEST_FOLD, TUNE_FOLD = 10, 0, 1
BUCKETS = 40
#: Steps of the logarithmic rounding of estimates in the EM histogram, a doubling.
STEPS = 4
_END, _START = np.uint64(0x0123456789ABCDEF), np.uint64(0xFEDCBA9876543210)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_memo = WordHashes()


def _pack(a: np.ndarray) -> bytes:
    """Byte planes of an integer array, compressed."""
    planes = np.ascontiguousarray(a).view(np.uint8).reshape(len(a), a.itemsize).T if len(a) else np.zeros(0, np.uint8)
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes).tobytes())


def _unpack(b: bytes, dtype) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(b), np.uint8)
    width = np.dtype(dtype).itemsize
    return np.ascontiguousarray(raw.reshape(width, -1).T).reshape(-1).view(dtype) if len(raw) else np.zeros(0, dtype)


def fold(doc_id) -> int:
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % FOLDS


def block_table(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(block, docs, folds, sizes, items, words, tokens, train, tune): tokens as positions in the block's vocabulary."""
    source = docs.select(id_col, text_col)
    kind = source.schema[id_col].dataType.simpleString()

    def run(batches):
        from pyspark import TaskContext

        base, made = TaskContext.get().partitionId() << 32, 0
        ids, parts, held, id_type = [], [], 0, None

        def row(block):
            sizes = np.array([len(p) for p in parts], np.uint32)
            every = np.concatenate(parts)
            parts.clear()
            order = np.argsort(every, kind="stable")
            ranked = every[order]
            del every
            new = np.concatenate([[True], ranked[1:] != ranked[:-1]])
            words, place = ranked[new], np.cumsum(new, dtype=np.int32) - 1
            del ranked
            counts = np.bincount(place)
            by_count = np.argsort(-counts, kind="stable")
            rank = np.empty(len(words), np.uint32)
            rank[by_count] = np.arange(len(words), dtype=np.uint32)
            items = np.empty(len(order), np.uint32)
            items[order] = rank[place]
            del order, place
            folds = np.array([fold(i) for i in ids], np.uint8)
            train = int(sizes[folds != TEST_FOLD].sum())
            tune = int(sizes[folds == TUNE_FOLD].sum())
            columns = [[block], [ids], [folds.tobytes()], [sizes.tobytes()], [_pack(items)], [words[by_count].tobytes()], [len(items)], [train], [tune]]
            types = [pa.int64(), pa.list_(id_type), *[pa.binary()] * 4, *[pa.int64()] * 3]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["block", "docs", "folds", "sizes", "items", "words", "tokens", "train", "tune"])

        for batch in batches:
            id_type = batch.schema.field(0).type
            texts = batch.column(1).cast(pa.large_binary())
            for k, i in enumerate(batch.column(0).to_pylist()):
                h = word_hashes(texts[k].as_py() or b"", _memo)
                ids.append(i)
                parts.append(np.append(h, _END))
                held += len(h) + 1
                if held >= BLOCK_TOKENS:
                    yield row(base + made)
                    ids, parts, held, made = [], [], 0, made + 1
        if ids:
            yield row(base + made)
        _memo.clear()  # the worker goes on to the next phases
        release()

    return source.mapInArrow(run, f"block long, docs array<{kind}>, folds binary, sizes binary, items binary, words binary, tokens long, train long, tune long")


class Block:
    """A row of the block table, opened: its distinct n-grams in key order."""

    def __init__(self, folds: bytes, sizes: bytes, items: bytes, words: bytes):
        self.folds = np.frombuffer(folds, np.uint8)
        self.sizes = np.frombuffer(sizes, np.uint32).astype(np.int64)
        self.items = _unpack(items, np.uint32)
        hashes = np.frombuffer(words, np.uint64)
        self.ends = np.cumsum(self.sizes)
        self.begins = self.ends - self.sizes
        with np.errstate(over="ignore"):
            keys = mix(hashes * _STEP + np.uint64(1))
            self.uni_order = np.argsort(keys, kind="stable")
            self.uni_keys = keys[self.uni_order]
            current = hashes[self.items]
            self.raw = np.empty(len(self.items), np.uint64)
            self.raw[1:] = current[:-1]
            self.raw[self.begins] = _START
            for i in range(0, len(current), 1 << 18):  # in slices, for small temporaries
                j = slice(i, i + (1 << 18))
                self.raw[j] = mix(mix(self.raw[j] * _STEP + np.uint64(2)) ^ current[j])

    def unigrams(self) -> tuple[np.ndarray, np.ndarray]:
        """(keys, position of each token among them)."""
        place = np.empty(len(self.uni_order), np.int32)
        place[self.uni_order] = np.arange(len(self.uni_order), dtype=np.int32)
        return self.uni_keys, place[self.items]

    def bigrams(self, at: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        if at is None:
            order = np.argsort(self.raw)
            ranked = self.raw[order]
            new = np.concatenate([[True], ranked[1:] != ranked[:-1]])
            keys = ranked[new]
            del ranked
            place = np.empty(len(order), np.int32)
            place[order] = np.cumsum(new, dtype=np.int32) - 1
            return keys, place
        keys = np.sort(self.raw)
        keys = keys[np.concatenate([[True], keys[1:] != keys[:-1]])]
        return keys, np.searchsorted(keys, self.raw[at])

    def token_folds(self) -> np.ndarray:
        return np.repeat(self.folds, self.sizes)


def _squeeze(keys: np.ndarray) -> bytes:
    """Sorted keys as gaps of 6 or 8 bytes."""
    gaps = np.diff(keys, prepend=np.uint64(0))
    narrow = not len(gaps) or int(gaps[1:].max(initial=0)) < 1 << 48
    head = int(keys[0]) if len(keys) else 0
    body = gaps[1:].view(np.uint8).reshape(-1, 8)[:, : 6 if narrow else 8].tobytes()
    return bytes([6 if narrow else 8]) + head.to_bytes(8, "little") + body


def _spread(b: bytes, n: int) -> np.ndarray:
    if not n:
        return np.zeros(0, np.uint64)
    width = b[0]
    gaps = np.zeros((n, 8), np.uint8)
    gaps[0] = np.frombuffer(b, np.uint8, 8, 1)
    gaps[1:, :width] = np.frombuffer(b, np.uint8, (n - 1) * width, 9).reshape(-1, width)
    return np.cumsum(gaps.reshape(-1).view(np.uint64), dtype=np.uint64)


def ngram_counts(table: DataFrame, ranges: int) -> DataFrame:
    """(range, block, kind, n, keys, retained, tuned): each block's distinct n-grams by key range."""
    shift = np.uint64(64 - ranges.bit_length() + 1)

    def run(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                number, folds, sizes, items, words = (batch.column(c)[k].as_py() for c in range(5))
                block = Block(folds, sizes, items, words)
                f = block.token_folds()
                rows = []
                for kind, grams in enumerate((block.unigrams, block.bigrams)):
                    keys, place = grams()
                    tuned = np.bincount(place[f == TUNE_FOLD], minlength=len(keys)).astype(np.uint32)
                    kept = np.bincount(place[(f != TUNE_FOLD) & (f != TEST_FOLD)], minlength=len(keys)).astype(np.uint32)
                    of = (keys >> shift).astype(np.int64)
                    cuts = np.flatnonzero(np.diff(of, prepend=-1))  # ranges that have keys only
                    for i, j in zip(cuts.tolist(), [*cuts[1:].tolist(), len(keys)]):
                        rows.append((int(of[i]), number, kind, j - i, _squeeze(keys[i:j]), _pack(kept[i:j]), _pack(tuned[i:j])))
                del block, f, keys, place, tuned, kept, of
                release()
                columns = list(zip(*rows))
                types = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["range", "block", "kind", "n", "keys", "retained", "tuned"])

    return table.select("block", "folds", "sizes", "items", "words").mapInArrow(run, "range long, block long, kind int, n int, keys binary, retained binary, tuned binary")


def totals(counts: DataFrame) -> DataFrame:
    """(block, kind, range, retained, train, kinds_retained, kinds_train): corpus counts in each block's order.

    The last two, on one row of each range and kind, are its numbers of
    distinct keys in the retained and in all training texts.
    """
    names = ["block", "kind", "range", "retained", "train", "kinds_retained", "kinds_train"]
    types = [pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.int64()]

    def answer(group):
        every = [_spread(g[4], g[3]) for g in group]
        keys = np.concatenate(every)
        order = np.argsort(keys)
        ranked = keys[order]
        new = np.concatenate([[True], ranked[1:] != ranked[:-1]])
        place = np.empty(len(order), np.int64)
        place[order] = np.cumsum(new) - 1
        kept = np.concatenate([_unpack(g[5], np.uint32) for g in group])
        tuned = np.concatenate([_unpack(g[6], np.uint32) for g in group])
        retained = np.bincount(place, weights=kept).astype(np.uint32)
        train = retained + np.bincount(place, weights=tuned).astype(np.uint32)
        at = 0
        for k, g in enumerate(group):
            mine = place[at : at + g[3]]
            at += g[3]
            yield (g[1], g[2], g[0], _pack(retained[mine]), _pack(train[mine]), int((retained > 0).sum()) if k == 0 else 0, int((train > 0).sum()) if k == 0 else 0)

    def run(batches):
        group = []
        for batch in batches:
            out = []
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if group and (row[0], row[2]) != (group[0][0], group[0][2]):
                    out += answer(group)
                    group = []
                group.append(row)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)
        if group:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*answer(group)), types)], names=names)
        group = batch = out = None
        release()

    placed = counts.repartition("range", "kind").sortWithinPartitions("range", "kind", "block")
    return placed.mapInArrow(run, "block long, kind int, range long, retained binary, train binary, kinds_retained long, kinds_train long")


def bucket(context_count: np.ndarray) -> np.ndarray:
    """0 for an unseen context, else one more than the floor of the count's base-2 logarithm."""
    return np.minimum(BUCKETS - 1, np.frexp(context_count.astype(np.float64))[1] * (context_count > 0))


def _estimates(block: Block, given: list, train: bool, at: np.ndarray | None, docs: int):
    """(first token, counts of each chosen token, of its context and of the pair), some tokens at a time; ``docs`` counts a text's start."""
    found = [[], []]
    for kind, _, retained, all_train in sorted((g["kind"], g["range"], g["retained"], g["train"]) for g in given):
        found[kind].append(_unpack(all_train if train else retained, np.uint32))
    given.clear()
    uni, bi = (np.concatenate(f) if f else np.zeros(0, np.uint32) for f in found)
    found.clear()
    of_word = np.empty(len(uni), np.uint32)  # by the block's vocabulary, like its items
    of_word[block.uni_order] = uni
    begin = np.zeros(len(block.items), bool)
    begin[block.begins] = True
    _, place = block.bigrams(at)
    for i in range(0, len(place), SLICE_TOKENS):
        j = min(i + SLICE_TOKENS, len(place))
        mine = np.arange(i, j) if at is None else at[i:j]
        word = of_word[block.items[mine]].astype(np.int64)
        context = np.where(begin[mine], docs, of_word[block.items[mine - 1]].astype(np.int64))
        yield i, word, context, bi[place[i:j]].astype(np.int64)


def learn_weights(histogram: list[tuple[int, int, int, int]], tokens: int, kinds: int, rounds: int = 40) -> np.ndarray:
    """(BUCKETS, 3) weights of bigram, unigram and uniform estimate, by EM on (bucket, bigram step, unigram step, tokens)."""
    weights = np.full((BUCKETS, 3), 1 / 3)
    weights[0] = (0, 0.5, 0.5)
    if not tokens:
        weights[:] = (0, 0, 1)
        return weights
    if not histogram:
        return weights
    h = np.array(histogram, np.int64)
    value = lambda s: np.where(s < 0, 0.0, np.exp2(-s / STEPS))
    p = np.stack([value(h[:, 1]), value(h[:, 2]), np.full(len(h), 1 / (kinds + 1))], 1)
    seen = np.bincount(h[:, 0], weights=h[:, 3], minlength=BUCKETS)
    for _ in range(rounds):
        share = weights[h[:, 0]] * p
        share *= (h[:, 3] / np.maximum(share.sum(1), 1e-300))[:, None]
        mass = np.stack([np.bincount(h[:, 0], weights=share[:, j], minlength=BUCKETS) for j in range(3)], 1)
        # A little of the mean over all buckets steadies those with few tokens.
        mean = mass.sum(0) / mass.sum()
        mass += 5 * np.where(np.arange(BUCKETS)[:, None] == 0, np.array([0, mean[1], mean[0] + mean[2]]), mean)
        weights = mass / mass.sum(1, keepdims=True)
    weights[seen == 0, 2] = np.maximum(weights[seen == 0, 2], 1e-6)
    return weights / weights.sum(1, keepdims=True)


def score_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, held_out, n_tokens, n_known, train_tokens, base_score, score): log10 probabilities of every whole text."""
    spark = docs.sparkSession
    ship(spark)
    scratch = Scratch(spark, "lm-scoring")
    id_kind = docs.schema[id_col].dataType.simpleString()
    table = scratch.put(block_table(docs, id_col, text_col), "blocks")
    size = table.agg(F.count(F.lit(1)), F.coalesce(F.sum("train"), F.lit(0)), F.coalesce(F.sum("tune"), F.lit(0))).first()
    n_blocks, n_train, n_tune = size
    # Key ranges follow the blocks, so that what one range gathers from all of them has the same size for any input.
    ranges = max(64, 1 << (8 * max(1, n_blocks) - 1).bit_length())
    given = scratch.put(totals(ngram_counts(table, ranges)), "totals")
    scratch.settle()
    kinds_retained, kinds_train = given.filter("kind = 0").agg(F.coalesce(F.sum("kinds_retained"), F.lit(0)), F.coalesce(F.sum("kinds_train"), F.lit(0))).first()
    answers = given.groupBy("block").agg(F.collect_list(F.struct("kind", "range", "retained", "train")).alias("given"))
    opened = table.drop("tokens", "train", "tune").join(answers, "block")
    n_retained = n_train - n_tune
    starts = table.select(F.explode(F.expr("transform(sequence(1, length(folds)), i -> hex(substring(folds, i, 1)))")).alias("f")).groupBy("f").count().collect()
    per_fold = {int(r[0], 16): r[1] for r in starts}  # at most FOLDS rows
    docs_train = sum(n for f, n in per_fold.items() if f != TEST_FOLD)
    docs_retained = docs_train - per_fold.get(TUNE_FOLD, 0)

    def tune(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                folds, sizes, items, words, answered = (batch.column(c)[k].as_py() for c in range(5))
                block = Block(folds, sizes, items, words)
                at = np.flatnonzero(block.token_folds() == TUNE_FOLD)
                if not len(at):
                    continue
                found = []
                for _, word, context, pair in _estimates(block, answered, False, at, docs_retained):
                    with np.errstate(divide="ignore", invalid="ignore"):
                        step = lambda p: np.where(p > 0, np.rint(-STEPS * np.log2(np.where(p > 0, p, 1))), -1).astype(np.int64)
                        two, one = step(pair / np.maximum(context, 1)), step(word / max(1, n_retained))
                    found.append((bucket(context).astype(np.int64) << 40) | ((two + 1) << 20) | (one + 1))
                key, count = np.unique(np.concatenate(found), return_counts=True)
                del block, at, found
                release()
                yield pa.RecordBatch.from_arrays([pa.array(key >> 40), pa.array(((key >> 20) & 0xFFFFF) - 1), pa.array((key & 0xFFFFF) - 1), pa.array(count.astype(np.int64))], names=["bucket", "two", "one", "n"])

    columns = ["folds", "sizes", "items", "words", "given"]
    histogram = opened.select(*columns).mapInArrow(tune, "bucket long, two long, one long, n long").groupBy("bucket", "two", "one").agg(F.sum("n").alias("n"))
    with one_a_batch(spark):
        rows = sorted(tuple(r) for r in histogram.collect())  # bounded by BUCKETS and the steps of both estimates; EM sums in this order
    weights = learn_weights(rows, n_retained, kinds_retained)
    scratch.settle()

    def score(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                folds, sizes, items, words, answered = (batch.column(c)[k].as_py() for c in range(1, 6))
                ids = batch.column(0).slice(k, 1).flatten()
                block = Block(folds, sizes, items, words)
                n = len(ids)
                known, base, score = np.zeros(n, np.int64), np.zeros(n), np.zeros(n)
                for i, word, context, pair in _estimates(block, answered, True, None, docs_train):
                    w = weights[bucket(context)]
                    p = w[:, 0] * pair / np.maximum(context, 1) + w[:, 1] * word / max(1, n_train) + w[:, 2] / (kinds_train + 1)
                    # The texts that have tokens here; a long one goes on in the next slice.
                    a, b = np.searchsorted(block.ends, i, "right"), np.searchsorted(block.begins, i + len(word))
                    starts = np.maximum(block.begins[a:b] - i, 0)
                    known[a:b] += np.add.reduceat((word > 0).astype(np.int64), starts)
                    base[a:b] += np.add.reduceat(np.log10((word + 0.1) / (n_train + 0.1 * (kinds_train + 1))), starts)
                    score[a:b] += np.add.reduceat(np.log10(p), starts)
                yield pa.RecordBatch.from_arrays([ids, pa.array(block.folds == TEST_FOLD), pa.array(block.sizes), pa.array(known), pa.array(np.full(n, n_train, np.int64)), pa.array(base), pa.array(score)], names=[id_col, "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])
                del block
                release()

    scored = opened.select("docs", *columns).mapInArrow(score, f"`{id_col}` {id_kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
    with one_a_batch(spark):
        result = scratch.put(scored, "scores")
    scratch.keep("scores")
    return result

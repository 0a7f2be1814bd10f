"""Language ID with segmentation-marginalised unigrams.

A language gives every piece of a fixed public vocabulary a probability. The
probability of a word is the sum over all its segmentations into pieces,
computed by the forward algorithm; a text is the product of its words, and its
prediction the language with the largest posterior under equal priors. Piece
probabilities are learned by EM (forward and backward over the same lattices)
from word counts of a bounded sample of labelled texts.

Texts are scored in one pass without a shuffle: a space-separated chunk has a
row of log probabilities that is computed once for each worker and summed by
document, however long the document is.

Words of any length are scored whole. Those of up to ``LONGEST`` letters go
through the lattice many at a time; a longer one goes letter by letter, its
sums kept in logarithms over a window as long as the longest piece.

Defined results: null text, or one without a letter (Unicode category L), is
``und`` with score 0;
rows with null text or language teach nothing, and with no teaching rows every
text is ``und``; repeated rows count as often as they occur.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import vocab
from .scratch import ship

FOLDS, TEST_FOLD = 5, 0
#: The bound on labelled texts that teach each language.
SAMPLE = 400
UNDETERMINED = "und"
ROUNDS = 3
#: Letters of the words that share a lattice: their sums stay in range, and the lattice small.
LONGEST = 40
_SCALE = 30.0
_UNKNOWN = 1e-7
_LETTERS = regex.compile(r"\p{L}+")
#: Chunks, and their bytes, that a worker remembers, and words whose lattice is made at once.
MEMO_ENTRIES = 200_000
MEMO_BYTES = 48 << 20
LATTICE_WORDS = 4_000


def words_of(chunk: bytes) -> list[str]:
    """Lower-case letter runs of a chunk."""
    low = chunk.lower()
    if low.isalpha():
        return [low.decode()]
    return _LETTERS.findall(chunk.decode("utf-8", "replace").lower())


_pieces: dict[str, dict[str, int]] = {}


def piece_ids(path: str) -> dict[str, int]:
    """The vocabulary's lower-case letter pieces; a leading mark stands for a word's start."""
    if path not in _pieces:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        names = (model.id_to_piece(i) for i in range(model.get_piece_size()))
        kept = [n for n in names if (w := n.removeprefix("▁")) and w.isalpha() and w == w.lower()]
        _pieces[path] = {n: i for i, n in enumerate(dict.fromkeys(kept))}
    return _pieces[path]


def beginnings(pieces: dict[str, int]) -> dict[str, int]:
    """The pieces, and with -1 what only begins one."""
    return {p[:j]: -1 for p in pieces for j in range(1, len(p))} | pieces


class Lattice:
    """All pieces of some words: (word, begin, end, piece), in order of end."""

    def __init__(self, words: list[str], pieces: dict[str, int], longest: int, begun: dict[str, int] | None = None):
        self.sizes = np.array([len(w) for w in words], np.int64)
        unknown = len(pieces)
        word, begin, end, piece = [], [], [], []
        get = (beginnings(pieces) if begun is None else begun).get
        for k, w in enumerate(words):
            n = len(w)
            for i in range(n):
                for j in range(i + 1, min(n, i + longest) + 1):
                    p = get(w[i:j] if i else "▁" + w[:j])
                    if j == i + 1 or p is not None and p >= 0:
                        word.append(k)
                        begin.append(i)
                        end.append(j)
                        piece.append(unknown if p is None or p < 0 else p)
                    if p is None:  # no piece begins so
                        break
        order = np.argsort(end, kind="stable") if end else np.zeros(0, np.int64)
        self.word, self.begin, self.end, self.piece = (np.array(x, np.int64)[order] for x in (word, begin, end, piece))
        self.scale = _SCALE ** (self.end - self.begin).astype(np.float64)
        self.cuts = np.searchsorted(self.end, np.arange(1, int(self.sizes.max(initial=0)) + 2))

    def forward(self, p: np.ndarray) -> np.ndarray:
        """(words, ends + 1) scaled forward sums under one language's piece probabilities."""
        n, m = len(self.sizes), int(self.sizes.max(initial=0))
        alpha = np.zeros((m + 1, n))
        alpha[0] = 1
        value = p[self.piece] * self.scale
        for j in range(1, m + 1):
            i = slice(self.cuts[j - 1], self.cuts[j])
            w = self.word[i]
            alpha[j] = np.bincount(w, weights=alpha[self.begin[i], w] * value[i], minlength=n)
        return alpha

    def log_probability(self, p: np.ndarray) -> np.ndarray:
        alpha = self.forward(p)
        return np.log(alpha[self.sizes, np.arange(len(self.sizes))]) - self.sizes * np.log(_SCALE)

    def expected(self, p: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Expected piece counts given word counts."""
        n, m = len(self.sizes), int(self.sizes.max(initial=0))
        alpha = self.forward(p)
        beta = np.zeros((m + 1, n))
        beta[self.sizes, np.arange(n)] = 1
        value = p[self.piece] * self.scale
        for j in range(m, 0, -1):  # words' own ends come first, so beta[j] is complete when j is reached
            i = slice(self.cuts[j - 1], self.cuts[j])
            w = self.word[i]
            np.add.at(beta, (self.begin[i], w), beta[j, w] * value[i])
        share = counts / np.maximum(alpha[self.sizes, np.arange(n)], 1e-300)
        return np.bincount(self.piece, weights=alpha[self.begin, self.word] * value * beta[self.end, self.word] * share[self.word], minlength=len(p))


def _ends(word: str, pieces: dict[str, int], longest: int):
    """(end, [(begin, piece)]) for each letter of a word, the unknown piece for letters that are none."""
    unknown, get = len(pieces), pieces.get
    for j in range(1, len(word) + 1):
        found = []
        for i in range(max(0, j - longest), j):
            p = get(word[i:j] if i else "▁" + word[:j])
            if p is not None:
                found.append((i, p))
            elif i == j - 1:
                found.append((i, unknown))
        yield j, found


def long_word(word: str, table: np.ndarray, pieces: dict[str, int], longest: int) -> np.ndarray:
    """Log probabilities of a word of any length, one for each column of ``table``; memory as for its longest piece."""
    size = longest + 1
    logs = np.zeros((size, table.shape[1]))
    n = 0
    for n, found in _ends(word, pieces, longest):
        parts = np.stack([logs[i % size] for i, _ in found]) + np.log(table[[p for _, p in found]])
        top = parts.max(0)
        logs[n % size] = top + np.log(np.exp(parts - top).sum(0))
    return logs[n % size].copy()


def long_expected(word: str, p: np.ndarray, pieces: dict[str, int], longest: int) -> np.ndarray:
    """Expected piece counts of one word of any length."""
    logs, edges = np.zeros(len(word) + 1), []
    for j, found in _ends(word, pieces, longest):
        i, q = (np.array(x) for x in zip(*found))
        parts = logs[i] + np.log(p[q])
        top = parts.max()
        logs[j] = top + np.log(np.exp(parts - top).sum())
        edges.append((j, i, q, parts - logs[j]))  # the share of the sum at j that comes over each edge
    out, reach = np.zeros(len(p)), np.zeros(len(word) + 1)
    reach[len(word)] = 1  # the expected number of piece ends at each letter
    for j, i, q, share in reversed(edges):
        flow = reach[j] * np.exp(share)
        np.add.at(reach, i, flow)
        np.add.at(out, q, flow)
    return out


def learn(counts: dict[str, dict[str, int]], pieces: dict[str, int], rounds: int = ROUNDS) -> tuple[list[str], np.ndarray]:
    """(languages, pieces + 1 by languages) probabilities from word counts by language."""
    languages = sorted(counts)
    longest = max((len(p) for p in pieces), default=1)
    table = np.full((len(pieces) + 1, len(languages)), _UNKNOWN)
    for k, language in enumerate(languages):
        words = sorted(w for w in counts[language] if len(w) <= LONGEST)
        rest = sorted(w for w in counts[language] if len(w) > LONGEST)
        weight = np.array([counts[language][w] for w in words], np.float64)
        p = np.full(len(pieces) + 1, 1 / (len(pieces) + 1))
        p[-1] = _UNKNOWN
        parts = [(Lattice(words[i : i + 20_000], pieces, longest), weight[i : i + 20_000]) for i in range(0, len(words), 20_000)]
        for _ in range(rounds):
            got = sum((lattice.expected(p, w) for lattice, w in parts), np.zeros(len(p)))
            for w in rest:
                got += counts[language][w] * long_expected(w, p, pieces, longest)
            p = (got + 0.01) / (got.sum() + 0.01 * len(p))
            p[-1] = _UNKNOWN
        table[:, k] = p
    return languages, table


class _Scorer(dict):
    """chunk -> row of log probabilities by language; new chunks wait for ``rows``, and ``thin`` forgets those met once."""

    def __init__(self, pieces: dict[str, int], table: np.ndarray):
        super().__init__()
        self.pieces, self.table = pieces, table
        self.longest = max((len(p) for p in pieces), default=1)
        self.begun = beginnings(pieces)
        self.words: dict[str, int] = {}
        self.clear()

    def clear(self) -> None:
        super().clear()
        self.words.clear()
        self.held = 0
        self.new: list[bytes] = []
        self.of_words = np.zeros((0, self.table.shape[1]))
        self.of_chunks = np.zeros((0, self.table.shape[1] + 1))
        self.word_uses, self.chunk_uses = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def thin(self) -> None:
        """Keeps the chunks met, and the words in chunks met, more than once, unless those are over half of what may be held."""
        again, shared = self.chunk_uses > 1, self.word_uses > 1
        chunks = [c for c, a in zip(self, again.tolist()) if a]
        words = [w for w, s in zip(self.words, shared.tolist()) if s]
        of_chunks, of_words = self.of_chunks[again], self.of_words[shared]
        held = sum(map(len, chunks))
        self.clear()
        if 2 * max(len(chunks), len(words)) <= MEMO_ENTRIES and 2 * held <= MEMO_BYTES:
            self.update(zip(chunks, range(len(chunks))))
            self.words.update(zip(words, range(len(words))))
            self.of_chunks, self.of_words, self.held = of_chunks, of_words, held
            self.chunk_uses, self.word_uses = np.zeros(len(chunks), np.int64), np.zeros(len(words), np.int64)

    def __missing__(self, chunk: bytes) -> int:
        self[chunk] = k = len(self)
        self.new.append(chunk)
        self.held += len(chunk)
        return k

    def rows(self) -> np.ndarray:
        """A row for every chunk so far; the last column counts its words."""
        if self.new:
            fresh, owner, place = [], [], []
            for k, chunk in enumerate(self.new):
                for w in words_of(chunk):
                    at = self.words.get(w)
                    if at is None:
                        at = self.words[w] = len(self.words)
                        fresh.append(w)
                    owner.append(k)
                    place.append(at)
            if fresh:
                short = np.array([len(w) <= LONGEST for w in fresh])
                got = np.empty((len(fresh), self.table.shape[1]))
                every = np.flatnonzero(short)
                for i in range(0, len(every), LATTICE_WORDS):
                    some = every[i : i + LATTICE_WORDS]
                    lattice = Lattice([fresh[k] for k in some], self.pieces, self.longest, self.begun)
                    for c in range(self.table.shape[1]):
                        got[some, c] = lattice.log_probability(self.table[:, c])
                for k in np.flatnonzero(~short):
                    got[k] = long_word(fresh[k], self.table, self.pieces, self.longest)
                self.of_words = np.concatenate([self.of_words, got])
            self.word_uses = np.concatenate([self.word_uses, np.zeros(len(fresh), np.int64)])
            self.chunk_uses = np.concatenate([self.chunk_uses, np.zeros(len(self.new), np.int64)])
            got = np.zeros((len(self.new), self.table.shape[1] + 1))
            if owner:
                self.word_uses += np.bincount(place, minlength=len(self.words))
                for c in range(self.table.shape[1]):
                    got[:, c] = np.bincount(owner, weights=self.of_words[place, c], minlength=len(self.new))
                got[:, -1] = np.bincount(owner, minlength=len(self.new))
            self.of_chunks = np.concatenate([self.of_chunks, got])
            self.new = []
        return self.of_chunks


_scorers: dict[int, _Scorer] = {}


def _sums(texts: list[bytes], scorer: _Scorer) -> np.ndarray:
    out = np.zeros((len(texts), scorer.table.shape[1] + 1))
    held, rows = [], []

    def flush():
        table = scorer.rows()
        begins = np.cumsum([0] + [len(h) for h in held[:-1]])
        every = np.concatenate(held)
        sums = np.add.reduceat(table[every], begins)
        np.add.at(out, rows, sums)
        scorer.chunk_uses += np.bincount(every, minlength=len(table))
        held.clear()
        rows.clear()
        if max(len(scorer), len(scorer.words)) >= MEMO_ENTRIES or scorer.held >= MEMO_BYTES:
            scorer.thin()

    size = 0
    for k, text in enumerate(texts):
        for words in vocab.pieces_of(text):
            if words:
                held.append(np.fromiter(map(scorer.__getitem__, words), np.int64, len(words)))
                rows.append(k)
                size += len(words)
            if size >= 400_000 or scorer.held >= MEMO_BYTES:
                flush()
                size = 0
    if held:
        flush()
    return out


def _fold(doc_id) -> int:
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % FOLDS


def teach(docs: DataFrame, id_col: str, text_col: str, lang_col: str, path: str, sample: int = SAMPLE):
    """Languages and piece probabilities, from at most ``sample`` texts of each language outside the test fold."""
    text_id = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    rows = docs.filter(F.col(text_col).isNotNull() & F.col(lang_col).isNotNull()).filter(F.pmod(F.crc32(text_id.cast("binary")), F.lit(FOLDS)) != TEST_FOLD)
    rows = rows.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"), F.xxhash64(text_id).alias("draw"))
    # Thin by hash to about twice the bound before the exact bound, so few texts move.
    rate = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).select("lang", F.least(F.lit(1.0), 2.0 * sample / F.col("n")).alias("rate"))
    thin = rows.join(F.broadcast(rate), "lang").filter(F.pmod("draw", F.lit(1 << 20)) < F.col("rate") * (1 << 20))
    drawn = thin.withColumn("k", F.row_number().over(Window.partitionBy("lang").orderBy("draw", "text"))).filter(F.col("k") <= sample)

    def split(batches):
        for batch in batches:
            lang, word, n = [], [], []
            for name, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.large_binary()).to_pylist()):
                counts: dict[str, int] = {}
                for chunk in text.split():
                    for w in words_of(chunk):
                        counts[w] = counts.get(w, 0) + 1
                lang += [name] * len(counts)
                word += counts
                n += counts.values()
            yield pa.RecordBatch.from_arrays([pa.array(lang, pa.string()), pa.array(word, pa.string()), pa.array(n, pa.int64())], names=["lang", "word", "n"])

    table = drawn.select("lang", "text").mapInArrow(split, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))
    counts: dict[str, dict[str, int]] = {}
    for lang, word, n in table.collect():  # the words of a bounded sample
        counts.setdefault(lang, {})[word] = n
    return learn(counts, piece_ids(path))


def _predictor(docs: DataFrame, id_col: str, text_col: str, lang_col: str, path: str | None, sample: int):
    """Texts -> (language or ``und``, posterior) for each, from what the labelled texts teach."""
    spark = docs.sparkSession
    ship(spark)
    path = path or vocab.vocabulary_path("piece_bpe_32k.model")
    languages, table = teach(docs, id_col, text_col, lang_col, path, sample)
    model = zlib.crc32(table.tobytes())
    sent = spark.sparkContext.broadcast(table)  # pieces by languages

    def predict(texts: list) -> tuple[list[str], np.ndarray]:
        if not languages or not texts:
            return [UNDETERMINED] * len(texts), np.zeros(len(texts))
        vocab.only("language_id", _scorers.clear)
        if model not in _scorers:
            _scorers.clear()
            _scorers[model] = _Scorer(piece_ids(path), sent.value)
        sums = _sums([t or b"" for t in texts], _scorers[model])
        share = np.exp(sums[:, :-1] - sums[:, :-1].max(1, keepdims=True))
        share /= share.sum(1, keepdims=True)
        known = sums[:, -1] > 0
        names = [languages[b] if k else UNDETERMINED for b, k in zip(np.argmax(share, 1), known)]
        return names, np.where(known, share.max(1), 0.0)

    return predict


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", path: str | None = None, sample: int = SAMPLE) -> DataFrame:
    """(id, held_out, lang_pred, score) per row; the score is the prediction's posterior probability."""
    predict = _predictor(docs, id_col, text_col, lang_col, path, sample)
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        for batch in vocab.sliced(batches, 1):
            predicted, score = predict(batch.column(1).cast(pa.large_binary()).to_pylist())
            held_out = [_fold(i) == TEST_FOLD for i in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(held_out, pa.bool_()), pa.array(predicted, pa.string()), pa.array(score, pa.float64())], names=[id_col, "held_out", "lang_pred", "score"])

    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, held_out boolean, lang_pred string, score double")


def keep_identified(docs: DataFrame, least: float = 0.5, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", path: str | None = None, sample: int = SAMPLE) -> DataFrame:
    """The rows whose language is determined with a posterior of at least ``least``, with all their columns, in one pass."""
    predict = _predictor(docs, id_col, text_col, lang_col, path, sample)
    at = docs.columns.index(text_col)

    def run(batches):
        for batch in vocab.sliced(batches, at):
            predicted, score = predict(batch.column(at).cast(pa.large_binary()).to_pylist())
            yield batch.filter(pa.array([p != UNDETERMINED and s >= least for p, s in zip(predicted, score)], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)

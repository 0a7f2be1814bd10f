"""Toxicity by a chain of linear classifiers.

Categories are predicted one after the other. Each model is a logistic
regression over the presence of selected words and a few shape measures of the
text, and over the log odds of every earlier category. In training those are
out-of-fold: a row's earlier probability comes from a model that never saw the
row, so later models learn from inputs as uncertain as those they will get.

Word selection and fitting use a bounded sample of labelled rows; every
document is then scored in one pass without a shuffle, over its whole text.

Defined results: null text is empty and, like any text without a word, has no
features, so its probabilities are the models' base rates; unlabelled rows and
null labels teach nothing; without any labelled row all probabilities are 0;
repeated rows give repeated results; of several texts under one labelled id
the least teaches.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import vocab
from .scratch import Scratch, ship

#: The bound on labelled rows that teach, words selected for each category, and folds of the chain.
SAMPLE = 20_000
WORDS = 160
FOLDS = 5
THRESHOLD = 0.5
LEAST_G = 24.0
_LETTERS = re.compile(r"[^\W\d_]+")
SHAPES = 6
PREFIXES = (4, 5, 6, 7)
#: Chunks in a generation of a worker's memo.
MEMO_ENTRIES = 100_000


def words_of(chunk: bytes) -> list[str]:
    """Lower-case letter runs of a chunk, and the beginnings (``^``) of the longer ones, which inflected forms share."""
    out = []
    for w in _LETTERS.findall(chunk.decode("utf-8", "replace").lower()):
        out.append(w)
        out += ["^" + w[:n] for n in PREFIXES if n < len(w)]
    return out


class _Words(dict):
    """chunk -> its words' numbers among the selected ones; two generations, the older one dropped when the younger is full."""

    def __init__(self, selected: dict[str, int], entries: int = MEMO_ENTRIES):
        super().__init__()
        self.selected, self.entries = selected, entries
        self.old: dict = {}

    def __missing__(self, chunk: bytes) -> tuple[int, ...]:
        got = self.old.get(chunk)
        if got is None:
            got = tuple(self.selected[w] for w in words_of(chunk) if w in self.selected)
        if len(chunk) <= 64:
            if len(self) >= self.entries:
                self.old = dict(self)
                self.clear()
            self[chunk] = got
        return got


def shape(text: bytes, n_words: int, n_distinct: int) -> list[float]:
    """Measures of a text's form, about 0 to 1 each."""
    n = max(1, len(text))
    upper = n - len(text.translate(None, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"))
    digits = n - len(text.translate(None, b"0123456789"))
    marks = n - len(text.translate(None, b"!?#*$%&=@<>|~^_{}[]\\"))
    return [np.log1p(len(text)) / 10, upper / n, digits / n, marks / n, n_distinct / max(1, n_words), min(1.0, n / max(1, n_words) / 20)]


def features(text: bytes, memo: _Words) -> tuple[list[int], list[float]]:
    """(selected words present, shape) of a whole text."""
    chunks: set[bytes] = set()
    n = 0
    for words in vocab.pieces_of(text):
        n += len(words)
        chunks.update(words)
    found = {k for got in map(memo.__getitem__, chunks) for k in got}
    return sorted(found), shape(text, n, len(chunks))


def fit(x: np.ndarray, y: np.ndarray, ridge: float = 0.3, rounds: int = 12) -> np.ndarray:
    """Logistic regression with a ridge, by Newton steps; the last weight is the intercept."""
    x = np.concatenate([x, np.ones((len(x), 1))], 1)
    penalty = np.full(x.shape[1], ridge)
    penalty[-1] = 1e-3
    w = np.zeros(x.shape[1])
    rate = (y.sum() + 0.5) / (len(y) + 1)
    w[-1] = np.log(rate / (1 - rate))
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (y - p) - penalty * w
        hessian = (x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty)
        step = np.linalg.solve(hessian, gradient)
        step *= min(1.0, 4.0 / max(1e-12, np.abs(step).max()))
        w += step
        if np.abs(step).max() < 1e-5:
            break
    return w


def predict(w: np.ndarray, x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x @ w[:-1] + w[-1], -30, 30)))


def _odds(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-4, 1 - 1e-4)
    return np.log(p / (1 - p)) / 4


def fit_chain(x: np.ndarray, y: np.ndarray, folds: np.ndarray) -> list[np.ndarray]:
    """A model for each column of ``y``; earlier categories enter with out-of-fold log odds."""
    chain = []
    for c in range(y.shape[1]):
        chain.append(fit(x, y[:, c]))
        out = np.empty(len(x))
        for f in range(FOLDS):
            test = folds == f
            if test.any():
                rest = ~test if (~test).any() else test
                out[test] = predict(fit(x[rest], y[rest, c]), x[test])
        x = np.concatenate([x, _odds(out)[:, None]], 1)
    return chain


def run_chain(chain: list[np.ndarray], x: np.ndarray) -> np.ndarray:
    """Probabilities of all categories, one after the other."""
    out = []
    for w in chain:
        out.append(predict(w, x))
        x = np.concatenate([x, _odds(out[-1])[:, None]], 1)
    return np.stack(out, 1)


def _fold(doc_id) -> int:
    return zlib.crc32(str(doc_id).encode()) % FOLDS


def teach(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, categories: dict[str, Column], sample: int = SAMPLE):
    """(selected words, chain of models) from at most ``sample`` labelled rows, drawn by hash of their id."""
    names = list(categories)
    known = labels.select(F.col(id_col).alias("__id"), *[c.cast("double").alias(n) for n, c in categories.items()]).dropna()
    drawn = known.orderBy(F.xxhash64("__id"), *names).limit(sample)
    rows = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text")).join(F.broadcast(drawn), "__id")  # at most ``sample`` small rows
    rows = rows.groupBy("__id", *names).agg(F.min("__text").alias("__text"))  # and no more come of it, however often an id occurs
    # The sample is small and read several times, so the documents are scanned for it once.
    scratch = Scratch(docs.sparkSession, "toxicity")
    rows = scratch.put(rows.select("__id", "__text", *names), "sample")

    def count(batches):
        table: dict[str, list] = {}
        for batch in batches:
            y = np.stack([batch.column(2 + k).to_numpy() for k in range(len(names))], 1)
            for k, text in enumerate(batch.column(1).cast(pa.large_binary()).to_pylist()):
                for w in {w for c in set((text or b"").split()) for w in words_of(c)}:
                    got = table.setdefault(w, [0] * (1 + len(names)))
                    got[0] += 1
                    for c in range(len(names)):
                        got[1 + c] += int(y[k, c])
        words = list(table)
        columns = [pa.array(words, pa.string())] + [pa.array([table[w][c] for w in words], pa.int64()) for c in range(1 + len(names))]
        yield pa.RecordBatch.from_arrays(columns, names=["word", "n", *[f"y{c}" for c in range(len(names))]])

    fields = ", ".join(f"y{c} long" for c in range(len(names)))
    counted = rows.mapInArrow(count, f"word string, n long, {fields}").groupBy("word").agg(F.sum("n").alias("n"), *[F.sum(f"y{c}").alias(f"y{c}") for c in range(len(names))]).filter("n >= 3")
    counted = scratch.put(counted, "words")
    totals = rows.agg(F.count(F.lit(1)), *[F.coalesce(F.sum(n), F.lit(0.0)) for n in names]).first()
    if not totals[0]:
        scratch.keep()
        return {}, []
    selected: list[str] = []
    for c in range(len(names)):
        total, hits = float(totals[0]), float(totals[1 + c])

        def part(observed: Column, expected: Column) -> Column:
            return F.when(observed > 0, observed * F.log(observed / F.greatest(expected, F.lit(1e-12)))).otherwise(0.0)

        n, y = F.col("n").cast("double"), F.col(f"y{c}").cast("double")
        g = 2 * (part(y, n * hits / total) + part(n - y, n * (total - hits) / total) + part(hits - y, (total - n) * hits / total) + part(total - n - hits + y, (total - n) * (total - hits) / total))
        best = counted.withColumn("g", g).filter(F.col("g") >= LEAST_G).orderBy(F.desc("g"), "word").limit(WORDS).collect()
        selected += [r["word"] for r in best if r["word"] not in selected]
    index = {w: k for k, w in enumerate(selected)}

    def measure(batches):
        memo = _Words(index)
        for batch in batches:
            got = [features(t or b"", memo) for t in batch.column(1).cast(pa.large_binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([_fold(i) for i in batch.column(0).to_pylist()], pa.int32()), pa.array([g[0] for g in got], pa.list_(pa.int32())), pa.array([g[1] for g in got], pa.list_(pa.float64())), *batch.columns[2:]], names=["fold", "words", "shape", *names])

    kinds = ", ".join(f"`{n}` double" for n in names)
    measured = rows.mapInArrow(measure, f"fold int, words array<int>, shape array<double>, {kinds}").collect()  # the bounded sample, a few numbers each
    scratch.drop("sample", "words")
    measured.sort(key=lambda r: (r["fold"], r["words"], r["shape"], [r[n] for n in names]))
    x = np.zeros((len(measured), len(selected) + SHAPES))
    for k, r in enumerate(measured):
        x[k, r["words"]] = 1
        x[k, len(selected) :] = r["shape"]
    y = np.array([[r[n] for n in names] for r in measured])
    return index, fit_chain(x, y, np.array([r["fold"] for r in measured]))


_memos: dict[int, _Words] = {}


def _predictor(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, categories: dict[str, Column], sample: int):
    """Texts -> probabilities of all categories for each, from what the labelled rows teach."""
    ship(docs.sparkSession)
    index, chain = teach(docs, labels, id_col, text_col, categories, sample)
    model = zlib.crc32(repr(sorted(index)).encode() + b"".join(w.tobytes() for w in chain))
    n = len(categories)

    def predict(texts: list) -> np.ndarray:
        if not chain or not texts:
            return np.zeros((len(texts), n))
        vocab.only("toxicity", _memos.clear)
        if model not in _memos:
            _memos.clear()
            _memos[model] = _Words(index)
        x = np.zeros((len(texts), len(index) + SHAPES))
        for k, text in enumerate(texts):
            found, form = features(text or b"", _memos[model])
            x[k, found] = 1
            x[k, len(index) :] = form
        return run_chain(chain, x)

    return predict


def _categories(categories: dict[str, Column] | None) -> dict[str, Column]:
    return categories or {"low_quality": 1 - F.col("quality"), "toxic": F.col("toxic")}


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", categories: dict[str, Column] | None = None, threshold: float = THRESHOLD, sample: int = SAMPLE) -> DataFrame:
    """(id, p_<category>..., is_<last category>): probabilities along the chain, and the decision on its last category."""
    categories = _categories(categories)
    names = list(categories)
    predict = _predictor(docs, labels, id_col, text_col, categories, sample)
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        for batch in vocab.sliced(batches, 1):
            p = predict(batch.column(1).cast(pa.large_binary()).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(p[:, c]) for c in range(len(names))], pa.array(p[:, -1] >= threshold, pa.bool_())], names=[id_col, *[f"p_{n}" for n in names], f"is_{names[-1]}"])

    fields = ", ".join(f"p_{n} double" for n in names)
    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, {fields}, is_{names[-1]} boolean")


def drop_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", categories: dict[str, Column] | None = None, threshold: float = THRESHOLD, sample: int = SAMPLE) -> DataFrame:
    """The rows whose last category's probability is under the threshold, with all their columns, in one pass."""
    predict = _predictor(docs, labels, id_col, text_col, _categories(categories), sample)
    at = docs.columns.index(text_col)

    def run(batches):
        for batch in vocab.sliced(batches, at):
            p = predict(batch.column(at).cast(pa.large_binary()).to_pylist())
            yield batch.filter(pa.array(p[:, -1] < threshold, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)

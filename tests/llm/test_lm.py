"""LM scoring and language ID against brute force."""

import math
import tracemalloc
import unicodedata
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tessera.llm import language_id, lm_scoring, scratch, toxicity, vocab


def fold(i):
    return zlib.crc32(b"" if i is None else str(i).encode()) % 10


def tokens(t):
    return (t or "").encode().lower().split() + [None]


def test_scores_equal_brute_force(edge, edge_rows, monkeypatch):
    kept = []
    learn = lm_scoring.learn_weights
    monkeypatch.setattr(lm_scoring, "learn_weights", lambda *a: kept.append(learn(*a)) or kept[-1])
    got = sorted(map(tuple, lm_scoring.score_texts(edge).collect()), key=repr)
    weights = kept[0]
    assert np.allclose(weights.sum(1), 1) and (weights >= 0).all()
    train = [tokens(t) for i, t in edge_rows if fold(i)]
    one = Counter(w for s in train for w in s)
    two = Counter(p for s in train for p in zip(["<s>", *s], s))
    n, v = sum(one.values()), len(one)
    want = []
    for i, t in edge_rows:
        s, base, score = tokens(t), 0.0, 0.0
        for h, w in zip(["<s>", *s], s):
            c = len(train) if h == "<s>" else one[h]
            b = 0 if c == 0 else min(lm_scoring.BUCKETS - 1, int(math.log2(c)) + 1)
            p = weights[b]
            score += math.log10(p[0] * two[h, w] / max(1, c) + p[1] * one[w] / n + p[2] / (v + 1))
            base += math.log10((one[w] + 0.1) / (n + 0.1 * (v + 1)))
        want.append((i, fold(i) == 0, len(s), sum(one[w] > 0 for w in s), n, base, score))
    want.sort(key=repr)
    for a, b in zip(sorted(got, key=lambda r: repr(r[:5])), sorted(want, key=lambda r: repr(r[:5]))):
        assert a[:5] == b[:5] and a[5] == pytest.approx(b[5]) and a[6] == pytest.approx(b[6])


def test_em_prefers_what_predicts():
    rows = [(3, 8, 80, 500), (3, -1, 60, 20), (0, -1, 40, 50)]
    w = lm_scoring.learn_weights(rows, 1000, 500)
    assert w[3][0] > 0.8 and w[0][0] == 0 and np.allclose(w.sum(1), 1)
    assert (lm_scoring.learn_weights([], 0, 0)[5] == (0, 0, 1)).all()


def test_no_texts(nothing, spark):
    assert lm_scoring.score_texts(nothing).count() == 0
    held = [i for i in range(200) if fold(i) == 0][:2]
    df = spark.createDataFrame([(held[0], "a b"), (held[1], None)], "doc_id long, text string")
    rows = {r.doc_id: r for r in lm_scoring.score_texts(df).collect()}
    assert rows[held[0]].n_tokens == 3 and rows[held[0]].train_tokens == 0 and rows[held[0]].score == 0


def brute(word, p, pieces):
    """Sum over all segmentations, by recursion."""

    def rest(i):
        if i == len(word):
            return 1.0
        total = 0.0
        for j in range(i + 1, len(word) + 1):
            k = pieces.get(word[i:j] if i else "▁" + word[:j])
            if k is not None:
                total += p[k] * rest(j)
            elif j == i + 1:
                total += p[len(pieces)] * rest(j)
        return total

    return rest(0)


def test_forward_sums_all_segmentations():
    pieces = {"▁a": 0, "▁ab": 1, "b": 2, "bc": 3, "c": 4, "▁abc": 5}
    p = np.array([0.2, 0.1, 0.3, 0.15, 0.2, 0.05, 1e-3])
    words = ["abc", "a", "abcb", "zzb", "bca"]
    lattice = language_id.Lattice(words, pieces, 4)
    assert np.exp(lattice.log_probability(p)) == pytest.approx([brute(w, p, pieces) for w in words])
    counts = lattice.expected(p, np.ones(len(words)))
    # Every word's pieces cover it once in expectation.
    sizes = np.array([1, 2, 1, 2, 1, 3, 1])
    assert counts @ sizes == pytest.approx(sum(map(len, words)))


def test_long_words():
    """Words of any length are scored whole, in range, and teach as the lattice does."""
    pieces = {"▁a": 0, "▁ab": 1, "b": 2, "bc": 3, "c": 4, "▁abc": 5}
    p = np.array([0.2, 0.1, 0.3, 0.15, 0.2, 0.05, 1e-3])
    for word in ["abc", "a", "abcb", "zzb", "bca", "abcbcbcabcbbbcc"]:
        assert np.exp(language_id.long_word(word, p[:, None], pieces, 4)[0]) == pytest.approx(brute(word, p, pieces))
        assert language_id.long_expected(word, p, pieces, 4) == pytest.approx(language_id.Lattice([word], pieces, 4).expected(p, np.ones(1)))
    assert language_id.long_word("z" * 3000, p[:, None], pieces, 4)[0] == pytest.approx(3000 * math.log(1e-3))
    both = language_id._Scorer(pieces, np.stack([p, p[::-1]], 1))
    words = ["abc" * 30, "abc", "zb" * 21]  # on both sides of the bound
    sums = language_id._sums([" ".join(words).encode()], both)[0]
    assert sums[0] == pytest.approx(sum(language_id.long_word(w, p[:, None], pieces, 4)[0] for w in words)) and sums[2] == 3


def test_letters():
    assert language_id.words_of("½ ② Ⅷ 12 _ !".encode()) == []
    assert language_id.words_of("ÉTÉ a1b 日本".encode()) == ["été", "a", "b", "日本"]


def test_languages_by_definition(spark, sf_dir, monkeypatch):
    """Every prediction of the query equals a plain scorer's: products of word sums, one segmentation step at a time."""
    from tessera.llm import queries, vocab

    taught = []
    teach = language_id.teach
    monkeypatch.setattr(language_id, "teach", lambda *a: taught.append(teach(*a)) or taught[-1])
    got = {r.doc_id: r for r in queries.QUERIES["op9_language_id"](spark, sf_dir).collect()}
    languages, table = taught[0]
    pieces = language_id.piece_ids(vocab.vocabulary_path("piece_bpe_32k.model"))
    longest, logs, known = max(map(len, pieces)), np.log(table), {}

    def word(w):
        ends = [np.zeros(len(languages))]
        for j in range(1, len(w) + 1):
            parts = []
            for i in range(max(0, j - longest), j):
                k = pieces.get(w[i:j] if i else "▁" + w[:j], len(pieces) if i == j - 1 else None)
                if k is not None:
                    parts.append(ends[i] + logs[k])
            ends.append(np.logaddexp.reduce(parts))
        return ends[-1]

    for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect():
        letters = "".join(c if unicodedata.category(c)[0] == "L" else " " for c in (r.text or "").lower())
        total = np.zeros(len(languages))
        for w in letters.split():
            if w not in known:
                known[w] = word(w)
            total = total + known[w]
        assert got[r.doc_id].held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        if not letters.split():
            assert (got[r.doc_id].lang_pred, got[r.doc_id].score) == ("und", 0)
            continue
        share = np.exp(total - np.logaddexp.reduce(total))
        assert got[r.doc_id].score == pytest.approx(share.max(), rel=1e-6)
        assert got[r.doc_id].lang_pred == languages[int(share.argmax())] or np.sort(share)[-2] == pytest.approx(share.max())


def test_weights_by_plain_em():
    """The buckets' weights equal expectation-maximisation over single tokens, but for the rounding of estimates."""
    rng = np.random.default_rng(2)
    rows = [(int(b), int(rng.integers(-1, 40)), int(rng.integers(0, 60)), int(rng.integers(1, 9))) for b in rng.integers(0, 4, 60)]
    got = lm_scoring.learn_weights(rows, 1000, 500)
    single = [(b, 0.0 if two < 0 else 2 ** (-two / lm_scoring.STEPS), 2 ** (-one / lm_scoring.STEPS), 1 / 501) for b, two, one, n in rows for _ in range(n)]
    w = np.full((lm_scoring.BUCKETS, 3), 1 / 3)
    w[0] = 0, 0.5, 0.5
    for _ in range(40):
        mass = np.zeros_like(w)
        for b, *p in single:
            part = w[b] * p
            mass[b] += part / part.sum()
        mean = mass.sum(0) / mass.sum()
        for b in range(len(w)):
            mass[b] += 5 * (np.array([0, mean[1], mean[0] + mean[2]]) if b == 0 else mean)
        w = mass / mass.sum(1, keepdims=True)
    assert got[:4] == pytest.approx(w[:4], rel=1e-4)


def test_languages(spark, sf_dir, edge, nothing):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = language_id.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out")
    assert got.filter("lang = lang_pred").count() >= 0.97 * got.count()
    assert got.filter("score < 0 or score > 1").count() == 0
    rows = {r.doc_id: r for r in language_id.identify(edge).collect()}
    for i in (4, 5, 6, 14):
        assert rows[i].lang_pred == "und" and rows[i].score == 0
    assert rows[1].lang_pred == "en"
    assert language_id.identify(nothing).count() == 0
    kept = {r.doc_id for r in language_id.keep_identified(edge).collect()}
    assert kept.isdisjoint({4, 5, 6, 14}) and {1, 2, 3, 7, 10, None} <= kept
    unlabelled = edge.drop("lang").selectExpr("*", "cast(null as string) as lang")
    assert {r.lang_pred for r in language_id.identify(unlabelled).collect()} == {"und"}


def test_blocks_are_read_in_slices(monkeypatch):
    rng = np.random.default_rng(5)
    n, docs, kinds = 400_000, 800, 20_000
    words = rng.integers(0, 1 << 63, kinds, dtype=np.uint64)
    items = (kinds * rng.random(n) ** 3).astype(np.uint32)
    sizes = np.full(docs, n // docs, np.uint32)
    folds = (np.arange(docs) % 10).astype(np.uint8)

    def opened():
        return lm_scoring.Block(folds.tobytes(), sizes.tobytes(), lm_scoring._pack(items), words.tobytes())

    block, given = opened(), []
    for kind, grams in enumerate((block.unigrams, block.bigrams)):
        keys, place = grams()
        count = lm_scoring._pack(np.bincount(place, minlength=len(keys)).astype(np.uint32))
        given.append({"kind": kind, "range": 0, "retained": count, "train": count})
    one = np.bincount(items)
    text = items.reshape(docs, -1).astype(np.int64)
    key = np.concatenate([np.full((docs, 1), kinds), text[:, :-1]], 1) * kinds + text
    _, place, two = np.unique(key, return_inverse=True, return_counts=True)
    context = np.concatenate([np.full((docs, 1), docs), one[text[:, :-1]]], 1)
    want = np.stack([one[items], context.ravel(), two[place].ravel()])
    monkeypatch.setattr(lm_scoring, "SLICE_TOKENS", 7_001)
    for at in (None, np.flatnonzero(block.token_folds() == 1)):
        parts = list(lm_scoring._estimates(opened(), list(given), True, at, docs))
        assert [p[0] for p in parts] == list(range(0, n if at is None else len(at), 7_001))
        assert (np.concatenate([np.stack(p[1:]) for p in parts], 1) == (want if at is None else want[:, at])).all()
    block = opened()
    tracemalloc.start()
    for _ in lm_scoring._estimates(block, list(given), True, None, docs):
        pass
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 48 * n  # bytes; whole columns of estimates took more


def test_one_row_a_batch(spark):
    def sizes(batches):
        import pyarrow as pa

        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], names=["n"])

    def run():
        return [r.n for r in spark.range(0, 6, 1, 2).mapInArrow(sizes, "n long").collect()]

    with scratch.one_a_batch(spark):
        assert run() == [1] * 6
    assert run() == [3, 3]


def test_language_memo_keeps_what_recurs(monkeypatch):
    pieces = {"▁a": 0, "b": 1, "bc": 2, "c": 3, "▁ab": 4}
    table = np.random.default_rng(1).dirichlet(np.ones(6), 2).T
    texts = [b"abc " + b" ".join(b"%s%s" % (b"a" * (k % 7 + 1), b"bc" * (k % 5 + j)) for j in range(9)) + b" abc" for k in range(60)]
    want = language_id._sums(texts, language_id._Scorer(pieces, table))
    monkeypatch.setattr(language_id, "MEMO_ENTRIES", 40)
    monkeypatch.setattr(language_id, "LATTICE_WORDS", 7)
    scorer = language_id._Scorer(pieces, table)
    got = np.concatenate([language_id._sums(texts[i : i + 2], scorer) for i in range(0, 60, 2)])
    assert np.allclose(got, want, rtol=1e-12)
    assert len(scorer) < 40 + 2 * 11 and b"abc" in scorer
    assert len(scorer.rows()) == len(scorer) == len(scorer.chunk_uses)


def test_one_operator_remembers_at_a_time(monkeypatch):
    monkeypatch.setattr(vocab, "_holders", {})
    a, b = {1: 2}, {3: 4}
    vocab.only("a", a.clear)
    vocab.only("a", a.clear)
    assert a
    vocab.only("b", b.clear)
    assert not a and b


def test_slices_hold_all_rows():
    texts = ["x" * 50, None, "é" * 500, "", *["y" * 30] * 200]
    batch = pa.RecordBatch.from_pydict({"i": list(range(len(texts))), "t": texts})
    parts = list(vocab.slices(batch, 1, 1000))
    assert [i for p in parts for i in p.column(0).to_pylist()] == list(range(len(texts)))
    assert len(parts) > 10 and all(sum(len((t or "").encode()) for t in p.column(1).to_pylist()[1:]) <= 1000 for p in parts)
    assert list(vocab.slices(batch.slice(0, 0), 1)) == []


def test_toxicity_memo_is_bounded():
    memo = toxicity._Words({"bad": 0}, entries=10)
    for k in range(200):
        assert memo[b"w%d" % k] == () and memo[b"bad"] == (0,)
        assert len(memo) <= 10 and len(memo.old) <= 10

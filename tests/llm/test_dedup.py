"""Line dedup, the n-gram Jaccard join and NN-descent against brute force."""

import random

import numpy as np
import pytest

from tessera.llm import graph, line_dedup, ngram_join, nn_descent, queries
from tessera.llm.scratch import Scratch


def tag(i):
    return "" if i is None else i


# Lines.


def test_lines_oracle(spark, sf_dir, duck, same_rows):
    assert same_rows(queries.QUERIES["op5_line_dedup"](spark, sf_dir).toPandas(), duck.sql(queries.ORACLES["op5_line_dedup"]).df())


def test_line_edges(edge, edge_rows, nothing, passage):
    rows = line_dedup.dedup_lines(edge).collect()
    assert len(rows) == len(edge_rows) and set(edge.columns) <= set(rows[0].asDict())
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, []).append(r)
    # A null id sorts first, so its copy of the passage stays and the others go.
    assert by[None][0].text == passage(1) and by[1][0].text == "" and by[2][0].text == ""
    assert by[3][0].text == passage(1) + " tail"  # another line
    assert by[4][0].text is None and by[5][0].text == "" and by[6][0].text == "   \n\t \n"
    assert by[10][0].lines_removed == 0
    assert by[11][0].text == "other start" and by[11][0].runs_removed == 1 and by[11][0].lines_removed == 4  # adjoining runs are one stretch
    assert [r.text for r in by[13]] == ["two words"] * 2  # short lines are no runs
    assert line_dedup.dedup_lines(nothing).count() == 0


def test_guarantee(spark):
    """Every run of at least the guarantee that an earlier place has is found, wherever it stands."""
    rng = random.Random(4)
    line = lambda n: " ".join(f"w{rng.randrange(10**6)}" for _ in range(n))
    docs, planted = [], {}
    for k in range(40):
        run = [line(rng.choice([3, 8, 20, 55])) for _ in range(rng.randint(1, 9))]
        words = sum(len(x.split()) for x in run)
        a = [line(30)] + run + [line(30)]
        b = [line(7) for _ in range(rng.randint(0, 3))] + run + [line(9)]
        docs += [(2 * k, "\n".join(a)), (2 * k + 1, "\n".join(b))]
        planted[2 * k + 1] = (run, words, len(b) - len(run))
    got = {r.doc_id: r for r in line_dedup.dedup_lines(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    for i, (run, words, others) in planted.items():
        left = got[i].text.split("\n")
        if words >= line_dedup.GUARANTEE_WORDS:
            assert not set(run) & set(left) and len(left) == others
        else:
            assert got[i].lines_removed == 0
        assert got[i - 1].lines_removed == 0


def brute_lines(rows, key, guarantee=line_dedup.GUARANTEE_WORDS):
    """(id, text) -> what stays, by the definition: lines of runs that stand at an earlier place go."""
    docs = sorted(set(rows), key=lambda d: (d[0] is not None, d[0] or 0, key[d[1]]))
    lines = {d: [x.strip(" ") for x in d[1].split("\n")] for d in docs}
    first, runs = {}, {}
    for d in docs:
        at = [k for k, x in enumerate(lines[d]) if x]
        size = [len(lines[d][k].split(" ")) for k in at]
        runs[d] = [(a, b, tuple(lines[d][k] for k in at[a : b + 1])) for a in range(len(at)) for b in range(a, len(at)) if sum(size[a : b + 1]) >= guarantee]
        for a, _, run in runs[d]:
            first.setdefault(run, (d, a))
    out = {}
    for d in docs:
        at = [k for k, x in enumerate(lines[d]) if x]
        gone = sorted({k for a, b, run in runs[d] if first[run] != (d, a) for k in range(a, b + 1)})
        cut = set()
        for k in gone:
            cut |= set(range(at[k], at[k] + 1)) | (set(range(at[k - 1], at[k])) if k - 1 in gone else set())
        out[d] = "\n".join(x for k, x in enumerate(d[1].split("\n")) if k not in cut) if gone else d[1]
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_lines_brute_force(spark, seed):
    """Many documents out of few lines, ids that repeat over different texts, null ids, blank lines."""
    rng = random.Random(seed)
    bank = [" ".join(f"w{k}x{j}" for j in range(rng.choice([1, 3, 8, 20, 30, 55]))) for k in range(12)] + ["", "  "]
    rows = [(rng.choice([None, *range(20)]), "\n".join(rng.choice(bank) for _ in range(rng.randint(1, 9)))) for _ in range(70)]
    rows += rows[:5]
    df = spark.createDataFrame([(i, t, t) for i, t in rows], "doc_id long, text string, was string")
    key = {r.was: r.k for r in df.selectExpr("was", "xxhash64(was) AS k").distinct().collect()}
    want = brute_lines(rows, key)
    for parts in (1, 5):
        got = line_dedup.dedup_lines(df.repartition(parts)).collect()
        assert len(got) == len(rows) and all(r.text == want[r.doc_id, r.was] for r in got)
    assert sum(r.lines_removed for r in got) > 20


def test_no_stitched_runs(spark):
    """Lines that occur earlier pair by pair, but not as one run, stay."""
    a, b, c = (" ".join(f"{x}{k}" for k in range(20)) for x in "abc")
    df = spark.createDataFrame([(1, f"{a}\n{b}"), (2, f"{b}\n{c}"), (3, f"{a}\n{b}\n{c}")], "doc_id long, text string")
    assert [r.lines_removed for r in line_dedup.dedup_lines(df).collect()] == [0, 0, 0]


def test_ids_with_several_texts(spark, passage):
    p, u = passage(1), passage(5)
    df = spark.createDataFrame([(1, p), (2, u), (2, p), (None, u + " more")], "doc_id long, text string")
    got = sorted((r.doc_id or 0, r.text) for r in line_dedup.dedup_lines(df).collect())
    assert got == sorted([(1, p), (2, u), (2, ""), (0, u + " more")])


def test_clashing_columns(spark, passage):
    names = ["lines_total", "lines_removed", "runs_removed", "row", "id", "text_key", "cuts", "lines", "kept", "group", "name", "a.b"]
    schema = "doc_id long, text string, " + ", ".join(f"`{n}` string" for n in names)
    df = spark.createDataFrame([(i, passage(1), *[f"mine {n}" for n in names]) for i in (1, 2)], schema)
    out = line_dedup.dedup_lines(df)
    assert out.columns == [*df.columns, "lines_total_", "lines_removed_", "runs_removed_"]
    for frame in (out, line_dedup.drop_repeated_runs(df), ngram_join.keep_representatives(df)):
        assert all(r[n] == f"mine {n}" for r in frame.collect() for n in names)
    assert [r.lines_removed_ for r in out.orderBy("doc_id").collect()] == [0, 1]
    assert sorted(map(tuple, nn_descent.near_duplicates(spark.createDataFrame([(1, [1.0], 1, 7, 8)], "vec_id int, embedding array<double>, label int, id int, component int")).collect())) == [(1, 0, 1, True, 1.0)]


def test_lines_stay_native(spark, edge):
    plan = line_dedup.dedup_lines(edge)._jdf.queryExecution().executedPlan().toString()
    assert not any(k in plan for k in ("Python", "Pandas", "Arrow", "CartesianProduct", "NestedLoop"))


# N-grams.


def brute_components(docs, shingle, num, den):
    """Sizes and component of each row, by its place in ``docs``; a component's name is its least id."""
    sets = []
    for _, t in docs:
        w = (t or "").encode().lower().split()
        sets.append(frozenset(tuple(w[k : k + shingle]) for k in range(max(1, len(w) - shingle + 1))) if w else frozenset())
    root = list(range(len(docs)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, x in enumerate(sets):
        for b in range(a):
            if x and sets[b] and den * len(x & sets[b]) >= num * len(x | sets[b]):
                root[top(a)] = top(b)
    named = {}
    for k, (i, _) in enumerate(docs):
        if i is not None:
            named[top(k)] = min(i, named.get(top(k), i))
    return [len(x) for x in sets], [named.get(top(k)) if x else docs[k][0] for k, x in enumerate(sets)]


def joined(df, **options):
    """The rows' (id, size, component), sorted."""
    return sorted(map(tuple, ngram_join.jaccard_components(df, **options).collect()), key=repr)


def wanted(docs, shingle, num, den):
    sizes, roots = brute_components(docs, shingle, num, den)
    return sorted(((i, n, c) for (i, _), n, c in zip(docs, sizes, roots)), key=repr)


@pytest.mark.parametrize("shingle,num,den", [(3, 90, 100), (5, 80, 100)])
def test_join_brute_force(spark, shingle, num, den):
    rng = random.Random(shingle)
    docs, i = [], 0
    for size in [1, 2, 3, 9, 10, 11, 12, 19, 20, 21, 40, 77, 150, 400]:
        base = [f"w{rng.randrange(3000)}" for _ in range(size)]
        for _ in range(rng.choice([3, 9])):
            words = list(base)
            for _ in range(rng.randrange(0, 2 + size // 12)):
                k = rng.randrange(len(words) + 1)
                words[k : k + rng.randint(0, 1)] = [f"n{rng.randrange(9)}"] * rng.randint(0, 2)
            docs.append((i, " ".join(words)))
            i += 1
    common = " ".join(f"c{k}" for k in range(30))  # a passage in many texts links nobody
    docs += [(i + k, common + " " + " ".join(f"u{k}x{j}" for j in range(60))) for k in range(30)]
    want = wanted(docs, shingle, num, den)
    assert joined(spark.createDataFrame(docs, "doc_id long, text string"), shingle=shingle, num=num, den=den) == want
    assert len({c for _, _, c in want}) < len(want) - 20


def test_join_repeated_ids(spark):
    """One id over different texts, and null ids: rows link by their texts, in any partitioning."""
    rng = random.Random(7)
    bases = [[f"b{k}w{j}" for j in range(60)] for k in range(8)]
    docs = []
    for _ in range(60):
        words = list(rng.choice(bases))
        if rng.random() < 0.5:
            words[rng.choice([0, 59])] = "other"
        docs.append((rng.choice([None, *range(9)]), " ".join(words)))
    docs += [(3, ""), (3, None), (None, "")]
    want = wanted(docs, 3, 90, 100)
    kept = None
    for parts in (1, 4):
        df = spark.createDataFrame(docs, "doc_id long, text string").repartition(parts)
        assert joined(df) == want
        rows = sorted(((r.doc_id, r.text) for r in ngram_join.keep_representatives(df).collect()), key=repr)
        assert kept is None or rows == kept
        kept = rows
    # One of each component, and all the empty ones.
    sizes, roots = brute_components(docs, 3, 90, 100)
    full = [(t, c) for (_, t), n, c in zip(docs, sizes, roots) if n]
    groups = {frozenset(u for u, d in full if d == c) for _, c in full}
    assert [t or "" for _, t in kept].count("") == 3 and len(kept) >= 3 + len(groups)
    assert len({(i, t) for i, t in kept if t}) == sum(1 for _, t in kept if t)


def test_join_open_group(spark):
    """Many texts that share column blocks but mostly don't link: the tiles decide."""
    rng = random.Random(9)
    base = [f"w{k}" for k in range(120)]
    docs = []
    for i in range(300):
        words = list(base)
        for k in rng.sample(range(120), 4):
            words[k] = f"x{i}y{k}"
        docs.append((i, " ".join(words)))
    docs += [(300, " ".join(base)), (301, " ".join(base[:118]))]
    assert joined(spark.createDataFrame(docs, "doc_id long, text string")) == wanted(docs, 3, 90, 100)


def test_join_edges(edge, edge_rows, nothing):
    rows = ngram_join.jaccard_components(edge).collect()
    assert len(rows) == len(edge_rows)
    by = {r.doc_id: r for r in rows if r.doc_id is not None}
    assert [by[i].component_id for i in (1, 2, 3)] == [1, 1, 1]
    assert [(by[i].n_shingles, by[i].component_id) for i in (4, 5, 6)] == [(0, 4), (0, 5), (0, 6)]
    assert by[7].n_shingles == 1 and by[12].component_id == by[13].component_id == 12 and by[12].n_shingles == 1
    assert ngram_join.jaccard_components(nothing).count() == 0
    kept = ngram_join.keep_representatives(edge)
    assert sorted(tag(r.doc_id) for r in kept.filter("doc_id is not null").collect()) == [1, 4, 5, 6, 7, 8, 9, 10, 11, 12, 14]
    assert kept.columns == edge.columns and kept.filter("doc_id is null").count() == 0


def test_bands_guarantee():
    """Rows within the bound always share a column block of a common band, empty blocks included."""
    rng = np.random.default_rng(3)
    for num, den in ((90, 100), (80, 100)):
        bands = ngram_join.Bands(num, den)
        for _ in range(400):
            n = int(rng.choice([2, 4, 9, 10, 13, 19, 25, 60, 200]))
            row = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2))
            most = 2 * len(row) * (den - num) // (den + num)
            gone = int(rng.integers(0, most + 1))
            other = np.unique(np.concatenate([rng.permutation(row)[: len(row) - gone // 2], rng.integers(0, 1 << 63, gone - gone // 2, dtype=np.uint64)]))
            inter = len(np.intersect1d(row, other))
            if den * inter >= num * (len(row) + len(other) - inter) and len(row) != inter:
                assert set(bands.signatures(row).tolist()) & set(bands.signatures(other).tolist())
                assert ngram_join.may_link([ngram_join.sketch(row)], [ngram_join.sketch(other)], num, den)[0, 0]
                for share in (0.2, 0.8, 1.0):  # whichever columns count as frequent
                    every = np.union1d(row, other)
                    frequent = np.sort(rng.permutation(every)[: int(share * len(every))])
                    assert set(bands.signatures(row, frequent).tolist()) & set(bands.signatures(other, frequent).tolist())


def test_components(spark):
    rng = random.Random(1)
    links = [(i, i + 1) for i in range(60)] + [(100, 140), (120, 140), (100, 100)] + [(200, rng.randrange(201, 260)) for _ in range(60)]
    scratch = Scratch(spark, "test")
    got = {r.node: r.component for r in graph.components(spark.createDataFrame(links, "a long, b long"), scratch, "t").collect()}
    assert all(got[i] == 0 for i in range(61)) and got[120] == got[140] == 100
    assert {got[n] for n in got if n >= 200} == {200}
    assert graph.components(spark.createDataFrame([], "a long, b long"), scratch, "u").count() == 0


# Embeddings.


def test_vectors_brute_force(spark):
    rng = np.random.default_rng(2)
    rows, i = [], 0
    for group in [1] * 150 + [2, 3, 5, 12, 30, 120]:
        centre = rng.normal(size=16)
        for _ in range(group):
            rows.append((i, (centre + 0.05 * rng.normal(size=16)).tolist(), int(group > 3)))
            i += 1
    near = [rows[-1][1]] * 40  # exact copies
    rows += [(i + k, v, 1) for k, v in enumerate(near)]
    i += 40
    x = [1.0] + [0.0] * 15
    y = [0.93, (1 - 0.93**2) ** 0.5] + [0.0] * 14
    rows += [(i, x, 5), (i + 1, y, 5), (i + 2, [0.9299, (1 - 0.9299**2) ** 0.5] + [0.0] * 14, 6), (i + 3, x, 6)]
    n = len(rows)
    got = {r.vec_id: r for r in nn_descent.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()}
    v = np.array([r[1] for r in rows])
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    label = np.array([r[2] for r in rows])
    hit = (v @ v.T >= 0.93) & (label[:, None] == label[None, :])
    np.fill_diagonal(hit, False)
    comp = np.arange(n)
    while True:
        new = np.array([min(comp[k], comp[hit[k]].min(initial=comp[k])) for k in range(n)])
        if (new == comp).all():
            break
        comp = new
    assert [got[k].n_links for k in range(n)] == hit.sum(1).tolist()
    assert [got[k].component_id for k in range(n)] == comp.tolist()
    assert all(got[k].kept == (comp[k] == k) for k in range(n))
    assert got[i].n_links == 1 and got[i + 2].n_links == 0 and got[0].audit_recall == 1


def test_vector_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (3, [1.0, 0.0], None), (4, None, 1), (5, [0.0, 0.0], 1), (6, [nan, 1.0], 1), (7, [inf, 1.0], 1), (8, [None, 1.0], 1), (9, [1.0, 0.0, 0.0], 1), (10, [], 1), (None, [1.0, 0.0], 1), (11, [1.0, 0.0], 1), (11, [1.0, 0.0], 1), (12, [1e300, 0.0], 1)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<double>, label int, n_links string")
    got = nn_descent.near_duplicates(df).collect()
    assert len(got) == len(rows)
    by = {r.vec_id: r for r in got}
    assert all(by[i].n_links == 0 and by[i].kept for i in (3, 4, 5, 6, 7, 8, 9, 10))
    assert by[2].component_id == by[11].component_id == by[12].component_id == 1
    assert by[1].n_links == 5 and by[2].n_links == 5
    assert by[None].n_links == 5 and by[None].component_id == 1 and not by[None].kept
    assert nn_descent.near_duplicates(df.limit(0)).count() == 0


@pytest.mark.parametrize("kind", ["smallint", "string"])
def test_vectors_repeated_ids(spark, kind):
    """One id over different vectors, null ids, ids of any type: rows link by their vectors."""
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(5, 8))
    rows = []
    for k in range(60):
        i = [None, *range(12)][int(rng.integers(13))]
        v = centres[rng.integers(5)] + 0.08 * rng.normal(size=8) * int(rng.integers(2))
        rows.append((i, v.tolist(), int(rng.integers(2))))
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").selectExpr(f"cast(vec_id as {kind}) as vec_id", "embedding", "label")
    v = np.array([r[1] for r in rows])
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    label = np.array([r[2] for r in rows])
    hit = (v @ v.T >= 0.93) & (label[:, None] == label[None, :])
    np.fill_diagonal(hit, False)
    root = np.arange(len(rows))
    while True:
        new = np.array([min(root[k], root[hit[k]].min(initial=root[k])) for k in range(len(rows))])
        if (new == root).all():
            break
        root = new
    cast = (lambda i: i) if kind == "smallint" else (lambda i: None if i is None else str(i))
    ids = [cast(r[0]) for r in rows]
    name = {c: min((i for i, d in zip(ids, root) if d == c and i is not None), default=None) for c in root}
    want = sorted(((i, int(n), name[c], i == name[c], 1.0) for i, n, c in zip(ids, hit.sum(1), root)), key=repr)
    for parts in (1, 4):
        assert sorted(map(tuple, nn_descent.near_duplicates(df.repartition(parts)).collect()), key=repr) == want


def test_crowded_label(spark):
    """Vectors that share a direction crowd the trees' leaves, and few pairs among them link: every pair is found still."""
    rng = np.random.default_rng(0)
    base = np.r_[2.0, np.zeros(63)] + np.c_[np.zeros(3000), rng.normal(size=(3000, 63)) / 63**0.5]
    near = base[:5] + 0.35 * np.linalg.norm(base[:5], axis=1, keepdims=True) * rng.normal(size=(5, 64)) / 8
    v = np.r_[base, near]
    got = nn_descent.near_duplicates(spark.createDataFrame([(k, x.tolist(), 1) for k, x in enumerate(v)], "vec_id long, embedding array<double>, label int")).collect()
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    hit = v @ v.T >= 0.93
    np.fill_diagonal(hit, False)
    assert hit.sum() == 10
    assert {r.vec_id: r.n_links for r in got} == dict(enumerate(hit.sum(1).tolist()))

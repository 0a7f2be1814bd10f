"""The classifier chain and the corpus pipeline."""

import math
import re
import string

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tessera.llm import queries, toxicity


def test_toxicity_held_out(spark, sf_dir):
    docs, labels = spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    seen = F.pmod(F.xxhash64("doc_id"), F.lit(10)) < 7
    got = toxicity.classify(docs, labels.filter(seen)).join(labels.filter(~seen), "doc_id")
    clean, toxic = got.filter("toxic = 0"), got.filter("toxic = 1 and quality = 1")
    assert clean.filter("is_toxic").count() <= 0.02 * clean.count()
    assert toxic.filter("is_toxic").count() >= 0.6 * toxic.count()
    assert got.filter("p_toxic < 0 or p_toxic > 1 or p_low_quality < 0 or p_low_quality > 1").count() == 0


def test_chain_feeds_earlier_probabilities():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(600, 3))
    first = (x[:, 0] + 0.2 * rng.normal(size=600) > 0).astype(float)
    second = ((first > 0) & (x[:, 1] > 0)).astype(float)
    chain = toxicity.fit_chain(x, np.stack([first, second], 1), np.arange(600) % 5)
    assert [len(w) for w in chain] == [4, 5] and chain[1][3] > 0.1
    p = toxicity.run_chain(chain, x)
    assert ((p[:, 0] > 0.5) == (first > 0)).mean() > 0.9 and ((p[:, 1] > 0.5) == (second > 0)).mean() > 0.85


def test_toxicity_edges(spark, edge, edge_rows, nothing):
    labels = spark.createDataFrame([(1, 1, 0), (2, 1, 1), (3, None, 1), (10, 0, 0), (99, 1, 1), (None, 1, 1)], "doc_id long, quality int, toxic int")
    got = toxicity.classify(edge, labels)
    assert got.count() == len(edge_rows) and got.columns == ["doc_id", "p_low_quality", "p_toxic", "is_toxic"]
    assert got.filter("p_toxic is null or isnan(p_toxic)").count() == 0
    none = toxicity.classify(edge, labels.limit(0))
    assert none.filter("is_toxic or p_toxic <> 0").count() == 0
    assert toxicity.classify(nothing, labels).count() == 0
    assert toxicity.drop_toxic(edge, labels.limit(0)).count() == len(edge_rows)


def test_toxicity_by_definition(spark, monkeypatch):
    """Every row of the query equals a plain evaluation of the taught chain over the whole text."""
    taught, sf_dir = [], "/root/testdata/sf0.01"  # the smallest one whose labels select words
    teach = toxicity.teach
    monkeypatch.setattr(toxicity, "teach", lambda *a: taught.append(teach(*a)) or taught[-1])
    got = {r.doc_id: r for r in queries.QUERIES["op6_toxicity_chain"](spark, sf_dir).collect()}
    index, chain = taught[0]
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    assert len(got) == len(docs) and index and len(chain) == 2
    for r in docs:
        text = r.text or ""
        chunks = text.encode().split()
        present = set()
        for w in (w for c in set(chunks) for w in re.findall(r"[^\W\d_]+", c.decode("utf-8", "replace").lower())):
            present |= {w, *("^" + w[:n] for n in (4, 5, 6, 7) if n < len(w))}
        x = [1.0 if w in present else 0.0 for w in index]
        raw = text.encode()
        n = max(1, len(raw))
        share = lambda marks: sum(raw.count(m.encode()) for m in marks) / n  # noqa: B023, E731
        x += [math.log1p(len(raw)) / 10, share(string.ascii_uppercase), share(string.digits), share("!?#*$%&=@<>|~^_{}[]\\"), len(set(chunks)) / max(1, len(chunks)), min(1.0, n / max(1, len(chunks)) / 20)]
        p = []
        for w in chain:
            z = sum(a * b for a, b in zip(w, x)) + w[-1]
            p.append(1 / (1 + math.exp(-min(30, max(-30, z)))))
            q = min(1 - 1e-4, max(1e-4, p[-1]))
            x.append(math.log(q / (1 - q)) / 4)
        assert (got[r.doc_id].p_low_quality, got[r.doc_id].p_toxic) == pytest.approx(tuple(p), rel=1e-9)
        assert got[r.doc_id].is_toxic == (got[r.doc_id].p_toxic >= 0.5)


def test_labels_of_repeated_rows(spark, edge):
    """However often a labelled id occurs, it teaches once."""
    labels = spark.createDataFrame([(13, 1, 0), (13, 1, 0), (1, 0, 1)], "doc_id long, quality int, toxic int")
    once = toxicity.classify(edge, labels).collect()
    again = toxicity.classify(edge.union(edge.filter("doc_id = 13")), labels).collect()
    assert len(again) == len(once) + 2 and {tuple(r) for r in once} == {tuple(r) for r in again}


def test_stages(spark, tmp_path):
    """Each stage by its definition on what the stage before kept; the learned ones agree with their operators' decisions."""
    from test_dedup import brute_components, brute_lines
    from tessera.llm import language_id

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    before = docs
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "language_id", "line_dedup", "ngram_join", "packing"]
    pairs = lambda df: sorted((r.doc_id, r.text) for r in df.select("doc_id", "text").collect())
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, sf)
        out.write.parquet(str(tmp_path / name))
        out = spark.read.parquet(str(tmp_path / name))
        if k < 4:
            assert out.columns == before.columns
        rows = pairs(docs)
        if name == "toxicity":
            gone = {r.doc_id for r in toxicity.classify(docs, spark.read.parquet(f"{sf}/labels.parquet")).filter("is_toxic").collect()}
            assert pairs(out) == [r for r in rows if r[0] not in gone]
        if name == "language_id":
            kept = {r.doc_id for r in language_id.identify(docs).filter("lang_pred <> 'und' and score >= 0.5").collect()}
            assert pairs(out) == [r for r in rows if r[0] in kept]
        if name == "line_dedup":
            want = brute_lines(rows, {r.text: r.k for r in docs.selectExpr("text", "xxhash64(text) AS k").collect()})
            assert pairs(out) == sorted((i, want[i, t]) for i, t in rows)
            changed = {i for i, t in rows if want[i, t] != t}
            assert out.filter("n_chars <> length(text)").filter(F.col("doc_id").isin(list(changed))).count() == 0 and changed
        if name == "ngram_join":
            _, roots = brute_components(rows, 5, 80, 100)
            assert pairs(out) == [r for r, c in zip(rows, roots) if r[0] == c]
        docs = out
    assert docs.groupBy("sequence_id").agg(F.sum("length").alias("n")).filter("n > 4096").count() == 0
    assert {r.doc_id for r in docs.collect()} == {i for i, _ in pairs(spark.read.parquet(str(tmp_path / "ngram_join")))}
    whole = corpus_pipeline.run(spark, sf)
    assert sorted(map(tuple, whole.select("doc_id", "start", "length", "ids_crc32").collect())) == sorted(map(tuple, docs.select("doc_id", "start", "length", "ids_crc32").collect()))


def test_pipeline_edges(spark, tmp_path, edge, edge_rows):
    """Null ids and texts, repeated rows, clashing columns; and nothing at all."""
    labels = spark.createDataFrame([(1, 1, 0), (10, 0, 0)], "doc_id long, quality int, toxic int")
    docs = edge.selectExpr("doc_id", "text", "'en' AS lang", "source", "cast(length(text) as bigint) AS n_chars", "block", "score", "'mine' AS lines_removed", "'mine' AS row")
    for name, some in (("full", docs), ("empty", docs.limit(0))):
        some.write.parquet(str(tmp_path / name / "documents.parquet"))
        labels.write.parquet(str(tmp_path / name / "labels.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path / "empty")).count() == 0
    at = spark.read.parquet(str(tmp_path / "full" / "documents.parquet"))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, at, str(tmp_path / "full"))
        assert out.columns == docs.columns and out.filter("lines_removed <> 'mine' or row <> 'mine'").count() == 0
        out.write.mode("overwrite").parquet(str(tmp_path / f"at{len(out.columns)}{stage.__name__}"))
        at = spark.read.parquet(str(tmp_path / f"at{len(out.columns)}{stage.__name__}"))
    left = [(r.doc_id, r.text) for r in at.collect()]
    assert sum(1 for _, t in left if t == "two words") == 1  # of three, one stays
    assert not {i for i, _ in left} & {4, 5, 6, 14}  # no letters, no language


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_oracles(name, spark, sf_dir, duck, same_rows):
    assert same_rows(queries.QUERIES[name](spark, sf_dir).toPandas(), duck.sql(queries.ORACLES[name]).df())


def test_registered():
    import __spark_entry__ as entry

    names = set(entry.queries())
    assert "pipeline" in names and {f"op{n}" for n in range(1, 11)} <= {n.split("_")[0] for n in names}


def test_stages_send_small_batches_unless_told(spark):
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name, None)
    try:
        spark.conf.unset(name)
        corpus_pipeline.small_batches(spark)
        assert spark.conf.get(name) == str(corpus_pipeline.BATCH_ROWS)
        spark.conf.set(name, "77")
        corpus_pipeline.small_batches(spark)
        assert spark.conf.get(name) == "77"
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)

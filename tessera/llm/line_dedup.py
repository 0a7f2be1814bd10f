"""Line dedup by winnowing over line hashes, in DataFrame operations only.

A document is the sequence of its non-blank lines. A *run* is a stretch of
whole lines of at least ``guarantee`` words; a line goes if it lies in a run
that also stands at an earlier place (order: doc id, hash of the text, line).
Both ends matter, so the runs that are looked up are the shortest ones from
each line forwards and from each line backwards: any longer repeated run is
made of them.

Winnowing finds them without comparing every run:

* a *gram* starts at a line and takes lines until it has ``noise`` words;
* of the grams that start within any ``guarantee - noise + 1`` words, the one
  with the least hash (rightmost at ties) is a *fingerprint*.

Equal runs select equal fingerprints at equal offsets, so only runs whose
fingerprint has another position in the corpus are candidates. A candidate is
joined with the first position of its own lines, which fixes one partner and
one alignment for the whole run; overlapping repeated runs are what extends a
match both ways. All lookups are "first position of a hash" (a combinable
minimum) joined back, so no group is ever collected or paired with itself,
however often a line repeats.

A passage that starts or ends inside a line is out of reach there, and one
inside a single line altogether.

Defined results: null text stays null; empty and blank lines are no lines to
match (blank lines inside a deleted stretch go with it); a document is a pair
of id and text, so rows that agree in both are one document and lose the same
lines, and rows of one id with different texts are different documents; a null
doc id is an id that sorts first; an empty table gives an empty table. Columns
of the input are never replaced, whatever their names. Lines and runs are
compared by 128 bits of hash, the texts of one id by 64.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .scratch import Scratch, added, named

NOISE_WORDS = 25
GUARANTEE_WORDS = 50


def _words(line: Column) -> Column:
    return F.length(line) - F.length(F.replace(line, F.lit(" "), F.lit(""))) + F.lit(1)


def _key(text: Column) -> Column:
    """What tells the texts of one id apart."""
    return F.xxhash64(text)


def line_runs(docs: DataFrame, id_col: str, text_col: str, noise: int, guarantee: int) -> DataFrame:
    """(doc, text_key, fp, fp_at, first, last, r1, r2): the shortest runs from and to each line.

    ``first`` and ``last`` are numbers of non-blank lines with their places in
    the text, ``r1`` and ``r2`` the hash of the run's lines, ``fp`` and
    ``fp_at`` the fingerprint that its first window selects.
    """
    text = named(docs, text_col)
    lines = F.transform(F.split(text, "\n"), lambda line, at: F.struct(at.alias("at"), F.trim(line).alias("line")))
    lines = F.transform(F.filter(lines, lambda x: x["line"] != ""), lambda x: F.struct(x["at"].alias("at"), F.xxhash64(x["line"]).alias("h1"), F.xxhash64(F.lit(1), x["line"]).alias("h2"), _words(x["line"]).alias("w")))
    doc = ["doc", "text_key"]
    # Rows of one id and text meet before the exchange, and the windows need no other one.
    rows = docs.filter(text.isNotNull()).select(named(docs, id_col).alias("doc"), _key(text).alias("text_key"), lines.alias("lines"))
    rows = rows.groupBy(*doc).agg(F.first("lines").alias("lines")).select(*doc, F.posexplode("lines").alias("n", "l")).select(*doc, "n", "l.*")
    by_line = Window.partitionBy(*doc).orderBy("n")
    rows = rows.withColumn("c", F.sum(F.col("w").cast("long")).over(by_line.rowsBetween(Window.unboundedPreceding, 0)) - F.col("w")).withColumn("e", F.col("c") + F.col("w"))
    by_word = Window.partitionBy(*doc).orderBy("c")
    gram, run = by_word.rangeBetween(0, noise - 1), by_word.rangeBetween(0, guarantee - 1)
    place, line = F.struct("n", "at"), F.struct("h1", "h2")
    rows = rows.withColumns(
        {
            "gram": F.when(F.sum("w").over(gram) >= noise, F.xxhash64(F.collect_list("h1").over(gram))),
            "forward": F.when(F.sum("w").over(run) >= guarantee, F.collect_list(line).over(run)),
            "last": F.max(place).over(run),
        }
    )
    least = F.min(F.when(F.col("gram").isNotNull(), F.struct("gram", (-F.col("n")).alias("neg")))).over(by_word.rangeBetween(0, guarantee - noise))
    rows = rows.withColumn("least", least)
    back = Window.partitionBy(*doc).orderBy("e").rangeBetween(1 - guarantee, 0)
    rows = rows.withColumns(
        {
            "backward": F.when(F.sum("w").over(back) >= guarantee, F.collect_list(line).over(back)),
            "back_first": F.min(place).over(back),
            "back_least": F.first("least").over(back),
            "back_last": F.first("last").over(back),
        }
    )
    one = lambda first, last, least, lines: F.struct(least["gram"].alias("fp"), (-least["neg"]).alias("fp_at"), first.alias("first"), last.alias("last"), F.xxhash64(lines).alias("r1"), F.xxhash64(F.lit(1), lines).alias("r2"))
    forward = F.when(F.col("forward").isNotNull(), one(place, F.col("last"), F.col("least"), F.col("forward")))
    # A backward run is news only where the forward one from its first line ends earlier.
    backward = F.when(F.col("backward").isNotNull() & (F.col("back_last.n") < F.col("n")), one(F.col("back_first"), place, F.col("back_least"), F.col("backward")))
    return rows.select(*doc, F.explode(F.array_compact(F.array(forward, backward))).alias("r")).select(*doc, "r.*")


def repeated_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", noise: int = NOISE_WORDS, guarantee: int = GUARANTEE_WORDS) -> DataFrame:
    """(doc, text_key, first, last): the stretches to delete, by 0-based line numbers."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "line-dedup")
    doc = ["doc", "text_key"]
    runs = scratch.put(line_runs(docs, id_col, text_col, noise, guarantee), "lines")
    # Minima and maxima are tables of their own, so that Spark can split a hot key's rows in the joins.
    at = F.struct(*doc, "fp_at")
    prints = runs.groupBy("fp").agg(F.min(at).alias("lo"), F.max(at).alias("hi")).filter(F.col("lo") < F.col("hi")).select("fp")
    prints = scratch.put(prints, "prints")
    candidates = scratch.put(runs.join(prints, "fp").select(*doc, "first", "last", "r1", "r2"), "candidates")
    at = F.struct(*doc, F.col("first.n").alias("n"))
    partner = candidates.groupBy("r1", "r2").agg(F.min(at).alias("partner"), F.max(at).alias("other")).filter(F.col("partner") < F.col("other")).drop("other")
    partner = scratch.put(partner, "partners")
    found = candidates.join(partner, ["r1", "r2"]).filter(at > F.col("partner")).select(*doc, "first", "last").distinct()
    # Overlapping or adjoining repeated runs are one stretch.
    by_first = Window.partitionBy(*doc).orderBy("first.n", "last.n")
    reach = F.max("last.n").over(by_first.rowsBetween(Window.unboundedPreceding, -1))
    found = found.withColumn("new", F.coalesce((F.col("first.n") > reach + 1).cast("int"), F.lit(1)))
    found = found.withColumn("stretch", F.sum("new").over(by_first.rowsBetween(Window.unboundedPreceding, 0)))
    stretches = found.groupBy(*doc, "stretch").agg(F.min("first").alias("first"), F.max("last").alias("last")).select(*doc, F.col("first.at").alias("first"), F.col("last.at").alias("last"))
    stretches = scratch.put(stretches, "stretches")
    scratch.keep("stretches")
    return stretches


def _cut(docs: DataFrame, id_col: str, text_col: str, noise: int, guarantee: int) -> DataFrame:
    """(row, text, lines_total, lines_removed, runs_removed); ``row`` holds the input's columns."""
    found = repeated_runs(docs, id_col, text_col, noise, guarantee)
    cuts = found.groupBy("doc", "text_key").agg(F.array_sort(F.collect_list(F.struct("first", "last"))).alias("cuts"))
    rows = docs.select(F.struct(*[named(docs, c) for c in docs.columns]).alias("row"), named(docs, id_col).alias("id"), named(docs, text_col).alias("text"))
    # The cuts grow with the input, so the plan is the one for large inputs at every size.
    kept = rows.join(cuts.hint("merge"), F.col("id").eqNullSafe(F.col("doc")) & (_key(F.col("text")) == F.col("text_key")), "left")
    n_cuts = F.size("cuts")
    # Slices between the cuts: linear in the lines, also for very long texts.
    start = lambda k: F.when(k == 0, F.lit(0)).otherwise(F.try_element_at("cuts", k)["last"] + 1)
    stop = lambda k: F.when(k == n_cuts, F.size("lines")).otherwise(F.try_element_at("cuts", k + 1)["first"])
    pieces = F.flatten(F.transform(F.sequence(F.lit(0), n_cuts), lambda k: F.slice("lines", start(k) + 1, stop(k) - start(k))))
    kept = kept.withColumn("lines", F.split("text", "\n"))
    has = F.col("cuts").isNotNull() & F.col("lines").isNotNull()
    kept = kept.withColumn("kept", F.when(has, pieces))
    return kept.select(
        "row",
        F.when(has, F.array_join("kept", "\n")).otherwise(F.col("text")).alias("text"),
        F.coalesce(F.when(F.col("lines").isNotNull(), F.size("lines")), F.lit(0)).cast("long").alias("lines_total"),
        F.when(has, F.size("lines") - F.size("kept")).otherwise(0).cast("long").alias("lines_removed"),
        F.when(has, n_cuts).otherwise(0).cast("long").alias("runs_removed"),
    )


def _back(docs: DataFrame, replaced: dict[str, Column]) -> list[Column]:
    """The columns of the input out of ``row``, some replaced."""
    return [replaced.get(c, F.col("row")[c]).alias(c) for c in docs.columns]


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", noise: int = NOISE_WORDS, guarantee: int = GUARANTEE_WORDS) -> DataFrame:
    """The documents with later repeated runs deleted from their text; every input row stays.

    Adds ``lines_total``, ``lines_removed`` and ``runs_removed`` (stretches;
    with ``_`` behind the name where the input has such a column).
    """
    cut = _cut(docs, id_col, text_col, noise, guarantee)
    names = added(docs, ["lines_total", "lines_removed", "runs_removed"])
    return cut.select(*_back(docs, {text_col: F.col("text")}), *[F.col(a).alias(b) for a, b in names.items()])


def drop_repeated_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size_col: str | None = None, noise: int = NOISE_WORDS, guarantee: int = GUARANTEE_WORDS) -> DataFrame:
    """As ``dedup_lines``, with the input's columns only; ``size_col`` gets the new number of characters where lines went."""
    cut = _cut(docs, id_col, text_col, noise, guarantee)
    replaced = {text_col: F.col("text")}
    if size_col is not None:
        size = F.length("text").cast(docs.schema[size_col].dataType)
        replaced[size_col] = F.when(F.col("lines_removed") > 0, size).otherwise(F.col("row")[size_col])
    return cut.select(*_back(docs, replaced))


#: From the definition: runs are compared as texts, each with every earlier place of its own lines.
ORACLE_SQL = f"""
WITH every AS (SELECT doc_id AS doc, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS pos, unnest(string_split(text, chr(10))) AS line FROM documents),
l AS (SELECT *, row_number() OVER (PARTITION BY doc ORDER BY pos) AS n, length(trim(line)) - length(replace(trim(line), ' ', '')) + 1 AS w FROM every WHERE trim(line) <> ''),
c AS (SELECT *, sum(w) OVER (PARTITION BY doc ORDER BY n) AS e, sum(w) OVER (PARTITION BY doc ORDER BY n) - w AS c FROM l),
spans AS (SELECT a.doc, a.n AS n1, b.n AS n2, a.pos AS a1, b.pos AS a2 FROM c a JOIN c b ON a.doc = b.doc AND a.n <= b.n AND b.e - a.c >= {GUARANTEE_WORDS} AND (b.c - a.c < {GUARANTEE_WORDS} OR b.e - a.e < {GUARANTEE_WORDS})),
runs AS (SELECT s.doc, s.n1, s.n2, s.a1, s.a2, string_agg(trim(c.line), chr(10) ORDER BY c.n) AS lines FROM spans s JOIN c ON c.doc = s.doc AND c.n BETWEEN s.n1 AND s.n2 GROUP BY ALL),
again AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lines ORDER BY doc NULLS FIRST, n1) AS k FROM runs) WHERE k > 1),
gone AS (SELECT DISTINCT c.doc, c.n, c.pos FROM c JOIN again r ON r.doc = c.doc AND c.n BETWEEN r.n1 AND r.n2),
cuts AS (SELECT doc, min(pos) AS a, max(pos) AS b FROM (SELECT *, n - row_number() OVER (PARTITION BY doc ORDER BY n) AS g FROM gone) GROUP BY doc, g),
kept AS (SELECT e.doc, string_agg(line, chr(10) ORDER BY pos) AS text, count(*) AS n FROM every e WHERE NOT EXISTS (SELECT 1 FROM cuts u WHERE u.doc = e.doc AND e.pos BETWEEN u.a AND u.b) GROUP BY e.doc),
n_cuts AS (SELECT doc, count(*) AS n FROM cuts GROUP BY doc)
SELECT d.doc_id, CASE WHEN d.text IS NOT NULL THEN coalesce(k.text, '') END AS text,
       CAST(coalesce(len(string_split(d.text, chr(10))), 0) AS BIGINT) AS lines_total,
       CAST(coalesce(len(string_split(d.text, chr(10))), 0) - coalesce(k.n, 0) AS BIGINT) AS lines_removed,
       CAST(coalesce(u.n, 0) AS BIGINT) AS runs_removed
FROM documents d LEFT JOIN kept k ON k.doc = d.doc_id LEFT JOIN n_cuts u ON u.doc = d.doc_id
"""

"""Accuracy and area statistics of a class map. Inputs are rows; outputs have a row per class or less."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def histogram(df: DataFrame, label: str) -> DataFrame:
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))


def area_by_class(df: DataFrame, label: str, area: str) -> DataFrame:
    """(label, area, share of all, whether the share is at least the mean share)."""
    sums = df.groupBy(label).agg(F.sum(area).alias("area"))
    every = Window.partitionBy()  # a row per class
    share = F.try_divide(F.col("area"), F.sum("area").over(every))
    return sums.withColumn("share", share).withColumn("majority", F.col("share") >= F.avg("share").over(every))


def share_summary(df: DataFrame, share: str = "share") -> DataFrame:
    return df.agg(F.avg(share).alias("mean_share"), F.percentile(F.col(share), F.lit(0.5)).alias("median_share"))


def cells(df: DataFrame, true: str, pred: str) -> DataFrame:
    """(true, pred, n): the counts from which everything else here follows; one exchange of the rows."""
    return df.filter(F.col(true).isNotNull() & F.col(pred).isNotNull()).groupBy(F.col(true).alias("true"), F.col(pred).alias("pred")).agg(F.count(F.lit(1)).alias("n"))


def confusion_matrix(df: DataFrame, true: str, pred: str, classes: list[int], normalised: bool = False) -> DataFrame:
    """A row per true class of ``classes``, a column ``pred_<k>`` per predicted one; classes without rows count 0."""
    counted = cells(df, true, pred).groupBy("true").pivot("pred", classes).agg(F.sum("n"))
    names = df.sparkSession.createDataFrame([(c,) for c in classes], "true int")
    full = names.join(counted, "true", "left").fillna(0)
    full = full.select("true", *[F.col(str(c)).alias(f"pred_{c}") for c in classes])
    if not normalised:
        return full
    total = sum((F.col(f"pred_{c}") for c in classes), F.lit(0))
    return full.select("true", *[F.coalesce(F.try_divide(F.col(f"pred_{c}").cast("double"), total.cast("double")), F.lit(0.0)).alias(f"pred_{c}") for c in classes])


def by_class(df: DataFrame, true: str, pred: str, legacy: bool = False) -> DataFrame:
    """Counts, omission and commission errors, producer's and user's accuracy of each class.

    Commission is FP / (FP + TP); ``legacy`` divides by FN + TP instead.
    """
    counted = cells(df, true, pred)
    sides = counted.select(F.explode(F.array(
        F.struct(F.col("true").alias("class"), F.lit("t").alias("side"), F.when(F.col("true") == F.col("pred"), F.col("n")).otherwise(0).alias("hit"), F.col("n").alias("n")),
        F.struct(F.col("pred").alias("class"), F.lit("p").alias("side"), F.lit(0).cast("long").alias("hit"), F.col("n").alias("n")),
    )).alias("s")).select("s.*")
    sums = sides.groupBy("class").agg(F.sum("hit").alias("tp"), F.sum(F.when(F.col("side") == "t", F.col("n")).otherwise(0)).alias("actual"), F.sum(F.when(F.col("side") == "p", F.col("n")).otherwise(0)).alias("predicted"))
    total = F.sum("actual").over(Window.partitionBy())  # a row per class
    out = sums.select("class", "tp", (F.col("actual") - F.col("tp")).alias("fn"), (F.col("predicted") - F.col("tp")).alias("fp"), (total - F.col("actual") - F.col("predicted") + F.col("tp")).alias("tn"))
    d = lambda a, b: F.try_divide(F.col(a).cast("double"), b.cast("double"))
    base = F.col("fn") + F.col("tp")
    out = out.withColumns({"omission": d("fn", base), "commission": d("fp", base if legacy else F.col("fp") + F.col("tp"))})
    return out.withColumns({"producer_acc": F.round(100 - F.col("omission") * 100, 2), "user_acc": F.round(100 - F.col("commission") * 100, 2)})


def overall(df: DataFrame, true: str, pred: str) -> DataFrame:
    """One row: accuracy, and precision, recall and F1 weighted by the classes' true counts, to three digits."""
    c = by_class(df, true, pred)
    n = (F.col("tp") + F.col("fn")).cast("double")
    zero = lambda v: F.coalesce(v, F.lit(0.0))
    precision = zero(F.try_divide(F.col("tp").cast("double"), (F.col("tp") + F.col("fp")).cast("double")))
    recall = zero(F.try_divide(F.col("tp").cast("double"), n))
    c = c.select(n.alias("n"), F.col("tp"), precision.alias("p"), recall.alias("r"))
    c = c.withColumn("f", zero(F.try_divide(2 * F.col("p") * F.col("r"), F.col("p") + F.col("r"))))
    mean = lambda v: F.round(F.try_divide(F.sum(F.col(v) * F.col("n")), F.sum("n")), 3)
    return c.agg(F.round(F.try_divide(F.sum("tp").cast("double"), F.sum("n")), 3).alias("accuracy"), mean("p").alias("precision"), mean("r").alias("recall"), mean("f").alias("f1"))


def area_estimates(df: DataFrame, true: str, pred: str, mapped: DataFrame, z: float = 1.96) -> DataFrame:
    """(class, area, half width): error-adjusted areas with confidence intervals (Olofsson et al. 2014).

    ``df`` holds reference rows, ``mapped`` (class, area) the map's areas, its strata.
    """
    counted = cells(df, true, pred)
    strata = counted.groupBy("pred").agg(F.sum("n").cast("double").alias("n_i"))
    weights = mapped.select(F.col("class").alias("pred"), F.col("area").cast("double").alias("a_i"))
    joined = counted.join(strata, "pred").join(weights, "pred")
    total = mapped.agg(F.sum("area").cast("double").alias("total"))
    joined = joined.crossJoin(F.broadcast(total))  # one row
    w = F.col("a_i") / F.col("total")
    p = F.col("n") / F.col("n_i")
    joined = joined.withColumns({"share": w * p, "variance": F.try_divide(w * w * p * (1 - p), F.col("n_i") - 1)})
    sums = joined.groupBy(F.col("true").alias("class")).agg(F.sum("share").alias("share"), F.sum("variance").alias("variance"), F.first("total").alias("total"))
    return sums.select("class", (F.col("share") * F.col("total")).alias("area"), (z * F.sqrt("variance") * F.col("total")).alias("half_width"))

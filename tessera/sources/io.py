"""Reading scenes, layers and tables; writing images, tables, class images and reports."""

from __future__ import annotations

import os
import posixpath

from pyspark.sql import DataFrame, SparkSession


def exists(spark: SparkSession, path: str) -> bool:
    """Whether anything is stored under the path, in whatever file system it names."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return bool(hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop))


def make_folder(spark: SparkSession, path: str) -> None:
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(hadoop)


def read(spark: SparkSession, path: str, columns: list[str] | None = None, schema: str | None = None) -> DataFrame:
    """A stored image, collection or table; only the named columns are read."""
    reader = spark.read.schema(schema) if schema else spark.read
    df = reader.option("header", True).csv(path) if path.endswith(".csv") else reader.parquet(path)
    return df.select(*columns) if columns else df


def read_collection(spark: SparkSession, path: str, years: tuple[int, int] | None = None, tiles: list[str] | None = None) -> DataFrame:
    """Observations; where ``year`` and ``tile`` are partition folders, these filters prune files."""
    df = spark.read.parquet(path)
    if years and "year" in df.columns:
        df = df.filter(df["year"].between(*years))
    if tiles:
        df = df.filter(df["tile"].isin(tiles))
    return df


def write_collection(df: DataFrame, path: str, partitions: tuple[str, ...] = ("year", "tile")) -> None:
    df.write.mode("errorifexists").partitionBy(*partitions).parquet(path)


def write_image(df: DataFrame, path: str, dry_run: bool = False) -> bool:
    """Writes the image; an existing one is an error. A dry run only explains the plan."""
    if dry_run:
        df.explain("formatted")
        return False
    df.write.mode("errorifexists").parquet(path)
    return True


def write_table(df: DataFrame, path: str, dry_run: bool = False) -> bool:
    """Writes the table unless it exists; tells whether it did."""
    if exists(df.sparkSession, path):
        print(f"exists already: {path}")
        return False
    if dry_run:
        df.explain("formatted")
        return False
    df.write.parquet(path)
    return True


def write_csv(df: DataFrame, path: str, selectors: list[str] | None = None, single: bool = False) -> None:
    """CSV with a header, of the selected columns in their order."""
    out = df.select(*selectors) if selectors else df
    (out.coalesce(1) if single else out).write.mode("errorifexists").option("header", True).csv(path)


def write_primitives(df: DataFrame, collection: str, value: int, probability: str, keys: list[str]) -> str:
    """One class's probability image in its collection, under ``class=<k>``."""
    path = posixpath.join(collection, f"class={value}")
    df.select(*keys, df[probability].alias("Probability")).write.mode("errorifexists").parquet(path)
    return path


def read_primitives(spark: SparkSession, collection: str, keys: list[str], values: list[int]) -> DataFrame:
    """The collection as a column ``Class<k>`` for each class, in one aggregation."""
    from ..operators.classify import to_bands

    wide = to_bands(spark.read.parquet(collection), keys, "class", values, "Probability")
    return wide.select(*keys, *[wide[str(v)].alias(f"Class{v}") for v in values])


def write_metrics(folder: str, value: int, importance: dict[str, float], oob: float, oob_all: float | None = None) -> None:
    """A class's variable importances as CSV and its out-of-bag errors (of the last fit, and of the one on all features) as text, on the driver."""
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, f"varImportanceClass{value}.csv"), "w") as f:
        f.write(",0\n" + "".join(f"{k},{v}\n" for k, v in importance.items()))
    with open(os.path.join(folder, f"oobErrorClass{value}.txt"), "w") as f:
        f.write(str(oob))
    if oob_all is not None:
        with open(os.path.join(folder, f"oobErrorAllClass{value}.txt"), "w") as f:
            f.write(str(oob_all))


def write_report(folder: str, classes: DataFrame, confusion: DataFrame, overall: DataFrame) -> None:
    """Class accuracies and confusion matrix as CSV, overall figures as text; a few rows each."""
    os.makedirs(folder, exist_ok=True)
    classes.toPandas().to_csv(os.path.join(folder, "classAccuracy.csv"), index=False)
    confusion.toPandas().to_csv(os.path.join(folder, "confMatrix.csv"), index=False)
    row = overall.first()
    with open(os.path.join(folder, "overallAccuracy.txt"), "w") as f:
        f.write(f"Accuracy:{row['accuracy']}\nPrecision:{row['precision']}\nRecall:{row['recall']}\nF1:{row['f1']}")

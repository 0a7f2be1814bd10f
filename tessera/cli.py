"""Command line: sample, composite, train-test, primitives, assemble, radar, basemap.

Inputs and outputs are Parquet paths. ``--dry-run`` checks everything and
explains the plan without running it.
"""

from __future__ import annotations

import argparse
from datetime import date

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from .config import CompositeConfig
from .functions.hashing import DEFAULT_SEED, reshuffled_seed
from .operators import classify, sampling
from .operators.clouds import margin
from .plans.composite import SENSOR_BANDS, feature_stack, masked_observations, near_polygons, scenes_of_year, select_bands
from .plans.sensors import basemap_stack, radar_composite
from .sources import io


def _need(spark: SparkSession, *paths: str) -> None:
    missing = [p for p in paths if not io.exists(spark, p)]
    if missing:
        raise FileNotFoundError(f"not found: {missing}")


def _free(spark: SparkSession, *paths: str) -> None:
    taken = [p for p in paths if io.exists(spark, p)]
    if taken:
        raise FileExistsError(f"exists already: {taken}")


def _seed(args: argparse.Namespace) -> int:
    return reshuffled_seed() if args.reshuffle else DEFAULT_SEED


def sample(spark: SparkSession, args: argparse.Namespace) -> None:
    """Stratified points of a class map, to a table, a CSV file or both."""
    _need(spark, args.input)
    sampling.resolve_points(args.class_values, args.class_points, args.n_points)
    cells = io.read(spark, args.input, ["x", "y", args.class_band]).withColumn("id", F.concat_ws("_", "x", "y"))
    points = sampling.stratified_sample(cells, args.class_band, ["id"], args.n_points, args.class_values, args.class_points, _seed(args))
    points = sampling.plot_ids(points.withColumns({"lon": (F.col("x") + 0.5) * args.scale, "lat": (F.col("y") + 0.5) * args.scale}), "id", "lon", "lat")
    both = args.to_table == args.to_csv
    if args.dry_run:
        points.explain("formatted")
        return
    if both or args.to_table:
        io.write_table(points, args.output)
    if both or args.to_csv:
        io.write_csv(points, args.output + "_csv", ["LON", "LAT", "PLOTID", "SAMPLEID", args.class_band])


def composite(spark: SparkSession, args: argparse.Namespace) -> None:
    """The yearly feature stack, everywhere or inside polygons only; only the year's folders, the named tiles and the polygons' surroundings are read."""
    _need(spark, args.observations, args.scenes, args.clouds, args.topography)
    _free(spark, args.output)
    config = CompositeConfig(approximate_percentiles=args.approximate)
    scenes = scenes_of_year(io.read(spark, args.scenes), args.year, args.year, config)
    tiles = args.tiles.split(",") if args.tiles else None
    obs, clouds = (io.read_collection(spark, p, (args.year, args.year), tiles) for p in (args.observations, args.clouds))
    if set(SENSOR_BANDS) <= set(obs.columns):
        obs = select_bands(obs.withColumnRenamed("SCL", "scl"), ["scene", "ts", "x", "y", "scl"])
    if args.polygons:
        _need(spark, args.polygons)
        obs, clouds = (near_polygons(df, io.read(spark, args.polygons), margin(config)) for df in (obs, clouds))
    obs = masked_observations(obs, scenes, clouds, config)
    footprint = None
    if args.polygons:
        cells = obs.select("x", "y").distinct()
        footprint = sampling.paint(cells, io.read(spark, args.polygons), args.label).filter(F.col(args.label).isNotNull())
    stack = feature_stack(obs, ["x", "y"], config, io.read(spark, args.topography), footprint=footprint)
    io.write_image(stack, args.output, args.dry_run)


def train_test(spark: SparkSession, args: argparse.Namespace) -> None:
    """Points in polygons with the stack's features, split into training and test tables."""
    _need(spark, args.polygons, args.stack)
    _free(spark, args.output + "_train", args.output + "_test")
    n = sampling.resolve_points(args.class_values, args.class_points, args.n_points)
    polygons, stack = io.read(spark, args.polygons), io.read(spark, args.stack)
    found = classify.labels_of(polygons, args.label)
    values = args.class_values or found
    if set(values) != set(found):
        print(f"classes of the polygons {found} and classes asked for {values} differ")
    wanted = dict(zip(values, args.class_points)) if n is None else dict.fromkeys(values, n)
    bands = [c for c in stack.columns if c not in ("x", "y")]
    points = sampling.sample_with_extraction(polygons, stack, args.label, wanted, args.scale, bands, _seed(args))
    train, test = sampling.split_train_test(points, ["id"], _seed(args))
    io.write_table(train, args.output + "_train", args.dry_run)
    io.write_table(test, args.output + "_test", args.dry_run)


def primitives(spark: SparkSession, args: argparse.Namespace) -> None:
    """A probability image for each class, with importances and out-of-bag errors."""
    _need(spark, args.stack, *args.training)
    _free(spark, args.output)
    stack = io.read(spark, args.stack)
    points = sampling.merge_sets(*[io.read(spark, p) for p in args.training])
    features = [c for c in stack.columns if c not in ("x", "y")]
    if args.dry_run:
        points.explain("formatted")
        return
    io.make_folder(spark, args.output)
    forests = {"trees": args.trees, "depth": args.depth}
    for fit in classify.train_primitives(points, args.label, features, **forests):
        scored = classify.probabilities(stack.select("x", "y", *features), [fit])
        io.write_primitives(scored, args.output, fit.value, f"Class{fit.value}", ["x", "y"])
        oob_all, oob = (classify.out_of_bag(points, args.label, fit.value, names, ["id"], **forests) for names in (features, fit.features))
        io.write_metrics(args.metrics, fit.value, fit.importance_top, oob, oob_all)


def radar(spark: SparkSession, args: argparse.Namespace) -> None:
    """Radar backscatter of two weeks."""
    _need(spark, args.observations, args.scenes, args.elevation)
    _free(spark, args.output)
    image = radar_composite(io.read(spark, args.observations), io.read(spark, args.scenes), io.read(spark, args.elevation), args.start)
    io.write_image(image, args.output, args.dry_run)


def basemap(spark: SparkSession, args: argparse.Namespace) -> None:
    """Monthly basemaps of a year with their indices, and the terrain."""
    _need(spark, args.images, *([args.topography] if args.topography else []))
    _free(spark, args.output)
    images = io.read_collection(spark, args.images, (args.year, args.year))
    image = basemap_stack(images, args.year, io.read(spark, args.topography) if args.topography else None)
    io.write_image(image, args.output, args.dry_run)


def assemble(spark: SparkSession, args: argparse.Namespace) -> None:
    """The map of the most probable class."""
    _need(spark, args.primitives)
    _free(spark, args.output)
    values = [r[0] for r in spark.read.parquet(args.primitives).select("class").distinct().orderBy("class").collect()]  # a row per class
    wide = io.read_primitives(spark, args.primitives, ["x", "y"], values)
    image = classify.most_probable(wide, {v: f"Class{v}" for v in values}).select("x", "y", "LANDCOVER")
    io.write_image(image, args.output, args.dry_run)


def _ints(text: str) -> list[int]:
    return [int(v) for v in text.replace(",", " ").split()]


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="tessera", description=__doc__)
    commands = top.add_subparsers(dest="command", required=True)

    def command(name, run, *paths):
        p = commands.add_parser(name, help=run.__doc__.splitlines()[0])
        for path in paths:
            p.add_argument(f"--{path}", required=True)
        p.add_argument("--output", required=True)
        p.add_argument("--dry-run", action="store_true")
        p.set_defaults(run=run)
        return p

    def points(p):
        p.add_argument("--n-points", type=int)
        p.add_argument("--class-values", type=_ints)
        p.add_argument("--class-points", type=_ints)
        p.add_argument("--scale", type=float, default=10)
        p.add_argument("--reshuffle", action="store_true")

    p = command("sample", sample, "input")
    points(p)
    p.add_argument("--class-band", default="LANDCOVER")
    p.add_argument("--to-table", action="store_true")
    p.add_argument("--to-csv", action="store_true")
    p = command("composite", composite, "observations", "scenes", "clouds", "topography")
    p.add_argument("--year", type=int, required=True)
    p.add_argument("--polygons")
    p.add_argument("--label", default="LANDCOVER")
    p.add_argument("--approximate", action="store_true")
    p.add_argument("--tiles", help="names of tiles, separated by commas")
    p = command("train-test", train_test, "polygons", "stack")
    points(p)
    p.add_argument("--label", default="LANDCOVER")
    p = command("primitives", primitives, "stack", "metrics")
    p.add_argument("--training", nargs="+", required=True)
    p.add_argument("--label", default="LANDCOVER")
    p.add_argument("--trees", type=int, default=classify.TREES)
    p.add_argument("--depth", type=int, default=classify.DEPTH)
    p = command("radar", radar, "observations", "scenes", "elevation")
    p.add_argument("--start", type=date.fromisoformat, required=True, help="first day of the two weeks")
    p = command("basemap", basemap, "images")
    p.add_argument("--year", type=int, required=True)
    p.add_argument("--topography")
    command("assemble", assemble, "primitives")
    return top


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    args = parser().parse_args(argv)
    args.run(spark or SparkSession.builder.appName(f"tessera-{args.command}").getOrCreate(), args)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())

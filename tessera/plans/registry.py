"""Driver registry: query name -> callable(spark, sf_dir), and its DuckDB oracle."""

from __future__ import annotations

from . import raster_queries, sample_queries

QUERIES: dict = {**raster_queries.QUERIES, **sample_queries.QUERIES}
ORACLES: dict = {**raster_queries.ORACLES, **sample_queries.ORACLES}

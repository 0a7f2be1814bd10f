"""tessera: Spark-native analytics for gridded, multi-band time series."""

__version__ = "0.1.0"

"""Latest value per key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_per_key(
    df: DataFrame, key: str | list[str], order_by: str | list[str], cols: list[str] | None = None
) -> DataFrame:
    """The row with the greatest `order_by` of each key.

    Order by the arrival position for "last write wins", or by event time if wanted.
    Rows that agree on it are ordered by their remaining columns, so that the answer
    never depends on the order of reading. Each task reduces its rows to one per key
    before the shuffle, hence a key of any size costs one row per task. Works the same
    on a stream.
    """
    keys = [key] if isinstance(key, str) else list(key)
    order = [order_by] if isinstance(order_by, str) else list(order_by)
    cols = [c for c in (df.columns if cols is None else cols) if c not in keys]
    rest = [c for c in cols if c not in order]
    best = df.groupBy(*keys).agg(F.max(F.struct(*order, *rest)).alias("_best"))
    return best.select(*keys, *[F.col(f"_best.{c}").alias(c) for c in cols])


def lookup(view: DataFrame, key: str, value: object) -> DataFrame:
    """Current row of one key; no row when the key is unknown."""
    return view.filter(F.col(key) == F.lit(value))


def lookup_many(view: DataFrame, key: str, keys: DataFrame, key_in: str | None = None) -> DataFrame:
    """Current rows of the keys that occur in another table, each once; unknown keys give no
    row.

    The keys restrict the scan, not the view: as the key is what the view is grouped by,
    Spark can put a Bloom filter of the wanted keys below the aggregate, so rows of other
    keys are neither reduced nor shuffled. It does so where the view's files are large
    (spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold) and the keys
    come from a filtered table.
    """
    wanted = keys.select(F.col(key_in or key).alias("_wanted"))
    return view.join(wanted, F.col(key) == F.col("_wanted"), "left_semi")


def lookup_list(view: DataFrame, key: str, values: list) -> DataFrame:
    """Current rows of a short list of keys. The list reaches the Parquet reader, which
    skips row groups by their statistics and by the Bloom filters that the change log
    writes."""
    return view.filter(F.col(key).isin(list(values)))

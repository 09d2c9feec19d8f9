"""Reports on readings: share of each status, messages lost per station."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .ordering import BLOCK, keep, of_mark, range_blocks, with_marks


# The columns of a run, after that of the station.
RUN = T.StructType(
    [T.StructField(n, T.LongType()) for n in ("run", "first_no", "last_no", "messages", "received", "dropped")]
)


def status_share(df: DataFrame, station: str | list[str], status: str, n: Column | None = None) -> DataFrame:
    """Count and percentage of each status per station.

    `station` can be several columns, such as a time window and a station. `n` is the
    aggregate that counts, for rows that stand for more than one.
    """
    by = [station] if isinstance(station, str) else list(station)
    counts = df.groupBy(*by, status).agg((F.count(F.lit(1)) if n is None else n).alias("n"))
    # The window runs on counted rows: one per status value of the station.
    total = F.sum("n").over(Window.partitionBy(*by))
    return counts.withColumn("pct", F.col("n") * 100.0 / total)


def sequence_audit(df: DataFrame, station: str, seq: str) -> DataFrame:
    """Numbers missing between the least and the greatest, one run per station.

    Repeats are removed by grouping on (station, number) first, which spreads a large
    station over all tasks.
    """
    spread = F.max(seq) - F.min(seq) + 1
    received = F.countDistinct(seq)
    return df.groupBy(station).agg(
        F.min(seq).alias("first_no"),
        F.max(seq).alias("last_no"),
        received.alias("received"),
        (spread - received).cast("bigint").alias("dropped"),
    )


def sequence_runs(
    df: DataFrame,
    station: str,
    seq: str,
    order_by: list[str],
    block: Column | None = None,
) -> DataFrame:
    """Sequence audit per run; a run starts when the number falls in arrival order.

    `order_by` must be a total order within the station. `block` is a column that cuts
    it into pieces of bounded size, such as `offset_block`; without one the rows are
    range partitioned.

    Inside a run the numbers never fall, so the count of different numbers is one more
    than the count of increases, and both add up across blocks.
    """
    pieces = sequence_pieces(df, station, seq, order_by, block)
    if block is None:
        # The pieces are used twice, and range bounds can differ between two runs.
        pieces = keep(pieces)
    return merge_pieces(pieces, station)


def sequence_pieces(
    df: DataFrame, station: str, seq: str, order_by: list[str], block: Column | None = None
) -> DataFrame:
    """The pieces of runs inside each block: many when numbers fall often, few when
    producers seldom restart. Blocks as in `sequence_runs`."""
    wanted = list(dict.fromkeys([station, seq, *order_by]))
    narrow = df.filter(F.col(seq).isNotNull())
    if block is None:
        tagged = range_blocks(narrow.select(*wanted), [station], order_by)
    else:
        tagged = narrow.select(*wanted, block.alias(BLOCK))
    arrival = Window.partitionBy(station, BLOCK).orderBy(*order_by)
    previous = F.lag(seq).over(arrival)
    falls = F.coalesce((F.col(seq) < previous).cast("int"), F.lit(0))
    rises = F.coalesce((F.col(seq) > previous).cast("int"), F.lit(0))
    return (
        tagged.withColumns({"_fall": falls, "_rise": rises})
        .withColumn("_piece", F.sum("_fall").over(arrival))
        .groupBy(station, BLOCK, "_piece")
        .agg(
            F.min(seq).alias("_lo"),
            F.max(seq).alias("_hi"),
            F.count(F.lit(1)).alias("_rows"),
            # The first row of a piece is a fall or has no predecessor in the block.
            (F.sum("_rise") + 1).alias("_different"),
        )
    )


def merge_pieces(pieces: DataFrame, station: str, open_runs: DataFrame | None = None) -> DataFrame:
    """Runs put together from their pieces, which are read twice.

    `open_runs` are the last runs of some stations so far, at most one row for each, in the
    form of the result: they go on where the pieces fit, and later runs are counted from
    theirs on.
    """
    if open_runs is not None:
        earliest = F.lit(-(2**63)).cast(pieces.schema[BLOCK].dataType)
        so_far = open_runs.select(
            station, earliest.alias(BLOCK), F.lit(0).cast("bigint").alias("_piece"), F.col("first_no").alias("_lo"),
            F.col("last_no").alias("_hi"), F.col("messages").alias("_rows"), F.col("received").alias("_different"),
        )
        pieces = pieces.unionByName(so_far)
    # One row per block: how it joins the block before, and the runs started so far.
    ends = pieces.groupBy(station, BLOCK).agg(
        F.min_by("_lo", "_piece").alias("_first"),
        F.max_by("_hi", "_piece").alias("_last"),
        F.max("_piece").alias("_falls"),
    )
    along = Window.partitionBy(station).orderBy(BLOCK)
    before = F.lag("_last").over(along)
    started = F.lag("_falls").over(along) + (F.col("_first") < before).cast("int")
    carry = (
        ends.withColumns({"_before": before, "_started": started})
        .withColumn("_base", F.coalesce(F.sum("_started").over(along), F.lit(0)))
        .select(
            station,
            BLOCK,
            "_base",
            F.coalesce(F.col("_first") == F.col("_before"), F.lit(False)).alias("_again"),
        )
    )
    if open_runs is not None:
        base = F.col("_base") + F.coalesce("_open", F.lit(0))
        known = open_runs.select(station, F.col("run").alias("_open"))
        carry = carry.join(known, station, "left").withColumn("_base", base).drop("_open")
    both, in_block, is_row = with_marks(pieces, carry, [station], ["_piece"])
    joined = both.withColumns(
        {"_from": of_mark("_base", in_block), "_repeat": of_mark("_again", in_block)}
    ).filter(is_row)
    repeated = ((F.col("_piece") == 0) & F.col("_repeat")).cast("int")
    run = F.col("_piece") + F.col("_from")
    received = F.sum("_different") - F.sum("_repeated")
    first_no, last_no = F.min("_lo"), F.max("_hi")
    return (
        joined.select(
            station,
            run.cast("bigint").alias("run"),
            "_lo",
            "_hi",
            "_rows",
            "_different",
            repeated.alias("_repeated"),
        )
        .groupBy(station, "run")
        .agg(
            first_no.alias("first_no"),
            last_no.alias("last_no"),
            F.sum("_rows").alias("messages"),
            received.alias("received"),
            (last_no - first_no + 1 - received).cast("bigint").alias("dropped"),
        )
    )


def cadence_audit(
    df: DataFrame, station: str, seconds: str, every: int = 1
) -> DataFrame:
    """Messages lost per station at one message per `every` seconds.

    Several messages of one second count as one received; the others are `repeated`, so
    that a repeat cannot hide a loss.
    """
    # By second first, which spreads a large station over all tasks.
    per_second = df.filter(F.col(seconds).isNotNull()).groupBy(station, seconds).agg(F.count(F.lit(1)).alias("_n"))
    spanned = F.max(seconds) - F.min(seconds)
    expected = F.floor(spanned / every).cast("bigint") + 1
    received = F.count(F.lit(1))
    return per_second.groupBy(station).agg(
        expected.alias("expected"),
        received.alias("received"),
        (F.sum("_n") - received).alias("repeated"),
        (expected - received).alias("dropped"),
    )

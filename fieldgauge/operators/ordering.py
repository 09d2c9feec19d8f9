"""Exact order-dependent results when one key may hold a large share of all rows.

A window over (key, order) sends a whole key to one task. Here the rows of a key are cut
into blocks along the order, each block is a window group of its own, and what a block
needs from the blocks before it comes from a summary with one row per (key, block). That
row joins the block as its first row, so the rows themselves are shuffled once.

The summaries of one key meet in one task. With blocks of a million rows that is a row
per million; choose `rows` of `offset_block` accordingly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import shared_folder

BLOCK = "_block"
MARK = "_mark"
# Estimated bytes of a range block.
BLOCK_BYTES = 128 * 1024 * 1024


def estimated_bytes(df: DataFrame) -> int:
    """Size of the table by the optimizer's estimate, 0 if unknown; runs nothing."""
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    # A plan without statistics counts as the largest number of bytes there is.
    return size if size < 2**56 else 0


def range_blocks(
    df: DataFrame, by: list[str], order_by: list[str], blocks: int | None = None
) -> DataFrame:
    """Tag each row with a block number; works for any total order.

    Range partitioning on (by, order_by) splits a large key over as many partitions as
    it fills. At most one key reaches into a block from the block before. The number of
    blocks follows the estimated size. The bounds come from a sample, which reads the
    input a second time, and two uses of the result can have different bounds: reduce it
    and `keep` that, then use it as often as needed.
    """
    count = blocks or max(
        int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")),
        -(-estimated_bytes(df) // BLOCK_BYTES),
    )
    return df.repartitionByRange(count, *by, *order_by).withColumn(
        BLOCK, F.spark_partition_id().cast("bigint")
    )


def keep(df: DataFrame) -> DataFrame:
    """Write the rows to the shared folder and go on from there."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def offset_block(offset: Column, rows: int = 1_000_000) -> Column:
    """Block for rows ordered by a whole number that is unique within the key.

    Needs no sample and no range partitioning: a block covers `rows` offsets, so it holds
    at most that many rows of a key. It is a fixed function of the row, so blocks can be
    worked out as often as needed and nothing has to be kept.
    """
    return offset - F.pmod(offset, F.lit(rows))


def with_marks(rows: DataFrame, marks: DataFrame, by: list[str], order_by: list[str]):
    """Put the summary of each block before its rows.

    Returns the rows and the summaries together, the window of a block with its summary
    first, and the test for a row that is no summary. `marks` has one row for each block
    that occurs, with `by`, the block and columns that `rows` lacks.
    """
    both = rows.withColumn(MARK, F.lit(1)).unionByName(
        marks.withColumn(MARK, F.lit(0)), allowMissingColumns=True
    )
    return both, Window.partitionBy(*by, BLOCK).orderBy(MARK, *order_by), F.col(MARK) == 1


def of_mark(name: str, window) -> Column:
    """A column of the block's summary, in each row of the block."""
    so_far = window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return F.first(name, ignorenulls=True).over(so_far)


def number_rows(
    df: DataFrame,
    by: list[str],
    order_by: list[str],
    name: str = "row_number",
    block: Column | None = None,
    blocks: int | None = None,
) -> DataFrame:
    """row_number() over (partition by `by` order by `order_by`), counted in blocks.

    `block` is a column that cuts the order into pieces, such as `offset_block`: then
    building the frame runs nothing. Without one the rows are range partitioned and kept.
    """
    if block is None:
        tagged = keep(range_blocks(df, by, order_by, blocks))
    else:
        tagged = df.withColumn(BLOCK, block)
    earlier = Window.partitionBy(*by).orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        tagged.groupBy(*by, BLOCK)
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select(*by, BLOCK, F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_start"))
    )
    both, in_block, is_row = with_marks(tagged, starts, by, order_by)
    # The summary is row 1 of its block.
    position = F.row_number().over(in_block) - 1 + of_mark("_start", in_block)
    return both.withColumn("_position", position).filter(is_row).select(
        *df.columns, F.col("_position").cast("bigint").alias(name)
    )

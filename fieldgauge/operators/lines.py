"""Operators for text logs: count, select, pair, rank, longest duration."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.units import duration_ms, field_text, size_bytes
from .ordering import BLOCK, keep, of_mark, offset_block, with_marks


def to_lines(df: DataFrame, file: str, text: str) -> DataFrame:
    """One row per line of a text, numbered from 1 within its file."""
    lines = F.posexplode(F.split(F.col(text), "\n", -1)).alias("_pos", "line")
    return df.select(file, lines).select(
        file, (F.col("_pos") + 1).cast("bigint").alias("line_no"), "line"
    )


def count_lines(df: DataFrame, line: str, text: str) -> DataFrame:
    """Number of lines that contain the text."""
    return df.filter(F.col(line).contains(text)).agg(F.count(F.lit(1)).alias("n"))


def select_lines(df: DataFrame, line: str, *alternatives: str) -> DataFrame:
    """Lines in which one of the patterns is found."""
    return df.filter(F.col(line).rlike("|".join(alternatives)))


def pair_lines(df: DataFrame, file: str, line_no: str, line: str, sep: str = "") -> DataFrame:
    """Join line 1 with 2, 3 with 4, and so on; a last odd line stays alone.

    `line_no` counts the lines of a file from 1 without gaps. Each pair is a group of
    its own, so a large file is spread over all tasks.
    """
    pair_no = ((F.col(line_no) + 1) / 2).cast("bigint")
    in_pair = Window.partitionBy(file, "pair_no").orderBy(line_no)
    return (
        df.select(file, line_no, F.col(line).alias("first"), pair_no.alias("pair_no"))
        .withColumn("second", F.lead("first").over(in_pair))
        .filter(F.col(line_no) % 2 == 1)
        .select(file, "pair_no", "first", "second", F.concat_ws(sep, "first", "second").alias("pair"))
    )


def pair_text(df: DataFrame, file: str, text: str, sep: str = "") -> DataFrame:
    """`pair_lines` for whole texts; no shuffle, the lines of a text are in one row."""
    all_lines = F.split(F.col(text), "\n", -1)
    pairs = F.arrays_zip(
        F.filter(all_lines, lambda x, i: i % 2 == 0).alias("first"),
        F.filter(all_lines, lambda x, i: i % 2 == 1).alias("second"),
    )
    return df.select(file, F.posexplode(pairs).alias("_i", "_pair")).select(
        file,
        (F.col("_i") + 1).cast("bigint").alias("pair_no"),
        "_pair.first",
        "_pair.second",
        F.concat_ws(sep, "_pair.first", "_pair.second").alias("pair"),
    )


def pair_selected_lines(
    df: DataFrame,
    file: str,
    line_no: str,
    line: str,
    sep: str = "",
    block_rows: int = 1_000_000,
) -> DataFrame:
    """`pair_lines` for lines left over after a selection, whose numbers have gaps.

    Positions are counted and neighbours found inside blocks of a file; a block with an
    odd start, or whose last line pairs with the next block, learns so from a summary.
    """
    rows = df.select(file, line_no, line, offset_block(F.col(line_no), block_rows).alias(BLOCK))
    along = Window.partitionBy(file).orderBy(BLOCK)
    earlier = along.rowsBetween(Window.unboundedPreceding, -1)
    marks = (
        rows.groupBy(file, BLOCK)
        .agg(F.count(F.lit(1)).alias("_rows"), F.min_by(line, line_no).alias("_head"))
        .select(
            file,
            BLOCK,
            F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_start"),
            F.lead("_head").over(along).alias("_following"),
        )
    )
    both, in_block, is_row = with_marks(rows, marks, [file], [line_no])
    # The summary is row 1 of its block.
    position = F.row_number().over(in_block) - 1 + of_mark("_start", in_block)
    more = F.lead(F.lit(True), 1, False).over(in_block)
    paired = both.withColumns(
        {
            "_position": position,
            "_second": F.when(more, F.lead(line).over(in_block)).otherwise(of_mark("_following", in_block)),
        }
    )
    return paired.filter(is_row & (F.col("_position") % 2 == 1)).select(
        file,
        ((F.col("_position") + 1) / 2).cast("bigint").alias("pair_no"),
        F.col(line).alias("first"),
        F.col("_second").alias("second"),
        F.concat_ws(sep, line, "_second").alias("pair"),
    )


def top_k(df: DataFrame, by: str, k: int = 10, weight: Column | None = None) -> DataFrame:
    """The k most frequent values, or with `weight` the k of greatest sum.

    Equal ranks are ordered by value.
    """
    measure = F.count(F.lit(1)) if weight is None else F.sum(weight)
    name = "n" if weight is None else "weight"
    return (
        df.groupBy(by).agg(measure.alias(name)).orderBy(F.desc(name), F.asc(by)).limit(k)
    )


# Buckets of the sketch: what a task sends of any number of values.
SKETCH_BUCKETS = 1 << 17


def top_k_sketched(df: DataFrame, by: str, k: int = 10, buckets: int = SKETCH_BUCKETS) -> DataFrame:
    """`top_k` without a shuffle of all values, for columns with very many of them.

    First the values are counted by bucket of their hash, of which each task sends
    `buckets` rows at most. The count of a bucket is a bound on that of each value in it.
    The values in the fullest buckets are counted exactly, and the k-th of these counts is
    a threshold: a value of a bucket below it cannot be among the first k. What lies in the
    other buckets is counted exactly, so the result is that of `top_k`, ties included. The
    input is read three times; it pays where few values are frequent, and where none is the
    last pass counts all values, as `top_k` does.
    """
    hashed = df.select(F.col(by), F.pmod(F.xxhash64(by), F.lit(buckets)).alias("_bucket"))
    # A fixed number of rows, whatever the input.
    sizes = keep(hashed.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_size")))
    inside = lambda buckets: hashed.join(F.broadcast(buckets.select("_bucket")), "_bucket", "left_semi")
    fullest = sizes.orderBy(F.desc("_size"), "_bucket").limit(2 * k)
    counts = inside(fullest).groupBy(by).agg(F.count(F.lit(1)).alias("n"))
    best = [row.n for row in counts.orderBy(F.desc("n")).limit(k).collect()]
    threshold = best[-1] if len(best) == k else 0
    return top_k(inside(sizes.where(F.col("_size") >= threshold)), by, k)


def top_pairs(
    df: DataFrame, file: str, line_no: str, line: str, *alternatives: str, k: int = 10, sep: str = "\n"
) -> DataFrame:
    """The k most frequent pairs of the lines in which one of the patterns is found."""
    chosen = select_lines(df, line, *alternatives)
    return top_k(pair_selected_lines(chosen, file, line_no, line, sep), "pair", k)


def allocation_top_k(
    df: DataFrame, file: str, line_no: str, line: str, k: int = 10
) -> DataFrame:
    """Classes with the most allocated memory, from `objectClass =` / `weight =` lines."""
    chosen = select_lines(df, line, "objectClass", "weight")
    pair = F.col("pair")
    # Equal pairs are counted first: sizes have few digits, so there are not many to parse.
    samples = pair_selected_lines(chosen, file, line_no, line, "\n").groupBy("pair").count()
    parsed = samples.select(
        field_text(pair, "objectClass").alias("object_class"),
        (size_bytes(pair, "weight") * F.col("count")).alias("_bytes"),
    )
    return top_k(parsed, "object_class", k, F.col("_bytes"))


def max_duration(df: DataFrame, line: str, name: str = "duration") -> DataFrame:
    """Line with the longest `duration = <number> <unit>`, whatever the unit, and its
    length in milliseconds; nulls when there is none."""
    longest = df.agg(F.max(F.struct(duration_ms(F.col(line), name), line)).alias("_l"))
    ms = F.col("_l.col1")
    return longest.select(ms.alias("max_ms"), F.when(ms.isNotNull(), F.col(f"_l.{line}")).alias("line"))

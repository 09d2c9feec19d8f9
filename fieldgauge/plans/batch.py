"""Registered queries that only read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.times import epoch_seconds
from ..operators import alerts, audit, latest, lines, messages as msg
from ..operators.ordering import offset_block
from ..sources import archive, exports
from .tables import messages, readings, table


def parquet_scan(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders")


def latest_per_key(spark: SparkSession, d: str) -> DataFrame:
    events = table(spark, d, "events")
    return latest.latest_per_key(
        events, "user_id", "event_id", ["event_id", "ts", "event_type", "value"]
    )


def latest_orders(spark: SparkSession, d: str) -> DataFrame:
    orders = table(spark, d, "orders")
    return latest.latest_per_key(
        orders, "o_custkey", ["o_orderdate", "o_orderkey"], ["o_orderkey", "o_orderdate", "o_totalprice"]
    )


def lookup(spark: SparkSession, d: str) -> DataFrame:
    return latest.lookup(latest_per_key(spark, d), "user_id", 7).select(
        "user_id", "event_id", "event_type"
    )


def alert_filter(spark: SparkSession, d: str) -> DataFrame:
    hits = alerts.over_threshold(table(spark, d, "events"), "props", "k", name="k")
    return hits.select("event_id", "k")


def alert_render(spark: SparkSession, d: str) -> DataFrame:
    return alerts.rain_alerts(messages(spark, d)).select("offset", "key", "value")


def route(spark: SparkSession, d: str) -> DataFrame:
    return msg.with_validity(messages(spark, d)).select("offset", "valid")


def default_key(spark: SparkSession, d: str) -> DataFrame:
    return msg.with_default_key(messages(spark, d)).select("offset", "key")


def classify_messages(spark: SparkSession, d: str) -> DataFrame:
    return msg.classify(messages(spark, d)).select("offset", "reason")


def dead_letters(spark: SparkSession, d: str) -> DataFrame:
    keyed = msg.with_default_key(messages(spark, d))
    return msg.dead_letters(msg.classify(keyed), "key", "value", "offset")


def parse_envelope(spark: SparkSession, d: str) -> DataFrame:
    return msg.readings(msg.classify(messages(spark, d)))


def envelope_json(spark: SparkSession, d: str) -> DataFrame:
    return msg.build_envelope(readings(spark, d)).select("event_id", "value")


def keyed_rows(spark: SparkSession, d: str) -> DataFrame:
    return msg.to_messages(readings(spark, d))


def normalise_value(spark: SparkSession, d: str) -> DataFrame:
    return msg.normalise_json(messages(spark, d)).select("offset", "value")


def normalise_spaced(spark: SparkSession, d: str) -> DataFrame:
    return msg.normalise_json(messages(spark, d), spaced=True).select("offset", "value")


def feed_documents(spark: SparkSession, d: str) -> DataFrame:
    """Events as documents of external feeds, one feed per event type."""
    current = F.struct(
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm").alias("time"),
        F.lit(900).alias("interval"),
        F.col("value").alias("temperature_2m"),
        F.get_json_object("props", "$.k").cast("int").alias("relative_humidity_2m"),
        (F.col("value") / 2).alias("wind_speed_10m"),
    )
    return table(spark, d, "events").withColumn(
        "document", F.to_json(F.struct(current.alias("current")))
    )


def damaged_documents(spark: SparkSession, d: str) -> DataFrame:
    """The same with unreadable, missing and incomplete documents among them."""
    n, text = F.col("event_id"), F.col("document")
    return feed_documents(spark, d).withColumn(
        "document",
        F.when(n % 11 == 0, F.lit(None))
        .when(n % 13 == 0, F.lit("hello"))
        .when(n % 17 == 0, F.expr("left(document, length(document) - 3)"))
        .when(n % 19 == 0, F.lit('{"error":true}'))
        .when(n % 7 == 0, F.replace(text, F.lit('"temperature_2m"'), F.lit('"t"')))
        .otherwise(text),
    )


def adapt_feed(spark: SparkSession, d: str) -> DataFrame:
    return msg.adapt_ordered_feed(
        damaged_documents(spark, d),
        "document",
        F.lit(11).cast("bigint"),
        epoch_seconds(F.col("ts")),
        ["event_type"],
        ["event_id"],
        offset_block(F.col("event_id")),
    ).drop("event_type")


def adapt_feed_by_offset(spark: SparkSession, d: str) -> DataFrame:
    return msg.adapt_feed(
        damaged_documents(spark, d),
        "document",
        F.lit(11).cast("bigint"),
        epoch_seconds(F.col("ts")),
        F.col("event_id") + 1,
    )


def status_share(spark: SparkSession, d: str) -> DataFrame:
    return audit.status_share(table(spark, d, "events"), "user_id", "event_type")


def sequence_audit(spark: SparkSession, d: str) -> DataFrame:
    return audit.sequence_audit(table(spark, d, "lineitem"), "l_orderkey", "l_linenumber")


def sequence_runs(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "lineitem").select("l_suppkey", "l_partkey", "l_orderkey").distinct()
    return audit.sequence_runs(rows, "l_suppkey", "l_orderkey", ["l_partkey", "l_orderkey"])


def sequence_runs_by_offset(spark: SparkSession, d: str) -> DataFrame:
    events = table(spark, d, "events")
    return audit.sequence_runs(
        events, "event_type", "user_id", ["event_id"], offset_block(F.col("event_id"))
    )


def cadence_audit(spark: SparkSession, d: str) -> DataFrame:
    seconds = table(spark, d, "events").select(
        "user_id", epoch_seconds(F.col("ts")).alias("seconds")
    )
    return audit.cadence_audit(seconds, "user_id", "seconds")


def archive_counts(spark: SparkSession, d: str) -> DataFrame:
    dated = archive.with_partitions(table(spark, d, "events"), epoch_seconds(F.col("ts")))
    return dated.groupBy("event_type", "year", "month").agg(F.count(F.lit(1)).alias("n"))


def snapshot_lines(spark: SparkSession, d: str) -> DataFrame:
    view = latest.latest_per_key(table(spark, d, "events"), "user_id", "event_id", ["props"])
    return exports.snapshot_lines(view, "user_id", "props")


def document_lines(spark: SparkSession, d: str) -> DataFrame:
    return lines.to_lines(table(spark, d, "documents"), "doc_id", "text")


def count_lines(spark: SparkSession, d: str) -> DataFrame:
    return lines.count_lines(document_lines(spark, d), "line", "license")


def select_lines(spark: SparkSession, d: str) -> DataFrame:
    return lines.select_lines(document_lines(spark, d), "line", "license", "email", "the")


def pair_lines(spark: SparkSession, d: str) -> DataFrame:
    pairs = lines.pair_lines(document_lines(spark, d), "doc_id", "line_no", "line")
    return pairs.select("doc_id", "pair_no", "pair")


def pair_text(spark: SparkSession, d: str) -> DataFrame:
    pairs = lines.pair_text(table(spark, d, "documents"), "doc_id", "text")
    return pairs.select("doc_id", "pair_no", "pair")


def pair_selected_lines(spark: SparkSession, d: str) -> DataFrame:
    chosen = lines.select_lines(table(spark, d, "events"), "event_type", "view", "click", "error")
    return lines.pair_selected_lines(chosen, "user_id", "event_id", "event_type", "+")


def top_k(spark: SparkSession, d: str) -> DataFrame:
    return lines.top_k(table(spark, d, "events"), "user_id")


def top_k_weighted(spark: SparkSession, d: str) -> DataFrame:
    # Cents, so that the sum does not depend on the order of adding.
    cents = F.round(F.col("value") * 100).cast("bigint")
    return lines.top_k(table(spark, d, "events"), "user_id", weight=cents)


def top_words(spark: SparkSession, d: str) -> DataFrame:
    """The most frequent of very many different values, without shuffling all of them."""
    words = table(spark, d, "documents").select(F.explode(F.split("text", " ", -1)).alias("word"))
    return lines.top_k_sketched(words, "word")


def allocation_lines(spark: SparkSession, d: str) -> DataFrame:
    """Each event as three lines of a profiler report, one report per user."""
    text = F.array(
        F.concat(F.lit("startTime = "), F.col("ts").cast("string")),
        F.concat(F.lit("objectClass = "), F.col("event_type")),
        F.concat(F.lit("weight = "), F.get_json_object("props", "$.k"), F.lit(" kB")),
    )
    return (
        table(spark, d, "events")
        .select("user_id", "event_id", F.posexplode(text).alias("_i", "line"))
        .select("user_id", (F.col("event_id") * 3 + F.col("_i")).alias("line_no"), "line")
    )


def allocation_top_k(spark: SparkSession, d: str) -> DataFrame:
    return lines.allocation_top_k(allocation_lines(spark, d), "user_id", "line_no", "line")


def top_pairs(spark: SparkSession, d: str) -> DataFrame:
    """Select, pair, count: the most frequent class and weight of a profiler report."""
    chosen = ("objectClass", "weight")
    return lines.top_pairs(allocation_lines(spark, d), "user_id", "line_no", "line", *chosen, sep=" ")


def max_duration(spark: SparkSession, d: str) -> DataFrame:
    unit = F.element_at(F.array(*map(F.lit, ["us", "ms", "s"])), (F.col("user_id") % 3 + 1).cast("int"))
    line = F.concat_ws(" ", F.lit("duration ="), F.col("value").cast("string"), unit)
    return lines.max_duration(table(spark, d, "events").select(line.alias("line")), "line")


QUERIES = {
    f.__name__: f
    for f in (
        parquet_scan,
        latest_per_key,
        latest_orders,
        lookup,
        alert_filter,
        alert_render,
        route,
        default_key,
        classify_messages,
        dead_letters,
        parse_envelope,
        envelope_json,
        keyed_rows,
        normalise_value,
        normalise_spaced,
        adapt_feed,
        adapt_feed_by_offset,
        status_share,
        sequence_audit,
        sequence_runs,
        sequence_runs_by_offset,
        cadence_audit,
        archive_counts,
        snapshot_lines,
        count_lines,
        select_lines,
        pair_lines,
        pair_text,
        pair_selected_lines,
        top_k,
        top_k_weighted,
        top_words,
        allocation_top_k,
        top_pairs,
        max_duration,
    )
}

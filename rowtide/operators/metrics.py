"""The metric suite, computed from outcome rows.

Every counter is a partial plus final aggregate. ``counter_base`` and ``summary``
count by labels of low cardinality. The published-events counter has one row per
target subject, so it is an aggregate of its own and stays distributed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from rowtide.operators import classify as C
from rowtide.session import materialize

# Metric names, and the upper bounds of the duration buckets.
EVENTS_TOTAL = "cdc_consumer_events_total"
PUBLISH_ERRORS_TOTAL = "cdc_consumer_publish_errors_total"
EVENTS_PUBLISHED_TOTAL = "cdc_consumer_events_published_total"
DEDUP_HIT_TOTAL = "cdc_consumer_redis_hit_total"
PROCESSING_SECONDS = "cdc_consumer_processing_seconds"
LAG_SECONDS = "cdc_consumer_lag_seconds"
UNHANDLED_FIELDS_TOTAL = "cdc_consumer_unhandled_fields_total"
DEDUP_CHECKS_TOTAL = "cdc_consumer_deduplication_checks_total"
DURATION_BUCKETS = (0.005, 0.01, 0.025, 0.05, 0.1, 0.25, 0.5, 1.0, 2.5, 5.0, 10.0)
LATENCY_BUCKET_US = 50_000
EXTRA_RESULT = {
    "null_record": "typed_data_population_error",
    "type_mismatch": "typed_data_population_error",
    "empty_pk": "pk_extraction_error",
}


# The outcome columns that metrics read.
READ = (
    "result_table",
    "payload_table",
    "result",
    "error_code",
    "dedup",
    "disposition",
    "consumer_id",
    "target_subject",
    "unhandled_fields",
    "duration_s",
    "received_at",
    "acked_at",
)
_LABELS = ("result_table", "payload_table", "result", "error_code", "dedup")


def counter_base(out: DataFrame) -> DataFrame:
    """Deliveries by the labels of the small counters; a few hundred rows."""
    return out.groupBy(*_LABELS).agg(F.count("*").alias("n"))


def events_total(base: DataFrame) -> DataFrame:
    """Events by (table, result).

    The outcome counts under the subject's table; a row image that cannot be
    read or has no key counts a second time, under the payload's table.
    """
    extra = None
    for code, label in EXTRA_RESULT.items():
        cond = F.col("error_code") == code
        extra = F.when(cond, label) if extra is None else extra.when(cond, label)
    marks = F.array(
        F.struct(F.col("result_table").alias("table"), F.col("result")),
        F.when(extra.isNotNull(), F.struct(F.col("payload_table").alias("table"), extra.alias("result"))),
    )
    return (
        base.groupBy("result_table", "payload_table", "result", "error_code")
        .agg(F.sum("n").alias("n"))
        .select(F.explode(F.array_compact(marks)).alias("m"), "n")
        .groupBy("m.table", "m.result")
        .agg(F.sum("n").alias("value"))
    )


def publish_errors_total(base: DataFrame) -> DataFrame:
    """Failed publish attempts, each counted once."""
    return base.agg(
        F.coalesce(F.sum(F.when(F.col("result") == C.PUBLISH_ERROR, F.col("n"))), F.lit(0)).alias("value")
    )


def published_base(out: DataFrame) -> DataFrame:
    """Publish attempts by target subject; a row per chat, so apart from the small counters."""
    status = F.when(F.col("result") == C.PROCESSED, "success").when(
        F.col("result") == C.PUBLISH_ERROR, "failure"
    )
    tried = out.select(F.col("target_subject").alias("subject"), status.alias("status"))
    return tried.filter(F.col("status").isNotNull()).groupBy("subject", "status").agg(F.count("*").alias("value"))


def events_published_total(out: DataFrame) -> DataFrame:
    """Publish attempts by (subject, status)."""
    return published_base(out)


def dedup_cache_hits(base: DataFrame) -> DataFrame:
    """Lookups by hit or miss over all tables."""
    return (
        base.filter(F.col("dedup").isNotNull())
        .groupBy(F.col("dedup").alias("status"))
        .agg(F.sum("n").alias("value"))
    )


def dedup_checks_total(base: DataFrame) -> DataFrame:
    """Lookups by (payload table, hit or miss)."""
    return (
        base.filter(F.col("dedup").isNotNull())
        .groupBy(F.col("payload_table").alias("table"), F.col("dedup").alias("result"))
        .agg(F.sum("n").alias("value"))
    )


def unhandled_fields_total(classified: DataFrame) -> DataFrame:
    """Drift by (payload table, field) over all deliveries, duplicates included."""
    return (
        classified.select(F.col("payload_table").alias("table"), F.explode("unhandled_fields").alias("field"))
        .groupBy("table", "field")
        .agg(F.count("*").alias("value"))
    )


def processing_histogram(
    out: DataFrame, duration: str = "duration_s", buckets: tuple[float, ...] = DURATION_BUCKETS
) -> DataFrame:
    """Cumulative duration buckets per table, with sum and count.

    One aggregate per bound in a single pass, turned into rows afterwards, so
    the input is not multiplied by the number of buckets. Durations are summed
    as decimals of nanoseconds, which does not depend on row order.
    """
    base = out.filter(F.col("result") == C.PROCESSED).groupBy("result_table")
    return _histogram(base.agg(*_duration_parts(duration, buckets)), buckets)


def _duration_parts(duration: str, buckets: tuple[float, ...]) -> list[Column]:
    """Aggregates that add up over any grouping: sum, count and one count per bound."""
    d = F.col(duration)
    return [
        F.sum(d.cast("decimal(28,9)")).alias("d_sum"),
        F.count(d).alias("d_count"),
        *[F.count_if(d <= F.lit(b)).alias(f"d_le{i}") for i, b in enumerate([*buckets, float("inf")])],
    ]


def _histogram(parts: DataFrame, buckets: tuple[float, ...]) -> DataFrame:
    bounds = [*buckets, float("inf")]
    sums = [F.sum(c).alias(c) for c in ("d_sum", "d_count", *[f"d_le{i}" for i in range(len(bounds))])]
    counted = parts.groupBy(F.col("result_table").alias("table")).agg(*sums)
    cells = F.array(
        *[
            F.struct(F.lit(bound_label(b)).alias("le"), F.col(f"d_le{i}").alias("bucket_count"))
            for i, b in enumerate(bounds)
        ]
    )
    return counted.select("table", F.explode(cells).alias("c"), "d_sum", "d_count").select(
        "table",
        "c.le",
        "c.bucket_count",
        F.col("d_sum").cast("double").alias("sum_seconds"),
        F.col("d_count").alias("total_count"),
    )


def bound_label(bound: float) -> str:
    return "+Inf" if bound == float("inf") else f"{bound:g}"


def consumer_lag(out: DataFrame, delivered: str = "received_at", acked: str = "acked_at") -> DataFrame:
    """The largest delivery-to-ack latency, in seconds, per consumer replica."""
    lag = F.max(F.unix_micros(acked) - F.unix_micros(delivered)) / F.lit(1_000_000)
    return out.filter(F.col("disposition") == "ack").groupBy("consumer_id").agg(lag.alias("lag_seconds"))


def summary(out: DataFrame) -> DataFrame:
    """Everything the small metrics need, by their labels, consumer and disposition.

    A few thousand rows whatever the input. Summaries of parts of an outcome
    table may be put together: all metrics add them up.
    """
    lag = F.max(F.unix_micros("acked_at") - F.unix_micros("received_at")).alias("lag_us")
    return out.groupBy(*_LABELS, "consumer_id", "disposition").agg(
        F.count("*").alias("n"), lag, *_duration_parts("duration_s", DURATION_BUCKETS)
    )


def merge_summaries(parts: DataFrame) -> DataFrame:
    """Summaries of several parts as one."""
    adds = [c for c in parts.columns if c == "n" or c.startswith("d_")]
    sums = [F.sum(c).cast(parts.schema[c].dataType).alias(c) for c in adds]
    return parts.groupBy(*_LABELS, "consumer_id", "disposition").agg(F.max("lag_us").alias("lag_us"), *sums)


def lag_part(out: DataFrame) -> DataFrame:
    """The largest delivery-to-ack latency per consumer of one batch."""
    lag = F.max(F.unix_micros("acked_at") - F.unix_micros("received_at")).alias("lag_us")
    return out.filter(F.col("disposition") == "ack").groupBy("consumer_id").agg(lag)


def last_lag(parts: DataFrame) -> DataFrame:
    """A gauge: what the last batch with a value says, not a sum or maximum over batches."""
    timed = parts.filter(F.col("lag_us").isNotNull()).groupBy("consumer_id")
    return timed.agg((F.max_by("lag_us", "batch") / F.lit(1_000_000)).alias("lag_seconds"))


def metrics_snapshot(out: DataFrame) -> DataFrame:
    """All metrics in long form ``(metric, labels, value)``; reads ``out`` three times."""
    return snapshot_of(materialize(summary(out), "metrics"), published_base(out), unhandled_fields_total(out))


def snapshot_of(small: DataFrame, published: DataFrame, drift: DataFrame) -> DataFrame:
    """The snapshot from summaries, publish attempts by subject and drift counts, each in one or more parts."""
    base = small.groupBy(*_LABELS).agg(F.sum("n").alias("n"))
    attempts = published.groupBy("subject", "status").agg(F.sum("value").alias("value"))
    drifted = drift.groupBy("table", "field").agg(F.sum("value").alias("value"))
    acked = small.filter(F.col("disposition") == "ack").groupBy("consumer_id")
    lag = acked.agg((F.max("lag_us") / F.lit(1_000_000)).alias("lag_seconds"))

    def rows(df: DataFrame, metric: str, labels: dict[str, str], value: Column) -> DataFrame:
        pairs = [F.lit(p) if i % 2 == 0 else F.col(p) for kv in labels.items() for i, p in enumerate(kv)]
        made = F.create_map(*pairs) if pairs else F.create_map().cast("map<string,string>")
        return df.select(F.lit(metric).alias("metric"), made.alias("labels"), value.cast("double").alias("value"))

    v = F.col("value")
    histogram = _histogram(small.filter(F.col("result") == C.PROCESSED), DURATION_BUCKETS)
    totals = histogram.filter(F.col("le") == "+Inf")
    parts = [
        rows(events_total(base), EVENTS_TOTAL, {"table": "table", "result": "result"}, v),
        rows(publish_errors_total(base), PUBLISH_ERRORS_TOTAL, {}, v),
        rows(
            attempts,
            EVENTS_PUBLISHED_TOTAL,
            {"subject": "subject", "status": "status"},
            v,
        ),
        rows(dedup_cache_hits(base), DEDUP_HIT_TOTAL, {"status": "status"}, v),
        rows(dedup_checks_total(base), DEDUP_CHECKS_TOTAL, {"table": "table", "result": "result"}, v),
        rows(
            drifted,
            UNHANDLED_FIELDS_TOTAL,
            {"table": "table", "field_name": "field"},
            v,
        ),
        rows(histogram, PROCESSING_SECONDS + "_bucket", {"table": "table", "le": "le"}, F.col("bucket_count")),
        rows(totals, PROCESSING_SECONDS + "_sum", {"table": "table"}, F.col("sum_seconds")),
        rows(totals, PROCESSING_SECONDS + "_count", {"table": "table"}, F.col("total_count")),
        rows(lag, LAG_SECONDS, {"consumer": "consumer_id"}, F.col("lag_seconds")),
    ]
    snapshot = parts[0]
    for part in parts[1:]:
        snapshot = snapshot.unionByName(part)
    return snapshot


def metric_lookup(snapshot: DataFrame, metric: str, labels: dict[str, str]) -> DataFrame:
    """The value with exactly these labels; no row when there is none."""
    same = F.size("labels") == len(labels)
    for name, value in labels.items():
        same = same & (F.col("labels")[name] == value)
    return snapshot.filter((F.col("metric") == metric) & same)


def label_text(labels: Column) -> Column:
    """Labels as sorted ``name=value`` pairs."""
    pairs = F.transform(F.map_entries(labels), lambda e: F.concat(e["key"], F.lit("="), e["value"]))
    return F.array_join(F.array_sort(pairs), ",")


def slo_report(
    out: DataFrame,
    window: str = "1 hour",
    latency_target_s: float = 0.060,
    throughput_target: float = 5000.0,
) -> DataFrame:
    """P95 latency and events per second of each time window against targets.

    The percentile is exact, interpolated between the two nearest latencies.
    These are found in two steps: a count per window and coarse latency bucket
    names the buckets that hold them, and only those are ordered, each bounded
    by the microseconds it spans.
    """
    micros = F.unix_micros("acked_at") - F.unix_micros("received_at")
    timed = out.filter(F.col("result") == C.PROCESSED).select(
        F.window("received_at", window).alias("w"), micros.alias("us")
    )
    # Counted by latency and written once: the input may be a long chain of joins.
    timed = materialize(timed.groupBy("w", "us").agg(F.count("*").alias("n")), "latencies")
    timed = timed.withColumn("b", F.floor(F.col("us") / LATENCY_BUCKET_US))
    cells = timed.groupBy("w", "b").agg(
        F.sum("n").alias("events"), F.coalesce(F.sum(F.when(F.col("us").isNotNull(), F.col("n"))), F.lit(0)).alias("c")
    )
    totals = cells.groupBy("w").agg(F.sum("events").alias("events"), F.sum("c").alias("timed"))
    totals = totals.withColumn("rank", (F.col("timed") - 1) * F.lit(0.95))
    ends = totals.withColumns({"low": F.floor("rank"), "high": F.ceil("rank")})
    before = Window.partitionBy("w").orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    placed = cells.filter("c > 0").withColumn("start", F.coalesce(F.sum("c").over(before), F.lit(0)))
    wanted = placed.join(ends, "w").filter(
        ((F.col("start") <= F.col("low")) & (F.col("low") < F.col("start") + F.col("c")))
        | ((F.col("start") <= F.col("high")) & (F.col("high") < F.col("start") + F.col("c")))
    )
    fine = timed.join(wanted.select("w", "b", "start", "low", "high"), ["w", "b"])
    upto = Window.partitionBy("w", "b").orderBy("us")
    fine = fine.withColumn("upto", F.col("start") + F.sum("n").over(upto))

    def at(rank: str) -> Column:
        return F.min(F.when(F.col("upto") > F.col(rank), F.col("us")))

    found = fine.groupBy("w").agg(at("low").alias("below"), at("high").alias("above"))
    between = F.col("below") + (F.col("above") - F.col("below")) * (F.col("rank") - F.col("low"))
    span = F.unix_timestamp(F.col("w.end")) - F.unix_timestamp(F.col("w.start"))
    report = ends.join(found, "w", "left").withColumn("p95_latency_s", between / F.lit(1_000_000))
    return report.select(
        F.col("w.start").alias("window_start"),
        F.col("w.end").alias("window_end"),
        "events",
        (F.col("events") / span).alias("events_per_s"),
        "p95_latency_s",
        (F.col("p95_latency_s") <= latency_target_s).alias("latency_met"),
        (F.col("events") / span >= throughput_target).alias("throughput_met"),
    )


# What a micro-batch counts, and how the parts of many batches become one.
PARTS = {
    "summary": summary,
    "published": published_base,
    "drift": unhandled_fields_total,
    "lag": lag_part,
}
FOLDS = {
    "summary": merge_summaries,
    "published": lambda parts: parts.groupBy("subject", "status").agg(F.sum("value").alias("value")),
    "drift": lambda parts: parts.groupBy("table", "field").agg(F.sum("value").alias("value")),
    "lag": lambda parts: parts.groupBy("consumer_id").agg(F.max_by("lag_us", "batch").alias("lag_us")),
}

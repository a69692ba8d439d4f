"""Monitoring (ops 59-63, 77): metric roll-ups and alarm rules.

Metrics are rows ``(ts, metric, value)`` with ``ts`` in epoch seconds.
Roll-ups are tumbling-window aggregations (partial aggregation, then a
shuffle of one row per metric and period).  Alarms need consecutive
periods, so the aggregated series is laid on a dense period grid and runs
of breaching periods are counted; windows run over aggregated rows only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from recoflow import constants as C

PERIOD = C.METRIC_PERIOD_SECONDS


def period_start(ts, seconds: int = PERIOD):
    t = F.col(ts) if isinstance(ts, str) else ts
    return (F.floor(t / seconds) * seconds).cast("long")


#: Statistics that a rule may name, and their columns in a roll-up.
STATISTICS = {"sum": "sum", "max": "maximum", "avg": "average", "p95": "p95"}


def statistics() -> list[Column]:
    """The aggregates of a roll-up. The percentile is exact; its state is the distinct values of one
    metric and period (``metric_sketch`` is the bounded, mergeable form)."""
    return [F.sum("value").alias("sum"), F.max("value").alias("maximum"), F.avg("value").alias("average"),
            F.percentile("value", F.lit(0.95)).alias("p95"), F.count(F.lit(1)).alias("samples")]


def metric_rollup(metrics: DataFrame, seconds: int = PERIOD) -> DataFrame:
    """59: per metric and period: sum, maximum, average, 95th percentile and sample count."""
    return metrics.groupBy("metric", period_start("ts", seconds).alias("period")).agg(*statistics())


SKETCH_K = 400   # KLL: rank error below 1.33 % in single quantiles at 99 % confidence by its paper's bound for k = 200; half of it here


def metric_sketch(metrics: DataFrame, seconds: int = PERIOD, k: int = SKETCH_K) -> DataFrame:
    """59 with a mergeable quantile sketch per metric and period: ``sketch`` (KLL, a few
    kilobytes however many samples), beside what merges by itself (sum, maximum, samples)."""
    return metrics.groupBy("metric", period_start("ts", seconds).alias("period")).agg(
        F.sum("value").alias("sum"), F.max("value").alias("maximum"), F.count(F.lit(1)).alias("samples"),
        F.kll_sketch_agg_double("value", k).alias("sketch"))


def merge_sketches(sketches: DataFrame, seconds: int, k: int = SKETCH_K) -> DataFrame:
    """Coarser periods (a multiple of the given ones') from finer ones, without the samples."""
    return sketches.groupBy("metric", period_start("period", seconds).alias("period")).agg(
        F.sum("sum").alias("sum"), F.max("maximum").alias("maximum"), F.sum("samples").alias("samples"),
        F.kll_merge_agg_double("sketch", k).alias("sketch"))


def sketch_rollup(sketches: DataFrame) -> DataFrame:
    """The columns of ``metric_rollup`` from sketches; ``p95`` is a sample whose rank is within the sketch's error."""
    return sketches.select("metric", "period", "sum", "maximum", (F.col("sum") / F.col("samples")).alias("average"),
                           F.kll_sketch_get_quantile_double("sketch", F.lit(0.95)).alias("p95"), "samples")


def alarm_rules(spark: SparkSession, rules=C.ALARM_RULES) -> DataFrame:
    """Rules without a missing-data treatment get the service's default, 'missing'."""
    return spark.createDataFrame(
        [r if len(r) == 6 else (*r, "missing") for r in rules],
        "alarm string, metric string, stat string, threshold double, periods int, missing string")


def alarm_rule(rollup: DataFrame, rules: DataFrame, seconds: int = PERIOD, until: int | None = None) -> DataFrame:
    """60: per alarm and period: the statistic, whether it breaches, and
    whether the alarm fires (N consecutive breaching periods).

    The grid spans each metric's first to last period (or the period ``until``, if later); periods without
    data have a NULL statistic and do not breach. Where the rule's
    ``missing`` is 'notBreaching' they end a run; else ('missing') they
    are passed over and the alarm keeps its state. A statistic that is not one of
    ``STATISTICS`` fails the job. The stream form is ``streaming.alarms``.
    """
    last = F.max("period") if until is None else F.greatest(F.max("period"), F.lit(until).cast("long"))
    span = rollup.groupBy("metric").agg(F.min("period").alias("lo"), last.alias("hi"))
    grid = span.select("metric", F.explode(F.sequence("lo", "hi", F.lit(seconds).cast("long")))
                       .alias("period"))
    dense = grid.join(rollup, ["metric", "period"], "left")
    r = dense.join(rules, "metric")
    stat = F.raise_error(F.concat(F.lit("unknown statistic "), F.coalesce("stat", F.lit("null")))).cast("double")
    for name, column in STATISTICS.items():
        stat = F.when(F.col("stat") == name, F.col(column)).otherwise(stat)
    breach = F.coalesce(stat >= F.col("threshold"), F.lit(False))
    w = Window.partitionBy("alarm").orderBy("period")
    r = r.withColumn("value", stat).withColumn("breaching", breach)
    # a run's length is the number of breaches since the last calm period;
    # it is compared with the rule's own N, whatever N is
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    calm = ~F.col("breaching") & (F.col("value").isNotNull() | (F.col("missing") == "notBreaching"))
    r = r.withColumn("breaches", F.count_if(F.col("breaching")).over(upto))
    before = F.max(F.when(calm, F.col("breaches"))).over(upto)
    run = F.col("breaches") - F.coalesce(before, F.lit(0))
    return r.select("alarm", "metric", "period", "value", "breaching",
                    (run >= F.col("periods")).alias("in_alarm"))


def tps(metrics: DataFrame, metric: str = "GetRecommendations", seconds: int = PERIOD) -> DataFrame:
    """61: requests per period divided by the period length."""
    return (metrics.filter(F.col("metric") == metric)
            .groupBy(period_start("ts", seconds).alias("period"))
            .agg((F.sum("value") / F.lit(float(seconds))).alias("tps")))


def recommendations_used(events: DataFrame, seconds: int = PERIOD) -> DataFrame:
    """63: events carrying a recommendation id, per period."""
    return (events.groupBy(period_start("ts", seconds).alias("period"))
            .agg(F.count_if(F.col("page_rid").isNotNull()).alias("used")))


def recommendation_use_rate(metrics: DataFrame, used: DataFrame, seconds: int = 3600) -> DataFrame:
    """62: used / (requests / 2) * 100 per hour (NULL without requests)."""
    req = (metrics.filter(F.col("metric") == "GetRecommendations")
           .groupBy(period_start("ts", seconds).alias("period"))
           .agg(F.sum("value").alias("requests")))
    u = (used.groupBy(period_start("period", seconds).alias("period"))
         .agg(F.sum("used").alias("used")))
    j = req.join(u, "period", "full_outer")
    return j.select("period", F.coalesce("used", F.lit(0)).cast("long").alias("used"),
                    F.coalesce("requests", F.lit(0.0)).alias("requests"),
                    F.when(F.col("requests") > 0,
                           F.coalesce("used", F.lit(0)) / (F.col("requests") / 2) * 100)
                    .alias("use_rate"))


def lag_samples(arrivals: DataFrame) -> DataFrame:
    """Metric rows of consumer lag (ms); ``arrivals``: ``stream``, ``event_ms``, ``arrival_ms`` per record."""
    return arrivals.select(F.floor(F.col("arrival_ms") / 1000).cast("long").alias("ts"), F.col("stream").alias("metric"),
                           (F.col("arrival_ms") - F.col("event_ms")).cast("double").alias("value"))


def stream_lag(arrivals: DataFrame, seconds: int = PERIOD, threshold_ms: int = C.LAG_ALARM_MS,
               periods: int = 10, missing: str = "missing") -> DataFrame:
    """77: consumer lag per stream and period (max of arrival - event time,
    ms) and the lag alarm over ``periods`` consecutive periods (10 for
    events, 1 for content): the roll-up (59) and the alarm rule (60) of the lag samples.
    """
    rollup = metric_rollup(lag_samples(arrivals), seconds)
    rules = rollup.select("metric").distinct().select(
        F.col("metric").alias("alarm"), "metric", F.lit("max").alias("stat"), F.lit(float(threshold_ms)).alias("threshold"),
        F.lit(periods).alias("periods"), F.lit(missing).alias("missing"))
    return alarm_rule(rollup, rules, seconds).select(
        F.col("metric").alias("stream"), "period", F.col("value").cast("long").alias("max_lag_ms"), "breaching", "in_alarm")


def counter_samples(counters: DataFrame, stream: str, ts: Column) -> DataFrame:
    """Metric rows of the ingest counters (57) of a stream (``PutEvents``, ``PutContent``)."""
    kinds = F.array(*(F.struct(F.lit(stream + name).alias("metric"), F.col(c).cast("double").alias("value"))
                      for name, c in (("Success", "success"), ("Errors", "fail"), ("Skipped", "skip"))))
    return counters.select(ts.cast("long").alias("ts"), F.inline(kinds))


def use_rate_samples(rate: DataFrame) -> DataFrame:
    """Metric rows of the recommendation use rate (62); hours without requests have none."""
    return rate.where(F.col("use_rate").isNotNull()).select(
        F.col("period").alias("ts"), F.lit("RecommendationUseRate").alias("metric"), F.col("use_rate").alias("value"))


def coverage_samples(coverage: DataFrame, ts: Column) -> DataFrame:
    """Metric rows of the serving job: one sample per request and measure;
    the fallback counts only where it was used."""
    def sample(metric: str, value: Column) -> Column:
        return F.struct(F.lit(metric).alias("metric"), value.cast("double").alias("value"))

    backup = F.col("backup")
    samples = F.array(
        sample("GetRecommendations", F.lit(1)), sample("ReturnRecommendations", F.col("returned")),
        sample("MissingRecommendations", F.col("missing")),
        sample("MissingDataMetadata", F.col("missing_metadata")),
        sample("MissingDataImages", F.col("missing_images")),
        sample("ReturnBackupRecommendations", F.when(backup > 0, backup)))
    return (coverage.select(ts.cast("long").alias("ts"), F.inline(samples))
            .filter(F.col("value").isNotNull()))

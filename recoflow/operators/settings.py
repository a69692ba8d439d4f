"""Backend settings: context maps, backend choice, fan-out (ops 9, 52-55, 72).

The settings table is configuration: one row per deployed backend.  It
is still treated as data (read, filtered, joined) so the same code runs
when it lives in a table.  Joins are left to adaptive execution; lists that
every row needs come as one array value (a scalar subquery).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recoflow import constants as C

def filter_specs(spark: SparkSession, specs=C.FILTER_SPECS) -> DataFrame:
    """The filter configuration as a DataFrame (one row per filter)."""
    rows = [(s["context"], s["name"], s["filter_values"], s["limit_time_range"],
             s["include_time_range_for_sections"]) for s in specs]
    return spark.createDataFrame(
        rows, "context string, name string, filter_values array<string>, "
              "limit_time_range boolean, include_time_range_for_sections array<string>")


def build_context_map(settings: DataFrame, filters: DataFrame) -> DataFrame:
    """72: per backend, a ``context`` map from request context to filter settings.

    Every backend gets a ``default`` entry (its ``-unread`` filter); a filter
    whose context is ``default`` replaces it.  The filter list reaches every backend row as one
    array value (scalar subquery) that is exploded: no join.
    """
    specs = (filters.filter(F.col("context").isNotNull())
             .select(F.collect_list(F.struct(
                 "context", F.col("name").alias("fname"), "filter_values", "limit_time_range",
                 "include_time_range_for_sections"))).scalar())
    entries = (settings.select("name", F.explode(specs).alias("f"))
               .select("name", F.col("f.context").alias("context"), F.struct(
                   F.concat(F.col("name"), F.lit("-"), F.col("f.fname")).alias("filter_name"),
                   F.col("f.fname").alias("kind"),
                   F.col("f.filter_values").alias("filter_values"),
                   F.col("f.limit_time_range").alias("limit_time_range"),
                   F.col("f.include_time_range_for_sections")
                   .alias("include_time_range_for_sections")).alias("v")))
    default = settings.select("name", F.lit(C.DEFAULT_CONTEXT).alias("context"), F.struct(
        F.concat(F.col("name"), F.lit("-" + C.DEFAULT_FILTER_SUFFIX)).alias("filter_name"),
        F.lit(C.DEFAULT_FILTER_SUFFIX).alias("kind"),
        F.lit(None).cast("array<string>").alias("filter_values"),
        F.lit(None).cast("boolean").alias("limit_time_range"),
        F.lit(None).cast("array<string>").alias("include_time_range_for_sections")).alias("v"))
    # configured entries win over the generated default
    merged = (default.withColumn("prio", F.lit(0))
              .unionByName(entries.withColumn("prio", F.lit(1)))
              .groupBy("name", "context").agg(F.max_by("v", "prio").alias("v")))
    ctx = merged.groupBy("name").agg(
        F.map_from_entries(F.collect_list(F.struct("context", "v"))).alias("context"))
    return settings.join(ctx, "name", "left")


def context_entries(settings_with_ctx: DataFrame) -> DataFrame:
    """Flat view of the context maps: (name, context, filter settings...)."""
    return (settings_with_ctx.select("name", F.explode("context").alias("context", "v"))
            .select("name", "context", "v.*"))


def assign_backend(requests: DataFrame, active: DataFrame, key: str = "request_id",
                   mode: str = "modulo") -> DataFrame:
    """55: weighted backend choice per request, repeatable.

    Weights: ``trafficRatio % 100 + 1`` (``mode='modulo'``, as deployed, where
    100 means weight 1) or ``trafficRatio`` itself (``'proportional'``).
    Backends are laid on [0, total) in ``backend_order``; a request falls
    at ``pmod(key, total)`` (numeric key) or ``pmod(hash(key), total)``.
    The backends come as one ordered array value and each request walks it:
    no join, no window, and the requests are never shuffled.  Without an
    active backend the choice is NULL.
    """
    ratio = F.col("trafficRatio").cast("int")
    weight = (F.pmod(ratio, F.lit(100)) + 1) if mode == "modulo" else ratio
    spans = active.select(F.sort_array(F.collect_list(
        F.struct("backend_order", "name", weight.cast("long").alias("w"))))).scalar()
    k = F.col(key)
    point = k.cast("long") if _numeric(requests, key) else F.hash(k).cast("long")
    laid = requests.withColumn("__spans", spans)
    total = F.aggregate("__spans", F.lit(0).cast("long"), lambda acc, s: acc + s["w"])
    laid = laid.withColumn("__total", total)
    at = F.when(F.col("__total") > 0, F.pmod(point, F.col("__total")))
    # what is left of the point after each span; the span in which it runs out is chosen
    chosen = F.aggregate(
        "__spans", F.struct(at.alias("left"), F.lit(None).cast("string").alias("name")),
        lambda acc, s: F.struct(
            (acc["left"] - s["w"]).alias("left"),
            F.when((acc["left"] >= 0) & (acc["left"] < s["w"]), s["name"]).otherwise(acc["name"]).alias("name")),
        lambda acc: acc["name"])
    return laid.withColumn("backend", chosen).drop("__spans", "__total")


def _numeric(df: DataFrame, c: str) -> bool:
    return df.schema[c].dataType.typeName() in ("long", "integer", "short", "byte")


def targets(active: DataFrame, target: str) -> list[str]:
    """The active backends' targets, in order; backends without one are left out. Settings
    hold a row per deployed backend."""
    return [r[0] for r in active.select(target).where(F.col(target).isNotNull()).orderBy(target).collect()]


def fanout(df: DataFrame, active: DataFrame | list[str], target: str, alias: str) -> DataFrame:
    """52/53: every row once per active backend target.

    The target list (given, or a scalar subquery over the active settings: one array value
    computed once and shipped with the plan) is exploded per row: the output is the required
    product, generated locally in each task without a join.  Without an active
    backend the batch fails: its rows would be lost.
    """
    if isinstance(active, list):
        found = F.array(*(F.lit(t) for t in active)).cast("array<string>")
    else:
        found = active.select(F.array_sort(F.collect_list(F.col(target)))).scalar()
    none = F.raise_error(F.lit("no active backend to deliver to")).cast("array<string>")
    return df.withColumn(alias, F.explode(F.when(F.size(found) > 0, found).otherwise(none)))


def fanout_events(events: DataFrame, active: DataFrame | list[str]) -> DataFrame:
    """52: valid events x active trackers."""
    return fanout(events, active, "eventTrackerId", "trackingId")


def fanout_items(items: DataFrame, active: DataFrame | list[str]) -> DataFrame:
    """53: valid items x active item datasets."""
    return fanout(items, active, "datasetArn", "datasetArn_target")


def context_lookup(requests: DataFrame, settings_with_ctx: DataFrame,
                   context: str = "context", backend: str = "backend") -> DataFrame:
    """54: the filter settings for a request's context, else the backend's default.

    An equi-join on the backend; the lookup is a map access per row.
    """
    ctx = settings_with_ctx.select(F.col("name").alias("__backend"),
                                   F.col("context").alias("__ctx_map"),
                                   "campaignArn")
    joined = requests.join(ctx, F.col(backend) == F.col("__backend"), "left")
    m = F.col("__ctx_map")
    entry = F.coalesce(F.try_element_at(m, F.col(context)),
                       F.try_element_at(m, F.lit(C.DEFAULT_CONTEXT)))
    return joined.withColumn("filter", entry).drop("__backend", "__ctx_map")


def time_range_rule(filter_col: Column, category: Column) -> Column:
    """47: dated filter on when the context says so (default on), or when the
    context filters by category and the request's category is in the
    context's section list."""
    base = F.coalesce(filter_col["limit_time_range"], F.lit(True))
    by_section = F.coalesce(F.array_contains(filter_col["include_time_range_for_sections"], category),
                            F.lit(False))
    return base | (uses_category(filter_col) & by_section)


def uses_category(filter_col: Column) -> Column:
    """Whether the context's filter takes the ``category`` value."""
    return F.coalesce(F.array_contains(filter_col["filter_values"], "category"), F.lit(False))

"""Candidate filtering, top-k and fallback (ops 43-46, 51, 68, 69).

A candidate is a (request, item, score) row.  The filter expressions of
the deployment are applied as joins and predicates:

* ``category``: INCLUDE Category IN ($category); EXCLUDE page-viewed;
  EXCLUDE Exclude = 1
* ``unread``:   INCLUDE CREATION_TIMESTAMP > 0; same excludes
* ``exclcat``:  as unread, plus EXCLUDE Category IN ($category)
* dated variants add EXCLUDE CREATION_TIMESTAMP < midnight(as_of - 3 days)

NULL rules: ``Exclude`` NULL is kept; a NULL Category fails an INCLUDE IN
and passes an EXCLUDE IN; a NULL creation time fails ``> 0``.  Items
missing from the items dataset have NULL attributes and so fail the
INCLUDE clauses, like items the service does not know.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recoflow import constants as C
from recoflow.operators import filters


def item_attributes(items: DataFrame) -> DataFrame:
    return items.select(F.col("ITEM_ID").alias("item_id"),
                        F.col("Category").alias("item_category"),
                        F.col("Exclude").alias("item_exclude"),
                        F.col("CREATION_TIMESTAMP").alias("item_created"))


def with_item_attributes(cands: DataFrame, items: DataFrame) -> DataFrame:
    """Attach item attributes (left join: unknown items get NULLs).

    The items side is catalogue-sized; the join strategy is left to AQE,
    which broadcasts it when its measured size is under the threshold.
    """
    return cands.join(item_attributes(items), "item_id", "left")


def _no(c: Column) -> Column:
    """EXCLUDE clause: drop only when the condition is true."""
    return ~F.coalesce(c, F.lit(False))


def _yes(c: Column) -> Column:
    """INCLUDE clause: keep only when the condition is true."""
    return F.coalesce(c, F.lit(False))


def include_category(category: str = "category") -> Column:
    return _yes(F.col("item_category") == F.col(category))


def include_created() -> Column:
    return _yes(F.col("item_created") > 0)


def exclude_category(category: str = "category") -> Column:
    return _no(F.col("item_category") == F.col(category))


def exclude_flagged() -> Column:
    return _no(F.col("item_exclude") == 1)


def exclude_viewed(cands: DataFrame, interactions: DataFrame, user: str = "user_id") -> DataFrame:
    """51: drop items the user already page-viewed (anti join on user, item)."""
    viewed = (interactions.filter(F.col("EVENT_TYPE") == C.PAGE_VIEW)
              .select(F.col("USER_ID").alias("__vu"), F.col("ITEM_ID").alias("__vi")).distinct())
    cond = (F.col(user) == F.col("__vu")) & (F.col("item_id") == F.col("__vi"))
    return cands.join(viewed, cond, "left_anti")


CLAUSES = {
    "include_category": include_category,
    "include_created": lambda category: include_created(),
    "exclude_category": exclude_category,
    "exclude_flagged": lambda category: exclude_flagged(),
}


def clauses_predicate(clauses, category: str = "category") -> Column:
    """All clauses of one filter; an unknown clause is an error."""
    unknown = set(clauses) - set(CLAUSES)
    if unknown or not clauses:
        raise ValueError(f"unknown or no filter clauses: {sorted(unknown)}")
    return reduce(and_, [CLAUSES[c](category) for c in clauses])


def kind_predicate(kind: str = "kind", category: str = "category", specs=C.FILTER_SPECS) -> Column:
    """The clauses of each filter kind, on attached attributes; rows of a
    kind without a spec fail the job."""
    bad = F.raise_error(F.concat(F.lit("no filter spec named "), F.coalesce(F.col(kind), F.lit("null"))))
    out = F
    for s in specs:
        out = out.when(F.col(kind) == s["name"], clauses_predicate(s["clauses"], category))
    return out.otherwise(bad.cast("boolean"))


def known_kind(kind: str = "kind", specs=C.FILTER_SPECS) -> Column:
    """True; rows of a kind without a spec fail the job."""
    bad = F.raise_error(F.concat(F.lit("no filter spec named "), F.coalesce(F.col(kind), F.lit("null"))))
    return F.when(F.col(kind).isin([s["name"] for s in specs]), True).otherwise(bad.cast("boolean"))


def kinds_with(clause: str, specs=C.FILTER_SPECS) -> list[str]:
    return [s["name"] for s in specs if clause in s["clauses"]]


def item_filter_category(cands, items, interactions, category="category"):
    """43: INCLUDE Category IN ($c); EXCLUDE viewed; EXCLUDE Exclude = 1."""
    c = with_item_attributes(cands, items).filter(include_category(category) & exclude_flagged())
    return exclude_viewed(c, interactions)


def item_filter_unread(cands, items, interactions):
    """44: INCLUDE CREATION_TIMESTAMP > 0; EXCLUDE viewed; EXCLUDE Exclude = 1."""
    c = with_item_attributes(cands, items).filter(include_created() & exclude_flagged())
    return exclude_viewed(c, interactions)


def item_filter_exclcat(cands, items, interactions, category="category"):
    """45: as unread, plus EXCLUDE Category IN ($c)."""
    c = with_item_attributes(cands, items).filter(
        include_created() & exclude_category(category) & exclude_flagged())
    return exclude_viewed(c, interactions)


def passes_age(as_of) -> Column:
    """46 on attached attributes."""
    return filters.passes_age(as_of, created="item_created")


def topk_per_request(cands: DataFrame, n: str | int, key: str = "request_id",
                     score: str = "score", item: str = "item_id") -> DataFrame:
    """68: the best ``n`` rows per request by (score desc, item asc), ranked.

    ``n`` may be a column (each request's own count).  With a constant ``n``
    Spark applies the limit per partition before the window's shuffle.
    """
    w = Window.partitionBy(key).orderBy(F.col(score).desc(), F.col(item).asc())
    limit = F.lit(n) if isinstance(n, int) else F.col(n)
    return cands.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= limit)


def ranked_lists(cands: DataFrame, cap: int = C.MAX_RESULTS, key: str = "lkey") -> DataFrame:
    """68 for shared lists: the best rows of each list key, ranked twice.

    ``variant`` False ranks all rows (undated filter), True only the rows
    that pass the age clause (dated filter); both are cut at ``cap``, the
    service maximum, so no request can need more and the cut is exact.
    Each ranking has a limit of its own, which every task applies before
    the shuffle; the count of age-passing rows per key (it decides the
    fallback) is a combined aggregate. No task holds a key's whole list.
    """
    def top(rows: DataFrame, variant: bool) -> DataFrame:
        return topk_per_request(rows, cap, key).select(
            key, "item_id", "score", F.lit(variant).alias("variant"), "rank")

    counts = cands.groupBy(key).agg(F.count_if(F.col("age_ok")).alias("n_dated"))
    return top(cands, False).unionByName(top(cands.filter("age_ok"), True)).join(counts, key)


def best_by_category(scored: DataFrame, segment: list[str], as_of, specs=C.FILTER_SPECS, cap: int = C.MAX_RESULTS) -> DataFrame:
    """For every filter kind that takes no category in: the best ``cap`` rows of each segment and item category, of all
    rows and of those that pass the age clause. A list without one category is the merge of the others, so it reads
    these rows only, however many categories are left out in turn; cutting at ``cap`` is exact as in ``ranked_lists``.
    """
    out = None
    for s in specs:
        if "include_category" in s["clauses"]:
            continue
        fixed = [c for c in s["clauses"] if c != "exclude_category"]
        rows = scored.filter(clauses_predicate(fixed)) if fixed else scored
        rows = rows.withColumn("kind", F.lit(s["name"]))
        out = rows if out is None else out.unionByName(rows)
    out = out.withColumn("age_ok", passes_age(as_of))
    w = Window.partitionBy(*segment, "kind", "item_category").orderBy(F.col("score").desc(), "item_id")

    def top(rows: DataFrame) -> DataFrame:
        return rows.withColumn("__rank", F.row_number().over(w)).filter(F.col("__rank") <= cap).drop("__rank")

    return top(out).unionByName(top(out.filter("age_ok"))).distinct()


def serve_lists(keyed: DataFrame, lists: DataFrame, key: str = "lkey") -> DataFrame:
    """69 per request: the dated list unless it is empty, its first ``num_results`` rows.

    ``keyed``: request_id, list key, dated, num_results.  A request that
    asked for the dated filter and whose list has no age-passing item falls
    back to the undated list (``backup``).  The join is on the list key;
    variant choice and prefix length are post-join conditions.  A key
    shared by many requests is a skewed join key, which AQE's skew-join
    handling splits across tasks.
    """
    r, l_ = keyed.alias("r"), lists.alias("l")
    j = r.join(l_, F.col(f"r.{key}") == F.col(f"l.{key}"))
    use_dated = F.col("r.dated") & (F.col("l.n_dated") > 0)
    return (j.filter((F.col("l.variant") == use_dated) & (F.col("l.rank") <= F.col("r.num_results")))
            .select("r.request_id", "l.item_id", "l.score", "l.rank", "r.dated",
                    use_dated.alias("filter_dated"),
                    (F.col("r.dated") & (F.col("l.n_dated") == 0)).alias("backup"),
                    "r.num_results"))

"""Feature table build (L2) and first-purchase table (L3)."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.codes import score_of_level
from ..functions.dates import days_before, elapsed_days
from ..operators.horizons import HORIZONS, horizon_sums, latest_code_per_day

PAIR = ("userId", "productId")


def _next_month(cutoff: str):
    return F.add_months(F.lit(cutoff).cast("date"), 1)


def order_features(orders: DataFrame, cutoff: str,
                   horizons: Sequence[int] = HORIZONS,
                   with_label: bool = False) -> DataFrame:
    """``o{n}``: units bought per pair in the n days before the cutoff.

    With ``with_label`` the same single aggregate also reads the cutoff
    month and returns ``label`` = first purchase day there (0 if none), so
    the order log is scanned, joined and shuffled once for both. Only pairs
    with a pre-cutoff order are kept (quirk Q8). The date filter is on the
    raw column, so it reaches the scan.
    """
    start = F.lit(cutoff).cast("date")
    end = _next_month(cutoff) if with_label else start
    rows = orders.filter(F.col("orderDate") < end)
    pre = F.col("orderDate") < start
    day = days_before(cutoff, "orderDate")
    measures = {"o{n}": F.when(pre, F.col("buyNum"))}
    if not with_label:
        return horizon_sums(rows, PAIR, day, measures, horizons)
    agg = horizon_sums(
        rows, PAIR, day, measures, horizons,
        extra_cols={"_pre": pre, "_dom": F.dayofmonth("orderDate")},
        extra_aggs=[F.count(F.when(F.col("_pre"), 1)).alias("_n_pre"),
                    F.coalesce(F.min(F.when(~F.col("_pre"), F.col("_dom"))), F.lit(0)).alias("label")])
    return agg.filter(F.col("_n_pre") > 0).drop("_n_pre")


def action_features(actions: DataFrame, cutoff: str,
                    horizons: Sequence[int] = HORIZONS) -> DataFrame:
    """``ua1_{n}``, ``ua2_{n}``: type-1 / type-2 action counts (A12 + A16)."""
    pre = actions.filter(F.col("actionDate") < F.lit(cutoff).cast("date"))
    t, n = F.col("actionType"), F.col("actionNum")
    measures = {"ua1_{n}": F.when(t == 1, n).otherwise(0),
                "ua2_{n}": F.when(t == 2, n).otherwise(0)}
    return horizon_sums(pre, PAIR, days_before(cutoff, "actionDate"), measures, horizons)


def comment_features(comments: DataFrame, order_products: DataFrame, cutoff: str,
                     horizons: Sequence[int] = HORIZONS, parts: int | None = None) -> DataFrame:
    """``s{n}``: comment points per pair.

    Comments reach products through the distinct (order, product) pairs
    (quirk Q6); comments less than 24 h before the cutoff are dropped (Q4);
    one comment per pair and day, the latest (time, order) wins (Q5).
    """
    # a whole day before the cutoff, as a bound on the raw column (an unknown
    # time counts as very old, quirk Q2)
    last = dt.date.fromisoformat(cutoff) - dt.timedelta(days=1)
    limit = F.lit(last.isoformat()).cast(comments.schema["commentTime"].dataType)
    c = (comments.filter((F.col("commentTime") <= limit) | F.col("commentTime").isNull())
                 .withColumn("d", elapsed_days(cutoff, "commentTime")))
    op = order_products.select("orderId", "productId").distinct()
    joined = c.join(op, "orderId")
    if parts:
        joined = joined.repartition(parts, *PAIR)
    per_day = latest_code_per_day(joined, PAIR, "d", "commentTime", "orderId", "scoreLevel",
                                  out="level")
    return horizon_sums(per_day, PAIR, "d", {"s{n}": score_of_level("level")}, horizons)


def purchase_labels(orders: DataFrame, cutoff: str, policy: str = "first") -> DataFrame:
    """Day of month of purchases in the cutoff month (label; Q7).

    ``first``: one row per pair, the first purchase day.
    ``all``: one row per cutoff-month order line (the reference's behaviour).
    """
    start = F.lit(cutoff).cast("date")
    m = orders.filter((F.col("orderDate") >= start) & (F.col("orderDate") < _next_month(cutoff)))
    if policy == "first":
        return m.groupBy(*PAIR).agg(F.min(F.dayofmonth("orderDate")).alias("label"))
    if policy == "all":
        return m.select(*PAIR, F.dayofmonth("orderDate").alias("label"))
    raise ValueError(policy)


def purchase_features(orders: DataFrame, order_products: DataFrame,
                      actions: DataFrame, comments: DataFrame,
                      users: DataFrame, products: DataFrame, cutoff: str,
                      horizons: Sequence[int] = HORIZONS,
                      label_policy: str = "first", parts: int | None = None) -> DataFrame:
    """Per-(user, product) feature row with label (L2).

    Population: pairs with at least one pre-cutoff order (Q8). Each source is
    aggregated to one row per pair before any join, so every join is
    one-to-one on the pair (no fan-out, no skewed join key with many rows);
    the user / product lookups are left to the optimizer, which broadcasts
    them when their estimated size is under the broadcast threshold and
    otherwise shuffles (AQE splits skewed partitions). With ``parts`` the rows
    of every source are dealt by pair into so many partitions, in which they
    are aggregated and joined without a further shuffle; a caller that grows
    it with the rows keeps a task's hash tables at one size.
    """
    first = label_policy == "first"
    if parts:
        orders, actions = (d.repartition(parts, *PAIR) for d in (orders, actions))
    of = order_features(orders, cutoff, horizons, with_label=first)
    af = action_features(actions, cutoff, horizons)
    cf = comment_features(comments, order_products, cutoff, horizons, parts)
    out = (of.join(af, list(PAIR), "left")
             .join(cf, list(PAIR), "left")
             .join(users, "userId", "left")
             .join(products, "productId", "left"))
    if not first:
        out = out.join(purchase_labels(orders, cutoff, label_policy), list(PAIR), "left")
    rest = [c for c in out.columns if c not in (*PAIR, "label")]
    return out.na.fill(0).select(*PAIR, *rest, "label")


def feature_columns(horizons: Sequence[int] = HORIZONS) -> list[str]:
    cols = [f"o{n}" for n in horizons]
    for n in horizons:
        cols += [f"ua1_{n}", f"ua2_{n}"]
    cols += [f"s{n}" for n in horizons]
    return cols

"""Trailing-horizon aggregates.

Every operator here is one or two hash aggregates with map-side partial
aggregation: no group is ever materialised in one task, so a hot key costs
one partial row per input partition, not a giant list.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Look-back horizons in days.
HORIZONS = (5, 10, 20, 40, 60, 80, 100, 200, 400)


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def horizon_exprs(day_col, measures: Mapping[str, object],
                  horizons: Sequence[int] = HORIZONS) -> list[Column]:
    """``sum(x) over days d in [0, n)`` for each measure and horizon.

    ``measures`` maps an output name pattern containing ``{n}`` to a column.
    Sums are bigint and 0 when no day falls inside the horizon. When the day
    and measures are column names, the sums are built as SQL expressions
    (one JVM call each instead of a dozen Column calls).
    """
    if isinstance(day_col, str) and all(isinstance(x, str) for x in measures.values()):
        return [F.expr(f"CAST(COALESCE(SUM(CASE WHEN `{day_col}` >= 0 AND `{day_col}` < {n} "
                       f"THEN `{x}` END), 0) AS BIGINT) AS `{pattern.format(n=n)}`")
                for n in horizons for pattern, x in measures.items()]
    d = _col(day_col)
    out = []
    for n in horizons:
        inside = (d >= 0) & (d < n)
        for pattern, x in measures.items():
            out.append(F.coalesce(F.sum(F.when(inside, _col(x))), F.lit(0))
                       .cast("long").alias(pattern.format(n=n)))
    return out


def horizon_sums(df: DataFrame, keys: Sequence[str], day_col,
                 measures: Mapping[str, object],
                 horizons: Sequence[int] = HORIZONS,
                 extra_aggs: Sequence[Column] = (),
                 extra_cols: Mapping[str, object] | None = None) -> DataFrame:
    """One aggregate per key with all horizon sums.

    The day and each measure are projected once per row before the
    aggregate, so the nine conditional sums only compare an int and add.
    ``extra_cols`` are projected alongside for ``extra_aggs`` to use.
    """
    names = list(measures)
    proj = [F.col(k) for k in keys] + [_col(day_col).alias("_d")]
    proj += [_col(x).alias(f"_m{i}") for i, x in enumerate(measures.values())]
    proj += [_col(v).alias(k) for k, v in (extra_cols or {}).items()]
    slim = df.select(*proj)
    aggs = horizon_exprs("_d", {n: f"_m{i}" for i, n in enumerate(names)}, horizons)
    return slim.groupBy(*keys).agg(*aggs, *extra_aggs)


def one_per_day(df: DataFrame, keys: Sequence[str], day_col: str, value_col: str,
                order_cols: Sequence[str], out: str = "value") -> DataFrame:
    """Keep one value per (keys, day): the one with the greatest order key.

    Deterministic replacement for last-write-wins maps (quirk Q5).
    """
    tie = F.struct(*[F.col(c) for c in order_cols])
    return (df.groupBy(*keys, day_col)
              .agg(F.max_by(F.col(value_col), tie).alias(out)))


def latest_code_per_day(df: DataFrame, keys: Sequence[str], day_col: str, time_col: str,
                        order_col: str, code_col: str, out: str = "code") -> DataFrame:
    """Per (keys, day), the code of the latest row by (time, order); the
    code must be an int in [0, 10) and the order a non-negative long.

    Same result as ``one_per_day`` but as a plain ``max`` over one
    DECIMAL(38,0) key ``micros * 1e20 + order * 10 + code``: its buffer is
    mutable, so Spark runs a hash aggregate (partial + final) instead of
    sorting every row by the group key. A code or order out of range raises;
    rows without a code say nothing and are left out, rows without an order
    count as order 0.
    """
    code, order = F.col(code_col), F.coalesce(F.col(order_col), F.lit(0))
    df = df.filter(code.isNotNull())
    checked = F.when(code.between(0, 9) & (order >= 0) & (order < F.lit(10 ** 18)), order * 10 + code).otherwise(
        F.raise_error(F.concat(F.lit("code or order out of range: "), code.cast("string"), F.lit(", "),
                               order.cast("string"))).cast("long"))
    d38 = "decimal(38,0)"
    key = (F.unix_micros(F.col(time_col).cast("timestamp")).cast(d38)
           * F.lit("100000000000000000000").cast(d38)
           + checked.cast(d38))
    g = df.groupBy(*keys, day_col).agg(F.max(key.cast(d38)).alias("_k"))
    return g.select(*keys, day_col, F.pmod(F.col("_k"), F.lit(10)).cast("int").alias(out))


def horizon_scores(df: DataFrame, keys: Sequence[str], day_col: str,
                   points, prefix: str = "s",
                   horizons: Sequence[int] = HORIZONS) -> DataFrame:
    """Sum of per-day points over each horizon (A13). ``df`` has one row per day."""
    return horizon_sums(df, keys, day_col, {prefix + "{n}": points}, horizons)


def pivot_sum(df: DataFrame, type_col: str, value_col: str,
              types: Mapping[object, str]) -> list[Column]:
    """Conditional-sum pivot of a type column (A16): one column per known type."""
    t, v = F.col(type_col), F.col(value_col)
    return [F.when(t == F.lit(k), v).otherwise(F.lit(0)).alias(name)
            for k, name in types.items()]


def lookback_cumulative(df: DataFrame, id_cols: Sequence[str], time_col: str,
                        value_col: str, target: int, steps: int,
                        out: str = "lookback") -> DataFrame:
    """Running sums ``k = 0..steps-1`` back from ``target``.

    Element k is ``sum(value)`` over times in ``[target - k, target]``;
    times after the target are ignored. ``steps`` is honoured (quirk Q12).
    """
    elems = ", ".join(
        f"CAST(COALESCE(SUM(CASE WHEN `{time_col}` BETWEEN {target - k} AND {target} "
        f"THEN `{value_col}` END), 0.0) AS DOUBLE)" for k in range(steps))
    return df.groupBy(*id_cols).agg(F.expr(f"array({elems})").alias(out))


def day_map(df: DataFrame, keys: Sequence[str], day_col: str, value_col: str,
            out: str = "by_day") -> DataFrame:
    """Per key, a map day -> summed value.

    Built after a per-day aggregate, so the map holds at most one entry per
    distinct day (bounded by the date span, not by the row count).
    """
    per_day = df.groupBy(*keys, day_col).agg(F.sum(value_col).alias("_v"))
    return (per_day.groupBy(*keys)
                   .agg(F.map_from_entries(F.array_sort(
                       F.collect_list(F.struct(F.col(day_col), F.col("_v"))))).alias(out)))

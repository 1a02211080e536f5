"""Monthly grouping: calendar-complete sums and means, pivots by category.

All aggregates are plain ``groupBy`` (partial aggregation happens map-side, so a
hot key is combined inside each map task before the shuffle). The calendar of a
series is filled at monthly grain, after the data has been reduced to one row per
key-month: each row is followed by the months up to the next one, so the facts are
scanned once and nothing is joined.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelcast.functions.scalars import to_month


def _keys(keys) -> list[str]:
    return list(keys or [])


#: Sums with a scale are added up in this type: ten decimals, totals below 1e28.
ADDEND = "decimal(28,10)"


def exact_sum(c: Column, scale: int | None) -> Column:
    """Sum; with ``scale`` it is added up in decimals and rounded to that many at the end.

    Float addition depends on the order rows meet in the tasks, so a plain sum can change
    in its last bits between runs or partitionings. Decimal addition does not: values with
    up to ten decimals give the same total however they are dealt. A value of 1e18 or more
    is an error, not a silent loss."""
    return F.sum(c) if scale is None else F.round(F.sum(c.cast(ADDEND)), scale).cast("double")


def exact_mean(c: Column, scale: int | None) -> Column:
    """Mean; with ``scale`` it is the reproducible total divided by the count."""
    return F.avg(c) if scale is None else F.try_divide(exact_sum(c, scale), F.count(c))


def fill_months(monthly: DataFrame, keys: list[str] | None = None, date: str = "date") -> DataFrame:
    """One row for every month between each key's first and last month.

    ``monthly`` holds one row per key-month; months without a row get NULL values. A
    NULL key is a key of its own. Without keys the window holds one row per month."""
    keys = _keys(keys)
    values = [c for c in monthly.columns if c not in (*keys, date)]
    after = F.lead(date).over(Window.partitionBy(*keys).orderBy(date))
    upto = monthly.withColumn("_last", F.coalesce(F.add_months(after, -1), F.col(date)))
    months = upto.select("*", F.posexplode(
        F.sequence(F.col(date), F.col("_last"), F.expr("INTERVAL 1 MONTH"))).alias("_gap", "_month"))
    return months.select(*keys, F.col("_month").alias(date),
                         *[F.when(F.col("_gap") == 0, F.col(c)).alias(c) for c in values])


def _monthly(df: DataFrame, date_col: str, date: str) -> DataFrame:
    return df.filter(F.col(date_col).isNotNull()).withColumn(date, to_month(date_col))


def monthly_sum(df: DataFrame, date_col: str, value_cols: list[str] | str,
                keys: list[str] | None = None, date: str = "date",
                out_names: list[str] | None = None, scale: int | None = None) -> DataFrame:
    """Sum per key-month; every month between the first and last is emitted, gaps -> 0."""
    keys = _keys(keys)
    value_cols = [value_cols] if isinstance(value_cols, str) else list(value_cols)
    out_names = out_names or value_cols
    base = _monthly(df, date_col, date)
    agg = base.groupBy(*keys, date).agg(*[
        exact_sum(F.col(c), scale).alias(o) for c, o in zip(value_cols, out_names)])
    return fill_months(agg, keys, date).withColumns({o: F.coalesce(F.col(o), F.lit(0.0)) for o in out_names})


def monthly_mean(df: DataFrame, date_col: str, value_cols: list[str] | str,
                 keys: list[str] | None = None, date: str = "date",
                 out_names: list[str] | None = None, zero_fill: bool | list[bool] = False,
                 scale: int | None = None) -> DataFrame:
    """Mean per key-month over the calendar; a month without rows stays NULL.

    ``zero_fill`` turns NULL values into 0 *before* the mean (missing days then
    pull the month down), which is what one of the daily sources does; a list says
    so for each value column, so both means come from one aggregate."""
    keys = _keys(keys)
    value_cols = [value_cols] if isinstance(value_cols, str) else list(value_cols)
    out_names = out_names or value_cols
    zeros = list(zero_fill) if isinstance(zero_fill, (list, tuple)) else [zero_fill] * len(value_cols)
    base = _monthly(df, date_col, date)
    agg = base.groupBy(*keys, date).agg(*[
        exact_mean(F.coalesce(F.col(c), F.lit(0.0)) if z else F.col(c), scale).alias(o)
        for c, o, z in zip(value_cols, out_names, zeros, strict=True)])
    return fill_months(agg, keys, date)


def zero_fill_then_mean(df: DataFrame, date_col: str, value_cols, keys=None, date="date",
                        out_names=None, scale: int | None = None) -> DataFrame:
    return monthly_mean(df, date_col, value_cols, keys, date, out_names, zero_fill=True, scale=scale)


def two_period_mean_union(df: DataFrame, date_col: str, value_cols, split_date,
                          keys=None, date="date", out_names=None,
                          scale: int | None = None) -> DataFrame:
    """Monthly mean of ``date < split`` and of ``date >= split`` separately, then union.

    Each part gets its own calendar, as two separate downloads would: the part is
    one more key of a single aggregate."""
    parts = df.withColumn("_late", F.col(date_col) >= F.lit(split_date))
    return monthly_mean(parts, date_col, value_cols, ["_late", *_keys(keys)], date, out_names,
                        scale=scale).drop("_late")


def monthly_pivot(df: DataFrame, date_col: str, category_col: str, value_col: str,
                  values: list, keys: list[str] | None = None, date: str = "date",
                  names: list[str] | None = None, scale: int | None = None) -> DataFrame:
    """Key-month x category sum.

    Months without rows are not emitted; an absent (month, category) pair is
    NULL; a pair whose values are all NULL sums to 0; rows with a NULL date or
    category are dropped. ``values`` is explicit so no extra job is needed to
    discover the pivot columns; a category that is not listed fails the query
    instead of vanishing from it."""
    keys = _keys(keys)
    base = df.filter(F.col(date_col).isNotNull() & F.col(category_col).isNotNull()) \
             .withColumn(date, to_month(date_col))
    cat = F.col(category_col)
    unlisted = F.raise_error(F.concat(F.lit(f"{category_col}: category not listed: "), cat.cast("string")))
    base = base.withColumn(category_col, F.when(cat.isin(list(values)), cat).otherwise(
        unlisted.cast(df.schema[category_col].dataType)))
    out = base.groupBy(*keys, date).pivot(category_col, values) \
              .agg(exact_sum(F.coalesce(F.col(value_col).cast("double"), F.lit(0.0)), scale))
    if names:
        out = out.withColumnsRenamed({str(v): n for v, n in zip(values, names)})
    return out


def monthly_pivot_filled(df: DataFrame, date_col: str, category_col: str, value_col: str,
                         values: list, start, keys=None, date="date", names=None,
                         scale: int | None = None) -> DataFrame:
    """Pivot, keep months after ``start`` (open bound) and turn NULL into 0."""
    out = monthly_pivot(df, date_col, category_col, value_col, values, keys, date, names, scale)
    cols = names or [str(v) for v in values]
    return out.filter(F.col(date) > F.lit(start)).fillna(0.0, subset=cols)

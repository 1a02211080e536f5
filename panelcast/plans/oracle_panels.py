"""Oracle SQL (DuckDB) for the demand panels of ``panels.py``."""

from __future__ import annotations

from panelcast.plans import sqlgen as S
from panelcast.plans.panels import (FEATURE_COLS, PRICE_COLS, PRIORITIES, PRIORITY_COLS,
                                    QTY_COLS, RETURN_FLAGS)

M_ORDER = S.month("o_orderdate")
M_SHIP = S.month("l_shipdate")

TARGET_CTE = (f"target AS (SELECT o_orderpriority AS series, {M_ORDER} AS date, "
              f"round(sum(o_totalprice), 2) AS demand FROM orders "
              f"WHERE o_orderdate IS NOT NULL GROUP BY 1, 2)")

QTY_CTE = (f"qty AS (SELECT {M_SHIP} AS date, "
           f"{S.pivot_sums('l_returnflag', 'l_quantity', RETURN_FLAGS, QTY_COLS, 2)} "
           f"FROM lineitem WHERE l_shipdate IS NOT NULL AND l_returnflag IS NOT NULL GROUP BY 1)")

PRICE_CTES = (f"price_agg AS (SELECT {M_SHIP} AS date, "
              f"round(sum(l_extendedprice), 2) / count(l_extendedprice) AS price_mean, "
              f"round(sum(l_discount), 2) / count(l_discount) AS discount_mean "
              f"FROM lineitem WHERE l_shipdate IS NOT NULL GROUP BY 1), "
              f"price AS (SELECT c.date, p.price_mean, p.discount_mean FROM ({S.calendar('price_agg')}) c "
              f"LEFT JOIN price_agg p ON c.date = p.date)")

REV_CTE = (f"rev AS (SELECT {M_ORDER} AS date, "
           f"{S.pivot_sums('o_orderpriority', 'o_totalprice', PRIORITIES, PRIORITY_COLS, 2)} "
           f"FROM orders WHERE o_orderdate IS NOT NULL AND o_orderpriority IS NOT NULL GROUP BY 1)")

CNT_CTE = (f"cnt AS (SELECT o_orderpriority AS series, {M_ORDER} AS date, count(*) AS n_orders "
           f"FROM orders WHERE o_orderdate IS NOT NULL GROUP BY 1, 2)")


def merged_cte(how: str = "LEFT") -> str:
    cols = ", ".join(FEATURE_COLS)
    return (f"merged AS (SELECT t.series, t.date, t.demand, {cols} FROM target t "
            f"{how} JOIN qty USING (date) {how} JOIN price USING (date) "
            f"{how} JOIN rev USING (date) {how} JOIN cnt USING (series, date))")


def master_cte() -> str:
    fills = ", ".join(f"{S.ffill_bfill(c, ['series'])} AS {c}" for c in FEATURE_COLS)
    return f"master AS (SELECT series, date, demand, {fills} FROM merged)"


def panel_ctes(how: str = "LEFT", fill: bool = True) -> str:
    parts = [TARGET_CTE, QTY_CTE, PRICE_CTES, REV_CTE, CNT_CTE, merged_cte(how)]
    if fill:
        parts.append(master_cte())
    return "WITH " + ", ".join(parts)


__all__ = ["panel_ctes", "PRICE_COLS", "QTY_COLS"]


def _w(frame: str = "") -> str:
    return S.win(["series"], frame=frame)


def features_select(p, extra_round: bool = True) -> str:
    """SELECT list (after ``*``) that builds the feature columns over ``master``."""
    parts = [f"lag({p.target}, {k}) OVER {_w()} AS {p.target}_lag_{k}" for k in p.target_lags]
    parts += [f"lag({c}, {k}) OVER {_w()} AS {c}_lag_{k}" for c in p.macro_cols for k in p.macro_lags]
    for w in p.windows:
        fr = f"ROWS BETWEEN {w} PRECEDING AND 1 PRECEDING"
        parts.append(f"CASE WHEN count({p.target}) OVER {_w(fr)} = {w} "
                     f"THEN avg({p.target}) OVER {_w(fr)} END AS {p.target}_ma{w}")
    parts.append("sin(2 * pi() * month(date) / 12.0) AS month_sin")
    parts.append("cos(2 * pi() * month(date) / 12.0) AS month_cos")
    parts.append(f"CAST(row_number() OVER {_w()} - 1 AS INTEGER) AS trend")
    return ", ".join(parts)


def feature_names(p) -> list[str]:
    names = [f"{p.target}_lag_{k}" for k in p.target_lags]
    names += [f"{c}_lag_{k}" for c in p.macro_cols for k in p.macro_lags]
    names += [f"{p.target}_ma{w}" for w in p.windows]
    return names + ["month_sin", "month_cos", "trend"]


def features_cte(p) -> str:
    """``feat_raw`` (no NULL drop) and ``feat`` (NULL rows dropped) on top of ``master``."""
    allc = ["series", "date", "demand"] + list(FEATURE_COLS) + feature_names(p)
    notnull = " AND ".join(f"{c} IS NOT NULL" for c in allc)
    return (f"feat_raw AS (SELECT *, {features_select(p)} FROM master), "
            f"feat AS (SELECT * FROM feat_raw WHERE {notnull})")

"""Small helpers that write the ANSI/DuckDB oracle SQL for the registered queries.

These only build strings for the correctness check; no query runs through them.
"""

from __future__ import annotations


def month(col: str) -> str:
    return f"CAST(date_trunc('month', {col}) AS DATE)"


def calendar(source: str, keys: list[str] | None = None, date: str = "date") -> str:
    """SQL of every month between min and max ``date`` of ``source`` (per key)."""
    keys = keys or []
    k = "".join(f"{c}, " for c in keys)
    grp = f" GROUP BY {', '.join(keys)}" if keys else ""
    return (f"SELECT {k}CAST(unnest(generate_series(min({date}), max({date}), INTERVAL 1 MONTH)) AS DATE) "
            f"AS {date} FROM {source}{grp}")


def ffill_bfill(col: str, keys: list[str] | None, date: str = "date", backward: bool = True) -> str:
    part = f"PARTITION BY {', '.join(keys)} " if keys else ""
    past = (f"last_value({col} IGNORE NULLS) OVER ({part}ORDER BY {date} "
            f"ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)")
    if not backward:
        return past
    fut = (f"first_value({col} IGNORE NULLS) OVER ({part}ORDER BY {date} "
           f"ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)")
    return f"coalesce({past}, {fut})"


def pivot_sums(category: str, value: str, values: list[str], names: list[str],
               digits: int | None = None) -> str:
    parts = []
    for v, n in zip(values, names):
        e = f"sum(CASE WHEN {category} = '{v}' THEN coalesce(CAST({value} AS DOUBLE), 0) END)"
        if digits is not None:
            e = f"round({e}, {digits})"
        parts.append(f"{e} AS {n}")
    return ", ".join(parts)


def win(keys: list[str] | None, date: str = "date", desc: bool = False, frame: str = "") -> str:
    part = f"PARTITION BY {', '.join(keys)} " if keys else ""
    return f"({part}ORDER BY {date}{' DESC' if desc else ''}{(' ' + frame) if frame else ''})"


def pair_corr(x: str, y: str) -> str:
    """Pairwise-complete Pearson r, NULL when a side is constant."""
    xm = f"CASE WHEN {x} IS NOT NULL AND {y} IS NOT NULL THEN {x} END"
    ym = f"CASE WHEN {x} IS NOT NULL AND {y} IS NOT NULL THEN {y} END"
    return f"(covar_pop({xm}, {ym}) / nullif(stddev_pop({xm}) * stddev_pop({ym}), 0))"


def poly(coef: list[float], x: str) -> str:
    acc = f"CAST({coef[-1]!r} AS DOUBLE)"
    for c in reversed(coef[:-1]):
        acc = f"({acc} * {x} + CAST({c!r} AS DOUBLE))"
    return acc


def norm_ppf(p: str) -> str:
    from panelcast.operators import stats as st
    q = f"({p} - 0.5)"
    rc = f"(0.180625 - {q} * {q})"
    central = f"({q} * {poly(st._A, rc)} / {poly(st._B, rc)})"
    r = f"sqrt(-ln(least({p}, 1.0 - {p})))"
    r1, r2 = f"({r} - 1.6)", f"({r} - 5.0)"
    tail = (f"(CASE WHEN {r} <= 5.0 THEN {poly(st._C, r1)} / {poly(st._D, r1)} "
            f"ELSE {poly(st._E, r2)} / {poly(st._F, r2)} END)")
    return (f"(CASE WHEN abs({q}) <= 0.425 THEN {central} "
            f"WHEN {q} < 0 THEN -{tail} ELSE {tail} END)")

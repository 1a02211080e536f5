"""Landed-grid decoding on hand-made sheets (layouts of FIXTURES.md part A)."""

import datetime as dt

import pytest

from panelcast.operators import grid as G

SPEC = ["especifica", "specification"]


def grid_df(spark, rows, n):
    data = [("sheet", i, *([*r] + [None] * (n - len(r)))) for i, r in enumerate(rows)]
    cols = ", ".join(["file string", "row_idx int"] + [f"col_{i} string" for i in range(n)])
    return spark.createDataFrame(data, cols)


def test_hierarchical_decode(spark):
    rows = [
        ["Monthly report"],
        ["Especificação / Specification", "2024.0", None, "2025.0"],
        [None, "Jan\nJan", "Fev\nFeb", "Jan\nJan"],
        ["Row before any category", "1", "2", "3"],
        ["Produção / Production", "10", "11", "12"],
        ["  Longos ", "n/d", "5", None],
        [None, None, None, None],
        ["Empty row", None, None, None],
        ["Importações / Imports", "7", "8", "9"],
    ]
    g = grid_df(spark, rows, 4)
    out = G.hierarchical_grid_to_long(g, SPEC, ["Produção", "Importações"], "Sem Categoria")
    got = sorted((r["category"], r["spec"], r["date"], r["value"]) for r in out.collect())
    d1, d2, d3 = dt.date(2024, 1, 1), dt.date(2024, 2, 1), dt.date(2025, 1, 1)
    assert ("Sem Categoria", "Row before any category", d1, 1.0) in got
    assert ("Produção / Production", "Longos", d1, None) in got         # text cell -> NULL
    assert ("Produção / Production", "Longos", d3, None) in got
    assert ("Importações / Imports", "Importações / Imports", d2, 8.0) in got
    assert not [x for x in got if x[1] == "Empty row"]                     # all-NULL row dropped
    assert len(got) == 4 * 3


def test_header_locate_rules(spark):
    # spec rows on both sides of the month row: the last one before it wins
    rows = [["especificação specification x"], ["jan in col0", "nope"], ["Especificação / Specification", "2020"],
            [None, "Jan"], ["especificação/specification later"]]
    loc = G.grid_header_locate(grid_df(spark, rows, 2), SPEC).collect()[0]
    assert (loc["month_row"], loc["spec_row"]) == (3, 2)
    rows2 = [[None, "jan"], ["Especificação - Specification"]]
    loc2 = G.grid_header_locate(grid_df(spark, rows2, 2), SPEC).collect()[0]
    assert (loc2["month_row"], loc2["spec_row"]) == (0, 1)
    with pytest.raises(ValueError):
        G.require_headers(G.grid_header_locate(grid_df(spark, [["x", "y"]], 2), SPEC))


def test_block_header_rename_and_promote(spark):
    wide = grid_df(spark, [[None, "CARS", None, "TRUCKS\n", None]], 5)
    assert [r["name"] for r in G.block_header_map(wide, 0, ["Prod", "Sales"]).orderBy("col_idx").collect()] == [
        "Date", "CARS_Prod", "CARS_Sales", "TRUCKS_Prod", "TRUCKS_Sales"]
    with pytest.raises(ValueError, match="no block name"):
        G.block_header_rename(grid_df(spark, [[None, None, "X"]], 3), 0, ["a"])
    with pytest.raises(ValueError, match="two columns"):
        G.block_header_rename(grid_df(spark, [[None, "X", "X"]], 3), 0, ["a"])
    rows = [["junk"], ["junk"], ["junk"], [None, "CARS", None], [None, "Prod", "Sales"], ["2020-01-01", "1", "2"]]
    named = G.block_header_rename(grid_df(spark, rows, 3), 3, ["Prod", "Sales"])
    assert named.columns == ["file", "row_idx", "Date", "CARS_Prod", "CARS_Sales"] and named.count() == 1
    other = grid_df(spark, [*rows[:3], [None, "BUSES", None], [None, "Prod", "Sales"], ["2020-01-01", "7", "8"]], 3)
    both = G.block_header_rename(grid_df(spark, rows, 3).union(other.replace("sheet", "sheet2", subset=["file"])), 3, ["Prod", "Sales"])
    got = {r["file"]: (r["CARS_Prod"], r["CARS_Sales"], r["BUSES_Prod"], r["BUSES_Sales"]) for r in both.collect()}
    assert got == {"sheet": ("1", "2", None, None), "sheet2": (None, None, "7", "8")}     # each file by its own header
    resp = grid_df(spark, [["code", "value"], ["1", "5"]], 2).unionByName(
        grid_df(spark, [["code", "value"], ["2", "6"]], 2).replace("sheet", "sheet2", subset=["file"]))
    p = G.promote_header(resp)
    assert p.columns == ["code", "value"] and p.count() == 3   # the second file's header row remains

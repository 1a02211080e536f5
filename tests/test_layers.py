"""Medallion layers: raw bronze copies, the sector flow, gold names."""

import pytest

from panelcast import sinks as K
from panelcast.operators.clean import rename_map
from panelcast.plans import layers as LY
from panelcast.plans import panels as P
from panelcast.session import scratch_path

FLOW = LY.SectorFlow("code", "month", "variable", "section", "value", "index", ["mining", "steel"], ["mining_index", "steel_index"])


def responses(spark, months):
    """Two regions in two column orders; the second file repeats its header in the middle."""
    rows = [("a", 0, "code", "month", "variable", "section", "value")]
    back = [("b", 0, "value", "section", "variable", "month", "code")]
    for i, m in enumerate(months):
        rows += [("a", len(rows) + j, "11", m, v, s, x) for j, (v, s, x) in enumerate(
            [("index", "steel", f"{i}.5"), ("index", "mining", "..."), ("index", "other", "9"), ("weight", "steel", "7")])]
        back += [("b", len(back), f"{i}", "mining", "index", m, "12")]
    back.insert(3, ("b", 99, "value", "section", "variable", "month", "code"))
    return spark.createDataFrame(rows + back, "file string, row_idx int, " + ", ".join(f"col_{i} string" for i in range(5)))


def test_sector_flow_from_landed_responses_to_silver(spark):
    months = [f"2020{m:02d}" for m in range(1, 13)]
    raw = responses(spark, months)
    out = LY.build_sector_silver(raw, FLOW, "t_sector", "2021-01-01", "t_bronze", "t_silver", scratch_path(spark, "t-sector"))
    bronze = K.read_table(spark, "t_bronze", "t_sector")
    assert sorted(map(tuple, bronze.collect())) == sorted(map(tuple, raw.collect()))          # untouched, headers included
    got = {(r["region_code"], str(r["date"])): (r["mining_index"], r["steel_index"]) for r in out.collect()}
    assert len(got) == 24 and got[11, "2020-03-01"] == (0.0, 2.5) and got[12, "2020-03-01"] == (2.0, None)


def test_sector_flow_validates_before_it_writes(spark):
    with pytest.raises(ValueError, match="min_rows"):
        LY.build_sector_silver(responses(spark, ["202001"]), FLOW, "t_short", "2020-06-01", "t_bronze", "t_silver2", scratch_path(spark, "t-sector"))
    assert not K.table_exists(spark, "t_silver2", "t_short") and K.table_exists(spark, "t_bronze", "t_short")


def test_gold_gets_its_names_before_validation(spark, sf_small):
    LY.build_silver(spark, sf_small, as_of="2002-01-01", layer="t_silver3")
    names = {P.TARGET: "revenue", "qty_r": "returned"}
    gold = LY.build_gold(spark, as_of="2002-01-01", layer="t_gold3", silver="t_silver3", rename=names)
    plain = LY.build_gold(spark, as_of="2002-01-01", layer="t_gold4", silver="t_silver3")
    assert "revenue" in gold.columns and P.TARGET not in gold.columns
    assert sorted(map(tuple, gold.collect()), key=str) == sorted(map(tuple, rename_map(plain, names).collect()), key=str)

"""Every registered query against its SQL counterpart, and what the plans look like."""

from __future__ import annotations

import re

import pytest

import __spark_entry__ as entry
from compare import compare, connect
from conftest import SF
from skyfact.plans.catalog import QUERIES


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_query_has_sql():
    assert set(QUERIES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    assert compare(spark, con, SF, name) == ""


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan(spark, name):
    """No Python workers, no cross joins, and no single-task window or sort over observations or facts."""
    plan = entry.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    for word in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin", "MapInPandas"):
        assert word not in plan
    bounded = ("_part#", "Date#", "Wavelength_nm#", "w#")
    for first in re.findall(r"windowspecdefinition\(([^,)]*)", plan):
        assert " ASC" not in first or first.startswith(bounded), first


def test_entry(spark):
    rows = entry.entry(spark).collect()
    assert len(rows) == 366 and all(0 <= r.AOD_Value < 4 for r in rows)


def test_page_filters_reach_the_scan(spark, mart):
    from skyfact.operators.filters import Filters, apply_filters

    df = apply_filters(mart, Filters(True, ["ASIA"], ["fine"], (0.1, 3.0), (3, 9))).select("AOD_Value")
    plan = df._jdf.queryExecution().executedPlan().toString()
    for part in ("EqualTo(is_enriched,1)", "EqualTo(Continent,ASIA)", "GreaterThanOrEqual(AOD_Value,0.1)", "LessThanOrEqual(Month,9)"):
        assert part in plan
    assert re.search(r"ReadSchema: struct<Continent:string,Month:int,Particle_type:string,AOD_Value:double,is_enriched:int>", plan)

"""Pruned scans and plans that shrink when nothing is skewed. The shape of every plan is checked in test_queries."""

import os
import re

import pytest

from tallyloom.operators import binning, cohort, ranking, segments, sequence
from tallyloom.plans.registry import QUERIES, runner
from tallyloom.session import cut_lineage

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test data absent")


def executed(spark, name):
    df = runner(QUERIES[name])(spark, FOLDER)
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_columns_and_filters_reach_the_scan(spark):
    text = executed(spark, "diner_q08_totals_before_joining")
    lineitem = re.findall(r"ReadSchema: struct<([^>]*l_orderkey[^>]*)>", text)
    assert lineitem and all(set(re.findall(r"(\w+):", s)) == {"l_orderkey", "l_partkey"} for s in lineitem)
    assert "EqualTo(c_mktsegment,BUILDING)" in text


def line_scans(spark, name, monkeypatch):
    """Scans of the order lines that were run, for the result or for a table written on the way; what is read again from a shuffle does not count."""
    written = []
    for module in (binning, cohort, ranking, segments, sequence):
        monkeypatch.setattr(module, "cut_lineage", lambda df: written.append(df) or cut_lineage(df))
    df = runner(QUERIES[name])(spark, FOLDER)
    found = 0

    def walk(node):
        nonlocal found
        kind = node.getClass().getSimpleName()
        if kind.startswith("Reused"):
            return
        if kind == "AdaptiveSparkPlanExec":
            return walk(node.executedPlan())
        if kind.endswith("QueryStageExec"):
            return walk(node.plan())
        found += kind == "FileSourceScanExec" and "l_orderkey" in node.output().toString()
        for below in (node.children(), node.subqueries()):
            for i in range(below.size()):
                walk(below.apply(i))

    for frame in (*written, df):
        frame.collect()
        walk(frame._jdf.queryExecution().executedPlan())
    return found


@pytest.mark.parametrize("name", ["retail_country_revenue_tiers", "retail_country_customer_tiers", "retail_monthly_revenue", "soda_product_extremes", "retail_top_countries", "retail_drilldown_first"])
def test_the_lines_are_read_once(spark, name, monkeypatch):
    assert line_scans(spark, name, monkeypatch) == 1

"""Every registered query against its SQL counterpart, and the plans they get."""

import inspect
import pathlib

import pytest
from oracle import connect, differences

import __spark_entry__ as registered
import barwright
from barwright.plans import oracles, queries
from barwright.plans.bars import scale_bars, table

QUERIES, ORACLES = queries.QUERIES, oracles.ORACLES


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


def test_every_query_has_a_counterpart():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_counterpart(spark, sf_dir, duck, name):
    assert differences(QUERIES[name](spark, sf_dir), duck, ORACLES[name]) == []


def test_entry(spark):
    df = registered.entry(spark)
    assert len(df.columns) == 16 and df.count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cross_join_and_no_python_in_the_plan(spark, sf_dir, name):
    text = QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "MapInPandas", "SortAggregate"):
        assert operator not in text, operator


def test_all_windows_share_one_exchange_and_one_sort(spark, sf_dir):
    text = QUERIES["silver_full"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert text.count("Window [") == 1
    assert text.count("Exchange hashpartitioning(Ticker") == 1
    assert text.count("Exchange") == 2  # bars by day and ticker, windows by ticker
    assert text.count("Sort [") == 1


def test_monthly_needs_one_exchange_and_combines_before_it(spark, sf_dir):
    from barwright.operators.gold import monthly
    from barwright.operators.silver import silver

    refined = silver(scale_bars(spark, sf_dir), one_bar_per_day=True)
    extra = monthly(refined)._jdf.queryExecution().executedPlan().toString()
    base = refined._jdf.queryExecution().executedPlan().toString()
    assert extra.count("Exchange") == base.count("Exchange") + 1
    assert "partial_sum" in extra and "Expand" not in extra


@pytest.mark.parametrize("name", ["d1_slice", "lookback_180d"])
def test_day_bounds_reach_the_scan(spark, sf_dir, name):
    text = QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(l_shipdate," in text and "LessThan(l_shipdate," in text


def test_only_needed_columns_are_read(spark, sf_dir):
    text = QUERIES["distinct_dates"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "l_tax" not in text and "l_extendedprice" not in text
    assert len(table(spark, sf_dir, "lineitem").columns) == 11


def test_ticker_predicate_goes_below_the_windows(spark, sf_dir):
    text = QUERIES["q_latest_days"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    scan = text[text.index("FileScan") :]
    above = text[: text.index("FileScan")]
    assert "no4" in scan or "no4" in above[above.rindex("Exchange") :]


def test_table_queries_prune_partitions(spark, sf_dir):
    text = QUERIES["table_since_topn"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(data_pregao" in text and ">= 2001-01-01" in text


def test_top_k_is_not_a_global_sort(spark, sf_dir):
    text = QUERIES["q_since_topn"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in text


def test_registered_queries_take_whole_tables():
    root = pathlib.Path(inspect.getsourcefile(barwright)).parent
    for path in root.rglob("*.py"):
        for shortcut in (".sample(", "localCheckpoint", "crossJoin", "/tmp", "tempfile"):
            assert shortcut not in path.read_text(), path

"""Every query against its SQL twin on DuckDB."""

import duckdb
import pytest

from beadloom.plans.adapters import TABLES
from beadloom.plans.oracle import ORACLE
from beadloom.plans.queries import QUERIES


@pytest.fixture(scope="module")
def duck(sf_dir):
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return c


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    one = lambda v: f"{v:.6f}" if isinstance(v, float) else str(v)
    return sorted(columns), sorted(tuple(one(r[i]) for i in order) for r in data)


def test_same_names():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", list(QUERIES))
def test_equal(spark, duck, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    other = duck.sql(ORACLE[name])
    assert rows(df.columns, df.collect()) == rows(other.columns, other.fetchall())


@pytest.mark.parametrize("name", list(QUERIES))
def test_no_nested_loops(spark, sf_dir, name):
    plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_scans_read_few_columns_and_push_filters(spark, sf_dir):
    plan = QUERIES["cluster_label"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "l_extendedprice" not in plan and "l_shipdate" not in plan
    plan = QUERIES["tag_ambiguity"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "LessThan(p_partkey,96)" in plan


#: Exchanges of data that grows with the input, at most. A single-partition exchange is allowed over rows per range, bin or name.
EXCHANGES = {"cluster_label": 3, "cluster_merge": 3, "umi_duplication": 2, "coord_sort": 1, "render_clusters": 2}


@pytest.mark.parametrize("name", list(EXCHANGES))
def test_exchanges(spark, sf_dir, name):
    plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert sum(line.lstrip(" :+-").startswith("Exchange ") for line in plan.split("\n")) <= EXCHANGES[name], plan


@pytest.mark.parametrize("name", ["barcode_layout", "identify", "bead_lookup", "terminal_lookup"])
def test_reads_are_shuffled_once(spark, sf_dir, name):
    """Tags shuffle for their own tables; the records of reads do at most once."""
    plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("orders.parquet") == 1 and plan.count("hashpartitioning(rec_no") <= 1, plan


def test_no_row_data_in_one_partition(spark, sf_dir):
    """Log blocks and chunks: what goes to one partition is behind an aggregation per range."""
    for name in ("error_blocks", "chunk_assign"):
        plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        lines = plan.split("\n")
        for i, line in enumerate(lines):
            if "Exchange SinglePartition" in line:
                assert "HashAggregate(keys=[__p" in "".join(lines[i : i + 3]), plan


def test_adapters_are_searched_once(spark, sf_dir):
    """The length filter behind trimming isn't pushed under the search, which would repeat it."""
    plan = QUERIES["trim_pairs_mismatch"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("lambdafunction(") == 2, plan

"""Plan shape: pruning and pushdown reach the scans, no Python in any plan,
no single-partition exchange over per-value data."""

import pytest

from bitlake.plans.registry import QUERIES, Fixture
from bitlake.plans.store import BitStore
from bitlake.sources.logs import read_log_lines
from bitlake.spec import IdConfig
from bitlake.streaming.load import run_load

from conftest import SF001
from golden import LINES, write


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def formatted(df):
    return df._sc._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted") and \
        df._jdf.queryExecution().explainString(
            df._sc._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


@pytest.fixture(scope="module")
def store(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("plans") / "pixel")
    write(root, LINES)
    s = BitStore(spark, str(tmp_path_factory.mktemp("plans-store")))
    run_load(spark, s, root=root, cfg=IdConfig(shard_width=4, lanes=2))
    return root, s


def test_date_range_lists_only_its_day_folders(spark, store):
    root, _ = store
    f = formatted(read_log_lines(spark, root, start="2018-07-02", end="2018-07-02"))
    assert "PartitionFilters" in f and "dt=2018-07-02" in f and "dt=2018-07-01" not in f


def test_row_pushes_partition_and_row_filter(store):
    _, s = store
    ix = s.index("_test")
    f = formatted(ix.columns(ix.row("ofield", "o1")))
    assert "(field#" in f and "= ofield)" in f          # partition filter on field
    assert "EqualTo(row_id,0)" in f                     # literal id pushed to parquet
    assert "ReadSchema: struct<row_id:bigint,col_id:bigint>" in f


def test_topn_reads_two_columns_and_aggregates_in_two_levels(store):
    _, s = store
    f = formatted(s.index("_test").topn("sfield", 2))
    assert "ReadSchema: struct<row_id:bigint,col_id:bigint>" in f
    assert f.count("HashAggregate") >= 4


@pytest.mark.parametrize("name", ["set_bits", "topn", "topn_filtered", "nested", "unpivot_bits", "ingest_report",
                                  "batch_calls", "encode_rows", "bitmap_index"])
def test_no_python_and_no_single_partition(spark, name):
    fx = Fixture(spark, SF001)
    p = plan(QUERIES[name](fx))
    for bad in ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "FlatMapGroupsInPandas", "MapInPandas"):
        assert bad not in p
    # TakeOrdered merges at most n rows per task; a global aggregate (the
    # report's total row, batch counts) merges one partial row per task.
    if name not in ("topn", "topn_filtered", "batch_calls", "ingest_report"):
        assert "SinglePartition" not in p

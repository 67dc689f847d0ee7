"""Column checks observed by the write equal the checks of the written table, planted faults included."""

from __future__ import annotations

import glob

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from playmart.operators import quality
from playmart.plans import registry
from playmart.plans.warehouse import Warehouse
from playmart.sources.sinks import insert_overwrite_partitions, write_table


@pytest.fixture(scope="module")
def built(spark, sf_dir):
    w = Warehouse(spark, sf_dir, materialize=True)
    return w, {t: registry.model(w, t) for t in quality.declared_checks()}


def rows(parts):
    return sorted(map(tuple, quality.dq_summary(parts).collect()), key=str)


def test_every_built_table_is_measured_by_its_write(built):
    w, tables = built
    assert set(w.measured) >= set(quality.declared_checks())
    assert rows(quality.column_checks(tables, w.measured)) == rows(quality.column_checks(tables, {}))


def test_planted_faults_are_counted_by_the_write(spark, built, tmp_root):
    _, tables = built
    declared = quality.declared_checks()
    for name in ("iap_arpdau_daily", "engagement_daily"):
        _, column, _, _ = next(c for c in declared[name] if c[0] == "not_null" and c[1] != "date")
        df = tables[name].withColumn(column, F.when(F.crc32(F.col(column).cast("string")) % 2 == 0, F.col(column)))
        path = f"{tmp_root}/faults-{name}"
        seen = write_table(df, path, partition_by=("date",), cluster_by=(column,), metrics=quality.write_metrics(name))
        want = rows([quality.table_checks(spark.read.schema(df.schema).parquet(path), name, declared[name])])
        got = rows(quality.column_checks({name: df}, {name: seen})) if set(declared) == {name} else sorted(
            ((c, name, col, sev, seen[f"_f{i}"]) for i, (c, col, sev, _) in enumerate(declared[name])), key=str)
        assert got == want and max(r[4] for r in got) > 0
        with pytest.raises(AssertionError, match=column):
            quality.assert_clean(quality.dq_summary(quality.column_checks({t: tables[t] for t in declared}, {t: seen if t == name else dict.fromkeys(
                quality.write_metrics(t), 0) for t in declared})))


def test_summary_reads_only_what_grain_and_rules_need(built):
    """No scan of a table serves column checks alone: ``level_upgrade_recommendations`` and others are not opened twice."""
    w, tables = built
    plan = quality.dq_summary(quality.column_checks(tables, w.measured))._jdf.queryExecution().optimizedPlan().toString()
    assert "Relation" not in plan and "Aggregate" not in plan


def test_empty_writes_and_partition_overwrites_are_measured(spark, tmp_root):
    path, bad = f"{tmp_root}/observed", {"bad": F.count_if(F.col("x").isNull()), "n": F.count(F.lit(1))}
    df = spark.createDataFrame([(1, "a"), (None, "a"), (2, "b"), (3, "b")], "x int, d string")
    assert write_table(df, path, partition_by=("d",), metrics=bad) == {"bad": 1, "n": 4}
    assert insert_overwrite_partitions(df.where("d = 'b'"), path, ["d"], metrics=bad) == {"bad": 0, "n": 2}
    assert spark.read.parquet(path).count() == 4
    assert insert_overwrite_partitions(df.where("d = 'x'"), path, ["d"], metrics=bad) == {"bad": 0, "n": 0}
    assert write_table(df.limit(0), f"{path}-none", metrics=bad) == {"bad": 0, "n": 0}
    assert write_table(df, f"{path}-unmeasured") == {}


def test_files_stay_sorted_when_observed(spark, tmp_root):
    path = f"{tmp_root}/observed-order"
    df = spark.range(20000).select((F.crc32(F.col("id").cast("string")) % 997).alias("k"), (F.col("id") % 3).alias("d"))
    write_table(df, path, partition_by=("d",), cluster_by=("k",), metrics={"n": F.count(F.lit(1))})
    files = glob.glob(f"{path}/d=*/*.parquet")
    assert files
    for f in files:
        k = pq.read_table(f, partitioning=None).column("k").to_pylist()
        assert k == sorted(k)

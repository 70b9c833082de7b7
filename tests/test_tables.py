"""Writing tables: scopes, contracts, publishing, partitions, batches; the exact sample."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillstar.operators.sampling import exact_sample, hash_number
from tillstar.plans.pipeline import ConstraintViolation, read_warehouse, rebuild_years, run_pipeline
from tillstar.session import shared_dir
from tillstar.sources import sinks

from .test_csv_pipeline import write_files

AS_OF = dt.date(2024, 1, 1)

CONTRACT = T.StructType([T.StructField("id", T.LongType(), False), T.StructField("name", T.StringType()),
                         T.StructField("price", T.DecimalType(10, 2), False)])


def tables_left(spark):
    base = f"{shared_dir(spark)}/{sinks.TABLES}".removeprefix("file:")
    return sorted(os.listdir(base)) if os.path.isdir(base) else []


def files(path):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def test_scope_drops_its_tables_and_no_others(spark):
    kept = sinks.stage_table(spark.range(3), "kept")
    before = tables_left(spark)
    with sinks.TableScope(spark):
        outer = sinks.stage_table(spark.range(5), "outer")
        with sinks.TableScope(spark) as inner:
            t = sinks.stage_table(spark.range(7), "inner")
            assert t.count() == 7 and len(inner.folders) == 1
        assert outer.count() == 5 and len(tables_left(spark)) == len(before) + 1
    assert tables_left(spark) == before and kept.count() == 3


def test_scope_drops_its_tables_after_a_failure_and_in_threads(spark):
    from concurrent.futures import ThreadPoolExecutor

    before = tables_left(spark)
    with pytest.raises(ZeroDivisionError), sinks.TableScope(spark) as scope:
        with ThreadPoolExecutor(3) as pool:
            list(pool.map(sinks.within_scope(lambda n: sinks.stage_table(spark.range(n), "t").count()), (1, 2, 3)))
        assert len(scope.folders) == 3
        1 / 0
    assert tables_left(spark) == before


def test_run_leaves_no_intermediate_tables(spark, tmp_dir):
    write_files(os.path.join(tmp_dir, "raw"))
    before = tables_left(spark)
    res = run_pipeline(spark, os.path.join(tmp_dir, "raw"), os.path.join(tmp_dir, "wh"), AS_OF)
    assert tables_left(spark) == before
    mart = read_warehouse(spark, os.path.join(tmp_dir, "wh"))
    for name in ("dim_date", "dim_products", "dim_stores", "dim_customers", "fct_sales"):
        assert res.rows[name] == mart[name].count() > 0
    assert not [f for f in os.listdir(os.path.join(tmp_dir, "wh", "mart")) if "." in f]


def test_failed_rules_leave_the_mart_and_no_tables(spark, tmp_dir):
    raw, out = os.path.join(tmp_dir, "raw"), os.path.join(tmp_dir, "wh")
    write_files(raw)
    run_pipeline(spark, raw, out, AS_OF)
    mart, before = files(os.path.join(out, "mart")), tables_left(spark)
    with pytest.raises(ConstraintViolation):
        run_pipeline(spark, raw, out, AS_OF, enforce=("stg_promo.overlap",))
    assert files(os.path.join(out, "mart")) == mart and tables_left(spark) == before


@pytest.mark.parametrize(("sql", "message"), [
    ("SELECT if(id = 3, null, id) AS id, 'x' AS name, 1.5 AS price FROM range(5)", "id is NULL in 1 rows"),
    ("SELECT id, 'x' AS name, if(id > 2, null, 1.5) AS price FROM range(5)", "price is NULL in 2 rows"),
    ("SELECT id, if(id = 4, 'toolong', 'ok') AS name, 1.5 AS price FROM range(5)", "name is longer than 5 in 1 rows")])
def test_broken_contract_is_refused_and_the_old_table_stays(spark, tmp_dir, sql, message):
    path = os.path.join(tmp_dir, "t")
    good = spark.sql("SELECT 1.25 AS price, id, 'a' AS name, 'more' AS extra FROM range(2)")
    table = sinks.materialize(good, path, contract=CONTRACT, lengths={"name": 5})
    assert table.columns == ["id", "name", "price"] and table.schema["price"].dataType == T.DecimalType(10, 2)
    before = files(path)
    with pytest.raises(sinks.ContractViolation, match=message):
        sinks.materialize(spark.sql(sql), path, contract=CONTRACT, lengths={"name": 5})
    assert files(path) == before and os.listdir(tmp_dir) == ["t"]


def test_contract_refuses_missing_columns_and_other_types(spark, tmp_dir):
    for sql in ("SELECT 1L AS id, 'a' AS name", "SELECT 1L AS id, 'a' AS name, DATE'2020-01-01' AS price"):
        with pytest.raises(Exception, match="is NULL|UNRESOLVED|INCOMPATIBLE|INVALID|MISSING|COLUMN|CAST"):
            sinks.materialize(spark.sql(sql), os.path.join(tmp_dir, "t"), contract=CONTRACT)
    assert not os.listdir(tmp_dir)


@pytest.mark.parametrize("arrived", [False, True])
def test_crash_while_publishing_is_recovered(spark, tmp_dir, arrived):
    """The old table was moved aside; the new one may have arrived."""
    path = os.path.join(tmp_dir, "t")
    sinks.materialize(spark.range(3), path)
    os.rename(path, f"{path}.previous")
    if arrived:
        spark.range(4).write.parquet(path)
    assert sinks.table_exists(spark, path)
    assert spark.read.parquet(path).count() == (4 if arrived else 3)
    assert sinks.materialize(spark.range(9), path).count() == 9 and os.listdir(tmp_dir) == ["t"]


def test_one_year_is_rebuilt_by_itself_and_pruned(spark, tmp_dir):
    raw, out = os.path.join(tmp_dir, "raw"), os.path.join(tmp_dir, "wh")
    write_files(raw)
    run_pipeline(spark, raw, out, AS_OF, fact_by_year=True)
    path = os.path.join(out, "mart", "fct_sales")
    fact = spark.read.parquet(path)
    rows = sorted(map(tuple, fact.collect()), key=repr)
    year = fact.where("year is not null").first().year
    before = files(path)
    rebuild_years(spark, out, [year])
    after = files(path)
    mine = {f for f in before if f"year={year}/" in f}
    assert mine and not mine & set(after)
    assert {f: t for f, t in before.items() if f not in mine}.items() <= after.items()
    fact = spark.read.parquet(path)
    assert sorted(map(tuple, fact.collect()), key=repr) == rows
    plan = fact.where(F.col("year") == year)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan


def test_batch_inserted_again_adds_nothing(spark, tmp_dir):
    path = os.path.join(tmp_dir, "t")
    sinks.append_batch(spark.range(3), path, "a")
    sinks.append_batch(spark.range(3, 5), path, "b")
    kept = {f: t for f, t in files(path).items() if "batch=a" in f}
    table = sinks.append_batch(spark.range(3, 5), path, "b")
    assert sorted((r.id, r.batch) for r in table.collect()) == [(0, "a"), (1, "a"), (2, "a"), (3, "b"), (4, "b")]
    assert kept.items() <= files(path).items()
    # A batch that failed on the way left nothing.
    with pytest.raises(Exception, match="stop"):
        sinks.append_batch(spark.range(9).selectExpr("if(id = 7, raise_error('stop'), id) AS id"), path, "c")
    assert spark.read.parquet(path).count() == 5


@pytest.mark.parametrize("fraction", [0.0, 0.001, 0.3, 0.5, 0.999, 1.0])
def test_sample_has_exactly_its_size(spark, fraction):
    df = spark.sql("SELECT if(id % 10 = 9, null, id % 700) AS id, id AS other FROM range(3000)")
    rows = df.where("id is not null").withColumn("h", hash_number("id")).orderBy("h", "id", "other").collect()
    want = [(r.id, r.other) for r in rows[:int(fraction * len(rows) + 0.5)]]
    assert sorted(map(tuple, exact_sample(df, "id", fraction).collect())) == sorted(want)


def test_sample_of_copies_of_one_key(spark):
    df = spark.sql("SELECT 5 AS id, id AS other FROM range(1000)")
    assert sorted(r.other for r in exact_sample(df, "id", 0.25).collect()) == list(range(250))
    assert exact_sample(df.limit(0), "id", 0.3).count() == 0

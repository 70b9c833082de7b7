"""CSV sources (S1-S3, S8) and the golden mini pipeline."""

import datetime as dt
import os

import pytest

from tillstar.plans.pipeline import run_pipeline, run_scd2_delta
from tillstar.sources.csv_source import align_to_schema, export_csv, load_all, read_csv
from tillstar.sources.schemas import RAW_LENGTHS

FILES = {
    "stores.csv": "store_id,format,city,region\n100,super, Lviv ,Lviv region\n101,hyper,Kyiv,Kyiv region\n",
    "customers.csv": "customer_id,city,birthday\n10000001,Lviv,01-02-1990\n10000002,9999,\n10000003,Kyiv,05-06-1985\n",
    "products.csv": 'product_id,name,unit,category\n100001,"Milk ""Fresh""",l,Dairy\n100002,Bread,pcs,Bakery\n',
    "pricing.csv": ("product_id,price,start_date,end_date,is_active\n"
                    "100001,10.00,01-01-2023,30-06-2023,0\n100001,12.00,01-07-2023,31-12-2024,1\n"
                    "100002,5.00,01-01-2023,31-12-2024,1\n"),
    "promo.csv": ("promo_type,product_id,discount_pct,start_date,end_date,is_active,description\n"
                  "10,100001,20,01-03-2023,31-03-2023,0,Week price\n11,100001,30,15-03-2023,15-04-2023,0,Spring\n"),
    "check_summary.csv": ("check_id,store_id,cashier_id,datetime,customer_id\n"
                          "100000000000,100,1,01-03-2023 10:15,10000001\n"
                          "100000000001,9999,,20-03-2023 12:00,\n"
                          "100000000002,101,2,01-08-2023 09:00,10000003\n"
                          "100000000003,101,2,02-08-2023 09:00,10000009\n"),
    "check_details.csv": ("check_id,product_id,product_name,unit_price,discount_pct,discount_abs,discount_type,quantity,total_amount\n"
                          "100000000000,100001,milk,10.00,,,,2,20.00\n"
                          "100000000001,100001,milk,10.00,20,2.00,10,1,8.00\n"
                          "100000000001,100002,bread,5.00,,,,-1,-5.00\n"
                          "100000000002,100002,bread,5.00,,,,1,5.00\n"
                          "100000000003,999999,ghost,1.00,,,,1,1.00\n"
                          "999999999999,100002,bread,5.00,,,,1,5.00\n"),
}


def write_files(d, files=FILES):
    os.makedirs(d, exist_ok=True)
    for name, text in files.items():
        with open(os.path.join(d, name), "w", encoding="utf-8") as f:
            f.write(text)
    return d


def test_read_by_header_name(spark, tmp_dir):
    d = write_files(os.path.join(tmp_dir, "raw"))
    df = align_to_schema(read_csv(spark, os.path.join(d, "customers.csv")),
                         list(RAW_LENGTHS["raw_customers"]))
    rows = {r.customer_id: r for r in df.collect()}
    assert rows["10000001"].name is None and rows["10000001"].city == "Lviv"
    assert rows["10000002"].birthday == ""          # blank last field stays ''
    prod = read_csv(spark, os.path.join(d, "products.csv")).collect()
    assert 'Milk "Fresh"' in [r.name for r in prod]


def test_multiline_quoted_field(spark, tmp_dir):
    p = os.path.join(tmp_dir, "ml.csv")
    with open(p, "w", encoding="utf-8") as f:
        f.write('product_id,name,unit,category\n1,"two\nlines",kg,c\n2,plain,kg,c\n')
    rows = read_csv(spark, p, multiline=True).orderBy("product_id").collect()
    assert [r.name for r in rows] == ["two\nlines", "plain"]


def test_unknown_column_is_error(spark, tmp_dir):
    p = os.path.join(tmp_dir, "bad.csv")
    with open(p, "w", encoding="utf-8") as f:
        f.write("store_id,colour\n1,red\n")
    with pytest.raises(ValueError):
        align_to_schema(read_csv(spark, p), list(RAW_LENGTHS["raw_stores"]))


def test_missing_file_reported(spark, tmp_dir):
    files = dict(FILES)
    files.pop("promo.csv")
    d = write_files(os.path.join(tmp_dir, "raw"), files)
    rep = load_all(spark, d)
    assert rep.skipped == ["raw_promo"] and "raw_stores" in rep.loaded


def test_export_roundtrip(spark, tmp_dir):
    d = write_files(os.path.join(tmp_dir, "raw"))
    df = read_csv(spark, os.path.join(d, "products.csv"))
    out = os.path.join(tmp_dir, "out")
    export_csv(df, out)
    back = read_csv(spark, out)
    assert sorted(tuple(r) for r in back.collect()) == sorted(tuple(r) for r in df.collect())


def test_golden_pipeline(spark, tmp_dir):
    d = write_files(os.path.join(tmp_dir, "raw"))
    out = os.path.join(tmp_dir, "wh")
    res = run_pipeline(spark, d, out, as_of=dt.date(2024, 1, 1))
    rd = spark.read.parquet
    stg = rd(res.tables["stg_transactions"])
    assert stg.count() == 5                     # the line without header is dropped
    dd = rd(res.tables["dim_date"])
    assert dd.count() == (dt.date(2023, 8, 2) - dt.date(2023, 3, 1)).days + 1
    stores = {r.store_id: r.store_key for r in rd(res.tables["dim_stores"]).collect()}
    assert stores == {-1: -1, 100: 1, 101: 2, 9999: 3}
    prods = {r.product_id: r.current_retail_price for r in rd(res.tables["dim_products"]).collect()}
    assert float(prods[100001]) == 12.0 and float(prods[100002]) == 5.0
    cust = rd(res.tables["dim_customers"]).collect()
    by_id = {r.customer_id: r for r in cust}
    assert by_id[10000001].valid_from == dt.date(2023, 3, 1)
    assert by_id[10000002].valid_from == dt.date(2024, 1, 1) and by_id[10000002].city == "Online"
    assert by_id[None].customer_key == 0
    fct = {(r.check_id, r.product_key): r for r in rd(res.tables["fct_sales"]).collect()}
    assert fct[(100000000000, 1)].customer_key == by_id[10000001].customer_key
    assert fct[(100000000001, 2)].quantity == 0 and fct[(100000000001, 2)].store_key == 3
    assert fct[(100000000003, -1)].customer_key == 0
    assert fct[(100000000000, 1)].date_key == 20230301

    # delta: Kyiv customer moves, a new customer arrives
    upd = os.path.join(tmp_dir, "upd")
    write_files(upd, {"customers.csv": "customer_id,city,birthday\n10000003,Odesa,05-06-1985\n10000004,Lviv,\n"})
    p2 = run_scd2_delta(spark, os.path.join(upd, "customers.csv"), out, dt.date(2024, 6, 1))
    v2 = rd(p2).collect()
    moved = sorted((r.city, r.is_current) for r in v2 if r.customer_id == 10000003)
    assert moved == [("Kyiv", False), ("Odesa", True)]
    assert [r.valid_from for r in v2 if r.customer_id == 10000004] == [dt.date(2024, 6, 1)]
    assert max(r.customer_key for r in v2) == len(v2) - 1


def test_load_seq_follows_file_order_across_splits(spark, tmp_dir):
    p = os.path.join(tmp_dir, "pricing.csv")
    n = 20000
    with open(p, "w", encoding="utf-8") as f:
        f.write("product_id,price,start_date,end_date,is_active\n")
        for i in range(n):
            f.write(f"{i},1.00,01-01-2024,31-12-2024,0\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    try:
        df = read_csv(spark, p, with_load_seq=True, spread_scan=False)
        assert df.rdd.getNumPartitions() > 3
        rows = df.select("product_id", "load_seq").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    in_order = [int(r.product_id) for r in sorted(rows, key=lambda r: (r.load_seq.file, r.load_seq.block,
                                                                       r.load_seq.pos))]
    assert in_order == list(range(n))


def test_pipeline_reports_rows_loaded(spark, tmp_dir):
    d = write_files(os.path.join(tmp_dir, "raw"))
    res = run_pipeline(spark, d, os.path.join(tmp_dir, "wh"), as_of=dt.date(2024, 1, 1))
    assert res.rows["raw_check_details"] == 6 and res.rows["raw_stores"] == 2


def test_command_line(spark, tmp_dir, capsys):
    import json

    from tillstar.__main__ import main

    d = write_files(os.path.join(tmp_dir, "raw"))
    out = os.path.join(tmp_dir, "wh")
    assert main(["run", "--raw", d, "--out", out, "--as-of", "2024-01-01"]) == 0
    res = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert set(res["tables"]) >= {"fct_sales", "dim_customers", "stg_transactions"}
    upd = write_files(os.path.join(tmp_dir, "upd"), {"customers.csv": "customer_id,city,birthday\n10000001,Odesa,\n"})
    assert main(["delta", "--customers", os.path.join(upd, "customers.csv"), "--out", out,
                 "--as-of", "2024-06-01"]) == 0
    path = json.loads(capsys.readouterr().out.strip().splitlines()[-1])["dim_customers"]
    assert path.endswith("v000002")


def test_missing_source_keeps_previous_table(spark, tmp_dir):
    out = os.path.join(tmp_dir, "wh")
    first = write_files(os.path.join(tmp_dir, "raw1"))
    run_pipeline(spark, first, out, as_of=dt.date(2024, 1, 1))
    files = dict(FILES)
    files.pop("promo.csv")
    second = write_files(os.path.join(tmp_dir, "raw2"), files)
    res = run_pipeline(spark, second, out, as_of=dt.date(2024, 1, 1))
    assert res.skipped_sources == ["raw_promo"] and res.kept_tables == ["stg_promo"]
    assert spark.read.parquet(res.tables["stg_promo"]).count() == 2
    assert res.tables["dim_customers"].endswith("v000002")
    files.pop("stores.csv")
    third = write_files(os.path.join(tmp_dir, "raw3"), files)
    with pytest.raises(FileNotFoundError):
        run_pipeline(spark, third, os.path.join(tmp_dir, "fresh"), as_of=dt.date(2024, 1, 1))


def test_latest_version_through_spark(spark, tmp_dir):
    from tillstar.sources.sinks import latest_version, write_version

    base = os.path.join(tmp_dir, "dim")
    assert latest_version("file:" + base, spark) is None
    df = spark.createDataFrame([(1,)], "a int")
    write_version(df, base, 1)
    write_version(df, base, 3)
    os.makedirs(os.path.join(base, "v000007"))          # not committed: no _SUCCESS
    assert latest_version("file:" + base, spark) == 3
    assert latest_version(base, spark) == 3 and latest_version(base) == 3


def test_clustered_fact_layout(spark):
    from pyspark.sql import functions as F

    from tillstar.operators.mart import fact_layout

    days = 60
    fct = spark.range(30000).select(
        # a third of the sales on one day
        F.when(F.col("id") % 3 == 0, F.lit(20240101))
         .otherwise(F.lit(20240101) + F.col("id") % days).cast("int").alias("date_key"),
        F.col("id").alias("check_id"))
    out = fact_layout(fct, clustered=True, num_partitions=6)
    per_part = out.groupBy(F.spark_partition_id().alias("p")).agg(
        F.count(F.lit(1)).alias("n"), F.min("date_key").alias("lo"), F.max("date_key").alias("hi")).collect()
    assert sum(r.n for r in per_part) == 30000
    assert max(r.n for r in per_part) < 30000 / 3          # the hot day is split
    assert len([r for r in per_part if r.lo <= 20240101 <= r.hi]) >= 2   # hot day in several files


def test_audit_report_command(spark, tmp_dir, capsys):
    import json

    from tillstar.__main__ import main

    d = write_files(os.path.join(tmp_dir, "raw"))
    out = os.path.join(tmp_dir, "wh")
    assert main(["run", "--raw", d, "--out", out, "--as-of", "2024-01-01"]) == 0
    capsys.readouterr()
    assert main(["audit", "--out", out, "--raw", d]) == 0
    rep = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert rep["raw_check_details.no_header"] == 1          # the line whose receipt is missing
    assert rep["raw_check_details.negative:quantity"] == 1
    assert rep["raw_check_details.negative:total_amount"] == 1
    assert rep["dim_customers.one_current:customer_id"] == 0
    assert rep["fct_sales.fk:product_key"] == 0
    assert rep["stg_promo.overlap"] == 1                     # 15-03..15-04 starts inside 01-03..31-03
    assert rep["stg_pricing.overlap"] == 0
    assert rep["stg_transactions.promo_mismatch"] == 0      # the promo line matches its promo


def test_golden_mart_tables_exact(spark, tmp_dir):
    """Every mart table of the seven small CSVs, row for row (hand-derived)."""
    from decimal import Decimal as Dc

    d = write_files(os.path.join(tmp_dir, "raw"))
    res = run_pipeline(spark, d, os.path.join(tmp_dir, "wh"), as_of=dt.date(2024, 1, 1))

    def rows(name):
        return sorted(tuple(r) for r in spark.read.parquet(res.tables[name]).collect())

    assert rows("dim_stores") == [(-1, -1, "Unknown", "Unknown", "Unknown"),
                                  (1, 100, "super", "Lviv", "Lviv region"),
                                  (2, 101, "hyper", "Kyiv", "Kyiv region"),
                                  (3, 9999, "Online", "Online", "Online")]
    assert rows("dim_products") == [(-1, -1, "Unknown", None, None, None),
                                    (1, 100001, 'Milk "Fresh"', "l", "Dairy", Dc("12.00")),
                                    (2, 100002, "Bread", "pcs", "Bakery", Dc("5.00"))]
    open_end = dt.date(9999, 12, 31)
    assert sorted(rows("dim_customers"), key=lambda r: r[0]) == [
        (0, None, "Guest Customer", "Unknown", None, dt.date(1900, 1, 1), open_end, True),
        (1, 10000001, None, "Lviv", dt.date(1990, 2, 1), dt.date(2023, 3, 1), open_end, True),
        (2, 10000002, None, "Online", None, dt.date(2024, 1, 1), open_end, True),
        (3, 10000003, None, "Kyiv", dt.date(1985, 6, 5), dt.date(2023, 8, 1), open_end, True)]
    dd = rows("dim_date")
    assert len(dd) == 155 and dd[0][:2] == (20230301, dt.date(2023, 3, 1)) and dd[-1][0] == 20230802
    q = Dc("1.0000")
    assert rows("fct_sales") == sorted([
        (20230301, 1, 1, 1, 100000000000, Dc("2.0000"), Dc("10.0000"), Dc("20.0000"), Dc("0.0000")),
        (20230320, 1, 3, 0, 100000000001, q, Dc("10.0000"), Dc("8.0000"), Dc("2.0000")),
        (20230320, 2, 3, 0, 100000000001, Dc("0.0000"), Dc("5.0000"), Dc("0.0000"), Dc("0.0000")),
        (20230801, 2, 2, 3, 100000000002, q, Dc("5.0000"), Dc("5.0000"), Dc("0.0000")),
        (20230802, -1, 2, 0, 100000000003, q, q, q, Dc("0.0000"))])


def test_stream_command(spark, tmp_dir, capsys):
    from tillstar.__main__ import main
    from tillstar.sources.sinks import latest_version

    d = write_files(os.path.join(tmp_dir, "raw"))
    out = os.path.join(tmp_dir, "wh")
    assert main(["run", "--raw", d, "--out", out, "--as-of", "2024-01-01"]) == 0
    landing = os.path.join(tmp_dir, "landing")
    write_files(landing, {"c.csv": "customer_id,city,birthday\n10000001,Odesa,\n"})
    assert main(["stream", "--landing", landing, "--out", out, "--checkpoint",
                 os.path.join(tmp_dir, "ckpt"), "--columns", "customer_id,city,birthday"]) == 0
    assert latest_version(os.path.join(out, "mart", "dim_customers"), spark) == 2


def test_delta_retry_over_aborted_version(spark, tmp_dir):
    """A leftover folder of an aborted write (no committed data) does not
    block the retried delta."""
    d = write_files(os.path.join(tmp_dir, "raw"))
    out = os.path.join(tmp_dir, "wh")
    run_pipeline(spark, d, out, as_of=dt.date(2024, 1, 1))
    leftover = os.path.join(out, "mart", "dim_customers", "v000002", "_temporary", "0")
    os.makedirs(leftover)
    upd = write_files(os.path.join(tmp_dir, "upd"), {"customers.csv": "customer_id,city,birthday\n10000001,Odesa,\n"})
    p2 = run_scd2_delta(spark, os.path.join(upd, "customers.csv"), out, dt.date(2024, 6, 1))
    assert p2.endswith("v000002")
    assert sorted(r.city for r in spark.read.parquet(p2).collect() if r.customer_id == 10000001) == ["Lviv", "Odesa"]


def test_command_line_input_bytes(spark, tmp_dir, capsys):
    from tillstar.__main__ import main

    d = write_files(os.path.join(tmp_dir, "raw"))
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        assert main(["run", "--raw", d, "--out", os.path.join(tmp_dir, "wh"), "--as-of", "2024-01-01",
                     "--input-bytes", str(1 << 30)]) == 0
        assert spark.conf.get("spark.sql.shuffle.partitions") == "200"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_built_tables_follow_contracts(spark, tmp_dir):
    from tillstar.sources.schemas import MART, STG

    d = write_files(os.path.join(tmp_dir, "raw"))
    res = run_pipeline(spark, d, os.path.join(tmp_dir, "wh"), as_of=dt.date(2024, 1, 1))
    for name, contract in {**STG, **MART}.items():
        got = [(f.name, f.dataType.simpleString()) for f in spark.read.parquet(res.tables[name]).schema.fields
               if f.name != "load_seq"]
        assert got == [(f.name, f.dataType.simpleString()) for f in contract.fields], name


def test_enforced_rules(spark, tmp_dir):
    from tillstar.plans.pipeline import ConstraintViolation

    d = write_files(os.path.join(tmp_dir, "raw"))
    res = run_pipeline(spark, d, os.path.join(tmp_dir, "ok"), as_of=dt.date(2024, 1, 1),
                       enforce=("fct_sales.fk:", "dim_customers.one_current", "dim_stores.unique"))
    assert "audit_report" in res.tables
    with pytest.raises(ConstraintViolation, match="stg_promo.overlap"):
        run_pipeline(spark, d, os.path.join(tmp_dir, "bad"), as_of=dt.date(2024, 1, 1),
                     enforce=("stg_promo.overlap",))


def test_raw_format_export_roundtrip(spark, tmp_dir):
    """Typed pricing -> CSV in the raw files' format -> read by header -> staged again: unchanged."""
    from tillstar.operators import staging
    from tillstar.sources.schemas import RAW_LENGTHS

    d = write_files(os.path.join(tmp_dir, "raw"))
    raw = align_to_schema(read_csv(spark, os.path.join(d, "pricing.csv")), list(RAW_LENGTHS["raw_pricing"]))
    typed = staging.stage_pricing(raw)
    out = os.path.join(tmp_dir, "export")
    export_csv(typed, out, raw_format=True)
    back = staging.stage_pricing(align_to_schema(read_csv(spark, out), list(RAW_LENGTHS["raw_pricing"])))
    assert sorted(tuple(r) for r in back.collect()) == sorted(tuple(r) for r in typed.collect())
    text = "".join(open(os.path.join(out, f), encoding="utf-8").read()
                   for f in sorted(os.listdir(out)) if f.endswith(".csv"))
    assert "01-07-2023" in text and "12.00" in text


def test_half_of_the_receipts_is_staged_with_the_landed_other_half(spark, tmp_dir):
    """One file of the receipts missing: the other is loaded and joined with
    what the landing table kept."""
    out = os.path.join(tmp_dir, "wh")
    run_pipeline(spark, write_files(os.path.join(tmp_dir, "raw1")), out, as_of=dt.date(2024, 1, 1))
    files = dict(FILES)
    files.pop("check_details.csv")
    res = run_pipeline(spark, write_files(os.path.join(tmp_dir, "raw2"), files), out,
                       as_of=dt.date(2024, 1, 1))
    assert res.skipped_sources == ["raw_check_details"] and not res.kept_tables
    assert "raw_check_details" not in res.rows and res.rows["raw_check_summary"] > 0
    assert spark.read.parquet(os.path.join(out, "landing", "raw_check_details")).count() == 6


def test_failed_overwrite_leaves_the_table(spark, tmp_dir):
    from tillstar.sources.sinks import materialize

    path = os.path.join(tmp_dir, "t")
    materialize(spark.range(3), path)
    with pytest.raises(Exception, match="stop"):
        materialize(spark.range(5).selectExpr("if(id = 4, raise_error('stop'), id) as id"), path)
    assert spark.read.parquet(path).count() == 3
    assert materialize(spark.read.parquet(path).union(spark.range(2)), path).count() == 5


def test_new_products_are_staged_without_a_pricing_file(spark, tmp_dir):
    """pricing.csv missing, products.csv grown: prices stay as they were, the
    new product arrives."""
    out = os.path.join(tmp_dir, "wh")
    run_pipeline(spark, write_files(os.path.join(tmp_dir, "raw1")), out, as_of=dt.date(2024, 1, 1))
    before = spark.read.parquet(os.path.join(out, "stg", "stg_products")).count()
    files = dict(FILES)
    files.pop("pricing.csv")
    files["products.csv"] = files["products.csv"].rstrip("\n") + "\n987654,New one,kg,Fruit\n"
    res = run_pipeline(spark, write_files(os.path.join(tmp_dir, "raw2"), files), out,
                       as_of=dt.date(2024, 1, 1))
    assert set(res.kept_tables) == {"stg_pricing"}
    got = spark.read.parquet(os.path.join(out, "stg", "stg_products"))
    assert got.count() == before + 1 and got.where("product_id = 987654").count() == 1

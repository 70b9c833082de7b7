"""The whole warehouse run in the source's order (D16), and the SCD2 delta run.

    raw CSV  ->  landing tables  ->  staging tables  ->  dimensions  ->  fact

Each layer is written as parquet and read back before the next layer uses
it, so a lost executor never forces a recomputation across layers, and
later readers get column pruning and row-group statistics.  The customer
dimension is versioned (``mart/dim_customers/v000001``, ...): the delta
run reads the newest version and writes the next one.
"""

from __future__ import annotations

import os
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import calendar, mart, scd2, staging
from ..sources import sinks
from ..sources.csv_source import load_all, read_csv, align_to_schema
from ..sources.schemas import MART, RAW_LENGTHS, SOURCE_FILES
from ..sources.sinks import latest_version, version_path, write_version

STG_SOURCES = {
    "stg_stores": ["raw_stores"],
    "stg_customers": ["raw_customers"],
    "stg_pricing": ["raw_pricing"],
    "stg_promo": ["raw_promo"],
    "stg_products": ["raw_products", "raw_pricing"],
    "stg_transactions": ["raw_check_summary", "raw_check_details"],
}


@dataclass
class RunResult:
    """Paths written, sources skipped, tables kept from an earlier run, rows loaded."""

    tables: dict[str, str] = field(default_factory=dict)
    skipped_sources: list[str] = field(default_factory=list)
    kept_tables: list[str] = field(default_factory=list)
    rows: dict[str, int] = field(default_factory=dict)


def _p(out_dir: str, layer: str, name: str) -> str:
    return os.path.join(out_dir, layer, name)


def _exists(spark: SparkSession, path: str) -> bool:
    return sinks.table_exists(spark, path)


def land_feeds(spark: SparkSession, raw_dir: str, out_dir: str, res: RunResult) -> dict[str, DataFrame]:
    """Replace the landing table of every raw feed whose file is there.

    A missing file is reported, and its landing table keeps what an earlier
    run loaded.  Returns the landing tables that exist; the rows written to
    each are counted on the way (S11).
    """
    rep = load_all(spark, raw_dir)
    res.skipped_sources = rep.skipped

    def land(name: str) -> DataFrame | None:
        path = _p(out_dir, "landing", name)
        if name not in rep.loaded:
            return spark.read.parquet(path) if _exists(spark, path) else None
        df, observed = sinks.with_metrics(rep.loaded[name], name)
        table = sinks.materialize(df, path)
        res.rows[name] = observed.get.get("rows", 0)
        return table

    # The feeds are independent: their jobs run side by side.
    with ThreadPoolExecutor(len(SOURCE_FILES)) as pool:
        landed = dict(zip(SOURCE_FILES, pool.map(sinks.within_scope(land), SOURCE_FILES)))
    return {name: table for name, table in landed.items() if table is not None}


def stage_layer(spark: SparkSession, raw_dir: str, out_dir: str, res: RunResult) -> dict[str, DataFrame]:
    """Load the raw feeds and write the six staging tables.

    A staging table is built again if any of its files is there, from the
    landing tables; with none, it is kept as it is.
    """
    raw = land_feeds(spark, raw_dir, out_dir, res)
    out: dict[str, DataFrame] = {}
    builders = {
        "stg_stores": lambda: staging.stage_stores(raw["raw_stores"]),
        "stg_customers": lambda: staging.stage_customers(raw["raw_customers"]),
        "stg_pricing": lambda: staging.stage_pricing(raw["raw_pricing"]),
        "stg_promo": lambda: staging.stage_promo(raw["raw_promo"]),
        "stg_products": lambda: staging.stage_products(raw["raw_products"], out["stg_pricing"]),
        "stg_transactions": lambda: staging.stage_transactions(raw["raw_check_summary"],
                                                               raw["raw_check_details"]),
    }
    for name, fn in builders.items():
        path = _p(out_dir, "stg", name)
        new = any(s in res.rows for s in STG_SOURCES[name])
        if all(s in raw for s in STG_SOURCES[name]) and (new or not _exists(spark, path)):
            out[name] = sinks.materialize(fn(), path)
        elif _exists(spark, path):
            out[name] = spark.read.parquet(path)
            res.kept_tables.append(name)
        else:
            missing = [s for s in STG_SOURCES[name] if s not in raw]
            raise FileNotFoundError(f"{name}: no source {missing} and no earlier table")
        res.tables[name] = path
    return out


class ConstraintViolation(RuntimeError):
    """An enforced audit rule found bad rows."""


def run_pipeline(spark: SparkSession, raw_dir: str, out_dir: str, as_of,
                 changes: DataFrame | None = None, cluster_fact: bool = False,
                 enforce: tuple[str, ...] = (), fact_by_year: bool = False) -> RunResult:
    """Full rebuild: staging, dimensions (customer version 1), fact.

    ``cluster_fact`` range-partitions the fact by date before writing (see
    ``mart.fact_layout``): one more shuffle, files that date filters skip.
    ``fact_by_year`` writes it in folders by year, which ``rebuild_years``
    can replace one by one.

    The mart's tables are written beside their places, checked against their
    contracts (columns, types, NOT NULL) as they are written, and put in
    place together at the end.  ``enforce`` lists audit rule prefixes (e.g.
    ``"fct_sales.fk:"``) that act like the source's table constraints: the
    audit report is written to ``audit/report``, and if any enforced rule has
    bad rows the run fails.  A run that fails leaves the mart as it was.
    Intermediate tables are dropped when the run ends, also when it fails.
    """
    res = RunResult()
    ready: dict[str, sinks.Prepared] = {}
    with sinks.TableScope(spark):
        try:
            _build_mart(spark, raw_dir, out_dir, as_of, changes, cluster_fact, fact_by_year, enforce, res, ready)
        except BaseException:
            for table in ready.values():
                sinks.drop_table(spark, table.written)
            raise
        for name, table in ready.items():
            sinks.publish(spark, table)
            res.tables[name], res.rows[name] = table.path, table.rows
    return res


def _build_mart(spark, raw_dir, out_dir, as_of, changes, cluster_fact, fact_by_year, enforce, res: RunResult,
                ready: dict[str, sinks.Prepared]) -> None:
    """Stage, prepare the mart's tables and check them."""
    stg = stage_layer(spark, raw_dir, out_dir, res)
    txn = stg["stg_transactions"]
    base = _p(out_dir, "mart", "dim_customers")
    v = (latest_version(base, spark) or 0) + 1
    builders = {
        "dim_date": lambda: calendar.build_dim_date(txn),
        "dim_products": lambda: mart.build_dim_products(stg["stg_products"]),
        "dim_stores": lambda: mart.build_dim_stores(stg["stg_stores"]),
        "dim_customers": lambda: scd2.build_dim_customers(stg["stg_customers"], txn, as_of, changes),
    }

    def build(name: str) -> DataFrame:
        path = version_path(base, v) if name == "dim_customers" else _p(out_dir, "mart", name)
        ready[name] = sinks.prepare(builders[name](), path, contract=MART[name])
        return ready[name].table

    # The four dimensions are independent: build them as concurrent jobs.
    with ThreadPoolExecutor(len(builders)) as pool:
        dims = dict(zip(builders, pool.map(sinks.within_scope(build), builders)))

    fct = mart.build_fct_sales(txn, dims["dim_date"], dims["dim_products"], dims["dim_stores"], dims["dim_customers"])
    fct = mart.fact_layout(sinks.conform(fct, MART["fct_sales"]), clustered=cluster_fact)
    if fact_by_year:
        ready["fct_sales"] = sinks.prepare(mart.with_year(fct), _p(out_dir, "mart", "fct_sales"), partition_by=["year"])
    else:
        ready["fct_sales"] = sinks.prepare(fct, _p(out_dir, "mart", "fct_sales"), contract=MART["fct_sales"])
    if enforce:
        from ..operators.audit import warehouse_report

        tables = stg | {name: table.table for name, table in ready.items()}
        report = sinks.materialize(warehouse_report(tables), _p(out_dir, "audit", "report"))
        res.tables["audit_report"] = _p(out_dir, "audit", "report")
        bad = {r.rule: r.n_bad for r in report.where("n_bad > 0").collect()
               if any(r.rule.startswith(e) for e in enforce)}
        if bad:
            raise ConstraintViolation(f"enforced rules violated: {bad}")


def rebuild_years(spark: SparkSession, out_dir: str, years: list[int]) -> str:
    """Build the fact rows of some years again from the staged lines, and replace those years' folders only.

    For a fact written with ``fact_by_year``.  Only lines of those days are
    read from staging and looked up in the newest dimensions.
    """
    with sinks.TableScope(spark):
        t = {n: spark.read.parquet(_p(out_dir, "stg", n)) for n in ("stg_transactions",)} | {
            n: spark.read.parquet(_p(out_dir, "mart", n)) for n in ("dim_date", "dim_products", "dim_stores")}
        base = _p(out_dir, "mart", "dim_customers")
        dim = spark.read.parquet(version_path(base, latest_version(base, spark)))
        lines = t["stg_transactions"].where(F.year("transaction_datetime").isin(*years))
        fct = mart.build_fct_sales(lines, t["dim_date"], t["dim_products"], t["dim_stores"], dim)
        path = _p(out_dir, "mart", "fct_sales")
        fct = mart.with_year(mart.fact_layout(sinks.conform(fct, MART["fct_sales"])))
        sinks.replace_partitions(fct.where(F.col("year").isin(*years)), path, ["year"])
    return path


def read_warehouse(spark: SparkSession, out_dir: str) -> dict[str, DataFrame]:
    """The staging and mart tables of a warehouse folder (newest customer version)."""
    t = {n: spark.read.parquet(_p(out_dir, "stg", n)) for n in STG_SOURCES}
    for n in ("dim_date", "dim_products", "dim_stores", "fct_sales"):
        t[n] = spark.read.parquet(_p(out_dir, "mart", n))
    base = _p(out_dir, "mart", "dim_customers")
    v = latest_version(base, spark)
    if v is None:
        raise FileNotFoundError(f"no customer dimension under {base}")
    t["dim_customers"] = spark.read.parquet(version_path(base, v))
    return t


def run_scd2_delta(spark: SparkSession, customers_csv: str, out_dir: str, as_of,
                   tracked: tuple[str, ...] = ("city",), collation: str | None = None) -> str:
    """Restage a customer feed and apply it to the newest customer
    dimension version; returns the path of the new version (D13)."""
    raw = align_to_schema(read_csv(spark, customers_csv), list(RAW_LENGTHS["raw_customers"]))
    stg = staging.stage_customers(raw)
    base = _p(out_dir, "mart", "dim_customers")
    v = latest_version(base, spark)
    if v is None:
        raise FileNotFoundError(f"no customer dimension under {base}")
    dim = spark.read.parquet(version_path(base, v))
    with sinks.TableScope(spark):
        return write_version(sinks.conform(scd2.scd2_apply(dim, stg, as_of, tracked, collation), MART["dim_customers"]), base, v + 1)


__all__ = ["run_pipeline", "rebuild_years", "run_scd2_delta", "read_warehouse", "stage_layer", "RunResult",
           "ConstraintViolation", "SOURCE_FILES"]

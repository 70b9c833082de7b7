"""Command line: the source's run order as two commands.

    python -m tillstar run   --raw RAW_DIR --out WAREHOUSE_DIR [--as-of YYYY-MM-DD]
    python -m tillstar delta --customers customers.csv --out WAREHOUSE_DIR [--as-of YYYY-MM-DD]

``run`` loads the seven CSV feeds, writes the staging tables, the four
dimensions (customer version 1) and the fact.  ``delta`` applies a new
customer feed to the newest customer dimension version.  ``--as-of``
defaults to today, as the source's CURDATE() does; it is fixed once for
the whole run.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json
import sys


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="tillstar")
    sub = p.add_subparsers(dest="cmd", required=True)
    r = sub.add_parser("run", help="full rebuild from raw CSV feeds")
    r.add_argument("--raw", required=True)
    r.add_argument("--out", required=True)
    r.add_argument("--as-of", type=dt.date.fromisoformat, default=dt.date.today())
    r.add_argument("--cluster-fact", action="store_true",
                   help="range-partition the fact by date before writing")
    r.add_argument("--enforce", action="append", default=[],
                   help="audit rule prefix that must have no bad rows, e.g. fct_sales.fk: (repeatable)")
    r.add_argument("--input-bytes", type=int, default=None,
                   help="size of the raw input; sizes shuffle and scan partitions (session.scale_conf)")
    d = sub.add_parser("delta", help="apply a customer feed as an SCD2 delta")
    d.add_argument("--customers", required=True)
    d.add_argument("--out", required=True)
    d.add_argument("--as-of", type=dt.date.fromisoformat, default=dt.date.today())
    d.add_argument("--collation", default=None)
    w = sub.add_parser("stream", help="apply customer files landing in a folder as SCD2 deltas")
    w.add_argument("--landing", required=True, help="folder the customer CSV files arrive in")
    w.add_argument("--out", required=True, help="warehouse folder written by `run`")
    w.add_argument("--checkpoint", required=True, help="stream checkpoint folder (shared storage)")
    w.add_argument("--columns", default="customer_id,name,city,birthday",
                   help="header layout of the landing files")
    w.add_argument("--continuous", action="store_true", help="keep running (default: process what is there)")
    q = sub.add_parser("audit", help="data-quality report over a built warehouse")
    q.add_argument("--out", required=True, help="warehouse folder written by `run`")
    q.add_argument("--raw", default=None, help="raw CSV folder, for the raw-text rules")
    for x in (r, d, w, q):
        x.add_argument("--master", default=None, help="e.g. local[8]; default: from spark-submit")
    a = p.parse_args(argv)

    from .plans.pipeline import run_pipeline, run_scd2_delta
    from .session import get_session, scale_conf

    spark = get_session("tillstar", master=a.master)
    if getattr(a, "input_bytes", None):
        for k, v in scale_conf(a.input_bytes).items():
            spark.conf.set(k, v)
    if a.cmd == "run":
        res = run_pipeline(spark, a.raw, a.out, a.as_of, cluster_fact=a.cluster_fact,
                           enforce=tuple(a.enforce))
        print(json.dumps({"tables": res.tables, "skipped_sources": res.skipped_sources,
                          "kept_tables": res.kept_tables, "rows": res.rows}))
    elif a.cmd == "stream":
        import os

        from .streaming.scd2_stream import start_customer_stream

        query = start_customer_stream(spark, a.landing, os.path.join(a.out, "mart", "dim_customers"),
                                      a.checkpoint, available_now=not a.continuous,
                                      columns=tuple(a.columns.split(",")))
        query.awaitTermination()
        print(json.dumps({"stream": "done"}))
    elif a.cmd == "delta":
        path = run_scd2_delta(spark, a.customers, a.out, a.as_of, collation=a.collation)
        print(json.dumps({"dim_customers": path}))
    else:
        from .plans.pipeline import read_warehouse
        from .operators.audit import warehouse_report
        from .sources.csv_source import load_all

        raw = load_all(spark, a.raw).loaded if a.raw else None
        rows = warehouse_report(read_warehouse(spark, a.out), raw).collect()
        print(json.dumps({r.rule: r.n_bad for r in rows}))
    return 0


if __name__ == "__main__":
    sys.exit(main())

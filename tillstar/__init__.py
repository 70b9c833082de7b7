"""tillstar: a retail star-schema warehouse built as Spark DataFrame jobs.

Raw till feeds (receipt headers and lines, products, prices, promotions,
stores, loyalty customers) are typed into staging tables and then into a
star schema with an SCD type 2 customer dimension.  Every step is a
function from DataFrames to a DataFrame, written with built-in Spark SQL
functions so Catalyst can prune, push down and plan it.
"""

__version__ = "0.1.0"

# Main entry points, imported on first use so that ``import tillstar`` stays light.
_EXPORTS = {
    "get_session": "tillstar.session",
    "run_pipeline": "tillstar.plans.pipeline",
    "run_scd2_delta": "tillstar.plans.pipeline",
    "read_warehouse": "tillstar.plans.pipeline",
    "load_all": "tillstar.sources.csv_source",
    "stage_all": "tillstar.operators.staging",
    "build_dim_date": "tillstar.operators.calendar",
    "build_dim_products": "tillstar.operators.mart",
    "build_dim_stores": "tillstar.operators.mart",
    "build_dim_customers": "tillstar.operators.scd2",
    "build_fct_sales": "tillstar.operators.mart",
    "sales_by_city_at_sale": "tillstar.operators.mart",
    "scd2_apply": "tillstar.operators.scd2",
    "warehouse_report": "tillstar.operators.audit",
}


def __getattr__(name):
    if name in _EXPORTS:
        import importlib

        return getattr(importlib.import_module(_EXPORTS[name]), name)
    raise AttributeError(name)


__all__ = sorted(_EXPORTS)

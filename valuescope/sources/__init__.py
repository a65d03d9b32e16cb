"""Sources and sinks: canonical transaction tables and report writers."""

from valuescope.sources.transactions import (  # noqa: F401
    dirty_transactions,
    ingest,
    ingest_rejects,
    read_raw_transactions,
    read_table,
    rejects,
    standardize,
    transactions_from_events,
    transactions_from_orders,
    union_sources,
)
from valuescope.sources.sinks import (  # noqa: F401
    load_model,
    order_violations,
    read_ordered,
    save_model,
    write_ordered,
    write_parquet,
    write_report_csv,
)

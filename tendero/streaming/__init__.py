from tendero.streaming.feed import (
    dedup_feed,
    hourly_sales,
    ingest,
    no_data_alerts,
    rejection_findings,
    rolling_sales_stream,
    run_available,
    upsert_stream,
    validate,
)

__all__ = [
    "dedup_feed",
    "hourly_sales",
    "ingest",
    "no_data_alerts",
    "rejection_findings",
    "rolling_sales_stream",
    "run_available",
    "upsert_stream",
    "validate",
]

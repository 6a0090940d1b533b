from tendero.sources.benchmark import event_feed, event_stream, retail_tables
from tendero.sources.files import load_table, load_tables, read_csv_table, split_bad_rows
from tendero.sources.layout import store_retail, stored_retail
from tendero.sources.sinks import describe_table, export, list_tables, preview, register_views, run_sql, save

__all__ = [
    "describe_table",
    "event_feed",
    "event_stream",
    "export",
    "list_tables",
    "load_table",
    "load_tables",
    "preview",
    "read_csv_table",
    "register_views",
    "retail_tables",
    "run_sql",
    "save",
    "split_bad_rows",
    "store_retail",
    "stored_retail",
]

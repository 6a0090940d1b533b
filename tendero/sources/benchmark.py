"""Retail views over the benchmark tables (region, nation, customer, supplier, part, orders,
lineitem, events), so every operator runs on them unchanged."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tendero.schemas import COMPLETED, CONTROL, RETURNED, TREATMENT, Tables

# Explicit schemas: no footer is read to plan a query.
SOURCE_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}

TRIAL_START, TRIAL_END = "2000-09-01", "2000-10-12"
DUAL_VARIANT_STORES = (8, 17)


def read_source(spark: SparkSession, directory: str, name: str) -> DataFrame:
    return spark.read.schema(SOURCE_SCHEMAS[name]).parquet(f"{directory}/{name}.parquet")


def raw_event_stream(spark: SparkSession, directory: str, **options: str) -> DataFrame:
    reader = spark.readStream.schema(SOURCE_SCHEMAS["events"]).option("pathGlobFilter", "events.parquet")
    return reader.options(**options).parquet(directory)


class _LazyTables(Mapping[str, DataFrame]):
    """Builds a table's plan on first use, so a query pays only for the tables it reads."""

    def __init__(self, builders: dict[str, Callable[[], DataFrame]]):
        self._builders = builders
        self._built: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = self._builders[name]()
        return self._built[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._builders)

    def __len__(self) -> int:
        return len(self._builders)


def retail_tables(spark: SparkSession, directory: str) -> Tables:
    def read(name: str) -> DataFrame:
        return read_source(spark, directory, name)

    def stores() -> DataFrame:
        key = F.col("n_nationkey")
        return read("nation").join(read("region"), F.col("r_regionkey") == F.col("n_regionkey")).select(
            key.alias("store_id"),
            F.col("n_name").alias("store_name"),
            F.col("r_name").alias("country"),
            F.col("n_name").alias("city"),
            F.when(key % 4 == 0, "HIPERMERCADO")
            .when(key % 4 == 1, "SUPERMERCADO")
            .when(key % 4 == 2, "DESCUENTO")
            .otherwise("EXPRESS")
            .alias("format"),
            (key * 137 + 200).alias("size_sqm"),
            F.date_add(F.lit("1994-01-01").cast("date"), key * 100).alias("opening_date"),
            F.col("r_name").alias("region"),
        )

    def vendors() -> DataFrame:
        supplier = F.col("s_suppkey")
        return read("supplier").select(
            supplier.alias("vendor_id"),
            F.col("s_name").alias("vendor_name"),
            F.col("s_nationkey").cast("string").alias("country"),
            F.when(supplier % 3 == 0, "A").when(supplier % 3 == 1, "B").otherwise("C").alias("tier"),
            (F.col("s_acctbal") > 0).alias("is_shared_catalog"),
        )

    def products() -> DataFrame:
        return read("part").select(
            F.col("p_partkey").alias("item_id"),
            F.col("p_name").alias("item_name"),
            F.col("p_brand").alias("brand"),
            # One product in eleven has a vendor that is not in the list.
            F.when(F.col("p_partkey") % 11 == 10, -1).otherwise(F.col("p_partkey") % 10).alias("vendor_id"),
            F.col("p_type").alias("category"),
            F.concat(F.lit("Dep "), F.substring("p_type", 1, 3)).alias("department"),
            (F.col("p_retailprice") * 0.6).alias("cost"),
        )

    def transactions() -> DataFrame:
        identified = F.col("o_custkey") % 5 >= 3
        customers = read("customer").select("c_custkey", "c_nationkey")
        return read("orders").join(customers, F.col("c_custkey") == F.col("o_custkey")).select(
            F.col("o_orderkey").alias("transaction_id"),
            F.when(identified, F.col("o_custkey")).alias("customer_id"),
            F.col("o_orderdate").cast("date").alias("transaction_date"),
            F.col("c_nationkey").alias("store_id"),
            F.col("o_totalprice").alias("total_amount"),
            F.col("o_orderpriority").alias("payment_method"),
            identified.alias("loyalty_card"),
            F.when(F.col("o_orderstatus") == "P", RETURNED).otherwise(COMPLETED).alias("status"),
        )

    def transaction_items() -> DataFrame:
        line_key = F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"))
        return read("lineitem").select(
            line_key.alias("transaction_item_id"),
            F.col("l_orderkey").alias("transaction_id"),
            F.col("l_partkey").alias("item_id"),
            F.col("l_quantity").cast("int").alias("quantity"),
            (F.col("l_extendedprice") / F.col("l_quantity")).alias("unit_price"),
            (F.col("l_discount") >= 0.08).alias("was_on_promo"),
        )

    def store_promotions() -> DataFrame:
        key = F.col("n_nationkey")
        own = F.when(key % 2 == 0, F.lit(CONTROL)).otherwise(F.lit(TREATMENT))
        both = F.array(F.lit(CONTROL), F.lit(TREATMENT))
        assigned = F.when(key.isin(*DUAL_VARIANT_STORES), both).otherwise(F.array(own))
        return read("nation").select(
            key.alias("store_id"),
            F.lit("Exhibicion").alias("promo_name"),
            F.explode(assigned).alias("variant"),
            F.lit(TRIAL_START).cast("date").alias("start_date"),
            F.lit(TRIAL_END).cast("date").alias("end_date"),
            F.lit("EXHIBICION").alias("promo_type"),
        )

    builders = (stores, vendors, products, transactions, transaction_items, store_promotions)
    return _LazyTables({build.__name__: build for build in builders})


def _as_feed(events: DataFrame) -> DataFrame:
    return events.select(
        F.col("event_id").alias("transaction_id"),
        F.col("ts").cast("timestamp").alias("ts"),
        (F.col("user_id") % 25).alias("store_id"),
        F.col("value").alias("total_amount"),
        F.when(F.col("event_type") == "error", RETURNED).otherwise(COMPLETED).alias("status"),
    )


def event_feed(spark: SparkSession, directory: str) -> DataFrame:
    """The event table as a bounded hourly ticket feed."""
    return _as_feed(read_source(spark, directory, "events"))


def event_stream(spark: SparkSession, directory: str, **options: str) -> DataFrame:
    """The same feed as a file stream."""
    return _as_feed(raw_event_stream(spark, directory, **options))

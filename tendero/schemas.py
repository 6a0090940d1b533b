"""Base table schemas, natural keys and label constants."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import types as T

Tables = Mapping[str, DataFrame]

_S, _I, _D, _B, _DATE = T.StringType(), T.IntegerType(), T.DoubleType(), T.BooleanType(), T.DateType()


def _schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


SCHEMAS: dict[str, T.StructType] = {
    "vendors": _schema(
        ("vendor_id", _S), ("vendor_name", _S), ("country", _S), ("tier", _S), ("is_shared_catalog", _B)
    ),
    "stores": _schema(
        ("store_id", _S), ("store_name", _S), ("country", _S), ("city", _S), ("format", _S),
        ("size_sqm", _I), ("opening_date", _DATE), ("region", _S),
    ),
    "products": _schema(
        ("item_id", _S), ("item_name", _S), ("brand", _S), ("vendor_id", _S), ("category", _S),
        ("department", _S), ("cost", _D),
    ),
    "transactions": _schema(
        ("transaction_id", _S), ("customer_id", _S), ("transaction_date", _DATE), ("store_id", _S),
        ("total_amount", _D), ("payment_method", _S), ("loyalty_card", _B), ("status", _S),
    ),
    "transaction_items": _schema(
        ("transaction_item_id", _S), ("transaction_id", _S), ("item_id", _S), ("quantity", _I),
        ("unit_price", _D), ("was_on_promo", _B),
    ),
    "store_promotions": _schema(
        ("store_id", _S), ("promo_name", _S), ("variant", _S), ("start_date", _DATE),
        ("end_date", _DATE), ("promo_type", _S),
    ),
}

# Order used by count and validation reports.
TABLE_NAMES = ("transactions", "transaction_items", "stores", "products", "vendors", "store_promotions")

PRIMARY_KEYS: dict[str, tuple[str, ...]] = {
    "vendors": ("vendor_id",),
    "stores": ("store_id",),
    "products": ("item_id",),
    "transactions": ("transaction_id",),
    "transaction_items": ("transaction_item_id",),
}

# Status codes and labels that results must carry verbatim.
COMPLETED = "COMPLETED"
RETURNED = "RETURNED"
CONTROL = "CONTROL"
TREATMENT = "TREATMENT"
NO_VENDOR = "SIN_VENDOR"
LOW_PERFORMANCE = "BAJO_RENDIMIENTO"
OK = "OK"
TREND_UP = "CRECE"
TREND_DOWN = "DECRECE"
TREND_UNKNOWN = "SIN_DATOS"
LOW_MARGIN_RETURN = "RETORNO_MARGEN_BAJO_1"
PROMO_UPLIFT = "UPLIFT_REAL"
PROMO_UNITS_ONLY = "MAS_UNIDADES_CON_MENOR_TICKET"
PROMO_UNCLEAR = "SIN_UPLIFT_CLARO"
PRIORITY_HIGH = "PRIORIDAD_ALTA"
PRIORITY_MEDIUM = "PRIORIDAD_MEDIA"
MONITORING = "MONITOREO"
WITHOUT_CUSTOMER = "SIN_CLIENTE"
WITH_CUSTOMER = "CON_CLIENTE"

# English names of the product categories, used by English-language reports.
CATEGORY_EN = {
    "Electrónica": "Electronics",
    "Hogar": "Home",
    "Ropa": "Apparel",
    "Alimentos": "Food",
    "Juguetes": "Toys",
    "Bebidas": "Beverages",
    "Cuidado Personal": "Personal Care",
    "Limpieza": "Cleaning",
}

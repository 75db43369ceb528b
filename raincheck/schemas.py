"""Column definitions of the source files and of every final table.

A column is (name, spark type, max length for varchar or None, not null).
``struct_of`` turns a definition into a ``StructType``; ``conform`` in
``raincheck.operators.conform`` enforces the rest (length, not null, ANSI
casts) the way the relational target enforced them on insert.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import types as T


class Col(NamedTuple):
    name: str
    type: str
    max_len: int | None = None
    not_null: bool = False


def _c(name, type_, max_len=None, not_null=False):
    return Col(name, type_, max_len, not_null)


# ---------------------------------------------------------------- sources
# Header row of each CSV file, in file order (fixed values: the source files'
# own spelling, including "Discont").
CSV_HEADERS = {
    "customers": ["Customer ID", "Name", "Email", "Telephone", "City", "Country",
                  "Gender", "Date Of Birth", "Job Title"],
    "discounts": ["Start", "End", "Discont", "Description", "Category", "Sub Category"],
    "employees": ["Employee ID", "Store ID", "Name", "Position"],
    "products": ["Product ID", "Category", "Sub Category", "Description PT", "Description DE",
                 "Description FR", "Description ES", "Description EN", "Description ZH",
                 "Color", "Sizes", "Production Cost"],
    "stores": ["Store ID", "Country", "City", "Store Name", "Number of Employees",
               "ZIP Code", "Latitude", "Longitude"],
    "transactions": ["Invoice ID", "Line", "Customer ID", "Product ID", "Size", "Color",
                     "Unit Price", "Quantity", "Date", "Discount", "Line Total", "Store ID",
                     "Employee ID", "Currency", "Currency Symbol", "SKU", "Transaction Type",
                     "Payment Method", "Invoice Total"],
}

# Flattened weather file, in file column order.
WEATHER_FILE_COLUMNS = ["date_id", "store_id", "temp_max", "temp_min", "is_rain"]

# Payload body of one weather request: daily parallel arrays.
WEATHER_BODY_DDL = ("daily struct<time: array<string>, temperature_2m_max: array<double>, "
                    "temperature_2m_min: array<double>, precipitation_sum: array<double>>")

# ---------------------------------------------------------------- final tables
# Table, column and type names are the contract of the warehouse (fixed values).
DIM_DATES = [
    _c("date_id", "date", not_null=True), _c("year", "int", not_null=True),
    _c("quarter", "int", not_null=True), _c("month", "int", not_null=True),
    _c("month_name", "string", not_null=True), _c("week", "int", not_null=True),
    _c("day", "int", not_null=True), _c("day_of_week", "int", not_null=True),
    _c("day_name", "string", not_null=True),
]
DIM_CUSTOMERS = [
    _c("customer_id", "int", not_null=True), _c("name", "string", 50), _c("email", "string", 200),
    _c("telephone", "string"), _c("city", "string", 50), _c("country", "string", 50),
    _c("gender", "string", 10), _c("date_of_birth", "date"), _c("job_title", "string"),
]
DIM_DISCOUNTS = [
    _c("start_date_id", "date", not_null=True), _c("end_date_id", "date", not_null=True),
    _c("discount_rate", "decimal(3,2)", not_null=True), _c("description", "string"),
    _c("category", "string"), _c("sub_category", "string"),
]
DIM_EMPLOYEES = [
    _c("employee_id", "int", not_null=True), _c("store_id", "int"),
    _c("name", "string", 255), _c("position", "string", 255),
]
DIM_PRODUCTS = [
    _c("product_id", "int", not_null=True), _c("category", "string", 255),
    _c("sub_category", "string", 255), _c("description_pt", "string"),
    _c("description_de", "string"), _c("description_fr", "string"),
    _c("description_es", "string"), _c("description_en", "string"),
    _c("description_zh", "string"), _c("color", "string", 50), _c("sizes", "string", 255),
    _c("production_cost", "decimal(10,2)"),
]
DIM_STORES = [
    _c("store_id", "int", not_null=True), _c("country", "string", 255), _c("city", "string", 255),
    _c("store_name", "string", 255), _c("number_of_employees", "int"),
    _c("zip_code", "string", 20), _c("size", "string", 10),
    _c("latitude", "decimal(9,6)"), _c("longitude", "decimal(9,6)"),
]
FACT_TRANSACTIONS = [
    _c("invoice_id", "string"), _c("line", "int"), _c("customer_id", "int"),
    _c("product_id", "int"), _c("size", "string", 5), _c("color", "string", 20),
    _c("unit_price", "double"), _c("quantity", "int"), _c("date", "date"),
    _c("datetime", "date"), _c("discount", "double"), _c("line_total", "double"),
    _c("store_id", "int"), _c("employee_id", "int"), _c("currency", "string", 10),
    _c("currency_symbol", "string", 10), _c("sku", "string"),
    _c("transaction_type", "string"), _c("payment_method", "string", 20),
    _c("invoice_total", "decimal(10,0)"),
]
DIM_STORE_WEATHER = [
    _c("store_id", "int"), _c("date_id", "date"), _c("temp_max", "decimal(5,2)"),
    _c("temp_min", "decimal(5,2)"), _c("is_rain", "boolean"),
]


def _marts(money: str, count: str, qty: str):
    m1 = [
        _c("country", "string", 50), _c("city", "string", 50), _c("store_size", "string", 10),
        _c("is_rain", "boolean"), _c("sale_date", "date"), _c("transaction_count", count),
        _c("total_revenue", money), _c("avg_temp_max", "decimal(5,2)"),
        _c("avg_temp_min", "decimal(5,2)"),
    ]
    m2 = [
        _c("product_id", "int"), _c("category", "string", 255), _c("sub_category", "string", 255),
        _c("is_rain", "boolean"), _c("temperature_range", "string", 10),
        _c("transaction_count", count), _c("total_quantity", qty), _c("total_revenue", money),
    ]
    m3 = [
        _c("store_size", "string", 10), _c("is_rain", "boolean"),
        _c("temperature_range", "string", 10), _c("transaction_count", count),
        _c("avg_transaction_value", money), _c("total_revenue", money),
    ]
    return m1, m2, m3


# Default: wide money and bigint counts (a mart cell passes 10^10 at sf0.1).
MART_REGION, MART_PRODUCT, MART_SIZE = _marts("decimal(18,2)", "bigint", "bigint")
# strict_types=True: the declared widths of the relational target.
STRICT_MART_REGION, STRICT_MART_PRODUCT, STRICT_MART_SIZE = _marts("decimal(12,2)", "int", "int")

TABLES = {
    "dim_dates": DIM_DATES,
    "dim_customers": DIM_CUSTOMERS,
    "dim_discounts": DIM_DISCOUNTS,
    "dim_employees": DIM_EMPLOYEES,
    "dim_products": DIM_PRODUCTS,
    "dim_stores": DIM_STORES,
    "fact_transactions": FACT_TRANSACTIONS,
    "dim_store_weather": DIM_STORE_WEATHER,
    "data_mart_weather_region_impact": MART_REGION,
    "data_mart_product_weather_sensitivity": MART_PRODUCT,
    "data_mart_store_size_weather_impact": MART_SIZE,
}

STRICT_MARTS = {
    "data_mart_weather_region_impact": STRICT_MART_REGION,
    "data_mart_product_weather_sensitivity": STRICT_MART_PRODUCT,
    "data_mart_store_size_weather_impact": STRICT_MART_SIZE,
}

# Primary keys (tables with only a serial key have none).
PRIMARY_KEYS = {
    "dim_dates": ["date_id"],
    "dim_customers": ["customer_id"],
    "dim_employees": ["employee_id"],
    "dim_products": ["product_id"],
    "dim_stores": ["store_id"],
}


_SIMPLE = {
    "int": T.IntegerType(), "bigint": T.LongType(), "string": T.StringType(),
    "date": T.DateType(), "double": T.DoubleType(), "boolean": T.BooleanType(),
}


def spark_type(type_: str) -> T.DataType:
    if type_ in _SIMPLE:
        return _SIMPLE[type_]
    if type_.startswith("decimal("):
        p, s = type_[len("decimal("):-1].split(",")
        return T.DecimalType(int(p), int(s))
    raise ValueError(f"unknown column type {type_!r}")


def struct_of(cols: list[Col]) -> T.StructType:
    return T.StructType([T.StructField(c.name, spark_type(c.type), not c.not_null) for c in cols])


def all_string_schema(headers: list[str]) -> T.StructType:
    return T.StructType([T.StructField(h, T.StringType(), True) for h in headers])

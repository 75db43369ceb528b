"""Retail x weather staging data derived from the driver's TPC-H-like tables.

The source CSV files and weather payloads are not shipped, so tests and the
benchmark derive them, deterministically, from ``supplier`` (stores),
``part`` (products), ``customer`` (customers, employees), ``lineitem`` ⋈
``orders`` (invoice lines) and the stores' ship days in ``lineitem``
(weather). The frames carry the CSV header names, so they go through exactly the same
rename/cast operators as a real CSV load. All work is Spark-side and grows
with the input tables.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the fixture definition (FIXTURES.md §4): day numbering
# origin, first discount day, and the moduli of the synthetic weather.
DAY_ZERO = "1995-01-01"
DISCOUNT_DAY_ZERO = "1995-01-02"


# Schemas of the driver's tables, which are read-only inputs: inferred once
# per process, then passed to the reader (no schema-inference job per read).
_SCHEMAS: dict[str, object] = {}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    if path not in _SCHEMAS:
        df = spark.read.parquet(path)
        _SCHEMAS[path] = df.schema
        return df
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def day_number(c: Column) -> Column:
    """Days since DAY_ZERO."""
    return F.datediff(c, F.lit(DAY_ZERO).cast("date"))


class RetailFixture:
    """Lazily built staging frames over one scale-factor directory."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self._tables: dict[str, DataFrame] = {}

    def t(self, name: str) -> DataFrame:
        """One reader per table (the schema is resolved once per fixture)."""
        if name not in self._tables:
            self._tables[name] = read_table(self.spark, self.sf_dir, name)
        return self._tables[name]

    # ------------------------------------------------------------ geography
    def _nation_region(self) -> DataFrame:
        n = self.t("nation").select("n_nationkey", "n_name", "n_regionkey")
        r = self.t("region").select("r_regionkey", "r_name")
        return n.join(r, n.n_regionkey == r.r_regionkey).select("n_nationkey", "n_name", "r_name")

    # ------------------------------------------------------------ stores
    @cached_property
    def staging_stores(self) -> DataFrame:
        s = self.t("supplier").select("s_suppkey", "s_name", "s_nationkey")
        geo = self._nation_region()  # 25 rows: the planner broadcasts it by file size
        j = s.join(geo, s.s_nationkey == geo.n_nationkey)
        k = F.col("s_suppkey")
        return j.select(
            k.alias("Store ID"),
            F.col("r_name").alias("Country"),
            F.col("n_name").alias("City"),
            F.col("s_name").alias("Store Name"),
            F.when(k % 37 == 36, F.lit(None)).otherwise((3 + k % 10).cast("int")).alias("Number of Employees"),
            F.lpad(k.cast("string"), 5, "0").alias("ZIP Code"),
            ((k * 13 % 1200 - 600) / F.lit(10.0)).cast("decimal(9,6)").alias("Latitude"),
            ((k * 29 % 3600 - 1800) / F.lit(10.0)).cast("decimal(9,6)").alias("Longitude"),
        )

    # ------------------------------------------------------------ products
    @cached_property
    def staging_products(self) -> DataFrame:
        p = self.t("part")
        none = F.lit(None).cast("string")
        return p.select(
            F.col("p_partkey").alias("Product ID"),
            F.col("p_type").alias("Category"),
            F.col("p_brand").alias("Sub Category"),
            none.alias("Description PT"), none.alias("Description DE"),
            none.alias("Description FR"), none.alias("Description ES"),
            F.col("p_name").alias("Description EN"), none.alias("Description ZH"),
            none.alias("Color"),
            F.col("p_size").cast("string").alias("Sizes"),
            F.col("p_retailprice").cast("decimal(10,2)").alias("Production Cost"),
        )

    # ------------------------------------------------------------ customers, employees
    @cached_property
    def staging_customers(self) -> DataFrame:
        c = self.t("customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
        geo = self._nation_region()  # 25 rows: the planner broadcasts it by file size
        none = F.lit(None).cast("string")
        return c.join(geo, c.c_nationkey == geo.n_nationkey).select(
            F.col("c_custkey").alias("Customer ID"), F.col("c_name").alias("Name"),
            none.alias("Email"), none.alias("Telephone"),
            F.col("n_name").alias("City"), F.col("r_name").alias("Country"),
            none.alias("Gender"), none.alias("Date Of Birth"),
            F.col("c_mktsegment").alias("Job Title"),
        )

    @cached_property
    def staging_employees(self) -> DataFrame:
        c = self.t("customer")
        return c.select(
            F.col("c_custkey").alias("Employee ID"), (F.col("c_custkey") % 10).alias("Store ID"),
            F.col("c_name").alias("Name"), F.col("c_mktsegment").alias("Position"),
        )

    # ------------------------------------------------------------ discounts
    @cached_property
    def staging_discounts(self) -> DataFrame:
        return self.staging_discounts_with()

    def staging_discounts_with(self, *more: str) -> DataFrame:
        """The discounts, with further columns of the part each comes from."""
        p = self.t("part")
        k = F.col("p_partkey")
        day0 = F.lit(DISCOUNT_DAY_ZERO).cast("date")
        return p.select(
            *more,
            F.date_add(day0, (k % 2000).cast("int")).alias("Start"),
            F.date_add(day0, (k % 2000 + 14).cast("int")).alias("End"),
            F.expr("cast((p_partkey % 50) / 100.0 as decimal(3,2))").alias("Discont"),
            F.col("p_name").alias("Description"), F.col("p_type").alias("Category"),
            F.col("p_brand").alias("Sub Category"),
        )

    # ------------------------------------------------------------ invoice lines
    @cached_property
    def staging_transactions(self) -> DataFrame:
        # The days and flags are taken before the join: they are narrower than what they are read from.
        li = self.t("lineitem").select(
            "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount",
            (F.col("l_returnflag") == "R").alias("returned"), (F.col("l_linestatus") == "F").alias("cash"),
            F.to_date("l_shipdate").alias("ship_day"))
        o = self.t("orders").select("o_orderkey", "o_custkey", "o_totalprice")
        # Both sides are fact-sized: a sort-merge join on the order key, so
        # the per-line expressions below run in the parallel join tasks.
        j = li.join(o.hint("merge"), li.l_orderkey == o.o_orderkey)
        ln = F.col("l_linenumber")
        ship_day = F.col("ship_day").cast("string")
        line_total = (F.col("l_extendedprice").cast("decimal(18,4)")
                      * (1 - F.col("l_discount")).cast("decimal(3,2)")).cast("decimal(18,4)")
        none = F.lit(None).cast("string")
        return j.select(
            F.concat(F.lit("INV-"), F.col("l_orderkey").cast("string")).alias("Invoice ID"),
            ln.alias("Line"),
            F.col("o_custkey").alias("Customer ID"),
            F.col("l_partkey").alias("Product ID"),
            F.when(ln % 4 == 0, "S").when(ln % 4 == 1, "M").when(ln % 4 == 2, "XL").alias("Size"),
            none.alias("Color"),
            (F.col("l_extendedprice") / F.col("l_quantity")).alias("Unit Price"),
            F.col("l_quantity").cast("int").alias("Quantity"),
            F.concat(ship_day, F.lit(" 1"), ln.cast("string"), F.lit(":30:00")).alias("Date"),
            F.col("l_discount").alias("Discount"),
            line_total.alias("Line Total"),
            F.col("l_suppkey").alias("Store ID"),
            F.col("o_custkey").alias("Employee ID"),
            F.when(F.col("l_suppkey") % 3 == 0, "USD").when(F.col("l_suppkey") % 3 == 1, "EUR")
             .otherwise("GBP").alias("Currency"),
            none.alias("Currency Symbol"), none.alias("SKU"),
            F.when(F.col("returned"), "Return").otherwise("Sale").alias("Transaction Type"),
            F.when(F.col("cash"), "Cash").otherwise("Credit Card").alias("Payment Method"),
            F.col("o_totalprice").cast("decimal(18,2)").alias("Invoice Total"),
        )

    # ------------------------------------------------------------ weather
    @cached_property
    def staging_weather(self) -> DataFrame:
        """One row per store and day on which it ships (one in ten store-days
        missing): store_id, date_id, temp_max, temp_min, precipitation (mm)."""
        return self._weather_on(self._ship_days().distinct())

    def _ship_days(self) -> DataFrame:
        return self.t("lineitem").select(F.col("l_suppkey").alias("store_id"), F.to_date("l_shipdate").alias("date_id"))

    def _weather_on(self, days: DataFrame) -> DataFrame:
        s, dn = F.col("store_id"), day_number(F.col("date_id"))
        wet = (s * 31 + dn * 17) % 61
        heat = (s * 37 + dn * 101) % 4501
        return (days.filter((s + dn) % 10 != 0).select(
            "store_id", "date_id",
            F.when(wet % 20 == 7, F.lit(None))
             .otherwise(((heat - 500) / F.lit(100.0)).cast("decimal(5,2)")).alias("temp_max"),
            ((heat - 1150) / F.lit(100.0)).cast("decimal(5,2)").alias("temp_min"),
            F.when(wet == 60, F.lit(None)).otherwise(wet / F.lit(10.0)).alias("precipitation"),
        ))

    @cached_property
    def weather_payloads(self) -> DataFrame:
        # The same days, found as one set a store (bounded by the day span), so
        # that a store's rows already lie together when its payload is made.
        sets = self._ship_days().groupBy("store_id").agg(F.collect_set("date_id").alias("dates"))
        return self.payloads_of(self._weather_on(sets.select("store_id", F.explode("dates").alias("date_id"))))

    def payloads_of(self, w: DataFrame) -> DataFrame:
        """One JSON payload per store, as a forecast service returns it:
        store_id, status, body. A store holds at most one row per calendar
        day, so each payload is bounded by the day span."""
        g = w.groupBy("store_id").agg(F.sort_array(F.collect_list(F.struct(
            F.col("date_id").cast("string").alias("time"),
            F.col("temp_max").cast("double").alias("tmax"),
            F.col("temp_min").cast("double").alias("tmin"),
            F.col("precipitation").alias("prcp")))).alias("days"))
        daily = F.struct(
            F.transform("days", lambda x: x["time"]).alias("time"),
            F.transform("days", lambda x: x["tmax"]).alias("temperature_2m_max"),
            F.transform("days", lambda x: x["tmin"]).alias("temperature_2m_min"),
            F.transform("days", lambda x: x["prcp"]).alias("precipitation_sum"))
        return g.select(
            "store_id", F.lit(200).alias("status"),
            F.to_json(F.struct(daily.alias("daily"))).alias("body"))

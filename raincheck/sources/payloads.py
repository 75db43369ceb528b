"""Weather payloads: flatten (S4), rain flag (P7), weather file (S5, S6), merge (R2).

A payload is one forecast response per store: rows ``store_id, status,
body`` where ``body`` holds ``daily`` parallel arrays. Failed requests
(status other than 200) are skipped and counted.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from raincheck import schemas as S
from raincheck.functions.dates import day_offset
from raincheck.functions.weather import rain_flag
from raincheck.operators.conform import conform
from raincheck.sources import csv, tables

OK_STATUS = 200
FAILED_STATUS = 400
#: Days of history that a forecast request asks for (fixed value).
PAST_DAYS = 92
_ARRAYS = ["time", "temperature_2m_max", "temperature_2m_min", "precipitation_sum"]


def read_payload_files(spark: SparkSession, path: str) -> DataFrame:
    """Saved forecast responses, one JSON document per file named
    ``<store_id>.json`` (or ``store_<store_id>.json``), as payload rows
    (store_id, status, body). Each file is read whole, as one row; a file
    holds one store's response, so its size is bounded by the day range.
    A file name without a store id is an error. The status is taken from the
    content: a response that says ``"error": true``, or has no ``daily``
    block, is a failed request.
    """
    raw = spark.read.option("wholetext", True).text(path)
    file = F.col("_metadata.file_name")
    name = F.regexp_extract(file, r"(\d+)\.json$", 1)
    failed = F.coalesce(F.get_json_object("value", "$.error"), F.lit("false")) == "true"
    failed = failed | F.get_json_object("value", "$.daily").isNull()
    return raw.select(
        F.when(name != "", name).otherwise(F.raise_error(F.concat(
            F.lit("no store id in the payload file name "), file))).cast("int").alias("store_id"),
        F.when(failed, F.lit(FAILED_STATUS)).otherwise(F.lit(OK_STATUS)).alias("status"),
        F.col("value").alias("body"))


def parse_payloads(payloads: DataFrame, audit: Observation | None = None) -> DataFrame:
    """Keep successful payloads and pick the daily arrays.

    Days follow ``time``: a value array longer than ``time`` is cut to its
    length; a shorter one (or a missing ``daily`` block) raises, since the
    day would have no value.
    """
    ok = F.col("status") == OK_STATUS
    if audit is not None:
        payloads = payloads.observe(
            audit, F.count(F.lit(1)).alias("payloads"),
            F.count(F.when(~ok | F.col("status").isNull(), 1)).alias("failed_payloads"))
    p = payloads.filter(ok).select(
        "store_id", F.from_json("body", S.WEATHER_BODY_DDL).alias("b"))
    d = F.col("b.daily")
    n = F.size(d["time"])
    complete = d["time"].isNotNull()
    for a in _ARRAYS[1:]:
        complete = complete & d[a].isNotNull() & (F.size(d[a]) >= n)
    daily = F.struct(d["time"].alias("time"), *[F.slice(d[a], 1, n).alias(a) for a in _ARRAYS[1:]])
    return p.select("store_id", F.when(complete, daily).otherwise(F.raise_error(
        F.concat(F.lit("weather payload for store "), F.col("store_id").cast("string"),
                 F.lit(" lacks daily values for some days")))).alias("daily"))


def flatten_weather(payloads: DataFrame, audit: Observation | None = None) -> DataFrame:
    """One row per store and day: date_id (text), store_id, temp_max,
    temp_min, precipitation."""
    daily = parse_payloads(payloads, audit)
    z = F.explode(F.arrays_zip(*[F.col(f"daily.{a}").alias(a) for a in _ARRAYS])).alias("z")
    return daily.select("store_id", z).select(
        F.col("z.time").alias("date_id"), "store_id",
        F.col("z.temperature_2m_max").alias("temp_max"),
        F.col("z.temperature_2m_min").alias("temp_min"),
        F.col("z.precipitation_sum").alias("precipitation"))


def weather_records(flat: DataFrame) -> DataFrame:
    """Add ``is_rain`` and keep the weather-file columns, in file order."""
    return flat.select(*S.WEATHER_FILE_COLUMNS[:-1], rain_flag("precipitation").alias("is_rain"))


def store_weather(records: DataFrame) -> DataFrame:
    """Weather records conformed to the weather table types."""
    return conform(records, S.DIM_STORE_WEATHER, "dim_store_weather")


def weather_file_name(run_date: dt.date) -> str:
    """S5 name: the day before the run date, yyyy-MM-dd."""
    return (run_date - dt.timedelta(days=1)).strftime("%Y-%m-%d")


def weather_file_day(run_date_col) -> F.Column:
    """P14 as a column expression (the same rule as ``weather_file_name``)."""
    return day_offset(run_date_col, 1)


def write_weather_file(records: DataFrame, out_dir: str, run_date: dt.date, batch_id: str = "") -> str:
    """Write the flattened weather as CSV with a header; returns the file's
    directory. A file that the same batch wrote before is replaced once the new
    one is complete: a failed write leaves it as it was."""
    path = f"{out_dir.rstrip('/')}/weather/{weather_file_name(run_date)}"
    if batch_id:
        path += f"/{batch_id}"
    spark = records.sparkSession
    jvm, top = spark._jvm, spark._jvm.org.apache.hadoop.fs.Path(path)
    draft = jvm.org.apache.hadoop.fs.Path(f"{top.getParent().toString()}/_draft-{uuid.uuid4().hex[:12]}")
    csv.write_csv(records.select(*S.WEATHER_FILE_COLUMNS), draft.toString(), mode="error")
    fs = top.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.delete(top, True)
    if not fs.rename(draft, top):
        raise RuntimeError(f"cannot put the weather file in place at {path}")
    return path


def load_weather(spark: SparkSession, path: str) -> DataFrame:
    """Read a weather file back, columns by name (text first, then typed)."""
    return store_weather(csv.scan_csv(spark, path, S.WEATHER_FILE_COLUMNS))


_VALUES = ["temp_max", "temp_min", "is_rain"]


def merge_weather(existing: DataFrame | None, incoming: DataFrame, run_date: dt.date, place=None) -> DataFrame:
    """R2: keyed merge on (store_id, date_id): the newest run wins (of one
    run date, the rows that come in), store-days that do not come in are kept.
    Returns rows with a ``run_date`` column. ``existing`` need only hold the
    months that come in. ``place`` lays the rows out for the write
    (``tables.in_shares``), whose column is kept.

    One aggregate per key (max of a struct led by the order, then the values,
    so ties are deterministic); partial aggregation bounds a hot key's work.
    """
    order = F.struct("run_date", "_new", *_VALUES)
    both = incoming.withColumn("run_date", F.lit(run_date)).withColumn("_new", F.lit(1))
    if existing is not None:
        both = existing.withColumn("_new", F.lit(0)).select(*both.columns).unionByName(both)
    places = [tables.SHARE] if place else []
    both = place(both) if place else both
    m = both.groupBy(*places, "store_id", "date_id").agg(F.max(order).alias("_w"))
    return m.select("store_id", "date_id", *[F.col(f"_w.{c}").alias(c) for c in (*_VALUES, "run_date")], *places)


# ---------------------------------------------------------------- requests
def weather_requests(staging_stores: DataFrame, past_days: int = PAST_DAYS) -> DataFrame:
    """The forecast requests of a batch: one per staged store, with its
    position and the days of history to ask for."""
    return staging_stores.select(
        F.col("`Store ID`").cast("int").alias("store_id"),
        F.col("`Latitude`").cast("decimal(9,6)").alias("latitude"),
        F.col("`Longitude`").cast("decimal(9,6)").alias("longitude"),
        F.lit(past_days).alias("past_days")).distinct()


def unanswered_requests(requests: DataFrame, payloads: DataFrame) -> DataFrame:
    """Requests without a successful payload."""
    ok = payloads.where(F.col("status") == OK_STATUS).select(F.col("store_id").cast("int").alias("store_id"))
    return requests.join(ok, "store_id", "left_anti")

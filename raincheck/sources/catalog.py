"""The written tables as tables of Spark's catalog (S7), and bucketed writes.

``define_tables`` creates every final table (``CREATE TABLE IF NOT EXISTS``)
with its declared types, text lengths included: an INSERT of a longer text fails
in Spark. ``publish`` points their partitions at the folders that hold the rows
now; it moves no data, and the plain tables' parts become partitions, so that
``spark.table("retail.fact_transactions")`` reads what the last run committed.
NOT NULL is declared too, but Spark does not enforce it for Parquet tables; the
load does (``operators.conform``).
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from raincheck import schemas as S
from raincheck.sources import tables

#: Columns that bucketed tables are clustered by: the key of lines and weather.
CLUSTER = ("store_id", "date")
#: Lines that a bucket holds at most: a task of the join without an exchange reads a whole bucket.
LINES_A_BUCKET = 2_000_000


def _column(c: S.Col) -> str:
    kind = f"varchar({c.max_len})" if c.max_len is not None else c.type
    return f"`{c.name}` {kind}{' NOT NULL' if c.not_null else ''}"


def table_ddl(database: str, name: str, root: str, strict_types: bool = False) -> str:
    """CREATE TABLE of a final table, partitioned by its parts."""
    columns = [_column(c) for c in (S.STRICT_MARTS.get(name) if strict_types else None) or S.TABLES[name]]
    declared = {c.name for c in S.TABLES[name]}
    columns += [f"`{f.name}` {f.dataType.simpleString()}" for f in tables.table_schema(name) if f.name not in declared]
    return (f"CREATE TABLE IF NOT EXISTS `{database}`.`{name}` ({', '.join(columns)}, `{tables.PART}` string) "
            f"USING parquet PARTITIONED BY (`{tables.PART}`) LOCATION '{tables.table_path(root, name)}/catalog'")


def define_tables(spark: SparkSession, root: str, database: str, strict_types: bool = False) -> list[str]:
    """Create every final table that is absent; existing ones are left alone."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    for name in S.TABLES:
        spark.sql(table_ddl(database, name, root, strict_types))
    return [f"{database}.{name}" for name in S.TABLES]


def point_at(spark: SparkSession, table: str, parts: dict[str, dict], path: str) -> None:
    """Make the partitions of a catalog table the given parts."""
    rows = spark.sql(f"SHOW PARTITIONS {table}").collect()
    unescape = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName
    held = {unescape(r[0].split("=", 1)[1]) for r in rows}
    quoted = {p: p.replace("'", "\\'") for p in held | set(parts)}
    if held:
        gone = ", ".join(f"PARTITION (`{tables.PART}` = '{quoted[p]}')" for p in sorted(held))
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {gone}")
    if parts:
        new = " ".join(f"PARTITION (`{tables.PART}` = '{quoted[n]}') LOCATION '{path}/{p['folder']}/{p['sub']}'"
                       for n, p in sorted(parts.items()))
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {new}")
    spark.catalog.refreshTable(table)


def publish(spark: SparkSession, root: str, database: str, strict_types: bool = False) -> list[str]:
    """Define the tables and let each read what its manifest names now."""
    names = define_tables(spark, root, database, strict_types)
    for name in S.TABLES:
        path = tables.table_path(root, name)
        point_at(spark, f"`{database}`.`{name}`", tables.live(spark, path), path)
    return names


# ---------------------------------------------------------------- buckets
def enough_buckets(least: int, lines: int) -> int:
    """``least`` buckets, doubled until none need hold more than ``LINES_A_BUCKET``."""
    n = least
    while lines > n * LINES_A_BUCKET:
        n *= 2
    return n


def _clustered(spark: SparkSession, schema, location: str, buckets: int, cluster) -> str:
    """An external table over a folder, partitioned by part and bucketed."""
    name = f"raincheck_{uuid.uuid4().hex[:12]}"
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema if f.name != tables.PART)
    spark.sql(f"CREATE TABLE {name} ({columns}, `{tables.PART}` string) USING parquet PARTITIONED BY (`{tables.PART}`) "
              f"CLUSTERED BY ({', '.join(f'`{c}`' for c in cluster)}) INTO {buckets} BUCKETS LOCATION '{location}'")
    return name


def write_bucketed(df: DataFrame, target: str, buckets: int, cluster=CLUSTER) -> None:
    """Write rows with a ``_part`` column into ``target``, each part in buckets."""
    spark = df.sparkSession
    name = _clustered(spark, df.schema, target, buckets, cluster)
    try:
        # A part's bucket comes from one task, so it is one file, however many tasks there are.
        (df.select(*[c for c in df.columns if c != tables.PART], tables.PART)
           .repartition(F.col(tables.PART), F.pmod(F.hash(*cluster), F.lit(buckets))).write.insertInto(name))
    finally:
        spark.sql(f"DROP TABLE {name}")             # the rows stay: the table is external


def read_bucketed(spark: SparkSession, path: str, schema, buckets: int, names=None, cluster=CLUSTER) -> DataFrame:
    """Parts written in buckets, as one bucketed table: a join on the cluster
    columns with another such table needs no exchange. The table stays in the
    session's catalog for as long as its frames may be read."""
    parts = {k: v for k, v in tables.live(spark, path).items() if names is None or k in names}
    if not parts:
        return spark.createDataFrame([], schema)
    name = _clustered(spark, schema, f"{path.rstrip('/')}/catalog", buckets, cluster)
    point_at(spark, name, parts, path.rstrip("/"))
    return spark.table(name).drop(tables.PART)

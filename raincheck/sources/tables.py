"""Tables as Parquet folders under one output root, each with a manifest.

A table's rows are written once, into a new folder, and become the table's
when its next manifest is committed: one small JSON file, put in place by a
rename, that names the folders which hold the table now. A job that is killed
leaves readers on the old rows and its half-written folder to a later clean-up;
running it again adds nothing twice. No job overwrites a path that it reads.

A table has *parts*, which are replaced one by one without touching the others:

  fact, discounts   -> one part a batch
  dimensions        -> one part for each load that added rows
  weather           -> one part a calendar month
  marts, staging    -> one part, or one a month (the regional mart)

There is one writer per table at a time, as there is one pipeline.
"""

from __future__ import annotations

import json
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from raincheck import schemas as S

#: Tables whose rows carry the batch that loaded them.
BATCHED = ("fact_transactions", "dim_discounts")
#: Name of the only part of a table without parts.
WHOLE = "all"
#: Folder level, and writer's column, that separates parts written by one job.
PART = "_part"
#: Column that tells the shares of parts apart while they are made.
SHARE = "_share"
#: Rows of a part that one share, so one task and file, takes on.
ROWS_A_SHARE = 1_000_000
#: Compression of the written files.
CODEC = "zstd"
#: Manifests that stay: the current one and the one readers may still hold.
KEPT = 2


def observed(obs: Observation) -> dict:
    """The metrics of an observed write; none when the optimizer proved the
    input empty and removed the plan that would have counted it."""
    try:
        return obs.get
    except Py4JJavaError:
        return {}


def table_path(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/{name}"


def table_schema(name: str) -> T.StructType:
    st = S.struct_of(S.TABLES[name])
    if name in BATCHED:
        st = st.add("batch_id", T.StringType())
    elif name == "dim_store_weather":
        st = st.add("run_date", T.DateType())
    return st


def month_of(day: str | Column) -> Column:
    """The part of a day: its calendar month, ``none`` without a day. Years of
    four digits, so almost all rows, need no formatter."""
    day = F.col(day) if isinstance(day, str) else day
    year, month = F.year(day), F.month(day)
    text = F.concat(year.cast("string"), F.when(month < 10, "-0").otherwise("-"), month.cast("string"))
    return F.coalesce(F.when(year.between(1000, 9999), text).otherwise(F.date_format(day, "yyyy-MM")), F.lit("none"))


def month_start(day: str) -> Column:
    """The first day of a day's month: tells months apart as ``month_of`` does,
    without a text for each row; ``month_of`` of it names the part."""
    return F.trunc(day, "month")


# ---------------------------------------------------------------- shares
def most_rows(df: DataFrame, by: Column) -> int:
    """Rows of the largest part; only the columns of ``by`` are read."""
    return df.groupBy(by.alias(PART)).count().agg(F.max("count")).first()[0] or 0


def in_shares(df: DataFrame, by: Column, rows: int, *spread: str) -> DataFrame:
    """Rows with the share of their part (a number), in the one exchange that an
    aggregate by share and ``spread``, and the write of its rows, need. ``rows``:
    those of the largest part, which is split by ``spread``. Shares that get the
    same number lie in the same task."""
    n = max(1, -(-rows // ROWS_A_SHARE))
    return df.withColumn(SHARE, F.hash(by, F.pmod(F.hash(*spread), F.lit(n)))).repartition(SHARE)


# ---------------------------------------------------------------- manifests
def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _names(spark: SparkSession, path: str) -> list[str]:
    fs, p = _fs(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def _delete(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def _numbers(spark: SparkSession, path: str) -> list[int]:
    return [int(n.split(".")[0]) for n in _names(spark, f"{path}/_manifest") if n.endswith(".json") and n[0] != "."]


def _manifest_path(path: str, number: int) -> str:
    return f"{path}/_manifest/{number:08d}.json"


def _read_manifest(spark: SparkSession, path: str, number: int) -> dict[str, dict]:
    fs, p = _fs(spark, _manifest_path(path, number))
    stream = fs.open(p)
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def live(spark: SparkSession, path: str) -> dict[str, dict]:
    """The parts that hold a table now: name -> folder, sub-folder, parts in
    that folder, and what the writer noted. Empty before the first commit."""
    path = path.rstrip("/")
    numbers = _numbers(spark, path)
    return _read_manifest(spark, path, numbers[-1]) if numbers else {}


def commit(spark: SparkSession, path: str, parts: dict[str, dict]) -> None:
    """Make ``parts`` the table, then clean up what no kept manifest names."""
    path = path.rstrip("/")
    numbers = _numbers(spark, path)
    number = numbers[-1] + 1 if numbers else 1
    fs, target = _fs(spark, _manifest_path(path, number))
    _, draft = _fs(spark, f"{path}/_manifest/.{uuid.uuid4().hex}")
    out = fs.create(draft)
    out.write(bytearray(json.dumps(parts).encode()))
    out.close()
    if fs.exists(target) or not fs.rename(draft, target):
        raise RuntimeError(f"another writer has committed to {path}")

    old, kept = numbers[:1 - KEPT] if KEPT > 1 else numbers, numbers[1 - KEPT:]
    named = [parts, *(_read_manifest(spark, path, n) for n in kept)]
    folders = {p["folder"] for m in named for p in m.values()}
    subs = {(p["folder"], p["sub"]) for m in named for p in m.values()}
    for n in old:
        for p in _read_manifest(spark, path, n).values():
            if p["folder"] in folders and (p["folder"], p["sub"]) not in subs:
                _delete(spark, f"{path}/{p['folder']}/{p['sub']}")
        _delete(spark, _manifest_path(path, n))
    for name in _names(spark, f"{path}/data"):
        if f"data/{name}" not in folders:
            _delete(spark, f"{path}/data/{name}")


# ---------------------------------------------------------------- writing
def write_parts(df: DataFrame, path: str, by: Column | None = None, buckets: int | None = None,
                cluster=("store_id", "date"), drop: str | None = None) -> dict[str, dict]:
    """Write rows into a new folder, not yet part of the table; the parts found
    there. ``by``: a text column that names each row's part. ``buckets``:
    clustered for joins without an exchange (``catalog``). ``drop``: a column
    that serves ``by`` alone. Rows that come ``in_shares`` stay in their tasks."""
    spark, folder = df.sparkSession, f"data/{uuid.uuid4().hex[:16]}"
    target = f"{path.rstrip('/')}/{folder}"
    if by is None:
        df.write.option("compression", CODEC).parquet(target)
        return {WHOLE: {"folder": folder, "sub": "", "of": 1}}
    split = df.withColumn(PART, by)
    split = split.drop(drop) if drop else split
    if buckets:
        from raincheck.sources import catalog
        catalog.write_bucketed(split, target, buckets, cluster)
    else:
        # One task, so one file, a part; a large part is split, small ones share a task.
        placed = split.drop(SHARE) if SHARE in split.columns else split.hint("rebalance", F.col(PART))
        placed.write.option("compression", CODEC).partitionBy(PART).parquet(target)
    subs = [n for n in _names(spark, target) if n.startswith(f"{PART}=")]
    return {n.removeprefix(f"{PART}="): {"folder": folder, "sub": n, "of": len(subs)} for n in subs}


def replace_table(df: DataFrame, path: str, **notes) -> None:
    """Replace a table by the rows of ``df``, which may read the table."""
    commit(df.sparkSession, path, {k: {**p, **notes} for k, p in write_parts(df, path).items()})


def put_part(df: DataFrame, path: str, name: str, **notes) -> int:
    """Replace one part, also by nothing; the rows written."""
    spark, obs = df.sparkSession, Observation(f"rows_{uuid.uuid4().hex[:8]}")
    written = write_parts(df.observe(obs, F.count(F.lit(1)).alias("rows")), path)[WHOLE]
    rows = int(observed(obs).get("rows", 0))
    before = live(spark, path)
    after = {k: v for k, v in before.items() if k != name}
    if rows:
        after[name] = {**written, "rows": rows, **notes}
    if rows or name in before:
        commit(spark, path, after)
    return rows


def append_rows(df: DataFrame, path: str) -> int:
    """Add rows as a part of their own; the rows written. Nothing is committed
    when there are none."""
    return put_part(df, path, uuid.uuid4().hex[:16])


def replace_parts(df: DataFrame, path: str, by: Column, gone: set[str], buckets: int | None = None,
                  cluster=("store_id", "date"), drop: str | None = None, note: dict | None = None) -> set[str]:
    """Replace the parts ``gone`` by those that ``df`` has; the names of these."""
    written = write_parts(df, path, by, buckets, cluster, drop)
    kept = {k: v for k, v in live(df.sparkSession, path).items() if k not in gone}
    commit(df.sparkSession, path, {**kept, **{k: {**p, **(note or {})} for k, p in written.items()}})
    return set(written)


# ---------------------------------------------------------------- reading
def folders(parts: dict[str, dict], path: str) -> list[str]:
    """Paths to read: a whole folder where all of its parts are wanted."""
    together: dict[str, list[dict]] = {}
    for p in parts.values():
        together.setdefault(p["folder"], []).append(p)
    return [f"{path.rstrip('/')}/{f}" + (f"/{p['sub']}" if part_of else "")
            for f, ps in together.items() for part_of in [len(ps) < ps[0]["of"]] for p in (ps if part_of else ps[:1])]


def read_parts(spark: SparkSession, path: str, schema: T.StructType | str, names=None) -> DataFrame:
    """Rows of a table, or of those of its parts that are named."""
    parts = live(spark, path)
    if names is not None:
        parts = {k: v for k, v in parts.items() if k in names}
    if not parts:
        # Known to be empty when planned: nothing is read or exchanged to meet no rows.
        return spark.createDataFrame([], schema).where(F.lit(False))
    return spark.read.schema(schema).option("recursiveFileLookup", True).parquet(*folders(parts, path))


def read_table(spark: SparkSession, root: str, name: str, parts=None) -> DataFrame:
    """A final table with its declared columns."""
    return read_parts(spark, table_path(root, name), table_schema(name), parts)


def write_batch(df: DataFrame, root: str, name: str, batch_id: str, mode: str) -> int:
    """Write one batch of a table that keeps the batch of each row.

    ``mode="idempotent"``: the batch's part is replaced, also by nothing when
    ``df`` is empty; other batches stay. ``mode="append"``: rows are added, as a
    plain INSERT would.
    """
    rows, path = df.withColumn("batch_id", F.lit(batch_id)), table_path(root, name)
    return append_rows(rows, path) if mode == "append" else put_part(rows, path, f"batch {batch_id}")


def row_counts(spark: SparkSession, root: str, names=None) -> DataFrame:
    """(table_name, columns, rows): the column names and types as written, and
    the rows counted by Spark."""
    out = None
    for n in names or S.TABLES:
        parts = live(spark, table_path(root, n))
        written = spark.read.option("recursiveFileLookup", True).parquet(
            folders(parts, table_path(root, n))[0]).schema if parts else table_schema(n)
        columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in written.fields)
        f = read_table(spark, root, n).agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(n).alias("table_name"), F.lit(columns).alias("columns"), "rows")
        out = f if out is None else out.unionByName(f)
    return out

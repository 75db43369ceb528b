"""CSV ingest and staging tables.

Files are read with their header row, every column as text (no inference).
Columns are picked by name, in each file by its own header: other columns and
any order are fine, a missing one is an error that names the file. Missing-value
spellings are mapped to NULL before any cast. Staging tables are Parquet folders
with a manifest (``tables``): a failed load or truncate leaves the old rows.
"""

from __future__ import annotations

import csv
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from raincheck import schemas as S
from raincheck.functions.nulls import clean_null_tokens
from raincheck.operators.dims import SEQ
from raincheck.sources import tables

STAGING_TABLES = {name: f"staging_{name}" for name in S.CSV_HEADERS}

#: Sources read with line breaks allowed inside quoted fields. A file of these
#: is read by one task, so large exports should come in parts, or be read with
#: single lines (``read_sources(multi_line=...)``, ``--single-line``); the
#: transactions have no free text and are split.
MULTI_LINE_SOURCES = ("customers", "discounts", "employees", "products", "stores")

#: Staging column with the file that a row came from.
FILE = "_file"
#: Files whose header is read at a time.
PEEKS = 32


def list_files(spark: SparkSession, path: str) -> list[str]:
    """The data files of a path (file, folder or pattern), in order of name."""
    pattern = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = pattern.getFileSystem(spark._jsc.hadoopConfiguration())
    matches = fs.globStatus(pattern)
    if not matches:
        raise FileNotFoundError(path)
    out = []
    for match in matches:
        top = match.getPath().toString()
        files = fs.listFiles(match.getPath(), True)
        while files.hasNext():
            status = files.next()
            name = status.getPath().toString()
            hidden = any(part[:1] in ("_", ".") for part in name.removeprefix(top).split("/"))
            if status.getLen() and not hidden:
                out.append(name)
    return sorted(out)


def header_of(spark: SparkSession, file: str) -> tuple[str, ...]:
    """The header row of one file; only its first line is read."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(file)
    stream = p.getFileSystem(conf).open(p)
    try:
        codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(p)
        plain = stream if codec is None else codec.createInputStream(stream)
        reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(plain, "UTF-8"))
        text = reader.readLine() or ""
        while text.count('"') % 2 and (more := reader.readLine()) is not None:
            text += "\n" + more                    # a line break inside a quoted name
    finally:
        stream.close()
    return tuple(next(csv.reader([text.removeprefix("\ufeff")]), ()))


def files_by_header(spark: SparkSession, files: list[str]) -> dict[tuple[str, ...], list[str]]:
    """Files that share a header, in order of each header's first file."""
    with ThreadPoolExecutor(PEEKS) as pool:
        headers = list(pool.map(lambda f: header_of(spark, f), files))
    out: dict[tuple[str, ...], list[str]] = {}
    for file, header in zip(files, headers, strict=True):
        out.setdefault(header, []).append(file)
    return out


def scan_csv(spark: SparkSession, path: str, headers: list[str], with_seq: bool = False,
             multi_line: bool = False, with_file: bool = False) -> DataFrame:
    """A CSV file (or folder of parts) with header rows, as text columns.

    The columns ``headers`` are selected by name, in every file by its own
    header: files that share a header are one scan, and the scans are united by
    name. A file that lacks a column is an error that names it; an empty file
    holds no rows. FAILFAST turns a malformed row into an error instead of a
    NULL row. Quotes inside quoted fields are doubled (RFC 4180, as pandas
    writes them). ``multi_line`` allows line breaks inside quoted fields, at the
    cost of one task per file. ``with_seq`` adds an input-order column taken at
    the scan (it follows the order of input splits and of rows within a split,
    header by header). ``with_file`` adds the file of each row.
    """
    out = None
    for header, files in files_by_header(spark, list_files(spark, path)).items():
        missing = [h for h in headers if h not in header]
        if missing:
            raise ValueError(f"{files[0]}: header {list(header)} has no column {', '.join(missing)}")
        # A wanted column is taken where its name stands first; the rest go by their place.
        columns = [h if h in headers and header.index(h) == k else f"_c{k}" for k, h in enumerate(header)]
        raw = (spark.read.schema(S.all_string_schema(columns)).option("header", True)
               .option("mode", "FAILFAST").option("multiLine", multi_line)
               .option("quote", '"').option("escape", '"').csv(files))
        file = [F.col("_metadata.file_path").alias(FILE)] if with_file else []
        cells = clean_null_tokens(raw.select(*[F.col(f"`{h}`") for h in headers], *file))
        out = cells if out is None else out.unionByName(cells)
    if out is None:
        out = spark.createDataFrame([], S.all_string_schema([*headers, *([FILE] if with_file else [])]))
    return out.withColumn(SEQ, F.monotonically_increasing_id()) if with_seq else out


def read_sources(spark: SparkSession, src_dir: str, with_seq: bool = True,
                 multi_line=MULTI_LINE_SOURCES) -> dict[str, DataFrame]:
    """The six sources ``{src_dir}/{name}.csv`` (each a file or a folder of
    parts), keyed by name, with the file of each row."""
    return {name: scan_csv(spark, f"{src_dir.rstrip('/')}/{name}.csv", hdr,
                           with_seq=with_seq and name not in ("transactions", "discounts"),
                           multi_line=name in multi_line, with_file=True)
            for name, hdr in S.CSV_HEADERS.items()}


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    """Write a frame as CSV with a header row (NULL as an empty cell, quotes
    doubled inside quoted fields, white space as it is)."""
    (df.write.mode(mode).option("header", True).option("quote", '"').option("escape", '"')
       .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))
    return path


def staging_path(staging_dir: str, name: str) -> str:
    return f"{staging_dir.rstrip('/')}/{STAGING_TABLES[name]}"


def append_staging(df: DataFrame, staging_dir: str, name: str, mode: str = "append") -> int:
    """S2 + S3: append one source to its staging table and return the rows
    written, counted by an observation during the write (no second pass).
    ``mode="overwrite"`` replaces what an earlier, unfinished run left."""
    path = staging_path(staging_dir, name)
    if mode == "append" and tables.live(df.sparkSession, path):
        return tables.append_rows(df, path)
    obs = Observation(f"load_{name}")
    tables.replace_table(df.observe(obs, F.count(F.lit(1)).alias("rows")), path)
    return int(tables.observed(obs).get("rows", 0))


def read_staging(spark: SparkSession, staging_dir: str, name: str) -> DataFrame:
    """S9 for a staging table."""
    path = staging_path(staging_dir, name)
    return spark.read.option("recursiveFileLookup", True).parquet(*tables.folders(tables.live(spark, path), path))


def load_audit(spark: SparkSession, staging_dir: str, names=None) -> DataFrame:
    """S3: rows per staging table and source file, counted from the one column
    of the written tables that holds the file (the sources are not read again).
    The file is NULL for rows that came from no file."""
    out = None
    for name in names or list(STAGING_TABLES):
        rows = read_staging(spark, staging_dir, name)
        file = F.col(FILE) if FILE in rows.columns else F.lit(None).cast("string")
        counted = rows.groupBy(F.lit(STAGING_TABLES[name]).alias("table_name"), file.alias("file")).agg(
            F.count(F.lit(1)).alias("rows"))
        out = counted if out is None else out.unionByName(counted)
    return out


def truncate_staging(spark: SparkSession, staging_dir: str, names=None) -> None:
    """Empty staging tables, keeping their columns; a table that was
    never loaded has nothing to empty."""
    for name in names or list(STAGING_TABLES):
        path = staging_path(staging_dir, name)
        if tables.live(spark, path):
            # Known to be empty when planned: written without a task that makes no rows.
            empty = spark.createDataFrame([], read_staging(spark, staging_dir, name).schema).where(F.lit(False))
            tables.replace_table(empty, path)

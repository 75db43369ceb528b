"""What a batch touches: headers per file, manifests, months, merged distinct
counts, catalog tables, buckets."""

import datetime as dt
import os
import re
import tempfile
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from raincheck import schemas as S
from raincheck.operators import adhoc, aggregates, joins, marts, partials
from raincheck.plans import pipeline, refresh
from raincheck.plans.pipeline import run_pipeline
from raincheck.plans.registry import fixture_staging
from raincheck.sources import catalog, csv, payloads, tables
from raincheck.plans.fixture import RetailFixture

from .helpers import fact, products, stores, weather

RUN = dt.date(2025, 3, 1)
MARTS = (marts.M1, marts.M2, marts.M3)


def fresh(kind="test"):
    return tempfile.mkdtemp(prefix=f"raincheck-{kind}-")


@pytest.fixture(scope="module")
def fx(spark, small_sf):
    return RetailFixture(spark, small_sf)


def files_of(path):
    return {os.path.join(d, f) for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")}


def rows(df):
    return sorted(map(str, df.collect()))


def full_rebuild(spark, root):
    return pipeline.mart_frames(
        tables.read_table(spark, root, "fact_transactions"),
        tables.read_table(spark, root, "dim_store_weather").drop("run_date"),
        tables.read_table(spark, root, "dim_stores"), tables.read_table(spark, root, "dim_products"))


def assert_marts_equal_full_rebuild(spark, root):
    for name, want in full_rebuild(spark, root).items():
        assert rows(tables.read_table(spark, root, name)) == rows(want), name


# ---------------------------------------------------------------- S1, S6: headers
def parts(folder, **files):
    os.makedirs(folder)
    for name, text in files.items():
        with open(f"{folder}/{name}.csv", "w", encoding="utf-8") as f:
            f.write(text)
    return folder


def test_parts_are_read_by_their_own_headers(spark):
    d = parts(fresh("csv") + "/employees.csv",
              a="Employee ID,Store ID,Name\n1,10,A\n", b="Store ID,Employee ID,Name\n20,2,B\n",
              c='﻿Name,Extra,"Store ID",Employee ID\n"C, c",x,30,3\n', d="", e="Employee ID,Store ID,Name\n")
    got = csv.scan_csv(spark, d, ["Employee ID", "Store ID", "Name"], with_seq=True, with_file=True).collect()
    assert sorted((r["Employee ID"], r["Store ID"], r["Name"], os.path.basename(r["_file"])[0]) for r in got) == [
        ("1", "10", "A", "a"), ("2", "20", "B", "b"), ("3", "30", "C, c", "c")]
    assert len({r["_seq"] for r in got}) == 3


def test_one_scan_for_each_header(spark):
    d = parts(fresh("csv") + "/x.csv", **{f"p{i}": ("a,b\n1,2\n" if i % 2 else "b,a\n2,1\n") for i in range(12)})
    df = csv.scan_csv(spark, d, ["a", "b"])
    assert df._jdf.queryExecution().optimizedPlan().toString().count("Relation [") == 2
    assert {tuple(r) for r in df.collect()} == {("1", "2")} and df.count() == 12


def test_a_part_without_a_column_is_named(spark):
    d = parts(fresh("csv") + "/x.csv", a="a,b\n1,2\n", broken="a,c\n1,2\n")
    with pytest.raises(ValueError, match=r"broken\.csv.*no column b"):
        csv.scan_csv(spark, d, ["a", "b"])
    with pytest.raises(FileNotFoundError):
        csv.scan_csv(spark, f"{d}/none", ["a"])


def test_repeated_and_unnamed_columns_of_a_header(spark):
    d = parts(fresh("csv") + "/x.csv", a="a,,a,b\n1,2,3,4\n")
    assert [tuple(r) for r in csv.scan_csv(spark, d, ["b", "a"]).collect()] == [("4", "1")]


def test_compressed_parts(spark):
    import gzip
    d = fresh("csv")
    with gzip.open(f"{d}/x.csv.gz", "wt") as f:
        f.write("b,a\n2,1\n")
    assert [tuple(r) for r in csv.scan_csv(spark, d, ["a", "b"]).collect()] == [("1", "2")]


def test_weather_file_is_read_by_name(spark):
    d = parts(fresh("w") + "/2025-02-28", a="date_id,store_id,temp_min,temp_max,is_rain\n2025-02-01,1,1.0,9.0,true\n")
    row = payloads.load_weather(spark, d).first()
    assert (row.temp_max, row.temp_min, row.is_rain) == (Decimal("9.00"), Decimal("1.00"), True)


def test_failed_weather_file_leaves_the_earlier_one(spark):
    d = fresh("w")
    records = spark.createDataFrame([("2025-02-01", 1, 9.0, 1.0, True)], "date_id string, store_id int, temp_max double, "
                                    "temp_min double, is_rain boolean")
    path = payloads.write_weather_file(records, d, RUN, "b1")
    bad = records.withColumn("temp_max", F.raise_error(F.lit("no")).cast("double"))
    with pytest.raises(Exception):
        payloads.write_weather_file(bad, d, RUN, "b1")
    assert payloads.load_weather(spark, path).count() == 1


def test_load_audit_by_file(spark):
    src, staging = fresh("src"), fresh("stg")
    parts(f"{src}/stores.csv", a="Store ID,Country\n1,X\n2,Y\n", b="Country,Store ID\nZ,3\n")
    csv.append_staging(csv.scan_csv(spark, f"{src}/stores.csv", ["Store ID", "Country"], with_file=True), staging, "stores")
    got = csv.load_audit(spark, staging, ["stores"]).collect()
    assert sorted((r.table_name, os.path.basename(r.file), r.rows) for r in got) == [
        ("staging_stores", "a.csv", 2), ("staging_stores", "b.csv", 1)]


# ---------------------------------------------------------------- manifests
def test_a_killed_append_leaves_the_old_rows_and_doubles_nothing(spark):
    path = fresh() + "/t"
    df = spark.range(5)
    tables.put_part(df, path, "b1")
    bad = df.select(F.when(F.col("id") == 4, F.raise_error(F.lit("killed")).cast("bigint")).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception):
        tables.put_part(bad.repartition(4), path, "b2")
    assert tables.read_parts(spark, path, "id bigint").count() == 5
    for _ in range(3):                                  # the retry, and the retry of the retry
        assert tables.put_part(df, path, "b2") == 5
    assert tables.read_parts(spark, path, "id bigint").count() == 10
    # What the killed job and the replaced parts left is gone after two more commits.
    assert len(os.listdir(f"{path}/data")) <= 3


def test_written_but_not_committed_rows_are_not_seen(spark):
    path = fresh() + "/t"
    tables.replace_table(spark.range(3), path)
    tables.write_parts(spark.range(7), path)            # the job ends before its commit
    assert tables.read_parts(spark, path, "id bigint").count() == 3


def test_replacing_parts_leaves_the_other_files(spark):
    path = fresh() + "/t"
    df = spark.range(100).withColumn("m", F.concat(F.lit("m"), (F.col("id") % 10).cast("string")))
    tables.replace_parts(df, path, F.col("m"), set())
    before = {k: files_of(f"{path}/{p['folder']}/{p['sub']}") for k, p in tables.live(spark, path).items()}
    tables.replace_parts(df.where("m = 'm3'").withColumn("id", F.col("id") + 1000), path, F.col("m"), {"m3", "m4"})
    now = tables.live(spark, path)
    assert set(now) == {f"m{i}" for i in range(10)} - {"m4"}
    assert all(files_of(f"{path}/{now[k]['folder']}/{now[k]['sub']}") == before[k] for k in now if k != "m3")
    got = tables.read_parts(spark, path, "id bigint, m string")
    assert got.count() == 90 and got.where("m = 'm3'").agg(F.min("id")).first()[0] == 1003
    assert tables.read_parts(spark, path, "id bigint, m string", {"m1", "m3"}).count() == 20


def test_two_writers_do_not_overwrite_each_other(spark, monkeypatch):
    path = fresh() + "/t"
    tables.replace_table(spark.range(1), path)
    monkeypatch.setattr(tables, "_numbers", lambda *_: [])          # a writer that saw the table before that commit
    with pytest.raises(RuntimeError, match="another writer"):
        tables.replace_table(spark.range(2), path)


# ---------------------------------------------------------------- marts from what changed
@pytest.fixture(scope="module")
def two_batches(spark, fx):
    """A warehouse after a first batch and what it looked like, then a second
    batch with few days, and weather for few days."""
    root = fresh("inc")
    stg = fixture_staging(fx)
    first = run_pipeline(spark, stg, fx.weather_payloads, root, RUN, "b1")
    seen = {n: files_of(f"{root}/{n}") for n in ("dim_store_weather", marts.M1, "state/invoice_days", "fact_transactions")}
    day = F.substring("Date", 1, 7)
    few = {**stg, "transactions": stg["transactions"].where(day == "1996-03").withColumn(
        "Invoice ID", F.when(F.col("Line") == 1, F.col("`Invoice ID`")).otherwise(F.concat(F.lit("N"), F.col("`Invoice ID`"))))}
    late = fx.payloads_of(fx.staging_weather.where("date_id between '1997-05-20' and '1997-08-20'").withColumn(
        "temp_max", F.lit(30).cast("decimal(5,2)")))
    second = run_pipeline(spark, few, late, root, RUN + dt.timedelta(1), "b2")
    return root, first, seen, second


def test_second_batch_computes_only_its_months(spark, two_batches):
    root, first, seen, second = two_batches
    assert len(first.mart_months) > 70 and first.fact_parts == ["batch b1"]
    assert second.mart_months == ["1996-03", "1997-05", "1997-06", "1997-07", "1997-08"]
    assert second.fact_parts == ["batch b2"]
    assert_marts_equal_full_rebuild(spark, root)


def test_second_batch_leaves_other_months_files(spark, two_batches):
    root, first, seen, second = two_batches
    for name, months in (("dim_store_weather", second.mart_months[1:]), (marts.M1, second.mart_months)):
        new = files_of(f"{root}/{name}") - seen[name]
        assert {p.split("_part=")[1][:7] for p in new} == set(months), name
    # Old lines were not reduced again.
    new = files_of(f"{root}/state/invoice_days") - seen["state/invoice_days"]
    assert {p.split("_part=")[1][:7] for p in new} == {"1996-03"}


def test_second_batch_reads_only_its_part_of_the_fact(spark, two_batches):
    root = two_batches[0]
    read = []

    class Reader:
        def __getattr__(self, name):
            return getattr(tables, name)

        def read_table(self, spark, root, name, parts=None):
            df = tables.read_table(spark, root, name, parts)
            if name == "fact_transactions":
                read.extend(df.inputFiles())
            return df

    state = refresh.state_path(root, "product_days")
    held = tables.live(spark, state)
    key = refresh.key_of(tables.live(spark, tables.table_path(root, "fact_transactions"))["batch b2"])
    tables.commit(spark, state, {n: p for n, p in held.items() if not n.endswith(key)})     # b2 has to be reduced again
    was, refresh.tables = refresh.tables, Reader()
    try:
        got = refresh.refresh(spark, root)
    finally:
        refresh.tables = was
    part = tables.live(spark, tables.table_path(root, "fact_transactions"))["batch b2"]
    assert read and all(part["folder"] in f for f in read)
    assert got["parts"] == ["batch b2"] and got["months"] == ["1996-03"]
    assert_marts_equal_full_rebuild(spark, root)


def test_nothing_new_computes_nothing(spark, two_batches):
    root = two_batches[0]
    before = {m: tables.live(spark, tables.table_path(root, m)) for m in MARTS}
    got = refresh.refresh(spark, root)
    assert got["months"] == [] and got["parts"] == []
    assert {m: tables.live(spark, tables.table_path(root, m)) for m in MARTS} == before


def small_run(spark, root, batch, lines, days, store_rows, product_rows=({"product_id": 1}, {"product_id": 2})):
    """One batch written straight to the tables, then the marts."""
    def put(df, name):
        tables.append_rows(df, tables.table_path(root, name))
    tables.write_batch(fact(spark, lines), root, "fact_transactions", batch, "idempotent")
    if days:
        path, months = tables.table_path(root, "dim_store_weather"), {f"{d['date_id']:%Y-%m}" for d in days}
        held = tables.read_table(spark, root, "dim_store_weather", months)
        merged = payloads.merge_weather(held, weather(spark, days), RUN).select(*held.columns)
        tables.replace_parts(merged, path, tables.month_of("date_id"), months)
    for rows_, name, build in ((store_rows, "dim_stores", stores), (product_rows, "dim_products", products)):
        if rows_:
            new = build(spark, list(rows_))
            put(new.join(tables.read_table(spark, root, name), new.columns[0], "left_anti"), name)
    return refresh.refresh(spark, root)


def line(invoice, day, store=1, product=1, total="10"):
    d = dt.date.fromisoformat(day) if day else None
    return dict(invoice_id=invoice, date=d, datetime=d, store_id=store, product_id=product, invoice_total=Decimal(total))


def test_months_stores_replaced_batches_and_odd_lines(spark):
    root = fresh("small")
    days = [dict(store_id=s, date_id=dt.date(2025, m, d)) for s in (1, 2, 3) for m in (1, 2) for d in (1, 2)]
    lines = [line("A", "2025-01-01"), line("A", "2025-02-01"), line("A", "2025-02-02", store=2), line("B", "2025-02-02"),
             line(None, "2025-02-02"), line("C", None), line("D", "2025-01-02", store=3), line("E", "2025-01-02", store=None),
             line("A", "2025-01-01"), line("F", "2025-01-02", product=9)]
    got = small_run(spark, root, "b1", lines, days, [{"store_id": 1}, {"store_id": 2, "size": "Large"}])
    assert got["months"] == ["2025-01", "2025-02", "none"] and got["lines"] == 10
    assert_marts_equal_full_rebuild(spark, root)
    # A known invoice comes again, in a month of its own: counted once over all months.
    got = small_run(spark, root, "b2", [line("A", "2025-03-05"), line("B", "2025-03-05")],
                    [dict(store_id=1, date_id=dt.date(2025, 3, 5))], [])
    assert "2025-03" in got["months"]
    assert_marts_equal_full_rebuild(spark, root)
    sizes = {(r.store_size, r.is_rain, r.temperature_range): r.transaction_count
             for r in tables.read_table(spark, root, marts.M3).collect()}
    assert sizes["Small", False, "moderate"] == 3                   # A, B and F; D's store is unknown
    # A store that was unknown: its old lines count now, without any new line of it.
    got = small_run(spark, root, "b3", [], [], [{"store_id": 3}])
    assert got["months"] == ["2025-01"]
    assert_marts_equal_full_rebuild(spark, root)
    # A new product: only the product mart changes.
    m1 = tables.live(spark, tables.table_path(root, marts.M1))
    got = small_run(spark, root, "b3", [], [], [], [{"product_id": 9, "category": "new"}])
    assert got["months"] == [] and tables.live(spark, tables.table_path(root, marts.M1)) == m1
    assert_marts_equal_full_rebuild(spark, root)
    # A batch is replaced by other lines, then by none.
    got = small_run(spark, root, "b1", [line("Z", "2025-02-01")], [], [])
    assert_marts_equal_full_rebuild(spark, root)
    tables.put_part(fact(spark, []).withColumn("batch_id", F.lit("b1")), tables.table_path(root, "fact_transactions"), "batch b1")
    refresh.refresh(spark, root)
    assert_marts_equal_full_rebuild(spark, root)
    assert {n.split("~")[0] for n in tables.live(spark, refresh.state_path(root, "invoice_days"))} == {"2025-03"}


def test_failure_between_the_marts_is_caught_up(spark, monkeypatch):
    root = fresh("fail")
    days = [dict(store_id=1, date_id=dt.date(2025, 1, d)) for d in (1, 2)]

    def fail(*_a, **_k):
        raise RuntimeError("lost")
    with monkeypatch.context() as m:
        m.setattr(partials, "product_months", fail)
        with pytest.raises(RuntimeError):
            small_run(spark, root, "b1", [line("A", "2025-01-01")], days, [{"store_id": 1}])
    assert refresh.refresh(spark, root)["months"] == ["2025-01"]
    assert_marts_equal_full_rebuild(spark, root)
    with monkeypatch.context() as m:
        m.setattr(partials, "invoice_days", fail)
        with pytest.raises(RuntimeError):
            small_run(spark, root, "b2", [line("B", "2025-01-02")], [], [])
    assert refresh.refresh(spark, root)["parts"] == ["batch b2"]
    assert_marts_equal_full_rebuild(spark, root)


# ---------------------------------------------------------------- A2: distinct counts that merge
def test_invoice_sets_merge_to_the_exact_distinct_count(spark, fx):
    from raincheck.operators import facts
    lines = facts.fact_transactions(fx.staging_transactions).select("store_id", "date", "invoice_id", "invoice_total")
    cut = F.col("store_id") % 2 == 0
    held, sets = spark.createDataFrame([], partials.INVOICE_NUMBERS), None
    for batch in (lines.where(cut), lines.where(~cut)):
        days = partials.invoice_day_lines(batch)
        met = spark.read.parquet(write(partials.met_invoices(days, held)))
        start = held.agg(F.max("invoice_no")).first()[0]
        new = partials.numbered(met, 0 if start is None else start + 1)
        numbers = spark.read.parquet(write(met.where("invoice_no IS NOT NULL").select("invoice_id", "invoice_no").unionByName(new)))
        held = held.unionByName(numbers).distinct()
        no = F.col("invoice_no")
        part = partials.invoice_days(days, numbers).groupBy("date", F.bitmap_bucket_number(no).alias("bucket")).agg(
            F.bitmap_construct_agg(F.bitmap_bit_position(no)).alias("invoices"))
        sets = part if sets is None else sets.unionByName(part)
    nos = sorted(r[0] for r in held.select("invoice_no").collect())
    assert nos == list(range(len(nos)))                              # dense, each given out once
    assert held.select("invoice_id").distinct().count() == len(nos)
    got = {r.date: r.transaction_count for r in partials.distinct_invoices(sets, ["date"]).collect()}
    assert got == {r.date: r.transaction_count for r in aggregates.invoice_counts(lines, ["date"]).collect()}


def write(df):
    path = fresh("x") + "/t"
    df.write.parquet(path)
    return path


def test_product_days_reduce_lines_before_the_join(spark):
    lines = fact(spark, [dict(invoice_id=f"i{k}", line=k, product_id=k % 3, quantity=2) for k in range(60)])
    days = partials.product_days(lines)
    assert days.count() == 3                                         # of 60 lines
    w = weather(spark, [dict(store_id=1, date_id=dt.date(2025, 3, 4))])
    months = partials.product_months(joins.join_weather(days, w, cols=("temp_max", "is_rain")), F.lit("m").alias("month"))
    p = products(spark, [dict(product_id=k, category="c") for k in range(3)])
    assert rows(partials.product_sensitivity_merged(months.drop("month"), p)) == rows(marts.product_sensitivity(lines, p, w))


# ---------------------------------------------------------------- S7, J2: catalog and buckets
def test_catalog_shows_what_was_committed_and_checks_lengths(spark, fx):
    root, db = fresh("cat"), "raincheck_catalog_test"
    r = run_pipeline(spark, fixture_staging(fx), fx.weather_payloads, root, RUN, "b1", database=db, buckets=3)
    assert set(r.defined) == {f"{db}.{n}" for n in S.TABLES}
    for name in S.TABLES:
        assert rows(spark.table(f"{db}.{name}").drop("_part")) == rows(tables.read_table(spark, root, name)), name
    assert "varchar(5)" in spark.sql(f"SHOW CREATE TABLE {db}.fact_transactions").first()[0].lower()
    late = fx.payloads_of(fx.staging_weather.where("date_id < '1995-02-01'"))
    run_pipeline(spark, fixture_staging(fx), late, root, RUN + dt.timedelta(1), "b2", database=db, buckets=3)
    for name in ("fact_transactions", marts.M1, "dim_store_weather"):
        assert rows(spark.table(f"{db}.{name}").drop("_part")) == rows(tables.read_table(spark, root, name)), name
    assert_marts_equal_full_rebuild(spark, root)
    with pytest.raises(Exception, match="EXCEED_LIMIT_LENGTH"):
        spark.sql(f"INSERT INTO {db}.dim_stores (store_id, size, _part) VALUES (1, 'far too long a size', 'x')")
    assert catalog.define_tables(spark, root, db) and spark.table(f"{db}.dim_stores").count() == 10   # left alone


def test_bucketed_lines_and_weather_join_without_an_exchange(spark, fx):
    import contextlib
    import io
    root = fresh("buckets")
    run_pipeline(spark, fixture_staging(fx), fx.weather_payloads, root, RUN, "b1", buckets=4)
    months = set(refresh.inputs_by_month(spark, root, False))
    days, product_days, w = refresh.month_inputs(spark, root, months, 4)
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    was = {k: spark.conf.get(k) for k in keys}
    try:
        for k in keys:
            spark.conf.set(k, "-1")
        for lines in (days, product_days):
            out = io.StringIO()
            joined = joins.join_weather(lines, w)
            with contextlib.redirect_stdout(out):
                joined.explain()
            assert "SortMergeJoin" in out.getvalue() and "Exchange" not in out.getvalue()
            assert joined.count() > 0
    finally:
        for k, v in was.items():
            spark.conf.set(k, v)


def test_buckets_grow_with_the_fact(spark, fx, monkeypatch):
    """A bucket is one task's: with more lines there are more, for all clustered tables alike."""
    monkeypatch.setattr(catalog, "LINES_A_BUCKET", 1_000)
    assert [catalog.enough_buckets(4, n) for n in (0, 4_000, 4_001, 40_000)] == [4, 4, 8, 64]
    root, lines = fresh("more-buckets"), fx.staging_transactions.count()
    run_pipeline(spark, fixture_staging(fx), fx.weather_payloads, root, RUN, "b1", buckets=2)
    n = catalog.enough_buckets(2, lines)
    assert n > 2
    for path in (refresh.state_path(root, "invoice_days"), refresh.state_path(root, "product_days"),
                 tables.table_path(root, "dim_store_weather")):
        assert {p["buckets"] for p in tables.live(spark, path).values()} == {n}
    assert_marts_equal_full_rebuild(spark, root)


# ---------------------------------------------------------------- what is exchanged
def exchanges(df):
    return [ln for ln in df._jdf.queryExecution().executedPlan().toString().splitlines() if "Exchange hashpartitioning" in ln]


def test_payloads_of_a_store_are_made_in_one_exchange(spark, fx):
    assert len(exchanges(fx.weather_payloads)) == 1
    assert rows(fx.weather_payloads) == rows(fx.payloads_of(fx.staging_weather))


def test_product_days_are_written_from_the_exchange_that_reduces_them(spark, fx, monkeypatch):
    from raincheck.operators import facts
    lines = facts.fact_transactions(fx.staging_transactions)
    month, root = tables.month_of("date"), fresh("shares")
    lines.write.parquet(f"{root}/lines")
    lines = spark.read.parquet(f"{root}/lines")
    most = tables.most_rows(lines, month)
    assert most == max(r["count"] for r in lines.groupBy(month).count().collect())
    monkeypatch.setattr(tables, "ROWS_A_SHARE", most // 3)
    days = partials.product_days(tables.in_shares(lines, month, most, "store_id", "date", "product_id"), (tables.SHARE,))
    assert len(exchanges(days)) == 1
    assert days.select(tables.SHARE).distinct().count() > 2 * lines.select(month).distinct().count()
    tables.replace_parts(days, f"{root}/t", month, set())
    assert rows(tables.read_parts(spark, f"{root}/t", partials.PRODUCT_DAYS)) == rows(partials.product_days(lines))
    assert tables.most_rows(lines.where("false"), month) == 0


def test_a_table_without_parts_is_known_to_be_empty(spark):
    df = tables.read_parts(spark, fresh() + "/t", "id bigint")
    assert "<empty>" in df.join(spark.range(9), "id")._jdf.queryExecution().optimizedPlan().toString()


def test_region_mart_exchanges_no_names_and_keeps_odd_rows(spark):
    stores_ = stores(spark, [dict(store_id=k, country=c, city="y", size=z) for k, c, z in (
        (1, "x", "Small"), (2, "x", "Small"), (3, None, "Large"), (4, None, "Large"), (5, "x", None))])
    f = fact(spark, [dict(invoice_id=None if k % 7 == 0 else f"i{k % 11}", store_id=k % 6 + 1, line=k,
                          invoice_total=None if k % 5 == 0 else Decimal(-k)) for k in range(90)])
    w = weather(spark, [dict(store_id=k, date_id=dt.date(2025, 3, 4), temp_max=None if k == 2 else Decimal("-1.27"),
                             temp_min=Decimal("-9.99") + k) for k in range(1, 7)])
    days = marts.invoice_days(joins.join_weather(f, w))
    ids = F.substring("invoice_id", 2, 9).cast("bigint").alias("invoice_no")
    matched = partials.matched_days(days.select("*", ids), stores_)
    got = partials.region_impact_by_place(matched, stores_)
    assert rows(got) == rows(marts.region_impact(f, stores_, w)) and got.count() == 3
    counted = [ln for ln in exchanges(got) if "invoice_no" in ln]
    assert counted and not any("country" in ln or "city" in ln for ln in counted)


# ---------------------------------------------------------------- what a row costs
def test_months_are_named_without_a_formatter_for_usual_years(spark):
    days = spark.createDataFrame([(d,) for d in (None, "0007-03-01", "0999-12-31", "1000-01-01", "1970-01-01", "2024-02-29", "2025-10-31",
                                                 "9999-12-31")], "t string").select(F.col("t").cast("date").alias("d"))
    days = days.unionByName(days.select(F.date_add(F.lit("9999-12-31").cast("date"), 40).alias("d")).limit(1))
    named = days.select("d", tables.month_of("d").alias("m"), tables.month_start("d").alias("s"))
    old = F.coalesce(F.date_format("d", "yyyy-MM"), F.lit("none"))
    assert named.where(F.col("m") != old).count() == 0 and named.where(F.col("m") != tables.month_of("s")).count() == 0
    assert {r.m for r in named.select("m").collect()} >= {"none", "0007-03", "1000-01", "2024-02", "2025-10", "9999-12", "+10000-02"}


def test_size_months_are_sorted_by_a_hash_and_hold_bigints(spark):
    w = weather(spark, [dict(store_id=k, date_id=dt.date(2025, m, 4), is_rain=k % 2 == 0, temp_max=None if k == 3 else Decimal(9 * k))
                        for k in range(1, 5) for m in (3, 4)])
    s = stores(spark, [dict(store_id=k, size=z) for k, z in ((1, "Small"), (2, "Large"), (3, None), (4, "Small"))])
    f = fact(spark, [dict(invoice_id=None if k % 9 == 0 else f"i{k % 40}", store_id=k % 4 + 1, line=k, date=dt.date(2025, 3 + k % 2, 4),
                          invoice_total=None if k % 5 == 0 else Decimal(9_999_999_999 - k)) for k in range(120)])
    days = partials.invoice_day_lines(f)
    assert "sum(cast(invoice_total" in days._jdf.queryExecution().executedPlan().toString().replace("CAST", "cast")
    assert days.schema["revenue"].dataType.simpleString() == "decimal(20,0)"
    ids = F.substring("invoice_id", 2, 9).cast("bigint").alias("invoice_no")
    matched = partials.matched_days(joins.join_weather(days.select("*", ids), w), s)
    assert matched.schema["revenue"].dataType.simpleString() == "bigint"
    months = partials.size_months(matched, tables.month_start("date").alias("month"))
    sorts = [ln for ln in months._jdf.queryExecution().executedPlan().toString().splitlines() if " Sort [" in ln and "store_size" in ln]
    assert sorts and all(re.search(r" Sort \[\w+#\d+L ASC", ln) for ln in sorts)          # the hash: the only bigint but the last
    assert months.columns == ["month", *spark.createDataFrame([], partials.SIZE_MONTHS).columns]
    assert rows(partials.size_impact_merged(months.drop("month"))) == rows(marts.size_impact(f, s, w))


def test_an_emptied_staging_table_is_known_to_be_empty(spark, monkeypatch):
    d, seen = fresh("trunc") + "/staging", []
    csv.append_staging(spark.range(5), d, "stores", "overwrite")
    put = tables.replace_table
    monkeypatch.setattr(tables, "replace_table", lambda df, path, **n: (seen.append(df), put(df, path, **n)))
    csv.truncate_staging(spark, d, ["stores"])
    assert "<empty>" in seen[0]._jdf.queryExecution().optimizedPlan().toString()
    after = csv.read_staging(spark, d, "stores")
    assert after.columns == ["id"] and after.count() == 0


# ---------------------------------------------------------------- X3
def test_category_maps_start_no_job_and_name_no_category(spark):
    n = 100_000
    p = spark.range(n).select(F.col("id").cast("int").alias("product_id"), F.concat(F.lit("c"), "id").alias("category"))
    f = spark.range(n).select(F.lit(1).alias("store_id"), F.lit(dt.date(2025, 1, 1)).alias("date"),
                              F.col("id").cast("int").alias("product_id"), F.lit(2).alias("quantity"), F.lit(1.5).alias("line_total"))
    spark.sparkContext.setJobGroup("maps", "maps")
    df = adhoc.category_maps(f, p)
    assert list(spark.sparkContext.statusTracker().getJobIdsForGroup("maps")) == []
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(df._jdf.queryExecution().optimizedPlan().toString()) < 5000
    row = df.select(F.size("quantity"), F.col("quantity")["c7"], F.col("amount")["c99999"]).first()
    assert tuple(row) == (n, 2, Decimal("1.5000"))


def test_category_maps_agree_with_the_wide_pivot(spark):
    p = products(spark, [dict(product_id=1, category="A b"), dict(product_id=2, category="C"), dict(product_id=3)])
    f = fact(spark, [dict(product_id=k, quantity=q, line_total=1.25 * q) for k, q in ((1, 2), (1, 3), (2, 4), (3, 5))])
    wide = adhoc.category_pivot(f, p, ["A b", "C", "none"]).first()
    maps = adhoc.category_maps(f, p).first()
    assert (wide["a_b_quantity"], wide["c_quantity"], wide["none_quantity"]) == (5, 4, 0)
    assert maps["quantity"] == {"A b": 5, "C": 4} and maps["amount"] == {"A b": Decimal("6.2500"), "C": Decimal("5.0000")}

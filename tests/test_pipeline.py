"""Re-run semantics of the end-to-end batch (R1-R3, S5-S8, E1), on sf0.001."""

import datetime as dt
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from raincheck import session
from raincheck.plans.pipeline import run_pipeline
from raincheck.plans.registry import fixture_staging
from raincheck.sources import csv, tables
from raincheck.plans.fixture import RetailFixture

RUN = dt.date(2025, 3, 1)


def fresh_root():
    return tempfile.mkdtemp(prefix="raincheck-test-")


def counts(spark, root):
    return {r.table_name: r.rows for r in tables.row_counts(spark, root).collect()}


def revenue(spark, root):
    m1 = tables.read_table(spark, root, "data_mart_weather_region_impact")
    return m1.agg(F.sum("total_revenue"), F.sum("transaction_count")).first()


@pytest.fixture(scope="module")
def fx(spark, small_sf):
    return RetailFixture(spark, small_sf)


def test_batch_rerun_is_idempotent_and_new_batch_adds(spark, fx):
    root = fresh_root()
    r = run_pipeline(spark, fixture_staging(fx), fx.weather_payloads, root, RUN, batch_id="b1")
    first = counts(spark, root)
    rev1 = revenue(spark, root)
    assert r.weather_file.endswith("/weather/2025-02-28/b1")
    assert r.unanswered_stores == 0
    assert os.path.isdir(r.weather_file)
    assert r.audit["transactions"] == first["fact_transactions"]
    run_pipeline(spark, fixture_staging(fx), fx.weather_payloads, root, RUN, batch_id="b1")
    assert counts(spark, root) == first
    assert revenue(spark, root) == rev1
    run_pipeline(spark, fixture_staging(fx), fx.weather_payloads, root, RUN, batch_id="b2")
    again = counts(spark, root)
    assert again["fact_transactions"] == 2 * first["fact_transactions"]
    assert again["dim_stores"] == first["dim_stores"]
    assert again["dim_store_weather"] == first["dim_store_weather"]
    # staging is emptied after the load
    assert csv.read_staging(spark, f"{root}/staging", "transactions").count() == 0


def test_append_mode_reproduces_double_counting(spark, fx):
    root = fresh_root()
    run_pipeline(spark, fixture_staging(fx), fx.weather_payloads, root, RUN, mode="append")
    rev1, n1 = revenue(spark, root)
    lines1 = counts(spark, root)["fact_transactions"]
    run_pipeline(spark, fixture_staging(fx), fx.weather_payloads, root, RUN, mode="append")
    assert counts(spark, root)["fact_transactions"] == 2 * lines1   # J5: every line appends again
    m1 = tables.read_table(spark, root, "data_mart_weather_region_impact")
    # The second computation sits beside the first; it has 2 x 2 = 4 x revenue
    # (fact and weather both doubled) and the same distinct invoice counts.
    assert m1.agg(F.sum("total_revenue")).first()[0] == rev1 * 5
    assert m1.agg(F.sum("transaction_count")).first()[0] == n1 * 2


def test_bad_value_commits_nothing(spark, fx):
    root = fresh_root()
    stg = fixture_staging(fx)
    stg["transactions"] = stg["transactions"].withColumn(
        "Date", F.when(F.col("Line") == 1, F.lit("not-a-date")).otherwise(F.col("Date")))
    with pytest.raises(Exception):
        run_pipeline(spark, stg, fx.weather_payloads, root, RUN)
    fact = tables.read_table(spark, root, "fact_transactions")
    assert fact.count() == 0


def test_csv_missing_column_is_named(spark):
    d = tempfile.mkdtemp(prefix="raincheck-csv-")
    path = f"{d}/stores.csv"
    with open(path, "w") as f:
        f.write("Store ID,Country\n1,X\n")
    with pytest.raises(ValueError, match="Nation"):
        csv.scan_csv(spark, path, ["Store ID", "Nation"])


def test_csv_extra_and_reordered_columns_padding_and_line_breaks(spark):
    d = tempfile.mkdtemp(prefix="raincheck-csv-")
    path = f"{d}/stores.csv"
    with open(path, "w") as f:
        f.write('More,Country,Store ID\nx,"two\nlines",1\ny,  pad  ,2\n')
    scan = csv.scan_csv(spark, path, ["Store ID", "Country"], multi_line=True)
    assert scan.columns == ["Store ID", "Country"]
    want = {"1": "two\nlines", "2": "  pad  "}
    assert {r["Store ID"]: r["Country"] for r in scan.collect()} == want
    back = csv.scan_csv(spark, csv.write_csv(scan, f"{d}/again"), ["Store ID", "Country"], multi_line=True)
    assert {r["Store ID"]: r["Country"] for r in back.collect()} == want


def test_csv_null_tokens_become_null(spark):
    d = tempfile.mkdtemp(prefix="raincheck-csv-")
    path = f"{d}/stores.csv"
    with open(path, "w") as f:
        f.write("Store ID,Country\n1,NA\n2,N/A\n3,nan\n4,France\n")
    got = {r["Store ID"]: r["Country"] for r in csv.scan_csv(spark, path, ["Store ID", "Country"]).collect()}
    assert got == {"1": None, "2": None, "3": None, "4": "France"}


def test_unmatched_lines_are_audited(spark, fx, small_sf):
    import duckdb
    root = fresh_root()
    r = run_pipeline(spark, fixture_staging(fx), fx.weather_payloads, root, RUN)
    con = duckdb.connect()
    # one store-day in ten has no weather: (supplier + day number) % 10 = 0
    want = con.execute(f"""
        select count(*) from read_parquet('{small_sf}/lineitem.parquet')
        where (l_suppkey + date_diff('day', date '1995-01-01', cast(l_shipdate as date))) % 10 = 0
    """).fetchone()[0]
    assert r.mart_lines == counts(spark, root)["fact_transactions"]
    assert r.unmatched_lines == want > 0


def test_pipeline_from_csv_files_equals_typed_run(spark, fx):
    """Six CSV exports -> header-checked text scan -> pipeline: the marts
    equal those of the same batch loaded from typed frames."""
    src = tempfile.mkdtemp(prefix="raincheck-src-")
    for name, df in fixture_staging(fx).items():
        csv.write_csv(df, f"{src}/{name}.csv")
    from_csv = fresh_root()
    run_pipeline(spark, csv.read_sources(spark, src), fx.weather_payloads, from_csv, RUN)
    typed = fresh_root()
    run_pipeline(spark, fixture_staging(fx), fx.weather_payloads, typed, RUN)
    assert counts(spark, from_csv) == counts(spark, typed)
    for m in ("data_mart_weather_region_impact", "data_mart_product_weather_sensitivity",
              "data_mart_store_size_weather_impact"):
        a = tables.read_table(spark, from_csv, m)
        b = tables.read_table(spark, typed, m)
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_dashboard_over_written_warehouse_equals_direct_queries(spark, fx, small_sf):
    from raincheck.plans import dashboard
    from raincheck.plans.registry import CATEGORIES, QUERIES, present
    root = fresh_root()
    run_pipeline(spark, fixture_staging(fx), fx.weather_payloads, root, RUN)
    assert "category_maps" in dashboard.category_analysis(spark, root)
    got = {**dashboard.panels(spark, root), **dashboard.category_analysis(spark, root, CATEGORIES)}
    for name, df in got.items():
        want = QUERIES["share_of_total" if name == "transactions_by_weather" else name](spark, small_sf)
        a = present(df)
        assert sorted(a.columns) == sorted(want.columns), name
        a = a.select(*want.columns)
        assert a.exceptAll(want).count() == 0 and want.exceptAll(a).count() == 0, name


def test_command_line_run(spark, fx):
    """CSV exports + JSON-lines payloads on disk -> one batch via main()."""
    from raincheck.plans import pipeline
    src = tempfile.mkdtemp(prefix="raincheck-src-")
    for name, df in fixture_staging(fx).items():
        csv.write_csv(df, f"{src}/{name}.csv")
    pay = tempfile.mkdtemp(prefix="raincheck-pay-") + "/payloads"
    fx.weather_payloads.write.json(pay)
    root = fresh_root()
    r = pipeline.main(["--sources", src, "--payloads", pay, "--root", root,
                       "--run-date", "2025-03-01", "--batch-id", "b1"])
    assert r.batch_id == "b1" and r.payloads == fx.weather_payloads.count()
    assert counts(spark, root)["fact_transactions"] == fx.staging_transactions.count()


def test_rerun_after_failure_converges(spark, fx):
    """A run that fails part-way (dimensions appended, fact rejected) and is
    then re-run with good data ends exactly like a clean run."""
    root = fresh_root()
    bad = fixture_staging(fx)
    bad["transactions"] = bad["transactions"].withColumn(
        "Date", F.when(F.col("Line") == 1, F.lit("not-a-date")).otherwise(F.col("Date")))
    with pytest.raises(Exception):
        run_pipeline(spark, bad, fx.weather_payloads, root, RUN)
    run_pipeline(spark, fixture_staging(fx), fx.weather_payloads, root, RUN)
    clean = fresh_root()
    run_pipeline(spark, fixture_staging(fx), fx.weather_payloads, clean, RUN)
    assert counts(spark, root) == counts(spark, clean)
    assert revenue(spark, root) == revenue(spark, clean)


def test_csv_doubled_quotes_and_commas(spark):
    d = tempfile.mkdtemp(prefix="raincheck-csv-")
    path = f"{d}/products.csv"
    with open(path, "w") as f:
        f.write('Store ID,Country\n1,"Ivory ""Coast"", West"\n2,plain\n')
    got = {r["Store ID"]: r["Country"] for r in csv.scan_csv(spark, path, ["Store ID", "Country"]).collect()}
    assert got == {"1": 'Ivory "Coast", West', "2": "plain"}
    back = csv.write_csv(csv.scan_csv(spark, path, ["Store ID", "Country"]), f"{d}/again")
    again = {r["Store ID"]: r["Country"] for r in csv.scan_csv(spark, back, ["Store ID", "Country"]).collect()}
    assert again == got


def test_sql_over_registered_views_equals_panels(spark, fx):
    from raincheck.plans import dashboard
    from raincheck.plans.registry import present
    root = fresh_root()
    run_pipeline(spark, fixture_staging(fx), fx.weather_payloads, root, RUN)
    dashboard.register_views(spark, root)
    names = set(dashboard.register_views(spark, root))
    assert {"staging_stores", "staging_transactions"} <= names
    assert spark.sql("select * from staging_stores").count() == 0          # emptied after the load
    q2 = spark.sql("""
        select category, sub_category, if(is_rain, 'Rainy', 'Not Rainy') weather_condition,
               cast(revenue as double) total_revenue
        from (select *, rank() over (partition by is_rain order by revenue desc nulls first) place
              from (select category, sub_category, is_rain, sum(cast(line_total as decimal(18,4))) revenue
                    from fact_transactions
                    join dim_products using (product_id)
                    join dim_store_weather on dim_store_weather.store_id = fact_transactions.store_id
                                          and date_id = date
                    group by all))
        where place <= 5""")
    panel = present(dashboard.panels(spark, root)["top_products_by_weather"])
    assert q2.exceptAll(panel).count() == 0 and panel.exceptAll(q2).count() == 0
    q4 = spark.sql("""
        select case when is_rain then 'Rainy' else 'Not Rainy' end as weather_condition,
               sum(transaction_count) as total_transactions
        from data_mart_weather_region_impact group by is_rain""")
    want = dashboard.panels(spark, root)["transactions_by_weather"].drop("share")
    assert sorted(q4.collect()) == sorted(want.collect())


def test_command_line_with_saved_response_files(spark, fx):
    from raincheck.plans import pipeline
    src = tempfile.mkdtemp(prefix="raincheck-src-")
    for name, df in fixture_staging(fx).items():
        csv.write_csv(df, f"{src}/{name}.csv")
    pay = tempfile.mkdtemp(prefix="raincheck-pay-")
    for r in fx.weather_payloads.collect():   # ten stores at sf0.001 (test only)
        with open(f"{pay}/store_{r.store_id}.json", "w") as f:
            f.write(r.body)
    root = fresh_root()
    r = pipeline.main(["--sources", src, "--payloads", pay, "--payload-format", "files",
                       "--root", root, "--run-date", "2025-03-01"])
    typed = fresh_root()
    run_pipeline(spark, fixture_staging(fx), fx.weather_payloads, typed, RUN)
    assert counts(spark, root) == counts(spark, typed)
    assert r.failed_payloads == 0


def as_written(spark, root, name):
    path = tables.table_path(root, name)
    return spark.read.parquet(*tables.folders(tables.live(spark, path), path))


def test_strict_types_write_the_declared_mart_widths(spark, fx):
    root = fresh_root()
    run_pipeline(spark, fixture_staging(fx), fx.weather_payloads, root, RUN, strict_types=True)
    m3 = as_written(spark, root, "data_mart_store_size_weather_impact")
    types = {f.name: f.dataType.simpleString() for f in m3.schema.fields}
    assert types["total_revenue"] == "decimal(12,2)" and types["transaction_count"] == "int"
    default = fresh_root()
    run_pipeline(spark, fixture_staging(fx), fx.weather_payloads, default, RUN)
    d3 = as_written(spark, default, "data_mart_store_size_weather_impact")
    assert {f.name: f.dataType.simpleString() for f in d3.schema.fields}["total_revenue"] == "decimal(18,2)"
    assert sorted(map(tuple, m3.select("store_size", "total_revenue").collect())) == \
        sorted(map(tuple, d3.select("store_size", "total_revenue").collect()))


def store_days(spark, root):
    t = tables.read_table(spark, root, "dim_store_weather")
    return {r.store_id: r["count"] for r in t.groupBy("store_id").count().collect()}


def test_second_batch_of_a_day_keeps_the_first_one_s_weather(spark, fx):
    root = fresh_root()
    even = F.col("store_id") % 2 == 0
    run_pipeline(spark, fixture_staging(fx), fx.weather_payloads.where(even), root, RUN, batch_id="b1")
    first = store_days(spark, root)
    r = run_pipeline(spark, fixture_staging(fx), fx.weather_payloads.where(~even), root, RUN, batch_id="b2")
    both = store_days(spark, root)
    assert first and {k: both[k] for k in first} == first and len(both) > len(first)
    assert r.unanswered_stores == len(first)
    assert both == {r.store_id: r["count"] for r in fx.staging_weather.groupBy("store_id").count().collect()}


def test_rerun_with_a_failed_store_keeps_its_days(spark, fx):
    root = fresh_root()
    run_pipeline(spark, fixture_staging(fx), fx.weather_payloads, root, RUN, batch_id="b1")
    before = store_days(spark, root)
    some = sorted(before)[0]
    broken = fx.weather_payloads.withColumn("status", F.when(F.col("store_id") == some, 500).otherwise(F.col("status")))
    r = run_pipeline(spark, fixture_staging(fx), broken, root, RUN, batch_id="b1")
    assert r.failed_payloads == 1 and r.unanswered_stores == 1
    assert store_days(spark, root) == before


def test_failed_mart_write_leaves_the_mart(spark, fx):
    root = fresh_root()
    run_pipeline(spark, fixture_staging(fx), fx.weather_payloads, root, RUN)
    name = "data_mart_store_size_weather_impact"
    before = sorted(map(str, tables.read_table(spark, root, name).collect()))
    bad = tables.read_table(spark, root, name).withColumn(
        "store_size", F.when(F.col("store_size").isNotNull(), F.raise_error(F.lit("no"))).cast("string"))
    with pytest.raises(Exception):
        tables.replace_table(bad, tables.table_path(root, name))
    assert sorted(map(str, tables.read_table(spark, root, name).collect())) == before
    # A table may be replaced by what is read from it.
    tables.replace_table(tables.read_table(spark, root, name).limit(1), tables.table_path(root, name))
    assert tables.read_table(spark, root, name).count() == 1


def test_rerun_with_an_empty_source_empties_its_batch(spark, fx):
    root = fresh_root()
    run_pipeline(spark, fixture_staging(fx), fx.weather_payloads, root, RUN, batch_id="b1")
    run_pipeline(spark, fixture_staging(fx), fx.weather_payloads, root, RUN, batch_id="b2")
    had = counts(spark, root)["dim_discounts"]
    stg = fixture_staging(fx)
    run_pipeline(spark, {**stg, "discounts": stg["discounts"].where("Discont is null")}, fx.weather_payloads, root, RUN,
                 batch_id="b1")
    left = tables.read_table(spark, root, "dim_discounts").groupBy("batch_id").count().collect()
    assert {r.batch_id: r["count"] for r in left} == {"b2": had // 2}


def test_failing_staging_read_is_not_swallowed(spark):
    d = tempfile.mkdtemp(prefix="raincheck-stg-")
    os.makedirs(f"{d}/staging_stores/data/a")
    with open(f"{d}/staging_stores/data/a/part-0.parquet", "w") as f:
        f.write("not parquet")
    tables.commit(spark, f"{d}/staging_stores", {"x": {"folder": "data/a", "sub": "", "of": 1}})
    with pytest.raises(Exception):
        csv.truncate_staging(spark, d, ["stores"])
    csv.truncate_staging(spark, d, ["customers"])        # never loaded: nothing to empty


def test_line_breaks_load_through_the_command_line(spark, fx):
    from raincheck.plans import pipeline
    src = tempfile.mkdtemp(prefix="raincheck-src-")
    stg = fixture_staging(fx)
    stg["products"] = stg["products"].withColumn("Description EN", F.concat(F.col("`Description EN`"), F.lit("\n line two")))
    stg["transactions"] = stg["transactions"].withColumn("SKU", F.lit("a\nb"))
    for name, df in stg.items():
        csv.write_csv(df, f"{src}/{name}.csv")
    pay = tempfile.mkdtemp(prefix="raincheck-pay-") + "/payloads"
    fx.weather_payloads.write.json(pay)
    root = fresh_root()
    pipeline.main(["--sources", src, "--payloads", pay, "--root", root, "--run-date", "2025-03-01",
                   "--multi-line-transactions"])
    got = tables.read_table(spark, root, "dim_products").where(F.col("description_en").endswith("\n line two")).count()
    assert got == stg["products"].count()
    assert tables.read_table(spark, root, "fact_transactions").where("sku = 'a\nb'").count() == stg["transactions"].count()


def test_reports_are_sorted(spark, fx, small_sf):
    from raincheck.plans.registry import QUERIES

    def none_last(*values):
        return tuple((v is None, v) for v in values)
    q1 = QUERIES["revenue_by_weather_over_time"](spark, small_sf).collect()
    assert len(q1) > 1 and [r.time for r in q1] == sorted((r.time for r in q1), key=none_last)
    q2 = QUERIES["top_products_by_weather"](spark, small_sf).collect()
    assert [(r.weather_condition == "Rainy", -r.total_revenue) for r in q2] == sorted(
        (r.weather_condition == "Rainy", -r.total_revenue) for r in q2)
    q3 = QUERIES["revenue_by_size_and_temperature"](spark, small_sf).collect()
    assert [none_last(r.store_size, r.temperature_range) for r in q3] == sorted(
        none_last(r.store_size, r.temperature_range) for r in q3)


def test_a_cluster_needs_a_shared_folder(spark, monkeypatch):
    from types import SimpleNamespace

    from raincheck import session
    fake = SimpleNamespace(conf=SimpleNamespace(get=lambda k, d=None: d),
                           sparkContext=SimpleNamespace(master="spark://h:7077", applicationId="a",
                                                        getCheckpointDir=lambda: None))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_dir(fake)


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {n for n in (files.apply(i).getName() for i in range(files.size())) if n.startswith("shuffle_")}


@pytest.mark.parametrize("buckets", [None, 2])
def test_a_run_leaves_no_shuffle_files_and_no_work_rows(spark, fx, buckets):
    root, before, setting = fresh_root(), shuffle_files(spark), spark.conf.get(session.DROP_SHUFFLES, None)
    run_pipeline(spark, fixture_staging(fx), fx.weather_payloads, root, RUN, buckets=buckets)
    assert shuffle_files(spark) <= before
    assert spark.conf.get(session.DROP_SHUFFLES, None) == setting
    left = [f for d, _, fs in os.walk(f"{root}/state") for f in fs if f.endswith(".parquet")
            and os.path.relpath(d, f"{root}/state").split("/")[0] in ("work", "matched_days")]
    assert left == []


def test_the_shuffle_setting_comes_back_after_a_failure(spark):
    for held in (None, "false", "true"):
        spark.conf.set(session.DROP_SHUFFLES, held) if held else spark.conf.unset(session.DROP_SHUFFLES)
        before = spark.conf.get(session.DROP_SHUFFLES, None)
        with pytest.raises(KeyError), session.shuffles_dropped(spark):
            assert spark.conf.get(session.DROP_SHUFFLES) == "true"
            raise KeyError
        assert spark.conf.get(session.DROP_SHUFFLES, None) == before
    spark.conf.unset(session.DROP_SHUFFLES)

"""Sources, sinks and whole jobs: stored tables read back, and repeated runs."""

from dataclasses import replace
from datetime import date, timedelta
from decimal import Decimal

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from crewcast import fixed_values as fv
from crewcast.plans import monthly, short_term
from crewcast.session import shared_folder
from crewcast.sources import schemas, tables
from crewcast.sources.versioned import Conflict, Segment, VersionedTable
from tests.test_fact import RULES, upstream

FORECAST_DIMS = ("District", "Product", "Technology", "Work_Order_Action", "Work_Force")


def test_shared_folder_is_the_named_one(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    first, second = shared_folder(spark), shared_folder(spark)
    assert first.startswith(base) and first != second


def test_copies_are_removed(spark, frame, monkeypatch):
    from crewcast import session

    monkeypatch.setattr(session, "_made", [])
    paths = [shared_folder(spark) for _ in range(2)]
    tables.written(frame([(1,)], "a int"), paths[0])
    assert session.remove_copies(spark) == 1 and session.remove_copies(spark) == 0
    with pytest.raises(Exception):
        spark.read.parquet(paths[0])


def test_schema_from_json(spark):
    text = """[{"name": "a", "type": "STRING", "mode": "NULLABLE"}, {"name": "n", "type": "NUMERIC"},
      {"name": "r", "type": "RECORD", "mode": "REPEATED", "fields": [{"name": "v", "type": "FLOAT"}, {"name": "d", "type": "DATE"}]}]"""
    df = spark.createDataFrame([], schemas.from_json(text))
    assert df.schema.simpleString() == "struct<a:string,n:decimal(38,9),r:array<struct<v:double,d:date>>>"
    with pytest.raises(ValueError):
        schemas.from_json('[{"name": "g", "type": "GEOGRAPHY"}]')


def test_declared_schemas_parse(spark):
    names = [n for n in dir(schemas) if n.isupper() and not n.startswith("_") and isinstance(getattr(schemas, n), str)]
    widths = {n: len(spark.createDataFrame([], getattr(schemas, n)).columns) for n in names}
    assert widths == {"CORRECTIONS": 9, "DAILY_FACT": 17, "DISPLAY": 13, "DISTRICTS": 8, "EFFICIENCIES": 34, "FORECAST": 12, "PANEL": 9,
                      "PREDICTION_INPUT": 9, "PRODUCT_NAMES": 2, "SPECIAL_PROJECTS": 28, "VOLUMES": 5, "VOLUME_SHEET": 7}


def test_conform_orders_casts_and_fills(frame):
    out = schemas.conform(frame([("5", "x")], "n string, extra string"), "m date, n bigint")
    assert out.schema.simpleString() == "struct<m:date,n:bigint>" and tuple(out.collect()[0]) == (None, 5)


def test_sheet_must_have_the_declared_header(spark, tmp_path):
    path = str(tmp_path / "sheet.csv")
    with open(path, "w") as out:
        out.write("a,b\n1,x\n,y\n")
    assert [tuple(r) for r in tables.read_sheet(spark, path, "a bigint, b string").collect()] == [(1, "x"), (None, "y")]
    with pytest.raises(Exception):
        tables.read_sheet(spark, path, "a bigint, c string").collect()


def test_series_dates_are_coerced(spark, tmp_path):
    path = str(tmp_path / "series.csv")
    with open(path, "w") as out:
        out.write("day,y\n2024-01-02,1\n2024-01-03 10:00:00,2\nbad,3\n")
    got = [tuple(r) for r in tables.read_series(spark, path, "day date, y double", "day").collect()]
    assert got == [(date(2024, 1, 2), 1.0), (date(2024, 1, 3), 2.0), (None, 3.0)]


def test_replacing_partitions_and_refreshing(spark, frame, tmp_path, values):
    path = str(tmp_path / "t")
    rows = frame([("a", 1), ("b", 2)], "k string, v int")
    tables.replace_partitions(rows, path, ["k"])
    tables.replace_partitions(frame([("b", 3)], "k string, v int"), path, ["k"])
    assert values(spark.read.parquet(path).select("k", "v")) == [("a", 1), ("b", 3)]
    other = str(tmp_path / "u")
    for _ in range(2):
        tables.refresh(rows, other)
    assert values(tables.read_parquet(spark, other)) == [("a", 1), ("b", 2)]
    tables.append(rows, other)
    assert tables.read_parquet(spark, other, "k string").count() == 4


def test_history_load_is_repeatable(spark, frame, tmp_path):
    path = str(tmp_path / "history")
    for _ in range(2):
        monthly.load_history(upstream(frame), RULES, date(2024, 3, 1), date(2024, 4, 1), path)
    monthly.load_history(upstream(frame), RULES, date(2024, 4, 1), date(2024, 5, 1), path)
    stored = monthly.history(spark, path)
    assert stored.count() == 3 and stored.agg(F.sum("SWT")).first()[0] == Decimal(8)
    assert stored.columns == [f.split()[0] for f in schemas.DAILY_FACT.split(", ")]


def month(i):
    return date(2022 + i // 12, i % 12 + 1, 1)


@pytest.fixture(scope="module")
def fact(spark):
    """Four years of monthly work of six series."""
    rows = []
    for i in range(48):
        for k, (district, product) in enumerate([("FFB - Calgary", "HSIA"), ("FFB - Yukon", "POTS"), ("FFB - Ontario", "HSIA")]):
            for force in ("LTS", "CNI"):
                hours = Decimal(100 + 10 * k + (i % 12) * 3 + (5 if force == "CNI" else 0))
                rows.append((month(i), force, "COMPLETE", "J", "C", "FIBRE", "INSTALL", "Install", district, "ON", "JC", product,
                             "Unmanaged", hours, hours, 1, 1))
    return spark.createDataFrame(rows, schemas.DAILY_FACT)


def test_monthly_jobs_from_history_to_published_tables(spark, fact, frame, tmp_path):
    folder = str(tmp_path)
    panel = tables.written(monthly.month_panel(fact, date(2026, 1, 10)), f"{folder}/panel")
    assert panel.count() == 6 * 48
    monthly.load_prediction_input(panel, date(2024, 1, 1), date(2026, 1, 1), f"{folder}/input")
    stored = tables.read_parquet(spark, f"{folder}/input", schemas.PREDICTION_INPUT)
    assert stored.groupBy("SWT_Type").count().collect() and stored.count() == 6 * (24 + 18)

    stamps = [f"2025-{m:02d}-05 06:00:00" for m in range(6, 12)] + ["2026-01-05 06:00:00"]
    monthly.forecast_version(panel, f"{folder}/forecast", stamps[-1])
    newest = monthly.forecasts(spark, f"{folder}/forecast")
    assert newest.count() == 6 * 18 and {r[0] for r in newest.select("Forecast_Date").distinct().collect()} == {stamps[-1]}
    assert newest.filter("predicted_SWT.value IS NULL").count() == 0
    shifted = newest.withColumn("Appointment_Month", F.add_months(F.col("Appointment_Month").cast("date"), -7).cast("string"))
    for stamp in stamps[:-1]:
        from crewcast.plans.versions import append_version
        append_version(shifted.drop("Forecast_Date"), f"{folder}/forecast", stamp)
    versions = monthly.forecasts(spark, f"{folder}/forecast")
    assert versions.count() == 7 * 6 * 18

    lookup = frame([("ON", None, None, None, None, "", "FFB - Calgary", "Tier 1"), ("ON", None, None, None, None, "", "FFB - Yukon", "Tier 3")], schemas.DISTRICTS)
    blank = (None,) * 10
    projects = spark.createDataFrame([("n", "p", "HSIA", "Install", None, "FFB - Yukon", None, None, None, "ok") + (None,) * 17 + (5.0,)], schemas.SPECIAL_PROJECTS)
    monthly.publish_cube(fact, versions, lookup, projects, date(2026, 1, 10), f"{folder}/cube")
    cube = monthly.published(spark, f"{folder}/cube", schemas.DISPLAY)
    months = sum(12 * 3 + m + 17 for m in range(6, 12)) + 48 + 18
    assert cube.filter("Work_Order_Action_Grp = 'Install'").count() == 6 * months
    assert cube.filter("Work_Order_Action_Grp = 'PROJECT'").count() == 6  # December 1 is too early for the last version

    sheet = frame([(i % 12 + 1, 2022 + i // 12, p, "Gross Adds", 40 + i % 12, 41 + i % 12, None) for i in range(60) for p in ("HSIA", "POTS")], schemas.VOLUME_SHEET)
    monthly.publish_volumes(sheet, date(2026, 1, 10), f"{folder}/volumes")
    volumes = monthly.published(spark, f"{folder}/volumes", schemas.VOLUMES)
    for _ in range(2):
        monthly.publish_corrections(fact, versions, volumes, f"{folder}/corrections")
    fixed = monthly.published(spark, f"{folder}/corrections", schemas.CORRECTIONS)
    assert fixed.count() == 2 * 13 and {r[0] for r in fixed.select("Forecast_Date").distinct().collect()} == {stamps[-1]}

    monthly.publish_product_names(spark, f"{folder}/names")
    assert monthly.published(spark, f"{folder}/names", schemas.PRODUCT_NAMES).count() == 14

    rules = spark.createDataFrame([("p", "i", None, "o", None, None, "HSIA", "Install", "Tier 1", "10 %") + (0.1,) * 24], schemas.EFFICIENCIES)
    monthly.register_views(fact, versions, rules, lookup, date(2026, 1, 20))
    counts = {v: spark.table(v).count() for v in ("monthly_history", "display", "export", "efficiencies", "efficiency_reductions")}
    assert counts["display"] == counts["export"] == 6 * 48 + 7 * 6 * 18
    assert counts["monthly_history"] == 6 * 48 and counts["efficiencies"] == 24 and counts["efficiency_reductions"] > 0


def test_back_test_job(spark, tmp_path):
    rows = []
    for i in range(160):
        for k, district in enumerate(("FFB - Calgary", "FFB - Yukon")):
            hours = Decimal(50 + 20 * k + (i % 7) * 5)
            rows.append((date(2024, 1, 1) + timedelta(days=i), "LTS", "COMPLETE", "J", "C", "FIBRE", "INSTALL", "Install", district,
                         "ON", "JC", "HSIA", "Unmanaged", hours, hours, 1, 1))
    source = short_term.daily_source(spark.createDataFrame(rows, schemas.DAILY_FACT))
    test = short_term.BackTest(train_start=date(2024, 1, 1), first_train_end=date(2024, 4, 30), horizon=7, fold_count=3, window=28)
    out = short_term.run(source, str(tmp_path), test)
    scores = {(r.model, r.scope): r for r in out["metrics"].collect()}
    assert set(scores) == {(m, s) for m in ("SMA", "SEASONAL_AR", "SEASONAL_ORDER") for s in ("Tier 1", "Tier 3", "Overall")}
    assert scores[("SEASONAL_AR", "Overall")].MAE < 1e-6 < scores[("SMA", "Overall")].MAE
    assert scores[("SEASONAL_ORDER", "Overall")].MAE < 1e-6
    assert out["forecasts"].count() == 3 * 2 * 3 * 7
    assert {r.train_rows for r in out["split_counts"].collect()} == {242, 256, 270}
    assert {r.null_count for r in out["null_counts"].collect()} == {0}
    assert out["numeric_profile"].count() == 7 and out["category_profile"].count() > 0 and out["weekly"].count() > 0


def test_dense_daily_source_fills_gaps(spark):
    rows = [(date(2024, 1, d), "LTS", "COMPLETE", "J", "C", "FIBRE", "INSTALL", "Install", "FFB - Calgary", "ON", "JC", "HSIA", "Unmanaged",
             Decimal(d), Decimal(d), 1, 1) for d in (1, 4)]
    fact = spark.createDataFrame(rows, schemas.DAILY_FACT)
    assert short_term.daily_source(fact).count() == 2
    dense = short_term.daily_source(fact, dense=True)
    assert [r.SWT for r in dense.orderBy("Appointment_Day").collect()] == [1.0, 0.0, 0.0, 4.0]
    assert dense.first().Region_Type == fv.DISTRICT_TIERS["FFB - Calgary"]


NAMES = "k string, v int"


def test_a_refresh_that_dies_half_way_changes_nothing(spark, frame, tmp_path, values):
    table = VersionedTable(spark, str(tmp_path / "t"), NAMES)
    assert table.read().collect() == [] and table.last() is None
    table.replace(frame([("a", 1)], NAMES))

    def dies(*_):
        raise RuntimeError("lost")

    bad = frame([("b", 2)], NAMES).select("k", F.assert_true(F.col("k") == "a", "lost").cast("int").alias("v"))
    with pytest.raises(Exception, match="lost"):
        table.replace(bad)  # while data is written
    commit = table._commit
    table._commit = dies
    with pytest.raises(RuntimeError):
        table.replace(frame([("c", 3)], NAMES))  # between data and commit
    table._commit = commit
    assert values(table.read()) == [("a", 1)] and len(table._names("data")) >= 2
    assert table.replace(table.read().unionByName(frame([("d", 4)], NAMES))) == 2  # reads what it replaces
    assert values(table.read()) == [("a", 1), ("d", 4)] and values(table.read(1)) == [("a", 1)]
    gone = table.vacuum(keep=1)
    assert len(gone) >= 2 and values(table.read()) == [("a", 1), ("d", 4)] and len(table._names("data")) == 1
    with pytest.raises(ValueError):
        table.read(9)


def test_two_writers_of_one_version(spark, frame, tmp_path, values):
    first, second = (VersionedTable(spark, str(tmp_path / "t"), NAMES) for _ in range(2))
    rows = frame([("a", 1)], NAMES)
    stale = first.last
    first.last = lambda version=None: None if version is None else stale(version)
    second.replace(rows)
    told = 0
    for k in range(4):  # the smaller token holds, whoever came first
        try:
            first.replace(frame([("b", k)], NAMES))
        except Conflict:
            told += 1
    tokens = spark.read.schema("version bigint, token string").json(f"{first.path}/commits").filter("version = 1").orderBy("token").collect()
    assert len(tokens) == 5 and stale()["token"] == tokens[0]["token"] and told >= 1 and second.read().count() == 1


periods = st.lists(st.tuples(st.integers(0, 60), st.integers(1, 40)), min_size=1, max_size=6)


@settings(max_examples=200, deadline=None)
@given(periods)
def test_every_day_belongs_to_the_last_load_that_covers_it(loads):
    day = lambda n: date(2024, 1, 1) + timedelta(days=n)
    segments, owner = [], {}
    for k, (first, length) in enumerate(loads):
        segments = [p for s in segments for p in s.without(day(first), day(first + length))] + [Segment(str(k), day(first), day(first + length))]
        owner.update({n: str(k) for n in range(first, first + length)})
    for n in range(110):
        held = [s.load for s in segments if s.first <= day(n) < s.until]
        assert held == ([owner[n]] if n in owner else [])
    assert all(s.first < s.until for s in segments)


def test_overlapping_and_emptied_loads(spark, frame, tmp_path, values):
    schema = "day date, v int"
    table = VersionedTable(spark, str(tmp_path / "t"), schema, "day")
    days = lambda a, b, v: frame([(date(2024, 1, 1) + timedelta(days=n), v) for n in range(a, b)] + [(None, v)], schema)
    at = lambda n: date(2024, 1, 1) + timedelta(days=n)
    table.load(days(0, 60, 1), at(0), at(60))
    table.load(days(20, 90, 2), at(30), at(90))  # ten days more than it owns
    table.load(days(0, 0, 3), at(40), at(45))
    want = [(at(n), 1) for n in range(30)] + [(at(n), 2) for n in range(30, 90) if not 40 <= n < 45]
    assert values(table.read()) == sorted(want, key=repr)
    scan = table.read().filter(F.col("day") < at(20))._jdf.queryExecution().executedPlan().toString()
    assert "load_month" in scan and "PartitionFilters: [" in scan
    before = table.last()["version"]
    table.compact()
    assert values(table.read()) == sorted(want, key=repr) and len(table.last()["segments"]) == 1
    assert values(table.read(before)) == sorted(want, key=repr)
    with pytest.raises(ValueError):
        VersionedTable(spark, str(tmp_path / "u"), schema).load(days(0, 1, 1), at(0), at(1))


def test_an_emptied_period_of_the_history_is_empty(spark, frame, tmp_path):
    path = str(tmp_path / "history")
    up = upstream(frame)
    monthly.load_history(up, RULES, date(2024, 3, 1), date(2024, 4, 1), path)
    had = monthly.history(spark, path).count()
    monthly.load_history(replace(up, job=up.job.limit(0)), RULES, date(2024, 3, 1), date(2024, 4, 1), path)
    assert had > 0 and monthly.history(spark, path).count() == 0


def test_corrections_need_enough_versions(spark, fact, frame, tmp_path):
    versions = spark.createDataFrame([], schemas.FORECAST)
    with pytest.raises(ValueError, match="versions before"):
        monthly.publish_corrections(fact, versions, spark.createDataFrame([], schemas.VOLUMES), str(tmp_path / "c"))


def test_a_slot_is_replaced_and_others_stay_where_they_lie(spark, frame, tmp_path, values):
    table = VersionedTable(spark, str(tmp_path / "t"), NAMES)
    for slot, v in (("x", 1), ("y", 2), ("x", 3)):
        table.put(frame([(slot, v)], NAMES), slot)
    assert values(table.read()) == [("x", 3), ("y", 2)] and values(table.read(2)) == [("x", 1), ("y", 2)]
    assert len(table._names("data")) == 3 and len(table.vacuum(keep=1)) == 1
    table.put(frame([], NAMES), "y")
    assert values(table.read()) == [("x", 3)]


def test_histories_are_written_several_at_a_time(frame, monkeypatch):
    from threading import Barrier

    from crewcast.sources import histories

    meet = Barrier(2, timeout=30)
    names = list(histories.LAYOUTS)

    def store(rows, table, path, layout, buckets, unit):
        if table in (f"p_{names[0]}", f"p_{names[1]}"):
            meet.wait()  # breaks if the second one starts after the first has ended
        return table, path, layout

    monkeypatch.setattr(histories, "store", store)
    stored = histories.store_all(upstream(frame), "p", "/f", 2)
    assert all(getattr(stored, n) == (f"p_{n}", f"/f/{n}", histories.LAYOUTS[n]) for n in names)


def test_a_load_stores_the_rows_that_are_left(frame, tmp_path, monkeypatch):
    """The histories after them are cut to these rows."""
    kept = []
    monkeypatch.setattr(monthly.tables, "written", lambda rows, path, write=tables.written: kept.append(write(rows, path)) or kept[-1])
    path = str(tmp_path / "history")
    monthly.load_history(upstream(frame), RULES, date(2024, 3, 1), date(2024, 4, 1), path)
    assert [sorted(r.work_order_id for r in rows.collect()) for rows in kept] == [[1, 2]]
    assert monthly.history(kept[0].sparkSession, path).count() == 3

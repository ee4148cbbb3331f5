"""Interval joins, additive distinct counts and checked sheets against plain forms."""

from datetime import date, timedelta

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from crewcast.operators.distinct import distinct_keys, key_bitmaps, numbered_keys
from crewcast.operators.joins import interval_join, near_keys
from crewcast.operators.latest import latest_version_flag, nth_latest_version
from crewcast.sources.tables import read_checked_sheet

EPOCH = date(1969, 12, 1)
day = st.one_of(st.none(), st.integers(0, 120).map(lambda n: EPOCH + timedelta(days=n)))
spans = st.lists(st.tuples(day, day), max_size=12)


@settings(max_examples=40, deadline=None)
@given(spans, spans, st.sampled_from([1, 7, 31, 400]))
def test_interval_join_is_all_overlapping_pairs(spark, left, right, days):
    side = lambda rows, name: spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], f"{name} int, {name}0 date, {name}1 date")
    got = interval_join(side(left, "a"), side(right, "b"), ("a0", "a1"), ("b0", "b1"), days)
    assert got.columns == ["a", "a0", "a1", "b", "b0", "b1"]
    # An open end reaches to the outermost day of either side, which for overlaps is as far as any.
    known = [d for r in (*left, *right) for d in r if d] or [date(1970, 1, 1)]
    closed = lambda r: (r[0] or min(known), r[1] or max(known))
    want = []
    for i, l in enumerate(map(closed, left)):
        for j, r in enumerate(map(closed, right)):
            if l[0] <= l[1] and r[0] <= r[1] and max(l[0], r[0]) <= min(l[1], r[1]):
                want.append((i, j))
    assert sorted((r["a"], r["b"]) for r in got.collect()) == want


facts = st.lists(st.tuples(st.sampled_from("ab"), st.integers(0, 3), st.one_of(st.none(), st.integers(0, 50).map(lambda n: f"order {n}"))), max_size=60)


@settings(max_examples=20, deadline=None)
@given(facts)
def test_bitmaps_count_distinct_keys_at_any_grain(spark, rows):
    df = spark.createDataFrame(rows, "place string, month int, key string")
    numbers = numbered_keys(df, "key", [F.col("month")])
    assert sorted(r["number"] for r in numbers.collect()) == list(range(len({r[2] for r in rows} - {None})))
    kept = key_bitmaps(df, ["place", "month"], "key", numbers)
    for by in (["place", "month"], ["place"], ["month"], []):
        at = [("place", "month", "key").index(c) for c in by]
        want = {}
        for r in rows:
            if r[2] is not None:
                want.setdefault(tuple(r[i] for i in at), set()).add(r[2])
        got = {tuple(r[c] for c in by): r["n"] for r in distinct_keys(kept, by, "n").collect()}
        assert got == ({k: len(v) for k, v in want.items()} if by else {(): len(want[()]) if want else None})


def test_bitmaps_of_many_blocks(spark):
    df = spark.range(100_000).select((F.col("id") % 3).alias("g"), F.concat(F.lit("k"), F.col("id") % 70_000).alias("key"))
    kept = key_bitmaps(df, ["g"], "key", numbered_keys(df, "key"))
    assert kept.select("block").distinct().count() == 3
    assert distinct_keys(kept, [], "n").first()["n"] == 70_000
    assert {r["g"]: r["n"] for r in distinct_keys(kept, ["g"], "n").collect()} == {r["g"]: r["n"] for r in df.groupBy("g").agg(F.countDistinct("key").alias("n")).collect()}


def test_checked_sheet_splits_rows_and_faults(spark, tmp_path):
    path = str(tmp_path / "sheet.csv")
    with open(path, "w") as out:
        out.write("a,d,t\n1,2024-01-02,x\n,,\nbad,2024-01-03,y\n3,never,z\nbad,never,q\n5,2024-01-05\n6,2024-01-06,x,more\n")
    rows, rejects = read_checked_sheet(spark, path, "a bigint, d date, t string")
    assert sorted(map(tuple, rows.collect()), key=str) == [(1, date(2024, 1, 2), "x"), (None, None, None)]
    found = sorted(((r["line"], r["column"], r["cell"]) for r in rejects.collect()), key=str)
    assert found == sorted([("bad,2024-01-03,y", "a", "bad"), ("3,never,z", "d", "never"), ("bad,never,q", "a", "bad"), ("bad,never,q", "d", "never"),
                            ("5,2024-01-05", None, None), ("6,2024-01-06,x,more", None, None)], key=str)
    assert {r["file"].rsplit("/", 1)[1] for r in rejects.collect()} == {"sheet.csv"}
    assert rows.count() == 2 and rejects.count() == 6


def test_versions_are_ordered_by_time_not_by_text(frame):
    rows = frame([("2000-9-01",), ("2000-10-01",), ("2000-10-01",), (None,), ("draft",)], "v string")
    flags = {r["v"]: r["newest"] for r in rows.withColumn("newest", latest_version_flag(rows, "v")).collect()}
    assert flags == {"2000-9-01": False, "2000-10-01": True, None: False, "draft": False}
    assert [nth_latest_version(rows, "v", k).collect()[0][0] for k in range(3)] == ["2000-10-01", "2000-9-01", "draft"]
    assert nth_latest_version(rows, "v", 3).collect() == []


def test_more_keys_than_may_be_listed_still_cut(spark):
    """Beyond the limit a bit per key is broadcast: no key is lost, and few others pass."""
    rows = spark.range(60_000).selectExpr("id - 20000 AS n", "'k' || id AS s", "int(id) AS small")
    left = rows.filter("n % 20 = 0").unionByName(spark.sql("SELECT bigint(NULL) AS n, string(NULL) AS s, int(NULL) AS small"))
    for key in ("n", "s"):
        cut = near_keys(left, key, limit=20_000)(rows)
        assert cut.columns == rows.columns and left.filter("n IS NOT NULL").exceptAll(cut).isEmpty()
        assert 3_000 <= cut.count() < 3_000 + 0.15 * 57_000 and cut.exceptAll(rows).isEmpty()
        assert near_keys(left, key, limit=11_000)(rows).count() == 60_000
    other = rows.selectExpr("n AS small")
    assert near_keys(left, "small", limit=20_000)(other).count() == 60_000
    assert near_keys(left.selectExpr("decimal(n) AS n"), "n", limit=20_000)(rows.selectExpr("decimal(n) AS n")).count() == 60_000

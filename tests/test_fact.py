"""Fact build on a hand-made fixture with the awkward rows."""

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from crewcast.operators.joins import resolve_hierarchy
from crewcast.operators.latest import Latest, latest_counts, latest_pivot, latest_rows, open_rows
from crewcast.plans import fact
from crewcast.plans.fact import FactRules, Upstream

OPEN, CLOSED = datetime(9999, 12, 31), datetime(2024, 1, 1)
RULES = FactRules(own_company="HOMECO", project_manager="boss", districts=("D-HOME",), district_patterns=("%FFB%",),
                  source_districts=("SRC",))
START, END = date(2024, 3, 1), date(2024, 4, 1)


def upstream(frame, **changes) -> Upstream:
    """Order 1 with two components, order 2 with none, plus whatever a test replaces."""
    day = datetime(2024, 3, 10, 15)
    tables = {
        "work_order": ([(1, "20001", "DATA", "ORDER", "I"), (2, "20001", "MM", "TROUBLE", None)],
                       "work_order_id int, orig_system_id string, work_order_category_cd string, work_order_classification_cd string, work_order_action_cd string"),
        "component": ([(1, 11, Decimal("2.5"), "R", "POTS", "POTS", None), (1, 12, Decimal("1.5"), "C", "BVOIP", "BVOIP", "COPPER")],
                      "work_order_id int, work_order_component_id int, estimated_duration_amt decimal(10,2), work_order_action_cd string, job_type_cd string, product_category_cd string, technology_cd string"),
        "job": ([(101, 1, 9, "JT", day, day, Decimal(8)), (102, 2, 9, "JT", None, day, Decimal(4))],
                "job_id int, work_order_id int, external_job_grouping_id int, job_type_cd string, appointment_start_datetime timestamp_ntz, early_start_time timestamp_ntz, estimated_duration decimal(10,2)"),
        "assignment": ([(201, 101, "w1", OPEN), (202, 102, "w1", OPEN), (203, 102, "w1", CLOSED)],
                       "job_assignment_id int, job_id int, team_member_id string, effective_end_ts timestamp_ntz"),
        "work_order_status": ([], "work_order_id int, effective_end_ts timestamp_ntz"),
        "job_status": ([(101, "OPEN", OPEN), (102, "OPEN", OPEN)], "job_id int, job_status_cd string, effective_end_ts timestamp_ntz"),
        "location": ([(k, "NAVIGATION_HIERARCHY", "ON", "R", "x FFB y", "A1", "America/Toronto", day, OPEN, None) for k in (1, 2)],
                     "work_order_id int, work_order_location_usage_cd string, province_cd string, region_nm string, district_nm string, service_area_clli_cd string, common_area_text string, src_last_updt_ts timestamp_ntz, effective_end_ts timestamp_ntz, municipality_nm string"),
        "work_order_attribute": ([(2, "PRODUCT_CATEGORY", "POTS", 1), (2, "TECHNOLOGY", "FIBRE", 1)],
                                 "work_order_id int, work_order_attribute_cd string, work_order_attribute_value_txt string, work_order_attribute_value_id int"),
        "job_attribute": ([], "job_id int, job_attribute_cd string, job_attribute_value_txt string"),
        "processing_state": ([], "job_id int, job_processing_state_cd string, job_processing_state_desc string, effective_start_ts timestamp_ntz"),
        "assignment_status": ([(201, "COMPLETE", "done", day), (202, "COMPLETE", "done", day)],
                              "job_assignment_id int, job_assignment_status_cd string, job_assignment_status_rsn_cd string, actual_status_dt timestamp_ntz"),
        "service": ([], "work_order_id int, service_type_cd string, service_identification string"),
        "party": ([], "work_order_id int, effective_end_ts timestamp_ntz"),
        "time_entry": ([(101, 11, Decimal(3), OPEN), (101, 11, Decimal(1), OPEN), (101, None, Decimal(9), OPEN), (102, None, Decimal(5), OPEN),
                        (102, None, Decimal(7), CLOSED)],
                       "job_id int, work_order_component_id int, number_of_hours decimal(10,2), effective_end_ts timestamp_ntz"),
        "team_member": ([("w1", "boss", "Ann", "Lee", None), ("boss", None, "Bo", "Ray", None)],
                        "team_member_id string, manager_team_member_id string, preferred_given_name string, family_name string, contracting_company_nm string"),
        "districts": ([("A1", "", "FFB new", "FFB old")], "service_area_clli string, migration string, district string, district_old string"),
        "product_keys": ([("POTSPOTS", "POTS"), ("JTPOTS", "HSIA")], "product_key string, product string"),
    }
    for name, rows in changes.items():
        tables[name] = (rows, tables[name][1])
    return Upstream(**{name: frame(*spec) for name, spec in tables.items()})


def rows(frame, **changes):
    out = fact.service_fact(upstream(frame, **changes), RULES, START, END)
    return {(r.Job_Type_Cd, r.Product_Category): r for r in out.collect()}


def test_component_values_win_over_job_values(frame):
    got = rows(frame)
    pots, voip, job = got[("POTS", "POTS")], got[("BVOIP", "BVOIP")], got[("JT", "POTS")]
    assert (pots.SWT, pots.AWT, pots.Work_Order_Action, pots.Work_Order_Action_Grp) == (Decimal("2.5"), Decimal(4), "REPAIR", "Repair")
    assert pots.Technology is None  # the component's null is kept
    assert (voip.SWT, voip.AWT, voip.Work_Order_Action, voip.Product, voip.Product_Grp) == (Decimal("1.5"), 0, "CHANGE", "OTHER", "OTHER")
    assert (job.SWT, job.AWT, job.Technology, job.Product, job.Product_Grp) == (4, 5, "FIBRE", "HSIA", "Unmanaged")
    assert job.Work_Order_Action == "REPAIR"  # trouble without an action
    assert {r.District for r in got.values()} == {"FFB new"}
    assert {r.Work_Force for r in got.values()} == {"HOMECO"}
    assert {r.Appointment_Timestamp for r in got.values()} == {date(2024, 3, 10)}


def test_repeating_tables_multiply_rows_but_not_the_distinct_count(frame):
    got = rows(frame, party=[(2, OPEN), (2, OPEN), (2, CLOSED)], work_order_status=[(2, OPEN), (2, OPEN), (2, OPEN)],
               job_status=[(101, "OPEN", OPEN), (102, "OPEN", OPEN), (102, "ASSIGNED", OPEN), (102, "CANCELLED", CLOSED)])
    job = got[("JT", "POTS")]
    assert (job.JobCount, job.WorkOrderCount, job.SWT, job.AWT) == (12, 1, 48, 60)


def test_dispatch_ties_multiply_rows(frame):
    day, older = datetime(2024, 3, 10, 15), datetime(2024, 3, 1)
    nav = [(k, "NAVIGATION_HIERARCHY", "ON", "R", "x FFB y", "A1", "America/Toronto", day, OPEN, None) for k in (1, 2)]
    ship = [(2, "DISPATCH", "ON", "R", None, "A1", None, when, OPEN, None) for when in (day, day, older)]
    assert rows(frame, location=nav + ship)[("JT", "POTS")].JobCount == 2


@pytest.mark.parametrize("changes", [
    {"job_status": [(101, "OPEN", OPEN), (102, "CANCELLED", OPEN)]},
    {"assignment_status": [(201, "COMPLETE", "", datetime(2024, 3, 1)), (202, "COMPLETE", "", datetime(2024, 3, 2)), (202, "REJECTED", "", datetime(2024, 2, 2))]},
    {"assignment": [(201, 101, "w1", OPEN), (202, 102, "nobody", OPEN)]},
    {"assignment": [(201, 101, "w1", OPEN), (202, 102, "w1", CLOSED)]},
    {"processing_state": [(102, "IS_ASSIST", "1", CLOSED)]},
    {"service": [(2, "PHONE", "an oncall line")]},
])
def test_rows_that_drop_out(frame, changes):
    assert set(rows(frame, **changes)) == {("POTS", "POTS"), ("BVOIP", "BVOIP")}


def test_assist_from_the_exempt_system_stays(frame):
    orders = [(1, "20001", "DATA", "ORDER", "I"), (2, "14184", "MM", "TROUBLE", None)]
    got = rows(frame, work_order=orders, processing_state=[(102, "IS_ASSIST", "1", CLOSED)])
    assert ("JT", "POTS") in got


def test_local_day_decides(frame):
    late = datetime(2024, 4, 1, 3)  # still March 31 in Toronto
    spring = datetime(2024, 3, 1, 4, 59)  # still February 29 in Toronto
    jobs = [(101, 1, 9, "JT", spring, datetime(2024, 5, 1), Decimal(8)), (102, 2, 9, "JT", late, None, Decimal(4))]
    got = rows(frame, job=jobs)
    assert set(got) == {("JT", "POTS")} and got[("JT", "POTS")].Appointment_Timestamp == date(2024, 3, 31)


def test_local_day_across_clock_change(frame):
    zone = [(datetime(2024, 3, 10, 6, 30), "America/Toronto"), (datetime(2024, 3, 10, 3, 59), "America/Toronto"), (None, "UTC"),
            (datetime(2024, 11, 4, 4, 30), "America/Toronto")]
    df = frame(zone, "ts timestamp_ntz, zone string")
    got = [r.d for r in df.select(fact.local_date(F.col("ts"), F.col("zone")).alias("d")).collect()]
    assert got == [date(2024, 3, 10), date(2024, 3, 9), None, date(2024, 11, 3)]


def test_early_start_counts_when_appointment_is_outside(frame):
    jobs = [(102, 2, 9, "JT", datetime(2024, 6, 5, 12), datetime(2024, 3, 5, 12), Decimal(4))]
    assert rows(frame, job=jobs)[("JT", "POTS")].Appointment_Timestamp == date(2024, 6, 5)


def labels(frame, spec):
    """spec: (special_project, work_force, province, manager, class, job type, code, classification)"""
    names = ("special_project", "work_force", "province", "MGR_TID", "work_class", "job_type", "action_code", "classification")
    df = frame(spec, ", ".join(f"{n} string" for n in names))
    return [r.a for r in df.select(fact.work_order_action(RULES).alias("a")).collect()]


def test_action_ladder_order(frame):
    base = (None, "HOMECO", "ON", "m", "BAU", "X", None, "ORDER")

    def case(**kw):
        names = ("project", "force", "province", "manager", "cls", "job", "code", "kind")
        return tuple(kw.get(n, b) for n, b in zip(names, base))

    assert labels(frame, [
        case(force="CNI", province="QC", project="c2f one"), case(project="c2f one"), case(project="smp migration"),
        case(project="nbd special project 1a", manager="boss", code="I"), case(project="nbd special project 1a", manager="x"),
        case(project="goc wcs"), case(project="goc wcs", force="CNI"), case(project="goc wcs", force=None, code="R"),
        case(project="ahs etts schc 2"), case(cls="Prestage", code="I"), case(job="PREXSTAGE_1"), case(job="PREFIELD_9", code="I"),
        case(code="PREV"), case(code="RSR"), case(code="CE"), case(kind="TROUBLE"), case(kind="TROUBLE", code="?"), case(),
    ]) == [
        "EXCLUDE", "PROJECT", "PROJECT", "INSTALL", "PROJECT", "PROJECT", "PROJECT (EXCLUDE)", "REPAIR", "PROJECT (EXCLUDE)",
        "PRESTAGE", "PRESTAGE", "PREFIELD", "PREFIELD", "RISER", "OUT", "REPAIR", "OTHER", "OTHER",
    ]


def test_work_class_patterns(frame):
    df = frame([("X ONCALL",), ("NGM1",), ("SPAN NGM",), ("COXWORK",), (None,), ("plain",)], "s string")
    got = [r.c for r in df.select(fact.work_class(F.col("s")).alias("c")).collect()]
    assert got == ["On Call", "NGM", "SPAN", "CO Work", "BAU", "BAU"]


def test_product_group_sides(frame):
    df = frame([("SDS WIFI", "QC"), ("SDS WIFI", None), ("SDS WIFI", "ON"), ("CPS", "QC"), ("CPS", "ON"), ("POTS", None), (None, "ON")],
               "p string, v string")
    alone = [r.g for r in df.select(fact.product_group(F.col("p"), F.col("v")).alias("g")).collect()]
    inline = [r.g for r in df.select(fact.product_group(F.col("p"), F.col("v"), anywhere=("SDS WIFI",)).alias("g")).collect()]
    assert alone == ["OTHER", "OTHER", "Unmanaged 3rd Wave", "Managed CPS", "OTHER", "OTHER", "OTHER"]
    assert inline == ["Unmanaged 3rd Wave"] * 3 + alone[3:]


def test_address_parts(frame):
    cols = ["work_order_id", "work_order_location_usage_cd", "src_last_updt_ts", "effective_end_ts", "lattitude", "longitude",
            *fact.fv.SERVICE_ADDRESS, *fact.fv.CIVIC_ADDRESS]
    kinds = {"src_last_updt_ts": "int", "effective_end_ts": "timestamp_ntz", "lattitude": "double", "longitude": "double", "work_order_id": "int"}
    schema = ", ".join(f"{c} {kinds.get(c, 'string')}" for c in cols)
    def row(key, when, city):
        return (key, "DISPATCH", when, OPEN, 1.0, 2.0, None, " 12 ", "Main", None, "K1K", "77", None, " Oak ", "ST", city, "ON", None)
    df = frame([row(1, 1, None), row(2, 1, "Ajax"), row(2, 0, "Old")], schema)
    got = {r.work_order_id: r.PARTY_ADDRESS for r in fact.dispatch_location(df).collect()}
    assert got == {1: "12 Main K1K", 2: "77 Oak ST Ajax ON"}


def test_rebook_indicator_and_group_demand(frame):
    attrs = frame([(1, "REBOOKREQ_IND", "true"), (2, "REBOOKREQ_IND", "no"), (3, "DEMANDTYPE", "a"), (4, "DEMANDTYPE", "b")],
                  "job_id int, job_attribute_cd string, job_attribute_value_txt string")
    jobs = frame([(3, 7), (4, 7)], "job_id int, external_job_grouping_id int")
    got = {r.job_id: r.REBOOKREQ_IND for r in fact.job_attributes(attrs).collect()}
    assert got == {1: "1", 2: "0", 3: None, 4: None}
    assert [tuple(r) for r in fact.group_demand(attrs, jobs).collect()] == [(7, "b")]


def test_latest_pivot_ties_nulls_and_absent_codes(frame, values):
    df = frame([(1, "a", "x", 5), (1, "a", "y", 5), (1, "a", "z", 4), (1, "b", None, 9), (1, "b", "old", 1), (2, "c", "no", 1),
                (3, "a", "only", None)], "k int, code string, v string, o int")
    out = latest_pivot(df, "k", "code", "o", {"a": Latest(["a"], "v"), "b": Latest(["b"], "v"), "ab": Latest(["a", "b"], "v")})
    assert values(out) == [(1, "y", None, "y"), (3, "only", None, "only")]


def test_latest_rows_keep_ties_and_null_order(frame, values):
    df = frame([(1, 5, "x"), (1, 5, "y"), (1, None, "n"), (2, None, "p"), (2, None, "q"), (None, 1, "r")], "k int, o int, v string")
    assert values(latest_rows(df, ["k"], "o").select("v")) == [("p",), ("q",), ("r",), ("x",), ("y",)]
    assert values(latest_counts(df, "k", "o", "n")) == [(1, 2), (2, 2), (None, 1)]


def test_open_rows(frame):
    df = frame([(1, OPEN), (2, CLOSED), (3, None)], "k int, effective_end_ts timestamp_ntz")
    assert [r.k for r in open_rows(df).collect()] == [1]


def test_hierarchy_without_manager_or_company(frame):
    df = frame([("a", None, "A", "One", "X"), ("b", "a", "B", "Two", None), ("c", "b", "C", None, None), ("d", "gone", "D", "Four", "Y")],
               "team_member_id string, manager_team_member_id string, preferred_given_name string, family_name string, contracting_company_nm string")
    got = {r.team_member_id: (r.MGR_TID, r.OPS_TID, r.OPS_MGR, r.TECHNICIAN, r.COMPANY) for r in resolve_hierarchy(df, "OWN").collect()}
    assert got == {
        "a": (None, None, None, "A One", "X"), "b": ("a", None, None, "B Two", "OWN"), "c": ("b", "a", "A One", None, "OWN"),
        "d": (None, None, None, "D Four", "Y"),
    }


def test_the_fact_reads_only_the_codes_and_rows_it_needs(frame, spark):
    """Histories are aggregated before they are moved, and only of the codes that the rows carry."""
    from tests.test_plans import plan

    text = plan(fact.service_fact(upstream(frame), RULES, START, END))
    assert "LeftSemi" not in text
    assert not [code for code in ("SITE_ACCESS", "READY_FOR_DISPATCH", "DISPATCHED") if code in text]


def test_closing_codes_are_those_of_the_statuses_without_a_sort(frame):
    from tests.test_plans import plan

    given = upstream(frame, assignment_status=[
        (201, "COMPLETE", "a", datetime(2024, 3, 1)), (201, "REJECTED", "b", None), (202, "ON_SITE", "c", datetime(2024, 3, 1)),
        (203, "INCOMPLETE", None, datetime(2024, 3, 2)), (203, "COMPLETE", "d", datetime(2024, 3, 2)), (204, None, None, None),
    ]).assignment_status
    every = {r.job_assignment_id: r.JOB_ASSIGNMENT_STATUS_CD for r in fact.assignment_statuses(given).collect()}
    lean = fact.closing_codes(given)
    assert {r.job_assignment_id: r.JOB_ASSIGNMENT_STATUS_CD for r in lean.collect()} == {k: v for k, v in every.items() if v is not None}
    assert every == {201: "REJECTED", 202: None, 203: "INCOMPLETE"}
    assert "HashAggregate" in plan(lean) and "SortAggregate" not in plan(lean)


def test_histories_are_cut_to_the_kept_rows(frame, monkeypatch):
    """Rows stored in between change nothing, and the histories joined after them are cut by their broadcast keys."""
    from crewcast.operators import joins
    from crewcast.session import shared_folder
    from crewcast.sources.tables import written
    from tests.test_plans import plan

    up = upstream(frame, service=[(1, "ACCOUNT", "x"), (2, "PHONE", "y"), (3, "PHONE", "z")])
    keep = lambda rows: written(rows, shared_folder(rows.sparkSession))
    whole = fact.service_fact(up, RULES, START, END)
    cut = fact.service_fact(up, RULES, START, END, keep)
    assert plan(cut).count("LeftSemi, BuildRight") >= 7
    assert sorted(map(repr, cut.collect())) == sorted(map(repr, whole.collect()))
    left = keep(up.work_order.filter("work_order_id = 1"))
    assert [r.work_order_id for r in joins.near_keys(left, "work_order_id")(up.service).collect()] == [1]
    assert joins.near_keys(left, "work_order_id", limit=1)(up.service).count() == 3
    monkeypatch.setattr(fact, "near_keys", lambda others, key: joins.near_keys(others, key, limit=1))
    assert sorted(map(repr, fact.service_fact(up, RULES, START, END, keep).collect())) == sorted(map(repr, whole.collect()))


def test_jobs_meet_their_assignments_before_their_work_orders(frame):
    """What drops jobs by their own key comes first, so the rows move by work order once, for all that is joined by it."""
    import re

    built = fact.work_rows(upstream(frame), RULES, START, END)._jdf.queryExecution().analyzed().toString()
    joined = [a for a, b in re.findall(r"Join Inner, \((\w+)#\d+ = (\w+)#\d+\)", built) if a == b]
    assert joined == ["work_order_id", "work_order_id", "team_member_id", "job_assignment_id", "job_id", "job_id"]


def test_a_table_function_may_read_stored_rows(frame, spark):
    """With ``keep`` a call joins nothing: it reads its days from the rows that were stored when it was registered."""
    from crewcast.plans.sql_functions import register_period_fact
    from crewcast.session import shared_folder
    from crewcast.sources.tables import written
    from tests.test_plans import plan

    up = upstream(frame, job=[(101, 1, 9, "JT", datetime(2024, 3, 10, 15), datetime(2024, 3, 10, 15), Decimal(8)),
                              (102, 2, 9, "JT", datetime(2024, 4, 20, 15), datetime(2024, 4, 2, 2), Decimal(4))])
    register_period_fact(up, RULES, "lazy_")
    register_period_fact(up, RULES, "kept_", lambda rows: written(rows, shared_folder(spark)))
    for first, until, n in (("2024-03-01", "2024-04-01", 2), ("2024-03-01", "2024-04-02", 3), ("2024-04-02", "2024-05-01", 1), ("2025-01-01", "2026-01-01", 0)):
        lazy, kept = (spark.sql(f"SELECT * FROM {p}_period_fact(DATE'{first}', DATE'{until}')") for p in ("lazy", "kept"))
        assert sorted(map(repr, kept.collect())) == sorted(map(repr, lazy.collect())) and kept.count() == n
        assert "Join" in plan(lazy) and "Join" not in plan(kept) and "early_start_time" in plan(kept)

from __future__ import annotations

import datetime as dt

import pytest

from feedkit.plans import transfers as tr

from .conftest import rows

D = dt.date
TRANSFER = "id int, personid bigint, trainingprogram string, credithours string, completeddate date, isvalid string"
PERSON = "personid bigint, hiredate date"
REQUIREMENT = (
    "personid bigint, trainingprogram string, trackingdate date, duedate date, duedateextension date, "
    "requiredhours double, earnedhours double, transferredhours double, status string"
)
BT, CE = "Basic Training 70 Hours", "Continuing Education"
FROM, DUE, LATE = D(2023, 1, 1), D(2023, 6, 30), D(2023, 12, 31)


def ruled(spark, transfer, person, requirement):
    t = spark.createDataFrame([(1, 1, *transfer, "true")], TRANSFER)
    p = spark.createDataFrame([(1, person)], PERSON)
    r = spark.createDataFrame([(1, *requirement)] if requirement else [], REQUIREMENT)
    out = tr.apply_transfer_rules(tr.eligible_hours(t), p, r)
    return out.select("is_valid", "error_message", "transferhours", "additionalerrors").first()


M = tr.MESSAGES
BASIC = (BT, FROM, DUE, None, 70.0, 0.0, 0.0, "Active")
HIRED = D(2021, 5, 1)


@pytest.mark.parametrize(
    ("transfer", "hired", "requirement", "expected"),
    [
        # basic training: hours must equal the requirement, up to the due date or its extension
        ((BT, "70", D(2023, 6, 30)), HIRED, BASIC, (True, None, 70.0, None)),
        ((BT, "70.00", D(2023, 6, 30)), HIRED, BASIC, (True, None, 70.0, None)),
        ((BT, "70", D(2023, 7, 1)), HIRED, BASIC, (True, None, None, M["basic_late"])),
        ((BT, "70", D(2023, 7, 1)), HIRED, (BT, FROM, DUE, LATE, 70.0, 0.0, 0.0, "active"), (True, None, 70.0, None)),
        ((BT, "70", D(2023, 6, 1)), HIRED, (BT, FROM, DUE, None, 30.0, 0.0, 0.0, "active"), (True, None, None, None)),
        # hire date
        ((BT, "70", D(2021, 4, 30)), HIRED, BASIC, (False, M["before_hire"], 70.0, None)),
        ((BT, "70", D(2021, 4, 30)), None, BASIC, (True, None, 70.0, None)),
        # no active requirement
        ((BT, "70", D(2023, 6, 1)), HIRED, None, (False, M["no_requirement"], None, None)),
        ((BT, "70", D(2023, 6, 1)), HIRED, (*BASIC[:-1], "closed"), (False, M["no_requirement"], None, None)),
        ((CE, "5", D(2023, 6, 1)), HIRED, None, (False, M["no_requirement"], None, M["excess"])),
        # continuing education: inside the window, exactly the open hours, hired late enough
        ((CE, "10", D(2023, 6, 1)), HIRED, (CE, FROM, DUE, None, 12.0, 0.0, 2.0, "active"), (True, None, 12.0, None)),
        ((CE, "10", D(2023, 6, 1)), HIRED, (CE, FROM, DUE, None, 12.0, None, 2.0, "active"), (True, None, 12.0, None)),
        ((CE, "12", D(2023, 1, 1)), HIRED, (CE, FROM, DUE, None, 12.0, None, None, "active"), (True, None, 12.0, None)),
        ((CE, "12", D(2022, 12, 31)), HIRED, (CE, FROM, DUE, None, 12.0, None, None, "active"), (True, None, None, M["continuing_window"])),
        ((CE, "12", D(2023, 7, 1)), HIRED, (CE, FROM, DUE, None, 12.0, None, None, "active"), (True, None, None, M["continuing_window"])),
        ((CE, "12", D(2023, 6, 1)), D(2020, 2, 29), (CE, FROM, DUE, None, 12.0, None, None, "active"), (True, None, None, M["hired_early"])),
        ((CE, "12", D(2023, 6, 1)), D(2020, 3, 1), (CE, FROM, DUE, None, 12.0, None, None, "active"), (True, None, 12.0, None)),
        ((CE, "12", D(2023, 6, 1)), HIRED, (CE, FROM, DUE, None, 12.0, 1.0, 0.0, "active"), (True, None, None, M["excess"])),
        ((CE, "3", D(2023, 6, 1)), HIRED, (CE, FROM, DUE, None, 12.0, 1.0, 0.0, "active"), (True, None, None, None)),
    ],
)
def test_rules(spark, transfer, hired, requirement, expected):
    assert tuple(ruled(spark, transfer, hired, requirement)) == expected


@pytest.mark.parametrize(
    ("program", "hours", "survey", "ok"),
    [
        (BT, "70", False, True),
        (BT, "70.4", False, True),  # the feed drops fractions
        (BT, "70.4", True, False),
        (BT, "69", False, False),
        ("Basic Training 7 Hours", "7", False, False),
        ("Basic Training 7 Hours", "7", True, True),
        ("Orientation & Safety", "5", False, True),
        (" Continuing Education ", "0", False, True),
        (CE, "12", False, True),
        (CE, "13", False, False),
        (CE, "12.5", False, True),
        (CE, "12.5", True, False),
        (CE, "n/a", False, False),
        (CE, None, False, False),
        (None, "5", False, False),
    ],
)
def test_eligible_hours(spark, program, hours, survey, ok):
    df = spark.createDataFrame([(program, hours)], "trainingprogram string, credithours string")
    assert tr.eligible_hours(df, survey=survey).first().hours_ok is ok


def test_feed_routes_every_valid_row_once(spark):
    t = spark.createDataFrame(
        [
            (1, 1, BT, "70", D(2023, 6, 2), "true"),
            (2, 1, BT, "70", D(2023, 6, 1), "true"),  # earlier: this one counts
            (3, 1, BT, "30", D(2023, 6, 1), "true"),  # hours do not fit
            (4, 2, BT, "70", D(2023, 6, 1), "true"),  # in production already
            (5, 3, BT, "70", D(2023, 6, 1), "true"),  # no requirement
            (6, 1, BT, "70", D(2023, 5, 1), "false"),  # not valid: left out
            (7, None, BT, "70", D(2023, 6, 1), "true"),
        ],
        TRANSFER,
    )
    p = spark.createDataFrame([(1, HIRED), (2, HIRED), (3, HIRED)], PERSON)
    r = spark.createDataFrame([(1, *BASIC), (2, *BASIC)], REQUIREMENT)
    h = spark.createDataFrame([(2, BT, 70.0), (None, BT, 70.0)], "personid bigint, trainingprogram string, transferhours double")
    routed = tr.feed_transfers(t, p, r, h, ["id"])
    assert rows(routed, "id", "route") == [
        (1, "duplicate"), (2, "staging"), (3, "rejected_hours"), (4, "in_history"), (5, "rule_error"), (7, "rule_error"),
    ]
    messages = {r.id: r.error_message for r in routed.collect()}
    assert messages[2] is None and messages[1] is None and messages[5] == M["no_requirement"]


def test_several_requirements_give_several_rows(spark):
    t = spark.createDataFrame([(1, 1, BT, "70", D(2023, 6, 2), "true"), (2, 1, BT, "70", D(2023, 6, 3), "true")], TRANSFER)
    p = spark.createDataFrame([(1, HIRED)], PERSON)
    r = spark.createDataFrame([(1, *BASIC), (1, *BASIC)], REQUIREMENT)
    h = spark.createDataFrame([], "personid bigint, trainingprogram string, transferhours double")
    # Only the transfer that is checked meets both requirements; the duplicate is logged once.
    assert rows(tr.feed_transfers(t, p, r, h, ["id"]), "id", "route") == [(1, "staging"), (1, "staging"), (2, "duplicate")]


def test_history_modes(spark):
    t = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "k int, v string")
    h = spark.createDataFrame([(1, "a")], "k int, v string")
    assert rows(tr.not_in_history(t, h, ["k", "v"])) == [(None, "c"), (2, "b")]
    assert rows(tr.not_in_history(t, h, ["k", "v"], mode="self")) == [(1, "a"), (2, "b")]


def test_course_titles(spark):
    data = [
        (1, " Basic Training 70 Hours (BT70)", "CE1"),
        (2, "Continuing Education (CE)", "#CE1"),
        (3, "Orientation & Safety (O&S) ", None),
        (4, "no marker", "NF2"),
        (5, "(CE) first", "plain"),
    ]
    df = spark.createDataFrame(data, "id int, course_name string, code_text string")
    catalog = spark.createDataFrame(
        [(BT, "201"), (BT, "201"), (CE, "300"), (CE, "603"), ("Orientation & Safety", "100")],
        "trainingprogramtype string, trainingprogramcode string",
    )
    assert rows(tr.clean_course(df, catalog), "id", "coursename_cleaned", "coursecode", "trainingprogramcode") == [
        (1, BT, "CE1", "201"),
        (2, CE, None, "300"),
        (3, "Orientation & Safety", None, "100"),
        (4, None, "NF2", None),
        (5, "(CE) first", None, None),
    ]


def test_survey_guards_all_programs(spark):
    """An unfinished or repeated response never reaches staging, whatever its program. A repeat is of the same class."""
    data = [
        (1, 1, f"{BT} (BT70)", "CE1", "70", D(2023, 6, 1), "False", "a"),
        (2, 2, f"{BT} (BT70)", "CE1", "70", D(2023, 6, 2), "True", "a"),
        (3, 2, f"{BT} (BT70)", "CE1", "70", D(2023, 6, 3), "True", "a"),
        (4, 3, "other", None, "70", D(2023, 6, 3), "True", "a"),
        (5, 2, f"{BT} (BT70)", "CE1", "70", D(2023, 6, 4), "True", "b"),
        (6, 2, f"{BT} (BT70)", "CE1", "50", D(2023, 6, 5), "True", "b"),
    ]
    survey = spark.createDataFrame(
        data,
        "id int, personid bigint, course_name string, code_text string, credithours string, completed_date date, finished string, "
        "continuing_education_information_1 string",
    )
    catalog = spark.createDataFrame([(BT, "201")], "trainingprogramtype string, trainingprogramcode string")
    p = spark.createDataFrame([(1, HIRED), (2, HIRED)], PERSON)
    r = spark.createDataFrame([(1, *BASIC), (2, *BASIC)], REQUIREMENT)
    h = spark.createDataFrame([], "personid bigint, trainingprogram string, transferhours double, coursecode string")
    routed = tr.survey_transfers(survey, catalog, p, r, h, ["id"])
    assert rows(routed, "id", "route") == [
        (1, "unfinished"), (2, "staging"), (3, "duplicate"), (4, "rejected_hours"), (5, "staging"), (6, "duplicate"),
    ]


def test_resolve_person(spark):
    df = spark.createDataFrame(
        [(1, 10, "Orientation & Safety"), (2, 10, BT), (3, 99, BT), (4, None, BT), (5, 10, None), (6, 10, "Orientation & Safety Attest")],
        "id int, ext bigint, program string",
    )
    person = spark.createDataFrame([(1, 10), (1, 10), (2, None)], "personid bigint, cdwaid bigint")
    routed = tr.resolve_person(df, person, "ext", "cdwaid", "program")
    assert rows(routed, "id", "route", "isvalid") == [
        (1, "safety", True), (2, "other", True), (3, "error", False), (4, "error", False), (5, "unknown_program", True), (6, "safety", True),
    ]

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from feedkit.plans import completions as c, extracts as x, feeds as f, reports as r

from .conftest import rows

D = dt.date


def test_family_of_course_ids(spark):
    ids = ["ABC1234ABC1234", "X+(1234567", "SHORT", "1234567", " crs V000001", None]
    df = spark.createDataFrame([(i,) for i in ids], "courseid string").coalesce(1)
    got = [row[0] for row in df.select(c.course_family("courseid")).collect()]
    assert got == ["ABC1234", "X+(", "", "", "crs", None]


HISTORY = "id int, personid bigint, courseid string, completeddate date"


def test_unique_completions(spark):
    history = spark.createDataFrame(
        [
            (1, 1, "FIRE0000001", D(2024, 2, 1)),
            (2, 1, "FIRE0000002", D(2024, 1, 1)),  # earliest of the family
            (3, 1, "CARE0000001", D(2024, 1, 1)),  # taken, in other letters
            (4, 2, "CARE0000001", D(2024, 1, 1)),
            (5, 2, None, D(2024, 1, 1)),
            (6, None, "FIRE0000001", D(2024, 1, 1)),
            (7, 3, "FIRE0000001", None),  # a missing date sorts first
            (8, 3, "FIRE0000009", D(2024, 1, 1)),
        ],
        HISTORY,
    )
    taken = spark.createDataFrame([(1, "care9999999"), (1, "care8888888"), (None, "FIRE0000001")], "personid bigint, courseid string")
    out = c.unique_completions(history, taken, ["id"])
    assert rows(out, "id", "route") == [
        (1, "duplicate"), (2, "unique"), (3, "in_transcript"), (4, "unique"), (5, "no_course"), (6, "no_person"), (7, "unique"), (8, "duplicate"),
    ]


def test_validate_completions(spark):
    df = spark.createDataFrame(
        [
            (1, " 5 ", " LEE", "A@x.org ", "K", D(2024, 2, 1)),
            (2, "5", "lee", "a@x.org", "K", D(2024, 1, 1)),
            (3, "5", "lee", "other@x.org", "K", D(2023, 1, 1)),
            (4, "5", None, "a@x.org", "K", D(2023, 1, 1)),
            (5, "6", "Ray", "alt@x.org", "K", D(2023, 1, 1)),
            (6, "7", "Nix", None, "K", D(2023, 1, 1)),
        ],
        "id int, learner_id string, last_name string, learner_email string, class_title string, date date",
    )
    person = spark.createDataFrame(
        [(5, "Lee", "a@x.org", None), (5, "Lee", "a@x.org", None), (6, "Ray", None, "ALT@x.org"), (7, "Nix", None, None)],
        "personid bigint, lastname string, email1 string, email2 string",
    )
    out = c.validate_completions(df, person, ["id"])
    # The learner id is compared trimmed but grouped as given.
    assert rows(out, "id", "route") == [(1, "valid"), (2, "valid"), (3, "unmatched"), (4, "unmatched"), (5, "valid"), (6, "unmatched")]


CATALOG = "coursename string, courselanguage string, trainingprogramcode string, coursetype string, courseid string"


def test_preferred_courses_and_instructors(spark):
    catalog = spark.createDataFrame(
        [("A", "EN", "1", "ONL", "a1"), ("A", "EN", "1", "ILT", "a2"), ("A", "ES", "1", "ONL", "a3"), ("A", "EN", "2", "ONL", "a4")], CATALOG
    )
    assert rows(c.preferred_courses(catalog), "courseid") == [("a2",), ("a3",), ("a4",)]
    people = spark.createDataFrame(
        [(" Ann ", " Lee ", "1", "true"), ("Ann", "Lee", "1", "true"), ("Bo", "Ray", "2", "false")],
        "firstname string, lastname string, instructorid string, isactive string",
    )
    assert rows(c.active_instructors(people)) == [("Ann Lee", "1")]


def test_enrich_keeps_unmatched(spark):
    done = spark.createDataFrame([("5", " basics ", D(2024, 1, 1), "ANN lee "), ("5", "other", D(2024, 1, 1), None)], "learner_id string, class_title string, completiondate date, instructor string")
    catalog = spark.createDataFrame([("Basics ", "EN", "1", "ILT", "a2")], CATALOG)
    teachers = spark.createDataFrame([("Ann Lee", "I1")], "instructorname string, instructorid string")
    out = c.enrich_completions(done, catalog, teachers, "LMS")
    assert rows(out, "class_title", "courseid", "instructorid", "trainingsource") == [(" basics ", "a2", "I1", "LMS"), ("other", None, None, "LMS")]
    spanish = done.withColumn("class_title", F.lit("BASICS en"))
    assert c.enrich_completions(spanish, catalog, teachers, "S", with_language=True).filter("courseid = 'a2'").count() == 2


def test_newest_sheet(spark):
    df = spark.createDataFrame(
        [
            ("5", "K", D(2024, 1, 5), "Attended", "s-20240101"),
            ("5", "K", D(2024, 1, 9), "Attended", "s-20240201"),
            ("5", "K", D(2024, 1, 7), "Attended", "s-20240201"),
            ("5", "K", D(2024, 1, 1), "Absent", "s-20240301"),
            ("6", "K", D(2024, 1, 1), "Attended", "nodate"),
        ],
        "learner_id string, class_title string, date date, attendance string, sheet_name string",
    )
    assert rows(c.newest_sheet(df), "learner_id", "date", "sheetdate") == [("5", D(2024, 1, 7), D(2024, 2, 1)), ("6", D(2024, 1, 1), None)]


def test_safety_forms(spark):
    person = spark.createDataFrame([(1, 5), (5, 9), (7, None), (8, 8)], "personid bigint, dshsid bigint")
    forms = spark.createDataFrame(
        [
            (1, "5", "01/02/2024", "1", "true", 1),
            (2, "5", "2024-01-03", "1", "true", 2),  # newest submission
            (3, "7", "01022024", "1", "true", 1),
            (4, "8", "01-02-2024", "1", "true", 1),
            (5, "9", "01-02-2024", "0", "true", 1),
            (6, "x", "01-02-2024", "1", "true", 1),
            (7, "5", "01/09/2024", "1", "false", 9),
        ],
        "id int, form_id string, completion_date string, finished string, isdelta string, filemodifieddate int",
    )
    one = c.safety_from_form(forms, person, ["dshsid"], "FORM", ["id"])
    assert rows(one, "personid", "completeddate") == [(1, D(2024, 1, 3)), (8, D(2024, 1, 2))]
    both = c.safety_from_form(forms, person, ["personid", "dshsid"], "FORM", ["id"])
    # Form id 5 is person 5 and the external id of person 1; person 8 is found both ways and counts once; 7 lacks an id.
    assert rows(both, "personid", "completeddate") == [(1, D(2024, 1, 3)), (5, D(2024, 1, 3)), (8, D(2024, 1, 2))]
    assert one.first().courseid == "1000065ONLEN02" and one.first().trainingprogramcode == 100


def test_safety_transfers_conserve_rows(spark):
    person = spark.createDataFrame([(1, 10), (2, None), (3, 30)], "personid bigint, cdwaid bigint")
    need = spark.createDataFrame([(1, "100", "active"), (1, "100", "active"), (2, "100", "active"), (3, "100", "closed")], "personid bigint, trainingprogramcode string, status string")
    df = spark.createDataFrame(
        [(1, 1, "S", D(2024, 1, 2), "true"), (2, 1, "S", D(2024, 1, 1), "true"), (3, 2, "S", D(2024, 1, 1), "true"), (4, 3, "S", D(2024, 1, 1), "true"), (5, 1, "T", None, "true")],
        "id int, personid bigint, trainingprogram string, completeddate date, isvalid string",
    )
    out = c.safety_from_transfers(df, person, need, ["id"], "FEED")
    assert rows(out, "id", "route") == [(1, "log"), (2, "history"), (3, "log"), (4, "log"), (5, "history")]


def test_clean_completions(spark):
    lms = spark.createDataFrame(
        [
            ("5", "K", "2024-01-02", "1/2/2024", "Passed", 1),
            ("5", "K", "2024-01-03", "1/2/2024", "Passed", 2),
            ("x5", "K", "2024-01-03", "", "Passed", 3),
            ("6", "", "2024-01-03", "", "Passed", 4),
            ("7", "K", "", "", "Passed", 5),
            ("8", "K", "2024-01-03", "", "Failed", 6),
        ],
        ["BG Person ID", "Course Title", "Completion Date", "Registration Date", "Status", "n"],
    )
    out = c.clean_lms_completions(lms, ["n"])
    assert [(r["BG Person ID"], str(r["Completion Date"]), str(r["Registration Date"])) for r in out.collect()] == [("5", "2024-01-02 00:00:00", "2024-01-02 00:00:00")]
    sheet = spark.createDataFrame(
        [
            ("5", "K", "T", "01/02/24", "Attended", "O'Neil", "01/01/24", 1),
            ("5", "K", "T", "01/03/24", "Attended", "O'Neil", "01/01/24", 2),
            ("1234567890123", "K", "T", "01/02/24", "Attended", "x", "", 3),
            ("6", "K", "T", "", "Attended", "x", "", 4),
        ],
        ["learner id", "class id", "class title", "date", "attendance", "instructor", "when enrolled", "n"],
    )
    got = c.clean_sheet_completions(sheet, ["n"], as_of="2024-06-30")
    assert [(r["learner id"], r["date"], r["instructor"], r["when enrolled"]) for r in got.collect()] == [("5", D(2024, 1, 2), "O’Neil", D(2024, 1, 1))]


# ---- extracts and reports

REQUIREMENT = "personid bigint, trainingid int, trainingprogramcode string, trackingdate date, duedate date, completeddate date, earnedhours double"


def student_kinds(spark, basic):
    """For which extract kinds does a person with this newest 70-hour training come out?"""
    person = spark.createDataFrame(
        [(1, "Lee", "Ann", "123456789", D(1980, 1, 2), "1 oak", "x", "wa", "98000", "1206", "Active", "c")],
        "personid bigint, lastname string, firstname string, ssn string, dob date, mailingstreet1 string, mailingcity string, "
        "mailingstate string, mailingzip string, mobilephone string, status string, credentialnumber string",
    )
    requirement = spark.createDataFrame([(1, 1, "100", D(2024, 1, 1), D(2024, 2, 1), D(2024, 1, 15), 5.0), *basic], REQUIREMENT)
    transcript = spark.createDataFrame(
        [(1, "201", "I1", "Old", D(2020, 1, 1)), (1, "201", "I2", "New", D(2024, 1, 1)), (1, "300", "I3", "Else", D(2025, 1, 1))],
        "personid bigint, trainingprogramcode string, instructorid string, instructorname string, completeddate date",
    )
    employers = spark.createDataFrame([(1, "A,B")], "personid bigint, activeemployers string")
    numbers = spark.createDataFrame([("HM1", 1), ("HM1", 1), (None, 1)], "credentialnumber string, personid bigint")
    pending = spark.createDataFrame([("HM1",)], "credentialnumber string")
    out = {}
    for kind in ("open", "completed"):
        got = x.student_extract(person, employers, requirement, transcript, numbers, pending, kind).collect()
        if got:
            out[kind] = got
    return out


def test_student_kinds(spark):
    def basic(i, due, done, hours):
        return (1, i, "201", D(2023, 1, 1), due, done, hours)

    due = D(2023, 6, 1)
    assert set(student_kinds(spark, [basic(2, due, None, 10.0)])) == {"open"}
    late = student_kinds(spark, [basic(2, due, D(2023, 7, 1), 70.0)])
    assert set(late) == {"open"} and late["open"][0].btinstructorid == "I2"
    on_time = student_kinds(spark, [basic(2, due, due, 70.0)])
    assert set(on_time) == {"completed"}
    row = on_time["completed"][0]
    assert (row.ssn, row.birthdate, row.mailingcity, row.btduedate, row.osearnedhours) == ("6789", "01/02/1980", "X", "06/01/2023", 5)
    assert set(student_kinds(spark, [basic(2, due, D(2023, 7, 1), 35.0)])) == set()
    assert set(student_kinds(spark, [(1, 2, "201", D(2013, 8, 31), due, None, 0.0)])) == set()
    opened = student_kinds(spark, [basic(2, due, None, None)])["open"][0]
    assert (opened.btearnedhours, opened.btinstructorid, opened.btcompleted) == (0.0, None, None)


def test_credentials_and_employers(spark):
    credentials = spark.createDataFrame(
        [("a", "hm", "Pending", 1), ("b", "HM", "PENDING", 1), ("c", "HM", "Active", 1), ("d", "NA", "Pending", 1), ("e", "HM", "Pending", 0), (None, "HM", "Pending", 1)],
        "credentialnumber string, credentialtype string, credentialstatus string, primarycredential int",
    )
    reported = spark.createDataFrame([("b",), (None,)], "credentialnumber string")
    # A missing number among the reported ones does not empty the list.
    assert rows(x.pending_credentials(credentials, reported), "credentialnumber") == [(None,), ("a",)]
    relations = spark.createDataFrame([(1, "10", "active"), (1, "11", "ACTIVE"), (1, "11", "active"), (1, "12", "active"), (2, "10", "closed"), (3, "x", "active")], "personid bigint, employerid string, empstatus string")
    employers = spark.createDataFrame([(10, "Zed"), (11, "Alp"), (12, "Out")], "employerid bigint, employername string")
    trusts = spark.createDataFrame([(10, "tp"), (11, "TP"), (11, "TP"), (12, "no")], "employerid bigint, trust string")
    assert rows(x.active_employers(relations, employers, trusts, "tp")) == [(1, "Alp,Zed")]


def test_error_export_name(spark):
    loaded = spark.createDataFrame([("in-1.csv", 1), ("in-2.csv", 2), ("in-2.csv", 2)], "filename string, filemodifieddate int")
    out = x.error_export_rows(spark.range(2), loaded)
    assert rows(out) == [(0, "in-2-error.csv"), (1, "in-2-error.csv")]


def test_report_roundtrip(spark):
    df = spark.createDataFrame(
        [(" Lee ", "HMC. 00012345.X", "", "01/02/2024", "I9  Ann Lee", "Classified File 20240630101500.csv"), ("Ray", "HMC.00000001", "Open", "x", "I9", "other.csv")],
        "filelastname string, credential string, credentialstatus string, applicationdate string, who string, filename string",
    )
    loaded = r.load_report(df, "credential", "Classified File ")
    assert rows(loaded, "filelastname", "credentialnumber", "credentialstatus") == [("Lee", "00012345X", None), ("Ray", "0000001", "Open")]
    target = spark.createDataFrame([("0000001",), (None,)], "credentialnumber string")
    final = r.finalize_report(loaded, target, "Classified File ", instructor="who")
    assert rows(final, "applicationdate", "reportdate", "approvedinstructorcode", "approvedinstructorname") == [
        (D(2024, 1, 2), D(2024, 6, 30), "I9", "Ann Lee")
    ]


def test_feed_loaders(spark):
    df = spark.createDataFrame([("5", "123456789", "moves 06302024.csv", "")], ["Person ID", "ssn", "filename", "Sub Category"])
    out = r.load_transition(df, "moves ").first()
    assert (out.personid, out.ssn, out.subcategory, str(out.filedate)) == ("5", "6789", None, "2024-06-30 00:00:00")
    rel = spark.createDataFrame([("x", "99999999999", "1.239", "rel_20240630_101500.TXT")], ["provider id", "student id", "cumulative career hours", "filename"])
    got = r.load_feed(rel, r.RELATIONSHIP, "rel_", "yyyyMMdd_HHmmss", "filemodifieddate").first()
    assert (got.provider_id, got.student_id, str(got.cumulative_career_hours), str(got.filemodifieddate)) == (None, 99999999999, "1.24", "2024-06-30 10:15:00")


def test_feed_names_follow_headings():
    named = {source: target for source, _, target, _ in f.PROVIDER}
    assert (named["i&e date"], named["o&s completed"], named["mailing add 1"], named["person id"]) == ("ie_date", "os_completed", "mailing_add_1", "personid")
    assert {t for _, _, t, _ in f.TRANSFER} >= {"employeeid", "dshscoursecode", "reasonfortransfer", "createddate"}
    survey = {source: (target, kind) for source, _, target, kind in f.TRANSFER_SURVEY}
    assert survey["Duration (in seconds)"] == ("duration_in_seconds", "string") and survey["id"] == ("personid", "bigint")
    assert [t for s, _, t, _ in f.INTAKE if s == "Q3"] == ["cg_status", "person_emp_status"]
    assert len({t for _, _, t, _ in f.LMS}) == len(f.LMS) == 22

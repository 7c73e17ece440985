from __future__ import annotations

import datetime as dt

from feedkit.functions.hashing import reveal_column
from feedkit.plans import people as p

from .conftest import rows

D = dt.date
AS_OF = "2024-06-30"
FORM_COLUMNS = (
    ["responseid", "cg_status", "isdelta", "terminated_person_id", "person_termination_date", "person_hire_date"]
    + ["employername", "preferredlanguage", "userlanguage", "exempt"]
    + sorted({c for pair in p.FORM_PAIRS.values() for c in pair})
)


def form(spark, *overrides):
    """Form rows: a good new hire, changed by the given values."""
    base = dict.fromkeys(FORM_COLUMNS) | {
        "responseid": "R0", "cg_status": "1", "isdelta": "true", "person_hire_date": "01/02/2024", "employername": "1",
        "preferredlanguage": "2", "exempt": "1", "newhire_person_firstname": "Ann", "newhire_person_lastname": "Lee",
        "newhire_person_ssn": "12", "newhire_person_dob": "03/04/85", "newhire_person_phone1": "(206) 555-1234",
        "newhire_person_email1": "a@b.org", "newhire_person_street": "1 Oak", "newhire_person_city": "X",
        "newhire_person_state": "WA", "newhire_person_zipcode": "98000",
    }
    data = [base | {"responseid": f"R{i}"} | o for i, o in enumerate(overrides)]
    schema = ", ".join(f"{c} string" for c in FORM_COLUMNS)
    df = spark.createDataFrame([tuple(r[c] for c in FORM_COLUMNS) for r in data], schema)
    return df.selectExpr("*", "DATE '2024-06-01' AS filemodifieddate")


TERMINATED = {
    "cg_status": "2", "terminated_person_id": "7", "person_termination_date": "02/01/2024", "terminated_person_firstname": "Bo",
    "terminated_person_lastname": "Ray", "terminated_person_dob": "01/01/1970", "terminated_person_ssn": "0099",
}


def test_person_form_keeps_what_it_should(spark):
    cases = {
        "kept": {},
        "terminated": TERMINATED,
        "old row": {"isdelta": "false"},
        "no hire date": {"person_hire_date": "soon"},
        "unknown agency": {"employername": "99"},
        "bad mobile": {"newhire_person_phone1": "none"},
        "bad home phone": {"newhire_person_phone2": "none"},
        "bad mail": {"newhire_person_email1": "a b"},
        "child": {"newhire_person_dob": "01/01/2015"},
        "no birth date": {"newhire_person_dob": "02/30/1980"},
        "no status": {"cg_status": None},
        "terminated without id": TERMINATED | {"terminated_person_id": None},
        "terminated without date": TERMINATED | {"person_termination_date": None},
    }
    df = form(spark, *[{"userlanguage": k, **v} for k, v in cases.items()])
    out = {r.language: r for r in p.standardize_person_form(df, as_of=AS_OF).collect()}
    assert set(out) == {"kept", "terminated"}
    kept = out["kept"]
    assert (kept.firstname, kept.ssn, kept.dob, kept.status, kept.exempt) == ("Ann", "0012", "1985-03-04", "Active", "true")
    assert (kept.mobilephone, kept.homephone, kept.preferred_language) == ("12065551234", None, "Amharic")
    assert kept.mailingaddress == "1 Oak, X, WA, 98000"
    assert kept.sourcekey.startswith("branch390-") and len(kept.sourcekey) == len("branch390-") + 10
    assert out["terminated"].agencyid == 7 and out["terminated"].status == "Terminated"


def test_agency_codes_are_the_callers(spark):
    codes = p.AgencyCodes(employers={"1": "E1"}, branches={"E1": 5}, languages={"2": "Two"}, labels={5: "North"})
    out = p.standardize_person_form(form(spark, {}, {"employername": "2"}), codes, as_of=AS_OF).collect()
    assert len(out) == 1 and out[0].sourcekey.startswith("North-") and out[0].preferred_language == "Two"


def test_employment_rows(spark):
    df = form(spark, {}, TERMINATED, {"newhire_person_firstname": None}, {"person_hire_date": "2024-01-02"}, {"employername": "9"})
    out = p.employment_rows(df, as_of=AS_OF)
    assert rows(out, "empstatus", "employerid", "branchid", "authstart", "authend") == [
        ("Active", "102", 390, "2024-01-02", None),
        ("Active", "102", 390, "2024-01-02", None),
        ("Terminated", "102", 390, "2024-01-02", "2024-02-01"),
    ]


def test_same_person_gets_one_key_in_both_tables(spark):
    df = form(spark, {}, TERMINATED)
    person = p.standardize_person_form(df, as_of=AS_OF).selectExpr("sourcekey").distinct()
    assert rows(person) == rows(p.employment_rows(df, as_of=AS_OF).selectExpr("source").distinct())


PERSON = "personid bigint, firstname string, lastname string, ssn string, dob date, email1 string, email2 string"


def test_match_terminated_routes_every_row(spark):
    person = spark.createDataFrame([(7, "BO", "Other", "0099", D(1960, 1, 1), None, "bo@x.org")], PERSON)
    cases = {
        "new hire": {},
        "new hire with an id": {"terminated_person_id": "7"},
        "name and ssn": TERMINATED,
        "short ssn": TERMINATED | {"terminated_person_ssn": "99"},
        "unknown id": TERMINATED | {"terminated_person_id": "8"},
        "no id": TERMINATED | {"terminated_person_id": None},
        "no status": {"cg_status": None},
    }
    df = form(spark, *[{"userlanguage": k, **v} for k, v in cases.items()])
    out = p.match_terminated(df, person)
    assert out.count() == len(cases)
    routes = {r.userlanguage: r.route for r in out.collect()}
    assert {k for k, v in routes.items() if v == "clean"} == {"new hire", "new hire with an id", "name and ssn", "short ssn"}


def test_match_terminated_needs_name_and_proof(spark):
    person = spark.createDataFrame([(7, "Bo", "Ray", "1111", D(1970, 1, 1), None, "bo@x.org")], PERSON)

    def verdict(**change):
        return p.match_terminated(form(spark, TERMINATED | change), person).first().route

    assert verdict() == "clean"  # name and date of birth
    assert verdict(terminated_person_dob="01/02/1970") == "error"  # name only
    assert verdict(terminated_person_dob=None, terminated_person_email="bo@x.org") == "clean"
    assert verdict(terminated_person_firstname="X", terminated_person_lastname="RAY") == "clean"
    assert verdict(terminated_person_firstname="X", terminated_person_lastname="Y") == "error"


def test_identity_conflicts(spark):
    df = spark.createDataFrame(
        [(1, "111111111"), (1, "999999999"), (2, "222222222"), (3, "12345"), (4, None), (5, "1234567890"), (6, "1234567")],
        "personid bigint, ssn string",
    )
    crosswalk = spark.createDataFrame([("111111111", 1), ("999999999", 8), ("222222222", 2), ("12345", 3)], "ssn string, cdwaid bigint")
    out = p.identity_conflicts(df, crosswalk)
    assert out.count() == df.count()
    assert rows(out, "personid", "route") == [
        (1, "duplicate_ssn"), (1, "duplicate_ssn"), (2, "ok"), (3, "bad_length"), (4, "ok"), (5, "bad_length"), (6, "ok"),
    ]


def test_extend_crosswalk_is_idempotent(spark):
    key = "0123456789abcdef"
    df = spark.createDataFrame(
        [("1", "s1", "ok"), ("1", "s1", "ok"), ("2", "s2", "ok"), ("3", None, "ok"), ("4", "s4", "duplicate_ssn"), ("5", "s5", "bad_length")],
        "personid string, ssn string, route string",
    )
    known = spark.createDataFrame([(2,)], "cdwaid bigint")
    new = p.extend_crosswalk(df, known, key)
    assert rows(reveal_column(new, "fullssn", key), "cdwaid", "fullssn") == [(1, "s1")]
    assert p.extend_crosswalk(df, known.union(new.select("cdwaid")), key).count() == 0


def test_feed_person(spark):
    columns = (
        "personid ssn isvalid first_name middle_name last_name dob email phone_1 phone_2 language employee_classification exempt_status "
        "ahcas_eligible carina_eligible hire_date classification_start_date background_check_date ie_date employee_id physical_add_1 physical_city "
        "physical_state physical_zip mailing_add_1 mailing_add_2 mailing_city mailing_state mailing_zip filename"
    ).split()
    good = dict.fromkeys(columns) | {
        "personid": "5", "ssn": "12", "isvalid": "true", "dob": "19700101", "phone_1": "555-1234", "phone_2": "206-555-1234",
        "exempt_status": "Yes", "hire_date": "20200102", "employee_id": "900000001", "filename": "P-2024-06-30.csv",
    }
    cases = [good, good | {"isvalid": "false"}, good | {"dob": "20200101"}, good | {"dob": "19000505", "personid": "6"}, good | {"dob": "x"}]
    df = spark.createDataFrame([tuple(c[n] for n in columns) for c in cases], ", ".join(f"{c} string" for c in columns))
    out = p.standardize_person_feed(df, "FEED", "P-", as_of=AS_OF)
    assert rows(out, "sourcekey", "ssn", "mobilephone", "homephone", "exempt", "ahcas_eligible") == [
        ("FEED-5", "0012", None, "12065551234", "true", False),
        ("FEED-6", "0012", None, "12065551234", "true", False),
    ]
    assert {str(r.filemodifieddate) for r in out.collect()} == {"2024-06-30"}


def test_provider_text(spark):
    df = spark.createDataFrame([(' "a\r\nb" ', "wash", "or"), ("\n", None, "x")], "client_id string, mailing_state string, physical_state string")
    assert rows(p.clean_provider_rows(df)) == [(None, None, "X"), ("ab", "WA", "OR")]

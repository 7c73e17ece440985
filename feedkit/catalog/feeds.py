"""Raw loads of whole feeds: rows under the feed's headings in, typed and routed rows out."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.hashing import reveal_column
from ..plans import feeds as f, transfers as tr
from ..plans.people import extend_crosswalk
from .jobs import _KEYS, _MATCHED, LMS_HEADINGS, NEW_PAIRS_SQL
from .registry import Tables, query, with_inputs
from .scalars import AS_OF, CHECK_KEY


def _headed(df: DataFrame, mapping) -> DataFrame:
    """Rename table columns back to the headings of their feed."""
    return df.withColumnsRenamed({target: heading for heading, _, target, _ in mapping if target != "person_emp_status"})


@query(
    "load_intake",
    with_inputs(
        ["person", "intake_form"],
        f", {_MATCHED} SELECT responseid, cg_status, newhire_person_lastname, nullif(person_hire_date, '') AS person_hire_date, employername, "
        "'Intake20240630101500.csv' AS filename, strftime(TIMESTAMP '2024-06-30 10:15:00', '%Y-%m-%d %H:%M:%S') AS loaded, "
        "CASE WHEN cg_status = '1' OR (cg_status = '2' AND terminated_person_id IN (SELECT terminated_person_id FROM matched)) THEN 'clean' ELSE 'error' END AS route, "
        "NOT (responseid IN (SELECT 'R_' || (o_orderkey + 1) FROM orders)) AS isdelta FROM intake_form",
    ),
)
def load_intake(t: Tables):
    raw = _headed(t.input("intake_form").drop("isdelta", "filemodifieddate"), f.INTAKE).withColumn(
        "filename", F.lit("Intake20240630101500.csv")
    )
    previous = t.orders.select(F.concat(F.lit("R_"), (F.col("o_orderkey") + 1).cast("string"), F.lit(" ")).alias("responseid"))
    out = f.load_intake(raw, t.input("person"), previous, "Intake")
    return out.select(
        "responseid", "cg_status", "newhire_person_lastname", "person_hire_date", "employername", "filename",
        F.date_format("filemodifieddate", "yyyy-MM-dd HH:mm:ss").alias("loaded"), "route", "isdelta",
    )


@query(
    "load_safety_form",
    with_inputs(
        ["safety_form"],
        "SELECT 'S' || o_orderkey AS responseid, form_id AS dshs_id, completion_date AS os_completion_date, finished, "
        "o_orderpriority = '1-URGENT' AS isdelta FROM safety_form",
    ),
)
def load_safety_form(t: Tables):
    raw = t.input("safety_form").select(
        F.concat(F.lit("S"), F.col("o_orderkey").cast("string")).alias("ResponseId"),
        F.col("form_id").alias("Q5_5"),
        F.col("completion_date").alias("Q13"),
        F.col("finished").alias("Finished"),
        F.lit("Safety20240630101500.csv").alias("filename"),
    )
    previous = t.orders.filter("o_orderpriority <> '1-URGENT'").select(F.expr("concat('S', o_orderkey)").alias("responseid"))
    out = f.load_safety_form(raw, previous, "Safety")
    return out.select("responseid", "dshs_id", "os_completion_date", "finished", "isdelta")


@query(
    "load_transfer_survey",
    with_inputs(
        ["survey"],
        "SELECT 'T' || event_id AS responseid, personid, course_name, credithours, finished, event_type = 'click' AS isdelta, DATE '2024-06-30' AS loaded FROM survey",
    ),
)
def load_transfer_survey(t: Tables):
    raw = t.input("survey").select(
        F.concat(F.lit("T"), F.col("event_id").cast("string")).alias("ResponseId"),
        F.col("personid").cast("string").alias("id"),
        F.col("course_name").alias("vertical"),
        F.col("credithours").alias("hours"),
        F.col("finished").alias("Finished"),
        F.lit("transfers2024-06-30.csv").alias("filename"),
    )
    previous = t.events.filter("event_type <> 'click'").select(F.expr("concat('T', event_id, ' ')").alias("responseid"))
    out = f.load_transfer_survey(raw, previous, "transfers")
    return out.select(
        "responseid", "personid", "course_name", "credithours", "finished", "isdelta",
        F.col("filemodifieddate").cast("date").alias("loaded"),
    )


@query(
    "load_provider",
    with_inputs(
        ["provider", "crosswalk"],
        ", bad AS (SELECT DISTINCT p.personid FROM provider p JOIN crosswalk x ON p.ssn = x.ssn WHERE CAST(p.personid AS BIGINT) <> x.cdwaid) "
        "SELECT try_cast(employee_id AS BIGINT) AS employee_id, personid, first_name, middle_name, right(CASE WHEN length(ssn) < 9 THEN lpad(ssn, 9, '0') "
        "ELSE ssn END, 4) AS ssn, try_cast(dob AS INTEGER) AS dob, try_cast(ie_date AS INTEGER) AS ie_date, "
        "nullif(trim(client_id), '') AS client_id, left(upper(mailing_state), 2) AS mailing_state, filemodifieddate, "
        "CASE WHEN personid IN (SELECT personid FROM bad) THEN 'duplicate_ssn' WHEN length(ssn) < 7 OR length(ssn) > 9 THEN 'bad_length' ELSE 'ok' END AS route FROM provider",
    ),
)
def load_provider(t: Tables):
    rows = t.input("provider").drop("o_orderkey", "isvalid", "filemodifieddate")
    raw = _headed(rows, f.PROVIDER).withColumnRenamed("Client ID", ' "Client ID" ')
    out = f.load_provider(raw, t.input("crosswalk"), "providers-")
    return out.select(
        "employee_id", "personid", "first_name", "middle_name", "ssn", "dob", "ie_date", "client_id", "mailing_state",
        "filemodifieddate", "route",
    )


@query("provider_flow", with_inputs(["provider", "crosswalk", "known_crosswalk"], NEW_PAIRS_SQL))
def provider_flow(t: Tables):
    # One routed frame gives the new pairs, whole ids protected, before the rows are masked.
    rows = t.input("provider").drop("o_orderkey", "isvalid", "filemodifieddate")
    routed = f.route_provider(_headed(rows, f.PROVIDER), t.input("crosswalk"), "providers-")
    known = t.input("known_crosswalk").filter("segment <> 'BUILDING'")
    return reveal_column(extend_crosswalk(routed, known, CHECK_KEY), "fullssn", CHECK_KEY, to="revealed").select("cdwaid", "revealed")


@query(
    "load_transfers",
    with_inputs(
        ["transfer", "person"],
        "SELECT employeeid, coalesce(q.personid, t.personid + 500000) AS personid, trainingprogram, classname, credithours, completeddate, "
        "CAST(substr(filename, 11, 10) AS DATE) AS filedate, CASE WHEN q.personid IS NULL THEN 'error' "
        "WHEN trainingprogram = 'Orientation & Safety' THEN 'safety' ELSE 'other' END AS route, "
        f"CASE WHEN q.personid IS NULL THEN '{tr.MESSAGES['unmapped']}' END AS error_message FROM transfer t "
        "LEFT JOIN (SELECT DISTINCT personid, cdwaid FROM person) q ON t.personid + 500000 = q.cdwaid",
    ),
)
def load_transfers(t: Tables):
    raw = t.input("transfer").select(
        F.col("employeeid").cast("string").alias("Employee Id"),
        (F.col("personid") + 500000).cast("string").alias("Person ID"),
        F.col("trainingprogram").alias("training program"),
        F.col("classname").alias("Class Name"),
        F.col("credithours").alias("Credit Hours"),
        F.date_format("completeddate", "yyyyMMdd").alias("Completed Date"),
        F.lit("x").alias("CreatedDate"),
        "filename",
    )
    out = f.load_transfers(raw, t.input("person"), "transfers-")
    return out.select(
        "employeeid", "personid", "trainingprogram", "classname", "credithours", "completeddate", "filedate", "route", "error_message"
    )


@query(
    "load_lms",
    with_inputs(
        ["lms"],
        "SELECT person_id AS learner_id, 'Offer ' AS class_title, course_title AS class_id, CAST(NULL AS DATE) AS date, "
        "CAST(try_strptime(registration_date, '%m/%d/%Y') AS DATE) AS when_enrolled FROM (SELECT *, row_number() OVER "
        "(PARTITION BY person_id, course_title ORDER BY completion_date DESC, l_orderkey, l_linenumber, l_partkey, l_suppkey, status) AS rn FROM lms) "
        "WHERE rn = 1 AND regexp_matches(person_id, '^[0-9]+$') AND course_title <> '' AND completion_date <> '' AND status = 'Passed'",
    ),
)
def load_lms(t: Tables):
    raw = t.input("lms").withColumnsRenamed(LMS_HEADINGS)
    given = {"Offering Title": "Offer (EN)", "Student Last Name": "Lee", "Student First Name": "Ann", "Student Email": "", "Completed Date": "soon", "Phone Number": ""}
    raw = raw.withColumns({k: F.lit(v) for k, v in given.items()})
    loaded = f.load_lms(raw, [F.col("Completion Date").desc(), *_KEYS, "Status"])
    return f.completions_of(loaded).select("learner_id", "class_title", "class_id", "date", "when_enrolled")


_CLEAN_SHEET = (
    "SELECT learner_id, class_id, attendance, CAST(try_strptime(date_text, '%m/%d/%Y') AS DATE) AS date, "
    "replace(instructor, '''', '’') AS instructor, sheet_name FROM (SELECT *, row_number() OVER (PARTITION BY learner_id, class_id "
    "ORDER BY date_text DESC, l_orderkey, l_linenumber, l_partkey, l_suppkey, attendance) AS rn FROM {rows}) "
    "WHERE rn = 1 AND regexp_matches(learner_id, '^[0-9]+$') AND length(learner_id) <= 12 AND date_text <> ''"
)


@query(
    "load_sheet",
    with_inputs(
        ["sheet"],
        f", clean AS ({_CLEAN_SHEET.format(rows='sheet')}), "
        f"prev AS ({_CLEAN_SHEET.format(rows="(SELECT * FROM sheet WHERE l_linestatus = 'F')")}) "
        "SELECT DISTINCT learner_id, class_id, date, instructor, sheet_name, NOT EXISTS (SELECT 1 FROM prev p WHERE p.learner_id = c.learner_id "
        "AND p.class_id = c.class_id AND p.date = c.date AND p.instructor = c.instructor AND p.sheet_name = c.sheet_name "
        "AND p.attendance = c.attendance) AS isdelta FROM clean c",
    ),
)
def load_sheet(t: Tables):
    named = {s.replace(" ", "_"): s for s in f.SHEET_HEADINGS}
    rows = t.input("sheet").drop("date").withColumnRenamed("date_text", "date")
    extra = {"first name": "Ann", "last name": "Lee", "phone number": "1", "learner email": "a@b.org", "duration": "1.5", "when enrolled": "01/02/23"}
    raw = rows.withColumnsRenamed(named).withColumns({k: F.lit(v) for k, v in extra.items()})
    order = [F.col("date").desc(), *_KEYS, "attendance"]
    # The last snapshot is what the closed lines gave.
    known = raw.filter("l_linestatus = 'F'")
    nothing = t.orders.limit(0).selectExpr(*[f"CAST(NULL AS STRING) AS {c}" for c in f.SHEET_COLUMNS])
    previous = f.load_sheet(known, nothing, order, AS_OF).drop("isdelta")
    out = f.load_sheet(raw, previous, order, AS_OF)
    return out.select("learner_id", "class_id", "date", "instructor", "sheet_name", "isdelta")

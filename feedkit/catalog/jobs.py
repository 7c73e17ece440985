"""Composite jobs on the derived inputs, each against an independent SQL statement of its rules."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions import dates, hashing
from ..operators import delta, mapping as m
from ..operators.ranking import keep_first
from ..plans import completions as c, extracts as x, feeds, people as p, reports as r, transfers as tr
from ..session import scratch_dir
from ..snapshots import read_snapshot
from ..sinks.exports import export_delimited, export_ordered_file, name_parts, with_export_name
from ..sinks.tables import append
from ..sources.files import read_delimited, skip_preamble, with_file_name
from ..sources.tables import read_table
from .inputs import ORDER_DAY, compact_date
from .registry import Tables, query, with_inputs
from .scalars import AS_OF, CHECK_KEY

# ---- change detection

CUR = [
    "CASE WHEN o_orderkey % 101 = 0 THEN NULL WHEN o_orderkey % 2 = 0 THEN ' R' || o_orderkey || ' ' ELSE 'R' || o_orderkey END AS responseid",
    "o_custkey AS custkey",
    "CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_orderpriority END AS priority",
    "o_orderstatus AS status",
]
PREV = [
    "CASE WHEN o_orderkey % 3 = 0 AND o_orderkey % 9 <> 0 THEN NULL ELSE 'R' || o_orderkey END AS responseid",
    "CASE WHEN o_orderkey % 7 = 0 THEN o_custkey + 1 ELSE o_custkey END AS custkey",
    "CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_orderpriority END AS priority",
    "o_orderstatus AS status",
]
CUR_SQL = f"(SELECT {', '.join(CUR)} FROM orders)"
PREV_SQL = f"(SELECT {', '.join(PREV)} FROM orders WHERE o_orderpriority <> '1-URGENT')"
HASHED = ["custkey", "priority", "status"]
HASH_SQL = (
    "md5(CAST(custkey AS VARCHAR) || chr(31) || coalesce(priority, chr(0)) || chr(31) || coalesce(status, chr(0)))"
)


def _cur(t: Tables) -> DataFrame:
    return t.orders.selectExpr(*CUR)


def _prev(t: Tables) -> DataFrame:
    return t.orders.filter("o_orderpriority <> '1-URGENT'").selectExpr(*PREV)


@query(
    "delta_by_key",
    f"SELECT DISTINCT responseid, custkey, priority, status, NOT coalesce(trim(responseid) IN (SELECT trim(responseid) FROM {PREV_SQL} "
    f"WHERE responseid IS NOT NULL), false) AS isdelta FROM {CUR_SQL}",
)
def delta_by_key(t: Tables):
    return delta.flag_delta(_cur(t), _prev(t), key="responseid")


@query(
    "delta_by_hash",
    f"SELECT DISTINCT custkey, priority, status, {HASH_SQL} NOT IN (SELECT {HASH_SQL} FROM {PREV_SQL}) AS isdelta FROM {CUR_SQL}",
)
def delta_by_hash(t: Tables):
    return delta.flag_delta(_cur(t).select(*HASHED), _prev(t).select(*HASHED), cols=HASHED)


# What a drop leaves of the rows: blanks around a value are lost on the way, an empty value is null.
_DROPPED_SQL = "nullif(trim(responseid), '') AS responseid, CAST(custkey AS VARCHAR) AS custkey, priority, status"


@query(
    "snapshot_refresh",
    f"SELECT DISTINCT 1 AS version, {_DROPPED_SQL}, true AS isdelta FROM {PREV_SQL} UNION ALL "
    f"SELECT DISTINCT 2, {_DROPPED_SQL}, NOT coalesce(trim(responseid) IN (SELECT trim(responseid) FROM {PREV_SQL} WHERE responseid IS NOT NULL), false) FROM {CUR_SQL}",
)
def snapshot_refresh(t: Tables):
    """Two days of the loop: load the drop, flag it against the snapshot, replace the snapshot by what was flagged."""
    root = scratch_dir(t.spark, "refresh")
    for drop in (_prev(t), _cur(t)):
        path = scratch_dir(t.spark, "refresh-drop")
        export_delimited(drop, path, quote_all=True)
        feeds.refresh_snapshot(m.blank_to_null(read_delimited(t.spark, path)), root, key="responseid")
    days = [read_snapshot(t.spark, root, v).withColumn("version", F.lit(v)) for v in (1, 2)]
    return days[0].unionByName(days[1])


EXAM_COLS = ["studentid", "examdate", "status"]
EXAM = [
    "CASE WHEN o_orderkey % 13 = 0 THEN '' ELSE CAST(o_custkey AS STRING) END AS studentid",
    f"CASE WHEN o_orderkey % 2 = 0 THEN substr(CAST({ORDER_DAY} AS STRING), 6, 2) || '/' || substr(CAST({ORDER_DAY} AS STRING), 9, 2) || '/' || substr(CAST({ORDER_DAY} AS STRING), 1, 4) "
    f"ELSE substr(CAST({ORDER_DAY} AS STRING), 6, 2) || '-' || substr(CAST({ORDER_DAY} AS STRING), 9, 2) || '-' || substr(CAST({ORDER_DAY} AS STRING), 1, 4) END AS examdate",
    "o_orderstatus AS status",
]
_EXAM_SQL = (
    f"(SELECT o_orderpriority, nullif(studentid, '') AS studentid, CAST(try_strptime(examdate, ['%m/%d/%Y', '%m-%d-%Y']) AS DATE) AS examdate, status "
    f"FROM (SELECT o_orderpriority, {', '.join(EXAM)} FROM orders))"
)
_EXAM_HASH = "md5(concat_ws('', studentid, strftime(examdate, '%Y-%m-%d'), status))"


@query(
    "hash_diff_insert",
    f"SELECT studentid, examdate, status FROM {_EXAM_SQL} WHERE {_EXAM_HASH} NOT IN "
    f"(SELECT {_EXAM_HASH} FROM {_EXAM_SQL} WHERE o_orderpriority IN ('1-URGENT', '2-HIGH'))",
)
def hash_diff_insert(t: Tables):
    exams = m.blank_to_null(t.orders.selectExpr("o_orderpriority", *EXAM)).withColumn(
        "examdate", dates.parse_date("examdate", "MM/dd/yy", "MM/dd/yyyy", "MM-dd-yyyy", "MMddyyyy", as_of=AS_OF)
    )
    new = exams.drop("o_orderpriority")
    held = exams.filter("o_orderpriority IN ('1-URGENT', '2-HIGH')").drop("o_orderpriority")
    return delta.new_by_hash(new, held, EXAM_COLS, mode="plain")


@query(
    "insert_if_absent",
    "SELECT DISTINCT k, o_orderstatus FROM (SELECT nullif(o_custkey, 5) AS k, o_orderstatus FROM orders) a WHERE NOT EXISTS "
    "(SELECT 1 FROM customer WHERE c_custkey = a.k AND c_acctbal < 3000)",
)
def insert_if_absent(t: Tables):
    rows = t.orders.select(F.nullif("o_custkey", F.lit(5)).alias("k"), "o_orderstatus")
    held = t.customer.filter("c_acctbal < 3000").select(F.col("c_custkey").alias("k"))
    return delta.new_by_key(rows, held, ["k"])


NEW_PAIRS_SQL = (
    ", bad AS (SELECT DISTINCT p.personid FROM provider p JOIN crosswalk x ON p.ssn = x.ssn WHERE CAST(p.personid AS BIGINT) <> x.cdwaid) "
    "SELECT DISTINCT CAST(personid AS BIGINT) AS cdwaid, ssn AS revealed FROM provider p WHERE length(ssn) BETWEEN 7 AND 9 "
    "AND NOT coalesce(personid IN (SELECT personid FROM bad), false) AND NOT EXISTS "
    "(SELECT 1 FROM known_crosswalk k WHERE k.segment <> 'BUILDING' AND k.cdwaid = CAST(p.personid AS BIGINT))"
)


@query(
    "extend_crosswalk",
    with_inputs(
        ["provider", "crosswalk", "known_crosswalk"],
        NEW_PAIRS_SQL,
    ),
)
def extend_crosswalk(t: Tables):
    known = t.input("known_crosswalk").filter("segment <> 'BUILDING'")
    routed = p.identity_conflicts(t.input("provider").withColumn("personid", F.col("personid").cast("bigint")), t.input("crosswalk"))
    new = p.extend_crosswalk(routed, known, CHECK_KEY)
    return hashing.reveal_column(new, "fullssn", CHECK_KEY, to="revealed").select("cdwaid", "revealed")


@query(
    "duplicate_identity",
    with_inputs(
        ["provider", "crosswalk"],
        ", bad AS (SELECT DISTINCT p.personid FROM provider p JOIN crosswalk x ON p.ssn = x.ssn WHERE CAST(p.personid AS BIGINT) <> x.cdwaid) "
        "SELECT o_orderkey, personid, CASE WHEN personid IN (SELECT personid FROM bad) THEN 'duplicate_ssn' "
        "WHEN length(ssn) < 7 OR length(ssn) > 9 THEN 'bad_length' ELSE 'ok' END AS route FROM provider",
    ),
)
def duplicate_identity(t: Tables):
    rows = t.input("provider").select("o_orderkey", F.col("personid").cast("bigint").alias("personid"), "ssn")
    routed = p.identity_conflicts(rows, t.input("crosswalk"))
    return routed.select("o_orderkey", F.col("personid").cast("string").alias("personid"), "route")


# ---- persons

_MATCHED = (
    "matched AS (SELECT DISTINCT f.terminated_person_id FROM intake_form f JOIN person p ON CAST(p.personid AS VARCHAR) = f.terminated_person_id "
    "WHERE f.cg_status = '2' AND (upper(terminated_person_firstname) = upper(firstname) OR upper(terminated_person_lastname) = upper(lastname)) "
    "AND (CASE WHEN length(terminated_person_ssn) < 4 THEN lpad(terminated_person_ssn, 4, '0') ELSE terminated_person_ssn END = ssn "
    "OR CAST(try_strptime(terminated_person_dob, '%m/%d/%Y') AS DATE) = dob OR terminated_person_email = coalesce(email1, email2)))"
)


@query(
    "person_match_route",
    with_inputs(
        ["person", "intake_form"],
        f", {_MATCHED} SELECT responseid, CASE WHEN cg_status = '1' OR (cg_status = '2' AND terminated_person_id IN "
        "(SELECT terminated_person_id FROM matched)) THEN 'clean' ELSE 'error' END AS route FROM intake_form",
    ),
)
def person_match_route(t: Tables):
    return p.match_terminated(t.input("intake_form"), t.input("person")).select("responseid", "route")


def _case(codes, on: str) -> str:
    quoted = lambda v: f"'{v}'" if isinstance(v, str) else str(v)
    return f"CASE {on} " + " ".join(f"WHEN {quoted(k)} THEN {quoted(v)}" for k, v in codes.items()) + " END"


def _pick(target: str) -> str:
    new, old = p.FORM_PAIRS[target]
    return f"CASE WHEN cg_status = '1' THEN {new} WHEN cg_status = '2' THEN {old} WHEN cg_status IS NULL THEN '' END"


def _pad4(e: str) -> str:
    return f"CASE WHEN length({e}) < 4 THEN lpad({e}, 4, '0') ELSE {e} END"


def _day(e: str, *formats: str) -> str:
    return f"CAST(try_strptime({e}, [{', '.join(repr(f) for f in formats)}]) AS DATE)"


_US_FORMATS = ("%m/%d/%Y", "%m-%d-%Y", "%m%d%Y")
_PHONE_RE = r"'^(?:\+?(\d{1})?-?\(?(\d{3})\)?[\s.-]?)?(\d{3})[\s.-]?(\d{4})[\s.-]?'"
_EMAIL_RE = r"'^\w+([.-]?\w+)*@\w+([.-]?\w+)*(\.\w{2,3})+$'"

_FORM_ROWS = (
    ", picked AS (SELECT *, "
    + ", ".join(f"{_pick(t)} AS {t}" for t in p.FORM_PAIRS)
    + f", {_case(p.EMPLOYER_OF_CODE, 'employername')} AS employerid FROM intake_form WHERE isdelta), "
    f"coded AS (SELECT *, CAST({_case(p.BRANCH_OF_EMPLOYER, 'employerid')} AS INTEGER) AS branchid, "
    f"{_pad4('ssn')} AS ssn4, {_day('dob', *_US_FORMATS)} AS bday FROM picked)"
)

_PERSON_FORM_SQL = (
    _FORM_ROWS
    + ", ready AS (SELECT *, CASE WHEN year(bday) > 1900 THEN bday END AS sane, "
    + f"{_day('person_hire_date', *_US_FORMATS)} AS hired FROM coded) "
    "SELECT 'branch' || branchid || '-' || left(md5(concat_ws('', ssn4, CAST(sane AS VARCHAR))), 10) AS sourcekey, firstname, middlename, lastname, "
    "ssn4 AS ssn, CAST(sane AS VARCHAR) AS dob, email1, '1' || regexp_replace(homephone, '[^A-Z0-9_]', '', 'g') AS homephone, "
    "'1' || regexp_replace(mobilephone, '[^A-Z0-9_]', '', 'g') AS mobilephone, userlanguage AS language, "
    + _case(p.LANGUAGE_OF_CODE, "preferredlanguage")
    + " AS preferred_language, CASE cg_status WHEN '1' THEN 'Active' ELSE 'Terminated' END AS status, "
    "CASE WHEN exempt = '1' THEN 'true' ELSE 'false' END AS exempt, CAST(hired AS TIMESTAMP) AS hiredate, CAST(hired AS TIMESTAMP) AS trackingdate, "
    "'SHCA' AS categorycode, 'Standard HCA' AS workercategory, try_cast(terminated_person_id AS BIGINT) AS agencyid, "
    "mailingstreet1 || ', ' || mailingcity || ', ' || mailingstate || ', ' || mailingzip AS mailingaddress, mailingstreet1, mailingcity, mailingstate, "
    "mailingzip, 'USA' AS mailingcountry, filemodifieddate FROM ready "
    "WHERE branchid IS NOT NULL AND ((cg_status = '1' AND hired IS NOT NULL) OR (cg_status = '2' AND terminated_person_id IS NOT NULL "
    "AND person_termination_date IS NOT NULL)) "
    f"AND (homephone IS NULL OR regexp_matches(homephone, {_PHONE_RE})) AND (mobilephone IS NULL OR regexp_matches(mobilephone, {_PHONE_RE})) "
    f"AND (email1 IS NULL OR regexp_matches(email1, {_EMAIL_RE})) AND sane <= DATE '{AS_OF}' - {dates.ADULT_DAYS}"
)


@query("person_standardize_form", with_inputs(["intake_form"], _PERSON_FORM_SQL))
def person_standardize_form(t: Tables):
    return p.standardize_person_form(t.input("intake_form"), as_of=AS_OF)


@query(
    "employment_from_form",
    with_inputs(
        ["intake_form"],
        _FORM_ROWS
        + ", ready AS (SELECT *, CASE WHEN year(h) > 1900 THEN h END AS hired, CASE WHEN year(e) > 1900 THEN e END AS ended FROM (SELECT *, "
        + f"{_day('person_hire_date', '%m/%d/%Y', '%m-%d-%Y', '%Y-%m-%d', '%m%d%Y')} AS h, "
        + f"{_day('person_termination_date', '%Y/%m/%d', '%m/%d/%Y', '%m-%d-%Y', '%Y-%m-%d')} AS e FROM coded)) "
        "SELECT 'branch' || branchid || '-' || left(md5(concat_ws('', ssn4, CAST(bday AS VARCHAR))), 10) AS source, "
        "try_cast(terminated_person_id AS BIGINT) AS agencyid, employerid, branchid, 'SHCA' AS categorycode, 'Standard HCA' AS workercategory, "
        "CASE cg_status WHEN '1' THEN 'Active' ELSE 'Terminated' END AS empstatus, CAST(hired AS TIMESTAMP) AS hiredate, "
        "CAST(hired AS VARCHAR) AS authstart, CAST(ended AS VARCHAR) AS authend, CAST(hired AS VARCHAR) AS trackingdate, "
        "CAST(ended AS VARCHAR) AS terminationdate, CAST(1 AS INTEGER) AS priority, 'CARE' AS role, 'feedkit' AS createdby, "
        "filemodifieddate AS filedate FROM ready WHERE branchid IS NOT NULL AND firstname IS NOT NULL AND "
        "((cg_status = '1' AND hired IS NOT NULL) OR (cg_status = '2' AND terminated_person_id IS NOT NULL AND ended IS NOT NULL))",
    ),
)
def employment_from_form(t: Tables):
    return p.employment_rows(t.input("intake_form"), as_of=AS_OF)


@query(
    "person_standardize_feed",
    with_inputs(
        ["provider"],
        "SELECT 'FEED-' || personid AS sourcekey, first_name AS firstname, middle_name AS middlename, last_name AS lastname, "
        f"{_pad4('ssn')} AS ssn, strftime({_day('dob', '%Y%m%d')}, '%Y-%m-%d') AS dob, email AS email1, "
        + ", ".join(
            f"CASE WHEN length(right(regexp_replace({a}, '[^0-9]', '', 'g'), 10)) = 10 THEN '1' || right(regexp_replace({a}, '[^0-9]', '', 'g'), 10) END AS {b}"
            for a, b in (("phone_1", "mobilephone"), ("phone_2", "homephone"))
        )
        + ", language, employee_classification AS workercategory, CASE carina_eligible WHEN 'true' THEN true WHEN 'false' THEN false END AS iscarinaeligible, "
        "try_strptime(hire_date, '%Y%m%d') AS hiredate, try_strptime(classification_start_date, '%Y%m%d') AS trackingdate, "
        f"{_day('background_check_date', '%Y%m%d')} AS last_background_check_date, {_day('ie_date', '%Y%m%d')} AS ie_date, "
        "CAST(personid AS BIGINT) AS cdwa_id, CAST(employee_id AS DECIMAL(9,0)) AS dshsid, "
        "physical_add_1 || ', ' || physical_city || ', ' || physical_state || ', ' || physical_zip AS physicaladdress, "
        "mailing_add_1 || ', ' || mailing_city || ', ' || mailing_state || ', ' || mailing_zip AS mailingaddress, "
        "mailing_add_1 AS mailingstreet1, mailing_add_2 AS mailingstreet2, mailing_city AS mailingcity, mailing_state AS mailingstate, "
        "mailing_zip AS mailingzip, 'USA' AS mailingcountry, CAST(substr(filename, 11, 10) AS DATE) AS filemodifieddate, "
        "CASE WHEN exempt_status = 'Yes' THEN 'true' ELSE 'false' END AS exempt, coalesce(ahcas_eligible = '1', false) AS ahcas_eligible "
        f"FROM provider WHERE isvalid = 'true' AND year({_day('dob', '%Y%m%d')}) >= 1900 AND {_day('dob', '%Y%m%d')} <= DATE '{AS_OF}' - {dates.ADULT_DAYS}",
    ),
)
def person_standardize_feed(t: Tables):
    return p.standardize_person_feed(t.input("provider"), "FEED", "providers-", as_of=AS_OF)


VIEW = [
    "'FEED-' || o_custkey AS sourcekey",
    "'SHCA' AS classificationcode",
    f"{ORDER_DAY} AS filedate",
    f"{ORDER_DAY} + 5 AS initialtrackingdate",
    f"{ORDER_DAY} AS hire_date",
    "CAST(1 AS INT) AS priority",
    "CASE WHEN o_orderkey % 9 = 0 THEN 'x' ELSE CAST(o_custkey % 100 AS STRING) END AS employerid",
    "CAST(NULL AS TIMESTAMP) AS termination_date",
    "CAST(o_custkey + 70000 AS DECIMAL(10,0)) AS employee_id",
    "'Standard' AS employee_classification",
    "CASE o_orderstatus WHEN 'F' THEN 'Terminated' ELSE 'Active' END AS empstatus",
]


@query(
    "employment_from_view",
    f"SELECT sourcekey AS source, classificationcode AS categorycode, filedate, CAST(initialtrackingdate AS VARCHAR) AS trackingdate, "
    "'feedkit' AS createdby, CAST(hire_date AS TIMESTAMP) AS hiredate, priority, CAST(try_cast(employerid AS INTEGER) AS VARCHAR) AS employerid, "
    "CAST(NULL AS VARCHAR) AS terminationdate, CAST(employee_id AS BIGINT) AS employeeid, employee_classification AS workercategory, empstatus "
    f"FROM (SELECT {', '.join(VIEW)} FROM orders)",
)
def employment_from_view(t: Tables):
    view = t.orders.selectExpr(*VIEW).withColumn("employerid", F.col("employerid").try_cast("int"))
    return p.employment_from_view(view)


@query(
    "source_key",
    f"SELECT c_custkey, 'LBL-' || left(md5(concat_ws('', ssn, CAST(dob AS VARCHAR))), 10) AS hashed, 'FEED-' || c_custkey AS plain FROM "
    f"(SELECT c_custkey, {_pad4('CAST(c_custkey % 997 AS VARCHAR)')} AS ssn, CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE DATE '1950-01-01' + CAST(c_custkey AS INTEGER) END AS dob FROM customer)",
)
def source_key(t: Tables):
    rows = t.customer.selectExpr(
        "c_custkey",
        "lpad(CAST(c_custkey % 997 AS STRING), greatest(4, length(CAST(c_custkey % 997 AS STRING))), '0') AS ssn",
        "CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE DATE '1950-01-01' + CAST(c_custkey AS INT) END AS dob",
    )
    return rows.select(
        "c_custkey",
        hashing.source_key("LBL", "ssn", F.col("dob").cast("string")).alias("hashed"),
        F.concat(F.lit("FEED-"), F.col("c_custkey").cast("string")).alias("plain"),
    )


@query(
    "contact_validation",
    with_inputs(
        ["intake_form"],
        f"SELECT responseid, CASE WHEN (newhire_person_phone1 IS NULL OR regexp_matches(newhire_person_phone1, {_PHONE_RE})) AND "
        f"(newhire_person_phone2 IS NULL OR regexp_matches(newhire_person_phone2, {_PHONE_RE})) THEN 'valid' ELSE 'invalid' END AS is_validphone, "
        f"CASE WHEN newhire_person_email1 IS NULL OR regexp_matches(newhire_person_email1, {_EMAIL_RE}) THEN 'valid' ELSE 'invalid' END AS is_validemail "
        "FROM intake_form",
    ),
)
def contact_validation(t: Tables):
    checked = p.validate_contacts(
        t.input("intake_form"), ("newhire_person_phone1", "newhire_person_phone2"), "newhire_person_email1"
    )
    return checked.select("responseid", "is_validphone", "is_validemail")


@query(
    "provider_clean",
    with_inputs(
        ["provider"],
        "SELECT o_orderkey, nullif(trim(regexp_replace(client_id, '[\\r\\n\"]', '', 'g')), '') AS client_id, "
        "left(upper(mailing_state), 2) AS mailing_state, left(upper(physical_state), 2) AS physical_state FROM provider",
    ),
)
def provider_clean(t: Tables):
    return p.clean_provider_rows(t.input("provider")).select("o_orderkey", "client_id", "mailing_state", "physical_state")


# ---- transfers


@query(
    "resolve_person_route",
    with_inputs(
        ["transfer", "person"],
        "SELECT event_id, q.personid AS person_id, CASE WHEN q.personid IS NULL THEN 'error' "
        "WHEN trainingprogram = 'Orientation & Safety' THEN 'safety' ELSE 'other' END AS route, q.personid IS NOT NULL AS isvalid "
        "FROM transfer t LEFT JOIN (SELECT DISTINCT personid, cdwaid FROM person) q ON t.personid + 500000 = q.cdwaid",
    ),
)
def resolve_person_route(t: Tables):
    rows = t.input("transfer").withColumn("ext", F.col("personid") + 500000)
    routed = tr.resolve_person(rows.drop("isvalid"), t.input("person"), "ext", "cdwaid", "trainingprogram")
    return routed.select("event_id", "person_id", "route", "isvalid")


_FIRST = (
    "firsts AS (SELECT *, row_number() OVER (PARTITION BY personid, trainingprogram, credithours ORDER BY completeddate NULLS FIRST, event_id) AS rn "
    "FROM transfer WHERE isvalid = 'true')"
)


@query("transfer_first", with_inputs(["transfer"], f", {_FIRST} SELECT event_id, rn = 1 AS is_first FROM firsts"))
def transfer_first(t: Tables):
    return tr.flag_first_transfers(t.input("transfer"), ["event_id"]).select("event_id", "is_first")


def _hours_ok(program: str, hours: str, table, whole: bool) -> str:
    n = f"trunc(try_cast({hours} AS DOUBLE))" if whole else f"try_cast({hours} AS DOUBLE)"
    exact = " OR ".join(f"({program} = '{k}' AND {n} = {v})" for k, v in table.items())
    return f"coalesce({exact} OR (trim({program}) = 'Continuing Education' AND {n} BETWEEN 0 AND 12), false)"


_FEED_OK = _hours_ok("trainingprogram", "credithours", tr.FEED_HOURS, True)
_SURVEY_OK = _hours_ok("trainingprogramtype", "credithours", tr.SURVEY_HOURS, False)


@query(
    "transfer_eligible_hours",
    with_inputs(
        ["transfer"],
        f"SELECT event_id, {_FEED_OK} AS hours_ok, {_case(tr.PROGRAM_CODES, 'trainingprogram')} AS trainingprogramcode FROM transfer",
    ),
)
def transfer_eligible_hours(t: Tables):
    return tr.eligible_hours(t.input("transfer")).select("event_id", "hours_ok", "trainingprogramcode")


@query(
    "transfer_vs_history",
    with_inputs(
        ["transfer", "transfer_history"],
        "SELECT event_id FROM transfer t WHERE NOT EXISTS (SELECT 1 FROM transfer_history h WHERE h.personid = t.personid "
        "AND h.trainingprogram = t.trainingprogram AND CAST(h.transferhours AS DECIMAL(5,2)) = try_cast(t.credithours AS DECIMAL(5,2)))",
    ),
)
def transfer_vs_history(t: Tables):
    rows = t.input("transfer").withColumn("hours", F.col("credithours").try_cast("decimal(5,2)"))
    past = t.input("transfer_history").withColumn("hours", F.col("transferhours").try_cast("decimal(5,2)"))
    return tr.not_in_history(rows, past, ["personid", "trainingprogram", "hours"]).select("event_id")


def _rules(rows: str, program: str, done: str) -> str:
    """The rule table over ``rows`` as a CTE body."""
    h = "try_cast(tt.credithours AS DECIMAL(9,2))"
    due = "coalesce(r.duedateextension, r.duedate)"
    need = "CAST(r.requiredhours AS DECIMAL(9,2))"
    earned, moved = (f"coalesce(CAST(r.{x} AS DECIMAL(9,2)), 0)" for x in ("earnedhours", "transferredhours"))
    msg = tr.MESSAGES
    return (
        f"SELECT tt.*, NOT (coalesce(tt.{done} < p.hiredate, false) OR r.personid IS NULL) AS is_valid, "
        f"CASE WHEN tt.{done} < p.hiredate THEN '{msg['before_hire']}' WHEN r.personid IS NULL THEN '{msg['no_requirement']}' END AS error_message, "
        f"CASE WHEN tt.trainingprogramcode IN ('201','202','203','204') AND {h} = {need} AND tt.{done} <= {due} THEN CAST({h} AS DOUBLE) "
        f"WHEN tt.trainingprogramcode = '300' AND tt.{done} BETWEEN r.trackingdate AND {due} AND {need} - {earned} - {moved} = {h} "
        f"AND p.hiredate >= DATE '2020-03-01' THEN CAST({h} + {moved} AS DOUBLE) END AS transferhours, "
        f"CASE WHEN tt.trainingprogramcode = '300' AND tt.{done} NOT BETWEEN r.trackingdate AND {due} THEN '{msg['continuing_window']}' "
        f"WHEN tt.trainingprogramcode IN ('201','202','203','204') AND tt.{done} > {due} THEN '{msg['basic_late']}' "
        f"WHEN tt.trainingprogramcode = '300' AND p.hiredate < DATE '2020-03-01' THEN '{msg['hired_early']}' "
        f"WHEN tt.trainingprogramcode = '300' AND {earned} + coalesce({h}, 0) > coalesce({need}, 0) THEN '{msg['excess']}' END AS additionalerrors "
        f"FROM {rows} tt LEFT JOIN person p ON tt.personid = p.personid LEFT JOIN (SELECT * FROM requirement WHERE lower(status) = 'active') r "
        f"ON tt.personid = r.personid AND tt.{program} = r.trainingprogram"
    )


_CODED = f"coded AS (SELECT *, {_case(tr.PROGRAM_CODES, 'trainingprogram')} AS trainingprogramcode FROM transfer)"
_RULE_INPUTS = ["transfer", "person", "requirement"]


@query(
    "transfer_rules",
    with_inputs(
        _RULE_INPUTS,
        f", {_CODED}, ruled AS ({_rules('coded', 'trainingprogram', 'completeddate')}) "
        "SELECT event_id, is_valid, error_message, transferhours, additionalerrors FROM ruled",
    ),
)
def transfer_rules(t: Tables):
    coded = tr.eligible_hours(t.input("transfer"))
    ruled = tr.apply_transfer_rules(coded, t.input("person"), t.input("requirement"))
    return ruled.select("event_id", "is_valid", "error_message", "transferhours", "additionalerrors")


_ROUTED = (
    "SELECT event_id, transferhours, CASE WHEN is_valid AND transferhours IS NOT NULL THEN 'staging' ELSE 'rule_error' END AS route, "
    "CASE WHEN NOT (is_valid AND transferhours IS NOT NULL) THEN concat_ws(';', error_message, additionalerrors) END AS error_message FROM ruled"
)


@query(
    "transfer_route",
    with_inputs(
        [*_RULE_INPUTS, "transfer_history"],
        f", {_FIRST}, marked AS (SELECT *, {_FEED_OK} AS ok, {_case(tr.PROGRAM_CODES, 'trainingprogram')} AS trainingprogramcode, "
        "EXISTS (SELECT 1 FROM transfer_history h WHERE h.personid = f.personid AND h.trainingprogram = f.trainingprogram "
        "AND CAST(h.transferhours AS DECIMAL(5,2)) = try_cast(f.credithours AS DECIMAL(5,2))) AS held FROM firsts f), "
        "fresh AS (SELECT * FROM marked WHERE rn = 1 AND ok AND NOT held), "
        f"ruled AS ({_rules('fresh', 'trainingprogram', 'completeddate')}) {_ROUTED} "
        "UNION ALL SELECT event_id, NULL, CASE WHEN rn > 1 THEN 'duplicate' WHEN NOT ok THEN 'rejected_hours' ELSE 'in_history' END, NULL "
        "FROM marked WHERE NOT (rn = 1 AND ok AND NOT held)",
    ),
)
def transfer_route(t: Tables):
    routed = tr.feed_transfers(
        t.input("transfer"), t.input("person"), t.input("requirement"), t.input("transfer_history"), ["event_id"]
    )
    return routed.select("event_id", "transferhours", "route", "error_message")


_CLEANED = (
    "cleaned AS (SELECT *, CASE "
    + " ".join(
        f"WHEN contains(course_name, '{s}') THEN regexp_replace(trim(course_name), '\\s*{s.replace('(', chr(92) + '(').replace(')', chr(92) + ')')}$', '')"
        for s in tr.TITLE_SUFFIXES
    )
    + " END AS coursename_cleaned, CASE WHEN regexp_matches(code_text, '^[^#]') AND regexp_matches(code_text, '^.*CE+[0-9]|CO+[0-9]|NF+[0-9]') "
    "THEN code_text END AS coursecode FROM survey), titled AS (SELECT c.*, b.trainingprogramtype, b.trainingprogramcode FROM cleaned c LEFT JOIN "
    "(SELECT DISTINCT trainingprogramtype, trainingprogramcode FROM program_catalog WHERE trainingprogramcode <> '603') b "
    "ON c.coursename_cleaned = b.trainingprogramtype)"
)


@query(
    "course_name_clean",
    with_inputs(
        ["survey", "program_catalog"],
        f", {_CLEANED} SELECT event_id, coursename_cleaned, coursecode, trainingprogramtype, trainingprogramcode FROM titled",
    ),
)
def course_name_clean(t: Tables):
    cleaned = tr.clean_course(t.input("survey"), t.input("program_catalog"))
    return cleaned.select("event_id", "coursename_cleaned", "coursecode", "trainingprogramtype", "trainingprogramcode")


@query(
    "transfer_survey",
    with_inputs(
        ["survey", "program_catalog", "person", "requirement", "transfer_history"],
        f", {_CLEANED}, firsts AS (SELECT *, row_number() OVER (PARTITION BY personid, trainingprogramcode, continuing_education_information_1 "
        f"ORDER BY completed_date NULLS FIRST, event_id, trainingprogramcode) AS rn FROM titled), marked AS (SELECT *, {_SURVEY_OK} AS ok, "
        "EXISTS (SELECT 1 FROM transfer_history h WHERE h.personid = f.personid AND h.trainingprogram = f.trainingprogramtype "
        "AND CAST(h.transferhours AS DECIMAL(5,2)) = try_cast(f.credithours AS DECIMAL(5,2)) AND h.coursecode = f.coursecode) AS held FROM firsts f), "
        "fresh AS (SELECT * FROM marked WHERE finished = 'True' AND rn = 1 AND ok AND NOT held), "
        f"ruled AS ({_rules('fresh', 'trainingprogramtype', 'completed_date')}) {_ROUTED} "
        "UNION ALL SELECT event_id, NULL, CASE WHEN finished <> 'True' THEN 'unfinished' WHEN rn > 1 THEN 'duplicate' WHEN NOT ok THEN 'rejected_hours' "
        "ELSE 'in_history' END, NULL FROM marked WHERE NOT (finished = 'True' AND rn = 1 AND ok AND NOT held)",
    ),
)
def transfer_survey(t: Tables):
    routed = tr.survey_transfers(
        t.input("survey"),
        t.input("program_catalog"),
        t.input("person"),
        t.input("requirement"),
        t.input("transfer_history"),
        ["event_id", "trainingprogramcode"],
    )
    return routed.select("event_id", "transferhours", "route", "error_message")


# ---- completions


@query(
    "catalog_preferred",
    with_inputs(
        ["catalog"],
        "SELECT coursename, courselanguage, trainingprogramcode, coursetype, courseid FROM (SELECT *, row_number() OVER "
        "(PARTITION BY coursename, courselanguage, trainingprogramcode ORDER BY coursetype, courseid) AS rn FROM catalog) WHERE rn = 1",
    ),
)
def catalog_preferred(t: Tables):
    return c.preferred_courses(t.input("catalog")).select(
        "coursename", "courselanguage", "trainingprogramcode", "coursetype", "courseid"
    )


@query(
    "active_instructors",
    with_inputs(
        ["instructor"],
        "SELECT DISTINCT trim(trim(firstname) || ' ' || trim(lastname)) AS instructorname, instructorid FROM instructor WHERE isactive = 'true'",
    ),
)
def active_instructors(t: Tables):
    return c.active_instructors(t.input("instructor"))


_KEYS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


def completions(t: Tables) -> DataFrame:
    """Completions as a learning system gives them: an order line is one, its customer the learner, its part the title."""
    lines = t.lineitem.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", F.col("l_shipdate").cast("date").alias("day"))
    learners = t.orders.select("o_orderkey", "o_custkey")
    titles = t.part.select("p_partkey", F.concat(F.lit(" "), F.upper("p_name")).alias("class_title"))
    return (
        lines.join(learners, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(titles, F.col("l_partkey") == F.col("p_partkey"))
        .select(F.col("o_custkey").alias("learner_id"), "class_title", F.col("day").alias("completiondate"), *_KEYS)
    )


def taught(t: Tables, lines: DataFrame) -> DataFrame:
    """Completions with their instructor, the line's supplier."""
    teachers = t.supplier.select(
        "s_suppkey", F.concat(F.upper("s_name"), F.lit(" N"), F.col("s_nationkey").cast("string"), F.lit(" ")).alias("instructor")
    )
    return lines.join(teachers, F.col("l_suppkey") == F.col("s_suppkey"), "left").drop("s_suppkey")


COMPLETIONS_SQL = (
    "SELECT o_custkey AS learner_id, ' ' || upper(p_name) AS class_title, CAST(l_shipdate AS DATE) AS completiondate, "
    "upper(s_name) || ' N' || s_nationkey || ' ' AS instructor, l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem "
    "JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey LEFT JOIN supplier ON l_suppkey = s_suppkey"
)
ENRICH_SQL = with_inputs(
    ["catalog", "instructor"],
    f", done AS ({COMPLETIONS_SQL}), firsts AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY learner_id, class_title "
    "ORDER BY completiondate NULLS FIRST, l_orderkey, l_linenumber, l_partkey, l_suppkey) AS rn FROM done) WHERE rn = 1), "
    "cat AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY coursename, courselanguage, trainingprogramcode ORDER BY coursetype, courseid) AS rn "
    "FROM catalog) WHERE rn = 1), ins AS (SELECT DISTINCT trim(trim(firstname) || ' ' || trim(lastname)) AS iname, instructorid FROM instructor "
    "WHERE isactive = 'true') "
    "SELECT DISTINCT learner_id, class_title, completiondate, credithours, trainingprogramtype, trainingprogramcode, courseid, coursetype, courselanguage, "
    "dshscourseid, instructor AS instructorname, instructorid, 'LMS' AS trainingsource FROM firsts "
    "LEFT JOIN cat ON lower(trim(class_title)) = lower(trim(coursename)) LEFT JOIN ins ON lower(trim(iname)) = lower(trim(instructor))",
)


@query("completions_enrich", ENRICH_SQL)
def completions_enrich(t: Tables):
    first = taught(t, keep_first(completions(t), ["learner_id", "class_title"], ["completiondate", *_KEYS]))
    courses = c.preferred_courses(t.input("catalog"))
    return c.enrich_completions(first, courses, c.active_instructors(t.input("instructor")), "LMS")


@query(
    "completions_enrich_language",
    with_inputs(
        ["catalog"],
        ", sheet_rows AS (SELECT DISTINCT l_orderkey AS learner_id, upper(p_name) || CASE WHEN l_partkey % 3 = 0 THEN ' es' ELSE ' EN' END AS class_title, "
        "CAST(l_shipdate AS DATE) AS completiondate FROM lineitem JOIN part ON l_partkey = p_partkey), "
        "cat AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY coursename, courselanguage, trainingprogramcode ORDER BY coursetype, courseid) AS rn "
        "FROM catalog) WHERE rn = 1) SELECT DISTINCT learner_id, class_title, completiondate, courseid, 'SHEET' AS trainingsource FROM sheet_rows "
        "LEFT JOIN cat ON lower(trim(class_title)) = lower(trim(coursename) || ' ' || courselanguage)",
    ),
)
def completions_enrich_language(t: Tables):
    rows = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).select(
        F.col("l_orderkey").alias("learner_id"),
        F.concat(F.upper("p_name"), F.when(F.col("l_partkey") % 3 == 0, " es").otherwise(" EN")).alias("class_title"),
        F.col("l_shipdate").cast("date").alias("completiondate"),
        F.lit(None).cast("string").alias("instructor"),
    )
    courses = c.preferred_courses(t.input("catalog"))
    done = c.enrich_completions(rows, courses, c.active_instructors(t.input("instructor")), "SHEET", with_language=True)
    return done.select("learner_id", "class_title", "completiondate", "courseid", "trainingsource").distinct()


@query(
    "completions_validate_person",
    with_inputs(
        ["named_completion", "person"],
        ", known AS (SELECT DISTINCT lower(lastname) AS ln, lower(coalesce(email1, email2)) AS em, CAST(personid AS VARCHAR) AS id FROM person "
        "WHERE coalesce(email1, email2) IS NOT NULL), flagged AS (SELECT n.*, id IS NOT NULL AS ok FROM named_completion n LEFT JOIN known ON "
        "lower(trim(last_name)) = ln AND lower(trim(learner_email)) = em AND trim(learner_id) = id), "
        "ranked AS (SELECT *, row_number() OVER (PARTITION BY learner_id, class_title ORDER BY date NULLS FIRST, l_orderkey, l_linenumber, l_partkey, l_suppkey) AS rn "
        "FROM flagged WHERE ok) SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, date, CASE WHEN rn = 1 THEN 'valid' ELSE 'duplicate' END AS route FROM ranked "
        "UNION ALL SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, date, 'unmatched' FROM flagged WHERE NOT ok",
    ),
)
def completions_validate_person(t: Tables):
    return c.validate_completions(t.input("named_completion"), t.input("person"), _KEYS).select(*_KEYS, "date", "route")


@query(
    "completions_newest_sheet",
    with_inputs(
        ["sheet"],
        "SELECT learner_id, class_title, date, sheetdate FROM (SELECT *, row_number() OVER (PARTITION BY learner_id, class_title ORDER BY sheetdate DESC NULLS LAST, "
        "date NULLS FIRST, l_orderkey, l_linenumber, l_partkey, l_suppkey) AS rn FROM (SELECT *, CAST(try_strptime(split_part(sheet_name, '-', 2), '%Y%m%d') AS DATE) AS sheetdate "
        "FROM sheet WHERE attendance = 'Attended')) WHERE rn = 1",
    ),
)
def completions_newest_sheet(t: Tables):
    return c.newest_sheet(t.input("sheet"), _KEYS).select("learner_id", "class_title", "date", "sheetdate")


LMS_HEADINGS = {
    "person_id": "BG Person ID",
    "course_title": "Course Title",
    "completion_date": "Completion Date",
    "registration_date": "Registration Date",
    "status": "Status",
}


@query(
    "completions_clean",
    with_inputs(
        ["lms"],
        "SELECT person_id, course_title, strftime(try_strptime(completion_date, '%Y-%m-%d'), '%Y-%m-%d') AS completed, "
        "strftime(try_strptime(registration_date, '%m/%d/%Y'), '%Y-%m-%d') AS registered FROM (SELECT *, row_number() OVER "
        "(PARTITION BY person_id, course_title ORDER BY completion_date DESC, l_orderkey, l_linenumber, l_partkey, l_suppkey, status) AS rn FROM lms) "
        "WHERE rn = 1 AND regexp_matches(person_id, '^[0-9]+$') AND course_title <> '' AND completion_date <> '' AND status = 'Passed'",
    ),
)
def completions_clean(t: Tables):
    order = [F.col("Completion Date").desc(), *_KEYS, "Status"]
    clean = c.clean_lms_completions(t.input("lms").withColumnsRenamed(LMS_HEADINGS), order)
    return clean.select(
        F.col("BG Person ID").alias("person_id"),
        F.col("Course Title").alias("course_title"),
        F.date_format("Completion Date", "yyyy-MM-dd").alias("completed"),
        F.date_format("Registration Date", "yyyy-MM-dd").alias("registered"),
    )


@query(
    "completions_clean_sheet",
    with_inputs(
        ["sheet"],
        "SELECT learner_id, class_id, CAST(try_strptime(date_text, '%m/%d/%Y') AS DATE) AS date, replace(instructor, '''', '’') AS instructor FROM "
        "(SELECT *, row_number() OVER (PARTITION BY learner_id, class_id ORDER BY date_text DESC, l_orderkey, l_linenumber, l_partkey, l_suppkey, attendance) AS rn FROM sheet) "
        "WHERE rn = 1 AND regexp_matches(learner_id, '^[0-9]+$') AND length(learner_id) <= 12 AND date_text <> ''",
    ),
)
def completions_clean_sheet(t: Tables):
    named = {"learner_id": "learner id", "class_id": "class id", "class_title": "class title", "date_text": "date"}
    rows = t.input("sheet").drop("date").withColumnsRenamed(named).withColumn("when enrolled", F.lit("01/02/23"))
    clean = c.clean_sheet_completions(rows, [F.col("date").desc(), *_KEYS, "attendance"], as_of=AS_OF)
    return clean.select(F.col("learner id").alias("learner_id"), F.col("class id").alias("class_id"), "date", "instructor")


_FAMILY = "trim(left(courseid, greatest(length(courseid) - 7, 0)))"
_HISTORY_ORDER = "completeddate NULLS FIRST, courseid NULLS FIRST, credithours, partkey, suppkey"


@query(
    "unique_course_family",
    with_inputs(
        ["history", "taken"],
        f", held AS (SELECT DISTINCT personid AS tp, lower({_FAMILY}) AS tf FROM taken WHERE personid IS NOT NULL AND courseid IS NOT NULL), "
        f"ranked AS (SELECT *, {_FAMILY} AS family, row_number() OVER (PARTITION BY personid, {_FAMILY} ORDER BY {_HISTORY_ORDER}) AS rn FROM history "
        "WHERE personid IS NOT NULL) SELECT r.personid, courseid, completeddate, credithours, partkey, suppkey, CASE WHEN courseid IS NULL THEN 'no_course' "
        "WHEN tp IS NOT NULL THEN 'in_transcript' WHEN rn = 1 THEN 'unique' ELSE 'duplicate' END AS route FROM ranked r LEFT JOIN held ON tp = r.personid "
        "AND tf = lower(family) UNION ALL SELECT personid, courseid, completeddate, credithours, partkey, suppkey, 'no_person' FROM history WHERE personid IS NULL",
    ),
)
def unique_course_family(t: Tables):
    return c.unique_completions(t.input("history"), t.input("taken"), ["courseid", "credithours", "partkey", "suppkey"])


_SAFETY_SQL = (
    "'Orientation & Safety EN' AS coursename, CAST(5 AS DOUBLE) AS credithours, '1000065ONLEN02' AS courseid, CAST(100 AS BIGINT) AS trainingprogramcode"
)


@query(
    "safety_completions_transfers",
    with_inputs(
        ["transfer", "person", "requirement"],
        ", need AS (SELECT DISTINCT p.personid FROM person p JOIN requirement r ON p.personid = r.personid WHERE r.trainingprogramcode = '100' "
        "AND r.status = 'active' AND p.cdwaid IS NOT NULL), ranked AS (SELECT *, row_number() OVER (PARTITION BY personid, trainingprogram "
        "ORDER BY completeddate NULLS FIRST, event_id) AS rn FROM transfer WHERE isvalid = 'true') "
        f"SELECT event_id, personid, completeddate, CASE WHEN rn = 1 AND personid IN (SELECT personid FROM need) THEN 'history' ELSE 'log' END AS route, {_SAFETY_SQL} FROM ranked",
    ),
)
def safety_completions_transfers(t: Tables):
    done = c.safety_from_transfers(t.input("transfer"), t.input("person"), t.input("requirement"), ["event_id"], "FEED")
    return done.select(
        "event_id", "personid", "completeddate", "route", "coursename", "credithours", "courseid", "trainingprogramcode"
    )


_FORM_DAY = (
    "CAST(try_strptime(completion_date, ['%m/%d/%Y', '%m-%d-%Y', '%Y-%m-%d', '%m%d%Y']) AS DATE)"
)
_LAST_FORM = (
    f"last AS (SELECT try_cast(form_id AS BIGINT) AS fid, completeddate, filemodifieddate FROM (SELECT *, row_number() OVER (PARTITION BY form_id ORDER BY filemodifieddate DESC NULLS LAST, "
    f"completeddate NULLS FIRST, o_orderkey) AS rn FROM (SELECT *, {_FORM_DAY} AS completeddate FROM safety_form WHERE isdelta = 'true')) WHERE rn = 1 AND finished = '1')"
)


@query(
    "safety_completions_by_id",
    with_inputs(
        ["safety_form", "person"],
        f", {_LAST_FORM} SELECT p.personid, p.dshsid, completeddate, filemodifieddate, {_SAFETY_SQL}, 'FORM' AS trainingsource FROM last "
        "JOIN (SELECT DISTINCT dshsid, personid FROM person) p ON fid = p.dshsid",
    ),
)
def safety_completions_by_id(t: Tables):
    done = c.safety_from_form(t.input("safety_form"), t.input("person"), ["dshsid"], "FORM", ["o_orderkey"])
    return done.select(
        "personid", "dshsid", "completeddate", "filemodifieddate", "coursename", "credithours", "courseid",
        "trainingprogramcode", "trainingsource",
    )


@query(
    "safety_completions_either_id",
    with_inputs(
        ["safety_form", "person"],
        f", {_LAST_FORM} SELECT p.personid, p.dshsid, completeddate, filemodifieddate, {_SAFETY_SQL}, 'FORM' AS trainingsource FROM last "
        "JOIN (SELECT DISTINCT dshsid, personid FROM person WHERE dshsid IS NOT NULL) p ON fid = p.dshsid OR fid = p.personid",
    ),
)
def safety_completions_either_id(t: Tables):
    done = c.safety_from_form(t.input("safety_form"), t.input("person"), ["personid", "dshsid"], "FORM", ["o_orderkey"])
    return done.select(
        "personid", "dshsid", "completeddate", "filemodifieddate", "coursename", "credithours", "courseid",
        "trainingprogramcode", "trainingsource",
    )


# ---- extracts

_PENDING = (
    "SELECT credentialnumber FROM credential c WHERE upper(credentialtype) = 'HM' AND primarycredential = 1 AND upper(credentialstatus) = 'PENDING' "
    "AND NOT EXISTS (SELECT 1 FROM reported r WHERE r.credentialnumber = c.credentialnumber)"
)
_EMPLOYERS = (
    "SELECT personid, string_agg(DISTINCT employername, ',' ORDER BY employername) AS activeemployers FROM relation r JOIN employer e "
    "ON CAST(r.employerid AS BIGINT) = e.employerid JOIN employertrust b ON CAST(r.employerid AS BIGINT) = b.employerid "
    "WHERE upper(empstatus) = 'ACTIVE' AND upper(trust) = 'TP' GROUP BY personid"
)


@query("credential_pending", with_inputs(["credential", "reported"], _PENDING))
def credential_pending(t: Tables):
    return x.pending_credentials(t.input("credential"), t.input("reported")).select("credentialnumber")


@query("active_employers", with_inputs(["relation", "employer", "employertrust"], _EMPLOYERS))
def active_employers(t: Tables):
    return x.active_employers(t.input("relation"), t.input("employer"), t.input("employertrust"), "TP")


_STUDENT_INPUTS = [
    "person", "student_requirement", "transcript", "number", "credential", "reported", "relation", "employer", "employertrust",
]


def _students_sql(state: str, taught: str, hours: str) -> str:
    def us(e: str) -> str:
        return f"strftime({e}, '%m/%d/%Y')"

    return with_inputs(
        _STUDENT_INPUTS,
        f", pending AS ({_PENDING}), serv AS ({_EMPLOYERS}), "
        f"bt AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY personid ORDER BY trainingid DESC, completeddate DESC NULLS LAST) AS rn "
        f"FROM student_requirement WHERE trackingdate >= DATE '2013-09-01' AND trainingprogramcode = '201' AND {state}) WHERE rn = 1), "
        "os AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY personid ORDER BY trainingid DESC, completeddate DESC NULLS LAST) AS rn "
        "FROM student_requirement WHERE trainingprogramcode = '100' AND completeddate IS NOT NULL AND earnedhours = 5) WHERE rn = 1), "
        "tp AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY personid ORDER BY CAST(left(completeddate, 10) AS DATE) DESC NULLS LAST, instructorid, instructorname) AS rn "
        "FROM transcript WHERE trainingprogramcode = '201') WHERE rn = 1) "
        'SELECT DISTINCT per.personid AS "Student ID", lastname AS "Last Name", firstname AS "First Name", right(ssn, 4) AS "Social Security Number (Last 4)", '
        f'{us("dob")} AS "Birthdate", upper(mailingstreet1) AS "Mailing Street", upper(mailingcity) AS "Mailing City", upper(mailingstate) AS "Mailing State", '
        'mailingzip AS "Mailing Zip/Postal Code", CAST(NULL AS VARCHAR) AS "County", mobilephone AS "Phone1", activeemployers AS "Active Employer(s)", '
        f'{us("bt.trackingdate")} AS "Tracking Date", {us("bt.duedate")} AS "Due Date", CAST(os.earnedhours AS INTEGER) AS "Safety & Orientation Hours Completed", '
        f'{us("os.completeddate")} AS "Safety & Orientation Completed On", {hours} AS "Basic Training Hours Completed", '
        f"{us('bt.completeddate')} AS \"Basic Training Completed On\", '0001' AS \"Training Program Code\", 'Training Program' AS \"Training Program Name\", "
        f'CASE WHEN {taught} THEN instructorid END AS "Last Instructor ID", CASE WHEN {taught} THEN instructorname END AS "Last Instructor Name", '
        'pending.credentialnumber AS "HCA Credential Number" FROM person per JOIN serv ON per.personid = serv.personid JOIN bt ON bt.personid = per.personid '
        "JOIN os ON os.personid = per.personid JOIN number prc ON prc.personid = per.personid JOIN pending ON pending.credentialnumber = prc.credentialnumber "
        "LEFT JOIN tp ON tp.personid = per.personid WHERE upper(per.status) = 'ACTIVE'",
    )


def _students(t: Tables, kind: str) -> DataFrame:
    extract = x.student_extract(
        t.input("person"),
        x.active_employers(t.input("relation"), t.input("employer"), t.input("employertrust"), "TP"),
        t.input("student_requirement"),
        x.transcript_dates(t.input("transcript")),
        t.input("number"),
        x.pending_credentials(t.input("credential"), t.input("reported")),
        kind,
    )
    return m.rename(extract, x.STUDENT_HEADINGS)


@query(
    "students_late_or_open",
    _students_sql(
        "(completeddate IS NULL OR (completeddate > duedate AND earnedhours = 70))",
        "bt.earnedhours = 70",
        "coalesce(bt.earnedhours, 0)",
    ),
)
def students_late_or_open(t: Tables):
    return _students(t, "open")


@query(
    "students_completed",
    _students_sql(
        "completeddate IS NOT NULL AND completeddate <= duedate AND earnedhours = 70", "true", "CAST(bt.earnedhours AS INTEGER)"
    ),
)
def students_completed(t: Tables):
    return _students(t, "completed")


@query(
    "id_extract",
    with_inputs(
        ["crosswalk"],
        "SELECT DISTINCT personid, lpad(ssn, 9, '0') AS fullssn FROM crosswalk WHERE length(ssn) >= 7 AND personid IS NOT NULL",
    ),
)
def id_extract(t: Tables):
    sealed = hashing.protect_column(t.input("crosswalk"), "ssn", CHECK_KEY, to="fullssn").drop("ssn")
    return x.id_extract(sealed, CHECK_KEY)


# ---- report files and exports

_REPORT_SQL = (
    "SELECT c_custkey, segment, trim(col0) AS filelastname, col1 AS filefirstname, col2 AS filereceiveddate, trim(col3) AS registryname, "
    "nullif(substring(replace(col4, '.', ''), 5, 16), '') AS credentialnumber, nullif(col5, '') AS credentialstatus, col6 AS applicationdate, "
    "col7 AS dateupdated, instructor_text, filename, strftime(try_strptime(substr(filename, 17, 14), '%Y%m%d%H%M%S'), '%Y-%m-%d %H:%M:%S') AS filedate FROM report"
)


def _report(t: Tables) -> DataFrame:
    loaded = r.load_report(t.input("report"), "col4", "Classified File ").drop("col4")
    named = m.rename(loaded, {k: v for k, v in r.CLASSIFIED_COLUMNS.items() if k in loaded.columns})
    return named.withColumn("filedate", F.date_format("filedate", "yyyy-MM-dd HH:mm:ss"))


@query("report_preamble_load", with_inputs(["report"], _REPORT_SQL))
def report_preamble_load(t: Tables):
    return _report(t)


@query(
    "report_finalize",
    with_inputs(
        ["report"],
        f", loaded AS ({_REPORT_SQL}) SELECT credentialnumber, "
        + ", ".join(f"{_day(d, '%m/%d/%Y')} AS {d}" for d in ("filereceiveddate", "applicationdate", "dateupdated"))
        + ", CAST(try_strptime(substr(filename, 17, 8), '%Y%m%d') AS DATE) AS reportdate, regexp_split_to_array(instructor_text, '\\s+')[1] AS approvedinstructorcode, "
        "regexp_split_to_array(instructor_text, '\\s+')[2] || ' ' || regexp_split_to_array(instructor_text, '\\s+')[3] AS approvedinstructorname "
        "FROM loaded WHERE segment <> 'BUILDING'",
    ),
)
def report_finalize(t: Tables):
    loaded = _report(t)
    target = loaded.filter("segment = 'BUILDING'").select("credentialnumber")
    done = r.finalize_report(loaded, target, "Classified File ", instructor="instructor_text")
    return done.select(
        "credentialnumber", "filereceiveddate", "applicationdate", "dateupdated", "reportdate",
        "approvedinstructorcode", "approvedinstructorname",
    )


# Names of the dropped report files, by the parity of the customer key.
COMPLETED_FILES = ("Completed File 20240630101500.csv", "Completed File 20240701093000.csv")
COMPLETED_ROWS = [f"col{i}" for i in range(8)] + ["instructor_text", "col2 AS graduated", "c_custkey AS place"]


@query(
    "completed_report_load",
    with_inputs(
        ["report"],
        "SELECT trim(col0) AS filelastname, trim(col3) AS registryname, nullif(substring(replace(col4, '.', ''), 5, 16), '') AS credentialnumber, "
        "nullif(col5, '') AS credentialstatus, "
        + ", ".join(
            f"{_day(c, '%m/%d/%Y')} AS {d}"
            for c, d in (("col2", "filereceiveddate"), ("col6", "applicationdate"), ("col7", "dateinstructorupdated"), ("col2", "dategraduatedfor70hours"))
        )
        + f", CASE WHEN c_custkey % 2 = 0 THEN '{COMPLETED_FILES[0]}' ELSE '{COMPLETED_FILES[1]}' END AS filename, "
        "CASE WHEN c_custkey % 2 = 0 THEN DATE '2024-06-30' ELSE DATE '2024-07-01' END AS reportdate, "
        "regexp_split_to_array(instructor_text, '\\s+')[1] AS approvedinstructorcode, "
        "regexp_split_to_array(instructor_text, '\\s+')[2] || ' ' || regexp_split_to_array(instructor_text, '\\s+')[3] AS approvedinstructorname "
        "FROM report WHERE segment <> 'BUILDING'",
    ),
)
def completed_report_load(t: Tables):
    path = scratch_dir(t.spark, "completed")
    report = t.input("report")
    head = t.spark.range(-r.PREAMBLE_ROWS, 0).select(
        F.concat(F.lit("Report line "), F.col("id").cast("string")).alias("col0"),
        *[F.lit(None).cast("string").alias(f"col{i}") for i in range(1, 8)],
        *[F.lit(None).cast("string").alias(c) for c in ("instructor_text", "graduated")],
        F.col("id").alias("place"),
    )
    for k, name in enumerate(COMPLETED_FILES):
        drop = head.unionByName(report.filter(F.col("c_custkey") % 2 == k).selectExpr(*COMPLETED_ROWS))
        columns = [c for c in drop.columns if c != "place"]
        export_ordered_file(drop, path, name, ["place"], columns=columns, header=False)
    read = with_file_name(read_delimited(t.spark, path, r.COMPLETED_SCHEMA, header=False, recursive=True))
    loaded = r.load_report(skip_preamble(read, r.PREAMBLE_ROWS), "credential", "Completed File ")
    target = _report(t).filter("segment = 'BUILDING'").select("credentialnumber")
    done = r.finalize_report(loaded, target, "Completed File ", instructor="approvedinstructorcodeandname")
    return done.select(
        "filelastname", "registryname", "credentialnumber", "credentialstatus", "filereceiveddate", "applicationdate",
        "dateinstructorupdated", "dategraduatedfor70hours", "filename", "reportdate", "approvedinstructorcode", "approvedinstructorname",
    )


TRANSITION_ROWS = [
    "'P' || o_custkey AS `providerone ipid`",
    "CAST(o_custkey AS STRING) AS `person id`",
    "CAST(100000000 + o_custkey AS STRING) AS ssn",
    "'Moved' AS category",
    "CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE o_orderpriority END AS `sub category`",
    f"'moves ' || substr({compact_date(ORDER_DAY)}, 5, 4) || substr({compact_date(ORDER_DAY)}, 1, 4) || '.csv' AS filename",
]


@query(
    "transition_load",
    "SELECT 'P' || o_custkey AS providerone_id, CAST(o_custkey AS VARCHAR) AS personid, 'Moved' AS category, "
    "CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_orderpriority END AS subcategory, right(CAST(100000000 + o_custkey AS VARCHAR), 4) AS ssn, "
    f"'moves ' || substr({compact_date(ORDER_DAY)}, 5, 4) || substr({compact_date(ORDER_DAY)}, 1, 4) || '.csv' AS filename, CAST({ORDER_DAY} AS TIMESTAMP) AS filedate FROM orders",
)
def transition_load(t: Tables):
    return r.load_transition(t.orders.selectExpr(*TRANSITION_ROWS), "moves ")


EXAM_ROWS = [
    "CAST(o_custkey AS STRING) AS studentid",
    "'T' || o_custkey AS taxid",
    f"CAST({ORDER_DAY} AS STRING) AS examdate",
    "CASE WHEN o_orderkey % 5 = 0 THEN '' ELSE o_orderstatus END AS examstatus",
    "'Skills' AS examtitlefromprometrics",
    "CAST(o_orderkey % 100 AS STRING) AS randomskill1result",
]


@query(
    "exam_load",
    f"SELECT CAST(o_custkey AS VARCHAR) AS studentid, 'T' || o_custkey AS taxid, CAST({ORDER_DAY} AS VARCHAR) AS examdate, "
    "CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_orderstatus END AS examstatus, 'Skills' AS examtitlefromprometrics, CAST(o_orderkey % 100 AS VARCHAR) AS randomskill1result, "
    "'exam_20240630_101500.TXT' AS filename, TIMESTAMP '2024-06-30 10:15:00' AS filemodifieddate FROM orders",
)
def exam_load(t: Tables):
    path = scratch_dir(t.spark, "exam")
    drop = t.orders.selectExpr(*EXAM_ROWS, "o_orderkey AS place")
    export_ordered_file(drop, path, "exam_20240630_101500.TXT", ["place"], columns=drop.columns[:-1], sep="|")
    read = with_file_name(read_delimited(t.spark, path, sep="|"))
    return r.load_feed(read, r.EXAM, "exam_", "yyyyMMdd_HHmmss", "filemodifieddate")


RELATION_ROWS = [
    "CASE WHEN o_orderkey % 9 = 0 THEN 'n/a' ELSE CAST(o_custkey AS STRING) END AS `provider id`",
    "CAST(o_orderkey + 10000000000 AS STRING) AS `student id`",
    "CAST(100000000 + o_custkey AS STRING) AS `social security number`",
    "o_orderkey || '.125' AS `cumulative career hours`",
    "CASE WHEN o_orderkey % 2 = 0 THEN '' ELSE '12' END AS `monthly hours worked month`",
    "o_orderstatus AS `termination type`",
]


@query(
    "relation_load",
    "SELECT CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE CAST(o_custkey AS INTEGER) END AS provider_id, o_orderkey + 10000000000 AS student_id, "
    "CAST(100000000 + o_custkey AS INTEGER) AS social_security_number, CAST(o_orderkey || '.13' AS DECIMAL(10,2)) AS cumulative_career_hours, "
    "CASE WHEN o_orderkey % 2 = 0 THEN NULL ELSE CAST(12 AS INTEGER) END AS monthly_hours_worked_month, CAST(NULL AS INTEGER) AS termination_type, "
    "'rel_20240630_101500.TXT' AS filename, TIMESTAMP '2024-06-30 10:15:00' AS filemodifieddate FROM orders",
)
def relation_load(t: Tables):
    path = scratch_dir(t.spark, "relation")
    drop = t.orders.selectExpr(*RELATION_ROWS, "o_orderkey AS place")
    export_ordered_file(drop, path, "rel_20240630_101500.TXT", ["place"], columns=drop.columns[:-1], sep="|")
    read = with_file_name(read_delimited(t.spark, path, sep="|"))
    return r.load_feed(read, r.RELATIONSHIP, "rel_", "yyyyMMdd_HHmmss", "filemodifieddate")


@query(
    "error_file_export",
    with_inputs(
        ["provider"],
        "SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, personid, 'providers-' || CAST((SELECT max(filemodifieddate) FROM provider) AS VARCHAR) || '-error.csv' AS export_name "
        "FROM provider WHERE isvalid = 'false'",
    ),
)
def error_file_export(t: Tables):
    loaded = t.input("provider")
    errors = loaded.filter("isvalid = 'false'").select("o_orderkey", "personid")
    path = scratch_dir(t.spark, "errors")
    export_delimited(x.error_export_rows(errors, loaded), path, quote_all=True)
    return read_delimited(t.spark, path, "o_orderkey STRING, personid STRING, export_name STRING")


@query(
    "quarantine_export",
    with_inputs(
        ["person"],
        "SELECT CAST(personid AS VARCHAR) AS personid, CAST(hiredate AS VARCHAR) AS hiredate, lastname FROM person",
    ),
)
def quarantine_export(t: Tables):
    rows = t.input("person").select("personid", "hiredate", "lastname")
    path = scratch_dir(t.spark, "quarantine")
    export_delimited(x.quarantine_rows(rows, ["personid", "hiredate"]), path, quote_all=True, bom=True)
    read = read_delimited(t.spark, path, escape='"')
    return read.toDF(*[n.lstrip("﻿") for n in read.columns])


@query("provider_export", "SELECT CAST(s_suppkey AS VARCHAR) AS col0, s_name AS col1 FROM supplier UNION ALL SELECT CAST(c_custkey AS VARCHAR), c_name FROM customer")
def provider_export(t: Tables):
    rows = t.supplier.select("s_suppkey", "s_name").union(t.customer.select("c_custkey", "c_name"))
    path = scratch_dir(t.spark, "providers")
    export_delimited(rows, path, sep="|", header=False)
    return read_delimited(t.spark, path, names=["col0", "col1"], sep="|")


STATUS_ROWS = [
    "o_custkey + 70000 AS `Employee ID`",
    "o_custkey AS `Person ID`",
    "o_orderstatus AS `Compliance Status`",
    "CAST(o_totalprice AS DECIMAL(10,2)) AS `Credit Hours`",
    f"CAST({ORDER_DAY} AS STRING) AS `Completed Date`",
]


_STATUS_TEXT = ("employeeid", "personid", "compliancestatus", "credithours", "completeddate")
_STATUS_VALUES = (
    "CAST(o_custkey + 70000 AS VARCHAR) AS employeeid, CAST(o_custkey AS VARCHAR) AS personid, o_orderstatus AS compliancestatus, "
    f"CAST(CAST(o_totalprice AS DECIMAL(10,2)) AS VARCHAR) AS credithours, CAST({ORDER_DAY} AS VARCHAR) AS completeddate"
)


@query(
    "trainee_status_export",
    f"SELECT 'export' AS part, {_STATUS_VALUES}, CAST(NULL AS VARCHAR) AS filename FROM orders "
    f"UNION ALL SELECT 'log', {_STATUS_VALUES}, 'Status-2024-06-30.csv' FROM orders",
)
def trainee_status_export(t: Tables):
    # Both halves are read back: the file that is handed out, and the log of what was sent in it.
    rows = m.stringify(t.orders.selectExpr(*STATUS_ROWS), ["Employee ID"])
    path, log = scratch_dir(t.spark, "status"), scratch_dir(t.spark, "status-log")
    export_delimited(rows, path, quote_all=True)
    sent = with_export_name(rows, dates.export_name("Status-", "2024-06-30", "yyyy-MM-dd"))
    append(m.apply_mapping(sent, x.STATUS_LOG), log)
    read = read_delimited(t.spark, path).withColumnsRenamed({c: c.lower().replace(" ", "") for c in rows.columns})
    exported = read.select(F.lit("export").alias("part"), *_STATUS_TEXT, F.lit(None).cast("string").alias("filename"))
    logged = read_table(t.spark, log).select(F.lit("log").alias("part"), *[F.col(c).cast("string") for c in _STATUS_TEXT], "filename")
    return exported.union(logged)

"""Feed-like inputs derived from the test tables.

The expressions are plain SQL read alike by Spark and by the checking engine, so both sides start from the same
rows. All values are invented.
"""

from __future__ import annotations


def us_date(expr: str) -> str:
    """MM/dd/yyyy text of a date expression."""
    d = f"CAST({expr} AS STRING)"
    return f"(substr({d}, 6, 2) || '/' || substr({d}, 9, 2) || '/' || substr({d}, 1, 4))"


def compact_date(expr: str) -> str:
    """yyyyMMdd text of a date expression."""
    d = f"CAST({expr} AS STRING)"
    return f"(substr({d}, 1, 4) || substr({d}, 6, 2) || substr({d}, 9, 2))"


ORDER_DAY = "CAST(o_orderdate AS DATE)"
# Orders run from 1995 to 2001, events through January 2024: move orders next to events.
MOVED_DAY = f"({ORDER_DAY} + 9131)"
DOB = "(DATE '1950-01-01' + CAST((c_custkey * 37) % 24000 AS INT))"

PROGRAM = (
    "CASE {k} % 6 WHEN 0 THEN 'Basic Training 70 Hours' WHEN 1 THEN 'Basic Training 30 Hours' "
    "WHEN 2 THEN 'Basic Training 9 Hours' WHEN 3 THEN 'Continuing Education' "
    "WHEN 4 THEN 'Orientation & Safety' ELSE 'Continuing Education' END"
)
PROGRAM_CODE = "CASE {k} % 6 WHEN 0 THEN '201' WHEN 1 THEN '202' WHEN 2 THEN '203' WHEN 3 THEN '300' WHEN 4 THEN '100' ELSE '300' END"
PROGRAM_HOURS = "CASE {k} % 6 WHEN 0 THEN 70 WHEN 1 THEN 30 WHEN 2 THEN 9 WHEN 3 THEN 12 WHEN 4 THEN 5 ELSE 12 END"

FORM_AGE = "(DATE '1960-01-01' + CAST((o_custkey * 37) % 24000 AS INT))"

INPUTS: dict[str, tuple[str, list[str]]] = {
    "person": (
        "customer",
        [
            "c_custkey AS personid",
            "CASE WHEN c_custkey % 19 = 0 THEN NULL ELSE 500000 + c_custkey END AS cdwaid",
            "CASE WHEN c_custkey % 23 = 0 THEN NULL WHEN c_custkey % 29 = 0 THEN c_custkey ELSE c_custkey + 40 END AS dshsid",
            "'First' || (c_custkey % 40) AS firstname",
            "'Last' || (c_custkey % 90) AS lastname",
            "lpad(CAST(c_custkey % 997 AS STRING), 4, '0') AS ssn",
            f"{DOB} AS dob",
            "CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE 'P' || c_custkey || '@mail.org' END AS email1",
            "CASE WHEN c_custkey % 14 = 0 THEN NULL ELSE 'alt' || c_custkey || '@mail.org' END AS email2",
            "CASE WHEN c_custkey % 31 = 0 THEN NULL WHEN c_custkey % 11 = 0 THEN DATE '2024-01-15' "
            "ELSE DATE '2019-10-01' + CAST(c_custkey % 300 AS INT) END AS hiredate",
            "'1555' || lpad(CAST(c_custkey AS STRING), 7, '0') AS mobilephone",
            "'' || c_custkey || ' Main st' AS mailingstreet1",
            "'town' || (c_custkey % 60) AS mailingcity",
            "'wa' AS mailingstate",
            "lpad(CAST(c_custkey % 99999 AS STRING), 5, '0') AS mailingzip",
            "CASE WHEN c_custkey % 5 = 0 THEN 'Inactive' WHEN c_custkey % 2 = 0 THEN 'ACTIVE' ELSE 'Active' END AS status",
            "'HM' || lpad(CAST(c_custkey AS STRING), 8, '0') AS credentialnumber",
        ],
    ),
    "requirement": (
        "orders",
        [
            "o_custkey AS personid",
            "o_orderkey AS trainingid",
            f"{PROGRAM.format(k='o_orderkey')} AS trainingprogram",
            f"{PROGRAM_CODE.format(k='o_orderkey')} AS trainingprogramcode",
            f"{MOVED_DAY} AS trackingdate",
            f"{MOVED_DAY} + CAST(300 + o_orderkey % 900 AS INT) AS duedate",
            f"CASE WHEN o_orderkey % 4 = 0 THEN {MOVED_DAY} + 1500 ELSE NULL END AS duedateextension",
            f"CAST({PROGRAM_HOURS.format(k='o_orderkey')} AS DOUBLE) AS requiredhours",
            "CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE CAST(o_orderkey % 3 AS DOUBLE) END AS earnedhours",
            "CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE CAST(o_orderkey % 2 AS DOUBLE) END AS transferredhours",
            f"CASE WHEN o_orderstatus = 'O' THEN NULL ELSE {MOVED_DAY} + CAST(o_orderkey % 1300 AS INT) END AS completeddate",
            "CASE o_orderstatus WHEN 'F' THEN 'closed' WHEN 'O' THEN 'active' ELSE 'Active' END AS status",
        ],
    ),
    # The student extracts need people with both a safety and a basic requirement.
    "student_requirement": (
        "orders",
        [
            "o_custkey AS personid",
            "o_orderkey AS trainingid",
            "CASE o_orderkey % 3 WHEN 0 THEN 'Orientation & Safety' WHEN 1 THEN 'Basic Training 70 Hours' ELSE 'Continuing Education' END AS trainingprogram",
            "CASE o_orderkey % 3 WHEN 0 THEN '100' WHEN 1 THEN '201' ELSE '300' END AS trainingprogramcode",
            f"{ORDER_DAY} + 6600 AS trackingdate",
            f"{ORDER_DAY} + 6720 AS duedate",
            f"CASE WHEN o_orderstatus = 'O' THEN NULL ELSE {ORDER_DAY} + CAST(6600 + o_orderkey % 240 AS INT) END AS completeddate",
            "CASE o_orderkey % 3 WHEN 0 THEN 5.0e0 WHEN 1 THEN (CASE WHEN o_orderkey % 4 = 0 THEN 35.0e0 ELSE 70.0e0 END) ELSE 12.0e0 END AS earnedhours",
        ],
    ),
    "transfer_history": (
        "orders",
        [
            "o_custkey AS personid",
            f"{PROGRAM.format(k='o_custkey')} AS trainingprogram",
            f"CAST({PROGRAM_HOURS.format(k='o_custkey')} - o_orderkey % 4 AS DOUBLE) AS transferhours",
            "CASE WHEN o_orderkey % 3 = 0 THEN 'CE' || (o_custkey % 9) || '0' ELSE NULL END AS coursecode",
        ],
    ),
    "transfer": (
        "events",
        [
            "event_id",
            "user_id + 70000 AS employeeid",
            "CASE WHEN event_id % 97 = 0 THEN NULL ELSE user_id END AS personid",
            f"CASE WHEN event_id % 53 = 0 THEN 'Unknown Program' ELSE {PROGRAM.format(k='(user_id + event_id % 5)')} END AS trainingprogram",
            "event_type || ' class' AS classname",
            "'CE' || (event_id % 9) || '0' AS coursecode",
            f"CASE WHEN event_id % 10 = 9 THEN CAST(event_id % 15 AS STRING) WHEN event_id % 61 = 0 THEN 'n/a' WHEN event_id % 10 < 5 "
            f"THEN CAST({PROGRAM_HOURS.format(k='(user_id + event_id % 5)')} AS STRING) "
            f"ELSE CAST({PROGRAM_HOURS.format(k='(user_id + event_id % 5)')} - event_id % 4 AS STRING) END AS credithours",
            "CAST(ts AS DATE) AS completeddate",
            "CASE WHEN event_id % 41 = 0 THEN 'false' ELSE 'true' END AS isvalid",
            "'transfers-' || CAST(CAST(ts AS DATE) AS STRING) || '.csv' AS filename",
        ],
    ),
    "survey": (
        "events",
        [
            "event_id",
            "event_type",
            "user_id AS personid",
            "CASE WHEN event_id % 20 < 18 THEN "
            f"' ' || ({PROGRAM.format(k='(user_id + event_id % 5)')}) || "
            "(CASE (user_id + event_id % 5) % 6 WHEN 0 THEN ' (BT70)' WHEN 1 THEN ' (BT30)' WHEN 2 THEN ' (BT9)' WHEN 4 THEN ' (O&S)' ELSE ' (CE)' END) "
            "WHEN event_id % 20 = 18 THEN 'Basic Training 7 Hours (BT7)' ELSE 'no marker' END AS course_name",
            "CASE event_id % 5 WHEN 0 THEN '#CE12' WHEN 1 THEN 'CE' || (user_id % 9) || '0' WHEN 2 THEN NULL WHEN 3 THEN 'xxNF7' ELSE 'plain' END AS code_text",
            f"CASE WHEN event_id % 10 = 9 THEN CAST(event_id % 15 AS STRING) "
            f"ELSE CAST({PROGRAM_HOURS.format(k='(user_id + event_id % 5)')} - (event_id % 3) AS STRING) END AS credithours",
            "CAST(ts AS DATE) AS completed_date",
            "CASE WHEN event_id % 13 = 0 THEN 'False' ELSE 'True' END AS finished",
            "CASE event_id % 4 WHEN 0 THEN 'class a' WHEN 1 THEN 'class b' WHEN 2 THEN 'class c' END AS continuing_education_information_1",
        ],
    ),
    "program_catalog": (
        "part",
        [
            f"CASE WHEN p_partkey % 7 = 6 THEN 'Basic Training 7 Hours' ELSE {PROGRAM.format(k='(p_partkey % 7)')} END AS trainingprogramtype",
            f"CASE WHEN p_partkey % 7 = 6 THEN '204' WHEN p_partkey % 14 = 3 THEN '603' ELSE {PROGRAM_CODE.format(k='(p_partkey % 7)')} END AS trainingprogramcode",
        ],
    ),
    "catalog": (
        "part",
        [
            "p_name || '  ' AS coursename",
            "CASE WHEN length(p_name) % 2 = 0 THEN 'EN' ELSE 'ES' END AS courselanguage",
            "'C' || (length(p_name) % 3) AS trainingprogramcode",
            "p_type AS trainingprogramtype",
            "CASE WHEN p_size % 2 = 0 THEN 'ILT' ELSE 'ONL' END AS coursetype",
            "lpad(CAST(p_partkey AS STRING), 9, '0') AS courseid",
            "CAST(p_size AS DOUBLE) AS credithours",
            "'D' || p_partkey AS dshscourseid",
        ],
    ),
    "instructor": (
        "supplier",
        [
            "' ' || s_name || ' ' AS firstname",
            "'N' || s_nationkey || ' ' AS lastname",
            "'I' || s_suppkey AS instructorid",
            "CASE WHEN s_suppkey % 4 = 0 THEN 'false' ELSE 'true' END AS isactive",
        ],
    ),
    "intake_form": (
        "orders",
        [
            "'R_' || o_orderkey AS responseid",
            "CASE WHEN o_orderkey % 37 = 0 THEN NULL WHEN o_orderkey % 3 = 0 THEN '2' WHEN o_orderkey % 41 = 0 THEN '9' ELSE '1' END AS cg_status",
            "CASE WHEN o_orderkey % 10 = 0 THEN false ELSE true END AS isdelta",
            "CASE WHEN o_orderkey % 43 = 0 THEN NULL ELSE 'First' || (o_custkey % 40) END AS newhire_person_firstname",
            "'M' || (o_custkey % 5) AS newhire_person_middlename",
            "'Last' || (o_custkey % 90) AS newhire_person_lastname",
            "CASE WHEN o_orderkey % 11 = 0 THEN NULL WHEN o_orderkey % 17 = 0 THEN 'bad mail@x' ELSE 'n' || o_custkey || '@mail.org' END AS newhire_person_email1",
            "CASE WHEN o_orderkey % 19 = 0 THEN 'none' ELSE '(206) 555-' || lpad(CAST(o_custkey % 9999 AS STRING), 4, '0') END AS newhire_person_phone1",
            "CASE WHEN o_orderkey % 23 = 0 THEN NULL ELSE '206555' || lpad(CAST(o_custkey % 9999 AS STRING), 4, '0') END AS newhire_person_phone2",
            "CAST(o_custkey % 997 AS STRING) AS newhire_person_ssn",
            f"CASE o_orderkey % 4 WHEN 0 THEN {us_date(FORM_AGE)} WHEN 1 THEN replace({us_date(FORM_AGE)}, '/', '-') "
            f"WHEN 2 THEN replace({us_date(FORM_AGE)}, '/', '') ELSE {us_date(FORM_AGE)} END AS newhire_person_dob",
            "'' || o_custkey || ' Oak' AS newhire_person_street",
            "CASE WHEN o_orderkey % 29 = 0 THEN NULL ELSE 'city' || (o_custkey % 60) END AS newhire_person_city",
            "'WA' AS newhire_person_state",
            "'98' || lpad(CAST(o_custkey % 999 AS STRING), 3, '0') AS newhire_person_zipcode",
            "CASE WHEN o_orderkey % 5 = 0 THEN 'first' || (o_custkey % 40) ELSE 'Other' END AS terminated_person_firstname",
            "CAST(NULL AS STRING) AS terminated_person_middlename",
            "CASE WHEN o_orderkey % 7 < 4 THEN 'LAST' || (o_custkey % 90) ELSE 'Other' END AS terminated_person_lastname",
            "CASE WHEN o_orderkey % 8 = 0 THEN 'P' || o_custkey || '@mail.org' ELSE NULL END AS terminated_person_email",
            "CASE WHEN o_orderkey % 31 = 0 THEN '123' ELSE '12065550000' END AS terminated_person_phone",
            "CASE WHEN o_orderkey % 4 = 0 THEN CAST(o_custkey % 997 AS STRING) ELSE '8888' END AS terminated_person_ssn",
            f"CASE WHEN o_orderkey % 6 = 0 THEN {us_date(DOB.replace('c_custkey', 'o_custkey'))} ELSE '02/30/1970' END AS terminated_person_dob",
            "'' || o_custkey || ' Elm' AS terminated_person_street",
            "'Port' AS terminated_person_city",
            "'WA' AS terminated_person_state",
            "'98000' AS terminated_person_zipcode",
            "CASE WHEN o_orderkey % 13 = 0 THEN NULL WHEN o_orderkey % 9 = 0 THEN CAST(o_custkey + 90000000 AS STRING) ELSE CAST(o_custkey AS STRING) END AS terminated_person_id",
            f"CASE WHEN o_orderkey % 12 = 0 THEN NULL WHEN o_orderkey % 2 = 0 THEN {us_date(MOVED_DAY)} ELSE CAST({MOVED_DAY} AS STRING) END AS person_termination_date",
            f"CASE WHEN o_orderkey % 14 = 0 THEN '' WHEN o_orderkey % 2 = 0 THEN {us_date(MOVED_DAY)} ELSE replace({us_date(MOVED_DAY)}, '/', '-') END AS person_hire_date",
            "CAST(o_orderkey % 17 AS STRING) AS employername",
            "CAST(o_orderkey % 19 AS STRING) AS preferredlanguage",
            "'EN' AS userlanguage",
            "CAST(o_orderkey % 2 AS STRING) AS exempt",
            f"CAST({MOVED_DAY} AS DATE) AS filemodifieddate",
        ],
    ),
    "provider": (
        "orders",
        [
            "o_orderkey",
            "CAST(o_custkey AS STRING) AS personid",
            "CASE WHEN o_orderkey % 31 = 0 THEN NULL WHEN o_orderkey % 37 = 0 THEN '12345' WHEN o_orderkey % 41 = 0 THEN '1234567890' "
            "WHEN o_orderkey % 101 = 0 THEN CAST(100000000 + o_custkey + 1 AS STRING) ELSE CAST(100000000 + o_custkey AS STRING) END AS ssn",
            "CASE WHEN o_orderkey % 15 = 0 THEN 'false' ELSE 'true' END AS isvalid",
            "'F' || (o_custkey % 40) AS first_name",
            "CASE WHEN o_custkey % 3 = 0 THEN NULL ELSE 'M' END AS middle_name",
            "'L' || (o_custkey % 90) AS last_name",
            f"CASE WHEN o_orderkey % 21 = 0 THEN '2019' ELSE {compact_date(FORM_AGE)} END AS dob",
            "'p' || o_custkey || '@mail.org' AS email",
            "CASE WHEN o_orderkey % 9 = 0 THEN '555-1234' ELSE '+1 (206) 555-' || lpad(CAST(o_custkey % 9999 AS STRING), 4, '0') END AS phone_1",
            "CASE WHEN o_orderkey % 8 = 0 THEN NULL ELSE '206.555.' || lpad(CAST(o_custkey % 9999 AS STRING), 4, '0') END AS phone_2",
            "'English' AS language",
            "'Standard' AS employee_classification",
            "CASE WHEN o_orderkey % 2 = 0 THEN 'Yes' ELSE 'No' END AS exempt_status",
            "CASE o_orderkey % 3 WHEN 0 THEN '1' WHEN 1 THEN '0' ELSE NULL END AS ahcas_eligible",
            "CASE o_orderkey % 3 WHEN 0 THEN 'true' WHEN 1 THEN 'false' ELSE NULL END AS carina_eligible",
            f"{compact_date(MOVED_DAY)} AS hire_date",
            f"{compact_date(ORDER_DAY)} AS classification_start_date",
            f"CASE WHEN o_orderkey % 6 = 0 THEN '' ELSE {compact_date(ORDER_DAY)} END AS background_check_date",
            f"CASE WHEN o_orderkey % 6 = 1 THEN '20201340' ELSE {compact_date(ORDER_DAY)} END AS ie_date",
            "CAST(o_custkey + 70000 AS STRING) AS employee_id",
            "'' || o_custkey || ' Oak' AS physical_add_1",
            "'city' AS physical_city",
            "'wash' AS physical_state",
            "'98001' AS physical_zip",
            "CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE '' || o_custkey || ' Elm' END AS mailing_add_1",
            "'apt ' || (o_custkey % 9) AS mailing_add_2",
            "'city' AS mailing_city",
            "'wash' AS mailing_state",
            "'98002' AS mailing_zip",
            "CASE WHEN o_orderkey % 12 = 0 THEN ' ' ELSE ' ' || o_orderkey || ' ' END AS client_id",
            f"'providers-' || CAST({MOVED_DAY} AS STRING) || '.csv' AS filename",
            f"{MOVED_DAY} AS filemodifieddate",
        ],
    ),
    "crosswalk": (
        "customer",
        [
            "CASE WHEN c_custkey % 59 = 0 THEN NULL ELSE c_custkey + 3 END AS personid",
            "c_custkey AS cdwaid",
            "CASE WHEN c_custkey % 61 = 0 THEN '12345' WHEN c_custkey % 67 = 0 THEN CAST(1000000 + c_custkey AS STRING) "
            "ELSE CAST(100000000 + c_custkey AS STRING) END AS ssn",
        ],
    ),
    "known_crosswalk": ("customer", ["c_custkey AS cdwaid", "c_mktsegment AS segment"]),
    "credential": (
        "customer",
        [
            "'HM' || lpad(CAST(c_custkey AS STRING), 8, '0') AS credentialnumber",
            "CASE WHEN c_custkey % 6 = 0 THEN 'NA' WHEN c_custkey % 6 = 1 THEN 'hm' ELSE 'HM' END AS credentialtype",
            "CASE WHEN c_custkey % 4 = 0 THEN 'Active' WHEN c_custkey % 4 = 1 THEN 'Pending' ELSE 'PENDING' END AS credentialstatus",
            "CASE WHEN c_custkey % 8 = 0 THEN 0 ELSE 1 END AS primarycredential",
        ],
    ),
    "reported": (
        "customer",
        ["CASE WHEN c_custkey % 10 = 0 THEN 'HM' || lpad(CAST(c_custkey AS STRING), 8, '0') ELSE NULL END AS credentialnumber"],
    ),
    "relation": (
        "orders",
        [
            "o_custkey AS personid",
            "CAST(o_orderkey % 50 AS STRING) AS employerid",
            "CASE o_orderstatus WHEN 'F' THEN 'Terminated' WHEN 'O' THEN 'Active' ELSE 'ACTIVE' END AS empstatus",
        ],
    ),
    "employer": ("supplier", ["s_suppkey AS employerid", "s_name AS employername"]),
    "employertrust": ("supplier", ["s_suppkey AS employerid", "CASE WHEN s_suppkey % 3 = 0 THEN 'tp' ELSE 'other' END AS trust"]),
    "transcript": (
        "orders",
        [
            "o_custkey AS personid",
            "CASE WHEN o_orderkey % 2 = 0 THEN '201' ELSE '300' END AS trainingprogramcode",
            "'I' || (o_orderkey % 90) AS instructorid",
            "'Name ' || (o_orderkey % 90) AS instructorname",
            f"CASE WHEN o_orderkey % 4 = 0 THEN CAST({MOVED_DAY} AS STRING) ELSE CAST({MOVED_DAY} AS STRING) || ' 10:00:00' END AS completeddate",
        ],
    ),
    "number": (
        "customer",
        [
            "CASE WHEN c_custkey % 13 = 0 THEN NULL ELSE c_custkey END AS personid",
            "CASE WHEN c_custkey % 17 = 0 THEN NULL ELSE 'HM' || lpad(CAST(c_custkey AS STRING), 8, '0') END AS credentialnumber",
        ],
    ),
    "history": (
        "lineitem",
        [
            "CASE WHEN l_orderkey % 43 = 0 THEN NULL ELSE l_orderkey END AS personid",
            "CASE WHEN l_partkey % 47 = 0 THEN NULL WHEN l_partkey % 53 = 0 THEN 'SHORT' "
            "ELSE (CASE WHEN l_partkey % 2 = 0 THEN 'crs' ELSE 'CRS' END) || (l_suppkey % 4) || ' V' || lpad(CAST(l_linenumber AS STRING), 6, '0') END AS courseid",
            "CAST(l_shipdate AS DATE) AS completeddate",
            "l_quantity AS credithours",
            "l_partkey AS partkey",
            "l_suppkey AS suppkey",
        ],
    ),
    "taken": (
        "orders",
        [
            "CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_orderkey END AS personid",
            "CASE WHEN o_custkey % 11 = 0 THEN NULL ELSE 'Crs' || (o_custkey % 4) || ' X' || lpad(CAST(o_custkey % 10 AS STRING), 6, '0') END AS courseid",
        ],
    ),
    "safety_form": (
        "orders",
        [
            "o_orderkey",
            "o_orderpriority",
            "CASE WHEN o_orderkey % 71 = 0 THEN 'abc' WHEN o_orderkey % 73 = 0 THEN NULL ELSE CAST(o_custkey AS STRING) END AS form_id",
            f"CASE o_orderkey % 5 WHEN 0 THEN {us_date(ORDER_DAY)} WHEN 1 THEN replace({us_date(ORDER_DAY)}, '/', '-') "
            f"WHEN 2 THEN CAST({ORDER_DAY} AS STRING) WHEN 3 THEN replace({us_date(ORDER_DAY)}, '/', '') ELSE 'soon' END AS completion_date",
            "CASE WHEN o_orderkey % 3 = 0 THEN '0' ELSE '1' END AS finished",
            "CASE WHEN o_orderkey % 4 = 0 THEN 'false' ELSE 'true' END AS isdelta",
            f"{ORDER_DAY} + CAST(o_orderkey % 3 AS INT) AS filemodifieddate",
        ],
    ),
    "lms": (
        "lineitem",
        [
            "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
            "CASE WHEN l_orderkey % 29 = 0 THEN 'x' || l_orderkey WHEN l_orderkey % 31 = 0 THEN '' ELSE CAST(l_orderkey AS STRING) END AS person_id",
            "CASE WHEN l_partkey % 37 = 0 THEN '' ELSE 'Course ' || (l_partkey % 3) END AS course_title",
            f"CASE WHEN l_linenumber = 7 THEN '' ELSE CAST(CAST(l_shipdate AS DATE) AS STRING) END AS completion_date",
            f"{us_date('CAST(l_shipdate AS DATE)')} AS registration_date",
            "CASE WHEN l_returnflag = 'R' THEN 'Failed' ELSE 'Passed' END AS status",
        ],
    ),
    "sheet": (
        "lineitem",
        [
            "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_linestatus",
            "CASE WHEN l_orderkey % 29 = 0 THEN 'x' || l_orderkey WHEN l_orderkey % 31 = 0 THEN '1234567890123' ELSE CAST(l_orderkey AS STRING) END AS learner_id",
            "'K' || (l_partkey % 3) AS class_id",
            "'Class ' || (l_partkey % 3) AS class_title",
            f"CASE WHEN l_linenumber = 7 THEN '' ELSE {us_date('CAST(l_shipdate AS DATE)')} END AS date_text",
            "CAST(l_shipdate AS DATE) AS date",
            "CASE WHEN l_returnflag = 'R' THEN 'Absent' ELSE 'Attended' END AS attendance",
            "'sheet-' || CASE WHEN l_suppkey % 13 = 0 THEN 'latest' ELSE " + compact_date("(DATE '2023-01-01' + CAST(l_suppkey % 30 AS INT))") + " END AS sheet_name",
            "'O''Neil ' || l_suppkey AS instructor",
        ],
    ),
    "named_completion": (
        "lineitem",
        [
            "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
            "CAST(l_orderkey % 3000 AS STRING) AS learner_id",
            "' LAST' || (l_orderkey % 3000 % 90) || ' ' AS last_name",
            "CASE WHEN l_partkey % 5 = 0 THEN 'other@mail.org' ELSE 'p' || (l_orderkey % 3000) || '@MAIL.org' END AS learner_email",
            "'Class ' || (l_partkey % 6) AS class_title",
            "CAST(l_shipdate AS DATE) AS date",
        ],
    ),
    "report": (
        "customer",
        [
            "c_custkey",
            "c_mktsegment AS segment",
            "' Last' || c_custkey AS col0",
            "'First' AS col1",
            f"{us_date(DOB)} AS col2",
            "' Registry' AS col3",
            "'HMC.' || lpad(CAST(c_custkey AS STRING), 8, '0') || '.X' AS col4",
            "CASE WHEN c_custkey % 9 = 0 THEN '' ELSE 'Pending' END AS col5",
            f"CASE WHEN c_custkey % 7 = 0 THEN 'unknown' ELSE {us_date(DOB)} END AS col6",
            f"{us_date(DOB)} AS col7",
            "'In' || c_custkey || '  Ann   Lee x' AS instructor_text",
            f"'Classified File ' || {compact_date(DOB)} || '123000.csv' AS filename",
        ],
    ),
}

"""Outbound extracts: student lists, protected ids, error and status files."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.dates import error_name, parse_date
from ..functions.hashing import reveal_column
from ..functions.text import pad_id
from ..operators.aggregate import concat_distinct, latest_batch
from ..operators.mapping import stringify
from ..operators.ranking import keep_first
from ..operators.relate import anti

# Column -> report heading, in report order.
STUDENT_HEADINGS = {
    "personid": "Student ID",
    "lastname": "Last Name",
    "firstname": "First Name",
    "ssn": "Social Security Number (Last 4)",
    "birthdate": "Birthdate",
    "mailingstreet1": "Mailing Street",
    "mailingcity": "Mailing City",
    "mailingstate": "Mailing State",
    "mailingzip": "Mailing Zip/Postal Code",
    "county": "County",
    "mobilephone": "Phone1",
    "activeemployers": "Active Employer(s)",
    "bttrackingdate": "Tracking Date",
    "btduedate": "Due Date",
    "osearnedhours": "Safety & Orientation Hours Completed",
    "oscompleted": "Safety & Orientation Completed On",
    "btearnedhours": "Basic Training Hours Completed",
    "btcompleted": "Basic Training Completed On",
    "trainingprogramcode": "Training Program Code",
    "trainingprogramname": "Training Program Name",
    "btinstructorid": "Last Instructor ID",
    "btinstructorname": "Last Instructor Name",
    "credentialnumber": "HCA Credential Number",
}

# Programs, hours and first tracking date of the student extracts.
SAFETY_CODE, SAFETY_HOURS = "100", 5
BASIC_CODE, BASIC_HOURS = "201", 70
TRACKED_FROM = "2013-09-01"
REPORT_PROGRAM_CODE = "0001"
REPORT_DATE = "MM/dd/yyyy"


def pending_credentials(credentials: DataFrame, reported: DataFrame, kind: str = "HM") -> DataFrame:
    """Primary credentials of one type that are pending and not reported yet."""
    pending = (
        (F.upper("credentialtype") == kind)
        & (F.col("primarycredential") == 1)
        & (F.upper("credentialstatus") == "PENDING")
    )
    return anti(credentials.filter(pending), reported, ["credentialnumber"])


def active_employers(relations: DataFrame, employers: DataFrame, trusts: DataFrame, trust: str) -> DataFrame:
    """Per person the distinct names of active employers in one trust, sorted and joined by commas."""
    inside = trusts.filter(F.upper("trust") == trust.upper()).select("employerid")
    named = employers.select("employerid", "employername").join(inside, "employerid", "left_semi")
    active = relations.filter(F.upper("empstatus") == "ACTIVE").select(
        F.col("employerid").try_cast("bigint").alias("employerid"), "personid"
    )
    return concat_distinct(active.join(named, "employerid"), ["personid"], "employername", "activeemployers")


def _newest(requirements: DataFrame, kinds: Mapping[str, tuple[Column, Sequence[str]]]) -> DataFrame:
    """Persons with a requirement of every kind, and columns of the newest of each, in one pass. Nulls are oldest."""
    order = F.struct("trainingid", "completeddate")
    newest = [F.max_by(F.struct(*cols), F.when(keep, order)).alias(kind) for kind, (keep, cols) in kinds.items()]
    wanted = reduce(or_, [keep for keep, _ in kinds.values()])
    both = requirements.filter(wanted).groupBy("personid").agg(*newest).dropna(subset=list(kinds))
    return both.select("personid", *[F.col(f"{k}.{c}").alias(f"{k}_{c}") for k, (_, cols) in kinds.items() for c in cols])


def student_extract(
    person: DataFrame,
    employers: DataFrame,
    requirements: DataFrame,
    transcript: DataFrame,
    numbers: DataFrame,
    credentials: DataFrame,
    kind: str,
    program_name: str = "Training Program",
) -> DataFrame:
    """Active students with a pending credential and completed safety training.

    ``kind='open'`` takes those whose newest 70-hour training is open or was completed late, ``'completed'`` those
    who completed it on time. ``employers`` comes from ``active_employers``, ``credentials`` from
    ``pending_credentials``, ``numbers`` holds (credentialnumber, personid).
    """
    done, due = F.col("completeddate"), F.col("duedate")
    full = F.col("earnedhours") == BASIC_HOURS
    if kind == "open":
        state = done.isNull() | ((done > due) & full)
    elif kind == "completed":
        state = done.isNotNull() & (done <= due) & full
    else:
        raise ValueError(f"unknown kind {kind!r}")
    basic = (F.col("trainingprogramcode") == BASIC_CODE) & (F.col("trackingdate") >= F.lit(TRACKED_FROM).cast("date")) & state
    safety = (F.col("trainingprogramcode") == SAFETY_CODE) & done.isNotNull() & (F.col("earnedhours") == SAFETY_HOURS)
    trained = _newest(
        requirements,
        {
            "bt": (basic, ["duedate", "completeddate", "earnedhours", "trackingdate"]),
            "os": (safety, ["completeddate", "earnedhours"]),
        },
    )
    teacher = keep_first(
        transcript.filter(F.col("trainingprogramcode") == BASIC_CODE).select(
            "personid", "instructorid", "instructorname", "completeddate"
        ),
        ["personid"],
        [F.col("completeddate").desc_nulls_last(), F.col("instructorid"), F.col("instructorname")],
    ).drop("completeddate")
    owned = numbers.select("credentialnumber", "personid").dropna().distinct()
    pending = owned.join(credentials.select("credentialnumber").distinct(), "credentialnumber")
    active = person.filter(F.upper("status") == "ACTIVE").drop("credentialnumber")

    star = (
        active.join(trained, "personid")
        .join(employers, "personid")
        .join(pending, "personid")
        .join(teacher, "personid", "left")
    )

    def day(c: str) -> Column:
        return F.date_format(c, REPORT_DATE)

    taught = F.lit(True) if kind == "completed" else F.col("bt_earnedhours") == BASIC_HOURS
    hours = F.col("bt_earnedhours").cast("int") if kind == "completed" else F.coalesce("bt_earnedhours", F.lit(0.0))
    return star.select(
        "personid",
        "lastname",
        "firstname",
        F.right("ssn", F.lit(4)).alias("ssn"),
        day("dob").alias("birthdate"),
        F.upper("mailingstreet1").alias("mailingstreet1"),
        F.upper("mailingcity").alias("mailingcity"),
        F.upper("mailingstate").alias("mailingstate"),
        "mailingzip",
        F.lit(None).cast("string").alias("county"),
        "mobilephone",
        "activeemployers",
        day("bt_trackingdate").alias("bttrackingdate"),
        day("bt_duedate").alias("btduedate"),
        F.col("os_earnedhours").cast("int").alias("osearnedhours"),
        day("os_completeddate").alias("oscompleted"),
        hours.alias("btearnedhours"),
        day("bt_completeddate").alias("btcompleted"),
        F.lit(REPORT_PROGRAM_CODE).alias("trainingprogramcode"),
        F.lit(program_name).alias("trainingprogramname"),
        F.when(taught, F.col("instructorid")).alias("btinstructorid"),
        F.when(taught, F.col("instructorname")).alias("btinstructorname"),
        "credentialnumber",
    ).distinct()


def transcript_dates(transcript: DataFrame) -> DataFrame:
    """Transcript with its text dates parsed."""
    c = F.col("completeddate").cast("string")
    return transcript.withColumn("completeddate", parse_date(F.substring(c, 1, 10), "yyyy-MM-dd"))


def id_extract(crosswalk: DataFrame, key: str) -> DataFrame:
    """Distinct (person id, nine-digit id) of known persons whose revealed id has at least seven characters."""
    open_ids = reveal_column(crosswalk, "fullssn", key)
    kept = open_ids.filter("length(fullssn) >= 7 AND personid IS NOT NULL")
    return kept.select("personid", pad_id("fullssn", 9).alias("fullssn")).distinct()


def error_export_rows(rows: DataFrame, loaded: DataFrame, name: str = "filename", date: str = "filemodifieddate") -> DataFrame:
    """Rows of the error view with the export file name built from the newest loaded file."""
    newest = latest_batch(loaded, date).agg(F.min(error_name(F.col(name)))).scalar()
    return rows.withColumn("export_name", newest)


def quarantine_rows(df: DataFrame, text: Sequence[str]) -> DataFrame:
    """Quarantined persons with ids and dates as text, as the export writes them."""
    return stringify(df, text)


# Columns of the log of sent status rows.
STATUS_LOG = [
    ("employee id", "string", "employeeid", "string"),
    ("person id", "bigint", "personid", "bigint"),
    ("compliance status", "string", "compliancestatus", "string"),
    ("training exempt", "string", "trainingexempt", "string"),
    ("training program", "string", "trainingprogram", "string"),
    ("training program status", "string", "trainingstatus", "string"),
    ("class name", "string", "classname", "string"),
    ("dshs course code", "string", "dshscoursecode", "string"),
    ("credit hours", "decimal", "credithours", "decimal"),
    ("completed date", "string", "completeddate", "date"),
    ("filename", "string", "filename", "string"),
]

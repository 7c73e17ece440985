"""The raw feeds: their columns, and the load that turns each delimited drop into a typed raw table.

A feed is declared by its headings. A target name is the heading in lower case with its words joined, a type is
text, unless the feed says otherwise.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.dates import parse_date
from ..functions.text import field, last4
from ..operators.delta import flag_delta
from ..operators.mapping import apply_mapping, blank_to_null, trim_all
from ..snapshots import latest, publish, read_snapshot
from ..sources.files import clean_headers
from .completions import clean_lms_completions, clean_sheet_completions
from .people import clean_provider_rows, identity_conflicts, match_terminated
from .reports import load_feed
from .transfers import resolve_person

MappingList = list[tuple[str, str, str, str]]


def feed_mapping(
    headings: Sequence[str],
    types: Mapping[str, str] | None = None,
    names: Mapping[str, str] | None = None,
    joiner: str = "_",
) -> MappingList:
    """Mapping of a feed from its headings; ``types`` and ``names`` are keyed by heading."""
    out = []
    for heading in headings:
        words = re.findall("[a-z0-9]+", heading.lower().replace("&", ""))
        out.append((heading, "string", (names or {}).get(heading, joiner.join(words)), (types or {}).get(heading, "string")))
    return out


FILE_COLUMNS: MappingList = [
    ("filename", "string", "filename", "string"),
    ("filemodifieddate", "timestamp", "filemodifieddate", "timestamp"),
]

# Columns every survey export brings.
SURVEY_HEADINGS = (
    "StartDate", "EndDate", "Status", "IPAddress", "Progress", "Duration (in seconds)", "Finished", "RecordedDate",
    "ResponseId", "RecipientLastName", "RecipientFirstName", "RecipientEmail", "ExternalReference", "LocationLatitude",
    "LocationLongitude", "DistributionChannel", "UserLanguage", "Q_RecaptchaScore",
)

# Question -> column of the intake form. The status question feeds two columns.
INTAKE_QUESTIONS = {
    "Q2": "preferredlanguage",
    "Q3": "cg_status",
    "Q5_1": "agency_firstname",
    "Q5_2": "agency_lastname",
    "Q5_3": "agency_email",
    "Q5_4": "agency_phone",
    "Q8_1": "newhire_person_firstname",
    "Q8_2": "newhire_person_middlename",
    "Q8_3": "newhire_person_lastname",
    "Q8_4": "newhire_person_dob",
    "Q8_5": "newhire_person_ssn",
    "Q9_1": "newhire_person_phone1",
    "Q9_2": "newhire_person_phone2",
    "Q9_3": "newhire_person_phone3",
    "Q9_4": "newhire_person_email1",
    "Q9_5": "newhire_person_email2",
    "Q10_1": "newhire_person_street",
    "Q10_2": "newhire_person_city",
    "Q10_3": "newhire_person_state",
    "Q10_4": "newhire_person_zipcode",
    "Q14": "employername",
    "Q21": "exempt",
    "Q22": "person_workercategory",
    "Q26_1": "terminated_person_firstname",
    "Q26_2": "terminated_person_middlename",
    "Q26_3": "terminated_person_lastname",
    "Q26_4": "terminated_person_dob",
    "Q26_6": "terminated_person_ssn",
    "Q26_7": "terminated_person_id",
    "Q27_1": "terminated_person_phone",
    "Q27_2": "terminated_person_email",
    "Q28_1": "terminated_person_street",
    "Q28_2": "terminated_person_city",
    "Q28_3": "terminated_person_state",
    "Q28_4": "terminated_person_zipcode",
    "Q31": "person_termination_date",
    "Q33": "newhire_personemployerbranch",
    "Q35": "terminated_person_employerbranch",
    "Q40": "person_hire_date",
}
INTAKE = (
    feed_mapping([*SURVEY_HEADINGS, *INTAKE_QUESTIONS], names=INTAKE_QUESTIONS)
    + [("Q3", "string", "person_emp_status", "string")]
    + FILE_COLUMNS
)

# Question -> column of the safety-training forms; only one of the two ids is asked.
SAFETY_QUESTIONS = {
    "Q2_1": "agency_firstname",
    "Q2_2": "agency_lastname",
    "Q2_3": "agency_email",
    "Q4": "employername",
    "Q5_1": "person_firstname",
    "Q5_2": "person_lastname",
    "Q5_3": "person_dob",
    "Q5_4": "person_phone",
    "Q5_5": "dshs_id",
    "Q5_8": "person_id",
    "Q13": "os_completion_date",
}
SAFETY_FORM = feed_mapping([*SURVEY_HEADINGS, *SAFETY_QUESTIONS], names=SAFETY_QUESTIONS) + FILE_COLUMNS

# Question -> column of the transfer survey.
TRANSFER_QUESTIONS = {
    "id": "personid",
    "vertical": "course_name",
    "reason": "reasonfortransfer",
    "ce_1": "continuing_education_information_1",
    "ce_2": "continuing_education_information_2",
    "completion_date": "completed_date",
    "entity2_1": "trainingentity",
    "hours": "credithours",
    "employer": "employer",
    "staff": "employerstaff",
    "comments": "additional_comments",
    "form_completed_date": "form_completed_date",
}
TRANSFER_SURVEY = (
    feed_mapping(
        [*SURVEY_HEADINGS[:-1], *TRANSFER_QUESTIONS],
        types={"StartDate": "timestamp", "EndDate": "timestamp", "RecordedDate": "timestamp", "id": "bigint"},
        names=TRANSFER_QUESTIONS,
    )
    + FILE_COLUMNS
)

# Columns of the provider feed and those that are numbers (dates are yyyyMMdd numbers).
PROVIDER_HEADINGS = (
    "employee id", "person id", "first name", "Middle Name", "last name", "ssn", "dob", "gender", "race", "language",
    "Marital Status", "phone 1", "phone 2", "email", "mailing add 1", "mailing add 2", "mailing city", "mailing state",
    "mailing zip", "physical add 1", "physical add 2", "physical city", "physical state", "physical zip",
    "Employee Classification", "exempt status", "Background Check Date", "i&e date", "hire date",
    "classification start date", "carina eligible", "ahcas eligible", "o&s completed", "termination date",
    "authorized start date", "authorized end date", "client count", "client relationship", "Client ID", "Ethnicity",
)
PROVIDER_NUMBERS = {"employee id": "bigint", "phone 1": "bigint", "phone 2": "bigint"} | dict.fromkeys(
    (
        "dob", "Background Check Date", "i&e date", "hire date", "classification start date", "o&s completed",
        "termination date", "authorized start date", "authorized end date", "client count",
    ),
    "int",
)
PROVIDER = feed_mapping(PROVIDER_HEADINGS, PROVIDER_NUMBERS, {"person id": "personid"})

# Columns of the transfer feed.
TRANSFER_HEADINGS = (
    "Employee Id", "Person ID", "training program", "Class Name", "DSHS Course Code", "Credit Hours", "Completed Date",
    "Training Entity", "Reason for Transfer", "EmployerStaff", "CreatedDate",
)
TRANSFER = feed_mapping(TRANSFER_HEADINGS, {"Employee Id": "bigint", "Person ID": "bigint"}, joiner="")

# Columns of the learning-system export.
LMS_HEADINGS = (
    "Offering Title", "Course Title", "Student First Name", "Student Last Name", "Student Email", "Last Active Date",
    "Course Type", "BG Person ID", "Date Of Birth", "Phone Number", "Street 1", "Street 2", "City", "State/Province",
    "Postal Code", "Registration Date", "Begin Date", "Completed Date", "Grade", "Status", "Completion Percentage",
    "Completion Date",
)
LMS = feed_mapping(
    LMS_HEADINGS,
    {"Date Of Birth": "date"}
    | dict.fromkeys(("Last Active Date", "Registration Date", "Begin Date", "Completed Date", "Completion Date"), "timestamp"),
    {
        "Student First Name": "user_first_name",
        "Student Last Name": "user_last_name",
        "Student Email": "user_email",
        "Last Active Date": "last_login_date",
        "Registration Date": "registered_date",
        "Grade": "grade_percentage",
        "State/Province": "state",
    },
)

# Columns of the attendance sheets, in the order they are hashed.
SHEET_HEADINGS = (
    "learner id", "first name", "last name", "phone number", "learner email", "attendance", "class id", "class title",
    "date", "duration", "when enrolled", "instructor", "sheet name",
)
SHEET = feed_mapping(SHEET_HEADINGS, {"date": "date", "when enrolled": "date", "duration": "decimal(3,2)"})
SHEET_COLUMNS = [target for _, _, target, _ in SHEET]


def load_intake(df: DataFrame, person: DataFrame, previous: DataFrame, prefix: str) -> DataFrame:
    """Intake form: routed ``clean`` / ``error`` by the person check, new responses marked by ``isdelta``."""
    rows = load_feed(df, INTAKE, prefix, "yyyyMMddHHmmss", "filemodifieddate")
    return flag_delta(match_terminated(rows, person), previous, key="responseid")


def load_safety_form(df: DataFrame, previous: DataFrame, prefix: str) -> DataFrame:
    """Safety-training form of either kind, new responses marked by ``isdelta``."""
    rows = load_feed(df, SAFETY_FORM, prefix, "yyyyMMddHHmmss", "filemodifieddate")
    return flag_delta(rows, previous, key="responseid")


def load_transfer_survey(df: DataFrame, previous: DataFrame, prefix: str) -> DataFrame:
    """Transfer survey, new responses marked by ``isdelta``."""
    rows = load_feed(df, TRANSFER_SURVEY, prefix, "yyyy-MM-dd", "filemodifieddate")
    return flag_delta(rows, previous, key="responseid")


def route_provider(df: DataFrame, crosswalk: DataFrame, prefix: str) -> DataFrame:
    """Provider feed: clean text, identity routes (``ok``, ``duplicate_ssn``, ``bad_length``), whole ssn.

    ``people.extend_crosswalk`` takes its new pairs from here; ``mask_provider`` gives the rows to store.
    """
    text = blank_to_null(trim_all(clean_headers(df)))
    named = load_feed(text, [*PROVIDER, *_dated("date")], prefix, "yyyy-MM-dd", "filemodifieddate")
    keyed = named.withColumn("personid", F.col("personid").try_cast("bigint"))
    return identity_conflicts(clean_provider_rows(keyed), crosswalk)


def mask_provider(routed: DataFrame) -> DataFrame:
    """Routed provider rows as they are stored: last four of the ssn, text ids."""
    return routed.withColumns({"ssn": last4("ssn"), "personid": F.col("personid").cast("string")})


def load_provider(df: DataFrame, crosswalk: DataFrame, prefix: str) -> DataFrame:
    """Provider feed routed and masked in one step, for callers that do not keep a crosswalk."""
    return mask_provider(route_provider(df, crosswalk, prefix))


def _dated(type_name: str) -> MappingList:
    return [
        ("filename", "string", "filename", "string"),
        ("filemodifieddate", type_name, "filemodifieddate", type_name),
    ]


def load_transfers(df: DataFrame, person: DataFrame, prefix: str) -> DataFrame:
    """Transfer feed: dates, person behind the external id, routes ``safety`` / ``other`` / ``error``."""
    rows = load_feed(df, [*TRANSFER, *_dated("date")], prefix, "yyyy-MM-dd", "filemodifieddate")
    dated = rows.withColumns({d: parse_date(d, "yyyyMMdd") for d in ("completeddate", "createddate")})
    routed = resolve_person(dated, person, "personid", "cdwaid", "trainingprogram")
    # Mapped rows carry the person id from here on; unmapped ones keep the external id for the log.
    return routed.withColumns({"personid": F.coalesce("person_id", "personid")}).drop("person_id").withColumnRenamed(
        "filemodifieddate", "filedate"
    )


def load_lms(df: DataFrame, order: Sequence[Column | str]) -> DataFrame:
    """Learning-system export: cleaned passed completions under their table names."""
    return apply_mapping(clean_lms_completions(df, order), LMS)


def load_sheet(df: DataFrame, previous: DataFrame, order: Sequence[Column | str], as_of=None) -> DataFrame:
    """Attendance sheet: cleaned rows, those whose hash the last snapshot lacks marked by ``isdelta``."""
    clean = clean_sheet_completions(df, order, as_of)
    return flag_delta(apply_mapping(clean, SHEET), previous, cols=SHEET_COLUMNS)


def completions_of(raw: DataFrame) -> DataFrame:
    """Loaded learning-system rows in the shape the completion jobs take; a title ends before its first ``(``."""
    return raw.filter(F.col("status") == "Passed").select(
        F.col("bg_person_id").alias("learner_id"),
        F.substring_index("offering_title", "(", 1).alias("class_title"),
        F.col("course_title").alias("class_id"),
        F.col("completed_date").cast("date").alias("date"),
        F.col("user_last_name").alias("last_name"),
        F.col("user_first_name").alias("first_name"),
        F.col("user_email").alias("learner_email"),
        F.lit(0).alias("duration"),
        F.col("registered_date").cast("date").alias("when_enrolled"),
        F.lit("instructor").alias("instructor"),
        "status",
        field("phone_number"),
    )


def refresh_snapshot(loaded: DataFrame, root: str, key: str | None = None, cols: Sequence[str] | None = None) -> int:
    """Flag a loaded drop against the versioned snapshot at ``root``, make it the next version and return its number.

    Rows are told apart as in ``flag_delta``, by ``key`` or by the hash of ``cols``. Without a snapshot all rows are new.
    A run that dies leaves the snapshot as it was, and can be repeated; one that meets another's replace gets an error.
    """
    spark = loaded.sparkSession
    held = latest(spark, root)
    prev = read_snapshot(spark, root, held.version) if held else loaded.limit(0)
    return publish(flag_delta(loaded, prev, key=key, cols=cols), root, base=held.version if held else 0)

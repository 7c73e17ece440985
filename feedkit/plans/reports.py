"""Report and register files: preamble reports, transition list, exam results, relationship feed."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

from ..functions.dates import file_date, parse_date
from ..functions.text import word
from ..operators.mapping import apply_mapping, blank_to_null, trim_all
from ..operators.relate import anti

# Preamble rows of a report, and where the credential number sits in its text.
PREAMBLE_ROWS = 7
CREDENTIAL_START, CREDENTIAL_LENGTH = 5, 16

# Columns of the two report files.
CLASSIFIED_COLUMNS = {
    "col0": "filelastname",
    "col1": "filefirstname",
    "col2": "filereceiveddate",
    "col3": "registryname",
    "credentialnumber": "credentialnumber",
    "col5": "credentialstatus",
    "col6": "applicationdate",
    "col7": "dateupdated",
}

COMPLETED_SCHEMA = T.StructType(
    [
        T.StructField(name, T.StringType())
        for name in (
            "filelastname",
            "filefirstname",
            "filereceiveddate",
            "registryname",
            "credential",
            "credentialstatus",
            "applicationdate",
            "dateinstructorupdated",
            "approvedinstructorcodeandname",
            "dategraduatedfor70hours",
        )
    ]
)


def load_report(df: DataFrame, credential: str, prefix: str, name: str = "filename") -> DataFrame:
    """Rows below the preamble: blanks to null, credential number from its text, date of the file name."""
    number = F.substring(F.translate(credential, ".", ""), CREDENTIAL_START, CREDENTIAL_LENGTH)
    loaded = df.withColumns({"credentialnumber": number, "filedate": file_date(name, prefix, "yyyyMMddHHmmss")})
    return blank_to_null(trim_all(loaded))


def finalize_report(df: DataFrame, target: DataFrame, prefix: str, instructor: str | None = None) -> DataFrame:
    """New credentials with real dates; the instructor text splits into a code and two name words."""
    new = anti(df.distinct(), target, ["credentialnumber"])
    dates = [c for c in ("filereceiveddate", "applicationdate", "dateupdated", "dateinstructorupdated", "dategraduatedfor70hours") if c in df.columns]
    out = new.withColumns(
        {c: parse_date(c, "MM/dd/yyyy") for c in dates}
        | {"reportdate": file_date("filename", prefix, "yyyyMMddHHmmss").cast("date")}
    )
    if instructor is None:
        return out
    return out.withColumns(
        {
            "approvedinstructorcode": word(instructor, 0),
            "approvedinstructorname": F.concat(word(instructor, 1), F.lit(" "), word(instructor, 2)),
        }
    )


# Columns of the transition list.
TRANSITION = [
    ("providerone ipid", "string", "providerone_id", "string"),
    ("workday id", "string", "workdayid", "string"),
    ("person id", "string", "personid", "string"),
    ("category", "string", "category", "string"),
    ("sub category", "string", "subcategory", "string"),
    ("status", "string", "status", "string"),
    ("ssn", "string", "ssn", "string"),
    ("hire date", "string", "hiredate", "string"),
    ("birth date", "string", "birthdate", "string"),
    ("ip name", "string", "ipname", "string"),
    ("firstname", "string", "firstname", "string"),
    ("middlename", "string", "middlename", "string"),
    ("lastname", "string", "lastname", "string"),
    ("email", "string", "email", "string"),
    ("home phone", "string", "homephone", "string"),
    ("cell phone", "string", "cellphone", "string"),
    ("address type", "string", "addresstype", "string"),
    ("address line 1", "string", "addressline1", "string"),
    ("address line 2", "string", "addressline2", "string"),
    ("city", "string", "city", "string"),
    ("state", "string", "state", "string"),
    ("zip code", "string", "zipcode", "string"),
    ("preferred language", "string", "preferredlanguage", "string"),
    ("recommended preferred language", "string", "recommendedpreferredlanguage", "string"),
    ("filename", "string", "filename", "string"),
    ("filedate", "date", "filedate", "timestamp"),
]

# Columns of the relationship feed.
RELATIONSHIP = [
    ("provider id", "string", "provider_id", "int"),
    ("filename", "string", "filename", "string"),
    ("filemodifieddate", "timestamp", "filemodifieddate", "timestamp"),
    ("student id", "string", "student_id", "bigint"),
    ("social security number", "string", "social_security_number", "int"),
    ("dob", "string", "dob", "string"),
    ("client relationship to ip", "string", "client_relationship_to_ip", "string"),
    ("authorization start date", "string", "authorization_start_date", "string"),
    ("authorization end date", "string", "authorization_end_date", "string"),
    ("preferred language", "string", "preferred_language", "string"),
    ("cumulative career hours", "string", "cumulative_career_hours", "decimal"),
    ("monthly hours worked", "string", "monthly_hours_worked", "decimal"),
    ("monthly hours worked month", "string", "monthly_hours_worked_month", "int"),
    ("last background check date", "string", "last_background_check_date", "string"),
    ("ip contract expiration date", "string", "ip_contract_expiration_date", "string"),
    ("termination type", "string", "termination_type", "int"),
    ("termination date", "string", "termination_date", "string"),
]

# Columns of the exam results.
EXAM_HEADINGS = (
    "studentid", "taxid", "credentialnumber", "examdate", "examstatus", "examtitlefromprometrics", "testlanguage",
    "testsite", "sitename", "rolesandresponsibilitiesofthehomecareaide", "supportingphysicalandpsychosocialwellbeing",
    "promotingsafety", "handwashingskillresult", "randomskill1result", "randomskill2result", "randomskill3result",
    "commoncarepracticesskillresult",
)
EXAM = [(name, "string", name, "string") for name in EXAM_HEADINGS] + [
    ("filename", "string", "filename", "string"),
    ("filemodifieddate", "timestamp", "filemodifieddate", "timestamp"),
]


def load_feed(df: DataFrame, mapping, prefix: str, fmt: str, date_col: str) -> DataFrame:
    """Delimited rows with a ``filename`` column to typed rows: blanks to null, file date, mapping."""
    dated = blank_to_null(df).withColumn(date_col, file_date("filename", prefix, fmt))
    return apply_mapping(dated, mapping)


def load_transition(df: DataFrame, prefix: str) -> DataFrame:
    """Transition list: last four digits of the ssn, file date, mapping."""
    return load_feed(df.withColumn("ssn", F.right("ssn", F.lit(4))), TRANSITION, prefix, "MMddyyyy", "filedate")

"""Persons and employment: standard records, matching, identity conflicts, crosswalk."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field as dc_field

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.dates import YEARS_AHEAD, adult, file_date, newest_birth, parse_date, sane_date
from ..functions.hashing import protect_column, source_key
from ..functions.text import blank_as_null, email_ok, join_address, normalize_phone, pad_id, phone_ok, prefix_phone
from ..operators.mapping import apply_mapping, code_label, pick_by
from ..operators.relate import anti, has_other_id, with_partner_flag

# Form code of the employing agency -> employer id -> branch id.
EMPLOYER_OF_CODE = {
    "1": "102", "2": "113", "3": "105", "4": "106", "5": "116", "6": "107", "7": "117",
    "8": "109", "10": "104", "11": "111", "12": "108", "13": "119", "14": "120", "15": "121",
}
BRANCH_OF_EMPLOYER = {
    "102": 390, "113": 398, "105": 391, "106": 223, "116": 201, "107": 393, "117": 202,
    "109": 394, "104": 388, "111": 396, "108": 246, "119": 284, "120": 205, "121": 206,
}

# Form code of the preferred language -> language name.
LANGUAGE_OF_CODE = {
    "1": "English", "2": "Amharic", "3": "Arabic", "4": "Chinese", "5": "Farsi", "6": "Khmer",
    "7": "Korean", "8": "Lao", "9": "Nepali", "10": "Punjabi", "11": "Russian", "12": "Samoan",
    "13": "Somali", "14": "Spanish", "15": "Tagalog", "16": "Ukrainian", "17": "Vietnamese",
}

# Form status, category and work category, date formats of the form.
NEW_HIRE, TERMINATED = "1", "2"
STATUS_LABELS = {NEW_HIRE: "Active", TERMINATED: "Terminated"}
CATEGORY = "SHCA"
WORK_CATEGORY = "Standard HCA"
COUNTRY = "USA"
PERSON_DATES = ("MM/dd/yy", "MM/dd/yyyy", "MM-dd-yyyy", "MMddyyyy")
HIRE_DATES = ("MM/dd/yy", "MM/dd/yyyy", "MM-dd-yyyy", "yyyy-MM-dd", "MMddyyyy")
TERM_DATES = ("yyyy/MM/dd", "MM/dd/yy", "MM/dd/yyyy", "MM-dd-yyyy", "yyyy-MM-dd")


@dataclass(frozen=True)
class AgencyCodes:
    """Code tables of the intake form. Branch labels are the caller's; without them a branch is named by its id."""

    employers: Mapping[str, str] = dc_field(default_factory=lambda: EMPLOYER_OF_CODE)
    branches: Mapping[str, int] = dc_field(default_factory=lambda: BRANCH_OF_EMPLOYER)
    languages: Mapping[str, str] = dc_field(default_factory=lambda: LANGUAGE_OF_CODE)
    labels: Mapping[int, str] | None = None

    def label(self, branch: Column) -> Column:
        return code_label(branch, self.labels) if self.labels else F.concat(F.lit("branch"), branch.cast("string"))


# Target column -> (new-hire source, terminated source).
FORM_PAIRS = {
    "firstname": ("newhire_person_firstname", "terminated_person_firstname"),
    "lastname": ("newhire_person_lastname", "terminated_person_lastname"),
    "middlename": ("newhire_person_middlename", "terminated_person_middlename"),
    "email1": ("newhire_person_email1", "terminated_person_email"),
    "homephone": ("newhire_person_phone2", "terminated_person_phone"),
    "mobilephone": ("newhire_person_phone1", "terminated_person_phone"),
    "ssn": ("newhire_person_ssn", "terminated_person_ssn"),
    "dob": ("newhire_person_dob", "terminated_person_dob"),
    "mailingstreet1": ("newhire_person_street", "terminated_person_street"),
    "mailingcity": ("newhire_person_city", "terminated_person_city"),
    "mailingstate": ("newhire_person_state", "terminated_person_state"),
    "mailingzip": ("newhire_person_zipcode", "terminated_person_zipcode"),
}


def pick_form_columns(df: DataFrame, targets: Sequence[str] = tuple(FORM_PAIRS)) -> DataFrame:
    """Fill the person columns from the new-hire or terminated part of the form, by status."""
    return pick_by(
        df,
        "cg_status",
        {NEW_HIRE: {t: FORM_PAIRS[t][0] for t in targets}, TERMINATED: {t: FORM_PAIRS[t][1] for t in targets}},
    )


def validate_contacts(df: DataFrame, phones: Sequence[str] = ("homephone", "mobilephone"), email: str = "email1") -> DataFrame:
    """Add ``is_validphone`` and ``is_validemail`` (valid / invalid). Missing contacts are valid."""
    phone = phone_ok(phones[0])
    for p in phones[1:]:
        phone = phone & phone_ok(p)
    return df.withColumns(
        {
            "is_validphone": F.when(phone, "valid").otherwise("invalid"),
            "is_validemail": F.when(email_ok(email), "valid").otherwise("invalid"),
        }
    )


def _coded(df: DataFrame, codes: AgencyCodes) -> DataFrame:
    """Employer and branch of the row's agency code; rows without both are dropped."""
    coded = df.withColumn("employerid", code_label("employername", codes.employers))
    coded = coded.withColumn("branchid", code_label("employerid", codes.branches).cast("int"))
    return coded.filter("employerid IS NOT NULL AND branchid IS NOT NULL")


def standardize_person_form(df: DataFrame, codes: AgencyCodes = AgencyCodes(), as_of=None) -> DataFrame:
    """New intake-form rows to person history.

    Kept: new hires with a hire date and terminated persons with id and date, known agency, valid contacts, adult
    date of birth.
    """
    form = pick_form_columns(df.filter(F.col("isdelta").cast("string") == "true"))
    form = form.withColumns(
        {
            "mailingaddress": join_address("mailingstreet1", "mailingcity", "mailingstate", "mailingzip"),
            "status": code_label("cg_status", STATUS_LABELS),
            "exempt": F.when(F.col("exempt") == "1", "true").otherwise("false"),
            "hiredate": parse_date("person_hire_date", *PERSON_DATES, as_of=as_of, years_ahead=YEARS_AHEAD),
            "dob": parse_date("dob", *PERSON_DATES, as_of=as_of, sane=True),
            "ssn": pad_id("ssn", 4),
        }
    )
    wanted = ((F.col("status") == "Active") & F.col("hiredate").isNotNull()) | (
        (F.col("status") == "Terminated")
        & F.col("terminated_person_id").isNotNull()
        & F.col("person_termination_date").isNotNull()
    )
    valid = validate_contacts(_coded(form.filter(wanted), codes))
    valid = valid.filter((F.col("is_validphone") == "valid") & (F.col("is_validemail") == "valid"))
    hired = sane_date("hiredate").cast("timestamp")
    return valid.filter(F.col("dob") <= newest_birth(as_of)).select(
        source_key(codes.label(F.col("branchid")), "ssn", F.col("dob").cast("string")).alias("sourcekey"),
        "firstname",
        "middlename",
        "lastname",
        "ssn",
        F.date_format("dob", "yyyy-MM-dd").alias("dob"),
        "email1",
        prefix_phone("homephone").alias("homephone"),
        prefix_phone("mobilephone").alias("mobilephone"),
        F.col("userlanguage").alias("language"),
        code_label("preferredlanguage", codes.languages).alias("preferred_language"),
        "status",
        "exempt",
        hired.alias("hiredate"),
        hired.alias("trackingdate"),
        F.lit(CATEGORY).alias("categorycode"),
        F.lit(WORK_CATEGORY).alias("workercategory"),
        F.col("terminated_person_id").try_cast("bigint").alias("agencyid"),
        "mailingaddress",
        "mailingstreet1",
        "mailingcity",
        "mailingstate",
        "mailingzip",
        F.lit(COUNTRY).alias("mailingcountry"),
        F.col("filemodifieddate").cast("date").alias("filemodifieddate"),
    )


def employment_rows(
    df: DataFrame, codes: AgencyCodes = AgencyCodes(), as_of=None, created_by: str = "feedkit"
) -> DataFrame:
    """New intake-form rows to employment history: status, dates, employer, branch, fixed role and priority."""
    form = pick_form_columns(df.filter(F.col("isdelta").cast("string") == "true"), ("ssn", "dob", "firstname"))
    form = form.withColumns(
        {
            "dob": parse_date("dob", *PERSON_DATES, as_of=as_of),
            "ssn": pad_id("ssn", 4),
            "hiredate": parse_date("person_hire_date", *HIRE_DATES, as_of=as_of, years_ahead=YEARS_AHEAD, sane=True),
            "termdate": parse_date("person_termination_date", *TERM_DATES, as_of=as_of, years_ahead=YEARS_AHEAD, sane=True),
        }
    )
    wanted = ((F.col("cg_status") == NEW_HIRE) & F.col("hiredate").isNotNull()) | (
        (F.col("cg_status") == TERMINATED) & F.col("terminated_person_id").isNotNull() & F.col("termdate").isNotNull()
    )
    kept = _coded(form.filter(wanted), codes).filter("firstname IS NOT NULL")
    return kept.select(
        source_key(codes.label(F.col("branchid")), "ssn", F.col("dob").cast("string")).alias("source"),
        F.col("terminated_person_id").try_cast("bigint").alias("agencyid"),
        "employerid",
        "branchid",
        F.lit(CATEGORY).alias("categorycode"),
        F.lit(WORK_CATEGORY).alias("workercategory"),
        code_label("cg_status", STATUS_LABELS).alias("empstatus"),
        F.col("hiredate").cast("timestamp").alias("hiredate"),
        F.col("hiredate").cast("string").alias("authstart"),
        F.col("termdate").cast("string").alias("authend"),
        F.col("hiredate").cast("string").alias("trackingdate"),
        F.col("termdate").cast("string").alias("terminationdate"),
        F.lit(1).alias("priority"),
        F.lit("CARE").alias("role"),
        F.lit(created_by).alias("createdby"),
        F.col("filemodifieddate").cast("date").alias("filedate"),
    )


# Provider view to employment history, one mapping without logic.
EMPLOYMENT_VIEW = [
    ("sourcekey", "string", "source", "string"),
    ("classificationcode", "string", "categorycode", "string"),
    ("filedate", "date", "filedate", "date"),
    ("initialtrackingdate", "date", "trackingdate", "string"),
    ("createdby", "string", "createdby", "string"),
    ("hire_date", "date", "hiredate", "timestamp"),
    ("priority", "int", "priority", "int"),
    ("employerid", "int", "employerid", "string"),
    ("authorized_end_date", "timestamp", "authend", "string"),
    ("termination_date", "timestamp", "terminationdate", "string"),
    ("authorized_start_date", "timestamp", "authstart", "string"),
    ("employee_id", "decimal(10,0)", "employeeid", "bigint"),
    ("employee_classification", "string", "workercategory", "string"),
    ("relationship", "string", "relationship", "string"),
    ("empstatus", "string", "empstatus", "string"),
]


def employment_from_view(df: DataFrame, created_by: str = "feedkit") -> DataFrame:
    """Project the provider view to the employment schema; absent columns are left out."""
    return apply_mapping(df.withColumn("createdby", F.lit(created_by)), EMPLOYMENT_VIEW)


def standardize_person_feed(df: DataFrame, label: str, file_prefix: str, as_of=None) -> DataFrame:
    """Valid provider-feed rows to person history: addresses, phones, dates written as yyyyMMdd, adults only."""
    dob = parse_date(F.col("dob").cast("string"), "yyyyMMdd")
    rows = df.filter(F.col("isvalid").cast("string") == "true").withColumn("_dob", dob).filter(adult("_dob", as_of))
    return rows.select(
        F.concat(F.lit(label + "-"), F.col("personid").cast("string")).alias("sourcekey"),
        F.col("first_name").alias("firstname"),
        F.col("middle_name").alias("middlename"),
        F.col("last_name").alias("lastname"),
        pad_id("ssn", 4).alias("ssn"),
        F.date_format("_dob", "yyyy-MM-dd").alias("dob"),
        F.col("email").alias("email1"),
        normalize_phone("phone_1").alias("mobilephone"),
        normalize_phone("phone_2").alias("homephone"),
        "language",
        F.col("employee_classification").alias("workercategory"),
        (F.col("exempt_status") == "Yes").alias("_exempt"),
        (F.col("ahcas_eligible").cast("string") == "1").alias("_eligible"),
        F.col("carina_eligible").try_cast("boolean").alias("iscarinaeligible"),
        parse_date(F.col("hire_date").cast("string"), "yyyyMMdd").cast("timestamp").alias("hiredate"),
        parse_date(F.col("classification_start_date").cast("string"), "yyyyMMdd").cast("timestamp").alias("trackingdate"),
        parse_date(F.col("background_check_date").cast("string"), "yyyyMMdd").alias("last_background_check_date"),
        parse_date(F.col("ie_date").cast("string"), "yyyyMMdd").alias("ie_date"),
        F.col("personid").try_cast("bigint").alias("cdwa_id"),
        F.col("employee_id").try_cast("decimal(9,0)").alias("dshsid"),
        join_address("physical_add_1", "physical_city", "physical_state", "physical_zip").alias("physicaladdress"),
        join_address("mailing_add_1", "mailing_city", "mailing_state", "mailing_zip").alias("mailingaddress"),
        F.col("mailing_add_1").alias("mailingstreet1"),
        F.col("mailing_add_2").alias("mailingstreet2"),
        F.col("mailing_city").alias("mailingcity"),
        F.col("mailing_state").alias("mailingstate"),
        F.col("mailing_zip").alias("mailingzip"),
        F.lit(COUNTRY).alias("mailingcountry"),
        file_date("filename", file_prefix, "yyyy-MM-dd").alias("filemodifieddate"),
    ).select(
        "*",
        F.when(F.col("_exempt"), "true").otherwise("false").alias("exempt"),
        F.coalesce("_eligible", F.lit(False)).alias("ahcas_eligible"),
    ).drop("_exempt", "_eligible")


def match_terminated(df: DataFrame, person: DataFrame) -> DataFrame:
    """Route form rows: new hires are ``clean``; a terminated row is ``clean`` when its person id is confirmed.

    An id is confirmed when some terminated row with it agrees with the person on first or last name (any case)
    and on ssn, date of birth or e-mail. Everything else is ``error``.
    """
    claims = df.filter(F.col("cg_status") == TERMINATED).select(
        F.col("terminated_person_id").alias("_claim"),
        F.upper("terminated_person_firstname").alias("_first"),
        F.upper("terminated_person_lastname").alias("_last"),
        pad_id("terminated_person_ssn", 4).alias("_ssn"),
        parse_date("terminated_person_dob", "MM/dd/yyyy").alias("_dob"),
        F.col("terminated_person_email").alias("_email"),
    )
    known = person.select(
        F.col("personid").cast("string").alias("_id"),
        F.upper("firstname").alias("_pfirst"),
        F.upper("lastname").alias("_plast"),
        F.col("ssn").alias("_pssn"),
        F.col("dob").alias("_pdob"),
        F.coalesce("email1", "email2").alias("_pemail"),
    )
    name = (F.col("_first") == F.col("_pfirst")) | (F.col("_last") == F.col("_plast"))
    proof = (F.col("_ssn") == F.col("_pssn")) | (F.col("_dob") == F.col("_pdob")) | (F.col("_email") == F.col("_pemail"))
    confirmed = claims.distinct().join(known, (F.col("_claim") == F.col("_id")) & name & proof, "left_semi")
    marked = with_partner_flag(df, confirmed, "terminated_person_id", "_claim", "_confirmed")
    ok = (F.col("cg_status") == NEW_HIRE) | ((F.col("cg_status") == TERMINATED) & F.col("_confirmed"))
    return marked.withColumn("route", F.when(ok, "clean").otherwise("error")).drop("_confirmed")


def identity_conflicts(df: DataFrame, crosswalk: DataFrame, low: int = 7, high: int = 9) -> DataFrame:
    """Route provider rows: ``duplicate_ssn``, ``bad_length`` or ``ok``.

    ``crosswalk`` has ``ssn`` (revealed) and ``cdwaid``. When one row of a person carries an ssn held by another
    id, all rows of that person are ``duplicate_ssn``. An ssn shorter than ``low`` or longer than ``high`` is
    ``bad_length``; a missing one is no error.
    """
    marked = has_other_id(df.select("personid", "ssn").distinct(), crosswalk, "ssn", "personid", "ssn", "cdwaid", "_other")
    out = with_partner_flag(df, marked.filter("_other"), "personid", "personid", "_conflict")
    n = F.length("ssn")
    where = F.when(F.col("_conflict"), "duplicate_ssn").when((n < low) | (n > high), "bad_length").otherwise("ok")
    return out.withColumn("route", where).drop("_conflict")


def extend_crosswalk(df: DataFrame, crosswalk: DataFrame, key: str) -> DataFrame:
    """New (protected ssn, external id) pairs for persons the crosswalk lacks.

    ``df`` comes routed from ``identity_conflicts`` and holds whole ssns: conflicts and bad lengths are left out, as are
    null ssns.
    """
    pairs = df.filter("route = 'ok'").select(F.col("personid").try_cast("bigint").alias("cdwaid"), "ssn").filter("ssn IS NOT NULL").distinct()
    new = anti(pairs, crosswalk, ["cdwaid"])
    return protect_column(new, "ssn", key, to="fullssn").select("fullssn", "cdwaid")


def clean_provider_rows(df: DataFrame) -> DataFrame:
    """Provider feed text: line breaks and quotes leave the client id, blanks become null, states are two letters."""
    client = blank_as_null(F.trim(F.regexp_replace("client_id", '[\\r\\n"]', "")))
    return df.withColumns(
        {
            "client_id": client,
            "mailing_state": F.substring(F.upper("mailing_state"), 1, 2),
            "physical_state": F.substring(F.upper("physical_state"), 1, 2),
        }
    )

"""Course completions: cleaning, validation, enrichment, safety training and the unique history."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.dates import YEARS_AHEAD, parse_date, parse_ts_any
from ..functions.text import digits_only, field
from ..operators.mapping import blank_to_null
from ..operators.ranking import drop_dups, flag_first, keep_first
from ..operators.relate import join_any_key, lookup

# What every safety-training completion is recorded as.
SAFETY_COURSE = {
    "coursename": "Orientation & Safety EN",
    "credithours": 5.0,
    "courseid": "1000065ONLEN02",
    "trainingprogramtype": "Orientation & Safety",
    "courselanguage": "EN",
    "coursetype": "ONL",
    "instructorname": "instructor",
    "instructorid": "instructor",
}
SAFETY_CODE = 100

# Formats of the completion date typed into the safety forms.
FORM_DATES = ("MM/dd/yyyy", "MM-dd-yyyy", "yyyy-MM-dd", "MMddyyyy")

# Length of the suffix (delivery, language, version) of a course id.
VERSION_LENGTH = 7


def _key(c: Column | str) -> Column:
    return F.lower(F.trim(field(c) if isinstance(c, str) else c))


def clean_lms_completions(df: DataFrame, order: Sequence[Column | str]) -> DataFrame:
    """Learning-system export: one row per person and course, digits-only person id, passed only, real dates."""
    one = drop_dups(df, ["BG Person ID", "Course Title"], order)
    tidy = blank_to_null(one).withColumn("BG Person ID", digits_only("BG Person ID"))
    required = field("BG Person ID").isNotNull() & field("Course Title").isNotNull() & field("Completion Date").isNotNull()
    dates = ("Completed Date", "Registration Date", "Last Active Date", "Completion Date", "Begin Date")
    kept = tidy.filter(required & (field("Status") == "Passed"))
    return kept.withColumns({d: parse_ts_any(d) for d in dates if d in df.columns})


def clean_sheet_completions(df: DataFrame, order: Sequence[Column | str], as_of=None) -> DataFrame:
    """Attendance sheets: one row per learner and class, id of at most 12 digits, required fields, real dates."""
    one = drop_dups(df, ["learner id", "class id"], order)
    tidy = blank_to_null(one, ["date"]).withColumn("learner id", digits_only("learner id", 12))
    for name in ("learner id", "class id", "class title", "date", "attendance"):
        tidy = tidy.filter(field(name).isNotNull())
    return tidy.withColumns(
        {
            "date": parse_date("date", "MM/dd/yy", "MM/dd/yyyy", as_of=as_of, years_ahead=YEARS_AHEAD),
            "when enrolled": parse_date("when enrolled", "MM/dd/yy", "MM/dd/yyyy", as_of=as_of, years_ahead=YEARS_AHEAD),
            "instructor": F.regexp_replace("instructor", "'", "’"),
        }
    )


def preferred_courses(catalog: DataFrame, tie: Sequence[str] = ("courseid",)) -> DataFrame:
    """One row per course name, language and program; instructor-led (``ILT``) sorts before online (``ONL``)."""
    return keep_first(catalog, ["coursename", "courselanguage", "trainingprogramcode"], ["coursetype", *tie])


def active_instructors(df: DataFrame) -> DataFrame:
    """Distinct full name and id of active instructors."""
    name = F.trim(F.concat(F.trim("firstname"), F.lit(" "), F.trim("lastname")))
    active = df.filter(F.col("isactive").cast("string") == "true")
    return active.select(name.alias("instructorname"), F.col("instructorid")).distinct()


def validate_completions(df: DataFrame, person: DataFrame, tie: Sequence[str]) -> DataFrame:
    """Route completions: ``valid``, ``unmatched`` (no person with this last name, e-mail and id) or ``duplicate``.

    The earliest matched completion per learner and class is the valid one.
    """
    known = person.select(
        F.lower("lastname").alias("_last"),
        F.lower(F.coalesce("email1", "email2")).alias("_email"),
        F.col("personid").cast("string").alias("_id"),
    ).dropna()
    known = known.distinct().withColumn("_matched", F.lit(True))
    keyed = df.withColumns({"_l": _key("last_name"), "_e": _key("learner_email"), "_i": F.trim("learner_id")})
    joined = lookup(keyed, known, [("_l", "_last"), ("_e", "_email"), ("_i", "_id")])
    joined = joined.drop("_l", "_e", "_i", "_last", "_email", "_id")
    ranked = flag_first(joined, ["learner_id", "class_title", "_matched"], ["date", *tie])
    where = F.when(F.col("_matched").isNull(), "unmatched").when(F.col("is_first"), "valid").otherwise("duplicate")
    return ranked.withColumn("route", where).drop("_matched", "is_first")


def enrich_completions(
    df: DataFrame, catalog: DataFrame, instructors: DataFrame, source: str, with_language: bool = False
) -> DataFrame:
    """Attach course and instructor to completions (learner_id, class_title, completiondate, instructor).

    Courses match on the title, or on title and language joined by a blank; unmatched completions stay. Each row
    comes out once: the three inputs are made distinct, which is cheaper than doing so to the joined rows.
    """
    name = F.concat(F.trim("coursename"), F.lit(" "), F.col("courselanguage")) if with_language else F.trim("coursename")
    course_cols = (
        "credithours", "trainingprogramtype", "trainingprogramcode", "courseid",
        "coursetype", "courselanguage", "dshscourseid",
    )
    courses = catalog.select(F.lower(name).alias("_title"), *[c for c in course_cols if c in catalog.columns]).distinct()
    people = instructors.select(_key("instructorname").alias("_name"), F.col("instructorid")).distinct()
    out = df.select("learner_id", "class_title", "completiondate", F.col("instructor").alias("instructorname")).distinct()
    out = out.withColumns({"_t": _key("class_title"), "_n": _key("instructorname")})
    out = out.join(courses, F.col("_t") == F.col("_title"), "left").join(people, F.col("_n") == F.col("_name"), "left")
    return out.drop("_t", "_n", "_title", "_name").withColumn("trainingsource", F.lit(source))


def newest_sheet(df: DataFrame, tie: Sequence[str] = ()) -> DataFrame:
    """Attended completions: per learner and class the newest sheet, then the earliest date."""
    sheet_date = parse_date(F.try_element_at(F.split("sheet_name", "-"), F.lit(2)), "yyyyMMdd")
    attended = df.filter(F.col("attendance") == "Attended").withColumn("sheetdate", sheet_date)
    order = [F.col("sheetdate").desc_nulls_last(), F.col("date").asc_nulls_first(), *tie]
    return keep_first(attended, ["learner_id", "class_title"], order)


def _safety(df: DataFrame, source: str) -> DataFrame:
    return df.withColumns(
        {k: F.lit(v) for k, v in SAFETY_COURSE.items()}
        | {"trainingprogramcode": F.lit(SAFETY_CODE).cast("bigint"), "trainingsource": F.lit(source)}
    )


def safety_from_transfers(
    df: DataFrame, person: DataFrame, requirement: DataFrame, tie: Sequence[str], source: str, external_id: str = "cdwaid"
) -> DataFrame:
    """Safety transfers: the first per person and program becomes history when the person has an external id
    and an active safety requirement; all other valid rows go to the log (``route``: history / log)."""
    needed = requirement.filter((F.col("trainingprogramcode") == str(SAFETY_CODE)) & (F.col("status") == "active"))
    eligible = person.filter(F.col(external_id).isNotNull()).join(needed.select("personid"), "personid", "left_semi")
    ids = eligible.select(F.col("personid").alias("_pid")).distinct()
    valid = df.filter(F.col("isvalid").cast("string") == "true")
    ranked = flag_first(valid, ["personid", "trainingprogram"], ["completeddate", *tie])
    joined = lookup(ranked, ids, [("personid", "_pid")])
    kept = F.col("is_first") & F.col("_pid").isNotNull()
    routed = joined.withColumn("route", F.when(kept, "history").otherwise("log")).drop("_pid", "is_first")
    return _safety(routed, source)


def safety_from_form(
    df: DataFrame,
    person: DataFrame,
    ids: Sequence[str],
    source: str,
    tie: Sequence[str],
    key: str = "form_id",
    completed: str = "completion_date",
) -> DataFrame:
    """Safety completions from a form: new rows, newest submission per id, finished ones, joined to the person.

    ``ids`` lists the person columns the form id may hold. With several of them only persons that have all
    of them take part, and a person found through both counts once.
    """
    new = df.filter(F.col("isdelta").cast("string") == "true").withColumn(
        "completeddate", parse_date(completed, *FORM_DATES)
    )
    order = [F.col("filemodifieddate").desc_nulls_last(), F.col("completeddate").asc_nulls_first(), *tie]
    last = keep_first(new, [key], order).filter(F.col("finished") == "1")
    forms = last.select(F.col(key).try_cast("bigint").alias("_form"), "completeddate", "filemodifieddate")
    people = person.select("dshsid", "personid").distinct()
    if len(ids) > 1:
        people = people.dropna()
        joined = join_any_key(forms, people, "_form", ids)
    else:
        joined = forms.join(people, F.col("_form") == F.col(ids[0]), "inner")
    return _safety(joined.drop("_form"), source)


def course_family(c: Column | str) -> Column:
    """Course id without its version suffix; ids shorter than the suffix give an empty family."""
    c = field(c) if isinstance(c, str) else c
    return F.trim(F.substring(c, F.lit(1), F.greatest(F.length(c) - VERSION_LENGTH, F.lit(0))))


def unique_completions(history: DataFrame, transcript: DataFrame, tie: Sequence[str]) -> DataFrame:
    """Route completions: ``unique``, or why not: ``no_person``, ``no_course``, ``in_transcript``, ``duplicate``.

    A completion is unique when the transcript holds no course of its family for the person (any case) and it
    is the person's earliest of the family.
    """
    held = (
        transcript.select(F.col("personid").alias("_tp"), F.lower(course_family("courseid")).alias("_tf"))
        .dropna()
        .distinct()
    )
    named = history.filter("personid IS NOT NULL").withColumn("_family", course_family("courseid"))
    ranked = flag_first(named, ["personid", "_family"], ["completeddate", *tie])
    joined = lookup(ranked.withColumn("_lower", F.lower("_family")), held, [("personid", "_tp"), ("_lower", "_tf")])
    where = (
        F.when(F.col("courseid").isNull(), "no_course")
        .when(F.col("_tp").isNotNull(), "in_transcript")
        .when(F.col("is_first"), "unique")
        .otherwise("duplicate")
    )
    routed = joined.withColumn("route", where).drop("_family", "_lower", "is_first", "_tp", "_tf")
    nobody = history.filter("personid IS NULL").withColumn("route", F.lit("no_person"))
    return routed.unionByName(nobody)

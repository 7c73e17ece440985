"""Transfers of training hours: first submission, eligible hours, history check, rules, routing."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import field, strip_suffix
from ..operators.mapping import code_label
from ..operators.ranking import flag_first
from ..operators.relate import anti, lookup, resolve_id

# Program name -> program code.
PROGRAM_CODES = {
    "Basic Training 70 Hours": "201",
    "Basic Training 30 Hours": "202",
    "Basic Training 9 Hours": "203",
    "Continuing Education": "300",
    "Orientation & Safety": "100",
}

# Hours a program must be transferred with, in the provider feed and in the survey.
FEED_HOURS = {
    "Basic Training 70 Hours": 70,
    "Basic Training 30 Hours": 30,
    "Basic Training 9 Hours": 9,
    "Orientation & Safety": 5,
}
SURVEY_HOURS = FEED_HOURS | {"Basic Training 7 Hours": 7}
CONTINUING = "Continuing Education"
CONTINUING_HOURS = (0, 12)

# Programs taken as safety training, and the rule constants.
SAFETY_PROGRAMS = ("Orientation & Safety", "Orientation & Safety Attest")
BASIC_CODES = ("201", "202", "203", "204")
CONTINUING_CODE = "300"
CONTINUING_HIRED_FROM = "2020-03-01"

# Markers that end a survey course title, in the order they are looked for.
TITLE_SUFFIXES = ("(CE)", "(BT70)", "(BT7)", "(BT30)", "(BT9)", "(O&S)")
COURSE_CODE_PATTERN = r"^.*CE+[0-9]|CO+[0-9]|NF+[0-9]"
EXCLUDED_PROGRAM = "603"

MESSAGES = {
    "before_hire": "completed before the hire date",
    "no_requirement": "no active requirement for this program",
    "continuing_window": "continuing education outside its window",
    "basic_late": "basic training after the due date",
    "hired_early": "hired before the continuing education start",
    "excess": "more continuing education hours than required",
    "unmapped": "external id maps to no person",
}

HOURS = "decimal(9,2)"


def resolve_person(df: DataFrame, person: DataFrame, key: str, person_key: str, program: str) -> DataFrame:
    """Map an external id to ``person_id`` and route rows: ``error``, ``safety`` or ``other`` program.

    Unmapped rows keep a null ``person_id`` and carry ``isvalid=false`` and a message. Rows whose program is
    null are mapped but belong to neither program group; they are routed ``unknown_program``.
    """
    mapped = resolve_id(df, person, key, person_key, "personid", "person_id", how="left")
    known = F.col("person_id").isNotNull()
    where = (
        F.when(~known, "error")
        .when(field(program).isin(*SAFETY_PROGRAMS), "safety")
        .when(field(program).isNotNull(), "other")
        .otherwise("unknown_program")
    )
    return mapped.withColumns(
        {
            "isvalid": known,
            "error_message": F.when(~known, F.lit(MESSAGES["unmapped"])),
            "route": where,
        }
    )


def flag_first_transfers(df: DataFrame, tie: Sequence[str], program: str = "trainingprogram") -> DataFrame:
    """Mark the first valid transfer per person, program and hours (``is_first``); invalid rows are left out."""
    valid = df.filter(F.col("isvalid").cast("string") == "true")
    return flag_first(valid, ["personid", program, "credithours"], ["completeddate", *tie])


def hours_match(program: Column, hours: Column, table: Mapping[str, int], whole: bool) -> Column:
    """Do the hours fit the program? ``whole`` drops fractions first. Unknown programs and null hours do not."""
    number = hours.try_cast("double")
    if whole:
        number = number.try_cast("int")
    exact = code_label(program, table) == number
    continuing = (F.trim(program) == CONTINUING) & number.between(*CONTINUING_HOURS)
    return F.coalesce(exact, F.lit(False)) | F.coalesce(continuing, F.lit(False))


def eligible_hours(
    df: DataFrame, program: str = "trainingprogram", hours: str = "credithours", survey: bool = False
) -> DataFrame:
    """Add ``hours_ok`` and, for the provider feed, the program code. The survey brings its codes along."""
    ok = hours_match(F.col(program), F.col(hours), SURVEY_HOURS if survey else FEED_HOURS, whole=not survey)
    out = df.withColumn("hours_ok", ok)
    return out if survey else out.withColumn("trainingprogramcode", code_label(program, PROGRAM_CODES))


def not_in_history(df: DataFrame, history: DataFrame, keys: Sequence[str], mode: str = "anti") -> DataFrame:
    """Drop transfers already in production.

    ``mode='anti'`` removes rows whose keys are all found there. ``mode='self'`` checks against history plus the
    transfers themselves, as one existing job does; every row then finds itself, so only null keys are removed.
    """
    if mode == "anti":
        return anti(df, history, keys)
    if mode != "self":
        raise ValueError(f"unknown mode {mode!r}")
    return df.dropna(subset=list(keys))


def apply_transfer_rules(
    transfers: DataFrame,
    person: DataFrame,
    requirement: DataFrame,
    program: str = "trainingprogram",
    completed: str = "completeddate",
    only: Column | None = None,
) -> DataFrame:
    """Join person and active requirement and evaluate the rules.

    Adds ``is_valid``, ``error_message``, ``transferhours`` and ``additionalerrors``. Several active requirements
    for one person and program give several rows. Hours are compared as decimals. Rows outside ``only`` pass
    through without looking for a requirement, so they are not multiplied.
    """
    hired = person.select(F.col("personid").alias("_pid"), F.col("hiredate").alias("_hired"))
    hours = {n: F.col(n).try_cast(HOURS) for n in ("requiredhours", "earnedhours", "transferredhours")}
    active = requirement.filter(F.lower("status") == "active").select(
        F.col("personid").alias("_rid"),
        F.col("trainingprogram").alias("_program"),
        F.col("trackingdate").cast("date").alias("_from"),
        F.coalesce("duedateextension", "duedate").cast("date").alias("_due"),
        hours["requiredhours"].alias("_required"),
        hours["earnedhours"].alias("_earned"),
        hours["transferredhours"].alias("_transferred"),
    )
    wanted = F.col(program) if only is None else F.when(only, F.col(program))
    named = transfers.withColumn("_wanted", wanted).join(hired, F.col("personid") == F.col("_pid"), "left")
    joined = named.join(active, (F.col("personid") == F.col("_rid")) & (F.col("_wanted") == F.col("_program")), "left")

    def or_zero(c: Column) -> Column:
        return F.coalesce(c, F.lit(0).cast(HOURS))

    done = F.col(completed).cast("date")
    given = F.col("credithours").try_cast(HOURS)
    basic = F.col("trainingprogramcode").isin(*BASIC_CODES)
    continuing = F.col("trainingprogramcode") == CONTINUING_CODE
    before_hire = F.coalesce(done < F.col("_hired"), F.lit(False))
    open_requirement = F.col("_rid").isNotNull()
    in_window = done.between(F.col("_from"), F.col("_due"))
    late_hire = F.col("_hired") >= F.lit(CONTINUING_HIRED_FROM).cast("date")
    required, earned, transferred = (or_zero(F.col(c)) for c in ("_required", "_earned", "_transferred"))
    room = F.col("_required") - earned - transferred

    return joined.withColumns(
        {
            "is_valid": ~before_hire & open_requirement,
            "error_message": F.when(before_hire, MESSAGES["before_hire"]).when(
                ~open_requirement, MESSAGES["no_requirement"]
            ),
            "transferhours": F.when(basic & (given == F.col("_required")) & (done <= F.col("_due")), given.cast("double")).when(
                continuing & in_window & (room == given) & late_hire, (given + transferred).cast("double")
            ),
            "additionalerrors": F.when(continuing & ~in_window, MESSAGES["continuing_window"])
            .when(basic & (done > F.col("_due")), MESSAGES["basic_late"])
            .when(continuing & ~late_hire, MESSAGES["hired_early"])
            .when(continuing & (earned + or_zero(given) > required), MESSAGES["excess"]),
        }
    ).drop("_wanted", "_pid", "_hired", "_rid", "_program", "_from", "_due", "_required", "_earned", "_transferred")


def route_transfers(ruled: DataFrame) -> DataFrame:
    """``staging`` when valid with hours, else ``rule_error`` with all messages joined by ``;``."""
    good = F.col("is_valid") & F.col("transferhours").isNotNull()
    message = F.concat_ws(";", "error_message", "additionalerrors")
    return ruled.withColumns(
        {
            "route": F.when(good, "staging").otherwise("rule_error"),
            "error_message": F.when(~good, message),
        }
    ).drop("additionalerrors")


def _route_all(
    marked: DataFrame,
    history: DataFrame,
    keys: Sequence[str],
    person: DataFrame,
    requirement: DataFrame,
    program: str,
    completed: str,
    skipped: Column,
) -> DataFrame:
    """One pass over marked transfers (``is_first``, ``hours_ok``): history check, rules, reason of each reject.

    Only first eligible rows look for partners. The others keep a null in one part of the join keys, so they
    match nothing, are not multiplied, and still spread by person.
    """
    candidate = F.col("is_first") & F.col("hours_ok") & ~skipped
    held = history.select(*[F.col(k).alias(f"_held{i}") for i, k in enumerate(keys)]).distinct()
    asked = marked.withColumn("_hours", F.when(candidate, F.col("_hours")))
    checked = lookup(asked, held, [(k, f"_held{i}") for i, k in enumerate(keys)])
    checked = checked.withColumn("_fresh", candidate & F.col("_held0").isNull()).drop(*held.columns)
    ruled = apply_transfer_rules(checked, person, requirement, program, completed, only=F.col("_fresh"))
    fresh = F.col("_fresh")
    why = (
        F.when(skipped, "unfinished")
        .when(~F.col("is_first"), "duplicate")
        .when(~F.col("hours_ok"), "rejected_hours")
        .when(~fresh, "in_history")
        .otherwise(F.col("route"))
    )
    return (
        route_transfers(ruled)
        .withColumns(
            {
                "route": why,
                "transferhours": F.when(fresh, F.col("transferhours")),
                "error_message": F.when(fresh, F.col("error_message")),
            }
        )
        .drop("_fresh", "_hours", "is_first", "hours_ok", "is_valid")
    )


def feed_transfers(
    transfers: DataFrame, person: DataFrame, requirement: DataFrame, history: DataFrame, tie: Sequence[str]
) -> DataFrame:
    """Provider-feed transfers to one routed frame.

    Routes: staging, rule_error, duplicate, rejected_hours, in_history. ``history`` has personid,
    trainingprogram, transferhours. Every valid input row is routed.
    """
    marked = eligible_hours(flag_first_transfers(transfers, tie)).withColumn(
        "_hours", F.col("credithours").try_cast("decimal(5,2)")
    )
    past = history.select("personid", "trainingprogram", F.col("transferhours").try_cast("decimal(5,2)").alias("_hours"))
    keys = ["personid", "trainingprogram", "_hours"]
    return _route_all(marked, past, keys, person, requirement, "trainingprogram", "completeddate", F.lit(False))


def clean_course(df: DataFrame, catalog: DataFrame, mode: str = "suffix") -> DataFrame:
    """Survey course titles to program names, course codes and program codes.

    ``coursename_cleaned`` is the title without its marker, null when it has none. ``coursecode`` keeps the
    free-text code only when it looks like one. Programs come from the distinct catalog programs.
    """
    title = F.col("course_name")
    cleaned = None
    for suffix in TITLE_SUFFIXES:
        hit, value = title.contains(suffix), strip_suffix(title, suffix, mode)
        cleaned = F.when(hit, value) if cleaned is None else cleaned.when(hit, value)
    code = F.col("code_text")
    looks_right = code.rlike("^[^#]") & code.rlike(COURSE_CODE_PATTERN)
    programs = (
        catalog.filter(F.col("trainingprogramcode") != EXCLUDED_PROGRAM)
        .select("trainingprogramtype", "trainingprogramcode")
        .distinct()
    )
    out = df.withColumns({"coursename_cleaned": cleaned, "coursecode": F.when(looks_right, code)})
    return out.join(programs, F.col("coursename_cleaned") == F.col("trainingprogramtype"), "left")


def survey_transfers(
    survey: DataFrame,
    catalog: DataFrame,
    person: DataFrame,
    requirement: DataFrame,
    history: DataFrame,
    tie: Sequence[str],
) -> DataFrame:
    """Survey transfers to one routed frame.

    Routes: staging, rule_error, duplicate, rejected_hours, in_history, unfinished. Only finished responses
    whose hours fit their program reach the rules. A duplicate is a later row of the same person, program and class
    (``continuing_education_information_1``), whatever its hours. History is matched on person, program, hours and course code.
    """
    titled = clean_course(survey.distinct(), catalog)
    ranked = flag_first(titled, ["personid", "trainingprogramcode", "continuing_education_information_1"], ["completed_date", *tie])
    marked = eligible_hours(ranked, "trainingprogramtype", "credithours", survey=True).withColumn(
        "_hours", F.col("credithours").try_cast("decimal(5,2)")
    )
    past = history.select(
        "personid",
        F.col("trainingprogram").alias("trainingprogramtype"),
        F.col("transferhours").try_cast("decimal(5,2)").alias("_hours"),
        "coursecode",
    )
    keys = ["personid", "trainingprogramtype", "_hours", "coursecode"]
    unfinished = ~F.coalesce(F.col("finished") == "True", F.lit(False))
    return _route_all(marked, past, keys, person, requirement, "trainingprogramtype", "completed_date", unfinished)

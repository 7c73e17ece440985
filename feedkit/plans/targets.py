"""The stored tables that routed rows end in: their columns and types, and one write for all of them.

A routed frame is computed once and written in parts by route; every target then reads the parts of its own routes,
takes its columns and writes them below ``<root>/run=<run>``. A run that is repeated replaces its own rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, functions as F

from ..operators.mapping import apply_mapping
from ..session import scratch_dir
from .feeds import TRANSFER_HEADINGS, MappingList, feed_mapping
from .reports import load_feed

# Columns of the training history.
TRAINING_HISTORY: MappingList = [
    ("personid", "long", "personid", "long"),
    ("dshsid", "long", "dshsid", "long"),
    ("courseid", "string", "courseid", "string"),
    ("completeddate", "date", "completeddate", "date"),
    ("coursename", "string", "coursename", "string"),
    ("credithours", "double", "credithours", "double"),
    ("trainingprogramtype", "string", "trainingprogramtype", "string"),
    ("trainingprogramcode", "long", "trainingprogramcode", "long"),
    ("coursetype", "string", "coursetype", "string"),
    ("courselanguage", "string", "courselanguage", "string"),
    ("instructorname", "string", "instructorname", "string"),
    ("instructorid", "string", "instructorid", "string"),
    ("trainingsource", "string", "trainingsource", "string"),
    ("filedate", "date", "filedate", "date"),
]

#: The log of safety transfers: the same columns without the file date, hours whole.
TRAINING_HISTORY_LOG: MappingList = [
    (source, kind, target, "int" if target == "credithours" else to) for source, kind, target, to in TRAINING_HISTORY if target != "filedate"
]

#: The log of completions that are not unique or have no person. The learning system's and the form's ids stay with them.
UNIQUE_LOG: MappingList = [m for m in TRAINING_HISTORY if m[2] != "filedate"] + [
    (c, kind, c, kind) for c, kind in (("recordcreateddate", "timestamp"), ("recordmodifieddate", "timestamp"), ("qual_person_id", "long"), ("dshscourseid", "string"))
]

# Columns of staged transfers. Their hours are the transfer's own credit hours, as they were always stored;
# the hours that the rules computed are ``transferhours`` of the routed frame.
STAGED_TRANSFERS: MappingList = [
    ("employeeid", "bigint", "employeeid", "bigint"),
    ("personid", "bigint", "personid", "bigint"),
    ("trainingprogram", "string", "trainingprogram", "string"),
    ("trainingprogramcode", "string", "trainingprogramcode", "string"),
    ("classname", "string", "classname", "string"),
    ("dshscoursecode", "string", "dshscoursecode", "string"),
    ("credithours", "string", "transferhours", "double"),
    ("completeddate", "date", "completeddate", "date"),
    ("trainingentity", "string", "transfersource", "string"),
    ("reasonfortransfer", "string", "reasonfortransfer", "string"),
    ("filename", "string", "filename", "string"),
]

# Columns of the log of transfers.
TRANSFER_LOG: MappingList = [
    ("employeeid", "bigint", "employeeid", "bigint"),
    ("personid", "bigint", "personid", "bigint"),
    ("trainingprogram", "string", "trainingprogram", "string"),
    ("classname", "string", "classname", "string"),
    ("dshscoursecode", "string", "dshscoursecode", "string"),
    ("credithours", "string", "credithours", "string"),
    ("completeddate", "date", "completeddate", "date"),
    ("trainingentity", "string", "trainingentity", "string"),
    ("reasonfortransfer", "string", "reasonfortransfer", "string"),
    ("employerstaff", "string", "employerstaff", "string"),
    ("createddate", "date", "createddate", "date"),
    ("filedate", "date", "filedate", "date"),
    ("filename", "string", "filename", "string"),
    ("error_message", "string", "error_message", "string"),
]

# Headings of the file of rejected attendance rows. (The last name once came under "First Name" too.)
ERROR_HEADINGS = {
    "date": "Date",
    "learner_id": "Learner ID",
    "class_id": "Class ID",
    "last_name": "Last Name",
    "class_title": "Class Title",
    "duration": "Duration",
    "learner_email": "Learner Email",
    "instructor": "Instructor",
    "when_enrolled": "When Enrolled",
    "phone_number": "Phone Number",
    "first_name": "First Name",
    "status": "Status",
}

# What the log keeps of a rejected attendance row.
ERROR_LOG: MappingList = [
    ("learner_id", "string", "personid", "long"),
    ("class_title", "string", "coursename", "string"),
    ("class_id", "string", "courseid", "string"),
    ("date", "string", "completeddate", "date"),
    ("duration", "string", "credithours", "double"),
    ("instructor", "string", "instructorname", "string"),
]

#: The transfer drop as it came: every column a text.
TRANSFER_TEXTS = feed_mapping(TRANSFER_HEADINGS, joiner="")


class Target(NamedTuple):
    """A stored table: which routes it takes, which columns, and where it lies."""

    routes: Sequence[str]
    mapping: MappingList
    root: str


def store_routes(routed: DataFrame, targets: Sequence[Target], run: str) -> None:
    """Write every target's rows of ``routed`` (``route``) below its root as ``run``. Columns the frame lacks are null.

    Routes that no target takes are an error, so that no row is lost by a name spelled differently.
    """
    staged = f"{scratch_dir(routed.sparkSession, 'routes')}/rows"
    routed.write.partitionBy("route").parquet(staged)
    rows = routed.sparkSession.read.schema(routed.schema).parquet(staged)
    taken = {r for t in targets for r in t.routes}
    routes = rows.agg(F.collect_set(F.coalesce("route", F.lit("no route")))).first()[0]  # as many as the folders just written
    left = sorted(r for r in routes if r not in taken)
    if left:
        raise ValueError(f"no target takes {left}")
    for t in targets:
        own = rows.filter(F.col("route").isin(*t.routes))
        apply_mapping(own, t.mapping, missing="null").write.mode("overwrite").parquet(f"{t.root.rstrip('/')}/run={run}")


def stage_rejected(routed: DataFrame) -> DataFrame:
    """The rejected rows of validated completions, written once: their file and their log are read from what is stored."""
    staged = f"{scratch_dir(routed.sparkSession, 'rejected')}/rows"
    routed.filter("route <> 'valid'").write.option("compression", "zstd").parquet(staged)
    return routed.sparkSession.read.schema(routed.schema).parquet(staged)


def completion_errors(routed: DataFrame, headings: dict[str, str] = ERROR_HEADINGS) -> tuple[DataFrame, DataFrame]:
    """Of validated completions the rejected ones: the rows of the error file under its headings, and those of the log.

    The file has the headings of the columns that the frame has, in their order; ``route`` and the others keep out.
    """
    bad = routed.filter("route <> 'valid'")
    named = {c.lower(): c for c in routed.columns}
    file = bad.select(*[F.col(f"`{named[c]}`").alias(h) for c, h in headings.items() if c in named])
    return file, apply_mapping(bad, ERROR_LOG, missing="null")


def load_transfer_texts(df: DataFrame, prefix: str) -> DataFrame:
    """The transfer drop as plain text: names joined, blanks to null, quotes out of the creation date, the file's date."""
    bare = df.withColumn("CreatedDate", F.replace(F.col("CreatedDate"), F.lit('"'), F.lit("")))
    mapping = [*TRANSFER_TEXTS, ("filename", "string", "filename", "string"), ("filemodifieddate", "date", "filemodifieddate", "date")]
    return load_feed(bare, mapping, prefix, "yyyy-MM-dd", "filemodifieddate")

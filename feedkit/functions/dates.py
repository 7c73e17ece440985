"""Date parsing that never raises: what does not fit becomes null, also under ANSI mode."""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import Column, functions as F

from .text import as_col


def as_of_date(as_of) -> Column:
    """The reference day as a column; the current day when none is given."""
    if as_of is None:
        return F.current_date()
    return as_of if isinstance(as_of, Column) else F.lit(str(as_of)).cast("date")


def _up_to(yy: int) -> str:
    """Pattern of the two-digit numbers 00..yy."""
    tens, ones = divmod(yy, 10)
    lower = [rf"[0-{tens - 1}]\d"] if tens else []
    return "|".join([*lower, f"{tens}[0-{ones}]"])


# Pattern letters of the accepted date formats. One-digit months and days pass where a separator sets them off.
_PARTS = {"yyyy": r"(\d{4})", "yy": r"(\d{2})", "MM": r"(0[1-9]|1[0-2])", "dd": r"(0[1-9]|[12]\d|3[01])"}
_LOOSE = _PARTS | {"MM": r"(0?[1-9]|1[0-2])", "dd": r"(0?[1-9]|[12]\d|3[01])"}
_SANE_YEAR = r"(19(?!00)\d{2}|[2-9]\d{3})"
_TOKEN = re.compile("yyyy|yy|MM|dd")


def _shape(fmt: str, sane: bool) -> tuple[str, list[str]]:
    """Pattern of a date format without anchors, and its tokens in order."""
    parts = _LOOSE if re.search("[^A-Za-z]", fmt) else _PARTS
    if sane:
        parts = parts | {"yyyy": _SANE_YEAR}
    literal = re.sub("[^A-Za-z]", lambda m: re.escape(m[0]), fmt)
    return _TOKEN.sub(lambda m: parts[m[0]], literal), _TOKEN.findall(fmt)


# Put in front of a text: a mark no date begins with, so that text no pattern rewrites stays unparsed, and the
# centuries a match with a two-digit year takes its own from.
_MARK, _CENTURIES = "~", "2019"


def _alternatives(fmt: str, sane: bool, newest: int | None) -> list[tuple[str, str, list[str]]]:
    """Patterns of a format, with the role of each of their groups; two per format with a two-digit year."""
    pattern, tokens = _shape(fmt, sane)
    if "yyyy" in fmt:
        return [("" if newest is None else _CENTURIES, pattern, tokens)]
    older = ("20(19)", pattern, ["yyyy", *tokens])
    if newest < 0:
        return [older]
    recent = pattern.replace(_PARTS["yy"], f"({_up_to(newest)})")
    return [("(20)19", recent, ["yyyy", *tokens]), older]


# Years beyond the run that a two-digit year may lie in, where dates are entered ahead: hires, terminations, enrolments.
# Dates of birth lie in the past.
YEARS_AHEAD = 20


def parse_date(c: Column | str, *formats: str, as_of=None, years_ahead: int = 0, sane: bool = False) -> Column:
    """Date from the first format that fits; null when none does. ``sane`` takes years after 1900 only.

    With a separator, one-digit months and days are accepted. A two-digit year after ``as_of`` (plus
    ``years_ahead``) belongs to the 1900s; ``as_of`` is then a day, by default the day the plan is built.

    All formats become one pattern that rewrites the text to ISO form, which is cast once. The input expression
    so appears once however many formats are tried (copies of it would outgrow generated code), and a value that
    fits none costs no exception.
    """
    if sum(not re.search("[^A-Za-z]", f) for f in formats) > 1:
        return F.coalesce(*[parse_date(c, f, as_of=as_of, years_ahead=years_ahead, sane=sane) for f in formats])
    lead, newest = _MARK, None
    if any("yyyy" not in f for f in formats):
        day = dt.date.today() if as_of is None else dt.date.fromisoformat(str(as_of))
        lead, newest = _MARK + _CENTURIES, min(day.year + years_ahead - 2000, 99)
    text = F.concat(F.lit(lead), F.trim(as_col(c)))
    patterns, refs, group = [], {"yyyy": "", "MM": "", "dd": ""}, 0
    for fmt in formats:
        for century, pattern, roles in _alternatives(fmt, sane, newest):
            patterns.append(century + pattern)
            for role in roles:
                group += 1
                refs["yyyy" if role == "yy" else role] += f"${group}"
    # Only the groups of the alternative that matched hold text; the others add nothing.
    iso = F.regexp_replace(text, f"^{_MARK}(?:{'|'.join(patterns)})$", f"{refs['yyyy']}-{refs['MM']}-{refs['dd']}")
    return iso.try_cast("date")


# Shapes accepted by the free-form parser.
FREE_FORMATS = (
    "yyyy-MM-dd HH:mm:ss",
    "yyyy-MM-dd'T'HH:mm:ss",
    "yyyy-MM-dd HH:mm",
    "yyyy-MM-dd",
    "M/d/yyyy H:mm:ss",
    "M/d/yyyy H:mm",
    "M/d/yyyy h:mm a",
    "M/d/yyyy",
    "M-d-yyyy",
    "yyyyMMdd",
    "MMM d, yyyy",
    "d MMM yyyy",
)


def _ts_shape(fmt: str) -> str:
    """Rough pattern of a timestamp format: which digits and separators it needs."""
    out = ""
    for run in re.finditer(r"'[^']*'|([A-Za-z])\1*|[^A-Za-z']", fmt):
        piece = run[0]
        if piece.startswith("'"):
            out += re.escape(piece.strip("'"))
        elif not piece[0].isalpha():
            out += re.escape(piece)
        elif piece == "a":
            out += "[AaPp][Mm]"
        elif piece == "MMM":
            out += "[A-Za-z]{3}"
        else:
            out += r"\d{1,2}" if len(piece) == 1 else rf"\d{{{len(piece)}}}"
    return f"^{out}$"


def parse_ts(c: Column | str, *formats: str) -> Column:
    """Timestamp by the format whose shape the text has; formats of one shape are tried in order.

    Looking at the shape first leaves at most one failing parse per value.
    """
    c = F.trim(as_col(c))
    by_shape: dict[str, list[str]] = {}
    for fmt in formats:
        by_shape.setdefault(_ts_shape(fmt), []).append(fmt)
    out = None
    for shape, group in by_shape.items():
        parsed = F.coalesce(*[F.try_to_timestamp(c, F.lit(f)) for f in group])
        out = F.when(c.rlike(shape), parsed) if out is None else out.when(c.rlike(shape), parsed)
    return out


def parse_ts_any(c: Column | str) -> Column:
    """Timestamp from free-form text."""
    return parse_ts(c, *FREE_FORMATS)


def sane_date(c: Column | str) -> Column:
    """The date when its year is after 1900, else null."""
    c = as_col(c)
    return F.when(F.year(c) > 1900, c)


# Fixed value: days a person must have lived to count as adult.
ADULT_DAYS = 18 * 365 + 4


def newest_birth(as_of=None) -> Column:
    """Latest date of birth of an adult."""
    return F.date_sub(as_of_date(as_of), ADULT_DAYS)


def adult(c: Column | str, as_of=None) -> Column:
    c = as_col(c)
    return (F.year(c) >= 1900) & (c <= newest_birth(as_of))


def file_date(name: Column | str, prefix: str, fmt: str) -> Column:
    """Date (or timestamp, when the format has hours) embedded in a file name right after ``prefix``."""
    shape = re.sub("[A-Za-z]", r"\\d", fmt)
    text = F.regexp_extract(as_col(name), re.escape(prefix) + f"({shape})" + r"\.\w+$", 1)
    return F.try_to_timestamp(text, F.lit(fmt)) if "H" in fmt else parse_date(text, fmt)


def export_name(stem: str, as_of, fmt: str, ext: str = ".csv") -> Column:
    """File name made of a stem and a formatted run time."""
    when = as_of if isinstance(as_of, Column) else F.lit(str(as_of)).cast("timestamp")
    return F.concat(F.lit(stem), F.date_format(when, fmt), F.lit(ext))


def error_name(name: Column | str) -> Column:
    """Input file name without its extension, plus ``-error.csv``."""
    return F.concat(F.regexp_replace(as_col(name), r"\.\w+$", ""), F.lit("-error.csv"))

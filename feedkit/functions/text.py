"""Text clean-up expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F


def field(name: str) -> Column:
    """Column by its literal name, which may hold blanks or dots (raw feed headings do)."""
    return F.col("`" + name.replace("`", "``") + "`")


def as_col(c: Column | str) -> Column:
    return field(c) if isinstance(c, str) else c


def blank_as_null(c: Column | str) -> Column:
    return F.nullif(as_col(c), F.lit(""))


def strip_suffix(c: Column | str, suffix: str, mode: str = "suffix") -> Column:
    """Drop a trailing marker such as ``(CE)`` together with the blanks around it.

    ``mode='suffix'`` removes exactly the marker. ``mode='charset'`` removes any run of the marker's
    characters (SQL ``trim(TRAILING 'chars' FROM x)``), which also eats letters of the title itself.
    """
    trimmed = F.trim(as_col(c))
    if mode == "suffix":
        return F.regexp_replace(trimmed, r"\s*" + re.escape(suffix) + "$", "")
    if mode == "charset":
        return F.rtrim(trimmed, F.lit(" " + suffix))
    raise ValueError(f"unknown mode {mode!r}")


def pad_id(c: Column | str, n: int) -> Column:
    """Left-pad with zeros up to ``n`` characters; longer values and nulls stay as they are."""
    c = as_col(c)
    return F.when(F.length(c) < n, F.lpad(c, n, "0")).otherwise(c)


def last4(c: Column | str, pad: int | None = 9) -> Column:
    """Last four characters, after zero-padding to ``pad`` when given."""
    c = as_col(c)
    return F.right(c if pad is None else pad_id(c, pad), F.lit(4))


def digits(c: Column | str) -> Column:
    return F.regexp_replace(as_col(c), "[^0-9]", "")


def normalize_phone(c: Column | str) -> Column:
    """``1`` plus the last ten digits, or null when there are fewer than ten."""
    tail = F.right(digits(c), F.lit(10))
    return F.when(F.length(tail) == 10, F.concat(F.lit("1"), tail))


def prefix_phone(c: Column | str) -> Column:
    """``1`` plus the value with everything but upper-case letters, digits and ``_`` removed."""
    return F.concat(F.lit("1"), F.regexp_replace(as_col(c), "[^A-Z0-9_]", ""))


# Contact patterns. Repeated groups start with a separator, so a long value that does not match fails in linear
# time instead of backtracking through every split of a word.
EMAIL_PATTERN = r"^\w+([.-]\w+)*@\w+([.-]\w+)*(\.\w{2,3})+$"
PHONE_PATTERN = r"^(\+?\d?-?\(?\d{3}\)?[\s.-]?)?\d{3}[\s.-]?\d{4}"


def phone_ok(c: Column | str) -> Column:
    c = as_col(c)
    return F.coalesce(c.rlike(PHONE_PATTERN), F.lit(True))


def email_ok(c: Column | str) -> Column:
    c = as_col(c)
    return F.coalesce(c.rlike(EMAIL_PATTERN), F.lit(True))


def digits_only(c: Column | str, max_length: int | None = None) -> Column:
    """The value when it is all digits (and not too long), else null."""
    c = as_col(c)
    ok = c.rlike("^[0-9]+$")
    if max_length is not None:
        ok = ok & (F.length(c) <= max_length)
    return F.when(ok, c)


def word(c: Column | str, i: int, pattern: str = r"\s+") -> Column:
    """The ``i``-th piece (from 0) of a split, null when there are fewer."""
    return F.get(F.split(as_col(c), pattern), F.lit(i))


def join_address(*parts: Column | str) -> Column:
    """Parts joined with ``', '``; null when any part is null."""
    pieces: list[Column] = []
    for p in parts:
        pieces += [F.lit(", "), as_col(p)]
    return F.concat(*pieces[1:])


def file_name_of(uri: Column | str) -> Column:
    """Base name of a path or URI."""
    return F.regexp_extract(as_col(uri), "([^/]+)$", 1)

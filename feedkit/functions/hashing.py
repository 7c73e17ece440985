"""Row hashes, source keys and protected id columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .text import as_col


def row_hash(*cols: Column | str, mode: str = "safe") -> Column:
    """md5 over several columns.

    ``mode='safe'`` separates the values and marks nulls, so ('ab','c'), ('a','bc') and a moved null all differ.
    ``mode='plain'`` joins without a separator and skips nulls, as older snapshots were hashed.
    """
    texts = [as_col(c).cast("string") for c in cols]
    if mode == "plain":
        return F.md5(F.concat_ws("", *texts))
    if mode != "safe":
        raise ValueError(f"unknown mode {mode!r}")
    return F.md5(F.concat_ws("\u001f", *[F.coalesce(t, F.lit("\u0000")) for t in texts]))


def source_key(label: Column | str, *cols: Column | str) -> Column:
    """``label-`` plus the first ten characters of the plain md5 of the columns. A plain str label is a literal."""
    lead = label if isinstance(label, Column) else F.lit(label)
    return F.concat(lead, F.lit("-"), F.substring(row_hash(*cols, mode="plain"), 1, 10))


def protect_column(df: DataFrame, col: str, key: str | Column, to: str | None = None) -> DataFrame:
    """Encrypt a text column with AES-GCM and encode it as base64.

    Every call draws a fresh nonce, so equal values give different tokens: compare through ``reveal_column``
    or ``fingerprint``.
    """
    secret = key if isinstance(key, Column) else F.lit(key)
    return df.withColumn(to or col, F.base64(F.aes_encrypt(as_col(col).cast("string"), secret)))


def reveal_column(df: DataFrame, col: str, key: str | Column, to: str | None = None) -> DataFrame:
    """Decrypt a protected column; a token that does not fit the key gives null."""
    secret = key if isinstance(key, Column) else F.lit(key)
    return df.withColumn(to or col, F.try_aes_decrypt(F.unbase64(as_col(col)), secret).cast("string"))


def fingerprint(c: Column | str, key: str) -> Column:
    """Keyed sha-256, stable across runs: an equality key for protected ids."""
    return F.sha2(F.concat(F.lit(key), F.lit("\u001f"), as_col(c).cast("string")), 256)

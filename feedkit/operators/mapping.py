"""Column mapping and cleaning. Every operator is one projection."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions.text import blank_as_null, field

# Type names accepted in mappings that Spark spells differently.
TYPE_NAMES = {"long": "bigint", "decimal": "decimal(10,2)", "numeric": "decimal(10,2)", "text": "string"}


def spark_type(name: str) -> str:
    name = name.strip().lower()
    if name.startswith("numeric("):
        return "decimal" + name[len("numeric"):]
    return TYPE_NAMES.get(name, name)


def cast_or_null(c: Column | str, type_name: str) -> Column:
    """Cast; a value that does not fit becomes null."""
    c = field(c) if isinstance(c, str) else c
    return c.try_cast(spark_type(type_name))


def apply_mapping(df: DataFrame, mapping: Sequence[tuple[str, str, str, str]], missing: str = "skip") -> DataFrame:
    """Select, rename and cast by ``(source, source type, target, target type)``; unlisted columns are dropped.

    Source names match in any case and one source may feed several targets. A source the frame lacks is
    skipped, or becomes a typed null with ``missing='null'``, or raises with ``missing='error'``.
    """
    present = {c.lower() for c in df.columns}
    out = []
    for source, source_type, target, target_type in mapping:
        if source.lower() in present:
            c = field(source)
            if spark_type(source_type) not in (spark_type(target_type), "string"):
                c = cast_or_null(c, source_type)
            out.append(cast_or_null(c, target_type).alias(target))
        elif missing == "null":
            out.append(F.lit(None).cast(spark_type(target_type)).alias(target))
        elif missing == "error":
            raise ValueError(f"no column {source!r}")
    return df.select(*out)


def select_existing(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Keep the listed columns, ignoring those the frame lacks."""
    present = {c.lower() for c in df.columns}
    return df.select(*[field(n) for n in names if n.lower() in present])


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Cast to the target table's columns and types, in its order; absent columns become null."""
    present = {c.lower() for c in df.columns}
    return df.select(
        *[
            (field(f.name).try_cast(f.dataType) if f.name.lower() in present else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in schema.fields
        ]
    )


def split_by_type(df: DataFrame, col: str, types: Sequence[str]) -> DataFrame:
    """Split a mixed-type text column into one column per type, named ``col_type``.

    A value lands in the first listed type it fits; the others stay null.
    """
    taken = F.lit(False)
    new = {}
    for name in types:
        value = cast_or_null(col, name)
        new[f"{col}_{name}"] = F.when(~taken, value)
        taken = taken | value.isNotNull()
    return df.withColumns(new).drop(col)


def drop_all_null_columns(df: DataFrame) -> DataFrame:
    """Drop columns without a single value. Decided in one aggregation that returns one row."""
    if not df.columns:
        return df
    names = df.columns
    filled = df.agg(*[F.max(field(c).isNotNull()).alias(f"c{i}") for i, c in enumerate(names)]).first()
    return df.select(*[field(c) for i, c in enumerate(names) if filled[i]])


def _strings(df: DataFrame) -> set[str]:
    return {f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)}


def blank_to_null(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Empty text becomes null in the listed columns, or in every text column."""
    wanted = _strings(df) if cols is None else set(cols)
    return df.select(*[blank_as_null(c).alias(c) if c in wanted else field(c) for c in df.columns])


def trim_all(df: DataFrame) -> DataFrame:
    strings = _strings(df)
    return df.select(*[F.trim(field(c)).alias(c) if c in strings else field(c) for c in df.columns])


def rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(names))


def with_literals(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    return df.withColumns({k: F.lit(v) for k, v in values.items()})


def with_null(df: DataFrame, name: str, type_name: str) -> DataFrame:
    """A typed null column (an untyped one cannot be written)."""
    return df.withColumn(name, F.lit(None).cast(spark_type(type_name)))


def flag(df: DataFrame, name: str, cond: Column, as_text: bool = False) -> DataFrame:
    """Boolean (or 'true'/'false' text) from a condition; an unknown condition counts as false."""
    yes, no = (F.lit("true"), F.lit("false")) if as_text else (F.lit(True), F.lit(False))
    return df.withColumn(name, F.when(cond, yes).otherwise(no))


def pick_by(df: DataFrame, key: str, choices: Mapping[str, Mapping[str, str]]) -> DataFrame:
    """Fill target columns from the source columns of the row's status code.

    ``choices`` is ``{code: {target: source}}``. A null code gives ``''``, an unlisted code gives null.
    """
    targets: dict[str, Column | None] = {}
    for code, columns in choices.items():
        for target, source in columns.items():
            branch = targets.get(target)
            hit = field(key) == F.lit(code)
            targets[target] = F.when(hit, field(source)) if branch is None else branch.when(hit, field(source))
    return df.withColumns({t: c.when(field(key).isNull(), F.lit("")) for t, c in targets.items()})


def code_label(c: Column | str, codes: Mapping) -> Column:
    """Look a code up in a small literal table; unlisted codes give null."""
    c = field(c) if isinstance(c, str) else c
    pairs = [F.lit(x) for pair in codes.items() for x in pair]
    return F.try_element_at(F.create_map(*pairs), c)


def map_codes(df: DataFrame, col: str, codes: Mapping | DataFrame, to: str | None = None) -> DataFrame:
    """Map codes to labels through a literal table, or through a two-column ``(code, label)`` frame.

    A frame is left-joined and Spark picks the join from its size.
    """
    if isinstance(codes, Mapping):
        return df.withColumn(to or col, code_label(col, codes))
    code, label = codes.columns
    table = codes.select(field(code).alias("_code"), field(label).alias("_label"))
    joined = df.join(table, field(col) == F.col("_code"), "left").drop("_code")
    if (to or col) in df.columns:
        return joined.withColumn(to or col, F.col("_label")).drop("_label")
    return joined.withColumnRenamed("_label", to or col)


def stringify(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Cast columns to text, as done before an export."""
    return df.withColumns({c: field(c).cast("string") for c in cols})

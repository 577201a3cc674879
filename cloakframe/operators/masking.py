"""Masking of whole tables and the reports around it. Everything but the reports' final sums is a
narrow projection: no shuffle, no Python per row."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cloakframe.functions import detect, mask, names
from cloakframe.functions.text import plain_number

TEXT_TYPES = (T.StringType, T.CharType, T.VarcharType)


def _as_text(col: Column, data_type: T.DataType) -> Column:
    if isinstance(data_type, TEXT_TYPES):
        return col
    if isinstance(data_type, T.DoubleType):
        return plain_number(col)
    if isinstance(data_type, T.FloatType):
        return plain_number(col, 1e7)
    if isinstance(data_type, T.BooleanType):
        return F.initcap(col.cast("string"))
    return col.cast("string")


def _masked_text(df_name: str, data_type: T.DataType, numeric: str) -> bool:
    """Is the column masked as one text value?"""
    if isinstance(data_type, TEXT_TYPES):
        return not names.is_balance_column(df_name)
    if isinstance(data_type, (T.ArrayType, T.MapType, T.StructType)):
        return False
    strict = isinstance(data_type, T.NumericType) and numeric == "strict"
    return names.is_sensitive_column(df_name) or (strict and not names.is_balance_column(df_name))


def _mask_nested(col: Column, name: str, data_type: T.DataType, numeric: str, masked: bool = True) -> Column:
    """The rules for whatever is inside arrays, maps (keys too) and structs. With ``masked=False`` the same shape
    with every value that is masked as text shown as that text."""
    if not _changes(name, data_type, numeric):
        return col
    if isinstance(data_type, T.ArrayType):
        return F.transform(col, lambda x: _mask_nested(x, name, data_type.elementType, numeric, masked))
    if isinstance(data_type, T.MapType):
        values = F.transform_values(col, lambda _, x: _mask_nested(x, name, data_type.valueType, numeric, masked))
        if not _changes(name, data_type.keyType, numeric):
            return values
        entries = F.transform(
            F.map_entries(values),
            lambda e: F.struct(_mask_nested(e["key"], name, data_type.keyType, numeric, masked).alias("key"), e["value"]),
        )
        # Of keys that are equal once masked, the last stays.
        last = F.transform(F.array(entries), lambda a: F.filter(a, lambda e, i: ~_key_follows(a, e, i)))[0]
        return F.map_from_entries(last)
    if isinstance(data_type, T.StructType):
        fields = [_mask_nested(col.getField(f.name), f.name, f.dataType, numeric, masked).alias(f.name) for f in data_type]
        return F.when(col.isNotNull(), F.struct(*fields))
    if _masked_text(name, data_type, numeric):
        text = _as_text(col, data_type)
        return mask.mask_value(text, name) if masked else text
    return col


def _key_follows(entries: Column, entry: Column, i: Column) -> Column:
    """Does an equal key come after entry number ``i``?"""
    return F.exists(F.slice(entries, i + 2, F.size(entries)), lambda later: later["key"] == entry["key"])


def _changes(name: str, data_type: T.DataType, numeric: str) -> bool:
    """Can masking change a value of this type in a column or field of this name? Items of arrays and maps go by
    the name of their column or field, fields of structs by their own."""
    if isinstance(data_type, T.ArrayType):
        return _changes(name, data_type.elementType, numeric)
    if isinstance(data_type, T.MapType):
        return _changes(name, data_type.keyType, numeric) or _changes(name, data_type.valueType, numeric)
    if isinstance(data_type, T.StructType):
        return any(_changes(f.name, f.dataType, numeric) for f in data_type)
    return _masked_text(name, data_type, numeric)


def _quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def _check(df: DataFrame, numeric: str) -> None:
    repeated = {c for c in df.columns if df.columns.count(c) > 1}
    if repeated:
        raise ValueError(f"duplicate output columns: {sorted(repeated)}")
    if numeric not in ("keep", "strict"):
        raise ValueError("numeric must be 'keep' or 'strict'")


def _side_by_side(df: DataFrame, numeric: str) -> DataFrame:
    """Original columns as ``v0, v1, …`` (as text where they are masked as text) and, next to them, the
    digits their rules share as ``d0, d1, …``. Being used several times above, the digits stay a projection of
    their own and are computed once per value."""
    columns = []
    for i, (f, col) in enumerate(zip(df.schema, _originals(df, numeric))):
        columns.append(col.alias(f"v{i}"))
        rule = names.name_rule(f.name)
        if _masked_text(f.name, f.dataType, numeric) and mask.shares_digits(rule):
            columns.append(mask.shared_digits(col, rule).alias(f"d{i}"))
    return df.select(*columns)


def _masked_column(col: Column, f: T.StructField, digits: Column | None, numeric: str) -> Column:
    """Text goes through the value ladder. Numbers keep their type unless the name is sensitive or
    ``numeric="strict"``. Dates, timestamps, booleans and binaries are masked only by name. Inside
    arrays, maps and structs the same rules apply to the text they hold."""
    if _masked_text(f.name, f.dataType, numeric):
        return mask.mask_by_rule(col, names.name_rule(f.name), digits)
    return col if isinstance(f.dataType, TEXT_TYPES) else _mask_nested(col, f.name, f.dataType, numeric)


def _over_shared_digits(df: DataFrame, numeric: str) -> list[Column]:
    """Masked columns over ``_side_by_side``."""
    return [
        _masked_column(F.col(f"v{i}"), f, F.col(f"d{i}") if mask.shares_digits(names.name_rule(f.name)) else None, numeric)
        for i, f in enumerate(df.schema)
    ]


def _originals(df: DataFrame, numeric: str) -> list[Column]:
    """The columns of a table, as text where they are masked as text."""
    return [
        _as_text(_quoted(f.name), f.dataType) if _masked_text(f.name, f.dataType, numeric) else _quoted(f.name)
        for f in df.schema
    ]


def _may_change(f: T.StructField, numeric: str) -> bool:
    return _changes(f.name, f.dataType, numeric)


def _comparable(col: Column, data_type: T.DataType) -> Column:
    """Maps cannot be compared; as JSON they can."""
    return F.to_json(F.struct(col.alias("x"))) if "map<" in data_type.simpleString() else col


def _any_differs(df: DataFrame, before: list[Column], after: list[Column], numeric: str) -> Column:
    nested = (T.ArrayType, T.MapType, T.StructType)
    pairs = []
    for f, b, a in zip(df.schema, before, after):
        if _may_change(f, numeric):
            shown = _mask_nested(b, f.name, f.dataType, numeric, masked=False) if isinstance(f.dataType, nested) else b
            pairs.append(~_comparable(shown, f.dataType).eqNullSafe(_comparable(a, f.dataType)))
    return reduce(lambda x, y: x | y, pairs) if pairs else F.lit(False)


def mask_table(df: DataFrame, numeric: str = "keep") -> DataFrame:
    """Mask every column; columns whose name and type need no check pass through untouched."""
    _check(df, numeric)
    masked = _over_shared_digits(df, numeric)
    return _side_by_side(df, numeric).select(*[c.alias(n) for n, c in zip(df.columns, masked)])


def with_change_flag(df: DataFrame, numeric: str = "keep", flag: str = "was_masked") -> DataFrame:
    """``mask_table`` plus a flag: does any cell of the row differ from the original?"""
    _check(df, numeric)
    masked = _over_shared_digits(df, numeric)
    both = _side_by_side(df, numeric).select("*", *[c.alias(f"m{i}") for i, c in enumerate(masked)])
    before, after = ([F.col(f"{x}{i}") for i in range(len(masked))] for x in "vm")
    changed = _any_differs(df, before, after, numeric)
    return both.select(*[c.alias(n) for n, c in zip(df.columns, after)], changed.alias(flag))


def mask_capped(capped: DataFrame, numeric: str = "keep", flag: str | None = None) -> DataFrame:
    """``mask_table`` for the few rows a limit leaves, optionally with the change flag.

    Spark moves projections below a limit. As a single projection the masking ends up inside the top-k
    operator, or in a scan that stops at the limit; a second projection would turn a top-k into a full sort.
    """
    _check(capped, numeric)
    before = _originals(capped, numeric)
    after = [_masked_column(c, f, None, numeric) for c, f in zip(before, capped.schema)]
    columns = [c.alias(n) for n, c in zip(capped.columns, after)]
    if flag is not None:
        columns.append(_any_differs(capped, before, after, numeric).alias(flag))
    return capped.select(*columns)


def masking_report(df: DataFrame, numeric: str = "keep") -> DataFrame:
    """One row: how many rows were read and how many had at least one cell masked."""
    flagged = with_change_flag(df, numeric)
    return flagged.agg(
        F.count("*").alias("total_rows"),
        F.count_if(F.col("was_masked")).alias("masked_rows"),
    )


def classify_columns(catalog: DataFrame, name: str = "column_name") -> DataFrame:
    """Money flag, sensitivity flag and mask kind for each column name of a catalog."""
    col = F.col(name)
    sensitive = names.is_sensitive_column(col)
    return (
        catalog.withColumn("is_balance", names.is_balance_column(col))
        .withColumn("is_sensitive", sensitive)
        .withColumn("masking_type", F.when(sensitive, names.masking_type(col)))
    )


def check_column_sensitivity(catalog: DataFrame, name: str = "column_name") -> DataFrame:
    """Sensitivity flag and the message that goes with it."""
    flagged = catalog.withColumn("is_sensitive", names.is_sensitive_column(F.col(name)))
    return flagged.withColumn("message", names.sensitivity_message(F.col("is_sensitive")))


def sensitive_column_counts(catalog: DataFrame, table: str = "table_name", name: str = "column_name") -> DataFrame:
    """Columns and sensitive columns per table of a catalog."""
    return catalog.groupBy(table).agg(
        F.count("*").alias("column_count"),
        F.count_if(names.is_sensitive_column(F.col(name))).alias("sensitive_count"),
    )


def contains_pii(values: DataFrame, value: str = "v", flag: str = "contains_pii") -> DataFrame:
    """A flag per value: does any detector fire?"""
    digits = values.withColumn("__digits", detect.rule_digits(F.col(value)))
    return digits.withColumn(flag, detect.contains_pii(F.col(value), F.col("__digits"))).drop("__digits")


def _with_rules(values: DataFrame, value: str, name: str | None) -> tuple[DataFrame, Column | str]:
    """Values with the rule of their name and the digits the rules share, each computed once per row.

    ``name`` names the column that holds the column names; None stands for names that say nothing.
    """
    rule: Column | str = names.PLAIN_RULE
    if name is not None:
        values = values.withColumn("__rule", names.name_rule(F.col(name)))
        rule = F.col("__rule")
    return values.withColumn("__digits", mask.shared_digits(F.col(value), rule)), rule


def mask_named_values(values: DataFrame, value: str = "v", name: str = "column_name", masked: str = "masked") -> DataFrame:
    """Mask a long table of (column name, value) rows."""
    ruled, rule = _with_rules(values, value, name)
    return ruled.withColumn(masked, mask.mask_by_rule(F.col(value), rule, F.col("__digits"))).drop("__rule", "__digits")


def pii_detection_report(values: DataFrame, value: str = "v", name: str | None = None) -> DataFrame:
    """Original, detector answer, masked form and whether masking changed the value."""
    v, d = F.col(value), F.col("__digits")
    ruled, rule = _with_rules(values, value, name)
    shown = ruled.withColumns(
        {"contains_pii": detect.contains_pii(v, d if name is None else None), "masked_value": mask.mask_by_rule(v, rule, d)}
    )
    return shown.withColumn("was_masked", ~v.eqNullSafe(F.col("masked_value"))).drop("__rule", "__digits")


def pii_class_counts(values: DataFrame, group: list[str], value: str = "v", name: str | None = None) -> DataFrame:
    """How many values of each group take which step of the ladder."""
    ruled, rule = _with_rules(values, value, name)
    classed = ruled.select(*group, mask.pii_class(F.col(value), rule, F.col("__digits")).alias("pii_class"))
    return classed.groupBy(*group, "pii_class").agg(F.count("*").alias("value_count"))

"""From raw text tables to canonical ones."""

from __future__ import annotations

from collections.abc import Collection, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from airlend.functions import columns as C
from airlend.schemas import FINANCE_ADVANCES, FINANCE_COLUMNS, LEDGER, RAW_RECORD_ITEMS

INDEX_COLUMN = "_c0"


def to_template(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Source names to canonical names; names that are not there and the unnamed index column are ignored."""
    present = {old: new for old, new in mapping.items() if old in df.columns}
    return df.drop(INDEX_COLUMN).withColumnsRenamed(present)


#: Wide enough for any whole number of 64 bits, with room to see a fraction.
EXACT = "decimal(38,10)"


def _typed(name: str, dtype: T.DataType, source: T.DataType, truncate: bool = False) -> Column:
    """Text trimmed and cast; what does not parse is NULL. A column that has its type already is passed
    through, so a filter on it still reaches the scan. A whole number may be written with a decimal point;
    one with a fraction is NULL, or cut to its whole part with `truncate`."""
    if source == dtype and not isinstance(dtype, T.StringType):
        return F.col(name)
    if not isinstance(source, T.StringType):
        return F.col(name).try_cast(dtype).alias(name)
    text = F.trim(F.col(name))
    if isinstance(dtype, T.IntegralType):
        exact = text.try_cast(EXACT)
        whole = exact if truncate else F.when(exact == F.floor(exact), exact)
        return F.coalesce(text.try_cast(dtype), whole.try_cast(dtype)).alias(name)
    return text.try_cast(dtype).alias(name)


def _typed_columns(df: DataFrame, schema: T.StructType, truncated: Collection[str]) -> list[Column]:
    have = {field.name: field.dataType for field in df.schema}
    return [
        _typed(field.name, field.dataType, have[field.name], field.name in truncated)
        if field.name in have
        else F.lit(None).cast(field.dataType).alias(field.name)
        for field in schema
    ]


def type_template(df: DataFrame, schema: T.StructType, truncated: Collection[str] = ()) -> DataFrame:
    """Trim and cast the schema's columns in one projection; other columns are dropped, missing ones are NULL.

    Whole numbers named in `truncated` lose their fraction; in others a fraction makes them NULL.
    """
    return df.select(*_typed_columns(df, schema, truncated))


def _reason(name: str, typed: Column, dtype: T.DataType) -> Column:
    """Why a text that is there has no value of this type: NULL if it has one, or is blank."""
    text = F.trim(F.col(name))
    reason = F.lit("format")
    if isinstance(dtype, T.IntegralType):
        exact = text.try_cast(EXACT)
        reason = F.when(exact.isNull(), "format").when(exact != F.floor(exact), "fraction").otherwise("range")
    elif isinstance(dtype, T.DecimalType):
        reason = F.when(text.try_cast("double").isNull(), "format").otherwise("range")
    return F.when((text != "") & typed.isNull(), reason)


def type_with_rejects(df: DataFrame, schema: T.StructType, truncated: Collection[str] = ()) -> DataFrame:
    """`type_template` with one column more, rejects: an array of (column, value, reason) of the texts that became
    NULL because they are no value of their column's type.

    The reason is 'format' (no number or time), 'fraction' (of a whole number) or 'range' (a number that does not
    fit). Blank text is a missing value and no reject. Both outputs come from one pass if the result is staged.
    """
    have = {field.name: field.dataType for field in df.schema}
    cells = []
    for field in schema:
        if isinstance(have.get(field.name), T.StringType) and not isinstance(field.dataType, T.StringType):
            typed = _typed(field.name, field.dataType, have[field.name], field.name in truncated)
            reason = _reason(field.name, typed, field.dataType)
            cell = F.struct(F.lit(field.name).alias("column"), F.col(field.name).alias("value"), reason.alias("reason"))
            cells.append(F.when(reason.isNotNull(), cell))
    kind = "array<struct<column:string,value:string,reason:string>>"
    rejects = F.array_compact(F.array(*cells)) if cells else F.array()
    return df.select(*_typed_columns(df, schema, truncated), rejects.cast(kind).alias("rejects"))


def rejected_values(typed: DataFrame, *keys: str) -> DataFrame:
    """keys, column, value, reason: a row for each reject of `type_with_rejects`."""
    return typed.filter(F.size("rejects") > 0).select(*keys, F.inline("rejects"))


def type_ledger(df: DataFrame) -> DataFrame:
    """Ledger text columns to their types; other columns (raw record, balances) stay as they are."""
    have = {field.name: field.dataType for field in df.schema}
    types = {field.name: field.dataType for field in LEDGER if field.name in have}
    return df.select(
        *(_typed(name, types[name], have[name]) if name in types else F.col(name) for name in df.columns)
    )


def type_finance(df: DataFrame) -> DataFrame:
    """Finance advances: source names to canonical ones, with types; the chosen amount is the whole amount."""
    return type_template(to_template(df, FINANCE_COLUMNS), FINANCE_ADVANCES, truncated=("chosen_amount",))


def split_raw_record(
    df: DataFrame, col: str = "raw_record", items: Mapping[str, int] = RAW_RECORD_ITEMS
) -> DataFrame:
    """Items of the raw record as columns; of `entity` and `entity_name` the part after the first '-'."""
    parts = {name: C.record_item(col, item) for name, item in items.items()}
    for name in ("entity", "entity_name"):
        if name in parts:
            parts[name] = C.record_item(parts[name], 1, sep="-")
    return df.withColumns(parts).drop(col)


def normalise_msisdn(df: DataFrame, col: str = "msisdn", width: int = 10, pad: str = "0") -> DataFrame:
    """Pad numbers one character short and keep the valid ones; a NULL number is not valid."""
    number = C.padded_msisdn(col, width, pad)
    return df.withColumn(col, number).filter(F.length(col) == width)


def with_day(df: DataFrame, ts: str = "event_ts", name: str = "day") -> DataFrame:
    return df.withColumn(name, C.day(ts))


def with_year_month(df: DataFrame, ts: str = "event_ts") -> DataFrame:
    return df.withColumns({"year": F.date_format(ts, "yyyy"), "month": F.date_format(ts, "MM")})


def dedupe(df: DataFrame) -> DataFrame:
    """Whole-row duplicates out. Copies are combined on the map side, so a much repeated row is no hot spot."""
    return df.dropDuplicates()

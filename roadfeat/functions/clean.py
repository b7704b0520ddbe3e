"""Column and DataFrame helpers that clean raw source tables."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadfeat.config import LAT_RANGE, LON_RANGE

# The texts a CSV reader of data frames takes as missing.
NA_STRINGS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

DECIMAL_PATTERN = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"


def require_columns(df: DataFrame, columns: Iterable[str], what: str) -> None:
    """Fail at plan time, without a job, when a needed column is absent."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"{what}: missing columns {missing}")


def name(column: str) -> Column:
    """A column by its exact name; source headers contain brackets and dots."""
    return F.col("`" + column.replace("`", "``") + "`")


def normalize_na(df: DataFrame) -> DataFrame:
    """Turn the usual missing-value texts of untyped string columns into null."""
    strings = {f.name for f in df.schema.fields if f.dataType.typeName() == "string"}
    return df.select(
        *[
            F.when(name(c).isin(*NA_STRINGS), None).otherwise(name(c)).alias(c) if c in strings else name(c)
            for c in df.columns
        ]
    )


def to_number(col: Column, type_name: str | None = None) -> Column:
    """Double value of a column; whatever is no plain decimal number becomes null.

    ``try_cast`` alone would also take ``1d``, hex floats and ``NaN``. With a
    numeric ``type_name`` only the NaN check is left.
    """
    if type_name is not None and type_name != "string":
        return F.nanvl(col.cast("double"), F.lit(None).cast("double"))
    text = col.cast("string")
    return F.when(text.rlike(DECIMAL_PATTERN), F.trim(text).try_cast("double"))


def with_numbers(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    types = {f.name: f.dataType.typeName() for f in df.schema.fields}
    return df.withColumns({c: to_number(name(c), types[c]) for c in columns})


# White space as text libraries strip it, beyond the blank: controls, no-break and wide spaces.
WHITE_SPACE = "".join(
    map(chr, [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000])
)


def trimmed(col: Column) -> Column:
    """Text without white space of any kind at its ends."""
    return F.btrim(col.cast("string"), F.lit(WHITE_SPACE))


def to_long(col: Column) -> Column:
    """Whole number of an id; text keeps every digit, other numbers lose their fraction."""
    text = trimmed(col)
    whole = F.when(text.rlike(r"^[+-]?[0-9]{1,19}$"), text.try_cast("long"))
    return F.coalesce(whole, to_number(col).try_cast("long"))


def swap_lat_lon(df: DataFrame, lat: str, lon: str) -> DataFrame:
    """Exchange latitude and longitude in the rows where they stand swapped."""
    swapped = is_swapped(lat, lon)
    return df.withColumns(
        {
            lat: F.when(swapped, name(lon)).otherwise(name(lat)),
            lon: F.when(swapped, name(lat)).otherwise(name(lon)),
        }
    )


def is_swapped(lat: str, lon: str) -> Column:
    return name(lat).between(*LON_RANGE) & name(lon).between(*LAT_RANGE)


def in_city_range(lat: str, lon: str) -> Column:
    return name(lat).between(*LAT_RANGE) & name(lon).between(*LON_RANGE)


def canonical_ids(df: DataFrame, column: str, id_type: str = "infer") -> DataFrame:
    """Make equal ids of an untyped text column equal as text.

    In an all-number id column ``007`` and ``7`` are one id. ``infer`` settles whether it is one by an aggregate of that
    column inside the query that uses the ids, so nothing runs when a source is declared; ``string`` and ``long`` need none.
    """
    if id_type not in ("infer", "string", "long"):
        raise ValueError(f"unknown id_type {id_type!r}")
    if id_type == "string":
        return df
    text = name(column)
    value = trimmed(text)
    # Whole numbers keep every digit; other decimals compare as doubles.
    whole = F.when(value.rlike(r"^[+-]?[0-9]{1,38}$"), value.try_cast("decimal(38,0)").cast("string"))
    number = F.coalesce(whole, whole_or_double(value))
    if id_type == "infer":
        numeric = df.agg(F.every(text.isNull() | text.rlike(DECIMAL_PATTERN))).scalar()
        number = F.when(numeric, number).otherwise(text)
    return df.withColumn(column, number)


def whole_or_double(value: Column) -> Column:
    number = value.try_cast("double")
    is_whole = (number == F.floor(number)) & (F.abs(number) < 9.0e15)
    return F.when(is_whole, number.cast("long").cast("string")).otherwise(number.cast("string"))

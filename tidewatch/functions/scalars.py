"""Column expressions. All of them stay inside generated JVM code."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.schemas import CODE_CONDITIONS, CONDITION_LABELS, HOUR_KEY_BASE

TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"
ISO_FORMAT = "yyyy-MM-dd'T'HH:mm:ss"


def utc_timestamp(text: Column) -> Column:
    """Strict parse; an offset in the text is applied, then the zone is dropped."""
    return F.to_timestamp(text).cast("timestamp_ntz")


def utc_timestamp_or_null(text: Column) -> Column:
    """Lenient parse: unreadable text becomes NULL."""
    return F.try_to_timestamp(text).cast("timestamp_ntz")


def timestamp_text(ts: Column) -> Column:
    return F.date_format(ts, TIMESTAMP_FORMAT)


def nan_to_null(number: Column) -> Column:
    return F.when(~F.isnan(number), number)


def number_or_null(text: Column) -> Column:
    """Text to double; bad text and NaN become NULL.

    The JVM parser takes a trailing type letter ("1d", "2.5f") as part of the
    number, so such text is refused first.
    """
    plain = F.when(~text.rlike(r"[0-9.][dDfF]\s*$"), text)
    return nan_to_null(plain.try_cast("double"))


def as_number(df: DataFrame, name: str) -> Column:
    """Column ``name`` as a NaN-free double, whatever its stored type."""
    kind = df.schema[name].dataType
    if isinstance(kind, T.StringType):
        return number_or_null(F.col(name))
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return nan_to_null(F.col(name).cast("double"))
    return F.col(name).cast("double")


def optional_number(df: DataFrame, name: str) -> Column:
    """As :func:`as_number`, or a typed NULL where the column does not exist."""
    if name in df.columns:
        return as_number(df, name)
    return F.lit(None).cast("double")


def iso_timestamp(ts: Column) -> Column:
    """ISO text; six fraction digits where the fraction is not zero."""
    whole = F.date_trunc("second", ts).cast("timestamp_ntz") == ts.cast("timestamp_ntz")
    return F.when(whole, F.date_format(ts, ISO_FORMAT)).otherwise(
        F.date_format(ts, ISO_FORMAT + ".SSSSSS")
    )


def coerce_numbers(df: DataFrame, names: list[str]) -> DataFrame:
    return df.withColumns({name: as_number(df, name) for name in names})


def round_half_even(number: Column, kind: str = "int") -> Column:
    """Rounded number; NULL where it does not fit ``kind``."""
    return F.bround(number).try_cast(kind)


def hour_key(ts: Column, base: str = HOUR_KEY_BASE) -> Column:
    """Hours since ``base``, rounded half-even, counted from 1."""
    start = F.lit(base).cast("timestamp_ntz")
    hours = F.timestamp_diff("MICROSECOND", start, ts) / F.lit(3_600_000_000.0)
    return round_half_even(hours, "bigint") + F.lit(1).cast("bigint")


def _lookup(mapping: dict) -> Column:
    """Constant map; one parsed expression instead of one call per entry."""
    entries = ", ".join(f"{key!r}, {value!r}" for key, value in mapping.items())
    return F.expr(f"map({entries})")


def condition_of(code: Column) -> Column:
    """Condition label of a numeric code; unknown and missing codes give NULL."""
    return F.try_element_at(_lookup(CODE_CONDITIONS), round_half_even(code.cast("double")))


def condition_ordinal(label: Column) -> Column:
    """Position of a label in the fixed label list, from 0."""
    return F.try_element_at(_lookup({c: i for i, c in enumerate(CONDITION_LABELS)}), label)


def dew_point_spread(temperature: Column, dew_point: Column) -> Column:
    return temperature - dew_point


def wind_u(speed: Column, direction: Column) -> Column:
    return -speed * F.sin(F.radians(direction))


def wind_v(speed: Column, direction: Column) -> Column:
    return -speed * F.cos(F.radians(direction))


def calendar_columns(ts: Column) -> dict[str, Column]:
    """Hour, weekday (Monday is 0), month, day of year and a weekend flag."""
    return {
        "hour_of_day": F.hour(ts),
        "day_of_week": F.weekday(ts),
        "month": F.month(ts),
        "day_of_year": F.dayofyear(ts),
        "is_weekend": F.weekday(ts).isin(5, 6),
    }


def stamp(df: DataFrame, **constants: object) -> DataFrame:
    """Put constant columns in front of the frame, in the given order."""
    return df.select(*[F.lit(value).alias(name) for name, value in constants.items()], "*")


def json_record(df: DataFrame, name: str = "record") -> DataFrame:
    """One JSON document per row: NULLs kept, NaN as null, ISO timestamps."""
    safe = []
    for field in df.schema.fields:
        column = F.col(field.name)
        if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            column = nan_to_null(column)
        elif isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
            column = iso_timestamp(column)
        safe.append(column.alias(field.name))
    return df.select(F.to_json(F.struct(*safe), {"ignoreNullFields": "false"}).alias(name))

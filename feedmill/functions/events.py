"""Event types and the parts of a change record."""

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedmill.schemas import EVENT_CODES


def _lookup(col: Column, pairs: dict[str, str], what: str) -> Column:
    chain = None
    for key, value in pairs.items():
        chain = F.when(col == key, value) if chain is None else chain.when(col == key, value)
    message = F.concat(F.lit(f"unknown {what}: "), F.coalesce(col, F.lit("null")))
    return chain.otherwise(F.raise_error(message))


def event_code(col: Column) -> Column:
    """`INSERT` / `UPDATE` / `DELETE` to `I` / `U` / `D`; anything else fails the job."""
    return _lookup(col, EVENT_CODES, "event name")


def event_name(col: Column) -> Column:
    """`I` / `U` / `D` to its name; anything else fails the job."""
    return _lookup(col, {code: name for name, code in EVENT_CODES.items()}, "event code")


def is_dml(col: Column) -> Column:
    return col.isin(*EVENT_CODES.values())


def payload_text(col: Column, dtype: T.DataType) -> Column:
    """Document source as text; bytes are read as UTF-8."""
    return F.decode(col, "UTF-8") if isinstance(dtype, T.BinaryType) else col.cast("string")


def stamp(col: Column, dtype: T.DataType) -> Column:
    """Wall-clock time as `yyyy-MM-dd'T'HH:mm:ssSSS`.

    A timestamp without zone is formatted from its own fields, so that no
    session zone (with its skipped hours) can shift it.
    """
    if isinstance(dtype, T.TimestampNTZType):
        text = col.cast("string")
        seconds = F.translate(F.substring(text, 1, 19), " ", "T")
        return F.concat(seconds, F.rpad(F.substring(text, 21, 3), 3, "0"))
    return F.date_format(col, "yyyy-MM-dd'T'HH:mm:ssSSS")


def stamp_time(col: Column) -> Column:
    """The time in a record's `create_time`, without zone."""
    return F.to_timestamp_ntz(col, F.lit("yyyy-MM-dd'T'HH:mm:ssSSS"))

"""Text rules for setting keys and values."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Java counts as white space (no-break spaces are
# not among them), as code points.
WHITESPACE = (
    *range(0x09, 0x0E),
    *range(0x1C, 0x21),
    0x1680,
    *range(0x2000, 0x2007),
    *range(0x2008, 0x200B),
    0x2028,
    0x2029,
    0x205F,
    0x3000,
)
_WHITESPACE = "".join(map(chr, WHITESPACE))
_CONTROLS = "".join(map(chr, range(0x21)))


def is_blank(col: Column) -> Column:
    return col.isNull() | (F.btrim(col, F.lit(_WHITESPACE)) == "")


def text_is_blank(text: str | None) -> bool:
    return text is None or all(ord(c) in WHITESPACE for c in text)


def trim_controls(text: str) -> str:
    """Cut characters up to U+0020 from both ends."""
    return text.strip(_CONTROLS)


def trim_controls_col(col: Column) -> Column:
    return F.btrim(col, F.lit(_CONTROLS))


def key_suffix(col: Column) -> Column:
    """The part of a setting key after its last dot."""
    return F.substring_index(col, ".", -1)


def stored_mark(col: Column) -> Column:
    """A stored SCN mark as a number: blank is 0, anything but digits fails the job."""
    junk = F.raise_error(F.concat(F.lit("not an SCN mark: "), col))
    number = F.when(col.rlike(r"\A[+-]?[0-9]+\z"), col.cast("long")).otherwise(junk)
    return F.when(is_blank(col), F.lit(0).cast("long")).otherwise(number)


def flag(col: Column) -> Column:
    """A stored table flag: true, false, or NULL when blank; anything else fails the job."""
    junk = F.raise_error(F.concat(F.lit("not a table flag: "), col))
    return F.when(is_blank(col), F.lit(None).cast("boolean")).otherwise(
        F.when(col == "true", True).when(col == "false", False).otherwise(junk)
    )

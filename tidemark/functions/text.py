"""Column functions over text."""

from __future__ import annotations

import sys
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every Unicode white-space character, by rule. SQL's plain ``trim`` would remove U+0020 only.
WHITESPACE = "".join(chr(c) for c in range(sys.maxunicode + 1) if chr(c).isspace())
_ASCII_WHITESPACE = "".join(c for c in WHITESPACE if c.isascii())
_NOT_BLANK = r"(?U)[^\s\x1c-\x1f]"


def quoted(name: str) -> Column:
    """A column by its literal name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def strip_text(col: Column) -> Column:
    """``col`` without white space at its ends. Text that is all ASCII, as most is, is compared
    with the few ASCII characters only."""
    ascii_only = F.octet_length(col) == F.length(col)
    short = F.btrim(col, F.lit(_ASCII_WHITESPACE))
    return F.when(ascii_only, short).otherwise(F.btrim(col, F.lit(WHITESPACE)))


def is_blank(col: Column) -> Column:
    """Nothing but white space, or nothing at all."""
    return col.isNull() | ~col.rlike(_NOT_BLANK)


def null_if_in(col: Column, tokens: Sequence[str]) -> Column:
    """``col`` with each of ``tokens`` read as null."""
    return F.when(~col.isin(*tokens), col)


# Codes that mean there is none; the words are what a null leaves behind as text.
NO_CODE = ("", "nan", "None")


def normalise_code(col: Column) -> Column:
    """A stripped code, null where it is one of ``NO_CODE``."""
    return null_if_in(strip_text(col), NO_CODE)


def to_flag(col: Column) -> Column:
    """Text to boolean, null where the text is neither."""
    return col.try_cast("boolean")

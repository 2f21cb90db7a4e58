"""Reversible scrambling of 32-bit ids."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The XOR key and the bit fields that trade places.
XOR_KEY = 82920181
TOP_BYTE = -16777216
UPPER_MIDDLE_BYTE = 0x00FF0000
LOWER_MIDDLE_BYTE = 0x0000FF00
UPPER_NIBBLE = 0x000000F0
LOWER_NIBBLE = 0x0000000F


def _swap(id_: Column) -> Column:
    """Swaps the two middle bytes and the two nibbles of the low byte; its own inverse."""

    def field(mask: int) -> Column:
        return id_.bitwiseAND(F.lit(mask))

    return (
        field(TOP_BYTE)
        .bitwiseOR(F.shiftleft(field(LOWER_MIDDLE_BYTE), 8))
        .bitwiseOR(F.shiftright(field(UPPER_MIDDLE_BYTE), 8))
        .bitwiseOR(F.shiftleft(field(LOWER_NIBBLE), 4))
        .bitwiseOR(F.shiftright(field(UPPER_NIBBLE), 4))
    )


def id_number(c: Column | str) -> Column:
    """INT of an id's text; NULL when it is no non-negative 32-bit number."""
    c = F.col(c) if isinstance(c, str) else c
    text = c.cast("string")
    return F.when(text.rlike("^[0-9]+$"), text.try_cast("int"))


def scramble_number(number: Column) -> Column:
    return _swap(number).bitwiseXOR(F.lit(XOR_KEY)).cast("string")


def descramble_number(number: Column) -> Column:
    """Text of the id hidden in an INT. The bit swap reads its input five times, so
    give it a column rather than a long expression."""
    return _swap(number.bitwiseXOR(F.lit(XOR_KEY))).cast("string")


def scramble(c: Column | str) -> Column:
    """Scrambled text of an id."""
    return scramble_number(id_number(c))


def descramble(c: Column | str) -> Column:
    """Id hidden in a scrambled text."""
    return descramble_number(id_number(c))

"""Small helpers that the operators of this package share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialise

ASCII_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BLANKS = " \t\n\x0b\f\r"
BLANK_RUN = "[\\x20\\x09-\\x0D]+"
ROWS_AT_ONCE = 256


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` with ``value`` evaluated once per row, however often the body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, every other character as it is."""
    plain = F.octet_length(text) == F.length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def blank_words(text: Column) -> Column:
    """The words between ASCII blanks as an array; empty for null or blank text."""
    trimmed = F.trim(F.coalesce(text, F.lit("")), F.lit(BLANKS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(
        F.split(trimmed, BLANK_RUN))


def crc_of_id(column: str) -> Column:
    """CRC-32 of an id's decimal text; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary"))


def text_bytes(column: pa.Array) -> Iterator[bytes]:
    """UTF-8 bytes of a string column, null as empty, a few rows at a time."""
    column = column.cast(pa.large_binary())
    for at in range(0, len(column), ROWS_AT_ONCE):
        for value in column.slice(at, ROWS_AT_ONCE).to_pylist():
            yield value or b""


def mixed(values: np.ndarray, salt: int) -> np.ndarray:
    """A bijective 64-bit mix of each value; another salt gives another mix."""
    # fixed values: the constants of the splitmix64 generator
    increment, first, second = 0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB
    with np.errstate(over="ignore"):
        x = values + np.uint64((increment * (salt + 1)) & (2**64 - 1))
        x = (x ^ (x >> np.uint64(30))) * np.uint64(first)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(second)
        return x ^ (x >> np.uint64(31))


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read again: a cut in the lineage."""
    return materialise(df, name)


def packed(docs: DataFrame, **columns: Column) -> DataFrame:
    """All columns of ``docs`` in one struct ``_row`` beside ``columns``: no name can clash."""
    return docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("_row"),
                       *[c.alias(name) for name, c in columns.items()])

"""Station, column and file name normalisers as column expressions."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Letters that are no plain letter with a mark, and their plain spelling.
SINGLE_LETTERS = {"ı": "i", "ø": "o", "Ø": "O", "ł": "l", "Ł": "L", "đ": "d", "Đ": "D", "ð": "d", "Ð": "D"}
DOUBLE_LETTERS = {"ß": "ss", "æ": "ae", "Æ": "AE", "œ": "oe", "Œ": "OE", "þ": "th", "Þ": "Th"}


def _marked_letters() -> dict[str, str]:
    """Latin letters with marks and the letters they decompose to."""
    latin = map(chr, [*range(0xC0, 0x250), *range(0x1E00, 0x1F00)])
    plain = {c: unicodedata.normalize("NFD", c)[0] for c in latin}
    return {c: p for c, p in plain.items() if p != c and p.isascii()}


_LETTERS = {**_marked_letters(), **SINGLE_LETTERS}
LETTERS_FROM = "".join(_LETTERS)
LETTERS_TO = "".join(_LETTERS.values())

# The six lower-case letters the coordinate lookup replaces.
LOOKUP_FROM = "çğıöşü"
LOOKUP_TO = "cgiosu"

# Unit suffixes of pollutant headers, removed in this order before all spaces.
UNIT_SUFFIXES = [
    " ( µg/m3 )",
    " ( ppb )",
    " ( ug/m3 )",
    " ( mg/m3 )",
    " ( - )",
    " ( l/dk )",
    " ( ppm )",
]

# Fixed value: longest name a sheet may have.
SHEET_NAME_LENGTH = 31


def trimmed(c: Column) -> Column:
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def plain_letters(c: Column) -> Column:
    """Latin letters without marks; a mark that follows its letter goes too."""
    plain = F.regexp_replace(F.translate(c, LETTERS_FROM, LETTERS_TO), r"\p{Mn}", "")
    for letter, spelt in DOUBLE_LETTERS.items():
        plain = F.replace(plain, F.lit(letter), F.lit(spelt))
    return plain


def station_key(name: Column) -> Column:
    """Lower case in plain letters, runs of whitespace as one underscore.

    Letters are replaced before lowering because lowering a dotted capital I yields two
    code points.
    """
    return F.regexp_replace(F.lower(plain_letters(name)), r"\s+", "_")


def sheet_key(name: Column) -> Column:
    """Sheet name: every other character an underscore, runs collapsed, lower, cut to size."""
    words = F.regexp_replace(plain_letters(name), r"[^\w\s]", "_")
    joined = F.regexp_replace(F.regexp_replace(words, r"\s+", "_"), "_+", "_")
    return F.substring(F.lower(joined), 1, SHEET_NAME_LENGTH)


def lookup_key(name: Column) -> Column:
    """Dimension-side key of the coordinate lookup; missing names become empty."""
    spaced = F.replace(trimmed(F.coalesce(name, F.lit(""))), F.lit(" "), F.lit("_"))
    named = F.when(spaced == "nan", F.lit("")).otherwise(spaced)
    return F.translate(F.regexp_replace(named, "_+", "_"), LOOKUP_FROM, LOOKUP_TO)


def file_lookup_key(file_name: Column) -> Column:
    """File-side key: the stem, trimmed and lower-cased. Underscore runs stay."""
    stem = F.lower(trimmed(without_extension(file_name)))
    return F.translate(F.replace(stem, F.lit(" "), F.lit("_")), LOOKUP_FROM, LOOKUP_TO)


def without_extension(file_name: Column) -> Column:
    """File name without its last extension; a leading dot does not start one."""
    return F.regexp_replace(file_name, r"(?<=[^.])\.[^.]*$", "")


def file_stem(file_name: Column) -> Column:
    """File name up to its first dot."""
    return F.split_part(file_name, F.lit("."), F.lit(1))


def base_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def pollutant_name(label: Column) -> Column:
    """Pollutant label without unit suffixes and spaces."""
    for suffix in UNIT_SUFFIXES:
        label = F.replace(label, F.lit(suffix), F.lit(""))
    return F.replace(label, F.lit(" "), F.lit(""))


def drop_periods(text: Column) -> Column:
    """Text number with its periods deleted; it stays text."""
    return F.replace(text, F.lit("."), F.lit(""))


def parse_decimal(text: Column) -> Column:
    """Number from text with thousands periods and a decimal comma; null if it is none."""
    return F.replace(drop_periods(text), F.lit(","), F.lit(".")).try_cast("double")


def strip_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.strip() for c in df.columns])


def space_columns(df: DataFrame) -> DataFrame:
    """Column names with spaces in place of underscores."""
    return df.toDF(*[c.replace("_", " ") for c in df.columns])


def clean_pollutant_columns(df: DataFrame) -> DataFrame:
    """Unit suffixes and spaces removed from every column name."""
    names = []
    for name in df.columns:
        for suffix in UNIT_SUFFIXES:
            name = name.replace(suffix, "")
        names.append(name.replace(" ", ""))
    return df.toDF(*names)

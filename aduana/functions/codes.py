"""Normalised codes: products, activity classes, flags and names taken from file names."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

PRODUCT_WIDTH = 8
ACTIVITY_WIDTH = 7
CLASS_WIDTH = 5
DIVISION_WIDTH = 2


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def padded(c: str | Column, width: int) -> Column:
    """Left-pad with zeros; `lpad` also cuts what is longer than `width`."""
    return F.lpad(_col(c).cast("string"), width, "0")


def product_key(c: str | Column) -> Column:
    return padded(c, PRODUCT_WIDTH)


def class_of_activity(c: str | Column) -> Column:
    """Five-character class of a seven-digit activity; pads first, so leading zeros survive."""
    return F.substring(padded(c, ACTIVITY_WIDTH), 1, CLASS_WIDTH)


def class_key(c: str | Column) -> Column:
    return padded(c, CLASS_WIDTH)


def division_of_class(c: str | Column) -> Column:
    return F.substring(_col(c), 1, DIVISION_WIDTH)


def flag_is(c: str | Column, value: int) -> Column:
    """Compare a text flag with a number: '2', '02' and ' 002 ' are all 2, '021' and 'x' are not."""
    text = F.trim(_col(c).cast("string"))
    return F.when(text.isNotNull(), F.coalesce(text.try_cast("int") == value, F.lit(False)))


def leading_digits(c: str | Column) -> Column:
    """Digits at the start of a text, null where there are none."""
    return F.nullif(F.regexp_extract(_col(c), r"^(\d+)", 1), F.lit(""))


def without_punctuation(c: str | Column) -> Column:
    return F.regexp_replace(_col(c), r"[.\-]", "")


def joined_id(*parts: str | Column) -> Column:
    """Company identifier from its parts; null parts are left out."""
    return F.concat_ws("", *[_col(p) for p in parts])


def file_stem(c: str | Column) -> Column:
    """Lower-cased file name up to its first dot."""
    return F.lower(F.substring_index(_col(c), ".", 1))


def table_of_file(c: str | Column) -> Column:
    """Table a numbered file belongs to: `Empresas3.zip` and `Empresas 3.zip` -> `empresas`."""
    return table_name(F.regexp_replace(file_stem(c), r"[ _-]*\d+$", ""))


# Accented letters and their plain forms.
ACCENTED, PLAIN = "áàâãäéèêëíìîïóòôõöúùûüçñ", "aaaaaeeeeiiiiooooouuuucn"


def table_name(c: str | Column) -> Column:
    """A name the catalog takes without quotes: plain letters, digits and underscores."""
    return F.regexp_replace(F.translate(F.lower(F.trim(_col(c))), ACCENTED, PLAIN), "[^a-z0-9_]+", "_")

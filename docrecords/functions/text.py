"""String, path, date and byte expressions. All run inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# Strings that stand for "not available", shapes and formats of dates, the
# characters that do not belong to a date, and the parts of a path.
BLANK_WORDS = ("n/a", "na")

ISO_DATE = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"
US_DATE = r"^[0-9]{1,2}/[0-9]{1,2}/[0-9]{2,4}$"
NOT_IN_DATES = r"[^0-9/\-\s]"
ISO_FORMAT, US_FORMAT = "yyyy-MM-dd", "MM/dd/yyyy"
DIRECTORY = r"^(.*/)([^/]+)$"
EXTENSION, DOT_EXTENSION = r"\.([^.]+)$", r"(\.[^.]+)$"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def nz(c: Column | str) -> Column:
    """NULL for blanks and not-available words; any other value unchanged."""
    c = _col(c)
    word = F.lower(F.trim(c))
    return F.when((word == "") | word.isin(*BLANK_WORDS), None).otherwise(c)


def register_nz(spark: SparkSession, name: str = "nz") -> None:
    """The same rule as a SQL function of the session."""
    words = ", ".join(f"'{w}'" for w in ("",) + BLANK_WORDS)
    spark.sql(
        f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(s STRING) RETURNS STRING "
        f"RETURN IF(lower(trim(s)) IN ({words}), NULL, s)"
    )


def file_name(path: Column | str) -> Column:
    """Text after the last slash; '' when the path ends in one."""
    return F.element_at(F.split(_col(path), "/"), -1)


def directory(path: Column | str) -> Column:
    """Text up to and with the last slash, '' when there is none or no name follows."""
    return F.regexp_extract(_col(path), DIRECTORY, 1)


def extension(path: Column | str, with_dot: bool = False) -> Column:
    """Text after the last dot, '' when there is none."""
    return F.regexp_extract(_col(path), DOT_EXTENSION if with_dot else EXTENSION, 1)


def decode_text(content: Column | str) -> Column:
    """Bytes as UTF-8; invalid bytes become U+FFFD instead of failing the query."""
    return F.make_valid_utf8(_col(content).cast("string"))


def squeeze(c: Column | str) -> Column:
    """Runs of white space become one space; none is left at the ends."""
    return F.trim(F.regexp_replace(_col(c), r"\s+", " "))


def normalize_date(c: Column | str, lenient: bool = False) -> Column:
    """A date string as DATE: ISO first, then US; NULL for anything else.

    Strict mode parses the raw text with two-digit month and day and a four-digit
    year. Lenient mode parses the text after removing everything but digits,
    slashes, dashes and spaces, with one- or two-digit parts and years.
    """
    c = _col(c)
    cleaned = F.regexp_replace(c, NOT_IN_DATES, "")
    if lenient:
        cleaned = F.trim(cleaned)
        us = F.when(cleaned.rlike(r"/[0-9]{4}$"), F.try_to_date(cleaned, "M/d/yyyy")).when(
            cleaned.rlike(r"/[0-9]{2}$"), F.try_to_date(cleaned, "M/d/yy")
        )
    else:
        us = F.try_to_date(c, US_FORMAT)
    return F.when(c.rlike(ISO_DATE), F.try_to_date(c, ISO_FORMAT)).when(cleaned.rlike(US_DATE), us)


def lead_sentences(c: Column | str, sentences: int, head_chars: int | None = None) -> Column:
    """The first sentences, of the first ``head_chars`` characters if given, on one line."""
    head = _col(c) if head_chars is None else F.left(_col(c), F.lit(head_chars))
    cut = F.regexp_replace(head, r"([.!?]+)\s+", "$1\u001e")
    return squeeze(F.array_join(F.slice(F.split(cut, "\u001e"), 1, sentences), " "))

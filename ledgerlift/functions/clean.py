"""Column-to-Column cleaning. Whatever cannot be read becomes null, with ANSI mode on or off."""

import re
from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerlift.defaults import (
    CURRENCY_WORD,
    DATE_FORMATS,
    LABEL_KEEP,
    MONEY_SYMBOLS,
    MOVEMENT_WORDS,
)

# What each pattern piece can match at most. A year may have a sign and more than four digits;
# Spark reads month names in English, all of which have three letters when short.
_DATE_PIECES = {"yyyy": r"[+-]?\d{4,}", "MMM": ".{3}", "MM": r"\d\d", "dd": r"\d\d"}


def parse_money(c: Column, symbols: str = MONEY_SYMBOLS, word: str = CURRENCY_WORD) -> Column:
    """Text to double, without the symbols and then without the (upper-case) currency word.

    The symbols go first: removing one may complete the word.
    """
    bare = reduce(lambda text, symbol: F.replace(text, F.lit(symbol), F.lit("")), symbols, c)
    return F.regexp_replace(bare, rf"\s*{re.escape(word)}\s*", "").try_cast("double")


def _date_shape(fmt: str) -> str | None:
    """A regex that every text of this date format matches; None if that is not certain."""
    pieces = re.findall(r"[A-Za-z]+|[^A-Za-z]+", fmt)
    if not all(p in _DATE_PIECES or re.fullmatch("[-/., :_]+", p) for p in pieces):
        return None
    return r"\A" + "".join(_DATE_PIECES.get(p, re.escape(p)) for p in pieces) + r"\z"


def parse_date_multi(c: Column, formats: Iterable[str] = DATE_FORMATS) -> Column:
    """Text to date by the first format that reads it.

    A failed parse costs a Java exception, so each format is only tried on texts of its shape.
    The shape never rejects a text that the format would read. It also keeps the parsers of other
    ``spark.sql.legacy.timeParserPolicy`` settings from raising or reading more.
    """

    def attempt(fmt: str) -> Column:
        parsed, shape = F.try_to_date(c, fmt), _date_shape(fmt)
        return parsed if shape is None else F.when(c.rlike(shape), parsed)

    attempts = [attempt(fmt) for fmt in formats]
    if not attempts:
        raise ValueError("no date format given")
    return F.coalesce(*attempts)


def clean_label(c: Column, keep: str = LABEL_KEEP) -> Column:
    """Delete every character outside the ``keep`` class, then the blanks at both ends.

    Case and accents stay, so spelling variants stay apart.
    """
    return F.trim(F.regexp_replace(c, f"[^{keep}]", ""))


def map_synonyms(c: Column, mapping: Mapping[str, Iterable[str]] = MOVEMENT_WORDS) -> Column:
    """The label whose words hold the text, both in any case; null if none does."""
    if not mapping:
        raise ValueError("no words to map given")
    text, case = F.upper(c), F
    for label, words in mapping.items():
        case = case.when(text.isin(*(w.upper() for w in words)), label)
    return case

"""Text normalisation as Column expressions; only Unicode decomposition needs Arrow."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from linkwright.functions import lexicon as lex

UNICODE = "(?U)"


@F.pandas_udf(StringType())
def _strip_marks(s: pd.Series) -> pd.Series:
    def one(t):
        if t is None or t != t:
            return ""
        return t if t.isascii() else "".join(c for c in unicodedata.normalize("NFKD", t) if not unicodedata.combining(c))

    return s.map(one, na_action=None).astype(object)


def remove_accents(c: Column) -> Column:
    """Compatibility decomposition without combining marks; null gives ''."""
    return _strip_marks(c)


def words(c: Column) -> Column:
    """Words of a text whose gaps are single spaces; '' has none."""
    return F.filter(F.split(c, " ", -1), lambda w: w != "")


def strip_urls(c: Column) -> Column:
    return F.regexp_replace(c, UNICODE + lex.URL_PATTERN, "")


def strip_legal(c: Column) -> Column:
    return F.regexp_replace(c, UNICODE + lex.LEGAL_PATTERN, "")


def strip_symbols(c: Column) -> Column:
    spaced = F.regexp_replace(c, UNICODE + r"[^a-z0-9\s]", " ")
    return F.trim(F.regexp_replace(spaced, UNICODE + r"\s+", " "))


def drop_repeats(c: Column) -> Column:
    """Without words that equal the word before them, letter case aside; the first of each run stays. Gaps are single spaces."""
    return F.regexp_replace(c, r"(?iu)(?<![^ ])([^ ]+)(?: \1(?![^ ]))+", "$1")


def clean_text(c: Column) -> Column:
    return clean_ascii(remove_accents(c))


def clean_ascii(c: Column) -> Column:
    """``clean_text`` of text whose accents are gone already."""
    return drop_repeats(strip_symbols(strip_legal(strip_urls(F.lower(c)))))


def digits(c: Column) -> Column:
    return F.regexp_replace(F.coalesce(c, F.lit("")), UNICODE + r"\D", "")


def country(c: Column) -> Column:
    return F.lower(F.trim(F.coalesce(c, F.lit(""))))


def simple_clean(c: Column) -> Column:
    """Lower case, all but letters and digits to single spaces; accents aren't folded."""
    return F.trim(F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), "[^a-z0-9]+", " "))

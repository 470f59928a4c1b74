"""Extractors and tokenisers as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from linkwright.functions import lexicon as lex
from linkwright.functions.text import UNICODE, country, simple_clean, words


def _or_empty(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def tokens(cleaned_name: Column, cleaned_address: Column) -> Column:
    """Distinct words of at least three letters that aren't stop words."""
    w = words(F.concat_ws(" ", cleaned_name, cleaned_address))
    return F.array_distinct(F.filter(w, lambda t: (F.length(t) >= 3) & ~t.isin(lex.STOP_WORDS)))


def house_numbers(c: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(_or_empty(c), F.lit(UNICODE + lex.NUMBER_PATTERN), F.lit(0)))


def _last(c: Column, pattern: str) -> Column:
    found = F.regexp_extract_all(_or_empty(c), F.lit(UNICODE + pattern), F.lit(1))
    return F.coalesce(F.try_element_at(found, F.lit(-1)), F.lit(""))


def postal_code(address: Column, land: Column) -> Column:
    """The last code of the country's kind; where the country is another or unknown, six digits before five."""
    c, six, five = country(land), _last(address, lex.SIX_DIGITS), _last(address, lex.FIVE_DIGITS)
    return F.when(c.isin(*lex.SIX_DIGIT_COUNTRIES), six).when(c.isin(*lex.FIVE_DIGIT_COUNTRIES), five).when(six != "", six).otherwise(five)


def domain(name: Column, address: Column) -> Column:
    """The first category with a keyword among the words of letters only, or ''."""
    found = F.regexp_extract_all(F.lower(F.concat_ws(" ", name, address)), F.lit(UNICODE + r"\b[a-z]{3,}\b"), F.lit(0))
    out = None
    for name_, keys in lex.DOMAINS.items():
        hit = F.arrays_overlap(found, F.array(*[F.lit(k) for k in keys]))
        out = F.when(hit, F.lit(name_)) if out is None else out.when(hit, F.lit(name_))
    return F.coalesce(out.otherwise(F.lit("")), F.lit(""))


def _initials(w: Column) -> Column:
    return F.array_join(F.transform(w, lambda x: F.substring(x, 1, 1)), "")


def acronym_match(a: Column, b: Column) -> Column:
    """1.0 if one side is up to six letters and begins the initials of the other's two or more words, connectives in or out."""

    def one(short: Column, long: Column) -> Column:
        w, s = words(long), F.lower(short)
        every, some = F.lower(_initials(w)), F.lower(_initials(F.filter(w, lambda x: ~F.lower(x).isin(lex.CONNECTIVES))))
        return (F.length(short) <= 6) & short.rlike(r"^\p{L}+$") & (F.size(w) >= 2) & (every.startswith(s) | some.startswith(s))

    a, b = _or_empty(a), _or_empty(b)
    return F.when((a != "") & (b != "") & (one(a, b) | one(b, a)), 1.0).otherwise(0.0)


def char_ngrams(c: Column, n: int = 3) -> Column:
    """Distinct n-grams; a shorter text is its own one, '' has none."""
    return F.when(c == "", F.array().cast("array<string>")).when(F.length(c) < n, F.array(c)).otherwise(_grams(c, n))


def _grams(c: Column, n: int) -> Column:
    # the guard keeps sequence() from counting down
    last = F.greatest(F.length(c) - (n - 1), F.lit(1))
    return F.array_distinct(F.transform(F.sequence(F.lit(1), last), lambda i: F.substring(c, i, F.lit(n))))


def simple_grams(c: Column) -> Column:
    """Distinct trigrams of ``simple_clean``; none under three characters."""
    t = simple_clean(c)
    return F.when(F.length(t) < 3, F.array().cast("array<string>")).otherwise(_grams(t, 3))


def simple_gram_codes(c: Column) -> Column:
    """``simple_grams`` as numbers: its characters are ASCII, so a trigram is one integer and sets of them compare faster."""
    t = simple_clean(c)
    at = lambda i: F.ascii(F.substring(t, i, F.lit(1)))
    code = lambda i: at(i) * 65536 + at(i + 1) * 256 + at(i + 2)
    grams = F.array_distinct(F.transform(F.sequence(F.lit(1), F.greatest(F.length(t) - 2, F.lit(1))), code))
    return F.when(F.length(t) < 3, F.array().cast("array<int>")).otherwise(grams)


def first_house(c: Column) -> Column:
    return F.regexp_extract(_or_empty(c), UNICODE + lex.FIRST_HOUSE, 0)


def blocking_keys(name: Column, address: Column, land: Column) -> Column:
    """Up to five keys: country with prefixes of the first, second and longest word and with the house number."""
    c, house = country(land), first_house(F.lower(address))
    w = F.filter(F.regexp_extract_all(F.lower(F.trim(_or_empty(name))), F.lit("[a-z0-9]+"), F.lit(0)), lambda x: F.length(x) >= 3)
    first, second = F.get(w, F.lit(0)), F.get(w, F.lit(1))
    longest = F.aggregate(w, F.lit(""), lambda m, x: F.when(F.length(x) > F.length(m), x).otherwise(m))
    some = F.size(w) > 0
    keys = F.array(
        F.when(some, F.concat(c, F.lit("_n4_"), F.substring(first, 1, 4))),
        F.when(some, F.concat(c, F.lit("_n3_"), F.substring(first, 1, 3))),
        F.when(some & (house != ""), F.concat(c, F.lit("_h_"), house, F.lit("_"), F.substring(first, 1, 3))),
        F.when(F.length(second) >= 4, F.concat(c, F.lit("_w2_"), F.substring(second, 1, 4))),
        F.when(F.length(longest) >= 5, F.concat(c, F.lit("_long_"), F.substring(longest, 1, 5))),
        F.when(~some & (house != ""), F.concat(c, F.lit("_h_"), house)),
    )
    return F.filter(keys, lambda k: k.isNotNull())


def longest_two(w: Column) -> Column:
    """The two longest words, the earlier first among equals."""
    ranked = F.array_sort(F.transform(w, lambda x, i: F.struct((-F.length(x)).alias("l"), i.alias("i"), x.alias("w"))))
    return F.slice(F.transform(ranked, lambda s: s["w"]), 1, 2)


def first_word(w: Column) -> Column:
    return F.coalesce(F.get(w, F.lit(0)), F.lit(""))


def last_word(w: Column) -> Column:
    return F.coalesce(F.try_element_at(w, F.lit(-1)), F.lit(""))

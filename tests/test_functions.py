"""Hand-traced values of the scalar operators."""

import pytest
from pyspark.sql import functions as F

from linkwright.functions import extract as ex
from linkwright.functions import similarity as sm
from linkwright.functions import text as tx


def value(spark, expr, *args):
    schema = ", ".join(f"a{i} string" for i in range(len(args)))
    return spark.createDataFrame([args], schema).select(expr(*[F.col(f"a{i}") for i in range(len(args))]).alias("v")).first()["v"]


@pytest.mark.parametrize(
    "raw, want",
    [
        ("Café  LLC LLC", "cafe"),
        ("Odyssey odyssey Foods", "odyssey foods"),
        ("A B A", "a b a"),
        ("Foo www.acme.co.in Bar", "foo bar"),
        ("Co-op L.L.C.", "op l c"),
        (None, ""),
        ("", ""),
        ("a a a b b a", "a b a"),
        ("ﬁne ½", "fine 1 2"),
    ],
)
def test_clean_text(spark, raw, want):
    assert value(spark, tx.clean_text, raw) == want


@pytest.mark.parametrize(
    "address, land, want",
    [
        ("Austin TX 78701-1234", "US", "78701"),
        ("12345-67890", "US", "67890"),
        ("Delhi 110001", "India", "110001"),
        ("Delhi 011000", "India", ""),
        ("750012 and 10001", "", "750012"),
        (None, None, ""),
    ],
)
def test_postal_code(spark, address, land, want):
    assert value(spark, ex.postal_code, address, land) == want


@pytest.mark.parametrize("a, b, want", [("kfc", "kentucky fried chicken", 1.0), ("ke", "kentucky fried chicken", 0.0), ("kf", "kentucky fried chicken", 1.0), ("boi", "bank of india", 1.0), ("bi", "bank of india", 1.0), (None, "x y", 0.0)])
def test_acronym_is_symmetric(spark, a, b, want):
    assert value(spark, ex.acronym_match, a, b) == value(spark, ex.acronym_match, b, a) == want


def test_extractors(spark):
    t = lambda n, a: ex.tokens(tx.clean_text(n), tx.clean_text(a))
    assert set(value(spark, t, "Delhi Traders Pvt Ltd", "12 Main Street 110001")) == {"delhi", "110001"}
    assert set(value(spark, ex.house_numbers, "12-A, 45 Main St 45")) == {"12", "45"}
    assert value(spark, ex.house_numbers, None) == []
    assert value(spark, ex.domain, "city hospital hotel", "") == "health"
    assert value(spark, ex.domain, "hotel2go", "") == ""
    assert value(spark, ex.char_ngrams, "ab") == ["ab"] and value(spark, ex.char_ngrams, "") == []
    assert value(spark, ex.simple_grams, "ab") == []
    assert value(spark, ex.blocking_keys, "Blue Sky Foods", "12 Oak", "US") == ["us_n4_blue", "us_n3_blu", "us_h_12_blu", "us_long_foods"]
    assert value(spark, lambda c: ex.longest_two(tx.words(c)), "foo delta blues") == ["delta", "blues"]


def test_similarities(spark):
    assert value(spark, sm.string_ratio, "night", "nacht") == pytest.approx(1 / 7)
    assert value(spark, sm.token_sort_ratio, "b a", "a b") == 1.0
    assert value(spark, lambda a, b: sm.jaccard(tx.words(a), tx.words(b)), "", "a") == 0.0
    assert sm.jaro_winkler_score("abcxxxxx", "cabxxxxx") == pytest.approx(0.9375)
    assert sm.jaro_winkler_score("abcdefgh", "abzzzzzz") == pytest.approx(0.6)
    assert sm.jaro_winkler_score("ab", "ba") == 0.0
    assert value(spark, sm.jaro_winkler, "x", None) == 0.0

import random
import unicodedata

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from plumbline.functions import ascii_fold, normalized, safe_int


def fold(spark, texts):
    frame = spark.createDataFrame(list(enumerate(texts)), "n int, x string")
    rows = frame.select("n", ascii_fold(F.col("x")).alias("y"), normalized(F.col("x")).alias("z")).collect()
    return {texts[row["n"]]: (row["y"], row["z"]) for row in rows}


FOLDED = {
    None: None,
    "": "",
    "plain": "plain",
    "Não gostei, é péssimo!": "Nao gostei, e pessimo!",
    "Österreich": "Osterreich",
    "straße": "strasse",
    "Ærø œuvre": "AEro oeuvre",
    "Łódź Đà Nẵng": "Lodz Da Nang",
    "“olá” – ‘sim’ — …": "\"ola\" - 'sim' -- ...",
    "1º 2ª ½ © €": "1o 2a 1/2 (c) EUR",
    "e\u0301 o\u0303": "e o",
    "top 👍🏽 demais ❤️": "top  demais ",
    "Ｆｕｌｌ": "Full",
    "þing ŋ ĳ": "thing ng ij",
    "a b": "a b",
    "привет 漢字 é": "привет 漢字 e",
    "fin\u202f! a\u3000b": "fin ! a b",
    "x\u2028y\u2029z": "x\ny\n\nz",
    "−5 5′ 6″ 1⁄2": "-5 5' 6\" 1/2",
    "10‰ №5 a→b": "10%0 No5 a->b",
    "H₂O x² ⅓": "H2O x2 1/3",
    "ﬁn Ǆ 5㎏": "fin DZ 5kg",
}


def test_fold_cases(spark):
    found = fold(spark, list(FOLDED))
    assert {text: pair[0] for text, pair in found.items()} == FOLDED
    assert found["straße"][1] == "STRASSE"
    assert found[None][1] is None


def test_fold_of_latin_letters_is_their_decomposition(spark):
    letters = [chr(c) for block in (range(0xC0, 0x180), range(0x1E00, 0x1F00)) for c in block]
    expected = {}
    for letter in letters:
        plain = "".join(c for c in unicodedata.normalize("NFKD", letter) if not unicodedata.combining(c))
        if len(plain) == 1 and plain.isascii():
            expected[letter] = plain
    found = fold(spark, letters)
    assert {letter: found[letter][0] for letter in expected} == expected
    assert len(expected) > 300


def test_fold_is_letter_by_letter(spark):
    """Mixed texts take different branches of the fold; all must agree with folding single letters."""
    generator = random.Random(7)
    alphabet = list("abc XYZ.") + list("áßœŁ—…“👍é漢©ŉ")
    single = {letter: pair[0] for letter, pair in fold(spark, alphabet).items()}
    texts = sorted({"".join(generator.choices(alphabet, k=generator.randint(1, 30))) for _ in range(500)})
    found = fold(spark, texts)
    assert {text: found[text][0] for text in texts} == {text: "".join(single[c] for c in text) for text in texts}


def test_fold_keeps_whole_long_texts(spark):
    text = "ação " * 50_000
    assert fold(spark, [text])[text][0] == "acao " * 50_000


INTEGERS = {
    None: None,
    "abc": None,
    "3": 3,
    "3.7": 3,
    " 4 ": 4,
    "-2.9": -2,
    "3.": 3,
    "+6": 6,
    "1e2": None,
    "": None,
    " ": None,
    "99999999999": None,
    "2147483647": 2147483647,
    "-2147483648": -2147483648,
    "2147483648.5": None,
    "\t7\n": 7,
    ".5": 0,
    ".": 0,
    "-": None,
    "1.2.3": None,
    "1 2": None,
    "٣": None,
    "1d": None,
    "0x1": None,
}


def test_safe_int_cases(spark):
    frame = spark.createDataFrame(list(enumerate(INTEGERS)), "n int, x string")
    rows = frame.select("x", safe_int(F.col("x")).alias("y")).collect()
    assert {row["x"]: row["y"] for row in rows} == INTEGERS


@pytest.fixture()
def legacy_cast(spark):
    spark.conf.set("spark.sql.ansi.enabled", "false")
    yield
    spark.conf.unset("spark.sql.ansi.enabled")


@settings(max_examples=5, deadline=None)
@given(texts=st.lists(st.text("0123456789+-. \t\nea", max_size=8), min_size=300, max_size=400))
def _equals_legacy(spark, texts):
    frame = spark.createDataFrame([(text,) for text in texts], "x string")
    both = frame.select("x", safe_int(F.col("x")).alias("safe"), F.col("x").cast("int").alias("legacy"))
    assert both.filter(~F.col("safe").eqNullSafe(F.col("legacy"))).collect() == []


def test_safe_int_equals_the_cast_without_ansi(spark, legacy_cast):
    _equals_legacy(spark)


def test_ansi_stays_on(spark):
    assert spark.conf.get("spark.sql.ansi.enabled") == "true"

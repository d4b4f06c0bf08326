import re
import unicodedata

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from hilada.functions import text as T

SPACES = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85        　"


def one(spark, value, *columns):
    return spark.createDataFrame([(value,)], "t string").select(*columns).first()


def clean(text):
    text = text.replace("\r\n", "\n").replace("\r", "\n")
    text = re.sub(r"\[\[PÁGINA\s+\d+\]\]", "\n", text, flags=re.I)
    text = re.sub(r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f]", "", text)
    text = re.sub(r"[ \t]+", " ", text)
    text = "\n".join(l.strip() for l in text.splitlines())
    return re.sub(r"\n{3,}", "\n\n", text).strip()


def normalized(text):
    text = re.sub("[   ]", " ", unicodedata.normalize("NFC", text))
    text = re.sub(r"[^\S\n]+", " ", re.sub(r"[ \t]+\n", "\n", text))
    return re.sub(r"\n{3,}", "\n\n", text).strip() + "\n"


def canonical(text):
    text = re.sub(r"([A-Za-zÁÉÍÓÚÜÑáéíóúüñ]+)-\n([a-záéíóúüñ]+)", r"\1\2", text)
    text = re.sub(r"^\s*\d+\s*$", "", text, flags=re.M)
    return re.sub(r"\n{3,}", "\n\n", text).strip() + "\n"


def test_white_space_is_pythons():
    assert {c for c in map(chr, range(0x10000)) if c.isspace()} == {chr(c) for a, b in T.SPACES for c in range(a, b + 1)}
    assert set(SPACES) <= {chr(c) for a, b in T.SPACES for c in range(a, b + 1)}


@settings(max_examples=15, deadline=None)
@given(st.lists(st.text(alphabet="aZñé1 \n\r\t-[]PÁGINA.²" + SPACES + "́\x07", max_size=60), min_size=20, max_size=60))
def test_forms_equal_python(spark, texts):
    c = F.col("t")
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", T.clean(c).alias("c"), T.normalize(c).alias("n"), T.canonical(c).alias("k")).collect()
    for r in rows:
        t = texts[r.i]
        assert (r.c, r.n, r.k) == (clean(t), normalized(t), canonical(t))


@pytest.mark.parametrize(
    ("text", "words"),
    [
        ("ſol ıx naïve año1 mar_tierra niño’s ²x ½ ab‍cd co-\noperar İstanbul", ["ſol", "ıx", "niño", "ab", "cd", "co", "operar", "stanbul"]),
        ("x́abc holá fin", ["abc", "holá", "fin"]), ("", []),
    ],
)
def test_lexical_tokens(spark, text, words):
    assert one(spark, text, T.lexical_tokens(F.col("t")))[0] == words


def test_lines_and_kinds(spark):
    assert one(spark, "a\x1cb\x85c d\r\ne\n", T.lines(F.col("t")))[0] == list("abcde")
    numeric = [one(spark, t, T.is_numeric_line(F.col("t")))[0] for t in ("12 3.", "(4)", "²", "IV")]
    upper = [one(spark, t, T.is_uppercase_line(F.col("t")))[0] for t in ("ÁÉÍÓÚ ABC d", "ABCD")]
    assert numeric == [True, True, True, False] and upper == [False, False]


def test_small_functions(spark):
    assert one(spark, " null ", T.scalar(F.col("t")))[0] is None and one(spark, " x ", T.scalar(F.col("t")))[0] == "x"
    assert one(spark, "a, b ,,c", T.names(F.col("t")))[0] == ["a", "b", "c"]
    assert one(spark, "a  b c", T.shortened(F.col("t"), 3), T.page_url("u/", F.col("t")))[0:2] == ("a b...", "u/a__b_c")
    assert one(spark, "python.org", T.uuid5("6ba7b810-9dad-11d1-80b4-00c04fd430c8", F.col("t")))[0] == "886313e1-3b8a-5372-9b90-0c9aee199e5d"
    assert spark.range(1).select(T.human_bytes(F.lit(1536))).first()[0] == "1.50 KB"


def test_nulls_give_nulls(spark):
    c = F.col("t")
    assert set(one(spark, None, T.clean(c), T.normalize(c), T.canonical(c), T.lexical_tokens(c))) == {None}

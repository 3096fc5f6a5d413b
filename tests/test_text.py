import html as html_module
import re

import pytest
from pyspark.sql import functions as F

from catalogflow.functions import text as tx
from catalogflow.functions.html import text_nodes
from conftest import rows


@pytest.mark.parametrize(
    ("markup", "nodes"),
    [
        ("plain", "plain"),
        ("", ""),
        ("   ", ""),
        ("<p> one </p><p>two</p>", "one\ntwo"),
        ("a<br>b<br/>c", "a\nb\nc"),
        ("caf&eacute; &amp; th&#233;", "café & thé"),
        ("&amp;#39;", "&#39;"),
        ('<script>var t="</p>";</script>x', "x"),
        ("<style>p{}</style>", ""),
        ("<!-- no -->yes", "yes"),
        ("a<!-- x -->b", "a\nb"),
        ("1 < 2", "1 < 2"),
        ("<b>bold</b> tail", "bold\ntail"),
        ("<p>unclosed", "unclosed"),
        ("<div title='a > b'>in</div>", "in"),
        ("&nbsp;<i>x</i>&nbsp;", "x"),
    ],
)
def test_text_nodes(markup, nodes):
    assert text_nodes(markup) == nodes


def cleaned(markup):
    text = text_nodes(markup).replace("\n", ". ")
    text = re.sub(r"&#\d+;", "", text)
    text = re.sub("¿{2,}", " ", text).replace("¿", "")
    return re.sub(r"[^\x00-\x7F]+", "", text)


SAMPLES = ["", "  x ", "a\nb", "¿¿what¿", "é¿¿¿è", "&#39;s", "&amp;#39;s", "<p>a</p>\n<p>b</p>", "5 < 6 & 7", "caf&eacute; noir", None]


def test_clean_description_matches_plain_python(spark):
    df = spark.createDataFrame([(i, s) for i, s in enumerate(SAMPLES)], "i int, s string")
    got = {r["i"]: r["c"] for r in df.select("i", tx.clean_description(F.col("s")).alias("c")).collect()}
    assert got == {i: None if s is None else cleaned(s) for i, s in enumerate(SAMPLES)}


def test_native_cleaning_agrees_without_numeric_references(spark):
    plain = [s for s in SAMPLES if s is None or not re.search("&#|5 <", s)]
    df = spark.createDataFrame([(s,) for s in plain], "s string")
    both = df.select(tx.clean_description(F.col("s")).alias("a"), tx.clean_description_native(F.col("s")).alias("b"))
    assert both.where(~F.col("a").eqNullSafe(F.col("b"))).count() == 0


def test_full_texts_on_blank_and_null(spark):
    df = spark.createDataFrame([("t", None), ("t", ""), ("t", "  "), (None, "d"), ("t", "d")], "designation string, description string")
    a, b = "designation", "description"
    got = df.select(tx.full_text_strip(a, b), tx.full_text_truthy(a, b), tx.full_text_ignore_nulls(a, b)).collect()
    assert [tuple(r) for r in got] == [
        ("t", "t", "t"), ("t", "t", "t. "), ("t", "t.   ", "t.   "), (". d", ". d", "d"), ("t. d", "t. d", "t. d")]


def test_text_tabular_counts_like_python(spark):
    cases = [("Été 2024, OK!", "a-b  c\td"), ("", None), ("x", "   "), (" NBSP", "Ünï"), (None, None)]
    df = spark.createDataFrame([(i, *c) for i, c in enumerate(cases)], "i int, designation string, description string")
    got = {r["i"]: r for r in df.select("i", *tx.text_tabular("designation", "description")).collect()}
    for i, (d, e) in enumerate(cases):
        d, e = d or "", e or ""
        t = f"{d}. {e}" if e else d
        n = len(t)
        assert got[i]["tab_text_length"] == n
        assert got[i]["tab_word_count"] == len(t.split())
        assert got[i]["tab_designation_length"] == len(d)
        assert got[i]["tab_description_present"] == int(bool(e.strip()))
        for name, count in (("uppercase_ratio", sum(c.isupper() for c in t)), ("digit_ratio", sum(c.isdigit() for c in t)),
                            ("punct_density", sum(c in ".,;:!?-" for c in t))):
            assert got[i][f"tab_{name}"] == pytest.approx(count / n if n else 0.0)


def test_tokens_and_padding(spark):
    from catalogflow.operators.aggregates import encode_tokens, vocabulary

    df = spark.createDataFrame([(1, "B a, a! c"), (2, ""), (3, None), (4, "z-a (b)")], "id int, text string")
    vocab = vocabulary(df, "text", 4)
    assert rows(vocab.select("token", "n", "id")) == [("a", 3, 2), ("b", 2, 3)]
    got = dict(rows(encode_tokens(df, vocab, "id", "text", 3)))
    assert got == {1: [3, 2, 2], 2: [0, 0, 0], 3: [0, 0, 0], 4: [1, 2, 3]}


def test_feature_group(spark):
    names = ["p_text_class_1", "TEXT_P_x", "my_image_proba", "proba_image_3", "derived__kl", "Derived__kl", "tab__x"]
    df = spark.createDataFrame([(n,) for n in names], "n string").select(tx.feature_group(F.col("n")).alias("g"))
    assert [r["g"] for r in df.collect()] == ["text", "text", "image", "image", "derived", "tabular", "tabular"]


def test_entities_unescape_like_the_standard_library():
    assert text_nodes("&copy; &lt;b&gt;") == html_module.unescape("&copy; &lt;b&gt;")

import re

import pytest
from pyspark.sql import functions as F

from vectorloom.functions import text


def run(spark, fn, value):
    return spark.createDataFrame([(value,)], "x string").select(fn(F.col("x")).alias("y")).first()["y"]


@pytest.mark.parametrize(
    "raw, expected",
    [
        ("Hello world", "Hello world"),
        ("Hello   world\n\ttab", "Hello world tab"),
        ("", None),
        (None, None),
        ("   ", None),
        ("   \\n\\t  ", None),
        ("  ", None),
        ("Machine Learning", "Machine Learning"),
        ("a b c\u001cd\u0085e", "a b c d e"),
        ("a﻿b", "a﻿b"),
        ("$E=mc^2$ holds", "E=mc^2 holds"),
        ("50\\% of \\$5 \\& more", "50% of $5 & more"),
        ("one % comment\ntwo", "one two"),
        ("Erd\\H{o}s, Poincar\\'e and G\\\"odel", "Erdős, Poincaré and Gödel"),
        ("na\\\"{\\i}ve", "naïve"),
        ("$\\frac{a}{\\mathbf{b}}$ and $\\sqrt{x}$", "a/b and √(x)"),
        ("\\emph{very \\textbf{deep}} nets~work", "very deep nets work"),
        ("see \\cite{abc} in \\ref{x}", "see <cit.> in <ref>"),
        ("\\alpha decay, $\\Lambda_{c}$", "α decay, Λ_c"),
        ("\\unknown{kept} text", "kept text"),
        ("1--2 --- ``quoted''", "1–2 — “quoted”"),
        ("\\begin{equation} x \\end{equation}", "x"),
        ("\\footnote{Erd\\H{o}s \\v s \\c{c}}", "[Erdős š ç]"),
        ("\\( a \\) \\[ b \\] c\\, d", "a b c d"),
        ("\\section*{Intro} ends \\", "Intro ends"),
        ("\\emph{a \\textbf{b \\textit{c}}} \\frac{1}{2}", "a b c 1/2"),
        ("100\\% sure % not\nso", "100% sure so"),
    ],
)
def test_clean(spark, raw, expected):
    assert run(spark, text.clean_abstract, raw) == expected
    assert run(spark, text.clean_title, raw) == expected


def test_every_space_character(spark):
    """Each code point of the basic plane is white space here exactly when it is in Python."""
    points = [i for i in range(0x10000) if not 0xD800 <= i < 0xE000]
    df = spark.createDataFrame([(i, chr(i)) for i in points], "i int, c string")
    space = df.select("i", F.rlike("c", F.lit(f"^{text.SPACE}$")).alias("s"), text.collapse_space(F.concat(F.lit("a"), "c", F.lit("b"))).alias("t"))
    for row in space.collect():
        assert row.s == chr(row.i).isspace()
        assert row.t == (f"a{chr(row.i)}b" if not row.s else "a b")


def test_clean_keeps_words(spark):
    out = run(spark, text.clean_abstract, "$\\\\alpha$ decay")
    assert "alpha" in out and "decay" in out
    assert "some text" in run(spark, text.clean_abstract, "\\begin{invalid} some text")
    assert "Chemistry" in run(spark, text.clean_title, "$H_2O$ Chemistry")


def test_short_and_full_way_agree(spark):
    """A text without a backslash gives the same through the rules for one with."""
    samples = ["a $x$ b", "50 % off\nnext", "{x}~y & z", "plain -- text", "%%\n%a\nb", "``q'' #_^"]
    df = spark.createDataFrame([(s, s + "\n\\relax") for s in samples], "a string, b string")
    for row in df.select(text.clean_text(F.col("a")).alias("a"), text.clean_text(F.col("b")).alias("b")).collect():
        assert row.a == row.b


def test_ways_around_the_rules(spark):
    """Texts that are told to need no rule, and their neighbours that need one, against the rules themselves."""
    marks = ["", "-", "--", "---", "`", "``", "'", "''", "''" "'", "!", "!`", "?`", "`?", "a'b", "l'eau - x", "$", "{", "}", "~", "&", "%x\ny", "100 %"]
    spaces = ["", " ", "  ", "\n", "\n\n", " \n", "\n ", "\t", "\n\t", "\r\n", " ", " \n", "　", "—", "​"]
    samples = [f"{s}a{m}{s}b{s}" for m in marks for s in spaces]
    singles = {"$": "", "{": "", "}": "", "~": " ", "&": " "}
    signs = {"---": "—", "--": "–", "``": "“", "''": "”", "!`": "¡", "?`": "¿"}
    df = spark.createDataFrame([(s,) for s in [*samples, None]], "x string")
    for row in df.select("x", text.clean_text(F.col("x")).alias("y")).collect():
        if row.x is None:
            assert row.y is None
            continue
        want = re.sub(r"%[^\n]*", "", row.x)
        for source, target in {**singles, **signs}.items():
            want = want.replace(source, target)
        assert row.y == (" ".join(want.split()) or None)


@pytest.mark.parametrize(
    "url, expected",
    [
        ("http://arxiv.org/abs/2301.12345", "2301.12345"),
        ("http://arxiv.org/abs/quant-ph/0202022", "quant-ph/0202022"),
        ("http://example.com/other", None),
        ("", None),
    ],
)
def test_id_from_url(spark, url, expected):
    assert run(spark, text.id_from_url, url) == expected


def test_small_functions(spark):
    assert run(spark, text.strip_html, "<p>Hello <b>you</b></p>") == "Hello you"
    assert run(spark, text.comma_list, "A B,\n C , ,D") == ["A B", "C", "D"]
    assert run(spark, text.word_list, " cs.CL  math.CO ") == ["cs.CL", "math.CO"]
    assert run(spark, text.word_list, "") == []
    assert run(spark, text.strip, "\t  x y\n") == "x y"
    assert run(spark, lambda c: text.preview(c, 3), "abcdef") == "abc..."
    assert run(spark, text.abs_url, "1") == "https://arxiv.org/abs/1"
    assert run(spark, text.pdf_url, "1") == "https://arxiv.org/pdf/1"
    assert run(spark, lambda c: text.id_from_url(c, strip_version=True), "x/abs/2301.12345v2") == "2301.12345"


@pytest.mark.parametrize("depth", range(1, 9))
def test_nested_macros_to_any_depth(spark, depth):
    raw, want = "x", "x"
    for i in range(depth):
        raw, want = rf"\frac{{{i}}}{{{raw}}}", f"{i}/{want}"
    raw += r" \cite{" + r"\textbf{" * depth + "k" + "}" * depth + "}"
    assert run(spark, text.clean_text, raw) == want + " <cit.>"

"""Text cleaning and small string operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from vectorloom.config import ABS_URL, PDF_URL
from vectorloom.functions.latex import latex_to_text

# Fixed value: the characters Unicode-aware whitespace matching covers; Java's
# own classes leave some of them out. Latin ones stand one by one and the others
# inside one range, which lets a letter fail after two comparisons.
SPACE = (
    r"[\t\n\x0b\f\r\x1c\x1d\x1e\x1f\x20\x85\xa0"
    r"[\u1680-\u3000&&[\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]]]"
)
# The same without the plain space and the line feed, which hardly a text is free of.
_RARE_SPACE = (
    r"[\t\x0b\f\r\x1c\x1d\x1e\x1f\x85\xa0"
    r"[\u1680-\u3000&&[\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]]]"
)
# The same characters one by one.
_SPACE_CHARS = "".join(c for c in map(chr, range(0x3001)) if c.isspace())


def strip(text: Column) -> Column:
    """Drop Unicode whitespace at both ends."""
    return F.btrim(text, F.lit(_SPACE_CHARS))


def null_if_blank(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def collapse_space(text: Column) -> Column:
    """Every run of Unicode whitespace becomes one space; none at the ends.

    A single plain space is not matched, so ordinary text is hardly touched; a
    text whose lines end in nothing but line feeds is not searched for runs.
    """

    def runs(line: Column) -> Column:
        short = F.regexp_replace(line, f"{SPACE}(?:{SPACE}+|(?<! ))", " ")
        return F.when(F.contains(line, F.lit("  ")) | F.rlike(line, F.lit(_RARE_SPACE)), short).otherwise(line)

    # The one-element list binds the text, so it is computed only once.
    return F.trim(F.get(F.transform(F.array(F.replace(text, F.lit("\n"), F.lit(" "))), runs), F.lit(0)))


def clean_text(text: Column) -> Column:
    """Markup to text, whitespace collapsed, null when nothing is left."""
    return null_if_blank(collapse_space(latex_to_text(text)))


# Titles and abstracts follow one rule.
clean_abstract = clean_text
clean_title = clean_text


def strip_html(html: Column) -> Column:
    """Drop everything that looks like a tag."""
    return F.regexp_replace(html, "<[^>]+>", "")


def preview(text: Column, length: int, tail: str = "...") -> Column:
    """The first characters of a text with a tail mark."""
    return F.concat(F.substring(text, 1, length), F.lit(tail))


def abs_url(paper_id: Column) -> Column:
    return F.concat(F.lit(ABS_URL), paper_id)


def pdf_url(paper_id: Column) -> Column:
    return F.concat(F.lit(PDF_URL), paper_id)


def word_list(text: Column) -> Column:
    """Words between whitespace; an empty text gives an empty list."""
    return F.filter(F.split(text, f"{SPACE}+"), lambda w: w != F.lit(""))


def comma_list(text: Column) -> Column:
    """Names between commas, stripped, blanks dropped."""
    return F.filter(F.transform(F.split(text, ","), strip), lambda w: w != F.lit(""))


def id_from_url(url: Column, pattern: str = r"/abs/(.+)$", strip_version: bool = False) -> Column:
    """What follows the marker in a link, or null."""
    found = null_if_blank(F.regexp_extract(url, pattern, 1))
    return F.regexp_replace(found, r"v\d+$", "") if strip_version else found

"""Text cleaning and segmentation as native column expressions.

Everything here stays on the JVM side: no UDF, no shuffle, one row in and one row out.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusflow.functions.binding import let

# Every character Python's str.strip() and str.split() treat as whitespace.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# The same set as a character class. The wide part sits behind one range test, so plain
# text fails it in a single step.
_WIDE = r"[\u1680-\u3000&&[\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]]"
SPACE = r"[\t\n\x0b\f\r\x1c\x1d\x1e\x1f \x85\xa0" + _WIDE + "]"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _where(c: Column | str, test: Callable[[Column], Column], change: Callable) -> Column:
    """Change the texts that pass a cheap test; a rewrite copies a text twice."""
    return let(_col(c), lambda x: F.when(test(x), change(x)).otherwise(x))


def strip_text(c: Column | str) -> Column:
    """Remove whitespace (Unicode included) from both ends.

    Only texts with a loose end are trimmed: ``btrim`` indexes every character first.
    """

    def loose(x: Column) -> Column:
        edges = [test(x, F.lit(e)) for e in WHITESPACE for test in (F.startswith, F.endswith)]
        return reduce(or_, edges)

    return _where(c, loose, lambda x: F.btrim(x, F.lit(WHITESPACE)))


def drop_parentheticals(c: Column | str) -> Column:
    """Remove ``( ... )`` up to the first closing bracket; an unclosed one stays."""
    return _where(
        c,
        lambda x: F.contains(x, F.lit("(")),
        lambda x: F.regexp_replace(x, r"\([^)]*\)", ""),
    )


def tighten_punctuation(c: Column | str) -> Column:
    """Drop one blank before ``?``, ``.``, ``!`` or ``"`` when a blank or the end follows."""
    return F.regexp_replace(_col(c), SPACE + r'([?.!"](?:' + SPACE + r"|\z))", "$1")


def clean_whitespace(c: Column | str) -> Column:
    """Strip blanks and tabs from each line and squeeze runs of empty lines to one."""

    def ragged(x: Column) -> Column:
        edges = [F.contains(x, F.lit(e)) for e in (" \n", "\n ", "\t\n", "\n\t")]
        edges += [test(x, F.lit(e)) for e in " \t" for test in (F.startswith, F.endswith)]
        return reduce(or_, edges)

    def strip_lines(x: Column) -> Column:
        lines = F.transform(F.split(x, "\n"), lambda line: F.btrim(line, F.lit(" \t")))
        return F.array_join(lines, "\n")

    return _where(
        _where(c, ragged, strip_lines),
        lambda x: F.contains(x, F.lit("\n\n\n")),
        lambda x: F.regexp_replace(x, r"\n{3,}", "\n\n"),
    )


def clean_text(c: Column | str) -> Column:
    """The cleaning chain in its fixed order: strip, brackets, punctuation, lines."""
    return clean_whitespace(tighten_punctuation(drop_parentheticals(strip_text(c))))


def sentence_array(c: Column | str, abbreviations: Sequence[str] = ()) -> Column:
    """Split after ``.``, ``!`` or ``?`` followed by whitespace; pieces are stripped.

    A cut takes all whitespace between two pieces, so stripping the text strips them all.
    The pattern tries the whitespace before it looks back, which passes over letters fast.
    ``abbreviations`` (such as ``"Dr."``) never end a sentence.
    """
    guard = ""
    if abbreviations:
        words = "|".join(r"\Q" + a.rstrip(".") + r"\E" for a in abbreviations)
        guard = rf"(?<!\b(?:{words})\.{SPACE})"
    return F.split(strip_text(c), rf"{SPACE}(?<=[.!?]{SPACE}){guard}{SPACE}*+")


def word_count(c: Column | str) -> Column:
    """Number of whitespace-separated words (bigint), like Python ``len(s.split())``.

    Counts the gaps of the stripped text: one scan, and no array of words is built.
    """
    stripped = F.btrim(_col(c), F.lit(WHITESPACE))
    gaps = F.regexp_count(stripped, F.lit(SPACE + "++"))
    return F.when(stripped == "", F.lit(0)).otherwise(gaps + 1).cast("long")


def long_sentences(
    c: Column | str, min_words: int = 8, abbreviations: Sequence[str] = ()
) -> Column:
    """Sentences of more than ``min_words`` words, in order."""
    gap = SPACE + "++"

    def is_long(sentence: Column) -> Column:
        if 0 < min_words <= 64:  # stops reading at the last gap that matters
            return sentence.rlike(rf"^(?:[^{gap[1:-3]}]++{gap}){{{min_words}}}")
        return F.regexp_count(sentence, F.lit(gap)) >= min_words

    return F.filter(F.array_remove(sentence_array(c, abbreviations), ""), is_long)


def clean_article(
    c: Column | str, min_words: int = 8, abbreviations: Sequence[str] = ()
) -> Column:
    """Cleaned text rebuilt from its long sentences; null when none is long enough.

    Gives what exploding to snippets, filtering and regrouping by document would give,
    without moving a row.
    """
    kept = long_sentences(clean_text(c), min_words, abbreviations)
    return F.nullif(F.concat_ws(" ", kept), F.lit(""))


def leading_sentences(c: Column | str, n: int) -> Column:
    """The first ``n`` non-empty sentences joined by a blank."""
    full = F.filter(sentence_array(c), lambda s: s != "")
    return F.concat_ws(" ", F.slice(full, 1, n))

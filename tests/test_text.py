import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from corpusflow.functions import text as T
from corpusflow.operators import snippets as S

NBSP, WIDE = "\u00a0", "\u3000"


def values(spark, expression, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, c string")
    return [r.v for r in df.select("i", expression.alias("v")).orderBy("i").collect()]


def test_strip_removes_every_python_whitespace(spark):
    edge = T.WHITESPACE
    texts = [f"{edge}a b{edge}", edge, "", None, f"a{edge}b"]
    assert values(spark, T.strip_text("c"), texts) == ["a b", "", "", None, f"a{edge}b"]
    assert all(ch.isspace() for ch in edge)
    assert sum(chr(i).isspace() for i in range(0x11000)) == len(edge)


def test_drop_parentheticals(spark):
    texts = ["a (b) c", "a (b\nc) d", "(a (b) c)", "a (b", "a)b", None]
    expected = ["a  c", "a  d", " c)", "a (b", "a)b", None]
    assert values(spark, T.drop_parentheticals("c"), texts) == expected


@pytest.mark.parametrize(
    "text",
    [
        "a . b", "a .", "a . . b", 'x " y', "a ! ?", "a .b", "a\n.\nb", f"a{NBSP}.{WIDE}b",
        "a \x1c. b", " .", "a  .  b",
    ],
)
def test_tighten_punctuation_follows_python(spark, text):
    expected = re.sub(r'\s([?.!"](?:\s|$))', r"\1", text)
    assert values(spark, T.tighten_punctuation("c"), [text]) == [expected]


def test_clean_whitespace(spark):
    texts = ["  a \t\n\n\n\n b  \nc ", "a\n\nb", None]
    assert values(spark, T.clean_whitespace("c"), texts) == ["a\n\nb\nc", "a\n\nb", None]


def test_word_count(spark):
    texts = ["a b  c", "", " \n ", f"a{NBSP}b\x1cc{WIDE}", "one", None]
    assert values(spark, T.word_count("c"), texts) == [3, 0, 0, 3, 1, None]


@settings(
    max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(st.lists(st.text(alphabet="ab.!? ()\n\t\"\u00a0\x1c", max_size=60), min_size=30, max_size=60))
def test_cleaning_and_counting_follow_python(spark, texts):
    strip = [t.strip() for t in texts]
    brackets = [re.sub(r"\([^)]*\)", "", t) for t in strip]
    tight = [re.sub(r'\s([?.!"](?:\s|$))', r"\1", t) for t in brackets]
    chain = T.tighten_punctuation(T.drop_parentheticals(T.strip_text("c")))
    assert values(spark, chain, texts) == tight
    assert values(spark, T.word_count("c"), texts) == [len(t.split()) for t in texts]
    pieces = [[p.strip() for p in re.split(r"(?<=[.!?])\s+", t.strip())] for t in texts]
    assert values(spark, T.sentence_array("c"), texts) == pieces
    for least in (1, 2):
        long = [[p for p in ps if len(p.split()) > least] for ps in pieces]
        assert values(spark, T.long_sentences("c", least), texts) == long
    lines = [re.sub("\n{3,}", "\n\n", "\n".join(x.strip(" \t") for x in t.split("\n"))) for t in texts]
    assert values(spark, T.clean_whitespace("c"), texts) == lines


def docs(spark):
    long = "One two three four five six seven eight nine."
    return spark.createDataFrame(
        [
            (1, f"{long} Short one. {long.upper()}"),
            (2, "Too short. Also short."),
            (3, None),
            (4, f"  {long}  "),
            (5, "one two three four five six seven eight."),
        ],
        "doc_id long, article string",
    )


def test_snippets(spark):
    rows = S.split_sentences(docs(spark)).where("doc_id = 1").orderBy("split_id").collect()
    assert [r.doc_split_id for r in rows] == ["1_0", "1_1", "1_2"]
    assert [r.snippet_len for r in rows] == [9, 2, 9]
    types = dict(S.split_sentences(docs(spark)).dtypes)
    assert types == {
        "doc_split_id": "string",
        "article_snippet": "string",
        "doc_id": "bigint",
        "snippet_len": "bigint",
        "split_id": "bigint",
    }


def test_split_positions(spark):
    df = spark.createDataFrame([(1, "A. (x)\n. B.")], "doc_id long, article string")
    rows = S.split_sentences(df, clean=False).collect()
    assert [(r.split_id, r.article_snippet) for r in rows] == [(0, "A."), (1, "(x)\n."), (2, "B.")]
    blank = spark.createDataFrame([(1, " . A. "), (2, " ")], "doc_id long, article string")
    assert [r.split_id for r in S.split_sentences(blank, clean=False).collect()] == [0, 1]


def test_long_sentences_of_any_limit(spark):
    text = " ".join(["w"] * 70) + ". " + " ".join(["w"] * 71) + ". One."
    for least, kept in ((0, 3), (1, 2), (64, 2), (65, 2), (70, 1), (71, 0)):
        [found] = values(spark, T.long_sentences("c", least), [text])
        assert len(found) == kept


def test_abbreviations_do_not_end_a_sentence(spark):
    text = "Dr. Who met e.g. Ann. She left."
    plain, guarded = T.sentence_array("c"), T.sentence_array("c", ["Dr.", "e.g."])
    assert len(values(spark, plain, [text])[0]) == 4
    assert values(spark, guarded, [text]) == [["Dr. Who met e.g. Ann.", "She left."]]


def test_clean_article_forms_agree(spark):
    table = docs(spark)
    by_row = S.with_clean_article(table).orderBy("doc_id").collect()
    regrouped = S.clean_articles(table, S.split_sentences(table)).orderBy("doc_id").collect()
    assert by_row == regrouped
    assert [r.doc_id for r in by_row] == [1, 4]  # eight words are not enough


def test_reassembly_of_a_long_document(spark):
    n = 10_000
    rows = spark.range(n).select(
        F.lit(7).alias("doc_id"),
        (F.lit(n) - F.col("id")).alias("split_id"),
        (F.lit(n) - F.col("id")).cast("string").alias("article_snippet"),
    )
    [row] = S.reassemble_document(rows).collect()
    assert row.article_clean == " ".join(str(i) for i in range(1, n + 1))


def test_dedupe(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("b", 2)], "k string, v int")
    assert sorted(S.dedupe_by_key(df, ["k"]).collect()) == [("a", 1), ("b", 2)]

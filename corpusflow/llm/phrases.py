"""Collocations: phrases of two and three words that stick together, the best of each language.

A phrase's score is the least, over its cuts in two, of ``a * a / (l * r)``: its own count squared
over the counts of both parts. The search grows phrases by a word at the end, best first. A prefix
``p`` that begins with word ``x`` bounds whatever grows from it: a longer phrase has at most the
count of ``p``, and its part after ``x`` has at least its own, so its score is at most
``f(p) / f(x)`` and, among equal scores, its count at most ``f(p)``. Words have no such bound
yet, so all pairs are counted; three words are counted only where the pair they begin with is
in the frontier (its bound reaches the mark) or a pair inside them may be dropped in their favour.
The mark is the score and count of a pair somewhat below the wanted number; where too few phrases
survive above it, the mark is lowered and the frontier grows in the next wave.

Every pass over the texts counts whole Arrow batches by numpy on exact word numbers, so a phrase
leaves a batch once, however often it occurs; Spark adds up the batches' counts and joins counts
to phrases. Nothing is gathered by language: ranks are positions in a range-partitioned order.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusflow.llm.storage import written
from corpusflow.llm.textarrays import lowered, utf8, words
from corpusflow.operators.ids import with_position

TOP = 2000
LEAST = 10
SCALE = 1_000_000
# A longer phrase with this share of a phrase's count (in percent) takes its place.
SHARE = 50
#: Pairs up to which a wave's frontier is sent to the tasks (some 15 MB); beyond, they count all.
FRONTIER = 500_000
#: Rows up to which a table with a row for each language is broadcast.
LANGUAGES = 10_000
#: Bytes of text that are counted at once, if no single text is longer. A worker's arrays take
#: some 20 times as much.
PART_BYTES = 4_000_000

# The bytes that end a piece, and those that part words in one.
_ENDS = (*b".,;:!?", 0x0A, 0x0B, 0x0C, 0x0D)
_GAPS = (0x20, 0x09)
_LETTERS = np.ones(256, bool)
_LETTERS[[*_ENDS, *_GAPS]] = False
_END = np.zeros(256, bool)
_END[list(_ENDS)] = True

_COUNTS = "lang string, size int, phrase string, n long"


class Words:
    """The words of some texts as numbers, and which of them are neighbours in a piece."""

    def __init__(self, texts: pa.Array, langs: pa.Array):
        data, offsets = utf8(texts)
        data = lowered(data)
        starts, ends, first = words(data, offsets, _LETTERS)
        length = np.zeros(len(starts) + 1, np.int64)
        np.cumsum(ends - starts, out=length[1:])
        kept = data[_LETTERS[data]] if len(data) else data
        spelled = pa.Array.from_buffers(
            pa.large_string(), len(starts), [None, pa.py_buffer(length), pa.py_buffer(np.ascontiguousarray(kept))]
        ).dictionary_encode()
        self.spelling = spelled.dictionary
        self.word = spelled.indices.to_numpy().astype(np.int64)
        coded = pc.fill_null(langs, "und").dictionary_encode()
        self.langs = coded.dictionary
        per_text = np.diff(first)
        self.lang = np.repeat(coded.indices.to_numpy().astype(np.int64), per_text)
        piece = np.searchsorted(np.flatnonzero(_END[data]), starts)
        text = np.repeat(np.arange(len(per_text)), per_text)
        self.next = (piece[1:] == piece[:-1]) & (text[1:] == text[:-1])

    def runs(self, size: int) -> np.ndarray:
        """Where runs of ``size`` words begin that lie in one piece."""
        n = max(0, len(self.word) - max(size, 1) + 1)
        inside = np.ones(n, bool)
        for j in range(size - 1):
            inside &= self.next[j : j + n]
        return np.flatnonzero(inside)

    def counted(self, size: int, at: np.ndarray | None = None) -> pa.RecordBatch:
        """Every distinct run of a language with its count; of no words: all words' count."""
        at = self.runs(size) if at is None else at
        parts = [self.lang[at], *(self.word[at + j] for j in range(size))]
        widths = [len(self.langs), *[len(self.spelling)] * size]
        key, many = parts[0], widths[0]
        for part, width in zip(parts[1:], widths[1:]):
            if many * width >= 2**62:  # number the runs so far anew, which are few
                values, key = np.unique(key, return_inverse=True)
                many = len(values)
            key, many = key * width + part, many * width
        _, where, n = np.unique(key, return_index=True, return_counts=True)
        of = at[where]
        spelled = [self.spelling.take(pa.array(self.word[of + j])) for j in range(size)]
        phrase = pc.binary_join_element_wise(*spelled, pa.scalar(" ", pa.large_string())) if size else pa.array([""] * len(of))
        return pa.RecordBatch.from_arrays(
            [
                self.langs.take(pa.array(self.lang[of])).cast(pa.string()),
                pa.array(np.full(len(of), size, np.int32)),
                phrase.cast(pa.string()),
                pa.array(n.astype(np.int64)),
            ],
            names=["lang", "size", "phrase", "n"],
        )

    def among(self, pairs: pa.Table) -> np.ndarray:
        """For each word, whether it and the next one are one of the pairs in its language."""
        found = np.zeros(len(self.word), bool)
        if not len(self.word):
            return found
        width = len(self.spelling)
        numbers = [
            pc.index_in(pairs.column(name).cast(values.type), values).to_numpy(zero_copy_only=False)
            for name, values in (("lang", self.langs), ("x", self.spelling), ("y", self.spelling))
        ]
        known = ~np.logical_or.reduce([np.isnan(v.astype(np.float64)) for v in numbers])
        lang, x, y = (v[known].astype(np.int64) for v in numbers)
        wanted = np.unique((lang * width + x) * width + y)
        if len(wanted):
            key = (self.lang[:-1] * width + self.word[:-1]) * width + self.word[1:]
            place = np.minimum(np.searchsorted(wanted, key), len(wanted) - 1)
            found[:-1] = self.next & (wanted[place] == key)
        return found


def _parts(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    size = np.cumsum(pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False))
    part = size // PART_BYTES
    edges = np.flatnonzero(np.diff(part, prepend=-1)) if len(part) else []
    for a, b in zip(edges, [*edges[1:], batch.num_rows]):
        yield batch.slice(a, b - a)


def _texts(docs: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    return docs.select(F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"))


def _summed(texts: DataFrame, count) -> DataFrame:
    """Counts of all batches added up. A batch has each phrase once, so nothing is summed earlier."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _parts(batch):
                some = Words(part.column("text"), part.column("lang"))
                for made in count(some):
                    for at in range(0, made.num_rows, 200_000):
                        yield made.slice(at, 200_000)

    key = ["lang", "size", "phrase"]
    return texts.mapInArrow(run, _COUNTS).repartition(*key).groupBy(*key).agg(F.sum("n").alias("n"))


def count_pairs(docs: DataFrame, least: int = LEAST, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``lang, size, phrase, n`` of phrases of up to two words; rare words and pairs are left out.

    The phrase of no words has the number of all words of its language.
    """
    found = _summed(_texts(docs, text_col, lang_col), lambda w: (w.counted(size) for size in (0, 1, 2)))
    return found.where((F.col("n") >= least) | (F.col("size") == 0))


def count_triples(
    docs: DataFrame,
    frontier: DataFrame,
    least: int = LEAST,
    text_col: str = "text",
    lang_col: str = "lang",
    limit: int = FRONTIER,
) -> DataFrame:
    """``lang, phrase, n`` of three words that begin with a pair of the frontier that may grow, or
    end with one that may be dropped (``lang, x, y, grows, drops``)."""
    if frontier.limit(limit + 1).count() <= limit:
        pairs = frontier.toArrow()
        grows = pairs.filter(pairs.column("grows")).select(["lang", "x", "y"])
        drops = pairs.filter(pairs.column("drops")).select(["lang", "x", "y"])

        def count(some: Words) -> Iterator[pa.RecordBatch]:
            at = some.runs(3)
            begins, ends = some.among(grows), some.among(drops)
            yield some.counted(3, at[begins[at] | ends[at + 1]])
    else:

        def count(some: Words) -> Iterator[pa.RecordBatch]:
            yield some.counted(3)

    found = _summed(_texts(docs, text_col, lang_col), count)
    return found.where(F.col("n") >= least).select("lang", "phrase", "n")


def _big(c: str | Column) -> Column:
    return F.col(c).cast("decimal(15,0)") if isinstance(c, str) else c.cast("decimal(15,0)")


def _scored(a: str, left: str, right: str) -> Column:
    """``floor(SCALE * a * a / (l * r))``; counts up to 10^15 give exact products.

    The quotient is at most ``SCALE``, as neither part is rarer than the phrase.
    """
    over = _big(a) * _big(a) * F.lit(SCALE).cast("decimal(7,0)")
    return F.call_function("div", over, _big(left) * _big(right))


def _score_pairs(counts: DataFrame) -> DataFrame:
    """``lang, phrase, x, y, a, l, r, score, bound`` of pairs."""
    single = counts.where("size = 1").select("lang", "phrase", "n")
    pair = counts.where("size = 2").select(
        "lang",
        "phrase",
        F.substring_index("phrase", " ", 1).alias("x"),
        F.substring_index("phrase", " ", -1).alias("y"),
        F.col("n").alias("a"),
    )
    first = single.select("lang", F.col("phrase").alias("x"), F.col("n").alias("l"))
    second = single.select("lang", F.col("phrase").alias("y"), F.col("n").alias("r"))
    return (
        pair.join(first, ["lang", "x"])
        .join(second, ["lang", "y"])
        .select("lang", "phrase", "x", "y", "a", "l", "r", _scored("a", "l", "r").alias("score"),
                F.call_function("div", F.col("a") * SCALE, F.col("l")).alias("bound"))
    )


def _score_triples(triples: DataFrame, pairs: DataFrame) -> DataFrame:
    """Three words with their better bound cut: after one word, or after two if that is lower."""
    begin = pairs.select("lang", F.col("phrase").alias("__xy"), F.col("l").alias("f_x"), F.col("a").alias("f_xy"))
    end = pairs.select("lang", F.col("phrase").alias("__yz"), F.col("a").alias("f_yz"), F.col("r").alias("f_z"))
    cut = (
        _with_pairs(triples.withColumnRenamed("n", "a"))
        .join(begin, ["lang", "__xy"])
        .join(end, ["lang", "__yz"])
        .withColumns({"one": _scored("a", "f_x", "f_yz"), "two": _scored("a", "f_xy", "f_z")})
    )
    later = F.col("two") < F.col("one")
    return cut.select(
        "lang",
        "phrase",
        "a",
        F.when(later, F.col("f_xy")).otherwise(F.col("f_x")).alias("l"),
        F.when(later, F.col("f_z")).otherwise(F.col("f_yz")).alias("r"),
        F.least("one", "two").alias("score"),
    )


def _with_pairs(triples: DataFrame) -> DataFrame:
    return triples.withColumns(
        {
            "__xy": F.substring_index("phrase", " ", 2),
            "__yz": F.substring_index("phrase", " ", -2),
        }
    )


def _few(df: DataFrame, limit: int = LANGUAGES) -> DataFrame:
    """A small written table, broadcast if it is as small as it should be."""
    return F.broadcast(df) if df.limit(limit + 1).count() <= limit else df


def _ranked(df: DataFrame) -> DataFrame:
    """With ``rank`` in the order of each language, from 1."""
    placed = with_position(df, ["lang", -F.col("score"), -F.col("a"), "phrase"], "place")
    firsts = written(placed.groupBy("lang").agg(F.min("place").alias("first")), "phrase-firsts")
    return placed.join(_few(firsts), "lang").withColumn("rank", F.col("place") - F.col("first") + 1).drop("place", "first")


def _reaches(value: str, a: str = "a") -> Column:
    """Whether a score or bound and the count beside it reach the language's mark."""
    return (F.col(value) > F.col("mark")) | ((F.col(value) == F.col("mark")) & (F.col(a) >= F.col("mark_a")))


def mine(
    docs: DataFrame,
    top: int = TOP,
    least: int = LEAST,
    text_col: str = "text",
    lang_col: str = "lang",
    ahead: float = 1.5,
) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the first ``top`` phrases of each language.

    Texts are lower-cased (A to Z), cut into pieces at punctuation and line ends and those into
    words at blanks and tabs. Candidates occur ``least`` times or more. One that lies inside a
    longer candidate with at least half its count is dropped. Equal scores are ordered by count,
    then by the phrase's bytes, so ranks have no ties. A null text has no words; a null language
    counts as ``und``; rows that repeat count each time; a text of any length is counted whole. An
    empty table gives an empty result. Other columns, whatever their names, are not looked at.
    Runs jobs while the plan is built.

    ``ahead``: the first wave's mark is the pair at this multiple of ``top``; later waves, for
    languages not settled yet, go four times as far each.
    """
    counts = written(count_pairs(docs, least, text_col, lang_col), "phrase-counts")
    pairs = written(_score_pairs(counts), "phrase-pairs")
    order = written(_ranked(pairs.select("lang", "score", "a", "phrase")), "phrase-order")
    last = order.groupBy("lang").agg(F.max("rank").alias("last"))
    totals = counts.where("size = 0").select("lang", F.col("n").alias("words"))

    triples, before, reach = None, None, max(1, int(top * ahead))
    while True:
        at = order.join(_few(written(last, "phrase-lasts")), "lang")
        marks = at.where((F.col("rank") == reach) & (F.col("last") > reach))
        marks = marks.select("lang", F.col("score").alias("mark"), F.col("a").alias("mark_a"), F.lit(False).alias("whole"))
        rest = last.where(F.col("last") <= reach)  # nothing lies below: the whole frontier grows
        rest = rest.select("lang", F.lit(-1).cast("long").alias("mark"), F.lit(0).cast("long").alias("mark_a"), F.lit(True).alias("whole"))
        marks = marks.unionByName(rest)
        if before is not None:  # settled languages keep their mark
            settled = before.where("settled").select("lang", "mark", "mark_a", "whole")
            marks = marks.join(_few(settled.select("lang")), "lang", "left_anti").unionByName(settled)
        marks = _few(written(marks, "phrase-marks"))
        wave = pairs.join(marks, "lang").withColumns({"grows": _reaches("bound"), "drops": _reaches("score")})
        if before is not None:
            old = before.select("lang", F.col("mark").alias("old"), F.col("mark_a").alias("old_a"), "settled")
            passed = (F.col("bound") > F.col("old")) | ((F.col("bound") == F.col("old")) & (F.col("a") >= F.col("old_a")))
            judged = (F.col("score") > F.col("old")) | ((F.col("score") == F.col("old")) & (F.col("a") >= F.col("old_a")))
            wave = wave.join(_few(old), "lang").where("NOT settled")
            wave = wave.withColumns({"grows": F.col("grows") & ~passed, "drops": F.col("drops") & ~judged})
        frontier = written(wave.where("grows OR drops").select("lang", "x", "y", "grows", "drops"), "phrase-frontier")
        found = count_triples(docs, frontier, least, text_col, lang_col)
        if triples is not None:
            found = found.unionByName(triples).dropDuplicates(["lang", "phrase"])
        triples = written(found, "phrase-triples")
        survivors = written(_surviving(pairs, triples, marks), "phrase-survivors")
        kept = survivors.groupBy("lang").agg(F.count(F.lit(1)).alias("kept"))
        state = marks.join(kept, "lang", "left").withColumn("settled", F.col("whole") | (F.coalesce("kept", F.lit(0)) >= top))
        before = written(state.drop("kept"), "phrase-state")
        if not before.where("NOT settled").limit(1).count():
            break
        reach *= 4
    ranked = _ranked(survivors).where(F.col("rank") <= top)
    return ranked.join(_few(written(totals, "phrase-totals")), "lang").select(
        "lang", "rank", "phrase", "a", "l", "r", F.col("words").alias("n"), "score"
    )


def _surviving(pairs: DataFrame, triples: DataFrame, marks: DataFrame) -> DataFrame:
    """Pairs and triples at or above their language's mark, without those inside longer ones."""
    longer = _with_pairs(triples).select("lang", "n", F.explode(F.array("__xy", "__yz")).alias("phrase"))
    most = longer.groupBy("lang", "phrase").agg(F.max("n").alias("most"))
    two = (
        pairs.join(marks, "lang")
        .where(_reaches("score"))
        .join(most, ["lang", "phrase"], "left")
        .where(F.col("most").isNull() | (100 * F.col("most") < SHARE * F.col("a")))
    )
    three = _score_triples(triples, pairs).join(marks, "lang").where(_reaches("score"))
    columns = ["lang", "phrase", "a", "l", "r", "score"]
    return two.select(*columns).unionByName(three.select(*columns))

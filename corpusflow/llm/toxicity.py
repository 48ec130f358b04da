"""Toxicity by class-conditional Kneser-Ney models.

Two models, one of toxic and one of ordinary rows, share their backoff. Each gives a word's
probability after the word before it: it discounts its own counts of pairs and gives the mass
that frees to its word model, which discounts its own word counts and gives the mass it frees to
one shared distribution: in how many distinct neighbourhoods (words before) a word was seen, over
both classes. So what is rare in a class is judged by what both classes know of it. A text's
evidence is the difference of its two log-likelihoods divided by its length, by pairs and by
words alone; as a long text may be toxic in one passage only, its best stretches of
``STRETCHES`` words count as well. A logistic curve over all of them turns evidence into a score.

The counts come from every labelled training row. They are summed by Spark over pairs of
neighbouring words; keys are 64-bit hashes, and the grown model is a table of one row a word and
one a pair, of which a chunk of texts gets the rows that it asks for (``lookups.py``). Words are
counted in ``PARTS`` and texts are scored in ``WAVES``, one after another, by hashes of either, so that
only a part of what is shuffled lies on disk at a time. Only the table's totals reach the driver. The curve is fitted on a bounded sample, at most ``SAMPLE`` training rows of
each class (lowest id digests), each judged with its own words taken out of the counts.

Defined results: a text without words (null, empty) has no evidence and gets the score of no
evidence; without labels of both classes every score is the share of label 1 among them (0.0 if
there are none). Rows with a null id or label are not learned from; of several labels of an id
the largest counts. Repeated rows score alike; an empty table gives an empty result. Other
columns pass through; a result column replaces one of the same name.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusflow.llm.lang_id import sampled
from corpusflow.llm.lookups import BYTES_A_KEY, merged, sliced, with_values
from corpusflow.llm.rounds import SLICE_KEYS, slice_bits, text_bytes
from corpusflow.llm.storage import kept, leaving_no_shuffles, written
from corpusflow.llm.textarrays import lowered, utf8, word_hashes, words

COLUMNS = ["ordinary", "toxic", "before", "next_ordinary", "next_toxic", "kinds_ordinary", "kinds_toxic"]
STRETCHES = (4, 32)
SAMPLE = 3000
# Up to so many labels (some 100 MB as a hash table) go to the texts; beyond, both are shuffled.
BROADCAST_LABELS = 2_000_000
# Parts of the words that are counted, and of the texts that are scored, at a time.
PARTS, WAVES = 2, 4
_EMPTY_WORD = np.uint64(0x9E3779B97F4A7C15)  # stands before a text's first word
_TURN = 23  # bits by which the word before is turned in a pair's key
_ROWS = 512  # texts hashed at once

# Letters, digits and every byte of a character beyond ASCII make words; the rest separates.
_LETTERS = np.zeros(256, bool)
_LETTERS[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True


def numbered(texts: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Keys of the words of all texts in a row, and the index of each text's first."""
    keys, counts = [np.zeros(0, np.uint64)], [np.zeros(1, np.int64)]
    for at in range(0, len(texts), _ROWS):
        data, offsets = utf8(texts.slice(at, _ROWS))
        data = lowered(data)
        starts, ends, first = words(data, offsets, _LETTERS)
        keys.append(word_hashes(data, starts, ends))
        counts.append(np.diff(first))
    return np.concatenate(keys), np.cumsum(np.concatenate(counts))


def before_each(word: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The word before each word of its text."""
    prior = np.concatenate([[_EMPTY_WORD], word[:-1]]) if len(word) else word
    prior[first[:-1][np.diff(first) > 0]] = _EMPTY_WORD
    return prior


def pairs_of(word: np.ndarray, prior: np.ndarray) -> np.ndarray:
    """Keys of words after the words before them."""
    return word ^ (prior << np.uint64(_TURN) | prior >> np.uint64(64 - _TURN))


def distinct_keys(texts: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """The same keys as ``Words`` has, without their places."""
    word, first = numbered(texts)
    keys = np.sort(np.concatenate([word, pairs_of(word, before_each(word, first)), [_EMPTY_WORD]]))
    return keys[np.append(True, keys[1:] != keys[:-1])]


class Words:
    """Words, words before and pairs of all texts in a row, as indices of their distinct keys."""

    def __init__(self, texts: pa.Array | pa.ChunkedArray) -> None:
        word, self.first = numbered(texts)
        pair = pairs_of(word, before_each(word, self.first))
        self.keys, at = np.unique(np.concatenate([word, pair, [_EMPTY_WORD]]), return_inverse=True)
        self.word, self.pair = at[:-1].reshape(2, -1)
        # The words before are the same ones, so they need no search of their own.
        self.prior = np.append(at[-1], self.word[:-1]) if len(word) else self.word
        self.prior[self.first[:-1][np.diff(self.first) > 0]] = at[-1]


@dataclass
class Tally:
    """Of one count over all words: its sum, and how many words have it, at 1 and at 2."""

    total: float
    kinds: int
    once: int
    twice: int

    @classmethod
    def of(cls, c: np.ndarray) -> Tally:
        return cls(float(c.sum()), *(int(np.count_nonzero(x)) for x in (c, c == 1, c == 2)))

    @property
    def cut(self) -> float:
        return min(0.95, max(0.1, self.once / (self.once + 2 * self.twice))) if self.once else 0.5


@dataclass
class Totals:
    """What the whole table says about itself: all that the models need besides its rows."""

    size: int
    counts: list[Tally]  # ordinary, toxic
    before: Tally
    pairs: list[Tally] = field(default_factory=list)  # ordinary, toxic


@dataclass
class KneserNey:
    """Counts by word: of each class, and of distinct words before (both classes)."""

    counts: np.ndarray  # 2 x words: ordinary, toxic
    before: np.ndarray

    def prepare(self, totals: Totals | None = None) -> KneserNey:
        """Set up for these words, which are all there are unless ``totals`` are given."""
        if totals is None:
            totals = Totals(len(self.before), [Tally.of(c) for c in self.counts], Tally.of(self.before))
        before = totals.before
        total = max(1.0, before.total)
        even = before.cut * before.kinds / total if before.kinds else 1.0
        self.shared = np.maximum(self.before - before.cut, 0) / total + even / totals.size
        self.cuts = [t.cut for t in totals.counts]
        self.totals = [max(1.0, t.total) for t in totals.counts]
        self.kinds = [t.kinds for t in totals.counts]
        return self

    def log_probability(self, kind: int, word: np.ndarray, less: np.ndarray | int = 0) -> np.ndarray:
        """Of words in a class; ``less`` is what to leave out of the class's counts of them."""
        cut, total = self.cuts[kind], self.totals[kind]
        own = np.maximum(self.counts[kind][word] - less - cut, 0) / total
        return np.log(own + cut * self.kinds[kind] / total * self.shared[word] + 1e-300)


def after(n: np.ndarray, total: np.ndarray, kinds: np.ndarray, cut: float, alone: np.ndarray) -> np.ndarray:
    """Probability of words after a word that ``total`` words follow, of ``kinds`` kinds.

    ``n`` counts the pairs; what the discount ``cut`` frees goes out by the words' own probability.
    """
    found = (np.maximum(n - cut, 0) + cut * kinds * alone) / np.maximum(total, 1)
    return np.where(total > 0, found, alone)


def differences(
    text: Words, values: np.ndarray, totals: Totals, label: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """Toxic minus ordinary log-probability of every word, alone and after the word before it.

    ``values`` are the model's rows of the texts' keys. With the texts' labels given, each is
    judged with its own words and pairs taken out of its class's counts.
    """
    of = dict(zip(COLUMNS, values.T))
    counts = np.stack([of["ordinary"], of["toxic"]])
    follow = [(of["next_ordinary"], of["kinds_ordinary"]), (of["next_toxic"], of["kinds_toxic"])]
    model = KneserNey(counts, of["before"]).prepare(totals)
    alone, paired = [], []
    if label is not None:
        row = np.repeat(np.arange(len(label)), np.diff(text.first))
        mine, size = np.asarray(label, np.int64)[row], max(1, len(text.keys))
        own = {}
        for name in ("word", "prior", "pair"):
            _, at, back, n = np.unique(
                row * size + getattr(text, name), return_index=True, return_inverse=True, return_counts=True
            )
            own[name] = at, back, n
        at, _, n = own["pair"]
        gone = counts[mine[at], text.pair[at]] <= n  # pairs that only this text has in its class
        _, back, priors = own["prior"]
        lost = np.bincount(back[at], gone, len(priors))[back]
    for kind in (0, 1):
        less = [0, 0, 0, 0]
        if label is not None:
            less = [np.where(mine == kind, n[back], 0) for _, back, n in own.values()]
            less.append(np.where(mine == kind, lost, 0))
        log = model.log_probability(kind, text.word, less[0])
        total, kinds = (x[text.prior] - y for x, y in zip(follow[kind], (less[1], less[3])))
        n = counts[kind][text.pair] - less[2]
        alone.append(log)
        paired.append(np.log(after(n, total, kinds, totals.pairs[kind].cut, np.exp(log)) + 1e-300))
    return alone[1] - alone[0], paired[1] - paired[0]


def evidence(difference: np.ndarray, first: np.ndarray) -> np.ndarray:
    """For each text: the mean difference over its words, and over its best stretches."""
    total = np.concatenate([[0.0], np.cumsum(difference, dtype=np.float64)])
    length = np.diff(first)
    mean = (total[first[1:]] - total[first[:-1]]) / np.maximum(length, 1)
    found = [mean]
    for stretch in STRETCHES:
        best = mean.copy()
        longer = np.flatnonzero(length > stretch)
        if len(longer):
            runs = (total[stretch:] - total[:-stretch]) / stretch
            # Each text's runs lie between its first word and its last full run.
            edges = np.column_stack([first[longer], first[longer + 1] - stretch + 1]).ravel()
            best[longer] = np.maximum.reduceat(np.append(runs, -np.inf), edges)[::2]
        found.append(best)
    return np.column_stack(found)


def features(text: Words, values: np.ndarray, totals: Totals, label: np.ndarray | None = None) -> np.ndarray:
    """Each text's evidence, and its length: longer texts have better best stretches."""
    found = [evidence(d, text.first) for d in differences(text, values, totals, label)]
    return np.column_stack([*found, np.log1p(np.diff(text.first))])


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-3) -> np.ndarray:
    """Weighted logistic regression by Newton steps; the last coefficient is the bias."""
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (weight * (y - p)) - ridge * w
        curve = (x * (weight * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(curve, slope)
        w += step
        if np.abs(step).max() < 1e-9:
            break
    return w


@dataclass
class ToxicityModel:
    table: DataFrame | None  # words and pairs in slices; without both classes there is none
    totals: Totals | None
    curve: np.ndarray
    bits: int = 0  # which name a slice

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(x @ self.curve[:-1] + self.curve[-1], -30, 30)))


def _labelled(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str) -> DataFrame:
    few = labels.limit(BROADCAST_LABELS + 1).count() <= BROADCAST_LABELS
    marks = (
        labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
        .groupBy(F.col(id_col).alias("id"))
        .agg(F.max((F.col(label_col) == 1).cast("int")).alias("label"))
    )
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return texts.join(F.broadcast(marks) if few else marks, "id")


def count_words(labelled: DataFrame, part: int | None = None) -> DataFrame:
    """``key`` of a word or pair and its ``COLUMNS``, which are numbers of

    its ordinary and toxic occurrences, the distinct words before it, the words after it in
    ordinary and in toxic rows, and the distinct ones among them. A pair has the first two only.
    Tasks sum pairs within each batch before the shuffle. ``part`` counts one of ``PARTS`` of the
    words with the words before them, so parts share keys: what follows a word is summed over all.
    """

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            label = batch.column("label").to_numpy(zero_copy_only=False).astype(bool)
            word, first = numbered(batch.column("text"))
            length = np.diff(first)
            prior = before_each(word, first)
            toxic = np.repeat(label, length)
            if part is not None:
                mine = word % np.uint64(PARTS) == part
                word, prior, toxic = word[mine], prior[mine], toxic[mine]
            order = np.lexsort((prior, word))
            word, prior, toxic = word[order], prior[order], toxic[order]
            new = (np.diff(word) != 0) | (np.diff(prior) != 0)
            at = np.flatnonzero(np.append(True, new)) if len(word) else np.zeros(0, np.int64)
            n = np.diff(np.append(at, len(word)))
            bad = np.add.reduceat(toxic, at, dtype=np.int64) if len(at) else n
            yield pa.RecordBatch.from_arrays(
                [pa.array(x) for x in (word[at].view(np.int64), prior[at].view(np.int64), n - bad, bad)],
                names=["word", "prior", "ordinary", "toxic"],
            )

    counts = (
        labelled.select("label", "text")
        .mapInArrow(pairs, "word long, prior long, ordinary long, toxic long")
        .groupBy("word", "prior")
        .agg(F.sum("ordinary").alias("ordinary"), F.sum("toxic").alias("toxic"))
    )
    none = F.lit(0).cast("long")
    turned = F.shiftleft("prior", _TURN).bitwiseOR(F.shiftrightunsigned("prior", 64 - _TURN))
    both = counts.select(F.col("word").bitwiseXOR(turned).alias("key"), "ordinary", "toxic")
    seen = [(F.col(c) > 0).cast("long") for c in ("ordinary", "toxic")]
    as_word = [F.col("word"), F.col("ordinary"), F.col("toxic"), F.lit(1).cast("long"), *[none] * 4]
    as_prior = [F.col("prior"), *[none] * 3, F.col("ordinary"), F.col("toxic"), *seen]
    rows = [
        F.struct(*[x.alias(c) for x, c in zip(values, ["key", *COLUMNS])]) for values in (as_word, as_prior)
    ]
    alone = counts.select(F.inline(F.array(*rows))).groupBy("key").agg(*[F.sum(c).alias(c) for c in COLUMNS])
    return both.select("key", "ordinary", "toxic", *[none.alias(c) for c in COLUMNS[2:]]).unionByName(alone)


def _tallied(values: np.ndarray) -> list[int]:
    """Of a slice: its words, the tallies of their first three columns, and of its pairs' first two."""
    words = values[:, 2] > 0
    pairs = ~words & (values[:, 3:5].sum(axis=1) == 0)
    found = [int(np.count_nonzero(words))]
    for of, columns in ((words, 3), (pairs, 2)):
        for c in values[of, :columns].T:
            found += [int(c.sum()), *(int(np.count_nonzero(x)) for x in (c, c == 1, c == 2))]
    return found


def _model_table(labelled: DataFrame, bits: int) -> tuple[DataFrame, Totals]:
    """The counts in slices, and their totals."""
    parts = [kept(sliced(count_words(labelled, p), bits), "toxicity-parts") for p in range(PARTS)]
    told = [f"t{i}" for i in range(21)]
    rows = reduce(DataFrame.unionByName, [df for df, _ in parts])
    table = written(merged(rows, _tallied, told), "toxicity-counts")
    for _, name in parts:
        labelled.sparkSession.sql(f"DROP TABLE {name}")
    size, *sums = table.agg(*[F.coalesce(F.sum(c), F.lit(0)) for c in told]).first()
    ordinary, toxic, before, *pairs = [Tally(*sums[i : i + 4]) for i in range(0, 20, 4)]
    return table, Totals(size + 1, [ordinary, toxic], before, pairs)  # and a word never seen


def _keys(text_col: str) -> Callable[[pa.Table], np.ndarray]:
    return lambda rows: distinct_keys(rows.column(text_col))


def train(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
) -> ToxicityModel:
    """Learn from the documents that have a label; the caller leaves out held-out rows."""
    labelled = _labelled(docs, labels, id_col, text_col, label_col)
    share = {r.label: r["count"] for r in labelled.groupBy("label").count().collect()}
    total = sum(share.values())
    if len(share) < 2:
        rate = share.get(1, 0) / total if total else 0.0
        bias = np.log(max(rate, 1e-13) / max(1 - rate, 1e-13))
        return ToxicityModel(None, None, np.array([bias]))
    bits = slice_bits(text_bytes(docs, text_col) // BYTES_A_KEY)
    table, totals = _model_table(labelled, bits)
    sample = sampled(labelled, SAMPLE)

    def judge(rows: pa.Table, values: np.ndarray) -> pa.Table:
        label = rows.column("label").to_numpy()
        x = features(Words(rows.column("text")), values, totals, label)
        return pa.table({"label": pa.array(label, pa.int32()), "x": pa.array(list(x), pa.list_(pa.float64()))})

    found = with_values(
        sample.select("label", "text"),
        "text",
        table,
        len(COLUMNS),
        bits,
        _keys("text"),
        judge,
        "label int, x array<double>",
    )
    with leaving_no_shuffles(docs.sparkSession):
        seen = found.collect()
    seen.sort(key=lambda r: (r.label, r.x))
    y = np.array([r.label for r in seen], float)
    weight = np.where(y == 1, share[1] / total / y.sum(), share[0] / total / (1 - y).sum()) * len(y)
    return ToxicityModel(table, totals, logistic(np.array([r.x for r in seen]), y, weight), bits)


def score(
    docs: DataFrame,
    model: ToxicityModel,
    text_col: str = "text",
    threshold: float = 0.3,
    keep_text: bool = True,
) -> DataFrame:
    """Add ``score`` and ``predicted`` to every row; whole texts, shuffled once in packed chunks.

    The texts go wave by wave, each one's rows being written before the next; by a hash of the text
    alone, which is the same whenever the rows are read.
    """
    fields = [f for f in docs.schema.fields if f.name not in {"score", "predicted"}]
    names = [f.name for f in fields]
    fields = [f for f in fields if keep_text or f.name != text_col]
    schema = T.StructType([*fields, T.StructField("score", T.DoubleType())])
    if model.table is None:
        found = docs.select(*[f.name for f in fields]).withColumn("score", F.lit(float(model.score(np.zeros((1, 0)))[0])))
        return found.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
    totals, curve = model.totals, ToxicityModel(None, None, model.curve)  # no table goes to the tasks

    def run(rows: pa.Table, values: np.ndarray) -> pa.Table:
        made = curve.score(features(Words(rows.column(text_col)), values, totals))
        rows = rows.select([f.name for f in fields])
        return rows.append_column("score", pa.array(made, pa.float64()))

    asked = text_bytes(docs, text_col) // BYTES_A_KEY
    waves = max(WAVES, -(-asked // (SLICE_KEYS << model.bits)))
    done = []
    for wave in range(waves):
        some = docs.select(*names).where(F.pmod(F.xxhash64(text_col), F.lit(waves)) == wave)
        scored = with_values(
            some, text_col, model.table, len(COLUMNS), model.bits, _keys(text_col), run, schema
        )
        done.append(written(scored, "toxicity-scores"))
    found = reduce(DataFrame.unionByName, done)
    return found.withColumn("predicted", (F.col("score") >= threshold).cast("int"))

"""Deduplication, joins, mixing and encoding against brute force on small tables."""

import hashlib
import itertools
import random
import re
import time
import tracemalloc
from collections import Counter
from pathlib import Path

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F

from corpusflow.llm import bpe, byte_spans, lang_id, line_join, mixing, set_join, suffixes, textarrays
from corpusflow.llm.byte_spans import remove_repeats
from corpusflow.llm.components import components
from corpusflow.llm.line_join import remove_lines
from corpusflow.llm.rounds import ask, chunked
from corpusflow.llm.set_join import link_classes
from corpusflow.llm.storage import written
from corpusflow.llm.substrings import deduplicate
from corpusflow.llm.textarrays import kept_things

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
SPLIT = re.compile(r"[^\x20\x09-\x0D]+")


def sentence(random_, n, words=400):
    return " ".join(f"w{random_.randrange(words)}" for _ in range(n))


@pytest.fixture(scope="module")
def texts():
    """Copies, near copies, shared passages, short, blank, long and odd texts."""
    r = random.Random(4)
    passage = sentence(r, 60, 10_000)
    base = [sentence(r, r.randrange(1, 200), 3000) for _ in range(25)]
    out = [None, "", "  \n\t ", "one", "One", "a b c", "Ünïcode ñandú wörter 漢字 \x1c x", "\n\n"]
    out += base + base[:6] + [passage + " " + b for b in base[10:15]]
    for b in base[:8]:
        words = b.split()
        if len(words) > 20:
            words[r.randrange(len(words))] = "edited"
            out.append(" ".join(words))
    out += ["the line that all have of nine words\n" + sentence(r, 30) for _ in range(6)]
    out += ["the line that all have of ten words now\n" + sentence(r, 5), "ab " * 300, "x" * 5000]
    out.append(sentence(r, 30_000, 500))
    return out


@pytest.fixture(scope="module")
def docs(spark, texts):
    """With nulls, and columns named like those the operators use inside."""
    rows = [(i * 3 + 1, t, None if i % 5 == 0 else f"s{i % 3}", i) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, n long")
    clash = {c: F.lit("x") for c in ("id", "chunk", "key", "place", "words", "size", "label", "set")}
    return df.withColumns({**clash, "ids": F.lit(None).cast("string")}).repartition(3)


@pytest.fixture(scope="module")
def no_docs(docs):
    return docs.where("false")


def words_of(text):
    return SPLIT.findall(text or "")


def rows_by_id(df):
    return {r.doc_id: r for r in df.collect()}


def test_substrings_match_brute_force(docs, texts):
    got = rows_by_id(deduplicate(docs, size=13))
    first = {}
    for i, t in enumerate(texts):
        w = words_of(t)
        for k in range(len(w) - 12):
            first.setdefault(tuple(w[k : k + 13]), i)
    for i, t in enumerate(texts):
        w = words_of(t)
        gone = [False] * len(w)
        for k in range(len(w) - 12):
            if first[tuple(w[k : k + 13])] < i:
                gone[k : k + 13] = [True] * 13
        row = got[i * 3 + 1]
        assert (row.n_words, row.n_removed) == (len(w), sum(gone))
        assert row.kept_text == " ".join(x for x, g in zip(w, gone) if not g)


def test_substrings_with_null_and_repeated_ids(spark):
    text = " ".join(f"a{i}" for i in range(20))
    df = spark.createDataFrame([(None, text), (1, text), (1, text), (2, text)], "doc_id long, text string")
    rows = sorted(((r.doc_id is None, r.doc_id, r.n_removed) for r in deduplicate(df).collect()), key=str)
    assert rows == [(False, 1, 0), (False, 1, 0), (False, 2, 20), (True, None, 20)]


def cut_repeats(texts, length):
    data = [(t or "").encode() for t in texts]
    count = Counter(x[i : i + length] for x in data for i in range(len(x) - length + 1))
    for x in data:
        gone = [False] * len(x)
        for i in range(len(x) - length + 1):
            if count[x[i : i + length]] > 1:
                gone[i : i + length] = [True] * length
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        yield len(x), sum(gone), spans, bytes(b for b, g in zip(x, gone) if not g)


@pytest.mark.parametrize("most", [4096, 1])
def test_byte_spans_match_brute_force(docs, texts, monkeypatch, most):
    monkeypatch.setattr(byte_spans, "MOST_CONTEXTS", most)
    got = rows_by_id(remove_repeats(docs, length=200))
    for i, expected in enumerate(cut_repeats(texts, 200)):
        row = got[i * 3 + 1]
        assert (row.n_bytes, row.n_removed, row.n_spans, bytes(row.kept)) == expected


def test_repeats_of_suffixes():
    r = random.Random(2)
    for _ in range(30):
        depth = r.choice([9, 12, 20])
        base = bytes(r.choices(b"abc", k=200))
        found = []
        for _ in range(r.randrange(1, 12)):
            a = r.randrange(150)
            found.append(base[a : a + r.randrange(depth, 60)] + bytes(r.choices(b"ab", k=9)))
        weights = [r.choice([1, 1, 2]) for _ in found]
        count = Counter()
        for t, w in zip(found, weights):
            for i in range(len(t) - depth + 1):
                count[t[i : i + depth]] += w
        for t, marks in zip(found, suffixes.repeats(found, weights, depth)):
            expected = [count[t[i : i + depth]] > 1 for i in range(len(t) - depth + 1)]
            assert marks.tolist() == expected


def shingle_set(text):
    w = [re.sub("[A-Z]", lambda m: m[0].lower(), x) for x in words_of(text)]
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def roots(n, links):
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    return [find(i) for i in range(n)]


def test_set_join_matches_brute_force(docs, texts):
    sets = [shingle_set(t) for t in texts]
    links = [
        (a, b)
        for a, b in itertools.combinations(range(len(sets)), 2)
        if sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])
    ]
    got = rows_by_id(link_classes(docs))
    for i, root in enumerate(roots(len(sets), links)):
        row = got[i * 3 + 1]
        assert (row.n_shingles, row.component_id) == (len(sets[i]), root * 3 + 1)


def test_set_join_chain_of_near_copies(spark):
    """Each links to the next only; blocks and rounds must not lose the chain."""
    words = [f"w{i}" for i in range(200)]
    texts = []
    for i in range(30):
        texts.append(" ".join(words[i * 4 : i * 4 + 60]))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r.component_id for r in link_classes(df).collect()} == {0}


def test_components_of_random_edges(spark):
    r = random.Random(8)
    edges = [(r.randrange(200), r.randrange(200)) for _ in range(110)]
    got = dict(map(tuple, components(spark.createDataFrame(edges, "a long, b long")).collect()))
    expected = roots(200, edges)
    assert got == {n: expected[n] for e in edges for n in e if e[0] != e[1]} | {
        n: expected[n] for n in got
    }


def gone_lines(texts):
    sets, gone = [], set()
    for i, t in enumerate(texts):
        for j, line in enumerate((t or "").split("\n")):
            w = set(words_of(line))
            if w and any(4 * len(w & o) >= 3 * len(w | o) for o in sets):
                gone.add((i, j))
            if w:
                sets.append(w)
    return gone


def test_line_join_matches_brute_force(docs, texts):
    gone = gone_lines(texts)
    got = rows_by_id(remove_lines(docs))
    for i, t in enumerate(texts):
        row = got[i * 3 + 1]
        if t is None:
            assert (row.n_lines, row.n_removed, row.text) == (0, 0, None)
            continue
        kept = [x for j, x in enumerate(t.split("\n")) if (i, j) not in gone]
        assert (row.n_removed, row.text) == (len(t.split("\n")) - len(kept), "\n".join(kept))


def test_line_join_of_a_large_group(spark):
    """Near copies beyond the compared neighbours still meet in the full join."""
    r = random.Random(3)
    base = [f"w{i}" for i in range(20)]
    lines = []
    for _ in range(80):
        w = list(base)
        for k in r.sample(range(20), 2):
            w[k] = f"x{r.randrange(1000)}"
        lines.append(" ".join(w))
    df = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")
    got = {r.doc_id for r in remove_lines(df).collect() if r.n_removed}
    assert got == {i for i, _ in gone_lines(lines)}


def test_line_join_keeps_no_lone_posts(spark):
    lines = [" ".join(f"w{i}x{j}" for j in range(20)) for i in range(50)]
    texts = spark.createDataFrame(list(enumerate([*lines, lines[0] + " more"])), "doc long, text string")
    posts = line_join._posts(line_join._lines(texts), [0] * line_join.BUCKETS, 75)
    kept = line_join._with_near(posts, 75)
    assert posts.count() == 51 * 6
    assert {r.doc for r in kept.select("doc").distinct().collect()} == {0, 50}


def test_line_join_compares_few_whole_sets(spark, monkeypatch):
    r = random.Random(4)
    word = [f"w{i}" for i in range(200)]
    lines = []
    for i in range(60):
        w = list(word[:60])
        for j in r.sample(range(60), 3):
            w[j] = f"own{i}x{j}"
        lines.append(" ".join(w))
    df = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")
    compared = []
    join = line_join._alike
    monkeypatch.setattr(line_join, "_alike", lambda pairs, *a: compared.append(pairs.count()) or join(pairs, *a))
    got = {row.doc_id for row in remove_lines(df).collect() if row.n_removed}
    assert got == {i for i, _ in gone_lines(lines)}
    assert len(got) == 59 and sum(compared) <= 60


def test_line_join_compares_few_long_lines(spark, monkeypatch):
    """Long lines that share a few words only do not become pairs; near copies of them do."""
    r = random.Random(5)
    lines = []
    for i in range(40):
        own = [f"w{i}x{j}" for j in range(330 if i % 2 else 170)]
        lines.append(own + [f"all{j}" for j in range(8)])
    for i in (3, 10):
        near = list(lines[i])
        for j in r.sample(range(len(near)), len(near) // 10):
            near[j] = f"new{i}x{j}"
        lines.append(near)
    lines = [" ".join(words) for words in lines]
    df = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")
    met = []
    verify = line_join._verified
    monkeypatch.setattr(line_join, "_verified", lambda pairs, *a: met.append(pairs.count()) or verify(pairs, *a))
    # One rarity for all words: those that all lines share are posted too.
    monkeypatch.setattr(line_join, "rarity", lambda texts: [0] * line_join.BUCKETS)
    got = {row.doc_id for row in remove_lines(df).collect() if row.n_removed}
    assert got == {i for i, _ in gone_lines(lines)} == {40, 41}
    assert sum(met) <= 4


def test_other_operators_let_the_encoder_go():
    """A worker's memo does not stay beside the memory of the stages after it."""

    class Chunks:
        def groupBy(self, *_):
            return self

        def applyInArrow(self, function, schema):
            return function

    content = Path(PATH).read_bytes()
    bpe._held(("job",), lambda: bpe.Encoder(content, public_tokenizers.PATTERN, ("ids",)))
    assert kept_things()
    ask(Chunks(), lambda chunk, known: iter([]))(pa.table({"chunk": [0]}))
    assert not kept_things()


def test_encoder_begins_with_freed_memory_given_back(monkeypatch):
    """What earlier operators' tasks freed goes back once, before the vocabulary is read."""
    kept_things().clear()
    given = []
    monkeypatch.setattr(bpe, "trimmed", lambda: given.append(len(kept_things())))
    for job in ("one", "one", "two"):
        bpe._held((job,), lambda: object())
    assert given == [0, 0]
    kept_things().clear()
    textarrays.trimmed()


def test_sets_of_a_chunk_need_little_memory():
    """Texts are cut into shingles some after others; the sets are those of each text alone."""
    r = random.Random(7)
    texts = [sentence(r, r.randrange(0, 9000), 5000) for _ in range(150)] + [None, "", "one"]
    chunk = pa.table({"text": pa.array(texts, pa.string())})
    tracemalloc.start()
    _, value, first = set_join._sets(chunk, 5)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    for i in (0, 77, 149, 150, 151, 152):
        assert value[first[i] : first[i + 1]].tolist() == set_join._sets(chunk.slice(i, 1), 5)[1].tolist()
    assert peak < 15 * chunk.nbytes


@pytest.mark.parametrize("most", [1000, 2**22])
def test_pairs_of_ranks_are_sorted(most):
    r = random.Random(8)
    pairs = [(r.randrange(40), r.choice([r.randrange(5), most])) for _ in range(1000)]
    first, second = (np.array(x, np.uint64) for x in zip(*pairs))
    got, inner = suffixes._sorted_pairs(first, second, most)
    assert [pairs[i] for i in inner] == sorted(pairs)
    assert [(int(x) >> most.bit_length(), int(x) % 2 ** most.bit_length()) for x in got] == sorted(pairs)


def test_long_arrays_are_mixed_and_hashed_in_blocks():
    """Blocks that end anywhere give what one step over the whole gives, with less memory."""
    data = np.random.default_rng(1).integers(0, 250, 5 * textarrays.BLOCK // 2, dtype=np.uint8)
    span = textarrays.span_hashes(data)
    begin, end = np.array([0, 7, textarrays.BLOCK - 9]), np.array([90, 97, textarrays.BLOCK + 81])
    alone = [textarrays.span_hashes(data[a:b])(np.array([0]), np.array([b - a]), 1)[0] for a, b in zip(begin, end)]
    assert span(begin, end, 1).tolist() == alone
    hashes = span(slice(0, len(data) - 99), slice(100, len(data) + 1), 0)
    tracemalloc.start()
    best = byte_spans._window_argmin(hashes, 101)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    high = hashes >> np.uint64(32)
    some = [0, 5, textarrays.BLOCK - 50, textarrays.BLOCK, 2 * textarrays.BLOCK - 1, len(best) - 1]
    assert [best[i] for i in some] == [i + int(high[i : i + 101].argmin()) for i in some]
    assert len(best) == len(hashes) - 100 and peak < 2.5 * hashes.nbytes


def test_line_join_drops_posts_that_have_met(spark):
    """A word with few posts needs no second join; one with many keeps them all."""
    rows = [(i, " ".join(f"own{i}x{j}" for j in range(7)) + " few" * (i < 3) + " many") for i in range(12)]
    texts = spark.createDataFrame(rows, "doc long, text string")
    near = line_join._with_near(line_join._posts(line_join._lines(texts), [0] * line_join.BUCKETS, 1), 75)
    posts = sorted((r.many, r.later) for r in near.collect())
    assert posts == [(False, False)] * 3 + [(True, False)] * 6 + [(True, True)] * 6


def test_line_join_works_words_out_once(spark):
    """Spark's filter on what is exploded does not repeat the steps that make it."""
    texts = spark.createDataFrame([(0, "a b c d e")], "doc long, text string")
    plan = line_join._posts(line_join._lines(texts), [0] * line_join.BUCKETS, 75)
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("split(line") == 1


def test_line_join_shuffles_posts_in_parts(spark, monkeypatch):
    """No shuffle holds more than a part of the posts, and lines alike by any word are found."""
    lines = [" ".join(f"w{i // 2}x{j}" for j in range(20)) + f" own{i}" for i in range(80)]
    df = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")
    parts = []
    keep = line_join.bucketed
    monkeypatch.setattr(line_join, "bucketed", lambda df, *a: parts.append(df.count()) or keep(df, *a))
    got = {r.doc_id for r in remove_lines(df).collect() if r.n_removed}
    assert got == {i for i, _ in gone_lines(lines)} == set(range(1, 80, 2))
    assert len(parts) > 1 and max(parts) < sum(parts) / 2


def test_line_join_of_equal_words_in_other_strings(spark):
    """Only equal strings are settled by their hashes; equal sets of words meet as posts do."""
    lines = ["b a", "a b", "a\tb ", "one", " one", "one\r", "one two", "", " "]
    df = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")
    got = {r.doc_id for r in remove_lines(df).collect() if r.n_removed}
    assert got == {i for i, _ in gone_lines(lines)} == {1, 2, 4, 5}


def test_line_join_ranks_words_by_all_occurrences(spark):
    """The table of rarity stays in Spark: a number for each bucket, of all words of all texts."""
    texts = ["often " * 40 + "twice\trare\nseldom", "twice seldom\n often", None, ""]
    table = line_join.rarity(spark.createDataFrame(list(enumerate(texts)), "doc long, text string"))
    (row,) = table.collect()
    place = f"cast(xxhash64(w) & {line_join.BUCKETS - 1} as int)"
    words = spark.createDataFrame([(w,) for w in ("often", "twice", "seldom", "rare", "none")], "w string")
    at = dict(words.selectExpr("w", place).collect())
    assert len(row.rare) == line_join.BUCKETS
    assert {w: row.rare[i] for w, i in at.items()} == {"often": 16, "twice": 4, "seldom": 4, "rare": 3, "none": 0}


def test_line_join_of_crowded_words(spark, monkeypatch):
    """Only crowded words go through windows; settled lines of theirs do not meet each other."""
    r = random.Random(9)
    base = [f"w{i}" for i in range(20)]
    lines = [" ".join(f"own{i // 2}x{j}" for j in range(9 + i % 2)) for i in range(40)]
    for _ in range(120):
        w = list(base)
        for k in r.sample(range(20), r.randrange(3)):
            w[k] = f"x{r.randrange(9)}"
        lines.append(" ".join(w))
    df = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")
    windows, met = [], []
    near, join = line_join._with_near, line_join._joined
    monkeypatch.setattr(line_join, "_CROWDED", 15 << 40)  # 32 occurrences
    monkeypatch.setattr(line_join, "_with_near", lambda posts, p: windows.append(posts) or near(posts, p))
    monkeypatch.setattr(line_join, "_joined", lambda *a: met.append(join(*a).localCheckpoint()) or met[-1])
    got = {row.doc_id for row in remove_lines(df).collect() if row.n_removed}
    assert got == {i for i, _ in gone_lines(lines)}
    assert len(got) > 100 and len(windows) == 1 and len(met) == 4
    # Without settled lines left out, then words that are not crowded, and open with all crowded posts.
    assert sum(pairs.count() for pairs in met[1:]) < met[0].count() / 2


def test_line_join_stays_native(docs):
    plan = remove_lines(docs)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


def brute_sainte_lague(weights, seats, most):
    out = [0] * len(weights)
    for _ in range(seats):
        free = [i for i in range(len(out)) if out[i] < most[i] and weights[i] > 0]
        if not free:
            break
        best = max(free, key=lambda i: (weights[i] / (2 * out[i] + 1), -i))
        out[best] += 1
    return out


def test_sainte_lague_matches_highest_quotients():
    r = random.Random(6)
    for _ in range(200):
        n = r.randrange(1, 7)
        weights = [r.choice([0, 1, 2, 3, r.random() * 50]) for _ in range(n)]
        most = [r.randrange(0, 30) for _ in range(n)]
        seats = r.randrange(0, 60)
        assert mixing.sainte_lague(weights, seats, most).tolist() == brute_sainte_lague(
            weights, seats, most
        )


def test_mix_meets_its_targets(docs, texts):
    rows = mixing.mix(docs.select("doc_id", "text", "source", "size"), block_words=8).collect()
    assert len(rows) == len(texts)
    sizes, taken, target = Counter(), Counter(), {}
    for r in rows:
        size = len(words_of(r.text))
        assert r.size == size and r.taken <= 2 * size
        spans = [(x["begin"], x["end"]) for x in r.ranges]
        assert all(0 <= a < b <= size for a, b in spans) and spans == sorted(spans)
        assert r.taken == r.copies * size + sum(b - a for a, b in spans)
        sizes[r.source] += size
        taken[r.source] += r.taken
        target[r.source] = (r.target, r.source_size)
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    wanted = mixing.targets([sizes[s] for s in names], [3, 1, 2, 3][: len(names)])
    for name, want in zip(names, wanted):
        assert target[name] == (pytest.approx(want), sizes[name])
        assert abs(taken[name] - want) <= 16 and want <= 2 * sizes[name] + 1e-9


def test_mix_repeats_itself(docs):
    once = {(r.doc_id, r.taken) for r in mixing.mix(docs).collect()}
    assert once == {(r.doc_id, r.taken) for r in mixing.mix(docs.repartition(7)).collect()}


@pytest.fixture(scope="module")
def reference_encoding():
    with open(PATH, "rb") as file:
        ranks = bpe.Vocabulary(file.read()).ranks
    return tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )


def test_encode_and_decode(docs, texts, reference_encoding):
    coded = bpe.encode(docs, PATH, public_tokenizers.PATTERN, keep_text=True)
    assert coded.columns.count("ids") == 1
    back = bpe.decode(coded, PATH)
    for r in back.collect():
        assert r.ids == reference_encoding.encode_ordinary(r.text or "")
        assert r.n_tokens == len(r.ids) and bytes(r.decoded) == (r.text or "").encode()


def test_encoding_of_random_text(reference_encoding):
    r = random.Random(1)
    letters = "aeinrst ' 12,.\n\téü中\U0001f600\x1c "
    texts = ["".join(r.choices(letters, k=r.randrange(40))) for _ in range(400)]
    with open(PATH, "rb") as file:
        encoder = bpe.Encoder(file.read(), public_tokenizers.PATTERN, ("ids",))
    assert encoder.encode(texts)[0] == [reference_encoding.encode_ordinary(t) for t in texts]


def test_encoder_keeps_only_pieces_that_come_again(reference_encoding):
    with open(PATH, "rb") as file:
        encoder = bpe.Encoder(file.read(), public_tokenizers.PATTERN, ("ids", "n_tokens", "ids_text", "decoded"))
    often = "a phrase that every batch has"
    for i in range(3):
        texts = [f"{often} {''.join(random.Random(i * 500 + j).choices('bcdfg', k=9))}" for j in range(500)]
        ids, sizes, listed, decoded = encoder.encode(texts)
        assert ids == [reference_encoding.encode_ordinary(t) for t in texts]
        assert sizes == list(map(len, ids)) and decoded == [t.encode() for t in texts]
        assert listed == [",".join(map(str, x)) for x in ids]
    assert {" phrase", " every", " batch"} <= encoder.memo.keys() and len(encoder.memo) < 50
    assert all(isinstance(x, bytes) for x in encoder.memo.values())


def test_written_rows_leave_no_shuffle_files(spark, tmp_path):
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, blocks = spark.conf.get(key, None), spark.sparkContext._jsc.sc().env().blockManager()
    made = written(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count(), "counts")
    assert made.count() == 7 and spark.conf.get(key, None) == before
    # What is left belongs to queries that did not write.
    folder = Path(blocks.diskBlockManager().localDirs()[0].getPath())
    old = {f.name for f in folder.rglob("shuffle_*")}
    written(spark.range(1000).repartition(5, "id").groupBy((F.col("id") % 9).alias("k")).count(), "counts")
    time.sleep(1)
    assert not {f.name for f in folder.rglob("shuffle_*")} - old


def test_prefix_encoding_appends_and_edits():
    with open(PATH, "rb") as file:
        vocabulary = bpe.Vocabulary(file.read())
    r = random.Random(5)
    data = b"the encoding of a growing text " * 20
    live = bpe.PrefixEncoding(vocabulary, data)
    for _ in range(60):
        a = r.randrange(len(data))
        b = min(len(data), a + r.randrange(12))
        new = bytes(r.choices(b"etaoin shr", k=r.randrange(10)))
        live.replace(a, b, new)
        live.append(b"ing")
        data = data[:a] + new + data[b:] + b"ing"
        assert live.data == data and live.ids() == bpe.PrefixEncoding(vocabulary, data).ids()


def test_empty_tables(no_docs):
    assert deduplicate(no_docs).count() == 0
    assert remove_repeats(no_docs).count() == 0
    assert link_classes(no_docs).count() == 0
    assert remove_lines(no_docs).count() == 0
    assert mixing.mix(no_docs).count() == 0
    assert bpe.encode(no_docs, PATH, public_tokenizers.PATTERN).count() == 0


def test_digests_agree_with_the_query(spark):
    from corpusflow.llm.queries import QUERIES

    sf_dir = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    for r in QUERIES["op7_byte_bpe"](spark, sf_dir).collect():
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def test_small_source_of_a_large_table_meets_its_target(spark):
    rows = [(i, "w " * 40, "big") for i in range(9900)] + [(i, "w " * 30, "small") for i in range(9900, 10_000)]
    rows += [(i, None, "small") for i in range(10_000, 10_200)] + [(10_200, "", "none")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    mixed = mixing.mix(docs, weights=(99, 0.5, 0.75), shard_docs=100)
    found = mixed.groupBy("source").agg(F.count("*"), F.sum("taken"), F.max("target")).collect()
    assert {r[0]: r[1] for r in found} == {"big": 9900, "none": 1, "small": 300}
    for source, _, taken, target in found:
        # Every shard of "big" may end in a partial block; "small" has one shard with words.
        assert abs(taken - target) <= (64 if source != "big" else 0.01 * target)
    assert {r[0]: r[3] for r in found}["small"] == pytest.approx(1.5 * 3000, rel=0.05)


def test_chunks_spread_rows_without_or_with_one_id(spark):
    rows = [(None, f"text {i}") for i in range(300)] + [(7, f"more {i}") for i in range(300)]
    rows += [(None, "same")] * 400
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    got = chunked(df, 100_000, chunk_bytes=1_000).collect()
    most = lambda f: max(Counter(r.chunk for r in got if f(r)).values())
    assert len(got) == 1000
    assert most(lambda r: r.text.startswith("text")) < 20 and most(lambda r: r.id == 7) < 20
    assert most(lambda r: r.text == "same") < 200


def test_anchors_spread_evenly_over_slices(texts):
    """Anchors are least hashes, but no slice gets much more than its share of contexts."""
    import numpy as np
    import pyarrow as pa

    chunk = pa.table({"text": pa.array(texts * 3, pa.string())})
    anchors = byte_spans._Contexts(chunk, 200, 100).distinct["anchor"]
    top = (anchors >> np.uint64(60)).astype(int)
    assert len(anchors) > 1000 and np.bincount(top, minlength=16).max() < 2 * len(anchors) / 16


def test_columns_named_like_inner_ones_stay(spark):
    rows = [(i, "a", f"one two three {i}\nfour five", i) for i in range(3)]
    table = spark.createDataFrame(rows, "doc_id long, source string, text string, value long")
    mixed = mixing.mix(table.withColumnRenamed("value", "_mix_size"))
    assert sorted(r._mix_size for r in mixed.collect()) == [0, 1, 2]
    cut = remove_lines(table.withColumnRenamed("value", "_line_doc"))
    assert sorted((r._line_doc, r.n_removed) for r in cut.collect()) == [(0, 0), (1, 1), (2, 1)]
    model = lang_id.train(table.withColumnRenamed("source", "lang"), F.lit(True))
    found = lang_id.identify(table.withColumnRenamed("value", "_letters"), model).collect()
    assert sorted((r._letters, r.lang_pred) for r in found) == [(0, "a"), (1, "a"), (2, "a")]

"""The conversation trie against listing every beginning."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from corpusflow.llm import prefix_trie
from corpusflow.llm.prefix_trie import TURN, Forest, Vertex, _merged, shared, trie, turns_of, with_borrowed_heads


def brute(convs):
    """Rows of the trie of ``{conv: [(token, words), ...]}``."""
    members = {}
    for conv, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(conv)
    kids = {path: 0 for path in members}
    for path in members:
        if path:
            kids[path[:-1]] += 1
    out = []
    for path, convs_here in members.items():
        under = [p for p in members if p[: len(path)] == path]
        ends = sorted(c for c in convs_here if len(convs[c]) == len(path))
        out.append((min(convs_here), len(path), min(members[path[:-1]]) if path else None, len(convs_here), kids[path],
                    sum(kids[p] == 0 for p in under),
                    sum((len(members[p]) - 1) * p[-1][1] for p in under if p),
                    hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()))
    return sorted(out, key=str)


def random_convs(r, n, words=3, longest=8):
    out = {}
    for conv in r.sample(range(-50, 1000), n):
        if out and r.random() < 0.5:
            turns = list(r.choice(list(out.values())))
            turns = turns[: r.randrange(len(turns) + 1)]
        else:
            turns = []
        while len(turns) < longest and r.random() < 0.6:
            token = r.randrange(4)
            turns.append((token, token % words))
        out[conv] = turns
    return out


def key_of(turns):
    return b"".join(hashlib.md5(str(t).encode()).digest() + w.to_bytes(4) for t, w in turns)


@pytest.mark.parametrize("seed", range(40))
def test_any_cut_of_the_order_gives_the_same_nodes(seed):
    r = random.Random(seed)
    convs = random_convs(r, r.randrange(1, 60))
    groups = {}
    for conv, turns in convs.items():
        groups.setdefault(key_of(turns), []).append(conv)
    items = [Vertex(k, len(k) // TURN, min(groups[k]), len(groups[k]), True) for k in sorted(groups)]
    cuts = sorted(r.choices(range(len(items) + 1), k=r.randrange(6)))
    rows, packed = [], []
    for part, (a, b) in enumerate(zip([0, *cuts], [*cuts, len(items)])):
        forest = Forest()
        for at in range(a, b, 3):  # in batches
            some = items[at : min(b, at + 3)]
            keys = [v.key for v in some]
            forest.add(some, [shared(x, y) for x, y in zip(keys, keys[1:])], keys[0], keys[-1])
        rows += forest.nodes.rows().to_pylist()
        if forest.vertices:
            depths = [v.depth for v in forest.vertices]
            low = depths.index(min(depths))
            assert depths[: low + 1] == sorted(depths[: low + 1], reverse=True)
            assert depths[low:] == sorted(depths[low:])
            packed.append(forest.packed(part))
    import pyarrow as pa

    rows += [x for x in _merged(pa.Table.from_batches(packed), True).to_pylist() if x["forest"] is None]
    ids = {x["id"]: x["conv_id"] for x in rows if x["id"] is not None}
    got = sorted(
        (
            (x["conv_id"], x["depth"], ids[x["parent_id"]] if x["parent_id"] is not None else x["conv_id"] if x["depth"] else None,
             x["n_convs"], x["n_children"], x["n_leaves"], x["saved_tokens"]) for x in rows
        ), key=str)
    assert got == sorted((x[:-1] for x in brute(convs)), key=str)
    assert sum(x["ends"] for x in rows) == len(groups)


def frame(spark, convs):
    rows = [(c, [f"{hashlib.md5(str(t).encode()).hexdigest()}{w:08x}" for t, w in turns]) for c, turns in convs.items()]
    return spark.createDataFrame(rows, "conv long, turns array<string>").repartition(6)


@pytest.mark.parametrize("ranges", [None, 45])
def test_operator(spark, ranges):
    """45 ranges make three forests of sixteen, then one."""
    r = random.Random(11)
    convs = random_convs(r, 300)
    convs |= {c: [(7, 1)] * 40 for c in range(2000, 2300)}  # one large group of copies, long
    convs |= {c: [(7, 1)] * 39 + [(c, 2)] for c in range(3000, 3040)}
    out = trie(frame(spark, convs), ranges)
    assert sorted((tuple(x) for x in out.collect()), key=str) == brute(convs)


def test_packets_of_a_large_group_pass_one_hash(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "BLOB", 100)
    convs = {c: [(1, 1)] for c in range(-5, 400)} | {1000: [(1, 1), (2, 2)], 2000: []}
    out = trie(frame(spark, convs))
    assert sorted((tuple(x) for x in out.collect()), key=str) == brute(convs)


def test_turns_and_borrowed_heads(spark):
    r = random.Random(2)
    rows = []
    for conv in [*range(0, 45), -3, 87, 200]:
        for turn in range(r.randrange(0, 6)):
            rows.append((conv, r.choice([turn, turn, None]), r.choice(["user", None]), r.choice(["a b", "c", None, ""])))
    rows += [(7, 1, "x", "same same")] * 3 + [(None, 1, "user", "lost"), (61, None, None, None)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    df = df.withColumns({c: F.lit(0) for c in ("conv", "h", "base", "row", "token", "key", "n")}).repartition(4)

    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            digest = hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()
            own.setdefault(conv, []).append((turn is not None, turn or 0, digest, len(text.split())))
    own = {c: [(d, w) for _, _, d, w in sorted(ts)] for c, ts in own.items()}
    expected = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (abs(c) % 20 if c >= 0 else -(abs(c) % 20))
        expected[c] = own.get(base, [])[:h] + turns[h:]
    got = with_borrowed_heads(turns_of(df))
    assert {x.conv: x.turns for x in got.collect()} == {
        c: [f"{d}{w:08x}" for d, w in ts] for c, ts in expected.items()
    }
    assert sorted((tuple(x) for x in trie(got).collect()), key=str) == brute(expected)


def test_empty(spark):
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert trie(with_borrowed_heads(turns_of(none))).collect() == []
    bare = trie(spark.createDataFrame([(5, [])], "conv long, turns array<string>")).collect()
    assert [tuple(x)[:7] for x in bare] == [(5, 0, None, 1, 0, 1, 0)]

"""The trie of conversations: which beginnings they share, and what sharing them would save.

A conversation is one binary key, 20 bytes a turn (digest of role and text, then its words), so
that sorting keys puts conversations with a common beginning side by side. Equal conversations are
counted first and make one key. Neighbours in the order are joined by an edge as deep as the turns
they share. Union-find takes these edges in descending depth: a merge at depth ``d`` makes a
branching node there, or lets one grow that is there already, and closes what hangs below it.

Ranges of the order are worked on apart. What touches an end of a range may go on beyond it, so it
stays open: the range leaves a contracted forest, the nodes on the way down from its first key and
up to its last, each with the sums of what is closed below. Neighbouring forests merge by the same
union-find over the edges left, sixteen at a time, until one remains, whose bottom is the root.
Turns between two branching nodes are listed when their lower node is closed.

One conversation's key must fit one row (20 bytes a turn); groups of equal conversations, common
beginnings and the table as a whole are spread over tasks.
"""

from __future__ import annotations

import hashlib
import pickle
from collections.abc import Iterator
from dataclasses import astuple, dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusflow.llm.storage import written

WORD = r"[^\x20\x09-\x0D]+"  # fixed value
TURN = 20  # bytes of a key for each turn: 16 of a digest, 4 of the number of words
RANGE_BYTES = 32_000_000
RANGES = 8
FOREST = 16
BLOB = 1_000_000


# --- union-find over one stretch of the order ----------------------------------------------


@dataclass(slots=True)
class Vertex:
    """A node with all that is known below it. ``key`` begins with the node's path."""

    key: bytes
    depth: int
    conv: int
    n: int
    ends: bool
    kids: int = 0
    leaves: int = 0
    below: int = 0

    def take(self, other: Vertex) -> None:
        """Two parts of one node."""
        self.conv, self.n, self.ends = min(self.conv, other.conv), self.n + other.n, self.ends or other.ends
        self.kids, self.leaves, self.below = self.kids + other.kids, self.leaves + other.leaves, self.below + other.below


def shared(a: bytes, b: bytes) -> int:
    """Turns that two keys have in common."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n // TURN
    differ = np.frombuffer(a, np.uint8, n) != np.frombuffer(b, np.uint8, n)
    return int(differ.argmax()) // TURN


def path_id(key: bytes, depth: int) -> bytes:
    return hashlib.md5(key[: TURN * depth]).digest()


class Nodes:
    """Rows of closed nodes."""

    NAMES = ("conv_id", "depth", "parent_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "id", "ends")
    TYPES = (pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.bool_())
    SCHEMA = (
        "conv_id long, depth long, parent_id binary, n_convs long, n_children long, n_leaves long, "
        "saved_tokens long, id binary, ends boolean, part long, forest binary"
    )
    ARROW = pa.schema([*zip(NAMES, TYPES), ("part", pa.int64()), ("forest", pa.binary())])

    def __init__(self):
        self.columns = [[] for _ in self.NAMES]

    def __len__(self) -> int:
        return len(self.columns[0])

    def close(self, v: Vertex, above: int) -> tuple[int, int]:
        """List a node and the turns over it, up to its parent at depth ``above`` (-1: a root).

        Gives its leaves, and what is saved in it, below it and by those turns.
        """
        depths = np.arange(max(above + 1, 0), v.depth + 1)
        words = np.frombuffer(v.key, ">u4")[4::5][depths[0] - 1 if depths[0] else 0 : v.depth].astype(np.int64)
        if not depths[0]:
            words = np.concatenate([[0], words])
        saved = v.below + (v.n - 1) * np.cumsum(words[::-1])[::-1]
        n, leaves = len(depths), v.leaves or 1
        first = path_id(v.key, above) if above >= 0 else None
        for column, values in zip(
            self.columns,
            (
                [v.conv] * n,
                depths.tolist(),
                [first] + [None] * (n - 1),
                [v.n] * n,
                [1] * (n - 1) + [v.kids],
                [leaves] * n,
                saved.tolist(),
                [None] * (n - 1) + [path_id(v.key, v.depth)],
                [False] * (n - 1) + [v.ends],
            ),
        ):
            column += values
        return leaves, int(saved[0])

    def rows(self) -> pa.RecordBatch:
        arrays = [pa.array(c, t) for c, t in zip(self.columns, self.TYPES)]
        n = len(self)
        self.columns = [[] for _ in self.NAMES]
        return pa.RecordBatch.from_arrays([*arrays, pa.nulls(n, pa.int64()), pa.nulls(n, pa.binary())], schema=self.ARROW)


def _joined(left: Vertex, right: Vertex, depth: int, nodes: Nodes) -> Vertex:
    """The node at ``depth`` over two closed neighbours."""
    made = Vertex(left.key, depth, min(left.conv, right.conv), 0, False)
    for v in (left, right):
        if v.depth == depth:
            made.take(v)
        else:
            _hang(made, v, nodes)
    return made


def _hang(under: Vertex, v: Vertex, nodes: Nodes) -> None:
    leaves, saved = nodes.close(v, under.depth)
    under.conv, under.n = min(under.conv, v.conv), under.n + v.n
    under.kids, under.leaves, under.below = under.kids + 1, under.leaves + leaves, under.below + saved


def contract(
    vertices: list[Vertex], edges: list[int], nodes: Nodes, left_open: bool = True, right_open: bool = True
) -> tuple[list[Vertex], list[int]]:
    """Merge neighbours in descending depth of their edge; ``edges[i]`` lies after ``vertices[i]``.

    Closed nodes go to ``nodes``. What is left is open: the node of the first vertex and what it
    hangs under, ever less deep, then ever deeper to that of the last vertex.
    """
    n = len(vertices)
    over = list(range(n))  # union-find over vertices

    def find(i: int) -> int:
        while over[i] != i:
            over[i] = over[over[i]]
            i = over[i]
        return i

    # Each component's nodes in order and the edges between them: one, or an open end's path.
    paths: list[tuple[list[Vertex], list[int]] | None] = [([v], []) for v in vertices]
    first, last = (0 if left_open else -1), (n - 1 if right_open else -1)

    for i in sorted(range(n - 1), key=lambda i: -edges[i]):
        depth, a, b = edges[i], find(i), find(i + 1)
        (left, between_left), (right, between_right) = paths[a], paths[b]
        at_left = first >= 0 and find(first) == a
        at_right = last >= 0 and find(last) == b
        if at_left and at_right:
            if left[-1].depth == depth == right[0].depth:
                left[-1].take(right[0])
                made = (left + right[1:], between_left + between_right)
            else:
                made = (left + right, [*between_left, depth, *between_right])
        elif at_left:
            made = (left, between_left)
            if left[-1].depth != depth:
                left.append(Vertex(left[0].key, depth, right[0].conv, 0, False))
                between_left.append(depth)
            _absorb(left[-1], right[0], nodes)
        elif at_right:
            made = (right, between_right)
            if right[0].depth != depth:
                right.insert(0, Vertex(right[-1].key, depth, left[0].conv, 0, False))
                between_right.insert(0, depth)
            _absorb(right[0], left[0], nodes)
        else:
            made = ([_joined(left[0], right[0], depth, nodes)], [])
        over[b] = a
        paths[a], paths[b] = made, None
    return paths[find(0)] if n else ([], [])


def _absorb(node: Vertex, v: Vertex, nodes: Nodes) -> None:
    if v.depth == node.depth:
        node.take(v)
    else:
        _hang(node, v, nodes)


class Forest:
    """The open nodes of a stretch of the order, to which what follows is added."""

    def __init__(self):
        self.vertices: list[Vertex] = []
        self.edges: list[int] = []
        self.last = b""
        self.nodes = Nodes()

    def add(self, vertices: list[Vertex], edges: list[int], first: bytes, last: bytes) -> None:
        if self.vertices:
            edges = [*self.edges, shared(self.last, first), *edges]
        self.vertices, self.edges = contract(self.vertices + vertices, edges, self.nodes)
        self.last = last

    def packed(self, part: int) -> pa.RecordBatch:
        """One row that another task can go on with."""
        state = pickle.dumps(
            (
                # Every open node lies on the way to the first or to the last key.
                [(self.last.startswith(v.key[: TURN * v.depth]), *astuple(v)[1:]) for v in self.vertices],
                self.edges,
                self.vertices[0].key,
                self.last,
            )
        )
        row = {name: None for name in Nodes.NAMES} | {"part": part, "forest": state}
        return pa.RecordBatch.from_pylist([row], schema=Nodes.ARROW)

    def finish(self) -> None:
        """Close what is open, down to the root."""
        (top,), _ = contract(self.vertices, self.edges, self.nodes, False, False)
        if top.depth:
            root = Vertex(top.key, 0, top.conv, 0, False)
            _hang(root, top, self.nodes)
            top = root
        self.nodes.close(top, -1)


def _forests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Closed nodes and the forest of one range of sorted keys."""
    forest = Forest()
    for batch in batches:
        keys = batch.column("key").to_pylist()
        if not keys:
            continue
        rows = zip(keys, batch.column("conv").to_pylist(), batch.column("n").to_pylist())
        vertices = [Vertex(k, len(k) // TURN, conv, n, True) for k, conv, n in rows]
        edges = [shared(a, b) for a, b in zip(keys, keys[1:])]
        forest.add(vertices, edges, keys[0], keys[-1])
        yield forest.nodes.rows()
    if forest.vertices:
        yield forest.packed(TaskContext.get().partitionId())


def _merged(rows: pa.Table, last: bool) -> pa.Table:
    """Neighbouring forests as one; the last one is closed."""
    rows = rows.sort_by("part")
    forest, made = Forest(), []
    for state in rows.column("forest").to_pylist():
        vertices, edges, first, end = pickle.loads(state)
        forest.add([Vertex(end if of_last else first, *v) for of_last, *v in vertices], edges, first, end)
        made.append(forest.nodes.rows())
    if last:
        forest.finish()
        made.append(forest.nodes.rows())
    else:
        made.append(forest.packed(rows.column("part")[0].as_py() // FOREST))
    return pa.Table.from_batches(made, schema=Nodes.ARROW)


# --- conversations as keys -----------------------------------------------------------------


def turns_of(
    turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """``conv, turns``: each conversation's turns in order, 40 hex digits each.

    Turns without a number come first; turns with one number are ordered by the digest of role
    and text, so repeated rows stay and the order is the same at every run. A null role or text is
    empty. Rows without a conversation belong to none and are left out.
    """
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in (role_col, text_col))
    digest = F.md5(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text))
    count = F.lpad(F.hex(F.regexp_count(text, F.lit(WORD))), 8, "0")
    rows = turns.select(
        F.col(conv_col).cast("long").alias("conv"),
        F.struct(F.col(turn_col).alias("turn"), F.concat(digest, F.lower(count)).alias("token")).alias("row"),
    ).where("conv IS NOT NULL")
    in_order = F.array_sort(F.collect_list("row"), _before)
    return rows.groupBy("conv").agg(in_order.alias("rows")).select(
        "conv", F.transform("rows", lambda r: r["token"]).alias("turns")
    )


def _before(a: Column, b: Column) -> Column:
    """Order of two turns: null numbers first, then by number, then by digest."""
    by_number = F.when(a["turn"].eqNullSafe(b["turn"]), 0).when(a["turn"].isNull() | (a["turn"] < b["turn"]), -1)
    by_token = F.when(a["token"] < b["token"], -1).when(a["token"] == b["token"], 0).otherwise(1)
    number = F.when(b["turn"].isNull() & a["turn"].isNotNull(), 1).otherwise(by_number.otherwise(1))
    return F.when(number == 0, by_token).otherwise(number)


def with_borrowed_heads(convs: DataFrame, every: int = 20, most: int = 4) -> DataFrame:
    """Each conversation with its first turns taken from the one its family begins with.

    A family is ``every`` neighbouring ids; the head is crc32 of the id modulo ``most`` turns long,
    fewer if that conversation has fewer. The own turns after as many follow.
    """
    conv = F.col("conv")
    convs = convs.withColumns(
        {"base": conv - conv % every, "h": (F.crc32(conv.cast("string")) % most).cast("int")}
    )
    heads = convs.where(conv == F.col("base")).select("base", F.slice("turns", 1, most - 1).alias("head"))
    head = F.slice(F.coalesce("head", F.array().cast("array<string>")), F.lit(1), F.col("h"))
    own = F.slice("turns", F.col("h") + 1, F.greatest(F.size("turns"), F.lit(1)))
    return convs.join(heads, "base", "left").select("conv", F.concat(head, own).alias("turns"))


# --- the operator --------------------------------------------------------------------------


def _digests(members: DataFrame) -> DataFrame:
    """``id, ends_sha256``: SHA-256 of each group's ids, ascending, joined by commas.

    A group of any size is packed range by range, and its packets pass one hash in order.
    """
    ranges = members.repartitionByRange("id", "conv").sortWithinPartitions("id", "conv")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made, now, ids, size = [], None, [], 0

        def packet() -> dict:
            return {"id": now, "first": ids[0], "blob": ",".join(map(str, ids)).encode()}

        for batch in batches:
            for group, conv in zip(batch.column("id").to_pylist(), batch.column("conv").to_pylist()):
                if ids and (group != now or len(ids) * 20 > BLOB):
                    made.append(packet())
                    size += len(made[-1]["blob"])
                    ids = []
                now = group
                ids.append(conv)
                if size > 4 * BLOB or len(made) >= 10_000:
                    yield pa.RecordBatch.from_pylist(made, schema=_PACKET)
                    made, size = [], 0
        if ids:
            made.append(packet())
        yield pa.RecordBatch.from_pylist(made, schema=_PACKET)

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, sha = None, None
        for batch in batches:
            made = []
            for group, blob in zip(batch.column("id").to_pylist(), batch.column("blob").to_pylist()):
                if group != now:
                    if sha is not None:
                        made.append({"id": now, "ends_sha256": sha.hexdigest()})
                    now, sha = group, hashlib.sha256(blob)
                else:
                    sha.update(b"," + blob)
            yield pa.RecordBatch.from_pylist(made, schema=_DIGEST)
        if sha is not None:
            yield pa.RecordBatch.from_pylist([{"id": now, "ends_sha256": sha.hexdigest()}], schema=_DIGEST)

    packets = ranges.mapInArrow(pack, "id binary, first long, blob binary")
    in_order = packets.repartition("id").sortWithinPartitions("id", "first")
    return in_order.mapInArrow(digest, "id binary, ends_sha256 string")


_PACKET = pa.schema([("id", pa.binary()), ("first", pa.int64()), ("blob", pa.binary())])
_DIGEST = pa.schema([("id", pa.binary()), ("ends_sha256", pa.string())])


def trie(convs: DataFrame, ranges: int | None = None) -> DataFrame:
    """Every node of the trie of ``conv, turns``, from the root to the last turn of each.

    ``conv_id``: least member; ``depth``; ``parent_conv_id`` (null for the root); ``n_convs``:
    conversations that begin with the node's turns; ``n_children``; ``n_leaves``: childless nodes
    in its subtree; ``saved_tokens``: words that need not be read again if each node of the subtree
    is read once; ``ends_sha256``: SHA-256 of the ids that end here, ascending, joined by commas.

    A conversation without turns is a member of the root only. Equal conversations share all their
    nodes. An empty table has no node. The result does not depend on how rows are partitioned.
    Runs jobs while the plan is built; ``ranges`` is how many parts the order is cut into, by
    default one for 32 MB of keys.
    """
    key = F.unhex(F.array_join("turns", ""))
    members = written(convs.select("conv", key.alias("key")), "trie-members")
    distinct = members.groupBy("key").agg(F.min("conv").alias("conv"), F.count(F.lit(1)).alias("n"))
    distinct = written(distinct, "trie-keys")
    if ranges is None:
        total = distinct.agg(F.sum(F.octet_length("key"))).first()[0] or 0
        ranges = max(RANGES, -(-total // RANGE_BYTES))
    made = distinct.repartitionByRange(ranges, "key").sortWithinPartitions("key").mapInArrow(_forests, Nodes.SCHEMA)
    levels = [written(made, "trie-ranges")]
    forests = levels[0].where("forest IS NOT NULL")
    left = (forests.agg(F.max("part")).first()[0] or 0) + 1
    while True:
        last = left <= FOREST
        group = F.floor(F.col("part") / FOREST).alias("group")
        merged = forests.groupBy(group).applyInArrow(_merging(last), Nodes.SCHEMA)
        levels.append(written(merged, "trie-merged"))
        if last:
            break
        forests, left = levels[-1].where("forest IS NOT NULL"), -(-left // FOREST)

    nodes = levels[0]
    for level in levels[1:]:
        nodes = nodes.unionByName(level)
    nodes = nodes.where("forest IS NULL").drop("part", "forest")
    parents = nodes.where("id IS NOT NULL AND n_children > 0").select(
        F.col("id").alias("parent_id"), F.col("conv_id").alias("parent_conv_id")
    )
    hung = nodes.where("parent_id IS NOT NULL").join(parents, "parent_id", "left")
    inner = nodes.where("parent_id IS NULL").withColumn(
        "parent_conv_id", F.when(F.col("depth") > 0, F.col("conv_id"))
    )
    every = hung.unionByName(inner)
    digests = _digests(members.select(F.unhex(F.md5("key")).alias("id"), "conv"))
    nobody = F.lit(hashlib.sha256(b"").hexdigest())
    ending = every.where("ends").join(digests, "id", "left")
    through = every.where("NOT ends").withColumn("ends_sha256", nobody)
    return ending.unionByName(through).select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"
    )


def _merging(last: bool):
    return lambda rows: _merged(rows, last)

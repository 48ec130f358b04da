"""N-gram Jaccard join: size-banded tiles, bitmap bounds, exact intersections.

Two documents link when the Jaccard likeness of their sets of word shingles is at least
``percent`` / 100; the result is each document's class under these links.

1. A sketch over all chunks (a count-min sketch of the shingles' hashes, which never
   underestimates) tells which shingles may occur in a second document. A document that links
   shares that share of its own shingles, so all others are done: they link with nothing.
2. Documents with equal sets become one class. Each class is posted under the smallest hashes of
   its set, so many that two linked sets must meet under one of them (prefix filter), once for
   its size band and once for the next: sets that link lie in the same or neighbouring bands.
   Posts of the same members, which near copies have by the hundred, become one with their number.
3. In a few rounds each class is compared with the ``LEADERS`` classes, seeded choices of each
   post, that it meets in most posts. These links join large groups of near copies without
   looking at all pairs.
4. Posts that still hold several components become tiles, cut into blocks of ``BLOCK`` sets. In a tile, the bits in which two hashed bitmaps differ
   bound the overlap from above; pairs inside a component are passed over, and a pair is
   given out only under the least post it shares. The pairs that remain are settled by
   intersecting their sorted arrays.
5. Components come from alternating stars.

No link between different components is skipped, so the classes are exact; links inside a
component that is already known need not be looked at. Shingles are 64-bit hashes.

Defined results: A-Z are lower-cased, words are runs of bytes other than blanks; fewer words
than a shingle make one shingle; a null or text without words has none and is alone. Rows that
share an id count as one document each for the links and get one answer per row; their
component is the smallest id reachable. Null ids count as the largest and come back null. An
empty table gives an empty result. Only the id and text column are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from corpusflow.llm.components import components
from corpusflow.llm.rounds import LAST_ID, Sketch, ask, chunked, finish, reply, text_bytes
from corpusflow.llm.storage import written
from corpusflow.llm.textarrays import lowered, mixed, shingles, utf8

WORDS = 5
PERCENT = 75
BLOCK = 512
TILE_ROWS = 20_000
ROUNDS = 3
LEADERS = 4
# A chunk's texts are cut into shingles so many bytes at a time, or one text if it is longer.
RUN_BYTES = 500_000
# On average a word and the blank after it take at least this many bytes.
_BYTES_A_WORD = 4


def _sets(chunk: pa.Table, words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct shingles of a chunk's documents: owners, hashes, and where each begins.

    Worked out for some documents after others, as what a byte needs on the way is many times it.
    """
    data, offsets = utf8(chunk.column("text"))
    owners, values = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
    begin, rows = 0, len(offsets) - 1
    while begin < rows:
        end = max(begin + 1, int(np.searchsorted(offsets, offsets[begin] + RUN_BYTES, "right")) - 1)
        some = lowered(data[offsets[begin] : offsets[end]])
        owner, value = shingles(some, offsets[begin : end + 1] - offsets[begin], words)
        order = np.lexsort((value, owner))
        owner, value = owner[order], value[order]
        new = np.ones(len(owner), bool)
        new[1:] = (owner[1:] != owner[:-1]) | (value[1:] != value[:-1])
        owners.append(owner[new] + begin)
        values.append(value[new])
        begin = end
    owner, value = np.concatenate(owners), np.concatenate(values)
    return owner, value, np.searchsorted(owner, np.arange(chunk.num_rows + 1))


def _digests(chunk: pa.Table) -> list[bytes]:
    return [hashlib.md5(t.as_buffer()).digest() for t in chunk.column("text").cast(pa.binary())]


def _prefix(n: np.ndarray | int, percent: int) -> np.ndarray | int:
    """How many of a set's smallest hashes must be posted."""
    return n - -(-n * percent // 100) + 1


def band(n: Column, percent: int) -> Column:
    """Sets that link lie in the same band or in neighbouring ones."""
    return F.floor(F.log(n.cast("double")) / F.log(F.lit(100 / percent)) + 1e-9).cast("int")


def bitmap(values: np.ndarray, bits: int) -> bytes:
    marks = np.zeros(bits, bool)
    marks[(mixed(values) % np.uint64(bits)).astype(np.int64)] = True
    return np.packbits(marks).tobytes()


def _bitmap_bits(tile: int, percent: int) -> int:
    """Bits of a tile's bitmaps: about four for each shingle of its largest sets."""
    largest = (100 / percent) ** (tile + 1)
    return int(min(2**16, max(64, 2 ** int(np.ceil(np.log2(4 * largest))))))


def link_classes(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    words: int = WORDS,
    percent: int = PERCENT,
    row_keys: bool = False,
) -> DataFrame:
    """``id_col, n_shingles, class_id, component_id`` of every document.

    ``class_id`` is the smallest id with the same set, ``component_id`` the smallest reachable.
    ``row_keys`` adds ``text_key``, the MD5 of the text, which with the id names a row, and
    ``group_key``, which names a component also where ids repeat; null for what links with nothing.
    """
    total = text_bytes(docs, text_col)
    chunks = chunked(docs, total, id_col, text_col)
    sketch = Sketch(total // _BYTES_A_WORD, rows=1)

    def count(chunk: pa.Table, _: list[bytes]) -> Iterator[tuple[int, bytes]]:
        yield from sketch.question(_sets(chunk, words)[1])

    def describe(chunk: pa.Table, answers: list[bytes]) -> pa.Table:
        owner, value, first = _sets(chunk, words)
        shared = np.concatenate([[0], np.cumsum(sketch.repeated(value, answers))])
        n = np.diff(first)
        may = (n > 0) & ((shared[first[1:]] - shared[first[:-1]]) * 100 >= percent * n)
        sets = [value[first[i] : first[i + 1]].tobytes() if may[i] else None for i in range(len(n))]
        return pa.table(
            {
                "id": chunk.column("id"),
                "n": pa.array(n, pa.int64()),
                "set": pa.array(sets, pa.binary()),
                "text_key": pa.array(_digests(chunk) if row_keys else [None] * len(n), pa.binary()),
            }
        )

    answers = reply(ask(chunks, count), sketch.answer)
    found = written(finish(chunks, answers, describe, "id long, n long, set binary, text_key binary"), "sets")
    found = found.withColumn("key", F.unhex(F.md5("set")))
    # One row of each distinct set; its text-sized array is picked up once, by its least id.
    least = found.where("key IS NOT NULL").groupBy("key").agg(F.min("id").alias("class_id"))
    classes = written(
        found.where("key IS NOT NULL")
        .join(least.withColumnRenamed("class_id", "id"), ["key", "id"])
        .dropDuplicates(["key"])
        .select("key", F.col("id"), "n", "set"),
        "classes",
    )
    labels = _link(classes, percent)
    answer = least.join(labels, "key", "left").select(
        "key",
        "class_id",
        F.coalesce("component_id", "class_id").alias("component_id"),
        F.coalesce("component", "key").alias("group_key"),
    )
    alone = F.when(F.col("id") != LAST_ID, F.col("id"))
    rows = found.select("id", "n", "key", "text_key").join(answer, "key", "left")
    named = [
        F.when(F.coalesce(c, F.col("id")) != LAST_ID, F.coalesce(c, F.col("id")))
        for c in (F.col("class_id"), F.col("component_id"))
    ]
    return rows.select(
        alone.alias(id_col),
        F.col("n").alias("n_shingles"),
        named[0].alias("class_id"),
        named[1].alias("component_id"),
        *(["text_key", "group_key"] if row_keys else []),
    )


def _link(classes: DataFrame, percent: int) -> DataFrame:
    """``key, component_id, component`` of the classes that link with another one."""

    def posts_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [np.frombuffer(s, np.uint64) for s in batch.column("set").to_pylist()]
            heads = [v[: _prefix(len(v), percent)].view(np.int64) for v in values]
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), batch.column("id"), batch.column("n"), pa.array(heads, pa.list_(pa.int64()))],
                names=["key", "id", "n", "heads"],
            )

    posted = classes.mapInArrow(posts_of, "key binary, id long, n long, heads array<long>")
    own = band(F.col("n"), percent)
    posts = posted.select("key", "n", F.explode("heads").alias("head")).withColumn(
        "tile", F.explode(F.array(own, own + 1))
    )
    # Posts with a single class lead nowhere; of posts with the same members one stays, with their number.
    several = (
        posts.groupBy("head", "tile")
        .agg(
            F.count(F.lit(1)).alias("m"),
            F.bit_xor(F.xxhash64("key")).alias("s1"),
            F.bit_xor(F.xxhash64(F.lit(1), "key")).alias("s2"),
        )
        .where("m > 1")
        .groupBy("m", "s1", "s2")
        .agg(F.min(F.struct("tile", "head")).alias("least"), F.count(F.lit(1)).alias("same"))
        .select("least.*", "same")
    )
    posts = written(posts.join(several, ["head", "tile"]), "posts")
    ids = classes.select("key", "id")
    edges: DataFrame | None = None
    labels: DataFrame | None = None
    for seed in range(ROUNDS):
        members = _labelled(posts, labels)
        chosen = [
            F.min_by(F.struct("key", "label"), F.xxhash64(F.lit(seed * LEADERS + k), "key"))
            for k in range(LEADERS)
        ]
        leaders = members.groupBy("head", "tile").agg(F.array_distinct(F.array(*chosen)).alias("led"))
        # Sets that link share most of their posts; the tiles see to the few that do not.
        posted_n = F.col("n") - F.ceil(F.col("n") * percent / 100) + 1
        best = Window.partitionBy("key").orderBy(F.desc("posts"), "leader")
        led = (
            members.join(leaders, ["head", "tile"])
            .withColumn("led", F.explode("led"))
            .where(F.col("led.label") != F.col("label"))
            .groupBy("key", "n", F.col("led.key").alias("leader"))
            .agg(F.sum("same").alias("posts"))
            .where(3 * F.col("posts") >= posted_n)
            .withColumn("place", F.row_number().over(best))
            .where(F.col("place") <= LEADERS)
        )
        pairs = led.select(F.col("key").alias("x"), F.col("leader").alias("y"))
        new = written(_settled(pairs, classes, percent), "links")
        if new.isEmpty():
            break
        edges = new if edges is None else edges.unionByName(new)
        labels = written(components(edges, "x", "y"), "labels")
    pairs = _tiles(_labelled(posts, labels), classes, percent)
    new = written(_settled(pairs, classes, percent), "links")
    if edges is None or not new.isEmpty():
        edges = new if edges is None else edges.unionByName(new)
        labels = components(edges, "x", "y")
    named = labels.join(ids.withColumnRenamed("key", "node"), "node")
    smallest = named.groupBy("component").agg(F.min("id").alias("component_id"))
    return named.join(smallest, "component").select(
        F.col("node").alias("key"), "component_id", "component"
    )


def _labelled(posts: DataFrame, labels: DataFrame | None) -> DataFrame:
    if labels is None:
        return posts.withColumn("label", F.col("key"))
    names = labels.select(F.col("node").alias("key"), "component")
    return posts.join(names, "key", "left").select(
        *posts.columns, F.coalesce("component", "key").alias("label")
    )


def _settled(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """The pairs ``x, y`` whose sets link, by intersecting their sorted arrays."""
    left = classes.select(F.col("key").alias("x"), F.col("set").alias("set_x"))
    right = classes.select(F.col("key").alias("y"), F.col("set").alias("set_y"))
    both = pairs.join(left, "x").join(right, "y")

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for a, b in zip(batch.column("set_x"), batch.column("set_y")):
                a, b = (np.frombuffer(s.as_buffer(), np.uint64) for s in (a, b))
                common = len(np.intersect1d(a, b, assume_unique=True))
                keep.append(100 * common >= percent * (len(a) + len(b) - common))
            yield pa.RecordBatch.from_arrays(
                [batch.column("x"), batch.column("y")], names=["x", "y"]
            ).filter(pa.array(keep, pa.bool_()))

    return both.mapInArrow(check, "x binary, y binary")


def _tiles(members: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Pairs ``x, y`` of different components that no bound rules out.

    Posts are cut into blocks, and tiles of two blocks go to tasks in buckets of about
    ``TILE_ROWS`` rows.
    """
    post = ["head", "tile"]
    sizes = members.groupBy(*post).agg(
        F.count(F.lit(1)).alias("m"),
        F.min("label").alias("low"),
        F.max("label").alias("high"),
    )
    blocks = F.ceil(F.col("m") / BLOCK).cast("int")
    open_ = written(sizes.where("low <> high").select(*post, blocks.alias("blocks")), "open-posts")
    rows = open_.agg(F.sum(F.col("blocks") * F.col("blocks"))).first()[0] or 0
    buckets = max(1, -(-rows * BLOCK // (8 * TILE_ROWS)))
    block = F.pmod(F.xxhash64(F.lit(9), "key"), F.col("blocks")).cast("int")
    # A member of block b meets every block: it goes to the tiles (min, max) of b and each.
    meets = F.transform(
        F.sequence(F.lit(0), F.col("blocks") - 1),
        lambda o: F.struct(F.least(o, F.col("block")).alias("i"), F.greatest(o, F.col("block")).alias("j")),
    )
    own = band(F.col("n"), percent)
    drawn = classes.select("key", "set", F.explode(F.array(own, own + 1)).alias("tile"))

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            maps = [
                bitmap(np.frombuffer(s, np.uint64), _bitmap_bits(t, percent))
                for s, t in zip(batch.column("set").to_pylist(), batch.column("tile").to_pylist())
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), batch.column("tile"), pa.array(maps, pa.binary())],
                names=["key", "tile", "map"],
            )

    # Each member knows all its posts, so that a pair is looked at under the least it shares.
    number = F.xxhash64(*post).alias("post")
    kept = members.join(open_, post)
    shared = kept.groupBy("key").agg(F.sort_array(F.collect_set(number)).alias("posts"))
    spread = (
        kept.join(shared, "key")
        .withColumn("block", block)
        .withColumn("at", F.explode(meets))
        .select(*post, number, "posts", "at.i", "at.j", "block", "key", "label", "n")
        .join(drawn.mapInArrow(draw, "key binary, tile int, map binary"), ["key", "tile"])
        .withColumn("bucket", F.pmod(F.xxhash64(*post, "i", "j"), F.lit(buckets)))
    )
    return (
        spread.groupBy("bucket")
        .applyInArrow(lambda t: compare_tiles(t, percent), "x binary, y binary")
        .distinct()
    )


def compare_tiles(tiles: pa.Table, percent: int) -> pa.Table:
    """Pairs of each tile whose bitmaps allow a link, if they join two components."""
    tiles = tiles.sort_by([(c, "ascending") for c in ("head", "tile", "i", "j", "key")])
    keys, maps = tiles.column("key").to_pylist(), tiles.column("map").to_pylist()
    label = tiles.column("label").combine_chunks().dictionary_encode()
    if isinstance(label, pa.ChunkedArray):
        label = label.combine_chunks()
    label = label.indices.to_numpy()
    block, n = tiles.column("block").to_numpy(), tiles.column("n").to_numpy()
    post, posts = tiles.column("post").to_numpy(), tiles.column("posts").to_pylist()
    ids = np.stack([tiles.column(c).to_numpy() for c in ("head", "tile", "i", "j")])
    at = np.flatnonzero(np.append(True, (np.diff(ids) != 0).any(axis=0)))
    xs, ys = [], []
    for begin, end in zip(at, np.append(at[1:], len(keys))):
        across = ids[2, begin] != ids[3, begin]
        bits = np.stack([np.frombuffer(m, np.uint64) for m in maps[begin:end]])
        earlier = [[p for p in x if p < post[begin]] for x in posts[begin:end]]
        place = {p: i for i, p in enumerate({p for x in earlier for p in x})}
        met = np.zeros((end - begin, len(place) + 1), bool)
        for a, x in enumerate(earlier):
            met[a, [place[p] for p in x]] = True
        for a in range(begin, end - 1):
            other = np.arange(a + 1, end)
            other = other[label[other] != label[a]]
            if across:
                other = other[block[other] != block[a]]
            less, more = np.minimum(n[other], n[a]), np.maximum(n[other], n[a])
            other = other[100 * less >= percent * more]
            # 100 |x & y| >= percent |x or y| is |x & y| >= percent (|x| + |y|) / (100 + percent),
            # and every bit that differs takes half a shingle off (|x| + |y|) / 2.
            differ = np.bitwise_count(bits[other - begin] ^ bits[a - begin]).sum(axis=1, dtype=np.int64)
            both = n[other] + n[a]
            other = other[(100 + percent) * (both - differ) >= 2 * percent * both]
            for b in other[~(met[other - begin] & met[a - begin]).any(axis=1)]:
                xs.append(keys[a])
                ys.append(keys[b])
    return pa.table({"x": pa.array(xs, pa.binary()), "y": pa.array(ys, pa.binary())})

"""Line deduplication by an exact set-similarity join, in DataFrame operations only.

A line is the set of its distinct words. It is removed if a line before it, in this document or
one of a smaller id, has a Jaccard likeness of at least ``percent`` / 100; all lines are judged
on the input.

1. Equal lines: every one after the first is removed. Only digests are shuffled. Equal sets in other
   strings meet in the steps below.
2. The first lines order their words by rarity. Rarity is the number of occurrences of the
   words in the same one of ``BUCKETS`` hash buckets, a table of fixed size made from all texts. Each
   line is posted under its rarest words, so many that two matching lines must share one; posts are
   shuffled in ``WAVES`` parts of the documents into a table in buckets.
3. In the posts of words that may have ``CROWD`` posts or more, in line order, a line is first
   compared with the first line and the ``NEAR`` lines before it. Length, and a map of the set (bits
   that differ bound the overlap from above; 128 bits, for long lines 256 or 512, as more words make
   more bits differ by chance), rule out most; the rest meets a map of 512 bits, then is verified on
   whole sets, a line's nearest candidate first. That settles lines of large groups of near copies
   without looking at all their pairs.
4. All lines join all lines under the same words, with the same filters and the positional one
   (enough words must be left to share if this is the first shared one), but for pairs whose later
   line is settled, and are verified. Of the line with fewer words, still fewer posts take part: its
   first shared word lies further in front. So no match is lost: a pair that matches meets under
   its first shared word.
5. Documents are rebuilt without the removed lines.

Defined results: lines end at ``\\n``; a null text has no lines and stays null; lines without
words are never removed and match nothing. Rows that share an id are copies of one document:
their lines at the same place do not remove each other. Null ids count as one document, the
last. An empty table gives an empty result. Other columns pass through; ``n_lines`` and
``n_removed`` are replaced.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from corpusflow.llm.names import clashing, restored
from corpusflow.llm.storage import bucketed, written

PERCENT = 75
BUCKETS = 2**20
# Up to so many lines (ids and places, some 100 MB) go to the texts instead of the texts to them.
BROADCAST_LINES = 2_000_000
NEAR = 4
# Words of fewer occurrences do without the step that settles large groups.
CROWD = 512
# Numbers of such words begin here: a number begins with what ``rarity`` gives the word.
_CROWDED = int(3 * math.log2(CROWD)) << 40
# Posts are shuffled in so many parts, one after the other.
WAVES = 3
_LAST = 2**63 - 1

# Fixed value: what a word is made of.
_WORD = r"[^\x20\x09-\x0D]"
_KEYS = "struct(xxhash64(line) as k1, xxhash64(1, line) as k2)"
# Hashes of the distinct words of a line. Blanks alone need no regular expression to split at, and
# the empty string's hash goes from the hashes, as functions of a lambda are not compiled.
_WORDS = (
    r"array_remove(array_distinct(transform(split(line, if(line rlike '[\\x09-\\x0D]',"
    r" '[\\x20\\x09-\\x0D]+', ' ')), w -> xxhash64(w))), xxhash64(''))"
)
# A map of 128 bits in two halves; each word turns one bit over. So the bits in which two maps differ
# are at most the words that only one of the lines has, and words of both leave no mark.
_LOW, _HIGH = (
    f"aggregate(words, 0L, (m, w) -> if((w & 64) = {half}, m ^ shiftleft(1L, cast(w & 63 as int)), m))"
    for half in (0, 64)
)
# Lines of so many words are mapped in 256 and 512 bits, or unlike lines would look alike.
LONG, LONGER = 112, 256
# Halves of the 256 bits, then quarters of the 512, that the 128 bits hold folded into one; the other
# halves and quarters come from the folded ones, so that posts need not carry them.
_MORE = (
    "case when size(words) >= {LONGER} then array({long}, {longer})"
    " when size(words) >= {LONG} then array({long}) end"
).format(
    LONG=LONG,
    LONGER=LONGER,
    **{
        name: ", ".join(
            f"aggregate(words, 0L, (m, w) -> if((w & {mask}) = {part + half},"
            " m ^ shiftleft(1L, cast(w & 63 as int)), m))"
            for part in parts
            for half in (0, 64)
        )
        for name, mask, parts in (("long", 64 + 128, (128,)), ("longer", 64 + 128 + 256, (256, 128 + 256)))
    },
)
# The same in 512 bits, by other bits of the hashes, for lines that are compared with candidates.
_WIDE = "array({})".format(
    ", ".join(
        f"aggregate(words, 0L, (m, w) -> if((shiftright(w, 20) & 7) = {part},"
        " m ^ shiftleft(1L, cast(shiftright(w, 24) & 63 as int)), m))"
        for part in range(8)
    )
)
_DIFFER = " + ".join(f"bit_count(map[{part}] ^ map2[{part}])" for part in range(8))


def _key(id_col: str) -> Column:
    return F.coalesce(F.col(id_col).cast("long"), F.lit(_LAST)).alias("doc")


def _sent(small: DataFrame, rows: int) -> DataFrame:
    """To be sent to every task if it is known to be small; shuffled otherwise."""
    return F.broadcast(small) if rows <= BROADCAST_LINES else small


def _lines(texts: DataFrame, but: tuple[DataFrame, int] | None = None, words: str = _WORDS) -> DataFrame:
    """``doc, place, words``: the lines of ``doc, text`` that have words, without some."""
    columns = ["doc", F.posexplode(F.split("text", "\n")).alias("place", "line")]
    if but is not None:
        places = but[0].groupBy("doc").agg(F.collect_set("place").alias("but"))
        texts = texts.join(_sent(places, but[1]), "doc", "left")
        kept = F.coalesce(F.array_contains("but", F.col("place")), F.lit(False))
        each = texts.select("but", *columns).where(~kept)
    else:
        each = texts.select(*columns)
    return each.where(F.col("line").rlike(_WORD)).select("doc", "place", F.expr(words).alias("words"))


def _some_lines(texts: DataFrame, wanted: DataFrame, rows: int) -> DataFrame:
    """``doc, place, words`` of the lines that ``wanted`` (``doc, place``) names."""
    places = wanted.groupBy("doc").agg(F.collect_set("place").alias("places"))
    each = texts.join(_sent(places, rows), "doc").select(
        "doc", "places", F.posexplode(F.split("text", "\n")).alias("place", "line")
    )
    named = each.where(F.array_contains("places", F.col("place")))
    return named.where(F.col("line").rlike(_WORD)).select("doc", "place", F.expr(_WORDS).alias("words"))


def rarity(texts: DataFrame) -> DataFrame:
    """One row, ``rare``: for each bucket a number below 128 that grows with the occurrences of its words."""
    blank = F.expr(r"if(text rlike '[\\x09\\x0B-\\x0D]', '[\\x20\\x09-\\x0D]+', ' ')")
    words = texts.select(F.explode(F.split(F.replace("text", F.lit("\n"), F.lit(" ")), blank)).alias("w"))
    counts = words.groupBy(F.expr(f"xxhash64(w) & {BUCKETS - 1}").alias("bucket")).count()
    number = F.least(F.lit(127), F.floor(3 * F.log2(F.col("count") + 1))).cast("byte")
    none = texts.sparkSession.range(BUCKETS).select(F.col("id").alias("bucket"), F.lit(0).cast("byte").alias("rare"))
    numbers = counts.select("bucket", number.alias("rare")).unionByName(none)
    # Blocks of buckets first, so that no task sorts single numbers of all.
    blocks = numbers.groupBy(F.shiftright("bucket", 10).alias("block")).agg(
        F.sort_array(F.collect_list(F.struct("bucket", "rare"))).alias("numbers")
    )
    last = F.filter("numbers", lambda x, i: F.coalesce(F.get("numbers", i + 1)["bucket"] > x["bucket"], F.lit(True)))
    block = F.struct("block", F.transform(last, lambda x: x["rare"]).alias("rare"))
    all_ = F.flatten(F.transform(F.sort_array(F.collect_list(block)), lambda x: x["rare"]))
    return written(blocks.agg(all_.alias("rare")), "line-rarity")


def _may_match(one: str, two: str, more: str, more2: str, percent: int) -> str:
    """Length filter, then the bound that the maps give.

    Columns are named ``one.format(column)``, the maps of long lines ``more.format(number)``.
    """
    return " and ".join(_alike_maps(one, two, more, more2, percent))


def _alike_maps(one: str, two: str, more: str, more2: str, percent: int) -> tuple[str, str]:
    """Length and 128 bits, which most pairs fail, and the maps of long lines."""

    def differ(*maps: str) -> str:
        return f"({' + '.join(f'bit_count({m})' for m in maps)})"

    n, other = one.format("n"), two.format("n")
    folded = [f"{one.format(c)} ^ {two.format(c)}" for c in ("low", "high")]
    part = [f"{more.format(i)} ^ {more2.format(i)}" for i in range(6)]
    halves = [*part[:2], *(f"{a} ^ {b}" for a, b in zip(folded, part[:2]))]
    # Quarters of the first half (what is folded without the second) and of the second.
    quarters = [*part[2:], *(f"{a} ^ {b}" for a, b in zip(halves[2:] + halves[:2], part[2:]))]
    return (
        f"100 * least({n}, {other}) >= {percent} * greatest({n}, {other})"
        f" and {_overlaps(n, other, differ(*folded), percent)}",
        f"(least({n}, {other}) < {LONG} or {_overlaps(n, other, differ(*halves), percent)})"
        f" and (least({n}, {other}) < {LONGER} or {_overlaps(n, other, differ(*quarters), percent)})",
    )


def _overlaps(n: str, other: str, differ: str, percent: int) -> str:
    """Whether sets, ``differ`` of whose words at least are in one of them only, may share enough."""
    return f"{100 + percent} * ({n} + {other} - {differ}) >= {2 * percent} * ({n} + {other})"


def _ranked(lines: DataFrame, table: DataFrame | list[int], percent: int) -> DataFrame:
    """``doc, place, n, low, high, more, ranked``: each line with its rarest words, rarest first.

    ``table`` is what ``rarity`` gives, or its numbers. A word's number begins with its rarity, so
    that sorted numbers are in order of rarity; 40 bits of its hash follow, as words that share a
    number only make more candidates.
    """
    if isinstance(table, list):
        rare = F.expr(f"cast(split('{','.join(map(str, table))}', ',') as array<byte>)")
    else:
        rare = table.scalar()
    # Without nulls numbers are sorted as such, not as objects. They keep all the bits that maps are
    # made of and take the place of the words, so that Spark need not hold the table beside a row.
    known = f"cast(coalesce(get(rare, cast(w & {BUCKETS - 1} as int)), 0Y) as bigint)"
    number = f"shiftleft({known}, 40) | (w & {2**40 - 1})"
    lines = lines.select("doc", "place", "words", rare.alias("rare")).select(
        "doc", "place", F.expr(f"transform(words, w -> {number})").alias("words")
    )
    n = F.size("words")
    prefix = n - F.ceil(n * percent / 100).cast("int") + 1
    return lines.select(
        "doc",
        "place",
        n.alias("n"),
        F.expr(_LOW).alias("low"),
        F.expr(_HIGH).alias("high"),
        F.expr(_MORE).alias("more"),
        F.slice(F.sort_array("words"), F.lit(1), prefix).alias("ranked"),
    )


def _by_word(ranked: DataFrame) -> DataFrame:
    """``word, at, doc, place, n, low, high, more``: a post for each of a line's rarest words."""
    # Of a plain column Spark first filters the size, below the steps that make it, which works the
    # column out twice; a slice is left alone.
    words = F.slice("ranked", F.lit(1), F.size("ranked"))
    return ranked.select("doc", "place", "n", "low", "high", "more", F.posexplode(words).alias("at", "word"))


def _posts(lines: DataFrame, table: list[int], percent: int) -> DataFrame:
    """The posts of lines, in two steps: what stands beside an explode is worked out for every row."""
    return _by_word(_ranked(lines, table, percent))


def _with_near(posts: DataFrame, percent: int) -> DataFrame:
    """Adds ``near``, which of the ``NEAR`` posts before and the word's first one pass the filters,

    ``later``, whether the word has yet more posts before, and ``many``, whether any of its posts
    has. Conditions are spelt out per post, not in a lambda over an array, as only so they are
    compiled. The only post of a word meets none and goes.
    """
    order = Window.partitionBy("word").orderBy("doc", "place")
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    all_ = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    compared = NEAR + 2  # of the first so many posts, each has met all before
    # Plain columns and places in the window: structs and counts would be made anew for every post.
    each = ["doc", "place", "n", "low", "high", "more"]
    first = [F.nth_value(c, 1).over(so_far).alias(f"o0_{c}") for c in each]
    before = [F.lag(c, i).over(order).alias(f"o{i}_{c}") for i in range(1, NEAR + 1) for c in each]
    numbers = [
        F.nth_value("doc", 2).over(all_).isNotNull().alias("shared"),
        F.nth_value("doc", compared + 1).over(so_far).isNotNull().alias("later"),
        F.nth_value("doc", compared + 1).over(all_).isNotNull().alias("many"),
    ]
    told = [
        F.expr(
            f"if({o}_doc is not null and ({o}_doc <> doc or {o}_place <> place)"
            f" and {_may_match('{}', f'{o}_{{}}', 'get(more, {})', f'get({o}_more, {{}})', percent)},"
            f" struct({o}_doc as doc, {o}_place as place), null)"
        )
        for o in (f"o{i}" for i in range(NEAR + 1))
    ]
    return posts.select("*", *first, *before, *numbers).where("shared").select(
        *posts.columns, "later", "many", F.array_compact(F.array(*told)).alias("near")
    )


def _verified(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """``doc, place`` of the first line of each pair whose whole sets are alike enough.

    Wide maps of the named lines rule most pairs out before any set is sent to a pair. One match
    settles a line, so each is first compared with the line its map is nearest to; only lines
    that are not alike go on to their other pairs.
    """
    line = ["doc", "place"]
    first = pairs.select(*line)
    second = pairs.select(F.col("doc2").alias("doc"), F.col("place2").alias("place"))
    named = first.unionByName(second).distinct()
    found = _some_lines(texts, named, named.count()).dropDuplicates(line)
    sets = written(found.select("*", F.size("words").alias("n"), F.expr(_WIDE).alias("map")), "line-sets")
    maps = sets.select(*line, "n", "map")
    others = maps.select(*(F.col(c).alias(f"{c}2") for c in maps.columns))
    close = pairs.join(maps, line).join(others, ["doc2", "place2"]).withColumn("differ", F.expr(_DIFFER))
    close = close.where(_overlaps("n", "n2", "differ", percent))
    close = written(close.select(*line, "doc2", "place2", "differ"), "close-pairs")
    best = close.groupBy(*line).agg(F.min(F.struct("differ", "doc2", "place2")).alias("other"))
    best = best.select(*line, "other.doc2", "other.place2")
    settled = written(_alike(best, sets, percent), "alike-lines")
    rest = close.select(*best.columns).join(settled, line, "left_anti").join(best, best.columns, "left_anti")
    return settled.unionByName(_alike(rest, sets, percent))


def _alike(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """``doc, place`` of the first line of each pair whose sets are alike enough."""
    wanted = pairs.select(F.col("doc2").alias("doc"), F.col("place2").alias("place")).distinct()
    other = sets.join(wanted, ["doc", "place"], "left_semi").select(
        F.col("doc").alias("doc2"), F.col("place").alias("place2"), F.col("words").alias("words2")
    )
    both = pairs.join(sets, ["doc", "place"]).join(other, ["doc2", "place2"])
    common = F.size(F.array_intersect("words", "words2"))
    alike = 100 * common >= percent * (F.size("words") + F.size("words2") - common)
    return both.where(alike).select("doc", "place").distinct()


def _joined(posts: DataFrame, others: DataFrame, percent: int) -> DataFrame:
    """``doc, place, doc2, place2``: lines of ``posts`` and those of ``others`` under one word, later first.

    Side 1 is the line with more words. Side 2, of ``others``, has fewer and must share so many of
    them that the first shared one is among its very first; of lines with as many, 2 is the earlier.
    """

    def side(number: int, some: DataFrame) -> DataFrame:
        return some.select("word", *(F.col(c).alias(f"{c}{number}") for c in some.columns if c != "word"))

    front = others.where(f"{100 + percent} * (n - at) >= {2 * percent} * n")
    earlier = "(doc2 < doc1 or (doc2 = doc1 and place2 < place1))"
    later = "(doc2 > doc1 or (doc2 = doc1 and place2 > place1))"
    behind = f"{100 + percent} * least(n1 - at1, n2 - at2) >= {percent} * (n1 + n2)"
    short, long = _alike_maps("{}1", "{}2", "get(more1, {})", "get(more2, {})", percent)
    # All pairs under a word meet these few conditions; in one method with the others, they are slow.
    met = side(1, posts).join(side(2, front), "word").where(f"n2 <= n1 and {behind} and {short}")
    # A row's partition is not known beforehand, so the others stay behind the join.
    then = f"spark_partition_id() >= 0 and {long} and ({earlier} or n2 < n1 and {later})"
    ends = [
        F.expr(f"if({earlier}, {c}{a}, {c}{b})").alias(f"{c}{name}")
        for name, a, b in (("", 1, 2), ("2", 2, 1))
        for c in ("doc", "place")
    ]
    return met.where(f"if({then}, true, false)").select(*ends)


def repeated_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT
) -> DataFrame:
    """``doc, place`` (from 0) of every line to remove; null ids are given as the largest."""
    texts = docs.select(_key(id_col), F.col(text_col).alias("text"))
    keyed = written(_lines(texts, words=_KEYS).select("doc", "place", "words.*"), "line-keys")
    line = F.struct("doc", "place")
    sets = keyed.groupBy("k1", "k2").agg(F.min(line).alias("first"), F.count(F.lit(1)).alias("lines"))
    later = written(
        keyed.join(sets.where("lines > 1"), ["k1", "k2"])
        .where(F.col("first") < line)
        .select("doc", "place")
        .distinct(),
        "equal-lines",
    )
    n_later = later.count()
    table = rarity(texts)
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # Posts are shuffled once, in waves of documents that leave no shuffle files, as these would lie
    # beside the posts' table; what follows reads that by word.
    name = None
    for wave in range(WAVES):
        some = texts.where(f"pmod(xxhash64(doc, octet_length(text)), {WAVES}) = {wave}")
        made = _posts(_lines(some, (later, n_later)), table, percent).repartition(parts, "word")
        posts, name = bucketed(made, "line-posts", "word", parts, name)
    near = _with_near(posts.where(f"word >= {_CROWDED}"), percent)
    # One candidate a post, not always the first: a line's posts name different ones.
    close = near.where("size(near) > 0").select("doc", "place", F.expr("near[at % size(near)]").alias("o"))
    tried = written(
        close.select("doc", "place", F.col("o.doc").alias("doc2"), F.col("o.place").alias("place2")).distinct(),
        "near-pairs",
    )
    gone, pairs = later, _joined(posts, posts, percent)
    if tried.count() > 0:
        settled = written(_verified(tried, texts, percent).distinct(), "settled-lines")
        gone = gone.unionByName(settled)
        # Settled lines of a crowded word meet open ones only: they may be most of it. What pairs
        # they still are the later line of goes.
        done = _sent(settled, settled.count())
        few, many = posts.where(f"word < {_CROWDED}"), posts.where(f"word >= {_CROWDED}")
        open_, closed = (many.join(done, ["doc", "place"], f"left_{kind}") for kind in ("anti", "semi"))
        pairs = _joined(few, few, percent)
        for one, other in ((open_, many), (closed, open_)):
            pairs = pairs.unionByName(_joined(one, other, percent))
        pairs = pairs.join(done, ["doc", "place"], "left_anti")
    pairs = pairs.distinct().join(tried, tried.columns, "left_anti")
    pairs = written(pairs, "line-pairs")
    docs.sparkSession.sql(f"DROP TABLE {name}")
    return gone.unionByName(_verified(pairs, texts, percent)).distinct()


def remove_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT
) -> DataFrame:
    """The documents with repeated lines cut out of the text, and ``n_lines, n_removed``."""
    if others := clashing(docs, "_line_", [id_col, text_col]):
        renamed = docs.withColumnsRenamed(others)
        return restored(remove_lines(renamed, id_col, text_col, percent), others)
    gone = written(repeated_lines(docs, id_col, text_col, percent), "gone-lines")
    places = gone.groupBy(F.col("doc").alias("_line_doc")).agg(F.collect_set("place").alias("_line_gone"))
    lines = F.split(text_col, "\n")
    kept = F.filter(lines, lambda line, i: ~F.array_contains("_line_gone", i))
    marked = docs.withColumn("_line_doc", _key(id_col)).join(
        _sent(places, gone.count()), "_line_doc", "left"
    )
    cut = F.col("_line_gone").isNotNull()
    return marked.withColumns(
        {
            "n_lines": F.coalesce(F.size(lines), F.lit(0)).cast("long"),
            "n_removed": F.coalesce(F.size("_line_gone"), F.lit(0)).cast("long"),
            text_col: F.when(cut, F.array_join(kept, "\n")).otherwise(F.col(text_col)),
        }
    ).drop("_line_doc", "_line_gone")

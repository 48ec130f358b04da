"""Approximate nearest neighbours on robust-pruned directed graphs, one graph a shard.

Equal vectors are indexed as one point that keeps its members' smallest ids, as many as a result
can hold; so a vector that a third of all rows share is one point. Points are spread over shards
of about ``shard_size`` by digest. In a shard the graph is built by inserting all points in
random order, twice: a greedy search from the medoid visits points, the visited ones and the
present neighbours are candidates, and relaxed distance pruning keeps an edge only if no kept
edge leads ``alpha`` times nearer to its end. Reverse edges are added and pruned the same way.
A query's beam search runs on every shard; the shards' best are merged with a top-k per query.

Building and searching go in lockstep for a block of points, so that each step is one numpy
operation over the block. Distances that decide the result are in double precision.

Defined results: rows whose vector is null, empty, zero, or holds a null, NaN or infinite value
take no part, nor do rows without an id; vectors of another length than the most frequent one
are an error. A query never finds its own row; ties go to the smaller id; rows that repeat an id
are kept once per distinct vector. With fewer candidates than ``k`` all are returned. Empty
tables give an empty result. Only the columns named are read, so others cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

DEGREE = 32
BEAM = 96
ALPHA = 1.2
BLOCK = 256


def usable(vector: str) -> Column:
    """Whether a vector takes part: present, finite throughout, and not zero."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(fine & F.exists(vector, lambda x: x != 0), F.lit(False))


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of each row of ``a`` (n x d) to its rows of ``b`` (n x m x d)."""
    gap = b - a[:, None, :]
    return np.einsum("nmd,nmd->nm", gap, gap)


def beam_search(
    points: np.ndarray, edges: np.ndarray, entry: int, queries: np.ndarray, beam: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Greedy search of a block of queries in lockstep.

    Returns the beam's points and squared distances, nearest first (-1 and inf where it is not
    full), and the points each query expanded (-1 after the last).
    """
    n = len(queries)
    ids = np.full((n, beam), -1, np.int64)
    near = np.full((n, beam), np.inf)
    done = np.ones((n, beam), bool)
    ids[:, 0], done[:, 0] = entry, False
    near[:, 0] = _distances(queries, np.broadcast_to(points[entry], (n, 1, points.shape[1])))[:, 0]
    seen = np.zeros((n, len(points)), bool)
    seen[:, entry] = True
    expanded: list[np.ndarray] = []
    while True:
        live = np.flatnonzero((~done).any(axis=1))
        if not len(live):
            break
        at = (~done[live]).argmax(axis=1)  # beams are sorted: the nearest not yet expanded
        point = ids[live, at]
        done[live, at] = True
        step = np.full(n, -1, np.int64)
        step[live] = point
        expanded.append(step)
        fresh = edges[point]
        new = (fresh >= 0) & ~seen[live[:, None], np.maximum(fresh, 0)]
        r, c = np.nonzero(new)
        seen[live[r], fresh[r, c]] = True
        gap = np.full(fresh.shape, np.inf)
        delta = points[fresh[r, c]] - queries[live[r]]
        gap[r, c] = np.einsum("nd,nd->n", delta, delta)
        all_ids = np.concatenate([ids[live], np.where(new, fresh, -1)], axis=1)
        all_near = np.concatenate([near[live], gap], axis=1)
        all_done = np.concatenate([done[live], ~new], axis=1)
        order = np.argsort(all_near, axis=1, kind="stable")[:, :beam]
        ids[live] = np.take_along_axis(all_ids, order, axis=1)
        near[live] = np.take_along_axis(all_near, order, axis=1)
        done[live] = np.take_along_axis(all_done, order, axis=1)
    visited = np.stack(expanded, axis=1) if expanded else np.full((n, 1), -1, np.int64)
    return ids, near, visited


def robust_prune(
    points: np.ndarray, of: np.ndarray, candidates: np.ndarray, degree: int, alpha: float
) -> np.ndarray:
    """Up to ``degree`` diverse edges for each point of a block from its candidates (-1: none).

    Takes the nearest candidate, drops those it leads to (``alpha`` times nearer than the point
    itself is to them), and goes on.
    """
    candidates = np.sort(candidates, axis=1)[:, ::-1]
    repeat = np.zeros(candidates.shape, bool)
    repeat[:, 1:] = candidates[:, 1:] == candidates[:, :-1]
    out_of = (candidates < 0) | repeat | (candidates == of[:, None])
    places = points[np.maximum(candidates, 0)]
    near = np.where(out_of, np.inf, _distances(points[of], places))
    kept = np.full((len(of), degree), -1, np.int64)
    left = near.copy()
    rows = np.arange(len(of))
    for k in range(degree):
        best = left.argmin(axis=1)
        some = np.isfinite(left[rows, best])
        if not some.any():
            break
        kept[some, k] = candidates[rows, best][some]
        left[rows, best] = np.inf
        between = _distances(places[rows, best], places)
        left[some[:, None] & (alpha * alpha * between <= near)] = np.inf
    return kept


def build(
    points: np.ndarray, degree: int = DEGREE, beam: int = BEAM, alpha: float = ALPHA, seed: int = 5
) -> tuple[np.ndarray, int]:
    """Edges (points x degree, -1: none) and the entry point of a shard's graph."""
    n = len(points)
    entry = int(_distances(points.mean(axis=0)[None], points[None])[0].argmin())
    edges = np.full((n, degree), -1, np.int64)
    random = np.random.default_rng(seed)
    if n > 1:  # a random start keeps the graph connected while it fills
        edges[:, : min(degree, n - 1)] = random.integers(0, n, (n, min(degree, n - 1)))
    for relaxed in (1.0, alpha):
        order = random.permutation(n)
        for at in range(0, n, BLOCK):
            block = order[at : at + BLOCK]
            found, _, visited = beam_search(points, edges, entry, points[block], beam)
            pool = np.concatenate([visited, found, edges[block]], axis=1)
            edges[block] = robust_prune(points, block, pool, degree, relaxed)
            _add_reverse(points, edges, block, degree, relaxed)
    return edges, entry


def _add_reverse(
    points: np.ndarray, edges: np.ndarray, block: np.ndarray, degree: int, alpha: float
) -> None:
    """Give each new edge its reverse; points whose edges overflow are pruned anew."""
    source = np.repeat(block, degree)
    target = edges[block].ravel()
    source, target = source[target >= 0], target[target >= 0]
    order = np.argsort(target, kind="stable")
    source, target = source[order], target[order]
    touched, first, count = np.unique(target, return_index=True, return_counts=True)
    for at in range(0, len(touched), BLOCK):
        some = slice(at, at + BLOCK)
        widest = int(count[some].max())
        extra = np.full((len(touched[some]), widest), -1, np.int64)
        for i, (f, c) in enumerate(zip(first[some], count[some])):
            extra[i, :c] = source[f : f + c]
        pool = np.concatenate([edges[touched[some]], extra], axis=1)
        edges[touched[some]] = robust_prune(points, touched[some], pool, degree, alpha)


def _rows(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    return df.where(usable(vector_col) & F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("id"),
        F.transform(vector_col, lambda x: x.cast("double") + F.lit(0.0)).alias("vector"),
    )


def shards_for(vectors: DataFrame, shard_size: int = 4096) -> int:
    """How many shards of about ``shard_size`` points a table needs."""
    return max(1, -(-vectors.count() // shard_size))


def index(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    k: int = 10,
    shards: int = 1,
) -> DataFrame:
    """``shard, place, ids, vector, edges, entry``: one row a distinct vector.

    ``ids`` are the ``k + 1`` smallest ids with that vector, enough for any result; ``edges``
    are places in the same shard.
    """
    rows = _rows(vectors, id_col, vector_col)
    # The engine keeps k + 1 rows of a vector per task before it shuffles them.
    order = Window.partitionBy("vector").orderBy("id")
    first = rows.withColumn("n", F.dense_rank().over(order)).where(F.col("n") <= k + 1)
    points = first.groupBy("vector").agg(F.sort_array(F.collect_set("id")).alias("ids"))
    placed = points.withColumn("shard", F.pmod(F.xxhash64(F.lit(3), "vector"), F.lit(shards)).cast("int"))

    def graph(shard: pa.Table) -> pa.Table:
        shard = shard.sort_by("smallest")
        vectors = _matrix(shard.column("vector"))
        edges, entry = build(vectors.astype(np.float32))
        return pa.table(
            {
                "shard": shard.column("shard"),
                "place": pa.array(np.arange(len(vectors), dtype=np.int32)),
                "ids": shard.column("ids").cast(pa.list_(pa.int64())),
                "vector": shard.column("vector").cast(pa.list_(pa.float64())),
                "edges": pa.array(list(edges.astype(np.int32)), pa.list_(pa.int32())),
                "entry": pa.array(np.full(len(vectors), entry, np.int32)),
            }
        )

    schema = "shard int, place int, ids array<long>, vector array<double>, edges array<int>, entry int"
    placed = placed.withColumn("smallest", F.get("ids", F.lit(0)))
    return placed.groupBy("shard").applyInArrow(graph, schema)


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    lists = column.combine_chunks()
    if isinstance(lists, pa.ChunkedArray):
        lists = pa.concat_arrays(lists.chunks)
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    if len(flat) % max(len(lists), 1):
        raise ValueError("vectors differ in length")
    return flat.reshape(len(lists), -1)


def search(
    graphs: DataFrame,
    queries: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    k: int = 10,
    shards: int = 1,
    beam: int = BEAM,
    query_block: int = 20_000,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the nearest of an index for each query row.

    Every query goes to every shard; a task holds one shard's graph and one block of queries,
    and ``k`` rows a query and shard come back.
    """
    asked = _rows(queries, id_col, vector_col)
    blocks = max(1, -(-queries.count() // query_block))
    block = F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int")
    every = F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))
    asked = asked.withColumn("block", block).withColumn("shard", every)
    spread = graphs.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    def meet(graph: pa.Table, asking: pa.Table) -> pa.Table:
        found: dict[str, list] = {"query_id": [], "vec_id": [], "score": []}
        if graph.num_rows and asking.num_rows:
            graph = graph.sort_by("place")
            points, wanted = _matrix(graph.column("vector")), _matrix(asking.column("vector"))
            if points.shape[1] != wanted.shape[1]:
                raise ValueError("vectors differ in length")
            edges = np.stack(graph.column("edges").to_numpy())
            ids, entry = graph.column("ids").to_pylist(), graph.column("entry")[0].as_py()
            own = asking.column("id").to_pylist()
            small = points.astype(np.float32)
            for at in range(0, len(own), BLOCK):
                near, _, _ = beam_search(
                    small, edges, entry, wanted[at : at + BLOCK].astype(np.float32), beam
                )
                for i, row in enumerate(near, at):
                    row = row[row >= 0]
                    gap = np.sqrt(((points[row] - wanted[i]) ** 2).sum(axis=1)).tolist()
                    hits = sorted(
                        (g, v) for g, p in zip(gap, row) for v in ids[p] if v != own[i]
                    )
                    for g, v in hits[:k]:
                        found["query_id"].append(own[i])
                        found["vec_id"].append(v)
                        found["score"].append(g)
        return pa.table(found, schema=_FOUND)

    hits = (
        spread.groupBy("shard", "block")
        .cogroup(asked.groupBy("shard", "block"))
        .applyInArrow(meet, "query_id long, vec_id long, score double")
        .distinct()
    )
    best = Window.partitionBy("query_id").orderBy("score", "vec_id")
    ranked = hits.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


_FOUND = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])

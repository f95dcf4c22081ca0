"""Nearest neighbours by robust-pruned directed graphs in each shard, searched with a beam.

Inner products become distances by one more coordinate, which works well for vectors of about one
length. So a shard has a graph for each band of lengths. A query searches the bands from the longest
down and stops where the product of the lengths cannot reach its k-th score any more.
"""

from __future__ import annotations

import pickle

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.shared import stored
from .common import column

NEIGHBOURS = 20
DEGREE = 32
BUILD_BEAM = 64
SEARCH_BEAM = 160
ALPHA = 1.2  # a neighbour is dropped if a kept one is this many times nearer to it
SHARD_ROWS = 16_384
BAND = 1.1  # the longest vector of a graph is at most this many times as long as the shortest
BAND_ROWS = 128  # but a graph has as many points at least; fewer than the beam, which meets them all
QUERY_BLOCK = 1_024
BLOCKS_PER_GRAPH = 16  # query blocks that one copy of a graph serves
STEP = 512  # points that look for neighbours at once


def augmented(vectors: np.ndarray) -> np.ndarray:
    """Vectors with one more number, all of one length: nearest then means largest inner product."""
    norms = np.einsum("ij,ij->i", vectors, vectors)
    more = np.sqrt(np.maximum(0, norms.max(initial=0) - norms))
    return np.concatenate([vectors, more[:, None]], 1)


def beam_search(points: np.ndarray, edges: np.ndarray, entries: np.ndarray, queries: np.ndarray, beam: int):
    """The ``beam`` nearest points each greedy search meets, nearest first, and their distances.

    A search begins at the entries nearest to the query, as many as its beam holds. All queries take
    a step at a time: each opens the nearest unopened point of its beam. -1 fills the beams of small
    graphs. Distances are squared, less the square of the query.
    """
    n, degree = len(queries), edges.shape[1]
    square = np.einsum("ij,ij->i", points, points)
    rows = np.arange(n)
    seen = np.zeros((n, len(points)), bool)
    seen[:, entries] = True
    ids = np.full((n, beam), -1, np.int32)
    far = np.full((n, beam), np.inf, np.float32)
    opened = np.zeros((n, beam), bool)
    first = square[entries] - 2 * (queries @ points[entries].T)
    near = np.argsort(first, 1, kind="stable")[:, :beam]
    ids[:, : near.shape[1]] = entries[near]
    far[:, : near.shape[1]] = first[rows[:, None], near]
    active = rows
    while len(active):
        waiting = np.where(opened[active] | (ids[active] < 0), np.inf, far[active])
        place = waiting.argmin(1)
        left = np.isfinite(waiting[np.arange(len(active)), place])
        active, place = active[left], place[left]
        if not len(active):
            break
        opened[active, place] = True
        new = edges[ids[active, place]]
        fresh = (new >= 0) & ~seen[active[:, None], new]
        seen[active[:, None], np.where(fresh, new, entries[0])] = True
        d = square[new] - 2 * np.einsum("ij,ikj->ik", queries[active], points[new])
        all_far = np.concatenate([far[active], np.where(fresh, d, np.inf)], 1)
        all_ids = np.concatenate([ids[active], np.where(fresh, new, -1)], 1)
        all_open = np.concatenate([opened[active], np.zeros((len(active), degree), bool)], 1)
        best = np.argsort(all_far, 1, kind="stable")[:, :beam]
        at = np.arange(len(active))[:, None]
        far[active], ids[active], opened[active] = all_far[at, best], all_ids[at, best], all_open[at, best]
        ids[~np.isfinite(far)] = -1
    return ids, far


def pruned(points: np.ndarray, own: np.ndarray, candidates: np.ndarray, degree: int, alpha: float) -> np.ndarray:
    """Robust pruning for many points at once: candidates nearest first, then only diverse ones.

    A candidate stays unless one kept before it is ``alpha`` times nearer to it than the point is.
    """
    rows = np.arange(len(own))[:, None]
    good = (candidates >= 0) & (candidates != own[:, None])
    c = np.where(good, candidates, 0)
    near = points[c]
    d = ((near - points[own][:, None, :]) ** 2).sum(2)
    d[~good] = np.inf
    order = np.argsort(d, 1, kind="stable")
    c, d, near = c[rows, order], d[rows, order], near[rows, order]
    square = (near**2).sum(2)
    between = square[:, :, None] + square[:, None, :] - 2 * near @ near.transpose(0, 2, 1)
    alive = np.isfinite(d)
    alive[:, 1:] &= ~((c[:, 1:] == c[:, :-1]) & alive[:, :-1])
    kept = np.full((len(own), degree), -1, np.int32)
    for k in range(degree):
        first = alive.argmax(1)
        some = alive[rows[:, 0], first]
        if not some.any():
            break
        kept[some, k] = c[rows[:, 0], first][some]
        alive &= ~(some[:, None] & (alpha**2 * between[rows[:, 0], first] <= d))
        alive[rows[:, 0], first] = False
    return kept


def build_graph(points: np.ndarray, degree: int = DEGREE, beam: int = BUILD_BEAM, alpha: float = ALPHA):
    """Edges and entries. Two rounds: first with plain, then with relaxed distance pruning.

    Points propose neighbours by a greedy search on the graph so far, a block of them at a time;
    what points to them is added in return and pruned where it is too much. Entries are the middle
    point, some points at random, and one for each part that no other entry leads to: every point
    can be reached.
    """
    n = len(points)
    rng = np.random.default_rng(n)
    middle = int(((points - points.mean(0)) ** 2).sum(1).argmin())
    edges = np.full((n, degree), -1, np.int32)
    if n <= 1:
        return edges, np.array([middle])
    entries = np.unique(np.r_[middle, rng.permutation(n)[: int(4 * n**0.5)]])
    some = min(degree, n - 1)
    edges[:, :some] = (np.arange(n)[:, None] + 1 + rng.integers(0, n - 1, (n, some))) % n
    for relaxed in (1.0, alpha):
        order = rng.permutation(n)
        for i in range(0, n, STEP):
            own = order[i : i + STEP]
            found, _ = beam_search(points, edges, entries, points[own], beam)
            edges[own] = pruned(points, own, np.concatenate([found, edges[own]], 1), degree, relaxed)
            _point_back(points, edges, own, degree, relaxed)
    return edges, with_unreached(edges, entries)


def with_unreached(edges: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """The entries and, while there are points that none of them leads to, the first of these."""
    reached = np.zeros(len(edges), bool)
    more: list[int] = []
    new = entries
    while len(new):
        reached[new] = True
        new = np.unique(edges[new])
        new = new[new >= 0]
        new = new[~reached[new]]
        if not len(new) and not reached.all():
            more.append(int(reached.argmin()))
            new = np.array(more[-1:])
    return np.r_[entries, np.array(more, entries.dtype)]


def bands(vectors: np.ndarray, ratio: float = BAND, least: int = BAND_ROWS) -> list[np.ndarray]:
    """Rows of the vectors by falling length, cut where a length falls below that of the band's first.

    A band with fewer than ``least`` rows goes on beyond that.
    """
    norms = np.sqrt(np.einsum("ij,ij->i", vectors, vectors))
    order = np.argsort(-norms, kind="stable")
    falling = norms[order]
    out, a = [], 0
    while a < len(order):
        b = max(int(np.searchsorted(-falling, -falling[a] / ratio, "right")), a + least)
        out.append(order[a:b])
        a = b
    return out


def _point_back(points: np.ndarray, edges: np.ndarray, own: np.ndarray, degree: int, alpha: float) -> None:
    to, back = edges[own].ravel(), np.repeat(own, degree)
    to, back = to[to >= 0], back[to >= 0]
    order = np.argsort(to, kind="stable")
    to, back = to[order], back[order]
    first = np.flatnonzero(np.r_[True, to[1:] != to[:-1]])
    place = np.arange(len(to)) - np.repeat(first, np.diff(np.r_[first, len(to)]))
    for low in range(0, int(place.max(initial=-1)) + 1, degree):  # as many in return at a time as a point has edges
        part = (place >= low) & (place < low + degree)
        targets, row = np.unique(to[part], return_inverse=True)
        more = np.full((len(targets), degree), -1, np.int32)
        more[row, place[part] - low] = back[part]
        for i in range(0, len(targets), STEP):
            t = targets[i : i + STEP]
            edges[t] = pruned(points, t, np.concatenate([edges[t], more[i : i + STEP]], 1), degree, alpha)


def _usable(df: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """Rows with an id and a vector that is neither zero nor holds null or non-finite numbers."""
    v = F.transform(column(vector), lambda x: x.cast("double"))
    rows = df.select(column(vec_id).alias("vec_id"), v.alias("v"))
    return rows.where(
        F.col("vec_id").isNotNull() & F.col("v").isNotNull()
        & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists("v", lambda x: x != 0)
    )


def build_index(
    vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", k: int = NEIGHBOURS,
    shard_rows: int = SHARD_ROWS,
) -> DataFrame:
    """``shard, graph``: one graph for about ``shard_rows`` different vectors, stored.

    Every usable row is indexed. Equal vectors are one point that carries its k + 1 smallest ids:
    no result of k neighbours can hold more of them, one of which may be the query's own.
    """
    first = Window.partitionBy("v").orderBy("vec_id")
    members = (
        _usable(vectors, vec_id, vector)
        .withColumn("n", F.dense_rank().over(first)).where(F.col("n") <= k + 1)
        .groupBy("v").agg(F.sort_array(F.collect_set("vec_id")).alias("ids"))
    )
    points = stored(members, "graph-points")
    shards = max(1, -(-points.count() // shard_rows))
    keyed = points.withColumn("shard", F.pmod(F.xxhash64("v"), F.lit(shards)).cast("int"))

    def build(group: pa.Table) -> pa.Table:
        rows = sorted(zip(group["ids"].to_pylist(), group["v"].to_pylist()))
        graphs = []
        for size in sorted({len(v) for _, v in rows}):  # vectors of one length are compared only
            own = [(i, v) for i, v in rows if len(v) == size]
            every = np.array([v for _, v in own], float)
            for band in bands(every):
                exact = every[band]
                # Scaled by the longest, as float32 cannot hold the squares of all doubles.
                x = augmented(exact / np.abs(exact).max()).astype(np.float32)
                graphs.append((size, [own[i][0] for i in band.tolist()], exact, x, *build_graph(x)))
        out = pickle.dumps(graphs)
        return pa.table({"shard": group["shard"][:1], "graph": pa.array([out], pa.binary())})

    # A number of partitions of its own: otherwise few large graphs would be built by one task.
    apart = keyed.repartition(4 * shards, "shard")
    return stored(apart.groupBy("shard").applyInArrow(build, "shard int, graph binary"), "graph-index")


def search_index(
    index: DataFrame, queries: DataFrame, vec_id: str = "vec_id", vector: str = "embedding",
    k: int = NEIGHBOURS, beam: int = SEARCH_BEAM, block: int = QUERY_BLOCK,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k nearest each query finds over all shards.

    Queries go through every shard in blocks; a task holds the graphs of one shard, and the blocks
    pass by. Nearness is the inner product of the original vectors in double precision, ties go to
    the smaller id, and a query's own id is no neighbour. All points of a graph can be reached, so a
    query gets k neighbours, or all there are if fewer. Unusable queries have no rows; of several
    vectors of one query id the smallest is searched. Vectors of another length in numbers are no
    neighbours.
    """
    usable = _usable(queries, vec_id, vector).groupBy("vec_id").agg(F.min("v").alias("v"))
    usable = stored(usable, "graph-queries")
    kind = dict(usable.dtypes)["vec_id"]
    blocks = max(1, -(-usable.count() // block))
    copies = -(-blocks // BLOCKS_PER_GRAPH)
    shards = (index.agg(F.max("shard")).first()[0] or 0) + 1
    packed = (
        usable.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int"))
        .groupBy("block").agg(F.collect_list(F.struct("vec_id", "v")).alias("queries"))
    )
    # The graphs of a shard, one copy for some blocks, come before these blocks.
    none = F.lit(None)
    graphs = index.select(
        "shard", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))).alias("copy"), F.lit(0).alias("turn"), "graph",
        none.cast(packed.schema["queries"].dataType).alias("queries"),
    )
    every_block = packed.select(
        F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"),
        F.pmod("block", F.lit(copies)).cast("int").alias("copy"), F.lit(1).alias("turn"),
        none.cast("binary").alias("graph"), "queries",
    )
    laid_out = (
        graphs.union(every_block).repartition(4 * copies * shards, "shard", "copy")
        .sortWithinPartitions("shard", "copy", "turn")
    )
    beam = max(beam, k + 1)

    def search(batches):
        here, held = None, []
        for batch in batches:
            types = (batch.schema.field("queries").type.value_type.field(0).type,) * 2 + (pa.float64(),)
            for shard, group, raw in zip(batch["shard"].to_pylist(), batch["queries"], batch["graph"]):
                if raw.is_valid:
                    here, held = shard, pickle.loads(raw.as_py())
                if raw.is_valid or shard != here:  # a graph, or a block for a shard without points
                    continue
                out: tuple[list, list, list] = ([], [], [])
                rows = group.as_py()
                for size in {g[0] for g in held}:
                    own = [(r["vec_id"], r["v"]) for r in rows if len(r["v"]) == size]
                    graphs = [g[1:] for g in held if g[0] == size]
                    for i in range(0, len(own), STEP):
                        _nearest(own[i : i + STEP], graphs, k, beam, out)
                if out[0]:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(out, types)], names=["query_id", "vec_id", "score"]
                    )

    found = laid_out.select("shard", "queries", "graph").mapInArrow(search, f"query_id {kind}, vec_id {kind}, score double")
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    distinct = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return distinct.select("query_id", "rank", "vec_id", "score")


def _nearest(queries, graphs, k, beam, out) -> None:
    """Add the k best of all graphs to ``out``. Graphs come by falling length of their vectors."""
    q = np.array([v for _, v in queries], float)
    lengths = np.sqrt(np.einsum("ij,ij->i", q, q))
    scaled = q / np.abs(q).max(1)[:, None]  # the order of the products stays; float32 holds them
    wide = np.concatenate([scaled, np.zeros((len(q), 1))], 1).astype(np.float32)
    best: list[list[tuple]] = [[] for _ in queries]
    least = np.full(len(q), -np.inf)  # each query's k-th score
    for ids, exact, points, edges, entries in graphs:
        longest = float(np.sqrt((exact**2).sum(1).max()))
        # A little more than the lengths' product, for its rounding.
        some = np.flatnonzero(~(lengths * longest * (1 + 1e-9) < least))
        if not len(some):
            break
        found, _ = beam_search(points, edges, entries, wide[some], beam)
        for i, near in zip(some.tolist(), found):
            near = near[near >= 0]
            scores = (exact[near] * q[i]).sum(1)
            own, query = best[i], queries[i][0]
            new: list[tuple] = []
            for j in np.argsort(-scores, kind="stable"):
                if scores[j] < least[i] or (len(new) >= k and scores[j] < new[k - 1][0]):
                    break
                new += [(scores[j], m) for m in ids[near[j]] if m != query]
            best[i] = own = sorted(own + new, key=lambda b: (-b[0], b[1]))[:k]
            if len(own) == k:
                least[i] = own[-1][0]
    for (query, _), own in zip(queries, best):
        for score, m in own:
            for column, value in zip(out, (query, m, float(score))):
                column.append(value)

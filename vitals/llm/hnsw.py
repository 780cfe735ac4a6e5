"""Approximate nearest neighbours: one hierarchical navigable small-world graph per shard.

Rows are dealt to shards by a hash of id and vector. A shard keeps each distinct
vector once, with the ids that carry it, so copies cannot crowd a graph. Its
graph is a stack of layers of flat neighbour arrays; a vector reaches a layer
by a hash, each layer having about one in ``DEGREE`` of the one below. Points
are put in batch by batch: a batch looks for its neighbours in what is there
and within itself, then links both ways, keeping diverse neighbours.

For the inner product, vectors get one more component that makes all norms of
the shard equal; a query has 0 there, so the order of inner products stays
and the graph is built on distances that obey the triangle inequality.

Queries come in blocks, each block is searched in every shard, and the best of
all shards are merged. Results are scored again on the original vectors. A
query's own row is known by its id and its very vector, so other vectors under
its id are candidates like any others.
"""

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window as W, functions as F

from vitals.llm.common import mix64, stored

SHARD_ROWS = 16_384
BLOCK_ROWS = 8_192
DEGREE = 16
BUILD_WIDTH = 48
SEARCH_WIDTH = 128
TOP = 20


def _beam(points, links, queries, entry, width):
    """For all queries at once: best-first search with a beam; returns (ids, scores) best first, -1 where unused."""
    q, n = len(queries), len(points)
    ids = np.full((q, width), -1, np.int32)
    scores = np.full((q, width), -np.inf, np.float32)
    done = np.zeros((q, width), bool)
    seen = np.zeros((q, n), bool)
    entry = entry.reshape(q, -1)
    first = entry.shape[1]
    got = np.einsum("qed,qd->qe", points[entry], queries)
    order = np.argsort(-got, 1, kind="stable")[:, :width]
    ids[:, :min(first, width)] = np.take_along_axis(entry, order, 1)
    scores[:, :min(first, width)] = np.take_along_axis(got, order, 1)
    seen[np.arange(q)[:, None], entry] = True
    active = np.arange(q)
    while len(active):
        open_scores = np.where(done[active] | (ids[active] < 0), -np.inf, scores[active])
        pick = open_scores.argmax(1)
        more = open_scores[np.arange(len(active)), pick] > -np.inf
        active, pick = active[more], pick[more]
        if not len(active):
            break
        done[active, pick] = True
        near = links[ids[active, pick]]
        fresh = (near >= 0) & ~seen[active[:, None], near]
        rows, columns = np.nonzero(fresh)
        targets = near[rows, columns]
        seen[active[rows], targets] = True
        found = np.full(near.shape, -np.inf, np.float32)
        found[rows, columns] = np.einsum("rd,rd->r", points[targets], queries[active[rows]])
        all_scores = np.hstack([scores[active], found])
        best = np.argpartition(-all_scores, width - 1, 1)[:, :width] if all_scores.shape[1] > width else np.argsort(-all_scores, 1)
        scores[active] = np.take_along_axis(all_scores, best, 1)
        ids[active] = np.take_along_axis(np.hstack([ids[active], np.where(fresh, near, -1)]), best, 1)
        done[active] = np.take_along_axis(np.hstack([done[active], np.zeros_like(fresh)]), best, 1)
    order = np.argsort(-scores, 1, kind="stable")
    return np.take_along_axis(ids, order, 1), np.take_along_axis(scores, order, 1)


def _diverse(points, at, ids, scores, degree):
    """Of each point's candidates (best first) those nearer to it than to one kept before, then the best others."""
    q, c = ids.shape
    kept = np.zeros((q, c), bool)
    valid = (ids >= 0) & (ids != at[:, None])
    vectors = points[np.maximum(ids, 0)]
    nearest_kept = np.full((q, c), -np.inf, np.float32)
    for j in range(c):
        take = valid[:, j] & (scores[:, j] > nearest_kept[:, j]) & (kept.sum(1) < degree)
        kept[:, j] = take
        if j + 1 < c and take.any():
            to_this = np.einsum("qcd,qd->qc", vectors[take, j + 1:], vectors[take, j])
            nearest_kept[take, j + 1:] = np.maximum(nearest_kept[take, j + 1:], to_this)
    rank = np.where(kept, 0, np.where(valid, 1, 2)) * c + np.arange(c)
    order = np.argsort(rank, 1)[:, :degree]
    chosen = np.where(np.take_along_axis(valid, order, 1), np.take_along_axis(ids, order, 1), -1)
    return np.pad(chosen, ((0, 0), (0, degree - chosen.shape[1])), constant_values=-1)


def _layer(points, degree):
    """Neighbour array of one layer, built batch by batch."""
    n = len(points)
    links = np.full((n, degree), -1, np.int32)
    start = 0
    while start < n:
        stop = min(n, start + max(32, min(512, start)))
        batch = np.arange(start, stop, dtype=np.int32)
        own = points[batch] @ points[batch].T
        np.fill_diagonal(own, -np.inf)
        most = min(BUILD_WIDTH, len(batch) - 1)
        inside = np.argsort(-own, 1, kind="stable")[:, :most]
        ids, scores = batch[inside], np.take_along_axis(own, inside, 1)
        if start:
            seeds = _entries(start, len(batch))
            far_ids, far_scores = _beam(points[:start], links[:start], points[batch], seeds, BUILD_WIDTH)
            ids, scores = np.hstack([ids, far_ids]), np.hstack([scores, far_scores])
            order = np.argsort(-scores, 1, kind="stable")[:, :BUILD_WIDTH]
            ids, scores = np.take_along_axis(ids, order, 1), np.take_along_axis(scores, order, 1)
        links[batch] = _diverse(points, batch, ids, scores, degree)
        # links back: each target chooses anew among its links and the newcomers
        rows, columns = np.nonzero(links[batch] >= 0)
        targets, newcomers = links[batch][rows, columns], batch[rows]
        order = np.argsort(targets, kind="stable")
        targets, newcomers = targets[order], newcomers[order]
        unique, first, count = np.unique(targets, return_index=True, return_counts=True)
        for low in range(0, len(unique), 1024):
            part = slice(low, low + 1024)
            width = count[part].max()
            offsets = np.arange(width)
            inside = offsets < count[part][:, None]
            extra = np.where(inside, newcomers[np.minimum(first[part][:, None] + offsets, len(newcomers) - 1)], -1)
            both = np.hstack([links[unique[part]], extra])
            both = np.sort(both, 1)
            both[:, 1:][both[:, 1:] == both[:, :-1]] = -1
            near = np.where(both >= 0, np.einsum("qcd,qd->qc", points[np.maximum(both, 0)], points[unique[part]]), -np.inf)
            order = np.argsort(-near, 1, kind="stable")[:, :3 * degree]
            links[unique[part]] = _diverse(points, unique[part], np.take_along_axis(both, order, 1), np.take_along_axis(near, order, 1), degree)
        start = stop
    return links


def _entries(n, q):
    """The same few spread entry points for every query."""
    few = np.unique(np.linspace(0, n - 1, min(n, 8)).astype(np.int32))
    return np.tile(few, (q, 1))


def build(ids: np.ndarray, vectors: np.ndarray) -> dict:
    """The index of one shard: distinct vectors, their ids, layers of flat neighbour arrays."""
    distinct, inverse = np.unique(vectors, axis=0, return_inverse=True)
    inverse = inverse.ravel()
    # a hash order, so that any first part of the points is a fair sample: the layers above are first parts
    turn = np.argsort(mix64(np.arange(len(distinct), dtype=np.uint64)), kind="stable")
    place = np.empty(len(turn), np.int64)
    place[turn] = np.arange(len(turn))
    distinct, inverse = distinct[turn], place[inverse]
    order = np.lexsort((ids, inverse))
    starts = np.searchsorted(inverse[order], np.arange(len(distinct) + 1))
    wide = distinct / np.abs(distinct).max()  # no square of a large component overflows
    norms = (wide ** 2).sum(1)
    points = np.hstack([wide, np.sqrt(np.maximum(norms.max() - norms, 0))[:, None]])
    points = (points / np.sqrt(norms.max())).astype(np.float32)
    sizes = [len(points)]
    while sizes[-1] > 4 * DEGREE:
        sizes.append(sizes[-1] // DEGREE)
    layers = [_layer(points[:n], 2 * DEGREE if i == 0 else DEGREE) for i, n in enumerate(sizes)]
    return {"points": points, "ids": ids[order], "originals": vectors[order], "starts": starts, "layers": layers}


def search(index: dict, queries: np.ndarray, own_ids: np.ndarray, top: int, width: int):
    """What the graph finds for each query but its own row: (query row, id, place among the index's ids)."""
    points, layers = index["points"], index["layers"]
    wide = np.zeros((len(queries), points.shape[1]), np.float32)
    level = queries / np.abs(queries).max(1, keepdims=True)
    wide[:, :-1] = level / np.linalg.norm(level, axis=1, keepdims=True)
    entry = _entries(len(layers[-1]), len(queries))
    for links in layers[:0:-1]:
        entry = np.maximum(_beam(points[:len(links)], links, wide, entry, 8)[0], entry[:, :1])
    found, _ = _beam(points, layers[0], wide, entry, max(width, top + 1))
    rows, columns = np.nonzero(found >= 0)
    members = found[rows, columns]
    # of one vector's ids, which tie, the smallest can be wanted only: one more than asked, as the query's own is left out
    count = np.minimum(index["starts"][members + 1] - index["starts"][members], top + 1)
    rows, at = np.repeat(rows, count), np.repeat(index["starts"][members], count)
    at = at + np.arange(len(at)) - np.repeat(np.cumsum(count) - count, count)
    ids = index["ids"][at]
    own = np.flatnonzero(ids == own_ids[rows])
    own = own[(index["originals"][at[own]] == queries[rows[own]]).all(1)]
    other = np.ones(len(ids), bool)
    other[own] = False
    return rows[other], ids[other], at[other]


def usable(vector):
    """Vectors that take part: no null or non-finite component, not all zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0)


def nearest(
    vectors: DataFrame, every: int = 20, top: int = TOP, vec_id="vec_id", vector="embedding",
    shard_rows: int = SHARD_ROWS, width: int = SEARCH_WIDTH,
) -> DataFrame:
    """``query_id, rank, vec_id, score, query_sha256``: the ``top`` nearest others of each row whose id is divisible by ``every``.

    Null ids and unusable vectors take no part. Vectors are compared with
    those of the same length only. Rows that repeat both id and vector count
    once. Several vectors under one id are rows of their own: each is a
    candidate for all others, and where the id is a query's, each has its own
    ranks, told apart by ``query_sha256`` (of the vector as little-endian
    doubles). An infinite inner product is first or last by its sign, one that
    is no number last. With fewer candidates than ``top`` all found are given;
    without any, none.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("vector"))
    rows = rows.filter(F.col("vec_id").isNotNull() & usable(F.col("vector"))).dropDuplicates()
    rows = stored(rows.withColumn("dim", F.size("vector")), "hnsw-rows")
    counts = rows.count()
    shards = max(1, -(-counts // shard_rows))
    rows = rows.withColumn("shard", F.pmod(F.xxhash64("vec_id", "vector"), F.lit(shards)).cast("int"))

    def indexed(pdf: pd.DataFrame) -> pd.DataFrame:
        matrix = np.stack(pdf["vector"].to_numpy()).astype(np.float64)
        index = build(pdf["vec_id"].to_numpy(np.int64), matrix)
        return pd.DataFrame({
            "shard": [int(pdf["shard"].iloc[0])], "dim": [matrix.shape[1]], "points": [index["points"].tobytes()],
            "ids": [index["ids"].astype(np.int64).tobytes()], "starts": [index["starts"].astype(np.int64).tobytes()],
            "originals": [index["originals"].tobytes()], "layers": [[l.tobytes() for l in index["layers"]]],
        })

    index = stored(rows.groupBy("shard", "dim").applyInPandas(
        indexed, "shard int, dim int, points binary, ids binary, starts binary, originals binary, layers array<binary>"), "hnsw-index")
    queries = rows.filter(F.pmod("vec_id", F.lit(every)) == 0)
    blocks = max(1, -(-counts // (every * BLOCK_ROWS)))
    queries = queries.select("vec_id", "vector", "dim", F.pmod(F.xxhash64("vec_id", "vector", F.lit(1)), F.lit(blocks)).cast("int").alias("block"))
    left = index.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    right = queries.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))

    def searched(shard: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
        empty = pd.DataFrame({"query_id": np.empty(0, np.int64), "query_sha256": np.empty(0, object), "vec_id": np.empty(0, np.int64), "score": np.empty(0)})
        if not len(shard) or not len(block):
            return empty
        row = shard.iloc[0]
        dim = int(row["dim"])
        points = np.frombuffer(row["points"], np.float32).reshape(-1, dim + 1)
        layers = [np.frombuffer(l, np.int32).reshape(-1, 2 * DEGREE if i == 0 else DEGREE) for i, l in enumerate(row["layers"])]
        found = {"points": points, "ids": np.frombuffer(row["ids"], np.int64), "starts": np.frombuffer(row["starts"], np.int64), "layers": layers}
        originals = found["originals"] = np.frombuffer(row["originals"], np.float64).reshape(-1, dim)
        matrix = np.stack(block["vector"].to_numpy()).astype(np.float64)
        own = block["vec_id"].to_numpy(np.int64)
        marks = np.array([hashlib.sha256(v.astype("<f8").tobytes()).hexdigest() for v in matrix], object)
        out = []
        for low in range(0, len(matrix), 256):
            q, ids, at = search(found, matrix[low:low + 256], own[low:low + 256], top, width)
            with np.errstate(over="ignore", invalid="ignore"):
                scores = np.einsum("rd,rd->r", originals[at], matrix[low:low + 256][q])
            order = np.lexsort((ids, -scores, q))
            q, ids, scores = q[order], ids[order], scores[order]
            first = np.searchsorted(q, np.arange(len(matrix[low:low + 256])))
            best = np.arange(len(q)) - first[q] < top
            out.append(pd.DataFrame({
                "query_id": own[low:low + 256][q[best]], "query_sha256": marks[low:low + 256][q[best]], "vec_id": ids[best], "score": scores[best]}))
        return pd.concat(out)

    hits = left.groupBy("shard", "dim", "block").cogroup(right.groupBy("shard", "dim", "block")).applyInPandas(
        searched, "query_id long, query_sha256 string, vec_id long, score double")
    best = W.partitionBy("query_id", "query_sha256").orderBy(F.isnan("score"), F.desc("score"), "vec_id")
    ranked = hits.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= top)
    return ranked.select("query_id", "rank", "vec_id", "score", "query_sha256")

"""Nearest neighbours by largest inner product on an inverted multi-index.

Vectors are cut in half and each half is quantised by its own k-means
codebook; a cell of the index is a pair of centroids. For a query both halves'
centroids are sorted by inner product, and a heap walks the centroid pairs in
falling order of the summed products until the cells met hold ``probe`` of all
entries (k and the query's own at least). The entries of those cells are reranked by the
exact inner product in double precision.

An entry is a distinct vector with the ``k + 1`` smallest ids that have it (no
query can return more of them), so copies neither use up the walk's share nor
weigh in the codebooks. The ids are put in after the rerank.

Work is dealt out in blocks: entries of up to ``block`` vectors of neighbouring
cells (a larger cell is split by a hash of the id), each against blocks of
queries; a task holds one block of either and puts out ``k`` rows a query.
Only centroids, cell counts (bounded by centroids^2) and a training sample of
``train`` vectors reach the driver.

Isotropic vectors are the hard case (neighbours are hardly nearer than the
rest): with 64 centroids a half, half of the entries are needed for a recall
above 0.9; clustered data need far less. ``probe`` sets the trade.

Defined cases: null or zero vectors, and those with null or non-finite
components or another length than the most frequent one, take no part, nor do
null ids; of rows with one id the vector that sorts first counts; equal scores
go to the smaller id; with fewer candidates than ``k`` all are returned; an
empty index gives an empty result.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F

from clientlens.llm.shared import written


def usable(vectors: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """(id, v): rows that take part."""
    v = F.col("v")
    rows = vectors.select(F.col(vec_id).cast("long").alias("id"), F.col(vector).alias("v")).filter("id is not null")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    rows = rows.filter(v.isNotNull() & F.coalesce(fine, F.lit(False)))
    size = rows.groupBy(F.size("v").alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.desc("d")).first()
    if size is None:
        return rows
    return rows.filter(F.size("v") == size.d).groupBy("id").agg(F.min("v").alias("v"))


def _collapse(keep: int):
    """(v, ids) of each batch: its distinct vectors, each with its ``keep`` smallest ids."""
    def run(batches):
        for b in batches:
            if not b.num_rows:
                continue
            b = b.sort_by("id")
            x = np.ascontiguousarray(_matrix(b.column("v")))
            _, first, own = np.unique(x.view(f"V{x.itemsize * x.shape[1]}").ravel(), return_index=True, return_inverse=True)
            order, n = np.argsort(own, kind="stable"), np.bincount(own)
            rank = np.arange(len(own)) - np.repeat(np.cumsum(n) - n, n)
            ids = b.column("id").to_numpy()[order[rank < keep]]
            cut = np.append(0, np.cumsum(np.minimum(n, keep))).astype(np.int32)
            yield pa.RecordBatch.from_arrays([b.column("v").take(pa.array(first)), pa.ListArray.from_arrays(pa.array(cut), pa.array(ids))],
                                             names=["v", "ids"])
    return run


def distinct(rows: DataFrame, keep: int) -> DataFrame:
    """(v, ids): each vector once, with its ``keep`` smallest ids in order. A
    vector's copies are cut to ``keep`` a batch before they meet in one task."""
    kind = rows.schema["v"].dataType.simpleString()
    parts = rows.mapInArrow(_collapse(keep), f"v {kind}, ids array<long>").groupBy("v").agg(F.flatten(F.collect_list("ids")).alias("ids"))
    return parts.select("v", F.slice(F.array_sort("ids"), 1, keep).alias("ids"))


def kmeans(x: np.ndarray, k: int, rounds: int = 12, seed: int = 3) -> np.ndarray:
    """Lloyd's iterations from distinct sample points; may return fewer."""
    points = np.unique(x, axis=0)
    if not x.shape[1]:  # half of a one-component vector
        return x[:1]
    c = points[np.random.default_rng(seed).permutation(len(points))[:k]].copy()
    for _ in range(rounds):
        near = nearest(x, c)
        n = np.bincount(near, minlength=len(c))
        total = np.stack([np.bincount(near, x[:, j], len(c)) for j in range(x.shape[1])], 1)
        c[n > 0] = total[n > 0] / n[n > 0, None]
    return c


def nearest(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return ((c * c).sum(1) / 2 - x @ c.T).argmin(1)


def traverse(a: np.ndarray, b: np.ndarray, counts: np.ndarray, budget: float) -> float:
    """Walk centroid pairs in falling order of a[i] + b[j] until the cells met
    hold ``budget`` entries; returns the last pair's sum, so that a cell is met
    if its sum is at least that."""
    i_by, j_by = np.argsort(-a, kind="stable"), np.argsort(-b, kind="stable")
    x, y, n = a[i_by].tolist(), b[j_by].tolist(), counts[i_by][:, j_by].tolist()
    heap, got, last = [(-(x[0] + y[0]), 0, 0)], 0, -np.inf
    while heap:
        s, i, j = heapq.heappop(heap)
        last = -s
        got += n[i][j]
        if got >= budget:
            return last
        if j + 1 < len(y):
            heapq.heappush(heap, (-(x[i] + y[j + 1]), i, j + 1))
        if j == 0 and i + 1 < len(x):
            heapq.heappush(heap, (-(x[i + 1] + y[0]), i + 1, 0))
    return -np.inf


def _matrix(col) -> np.ndarray:
    """(rows, dims) doubles of an Arrow list column without nulls."""
    col = col.combine_chunks() if isinstance(col, pa.ChunkedArray) else col
    flat = col.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(col), -1) if len(col) else np.zeros((0, 1))


def _assign(held):
    def run(batches):
        c1, c2 = held.value
        for b in batches:
            x = _matrix(b.column("v"))
            if len(x):
                h = c1.shape[1]
                yield pa.RecordBatch.from_arrays(
                    [b.column("ids"), b.column("v"), pa.array(nearest(x[:, :h], c1).astype(np.int32)),
                     pa.array(nearest(x[:, h:], c2).astype(np.int32))], names=["ids", "v", "c1", "c2"])
    return run


def _route(held, counts: np.ndarray, budget: float):
    """Adds each query's stopping sum."""
    def run(batches):
        c1, c2 = held.value
        for b in batches:
            q = _matrix(b.column("v"))
            if len(q):
                h = c1.shape[1]
                stop = [traverse(x, y, counts, budget) for x, y in zip(q[:, :h] @ c1.T, q[:, h:] @ c2.T)]
                yield pa.RecordBatch.from_arrays([b.column("id"), b.column("v"), pa.array(stop, pa.float64())], names=["id", "v", "stop"])
    return run


def _rerank(held, k: int):
    """One block of queries against one block of entries: cell by cell, only
    the queries that met the cell; keeps k a query."""
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        c1, c2 = held.value
        none = pa.table({"query_id": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
        if not left.num_rows or not right.num_rows:
            return none
        q, x, h = _matrix(left.column("v")), _matrix(right.column("v")), c1.shape[1]
        ids, stop, lists = left.column("id").to_numpy(), left.column("stop").to_numpy(), right.column("ids").combine_chunks()
        flat, held_ids = lists.flatten().to_numpy(), lists.value_lengths().to_numpy().astype(np.int64)
        begin = np.cumsum(held_ids) - held_ids
        own, second = flat[begin], flat[np.minimum(begin + 1, len(flat) - 1)]  # second: only of entries with more ids
        a, b = q[:, :h] @ c1.T, q[:, h:] @ c2.T
        cell = right.column("c1").to_numpy().astype(np.int64) * len(c2) + right.column("c2").to_numpy()
        order = np.argsort(cell, kind="stable")
        edge = np.flatnonzero(np.diff(cell[order], prepend=-1))
        bar = np.full(len(q), -np.inf)  # each query's k-th best so far, a little lowered
        slack = 1e-12 * np.linalg.norm(q, axis=1) * np.linalg.norm(x, axis=1).max()
        kept, size = [], 0

        def best(parts):
            """The k best of the collected (query, entry) pairs, exactly scored."""
            qi, xi = (np.concatenate(z) for z in zip(*parts))
            score = np.empty(len(qi))
            for s in range(0, len(qi), 65536):
                score[s:s + 65536] = (q[qi[s:s + 65536]] * x[xi[s:s + 65536]]).sum(1)
            o = np.lexsort((np.where(own[xi] == ids[qi], second[xi], own[xi]), -score, qi))
            qi, xi, score = qi[o], xi[o], score[o]
            n = np.bincount(qi, minlength=len(q))
            rank = np.arange(len(qi)) - (np.cumsum(n) - n)[qi]
            last = rank == k - 1
            bar[qi[last]] = score[last] - slack[qi[last]]
            keep = rank < k
            return qi[keep], xi[keep], score[keep]

        for at, to in zip(edge, np.append(edge[1:], len(order))):
            rows = order[at:to]
            i, j = divmod(int(cell[rows[0]]), len(c2))
            met = np.flatnonzero(a[:, i] + b[:, j] >= stop)
            for s in range(0, len(met), 4096):
                part = met[s:s + 4096]
                score = q[part] @ x[rows].T
                ok = (score >= bar[part, None]) & ((own[rows][None] != ids[part, None]) | (held_ids[rows] > 1)[None])
                qi, xi = np.nonzero(ok)
                kept.append((part[qi], rows[xi]))
                size += len(qi)
                if size > 100 * len(q) + 10_000:  # soon, so that the bar keeps most pairs out
                    got = best(kept)
                    kept, size = [got[:2]], 0
        if not kept:
            return none
        qi, xi, score = best(kept)
        # every id of the kept entries but the query's own, again the k best
        n = held_ids[xi]
        at = np.repeat(begin[xi] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        qi, vec, score = np.repeat(qi, n), flat[at], np.repeat(score, n)
        other = vec != ids[qi]
        qi, vec, score = qi[other], vec[other], score[other]
        o = np.lexsort((vec, -score, qi))
        n = np.bincount(qi, minlength=len(q))
        o = o[np.arange(len(o)) - (np.cumsum(n) - n)[qi[o]] < k]
        return pa.table({"query_id": ids[qi[o]], "vec_id": vec[o], "score": score[o]})
    return run


def search(vectors: DataFrame, is_query: str = "id % 20 = 0", vec_id: str = "vec_id", vector: str = "embedding", k: int = 20,
           centroids: int = 64, probe: float = 0.5, train: int = 20_000, block: int = 8192,
           query_block: int = 2048, seed: int = 3) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` nearest found of the rows that
    meet ``is_query`` (a SQL condition on ``id``) among all other rows. A walk
    meets the share ``probe`` of the entries, and never fewer than k and its own."""
    spark = vectors.sparkSession
    rows = usable(vectors, vec_id, vector)
    kind = rows.schema["v"].dataType.simpleString()
    once = written(distinct(rows, k + 1), "ann-vectors")
    n = once.count()
    if not n:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    share = min(1.0, train / n)
    least = F.element_at("ids", 1)
    slot = F.pmod(F.xxhash64(least, F.lit(seed)), F.lit(1 << 20))
    sample = _matrix(once.filter(slot < int(share * (1 << 20)) + 1).orderBy(least).select("v").toArrow().column("v"))
    if not len(sample):
        sample = _matrix(once.orderBy(least).limit(1).toArrow().column("v"))
    half = (sample.shape[1] + 1) // 2
    codes = (kmeans(sample[:, :half], centroids, seed=seed), kmeans(sample[:, half:], centroids, seed=seed + 1))
    held = spark.sparkContext.broadcast(codes)
    entries = written(once.mapInArrow(_assign(held), f"ids array<long>, v {kind}, c1 int, c2 int"), "ann-index")
    counts = np.zeros((len(codes[0]), len(codes[1])), np.int64)
    for r in entries.groupBy("c1", "c2").agg(F.count(F.lit(1)).alias("n")).collect():
        counts[r.c1, r.c2] = r.n

    # blocks of neighbouring first centroids; one with more than a block is split by hash
    order, first, split, used = np.argsort(codes[0] @ codes[0].mean(0), kind="stable"), {}, {}, 0
    room = 0
    for c in order.tolist():
        m = int(counts[c].sum())
        if m > room:
            first[c], split[c] = used, -(-m // block)
            used += split[c]
            room = block - m if m < block else 0
        else:
            first[c], split[c] = used - 1, 1
            room -= m
    def lookup(d):
        return F.element_at(F.array(*[F.lit(int(d[c])) for c in range(len(first))]), F.col("c1") + 1)
    queries = written(rows.filter(is_query).repartition("id")
                      .mapInArrow(_route(held, counts, max(probe * n, k + 1)), f"id long, v {kind}, stop double"), "ann-queries")
    n_query = queries.count()
    q_blocks = max(1, -(-n_query // query_block))
    blocks = F.sequence(F.lit(0), F.lit(q_blocks - 1))
    place = (lookup(first) + F.pmod(F.xxhash64(least, F.lit(seed)), lookup(split))).cast("int")
    right = entries.withColumn("vb", place).withColumn("qb", F.explode(blocks))
    left = queries.withColumn("qb", F.pmod(F.xxhash64("id", F.lit(seed + 1)), F.lit(q_blocks)).cast("int")) \
        .withColumn("vb", F.explode(F.sequence(F.lit(0), F.lit(max(1, used) - 1))))
    found = left.groupBy("qb", "vb").cogroup(right.groupBy("qb", "vb")) \
        .applyInArrow(_rerank(held, k), "query_id long, vec_id long, score double")
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


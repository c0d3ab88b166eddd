"""Approximate nearest neighbours by cosine: a robust-pruned directed graph in each shard, searched with beams.

Vectors are dealt to shards by hash. In a shard, vectors enter the graph in batches: a greedy search with a beam from the
most central vector proposes neighbours for each of a batch; relaxed pruning keeps the nearest proposal, drops those that
are ALPHA times nearer to it than to the vector, and goes on, so that at most DEGREE diverse edges stay; edges back are pruned
alike. A query goes to every shard, where a beam search finds its nearest vectors; they are scored in double precision on
the original components, and the shards' best are merged.

Equal vectors are one node, with the k + 1 smallest of their ids: enough for any query's k best, and a group of
copies of whatever size can neither fill an adjacency list nor a shard. Every distinct vector is indexed. Queries meet all shards in
blocks of BLOCK; a shard of 8 MB goes to a task once for each block, whose searches take thousands of times longer than that.

Defined results: rows whose vector is null, zero, or holds null or non-finite components and rows without id take no
part. Shorter vectors count as padded with 0. Rows that repeat an id with the same vector count once; with another vector
they are queries and candidates of their own, but never each other's. Fewer candidates than k: all that are found. An empty table
gives an empty result. Columns other than vec_id and embedding are ignored. Recall is measured in the tests.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chronocell.llm.common import durable, partitions
from chronocell.llm.vectors import finite, lists, matrix

K, QUERY_EVERY = 5, 50
SHARD, LEAST_SHARD = 1 << 14, 2048  # vectors of a shard; of the least one, where there are more tasks than large shards
BLOCK = 1024  # queries
DEGREE, BEAM, SEARCH_BEAM, ALPHA = 32, 64, 160, 1.2
BATCH = 512  # vectors that enter or search together
WIDE = 4  # nodes that a search expands at once
PAIRS = 1 << 22  # distances among proposals computed at once
INDEX = "shard int, ids array<array<long>>, vectors array<array<double>>, edges array<array<int>>"


def scaled(x: np.ndarray) -> np.ndarray:
    """Rows times powers of two, exactly, so that no square overflows or vanishes."""
    _, e = np.frexp(np.abs(x).max(1, initial=0))
    return np.ldexp(x, -e[:, None])


def _unit(x: np.ndarray) -> np.ndarray:
    x = scaled(x)
    return (x / np.sqrt((x * x).sum(1))[:, None]).astype(np.float32)


def _once(ids: np.ndarray) -> np.ndarray:
    """ids with -1 in place of what a row has repeated."""
    order = np.argsort(ids, axis=1, kind="stable")
    s = np.take_along_axis(ids, order, 1)
    again = np.zeros(ids.shape, bool)
    again[:, 1:] = s[:, 1:] == s[:, :-1]
    out = ids.copy()
    np.put_along_axis(out, order, np.where(again, -1, s), 1)
    return out


class Graph:
    """Unit vectors and their edges (rows of node numbers, -1 where there is none)."""

    def __init__(self, x: np.ndarray, edges: np.ndarray | None = None, degree: int = DEGREE, beam: int = BEAM, alpha: float = ALPHA):
        self.x, self.degree, self.beam, self.alpha = x, degree, beam, alpha
        self.entry = int((x @ x.mean(0)).argmax())
        self.edges = np.full((len(x), degree), -1, np.int32) if edges is None else edges
        if edges is None:
            order = np.random.default_rng(len(x)).permutation(len(x))
            order = order[order != self.entry]
            at = 0
            while at < len(order):
                more = order[at : at + min(BATCH, at + 1)]
                self._enter(more)
                at += len(more)

    def search(self, q: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """The nodes of each query's beam, nearest first, and all nodes that were expanded (-1: none)."""
        n, rows = len(q), np.arange(len(q))
        ids, far, done = np.full((n, beam), -1, np.int32), np.full((n, beam), np.inf, np.float32), np.ones((n, beam), bool)
        ids[:, 0], far[:, 0], done[:, 0] = self.entry, -(q @ self.x[self.entry]), False
        seen = np.zeros((n, len(self.x)), bool)
        seen[:, self.entry] = True
        trail = []
        while len(rows := rows[~done[rows].all(1)]):
            open_ = np.where(done[rows], np.inf, far[rows])
            at = np.argpartition(open_, min(WIDE, beam) - 1, axis=1)[:, :WIDE]
            real = np.isfinite(np.take_along_axis(open_, at, 1))
            node = np.where(real, ids[rows[:, None], at], -1)
            done[rows[:, None], at] = True
            step = np.full((n, at.shape[1]), -1, np.int32)
            step[rows] = node
            trail.append(step)
            near = np.where(real[:, :, None], self.edges[node], -1).reshape(len(rows), -1)
            near[seen[rows[:, None], near]] = -1
            near = _once(near)
            new = near >= 0
            r, c = np.nonzero(new)
            seen[rows[r], near[r, c]] = True
            d = np.full(near.shape, np.inf, np.float32)
            d[r, c] = -np.einsum("ij,ij->i", self.x[near[r, c]], q[rows[r]])
            ids_, far_, done_ = np.hstack([ids[rows], near]), np.hstack([far[rows], d]), np.hstack([done[rows], ~new])
            best = np.argpartition(far_, beam - 1, axis=1)[:, :beam]
            ids[rows], far[rows], done[rows] = (np.take_along_axis(a, best, 1) for a in (ids_, far_, done_))
        order = np.argsort(far, axis=1, kind="stable")
        return np.take_along_axis(ids, order, 1), np.hstack(trail)

    def _prune(self, p: np.ndarray, proposed: np.ndarray) -> np.ndarray:
        """At most degree of the proposals of each node of p: the nearest, then the nearest of those that it does not stand in for, and so on."""
        proposed = _once(np.where(proposed == p[:, None], -1, proposed))
        out = np.full((len(p), self.degree), -1, np.int32)
        step = max(1, PAIRS // proposed.shape[1] ** 2)
        for lo in range(0, len(p), step):
            c = proposed[lo : lo + step]
            v = self.x[c]
            d = np.where(c < 0, np.inf, 2 - 2 * np.matmul(v, self.x[p[lo : lo + step]][:, :, None])[..., 0])
            order = np.argsort(d, axis=1, kind="stable")
            c, d, v = np.take_along_axis(c, order, 1), np.take_along_axis(d, order, 1), np.take_along_axis(v, order[:, :, None], 1)
            apart = 2 - 2 * np.matmul(v, v.transpose(0, 2, 1))
            alive, rows = c >= 0, np.arange(len(c))
            for k in range(self.degree):
                pick = alive.argmax(1)
                some = alive[rows, pick]
                if not some.any():
                    break
                out[lo : lo + step][:, k] = np.where(some, c[rows, pick], -1)
                alive &= self.alpha**2 * apart[rows, pick] > d  # squared distances
                alive[rows, pick] = False
        return out

    def _enter(self, p: np.ndarray) -> None:
        beam, trail = self.search(self.x[p], self.beam)
        self.edges[p] = self._prune(p, np.hstack([beam, trail]))
        source = np.repeat(p, self.degree).astype(np.int32)
        target = self.edges[p].ravel()
        source, target = source[target >= 0], target[target >= 0]
        order = np.argsort(target, kind="stable")
        source, target = source[order], target[order]
        node, first, many = np.unique(target, return_index=True, return_counts=True)
        place = np.arange(len(target)) - np.repeat(first, many)
        has = (self.edges[node] >= 0).sum(1)
        full = has + many > self.degree
        room = ~np.repeat(full, many)
        self.edges[target[room], np.repeat(has, many)[room] + place[room]] = source[room]
        full = np.flatnonzero(full)
        full = full[np.argsort(many[full], kind="stable")]  # nodes with alike numbers of new edges are pruned together
        for lo in range(0, len(full), BATCH):
            on = full[lo : lo + BATCH]
            wide = np.full((len(on), int(many[on].max())), -1, np.int32)
            row = np.repeat(np.arange(len(on)), many[on])
            at = np.arange(len(row)) - np.repeat(np.cumsum(many[on]) - many[on], many[on])
            wide[row, at] = source[np.repeat(first[on], many[on]) + at]
            self.edges[node[on]] = self._prune(node[on].astype(np.int32), np.hstack([self.edges[node[on]], wide]))


def nodes(embeddings: DataFrame, k: int = K) -> DataFrame:
    """(v array<double>, ids): the distinct vectors that take part, each with the k + 1 smallest of its ids."""
    rows = taking_part(embeddings)
    rank = F.dense_rank().over(Window.partitionBy("v").orderBy("vec_id"))  # Spark drops higher ranks before the shuffle, too
    return rows.withColumn("nth", rank).where(F.col("nth") <= k + 1).groupBy("v").agg(F.sort_array(F.collect_set("vec_id")).alias("ids"))


def taking_part(embeddings: DataFrame) -> DataFrame:
    x = F.col("embedding")
    v = F.transform(x, lambda c: c.cast("double") + F.lit(0.0))  # -0.0 becomes 0.0, and equal vectors equal keys
    return embeddings.where(F.col("vec_id").isNotNull() & finite(x) & F.exists(x, lambda c: c != 0)).select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v"))


def _padded(col: pa.ChunkedArray, dim: int) -> np.ndarray:
    col = col.combine_chunks()
    off = np.asarray(col.offsets)
    length = np.diff(off)
    out = np.zeros((len(length), dim))
    out[np.arange(dim) < length[:, None]] = np.asarray(col.flatten())
    return out


def index(found: DataFrame, shards: int, dim: int) -> DataFrame:
    """One row a shard: its nodes' ids, vectors and edges. Shards hold about equally many nodes, as these are distinct."""

    def build(t: pa.Table) -> pa.Table:
        ids = t.column("ids").combine_chunks()
        first = np.asarray(ids.flatten())[np.asarray(ids.offsets)[:-1] - ids.offsets[0].as_py()]
        x = _padded(t.column("v"), dim)
        order = np.lexsort((*x.T[::-1], first))  # the rows' order differs from run to run
        x = x[order]
        edges = Graph(_unit(x)).edges
        return pa.table({"shard": t.column("shard")[:1], **{name: pa.array([values]) if isinstance(values, list) else pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values) for name, values in (("ids", ids.take(pa.array(order))), ("vectors", lists(x)), ("edges", lists(edges)))}})

    dealt = found.withColumn("shard", F.pmod(F.xxhash64("v"), F.lit(shards)).cast("int"))
    return dealt.repartition(max(shards, partitions(found.sparkSession)), "shard").groupBy("shard").applyInArrow(build, INDEX)


def _best(k: int, dim: int, beam: int):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                get = lambda name: batch.column(name)[i].values  # noqa: B023, E731
                x, edges = matrix(get("vectors"), dim), matrix(get("edges"), DEGREE)
                q, qids, qnos = matrix(get("qvectors"), dim), np.asarray(get("qids")), np.asarray(get("qnos"))
                ids = get("ids")
                id_off, id_all = np.asarray(ids.offsets) - ids.offsets[0].as_py(), np.asarray(ids.flatten())
                graph = Graph(_unit(x), edges)
                exact, q_exact = scaled(x), scaled(q)
                norm, q_norm = np.sqrt((exact * exact).sum(1)), np.sqrt((q_exact * q_exact).sum(1))
                unit = _unit(q)
                for lo in range(0, len(q), BATCH):
                    seen, _ = graph.search(unit[lo : lo + BATCH], min(beam, len(x)))
                    row, col = np.nonzero(seen >= 0)
                    node, row = seen[row, col], row + lo
                    score = np.empty(len(row))
                    for at in range(0, len(row), 1 << 14):
                        r, m = row[at : at + (1 << 14)], node[at : at + (1 << 14)]
                        score[at : at + len(r)] = (q_exact[r] * exact[m]).sum(1) / (q_norm[r] * norm[m])
                    many = np.diff(id_off)[node]
                    place = np.repeat(id_off[node], many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
                    row, score, vec = np.repeat(row, many), np.repeat(score, many), id_all[place]
                    other = vec != qids[row]
                    row, score, vec = row[other], score[other], vec[other]
                    order = np.lexsort((vec, -score, row))
                    row, score, vec = row[order], score[order], vec[order]
                    top = np.arange(len(row)) - np.searchsorted(row, row) < k
                    yield pa.record_batch({"query": pa.array(qnos[row[top]]), "query_id": pa.array(qids[row[top]]), "vec_id": pa.array(vec[top]), "score": pa.array(score[top])})

    return search


def nearest(embeddings: DataFrame, k: int = K, every: int = QUERY_EVERY, shard: int = SHARD, beam: int = SEARCH_BEAM) -> DataFrame:
    """query_id, rank, vec_id, score of the k nearest that are found for each row whose id is divisible by every."""
    spark = embeddings.sparkSession
    found = durable(nodes(embeddings, k), "nodes")
    n, dim = found.agg(F.count(F.lit(1)), F.max(F.size("v"))).first()
    if not n:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    shards = max(1, -(-n // shard), min(partitions(spark), n // LEAST_SHARD))
    graphs = durable(index(found, shards, dim), "graphs")
    padded = F.when(F.size("v") < dim, F.concat("v", F.array_repeat(F.lit(0.0), F.lit(dim) - F.size("v")))).otherwise(F.col("v"))
    queries = durable(taking_part(embeddings).where(F.col("vec_id") % every == 0).distinct().withColumn("query", F.monotonically_increasing_id()), "queries")
    blocks = max(1, -(-queries.count() // BLOCK))
    dealt = queries.select("query", "vec_id", padded.alias("v"), F.pmod(F.xxhash64("query"), F.lit(blocks)).alias("block"))
    packed = dealt.groupBy("block").agg(F.collect_list(F.struct("query", "vec_id", "v")).alias("q"))  # BLOCK queries, dealt by hash
    packed = packed.select(F.col("q.query").alias("qnos"), F.col("q.vec_id").alias("qids"), F.col("q.v").alias("qvectors"), F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"))
    tasks = max(shards, partitions(spark))
    met = graphs.repartition(tasks, "shard").join(packed.repartition(tasks, "shard"), "shard")
    scores = met.mapInArrow(_best(k, dim, beam), "query long, query_id long, vec_id long, score double")
    rank = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "vec_id"))
    return scores.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

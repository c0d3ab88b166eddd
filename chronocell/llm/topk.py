"""Exact top-k inner product search by MaxScore.

Terms are vector components. In a shard of vectors the score of a query is its lowest possible one plus
non-negative contributions, one a term, each with its upper bound. Terms are taken by falling bound. The threshold is
the query's k-th best score so far: before the search each block of queries meets one shard, whose k-th best goes with
the query to all shards; in a shard it rises with what is found. Non-essential terms are the longest run from the
least bound up that cannot reach the threshold by itself; the others are essential. Postings lie in blocks of
POSTINGS vectors, each block with its terms' ranges: blocks whose bound stays below the threshold are skipped, in the
others the essential terms are traversed, and the non-essential ones probed only for vectors whose score plus the
bounds still left reaches the threshold. Shards' best are merged.

Vectors are dealt to shards by hash of id and vector, so that one holds SHARD bytes, and queries to blocks of BLOCK bytes;
every block meets every shard by a join on the shard's number. All of a shard or block is a fixed number of vectors.
What is sent grows as queries times shards, so shards are as large as a task's memory allows.

Defined results: vectors that are null, or hold a null or non-finite component, and rows without id take
no part; shorter vectors count as padded with 0; rows that repeat an id are one item to its queries
(never their own partner) and each a candidate to others; an empty table gives an empty result; other columns are
ignored. Scores are exact as long as a sum of absolute products stays under 2^63; beyond that they are undefined.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chronocell.llm.common import durable, partitions

SHARD, BLOCK = 16 << 20, 2 << 20  # bytes of a shard and of a block of queries, as numbers of 8 bytes
LEAST_SHARD = 2048  # vectors
POSTINGS = 2048  # vectors of a block of postings
K = 5
QUERY_EVERY = 50
PACKED = "no int, n int, dim int, ids binary, vectors binary"
STEP = 32  # terms probed between two comparisons with the threshold
EXACT = float(1 << 53)


def quantised(embeddings: DataFrame) -> DataFrame:
    """(vec_id, v array<long>) of the rows that take part."""
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return embeddings.where(F.col("embedding").isNotNull() & F.col("vec_id").isNotNull() & ~bad).select(F.col("vec_id").cast("long"), F.transform("embedding", lambda x: F.floor(x.cast("double") * 256)).alias("v"))


def _pack(vectors: DataFrame, blocks: int) -> DataFrame:
    """Vectors dealt to blocks by hash of id and vector; in a block, those alike in sign of the most varied terms stand together."""

    def pack(t: pa.Table) -> pa.Table:
        v = t.column("v").combine_chunks()
        off = np.asarray(v.offsets)
        flat = np.asarray(v.values.slice(off[0], off[-1] - off[0]))
        length = np.diff(off)
        dim = int(length.max())
        m = np.zeros((len(length), dim), np.int64)
        m[np.arange(dim) < length[:, None]] = flat
        ids = t.column("vec_id").to_numpy()
        varied = np.argsort(-m.std(0), kind="stable")[:8] if dim else np.zeros(0, np.int64)
        side = (m[:, varied] > np.median(m[:, varied], axis=0)) @ (1 << np.arange(len(varied)))
        order = np.lexsort((ids, side))
        small = np.int32 if not m.size or np.abs(m).max() < 1 << 31 else np.int64
        return pa.table({"no": t.column("no")[:1], "n": pa.array([len(ids)], pa.int32()), "dim": pa.array([dim], pa.int32()), "ids": pa.array([ids[order].tobytes()], pa.binary()), "vectors": pa.array([m[order].astype(small).tobytes()], pa.binary())})

    dealt = vectors.withColumn("no", F.pmod(F.xxhash64("vec_id", "v"), F.lit(blocks)).cast("int"))
    return dealt.groupBy("no").applyInArrow(pack, PACKED)


class Shard:
    """Blocks of postings (terms by vectors) with the terms' ranges."""

    def __init__(self, ids: np.ndarray, x: np.ndarray):
        edge = range(0, len(ids), POSTINGS)
        self.ids = [ids[i : i + POSTINGS] for i in edge]
        self.blocks = [np.ascontiguousarray(x[i : i + POSTINGS].T) for i in edge]
        self.low, self.high = (np.stack([f(b, axis=1) for b in self.blocks], 1).astype(float) for f in (np.min, np.max))

    def best(self, q: np.ndarray, qid: int, k: int, least: float = -np.inf, prune: bool = True) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the k best of which none is under least (the k-th best elsewhere)."""
        a, b = q * self.low.min(1), q * self.high.max(1)
        floor, gain = np.minimum(a, b).astype(float), np.abs(a - b).astype(float)
        order = np.argsort(-gain, kind="stable")
        left = np.r_[gain[order][::-1].cumsum()[::-1], 0.0]  # bounds of the terms from here on
        rest = np.r_[floor[order][::-1].cumsum()[::-1], 0.0]  # lowest scores of the terms from here on
        bound = np.maximum(q, 0) @ self.high + np.minimum(q, 0) @ self.low  # of each block
        ids, scores, seen = np.zeros(0, np.int64), np.zeros(0, q.dtype), None
        for at in np.argsort(-bound, kind="stable"):
            if bound[at] < least:
                break  # the blocks after this have lower bounds
            if seen != least:  # the run of terms from the least bound up that cannot reach it is not essential
                seen = least
                essential = min(len(order), max(1, int(np.searchsorted(-(rest[0] + left), -least, "right")))) if np.isfinite(least) else len(order)
                only = np.zeros_like(q)
                only[order[:essential]] = q[order[:essential]]
            block = self.blocks[at]
            score = only @ block
            alive = np.flatnonzero((score + rest[essential] + left[essential] >= least) & (self.ids[at] != qid))
            score = score[alive]
            for t in range(essential, len(order), STEP):
                if not len(alive):
                    break
                on = order[t : t + STEP]
                score = score + q[on] @ block[np.ix_(on, alive)]
                t = min(t + STEP, len(order))
                keep = score + rest[t] + left[t] >= least
                alive, score = alive[keep], score[keep]
            if len(alive):
                ids, scores = np.r_[ids, self.ids[at][alive]], np.r_[scores, score]
                top = np.lexsort((ids, -scores))[:k]
                ids, scores = ids[top], scores[top]
                if prune and len(ids) == k:
                    least = max(least, float(scores[-1]))
        return ids, scores


def _search(k: int):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in batches:
            for r in t.to_pylist():
                dim = max(r["dim"], r["qdim"])

                def matrix(buffer: bytes, n: int, own: int, dim: int = dim) -> np.ndarray:
                    m = np.zeros((n, dim), np.int64)
                    m[:, :own] = np.frombuffer(buffer, np.int64 if len(buffer) == 8 * n * own else np.int32).reshape(n, own)
                    return m

                x, q = matrix(r["vectors"], r["n"], r["dim"]), matrix(r["qvectors"], r["qn"], r["qdim"])
                exact = float(np.abs(x).max(initial=0)) * float(np.abs(q).max(initial=0)) * dim < EXACT
                if exact:
                    x, q = x.astype(float), q.astype(float)
                ids, qids = np.frombuffer(r["ids"], np.int64), np.frombuffer(r["qids"], np.int64)
                least = np.full(len(qids), -np.inf)
                seen = np.frombuffer(r["least"] or b"", float)
                if exact:  # else bounds in floating point may not hold, and every vector is scored in full
                    least[: len(seen)] = seen
                shard = Shard(ids, x)
                out = [(i, *shard.best(q[i], qids[i], k, least[i], exact)) for i in range(len(qids))]
                size = [len(o[1]) for o in out]
                row = np.repeat([o[0] for o in out], size)
                yield pa.record_batch({
                    "qno": pa.array(np.full(len(row), r["qno"], np.int32)),
                    "query_id": pa.array(qids[row]),
                    "query_row": pa.array(row.astype(np.int32)),
                    "vec_id": pa.array(np.concatenate([o[1] for o in out])),
                    "score": pa.array(np.concatenate([o[2] for o in out]).astype(np.int64)),
                })

    return search


def search(vectors: DataFrame, queries: DataFrame, k: int = K, shard: int = SHARD, block: int = BLOCK) -> DataFrame:
    """query_id, rank, vec_id, score of each query's k best among vectors, both (vec_id, v array<long>)."""
    n, dim = vectors.agg(F.count(F.lit(1)), F.max(F.size("v"))).first()
    shards = max(1, -(-n * 8 * (dim or 1) // shard), min(partitions(vectors.sparkSession), n // LEAST_SHARD))
    x = durable(_pack(vectors, shards))
    q = durable(_pack(queries, max(1, -(-queries.count() * 8 * (dim or 1) // block))))
    q = q.select(F.col("no").alias("qno"), F.col("n").alias("qn"), F.col("dim").alias("qdim"), F.col("ids").alias("qids"), F.col("vectors").alias("qvectors"))
    kind = "qno int, query_id long, query_row int, vec_id long, score long"

    # the k-th best of one shard of each block of queries is a threshold for all
    first = x.join(q.select("*", F.pmod("qno", F.lit(shards)).alias("no"), F.lit(None).cast("binary").alias("least")), "no").mapInArrow(_search(k), kind)

    def thresholds(t: pa.Table) -> pa.Table:
        row, score = t.column("query_row").to_numpy(), t.column("score").to_numpy()
        least = np.full(int(row.max()) + 1, np.inf)
        np.minimum.at(least, row, score.astype(float))
        least[np.bincount(row, minlength=len(least)) < k] = -np.inf
        return pa.table({"of": t.column("qno")[:1], "seen": pa.array([least.tobytes()], pa.binary())})

    seen = first.groupBy("qno").applyInArrow(thresholds, "of int, seen binary")
    q = q.join(seen, F.col("qno") == F.col("of"), "left").drop("of")
    every = q.select("*", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("no")).withColumnRenamed("seen", "least")
    found = x.join(every, "no").mapInArrow(_search(k), kind)
    rank = F.row_number().over(Window.partitionBy("qno", "query_row").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def top_pairs(embeddings: DataFrame, k: int = K, every: int = QUERY_EVERY) -> DataFrame:
    """Queries are the rows whose id is divisible by every; candidates are all rows but the query's own."""
    v = quantised(embeddings)
    return search(v, v.where(F.col("vec_id") % every == 0), k)


ORACLE = f"""
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
           WHERE embedding IS NOT NULL AND vec_id IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % {QUERY_EVERY} = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM r WHERE rank <= {K}
"""

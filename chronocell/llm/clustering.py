"""Centroid clustering of integer vectors, each round filtered in PCA-rotated coordinates.

The covariance of all vectors is added up by Spark; its eigenvectors rotate every vector once. Stored beside the
integers are the LEADING rotated coordinates and the norm of the rest (the residual). For a centroid rotated alike,
projected distance plus the squared difference of the residual norms is a lower bound of the squared distance, so
that a vector meets centroids by rising bound and stops where the bound passes its best exact distance. What a bound
does not exclude is verified in 64-bit integers, so rotation and rounding decide only what is looked at, never a result.

A round is one pass over the stored table whose tasks return a count and component sums for each centroid: what reaches
the driver is k rows, whatever the table's size, and no group of vectors ever meets in one task.

Defined results: vectors that are null, have other than dim components, or hold null or non-finite ones take no part.
Rows without id take part (and are the last to be seeds); rows that repeat an id are vectors of their own. Seeds with
equal ids stand in order of their components. Fewer vectors than k: as many centroids as vectors; none: an empty
result. A component so large that squared distances need more than 63 bits, or an inertia that does, is an error.
Columns other than vec_id and embedding are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronocell.llm.common import durable
from chronocell.llm.vectors import STEP, by_group, finite, integers, lists, matrix, sums

DIM, K, ROUNDS, SCALE = 64, 40, 5, 256
LEADING = 16  # rotated coordinates that are stored
SEED = "2:"  # goes before the id that is hashed for the order of the seeds
SLACK = 1e-9  # of the squared norms: far above what rounding adds to a bound
RESULT = "vec_id long, cluster int, distance long"


def _moments(dim: int):
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, first, second = 0, np.zeros(dim), np.zeros((dim, dim))
        for b in batches:
            x = matrix(b.column("v"), dim).astype(float)
            n, first, second = n + len(x), first + x.sum(0), second + x.T @ x
        if n:
            yield pa.record_batch({"row": pa.array(np.arange(dim + 1, dtype=np.int32)), "n": pa.array(np.full(dim + 1, n)), "total": lists(np.vstack([first, second]))})

    return add


def rotation(vectors: DataFrame, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Mean and eigenvectors (columns, by falling variance) of all vectors (v array<int>)."""
    rows = sorted(sums(vectors.select("v").mapInArrow(_moments(dim), "row int, n long, total array<double>"), ["row"], dim))
    n, m = rows[0].n, np.array([r.total for r in rows])
    mean = m[0] / n
    _, basis = np.linalg.eigh(m[1:] / n - np.outer(mean, mean))
    return mean, basis[:, ::-1]


class Filter:
    """Lower bounds of squared distances from what is stored of a vector to what is known of each centroid."""

    def __init__(self, mean: np.ndarray, basis: np.ndarray, leading: int):
        self.mean, self.basis, self.leading = mean, basis, min(leading, len(mean))

    def rotated(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        y = (x - self.mean) @ self.basis
        return y[:, : self.leading], np.sqrt((y[:, self.leading :] ** 2).sum(1))

    def nearest(self, x: np.ndarray, lead: np.ndarray, rest: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """Nearest centroid (ties: smaller number) and exact squared distance of each row, and how many distances were computed."""
        c_lead, c_rest = self.rotated(centroids)
        size, c_size = (lead**2).sum(1), (c_lead**2).sum(1)
        bound = size[:, None] + c_size - 2 * lead @ c_lead.T + (rest[:, None] - c_rest) ** 2
        bound -= SLACK * (1 + (size + rest**2)[:, None] + c_size + c_rest**2)
        order = np.argsort(bound, axis=1, kind="stable")
        best, found, alive, computed = np.full(len(x), np.iinfo(np.int64).max), np.zeros(len(x), np.int64), np.arange(len(x)), 0
        for j in range(len(centroids)):
            at = order[alive, j]
            on = bound[alive, at] <= best[alive]
            alive, at = alive[on], at[on]
            if not len(alive):
                break
            d = ((x[alive] - centroids[at]) ** 2).sum(1)
            computed += len(d)
            better = (d < best[alive]) | ((d == best[alive]) & (at < found[alive]))
            best[alive[better]], found[alive[better]] = d[better], at[better]
        return found, best, computed


def _assignments(of: Filter, centroids: np.ndarray):
    dim = centroids.shape[1]

    def assigned(b: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, np.ndarray]]:
        for at in range(0, len(b), STEP):
            part = b.slice(at, STEP)
            x = matrix(part.column("v"), dim).astype(np.int64)
            yield part, x, *of.nearest(x, matrix(part.column("lead"), of.leading), np.asarray(part.column("rest")), centroids)[:2]

    return assigned


def _partial(of: Filter, centroids: np.ndarray):
    k, assigned = len(centroids), _assignments(of, centroids)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = np.zeros(k, np.int64), np.zeros(centroids.shape, np.int64)
        for b in batches:
            for _, x, found, _ in assigned(b):
                more = by_group(x, found, k)
                n, total = n + more[0], total + more[1]
        on = np.flatnonzero(n)
        yield pa.record_batch({"cluster": pa.array(on.astype(np.int32)), "n": pa.array(n[on]), "total": lists(total[on])})

    return add


def _final(of: Filter, centroids: np.ndarray):
    assigned = _assignments(of, centroids)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part, _, found, best in assigned(b):
                yield pa.record_batch({"vec_id": part.column("vec_id"), "cluster": pa.array(found.astype(np.int32)), "distance": pa.array(best)})

    return assign


def stored(embeddings: DataFrame, dim: int = DIM, scale: int = SCALE, leading: int = LEADING) -> tuple[DataFrame, Filter] | None:
    """The table that every round reads (vec_id, v, lead, rest) and its filter; None without vectors."""
    kept = embeddings.where(finite(F.col("embedding")) & (F.size("embedding") == dim)).select(F.col("vec_id").cast("long").alias("vec_id"), integers(F.col("embedding"), scale, dim).alias("v"))
    if kept.isEmpty():
        return None
    of = Filter(*rotation(kept, dim), leading)

    def rotate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lead, rest = of.rotated(matrix(b.column("v"), dim))
            yield pa.record_batch({"vec_id": b.column("vec_id"), "v": b.column("v"), "lead": lists(lead), "rest": pa.array(rest)})

    return durable(kept.mapInArrow(rotate, "vec_id long, v array<int>, lead array<double>, rest double"), "rotated"), of


def clusters(embeddings: DataFrame, k: int = K, rounds: int = ROUNDS, dim: int = DIM, scale: int = SCALE, leading: int = LEADING) -> tuple[DataFrame, np.ndarray]:
    """(vec_id, cluster, distance) of every vector that takes part, and the final centroids."""
    if (found := stored(embeddings, dim, scale, leading)) is None:
        return embeddings.sparkSession.createDataFrame([], RESULT), np.zeros((0, dim), np.int64)
    table, of = found
    drawn = table.orderBy(F.sha2(F.concat(F.lit(SEED), F.col("vec_id").cast("string")), 256).asc_nulls_last(), "v").limit(k)
    centroids = np.array([r.v for r in drawn.select("v").collect()], np.int64)
    for _ in range(rounds):
        for r in sums(table.select("v", "lead", "rest").mapInArrow(_partial(of, centroids), "cluster int, n long, total array<long>"), ["cluster"], dim):
            centroids[r.cluster] = np.array(r.total) // r.n  # rounds down
    return table.mapInArrow(_final(of, centroids), RESULT), centroids


def digest(components: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, components.ravel().tolist())).encode()).hexdigest()


def clustered(embeddings: DataFrame, **options: int) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256 of every vector that takes part."""
    found, centroids = clusters(embeddings, **options)
    found = durable(found, "clusters")
    of_cluster = found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()  # k rows at most
    rows = [(r.cluster, int(r.s), sum(int(o.s) for o in of_cluster), digest(centroids[r.cluster])) for r in of_cluster]
    if any(r[2] >= 1 << 63 for r in rows):
        raise OverflowError("the inertia needs more than 63 bits")
    per = found.sparkSession.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.join(F.broadcast(per), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def _oracle() -> str:
    ctes = [
        f"""v AS (SELECT row_number() OVER () AS n, vec_id, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)) AS v FROM embeddings
           WHERE len(embedding) = {DIM} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
        f"c0 AS (SELECT row_number() OVER (ORDER BY h NULLS LAST, v) - 1 AS c, v FROM (SELECT sha256('{SEED}' || vec_id) AS h, v FROM v) ORDER BY h NULLS LAST, v LIMIT {K})",
    ]
    for r in range(ROUNDS + 1):
        ctes.append(f"""a{r} AS (SELECT n, vec_id, v.v, min(row(list_inner_product(v.v, v.v) + list_inner_product(c.v, c.v) - 2 * list_inner_product(v.v, c.v), c)) AS best FROM v, c{r} AS c GROUP BY ALL)""")
        if r < ROUNDS:
            ctes.append(f"""s{r} AS (SELECT c, i, sum(x)::HUGEINT AS s, count(*) AS m FROM (SELECT best[2] AS c, unnest(range(1, {DIM + 1})) AS i, unnest(v)::BIGINT AS x FROM a{r}) GROUP BY c, i),
m{r} AS (SELECT c, list(((s - (s % m + m) % m) // m)::DOUBLE ORDER BY i) AS v FROM s{r} GROUP BY c),
c{r + 1} AS (SELECT c, coalesce(m.v, o.v) AS v FROM c{r} AS o LEFT JOIN m{r} AS m USING (c))""")
    last = f"SELECT vec_id, best[2] AS c, best[1]::BIGINT AS d FROM a{ROUNDS}"
    return f"""WITH {", ".join(c.replace("AS (", "AS MATERIALIZED (", 1) for c in ctes)}
SELECT vec_id, c::INTEGER AS cluster, d AS distance, (sum(d) OVER (PARTITION BY c))::BIGINT AS cluster_inertia, (sum(d) OVER ())::BIGINT AS inertia,
sha256(array_to_string(list_transform(f.v, lambda x: x::BIGINT), ',')) AS centroid_sha256 FROM ({last}) JOIN c{ROUNDS} AS f USING (c)"""


ORACLE = _oracle()

"""Product codes of integer vectors, whose codebooks are searched with LAESA pivots.

A vector is cut into equal parts; each part position has a codebook. For each position a few of its first entries,
far from each other, are pivots for good: the distance of every vector's part to them is computed once and stored.
In each round only the entries meet the pivots. The largest difference of the two distances over the pivots is a lower
bound of a part's distance to an entry; entries are taken by rising bound, in waves, and those whose bound
passes the best exact distance so far are never evaluated. What is evaluated is computed in 64-bit integers.

A round is one pass over the stored table whose tasks return a count and component sums for each entry: the driver gets
parts x entries rows, whatever the table's size.

Defined results: rows whose vector is null or holds null or non-finite components are dropped. Codes need vectors of one
length that the number of parts divides: the length is that of the row with the smallest id among those that can
be cut, and rows of other lengths are dropped too. Rows without id take part (and are the last to be entries); rows that repeat an id
are vectors of their own, in order of their components. Fewer vectors than entries: as many entries as vectors; none: an
empty result. A component so large that squared distances need more than 63 bits, or a sum of errors that
does, is an error. Columns other than vec_id, embedding and label are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronocell.llm.clustering import digest
from chronocell.llm.common import durable
from chronocell.llm.vectors import by_group, finite, integers, lists, matrix, sums

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
PIVOTS = 8  # of each part position
WAVES = (4, 16, 64)  # entries by rising bound, evaluated together
SLACK = 1e-9  # of a distance: far above what rounding adds to a bound
STEP = 1024  # rows worked on at once


def pivots(entries: np.ndarray, n: int) -> np.ndarray:
    """n of the entries of one position: the first, then always the one farthest from all that were chosen."""
    chosen = [0]
    far = ((entries - entries[0]) ** 2).sum(1)
    while len(chosen) < min(n, len(entries)):
        chosen.append(int(far.argmax()))
        far = np.minimum(far, ((entries - entries[chosen[-1]]) ** 2).sum(1))
    return entries[chosen]


def distances(x: np.ndarray, to: np.ndarray) -> np.ndarray:
    """Of every row of x to every row of to, from exact squares."""
    return np.sqrt(np.stack([((x - p) ** 2).sum(1) for p in to], 1).astype(float))


class Codebook:
    """One position's entries in a round, and their distances to its pivots."""

    def __init__(self, entries: np.ndarray, fixed: np.ndarray):
        self.entries, self.far = entries, distances(entries, fixed)

    def nearest(self, x: np.ndarray, far: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """Nearest entry (ties: lower index) and exact squared distance of each row, and how many distances were computed."""
        n, m = len(x), len(self.entries)
        bound = np.abs(far[:, :1] - self.far[:, 0])
        for p in range(1, far.shape[1]):
            np.maximum(bound, np.abs(far[:, p : p + 1] - self.far[:, p]), out=bound)
        bound -= SLACK * (1 + far.max(1)[:, None] + self.far.max(1))
        np.maximum(bound, 0, out=bound)
        bound *= bound
        edges = [0, *(w for w in WAVES if w < m), m]
        order = np.argpartition(bound, edges[1:-1], axis=1) if len(edges) > 2 else np.broadcast_to(np.arange(m), (n, m))
        most = np.iinfo(np.int64).max
        best, found, alive, computed = np.full(n, most), np.zeros(n, np.int64), np.arange(n), 0
        for lo, hi in zip(edges, edges[1:], strict=False):
            at = order[alive, lo:hi]
            on = np.take_along_axis(bound[alive], at, 1) <= best[alive][:, None]
            going = on.any(1)  # a wave's bounds are not under those of the waves before
            alive, at, on = alive[going], at[going], on[going]
            if not len(alive):
                break
            row, col = np.nonzero(on)
            d = np.full(at.shape, most)
            d[row, col] = ((x[alive[row]] - self.entries[at[row, col]]) ** 2).sum(1)
            computed += len(row)
            least = d.min(1)
            first = np.where(d == least[:, None], at, m).min(1)
            better = (least < best[alive]) | ((least == best[alive]) & (first < found[alive]))
            best[alive[better]], found[alive[better]] = least[better], first[better]
        return found, best, computed


def _assignments(books: list[Codebook], width: int):
    def assigned(b: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, list[tuple[np.ndarray, np.ndarray, np.ndarray]]]]:
        for at in range(0, len(b), STEP):
            part = b.slice(at, STEP)
            x = matrix(part.column("v"), width * len(books)).astype(np.int64)
            far = matrix(part.column("far"), sum(c.far.shape[1] for c in books))
            out, p = [], 0
            for i, c in enumerate(books):
                own = x[:, i * width : (i + 1) * width]
                out.append((own, *c.nearest(own, far[:, p : p + c.far.shape[1]])[:2]))
                p += c.far.shape[1]
            yield part, out

    return assigned


def _partial(books: list[Codebook], width: int):
    parts, assigned = len(books), _assignments(books, width)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = [np.zeros(len(c.entries), np.int64) for c in books]
        total = [np.zeros(c.entries.shape, np.int64) for c in books]
        for b in batches:
            for _, out in assigned(b):
                for i, (x, found, _) in enumerate(out):
                    more = by_group(x, found, len(n[i]))
                    n[i], total[i] = n[i] + more[0], total[i] + more[1]
        for i in range(parts):
            on = np.flatnonzero(n[i])
            yield pa.record_batch({"part": pa.array(np.full(len(on), i, np.int32)), "entry": pa.array(on.astype(np.int32)), "n": pa.array(n[i][on]), "total": lists(total[i][on])})

    return add


def _final(books: list[Codebook], width: int):
    assigned = _assignments(books, width)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part, out in assigned(b):
                digits = np.stack([found for _, found, _ in out], 1).astype(np.uint8)
                yield pa.record_batch({
                    "vec_id": part.column("vec_id"), "label": part.column("label"),
                    "code": pa.array([r.tobytes().hex() for r in digits]), "error": pa.array(sum(best for *_, best in out)),
                })

    return assign


def codes(embeddings: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE, n_pivots: int = PIVOTS) -> tuple[DataFrame, np.ndarray] | None:
    """(vec_id, label, code, error) of every vector that takes part, and the codebooks (parts x entries x components of a part); None without vectors."""
    if not 0 < entries <= 256:
        raise ValueError("an entry's index has two hex digits: 1 to 256 entries")
    size = F.size("embedding")
    usable = embeddings.where(finite(F.col("embedding")) & (size > 0) & (size % parts == 0))
    first = usable.agg(F.min(F.struct(F.col("vec_id").isNull().alias("none"), F.col("vec_id").alias("id"), size.alias("dim")))).first()[0]
    if first is None:
        return None
    dim, width = first.dim, first.dim // parts
    kept = usable.where(size == dim).select(F.col("vec_id").cast("long").alias("vec_id"), "label", integers(F.col("embedding"), scale, dim).alias("v"))
    drawn = kept.orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(entries).collect()
    books = np.array([r.v for r in drawn], np.int64).reshape(len(drawn), parts, width).transpose(1, 0, 2).copy()
    fixed = [pivots(b, n_pivots) for b in books]

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = matrix(b.column("v"), dim).astype(np.int64)
            far = np.hstack([distances(x[:, i * width : (i + 1) * width], p) for i, p in enumerate(fixed)])
            yield pa.record_batch({"vec_id": b.column("vec_id"), "label": b.column("label"), "v": b.column("v"), "far": lists(far)})

    kind = dict(kept.dtypes)["label"]
    table = durable(kept.mapInArrow(measure, f"vec_id long, label {kind}, v array<int>, far array<double>"), "measured")
    of_round = lambda: [Codebook(b, p) for b, p in zip(books, fixed, strict=True)]
    for _ in range(rounds):
        for r in sums(table.select("v", "far").mapInArrow(_partial(of_round(), width), "part int, entry int, n long, total array<long>"), ["part", "entry"], width):
            books[r.part, r.entry] = np.array(r.total) // r.n  # rounds down
    return table.mapInArrow(_final(of_round(), width), f"vec_id long, label {kind}, code string, error long"), books


def coded(embeddings: DataFrame, **options: int) -> DataFrame:
    """vec_id, code, error, label_error, codebooks_sha256 of every vector that takes part. Errors are added up before rows
    of a label meet their sum, in a join that Spark may split where a label holds many rows."""
    if (found := codes(embeddings, **options)) is None:
        return embeddings.sparkSession.createDataFrame([], "vec_id long, code string, error long, label_error long, codebooks_sha256 string")
    rows = durable(found[0], "codes")
    per = rows.groupBy(F.col("label").alias("of")).agg(F.sum(F.col("error").cast("decimal(38,0)")).cast("long").alias("label_error"))
    return rows.join(per, F.col("label").eqNullSafe(F.col("of"))).select("vec_id", "code", "error", "label_error", F.lit(digest(found[1])).alias("codebooks_sha256"))


def _oracle() -> str:
    ctes = [
        f"""k AS (SELECT vec_id, label, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)) AS v FROM embeddings
           WHERE len(embedding) > 0 AND len(embedding) % {PARTS} = 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
        "d AS (SELECT len(v) AS dim FROM k ORDER BY vec_id NULLS LAST, dim LIMIT 1)",
        "v AS (SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, v) - 1 AS n, vec_id, label, v FROM k WHERE len(v) = (SELECT dim FROM d))",
        f"p AS (SELECT n, p, v[p * len(v) // {PARTS} + 1:(p + 1) * len(v) // {PARTS}] AS v FROM v, range({PARTS}) AS r(p))",
        f"c0 AS (SELECT p, n AS c, v FROM p WHERE n < {ENTRIES})",
    ]
    for r in range(ROUNDS + 1):
        ctes.append(f"a{r} AS (SELECT p.n, p.p, p.v, min(row(list_inner_product(p.v, p.v) + list_inner_product(c.v, c.v) - 2 * list_inner_product(p.v, c.v), c)) AS best FROM p JOIN c{r} AS c ON p.p = c.p GROUP BY ALL)")
        if r < ROUNDS:
            ctes.append(f"""s{r} AS (SELECT p, c, i, sum(x)::HUGEINT AS s, count(*) AS m FROM (SELECT p, best[2] AS c, unnest(range(1, len(v) + 1)) AS i, unnest(v)::BIGINT AS x FROM a{r}) GROUP BY p, c, i),
m{r} AS (SELECT p, c, list(((s - (s % m + m) % m) // m)::DOUBLE ORDER BY i) AS v FROM s{r} GROUP BY p, c),
c{r + 1} AS (SELECT p, c, coalesce(m.v, o.v) AS v FROM c{r} AS o LEFT JOIN m{r} AS m USING (p, c))""")
    ctes.append(f"e AS (SELECT n, string_agg(printf('%02x', best[2]), '' ORDER BY p) AS code, sum(best[1])::BIGINT AS error FROM a{ROUNDS} GROUP BY n)")
    ctes.append(f"h AS (SELECT sha256(string_agg(array_to_string(list_transform(v, lambda x: x::BIGINT), ','), ',' ORDER BY p, c)) AS h FROM c{ROUNDS})")
    return f"""WITH {", ".join(c.replace("AS (", "AS MATERIALIZED (", 1) for c in ctes)}
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, h AS codebooks_sha256 FROM e JOIN v USING (n), h"""


ORACLE = _oracle()

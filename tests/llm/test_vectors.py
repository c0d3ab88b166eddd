"""Clustering, graph search and codes of vectors: brute force, recall, hard tables and what the filters save."""

import hashlib
from pathlib import Path

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from chronocell.llm import clustering, codes, graph, vectors

SF = "/root/testdata/sf0.001"
ROW = "vec_id long, embedding array<float>, label int"
given = pytest.mark.skipif(not Path(SF).exists(), reason="no test data")


def table(spark, rows, schema=ROW):
    return spark.createDataFrame(rows, schema)


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, wrong lengths, numbers that are none, a zero vector, ties, repeated rows and ids, clashing columns."""
    r = np.random.default_rng(5)
    x = np.round(r.normal(size=(90, 64)) * 4) / 4
    rows = [(i, [float(c) for c in v], i % 3 if i % 7 else None) for i, v in enumerate(x)]
    rows += [(100 + i, rows[3][1], 1) for i in range(30)]  # copies
    rows += [rows[5], rows[5], (6, rows[8][1], 2), (None, rows[9][1], 0), (None, None, 0), (200, None, 1), (201, [1.0] * 63 + [None], 1)]
    rows += [(202, [float("nan")] + [0.0] * 63, 1), (203, [float("inf")] * 64, None), (204, [0.0] * 64, 1), (205, [], 1), (206, [1.0, 2.0, 3.0], 1), (250, [-0.0] * 63 + [1.0], 0)]
    return table(spark, rows).withColumns({"cluster": F.lit("x"), "code": F.lit(1), "v": F.lit("v"), "distance": F.lit(None), "score": F.col("vec_id"), "rank": F.lit(0), "n": F.lit(0)})


def by_sql(sql, df):
    con = duckdb.connect()
    con.register("embeddings", df.toArrow())
    rel = con.sql(sql)
    return sorted(map(repr, (tuple(r[rel.columns.index(c)] for c in sorted(rel.columns)) for r in rel.fetchall())))


def as_rows(df):
    return sorted(repr(tuple(r[c] for c in sorted(df.columns))) for r in df.collect())


def kept_rows(df, scale, dim):
    out = [(r.vec_id, [int(np.floor(scale * float(c))) for c in r.embedding], r.label) for r in df.collect() if r.embedding is not None and len(r.embedding) == dim and all(c is not None and np.isfinite(c) for c in r.embedding)]
    return out


def plain_clusters(rows, k, rounds):
    """Loops over plain integers."""
    seeds = sorted(rows, key=lambda r: (r[0] is None, hashlib.sha256(f"2:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1]))[:k]
    centroids = [list(r[1]) for r in seeds]
    near = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), i) for i, c in enumerate(centroids))
    for _ in range(rounds):
        of = [near(v)[1] for _, v, _ in rows]
        for i in range(len(centroids)):
            own = [v for (_, v, _), o in zip(rows, of, strict=True) if o == i]
            if own:
                centroids[i] = [sum(c) // len(own) for c in zip(*own, strict=True)]
    found = [near(v) for _, v, _ in rows]
    text = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    inertia = [sum(d for d, o in found if o == i) for i in range(len(centroids))]
    return sorted(repr((text[i], i, inertia[i], d, sum(inertia), r[0])) for r, (d, i) in zip(rows, found, strict=True))


def test_clusters_are_those_of_plain_loops(spark, odd):
    got = clustering.clustered(odd, k=7, rounds=3)
    assert got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert as_rows(got) == plain_clusters(kept_rows(odd, 256, 64), 7, 3)
    assert as_rows(clustering.clustered(odd)) == by_sql(clustering.ORACLE, odd)


def test_clusters_of_little(spark, odd):
    assert clustering.clustered(odd.where("false")).count() == 0
    assert clustering.clustered(odd.where("embedding is null")).count() == 0
    few = odd.where("vec_id in (1, 2)")
    assert {(r.distance, r.inertia) for r in clustering.clustered(few).collect()} == {(0, 0)}
    alike = table(spark, [(i, [0.5] * 64, 0) for i in range(60)])
    assert {r.cluster for r in clustering.clustered(alike).collect()} == {0}  # ties: the smaller number; the others stay empty
    with pytest.raises(Exception, match="too large"):
        clustering.clustered(table(spark, [(1, [1e30] * 64, 0), (2, [0.0] * 64, 0)])).count()


def test_bounds_exclude_most_centroids_and_never_the_nearest():
    r = np.random.default_rng(0)
    middle = r.integers(-400, 400, (40, 64))
    x = np.vstack([middle[r.integers(0, 40, 3000)] + r.integers(-20, 20, (3000, 64)), np.full((5, 64), vectors.largest(64)), np.full((5, 64), -vectors.largest(64))])
    c = np.vstack([x[r.integers(0, len(x), 39)], np.full((1, 64), vectors.largest(64))])
    mean = x.mean(0)
    of = clustering.Filter(mean, np.linalg.eigh(np.cov(x.T))[1][:, ::-1], 16)
    found, best, computed = of.nearest(x, *of.rotated(x), c)
    d = np.array([[sum((int(a) - int(b)) ** 2 for a, b in zip(v, e, strict=True)) for e in c] for v in x[::50]])
    assert (found[::50] == d.argmin(1)).all() and (best[::50] == d.min(1)).all()
    assert computed < 0.5 * len(x) * len(c)


def plain_codes(rows, entries, rounds):
    rows = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    cut = lambda v, p: v[p * len(v) // 4 : (p + 1) * len(v) // 4]
    books = [[cut(r[1], p) for r in rows[:entries]] for p in range(4)]
    near = lambda v, p: min((sum((a - b) ** 2 for a, b in zip(v, e, strict=True)), i) for i, e in enumerate(books[p]))
    for _ in range(rounds):
        of = [[near(cut(v, p), p)[1] for _, v, _ in rows] for p in range(4)]
        for p in range(4):
            for i in range(len(books[p])):
                own = [cut(r[1], p) for r, o in zip(rows, of[p], strict=True) if o == i]
                if own:
                    books[p][i] = [sum(c) // len(own) for c in zip(*own, strict=True)]
    found = [[near(cut(v, p), p) for p in range(4)] for _, v, _ in rows]
    text = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    error = [sum(d for d, _ in f) for f in found]
    label = {x: sum(e for e, r in zip(error, rows, strict=True) if r[2] == x) for x in {r[2] for r in rows}}
    return sorted(repr(("".join(f"{i:02x}" for _, i in f), text, e, label[r[2]], r[0])) for r, f, e in zip(rows, found, error, strict=True))


def test_codes_are_those_of_plain_loops(spark, odd):
    got = codes.coded(odd, entries=9, rounds=2)
    assert got.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert as_rows(got) == plain_codes(kept_rows(odd, 1024, 64), 9, 2)
    assert as_rows(codes.coded(odd)) == by_sql(codes.ORACLE, odd)


def test_codes_of_little(spark, odd):
    assert codes.coded(odd.where("false")).count() == 0
    assert codes.coded(odd.where("vec_id in (205, 206, 200)")).count() == 0  # no length that 4 divides
    assert {r.error for r in codes.coded(odd.where("vec_id < 20")).collect()} == {0}  # every vector is an entry
    other = table(spark, [(5, [1.0] * 8, 1), (3, [1.0] * 4, 1), (4, [2.0] * 4, None)])
    assert {r.vec_id for r in codes.coded(other).collect()} == {3, 4}  # the length of the smallest id
    assert {r.code for r in codes.coded(table(spark, [(i, [0.25] * 64, 0) for i in range(300)])).collect()} == {"00000000"}
    assert codes.coded(odd.where("vec_id is null")).count() == 1


def test_pivots_exclude_most_entries_and_never_the_nearest():
    r = np.random.default_rng(1)
    middle = r.integers(-1000, 1000, (256, 16))
    x = middle[r.integers(0, 256, 2000)] + r.integers(-30, 30, (2000, 16))
    for m in (1, 3, 5, 256):
        fixed = codes.pivots(middle[:m], 8)
        book = codes.Codebook(middle[:m] + r.integers(-30, 30, (m, 16)), fixed)
        found, best, computed = book.nearest(x, codes.distances(x, fixed))
        d = ((x[:, None, :] - book.entries) ** 2).sum(2)
        assert (found == d.argmin(1)).all() and (best == d.min(1)).all()
    assert computed < 0.3 * d.size


def plain_nearest(df, k):
    """Every query against every candidate, as sets of distinct rows."""
    rows = {(r.vec_id, tuple(float(c) for c in r.embedding)) for r in df.collect() if r.vec_id is not None and r.embedding is not None and all(c is not None and np.isfinite(c) for c in r.embedding) and any(r.embedding)}
    dim = max((len(v) for _, v in rows), default=0)
    rows = sorted((i, v + (0.0,) * (dim - len(v))) for i, v in rows)
    ids, x = np.array([i for i, _ in rows]), np.array([v for _, v in rows])
    u = x / np.linalg.norm(x, axis=1)[:, None]
    out = {}
    for a in np.flatnonzero(ids % 50 == 0):
        s = u @ u[a]
        s[ids == ids[a]] = -9
        out[ids[a]] = sorted(((-s[j], ids[j]) for j in range(len(ids)) if s[j] > -9))[:k]
    return out


def test_graph_search_finds_neighbours_copies_and_little(spark, odd):
    got = graph.nearest(odd)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    want = plain_nearest(odd, 5)
    rows = sorted(got.collect())
    assert [r.query_id for r in rows] == sorted(q for q, top in want.items() for _ in top)
    for q, top in want.items():
        own = [r for r in rows if r.query_id == q]
        assert [r.rank for r in own] == [1, 2, 3, 4, 5]
        assert np.allclose([r.score for r in own], [-s for s, _ in top])
    copies = [r.vec_id for r in rows if r.query_id == 100]
    assert copies == [3, 101, 102, 103, 104]  # ties to smaller ids, whatever the size of the group
    assert graph.nearest(odd.where("false")).count() == 0
    assert graph.nearest(odd.where("vec_id = 0")).count() == 0  # no candidate
    assert [(r.vec_id, r["rank"]) for r in graph.nearest(odd.where("vec_id in (0, 1)")).collect()] == [(1, 1)]
    far = table(spark, [(0, [1e38, 1e38], 0), (1, [1e38, 2e38], 0), (2, [1e-30, 1e-30], 0)])
    assert [(r.vec_id, round(r.score, 6)) for r in graph.nearest(far).orderBy("rank").collect()] == [(2, 1.0), (1, 0.948683)]


@given
def test_recall(spark):
    df = spark.read.parquet(f"{SF}/embeddings.parquet")
    want = plain_nearest(df, 5)
    got = graph.nearest(df, shard=120)  # five shards
    hits = {(r.query_id, r.vec_id) for r in got.collect()} & {(q, i) for q, top in want.items() for _, i in top}
    assert len(hits) >= 0.99 * 5 * len(want)


def test_recall_in_a_large_shard_whose_edges_are_few():
    r = np.random.default_rng(3)
    x = r.normal(size=(5000, 24)).astype(np.float32)
    x[:2000] = x[0] + 0.01 * x[:2000]  # near copies
    x /= np.linalg.norm(x, axis=1)[:, None]
    g = graph.Graph(x)
    assert (g.edges >= 0).sum(1).max() <= graph.DEGREE and (g.edges >= 0).any(1).all()
    q = x[::50]
    true = np.argsort(-(q @ x.T), axis=1)[:, :6]
    found = g.search(q, graph.SEARCH_BEAM)[0][:, :6]
    assert np.mean([len(set(a) & set(b)) / 6 for a, b in zip(true, found, strict=True)]) >= 0.95

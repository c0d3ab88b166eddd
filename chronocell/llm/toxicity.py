"""Toxicity by non-negative positive-unlabelled learning.

A linear model over the hashed presence of words and word beginnings is fitted with numpy by the class-prior-corrected risk
  prior * E_P[l(f)] + max(0, E_U[l(-f)] - prior * E_P[l(-f)]),  l the logistic loss,
stepping back along the second part whenever it turns negative. Confirmed toxic rows are the positives;
texts taken without regard to their label are the unlabelled ones. The prior is counted over all labelled
training rows.

The training sample is bounded: the texts of at most POSITIVES and UNLABELLED ids (by hash, of the training
folds), one an id and whole, as long as those before them in order of the hash have under SAMPLE bytes of bucket numbers: very
long texts make the sample one of fewer rows, but leave none out for its length. It goes to one task (96 MB and two texts of
at most 4 MB; some 40 MB for usual texts; the fit holds about four times that), which fits the model and returns the weights of
the features in use; neither texts nor sample reach the driver. A feature is in use if LEAST_DF training texts hold it and its share differs by LEAST_Z
standard errors between positives and unlabelled texts: with a full sample, one that only toxic texts hold needs
about 9 of 4000 of them, so a text whose only toxic words are rarer than that (0.2 %) is not caught.

Defined results: null and empty texts score by the intercept alone; a null doc_id is in no held-out fold
and is never trained on; of repeated labels of one id the toxic one holds; with no confirmed toxic row
every score is 0; an empty table gives an empty result; labels, lang, source and doc_id are no features.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chronocell.llm.common import SLICE, row_slices, short_batches, tidy, word_hashes

POSITIVES, UNLABELLED = 4_000, 8_000
BITS = 20
PREFIXES = (3, 4, 5, 6, 7)
FOLDS = 5
SAMPLE = {True: 32 << 20, False: 64 << 20}  # bytes of the positives and of the unlabelled texts
EPOCHS = 150
STEP, DECAY = 0.1, 3e-4
LEAST_DF = 8  # a bucket seen in fewer training texts has weight 0
LEAST_Z = 4.0  # and so has one whose share differs less between positives and unlabelled texts, in standard errors


@dataclass
class Model:
    weights: np.ndarray
    intercept: float


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(F.encode(doc_id.cast("string"), "UTF-8")) % FOLDS == 0, F.lit(False))


def presence(col, useful: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (row, bucket) pairs of a text column's words and word beginnings, sorted by row; only useful buckets."""
    h, row, *more = word_hashes(col, PREFIXES)
    keys = []
    for x in (h, *more):
        on = x != 0
        bucket = x >> np.uint64(64 - BITS)
        if useful is not None:
            on &= useful[bucket]
        keys.append(np.unique((row[on].astype(np.uint64) << np.uint64(BITS)) | bucket[on]))
    key = np.unique(np.concatenate(keys))
    return (key >> np.uint64(BITS)).astype(np.int64), (key & np.uint64((1 << BITS) - 1)).astype(np.int64)


def _buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each text's buckets."""
    for b in batches:
        for lo, hi in row_slices(b.column("text"), SLICE):
            part = b.slice(lo, hi - lo)
            row, bucket = presence(part.column("text"))
            off = np.searchsorted(row, np.arange(hi - lo + 1))
            own = pa.array([bucket[s:e].astype(np.int32).tobytes() for s, e in zip(off[:-1], off[1:], strict=True)], pa.binary())
            yield pa.record_batch({"doc_id": part.column("doc_id"), "h": part.column("h"), "buckets": own})


def fit(rows: list[np.ndarray], positive: np.ndarray, unlabelled: np.ndarray, prior: float, epochs: int = EPOCHS) -> Model:
    """rows: each training text's buckets; positive and unlabelled say which samples it belongs to (or both)."""
    size = 1 << BITS
    if not positive.any() or not unlabelled.any():
        return Model(np.zeros(size, np.float32), -np.inf)
    count = lambda of: np.bincount(np.concatenate([r for r, on in zip(rows, of, strict=True) if on]), minlength=size)
    n_p, n_u = positive.sum(), unlabelled.sum()
    in_p, in_u = count(positive), count(unlabelled)
    both = (in_p + in_u + 1) / (n_p + n_u + 2)
    z = np.abs(in_p / n_p - in_u / n_u) / np.sqrt(both * (1 - both) * (1 / n_p + 1 / n_u))
    used = np.flatnonzero((in_p + in_u >= LEAST_DF) & (z >= LEAST_Z))
    place = np.full(size, -1, np.int32)
    place[used] = np.arange(len(used))
    cols = [place[r] for r in rows]
    cols = [c[c >= 0] for c in cols]
    row, col = np.repeat(np.arange(len(cols), dtype=np.int32), [len(c) for c in cols]), np.concatenate(cols)
    w, bias = np.zeros(len(used) + 1), np.log(prior / (1 - prior))
    w[-1] = bias
    m, v = np.zeros_like(w), np.zeros_like(w)
    p, u = positive / positive.sum(), unlabelled / unlabelled.sum()
    for t in range(1, epochs + 1):
        f = np.bincount(row, w[col], minlength=len(cols)) + w[-1]
        s = 1 / (1 + np.exp(-np.clip(f, -50, 50)))
        loss_neg = np.logaddexp(0, f)
        negative = u @ loss_neg - prior * (p @ loss_neg)
        d_pos, d_neg = prior * p * (s - 1), (u - prior * p) * s
        d = d_pos + d_neg if negative >= 0 else -d_neg
        g = np.r_[np.bincount(col, d[row], minlength=len(used)), d.sum()]
        g[:-1] += DECAY * w[:-1]
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= STEP * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    weights = np.zeros(size, np.float32)
    weights[used] = w[:-1]
    return Model(weights, float(w[-1]))


def _fitted(prior: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The model of the whole sample, which one task holds: features in use, their weights, the intercept."""
        found: dict[bytes, int] = {}  # copies count once
        for b in batches:
            for p, buckets in zip(b.column("p").to_pylist(), b.column("buckets").to_pylist(), strict=True):
                found[buckets] = found.get(buckets, 0) | (1 if p else 2)
        keys = sorted(found)
        kind = np.array([found[k] for k in keys], np.int64)
        model = fit([np.frombuffer(k, np.int32) for k in keys], (kind & 1) > 0, (kind & 2) > 0, prior)
        used = np.flatnonzero(model.weights)
        yield pa.record_batch({"used": [zlib.compress(used.astype(np.int32).tobytes(), 1)], "weights": [model.weights[used].tobytes()], "intercept": [model.intercept]})

    return run


def train(docs: DataFrame, labels: DataFrame, positives: int = POSITIVES, unlabelled: int = UNLABELLED, sample_bytes: dict[bool, int] | None = None) -> Model:
    of_id = F.xxhash64(F.col("doc_id"), F.lit("toxicity"))
    own = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    seen, toxic = own.agg(F.count(F.lit(1)), F.sum("toxic")).first()
    if not toxic:
        return fit([], np.zeros(0, bool), np.zeros(0, bool), 0.5)
    training = docs.where(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    p_ids = own.where("toxic = 1").orderBy(of_id, "doc_id").limit(positives).select("doc_id", F.lit(True).alias("p"))
    u_ids = training.select("doc_id").dropDuplicates().orderBy(of_id, "doc_id").limit(unlabelled).select("doc_id", F.lit(False).alias("p"))
    ids = p_ids.unionByName(u_ids)  # at most positives + unlabelled rows
    texts = training.select("doc_id", F.xxhash64("text").alias("h"), "text").join(F.broadcast(ids.select("doc_id")), "doc_id", "left_semi")
    rows = texts.mapInArrow(tidy(_buckets), "doc_id long, h long, buckets binary").join(F.broadcast(ids), "doc_id")
    sample = rows.groupBy("doc_id", "p").agg(F.min_by("buckets", "h").alias("buckets"))  # one row an id, whatever repeats it
    most = {**SAMPLE, **(sample_bytes or {})}
    before = F.coalesce(F.sum("n").over(Window.partitionBy("p").orderBy(of_id, "doc_id").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))  # of ids and lengths only
    kept = sample.select("doc_id", "p", F.octet_length("buckets").alias("n")).withColumn("before", before).where(F.col("before") < F.when(F.col("p"), most[True]).otherwise(most[False]))
    sample = sample.join(F.broadcast(kept.select("doc_id", "p")), ["doc_id", "p"], "left_semi")
    fitted = sample.select("p", "buckets").coalesce(1).mapInArrow(tidy(_fitted(min(0.95, max(1e-4, toxic / seen)))), "used binary, weights binary, intercept double")
    with short_batches(docs.sparkSession):
        found = fitted.first()  # 4 MB at most
    if found is None:  # no text at all
        return fit([], np.zeros(0, bool), np.zeros(0, bool), 0.5)
    weights = np.zeros(1 << BITS, np.float32)
    weights[np.frombuffer(zlib.decompress(found.used), np.int32)] = np.frombuffer(found.weights, np.float32)
    return Model(weights, found.intercept)


def score(docs: DataFrame, model: Model, name: str = "toxicity_score") -> DataFrame:
    """docs with a column name double; one of that name is replaced."""
    kept = [c for c in docs.columns if c != name]
    sent = docs.sparkSession.sparkContext.broadcast((model.weights, model.intercept))  # 4 MB whatever the input

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, intercept = sent.value
        useful = weights != 0
        for b in batches:
            out = np.zeros(b.num_rows)
            for lo, hi in row_slices(b.column("text"), SLICE):
                row, bucket = presence(b.column("text").slice(lo, hi - lo), useful)
                out[lo:hi] = np.bincount(row, weights[bucket].astype(float), minlength=hi - lo)
            s = 1 / (1 + np.exp(-np.clip(out + intercept, -50, 50))) if np.isfinite(intercept) else out
            yield pa.record_batch([*(b.column(c) for c in kept), pa.array(s)], names=[*kept, name])

    d = docs.select(*[F.col(f"`{c}`") for c in kept])
    return d.mapInArrow(tidy(run), ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in d.schema), f"`{name}` double"]))


def judge(docs: DataFrame, labels: DataFrame, **bounds) -> DataFrame:
    """doc_id, held_out, score, predicted of every row."""
    d = score(docs.select("doc_id", "text"), train(docs, labels, **bounds))
    return d.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("toxicity_score").alias("score"), (F.col("toxicity_score") >= 0.5).cast("int").alias("predicted"))


def clean(docs: DataFrame, labels: DataFrame, **bounds) -> DataFrame:
    """The documents whose score stays under one half, with their columns."""
    name = "toxicity_score"
    while name in docs.columns:
        name += "_"
    return score(docs, train(docs, labels, **bounds), name).where(F.col(name) < 0.5).select(*[F.col(f"`{c}`") for c in docs.columns])

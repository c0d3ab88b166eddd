"""MinHash near-dedup: improved consistent weighted sampling over TF-IDF shingles.

Shingles are runs of five words; a shingle weighs its count times 1 + ln(share) / ln(LEAST_SHARE), share being that of
all documents that hold it, LEAST_SHARE at least. Shares are counted over all documents in 2^21 hash buckets; a bucket
takes up the shares of the shingles that meet in it, about (shingles a text) / 2^21 whatever the corpus, which is
below LEAST_SHARE, so rare shingles weigh 2 at any size.
SAMPLES consistent weighted samples of a text agree with another's with probability of their weighted
Jaccard similarity; BANDS bands of ROWS samples (drawn from all SAMPLES, so bands share some) propose
pairs: one at 0.8 is missed 7.5 in ten thousand times (simulated), one at 0.3 seldom proposed. A rough count of
agreeing samples drops hopeless ones (one at 0.8 seven times in ten million), and the exact weighted Jaccard of the
texts decides.

Exact copies (equal SHA-256) are one node from the start; a node's number is given once, in a written table. A bucket
never emits all its pairs and is never held by one task: its least and greatest node come from partial aggregates, its
members from a join that may be split. Each text is first compared to the least leader of its buckets, then members of
other classes to each bucket's leader. Texts of buckets that still hold several classes get a bound: their rare
shingles, those that one or two of these texts hold, tell what a text can share with others at most. Pairs of a bucket
with a rare shingle in common are listed from the shingles; any other pair shares no more than the lesser of what is
left of the two texts in each of PARTS hash parts, so a text whose rare shingles weigh over 1 - LEAST of it has no
further partner, and a pair under the bound is not near. Members left over become pivots (about 16, then 256, ... a bucket,
by hash) and meet the members of other classes that the bound lets through, until every pair of a bucket is in one class,
excluded by the bound, or compared. Only members outside the class of a bucket's least node need be pivots, and a
round has only the buckets that still have some, so a member is listed as often as its bucket's size has factors of 16. Only texts that are alike but not near (a family of templates) come that far;
there the pairs that the bound cannot exclude are compared one by one, as nothing short of that is exact.
Classes are the connected components, by repeated least labels with durable tables between steps; new pairs
only join classes, so each later step is over the classes that they touch. Tables are deleted once the next is written.

Defined results: null is the empty text; texts without words match only equal texts; of repeated rows with
one id and text all share the class and are kept or not alike (one_of_each() leaves one); a null id is greater than
all others (a class of null ids only has a null class_id); an empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronocell.llm.common import SLICE, durable, mix64, release, row_slices, shingles, short_batches, tidy

K = 5
LEAST = 0.8
SAMPLES = 72
ROWS, BANDS = 7, 64
HOPELESS = 0.55  # share of agreeing samples
DF_BITS, DF_BLOCKS = 21, 64
LEAST_SHARE = 1e-3
PARTS = 64  # hash parts of the bound
LAST = (1 << 63) - 1
_U = np.uint64


def _draws() -> tuple[np.ndarray, ...]:
    rng = np.random.Generator(np.random.PCG64(20240229))
    n = 1 << 16
    gamma = lambda: -np.log(rng.random(n) * rng.random(n) + 1e-300)  # Gamma(2, 1)
    return gamma().astype(np.float32), np.log(gamma()).astype(np.float32), rng.integers(1, 1 << 63, (SAMPLES, 2), dtype=np.uint64) | _U(1), np.stack([rng.permutation(SAMPLES)[:ROWS] for _ in range(BANDS)])


R, LN_C, SEEDS, CHOSEN = _draws()


def counted(col, k: int = K) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, shingle and count of each row's different shingles, sorted."""
    h, row = shingles(col, k)
    order = np.lexsort((h, row))
    h, row = h[order], row[order]
    if not len(h):
        return row, h, np.zeros(0, np.int64)
    s = np.flatnonzero(np.r_[True, (h[1:] != h[:-1]) | (row[1:] != row[:-1])])
    return row[s], h[s], np.diff(np.r_[s, len(h)])


def document_frequencies(docs: DataFrame) -> tuple[np.ndarray, int]:
    """Documents a hash bucket of shingles, and documents in all. Partial counts are summed in two steps."""
    size = (1 << DF_BITS) // DF_BLOCKS

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, n, part = np.zeros(1 << DF_BITS, np.int64), 0, 0
        for b in batches:
            n += b.num_rows
            part = b.column("part")[0].as_py() if b.num_rows else part
            for lo, hi in row_slices(b.column("text"), SLICE):
                h, row = shingles(b.column("text").slice(lo, hi - lo), K)
                key = np.unique((row.astype(np.uint64) << _U(DF_BITS)) | (h >> _U(64 - DF_BITS)))
                np.add.at(df, (key & _U((1 << DF_BITS) - 1)).astype(np.int64), 1)
        if n:
            blocks = [zlib.compress(x.tobytes(), 1) for x in df.reshape(DF_BLOCKS, size)]
            yield pa.record_batch({"block": pa.array([*range(DF_BLOCKS), -1], pa.int32()), "part": pa.array([part] * (DF_BLOCKS + 1), pa.int32()), "n": pa.array([0] * DF_BLOCKS + [n], pa.int64()), "counts": pa.array([*blocks, b""], pa.binary())})

    def add(t: pa.Table) -> pa.Table:
        total = np.zeros(size, np.int64)
        for c in t.column("counts"):
            if c.as_py():
                total += np.frombuffer(zlib.decompress(c.as_py()), np.int64)
        return pa.table({"block": t.column("block")[:1], "part": pa.array([0], pa.int32()), "n": pa.array([sum(t.column("n").to_pylist())], pa.int64()), "counts": pa.array([zlib.compress(total.tobytes(), 1)], pa.binary())})

    kind = "block int, part int, n long, counts binary"
    parts = docs.select("text", F.pmod(F.spark_partition_id(), F.lit(64)).alias("part")).mapInArrow(tidy(count), kind)
    rows = parts.groupBy("block", "part").applyInArrow(add, kind).groupBy("block").applyInArrow(add, kind).collect()  # 65 rows, 4 MB at most
    df = np.zeros((DF_BLOCKS, size), np.int64)
    for r in rows:
        if r.block >= 0:
            df[r.block] = np.frombuffer(zlib.decompress(r.counts), np.int64)
    return df.ravel(), sum(r.n for r in rows)


def idf_table(df: np.ndarray, n: int) -> np.ndarray:
    share = np.clip(np.maximum(df, 1) / max(n, 1), LEAST_SHARE, 1)
    return (1 + np.log(share) / np.log(LEAST_SHARE)).astype(np.float32)


def samples(row: np.ndarray, h: np.ndarray, weight: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(rows that have shingles, their SAMPLES 32-bit samples)."""
    some = np.unique(row)
    out = np.zeros((len(some), SAMPLES), np.uint32)
    if not len(some):
        return some, out
    start = np.searchsorted(row, some)
    ln_w = np.log(weight).astype(np.float32)
    place = np.arange(len(h), dtype=np.int64)
    for k in range(SAMPLES):
        x = (h ^ SEEDS[k, 0]) * SEEDS[k, 1]
        x ^= x >> _U(32)
        x *= _U(0xD6E8FEB86659FD93)
        r = R[x >> _U(48)]
        beta = (x & _U(0xFFFFFFFF)).astype(np.float32) * np.float32(2**-32)
        t = np.floor(ln_w / r + beta)
        ln_a = LN_C[(x >> _U(32)) & _U(0xFFFF)] - r * (t - beta + np.float32(1))
        i = ln_a.view(np.int32)
        key = ((i ^ ((i >> 31) & np.int32(0x7FFFFFFF))).astype(np.int64) << 32) | place  # order of the float, then place
        at = np.minimum.reduceat(key, start) & 0xFFFFFFFF
        out[:, k] = mix64(h[at] ^ (t[at].astype(np.int64).astype(np.uint64) * _U(0x9E3779B97F4A7C15))) >> _U(32)
    return some, out


def _weighted(col, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    row, h, count = counted(col)
    return row, h, count * idf[h >> _U(64 - DF_BITS)]


def _sketches(idf):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = idf.value
        for b in batches:
            for lo, hi in row_slices(b.column("text"), 1 << 19):
                part = b.slice(lo, hi - lo)
                row, h, w = _weighted(part.column("text"), table)
                some, s = samples(row, h, w, part.num_rows)
                sketch = np.full(part.num_rows, None, object)
                sketch[some] = [x.tobytes() for x in s]
                yield pa.record_batch({"doc_id": part.column("doc_id"), "digest": part.column("digest"), "sketch": pa.array(sketch.tolist(), pa.binary())})

    return run


def _bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        if b.num_rows:
            x = np.frombuffer(b"".join(b.column("sketch").to_pylist()), np.uint32).reshape(-1, SAMPLES).astype(np.uint64)
            total = np.broadcast_to(np.arange(BANDS, dtype=np.uint64), (len(x), BANDS))
            for j in range(ROWS):
                total = mix64(total * _U(0x9E3779B97F4A7C15) + x[:, CHOSEN[:, j]])
            yield pa.record_batch({"bucket": pa.array(total.ravel().view(np.int64)), "node": pa.array(np.repeat(b.column("node").to_numpy(), BANDS))})


def _agree(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Keeps the pairs whose sketches agree often enough."""
    for b in batches:
        if b.num_rows:
            x, y = (np.frombuffer(b"".join(b.column(c).to_pylist()), np.uint32).reshape(-1, SAMPLES) for c in ("sa", "sb"))
            on = pa.array((x == y).mean(1) >= HOPELESS)
            yield pa.record_batch({"a": b.column("a").filter(on), "b": b.column("b").filter(on)})


def _verify(idf):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = idf.value
        for b in batches:
            for lo in range(0, b.num_rows, 500):
                part = b.slice(lo, 500)
                n = part.num_rows
                both = pa.concat_arrays([part.column("ta").cast(pa.large_string()), part.column("tb").cast(pa.large_string())])
                row, h, w = _weighted(both, table)
                total = np.bincount(row, w, minlength=2 * n)
                pair, h2 = row % n, h
                order = np.lexsort((h2, pair))
                p, q, v = pair[order], h2[order], w[order]
                twin = np.flatnonzero((p[1:] == p[:-1]) & (q[1:] == q[:-1]))
                common = np.bincount(p[twin], np.minimum(v[twin], v[twin + 1]), minlength=n)
                whole = total[:n] + total[n:] - common
                on = pa.array(common >= (LEAST - 1e-9) * whole)
                yield pa.record_batch({"a": part.column("a").filter(on), "b": part.column("b").filter(on)})

    return run


def _postings(idf):
    """Each text's different shingles with their weight."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = idf.value
        for b in batches:
            for lo, hi in row_slices(b.column("text"), 1 << 19):
                part = b.slice(lo, hi - lo)
                row, h, w = _weighted(part.column("text"), table)
                node = part.column("node").to_numpy()
                yield pa.record_batch({"shingle": pa.array(h.view(np.int64)), "node": pa.array(node[row]), "w": pa.array(w.astype(np.float64))})

    return run


def _part_weights(idf):
    """Each text's weight, whole and by hash part of its shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = idf.value
        for b in batches:
            for lo, hi in row_slices(b.column("text"), 1 << 19):
                part = b.slice(lo, hi - lo)
                n = part.num_rows
                row, h, w = _weighted(part.column("text"), table)
                by = np.bincount(row * PARTS + (h & _U(PARTS - 1)).astype(np.int64), w, minlength=n * PARTS)
                parts = pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * PARTS), pa.array(by))
                yield pa.record_batch({"node": part.column("node"), "whole": pa.array(np.bincount(row, w, minlength=n).astype(np.float64)), "parts": parts})

    return run


def rare_weights(texts: DataFrame, idf) -> tuple[DataFrame, DataFrame]:
    """(node, whole, left, parts): each text's weight and what its rare shingles leave of it, whole and by hash part;
    and (a, b, w): the weight of the rare shingles that both texts of a pair hold, of pairs that have some.

    A shingle is rare if one or two of the texts hold it, so count, least and greatest holder tell all of it:
    every step is a sum that tasks prepare, however many texts hold a shingle.
    """
    found = texts.select("node", "text").mapInArrow(tidy(_postings(idf)), "shingle long, node long, w double")
    held = F.struct("node", "w")
    by = found.groupBy("shingle").agg(F.count(F.lit(1)).alias("n"), F.min(held).alias("x"), F.max(held).alias("y")).where("n <= 2")
    alone = lambda s: F.struct(F.col(f"{s}.node").alias("a"), F.lit(None).cast("long").alias("b"), F.col(f"{s}.w").alias("w"))
    both = F.struct(F.col("x.node").alias("a"), F.col("y.node").alias("b"), F.least("x.w", "y.w").alias("w"))
    rows = by.select(F.col("shingle").bitwiseAND(F.lit(PARTS - 1)).cast("int").alias("part"), F.explode(F.when(F.col("n") == 1, F.array(alone("x"))).otherwise(F.array(alone("x"), alone("y"), both))).alias("r"))
    with short_batches(texts.sparkSession):
        rows = durable(rows.select("part", "r.*").groupBy("a", "b", "part").agg(F.sum("w").alias("w")))
    rare = rows.where("b is null").groupBy("a").agg(F.map_from_entries(F.collect_list(F.struct("part", "w"))).alias("rare"))  # PARTS entries at most
    of = texts.select("node", "text").mapInArrow(tidy(_part_weights(idf)), "node long, whole double, parts array<double>")
    of = of.join(rare.withColumnRenamed("a", "node"), "node", "left")
    less = F.transform("parts", lambda x, i: F.greatest(x - F.coalesce(F.element_at("rare", i), F.lit(0.0)), F.lit(0.0)).cast("float"))
    left = of.select("node", "whole", less.alias("parts")).withColumn("left", F.aggregate("parts", F.lit(0.0), lambda t, x: t + x))
    return left, rows.where("b is not null").groupBy("a", "b").agg(F.sum("w").alias("w"))


def _possible(a: str, b: str, shared=0.0):
    """Whether two texts can be near that share the rare weight given, and otherwise at most the lesser of what is left of them in each part."""
    least = F.lit(LEAST - 1e-6) * (F.col(f"whole{a}") + F.col(f"whole{b}"))
    near = lambda most: (most + F.lit(shared)) * F.lit(1 + LEAST - 1e-6) >= least
    by_part = F.aggregate(F.zip_with(f"parts{a}", f"parts{b}", lambda x, y: F.least(x, y)), F.lit(0.0), lambda t, x: t + x)
    return near(F.least(f"left{a}", f"left{b}")) & near(by_part)


def joined(label: DataFrame, edges: DataFrame) -> DataFrame:
    """label with the classes joined that the further edges connect, in the form of components; both are used up."""
    own = lambda c: label.select(F.col("node").alias(c), F.col("label").alias(f"l{c}"))
    ends = edges.join(own("a"), "a", "left").join(own("b"), "b", "left").select(F.coalesce("la", "a").alias("a"), F.coalesce("lb", "b").alias("b"))
    ends = durable(ends.where("a <> b").dropDuplicates())
    release(edges)
    if ends.isEmpty():
        release(ends)
        return label
    found = components(ends)
    now = found.select(F.col("node").alias("label"), F.col("label").alias("least"))
    old = label.join(now, "label", "left").select("node", F.coalesce("least", "label").alias("label"))
    new = now.join(label.select(F.col("node").alias("label")), "label", "left_anti")
    out = durable(old.union(new))
    release(label, found)
    return out


def components(edges: DataFrame) -> DataFrame:
    """(node, label): the least node of each node's component, for nodes with an edge. edges are used up.

    Labels start at the least neighbour; each step takes the least label around and the label's own label.
    """
    both = durable(edges.select("a", "b").union(edges.select("b", "a")).dropDuplicates())
    release(edges)
    now = durable(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("label"), F.lit(True).alias("changed")))
    while True:
        around = both.join(now.select(F.col("node").alias("b"), "label"), "b").groupBy("a").agg(F.min("label").alias("l1"))
        jump = now.select(F.col("node").alias("label"), F.col("label").alias("l2"))
        new = now.join(around, F.col("node") == F.col("a")).join(jump, "label", "left")
        least = F.least("label", "l1", F.coalesce("l2", "label"))
        new = durable(new.select("node", least.alias("label"), (least != F.col("label")).alias("changed")))
        release(now)
        now = new
        if now.where("changed").isEmpty():
            release(both)
            return now


def _identity() -> tuple[Column, Column, Column]:
    """doc_id (LAST for null), text (empty for null) and digest (SHA-256 of the text) of a row."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)), text, F.unhex(F.sha2(text.cast("binary"), 256))


def classes(docs: DataFrame) -> DataFrame:
    """doc_id, class_id (least id of the class), class_size (rows), kept (this row stays) of every row."""
    null = lambda c: F.when(F.col(c) != LAST, F.col(c)).alias(c)
    return _judged(docs).select(null("doc_id"), null("class_id"), "class_size", "kept")


def _judged(docs: DataFrame) -> DataFrame:
    """classes with the digest of every row, and LAST for a null id."""
    spark = docs.sparkSession
    doc_id, text, digest = _identity()
    d = docs.select(doc_id.alias("doc_id"), text.alias("text"), digest.alias("digest"))
    with short_batches(spark):
        df, n = document_frequencies(d)
    idf = spark.sparkContext.broadcast(idf_table(df, n))  # 8 MB whatever the input
    with short_batches(spark):
        sketched = durable(d.mapInArrow(tidy(_sketches(idf)), "doc_id long, digest binary, sketch binary"))
    one = sketched.groupBy("digest").agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("copies"), F.any_value("sketch").alias("sketch"))
    nodes = durable(one.withColumn("node", F.monotonically_increasing_id()))  # numbers hold from here on, as they are written

    bands = nodes.where("sketch is not null").select("node", "sketch").mapInArrow(tidy(_bands), "bucket long, node long")
    shared = durable(bands.groupBy("bucket").agg(F.min("node").alias("leader"), F.max("node").alias("other")).where("leader <> other").select("bucket", "leader"))
    members = durable(bands.join(shared, "bucket").select("bucket", "node", "leader"))
    release(shared)

    # texts of all nodes that share a bucket, from the row of the node's least id: shuffled whole once
    needed = members.select("node").dropDuplicates().join(nodes.select("node", "digest", F.col("rep").alias("doc_id")), "node")
    pool = durable(d.join(needed, ["digest", "doc_id"]).dropDuplicates(["node"]).select("node", "text"))

    def tested(pairs: DataFrame) -> DataFrame:
        """Pairs (a < b) that are near copies."""
        p = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b").dropDuplicates()
        s = nodes.select("node", "sketch")
        p = p.join(s.select(F.col("node").alias("a"), F.col("sketch").alias("sa")), "a").join(s.select(F.col("node").alias("b"), F.col("sketch").alias("sb")), "b")
        p = durable(p.mapInArrow(tidy(_agree), "a long, b long"))
        both = p.join(pool.select(F.col("node").alias("b"), F.col("text").alias("tb")), "b").join(pool.select(F.col("node").alias("a"), F.col("text").alias("ta")), "a")
        with short_batches(spark):
            out = durable(both.mapInArrow(tidy(_verify(idf)), "a long, b long"))
        release(p)
        return out

    def labelled(members: DataFrame, label: DataFrame) -> DataFrame:
        """members with their class."""
        return members.join(label.select("node", "label"), "node", "left").withColumn("label", F.coalesce("label", "node"))

    def mixed(own: DataFrame) -> DataFrame:
        """The buckets that hold several classes, with that of their least node, which stays one class as classes are joined."""
        by = own.groupBy("bucket").agg(F.min("label").alias("l"), F.max("label").alias("m"), F.min_by("label", "node").alias("first"))
        return by.where("l <> m").select(F.col("bucket").alias("_bucket"), "first")

    def outside(own: DataFrame) -> DataFrame:
        """The members of other classes than their bucket's least node."""
        return own.join(mixed(own), (F.col("bucket") == F.col("_bucket")) & (F.col("label") != F.col("first"))).drop("_bucket", "first")

    edges = tested(members.groupBy("node").agg(F.min("leader").alias("leader")).select(F.col("leader").alias("a"), F.col("node").alias("b")))
    label = components(edges)
    label = joined(label, tested(outside(labelled(members, label)).select(F.col("leader").alias("a"), F.col("node").alias("b"))))
    own = labelled(members, label)
    own = durable(own.join(mixed(own).select(F.col("_bucket").alias("bucket")), "bucket", "left_semi").drop("label"))
    release(members)
    if not own.isEmpty():
        texts = durable(pool.join(own.select("node").dropDuplicates(), "node", "left_semi"))
        left, twos = rare_weights(texts, idf)
        with short_batches(spark):
            left = durable(left)
        every = lambda c: left.select(F.col("node").alias(c), *(F.col(x).alias(f"{x}_{c}") for x in ("whole", "left", "parts")))
        twos = twos.join(every("a"), "a").join(every("b"), "b").where(_possible("_a", "_b", F.col("w"))).select("a", "b")
        in_bucket = lambda c: own.select(F.col("node").alias(c), "bucket")
        twos = twos.join(in_bucket("a"), "a").join(in_bucket("b"), ["b", "bucket"]).select("a", "b")
        label = joined(label, tested(twos))
        release(texts)
        members = durable(own.select("bucket", "leader", "node").join(left.where(F.col("left") >= F.lit(LEAST - 1e-6) * F.col("whole")), "node"))
        used, pivots = None, 16
        while not members.isEmpty():
            now = labelled(members, label)
            rest = outside(now)
            if used is not None:
                rest = rest.join(used, ["bucket", "node"], "left_anti")
            rest = durable(rest)
            if rest.isEmpty():
                release(rest)
                break
            many = durable(rest.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > pivots))
            chosen = rest.join(many, "bucket", "left").where(F.col("n").isNull() | (F.pmod(F.xxhash64("node", F.lit(pivots)), "n") < pivots))
            chosen = durable(chosen.select("bucket", F.col("node").alias("pivot"), *(F.col(c).alias(f"{c}_p") for c in ("label", "left", "whole", "parts"))))
            on = (F.col("label") != F.col("label_p")) & (F.col("node") != F.col("leader")) & _possible("", "_p")
            pairs = now.withColumnRenamed("bucket", "_bucket").join(chosen, (F.col("_bucket") == F.col("bucket")) & on).select(F.col("pivot").alias("a"), F.col("node").alias("b"))
            near = tested(pairs)
            mine = chosen.select("bucket", F.col("pivot").alias("node"))
            before, used = used, durable((mine if used is None else used.union(mine)).join(many, "bucket", "left_semi"))
            label = joined(label, near)
            smaller = durable(members.join(many, "bucket", "left_semi"))  # of the others, all have been pivots
            release(rest, chosen, many, members, *([before] if before is not None else []))
            members, pivots = smaller, 16 * pivots
        release(members, *([used] if used is not None else []))

    release(pool, own)
    of = nodes.join(label.select("node", "label"), "node", "left").select("digest", "rep", "copies", F.coalesce("label", "node").alias("label"))
    whole = of.groupBy("label").agg(F.min("rep").alias("class_id"), F.sum("copies").alias("class_size"), F.min(F.struct("rep", "digest")).alias("stays"))
    first = of.join(whole, "label").select("digest", "class_id", "class_size", (F.col("digest") == F.col("stays.digest")).alias("chosen"))
    out = sketched.select("doc_id", "digest").join(first, "digest")
    return out.select("doc_id", "digest", "class_id", "class_size", (F.col("chosen") & (F.col("doc_id") == F.col("class_id"))).alias("kept"))


def one_of_each(docs: DataFrame) -> DataFrame:
    """docs without near copies: of each class the row of the chosen text with the least id stays (one, where rows repeat id and text)."""
    stay = durable(_judged(docs).where("kept").groupBy("doc_id", "digest").agg(F.count(F.lit(1)).alias("times")))
    doc_id, _, digest = _identity()
    own = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), doc_id.alias("id"), digest.alias("digest"))
    out = own.join(stay.select(F.col("doc_id").alias("id"), "digest"), ["id", "digest"], "left_semi")
    if not stay.where("times > 1").isEmpty():  # rows that repeat id and text
        out = out.dropDuplicates(["id", "digest"])
    return out.select("row.*")

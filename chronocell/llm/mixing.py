"""Mixing sources to target weights.

Every row gets a hash-random key (of its id and text, so neither a null nor a repeated id is a hot one); the key's
leading bits give it a range bucket in its source. Bucket totals (aggregated before the shuffle) are summed along each
source, rows are sorted inside their (source, bucket) only, so no task holds a whole source however large it is. A
source's budget buys whole epochs first; the rest is cut exactly where the running sum of sizes reaches it. Rows
without words take no part in the sums, however many they are. Sources are few (kinds of data, not hosts): their
table of one row each, and those rows alone, are ordered in one task and may be broadcast.

Defined results: a null or empty text has size 0 and is never taken; a null source is a source of its
own, last in order; repeated rows each count; an empty table gives an empty result; mix() replaces columns
of the input named like an output, mixed_documents() keeps all. Ties of the key fall to doc_id, then size; rows equal
in all of these are interchangeable.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chronocell.llm.common import partitions

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
MOST_EPOCHS = 3
BUCKET_ROWS = 50_000
OUT = ("size", "source_size", "target", "epochs", "part", "taken")


def size_of(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def random_key(doc_id: Column, text: Column) -> Column:
    """60 bits of md5 of id and text, as text of 15 hex digits."""
    return F.substring(F.md5(F.concat(F.coalesce(doc_id.cast("string"), F.lit("null")), F.lit(" "), F.coalesce(text, F.lit("")))), 1, 15)


def source_targets(sizes: DataFrame, weights=WEIGHTS, most: int = MOST_EPOCHS) -> DataFrame:
    """(source, source_size) to targets: water-filling by weight under caps of most times the size.

    Sources are sorted by the level at which their cap binds; at the right place the level that the
    uncapped ones share no longer passes the next cap. The table has one row a source.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))).cast("int") + 1)
    s = sizes.withColumn("_w", w).withColumn("_cap", F.lit(float(most)) * F.col("source_size")).withColumn("_bind", F.col("_cap") / F.col("_w"))
    order = Window.orderBy("_bind", F.col("source").asc_nulls_last())
    s = s.withColumn("_full", F.coalesce(F.sum("_cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
    s = s.withColumn("_open", F.sum("_w").over(order.rowsBetween(0, Window.unboundedFollowing)))
    s = s.withColumn("_level", (F.sum("source_size").over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)) - F.col("_full")) / F.col("_open"))
    s = s.withColumn("_at", F.max(F.when(F.col("_level") <= F.col("_bind"), F.col("_level"))).over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    return s.select("source", "source_size", F.least("_cap", F.col("_at") * F.col("_w")).alias("target"))


def _mixed(docs: DataFrame, weights, most: int, bucket_rows: int) -> DataFrame:
    """docs, its columns named c0, c1, ..., with n (size), source_size, target, epochs and part."""
    spark = docs.sparkSession
    buckets = max(2 * partitions(spark), -(-docs.count() // bucket_rows))
    text = F.coalesce(F.col("text"), F.lit(""))
    own = [F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns)]
    some = docs.where(text.rlike(WORD)).select(*own, "source", F.col("doc_id").alias("id"), size_of(F.col("text")).alias("n"), random_key(F.col("doc_id"), F.col("text")).alias("key"))
    high = F.conv(F.substring("key", 1, 8), 16, 10).cast("long")
    some = some.withColumn("bucket", F.shiftright(high * F.lit(buckets), 32))
    none = docs.where(~text.rlike(WORD)).select(*own, "source")

    totals = some.groupBy("source", "bucket").agg(F.sum("n").alias("sum"))
    along = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.withColumn("start", F.coalesce(F.sum("sum").over(along), F.lit(0)))
    sizes = totals.select("source", "sum").unionByName(none.select("source", F.lit(0).cast("long").alias("sum"))).groupBy("source").agg(F.sum("sum").alias("source_size"))
    target = source_targets(sizes, weights, most).withColumnRenamed("source", "of")
    starts = starts.join(target, F.col("source").eqNullSafe(F.col("of"))).select("of", F.col("bucket").alias("in"), "start", "source_size", "target")

    within = Window.partitionBy("source", "bucket").orderBy("key", "id", "n").rowsBetween(Window.unboundedPreceding, -1)
    some = some.withColumn("before", F.coalesce(F.sum("n").over(within), F.lit(0)))
    some = some.join(starts, F.col("source").eqNullSafe(F.col("of")) & (F.col("bucket") == F.col("in")))
    budget = F.round("target").cast("long")
    epochs = F.coalesce(F.floor(F.try_divide(budget, F.col("source_size"))).cast("long"), F.lit(0).cast("long")).alias("epochs")
    columns = [*(f"c{i}" for i in range(len(docs.columns))), "n", "source_size", "target", "epochs"]
    rest = budget - F.col("epochs") * F.col("source_size") - F.col("start") - F.col("before")
    some = some.select("*", epochs).select(*columns, F.greatest(F.lit(0).cast("long"), F.least(F.col("n"), rest)).alias("part"))
    zero = F.lit(0).cast("long")
    none = none.join(target, F.col("source").eqNullSafe(F.col("of"))).select("*", zero.alias("n"), epochs).select(*columns, zero.alias("part"))
    return some.unionByName(none)


def mix(docs: DataFrame, weights=WEIGHTS, most: int = MOST_EPOCHS, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """docs with OUT: epochs whole passes, part words of one more pass, taken their sum in words."""
    m = _mixed(docs, weights, most, bucket_rows)
    return m.select(
        *[F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns) if c not in OUT],
        F.col("n").alias("size"), "source_size", "target", "epochs", "part",
        (F.col("epochs") * F.col("n") + F.col("part")).alias("taken"),
    )


def mixed_documents(docs: DataFrame, weights=WEIGHTS, most: int = MOST_EPOCHS, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """The mix as documents: one row a whole pass; the document at the cut stays whole if at least half is taken."""
    copies = F.col("epochs") + F.when((F.col("part") > 0) & (2 * F.col("part") >= F.col("n")), 1).otherwise(0)
    m = _mixed(docs, weights, most, bucket_rows).where(copies > 0).withColumn("i", F.explode(F.sequence(F.lit(1).cast("long"), copies)))
    return m.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns)])


ORACLE = r"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
                  substr(md5(concat(coalesce(CAST(doc_id AS VARCHAR), 'null'), ' ', coalesce(text, ''))), 1, 15) AS k FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, [5.0::DOUBLE, 2.0::DOUBLE, 1.0::DOUBLE][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::BIGINT] AS w, 3.0::DOUBLE * source_size AS cap FROM s),
l AS (SELECT *, cap / w AS bind,
             (sum(source_size) OVER ()::DOUBLE - coalesce(sum(cap) OVER (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0))
             / sum(w) OVER (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS lev FROM w),
t AS (SELECT source, source_size, least(cap, max(CASE WHEN lev <= bind THEN lev END) OVER () * w) AS target FROM l),
r AS (SELECT doc_id, size, source_size, target, round(target)::BIGINT AS budget,
             CASE WHEN source_size = 0 THEN 0 ELSE round(target)::BIGINT // source_size END AS epochs,
             coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY k, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
p AS (SELECT *, greatest(0, least(size, budget - epochs * source_size - before))::BIGINT AS part FROM r)
SELECT doc_id, size, source_size, target, (epochs * size + part)::BIGINT AS taken, epochs::BIGINT AS epochs, part FROM p
"""

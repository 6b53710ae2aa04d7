"""Mixing sources to target weights.

Each row gets a hash-random key; rows are ordered by it within their source, a distributed prefix sum of sizes runs over that
order, and every source is cut at its exact budget, after as many whole epochs as the budget holds.
"""

from __future__ import annotations

from math import isqrt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from segloom.llm.common import WORD, cut

#: A hash bucket of a source, which one task orders, has about so many rows, or the root of the source's rows if that is more.
BUCKET_ROWS = 500
#: The targets of so many sources, a row of numbers each, are sent to all tasks; of more they are joined by an exchange.
FEW_SOURCES = 100_000


def targets(totals: DataFrame, weights: tuple[int, ...], cap: int) -> DataFrame:
    """totals (mix_name, mix_source_size, mix_n; a row for each source) with mix_rank, mix_target, mix_epochs, mix_rest and mix_buckets.

    The targets share the sum of all sizes by weight; none exceeds cap times its source's size, and what is above goes to the others by
    weight until none is above. Sources are capped in the order of size by weight, so prefix sums over that order settle it: a source is
    capped if its share of what those before it leave is above its cap. All is whole numbers; windows over all sources are one task
    each, which sorts rows of a few numbers and spills.
    """
    wide = lambda c: c.cast("decimal(38,0)")
    every = Window.partitionBy(F.lit(0))
    rank = F.row_number().over(every.orderBy(F.col("mix_name").asc_nulls_last())) - 1
    w = wide(F.element_at(F.array(*[F.lit(x) for x in weights]), (1 + F.col("mix_rank") % len(weights)).cast("int")))
    rows = totals.withColumn("mix_rank", rank).withColumn("w", w).withColumn("total", wide(F.col("mix_source_size")))
    order = every.orderBy(F.col("total").cast("double") / F.col("w").cast("double"), "mix_rank")
    before, after = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    rows = rows.withColumns({"k": F.row_number().over(order), "rest": wide(F.sum("total").over(every)) - cap * wide(F.coalesce(F.sum("total").over(before), F.lit(0))), "left": wide(F.sum("w").over(after))})
    capped = F.max(F.when(wide(F.col("rest") * F.col("w")) > cap * wide(F.col("total") * F.col("left")), F.col("k")).otherwise(0)).over(every)
    rows = rows.withColumn("capped", capped)
    at = F.col("k") == F.col("capped") + 1
    rows = rows.withColumns({"rest": F.max(F.when(at, F.col("rest"))).over(every), "left": F.max(F.when(at, F.col("left"))).over(every), "full": F.col("k") <= F.col("capped")})
    share = wide(F.col("rest") * F.col("w"))
    exact = wide((share - share % F.col("left")) / F.col("left"))  # a decimal quotient is rounded, so the remainder is taken off first
    budget = F.when(F.col("full"), wide(cap * F.col("total"))).otherwise(exact)
    target = F.when(F.col("full"), (cap * F.col("total")).cast("double")).otherwise(share.cast("double") / F.col("left").cast("double"))
    some = F.col("total") > 0
    rest = F.when(some, budget % F.col("total")).otherwise(0)
    epochs = F.when(some, (budget - budget % F.col("total")) / F.col("total")).otherwise(0)
    n = F.col("mix_n")
    buckets = F.greatest(F.lit(1), F.ceil(n / F.greatest(F.lit(BUCKET_ROWS), F.floor(F.sqrt(n)))))
    return rows.select("mix_name", "mix_rank", "mix_source_size", target.alias("mix_target"), epochs.cast("long").alias("mix_epochs"), rest.cast("long").alias("mix_rest"), buckets.cast("int").alias("mix_buckets"))


def buckets_for(rows: int) -> int:
    """Hash buckets for so many rows: neither the buckets nor the rows in one grow faster than the root of the rows."""
    return max(1, -(-rows // max(BUCKET_ROWS, isqrt(rows))))


def random_key(*columns: str) -> Column:
    """Hex digest that orders rows at random and alike in every run."""
    return F.md5(F.concat_ws("|", F.lit("mix"), *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]))


def mix(docs: DataFrame, size: str = "size", source: str = "source", doc_id: str = "doc_id", weights: tuple[int, ...] = (5, 2, 1), cap: int = 3) -> DataFrame:
    """docs with mix_source_size, mix_target (double), mix_taken and mix_key; one row for each row of docs, repeated rows included.

    mix_taken is how many units of the row's size the mix takes: whole epochs times the size, and in the last epoch what is left
    of the budget when the row's turn comes. A source's mix_taken add up to its target, rounded down. Sources are ranked by code
    point, null last, and weights repeat over that order. A null size counts as 0. Columns of docs keep their names; names that
    begin with mix_ are replaced.
    """
    docs = docs.drop(*[c for c in docs.columns if c.startswith("mix_")])
    units = F.coalesce(F.col(size).cast("long"), F.lit(0))
    table = cut(targets(docs.groupBy(F.col(source).alias("mix_name")).agg(F.sum(units).alias("mix_source_size"), F.count("*").alias("mix_n")), weights, cap), "sources")
    table = F.broadcast(table) if table.count() <= FEW_SOURCES else table
    keyed = docs.withColumn("mix_key", random_key(doc_id)).join(table, F.col(source).eqNullSafe(F.col("mix_name")))
    keyed = keyed.withColumn("mix_bucket", (F.conv(F.substring("mix_key", 1, 8), 16, 10).cast("long") * F.col("mix_buckets") / 4294967296).cast("int"))
    before = Window.partitionBy("mix_rank").orderBy("mix_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = keyed.groupBy("mix_rank", "mix_bucket").agg(F.sum(units).alias("mix_sum")).withColumn("mix_before", F.coalesce(F.sum("mix_sum").over(before), F.lit(0))).drop("mix_sum")
    inside = Window.partitionBy("mix_rank", "mix_bucket").orderBy("mix_key", doc_id, units).rowsBetween(Window.unboundedPreceding, -1)
    prefix = F.col("mix_before") + F.coalesce(F.sum(units).over(inside), F.lit(0))
    taken = F.col("mix_epochs") * units + F.greatest(F.lit(0), F.least(units, F.col("mix_rest") - prefix))
    out = keyed.join(starts, ["mix_rank", "mix_bucket"]).withColumn("mix_taken", taken)
    return out.select(*docs.columns, "mix_source_size", "mix_target", "mix_taken", "mix_key")


def sized(docs: DataFrame, text: str = "text", size: str = "size") -> DataFrame:
    """docs with `size`: the number of words in the whole text, 0 for a null text."""
    return docs.withColumn(size, F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long"))


def op8(spark, sf_dir: str) -> DataFrame:
    docs = sized(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "source", "text")).drop("text")
    out = mix(cut(docs, "sizes"))
    return out.select("doc_id", "size", F.col("mix_source_size").alias("source_size"), F.col("mix_target").alias("target"), F.col("mix_taken").alias("taken"))


#: The same rows by sorting each source in full. A source is capped if its share of what the sources capped before it leave is above.
OP8_SQL = r"""
WITH d AS (SELECT doc_id, source, CASE WHEN text IS NULL THEN 0 ELSE len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) END AS size FROM documents),
s AS (SELECT source, sum(size)::HUGEINT AS total FROM d GROUP BY source),
r AS (SELECT *, [5, 2, 1][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3]::HUGEINT AS w FROM s),
o AS (SELECT *, row_number() OVER (ORDER BY total::DOUBLE / w, source NULLS LAST) AS k FROM r),
p AS (SELECT *, (sum(total) OVER ())::HUGEINT - 3 * coalesce((sum(total) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))::HUGEINT, 0) AS rest,
             (sum(w) OVER (ORDER BY k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::HUGEINT AS weight FROM o),
q AS (SELECT *, max(CASE WHEN rest * w > 3 * total * weight THEN k ELSE 0 END) OVER () AS capped FROM p),
u AS (SELECT source, total, w, k <= capped AS full_, max(rest) FILTER (WHERE k = capped + 1) OVER () AS rest, max(weight) FILTER (WHERE k = capped + 1) OVER () AS weight FROM q),
b AS (SELECT source, total, CASE WHEN full_ THEN (3 * total)::DOUBLE ELSE (rest * w)::DOUBLE / weight::DOUBLE END AS target,
             CASE WHEN full_ THEN 3 * total ELSE (rest * w) // weight END AS budget FROM u),
x AS (SELECT d.doc_id, d.size, b.total, b.target, b.budget, coalesce((sum(d.size) OVER (PARTITION BY d.source ORDER BY md5('mix|' || coalesce(d.doc_id::VARCHAR, '')), d.doc_id, d.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))::HUGEINT, 0) AS before
      FROM d JOIN b ON d.source IS NOT DISTINCT FROM b.source)
SELECT doc_id, size::BIGINT AS size, total::BIGINT AS source_size, target,
       CASE WHEN total = 0 THEN 0 ELSE (budget // total * size + greatest(0, least(size, budget % total - before)))::BIGINT END AS taken FROM x
"""

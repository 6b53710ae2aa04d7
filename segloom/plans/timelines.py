"""Queries over segment lists: timelines, still policy, merges, coarsening, targets, censuses, integrity audits."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from segloom.operators import kernels
from segloom.operators.joins import aligned_audit
from segloom.operators.windows import absorb_still, along, block_numbers, label_runs
from segloom.plans import sequential
from segloom.plans.registry import query
from segloom.sources.tables import TIMELINE, table, timeline

def w():
    return along("episode", "segment")


TL = f"WITH {TIMELINE}"
PAIR = "'left:' || \"left\" || ', right:' || \"right\""
PAIR_RUNS = f"""pr AS (SELECT episode, run, any_value(pair) AS pair, min(segment) AS first_segment, max(segment) AS last_segment, count(*) AS pieces, CAST(sum(n) AS BIGINT) AS frames FROM (
  SELECT *, sum(turn) OVER (PARTITION BY episode ORDER BY segment) AS run FROM (SELECT *, {PAIR} AS pair, CASE WHEN segment > 0 AND ("left", "right") = lag(("left", "right")) OVER (PARTITION BY episode ORDER BY segment) THEN 0 ELSE 1 END AS turn FROM tl)) GROUP BY episode, run)"""


def pair():
    return F.concat(F.lit("left:"), "left", F.lit(", right:"), "right")


@query("segment_timeline", f"{TL} SELECT episode, segment, start_frame, end_frame, {PAIR} AS pair FROM tl")
def segment_timeline(spark, root):
    """SEG-01, WIN-21 by prefix sums."""
    return timeline(spark, root).select("episode", "segment", "start_frame", "end_frame", pair().alias("pair"))


@query("timeline_violations", f"""WITH g AS (SELECT l_orderkey AS episode, l_linenumber AS k, count(*) AS same FROM lineitem GROUP BY ALL), s AS (SELECT *, row_number() OVER w AS want, lag(k) OVER w AS p FROM g WINDOW w AS (PARTITION BY episode ORDER BY k)),
  v AS (SELECT episode, unnest([CASE WHEN k <> want THEN 'index' END, CASE WHEN same > 1 THEN 'duplicate' END, CASE WHEN k <> coalesce(p, 0) + 1 THEN 'gap' END]) AS code FROM s)
  SELECT code, count(*) AS n, count(DISTINCT episode) AS episodes FROM v WHERE code IS NOT NULL GROUP BY code""")
def timeline_violations(spark, root):
    """FLT-10 on line numbers: indices that are not 1, 2, 3 and so on, duplicates and gaps."""
    rows = table(spark, root, "lineitem").groupBy(F.col("l_orderkey").alias("episode"), F.col("l_linenumber").alias("k")).agg(F.count("*").alias("same"))
    by_k = along("episode", "k")
    rows = rows.withColumn("want", F.row_number().over(by_k)).withColumn("p", F.coalesce(F.lag("k").over(by_k), F.lit(0)))
    codes = F.array(F.when(F.col("k") != F.col("want"), "index"), F.when(F.col("same") > 1, "duplicate"), F.when(F.col("k") != F.col("p") + 1, "gap"))
    return rows.select("episode", F.explode(F.filter(codes, lambda c: c.isNotNull())).alias("code")).groupBy("code").agg(F.count("*").alias("n"), F.countDistinct("episode").alias("episodes"))


STILL = "\"left\" = 'N' AND \"right\" = 'O'"


@query("timeline_policy_violations", f"""{TL}, x AS (SELECT *, {STILL} AS still, lead(segment) OVER w IS NULL AS last_, lag("left") OVER w AS pl, lag("right") OVER w AS pr, lag(n) OVER w AS pn FROM tl WINDOW w AS (PARTITION BY episode ORDER BY segment))
  SELECT count(*) FILTER (WHERE still AND NOT last_) AS inner_still, count(*) FILTER (WHERE still AND last_ AND n < 8) AS short_hold, count(*) FILTER (WHERE "left" = pl AND "right" = pr AND least(n, pn) < 8) AS short_pair FROM x""")
def timeline_policy_violations(spark, root):
    """FLT-11."""
    still = (F.col("left") == "N") & (F.col("right") == "O")
    rows = timeline(spark, root).select("n", still.alias("still"), F.lead("segment").over(w()).isNull().alias("last_"), ((F.col("left") == F.lag("left").over(w())) & (F.col("right") == F.lag("right").over(w()))).alias("same"), F.lag("n").over(w()).alias("pn"))
    return rows.agg(F.count_if(F.col("still") & ~F.col("last_")).alias("inner_still"), F.count_if(F.col("still") & F.col("last_") & (F.col("n") < 8)).alias("short_hold"), F.count_if(F.col("same") & (F.least("n", "pn") < 8)).alias("short_pair"))


@query("still_absorption", f"""{TL}, s AS (SELECT *, {STILL} AS still, sum(CASE WHEN {STILL} THEN 0 ELSE 1 END) OVER (PARTITION BY episode ORDER BY segment) AS seen FROM tl), a AS (SELECT *, max(seen) OVER (PARTITION BY episode) AS all_ FROM s),
  t AS (SELECT *, sum(CASE WHEN still AND seen = all_ THEN n ELSE 0 END) OVER (PARTITION BY episode) AS tail FROM a),
  g AS (SELECT *, CASE WHEN still AND seen = all_ AND (tail >= 8 OR all_ = 0) THEN CASE WHEN all_ = 0 THEN 0 ELSE all_ END ELSE greatest(seen, 1) - 1 END AS grp, still AND seen = all_ AND (tail >= 8 OR all_ = 0) AS own FROM t)
  SELECT episode, CAST(grp AS BIGINT) AS grp, min(start_frame) AS start_frame, max(end_frame) AS end_frame, coalesce(min(segment) FILTER (WHERE NOT still), min(segment)) AS owner, list(segment ORDER BY segment) AS segments,
    list(CASE WHEN NOT still THEN 'owner' WHEN own THEN 'terminal' WHEN seen = 0 THEN 'pre_context' ELSE 'post_settle' END ORDER BY segment) AS roles FROM g GROUP BY episode, grp""")
def still_absorption(spark, root):
    """SEG-05 with N/O as both arms still."""
    rows = absorb_still(timeline(spark, root), (F.col("left") == "N") & (F.col("right") == "O"), 8)
    parts = F.sort_array(F.collect_list(F.struct("segment", "role")))
    out = rows.groupBy("episode", F.col("group").cast("long").alias("grp")).agg(F.min("start_frame").alias("start_frame"), F.max("end_frame").alias("end_frame"), F.coalesce(F.min(F.when(~F.col("is_still"), F.col("segment"))), F.min("segment")).alias("owner"), parts.alias("p"))
    return out.select("episode", "grp", "start_frame", "end_frame", "owner", F.col("p.segment").alias("segments"), F.col("p.role").alias("roles"))


@query("identical_pair_runs", f"{TL}, {PAIR_RUNS} SELECT episode, CAST(run - 1 AS BIGINT) AS run, pair, first_segment, last_segment, pieces, frames FROM pr")
def identical_pair_runs(spark, root):
    """WIN-07 on pairs of actions, with the frames of each run from the same aggregation."""
    runs = label_runs(timeline(spark, root), pair(), "episode", "segment", F.sum("n").alias("frames"))
    return runs.select("episode", F.col("run").cast("long").alias("run"), F.col("label").alias("pair"), F.col("start_frame").alias("first_segment"), F.col("end_frame").alias("last_segment"), F.col("n").alias("pieces"), "frames")


@query("adjacent_same_pairs", f"""{TL}, p AS (SELECT {PAIR} AS pair, n, lag({PAIR}) OVER (PARTITION BY episode ORDER BY segment) AS before FROM tl) SELECT pair, count(*) AS segments, count(*) FILTER (WHERE pair = before) AS same_as_before, count(*) FILTER (WHERE n < 8) AS short FROM p GROUP BY pair""")
def adjacent_same_pairs(spark, root):
    """AGG-13."""
    rows = timeline(spark, root).select(pair().alias("pair"), "n", F.lag(pair()).over(w()).alias("before"))
    return rows.groupBy("pair").agg(F.count("*").alias("segments"), F.count_if(F.col("pair") == F.col("before")).alias("same_as_before"), F.count_if(F.col("n") < 8).alias("short"))


@query("length_counts_dense", f"{TL}, k AS (SELECT unnest(range(1, 17)) AS n) SELECT k.n, count(tl.n) AS segments FROM k LEFT JOIN tl USING (n) GROUP BY k.n")
def length_counts_dense(spark, root):
    """AGG-13: lengths 1 to 16, those without segments too."""
    every = spark.range(1, 17).withColumnRenamed("id", "n")
    counts = timeline(spark, root).where("n between 1 and 16").groupBy("n").agg(F.count("*").alias("c"))
    return every.join(counts, "n", "left").select("n", F.coalesce("c", F.lit(0)).alias("segments"))


def _spans(groups: list[int], start: list[int], end: list[int]) -> list[tuple[int, int, int, int]]:
    """(group, first frame, last frame, pieces) of consecutive segments of one group."""
    out: list[list[int]] = []
    for g, a, z in zip(groups, start, end, strict=True):
        if out and out[-1][0] == g:
            out[-1][2:] = z, out[-1][3] + 1
        else:
            out.append([g, a, z, 1])
    return [tuple(r) for r in out]


def _grouped(spark, root, rule):
    def kernel(_, n, start, end, labels):
        groups = rule(n, labels, 8)
        return [(g, labels[groups.index(g)], a, z, k) for g, a, z, k in _spans(groups, start, end)]

    rows = timeline(spark, root).withColumn("pair", pair())
    return kernels.per_episode(rows, kernel, "episode long, grp long, pair string, start_frame long, end_frame long, pieces long", ["episode"], "segment", ["segment", "n", "start_frame", "end_frame", "pair"])


@query("short_merge", sequential.SHORT_MERGE)
def short_merge(spark, root):
    """SEG-06: under eight frames joins an equal neighbour, to a fixpoint."""
    return _grouped(spark, root, kernels.merge_short)


@query("short_merge_single_pass", f"""WITH RECURSIVE {TIMELINE}, p AS (SELECT *, {PAIR} AS pair FROM tl), f AS (SELECT episode, segment, CAST(0 AS BIGINT) AS grp, n AS size, pair FROM p WHERE segment = 0
  UNION ALL SELECT p.episode, p.segment, CASE WHEN p.pair = f.pair AND (p.n < 8 OR f.size < 8) THEN f.grp ELSE f.grp + 1 END, CASE WHEN p.pair = f.pair AND (p.n < 8 OR f.size < 8) THEN f.size + p.n ELSE p.n END, p.pair
    FROM f JOIN p ON p.episode = f.episode AND p.segment = f.segment + 1)
  SELECT f.episode, grp, any_value(f.pair) AS pair, min(start_frame) AS start_frame, max(end_frame) AS end_frame, count(*) AS pieces FROM f JOIN p ON p.episode = f.episode AND p.segment = f.segment GROUP BY f.episode, grp""")
def short_merge_single_pass(spark, root):
    """SEG-07, SEG-12."""
    return _grouped(spark, root, kernels.fold_short)


@query("optimal_coarsening", sequential.COARSENING)
def optimal_coarsening(spark, root):
    """SEG-08: each run of equal pairs is a problem of its own, so runs, not episodes, are the groups."""
    turn = F.when(pair() == F.lag(pair()).over(w()), 0).otherwise(1)
    rows = timeline(spark, root).withColumn("turn", turn).withColumn("run", F.sum("turn").over(w().rowsBetween(Window.unboundedPreceding, 0)))

    def kernel(_, n, start, end):
        groups, cost = kernels.coarsen(n)
        return [(*r, cost) for r in _spans(groups, start, end)]

    return kernels.per_episode(rows, kernel, "episode long, run long, grp long, start_frame long, end_frame long, pieces long, cost double", ["episode", "run"], "segment", ["segment", "n", "start_frame", "end_frame"])


@query("max_length_split", sequential.LENGTH_SPLIT)
def max_length_split(spark, root):
    """SEG-10 over segment starts, with the segment length as energy of its frames."""

    def kernel(_, n, start):
        energy = [k for k in n for _ in range(k)]
        cuts = kernels.split_long([*start, len(energy)], energy, 24, 4)
        return [(i, a, z - 1) for i, (a, z) in enumerate(zip(cuts, cuts[1:], strict=False))]

    return kernels.per_episode(timeline(spark, root), kernel, "episode long, segment long, start_frame long, end_frame long", ["episode"], "segment", ["segment", "n", "start_frame"])


@query("chunk_targets", f"""{TL} SELECT episode, segment, CAST(ceil(n / 8.0) AS BIGINT) AS num_chunks, CAST(ceil(n / 8.0) * 8 AS BIGINT) AS slots, CAST(ceil(n / 8.0) * 8 AS BIGINT) - n AS padded, least(greatest(0, n - 1), 3 * n // 10) AS origin FROM tl""")
def chunk_targets(spark, root):
    """PRJ-12."""
    n = F.col("n")
    chunks = F.ceil(n / 8).cast("long")
    return timeline(spark, root).select("episode", "segment", chunks.alias("num_chunks"), (chunks * 8).alias("slots"), (chunks * 8 - n).alias("padded"), F.least(F.greatest(F.lit(0), n - 1), F.floor(3 * n / 10)).cast("long").alias("origin"))


@query("slot_mask", f"{TL} SELECT episode, segment, list_concat(list_transform(range(n), lambda i: 1), list_transform(range(CAST(ceil(n / 8.0) * 8 AS BIGINT) - n), lambda i: 0)) AS mask FROM tl")
def slot_mask(spark, root):
    """PRJ-12."""
    n = F.col("n").cast("int")
    return timeline(spark, root).select("episode", "segment", F.concat(F.array_repeat(F.lit(1), n), F.array_repeat(F.lit(0), (F.ceil(n / 8) * 8).cast("int") - n)).alias("mask"))


@query("history_chain", f"""{TL} SELECT episode, segment, {PAIR} AS pair, lag({PAIR}) OVER w AS previous_pair, lag(end_frame) OVER w AS previous_end, lag(CAST(ceil(n / 8.0) AS BIGINT)) OVER w AS executed_chunks, start_frame - lag(start_frame) OVER w AS observed_delta
  FROM tl WINDOW w AS (PARTITION BY episode ORDER BY segment)""")
def history_chain(spark, root):
    """WIN-18: what was done before, null in the first row."""
    return timeline(spark, root).select("episode", "segment", pair().alias("pair"), F.lag(pair()).over(w()).alias("previous_pair"), F.lag("end_frame").over(w()).alias("previous_end"), F.lag(F.ceil(F.col("n") / 8).cast("long")).over(w()).alias("executed_chunks"), (F.col("start_frame") - F.lag("start_frame").over(w())).alias("observed_delta"))


@query("global_block_numbering", f"{TL} SELECT episode, segment, row_number() OVER (ORDER BY episode, segment) - 1 AS block FROM tl")
def global_block_numbering(spark, root):
    """WIN-21, without a window over all rows."""
    return block_numbers(timeline(spark, root).select("episode", "segment"), "episode", ["segment"])


@query("length_census", f"""{TL} SELECT count(*) AS total, CAST(sum(n) AS BIGINT) AS frames, quantile_cont(n, 0.1) AS p10, quantile_cont(n, 0.5) AS p50, quantile_cont(n, 0.9) AS p90, quantile_cont(n, 0.99) AS p99, count(*) FILTER (WHERE n < 16) AS below_16, count(*) FILTER (WHERE n BETWEEN 16 AND 31) AS from_16, count(*) FILTER (WHERE n >= 32) AS from_32,
  CAST(sum(n // 16) AS BIGINT) AS capacity FROM tl""")
def length_census(spark, root):
    """AGG-03 from the histogram: percentiles weigh each length by its count, so only distinct lengths are sorted."""
    n, k = F.col("n"), F.col("k")
    hist = timeline(spark, root).groupBy("n").agg(F.count("*").alias("k"))
    q = lambda p: F.percentile(n, F.lit(p), k)
    return hist.agg(F.sum(k).alias("total"), F.sum(n * k).alias("frames"), F.bround(q(0.1), 6).alias("p10"), F.bround(q(0.5), 6).alias("p50"), F.bround(q(0.9), 6).alias("p90"), F.bround(q(0.99), 6).alias("p99"), F.sum(F.when(n < 16, k).otherwise(0)).alias("below_16"), F.sum(F.when(n.between(16, 31), k).otherwise(0)).alias("from_16"), F.sum(F.when(n >= 32, k).otherwise(0)).alias("from_32"), F.sum(F.floor(n / 16) * k).alias("capacity"))


@query("length_histogram", f"{TL} SELECT n AS steps, count(*) AS episodes, CAST(sum(count(*)) OVER (ORDER BY n) AS BIGINT) AS at_most FROM tl GROUP BY n")
def length_histogram(spark, root):
    """AGG-04, WIN-22: counts and cumulative ranks over distinct lengths."""
    return timeline(spark, root).groupBy(F.col("n").alias("steps")).agg(F.count("*").alias("episodes")).withColumn("at_most", F.sum("episodes").over(Window.orderBy("steps")))


@query("length_census_grouping_sets", f"""{TL} SELECT "left", "right", count(*) AS segments, CAST(sum(n) AS BIGINT) AS frames FROM tl GROUP BY GROUPING SETS (("left"), ("left", "right"), ())""")
def length_census_grouping_sets(spark, root):
    """AGG-04: three levels of totals."""
    return timeline(spark, root).groupingSets([[F.col("left")], [F.col("left"), F.col("right")], []], "left", "right").agg(F.count("*").alias("segments"), F.sum("n").alias("frames"))


@query("pair_sequence_diversity", f"{TL}, s AS (SELECT episode, string_agg(\"left\" || \"right\", '>' ORDER BY segment) AS sequence FROM tl GROUP BY episode) SELECT sequence, count(*) AS episodes FROM s GROUP BY sequence")
def pair_sequence_diversity(spark, root):
    """AGG-12."""
    ordered = F.sort_array(F.collect_list(F.struct("segment", F.concat("left", "right").alias("p"))))
    sequences = timeline(spark, root).groupBy("episode").agg(F.array_join(ordered["p"], ">").alias("sequence"))
    return sequences.groupBy("sequence").agg(F.count("*").alias("episodes"))


@query("arm_mode", f"""{TL} SELECT episode, CASE WHEN bool_or("left" <> 'N') AND bool_or("right" <> 'O') THEN 'bimanual' WHEN bool_or("left" <> 'N') THEN 'left' WHEN bool_or("right" <> 'O') THEN 'right' ELSE 'idle' END AS mode FROM tl GROUP BY episode""")
def arm_mode(spark, root):
    """AGG-19."""
    left, right = F.bool_or(F.col("left") != "N"), F.bool_or(F.col("right") != "O")
    return timeline(spark, root).groupBy("episode").agg(F.when(left & right, "bimanual").when(left, "left").when(right, "right").otherwise("idle").alias("mode"))


@query("coordination_relation", f"""{TL} SELECT CASE WHEN "left" = 'N' AND "right" = 'O' THEN 'both_still' WHEN "right" = 'O' THEN 'left_only' WHEN "left" = 'N' THEN 'right_only' WHEN ascii("left") % 2 = ascii("right") % 2 THEN 'dual_same_phase' ELSE 'dual_different_phase' END AS relation, count(*) AS n FROM tl GROUP BY 1""")
def coordination_relation(spark, root):
    """SEG-03, with N and O as still and two phases by letter."""
    still_left, still_right = F.col("left") == "N", F.col("right") == "O"
    relation = F.when(still_left & still_right, "both_still").when(still_right, "left_only").when(still_left, "right_only").when(F.ascii("left") % 2 == F.ascii("right") % 2, "dual_same_phase").otherwise("dual_different_phase")
    return timeline(spark, root).groupBy(relation.alias("relation")).agg(F.count("*").alias("n"))


@query("unique_lookup_violations", "SELECT CASE WHEN n = 0 THEN 'none' ELSE 'many' END AS issue, count(*) AS keys FROM (SELECT o_orderkey, count(l_orderkey) AS n FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey AND l_linenumber = 1 GROUP BY o_orderkey) WHERE n <> 1 GROUP BY 1")
def unique_lookup_violations(spark, root):
    """JOIN-06: keys that match not exactly once."""
    orders = table(spark, root, "orders").select("o_orderkey")
    lines = table(spark, root, "lineitem").where("l_linenumber = 1").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count("*").alias("n"))
    found = orders.join(lines, "o_orderkey", "left").where("n is null or n <> 1")
    return found.groupBy(F.when(F.col("n").isNull(), "none").otherwise("many").alias("issue")).agg(F.count("*").alias("keys"))


@query("manifest_alignment_audit", """WITH a AS (SELECT o_orderkey AS k, o_orderstatus AS status, year(o_orderdate) AS y FROM orders), b AS (SELECT l_orderkey AS k, min(l_linestatus) AS status, min(year(l_shipdate)) AS y FROM lineitem GROUP BY l_orderkey),
  j AS (SELECT a.k AS ak, b.k AS bk, a.status AS s1, b.status AS s2, a.y AS y1, b.y AS y2 FROM a FULL JOIN b ON a.k = b.k),
  i AS (SELECT unnest([CASE WHEN ak IS NULL THEN 'missing_left' END, CASE WHEN bk IS NULL THEN 'missing_right' END, CASE WHEN ak IS NOT NULL AND bk IS NOT NULL AND s1 IS DISTINCT FROM s2 THEN 'differs_status' END, CASE WHEN ak IS NOT NULL AND bk IS NOT NULL AND y1 IS DISTINCT FROM y2 THEN 'differs_y' END]) AS issue FROM j)
  SELECT issue, count(*) AS n FROM i WHERE issue IS NOT NULL GROUP BY issue""")
def manifest_alignment_audit(spark, root):
    """JOIN-05, JOIN-10, SET-02: manifest and segments side by side, every mismatch a row."""
    a = table(spark, root, "orders").select(F.col("o_orderkey").alias("k"), F.col("o_orderstatus").alias("status"), F.year("o_orderdate").alias("y"))
    b = table(spark, root, "lineitem").groupBy(F.col("l_orderkey").alias("k")).agg(F.min("l_linestatus").alias("status"), F.min(F.year("l_shipdate")).alias("y"))
    return aligned_audit(a, b, ["k"], ["status", "y"])


@query("pending_episodes", "SELECT o_orderkey AS episode, o_orderpriority AS priority FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)")
def pending_episodes(spark, root):
    """JOIN-20, STM-02."""
    return table(spark, root, "orders").join(table(spark, root, "lineitem").select(F.col("l_orderkey").alias("o_orderkey")), "o_orderkey", "left_anti").select(F.col("o_orderkey").alias("episode"), F.col("o_orderpriority").alias("priority"))


@query("completed_episodes", "SELECT o_orderpriority AS priority, count(*) AS n FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem) GROUP BY 1")
def completed_episodes(spark, root):
    """JOIN-19, AGG-20."""
    done = table(spark, root, "orders").join(table(spark, root, "lineitem").select(F.col("l_orderkey").alias("o_orderkey")), "o_orderkey", "left_semi")
    return done.groupBy(F.col("o_orderpriority").alias("priority")).agg(F.count("*").alias("n"))


@query("episode_status", """WITH c AS (SELECT l_orderkey, count(DISTINCT l_linenumber) AS have, max(l_linenumber) AS want FROM lineitem GROUP BY 1)
  SELECT CASE WHEN have IS NULL THEN 'unstarted' WHEN have = want THEN 'complete' ELSE 'partial' END AS status, count(*) AS episodes FROM orders LEFT JOIN c ON o_orderkey = l_orderkey GROUP BY 1""")
def episode_status(spark, root):
    """AGG-20, ROW-09: complete, partial and unstarted episodes by the blocks that are there."""
    have = table(spark, root, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.countDistinct("l_linenumber").alias("have"), F.max("l_linenumber").alias("want"))
    status = F.when(F.col("have").isNull(), "unstarted").when(F.col("have") == F.col("want"), "complete").otherwise("partial")
    return table(spark, root, "orders").join(have, "o_orderkey", "left").groupBy(status.alias("status")).agg(F.count("*").alias("episodes"))


@query("partition_balance", "SELECT CAST(o_orderkey % 4 AS INTEGER) AS rank, count(*) AS episodes, min(o_orderkey) AS first, max(o_orderkey) AS last FROM orders GROUP BY 1")
def partition_balance(spark, root):
    """SET-03, WIN-26."""
    return table(spark, root, "orders").groupBy((F.col("o_orderkey") % 4).cast("int").alias("rank")).agg(F.count("*").alias("episodes"), F.min("o_orderkey").alias("first"), F.max("o_orderkey").alias("last"))


@query("style_allocation", f"{TL}, b AS (SELECT (row_number() OVER (ORDER BY episode, segment) - 1) % 5 AS style, n FROM tl) SELECT CAST(style AS INTEGER) AS style, count(*) AS rows_, CAST(sum(n) AS BIGINT) AS frames, max(count(*)) OVER () - min(count(*)) OVER () <= 1 AS balanced FROM b GROUP BY style")
def style_allocation(spark, root):
    """AGG-06: the block number modulo five, and whether the styles are level."""
    blocks = block_numbers(timeline(spark, root).select("episode", "segment", "n"), "episode", ["segment"])
    counts = blocks.groupBy((F.col("block") % 5).cast("int").alias("style")).agg(F.count("*").alias("rows_"), F.sum("n").alias("frames"))
    every = Window.partitionBy()
    return counts.withColumn("balanced", F.max("rows_").over(every) - F.min("rows_").over(every) <= 1)


@query("paired_run_diff", f"""{TL}, o AS (SELECT episode, segment, {PAIR} AS pair, n FROM tl), w AS (SELECT episode, segment, CASE WHEN n = 50 THEN 'left:changed' ELSE {PAIR} END AS pair, n FROM tl WHERE n > 1)
  SELECT CASE WHEN w.episode IS NULL THEN 'removed' WHEN o.pair <> w.pair THEN 'pair' ELSE 'same' END AS outcome, count(*) AS n FROM o LEFT JOIN w USING (episode, segment) GROUP BY 1""")
def paired_run_diff(spark, root):
    """JOIN-21: an earlier and a later run, row by row, null equal to null."""
    old = timeline(spark, root).select("episode", "segment", pair().alias("pair"), "n")
    new = old.where("n > 1").select("episode", "segment", F.when(F.col("n") == 50, "left:changed").otherwise(F.col("pair")).alias("new_pair"))
    outcome = F.when(F.col("new_pair").isNull(), "removed").when(~F.col("pair").eqNullSafe(F.col("new_pair")), "pair").otherwise("same")
    return old.join(new, ["episode", "segment"], "left").groupBy(outcome.alias("outcome")).agg(F.count("*").alias("n"))


@query("correction_override", f"{TL}, c AS (SELECT o_orderkey AS episode, CAST(o_custkey % 5 AS BIGINT) AS segment, o_orderstatus AS fix FROM orders WHERE o_orderpriority LIKE '1%') SELECT coalesce(fix, \"left\") AS label, fix IS NOT NULL AS corrected, count(*) AS n FROM tl LEFT JOIN c USING (episode, segment) GROUP BY ALL")
def correction_override(spark, root):
    """JOIN-13, ROW-16: corrections by (episode, segment) in the place of the label."""
    fixes = table(spark, root, "orders").where("o_orderpriority like '1%'").select(F.col("o_orderkey").alias("episode"), (F.col("o_custkey") % 5).alias("segment"), F.col("o_orderstatus").alias("fix"))
    joined = timeline(spark, root).join(fixes, ["episode", "segment"], "left")
    return joined.groupBy(F.coalesce("fix", "left").alias("label"), F.col("fix").isNotNull().alias("corrected")).agg(F.count("*").alias("n"))


@query("correction_remap", f"""{TL}, {PAIR_RUNS}, m AS (SELECT episode, run - 1 AS target, unnest(range(first_segment, last_segment + 1)) AS segment FROM pr), c AS (SELECT o_orderkey AS episode, CAST(o_custkey % 5 AS BIGINT) AS segment FROM orders)
  SELECT c.episode, c.segment, CAST(target AS BIGINT) AS target FROM c LEFT JOIN m USING (episode, segment)""")
def correction_remap(spark, root):
    """JOIN-12: corrections of source segments carried over to the merged ones; null where a correction has lost its segment."""
    runs = label_runs(timeline(spark, root), pair(), frame="segment")
    mapping = runs.select("episode", F.col("run").cast("long").alias("target"), F.explode(F.sequence("start_frame", "end_frame")).alias("segment"))
    fixes = table(spark, root, "orders").select(F.col("o_orderkey").alias("episode"), (F.col("o_custkey") % 5).alias("segment"))
    return fixes.join(mapping, ["episode", "segment"], "left").select("episode", "segment", "target")


@query("evenly_spaced_samples", f"{TL} SELECT episode, segment, list_sort(list_distinct(list_transform(range(5), lambda i: start_frame + i * (n - 1) // 4))) AS frames FROM tl")
def evenly_spaced_samples(spark, root):
    """TOP-05."""
    spot = F.transform(F.sequence(F.lit(0), F.lit(4)), lambda i: F.col("start_frame") + F.floor(i * (F.col("n") - 1) / 4))
    return timeline(spark, root).select("episode", "segment", F.array_distinct(spot).alias("frames"))


@query("seeded_sample", "SELECT o_custkey, o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY md5('7|' || o_orderkey), o_orderkey) AS k FROM orders) WHERE k <= 2")
def seeded_sample(spark, root):
    """TOP-04: two episodes for each task, in the random order of a seed that every run shares."""
    key = F.md5(F.concat(F.lit("7|"), F.col("o_orderkey").cast("string")))
    ranked = table(spark, root, "orders").select("o_custkey", "o_orderkey", F.row_number().over(Window.partitionBy("o_custkey").orderBy(key, "o_orderkey")).alias("k"))
    return ranked.where("k <= 2").select("o_custkey", "o_orderkey")


@query("alternating_halves", "SELECT o_custkey, o_orderkey, CAST((row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1) % 2 AS INTEGER) AS half FROM orders")
def alternating_halves(spark, root):
    """TOP-06."""
    return table(spark, root, "orders").select("o_custkey", "o_orderkey", ((F.row_number().over(Window.partitionBy("o_custkey").orderBy("o_orderkey")) - 1) % 2).alias("half"))


@query("boundary_union", f"{TL} SELECT episode, list_sort(list(DISTINCT b)) AS boundaries FROM (SELECT episode, start_frame AS b FROM tl WHERE \"left\" = 'R' UNION SELECT episode, end_frame + 1 FROM tl WHERE \"right\" = 'F') GROUP BY episode")
def boundary_union(spark, root):
    """SET-01, SEG-11."""
    tl = timeline(spark, root)
    both = tl.where("left = 'R'").select("episode", F.col("start_frame").alias("b")).unionByName(tl.where("right = 'F'").select("episode", (F.col("end_frame") + 1).alias("b"))).distinct()
    return both.groupBy("episode").agg(F.sort_array(F.collect_list("b")).alias("boundaries"))


@query("range_match", "WITH r AS (SELECT CAST(o_orderkey // 1000 AS BIGINT) AS part, min(o_orderkey) AS lo, max(o_orderkey) AS hi FROM orders GROUP BY 1) SELECT part, count(*) AS lines FROM r JOIN lineitem ON l_orderkey BETWEEN lo AND hi GROUP BY part")
def range_match(spark, root):
    """JOIN-08, SRC-03: episodes by a catalogue of [min, max] ranges. A range is listed under each block of keys it meets, so the join
    has an equality."""
    ranges = table(spark, root, "orders").groupBy(F.floor(F.col("o_orderkey") / 1000).alias("part")).agg(F.min("o_orderkey").alias("lo"), F.max("o_orderkey").alias("hi"))
    ranges = ranges.withColumn("block", F.explode(F.sequence(F.floor(F.col("lo") / 512), F.floor(F.col("hi") / 512))))
    lines = table(spark, root, "lineitem").select("l_orderkey", F.floor(F.col("l_orderkey") / 512).alias("block"))
    return lines.join(ranges, "block").where("l_orderkey between lo and hi").groupBy("part").agg(F.count("*").alias("lines"))


@query("task_resolution", "SELECT coalesce(c_mktsegment, 'unknown') AS task, count(*) AS episodes, count(*) FILTER (WHERE c_custkey IS NULL) AS unresolved FROM orders LEFT JOIN customer ON o_custkey = c_custkey AND c_acctbal > 0 GROUP BY 1")
def task_resolution(spark, root):
    """SRC-18, JOIN-18: the task of an episode, with a default."""
    named = table(spark, root, "customer").where("c_acctbal > 0").select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment", F.lit(True).alias("known"))
    joined = table(spark, root, "orders").select("o_custkey").join(named, "o_custkey", "left")
    return joined.groupBy(F.coalesce("c_mktsegment", F.lit("unknown")).alias("task")).agg(F.count("*").alias("episodes"), F.count_if(F.col("known").isNull()).alias("unresolved"))


@query("inventory_shards", "SELECT o_orderkey, sha256('episode-' || o_orderkey) AS key, CAST(('0x' || sha256('episode-' || o_orderkey)[15:16])::INTEGER % 256 AS INTEGER) AS shard FROM orders")
def inventory_shards(spark, root):
    """SRC-16: SHA-256 keys; the first 64 bits modulo 256 are their last byte."""
    key = F.sha2(F.concat(F.lit("episode-"), F.col("o_orderkey").cast("string")), 256)
    return table(spark, root, "orders").select("o_orderkey", key.alias("key"), F.conv(F.substring(key, 15, 2), 16, 10).cast("int").alias("shard"))


@query("duplicate_manifest_ids", "SELECT l_orderkey, l_linenumber, count(*) AS copies FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def duplicate_manifest_ids(spark, root):
    """SET-05: ids that a union of manifests holds twice."""
    return table(spark, root, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.count("*").alias("copies")).where("copies > 1")

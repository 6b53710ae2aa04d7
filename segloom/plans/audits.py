"""Gates, audits and row builders that span several tables or need a sequential rule."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from segloom.functions.arrays import round_even
from segloom.functions.text import tokens
from segloom.operators import kernels
from segloom.operators.gates import citations_ok
from segloom.operators.windows import along, label_runs
from segloom.plans import sequential
from segloom.plans.registry import query
from segloom.plans.texts import documents
from segloom.sources.tables import EVENTS, TIMELINE, events, table, timeline

TL = f"WITH {TIMELINE}"
EV = f"WITH {EVENTS}"


def seg():
    return along("episode", "segment")


@query("bimanual_match", sequential.BIMANUAL_MATCH)
def bimanual_match(spark, root):
    """JOIN-15: clicks as left and views as right evidence of each stream, matched one to one by nearest frame."""

    def kernel(frame, c, label):
        def side(name):
            return [{"frame": f, "strength": v / 100 + 1, "strong": True, "kind": ("level", "high" if v >= 1500 else "low"), "types": (name,), "arms": (name,)} for f, v, x in zip(frame, c, label, strict=True) if x == name]

        return [(e["frame"], e["relation"], list(e["arms"])) for e in kernels.pair_arms(side("click"), side("view"), 3, 1)]

    return kernels.per_episode(events(spark, root), kernel, "episode long, frame long, relation string, arms array<string>", ["episode"], "frame", ["frame", "c", "label"])


@query("synchronous_events", sequential.SYNCHRONOUS)
def synchronous_events(spark, root):
    """JOIN-16: the closest pairs of one direction first, each event once."""

    def kernel(frame, c, label):
        side = lambda name: [(f, v >= 1500) for f, v, x in zip(frame, c, label, strict=True) if x == name]
        left, right = side("click"), side("view")
        return [(left[i][0], right[j][0], gap) for gap, i, j in kernels.greedy_pairs(left, right, 2)]

    return kernels.per_episode(events(spark, root), kernel, "episode long, left_frame long, right_frame long, separation long", ["episode"], "frame", ["frame", "c", "label"])


@query("opposing_events", f"{EV} SELECT a.episode, a.frame AS left_frame, b.frame AS right_frame, abs(a.frame - b.frame) AS separation FROM ev a JOIN ev b ON a.episode = b.episode AND abs(a.frame - b.frame) <= 2 WHERE a.label = 'click' AND b.label = 'view' AND (a.c >= 1500) <> (b.c >= 1500)")
def opposing_events(spark, root):
    """JOIN-16: pairs of opposite direction within two frames, by an equality join on each frame that is near enough."""
    ev = events(spark, root)
    left = ev.where("label = 'click'").select("episode", F.col("frame").alias("left_frame"), (F.col("c") >= 1500).alias("a"), F.explode(F.sequence(F.col("frame") - 2, F.col("frame") + 2)).alias("right_frame"))
    right = ev.where("label = 'view'").select("episode", F.col("frame").alias("right_frame"), (F.col("c") >= 1500).alias("b"))
    return left.join(right, ["episode", "right_frame"]).where("a <> b").select("episode", "left_frame", "right_frame", F.abs(F.col("left_frame") - F.col("right_frame")).alias("separation"))


@query("phase_run_smoothing", sequential.PHASE_SMOOTHING)
def phase_run_smoothing(spark, root):
    """WIN-13: runs of levels without those under two frames."""
    level = F.when(F.col("c") < 1000, "low").when(F.col("c") < 3000, "middle").otherwise("high")
    runs = label_runs(events(spark, root), level)

    def kernel(start, end, label):
        return [(i, *r) for i, r in enumerate(kernels.persistent_runs(list(zip(label, start, end, strict=True)), 2))]

    return kernels.per_episode(runs, kernel, "episode long, run long, phase string, start_frame long, end_frame long", ["episode"], "start_frame", ["start_frame", "end_frame", "label"])


@query("evidence_filter", sequential.EVIDENCE_FILTER)
def evidence_filter(spark, root):
    """WIN-16, WIN-17, AGG-25: high frames as evidence, clustered and folded to a least separation."""
    high = events(spark, root).withColumn("frames", F.count("*").over(Window.partitionBy("episode"))).where("c >= 3000")

    def kernel(frame, c, label, frames):
        rows = [{"frame": f, "strength": v / 1000, "strong": v >= 4000, "kind": ("level", x), "types": (x,), "arms": ("left",)} for f, v, x in zip(frame, c, label, strict=True)]
        return [(e["frame"], e["strength"], e["strong"], list(e["types"]), len(e["support"])) for e in kernels.filter_evidence(rows, frames[0], 4, 2)]

    return kernels.per_episode(high, kernel, "episode long, frame long, strength double, strong boolean, types array<string>, support long", ["episode"], "frame", ["frame", "c", "label", "frames"])


@query("boundary_margin", f"{EV}, n AS (SELECT episode, count(*) AS n FROM ev GROUP BY episode) SELECT ev.episode, frame FROM ev JOIN n USING (episode) WHERE c >= 3000 AND frame BETWEEN 5 AND n - 5")
def boundary_margin(spark, root):
    """FLT-23."""
    ev = events(spark, root).withColumn("n", F.count("*").over(Window.partitionBy("episode")))
    return ev.where("c >= 3000 and frame between 5 and n - 5").select("episode", "frame")


@query("supervised_range", f"{TL} SELECT episode, min(segment) AS first_segment, max(segment) AS last_segment, max(segment) - min(segment) + 1 = count(*) AS contiguous FROM tl WHERE \"right\" = 'O' GROUP BY episode")
def supervised_range(spark, root):
    """FLT-22."""
    s = F.col("segment")
    return timeline(spark, root).where("right = 'O'").groupBy("episode").agg(F.min(s).alias("first_segment"), F.max(s).alias("last_segment"), (F.max(s) - F.min(s) + 1 == F.count("*")).alias("contiguous"))


@query("future_leak", "SELECT l_returnflag AS flag, count(*) AS n, count(*) FILTER (WHERE l_shipdate < o_orderdate) AS leaks FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1")
def future_leak(spark, root):
    """FLT-25: rows that are older than what they are said to follow."""
    joined = table(spark, root, "lineitem").join(table(spark, root, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate"), "l_orderkey")
    return joined.groupBy(F.col("l_returnflag").alias("flag")).agg(F.count("*").alias("n"), F.count_if(F.col("l_shipdate") < F.col("o_orderdate")).alias("leaks"))


@query("flag_gate", f"""{EV}, e AS (SELECT episode, arg_min(label, frame) AS head, arg_max(label, frame) AS tail, count(*) FILTER (WHERE label = 'purchase') AS buys, count(*) AS n FROM ev GROUP BY episode),
  v AS (SELECT episode, unnest([CASE WHEN head <> 'view' THEN 'first' END, CASE WHEN tail = 'error' THEN 'last_error' END, CASE WHEN buys = 0 THEN 'no_purchase' END, CASE WHEN n < 50 THEN 'short' END]) AS code FROM e) SELECT code, count(*) AS episodes FROM v WHERE code IS NOT NULL GROUP BY code""")
def flag_gate(spark, root):
    """FLT-24."""
    e = events(spark, root).groupBy("episode").agg(F.min_by("label", "frame").alias("head"), F.max_by("label", "frame").alias("tail"), F.count_if(F.col("label") == "purchase").alias("buys"), F.count("*").alias("n"))
    codes = F.array(F.when(F.col("head") != "view", "first"), F.when(F.col("tail") == "error", "last_error"), F.when(F.col("buys") == 0, "no_purchase"), F.when(F.col("n") < 50, "short"))
    return e.select(F.explode(F.filter(codes, lambda c: c.isNotNull())).alias("code")).groupBy("code").agg(F.count("*").alias("episodes"))


@query("eligibility", """SELECT c_custkey, list_filter(['balance', 'segment', 'orders'], lambda r: CASE r WHEN 'balance' THEN c_acctbal < 0 WHEN 'segment' THEN c_mktsegment = 'MACHINERY' ELSE n = 0 END) AS reasons FROM (SELECT c_custkey, c_acctbal, c_mktsegment, count(o_orderkey) AS n FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY ALL)""")
def eligibility(spark, root):
    """FLT-21: why a record may not be used; an empty list lets it pass."""
    counts = table(spark, root, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("n"))
    rows = table(spark, root, "customer").join(counts, "c_custkey", "left")
    reasons = F.array(F.when(F.col("c_acctbal") < 0, "balance"), F.when(F.col("c_mktsegment") == "MACHINERY", "segment"), F.when(F.col("n").isNull(), "orders"))
    return rows.select("c_custkey", F.filter(reasons, lambda r: r.isNotNull()).alias("reasons"))


@query("mixed_groups", f"{TL} SELECT episode, segment // 3 AS grp, count(DISTINCT \"left\") > 1 AS mixed, list_sort(list(DISTINCT \"left\")) AS labels FROM tl GROUP BY ALL")
def mixed_groups(spark, root):
    """FLT-12: groups of segments that hold more than one action."""
    g = timeline(spark, root).groupBy("episode", F.floor(F.col("segment") / 3).alias("grp")).agg(F.sort_array(F.collect_set("left")).alias("labels"))
    return g.select("episode", "grp", F.exists("labels", lambda x: x != F.get("labels", F.lit(0))).alias("mixed"), "labels")


@query("opposed_groups", f"{TL} SELECT episode, segment // 3 AS grp, bool_or(\"left\" = 'A') AND bool_or(\"left\" = 'R') AS opposed FROM tl GROUP BY ALL")
def opposed_groups(spark, root):
    """ROW-18."""
    g = timeline(spark, root).groupBy("episode", F.floor(F.col("segment") / 3).alias("grp")).agg(F.collect_set("left").alias("s"))
    return g.select("episode", "grp", (F.array_contains("s", "A") & F.array_contains("s", "R")).alias("opposed"))


@query("forbidden_keys", "SELECT count(*) AS n, count(*) FILTER (WHERE regexp_matches(props, '\"(password|token|k)\"\\s*:')) AS with_key, count(*) FILTER (WHERE regexp_matches(props, '\"(password|token)\"\\s*:')) AS forbidden FROM events")
def forbidden_keys(spark, root):
    """FLT-13."""
    p = F.col("props")
    return table(spark, root, "events").agg(F.count("*").alias("n"), F.count_if(p.rlike(r'"(password|token|k)"\s*:')).alias("with_key"), F.count_if(p.rlike(r'"(password|token)"\s*:')).alias("forbidden"))


@query("aperture_conflict", f"{EV}, a AS (SELECT CASE WHEN c <= 250 THEN 'closed' WHEN c >= 4750 THEN 'open' ELSE 'between' END AS state, label FROM ev) SELECT state, count(*) AS n, count(*) FILTER (WHERE (state = 'closed' AND label = 'purchase') OR (state = 'open' AND label = 'error')) AS conflicts FROM a GROUP BY state")
def aperture_conflict(spark, root):
    """FLT-17."""
    c, label = F.col("c"), F.col("label")
    state = F.when(c <= 250, "closed").when(c >= 4750, "open").otherwise("between")
    rows = events(spark, root).select(state.alias("state"), (((c <= 250) & (label == "purchase")) | ((c >= 4750) & (label == "error"))).alias("bad"))
    return rows.groupBy("state").agg(F.count("*").alias("n"), F.count_if("bad").alias("conflicts"))


@query("label_gate", r"SELECT conv_id, turn, len(regexp_extract_all(text, '\S+')) <= 45 AS brief, regexp_matches(text, '^[A-ZÄÖÜÉÈÇÑ]') AS capital, right(text, 1) = '.' AS closed FROM conversations")
def label_gate(spark, root):
    """FLT-20."""
    t = F.col("text")
    return table(spark, root, "conversations").select("conv_id", "turn", (F.regexp_count(t, F.lit(r"\S+")) <= 45).alias("brief"), t.rlike("^[A-ZÄÖÜÉÈÇÑ]").alias("capital"), (F.right(t, F.lit(1)) == ".").alias("closed"))


@query("arm_consistency", f"{TL}, m AS (SELECT episode, bool_or(\"left\" <> 'N') AS l, bool_or(\"right\" <> 'O') AS r FROM tl GROUP BY episode) SELECT l AND NOT r AS left_only, r AND NOT l AS right_only, count(*) AS episodes FROM m GROUP BY ALL")
def arm_consistency(spark, root):
    """FLT-26."""
    m = timeline(spark, root).groupBy("episode").agg(F.bool_or(F.col("left") != "N").alias("l"), F.bool_or(F.col("right") != "O").alias("r"))
    return m.groupBy((F.col("l") & ~F.col("r")).alias("left_only"), (F.col("r") & ~F.col("l")).alias("right_only")).agg(F.count("*").alias("episodes"))


@query("shared_boundary_states", f"{TL}, b AS (SELECT *, lag(\"right\") OVER (PARTITION BY episode ORDER BY segment) AS p FROM tl) SELECT p AS before, \"left\" AS after, count(*) AS n FROM b WHERE p = 'F' AND \"left\" = 'N' OR p = 'O' AND \"left\" = 'A' GROUP BY ALL")
def shared_boundary_states(spark, root):
    """FLT-19: neighbours whose states at their common boundary contradict."""
    b = timeline(spark, root).withColumn("p", F.lag("right").over(seg()))
    return b.where("(p = 'F' and left = 'N') or (p = 'O' and left = 'A')").groupBy(F.col("p").alias("before"), F.col("left").alias("after")).agg(F.count("*").alias("n"))


@query("array_set_algebra", f"{TL}, s AS (SELECT episode, list_sort(list(DISTINCT \"left\")) AS a, list_sort(list(DISTINCT CASE WHEN n > 25 THEN \"left\" END) FILTER (WHERE n > 25)) AS b FROM tl GROUP BY episode) SELECT episode, len(a) AS n, coalesce(len(list_intersect(a, b)), 0) AS common, len(a) - coalesce(len(list_intersect(a, b)), 0) AS only_a FROM s")
def array_set_algebra(spark, root):
    """SET-06."""
    s = timeline(spark, root).groupBy("episode").agg(F.collect_set("left").alias("a"), F.collect_set(F.when(F.col("n") > 25, F.col("left"))).alias("b"))
    return s.select("episode", F.size("a").cast("long").alias("n"), F.size(F.array_intersect("a", "b")).cast("long").alias("common"), F.size(F.array_except("a", "b")).cast("long").alias("only_a"))


@query("action_rows", f"""{TL} SELECT episode, '[' || string_agg('{{"segment":' || segment || ',"start":' || start_frame || ',"end":' || end_frame || ',"verb":"left:' || "left" || ', right:' || "right" || '"}}', ',' ORDER BY segment) || ']' AS segments FROM tl GROUP BY episode""")
def action_rows(spark, root):
    """ROW-01, D12: the segments of an episode as one JSON text."""
    part = F.struct("segment", F.col("start_frame").alias("start"), F.col("end_frame").alias("end"), F.concat(F.lit("left:"), "left", F.lit(", right:"), "right").alias("verb"))
    return timeline(spark, root).groupBy("episode").agg(F.to_json(F.sort_array(F.collect_list(part))).alias("segments"))


@query("round_trip_audit", f"{TL} SELECT count(*) AS episodes, count(*) FILTER (WHERE total <> last_ + 1) AS coverage, count(*) FILTER (WHERE first_ <> 0) AS origin FROM (SELECT episode, sum(n) AS total, max(end_frame) AS last_, min(start_frame) AS first_ FROM tl GROUP BY episode)")
def round_trip_audit(spark, root):
    """ROW-05: frames that the segments give back against those there were."""
    e = timeline(spark, root).groupBy("episode").agg(F.sum("n").alias("total"), F.max("end_frame").alias("last_"), F.min("start_frame").alias("first_"))
    return e.agg(F.count("*").alias("episodes"), F.count_if(F.col("total") != F.col("last_") + 1).alias("coverage"), F.count_if(F.col("first_") != 0).alias("origin"))


@query("split_disjointness", "SELECT count(*) AS keys, count(*) FILTER (WHERE n > 1) AS shared, max(n) AS most FROM (SELECT o_custkey, count(DISTINCT o_orderkey % 2) AS n FROM orders GROUP BY 1)")
def split_disjointness(spark, root):
    """SET-03: keys that both halves hold."""
    k = table(spark, root, "orders").groupBy("o_custkey").agg(F.countDistinct(F.col("o_orderkey") % 2).alias("n"))
    return k.agg(F.count("*").alias("keys"), F.count_if(F.col("n") > 1).alias("shared"), F.max("n").alias("most"))


@query("sentence_trim", r"""WITH s AS (SELECT doc_id, unnest(string_split_regex(text, '[.!?]\s+')) AS s, generate_subscripts(string_split_regex(text, '[.!?]\s+'), 1) AS k FROM documents), n AS (SELECT doc_id, k, len(regexp_extract_all(s, '\S+')) AS n FROM s),
  c AS (SELECT *, sum(n) OVER (PARTITION BY doc_id ORDER BY k) AS total FROM n) SELECT doc_id, count(*) FILTER (WHERE total <= 50) AS sentences, CAST(coalesce(max(total) FILTER (WHERE total <= 50), 0) AS BIGINT) AS words FROM c GROUP BY doc_id""")
def sentence_trim(spark, root):
    """STR-02: whole sentences up to fifty words."""
    s = documents(spark, root).select("doc_id", F.posexplode(F.split("text", r"[.!?]\s+")).alias("k", "s"))
    total = F.sum(F.regexp_count("s", F.lit(r"\S+"))).over(Window.partitionBy("doc_id").orderBy("k"))
    c = s.select("doc_id", total.alias("total"))
    return c.groupBy("doc_id").agg(F.count_if(F.col("total") <= 50).alias("sentences"), F.coalesce(F.max(F.when(F.col("total") <= 50, F.col("total"))), F.lit(0)).cast("long").alias("words"))


@query("citation_validity", r"SELECT c.conv_id, c.turn, len(list_filter(regexp_extract_all(lower(text), '[a-z]+')[1:5], lambda w: NOT list_contains(['the', 'and', 'of', 'de', 'la', 'der', 'die', 'el', 'que'], w))) = 0 AND contains(text, substr(text, 3, 10)) AS valid FROM conversations c")
def citation_validity(spark, root):
    """FLT-18: ids that are allowed and a quote that stands in the body."""
    allowed = F.array(*[F.lit(w) for w in ("the", "and", "of", "de", "la", "der", "die", "el", "que")])
    cited = F.slice(F.regexp_extract_all(F.lower("text"), F.lit("([a-z]+)"), F.lit(1)), 1, 5)
    return table(spark, root, "conversations").select("conv_id", "turn", citations_ok(cited, allowed, F.substring("text", 3, 10), F.col("text")).alias("valid"))


@query("temporal_parameters", f"{EV}, d AS (SELECT episode, median(dt) AS period FROM (SELECT episode, t - lag(t) OVER (PARTITION BY episode ORDER BY frame) AS dt FROM ev) GROUP BY episode) SELECT episode, period, CAST(greatest(1, round_even(3.6e10 / period, 0)) AS BIGINT) AS window_frames, CAST(greatest(3, round_even(7.2e9 / period, 0)) AS BIGINT) AS phase_frames FROM d")
def temporal_parameters(spark, root):
    """PRJ-16, AGG-23: durations in frames of the median step, half to even, with least values."""
    d = events(spark, root).withColumn("dt", F.col("t") - F.lag("t").over(along())).groupBy("episode").agg(F.percentile("dt", F.lit(0.5)).alias("period"))
    frames = lambda s, least: F.greatest(F.lit(least), round_even(F.lit(s) / F.col("period"), 0)).cast("long")
    return d.select("episode", "period", frames(3.6e10, 1).alias("window_frames"), frames(7.2e9, 3).alias("phase_frames"))


@query("receipt_gate", "SELECT l_orderkey AS episode, count(DISTINCT l_suppkey) = 4 AS distinct_receipts, bool_and(l_discount <= 0.09) AS all_pass FROM lineitem GROUP BY 1 HAVING count(*) >= 4")
def receipt_gate(spark, root):
    """ROW-11, ROW-12: four distinct receipts, and every check passed."""
    rows = table(spark, root, "lineitem").groupBy(F.col("l_orderkey").alias("episode")).agg(F.collect_list("l_suppkey").alias("receipts"), F.collect_list(F.col("l_discount") <= 0.09).alias("checks"))
    rows = rows.where(F.size("receipts") >= 4)
    return rows.select("episode", (F.size(F.array_distinct("receipts")) == 4).alias("distinct_receipts"), F.forall("checks", lambda c: c).alias("all_pass"))


@query("source_drift", "SELECT CASE WHEN p.p_partkey IS NULL THEN 'new' WHEN l.k IS NULL THEN 'unused' WHEN p.p_size % 7 = 0 THEN 'changed' ELSE 'same' END AS state, count(*) AS parts FROM part p FULL JOIN (SELECT DISTINCT l_partkey AS k FROM lineitem) l ON p.p_partkey = l.k GROUP BY 1")
def source_drift(spark, root):
    """ROW-25: an inventory against what is found."""
    used = table(spark, root, "lineitem").select(F.col("l_partkey").alias("p_partkey"), F.lit(1).alias("used")).distinct()
    both = table(spark, root, "part").select("p_partkey", "p_size", F.lit(1).alias("listed")).join(used, "p_partkey", "full")
    state = F.when(F.col("listed").isNull(), "new").when(F.col("used").isNull(), "unused").when(F.col("p_size") % 7 == 0, "changed").otherwise("same")
    return both.groupBy(state.alias("state")).agg(F.count("*").alias("parts"))


@query("run_manifest", f"{TL} SELECT count(DISTINCT episode) AS episodes, count(*) AS segments, CAST(sum(n) AS BIGINT) AS frames, CAST(sum(CAST(ceil(n / 8.0) AS BIGINT)) AS BIGINT) AS chunks, count(DISTINCT \"left\" || \"right\") AS pairs FROM tl")
def run_manifest(spark, root):
    """ROW-23."""
    n = F.col("n")
    return timeline(spark, root).agg(F.countDistinct("episode").alias("episodes"), F.count("*").alias("segments"), F.sum(n).alias("frames"), F.sum(F.ceil(n / 8).cast("long")).alias("chunks"), F.countDistinct(F.concat("left", "right")).alias("pairs"))


@query("sample_ids", f"{TL} SELECT episode, segment, 'episode_' || lpad(CAST(episode AS VARCHAR), 6, '0') || '_segment_' || lpad(CAST(segment AS VARCHAR), 3, '0') AS sample_id, list_transform(['head', 'left', 'right'], lambda r: 'images/' || r || '_' || start_frame || '.jpg') AS images FROM tl")
def sample_ids(spark, root):
    """PRJ-17, SRC-02."""
    name = F.concat(F.lit("episode_"), F.lpad(F.col("episode").cast("string"), 6, "0"), F.lit("_segment_"), F.lpad(F.col("segment").cast("string"), 3, "0"))
    images = F.array(*[F.concat(F.lit(f"images/{r}_"), F.col("start_frame").cast("string"), F.lit(".jpg")) for r in ("head", "left", "right")])
    return timeline(spark, root).select("episode", "segment", name.alias("sample_id"), images.alias("images"))


# The role of each raw phase.
PHASES = {"view": "rollout", "click": "rollout", "signup": "recovery", "purchase": "recovery", "error": "failure"}


@query("phase_role_counts", f"{EV}, p AS (SELECT episode, CASE label " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in PHASES.items()) + " END AS role FROM ev) SELECT episode, count(*) FILTER (WHERE role = 'rollout') AS rollout, count(*) FILTER (WHERE role = 'failure') AS failure, count(*) FILTER (WHERE role = 'recovery') AS recovery FROM p GROUP BY episode")
def phase_role_counts(spark, root):
    """ROW-07, AGG-15."""
    role = F.create_map(*[F.lit(x) for kv in PHASES.items() for x in kv])[F.col("label")]
    return events(spark, root).select("episode", role.alias("role")).groupBy("episode").agg(*[F.count_if(F.col("role") == r).alias(r) for r in ("rollout", "failure", "recovery")])


@query("recovery_rows", f"""{EV}, r AS (SELECT *, lag(label) OVER w AS before, lead(label) OVER w AS next FROM ev WINDOW w AS (PARTITION BY episode ORDER BY frame))
  SELECT episode, frame, 'failure' AS role, false AS supervised FROM r WHERE label = 'error' UNION ALL SELECT episode, frame, 'recovery', true FROM r WHERE before = 'error' AND label <> 'error' UNION ALL SELECT episode, frame, 'terminal', false FROM r WHERE next IS NULL""")
def recovery_rows(spark, root):
    """SEG-16: what rows of a sequence become, each role a branch."""
    w = along()
    r = events(spark, root).select("episode", "frame", "label", F.lag("label").over(w).alias("before"), F.lead("label").over(w).alias("next"))
    roles = F.array(F.when(F.col("label") == "error", F.struct(F.lit("failure").alias("role"), F.lit(False).alias("supervised"))), F.when((F.col("before") == "error") & (F.col("label") != "error"), F.struct(F.lit("recovery").alias("role"), F.lit(True).alias("supervised"))), F.when(F.col("next").isNull(), F.struct(F.lit("terminal").alias("role"), F.lit(False).alias("supervised"))))
    return r.select("episode", "frame", F.explode(F.filter(roles, lambda x: x.isNotNull())).alias("x")).select("episode", "frame", "x.role", "x.supervised")


@query("evidence_lines", r"WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS k FROM documents) SELECT doc_id, CAST(k AS INTEGER) AS k, length(line) AS n FROM l WHERE regexp_matches(line, '^(The|Der|La|Los) ')")
def evidence_lines(spark, root):
    """ROW-14: lines of a text that begin in a known way, with their place."""
    lines = documents(spark, root).select("doc_id", F.posexplode(F.split("text", "\n")).alias("k", "line"))
    return lines.where(F.col("line").rlike("^(The|Der|La|Los) ")).select("doc_id", "k", F.length("line").cast("long").alias("n"))


@query("outcome_prefix", "SELECT o_orderstatus AS status, regexp_replace(CASE o_orderstatus WHEN 'F' THEN 'Failed: ' WHEN 'O' THEN 'Open: ' ELSE '' END || o_orderpriority, '^(Failed|Open): [0-9]-', '') AS body, count(*) AS n FROM orders GROUP BY ALL")
def outcome_prefix(spark, root):
    """ROW-24: a prefix by status, put before a text and taken off again."""
    prefix = F.when(F.col("o_orderstatus") == "F", "Failed: ").when(F.col("o_orderstatus") == "O", "Open: ").otherwise("")
    body = F.regexp_replace(F.concat(prefix, "o_orderpriority"), r"^(Failed|Open): [0-9]-", "")
    return table(spark, root, "orders").groupBy(F.col("o_orderstatus").alias("status"), body.alias("body")).agg(F.count("*").alias("n"))


@query("latest_prior_annotation", f"{EV}, a AS (SELECT episode, t, event_id, label FROM ev WHERE label IN ('signup', 'error')) SELECT k.episode, k.event_id, a.event_id AS annotation, a.label AS kind FROM ev k ASOF LEFT JOIN a ON k.episode = a.episode AND k.t >= a.t WHERE k.label = 'purchase'")
def latest_prior_annotation(spark, root):
    """ROW-15: the last annotation at or before each segment start."""
    ev = events(spark, root)
    note = F.when(F.col("label").isin("signup", "error"), F.struct(F.col("event_id").alias("annotation"), F.col("label").alias("kind")))
    last = F.last(note, ignorenulls=True).over(along().rowsBetween(Window.unboundedPreceding, 0))
    return ev.select("episode", "event_id", "label", last.alias("a")).where("label = 'purchase'").select("episode", "event_id", "a.annotation", "a.kind")


@query("vocabulary_overlap", r"WITH w AS (SELECT DISTINCT lang, unnest(regexp_extract_all(lower(text), '[a-z0-9]+')) AS word FROM documents) SELECT a.lang AS a, b.lang AS b, count(*) AS shared FROM w a JOIN w b USING (word) WHERE a.lang < b.lang GROUP BY ALL")
def vocabulary_overlap(spark, root):
    """SET-02, STR-13: words that two languages have in common."""
    w = documents(spark, root).select("lang", F.explode_outer(tokens(F.col("text"), "strict")).alias("word")).where("word is not null").distinct()
    other = w.select(F.col("lang").alias("b"), "word")
    return w.withColumnRenamed("lang", "a").join(other, "word").where("a < b").groupBy("a", "b").agg(F.count("*").alias("shared"))

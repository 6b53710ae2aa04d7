"""SQL for the sequential rules: recursion over lists, one step for each merge, cut or match. For checks, not for speed."""

from __future__ import annotations

from segloom.sources.tables import EVENTS, TIMELINE

PAIR = "'left:' || \"left\" || ', right:' || \"right\""

#: The first short group beside an equal one joins the one before if it can, else the one after, until there is none.
SHORT_MERGE = f"""WITH RECURSIVE {TIMELINE},
 s AS (SELECT episode, list({{'n': n, 'pair': {PAIR}, 'a': start_frame, 'z': end_frame, 'k': CAST(1 AS BIGINT)}} ORDER BY segment) AS g FROM tl GROUP BY episode),
 m AS (SELECT episode, g, 0 AS step FROM s
   UNION ALL SELECT episode, list_concat(list_concat(g[1:j - 1], [{{'n': g[j].n + g[j + 1].n, 'pair': g[j].pair, 'a': g[j].a, 'z': g[j + 1].z, 'k': g[j].k + g[j + 1].k}}]), g[j + 2:]), step + 1
   FROM (SELECT *, CASE WHEN i > 1 AND g[i - 1].pair = g[i].pair THEN i - 1 ELSE i END AS j FROM
     (SELECT *, coalesce(list_position(list_transform(range(1, len(g) + 1), lambda i: g[i].n < 8 AND ((i > 1 AND g[i - 1].pair = g[i].pair) OR (i < len(g) AND g[i + 1].pair = g[i].pair))), true), 0) AS i FROM m)) WHERE i > 0),
 e AS (SELECT episode, arg_max(g, step) AS g FROM m GROUP BY episode),
 u AS (SELECT episode, unnest(range(1, len(g) + 1)) AS i, g FROM e)
 SELECT episode, CAST(i - 1 AS BIGINT) AS grp, g[i].pair AS pair, g[i].a AS start_frame, g[i].z AS end_frame, g[i].k AS pieces FROM u"""

#: The cheapest cost of each prefix, from those before it; of equal costs the shorter last group.
COARSENING = f"""WITH RECURSIVE {TIMELINE},
 r AS (SELECT *, sum(turn) OVER (PARTITION BY episode ORDER BY segment) AS run FROM (SELECT *, CASE WHEN {PAIR} = lag({PAIR}) OVER (PARTITION BY episode ORDER BY segment) THEN 0 ELSE 1 END AS turn FROM tl)),
 s AS (SELECT episode, run, list(start_frame ORDER BY segment) || [max(end_frame) + 1] AS cut FROM r GROUP BY episode, run),
 d AS (SELECT episode, run, cut, [0.0::DOUBLE] AS cost, [-1::BIGINT] AS back FROM s
   UNION ALL SELECT episode, run, cut, list_append(cost, best.c), list_append(back, -best.s) FROM
     (SELECT *, list_sort(list_transform(list_filter(range(0, len(cost)), lambda i: i = len(cost) - 1 OR cut[len(cost) + 1] - cut[i + 1] <= 128),
        lambda i: {{'c': cost[i + 1] + 0.8::DOUBLE + 4 * pow(greatest(0, 32 - (cut[len(cost) + 1] - cut[i + 1])) / 16.0::DOUBLE, 2) + pow(greatest(0, cut[len(cost) + 1] - cut[i + 1] - 64) / 32.0::DOUBLE, 2), 's': -i}}))[1] AS best
      FROM d WHERE len(cost) < len(cut))),
 f AS (SELECT episode, run, cut, cost[len(cut)] AS cost, back FROM d WHERE len(cost) = len(cut)),
 b AS (SELECT episode, run, cut, cost, back, back[len(cut)] AS a, CAST(len(cut) - 1 AS BIGINT) AS z FROM f
   UNION ALL SELECT episode, run, cut, cost, back, back[a + 1], a FROM b WHERE a > 0)
 SELECT episode, CAST(run AS BIGINT) AS run, row_number() OVER (PARTITION BY episode, run ORDER BY a) - 1 AS grp, cut[a + 1] AS start_frame, cut[z + 1] - 1 AS end_frame, z - a AS pieces, cost FROM b"""

#: From each boundary on, more of them at the least energy near the farthest point allowed.
LENGTH_SPLIT = f"""WITH RECURSIVE {TIMELINE},
 s AS (SELECT episode, list(start_frame ORDER BY segment) || [sum(n)::BIGINT] AS cut, flatten(list(list_transform(range(n), lambda i: n) ORDER BY segment)) AS energy FROM tl GROUP BY episode),
 w AS (SELECT episode, cut, energy, CAST(0 AS BIGINT) AS pos, 2 AS i FROM s
   UNION ALL SELECT episode, cut, energy, CASE WHEN cut[i] - pos <= 24 THEN cut[i] WHEN hi > lo THEN lo - 1 + list_position(energy[lo + 1:hi + 1], list_min(energy[lo + 1:hi + 1])) ELSE pos + 24 END, CASE WHEN cut[i] - pos <= 24 THEN i + 1 ELSE i END
   FROM (SELECT *, greatest(pos + 4, pos + 18) AS lo, least(cut[i] - 4, pos + 30) AS hi FROM w WHERE i <= len(cut))),
 c AS (SELECT DISTINCT episode, pos FROM w)
 SELECT episode, row_number() OVER o - 1 AS segment, pos AS start_frame, stop - 1 AS end_frame FROM (SELECT episode, pos, lead(pos) OVER (PARTITION BY episode ORDER BY pos) AS stop FROM c) WHERE stop IS NOT NULL WINDOW o AS (PARTITION BY episode ORDER BY pos)"""

#: Runs of one frame vanish between equal neighbours; what is left of them joins the run before, or the next one at the start.
PHASE_SMOOTHING = f"""WITH RECURSIVE {EVENTS},
 l AS (SELECT episode, frame, CASE WHEN c < 1000 THEN 'low' WHEN c < 3000 THEN 'middle' ELSE 'high' END AS label FROM ev),
 t AS (SELECT *, sum(turn) OVER (PARTITION BY episode ORDER BY frame) AS run FROM (SELECT *, CASE WHEN label = lag(label) OVER (PARTITION BY episode ORDER BY frame) THEN 0 ELSE 1 END AS turn FROM l)),
 r AS (SELECT episode, run, any_value(label) AS label, min(frame) AS a, max(frame) AS z FROM t GROUP BY episode, run),
 s AS (SELECT episode, list({{'label': label, 'a': a, 'z': z}} ORDER BY a) AS g FROM r GROUP BY episode),
 m AS (SELECT episode, g, 0 AS step FROM s
   UNION ALL SELECT episode, list_concat(list_concat(g[1:i - 2], [{{'label': g[i - 1].label, 'a': g[i - 1].a, 'z': g[i + 1].z}}]), g[i + 2:]), step + 1
   FROM (SELECT *, coalesce(list_position(list_transform(range(1, len(g) + 1), lambda i: i > 1 AND i < len(g) AND g[i].a = g[i].z AND g[i - 1].label = g[i + 1].label), true), 0) AS i FROM m) WHERE i > 0),
 e AS (SELECT episode, arg_max(g, step) AS g FROM m GROUP BY episode),
 u AS (SELECT episode, i, g[i].label AS label, g[i].a AS a, g[i].z AS z FROM (SELECT episode, g, unnest(range(1, len(g) + 1)) AS i FROM e)),
 k AS (SELECT episode, grp, arg_min(label, i) AS label, min(a) AS a, max(z) AS z FROM (SELECT *, sum(CASE WHEN i = 1 OR z > a THEN 1 ELSE 0 END) OVER (PARTITION BY episode ORDER BY i) AS grp FROM u) GROUP BY episode, grp),
 q AS (SELECT *, max(grp) OVER (PARTITION BY episode) > 1 AND min(a) OVER (PARTITION BY episode) = min(CASE WHEN grp = 1 THEN z END) OVER (PARTITION BY episode) AS short_head FROM k),
 h AS (SELECT episode, label, CASE WHEN short_head AND grp = 2 THEN 0 ELSE a END AS a, z FROM q WHERE NOT (short_head AND grp = 1)),
 c AS (SELECT *, sum(turn) OVER (PARTITION BY episode ORDER BY a) AS run FROM (SELECT *, CASE WHEN label = lag(label) OVER (PARTITION BY episode ORDER BY a) THEN 0 ELSE 1 END AS turn FROM h))
 SELECT episode, CAST(run - 1 AS BIGINT) AS run, any_value(label) AS phase, CAST(min(a) AS BIGINT) AS start_frame, max(z) AS end_frame FROM c GROUP BY episode, run"""

_CENTRE = """CASE WHEN len(list_filter({0}, lambda e: e.strong)) > 0
  THEN CAST(round_even(list_sum(list_transform(list_filter({0}, lambda e: e.strong), lambda e: e.f * e.w)) / list_sum(list_transform(list_filter({0}, lambda e: e.strong), lambda e: e.w)), 0) AS BIGINT) ELSE {0}[1].f END"""

#: Clusters in order; one whose centre is under four frames after that of the last output is combined with all of its members.
EVIDENCE_FILTER = f"""WITH RECURSIVE {EVENTS},
 h AS (SELECT *, count(*) OVER (PARTITION BY episode) AS frames FROM ev), b AS (SELECT * FROM h WHERE c >= 3000 AND frame BETWEEN 4 AND frames - 4),
 t AS (SELECT *, sum(far) OVER (PARTITION BY episode ORDER BY frame) AS cluster FROM (SELECT *, CASE WHEN frame - lag(frame) OVER (PARTITION BY episode ORDER BY frame) > 2 THEN 1 ELSE 0 END AS far FROM b)),
 s AS (SELECT episode, row_number() OVER (PARTITION BY episode ORDER BY cluster) AS i, g FROM (SELECT episode, cluster, list({{'f': frame, 'w': c / 1000.0::DOUBLE, 'strong': c >= 4000, 'type': label}} ORDER BY frame) AS g FROM t GROUP BY episode, cluster)),
 x AS (SELECT episode, i, g, {_CENTRE.format('g')} AS centre FROM s),
 m AS (SELECT episode, i, 1::BIGINT AS o, g, centre FROM x WHERE i = 1
   UNION ALL SELECT episode, i, o, g, {_CENTRE.format('g')} FROM
    (SELECT x.episode, x.i, CASE WHEN x.centre - m.centre < 4 THEN m.o ELSE m.o + 1 END AS o, CASE WHEN x.centre - m.centre < 4 THEN list_concat(m.g, x.g) ELSE x.g END AS g FROM m JOIN x ON x.episode = m.episode AND x.i = m.i + 1)),
 e AS (SELECT episode, o, arg_max(g, i) AS g, arg_max(centre, i) AS frame FROM m GROUP BY episode, o)
 SELECT episode, frame, list_max(list_transform(g, lambda e: e.w)) AS strength, list_bool_or(list_transform(g, lambda e: e.strong)) AS strong, list_sort(list_distinct(list_transform(g, lambda e: e.type))) AS types, len(g) AS support FROM e"""

#: Left items in order, each with the nearest right one not used yet.
BIMANUAL_MATCH = f"""WITH RECURSIVE {EVENTS},
 s AS (SELECT episode, coalesce(list({{'f': frame, 'w': c / 100.0::DOUBLE + 1, 'high': c >= 1500}} ORDER BY frame) FILTER (WHERE label = 'click'), []) AS l, coalesce(list({{'f': frame, 'w': c / 100.0::DOUBLE + 1, 'high': c >= 1500}} ORDER BY frame) FILTER (WHERE label = 'view'), []) AS r FROM ev GROUP BY episode),
 m AS (SELECT episode, l, r, 0 AS i, []::BIGINT[] AS used, CAST(0 AS BIGINT) AS j FROM s
   UNION ALL SELECT episode, l, r, i + 1, CASE WHEN ok THEN list_append(used, near.j) ELSE used END, CASE WHEN ok THEN near.j ELSE 0 END FROM
    (SELECT *, near.j IS NOT NULL AND (l[i + 1].high = r[near.j].high OR near.gap <= 1) AS ok FROM
      (SELECT *, list_sort(list_transform(list_filter(range(1, len(r) + 1), lambda k: abs(r[k].f - l[i + 1].f) <= 3 AND NOT list_contains(used, k)), lambda k: {{'gap': abs(r[k].f - l[i + 1].f), 'j': k}}))[1] AS near FROM m WHERE i < len(l)))),
 o AS (SELECT episode, CASE WHEN j = 0 THEN l[i].f ELSE CAST(round_even((l[i].f * l[i].w + r[j].f * r[j].w) / (l[i].w + r[j].w), 0) AS BIGINT) END AS frame,
     CASE WHEN j = 0 THEN 'single_arm' WHEN l[i].high = r[j].high THEN 'synchronous_level' ELSE 'near_simultaneous_mixed_evidence' END AS relation, CASE WHEN j = 0 THEN ['click'] ELSE ['click', 'view'] END AS arms FROM m WHERE i > 0),
 e AS (SELECT episode, r, arg_max(used, i) AS used FROM m GROUP BY episode, r)
 SELECT * FROM o UNION ALL SELECT episode, r[k].f, 'single_arm', ['view'] FROM (SELECT episode, r, used, unnest(range(1, len(r) + 1)) AS k FROM e) WHERE NOT list_contains(used, k)"""

#: Pairs of one direction by distance, then by place; each that finds both its events free takes them.
SYNCHRONOUS = f"""WITH RECURSIVE {EVENTS},
 a AS (SELECT episode, frame, c >= 1500 AS up, row_number() OVER (PARTITION BY episode ORDER BY frame) AS i FROM ev WHERE label = 'click'), b AS (SELECT episode, frame, c >= 1500 AS up, row_number() OVER (PARTITION BY episode ORDER BY frame) AS j FROM ev WHERE label = 'view'),
 p AS (SELECT a.episode, a.frame AS l, b.frame AS r, i, j, abs(a.frame - b.frame) AS gap FROM a JOIN b ON a.episode = b.episode AND a.up = b.up AND abs(a.frame - b.frame) <= 2),
 s AS (SELECT episode, list({{'gap': gap, 'i': i, 'j': j, 'l': l, 'r': r}} ORDER BY gap, i, j) AS g FROM p GROUP BY episode),
 m AS (SELECT episode, g, 0 AS k, []::BIGINT[] AS ui, []::BIGINT[] AS uj, false AS ok FROM s
   UNION ALL SELECT episode, g, k + 1, CASE WHEN free THEN list_append(ui, g[k + 1].i) ELSE ui END, CASE WHEN free THEN list_append(uj, g[k + 1].j) ELSE uj END, free
   FROM (SELECT *, NOT list_contains(ui, g[k + 1].i) AND NOT list_contains(uj, g[k + 1].j) AS free FROM m WHERE k < len(g)))
 SELECT episode, g[k].l AS left_frame, g[k].r AS right_frame, g[k].gap AS separation FROM m WHERE ok"""


def _centre(g: str) -> str:
    """Frame of the evidence in list g: the mean of strong members by strength, half to even, else the first."""
    strong = f"list_filter({g}, lambda e: e.strong)"
    return f"CASE WHEN len({strong}) > 0 THEN CAST(round_even(list_sum(list_transform({strong}, lambda e: e.f * e.s)) / list_sum(list_transform({strong}, lambda e: e.s)), 0) AS BIGINT) ELSE {g}[1].f END"


def _folded(name: str, rows: str, least: int, radius: int, keys: str) -> str:
    """CTEs <name>_k (clusters) and <name> (outputs) of evidence `rows` (keys, n, f, s, strong, kind, o): filtered, clustered, and folded
    where the centre of the next cluster is under `least` frames after the last output."""
    return f"""{name}_b AS (SELECT *, CASE WHEN f - lag(f) OVER (PARTITION BY {keys} ORDER BY f, o) > {radius} THEN 1 ELSE 0 END AS far FROM {rows} WHERE f BETWEEN {least} AND n - {least}),
 {name}_t AS (SELECT *, sum(far) OVER (PARTITION BY {keys} ORDER BY f, o) AS cluster FROM {name}_b),
 {name}_s AS (SELECT {keys}, n, row_number() OVER (PARTITION BY {keys} ORDER BY cluster) AS i, g FROM (SELECT {keys}, n, cluster, list({{'f': f, 's': s, 'strong': strong, 'kind': kind}} ORDER BY f, o) AS g FROM {name}_t GROUP BY {keys}, n, cluster)),
 {name}_x AS (SELECT *, {_centre('g')} AS centre FROM {name}_s),
 {name}_m AS (SELECT {keys}, n, i, 1::BIGINT AS o, g, centre FROM {name}_x WHERE i = 1
   UNION ALL SELECT {keys}, n, i, o, g, {_centre('g')} FROM (SELECT {', '.join(f'x.{k.strip()}' for k in keys.split(','))}, x.n, x.i, CASE WHEN x.centre - m.centre < {least} THEN m.o ELSE m.o + 1 END AS o, CASE WHEN x.centre - m.centre < {least} THEN list_concat(m.g, x.g) ELSE x.g END AS g FROM {name}_m m JOIN {name}_x x ON {' AND '.join(f'x.{k.strip()} = m.{k.strip()}' for k in keys.split(','))} AND x.i = m.i + 1)),
 {name} AS (SELECT {keys}, n, o, frame AS f, list_max(list_transform(g, lambda e: e.s)) AS s, len(list_filter(g, lambda e: e.strong)) > 0 AS strong,
   CASE WHEN len(list_filter(g, lambda e: e.strong)) > 0 THEN list_sort(list_transform(range(1, len(g) + 1), lambda i: {{'a': NOT g[i].strong, 's': -g[i].s, 'f': g[i].f, 'i': i, 'kind': g[i].kind}}))[1].kind ELSE g[1].kind END AS kind
   FROM (SELECT {keys}, n, o, arg_max(g, i) AS g, arg_max(centre, i) AS frame FROM {name}_m GROUP BY {keys}, n, o))"""


def segment_sql(vectors: str) -> str:
    """Segments of dual-arm episodes at 50 frames a second: features, evidence of both arms, its clusters, matches, labels, still policy.

    vectors: the CTE vx (episode, frame, x), x in millionths.
    """
    w, d = "PARTITION BY episode, arm ORDER BY frame", "1000000.0::DOUBLE"
    return f"""WITH RECURSIVE {vectors},
 fa AS (SELECT episode, frame, arm, frame * 0.02::DOUBLE AS t, x[o + 1] / {d} AS px, x[o + 2] / {d} AS py, x[o + 3] / {d} AS pz, x[o + 4] / {d} / greatest(size, 1e-12) AS qw, x[o + 5] / {d} / greatest(size, 1e-12) AS qx, x[o + 6] / {d} / greatest(size, 1e-12) AS qy, x[o + 7] / {d} / greatest(size, 1e-12) AS qz, x[o + 8] / {d} AS grip FROM
   (SELECT *, sqrt(pow(x[o + 4] / {d}, 2) + pow(x[o + 5] / {d}, 2) + pow(x[o + 6] / {d}, 2) + pow(x[o + 7] / {d}, 2)) AS size FROM (SELECT episode, frame, x, unnest(['left', 'right']) AS arm, unnest([0, 8]) AS o FROM vx))),
 fq AS (SELECT episode, arm, quantile_cont(grip, 0.05) AS lo, quantile_cont(grip, 0.95) AS hi, count(*) AS n FROM fa GROUP BY ALL),
 fb AS (SELECT fa.*, n, CASE WHEN hi - lo > 1e-9 THEN least(greatest((grip - lo) / (hi - lo), 0), 1) ELSE 0 END AS unit FROM fa JOIN fq USING (episode, arm)),
 fl AS (SELECT *, t - lag(t) OVER w AS dt, lag(px) OVER w AS ax, lag(py) OVER w AS ay, lag(pz) OVER w AS az, lag(qw) OVER w AS w0, lag(qx) OVER w AS x0, lag(qy) OVER w AS y0, lag(qz) OVER w AS z0, lag(unit) OVER w AS u0 FROM fb WINDOW w AS ({w})),
 fm AS (SELECT *, coalesce((px - ax) / dt, 0) AS vx_, coalesce((py - ay) / dt, 0) AS vy_, coalesce((pz - az) / dt, 0) AS vz_, coalesce((unit - u0) / dt, 0) AS rate, coalesce(sqrt(pow(px - ax, 2) + pow(py - ay, 2) + pow(pz - az, 2)), 0) AS step, coalesce(2 * acos(least(abs(qw * w0 + qx * x0 + qy * y0 + qz * z0), 1.0)), 0) AS turn, abs(qw * w0 + qx * x0 + qy * y0 + qz * z0) AS cw,
   sqrt(pow(-qw * x0 + w0 * qx - (qy * z0 - qz * y0), 2) + pow(-qw * y0 + w0 * qy - (qz * x0 - qx * z0), 2) + pow(-qw * z0 + w0 * qz - (qx * y0 - qy * x0), 2)) AS len FROM fl),
 fn AS (SELECT *, coalesce(CASE WHEN len > 1e-12 THEN 2 * atan2(len, cw) ELSE 2 * len END / dt, 0) AS spin, sqrt(vx_ * vx_ + vy_ * vy_ + vz_ * vz_) AS speed FROM fm),
 fe AS (SELECT *, speed / 0.15::DOUBLE + spin / 1.0 + abs(rate) / 1.0 AS energy FROM fn),
 f AS (SELECT *, sum(energy * 0.2::DOUBLE) OVER (w ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING) AS calm, sum(step) OVER w AS path, sum(turn) OVER w AS rotation, first_value({{'x': px, 'y': py, 'z': pz, 'f': frame}}) OVER h AS pa, last_value({{'x': px, 'y': py, 'z': pz, 'f': frame}}) OVER h AS pb FROM fe WINDOW w AS ({w}), h AS ({w} ROWS BETWEEN 4 PRECEDING AND 4 FOLLOWING)),
 pi AS (SELECT episode, arm, n, min(frame) AS a, max(frame) AS z, arg_min(frame, calm) AS f, min(calm) AS e FROM (SELECT *, frame - row_number() OVER ({w}) AS island FROM f WHERE calm < 0.5) GROUP BY episode, arm, n, island),
 pe AS (SELECT episode, arm, n, f, 2 + greatest(0, (0.5::DOUBLE - e) / 0.5::DOUBLE) AS s, true AS strong, 'pause:still' AS kind, a AS o FROM pi WHERE z - a + 1 >= 3 AND a > 1 AND z < n - 2),
 gd AS (SELECT *, unnest(['increase', 'decrease']) AS dir, unnest([1, -1]) AS sign FROM f),
 go AS (SELECT *, sign * rate >= 0.5 AS lit, sign * rate <= -0.5 AS against FROM gd),
 gt AS (SELECT *, sum(turn_) OVER (PARTITION BY episode, arm, dir ORDER BY frame) AS run FROM (SELECT *, CASE WHEN lit = lag(lit) OVER (PARTITION BY episode, arm, dir ORDER BY frame) THEN 0 ELSE 1 END AS turn_ FROM go)),
 gb AS (SELECT *, lit OR (count(*) OVER r <= 2 AND min(frame) OVER r > 0 AND max(frame) OVER r < n - 1 AND NOT bool_or(against) OVER r) AS filled FROM gt WINDOW r AS (PARTITION BY episode, arm, dir, run)),
 gi AS (SELECT episode, arm, n, dir, min(frame) AS a, max(frame) AS b FROM (SELECT *, frame - row_number() OVER (PARTITION BY episode, arm, dir ORDER BY frame) AS island FROM gb WHERE filled) GROUP BY episode, arm, n, dir, island),
 gv AS (SELECT gi.* FROM gi JOIN f x ON x.episode = gi.episode AND x.arm = gi.arm AND x.frame = b JOIN f y ON y.episode = gi.episode AND y.arm = gi.arm AND y.frame = greatest(0, a - 1) WHERE abs(x.unit - y.unit) >= 0.08),
 gw AS (SELECT *, greatest(1, a - 30) AS lo, greatest(greatest(1, a - 30), a) AS hi, 0 AS post FROM gv UNION ALL SELECT *, b, least(n - 1, b + 20), 1 FROM gv),
 gx AS (SELECT gw.episode, gw.arm, gw.n, dir, a, post, arg_min(f.frame, f.calm) AS f, min(f.calm) AS e FROM gw JOIN f ON f.episode = gw.episode AND f.arm = gw.arm AND f.frame BETWEEN lo AND hi GROUP BY ALL),
 ge AS (SELECT episode, arm, n, f, 2.5 + greatest(0, 0.5::DOUBLE - e) AS s, true AS strong, 'gripper:' || dir AS kind, 1000000 + a * 4 + CASE dir WHEN 'increase' THEN 0 ELSE 2 END + post AS o FROM gx),
 la AS (SELECT f.episode, f.arm, f.n, f.frame, f.pb.z - f.pa.z AS dz, sqrt(pow(f.pb.x - f.pa.x, 2) + pow(f.pb.y - f.pa.y, 2) + pow(f.pb.z - f.pa.z, 2)) AS length, b.path - a.path AS way, b.rotation - a.rotation AS turned FROM f JOIN f a ON a.episode = f.episode AND a.arm = f.arm AND a.frame = f.pa.f JOIN f b ON b.episode = f.episode AND b.arm = f.arm AND b.frame = f.pb.f),
 lb AS (SELECT *, abs(dz) / greatest(length, 1e-12) AS upright FROM la),
 lc AS (SELECT *, CASE WHEN length < 0.003 AND way < 0.008 AND turned < 0.02 THEN 'still' WHEN abs(dz) >= 0.005 AND upright >= 0.62 THEN CASE WHEN dz > 0 THEN 'lift' ELSE 'lower' END WHEN turned / 0.05::DOUBLE > 1.6::DOUBLE * greatest(length / 0.03::DOUBLE, 1e-6) THEN 'turn' ELSE 'move' END AS label FROM lb),
 lt AS (SELECT *, sum(turn_) OVER ({w}) AS run FROM (SELECT *, CASE WHEN label = lag(label) OVER ({w}) THEN 0 ELSE 1 END AS turn_ FROM lc)),
 ls AS (SELECT episode, arm, list({{'label': label, 'a': a, 'z': z}} ORDER BY a) AS g FROM (SELECT episode, arm, run, any_value(label) AS label, min(frame) AS a, max(frame) AS z FROM lt GROUP BY episode, arm, run) GROUP BY episode, arm),
 lm AS (SELECT episode, arm, g, 0 AS step FROM ls UNION ALL SELECT episode, arm, list_concat(list_concat(g[1:i - 2], [{{'label': g[i - 1].label, 'a': g[i - 1].a, 'z': g[i + 1].z}}]), g[i + 2:]), step + 1
   FROM (SELECT *, coalesce(list_position(list_transform(range(1, len(g) + 1), lambda i: i > 1 AND i < len(g) AND g[i].z - g[i].a + 1 < 5 AND g[i - 1].label = g[i + 1].label), true), 0) AS i FROM lm) WHERE i > 0),
 lu AS (SELECT episode, arm, i, g[i].label AS label, g[i].a AS a, g[i].z AS z FROM (SELECT episode, arm, g, unnest(range(1, len(g) + 1)) AS i FROM (SELECT episode, arm, arg_max(g, step) AS g FROM lm GROUP BY episode, arm))),
 lk AS (SELECT episode, arm, grp, arg_min(label, i) AS label, min(a) AS a, max(z) AS z FROM (SELECT *, sum(CASE WHEN i = 1 OR z - a + 1 >= 5 THEN 1 ELSE 0 END) OVER (PARTITION BY episode, arm ORDER BY i) AS grp FROM lu) GROUP BY episode, arm, grp),
 lq AS (SELECT *, max(grp) OVER (PARTITION BY episode, arm) > 1 AND min(CASE WHEN grp = 1 THEN z - a + 1 END) OVER (PARTITION BY episode, arm) < 5 AS head FROM lk),
 lh AS (SELECT episode, arm, label, CASE WHEN head AND grp = 2 THEN 0 ELSE a END AS a, z FROM lq WHERE NOT (head AND grp = 1)),
 lv AS (SELECT *, sum(turn_) OVER (PARTITION BY episode, arm ORDER BY a) AS run FROM (SELECT *, CASE WHEN label = lag(label) OVER (PARTITION BY episode, arm ORDER BY a) THEN 0 ELSE 1 END AS turn_ FROM lh)),
 lr AS (SELECT episode, arm, run, any_value(label) AS label, min(a) AS a, max(z) AS z FROM lv GROUP BY episode, arm, run),
 ln AS (SELECT *, lag(z) OVER (PARTITION BY episode, arm ORDER BY a) AS before FROM lr),
 tr AS (SELECT ln.episode, ln.arm, x.n, ln.label, CAST(ln.a AS BIGINT) AS nominal, 1 + least(abs(x.upright - y.upright) + abs(x.turned - y.turned) / 0.05::DOUBLE, 2.0) AS s FROM ln JOIN lc x ON x.episode = ln.episode AND x.arm = ln.arm AND x.frame = ln.a JOIN lc y ON y.episode = ln.episode AND y.arm = ln.arm AND y.frame = ln.before),
 sc AS (SELECT episode, arm, frame, unnest(['still', 'move', 'turn', 'lift', 'lower']) AS label, unnest([1 / (1 + energy / 0.5::DOUBLE), sqrt(vx_ * vx_ + vy_ * vy_) / 0.08::DOUBLE, greatest(spin / 0.40::DOUBLE - 0.35::DOUBLE * speed / 0.08::DOUBLE, 0), greatest(vz_, 0) / 0.05::DOUBLE, greatest(-vz_, 0) / 0.05::DOUBLE]) AS score FROM f),
 sd AS (SELECT *, CASE WHEN label = 'still' THEN 0.45::DOUBLE ELSE 0.25::DOUBLE END AS low FROM sc),
 so AS (SELECT *, avg(score) OVER (p ROWS BETWEEN CURRENT ROW AND 2 FOLLOWING) AS after_, count(*) OVER (p ROWS BETWEEN CURRENT ROW AND 2 FOLLOWING) AS k, avg(CASE WHEN score >= low THEN 1.0::DOUBLE ELSE 0 END) OVER (p ROWS BETWEEN CURRENT ROW AND 2 FOLLOWING) AS held, avg(score) OVER (p ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING) AS before_ FROM sd WINDOW p AS (PARTITION BY episode, arm, label ORDER BY frame)),
 on_ AS (SELECT tr.episode, tr.arm, tr.nominal, min(so.frame) AS f FROM tr JOIN so ON so.episode = tr.episode AND so.arm = tr.arm AND so.label = tr.label AND so.frame BETWEEN greatest(1, nominal - 9) AND least(n - 1, nominal + 9) AND k > 1 AND score >= low AND after_ >= 0.55 AND held >= 0.67 AND (before_ < 0.55 OR after_ >= before_ + 0.15) GROUP BY ALL),
 te AS (SELECT tr.episode, tr.arm, n, coalesce(on_.f, tr.nominal) AS f, s, false AS strong, 'phase:' || label AS kind, 9000000 + tr.nominal AS o FROM tr LEFT JOIN on_ ON on_.episode = tr.episode AND on_.arm = tr.arm AND on_.nominal = tr.nominal),
 ev AS (SELECT episode, arm, n, f, s, strong, kind, o FROM pe UNION ALL SELECT episode, arm, n, f, s, strong, kind, o FROM ge UNION ALL SELECT episode, arm, n, f, s, strong, kind, o FROM te),
 {_folded('one', 'ev', 5, 5, 'episode, arm')},
 ep AS (SELECT episode, count(*) AS n FROM vx GROUP BY episode),
 pl AS (SELECT episode, ep.n, coalesce(list({{'f': f, 's': s, 'strong': strong, 'kind': kind}} ORDER BY o) FILTER (WHERE arm = 'left'), []) AS l, coalesce(list({{'f': f, 's': s, 'strong': strong, 'kind': kind}} ORDER BY o) FILTER (WHERE arm = 'right'), []) AS r FROM ep LEFT JOIN one USING (episode) GROUP BY episode, ep.n),
 pm AS (SELECT episode, n, l, r, 0 AS i, []::BIGINT[] AS used, CAST(0 AS BIGINT) AS j FROM pl
   UNION ALL SELECT episode, n, l, r, i + 1, CASE WHEN ok THEN list_append(used, near.j) ELSE used END, CASE WHEN ok THEN near.j ELSE 0 END FROM
    (SELECT *, near.j IS NOT NULL AND (l[i + 1].kind = r[near.j].kind OR near.gap <= 2) AS ok FROM (SELECT *, list_sort(list_transform(list_filter(range(1, len(r) + 1), lambda k: abs(r[k].f - l[i + 1].f) <= 4 AND NOT list_contains(used, k)), lambda k: {{'gap': abs(r[k].f - l[i + 1].f), 'j': k}}))[1] AS near FROM pm WHERE i < len(l)))),
 po AS (SELECT episode, n, i AS o, CASE WHEN j = 0 THEN [l[i]] ELSE [l[i], r[j]] END AS g FROM pm WHERE i > 0 UNION ALL SELECT episode, n, 100000 + k, [r[k]] FROM (SELECT episode, n, r, used, unnest(range(1, len(r) + 1)) AS k FROM (SELECT episode, n, r, arg_max(used, i) AS used FROM pm GROUP BY episode, n, r)) WHERE NOT list_contains(used, k)),
 jo AS (SELECT episode, n, o, CASE WHEN len(g) = 2 AND NOT g[1].strong AND NOT g[2].strong THEN least(g[1].f, g[2].f) ELSE {_centre('g')} END AS f, list_max(list_transform(g, lambda e: e.s)) AS s, len(list_filter(g, lambda e: e.strong)) > 0 AS strong, g[1].kind AS kind FROM po),
 {_folded('two', 'jo', 2, 0, 'episode')},
 cu AS (SELECT episode, n, f FROM two WHERE f > 0 AND f < n UNION SELECT episode, n, 0 FROM ep),
 sg AS (SELECT episode, n, row_number() OVER (PARTITION BY episode ORDER BY f) - 1 AS i, f AS a, coalesce(lead(f) OVER (PARTITION BY episode ORDER BY f), n) - 1 AS b FROM cu),
 rg AS (SELECT *, grip - lag(grip) OVER ({w}) AS change FROM f),
 ri AS (SELECT episode, arm, min(frame) - 1 AS s, max(frame) AS e FROM (SELECT *, frame - row_number() OVER ({w}) AS island FROM rg WHERE abs(change) >= 0.01) GROUP BY episode, arm, island),
 rv AS (SELECT sg.episode, sg.i, ri.arm, min(ri.s) AS s, arg_min(ri.e, ri.s) AS e FROM sg JOIN ri ON ri.episode = sg.episode AND ri.s <= sg.b AND ri.e >= sg.a GROUP BY ALL),
 lz AS (SELECT sg.episode, sg.i, sg.a, sg.b, x.arm, CASE WHEN rv.s IS NOT NULL THEN CASE WHEN ge_.grip < gs.grip THEN 'gripper_decrease' ELSE 'gripper_increase' END
     WHEN sqrt(pow(y.px - x.px, 2) + pow(y.py - x.py, 2) + pow(y.pz - x.pz, 2)) < 0.005 AND y.rotation - x.rotation < 0.03 THEN 'still'
     WHEN abs(y.pz - x.pz) > greatest(0.015::DOUBLE, 0.60::DOUBLE * sqrt(pow(y.px - x.px, 2) + pow(y.py - x.py, 2) + pow(y.pz - x.pz, 2))) AND abs(y.pz - x.pz) > sqrt(pow(y.px - x.px, 2) + pow(y.py - x.py, 2)) THEN CASE WHEN y.pz > x.pz THEN 'lift' ELSE 'lower' END
     WHEN (y.rotation - x.rotation) / 0.10::DOUBLE > 4.5::DOUBLE * greatest(sqrt(pow(y.px - x.px, 2) + pow(y.py - x.py, 2) + pow(y.pz - x.pz, 2)) / 0.08::DOUBLE, 1e-6) THEN 'turn' ELSE 'move' END AS action
   FROM sg JOIN f x ON x.episode = sg.episode AND x.frame = sg.a JOIN f y ON y.episode = sg.episode AND y.arm = x.arm AND y.frame = sg.b LEFT JOIN rv ON rv.episode = sg.episode AND rv.i = sg.i AND rv.arm = x.arm LEFT JOIN f gs ON gs.episode = sg.episode AND gs.arm = x.arm AND gs.frame = rv.s LEFT JOIN f ge_ ON ge_.episode = sg.episode AND ge_.arm = x.arm AND ge_.frame = rv.e),
 aa AS (SELECT episode, i, a, b, max(CASE WHEN arm = 'left' THEN action END) AS l, max(CASE WHEN arm = 'right' THEN action END) AS r FROM lz GROUP BY ALL),
 ab AS (SELECT *, l = 'still' AND r = 'still' AS still, sum(CASE WHEN l = 'still' AND r = 'still' THEN 0 ELSE 1 END) OVER (PARTITION BY episode ORDER BY i) AS seen FROM aa), ac AS (SELECT *, max(seen) OVER (PARTITION BY episode) AS all_ FROM ab),
 ad AS (SELECT *, sum(CASE WHEN still AND seen = all_ THEN b - a + 1 ELSE 0 END) OVER (PARTITION BY episode) AS tail FROM ac), ae AS (SELECT *, CASE WHEN still AND seen = all_ AND (tail >= 8 OR all_ = 0) THEN CASE WHEN all_ = 0 THEN 0 ELSE all_ + 1 END ELSE greatest(seen, 1) END AS grp FROM ad),
 af AS (SELECT episode, grp, min(a) AS a, max(b) AS b, coalesce(arg_min(l, i) FILTER (WHERE NOT still), arg_min(l, i)) AS l, coalesce(arg_min(r, i) FILTER (WHERE NOT still), arg_min(r, i)) AS r, count(*) AS pieces FROM ae GROUP BY episode, grp)
 SELECT episode, row_number() OVER (PARTITION BY episode ORDER BY a) - 1 AS segment, a AS start_frame, b AS end_frame, l AS left_action, r AS right_action, CASE WHEN l = 'still' AND r = 'still' THEN 'still' WHEN l = 'still' OR l = r THEN r WHEN r = 'still' THEN l ELSE l || '+' || r END AS label,
   CASE WHEN l = 'still' AND r = 'still' THEN 'both_still' WHEN r = 'still' THEN 'left_only' WHEN l = 'still' THEN 'right_only' WHEN l = r THEN 'dual_same_phase' ELSE 'dual_different_phase' END AS relation, pieces FROM af"""

"""DuckDB forms of the selections over scene graphs: recursive queries over all pairs of shortest ways."""

from __future__ import annotations

from lumenvox.plans import sql

#: Lengths of all shortest ways of each view (view, root, node, d); m has nothing where there is no way.
WAYS = f"""{sql.SCENE}, l2 AS MATERIALIZED (SELECT view, src, dst, w FROM slink UNION ALL SELECT view, vec_id, vec_id, 0 FROM pts),
rr AS (SELECT 0 AS k, view, vec_id AS root, vec_id AS node, 0.0::DOUBLE AS d FROM pts UNION ALL SELECT rr.k + 1, rr.view, rr.root, l2.dst, min(rr.d + l2.w) FROM rr JOIN l2 ON rr.node = l2.src WHERE rr.k < 60 GROUP BY rr.k, rr.view, rr.root, l2.dst),
m AS MATERIALIZED (SELECT view, root, node, d FROM rr WHERE k = 60),
dl AS MATERIALIZED (SELECT view, node, list({{'root': root, 'd': d}}) AS dl FROM m GROUP BY view, node)"""
_DRAW = "('0x' || substr(md5(vec_id::VARCHAR), 1, 12))::BIGINT"


def _reached(picks: str) -> str:
    """Ways to a candidate from the picks that have one."""
    return f"list_transform(list_filter(dl, lambda q: list_contains({picks}, q.root)), lambda q: q.d)"


def spread(name: str, sep: float, clearance: float, count: int = 8) -> str:
    """The relation ``name`` (view, picks): anchors by best candidates under thresholds that adapt; needs ``WAYS`` and ``CANDIDATES``."""
    return f"""{name}f AS (SELECT view, arg_min(id, (draw, id)) AS id FROM cand WHERE clear >= {clearance} GROUP BY view),
{name}r AS (SELECT f.view, 0 AS it, [f.id] AS picks, p.y AS y0, {sep}::DOUBLE AS now, {clearance}::DOUBLE AS room, false AS stop FROM {name}f f JOIN pts p ON p.vec_id = f.id
UNION ALL SELECT view, it + 1, CASE WHEN best IS NULL THEN picks ELSE list_append(picks, best) END, y0, CASE WHEN best IS NULL THEN now * 0.9::DOUBLE ELSE least(now * 1.05::DOUBLE, {sep}::DOUBLE) END,
  CASE WHEN best IS NULL THEN room * 0.9::DOUBLE ELSE least(room * 1.05::DOUBLE, {clearance}::DOUBLE) END,
  best IS NULL AND now * 0.9::DOUBLE < 0.5 * greatest(0.6, {sep}) AND room * 0.9::DOUBLE < 0.6 * greatest(0.1, {clearance}) FROM
  (SELECT view, it, any_value(picks) AS picks, any_value(y0) AS y0, any_value(now) AS now, any_value(room) AS room,
     arg_min(id, (-round(list_min(near) + bonus, 9), draw, id)) FILTER (WHERE abs(y - y0) <= 0.5 AND clear >= room AND len(near) = len(picks) AND list_min(near) >= now) AS best
   FROM (SELECT r.*, c.id, c.y, c.clear, c.draw, c.bonus, {_reached('r.picks')} AS near FROM {name}r r JOIN cand c ON c.view = r.view WHERE NOT r.stop AND len(r.picks) < {count}) GROUP BY view, it)),
{name} AS (SELECT view, arg_max(picks, it) AS picks FROM {name}r GROUP BY view)"""


CANDIDATES = f"""bon AS (SELECT root, 0.3::DOUBLE * max(d) AS bonus FROM m WHERE d >= 0.3 AND d <= 0.6 GROUP BY root),
cand AS MATERIALIZED (SELECT p.view, vec_id AS id, y, abs(z) AS clear, {_DRAW} AS draw, coalesce(bonus, 0) AS bonus, dl FROM pts p JOIN dl ON dl.node = p.vec_id LEFT JOIN bon ON bon.root = p.vec_id)"""

SPREAD = f"""WITH RECURSIVE {WAYS}, {CANDIDATES}, {spread('s', 0.45, 0.02)}
SELECT view, (o - 1)::BIGINT AS ord, picks[o] AS id FROM s, range(1, 9) t(o) WHERE o <= len(picks)"""


def retarget(steps: list[tuple[float, float]], want: int) -> str:
    """The first step at which a view has as many anchors, else the last one."""
    parts = ", ".join(spread(f"s{i}", sep, clear) for i, (sep, clear) in enumerate(steps, 1))
    tried = " UNION ALL ".join(f"SELECT v.view, {i} AS step, {sep}::DOUBLE AS sep, {clear}::DOUBLE AS clearance, coalesce(len(s{i}.picks), 0)::BIGINT AS got FROM (SELECT DISTINCT view FROM pts) v LEFT JOIN s{i} ON s{i}.view = v.view" for i, (sep, clear) in enumerate(steps, 1))
    return f"""WITH RECURSIVE {WAYS}, {CANDIDATES}, {parts}, tried AS ({tried}),
b AS (SELECT view, coalesce(min(step) FILTER (WHERE got >= {want}), max(step)) AS step FROM tried GROUP BY view)
SELECT view, step::INT AS step, {sql.rounded('sep', 'clearance')}, got FROM b JOIN tried USING (view, step)"""


GAPS = f"""WITH RECURSIVE {sql.PATH}, {WAYS[len(sql.PTS) + 1 :].lstrip(', ')},
sg AS (SELECT (path_id + 1) % 10 AS path_id, x AS ax, z AS az, lead(x) OVER w AS bx, lead(z) OVER w AS bz FROM path WINDOW w AS (PARTITION BY path_id ORDER BY seq)),
tt AS (SELECT vec_id, x, z, ax, az, bx, bz, CASE WHEN power(bx-ax,2)+power(bz-az,2) = 0 THEN 0 ELSE least(greatest(((x-ax)*(bx-ax)+(z-az)*(bz-az))/(power(bx-ax,2)+power(bz-az,2)), 0), 1) END AS t FROM pts JOIN sg ON view = path_id AND bx IS NOT NULL),
nr AS (SELECT vec_id FROM tt GROUP BY vec_id HAVING min(sqrt(power(x-ax-t*(bx-ax),2)+power(z-az-t*(bz-az),2))) <= 0.3),
dr AS (SELECT p.vec_id, min(sqrt((p.x-a.x)*(p.x-a.x) + (p.z-a.z)*(p.z-a.z))) AS direct FROM pts p JOIN pts a ON a.view = p.view AND a.vec_id % 25 = 0 GROUP BY p.vec_id),
an AS (SELECT view, list(vec_id) FILTER (WHERE vec_id % 25 = 0) AS anchors FROM pts GROUP BY view),
c AS MATERIALIZED (SELECT p.view, p.vec_id AS id, coalesce(direct, 'inf'::DOUBLE) AS direct, dl FROM pts p JOIN nr ON nr.vec_id = p.vec_id JOIN dl ON dl.node = p.vec_id LEFT JOIN dr ON dr.vec_id = p.vec_id WHERE abs(z) >= 0.02 AND p.vec_id % 25 <> 0),
g AS (SELECT view, j, r, 0 AS n, anchors AS picks, NULL::BIGINT AS id FROM an, (VALUES (0, 0.5::DOUBLE), (1, 0.4), (2, 0.3), (3, 0.25)) f(j, r)
UNION ALL SELECT view, j, r, n + 1, list_append(picks, id), id FROM
  (SELECT g.view, g.j, g.r, g.n, any_value(g.picks) AS picks, arg_min(c.id, (-round(list_min({_reached('g.picks')}), 9), c.id)) FILTER (WHERE list_min({_reached('g.picks')}) >= g.r) AS id
   FROM g JOIN c ON c.view = g.view AND c.direct >= 0.75 * g.r WHERE g.n < 12 GROUP BY g.view, g.j, g.r, g.n) WHERE id IS NOT NULL)
SELECT view, (n - 1)::BIGINT AS ord, id, round(r, 6) + 0.0 AS radius FROM g WHERE n > 0 AND j = (SELECT min(j) FROM g h WHERE h.view = g.view AND h.n > 0)"""

FARTHEST = f"""WITH RECURSIVE {WAYS},
an AS (SELECT view, list(vec_id) AS anchors, min(vec_id) AS root FROM pts WHERE vec_id % 25 = 0 GROUP BY view),
op AS (SELECT p.view, vec_id AS id, row_number() OVER (PARTITION BY p.view ORDER BY {_DRAW}, vec_id) - 1 AS nth, count(*) OVER (PARTITION BY p.view) AS n, dl FROM pts p JOIN dl ON dl.node = p.vec_id JOIN an ON an.view = p.view
       WHERE abs(z) >= 0.02 AND vec_id % 25 <> 0 AND len(list_filter(dl, lambda q: q.root = an.root)) > 0),
bt AS MATERIALIZED (SELECT view, id, dl, CASE WHEN nth < (n % 8) * (n // 8 + 1) THEN nth // (n // 8 + 1) ELSE n % 8 + (nth - (n % 8) * (n // 8 + 1)) // greatest(n // 8, 1) END AS b FROM op),
g AS (SELECT view, 0 AS b, anchors AS picks, 0 AS got, 0.5::DOUBLE AS now, 0 AS stalls, NULL::BIGINT AS id, NULL::DOUBLE AS used FROM an
UNION ALL SELECT view, b + 1, CASE WHEN far >= now THEN list_append(picks, best) ELSE picks END, CASE WHEN far >= now THEN got + 1 ELSE got END,
  CASE WHEN best IS NULL AND stalls % 2 = 1 THEN greatest(0.2::DOUBLE, now * 0.9::DOUBLE) ELSE now END, CASE WHEN best IS NULL THEN stalls + 1 ELSE stalls END, CASE WHEN far >= now THEN best END, now FROM
  (SELECT g.view, g.b, any_value(picks) AS picks, any_value(got) AS got, any_value(now) AS now, any_value(stalls) AS stalls, arg_min(bt.id, (-round(list_min({_reached('g.picks')}), 9), bt.id)) AS best, max(list_min({_reached('g.picks')})) AS far
   FROM g LEFT JOIN bt ON bt.view = g.view AND bt.b = g.b WHERE g.b < 8 AND g.got < 6 GROUP BY g.view, g.b))
SELECT view, (got - 1)::BIGINT AS ord, id, round(used, 6) + 0.0 AS radius FROM g WHERE id IS NOT NULL"""

REPAIR = """, pl AS (SELECT path_id, j * n + (((rk - j) % n) + n) % n AS pos, vi, {yaw} AS yaw, rk, n FROM stp, off),
rg AS MATERIALIZED (SELECT path_id, rk, vi, x, y, z FROM (SELECT DISTINCT path_id, vi, rk FROM stp) s JOIN path p USING (path_id) WHERE p.seq = s.vi),
g AS (SELECT path_id, pos, vi, rk, yaw FROM pl WHERE pos = 0
UNION ALL SELECT path_id, pos, coalesce(vi2, vi), coalesce(rk2, rk), yaw FROM
  (SELECT g.path_id, pl.pos, any_value(pl.vi) AS vi, any_value(pl.rk) AS rk, any_value(pl.yaw) AS yaw,
     arg_min(o.vi, (o.rk - pl.rk + pl.n) % pl.n) FILTER (WHERE sqrt(power(o.x-a.x,2)+power(o.y-a.y,2)+power(o.z-a.z,2)) >= 0.25) AS vi2,
     arg_min(o.rk, (o.rk - pl.rk + pl.n) % pl.n) FILTER (WHERE sqrt(power(o.x-a.x,2)+power(o.y-a.y,2)+power(o.z-a.z,2)) >= 0.25) AS rk2
   FROM g JOIN pl ON pl.path_id = g.path_id AND pl.pos = g.pos + 1 JOIN rg a ON a.path_id = g.path_id AND a.rk = g.rk JOIN rg o ON o.path_id = g.path_id GROUP BY g.path_id, pl.pos))
SELECT path_id, pos, vi, round(yaw, 6) + 0.0 AS yaw FROM g"""


def resampled(src: str, out: str, stride: float) -> str:
    """The relation ``out`` (path_id, seq, x, y, z): ``src`` (the same) with points every ``stride`` and its end."""
    at = ", ".join(f"(1 - (t - (s - step)) / step) * {c}0 + (t - (s - step)) / step * {c} AS {c}" for c in "xyz")
    return f"""{out}0 AS (SELECT *, coalesce(sqrt((x - lag(x) OVER w)*(x - lag(x) OVER w) + (y - lag(y) OVER w)*(y - lag(y) OVER w) + (z - lag(z) OVER w)*(z - lag(z) OVER w)), 0) AS step, lag(x) OVER w AS x0, lag(y) OVER w AS y0, lag(z) OVER w AS z0 FROM {src} WINDOW w AS (PARTITION BY path_id ORDER BY seq)),
{out}1 AS (SELECT *, sum(step) OVER (PARTITION BY path_id ORDER BY seq) AS s FROM {out}0),
{out}t AS (SELECT path_id, max(s) AS total, arg_max(x, seq) AS ex, arg_max(y, seq) AS ey, arg_max(z, seq) AS ez, arg_min(x, seq) AS fx, arg_min(y, seq) AS fy, arg_min(z, seq) AS fz FROM {out}1 GROUP BY path_id),
{out}p AS (SELECT path_id, k, k * {stride}::DOUBLE AS t FROM {out}t, range(0, 100000) r(k) WHERE k * {stride}::DOUBLE < total AND k <= total / {stride}::DOUBLE + 1),
{out}s AS (SELECT p.path_id, k, {at} FROM {out}p p JOIN {out}1 a ON p.path_id = a.path_id AND x0 IS NOT NULL AND step > 0 AND t > s - step AND t <= s WHERE k > 0 UNION ALL SELECT path_id, 0, fx, fy, fz FROM {out}t),
{out}l AS (SELECT path_id, max(k) AS k, arg_max(x, k) AS x, arg_max(y, k) AS y, arg_max(z, k) AS z FROM {out}s GROUP BY path_id),
{out} AS (SELECT path_id, k AS seq, x, y, z FROM {out}s UNION ALL SELECT l.path_id, l.k + 1, ex, ey, ez FROM {out}l l JOIN {out}t t ON l.path_id = t.path_id WHERE total > 0 AND sqrt(power(ex-x,2)+power(ey-y,2)+power(ez-z,2)) > 1e-4)"""


def trajectory(chaikin) -> str:
    """Legs of the tour along shortest ways, resampled leg by leg, densified, cut and resampled; ``chaikin(src, out)`` cuts corners once."""
    dense = ", ".join(f"CASE WHEN k = 0 THEN {c} ELSE (1 - k / (n + 1)) * {c} + k / (n + 1) * {c}1 END AS {c}" for c in "xyz")
    return f"""WITH RECURSIVE {WAYS},
t AS (SELECT view, 0 AS ord, min(vec_id) AS id, [min(vec_id)] AS seen FROM pts WHERE vec_id % 25 = 0 GROUP BY view
UNION ALL SELECT view, ord + 1, id, list_append(seen, id) FROM (SELECT t.view, t.ord, any_value(t.seen) AS seen, arg_min(m.node, (round(m.d, 9), m.node)) AS id
  FROM t JOIN m ON m.root = t.id WHERE m.node % 25 = 0 AND NOT list_contains(t.seen, m.node) GROUP BY t.view, t.ord)),
lg AS (SELECT view, ord AS leg, id AS a, coalesce(lead(id) OVER w, first(id) OVER w) AS b FROM t WINDOW w AS (PARTITION BY view ORDER BY ord)),
wy AS (SELECT view, leg, a, b AS node, 0 AS back FROM lg
UNION ALL SELECT view, leg, a, before, back + 1 FROM (SELECT wy.view, wy.leg, wy.a, wy.back, arg_min(l.src, m.d + l.w) AS before FROM wy JOIN slink l ON l.dst = wy.node JOIN m ON m.root = wy.a AND m.node = l.src WHERE wy.node <> wy.a GROUP BY wy.view, wy.leg, wy.a, wy.back)),
pl AS (SELECT wy.view * 1000 + leg AS path_id, -back AS seq, x, y, z FROM wy JOIN pts ON vec_id = node),
{resampled('pl', 'q', 0.2)},
j AS (SELECT path_id // 1000 AS path_id, row_number() OVER (PARTITION BY path_id // 1000 ORDER BY path_id, seq) - 1 AS seq, x, y, z FROM q),
sg AS (SELECT *, lead(x) OVER w AS x1, lead(y) OVER w AS y1, lead(z) OVER w AS z1 FROM j WINDOW w AS (PARTITION BY path_id ORDER BY seq)),
sn AS (SELECT *, coalesce(floor(sqrt(power(x1-x,2)+power(y1-y,2)+power(z1-z,2)) / 0.2 + 1e-6), 0)::BIGINT AS n FROM sg), sk AS (SELECT *, unnest(range(0, n + 1)) AS k FROM sn),
de AS (SELECT path_id, row_number() OVER (PARTITION BY path_id ORDER BY seq, k) - 1 AS seq, {dense} FROM sk),
{chaikin('de', 'c1')}, {chaikin('c1', 'c2')}, {resampled('c2', 'f', 0.2)}
SELECT path_id, seq, {sql.rounded('x', 'y', 'z')} FROM f"""


EXTRAS_TOUR = f"""{GAPS.rpartition("SELECT view, (n - 1)")[0].rstrip()},
st AS MATERIALIZED (SELECT vec_id AS id FROM pts WHERE vec_id % 25 = 0 UNION SELECT id FROM g WHERE n > 0 AND j = (SELECT min(j) FROM g h WHERE h.view = g.view AND h.n > 0)),
t AS (SELECT view, 0 AS ord, min(vec_id) AS id, [min(vec_id)] AS seen FROM pts WHERE vec_id IN (SELECT id FROM st) GROUP BY view
UNION ALL SELECT view, ord + 1, id, list_append(seen, id) FROM (SELECT t.view, t.ord, any_value(t.seen) AS seen, arg_min(m.node, (round(m.d, 9), m.node)) AS id
  FROM t JOIN m ON m.root = t.id JOIN st ON st.id = m.node WHERE NOT list_contains(t.seen, m.node) GROUP BY t.view, t.ord))
SELECT view, ord::BIGINT AS ord, id FROM t"""

SPAN = f"""WITH RECURSIVE {WAYS},
dw AS (SELECT view, vec_id, row_number() OVER (PARTITION BY view ORDER BY {_DRAW}, vec_id) - 1 AS nth FROM pts QUALIFY nth < 512), nn AS (SELECT view, count(*) AS n FROM dw GROUP BY view),
pr AS (SELECT nn.view, a.vec_id AS src, b.vec_id AS dst FROM nn JOIN range(1024) k(id) ON k.id < 4 * n JOIN dw a ON a.view = nn.view AND a.nth = (k.id * 7919) % n JOIN dw b ON b.view = nn.view AND b.nth = (k.id * 104729 + 3) % n WHERE a.vec_id <> b.vec_id)
SELECT pr.view, round(quantile_cont(m.d, 0.95), 6) AS span, round(avg((m.d IS NOT NULL)::INT), 6) + 0.0 AS connected FROM pr LEFT JOIN m ON m.root = pr.src AND m.node = pr.dst GROUP BY pr.view"""

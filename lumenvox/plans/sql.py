"""DuckDB forms of the derived tables, for the oracle queries."""

from __future__ import annotations

PTS = """pts AS (SELECT vec_id, label AS view, embedding[1]::DOUBLE AS x, embedding[2]::DOUBLE AS y, embedding[3]::DOUBLE AS z,
  least(greatest(round_even((embedding[4]::DOUBLE + 0.5) * 255, 0), 0), 255)::INT AS r,
  least(greatest(round_even((embedding[5]::DOUBLE + 0.5) * 255, 0), 0), 255)::INT AS g,
  least(greatest(round_even((embedding[6]::DOUBLE + 0.5) * 255, 0), 0), 255)::INT AS b FROM embeddings)"""
TILE = """raw AS (SELECT vec_id, label, unnest(embedding)::DOUBLE AS val, (generate_subscripts(embedding, 1) - 1)::INT AS i FROM embeddings),
tile AS (SELECT vec_id, label, i % 8 AS u, (i // 8)::INT AS v, CASE WHEN 1 + 4 * val > 0 THEN 1 + 4 * val END AS depth, val FROM raw)"""
PATH = PTS + """,
path AS (SELECT view AS path_id, row_number() OVER (PARTITION BY view ORDER BY vec_id) - 1 AS seq, vec_id, x, y, z FROM pts)"""
YAW = """head AS (SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS seq,
  (((value * pi() / 50 + pi()) % (2 * pi())) + 2 * pi()) % (2 * pi()) - pi() AS yaw FROM events)"""
ANCHOR = PTS + """,
anchor AS (SELECT vec_id AS anchor_id, x, y, z FROM pts WHERE vec_id % 25 = 0)"""
GRAPH = PTS + """,
link AS (SELECT a.vec_id AS src, b.vec_id AS dst, sqrt((a.x-b.x)*(a.x-b.x) + (a.y-b.y)*(a.y-b.y) + (a.z-b.z)*(a.z-b.z)) AS w
  FROM pts a JOIN pts b ON a.vec_id <> b.vec_id AND sqrt((a.x-b.x)*(a.x-b.x) + (a.y-b.y)*(a.y-b.y) + (a.z-b.z)*(a.z-b.z)) <= 0.1)"""
SCENE = PTS + """,
slink AS MATERIALIZED (SELECT a.view, a.vec_id AS src, b.vec_id AS dst, sqrt((a.x-b.x)*(a.x-b.x) + (a.y-b.y)*(a.y-b.y) + (a.z-b.z)*(a.z-b.z)) AS w
  FROM pts a JOIN pts b ON a.view = b.view AND a.vec_id <> b.vec_id AND sqrt((a.x-b.x)*(a.x-b.x) + (a.y-b.y)*(a.y-b.y) + (a.z-b.z)*(a.z-b.z)) <= 0.25)"""
CELLS = PTS + """,
walk AS (SELECT DISTINCT floor(x / 0.2)::BIGINT AS cx, floor(z / 0.2)::BIGINT AS cz FROM pts)"""
POSE = """p0 AS (SELECT vec_id AS frame, embedding[7]::DOUBLE AS a, embedding[8]::DOUBLE AS b, embedding[9]::DOUBLE AS c, embedding[10]::DOUBLE AS d,
  embedding[1]::DOUBLE AS tx, embedding[2]::DOUBLE AS ty, embedding[3]::DOUBLE AS tz FROM embeddings),
p1 AS (SELECT *, sqrt(a*a + b*b + c*c + d*d) AS n FROM p0),
pose AS (SELECT frame, CASE WHEN n > 0 THEN a/n ELSE 0 END AS q1, CASE WHEN n > 0 THEN b/n ELSE 0 END AS q2, CASE WHEN n > 0 THEN c/n ELSE 0 END AS q3, CASE WHEN n > 0 THEN d/n ELSE 0 END AS q4, tx, ty, tz FROM p1),
rot AS (SELECT *, CASE WHEN q1*q1+q2*q2+q3*q3+q4*q4 = 0 THEN 0 ELSE 2/(q1*q1+q2*q2+q3*q3+q4*q4) END AS s FROM pose),
mat AS (SELECT frame, tx, ty, tz, q1, q2, q3, q4,
  1-s*(q2*q2+q3*q3) AS m00, s*(q1*q2-q4*q3) AS m01, s*(q1*q3+q4*q2) AS m02,
  s*(q1*q2+q4*q3) AS m10, 1-s*(q1*q1+q3*q3) AS m11, s*(q2*q3-q4*q1) AS m12,
  s*(q1*q3-q4*q2) AS m20, s*(q2*q3+q4*q1) AS m21, 1-s*(q1*q1+q2*q2) AS m22 FROM rot)"""


def wrap(x: str) -> str:
    return f"(((({x}) + pi()) % (2 * pi())) + 2 * pi()) % (2 * pi()) - pi()"


def rounded(*names: str, digits: int = 6) -> str:
    return ", ".join(f"round({n}, {digits}) + 0.0 AS {n}" for n in names)


def normal_draw(key: str, name: str) -> str:
    u = [f"(('0x' || substr(md5({key}::VARCHAR || '/{name}'), {at}, 8))::BIGINT + 1) / 4294967297.0::DOUBLE" for at in (1, 9)]
    return f"sqrt(-2 * ln({u[0]})) * cos(2 * pi() * {u[1]})"

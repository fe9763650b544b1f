"""Shortest ways, components and greedy selection over a navigation graph."""

from __future__ import annotations

import functools
import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumenvox.operators.common import settled


def geodesic(links: DataFrame, roots: DataFrame, key: str | None = None, within: float | None = None) -> DataFrame:
    """Length of the shortest way from any root (node) to each node that can be reached: node, d.

    With ``key``, a column of ``roots``, the ways of each key are found apart: key, node, d. Ways longer than
    ``within`` are given up. Bellman-Ford: only nodes whose distance fell in a round pass it on in
    the next. Improvements are appended, and merged with the table of distances every few rounds.
    """
    names = [key, "node"] if key else ["node"]
    best = settled(roots.select(*names, F.lit(0.0).alias("d")).distinct())
    fresh, added, rounds = best, None, 0
    while True:
        offers = fresh.join(links, F.col("node") == F.col("src")).select(*names[:-1], F.col("dst").alias("node"), (F.col("d") + F.col("w")).alias("offer"))
        offers = offers if within is None else offers.filter(F.col("offer") <= within)
        offers = offers.groupBy(*names).agg(F.min("offer").alias("offer"))
        known = best if added is None else best.unionByName(added).groupBy(*names).agg(F.min("d").alias("d"))
        better = offers.join(known, names, "left").filter("d is null or offer < d - 1e-12")
        fresh = settled(better.select(*names, F.col("offer").alias("d")))
        if fresh.isEmpty():
            return settled(known)
        added, rounds = fresh if added is None else added.unionByName(fresh), rounds + 1
        if rounds % 4 == 0:
            best, added = settled(best.unionByName(added).groupBy(*names).agg(F.min("d").alias("d"))), None


def _roots(up: DataFrame) -> DataFrame:
    """``up`` (id, up) with every node led to its root, by doubling."""
    while True:
        above = up.select(F.col("id").alias("_id"), F.col("up").alias("_up"))
        higher = settled(up.join(above, F.col("up") == F.col("_id")).select("id", F.col("up").alias("before"), F.col("_up").alias("up")))
        up = higher.select("id", "up")
        if higher.filter("before <> up").isEmpty():
            return up


#: Links that a task joins at once.
_LINKS_AT_ONCE = 1 << 21


def _stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links (src, dst), a bounded number at a time, as links between each node and the smallest one that it reaches over these, both ways."""

    def star(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        kind, names = held[0].schema.types[0], held[0].schema.names
        src, dst = (np.concatenate([b.column(i).to_numpy(zero_copy_only=False) for b in held]) for i in (0, 1))
        ids, at = np.unique(np.concatenate([src, dst]), return_inverse=True)
        a, b, root = at[: len(src)], at[len(src) :], np.arange(len(ids))
        while ((ra := root[a]) != (rb := root[b])).any():
            np.minimum.at(root, np.maximum(ra, rb), np.minimum(ra, rb))
            while ((up := root[root]) != root).any():
                root = up
        led = np.flatnonzero(root != np.arange(len(ids)))
        below, above = ids[led], ids[root[led]]
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c), kind) for c in ((below, above), (above, below))], names)

    held, n = [], 0
    for b in batches:
        held.append(b)
        n += b.num_rows
        if n >= _LINKS_AT_ONCE:
            yield star(held)
            held, n = [], 0
    if n:
        yield star(held)


def connected(links: DataFrame, nodes: DataFrame) -> DataFrame:
    """node, component: the smallest node that can be reached, for every node of ``nodes``.

    At first each task joins the links that it has, so that what it knows to be connected takes no round.
    Each round every component hooks on to its smallest neighbour and follows the hooks to their
    roots, so only components without a smaller neighbour go on to the next round.
    """
    label = settled(nodes.select("node", F.col("node").alias("component")))
    kind = links.schema["src"].dataType.simpleString()
    open_ = settled(links.select("src", "dst").filter("src <> dst").mapInArrow(_stars, f"src {kind}, dst {kind}").distinct())
    while not open_.isEmpty():
        up = open_.groupBy("src").agg(F.min("dst").alias("dst")).select(F.col("src").alias("id"), F.least("src", "dst").alias("up"))
        up = _roots(settled(up))
        label = settled(label.join(up, F.col("component") == F.col("id"), "left").select("node", F.coalesce("up", "component").alias("component")))
        a, b = up.select(F.col("id").alias("src"), F.col("up").alias("a")), up.select(F.col("id").alias("dst"), F.col("up").alias("b"))
        open_ = settled(open_.join(a, "src").join(b, "dst").filter("a <> b").select(F.col("a").alias("src"), F.col("b").alias("dst")).distinct())
    return label


def farthest_points(candidates: DataFrame, key: str, count: int, least: float = 0.0) -> DataFrame:
    """Greedy farthest-point selection in each group: key, ord, id, d.

    ``candidates`` has key, id, x, y, z. The first pick is the smallest id; each next one is the
    furthest from all picks before, the smallest id on ties, until none is at least ``least`` away
    or ``count`` are picked. One round is one aggregation over all groups; d is null for the first.
    """
    state = settled(candidates.select(key, "id", "x", "y", "z", F.lit(None).cast("double").alias("d")))
    picks = None
    for i in range(count):
        order = F.min(F.struct(F.coalesce(-F.col("d"), F.lit(float("-inf"))), F.col("id"), "x", "y", "z", "d"))
        best = state.groupBy(key).agg(order.alias("p")).filter((F.col("p.d").isNull()) | (F.col("p.d") > least))
        best = settled(best.select(key, F.col("p.id").alias("pid"), *[F.col(f"p.{c}").alias(f"p{c}") for c in "xyz"], F.col("p.d").alias("pd")))
        new = best.select(key, F.lit(i).alias("ord"), F.col("pid").alias("id"), F.col("pd").alias("d"))
        picks = new if picks is None else picks.unionByName(new)
        gap = F.sqrt((F.col("x") - F.col("px")) ** 2 + (F.col("y") - F.col("py")) ** 2 + (F.col("z") - F.col("pz")) ** 2)
        state = settled(state.join(best, key).select(key, "id", "x", "y", "z", F.least(F.coalesce("d", gap), gap).alias("d")))
    return picks


class _Scene:
    """The navigation graph of one scene; ways are found from one point at a time, and kept for the points that are chosen."""

    def __init__(self, points: pd.DataFrame, links: pd.DataFrame) -> None:
        self.ids = np.sort(points["id"].to_numpy())
        src, dst = (np.searchsorted(self.ids, links[c].to_numpy()) for c in ("src", "dst"))
        there = (src < len(self.ids)) & (dst < len(self.ids))
        there[there] &= (self.ids[src[there]] == links["src"].to_numpy()[there]) & (self.ids[dst[there]] == links["dst"].to_numpy()[there])
        order = np.argsort(src[there], kind="stable")
        self.to, self.w = dst[there][order].tolist(), links["w"].to_numpy()[there][order].tolist()
        self.start = np.searchsorted(src[there][order], np.arange(len(self.ids) + 1)).tolist()
        self.known: dict[int, tuple[np.ndarray, list[int]]] = {}

    def ways(self, i: int) -> np.ndarray:
        """Length of the shortest way from the ``i``-th point to each; infinite where there is none."""
        return self._from(i)[0]

    def way(self, i: int, j: int) -> list[int]:
        """The points of the shortest way, both ends included; the ends alone where there is none."""
        d, before = self._from(i)
        if not np.isfinite(d[j]):
            return [i, j]
        found = [j]
        while found[-1] != i:
            found.append(before[found[-1]])
        return found[::-1]

    def sees(self, i: int, near: float, far: float) -> float:
        """The longest of the shortest ways from the ``i``-th point that are between ``near`` and ``far``, 0 without one; nothing beyond ``far`` is looked at."""
        d, done, open_, longest = {i: 0.0}, set(), [(0.0, i)], 0.0
        while open_:
            way, at = heapq.heappop(open_)
            if at in done:
                continue
            done.add(at)
            longest = way if way >= near else longest
            for e in range(self.start[at], self.start[at + 1]):
                if (new := way + self.w[e]) <= far and new < d.get(self.to[e], float("inf")):
                    d[self.to[e]] = new
                    heapq.heappush(open_, (new, self.to[e]))
        return longest

    def nearest_of(self, starts: np.ndarray) -> np.ndarray:
        """Length of the shortest way to each point from any of ``starts``; infinite without one."""
        return np.min([self.ways(int(i)) for i in starts], axis=0) if len(starts) else np.full(len(self.ids), np.inf)

    def lengths(self, i: int, ends: np.ndarray) -> np.ndarray:
        """Lengths of the shortest ways from the ``i``-th point to ``ends``; they are not kept."""
        found = self.ways(i)[ends]
        self.known.clear()
        return found

    def closest(self, i: int, left: list[int]) -> int | None:
        """The one of ``left`` with the shortest way, to nine digits, the first on ties; None where there is no way."""
        d = self.ways(i)
        best = min(left, key=lambda j: (round(float(d[j]), 9), j))
        return best if np.isfinite(d[best]) else None

    def _from(self, i: int) -> tuple[np.ndarray, list[int]]:
        if i not in self.known:
            d, before, open_ = [float("inf")] * len(self.ids), [-1] * len(self.ids), [(0.0, i)]
            d[i] = 0.0
            while open_:
                far, at = heapq.heappop(open_)
                if far > d[at]:
                    continue
                for e in range(self.start[at], self.start[at + 1]):
                    if (new := far + self.w[e]) < d[self.to[e]]:
                        d[self.to[e]], before[self.to[e]] = new, at
                        heapq.heappush(open_, (new, self.to[e]))
            self.known[i] = np.array(d), before
        return self.known[i]


class _Grid:
    """Points (numbers, positions, cells) in order of cells, to look around in."""

    def __init__(self, ids: np.ndarray, at: np.ndarray, cells: np.ndarray) -> None:
        self.ids, self.at, self.cells = ids, at, cells
        x, y, self.z = cells
        starts = np.flatnonzero(np.r_[True, (x[1:] != x[:-1]) | (y[1:] != y[:-1])][: len(x)])
        self.columns = dict(zip(zip(x[starts].tolist(), y[starts].tolist(), strict=True), zip(starts.tolist(), [*starts[1:].tolist(), len(x)], strict=len(x) > 0), strict=True))
        self.spans = functools.lru_cache(1 << 12)(self._spans)

    def _spans(self, x: int, y: int, z: int) -> list[slice]:
        """Where the points of a cell and its neighbours are."""
        found = []
        for column in ((x + i, y + j) for i in (-1, 0, 1) for j in (-1, 0, 1)):
            if column in self.columns:
                a, b = self.columns[column]
                lo, hi = np.searchsorted(self.z[a:b], (z - 1, z + 2))
                if lo < hi:
                    found.append(slice(a + int(lo), a + int(hi)))
        return found

    def near(self, cell: list[int], at: np.ndarray, reach: float) -> tuple[np.ndarray, np.ndarray]:
        """The points within ``reach`` of a position, and how far away they are."""
        spans = self.spans(*cell)
        if not spans:
            return np.zeros(0, int), np.zeros(0)
        gap = np.concatenate([self.at[:, s] for s in spans], axis=1) - at[:, None]
        gap *= gap
        d = np.sqrt(gap[0] + gap[1] + gap[2])
        hit = np.flatnonzero(d <= reach)
        return np.concatenate([self.ids[s] for s in spans])[hit], d[hit]

    def only(self, kept: np.ndarray) -> _Grid:
        """Those points for whose number ``kept`` is true."""
        here = np.flatnonzero(kept[self.ids])
        return _Grid(self.ids[here], np.ascontiguousarray(self.at[:, here]), self.cells[:, here])


class _Cloud:
    """The graph of one scene whose points (id, x, y, z) are linked where they are within ``reach``, with what ``_Scene`` tells.

    Links are looked for around a point when it is passed, over cells of that width, and never kept, so memory grows with the points.
    A way between points within reach is the straight one; a single way is looked for along the straight line first.
    """

    def __init__(self, points: pd.DataFrame, reach: float) -> None:
        self.ids, self.reach = points["id"].to_numpy(), reach
        self.at = np.ascontiguousarray(points[["x", "y", "z"]].to_numpy(float, na_value=np.nan).T)
        cells = np.floor(np.where(np.isfinite(self.at), self.at, 0.0) / (reach * (1 + 1e-9))).astype(np.int64)
        order = np.lexsort(cells[::-1])
        self.grid, self.cell = _Grid(order, np.ascontiguousarray(self.at[:, order]), cells[:, order]), cells.T.tolist()
        self.known: dict[int, np.ndarray] = {}
        self.labels: np.ndarray | None = None

    def straight(self, i: int, ends: np.ndarray) -> np.ndarray:
        gap = self.at[:, ends] - self.at[:, i, None]
        gap *= gap
        return np.sqrt(gap[0] + gap[1] + gap[2])

    def near(self, i: int, grid: _Grid | None = None) -> tuple[np.ndarray, np.ndarray]:
        """The points (of ``grid``) within reach of the ``i``-th, itself too, and how far away they are."""
        return (grid or self.grid).near(self.cell[i], self.at[:, i], self.reach)

    def _dijkstra(self, starts: np.ndarray, within: float = np.inf) -> np.ndarray:
        """Lengths of the shortest ways from any of ``starts`` to each point, infinite beyond ``within``. Points whose length is final are no longer looked at."""
        d = np.full(len(self.ids), np.inf)
        d[starts] = 0.0
        for i in starts.tolist():
            to, w = self.near(i)
            d[to] = np.minimum(d[to], w)  # straight, and no way is shorter
        d[d > within] = np.inf
        left = np.isinf(d)
        known = np.flatnonzero(~left)
        open_ = list(zip(d[known].tolist(), known.tolist(), strict=True))
        heapq.heapify(open_)
        grid, done = self.grid.only(left), 0
        while open_ and len(grid.ids):
            far, at = heapq.heappop(open_)
            if far > d[at]:
                continue
            if left[at]:
                left[at], done = False, done + 1
                if done > len(grid.ids) // 4:
                    grid, done = grid.only(left), 0
            to, new = self.near(at, grid)
            new = new + far
            better = np.flatnonzero((new < d[to]) & (new <= within))
            to, new = to[better], new[better]
            d[to] = new
            for offer in zip(new.tolist(), to.tolist(), strict=True):
                heapq.heappush(open_, offer)
        return d

    def ways(self, i: int) -> np.ndarray:
        if i not in self.known:
            self.known[i] = self._dijkstra(np.array([i]))
        return self.known[i]

    def nearest_of(self, starts: np.ndarray) -> np.ndarray:
        return self._dijkstra(np.asarray(starts, dtype=int))

    def sees(self, i: int, near: float, far: float) -> float:
        d = self._dijkstra(np.array([i]), far)
        return float(np.max(d, initial=0.0, where=(d >= near) & (d <= far)))

    def island(self) -> np.ndarray:
        """A number for each point, equal for points that a way joins."""
        if self.labels is None:
            self.labels, grid, done = np.full(len(self.ids), -1), self.grid, 0
            for i in range(len(self.ids)):
                if self.labels[i] < 0:
                    self.labels[i], open_, done = i, [i], done + 1
                    while open_:
                        to = self.near(open_.pop(), grid)[0]
                        to = to[self.labels[to] < 0]
                        self.labels[to], done = i, done + len(to)
                        open_.extend(to.tolist())
                        if done > len(grid.ids) // 4:
                            grid, done = grid.only(self.labels < 0), 0
        return self.labels

    def few(self, i: int, most: int = 1000) -> np.ndarray | None:
        """The points that a way joins with the ``i``-th, None where they are more than ``most``."""
        seen, open_ = {i}, [i]
        while open_ and len(seen) <= most:
            new = set(self.near(open_.pop())[0].tolist()) - seen
            seen |= new
            open_.extend(new)
        return np.array(sorted(seen)) if len(seen) <= most else None

    def bounds(self, i: int, ends: np.ndarray, within: float) -> np.ndarray:
        """Lengths that the shortest ways from the ``i``-th point to ``ends`` don't exceed, or infinite: those over one point of each quarter of a cell's width."""
        fine = np.floor(np.where(np.isfinite(self.at), self.at, 0.0) / (self.reach / 4)).astype(np.int64)
        order = np.lexsort(fine[::-1])
        first = np.r_[True, (np.diff(fine[:, order], axis=1) != 0).any(axis=0)]
        net = np.union1d(order[first], [i])
        sparse = _Cloud(pd.DataFrame({"id": net, **dict(zip("xyz", self.at[:, net], strict=True))}), self.reach)
        known = sparse._dijkstra(np.searchsorted(net, [i]), within)
        found = np.full(len(ends), np.inf)
        for n, j in enumerate(ends.tolist()):
            to, w = sparse.grid.near(self.cell[j], self.at[:, j], self.reach)
            found[n] = np.min(known[to] + w, initial=np.inf)
        return found

    def _guess(self, i: int, j: int, within: float) -> float:
        """The length of some way, found by long steps along the straight line; infinite without one."""
        way = 0.0
        while (gap := float(self.straight(i, np.array([j]))[0])) > self.reach:
            to, w = self.near(i)
            ahead = self.straight(j, to)
            fits = np.flatnonzero((w > self.reach / 2) & (ahead < gap))
            if not len(fits):
                return np.inf
            best = fits[(w[fits] + ahead[fits]).argmin()]
            way, i = way + float(w[best]), int(to[best])
            if way > within:
                return np.inf
        return way + gap if gap <= self.reach else np.inf

    def _search(self, i: int, j: int, within: float = np.inf) -> tuple[float, np.ndarray]:
        """Length of the shortest way, and of each point that was met the one before it; infinite where it is longer than ``within``. A*."""
        most = min(within, self._guess(i, j, within)) * (1 + 1e-12)
        d, before, done = np.full(len(self.ids), np.inf), np.full(len(self.ids), -1), bytearray(len(self.ids))
        d[i], open_ = 0.0, [(0.0, i)]
        while open_:
            at = heapq.heappop(open_)[1]
            if at == j:
                break
            if done[at]:
                continue
            done[at] = 1
            to, new = self.near(at)
            new = new + d[at]
            better = np.flatnonzero(new < np.minimum(d[to], d[j]))
            to, new = to[better], new[better]
            total = new + self.straight(j, to)
            fits = np.flatnonzero(total <= min(most, d[j]))
            to, new = to[fits], new[fits]
            d[to], before[to] = new, at
            for offer in zip(total[fits].tolist(), to.tolist(), strict=True):
                heapq.heappush(open_, offer)
        return (float(d[j]) if d[j] <= within else np.inf), before

    def length(self, i: int, j: int, within: float = np.inf) -> float:
        gap = float(self.straight(i, np.array([j]))[0])
        if i == j or gap <= self.reach:
            return 0.0 if i == j else gap if gap <= within else np.inf
        return self._search(i, j, within)[0] if gap <= within else np.inf

    def lengths(self, i: int, ends: np.ndarray) -> np.ndarray:
        island = self.island()
        return np.array([self.length(i, int(j)) if island[i] == island[j] else np.inf for j in ends])

    def way(self, i: int, j: int) -> list[int]:
        if i == j or self.straight(i, np.array([j]))[0] <= self.reach:
            return [i, j]
        d, before = self._search(i, j)
        found = [j] if np.isfinite(d) else [j, i]
        while found[-1] != i:
            found.append(int(before[found[-1]]))
        return found[::-1]

    def closest(self, i: int, left: list[int]) -> int | None:
        ends = np.array(left)
        gaps = self.straight(i, ends)
        if gaps.min() > self.reach:  # else there is a straight way
            joined = self.island()[ends] == self.island()[i]
            ends, gaps = ends[joined], gaps[joined]
        best: tuple[float, int] | None = None
        for k in np.lexsort((ends, gaps)):
            if best is not None and round(float(gaps[k]), 9) > best[0]:
                break
            d = self.length(i, int(ends[k]), np.inf if best is None else best[0] + 1e-9)
            if np.isfinite(d) and (best is None or (round(d, 9), int(ends[k])) < best):
                best = round(d, 9), int(ends[k])
        return None if best is None else best[1]


def _by_scene(points: DataFrame, links: DataFrame | float, key: str, names: list[str], work, columns: str) -> DataFrame:
    """``work(points in order of id, graph)`` for each scene; a scene's points are one group, with its links or, where these are a reach, with positions."""

    def run(g: pd.DataFrame, graph: pd.DataFrame | float) -> pd.DataFrame:
        if g.empty:
            return pd.DataFrame(columns=[key, *[c.split()[0] for c in columns.split(", ")]])
        g = g.sort_values("id").reset_index(drop=True)
        found = work(g, _Scene(g, graph) if isinstance(graph, pd.DataFrame) else _Cloud(g, graph))
        return pd.DataFrame({key: [g[key].iloc[0]] * len(next(iter(found.values()))), **found})

    schema = f"{key} {points.schema[key].dataType.simpleString()}, {columns}"
    if isinstance(links, DataFrame):
        return points.select(key, "id", *names).groupBy(key).cogroup(links.select(key, "src", "dst", "w").groupBy(key)).applyInPandas(lambda g, l: run(g, l), schema)
    places = [F.col(c).cast("double").alias(c) for c in "xyz" if c not in names]
    # a number of partitions that is given is not lowered, so that scenes, small as tables, don't wait for each other in one task
    dealt = points.select(key, "id", *names, *places).repartition(int(points.sparkSession.conf.get("spark.sql.shuffle.partitions")), key)
    return dealt.groupBy(key).applyInPandas(lambda g: run(g, links), schema)


def _toured(scene: _Scene | _Cloud, stops: list[int]) -> list[int]:
    """``stops`` in the order of a greedy tour from the first one; those that cannot be reached are left out."""
    order, left = stops[:1], stops[1:]
    while left and (best := scene.closest(order[-1], left)) is not None:
        order.append(best)
        left.remove(best)
    return order


def greedy_tour(points: DataFrame, links: DataFrame | float, key: str) -> DataFrame:
    """A way through the stops of each scene that always goes on to the nearest one left: key, ord, id.

    ``points`` has key, id and stop (true for the stops), ``links`` key, src, dst, w. Distances are lengths of shortest
    ways. Starts at the smallest id; the smallest id wins ties; stops without a way are left out.
    """

    def work(g: pd.DataFrame, scene: _Scene | _Cloud) -> dict:
        order = _toured(scene, np.flatnonzero(g["stop"].to_numpy()).tolist())
        return {"ord": np.arange(len(order)), "id": scene.ids[order]}

    return _by_scene(points, links, key, ["stop"], work, "ord long, id long")


def tour_path(points: DataFrame, links: DataFrame | float, key: str, closed: bool = True) -> DataFrame:
    """The points of the shortest ways from stop to stop of the greedy tour: key, leg, seq, id; closed back to the first stop.

    A leg has both its stops, and ``seq`` begins anew in each; a tour of one stop is one leg of one point.
    """

    def work(g: pd.DataFrame, scene: _Scene | _Cloud) -> dict:
        order = _toured(scene, np.flatnonzero(g["stop"].to_numpy()).tolist())
        ends = [*order, order[0]] if closed and len(order) > 1 else order
        ways = [scene.way(a, b) for a, b in zip(ends, ends[1:], strict=False)] or [ends]
        leg = np.repeat(np.arange(len(ways)), [len(w) for w in ways])
        return {"leg": leg, "seq": np.concatenate([np.arange(len(w)) for w in ways]), "id": scene.ids[np.concatenate(ways).astype(int)]}

    return _by_scene(points, links, key, ["stop"], work, "leg long, seq long, id long")


# How thresholds adapt in the selection of anchors, and where it ends.
_GROW, _SHRINK, _END_SEP, _END_ROOM, _LEAST_SEP, _LEAST_ROOM = 1.05, 0.9, 0.5, 0.6, 0.6, 0.1


def spread_anchors(candidates: DataFrame, links: DataFrame | float, key: str, count: int, sep: float, *, clearance: float = 0.0, most_dy: float = 0.5, vantage: float = 0.0, near: float = 3.0, far: float = 10.0) -> DataFrame:
    """Anchors of each scene by best-candidate sampling with thresholds that adapt: key, ord, id.

    ``candidates`` has key, id, y, clear and draw (a fixed random order in place of a random generator),
    ``links`` key, src, dst, w. The first draw with enough clearance (null passes) is the first anchor.
    Ways are kept from anchors only, and what a candidate sees is looked for within ``far``, so memory grows with points times ``count``. Each round takes, among the candidates with enough clearance, within ``most_dy`` of the first anchor's
    height and at least the separation away from all anchors by the shortest way, the one with the
    highest score: its distance from the anchors and ``vantage`` times the longest way between ``near`` and ``far``
    that it sees. Candidates without a way to an anchor are refused. After a success both thresholds grow
    by 1.05 up to their start, after a failure they shrink by 0.9, and when both are small the search ends.
    """

    def work(g: pd.DataFrame, scene: _Scene | _Cloud) -> dict:
        clear, y = g["clear"].fillna(np.inf).to_numpy(), g["y"].to_numpy()
        order = np.lexsort((g["id"].to_numpy(), g["draw"].to_numpy()))
        first = [i for i in order if clear[i] >= clearance]
        if not first:
            return {"ord": [], "id": []}
        picks, now, room = [int(first[0])], sep, clearance
        nearest, farthest = scene.ways(picks[0]).copy(), scene.ways(picks[0]).copy()
        level = np.abs(y - y[picks[0]]) <= most_dy
        place = np.empty(len(g), np.int64)
        place[order] = np.arange(len(g))
        bonus: dict[int, float] = {}

        def score(i: int) -> float:
            if vantage > 0 and i not in bonus:
                bonus[i] = vantage * scene.sees(i, near, far)
            return round(nearest[i] + bonus.get(i, 0.0), 9)

        while len(picks) < count:
            fits = np.flatnonzero(level & (clear >= room) & np.isfinite(farthest) & (nearest >= now))
            if len(fits):
                # furthest first, so that most need not be asked what they see: it adds ``vantage * far`` at most
                top, best = -1.0, -1
                for i in fits[np.lexsort((place[fits], -nearest[fits]))]:
                    if round(nearest[i] + max(vantage, 0.0) * far, 9) < top:
                        break
                    if (new := score(int(i))) > top or (new == top and place[i] < place[best]):
                        top, best = new, int(i)
                picks.append(best)
                nearest, farthest = np.minimum(nearest, scene.ways(best)), np.maximum(farthest, scene.ways(best))
                now, room = min(now * _GROW, sep), min(room * _GROW, clearance)
                continue
            now, room = now * _SHRINK, room * _SHRINK
            if now < _END_SEP * max(_LEAST_SEP, sep) and room < _END_ROOM * max(_LEAST_ROOM, clearance):
                break
        return {"ord": np.arange(len(picks)), "id": scene.ids[picks]}

    return _by_scene(candidates, links, key, ["y", "clear", "draw"], work, "ord long, id long")


def _filled(scene: _Scene | _Cloud, open_: np.ndarray, anchors: np.ndarray, radius: float, most: int) -> list[int]:
    """Open points furthest from all anchors first, while one is at least ``radius`` away by a way that exists."""
    nearest = np.where(open_, scene.nearest_of(anchors), -1.0)
    picks: list[int] = []
    while len(picks) < most:
        fits = np.flatnonzero(np.isfinite(nearest) & (nearest >= radius))
        if not len(fits):
            break
        picks.append(int(fits[np.round(nearest[fits], 9).argmax()]))
        nearest = np.minimum(nearest, scene.ways(picks[-1]))
    return picks


def gap_anchors(candidates: DataFrame, links: DataFrame | float, key: str, radius: float, factors: tuple[float, ...] = (1.0, 0.8, 0.6, 0.5), floor: float = 0.4, most: int = 12, gate: float = 0.75) -> DataFrame:
    """Extra anchors where none is near: key, ord, id, radius, for the first radius of ``factors`` that gives any.

    ``candidates`` has key, id, anchor (true for anchors), fits (near the path and with enough clearance) and
    direct (straight distance in the plane to the nearest anchor, null without one), ``links`` key, src, dst, w. Points
    with less than ``gate`` of the radius in between are left out before ways are looked for; the others are
    picked furthest first by the shortest way, and those without a way to an anchor never.
    """

    def work(g: pd.DataFrame, scene: _Scene | _Cloud) -> dict:
        anchors = np.flatnonzero(g["anchor"].to_numpy())
        direct = g["direct"].fillna(np.inf).to_numpy()
        for f in factors:
            r = max(floor, radius * f)
            picks = _filled(scene, g["fits"].to_numpy() & ~g["anchor"].to_numpy() & (direct >= gate * r), anchors, r, most)
            if picks:
                return {"ord": np.arange(len(picks)), "id": scene.ids[picks], "radius": [r] * len(picks)}
        return {"ord": [], "id": [], "radius": []}

    return _by_scene(candidates, links, key, ["anchor", "fits", "direct"], work, "ord long, id long, radius double")


def farthest_anchors(candidates: DataFrame, links: DataFrame | float, key: str, radius: float, batches: int, most: int, floor: float = 0.4) -> DataFrame:
    """Extra anchors on the anchors' islands, furthest first: key, ord, id, radius.

    ``candidates`` has key, id, anchor, fits and draw, ``links`` key, src, dst, w. Points that a way joins with the first
    anchor are dealt to ``batches`` by draw; a batch gives its point furthest from all anchors, if it is the radius
    away. Every second batch without a point relaxes the radius by 0.9, not below ``floor``; one whose points are too near does not.
    """

    def work(g: pd.DataFrame, scene: _Scene | _Cloud) -> dict:
        anchors = np.flatnonzero(g["anchor"].to_numpy())
        if not len(anchors):
            return {"ord": [], "id": [], "radius": []}
        open_ = g["fits"].to_numpy() & ~g["anchor"].to_numpy() & np.isfinite(scene.ways(int(anchors[0])))
        order = np.lexsort((g["id"].to_numpy(), g["draw"].to_numpy()))
        nearest = scene.nearest_of(anchors)
        picks, used, now, stalls = [], [], radius, 0
        for batch in np.array_split(order[open_[order]], batches):
            if len(picks) >= most:
                break
            best = max(batch, key=lambda i: (round(nearest[i], 9), -i), default=None)
            if best is None:
                stalls += 1
                now = max(floor, now * _SHRINK) if stalls % 2 == 0 else now
            elif nearest[best] >= now:
                picks.append(int(best))
                used.append(now)
                nearest = np.minimum(nearest, scene.ways(int(best)))
        return {"ord": np.arange(len(picks)), "id": scene.ids[picks] if picks else [], "radius": used}

    return _by_scene(candidates, links, key, ["anchor", "fits", "draw"], work, "ord long, id long, radius double")


def pair_ways(candidates: DataFrame, links: DataFrame | float, key: str, most_points: int = 512, budget: int = 1024) -> DataFrame:
    """Lengths of the shortest ways between pairs of drawn points of each scene: key, pair, src, dst, d; d is null where there is no way.

    ``candidates`` has key, id and draw. The first ``most_points`` by draw are paired by fixed strides, ``budget`` pairs and four for each
    point at most; a point is not paired with itself. Ways are found from one source after the other and not kept.
    """

    def work(g: pd.DataFrame, scene: _Scene | _Cloud) -> dict:
        drawn = np.lexsort((g["id"].to_numpy(), g["draw"].to_numpy()))[:most_points]
        n = len(drawn)
        k = np.arange(min(budget, 4 * n))
        a, b = drawn[k * 7919 % n], drawn[(k * 104729 + 3) % n]
        k, a, b = k[a != b], a[a != b], b[a != b]
        d = np.full(len(k), np.nan)
        for i in np.unique(a):
            d[a == i] = scene.lengths(int(i), b[a == i])
        return {"pair": k, "src": scene.ids[a], "dst": scene.ids[b], "d": [float(x) if np.isfinite(x) else None for x in d]}

    return _by_scene(candidates, links, key, ["draw"], work, "pair long, src long, dst long, d double")


def _around(g: pd.DataFrame, scene: _Cloud, far: float) -> tuple[int, np.ndarray]:
    """The ``first`` point of a scene, and its own points that may be within ``far`` of it."""
    own, root = np.flatnonzero(g["own"].to_numpy()), int(np.flatnonzero(scene.ids == g["first"].iloc[0])[0])
    ends = own[scene.straight(root, own) <= far]
    few = scene.few(root)
    return root, ends if few is None else np.intersect1d(ends, few)


def first_target(points: DataFrame, reach: float, key: str, near: float, far: float) -> DataFrame:
    """Of the own points of each key the first by draw whose shortest way from its ``first`` point is between ``near``, to nine digits, and ``far`` long: key, id, d.

    ``points`` has key, id, x, y, z, first (an id that is there), own and draw: the points that ways within ``far`` may use, own ones or not, linked where they are within ``reach``.
    Ways are looked for one after the other, by A*, until one fits.
    """

    def work(g: pd.DataFrame, scene: _Cloud) -> dict:
        root, ends = _around(g, scene, far)
        for i in ends[np.lexsort((scene.ids[ends], g["draw"].to_numpy()[ends]))]:
            d = scene.length(int(i), root, far)
            if np.isfinite(d) and round(d, 9) >= near:
                return {"id": [scene.ids[i]], "d": [d]}
        return {"id": [], "d": []}

    return _by_scene(points, reach, key, ["first", "own", "draw"], work, "id long, d double")


def furthest_way(points: DataFrame, reach: float, key: str, near: float, far: float) -> DataFrame:
    """The longest of the shortest ways from each key's ``first`` point to its own ones that are between ``near``, to nine digits, and ``far`` long, 0 without one: key, d.

    ``points`` is that of ``first_target``. Lengths that ways don't exceed are found over a sparse part of the points; only
    where they leave it open whether a way is longer than the longest so far it is looked for, by A*.
    """

    def work(g: pd.DataFrame, scene: _Cloud) -> dict:
        root, ends = _around(g, scene, far)
        most, best = np.minimum(scene.bounds(root, ends, far) * (1 + 1e-12), far), 0.0
        for k in np.lexsort((-scene.straight(root, ends), -most)):
            if most[k] <= best:
                break
            d = scene.length(int(ends[k]), root, far)
            if np.isfinite(d) and round(d, 9) >= near:
                best = max(best, d)
        return {"d": [best]}

    return _by_scene(points, reach, key, ["first", "own"], work, "d double")

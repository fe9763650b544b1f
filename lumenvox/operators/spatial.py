"""Distances and nearest neighbours. Pairs are found over grid cells in equi joins, never by a cross join."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumenvox.functions.angles import wrap
from lumenvox.operators.common import settled


def distance(a: list[Column], b: list[Column]) -> Column:
    return F.sqrt(sum(((x - y) ** 2 for x, y in zip(a[1:], b[1:], strict=True)), (a[0] - b[0]) ** 2))


def around(df: DataFrame, axes: list[str], size: float) -> DataFrame:
    """Each row once for its own and each neighbouring cell."""
    step = F.array(*[F.lit(i).cast("long") for i in (-1, 0, 1)])
    df = df.withColumns({f"_c{c}": F.floor(F.col(c) / size).cast("long") for c in axes})
    for c in axes:
        df = df.withColumn("_d", F.explode(step)).withColumn(f"_c{c}", F.col(f"_c{c}") + F.col("_d")).drop("_d")
    return df


#: Rows of a table of cells that are broadcast at most; one is less than 300 bytes.
FEW_CELLS = 50_000
#: Levels of cells at most: below, doubles hardly tell positions apart.
DEEPEST = 50
#: Levels of cells that are passed in one job.
LEVELS_AT_ONCE = 5
#: Cells that every query may meet at first.
FIRST_CELLS = 64


def _few(df: DataFrame, n: int) -> DataFrame:
    return F.broadcast(df) if n <= FEW_CELLS else df


def _placed(df: DataFrame, key: str, name: str, axes: list[str], on: str | None) -> DataFrame:
    """``key`` as ``name``, the group _g and the position _p0, _p1, ...; only rows with a finite position and a group."""
    places = [F.col(c).cast("double").alias(f"_p{i}") for i, c in enumerate(axes)]
    df = df.select(F.col(key).alias(name), (F.col(on) if on else F.lit(0)).alias("_g"), *places)
    for i in range(len(axes)):
        df = df.filter(F.col(f"_p{i}") - F.col(f"_p{i}") == 0)
    return df.filter("_g is not null")


def _cell_tree(t: DataFrame, dims: int, crowd: int) -> tuple[list[tuple[int, DataFrame, int]], DataFrame | None, int]:
    """Cells of the targets ``t`` (_t, _g, _p..), halved where more than ``crowd`` lie: levels, each with its cells and how many they are at most, what the leaves hold, and the number of targets.

    The first level that is counted is the one at which evenly dealt targets would fill no cell; those above it are sums of it, up to one that every query may meet. Below,
    only the targets of crowded cells are dealt again, at the next level that parts any of them. A cell has its tight box (_lo.., _hi..), one of its
    targets' positions (rep) and whether it is a leaf.
    """
    ps, cs = [f"_p{i}" for i in range(dims)], [f"_c{i}" for i in range(dims)]
    keys = ["_g", *cs]
    box = t.agg(F.count("*").alias("n"), *[f(p).alias(f"{k}{p}") for p in ps for f, k in ((F.min, "lo"), (F.max, "hi"))]).first()
    if not box["n"]:
        return [], None, 0
    span = max(box[f"hi{p}"] - box[f"lo{p}"] for p in ps) or 1.0
    start = 0
    while box["n"] > crowd << (dims * start):
        start += 1

    def cells(level: int) -> dict[str, Column]:
        return {c: F.least(F.floor((F.col(p) - box[f"lo{p}"]) / span * float(1 << level)).cast("long"), F.lit((1 << level) - 1).cast("long")) for c, p in zip(cs, ps, strict=True)}

    bounds = [f"_lo{i}" for i in range(dims)], [f"_hi{i}" for i in range(dims)]
    extent = F.array_max(F.array(*[F.col(b) - F.col(a) for a, b in zip(*bounds, strict=True)]))
    level, here, held, levels = start, t.withColumns(cells(start)), None, {}
    while True:
        counted = here.groupBy(*keys).agg(
            F.count("*").alias("n"), *[F.min(p).alias(b) for p, b in zip(ps, bounds[0], strict=True)], *[F.max(p).alias(b) for p, b in zip(ps, bounds[1], strict=True)], F.min(F.struct(*ps)).alias("rep")
        )
        nodes = settled(counted.withColumn("leaf", (F.col("n") <= crowd) | F.lit(level >= DEEPEST)))
        sizes = nodes.agg(F.count("*").alias("all"), F.count_if("leaf").alias("leaves"), F.max(F.when(~F.col("leaf"), extent)).alias("extent")).first()
        levels[level] = nodes, sizes["all"]
        mine = here.join(_few(nodes.filter("leaf").select(*keys), sizes["leaves"]), keys)
        mine = mine.groupBy(*keys).agg(F.collect_list(F.struct(*ps, "_t")).alias("held")).withColumn("level", F.lit(level))  # at most ``crowd``
        held = mine if held is None else held.unionByName(mine)
        crowded = sizes["all"] - sizes["leaves"]
        if not crowded:
            break
        level = min(DEEPEST, max(level + 1, int(math.log2(span / sizes["extent"]))))  # a crowded cell is still cut in two along an axis at most
        here = settled(here.join(_few(nodes.filter(~F.col("leaf")).select(*keys), crowded), keys, "left_semi").withColumns(cells(level)))
    for above in range(start - 1, -1, -1):
        if levels[above + 1][1] <= FIRST_CELLS:
            break  # no leaf is above this level
        below = levels[above + 1][0].withColumns({c: F.shiftright(c, 1) for c in cs}).groupBy(*keys)
        nodes = below.agg(F.sum("n").alias("n"), *[F.min(b).alias(b) for b in bounds[0]], *[F.max(b).alias(b) for b in bounds[1]], F.min("rep").alias("rep")).withColumn("leaf", F.lit(False))
        most = levels[above + 1][1]  # no more than the level below has
        levels[above] = (nodes if most <= FEW_CELLS else settled(nodes)), most
    return [(i, *levels[i]) for i in sorted(levels)], settled(held), box["n"]


def _apart(a: list[Column], b: list[Column]) -> Column:
    return F.sqrt(sum(((x - y) * (x - y) for x, y in zip(a[1:], b[1:], strict=True)), (a[0] - b[0]) * (a[0] - b[0])))


def _descended(waiting: DataFrame, levels: list[tuple[int, DataFrame, int]], dims: int, nearest_only: bool) -> DataFrame:
    """``waiting`` (_q, _g, _p.., most: how far away a target is at most) with the leaves of its group within that: open.

    On each level a query meets the cells below those that are open, and learns from one target of each how far away one is at most. It
    keeps those whose box is not further away, or, with ``nearest_only``, just the one whose box is nearest.
    """
    ps, cs = [f"_p{i}" for i in range(dims)], [f"_c{i}" for i in range(dims)]
    who, at = ["_q", "_g", *ps], [F.col(p) for p in ps]
    root = F.struct(F.lit(0.0).alias("near"), F.lit(0.0).alias("mark"), F.lit(-1).alias("level"), *[F.lit(0).cast("long").alias(c) for c in cs], F.lit(False).alias("leaf"))
    waiting, before = waiting.select(*who, "most", F.array(root).alias("open")), -1
    for i, (level, nodes, n) in enumerate(levels):
        shift, before = min(level - before, 63), level
        below = nodes.select("_g", *[F.shiftright(c, shift).alias(f"_u{k}") for k, c in enumerate(cs)], *cs, *[f"_{b}{k}" for b in ("lo", "hi") for k in range(dims)], "rep", F.col("leaf").alias("_leaf"))
        # a leaf has no cells below: it goes by a number of its own that no cell has
        own = [F.when(F.col("o.leaf"), -1 - F.pmod(F.xxhash64("_q"), F.lit(1 << 20))).otherwise(F.col("o._c0")).alias("_u0"), *[F.col(f"o._c{k}").alias(f"_u{k}") for k in range(1, dims)]]
        met = waiting.select(*who, "most", F.explode("open").alias("o")).select(*who, "most", "o", *own).join(_few(below, n), ["_g", *[f"_u{k}" for k in range(dims)]], "left")
        near = _apart(at, [F.greatest(F.col(f"_lo{k}"), F.least(F.col(f"_hi{k}"), F.col(p))) for k, p in enumerate(ps)])
        mark = _apart(at, [F.col(f"rep.{p}") for p in ps])
        child = F.struct(near.alias("near"), mark.alias("mark"), F.lit(level).alias("level"), *cs, F.col("_leaf").alias("leaf"))
        met = met.filter("o.leaf or _leaf is not null").select(*who, "most", F.when(F.col("o.leaf"), F.col("o")).otherwise(child).alias("o"))
        met = met if nearest_only else met.filter(F.col("o.near") <= F.col("most"))
        grouped = met.groupBy(*who).agg(F.min(F.least("most", "o.mark")).alias("most"), F.collect_list("o").alias("open"))  # the cells that one query meets
        waiting = grouped.withColumn("open", F.array(F.array_min("open")) if nearest_only else F.filter("open", lambda o: o["near"] <= F.col("most")))
        if n > FEW_CELLS or i % LEVELS_AT_ONCE == LEVELS_AT_ONCE - 1:
            waiting = settled(waiting)
    return waiting


def nearest(queries: DataFrame, targets: DataFrame, query: str, target: str, axes: tuple[str, ...] = ("x", "y", "z"), crowd: int = 64, on: str | None = None) -> DataFrame:
    """The nearest target of each query: query, target, d. On equal distances the smallest target.

    ``queries`` and ``targets`` have an id, the ``axes`` and, if given, a column ``on`` that has to be equal. Rows with a null or not
    finite position, or a null ``on``, have no neighbour, nor have queries without a target. Cells adapt to the targets:
    one with more than ``crowd`` is halved along each axis. All queries go down level by level, first into the nearest cell
    only, so that each knows how far away a target is at most, then into all cells whose box is not further away. So
    what it compares depends on ``crowd``, not on how densely or unevenly targets lie.
    """
    dims, ps, cs = len(axes), [f"_p{i}" for i in range(len(axes))], [f"_c{i}" for i in range(len(axes))]
    t = settled(_placed(targets, target, "_t", list(axes), on).groupBy("_g", *ps).agg(F.min("_t").alias("_t")))
    levels, held, total = _cell_tree(t, dims, max(1, crowd))
    who = ["_q", "_g", *ps]
    waiting = _placed(queries, query, "_q", list(axes), on)
    if held is None:
        return waiting.join(t, "_g").limit(0).select(F.col("_q").alias(query), F.col("_t").alias(target), F.lit(0.0).alias("d"))
    leaves = _few(held, total)
    best = F.array_min(F.transform("held", lambda h: F.struct(_apart([F.col(p) for p in ps], [h[p] for p in ps]).alias("d"), h["_t"].alias("_t"))))

    def compared(waiting: DataFrame) -> DataFrame:
        ends = waiting.select(*who, F.explode("open").alias("o")).select(*who, "o.level", *[f"o.{c}" for c in cs])
        return ends.join(leaves, ["level", "_g", *cs]).select(*who, best.alias("b"))

    one = compared(_descended(waiting.repartition(*who).select(*who, F.lit(float("inf")).alias("most")), levels, dims, nearest_only=True))
    first = settled(one.select(*who, F.col("b.d").alias("most")).repartition(*who))
    found = compared(_descended(first, levels, dims, nearest_only=False)).groupBy("_q").agg(F.min("b").alias("b"))
    return settled(found.select(F.col("_q").alias(query), F.col("b._t").alias(target), F.col("b.d").alias("d")))


def segment_distance(px: Column, pz: Column, ax: Column, az: Column, bx: Column, bz: Column) -> Column:
    """Distance in the plane from a point to a segment."""
    length = (bx - ax) ** 2 + (bz - az) ** 2
    t = F.when(length == 0, F.lit(0.0)).otherwise(F.least(F.greatest(((px - ax) * (bx - ax) + (pz - az) * (bz - az)) / length, F.lit(0.0)), F.lit(1.0)))
    return F.sqrt((px - ax - t * (bx - ax)) ** 2 + (pz - az - t * (bz - az)) ** 2)


def polyline_distance(points: DataFrame, segments: DataFrame, point: str, band: float, on: str) -> DataFrame:
    """Smallest distance of each point to the segments (ax, az, bx, bz) of its ``on``, as far as ``band``: point, d.

    Segments are entered into all cells of ``band`` width that their box widened by the band
    meets, so a point finds every segment within the band in its own cell. Points further away
    have no row.
    """
    span = lambda a, b: F.sequence(F.floor((F.least(a, b) - band) / band).cast("long"), F.floor((F.greatest(a, b) + band) / band).cast("long"))
    s = segments.withColumn("_cx", F.explode(span(F.col("ax"), F.col("bx")))).withColumn("_cz", F.explode(span(F.col("az"), F.col("bz"))))
    p = points.select(point, "x", "z", on, F.floor(F.col("x") / band).cast("long").alias("_cx"), F.floor(F.col("z") / band).cast("long").alias("_cz"))
    d = segment_distance(*[F.col(c) for c in ("x", "z", "ax", "az", "bx", "bz")])
    return p.join(s, ["_cx", "_cz", on]).groupBy(point).agg(F.min(d).alias("d")).filter(F.col("d") <= band)


#: Cells of a side of a block of the walkable plane, as a power of two.
BLOCK_BITS = 5
#: Blocks that are broadcast at most; one is less than a kilobyte.
FEW_BLOCKS = 50_000


def walkable_blocks(cells: DataFrame) -> DataFrame:
    """bx, bz, walk of the walkable ``cells`` (cx, cz): for each block of 32 x 32 cells a list of 32 numbers, whose bits are cells."""
    side = 1 << BLOCK_BITS
    placed = cells.select(
        F.shiftright("cx", BLOCK_BITS).alias("bx"), F.shiftright("cz", BLOCK_BITS).alias("bz"), F.expr(f"cast(cx & {side - 1} as int)").alias("i"), F.expr(f"shiftleft(1L, cast(cz & {side - 1} as int))").alias("bit")
    )
    rows = placed.groupBy("bx", "bz", "i").agg(F.bit_or("bit").alias("bits"))
    blocks = rows.groupBy("bx", "bz").agg(F.map_from_entries(F.collect_list(F.struct("i", "bits"))).alias("m"))  # at most 32 entries
    whole = F.transform(F.sequence(F.lit(0), F.lit(side - 1)), lambda i: F.coalesce(F.try_element_at("m", i), F.lit(0).cast("long")))
    return blocks.select("bx", "bz", whole.alias("walk"))


def forward_clearance(starts: DataFrame, cells: DataFrame, key: list[str], size: float, step: float, steps: int) -> DataFrame:
    """How far one can go straight from (x, z) along yaw over the walkable ``cells`` (cx, cz): key, clear.

    The first step into a cell that isn't walkable ends the way; without one it is steps * step. A null position or
    heading has no room. A ray is one row for each block of cells that it meets, not one for each step, and
    its steps in a block are looked up in the bits of it.
    """
    nths, mask = F.sequence(F.lit(1), F.lit(steps)), F.lit((1 << BLOCK_BITS) - 1)

    def cell(n: Column) -> tuple[Column, Column]:
        t = n * F.lit(step)
        return F.floor((F.col("x") + F.sin("yaw") * t) / size).cast("long"), F.floor((F.col("z") + F.cos("yaw") * t) / size).cast("long")

    def block(n: Column) -> Column:
        return F.struct(*[F.shiftright(c, BLOCK_BITS).alias(name) for c, name in zip(cell(n), ("bx", "bz"), strict=True)])

    blocks = settled(walkable_blocks(cells))
    blocks = F.broadcast(blocks) if blocks.count() <= FEW_BLOCKS else blocks
    way = starts.select(*dict.fromkeys([*key, "x", "z", "yaw"]), F.inline(F.array_distinct(F.transform(nths, block))))
    seen = way.join(blocks, ["bx", "bz"], "left")

    def stopped(n: Column) -> Column:
        cx, cz = cell(n)
        bits = F.get(F.col("walk"), cx.bitwiseAND(mask).cast("int"))
        free = F.call_function("shiftright", bits, cz.bitwiseAND(mask).cast("int")).bitwiseAND(F.lit(1)) == 1
        here = F.shiftright(cx, BLOCK_BITS).eqNullSafe(F.col("bx")) & F.shiftright(cz, BLOCK_BITS).eqNullSafe(F.col("bz"))
        return here & ~F.coalesce(free, F.lit(False))

    first = F.min(F.array_min(F.filter(nths, stopped)))
    return seen.groupBy(*key).agg(F.coalesce((first - 1) * F.lit(step), F.lit(steps * step)).alias("clear"))


def panorama(stops: DataFrame, points: DataFrame, key: str, on: str, reach: float, bins: int) -> DataFrame:
    """Free sight around each of ``stops`` (key, on, x, z) in the plane: key, sight, a list of ``bins`` distances clockwise from +Z.

    An entry is the distance of the nearest of the ``points`` (on, x, z) in its direction that is not at the stop itself and not
    further away than ``reach``, null without one. Points are met over cells of that width, and reduced to the nearest of
    each direction, so a stop ends as a list of fixed length however many points there are around it.
    """
    own = stops.select(key, on, *[F.col(c).alias(f"_s{c}") for c in "xz"])
    near = around(own.withColumnsRenamed({"_sx": "x", "_sz": "z"}), ["x", "z"], reach).withColumnsRenamed({"x": "_sx", "z": "_sz"})
    cells = points.select(on, "x", "z", *[F.floor(F.col(c) / reach).cast("long").alias(f"_c{c}") for c in "xz"])
    dx, dz = F.col("x") - F.col("_sx"), F.col("z") - F.col("_sz")
    met = near.join(cells, [on, "_cx", "_cz"]).select(key, F.sqrt(dx**2 + dz**2).alias("d"), sector(F.atan2(dx, dz), bins).alias("bin")).filter((F.col("d") > 0) & (F.col("d") <= reach))
    nearest_ = met.groupBy(key, "bin").agg(F.min("d").alias("d")).groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct("bin", "d"))).alias("m"))  # at most bins entries
    sight = F.transform(F.sequence(F.lit(0), F.lit(bins - 1)), lambda i: F.try_element_at("m", i))
    return stops.select(key).join(nearest_, key, "left").select(key, sight.alias("sight"))


def sector(angle: Column, bins: int) -> Column:
    """Which of ``bins`` equal sectors a direction lies in; one within a billionth of the next sector counts to that."""
    turn = 2 * math.pi
    return F.pmod(F.floor(F.pmod(angle, F.lit(turn)) / (turn / bins) + 1e-9).cast("int"), F.lit(bins))


def best_heading(seed: str, scan_deg: float, steps: int, bins: int, field: int, share: float) -> Column:
    """Of at least three headings within ``scan_deg`` of the column ``seed`` that with the most room in its middle, the first on ties.

    For rows with a column sight (``panorama``). A view spans ``field`` sectors; the room is the median of the distances in the
    middle ``share`` of it, four sectors at least, weighed by how many of these have one, and 0 where none has. Nothing is
    scanned where steps or scan_deg are not positive.
    """
    if steps <= 0 or scan_deg <= 0:
        return F.col(seed)
    steps, width = max(3, steps), max(4, round(share * field))

    def tried(i: Column) -> Column:
        yaw = wrap(F.col(seed) + F.radians(-scan_deg + i * (2 * scan_deg / (steps - 1))))
        middle = F.transform(F.sequence(F.lit(0), F.lit(width - 1)), lambda j: F.get(F.col("sight"), F.pmod(sector(yaw, bins) - width // 2 + j, F.lit(bins))))
        seen = F.array_sort(F.array_compact(middle))
        n = F.size(seen)
        median = (F.get(seen, F.floor((n - 1) / 2).cast("int")) + F.get(seen, F.floor(n / 2).cast("int"))) / 2
        room = F.when(n > 0, median * (0.5 + 0.5 * n / width)).otherwise(0.0)
        return F.struct(F.round(room, 9).alias("room"), (-i).alias("first"), yaw.alias("yaw"))

    return F.array_max(F.transform(F.sequence(F.lit(0), F.lit(steps - 1)), tried))["yaw"]

"""Mixing sources to target weights with hash-threshold histograms.

Only DataFrame operations: sizes are summed by source and hash bucket, running sums over the
buckets find where a source's budget ends, and only that boundary bucket is split again by the
next bits of the hash. Documents are then taken by comparing their hash with the thresholds;
nothing is sorted and no document list is built.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lumenvox.llm.common import cut, lookup, text_of

#: Words: runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
HASH_BITS, BUCKET_BITS = 60, 12
#: Sources that are joined by broadcast; with more of them the thresholds are joined by a shuffle.
BROADCAST_SOURCES = 20_000


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def document_hash(id_col: str, text_col: str) -> Column:
    """60 bits of an md5 over id and text: the same on every run, and spread over repeated ids."""
    key = F.concat(F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.lit(" "), text_of(text_col))
    return F.conv(F.substring(F.md5(key), 1, HASH_BITS // 4), 16, 10).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...], share: float, most: float) -> DataFrame:
    """Targets by water-filling: source, source_size, target.

    ``sizes`` has source and source_size. Sources in code point order, null last, weigh
    ``weights`` in turn and divide ``share`` times the sum of all sizes; a target stops at
    ``most`` times the source's size and the excess goes to the others by weight.
    """
    in_order = Window.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(in_order) - 1) % len(weights)
    weighed = sizes.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (turn + 1).cast("int")))
    by_ratio = Window.orderBy(F.col("ratio"), F.col("source").asc_nulls_last())
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    stepped = (
        weighed.withColumn("cap", most * F.col("source_size"))
        .withColumn("ratio", F.col("cap") / F.col("weight"))
        .withColumn("left_size", share * F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
        .withColumn("left_weight", F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
        .withColumn("capped", F.col("cap") * F.col("left_weight") <= F.col("left_size") * F.col("weight"))
    )
    first_open = F.min(F.when(~F.col("capped"), F.struct("ratio", "left_size", "left_weight"))).over(everything)
    open_ = F.coalesce(F.col("ratio") >= F.col("open.ratio"), F.lit(False)) & ~F.col("capped")
    filled = stepped.withColumn("open", first_open)
    return filled.select(
        "source",
        "source_size",
        F.when(open_, F.col("open.left_size") * F.col("weight") / F.col("open.left_weight")).otherwise(F.col("cap")).alias("target"),
    )


def _same(a: str, b: str) -> Column:
    return F.col(a).eqNullSafe(F.col(b))


def _thresholds(items: DataFrame, budgets: DataFrame) -> DataFrame:
    """The hash below which each source's items are within its budget: source, threshold, used.

    ``items`` has source, hash, size; ``budgets`` has source, budget. Each round adds up the
    boundary bucket of every source by the next bits of the hash.
    """
    spark = items.sparkSession
    found = None
    # of each source: the boundary bucket so far, what is taken below it, and its budget
    state = budgets.select("source", F.lit(0).cast("long").alias("bucket"), F.lit(0).cast("long").alias("used"), "budget")
    for shift in range(HASH_BITS - BUCKET_BITS, -1, -BUCKET_BITS):
        inside = items
        if shift < HASH_BITS - BUCKET_BITS:
            marks = F.broadcast(state) if state.count() <= BROADCAST_SOURCES else state
            marks = marks.select(F.col("source").alias("_source"), F.col("bucket").alias("_bucket"))
            inside = items.join(marks, _same("source", "_source") & (F.shiftright("hash", shift + BUCKET_BITS) == F.col("_bucket")), "left_semi")
        buckets = inside.groupBy("source", F.shiftright("hash", shift).alias("b")).agg(F.sum("size").alias("size"), F.count("*").alias("n"))
        rising = Window.partitionBy("source").orderBy("b")
        summed = (
            buckets.withColumnRenamed("source", "_source")
            .join(state, _same("_source", "source"))
            .drop("_source")
            .withColumn("upto", F.col("used") + F.sum("size").over(Window.partitionBy("source").orderBy("b").rowsBetween(Window.unboundedPreceding, 0)))
        )
        over = summed.filter(F.col("upto") > F.col("budget"))
        edge = over.withColumn("_rank", F.row_number().over(rising)).filter("_rank = 1")
        edge = cut(edge.select("source", F.col("b").alias("bucket"), (F.col("upto") - F.col("size")).alias("used"), "budget", "n"))
        final = edge if shift == 0 else edge.filter("n = 1")
        done = final.select("source", F.shiftleft("bucket", shift).alias("threshold"), "used")
        found = done if found is None else found.unionByName(done)
        state = edge.filter("n > 1").drop("n")
        if shift == 0 or state.isEmpty():
            break
    return found if found is not None else spark.createDataFrame([], "source string, threshold long, used long")


def _plan(items: DataFrame, weights: tuple[int, ...], share: float, most: float, rounds: int) -> DataFrame:
    """Of each source: source, source_size, target, whole (times that all is taken), bounds (thresholds and gaps)."""
    sizes = items.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n"))
    named = cut(sizes)
    plan = source_targets(named.drop("n"), weights, share, most)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    plan = plan.withColumn("whole", whole).withColumn("gap0", F.col("target") - F.col("whole") * F.col("source_size"))
    plan = cut(plan.join(named.select(F.col("source").alias("_source"), F.col("n").alias("rows")), _same("source", "_source")).drop("_source"))
    top = F.lit(1 << HASH_BITS).cast("long")
    for r in range(1, rounds + 1):
        fits = plan if r == 1 else plan.filter(F.col(f"gap{r - 1}") >= 1)
        budgets = fits.select("source", F.col(f"gap{r - 1}").alias("budget"), *([F.col(f"from{r - 1}").alias("least")] if r > 1 else []))
        rest = items
        if r > 1:
            marks = F.broadcast(budgets) if budgets.count() <= BROADCAST_SOURCES else budgets
            marks = marks.withColumnRenamed("source", "_source")
            rest = items.join(
                marks, _same("source", "_source") & (F.col("hash") >= F.col("least")) & (F.col("size") <= F.col("budget")), "left_semi"
            )
        found = _thresholds(rest, budgets.select("source", "budget"))
        bounds = found.select(F.col("source").alias("_source"), F.col("threshold").alias("_t"), F.col("used").alias("_u"))
        # a source without a boundary takes all that fits, so its gap is closed as far as it can be
        plan = cut(
            plan.join(bounds, _same("source", "_source"), "left")
            .withColumn(f"from{r}", F.when(F.col(f"gap{r - 1}") >= 1, F.coalesce("_t", top)).otherwise(F.lit(0) if r == 1 else F.col(f"from{r - 1}")).cast("long"))
            .withColumn(f"gap{r}", F.when(F.col("_t").isNotNull(), F.col(f"gap{r - 1}") - F.col("_u")).otherwise(F.lit(0.0)))
            .drop("_source", "_t", "_u")
        )
    return plan


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[int, ...] = (5, 2, 1),
    share: float = 1.5,
    most: float = 2.0,
    rounds: int = 3,
) -> DataFrame:
    """How often each document goes into the mix: row (all columns), doc_id, size, source_size, target, copies, taken.

    A source whose target is k times its size and a rest takes every document k times and, for
    the rest, once more the documents whose hash is below the source's threshold. What then is
    still open is narrower than the first document over the budget; ``rounds`` says how often
    the gap is filled in the same way from the documents above the threshold that fit it.
    Documents are taken whole, so no document exceeds ``most`` times its size if that is whole.

    Null text has size 0; null is a source of its own and comes last; a null id is hashed as an
    empty one; rows with equal id and text have equal hashes and share their fate. An empty table
    gives no rows. Extra columns stay inside ``row`` and cannot clash.
    """
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.col(id_col).alias("doc_id"),
        F.col(source_col).cast("string").alias("source"),
        word_count(text_of(text_col)).alias("size"),
        document_hash(id_col, text_col).alias("hash"),
    )
    items = cut(rows.select("source", "hash", "size"))
    plan = _plan(items, weights, share, most, rounds)
    key = F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit(""))
    plan = plan.withColumn("_key", key).drop("source")
    keyed = rows.withColumn("_key", key)
    found = keyed.join(F.broadcast(plan), "_key", "left") if plan.count() <= BROADCAST_SOURCES else lookup(keyed, "_key", plan, "rows", F.col("hash"))
    once_more = F.col("hash") < F.col("from1")
    for r in range(2, rounds + 1):
        once_more = once_more | ((F.col("size") <= F.col(f"gap{r - 1}")) & (F.col("hash") >= F.col(f"from{r - 1}")) & (F.col("hash") < F.col(f"from{r}")))
    copies = F.col("whole") + F.coalesce(once_more, F.lit(False)).cast("long")
    return found.select("row", "doc_id", "source", "size", "source_size", "target", copies.alias("copies")).withColumn(
        "taken", F.col("copies") * F.col("size")
    )


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: every document as often as ``mix`` says, with the columns of ``docs``."""
    taken = mix(docs, **options).filter("copies > 0")
    return taken.select("row", F.explode(F.array_repeat(F.lit(True), F.col("copies").cast("int")))).select("row.*")

"""Mixing sources to target weights by entropy balancing.

Each document gets a rate, the expected number of its copies. The rates minimise the
relative entropy to one copy each, under the constraint that every source gives its
target of words and no rate is above the cap. By duality they are exponential tilts,
rate = min(cap, exp(lambda * size / mean size)), with one dual variable lambda for each
source. The dual is convex and its Hessian diagonal; Newton steps, held inside a
bracket, solve it. Each step is one aggregation over (source, size) cells, so that the
work of a step does not grow with documents of equal size and a hot source is spread.

Rates are then rounded: along each source's cells in falling size the running total of
copies is rounded, and what that leaves of the target is made up with the smallest
documents. Which documents of a cell get one copy more is chosen by a hash of their id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tributary.llm.common import free_names, staged, word_count

WEIGHTS = (3, 1, 2)
SHARE = 1.5
CAP = 2
TOLERANCE = 1e-9
MAX_STEPS = 80
#: Steps that end without the tolerance are an error beyond this share of a target.
ACCEPTED_MISS = 1e-6
#: Documents of a cell that are ranked together.
RANKED_TOGETHER = 1000
SEED = 42


def _ranked(sources: DataFrame) -> DataFrame:
    """``sources`` with rank, from 0 by code point and null last, without sorting all in one task."""
    order = F.col("source").asc_nulls_last()
    dealt = staged(sources.repartitionByRange(order).withColumn("part", F.spark_partition_id()), "mix-sources")
    # one row per partition
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (dealt.groupBy("part").agg(F.count(F.lit(1)).alias("c"))
               .select("part", F.coalesce(F.sum("c").over(before), F.lit(0)).alias("offset")))
    nth = F.row_number().over(Window.partitionBy("part").orderBy(order))
    return dealt.withColumn("nth", nth).join(offsets, "part").withColumn(
        "rank", F.col("offset") + F.col("nth") - 1).drop("part", "nth", "offset")


def source_targets(sources: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """``sources`` (source, words, ..) with target: its weight's part of ``share`` times all words.

    Weights go round the sources by code point, null last. A target stops at ``cap`` times
    the source's words; the excess is shared again by weight until none is above. With
    share above cap all targets are at their stop.
    """
    pick = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod("rank", F.lit(len(weights))) + 1).cast("int"))
    ranked = staged(_ranked(sources).withColumn("weight", pick).withColumn("most", F.col("words") * F.lit(float(cap))),
                    "mix-weights")
    pool = float(ranked.agg(F.sum("words")).first()[0] or 0) * share
    level = 0.0
    while True:  # the level only rises, and each round stops another source at least
        full = F.col("weight") * F.lit(level) > F.col("most")
        taken, left = ranked.agg(F.sum(F.when(full, F.col("most")).otherwise(0.0)),
                                 F.sum(F.when(full, 0.0).otherwise(F.col("weight")))).first()
        if not left:
            break
        new = (pool - taken) / left
        if new <= level:
            break
        level = new
    target = F.least(F.col("weight") * F.lit(level), F.col("most")) if left else F.col("most")
    return ranked.withColumn("target", target).drop("rank", "most")


def _rate(lam: Column, size: Column, mean: Column, cap: float) -> Column:
    return F.least(F.lit(float(cap)), F.exp(lam * size / mean))


def dual_variables(cells: DataFrame, targets: DataFrame, cap: float = CAP, tolerance: float = TOLERANCE) -> DataFrame:
    """(source, words, target, mean, lam): Newton's solution for every source.

    lam is null where all rates are the cap (the target is the most that can be taken)
    and where nothing is to be taken.
    """
    facts = (cells.where("size > 0").groupBy("source")
             .agg((F.sum(F.col("size") * F.col("n")) / F.sum("n")).alias("mean"), F.min("size").alias("low")))
    state = _by_source(targets.select("source", "words", "target"), facts, "left")
    least = F.col("low") / F.col("mean")
    grow = F.col("target") >= F.col("words")
    solved = F.col("mean").isNull() | (F.col("target") <= 0) | (F.col("target") >= F.col("words") * cap * (1 - 1e-12))
    state = state.select(
        "source", "words", "target", "mean", F.when(~solved, F.lit(0.0)).alias("lam"),
        # all rates are at the cap at one end, all are small enough at the other
        F.when(grow, F.lit(0.0)).otherwise(F.log(F.col("target") / F.col("words")) / least).alias("a"),
        F.when(grow, F.log(F.lit(float(cap))) / least).otherwise(F.lit(0.0)).alias("b"), F.lit(1.0).alias("miss"))
    state = staged(state, "mix-dual")
    for _ in range(MAX_STEPS):
        x = F.col("size") / F.col("mean")
        rate = _rate(F.col("lam"), F.col("size"), F.col("mean"), cap)
        words = F.col("n") * F.col("size") * rate
        sums = (_by_source(cells.where("size > 0"), state.where("lam is not null").select("source", "lam", "mean"), "inner")
                .groupBy("source").agg(F.sum(words).alias("f"), F.sum(F.when(rate < cap, words * x).otherwise(0.0)).alias("slope")))
        joined = _by_source(state, sums, "left")
        a = F.when(F.col("f") < F.col("target"), F.col("lam")).otherwise(F.col("a"))
        b = F.when(F.col("f") >= F.col("target"), F.col("lam")).otherwise(F.col("b"))
        step = F.col("lam") + F.log(F.col("target") / F.col("f")) * F.col("f") / F.col("slope")
        inside = (F.col("slope") > 0) & (step > F.col("a2")) & (step < F.col("b2"))
        miss = F.abs(F.col("f") / F.col("target") - 1)
        state = staged(joined.withColumn("a2", a).withColumn("b2", b).select(
            "source", "words", "target", "mean",
            F.when(miss < tolerance, F.col("lam")).when(inside, step).otherwise((F.col("a2") + F.col("b2")) / 2).alias("lam"),
            F.col("a2").alias("a"), F.col("b2").alias("b"), miss.alias("miss")), "mix-dual")
        worst = state.agg(F.max("miss")).first()[0]
        if worst is None or worst < tolerance:
            break
    else:
        if worst > ACCEPTED_MISS:
            raise RuntimeError(f"a source's expected words miss their target by {worst:.2g} after {MAX_STEPS} Newton steps")
    return state.select("source", "words", "target", "mean", "lam")


def _by_source(left: DataFrame, right: DataFrame, how: str) -> DataFrame:
    """Join on source, nulls alike."""
    r = right.withColumnRenamed("source", "source_r")
    return left.join(r, left["source"].eqNullSafe(F.col("source_r")), how).drop("source_r")


def _copies(cells: DataFrame, solved: DataFrame, cap: float) -> DataFrame:
    """``cells`` with words, target and k, the copies that a cell's documents get together."""
    rate = (F.when((F.col("size") == 0) | (F.col("target") <= 0), F.lit(0.0))
            .when(F.col("lam").isNull(), F.lit(float(cap)))
            .otherwise(_rate(F.col("lam"), F.col("size"), F.col("mean"), cap)))
    base = _by_source(cells, solved, "inner").withColumn("real", F.col("n") * rate)
    most = (F.col("n") * F.lit(cap)).cast("bigint")
    fall = Window.partitionBy("source").orderBy(F.desc("size")).rowsBetween(Window.unboundedPreceding, 0)
    so_far = F.sum("real").over(fall)
    base = base.withColumn("to", so_far).withColumn("k", F.least(most, F.greatest(F.lit(0), (
        F.floor(F.col("to") + 0.5) - F.floor(F.col("to") - F.col("real") + 0.5))).cast("bigint")))
    every = Window.partitionBy("source")
    base = base.withColumn("open", F.floor(F.col("target") - F.sum(F.col("k") * F.col("size")).over(every) + 0.5).cast("bigint"))
    rise = Window.partitionBy("source").orderBy("size").rowsBetween(Window.unboundedPreceding, 0)
    room = F.when(F.col("size") == 0, F.lit(0)).when(F.col("open") > 0, most - F.col("k")).otherwise(F.col("k"))
    base = base.withColumn("room", room).withColumn("before", F.sum(F.col("room") * F.col("size")).over(rise) - F.col("room") * F.col("size"))
    move = F.least(F.col("room"), F.greatest(F.lit(0), F.floor(
        (F.abs("open") - F.col("before")) / F.greatest("size", F.lit(1))).cast("bigint")))
    return base.select("source", "size", "n", "words", "target", (F.col("k") + F.signum("open").cast("bigint") * move).alias("k"))


def mix_plan(docs: DataFrame, text: str = "text", source: str = "source", id_col: str = "doc_id",
             weights: tuple = WEIGHTS, share: float = SHARE, cap: int = CAP) -> DataFrame:
    """One row per row of ``docs``: id, th (the text's hash), size, source_size, target, copies and taken.

    size counts the text's words (a null text has none); taken is copies times size, and
    copies is at most ``cap``. Documents without words are never copied. A null source is
    a source. Repeated rows are documents of their own. The same rows give the same plan.
    """
    sized = staged(docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("th"), F.col(source).alias("source"),
                               word_count(text).alias("size")), "mix-sizes")
    cells = staged(sized.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n")), "mix-cells")
    sources = cells.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("words"))
    solved = dual_variables(cells, source_targets(sources, weights, share, cap), cap)
    plan = staged(_copies(cells, solved, cap).withColumnRenamed("size", "size_c"), "mix-copies")
    joined = sized.join(plan.withColumnRenamed("source", "source_c"),
                        F.col("source").eqNullSafe(F.col("source_c")) & (F.col("size") == F.col("size_c"))).drop("source_c", "size_c")
    chance = F.xxhash64(F.lit(SEED), "id", "th")
    dealt = staged(joined.withColumn("chance", chance).withColumn(
        "lot", F.pmod(F.col("chance"), F.ceil(F.col("n") / RANKED_TOGETHER))), "mix-lots")
    lots = dealt.groupBy("source", "size", "lot").agg(F.count(F.lit(1)).alias("c"))
    before = Window.partitionBy("source", "size").orderBy("lot").rowsBetween(Window.unboundedPreceding, -1)
    lots = lots.select(F.col("source").alias("source_l"), F.col("size").alias("size_l"), F.col("lot").alias("lot_l"),
                       F.coalesce(F.sum("c").over(before), F.lit(0)).alias("offset"))
    nth = F.row_number().over(Window.partitionBy("source", "size", "lot").orderBy("chance", "id"))
    out = dealt.withColumn("nth", nth).join(
        lots, F.col("source").eqNullSafe(F.col("source_l")) & (F.col("size") == F.col("size_l")) & (F.col("lot") == F.col("lot_l")))
    more = (F.col("offset") + F.col("nth") <= F.col("k") % F.col("n")).cast("bigint")
    out = out.withColumn("copies", F.floor(F.col("k") / F.col("n")).cast("bigint") + more)
    return out.select(F.col("id").alias(id_col), "th", "size", F.col("words").alias("source_size"), "target", "copies",
                      (F.col("copies") * F.col("size")).alias("taken"))


def mixed(docs: DataFrame, text: str = "text", source: str = "source", id_col: str = "doc_id",
          weights: tuple = WEIGHTS, share: float = SHARE, cap: int = CAP) -> DataFrame:
    """``docs`` with each row as often as the plan has copies of it; columns unchanged."""
    plan = mix_plan(docs, text, source, id_col, weights, share, cap)
    # rows that repeat an id and a text share their copies
    per = staged(plan.groupBy(F.col(id_col).alias("id"), "th").agg(F.sum("copies").alias("copies"), F.count(F.lit(1)).alias("rows"))
                 .where("copies > 0"), "mix-per-document")
    th, nth, copies, rows, id_p, th_p, one = free_names(docs, "th", "nth", "copies", "rows", "id_p", "th_p", "one")
    keyed = docs.withColumn(th, F.xxhash64(text))
    right = per.toDF(id_p, th_p, copies, rows).hint("shuffle_hash")
    joined = keyed.join(right, F.col(id_col).eqNullSafe(F.col(id_p)) & F.col(th).eqNullSafe(F.col(th_p)))
    cols = [F.col(f"`{c}`") for c in docs.columns]
    single = joined.where(F.col(rows) == 1)
    out = single.withColumn(one, F.explode(F.sequence(F.lit(1), F.col(copies)))).select(*cols)
    if per.where("rows > 1").isEmpty():
        return out
    again = joined.where(F.col(rows) > 1).withColumn(nth, F.row_number().over(Window.partitionBy(id_p, th_p).orderBy(th_p)))
    share_of = F.floor(F.col(copies) * F.col(nth) / F.col(rows)) - F.floor(F.col(copies) * (F.col(nth) - 1) / F.col(rows))
    again = again.withColumn(one, F.explode(F.array_repeat(F.lit(1), share_of.cast("int")))).select(*cols)
    return out.unionByName(again)

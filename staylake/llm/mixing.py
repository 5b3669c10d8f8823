"""Mixing sources to target weights by Pareto order sampling.

Every source gets a word target. Whole copies that its target holds for certain go to each of its
documents; the rest of the target is a fixed-size sample without replacement with unequal
inclusion probabilities: documents are ranked by their random odds divided by their inclusion
odds, and in this order every document whose words still fit is taken. One more document, the one
whose size comes nearest to the words still missing, closes the gap. Documents whose share of the
rest is a whole copy or more are taken for certain, and what they leave is shared again.

The order is never walked row by row. Words are summed by rank class; only the class in which the
words run out is ordered, up to the document that no longer fits. The next round goes on behind it
with the documents that fit into what is left, until none does.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from staylake.llm._scratch import Scratch, free_name, small_side

#: Rank classes in which the cut is first looked for; only one class of a source is ever ordered row by row.
RANK_CLASSES = 4096


def word_count(text: Column) -> Column:
    """Number of ``[^\\x20\\x09-\\x0D]+`` in the text (0 for null)."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def random_unit(doc_id: Column, seed: int) -> Column:
    """A uniform number in (0, 1) that depends on the id and the seed alone."""
    digits = F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), doc_id.cast("string")).cast("binary")), 1, 12)
    return (F.conv(digits, 16, 10).cast("long") + F.lit(0.5)) / F.lit(float(1 << 48))


def source_targets(sizes: DataFrame, cycle: tuple[int, ...], max_copies: int) -> DataFrame:
    """source, source_size, target: one row per source (of ``sizes``: source, size).

    Sources by code point, null last, take the cycle's weights in turn. Targets share the total by
    weight; a target stops at max_copies times its source, and what is above it is shared again.
    Both windows run over one row per source.
    """
    by_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weighted = by_source.withColumn("weight", F.element_at(F.array(*map(F.lit, cycle)), (place % len(cycle) + 1).cast("int")).cast("long"))
    weighted = weighted.withColumn("cap", F.col("source_size") * max_copies)
    order = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before, everything = order.rowsBetween(Window.unboundedPreceding, -1), Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    filled = weighted.select("*", F.row_number().over(order).alias("at"), F.coalesce(F.sum("cap").over(before), F.lit(0)).alias("capped"), F.coalesce(F.sum("weight").over(before), F.lit(0)).alias("weight_before"),
                             F.sum("source_size").over(everything).alias("total"), F.sum("weight").over(everything).alias("weights"))
    filled = filled.withColumn("level", (F.col("total") - F.col("capped")).cast("double") / (F.col("weights") - F.col("weight_before")).cast("double"))
    open_at = F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.col("at"))
    filled = filled.withColumn("first_open", F.min(open_at).over(everything))
    level = F.max(F.when(F.col("at") == F.col("first_open"), F.col("level"))).over(everything)
    capped = F.col("first_open").isNull() | (F.col("at") < F.col("first_open"))
    return filled.withColumn("level", level).select("source", "source_size", F.when(capped, F.col("cap").cast("double")).otherwise(F.col("level") * F.col("weight")).alias("target"))


def _rank(frame: DataFrame) -> DataFrame:
    """Adds ``rank``: random odds / inclusion odds, mapped from (0, inf) to (0, 1)."""
    u, p = F.col("u"), F.col("chance")
    odds = F.try_divide(u / (1 - u), p / (1 - p))  # null where nothing is drawn
    return frame.withColumn("rank", odds / (1 + odds)).withColumn("class", F.floor(F.col("rank") * RANK_CLASSES).cast("int"))


def row_id(name: str) -> Column:
    """The id, a null as the smallest long."""
    return F.coalesce(F.col(name), F.lit(-(1 << 63)).cast("long"))


def fitting_rounds(ranked: DataFrame, gaps: DataFrame, n_sources: int, scratch: Scratch) -> DataFrame:
    """of, rounds, gap: which stretches of the rank order each source takes, and the words still missing then.

    ``ranked``: source, rank, class, id, size; ``gaps``: of, gap (one row per source). A stretch
    (gap, after, upto) takes the documents of 1 to ``gap`` words that rank behind ``after`` (null:
    from the start) and not behind ``upto`` (null: to the end). Rows that agree in rank, id and size
    are taken together or not at all.
    """
    place = "struct<rank:double,id:bigint,size:bigint>"
    form = f"array<struct<gap:bigint,after:{place},upto:{place}>>"
    state = gaps.select("of", F.col("gap").cast("long").alias("gap"), F.lit(None).cast(place).alias("after"), F.array().cast(form).alias("rounds"), (F.col("gap") > 0).alias("open"))
    state, step = scratch.write(state, "round-0"), 0
    here = F.struct("rank", "id", "size")
    while not state.where("open").isEmpty():
        now = state.where("open").select("of", "gap", "after")
        fitting = ranked.join(small_side(now, n_sources), F.col("source").eqNullSafe(F.col("of"))).where((F.col("size") > 0) & (F.col("size") <= F.col("gap")) & (F.col("after").isNull() | (here > F.col("after"))))
        classes = fitting.groupBy("of", "class").agg(F.sum("size").alias("words"), F.first("gap").alias("gap"))
        classes = classes.withColumn("until", F.sum("words").over(Window.partitionBy("of").orderBy("class")))
        full = F.col("until") > F.col("gap")
        classes = scratch.write(classes.groupBy("of").agg(F.max("until").alias("total"), F.min_by(F.struct("class", (F.col("until") - F.col("words")).alias("before")), F.when(full, F.col("class"))).alias("cut")), f"classes-{step}")
        cuts = classes.where("cut is not null").select(F.col("of").alias("cut_of"), "cut")
        steps = fitting.join(small_side(cuts, n_sources), F.col("of").eqNullSafe(F.col("cut_of")) & (F.col("class") == F.col("cut.class")))
        steps = steps.groupBy("of", "rank", "id", "size").agg(F.sum("size").alias("words"), F.first("gap").alias("gap"), F.first("cut.before").alias("before"))
        steps = steps.withColumn("until", F.col("before") + F.sum("words").over(Window.partitionBy("of").orderBy("rank", "id", "size")))
        stops = steps.where(F.col("until") > F.col("gap")).groupBy("of").agg(F.min(F.struct("rank", "id", "size", (F.col("until") - F.col("words")).alias("taken"))).alias("stop"))
        took = classes.join(stops.withColumnRenamed("of", "stop_of"), F.col("of").eqNullSafe(F.col("stop_of")), "left").select(F.col("of").alias("took_of"), F.coalesce("stop.taken", "total").alias("taken"), F.when(F.col("stop").isNotNull(), F.struct("stop.rank", "stop.id", "stop.size")).alias("stop"))
        joined = state.join(took, F.col("of").eqNullSafe(F.col("took_of")) & F.col("open"), "left")
        went = F.struct(F.col("gap"), F.col("after"), F.col("stop").cast(place).alias("upto"))
        left = F.col("gap") - F.coalesce("taken", F.lit(0))
        state = scratch.write(joined.select("of", left.alias("gap"), F.coalesce(F.col("stop").cast(place), F.col("after")).alias("after"),
                                            F.when(F.col("taken").isNull(), F.col("rounds")).otherwise(F.concat("rounds", F.array(went).cast(form))).alias("rounds"),
                                            (F.col("stop").isNotNull() & (left > 0)).alias("open")), f"round-{step + 1}")
        scratch.drop(f"round-{step}", f"classes-{step}")
        step += 1
    return state.select("of", "rounds", "gap")


def fits_a_round() -> Column:
    """Whether the row (rank, id, size) lies in a stretch of its source's ``rounds``."""
    here = F.struct("rank", "id", "size")
    inside = lambda r: (F.col("size") <= r["gap"]) & (r["after"].isNull() | (here > r["after"])) & (r["upto"].isNull() | (here < r["upto"]))
    return F.coalesce((F.col("size") > 0) & F.exists("rounds", inside), F.lit(False))


def _shared_again(sized: DataFrame, plan: DataFrame, n_sources: int, scratch: Scratch) -> DataFrame:
    """``plan`` (of, rest, ...) with ``spare``, ``mass`` and ``sure_from``.

    A document whose share rest * importance / mass is 1 or more is certain: its words leave the
    rest, its mass the mass, and the others share again, until no more become certain. Those of
    importance ``sure_from`` or more are certain (null: none).
    """
    state, step = plan.withColumn("sure_from", F.lit(None).cast("double")).withColumn("spare", F.col("rest")), 0
    while True:
        rows = sized.select("source", "size", "importance").join(small_side(state, n_sources), F.col("source").eqNullSafe(F.col("of")))
        free = F.col("sure_from").isNull() | (F.col("importance") < F.col("sure_from"))
        mass = rows.groupBy("of").agg(F.sum(F.when(free, F.col("importance") * F.col("size"))).alias("free_mass"), F.sum(F.when(~free, F.col("size"))).alias("sure_words"), F.max(F.when(free & (F.col("size") > 0), F.col("importance"))).alias("most"))
        joined = state.drop("spare", "mass").join(mass.withColumnRenamed("of", "mass_of"), F.col("of").eqNullSafe(F.col("mass_of")), "left").drop("mass_of")
        joined = joined.withColumn("spare", F.greatest(F.col("rest") - F.coalesce("sure_words", F.lit(0)), F.lit(0.0))).withColumnRenamed("free_mass", "mass")
        sure = F.coalesce(F.try_divide(F.col("spare") * F.col("most"), F.col("mass")) >= 1, F.lit(False)) & (F.col("spare") > 0)
        # all of an importance of mass / spare or more become certain together
        state = scratch.write(joined.withColumn("more", sure).withColumn("sure_from", F.when(F.col("more"), F.try_divide("mass", "spare")).otherwise(F.col("sure_from"))).drop("sure_words", "most"), f"shares-{step}")
        if state.where("more").isEmpty():
            return state.drop("more")
        state, step = state.drop("more"), step + 1


def mix_sources(docs: DataFrame, cycle: tuple[int, ...] = (1, 2, 3), max_copies: int = 3, seed: int = 0, importance: Column | None = None, name: str = "_mix") -> DataFrame:
    """All columns of ``docs`` plus, last, ``name``: struct(size, source_size, target, copies).

    ``docs`` needs doc_id, text, source; its other columns, whatever they are called, are kept, so
    ``name`` must be none of them (``_scratch.free_name`` gives one; a ValueError says so).
    ``importance`` (positive, 1 by default) makes a document likelier within its source; documents
    that it makes certain come first in their source, by the same rank, as far as they fit.

    A null text has size 0, and so has an empty one; null is a source of its own. Rows that agree
    in doc_id and size are taken or left together. Sources of size 0 have target 0. Documents of
    size 0, and those of a source whose rest is 0, get only their certain copies. An empty table stays
    empty. The result depends on ids, sizes, sources and the seed alone, so reruns and retried tasks
    agree. A source misses its target by less than half of its smallest document left out.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark)
    if free_name(docs, name) != name:
        raise ValueError(f"the table has a column {name}")
    size, unit = word_count(F.col("text")), random_unit(F.col("doc_id"), seed)
    weight = (F.lit(1.0) if importance is None else importance).cast("double")
    sized = scratch.write(docs.select("doc_id", "source", size.alias("size"), unit.alias("u"), weight.alias("importance")), "sized")
    targets = scratch.write(source_targets(sized, cycle, max_copies), "targets")
    whole = F.when(F.col("source_size") > 0, F.floor(F.try_divide("target", "source_size"))).otherwise(F.lit(0)).cast("long")
    plan = targets.withColumn("whole", whole).withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size")).withColumnRenamed("source", "of")
    n_sources = targets.count()
    if importance is None:  # then every share is below 1, and the mass is the size
        plan = plan.withColumn("mass", F.col("source_size").cast("double")).withColumn("spare", F.col("rest")).withColumn("sure_from", F.lit(None).cast("double"))
        plan = scratch.write(plan, "plan")
    else:
        plan = scratch.write(_shared_again(sized, plan, n_sources, scratch), "plan")

    def with_plan(frame: DataFrame, plan: DataFrame) -> DataFrame:
        return frame.join(small_side(plan, n_sources), F.col("source").eqNullSafe(F.col("of")))

    sure = F.coalesce(F.col("importance") >= F.col("sure_from"), F.lit(False))
    chance = F.coalesce(F.least(F.try_divide(F.col("spare") * F.col("importance"), F.col("mass")), F.lit(1 - 1e-12)), F.lit(0.0))

    def ranked(frame: DataFrame) -> DataFrame:
        """Certain documents first, each part by its random odds over its inclusion odds."""
        out = _rank(frame.withColumn("chance", F.when(sure, F.lit(0.5)).otherwise(chance)))
        return out.withColumn("rank", F.col("rank") + F.when(sure, F.lit(-1.0)).otherwise(F.lit(0.0))).withColumn("class", F.floor(F.col("rank") * RANK_CLASSES).cast("int")).withColumn("id", row_id("doc_id"))

    order = ranked(with_plan(sized, plan.where("rest > 0"))).select("source", "rank", "class", "id", "size")
    rounds = fitting_rounds(order, plan.where("rest > 0").select("of", F.floor("rest").alias("gap")), n_sources, scratch)
    missing = plan.select(F.col("of").alias("plan_of"), "rest").join(rounds.select("of", "rounds", F.col("gap").alias("left")), F.col("plan_of").eqNullSafe(F.col("of")))
    missing = missing.select("of", "rounds", (F.col("left") + F.col("rest") - F.floor("rest")).alias("gap"))
    over = with_plan(order, missing.where("gap > 0")).where(~fits_a_round())
    miss = F.abs(F.col("gap") - F.col("size"))
    closer = over.where(miss < F.col("gap")).groupBy("of").agg(F.min(F.struct(miss.alias("miss"), "rank", "id", "size")).alias("x")).select(F.col("of").alias("x_of"), F.struct("x.rank", "x.id", "x.size").alias("closer"))
    filled = missing.join(closer, F.col("of").eqNullSafe(F.col("x_of")), "left").select(F.col("of").alias("r_of"), "rounds", "closer")
    decided = scratch.write(plan.join(filled, F.col("of").eqNullSafe(F.col("r_of")), "left").drop("r_of"), "decided")
    rows = decided.select(F.struct("*").alias("_plan"))
    out = docs.select(F.struct("*").alias("_doc"), F.col("doc_id").alias("doc_id"), size.alias("size"), unit.alias("u"), weight.alias("importance"))
    out = out.join(small_side(rows, n_sources), F.col("_doc.source").eqNullSafe(F.col("_plan.of")))
    out = ranked(out.select("_doc", "doc_id", "size", "u", "importance", "_plan.*"))
    taken = (F.col("rest") > 0) & (fits_a_round() | F.coalesce(F.struct("rank", "id", "size") == F.col("closer"), F.lit(False)))
    copies = F.col("whole") + F.coalesce(taken, F.lit(False)).cast("long")
    return out.select("_doc.*", F.struct("size", "source_size", "target", copies.alias("copies")).alias(name))

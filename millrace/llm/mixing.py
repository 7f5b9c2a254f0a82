"""Mixing sources to target weights by entropy balancing.

Each document gets a rate between 0 and 2 copies. Among all rates that give every source
its target words, the ones nearest to one copy each (in the entropy of a choice bounded by
0 and 2) are exponentially tilted: ``rate = 2 / (1 + exp(-lambda * size / mean size))``. The
multipliers ``lambda`` solve a convex dual, by Newton steps over the distinct sizes of each
source. Rates become whole copies by a hash of the document, cut where the source's words
come nearest to its target.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import WORD, dropped, saved, scalar

MOST = 2.0  # copies a document can have at most
SHARE = 1.5  # words of the mix, as a multiple of all words given
WEIGHTS = (3, 1, 2)  # of the sources in order, repeating
STEPS = 60  # Newton steps at most; bracketing alone reaches the tolerance before that
TOLERANCE = 1e-9
BINS = 4096
POOL = 64  # documents looked at for filling the last words of a source


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sources: DataFrame, share: float = SHARE, weights: tuple = WEIGHTS, most: float = MOST) -> DataFrame:
    """(source, words) with weight and target: shares by weight, cut at ``most`` times the source.

    Sources weigh ``weights`` in code point order, NULL last. What a source cannot take is
    shared again by weight. Filling in the order of limit / weight gives the fixed point of
    that repeated sharing at once. One row per source passes through one task.
    """
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (rank - 1) % len(weights) + 1)
    s = sources.withColumn("weight", weight).withColumn("most", most * F.col("words"))
    everything = Window.partitionBy()
    fill = Window.orderBy(F.col("most") / F.col("weight"), F.col("source").asc_nulls_last())
    earlier = fill.rowsBetween(Window.unboundedPreceding, -1)
    budget = share * F.sum("words").over(everything)
    left = budget - F.coalesce(F.sum("most").over(earlier), F.lit(0.0))
    weight_left = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(earlier), F.lit(0.0))
    s = s.withColumns({"budget": budget, "full": left / weight_left * F.col("weight") >= F.col("most")})
    rest = F.col("budget") - F.sum(F.when(F.col("full"), F.col("most")).otherwise(0.0)).over(everything)
    rest_weight = F.sum(F.when(F.col("full"), 0.0).otherwise(F.col("weight"))).over(everything)
    target = F.when(F.col("full"), F.col("most")).otherwise(rest * F.col("weight") / rest_weight)
    return s.select("source", "words", "weight", "full", target.alias("target"))


def _balanced(sizes: DataFrame, sources: DataFrame, most: float) -> DataFrame:
    """Adds each source's multiplier. ``sizes``: source, size, number of documents of that size."""
    mean = sizes.groupBy("source").agg((F.sum(F.col("size") * F.col("n")) / F.sum("n")).alias("mean"))
    state = sources.join(mean, sources["source"].eqNullSafe(mean["source"]), "left").drop(mean["source"])
    state = state.withColumns({"tilt": F.lit(0.0), "low": F.lit(-1024.0), "high": F.lit(1024.0), "off": F.lit(float("inf"))})
    state = saved(state, "mix-dual")
    for _ in range(STEPS):
        x = F.col("size") / F.col("mean")
        rate = most / (1 + F.exp(-F.col("tilt") * x))
        words = F.col("n") * F.col("size") * rate
        keyed = sizes.join(state.withColumnRenamed("source", "_s"), sizes["source"].eqNullSafe(F.col("_s")))
        slope = words * x * (1 - rate / most)
        sums = keyed.groupBy("source").agg(F.sum(words).alias("got"), F.sum(slope).alias("slope")).withColumnRenamed("source", "_s")
        step = state.join(sums, state["source"].eqNullSafe(sums["_s"]), "left").drop("_s")
        over = F.col("got") - F.col("target")
        step = step.withColumns({
            "low": F.when(over < 0, F.col("tilt")).otherwise(F.col("low")),
            "high": F.when(over > 0, F.col("tilt")).otherwise(F.col("high")),
            "off": F.when(F.col("full") | F.col("got").isNull(), 0.0).otherwise(F.abs(over) / F.greatest("target", F.lit(1.0))),
        })
        newton = F.col("tilt") - over / F.col("slope")
        inside = (F.col("slope") > 0) & (newton > F.col("low")) & (newton < F.col("high"))
        step = step.withColumn("tilt", F.when(F.col("off") < TOLERANCE, F.col("tilt")).when(inside, newton).otherwise((F.col("low") + F.col("high")) / 2))
        past, state = state, saved(step.drop("got", "slope"), "mix-dual")
        dropped(past)
        if (scalar(state.agg(F.max("off"))) or 0.0) < TOLERANCE:
            break
    return state.select("source", "words", "target", "full", "mean", "tilt")


def mix(
    docs: DataFrame, share: float = SHARE, weights: tuple = WEIGHTS, most: float = MOST,
    id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", carry: list[str] | None = None,
) -> DataFrame:
    """One row per document: ``carry`` columns (default: the id), ``_size``, ``_source_size``, ``_target``, ``_copies``.

    A document's size is its number of words (NULL or blank text: 0); documents of size 0
    have no copies. NULL is a source of its own. Copies are 0, 1 or 2, the same in every run:
    they follow from a hash of id and text. Rows that repeat in full are as good as each
    other, so it does not matter which of them gets a copy; only as many get one as fit. No rows: no rows.

    Per source, whole copies are given in hash order until the next would exceed the target;
    what is left is filled from the next ``POOL`` documents, largest first.
    """
    carry = [id_col] if carry is None else carry
    told = [c for c in carry if "map<" not in docs.schema[c].dataType.simpleString()]  # maps have no hash
    rows = docs.select(
        *[F.col(c).alias(f"_in_{i}") for i, c in enumerate(carry)], F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size"),
        F.col(id_col).alias("_id"), F.xxhash64(F.lit(17), F.col(id_col), F.col(text_col)).alias("_h"),
        F.xxhash64(F.lit(0), *told).alias("_same"), F.monotonically_increasing_id().alias("_row"),
    )
    rows = saved(rows, "mix-rows")  # from here on a row keeps its number
    sizes = saved(rows.where("size > 0").groupBy("source", "size").agg(F.count(F.lit(1)).alias("n")), "mix-sizes")
    # sources without any word keep their place in the order
    sources = rows.groupBy("source").agg(F.sum("size").alias("words"))
    state = _balanced(sizes, saved(targets(sources, share, weights, most), "mix-sources"), most).withColumnRenamed("source", "_s")

    tagged = rows.join(state, rows["source"].eqNullSafe(state["_s"])).drop("_s")
    rate = F.when(F.col("full"), most).otherwise(most / (1 + F.exp(-F.col("tilt") * F.col("size") / F.col("mean"))))
    tagged = tagged.withColumn("rate", F.when(F.col("size") > 0, rate).otherwise(0.0))
    tagged = tagged.withColumn("base", F.floor("rate"))
    # a rate of a long document may round to ``most``: then it has no room for another copy
    tagged = tagged.withColumn("free", F.when(F.col("base") < most, F.col("size")).otherwise(0))
    spread = F.shiftrightunsigned("_h", 11) / F.lit(float(2**53))
    tagged = tagged.withColumn("order", spread - (F.col("rate") - F.col("base")))
    tagged = tagged.withColumn("bin", F.floor((F.col("order") + 1) * (BINS // 2)))

    # words beyond the whole part of the rates go to the smallest ``order``, bin after bin
    some = tagged.groupBy("source", "bin").agg(F.sum("free").alias("words"), F.sum(F.col("size") * F.col("base")).alias("sure"), F.max("target").alias("target"))
    by_source, up_to = Window.partitionBy("source"), Window.partitionBy("source").orderBy("bin")
    some = some.withColumns({"open": F.col("target") - F.sum("sure").over(by_source), "so_far": F.sum("words").over(up_to)})
    cut = some.where("so_far > open").groupBy("source").agg(
        F.min("bin").alias("cut"), (F.min_by("open", "bin") - F.min_by(F.col("so_far") - F.col("words"), "bin")).alias("room")
    )
    cut = saved(cut, "mix-cut").withColumnRenamed("source", "_s")
    tagged = tagged.join(cut, tagged["source"].eqNullSafe(cut["_s"]), "left").drop("_s")
    key = ["order", "_h", "_id", "_same", "_row"]
    run = Window.partitionBy("source").orderBy(*key).rowsBetween(Window.unboundedPreceding, 0)
    here = tagged.where("bin = cut").withColumn("total", F.sum("free").over(run))
    here = saved(here.withColumn("taken", F.col("total") <= F.col("room")), "mix-here")
    taken = here.where("taken").drop("total", "taken")
    beyond = here.where("NOT taken").drop("total", "taken").unionByName(tagged.where("bin > cut"))
    # the rest of the room: of the next few documents, the largest that still fit
    gap = here.groupBy("source").agg(F.coalesce(F.max(F.when(F.col("taken"), F.col("total"))), F.lit(0)).alias("got"), F.max("room").alias("room"))
    next_up = beyond.where("free > 0").withColumn("_n", F.row_number().over(Window.partitionBy("source").orderBy(*key))).where(F.col("_n") <= POOL)
    pool = next_up.groupBy("source").agg(F.sort_array(F.collect_list(F.struct("size", *key)), asc=False).alias("pool"))
    pool = pool.withColumnRenamed("source", "_s").join(gap, F.col("_s").eqNullSafe(gap["source"]))
    empty = F.struct((F.col("room") - F.col("got")).alias("left"), F.filter("pool", lambda _: F.lit(False)).alias("in"))
    fit = lambda acc, x: F.when(x["size"] <= acc["left"], F.struct((acc["left"] - x["size"]).alias("left"), F.concat(acc["in"], F.array(x)).alias("in"))).otherwise(acc)
    chosen = pool.select("_s", F.explode(F.aggregate("pool", empty, fit, lambda acc: acc["in"])).alias("x"))
    chosen = saved(chosen.select(F.col("x._row").alias("_chosen")), "mix-chosen")
    beyond = beyond.join(chosen, F.col("_row") == F.col("_chosen"), "left")
    beyond = beyond.withColumn("extra", F.col("_chosen").isNotNull().cast("long")).drop("_chosen")
    sure = taken.unionByName(tagged.where("cut IS NULL OR bin < cut")).withColumn("extra", F.lit(1).cast("long"))
    copies = F.when(F.col("size") > 0, F.least(F.col("base") + F.col("extra"), F.lit(int(most)))).otherwise(F.lit(0))
    return sure.unionByName(beyond).select(
        *[F.col(f"_in_{i}").alias(c) for i, c in enumerate(carry)], F.col("size").alias("_size"), F.col("words").alias("_source_size"),
        F.col("target").alias("_target"), copies.cast("long").alias("_copies"),
    )

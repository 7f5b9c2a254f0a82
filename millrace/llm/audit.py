"""How filters interact: what each removes in every order, from one pass over a document-term matrix.

Row sums and numbers of nonzero entries of the sparse matrix (``term_matrix``) are the words
and distinct words of a document and decide filters A and B; C and D come from its bytes, E from
the least id of its text. A document's failures are five bits, and all counts of all orders
follow from how many documents of a part have each of the 32 patterns.
"""

from __future__ import annotations

from itertools import permutations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import saved
from millrace.llm.term_matrix import term_matrix

LETTERS = "ABCDE"
LEAST_WORDS = 200
LEAST_DISTINCT = 50  # percent of the words
MOST_UPPER = 2  # percent of the code points
SIGNS = "[#$%&*|]"


def _bit(letter: str) -> int:
    return 1 << LETTERS.index(letter)


def _byte_flags(text: pa.Array) -> pa.Array:
    """Failure bits of C and D of each text."""
    upper = pc.count_substring_regex(text, "[A-Z]").to_numpy(zero_copy_only=False).astype(np.int64)
    long = pc.utf8_length(text).to_numpy(zero_copy_only=False).astype(np.int64)
    signs = pc.match_substring_regex(text, SIGNS).to_numpy(zero_copy_only=False)
    mask = np.where(100 * upper > MOST_UPPER * long, _bit("C"), 0) | np.where(signs, _bit("D"), 0)
    return pa.array(mask.astype(np.int32))


def _row_flags(names: list[str]):
    """Rows of documents from the matrix: A by the row sum, B by the nonzero entries."""

    def run(batches):
        for batch in batches:
            for r in range(batch.num_rows):
                ends = np.frombuffer(batch.column("ends")[r].as_buffer(), "<i8")
                counts = np.frombuffer(batch.column("counts")[r].as_buffer(), "<u4")
                total = np.r_[0, np.cumsum(counts, dtype=np.int64)]
                words, distinct = total[ends[1:]] - total[ends[:-1]], np.diff(ends)
                mask = batch.column("measure")[r].values.to_numpy(zero_copy_only=False).astype(np.int32)
                mask = mask | np.where(words < LEAST_WORDS, _bit("A"), 0) | np.where(100 * distinct < LEAST_DISTINCT * words, _bit("B"), 0)
                columns = [batch.column(name)[r].values for name in names]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(mask.astype(np.int32))], [*names, "mask"])

    return run


def failure_bits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """(part, id, h1, h2, mask, n): documents by part, id and text (two hashes), the bits of filters A to E they fail, and how many rows are alike."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    carry = {
        "part": F.coalesce(F.col(part_col).cast("string"), F.lit("")),
        "id": F.col(id_col),
        "h1": F.xxhash64(text),
        "h2": F.xxhash64(F.lit(1), text),
    }
    names = list(carry)
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in docs.select(*[c.alias(name) for name, c in carry.items()]).schema.fields)
    matrix, _ = term_matrix(docs, carry, text_col, _byte_flags)
    rows = matrix.drop("shard", "terms").mapInArrow(_row_flags(names), f"{kinds}, mask int")
    rows = saved(rows.groupBy(*names, "mask").agg(F.count("*").alias("n")), "audit-rows")

    # the first document of a text passes E; joined by id too, so copies spread over the tasks
    first = rows.where("id IS NOT NULL").groupBy("h1", "h2").agg(F.min("id").alias("id")).withColumn("first", F.lit(True))
    named = rows.where("id IS NOT NULL").join(first, ["h1", "h2", "id"], "left")
    named = named.withColumn("mask", F.when(F.col("first"), F.col("mask")).otherwise(F.col("mask").bitwiseOR(F.lit(_bit("E")))))
    columns = ["part", "id", "h1", "h2", "mask", "n"]
    return named.select(columns).unionByName(rows.where("id IS NULL").select(columns))


def _sum(cells: Column, field: str, where) -> Column:
    zero = F.lit(0).cast("long")
    return F.aggregate(cells, zero, lambda total, x: total + F.when(where(x["mask"]), x[field]).otherwise(zero))


def filter_interactions(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """One row for each part, order of the filters and step: part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley.

    Filters are applied in order; each looks only at what is left. A: under 200 words. B: fewer
    than half of the words distinct. C: over 2 % of the code points A-Z. D: holds one of
    #$%&*|. E: the text is that of a smaller id, of any part, removed or not. NULL and empty
    texts fail A, pass B to D, and are one text for E; rows that repeat id and text count
    each and do not fail E by each other; a row without an id neither fails E nor makes another
    fail it. A part is a source, NULL being the empty string. A document is good or toxic when
    any label of its id says 1. Counts are of rows: kept and removed by the step, redundant
    (failing its filter, but removed before), unique_fails (failing only it), good_lost and
    toxic_lost of those removed, shapley (removed by its filter, summed over all 120 orders).
    No documents: no rows; no labels: nothing lost. Other columns do not matter.
    """
    rows = failure_bits(docs, id_col, text_col, part_col)
    marks = labels.groupBy(F.col("doc_id").alias("id")).agg(
        F.coalesce(F.max(F.col("quality") == 1), F.lit(False)).alias("good"), F.coalesce(F.max(F.col("toxic") == 1), F.lit(False)).alias("toxic")
    )
    marks = marks.where("id IS NOT NULL AND (good OR toxic)")
    cells = rows.where("id IS NOT NULL").join(marks, "id", "left").select("part", "mask", "n", "good", "toxic")
    nothing = F.lit(False)
    cells = cells.unionByName(rows.where("id IS NULL").select("part", "mask", "n", nothing.alias("good"), nothing.alias("toxic")))
    amount = lambda flag: F.coalesce(F.sum(F.when(F.col(flag), F.col("n"))), F.lit(0).cast("long")).alias(flag)
    cells = cells.groupBy("part", "mask").agg(F.sum("n").alias("n"), amount("good"), amount("toxic"))
    parts = saved(cells.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("cells")), "audit-parts")

    orders = F.lit(["".join(p) for p in permutations(LETTERS)])
    steps = parts.select("part", "cells", F.explode(orders).alias("filter_order"))
    steps = steps.select("*", F.explode(F.sequence(F.lit(1), F.lit(len(LETTERS)))).alias("step"))
    own = F.substring("filter_order", F.col("step"), F.lit(1))
    past = F.substring("filter_order", F.lit(1), F.col("step") - 1)
    own_bit = sum((F.when(own == x, F.lit(_bit(x))).otherwise(0) for x in LETTERS), F.lit(0))
    past_bits = sum((F.when(F.contains(past, F.lit(x)), F.lit(_bit(x))).otherwise(0) for x in LETTERS), F.lit(0))
    steps = steps.withColumns({"own": own_bit, "past": past_bits})
    own, past, cells = F.col("own"), F.col("past"), F.col("cells")
    fails = lambda m: m.bitwiseAND(own) != 0
    gone = lambda m: m.bitwiseAND(past) != 0
    here = lambda m: fails(m) & ~gone(m)
    zero = F.lit(0).cast("long")
    # of the 120 orders, a filter comes first among m failed ones in 120 / m
    share = F.aggregate(
        cells, zero, lambda total, x: total + F.when(fails(x["mask"]), x["n"] * (F.lit(120) / F.bit_count(x["mask"])).cast("long")).otherwise(zero)
    )
    return steps.select(
        "part", "filter_order", "step",
        _sum(cells, "n", lambda m: ~fails(m) & ~gone(m)).alias("kept"),
        _sum(cells, "n", here).alias("removed"),
        _sum(cells, "n", lambda m: fails(m) & gone(m)).alias("redundant"),
        _sum(cells, "n", lambda m: m == own).alias("unique_fails"),
        _sum(cells, "good", here).alias("good_lost"),
        _sum(cells, "toxic", here).alias("toxic_lost"),
        share.alias("shapley"),
    )

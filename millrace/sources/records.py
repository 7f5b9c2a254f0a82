"""Records that go on over several lines, put together without reading a file in one piece.

A line starts either between records or inside a quoted field, and what it leaves for the
next line depends on that: each line, each file split and each run of splits is a function on
these two states. One pass over the lines follows both possible states of its split at once
(they soon meet). A prefix scan over the splits of a file, one row each, then says which one
was real, and how many records started before; a record that crosses a split's end is put
together from its lines in both. Only lines of records of several lines are shuffled.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from millrace import session

MARKS = "file string, file_size bigint, file_modified_at timestamp, block_start bigint, _bytes binary, seq bigint"
STATES = "open_o boolean, open_q boolean, next_o boolean, next_q boolean, nth_o bigint, nth_q bigint"
SPLIT = ["file", "block_start"]
_BOM = "\ufeff".encode()


def line_patterns(delimiter: str, quote: str, trim: bool) -> tuple[re.Pattern, re.Pattern]:
    """Lines that end between records: when they start between records, and when they start inside a quoted field.

    A field is quoted when its first character is a quote (blanks may stand before it under
    ``trim``); a doubled quote is part of it, and what follows its closing quote, up to the
    delimiter, is taken as it is.
    """
    d, q = re.escape(delimiter.encode()), re.escape(quote.encode())
    plain = b"(?:(?!%b).)*+" % d
    blank = b"(?:(?!%b)[\\x00-\\x20])*+" % d if trim else b""
    inside = b"[^%b]*+(?:%b%b[^%b]*+)*+" % (q, q, q, q)
    field = b"(?>%b(?:%b%b%b%b|(?!%b)%b))" % (blank, q, inside, q, plain, q, plain)
    more = b"(?:%b%b)*+" % (d, field)
    return re.compile(field + more, re.DOTALL), re.compile(inside + q + plain + more, re.DOTALL)


def mark_lines(delimiter: str, quote: str, trim: bool, skip_mark: bool):
    """For lines in file order: their place in the split, and, for a split that starts between records (o) or in a
    quoted field (q), whether a line starts and ends inside one and how many records started up to it."""
    between, inside = line_patterns(delimiter, quote, trim)
    sign = quote.encode()

    def ends_open(line: bytes, is_open: bool) -> bool:
        return (inside if is_open else between).fullmatch(line) is None

    def run(batches):
        split, seq, state, nth = None, 0, [False, True], [0, 0]
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            lines, file, block = batch.column("_bytes"), batch.column("file"), batch.column("block_start")
            changes = np.ones(n, bool)
            differs = pc.or_(pc.not_equal(file[1:], file[:-1]), pc.not_equal(block[1:], block[:-1]))
            changes[1:] = differs.to_numpy(zero_copy_only=False)
            quoted = pc.fill_null(pc.match_substring(lines, sign), False).to_numpy(zero_copy_only=False)
            starts = np.flatnonzero(changes)
            out = {name: np.empty(n, bool) for name in ("open_o", "open_q", "next_o", "next_q")}
            out |= {name: np.empty(n, np.int64) for name in ("seq", "nth_o", "nth_q")}
            for at, end in zip(starts.tolist(), np.r_[starts[1:], n].tolist(), strict=True):
                here = (file[at].as_py(), block[at].as_py())
                if here != split:
                    split, seq, state, nth = here, 0, [False, True], [0, 0]
                last = at
                marked = (at + np.flatnonzero(quoted[at:end])).tolist()
                for i in [*marked, end]:
                    for k, name in enumerate("oq"):  # lines without a quote leave the state as it is
                        out[f"open_{name}"][last : min(i + 1, end)] = state[k]
                        out[f"next_{name}"][last:i] = state[k]
                    if i == end:
                        break
                    line = lines[i].as_py()
                    if skip_mark and here[1] == 0 and seq + i - at == 0:
                        line = line.removeprefix(_BOM)
                    first = ends_open(line, state[0])
                    state = [first, first if state[0] == state[1] else ends_open(line, state[1])]
                    out["next_o"][i], out["next_q"][i] = state
                    last = i + 1
                out["seq"][at:end] = np.arange(seq, seq + end - at)
                seq += end - at
                for k, name in enumerate("oq"):
                    out[f"nth_{name}"][at:end] = nth[k] + np.cumsum(~out[f"open_{name}"][at:end])
                    nth[k] = int(out[f"nth_{name}"][end - 1])
            names = [field.split()[0] for field in f"{MARKS}, {STATES}".split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array(out[name]) if name in out else batch.column(name) for name in names], names)

    return run


def split_states(marked: DataFrame) -> DataFrame:
    """For each split of a file: whether it starts inside a quoted field, and the records started before it."""
    last = F.max_by(F.struct("next_o", "next_q", "nth_o", "nth_q"), "seq").alias("end")
    ends = marked.groupBy(*SPLIT).agg(last).select(*SPLIT, "end.*")
    in_file = Window.partitionBy("file").orderBy("block_start")
    before = in_file.rowsBetween(Window.unboundedPreceding, -1)
    # a split either forgets the state it starts with, keeps it or turns it round
    fixed = F.col("next_o") == F.col("next_q")
    turns = F.sum((F.col("next_o") & ~F.col("next_q")).cast("long")).over(in_file.rowsBetween(Window.unboundedPreceding, 0))
    ends = ends.withColumn("turns", turns)
    ends = ends.withColumn("fix", F.when(fixed, F.struct(F.col("next_o").alias("open"), "turns")))
    ends = ends.withColumns({"fix": F.last("fix", ignorenulls=True).over(before), "turned": F.lag("turns", 1, 0).over(in_file)})
    turned = (F.col("turned") - F.coalesce("fix.turns", F.lit(0))) % 2 == 1
    ends = ends.withColumn("open", F.coalesce("fix.open", F.lit(False)) != turned)
    begun = F.sum(F.when(F.col("open"), F.col("nth_q")).otherwise(F.col("nth_o"))).over(before)
    return ends.select(*SPLIT, F.col("open").alias("_starts_open"), F.coalesce(begun, F.lit(0)).alias("_begun"))


def records(lines: DataFrame, fmt, folder: str) -> DataFrame:
    """Records of undecoded lines in file order: the lineage columns, _lines (their bytes in order) and _long.

    ``seq`` numbers the records of a file from 1, and ``block_start`` is the split that a record
    starts in. A record of more than ``fmt.most_record_bytes``, such as the rest of a file
    after a quote that is never closed, is _long and keeps its first line only. ``folder``
    takes two tables, which the result reads.
    """
    marks = mark_lines(fmt.delimiter, fmt.quote, fmt.trim, fmt.skip_byte_order_mark)
    marked = session.written(lines.mapInArrow(marks, f"{MARKS}, {STATES}"), f"{folder}/marks")
    with session.usual_splits(marked.sparkSession):
        states = session.written(split_states(marked), f"{folder}/states")
    found = marked.join(states, SPLIT)
    real = lambda name: F.when(F.col("_starts_open"), F.col(f"{name}_q")).otherwise(F.col(f"{name}_o"))
    found = found.select(
        *SPLIT, "file_size", "file_modified_at", "_bytes", F.col("seq").alias("_at"), (F.col("_begun") + real("nth")).alias("seq"),
        real("open").alias("_open"), real("next").alias("_next"),
    )
    columns = ["file", "file_size", "file_modified_at", "block_start", "seq"]
    whole = found.where("NOT _open AND NOT _next")
    whole = whole.select(*columns, F.array("_bytes").alias("_lines"), F.lit(False).alias("_long"))

    parts = found.where("_open OR _next")
    sizes = parts.groupBy("file", "seq").agg(F.sum(F.octet_length("_bytes") + 1).alias("size"))
    fits = F.col("size") <= fmt.most_record_bytes
    parts = parts.join(sizes.select("file", "seq", (~fits).alias("_long")), ["file", "seq"])
    place = F.struct("block_start", "_at", F.col("_bytes").alias("line"))
    gathered = parts.where("NOT _long OR NOT _open").groupBy("file", "seq").agg(
        F.any_value("file_size").alias("file_size"), F.any_value("file_modified_at").alias("file_modified_at"),
        F.array_sort(F.collect_list(place)).alias("_parts"), F.bool_or("_long").alias("_long"),
    )
    gathered = gathered.select(
        "file", "file_size", "file_modified_at", F.col("_parts")[0]["block_start"].alias("block_start"), "seq", F.col("_parts.line").alias("_lines"), "_long"
    )
    return whole.unionByName(gathered)

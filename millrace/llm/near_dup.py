"""Near-duplicate documents by HyperMinHash registers, with every link checked on full sets.

A document is its set of word shingles. One hash per shingle picks one of 128 buckets; a
bucket keeps the leading zeros of its smallest hash and the mantissa bits after them. Four
registers make a band; documents that agree in a band become candidates. Documents with
equal sets are one class from the start, whatever their number.

Bands link each class to the first class of the bucket, the one with the most copies, so a bucket of n classes gives
n - 1 edges. Components of these edges are groups in which all links must lie. Small groups
are settled in one task. In large ones each class is first checked with the first it
shares a band with; classes that these checks join need no further comparison with each
other. A class is then compared, block by block, with those classes of other components that
it shares a band with.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import dropped, partitions, pruned_joins, saved, scalar, trimmed, trimmed_group
from millrace.llm.components import components
from millrace.llm.words import mix, shingle_sets

BUCKET_BITS = 7
MANTISSA = 24
ROWS = 4  # registers to a band: 32 bands, which miss a pair at 0.8 in 5 cases of 10^8
SMALL_GROUP = 256  # classes compared in one task; larger groups take the way above
CHUNK = 256  # classes checked beside one copy of their hub
BLOCK = 1024  # classes to a block; a class goes to as many tasks as its group has blocks
BUCKET = 512  # classes a task should hold
COMPARED = 1 << 15  # pairs estimated at once
COLUMNS = 8192  # elements to a product of set memberships
SPREAD = 5.0  # standard errors that an estimate may lie below the threshold


def registers(sets: list[np.ndarray]) -> np.ndarray:
    """HyperMinHash registers, one row per sorted set: 0 if the bucket is empty."""
    out = np.zeros((len(sets), 1 << BUCKET_BITS), np.uint32)
    sizes = np.array([len(s) for s in sets], np.int64)
    if not sizes.sum():
        return out
    h, row = np.concatenate(sets), np.repeat(np.arange(len(sets)), sizes)
    bucket = (h >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)
    cell = (row << BUCKET_BITS) | bucket
    first = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]])  # sorted: the smallest of its bucket
    rest = h[first] << np.uint64(BUCKET_BITS)
    zeros = np.where(rest > 0, 53 - np.frexp((rest >> np.uint64(11)).astype(np.float64))[1], 64 - BUCKET_BITS).astype(np.uint64)
    zeros = np.minimum(zeros, np.uint64(64 - BUCKET_BITS))
    tail = (rest << zeros << np.uint64(1)) >> np.uint64(64 - MANTISSA)
    out.reshape(-1)[cell[first]] = ((zeros << np.uint64(MANTISSA)) | tail) + np.uint64(1)
    return out


def band_keys(regs: np.ndarray) -> np.ndarray:
    """One 64-bit key per band, the band's number included; 0 where all its registers are empty."""
    r = regs.reshape(len(regs), -1, ROWS).astype(np.uint64)
    key = np.broadcast_to(np.arange(1, r.shape[1] + 1, dtype=np.uint64), r.shape[:2])
    for j in range(ROWS):
        key = mix(key * np.uint64(0x9E3779B97F4A7C15) + r[:, :, j])
    return np.where(r.any(axis=2), key, np.uint64(0)).view(np.int64)


def estimate(regs: np.ndarray, other: np.ndarray, sizes: np.ndarray, size) -> tuple[np.ndarray, np.ndarray]:
    """Jaccard estimates of rows against one other, or row by row against others, less the matches expected by chance, and their standard errors at 0.8."""
    used = ((regs > 0) | (other > 0)).sum(axis=1)
    alike = ((regs == other) & (regs > 0)).sum(axis=1)
    # expected chance matches of HyperMinHash registers; the factor is the published constant
    chance = 0.1699194871597391 * 2.0 ** (BUCKET_BITS - MANTISSA) * 4.0 * sizes * size / (sizes + size) ** 2.0
    used = np.maximum(used, 1)
    return (alike - chance) / used, np.sqrt(0.16 / used)


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """100 * intersection >= percent * union, on sorted sets."""
    small, large = (a, b) if len(a) < len(b) else (b, a)
    if 100 * len(small) < percent * len(large):
        return False
    at = np.searchsorted(large, small)
    both = int((large[np.minimum(at, len(large) - 1)] == small).sum())
    return 100 * both >= percent * (len(a) + len(b) - both)


def _signed(batches, size: int):
    for batch in batches:
        sets = list(shingle_sets(batch.column("text"), size))
        regs = registers(sets)
        prints = [xxhash.xxh3_128_digest(s.tobytes()) for s in sets]
        yield batch, sets, regs, prints


def _describe(size: int):
    def run(batches):
        for batch, sets, regs, prints in _signed(batches, size):
            keys = band_keys(regs)
            cuts = np.arange(0, keys.size + 1, keys.shape[1], dtype=np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"), batch.column("th"), pa.array([len(s) for s in sets], pa.int64()),
                    pa.array(prints, pa.binary()), pa.ListArray.from_arrays(pa.array(cuts), pa.array(keys.reshape(-1))),
                ],
                ["id", "th", "n", "print", "keys"],
            )

    return run


def _sets(size: int):
    """Sets of the texts whose fingerprint is the expected one."""

    def run(batches):
        for batch, sets, _, prints in _signed(batches, size):
            want = batch.column("print").to_pylist()
            ok = [i for i, p in enumerate(prints) if p == want[i]]
            if ok:
                rows = batch.take(pa.array(ok))
                data = pa.array([sets[i].tobytes() for i in ok], pa.binary())
                yield pa.RecordBatch.from_arrays([rows.column("print"), rows.column("grp"), data], ["print", "grp", "set"])

    return run


def _unpacked(table: pa.Table):
    prints = table["print"].to_pylist()
    keep = list({p: i for i, p in enumerate(prints)}.values())  # a class can come from repeated rows
    keep.sort(key=prints.__getitem__)  # any order that does not depend on the shuffle
    table = table.take(pa.array(keep, pa.int64()))
    sets = [np.frombuffer(s, np.uint64) for s in table["set"].to_pylist()]
    return table, sets, registers(sets), np.array([len(s) for s in sets], np.int64)


def _agree(keys: np.ndarray) -> np.ndarray:
    """Which rows agree in one of the given bands."""
    together = np.zeros((len(keys), len(keys)), bool)
    for band in keys.T:
        order = np.argsort(band, kind="stable")
        ordered = band[order]
        bounds = np.r_[np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]]), len(band)]
        for i in np.flatnonzero((np.diff(bounds) > 1) & (ordered[bounds[:-1]] != 0)).tolist():
            some = order[bounds[i] : bounds[i + 1]]
            together[some[:, None], some] = True
    return together


def _near(regs: np.ndarray, sizes: np.ndarray, share: float, pairs: np.ndarray, band: int) -> tuple[np.ndarray, np.ndarray]:
    """Which of the wanted pairs agree in a band and may reach ``share`` by their registers.

    In the bucket of one band, all agree in that band; pairs that agree in an earlier one are
    left to the bucket of that.
    """
    keys = band_keys(regs)
    together = _agree(keys) if band == ANY_BAND else ~_agree(keys[:, :band])
    x, y = np.nonzero(together & pairs)
    keep = np.zeros(len(x), bool)
    for a in range(0, len(x), COMPARED):
        part = slice(a, a + COMPARED)
        guess, error = estimate(regs[x[part]], regs[y[part]], sizes[x[part]], sizes[y[part]])
        keep[part] = guess >= share - SPREAD * error
    return x[keep], y[keep]


def _joined(x: np.ndarray, y: np.ndarray, n: int) -> np.ndarray:
    """Smallest position reachable from each of ``n`` along the pairs."""
    label = np.arange(n)
    while True:
        low = label.copy()
        np.minimum.at(low, x, label[y])
        np.minimum.at(low, y, label[x])
        low = low[low]
        if (low == label).all():
            return label
        label = low


def intersections(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all pairwise intersections, by products over the elements that more than one set holds."""
    row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, column, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    several = times[column] > 1
    row, column = row[several], np.unique(column[several], return_inverse=True)[1]
    out = np.zeros((len(sets), len(sets)), np.float64)
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    for a in range(0, int(column[-1]) + 1 if len(column) else 0, COLUMNS):
        first, last = np.searchsorted(column, [a, a + COLUMNS])
        part = np.zeros((len(sets), COLUMNS), np.float32)
        part[row[first:last], column[first:last] - a] = 1
        out += part @ part.T
    return out


def _group_links(table: pa.Table, across: bool, percent: int) -> list[tuple[bytes, bytes]]:
    """Edges that join what is linked within a group, or between two blocks of it."""
    table, sets, regs, sizes = _unpacked(table)
    prints, block = table["print"].to_pylist(), table["block"].to_numpy()
    names: dict[bytes, int] = {}
    comp = np.array([names.setdefault(c, len(names)) for c in table["comp"].to_pylist()])
    pairs = np.triu(comp[:, None] != comp[None, :], 1)
    if across:
        pairs &= block[:, None] != block[None, :]
    x, y = _near(regs, sizes, percent / 100, pairs, table["band"][0].as_py())
    found = []
    family = _joined(x, y, len(sets))
    by_family = np.argsort(family[x], kind="stable")
    x, y = x[by_family], y[by_family]
    bounds = np.r_[np.flatnonzero(np.r_[True, family[x][1:] != family[x][:-1]]), len(x)].tolist() if len(x) else []
    for a, b in zip(bounds, bounds[1:], strict=False):
        some, place = np.unique(np.r_[x[a:b], y[a:b]], return_inverse=True)
        i, j = place[: b - a], place[b - a :]
        both = intersections([sets[k] for k in some])[i, j]
        sure = 100 * both >= percent * (sizes[some[i]] + sizes[some[j]] - both)
        label = _joined(i[sure], j[sure], len(some))
        found += [(prints[some[k]], prints[some[m]]) for k, m in enumerate(label.tolist()) if k != m]
    return found


def _links_of(percent: int):
    """``_group_links`` of all the groups of a bucket."""

    def run(table):
        table = table.sort_by([("grp", "ascending"), ("i", "ascending"), ("j", "ascending")]).combine_chunks()
        grp, i, j = (table[c].to_numpy() for c in ("grp", "i", "j"))
        fresh = np.r_[True, (grp[1:] != grp[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])]
        bounds = np.r_[np.flatnonzero(fresh), len(grp)].tolist()
        found = [p for a, b in zip(bounds, bounds[1:], strict=False) for p in _group_links(table.slice(a, b - a), i[a] != j[a], percent)]
        return pa.table({"a": pa.array([a for a, _ in found], pa.binary()), "b": pa.array([b for _, b in found], pa.binary())})

    return run


def _in_buckets(work: DataFrame, keys: list[str], function, percent: int, rows: int) -> DataFrame:
    """Edges found by ``function`` on buckets of whole groups; compute, not bytes, decides their number."""
    spark = work.sparkSession
    buckets = rows // BUCKET + 1
    work = work.withColumn("bucket", F.pmod(F.xxhash64(*keys), F.lit(buckets))).repartition(min(buckets, 4 * partitions(spark)), "bucket")
    return work.groupBy("bucket").applyInArrow(trimmed_group(function(percent)), EDGE)


def _star_links(percent: int):
    """Links between hubs and the classes dealt to the same chunks of their edges."""

    def run(table):
        table = table.sort_by([("at", "ascending"), ("chunk", "ascending")]).combine_chunks()
        at, chunk = table["at"].to_numpy(), table["chunk"].to_numpy()
        bounds = np.r_[np.flatnonzero(np.r_[True, (at[1:] != at[:-1]) | (chunk[1:] != chunk[:-1])]), len(at)].tolist()
        found = []
        for a, b in zip(bounds, bounds[1:], strict=False):
            part, sets, regs, sizes = _unpacked(table.slice(a, b - a))
            prints, hub = part["print"].to_pylist(), part["hub"].to_numpy(zero_copy_only=False)
            for h in np.flatnonzero(hub).tolist():
                guess, error = estimate(regs, regs[h], sizes, sizes[h])
                for w in np.flatnonzero(~hub & (guess >= percent / 100 - SPREAD * error)).tolist():
                    if linked(sets[h], sets[w], percent):
                        found.append((prints[h], prints[w]))
        return pa.table({"a": pa.array([a for a, _ in found], pa.binary()), "b": pa.array([b for _, b in found], pa.binary())})

    return run


NO_ID = 2**63 - 1
ANY_BAND = -1
EDGE = "a binary, b binary"


def near_duplicates(docs: DataFrame, shingle: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: its id, ``_th`` (hash of the text), ``_n`` (set size), ``_component``.

    Two documents are linked when their sets of ``shingle``-word shingles have a Jaccard index
    of ``percent`` / 100 or more; words are runs of non-blank bytes, A-Z lower-cased. A
    component is named by its smallest id. Texts with fewer words are one shingle; NULL and
    blank texts have an empty set, are linked with nothing and are their own component. Rows
    without an id take part; a component of only such rows has no name (NULL). Rows that repeat
    are copies of each other. No rows: no rows.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(F.col(text_col)).alias("th"), F.col(text_col).cast("string").alias("text"))
    signed = rows.mapInArrow(trimmed(_describe(shingle)), "id long, th long, n long, print binary, keys array<long>")
    signed = saved(signed, "near-signed")
    # equal sets are one class, and one of its texts stands for it. Its number orders classes by
    # their copies, then by id: the texts copied most are the likeliest centres of a group. Two
    # classes that share a number are only compared needlessly
    classes = signed.where("n > 0").groupBy("print").agg(
        F.min("id").alias("first"), F.min(F.struct(F.coalesce("id", F.lit(NO_ID)).alias("id"), "th")).alias("text"), F.first("keys").alias("keys"),
        F.count("*").alias("copies"),
    )
    rank = F.shiftleft(32767 - F.least("copies", F.lit(32767)), 48)
    number = rank + F.pmod(F.coalesce("first", F.xxhash64("print")), F.lit(1 << 48))
    classes = saved(classes.withColumn("node", number).drop("copies"), "near-classes")
    bands = classes.select("node", F.explode("keys").alias("key")).where("key <> 0")
    hubs = bands.groupBy("key").agg(F.min("node").alias("hub"), F.count("*").alias("n")).where("n > 1")
    hubs = saved(hubs, "near-hubs")
    with pruned_joins(spark):
        star = saved(bands.join(hubs.where("n > 1").select("key", "hub"), "key").where("node <> hub").select("node", "hub").distinct(), "near-star")
    dropped(hubs)
    groups = components(star.select(F.col("node").alias("a"), F.col("hub").alias("b")), "near-groups")

    members = classes.select("print", "text", "node").join(groups, "node").withColumnRenamed("root", "grp")
    counted = members.groupBy("grp").agg(F.count("*").alias("size"))
    members = saved(members.join(counted, "grp"), "near-members")

    def sets_of(some: DataFrame) -> DataFrame:
        texts = rows.select(F.coalesce("id", F.lit(NO_ID)).alias("id"), "th", "text")
        # rows that repeat id and text are one text
        texts = texts.join(some.select("print", "grp", "text.id", "text.th"), ["id", "th"]).dropDuplicates(["id", "th"])
        return texts.select("text", "print", "grp").mapInArrow(trimmed(_sets(shingle)), "print binary, grp long, set binary")

    with pruned_joins(spark):
        small = sets_of(members.where(F.col("size") <= SMALL_GROUP))
        small = small.select("grp", F.lit(0).alias("i"), F.lit(0).alias("j"), "print", "set", F.col("print").alias("comp"), F.lit(0).alias("block"), F.lit(ANY_BAND).alias("band"))
        rows_small = scalar(members.where(F.col("size") <= SMALL_GROUP).agg(F.count("*")))
        links = saved(_in_buckets(small, ["grp", "i", "j"], _links_of, percent, rows_small), "near-links")
        large = members.where(F.col("size") > SMALL_GROUP)
        if not large.isEmpty():
            sets = saved(sets_of(large), "near-sets")
            links = links.unionByName(_large_groups(large, sets, star, classes, percent))
            dropped(sets)

    joined = components(links, "near-components")
    named = classes.select("print", "first").join(joined.withColumnRenamed("node", "print"), "print", "left")
    named = named.withColumn("root", F.coalesce("root", "print"))
    names = named.groupBy("root").agg(F.min("first").alias("_component"))
    named = named.join(names, "root").select("print", "_component")
    out = signed.select("id", "th", "n", "print").join(named, "print", "left")
    component = F.when(F.col("n") > 0, F.col("_component")).otherwise(F.col("id"))
    return out.select(F.col("id").alias(id_col), F.col("th").alias("_th"), F.col("n").alias("_n"), component.alias("_component"))


def _large_groups(members: DataFrame, sets: DataFrame, star: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Links within the groups too large for one task.

    Tasks are laid out on the names of the classes; sets join them once per step.
    """
    spark = members.sparkSession
    place = lambda n: F.pmod(F.xxhash64("print"), n).cast("int")
    # 1: check each class with its smallest hub, the hub's set beside each chunk of its classes
    edges = members.select("print", "node").join(star.groupBy("node").agg(F.min("hub").alias("at")), "node")
    sizes = edges.groupBy("at").agg(F.ceil(F.count("*") / CHUNK).cast("int").alias("chunks"))
    ends = edges.join(sizes, "at").select("print", "at", place(F.col("chunks")).alias("chunk"), F.lit(False).alias("hub"))
    hubs = members.select("print", F.col("node").alias("at")).join(sizes, "at")
    hubs = hubs.select("print", "at", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"), F.lit(True).alias("hub"))
    tasks = saved(ends.unionByName(hubs), "near-tasks")
    work = sets.select("print", "set").join(tasks, "print")
    sure = saved(_in_buckets(work, ["at", "chunk"], _star_links, percent, tasks.count()), "near-sure")

    # 2: what these links join is one component; a link still missing joins two components that
    # meet in the bucket of a band, so only buckets of several components are compared
    roots = components(sure, "near-sure").withColumnRenamed("node", "print")
    placed = members.select("print").join(roots, "print", "left").withColumn("root", F.coalesce("root", "print"))
    keyed = placed.join(classes.select("print", "keys"), "print").select("print", "root", F.posexplode("keys").alias("band", "grp")).where("grp <> 0")
    keyed = saved(keyed, "near-placed")
    mark = F.xxhash64("root")
    mixed = keyed.groupBy("grp").agg(F.min(mark).alias("low"), F.max(mark).alias("high"), F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    mixed = mixed.where("low <> high").select("grp", "blocks")
    tasks = keyed.join(mixed, "grp").withColumn("block", place(F.col("blocks")))
    with_all = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda j: F.struct(F.least("block", j).alias("i"), F.greatest("block", j).alias("j")))
    tasks = tasks.withColumn("task", F.explode(with_all))
    tasks = saved(tasks.select("grp", F.col("task.i").alias("i"), F.col("task.j").alias("j"), "print", F.col("root").alias("comp"), "block", "band"), "near-tasks")
    work = sets.select("print", "set").join(tasks, "print")
    more = saved(_in_buckets(work, ["grp", "i", "j"], _links_of, percent, tasks.count()), "near-more")
    return sure.unionByName(more)

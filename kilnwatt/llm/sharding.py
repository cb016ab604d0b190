"""Sharding by a k-d tree: split at distributed weighted medians along the widest metadata dimension.

Only metadata is moved: ids, sizes, checksums and coordinates are written once, and every median is found by counting
bytes per bin and node on the executors. What reaches the driver is at most `BINS` sums per node and pass; the number
of passes depends on the width of the numbers, not on the number of rows.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kilnwatt.llm.common import numbered, phase, salts_for, table

#: Bins per node and pass of a median search.
BINS = 4096
#: Rows that tie in the cut's dimension and in their checksum (equal texts) stay together if the split then misses its
#: share by no more than this part of the node's bytes; a heavier group is cut by doc_id.
KEEP_TOGETHER = 0.0025
DIMENSIONS = ("d_size", "d_lang", "d_source")
#: Compared in this order where the dimension of a cut ties.
TIES = ("text_crc32", "d_id")


@dataclass(frozen=True)
class Cut:
    """Rows of `node` whose (dimension, checksum, id) is at most `at` go left; `left` and `right` are leaves below."""

    node: int
    dimension: str
    at: tuple[int, int, int]


def metadata(docs: DataFrame) -> DataFrame:
    """One row per document: id, size (UTF-8 bytes plus 1; null text: 1), checksum (null text: 0) and the dimensions.

    Null language, source and id count as a value of their own below all others. Further columns are left out.
    """
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 1
    code = lambda c: F.coalesce(F.crc32(F.col(c).cast("binary")), F.lit(-1).cast("long"))
    return docs.select(
        "doc_id",
        size.alias("size"),
        F.coalesce(F.crc32(F.col("text").cast("binary")), F.lit(0).cast("long")).alias("text_crc32"),
        size.alias("d_size"),
        code("lang").alias("d_lang"),
        code("source").alias("d_source"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63))).alias("d_id"),
    )


def weighted_cut(rows: DataFrame, column: str, wanted: dict[int, float]) -> dict[int, tuple[int, int, int]]:
    """For each node the least value v of `column` at which the bytes of rows <= v reach `wanted`.

    Returns (v, bytes below v, bytes at v). `rows` has node, size and `column`; each pass narrows the interval of
    every node to one bin of `BINS`.
    """
    found: dict[int, tuple[int, int, int]] = {}
    ends = rows.filter(F.col("node").isin(list(wanted))).groupBy("node").agg(F.min(column), F.max(column)).collect()
    spans = {n: (lo, hi, 0) for n, lo, hi in ends}
    while spans:
        steps = {n: max(1, -(-(hi - lo + 1) // BINS)) for n, (lo, hi, _) in spans.items()}
        bounds = rows.sparkSession.createDataFrame(
            [(n, lo, hi, steps[n]) for n, (lo, hi, _) in spans.items()], "_n int, _lo long, _hi long, _step long"
        )
        inside = rows.join(F.broadcast(bounds), (F.col("node") == F.col("_n")) & F.col(column).between(F.col("_lo"), F.col("_hi")))
        # The first interval may span more than a long holds, so the distance is taken as a decimal.
        binned = inside.groupBy("node", F.floor((F.col(column).cast("decimal(20,0)") - F.col("_lo")) / F.col("_step")).cast("int").alias("bin"))
        sums: dict[int, list[tuple[int, int]]] = {}
        for n, b, w in binned.agg(F.sum("size")).collect():
            sums.setdefault(n, []).append((b, w))
        following = {}
        for n, (lo, hi, below) in spans.items():
            for b, w in sorted(sums[n]):
                if below + w >= wanted[n] or b == max(x for x, _ in sums[n]):
                    start, end = lo + b * steps[n], min(hi, lo + (b + 1) * steps[n] - 1)
                    if steps[n] == 1:
                        found[n] = (start, below, w)
                    else:
                        following[n] = (start, end, below)
                    break
                below += w
        spans = following
    return found


def split(meta: DataFrame, leaves: int) -> DataFrame:
    """Add `shard` (0 to leaves - 1, from left to right) to a written metadata table.

    Each node is split along the dimension whose extent, relative to the root's, is widest, so that its bytes divide in
    proportion to the leaves on either side. An empty table has no rows and no shards.
    """
    extent = [f(c).alias(f"{c}_{n}") for c in DIMENSIONS for n, f in (("lo", F.min), ("hi", F.max))]
    rows = meta.withColumn("node", F.lit(0))
    counts = {0: leaves}
    first = {0: 0}
    root: dict[str, int] = {}
    while any(k > 1 for k in counts.values()):
        active = [n for n, k in counts.items() if k > 1]
        shapes = {r["node"]: r for r in rows.filter(F.col("node").isin(active)).groupBy("node").agg(F.sum("size").alias("w"), *extent).collect()}
        if not shapes:
            break
        root = root or {c: max(1, shapes[0][f"{c}_hi"] - shapes[0][f"{c}_lo"]) for c in DIMENSIONS}
        widest = {n: max(DIMENSIONS, key=lambda c: ((s[f"{c}_hi"] - s[f"{c}_lo"]) / root[c], -DIMENSIONS.index(c))) for n, s in shapes.items()}  # noqa: B023
        cuts = _cuts(rows, shapes, widest, counts)
        below, starts = {}, {}
        for n, k in counts.items():
            if n in shapes:
                below |= {2 * n + 1: k // 2, 2 * n + 2: k - k // 2}
                starts |= {2 * n + 1: first[n], 2 * n + 2: first[n] + k // 2}
            elif k == 1:
                below[n], starts[n] = k, first[n]
        counts, first = below, starts
        rows = _descend(rows, cuts)
    shards = meta.sparkSession.createDataFrame([(n, s) for n, s in first.items()], "_n int, shard int")
    return rows.join(F.broadcast(shards), F.col("node") == F.col("_n")).drop("node", "_n")


def _cuts(rows: DataFrame, shapes: dict, widest: dict[int, str], counts: dict[int, int]) -> list[Cut]:
    least, most = -(2**63), 2**63 - 1  # a null id is the least
    wanted = {n: s["w"] * (counts[n] // 2) / counts[n] for n, s in shapes.items()}
    at: dict[int, list[int]] = {}
    held = rows
    active = dict(wanted)
    value = F.lit(None).cast("long")
    for n, c in widest.items():
        value = F.when(F.col("node") == n, F.col(c)).otherwise(value)
    held = held.withColumn("_cut", value)
    for column in ("_cut", *TIES):
        if not active:
            break
        found = weighted_cut(held, column, active)
        following = {}
        for n, (v, below, here) in found.items():
            slack = KEEP_TOGETHER * shapes[n]["w"]
            at.setdefault(n, [])
            if column != "d_id" and below + here - active[n] > slack and active[n] - below > slack:
                at[n].append(v)
                following[n] = active[n] - below
            elif below + here - active[n] <= active[n] - below:
                at[n] += [v, *[most] * (2 - len(at[n]))]
            elif column == "_cut":
                at[n] += [v, -1, most]  # checksums are not negative
            elif column == TIES[0]:
                at[n] += [v - 1, most]
            elif v > least:
                at[n].append(v - 1)
            else:  # below the least id there are the smaller checksums only
                at[n] = [at[n][0], at[n][1] - 1, most]
        active = following
        if active:
            tied = rows.sparkSession.createDataFrame([(n, at[n][-1]) for n in active], "_t int, _v long")
            held = held.join(F.broadcast(tied), (F.col("node") == F.col("_t")) & (F.col(column) == F.col("_v"))).drop("_t", "_v")
    return [Cut(n, widest[n], tuple(v)) for n, v in at.items()]


def _descend(rows: DataFrame, cuts: Iterable[Cut]) -> DataFrame:
    frame = rows.sparkSession.createDataFrame([(c.node, c.dimension, *c.at) for c in cuts], "_n int, _dim string, _a long, _b long, _c long")
    value: Column = F.lit(None).cast("long")
    for c in DIMENSIONS:
        value = F.when(F.col("_dim") == c, F.col(c)).otherwise(value)
    joined = rows.join(F.broadcast(frame), F.col("node") == F.col("_n"), "left").withColumn("_x", value)
    left = (F.col("_x") < F.col("_a")) | (
        (F.col("_x") == F.col("_a")) & ((F.col(TIES[0]) < F.col("_b")) | ((F.col(TIES[0]) == F.col("_b")) & (F.col(TIES[1]) <= F.col("_c"))))
    )
    node = F.when(F.col("_n").isNull(), F.col("node")).otherwise(2 * F.col("node") + F.when(left, 1).otherwise(2))
    return joined.withColumn("node", node.cast("int")).drop("_n", "_dim", "_a", "_b", "_c", "_x")


def shard(docs: DataFrame, shards: int | None = None, target_bytes: int | None = None) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot): give `shards`, or `target_bytes` that a leaf should reach.

    Sizes of the shards are near equal (law `bytes`): a split misses its share by at most `KEEP_TOGETHER` of the node
    or half a row. Slots count from 0 without gaps within a shard. Repeated rows are rows of their own.
    """
    meta = phase(metadata(docs), "shard-meta")
    total = meta.agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("w")).first()
    if shards is None:
        shards = max(1, -(-(total["w"] or 0) // (target_bytes or 1 << 30)))
    placed = phase(split(meta, shards).select("doc_id", "size", "text_crc32", "shard"), "shard-leaves")
    return numbered(placed, "shard", ["doc_id", "text_crc32"], "slot", F.xxhash64("doc_id", "text_crc32"), salts_for(total["n"] // shards))


def op10_kd_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in shards 0 to 7 of near equal bytes."""
    out = shard(table(spark, sf_dir, "documents"), shards=8)
    return out.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard")
    )

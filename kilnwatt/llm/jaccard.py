"""Exact Jaccard join of shingle sets in their metric space.

Distances between unrelated texts crowd near 1, so cells around pivot documents alone would replicate everything
everywhere (two radii are wider than the spread of the distances). The first pivots are therefore shares of the shingle
space: two sets within the radius differ in at most D shingles, so of more than D disjoint shares that have some of a
set's shingles they agree exactly in one, and a set belongs to the region of each share with its own content. Sets with too many
shingles of their own have no links and go no further. Regions that have a member in common form a family;
no link leaves a family. Families beyond a size are split by pivot documents into Voronoi regions, a document also going
to each region whose pivot is at most two radii further than its nearest, again and again while that helps; what stays
large is cut into blocks by size, and every two blocks whose sizes allow a link are compared. All comparisons count
shared shingles exactly.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kilnwatt.llm.anchors import PART, Tokens, U, _encoded, _mixed, order_id
from kilnwatt.llm.common import lean, phase, row_key, table
from kilnwatt.llm.decontaminate import _small
from kilnwatt.llm.graph import components
from kilnwatt.session import discard

#: Words of a shingle, and links have 100 x intersection >= PERCENT x union, unless a caller asks for others.
SHINGLE = 3
PERCENT = 90
#: Sizes of a class differ by less than this factor, or by 100 / percent if that is more.
SPREAD = 1.25
#: One in so many shingles is looked for in other sets first.
SEEN = 3
#: Divisions of the shingle space, tried in turn for sets whose shingles lie in too few shares.
DIVISIONS = 4
#: Rows of (signature) to be broadcast.
SIGNATURES = 2_000_000
#: Members of a region that one task compares at once.
REGION = 800
#: Bytes of their shingles a task compares at once.
REGION_BYTES = 16_000_000
#: Blocks of a large region that a task compares with as many others.
TILE = 4
#: A shingle is counted pair by pair of its sets if these are this many times fewer than all pairs; pairs at once.
RARE, PAIRS = 300, 2_000_000
PIVOTS = 8
DEPTH = 3


class Sizes:
    """Size classes: `low[c]` to `low[c + 1] - 1` shingles, and the shares a class needs.

    A pair is looked for in the class of its larger set, whose size is at most u; within the radius both then differ in
    at most floor((100 - percent) x 2u / (100 + percent)) shingles. A smaller set is at most one class below.
    """

    def __init__(self, most: int, percent: int = PERCENT):
        low, self.percent = [1], percent
        while low[-1] <= most:
            low.append(self._next(low[-1]))
        low.append(self._next(low[-1]))
        self.low = np.array(low, dtype=np.int64)
        shares = (100 - percent) * 2 * (self.low[1:] - 1) // (100 + percent) + 1
        # Some more, as a share of few shingles is often empty.
        self.shares = shares + np.floor(shares * 3 * np.exp(-(100 + percent) / (2 * max(1, 100 - percent)))).astype(np.int64)

    def _next(self, low: int) -> int:
        return max(low + 1, int(np.ceil(low * SPREAD)), -(-low * 100 // self.percent))

    def differ(self, size: np.ndarray, kind: np.ndarray) -> np.ndarray:
        """In how many shingles a set and one it is linked with may differ, if the larger one is in class `kind`."""
        larger = np.minimum(size * 100 // self.percent, self.low[kind + 1] - 1)
        return (100 - self.percent) * (size + larger) // (100 + self.percent)

    def schemes(self, size: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """(rows, class) pairs: each set in its own class, and in the next if a partner there is possible."""
        own = np.searchsorted(self.low, size, side="right") - 1
        above = np.flatnonzero(size * 100 >= self.low[own + 1] * self.percent)
        return [(np.arange(len(size)), own), (above, own[above] + 1)]


def shingle_sets(texts: list[bytes], tokens: Tokens, shingle: int = SHINGLE) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(row, set begin, shingle hashes) by groups of texts; a row's set is sorted and distinct. Rows without words are
    left out. A text is a unit here: its words are in memory together."""
    group: list[int] = []
    size = 0
    for r, text in enumerate(texts):
        group.append(r)
        size += len(text) + 1
        if size >= PART or r == len(texts) - 1:
            blob = b"\n".join([texts[g].lower() for g in group])  # bytes: only A-Z change
            hashes, start, _ = tokens.read(blob)
            ends = np.cumsum([len(texts[g]) + 1 for g in group])
            owner = np.searchsorted(ends, start, side="right")
            count = np.bincount(owner, minlength=len(group))
            grams = tokens.rolling.grams(hashes, shingle)
            inside = owner[: len(grams)] == owner[shingle - 1 :] if len(grams) else np.zeros(0, bool)
            grams, of = grams[inside], owner[: len(inside)][inside]
            few = np.flatnonzero((count > 0) & (count < shingle))
            if len(few):
                begin = np.searchsorted(owner, few)
                whole = np.array([_mixed(np.add.reduce(hashes[b : b + n] * (np.arange(n, dtype=U) * U(2) + U(3)), keepdims=True) + U(n))[0] for b, n in zip(begin, count[few], strict=True)], dtype=U)
                grams, of = np.concatenate([grams, whole]), np.concatenate([of, few])
            order = np.lexsort((grams, of))
            grams, of = grams[order], of[order]
            first = np.ones(len(grams), dtype=bool)
            first[1:] = (grams[1:] != grams[:-1]) | (of[1:] != of[:-1])
            grams, of = grams[first], of[first]
            if len(of):
                begin = np.flatnonzero(np.diff(of, prepend=-1))
                yield np.array(group)[of[begin]], begin, grams
            group, size = [], 0


def digests(begin: np.ndarray, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit names of each set."""
    one = np.add.reduceat(_mixed(grams), begin)
    two = np.add.reduceat(_mixed(grams ^ U(0x2545F4914F6CDD1D)) * U(3), begin)
    return _mixed(one).view(np.int64), _mixed(two).view(np.int64)


def signatures(begin: np.ndarray, grams: np.ndarray, sizes: Sizes) -> tuple[np.ndarray, np.ndarray]:
    """(set, signature): for each class a set takes part in, one signature per share that has some of its shingles.

    Of more such shares than it may differ in, one is equal in both sets. A set that has fewer also takes part in the
    next division, where it meets the others that have too few, and in the last one with its empty shares as well.
    """
    size = np.diff(begin, append=len(grams))
    content = _mixed(grams + U(77))
    out_set, out_sig = [], []
    for rows, kind in sizes.schemes(size):
        several = sizes.shares[kind] > 1  # sets with a single share only link with equal ones
        rows, kind = rows[several], kind[several]
        for division in range(DIVISIONS):
            if not len(rows):
                break
            shares, n = sizes.shares[kind], size[rows]
            at = np.arange(n.sum()) + np.repeat(begin[rows] - (np.cumsum(n) - n), n)
            place = _mixed(grams[at] ^ U(0x9E3779B9 + division)) >> U(11)
            first = np.cumsum(shares) - shares
            cell = np.repeat(first, n) + (place % np.repeat(shares, n).astype(U)).astype(np.int64)
            order = np.argsort(cell, kind="stable")
            heads = np.flatnonzero(np.diff(cell[order], prepend=-1))
            sums = np.zeros(shares.sum(), dtype=U)
            sums[cell[order][heads]] = np.add.reduceat(content[at[order]], heads)
            sent = np.zeros(shares.sum(), dtype=bool)
            sent[cell[order][heads]] = True
            few = np.add.reduceat(sent.astype(np.int64), first) <= sizes.differ(n, kind)
            if division == DIVISIONS - 1:
                sent |= np.repeat(few, shares)
            number = np.arange(shares.sum()) - np.repeat(first, shares) + (division << 48)
            sig = _mixed(sums + _mixed(np.repeat(kind, shares).astype(U) * U(1 << 32) + number.astype(U) + U(1)))
            out_set.append(np.repeat(rows, shares)[sent])
            out_sig.append(sig[sent])
            rows, kind = rows[few], kind[few]
    if not out_set:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    return np.concatenate(out_set), np.concatenate(out_sig).view(np.int64)


def _meta(docs: DataFrame, shingle: int) -> DataFrame:
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = Tokens("words")
        for batch in batches:
            n = np.zeros(batch.num_rows, dtype=np.int64)
            one, two = n.copy(), n.copy()
            for row, begin, grams in shingle_sets(_encoded(batch.column("text")), tokens, shingle):
                n[row] = np.diff(begin, append=len(grams))
                one[row], two[row] = digests(begin, grams)
            names = [batch.column(c) for c in ("doc_id", "row_key", "id")]
            yield pa.record_batch([*names, pa.array(n), pa.array(one), pa.array(two)], names=["doc_id", "row_key", "id", "n_shingles", "set_key", "set_key2"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), row_key().alias("row_key"), order_id().alias("id"), "text")
    return phase(rows.mapInArrow(lean(read), "doc_id long, row_key long, id long, n_shingles long, set_key long, set_key2 long"), "jaccard-meta")


def _likely(docs: DataFrame, meta: DataFrame, shingle: int, percent: int) -> DataFrame:
    """(set_key, text): a document of each set that may be linked with another one; equal rows are all there.

    At most 100 - percent of 100 shingles of a linked set are in no other set. That holds for any part of them too: a set
    with more shingles of its own among one in SEEN has no link.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = Tokens("words")
        for batch in batches:
            for _, begin, grams in shingle_sets(_encoded(batch.column("text")), tokens, shingle):
                own = np.repeat(digests(begin, grams)[0], np.diff(begin, append=len(grams)))
                seen = grams % U(SEEN) == 0
                yield pa.record_batch([pa.array(grams[seen].view(np.int64)), pa.array(own[seen])], names=["shingle", "set_key"])

    sent = docs.select("text").mapInArrow(lean(read), "shingle long, set_key long")
    # As in _regions: copies of a set send the same rows, and a shingle's row only has the least and greatest of its sets.
    alone = sent.groupBy("shingle").agg(F.min("set_key").alias("a"), F.max("set_key").alias("b")).filter("a = b")
    alone = phase(alone.groupBy(F.col("a").alias("_set")).agg(F.count(F.lit(1)).alias("alone")), "jaccard-alone")
    sets = meta.filter("n_shingles > 0").groupBy("set_key", "set_key2").agg(F.min("row_key").alias("_row"), F.min("n_shingles").alias("n"))
    may = sets.join(alone, F.col("set_key") == F.col("_set"), "left").filter(F.coalesce("alone", F.lit(0)) * 100 <= F.lit(100 - percent) * F.col("n"))
    may = phase(may.select("set_key", "_row"), "jaccard-may")
    rows = docs.select(row_key().alias("row_key"), "text").join(_small(may), F.col("row_key") == F.col("_row"))
    likely = phase(rows.select("set_key", "text"), "jaccard-likely")
    discard(alone, may)
    return likely


def _regions(docs: DataFrame, most: int, shingle: int, percent: int) -> DataFrame:
    """(set_key, signature) of signatures that at least two different sets have."""
    sizes = Sizes(most, percent)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = Tokens("words")
        for batch in batches:
            for _, begin, grams in shingle_sets(_encoded(batch.column("text")), tokens, shingle):
                which, sig = signatures(begin, grams, sizes)
                if len(sig):
                    yield pa.record_batch([pa.array(sig), pa.array(digests(begin, grams)[0][which])], names=["signature", "set_key"])

    sent = docs.select("text").mapInArrow(lean(read), "signature long, set_key long")
    # Copies of a set send the same rows; the partial aggregation keeps one per task, and a signature's row only has the
    # least and greatest of its sets.
    spread = sent.groupBy("signature").agg(F.min("set_key").alias("a"), F.max("set_key").alias("b")).filter("a <> b").select("signature")
    spread = phase(spread, "jaccard-spread")
    regions = phase(sent.join(_small(spread, SIGNATURES), "signature").select("set_key", "signature").distinct(), "jaccard-regions")
    discard(spread)
    return regions


def _members(likely: DataFrame, named: DataFrame, shingle: int) -> DataFrame:
    """(region, set_key, shingles): one row for each set of `named`, read from the text of its document."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = Tokens("words")
        for batch in batches:
            want, region = batch.column("set_key").to_numpy(), batch.column("region")
            for row, begin, grams in shingle_sets(_encoded(batch.column("text")), tokens, shingle):
                ends = np.append(begin[1:], len(grams))
                key = digests(begin, grams)[0]
                for i in np.flatnonzero(key == want[row]).tolist():
                    own = region.slice(int(row[i]), 1)
                    yield pa.record_batch([own, pa.array(key[i : i + 1]), pa.array([grams[begin[i] : ends[i]].tobytes()], pa.binary())], names=["region", "set_key", "shingles"])

    rows = likely.join(_small(named), "set_key").select("region", "set_key", "text")
    return rows.mapInArrow(lean(read), "region long, set_key long, shingles binary").dropDuplicates(["set_key"])


class Inverted:
    """The distinct shingles of some sets, ascending, and for each the numbers of the sets that have it."""

    def __init__(self, sets: list[np.ndarray]):
        flat = np.concatenate(sets) if sets else np.zeros(0, dtype=U)
        order = np.argsort(flat, kind="stable")
        flat = flat[order]
        self.begin = np.flatnonzero(np.append(True, flat[1:] != flat[:-1])[: len(flat)])
        self.shingles = flat[self.begin]
        self.times = np.diff(self.begin, append=len(flat))
        self.rows = np.repeat(np.arange(len(sets), dtype=np.int32), [len(s) for s in sets])[order]
        self.sets = len(sets)

    def entries(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(set, place in `which`) for each set that has one of these shingles."""
        times = self.times[which]
        at = np.arange(times.sum()) + np.repeat(self.begin[which] - (np.cumsum(times) - times), times)
        return self.rows[at], np.repeat(np.arange(len(which)), times)

    def shared(self, other: Inverted) -> np.ndarray:
        """Sizes of the intersections of each own set with each of `other`: shingles of few sets are counted pair by pair of
        sets that have them, the others by products of blocks of 0 and 1."""
        out = np.zeros(self.sets * other.sets, dtype=np.int64)
        if not len(self.shingles) or not len(other.shingles):
            return out.reshape(self.sets, other.sets)
        place = np.minimum(np.searchsorted(self.shingles, other.shingles), len(self.shingles) - 1)
        there = np.flatnonzero(self.shingles[place] == other.shingles)
        here = place[there]
        met = self.times[here] * other.times[there]
        rare = met * RARE <= len(out)
        for part in np.split(np.flatnonzero(rare), np.searchsorted(np.cumsum(met[rare]), np.arange(PAIRS, met[rare].sum(), PAIRS))):
            row, column = self.entries(here[part])
            times = other.times[there[part]][column]
            at = np.arange(times.sum()) + np.repeat(other.begin[there[part]][column] - (np.cumsum(times) - times), times)
            out += np.bincount(np.repeat(row.astype(np.int64) * other.sets, times) + other.rows[at], minlength=len(out))
        out = out.reshape(self.sets, other.sets)
        often = np.flatnonzero(~rare)
        width = max(256, min(4096, 8_000_000 // max(1, self.sets + other.sets)))
        for at in range(0, len(often), width):
            part = often[at : at + width]
            left, right = np.zeros((self.sets, len(part)), dtype=np.float32), np.zeros((other.sets, len(part)), dtype=np.float32)
            left[self.entries(here[part])] = 1
            right[other.entries(there[part])] = 1
            out += (left @ right.T).astype(np.int64)
        return out


def shared_counts(sets: list[np.ndarray], others: list[np.ndarray] | None = None) -> np.ndarray:
    """Sizes of the intersections of each two sets, or of each set with each of `others`."""
    one = Inverted(sets)
    return one.shared(one if others is None else Inverted(others))


def linked(sets: list[np.ndarray], percent: int = PERCENT) -> np.ndarray:
    """For each set the least number of a set it is linked with, through others or itself."""
    n = np.array([len(s) for s in sets])
    common = shared_counts(sets)
    near = common * 100 >= percent * (n[:, None] + n[None, :] - common)
    label = np.arange(len(sets))
    while True:
        least = np.where(near, label[None, :], len(sets)).min(axis=1)
        least = np.minimum(least, label)
        least = least[least]
        if (least == label).all():
            return label
        label = least


def connected(blocks: list[tuple[int, list[np.ndarray]]], percent: int = PERCENT) -> np.ndarray:
    """For each set, counted through all blocks, the least number of one it is connected with by links between two blocks
    that are of different parts, or of any two, also within a block, if all are of one part.

    Blocks whose sizes rule out a link aren't compared, and sets known to be connected needn't be: of two blocks, only
    sets outside their largest component are, with all of the other.
    """
    sets = [s for _, own in blocks for s in own]
    size = np.array([len(s) for s in sets])
    ends = np.cumsum([len(own) for _, own in blocks])
    places = [np.arange(end - len(own), end) for end, (_, own) in zip(ends, blocks, strict=True)]
    index: list[Inverted | None] = [None] * len(blocks)
    label = np.arange(len(sets))
    one_part = len({part for part, _ in blocks}) == 1

    def inverted(block: int, rows: np.ndarray) -> Inverted:
        if len(rows) < len(places[block]):
            return Inverted([sets[r] for r in rows])
        index[block] = index[block] or Inverted(blocks[block][1])
        return index[block]

    def compare(i: int, rows: np.ndarray, j: int, others: np.ndarray) -> None:
        nonlocal label
        if not len(rows) or not len(others):
            return
        common = inverted(i, rows).shared(inverted(j, others))
        x, y = np.nonzero(common * 100 >= percent * (size[rows][:, None] + size[others][None, :] - common))
        x, y = label[rows[x]], label[others[y]]
        merged = np.arange(len(sets))
        while True:
            least = np.minimum(merged[x], merged[y])
            following = merged.copy()
            np.minimum.at(following, x, least)
            np.minimum.at(following, y, least)
            following = following[following]
            if (following == merged).all():
                break
            merged = following
        label = merged[label]

    for j in range(len(blocks)):
        for i in range(j + 1) if one_part else range(j):
            if not one_part and blocks[i][0] == blocks[j][0]:
                continue
            a, b = size[places[i]], size[places[j]]
            if a.max() * 100 < percent * b.min() or b.max() * 100 < percent * a.min():
                continue
            names, count = np.unique(label[np.concatenate([places[i], places[j]])], return_counts=True)
            main = names[count.argmax()]
            inside, outside = (places[i][label[places[i]] == main], places[i][label[places[i]] != main])
            far = places[j][label[places[j]] != main]
            compare(i, outside, j, places[j])
            if i != j:
                compare(i, inside, j, far)
    return label


def _split(rows: DataFrame, big: DataFrame, percent: int) -> DataFrame:
    """One round of Voronoi regions: (region, part, set_key) for the members of `big` regions."""
    order = Window.partitionBy("region").orderBy(F.xxhash64("set_key", "region"), "set_key")
    pivots = rows.join(_small(big), "region", "left_semi").withColumn("_n", F.row_number().over(order)).filter(F.col("_n") <= PIVOTS)
    pivots = phase(pivots.groupBy(F.col("region").alias("_region")).agg(F.collect_list("shingles").alias("pivots")), "jaccard-pivots")

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            regions, keys, sets, centres = (batch.column(n).to_pylist() for n in ("region", "set_key", "shingles", "pivots"))
            out = []
            for region in sorted(set(regions)):
                own = [i for i, r in enumerate(regions) if r == region]
                points = [np.frombuffer(p, dtype=U) for p in centres[own[0]]]
                mine = [np.frombuffer(sets[i], dtype=U) for i in own]
                common = shared_counts(mine, points)
                union = np.array([len(s) for s in mine])[:, None] + np.array([len(p) for p in points])[None, :] - common
                far = (union - common) / union
                # Two radii, with room for rounding: a linked text's nearest pivot is at most that much further.
                close = far <= far.min(axis=1, keepdims=True) + 2 * (1 - percent / 100) + 1e-9
                out += [(region, int(p), keys[own[i]]) for i, p in zip(*np.nonzero(close), strict=True)]
            columns = zip(*out, strict=True) if out else [[]] * 3
            yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, [pa.int64(), pa.int32(), pa.int64()], strict=True)], names=["region", "part", "set_key"])

    spread = rows.join(_small(pivots, 50), F.col("region") == F.col("_region")).select("region", "set_key", "shingles", "pivots")
    return spread.mapInArrow(lean(deal), "region long, part int, set_key long")


def _links(rows: DataFrame, percent: int) -> DataFrame:
    """(a, b): links that connect what is linked within each region, each region in one task or in pairs of blocks.

    If `rows` is a written table, it is deleted once it has been read.
    """
    held = rows
    for _ in range(DEPTH):
        counts = phase(rows.groupBy("region").agg(F.count(F.lit(1)).alias("n")), "jaccard-counts")
        big = counts.filter(F.col("n") > REGION)
        if not big.limit(1).count():
            break
        parts = phase(_split(rows, big.select("region"), percent), "jaccard-parts")
        # A split pays if comparing its parts takes clearly less than comparing the region.
        cost = parts.groupBy("region", "part").count().groupBy("region").agg(F.sum(F.col("count").cast("double") * F.col("count")).alias("c"))
        useful = big.join(cost, "region").filter(F.col("c") < 0.7 * F.col("n") * F.col("n")).select("region")
        useful = phase(useful, "jaccard-useful")
        if not useful.limit(1).count():
            discard(parts)
            break
        stay = rows.join(_small(useful), "region", "left_anti")
        # Shingles are sent to the parts of the regions that are split, and of no others.
        moved = rows.join(parts.join(_small(useful), "region", "left_semi"), ["region", "set_key"])
        moved = moved.select(F.xxhash64("region", "part").alias("region"), "set_key", "shingles")
        rows = phase(stay.select("region", "set_key", "shingles").unionByName(moved), "jaccard-rows")
        discard(parts, held)
        held = rows
    counts = rows.groupBy("region").agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("shingles")).alias("bytes"))
    large = _small(phase(counts.filter((F.col("n") > REGION) | (F.col("bytes") > REGION_BYTES)).select("region"), "jaccard-counts"))
    return _compared(rows.join(large, "region", "left_anti"), _blocks(rows.join(large, "region", "left_semi")), percent, held)


def _blocks(rows: DataFrame) -> DataFrame:
    """Add `own`, the number of a block within the region. Blocks follow the size of the sets and are of bounded count and
    bytes; sets of one size are dealt to as many as they need."""
    sized = rows.withColumn("size", F.floor(F.length("shingles") / 8).cast("int"))
    share = F.greatest(F.lit(2 / REGION), F.col("size") * (16 / REGION_BYTES))
    sizes = sized.groupBy("region", "size").agg(F.count(F.lit(1)).alias("n")).withColumn("width", F.col("n") * share)
    before = F.sum("width").over(Window.partitionBy("region").orderBy("size").rowsBetween(Window.unboundedPreceding, -1))
    sizes = phase(sizes.withColumn("before", F.coalesce(before, F.lit(0.0))), "jaccard-sizes")
    within = F.pmod(F.xxhash64("set_key"), F.col("n")) / F.col("n") * F.col("width")
    return sized.join(_small(sizes), ["region", "size"]).select("region", "set_key", "shingles", F.floor(F.col("before") + within).cast("int").alias("own"))


def _tasks(packed: DataFrame, percent: int) -> DataFrame:
    """(region, part, task): the parts, tiles of blocks, that each task has to compare: a part and one of sets at least as
    large, as far as their sizes allow links. Sizes rise with the parts, so a part's partners are a range of parts."""
    parts = packed.groupBy("region", "part").agg(F.min("least").alias("low"), F.max("most").alias("high"))
    begins = parts.select("region", F.col("low").alias("at"), F.lit(0).alias("ends"), "part")
    reach = F.floor(F.col("high") * 100 / percent).cast("int")
    both = begins.unionByName(parts.select("region", reach.alias("at"), F.lit(1).alias("ends"), "part"))
    so_far = Window.partitionBy("region").orderBy("at", "ends").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    last = F.max(F.when(F.col("ends") == 0, F.col("part"))).over(so_far)
    ranges = both.withColumn("last", last).filter("ends = 1")
    pairs = ranges.select("region", "part", F.explode(F.sequence("part", "last")).alias("other"))
    pairs = pairs.withColumn("task", F.xxhash64("region", "part", "other"))
    return pairs.select("region", "task", F.explode(F.array_distinct(F.array("part", "other"))).alias("part"))


BLOCK = "region long, own int, keys binary, lengths binary, shingles binary, size long, least int, most int"


def _compared(small: DataFrame, large: DataFrame, percent: int, held: DataFrame) -> DataFrame:
    """(a, b): links within each small region, and within each two tiles of blocks of a large one whose sizes allow links.

    A block becomes one compressed row before it is sent to the tasks of its tile: sets of a family have most shingles in
    common, so this is a fraction of their bytes. Within a task, sets already connected aren't compared with each other.
    If `held`, from which both come, is a written table, it is deleted once the blocks are packed.
    """

    def edges(keys: np.ndarray, sets: list[np.ndarray]) -> pa.RecordBatch:
        label = linked(sets, percent)
        other = np.flatnonzero(label != np.arange(len(label)))
        return pa.record_batch([pa.array(keys[other]), pa.array(keys[label[other]])], names=["a", "b"])

    def blocks_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, np.ndarray, list[np.ndarray]]]:
        now, keys, sets = None, [], []
        for batch in batches:
            for region, own, k, s in zip(*(batch.column(c).to_pylist() for c in ("region", "own", "set_key", "shingles")), strict=True):
                if (region, own) != now:
                    if keys:
                        yield now, np.array(keys, dtype=np.int64), sets
                    now, keys, sets = (region, own), [], []
                keys.append(k)
                sets.append(np.frombuffer(s, dtype=U))
        if keys:
            yield now, np.array(keys, dtype=np.int64), sets

    def single(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, keys, sets in blocks_of(batches):
            if len(keys) > 1:
                yield edges(keys, sets)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = pa.Codec("zstd")
        for (region, own), keys, sets in blocks_of(batches):
            raw = np.concatenate(sets).tobytes()
            lengths = np.array([len(x) for x in sets], dtype=np.int32)
            columns = [[region], [own], [keys.tobytes()], [lengths.tobytes()], [codec.compress(raw, asbytes=True)], [len(raw)], [lengths.min()], [lengths.max()]]
            kinds = [pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.int64(), pa.int32(), pa.int32()]
            yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["region", "own", "keys", "lengths", "shingles", "size", "least", "most"])

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec, task, tile = pa.Codec("zstd"), None, []

        def done() -> pa.RecordBatch:
            label = connected([(part, sets) for part, _, _, sets in sorted(tile, key=lambda x: x[:2])], percent)
            keys = np.concatenate([k for _, _, k, _ in sorted(tile, key=lambda x: x[:2])])
            other = np.flatnonzero(label != np.arange(len(label)))
            return pa.record_batch([pa.array(keys[other]), pa.array(keys[label[other]])], names=["a", "b"])

        for batch in batches:
            for t, part, own, k, lengths, packed, size in zip(*(batch.column(c).to_pylist() for c in ("task", "part", "own", "keys", "lengths", "shingles", "size")), strict=True):
                if t != task:
                    if tile:
                        yield done()
                    task, tile = t, []
                raw = np.frombuffer(codec.decompress(packed, size, asbytes=True), dtype=U)
                tile.append((part, own, np.frombuffer(k, dtype=np.int64), np.split(raw, np.cumsum(np.frombuffer(lengths, dtype=np.int32))[:-1])))
        if tile:
            yield done()

    columns = ("region", "own", "set_key", "shingles")
    alone = small.withColumn("own", F.lit(0)).select(*columns).repartition("region").sortWithinPartitions("region", "set_key")
    dealt = large.select(*columns).repartition("region", "own").sortWithinPartitions("region", "own", "set_key")
    blocks = phase(dealt.mapInArrow(lean(pack), BLOCK), "jaccard-blocks")
    packed = blocks.withColumn("part", F.floor(F.col("own") / TILE).cast("int"))
    few = phase(alone.mapInArrow(lean(single), "a long, b long").distinct(), "jaccard-few")
    discard(held)
    sizes = packed.groupBy("region", "part").agg(F.sum(F.length("shingles")).alias("bytes"))
    tasks = phase(_tasks(packed, percent).join(sizes, ["region", "part"]), "jaccard-tasks")
    # A block goes to every task that needs it. In each round about as many bytes are sent as the blocks have, so the disks
    # hold two copies of them at most, however many tasks a family has.
    whole, sent = (t.agg(F.sum("bytes")).first()[0] or 0 for t in (sizes, tasks))
    found = few
    rounds = -(-sent // whole) if whole else 0
    for number in range(rounds):
        now = tasks.filter(F.pmod(F.xxhash64("task"), F.lit(rounds)) == number).select("region", "part", "task")
        spread = packed.join(_small(now), ["region", "part"]).select("task", "part", "own", "keys", "lengths", "shingles", "size")
        spread = spread.repartition("task").sortWithinPartitions("task")
        found = found.unionByName(phase(spread.mapInArrow(lean(pairs), "a long, b long").distinct(), "jaccard-pairs"))
    discard(blocks, tasks)
    return found.distinct()


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id, row_key), one row per row of `docs`.

    Sets are of `shingle` successive words; links have at least `percent` of 100 parts of their union in common.
    Component ids are the least doc_id that links reach. Null and empty texts, and texts of white space, have no
    shingles and link with nothing. A null id counts as the greatest; where only such are reached, the component is null.
    Repeated rows have equal sets, so they are linked. Other columns play no part.
    """
    meta = _meta(docs, shingle)
    most = meta.agg(F.max("n_shingles")).first()[0] or 0
    likely = _likely(docs, meta, shingle, percent)
    regions = _regions(likely, most, shingle, percent)
    families = components(_bipartite(regions), "jaccard-families")
    named = families.join(regions.select("set_key").distinct(), F.col("node") == F.col("set_key")).select("set_key", F.col("root").alias("region"))
    named = phase(named, "jaccard-named")
    discard(regions)
    rows = phase(_members(likely, named, shingle), "jaccard-members")
    discard(likely, named)
    groups = components(_links(rows, percent), "jaccard-links").select(F.col("node").alias("set_key"), "root")
    filled = meta.filter("n_shingles > 0")
    sets = filled.groupBy("set_key", "set_key2").agg(F.min("id").alias("least")).join(groups, "set_key", "left")
    sets = phase(sets.withColumn("root", F.coalesce("root", "set_key")), "jaccard-sets")
    least = sets.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = sets.join(least, "root").select(F.col("set_key").alias("_one"), F.col("set_key2").alias("_two"), F.nullif(F.col("component_id"), F.lit(2**63 - 1)).alias("component_id"))
    joined = filled.join(classes, (F.col("set_key") == F.col("_one")) & (F.col("set_key2") == F.col("_two"))).select("doc_id", "n_shingles", "component_id", "row_key")
    return joined.unionByName(meta.filter("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"), "row_key"))


def _bipartite(regions: DataFrame) -> DataFrame:
    """Edges from each set to the least set of each of its regions: they connect the same sets as the regions do."""
    least = regions.groupBy("signature").agg(F.min("set_key").alias("b"))
    return regions.join(least, "signature").select(F.col("set_key").alias("a"), "b").distinct()


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents")).drop("row_key")

"""Content anchors: which windows of a text may also occur elsewhere, found without moving the texts.

A window is `width` successive tokens (words or bytes) of one document. Its anchor is the least hash among the `gram`-token
sequences in it, so equal windows have equal anchors wherever they lie. Successive windows with the same anchor form a
segment; a text has far fewer segments than windows. Only anchors that occur more than once can belong to a repeated
window, so one exchange of anchors tells which segments are worth a closer look.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kilnwatt.llm.common import lean, phase

U = np.uint64
#: Bytes of text handled at once within a task; longer texts are read in overlapping parts.
PART = 1 << 19
#: The same where each byte is a token: arrays of 64-bit numbers of a part stay in a processor's cache.
BYTES_PART = 1 << 16
#: Tokens of a part are numbered in the low bits of the keys whose minimum is taken.
PLACE_BITS = 22
#: Segments a task collects before it looks for anchors repeated among them.
FLUSH = 400_000


def _powers(base: int, n: int) -> np.ndarray:
    out = np.ones(max(n, 1), dtype=U)
    have, factor = 1, base
    while have < n:
        take = min(have, n - have)
        out[have : have + take] = out[:take] * U(factor)
        factor = factor * factor % 2**64
        have += take
    return out


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> U(30))
    x *= U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


class Rolling:
    """Hashes of all `n`-token sequences of an array, from sums of powers modulo 2^64."""

    BASE = 0x9E3779B97F4A7C15

    def __init__(self) -> None:
        self._forth = self._back = np.ones(1, dtype=U)

    def _grow(self, n: int) -> None:
        if len(self._forth) < n:
            self._forth, self._back = _powers(self.BASE, n), _powers(pow(self.BASE, -1, 2**64), n)

    def sums(self, values: np.ndarray) -> np.ndarray:
        self._grow(len(values) + 1)
        out = np.zeros(len(values) + 1, dtype=U)
        np.cumsum(values * self._forth[: len(values)], out=out[1:])
        return out

    def spans(self, sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return _mixed((sums[end] - sums[start]) * self._back[start] + (end - start).astype(U))

    def grams(self, values: np.ndarray, n: int) -> np.ndarray:
        if len(values) < n:
            return np.zeros(0, dtype=U)
        sums = self.sums(values)
        return _mixed((sums[n:] - sums[:-n]) * self._back[: len(values) - n + 1])


def sliding_min(keys: np.ndarray, width: int) -> np.ndarray:
    out, have = keys, 1
    while have < width:
        step = min(have, width - have)
        out = np.minimum(out[:-step], out[step:])
        have += step
    return out


class Tokens:
    """Token hashes of a run of texts: words between ASCII white space, or bytes.

    A byte has a fixed random 64-bit value; a word's hash comes from those of its bytes.
    """

    def __init__(self, kind: str):
        self.kind = kind
        self.rolling = Rolling()
        self._values = np.random.default_rng(20_240_101).integers(0, 2**64, 256, dtype=U) | U(1)

    def read(self, data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(hashes, start bytes, end bytes) of the tokens of `data`."""
        raw = np.frombuffer(data, dtype=np.uint8)
        if self.kind == "bytes":
            at = np.arange(len(raw) + 1)
            return self._values[raw], at[:-1], at[1:]
        start, end = word_places(raw)
        return self.rolling.spans(self.rolling.sums(self._values[raw]), start, end), start, end


def word_places(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    blank = (raw == 32) | ((raw >= 9) & (raw <= 13))
    edge = np.flatnonzero(np.diff(blank.view(np.int8), prepend=1, append=1))
    return edge[::2], edge[1::2]


@dataclass(frozen=True)
class Scheme:
    """`width` tokens to a window, `gram` to an anchor."""

    kind: str
    width: int
    gram: int

    def segments(self, tokens: Tokens, hashes: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(first window, windows, anchor) of each segment. Windows lie within tokens of one `owner`."""
        n = len(hashes) - self.width + 1
        none = np.zeros(0, dtype=np.int64)
        if n <= 0:
            return none, none, none.astype(U)
        grams = tokens.rolling.grams(hashes, self.gram)
        low = U((1 << PLACE_BITS) - 1)
        keys = (grams & ~low) | np.arange(len(grams), dtype=U)
        least = sliding_min(keys, self.width - self.gram + 1)
        whole = owner[: n] == owner[self.width - 1 :]
        change = np.ones(n, dtype=bool)
        change[1:] = (least[1:] != least[:-1]) | (whole[1:] != whole[:-1])
        first = np.flatnonzero(change)
        count = np.diff(first, append=n)
        kept = whole[first]
        first, count = first[kept], count[kept]
        return first, count, grams[(least[first] & low).astype(np.int64)]


@dataclass
class Part:
    """Token hashes of consecutive texts, or of a stretch of a long one.

    For each token: its first and last byte in its own text, the number of that text (-1 between texts), and its own
    number in the text.
    """

    hashes: np.ndarray
    start: np.ndarray
    end: np.ndarray
    owner: np.ndarray
    number: np.ndarray


_BLANK = re.compile(rb"[ \t\n\v\f\r]")


def parts(texts: list[bytes], tokens: Tokens, width: int) -> Iterator[Part]:
    """All windows of all texts, each in exactly one part of about PART bytes, or BYTES_PART if bytes are the tokens.

    A long text is read in stretches; each takes over the last `width - 1` tokens of the one before.
    """
    held: list[int] = []
    size = 0
    most = min(PART, BYTES_PART) if tokens.kind == "bytes" else PART
    for r, text in enumerate(texts):
        if held and size + len(text) > most:
            yield _joined(texts, held, tokens)
            held, size = [], 0
        if len(text) > most:
            yield from _stretches(text, r, tokens, width, most)
        elif len(text) >= width:
            held.append(r)
            size += len(text) + 1
    if held:
        yield _joined(texts, held, tokens)


def _joined(texts: list[bytes], rows: list[int], tokens: Tokens) -> Part:
    blob = b"\n".join([texts[r] for r in rows])
    hashes, start, end = tokens.read(blob)
    sizes = np.array([len(texts[r]) + 1 for r in rows])
    ends = np.cumsum(sizes)
    if tokens.kind == "bytes":  # every byte's text and place in it are known without a search
        owner = np.repeat(np.array(rows), sizes)[: len(blob)]
        owner[ends[:-1] - 1] = -1
        number = start - np.repeat(ends - sizes, sizes)[: len(blob)]
        return Part(hashes, number, number + 1, owner, number)
    nth = np.searchsorted(ends, start, side="right")
    first = np.searchsorted(start, ends - sizes)
    offset = (ends - sizes)[nth]
    owner = np.array(rows)[nth]
    return Part(hashes, start - offset, end - offset, owner, np.arange(len(hashes)) - first[nth])


def _stretches(text: bytes, row: int, tokens: Tokens, width: int, most: int) -> Iterator[Part]:
    kept = Part(*[np.zeros(0, dtype=k) for k in (U, np.int64, np.int64, np.int64, np.int64)])
    at = read = 0
    while at < len(text):
        stop = min(len(text), at + most)
        if tokens.kind == "words" and stop < len(text):
            blank = _BLANK.search(text, stop)
            stop = blank.start() if blank else len(text)
        hashes, start, end = tokens.read(text[at:stop])
        number = np.arange(read, read + len(hashes))
        own = Part(hashes, start + at, end + at, np.full(len(hashes), row), number)
        part = Part(*[np.concatenate([getattr(kept, f), getattr(own, f)]) for f in ("hashes", "start", "end", "owner", "number")])
        yield part
        kept = Part(*[getattr(part, f)[max(0, len(part.hashes) - width + 1) :] for f in ("hashes", "start", "end", "owner", "number")])
        at, read = stop, read + len(hashes)


def segments_of(texts: list[bytes], scheme: Scheme, tokens: Tokens) -> Iterator[tuple[Part, np.ndarray, np.ndarray, np.ndarray]]:
    """(part, first window, windows, anchor) for every part of the texts that has segments."""
    for part in parts(texts, tokens, scheme.width):
        first, count, anchor = scheme.segments(tokens, part.hashes, part.owner)
        if len(first):
            yield part, first, count, anchor


def distinct_texts(docs: DataFrame) -> DataFrame:
    """(text_key, text_key2, first_id, copies): one row per distinct text, written to the shared folder.

    Two independent 64-bit hashes name a text. `first_id` is the least doc_id, a null one counting as the greatest.
    Whole copies are settled here, so that the work below sees every text once, however many copies there are.
    """
    keyed = docs.select(*text_keys(), order_id().alias("_id"))
    return phase(keyed.groupBy("text_key", "text_key2").agg(F.min("_id").alias("first_id"), F.count(F.lit(1)).alias("copies")), "anchor-texts")


def text_keys() -> tuple[Column, Column]:
    text = F.coalesce(F.col("text"), F.lit(""))
    return F.xxhash64(text).alias("text_key"), F.xxhash64(F.lit(1), text).alias("text_key2")


def order_id() -> Column:
    return F.coalesce(F.col("doc_id").cast("long"), F.lit(2**63 - 1))


def repeated_anchors(docs: DataFrame, scheme: Scheme, within: bool) -> DataFrame:
    """(text_key, anchors): of each text, the distinct anchors that also occur in another text, or, if `within`, twice in it.

    Within a task, segments are compared first: an anchor of one text goes out with its key; one of several texts is
    settled for these, and only its presence goes out. So an anchor however common is sent at most once by each task (or
    FLUSH segments), and no group of the exchange grows with its copies.
    """

    def anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = Tokens(scheme.kind)
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0
        for batch in batches:
            keys = batch.column("text_key").to_numpy()
            for part, first, _, anchor in segments_of(_encoded(batch.column("text")), scheme, tokens):
                held.append((anchor.view(np.int64), keys[part.owner[first]]))
                size += len(first)
                if size >= FLUSH:
                    yield _outgoing(held, within)
                    held, size = [], 0
        if held:
            yield _outgoing(held, within)

    sent = docs.select(text_keys()[0], "text").mapInArrow(lean(anchors), "anchor long, text_key long, settled long")
    group = Window.partitionBy("anchor", "settled")
    if within:  # rows of one text may come from two flushes, or from its copies, which does no harm
        several = F.count(F.lit(1)).over(group) > 1
    else:
        several = (F.min("text_key").over(group) != F.max("text_key").over(group)) | (F.count("text_key").over(group) < F.count(F.lit(1)).over(group))
    hits = sent.withColumn("_several", several).filter(F.col("text_key").isNotNull() & ((F.col("settled") != 0) | F.col("_several")))
    return phase(hits.groupBy("text_key").agg(F.collect_set("anchor").alias("anchors")), "anchor-hits")


def _encoded(column: pa.Array) -> list[bytes]:
    """Texts as UTF-8; null ones are empty."""
    return [t or b"" for t in column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()).to_pylist()]


def _outgoing(held: list[tuple[np.ndarray, np.ndarray]], within: bool) -> pa.RecordBatch:
    """Rows to send: (anchor, text) seen alone, (anchor, null) for presence, and settled (anchor, text) pairs."""
    anchor, key = (np.concatenate(c) for c in zip(*held, strict=True))
    order = np.lexsort((key, anchor))
    anchor, key = anchor[order], key[order]
    pair = np.ones(len(anchor), dtype=bool)
    pair[1:] = (anchor[1:] != anchor[:-1]) | (key[1:] != key[:-1])
    times = np.diff(np.flatnonzero(pair), append=len(anchor))
    anchor, key = anchor[pair], key[pair]
    head = np.ones(len(anchor), dtype=bool)
    head[1:] = anchor[1:] != anchor[:-1]
    texts = np.diff(np.flatnonzero(head), append=len(anchor))
    many = np.repeat(texts > 1, texts)
    alone, told = ~many, head & many
    settled = many | (times > 1) if within else many
    out_anchor = np.concatenate([anchor[alone], anchor[told], anchor[settled]])
    out_key = np.concatenate([key[alone], np.zeros(told.sum(), dtype=np.int64), key[settled]])
    mark = np.concatenate([np.zeros(alone.sum() + told.sum(), dtype=np.int64), key[settled] | 1])
    absent = np.zeros(len(out_key), dtype=bool)
    absent[alone.sum() : alone.sum() + told.sum()] = True
    return pa.record_batch([pa.array(out_anchor), pa.array(out_key, mask=absent), pa.array(mark)], names=["anchor", "text_key", "settled"])


SEGMENTS = "anchor long, body binary, text_key long, first_id long, copies long, number long, windows int"


def candidate_segments(docs: DataFrame, distinct: DataFrame, hits: DataFrame, scheme: Scheme) -> DataFrame:
    """(anchor, body, text_key, first_id, copies, number, windows): segments of distinct texts whose anchor was hit.

    `number` is the first window's token number. `body` holds what tells windows apart: the bytes themselves, or 96 bits
    of each window of words (two independent hashes of all its words, which stand for it from here on).
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = Tokens(scheme.kind)
        for batch in batches:
            texts = _encoded(batch.column("text"))
            names = [batch.column(n).to_numpy() for n in ("text_key", "first_id", "copies")]
            wanted = batch.column("anchors")
            lengths = wanted.value_lengths().to_numpy()
            flat = wanted.flatten().to_numpy()
            # Pairs (row, anchor) that were hit, sorted: the row in the high bits, as much of the anchor's hash below as fits.
            # A part looks only among those of its own rows.
            low = U(len(texts).bit_length())
            high = U(64) - low
            hit = np.sort((np.repeat(np.arange(len(texts), dtype=U), lengths) << high) | (_mixed(flat.view(U)) >> low))
            begin = np.concatenate([[0], np.cumsum(lengths)])
            for part, first, count, anchor in segments_of(texts, scheme, tokens):
                row = part.owner[first]
                own = hit[begin[row[0]] : begin[row[-1] + 1]]
                if not len(own):
                    continue
                pair = (row.astype(U) << high) | (_mixed(anchor) >> low)
                kept = own[np.minimum(np.searchsorted(own, pair), len(own) - 1)] == pair
                if not kept.any():
                    continue
                first, count, anchor, row = first[kept], count[kept], anchor[kept], row[kept]
                if scheme.kind == "bytes":
                    body = _byte_bodies(texts, part, first, count + scheme.width - 1)
                else:
                    body = _window_bodies(tokens, part, first, count, scheme.width)
                yield pa.record_batch(
                    [pa.array(anchor.view(np.int64)), body, *(pa.array(n[row]) for n in names), pa.array(part.number[first]), pa.array(count.astype(np.int32))],
                    names=["anchor", "body", "text_key", "first_id", "copies", "number", "windows"],
                )

    wanted = hits.join(distinct.select(F.col("text_key").alias("_key"), "first_id", "copies"), F.col("text_key") == F.col("_key")).drop("_key")
    whole = docs.select(text_keys()[0].alias("_key"), order_id().alias("_id"), F.coalesce("text", F.lit("")).alias("text"))
    # Equal rows (same id and text) are one text here too.
    joined = whole.join(wanted, (F.col("_key") == F.col("text_key")) & (F.col("_id") == F.col("first_id")))
    once = joined.select("text", "text_key", "first_id", "copies", "anchors")
    return once.mapInArrow(lean(cut), SEGMENTS)


def _ranges(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """first[0], first[0] + 1, ... for each of the counts, in a row."""
    total = np.cumsum(count)
    return np.arange(total[-1]) + np.repeat(first - np.concatenate([[0], total[:-1]]), count)


def _binary(flat: np.ndarray, lengths: np.ndarray) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(lengths), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(flat))])


def _byte_bodies(texts: list[bytes], part: Part, first: np.ndarray, length: np.ndarray) -> pa.Array:
    return pa.array([texts[r][s : s + n] for r, s, n in zip(part.owner[first].tolist(), part.start[first].tolist(), length.tolist(), strict=True)], pa.binary())


WINDOW_BYTES = 12


def _window_bodies(tokens: Tokens, part: Part, first: np.ndarray, count: np.ndarray, width: int) -> pa.Array:
    one = tokens.rolling.grams(part.hashes, width)
    two = tokens.rolling.grams(_mixed(part.hashes ^ U(0x5851F42D4C957F2D)), width)
    at = _ranges(first, count)
    keys = np.empty((len(at), WINDOW_BYTES), dtype=np.uint8)
    keys[:, :8] = one[at].view(np.uint8).reshape(-1, 8)
    keys[:, 8:] = two[at].view(np.uint8).reshape(-1, 8)[:, :4]
    return _binary(keys.reshape(-1), count * WINDOW_BYTES)


def text_masks(segments: DataFrame, masks: DataFrame) -> DataFrame:
    """(text_key, first_id, runs): for each text the (number, mask) of its segments with a marked window.

    `masks` has (anchor, path, mask) with `path` the hash of the body and bit i for the i-th window of the segment.
    """
    places = segments.select("text_key", "first_id", "number", "anchor", F.xxhash64("body").alias("path"))
    found = places.join(masks, ["anchor", "path"]).select("text_key", "first_id", F.struct("number", "mask").alias("run"))
    return found.groupBy("text_key", "first_id").agg(F.collect_list("run").alias("runs"))


def marked_windows(runs: list[dict] | None) -> np.ndarray:
    """Numbers of the marked windows, sorted and distinct."""
    if not runs:
        return np.zeros(0, dtype=np.int64)
    number = np.array([r["number"] for r in runs], dtype=np.int64)
    mask = np.array([r["mask"] for r in runs], dtype=np.int64)
    bits = (mask[:, None] >> np.arange(63)) & 1
    at, bit = np.nonzero(bits)
    return np.unique(number[at] + bit)


def covered(starts: np.ndarray, width: int, n: int) -> np.ndarray:
    """Which of n tokens lie in a marked window."""
    edge = np.zeros(n + 1, dtype=np.int32)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + width, -1)
    return np.cumsum(edge[:n]) > 0


def with_results(docs: DataFrame, distinct: DataFrame, runs: DataFrame) -> DataFrame:
    """Rows of `docs` (all columns) with `_first_id`, `_copies` and `_runs` of their text; null where nothing was found."""
    both = distinct.join(runs, ["text_key", "first_id"], "left").filter((F.col("copies") > 1) | F.col("runs").isNotNull())
    found = phase(both, "anchor-results").select(
        F.col("text_key").alias("_key"), F.col("text_key2").alias("_key2"), F.col("first_id").alias("_first_id"), F.col("copies").alias("_copies"), F.col("runs").alias("_runs")
    )
    one, two = text_keys()
    keyed = docs.withColumn("_own", one).withColumn("_own2", two).withColumn("_id", order_id())
    return keyed.join(found, (F.col("_own") == F.col("_key")) & (F.col("_own2") == F.col("_key2")), "left").drop("_own", "_own2", "_key", "_key2")

"""Best-fit packing by minimum bin slack.

Texts are tokenised where they lie; only pieces (id, place, length, checksum) move. Which lengths share a sequence is
decided on the counts per length, at most `capacity` numbers however many pieces there are: for the longest length left,
a bitset subset-sum over the lengths available finds the fullest sequence, and that combination is used as often as the
counts allow. The plan is one table of ranges per length, so every piece then finds its sequence by its own number.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kilnwatt.llm.common import lean, numbered, phase, salts_for, table, texts

CAPACITY = 2048
END_ID = 0
#: Words whose ids a task remembers; the memory is emptied when full.
REMEMBERED = 500_000

#: Lower-case words of a-z and the letters U+00DF to U+00FF in UTF-8, and the characters by which byte-level tokenizers
#: spell those of their bytes that aren't printable in Latin-1.
_LETTERS = re.compile(rb"(?:[a-z]|\xc3[\x9f-\xb6\xb8-\xbf])+")
_SPELT = {0x9F: 0x141, 0xA0: 0x142, 0xAD: 0x143}

PIECES = "doc_id long, row_key long, piece int, start long, length long, ids_crc32 long"
_PIECE_SCHEMA = pa.schema([("doc_id", pa.int64()), ("row_key", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())])


class WordIds:
    """Ids of whole texts, as 32-bit little-endian machines store them, from the tokenizer's ids of their words.

    The tokenizer drops white space and never joins what it separates, so a text's ids are those of its words in a row.
    Only words not seen before are tokenised, in batches. Marks that the tokenizer knows as special, such as the end of a
    text, are ids of their own wherever they stand in a text, as the tokenizer reads them; with `marks` off they are
    ordinary characters.
    """

    def __init__(self, path: str, marks: bool = True):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        special = {t.content: array("I", [i]).tobytes() for i, t in self._tokenizer.get_added_tokens_decoder().items()}
        self._marks = special if marks else {}
        self._mark = re.compile("|".join(re.escape(m) for m in sorted(self._marks, key=len, reverse=True)))
        self._tokenizer.encode_special_tokens = True  # what is left between marks has none
        self._stops = re.compile(rb"(?<=[a-z0-9])([.,])(?=[ \n]|$)")
        self._spelt = "ByteLevel(" in str(self._tokenizer.pre_tokenizer)
        self._known: dict[bytes, bytes] = {}

    def _learn(self, words: list[bytes]) -> None:
        if len(self._known) + len(words) > REMEMBERED:
            self._known.clear()
        # What the tokenizer does before its model only spells bytes as characters in words of these letters.
        plain, spelt, rest = self._tokenizer.model.tokenize, self._spelt, []
        for w in words:
            if w.isalpha():
                self._known[w] = array("I", [t.id for t in plain(w.decode())]).tobytes()
            elif spelt and _LETTERS.fullmatch(w):
                self._known[w] = array("I", [t.id for t in plain(w.decode("latin-1").translate(_SPELT))]).tobytes()
            else:
                rest.append(w)
        for at in range(0, len(rest), 4096):
            part = rest[at : at + 4096]
            made = self._tokenizer.encode_batch_fast([w.decode() for w in part], add_special_tokens=False)
            self._known.update((w, array("I", e.ids).tobytes()) for w, e in zip(part, made, strict=True))

    def of(self, text: str) -> bytes:
        """Little-endian unsigned 32-bit ids."""
        if not self._marks:
            return self._between(text)
        out, at = [], 0
        for found in self._mark.finditer(text):
            out += [self._between(text[at : found.start()]), self._marks[found.group()]]
            at = found.end()
        return b"".join([*out, self._between(text[at:])])

    def _between(self, text: str) -> bytes:
        """Ids of a stretch without marks.

        Texts are cut at ASCII white space, which every word boundary respects, and before stops that end a word, which
        the tokenizer separates from letters and digits too. It reads A-Z as a-z, so this is done once for the text.
        """
        known, out = self._known, []
        words = self._stops.sub(rb" \1", text.encode().lower()).split()
        for at in range(0, len(words), REMEMBERED // 4):
            part = words[at : at + REMEMBERED // 4]
            ids = [*map(known.get, part)]
            try:
                out.append(b"".join(ids))
            except TypeError:  # some are new: a look for them first would cost a step per word of every text
                new = [i for i, found in enumerate(ids) if found is None]
                self._learn(list({part[i] for i in new}))
                for i in new:
                    ids[i] = known[part[i]]
                out.append(b"".join(ids))
        return b"".join(out)


def pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY) -> DataFrame:
    """One row per piece: documents of more than `capacity` ids (END_ID included) are cut, others are one piece.

    A null text is empty: one piece that holds END_ID alone. Repeated rows give pieces of their own.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = WordIds(tokenizer_path)
        end = np.array([END_ID], dtype="<u4").tobytes()
        for batch in batches:
            rows: list[tuple] = []
            for doc_id, text, key in zip(*(batch.column(n) for n in ("doc_id", "text", "row_key")), strict=True):
                ids = ids_of.of(text.as_py() or "") + end
                n = len(ids) // 4
                for piece, start in enumerate(range(0, n, capacity)):
                    length = min(capacity, n - start)
                    rows.append((doc_id.as_py(), key.as_py(), piece, start, length, zlib.crc32(memoryview(ids)[4 * start : 4 * (start + length)])))
            if rows:
                yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _PIECE_SCHEMA, strict=True)], schema=_PIECE_SCHEMA)

    return texts(docs).mapInArrow(lean(cut), PIECES)


@dataclass(frozen=True)
class Range:
    """Pieces `first` to `first + count * uses - 1` of a length lie in sequences from `sequence` on, `uses` to a sequence,
    the first of them at `offset`."""

    length: int
    first: int
    count: int
    uses: int
    sequence: int
    offset: int


def fullest(longest: int, left: dict[int, int], capacity: int) -> dict[int, int]:
    """Lengths and uses of the fullest sequence that holds `longest`, no length used more often than `left` allows.

    Bit s of a row is set if some of the lengths so far sum to s; a length of multiplicity m is added in powers of two.
    Longer lengths come first, and the search ends at the first exact fit. Walking the rows back gives the combination.
    """
    room = capacity - longest
    mask = (1 << (room + 1)) - 1
    reach = 1
    steps: list[tuple[int, int, int]] = []
    for length in sorted((k for k in left if k <= room), reverse=True):
        many = min(left[length] - (length == longest), room // length)
        take = 1
        while many > 0 and not reach >> room & 1:
            take = min(take, many)
            more = reach | (reach << (length * take)) & mask
            if more != reach:
                steps.append((length, take, reach))
                reach = more
            many -= take
            take *= 2
        if reach >> room & 1:
            break
    total = reach.bit_length() - 1
    used = {longest: 1}
    for length, take, before in reversed(steps):
        if not before >> total & 1:
            used[length] = used.get(length, 0) + take
            total -= length * take
    return used


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> tuple[list[Range], int]:
    """Ranges for all pieces of each length, and the number of sequences.

    Minimum bin slack: the longest length left opens a sequence, the fullest combination is found and taken out as many
    times as the counts allow at once.
    """
    left = {k: n for k, n in counts.items() if n > 0}
    given: dict[int, int] = {}
    ranges: list[Range] = []
    sequence = 0
    while left:
        used = fullest(max(left), left, capacity)
        times = min(left[k] // u for k, u in used.items())
        offset = 0
        for length, uses in sorted(used.items(), reverse=True):
            first = given.get(length, 0)
            ranges.append(Range(length, first, times, uses, sequence, offset))
            offset += length * uses
            given[length] = first + times * uses
            left[length] -= times * uses
            if not left[length]:
                del left[length]
        sequence += times
    return ranges, sequence


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset): every piece in a sequence of at most `capacity` ids.

    Sequences are gapless from offset 0. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    cut = phase(pieces(docs, tokenizer_path, capacity), "pack-pieces")
    per_length = {r[0]: r[1] for r in cut.groupBy("length").count().collect()}  # at most `capacity` rows
    ranges, _ = plan(per_length, capacity)
    lookup: dict[int, np.ndarray] = {}
    for r in ranges:
        lookup.setdefault(r.length, []).append((r.first, r.uses, r.sequence, r.offset))
    shared = spark.sparkContext.broadcast({k: np.array(v, dtype=np.int64) for k, v in lookup.items()})

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch.column("length").to_numpy()
            number = batch.column("number").to_numpy()
            sequence, offset = np.empty(len(length), np.int64), np.empty(len(length), np.int64)
            for k in np.unique(length):
                own = np.flatnonzero(length == k)
                t = shared.value[int(k)]
                row = t[np.searchsorted(t[:, 0], number[own], side="right") - 1]
                turn, nth = np.divmod(number[own] - row[:, 0], row[:, 1])
                sequence[own] = row[:, 2] + turn
                offset[own] = row[:, 3] + nth * k
            kept = [batch.column(n) for n in ("doc_id", "piece", "start", "length", "ids_crc32")]
            yield pa.record_batch([*kept, pa.array(sequence), pa.array(offset)], names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    salts = salts_for(max(per_length.values(), default=0))
    ordered = numbered(cut, "length", ["doc_id", "row_key", "piece"], "number", F.xxhash64("row_key", "piece"), salts)
    chosen = ordered.select("doc_id", "piece", "start", "length", "ids_crc32", F.col("number").cast("long").alias("number"))
    return chosen.mapInArrow(lean(place), "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")


def op6_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 2048 ids."""
    import public_tokenizers

    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))

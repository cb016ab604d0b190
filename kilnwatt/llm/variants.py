"""Spelling variants by finite-state composition: vocabulary acceptor, one-edit transducer, vocabulary acceptor.

Two words at one edit share either the head before the middle of the longer one or the tail behind it. The acceptors are
cut there: a partition starts from the state that a head leads to (or, read from the end, a tail), and its words are what is
accepted from that state. A partition of many words is cut in the same way in the middle of what is left, so that it ends
with at most one free symbol. In each partition the free parts become a minimised acceptor; the composition is walked from
its initial state and every accepted pair is given out.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kilnwatt.llm.common import lean, phase, table
from kilnwatt.llm.decontaminate import _small

#: Letters of a run, as a character class.
LETTERS = "[A-Za-zÀ-ÿ]"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LEAST_LENGTH, LEAST_COUNT = 7, 2
#: A form is at least so many times as frequent.
TIMES = 10
#: One in so many occurrences loses a letter.
NOISE = 31
#: Partitions of more words are cut further.
PARTITION = 2_000


def occurrences(docs: DataFrame, least: int = LEAST_LENGTH) -> DataFrame:
    """(doc_id, run): every maximal run of at least `least` letters, A-Z lower-cased, once per occurrence."""
    # A shorter run has no match in it, and a longer one is taken whole, as matching is greedy.
    found = docs.select("doc_id", F.explode(F.regexp_extract_all("text", F.lit(f"{LETTERS}{{{least},}}"), 0)).alias("run"))
    return found.select("doc_id", F.translate("run", UPPER, LOWER).alias("run"))


def misspelt(doc_id: Column, run: Column, every: int = NOISE) -> Column:
    """The run without one of its code points if a checksum of id and run is divisible by `every`; a null id is empty text."""
    named = F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), run)
    h = F.crc32(named.cast("binary"))
    at = (h % F.char_length(run)).cast("int")
    shorter = F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.char_length(run)))
    return F.when(h % every == 0, shorter).otherwise(run)


def vocabulary(words: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """(word, n) of the words that are long and frequent enough. `words` has one row per occurrence."""
    long = words.filter(F.char_length("word") >= least_length)
    return long.groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= least_count)


class Acceptor:
    """Minimised acceptor of sorted, distinct words: `moves[state]` by symbol, in the order of symbols, and `ends`."""

    def __init__(self, words: Iterable[str]):
        self.moves: list[dict[str, int]] = []
        self.ends: list[bool] = []
        known: dict[tuple, int] = {}
        path: list[tuple[dict[str, int], bool]] = [({}, False)]
        last = ""

        def close(depth: int) -> None:
            while len(path) > depth + 1:
                moves, end = path.pop()
                state = self._state(known, moves, end)
                path[-1][0][last[len(path) - 1]] = state

        for word in words:
            shared = 0
            for x, y in zip(last, word, strict=False):
                if x != y:
                    break
                shared += 1
            close(shared)
            path += [({}, False) for _ in word[shared:]]
            path[-1] = (path[-1][0], True)
            last = word
        close(0)
        self.start = self._state(known, *path[0])

    def _state(self, known: dict[tuple, int], moves: dict[str, int], end: bool) -> int:
        key = (end, *moves.items())
        if key not in known:
            known[key] = len(self.moves)
            self.moves.append(moves)
            self.ends.append(end)
        return known[key]


class Composition:
    """Acceptor, one insertion, deletion or replacement, and the acceptor again. Its states before the edit are pairs of
    equal states, written q; after it (p, q)."""

    def __init__(self, acceptor: Acceptor):
        self.moves, self.ends, self.start = acceptor.moves, acceptor.ends, acceptor.start
        self._meet: dict[tuple[int, int], bool] = {}
        # A state only leads to states closed before it, so their order is that of their numbers.
        self.fruitful = [False] * len(self.moves)
        for q, moves in enumerate(self.moves):
            self.fruitful[q] = any(self.fruitful[x] for x in moves.values()) or any(True for _ in self._edits(q))

    def meet(self, p: int, q: int) -> bool:
        """Whether some rest is accepted from both states."""
        todo = [(p, q)]
        while todo:
            a, b = pair = todo[-1]
            if pair in self._meet:
                todo.pop()
                continue
            if a == b or (self.ends[a] and self.ends[b]):
                self._meet[pair] = True
                continue
            following = [(x, self.moves[b][s]) for s, x in self.moves[a].items() if s in self.moves[b]]
            if any(self._meet.get(f) for f in following):
                self._meet[pair] = True
            else:
                unknown = [f for f in following if f not in self._meet]
                if unknown:
                    todo += unknown
                else:
                    self._meet[pair] = False
        return self._meet[(p, q)]

    def _edits(self, q: int) -> Iterator[tuple[str, int, str, int]]:
        """(symbol read, state, symbol written, state) of the edits from (q, q) that lead to acceptance; no symbol: ''.
        A pair and its mirror image are one."""
        symbols = list(self.moves[q].items())
        for i, (s, x) in enumerate(symbols):
            if self.meet(x, q):
                yield s, x, "", q
            for t, y in symbols[i + 1 :]:
                if self.meet(x, y):
                    yield s, x, t, y

    def pairs(self) -> Iterator[tuple[str, str]]:
        """Accepted pairs, each in one order; a pair that has several edits comes several times."""
        before = [(self.start, None)] if self.fruitful[self.start] else []
        while before:
            q, head = before.pop()
            for s, x, t, y in self._edits(q):
                after = [(x, y, None)]
                while after:
                    a, b, tail = after.pop()
                    if self.ends[a] and self.ends[b]:
                        start, end = _spelt(head), _spelt(tail)
                        yield start + s + end, start + t + end
                    after += [(c, self.moves[b][u], (tail, u)) for u, c in self.moves[a].items() if u in self.moves[b] and self.meet(c, self.moves[b][u])]
            before += [(x, (head, s)) for s, x in self.moves[q].items() if self.fruitful[x]]


def _spelt(path: tuple | None) -> str:
    out = []
    while path:
        path, symbol = path
        out.append(symbol)
    return "".join(reversed(out))


def _cut(rows: DataFrame) -> DataFrame:
    """Each row twice: with half of the free symbols of the longer word added to the head, and with the rest added to the
    tail. A pair whose edit lies behind the half agrees in the first, any other one in the second."""
    free = F.col("longer") - F.col("head") - F.col("tail")
    half = F.floor(free / 2).cast("int")
    both = F.array(
        F.struct((F.col("head") + half).alias("head"), F.col("tail").alias("tail")),
        F.struct(F.col("head").alias("head"), (F.col("tail") + free - half).alias("tail")),
    )
    # A tail as long as the longer word would be longer than the shorter one; with one free symbol nothing is left to cut.
    cut = rows.withColumn("_to", F.explode(both)).select("word", "n", "longer", F.col("_to.head").alias("head"), F.col("_to.tail").alias("tail"))
    return cut.filter(F.col("head") + F.col("tail") < F.col("longer"))


def _state() -> Column:
    """Name of a row's partition: the lengths, and the symbols of head and tail."""
    word, head, tail = F.col("word"), F.col("head"), F.col("tail")
    last = F.substring(word, F.char_length(word) - tail + 1, tail)
    return F.concat_ws("|", F.col("longer").cast("string"), head.cast("string"), tail.cast("string"), F.substring(word, F.lit(1), head), last)


def partitions(words: DataFrame, most: int = PARTITION) -> DataFrame:
    """(state, word, n, longer, head, tail): the words of each partition; two words at one edit share at least one.

    Each word stands in partitions of pairs whose longer word has its own length, and of pairs with one symbol more.
    """
    longer = F.explode(F.array(F.char_length("word"), F.char_length("word") + 1)).alias("longer")
    rows = words.select("word", "n", longer, F.lit(0).alias("head"), F.lit(0).alias("tail"))
    # One free symbol is the least there is: at most one word for each symbol, and the word without it.
    rows = _cut(rows.filter("longer > 1")).unionByName(rows.filter("longer <= 1")).withColumn("state", _state())
    while True:
        counts = rows.groupBy("state", "longer", "head", "tail").agg(F.count(F.lit(1)).alias("_n"))
        great = counts.filter((F.col("_n") > most) & (F.col("longer") - F.col("head") - F.col("tail") > 1))
        great = phase(great.select("state"), "variants-great")
        if not great.limit(1).count():
            return rows
        great = _small(great)
        again = _cut(rows.join(great, "state", "left_semi")).withColumn("state", _state())
        rows = phase(rows.join(great, "state", "left_anti").unionByName(again.select(rows.columns)), "variants-partitions")


def near_pairs(words: DataFrame, most: int = PARTITION) -> DataFrame:
    """(a, a_n, b, b_n): each two words that differ by exactly one edit, once. `words` has distinct (word, n)."""
    dealt = partitions(words, most).repartition("state").sortWithinPartitions("state", "word")

    def compose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def accepted() -> pa.RecordBatch:
            counts = dict(held)
            first = held[0][0]
            start, end = first[:head], first[len(first) - tail :] if tail else ""
            # The order of whole words is not that of their free parts where tails follow words of different lengths.
            free = sorted(w[head : len(w) - tail] for w, _ in held)
            found = {tuple(sorted((start + x + end, start + y + end))) for x, y in Composition(Acceptor(free)).pairs()}
            found = sorted(found)
            a, b = [x for x, _ in found], [y for _, y in found]
            columns = [pa.array(a, pa.string()), pa.array([counts[x] for x in a], pa.int64()), pa.array(b, pa.string()), pa.array([counts[x] for x in b], pa.int64())]
            return pa.record_batch(columns, names=["a", "a_n", "b", "b_n"])

        state, head, tail, held = None, 0, 0, []
        for batch in batches:
            for s, w, n, h, t in zip(*(batch.column(c).to_pylist() for c in ("state", "word", "n", "head", "tail")), strict=True):
                if s != state:
                    if len(held) > 1:
                        yield accepted()
                    state, head, tail, held = s, h, t, []
                held.append((w, n))
        if len(held) > 1:
            yield accepted()

    rows = dealt.select("state", "word", "n", "head", "tail")
    return rows.mapInArrow(lean(compose), "a string, a_n long, b string, b_n long").distinct()


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) for the words with a form: forms are followed by doubling, so the rounds are few. Counts grow along
    the way, so it has no circle."""
    now = phase(forms.select("word", F.col("form").alias("root")), "variants-roots")
    while True:
        step = now.select(F.col("word").alias("root"), F.col("root").alias("further"))
        joined = phase(now.join(step, "root", "left"), "variants-further")
        if not joined.filter("further is not null").limit(1).count():
            return now
        now = phase(joined.select("word", F.coalesce("further", "root").alias("root")), "variants-roots")


def grouped(words: DataFrame, times: int = TIMES, most: int = PARTITION) -> DataFrame:
    """(word, form, root, n, n_near, form_n), one row per row of `words`: distinct (word, n).

    Near words differ by exactly one inserted, deleted or replaced code point. A word's form is its most frequent near
    word (ties: the least in code-point order) if that is at least `times` as frequent, else null; its root is the last
    of the forms, or the word itself. An empty table has no rows.
    """
    pairs = phase(near_pairs(words, most), "variants-pairs")
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("near"), F.col("b_n").alias("near_n"))
    both = both.unionByName(pairs.select(F.col("b").alias("word"), F.col("a").alias("near"), F.col("a_n").alias("near_n")))
    best = both.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))
    known = phase(words.join(best, "word", "left"), "variants-known")
    enough = -F.col("best.less") >= times * F.col("n")
    known = known.select(
        "word",
        F.when(enough, F.col("best.near")).alias("form"),
        "n",
        F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(enough, -F.col("best.less")).alias("form_n"),
    )
    roots = _roots(known.filter("form is not null"))
    return known.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of whole texts (null: none), some occurrences with a letter missing."""
    runs = occurrences(table(spark, sf_dir, "documents").select("doc_id", "text"))
    words = vocabulary(runs.select(misspelt(F.col("doc_id"), F.col("run")).alias("word")))
    return grouped(phase(words, "variants-words"))

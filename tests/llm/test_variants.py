"""Spelling variants against all pairs of a small vocabulary."""

import random
import re
import zlib
from collections import Counter

import pytest
from llm_fixtures import SF_DIR, docs, in_order, odd_rows, real  # noqa: F401
from pyspark.sql import functions as F

from kilnwatt.llm import variants
from kilnwatt.llm.queries import QUERIES


def brute_words(rows):
    count = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            low = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{low}".encode())
            if h % 31 == 0:
                low = low[: h % len(low)] + low[h % len(low) + 1 :]
            count[low] += 1
    return {w: n for w, n in count.items() if len(w) >= 7 and n >= 2}


def neighbours(words):
    """Words that become equal when one symbol is deleted or masked."""
    holes = {}
    for w in words:
        for i in range(len(w) + 1):
            if i < len(w):
                holes.setdefault((w[:i], None, w[i + 1 :]), set()).add(w)
            holes.setdefault((w[:i], "", w[i:]), set())
    near = {w: set() for w in words}
    for (a, hole, b), held in holes.items():
        for w in held:
            if hole is None:
                near[w] |= held - {w}
    for w in words:
        for i in range(len(w)):
            shorter = w[:i] + w[i + 1 :]
            if shorter in near:
                near[w].add(shorter)
                near[shorter].add(w)
    return near


def brute_groups(count, times=10):
    near = neighbours(count)
    form = {}
    for w, n in count.items():
        if near[w]:
            best = min(near[w], key=lambda x: (-count[x], x.encode()))
            if count[best] >= times * n:
                form[w] = best
    out = []
    for w, n in count.items():
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, n, len(near[w]), count[form[w]] if w in form else None))
    return out


def test_query(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]
    got = QUERIES["op12_spelling_variants"](spark, SF_DIR)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert in_order(got.collect()) == in_order(brute_groups(brute_words(rows)))


def test_words(spark, docs, odd_rows):  # noqa: F811
    rows = [*odd_rows, (None, "Ünknown unknown UNKNOWN Àbcdefg×÷ÿ"), (7, "a" * 50_000 + " short " + "A" * 50_000), (40, "abcdefgh1abcdefgh abcdefg")]
    runs = variants.occurrences(docs(rows))
    words = variants.vocabulary(runs.select(variants.misspelt(F.col("doc_id"), F.col("run")).alias("word")))
    assert {r.word: r.n for r in words.collect()} == brute_words(rows)
    assert variants.vocabulary(variants.occurrences(docs([])).select(F.col("run").alias("word"))).collect() == []


@pytest.mark.parametrize("most", [2_000, 3, 1])
def test_pairs_of_any_partition(spark, most):
    """Empty and one-letter words, long words, chains of forms, ties, and partitions cut down to one free symbol."""
    rng = random.Random(4)
    count = {"".join(rng.choices("aàb", k=rng.randint(0, 6))): rng.choice([1, 2, 10, 100, 100, 1000]) for _ in range(150)}
    count |= {"x" * 3000: 5, "x" * 3001: 50, "x" * 1500 + "y" + "x" * 1499: 500}
    words = spark.createDataFrame(list(count.items()), "word string, n long")
    assert in_order(variants.grouped(words, most=most).collect()) == in_order(brute_groups(count))


def test_no_words(spark):
    none = spark.createDataFrame([], "word string, n long")
    assert variants.grouped(none).collect() == []
    assert [tuple(r) for r in variants.grouped(spark.createDataFrame([("alone", 3)], "word string, n long")).collect()] == [("alone", None, "alone", 3, 0, None)]


def test_acceptor_is_minimal():
    words = sorted(a + m + b for a in "abc" for m in ("", "x") for b in ("end", "ending"))
    assert len(variants.Acceptor(words).moves) == 9  # start, after the first letter, after x, and the six of the common rest

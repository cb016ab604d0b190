"""Benchmark decontamination by winnowing, in DataFrame operations only.

Both sides keep the least of every `WINDOW` successive k-gram hashes, with k + WINDOW - 1 = the span that must not be
missed, so any shared span of that many words has a fingerprint in common. Documents whose fingerprints meet those of an
item are opened up: a hit extends to every window of the span that the document shares with an item, and successive
windows to runs. Windows are compared by two 64-bit names, once for each different window of an item, so that repeated
words cost no more than others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kilnwatt.llm.common import phase, table, texts

SPAN = 10
GRAM = 8
#: Rows of (hash, ...) a join side may have to be broadcast; counted before each join, which is a sorted one beyond it.
BROADCAST_ROWS = 500_000
#: Two independent names of a row's id and text.
KEY = ("row_key", "row_key2")

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BREAKS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """Words of a text with A-Z in lower case; null and empty texts have none."""
    # `lower` is quick on ASCII; elsewhere it would change other letters too.
    low = F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))
    return F.coalesce(F.array_remove(F.split(low, BREAKS), ""), F.array().cast("array<string>"))


def n_words(text: Column) -> Column:
    return F.coalesce(F.size(F.array_remove(F.split(text, BREAKS), "")), F.lit(0)).cast("long")


def _shifted(array: Column, by: int) -> Column:
    return F.slice(array, by + 1, F.greatest(F.size(array) - by, F.lit(0)))


def _sliding(df: DataFrame, source: str, name: str, width: int, merge) -> DataFrame:
    """Add `name`: `merge` over every `width` successive elements of `source`, by doubling.

    Each step is a projection of its own, so that no step is evaluated twice. Past the end of the array a window holds
    fewer elements; such entries can only add meetings that fail later.
    """
    done, have = df.withColumn(name, F.col(source)), 1
    while have < width:
        step = min(have, width - have)
        done = done.withColumn("_moved", _shifted(F.col(name), step)).withColumn(name, F.zip_with(name, "_moved", merge)).drop("_moved")
        have += step
    return done


def grams(df: DataFrame, length: int, name: str, seed: int = 0) -> DataFrame:
    """Add hashes of all `length`-word sequences of the column `words`; another seed gives independent ones."""
    hashed = df.withColumn("_h", F.transform("words", lambda w: F.xxhash64(F.lit(seed), w) if seed else F.xxhash64(w)))
    # The merge tells (a, b) from (b, a); overlapping halves are fine, as they name the same words on both sides.
    return _sliding(hashed, "_h", name, length, lambda a, b: F.xxhash64(a, b)).drop("_h")


# Arrays that are costly to make are opened with the outer generators: for the plain ones the optimizer filters empty
# arrays first, and the filter would evaluate every step of the array again, twice as often with each step.


def winnowed(df: DataFrame, gram: int, window: int) -> DataFrame:
    """Add `prints`: distinct least hashes over every `window` successive `gram`-word sequences."""
    least = _sliding(grams(df, gram, "_g"), "_g", "_m", window, lambda a, b: F.least(a, b))
    return least.withColumn("prints", F.array_distinct("_m")).drop("_g", "_m")


def _small(side: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Marked for broadcast if the written table has at most `limit` rows."""
    return F.broadcast(side) if side.limit(limit + 1).count() <= limit else side


def _windows(df: DataFrame, length: int, *keys: str) -> DataFrame:
    """(keys, p, one, two): place and both names of every window of `length` words."""
    both = grams(grams(df.filter(F.size("words") >= length), length, "_g"), length, "_g2", seed=1)
    whole = F.slice(F.arrays_zip("_g", "_g2"), 1, F.size("words") - length + 1)  # beyond, windows are cut off
    return both.select(*keys, F.posexplode_outer(whole).alias("p", "_w")).select(*keys, "p", F.col("_w._g").alias("one"), F.col("_w._g2").alias("two"))


def _candidates(docs: DataFrame, items: DataFrame, span: int, gram: int) -> DataFrame:
    """(row_key, row_key2, gram_words, print): fingerprints that a document shares with any item.

    Items below `span` words are looked for as a whole: for each of the at most span - 1 lengths that occur, all
    sequences of that length are compared.
    """
    whole = items.filter(F.size("words") >= span)
    item_prints = [winnowed(whole, gram, span - gram + 1).select(F.lit(gram).alias("gram_words"), F.explode_outer("prints").alias("print"))]
    doc_prints = [winnowed(docs, gram, span - gram + 1).select(*KEY, F.lit(gram).alias("gram_words"), F.explode_outer("prints").alias("print"))]
    lengths = sorted(r[0] for r in items.select(F.size("words")).distinct().filter(F.size("words").between(1, span - 1)).collect())
    for n in lengths:
        short = grams(items.filter(F.size("words") == n), n, "_g")
        item_prints.append(short.select(F.lit(n).alias("gram_words"), F.element_at("_g", 1).alias("print")))
        doc_prints.append(grams(docs.filter(F.size("words") >= n), n, "_g").select(*KEY, F.lit(n).alias("gram_words"), F.explode_outer(F.array_distinct("_g")).alias("print")))
    wanted, found = item_prints[0], doc_prints[0]
    for more_items, more_docs in zip(item_prints[1:], doc_prints[1:], strict=True):
        wanted, found = wanted.unionByName(more_items), found.unionByName(more_docs)
    wanted = phase(wanted.distinct(), "decontaminate-items")
    return found.join(_small(wanted), ["gram_words", "print"])


def contamination(docs: DataFrame, items: DataFrame, span: int = SPAN, gram: int = GRAM) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items): one row per row of `docs`.

    A hit word lies in an occurrence of `span` successive item words, or of a whole item that has fewer; `items` are the
    sorted distinct ids of items that occur. Null and empty texts have no words, items without words never occur, null
    item ids are not reported (their words are still hit), repeated item ids count once, repeated rows are judged alike.
    """
    keyed = texts(docs).withColumn("row_key2", F.xxhash64(F.lit(1), "doc_id", "text"))
    spread = items.select(F.col("item_id"), words(F.col("text")).alias("words")).withColumn("item", F.xxhash64("item_id", "words"))
    spread = phase(spread.filter(F.size("words") > 0).dropDuplicates(["item", "words"]), "decontaminate-words")
    split = keyed.select(*KEY, words(F.col("text")).alias("words"))
    hits = phase(_candidates(split, spread, span, gram).select(*KEY, "gram_words").distinct(), "decontaminate-hits")

    suspects = keyed.select(*KEY, "text").join(_small(hits.select(*KEY).distinct()), list(KEY), "left_semi").dropDuplicates(list(KEY))
    suspects = phase(suspects, "decontaminate-suspects").withColumn("words", words(F.col("text"))).drop("text")
    lengths = sorted({r[0] for r in hits.select("gram_words").distinct().collect() if r[0] < span} | {span})
    names = spread.select("item", F.col("item_id").cast("string").alias("name"))
    starts = held = None
    for n in lengths:
        own = _windows(spread.filter(F.size("words") >= span if n == span else F.size("words") == n), n, "item")
        own = own.withColumn("length", F.lit(n))
        theirs = _windows(suspects, n, *KEY).withColumn("length", F.lit(n))
        held = own if held is None else held.unionByName(own)
        starts = theirs if starts is None else starts.unionByName(theirs)
    window = ["length", "one", "two"]
    held = phase(held.select("item", *window).distinct(), "decontaminate-windows")
    met = phase(starts.join(_small(held.select(*window).distinct()), window, "left_semi"), "decontaminate-met")

    # Words covered by windows that overlap: each adds what lies beyond the end of those before it.
    before = Window.partitionBy(*KEY).orderBy("p", "length").rowsBetween(Window.unboundedPreceding, -1)
    end = F.col("p") + F.col("length")
    reached = F.coalesce(F.max(end).over(before), F.lit(0))
    fresh = met.withColumn("fresh", F.greatest(end - F.greatest(reached, F.col("p")), F.lit(0)))
    n_hit = fresh.groupBy(*KEY).agg(F.sum("fresh").alias("n_hit"))
    occurring = met.select(*KEY, *window).distinct().join(held, window).select(*KEY, "item").distinct()
    occurring = occurring.join(names, "item").select(*KEY, "name").distinct()
    occurring = occurring.groupBy(*KEY).agg(F.sort_array(F.collect_list("name")).alias("items"))
    found = phase(n_hit.join(occurring, list(KEY)), "decontaminate-found")
    every = keyed.select("doc_id", *KEY, n_words(F.col("text")).alias("n_words")).join(_small(found), list(KEY), "left")
    none = F.array().cast("array<string>")
    return every.select(
        "doc_id",
        *KEY,
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
        F.coalesce("items", none).alias("items"),
    )


def clean(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of `docs`, all columns, without any hit word."""
    bad = phase(contamination(docs, items).filter(F.col("n_hit") > 0).select(*KEY).distinct(), "decontaminate-bad")
    one, two = F.xxhash64("doc_id", "text"), F.xxhash64(F.lit(1), "doc_id", "text")
    keyed = docs.select(F.struct(*map(F.col, docs.columns)).alias("row"), one.alias(KEY[0]), two.alias(KEY[1]))
    return keyed.join(_small(bad), list(KEY), "left_anti").select("row.*")


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated")
    )


OP1_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
), bw AS (
  SELECT DISTINCT item_id, n, array_to_string(w[i : i + n - 1], ' ') AS k
  FROM (SELECT item_id, w, least(len(w), 10) AS n, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM b WHERE len(w) > 0)
), dw AS (
  SELECT doc_id, i, n, array_to_string(w[i : i + n - 1], ' ') AS k
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM bw) WHERE len(w) >= n)
), hit AS (SELECT doc_id, i, dw.n, item_id FROM dw JOIN bw ON dw.k = bw.k AND dw.n = bw.n),
pos AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hit) GROUP BY doc_id),
it AS (SELECT doc_id, count(*) AS n_items, string_agg(name, ',' ORDER BY name) AS names
       FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS name FROM hit) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN pos USING (doc_id) LEFT JOIN it USING (doc_id)
"""

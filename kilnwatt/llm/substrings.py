"""Substring dedup on a de Bruijn graph of words.

Every window of `WIDTH` words is an edge between its first and last `WIDTH - 1` words. Edges are not moved one by one:
windows that share an anchor and follow one another in a text form a path, equal paths of all texts are merged by an
aggregation, and only the merged paths are opened into edges, which are counted to find the repeated ones. The runs of
repeated edges within a path then go back by a join to every place in a text where the path lies, and where their source
coordinates meet they close up to the long repeated spans, whose words are removed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kilnwatt.llm.anchors import WINDOW_BYTES, Scheme, candidate_segments, covered, distinct_texts, marked_windows, repeated_anchors, text_masks, with_results
from kilnwatt.llm.common import lean, phase, table

WIDTH = 35
GRAM = 6


def repeated_edges(segments: DataFrame) -> DataFrame:
    """(anchor, path, mask): of each merged path, the edges that start in more than one place."""
    paths = segments.groupBy("anchor", "body").agg(F.count(F.lit(1)).alias("places"), F.first("windows").alias("windows"))
    paths = phase(paths.withColumn("path", F.xxhash64("body")), "substring-paths")
    at = F.explode(F.sequence(F.lit(0), F.col("windows") - 1)).alias("at")
    edges = paths.select("anchor", "path", "places", "body", at)
    edges = edges.select("anchor", "path", "places", "at", F.substring("body", F.col("at") * WINDOW_BYTES + 1, F.lit(WINDOW_BYTES)).alias("edge"))
    often = edges.groupBy("edge").agg(F.sum("places").alias("n")).filter(F.col("n") > 1).select("edge")
    # Edges of a path that lies in several places are repeated as they are; the others have to be looked up.
    alone = edges.filter(F.col("places") == 1).join(often, "edge")
    bit = F.expr("shiftleft(1L, at)")
    masks = alone.groupBy("anchor", "path").agg(F.bit_or(bit).alias("mask"))
    whole = paths.filter(F.col("places") > 1).select("anchor", "path", F.expr("shiftleft(1L, windows) - 1").alias("mask"))
    return masks.unionByName(whole)


def repeated_spans(docs: DataFrame, width: int = WIDTH, gram: int = GRAM) -> DataFrame:
    """Rows of `docs` (all columns) with the marks of their repeated windows, to be read by `removal`."""
    scheme = Scheme("words", width, gram)
    distinct = distinct_texts(docs)
    hits = repeated_anchors(docs, scheme, within=True)
    segments = phase(candidate_segments(docs, distinct, hits, scheme), "substring-segments")
    runs = phase(text_masks(segments, repeated_edges(segments)), "substring-runs")
    return with_results(docs, distinct, runs)


def removal(text: str | None, copies: int | None, runs: list[dict] | None, width: int = WIDTH) -> tuple[int, int, bytes]:
    """(words, removed words, kept words joined by one space). A text with copies is repeated wherever a window fits."""
    words = (text or "").encode().split()
    if (copies or 0) > 1:
        return (len(words), len(words), b"") if len(words) >= width else (len(words), 0, b" ".join(words))
    gone = covered(marked_windows(runs), width, len(words))
    return len(words), int(gone.sum()), b" ".join([w for w, g in zip(words, gone.tolist(), strict=True) if not g])


RESULT = "doc_id long, n_words long, n_removed long, kept_sha256 string"


def deduplicated(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256), one row per row of `docs`.

    Each word covered by a window of `width` words that also starts anywhere else, the same text included, is removed;
    all windows are judged on the input. Null and empty texts have no words; repeated rows are repeated texts; null ids
    are kept. Other columns play no part.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [removal(*row, width) for row in zip(*(batch.column(n).to_pylist() for n in ("text", "_copies", "_runs")), strict=True)]
            n, gone, kept = zip(*made, strict=True) if made else ((), (), ())
            digests = [hashlib.sha256(k).hexdigest() for k in kept]
            yield pa.record_batch(
                [batch.column("doc_id").cast(pa.int64()), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(digests, pa.string())],
                names=["doc_id", "n_words", "n_removed", "kept_sha256"],
            )

    found = repeated_spans(docs.select("doc_id", "text"), width)
    return found.select("doc_id", "text", "_copies", "_runs").mapInArrow(lean(read), RESULT)


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return deduplicated(table(spark, sf_dir, "documents"))

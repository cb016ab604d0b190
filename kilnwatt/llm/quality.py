"""Quality classifier from positive and unlabelled texts: non-negative unbiased risk with an estimated class prior.

Texts become a few shape features in one pass without a shuffle. A bounded sample of trusted positives and of all
texts (unlabelled, whatever their labels say) reaches the driver, where a small network starts; the class prior comes
from the scores of all positives and all texts, counted by Spark, and the last steps follow the risk over all texts, whose
gradient Spark adds up. Scoring is again one pass. Ids, languages, sources and labels are never features.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kilnwatt.llm.common import lean, phase, table

#: Trusted positives used for fitting, and texts used for its first steps, at most: those with the smallest hash of their id.
SAMPLE = 8_000
HIDDEN = 12
#: Steps on the sample, then steps whose unlabelled risk covers all texts (one pass over the written features each).
STEPS, WHOLE_STEPS = 400, 8
#: Scores are counted in bins of their logit, this many for each unit between -30 and 30.
BINS_PER_UNIT = 40
#: Texts are read in slices of so many bytes, whose shares are averaged by length.
SLICE = 4_000_000
HELD_OUT = 2
THRESHOLD = 0.7

FEATURES = (
    "log_bytes", "upper", "digit", "space", "newline", "stops", "marks", "symbols", "beyond_ascii", "letters",
    "word_bytes", "repeats", "distinct", "odd_ends", "shouted",
)
#: Byte classes: sentence punctuation, exclamation and question marks, all other ASCII symbols.
STOPS, MARKS = b".,;:'\"()-", b"!?"


def _classes() -> np.ndarray:
    kinds = np.zeros((8, 256))
    for b in range(256):
        c = bytes([b])
        at = 0 if c.isupper() else 1 if c.isdigit() else 2 if c in b" \t" else 3 if c in b"\r\n\v\f" else 4 if c in STOPS else 5 if c in MARKS else 7 if b > 127 else None if c.islower() else 6
        if at is not None:
            kinds[at, b] = 1
    return kinds


def shape(text: str | None, classes: np.ndarray) -> list[float]:
    """Features of a whole text, in the order of FEATURES; null and empty texts have zeros."""
    data = (text or "").encode()
    if not data:
        return [0.0] * len(FEATURES)
    total = np.zeros(13)
    for at in range(0, len(data), SLICE):
        part = data[at : at + SLICE]
        shares = classes @ np.bincount(np.frombuffer(part, dtype=np.uint8), minlength=256)
        words = part.split()
        n = max(1, len(words))
        same = sum(map(bytes.__eq__, words, words[1:])) / n
        distinct = len(set(words)) / n
        odd = sum(1 for w in words if not (w[-1] > 127 or 48 <= w[-1] <= 57 or 65 <= w[-1] <= 90 or 97 <= w[-1] <= 122 or w[-1] in STOPS)) / n
        shouted = sum(map(bytes.isupper, words)) / n
        total += [*shares, same * len(part), distinct * len(part), odd * len(part), shouted * len(part), n]
    size = len(data)
    upper, digit, space, newline, stops, marks, symbols, beyond, same, distinct, odd, shouted = total[:12] / size
    letters = 1 - digit - space - newline - stops - marks - symbols
    return [float(np.log1p(size)), upper, digit, space, newline, stops, marks, symbols, beyond, letters, size / total[12] / 10, same, distinct, odd, shouted]


def shapes(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, features): one row per document. A null id is never held out and never labelled."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes = _classes()
        for batch in batches:
            made = [shape(t.as_py(), classes) for t in batch.column("text")]
            yield pa.record_batch([batch.column("doc_id"), batch.column("held_out"), pa.array(made, pa.list_(pa.float32()))], names=["doc_id", "held_out", "features"])

    return docs.select("doc_id", fold().alias("held_out"), "text").mapInArrow(lean(read), "doc_id long, held_out boolean, features array<float>")


def fold() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == HELD_OUT, F.lit(False))


class Net:
    """One hidden layer on standardised features; `score` is a probability."""

    def __init__(self, centre: np.ndarray, width: np.ndarray, seed: int = 7):
        rng = np.random.default_rng(seed)
        d = len(centre)
        self.centre, self.width = centre, width
        self.w = [rng.normal(0, 1 / np.sqrt(d), (d, HIDDEN)), np.zeros(HIDDEN), rng.normal(0, 1 / np.sqrt(HIDDEN), HIDDEN), np.zeros(1)]
        self.first, self.second, self.steps = [np.zeros_like(w) for w in self.w], [np.zeros_like(w) for w in self.w], 0

    def inputs(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.centre) / self.width, -8, 8)

    def logits(self, z: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        hidden = np.tanh(z @ self.w[0] + self.w[1])
        return hidden @ self.w[2] + self.w[3], hidden

    def score(self, x: np.ndarray) -> np.ndarray:
        return _sigmoid(self.logits(self.inputs(x))[0])

    def gradient(self, z: np.ndarray, hidden: np.ndarray, slope: np.ndarray) -> list[np.ndarray]:
        back = np.outer(slope, self.w[2]) * (1 - hidden**2)
        return [z.T @ back, back.sum(0), hidden.T @ slope, np.array([slope.sum()])]

    def as_negative(self, x: np.ndarray) -> tuple[int, float, list[np.ndarray]]:
        """Of rows taken as negatives: their number, the sum of l(-g) and its gradient, l the logistic loss."""
        z = self.inputs(x)
        g, hidden = self.logits(z)
        return len(x), float(np.logaddexp(0, g).sum()), self.gradient(z, hidden, _sigmoid(g))

    def descend(self, grads: list[np.ndarray], rate: float) -> None:
        """One step of Adam."""
        self.steps += 1
        for i, g in enumerate(grads):
            g = g + 1e-5 * self.w[i]
            self.first[i] = 0.9 * self.first[i] + 0.1 * g
            self.second[i] = 0.999 * self.second[i] + 0.001 * g * g
            self.w[i] = self.w[i] - rate * (self.first[i] / (1 - 0.9**self.steps)) / (np.sqrt(self.second[i] / (1 - 0.999**self.steps)) + 1e-8)

    def step(self, positive: np.ndarray, unlabelled: tuple[int, float, list[np.ndarray]], prior: float | None, rate: float = 0.03) -> None:
        """With a prior p the risk is p E+[l(g)] + max(0, Eu[l(-g)] - p E+[l(-g)]); while the second part is negative, its
        own gradient is followed upwards. Without one, positives are simply told from the unlabelled. Of the unlabelled
        only what `as_negative` gives is needed, so that their sums may come from anywhere."""
        z = self.inputs(positive)
        g, hidden = self.logits(z)
        s, n = _sigmoid(g), len(positive)
        count, loss, slopes = unlabelled
        if prior is None:
            parts = self.gradient(z, hidden, (s - 1) / n / 2), [x / count / 2 for x in slopes]
        elif loss / count - prior * np.logaddexp(0, g).mean() >= 0:
            parts = self.gradient(z, hidden, prior * (s - 1 - s) / n), [x / count for x in slopes]
        else:
            parts = self.gradient(z, hidden, prior * s / n), [-x / count for x in slopes]
        self.descend([x + y for x, y in zip(*parts, strict=True)], rate)

    def fit(self, positive: np.ndarray, unlabelled: np.ndarray, prior: float | None) -> Net:
        for _ in range(STEPS):
            self.step(positive, self.as_negative(unlabelled), prior)
        return self


def _sigmoid(g: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(g, -30, 30)))


def class_prior(positive: np.ndarray, unlabelled: np.ndarray) -> float:
    """Share of positives among the unlabelled, as far as scores show it.

    Above any score, positives among the unlabelled can't be rarer than their share of trusted positives there; the
    least ratio over all scores, with a bound for chance, is the estimate.
    """
    order = np.sort(positive)[::-1]
    ranked = np.sort(unlabelled)[::-1]
    share_u = np.searchsorted(-ranked, -order, side="right") / len(ranked)
    return _least_ratio(np.arange(1, len(order) + 1) / len(order), share_u, len(order), len(ranked))


def counted_prior(positive: np.ndarray, unlabelled: np.ndarray) -> float:
    """`class_prior` from counts per bin of scores, lowest bin first."""
    above_p, above_u = np.cumsum(positive[::-1]), np.cumsum(unlabelled[::-1])
    some = above_p > 0
    return _least_ratio((above_p / above_p[-1])[some], (above_u / above_u[-1])[some], above_p[-1], above_u[-1])


def _least_ratio(share_p: np.ndarray, share_u: np.ndarray, n_p: int, n_u: int) -> float:
    slack = np.sqrt(np.log(40) / 2 / n_u) + np.sqrt(np.log(40) / 2 / n_p)
    best = np.argmin((share_u + slack) / share_p)
    return float(np.clip(share_u[best] / share_p[best], 0.05, 0.99))


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    return np.asarray(batch.column("features").flatten(), dtype=float).reshape(batch.num_rows, len(FEATURES))


def score_counts(features: DataFrame, net: Net) -> np.ndarray:
    """Rows of `features` per bin of the logit; at most one row per bin and task is exchanged."""
    bins = 60 * BINS_PER_UNIT + 1

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(bins, dtype=np.int64)
        for batch in batches:
            if batch.num_rows:
                g = net.logits(net.inputs(_matrix(batch)))[0]
                total += np.bincount(((np.clip(g, -30, 30) + 30) * BINS_PER_UNIT).astype(np.int64), minlength=bins)
        at = np.flatnonzero(total)
        yield pa.record_batch([pa.array(at, pa.int64()), pa.array(total[at])], names=["bin", "n"])

    rows = features.select("features").mapInArrow(lean(count), "bin long, n long").groupBy("bin").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(bins, dtype=np.int64)
    for r in rows:
        out[r["bin"]] = r["n"]
    return out


def unlabelled_sums(features: DataFrame, net: Net) -> tuple[int, float, list[np.ndarray]]:
    """`Net.as_negative` over all rows of `features`: one row per number of the network and task is exchanged."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(2 + sum(w.size for w in net.w))
        for batch in batches:
            if batch.num_rows:
                n, loss, slopes = net.as_negative(_matrix(batch))
                total += np.concatenate([[n, loss], *[x.ravel() for x in slopes]])
        yield pa.record_batch([pa.array(np.arange(len(total))), pa.array(total)], names=["at", "value"])

    rows = features.select("features").mapInArrow(lean(add), "at long, value double").groupBy("at").agg(F.sum("value").alias("value")).collect()
    total = np.array([r["value"] for r in sorted(rows, key=lambda r: r["at"])])
    ends = np.cumsum([w.size for w in net.w])
    return int(total[0]), float(total[1]), [x.reshape(w.shape) for x, w in zip(np.split(total[2:], ends[:-1]), net.w, strict=True)]


def fit(features: DataFrame, labels: DataFrame) -> tuple[Net, float] | None:
    """The fitted network and the prior, or None without positives or texts. `features` is read several times, so it
    should be a written table.

    Trusted positives are documents outside the held-out fold that `labels` gives quality 1; repeated labels count
    once. Unlabelled texts come from all folds, since no label of theirs is read. The prior rests on the scores that a
    network fitted on one half of both samples gives to all rows outside that half (0.5 if there are none).
    """
    by_id, by_row = F.xxhash64("doc_id"), F.xxhash64("doc_id", F.lit(1))
    trusted = labels.filter((F.col("quality") == 1) & F.col("doc_id").isNotNull() & ~fold()).select("doc_id").distinct()
    chosen = trusted.orderBy(by_id, "doc_id").limit(SAMPLE)
    positive = features.join(F.broadcast(chosen), "doc_id").select(by_id.alias("place"), "doc_id", "features").orderBy("place", "doc_id").limit(SAMPLE).toPandas()
    unlabelled = features.select(by_row.alias("place"), "doc_id", "features").orderBy("place", "doc_id").limit(SAMPLE).toPandas()
    if positive.empty or unlabelled.empty:
        return None
    p, u = np.stack(positive["features"]).astype(float), np.stack(unlabelled["features"]).astype(float)
    centre, width = p.mean(0), np.maximum(p.std(0), 0.02)
    half_p, half_u = len(p) // 2, len(u) // 2
    prior = 0.5
    if half_p and half_u:
        apart = Net(centre, width).fit(p[:half_p], u[:half_u], None)
        rest = trusted.filter(by_id > int(positive["place"][half_p - 1]))
        counts_p = score_counts(features.join(rest, "doc_id"), apart)
        counts_u = score_counts(features.filter(by_row > int(unlabelled["place"][half_u - 1])), apart)
        if counts_p.any() and counts_u.any():
            prior = counted_prior(counts_p, counts_u)
    net = Net(centre, width).fit(p, u, prior)
    for _ in range(WHOLE_STEPS):
        net.step(p, unlabelled_sums(features, net), prior, 0.005)
    return net, prior


def scores(features: DataFrame, model: tuple[Net, float] | None) -> DataFrame:
    """(doc_id, held_out, score, predicted). Without a model every score is 0.5."""

    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            s = model[0].score(_matrix(batch)) if model else np.full(n, 0.5)
            yield pa.record_batch(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(s, pa.float64()), pa.array((s >= THRESHOLD).astype(np.int32))],
                names=["doc_id", "held_out", "score", "predicted"],
            )

    return features.mapInArrow(lean(rate), "doc_id long, held_out boolean, score double, predicted int")


def keep_good(docs: DataFrame, model: tuple[Net, float] | None) -> DataFrame:
    """The rows of `docs`, all columns, that score at least THRESHOLD: one pass, no shuffle."""

    def good(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes = _classes()
        for batch in batches:
            if batch.num_rows:
                x = np.array([shape(t.as_py(), classes) for t in batch.column("text")])
                kept = model[0].score(x) >= THRESHOLD if model else np.ones(batch.num_rows, bool)
                yield batch.filter(pa.array(kept))

    return docs.mapInArrow(lean(good), docs.schema)


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score every document; labels are learnt from outside the held-out fold only."""
    features = phase(shapes(table(spark, sf_dir, "documents")), "quality-shapes")
    return scores(features, fit(features, table(spark, sf_dir, "labels")))

"""Classifier, neighbours, sharding and the pipeline."""

import os
import sys
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from llm_fixtures import SF_DIR, docs, in_order, odd_rows, real  # noqa: F401

from kilnwatt.llm import neighbours, quality, sharding
from kilnwatt.llm.queries import QUERIES

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))


def test_held_out_quality(spark):
    sf_dir = SF_DIR.replace("sf0.001", "sf0.01")
    got = QUERIES["op9_quality"](spark, sf_dir).toPandas().merge(pd.read_parquet(f"{sf_dir}/labels.parquet"), on="doc_id")
    assert (got.held_out == [zlib.crc32(str(i).encode()) % 4 == 2 for i in got.doc_id]).all()
    held = got[got.held_out]
    assert (held.predicted == held.quality).mean() > 0.97
    assert got.score.between(0, 1).all() and (got.predicted == (got.score >= 0.7)).all()


def test_quality_odd_rows(spark, docs, odd_rows):  # noqa: F811
    features = quality.shapes(docs(odd_rows))
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert quality.fit(features, none) is None
    assert {r.score for r in quality.scores(features, None).collect()} == {0.5}
    labels = spark.createDataFrame([(i, 1, 0) for i in range(100, 130)] + [(100, 1, 0), (None, 1, 0), (4, None, 0), (999, 1, 1)], "doc_id long, quality int, toxic int")
    model = quality.fit(features, labels)
    out = quality.scores(features, model).collect()
    assert len(out) == len(odd_rows) and all(0 <= r.score <= 1 for r in out)
    kept = quality.keep_good(docs(odd_rows), model)
    assert kept.columns == docs(odd_rows).columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter(r.doc_id for r in out if r.predicted)
    assert quality.scores(quality.shapes(docs([])), model).collect() == []


def test_class_prior():
    rng = np.random.default_rng(2)
    positive, negative = rng.normal(3, 1, 4000), rng.normal(-3, 1, 4000)
    for share in (0.3, 0.8):
        mixed = np.where(rng.random(4000) < share, rng.permutation(positive), negative)
        assert abs(quality.class_prior(rng.normal(3, 1, 4000), mixed) - share) < 0.06


def test_quality_sums_cover_all_rows(spark):
    """Counts of scores and the gradient over all texts, added up by Spark, equal those of one matrix."""
    features = quality.shapes(spark.read.parquet(f"{SF_DIR}/documents.parquet")).repartition(5).cache()
    x = np.array([r.features for r in features.collect()])
    net = quality.Net(x.mean(0), np.maximum(x.std(0), 0.02))
    n, loss, slopes = quality.unlabelled_sums(features, net)
    want = net.as_negative(x)
    assert n == want[0] == len(x) and abs(loss - want[1]) < 1e-6 * abs(want[1])
    assert all(np.allclose(a, b, rtol=1e-6, atol=1e-6) for a, b in zip(slopes, want[2], strict=True))
    logits = net.logits(net.inputs(x))[0]
    counts = quality.score_counts(features, net)
    assert counts.sum() == len(x)
    assert (counts == np.bincount(((logits + 30) * quality.BINS_PER_UNIT).astype(int), minlength=len(counts))).all()
    rng = np.random.default_rng(4)
    positive = rng.normal(2, 1, 5000)
    mixed = np.concatenate([rng.normal(2, 1, 3000), rng.normal(-2, 1, 7000)])
    binned = [np.bincount(((v + 30) * quality.BINS_PER_UNIT).astype(int), minlength=len(counts)) for v in (positive, mixed)]
    assert abs(quality.counted_prior(*binned) - quality.class_prior(positive, mixed)) < 0.01


def test_held_out_ranking(spark):
    """Area under the curve of held-out scores: a good text ranks above a bad one."""
    sf_dir = SF_DIR.replace("sf0.001", "sf0.01")
    got = QUERIES["op9_quality"](spark, sf_dir).toPandas().merge(pd.read_parquet(f"{sf_dir}/labels.parquet"), on="doc_id")
    held = got[got.held_out]
    rank, good = held.score.rank(), held.quality == 1
    assert (rank[good].sum() - good.sum() * (good.sum() + 1) / 2) / (good.sum() * (~good).sum()) > 0.99


def brute_nearest(rows, every, k):
    valid = [(i, np.array(v, dtype=float)) for i, v in rows if i is not None and v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    out = {}
    for q, a in {i: (i, a) for i, a in valid if i % every == 0}.values():
        near = sorted({(-float(a @ b / np.linalg.norm(a) / np.linalg.norm(b)), i) for i, b in valid if i != q})
        out[q] = [i for _, i in near[:k]]
    return out


def test_nearest_recall(spark):
    sf_dir = SF_DIR.replace("sf0.001", "sf0.1")
    table = pd.read_parquet(f"{sf_dir}/embeddings.parquet")
    want = brute_nearest(list(zip(table.vec_id.tolist(), table.embedding.tolist(), strict=True)), 50, 5)
    got = QUERIES["op4_nearest"](spark, sf_dir).toPandas()
    assert set(got.query_id) == set(want) and (got.groupby("query_id")["rank"].apply(sorted).apply(tuple) == (1, 2, 3, 4, 5)).all()
    found = got.groupby("query_id").vec_id.apply(set)
    assert np.mean([len(found[q] & set(w)) / 5 for q, w in want.items()]) >= 0.9


def test_nearest_odd_rows(spark):
    rows = [(0, [1.0, 0.0]), (50, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, [0.0, 0.0]), (4, None), (5, [float("nan"), 1.0]), (6, [0.0, 1.0])]
    rows += [(7, [-1.0, 0.0]), (7, [-1.0, 0.0]), (8, [1e200, 1e200]), (None, [1.0, 0.0]), (9, [1.0]), (10, [float("inf"), 1.0]), (11, [None, 1.0]), (100, []), (-50, [1e-200, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "'x' as tree", "'y' as v", "1 as ids")
    got = neighbours.nearest(df, 50).collect()
    assert in_order((r.query_id, r["rank"], r.vec_id) for r in got) == in_order(
        (q, n, i) for q, near in {0: [-50, 1, 2, 50, 8], 50: [-50, 0, 1, 2, 8], -50: [0, 1, 2, 50, 8]}.items() for n, i in enumerate(near, 1)
    )
    assert {round(r.score, 9) for r in got} == {1.0, round(2**-0.5, 9)}
    assert neighbours.nearest(df.limit(0), 50).collect() == []


def test_equal_vectors_in_cuts(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "CHUNK", 16)
    rng = np.random.default_rng(1)
    rows = [(i, [1.0, 2.0, 3.0]) for i in range(200)] + [(200 + i, rng.normal(size=3).tolist()) for i in range(200)]
    got = neighbours.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), 50).collect()
    first = {q: [r.vec_id for r in sorted(got, key=lambda r: r["rank"]) if r.query_id == q] for q in (0, 50, 100, 150)}
    assert first == {0: [1, 2, 3, 4, 5], 50: [0, 1, 2, 3, 4], 100: [0, 1, 2, 3, 4], 150: [0, 1, 2, 3, 4]}


def test_shards(spark):
    table = pd.read_parquet(f"{SF_DIR.replace('sf0.001', 'sf0.01')}/documents.parquet")
    got = QUERIES["op10_kd_shards"](spark, SF_DIR.replace("sf0.001", "sf0.01")).toPandas()
    size = {i: len(t.encode()) + 1 for i, t in zip(table.doc_id, table.text, strict=True)}
    assert dict(zip(got.doc_id, got["size"], strict=True)) == size
    assert dict(zip(got.doc_id, got.text_crc32, strict=True)) == {i: zlib.crc32(t.encode()) for i, t in zip(table.doc_id, table.text, strict=True)}
    sums = got.groupby("shard")["size"].sum()
    assert list(sums.index) == list(range(8)) and sums.max() - sums.min() < 0.05 * sums.mean()
    assert all(sorted(g.slot) == list(range(len(g))) for _, g in got.groupby("shard"))


@pytest.mark.parametrize("shards", [1, 3, 8])
def test_shards_odd_rows(docs, odd_rows, shards):  # noqa: F811
    rows = [*odd_rows, *[(1000 + i, "same text") for i in range(300)]]
    got = sharding.shard(docs(rows), shards=shards).collect()
    assert Counter((r.doc_id, r["size"]) for r in got) == Counter((i, len((t or "").encode()) + 1) for i, t in rows)
    for s in range(shards):
        own = [r for r in got if r.shard == s]
        assert sorted(r.slot for r in own) == list(range(len(own)))
    assert sharding.shard(docs([]), shards=shards).collect() == []


def test_shards_by_target(docs, real):  # noqa: F811
    got = sharding.shard(docs(real), target_bytes=100_000).collect()
    total = sum(r["size"] for r in got)
    assert len({r.shard for r in got}) == -(-total // 100_000)


def test_pipeline_stages(spark, docs, odd_rows):  # noqa: F811
    import corpus_pipeline

    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "repeated_passages", "decontamination", "packing"]
    df = docs(odd_rows)
    near = corpus_pipeline.keep_one_of_near(spark, df, SF_DIR)
    assert near.columns == df.columns
    from llm_brute import cut_texts, jaccard_groups

    want = {(i, t) for (i, t), (_, _, c) in zip(odd_rows, jaccard_groups(odd_rows), strict=True) if c is None or i == c}
    assert {(r.doc_id, r.text) for r in near.collect()} == want and near.count() == len(want)
    cut = corpus_pipeline.cut_repeated(spark, near, SF_DIR)
    assert cut.columns == df.columns
    assert in_order((r.doc_id, r.text) for r in cut.collect()) == in_order(cut_texts(list(want), 50))
    assert all(r.n_chars == len(r.text) for r in cut.collect() if r.text is not None)


def test_pipeline_near_stage(spark, docs, odd_rows):  # noqa: F811
    import corpus_pipeline

    vocabulary = [f"v{i}" for i in range(5000)]
    text = np.random.default_rng(6).choice(vocabulary, 100, replace=False).tolist()
    changed = [*text[:25], "other", *text[26:50]]
    rows = [*odd_rows, (500, " ".join(text)), (501, " ".join([*text, *vocabulary[:15]])), (502, " ".join(text[:50])), (503, " ".join(changed))]
    sets = [(lambda w: {tuple(w[j : j + 5]) for j in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())((t or "").lower().split()) for _, t in rows]
    name = [10**9 if i is None else i for i, _ in rows]
    for _ in rows:
        name = [min([n] + [m for m, b in zip(name, sets, strict=True) if a and b and 100 * len(a & b) >= 80 * len(a | b)]) for n, a in zip(name, sets, strict=True)]
    want = {(i, t) for (i, t), n, s in zip(rows, name, sets, strict=True) if not s or n == 10**9 or i == n}
    assert {500, 502} <= {i for i, _ in want} and not {501, 503} & {i for i, _ in want}
    kept = dict(corpus_pipeline.STAGES)["near_duplicates"](spark, docs(rows), SF_DIR)
    assert {(r.doc_id, r.text) for r in kept.collect()} == want


def test_pipeline_run(spark):
    import corpus_pipeline

    out = corpus_pipeline.run(spark, SF_DIR)
    assert out.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"] and out.count() > 0


def test_sharding_null_ids_at_a_cut(spark):
    """Cuts that fall before the least id, and before a checksum that only null ids have."""
    for rows in ([(1, "a" * 39)] + [(None, "b" * 40)] * 3, [(None, "b" * 40)] * 5 + [(-(2**63), "b" * 40)], [(None, None)] * 4 + [(5, "x" * 100)]):
        df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'en' AS lang", "'s' AS source")
        got = sharding.shard(df, shards=8).collect()
        assert Counter(r.doc_id for r in got) == Counter(i for i, _ in rows)
        for s in {r.shard for r in got}:
            assert sorted(r.slot for r in got if r.shard == s) == list(range(sum(r.shard == s for r in got)))


def naive_shards(rows, leaves):
    """Rows (size, lang, source, checksum, id) split in memory by weighted medians along the widest dimension."""
    dims = (0, 1, 2)
    root = [max(1, max(r[d] for r in rows) - min(r[d] for r in rows)) for d in dims]

    def divide(node, k):
        if k == 1 or not node:
            return [node] + [[]] * (k - 1)
        d = max(dims, key=lambda c: ((max(r[c] for r in node) - min(r[c] for r in node)) / root[c], -c))
        weight = sum(r[0] for r in node)
        wanted, slack = weight * (k // 2) / k, sharding.KEEP_TOGETHER * weight

        def key(r):
            return (r[d], r[3], r[4])

        ordered = sorted(node, key=key)
        # The cut lies where the sum is nearest to the wanted one, among the places allowed.
        best = None
        for depth in (1, 2, 3):
            places, total = [(0, 0)], 0
            for i, r in enumerate(ordered, 1):
                total += r[0]
                if i == len(ordered) or key(ordered[i])[:depth] != key(r)[:depth]:
                    places.append((i, total))
            low = max((p for p in places if p[1] < wanted), default=(0, 0), key=lambda p: p[1])
            high = min((p for p in places if p[1] >= wanted), key=lambda p: p[1])
            best = high if high[1] - wanted <= wanted - low[1] else low
            if min(high[1] - wanted, wanted - low[1]) <= slack:
                break
        return divide(ordered[: best[0]], k // 2) + divide(ordered[best[0] :], k - k // 2)

    return divide(rows, leaves)


@pytest.mark.parametrize("leaves", [2, 8, 5])
def test_shards_equal_naive_tree(spark, real, leaves):  # noqa: F811
    table = pd.read_parquet(f"{SF_DIR}/documents.parquet")
    rows = [(len((t or "").encode()) + 1, zlib.crc32(a.encode()), zlib.crc32(s.encode()), zlib.crc32((t or "").encode()), i) for i, t, a, s in zip(table.doc_id, table.text, table.lang, table.source, strict=True)]
    got = sharding.shard(spark.read.parquet(f"{SF_DIR}/documents.parquet"), shards=leaves).collect()
    mine = {i: {r.doc_id for r in got if r.shard == i} for i in range(leaves)}
    assert mine == {i: {r[4] for r in part} for i, part in enumerate(naive_shards(rows, leaves))}

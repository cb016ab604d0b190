"""Substring, suffix-array and Jaccard dedup against brute force, and their parts against naive versions."""

import hashlib
import os
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from llm_brute import jaccard_groups, repeated_bytes, repeated_words
from llm_fixtures import docs, in_order, odd_rows, real  # noqa: F401

from kilnwatt.llm import anchors, graph, jaccard, substrings, suffixes
from kilnwatt.session import drop_materialised, shared_dir


@pytest.mark.parametrize("part", [anchors.PART, 300])
def test_substring_dedup_odd_rows(docs, odd_rows, monkeypatch, part):
    monkeypatch.setattr(anchors, "PART", part)
    assert in_order(substrings.deduplicated(docs(odd_rows)).collect()) == in_order(repeated_words(odd_rows, 35))


def test_substring_dedup_real(docs, real):
    assert in_order(substrings.deduplicated(docs(real, extra=False)).collect()) == in_order(repeated_words(real, 35))


@pytest.mark.parametrize("part", [anchors.PART, 300])
def test_suffix_dedup_odd_rows(docs, odd_rows, monkeypatch, part):
    monkeypatch.setattr(anchors, "PART", part)
    assert in_order(suffixes.deduplicated(docs(odd_rows)).collect()) == in_order(repeated_bytes(odd_rows, 50))


def test_suffix_dedup_real_in_small_shards(docs, real, monkeypatch):
    monkeypatch.setattr(suffixes, "SHARD_BYTES", 20_000)
    monkeypatch.setattr(suffixes, "QUEUE_BYTES", 1_000)
    assert in_order(suffixes.deduplicated(docs(real, extra=False)).collect()) == in_order(repeated_bytes(real, 50))


@pytest.mark.parametrize("region", [jaccard.REGION, 12])
def test_jaccard_odd_rows(docs, odd_rows, monkeypatch, region):
    monkeypatch.setattr(jaccard, "REGION", region)
    assert in_order(jaccard.near_duplicates(docs(odd_rows)).drop("row_key").collect()) == in_order(jaccard_groups(odd_rows))


def test_jaccard_real(docs, real):
    assert in_order(jaccard.near_duplicates(docs(real, extra=False)).drop("row_key").collect()) == in_order(jaccard_groups(real))


@pytest.mark.parametrize("operator", [substrings.deduplicated, suffixes.deduplicated, jaccard.near_duplicates])
def test_empty_table(docs, operator):
    assert operator(docs([])).collect() == []


def test_cleaned_texts_stay_valid(docs, odd_rows):
    rows = [*odd_rows, (200, "é" * 60), (201, "x" + "é" * 60), (202, "é" * 30 + "unlike anything that came before")]
    df = docs(rows)
    out = suffixes.cleaned(df)
    assert out.columns == df.columns
    kept = {r.doc_id: r.text for r in out.collect()}
    assert kept[200] == "é" * 60 and kept[201] == "x" and 16 not in kept and kept[1] == ""


def naive_suffixes(symbols, cap):
    breaks = [i for i, s in enumerate(symbols) if s == 0]

    def key(i):
        end = next(b for b in breaks if b >= i)
        return [s + len(symbols) for s in symbols[i:end]] + [breaks.index(end)]

    order = sorted(range(len(symbols)), key=key)
    common = [0]
    for a, b in zip(map(key, order), map(key, order[1:]), strict=False):
        same = 0
        while same < min(len(a), len(b)) - 1 and a[same] == b[same]:
            same += 1
        common.append(min(same, cap))
    return order, common


@pytest.mark.parametrize("least", [0, suffixes.LEAST_REDUCED])
def test_induced_sorting(monkeypatch, least):
    monkeypatch.setattr(suffixes, "LEAST_REDUCED", least)
    rng = random.Random(5 + least)
    for _ in range(300):
        kinds = rng.choice([1, 2, 3, 5, 255])
        strings = [[rng.randint(1, kinds) for _ in range(rng.randint(1, rng.choice([2, 8, 30])))] for _ in range(rng.randint(1, 8))]
        strings += [s[1:] for s in strings if len(s) > 2]
        symbols = np.array(sum([[*s, 0] for s in strings], []))
        cap = rng.choice([3, 50])
        order, common = suffixes.induced(symbols, suffixes.Text(symbols, cap), cap, budget=rng.choice([64, 10**9]))
        assert (order.tolist(), common.tolist()) == naive_suffixes(symbols.tolist(), cap)


def test_equal_windows_have_equal_anchors():
    rng = random.Random(3)
    scheme, tokens = anchors.Scheme("words", 10, 4), anchors.Tokens("words")
    words = [f"w{rng.randrange(9)}".encode() for _ in range(3000)]
    seen = {}
    total = 0
    for part, first, count, anchor in anchors.segments_of([b" ".join(words), b" ".join(words[700:1500])], scheme, tokens):
        for f, n, a in zip(first.tolist(), count.tolist(), anchor.tolist(), strict=True):
            total += n
            for i in range(f, f + n):
                assert seen.setdefault(part.hashes[i : i + 10].tobytes(), a) == a
    assert total == 2991 + 791


def test_shared_counts():
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 60, 40)).astype(np.uint64) for _ in range(30)]
    want = [[len(np.intersect1d(a, b)) for b in sets] for a in sets]
    got = jaccard.shared_counts(sets)
    assert all(got[i][j] == want[i][j] for i in range(30) for j in range(30) if i != j)
    assert jaccard.shared_counts(sets[:4], sets).tolist() == want[:4]


def test_linked_pairs_share_a_signature():
    rng = random.Random(8)
    sizes = jaccard.Sizes(2000)
    for _ in range(200):
        n = rng.randint(10, 600)
        a = {rng.getrandbits(60) for _ in range(n)}
        most = 10 * n // 100
        b = set(list(a)[rng.randint(0, most) :])
        b |= {rng.getrandbits(60) for _ in range(rng.randint(0, most))}
        if 100 * len(a & b) < 90 * len(a | b):
            continue
        flat = np.concatenate([np.sort(np.array(list(s), dtype=np.uint64)) for s in (a, b)])
        which, sig = jaccard.signatures(np.array([0, len(a)]), flat, sizes)
        assert a == b or set(sig[which == 0]) & set(sig[which == 1])


@pytest.mark.parametrize("percent", [80, 90])
@pytest.mark.parametrize("most", [12, 60, 600])
def test_linked_pairs_share_a_signature_of_shingles(percent, most):
    rng = random.Random(percent + most)
    sizes, seen = jaccard.Sizes(most * 2, percent), 0
    assert all(sizes.low[2:] * percent >= sizes.low[1:-1] * 100)  # a partner is at most one class away
    for _ in range(3000):
        n = rng.randint(1, most)
        a = {rng.getrandbits(60) for _ in range(n)}
        gone = rng.randint(0, (100 - percent) * n // 100)
        b = set(list(a)[gone:]) | {rng.getrandbits(60) for _ in range(rng.randint(0, n * (100 - percent) // percent))}
        if a == b or 100 * len(a & b) < percent * len(a | b):
            continue
        flat = np.concatenate([np.sort(np.array(list(s), dtype=np.uint64)) for s in (a, b)])
        which, sig = jaccard.signatures(np.array([0, len(a)]), flat, sizes)
        assert set(sig[which == 0]) & set(sig[which == 1])
        seen += 1
    assert seen > 100


def test_unlinked_sets_rarely_share_a_signature():
    rng = np.random.default_rng(5)
    flat = np.concatenate([np.sort(rng.integers(0, 2**62, 100, dtype=np.uint64)) for _ in range(2000)])
    which, sig = jaccard.signatures(np.arange(0, len(flat), 100), flat, jaccard.Sizes(200, 80))
    _, times = np.unique(sig, return_counts=True)
    assert (times > 1).sum() <= 20  # empty shares aren't content


def test_components(spark):
    rng = random.Random(4)
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, 200), (200, 300), (7, 7), (400, 401), (401, 400)] + [(1000, 1000 + rng.randrange(1, 50)) for _ in range(80)]
    parent = {x: x for e in edges for x in e}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        parent[max(find(a), find(b))] = min(find(a), find(b))
    got = {r.node: r.root for r in graph.components(spark.createDataFrame(edges, "a long, b long"), "t").collect()}
    assert got == {x: find(x) for x in parent if x != 7 or find(7) != 7}


def test_hashes_are_those_of_the_words():
    text = "Ein  Wort\tund é\n".encode() * 3
    tokens = anchors.Tokens("words")
    hashes, start, end = tokens.read(text)
    words = [text[s:e] for s, e in zip(start, end, strict=True)]
    assert words == text.split() and len(Counter(hashes.tolist())) == len(set(words))
    assert hashlib.sha256(hashes[:4].tobytes()).digest() == hashlib.sha256(hashes[4:8].tobytes()).digest()


def test_connected_across_tiles():
    """Links found in tasks of one tile and of two tiles connect the same sets as all pairs do."""
    rng = np.random.default_rng(1)
    for _ in range(30):
        base = [np.unique(rng.integers(0, 2**63, 40, dtype=np.uint64)) for _ in range(3)]

        def varied(b):
            b, k = b.copy(), rng.integers(0, 7)  # noqa: B023
            b[rng.integers(0, len(b), k)] = rng.integers(0, 2**63, k, dtype=np.uint64)
            return np.unique(b)

        sets = [varied(base[rng.integers(3)]) for _ in range(40)]
        cuts = [0, *sorted(rng.choice(np.arange(1, 40), 4, replace=False).tolist()), 40]
        own, parts = [sets[a:b] for a, b in zip(cuts, cuts[1:])], [0, 0, 0, 1, 1]
        label = np.arange(40)
        edges = []
        for task in ((0,), (1,), (0, 1)):
            of = [i for i in range(5) if parts[i] in task]
            names = np.concatenate([np.arange(cuts[i], cuts[i + 1]) for i in of])
            found = jaccard.connected([(parts[i], own[i]) for i in of], 80)
            edges += [(names[k], names[found[k]]) for k in range(len(names))]
        for _ in range(40):
            for a, b in edges:
                label[a] = label[b] = min(label[a], label[b])
        assert (label == jaccard.linked(sets, 80)).all()


def test_large_families_are_cut_by_size(spark, monkeypatch):
    """Links within a region that is cut into blocks connect the same sets as all pairs of the region do."""
    monkeypatch.setattr(jaccard, "REGION", 20)
    monkeypatch.setattr(jaccard, "TILE", 2)
    rng = np.random.default_rng(3)
    sets = []
    for n in (4, 10, 30, 32, 60, 200):
        base = np.unique(rng.integers(0, 2**63, n, dtype=np.uint64))
        for _ in range(30):
            own, k = base.copy(), int(rng.integers(0, max(2, n // 6)))
            own[rng.integers(0, len(own), k)] = rng.integers(0, 2**63, k, dtype=np.uint64)
            sets.append(np.unique(own[int(rng.integers(0, max(1, n // 8))) :]))
    sets += [np.arange(k, dtype=np.uint64) for k in range(1, 40)]  # a chain through all sizes
    rows = [(i % 2, 2 * i + (i % 2), sets[i].tobytes()) for i in range(len(sets))]
    links = jaccard._links(spark.createDataFrame(rows, "region long, set_key long, shingles binary"), 80).collect()
    for half in (0, 1):
        own = [i for i in range(len(sets)) if i % 2 == half]
        want = jaccard.linked([sets[i] for i in own], 80)
        parent = {2 * i + half: 2 * i + half for i in own}

        def find(x):
            while parent[x] != x:  # noqa: B023
                x = parent[x]  # noqa: B023
            return x

        for a, b in links:
            if a in parent:
                parent[max(find(a), find(b))] = min(find(a), find(b))
        assert [find(2 * i + half) for i in own] == [2 * own[k] + half for k in want]
        assert len(set(want)) > 3


def test_pairs_of_empty_and_disjoint_sets_share_nothing():
    none, some = np.zeros(0, dtype=np.uint64), np.arange(9, dtype=np.uint64)
    assert jaccard.shared_counts([none, some], [some + np.uint64(5), none]).tolist() == [[0, 0], [4, 0]]


def test_only_segments_alike_beside_their_anchor_are_sorted():
    rng = random.Random(11)
    some = lambda n: bytes(rng.choice(b"abcdefgh") for _ in range(n))
    gram, tokens = some(16), anchors.Tokens("bytes")
    anchor = tokens.rolling.grams(tokens.read(gram)[0], 16).view(np.int64)[0]
    before, behind = some(17), some(17)
    bodies = [some(17) + gram + some(17), some(17) + gram + some(17), some(20) + before + gram + some(17), some(3) + before + gram + some(14), some(34) + gram + behind + some(2)]
    bodies += [gram + behind + some(17), some(18) + before[1:] + gram + some(16) + b"x"]
    assert suffixes.alike(bodies, np.full(len(bodies), anchor)).tolist() == [False, False, True, True, True, True, False]


def test_shared_windows_are_never_left_out_of_the_sort():
    rng = random.Random(12)
    for letters in ("ab", "abcdefgh "):
        pool = ["".join(rng.choice(letters) for _ in range(n)) for n in (20, 45, 60, 120, 200)]
        texts = ["".join(rng.choice(pool) for _ in range(8)).encode() for _ in range(12)] + [b"ab" * 200, b"a" * 300, b"ab" * 90 + b"c" + b"ab" * 80]
        found = set()
        for part, first, count, anchor in anchors.segments_of(texts, anchors.Scheme("bytes", 50, 16), anchors.Tokens("bytes")):
            for f, n, a in zip(first.tolist(), count.tolist(), anchor.view(np.int64).tolist(), strict=True):
                at = int(part.start[f])
                found.add((a, texts[part.owner[f]][at : at + n + 49]))
        keys = sorted(found)
        times = Counter((a, w) for a, body in keys for w in {body[i : i + 50] for i in range(len(body) - 49)})
        kept = suffixes.alike([b for _, b in keys], np.array([a for a, _ in keys]))
        shared = [any(times[a, body[i : i + 50]] > 1 for i in range(len(body) - 49)) for a, body in keys]
        assert any(shared) and not (np.array(shared) & ~kept).any()


def test_finer_pieces_leave_fewer_segments_to_sort_and_no_shared_window():
    rng = random.Random(13)
    some = lambda n: bytes(rng.choice(b"abcdefgh") for _ in range(n))
    gram, tokens = some(16), anchors.Tokens("bytes")
    anchor = tokens.rolling.grams(tokens.read(gram)[0], 16).view(np.int64)[0]
    before, behind = some(34), some(34)
    for near in range(35):  # a window that has `near` bytes before the gram
        whole = [before + gram + behind, some(34 - near) + before[34 - near :] + gram + behind[: 34 - near] + some(near)]
        assert suffixes.alike(whole, np.full(2, anchor), pieces=suffixes.PIECES).all()
    half = [before + gram + b"x" + some(33), before + gram + b"y" + some(33)]
    apart = [b"x" + before[16:] + gram + behind, b"y" + before[16:] + gram + b"z" + behind[1:]]
    assert suffixes.alike(half, np.full(2, anchor), pieces=suffixes.PIECES).all()  # a window that ends with the gram
    assert suffixes.alike(apart, np.full(2, anchor)).all() and not suffixes.alike(apart, np.full(2, anchor), pieces=suffixes.PIECES).any()


@pytest.mark.parametrize("pieces", [3, 8, 34])
def test_pieces_keep_all_shared_windows(pieces):
    rng = random.Random(14)
    pool = ["".join(rng.choice("ab ") for _ in range(n)) for n in (20, 45, 60, 120, 200)]
    texts = ["".join(rng.choice(pool) for _ in range(8)).encode() for _ in range(12)] + [b"ab" * 200, b"a" * 300]
    found = set()
    for part, first, count, anchor in anchors.segments_of(texts, anchors.Scheme("bytes", 50, 16), anchors.Tokens("bytes")):
        for f, n, a in zip(first.tolist(), count.tolist(), anchor.view(np.int64).tolist(), strict=True):
            at = int(part.start[f])
            found.add((a, texts[part.owner[f]][at : at + n + 49]))
    keys = sorted(found)
    times = Counter((a, w) for a, body in keys for w in {body[i : i + 50] for i in range(len(body) - 49)})
    kept = suffixes.alike([b for _, b in keys], np.array([a for a, _ in keys]), pieces=pieces)
    shared = [any(times[a, body[i : i + 50]] > 1 for i in range(len(body) - 49)) for a, body in keys]
    assert any(shared) and not (np.array(shared) & ~kept).any()


def test_marks_of_a_batch_are_read_at_once():
    rng = random.Random(15)
    texts = [bytes(rng.choice(b"ab\xc3\xa9") for _ in range(n)) for n in (0, 49, 50, 300, 51, 400, 200, 0, 90)] + [None]
    ids = [5, 5, 9, 2**63 - 1, 2**63 - 2, 1, 7, 3, 8, 4]
    first = [None, 2, 3, 2**63 - 1, 2**63 - 1, None, 7, 2, 8, 1]
    runs = [None, [], [(0, 1)], [], None, [], [(0, 1), (50, 1), (101, 5), (30, 1 << 34)], None, [(40, 1), (0, (1 << 35) - 1)], []]
    runs[3] = [(n, rng.randrange(1, 1 << 34)) for n in rng.sample(range(0, 215), 5)]
    runs[3] = [(n, m) for n, m in runs[3] if n + m.bit_length() + 49 <= 300]
    marks = [r and [{"number": n, "mask": m} for n, m in r] for r in runs]
    kind = pa.list_(pa.struct([("number", pa.int64()), ("mask", pa.int64())]))
    whole = pa.record_batch([pa.array(texts, pa.binary()), pa.array(ids), pa.array(first, pa.int64()), pa.array(marks, kind)], names=["text", "_id", "_first_id", "_runs"])
    for low in (0, 3):
        data, spans = suffixes.removal(whole.slice(low))
        for t, own, least, m, d, found in zip(texts[low:], ids[low:], first[low:], marks[low:], data, spans, strict=True):
            n = len(t or b"")
            gone = np.full(n, n >= 50) if least is not None and own > least else anchors.covered(anchors.marked_windows(m), 50, n)
            edges = np.flatnonzero(np.diff(gone.astype(int), prepend=0, append=0))
            assert d == (t or b"") and found == list(zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True))
            assert suffixes.without(d, found) == bytes(b for b, g in zip(d, gone.tolist(), strict=True) if not g)


def test_parts_of_bytes_are_small_and_know_their_places():
    rng = random.Random(16)
    texts = [bytes(rng.choice(b"ab\n") for _ in range(n)) for n in (0, 60, 20, 70_000, 50, 65_000, 600, 140_000)]
    seen = Counter()
    for part in anchors.parts(texts, anchors.Tokens("bytes"), 50):
        assert len(part.hashes) <= anchors.BYTES_PART + 50
        for f in np.flatnonzero(part.owner >= 0).tolist()[::97]:
            assert part.start[f] == part.number[f] == part.end[f] - 1
            assert anchors.Tokens("bytes").read(texts[part.owner[f]][part.start[f] : part.end[f]])[0][0] == part.hashes[f]
        n = len(part.owner) - 49
        whole = part.owner[:n][(part.owner[:n] == part.owner[49:]) & (part.owner[:n] >= 0)]
        seen.update(whole.tolist())
    assert seen == {r: len(t) - 49 for r, t in enumerate(texts) if len(t) >= 50}


def scratch(spark):
    """Names of the written tables that are still there."""
    return sorted(re.sub("-[0-9a-f]{32}$", "", name) for name in os.listdir(shared_dir(spark).removeprefix("file://")))


def test_suffix_dedup_leaves_only_what_its_result_reads(spark, docs, odd_rows):
    drop_materialised(spark)
    suffixes.cleaned(docs(odd_rows))
    assert scratch(spark) == ["anchor-results"]


def test_sets_with_shingles_of_their_own_go_no_further(spark, docs):
    """A shared passage alone doesn't let a set be looked for; near copies, whole copies and small sets are kept."""
    rng = random.Random(13)
    some = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]
    passage, base = some(40), some(200)
    near = [base, base[:100] + some(1) + base[101:], base + some(10), [*base[10:], *some(2)]]
    texts = [*near, base, *(some(150) + passage + some(100) for _ in range(4)), some(300), ["one"], ["two", "words"]]
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    df = docs(rows)
    for shingle, percent in ((3, 90), (5, 80)):
        likely = {r.text for r in jaccard._likely(df, jaccard._meta(df, shingle), shingle, percent).collect()}
        assert {" ".join(t) for t in near} <= likely and not {" ".join(t) for t in texts[5:10]} & likely
        groups = {r.doc_id: r.component_id for r in jaccard.near_duplicates(df, shingle, percent).collect()}
        assert groups == {i: 0 if i <= 4 else i for i in range(len(rows))}


def test_near_duplicates_leave_only_what_their_result_reads(spark, docs, odd_rows, monkeypatch):
    monkeypatch.setattr(jaccard, "REGION", 12)
    drop_materialised(spark)
    jaccard.near_duplicates(docs(odd_rows))
    left = set(scratch(spark))
    assert {"jaccard-meta", "jaccard-sets"} <= left
    assert not left & {"jaccard-alone", "jaccard-likely", "jaccard-spread", "jaccard-regions", "jaccard-members", "jaccard-rows", "jaccard-blocks", "jaccard-tasks"}
    assert not [name for name in left if name.endswith(("-edges", "-least", "-large", "-lowest"))]

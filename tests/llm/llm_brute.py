"""Plain versions of the operators, for small tables."""

import hashlib
from collections import Counter

NULL_ID = 2**63 - 1


def repeated_words(rows, width):
    texts = [(t or "").encode().split() for _, t in rows]
    count = Counter(tuple(w[j : j + width]) for w in texts for j in range(len(w) - width + 1))
    out = []
    for (doc_id, _), w in zip(rows, texts, strict=True):
        gone = [False] * len(w)
        for j in range(len(w) - width + 1):
            if count[tuple(w[j : j + width])] > 1:
                gone[j : j + width] = [True] * width
        kept = b" ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out.append((doc_id, len(w), sum(gone), hashlib.sha256(kept).hexdigest()))
    return out


def repeated_bytes(rows, width):
    ids = [NULL_ID if i is None else i for i, _ in rows]
    texts = [(t or "").encode() for _, t in rows]
    first = {}
    for i, b in zip(ids, texts, strict=True):
        for j in range(len(b) - width + 1):
            first[b[j : j + width]] = min(i, first.get(b[j : j + width], NULL_ID))
    out = []
    for (doc_id, _), i, b in zip(rows, ids, texts, strict=True):
        gone = bytearray(len(b))
        for j in range(len(b) - width + 1):
            if first[b[j : j + width]] < i:
                gone[j : j + width] = b"\1" * width
        spans = sum(1 for x in range(len(b)) if gone[x] and (x == 0 or not gone[x - 1]))
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        out.append((doc_id, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def cut_texts(rows, width):
    """Rows (id, text) after what an earlier row has is cut, by whole characters; a row of which only blanks are left goes."""
    ids = [NULL_ID if i is None else i for i, _ in rows]
    texts = [(t or "").encode() for _, t in rows]
    first = {}
    for i, b in zip(ids, texts, strict=True):
        for j in range(len(b) - width + 1):
            first[b[j : j + width]] = min(i, first.get(b[j : j + width], NULL_ID))
    out = []
    for (doc_id, t), i, b in zip(rows, ids, texts, strict=True):
        gone = bytearray(len(b))
        for j in range(len(b) - width + 1):
            if first[b[j : j + width]] < i:
                gone[j : j + width] = b"\1" * width
        kept, at = [], 0
        for c in t or "":
            n = len(c.encode())
            if not any(gone[at : at + n]):
                kept.append(c)
            at += n
        if not any(gone):
            out.append((doc_id, t))
        elif "".join(kept).strip():
            out.append((doc_id, "".join(kept)))
    return out


def jaccard_groups(rows):
    sets = []
    for _, t in rows:
        w = (t or "").encode().lower().split()
        sets.append({tuple(w[j : j + 3]) for j in range(len(w) - 2)} if len(w) >= 3 else ({tuple(w)} if w else set()))
    parent = list(range(len(rows)))

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    holders = {}
    for a, s in enumerate(sets):
        shared = Counter(b for x in s for b in holders.get(x, ()))
        for b, k in shared.items():
            if 100 * k >= 90 * (len(s) + len(sets[b]) - k):
                parent[find(a)] = find(b)
        for x in s:
            holders.setdefault(x, []).append(a)
    least = {}
    for a, (doc_id, _) in enumerate(rows):
        least[find(a)] = min(least.get(find(a), NULL_ID), NULL_ID if doc_id is None else doc_id)
    out = []
    for a, (doc_id, _) in enumerate(rows):
        name = least[find(a)]
        out.append((doc_id, len(sets[a]), (None if name == NULL_ID else name) if sets[a] else doc_id))
    return out

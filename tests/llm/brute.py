"""Plain versions of the operators over lists of rows."""

import hashlib
import re

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall((text or "").encode())


def sha(text):
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


def removed(rows, size=20):
    """rows of (doc_id, text): {index: (n_words, n_removed, kept_sha256)}."""
    first = {}
    key = lambda d, p: (d is None, d or 0, p)
    for doc, text in rows:
        w = words(text)
        for p in range(len(w) - size + 1):
            k = tuple(w[p : p + size])
            first[k] = min(first.get(k, (True, 1 << 62, 1 << 62)), key(doc, p))
    out = {}
    for i, (doc, text) in enumerate(rows):
        w = words(text)
        gone = set()
        for p in range(len(w) - size + 1):
            if first[tuple(w[p : p + size])] < key(doc, p):
                gone |= set(range(p, p + size))
        kept = [x for p, x in enumerate(w) if p not in gone]
        out[i] = (len(w), len(gone), sha(b" ".join(kept)))
    return out


def shingles(text, n=5):
    w = words(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()


def linked(sets, near):
    """{index: smallest index reachable} of links near(a, b)."""
    parent = list(range(len(sets)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            if near(sets[a], sets[b]):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return [root(x) for x in range(len(sets))]

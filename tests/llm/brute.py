"""Plain versions of the operators for small inputs."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LAST = (1 << 63) - 1


def key(doc_id):
    return LAST if doc_id is None else doc_id


def sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def covered(rows, tokens, length):
    """(id, tokens, marks): tokens covered by a window that also starts in a document with a smaller id."""
    docs = [(key(i), tokens(t)) for i, t in rows]
    least = {}
    for i, w in docs:
        for p in range(len(w) - length + 1):
            k = tuple(w[p:p + length])
            least[k] = min(least.get(k, LAST + 1), i)
    out = []
    for i, w in docs:
        marks = bytearray(len(w))
        for p in range(len(w) - length + 1):
            if least[tuple(w[p:p + length])] < i:
                marks[p:p + length] = b"\1" * length
        out.append((i, w, marks))
    return out


def repeated_words(rows, length=13):
    return sorted((i, len(w), sum(m), sha(" ".join(x for x, y in zip(w, m) if not y).encode()))
                  for i, w, m in covered(rows, lambda t: WORD.findall(t or ""), length))


def repeated_bytes(rows, length=50):
    return sorted((i, len(w), sum(m), len(re.findall(b"\1+", bytes(m))), sha(bytes(x for x, y in zip(w, m) if not y)))
                  for i, w, m in covered(rows, lambda t: (t or "").encode(), length))


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def shingles(text, size=5):
    w = WORD.findall(lower(text))
    return {tuple(w[i:i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else ({tuple(w)} if w else set())


def groups(rows, percent=80):
    """(id or last, set size, smallest id of the component or -1) of every row."""
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    lists = defaultdict(list)
    for k, s in enumerate(sets):
        for e in s:
            lists[e].append(k)
    for k, s in enumerate(sets):
        for j, both in Counter(j for e in s for j in lists[e] if j < k).items():
            if 100 * both >= percent * (len(s) + len(sets[j]) - both):
                parent[root(k)] = root(j)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[root(k)] = min(least.get(root(k), i), i)
    out = []
    for k, (i, _) in enumerate(rows):
        c = least.get(root(k)) if sets[k] else i
        out.append((key(i), len(sets[k]), -1 if c is None else c))
    return sorted(out)


def base_counts(text):
    text = text or ""
    w, seen, lines = WORD.findall(text), set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            lines += line in seen
            seen.add(line)
    windows = Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
    repeated = set()
    for i in range(len(w) - 4):
        if windows[tuple(w[i:i + 5])] > 1:
            repeated.update(range(i, i + 5))
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), lines, len(repeated)

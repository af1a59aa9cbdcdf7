"""Plain versions of the operators, from their contracts."""

import hashlib
import re
from collections import Counter, defaultdict

ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SPACE = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def near_duplicates(rows):
    sets, owners, parent = {}, defaultdict(list), {}
    for i, t in rows:
        w = SPACE.findall((t or "").translate(LOWER))
        sets[i] = {tuple(w[k:k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
        parent[i] = i
        for s in sets[i]:
            owners[s].append(i)

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, own in sets.items():
        met = Counter(j for s in own for j in owners[s] if j < i)
        for j, n in met.items():
            if 100 * n >= 75 * (len(own) + len(sets[j]) - n):
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    return {i: (len(s), root(i)) for i, s in sets.items()}


def repeats(rows, length=200):
    raw = {i: (t or "").encode() for i, t in rows}
    seen = Counter(b[s:s + length] for b in raw.values() for s in range(len(b) - length + 1))
    out = {}
    for i, b in raw.items():
        gone = [False] * len(b)
        for s in range(len(b) - length + 1):
            if seen[b[s:s + length]] > 1:
                gone[s:s + length] = [True] * length
        spans = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out[i] = (len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


def contamination(rows, items, window=13):
    phrases = defaultdict(set)
    for item, t in items:
        w = ALNUM.findall((t or "").translate(LOWER))
        n = min(window, len(w))
        for k in range(len(w) - n + 1 if n else 0):
            phrases[tuple(w[k:k + n])].add(str(item))
    lengths, out = {len(p) for p in phrases}, {}
    for i, t in rows:
        w = ALNUM.findall((t or "").translate(LOWER))
        hit, found = set(), set()
        for n in lengths:
            for k in range(len(w) - n + 1):
                if p := phrases.get(tuple(w[k:k + n])):
                    hit.update(range(k, k + n))
                    found |= p
        out[i] = (len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(),
                  bool(hit) and 20 * len(hit) >= len(w))
    return out


def base_licenses(text):
    w = ALNUM.findall((text or "").translate(LOWER))
    starts, labels = [], set()
    for phrase, label in (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved")):
        p = phrase.split()
        at = [k for k in range(len(w)) if w[k:k + len(p)] == p]
        starts += at
        labels |= {label} if at else set()
    return len(w), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(labels))


def quality(text):
    t = text or ""
    w = SPACE.findall(t)
    lines = [x for x in t.split("\n") if SPACE.search(x)]
    windows = Counter(tuple(w[k:k + 8]) for k in range(len(w) - 7))
    covered = {j for k in range(len(w) - 7) if windows[tuple(w[k:k + 8])] > 1 for j in range(k, k + 8)}
    return (len(w), sum(map(len, w)), sum(t.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered),
            len(w) < 20 or 100 * len(covered) > 30 * len(w))

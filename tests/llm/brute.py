"""Plain versions of the operators over Python lists."""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict


def lower_ascii(text):
    return (text or "").translate({c: c + 32 for c in range(65, 91)})


def sha(text):
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


class Sets:
    def __init__(self, items):
        self.up = {i: i for i in items}

    def find(self, x):
        while self.up[x] != x:
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self.up[max(a, b)] = min(a, b)


def contamination(docs, items, width=10):
    cut = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+").findall
    windows = defaultdict(set)
    for item, text in items:
        w = cut(lower_ascii(text))
        for e in range(min(width, len(w)), len(w) + 1) if w else ():
            windows[tuple(w[max(0, e - width):e])].add(str(item))
    out = {}
    for doc, text in docs:
        w = cut(lower_ascii(text))
        hit, found = set(), set()
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                if tuple(w[k:k + n]) in windows:
                    found |= windows[tuple(w[k:k + n])]
                    hit |= set(range(k, k + n))
        out[doc] = (len(w), len(hit), len(found), sha(",".join(sorted(found))), bool(hit))
    return out


def fingerprint(text):
    import xxhash

    w = re.findall(r"[^\x20\x09-\x0D]+", lower_ascii(text))
    hashes = [xxhash.xxh64_intdigest(" ".join(w[k:k + 4]).encode(), 42) for k in range(max(1, len(w) - 3))] if w else []
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0


def near_duplicates(docs):
    fps = {d: fingerprint(t) for d, t in docs}
    sets, ids = Sets(fps), sorted(fps)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            if (fps[a] ^ fps[b]).bit_count() <= 4:
                sets.join(a, b)
    return {d: (f"{fps[d]:016x}", sets.find(d)) for d in ids}


def within_one_edit(a, b):
    if abs(len(a) - len(b)) > 1:
        return False
    if len(a) > len(b):
        a, b = b, a
    i = 0
    while i < len(a) and a[i] == b[i]:
        i += 1
    return a[i + 1:] == b[i + 1:] if len(a) == len(b) else a[i:] == b[i + 1:]


def dedup_lines(docs, near_chars=16):
    first = {}
    for doc, text in sorted(docs, key=lambda d: d[0]):
        for k, line in enumerate((text or "").split("\n")):
            if line.strip(" "):
                first.setdefault(line, (doc, k))
    by_length = defaultdict(list)
    gone = set()
    for line in first:
        if len(line) >= near_chars:
            if any(within_one_edit(line, x) for n in (-1, 0, 1) for x in by_length[len(line) + n]):
                gone.add(line)
            by_length[len(line)].append(line)
    return {doc: None if text is None else "\n".join(
        line for k, line in enumerate(text.split("\n"))
        if not line.strip(" ") or first[line] == (doc, k) and line not in gone) for doc, text in docs}


def repeated_paragraphs(docs, min_words=50, jaccard=0.8):
    places = defaultdict(list)
    for doc, text in docs:
        for k, line in enumerate((text or "").split("\n")):
            if len(lower_ascii(line).split()) >= min_words:
                places[line].append((doc, k))

    def shingles(line):
        w = line.encode().lower().split()
        return {tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))}

    sets_of = {p: shingles(p) for p in places}
    sets, kinds = Sets({min(v): 0 for v in places.values()}), list(places)
    for i, a in enumerate(kinds):
        for b in kinds[:i]:
            if len(sets_of[a] & sets_of[b]) >= jaccard * len(sets_of[a] | sets_of[b]) - 1e-9:
                sets.join(min(places[a]), min(places[b]))
    groups = defaultdict(list)
    for p, at in places.items():
        groups[sets.find(min(at))] += at
    return {at: c for c, all_at in groups.items() if len(all_at) > 1 for at in all_at}


def near_vectors(rows, cosine=0.95):
    import numpy as np

    good = [(i, np.array(v, dtype=float)) for i, v in rows
            if v is not None and None not in v and np.isfinite(np.array(v, dtype=float)).all() and any(v)]
    sets, links, pairs = Sets([i for i, _ in rows]), {i: 0 for i, _ in rows}, set()
    for k, (i, v) in enumerate(good):
        for j, w in good[:k]:
            if len(v) == len(w) and v @ w / np.linalg.norm(v) / np.linalg.norm(w) >= cosine:
                links[i] += 1
                links[j] += 1
                pairs.add((j, i))
                sets.join(i, j)
    return {i: (links[i], sets.find(i)) for i in links}, pairs


def longest_match(word, pieces, continuation):
    at = count = 0
    while at < len(word):
        for end in range(len(word), at, -1):
            if (continuation if at else "") + word[at:end] in pieces:
                break
        else:
            return 1
        at, count = end, count + 1
    return count

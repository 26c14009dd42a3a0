"""Plain definitions of the operators, for small tables."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


class Union:
    def __init__(self, items):
        self.up = {i: i for i in items}

    def root(self, i):
        while self.up[i] != i:
            i = self.up[i]
        return i

    def join(self, a, b):
        a, b = self.root(a), self.root(b)
        self.up[max(a, b)] = min(a, b)


def shingles(text, k):
    w = WORD.findall((text or "").translate(LOWER))
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def jaccard_classes(rows, k, t):
    """(doc_id, size, component, links) of rows with distinct doc_ids."""
    sets = {d: shingles(text, k) for d, text in rows}
    u, links = Union(sets), Counter()
    for a in sets:
        for b in sets:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= t * len(sets[a] | sets[b]):
                u.join(a, b)
                links[a] += 1
                links[b] += 1
    return sorted((d, len(s), u.root(d), links[d]) for d, s in sets.items())


def without_repeats(rows, window=13):
    """(doc_id, n_words, n_removed, kept)."""
    first, out = {}, []
    docs = [(d, WORD.findall(t or "")) for d, t in rows]
    for d, w in docs:
        for i in range(len(w) - window + 1):
            key = tuple(w[i:i + window])
            if d is not None:
                first[key] = min(first.get(key, d), d)
    for d, w in docs:
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if d is not None and first[tuple(w[i:i + window])] < d:
                gone[i:i + window] = [True] * window
        out.append((d, len(w), sum(gone), " ".join(x for x, g in zip(w, gone, strict=True) if not g)))
    return out


def leaks(rows, items, n=10):
    """(doc_id, n_words, hit flags, items) per row."""
    owners = defaultdict(set)
    for item, text in items:
        w = ALNUM.findall((text or "").translate(LOWER))
        for i in range(max(1, len(w) - n + 1) if w else 0):
            owners[tuple(w[i:i + n])].add("" if item is None else str(item))
    out = []
    for d, text in rows:
        w = ALNUM.findall((text or "").translate(LOWER))
        hit, found = [False] * len(w), set()
        for m in {len(k) for k in owners}:
            for i in range(len(w) - m + 1):
                if (key := tuple(w[i:i + m])) in owners:
                    hit[i:i + m] = [True] * m
                    found |= owners[key]
        out.append((d, len(w), hit, sorted(found)))
    return out


KINDS = {
    "assign": (re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""), 2, 8),
    "access": (re.compile(r"AKIA[A-Z0-9]+"), 0, 16),
    "hex": (re.compile(r"[0-9a-f]+"), 0, 32),
}


def base_secrets(text):
    spans = []
    for no, (kind, (pattern, group, least)) in enumerate(KINDS.items()):
        spans += [(m.start(), no, kind, m.end()) for m in pattern.finditer(text or "") if len(m[group]) >= least]
    return [f"{k}:{a}:{b}" for a, _, k, b in sorted(spans)]


def quality_counts(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    text = text or ""
    w = WORD.findall(text)
    seen = Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
    flag = [False] * len(w)
    for i in range(len(w) - 2):
        if seen[tuple(w[i:i + 3])] > 1:
            flag[i:i + 3] = [True] * 3
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), sum(flag))


def line_shingles(line, k=8):
    """Every character run of k."""
    return {line[i:i + k] for i in range(max(1, len(line) - k + 1))}


def line_classes(rows, threshold=0.8):
    """(doc_id, line_no) -> first (doc_id, line_no) of its class, by all pairs."""
    lines = [((d, i), x) for d, t in rows if d is not None and t is not None
             for i, x in enumerate(t.split("\n")) if WORD.search(x)]
    u, sets = Union([k for k, _ in lines]), {k: line_shingles(x) for k, x in lines}
    for a, x in lines:
        for b, y in lines:
            if a < b and (x == y or len(sets[a] & sets[b]) >= threshold * len(sets[a] | sets[b])):
                u.join(a, b)
    return {k: u.root(k) for k, _ in lines}

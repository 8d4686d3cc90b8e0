"""Plain Python versions of what the operators are to return."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter


def words(text):
    return (text or "").encode().split()


class Groups:
    def __init__(self, nodes):
        self.parent = {n: n for n in nodes}

    def root(self, x):
        while self.parent[x] != x:
            x = self.parent[x]
        return x

    def link(self, a, b):
        a, b = self.root(a), self.root(b)
        self.parent[max(a, b)] = min(a, b)


def near_duplicates(rows, size):
    """{id: (n_shingles, component)} of (id, text) rows with distinct ids."""
    sets = {}
    for i, text in rows:
        w = [x.lower() for x in words(text)]
        width = min(size, len(w))
        sets[i] = {tuple(w[k : k + width]) for k in range(len(w) - width + 1)} if w else set()
    groups = Groups(sets)
    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            common = len(sets[a] & sets[b])
            if common and 100 * common >= 80 * (len(sets[a]) + len(sets[b]) - common):
                groups.link(a, b)
    return {i: (len(sets[i]), groups.root(i)) for i in ids}


def near_vectors(rows, threshold):
    """{id: (n_links, component)} of (id, vector, label) rows with distinct ids."""
    good = {}
    for i, v, label in rows:
        fit = v and label is not None and all(x is not None and math.isfinite(x) for x in v) and any(v)
        if fit:
            good[i] = (v, label)
    groups, links = Groups([r[0] for r in rows]), Counter()
    ids = sorted(good)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            (x, s), (y, t) = good[a], good[b]
            if s == t and len(x) == len(y):
                dot = math.fsum(p * q for p, q in zip(x, y))
                if dot / math.sqrt(math.fsum(p * p for p in x) * math.fsum(q * q for q in y)) >= threshold:
                    links.update((a, b))
                    groups.link(a, b)
    return {r[0]: (links[r[0]], groups.root(r[0])) for r in rows}


def repeats(rows, window):
    """[(id, n_words, n_removed, sha256)] of (id, text) rows in order of id."""
    seen, out = set(), []
    for i, text in rows:
        w = words(text)
        gone = [False] * len(w)
        for k in range(len(w) - window + 1):
            run = tuple(w[k : k + window])
            if run in seen:
                gone[k : k + window] = [True] * window
            seen.add(run)
        rest = b" ".join(x for x, g in zip(w, gone) if not g)
        out.append((i, len(w), sum(gone), hashlib.sha256(rest).hexdigest()))
    return out


PII = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def _luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        value = int(c) * (1 + i % 2)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def _sound(kind, value):
    digits = re.sub("[^0-9]", "", value)
    if kind == "ip":
        return all(int(p) <= 255 for p in value.split("."))
    if kind == "card":
        return 13 <= len(digits) <= 19 and _luhn(digits)
    return kind != "phone" or 9 <= len(digits) <= 15


def base_spans(text):
    return ",".join(
        f"{kind}:{m.start()}:{m.end()}" for kind, form in PII.items() for m in re.finditer(form, text or "") if _sound(kind, m.group())
    )

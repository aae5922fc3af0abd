"""Plain versions of stages, on lists of rows."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


class Union:
    def __init__(self, n):
        self.up = list(range(n))

    def root(self, i):
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def join(self, i, j):
        a, b = self.root(i), self.root(j)
        self.up[max(a, b)] = min(a, b)


def line_shingles(x, size: int = 5):
    t = " ".join(WORD.findall(x.lower()))
    return {t[i : i + size] for i in range(max(1, len(t) - size + 1))}


def dedup_lines(texts: dict) -> dict:
    lines = [(d, n, x) for d in sorted(texts) for n, x in enumerate((texts[d] or "").split("\n")) if WORD.search(x)]
    sets, u = [line_shingles(x) for _, _, x in lines], Union(len(lines))
    for i in range(len(lines)):
        for j in range(i):
            if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                u.join(i, j)
    gone = defaultdict(set)
    for i, (d, n, _) in enumerate(lines):
        if u.root(i) != i:
            gone[d].add(n)
    out = {}
    for d, t in texts.items():
        left = t if not gone[d] else "\n".join(x for n, x in enumerate(t.split("\n")) if n not in gone[d])
        if not gone[d] or WORD.search(left):
            out[d] = left
    return out


def first_of_components(texts: dict, size: int, percent: int) -> set:
    ids = sorted(texts)
    sets = []
    for d in ids:
        w = WORD.findall((texts[d] or "").translate(LOW))
        sets.append({tuple(w[i : i + size]) for i in range(len(w) - size + 1)} or ({tuple(w)} if w else set()))
    u = Union(len(ids))
    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= percent * len(a | sets[j]):
                u.join(i, j)
    return {ids[i] for i in range(len(ids)) if u.root(i) == i}


def mix(rows: list, most: int = 2, seed: int = 11) -> Counter:
    """Times each doc_id is taken, over all its rows. rows: doc_id, text, lang, source; ids may be NULL and repeat."""
    leaf = lambda r: (f"domain{zlib.crc32((r[3] or '').encode()) % 4}", r[2] or "", r[3] or "")
    size = lambda r: len(WORD.findall(r[1] or ""))
    tokens = Counter()
    for r in rows:
        if size(r):
            tokens[leaf(r)] += size(r)

    def fill(budget, at, depth):
        if depth == 3:
            return {at: budget}
        kids = defaultdict(int)
        for k, t in tokens.items():
            if k[:depth] == at:
                kids[k[: depth + 1]] += t
        open_, left, out = dict(kids), budget, {}
        while open_:
            weight = sum(math.sqrt(t) for t in open_.values())
            full = [k for k, t in open_.items() if most * t <= left * math.sqrt(t) / weight + 1e-9]
            if not full:
                out |= {k: left * math.sqrt(t) / weight for k, t in open_.items()}
                break
            for k in full:
                out[k] = most * open_.pop(k)
            left = budget - sum(out.values())
        got = {}
        for k, b in out.items():
            got |= fill(b, k, depth + 1)
        return got

    times = Counter()
    for k, b in fill(sum(tokens.values()), (), 0).items():
        whole = math.floor(b / tokens[k] + 1e-9)
        rest = b - whole * tokens[k]
        place = lambda d: int(hashlib.md5(f"{'' if d is None else d}/{seed}/{whole}".encode()).hexdigest()[:15], 16)  # noqa: E731, B023
        mine = defaultdict(list)  # rows that share a place are taken together
        for r in rows:
            if size(r) and leaf(r) == k:
                mine[place(r[0])].append(r)
        total = 0
        for at in sorted(mine):
            total += sum(map(size, mine[at]))
            for r in mine[at]:
                times[r[0]] += whole + (total <= rest)
    return times

"""Plain versions of the text operators, without Spark and without their methods."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def words(text):
    return WORD.findall(text or "")


def shingles(text, size):
    w = words((text or "").translate(LOWER))
    return [tuple(w[i : i + size]) for i in range(len(w) - size + 1)]


def shingle_set(text, size):
    w = words((text or "").translate(LOWER))
    return frozenset(shingles(text, size)) if len(w) >= size else frozenset([tuple(w)] if w else [])


def counts(text):
    text, w = text or "", words(text)
    grams = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    covered = {k for i in range(len(w) - 4) if grams[tuple(w[i : i + 5])] > 1 for k in range(i, i + 5)}
    seen, again = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            again += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), again, len(covered)


def components(rows, size, percent=80):
    """doc_id -> least doc_id that can be reached; rows are (doc_id, text)."""
    sets = {(i, t): shingle_set(t, size) for i, t in rows}
    keys, parent = list(sets), {k: k for k in sets}

    def find(k):
        while parent[k] != k:
            k = parent[k]
        return k

    holders = defaultdict(list)
    for k in keys:
        met = Counter(other for s in sets[k] for other in holders[s])
        for other, n in met.items():
            if 100 * n >= percent * (len(sets[k]) + len(sets[other]) - n):
                parent[find(k)] = find(other)
        for s in sets[k]:
            holders[s].append(k)
    groups = defaultdict(list)
    for k in keys:
        groups[find(k)].append(k[0])
    return {k: (len(sets[k]), min(groups[find(k)])) for k in keys}


def without_repeats(rows, size):
    """(doc_id, text) -> (words, removed, kept text)."""
    first = {}
    for i, t in sorted(rows, key=lambda r: r[0]):
        w = words(t)
        for k in range(len(w) - size + 1):
            first.setdefault(tuple(w[k : k + size]), i)
    out = {}
    for i, t in rows:
        w = words(t)
        gone = {p for k in range(len(w) - size + 1) if first[tuple(w[k : k + size])] < i for p in range(k, k + size)}
        out[(i, t)] = (len(w), len(gone), " ".join(x for p, x in enumerate(w) if p not in gone))
    return out


def leaks(docs, items, size=5, percent=80):
    """(doc_id, item_id) -> (windows, first of the best, similarity)."""
    found = {}
    bags = {i: shingles(t, size) for i, t in items}
    for d, t in set(docs):
        mine = shingles(t, size)
        for i, theirs in bags.items():
            m, best, n = len(theirs), None, 0
            for start in range(max(0, len(mine) - m) + 1 if mine and theirs else 0):
                both = sum((Counter(mine[start : start + m]) & Counter(theirs)).values())
                either = min(m, len(mine)) + m - both
                if 100 * both >= percent * either:
                    n += 1
                    best = max(best or (0, 0), (both / either, -start))
            if n:
                found[(d, i)] = (n, -best[1], best[0])
    return found


def luhn(digits):
    d = [int(c) for c in digits][::-1]
    return sum(d[::2] + [sum(divmod(2 * x, 10)) for x in d[1::2]]) % 10 == 0


def personal(text):
    text = text or ""
    digits = lambda m: re.sub("[^0-9]", "", m.group())
    found = [(m.start(), 0, m.end(), "email") for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    found += [(m.start(), 1, m.end(), "ip") for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m.group().split("."))]
    found += [(m.start(), 2, m.end(), "card") for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text) if 14 <= len(digits(m)) <= 19 and luhn(digits(m))]
    found += [(m.start(), 3, m.end(), "phone") for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 10 <= len(digits(m)) <= 15]
    return [(a, b, k) for a, _, b, k in sorted(found)]


def credentials(text):
    text = text or ""
    word = "|".join("".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in w) for w in ("password", "passwd", "secret", "token", "api_?key"))
    found = [(m.start(), 0, m.end(), "assign") for m in re.finditer(rf"""({word})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text) if len(m.group(2)) >= 6]
    found += [(m.start(), 1, m.end(), "access") for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m.group()) >= 20]
    found += [(m.start(), 2, m.end(), "hex") for m in re.finditer(r"[0-9a-f]+", text) if len(m.group()) >= 24]
    return [(a, b, k) for a, _, b, k in sorted(found)]


def shown(spans):
    return ",".join(f"{k}:{a}:{b}" for a, b, k in spans)

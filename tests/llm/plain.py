"""The agreed results worked out plainly in Python, one text at a time."""

import hashlib
import math
import re
import zlib
from collections import Counter

WORD = re.compile(r"[^\x20\x09-\x0D]+")
KINDS = ["email", "ip", "card", "phone"]


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def rest(doc_id, n):
    return None if doc_id is None else zlib.crc32(str(doc_id).encode()) % n


def word_set(text, k=5):
    w = WORD.findall(lower(text))
    if len(w) >= k:
        return frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    return frozenset([tuple(w)] if w else [])


def components(sets, linked):
    """Smallest index that each index reaches over linked pairs."""
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(sets)):
        for j in range(i):
            if linked(sets[i], sets[j]):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [find(i) for i in range(len(sets))]


def near(a, b):
    both = len(a & b)
    return both > 0 and 100 * both >= 75 * (len(a) + len(b) - both)


def rules(text):
    text = text or ""
    words = WORD.findall(text)
    n = len(words)
    windows = Counter(tuple(words[i : i + 3]) for i in range(n - 2))
    inside = set()
    for i in range(n - 2):
        if windows[tuple(words[i : i + 3])] > 1:
            inside |= {i, i + 1, i + 2}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(inside)


def digest(spans, names):
    text = ",".join(f"{names[k]}:{a}:{b}" for a, k, b in sorted(spans))
    return hashlib.sha256(text.encode()).hexdigest()


def secrets(text):
    text = text or ""
    assign = re.compile(
        r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    )
    spans = [(m.start(), 0, m.end()) for m in assign.finditer(text) if len(m[2]) >= 8]
    spans += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    spans += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return sorted(spans)


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def personal(text):
    text = text or ""
    digits = lambda m: re.sub("[^0-9]", "", m[0])
    email = re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)
    spans = [(m.start(), 0, m.end()) for m in email]
    ip = re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text)
    spans += [(m.start(), 1, m.end()) for m in ip if all(int(p) <= 255 for p in m[0].split("."))]
    card = re.finditer(r"[0-9]([\x20-]?[0-9])+", text)
    spans += [(m.start(), 2, m.end()) for m in card if 14 <= len(digits(m)) <= 19 and luhn(digits(m))]
    phone = re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text)
    spans += [(m.start(), 3, m.end()) for m in phone if 10 <= len(digits(m)) <= 15]
    return sorted(spans)


def targets(sizes, weights=(5, 2, 1), share=1.5):
    """Words to take from each source; sizes by source."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, full = share * sum(sizes.values()), set()
    while True:
        left = total - sum(2 * sizes[s] for s in full)
        free = sum(weight[s] for s in order if s not in full)
        want = {s: 2 * sizes[s] if s in full else left * weight[s] / free for s in order}
        over = {s for s in order if s not in full and want[s] > 2 * sizes[s]}
        if not over:
            return want
        full |= over


def base_scores(rows):
    """(n_tokens, n_known, train tokens, base score) of (id, text) rows."""
    words = [[*WORD.findall(lower(t)), None] for _, t in rows]
    counts = Counter()
    for (i, _), w in zip(rows, words, strict=True):
        if i is not None and rest(i, 7) != 2:
            counts.update(w)
    n, v = sum(counts.values()), len(counts)
    return [
        (len(w), sum(counts[x] > 0 for x in w), n, sum(math.log10((counts[x] + 1) / (n + v + 1)) for x in w)) for w in words
    ]


def edit_distance_inside(item, text):
    """Smallest edit distance of the item to any part of the text."""
    row = [0] * (len(text) + 1)
    for i, c in enumerate(item):
        new = [i + 1]
        for j, d in enumerate(text):
            new.append(min(row[j + 1] + 1, new[j] + 1, row[j] + (c != d)))
        row = new
    return min(row)

"""Plain-Python versions of the operators' definitions."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def low(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def sha(s):
    return hashlib.sha256(s if isinstance(s, bytes) else s.encode()).hexdigest()


def crc(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode())


def quality(text):
    text = text or ""
    w = WORD.findall(text)
    seen, covered = Counter(zip(w, w[1:], w[2:])), set()
    for i in range(len(w) - 2):
        if seen[w[i], w[i + 1], w[i + 2]] > 1:
            covered |= {i, i + 1, i + 2}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    n, r = len(w), len(covered)
    return n, sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), r, n < 50 or 100 * r > 50 * n


def luhn(d):
    total = 0
    for i, c in enumerate(reversed(d)):
        v = int(c) * (1 + i % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def pii(text):
    text, out = text or "", []
    rules = [(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m, d: True),
             (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m, d: all(int(x) <= 255 for x in m.split("."))),
             (r"[0-9]([\x20-]?[0-9])+", lambda m, d: 14 <= len(d) <= 19 and luhn(d)),
             (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m, d: 10 <= len(d) <= 15)]
    for k, (rule, good) in enumerate(rules):
        out += [(m.start(), k, m.end()) for m in re.finditer(rule, text) if good(m[0], re.sub("[^0-9]", "", m[0]))]
    return [(("email", "ip", "card", "phone")[k], a, b) for a, k, b in sorted(out)]


def leaks(docs, items):
    where = defaultdict(set)
    for item, text in items:
        w = ALNUM.findall(low(text))
        for i in range(max(1, len(w) - 9) if w else 0):
            where[tuple(w[i:i + 10])].add(str(item))
    sizes, out = {len(k) for k in where}, []
    for text in docs:
        w, hit, found = ALNUM.findall(low(text)), set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                if (k := tuple(w[i:i + n])) in where:
                    hit |= set(range(i, i + n))
                    found |= where[k]
        out.append((len(w), len(hit), len(found), sha(",".join(sorted(found))), bool(hit)))
    return out


def jaccard(docs, size=4, percent=85):
    """docs: (doc_id, text). doc_id -> (shingles, component)."""
    sets, holders, parent = {}, defaultdict(list), {}
    for i, text in docs:
        w = WORD.findall(low(text))
        sets[i] = {tuple(w[j:j + size]) for j in range(max(1, len(w) - size + 1))} if w else set()
        parent[i] = i
        for s in sets[i]:
            holders[s].append(i)

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, s in sets.items():
        for j, o in Counter(j for x in s for j in holders[x] if j < i).items():
            if 100 * o >= percent * (len(s) + len(sets[j]) - o):
                a, b = sorted((top(i), top(j)))
                parent[b] = a
    return {i: (len(s), top(i)) for i, s in sets.items()}


def suffix(texts, length=200):
    data = [(t or "").encode() for t in texts]
    seen, out = Counter(b[i:i + length] for b in data for i in range(len(b) - length + 1)), []
    for b in data:
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if seen[b[i:i + length]] > 1:
                gone[i:i + length] = b"\1" * length
        kept = bytes(c for c, g in zip(b, gone) if not g)
        out.append((len(b), sum(gone), len(re.findall(b"\1+", gone)), sha(kept)))
    return out


def unigrams(docs):
    """docs: (doc_id, text). n_tokens, n_known, N, base score of each."""
    tokens = [WORD.findall(low(t)) + [None] for _, t in docs]
    c = Counter(w for (i, _), ws in zip(docs, tokens) if crc(i) % 5 != 1 for w in ws)
    n, below = sum(c.values()), sum(c.values()) + 0.5 * (len(c) + 1)
    return [(len(ws), sum(w in c for w in ws), n, sum(math.log10((c[w] + 0.5) / below) for w in ws)) for ws in tokens]


def bfd(lengths, capacity):
    """Sequences that best-fit decreasing needs."""
    room = []
    for s in sorted(lengths, reverse=True):
        fit = [r for r in room if r >= s]
        if fit:
            room.remove(min(fit))
            room.append(min(fit) - s)
        else:
            room.append(capacity - s)
    return len(room)

"""Plain Python versions of the corpus operators, and the odd rows every operator must bear."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

EXTRA = "k1 long, node string, h long, score double, row string, line int, t string, removed string, text_2 string"
DOCUMENTS = f"doc_id long, text string, {EXTRA}"
FILL = (1, "n", 2, 0.5, "r", 3, "t", "x", "y")

BODY = "the quick brown fox jumps over the lazy dog while seven wizards brew a potion of red herbs in the old tower near the river bank"
LINES = "\n".join(f"line number {i} says that the {w} stays on the shelf for the winter months" for i, w in enumerate("jam tea salt oil rice".split()))
LONG = " ".join(f"word{i * 7919 % 10007}" for i in range(30_000))


def odd_rows():
    """Nulls, empty and blank texts, repeated rows, copies, near copies, a very long text."""
    near = BODY.replace("seven", "eight", 1)
    rows = [
        (1, BODY), (2, BODY), (2, BODY), (3, near + " indeed so"), (4, None), (5, ""), (6, " \t\n "), (7, "one two"), (8, "One  TWO"),
        (None, BODY), (None, None), (9, LINES), (10, "intro\n" + LINES + "\nend"), (11, LINES), (11, LINES), (12, LONG), (13, LONG + " tail"),
        (14, "ÀÉ ünïcode " * 40), (15, "ÀÉ ünïcode " * 41), (16, "\n\n\n"), (17, "a"),
    ]
    return [(i, t, *FILL) for i, t in rows]


def words(text):
    return (text or "").encode().lower().split()


def shingle_set(text, size):
    found = words(text)
    if not found:
        return frozenset()
    return frozenset(tuple(found[i : i + size]) for i in range(max(1, len(found) - size + 1)))


def near_classes(rows, size, percent):
    """Per row (id, n_shingles, component, kept)."""
    sets = [shingle_set(t, size) for _, t in rows]
    distinct = list({s for s in sets if s})
    parent = {s: s for s in distinct}

    def root(s):
        while parent[s] is not s:
            s = parent[s]
        return s

    index = defaultdict(list)
    for s in distinct:
        for g in s:
            index[g].append(s)
    for a in distinct:
        common = Counter()
        for g in a:
            for b in index[g]:
                common[b] += 1
        for b, n in common.items():
            if a is not b and 100 * n >= percent * (len(a) + len(b) - n):
                parent[root(a)] = root(b)
    least = {}
    for (i, _), s in zip(rows, sets, strict=True):
        if s and i is not None:
            least[root(s)] = min(i, least.get(root(s), i))
    out = []
    for (i, _), s in zip(rows, sets, strict=True):
        component = least.get(root(s)) if s else i
        out.append((i, len(s), component, i is not None and i == component))
    return out


def substring_rows(rows, length):
    """Per row (id, bytes, removed, spans, sha256 of the rest)."""
    texts = [(i, (t or "").encode()) for i, t in rows]
    seen = Counter(b[p : p + length] for _, b in texts for p in range(len(b) - length + 1))
    out = []
    for i, b in texts:
        gone = bytearray(len(b))
        for p in range(len(b) - length + 1):
            if seen[b[p : p + length]] > 1:
                gone[p : p + length] = b"\1" * length
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        spans = sum(1 for p in range(len(b)) if gone[p] and not (p and gone[p - 1]))
        out.append((i, len(b), len(b) - len(kept), spans, hashlib.sha256(kept).hexdigest()))
    return out


def line_rows(rows, min_words):
    """Per row (id, lines, removed lines, runs, kept text), rows with distinct ids in order."""
    split = [None if t is None else t.split("\n") for _, t in rows]
    places = defaultdict(list)
    for d, lines in enumerate(split):
        for j, line in enumerate(lines or []):
            places[line].append((d, j))
    out = []
    for d, ((i, text), lines) in enumerate(zip(rows, split, strict=True)):
        gone = set()
        for j in range(len(lines or [])):
            best = 0
            for e, k in places[lines[j]]:
                if (e, k) >= (d, j):
                    break
                other, n = split[e], 0
                while j + n < len(lines) and k + n < len(other) and lines[j + n] == other[k + n]:
                    n += 1
                best = max(best, n)
            if sum(len(words(x)) for x in lines[j : j + best]) >= min_words:
                gone.update(range(j, j + best))
        kept = None if text is None else "\n".join(x for j, x in enumerate(lines) if j not in gone)
        out.append((i, len(lines or []), len(gone), sum(1 for j in gone if j - 1 not in gone), kept))
    return out


def fold(doc_id, n):
    return None if doc_id is None else zlib.crc32(str(doc_id).encode()) % n


def unigram_rows(rows, learn):
    """Per row (id, tokens, known tokens, training tokens, base score)."""
    counts = Counter()
    for i, t in rows:
        if learn(i):
            counts.update([*words(t), None])
    total, types = sum(counts.values()), len(counts)
    out = []
    for i, t in rows:
        tokens = [*words(t), None]
        base = sum(math.log10((counts[w] + 0.1) / (total + 0.1 * (types + 1))) for w in tokens)
        out.append((i, len(tokens), sum(counts[w] > 0 for w in tokens), total, base))
    return out


def top_rows(vectors, every, k, scale=256):
    """(query, rank, id, score) rows of whole vectors, {id: list} or pairs whose ids may repeat."""
    out = []
    whole = [(i, [math.floor(scale * x) for x in v]) for i, v in (vectors.items() if isinstance(vectors, dict) else vectors)]
    for own, (q, w) in enumerate(whole):
        if q % every == 0:
            scores = sorted((-sum(a * b for a, b in zip(w, v, strict=True)), i) for n, (i, v) in enumerate(whole) if n != own and len(v) == len(w))
            out.extend((q, rank, i, -s) for rank, (s, i) in enumerate(scores[:k], 1))
    return out


NUMBER = re.compile(r"\d+(?:[.,]\d+)*")


def least_padding(lengths, buckets):
    """Least total padding by trying every choice of limits."""
    from itertools import combinations

    values = sorted(set(lengths))
    best = None
    for n in range(min(buckets, len(values))):
        for chosen in combinations(values[:-1], n):
            limits = [*chosen, values[-1]]
            padding = sum(min(x for x in limits if x >= v) - v for v in lengths)
            best = padding if best is None else min(best, padding)
    return best

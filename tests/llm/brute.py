"""The contracts again, written as plainly as possible."""

import hashlib
import re
from collections import Counter

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def rules(text):
    text = text or ""
    w = WORD.findall(text)
    grams = Counter(zip(w, w[1:], w[2:]))
    again = {i + k for i in range(len(w) - 2) if grams[tuple(w[i : i + 3])] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return {
        "n_words": len(w),
        "word_chars": sum(map(len, w)),
        "n_symbols": sum(c in "#*$%&|<>" for c in text),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(again),
        "base_failed": len(w) < 50 or 100 * len(again) > 50 * len(w),
    }


KINDS = {
    "assign": re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A),
    "access": re.compile(r"AKIA[A-Z0-9]+"),
    "hex": re.compile(r"[0-9a-f]+"),
}


def base_spans(text):
    found = []
    for k, (kind, pattern) in enumerate(KINDS.items()):
        for m in pattern.finditer(text or ""):
            if len(m[2] if kind == "assign" else m[0]) >= {"assign": 8, "access": 16, "hex": 32}[kind]:
                found.append((m.start(), k, m.end(), kind))
    return [(kind, s, e) for s, _, e, kind in sorted(found)]


def listed(spans):
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def sha(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


def shingles(text, width):
    w = WORD.findall((text or "").translate(LOWER))
    if not w:
        return frozenset()
    return frozenset(zip(*(w[i:] for i in range(width)))) if len(w) >= width else frozenset([tuple(w)])


def components(texts, width, percent):
    """Smallest index reachable, for each text."""
    sets = [shingles(t, width) for t in texts]
    parent = list(range(len(sets)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 5 * min(len(a), len(b)) >= 2 * max(len(a), len(b)) and 100 * len(a & b) >= percent * len(a | b):
                x, y = sorted((find(i), find(j)))
                parent[y] = x
    return [find(i) for i in range(len(sets))], [len(s) for s in sets]

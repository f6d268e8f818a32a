"""Plain versions of the operators, for small inputs."""

import re
from collections import Counter
from hashlib import sha256

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower_az(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def shingles(text):
    w = WORD.findall(lower_az(text or ""))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)])


def near_dedup(rows):
    sets = [(r[0], shingles(r[1])) for r in rows]
    parent = {d: d for d, _ in sets}

    def top(d):
        while parent[d] != d:
            d = parent[d]
        return d

    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            if x and y and 100 * len(x & y) >= 75 * len(x | y):
                lo, hi = sorted((top(a), top(b)))
                parent[hi] = lo
    return Counter((d, len(s), top(d), top(d) == d) for d, s in sets)


def repeated_words(texts, size=35):
    """Per text the set of places of words to remove."""
    split = [WORD.findall(t or "") for t in texts]
    seen = Counter(tuple(w[i : i + size]) for w in split for i in range(len(w) - size + 1))
    return split, [{k for i in range(len(w) - size + 1) if seen[tuple(w[i : i + size])] > 1 for k in range(i, i + size)} for w in split]


def substring_dedup(rows):
    split, gone = repeated_words([r[1] for r in rows])
    return Counter((r[0], len(w), len(g), sha256(" ".join(x for i, x in enumerate(w) if i not in g).encode()).hexdigest()) for r, w, g in zip(rows, split, gone))


def quality_counts(text):
    text = text or ""
    w = WORD.findall(text)
    seen = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    covered = {k for i in range(len(w) - 4) if seen[tuple(w[i : i + 5])] > 1 for k in range(i, i + 5)}
    lines, repeats = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            repeats += line in lines
            lines.add(line)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), repeats, len(covered)


def base_secrets(text):
    out = []
    for kind, pattern in enumerate((r"(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", r"(AKIA[A-Z0-9]+)", r"([0-9a-f]+)")):
        for m in re.finditer(pattern, text or ""):
            if len(m[1]) >= (8, 16, 32)[kind]:
                out.append((kind, m.start(), m.end()))
    return sorted(out, key=lambda s: (s[1], s[0]))

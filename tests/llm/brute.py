"""Plain restatements of what the operators compute, for small inputs."""

import re
from collections import Counter

import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")
BWORD = re.compile(rb"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def quality(text):
    text = text or ""
    w = words(text)
    seen, dup, lines = set(), 0, 0
    for line in text.split("\n"):
        if WORD.search(line):
            lines += 1
            dup += line in seen
            seen.add(line)
    windows = Counter(zip(w, w[1:], w[2:], strict=False))
    covered = {j + k for j in range(len(w) - 2) if windows[tuple(w[j : j + 3])] > 1 for k in range(3)}
    return {
        "n_words": len(w),
        "word_chars": sum(map(len, w)),
        "n_symbols": sum(c in "#*$%&|<>" for c in text),
        "n_dup_lines": dup,
        "n_repeat_words": len(covered),
        "n_lines": lines,
    }


def spans(flags):
    """Maximal runs of set flags."""
    return sum(1 for i, f in enumerate(flags) if f and not (i and flags[i - 1]))


def repeated_words(docs, width):
    """{doc_id: (words, gone)} where a smaller id has the window."""
    by_id = {}
    for i, text in docs:
        by_id.setdefault(i, BWORD.findall((text or "").encode()))
    order = sorted(by_id, key=lambda i: (i is None, i))
    first, out = {}, {}
    for i in order:
        w = by_id[i]
        gone = [False] * len(w)
        for j in range(len(w) - width + 1):
            k = tuple(w[j : j + width])
            if first.setdefault(k, i) != i:
                gone[j : j + width] = [True] * width
        out[i] = (w, gone)
    return out


def repeated_bytes(docs, width):
    """{doc_id: (bytes, gone)} where the string starts earlier."""
    by_id = {}
    for i, text in docs:
        by_id.setdefault(i, (text or "").encode())
    seen, out = set(), {}
    for i in sorted(by_id, key=lambda i: (i is None, i)):
        b = by_id[i]
        gone = [False] * len(b)
        for j in range(len(b) - width + 1):
            if b[j : j + width] in seen:
                gone[j : j + width] = [True] * width
            seen.add(b[j : j + width])
        out[i] = (b, gone)
    return out


def fingerprint(text, shingle=3):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = words(low)
    parts = [" ".join(w[i : i + shingle]) for i in range(len(w) - shingle + 1)] if len(w) >= shingle else [" ".join(w)] * bool(w)
    h = [xxhash.xxh64_intdigest(p.encode(), seed=42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(v >> b & 1 for v in h) > len(h))


def shingles(text, n):
    """Distinct word shingles in lower case; a shorter text is one shingle."""
    w = words("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(w[i : i + n]) for i in range(max(len(w) - n + 1, min(1, len(w))))}


def groups(nodes, linked):
    """Smallest reachable node of each node."""
    nodes = sorted(nodes)
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for i, a in enumerate(nodes):
        for b in nodes[:i]:
            if linked(a, b):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {n: find(n) for n in nodes}


def targets(sizes, weights=(1, 2, 3), most=3):
    """Target of each source by repeated resharing; ``sizes`` in order of sources."""
    weight = [weights[i % len(weights)] for i in range(len(sizes))]
    target, open_ = [0.0] * len(sizes), set(range(len(sizes)))
    left = float(sum(sizes))
    while open_:
        total = sum(weight[i] for i in open_)
        over = {i for i in open_ if left * weight[i] / total > most * sizes[i]}
        if not over:
            for i in open_:
                target[i] = left * weight[i] / total
            break
        for i in over:
            target[i] = float(most * sizes[i])
        left -= sum(target[i] for i in over)
        open_ -= over
    return target


def thue_morse(n):
    """Two different strings whose polynomial hashes modulo a power of two are equal."""
    bits = [bin(i).count("1") & 1 for i in range(n)]
    return "".join("ab"[b] for b in bits), "".join("ba"[b] for b in bits)

"""Suffix arrays with numpy: Larsson-Sadakane refinement and Kasai's common prefixes.

Sequences are arrays of small integers that end with a 0. Every 0 is a separator of its
own: it is smaller than all tokens, and of two the one that stands first is smaller. So
a suffix counts to its next separator, and all suffixes differ.
"""

from __future__ import annotations

import numpy as np

_LANES = 1 << 15


def packed(seq: np.ndarray, bits: int) -> tuple[np.ndarray, int]:
    """For each place, as many tokens as fit 64 bits, the first on top; and how many."""
    width = 64 // bits
    padded = np.concatenate([seq.astype(np.uint64), np.zeros(width, np.uint64)])
    key = np.zeros(len(seq), np.uint64)
    for k in range(width):
        key = (key << np.uint64(bits)) | padded[k : k + len(seq)]
    return key, width


def next_separator(seq: np.ndarray) -> np.ndarray:
    """For each place the first separator at or after it."""
    at = np.where(seq == 0, np.arange(len(seq)), len(seq))
    return np.minimum.accumulate(at[::-1])[::-1]


def suffix_array(seq: np.ndarray, bits: int) -> np.ndarray:
    """Places of ``seq`` in order of the suffixes there.

    Suffixes are first sorted by a packed prefix. Then every group of equal prefixes of
    length h is sorted by the groups h places on, or at the separator if that comes
    first, which doubles the length; groups of one are final and not touched again.
    """
    n = len(seq)
    stop = next_separator(seq)
    key, h = packed(seq, bits)
    # What follows a separator does not count.
    used = np.minimum(stop - np.arange(n), h).astype(np.uint64)
    spare = (np.uint64(h) - used) * np.uint64(bits)
    key = np.where(spare < np.uint64(64), key >> np.minimum(spare, np.uint64(63)) << np.minimum(spare, np.uint64(63)), np.uint64(0))
    order = np.argsort(key, kind="stable")
    head = np.empty(n, bool)
    head[:1] = True
    np.not_equal(key[order[1:]], key[order[:-1]], out=head[1:])
    head[: int((seq == 0).sum())] = True  # separators come first, in order of place
    del key, used, spare
    group = np.empty(n, np.uint32)  # index of the group's first suffix
    group[order] = np.maximum.accumulate(np.where(head, np.arange(n), 0))
    open_ = np.arange(n)
    while True:
        last = np.append(head[1:], True)
        open_ = open_[~(head & last)[open_]]
        if not len(open_):
            return order
        suffix = order[open_]
        pair = (group[suffix].astype(np.uint64) << np.uint64(32)) | group[np.minimum(suffix + h, stop[suffix])]
        by = np.argsort(pair)
        pair, suffix = pair[by], suffix[by]
        order[open_] = suffix
        new = np.empty(len(pair), bool)
        new[:1] = True
        np.not_equal(pair[1:], pair[:-1], out=new[1:])
        head[open_] = new
        group[suffix] = np.maximum.accumulate(np.where(new, open_, 0))
        h *= 2


def common_prefixes(seq: np.ndarray, order: np.ndarray, bits: int, depth: int) -> np.ndarray:
    """Kasai's algorithm: common prefix of each suffix with the one before it in order.

    At the next place of the text the common prefix is at least one shorter, so the
    comparison goes on from there. The text is walked in many lanes at a time, and the
    comparison takes a packed word per step. Values stop at ``depth``.
    """
    n = len(seq)
    key, width = packed(seq, bits)
    stop = next_separator(seq)
    rank = np.empty(n, np.int64)
    rank[order] = np.arange(n)
    lanes = max(1, min(_LANES, n // 16))
    length = -(-n // lanes)
    out = np.zeros(n, np.int32)
    have = np.zeros(lanes, np.int64)
    base = np.arange(lanes) * length
    for step in range(length):
        live = np.flatnonzero(base + step < n)
        at = base[live] + step
        r = rank[at]
        other = order[np.maximum(r - 1, 0)]
        common = np.where(r > 0, np.maximum(have[live] - 1, 0), 0)
        todo = np.flatnonzero((common < depth) & (r > 0))
        while len(todo):
            a, b = at[todo] + common[todo], other[todo] + common[todo]
            differ = key[a] ^ key[b]
            room = np.minimum(stop[a] - a, stop[b] - b)
            got = np.zeros(len(todo), np.int64)
            for k in range(width):
                got += differ < np.uint64(1 << (bits * (width - 1 - k)))
            got = np.minimum(got, room)
            common[todo] += got
            todo = todo[(got == width) & (common[todo] < depth)]
        common = np.minimum(common, depth)
        have[live] = common
        out[r] = common
    return out


def classes(lcp: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Groups of suffixes that agree in ``depth`` tokens: group of each, first, end."""
    new = lcp < depth
    new[:1] = True
    first = np.flatnonzero(new)
    return np.cumsum(new) - 1, first, np.append(first[1:], len(lcp))


def joined(parts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Parts behind each other with a 0 after each, and where each begins."""
    begin = np.concatenate([[0], np.cumsum([len(p) + 1 for p in parts])]).astype(np.int64)
    out = np.zeros(int(begin[-1]), np.int32)
    for p, at in zip(parts, begin.tolist(), strict=False):
        out[at : at + len(p)] = p
    return out, begin

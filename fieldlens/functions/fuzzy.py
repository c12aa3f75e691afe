"""Edit-based similarity of short strings, 0 to 100, for Pandas UDFs.

``ratio`` is the Indel similarity: twice the longest common subsequence by the summed lengths. ``token_sort`` compares sorted
words, ``token_set`` also their common part, ``partial`` the best window of the longer string, and ``weighted`` the
best of them, each weighted down by how loose it is.
"""

from __future__ import annotations


def common_subsequence(a: str, b: str) -> int:
    """Length of the longest common subsequence, by one bit-parallel pass over b."""
    if not a or not b:
        return 0
    places: dict[str, int] = {}
    for i, c in enumerate(a):
        places[c] = places.get(c, 0) | 1 << i
    full = (1 << len(a)) - 1
    free = full
    for c in b:
        hit = free & places.get(c, 0)
        free = (free + hit | free - hit) & full
    return len(a) - free.bit_count()


def ratio(a: str, b: str) -> float:
    n = len(a) + len(b)
    return 200.0 * common_subsequence(a, b) / n if n else 100.0


def sorted_words(s: str) -> str:
    return " ".join(sorted(s.split()))


def token_sort(a: str, b: str) -> float:
    return ratio(sorted_words(a), sorted_words(b))


def token_set(a: str, b: str) -> float:
    x, y = set(a.split()), set(b.split())
    both = " ".join(sorted(x & y))
    if both and (x <= y or y <= x):
        return 100.0
    left, right = (" ".join(filter(None, [both, " ".join(sorted(s))])) for s in (x - y, y - x))
    return max(ratio(left, right), ratio(both, left) if both else 0.0, ratio(both, right) if both else 0.0)


def partial(a: str, b: str) -> float:
    short, long = sorted((a, b), key=len)
    if not short:
        return 0.0 if long else 100.0
    n = len(short)
    windows = {long[max(0, i) : i + n] for i in range(1 - n, len(long))}
    return max(ratio(short, w) for w in windows)


def weighted(a: str, b: str) -> float:
    """The best of the plain, sorted, set and partial scores under their weights (0.95 for tokens, 0.9 or 0.6 for parts)."""
    if not a or not b:
        return 0.0
    lengths = max(len(a), len(b)) / min(len(a), len(b))
    best = ratio(a, b)
    if lengths < 1.5:
        return max(best, 0.95 * max(token_sort(a, b), token_set(a, b)))
    scale = 0.9 if lengths <= 8 else 0.6
    tokens = max(partial(sorted_words(a), sorted_words(b)), partial(" ".join(sorted(set(a.split()))), " ".join(sorted(set(b.split())))))
    if set(a.split()) & set(b.split()):
        tokens = 100.0
    return max(best, scale * partial(a, b), 0.95 * scale * tokens)

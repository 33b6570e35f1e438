"""String measures used by several operators."""

from __future__ import annotations


def osa(a: str, b: str, most: int | None = None) -> int:
    """Edits and transpositions of neighbours between two strings; above ``most``, any number above it.

    Bit-parallel after Hyyro (2003): a column of the distance table is a pair of whole numbers of as many bits as ``a`` has letters.
    """
    if a == b:
        return 0
    n, m = len(a), len(b)
    if most is not None and abs(n - m) > most:
        return most + 1
    if not n or not m:
        return n or m
    at: dict[str, int] = {}
    bit = 1
    for c in a:
        at[c] = at.get(c, 0) | bit
        bit <<= 1
    mask, last = bit - 1, bit >> 1
    up, down, diagonal, before, score = mask, 0, 0, 0, n
    left = m
    for c in b:
        here = at.get(c, 0)
        diagonal = ((((here & up) + up) ^ up) | here | down | (((~diagonal & here) << 1) & before)) & mask
        plus = down | (~(diagonal | up) & mask)
        minus = diagonal & up
        left -= 1
        if plus & last:
            score += 1
        elif minus & last:
            score -= 1
        if most is not None and score - left > most:
            return most + 1
        plus, minus = (plus << 1) | 1, minus << 1
        up, down, before = (minus | ~(diagonal | plus)) & mask, plus & diagonal & mask, here
    return score


def closeness(a: str, b: str, least: float = 0.0) -> float:
    """1 minus the distance as a part of the longer string's length; below ``least``, any number below it."""
    n = max(len(a), len(b))
    if not n:
        return 1.0
    return 1 - osa(a, b, int((1 - least) * n + 1e-9)) / n


def monge_elkan(a: list[str], b: list[str]) -> float:
    """The mean, weighted by length, of each word's closest word on the other side; the lower of both directions."""

    def one_way(x: list[str], y: list[str]) -> float:
        total = sum(map(len, x))
        return sum(len(w) * max(closeness(w, v) for v in y) for w in x) / total if total else 0.0

    return min(one_way(a, b), one_way(b, a)) if a and b else 0.0

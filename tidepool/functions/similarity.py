"""Likeness of short strings by their longest common subsequence, 0 to 100.

ratio = 200 * lcs / (len a + len b). The lcs of a pair is found bit-parallel, a word per character of one side;
the functions are pandas UDFs, to be run on blocked candidates only.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType


def _masks(a: str) -> dict[str, int]:
    masks: dict[str, int] = {}
    for i, ch in enumerate(a):
        masks[ch] = masks.get(ch, 0) | 1 << i
    return masks


def _lcs_lengths(masks: dict[str, int], n: int, b: str) -> Iterator[int]:
    """The lcs of a text of n letters with each beginning of b, from the first letter on."""
    full = (1 << n) - 1
    row = full
    for ch in b:
        hit = row & masks.get(ch, 0)
        row = (row + hit | row - hit) & full
        yield n - row.bit_count()


def lcs_length(a: str, b: str) -> int:
    length = 0
    for length in _lcs_lengths(_masks(a), len(a), b):
        pass
    return length


def ratio(a: str, b: str) -> float:
    return 100.0 if not a and not b else 200.0 * lcs_length(a, b) / (len(a) + len(b))


def token_sort(a: str, b: str) -> float:
    return ratio(" ".join(sorted(a.split())), " ".join(sorted(b.split())))


def token_set(a: str, b: str) -> float:
    """Shared tokens against shared and own tokens of each side; 100 if one side's tokens are all shared."""
    x, y = set(a.split()), set(b.split())
    if not x or not y:
        return 0.0
    both, only_x, only_y = (" ".join(sorted(s)) for s in (x & y, x - y, y - x))
    if both and (not only_x or not only_y):
        return 100.0
    left, right = (f"{both} {own}".strip() for own in (only_x, only_y))
    best = ratio(left, right)
    return max(best, ratio(both, left), ratio(both, right)) if both else best


def partial(a: str, b: str) -> float:
    """The shorter string against each piece of the longer one of its length, pieces cut off by the ends included; both ways if they are of one length.

    Pieces at the ends come from one pass each. A piece further on by j letters has at most j more in common, so
    after each piece as many are passed over as can't be better than the best so far.
    """
    short, long = sorted((a, b), key=len)
    if not short:
        return 100.0 if not long else 0.0
    n = len(short)
    best = 0.0
    for s, t in [(short, long), (long, short)] if n == len(long) else [(short, long)]:
        masks = _masks(s)
        for m, end in ((masks, t[: n - 1]), (_masks(s[::-1]), t[: -n : -1])):
            best = max([best, *(200.0 * k / (n + size) for size, k in enumerate(_lcs_lengths(m, n, end), 1))])
        at, most = 0, int(best * n / 100)
        while at <= len(t) - n and most < n:
            k = 0
            for k in _lcs_lengths(masks, n, t[at : at + n]):
                pass
            most = max(most, k)
            at += most - k + 1
        best = max(best, 100.0 * most / n)
    return best


def _pairwise(function):
    @F.pandas_udf(DoubleType())
    def run(a: pd.Series, b: pd.Series) -> pd.Series:
        seen: dict[tuple[str, str], float] = {}
        out = []
        for pair in zip(a.fillna(""), b.fillna("")):
            if pair not in seen:
                seen[pair] = function(*pair)
            out.append(seen[pair])
        return pd.Series(out, dtype="float64")

    return run


ratio_udf, token_sort_udf, token_set_udf, partial_udf = map(_pairwise, (ratio, token_sort, token_set, partial))


#: Fixed value: the title's share in the score of a pair of events.
TITLE_SHARE = 0.62


def blended(title_score, venue_score, title_share: float = TITLE_SHARE):
    """The score of a pair of events: titles alone where a venue is missing on either side (venue_score null)."""
    return F.when(venue_score.isNull(), title_score).otherwise(title_share * title_score + (1 - title_share) * venue_score)

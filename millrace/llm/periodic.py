"""Periodic runs of words: maximal pairs out of a bottom-up LCP-interval tree."""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from .common import PIECE_BYTES, map_batches, rolling, texts

#: Words a run has at least, and how often its period goes into it at least.
LEAST_WORDS, LEAST_EXPONENT = 6, 4
#: Words compared one by one for all suffixes at once; longer matches are compared a stretch at a time.
STEPS = 64


def shortest_match(least: int, exponent: int) -> int:
    """The fewest words that the two ends of a run can share."""
    return min(max((exponent - 1) * q, least - q) for q in range(1, least + 1))


def suffix_order(ids: np.ndarray) -> np.ndarray:
    """Suffixes of an array in order, by doubling the sorted prefix; only what still ties is sorted again.

    Every number that ends a text must occur nowhere else, so that no two suffixes tie to the end."""
    n = len(ids)
    order = np.argsort(ids, kind="stable")
    sorted_ids = ids[order]
    fresh = np.append(True, sorted_ids[1:] != sorted_ids[:-1])
    slots, rank, h = np.arange(n), np.empty(n, np.int64), 1
    while True:
        starts = np.flatnonzero(fresh)
        rank[order[slots]] = np.repeat(slots[starts], np.diff(starts, append=len(slots)))
        slots = slots[~fresh | ~np.append(fresh[1:], True)]
        if not len(slots):
            return order
        at = order[slots]
        key = rank[at] * (n + 1) + rank[at + h]
        by = np.argsort(key, kind="stable")
        key, order[slots] = key[by], at[by]
        fresh = np.append(True, key[1:] != key[:-1])
        h *= 2


def _shared(ids: np.ndarray, a: int, b: int) -> int:
    done, size = 0, 256
    while True:
        m = min(size, len(ids) - max(a, b) - done)
        apart = np.flatnonzero(ids[a + done:a + done + m] != ids[b + done:b + done + m])
        if len(apart):
            return done + int(apart[0])
        done, size = done + m, 2 * size


def shared_prefixes(ids: np.ndarray, order: np.ndarray) -> np.ndarray:
    """How many words each suffix shares with the one before it in order.

    Where both follow the same word the number is one less than that of the suffix one word earlier; the others
    are compared, which adds up to n log n words at most."""
    n = len(ids)
    before = np.full(n, -1)
    before[order[1:]] = order[:-1]
    follows = np.zeros(n, bool)
    follows[1:] = (before[1:] > 0) & (ids[:-1] == ids[before[1:] - 1])
    first = np.flatnonzero(~follows)
    a, b, length = first, before[first], np.zeros(len(first), np.int64)
    live = np.flatnonzero(b >= 0)
    for step in range(STEPS):
        live = live[ids[a[live] + step] == ids[b[live] + step]]
        length[live] += 1
        if not len(live):
            break
    for k in live.tolist():
        length[k] += _shared(ids, int(a[k]) + STEPS, int(b[k]) + STEPS)
    reach = np.diff(first, append=n)
    out = np.repeat(length + first, reach) - np.arange(n)
    return out[order]


def _merged(match: int, children: list[list[int]], left: np.ndarray, found: list, least: int, exponent: int) -> list[int]:
    """Places of an interval from those of its children, ascending.

    Places are classed by the word to their left.  Two that come to stand side by side, from different children
    and of different classes, are a maximal pair of ``match`` words: nothing to either side can be added.  Its
    distance q makes it a run if ``match`` is at least (exponent - 1) q.  Within so short a distance the words have
    period q, so a place between the two would give a smaller period, and neighbours are all that is needed.
    """
    children.sort(key=len)
    large = children.pop()
    child_of = {x: i for i, child in enumerate(children) for x in child}
    if 8 * len(child_of) > len(large):
        large = sorted([*large, *child_of])  # stretches in order, so this is a merge
    else:
        for x in child_of:
            large.insert(bisect_left(large, x), x)
    for x in child_of:
        i = bisect_left(large, x)
        # a pair of two places from smaller children is looked at from its right one
        pairs = [(large[i - 1], x)] if i else []
        if i + 1 < len(large) and large[i + 1] not in child_of:
            pairs.append((x, large[i + 1]))
        for a, b in pairs:
            q = b - a
            if (exponent - 1) * q <= match and match + q >= least and left[a] != left[b] \
                    and child_of.get(a, -1) != child_of.get(b, -1):
                found.append((a, match + q, q))
    return large


def _tree(places: list[int], matches: list[int], left: np.ndarray, found: list, least: int, exponent: int) -> None:
    """Bottom up over the interval tree of suffixes that stand together; ``matches[k]`` is between k and k + 1."""
    stack: list[tuple[int, list[list[int]]]] = []
    last = [places[0]]
    for match, place in zip([*matches, 0], [*places[1:], -1]):
        while stack and stack[-1][0] > match:
            deep, children = stack.pop()
            last = _merged(deep, [*children, last], left, found, least, exponent)
        if stack and stack[-1][0] == match:
            stack[-1][1].append(last)
        else:
            stack.append((match, [last]))
        last = [place]


def _groups(ids: np.ndarray, floor: int, exponent: int) -> Iterator[tuple[list[int], list[int]]]:
    """Subtrees of matches of ``floor`` words or more that can hold a run: places and matches between them.  Those whose
    places all follow one word, or lie too far apart for the longest match, can't."""
    order = suffix_order(ids)
    lcp = shared_prefixes(ids, order)
    opens = lcp < floor
    group = np.cumsum(opens) - 1
    size = np.bincount(group)
    inside = size[group] > 1
    if not inside.any():
        return
    order, lcp, group = order[inside], lcp[inside], group[inside]
    starts = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
    ends = np.append(starts[1:], len(order))
    lcp[starts] = 0
    left = np.where(order > 0, ids[order - 1], -1)
    mixed = np.minimum.reduceat(left, starts) != np.maximum.reduceat(left, starts)
    by = np.lexsort((order, group))
    gap = np.diff(order[by], prepend=0)
    gap[starts] = len(ids)
    near = (exponent - 1) * np.minimum.reduceat(gap, starts) <= np.maximum.reduceat(lcp, starts)
    for a, b in zip(starts[mixed & near].tolist(), ends[mixed & near].tolist()):
        yield order[a:b].tolist(), lcp[a + 1:b].tolist()


def runs_of(words: list[list[bytes]], least: int = LEAST_WORDS, exponent: int = LEAST_EXPONENT) -> list[list[tuple[int, int, int]]]:
    """(start, length, period) of the runs of each list of words, by start, then period."""
    floor = shortest_match(least, exponent)
    out: list[list[tuple[int, int, int]]] = [[] for _ in words]
    coded, base = [], 0
    for text in words:
        seen: dict[bytes, int] = {}
        coded.append(np.array([seen.setdefault(w, len(seen)) for w in text], np.int64) + base)
        base += len(seen)
    sizes = np.array([len(c) for c in coded])
    if not sizes.sum():
        return out
    grams = rolling(np.concatenate(coded).astype(np.uint64), floor)  # no word is in two texts, so neither is a gram
    codes, _ = pd.factorize(grams)
    again = np.flatnonzero(np.bincount(codes)[codes] > 1) if len(codes) else codes
    some = np.unique(np.searchsorted(np.cumsum(sizes), again, side="right")).tolist()
    if not some:
        return out
    # texts with a repeat, each with an end that no other has
    ids = np.concatenate([np.append(coded[t], base + t) for t in some])
    firsts = np.cumsum([0, *(len(coded[t]) + 1 for t in some)])
    left = np.append(ids, -1)[np.arange(len(ids)) - 1]
    found: list[tuple[int, int, int]] = []
    for places, matches in _groups(ids, floor, exponent):
        _tree(places, matches, left, found, least, exponent)
    found.sort(key=lambda run: (run[0], run[2]))
    for (start, length, period), t in zip(found, np.searchsorted(firsts, [r[0] for r in found], side="right") - 1):
        out[some[t]].append((start - int(firsts[t]), length, period))
    return out


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words that no run repeats, joined by spaces: of a run only its first period stays."""
    if not runs:
        return b" ".join(words)
    gone = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        gone[start + period] += 1
        gone[start + length] -= 1
    return b" ".join([w for w, g in zip(words, np.cumsum(gone).tolist()) if not g])


def slices(batch: list[bytes], most: int = PIECE_BYTES) -> Iterator[list[bytes]]:
    """Consecutive texts of about ``most`` bytes together; a longer one is alone."""
    part, size = [], 0
    for data in batch:
        if part and size + len(data) > most:
            yield part
            part, size = [], 0
        part.append(data)
        size += len(data)
    if part:
        yield part


def find_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST_WORDS,
              exponent: int = LEAST_EXPONENT) -> DataFrame:
    """The id, ``runs`` (start, length and period in words, by start, then period) and ``collapsed`` of every row.

    Words are what blanks part.  A run is a stretch with smallest period q, of ``least`` words and ``exponent`` times q
    at least, that no neighbouring word extends.  ``collapsed`` are the words, joined by spaces, without those that a
    run has after its first period.  A null or empty text has no runs and collapses to nothing; repeated rows come
    back as they came; an empty table gives no rows; other columns are left out.

    Texts are independent, so nothing is shuffled.  A task holds about a MB of text at a time, or one longer text,
    in arrays of some 20 times its words; the tree is only climbed where places differ in the word before them.
    """
    if exponent < 3 or least < 2:
        raise ValueError("runs need an exponent of 3 and 2 words at least")

    def make():
        def work(batch):
            runs, left = [], []
            for part in slices(batch["text"]):
                words = [data.split() for data in part]
                for text, found in zip(words, runs_of(words, least, exponent)):
                    runs.append([dict(zip(("start", "length", "period"), run)) for run in found])
                    left.append(collapsed(text, found).decode("utf-8", "replace"))
            return {id_col: batch["doc_id"], "runs": runs, "collapsed": left}
        return work

    return map_batches(texts(docs, id_col, text_col), make, f"`{id_col}` {dict(docs.dtypes)[id_col]}, "
                       "runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed string")

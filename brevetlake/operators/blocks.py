"""Edit distances of all texts of two blocks, in numpy: pairs are left out by the letters they lack of each other, the others measured many at a time."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

#: Letters that are told apart, the other ones counting as one; how often a letter is counted; bits of a text.
LETTERS, TIMES, BITS = 64, 4, 64
#: Texts of the left block that are compared at once, entries of the table of their letters at most, and pairs measured at once.
AT_ONCE, ENTRIES, PAIRS = 128, 1 << 22, 1 << 16


class _Texts:
    """Texts by length: `order` (their places), n (letters of each), codes of all letters one after the other, and where each text starts."""

    def __init__(self, texts: list[str]) -> None:
        n = np.fromiter(map(len, texts), np.int64, len(texts))
        self.order = np.argsort(n, kind="stable")
        self.n = n[self.order]
        self.codes = np.frombuffer("".join(texts[i] for i in self.order).encode("utf-32-le"), np.uint32).astype(np.int64)
        self.start = np.cumsum(self.n) - self.n


def _coded(x: _Texts, y: _Texts) -> int:
    """Number of different letters; the letters' codes become numbers below it, the most frequent ones first."""
    often = np.bincount(np.concatenate([x.codes, y.codes, [0]]))
    often[0] -= 1
    found = np.argsort(-often, kind="stable")[: max(1, np.count_nonzero(often))]
    number = np.zeros(len(often), np.int64)
    number[found] = np.arange(len(found))
    x.codes, y.codes = number[x.codes], number[y.codes]
    return len(found)


def _bits(x: _Texts, y: _Texts) -> tuple[np.ndarray, np.ndarray]:
    """Bits of each text, of which each says that it has a letter so many times.  A slip takes and adds one at most."""

    def has(t: _Texts) -> np.ndarray:
        row = np.repeat(np.arange(len(t.n)), t.n)
        times = np.bincount(row * LETTERS + np.minimum(t.codes, LETTERS - 1), minlength=len(t.n) * LETTERS).reshape(-1, LETTERS)
        return np.concatenate([times > k for k in range(TIMES)], axis=1)

    has_x, has_y = has(x), has(y)
    share = (has_x.sum(axis=0) + has_y.sum(axis=0)) / max(1, len(x.n) + len(y.n))
    # The bits that tell most are those that about half of the texts have.
    best = np.argsort(-share * (1 - share), kind="stable")[:BITS]
    as_long = lambda has: np.ascontiguousarray(np.packbits(has[:, best], axis=1)).view(np.uint64).reshape(-1)
    return as_long(has_x), as_long(has_y)


def _table(x: _Texts, low: int, high: int, letters: int) -> tuple[list[np.ndarray], int]:
    """For the texts from low to high, in words of so many bits: where each has each letter."""
    longest = int(x.n[high - 1])
    kind, width = next(((k, w) for k, w in ((np.uint16, 16), (np.uint32, 32)) if longest <= w), (np.uint64, 64))
    words = [np.zeros((high - low) * letters, kind) for _ in range(max(1, -(-longest // width)))]
    for at in range(longest):
        first = low + int(np.searchsorted(x.n[low:high], at, "right"))
        rows = np.arange(first, high)
        words[at // width][(rows - low) * letters + x.codes[x.start[rows] + at]] |= kind(1 << at % width)
    return words, width


def _distances(x: _Texts, y: _Texts, low: int, table: tuple[list[np.ndarray], int], letters: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Distances of the pairs (i, j), by bits of differences down the columns (Myers 1999, Hyyrö 2003), a letter of all right texts at a time."""
    words, width = table
    kind = words[0].dtype.type
    one, last = kind(1), kind(width - 1)
    # Texts that end early are last, so the others stay in front.
    order = np.argsort(-y.n[j], kind="stable")
    row, start, n = (i[order] - low) * letters, y.start[j[order]], y.n[j[order]]
    ups, downs = [np.full(len(order), ~kind(0)) for _ in words], [np.zeros(len(order), kind) for _ in words]
    left = len(order) - np.searchsorted(n[::-1], np.arange(int(n[0]) if len(n) else 0), "right")
    for at, m in enumerate(left.tolist()):
        key = row[:m] + y.codes.take(start[:m] + at)
        plus, minus = one, kind(0)
        for w, own in enumerate(words):
            up, down, eq = ups[w][:m], downs[w][:m], own.take(key)
            across = eq | down
            eq |= minus
            zero = (((eq & up) + up) ^ up) | eq
            rises, falls = down | ~(zero | up), zero & up
            rises_on, falls_on = (rises >> last, falls >> last) if w + 1 < len(words) else (one, one)
            rises, falls = (rises << one) | plus, (falls << one) | minus
            ups[w][:m], downs[w][:m] = falls | ~(across | rises), rises & across
            plus, minus = rises_on, falls_on
    found = n.copy()
    own_n = x.n[i[order]]
    for w in range(len(words)):
        bits = np.clip(own_n - w * width, 0, width).astype(np.uint64)
        mask = np.where(bits == 64, ~np.uint64(0), (np.uint64(1) << np.minimum(bits, np.uint64(63))) - np.uint64(1)).astype(kind)
        found += np.bitwise_count(ups[w] & mask).astype(np.int64) - np.bitwise_count(downs[w] & mask)
    out = np.empty(len(order), np.int64)
    out[order] = found
    return out


def near(a: list[str], b: list[str], most: int, best: np.ndarray | None = None) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Places in a and in b, and the distance, of all pairs that are `most` slips apart at most.

    With `best`, a number for each text of a, which is lowered to the distance of its nearest text: only pairs as near as that.
    """
    if not a or not b:
        return
    x, y = _Texts(a), _Texts(b)
    letters = _coded(x, y)
    bits_x, bits_y = _bits(x, y)
    own_x, own_y = np.bitwise_count(bits_x), np.bitwise_count(bits_y)
    step = max(1, min(AT_ONCE, ENTRIES // letters))
    for low in range(0, len(a), step):
        high = min(low + step, len(a))
        reach = most if best is None else min(most, int(best[x.order[low:high]].max()))
        first, end = np.searchsorted(y.n, x.n[low] - reach, "left"), np.searchsorted(y.n, x.n[high - 1] + reach, "right")
        if first >= end:
            continue
        table = _table(x, low, high, letters)
        common = np.bitwise_count(bits_x[low:high, None] & bits_y[None, first:end])

        def measured(mask: np.ndarray, low: int = low, first: int = first, table: tuple = table) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
            at, width = np.flatnonzero(mask), mask.shape[1]
            for k in range(0, len(at), PAIRS):
                i, j = np.divmod(at[k : k + PAIRS], width)
                yield i + low, j + first, _distances(x, y, low, table, letters, i + low, j + first)

        if best is None:
            needed = lambda own: np.maximum(own.astype(np.int64) - most, 0).astype(np.uint8)
            for i, j, d in measured(common >= np.maximum(needed(own_x[low:high])[:, None], needed(own_y[first:end])[None])):
                close = d <= most
                yield x.order[i[close]], y.order[j[close]], d[close]
            continue
        # What two texts lack of each other is their distance at least, and so is the difference of their lengths.
        least = np.maximum(np.maximum(own_x[low:high, None], own_y[None, first:end]) - common, np.minimum(np.abs(x.n[low:high, None] - y.n[None, first:end]), np.iinfo(np.int32).max).astype(np.int32))
        bound, found = np.minimum(best[x.order[low:high]], most), []
        for slips in range(reach + 1):
            asked = bound >= slips
            if not asked.any():
                break
            for i, j, d in measured((least == slips) & asked[:, None]):
                np.minimum.at(bound, i - low, d)
                close = d <= bound[i - low]
                found.append((i[close], j[close], d[close]))
        for i, j, d in found:
            close = d == bound[i - low]
            yield x.order[i[close]], y.order[j[close]], d[close]
        best[x.order[low:high]] = np.minimum(best[x.order[low:high]], bound)

"""Dynamic programming over batches of sequence pairs in numpy.

A batch is a pair of padded byte matrices. Edit matrices are filled by anti-diagonals: all
cells of one depend on the two before it only, so a step handles one anti-diagonal of every
pair at once, and the steps number the sum of the two lengths, not their product.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np

#: Cells (pairs times the longer length) that one call holds at once, about.
CELLS = 1 << 22
_FAR = 1 << 20


def padded(texts: Sequence[str], fill: int) -> tuple[np.ndarray, np.ndarray]:
    """Texts as rows of a byte matrix, ``fill`` behind their ends, and their lengths."""
    raw = [t.encode("latin-1", "replace") for t in texts]
    lengths = np.array([len(r) for r in raw], dtype=np.int64)
    out = np.full((len(raw), int(lengths.max(initial=0))), fill, dtype=np.uint8)
    out[np.arange(out.shape[1]) < lengths[:, None]] = np.frombuffer(b"".join(raw), dtype=np.uint8)
    return out, lengths


def in_lots(first: Sequence, *others: Sequence, work: Callable) -> list:
    """``work`` over lots of pairs of like lengths, results in the order of the pairs."""
    order = np.argsort([len(x) for x in first], kind="stable")
    out: list = [None] * len(first)
    i = 0
    while i < len(order):
        size = max(1, CELLS // (len(first[order[min(len(order) - 1, i + 4095)]]) + len(others[0][order[i]]) + 1) // 16)
        lot = order[i : i + min(size, 4096)]
        for k, x in zip(lot, work([first[k] for k in lot], *[[o[k] for k in lot] for o in others]), strict=True):
            out[k] = x
        i += len(lot)
    return out


#: A cell holds its cost, a mark of the way that led to it, and the start of its stretch.
_COST, _WAY = 1 << 34, 1 << 32


def _sweep(a: np.ndarray, b: np.ndarray, free: bool, swaps: bool = False, widest: bool = False):
    """Yields ``(d, cells)`` of each anti-diagonal: cell ``(d - j, j)`` in column ``j``, as a
    multiple of ``_COST`` plus where in ``a`` its stretch starts. ``free``: ``b`` may begin
    anywhere in ``a`` (the first column costs nothing). Of ways that cost the same that over
    the diagonal counts, then that with a base of ``a`` more, or with ``widest`` that of the
    longest stretch."""
    up, left_way = (0, 0) if widest else (_WAY, 2 * _WAY)
    size, n = a.shape
    m = b.shape[1]
    before: dict[int, np.ndarray] = {}
    for d in range(n + m + 1):
        cells = np.full((size, m + 1), _FAR * _COST, dtype=np.int64)
        if d <= n:
            cells[:, 0] = d if free else d * _COST
        if d <= m:
            cells[:, d] = d * _COST
        lo, hi = max(1, d - n), min(m, d - 1)
        if lo <= hi:
            s, t = slice(lo, hi + 1), slice(lo - 1, hi)
            # a[d - j - 1] for rising j.
            left, right = a[:, d - hi - 1 : d - lo][:, ::-1], b[:, lo - 1 : hi]
            old = before[d - 1]
            best = np.where(left == right, before[d - 2][:, t], before[d - 2][:, t] + _COST)
            np.minimum(best, old[:, s] + (_COST + up), out=best)
            np.minimum(best, old[:, t] + (_COST + left_way), out=best)
            if swaps and hi >= 2 and d - lo >= 2:
                q = np.arange(max(lo, 2), min(hi, d - 2) + 1)
                if len(q):
                    crossed = (a[:, d - q - 1] == b[:, q - 2]) & (a[:, d - q - 2] == b[:, q - 1])
                    at = slice(q[0] - lo, q[-1] - lo + 1)
                    best[:, at] = np.where(crossed, np.minimum(best[:, at], before[d - 4][:, q[0] - 2 : q[-1] - 1] + _COST), best[:, at])
            best &= ~np.int64(3 * _WAY)
            cells[:, s] = best
        yield d, cells
        before[d] = cells
        before.pop(d - (4 if swaps else 2), None)


def osa(first: Sequence[str], second: Sequence[str]) -> list[int]:
    """Edit distances in which swapping two neighbours counts once."""

    def work(x: list[str], y: list[str]) -> list[int]:
        (a, n), (b, m) = padded(x, 1), padded(y, 2)
        out = np.zeros(len(x), dtype=np.int64)
        for d, cells in _sweep(a, b, free=False, swaps=True):
            now = n + m == d
            out[now] = cells[now, m[now]] // _COST
        return out.tolist()

    return in_lots(first, second, work=work)


def edits_inside(longer: Sequence[str], shorter: Sequence[str]) -> list[tuple[int, int, int]]:
    """For each pair the least edits with which the whole shorter sequence lies in a stretch
    of the longer one, with that stretch (start, end): the widest such, then the first."""

    def work(x: list[str], y: list[str]) -> list[tuple[int, int, int]]:
        (a, n), (b, m) = padded(x, 1), padded(y, 2)
        best = np.full(len(x), _FAR, dtype=np.int64)
        start, end = np.zeros(len(x), dtype=np.int64), np.zeros(len(x), dtype=np.int64)
        for d, cells in _sweep(a, b, free=True, widest=True):
            rows = np.flatnonzero((d - m >= 0) & (d - m <= n))
            got, e = cells[rows, m[rows]], (d - m)[rows]
            c, s = got // _COST, got % _WAY
            better = (c < best[rows]) | ((c == best[rows]) & (e - s > end[rows] - start[rows]))
            rows = rows[better]
            best[rows], start[rows], end[rows] = c[better], s[better], e[better]
        return list(zip(best.tolist(), start.tolist(), end.tolist(), strict=True))

    return in_lots(longer, shorter, work=work)


def trim_at(seqs: Sequence[str], adapters: Sequence[str], error: float, min_overlap: int = 3) -> list[int]:
    """Bases of each sequence before the first place where its adapter, or the adapter's
    start at the end of the read, fits with ``error`` edits per base at most (substitutions,
    insertions, deletions); all bases without one. Among overlapping places the best fit
    counts."""

    def work(x: list[str], y: list[str]) -> list[int]:
        (a, n), (b, m) = padded(x, 1), padded(y, 2)
        rows = np.arange(len(x))
        found = np.full(len(x), -1, dtype=np.int64)
        least = np.full(len(x), _FAR, dtype=np.int64)
        tail_cost = np.full((len(x), b.shape[1] + 1), _FAR, dtype=np.int64)
        tail_start = np.zeros_like(tail_cost)
        for d, cells in _sweep(a, b, free=True):
            i = d - m
            live = (i >= 1) & (i <= n)
            c, s = cells[rows, m] // _COST, cells[rows, m] % _WAY
            fits = live & (c <= error * m) & ((found < 0) | ((c < least) & (s <= found + m)))
            found[fits], least[fits] = s[fits], c[fits]
            j = d - n
            r = np.flatnonzero((j >= 0) & (j <= m))
            tail_cost[r, j[r]], tail_start[r, j[r]] = cells[r, j[r]] // _COST, cells[r, j[r]] % _WAY
        j = np.arange(b.shape[1] + 1)
        partial = (j < m[:, None]) & (j >= min_overlap) & (tail_cost <= error * j)
        longest = np.where(partial, j, -1).max(axis=1, initial=-1)
        tail = np.where(longest >= 0, tail_start[rows, np.maximum(longest, 0)], n)
        return np.where(found >= 0, found, tail).tolist()

    return in_lots(seqs, adapters, work=work)


def joined(first: Sequence[str], second: Sequence[str], min_overlap: int, max_mismatch: float, scored: bool = False) -> list[str | None]:
    """Each read merged with the reverse complement of its mate over their best ungapped
    overlap (fewest mismatches for its length, then the longest); None without one. With
    ``scored`` the best one, among those of few enough mismatches, has most matches less
    mismatches: a long overlap with an error goes before a few bases that agree by chance."""

    def work(x: list[str], y: list[str]) -> list[str | None]:
        (a, n), (b, m) = padded([t[::-1] for t in x], 1), padded(y, 2)
        best = np.full(len(x), np.inf)
        overlap = np.zeros(len(x), dtype=np.int64)
        for k in range(int(np.minimum(n, m).max(initial=0)), min_overlap - 1, -1):
            # Shorter ones score k at most, and have no less than no mismatch.
            rows = np.flatnonzero((n >= k) & (m >= k) & (best > (-k if scored else 0)))
            if len(rows):
                wrong = (a[rows, :k][:, ::-1] != b[rows, :k]).sum(axis=1)
                share = wrong / max(k, 1)
                cost = 2.0 * wrong - k if scored else share
                better = (share <= max_mismatch) & (cost < best[rows])
                best[rows[better]], overlap[rows[better]] = cost[better], k
        return [p + q[k:] if np.isfinite(s) else None for p, q, s, k in zip(x, y, best, overlap, strict=True)]

    return in_lots(first, second, work=work)


def marks(first: Sequence[str], second: Sequence[str]) -> list[str]:
    """Global alignments (match 1, mismatch and gap -1) as one mark for each base of the
    first sequence: * where it meets an equal base, - elsewhere."""

    def work(x: list[str], y: list[str]) -> list[str]:
        (a, n), (b, m) = padded(x, 1), padded(y, 2)
        size, rows = len(x), np.arange(len(x))
        score = np.zeros((size, a.shape[1] + 1, b.shape[1] + 1), dtype=np.int16)
        score[:, :, 0] = -np.arange(a.shape[1] + 1)
        score[:, 0, :] = -np.arange(b.shape[1] + 1)
        for d in range(2, a.shape[1] + b.shape[1] + 1):
            j = np.arange(max(1, d - a.shape[1]), min(b.shape[1], d - 1) + 1)
            i = d - j
            gain = np.where(a[:, i - 1] == b[:, j - 1], 1, -1)
            score[:, i, j] = np.maximum(np.maximum(score[:, i - 1, j - 1] + gain, score[:, i - 1, j] - 1), score[:, i, j - 1] - 1)
        out = np.full(a.shape, ord("-"), dtype=np.uint8)
        i, j = n.copy(), m.copy()
        while (i > 0).any():
            up, left = np.maximum(i - 1, 0), np.maximum(j - 1, 0)
            now = score[rows, i, j]
            equal = a[rows, up] == b[rows, left] if b.shape[1] else np.zeros(size, dtype=bool)
            across = (i > 0) & (j > 0) & (now == score[rows, up, left] + np.where(equal, 1, -1))
            above = (i > 0) & ~across & (now == score[rows, up, j] - 1)
            hit = rows[across & equal]
            out[hit, up[hit]] = ord("*")
            back = (i > 0) & ~across & ~above
            i, j = i - (across | above), j - (across | back)
        return [bytes(r[:k]).decode("latin-1") for r, k in zip(out, n, strict=True)]

    return in_lots(first, second, work=work)


def segments(queries: Sequence[str], targets: Sequence[str], offsets: Sequence[int], penalty: int = 3, gap: int = 4) -> list[tuple[int, int, int, int, int, int]]:
    """For each query laid on a target so that ``q[i]`` meets ``t[i + offset]``: the stretch of
    the highest score (1 for a match, ``-penalty`` for none), on that diagonal or on it and
    a neighbouring one, joined over one insert of one base at a cost of ``gap``.

    -> ``(start, end, matches, insert, target start, target end)``: ``insert`` is 1 where the
    target has a base more, -1 where the query has, 0 without; of joins that score alike
    that with the insert farthest left counts."""

    def work(x: list[str], y: list[str], z: list[int]) -> list[tuple[int, int, int, int, int, int]]:
        (a, n), (b, m) = padded(x, 1), padded(y, 2)
        size, width = a.shape
        rows, at = np.arange(size), np.arange(width)
        offset = np.array(z, dtype=np.int64)
        same, total = {}, {}
        for k in (-1, 0, 1):
            spot = at + offset[:, None] + k
            inside = (spot >= 0) & (spot < m[:, None]) & (at < n[:, None])
            same[k] = inside & (a == b[rows[:, None], np.clip(spot, 0, max(b.shape[1] - 1, 0))]) if b.shape[1] else np.zeros((size, width), dtype=bool)
            step = np.where(same[k], 1, np.where(inside, -penalty, -_FAR))
            total[k] = np.concatenate([np.zeros((size, 1), dtype=np.int64), np.cumsum(step, axis=1)], axis=1)
        best = np.zeros(size, dtype=np.int64)
        out = np.zeros((size, 6), dtype=np.int64)

        def count(k: int, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
            c = np.concatenate([np.zeros((size, 1), dtype=np.int64), np.cumsum(same[k], axis=1)], axis=1)
            return c[rows, hi] - c[rows, lo]

        def first_low(k: int, stop: np.ndarray) -> np.ndarray:
            """Where the stretch that ends at ``stop`` begins."""
            seen = np.where(np.arange(width + 1) <= stop[:, None], total[k], np.iinfo(np.int64).max)
            return np.argmin(seen, axis=1)

        rise = {k: total[k] - np.minimum.accumulate(total[k], axis=1) for k in total}
        fall = {k: np.maximum.accumulate(total[k][:, ::-1], axis=1)[:, ::-1] - total[k] for k in total}
        end = np.argmax(rise[0], axis=1)
        start = first_low(0, end)
        best = rise[0][rows, end]
        out[:] = np.stack([start, end, count(0, start, end), np.zeros(size, np.int64), start + offset, end + offset], axis=1)
        # Two diagonals: from p up to s, then from r on; the target's more when r > p.
        for p, r in ((0, 1), (-1, 0), (0, -1), (1, 0)):
            skip = 1 if r < p else 0
            joint = rise[p][:, : width + 1 - skip] + fall[r][:, skip:] - gap
            # Both parts must hold bases.
            joint = np.where((rise[p][:, : width + 1 - skip] > 0) & (fall[r][:, skip:] > 0), joint, -1)
            if not joint.shape[1]:
                continue
            s = np.argmax(joint, axis=1)
            score = joint[rows, s]
            better = score > best
            if not better.any():
                continue
            begin = first_low(p, s)
            after = s + skip
            later = np.where(np.arange(width + 1) >= after[:, None], total[r], np.iinfo(np.int64).min)
            stop = np.argmax(later, axis=1)
            new = np.stack([begin, stop, count(p, begin, s) + count(r, after, stop), np.full(size, r - p, np.int64), begin + offset + p, stop + offset + r], axis=1)
            out[better], best[better] = new[better], score[better]
        return [tuple(r) for r in out.tolist()]

    return in_lots(queries, targets, offsets, work=work) if len(queries) else []

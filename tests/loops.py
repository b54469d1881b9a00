"""Plain loops over one pair at a time, which the batch functions must equal."""

from __future__ import annotations

import numpy as np


def osa(a: str, b: str) -> int:
    """Edit distance in which swapping two neighbours counts once."""
    before, row = [], list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            d = min(row[j] + 1, new[j - 1] + 1, row[j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                d = min(d, before[j - 2] + 1)
            new.append(d)
        before, row = row, new
    return row[-1]


def trim_at(seq: str, adapter: str, error: float, min_overlap: int = 3) -> int:
    """Bases of ``seq`` before the first place where ``adapter``, or its start at the end of
    the read, fits with ``error`` edits per base at most (edits: substitution, insertion,
    deletion); all bases without one. Of places that end alike the best fit counts."""
    n, m = len(seq), len(adapter)
    # cost[j], start[j]: the cheapest way to lay adapter[:j] so that it ends at this base.
    cost, start = list(range(m + 1)), [0] * (m + 1)
    best: tuple[float, int, int] | None = None
    for i in range(1, n + 1):
        before, before_start = cost[0], start[0]
        cost[0], start[0] = 0, i
        for j in range(1, m + 1):
            old, old_start = cost[j], start[j]
            c, s = before + (seq[i - 1] != adapter[j - 1]), before_start
            if old + 1 < c:
                c, s = old + 1, old_start
            if cost[j - 1] + 1 < c:
                c, s = cost[j - 1] + 1, start[j - 1]
            cost[j], start[j] = c, s
            before, before_start = old, old_start
        if cost[m] <= error * m and (best is None or (cost[m] < best[1] and start[m] <= best[2] + m)):
            best = (0, cost[m], start[m])
    if best is not None:
        return best[2]
    for j in range(m - 1, min_overlap - 1, -1):
        if cost[j] <= error * j:
            return start[j]
    return n


def join_pair(first: str, second: str, min_overlap: int, max_mismatch: float) -> str | None:
    """Merges a read with the reverse complement of its mate over their best ungapped
    overlap (fewest mismatches for its length, then the longest); None without one."""
    best = None
    for k in range(min(len(first), len(second)), min_overlap - 1, -1):
        bad = sum(x != y for x, y in zip(first[-k:], second[:k], strict=True))
        if bad <= max_mismatch * k and (best is None or bad / k < best[0]):
            best = (bad / k, k)
            if not bad:
                break
    return first + second[best[1] :] if best else None


def align_marks(a: str, b: str) -> str:
    """Global alignment of two sequences (match 1, mismatch and gap -1) as one mark for
    each base of ``a``: * where it is matched by an equal base, - elsewhere."""
    n, m = len(a), len(b)
    s = [[-j for j in range(m + 1)]]
    for i in range(1, n + 1):
        row = [-i]
        for j in range(1, m + 1):
            row.append(max(s[i - 1][j - 1] + (1 if a[i - 1] == b[j - 1] else -1), s[i - 1][j] - 1, row[j - 1] - 1))
        s.append(row)
    marks, i, j = [], n, m
    while i:
        if j and s[i][j] == s[i - 1][j - 1] + (1 if a[i - 1] == b[j - 1] else -1):
            marks.append("*" if a[i - 1] == b[j - 1] else "-")
            i, j = i - 1, j - 1
        elif s[i][j] == s[i - 1][j] - 1:
            marks.append("-")
            i -= 1
        else:
            j -= 1
    return "".join(reversed(marks))


def best_segment(q: str, t: str, offset: int, penalty: int = 3) -> tuple[int, int, int]:
    """On the diagonal where q[i] meets t[i + offset]: start and end of the stretch of the
    highest score (1 for a match, ``-penalty`` for none), and its matches."""
    a, b = max(0, -offset), min(len(q), len(t) - offset)
    if a >= b:
        return 0, 0, 0
    same = np.frombuffer(q[a:b].encode(), np.uint8) == np.frombuffer(t[a + offset : b + offset].encode(), np.uint8)
    total = np.concatenate([[0], np.cumsum(np.where(same, 1, -penalty))])
    low = np.minimum.accumulate(total)
    end = int(np.argmax(total - low))
    start = int(np.argmin(total[: end + 1]))
    return a + start, a + end, int(same[start:end].sum())


def levenshtein(a: str, b: str) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def inside(longer: str, shorter: str) -> tuple[int, int]:
    """Least edits of the whole shorter sequence in the longer one, and the widest stretch."""
    rows = [(0, i) for i in range(len(longer) + 1)]
    for j, y in enumerate(shorter, 1):
        new = [(j, 0)]
        for i, x in enumerate(longer, 1):
            new.append(min((rows[i - 1][0] + (x != y), rows[i - 1][1]), (rows[i][0] + 1, rows[i][1]), (new[-1][0] + 1, new[-1][1])))
        rows = new
    least = min(c for c, _ in rows)
    return least, max(i - s for i, (c, s) in enumerate(rows) if c == least)

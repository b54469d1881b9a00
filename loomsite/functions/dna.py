"""Column functions on DNA sequences, positions and identifiers.

All of them are built-in expressions; what needs Python is in ``functions.vectorized``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def reverse_complement(seq: Column | str) -> Column:
    return F.reverse(F.translate(_c(seq), "ACGTNacgtn", "TGCANtgcan"))


def mask_repeats(seq: Column | str) -> Column:
    """Lower-case bases, which mark masked repeats, become N."""
    return F.translate(_c(seq), "acgt", "NNNN")


def range_of(seq: Column | str, start: Column | int, end: Column | int) -> Column:
    """Bases ``start`` to ``end``, from 1, both included; what lies outside is left out."""
    s = F.greatest(start if isinstance(start, Column) else F.lit(start), F.lit(1))
    e = end if isinstance(end, Column) else F.lit(end)
    return F.substring(_c(seq), s, F.greatest(e - s + 1, F.lit(0)))


def overlay_a(seq: Column | str, start: int, length: int) -> Column:
    """Writes a run of A over a range, as over the molecular tag of a read."""
    return F.overlay(_c(seq), F.lit("A" * length), F.lit(start), F.lit(length))


def mismatches(a: Column | str, b: Column | str) -> Column:
    """Hamming distance of two sequences of equal length; N of ``b`` matches any base.
    Null if the lengths differ."""
    x, y = F.split(_c(a), ""), F.split(_c(b), "")
    pairs = F.zip_with(x, y, lambda p, q: F.when((p == q) | (q == "N"), 0).otherwise(1))
    return F.when(F.length(_c(a)) == F.length(_c(b)), F.aggregate(pairs, F.lit(0), lambda s, d: s + d))


def match_count(seq: Column | str, pattern: Column | str, max_mismatches: int, start: int = 1, end: Column | int | None = None) -> Column:
    """Number of places of ``seq[start..end]`` where ``pattern`` fits without gaps and
    with ``max_mismatches`` at most."""
    window = range_of(seq, start, end if end is not None else F.length(_c(seq)))
    n = F.length(_c(pattern))
    last = F.length(window) - n
    starts = F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))
    return F.size(F.filter(starts, lambda i: mismatches(F.substr(window, i + 1, n), _c(pattern)) <= max_mismatches))


def linker_ranges(linker: Column | str) -> tuple[Column, Column, Column]:
    """(end of the barcode, start and end of the molecular tag): the tag is the first run
    of N of the linker and the barcode is what stands before it; 0 and null without N."""
    first = F.instr(_c(linker), "N")
    run = F.length(F.regexp_extract(_c(linker), "N+", 0))
    has = first > 0
    return F.when(has, first - 1).otherwise(F.lit(0)), F.when(has, first), F.when(has, first + run - 1)


def trim_sequence(seq: Column | str, tail: int = 15) -> Column:
    """What a read into the other side ends with: the reverse complement of the last bases."""
    return reverse_complement(F.right(_c(seq), F.lit(tail)))


def linker_tail(linker: Column | str) -> Column:
    """What follows the run of N of a linker."""
    return F.regexp_extract(_c(linker), "N+([^N]*)$", 1)


def position_of(strand: Column | str, start: Column | str, end: Column | str) -> Column:
    """The integration position of a fragment: its start on +, its end on -."""
    return F.when(_c(strand) == "+", _c(start)).otherwise(_c(end))


def break_of(strand: Column | str, start: Column | str, end: Column | str) -> Column:
    """The other end of a fragment."""
    return F.when(_c(strand) == "+", _c(end)).otherwise(_c(start))


def posid(chromosome: Column | str, strand: Column | str, position: Column | str, group: Column | str | None = None) -> Column:
    """``chr+123`` or, with a leader group, ``chr+123.2``."""
    base = F.concat(_c(chromosome), _c(strand), _c(position).cast("string"))
    return base if group is None else F.concat(base, F.lit("."), _c(group).cast("string"))


_POSID = r"^(.*)([+-])(\d+)(?:\.(\d+))?$"


def parse_posid(value: Column | str) -> dict[str, Column]:
    """The parts of a position id: chromosome (which may hold dots), strand, position,
    and group or null."""
    v = _c(value)
    return {
        "chromosome": F.regexp_extract(v, _POSID, 1),
        "strand": F.regexp_extract(v, _POSID, 2),
        "position": F.regexp_extract(v, _POSID, 3).cast("int"),
        "group": F.try_to_number(F.nullif(F.regexp_extract(v, _POSID, 4), F.lit("")), F.lit("999999999")).cast("int"),
    }


def without_group(value: Column | str) -> Column:
    return F.regexp_replace(_c(value), r"\.\d+$", "")


def sample_parts(unique_sample: Column | str) -> dict[str, Column]:
    """``trial~subject~sample~replicate`` as typed columns."""
    parts = F.split(_c(unique_sample), "~")
    return {"trial": parts[0], "subject": parts[1], "sample": parts[2], "replicate": parts[3].cast("int")}


def without_replicate(unique_sample: Column | str) -> Column:
    return F.regexp_replace(_c(unique_sample), r"~\d+$", "")


def unite(*parts: Column | str, by: str = "~") -> Column:
    return F.concat_ws(by, *[_c(p).cast("string") for p in parts])


def base_name(path: Column | str) -> Column:
    return F.element_at(F.split(_c(path), "/"), -1)


def quality_cut(qual: Column | str, code: str = "+", half_width: int = 3, events: int = 2) -> Column:
    """Bases to keep of a read: all before the first window of ``2 * half_width + 1``
    qualities around a base, of which ``events`` at least are at or below ``code``."""
    q = _c(qual)
    parts = F.split(q, rf"[\x00-\x{ord(code):02x}]", -1)

    def upto(p: Column, first: Column | int, size: Column | int) -> Column:
        """Bases from the start of one part to the bad base after the last of ``size`` parts."""
        return F.length(F.array_join(F.slice(p, first, size), ".")) + 1

    def first_window(p: Column) -> Column:
        # Bad bases number one less than the parts; a window holds events whose ends are
        # 2 * half_width apart at most, and begins half_width before the last of them.
        last = F.size(p) - events
        places = F.when(last >= 1, F.sequence(F.lit(1), last)).otherwise(F.array().cast("array<int>"))
        hits = F.filter(places, lambda j: upto(p, j + 1, events - 1) <= 2 * half_width)
        return F.when(F.size(hits) > 0, F.greatest(upto(p, 1, F.get(hits, F.lit(0)) + events - 1) - half_width - 1, F.lit(0)))

    # The parts are bound once: an expression in a function of an array is worked out anew for each item.
    return F.coalesce(F.transform(F.array(parts), first_window)[0], F.length(q))


def integrase_shift(strand: Column | str, position: Column | str, by: int) -> Column:
    """The position moved ``by`` bases downstream of its strand."""
    return F.when(_c(strand) == "+", _c(position) + by).otherwise(_c(position) - by)


def oriented_strand(strand: Column | str, flags: Column | str) -> Column:
    """The strand of the vector: turned for u3 ends, as it is for u5 ends."""
    return F.when(F.contains(_c(flags), F.lit("IN_u3")), F.translate(_c(strand), "+-", "-+")).otherwise(_c(strand))


def aligned_length(start: Column | str, end: Column | str) -> Column:
    return F.abs(_c(end) - _c(start)) + 1


def hit_strand(subject_start: Column | str, subject_end: Column | str) -> Column:
    """A hit whose subject runs backwards is on the minus strand."""
    return F.when(_c(subject_start) <= _c(subject_end), "+").otherwise("-")


def wallace_temperature(matched: Column | str) -> Column:
    """Melting temperature of the matched bases: 2 for A and T, 4 for G and C."""
    at = F.regexp_count(_c(matched), F.lit("[AT]"))
    gc = F.regexp_count(_c(matched), F.lit("[GC]"))
    return 2 * at + 4 * gc


def match_report(marks: Column | str, half: int) -> Column:
    """``<n>nt | <m>`` of a match string of * and -: matches in all and in its right half."""
    m = _c(marks)
    return F.concat(F.regexp_count(m, F.lit(r"\*")).cast("string"), F.lit("nt | "), F.regexp_count(F.right(m, F.lit(half)), F.lit(r"\*")).cast("string"))


def expand(start: Column | str, end: Column | str, by: int) -> tuple[Column, Column]:
    """A range widened by ``by`` bases at both ends, from 1 on."""
    return F.greatest(_c(start) - by, F.lit(1)), _c(end) + by


def percent_text(share: Column | str) -> Column:
    """A percentage as text with two decimals."""
    return F.concat(F.format_string("%.2f", _c(share)), F.lit("%"))


def thousands(n: Column | str) -> Column:
    """A count as text with a comma before every third digit."""
    return F.format_number(_c(n), 0)

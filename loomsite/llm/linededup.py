"""Line dedup by a deletion-neighbourhood join, with DataFrame functions only.

Two lines are near-equal if one edit of a character at most (insertion, deletion,
substitution) turns one into the other. Such lines have equal deletion variants: the
line itself or the line without one character. Emitting all variants of all lines would
cost the square of a line's length, so a lossless filter comes first: one edit leaves
the first or the last half of a line as it is, so that only lines which share a hashed
half with another distinct line can have a near-equal one. Their variants are emitted as
hashed keys, equal keys are joined, and the edit distance is verified.

A line that repeats, exactly or nearly, a line that starts earlier (by document, then
line number) is removed; lines are judged on the input, so the earliest of each stays.
Distinct lines are known by a 128-bit hash; line texts travel only for candidates.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomsite.llm.common import materialize, table

#: Characters of a block of a line's hash.
BLOCK = 256
#: Line coordinates up to which they are broadcast to pick line texts.
BROADCAST_ROWS = 100_000


def _hash(seed: int, *columns: Column) -> Column:
    return F.xxhash64(F.lit(seed), *columns)


def _halves(line: Column) -> Column:
    """Hashed halves: a line of n characters has near-equal partners of n - 1 to n + 1;
    the longer of a pair, of m characters, fixes the half's length, m / 2 rounded down."""
    n = F.char_length(line)

    def of(half: Column) -> list[Column]:
        return [_hash(1, half, F.substring(line, F.lit(1), half)), _hash(2, half, F.right(line, half))]

    low, high = F.floor(n / 2).cast("int"), F.floor((n + 1) / 2).cast("int")
    return F.when(low == high, F.array(*of(low))).otherwise(F.array(*of(low), *of(high)))


def _folded(parts: Column) -> Column:
    return F.aggregate(parts, F.lit(0).cast("long"), lambda a, x: a.bitwiseXOR(x))


def _let(value: Column, f) -> Column:
    """``f(value)`` with the value worked out once, however often ``f`` reads it."""
    return F.element_at(F.transform(F.array(value), f), 1)


def _without(j: Column, s: Column, most: Column) -> Column:
    """Hashes of block ``j`` without each of the first ``most`` characters of ``s``."""
    return F.transform(F.sequence(F.lit(1), most), lambda i: _hash(3, j, F.concat(F.left(s, i - 1), F.substr(s, i + 1))))


def _variants(line: Column) -> Column:
    """Hashes of the line and of the line without each one of its characters.

    A string's hash is the XOR of the hashes of its ``BLOCK``-character blocks with their
    numbers. Without character i, the blocks before i are the line's own and those after it
    are the line's blocks moved by one, so that each variant hashes one block only and a
    line's cost is nearly in proportion to its length."""
    n = F.char_length(line)
    count = F.floor((n + (BLOCK - 1)) / BLOCK).cast("int")
    short = F.concat(F.array(_hash(3, F.lit(0), line)), _without(F.lit(0), line, n))
    # Each block with the character that follows it, if there is one.
    wide = F.transform(F.sequence(F.lit(0), count - 1), lambda j: F.substring(line, j * BLOCK + 1, F.lit(BLOCK + 1)))

    def around(own: Column, moved: Column, j: Column) -> Column:
        return _folded(F.slice(own, 1, j)).bitwiseXOR(_folded(F.slice(moved, j + 2, F.size(own))))

    def long(w: Column) -> Column:
        # An empty last block adds nothing, as a string that ends before it has none.
        none = F.lit(0).cast("long")
        own = F.transform(w, lambda s, j: _hash(3, j, F.left(s, F.lit(BLOCK))))
        moved = F.transform(w, lambda s, j: F.when(F.char_length(s) == 1, none).otherwise(_hash(3, j, F.substr(s, F.lit(2)))))

        def cut(s: Column, j: Column) -> Column:
            return F.when(F.char_length(s) == 1, F.array(none)).otherwise(_without(j, s, F.least(F.char_length(s), F.lit(BLOCK))))

        return _let(F.struct(own.alias("o"), moved.alias("m")), lambda h: F.concat(F.array(_folded(h["o"])), F.flatten(F.transform(w, lambda s, j: _let(
            around(h["o"], h["m"], j), lambda rest: F.transform(cut(s, j), lambda x: x.bitwiseXOR(rest)))))))

    return F.array_distinct(F.when(count == 1, short).otherwise(_let(wide, long)))


def _lines(docs: DataFrame, id_column: str, text_column: str, min_chars: int) -> DataFrame:
    rows = docs.where(F.col(id_column).isNotNull()).select(F.col(id_column).cast("long").alias("doc"), F.posexplode(F.split(F.col(text_column).cast("string"), "\n", -1)).alias("at", "line"))
    return rows.where((F.char_length("line") >= min_chars) & (F.trim(F.translate("line", "\t\r", "")) != ""))


def repeated_lines(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", min_chars: int = 1) -> DataFrame:
    """-> ``(doc long, at int)``: the line numbers, from 0, of the lines to remove."""
    lines = _lines(docs, id_column, text_column, min_chars)
    seen = materialize(lines.select("doc", "at", _hash(0, F.col("line")).alias("h1"), _hash(9, F.col("line")).alias("h2"), _halves(F.col("line")).alias("halves")), "lines-seen")
    distinct = seen.groupBy("h1", "h2").agg(F.min(F.struct("doc", "at")).alias("first"), F.count(F.lit(1)).alias("n"), F.first("halves").alias("halves"))
    distinct = materialize(distinct, "lines")

    half = distinct.select("h1", "h2", "first", F.explode("halves").alias("half"))
    shared = half.groupBy("half").agg(F.count(F.lit(1)).alias("k")).where("k > 1").select("half")
    near = half.join(shared, "half", "left_semi").select(F.col("first.doc").alias("doc"), F.col("first.at").alias("at"), "h1", "h2").distinct()
    near = materialize(near, "lines-near")
    picked = F.broadcast(near) if near.count() <= BROADCAST_ROWS else near
    text = materialize(lines.join(picked, ["doc", "at"]).select("h1", "h2", F.struct("doc", "at").alias("first"), "line").dropDuplicates(["h1", "h2"]), "lines-text")

    # All variants are written once: counting keys and picking their lines read them again.
    keys = materialize(text.select("h1", "h2", "first", F.explode(_variants(F.col("line"))).alias("key")), "lines-variants")
    key = keys.groupBy("key").agg(F.count(F.lit(1)).alias("k")).where("k > 1").select("key")
    keys = materialize(keys.join(key, "key", "left_semi"), "lines-keys")
    a = keys.select("key", F.col("h1").alias("a1"), F.col("h2").alias("a2"), F.col("first").alias("af"))
    b = keys.select("key", F.col("h1").alias("b1"), F.col("h2").alias("b2"), F.col("first").alias("bf"))
    pairs = a.join(b, "key").where(F.col("bf") < F.col("af")).select("a1", "a2", "b1", "b2", "bf").distinct()
    pairs = pairs.join(text.select(F.col("h1").alias("a1"), F.col("h2").alias("a2"), F.col("line").alias("x")), ["a1", "a2"])
    pairs = pairs.join(text.select(F.col("h1").alias("b1"), F.col("h2").alias("b2"), F.col("line").alias("y")), ["b1", "b2"])
    pairs = pairs.where(F.levenshtein("x", "y", 1).between(0, 1))
    late = pairs.select(F.col("a1").alias("h1"), F.col("a2").alias("h2"), F.lit(True).alias("late")).distinct()

    # Of a distinct line with an earlier near-equal one every occurrence goes, else all
    # but the first; lines that are neither repeated nor late go no further.
    touched = distinct.join(late, ["h1", "h2"], "left").where("n > 1 or late").select("h1", "h2", "first", F.coalesce("late", F.lit(False)).alias("late"))
    touched = materialize(touched, "lines-touched")
    where = seen.select("doc", "at", "h1", "h2").join(touched, ["h1", "h2"])
    return where.where(F.col("late") | (F.struct("doc", "at") > F.col("first"))).select("doc", "at")


def dedup_lines(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", min_chars: int = 1, counts: tuple[str, str] = ("n_lines", "n_removed_lines")) -> DataFrame:
    """``docs`` with the lines of its texts that repeat an earlier line removed, and the
    columns that ``counts`` names, its lines and those removed (int), after its own.

    Lines end at ``\\n``. Defined cases: lines of fewer than ``min_chars`` characters and
    blank lines (spaces, tabs and ``\\r`` only) stay; a null text stays null with 0 lines; a text whose every line goes
    becomes empty; a row with a null id keeps its lines; rows that repeat an id share
    the removals found for it, and of equal lines with one coordinate none is earlier;
    all columns are kept, whatever their names; where one has a name of ``counts``, give
    others.
    """
    gone = repeated_lines(docs, id_column, text_column, min_chars)
    gone = gone.groupBy("doc").agg(F.sort_array(F.collect_set("at")).alias("at")).select(F.col("doc").alias("__line_doc"), F.col("at").alias("__line_at"))
    own = F.struct(*[docs[c].alias(c) for c in docs.columns])
    joined = docs.select(own.alias("__row"), docs[id_column].cast("long").alias("__id")).join(gone, F.col("__id") == F.col("__line_doc"), "left")
    text = F.col("__row")[text_column].cast("string")
    parts = F.split(text, "\n", -1)
    n = F.when(text.isNull(), 0).otherwise(F.size(parts))
    touched = F.col("__line_at").isNotNull() & text.isNotNull()
    # Spark counts the lines that stay once and joins those.
    stays = F.when(touched, F.array_except(F.sequence(F.lit(0), n - 1), F.col("__line_at")))
    left = F.array_join(F.transform(stays, lambda i: F.get(parts, i)), "\n")
    new = F.when(touched, left).otherwise(text)
    removed = F.when(touched, n - F.size(stays)).otherwise(0)
    kept = [new.alias(c) if c == text_column else F.col("__row")[c].alias(c) for c in docs.columns]
    return joined.select(*kept, n.alias(counts[0]), removed.alias(counts[1]))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_lines", "n_removed_lines", F.sha2(F.encode(F.coalesce("text", F.lit("")), "UTF-8"), 256).alias("kept_sha256"))


OP5_SQL = r"""
WITH l AS (
  SELECT doc_id, ln, ls[ln + 1] AS line
  FROM (SELECT doc_id, ls, unnest(range(0, len(ls))) AS ln FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents WHERE text IS NOT NULL))
), d AS (
  SELECT line, min((doc_id, ln)) AS first FROM l WHERE trim(translate(line, chr(9) || chr(13), '')) <> '' GROUP BY line
), h AS (
  SELECT line, first, unnest([
    (0, length(line) // 2, left(line, length(line) // 2)), (1, length(line) // 2, right(line, length(line) // 2)),
    (0, (length(line) + 1) // 2, left(line, (length(line) + 1) // 2)), (1, (length(line) + 1) // 2, right(line, (length(line) + 1) // 2))]) AS half
  FROM d
), late AS (
  SELECT DISTINCT a.line FROM h a JOIN h b ON a.half = b.half AND b.first < a.first
  WHERE CASE length(a.line) - length(b.line)
    WHEN 0 THEN len([i FOR i IN range(1, length(a.line) + 1) IF a.line[i] <> b.line[i]]) <= 1
    WHEN 1 THEN list_contains([left(a.line, i) || substr(a.line, i + 2) FOR i IN range(0, length(a.line))], b.line)
    WHEN -1 THEN list_contains([left(b.line, i) || substr(b.line, i + 2) FOR i IN range(0, length(b.line))], a.line) ELSE false END
), kept AS (
  SELECT l.doc_id, l.ln, l.line FROM l LEFT JOIN d ON d.line = l.line LEFT JOIN late ON late.line = l.line
  WHERE d.line IS NULL OR (late.line IS NULL AND d.first = (l.doc_id, l.ln))
), t AS (
  SELECT doc_id, count(*) AS n, string_agg(line, chr(10) ORDER BY ln) AS kept FROM kept GROUP BY doc_id
)
SELECT x.doc_id, CAST(CASE WHEN text IS NULL THEN 0 ELSE len(string_split(text, chr(10))) END AS INTEGER) AS n_lines,
  CAST(CASE WHEN text IS NULL THEN 0 ELSE len(string_split(text, chr(10))) - coalesce(n, 0) END AS INTEGER) AS n_removed_lines,
  sha256(coalesce(kept, '')) AS kept_sha256
FROM documents x LEFT JOIN t USING (doc_id)
"""

QUERIES = {"op5_line_dedup": op5_line_dedup}
ORACLES = {"op5_line_dedup": OP5_SQL}

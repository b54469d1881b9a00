"""Hard negatives by exact integer scores in a residue number system.

Vectors are integers; a score is an inner product. Each component is reduced modulo a few
primes to a balanced residue of one byte; the residues' matrices are multiplied in float32,
where every partial sum stays below 2^24 and so is exact, and the signed scores are put
together from their residues by the Chinese remainder theorem with balanced digits. The
number of primes follows from the largest norm of the table (no score is larger).

Rows are dealt to cells of bounded bytes by a hash of their id, within their label for the
search of positives and over all labels for that of negatives. Anchors, the stated query
set, go to each cell that they are compared with and stream past its rows, tile by tile;
a cell gives the best few rows of each anchor, and the cells' rows are ranked by a window.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomsite.llm.common import materialize, table

#: Moduli, of which as many are used as the scores need.
PRIMES = (251, 241, 239, 233, 229, 227, 223, 211)
#: Components whose products of balanced residues stay exact in a float32 sum.
EXACT = (1 << 24) // 125**2
#: Components of the vectors of a cell; rows of a tile; anchors compared with it at once.
CELL, TILE, ASKS = 1 << 24, 4096, 128
_NONE = np.iinfo(np.int64).min


def primes_for(bound: int) -> tuple[int, ...]:
    """As many primes as scores up to ``bound`` need, with a factor of two to spare."""
    product = 1
    for n, p in enumerate(PRIMES, 1):
        product *= p
        if product > 4 * bound:
            return PRIMES[:n]
    raise ValueError("scores go beyond 60 bits")


def residues(v: np.ndarray, primes: tuple[int, ...]) -> list[np.ndarray]:
    """The balanced residues of integers for each prime, in one byte each."""
    out = []
    for p in primes:
        r = np.remainder(v, p)
        out.append(np.where(r > p // 2, r - p, r).astype(np.int8))
    return out


def _balanced(x: np.ndarray, p: int) -> np.ndarray:
    x = np.remainder(x, p)
    return np.where(x > p // 2, x - p, x)


def product(a: list[np.ndarray], b: list[np.ndarray], primes: tuple[int, ...]) -> np.ndarray:
    """The exact inner products of all rows of two tables of residues, as 64-bit integers."""
    total: np.ndarray | None = None
    weight = 1
    for p, x, y in zip(primes, a, b, strict=True):
        part = np.zeros((len(x), len(y)), dtype=np.int64)
        for k in range(0, x.shape[1], EXACT):
            part += (x[:, k : k + EXACT].astype(np.float32) @ y[:, k : k + EXACT].astype(np.float32).T).astype(np.int64)
        if total is None:
            total = _balanced(part, p)
        else:
            # The next digit: what is missing to the residue, over the weight so far.
            total = total + weight * _balanced((_balanced(part, p) - np.remainder(total, p)) * pow(weight, -1, p), p)
        weight *= p
    return total


class _Best:
    """The ``top`` best (score, then smaller id) columns of each row of a growing matrix;
    ids come in rising order."""

    def __init__(self, rows: int, top: int):
        self.top = top
        self.row, self.id, self.score = (np.zeros(0, np.int64) for _ in range(3))
        self.least = np.full(rows, _NONE, dtype=np.int64)

    def take(self, scores: np.ndarray, ids: np.ndarray) -> None:
        """``scores`` of rows by columns, the smallest integer where a column is no choice."""
        if scores.shape[1] > self.top:
            bound = np.partition(scores, scores.shape[1] - self.top, axis=1)[:, -self.top]
        else:
            bound = np.full(len(scores), _NONE, dtype=np.int64)
        # A later id loses a tie against those that are held already.
        r, c = np.nonzero((scores >= bound[:, None]) & (scores > self.least[:, None]))
        if not len(r):
            return
        row, id_, score = np.concatenate([self.row, r]), np.concatenate([self.id, ids[c]]), np.concatenate([self.score, scores[r, c]])
        order = np.lexsort((id_, -score, row))
        row, id_, score = row[order], id_[order], score[order]
        place = np.arange(len(row)) - np.searchsorted(row, row)
        keep = place < self.top
        full = place == self.top - 1
        self.least[row[full]] = score[full]
        self.row, self.id, self.score = row[keep], id_[keep], score[keep]


_FOUND = "anchor long, positive long, positive_score long, id long, score long"


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    v = batch.column("v").flatten().to_numpy(zero_copy_only=False)
    return v.reshape(batch.num_rows, -1)


def _scan(keys: int, primes: tuple[int, ...], top: int, low: int, high: int):
    """Streams sorted rows ``(*keys, kind, id, label, v, wanted)``: a cell's rows first (kind
    0), then its anchors. Anchors without ``wanted`` look for rows, those with it for rows
    of other labels within the windows of their positives."""

    def choose(corpus: dict, ask: pa.RecordBatch) -> pa.RecordBatch | None:
        ids, x = np.asarray(ask.column("id")), residues(_matrix(ask), primes)
        wanted = ask.column("wanted").to_pylist()
        depth = max((len(w or ()) for w in wanted), default=0)
        lows = np.full((len(ids), depth), np.iinfo(np.int64).max)
        highs = np.full((len(ids), depth), _NONE)
        for i, w in enumerate(wanted):
            for k, p in enumerate(w or ()):
                # The smallest and largest integers in the window.
                lows[i, k], highs[i, k] = -(-low * p["score"] // 100), high * p["score"] // 100
        codes = corpus["codes"]
        label = np.array([codes.get(y, -1) for y in ask.column("label").to_pylist()])
        best = [_Best(len(ids), top) for _ in range(depth or 1)]
        for at in range(0, len(corpus["ids"]), TILE):
            part = slice(at, at + TILE)
            scores = product(x, [r[part] for r in corpus["residues"]], primes)
            own = corpus["ids"][part]
            if not depth:
                best[0].take(np.where(own[None, :] != ids[:, None], scores, _NONE), own)
                continue
            other = corpus["label"][part][None, :] != label[:, None]
            for k in range(depth):
                fits = other & (scores >= lows[:, k, None]) & (scores <= highs[:, k, None])
                if fits.any():
                    best[k].take(np.where(fits, scores, _NONE), own)
        columns = []
        for k, b in enumerate(best):
            got = b.score > _NONE
            row = b.row[got]
            known = [wanted[i][k] if depth else {"id": None, "score": None} for i in row]
            columns.append([ids[row].tolist(), [p["id"] for p in known], [p["score"] for p in known], b.id[got].tolist(), b.score[got].tolist()])
        merged = [sum(c, []) for c in zip(*columns, strict=True)]
        if not merged[0]:
            return None
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in merged], names=["anchor", "positive", "positive_score", "id", "score"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, corpus, parts = None, None, []
        for batch in batches:
            marks = list(zip(*(batch.column(i).to_pylist() for i in range(keys + 1)), strict=True))
            at = 0
            while at < len(marks):
                end = at + 1
                while end < len(marks) and marks[end] == marks[at] and end - at < ASKS * (1 if marks[at][-1] else 64):
                    end += 1
                cell, kind, part = marks[at][:-1], marks[at][-1], batch.slice(at, end - at)
                at = end
                if cell != now:
                    now, corpus, parts = cell, None, []
                if not kind:
                    parts.append((np.asarray(part.column("id")), part.column("label").to_pylist(), residues(_matrix(part), primes)))
                    continue
                if corpus is None and parts:
                    codes: dict = {}
                    label = np.array([codes.setdefault(y, len(codes)) for p in parts for y in p[1]])
                    corpus = {"ids": np.concatenate([p[0] for p in parts]), "codes": codes, "label": label, "residues": [np.concatenate(r) for r in zip(*(p[2] for p in parts), strict=True)]}
                    parts = []
                if corpus is not None and (out := choose(corpus, part)) is not None:
                    yield out

    return run


def _in_cells(rows: DataFrame, by: list[str]) -> DataFrame:
    """How many cells each ``by``, one of whose columns is ``dim``, is dealt to."""
    return rows.groupBy(*by).agg(F.ceil(F.count(F.lit(1)) * F.first("dim") / CELL).cast("int").alias("cells"))


def _best(rows: DataFrame, asks: DataFrame, by: list[str], primes: tuple[int, ...], top: int, low: int, high: int) -> DataFrame:
    cells = _in_cells(rows, by)
    shape = [*by, "cell", "kind", "id", "label", "v", "wanted"]
    empty = F.lit(None).cast("array<struct<score:bigint,id:bigint>>")
    dealt = rows.join(cells, by).withColumn("cell", F.pmod(F.xxhash64("id"), F.col("cells")).cast("int"))
    dealt = dealt.select(*by, "cell", F.lit(0).alias("kind"), "id", "label", "v", empty.alias("wanted"))
    sent = asks.join(cells, by).withColumn("cell", F.explode(F.sequence(F.lit(0), F.col("cells") - 1)))
    sent = sent.select(*by, "cell", F.lit(1).alias("kind"), "id", "label", "v", "wanted")
    both = dealt.unionByName(sent).repartition(*by, "cell").sortWithinPartitions(*by, "cell", "kind", "id")
    return both.select(*shape).mapInArrow(_scan(len(by) + 1, primes, top, low, high), _FOUND)


def mine(df: DataFrame, anchors: Column, positives: int = 5, negatives: int = 5, low: int = 80, high: int = 100, scale: int = 256, id_column: str = "vec_id", vector_column: str = "embedding", label_column: str = "label") -> DataFrame:
    """-> ``(anchor_id, positive_id long, rank int, negative_id, positive_score, negative_score
    long)``: for each anchor (rows for which ``anchors`` holds) and each of its best
    ``positives`` rows of its label, the best ``negatives`` rows of other labels whose score
    is ``low`` to ``high`` percent of the positive's.

    Vectors are scaled and rounded down to integers; a score is the exact inner product
    with the anchor. Higher scores come first, ties by the smaller id.
    Defined cases: rows with a null id, label or vector, or a null or non-finite
    component, take no part; rows of one id count once (the smallest label, then vector);
    vectors of different lengths are not compared, empty ones with nothing; a negative
    positive's window is empty; an empty table gives none; other columns are dropped.
    Scores beyond 60 bits are refused.
    """
    v = F.col(vector_column).cast("array<double>")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    valid = F.col(id_column).isNotNull() & F.col(label_column).isNotNull() & v.isNotNull() & (F.size(v) > 0) & fine
    rows = df.where(F.coalesce(valid, F.lit(False))).select(F.col(id_column).cast("long").alias("id"), F.col(label_column).alias("label"), F.transform(v, lambda x: F.floor(x * scale)).alias("v"), F.coalesce(anchors, F.lit(False)).alias("ask"), F.aggregate(v, F.lit(0.0), lambda s, x: s + (F.abs(x) * scale + 1) * (F.abs(x) * scale + 1)).alias("norm"))
    rows = rows.groupBy("id").agg(F.min(F.struct("label", "v", "ask", "norm")).alias("x")).select("id", "x.*")
    # ``of`` is the label as a key of cells.
    rows = materialize(rows.select("id", F.col("label").cast("string").alias("label"), "v", "ask", "norm", F.size("v").alias("dim"), F.col("label").cast("string").alias("of")), "negatives-rows")
    largest = rows.agg(F.max("norm")).first()[0]
    if largest is not None and not largest < 2.0**60:
        raise ValueError("scores go beyond 60 bits")
    primes = primes_for(int(largest or 0) + 1)
    asks = rows.where("ask").select("id", "label", "dim", "of", "v")
    empty = F.lit(None).cast("array<struct<score:bigint,id:bigint>>")
    near = _best(rows, asks.withColumn("wanted", empty), ["dim", "of"], primes, positives, low, high)
    order = Window.partitionBy("anchor").orderBy(F.desc("score"), "id")
    near = near.withColumn("n", F.row_number().over(order)).where(F.col("n") <= positives)
    near = near.groupBy(F.col("anchor").alias("id")).agg(F.array_sort(F.collect_list(F.struct("n", "score", "id"))).alias("w"))
    near = near.select("id", F.transform("w", lambda x: F.struct(x["score"].alias("score"), x["id"].alias("id"))).alias("wanted"))
    found = _best(rows, asks.join(near, "id"), ["dim"], primes, negatives, low, high)
    order = Window.partitionBy("anchor", "positive").orderBy(F.desc("score"), "id")
    found = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives)
    return found.select(F.col("anchor").alias("anchor_id"), F.col("positive").alias("positive_id"), F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(rows.withColumn("label", moved), F.col("vec_id") % 100 == 0)


OP13_SQL = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0 AND len(embedding) > 0
), s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same,
    CAST(list_sum([x[1] * x[2] FOR x IN list_zip(a.e, b.e)]) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) WHERE a.vec_id % 100 = 0
), p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT p.anchor_id, positive_id,
  CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
  vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT same AND 80 * positive_score <= 100 * score AND score <= positive_score
QUALIFY row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id) <= 5
"""

QUERIES = {"op13_hard_negatives": op13_hard_negatives}
ORACLES = {"op13_hard_negatives": OP13_SQL}

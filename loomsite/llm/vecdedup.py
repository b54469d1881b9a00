"""Embedding near-dedup with random-hyperplane sign hashing.

Equal vectors of a label collapse to one with a multiplicity, by a 128-bit hash of their
components. Each distinct vector gets a code of sign bits in several tables; vectors that
share (label, table, code) are candidates, and their cosine is computed in double
precision from the components as they are given. The number of bits grows with the
logarithm of the largest label, which keeps buckets at ``BUCKET`` vectors on average; the
number of tables follows from the recall asked for at the limit itself. Large buckets
need few tables, and tables are what vectors are shuffled for.

A bucket is cut into blocks by a hash of the id, and each pair of blocks is a tile: a
large bucket is many tasks, and none of its pairs is left out. A tile works on matrices
and emits a count for each vector and a spanning forest of its links, never the pairs.
A pair that shares several buckets counts in the first table that joins it.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomsite.llm.common import connected_components, materialize, table

#: Vectors of a bucket on average, and of a block.
BUCKET, BLOCK = 1024, 2048
SEED = 20240607


def tables_needed(limit: float, bits: int, recall: float) -> int:
    """Tables for which two vectors at cosine ``limit`` meet with probability ``recall``."""
    agree = (1 - math.acos(min(1.0, limit)) / math.pi) ** bits
    return max(1, math.ceil(math.log(1 - recall) / math.log1p(-agree))) if agree < 1 else 1


def _unit(flat: np.ndarray, dim: int) -> np.ndarray:
    x = flat.reshape(-1, dim).astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _codes(bits: int, tables: int, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes: dict[int, np.ndarray] = {}
        for batch in batches:
            dims = np.asarray(batch.column(3).value_lengths())
            for dim in np.unique(dims):
                part = batch.filter(pa.array(dims == dim))
                if dim not in planes:
                    planes[dim] = np.random.default_rng([SEED, int(dim)]).standard_normal((int(dim), bits * tables))
                raw = part.column(3).flatten().to_numpy(zero_copy_only=False)
                unit = _unit(raw, int(dim))
                sign = (unit @ planes[dim] >= 0).reshape(len(unit), tables, bits)
                codes = (sign * (1 << np.arange(bits))).sum(axis=2).astype(np.int32)
                offsets = pa.array(np.arange(len(unit) + 1, dtype=np.int32) * tables, pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), part.column(2), pa.array([x.tobytes() for x in raw.reshape(len(unit), -1)], pa.binary()), pa.ListArray.from_arrays(offsets, pa.array(codes.reshape(-1)))],
                    names=names,
                )

    return run


def _forest(linked: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(id, smallest id of its component) of the nodes that a link matrix connects."""
    left = linked.any(axis=1)
    a, b = [], []
    while left.any():
        seen = np.zeros(len(ids), dtype=bool)
        new = np.zeros(len(ids), dtype=bool)
        new[np.flatnonzero(left)[0]] = True
        while new.any():
            seen |= new
            new = linked[new].any(axis=0) & ~seen
        left &= ~seen
        member = ids[seen]
        low = member.min()
        a.append(member[member != low])
        b.append(np.full(len(a[-1]), low))
    return np.concatenate(a), np.concatenate(b)


def _tile(rows: pa.Table, limit: float, kind: str):
    t = rows.column("t")[0].as_py()
    same = rows.column("i")[0].as_py() == rows.column("j")[0].as_py()
    ids = rows.column("rep").to_numpy()
    copies = rows.column("copies").to_numpy()
    block = rows.column("block").to_numpy()
    raw = np.frombuffer(b"".join(rows.column("vector").to_pylist()), dtype=kind)
    unit = _unit(raw, len(raw) // len(ids))
    codes = np.stack(rows.column("codes").combine_chunks().flatten().to_numpy().reshape(len(ids), -1)[:, : t + 1])
    linked = unit @ unit.T >= limit
    if not same:
        linked &= block[:, None] != block[None, :]
    np.fill_diagonal(linked, False)
    x, y = np.nonzero(np.triu(linked))
    if not len(x):
        return None
    if t:
        before = (codes[x, :t] == codes[y, :t]).any(axis=1)
        linked[x[before], y[before]] = linked[y[before], x[before]] = False
        if not linked.any():
            return None
    n = linked @ copies
    a, b = _forest(linked, ids)
    some = n > 0
    none = np.zeros(len(a), dtype=np.int64)
    return pa.RecordBatch.from_arrays(
        [pa.array(np.concatenate([ids[some], a])), pa.array(np.concatenate([ids[some], b])), pa.array(np.concatenate([n[some], none]))], names=["a", "b", "n"]
    )


def _tiles(limit: float, kind: str):
    key = ["label", "dim", "t", "code", "i", "j"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: pa.Table | None = None
        for batch in batches:
            now = pa.Table.from_batches([batch])
            now = pa.concat_tables([kept, now]) if kept is not None else now
            if not now.num_rows:
                continue
            change = np.zeros(now.num_rows, dtype=bool)
            for c in key:
                v = np.asarray(now.column(c))
                change[1:] |= v[1:] != v[:-1]
            begin = [0, *np.flatnonzero(change).tolist()]
            for i, j in zip(begin[:-1], begin[1:], strict=True):
                if j - i > 1 and (out := _tile(now.slice(i, j - i), limit, kind)):
                    yield out
            kept = now.slice(begin[-1])
        if kept is not None and kept.num_rows > 1 and (out := _tile(kept, limit, kind)):
            yield out

    return run


def near_vectors(df: DataFrame, limit: float = 0.93, recall: float = 0.9999, id_column: str = "vec_id", vector_column: str = "embedding", label_column: str = "label") -> DataFrame:
    """-> ``(<id_column>, n_links long, component_id long, kept boolean)`` for every row.

    Vectors link if their labels are equal and not null and their cosine is ``limit`` at
    least. ``n_links`` counts the other vectors linked directly, ``component_id`` is the
    smallest id reachable. Ids are integers, labels of any type that can be compared.
    Defined cases: vectors that are null, empty, zero or hold a null or non-finite
    component, and rows with a null id or label, link with nothing (n_links 0, a
    component of their own, kept); vectors of different lengths don't link; each row is
    a vector of its own, so a repeated row links with its copy and shares its id; other
    columns are dropped.
    """
    single = df.schema[vector_column].dataType.simpleString() == "array<float>"
    v = F.col("v")
    rows = df.select(F.col(id_column).cast("long").alias("id"), F.col(label_column).alias("label"), F.col(vector_column).cast(f"array<{'float' if single else 'double'}>").alias("v"))
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(math.inf)))
    valid = F.col("id").isNotNull() & F.col("label").isNotNull() & v.isNotNull() & finite & F.exists(v, lambda x: x != 0)
    rows = rows.withColumn("valid", F.coalesce(valid, F.lit(False)))
    largest = rows.where("valid").groupBy("label").count().agg(F.max("count")).first()[0] or 1
    bits = max(1, min(24, math.ceil(math.log2(max(2, largest / BUCKET)))))
    tables = tables_needed(limit, bits, recall)
    rows = rows.select("id", "label", "valid", "v", *[F.when(F.col("valid"), F.xxhash64(F.lit(seed), F.size("v"), "v")).alias(f"h{seed}") for seed in (1, 2)])
    one = ["label", "h1", "h2"]
    reps = rows.where("valid").groupBy(*one).agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("copies"), F.first("v").alias("v"))
    kept = materialize(reps, "vectors")
    names = ["rep", "label", "copies", "vector", "codes"]
    kinds = T.StructType([T.StructField("rep", T.LongType()), kept.schema["label"], T.StructField("copies", T.LongType()), T.StructField("vector", T.BinaryType()), T.StructField("codes", T.ArrayType(T.IntegerType()))])
    coded = materialize(kept.select("rep", "label", "copies", "v").mapInArrow(_codes(bits, tables, names), kinds), "vector-codes")
    slots = coded.select("rep", "label", F.octet_length("vector").alias("dim"), F.posexplode("codes").alias("t", "code"))
    bucket = ["label", "dim", "t", "code"]
    size = slots.groupBy(*bucket).agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    # Buckets are counted; with those counts each vector goes with its codes to its tiles.
    # There are fewer buckets than vectors, and each holds BUCKET vectors on average.
    placed = coded.select("*", F.octet_length("vector").alias("dim"), F.posexplode("codes").alias("t", "code")).join(size, bucket)
    placed = placed.withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    placed = placed.select(*bucket, "rep", "copies", "vector", "codes", "block", other.alias("o"))
    key = [*bucket, "i", "j"]
    tiles = placed.select(*bucket, F.least("block", "o").alias("i"), F.greatest("block", "o").alias("j"), "block", "rep", "copies", "vector", "codes")
    tiles = tiles.repartition(*key).sortWithinPartitions(*key)
    found = materialize(tiles.mapInArrow(_tiles(limit, "<f4" if single else "<f8"), "a long, b long, n long"), "vector-links")
    links = found.where("n > 0").groupBy(F.col("a").alias("rep")).agg(F.sum("n").alias("links"))
    component = connected_components(found.where("n = 0").select("a", "b")).withColumnRenamed("id", "rep")
    known = kept.select(*one, "rep", "copies").join(links, "rep", "left").join(component, "rep", "left")
    known = known.select(*one, (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("links"), F.coalesce("component", "rep").alias("component"))
    out = rows.select("id", "valid", *one).join(known, one, "left")
    n = F.when(F.col("valid"), F.col("links")).otherwise(F.lit(0)).cast("long")
    component = F.when(F.col("valid"), F.col("component")).otherwise(F.col("id"))
    return out.select(F.col("id").alias(id_column), n.alias("n_links"), component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"))


def op4_vector_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))


OP4_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
    AND len([x FOR x IN embedding IF x <> 0]) > 0
), link AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.93
), reach(id, root) AS (
  SELECT vec_id, vec_id FROM embeddings
  UNION
  SELECT link.b, reach.root FROM reach JOIN link ON link.a = reach.id WHERE reach.root < link.b
), n AS (SELECT a, count(*) AS n_links FROM link GROUP BY a)
SELECT r.id AS vec_id, coalesce(n_links, 0) AS n_links, min(root) AS component_id, r.id = min(root) AS kept
FROM reach r LEFT JOIN n ON n.a = r.id GROUP BY r.id, n_links
"""

QUERIES = {"op4_vector_dedup": op4_vector_dedup}
ORACLES = {"op4_vector_dedup": OP4_SQL}

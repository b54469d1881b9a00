"""N-gram Jaccard join: size-banded tiles, bitmap bounds, exact intersection.

A document's set is its distinct k-word shingles. Two sets link if their Jaccard
similarity reaches ``percent`` / 100. The join is exact on 64-bit shingle hashes:

1. Documents with equal sets collapse by a 128-bit digest and the size.
2. Sizes fall into bands, and linked sets differ in at most D shingles, where D follows
   from the larger one's band; a set enters every band that its links can lie in. Hashing deals the
   shingles of a set into m = D + 1 + E parts; at most D of them can differ, so linked
   sets agree in a whole part, and in a non-empty one unless both have more than E empty
   parts (then their empty parts count as well). A tile is (band, part, hash of the
   part): sets that share one are candidates. A part holds several shingles, so that a
   passage that many documents share makes no large tiles.
3. Within a tile each document is paired with the first; a hashed bitmap of parities
   of twice as many bits as shingles bounds the overlap from above: each shingle outside
   the intersection flips one bit, so the sets differ in at least as many shingles as
   their bitmaps differ in bits. What
   passes is settled by intersecting sorted arrays, and links give components.
4. Tiles in which several components are left pair their documents across components,
   again under the bound, each pair once: tiles with the same smallest document are taken
   together where that makes fewer pairs. So no link between components is lost, while a
   group of many near copies needs no pairs among its own.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loomsite.llm.common import connected_components, materialize, table
from loomsite.llm.hashing import BYTE_VALUE_LOWER, U64, list_array, mix64, shingle_hashes, steps, word_hashes, words

#: Ratio of the bounds of a size band.
BAND_RATIO = 1.25
#: Documents of a block of a group of tiles in which several components are left.
TILE_BLOCK = 256
#: Groups of tiles of a document up to which they travel with it.
GROUP_KEYS = 64
#: Ids of documents, 8 bytes each, up to which they are broadcast to pick texts.
BROADCAST_IDS = 200_000


def shingle_sets(data: np.ndarray, offsets: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The sorted distinct shingle hashes of each row, one row after the other, and how
    many each row has. Fewer than k words are one shingle; no words are none."""
    start, end, first = words(data, offsets)
    h = word_hashes(data, start, end, BYTE_VALUE_LOWER)
    count = np.diff(first)
    n_rows = len(count)
    row = np.repeat(np.arange(n_rows), count)
    s = shingle_hashes(h, k)
    inside = row[: len(s)] == row[len(h) - len(s) :] if len(s) else np.zeros(0, bool)
    tokens, rows = s[inside], row[: len(s)][inside]
    for c in range(1, k):
        few = np.flatnonzero(count == c)
        if len(few):
            tokens = np.concatenate([tokens, mix64(shingle_hashes(h, c)[first[few]] + U64(c))])
            rows = np.concatenate([rows, few])
    order = np.argsort(tokens, kind="stable")
    kind = np.uint16 if n_rows < 1 << 16 else np.int64
    order = order[np.argsort(rows[order].astype(kind), kind="stable")]
    tokens, rows = tokens[order], rows[order]
    new = np.ones(len(tokens), dtype=bool)
    new[1:] = (tokens[1:] != tokens[:-1]) | (rows[1:] != rows[:-1])
    return tokens[new], np.bincount(rows[new], minlength=n_rows)


def _bands(percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lower bounds of the bands, and for each band the parts and the empty parts that
    are allowed for; no parts where linked sets must be equal. The allowance is three
    deviations over what the smallest sets of a band leave empty, so that tiles of empty
    parts, which unlike sets share, are next to none."""
    low, parts, empty = [1], [], []
    while low[-1] < 1 << 40:
        after = int(low[-1] * BAND_RATIO) + 1
        most = 2 * (after - 1) * (100 - percent) // (100 + percent)
        slack = 2
        for _ in range(30):
            m = most + 1 + slack
            usual = m * math.exp(-max(1.0, low[-1] * percent / 100) / m)
            slack = math.ceil(usual + 3 * math.sqrt(usual)) + 2
        parts.append(most + 1 + slack if most else 0)
        empty.append(slack)
        low.append(after)
    return np.array(low), np.array(parts), np.array(empty)


def _sums(values: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    total = np.zeros(len(values) + 1, dtype=U64)
    np.cumsum(values, out=total[1:], dtype=U64)
    at = np.concatenate([[0], np.cumsum(lengths)])
    return total[at[1:]] - total[at[:-1]]


def _bitmap_bits(n: np.ndarray) -> np.ndarray:
    """Bits of each set's bitmap: a power of two from twice its size on, 64 at least."""
    return 1 << np.ceil(np.log2(np.maximum(2 * n, 64))).astype(np.int64)


def _sketches(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, data, offsets in steps(batch.column(1)):
                tokens, n = shingle_sets(data, offsets, k)
                size = _bitmap_bits(n)
                base = np.cumsum(size) - size
                row = np.repeat(np.arange(len(n)), n)
                place = (mix64(tokens ^ U64(0x5851F42D4C957F2D)) & (size[row] - 1).astype(U64)).astype(np.int64)
                hits = np.bincount(base[row] + place, minlength=int(size.sum()))
                maps = np.packbits((hits & 1).astype(np.uint8), bitorder="little").view("<i8")
                d1, d2 = (_sums(mix64(tokens * U64(c)), n).view(np.int64) for c in (0xA0761D6478BD642F, 0xE7037ED1A0B428DB))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i), pa.array(n.astype(np.int64)), pa.array(d1), pa.array(d2), list_array(pa.array(maps), size // 64)],
                    names=["doc", "n", "d1", "d2", "bits"],
                )

    return run


def _tile_rows(k: int, percent: int):
    low, parts, slack = _bands(percent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, data, offsets in steps(batch.column(1)):
                ids = batch.column(0).slice(i, j - i).to_numpy(zero_copy_only=False)
                tokens, n = shingle_sets(data, offsets, k)
                value = mix64(tokens ^ U64(0x2545F4914F6CDD1D))
                high = tokens >> U64(32)
                row = np.repeat(np.arange(len(n)), n)
                band = np.searchsorted(low, np.maximum(n, 1), side="right") - 1
                up = -1
                while True:
                    up += 1
                    b = band + up
                    own_band = (n > 0) & ((up == 0) | (n * 100 >= percent * low[b]))
                    if not own_band.any():
                        break
                    m = np.where(own_band, parts[b], 0)
                    use = m[row] > 0
                    if not use.any():
                        continue
                    base = np.cumsum(m) - m
                    own = row[use]
                    part = base[own] + ((high[use] * m[own].astype(U64)) >> U64(32)).astype(np.int64)
                    total = np.zeros(int(m.sum()), dtype=U64)
                    np.add.at(total, part, value[use])
                    filled = np.bincount(part, minlength=len(total)) > 0
                    owner = np.repeat(np.arange(len(n)), m)
                    number = np.arange(len(total)) - base[owner]
                    empties = np.bincount(owner[~filled], minlength=len(n))
                    emit = filled | (empties > slack[b])[owner]
                    tile = mix64(total + mix64((b[owner].astype(U64) << U64(40)) + number.astype(U64)))
                    yield pa.RecordBatch.from_arrays([pa.array(tile[emit].view(np.int64)), pa.array(ids[owner[emit]])], names=["tile", "doc"])

    return run


def _sets(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, data, offsets in steps(batch.column(1)):
                tokens, n = shingle_sets(data, offsets, k)
                bounds = np.zeros(len(n) + 1, dtype=np.int32)
                np.cumsum(n * 8, out=bounds[1:])
                sets = pa.BinaryArray.from_buffers(pa.binary(), len(n), [None, pa.py_buffer(bounds), pa.py_buffer(tokens.tobytes())])
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), sets], names=["doc", "tokens"])

    return run


def _intersect(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = batch.column(0), batch.column(1)
            linked = np.zeros(batch.num_rows, dtype=bool)
            for i, (x, y) in enumerate(zip(batch.column(2), batch.column(3), strict=True)):
                x, y = np.frombuffer(x.as_buffer(), U64), np.frombuffer(y.as_buffer(), U64)
                both = np.concatenate([x, y])
                both.sort()
                shared = int(np.count_nonzero(both[1:] == both[:-1]))
                linked[i] = 100 * shared >= percent * (len(x) + len(y) - shared)
            keep = pa.array(linked)
            yield pa.RecordBatch.from_arrays([a.filter(keep), b.filter(keep)], names=["a", "b"])

    return run


_HALF = "zip_with(slice({x}, 1, size({x}) div 2), slice({x}, size({x}) div 2 + 1, size({x}) div 2), (p, q) -> p ^ q)"


def _may_link(percent: int) -> Column:
    """Whether the sizes ``an, bn`` and the bitmaps ``abits, bbits`` allow a link. A bitmap
    of twice the other's length is folded: its halves' parities add up. Lengths further
    apart bound nothing."""
    a = F.expr(f"if(size(abits) > size(bbits), {_HALF.format(x='abits')}, abits)")
    b = F.expr(f"if(size(bbits) > size(abits), {_HALF.format(x='bbits')}, bbits)")
    counts = F.zip_with(a, b, lambda x, y: F.coalesce(F.bit_count(x.bitwiseXOR(y)), F.lit(0)))
    differ = F.aggregate(counts, F.lit(0), lambda s, x: s + x)
    return (F.least("an", "bn") * 100 >= F.greatest("an", "bn") * percent) & (differ * (100 + percent) <= (F.col("an") + F.col("bn")) * (100 - percent))


def _bounded(pairs: DataFrame, sketch: DataFrame, percent: int) -> DataFrame:
    """Pairs of distinct documents that pass the bound."""
    for side in ("a", "b"):
        own = sketch.select(F.col("doc").alias(side), F.col("n").alias(f"{side}n"), F.col("bits").alias(f"{side}bits"))
        pairs = pairs.join(own, side)
    return pairs.where(_may_link(percent)).select("a", "b").distinct()


def _verified(pairs: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """The pairs whose sets link, by exact intersection."""
    pairs = materialize(pairs, "jaccard-pairs")
    wanted = materialize(pairs.select(F.explode(F.array("a", "b")).alias("doc")).distinct(), "jaccard-ids")
    if wanted.count() <= BROADCAST_IDS:
        wanted = F.broadcast(wanted)
    sets = materialize(texts.join(wanted, "doc", "left_semi").select("doc", "text").mapInArrow(_sets(k), "doc long, tokens binary"), "jaccard-sets")
    both = pairs.join(sets.select(F.col("doc").alias("b"), F.col("tokens").alias("y")), "b").join(sets.select(F.col("doc").alias("a"), F.col("tokens").alias("x")), "a")
    return materialize(both.select("a", "b", "x", "y").mapInArrow(_intersect(percent), "a long, b long"), "jaccard-links")


def _divided(tiles: DataFrame, found: DataFrame) -> DataFrame:
    """-> ``(key, doc, component, keys, blocks)``: the documents of tiles ``(tile, doc, low)``
    in which several components are left, in groups that may hold several tiles.

    Near copies meet in most of their tiles. Tiles with the same smallest document are one
    group if its documents make no more pairs than the tiles do. ``keys`` are a document's
    groups, by which a pair that meets in several is taken in the first; null where there
    are more than ``GROUP_KEYS``, whose pairs are made distinct later."""
    left = tiles.join(found.withColumnRenamed("id", "doc"), "doc", "left").select("tile", "low", "doc", F.coalesce("component", "doc").alias("component"))
    mixed = left.groupBy("tile").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.count(F.lit(1)).alias("size")).where("lo < hi").select("tile", "size")
    members = materialize(left.join(mixed, "tile").distinct(), "jaccard-members")
    apart = members.groupBy("low").agg(F.sum("size").alias("pairs"))
    whole = members.select("low", "doc").distinct().groupBy("low").agg(F.count(F.lit(1)).alias("docs"))
    merged = apart.join(whole, "low").where(F.col("docs") * F.col("docs") <= F.col("pairs")).select("low", F.lit(True).alias("merge"))
    key = F.when(F.col("merge"), F.xxhash64("low")).otherwise(F.xxhash64("low", "tile"))
    groups = materialize(members.join(merged, "low", "left").select(key.alias("key"), "doc", "component").distinct(), "jaccard-groups")
    sizes = groups.groupBy("key").agg(F.ceil(F.count(F.lit(1)) / TILE_BLOCK).cast("int").alias("blocks"))
    keys = groups.groupBy("doc").agg(F.collect_list("key").alias("keys")).select("doc", F.when(F.size("keys") <= GROUP_KEYS, F.col("keys")).alias("keys"))
    return groups.join(sizes, "key").join(keys, "doc")


def jaccard_components(docs: DataFrame, k: int = 5, percent: int = 80, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """-> ``(<id_column>, n_shingles long, component_id long)`` for every row.

    Words are ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased; fewer than ``k`` words are
    one shingle; ``component_id`` is the smallest id reachable by links. Defined cases:
    null, empty and blank texts have no shingles and link with nothing; a row with a
    null id links with nothing and has a null component; rows that repeat an id count as
    one document that has each of their texts, and each gets a row; ids are integers;
    other columns are dropped.
    """
    texts = docs.select(F.col(id_column).cast("long").alias("doc"), F.col(text_column).cast("string").alias("text"))
    full = materialize(texts.mapInArrow(_sketches(k), "doc long, n long, d1 long, d2 long, bits array<long>"), "jaccard-sketch")
    some = full.where("doc is not null and n > 0")
    # Copies of one set stand for the smallest id among them. Only sets that several
    # documents have are joined back, and a set of very many copies is one row of these.
    equal = materialize(some.groupBy("d1", "d2", "n").agg(F.min("doc").alias("rep"), F.max("doc").alias("last")).where("rep < last").drop("last"), "jaccard-equal")
    if equal.count() <= BROADCAST_IDS:
        equal = F.broadcast(equal)
    copies = materialize(some.select("doc", "d1", "d2", "n").join(equal, ["d1", "d2", "n"]).where("doc <> rep").select("doc", "rep").distinct(), "jaccard-copies")
    # A repeated id may have a text of its own beside a copy: it stays, linked by hand.
    own = some.join(equal, ["d1", "d2", "n"], "left").where("rep is null or rep = doc").select("doc").distinct()
    both = copies.join(own, "doc", "left_semi")
    gone = materialize(copies.join(own, "doc", "left_anti").select("doc").distinct(), "jaccard-gone")
    if gone.count() <= BROADCAST_IDS:
        gone = F.broadcast(gone)
    sketch = some.join(gone, "doc", "left_anti").dropDuplicates(["doc", "d1", "d2"]).select("doc", "n", "bits")

    tiles = texts.where("doc is not null").join(gone, "doc", "left_anti").mapInArrow(_tile_rows(k, percent), "tile long, doc long")
    tile = Window.partitionBy("tile")
    tiles = tiles.withColumn("low", F.min("doc").over(tile)).withColumn("high", F.max("doc").over(tile)).where("low < high")
    tiles = materialize(tiles.select("tile", "doc", "low"), "jaccard-tiles")

    star = tiles.where("doc <> low").select(F.col("low").alias("a"), F.col("doc").alias("b")).distinct()
    links = _verified(_bounded(star, sketch, percent), texts, k, percent).unionByName(both.select(F.least("doc", "rep").alias("a"), F.greatest("doc", "rep").alias("b")))
    links = materialize(links, "jaccard-links")
    found = materialize(connected_components(links), "jaccard-components")

    mixed = _divided(tiles, found).join(sketch, "doc")
    # A large group is many tasks: each pair of blocks of its documents is one key.
    mixed = mixed.withColumn("block", F.pmod(F.xxhash64("doc"), F.col("blocks")).cast("int")).withColumn("o", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    mixed = materialize(mixed.select("key", "doc", "component", "keys", "n", "bits", F.least("block", "o").alias("i"), F.greatest("block", "o").alias("j"), "block"), "jaccard-mixed")
    a, b = (mixed.select("key", "i", "j", *[F.col(c).alias(f"{x}{t}") for c, t in (("block", "k"), ("doc", ""), ("component", "c"), ("keys", "keys"), ("n", "n"), ("bits", "bits"))]) for x in ("a", "b"))
    apart = (F.col("i") == F.col("j")) | (F.col("ak") != F.col("bk"))
    first = F.coalesce(F.array_min(F.array_intersect("akeys", "bkeys")) == F.col("key"), F.lit(True))
    across = a.join(b, ["key", "i", "j"]).where((F.col("a") < F.col("b")) & (F.col("ac") != F.col("bc")) & apart & _may_link(percent) & first).select("a", "b").distinct()
    more = _verified(across, texts, k, percent)
    if not more.isEmpty():
        found = materialize(connected_components(links.unionByName(more)), "jaccard-components")

    of = copies.join(found.withColumnRenamed("id", "rep"), "rep", "left").select("doc", F.coalesce("component", "rep").alias("component"))
    of = of.unionByName(found.select(F.col("id").alias("doc"), "component")).groupBy("doc").agg(F.min("component").alias("component"))
    return full.select("doc", "n").join(of, "doc", "left").select(
        F.col("doc").alias(id_column), F.col("n").alias("n_shingles"), F.coalesce("component", "doc").alias("component_id")
    )


def keep_one(docs: DataFrame, k: int = 5, percent: int = 80, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``docs`` without the documents that link, directly or through others, to one with
    a smaller id; columns and defined cases as in ``jaccard_components``."""
    found = jaccard_components(docs, k, percent, id_column, text_column)
    gone = found.where(F.col("component_id") < F.col(id_column)).select(F.col(id_column).alias("__gone")).distinct()
    return docs.join(gone, docs[id_column].cast("long") == gone["__gone"], "left_anti")


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"), k=4, percent=85)


OP7_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws
  FROM documents
), sh AS (
  SELECT DISTINCT doc_id, md5(array_to_string(ws[p : p + 3], ' ')) AS s
  FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 2, 2))) AS p FROM w WHERE len(ws) > 0)
), n AS (
  SELECT w.doc_id, count(s) AS n_shingles FROM w LEFT JOIN sh USING (doc_id) GROUP BY w.doc_id
), pair AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2
), link AS (
  SELECT a, b FROM pair JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
  WHERE 100 * shared >= 85 * (x.n_shingles + y.n_shingles - shared)
), reach(id, root) AS (
  SELECT doc_id, doc_id FROM n
  UNION
  SELECT link.b, reach.root FROM reach JOIN link ON link.a = reach.id WHERE reach.root < link.b
)
SELECT n.doc_id, n.n_shingles, min(root) AS component_id FROM n JOIN reach ON reach.id = n.doc_id GROUP BY 1, 2
"""

QUERIES = {"op7_jaccard_join": op7_jaccard_join}
ORACLES = {"op7_jaccard_join": OP7_SQL}

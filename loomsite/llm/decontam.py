"""Benchmark decontamination with SimHash windows, with DataFrame functions only.

A document leaks a benchmark item if one of its windows of the item's number of words is
similar to it: the weighted Jaccard similarity of their ``k``-word shingles, weighted by
how often each occurs, reaches ``percent`` / 100. Words are the lower-cased runs of
letters and digits.

1. Where windows are worth a fingerprint: a similar window has ``percent`` of its places in
   shingles of the benchmark, and its document holds ``percent`` of an item's shingles.
   Nothing similar is lost here, in whatever order the words stand.
2. Windows and items get 256-bit SimHash fingerprints of their weighted shingles, cut into
   ``BLOCKS`` blocks of 16 bits. Fingerprints within the radius differ in ``radius //
   BLOCKS`` bits at most in one block at least: each item's blocks are stored with all
   their neighbours that far, and windows look theirs up by (words, block number, block).
   That finds all fingerprints within the radius, of all items of the window's words.
3. Pairs within the radius are settled by the exact similarity.

At 80 % similarity 15 % of a fingerprint's bits differ, 39 of 256 with a deviation of 5.7;
the radius of 63 leaves out about one such pair in 75,000, and fewer the more similar
they are. ``exact`` adds those: it settles the pairs that step 1 leaves and step 2 missed.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomsite.llm.common import materialize, release_shuffles, table

#: Bits in which fingerprints may differ, and blocks of 16 bits of a fingerprint.
RADIUS, BLOCKS = 63, 16
#: Benchmark shingles, or ids of documents, up to which they are broadcast.
BROADCAST_ROWS = 200_000

#: 64 bits of a fingerprint of the hashes ``s``.
_SIMHASH = (
    "aggregate(transform(sequence(0, 63), b -> if(aggregate({s}, 0, (a, x) -> "
    "a + if((shiftrightunsigned(x, b) & 1L) = 1L, 1, -1)) > 0, shiftleft(1L, b), 0L)), 0L, (a, x) -> a | x)"
)


def _word_hashes(text: Column) -> Column:
    parts = F.split(F.lower(F.coalesce(text.cast("string"), F.lit(""))), r"[^\p{L}\p{N}]+")
    return F.transform(F.filter(parts, lambda w: w != ""), lambda w: F.xxhash64(w))


def _shingles(words: Column, k: int) -> Column:
    """Hashes of the k-word shingles of an array of word hashes; empty if it is shorter."""
    each = F.transform(F.sequence(F.lit(0), F.size(words) - k), lambda i: F.xxhash64(*[F.get(words, i + j) for j in range(k)]))
    return F.when(F.size(words) >= k, each).otherwise(F.array().cast("array<long>"))


def _places(words: Column, k: int) -> Column:
    return F.transform(_shingles(words, k), lambda s, i: F.struct(F.lit(k).alias("k"), i.alias("pos"), s.alias("s")))


def fingerprint(hashes: str) -> Column:
    """256 bits as four longs: each takes its bits from a hash of its own."""
    more = [hashes, *[f"transform({hashes}, x -> xxhash64(x, {i}))" for i in (1, 2, 3)]]
    return F.array(*[F.expr(_SIMHASH.format(s=s)) for s in more])


def differing_bits(f: Column, g: Column) -> Column:
    return F.aggregate(F.zip_with(f, g, lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda a, x: a + x)


def _blocks(prints: str) -> Column:
    """The blocks of a fingerprint as an array of (nr, part)."""
    return F.expr(f"transform(sequence(0, {BLOCKS - 1}), i -> struct(i AS nr, cast(shiftrightunsigned({prints}[i div 4], i % 4 * 16) & 65535L AS int) AS part))")


def block_masks(radius: int) -> list[int]:
    """All 16-bit words with ``radius`` bits at most."""
    return [sum(1 << b for b in bits) for n in range(radius + 1) for bits in combinations(range(16), n)]


def _small(df: DataFrame) -> DataFrame:
    """A materialized table, marked for broadcast if its row count allows that."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def _windows(hits: DataFrame, percent: int) -> DataFrame:
    """``hits (doc, n, k, pos)``, places of benchmark shingles in a document -> ``(doc, n, k,
    start, c)``: every start from which n words cover ``c`` such places, ``percent`` of an
    item's at least.

    A place counts for the starts from pos + k - n to pos. These ranges are summed as
    steps up and down, so that rows grow with the places and the windows kept only."""
    step = F.explode(F.array(F.struct((F.col("pos") + F.col("k") - F.col("n")).alias("at"), F.lit(1).alias("d")), F.struct((F.col("pos") + 1).alias("at"), F.lit(-1).alias("d"))))
    steps = hits.select("doc", "n", "k", step.alias("e")).groupBy("doc", "n", "k", F.col("e.at").alias("at")).agg(F.sum("e.d").alias("d"))
    by = Window.partitionBy("doc", "n", "k").orderBy("at")
    runs = steps.withColumn("c", F.sum("d").over(by)).withColumn("until", F.lead("at").over(by) - 1)
    # A window that an end of the document cuts has fewer places: half its item's or more.
    runs = runs.where(F.col("c") * 100 >= (F.col("n") - F.col("k") + 1) * percent)
    return runs.select("doc", "n", "k", "c", F.explode(F.sequence("at", "until")).alias("start"))


def _similar(pairs: DataFrame, percent: int) -> DataFrame:
    """``pairs (doc, item, start, n_words, wh, ih)`` whose similarity reaches the limit."""
    once = (F.size(F.array_distinct("wh")) == F.size("wh")) | (F.size(F.array_distinct("ih")) == F.size("ih"))
    key = ["doc", "item", "start", "n_words"]
    sets = pairs.where(once).select(*key, (F.size("wh") + F.size("ih")).alias("both"), F.size(F.array_intersect("wh", "ih")).cast("long").alias("shared"))
    # Where both repeat shingles, these are counted as rows.
    bags = pairs.where(~once).select(*key, (F.size("wh") + F.size("ih")).alias("both"), F.explode(F.concat(F.transform("wh", lambda s: F.struct(s.alias("s"), F.lit(1).alias("w"))), F.transform("ih", lambda s: F.struct(s.alias("s"), F.lit(0).alias("w"))))).alias("e"))
    bags = bags.groupBy(*key, "both", "e.s").agg(F.least(F.sum("e.w"), F.sum(1 - F.col("e.w"))).alias("m")).groupBy(*key, "both").agg(F.sum("m").alias("shared"))
    union = F.col("both") - F.col("shared")
    return sets.unionByName(bags).where(F.col("shared") * 100 >= union * percent).select(*key, (F.col("shared") / union).alias("similarity"))


def leaks(docs: DataFrame, benchmark: DataFrame, k: int = 5, percent: int = 80, radius: int = RADIUS, exact: bool = False, id_column: str = "doc_id", text_column: str = "text", item_column: str = "item_id", item_text: str = "text") -> DataFrame:
    """-> ``(<id_column>, <item_column>, start int, n_words int, similarity double)``: one
    row for each document and item that it leaks, with the most similar window (ties:
    the first): its first word from 0 and its words.

    Defined cases: items and documents that are null or have no words match nothing; an
    item of fewer than ``k`` words has its whole sequence as its one shingle; a window
    that would begin before a document or end after it is cut; rows that repeat an id or
    an item give one result; rows with a null id are left out; an empty benchmark or
    table gives no rows; other columns are dropped.
    """
    spark = docs.sparkSession
    release_shuffles(spark)
    items = benchmark.select(F.col(item_column).alias("item"), _word_hashes(F.col(item_text)).alias("w")).where("item is not null and size(w) > 0")
    items = items.withColumn("k", F.least(F.size("w"), F.lit(k)))
    grams = F.coalesce(*[F.when(F.col("k") == j, _shingles(F.col("w"), j)) for j in range(1, k + 1)])
    items = materialize(items.select("item", F.size("w").alias("n"), "k", grams.alias("ih")).distinct(), "bench-items")
    lengths = sorted(r["k"] for r in items.select("k").distinct().collect())  # k values at most
    if not lengths:
        kinds = [docs.schema[id_column], benchmark.schema[item_column], T.StructField("start", T.IntegerType()), T.StructField("n_words", T.IntegerType()), T.StructField("similarity", T.DoubleType())]
        return spark.createDataFrame([], T.StructType(kinds))

    # One pass over the texts for all k: places of benchmark shingles.
    known = docs.where(F.col(id_column).isNotNull()).select(F.col(id_column).alias("doc"), F.col(text_column).alias("text"))
    words = known.select("doc", _word_hashes(F.col("text")).alias("w"))
    of_items = materialize(items.select("item", "k", F.explode("ih").alias("s")).groupBy("item", "k", "s").agg(F.count(F.lit(1)).alias("c")), "bench-grams")
    wanted = _small(materialize(of_items.select("k", "s").distinct(), "bench-shingles"))
    places = F.concat(*[_places(F.col("w"), j) for j in lengths])
    hits = words.select("doc", F.explode(places).alias("e")).select("doc", "e.k", "e.pos", "e.s").join(wanted, ["k", "s"], "left_semi")
    hits = materialize(hits, "bench-hits")

    held = hits.select("doc", "k", "s").distinct().join(of_items, ["k", "s"]).groupBy("doc", "item").agg(F.sum("c").alias("held"))
    share = held.join(items, "item").where(F.col("held") * 100 >= F.size("ih") * percent).select("doc", "item", "n", "k").distinct()
    share = materialize(share, "bench-share")
    windows = materialize(_windows(hits.select("doc", "k", "pos").distinct().join(share.select("doc", "n", "k").distinct(), ["doc", "k"]), percent), "bench-windows")

    some = _small(materialize(windows.select("doc").distinct(), "bench-docs"))
    held = known.join(some, "doc", "left_semi").select("doc", _word_hashes(F.col("text")).alias("w")).join(windows, "doc")
    begin, end = F.greatest("start", F.lit(0)), F.least(F.col("start") + F.col("n"), F.size("w"))
    # At most c shingles are shared, of the item's n - k + 1 and of what the cut window has.
    union = (F.col("n") - F.col("k") + 1) + (end - begin - F.col("k") + 1) - F.col("c")
    held = held.where(F.col("c") * 100 >= union * percent)
    held = held.select("doc", "n", "k", begin.alias("start"), (end - begin).alias("n_words"), F.slice("w", begin + 1, end - begin).alias("w"))
    grams = F.coalesce(*[F.when(F.col("k") == j, _shingles(F.col("w"), j)) for j in lengths])
    held = materialize(held.select("doc", "n", "start", "n_words", grams.alias("wh")).distinct().withColumn("f", fingerprint("wh")), "bench-prints")

    prints = materialize(items.withColumn("g", fingerprint("ih")), "bench-item-prints")
    # An item's neighbours are many rows of few bytes: they are dealt, never broadcast.
    near_blocks = F.explode(F.array(*[F.lit(m) for m in block_masks(radius // BLOCKS)]))
    right = prints.select("item", "n", F.explode(_blocks("g")).alias("b")).select("item", "n", "b.nr", "b.part", near_blocks.alias("m"))
    right = right.select("item", "n", "nr", F.col("part").bitwiseXOR(F.col("m")).alias("part"))
    at = ["doc", "n", "start", "n_words"]
    left = held.select(*at, F.explode(_blocks("f")).alias("b")).select(*at, "b.nr", "b.part")
    near = left.join(right.hint("shuffle_hash"), ["n", "nr", "part"]).select(*at, "item").distinct()
    near = near.join(held.select(*at, "f"), at).join(prints.select("item", "n", "g"), ["item", "n"]).where(differing_bits(F.col("f"), F.col("g")) <= radius)
    near = near.select(*at, "item")
    if exact:
        near = near.unionByName(held.join(share.select("doc", "n", "item"), ["doc", "n"]).select(*at, "item")).distinct()
    near = near.join(held.select(*at, "wh"), at).join(items.select("item", "n", "ih"), ["item", "n"])
    good = _similar(near, percent)
    best = good.groupBy("doc", "item").agg(F.max(F.struct("similarity", (-F.col("start")).alias("before"), "n_words")).alias("m"))
    return best.select(F.col("doc").alias(id_column), F.col("item").alias(item_column), (-F.col("m.before")).alias("start"), F.col("m.n_words").alias("n_words"), F.col("m.similarity").alias("similarity"))


def drop_leaking(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """``docs`` without the documents that leak an item; a null id stays."""
    id_column = options.get("id_column", "doc_id")
    bad = leaks(docs, benchmark, **options).select(F.col(id_column).alias("__leak")).distinct()
    return docs.join(bad, docs[id_column] == bad["__leak"], "left_anti")


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


OP8_SQL = r"""
WITH iw AS (
  SELECT DISTINCT item_id, [x FOR x IN string_split_regex(lower(text), '[^\p{L}\p{N}]+') IF x <> ''] AS w FROM benchmark
), i AS (
  SELECT item_id, len(w) AS n, least(len(w), 5) AS k, w FROM iw WHERE len(w) > 0
), ig AS (
  SELECT item_id, n, k, p, array_to_string(w[p : p + k - 1], ' ') AS s FROM (SELECT *, unnest(range(1, n - k + 2)) AS p FROM i)
), dw AS (
  SELECT doc_id, [x FOR x IN string_split_regex(lower(coalesce(text, '')), '[^\p{L}\p{N}]+') IF x <> ''] AS w FROM documents
), dg AS (
  SELECT doc_id, k, p, array_to_string(w[p : p + k - 1], ' ') AS s
  FROM (SELECT doc_id, k, w, unnest(range(1, greatest(len(w) - k + 2, 1))) AS p FROM dw, (SELECT DISTINCT k FROM i))
), hit AS (
  SELECT dg.doc_id, ig.item_id, n, ig.k, dg.p, ig.p AS ip FROM dg JOIN ig ON dg.s = ig.s AND dg.k = ig.k
), share AS (
  SELECT doc_id, item_id FROM hit GROUP BY doc_id, item_id, n, k HAVING count(DISTINCT ip) * 100 >= 80 * (n - k + 1)
), win AS (
  SELECT DISTINCT doc_id, item_id, n, k, unnest(range(p - (n - k + 1), p)) AS start FROM hit JOIN share USING (doc_id, item_id)
), span AS (
  SELECT DISTINCT doc_id, item_id, win.k, greatest(start, 0) AS a, least(start + n, len(w)) AS e FROM win JOIN dw USING (doc_id)
), wc AS (
  SELECT span.doc_id, item_id, a, e, s, count(*) AS c FROM span JOIN dg ON dg.doc_id = span.doc_id AND dg.k = span.k AND p > a AND p + span.k - 1 <= e
  GROUP BY ALL
), ic AS (SELECT item_id, s, count(*) AS c FROM ig GROUP BY ALL),
sim AS (
  SELECT wc.doc_id, wc.item_id, a, e, sum(least(wc.c, coalesce(ic.c, 0))) AS shared, sum(wc.c) AS nw
  FROM wc LEFT JOIN ic ON ic.item_id = wc.item_id AND ic.s = wc.s GROUP BY ALL
), r AS (
  SELECT sim.doc_id, sim.item_id, a, e, shared / (nw + t.c - shared) AS similarity
  FROM sim JOIN (SELECT item_id, sum(c) AS c FROM ic GROUP BY 1) t ON t.item_id = sim.item_id
  WHERE shared * 100 >= 80 * (nw + t.c - shared)
)
SELECT doc_id, item_id, CAST(a AS INTEGER) AS start, CAST(e - a AS INTEGER) AS n_words, CAST(similarity AS DOUBLE) AS similarity
FROM r QUALIFY row_number() OVER (PARTITION BY doc_id, item_id ORDER BY similarity DESC, a, e DESC) = 1
"""

QUERIES = {"op8_decontaminate": op8_decontaminate}
ORACLES = {"op8_decontaminate": OP8_SQL}

"""Substring dedup on a de Bruijn graph of word windows.

Every window of ``k`` consecutive words is an edge; consecutive windows of a document
make its walk through the graph. As in compaction by minimizers, a walk is cut into
pieces: the longest stretches of windows that share their minimizer, the smallest hash
of the ``m``-word shingles inside a window. Equal windows have equal minimizers, so that
dealing pieces by minimizer brings all occurrences of an edge together, and a piece
holds some (k - m) / 2 edges: few rows are shuffled, with 6 bytes an edge beside the
8-byte minimizer. Pieces that recur within a batch are combined before the shuffle.

In each minimizer's group, in the order of coordinates (document, word), the first
occurrence of an edge is its source; later ones are repeats, and nonbranching runs of
them, whose sources are consecutive too, come out as one row. Runs that go on in the
next piece on the same diagonal (same source document, same distance) are then
compacted to maximal repeated spans.

The source coordinates verify a span: the words at both of its ends are read again from
the texts, and their SHA-256 must agree. Edges are hashes, so that a span may point to
other words; such spans are dropped, and all windows are matched once more with hashes of
another seed, until a round has none. Each round adds only verified spans, and in a round
without a wrong one every window has met its true source, so that nothing is lost.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomsite.llm.common import materialize, table
from loomsite.llm.hashing import BYTE_VALUE, U64, mix64, ranges, shingle_hashes, steps, word_hashes, words

#: Bytes of an edge's hash that a piece carries in the first round; later rounds take 8.
EDGE_BYTES = 6

_PIECES = "minimizer long, doc long, start int, edges binary, n int, src_doc long, src_start int"
_RUNS = "doc long, start int, n int, src_doc long, src_start int"


def _sliding_argmin(values: np.ndarray, width: int) -> np.ndarray:
    """For each i the position of the leftmost minimum of values[i : i + width]."""
    at, span, value = np.arange(len(values)), 1, values
    while span < width:
        shift = min(span, width - span)
        n = len(value) - shift
        later = value[shift:] < value[:n]
        at = np.where(later, at[shift:], at[:n])
        value = np.where(later, value[shift:], value[:n])
        span += shift
    return at


def _pieces_of(docs: np.ndarray, data: np.ndarray, offsets: np.ndarray, k: int, m: int, seed: int):
    """The pieces of the rows of one step: minimizer, doc, start, edges in each, hashes."""
    start, end, first = words(data, offsets)
    if len(start) < k:
        return None
    h = word_hashes(data, start, end, mix64(BYTE_VALUE + U64(seed)) if seed else BYTE_VALUE)
    count = np.diff(first)
    row = np.repeat(np.arange(len(count)), count)
    s = shingle_hashes(h, m)
    n = len(h) - k + 1
    inside = row[:n] == row[k - 1 :]
    low = _sliding_argmin(s, k - m + 1)[:n]
    edge = s[:n].copy()
    for j in {*range(m, k - m, m), k - m}:
        edge = mix64(edge * U64(0xD6E8FEB86659FD93) + s[j : n + j])
    ok = np.flatnonzero(inside)
    if not len(ok):
        return None
    cut = np.ones(len(ok), dtype=bool)
    cut[1:] = (np.diff(ok) != 1) | (low[ok][1:] != low[ok][:-1]) | (row[ok][1:] != row[ok][:-1])
    begin = np.flatnonzero(cut)
    sizes = np.diff(np.append(begin, len(ok)))
    at = ok[begin]
    return s[low[at]], docs[row[at]], (at - first[row[at]]).astype(np.int32), sizes, edge[ok]


def _map_pieces(k: int, m: int, seed: int, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["minimizer", "doc", "start", "edges", "n", "src_doc", "src_start"]
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            got = [x for i, j, data, offsets in steps(batch.column(1)) if (x := _pieces_of(ids[i:j], data, offsets, k, m, seed))]
            if not got:
                continue
            low, doc, start, sizes, edge = (np.concatenate(c) for c in zip(*got, strict=True))
            begin = np.cumsum(sizes) - sizes
            place = np.arange(len(edge)) - np.repeat(begin, sizes)
            whole = mix64(low + np.add.reduceat(mix64(edge + place.astype(U64) * U64(0x9E3779B97F4A7C15)), begin))
            order = np.lexsort((start, doc))
            _, one, back = np.unique(whole[order], return_index=True, return_inverse=True)
            one = order[one]
            source = np.empty(len(order), dtype=np.int64)
            source[order] = one[back]
            again = (doc[source] < doc) | ((doc[source] == doc) & (start[source] < start))
            only = np.sort(one)
            body = edge[ranges(begin[only], sizes[only])].astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]
            bounds = np.zeros(len(only) + 1, dtype=np.int32)
            np.cumsum(sizes[only] * width, out=bounds[1:])
            edges = pa.BinaryArray.from_buffers(pa.binary(), len(only), [None, pa.py_buffer(bounds), pa.py_buffer(np.ascontiguousarray(body))])
            none = pa.nulls(len(only), pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array(low[only].view(np.int64)), pa.array(doc[only]), pa.array(start[only]), edges, none, pa.nulls(len(only), pa.int64()), none], names=names)
            if again.any():
                r = np.flatnonzero(again)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(mix64(doc[r].astype(U64) ^ whole[r]).view(np.int64)), pa.array(doc[r]), pa.array(start[r]), pa.nulls(len(r), pa.binary()), pa.array(sizes[r].astype(np.int32)), pa.array(doc[source[r]]), pa.array(start[source[r]])],
                    names=names,
                )

    return run


def _reduce_pieces(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows sorted by (minimizer, doc, start) -> runs of repeated edges. Of the group that
        a batch ends in, the first coordinate of each edge is kept for the next batch."""
        names = ["doc", "start", "n", "src_doc", "src_start"]
        open_at, kept = None, None
        for batch in batches:
            done = batch.column(4).is_valid().to_numpy(zero_copy_only=False)
            if done.any():
                ready = batch.filter(pa.array(done))
                yield pa.RecordBatch.from_arrays([ready.column(c) for c in (1, 2, 4, 5, 6)], names=names)
                batch = batch.filter(pa.array(~done))
            if not batch.num_rows:
                continue
            low = batch.column(0).to_numpy()
            doc, start = batch.column(1).to_numpy(), batch.column(2).to_numpy()
            body = batch.column(3).combine_chunks() if isinstance(batch.column(3), pa.ChunkedArray) else batch.column(3)
            bounds = np.frombuffer(body.buffers()[1], dtype=np.int32)[body.offset : body.offset + len(body) + 1]
            raw = np.frombuffer(body.buffers()[2], dtype=np.uint8)[bounds[0] : bounds[-1]].reshape(-1, width)
            wide = np.zeros((len(raw), 8), dtype=np.uint8)
            wide[:, :width] = raw
            sizes = np.diff(bounds) // width
            piece = np.repeat(np.arange(len(sizes)), sizes)
            key = mix64(wide.reshape(-1).view("<u8") + mix64(low.view(U64))[piece])
            place = (np.arange(len(key)) - np.repeat(np.cumsum(sizes) - sizes, sizes)).astype(np.int32)
            wdoc, wpos, group = doc[piece], start[piece] + place, low[piece]
            if open_at is not None and low[0] == open_at:
                key, wdoc, wpos = np.concatenate([kept[0], key]), np.concatenate([kept[1], wdoc]), np.concatenate([kept[2], wpos])
                piece = np.concatenate([np.full(len(kept[0]), -1), piece])
                group = np.concatenate([np.full(len(kept[0]), open_at), group])
            _, one, back = np.unique(key, return_index=True, return_inverse=True)
            # Coordinates ascend within a group, so the first index is the first coordinate.
            src_doc, src_pos = wdoc[one][back], wpos[one][back]
            open_at = low[-1]
            last = one[group[one] == open_at]
            kept = key[last], wdoc[last], wpos[last]
            again = np.flatnonzero((piece >= 0) & ((src_doc < wdoc) | ((src_doc == wdoc) & (src_pos < wpos))))
            if not len(again):
                continue
            p, a, b, c = piece[again], wpos[again], src_doc[again], src_pos[again]
            cut = np.ones(len(again), dtype=bool)
            cut[1:] = (np.diff(p) != 0) | (np.diff(a) != 1) | (np.diff(b) != 0) | (np.diff(c) != 1)
            begin = np.flatnonzero(cut)
            n = np.diff(np.append(begin, len(again))).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(wdoc[again][begin]), pa.array(a[begin]), pa.array(n), pa.array(b[begin]), pa.array(c[begin])], names=names)

    return run


def _digests(k: int):
    """Rows sorted by (doc, start, n), a document's texts (start null) before what is asked
    of it -> the SHA-256 of the words ``start`` to ``start + n + k - 2`` of each of its
    texts that has so many."""
    names = ["doc", "start", "n", "digest"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, texts, taken = None, [], True
        for batch in batches:
            out = []
            for doc, start, n, text in zip(*(batch.column(c).to_pylist() for c in range(4)), strict=True):
                if doc != now:
                    now, texts = doc, []
                if start is None:
                    texts.append(text)
                    taken = False
                    continue
                if not taken:
                    texts, taken = [x.encode().split() for x in dict.fromkeys(texts) if x], True
                end = start + n + k - 1
                out += [(doc, start, n, hashlib.sha256(b" ".join(own[start:end])).digest()) for own in texts if end <= len(own)]
            if out:
                types = (pa.int64(), pa.int32(), pa.int32(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names=names)

    return run


def _verified(rows: DataFrame, spans: DataFrame, k: int) -> DataFrame:
    """``spans`` with ``same``: whether the words at the source are those of the span. What
    is asked of a document is distinct before the shuffle, and streams past its text."""
    asked = spans.select("doc", "start", "n").unionByName(spans.select(F.col("src_doc").alias("doc"), F.col("src_start").alias("start"), "n")).distinct()
    none = F.lit(None)
    both = rows.select("doc", none.cast("int").alias("start"), none.cast("int").alias("n"), "text").unionByName(asked.withColumn("text", none.cast("string")))
    told = both.repartition("doc").sortWithinPartitions("doc", F.col("start").asc_nulls_first(), "n").mapInArrow(_digests(k), "doc long, start int, n int, digest binary")
    told = told.groupBy("doc", "start", "n").agg(F.collect_set("digest").alias("own"))
    source = told.select(F.col("doc").alias("src_doc"), F.col("start").alias("src_start"), "n", F.col("own").alias("source"))
    joined = spans.join(told, ["doc", "start", "n"], "left").join(source, ["src_doc", "src_start", "n"], "left")
    return joined.withColumn("same", F.coalesce(F.arrays_overlap("own", "source"), F.lit(False))).select("doc", "start", "n", "src_doc", "src_start", "same")


def _candidate_spans(rows: DataFrame, k: int, m: int, seed: int, width: int) -> DataFrame:
    pieces = rows.mapInArrow(_map_pieces(k, m, seed, width), _PIECES)
    runs = pieces.repartition("minimizer").sortWithinPartitions("minimizer", "doc", "start").mapInArrow(_reduce_pieces(width), _RUNS)
    diagonal = F.col("start") - F.col("src_start")
    order = Window.partitionBy("doc", "src_doc", "diagonal").orderBy("start")
    edges = runs.withColumn("diagonal", diagonal).withColumn("new", (F.lag(F.col("start") + F.col("n")).over(order) >= F.col("start")).cast("int"))
    paths = edges.withColumn("path", F.sum(1 - F.coalesce("new", F.lit(0))).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    end = F.max(F.col("start") + F.col("n")) - F.min("start")
    return paths.groupBy("doc", "src_doc", "diagonal", "path").agg(F.min("start").alias("start"), end.cast("int").alias("n"), F.min("src_start").alias("src_start")).select("doc", "start", "n", "src_doc", "src_start")


def repeated_spans(docs: DataFrame, k: int = 20, m: int = 8, id_column: str = "doc_id", text_column: str = "text", edge_bytes: int = EDGE_BYTES) -> DataFrame:
    """-> ``(doc, start, n, src_doc, src_start)``: the words ``start`` to ``start + n + k
    - 2`` of ``doc`` (n windows) also stand at ``src_start`` of ``src_doc``, which is
    earlier: a smaller document, or the same and an earlier word. Words are the runs of
    bytes other than 0x20 and 0x09-0x0D; spans are maximal for one source each. Where a
    round met wrong spans, spans of two rounds may overlap. A document that is the source
    of many different ranges answers them in one task, one by one."""
    rows = docs.where(F.col(id_column).isNotNull()).select(F.col(id_column).cast("long").alias("doc"), F.col(text_column).cast("string").alias("text"))
    found, seed = [], 0
    while True:
        spans = materialize(_candidate_spans(rows, k, m, seed, 8 if seed else edge_bytes), "spans", release=True)
        checked = materialize(_verified(rows, spans, k), "spans", release=True)
        found.append(checked.where("same").drop("same"))
        if checked.where(~F.col("same")).isEmpty():
            return found[0] if len(found) == 1 else reduce(DataFrame.unionByName, found).distinct()
        seed += 1


def remove_repeats(docs: DataFrame, k: int = 20, m: int = 8, id_column: str = "doc_id", text_column: str = "text", edge_bytes: int = EDGE_BYTES) -> DataFrame:
    """-> ``(<id_column>, n_words, n_removed, kept, kept_sha256)`` for every row: the text
    without the words that a window of ``k`` words covers whose words also start earlier,
    in one space each. Windows are judged on the input, not on what is left.

    Defined cases: a null or empty text has no words and an empty ``kept``; a text of
    fewer than ``k`` words keeps them all; rows with a null id take no part and keep
    theirs; rows that repeat an id share the removals found for it, and a window is not
    earlier than one with the same id and start; other columns are dropped.
    """
    spans = repeated_spans(docs, k, m, id_column, text_column, edge_bytes)
    by_doc = spans.groupBy("doc").agg(F.collect_list(F.struct("start", (F.col("start") + F.col("n") + (k - 1)).alias("end"))).alias("spans"))
    rows = docs.select(F.col(id_column), F.col(text_column).cast("string").alias("text"))
    joined = rows.join(by_doc.withColumnRenamed("doc", id_column), id_column, "left").select(id_column, "text", "spans.start", "spans.end")
    schema = T.StructType([rows.schema[0], T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField("kept", T.StringType()), T.StructField("kept_sha256", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for i in range(0, whole.num_rows, 256):
                batch = whole.slice(i, 256)
                out = []
                for text, starts, ends in zip(*(batch.column(c).to_pylist() for c in (1, 2, 3)), strict=True):
                    own = (text or "").encode().split()
                    kept = own
                    if starts:
                        depth = np.zeros(len(own) + 1, dtype=np.int32)
                        np.add.at(depth, np.minimum(starts, len(own)), 1)
                        np.add.at(depth, np.minimum(ends, len(own)), -1)
                        kept = [own[x] for x in np.flatnonzero(np.cumsum(depth[:-1]) == 0)]
                    body = b" ".join(kept)
                    out.append((len(own), len(own) - len(kept), body.decode(), hashlib.sha256(body).hexdigest()))
                columns = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.int64(), pa.int64(), pa.string(), pa.string()), strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=schema.names)

    return joined.mapInArrow(run, schema)


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents")).select("doc_id", "n_words", "n_removed", "kept_sha256")


OP9_SQL = r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents
), win AS (
  SELECT doc_id, p, array_to_string(ws[p : p + 19], ' ') AS s
  FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 18, 1))) AS p FROM w)
), again AS (
  SELECT doc_id, p FROM (SELECT doc_id, p, row_number() OVER (PARTITION BY s ORDER BY doc_id, p) AS n FROM win) WHERE n > 1
), gone AS (
  SELECT DISTINCT doc_id, p + j AS q FROM again, range(0, 20) AS t(j)
), kept AS (
  SELECT x.doc_id, x.q, x.word FROM (SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS q FROM w) x
  ANTI JOIN gone g ON x.doc_id = g.doc_id AND x.q = g.q
), body AS (
  SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY q) AS kept FROM kept GROUP BY doc_id
)
SELECT w.doc_id, len(ws) AS n_words, len(ws) - coalesce(n, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM w LEFT JOIN body USING (doc_id)
"""

QUERIES = {"op9_substring_dedup": op9_substring_dedup}
ORACLES = {"op9_substring_dedup": OP9_SQL}

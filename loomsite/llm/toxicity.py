"""Toxicity with a linear-chain conditional random field.

Tokens are runs of letters and digits, A-Z lower-cased; their features are the hashed
token, prefixes and a suffix. Labels belong to documents, so tokens are labelled first:
a token of a toxic document is toxic as far as one of its features is believed to mark
toxic documents, by its false discovery rate and its smoothed odds. On these softly
labelled tokens the field (two tags, feature and transition weights) is trained by stochastic gradient
descent on its exact likelihood. Forward-backward gives each token's marginal; a
document's largest marginal and their sum go through a logistic function, fitted to the
document labels, to its score; tokens whose marginal reaches 0.5 are the offending spans.

Training sees at most ``max_docs`` labelled documents, whole texts, a third toxic where there
are enough, chosen by a hash of the id from all labels. Scoring covers every token: it
runs block-wise with 64 tokens of context on both sides, over which the influence of
what lies beyond has decayed, and blocks in which no token has a weighted feature share
one marginal.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomsite.llm.common import table
from loomsite.llm.hashing import ALNUM, BYTE_VALUE_LOWER, U64, between, list_array, mix64, running, steps, words

#: Labelled documents that training uses at most.
MAX_DOCS = 3000
#: Bytes of a text that training takes: with ``MAX_DOCS`` it bounds the driver's memory
#: to 200 MB of texts. Longer texts are scored like others.
MAX_TEXT = 1 << 16
#: From this score on a document is rejected.
LIMIT = 0.3
BLOCK = 64

#: How much rarer than in toxic documents a telling feature is in clean ones, and the
#: smallest belief that a feature is trained with.
ODDS, LEAST = 12.0, 0.3

_PREFIXES = (3, 4, 5, 6)
_SUFFIX = 4


#: Kinds of features: the token, its prefixes and its suffix.
_KINDS = len(_PREFIXES) + 2


def _feature(sums: np.ndarray, start: np.ndarray, end: np.ndarray, kind: int) -> np.ndarray:
    """The hash of one kind of feature of every token; what is shorter than a prefix or the
    suffix has its whole bytes in it."""
    if kind == 0:
        h = between(sums, start, end)
    elif kind <= len(_PREFIXES):
        h = between(sums, start, np.minimum(start + _PREFIXES[kind - 1], end))
    else:
        h = between(sums, np.maximum(end - _SUFFIX, start), end)
    return mix64(h + U64(kind))


@dataclass
class Field:
    """A trained field: sorted feature hashes, their weights, the bias of the toxic tag,
    the transition scores [from, to] and the document's logistic function."""

    keys: np.ndarray
    weights: np.ndarray
    bias: float
    moves: np.ndarray
    logistic: np.ndarray

    def emissions(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The toxic tag's score of each token, and which tokens have a known feature."""
        score = np.full(len(start), self.bias)
        known = np.zeros(len(start), dtype=bool)
        if len(self.keys) and len(start):
            bitmap = np.zeros(1 << 16, dtype=bool)
            bitmap[(self.keys >> U64(48)).astype(np.int64)] = True
            sums = running(data, BYTE_VALUE_LOWER)
            for kind in range(_KINDS):
                h = _feature(sums, start, end, kind)
                maybe = np.flatnonzero(bitmap[(h >> U64(48)).astype(np.int64)])
                at = np.minimum(np.searchsorted(self.keys, h[maybe]), len(self.keys) - 1)
                hit = self.keys[at] == h[maybe]
                score[maybe[hit]] += self.weights[at[hit]]
                known[maybe[hit]] = True
        return score, known


def marginals(score: np.ndarray, valid: np.ndarray, moves: np.ndarray, pairs: bool = False):
    """Forward-backward over rows of equal length; steps that aren't valid are skipped.
    -> P(toxic) of each step, and with ``pairs`` the expected transition counts."""
    rows, n = score.shape
    emit = np.exp(np.clip(score, -30, 30))
    m = np.exp(moves)
    ahead = np.empty((n, rows, 2))
    a = np.full((rows, 2), 0.5)
    for t in range(n):
        new = a @ m
        new[:, 1] *= emit[:, t]
        new /= new.sum(axis=1, keepdims=True)
        a = np.where(valid[:, t, None], new, a)
        ahead[t] = a
    p = np.empty((rows, n))
    counts = np.zeros((2, 2))
    b = np.ones((rows, 2))
    for t in range(n - 1, -1, -1):
        both = ahead[t] * b
        p[:, t] = both[:, 1] / both.sum(axis=1)
        into = b.copy()
        into[:, 1] *= emit[:, t]
        if pairs:
            before = ahead[t - 1] if t else np.full((rows, 2), 0.5)
            joint = before[:, :, None] * m[None] * into[:, None, :]
            joint /= joint.sum(axis=(1, 2), keepdims=True)
            counts += joint[valid[:, t]].sum(axis=0)
        new = into @ m.T
        new /= new.sum(axis=1, keepdims=True)
        b = np.where(valid[:, t, None], new, b)
    return (p, counts) if pairs else p


def token_marginals(field: Field, score: np.ndarray, known: np.ndarray, first: np.ndarray) -> np.ndarray:
    """P(toxic) of each token of all documents; ``first`` bounds the documents."""
    quiet = marginals(np.full((1, 3 * BLOCK), field.bias), np.ones((1, 3 * BLOCK), bool), field.moves)[0, BLOCK + BLOCK // 2]
    p = np.full(len(score), quiet)
    at = np.flatnonzero(known)
    if not len(at):
        return p
    doc = np.searchsorted(first, at, side="right") - 1
    block = (at - first[doc]) // BLOCK
    near = np.concatenate([np.stack([doc, block + d], axis=1) for d in (-1, 0, 1)])
    last = (np.diff(first)[near[:, 0]] - 1) // BLOCK
    near = np.unique(near[(near[:, 1] >= 0) & (near[:, 1] <= last)], axis=0)
    lo, hi = first[near[:, 0]], first[near[:, 0] + 1]
    begin = lo + near[:, 1] * BLOCK
    for i in range(0, len(begin), 2048):
        s = slice(i, i + 2048)
        pos = begin[s, None] - BLOCK + np.arange(3 * BLOCK)
        ok = (pos >= lo[s, None]) & (pos < hi[s, None])
        got = marginals(np.where(ok, score[np.clip(pos, 0, len(score) - 1)], 0.0), ok, field.moves)
        own = ok.copy()
        own[:, :BLOCK] = own[:, 2 * BLOCK :] = False
        p[pos[own]] = got[own]
    return p


def _summary(p: np.ndarray, first: np.ndarray) -> np.ndarray:
    """(1, largest marginal, log of 1 + their sum) of each document."""
    n = len(first) - 1
    out = np.zeros((n, 3))
    out[:, 0] = 1
    some = np.flatnonzero(np.diff(first))
    if len(some):
        out[some, 1] = np.maximum.reduceat(p, first[some])
        out[some, 2] = np.log1p(np.add.reduceat(p, first[some]))
    return out


def _tails(n: int, share: float) -> np.ndarray:
    """P(at least k of n documents are toxic) for k from 0 to n, if chance alone decides."""
    k = np.arange(n + 1)
    logs = np.concatenate([[0.0], np.cumsum(np.log(np.arange(1, n + 1)))])
    p = np.exp(logs[n] - logs[k] - logs[n - k] + k * np.log(share) + (n - k) * np.log1p(-share))
    return np.minimum(1.0, np.cumsum(p[::-1])[::-1])


def _telling(h: np.ndarray, doc: np.ndarray, toxic: np.ndarray, before: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted hashes of one kind's features, and how likely each is to mark toxic tokens.

    A feature counts once for a document, and in toxic ones once for each token before
    it at most: the words of a much-copied toxic document always have the same neighbour.
    Its belief is the product of two: that it isn't there by chance (one less the false
    discovery rate at its level, the features that chance alone would bring to that level
    over those that are there, so that few labels give weak beliefs and many give strong
    ones) and that a document with it is toxic (``ODDS`` smoothed clean occurrences count
    like one toxic one). Features with a belief under ``LEAST`` are left out."""
    n1, n0 = max(1, int(toxic.sum())), max(1, int((~toxic).sum()))
    key, index = np.unique(h, return_inverse=True)
    pair = np.unique(index.astype(np.int64) * len(toxic) + doc)
    f, d = pair // len(toxic), pair % len(toxic)
    t = np.bincount(f[toxic[d]], minlength=len(key))
    c = np.bincount(f[~toxic[d]], minlength=len(key))
    share = min(max(float(t.sum()) / max(1, len(pair)), 1e-6), 1 - 1e-6)
    own = toxic[doc]
    _, one = np.unique(mix64(h[own] + mix64(before[own])), return_index=True)
    t = np.minimum(t, np.bincount(index[own][one], minlength=len(key)))
    n = t + c
    level = np.ones(len(key))
    tails = {int(m): _tails(int(m), share) for m in np.unique(n) if m}
    order = np.argsort(n, kind="stable")
    bounds = np.searchsorted(n[order], list(tails) + [n.max() + 1]) if len(order) else []
    for i, (m, tail) in enumerate(tails.items()):
        some = order[bounds[i] : bounds[i + 1]]
        level[some] = tail[t[some]]
    levels, many = np.unique(level, return_counts=True)
    seen = np.cumsum(many)
    chance = np.zeros(len(levels))
    for i, (m, tail) in enumerate(tails.items()):
        up = tail[::-1]  # ascending
        at = np.searchsorted(up, levels * (1 + 1e-9), side="right")
        chance += (bounds[i + 1] - bounds[i]) * np.where(at, up[np.maximum(at - 1, 0)], 0.0)
    rate = np.minimum.accumulate(np.minimum(1.0, chance / seen)[::-1])[::-1]
    real = 1 - rate[np.searchsorted(levels, level)]
    a, b = (t + 0.5) / (n1 + 1), (c + 0.5) / (n0 + 1)
    belief = real * a / (a + ODDS * b)
    keep = belief >= LEAST
    return key[keep], belief[keep]


def _fit_logistic(x: np.ndarray, marks: np.ndarray, w: np.ndarray) -> np.ndarray:
    # Documents count alike: labels hold noise, and a share of toxic documents without
    # any toxic token must not lift the score of all documents without one.
    weight = 1 / max(1, len(marks))
    for _ in range(3000):
        q = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        w = w + 2.0 * ((weight * (marks - q)) @ x - 1e-4 * w)
    return w


def train(texts: list[str], toxic: list[int], epochs: int = 8, rate: float = 0.5, seed: int = 7) -> Field:
    """A field from whole texts and their labels (1 toxic, 0 not)."""
    marks = np.array(toxic, dtype=bool)
    parts = [(data, *words(data, offsets, ALNUM), i) for i, _, data, offsets in steps(pa.array(texts, pa.string()))]
    doc = np.concatenate([np.repeat(np.arange(len(f) - 1, dtype=np.int32) + i, np.diff(f)) for _, _, _, f, i in parts]) if parts else np.zeros(0, np.int32)
    first = np.searchsorted(doc, np.arange(len(texts) + 1))
    before, found = np.zeros(0, U64), []
    free = np.ones(len(doc), dtype=bool)
    #: How likely each token is to be toxic, as its features tell.
    sure = np.zeros(len(doc))
    for kind in range(_KINDS):
        h = np.concatenate([_feature(running(data, BYTE_VALUE_LOWER), s, e, kind) for data, s, e, _, _ in parts]) if parts else before
        if kind == 0:
            before = np.concatenate([h[:1] * U64(0), h[:-1]])
            before[1:][doc[1:] != doc[:-1]] = U64(0)
        # Parts of tokens are judged on the tokens that weren't picked whole.
        key, belief = _telling(h[free], doc[free], marks, before[free]) if free.any() and marks.any() else (h[:0], np.zeros(0))
        at = np.flatnonzero(np.isin(h, key) & free)
        found.append((at, h[at], key))
        sure[at] = np.maximum(sure[at], belief[np.searchsorted(key, h[at])]) if len(at) else sure[at]
        if kind == 0:
            free[at] = False
    del before
    keys = np.unique(np.concatenate([key for _, _, key in found]))
    field = Field(keys, np.zeros(len(keys)), -4.0, np.zeros((2, 2)), np.array([-3.0, 4.0, 0.0]))
    #: The picked features of each token, by kind; -1: none.
    active = np.full((len(doc), _KINDS), -1, dtype=np.int32)
    for kind, (at, h, _) in enumerate(found):
        active[at, kind] = np.searchsorted(keys, h)
    has = (active >= 0).any(axis=1)
    if len(keys):
        label = np.where(has & marks[doc], sure, 0.0)
        # Every block with a picked feature, and as many others.
        start_of = np.concatenate([np.arange(a, b, BLOCK) for a, b in zip(first[:-1], first[1:], strict=True)])
        hot = np.add.reduceat(has, start_of) > 0
        rng = np.random.default_rng(seed)
        cold = rng.permutation(np.flatnonzero(~hot))[: max(256, int(hot.sum()))]
        chosen = np.concatenate([np.flatnonzero(hot), cold])
        for epoch in range(epochs):
            order = rng.permutation(chosen)
            scale = rate / (1 + 0.3 * epoch)
            for i in range(0, len(order), 256):
                begin = start_of[order[i : i + 256]]
                own = begin[:, None] + np.arange(BLOCK)
                valid = own < first[doc[begin] + 1][:, None]
                own = np.minimum(own, len(doc) - 1)
                f = active[own]
                score = field.bias + np.where(f >= 0, field.weights[f], 0.0).sum(axis=2)
                p, expected = marginals(score, valid, field.moves, pairs=True)
                y = np.where(valid, label[own], 0.0)
                error = np.where(valid, y - p, 0.0)
                hit = (f >= 0) & valid[:, :, None]
                grad = np.bincount(f[hit], weights=np.repeat(error.reshape(-1), hit.sum(axis=2).reshape(-1)), minlength=len(keys))
                seen = np.bincount(f[hit], minlength=len(keys))
                field.weights += scale * (grad / np.sqrt(np.maximum(seen, 1)) - 1e-3 * field.weights)
                field.bias += scale * float(error.sum()) / valid.sum() ** 0.5 * 0.1
                last = np.concatenate([np.zeros((len(own), 1)), y[:, :-1]], axis=1)
                observed = np.array([[((1 - last) * (1 - y))[valid].sum(), ((1 - last) * y)[valid].sum()], [(last * (1 - y))[valid].sum(), (last * y)[valid].sum()]])
                field.moves += scale * ((observed - expected) / len(own) / BLOCK - 1e-3 * field.moves)
        keep = np.abs(field.weights) >= 1e-3
        score = field.bias + np.where(active >= 0, field.weights[active], 0.0).sum(axis=1)
        field.keys, field.weights = keys[keep], field.weights[keep]
    else:
        score = np.full(len(doc), field.bias)
    x = _summary(token_marginals(field, score, has, first), first)
    field.logistic = _fit_logistic(x, marks, field.logistic)
    return field


def training_rows(docs: DataFrame, labels: DataFrame, usable=None, max_docs: int = MAX_DOCS, id_column: str = "doc_id", text_column: str = "text") -> tuple[list[str], list[int]]:
    """At most ``max_docs`` labelled texts of ``MAX_TEXT`` bytes at most, a third of them toxic
    at most, by a hash of the id; ``usable`` is a condition on the id. An id with both labels counts as toxic."""
    known = labels.where(F.col("toxic").isin(0, 1) & F.col(id_column).isNotNull())
    known = known.where(usable) if usable is not None else known
    known = known.groupBy(id_column).agg(F.max("toxic").alias("toxic"))
    order = [F.xxhash64(F.col(id_column)), F.col(id_column)]
    fits = docs.where(F.octet_length(F.col(text_column).cast("string")) <= MAX_TEXT).select(id_column).distinct()
    known = known.join(fits, id_column, "left_semi")
    ids = known.where("toxic = 1").orderBy(*order).limit(max_docs // 3).unionByName(known.where("toxic = 0").orderBy(*order).limit(max_docs - max_docs // 3))
    rows = docs.select(F.col(id_column), F.col(text_column).alias("text")).join(F.broadcast(ids), id_column).select(id_column, "text", "toxic")
    got = rows.toArrow().sort_by([(id_column, "ascending")])
    return [x or "" for x in got.column("text").to_pylist()], got.column("toxic").to_pylist()


def score_texts(docs: DataFrame, field: Field, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """-> ``(<id_column>, score double, span_starts, span_ends array<int>)`` for every row.

    Spans are character offsets of the tokens whose marginal reaches 0.5. Defined cases:
    a null, empty or tokenless text gets the logistic function's score of no marginals
    and no spans; repeated rows each get a row; other columns are dropped.
    """
    rows = docs.select(F.col(id_column), F.col(text_column).cast("string").alias("text"))
    ints = T.ArrayType(T.IntegerType())
    schema = T.StructType([rows.schema[0], T.StructField("score", T.DoubleType()), T.StructField("span_starts", ints), T.StructField("span_ends", ints)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, data, offsets in steps(batch.column(1)):
                start, end, first = words(data, offsets, ALNUM)
                score, known = field.emissions(data, start, end)
                p = token_marginals(field, score, known, first)
                x = _summary(p, first)
                q = 1 / (1 + np.exp(-np.clip(x @ field.logistic, -30, 30)))
                bad = np.flatnonzero(p >= 0.5)
                row = np.searchsorted(first, bad, side="right") - 1
                points = np.zeros(len(data) + 1, dtype=np.int64)
                np.cumsum((data & 0xC0) != 0x80, out=points[1:])
                count = np.bincount(row, minlength=j - i)
                spans = [list_array(pa.array((points[e[bad]] - points[offsets[row]]).astype(np.int32)), count) for e in (start, end)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), pa.array(q), *spans], names=schema.names)

    return rows.mapInArrow(run, schema)


def keep_clean(docs: DataFrame, field: Field, limit: float = LIMIT, text_column: str = "text") -> DataFrame:
    """The rows of ``docs`` whose score is under ``limit``, with all their columns.

    Defined cases: null, empty and tokenless texts have the score of no marginals, which
    a trained field keeps under the limit; repeated rows are judged alike; columns of any
    name and type are kept; an empty table gives none."""
    at = docs.columns.index(text_column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = np.ones(batch.num_rows, dtype=bool)
            for i, j, data, offsets in steps(batch.column(at)):
                start, end, first = words(data, offsets, ALNUM)
                score, known = field.emissions(data, start, end)
                x = _summary(token_marginals(field, score, known, first), first)
                keep[i:j] = 1 / (1 + np.exp(-np.clip(x @ field.logistic, -30, 30))) < limit
            yield batch.filter(pa.array(keep))

    return docs.mapInArrow(run, docs.schema)


def remainder(id_column: str, n: int):
    """crc32 of the id as text, modulo ``n``."""
    return F.crc32(F.col(id_column).cast("string").cast("binary")) % n


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    field = train(*training_rows(docs, table(spark, sf_dir, "labels"), remainder("doc_id", 4) != 2))
    return score_texts(docs, field).select(
        "doc_id",
        F.coalesce(remainder("doc_id", 4) == 2, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= LIMIT).cast("int").alias("predicted"),
    )


QUERIES = {"op3_toxicity": op3_toxicity}
ORACLES: dict[str, str] = {}

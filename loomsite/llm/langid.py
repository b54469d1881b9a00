"""Language identification: averaged hashed subword embeddings and a linear softmax.

A text's letters (A-Z lower-cased; every byte of a non-ASCII character counts as one) and
single spaces for what lies between give byte n-grams of 2 to 4; each hashes to a row of
an embedding table. A text is the average of its rows, and a linear softmax over it gives
the languages. Both are trained together by stochastic gradient descent in numpy, on
whole texts and on single lines of them, so that short texts are seen too. On a part of
the training rows kept apart, a temperature calibrates the probabilities and a threshold
is set above which predictions are right in ``precision`` of cases; below it the column
``rejected`` is true.

As the softmax is linear, prediction needs only the product of both matrices: each n-gram
adds one score for each language. Training takes at most ``max_docs`` rows, as even over
the languages as there are rows, chosen by a hash of the id.
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
from loomsite.llm.hashing import steps

#: Rows that training takes at most, and bytes of a text of theirs: both bound the driver's
#: memory to 200 MB of texts. Longer texts are predicted like others.
MAX_DOCS, MAX_TEXT = 3000, 1 << 16
BUCKETS = 1 << 16
ORDERS = (2, 3, 4)
UNKNOWN = "und"

_SPACE = 0x20
_LETTER = np.full(256, _SPACE, dtype=np.uint8)
_LETTER[97:123] = np.arange(97, 123)
_LETTER[65:91] = np.arange(97, 123)
_LETTER[128:] = np.arange(128, 256)


def _grams(data: np.ndarray, offsets: np.ndarray) -> Iterator[np.ndarray]:
    """For each order the bucket of the n-gram that starts at each byte; 0 where it
    starts with two spaces or leaves its row."""
    x = _LETTER[data].astype(np.uint32)
    n = len(x)
    room = np.repeat(offsets[1:], np.diff(offsets)) - np.arange(n)
    padded = np.concatenate([x, np.full(4, _SPACE, dtype=np.uint32)])
    blank = (padded[:n] == _SPACE) & (padded[1 : n + 1] == _SPACE)
    key = padded[:n].copy()
    for k in range(1, max(ORDERS)):
        key |= padded[k : n + k] << np.uint32(8 * k)
        if k + 1 in ORDERS:
            bucket = ((key * np.uint32(2654435761) + np.uint32(40503 * k)) >> np.uint32(16)).astype(np.int64)
            bucket[bucket == 0] = 1
            bucket[blank | (room < k + 1)] = 0
            yield bucket


@dataclass
class Model:
    langs: list[str]
    scores: np.ndarray  # (BUCKETS, languages): what an n-gram adds to each language
    bias: np.ndarray
    temperature: float
    threshold: float

    def logits(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        rows = len(offsets) - 1
        total = np.zeros((rows, len(self.langs)))
        count = np.zeros(rows)
        some = np.flatnonzero(np.diff(offsets))
        if len(some):
            for bucket in _grams(data, offsets):
                count[some] += np.add.reduceat(bucket > 0, offsets[some], dtype=np.int64)
                for c in range(len(self.langs)):
                    total[some, c] += np.add.reduceat(self.scores[:, c][bucket], offsets[some], dtype=np.float64)
        return total / np.maximum(count, 1)[:, None] + self.bias


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def _bag(text: str) -> tuple[np.ndarray, np.ndarray]:
    data = np.frombuffer(text.encode(), dtype=np.uint8)
    got = np.concatenate(list(_grams(data, np.array([0, len(data)])))) if len(data) else np.zeros(0, np.int64)
    ids, n = np.unique(got[got > 0], return_counts=True)
    return ids, n / max(1, n.sum())


def train(texts: list[str], langs: list[str], dim: int = 16, epochs: int = 4, rate: float = 4.0, precision: float = 0.995, seed: int = 11) -> Model:
    """A model from whole texts and their languages."""
    names = sorted(set(langs)) or [UNKNOWN]
    rng = np.random.default_rng(seed)
    rows = [(t, names.index(y)) for t, y in zip(texts, langs, strict=True)]
    apart = [r for i, r in enumerate(rows) if i % 5 == 0]
    used = [r for i, r in enumerate(rows) if i % 5] or rows

    def with_lines(some: list) -> list:
        out = list(some)
        for t, y in some:
            lines = [x for x in t.split("\n") if x.strip()]
            out += [(lines[int(rng.integers(len(lines)))], y)] if len(lines) > 1 else []
        return [(*_bag(t), y) for t, y in out]

    bags = with_lines(used)
    table_ = rng.normal(0, 0.1, (BUCKETS, dim))
    w = rng.normal(0, 0.1, (dim, len(names)))
    b = np.zeros(len(names))
    done, total = 0, epochs * max(1, len(bags))
    for _ in range(epochs):
        for i in rng.permutation(len(bags)):
            ids, share, y = bags[i]
            step = rate * (1 - done / total)
            done += 1
            if not len(ids):
                continue
            mean = share @ table_[ids]
            g = _softmax(mean @ w + b)
            g[y] -= 1
            to_table = w @ g
            w -= step * 0.25 * np.outer(mean, g)
            b -= step * 0.01 * g
            table_[ids] -= step * share[:, None] * len(ids) ** 0.5 * to_table[None, :]
    scores = table_ @ w
    scores[0] = 0
    bags = with_lines(apart)
    logits = np.array([share @ scores[ids] + b if len(ids) else b for ids, share, _ in bags]) if bags else np.zeros((0, len(names)))
    truth = np.array([y for _, _, y in bags], dtype=int)
    best, temperature = np.inf, 1.0
    for t in np.geomspace(0.1, 10, 41) if len(truth) else []:
        loss = -np.log(np.maximum(_softmax(logits / t)[np.arange(len(truth)), truth], 1e-12)).mean()
        if loss < best:
            best, temperature = loss, float(t)
    threshold = 0.0
    if len(truth):
        p = _softmax(logits / temperature)
        order = np.argsort(-p.max(axis=1), kind="stable")
        right = (p.argmax(axis=1) == truth)[order]
        good = np.cumsum(right) / np.arange(1, len(right) + 1) >= precision
        threshold = float(p.max(axis=1)[order][np.flatnonzero(good)[-1]]) if good.any() else 1.0
    return Model(names, np.ascontiguousarray(scores.astype(np.float32)), b, temperature, threshold)


def training_rows(docs: DataFrame, usable=None, max_docs: int = MAX_DOCS, id_column: str = "doc_id", text_column: str = "text", lang_column: str = "lang") -> tuple[list[str], list[str]]:
    """At most ``max_docs`` texts of ``MAX_TEXT`` bytes at most with a language; ``usable`` is a condition on the id."""
    known = docs.where(F.col(lang_column).isNotNull() & (F.octet_length(F.col(text_column)) <= MAX_TEXT) & F.col(id_column).isNotNull())
    known = known.where(usable) if usable is not None else known
    known = known.select(F.col(id_column).alias("id"), F.col(lang_column).alias("language"))
    count = known.groupBy("language").agg(F.count(F.lit(1)).alias("n"))
    kinds = max(1, count.count())
    lot = F.pmod(F.xxhash64("id"), F.lit(1 << 30)) / float(1 << 30)
    ids = known.join(count, "language").where(lot * F.col("n") < max_docs / kinds).orderBy(F.xxhash64("id"), "id").limit(max_docs)
    rows = docs.join(F.broadcast(ids.select(F.col("id").alias(id_column)).distinct()), id_column, "left_semi")
    rows = rows.where(F.col(lang_column).isNotNull() & (F.octet_length(F.col(text_column)) <= MAX_TEXT))
    got = rows.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"), F.col(lang_column).alias("language")).toArrow().sort_by([("id", "ascending"), ("text", "ascending")])
    return got.column("text").to_pylist(), got.column("language").to_pylist()


def _has_letter(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    at = np.flatnonzero(((data | 32) >= 97) & ((data | 32) <= 122) & (data < 128))
    sure = np.diff(np.searchsorted(at, offsets)) > 0
    for i in np.flatnonzero(~sure):
        sure[i] = any(c.isalpha() for c in data[offsets[i] : offsets[i + 1]].tobytes().decode("utf-8", "replace"))
    return sure


def identify(docs: DataFrame, model: Model, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """-> ``(<id_column>, lang_pred string, score double, rejected boolean)`` for every row.

    ``score`` is the calibrated probability of ``lang_pred``; ``rejected`` says that it is
    under the model's threshold. Defined cases: a text that is null or has no letter is
    ``und`` with score 0 and rejected; repeated rows each get a row; other columns are
    dropped.
    """
    rows = docs.select(F.col(id_column), F.col(text_column).cast("string").alias("text"))
    schema = T.StructType([rows.schema[0], T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("rejected", T.BooleanType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, data, offsets in steps(batch.column(1)):
                p = _softmax(model.logits(data, offsets) / model.temperature)
                letter = _has_letter(data, offsets)
                best = p.argmax(axis=1)
                score = np.where(letter, p[np.arange(len(best)), best], 0.0)
                names = [model.langs[k] if ok else UNKNOWN for k, ok in zip(best, letter, strict=True)]
                rejected = (score < model.threshold) | ~letter
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), pa.array(names, pa.string()), pa.array(score), pa.array(rejected)], names=schema.names)

    return rows.mapInArrow(run, schema)


def remainder(id_column: str, n: int):
    """crc32 of the id as text, modulo ``n``."""
    return F.crc32(F.col(id_column).cast("string").cast("binary")) % n


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = train(*training_rows(docs, remainder("doc_id", 3) != 1))
    held_out = F.coalesce(remainder("doc_id", 3) == 1, F.lit(False))
    return identify(docs, model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "rejected")


QUERIES = {"op2_language_id": op2_language_id}
ORACLES: dict[str, str] = {}

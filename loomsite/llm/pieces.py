"""SentencePiece (BPE) encoding and decoding over a table of distinct marked words.

No piece of the vocabulary crosses a white-space marker from the left (checked when the
model is read), so no merge does: a text is a row of marked words, each a run of markers
and what follows it, and a word's pieces depend on the word alone. A batch of texts is cut
into marked words in numpy, its distinct words are found by dictionary encoding, each is
segmented once (a task keeps the table of the words it has met, within a bound), and the
ids are joined back to the texts by position: word number, offset, gather.

The table belongs to a task. One table for the whole corpus would have to meet every word
of every text in a shuffle, which costs several times the input in disk; a task's table
costs no exchange at all, and a lost executor costs its own tasks only.
"""

from __future__ import annotations

import heapq
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomsite.llm.common import table
from loomsite.llm.hashing import list_array, ranges, steps

#: Fixed value: the white-space marker of the piece format.
MARK = "▁"
#: Kinds of pieces in a model file.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
#: Marked words of which a task keeps the ids, in each of two generations, and their length.
TABLE_WORDS, TABLE_LENGTH = 300_000, 64


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """The (number, value) fields of a protocol-buffer message."""
    at, end = 0, len(data)

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < end:
        tag = varint()
        if tag & 7 == 0:
            yield tag >> 3, varint()
            continue
        size = varint() if tag & 7 == 2 else {1: 8, 5: 4}[tag & 7]
        yield tag >> 3, data[at : at + size]
        at += size


class PieceModel:
    """A BPE model file: its pieces with scores, and how texts are marked.

    Models that this method can't encode are refused: other kinds than BPE, normalizers
    that change characters, pieces that hold a marker behind another character, and
    user-defined or unused pieces."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            message = list(_fields(f.read()))
        trainer = dict(x for k, v in message if k == 2 for x in _fields(v))
        normal = dict(x for k, v in message if k == 3 for x in _fields(v))
        pieces = [dict(_fields(v)) for k, v in message if k == 1]
        text = [p[1].decode() for p in pieces]
        kind = [p.get(3, NORMAL) for p in pieces]
        if trainer.get(3, 1) != 2 or normal.get(2) or normal.get(4, 1) or not normal.get(5, 1):
            raise ValueError(f"{path}: not a BPE model with plain characters")
        if {USER_DEFINED, UNUSED} & set(kind) or any(MARK in x.lstrip(MARK) for x, k in zip(text, kind, strict=True) if k == NORMAL):
            raise ValueError(f"{path}: a piece crosses a marker, or is user-defined or unused")
        self.prefix = bool(normal.get(3, 1))
        self.ids = {x: i for i, (x, k) in enumerate(zip(text, kind, strict=True)) if k == NORMAL}
        self.scores = {x: struct.unpack("<f", pieces[i].get(2, b"\0\0\0\0"))[0] for x, i in self.ids.items()}
        self.bytes = {int(x[3:5], 16): i for i, (x, k) in enumerate(zip(text, kind, strict=True)) if k == BYTE}
        self.unknown = kind.index(UNKNOWN)
        self.is_byte = np.array([k == BYTE for k in kind])
        labels = []
        for x, k in zip(text, kind, strict=True):
            plain = {CONTROL: "", UNKNOWN: trainer.get(44, " ⁇ ".encode()).decode()}.get(k, x.replace(MARK, " "))
            labels.append(bytes([int(x[3:5], 16)]) if k == BYTE else plain.encode())
        self.marked = np.array([k == NORMAL and x.startswith(MARK) for x, k in zip(text, kind, strict=True)])
        self.control = np.array([k == CONTROL for k in kind])
        self.lengths = np.array([len(x) for x in labels], dtype=np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.data = np.frombuffer(b"".join(labels), dtype=np.uint8)
        self.table: dict[str, np.ndarray] = {}
        self.older: dict[str, np.ndarray] = {}

    def segment(self, word: str) -> np.ndarray:
        """The ids of one marked word: neighbours whose joined piece has the best score
        (ties: the leftmost) are joined until none is left; what is no piece then goes as
        its bytes, or as unknown without byte pieces."""
        part = list(word)
        n = len(part)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        scores, queue = self.scores, []

        def offer(a: int, b: int) -> None:
            score = scores.get(part[a] + part[b])
            if score is not None:
                heapq.heappush(queue, (-score, a, b, len(part[a]) + len(part[b])))

        for i in range(n - 1):
            offer(i, i + 1)
        while queue:
            _, a, b, size = heapq.heappop(queue)
            if not part[a] or not part[b] or len(part[a]) + len(part[b]) != size:
                continue
            part[a] += part[b]
            part[b] = ""
            after[a] = after[b]
            if after[b] < n:
                before[after[b]] = a
                offer(a, after[b])
            if before[a] >= 0:
                offer(before[a], a)
        out: list[int] = []
        for x in part:
            if not x:
                continue
            known = self.ids.get(x)
            if known is not None:
                out.append(known)
            elif self.bytes:
                out += [self.bytes[b] for b in x.encode()]
            elif not out or out[-1] != self.unknown:
                out.append(self.unknown)
        return np.array(out, dtype=np.int32)

    def look_up(self, word: str) -> np.ndarray:
        """The ids of a word (its marker a space) from the table, or by segmenting it."""
        found = self.table.get(word)
        if found is None:
            found = self.older.get(word)
            if found is None:
                found = self.segment(word.replace(" ", MARK))
            if len(word) <= TABLE_LENGTH:
                if len(self.table) >= TABLE_WORDS:
                    self.table, self.older = {}, self.table
                self.table[word] = found
        return found

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """-> the ids of all texts in a row, and how many each text has."""
        texts = texts.cast(pa.large_string()).fill_null("")
        if pc.any(pc.match_substring(texts, MARK)).as_py():
            texts = pc.replace_substring(texts, MARK, " ")
        # Whether or not a model adds a marker, each text's first word begins one here.
        marked = pc.if_else(pc.equal(pc.binary_length(texts), 0), texts, pc.binary_join_element_wise(pa.scalar("", pa.large_string()), texts, pa.scalar(" ", pa.large_string())))
        ids, counts = [np.zeros(0, np.int32)], [np.zeros(0, np.int64)]
        for _, _, data, offsets in steps(marked):
            space = data == 0x20
            first = np.zeros(len(data) + 1, dtype=bool)
            first[offsets] = True
            start = np.flatnonzero(space & (first[:-1] | ~np.concatenate([[False], space[:-1]])))
            bounds = np.append(start, len(data)).astype(np.int64)
            words = pa.LargeStringArray.from_buffers(len(start), pa.py_buffer(bounds), pa.py_buffer(np.ascontiguousarray(data)))
            coded = words.dictionary_encode()
            own = coded.indices.to_numpy(zero_copy_only=False)
            distinct = [self.look_up(w) for w in coded.dictionary.to_pylist()]
            at_start = np.zeros(len(start), dtype=bool)
            if not self.prefix:
                at_start = first[start]
                extra = {w: self.segment(w[1:].replace(" ", MARK)) for w in {words[int(i)].as_py() for i in np.flatnonzero(at_start)}}
                number = {w: len(distinct) + i for i, w in enumerate(extra)}
                distinct += list(extra.values())
                own = own.copy()
                for i in np.flatnonzero(at_start):
                    own[i] = number[words[int(i)].as_py()]
            sizes = np.array([len(x) for x in distinct], dtype=np.int64)
            pool = np.concatenate(distinct) if distinct else np.zeros(0, np.int32)
            begins = np.cumsum(sizes) - sizes
            ids.append(pool[ranges(begins[own], sizes[own])] if len(own) else pool)
            so_far = np.concatenate([[0], np.cumsum(sizes[own])]) if len(own) else np.zeros(1, np.int64)
            counts.append(np.diff(so_far[np.searchsorted(start, offsets, side="left")]))
        return np.concatenate(ids), np.concatenate(counts).astype(np.int64)

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids: markers are spaces, one that a first piece begins with goes,
        runs of byte pieces are UTF-8 in which each wrong byte is U+FFFD."""
        if not len(ids):
            return ""
        spoken = ids[~self.control[ids]]
        try:
            # A control id between bytes ends their run.
            apart = len(spoken) < len(ids) and self.is_byte[ids].any()
            text = self._decode_runs(ids) if apart else self.data[ranges(self.starts[ids], self.lengths[ids])].tobytes().decode()
        except UnicodeDecodeError:
            text = self._decode_runs(ids)
        return text[1:] if self.prefix and len(spoken) and self.marked[spoken[0]] else text

    def _decode_runs(self, ids: np.ndarray) -> str:
        out, run = [], b""
        for i in [*ids.tolist(), -1]:
            if i >= 0 and self.is_byte[i]:
                run += self.data[self.starts[i] : self.starts[i] + 1].tobytes()
                continue
            at = 0
            while at < len(run):
                for size in (1, 2, 3, 4):
                    try:
                        out.append(run[at : at + size].decode())
                        at += size
                        break
                    except UnicodeDecodeError:
                        pass
                else:
                    out.append("�")
                    at += 1
            run = b""
            if i >= 0:
                out.append(self.data[self.starts[i] : self.starts[i] + self.lengths[i]].tobytes().decode())
        return "".join(out)


_loaded: dict[str, PieceModel] = {}


def model(path: str) -> PieceModel:
    """One model and one table of words for each file and Python worker."""
    if path not in _loaded:
        _loaded[path] = PieceModel(path)
    return _loaded[path]


def encode(df: DataFrame, path: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """-> ``(<id_column>, n_tokens long, ids array<int>)`` for every row: the ids of the
    whole text, without begin and end ids.

    ``path`` is the model file, the same on every executor.
    Defined cases: a null or empty text has no ids; a marker character in a text counts as
    a space; a very long word is segmented whole, in its length times the logarithm; a
    repeated row gives a repeated result; other columns are dropped.
    """
    rows = df.select(F.col(id_column), F.col(text_column).cast("string").alias(text_column))
    schema = rows.select(id_column).schema.add("n_tokens", "long").add("ids", T.ArrayType(T.IntegerType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model(path)
        for batch in batches:
            at = 0
            for i, j, _, _ in steps(batch.column(1)):
                ids, counts = m.encode(batch.column(1).slice(i, j - i))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, j - i), pa.array(counts), list_array(pa.array(ids, pa.int32()), counts)], names=[id_column, "n_tokens", "ids"])
                at = j

    return rows.mapInArrow(run, schema)


def decode(df: DataFrame, path: str, ids_column: str = "ids", out: str = "decoded") -> DataFrame:
    """``df`` with the text that its ``array<int>`` of ids stands for as column ``out``
    (null: an empty text; nulls in it are left out)."""
    schema = T.StructType([*df.schema.fields, T.StructField(out, T.StringType())])
    at = df.columns.index(ids_column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model(path)
        for batch in batches:
            for i in range(0, batch.num_rows, 512):
                part = batch.slice(i, 512)
                texts = [m.decode(x.values.drop_null().to_numpy()) if x.is_valid else "" for x in part.column(at)]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], names=[*part.schema.names, out])

    return df.mapInArrow(run, schema)


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op11_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = default_model()
    coded = decode(encode(table(spark, sf_dir, "documents"), path), path)
    return coded.select("doc_id", "n_tokens", F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"), F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"))


QUERIES = {"op11_sentencepiece": op11_sentencepiece}
ORACLES: dict[str, str] = {}

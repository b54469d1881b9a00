"""BPE encoding and decoding with a token automaton.

Method: the merges are compiled, in their order, into a deterministic automaton over
token labels. It starts as one state with an arc for each byte. The gadget of merge
``(u, v) -> w`` splits off the state after ``u``: it loses its arc ``v`` from then on,
and every state that had arc ``u`` gains arc ``w``, which leads where ``v`` led. After
all merges, the label sequences that the automaton accepts are exactly the token
sequences that applying the merges gives, and each text has one of them. The state
after a token depends on that token alone, so states are kept as a token's right spine
with the merge numbers between which each spine node was the rightmost token; an arc
exists if no gadget removed it in that time. Arcs that have been asked for are kept in
a transition table. A word is encoded by one pass over its bytes: for each reachable
position a byte trie gives the tokens that start there, the transition table says which
the state accepts, and each position is reached by one token at most. Decoding emits the
labels of the arcs.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomsite.llm.common import table
from loomsite.llm.hashing import list_array, ranges

#: Fixed value: the pre-split pattern of byte-level BPE vocabularies.
PRE_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: Words of which a worker keeps the ids, in each of two generations.
MEMO_WORDS = 300_000


def byte_letters() -> dict[str, int]:
    """Letter -> byte of byte-level vocabularies: printable bytes stand for themselves,
    the others for the code points from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class TokenAutomaton:
    """Compiled from a ``tokenizers`` JSON file with a byte-level BPE model."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters, model = byte_letters(), spec["model"]
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        ids = model["vocab"]
        self.labels: dict[int, bytes] = {i: bytes(letters[c] for c in t) for t, i in ids.items() if t not in self.special}
        self.labels |= {i: t.encode() for t, i in self.special.items()}
        size = max(self.labels) + 1
        never = len(model["merges"]) + 1
        left, right, made = {}, {}, {}
        #: lost[u][v]: the merge whose gadget takes arc v from the state after u.
        self.lost: dict[int, dict[int, int]] = {}
        for n, pair in enumerate(model["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            u, v, w = ids[a], ids[b], ids[a + b]
            self.lost.setdefault(u, {}).setdefault(v, n)
            if w not in made:
                left[w], right[w], made[w] = u, v, n
        self.left, self.right, self.made, self.never = left, right, made, never
        self.arcs: dict[int, bool] = {}
        self.size = size
        # A trie of the labels: (node, byte) -> node, and the token that ends at a node.
        self.next: dict[int, int] = {}
        self.token_at = [-1]
        for i, label in self.labels.items():
            if i in self.special.values():
                continue
            node = 0
            for byte in label:
                node = self.next.setdefault(node << 8 | byte, len(self.token_at))
                if node == len(self.token_at):
                    self.token_at.append(-1)
            self.token_at[node] = i
        # Labels as one buffer, for decoding whole columns.
        lengths = np.zeros(size, dtype=np.int64)
        for i, label in self.labels.items():
            lengths[i] = len(label)
        self.label_lengths = lengths
        self.label_starts = np.cumsum(lengths) - lengths
        self.label_bytes = np.frombuffer(b"".join(self.labels.get(i, b"") for i in range(size)), dtype=np.uint8)

    def arc(self, state: int, token: int) -> bool:
        """Whether the state after token ``state`` (-1: the start) has arc ``token``."""
        if state < 0:
            return True
        key = state * self.size + token
        known = self.arcs.get(key)
        if known is None:
            known = self.arcs[key] = self._compile_arc(state, token)
            if len(self.arcs) > 4_000_000:
                self.arcs = {}
        return known

    def _compile_arc(self, state: int, token: int) -> bool:
        spine, node, until = [], token, self.never
        while True:
            spine.append((node, until))
            if node not in self.made:
                break
            until, node = self.made[node], self.left[node]
        node, until = state, self.never
        while True:
            lost = self.lost.get(node)
            if lost:
                for first, first_until in spine:
                    n = lost.get(first)
                    # Among equal merges the leftmost goes first: it wins inside the
                    # left token and loses inside the right one.
                    if n is not None and n < until and n <= first_until:
                        return False
            if node not in self.made:
                return True
            until, node = self.made[node], self.right[node]

    def encode_word(self, word: bytes) -> list[int]:
        n = len(word)
        last = [-2] * (n + 1)
        last[0] = -1
        step, token_at, arcs, size = self.next, self.token_at, self.arcs, self.size
        for i in range(n):
            state = last[i]
            if state == -2:
                continue
            node, base = 0, state * size
            for j in range(i, n):
                node = step.get(node << 8 | word[j])
                if node is None:
                    break
                t = token_at[node]
                if t >= 0 and last[j + 1] == -2:
                    ok = True if state < 0 else arcs.get(base + t)
                    if ok is None:
                        ok = self.arc(state, t)
                        arcs = self.arcs
                    if ok:
                        last[j + 1] = t
        out, at = [], n
        while at:
            t = last[at]
            out.append(t)
            at -= len(self.labels[t])
        out.reverse()
        return out

    def decode(self, ids: np.ndarray) -> np.ndarray:
        """The bytes of the labels of ``ids``."""
        return self.label_bytes[ranges(self.label_starts[ids], self.label_lengths[ids])]


class _Memo(dict):
    """Word -> its ids as little-endian 32-bit integers; two bounded generations."""

    def __init__(self, automaton: TokenAutomaton):
        super().__init__()
        self.automaton, self.older = automaton, {}

    def __missing__(self, word: str) -> bytes:
        found = self.older.get(word)
        if found is None:
            found = np.array(self.automaton.encode_word(word.encode()), dtype="<u4").tobytes()
        if len(word) <= 64:
            if len(self) >= MEMO_WORDS:
                self.older = dict(self)
                self.clear()
            self[word] = found
        return found


_loaded: dict[str, tuple[TokenAutomaton, _Memo]] = {}


def automaton(path: str) -> tuple[TokenAutomaton, _Memo]:
    """One automaton for each file and Python worker."""
    if path not in _loaded:
        a = TokenAutomaton(path)
        _loaded[path] = a, _Memo(a)
    return _loaded[path]


_split = regex.compile(PRE_SPLIT).findall


def encode_text(text: str, path: str) -> bytes:
    a, memo = automaton(path)
    if not any(s in text for s in a.special):
        return b"".join(map(memo.__getitem__, _split(text)))
    parts = regex.split("(" + "|".join(map(regex.escape, a.special)) + ")", text)
    return b"".join(
        np.array([a.special[p]], dtype="<u4").tobytes() if p in a.special else b"".join(map(memo.__getitem__, _split(p)))
        for p in parts
    )


def encode(df: DataFrame, tokenizer: str, id_column: str = "doc_id", text_column: str = "text", arrays: bool = False) -> DataFrame:
    """-> ``(<id_column>, n_tokens long, ids)`` for every row: the ids of the whole text,
    as little-endian unsigned 32-bit integers in a binary or, with ``arrays``, as an
    ``array<int>``.

    ``tokenizer`` is the path of the vocabulary file, the same on every executor.
    Defined cases: a null or empty text has no ids; strings of special tokens in a text
    become their ids; a repeated row gives a repeated result; other columns are dropped.
    """
    rows = df.select(F.col(id_column), F.col(text_column).cast("string").alias(text_column))
    schema = rows.select(id_column).schema.add("n_tokens", "long").add("ids", T.ArrayType(T.IntegerType()) if arrays else T.BinaryType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key, texts = batch.column(0), batch.column(1)
            for i in range(0, batch.num_rows, 512):
                ids = [encode_text(t, tokenizer) if t else b"" for t in texts.slice(i, 512).to_pylist()]
                n = np.array([len(x) // 4 for x in ids], dtype=np.int64)
                if arrays:
                    coded = list_array(pa.array(np.frombuffer(b"".join(ids), dtype="<i4")), n)
                else:
                    coded = pa.array(ids, pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [key.slice(i, 512), pa.array(n), coded],
                    names=[id_column, "n_tokens", "ids"],
                )

    return rows.mapInArrow(run, schema)


def decode(df: DataFrame, tokenizer: str, ids_column: str = "ids", out: str = "decoded") -> DataFrame:
    """``df`` with the text that its ids stand for as column ``out`` (null ids: an empty
    text); bytes that are no valid UTF-8 become U+FFFD."""
    schema = T.StructType([*df.schema.fields, T.StructField(out, T.StringType())])
    at = df.columns.index(ids_column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, _ = automaton(tokenizer)
        for batch in batches:
            for i in range(0, batch.num_rows, 512):
                part = batch.slice(i, 512)
                texts = []
                for ids in part.column(at).to_pylist():
                    texts.append(a.decode(np.frombuffer(ids or b"", dtype="<u4")).tobytes().decode("utf-8", "replace"))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], names=[*part.schema.names, out])

    return df.mapInArrow(run, schema)


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op6_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = default_tokenizer()
    coded = decode(encode(table(spark, sf_dir, "documents"), path), path)
    return coded.select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"),
    )


QUERIES = {"op6_bpe_codec": op6_bpe_codec}
ORACLES: dict[str, str] = {}

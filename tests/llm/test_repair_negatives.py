"""Conversation repair, hard negatives and pieces against plain restatements."""

import hashlib
import os
import random
import zlib

import pytest
from pyspark.sql import functions as F

from loomsite.llm import repair as rp

SMALL = "/root/testdata/sf0.001"
WHITE = " \t\n\x0b\x0c\r"


def plain_repair(rows):
    """rows (turn, role, text) after damage -> counts, audit, digest; all strings of edits of
    a state are kept whole."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    turns = [t for t, _, _ in rows if t is not None]
    n = {"gaps": max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, "blank": 0, "duplicate": 0, "truncated": 0}
    n["illegal"] = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    step = {"": "u", "s": "u", "u": "a", "a": "u"}
    best = {"": (0, "", ())}

    def grow(now):
        for _ in range(3):
            for q, (c, e, out) in list(now.items()):
                new = (c + 3, e + "I", (*out, (step[q], "")))
                if step[q] not in now or new < now[step[q]]:
                    now[step[q]] = new
        return now

    seen = set()
    for _, role, text in rows:
        body = text.strip(WHITE)
        fault = "blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else None
        seen.add((role, text))
        if fault:
            n[fault] += 1
        more, new = 3 * (fault == "truncated"), {}
        for q, (c, e, out) in grow(best).items():
            ways = [(q, (c + 4, e + "D", out))]
            if fault not in ("blank", "duplicate"):
                if q == "" and role[:1] == "s":
                    ways.append(("s", (c + more, e + "K", (*out, (role, text)))))
                if role[:1] == step[q]:
                    ways.append((step[q], (c + more, e + "K", (*out, (role, text)))))
                ways.append((step[q], (c + 3 + more, e + "R", (*out, (step[q], text)))))
            for s, w in ways:
                if s not in new or w < new[s]:
                    new[s] = w
        best = new
    cost, audit, out = min(x for s, x in grow(best).items() if s in ("", "a"))
    names = {"u": "user", "a": "assistant"}
    lines = "\n".join(f"{names.get(r, r)}:{t}" for r, t in out)
    return {**n, "cost": cost, "audit": audit, "repaired_sha256": hashlib.sha256(lines.encode()).hexdigest()}


def plain_damage(conv, turn, role, text):
    role, text = " " if role is None else role, " " if text is None else text
    kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
    if kind == 0:
        return []
    text = "" if kind == 1 else text.replace(".", "").replace("!", "").replace("?", "") if kind == 2 else text
    return [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)


def _plain(rows):
    found = {}
    for conv, turn, role, text in rows:
        found.setdefault(conv, []).extend(plain_damage(conv, turn, role, text))
    return {c: plain_repair(r) for c, r in found.items()}


def _got(df):
    rows = [r.asDict() for r in df.collect()]
    assert len(rows) == len({r["conv_id"] for r in rows})
    return {r.pop("conv_id"): r for r in rows}


def _conversations(n, turns, seed):
    r = random.Random(seed)
    rows = []
    for c in range(n):
        for t in range(r.randint(0, turns)):
            role = r.choice(["system", "user", "user", "assistant", "assistant", "tool", None, ""])
            text = r.choice(["Yes.", "No", "why?", "", " ", None, f"line {r.randint(0, 5)}!", "a\n.\t", "x" * 50])
            rows.append((c if c else None, None if r.random() < 0.05 else t + 2 * (r.random() < 0.1), role, text))
            if r.random() < 0.1:
                rows.append(rows[-1])
    return rows


SCHEMA = "conv_id long, turn long, role string, text string"


@pytest.mark.parametrize("long", [rp.LONG, 7])
def test_repair_equals_whole_strings(spark, long):
    """Nulls in each column, ties, repeated rows; conversations in one task and cut."""
    rows = _conversations(120, 24, 3)
    df = spark.createDataFrame(rows, SCHEMA).withColumn("piece", F.lit(1)).withColumn("cost", F.lit("x")).repartition(5)
    got = _got(rp.read_back(rp.repair(rp.damage(df), dropped="dropped", long=long)))
    assert got == _plain(rows)


def test_repair_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = _got(rp.op12_conversation_repair(spark, SMALL))
    assert got == _plain(rows)


def test_repair_empty_and_dropped(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert rp.read_back(rp.repair(none)).count() == 0
    one = spark.createDataFrame([(5, 1, "user", "Hi.", True)], SCHEMA + ", dropped boolean")
    (row,) = rp.read_back(rp.repair(one, dropped="dropped")).collect()
    assert (row.audit, row.cost, row.gaps, row.repaired_sha256) == ("", 0, 0, hashlib.sha256(b"").hexdigest())


def test_search_forgets_settled_edits():
    """A long conversation holds few edits at any time and gives the edits of the whole."""
    search, faults, out, most = rp.Search(), rp.Faults(), [], 0
    r = random.Random(1)
    rows = [(i, r.choice(["user", "assistant", "assistant", "system"]), r.choice(["Yes.", "No", ""]) + ("" if r.random() < 0.3 else f"{i}.")) for i in range(3000)]
    for turn, role, text in rows:
        search.step(role, text, faults.look(turn, role, text))
        out += search.settled()
        most = max(most, max(n.depth for _, n in search.alive.values()) - search.root.depth)
    cost, rest = search.end()
    want = plain_repair(rows)
    assert (cost, "".join(e for e, _, _ in out + rest)) == (want["cost"], want["audit"])
    assert most < 400 and len(rest) < 400


def test_very_long_text_and_plan(spark):
    text = "word " * 400_000
    df = spark.createDataFrame([(1, 0, "user", text + "."), (1, 1, "assistant", text)], SCHEMA)
    (row,) = rp.read_back(rp.repair(df)).collect()
    assert (row.truncated, row.audit, row.cost) == (1, "KK", 3)


def plain_mine(rows, is_anchor):
    """rows (id, label, vector) -> rows of the result, by plain integers."""
    import math

    seen = {}
    for i, label, v in rows:
        if i is None or label is None or not v or any(x is None or not math.isfinite(x) for x in v):
            continue
        new = (label, [math.floor(256 * x) for x in v])
        seen[i] = min(seen.get(i, new), new)
    out = set()
    for a, (label, v) in seen.items():
        if not is_anchor(a):
            continue
        scored = sorted((-sum(x * y for x, y in zip(v, w)), i, other) for i, (other, w) in seen.items() if i != a and len(w) == len(v))
        for s, p, other in [x for x in scored if x[2] == label][:5]:
            good = [x for x in scored if x[2] != label and -80 * s <= -100 * x[0] <= -100 * s][:5]
            out |= {(a, p, n, i, -s, -t) for n, (t, i, _) in enumerate(good, 1)}
    return out


@pytest.mark.parametrize("cell", [1 << 24, 64])
def test_negatives_equal_plain_integers(spark, cell, monkeypatch):
    """Nulls, ties, repeated rows and ids, other lengths, large values; one cell and many."""
    from loomsite.llm import negatives as ng

    monkeypatch.setattr(ng, "CELL", cell)
    r = random.Random(5)
    rows = []
    for i in range(300):
        v = [r.choice([0.1, 0.5, -0.3, r.random(), 40.0]) for _ in range(r.choice([8, 8, 8, 3]))]
        rows.append((i, r.choice([0, 1, 2]), v))
    rows += [rows[3], rows[4], (5, 0, [0.0] * 8), (None, 1, [1.0] * 8), (301, None, [1.0] * 8), (302, 1, None), (303, 1, [None] * 8), (304, 1, [float("nan")] * 8), (305, 1, []), (306, 1, [float("inf")] * 8), (310, 2, rows[10][2]), (320, 2, rows[10][2])]
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>").withColumn("dim", F.lit("x")).withColumn("id", F.lit(1))
    got = {tuple(x) for x in ng.mine(df, F.col("vec_id") % 10 == 0).collect()}
    want = plain_mine(rows, lambda i: i % 10 == 0)
    assert got == want and len(want) > 100
    assert ng.mine(df.where("false"), F.col("vec_id") % 10 == 0).count() == 0


def test_residue_products_are_exact():
    import numpy as np

    from loomsite.llm import negatives as ng

    r = np.random.default_rng(1)
    for size, dim in ((10, 5), (1 << 20, 40), (1 << 23, 2500)):
        a, b = r.integers(-size, size, (7, dim)), r.integers(-size, size, (9, dim))
        a[0], b[0] = size, -size
        want = np.array([[sum(int(x) * int(y) for x, y in zip(u, w)) for w in b] for u in a])
        primes = ng.primes_for(int(np.abs(want).max()) + dim * size)
        assert (ng.product(ng.residues(a, primes), ng.residues(b, primes), primes) == want).all()


TEXTS = [None, "", " ", "   two  spaces ", "▁marked▁", "a\nb\tc　d", "\x00\x1f", "né 中国 \U0001f600\U0001f600", "x" * 9000, " " * 700, "word " * 30000, "the cat", "the cat"]


def test_pieces_equal_library(spark):
    import public_tokenizers
    import sentencepiece

    from loomsite.llm import pieces

    path = public_tokenizers.path("piece_bpe_32k.model")
    known = sentencepiece.SentencePieceProcessor(model_file=path)
    r = random.Random(2)
    texts = TEXTS + ["".join(r.choice(" ▁abcd<0x\n\té中\U0001f600of the") for _ in range(r.randint(0, 50))) for _ in range(300)]
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, ids string").repartition(3)
    got = {x.doc_id: x for x in pieces.decode(pieces.encode(df, path), path).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        want = known.encode(t or "")
        assert (got[i].ids, got[i].n_tokens, got[i].decoded) == (want, len(want), known.decode(want)), t
    assert pieces.encode(df.where("false"), path).count() == 0


def test_pieces_decode_any_ids():
    import numpy as np
    import public_tokenizers
    import sentencepiece

    from loomsite.llm import pieces

    path = public_tokenizers.path("piece_bpe_32k.model")
    known, own, r = sentencepiece.SentencePieceProcessor(model_file=path), pieces.PieceModel(path), random.Random(3)
    for _ in range(2000):
        ids = [r.choice([r.randrange(32000), r.randrange(3, 259), r.randrange(3)]) for _ in range(r.randint(0, 12))]
        assert own.decode(np.array(ids, dtype=np.int32)) == known.decode(ids)


def test_pieces_segment_each_word_once(monkeypatch):
    """The table is what is segmented: one segmentation for each distinct marked word."""
    import pyarrow as pa
    import public_tokenizers

    from loomsite.llm import pieces

    own, asked = pieces.PieceModel(public_tokenizers.path("piece_bpe_32k.model")), []
    real = own.segment
    monkeypatch.setattr(own, "segment", lambda w: asked.append(w) or real(w))
    own.encode(pa.array(["a bee sees a bee", "sees a", None, "bee"]))
    assert sorted(asked) == ["▁a", "▁bee", "▁sees"]

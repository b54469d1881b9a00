"""Repair of conversation structure by a Viterbi search with survivor coalescence.

The edits of a conversation (keep, rerole, delete, insert) lead through four states: nothing
yet, after a system turn, after a user turn, after an assistant turn. For each state the
cheapest edits so far survive, ties by their letters. Survivors are leaves of a tree of
backpointers whose nodes count their children; where all survivors hang below one node,
the edits up to it are settled: they are emitted and forgotten. A survivor that costs more
than another one and whatever it takes to follow it from there (``SLACK``) is given up,
so that hopeless ones don't hold the tree. Ties compare the whole unresolved suffixes, up to
the common ancestor. Two edit strings that consume the same rows and end with one of them
are never one the beginning of the other (insertions stand before the row they precede,
or at the end), so a tie that is decided stays decided whatever follows.

Turns are dealt by conversation and stream through tasks in sorted partitions. A
conversation of more than ``LONG`` turns is cut into segments of sorted turns instead, one
for each task: a segment is searched from each of the four states, the segments' costs
and order of ties are folded into one path, and each segment emits its part of that path.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomsite.llm.common import materialize, table

START, SYSTEM, USER, ASSISTANT = range(4)
STATES = (START, SYSTEM, USER, ASSISTANT)
#: Costs of edits and of a truncated turn that stays.
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
#: What following any other survivor costs at most: two insertions and a system turn deleted.
SLACK = 2 * INSERT + DELETE
#: A turn of this role leads from a state to the next one.
NEXT = {START: ("user", USER), SYSTEM: ("user", USER), USER: ("assistant", ASSISTANT), ASSISTANT: ("user", USER)}
#: Turns of a conversation that one task searches; longer ones are cut.
LONG = 100_000
#: Edits of an emitted piece, about.
PIECE = 4096

_WHITE = " \t\n\x0b\x0c\r"


class _Node:
    __slots__ = ("parent", "edit", "role", "text", "children", "depth")

    def __init__(self, parent: _Node | None, edit: str, role: str | None, text: str | None):
        self.parent, self.edit, self.role, self.text, self.children = parent, edit, role, text, 0
        self.depth = 0
        if parent is not None:
            self.depth = parent.depth + 1
            parent.children += 1


def _release(node: _Node) -> None:
    """A node that nothing hangs on any more goes, and so do its ancestors."""
    while node is not None and not node.children:
        up, node.parent = node.parent, None
        if up is not None:
            up.children -= 1
        node = up


def _precedes(a: _Node, b: _Node) -> bool:
    """Whether the edits up to ``a`` come before those up to ``b`` by their letters."""
    left, right = [], []
    while a is not b:
        if a.depth >= b.depth:
            left.append(a.edit)
            a = a.parent
        else:
            right.append(b.edit)
            b = b.parent
    return left[::-1] < right[::-1]


class Search:
    """The search over one conversation, or over a segment of it from ``entry``.

    ``step`` takes a turn, ``settled`` the edits that all survivors share as ``(edit, role,
    text)``, role null for deletions."""

    def __init__(self, entry: int = START):
        self.root = _Node(None, "", None, None)
        self.root.children = 1  # held by the search itself
        self.alive: dict[int, tuple[int, _Node]] = {entry: (0, self.root)}
        self.check = 64
        self.made: list[_Node] = []

    def _with_insertions(self) -> dict[int, tuple[int, _Node]]:
        """The survivors, and what one or two insertions make of them."""
        now = dict(self.alive)
        for _ in range(2):
            for state, (cost, node) in list(now.items()):
                role, goes = NEXT[state]
                self._offer(now, goes, cost + INSERT, node, "I", role, "")
        return now

    def _offer(self, found: dict[int, tuple[int, _Node]], state: int, cost: int, node: _Node, edit: str, role: str | None, text: str | None) -> None:
        known = found.get(state)
        if known is not None and known[0] < cost:
            return
        new = _Node(node, edit, role, text)
        self.made.append(new)
        if known is None or cost < known[0] or _precedes(new, known[1]):
            found[state] = (cost, new)

    def step(self, role: str, text: str, fault: str | None) -> None:
        self.made = [node for _, node in self.alive.values()]
        before = self._with_insertions()
        stays = TRUNCATED if fault == "truncated" else 0
        must_go = fault in ("blank", "duplicate")
        found: dict[int, tuple[int, _Node]] = {}
        for state, (cost, node) in before.items():
            self._offer(found, state, cost + DELETE, node, "D", None, None)
            if must_go:
                continue
            wanted, goes = NEXT[state]
            if state == START and role[:1] == "s":
                self._offer(found, SYSTEM, cost + stays, node, "K", role, text)
            if role[:1] == wanted[0]:
                self._offer(found, goes, cost + stays, node, "K", role, text)
            else:
                self._offer(found, goes, cost + REROLE + stays, node, "R", wanted, text)
        most = min(cost for cost, _ in found.values()) + SLACK
        self.alive = {s: x for s, x in found.items() if x[0] <= most}
        for _, node in self.alive.values():
            node.children += 1  # survivors are held until the others are gone
        for node in self.made:
            _release(node)
        for _, node in self.alive.values():
            node.children -= 1

    def settled(self, all_of: _Node | None = None) -> list[tuple[str, str | None, str | None]]:
        """Edits that are sure by now (or all up to the node ``all_of``); they are forgotten."""
        node = all_of or next(iter(self.alive.values()))[1]
        if all_of is None and node.depth - self.root.depth < self.check:
            return []
        chain = []
        while node is not self.root:
            chain.append(node)
            node = node.parent
        out = []
        ends = {id(n) for _, n in self.alive.values()}
        for node in reversed(chain):
            # The root is held by the search, and by its one child if that is settled.
            if all_of is None and (self.root.children > 2 or id(self.root) in ends):
                break
            out.append((node.edit, node.role, node.text))
            if all_of is None:
                self.root.children, node.parent, self.root = 0, None, node
                node.children += 1
        self.check = max(64, 2 * (len(chain) - len(out)))
        return out

    def end(self) -> tuple[int, list[tuple[str, str | None, str | None]]]:
        """The cost of the whole conversation and its edits that were not emitted yet."""
        best: tuple[int, _Node] | None = None
        for state, (cost, node) in self._with_insertions().items():
            if state in (START, ASSISTANT) and (best is None or cost < best[0] or (cost == best[0] and _precedes(node, best[1]))):
                best = (cost, node)
        return best[0], self.settled(best[1])


class Faults:
    """Counts of a conversation's turns, in their order; ``look`` gives a turn's fault."""

    def __init__(self):
        self.seen: set[bytes] = set()
        self.n = dict.fromkeys(("gaps", "blank", "duplicate", "truncated", "illegal", "cost"), 0)
        self.low = self.high = self.before = None
        self.turns = 0

    def look(self, turn: int | None, role: str, text: str, repeated: bool | None = None) -> str | None:
        if turn is not None:
            self.low = turn if self.low is None else self.low
            self.turns += self.high != turn
            self.high = turn
        if self.before is not None and self.before + role[:1] not in ("su", "ua", "au"):
            self.n["illegal"] += 1
        self.before = role[:1]
        if repeated is None:
            digest = hashlib.md5(f"{len(role)}:{role}{text}".encode()).digest()
            repeated = digest in self.seen
            self.seen.add(digest)
        said = text.rstrip(_WHITE)
        fault = "blank" if not said else "duplicate" if repeated else "truncated" if said[-1] not in ".!?" else None
        if fault:
            self.n[fault] += 1
        return fault

    def counts(self, cost: int) -> dict[str, int]:
        gaps = self.high - self.low + 1 - self.turns if self.low is not None else 0
        return {**self.n, "gaps": gaps, "cost": cost}


COUNTS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
_TURN = T.ArrayType(T.StructType([T.StructField("role", T.StringType()), T.StructField("text", T.StringType())]))
_ARROW_TURN = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))


def _schema(id_field: T.StructField) -> T.StructType:
    return T.StructType([id_field, T.StructField("piece", T.LongType()), *[T.StructField(c, T.LongType()) for c in COUNTS], T.StructField("audit", T.StringType()), T.StructField("repaired", _TURN)])


class _Pieces:
    """Collects pieces and turns them into batches of bounded size."""

    def __init__(self, schema: T.StructType, kind: pa.DataType):
        self.names, self.kind, self.rows, self.size = schema.names, kind, [], 0

    def add(self, key, piece: int, edits: list, counts: dict[str, int] | None) -> None:
        turns = [{"role": r, "text": t} for _, r, t in edits if r is not None]
        self.rows.append((key, piece, *[(counts or {}).get(c, 0) for c in COUNTS], "".join(e for e, _, _ in edits), turns))
        self.size += len(edits) + 16

    def batch(self) -> pa.RecordBatch:
        kinds = [self.kind, *[pa.int64()] * (1 + len(COUNTS)), pa.string(), _ARROW_TURN]
        columns = zip(*self.rows, strict=True)
        self.rows, self.size = [], 0
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=self.names)


def _stream(schema: T.StructType) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: tuple = ()
        out = search = faults = None
        piece, waiting = 0, []
        for batch in batches:
            out = out or _Pieces(schema, batch.schema.field(0).type)
            for start in range(0, batch.num_rows, 1024):
                part = batch.slice(start, 1024)
                for key, turn, role, text, dropped in zip(*(c.to_pylist() for c in part.columns), strict=True):
                    if now != (key,):
                        if now:
                            cost, rest = search.end()
                            out.add(now[0], piece, waiting + rest, faults.counts(cost))
                        now, search, faults, piece, waiting = (key,), Search(), Faults(), 0, []
                        if out.size > 4 * PIECE:
                            yield out.batch()
                    if dropped:
                        continue
                    search.step(role, text, faults.look(turn, role, text))
                    waiting += search.settled()
                    if len(waiting) >= PIECE:
                        out.add(key, piece, waiting, None)
                        piece, waiting = piece + 1, []
                        yield out.batch()
        if now:
            cost, rest = search.end()
            out.add(now[0], piece, waiting + rest, faults.counts(cost))
            yield out.batch()

    return run


def _cut_conversations(rows: DataFrame, id_column: str, length: int) -> DataFrame:
    """Pieces of conversations that are too long for one task."""
    id_field = rows.schema[id_column]
    name = id_field.name
    n = max(1, -(-rows.count() // length))
    # A segment is a conversation's part of a range of all sorted turns; rows that agree in
    # the columns of the ranges are in one of them.
    dealt = rows.where("not dropped").withColumn("d", F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text")))
    dealt = dealt.repartitionByRange(n, F.col(name), F.col("turn").asc_nulls_first(), "role", F.left("text", F.lit(64))).sortWithinPartitions(name, F.col("turn").asc_nulls_first(), "role", "text")
    at = materialize(dealt.select("*", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("at")), "repair-turns")
    same = F.col(name).eqNullSafe(F.col("__id")) & (F.col("d") == F.col("__d"))
    first = at.groupBy(F.col(name).alias("__id"), F.col("d").alias("__d")).agg(F.min("at").alias("__first"), F.count(F.lit(1)).alias("__n")).where("__n > 1").drop("__n")
    flagged = materialize(at.join(first, same, "left").select(name, "turn", "role", "text", "part", "at", F.coalesce(F.col("at") > F.col("__first"), F.lit(False)).alias("repeated")), "repair-segments")
    kind = {f.name: f for f in flagged.schema.fields}

    def turns(pdf: pd.DataFrame) -> tuple[pd.DataFrame, list]:
        pdf = pdf.sort_values("at")
        faults = Faults()
        number = [None if pd.isna(t) else int(t) for t in pdf["turn"]]
        seen = [(role, text, faults.look(turn, role, text, bool(again))) for turn, role, text, again in zip(number, pdf["role"], pdf["text"], pdf["repeated"], strict=True)]
        return faults, seen

    def searched(seen: list, entry: int) -> tuple[Search, list]:
        search, sure = Search(entry), []
        for x in seen:
            search.step(*x)
            sure += search.settled()
        return search, sure

    ends = T.StructType([kind[name], T.StructField("part", T.IntegerType()), *[T.StructField(c, T.LongType()) for c in ("blank", "duplicate", "truncated", "illegal", "low", "high", "turns")], T.StructField("first", T.StringType()), T.StructField("last", T.StringType()), T.StructField("paths", T.ArrayType(T.ArrayType(T.LongType())))])

    def survey(pdf: pd.DataFrame) -> pd.DataFrame:
        faults, seen = turns(pdf)
        paths = []
        for entry in STATES:
            search, _ = searched(seen, entry)
            ranked: list[int] = []
            for state, (_, node) in search.alive.items():
                i = 0
                while i < len(ranked) and not _precedes(node, search.alive[ranked[i]][1]):
                    i += 1
                ranked.insert(i, state)
            paths += [[entry, state, search.alive[state][0], i] for i, state in enumerate(ranked)]
        row = {name: pdf[name].iloc[0], "part": pdf["part"].iloc[0], **{c: faults.n[c] for c in ("blank", "duplicate", "truncated", "illegal")}, "low": faults.low, "high": faults.high, "turns": faults.turns,
               "first": seen[0][0][:1], "last": seen[-1][0][:1], "paths": paths}
        return pd.DataFrame([row]).astype({"low": "Int64", "high": "Int64"})

    surveyed = materialize(flagged.groupBy(name, "part").applyInPandas(survey, ends), "repair-paths")
    chosen = T.StructType([kind[name], T.StructField("part", T.IntegerType()), T.StructField("entry", T.IntegerType()), T.StructField("leaves", T.IntegerType()), T.StructField("is_last", T.BooleanType()), *[T.StructField(c, T.LongType()) for c in COUNTS]])

    def fold(pdf: pd.DataFrame) -> pd.DataFrame:
        # A few numbers for each segment, of which a conversation has one in LONG turns.
        pdf = pdf.sort_values("part")
        now, back = {START: (0, 0)}, []
        for paths in pdf["paths"]:
            best: dict[int, tuple] = {}
            for entry, state, cost, rank in (tuple(map(int, p)) for p in paths):
                if entry in now:
                    new = (now[entry][0] + cost, now[entry][1], rank, entry)
                    if state not in best or new[:2] < best[state][:2]:
                        best[state] = new
            order = sorted(best, key=lambda s: best[s][1:3])
            back.append({s: best[s][3] for s in best})
            now = {s: (best[s][0], order.index(s)) for s in best}
        more = {START: 0, SYSTEM: 2 * INSERT, USER: INSERT, ASSISTANT: 0}
        state = min(now, key=lambda s: (now[s][0] + more[s], now[s][1]))
        total = now[state][0] + more[state]
        out = []
        for part, steps in zip(reversed(pdf["part"].tolist()), reversed(back), strict=True):
            out.append((part, steps[state], state))
            state = steps[state]
        low, high, turns_, last_turn = None, None, 0, None
        illegal, last = int(pdf["illegal"].sum()), None
        for r in pdf.itertuples():
            if last is not None and last + r.first not in ("su", "ua", "au"):
                illegal += 1
            last = r.last
            if not pd.isna(r.low):
                low = int(r.low) if low is None else low
                turns_ += int(r.turns) - (last_turn == int(r.low))
                high = last_turn = int(r.high)
        counts = {**{c: int(pdf[c].sum()) for c in ("blank", "duplicate", "truncated")}, "illegal": illegal, "gaps": high - low + 1 - turns_ if low is not None else 0, "cost": total}
        rows = [(pdf[name].iloc[0], p, a, b, i == 0, *[counts[c] if i == 0 else 0 for c in COUNTS]) for i, (p, a, b) in enumerate(out)]
        return pd.DataFrame(rows, columns=chosen.names)

    path = surveyed.groupBy(name).applyInPandas(fold, chosen)
    out = _schema(id_field)

    def emit(pdf: pd.DataFrame, path: pd.DataFrame) -> pd.DataFrame:
        _, seen = turns(pdf)
        way = path.iloc[0]
        search, edits = searched(seen, int(way.entry))
        edits = edits + search.settled(search.alive[int(way.leaves)][1])
        state = int(way.leaves)
        while way.is_last and state not in (START, ASSISTANT):
            role, state = NEXT[state]
            edits.append(("I", role, ""))
        row = {name: pdf[name].iloc[0], "piece": int(way.part), **{c: int(way[c]) for c in COUNTS}, "audit": "".join(e for e, _, _ in edits), "repaired": [{"role": r, "text": t} for _, r, t in edits if r is not None]}
        return pd.DataFrame([row], columns=out.names)

    pieces = flagged.groupBy(name, "part").cogroup(path.groupBy(name, "part")).applyInPandas(emit, out)
    return pieces.repartition(name).sortWithinPartitions(name, "piece")


def repair(df: DataFrame, id_column: str = "conv_id", turn_column: str = "turn", role_column: str = "role", text_column: str = "text", dropped: str | None = None, long: int = LONG) -> DataFrame:
    """``df`` (conversation id, integer turn, role, text) -> ``(<id_column>, piece long, gaps,
    blank, duplicate, truncated, illegal, cost long, audit string, repaired array<struct<role,
    text>>)``.

    The pieces of a conversation, most have one, follow each other in one partition in their
    order: their audits and repaired turns joined are its own, and their counts add up.
    Rows of which the boolean column ``dropped`` holds only make their conversation known.
    Defined cases: a null role or text is one space; a null turn comes first and makes no
    gap; ties of a turn go by role, then text; repeated rows are duplicates; rows with a
    null id are one conversation; an empty table gives none; other columns are dropped.
    """
    lost = F.coalesce(F.col(dropped), F.lit(False)) if dropped else F.lit(False)
    name = "id" if id_column in ("turn", "role", "text", "dropped", "d", "part", "at", "repeated", "piece", *COUNTS) else id_column
    rows = df.select(F.col(id_column).alias(name), F.col(turn_column).cast("long").alias("turn"), F.coalesce(F.col(role_column).cast("string"), F.lit(" ")).alias("role"), F.coalesce(F.col(text_column).cast("string"), F.lit(" ")).alias("text"), lost.alias("dropped"))
    many = materialize(rows.groupBy(F.col(name).alias("__id")).agg(F.count(F.when(~F.col("dropped"), 1)).alias("n")).where(F.col("n") > long).select("__id"), "repair-long")
    same = F.col(name).eqNullSafe(F.col("__id"))
    cut = not many.isEmpty()
    short = rows.join(many, same, "left_anti") if cut else rows
    short = short.withColumn("text", F.when(~F.col("dropped"), F.col("text")))
    schema = _schema(rows.schema[name])
    out = short.repartition(name).sortWithinPartitions(name, F.col("turn").asc_nulls_first(), "role", "text").mapInArrow(_stream(schema), schema)
    if cut:
        out = out.unionByName(_cut_conversations(rows.join(many, same, "left_semi"), name, long))
    return out.withColumnRenamed(name, id_column)


def read_back(pieces: DataFrame) -> DataFrame:
    """The pieces of ``repair`` -> one row per conversation with its counts, its whole audit
    and ``repaired_sha256``, the digest of its turns as ``role:text`` lines. It reads pieces
    as a stream and keeps an audit and a running digest."""
    schema = T.StructType([pieces.schema[0], *[T.StructField(c, T.LongType()) for c in COUNTS], T.StructField("audit", T.StringType()), T.StructField("repaired_sha256", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: tuple = ()
        done, kinds = [], []

        def row() -> tuple:
            return (now[0], *counts, "".join(audit), digest.hexdigest())

        def flush() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*done, strict=True), kinds, strict=True)], names=schema.names)

        for batch in batches:
            kinds = [batch.schema.field(0).type, *[pa.int64()] * len(COUNTS), pa.string(), pa.string()]
            for i in range(batch.num_rows):
                key, _, *own, letters, turns = (c[i].as_py() for c in batch.columns)
                if now != (key,):
                    if now:
                        done.append(row())
                    now, counts, audit, digest, some = (key,), [0] * len(COUNTS), [], hashlib.sha256(), False
                counts = [a + b for a, b in zip(counts, own, strict=True)]
                audit.append(letters)
                for t in turns:
                    digest.update(f"{chr(10) if some else ''}{t['role']}:{t['text']}".encode())
                    some = True
            if len(done) >= 1000:
                yield flush()
                done = []
        if now:
            done.append(row())
            yield flush()

    return pieces.mapInArrow(run, schema)


def damage(df: DataFrame) -> DataFrame:
    """``conversations`` with faults: by the check sum of ``conv_id:turn`` a row is dropped
    (it stays with ``dropped`` true), emptied, stripped of its full stops, repeated, or made
    the user's. Nulls are one space."""
    def plain(c: str):
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(plain("conv_id"), F.lit(":"), plain("turn")).cast("binary")) % 20
    rows = df.select("conv_id", "turn", plain("role").alias("role"), plain("text").alias("text"), kind.alias("kind"))
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    copies = F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.select("conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), (F.col("kind") == 0).alias("dropped"), F.explode(copies).alias("copy")).drop("copy")


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_back(repair(damage(table(spark, sf_dir, "conversations")), dropped="dropped"))


def _then(path: str, cost: str, code: str) -> str:
    """SQL: a path of eight digits of cost and two letters for each edit, with one more."""
    return f"lpad(CAST(CAST({path}[1:8] AS INTEGER) + {cost} AS VARCHAR), 8, '0') || {path}[9:] || '{code}'"


def _stay(path: str, initial: str) -> str:
    return f"CASE WHEN fault IN (1, 2) THEN NULL WHEN role[1:1] = '{initial}' THEN {_then(path, 'more', 'K' + initial)} ELSE {_then(path, '3 + more', 'R' + initial)} END"


OP12_SQL = rf"""
WITH RECURSIVE crc AS (
  SELECT [list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, _: CASE WHEN c & 1 = 1 THEN xor(c >> 1, CAST(3988292384 AS BIGINT)) ELSE c >> 1 END) FOR i IN range(256)] AS t
), keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k
  FROM conversations
), kinds AS (
  SELECT keyed.*, xor(list_reduce([CAST(4294967295 AS BIGINT)] || [CAST(ascii(x) AS BIGINT) FOR x IN string_split(k, '')], lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), CAST(4294967295 AS BIGINT)) % 20 AS kind
  FROM keyed, crc
), harmed AS (
  SELECT conv_id, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM kinds, range(CASE kind WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)
), numbered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i,
    rtrim(text, chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' ') AS said
  FROM harmed
), r AS (
  SELECT *, CASE WHEN said = '' THEN 1 WHEN again > 1 THEN 2 WHEN right(said, 1) NOT IN ('.', '!', '?') THEN 3 ELSE 0 END AS fault, CASE WHEN fault = 3 THEN 3 ELSE 0 END AS more,
    lag(role[1:1]) OVER (PARTITION BY conv_id ORDER BY i) || role[1:1] AS pair
  FROM (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) AS again FROM numbered)
), p(conv_id, i, q, s, u, a) AS (
  SELECT DISTINCT conv_id, CAST(0 AS BIGINT), '00000000', CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR) FROM conversations
  UNION ALL
  SELECT conv_id, i, {_then('q', '4', 'D.')},
    least({_then('s', '4', 'D.')}, CASE WHEN fault NOT IN (1, 2) AND role[1:1] = 's' THEN {_then('q', 'more', 'Ks')} END),
    least({_then('u', '4', 'D.')}, {_stay('q', 'u')}, {_stay('s', 'u')}, {_stay('a', 'u')}),
    least({_then('a', '4', 'D.')}, {_stay('u', 'a')})
  FROM (
    SELECT x.*, least(oa, {_then('u', '3', 'Ia')}) AS a FROM (
      SELECT p.conv_id, r.i, role, fault, more, q, s, p.a AS oa, least(u, {_then('q', '3', 'Iu')}, {_then('s', '3', 'Iu')}, {_then('p.a', '3', 'Iu')}) AS u
      FROM p JOIN r ON r.conv_id IS NOT DISTINCT FROM p.conv_id AND r.i = p.i + 1
    ) x
  )
), ends AS (
  SELECT conv_id, least(q, a, {_then('v', '3', 'Ia')}) AS path FROM (
    SELECT conv_id, q, a, least(u, {_then('q', '3', 'Iu')}, {_then('s', '3', 'Iu')}) AS v FROM p
    QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY i DESC) = 1
  )
), edits AS (
  SELECT conv_id, path, k, path[7 + 2 * k:7 + 2 * k] AS edit, path[8 + 2 * k:8 + 2 * k] AS goes FROM ends, range(1, CAST((length(path) - 8) / 2 AS BIGINT) + 1) AS g(k)
), placed AS (
  SELECT *, count(*) FILTER (WHERE edit <> 'I') OVER (PARTITION BY conv_id ORDER BY k) AS i FROM edits
), told AS (
  SELECT placed.conv_id, string_agg(edit, '' ORDER BY k) AS audit,
    string_agg(CASE WHEN edit = 'K' THEN role WHEN goes = 'u' THEN 'user' ELSE 'assistant' END || ':' || CASE edit WHEN 'I' THEN '' ELSE text END, chr(10) ORDER BY k) FILTER (WHERE edit <> 'D') AS repaired
  FROM placed LEFT JOIN r ON r.conv_id IS NOT DISTINCT FROM placed.conv_id AND r.i = placed.i GROUP BY placed.conv_id
), counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (WHERE fault = 1) AS blank, count(*) FILTER (WHERE fault = 2) AS duplicate,
    count(*) FILTER (WHERE fault = 3) AS truncated, count(*) FILTER (WHERE pair NOT IN ('su', 'ua', 'au')) AS illegal
  FROM r GROUP BY conv_id
)
SELECT e.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
  coalesce(illegal, 0) AS illegal, CAST(path[1:8] AS BIGINT) AS cost, coalesce(audit, '') AS audit, sha256(coalesce(repaired, '')) AS repaired_sha256
FROM ends e LEFT JOIN told ON told.conv_id IS NOT DISTINCT FROM e.conv_id LEFT JOIN counts ON counts.conv_id IS NOT DISTINCT FROM e.conv_id
"""

QUERIES = {"op12_conversation_repair": op12_conversation_repair}
ORACLES = {"op12_conversation_repair": OP12_SQL}

"""The text operators against brute force on small inputs with odd rows."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from loomsite.llm import bpe, chat, decontam, jaccard, langid, linededup, substring, toxicity, urls, vecdedup

WORDS = ["alpha", "Beta", "gamma", "delta", "eps", "zeta", "eta", "théta", "x", "日本"]
SPLIT = re.compile(rb"[^\x20\x09-\x0D]+")


def make_docs(seed=3, n=60):
    rnd = random.Random(seed)
    base = [" ".join(rnd.choice(WORDS) + str(rnd.randint(0, 40)) for _ in range(60)) for _ in range(6)]
    rows = [(1000, None), (1001, ""), (1002, "  \n\t "), (1003, "one"), (1004, "one two three"), (1005, "one two three"), (1006, "x " * 3000)]
    for i in range(n):
        words = rnd.choice(base).split()
        for _ in range(rnd.choice([0, 0, 1, 2, 6])):
            words[rnd.randrange(len(words))] = rnd.choice(WORDS)
        cut = rnd.choice([5, 21, 60])
        sep = rnd.choice([" ", "\n", " \t"])
        rows.append((i, sep.join(words[:cut]) + rnd.choice(["", "\nthe same long line in many of the texts"])))
    return rows


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "extra", i) for i, t in make_docs()]
    return spark.createDataFrame(rows, "doc_id long, text string, tile string, n long")


def words_of(text):
    return SPLIT.findall((text or "").encode())


def components(ids, links):
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


@pytest.mark.parametrize("k,percent", [(4, 85), (5, 80), (2, 50)])
def test_jaccard_join(docs, k, percent):
    rows = {r.doc_id: r.text for r in docs.collect()}
    sets = {}
    for i, t in rows.items():
        w = [x.lower() if x.isascii() else x for x in words_of((t or "").translate({c: c + 32 for c in range(65, 91)}))]
        sets[i] = {tuple(w[j : j + k]) for j in range(max(1, len(w) - k + 1))} if w else set()
    links = [(a, b) for a in rows for b in rows if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    want = components(rows, links)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.jaccard_components(docs, k, percent).collect()}
    assert got == {i: (len(sets[i]), want[i]) for i in rows}
    block, jaccard.TILE_BLOCK = jaccard.TILE_BLOCK, 3
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.jaccard_components(docs, k, percent).collect()} == got
    jaccard.TILE_BLOCK = block
    kept = {r.doc_id for r in jaccard.keep_one(docs, k, percent).collect()}
    assert kept == {i for i in rows if want[i] == i}


def test_jaccard_of_empty_tables_and_null_ids(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert jaccard.jaccard_components(none).count() == 0
    odd = spark.createDataFrame([(None, "a b c d e f"), (1, "a b c d e f"), (1, "a b c d e f"), (2, "a b c d e f")], "doc_id long, text string")
    assert sorted((str(r.doc_id), str(r.component_id)) for r in jaccard.jaccard_components(odd).collect()) == [("1", "1"), ("1", "1"), ("2", "1"), ("None", "None")]
    # Document 5 has a copy of 1's text and a text near 7's: all three are one group.
    long = [f"w{i}" for i in range(40)]
    rows = [(1, "a b c d e f"), (5, "a b c d e f"), (5, " ".join(long)), (7, " ".join(long[:-1])), (8, "x")]
    got = {r.doc_id: r.component_id for r in jaccard.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: 1, 5: 1, 7: 1, 8: 8}


@pytest.mark.parametrize("k,m", [(20, 8), (4, 2)])
def test_substring_dedup(docs, k, m):
    rows = sorted((r.doc_id, r.text) for r in docs.collect())
    seen, want = set(), {}
    for i, t in rows:
        w = words_of(t)
        gone = np.zeros(len(w), dtype=bool)
        for p in range(len(w) - k + 1):
            s = tuple(w[p : p + k])
            if s in seen:
                gone[p : p + k] = True
            seen.add(s)
        body = b" ".join(x for x, g in zip(w, gone, strict=True) if not g)
        want[i] = (len(w), int(gone.sum()), hashlib.sha256(body).hexdigest())
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in substring.remove_repeats(docs, k, m).collect()}
    assert got == want


def test_repeated_spans_point_to_equal_words(docs):
    text = {r.doc_id: words_of(r.text) for r in docs.collect()}
    spans = substring.repeated_spans(docs, 20).collect()
    assert spans
    for s in spans:
        n = s.n + 19
        assert text[s.doc][s.start : s.start + n] == text[s.src_doc][s.src_start : s.src_start + n]
        assert (s.src_doc, s.src_start) < (s.doc, s.start)


def test_substring_verification(spark, tmp_path):
    """Edges of one byte point to wrong sources all the time: words at the source tell."""
    rnd = random.Random(5)
    core = "one two three four five six seven eight".split()
    rows = []
    for i in range(150):
        around = [rnd.choice(WORDS) + str(rnd.randint(0, 400)) for _ in range(40)]
        rows.append((i, " ".join(around[:20] + core + around[20:])))
        if i % 10 == 9:
            rows.append((1000 + i, rows[rnd.randrange(i)][1] + rnd.choice([" end", ""])))
    rows += [(2000, None), (2001, ""), (2002, rows[0][1]), (2002, rows[0][1]), (2003, "ab cd " * 20_000)]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, start int, n string")
    text = {i: words_of(t) for i, t in rows}

    def wrong(spans):
        return sum(text[s.doc][s.start : s.start + s.n + 19] != text[s.src_doc][s.src_start : s.src_start + s.n + 19] for s in spans)

    plain = df.selectExpr("doc_id AS doc", "text")
    assert wrong(substring._candidate_spans(plain, 20, 8, 0, 1).collect())
    assert not wrong(substring.repeated_spans(df, edge_bytes=1).collect())
    weak, full = ({(r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in substring.remove_repeats(df, edge_bytes=w).collect()} for w in (1, 6))
    assert weak == full
    removed = {i: n for i, _, n, _ in full}
    assert removed[2003] == 39_998 and removed[2000] == removed[2001] == 0 and removed[2002] == 48
    assert substring.remove_repeats(df.limit(0)).count() == 0


def test_line_dedup(spark):
    def one_edit(a, b):
        if abs(len(a) - len(b)) > 1:
            return False
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b, strict=True)) <= 1
        a, b = sorted((a, b), key=len)
        return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))

    rnd = random.Random(5)
    lines = ["the quick brown fox jumps over it", "short", "", "   ", "élan vital für alle Menschen hier", "a" * 40, "another line that is long enough"]
    rows = [(90, None, 1), (91, "", 1)]
    for i in range(40):
        own = []
        for _ in range(rnd.randint(1, 6)):
            x = rnd.choice(lines)
            if rnd.random() < 0.4 and len(x) > 20:
                j = rnd.randrange(len(x))
                x = x[:j] + rnd.choice(["", "Z", x[j] + "y"]) + x[j + 1 :]
            own.append(x)
        rows.append((i, "\n".join(own), 1))
    df = spark.createDataFrame(rows, "doc_id long, text string, n_lines int")
    places = [(i, j, x) for i, t, _ in rows if t is not None for j, x in enumerate(t.split("\n"))]
    long = [p for p in places if len(p[2]) >= 20 and p[2].strip()]
    first = {}
    for p in sorted(long):
        first.setdefault(p[2], p[:2])
    drop = {p[:2] for p in long if any(one_edit(p[2], y) and f < p[:2] for y, f in first.items())}
    want = {i: None if t is None else "\n".join(x for j, x in enumerate(t.split("\n")) if (i, j) not in drop) for i, t, _ in rows}
    out = linededup.dedup_lines(df, min_chars=20, counts=("all", "gone"))
    assert out.columns == ["doc_id", "text", "n_lines", "all", "gone"]
    assert {r.doc_id: r.text for r in out.collect()} == want
    assert linededup.dedup_lines(df.limit(0)).count() == 0


def test_line_dedup_of_long_lines_and_repeated_rows(spark):
    rnd = random.Random(9)
    base = "".join(rnd.choice("abcé日") for _ in range(1300))
    near = [base[:i] + x + base[i + n :] for i, x, n in ((0, "", 1), (255, "Z", 1), (256, "", 1), (257, "Q", 0), (700, "", 1), (1299, "!", 1), (1300, "!", 0), (512, "xy", 2))]
    rows = [(0, base), (1, near[0]), (2, near[1]), (3, near[2]), (4, near[3]), (5, near[4]), (6, near[5]), (7, near[6]), (8, near[7]), (9, base[:-40]), (1, near[0]), (10, "tail\n" + base + base)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for block in (256, 7, 1300, 1301):
        linededup.BLOCK = block
        got = sorted((r.doc_id, r.text) for r in linededup.dedup_lines(df).collect())
        assert [i for i, t in got if t == ""] == [1, 1, 2, 3, 4, 5, 6, 7] and got[-1] == (10, "tail\n" + base + base)
    linededup.BLOCK = 256


def test_line_dedup_takes_short_lines(spark, tmp_path):
    import corpus_pipeline

    texts = {0: "yes\nok\n\nshort line", 1: "ok\nyes\n\r\na", 2: "yet\nshort lines\n\r\nb", 3: "no match\n \n ", 4: "short  lines\nx\nno match", 5: None}
    lengths = {i: None if t is None else len(t) for i, t in texts.items()}
    df = spark.createDataFrame([(i, t, lengths[i]) for i, t in texts.items()], "doc_id long, text string, n_chars long")
    df.write.parquet(f"{tmp_path}/documents.parquet")
    places = sorted((i, j, x) for i, t in texts.items() if t is not None for j, x in enumerate(t.split("\n")) if x.strip())

    def near(a, b):
        less = lambda s: {s[:i] + s[i + 1 :] for i in range(len(s))}
        return a == b or a in less(b) or b in less(a) or len(a) == len(b) and sum(x != y for x, y in zip(a, b, strict=True)) == 1

    gone = {p[:2] for p in places if any(q[:2] < p[:2] and near(p[2], q[2]) for q in places)}
    want = {i: "\n".join(x for j, x in enumerate((t or "").split("\n")) if (i, j) not in gone) for i, t in texts.items()}
    got = {r.doc_id: (r.kept_sha256, r.n_removed_lines) for r in linededup.op5_line_dedup(spark, str(tmp_path)).collect()}
    assert got == {i: (hashlib.sha256(t.encode()).hexdigest(), sum(g[0] == i for g in gone)) for i, t in want.items()} and len(gone) >= 6
    left = {r.doc_id: r.text or "" for r in corpus_pipeline.line_dedup(spark, df, str(tmp_path)).collect()}
    solid = lambda t: len(re.sub(r"\s", "", t or ""))
    assert left == {i: t for i, t in want.items() if solid(t) > corpus_pipeline.MIN_LEFT * solid(texts[i]) or not any(g[0] == i for g in gone)}
    clash = df.withColumn("lines", F.lit(1)).withColumn("removed", F.lit(2)).withColumn("n_lines", F.lit(3))
    assert corpus_pipeline.line_dedup(spark, clash, str(tmp_path)).columns == clash.columns


def test_decontamination(spark):
    rnd = random.Random(2)
    vocabulary = [f"w{i}" for i in range(300)]
    items = [(i, " ".join(rnd.choice(vocabulary) for _ in range(rnd.choice([8, 20, 40])))) for i in range(8)]
    items += [(20, None), (21, ""), (22, "Two words")]
    rows = [(500, None), (501, "")]
    for i in range(40):
        w = [rnd.choice(vocabulary) for _ in range(80)]
        item = items[i % 8][1].split()
        kind = i % 4
        if kind:
            item = list(item)
            if kind == 2 and len(item) == 40:
                item[20] = "changed"
            if kind == 3:
                item = item[: len(item) // 2]
            w[30:30] = item
        if i == 39:
            w += ["two", "WORDS!"]
        rows.append((i, " ".join(w).upper() if i % 3 == 0 else ", ".join(w)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontam.leaks(docs, bench).collect()}
    want = set()
    for d, t in rows:
        w = re.findall(r"\w+", (t or "").lower())
        for i, x in items:
            v = re.findall(r"\w+", (x or "").lower())
            if not v:
                continue
            k = min(5, len(v))
            own = [tuple(v[j : j + k]) for j in range(len(v) - k + 1)]
            for s in range(-len(v) + 1, len(w)):
                win = w[max(0, s) : s + len(v)]
                other = [tuple(win[j : j + k]) for j in range(len(win) - k + 1)]
                if not other:
                    continue
                shared = sum(min(own.count(g), other.count(g)) for g in set(own))
                if 100 * shared >= 80 * (len(own) + len(other) - shared):
                    want.add((d, i))
                    break
    assert got == want and len(got) > 8
    left = {r.doc_id for r in decontam.drop_leaking(docs, bench).collect()}
    assert left == {d for d, _ in rows} - {d for d, _ in got}
    assert {(r.doc_id, r.item_id) for r in decontam.leaks(docs, bench, exact=True).collect()} == want
    assert decontam.leaks(docs, bench.limit(0)).columns == ["doc_id", "item_id", "start", "n_words", "similarity"]
    assert decontam.leaks(docs.limit(0), bench).count() == 0
    twice = docs.union(docs).withColumn("item_id", F.lit("x")).withColumn("w", F.lit(1)).withColumn("n", F.lit(1))
    assert {(r.doc_id, r.item_id) for r in decontam.leaks(twice, bench).collect()} == want
    assert decontam.drop_leaking(twice, bench).columns == twice.columns


def test_fingerprints_find_pairs_at_the_limit(spark):
    """Recall of the fingerprints alone, for pairs of sets that are 0.8 similar, 40 shingles each."""
    rnd = random.Random(17)

    def of():
        return rnd.randrange(-(1 << 63), 1 << 63)

    rows = []
    for i in range(400):
        shared = [of() for _ in range(40)]
        rows.append((i, shared + [of() for _ in range(5)], shared + [of() for _ in range(5)]))
    df = spark.createDataFrame(rows, "i int, wh array<long>, ih array<long>")
    df = df.withColumn("f", decontam.fingerprint("wh")).withColumn("g", decontam.fingerprint("ih")).withColumn("d", decontam.differing_bits(F.col("f"), F.col("g")))
    found = df.where(F.col("d") <= decontam.RADIUS).withColumn("x", decontam._blocks("f")).withColumn("y", decontam._blocks("g")).collect()
    assert len(found) >= 0.99 * len(rows)
    # Within the radius, one block at least is within its share of it.
    assert all(min((a.part ^ b.part).bit_count() for a, b in zip(r.x, r.y, strict=True)) <= decontam.RADIUS // decontam.BLOCKS for r in found)
    assert len(decontam.block_masks(3)) == 697


def test_decontamination_in_another_order(spark):
    a, b = [f"a{i}" for i in range(30)], [f"b{i}" for i in range(70)]
    long, short = a + b, [f"c{i}" for i in range(40)]
    items = [(1, " ".join(long)), (2, " ".join(short)), (3, "p q p q p q p q p q p q")]
    junk = [f"j{i}" for i in range(200)]
    rows = [
        (0, junk[:60] + b + a + junk[60:120]),
        (1, b + a),
        (2, junk[:9] + b[:40] + a + b[40:]),
        (3, junk[:70] + short[20:] + short[:20] + junk[70:90]),
        (4, junk + short[4:]),
        (5, junk[:50] + "q p q p q p q p q p q p".split()),
        (6, junk[:80] + b + junk[80:110] + a),
        (7, junk),
    ]
    want = {}
    for d, w in rows:
        for i, x in items:
            v = x.split()
            own = [tuple(v[j : j + 5]) for j in range(len(v) - 4)]
            for s in range(-len(v) + 1, len(w)):
                win = w[max(0, s) : s + len(v)]
                other = [tuple(win[j : j + 5]) for j in range(len(win) - 4)]
                shared = sum(min(own.count(g), other.count(g)) for g in set(own))
                union = len(own) + len(other) - shared
                if other and 100 * shared >= 80 * union:
                    want[d, i] = max(want.get((d, i), (0,)), (shared / union, -max(0, s), len(win)))
    docs = spark.createDataFrame([(d, " ".join(w)) for d, w in rows], "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id): (r.similarity, -r.start, r.n_words) for r in decontam.leaks(docs, bench).collect()}
    assert got == want and {(0, 1), (1, 1), (2, 1), (3, 2), (4, 2), (5, 3)} >= set(want) >= {(0, 1), (1, 1)}
    assert not {0, 1} & {r.doc_id for r in decontam.drop_leaking(docs, bench).collect()}


def test_bpe_equals_the_library(spark):
    from tokenizers import Tokenizer

    path = bpe.default_tokenizer()
    library = Tokenizer.from_file(path)
    rnd = random.Random(1)
    pieces = ["a", "the", "ing", " ", "  ", "\n", "'s", "é", "日本", "😀", "<|endoftext|>", "\x85", "123", "!?", "aaaa", "\u0301"]
    texts = ["".join(rnd.choice(pieces) for _ in range(rnd.randint(0, 40))) for _ in range(300)] + ["ab" * 5000, "", None]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in bpe.decode(bpe.encode(df, path), path).collect():
        ids = library.encode(texts[r.doc_id] or "", add_special_tokens=False).ids
        assert np.frombuffer(r.ids, "<u4").tolist() == ids and r.n_tokens == len(ids)
        assert r.decoded == library.decode(ids, skip_special_tokens=False)
    assert bpe.encode(df.limit(5), path, arrays=True).collect()[0].ids is not None


def test_chats_round_trip(spark):
    rnd = random.Random(4)
    bits = ["\\", "#", "<", "</turn>", "### user: ", "\n", "é", "ok ", ":", ""]
    rows = [(c, t, rnd.choice(["user", "assistant", "a:b#", None]), None if rnd.random() < 0.1 else "".join(rnd.choice(bits) for _ in range(6))) for c in range(40) for t in range(rnd.randint(1, 9))]
    rows += [(99, t, "assistant", "long " * 400_000) for t in range(3)] + [(None, 0, "user", "x")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    by = {}
    for c, t, role, text in rows:
        by.setdefault(c, []).append((t, role or "", text or ""))
    pieces = {}
    for r in chat.format_chats(df).collect():
        pieces.setdefault(r.conv_id, []).append((r.piece, r.formatted, list(zip(r.loss_starts, r.loss_chars, strict=True))))
    assert len(pieces[99]) > 1
    for c, own in by.items():
        own.sort()
        whole = "".join(p[1] for p in sorted(pieces[c]))
        assert chat.parse(whole) == [(role, text) for _, role, text in own]
        lost = [chat.unescape(f[a : a + n]) for _, f, spans in sorted(pieces[c]) for a, n in spans]
        assert lost == [text for _, role, text in own if role == "assistant"]
    back = {r.conv_id: r for r in chat.read_back(chat.format_chats(df)).collect()}
    for c, own in by.items():
        own.sort()
        said = "".join(f"{role}\n{text}\n" for _, role, text in own)
        assert back[c].turns_sha256 == hashlib.sha256(said.encode()).hexdigest() and back[c].n_turns == len(own)
    assert chat.format_chats(df.limit(0)).count() == 0


def test_language_model_and_odd_texts(spark):
    rnd = random.Random(6)
    kinds = {"aa": "abcde", "bb": "fghij", "cc": "éüßñk"}
    rows = [(" ".join("".join(rnd.choice(letters) for _ in range(5)) for _ in range(30)), lang) for lang, letters in kinds.items() for _ in range(40)]
    model = langid.train([t for t, _ in rows], [y for _, y in rows])
    df = spark.createDataFrame([(0, rows[0][0]), (1, rows[50][0]), (2, rows[100][0]), (3, None), (4, ""), (5, "123 .,! \n"), (6, "abc " * 50_000)], "doc_id long, text string")
    got = {r.doc_id: (r.lang_pred, r.score) for r in langid.identify(df, model).collect()}
    assert [got[i][0] for i in range(7)] == ["aa", "bb", "cc", "und", "und", "und", "aa"]
    assert all(0 <= s <= 1 for _, s in got.values())
    assert langid.identify(df.limit(0), model).count() == 0


def test_toxicity_field(spark):
    rnd = random.Random(8)
    plain = ["".join(rnd.choice("abcdefgh") for _ in range(6)) for _ in range(400)]
    texts, marks = [], []
    for i in range(300):
        w = [rnd.choice(plain) for _ in range(80)]
        if i % 3 == 0:
            for _ in range(2):
                w[rnd.randrange(80)] = "Zork" + "".join(rnd.choice("aeioulnst") for _ in range(4)) + rnd.choice(["", ","])
        texts.append(" ".join(w))
        marks.append(int(i % 3 == 0))
    field = toxicity.train(texts, marks)
    clean, bad = " ".join(plain[:500]), "é " + " ".join(plain[:100]) + " zorkito! " + " ".join(plain[:100])
    df = spark.createDataFrame([(0, clean), (1, bad), (2, None), (3, ""), (4, " ".join(plain) * 30 + " zorkish")], "doc_id long, text string")
    got = {r.doc_id: r for r in toxicity.score_texts(df, field).collect()}
    assert [got[i].score >= toxicity.LIMIT for i in range(5)] == [False, True, False, False, True]
    assert [bad[a:b] for a, b in zip(got[1].span_starts, got[1].span_ends, strict=True)] == ["zorkito"]
    assert {r.doc_id for r in toxicity.keep_clean(df, field).collect()} == {0, 2, 3}


@pytest.mark.parametrize("labels", [5, 20, 200])
def test_toxicity_learns_from_few_labels(labels):
    """Recall and false alarms on texts that training hasn't seen; a fifth of the toxic labels is wrong."""
    rnd = random.Random(labels)
    sounds = ["an", "the", "ing", "on", "er", "re", "st", "ou", "ea", "nd"]
    bad = ["zorkling", "blatsch", "gromwitz", "pfuideix"]

    def text(toxic):
        w = ["".join(rnd.choice(sounds) for _ in range(rnd.randint(1, 4))) for _ in range(120)]
        for _ in range(5 if toxic else 0):
            w[rnd.randrange(120)] = rnd.choice(bad)
        return " ".join(w)

    texts, marks = [], []
    for i in range(labels * 6):
        toxic = i < labels
        texts.append(text(toxic and i % 5 > 0))
        marks.append(int(toxic))
    field = toxicity.train(texts, marks)

    def score(some):
        out = []
        for _, _, data, offsets in toxicity.steps(toxicity.pa.array(some)):
            start, end, first = toxicity.words(data, offsets, toxicity.ALNUM)
            weight, known = field.emissions(data, start, end)
            x = toxicity._summary(toxicity.token_marginals(field, weight, known, first), first)
            out += (1 / (1 + np.exp(-x @ field.logistic))).tolist()
        return np.array(out)

    assert (score([text(True) for _ in range(100)]) >= toxicity.LIMIT).mean() >= 0.8
    assert (score([text(False) for _ in range(100)]) >= toxicity.LIMIT).mean() <= 0.03
    none = toxicity.train(texts, [0] * len(texts))
    assert not len(none.keys)


def test_held_out_rows_teach_nothing(spark, tmp_path):
    """op2 and op3 on a folder whose held-out rows have wrong labels: they must not follow them."""
    import zlib

    rnd = random.Random(31)
    rows, labels = [], []
    for i in range(240):
        lang, letters = rnd.choice([("xx", "abcde"), ("yy", "fghij")])
        toxic = i % 4 == 0
        w = ["".join(rnd.choice(letters) for _ in range(5)) for _ in range(60)]
        if toxic:
            w[7] = w[30] = w[50] = rnd.choice(["zorkling", "blatsch"])
        crc = zlib.crc32(str(i).encode())
        rows.append((i, " ".join(w), ("yy" if lang == "xx" else "xx") if crc % 3 == 1 else lang, "s", lang, toxic))
        labels.append((i, 1, int(toxic != (crc % 4 == 2))))
    spark.createDataFrame(rows, "doc_id long, text string, lang string, score string, truth string, bad boolean").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    got = {r.doc_id: r for r in langid.op2_language_id(spark, str(tmp_path)).collect()}
    assert len(got) == 240 and all(got[r[0]].held_out == (zlib.crc32(str(r[0]).encode()) % 3 == 1) for r in rows)
    assert sum(got[r[0]].lang_pred == r[4] for r in rows if got[r[0]].held_out) >= 0.95 * sum(g.held_out for g in got.values())
    got = {r.doc_id: r for r in toxicity.op3_toxicity(spark, str(tmp_path)).collect()}
    assert len(got) == 240 and all(got[r[0]].held_out == (zlib.crc32(str(r[0]).encode()) % 4 == 2) for r in rows)
    held = [r for r in rows if got[r[0]].held_out]
    assert sum(got[r[0]].predicted == int(r[5]) for r in held) >= 0.95 * len(held)
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, score string, truth string, bad boolean")
    field = toxicity.train(*toxicity.training_rows(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int").limit(0)))
    odd = docs.limit(3).union(docs.limit(3))
    assert toxicity.keep_clean(odd, field).count() == 6 and toxicity.keep_clean(docs.limit(0), field).columns == docs.columns


def test_marginals_equal_enumeration():
    rng = np.random.default_rng(0)
    score, moves = rng.normal(size=(1, 6)), rng.normal(size=(2, 2))
    total, one = 0.0, np.zeros(6)
    for code in range(64):
        tags = [code >> i & 1 for i in range(6)]
        weight = sum(np.exp(moves[s, tags[0]]) for s in (0, 1)) * np.exp(sum(score[0, i] for i in range(6) if tags[i]) + sum(moves[a, b] for a, b in zip(tags, tags[1:], strict=False)))
        total += weight
        one += weight * np.array(tags)
    assert np.allclose(toxicity.marginals(score, np.ones((1, 6), bool), moves)[0], one / total)


def test_vectors(spark):
    rng = np.random.default_rng(3)
    centers = rng.normal(size=(8, 16))
    rows = [(i, int(i % 3), (centers[i % 8] + rng.normal(scale=rng.choice([0.05, 0.2, 0.5]), size=16)).tolist()) for i in range(250)]
    rows += [(i + 1000, 1, rows[1][2]) for i in range(30)]
    rows += [(2000, None, rows[1][2]), (2001, 1, None), (2002, 1, [0.0] * 16), (2003, 1, [float("nan")] * 16), (2004, 1, [None] * 16), (2005, 1, []), (2006, 1, [1.0, 2.0])]
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>")
    good = [(i, y, np.array(v)) for i, y, v in rows if y is not None and v and len(v) == 16 and None not in v and np.isfinite(v).all() and np.any(v)]
    links = [(a, b) for a, ya, va in good for b, yb, vb in good if a < b and ya == yb and va @ vb / np.linalg.norm(va) / np.linalg.norm(vb) >= 0.93]
    n = {i: 0 for i, _, _ in rows}
    for a, b in links:
        n[a] += 1
        n[b] += 1
    want = components(n, links)
    for block in (512, 20):
        vecdedup.BLOCK = block
        got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in vecdedup.near_vectors(df).collect()}
        assert got == {i: (n[i], want[i], want[i] == i) for i in n}
    vecdedup.BLOCK = 2048
    named = df.withColumn("label", F.concat(F.lit("L"), F.col("label"))).withColumn("embedding", F.col("embedding").cast("array<float>")).withColumn("rep", F.lit(1)).withColumn("codes", F.lit(2))
    bucket, vecdedup.BUCKET = vecdedup.BUCKET, 8
    got = {r.vec_id: (r.n_links, r.component_id) for r in vecdedup.near_vectors(named).collect()}
    vecdedup.BUCKET = bucket
    assert got == {i: (n[i], want[i]) for i in n}
    assert vecdedup.near_vectors(df.limit(0)).count() == 0


def test_urls(spark):
    rows = [(0, None), (1, ""), (2, "no scheme"), (3, "http://"), (4, "HTTP://WWW.Example.COM/en/1?x#y"), (5, "http://example.com/en/7"), (6, "x://a.net#f"), (7, "http://a.net/de/x"), (7, "http://a.net/de/x"), (8, "http://notexample.com.evil/en/")]
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in urls.judge_urls(spark.createDataFrame(rows, "page_id long, url string"), urls.RULES).collect()}
    assert got[4] == ("www.example.com", "/en/1", "com/en/", "block")
    assert got[5] == ("example.com", "/en/7", "example.com/en/7", "allow")
    assert got[6][:3] == ("a.net", "", None) and got[7][2:] == ("net/de/", "allow")
    assert [got[i] for i in (0, 1, 2, 3)] == [("", "", None, "allow")] * 4 and got[8][2] is None


def test_url_templates_learn_from_labels(spark):
    rows = [(i, f"http://shop.test/{'spam' if i % 2 else 'good'}/item-{w}{i}/{i}", i % 2 if i < 80 else None) for i, w in enumerate(["word"] * 100)]
    rows += [(1000 + i, f"http://wiki.test/{chr(97 + i % 26)}{chr(97 + i // 26)}x/about", None) for i in range(60)]
    out = urls.judge_urls(spark.createDataFrame(rows, "page_id long, url string, bad int"), label_column="bad").collect()
    assert {r.page_id for r in out if r.verdict == "block"} == {i for i in range(100) if i % 2}
    assert {r.template for r in out if r.host == "wiki.test"} == {"/*/about"}


def slow_verdicts(rows, depth=8, most=20, few=10, branch=5, least=5, z=1.96, smoothing=5.0, limit=0.7):
    """The template tree again, over (host, segments, label, path) rows in plain Python."""
    t = [tuple(s[:depth]) + (("**",) if len(s) > depth else ()) for _, s, _, _ in rows]
    shape = list(t)
    marks = [(1, y is not None, y == 1, bool(re.search(r"[.][A-Za-z0-9]{1,8}/?\Z", p)), p.endswith("/")) for _, _, y, p in rows]
    for d in range(depth + 1):
        kids = {}
        for (host, *_), x, m in zip(rows, t, marks, strict=True):
            if len(x) > d:
                sums = kids.setdefault((host, x[:d]), {}).setdefault(x[d], [0] * 5)
                for i, v in enumerate(m):
                    sums[i] += v

        def close(own, all_, x, n):
            share, rest = all_[x] / all_[n], all_[n] - own[n]
            return abs(own[x] / own[n] - (all_[x] - own[x]) / rest) <= z * (share * (1 - share) * (1 / own[n] + 1 / rest)) ** 0.5

        new = []
        for (host, *_), x in zip(rows, t, strict=True):
            if len(x) > d and x[d] != "*":
                own = kids[host, x[:d]]
                me = own[x[d]]
                known = [v for y, v in own.items() if v[1] >= least and y != x[d]]
                all_ = [sum(v[i] for v in known) + me[i] for i in range(5)]
                wild = len(own) > most and sum(v[0] for v in own.values()) < len(own) * few
                wild |= len(own) > 1 and not known and me[1] >= least
                if known and min(me[0], all_[0] - me[0]) >= branch and close(me, all_, 3, 0) and close(me, all_, 4, 0):
                    wild |= me[1] < least or close(me, all_, 2, 1)
                x = x[:d] + (("*",) if wild else x[d : d + 1]) + x[d + 1 :]
            new.append(x)
        t = new

    def share(keep, prior):
        known = [r[2] for r, k in zip(rows, keep, strict=True) if k and r[2] is not None]
        return (sum(known) + smoothing * prior) / (len(known) + smoothing)

    out = []
    for (host, *_), x in zip(rows, t, strict=True):
        tops = {y[:1] for r, y in zip(rows, shape, strict=True) if r[0] == host}
        labels = [[r[2] for r, y in zip(rows, shape, strict=True) if r[0] == host and y[:1] == top and r[2] is not None] for top in tops]
        own = (sum(round(sum(v) / (len(v) + 5), 9) for v in labels) + 1) / (sum(round(len(v) / (len(v) + 5), 9) for v in labels) + 2)
        out.append(share([r[0] == host and y == x for r, y in zip(rows, t, strict=True)], own) >= limit)
    return out


def test_url_verdicts_without_rules_come_from_the_tree(spark):
    rnd = random.Random(21)
    rows = []
    for i in range(400):
        host = rnd.choice(["a.test", "b.test", "c.test", "d.test"])
        path = [rnd.choice(["x", "y", "z"]), rnd.choice(["u", "v", f"w{chr(97 + i % 26)}{chr(97 + i // 26)}"]), str(i)]
        bad = {"a.test": 0.95, "b.test": 0.05}.get(host, 0.9 if path[0] == "x" else 0.1)
        end = rnd.choice(["", "/", ".html"]) if path[0] != "y" else rnd.choice(["", "", ".html"])
        rows.append((i, f"http://{host}/" + "/".join(path[: rnd.choice([1, 2, 3])]) + end, int(rnd.random() < bad) if rnd.random() < 0.3 and host != "d.test" else None))
    rows += [(900 + i, "http://a.test/never/labelled" + "/deeper" * i, None) for i in range(0, 12, 4)]
    shaped = []
    for _, url, y in rows:
        host, _, path = url[7:].partition("/")
        shaped.append((host, ["*" if re.search("[0-9]", s) else s for s in path.split("/") if s], y, "/" + path))
    want = slow_verdicts(shaped)
    df = spark.createDataFrame([(*r, "clash", 1) for r in rows], "page_id long, url string, bad int, host string, l int")
    out = {r.page_id: r for r in urls.judge_urls(df, label_column="bad").collect()}
    assert {i for i, r in out.items() if r.verdict == "block"} == {r[0] for r, w in zip(rows, want, strict=True) if w}
    # A host known to be bad loses templates without labels; a host without labels loses none.
    assert all(out[i].verdict == "block" for i in range(900, 912, 4)) and not any(r.verdict == "block" for r in out.values() if r.host == "d.test")
    assert urls.judge_urls(df.limit(0), label_column="bad").count() == 0
    long = spark.createDataFrame([(1, "http://h/" + "seg/" * 50_000), (1, "http://h/" + "seg/" * 50_000)], "page_id long, url string")
    assert [r.verdict for r in urls.judge_urls(long).collect()] == ["allow", "allow"]


def test_url_labels_spread_to_similar_siblings_only(spark):
    """Verdicts within one host that no constant of the host could give: without the tree
    (``depth`` 0 leaves one template for each host) they are all the same."""
    ends = {"casino": "", "poker": "", "docs": ".html", "tiny": ""}
    sizes = {"casino": 60, "poker": 40, "docs": 40, "tiny": 3}
    rows = [(1000 * i + j, f"http://h.test/{top}/{j}{end}") for i, (top, end) in enumerate(ends.items()) for j in range(sizes[top])]
    rules = (urls.Rule("h.test", "/casino/", True),)
    df = spark.createDataFrame(rows, "page_id long, url string")

    def verdicts(**more):
        out = {}
        for r in urls.judge_urls(df, rules, **more).collect():
            out.setdefault(r.path.split("/")[1], set()).add(r.verdict)
        return out

    assert verdicts() == {"casino": {"block"}, "poker": {"block"}, "docs": {"allow"}, "tiny": {"allow"}}
    flat = verdicts(depth=0)
    assert flat["poker"] == flat["docs"] == flat["tiny"]
    # Several labelled branches that agree say something about the small one.
    more = rules + tuple(urls.Rule("h.test", f"/{x}/", True) for x in ("poker", "docs"))
    rules = more
    assert verdicts()["tiny"] == {"block"}

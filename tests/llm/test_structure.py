"""Languages, hard negatives and conversations against plain versions, on nulls, ties, repeated rows, hot keys and empty tables."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallyloom.llm import conversations, hard_negatives, language
from tests.llm.conftest import CLASHING, TEXTS, table

# Conversations


def plain_repair(codes):
    """Cheapest (cost, audit) row by row, with at most two insertions before each row and at the end."""
    inserts = {0: [(0, 0, ""), (2, 2, "I"), (4, 3, "II")], 1: [(0, 1, ""), (2, 2, "I"), (4, 3, "II")], 2: [(0, 2, ""), (2, 3, "I")], 3: [(0, 3, ""), (2, 2, "I")]}
    best = {0: (0, "")}
    for code in codes:
        nxt = {}
        for q, (cost, audit) in best.items():
            for c, r, a in inserts[q]:
                moves = [(3, r, "D")]
                if code != "-":
                    more = code.isupper()
                    moves.append((2 + more, 3 if r == 2 else 2, "R"))
                    to = {("s", 0): 1, ("u", 0): 2, ("u", 1): 2, ("u", 3): 2, ("a", 2): 3}.get((code.lower(), r))
                    if to is not None:
                        moves.append((more, to, "K"))
                for m, t, x in moves:
                    found = (cost + c + m, audit + a + x)
                    nxt[t] = min(nxt.get(t, found), found)
        best = nxt
    return min((cost + c, audit + a) for q, (cost, audit) in best.items() for c, r, a in inserts[q] if r in (0, 3))


def plain_report(rows):
    """The query's columns for the rows (turn, role, text) of one conversation, after damage."""
    digest = lambda role, text: hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()
    rows = [(t, " " if r is None else r, " " if x is None else x) for t, r, x in rows]
    rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], digest(*r[1:])))
    seen, codes, n = set(), "", Counter()
    for _, role, text in rows:
        words = re.sub(r"[\x20\x09-\x0D]+", "", text)
        fault = "blank" if not words else "duplicate" if (role, text) in seen else "truncated" if words[-1] not in ".!?" else ""
        seen.add((role, text))
        n[fault] += 1
        letter = role[:1] if role[:1] in ("s", "u", "a") else "o"
        codes += "-" if fault in ("blank", "duplicate") else letter.upper() if fault else letter
    n["illegal"] = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    cost, audit = plain_repair(codes)
    lines, last, left = [], "", iter(rows)
    for edit in audit:
        role, text = ("", "") if edit == "I" else next(left)[1:]
        if edit == "D":
            continue
        if edit != "K":
            role = "assistant" if last == "u" else "user"
        last = role[:1]
        lines.append(f"{role}:{text}")
    assert re.fullmatch("(s?(ua)+)?", "".join(x[0] for x in lines))
    return gaps, n["blank"], n["duplicate"], n["truncated"], n["illegal"], cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()


@settings(max_examples=300, deadline=None)
@given(st.text("suaoSUAO-", max_size=14), st.integers(1, 6))
def test_lightest_repair(codes, piece):
    assert conversations.repair(codes) == plain_repair(codes)
    pieces = [conversations.spans(codes[k : k + piece]) for k in range(0, len(codes), piece)]
    if pieces:
        items = conversations.fold(pieces)
        assert min(items[0, q] for q in (0, 3) if (0, q) in items) == plain_repair(codes)


def test_long_conversation_in_pieces():
    codes = "".join(random.Random(5).choices("suaoSUA-", [1, 6, 6, 1, 1, 2, 2, 2], k=3 * conversations.PIECE + 7))
    assert conversations.repair(codes) == plain_repair(codes)


def turns_of(seed, n):
    pick = random.Random(seed)
    texts = ["Yes.", "No!", "", " \n", "a cut end", "Well? ", "ends in a quote.”", None, "ﬁn.", "x" * 3000 + "."]
    return [(pick.choice([None, *range(-2, n)]), pick.choice(["user", "assistant", "system", "tool", "", None, "ußer"]), pick.choice(texts) if pick.random() < 0.6 else f"line {k}.") for k in range(n)]


def test_conversations_of_any_shape(spark, monkeypatch):
    monkeypatch.setattr(conversations, "PIECE", 16)
    groups = {k: turns_of(k, 1 + k % 9) for k in range(40)} | {100: turns_of(100, 700), 101: [(None, None, None)] * 5, None: turns_of(7, 30)}
    rows = [(k, *r) for k, g in groups.items() for r in g]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumns({c: F.lit("x") for c in [*CLASHING, "stretch", "said", "kind", "copies", "code"]})
    got = {r.conv_id: tuple(r)[1:] for r in conversations.repair_structure(frame.repartition(3)).collect()}
    assert got == {k: plain_report(g) for k, g in groups.items()}
    parts = conversations.stretches(conversations.judged(frame.select("conv_id", "turn", *(F.coalesce(c, F.lit(" ")).alias(c) for c in ("role", "text")))))
    assert parts.filter("conv_id = 100").count() > 1  # spread over tasks


def test_damage(spark):
    rows = [(c, t, r, x) for c in (1, 2, None) for t in (*range(60), None) for r, x in [("assistant", f"So. It is {t}! ok?"), (None, None)]]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    want = {}
    for c, t, r, x in rows:
        key, r, x = f"{' ' if c is None else c}:{' ' if t is None else t}", r or " ", x or " "
        kind = zlib.crc32(key.encode()) % 20
        x = "" if kind == 1 else re.sub("[.!?]", "", x) if kind == 2 else x
        want.setdefault(c, []).extend([(t, "user" if kind == 4 else r, x)] * (kind != 0) * (1 + (kind == 3)))
    got = {r.conv_id: tuple(r)[1:] for r in conversations.repair_damaged(frame).collect()}
    assert got == {c: plain_report(v) for c, v in want.items()}
    gone = next(t for t in range(1000) if zlib.crc32(f"9:{t}".encode()) % 20 == 0)
    (row,) = conversations.repair_damaged(spark.createDataFrame([(9, gone, "user", "Hi.")], frame.schema)).collect()
    assert tuple(row) == (9, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert conversations.repair_damaged(frame.limit(0)).count() == 0


# Hard negatives


def plain_negatives(rows, every):
    """Rows are (id, label, vector)."""
    rows = [r for r in rows if None not in r and None not in r[2]]
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    out = []
    for i, label, v in {(i, label, tuple(v)) for i, label, v in rows if i % every == 0}:
        others = sorted((-dot(v, w), j, m) for j, m, w in rows if j != i)
        positives = [(-s, j) for s, j, m in others if m == label][:5]
        for p, j in positives:
            fit = [(-s, k) for s, k, m in others if m != label and 50 * p <= -100 * s <= 95 * p][:3]
            out += [(i, j, rank, k, p, s) for rank, (s, k) in enumerate(fit, 1)]
    return sorted(out)


def vectors_of(seed, n, dims=6):
    pick = np.random.default_rng(seed)
    centres = pick.integers(-200, 200, (7, dims))
    rows = [(int(i), int(pick.integers(0, 3)), (centres[pick.integers(0, 7)] + pick.integers(-20, 20, dims)).tolist()) for i in range(n)]
    rows += [rows[10]] * 9 + [rows[20]] * 2 + [(20, 1, rows[21][2])]  # repeated rows, and one id with two vectors
    rows += [(n + 1, 0, rows[0][2]), (n + 2, 1, rows[0][2]), (n + 3, 1, [0] * dims), (n + 4, 0, []), (-10, 2, [5] * (dims + 3)), (n + 5, 1, [7])]
    return rows + [(None, 1, [1] * dims), (n + 6, None, [1] * dims), (n + 7, 1, None), (n + 8, 1, [None] * dims)]


def mined(spark, rows, every):
    frame = spark.createDataFrame(rows, "vec_id long, label int, vector array<long>").withColumns({c: F.lit("x") for c in [*CLASHING, "block", "place", "parent", "edge", "copies", "slice", "kind"] if c != "label"})
    return sorted(map(tuple, hard_negatives.mine(frame.repartition(3), F.col("vec_id") % every == 0).collect()))


@pytest.mark.parametrize("block", [4096, 7])
def test_hard_negatives(spark, monkeypatch, block):
    monkeypatch.setattr(hard_negatives, "BLOCK", block)
    monkeypatch.setattr(hard_negatives, "SLICES", 3)
    rows = vectors_of(3, 300)
    got = mined(spark, rows, 10)
    assert got and got == plain_negatives(rows, 10)


def test_hard_negatives_of_large_numbers(spark):
    rows = [(i, label, [x << 20 for x in v]) for i, label, v in vectors_of(4, 40) if v is not None and None not in v]
    assert mined(spark, rows, 10) == plain_negatives(rows, 10)
    assert mined(spark, [(0, 1, [2**62, 2**62]), (1, 1, [2**62, 2**62]), (2, 2, [1, 1])], 10) == []


def test_no_anchors(spark):
    assert mined(spark, [(1, 1, [1, 2]), (2, 1, [1, 2])], 10) == [] == mined(spark, [], 10)


def test_whole_numbers(spark):
    rows = [(1, 0, [0.5, -0.001, 1.0]), (2, 0, [float("nan")]), (3, 0, [float("inf"), 1.0]), (4, 0, [None, 1.0]), (5, 0, None), (6, 0, [])]
    frame = spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>")
    got = {r.vec_id: r.vector for r in hard_negatives.whole_numbers(frame).collect()}
    assert got == {1: [128, -1, 256], 2: None, 3: None, 4: None, 5: None, 6: []}


def test_tree_bounds_prune():
    """Anchors that lie close together: most candidates are decided by a parent's score."""
    import pyarrow as pa

    pick = np.random.default_rng(1)
    centre = pick.integers(-300, 300, 16)
    anchors = centre + pick.integers(-4, 4, (200, 16))
    order, parent, edge = hard_negatives.spanning_tree(anchors)
    assert sorted(order) == list(range(200)) and parent[0] == -1 and all(p < k for k, p in enumerate(parent))
    column = lambda v: pa.array(v.tolist(), pa.list_(pa.int64()))
    block = hard_negatives.Block(
        pa.table({"vector": column(anchors[order]), "vec_id": order + 10_000, "label": np.ones(200, int), "place": np.arange(200), "parent": parent, "edge": edge, "block": np.zeros(200, int), "positive_scores": pa.array([[100_000]] * 200)}), 3, (50, 95)
    )
    rows = pick.integers(-300, 300, (5000, 16))
    for k in range(0, 5000, 1000):
        block.meet(pa.record_batch({"vector": column(rows[k : k + 1000]), "vec_id": np.arange(k, k + 1000), "label": np.zeros(1000, int), "copies": np.ones(1000, int)}))
    assert block.scored < block.offered / 5
    scores = anchors[order] @ rows.T
    for k in range(200):
        fit = sorted((-s, i) for i, s in enumerate(scores[k].tolist()) if 50_000 <= s <= 95_000)[:3]
        assert [(-s, i) for s, i in fit] == list(zip(block.best[k][0].scores, block.best[k][0].ids))


# Languages


def plain_grams(text):
    letters = "".join((c.lower() if len(c.lower()) == 1 else c) if c.isalpha() else " " for c in text or "")
    s = " " + " ".join(letters.split(" ")).strip() + " "
    s = re.sub(" +", " ", s)
    out = Counter(c for c in s if c != " ")
    out.update(s[i : i + 2] for i in range(len(s) - 1))
    out.update(s[i : i + 3] for i in range(len(s) - 2) if s[i + 1] != " ")
    return out if s.strip() else Counter()


def plain_rank(counts, size):
    return {g: k for k, g in enumerate(sorted(counts, key=lambda g: (-counts[g], len(g), g))[:size])}


def plain_languages(rows, learn, size):
    """Rows are (id, text, lang); learn tells whose language is learned."""
    counts = {}
    for i, text, lang in rows:
        if lang is not None and learn(i):
            counts.setdefault(lang, Counter()).update(plain_grams(text))
    profiles = {k: plain_rank(c, size) for k, c in counts.items() if c}
    out = []
    for i, text, _ in rows:
        own = plain_rank(plain_grams(text), size)
        if not own or not profiles:
            out.append((i, "und", 0.0))
            continue
        far, lang = min((sum(abs(p[g] - k) if g in p else size for g, k in own.items()), lang) for lang, p in profiles.items())
        out.append((i, lang, round(1 - far / (size * len(own)), 12)))
    return sorted(out, key=repr)


def languages_of(frame, learned_from, **more):
    return sorted(((r.doc_id, r.lang_pred, round(r.score, 12)) for r in language.identify(frame, ["doc_id"], language.profiles(learned_from, more.get("size", 300)), **more).collect()), key=repr)


EXTRA = [(40, "Le cœur a ses raisons que la raison ne connaît point", "fr", "a"), (41, "Der Fluß lief über die alte Mühle", "de", "b"), (42, "İstanbul'da ŞEHİR ǅ ﬁ 漢字かな", "tr", None), (43, "12 34 !?", "de", "a"), (44, "a\U00010400b \U0001f600", "en", "a")]


@pytest.mark.parametrize("size,group", [(300, 500), (20, 500), (300, 1)])
def test_languages(spark, monkeypatch, size, group):
    monkeypatch.setattr(language, "SEEN", 200)
    rows = [(i, t, lang) for i, t, lang, _ in TEXTS + EXTRA]
    frame = table(spark, TEXTS + EXTRA).withColumns({c: F.lit("x") for c in ("lang_pred", "distance", "most", "gram", "rank")})
    got = languages_of(frame.repartition(3), frame.repartition(5), size=size, group=group)
    assert got == plain_languages(rows, lambda i: True, size)


def test_languages_without_a_profile(spark, nothing):
    frame = table(spark, [(1, "some text", None, "a"), (2, None, "en", "a")])
    assert languages_of(frame, frame) == [(1, "und", 0.0), (2, "und", 0.0)]
    assert languages_of(nothing, frame) == [] and language.predicted(nothing).collect() == []


def test_learning_rows(spark, edge):
    kept = lambda i: i is None or zlib.crc32(str(i).encode()) % 3 != 1
    rows = language.predicted(edge).collect()
    assert all(r.held_out == (not kept(r.doc_id)) for r in rows)
    assert sorted(((r.doc_id, r.lang_pred, round(r.score, 12)) for r in rows), key=repr) == plain_languages([(i, t, lang) for i, t, lang, _ in TEXTS], kept, 300)

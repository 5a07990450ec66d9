"""The methods behind the operators, against plain versions."""

import itertools
import math
import os

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
import tokenizers
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tallyloom.llm import bpe, html_extract, near_dedup, pii, quality_classifier, ragged, substring_dedup, token_counts
from tallyloom.llm.components import components
from tallyloom.llm.decontaminate import RADIUS, with_fingerprint
from tallyloom.llm.queries import tokenizer

QUICK = settings(max_examples=60, deadline=None, suppress_health_check=list(HealthCheck))
TEXT = st.text(alphabet=st.one_of(st.sampled_from("abt the in'll  \n\t▁é日🙂"), st.characters(codec="utf-8")), max_size=80)


@QUICK
@given(st.lists(TEXT, max_size=6))
def test_words_of_a_batch(texts):
    from tests.llm import plain

    t = ragged.Texts(pa.array([*texts, None], pa.string()))
    words = [w.decode() for w in np.array(t.vocabulary.to_pylist(), object)[t.ids]] if len(t.starts) else []
    assert words == [w for x in texts for w in plain.words(x)]
    assert t.n_words.tolist() == [len(plain.words(x)) for x in [*texts, ""]]


@QUICK
@given(st.lists(TEXT, min_size=1, max_size=5))
def test_pieces_as_the_library(texts):
    library = sentencepiece.SentencePieceProcessor(model_file=tokenizer("piece_bpe_32k.model"))
    sizes, n = token_counts.count_tokens(pa.array(texts, pa.string()), token_counts.pieces(tokenizer("piece_bpe_32k.model")))
    assert n.tolist() == [len(library.encode(x)) for x in texts]


def test_long_sequences_are_merged_alike():
    table = token_counts.pieces(tokenizer("piece_bpe_32k.model"))
    for word in (b"the" * 100, b"a" * 700, b" " * 333 + b"x", b"internationalisation" * 20):
        whole = token_counts.tokens_of([word], table)
        symbols = table.symbol[[ord(c) for c in word.decode().replace(" ", "▁")]]
        left, _ = token_counts.merge_rounds(symbols, np.array([0, len(symbols)]), table)
        assert whole.tolist() == [len(left)]


@QUICK
@given(st.lists(TEXT, min_size=1, max_size=5))
def test_byte_level_as_the_library(texts):
    library = tokenizers.Tokenizer.from_file(tokenizer("byte_bpe_50k.json"))
    v = bpe.vocabulary(tokenizer("byte_bpe_50k.json"))
    texts = [*texts, "a<|endoftext|> b"]
    found = bpe.Encoder(v).encode(texts)
    for text, ids in zip(texts, found):
        assert ids.tolist() == library.encode(text, add_special_tokens=False).ids
        assert v.decode(ids) == text


def test_encoder_forgets_and_goes_on(monkeypatch):
    monkeypatch.setattr(bpe, "KEPT", 5)
    encoder = bpe.Encoder(bpe.vocabulary(tokenizer("byte_bpe_50k.json")))
    once = [encoder.encode([t])[0].tolist() for t in ("one two three", "four five six seven", "one two three")]
    assert once[0] == once[2] and len(encoder.place) <= 5


def test_broken_ids_decode_with_replacement():
    v = bpe.vocabulary(tokenizer("byte_bpe_50k.json"))
    library = tokenizers.Tokenizer.from_file(tokenizer("byte_bpe_50k.json"))
    ids = library.encode("日本", add_special_tokens=False).ids[:-1]
    assert v.decode(np.array(ids)) == library.decode(ids, skip_special_tokens=False)


DISGUISED = [
    ("write to john [at] mail (dot) example.com now", ["email:9:41"]),
    ("John at gmail dot com, please", ["email:0:21"]),
    ("card ４０００ 1234 5678 9017 x", ["card:5:24"]),
    ("jоhn@exаmple.com", ["email:0:16"]),
    ("john@mail​.example.org", ["email:0:22"]),
    ("call plus one nine eight seven six five four three two one zero", ["phone:5:63"]),
    ("call + eins zwei drei vier fünf sechs sieben acht neun null.", ["phone:5:59"]),
    ("écrivez: jean arroba correo punto es", ["email:9:36"]),
    ("server 10․0․0․1 up", ["ip:7:15"]),
    ("he stayed at home and looked at the dot", []),
    ("meet us at example.com or look at Fig.2 about the dot product", []),
    ("il est chez lui point barre", []),
    ("mail eva at mail.example dot org", ["email:5:32"]),
    ("mail jane@example dot com now", ["email:5:25"]),
    ("mail jane@mail dot example.org", ["email:5:30"]),
    ("john dot smith at example dot com", ["email:0:33"]),
    ("to j dot r dot smith [at] example [dot] com", ["email:3:43"]),
    ("host 192 dot 168 dot 1 dot 20 up", ["ip:5:29"]),
    ("host 192.168 dot 1.20 up", ["ip:5:21"]),
    ("host 192 point 168 point 1 point 20 up", ["ip:5:35"]),
    ("host 192 dot 168 dot 1 dot 2000, 300 dot 1 dot 1 dot 1", []),
    ("section 3 dot 1 and the dot 2 dot 1 dot x", []),
    ("host one nine two.one six eight.one.one up", ["ip:5:39"]),
    ("host one nine two dot one six eight dot one dot two zero up", ["ip:5:56"]),
    ("host 10.0.0.one", ["ip:5:15"]),
    ("host 192.168.one.20 and 10 dot zero dot zero dot 1", ["ip:5:19", "ip:24:50"]),
    ("hôte un neuf deux point un six huit point un point deux", ["ip:5:55"]),
    ("host １９２.１６８.１.２０ up", ["ip:5:17"]),
    ("card four 1 one 1 one 1 one 1 one 1 one 1 one 1 one 1 now", ["card:5:53"]),
    ("card 4 one 1 one 1 one 1 one 1 one 1 one 1 one 1 one", ["card:5:52"]),
    ("call plus 1 nine 8 seven 6 five 4 three 2 one 0.", ["phone:5:47"]),
    ("one. two. three. four. five.", []),
    ("section one 2 and 3.5 or two 4", []),
    ("one two three apples", []),
    ("look at two, three or four of them", []),
]


@pytest.mark.parametrize("text, want", DISGUISED)
def test_disguises(text, want):
    base, every = pii.find(text)
    assert pii.shown([s for s in every if s not in base]).split(",") == (want or [""])


FOLDED = {"s": "ſ", "i": "ıİ", "k": "\u212a"}


@pytest.mark.parametrize("word", sorted(pii.DIGITS))
def test_letters_that_case_folds_into_digit_words(word):
    for k, letter in enumerate(word):
        for other in [letter.upper(), *FOLDED.get(letter, "")]:
            odd = word[:k] + other + word[k + 1 :]
            digit = pii.DIGITS[word]
            text = f"call + {odd} one two three four five six seven eight nine now"
            base, every = pii.find(text)
            assert not base and pii.shown(every) == f"phone:5:{len(text) - 4}", (odd, digit)


@pytest.mark.parametrize("text", ["ſeven one two three four", "call sıx six six six", "FİVE five five five", "ſix dot one dot two dot three", "null eıns zwei drei vier"])
def test_old_letters_do_not_raise(text):
    pii.find(text)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.one_of(st.sampled_from([*pii.DIGITS, " ", " dot ", " at ", "@", ".", "+", "-", "ſ", "ı", "İ", "ß", "K", "[at]", "(dot)", "1", "23", "\u200b"]), st.characters(codec="utf-8"))).map("".join))
def test_any_text_has_spans_within(text):
    base, every = pii.find(text)
    assert set(base) <= set(every) and base == pii.detect(text)
    assert all(0 <= a < b <= len(text) and kind in pii.KINDS for a, b, kind in every)
    assert pii.hide(text, every).count("[") >= text.count("[") - sum(text[a:b].count("[") for a, b, _ in every)


@QUICK
@given(TEXT, TEXT)
def test_tape_maps_back(before, after):
    tape = pii.Tape(before + "x [at] y" + after)
    pii.show_characters(tape)
    pii.show_signs(tape)
    assert len(tape.text) == len(tape.begin) == len(tape.end)
    assert all(a < b for a, b in zip(tape.begin, tape.end)) and (np.diff(tape.begin) >= 0).all()
    for i in np.flatnonzero(~tape.changed).tolist():
        assert (before + "x [at] y" + after)[tape.begin[i]] == tape.text[i]


def test_posterior_bound():
    """The bound is the least number of matches whose posterior still reaches MISS, by integrating the posterior."""
    grid = (np.arange(200_000) + 0.5) / 200_000
    for h, bound in zip(range(near_dedup.BATCH, near_dedup.HASHES + 1, near_dedup.BATCH), near_dedup.least_matches(0.8)):

        def posterior(m, h=h):
            density = np.exp(m * np.log(grid) + (h - m) * np.log1p(-grid) + math.lgamma(h + 2) - math.lgamma(m + 1) - math.lgamma(h - m + 1))
            return density[grid >= 0.8].mean() * 0.2

        assert posterior(bound) >= near_dedup.MISS * 0.99 and (bound == 0 or posterior(bound - 1) < near_dedup.MISS * 1.01)


def family(n, seed, length=150, edits=14):
    """Variants of one text with some words replaced."""
    random = np.random.default_rng(seed)
    base = [f"w{k}" for k in range(length)]
    texts = []
    for i in range(n):
        words = list(base)
        for k in random.choice(length, random.integers(0, edits), replace=False):
            words[k] = f"e{random.integers(0, 40)}"
        texts.append((i, " ".join(words)))
    return texts


@pytest.mark.parametrize("parts", [False, True])
def test_large_family_of_near_copies(spark, monkeypatch, parts):
    from tests.llm import plain

    if parts:  # every bucket and cluster is split over tasks
        monkeypatch.setattr(near_dedup, "BUCKET_NODES", 25)
        monkeypatch.setattr(near_dedup, "CLUSTER_SHINGLES", 3000)
    rows = family(160, 3) + [(i + 1000, t) for i, t in family(40, 4, 60, 9)]
    want = plain.components(rows, 5)
    got = near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)).collect()
    assert {r.doc_id: r.component_id for r in got} == {i: c for (i, _), (_, c) in want.items()}


def test_large_bucket_of_unlike_members(spark, monkeypatch):
    """Texts that share one band only, and pairs that meet nowhere else: found, in work that grows with the members rather than their square."""
    monkeypatch.setattr(near_dedup, "BUCKET_NODES", 50)
    plain_search, held = near_dedup.searched, []

    def counted(rows, payload, find):
        held[-1] += rows.count()
        return plain_search(rows, payload, find)

    monkeypatch.setattr(near_dedup, "searched", counted)
    random = np.random.default_rng(11)
    near_dedup.prepare(spark)
    for n in (300, 1200):
        signatures = random.integers(0, 1 << 16, (n, near_dedup.HASHES)).astype("<u2")
        signatures[:, : near_dedup.ROWS] = 7
        pairs = [(i, n - 1 - i) for i in range(0, n // 2, 10)]
        for i, j in pairs:  # alike but for one hash in each band except the first
            signatures[j] = signatures[i]
            signatures[j, [near_dedup.ROWS * b + random.integers(near_dedup.ROWS) for b in range(1, near_dedup.BANDS)]] += 1
        held.append(0)
        nodes = spark.createDataFrame([(k.to_bytes(4, "big"), x.tobytes()) for k, x in enumerate(signatures)], "node binary, signature binary")
        links = near_dedup.candidates(nodes, 80).collect()
        met = {tuple(sorted(int.from_bytes(x, "big") for x in (r.a, r.b))) for r in links}
        assert met == set(pairs)
    # Two rounds over all members, and what shares a second band.
    assert held[0] < 4 * 300 and held[1] < 4 * 1200


def test_large_clusters_are_split(spark, monkeypatch):
    """Clusters whose members are mostly not linked, with tasks of a few texts only: split by further bands, and the components stay exact."""
    from tests.llm import plain

    monkeypatch.setattr(near_dedup, "BUCKET_NODES", 12)
    monkeypatch.setattr(near_dedup, "CLUSTER_SHINGLES", 1200)
    plain_split, split = near_dedup.split_teams, []
    monkeypatch.setattr(near_dedup, "split_teams", lambda rows: split.append(rows.columns) or plain_split(rows))
    rows = family(110, 5, edits=16)
    want = plain.components(rows, 5)
    got = near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)).collect()
    assert {r.doc_id: r.component_id for r in got} == {i: c for (i, _), (_, c) in want.items()}
    assert any("shingles" in columns for columns in split)


def test_groups_cross_batches():
    keys = [1, 1, 1, 2, 3, 3, 3, 3, 3, 4, 4, 9]
    batches = [pa.RecordBatch.from_arrays([pa.array(keys[a : a + 2])], ["k"]) for a in range(0, 12, 2)]
    seen = [tuple(t.column("k").to_pylist()[a:b]) for t, cuts in near_dedup.whole_groups(iter([*batches[:3], batches[0].slice(0, 0), *batches[3:]]), "k") for a, b in zip(cuts[:-1], cuts[1:])]
    assert seen == [(1, 1, 1), (2,), (3,) * 5, (4, 4), (9,)]


def test_rows_kept_from_a_shuffle(spark):
    from tallyloom.llm.shared import likely_in

    rows = spark.range(0, 200_000).selectExpr("id", "id % 7 as x", "'p' as slot")
    ids = spark.range(0, 200_000, 41).withColumnRenamed("id", "wanted")
    kept = likely_in(rows, "id", ids, "wanted")
    assert kept.columns == rows.columns
    found = {r.id for r in kept.collect()}
    assert {r.wanted for r in ids.collect()} <= found and len(found) < 200_000 / 41 * 1.2
    assert likely_in(rows, "id", ids.limit(0), "wanted").count() == 0
    assert likely_in(rows.limit(0), "id", ids, "wanted").count() == 0


def test_components_of_chains_and_stars(spark):
    links = [(k, k + 1) for k in range(1, 40)] + [(100, k) for k in range(101, 140)] + [(200, 201), (201, 200), (300, 300)]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{k: 1 for k in range(1, 41)}, **{k: 100 for k in range(100, 140)}, 200: 200, 201: 200}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


@QUICK
@given(st.lists(st.lists(st.sampled_from("a b c d".split()), max_size=60), min_size=1, max_size=4), st.lists(st.sampled_from("a b c d".split()), min_size=13, max_size=30), st.integers(2, 13))
def test_equal_windows_have_equal_representatives(texts, passage, size):
    """A passage put into several texts is represented alike, runs and all."""
    column = pa.array([" ".join([*t, *passage, *t[::-1]]) for t in texts], pa.string())
    t = ragged.Texts(column)
    at, key = substring_dedup.representatives(t, size)
    known = {}
    ids = t.ids
    for a, k in zip(at.tolist(), key.tolist()):
        assert known.setdefault(tuple(ids[a : a + size].tolist()), k) == k
    assert at.tolist() == t.window_starts(size).tolist()


def test_representatives_are_few():
    text = " ".join(f"w{x}" for x in np.random.default_rng(1).zipf(1.3, 20_000) % 5000)
    _, key = substring_dedup.representatives(ragged.Texts(pa.array([text])), 13)
    assert len(np.unique(key)) < 0.5 * len(key)


def test_scores_equal_all_pairs():
    """The linear-time score against the sum over all pairs of inputs."""
    random = np.random.default_rng(0)
    machine = quality_classifier.Machine(0.1, random.normal(size=quality_classifier.WIDTH), random.normal(size=(quality_classifier.WIDTH, quality_classifier.RANK)))
    x = quality_classifier.inputs(pa.array(["some words and some more words", "", None, "x"]), pa.array([30, 0, None, 1]))
    margin, _ = machine.margin(x)
    for row in range(4):
        at, value = x.at[x.offsets[row] : x.offsets[row + 1]], x.value[x.offsets[row] : x.offsets[row + 1]].astype(float)
        pairs = sum(machine.factors[at[i]] @ machine.factors[at[j]] * value[i] * value[j] for i, j in itertools.combinations(range(len(at)), 2))
        assert margin[row] == pytest.approx(0.1 + machine.weights[at] @ value + pairs)


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.01"), reason="test data absent")
def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    scored = quality_classifier.classify(docs, labels, ["doc_id"]).withColumn("held_out", quality_classifier.held_out())
    rows = scored.join(labels, "doc_id").filter("held_out").collect()
    right = sum(r.predicted == r.quality for r in rows)
    assert right >= 0.9 * len(rows) and all(r.predicted == 1 for r in rows if r.quality == 1)


PAGE = """<!DOCTYPE html><html><head><title>No</title><script>var a = "</p><p>no</p>";</script></head><body class="has-sidebar">
<header><a href=/>Site name</a></header><nav><ul><li><a href=/a>Menu</a><li><a href=/b>Other menu</a></ul></nav>
<div id="cookie-notice">We use cookies to show more adverts to everybody who reads this page.</div>
<main><article class="post comments-open"><header><h1>A heading &amp; more</h1></header>
<p>First  <b>bold</b> paragraph with a <a href=x>link</a> and<br>a break.<p>Second &lt;one&gt;, unclosed
<form><label>Mail <input name=q></label><button>Send</button></form>
<div class="comments"><p>A reader says something long about the article that nobody asked for.</p></div></article></main>
<aside>Read also this other thing</aside><footer>&copy; 2020 &middot; nobody</footer></body>"""


def test_parts_of_a_page(spark):
    tree = html_extract.train(spark)
    assert html_extract.main_text(PAGE, tree) == "A heading & more First bold paragraph with a link and a break. Second <one>, unclosed"


@pytest.mark.parametrize("names", ["has-sidebar", "content-with-sidebar", "no-comments", "search-results", "layout sidebar-right"])
@pytest.mark.parametrize("tag", ["article", "main"])
def test_wrapper_named_after_another_part(spark, names, tag):
    tree = html_extract.train(spark)
    text = "A paragraph of a good many words that goes on for a while and says what there is to say about it all. "
    comments = f'<div id="comments" class="comments-area"><article class="comment-body"><p>{text}</p></article></div>'
    page = f'<nav><article><a href=1>Home</a></article></nav><div class="{names}"><{tag}><h1>Title</h1><p>{text * 2}</p><p>{text}</p></{tag}>{comments if tag == "article" else ""}</div>'
    assert html_extract.main_text(page, tree) == f"Title {text * 3}".strip()
    assert html_extract.main_text(f'<main><h1>Title</h1><div class="{names}"><article><p>{text * 3}</p></article></div></main>', tree) == f"Title {text * 3}".strip()


def test_articles_beside_the_main_one(spark):
    tree = html_extract.train(spark)
    text = "A paragraph of a good many words that goes on for a while and says what there is to say about it all."
    page = f'<div class="sidebar"><article><p>{text}</p></article></div><article><p>{text} So.</p></article><div class="comments"><article><p>{text}</p></article></div>'
    assert html_extract.main_text(page, tree) == f"{text} So."


@pytest.mark.parametrize("names", ["post form-guide", "search-results", "notice-of-award", "widget"])
def test_names_do_not_empty_a_page(spark, names):
    body = f"<h1>A title here</h1><p>{'word ' * 40}</p><p>{'more ' * 30}</p>"
    page = f'<nav><a href="/">x</a></nav><div class="{names}">{body}<div class="comments"><p>{"no " * 30}</p></div></div><div class="footer">foot</div>'
    assert html_extract.main_text(page, html_extract.train(spark)) == f"A title here {'word ' * 40}{'more ' * 30}".strip()


@pytest.mark.parametrize("start, end", [("<div>", "</b>"), ("<p><div><b>", "</p>"), ("<b>", "<p>"), ("<div class=form>", "<main>"), ("<li><ul>", "</li>"), ("<article class=ad>", "<article class=ad>")])
def test_unclosed_tags_take_linear_time(start, end):
    import time

    def took(n):
        begun = time.perf_counter()
        html_extract.blocks(start * n + end * n + "x")
        return time.perf_counter() - begun

    took(500)
    assert took(16_000) < 24 * max(took(2_000), 0.02)


def plain_page(k):
    """A page of divisions without a telling tag or name, and its main text."""
    import random

    pick = random.Random(k)
    words = lambda n: " ".join(pick.choice("river stone bridge mill water road house garden field winter".split()) for _ in range(n))
    link = lambda n: f'<div><a href="#">{words(n)}</a></div>'
    menu, main, foot = [link(pick.randint(1, 6)) for _ in range(pick.randint(2, 6))], [], [link(pick.randint(2, 9)) for _ in range(pick.randint(2, 5))]
    if pick.random() < 0.6:
        menu.insert(pick.randrange(1, len(menu)), f"<div>{words(pick.randint(2, 6))}</div>")  # a short line between links
    if pick.random() < 0.6:
        foot.insert(pick.randrange(1, len(foot)), f"<div>{words(pick.randint(2, 8))}</div>")
    for j in range(pick.randint(3, 8)):
        main.append(words(pick.randint(25, 90)))
        if pick.random() < 0.4 and j:
            main.append(words(pick.randint(2, 8)))  # a short line between texts
    if len(main[-1].split()) < 20:
        main.append(words(30))
    return "<html><body>" + "".join(menu) + "".join(f"<div>{t}</div>" for t in main) + "".join(foot) + "</body></html>", main


def test_pages_of_plain_divisions(spark):
    """Blocks right of those taken, and taken of those right, over 300 pages in which only words, links and neighbours tell them apart."""
    tree = html_extract.train(spark)
    used = set()

    def walk(node):
        if node.feature >= 0:
            used.add(node.feature)
            walk(node.left)
            walk(node.right)

    walk(tree)
    assert used & {2, 3, 4, 5}  # features of the neighbours
    taken = right = wanted = 0
    for k in range(300):
        page, main = plain_page(k)
        found = html_extract.blocks(page)
        texts = [b.text() for b in found]
        numbers = [html_extract.Numbers(len(t.split()), min(b.linked_words(), len(t.split())), b.article, b.aside, b.heading) for b, t in zip(found, texts)]
        kept = [t for t, x in zip(texts, html_extract.features(numbers)) if tree.says(x)]
        taken, right, wanted = taken + len(kept), right + len([t for t in kept if t in main]), wanted + len(main)
    assert right / taken >= 0.97 and right / wanted >= 0.97, (right / taken, right / wanted)


def test_page_without_an_article(spark):
    tree = html_extract.train(spark)
    text = "A paragraph of a good many words that goes on for a while and says what there is to say about it all. " * 3
    page = f"<div><a href=1>Home</a> <a href=2>News</a></div><div><p>{text}</p><p>{text}</p></div><div><a href=3>Next</a> <a href=4>Back</a></div>"
    assert html_extract.main_text(page, tree) == f"{text.strip()} {text.strip()}"


def test_tree_agrees_with_its_table(spark):
    tree = html_extract.train(spark)
    for page in html_extract.LABELLED:
        rows = html_extract.features([html_extract.Numbers(*b[:5]) for b in page])
        assert [tree.says(r) for r in rows] == [bool(b[5]) for b in page]


@pytest.mark.parametrize("page", ["<", "<a", "<!-- open", "<p class=\"x", "a < b and c > d", "<script>never closed", "</p></div>", "&#x26;&notin;&am", "<p>" * 2000 + "deep"])
def test_broken_markup(spark, page):
    html_extract.main_text(page, html_extract.Tree(answer=True))


def simhash(hashes):
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints(spark):
    random = np.random.default_rng(2)
    rows = [(k, random.integers(-(1 << 63), 1 << 63, n).tolist()) for k, n in enumerate((1, 2, 5, 34, 300))]
    rows.append((9, rows[3][1] + rows[3][1][:7]))
    got = with_fingerprint(spark.createDataFrame(rows, "k long, s array<bigint>"), "s").collect()
    assert {r.k: r.fingerprint & (1 << 64) - 1 for r in got} == {k: simhash([h & (1 << 64) - 1 for h in s]) for k, s in rows}


def test_blocks_find_every_print_within_the_radius(spark):
    from pyspark.sql import functions as F

    from tallyloom.llm.decontaminate import blocks

    random = np.random.default_rng(5)
    base = int(random.integers(0, 1 << 62))
    near = [base]
    for k in range(1, RADIUS + 1):
        flipped = base
        for b in random.choice(63, k, replace=False):
            flipped ^= 1 << int(b)
        near.append(flipped)
    rows = spark.createDataFrame([(k, x) for k, x in enumerate(near)], "k long, fingerprint long").select("k", blocks(RADIUS).alias("b"))
    own = rows.filter("k = 0").select(F.col("b").alias("c"))
    assert {r.k for r in rows.join(own, F.col("b") == F.col("c")).collect()} == set(range(RADIUS + 1))

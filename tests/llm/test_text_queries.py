"""The registered text queries on the smallest data folder, against SQL or plain versions."""

import hashlib
import os
import re
from html import unescape

import pytest
import sentencepiece
import tokenizers

import __spark_entry__ as contract
import corpus_pipeline
from tallyloom.llm import queries, quality_classifier
from tests.compare import connect, rows_of
from tests.llm import plain

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test data absent")


def sha(data):
    return hashlib.sha256(data.encode() if isinstance(data, str) else data).hexdigest()


@pytest.fixture(scope="module")
def docs(spark):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


def test_all_are_registered():
    numbers = {int(re.match(r"op(\d+)_", name)[1]) for name in queries.QUERIES}
    assert numbers == set(range(1, 14)) and "pipeline" in contract.queries()
    assert set(queries.QUERIES) <= set(contract.queries()) and set(queries.ORACLE) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_against_sql(spark, duck, name):
    df = queries.QUERIES[name](spark, FOLDER)
    names, got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cursor = duck.execute(queries.ORACLE[name])
    want_names, want = rows_of([d[0] for d in cursor.description], cursor.fetchall())
    assert names == want_names and want and got == want


def test_personal_data(spark, docs):
    rows = queries.personal_data(spark, FOLDER).collect()
    assert len(rows) == len(docs)
    assert all(r.base_sha256 == sha(plain.shown(plain.personal(docs[r.doc_id]))) for r in rows)


def test_tokens(spark, docs):
    library = sentencepiece.SentencePieceProcessor(model_file=queries.tokenizer("piece_bpe_32k.model"))
    assert {r.doc_id: r.n_tokens for r in queries.tokens(spark, FOLDER).collect()} == {i: len(library.encode(t or "")) for i, t in docs.items()}


def test_encoding(spark, docs):
    library = tokenizers.Tokenizer.from_file(queries.tokenizer("byte_bpe_50k.json"))
    for r in queries.encoding(spark, FOLDER).collect():
        ids = library.encode(docs[r.doc_id] or "", add_special_tokens=False).ids
        assert r.n_tokens == len(ids) and r.ids_sha256 == sha(b"".join(i.to_bytes(4, "little") for i in ids))
        assert r.decoded_sha256 == sha(library.decode(ids, skip_special_tokens=False))


def test_main_text(spark):
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{FOLDER}/pages.parquet").collect()}
    for r in queries.page_text(spark, FOLDER).collect():
        inside = re.search(r"<article>(.*?)(?:</article>|$)", pages[r.page_id], re.S)[1]
        pieces = re.sub(r"<[^>]*>", "", re.sub(r"</?(?:p|h1)>", "\0", inside.replace("<br>", " "))).split("\0")
        assert r.text == " ".join(t for t in (" ".join(unescape(p).split()) for p in pieces) if t) and r.n_chars == len(r.text)


def test_scores(spark, docs):
    rows = queries.classes(spark, FOLDER).collect()
    import zlib

    assert len(rows) == len(docs)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and r.predicted == int(r.score >= 0.3) for r in rows)


def test_pipeline(spark, docs):
    """Every stage after the classifier against a plain version."""
    frame, labels = spark.read.parquet(f"{FOLDER}/documents.parquet"), spark.read.parquet(f"{FOLDER}/labels.parquet")
    good = [(r.doc_id, r.text) for r in quality_classifier.classify(frame, labels).collect() if r.predicted == 1]
    groups = plain.components(good, 5)
    single = [(i, t) for i, t in good if not plain.words(t) or groups[(i, t)][1] == i]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    leaked = {d for d, _ in plain.leaks(single, items)}
    library = tokenizers.Tokenizer.from_file(queries.tokenizer("byte_bpe_50k.json"))
    want = {}
    for i, t in single:
        if i not in leaked:
            out, done = [], 0
            for a, b, kind in plain.personal(t):
                if a >= done:
                    out += [t[done:a], f"[{kind.upper()}]"]
                done = max(done, b)
            want[i] = library.encode("".join([*out, (t or "")[done:]]), add_special_tokens=False).ids
    got = corpus_pipeline.run(spark, FOLDER)
    assert {r.doc_id: list(r.ids) for r in got.collect()} == want and 0 < len(want) < len(docs)


def test_stages_keep_the_columns(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    assert 4 <= len(corpus_pipeline.STAGES) <= 5
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, FOLDER).columns == docs.columns, name


def test_pipeline_of_nothing(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, FOLDER).count() == 0

"""Token counts against the library on whole texts, with chunks small enough to be spliced everywhere."""

import hashlib
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from millrace.llm import token_counts
from millrace.llm.queries import COUNT_MODEL, tokenizer_path
from conftest import rows

SPEC = token_counts.read_tokenizer(tokenizer_path(COUNT_MODEL))
COUNTER = token_counts.Counter(SPEC)


def whole(text):
    return len(COUNTER.tokenizer.encode(text or "", add_special_tokens=False))


@pytest.fixture(scope="module")
def long_texts(texts):
    some = [t for t in texts.values() if t and len(t) > 500][:30]
    r = random.Random(7)
    alphabet = [*"ab  \n\t'", "'re", "'ll ", "é", "日本", "\U0001f600", "1", ".", "<|endoftext|>", "<|endof", "word "]
    some += ["".join(r.choice(alphabet) for _ in range(r.randint(300, 3000))) for _ in range(60)]
    return some + ["a" * 5000, " " * 5000, "x" * 900 + " y" * 900, "'" * 700 + "re" * 400, "<|endoftext|>" * 200]


def test_spliced_counts_equal_the_library(spark, long_texts):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(long_texts)], "doc_id long, text string")
    for chunk, overlap in [(64, 24), (200, 40), (1000, 1000)]:
        got = rows(token_counts.count_tokens(docs, SPEC, chunk=chunk, overlap=overlap).select("doc_id", "n_tokens"))
        assert got == rows(spark.createDataFrame([(i, whole(t)) for i, t in enumerate(long_texts)]))


def test_alignment_that_fails_is_widened(spark):
    """One word across many overlaps can be spliced nowhere until a chunk holds it."""
    text = "b" * 4000 + " c" * 100
    seams = token_counts._encode_chunks(spark.createDataFrame([(text,)], "text string"), SPEC, 100, 30)
    assert token_counts.splice(seams).first().n_open > 30
    assert token_counts.splice_counts(spark.createDataFrame([(text,)], "text string"), SPEC, 100, 30).collect() == [
        (hashlib.md5(text.encode()).hexdigest(), whole(text))
    ]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from([*"ab \n\t'.1é", "'re", "'ve", "日", "<|endoftext|>", "<|end", "  "]), max_size=80))
def test_reported_word_starts_are_the_whole_texts(parts):
    """What a chunk that starts right says about places beyond the margin holds for the whole text."""
    text = "".join(parts)
    truth = dict(zip(*COUNTER.word_starts(text)[:2]))
    for cut in range(len(text)):
        places, before, _ = COUNTER.word_starts(text[:cut])
        for p, b in zip(places, before):
            if p <= cut - COUNTER.margin:
                assert truth.get(p) == b


def test_edges(spark, edges, empty):
    found = token_counts.count_tokens(edges, SPEC, chunk=1000, overlap=100)
    assert found.columns == [*edges.columns, "n_tokens"]
    assert rows(found.select("doc_id", "n_tokens")) == rows(
        spark.createDataFrame([(r.doc_id, whole(r.text)) for r in edges.collect()], "doc_id long, n_tokens long")
    )
    assert token_counts.count_tokens(empty, SPEC).collect() == []
    clash = edges.withColumn("n_tokens", edges.doc_id).withColumn("_total", edges.doc_id)
    assert token_counts.count_tokens(clash, SPEC, chunk=1000, overlap=100).columns[-2:] == ["_total", "n_tokens"]


def test_other_tokenizers_encode_whole(spark):
    spec = token_counts.read_tokenizer(tokenizer_path("word_bpe_49k.json"))
    assert token_counts.margin(spec) is None
    text = "Some words. " * 200
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    expected = len(token_counts.Counter(spec).tokenizer.encode(text, add_special_tokens=False))
    assert token_counts.count_tokens(docs, spec, chunk=100, overlap=50).first().n_tokens == expected

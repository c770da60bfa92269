import hashlib

import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from millrace.llm.queries import QUERIES, tokenizer_path
from millrace.llm.sentencepiece_bpe import Encoder, decode, encode_and_decode, read_model

from .conftest import EDGES, FOLDER

MODEL = read_model(tokenizer_path())
LIBRARY = sentencepiece.SentencePieceProcessor(model_proto=MODEL)
ENCODER = Encoder(MODEL)


def test_whole_documents_equal_the_library(spark, texts):
    def sha(x):
        return hashlib.sha256(x.encode()).hexdigest()

    got = {r.doc_id: r for r in QUERIES["op3_sentencepiece"](spark, FOLDER).collect()}
    assert len(got) == len(texts)
    for i, text in texts.items():
        ids = LIBRARY.encode(text)
        row = got[i]
        assert (row.n_tokens, row.ids_sha256) == (len(ids), sha(",".join(map(str, ids))))
        assert row.decoded_sha256 == sha(LIBRARY.decode(ids))


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from("aehinorst ▁.,\n0é中\U0001f600Th-="), max_size=40))
def test_any_text_equals_the_library(text):
    assert ENCODER.encode(text) == LIBRARY.encode(text)


def test_compatible_pieces_are_those_that_stay_apart():
    for left, right in ((" t", "he"), ("a", "a"), ("th", "e"), ("er", "ation")):
        a, b = left.replace(" ", "▁"), right
        n, m = ENCODER.number[a], ENCODER.number[b]
        assert ENCODER._compatible(n, m) == (ENCODER._merged(a + b) == [a, b])


def test_edges_and_decoding_alone(spark, edges):
    both = encode_and_decode(edges, MODEL)
    assert both.columns == [*edges.columns, "ids", "decoded"]
    again = decode(both.drop("decoded"), MODEL)
    expected = sorted(((t or ""), LIBRARY.decode(LIBRARY.encode(t or ""))) for _, t in EDGES)
    assert sorted(((r.text or ""), r.decoded) for r in both.collect()) == expected
    assert sorted(((r.text or ""), r.decoded) for r in again.collect()) == expected

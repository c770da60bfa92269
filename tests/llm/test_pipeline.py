"""The pipeline's rows against plain versions of its filtering stages on the smallest tables."""

import hashlib

import corpus_pipeline
import sentencepiece
from millrace.llm.queries import tokenizer_path
from millrace.llm.simhash import fingerprint
from millrace.session import stage

from .conftest import FOLDER
from .test_decontaminate import words
from .test_simhash import unite


def test_stages_by_hand(spark, con, texts):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    frames = [docs]
    for _, step in corpus_pipeline.STAGES:
        frames.append(stage(step(spark, frames[-1], FOLDER)))
    assert all(f.columns == docs.columns for f in frames[:-1])
    told, lined, single, clean = ({r.doc_id: r.text for r in f.collect()} for f in frames[1:5])
    assert told == {i: t for i, t in texts.items() if any(c.isalpha() for c in t)}

    keys = {i: [x.strip(" \t\n\x0b\x0c\r").lower() for x in t.split("\n")] for i, t in told.items()}
    n = {}
    for own in keys.values():
        for k in set(own):
            n[k] = n.get(k, 0) + 1
    assert lined == {
        i: "\n".join(x for x, k in zip(t.split("\n"), keys[i]) if not k or n[k] < 10) for i, t in told.items()
    }

    prints = {i: fingerprint(t.encode()) & (1 << 64) - 1 for i, t in lined.items()}
    near = [(a, b) for a in prints for b in prints if a < b and (prints[a] ^ prints[b]).bit_count() <= 2]
    roots = unite(list(prints), near)
    assert single == {i: lined[i] for i in prints if roots[i] == i}

    windows = set()
    for (text,) in con.execute("SELECT text FROM benchmark").fetchall():
        w = words(text)
        windows |= {tuple(w[s : s + 10]) for s in range(max(1, len(w) - 9))}
    dirty = {i for i, t in single.items() for w in [words(t)] if any(tuple(w[s : s + 10]) in windows for s in range(len(w)))}
    assert clean == {i: t for i, t in single.items() if i not in dirty}

    sp = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path())
    got = {r.doc_id: (r.n_tokens, r.ids_sha256) for r in frames[5].collect()}
    assert got == {
        i: (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
        for i, t in clean.items()
        for ids in [sp.encode(t)]
    }
    assert sorted(corpus_pipeline.run(spark, FOLDER).collect()) == sorted(frames[5].collect())


def test_short_texts_of_a_language_stay(spark):
    folder = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = {r.doc_id for r in corpus_pipeline.language_id(spark, docs, folder).select("doc_id").collect()}
    assert kept == {r.doc_id for r in docs.collect() if any(c.isalpha() for c in r.text or "")}


def test_edges_go_through_all_stages(spark, edges, empty, tmp_path):
    items = spark.createDataFrame([(1, "no such words")], "item_id long, text string")
    items.write.parquet(f"{tmp_path}/benchmark.parquet")
    for docs in (edges, empty):
        docs = stage(docs)
        for _, step in corpus_pipeline.STAGES[:-1]:
            out = stage(step(spark, docs, str(tmp_path)))
            assert out.columns == docs.columns
            docs = out
        final = corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path))
        assert final.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
        assert final.count() == docs.count()

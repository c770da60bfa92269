import random
import re

from compare import spark_result

from millrace.llm import decontaminate
from millrace.llm.decontaminate import build_index, contamination, drop_contaminated, near_matches, phrase_matches


def words(text):
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", "".join(c.lower() if c.isascii() else c for c in text or ""))


def brute(docs, items, window):
    got = {}
    for i, text in docs:
        w, hit, ids = words(text), set(), set()
        for item, t in items:
            q = words(t)
            n = min(window, len(q))
            for s in range(len(q) - n + 1) if n else ():
                for p in range(len(w) - n + 1):
                    if w[p : p + n] == q[s : s + n]:
                        hit |= set(range(p, p + n))
                        ids.add(str(item))
        if hit:
            got[i] = (len(hit), sorted(ids))
    return got


def test_random_texts_of_few_words(spark):
    """Words are so few that windows overlap, repeat within an item, and begin before a document."""
    rng = random.Random(4)
    docs = [(i, " ".join(rng.choices("abc", k=rng.randrange(0, 40)))) for i in range(60)]
    items = [(i, " ".join(rng.choices("abcd", weights=(5, 5, 5, 1), k=rng.randrange(0, 9)))) for i in range(15)]
    docs += [(100 + i, f"x y {t.upper()}, z") for i, (_, t) in enumerate(items)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    it = spark.createDataFrame(items, "item_id long, text string")
    ids = {r.k2: r.doc_id for r in df.selectExpr("doc_id", "xxhash64(doc_id) AS k2").collect()}
    got = {ids[r.k1]: (r.n_hit, r.item_ids) for r in contamination(build_index(df, it), 4).collect()}
    assert got == brute(docs, items, 4)


def test_near_matches(spark):
    items = [(1, "alpha beta gamma the the of")]
    docs = [
        (1, "the alpha of x gamma the beta"),
        (2, "alpha " + "the " * 20 + "beta gamma of"),
        (3, "alpha beta the of"),
        (4, "gamma " + "of " * 8 + "alpha beta"),
        *[(i, "the of") for i in range(5, 30)],
    ]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    index = build_index(df, spark.createDataFrame(items, "item_id long, text string"))
    near = {r.k1 for r in near_matches(index).collect()}
    ids = {r.k: r.doc_id for r in df.selectExpr("doc_id", "xxhash64(doc_id) AS k").collect()}
    assert {ids[k] for k in near} == {1, 4}


def test_phrase_positions(spark):
    df = spark.createDataFrame([(1, "So: one TWO three, four!")], "doc_id long, text string")
    items = spark.createDataFrame([(7, "two three four")], "item_id long, text string")
    found = phrase_matches(build_index(df, items)).collect()
    assert [(r.item_id, sorted(r.positions)) for r in found] == [("7", [2, 3, 4])]


def test_edges(spark, edges, empty):
    items = spark.createDataFrame([(1, "A, b"), (None, "lazy dog"), (3, None), (4, "?!")], "item_id long, text string")
    kept = drop_contaminated(edges, items)
    assert kept.columns == edges.columns
    assert sorted(r.text or "" for r in kept.collect()) == sorted(
        ["", "", "", " \t\n\r\n ", "word " * 30_000, "é ñ 日本 \U0001f600 ▁x  y\n", "x"]
    )
    assert drop_contaminated(edges, items.limit(0)).count() == edges.count()
    assert drop_contaminated(empty, items).count() == 0


def test_main_path_has_no_python(spark, edges):
    items = spark.createDataFrame([(1, "A, b c")], "item_id long, text string")
    plan = contamination(build_index(edges, items))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
    assert spark_result(contamination(build_index(edges, items)))[1]


def test_repeated_rows_are_indexed_once(spark):
    """n equal rows must not meet each other: the index has the postings of one."""
    items = spark.createDataFrame([(1, "alpha beta gamma delta")], "item_id long, text string")
    docs = spark.range(10_000).selectExpr("1L AS doc_id", "'x alpha beta gamma delta beta y' AS text")
    docs = docs.unionByName(spark.createDataFrame([(2, "alpha beta"), (2, None)], "doc_id long, text string")).repartition(4)
    index = build_index(docs, items)
    assert index.postings.count() == 5 + 2
    assert near_matches(index).count() == 1
    assert contamination(index).count() == 1
    assert drop_contaminated(docs, items).count() == 2


def test_words_of_any_text(spark):
    texts = ["", " ", "a", " a", "a ", "A-b\x00c\x7fé@Z[ü]`{1}", "日本 \U0001f600x\n\r\ty", "--", "a" * 10**6 + " b"]
    df = spark.createDataFrame([(t,) for t in texts] + [(None,)], "text string")
    got = df.select(decontaminate.words(df.text).alias("w"), decontaminate.count_words(df.text).alias("n")).collect()
    assert [r.w for r in got] == [words(t) for t in texts] + [None]
    assert [r.n for r in got] == [len(words(t)) for t in texts] + [0]

import numpy as np
import pytest

from millrace.llm import embedding_dedup
from millrace.llm.embedding_dedup import Quantiser, Tables, class_links, classes, near_duplicates


def planted(dim=64, seed=0):
    """Random vectors, groups of copies, and neighbours at cosines from 0.88 to 0.999."""
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(600, dim))
    near = []
    for v in base[:300]:
        other = rng.normal(size=dim)
        other -= v * (other @ v) / (v @ v)
        c = rng.uniform(0.88, 0.999)
        near.append(c * v / np.linalg.norm(v) + np.sqrt(1 - c * c) * other / np.linalg.norm(other))
    hot = base[0] + 0.05 * rng.normal(size=(150, dim))
    return np.concatenate([base, near, hot, base[:40], base[:40]]).astype(np.float32)


def brute(vectors, threshold=0.9):
    unit = vectors.astype(np.float64)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    linked = unit @ unit.T >= threshold
    np.fill_diagonal(linked, False)
    return linked


def test_links_against_brute_force(spark):
    vectors = planted()
    rows = [(int(i), v.tolist(), 0) for i, v in enumerate(vectors)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(4)
    got = {r.vec_id: r for r in near_duplicates(df).collect()}
    linked = brute(vectors)
    degree = linked.sum(axis=1)
    found = np.array([got[i].n_links for i in range(len(vectors))])
    assert (found <= degree).all()
    assert found.sum() >= 0.95 * degree.sum()
    assert (found == degree).mean() > 0.9
    for i in range(len(vectors)):
        root = got[i].component_id
        assert got[root].kept and got[i].kept == (root == i)
        assert (root == i) or linked[i].any()


def test_tiles_do_not_change_the_links(spark):
    vectors = planted(seed=1)
    rows = [(int(i), v.tolist()) for i, v in enumerate(vectors)]
    _, found = classes(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), "embedding", "vec_id")

    def sums(tile_rows):
        links = class_links(found, 64, tile_rows=tile_rows).groupBy("cid").agg({"links": "sum"})
        return {tuple(r) for r in links.collect()}

    assert sums(16) == sums(512)


def test_other_sizes_and_directions(spark):
    rng = np.random.default_rng(3)
    a = rng.normal(size=100)
    rows = [(1, a.tolist()), (2, (1e-30 * a).tolist()), (3, (-a).tolist()), (4, rng.normal(size=100).tolist())]
    got = near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert {(r.vec_id, r.n_links, r.component_id) for r in got} == {(1, 1, 1), (2, 1, 1), (3, 0, 3), (4, 0, 4)}


def test_codes_are_balanced():
    sample = np.random.default_rng(5).normal(size=(4000, 64)) + 3
    bits = np.unpackbits(Quantiser.fit(sample, 64).codes(sample), axis=1)
    assert abs(bits.mean(axis=0) - 0.5).max() < 0.1


def pairs_at(dim, shift, n, low, high, seed):
    """n unit vectors with a common mean (random pairs have the cosine `shift`), a partner of each."""
    rng = np.random.default_rng(seed)
    v = rng.normal(size=(n, dim))
    v = np.sqrt(1 - shift) * v / np.linalg.norm(v, axis=1, keepdims=True) + np.sqrt(shift / dim)
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    other = rng.normal(size=(n, dim))
    other -= v * (other * v).sum(axis=1, keepdims=True)
    other /= np.linalg.norm(other, axis=1, keepdims=True)
    c = rng.uniform(low, high, size=(n, 1))
    return v, c * v + np.sqrt(1 - c * c) * other


@pytest.mark.parametrize("n_rows", [20_000, 10**8])
@pytest.mark.parametrize("dim, shift", [(16, 0), (32, 0), (64, 0), (64, 0.5), (64, 0.7), (768, 0)])
def test_recall_at_the_threshold(dim, shift, n_rows):
    sample, _ = pairs_at(dim, shift, 4096, 0.9, 0.91, 0)
    tables = Tables.fit(sample, min(dim, 64), n_rows)
    assert tables.recall >= 0.97 and tables.width >= (6 if n_rows < 10**6 else 13)
    one, two = pairs_at(dim, shift, 4000, 0.9, 0.91, 1)
    (lead, keys), (lead2, keys2) = tables.keys(one), tables.keys(two)
    met = (keys == keys2).any(axis=1) & (np.bitwise_count(lead ^ lead2) <= tables.radius)
    assert met.mean() >= 0.95


@pytest.mark.parametrize("dim, shift", [(16, 0), (32, 0.5), (64, 0.7)])
def test_links_just_above_the_threshold(spark, dim, shift):
    vectors = np.concatenate(pairs_at(dim, shift, 1500, 0.9, 0.93, 2)).astype(np.float32)
    rows = [(i, v.tolist(), 0, 0) for i, v in enumerate(vectors)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, size int, links int")
    got = dict(near_duplicates(df).select("vec_id", "n_links").collect())
    degree = brute(vectors).sum(axis=1)
    found = np.array([got[i] for i in range(len(vectors))])
    assert (found <= degree).all() and found.sum() >= 0.95 * degree.sum()


def test_short_keys_where_tables_do_not_suffice(monkeypatch):
    monkeypatch.setattr(embedding_dedup, "MAX_TABLES", 1)
    sample, other = pairs_at(16, 0, 2000, 0.9, 0.91, 3)
    tables = Tables.fit(sample, 16, 20_000)
    assert (tables.width, tables.count, tables.radius) == (0, 1, 16)
    assert (tables.keys(sample)[1] == tables.keys(other)[1]).all()


def test_few_or_no_vectors(spark):
    schema = "vec_id long, embedding array<double>, keys string"
    assert near_duplicates(spark.createDataFrame([], schema)).count() == 0
    none = [(1, None, ""), (2, [], ""), (3, [0.0, 0.0], ""), (4, [float("nan"), 1.0], ""), (5, [None, 1.0], "")]
    got = near_duplicates(spark.createDataFrame(none, schema)).collect()
    assert {tuple(r) for r in got} == {(i, 0, i, True) for i in range(1, 6)}
    got = near_duplicates(spark.createDataFrame(none + [(6, [1.0, 2.0], ""), (7, [1.0, 2.0], "")], schema)).collect()
    assert {tuple(r) for r in got if r.vec_id > 5} == {(6, 1, 6, True), (7, 1, 6, False)}

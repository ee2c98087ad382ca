"""Vector codes, centroid clusters and mixing against brute force and SQL."""

import hashlib
import math
import random
import re
from collections import defaultdict

import numpy as np
import pytest
from check_oracle import compare, connect
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tests.llm.conftest import prose

from sparkloom.llm import centroids, code_compression, mixing
from sparkloom.llm import queries as llm_queries

VECTORS = "vec_id bigint, embedding array<double>, label int"
#: Names that the operators use inside.
CLASHING = VECTORS + ", id int, v string, a string, error int, codes string, x int"


@pytest.mark.parametrize("key", ["op11_vector_codes", "op12_centroids", "op13_mixing"])
def test_query_equals_sql(key, spark, sf_dir):
    df = llm_queries.QUERIES[key](spark, sf_dir)
    assert compare(connect(sf_dir), llm_queries.ORACLES[key], df) is None


# --- Vector codes ----------------------------------------------------------------------------------


def _lloyd(rows, params):
    """(codes, errors, codebooks) by comparing everything with everything; rows sorted by id."""
    x = np.array(rows, np.int64).reshape(len(rows), params.parts, -1).transpose(1, 0, 2)
    books = x[:, :params.entries].copy()

    def nearest():
        d = ((x[:, :, None] - books[:, None]) ** 2).sum(axis=3)
        return d.argmin(axis=2), d.min(axis=2)

    for _ in range(params.rounds):
        codes = nearest()[0]
        for p in range(len(books)):
            for e in range(books.shape[1]):
                own = x[p][codes[p] == e]
                if len(own):
                    books[p, e] = own.sum(axis=0) // len(own)
    codes, d = nearest()
    return codes.T, d.sum(axis=0), books


def _vectors(n, length, seed, spread=1.0):
    draw = np.random.default_rng(seed)
    centers = draw.normal(0, spread, (7, length))
    return centers[draw.integers(0, 7, n)] + draw.normal(0, 0.1, (n, length))


@settings(max_examples=40, deadline=None)
@given(n=st.integers(1, 120), entries=st.integers(1, 9), width=st.integers(1, 3), span=st.integers(1, 30),
       leaf=st.integers(1, 8), pairs=st.integers(1, 200), seed=st.integers(0, 10**6))
def test_dual_walk_equals_all_distances(n, entries, width, span, leaf, pairs, seed):
    draw = np.random.default_rng(seed)
    params = code_compression.CodeParams(parts=3, entries=entries, leaf=leaf, pairs=pairs)
    rows = draw.integers(-span, span, (n, 3 * width))
    books = draw.integers(-span, span, (3, entries, width))  # equal entries and ties are common here
    x = rows.reshape(n, 3, width).transpose(1, 0, 2)
    d = ((x[:, :, None] - books[:, None]) ** 2).sum(axis=3)
    codes, error = code_compression.nearest_codes(rows, books, params)
    assert (codes.T == d.argmin(axis=2)).all() and (error == d.min(axis=2).sum(axis=0)).all()
    assert (code_compression.decode(codes, books) == books[np.arange(3)[:, None], codes.T]
            .transpose(1, 0, 2).reshape(n, -1)).all()
    want = np.zeros((3, entries, width + 1), np.int64)
    for p in range(3):
        for k in range(n):
            want[p, codes[k, p]] += np.append(x[p, k], 1)
    assert (code_compression.nearest_sums(rows, books, params) == want).all()


def test_most_parts_are_assigned_by_whole_nodes():
    """Clustered parts: the trees settle nodes of many parts at once, few leaves need distances."""
    draw = np.random.default_rng(1)
    books = draw.integers(-4000, 4000, (2, 64, 4))
    x = books[:, draw.integers(0, 64, 4096)] + draw.integers(-20, 20, (2, 4096, 4))
    parts = code_compression.BoxTree(x, 16)
    compared = sum(len(nodes) * parts.leaf for level, nodes, _ in
                   code_compression.dual_walk(parts, code_compression.BoxTree(books, 1)) if level < 0)
    assert compared < 2 * 4096 * 64 / 8
    assert (parts.total[0] == x.sum(axis=1)).all() and (parts.count[0] == 4096).all()


@pytest.mark.parametrize("n, partitions", [(700, 5), (30, 3), (1, 1)])
def test_codes_equal_lloyd(spark, n, partitions):
    params = code_compression.CodeParams(block=256)
    rows = _vectors(n, 32, n)
    ids = random.Random(n).sample(range(10_000), n)
    df = spark.createDataFrame([(i, r.tolist(), k % 3 or None) for k, (i, r) in enumerate(zip(ids, rows))], VECTORS)
    coded, books = code_compression.compress(df.repartition(partitions), params)
    got = {r.id: (r.codes, r.error) for r in coded.collect()}
    order = sorted(range(n), key=lambda k: ids[k])
    codes, errors, want = _lloyd(np.floor(rows[order] * 256), params)
    assert (books == want).all()
    assert got == {ids[k]: (codes[at].tolist(), int(errors[at])) for at, k in enumerate(order)}


def test_codes_of_awkward_rows(spark):
    good = [[0.1 * k, -0.2] * 8 for k in range(5)]
    rows = [(1, good[0], 1), (2, None, 1), (3, [math.nan] * 16, 1), (4, [None] * 16, 2), (5, [math.inf] * 16, 2),
            (6, good[1], None), (6, good[2], None), (7, [], 1), (8, [1.0] * 15, 1), (9, [1.0] * 32, 1),
            (None, good[3], 1), (10, good[4], 1), (10, good[4], 1)]
    df = spark.createDataFrame([(*r, 1, "s", "s", 1, "s", 1) for r in rows], CLASHING)
    coded, books = code_compression.compress(df)
    got = coded.collect()
    assert sorted((r.id is None, r.id or 0) for r in got) == [(False, 1), (False, 6), (False, 6), (False, 10), (False, 10),
                                                              (True, 0)]
    assert books.shape == (16, 6, 1) and all(r.error == 0 and len(r.codes) == 16 for r in got)
    none, empty = code_compression.compress(df.filter("vec_id = 2"))
    assert none.collect() == [] and empty.size == 0 and none.columns == coded.columns
    with pytest.raises(Exception, match="67108864 or more"):
        code_compression.compress(spark.createDataFrame([(1, [1e300] * 16, 1)], VECTORS))


def test_code_query_on_no_rows(spark, tmp_path):
    spark.createDataFrame([], "vec_id bigint, embedding array<float>, label int").write.parquet(
        f"{tmp_path}/embeddings.parquet")
    for key in ("op11_vector_codes", "op12_centroids"):
        assert llm_queries.QUERIES[key](spark, str(tmp_path)).collect() == []


# --- Centroids -------------------------------------------------------------------------------------


@settings(max_examples=200, deadline=None)
@given(dims=st.integers(1, 4), seed=st.integers(0, 10**6), radius=st.floats(0, 50))
def test_approach_is_never_understated(dims, seed, radius):
    draw = np.random.default_rng(seed)
    center, old, new = draw.normal(0, 20, (3, dims))
    x = draw.normal(0, 1, (500, dims))
    x = center + radius * x / np.linalg.norm(x, axis=1, keepdims=True) * draw.random((500, 1)) ** draw.choice([0, 0.3])
    truth = np.linalg.norm(x - old, axis=1) - np.linalg.norm(x - new, axis=1)
    bound, way = centroids.most_approach(center, radius, old, new), float(np.linalg.norm(new - old))
    assert truth.max() <= bound + 1e-9 * (1 + way + radius) and bound <= way + 1e-9


def test_approach_is_less_than_the_way():
    center, old = np.zeros(2), np.array([10.0, 0.0])
    towards, across, away = (np.array(p, float) for p in ([9, 0], [10, 1], [12, 0]))
    assert centroids.most_approach(center, 1.0, old, towards) == pytest.approx(1.0)
    assert centroids.most_approach(center, 1.0, old, across) < 0.2
    assert centroids.most_approach(center, 1.0, old, away) < -1.9
    assert centroids.most_approach(center, 11.0, old, away) == pytest.approx(2.0)


def _kmeans(rows, start, rounds):
    x, c = np.array(rows, np.int64), np.array(start, np.int64)
    for step in range(rounds + 1):
        d = ((x[:, None] - c[None]) ** 2).sum(axis=2)
        a = d.argmin(axis=1)
        if step < rounds:
            for j in range(len(c)):
                if (a == j).any():
                    c[j] = x[a == j].sum(axis=0) // int((a == j).sum())
    return a, d.min(axis=1), c


@pytest.mark.parametrize("n, partitions, spread", [(900, 5, 1.0), (300, 1, 0.0), (5, 2, 1.0)])
def test_clusters_equal_lloyd(spark, n, partitions, spread):
    params = centroids.ClusterParams(length=6, part_rows=64)
    rows = np.round(_vectors(n, 6, n, spread), 2)  # rounded: ties and equal rows occur
    df = spark.createDataFrame([(k, r.tolist(), 1) for k, r in enumerate(rows)], VECTORS).repartition(partitions)
    found = centroids.cluster(df, params)
    whole = np.floor(rows * 1024).astype(np.int64)
    order = sorted(range(n), key=lambda k: hashlib.sha256(f"3:{k}".encode()).hexdigest())
    a, d, c = _kmeans(whole, whole[order[:8]], 10)
    got = {r.id: (r.a, r.distance) for r in found.rows.collect()}
    assert got == {k: (int(a[k]), int(d[k])) for k in range(n)} and (found.centroids == c).all()
    out = {r.id: r for r in centroids.with_inertia(found).collect()}
    assert len(out) == n and all(r.inertia == int(d.sum()) and r.cluster_inertia == int(d[a == r.cluster].sum())
                                 and r.centroid == c[r.cluster].tolist() for r in out.values())


def test_bounds_spare_most_scans(spark):
    df = spark.createDataFrame([(k, r.tolist(), 1) for k, r in enumerate(_vectors(2000, 8, 3))], VECTORS)
    found = centroids.cluster(df, centroids.ClusterParams(length=8))
    assert found.rows.filter("scanned").count() < 400


def test_clusters_of_awkward_rows(spark):
    good = [[float(k), -float(k)] for k in range(4)]
    rows = [(1, good[0], 1), (2, None, 1), (3, [math.nan, 1.0], 1), (4, [None, 1.0], 2), (5, [-math.inf, 1.0], 2),
            (6, good[1], None), (6, good[2], None), (7, [], 1), (8, [1.0], 1), (None, good[3], 1), (6, good[1], 3)]
    df = spark.createDataFrame([(*r, 1, "s", "s", 1, "s", 1) for r in rows], CLASHING)
    found = centroids.cluster(df, centroids.ClusterParams(length=2, clusters=3))
    got = [(r.id, r.distance) for r in found.rows.collect()]
    assert sorted((i or 0 for i, _ in got)) == [0, 1, 6, 6, 6]
    assert all(d >= 0 for _, d in got) and len(found.centroids) == 3
    none = centroids.cluster(df.filter("vec_id = 2"), centroids.ClusterParams(length=2))
    assert none.rows.collect() == [] and centroids.with_inertia(none).collect() == []


# --- Mixing ----------------------------------------------------------------------------------------


def _targets(sizes, weights, most, percent=100):
    """Shares by weight, shared again until none is above its bound, with fractions."""
    from fractions import Fraction
    bounded, whole = {}, sum(sizes.values()) * percent // 100
    while True:
        free = [s for s in sizes if s not in bounded]
        left, heavy = whole - sum(bounded.values()), sum(weights[s] for s in free)
        share = {s: Fraction(left * weights[s], heavy) for s in free}
        above = [s for s in free if share[s] >= most * sizes[s]]
        if not above:
            return {**bounded, **share}
        bounded |= {s: most * sizes[s] for s in above}


def _mix_docs(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, text string, source string, size string, cut int, taken int")


def _mixed_rows(seed=5, n=400):
    draw, rows = random.Random(seed), []
    for k in range(n):
        source = draw.choice(["a", "a", "a", "b", "c", "d", None, "é", ""])
        rows.append((k, prose(k, draw.randrange(0, 40) if source != "c" else 1), source, "x", 1, 1))
    return rows


@pytest.mark.parametrize("partitions, percent", [(1, 100), (7, 100), (3, 250), (2, 40)])
def test_mix_takes_the_targets(spark, partitions, percent):
    rows = _mixed_rows()
    docs = _mix_docs(spark, rows).repartition(partitions)
    plan = mixing.mix_plan(docs, params=mixing.MixParams(percent=percent))
    got = plan.collect()
    sizes, taken = defaultdict(int), defaultdict(int)
    for r in got:
        assert r.size == len(re.findall(r"[^\x20\x09-\x0D]+", rows[r.doc_id][1]))
        assert r.taken == r.epochs * r.size + r.cut <= 3 * r.size
        sizes[r.source] += r.size
        taken[r.source] += r.taken
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None]
    want = _targets(sizes, {s: k % 3 + 1 for k, s in enumerate(names)}, 3, percent)
    assert dict(taken) == {s: int(want[s]) for s in names}
    assert all(r.target == pytest.approx(float(want[r.source])) and r.source_size == sizes[r.source] for r in got)
    again = mixing.mix_plan(docs.repartition(4), params=mixing.MixParams(percent=percent)).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))


def test_mixed_texts(spark):
    docs = _mix_docs(spark, [*_mixed_rows(), (3, "two words", "b", "x", 1, 1), (3, "two words", "b", "x", 1, 1)])
    plan = mixing.mix_plan(docs)
    mixed = mixing.mixed_texts(docs, plan)
    by_id = mixed.groupBy("doc_id", "source").agg(F.sum(mixing.n_words("text")).alias("n"))
    want = plan.groupBy("doc_id", "source").agg(F.sum("taken").alias("n")).filter("n > 0")
    assert sorted(map(str, by_id.collect())) == sorted(map(str, want.collect()))
    whole = {(r[0], r[2]): r[1] for r in _mixed_rows()}
    assert all(whole[r.doc_id, r.source].startswith(r.text) for r in mixed.filter("doc_id > 3").collect())


def test_words_and_their_heads(spark):
    texts = ["", " \t", "a", " a  b\n", "a b c", "x\x0b y\x0c", None, "w " * 50_000]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = df.select(mixing.n_words("t"), mixing.first_words(F.col("t"), F.lit(2))).collect()
    assert [r[0] for r in got] == [len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for t in texts]
    assert [r[1] for r in got] == ["", " \t", "a", " a  b", "a b c", "x\x0b y", None, "w w"]


def test_mix_with_named_weights_and_hot_rows(spark):
    """One source and one repeated row hold most rows; ranges split them, and the cut is exact all the same."""
    rows = [(1, "one two three", "hot", "x", 1, 1)] * 3000 + [(k, "four words are here", "cold", "x", 1, 1) for k in range(500)]
    weight = F.when(F.col("source") == "hot", 1).otherwise(1)
    plan = mixing.mix_plan(_mix_docs(spark, rows), weight)
    got = {r.source: (r.n, r.t) for r in plan.groupBy("source").agg(F.count("*").alias("n"), F.sum("taken").alias("t")).collect()}
    assert got == {"hot": (3000, 5500), "cold": (500, 5500)}
    assert plan.filter("cut > 0 and cut < size").count() <= 2


def test_mix_of_awkward_rows(spark, awkward, no_docs):
    got = mixing.mix_plan(awkward).collect()
    assert len(got) == awkward.count() and all(r.source is None and r.taken == r.size for r in got)
    assert mixing.mix_plan(no_docs).collect() == []
    empty = mixing.mix_plan(awkward.filter("doc_id in (1, 2, 3)")).collect()
    assert [(r.size, r.target, r.taken) for r in empty] == [(0, 0.0, 0)] * 3


def test_mix_uses_no_python_worker(spark, sf_dir):
    plan = llm_queries.QUERIES["op13_mixing"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Scan ExistingRDD" not in plan

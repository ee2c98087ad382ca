"""Links inside large clusters against brute force, with buckets that are forced together."""

import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F
from tests.llm.test_duplicates import _components

from sparkloom.llm import minhash, set_links


def _families(seed, families=9, copies=9, size=60):
    """Sets around common ones, with more and more elements changed; families share half of their elements."""
    draw = np.random.default_rng(seed)
    common = draw.integers(1, 1 << 62, size // 2, dtype=np.uint64)
    sets = []
    for _ in range(families):
        base = np.concatenate((common, draw.integers(1, 1 << 62, size - len(common), dtype=np.uint64)))
        for _ in range(copies):
            one = base.copy()
            for at in draw.integers(0, size, draw.integers(0, 16)):
                one[at] = draw.integers(1, 1 << 62)
            sets.append(np.unique(one))
    return sets


def _similar(a, b, percent):
    both = len(np.intersect1d(a, b))
    return 100 * both >= percent * (len(a) + len(b) - both)


def _frames(spark, sets, buckets):
    rows = spark.createDataFrame([(k, bytearray(s.tobytes())) for k, s in enumerate(sets)], "node bigint, shingles binary")
    members = spark.createDataFrame([(n, key) for key, nodes in buckets.items() for n in nodes], "node bigint, key bigint")
    return rows, members.groupBy("node").agg(F.collect_list("key").alias("keys"))


@pytest.mark.parametrize("percent, block, seed", [(80, 4, 1), (85, 100, 2), (80, 30, 3), (60, 7, 4)])
def test_one_bucket_for_all(spark, percent, block, seed):
    sets = _families(seed)
    want = _components(range(len(sets)), [(a, b) for a, b in itertools.combinations(range(len(sets)), 2)
                                          if _similar(sets[a], sets[b], percent)])
    rows, buckets = _frames(spark, sets, {1: range(len(sets))})
    links = set_links.star_links(rows, minhash.candidate_ties(buckets), buckets, percent, block).collect()
    assert all(_similar(sets[r.x], sets[r.y], percent) for r in links)
    assert _components(range(len(sets)), [(r.x, r.y) for r in links]) == want


def test_random_buckets(spark):
    sets, draw = _families(11, families=5, copies=20), np.random.default_rng(5)
    buckets = {k: sorted({int(x) for x in draw.integers(0, len(sets), draw.integers(2, 12))}) for k in range(60)}
    pairs = {p for nodes in buckets.values() for p in itertools.combinations(nodes, 2)}
    candidates = [(a, b) for a, b in pairs if _similar(sets[a], sets[b], 80)]
    rows, members = _frames(spark, sets, buckets)
    links = set_links.star_links(rows, minhash.candidate_ties(members), members, 80, 6).collect()
    # All that meet are found; links of texts that do not meet may be found beside them.
    got = _components(range(len(sets)), [(r.x, r.y) for r in links])
    assert all(got[a] == got[b] for a, b in candidates)
    assert all(_similar(sets[r.x], sets[r.y], 80) for r in links)


def test_repeated_nodes_and_no_nodes(spark):
    sets = _families(2, families=2, copies=3)
    rows, buckets = _frames(spark, sets, {1: range(6), 2: [0, 1]})
    ties = minhash.candidate_ties(buckets)
    once = set_links.star_links(rows, ties, buckets, 80, 2).collect()
    twice = set_links.star_links(rows.unionByName(rows), ties, buckets, 80, 2).collect()
    assert _components(range(6), [tuple(r) for r in once]) == _components(range(6), [tuple(r) for r in twice])
    assert set_links.star_links(rows.limit(0), ties, buckets, 80, 2).collect() == []


def test_a_chain_of_chance_meetings_costs_its_meetings(spark):
    """2,000 sets, each in a bucket with the next one: one cluster, but only neighbours are compared."""
    sets = [np.unique(np.random.default_rng(k // 2 if k % 40 < 2 else 10_000 + k).integers(1, 1 << 62, 20, dtype=np.uint64))
            for k in range(2000)]
    rows, buckets = _frames(spark, sets, {k: [k, k + 1] for k in range(1999)})
    homes = set_links._homes(rows, set_links._stars(rows, minhash.candidate_ties(buckets), 80, 512))
    units = set_links._bucket_units(buckets, homes, 512)
    assert units.count() <= 2 * 1999
    links = set_links.star_links(rows, minhash.candidate_ties(buckets), buckets, 80, 512).collect()
    assert sorted({tuple(sorted(r)) for r in links}) == [(k, k + 1) for k in range(0, 2000, 40)]


def test_a_large_family_meets_strangers_by_its_centers(spark):
    """A family and strangers that share buckets with different parts of it: the family's members are not compared
    with the strangers once the center is known to be too far."""
    draw = np.random.default_rng(9)
    base = draw.integers(1, 1 << 62, 60, dtype=np.uint64)
    family = [np.unique(np.append(base, np.uint64(k + 1))) for k in range(300)]
    strangers = [np.unique(np.concatenate((base[:20], draw.integers(1, 1 << 62, 40, dtype=np.uint64)))) for _ in range(5)]
    sets = family + strangers
    rows, buckets = _frames(spark, sets, {k: [0, *range(1 + k, 300, 7), 300 + k % 5] for k in range(40)})
    homes = set_links._homes(rows, set_links._stars(rows, minhash.candidate_ties(buckets), 80, 512))
    assert set_links._bucket_units(buckets, homes, 512).count() < 40
    links = set_links.star_links(rows, minhash.candidate_ties(buckets), buckets, 80, 512).collect()
    assert set(_components(range(305), [tuple(r) for r in links]).values()) == {0, *range(300, 305)}


def test_overlap():
    draw = np.random.default_rng(3)
    for _ in range(50):
        a, b = (np.unique(draw.integers(0, 40, draw.integers(1, 30)).astype(np.uint64)) for _ in range(2))
        assert set_links.overlap(a, b) == len(np.intersect1d(a, b))

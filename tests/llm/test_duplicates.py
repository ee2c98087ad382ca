"""Near-duplicates of texts and vectors, repeated strings and components against brute force."""

import hashlib
import itertools
import random
import re
from collections import Counter

import numpy as np
import pytest
from tests.llm.conftest import LONG, prose

from sparkloom.llm import embed_dedup, minhash, substring_dedup
from sparkloom.llm.components import connected_components


def _components(nodes, links):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components(spark):
    draw = random.Random(1)
    edges = [(k, k + 1) for k in range(100, 160)] + [(draw.randrange(40), draw.randrange(40)) for _ in range(25)]
    edges += [(500, 500), (7, 8), (8, 7)]
    df = spark.createDataFrame([*edges, (None, 3)], "a bigint, b bigint")
    got = {r.node: r.component for r in connected_components(df, "a", "b").collect()}
    assert got == _components({n for e in edges for n in e}, edges)
    assert connected_components(df.filter("a < 0"), "a", "b").collect() == []


def _sets(texts, k):
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    out = {}
    for i, t in texts.items():
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(low))
        out[i] = {tuple(w[j:j + k]) for j in range(max(1, len(w) - k + 1))} if w else set()
    return out


def _families(seed=3):
    """Families of texts with more and more words changed, and unrelated ones."""
    draw, texts = random.Random(seed), {}
    for family in range(12):
        base = prose(family, 120).split()
        for copy in range(8):
            words = list(base)
            for _ in range(draw.randrange(0, 9)):
                words[draw.randrange(len(words))] = f"x{draw.randrange(10**6)}"
            texts[len(texts)] = " ".join(words) if copy % 2 else " ".join(words).upper()
    return texts | {len(texts) + k: prose(1000 + k, 40) for k in range(40)}


@pytest.mark.parametrize("words, percent, block", [(3, 85, 512), (5, 80, 3)])
def test_near_duplicates_equal_brute_force(frame, words, percent, block):
    texts = _families() | {900: "one", 901: "One", 902: "two words", 903: "", 904: None, 905: "", 906: " \n"}
    sets = _sets(texts, words)
    links = [(a, b) for a, b in itertools.combinations(texts, 2)
             if sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    want = _components(texts, links)
    params = minhash.MinHashParams(words=words, percent=percent, block=block, broadcast_rows=10 if block == 3 else 1000)
    got = {r.doc_id: r for r in minhash.near_duplicates(frame(texts.items()), params).collect()}
    assert {i: r.component_id for i, r in got.items()} == want
    assert {i: r.n_shingles for i, r in got.items()} == {i: len(s) for i, s in sets.items()}
    assert all(r.kept == (i == want[i]) for i, r in got.items())
    kept = {r.doc_id for r in minhash.drop_near_duplicates(frame(texts.items()), params).collect()}
    assert kept == set(want.values())


def test_near_duplicates_awkward_rows(awkward, no_docs):
    got = minhash.near_duplicates(awkward).collect()
    by_id = {r.doc_id: r for r in got}
    assert len(got) == 12 and by_id[6].component_id == 5 and by_id[9].component_id == 8 and not by_id[9].kept
    assert by_id[None].kept and by_id[None].component_id is None and by_id[2].n_shingles == 0
    left = minhash.drop_near_duplicates(awkward)
    assert left.columns == awkward.columns
    assert sorted(r.doc_id or 0 for r in left.collect()) == [0, 1, 2, 3, 4, 5, 7, 8, 10]
    assert minhash.near_duplicates(no_docs).collect() == []
    assert minhash.drop_near_duplicates(no_docs).collect() == []


@pytest.mark.parametrize("rows", [1000, 0])
def test_ids_repeated_with_other_texts(frame, rows):
    base, alone = prose(1, 60), [prose(k, 60) for k in range(2, 9)]
    near, nearer = base + " one", base + " one two"
    docs = [(3, base), (7, near), (7, alone[0]), (8, alone[1]), (8, alone[2]), (8, alone[2]), (9, alone[3]),
            (9, alone[3] + " x"), (10, None), (10, ""), (10, alone[4]), (11, nearer), (11, near), (12, alone[5]),
            (12, alone[5].upper()), (13, alone[0] + " y"), (None, base), (None, base)]
    params = minhash.MinHashParams(words=5, percent=80, broadcast_rows=rows)
    got = minhash.near_duplicates(frame(docs), params).collect()
    found = Counter((r.doc_id, r.component_id, r.kept) for r in got if r.doc_id != 9)
    assert found == Counter([(3, 3, True), (7, 3, False), (7, 7, True), *[(8, 8, True)] * 3, *[(10, 10, True)] * 3,
                             (11, 3, False), (11, 3, False), (12, 12, True), (12, 12, True), (13, 7, False),
                             (None, None, True), (None, None, True)])
    assert sorted((r.component_id, r.kept) for r in got if r.doc_id == 9) == [(9, False), (9, True)]
    left = [(r.doc_id, r.text) for r in minhash.drop_near_duplicates(frame(docs), params).collect()]
    nine = [t for i, t in left if i == 9]
    assert len(nine) == 1 and nine[0] in (alone[3], alone[3] + " x")
    assert Counter(d for d in left if d[0] != 9) == Counter(
        [(3, base), (7, alone[0]), (8, alone[1]), (8, alone[2]), (10, ""), (10, alone[4]), (12, alone[5].upper()),
         (None, base), (None, base)])


def test_enough_tables_for_the_threshold():
    for percent in (80, 85, 90):
        p = minhash.MinHashParams(percent=percent)
        assert 2 * (1 - (percent / 100) ** p.half) ** p.collection <= 1e-4
    assert minhash.MinHashParams(percent=100).collection == 2


# --- Repeated strings ------------------------------------------------------------------------------


def _repeats(texts, length):
    raw = {i: (t or "").encode() for i, t in texts.items()}
    seen = Counter(b[s:s + length] for b in raw.values() for s in range(len(b) - length + 1))
    out = {}
    for i, b in raw.items():
        covered = np.zeros(len(b) + 1, int)
        for s in range(len(b) - length + 1):
            if seen[b[s:s + length]] > 1:
                covered[s] += 1
                covered[s + length] -= 1
        gone = np.cumsum(covered[:-1]) > 0
        kept = bytes(c for c, g in zip(b, gone) if not g)
        spans = int(((np.diff(gone.astype(int), prepend=0)) == 1).sum())
        out[i] = (len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest())
    return out


def _repeat_texts():
    draw = random.Random(5)
    shared = [prose(k, 60) for k in range(6)]
    texts = {}
    for k in range(40):
        parts = [prose(100 + k, draw.randrange(0, 50))]
        for _ in range(draw.randrange(0, 4)):
            cut = draw.choice(shared)
            a = draw.randrange(len(cut))
            parts += [cut[a:a + draw.randrange(20, 200)], prose(draw.randrange(10**6), draw.randrange(0, 9))]
        texts[k] = " ".join(parts)
    return texts | {50: "ab" * 300, 51: "ab" * 90, 52: "x", 53: "", 54: None, 55: "ünï " * 80, 56: "ünï " * 20,
                    57: "a" * 1000, 58: prose(7, 30), 59: prose(7, 30)}


@pytest.mark.parametrize("hot, widths", [(5000, (16, 1)), (1, (16, 1)), (3, (16, 1)), (1, (7,))])
def test_repeats_equal_brute_force(frame, hot, widths):
    texts = _repeat_texts()
    # A passage of 50 bytes with many neighbours on both sides, some of which come again.
    for k in range(60):
        texts[100 + k] = f"{prose(k % 23, 4)[-9:]} {'the same words between other ones, fifty bytes in.'} {prose(k % 17, 4)[:9]}"
    params = substring_dedup.RepeatParams(length=60, probe=20, block_bytes=2000, hot_stretches=hot, widths=widths)
    got = substring_dedup.remove_repeats(frame(texts.items()), params).collect()
    want = _repeats(texts, 60)
    assert {r.doc_id: (r.n_bytes, r.n_removed, len(r.spans), hashlib.sha256(r.kept).hexdigest()) for r in got} == want


def test_sorted_block_finds_equal_suffixes():
    draw = np.random.default_rng(1)
    for size, letters, length in ((400, 2, 20), (900, 3, 31), (300, 1, 50), (500, 26, 15)):
        raw = draw.integers(97, 97 + letters, size).astype(np.uint8)
        raw = np.concatenate((raw, raw[:size // 3]))
        starts = np.arange(len(raw) - length + 1)
        seen = Counter(raw[s:s + length].tobytes() for s in starts)
        want = [seen[raw[s:s + length].tobytes()] > 1 for s in starts]
        assert substring_dedup.repeated_starts(raw, starts, length).tolist() == want


def test_divided_buckets_part_no_equal_strings(frame):
    raws = [(f"{a:03d}" * 9 + "x" * 45 + f"{b:03d}" * 9).encode() for a in range(3) for b in range(4)]
    params = substring_dedup.RepeatParams(length=60, probe=20)
    spark = frame([]).sparkSession
    rows = spark.createDataFrame([(k, 0, 0, len(r) - 60, 30, 5, bytearray(r)) for k, r in enumerate(raws)],
                                 "id bigint, h bigint, first bigint, last bigint, before int, bucket bigint, stretch binary")
    for width in (16, 5, 1):
        places: dict[bytes, set] = {}
        seen = set()
        for p in substring_dedup.finer_picks(rows, params, width, "bigint").collect():
            assert p.last - p.first < width and p.first + p.before == 30
            for start in range(p.first, p.last + 1):
                assert (p.id, start) not in seen
                seen.add((p.id, start))
                places.setdefault(raws[p.id][start:start + 60] + b"%d" % (30 - start), set()).add(p.bucket)
        assert seen == {(k, s) for k, r in enumerate(raws) for s in range(len(r) - 60 + 1)}
        assert all(len(buckets) == 1 for buckets in places.values())


def test_cover_holds_every_distance():
    cover, m = substring_dedup.COVER, substring_dedup.MODULUS
    assert {(a - b) % m for a in cover for b in cover} == set(range(m))


def test_repeats_awkward_rows(awkward, no_docs):
    got = {r.doc_id: r for r in substring_dedup.remove_repeats(awkward).collect()}
    assert got[5].n_removed == got[6].n_removed == len(LONG) and got[5].kept == b""
    assert got[1].n_bytes == 0 and got[1].spans == [] and got[4].n_removed == 0 and got[None].n_removed == 0
    assert got[8].n_removed == got[8].n_bytes == 640
    assert substring_dedup.remove_repeats(no_docs).collect() == []


# --- Vectors ---------------------------------------------------------------------------------------


def _vectors():
    draw = np.random.default_rng(8)
    rows, k = [], 0
    for family in range(15):
        base = draw.normal(size=32)
        base /= np.linalg.norm(base)
        for _ in range(12):
            step = draw.normal(size=32)
            step /= np.linalg.norm(step)
            v = base + step * draw.uniform(0, 0.25)
            rows.append((k, [float(np.float32(x)) for x in v], family % 3))
            k += 1
    rows += [(k, rows[0][1], 0), (k + 1, [2 * x for x in rows[0][1]], 0), (k + 2, rows[0][1], 1), (k + 3, rows[0][1], None)]
    return rows


@pytest.mark.parametrize("block", [1024, 5])
def test_vectors_equal_brute_force(spark, block):
    rows = _vectors()
    links = []
    for (a, x, la), (b, y, lb) in itertools.combinations(rows, 2):
        if la == lb and la is not None:
            x, y = np.array(x), np.array(y)
            if x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= 0.98:
                links.append((a, b))
    want = _components([r[0] for r in rows], links)
    degree = Counter(n for link in links for n in link)
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int")
    got = embed_dedup.near_vectors(df, embed_dedup.PolytopeParams(block=block)).collect()
    assert {r.vec_id: (r.n_links, r.component_id, r.kept) for r in got} == {
        i: (degree[i], c, i == c) for i, c in want.items()}


def test_vectors_awkward_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None, 0), (2, [], 0), (3, [0.0, 0.0], 0), (4, [nan, 1.0], 0), (5, [inf, 1.0], 0), (6, [None, 1.0], 0),
            (7, [1.0, 1.0], None), (8, [1e200, 1e200], 0), (9, [1e-200, 1e-200], 0), (10, [1.0, 1.0, 0.0], 0),
            (None, [1.0, 1.0], 0), (11, [5.0], 0), (12, [7.0], 0), (13, [-7.0], 0)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id bigint, embedding array<double>, label int, id string")
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in embed_dedup.near_vectors(df).collect()}
    assert len(got) == 14
    assert got[8] == (1, 8, True) and got[9] == (1, 8, False)
    assert got[11] == (1, 11, True) and got[12] == (1, 11, False) and got[13] == (0, 13, True)
    assert got[None] == (0, None, True)
    assert all(got[i] == (0, i, True) for i in (1, 2, 3, 4, 5, 6, 7, 10))
    assert embed_dedup.near_vectors(df.filter("vec_id < 0")).collect() == []


def test_vectors_of_a_mixed_cluster_are_compared_by_label_and_length(spark):
    """As if all keys had fallen together: one cluster of two labels and two lengths, in one block and in several."""
    draw = np.random.default_rng(4)
    base = {("a", 4): draw.normal(0, 1, 4), ("b", 4): None, ("a", 8): draw.normal(0, 1, 8), ("c", 4): draw.normal(0, 1, 4)}
    base["b", 4] = base["a", 4]  # equal vectors of different labels
    rows = []
    for (label, length), center in base.items():
        for _ in range(6):
            rows.append((len(rows), 1 + len(rows) % 3, label, (center + draw.normal(0, 0.01, length)).tobytes()))
    ones = spark.createDataFrame([(n, c, l, bytearray(v)) for n, c, l, v in rows], "node bigint, copies bigint, label string, vec binary")
    members = spark.createDataFrame([(r[0], 0) for r in rows], "node bigint, component bigint")
    for block in (100, 7, 2):
        got = embed_dedup._compared(ones, members, embed_dedup.PolytopeParams(block=block)).collect()
        degree = Counter()
        for r in got:
            if r.y is None:
                degree[r.x] += r.n
        want = {n: sum(c2 for m, c2, l2, v2 in rows if m != n and l2 == l and len(v2) == len(v)) for n, _, l, v in rows}
        assert degree == want
        assert set(_components([r[0] for r in rows], [(r.x, r.y) for r in got if r.y is not None]).values()) == {0, 6, 12, 18}


def test_vectors_of_a_repeated_id_are_judged_each(spark):
    rows = [(1, [1.0, 0.0], 0), (2, [0.0, 1.0], 0), (2, [1.0, 0.01], 0), (3, [0.0, 1.01], 0), (3, [0.0, 1.01], 0), (9, [1.0, 0.0], 1)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int")
    got = sorted(tuple(r) for r in embed_dedup.near_vectors(df).collect())
    assert got == [(1, 1, 1, True), (2, 1, 1, False), (2, 2, 2, True), (3, 2, 2, False), (3, 2, 2, False), (9, 0, 9, True)]


@pytest.mark.parametrize("vectors, least", [(10**5, 0.999), (10**7, 0.995), (10**9, 0.99)])
def test_recall_of_the_hashing_stage(vectors, least):
    """Pairs at exactly the threshold, with keys as long as for so many vectors: one of the two lives where the
    other lives or probes."""
    params, draw = embed_dedup.PolytopeParams(), np.random.default_rng(8)
    x = draw.normal(0, 1, (3000, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    side = draw.normal(0, 1, x.shape)
    side -= (side * x).sum(axis=1, keepdims=True) * x
    side /= np.linalg.norm(side, axis=1, keepdims=True)
    y = 0.98 * x + np.sqrt(1 - 0.98 ** 2) * side
    bits = int(np.ceil(np.log2(params.room * vectors)))
    keys = [embed_dedup.Hasher(64, bits, params)(v).reshape(len(v), params.tables, -1) for v in (x, y)]
    meet = np.zeros(len(x), bool)
    for a, b in (keys, keys[::-1]):
        meet |= (a[:, :, :1] == b).any(axis=(1, 2))
    assert meet.mean() >= least


def test_hadamard_is_orthonormal():
    eye = embed_dedup.hadamard(np.eye(16))
    assert np.allclose(eye @ eye.T, np.eye(16)) and np.allclose(np.abs(eye), 0.25)

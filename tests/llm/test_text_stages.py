"""Personal data, decontamination and the pipeline."""

import itertools
import random
import re

import pytest
from tests.llm.conftest import awkward_rows, prose

import corpus_pipeline
from sparkloom.llm import decontam, minhash, pii
from sparkloom.scratch import freeze


def _base(text):
    out = [("email", m.start(), m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [("ip", m.start(), m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text)
            if all(int(p) <= 255 for p in m.group().split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m.group())
        total = sum(sum(divmod(int(c) * (1 + k % 2), 10)) for k, c in enumerate(reversed(digits)))
        if 13 <= len(digits) <= 19 and total % 10 == 0:
            out.append(("card", m.start(), m.end()))
    out += [("phone", m.start(), m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text)
            if 9 <= len(re.sub("[^0-9]", "", m.group())) <= 15]
    return out


def test_base_spans_equal_the_patterns():
    draw = random.Random(1)
    for _ in range(4000):
        text = "".join(draw.choice("a.@-+ 019(2)5é%_\n٣") for _ in range(draw.randrange(40)))
        assert pii.base_spans(text) == _base(text), text


@pytest.fixture(scope="module")
def weights(frame):
    return pii.train_pii(frame([(1, "call +1 (017) 555-7713 or mail a.b@example.org, license 2.0, 12345")]))


def test_field_adds_what_patterns_run_together(weights):
    text = "x 4111111111111111 5500005555555559 y +1 (017) 555-7713 190.137.223.204 z josé.7@mail.example.com."
    base, spans = pii.all_spans(text, weights)
    assert set(base) <= set(spans)
    found = {(k, text[a:b]) for k, a, b in spans}
    assert {("card", "4111111111111111"), ("card", "5500005555555559"), ("phone", "+1 (017) 555-7713"),
            ("ip", "190.137.223.204")} <= found
    assert pii.all_spans("License 2.0, chapter 3.1.4, id 1234567890123456, 2024-01-02", weights) == ([], [])
    assert pii.mask("a 4111111111111111 b", [("card", 2, 18)]) == "a [card] b"


def test_decoding_is_the_best_segmentation(weights):
    text = "+1 (017) 555-7713 4111111111111111"
    lat = pii.lattice(text, 0, len(text))
    value = {(k, lat.offsets[i], lat.offsets[j]): sum(weights.get((k, f), 0.0) for f in fs)
             for j in range(len(lat.ends)) for i, fs in lat.ends[j] for k in pii.KINDS}

    def best(at):
        options = [0.0] + [v + best(b) for (_, a, b), v in value.items() if a >= at and v > 0]
        return max(options)

    assert sum(value[s] for s in pii.decode(weights, lat)) == pytest.approx(best(0))


def test_pii_awkward_rows(awkward, no_docs, weights):
    got = {r.doc_id: r for r in pii.find_pii(awkward, weights).collect()}
    assert got[1].spans == [] and got[5].base == []
    assert [s["kind"] for s in got[7].base] == ["email", "ip", "phone"]
    masked = pii.mask_pii(awkward, weights)
    assert masked.columns == awkward.columns
    texts = {r.doc_id: r.text for r in masked.collect()}
    assert texts[1] is None and texts[2] == "" and texts[7].endswith(" [email] [phone]")
    assert pii.find_pii(no_docs, weights).collect() == [] and pii.mask_pii(no_docs, weights).collect() == []


# --- Decontamination -------------------------------------------------------------------------------


def _tokens(text):
    return [w for w in re.split(r"[^\w]+|_", (text or "").lower()) if w]


def _overlap(doc, item, window=20, percent=80):
    a, b = _tokens(doc), _tokens(item)
    if len(b) < decontam.SPAN:
        return False
    w = min(window, len(b))
    for shift in range(-len(b), len(a)):
        agree = [0 <= shift + k < len(a) and a[shift + k] == b[k] for k in range(len(b))]
        if any(100 * sum(agree[s:s + w]) >= percent * w for s in range(len(b) - w + 1)):
            return True
    return False


def test_overlaps_equal_brute_force(spark, frame):
    draw = random.Random(9)
    items = {k: prose(k, draw.randrange(3, 40), 300) for k in range(25)} | {90: None, 91: "", 92: prose(0, 39, 300)}
    items[93] = items[1]
    docs = {}
    for k in range(60):
        words = prose(500 + k, 40, 300).split()
        if k % 2:
            leak = (items[draw.randrange(25)]).split()
            for _ in range(len(leak) * draw.randrange(0, 25) // 100):
                leak[draw.randrange(len(leak))] = f"y{draw.randrange(999)}"
            at = draw.randrange(40)
            words[at:at] = [w.upper() + "!!" for w in leak]
        docs[k] = " ".join(words)
    docs |= {100: None, 101: ""}
    table = spark.createDataFrame(list(items.items()), "item_id bigint, text string")
    for rows in (500_000, 3):
        got = {(r.doc_id, r.item_id) for r in decontam.overlaps(frame(docs.items()), table, broadcast_rows=rows).collect()}
        want = {(d, i) for d, t in docs.items() for i, item in items.items() if _overlap(t, item)}
        assert got <= want
        # Seeds may miss a leak with many words changed, never one with few.
        assert len(got) >= 0.9 * len(want)
    clean = {r.doc_id for r in decontam.drop_contaminated(frame(docs.items()), table).collect()}
    assert clean == set(docs) - {d for d, _ in got}


def test_masks_fit_between_all_placements_of_differing_words():
    for n in range(decontam.SPAN, 21):
        seeds = [sum(1 << (at + o) for o in mask) for mask in decontam.MASKS for at in range(n - mask[-1])]
        for gone in itertools.combinations(range(n), n // 5):
            assert not all(s & sum(1 << g for g in gone) for s in seeds), (n, gone)


def test_overlaps_with_as_many_words_changed_as_allowed(spark, frame):
    items = {n: " ".join(f"i{n}w{k}" for k in range(n)) for n in (8, 9, 10, 15, 16, 20, 23)}
    docs, draw = {}, random.Random(4)
    for n, item in items.items():
        for gone in draw.sample(list(itertools.combinations(range(min(n, 20)), min(n, 20) // 5)), 8 if n < 10 else 45):
            leak = [f"z{k}" if k in gone else w for k, w in enumerate(item.split())]
            docs[len(docs)] = " ".join(leak + ["tail"] * (len(docs) % 3))
    docs[len(docs)] = items[8].split(" ", 1)[1]
    docs[len(docs)] = " ".join(items[10].split()[:7])
    table = spark.createDataFrame(list(items.items()), "item_id bigint, text string")
    got = {(r.doc_id, r.item_id) for r in decontam.overlaps(frame(docs.items()), table).collect()}
    assert got == {(d, i) for d, t in docs.items() for i, item in items.items() if _overlap(t, item)}


def test_overlaps_awkward_rows(spark, awkward, no_docs):
    table = spark.createDataFrame([(1, "The same words. The same words. The same words."), (2, None), (None, "a b"), (3, "a")],
                                  "item_id bigint, text string")
    got = {(r.doc_id, r.item_id) for r in decontam.overlaps(awkward, table).collect()}
    assert got == {(8, 1), (9, 1)}
    left = decontam.drop_contaminated(awkward, table)
    assert left.columns == awkward.columns and left.count() == 10
    assert decontam.overlaps(no_docs, table).collect() == []
    assert decontam.overlaps(awkward, table.filter("item_id < 0")).collect() == []


def test_no_python_in_decontamination(frame, spark):
    table = spark.createDataFrame([(1, prose(1, 30))], "item_id bigint, text string")
    plan = decontam.overlaps(frame([(1, prose(1, 60))]), table)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|ArrowEval|MapInArrow", plan)


# --- The pipeline ----------------------------------------------------------------------------------


def test_pipeline_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert len(corpus_pipeline.STAGES) == 5
    for name, stage in corpus_pipeline.STAGES:
        before, out = docs, freeze(spark, stage(spark, docs, sf_dir), name)
        if name != "best_fit_packing":
            assert out.columns == docs.columns and dict(out.dtypes) == dict(docs.dtypes)
        ids = {r.doc_id for r in out.select("doc_id").distinct().collect()}
        all_ids = {r.doc_id for r in before.select("doc_id").collect()}
        assert ids <= all_ids
        if name == "near_duplicates":
            found = minhash.near_duplicates(before, minhash.MinHashParams(words=5, percent=80)).filter("kept").collect()
            assert ids == {r.doc_id for r in found}
        elif name == "benchmark_decontamination":
            items = spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()
            rows = {r.doc_id: r.text for r in before.collect()}
            assert ids == {d for d, t in rows.items() if not any(_overlap(t, i.text) for i in items)}
        elif name == "personal_data":
            texts = [r.text for r in out.collect()]
            assert ids == all_ids and not any(_base(t or "") for t in texts)
        elif name == "best_fit_packing":
            assert ids == all_ids
        docs = out


@pytest.mark.parametrize("rows", [0, 12])
def test_stages_on_awkward_rows(spark, awkward, no_docs, rows, tmp_path):
    names = ["doc_id", "text", "lang", "source", "n_chars"]
    folder = str(tmp_path / "in")
    spark.createDataFrame([], "doc_id bigint, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([], "item_id bigint, text string").write.parquet(f"{folder}/benchmark.parquet")
    (awkward if rows else no_docs).select(*names).write.parquet(f"{folder}/documents.parquet")
    got = corpus_pipeline.run(spark, folder).collect()
    kept = {r[0] for r in awkward_rows()} - {6, 9} if rows else set()
    assert {r.doc_id for r in got} == kept

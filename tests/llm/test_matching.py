"""Archives, similarity, containment, language models, toxicity and the pipeline."""

import base64
import hashlib
import math
import random
import re
import zlib
from collections import Counter

import corpus_pipeline
import numpy as np
import pytest
from llm_frames import AWKWARD, LONG, documents
from pyspark.sql import functions as F

from payments_lake.llm import toxicity, warc, whole_model
from payments_lake.llm.common import shared_folder, written
from payments_lake.llm.components import components
from payments_lake.llm.decontamination import contained_items, decontaminated
from payments_lake.llm.jaccard_join import linked_components, one_per_component


def pages(spark, payloads):
    rows = [(i, f"http://a.example/{i} x\n" if i % 3 else None, p, "extra") for i, p in enumerate(payloads)]
    return spark.createDataFrame(rows, "page_id bigint, url string, html string, sha1 string")


PAYLOADS = [None, "", "a", "a", LONG, "WARC/1.1\r\n\r\nWARC/1.1\r\n", "b" * 65536, "c" * 65537, "a", LONG, "é\r\n\r\n"]


def test_archives_round_trip(spark):
    data = [(p or "").encode() for p in PAYLOADS]
    out = {r.page_id: r for r in warc.archived_pages(pages(spark, PAYLOADS)).collect()}
    assert len(out) == len(data)
    for i, payload in enumerate(data):
        last = max(j for j, other in enumerate(data) if other == payload)
        assert out[i].payload_bytes == len(payload)
        assert out[i].payload_digest == base64.b32encode(hashlib.sha1(payload).digest()).decode()
        assert (out[i].record_type, out[i].refers_to) == (("response", None) if last == i else ("revisit", last))
    assert warc.archived_pages(pages(spark, [])).count() == 0


def test_small_payloads_stay_responses(spark):
    out = {r.page_id: r.record_type for r in warc.archived_pages(pages(spark, PAYLOADS), min_bytes=2).collect()}
    assert out[0] == out[1] == out[2] == out[3] == out[8] == "response" and out[4] == "revisit"


def test_chunks_carry_data_and_digests(spark):
    archives = warc.write_archives(pages(spark, PAYLOADS), shared_folder(spark) + "/warc")
    rows = warc.read_chunks(spark, archives, chunk=1000).filter("record_type = 'response'").collect()
    by_page = {}
    for r in sorted(rows, key=lambda r: (r.page_id, r.chunk_no)):
        data = by_page[r.page_id] = by_page.get(r.page_id, b"") + bytes(r.data)
        assert len(r.data) == r.chunk_bytes <= 1000 and r.payload_bytes == len(data)
        assert r.payload_digest == base64.b32encode(hashlib.sha1(data).digest()).decode()
    for i, data in by_page.items():
        assert data == (PAYLOADS[i] or "").encode()


def test_rows_without_id_and_repeated_rows(spark):
    frame = pages(spark, ["a", "a"]).unionAll(pages(spark, ["a", "a"]))
    frame = frame.unionAll(frame.limit(1).withColumn("page_id", F.lit(None).cast("bigint")))
    out = [(r.page_id, r.record_type, r.refers_to) for r in warc.archived_pages(frame).collect()]
    assert sorted(out, key=str) == sorted(
        [(0, "revisit", 1)] * 2 + [(1, "response", None)] * 2 + [(None, "revisit", 1)], key=str
    )


def shingle_sets(texts):
    out = []
    for text in texts:
        words = (text or "").encode().lower().split()
        out.append({tuple(words)} if 0 < len(words) < 5 else {tuple(words[i : i + 5]) for i in range(len(words) - 4)})
    return out


def near_copies(seed, groups=12, copies=9, words=120):
    """Texts in chains of edits, so that links also join what isn't similar itself."""
    draw, texts = random.Random(seed), []
    for _ in range(groups):
        base = [f"w{draw.randint(0, 5000)}" for _ in range(draw.randint(8, words))]
        for _ in range(copies):
            at = draw.randrange(len(base))
            base = [*base[:at], *(f"n{draw.randint(0, 99999)}" for _ in range(draw.randint(1, 2))), *base[at + 1 :]]
            texts.append(" ".join(base).upper() if draw.random() < 0.3 else " ".join(base))
    passage = " ".join(f"p{i}" for i in range(40))
    texts += [f"{passage} " + " ".join(f"u{i}x{j}" for j in range(80)) for i in range(70)]
    return texts


def brute_components(texts):
    sets = shingle_sets(texts)
    label = list(range(len(texts)))
    for i, a in enumerate(sets):
        for j in range(i):
            shared = len(a & sets[j])
            if shared and 100 * shared >= 75 * (len(a) + len(sets[j]) - shared):
                low, high = sorted((label[i], label[j]))
                label = [low if x == high else x for x in label]
    return [(len(s), c) for s, c in zip(sets, label, strict=True)]


@pytest.mark.parametrize("seed", [1, 2])
def test_components_equal_brute_force(spark, seed):
    texts = AWKWARD + near_copies(seed)
    random.Random(seed).shuffle(texts)
    out = {r.doc_id: (r.n_shingles, r.component_id) for r in linked_components(documents(spark, texts)).collect()}
    assert [out[i] for i in range(len(texts))] == brute_components(texts)


def smallest_linked(texts):
    """The smallest linked number of each text, by all pairs."""
    sets = shingle_sets(texts)
    label = list(range(len(texts)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and 100 * both >= 75 * len(a | sets[j]) and root(i) != root(j):
                label[max(root(i), root(j))] = min(root(i), root(j))
    return [root(i) for i in range(len(texts))]


def edited_copies(draw, words, n, edits):
    out = []
    for _ in range(n):
        copy = list(words)
        for _ in range(draw.choice(edits)):
            copy[draw.randrange(len(copy))] = f"w{draw.randrange(10**9)}"
        out.append(" ".join(copy))
    return out


def test_large_group_of_near_copies_with_stragglers(spark):
    """Copies with few changes link with the original; those with three or four changed places lie
    on both sides of the threshold, some linked with a few members only."""
    draw = random.Random(11)
    words = [f"v{i}" for i in range(130)]
    texts = edited_copies(draw, words, 300, [0, 1, 1, 2, 2, 3, 3, 4, 4, 5]) + edited_copies(draw, words[:110], 60, [0, 1, 2, 3])
    texts += edited_copies(draw, [f"u{i}" for i in range(60)], 40, [0, 1, 1, 2]) + [" ".join(words)] * 5
    draw.shuffle(texts)
    found = {r.doc_id: r.component_id for r in linked_components(documents(spark, texts)).collect()}
    assert [found[i] for i in range(len(texts))] == smallest_linked(texts)
    assert 2 < len(set(found.values())) < len(texts)


@pytest.mark.parametrize("seed", range(2))
def test_links_without_pivots(spark, monkeypatch, seed):
    """The matrix alone finds all links, large groups or small."""
    monkeypatch.setattr("payments_lake.llm.jaccard_join.ROUNDS", 0)
    draw = random.Random(seed)
    texts = [t for k in range(8) for t in edited_copies(draw, [f"{k}x{i}" for i in range(30 + 20 * k)], 14, range(6))]
    found = {r.doc_id: r.component_id for r in linked_components(documents(spark, texts)).collect()}
    assert [found[i] for i in range(len(texts))] == smallest_linked(texts)


def test_one_row_of_each_component_whatever_repeats(spark):
    a, b = "the quick brown fox jumps over the lazy dog while seven wise owls watch " * 3, "entirely different words are written in this other text here " * 3
    rows = [(3, a, "x"), (5, a, "x"), (5, b, "x"), (7, b, "y"), (7, b, "y"), (8, None, "x"), (8, None, "x"), (8, "", "z"), (None, a, "x"), (None, a, "x")]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, `a.b` string").withColumn("group", F.lit(1)).withColumn("_doc_id", F.lit(2))
    kept = one_per_component(frame)
    assert kept.columns == frame.columns
    got = sorted((r.doc_id if r.doc_id is not None else -1, (r.text or "")[:5]) for r in kept.collect())
    assert got == [(-1, a[:5]), (-1, a[:5]), (3, a[:5]), (5, b[:5]), (8, "")]
    # Rows that differ in another column only: always the same one stays.
    ties = spark.createDataFrame([(1, a, "p"), (1, a, "q")], "doc_id bigint, text string, `a.b` string")
    assert len({one_per_component(ties.orderBy(F.desc("`a.b`")) if i else ties).first()["a.b"] for i in range(2)}) == 1
    assert one_per_component(frame.limit(0)).collect() == []


def test_one_document_of_each_component_stays(spark):
    texts = AWKWARD + near_copies(3, groups=4)
    frame = documents(spark, texts)
    frame = frame.unionAll(frame.filter("doc_id = 3")).unionAll(
        frame.filter("doc_id = 4").withColumn("doc_id", F.lit(None).cast("bigint"))
    )
    kept = one_per_component(frame)
    assert kept.columns == frame.columns
    expected = sorted({c for _, c in brute_components(texts)})
    assert sorted(r.doc_id for r in kept.filter("doc_id is not null").collect()) == expected
    assert kept.filter("doc_id is null").count() == 1
    assert linked_components(documents(spark, [])).count() == 0


def test_components_of_a_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 50), (50, 100), (7, 7)], "a long, b long")
    out = {r.node: r.component for r in components(links).collect()}
    assert out == {**{i: 0 for i in range(41)}, 50: 50, 100: 50}


def test_contained_items_equal_brute_force(spark):
    draw = random.Random(7)
    items = [" ".join(f"b{draw.randint(0, 9999)}" for _ in range(n)) for n in (5, 6, 9, 14, 30, 59, 200)] + [None, "", "one two"]
    texts = list(AWKWARD)
    for item in items[:7]:
        words = item.split()
        filler = [f"f{draw.randint(0, 99999)}" for _ in range(3000)]
        for share in (1.0, 0.9, 0.8, 0.5):
            at = draw.randrange(3000)
            texts.append(" ".join([*filler[:at], *words[: int(len(words) * share)], *filler[at:]]))
    frame = documents(spark, texts)
    benchmark = spark.createDataFrame([(i, t, 1) for i, t in enumerate(items)], "item_id bigint, text string, doc_id int")
    wanted = shingle_sets(items)
    expected = {
        (i, j, len(q), len(q & s))
        for i, s in enumerate(shingle_sets(texts)) for j, q in enumerate(wanted)
        if q and 100 * len(q & s) >= 75 * len(q)
    }
    for block in (32 << 20, 300):
        found = contained_items(frame, benchmark, block_bytes=block).collect()
        assert {(r.doc_id, r.item_id, r.n_item_shingles, r.n_shared) for r in found} == expected
        assert len(found) == len(expected)
        kept = decontaminated(frame, benchmark, block_bytes=block)
        assert kept.columns == frame.columns
        assert {r.doc_id for r in kept.collect()} == set(range(len(texts))) - {i for i, *_ in expected}
    assert contained_items(documents(spark, []), benchmark).count() == 0
    assert contained_items(frame, benchmark.filter("false")).count() == 0


@pytest.mark.parametrize("chunk", [1, 7, 200])
def test_long_texts_are_hashed_in_pieces(monkeypatch, chunk):
    texts = [(t or "").encode() for t in [*AWKWARD, " lead and trail \n", "x" * 500, "x y\x0bz\x1c " * 40]]
    hashes, sizes = whole_model.hashed_words(texts)
    assert sizes.tolist() == [len(t.split()) for t in texts]
    monkeypatch.setattr(whole_model, "CHUNK", chunk)
    again, same = whole_model.hashed_words(texts)
    assert again.tolist() == hashes.tolist() and same.tolist() == sizes.tolist()
    assert [len(x) for x in whole_model.hashed_words([])] == [0, 0]


def brute_difference(texts, target):
    """Every word and pair counted in plain Python; the background is all other documents."""
    def grams(text):
        words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
        return words, list(zip([None, *words], words))

    def model(texts, scale):
        words, pairs, befores = Counter(), Counter(), Counter()
        for own, joined in map(grams, texts):
            words.update(own)
            pairs.update(joined)
            befores.update(a for a, _ in joined)
        total = sum(words.values()) * scale

        def loss(text):
            logs = []
            for a, b in grams(text)[1]:
                p_word = (words[b] * scale + 0.5) / (total + 0.5 * size)
                p_pair = (pairs[a, b] * scale + 50 * p_word) / (befores[a] * scale + 50)
                logs.append(-math.log(0.6 * p_pair + 0.4 * p_word))
            return sum(logs) / max(len(logs), 1)

        return loss

    size = len({w for t in [*texts, *target] for w in grams(t)[0]})
    sums = [max(sum(len(grams(t)[0]) for t in table), 1) for table in (texts, target)]
    wanted = model(target, 1.0)
    for i, text in enumerate(texts):
        yield len(grams(text)[0]), wanted(text), model(texts[:i] + texts[i + 1 :], sums[1] / sums[0])(text)


@pytest.mark.parametrize("parts, stretch", [(None, None), (7, 60), (1, 1)])
def test_whole_cross_entropy_equals_brute_force(spark, parts, stretch):
    """Rare words and pairs count like all others."""
    draw = random.Random(11)
    rare = [f"R{draw.randrange(3000)}" for _ in range(4000)]
    texts = [*AWKWARD, "a b a c", "c c c d", " x\x0by z\x1c ", "x y", *(" ".join(rare[i : i + 80]) for i in range(0, 4000, 80))]
    target = ["a b a b", None, "b a", " ".join(rare[40:700]), "", LONG]
    frame = spark.createDataFrame([(t,) for t in target], "text string")
    if parts is None:
        found = whole_model.whole_difference(documents(spark, texts), frame)
    else:
        found = whole_model.whole_difference(documents(spark, texts), frame, parts, stretch)
    out = {r.doc_id: r for r in found.collect()}
    assert len(out) == len(texts)
    for i, (n, wanted, background) in enumerate(brute_difference(texts, target)):
        assert out[i].n_words == n
        assert out[i].target_loss == pytest.approx(wanted, rel=1e-9)
        assert out[i].background_loss == pytest.approx(background, rel=1e-9)
        assert out[i].score == pytest.approx(wanted - background, rel=1e-6, abs=1e-9)


def test_whole_cross_entropy_of_empty_tables(spark):
    target = spark.createDataFrame([("a b",)], "text string")
    assert whole_model.whole_difference(documents(spark, []), target.filter("false")).count() == 0
    texts = ["a b", None, "a"]
    for wanted, rows in (([], target.filter("false")), (["a b"], target)):
        out = {r.doc_id: r for r in whole_model.whole_difference(documents(spark, texts), rows).collect()}
        for i, (_, loss, background) in enumerate(brute_difference(texts, wanted)):
            assert (out[i].target_loss, out[i].background_loss) == pytest.approx((loss, background), rel=1e-9)


def test_toxicity_on_held_out_rows(spark):
    draw = random.Random(8)
    bad = ["idiot", "blorxen", "blorxing", "zagnuk"]
    texts, toxic = list(AWKWARD), [0] * len(AWKWARD)
    for i in range(900):
        words = [f"w{draw.randint(0, 800)}" for _ in range(60)]
        toxic.append(int(i % 6 == 0))
        if toxic[-1]:
            words[draw.randrange(60)] = draw.choice(bad)
            words[draw.randrange(60)] = draw.choice(bad)
        texts.append(" ".join(words))
    labels = spark.createDataFrame(
        [(i, y) for i, y in enumerate(toxic)] + [(None, 1), (5, None), (20, toxic[20])], "doc_id bigint, toxic int"
    )
    out = {r.doc_id: r for r in toxicity.toxicity(documents(spark, texts), labels).collect()}
    held = [i for i in range(len(texts)) if zlib.crc32(str(i).encode()) % 3 == 1]
    assert [i for i in out if out[i].held_out] and {i for i in out if out[i].held_out} == set(held)
    wrong = [i for i in held if out[i].predicted != toxic[i]]
    assert len(wrong) <= len(held) * 0.03
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in out.values())
    seeds = toxicity.toxicity(documents(spark, [None, "fine words here", "you idiot moron"]), labels.filter("false"))
    scores = {r.doc_id: r.score for r in seeds.collect()}
    assert scores[2] > scores[1]
    assert toxicity.toxicity(documents(spark, []), labels.filter("false")).count() == 0


def test_exact_chance():
    from math import comb

    for a, n, p in ((3, 5, 0.1), (9, 9, 0.1), (20, 100, 0.1)):
        exact = sum(comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(a, n + 1))
        assert toxicity.chance(a, n, p) == pytest.approx(exact, rel=1e-9)


def test_pipeline_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns = docs.columns
    sizes = [docs.count()]
    for name, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
        sizes.append(docs.count())
        assert name == "packing" or docs.columns == columns
    assert sizes[0] > sizes[1] > sizes[2] >= sizes[3] == sizes[4] <= sizes[5]


def test_items_in_very_long_texts_with_bounded_memory():
    """Short and long items at places around the segments' ends; one-shingle items by lookup."""
    import tracemalloc

    from payments_lake.llm.decontamination import ItemIndex

    draw = random.Random(4)
    words = [f"w{draw.randrange(40_000)}" for _ in range(420_000)]
    spans = [(0, 4), (65_530, 5), (131_068, 8), (131_060, 40), (196_600, 300), (262_000, 5_000), (100_000, 140_000), (419_990, 10)]
    items = [(k, " ".join(words[at : at + n]).encode()) for k, (at, n) in enumerate(spans)]
    items += [(100 + k, " ".join(f"z{k}_{i}" for i in range(n)).encode()) for k, n in enumerate([3, 5, 6, 90])]
    text = " ".join(words).encode()
    index = ItemIndex(items)
    tracemalloc.start()
    found = {item: (size, shared) for item, size, shared in index.matches(text, 75)}
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    # Item 0 has fewer than five words, so only a text of just these words has it.
    assert set(found) == set(range(1, 8)) and all(size == shared for size, shared in found.values())
    assert peak < 250e6
    assert [i for i, _, _ in index.matches(items[0][1], 75)] == [0]

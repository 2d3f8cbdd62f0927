"""Clusters and product codes of embeddings against plain Python, and their awkward cases."""

import hashlib
import math
import random

import numpy as np
import pytest

from payments_lake.llm import centroid_clusters, product_codes
from payments_lake.llm.centroid_clusters import clustered, nearest, projected
from payments_lake.llm.product_codes import Codebooks, reassigned

SCHEMA = "vec_id bigint, embedding array<float>, label int, cluster string, `a.b` int, q int, code int"


def frame(spark, rows):
    """Rows of (vec_id, embedding, label), with further columns whose names clash."""
    return spark.createDataFrame([(*row, "c", 1, 2, 3) for row in rows], SCHEMA)


def random_rows(n, size=64, seed=7, spread=0.1):
    draw = random.Random(seed)
    middles = [[draw.gauss(0, 0.2) for _ in range(size)] for _ in range(6)]
    return [
        (i, np.array([m + draw.gauss(0, spread) for m in middles[draw.randrange(6)]], np.float32).tolist(), draw.choice([None, 1, 2]))
        for i in range(n)
    ]


def whole(vector):
    return [math.floor(1024 * x) for x in vector]


def gap(a, b):
    return sum((x - y) ** 2 for x, y in zip(a, b, strict=True))


def plain_clusters(rows, clusters, rounds):
    kept = sorted(((i, whole(v)) for i, v, _ in rows), key=lambda r: (hashlib.sha256(f"3:{r[0]}".encode()).hexdigest(), r[1]))
    centres = [v for _, v in kept[:clusters]]
    closest = lambda v: min(range(len(centres)), key=lambda c: (gap(v, centres[c]), c))
    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(closest(v), []).append(v)
        centres = [
            [sum(x) // len(groups[c]) for x in zip(*groups[c], strict=True)] if c in groups else old
            for c, old in enumerate(centres)
        ]
    return sorted((i, closest(v), gap(v, centres[closest(v)])) for i, v in kept), centres


def plain_codes(rows, parts, entries, rounds):
    kept = sorted((i, whole(v), label) for i, v, label in rows)
    width = len(kept[0][1]) // parts
    codes, errors, books = [""] * len(kept), [0] * len(kept), []
    for p in range(parts):
        pieces = [v[p * width : (p + 1) * width] for _, v, _ in kept]
        book = pieces[:entries]
        near = lambda v: min((gap(v, e), k) for k, e in enumerate(book))  # noqa: E731, B023
        for _ in range(rounds):
            groups = {}
            for piece in pieces:
                groups.setdefault(near(piece)[1], []).append(piece)
            book = [
                [sum(x) // len(groups[k]) for x in zip(*groups[k], strict=True)] if k in groups else old
                for k, old in enumerate(book)
            ]
        for i, piece in enumerate(pieces):
            distance, k = near(piece)
            codes[i] += f"{k:02x}"
            errors[i] += distance
        books += [v for e in book for v in e]
    digest = hashlib.sha256(",".join(map(str, books)).encode()).hexdigest()
    labels = {}
    for (_, _, label), error in zip(kept, errors, strict=True):
        labels[label] = labels.get(label, 0) + error
    return sorted((i, c, e, labels[label], digest) for (i, _, label), c, e in zip(kept, codes, errors, strict=True))


def test_clusters_equal_plain_ones(spark):
    rows = random_rows(400)
    rows += [(i + 400, rows[i][1], None) for i in range(60)] + [(7, rows[7][1], 1)]
    found = clustered(frame(spark, rows)).collect()
    want, centres = plain_clusters(rows, 8, 10)
    assert sorted((r.vec_id, r.cluster, r.distance) for r in found) == want
    of = {}
    for _, cluster, distance in want:
        of[cluster] = of.get(cluster, 0) + distance
    for r in found:
        assert (r.cluster_inertia, r.inertia) == (of[r.cluster], sum(of.values()))
        assert r.centroid_sha256 == hashlib.sha256(",".join(map(str, centres[r.cluster])).encode()).hexdigest()


def test_codes_equal_plain_ones(spark):
    rows = random_rows(420, seed=3)
    rows += [(i + 500, rows[i][1], None) for i in range(50)] + [(7, rows[7][1], rows[7][2])]
    found = product_codes.product_codes(frame(spark, rows))
    assert sorted(map(tuple, found.collect())) == plain_codes(rows, 4, 256, 4)
    few = [(i, v[:8], label) for i, v, label in rows[:90]]
    found = product_codes.product_codes(frame(spark, few), parts=2, entries=40, rounds=6)
    assert sorted(map(tuple, found.collect())) == plain_codes(few, 2, 40, 6)


def test_awkward_vectors(spark):
    rows = random_rows(5)
    bad = [
        (20, None, 1), (21, [], 1), (22, [None] * 64, 1), (23, [float("nan")] * 64, 1), (24, [float("inf")] + [0.0] * 63, 1),
        (25, [1.0] * 63, 1), (None, [0.5] * 64, None), (None, [0.25] * 64, None),
    ]
    found = clustered(frame(spark, rows + bad)).collect()
    assert sorted((r.vec_id is None, r.vec_id) for r in found if r.vec_id is not None) == [(False, i) for i in range(5)]
    assert len(found) == 7 and len({r.cluster for r in found}) == 7 and {r.distance for r in found} == {0}
    codes = product_codes.product_codes(frame(spark, rows + bad)).collect()
    assert len(codes) == 7 and {r.error for r in codes} == {0} and codes[0].label_error == 0
    assert sorted(r.code for r in codes if r.vec_id is None) == ["05050505", "06060606"]
    for empty in (frame(spark, []), frame(spark, bad[:5])):
        assert clustered(empty).collect() == [] and product_codes.product_codes(empty).collect() == []
    names = ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert clustered(frame(spark, [])).columns == clustered(frame(spark, rows)).columns == names


def test_same_vector_everywhere(spark):
    rows = [(i, [0.125] * 64, 1) for i in range(300)]
    assert {(r.cluster, r.distance, r.inertia) for r in clustered(frame(spark, rows)).collect()} == {(0, 0, 0)}
    assert {(r.code, r.error) for r in product_codes.product_codes(frame(spark, rows)).collect()} == {("00000000", 0)}


def test_large_components_are_exact(spark):
    rows = [(i, [(-1.0) ** i * 1e6 * (i + 1)] + [0.0] * 63, 1) for i in range(9)]
    found = clustered(frame(spark, rows)).collect()
    assert sorted((r.vec_id, r.cluster, r.distance) for r in found) == plain_clusters(rows, 8, 10)[0]
    assert sorted(map(tuple, product_codes.product_codes(frame(spark, rows)).collect())) == plain_codes(rows, 4, 256, 4)


def test_projection_bounds_never_exceed_distances_and_close_clusters():
    rows = np.array([whole(v) for _, v, _ in random_rows(2000, spread=0.03)])
    centres = rows[:8]
    axes = np.linalg.eigh(np.cov(rows.T.astype(float)))[1][:, ::-1][:, :16]
    lead, rest = projected(rows, axes)
    best, distance, measured = nearest(rows, lead, rest, centres, axes)
    all_distances = ((rows[:, None, :] - centres) ** 2).sum(axis=2)
    assert (best == all_distances.argmin(axis=1)).all() and (distance == all_distances.min(axis=1)).all()
    assert measured < 0.4 * all_distances.size


@pytest.mark.parametrize("seed", range(3))
def test_bounds_stay_below_distances_over_many_rounds(seed):
    """Stamped bounds against all distances, with entries that wander back and forth."""
    draw = np.random.default_rng(seed)
    rows = draw.integers(-500, 500, (300, 16))
    book = rows[:100].copy()
    history, code = [book], None
    bounds, stamps = np.zeros((300, 4), np.int64), np.zeros((300, 4), np.int64)
    measured = []
    for number in range(8):
        books = Codebooks(history)
        code, distance, n = reassigned(rows, books, code, bounds, stamps)
        measured.append(n)
        full = ((rows[:, None, :] - history[-1]) ** 2).sum(axis=2)
        assert (code == full.argmin(axis=1)).all() and (distance == full.min(axis=1)).all()
        full[np.arange(300), code] = 1 << 60
        for g, span in enumerate(books.groups):
            held = bounds[:, g] - books.drift[stamps[:, g], g]
            assert (held <= np.sqrt(full[:, span].min(axis=1).astype(float)) + 1e-6).all()
        history = [*history, history[-1] + (-1) ** number * draw.integers(0, 12, book.shape)]
    assert min(measured[1:]) < measured[0]


def test_net_displacement_is_tighter_than_summed_drift():
    book = np.arange(64).reshape(4, 16) * 10
    history = [book, book + 8, book]
    assert Codebooks(history).drift[0].max() == 0 < Codebooks(history).drift[1].max()


def test_registered_sizes():
    assert (centroid_clusters.CLUSTERS, centroid_clusters.ROUNDS, centroid_clusters.DIMENSIONS) == (8, 10, 64)
    assert (product_codes.PARTS, product_codes.ENTRIES, product_codes.ROUNDS) == (4, 256, 4)

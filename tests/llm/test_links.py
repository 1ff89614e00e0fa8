"""Operators 1 and 2 against brute force."""

from __future__ import annotations

import collections
import random

import numpy as np

from slotwise.llm import jaccard_join, near_vectors
from odd_rows import none, odd  # noqa: F401
from slotwise.llm.graph import components


def classes(ids, links):
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def jaccard_truth(rows):
    sets = {i: set(jaccard_join.shingles(jaccard_join.words_of(t)).tolist()) for i, t in rows}
    where = collections.defaultdict(list)
    for i, s in sets.items():
        for x in s:
            where[x].append(i)
    common = collections.Counter((a, b) for l in where.values() for k, a in enumerate(l) for b in l[k + 1 :])
    links = [p for p, n in common.items() if n >= 0.8 * (len(sets[p[0]]) + len(sets[p[1]]) - n) - 1e-9]
    degree = collections.Counter(x for p in links for x in p)
    found = classes(sets, links)
    return {i: (found[i], degree[i]) for i in sets}


def test_components_of_a_chain_a_star_and_a_loop(spark):
    edges = [(i, i + 1) for i in range(50)] + [(100, i) for i in range(101, 130)] + [(7, 7), (500, 500)]
    got = {r["id"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long"), "t").collect()}
    assert got == {i: 0 for i in range(51)} | {i: 100 for i in range(100, 130)}


def test_jaccard_classes_equal_brute_force_with_a_group_larger_than_a_bucket(spark):
    rng = random.Random(3)
    base = [f"v{rng.randrange(10**6)}" for _ in range(120)]
    texts = []
    for _ in range(300):  # one group of near copies, larger than a leaf and a block
        words = list(base)
        for _ in range(rng.randrange(3)):
            words[rng.randrange(len(words))] = f"c{rng.randrange(10**6)}"
        texts.append(" ".join(words))
    passage = " ".join(f"p{i}" for i in range(50))
    for _ in range(150):  # a shared passage is no link
        texts.append(passage + " " + " ".join(f"u{rng.randrange(10**9)}" for _ in range(200)))
    rows = list(enumerate(texts))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: (r["class_id"], r["n_links"]) for r in jaccard_join.jaccard_classes(docs).collect()}
    assert got == jaccard_truth(rows)


def test_jaccard_join_of_odd_rows(spark, odd, none):
    got = sorted((r["doc_id"] or 0, r["class_id"] or 0, r["n_links"]) for r in jaccard_join.jaccard_classes(odd).collect())
    # ids 4 (twice) and 5 hold the same words; 6 and 7 differ in one word; the others link with nothing
    assert got == [(0, 0, 0), (1, 1, 0), (2, 2, 0), (3, 3, 0), (4, 4, 2), (4, 4, 2), (5, 4, 2), (6, 6, 1), (7, 6, 1), (8, 8, 0)]
    kept = jaccard_join.keep_one_per_class(odd)
    assert kept.columns == odd.columns
    assert sorted(r["doc_id"] or 0 for r in kept.collect()) == [0, 1, 2, 3, 4, 6, 8]
    assert jaccard_join.jaccard_classes(none).count() == 0


def test_vectors_equal_brute_force(spark):
    rng = np.random.default_rng(4)
    rows = []
    centre = rng.standard_normal(16)
    for i in range(240):  # a dense group, larger than any list
        rows.append((i, (centre + 0.05 * rng.standard_normal(16)).tolist(), 1))
    for i in range(240, 500):
        rows.append((i, rng.standard_normal(16).tolist(), i % 2))
    for i in range(500, 520):
        rows.append((i, (np.array(rows[i - 200][1]) + 0.05 * rng.standard_normal(16)).tolist(), rows[i - 200][2]))
    rows += [(520, rows[300][1], rows[300][2]), (521, rows[300][1], 1 - rows[300][2]), (522, None, 1), (523, [0.0] * 16, 1), (524, [float("nan")] * 16, 1)]
    rows += [(525, rows[300][1], None), (526, [None] + [1.0] * 15, 1), (527, [], 1), (528, [1.0, 2.0], 1)]
    v = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumnRenamed("x", "y")
    got = {r["vec_id"]: (r["component_id"], r["n_links"], r["kept"]) for r in near_vectors.link_vectors(v).collect()}
    good = [r for r in rows if r[1] and r[2] is not None and None not in r[1] and np.isfinite(r[1]).all() and np.any(r[1])]
    links = []
    for a in range(len(good)):
        for b in range(a + 1, len(good)):
            x, y = np.array(good[a][1]), np.array(good[b][1])
            if good[a][2] == good[b][2] and len(x) == len(y) and x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= 0.93:
                links.append((good[a][0], good[b][0]))
    degree = collections.Counter(x for p in links for x in p)
    found = classes([r[0] for r in rows], links)
    assert got == {i: (found[i], degree[i], found[i] == i) for i in found}
    assert near_vectors.link_vectors(v.limit(0)).count() == 0


def test_start_tables_keep_the_chance_to_meet_at_every_size():
    together = 1 - np.arccos(near_vectors.LINK) / np.pi
    for bits in range(41):
        assert 1 - (1 - together**bits) ** near_vectors.tables(bits) >= 0.99 - 1e-9


def test_pairs_beside_a_dense_group_are_audited_and_a_failed_search_ends_exactly(spark, monkeypatch):
    rng = np.random.default_rng(6)
    centre = rng.standard_normal(16)
    rows = [(i, (centre + 0.02 * rng.standard_normal(16)).tolist(), 1) for i in range(240)]
    rows += [(i, rng.standard_normal(16).tolist(), 1) for i in range(240, 280)]
    rows += [(i, (np.array(rows[i - 40][1]) + 0.01 * rng.standard_normal(16)).tolist(), 1) for i in range(280, 320)]
    search = near_vectors.neighbour_lists
    # a search that finds the dense group and misses every pair
    monkeypatch.setattr(near_vectors, "neighbour_lists", lambda *a: search(*a).where("size(near) >= 8 and array_min(sims) >= 0.93"))
    v = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = {r["vec_id"]: (r["component_id"], r["n_links"]) for r in near_vectors.link_vectors(v).collect()}
    m = np.array([r[1] for r in rows])
    m /= np.linalg.norm(m, axis=1)[:, None]
    linked = np.triu(m @ m.T >= 0.93, 1)
    found = classes(range(320), np.argwhere(linked).tolist())
    assert got == {i: (found[i], int(linked[i].sum() + linked[:, i].sum())) for i in range(320)}
    assert all(got[i] == (i, 1) for i in range(240, 280))

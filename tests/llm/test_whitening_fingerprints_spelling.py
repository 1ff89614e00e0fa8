"""Operators 11, 12 and 13 against brute force, and on odd rows."""

from __future__ import annotations

import collections
import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from odd_rows import none, odd  # noqa: F401
from slotwise.llm import fingerprints, queries, spelling, whitening

SF_SMALL = "/root/testdata/sf0.001"


# --- operator 11 -----------------------------------------------------------------------


def whitened_plainly(vectors: dict) -> tuple[int, dict, np.ndarray, np.ndarray]:
    """Size of the fit list, exact deviations, eigenvalues and axes, by fractions and one plain product."""
    x = {k: [int(np.floor(64 * float(c))) + 1_000_000 for c in v] for k, v in vectors.items()}
    fit = [list(t) for t in {tuple(v) for v in x.values()}]
    n, dims = len(fit), len(fit[0])
    sums = [sum(v[i] for v in fit) for i in range(dims)]
    deviation = {k: sum((n * v[i] - sums[i]) ** 2 for i in range(dims)) for k, v in x.items()}
    centred = [[v[i] - Fraction(sums[i], n) for i in range(dims)] for v in fit]
    cov = np.array([[float(sum(v[i] * v[j] for v in centred) / n) for j in range(dims)] for i in range(dims)])
    values, axes = np.linalg.eigh(cov)
    return n, deviation, values[::-1], axes[:, ::-1], {k: np.array([float(v[i] - Fraction(sums[i], n)) for i in range(dims)]) for k, v in x.items()}


def vectors_df(spark, rows):
    return spark.createDataFrame([(i, v, "x", 1.0) for i, v in rows], "vec_id long, embedding array<float>, component string, whitened double")


def test_whitening_equals_a_plain_covariance(spark):
    rng = np.random.default_rng(3)
    mix = rng.normal(size=(6, 6))
    rows = [(i, [float(np.float32(c)) for c in rng.normal(size=6) @ mix]) for i in range(120)]
    rows += [(200 + i, rows[7][1]) for i in range(60)]  # a third of the rows is one vector
    n, deviation, values, axes, centred = whitened_plainly(dict(rows))
    got = whitening.whiten(vectors_df(spark, rows).repartition(5), components=4).collect()
    assert len(got) == 180 * 4 and {r["n"] for r in got} == {n} and n <= 120
    assert all(int(r["deviation"]) == deviation[r["id"]] for r in got)
    signs = {}
    for r in got:
        k = r["component"] - 1
        want = centred[r["id"]] @ axes[:, k] / np.sqrt(values[k])
        sign = signs.setdefault(k, np.sign(want * r["whitened"]))
        assert r["whitened"] * sign == pytest.approx(want, abs=1e-8)
        assert r["explained"] == pytest.approx(values[k] / values.sum(), rel=1e-9) and r["identity_error"] < 1e-9


def test_polarised_sums_stay_exact_beyond_64_bits(spark):
    rows = [(i, [4e9 * ((-1) ** i) + i, 3e9 * (i % 3), -1.5e9 + 7 * i]) for i in range(40)]
    fit = whitening.coded(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), "vec_id", "embedding").select("code").distinct()
    n, _, _, _, centred = whitened_plainly(dict(rows))
    got = whitening.fit_whitening(fit, 3)
    want = np.cov(np.array(list(centred.values())).T, bias=True)
    assert got.n == n == 40 and np.allclose(got.covariance, want, rtol=1e-12)


def test_whitening_of_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    odd_rows = [(1, None), (2, []), (3, [1.0, None]), (4, [1.0, nan]), (5, [inf, 1.0]), (6, [1.0, 2.0, 3.0])]
    rows = [(7, [1.0, 2.0]), (7, [1.0, 2.0]), (None, [2.0, 4.0]), (8, [3.0, 6.0])]
    got = whitening.whiten(vectors_df(spark, odd_rows + rows)).collect()
    assert collections.Counter(r["id"] for r in got) == {7: 4, None: 2, 8: 2} and {r["n"] for r in got} == {3}
    by = {(r["id"], r["component"]): r for r in got}
    assert by[8, 1]["explained"] == pytest.approx(1.0) and by[8, 2]["whitened"] is None and by[8, 2]["explained"] == pytest.approx(0, abs=1e-12)
    alone = whitening.whiten(vectors_df(spark, [(1, [1.0, 2.0])] * 3)).collect()
    assert len(alone) == 6 and all(r["whitened"] is None and r["deviation"] == 0 and r["explained"] is None and r["identity_error"] is None for r in alone)
    assert whitening.whiten(vectors_df(spark, odd_rows[:2])).count() == 0
    assert whitening.whiten(vectors_df(spark, rows).limit(0)).count() == 0
    far = whitening.whiten(vectors_df(spark, [(1, [3e38, 1.0]), (2, [-3e38, 2.0]), (3, [0.0, 0.0])])).collect()
    assert len(far) == 6


def test_whitening_query_keeps_its_contract(spark):
    rows = queries.op11_embedding_whitening(spark, SF_SMALL).collect()
    vectors = {r["vec_id"]: r["embedding"] for r in spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").collect()}
    x = {k: np.floor(64 * np.array(v, dtype=np.float64)).astype(int) + 1_000_000 for k, v in vectors.items()}
    fit = np.array(sorted({tuple(v) for v in x.values()}))
    n, sums = len(fit), fit.sum(axis=0)
    assert len(rows) == 16 * len(vectors) and {r["n"] for r in rows} == {n}
    assert all(r["deviation"] == int(((n * x[r["vec_id"]] - sums) ** 2).sum()) for r in rows)
    by = {(r["vec_id"], r["component"]): r["whitened"] for r in rows}
    first = {tuple(v): k for k, v in x.items()}
    values = np.array([[by[first[tuple(v)], k] for k in range(1, 17)] for v in fit.tolist()])
    error = np.abs(np.cov(values.T, bias=True) - np.eye(16)).max()
    assert error < 1e-9 and all(r["identity_error"] < 1e-9 for r in rows)


# --- operator 12 -----------------------------------------------------------------------


def slow_fingerprint(text: str) -> str:
    """The fingerprint byte by byte, with every level counted on its own."""
    data = [b + 1 for b in text.encode()]
    if not data:
        return "3::"
    base = 0x9E3779B97F4A7C15

    def step(i):
        h = sum(data[i - k] * pow(0x01000193, k, 1 << 32) for k in range(7) if i - k >= 0) % (1 << 32)
        h ^= h >> 15
        h = h * 0x2C1B3C6D % (1 << 32)
        return h ^ h >> 12

    steps = [step(i) for i in range(len(data))]

    def cuts(size):
        return [i + 1 for i, h in enumerate(steps) if h % size == 0]

    def signature(size):
        out, start = "", 0
        for end in sorted({*cuts(size), len(data)}):
            h = 0
            for b in reversed(data[start:end]):
                h = (h * base + b) % (1 << 64)
            h ^= h >> 32
            h = h * 0xD6E8FEB86659FD93 % (1 << 64) >> 52
            out += fingerprints.LETTERS[h // 64] + fingerprints.LETTERS[h % 64]
            start = end
        return out

    size = 3
    while len(cuts(size)) > 64:
        size *= 2
    return f"{size}:{signature(size)}:{signature(2 * size)}"


def slow_likeness(a: str, b: str) -> float:
    def common(x, y):
        row = [0] * (len(y) + 1)
        for p in x:
            new = [0]
            for j, q in enumerate(y):
                new.append(row[j] + 1 if p == q else max(row[j + 1], new[j]))
            row = new
        return row[-1]

    if a == b:
        return 1.0
    (sa, *pa_), (sb, *pb) = a.split(":"), b.split(":")
    best = 0.0
    for i, x in enumerate(pa_):
        for j, y in enumerate(pb):
            if int(sa) << i == int(sb) << j:
                x_, y_ = re.findall("..", x), re.findall("..", y)
                best = max(best, 1 - (len(x_) + len(y_) - 2 * common(x_, y_)) / (len(x_) + len(y_)) if x_ or y_ else 1.0)
    return best


def edits_plainly(rows: list) -> collections.Counter:
    rows = [(i, t or "") for i, t in rows]
    out = collections.Counter()
    for (i, text), (_, after) in zip(rows, rows[1:] + rows[:1]):
        k = len(text) // 4
        edited = text[: len(text) - k] + after[:k]
        a, b, c = (slow_fingerprint(t) for t in (text, edited, after))
        out[i, len(text), hashlib.sha256(edited.encode()).hexdigest(), a, b, round(slow_likeness(a, b), 9), round(slow_likeness(a, c), 9)] += 1
    return out


def edits(df, **kw) -> collections.Counter:
    got = fingerprints.fingerprint_edits(df, **kw).collect()
    return collections.Counter((*r[:5], round(r[5], 9), round(r[6], 9)) for r in got)


def test_fingerprints_equal_brute_force(spark):
    rng = random.Random(11)
    words = [f"w{i}é" for i in range(60)] + ["日本", "🙂", "a", "the"]
    rows = [(i, " ".join(rng.choice(words) for _ in range(rng.choice((0, 1, 3, 40, 300))))) for i in rng.sample(range(1000), 40)]
    rows += [(2000, "z" * 500), (2001, "ab" * 400), (2002, None), (2003, rows[0][1]), (2004, rows[0][1] + " tail")]
    rng.shuffle(rows)
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, part string").repartition(4)
    for parts in (1, 3, 7):
        assert edits(df, parts=parts) == edits_plainly(sorted(rows))


def test_fingerprints_of_odd_rows(spark, odd, none):
    got = fingerprints.fingerprint_edits(odd, parts=3).collect()
    assert len(got) == odd.count() and fingerprints.fingerprint_edits(none).count() == 0
    by = collections.defaultdict(list)
    for r in got:
        by[r["id"]].append(r)
    assert by[1][0]["n_chars"] == 0 and by[1][0]["fingerprint"] == "3::" == by[2][0]["fingerprint"] and by[1][0]["near_next"] == 1.0
    assert by[4][0]["fingerprint"] == by[4][1]["fingerprint"] and max(r["near_next"] for r in by[4]) == 1.0
    # the order begins with the null id, so that one follows the last
    nobody, last = "nobody's words here", odd.where("doc_id = 8").first()["text"]
    assert by[8][0]["edited_sha256"] == hashlib.sha256((last[: len(last) - len(last) // 4] + nobody[: len(last) // 4]).encode()).hexdigest()
    one = spark.createDataFrame([(5, "alone in the table")], "doc_id long, text string")
    row = fingerprints.fingerprint_edits(one).first()
    assert row["near_next"] == 1.0 and row["edited_sha256"] == hashlib.sha256(b"alone in the talon"[:14] + b"alon").hexdigest()


def test_fingerprints_tell_edits_from_other_documents(spark):
    rows = queries.op12_document_fingerprints(spark, SF_SMALL).where("n_chars > 200").collect()
    near, far = sorted(r["near_edited"] for r in rows), sorted(r["near_next"] for r in rows)
    assert near[len(near) // 20] > 0.5 and near[len(near) // 2] > 0.65 and far[len(far) * 9 // 10] < 0.2
    assert all(fingerprints.parse(r["fingerprint"]).text() == r["fingerprint"] for r in rows)


# --- operator 13 -----------------------------------------------------------------------


def variants_plainly(docs, least, min_count, ratio, drop_every) -> set:
    """Every pair of words compared, letter by letter."""
    counts = collections.Counter()
    for i, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{word}".encode())
            if drop_every and h % drop_every == 0:
                word = word[: h % len(word)] + word[h % len(word) + 1 :]
            counts[word] += 1
    n = {w: c for w, c in counts.items() if len(w) >= least and c >= min_count}

    def near(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        a, b = sorted((a, b), key=len)
        return len(b) == len(a) + 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))

    by = {w: sorted((v for v in n if v != w and near(w, v)), key=lambda v: (-n[v], v)) for w in n}
    form = {w: vs[0] if vs and n[vs[0]] >= ratio * n[w] else None for w, vs in by.items()}

    def last(w):
        while form[w]:
            w = form[w]
        return w

    return {(w, form[w], last(w), n[w], len(by[w]), n.get(form[w])) for w in n}


def variants(df, **kw) -> list:
    return [tuple(r) for r in spelling.spelling_variants(df, **kw).select("word", "form", "root", "n", "n_near", "form_n").collect()]


@pytest.fixture(scope="module")
def spelled(spark):
    rng = random.Random(13)
    alphabet = "abé×"
    words = ["".join(rng.choice(alphabet) for _ in range(rng.choice((4, 5, 6, 7, 8)))) for _ in range(500)]
    words += ["receive", "recieve", "receiv", "receives", "rceive", "recei", "abcdef", "bcdefa", "Straße", "STRASSE"]
    weights = [rng.choice((1, 1, 3, 20, 120)) for _ in words]
    docs = [(i, " ".join(rng.choices(words, weights, k=300)).replace("a", "A", i % 5)) for i in range(60)]
    docs += [(None, "receive, recieve! receive 日本receive_receive"), (70, None), (71, ""), (72, "x" * 3000), (72, "x" * 2999), (72, "x" * 3000)]
    return docs


def test_spelling_variants_equal_brute_force(spark, spelled, monkeypatch):
    df = spark.createDataFrame([(*d, "w", 1) for d in spelled], "doc_id long, text string, word string, n int").repartition(6)
    for least, min_count, ratio, drop in ((6, 1, 5, None), (4, 2, 2, 7), (6, 5, 5, 199)):
        want = variants_plainly(spelled, least, min_count, ratio, drop)
        got = variants(df, least=least, min_count=min_count, ratio=ratio, drop_every=drop)
        assert len(got) == len(want) and set(got) == want
    # many boxes, boxes dealt to several groups, small fine trees
    for name, value in (("BOX", 30), ("SAMPLE_BOX", 1), ("MOST", 8), ("LEAF", 3), ("PAIRS", 50), ("HELD", 40)):
        monkeypatch.setattr(spelling, name, value)
    assert set(variants(df, least=4, min_count=1, ratio=2, drop_every=7)) == variants_plainly(spelled, 4, 1, 2, 7)


def test_spelling_trees_reach_every_word_of_a_ball():
    rng = random.Random(5)
    words = sorted({"".join(rng.choice("abcd") for _ in range(7)) for _ in range(900)})
    counts = spelling.counts_of(spelling.letters_of(words))
    tree, boxes = spelling.plant(counts, 20)
    place = spelling.home(tree, counts)
    assert boxes > 10 and place.max() == boxes - 1 and all((counts[place == b] == counts[place == b][0]).all() or (place == b).sum() <= 20 for b in range(boxes))
    reached = collections.defaultdict(set)
    for box, rows in spelling.search(tree, counts, 1):
        for r in rows.tolist():
            reached[r].add(box)
    for a in range(0, len(words), 7):
        ball = np.abs(counts - counts[a]).sum(axis=1) <= 2
        assert set(place[ball].tolist()) <= reached[a]


def test_spelling_of_odd_rows_and_hot_words(spark, odd, none):
    assert spelling.spelling_variants(none).count() == 0 and spelling.spelling_variants(none, drop_every=3).count() == 0
    got = variants(odd, least=3, min_count=1)
    want = variants_plainly([(r["doc_id"], r["text"]) for r in odd.collect()], 3, 1, 5, None)
    assert set(got) == want
    # one form is the root of a third of all words
    docs = [(i, " ".join(["stationary"] * 50 + ["station" + c + "ry" for c in "bcdefgh"])) for i in range(20)]
    got = {r[0]: r for r in variants(spark.createDataFrame(docs, "doc_id long, text string"))}
    assert got["stationary"][1:] == (None, "stationary", 1000, 7, None) and got["stationbry"][1:] == ("stationary", "stationary", 20, 7, 1000)


def test_spelling_query_equals_brute_force(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    got = [tuple(r) for r in queries.op13_spelling_variants(spark, SF_SMALL).select("word", "form", "root", "n", "n_near", "form_n").collect()]
    assert set(got) == variants_plainly(docs, 6, 5, 5, 199) and len(got) > 100

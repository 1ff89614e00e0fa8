"""Operators 5, 6, 8 and 9: plain-Python truth, planted cases and odd rows."""

from __future__ import annotations

import collections
import random
import re
import zlib

import duckdb
import numpy as np
import pytest

from odd_rows import none, odd  # noqa: F401
from slotwise.llm import html_text, pii, quality_model, quality_rules

SF_ORACLE = "/root/testdata/sf0.01"


def test_quality_model_separates_held_out_labels():
    rows = duckdb.sql(
        f"select d.doc_id, l.quality, d.text from '{SF_ORACLE}/documents.parquet' d join '{SF_ORACLE}/labels.parquet' l using (doc_id) order by 1"
    ).fetchall()
    fold = [zlib.crc32(str(r[0]).encode()) % 5 for r in rows]
    w = quality_model.train([(r[2], r[1]) for r, f in zip(rows, fold) if f])
    hashes = quality_model.WordHashes()
    test = [(r[1], quality_model.dot(w, quality_model.fields(r[2], hashes)) + w[-1]) for r, f in zip(rows, fold) if not f]
    good, bad = [s for q, s in test if q], [s for q, s in test if not q]
    assert np.mean([g > b for g in good for b in bad]) > 0.97


def test_quality_scores_of_odd_rows(spark, odd, none):
    labels = spark.createDataFrame([(3, 1, 0), (4, 0, 0), (4, 1, 0), (6, 0, 0), (9, None, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    out = quality_model.score_quality(odd, labels)
    assert set(out.columns) == set(odd.columns) | {"held_out", "predicted"} and out.count() == odd.count()
    scores = {(r["doc_id"], r["text"]): r["score"] for r in out.collect()}
    assert all(0 <= s <= 1 for s in scores.values()) and scores[1, None] == scores[2, ""]
    assert quality_model.score_quality(none, labels).count() == 0
    assert {r["score"] for r in quality_model.score_quality(odd, labels.limit(0)).collect()} == {0.5}


def naive_figures(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    hit = {k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(i, i + 3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    dup = sum(x in lines[:i] for i, x in enumerate(lines))
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(hit)


def test_text_figures_equal_plain_python():
    rng = random.Random(1)
    for _ in range(300):
        text = "".join(rng.choice(["a", "b", "é", "#", " ", "\n", "\t", "\x1c", "\xa0", "a b ", "<|"]) for _ in range(rng.randrange(60)))
        assert quality_rules.text_figures(text) == naive_figures(text), repr(text)


def test_rule_quality_keeps_clean_and_rejects_junk(spark, odd, none):
    clean = " ".join(["Some plain words that follow each other, number after number."] + [f"word{'abcdefgh'[i % 8]}{chr(97 + i // 8)}" for i in range(120)])
    junk = " ".join(f"w{chr(97 + i % 26)}{chr(97 + i // 26)}###" for i in range(120))
    docs = spark.createDataFrame([(i, clean + chr(97 + i)) for i in range(20)] + [(100 + i, junk) for i in range(3)], "doc_id long, text string")
    got = {r["doc_id"]: (r["base_failed"], r["kept"]) for r in quality_rules.rule_quality(docs).collect()}
    assert got == {i: (False, True) for i in range(20)} | {100 + i: (False, False) for i in range(3)}
    assert quality_rules.rule_quality(odd).count() == odd.count() and quality_rules.rule_quality(none).count() == 0


def plain_em(counts: dict, rounds: int = 500):
    """The same estimation text class by text class, rule by rule."""
    blame, praise = len(quality_rules.BLAME), len(quality_rules.PRAISE)
    belief = [[0.5] * blame + [0.3] * praise, [0.005] * blame + [0.95] * praise]
    rates, shares, total = [list(x) for x in belief], [0.2, 0.8], sum(counts.values())
    weight = quality_rules.BELIEF * total + 1
    for _ in range(rounds):
        post = {}
        for pattern in counts:
            value = []
            for k in (0, 1):
                v = shares[k]
                for c, r in zip(pattern, rates[k]):
                    v *= r if c != "0" else 1 - r
                value.append(v)
            post[pattern] = value[1] / sum(value)
        for k in (0, 1):
            mass = {p: n * (post[p] if k else 1 - post[p]) for p, n in counts.items()}
            shares[k] = (sum(mass.values()) + 1) / (total + 2)
            rates[k] = [(sum(m for p, m in mass.items() if p[i] != "0") + weight * belief[k][i]) / (sum(mass.values()) + weight) for i in range(blame + praise)]
    return post, rates


def test_posteriors_equal_a_plain_estimation(spark):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    figures = {i: quality_rules.text_figures(t) for i, t in texts.items()}
    patterns = {i: quality_rules.votes(t, figures[i]) for i, t in texts.items()}
    want, _ = plain_em(collections.Counter(patterns.values()))
    rows = quality_rules.rule_quality(spark.read.parquet("/root/testdata/sf0.001/documents.parquet")).collect()
    for r in rows:
        assert r["pattern"] == patterns[r["doc_id"]] and r["posterior"] == pytest.approx(want[r["pattern"]], abs=1e-6)
        failed = r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"]
        assert r["kept"] == (not failed and want[r["pattern"]] >= 0.5)


def test_a_rule_that_is_wrong_on_a_source_loses_its_weight():
    names = [name for name, _ in quality_rules.BLAME]
    wrong, praise = names.index("digit_share"), "+" * len(quality_rules.PRAISE)

    def pattern(*blamed, praised=praise):
        return "".join("-" if i in blamed else "0" for i in range(len(names))) + praised

    # a third of the good texts hold many numbers; bad ones break several other rules
    counts = {pattern(): 600, pattern(wrong, praised="0" + praise[1:]): 300, pattern(0, 1, praised="000"): 60, pattern(0, 1, 3, praised="000"): 40}
    posterior, rate, share = quality_rules.estimate(sorted(counts.items()))
    assert 0.28 < rate[1, wrong] < 0.36 and rate[0, wrong] < rate[1, wrong] and 0.08 < share[0] < 0.13
    assert posterior[pattern(wrong, praised="0" + praise[1:])] > 0.9 and posterior[pattern(0, 1, praised="000")] < 0.1
    few, _, _ = quality_rules.estimate([(pattern(wrong, praised="000"), 3), (pattern(), 900)])
    assert few[pattern(wrong, praised="000")] < 0.5  # where few texts trip it, the rule is believed


def test_texts_without_spaces_are_not_blamed_for_their_words():
    text = "这是一个很长的句子没有空格" * 20 + " " + "日本語の文章です" * 20
    figures = quality_rules.text_figures(text)
    assert "-" not in quality_rules.votes(text, figures)


EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"
IP = r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"


def test_base_spans_equal_the_patterns():
    rng = random.Random(2)
    parts = ["a@b.c", "@", ".", "x.y", "1.2.3.4", "999.1.1.1", "4111 1111 1111 1111", "4111-1111-1111-1112", "+1 (222) 333-4444", "+", "7", " ", "é", "-"]
    for _ in range(2000):
        text = "".join(rng.choice(parts) for _ in range(rng.randrange(12)))
        want = [("email", m.start(), m.end()) for m in re.finditer(EMAIL, text)]
        want += [("ip", m.start(), m.end()) for m in re.finditer(IP, text) if all(int(p) < 256 for p in m.group().split("."))]
        for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
            d = re.sub("[^0-9]", "", m.group())
            if 13 <= len(d) <= 19 and pii.luhn(d):
                want.append(("card", m.start(), m.end()))
        for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
            if 9 <= len(re.sub("[^0-9]", "", m.group())) <= 15:
                want.append(("phone", m.start(), m.end()))
        assert pii.base_spans(text) == want, repr(text)


def test_field_finds_planted_forms_and_leaves_plain_text_alone():
    weights = pii.trained()
    planted = {
        "call (123) 555-7788 today": ("phone", "(123) 555-7788"),
        "mail joe at gmail dot com now": ("email", "joe at gmail dot com"),
        'token = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff"': ("secret", "24be64439e3e49cf46b2d7c90f3602a3d0b907ff"),
    }
    for text, (kind, part) in planted.items():
        at = text.index(part)
        assert pii.all_spans(text, weights)[1] == [(kind, at, at + len(part))]
    for text in ("on 2020-01-02 at 10.30", "Version 2.0. See 3.", "that at there dot an", "x 12345678 y", "Apache License, Version 2.0."):
        assert pii.all_spans(text, weights) == ([], [])


def test_field_chooses_the_boundaries_of_numbers_that_stand_together():
    weights = pii.trained()
    planted = {
        "call 555-123-4567 2024-01-15 now": [("phone", "555-123-4567")],
        "tel 212-555-0199 / 212-555-0188 aaa": [("phone", "212-555-0199"), ("phone", "212-555-0188")],
        "call 555-123-4567 12 people": [("phone", "555-123-4567")],
        "card 4111/1111/1111/1111 123 aaa": [("card", "4111/1111/1111/1111")],
    }
    for text, parts in planted.items():
        want = [(kind, text.index(part), text.index(part) + len(part)) for kind, part in parts]
        assert {c for s in pii.stretches(text, []) for k in range(len(s.segments)) for c in s.spans([k])} >= set(want)
        assert pii.all_spans(text, weights)[1] == want, text


def test_field_finds_long_secrets_names_and_domain_labels():
    weights, rng = pii.trained(), random.Random(7)
    for n in (150, 400, 3000):
        key = "".join(rng.choice("abcdefghijkABCDEFGHIJK0123456789") for _ in range(n))
        text = f'token = "{key}" aaa'
        assert pii.all_spans(text, weights)[1] == [("secret", 9, 9 + n)], n
    for part in ("joe at " + "m" * 10 + " dot " + "d" * 40 + " dot com", "j" * 90 + " at gmail dot com", "joe at mail dot example dot com", "joe (at) mail (dot) example (dot) org"):
        assert pii.all_spans(f"mail {part} now", weights)[1] == [("email", 5, 5 + len(part))], part


def test_names_domains_and_parts_of_any_length():
    weights = pii.trained()
    for part in ("john dot smith at gmail dot com", "joe [at] a.b.c.d.e.example.com", "joe at " + "m" * 80 + " dot com", "x" * 300 + " [at] " + "y.yy." * 40 + "com"):
        assert pii.all_spans(f"mail {part} now", weights)[1] == [("email", 5, 5 + len(part))], part
    assert pii.base_spans("0000000000000000000001.2.3.4") == [("ip", 0, 28)] and pii.base_spans("0000000000000000000256.2.3.4") == []
    hidden = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff"
    assert pii.all_spans(f"commit {hidden} aaa", weights)[1] == [] and pii.all_spans(f"sha1 {hidden}", weights)[1] == []


def test_long_texts_cost_linear_time():
    import time

    weights = pii.trained()
    for part, n in (("a.", 4000), ("a/1", 8000), ("1 ", 8000), ("x at ", 4000), ("a dot ", 4000), ("0123456789abcdef", 20_000)):
        took = []
        for text in (part * n + "a@b.com", part * 4 * n + "a@b.com"):
            began = time.process_time()
            pii.all_spans(text, weights)
            took.append(time.process_time() - began)
        assert took[1] < 8 * took[0] + 0.5, (part, took)
    began = time.process_time()
    pii.all_spans("a." * 4000 + "a@b.com", weights)
    assert time.process_time() - began < 0.5


def test_viterbi_and_marginals_equal_enumeration():
    segments = [(0, 2, "a", []), (1, 3, "b", []), (2, 4, "c", []), (0, 4, "d", [])]
    scores = [1.0, 2.5, 1.2, 2.0]
    sets = [s for s in ([], [0], [1], [2], [3], [0, 2])]
    value = {tuple(s): sum(scores[c] for c in s) for s in sets}
    total = sum(np.exp(v) for v in value.values())
    want = [sum(np.exp(v) for s, v in value.items() if c in s) / total for c in range(4)]
    assert np.allclose(pii.marginals(4, segments, scores), want)
    assert pii.best_path(4, segments, lambda s: scores[segments.index(s)]) == list(max(value, key=value.get))


def test_personal_data_of_odd_rows(spark, odd, none):
    out = pii.find_personal_data(odd)
    assert out.count() == odd.count() and {r["spans"] for r in out.collect()} == {""}
    assert pii.redact(odd).columns == odd.columns and pii.find_personal_data(none).count() == 0
    assert pii.redacted("a x@y.zz b", [("email", 2, 8)]) == "a [EMAIL] b"


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body>
<header><a href=/>Site</a></header><nav><ul><li><a href=a>One</a></li></ul></nav><div class="cookie-notice">We use cookies</div>
<div class="ad">Buy now</div><article><h1>Head &amp; line</h1><p>First   <b>bold</b><br>line<p>Second 1 &lt; 2</p><!-- x --><form>Mail <input></form></article>
<section class="comments"><p>Nice one, thank you for this long and friendly comment about it</p></section>
<aside>More to read</aside><footer>&copy; us</footer></body></html>"""


def test_main_text_of_a_page_and_of_broken_ones(spark):
    assert html_text.main_text(PAGE) == "Head & line\nFirst bold line\nSecond 1 < 2"
    pages = spark.createDataFrame([(1, "u", PAGE, 1), (2, None, None, 1), (3, "u", "", 1), (3, "u", "", 1), (None, "u", "<p", 1)], "page_id long, url string, html string, text int")
    got = sorted((r["page_id"] or 0, r["text"], r["n_chars"]) for r in html_text.extract(pages).collect())
    assert got == [(0, "", 0), (1, html_text.main_text(PAGE), 40), (2, "", 0), (3, "", 0), (3, "", 0)]
    for broken in ("<a " * 20000, '<a "' * 20000, "<!--" * 20000, "<" * 50000):
        html_text.main_text(broken)  # linear time


def test_main_text_of_the_test_pages_is_their_article():
    import html

    for (page,) in duckdb.sql(f"select html from '{SF_ORACLE}/pages.parquet'").fetchall():
        article = re.search(r"<article>(.*?)(</article>|$)", page, re.S).group(1)
        parts = [" ".join(html.unescape(re.sub(r"<[^>]*>?", " ", x)).split()) for x in re.split(r"</?(?:p|h1)>", article)]
        assert html_text.main_text(page) == "\n".join(p for p in parts if p)


def test_main_text_is_not_hidden_or_set_aside_by_loose_names():
    words = "Plain words of a story that goes on for a while and says what it has to say to all"
    whole = (
        f'<body><div class="post" style="overflow:hidden"><p>{words}</p></div></body>',
        f'<body><div class="post hidden-xs" id="hidden-costs"><p>{words}</p></div></body>',
        f'<body><meta name="x" content="hidden"><article><source title=hidden><p>{words}</p></article></body>',
        f'<body class="home no-sidebar"><p>{words}</p></body>',
        f'<body><div class="main-content with-sidebar"><p>{words}</p></div></body>',
        f'<body><div class="post tag-news"><p>{words}</p></div></body>',
        f'<html><head><title>T</title><meta charset=x><body><p>{words}</p></body>',
        f'<html><head><title>T</title><p>{words}</p>',
        f'<body><article><b hidden>no</b><p>{words}</p></article></body>',
    )
    for page in whole:
        assert html_text.main_text(page) == words, page
    assert html_text.main_text(f'<article><header class="entry-header"><h1>A title</h1></header><p>{words}</p></article>') == f"A title\n{words}"
    assert html_text.main_text(f"<article><p>{words} <math><mi>x</mi><mo>=</mo><mn>2</mn></math></p></article>") == f"{words} x=2"
    for attributes in ("hidden", 'style="color:red; display: none"', "aria-hidden=true", 'class="sidebar"', 'class="cookie-notice post"', 'class="post-comments"'):
        assert html_text.main_text(f"<article><p>{words}</p></article><div {attributes}><p>{words}</p></div>") == words, attributes


P65 = "<p>" + " ".join(f"w{i}" for i in range(65)) + "</p>"


def paragraphs(page: str) -> list[int]:
    """Sizes of the kept blocks in words."""
    text = html_text.main_text(page)
    return [len(b.split()) for b in text.split("\n")] if text else []


@pytest.mark.parametrize(
    "page,sizes",
    [
        (f"<body>{P65 * 3}</body>", [65, 65, 65]),
        (f"<body><h1>Two words</h1>{P65 * 2}<p>end</p></body>", [2, 65, 65, 1]),
        ("<body>" + P65.replace("p>", "div>") * 4, [65] * 4),
        ("<table>" + "".join(f"<tr><td>{P65[3:-4]}</td></tr>" for _ in range(3)) + "</table>", [65] * 3),
        ("<table>" + "".join(f"<tr><td>{P65[3:-4]}" for _ in range(3)) + "</table>", [65] * 3),
        (f"<nav><a href=x>Home</a></nav><div id=wrap>{P65}<p>short one</p>{P65}</div><footer>Imprint of us</footer>", [65, 2, 65]),
        (f"<ul><li><a href=a>One</a><li><a href=b>Two</a></ul>{P65 * 2}<ul><li><a href=c>Three</a></ul>", [65, 65]),
        (f"<p>We use cookies to improve your visit. Accept?</p><h1>A title</h1>{P65 * 2}<p>Copyright 2024, all rights reserved</p>", [2, 65, 65]),
        (f"<div class=sidebar>{P65}</div>{P65}<div class=related><article>{P65}</article></div>{P65}", [65, 65]),
        (f"<section>{P65}</section><section><h2>Next part</h2>{P65}</section><form>{P65}</form>", [65, 2, 65]),
        (f"<body class='home no-sidebar comments-open'><form id=all><main>{P65}</main></form>", [65]),
        (f"<article>{P65}<article class='comment-body'>{P65}</article></article>", [65]),
        (f"<aside class=related><article>{P65}</article></aside><article>{P65 * 2}</article>", [65, 65]),
        (f"<article><p class=ad>x<p>{P65[3:]}</article>", [65]),
        ("<article><ul><li class=share>S<li>four words of text</ul></article>", [4]),
        (f"<article><dl><dt class=ad>x<dd>two words</dl>{P65}</article>", [2, 65]),
        ("<p>one block alone of a page</p>", [6]),
    ],
)
def test_main_text_of_layouts(page, sizes):
    assert paragraphs(page) == sizes


@pytest.mark.parametrize("words", [20, 21, 30, 65, 300])
def test_no_long_block_outside_a_side_is_dropped(words):
    """Whatever stands around it: first, last, between links, after one word, with and without an article on the page."""
    block = "<div>" + " ".join(f"w{i}" for i in range(words)) + "</div>"
    around = ["", "<p>x</p>", "<p><a href=a>link</a></p>", P65, "<h2>a heading</h2>", "<div class=ad>some advert text</div>", f"<article>{P65}</article>"]
    for before in around:
        for after in around:
            assert words in paragraphs(before + block + after), (before[:20], after[:20])


def test_deep_and_broken_nesting_costs_linear_time():
    import time

    for page in ("<div>" * 30_000 + "x", "<p class=a>" * 20_000 + "x" + "</section>" * 20_000, "<div><li class=a>" * 15_000 + "x"):
        began = time.process_time()
        html_text.main_text(page)
        assert time.process_time() - began < 5


def test_tree_learns_its_layouts():
    rows = html_text.labelled()
    own = rows[: sum(len(x.split()) for x in html_text.LAYOUTS)]
    assert len(own) > 250 and all(html_text.keep(html_text.tree(), r[:-1]) == r[-1] for r in own)

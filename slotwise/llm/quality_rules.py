"""Operator 6: quality rules as weak supervision.

Each rule looks at one figure of a text and votes good (+1), bad (-1) or abstains
(0); some rules can only blame, others only praise.
Expectation-maximisation on the counts of all vote patterns estimates how
often each rule is right on good and on bad texts, without labels, and every text
gets the posterior probability of being good. The table of patterns has at most
``2 ** rules`` rows whatever the corpus, so only that table reaches the driver.
"""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotwise.llm.common import arrow_map, quoted, stored

SYMBOLS = b"#*$%&|<>"
_SYMBOL_RUNS = re.compile("[#*$%&|<>]+")
MIN_WORDS = 50
WINDOW = 3
#: Rules that can only blame: bad above the threshold, else abstain.
BLAME = (
    ("symbols_per_word", 0.25),
    ("symbol_runs_per_word", 0.2),
    ("duplicate_lines", 0.5),
    ("repeated_words", 0.3),
    ("upper_share", 0.3),
    ("marks_per_word", 0.6),
    ("word_length_off", 4.0),
    ("digit_share", 0.15),
)
#: Rules that can only praise: good if every named figure is at most its threshold, else abstain.
PRAISE = (
    {"symbols_per_word": 0.02, "digit_share": 0.05},
    {"duplicate_lines": 0.05, "repeated_words": 0.1},
    {"upper_share": 0.08, "marks_per_word": 0.3, "word_length_off": 3.0},
)
#: Weight of the prior belief in the rules, in corpora: enough to say which class is the good one, too
#: little to hold a rule's rates against what the corpus shows.
BELIEF = 0.01
#: Letters of scripts that put no spaces between words; above this share a text has no word length.
_UNSPACED = re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u2e80-\u9fff\uf900-\ufaff]")
UNSPACED_SHARE = 0.2


def text_figures(text: str) -> tuple[int, int, int, int, int]:
    """``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words`` of one text.

    A word is a run of characters other than space and the ASCII controls
    tab to carriage return; that is exactly how ``bytes.split`` cuts.
    """
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    joined = b"".join(words)
    word_chars = len(joined.decode("utf-8", "surrogatepass"))
    n_symbols = len(raw) - len(raw.translate(None, SYMBOLS))
    lines = [x for x in raw.split(b"\n") if x.split(None, 1)]
    return len(words), word_chars, n_symbols, len(lines) - len(set(lines)), repeated_words(words)


def repeated_words(words: list, window: int = WINDOW) -> int:
    """How many words lie in a window of ``window`` words that the text holds twice or more."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    known: dict = {}
    ids = np.array([known.setdefault(w, len(known)) for w in words], np.int64)
    code, base = ids[:n], len(known)
    for i in range(1, window):  # renumbered after each word, so codes stay below words squared
        code = np.unique(code * base + ids[i : n + i], return_inverse=True)[1].reshape(-1)
    hit = np.bincount(code)[code] > 1
    covered = np.zeros(len(words), bool)
    for i in range(window):
        covered[i : n + i] |= hit
    return int(covered.sum())


def votes(text: str, figures: tuple[int, int, int, int, int]) -> str:
    """One character per rule, ``-`` bad, ``+`` good, ``0`` abstains; a text without words gets abstentions only."""
    n_words, word_chars, n_symbols, n_dup, n_rep = figures
    if not n_words:
        return "0" * (len(BLAME) + len(PRAISE))
    unspaced = not text.isascii() and len(_UNSPACED.findall(text)) > UNSPACED_SHARE * word_chars
    got = {
        "symbols_per_word": n_symbols / n_words,
        "symbol_runs_per_word": len(_SYMBOL_RUNS.findall(text)) / n_words,
        "duplicate_lines": n_dup / (text.count("\n") + 1),
        "repeated_words": n_rep / n_words,
        "upper_share": len(re.findall("[A-ZÀ-ÖØ-Þ]", text)) / word_chars,
        "marks_per_word": sum(map(text.count, "!?.,;:")) / n_words,
        "word_length_off": 0.0 if unspaced else abs(word_chars / n_words - 6.0),
        "digit_share": len(re.findall("[0-9]", text)) / word_chars,
    }
    bad = ["-" if got[name] > most else "0" for name, most in BLAME]
    return "".join(bad + ["+" if all(got[k] <= most for k, most in rule.items()) else "0" for rule in PRAISE])


def figures_and_votes(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    def make():
        def each(cols: dict) -> dict:
            texts = [t or "" for t in cols["text"]]
            figures = [text_figures(t) for t in texts]
            out = dict(zip(("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"), zip(*figures) if figures else [()] * 5))
            out["pattern"] = [votes(t, f) for t, f in zip(texts, figures)]
            return {"id": cols["id"]} | out

        return each

    schema = "id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, pattern string"
    return arrow_map(docs.select(quoted(id_col).cast("bigint").alias("id"), quoted(text_col).alias("text")), schema, make)


def estimate(counts: list[tuple[str, int]], rounds: int = 500) -> tuple[dict[str, float], np.ndarray, np.ndarray]:
    """Posterior of a good text for each vote pattern, each rule's rate of votes on bad and good texts, and their shares.

    Expectation-maximisation over two classes, and per class and rule the probability that the rule
    votes. The prior says that a rule mostly votes on the class it speaks of and weighs as
    much as ``BELIEF`` times all texts, one text at least. No patterns give an empty table.
    """
    blame, praise = len(BLAME), len(PRAISE)
    belief = np.array([[0.5] * blame + [0.3] * praise, [0.005] * blame + [0.95] * praise])
    rate, prior = belief, np.array([0.2, 0.8])
    if not counts:
        return {}, rate, prior
    voted = np.array([[c != "0" for c in p] for p, _ in counts], float)
    n = np.array([c for _, c in counts], float)
    weight = BELIEF * n.sum() + 1
    for _ in range(rounds):
        log = np.log(prior)[:, None] + np.log(rate) @ voted.T + np.log1p(-rate) @ (1 - voted).T
        post = np.exp(log - np.logaddexp(*log))
        mass = post * n
        prior = (mass.sum(1) + 1) / (n.sum() + 2)
        new = (mass @ voted + weight * belief) / (mass.sum(1)[:, None] + weight)
        moved, rate = np.abs(new - rate).max(), new
        if moved < 1e-9:
            break
    return {p: float(x) for (p, _), x in zip(counts, post[1])}, rate, prior


def rule_quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep_at: float = 0.5) -> DataFrame:
    """Per row: the id, the five figures, ``base_failed``, ``pattern``, ``posterior`` and ``kept``.

    Null and empty texts have no words, so the base fails them. Rows that repeat
    an id are judged one by one. Other columns are ignored. An empty table gives
    an empty one. A posterior of exactly ``keep_at`` is kept.
    """
    spark = docs.sparkSession
    seen = stored(figures_and_votes(docs, id_col, text_col), "rule-votes")
    counts = seen.groupBy("pattern").agg(F.count(F.lit(1)).alias("n")).collect()  # at most 2 ** rules rows
    model, _, _ = estimate(sorted((r["pattern"], r["n"]) for r in counts))
    table = spark.createDataFrame(list(model.items()), "pattern string, posterior double")
    failed = (F.col("n_words") < MIN_WORDS) | (F.lit(100) * F.col("n_repeat_words") > F.lit(50) * F.col("n_words"))
    return seen.join(F.broadcast(table), "pattern").select(
        F.col("id").alias(id_col),
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        failed.alias("base_failed"),
        "pattern",
        "posterior",
        (~failed & (F.col("posterior") >= keep_at)).alias("kept"),
    )

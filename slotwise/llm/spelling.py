"""Operator 13: spelling variants by k-d trees over letter counts.

Method. A word becomes the vector of its letters' counts. One replaced letter
moves two counts by one each (L1 distance two), one inserted or deleted letter
moves one count (distance one). So the words near a word lie in a small ball of the
count space: for words of equal length one count higher and one lower, for words one
letter longer one count higher. The balls are searched with k-d trees, one tree for
each length; a branch is cut when its box needs more than these two moves. The words
found have their letter order compared at the end.

On a cluster. A coarse tree for each length is cut from a bounded sample of words
(``SAMPLE``); the sample decides where boxes end and nothing else. Every word
goes to its own box and, as a question, to each box that its ball reaches: for equal
lengths only to its own and later boxes, so each pair is met once. A box is one group of rows;
a box of more than ``MOST`` words is dealt to several groups by hash, each of which gets the
box's questions. Inside a group a fine tree is searched with all questions of a
batch at once. Groups report, per word, the number of near words and the best one, so
pairs are never written out.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotwise.llm.common import bounded_batches, quoted, stored

#: Words that cut the coarse trees, at most; and the words a box should hold.
SAMPLE, BOX = 65_536, 8192
#: Coarse boxes are cut from at least so many sample words.
SAMPLE_BOX = 8
#: Words of one group, at most.
MOST = 1 << 18
#: Words at the end of a fine tree, and pairs compared at once.
LEAF, PAIRS = 32, 1 << 16
#: Words counted in a task before their counts are handed on.
HELD = 400_000
#: The letters are A-Z, a-z and U+00C0-U+00FF; only A-Z are lower-cased.
_LETTERS = b"abcdefghijklmnopqrstuvwxyz" + bytes(range(0xC0, 0x100))
_PLAIN = bytes(c + 32 if 65 <= c <= 90 else c if c in _LETTERS else 32 for c in range(256))
_COLUMN = np.zeros(256, dtype=np.int64)
_COLUMN[list(_LETTERS)] = range(len(_LETTERS))


# --- words and their counts --------------------------------------------------------------


def _runs(text: str, least: int) -> list[bytes]:
    """Runs of at least ``least`` letters in Latin-1; other characters cannot be in a run."""
    return re.findall(rb"[^ ]{%d,}" % least, text.encode("latin-1", "replace").translate(_PLAIN))


def text_words(doc_id, text: str, least: int, drop_every: int | None) -> list[bytes]:
    """The words of a text; ``drop_every`` takes a letter out of those runs whose hash it divides."""
    words = _runs(text, least)
    if not drop_every:
        return words
    start = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    crc, out = zlib.crc32, []
    for word in words:
        h = crc(word if word.isascii() else word.decode("latin-1").encode(), start)
        if h % drop_every:
            out.append(word)
        elif len(word) > least:
            at = h % len(word)
            out.append(word[:at] + word[at + 1 :])
    return out


def word_counts(df: DataFrame, id_col: str, text_col: str, least: int, min_count: int, drop_every: int | None = None) -> DataFrame:
    """``word, n`` of the words of at least ``least`` letters with at least ``min_count`` occurrences."""
    docs = df.select(quoted(id_col).alias("id"), quoted(text_col).alias("text")).where("text is not null")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for i, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                counts.update(text_words(i, text, least, drop_every))
                if len(counts) > HELD:
                    yield _counted(counts)
                    counts.clear()
        yield _counted(counts)

    found = docs.mapInArrow(run, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    return found.where(F.col("n") >= min_count)


def _counted(counts: Counter) -> pa.RecordBatch:
    words = [w.decode("latin-1") for w in counts]
    return pa.record_batch([pa.array(words, pa.string()), pa.array(counts.values(), pa.int64())], names=["word", "n"])


# --- trees -------------------------------------------------------------------------------


def letters_of(words: list[str]) -> np.ndarray:
    """Words of one length as rows of Latin-1 codes."""
    joined = "".join(words).encode("latin-1")
    return np.frombuffer(joined, dtype=np.uint8).reshape(len(words), -1)


def counts_of(letters: np.ndarray) -> np.ndarray:
    """The letter counts of words of one length."""
    rows, length = letters.shape
    kind = np.int16 if length < 1 << 14 else np.int32
    out = np.zeros((rows, len(_LETTERS)), dtype=kind)
    at = np.arange(rows)
    for k in range(length):  # a column of letters holds each row once
        out[at, _COLUMN[letters[:, k]]] += 1
    return out


@dataclass(frozen=True)
class Cut:
    """Words with at most ``value`` letters ``letter`` lie on the low side."""

    letter: int
    value: int
    low: Cut | int
    high: Cut | int


def _best_cut(counts: np.ndarray) -> tuple[int, int] | None:
    """The letter and value that halve the rows best; None if all rows are equal."""
    total = len(counts)
    best = None
    top = int(counts.max(initial=0))
    for value in range(min(top, 4)):  # counts above four hardly halve anything, unless all are
        below = (counts <= value).sum(axis=0)
        off = np.abs(2 * below - total)
        off[(below == 0) | (below == total)] = 4 * total
        letter = int(off.argmin())
        if off[letter] < 2 * total and (best is None or off[letter] < best[0]):
            best = (int(off[letter]), letter, value)
    if best is None:
        spread = counts.max(axis=0) - counts.min(axis=0)
        letter = int(spread.argmax()) if len(spread) else 0
        if total == 0 or spread[letter] == 0:
            return None
        low, high = int(counts[:, letter].min()), int(counts[:, letter].max())
        return letter, (low + high) // 2
    return best[1:]


def plant(counts: np.ndarray, most: int, first: int = 0) -> tuple[Cut | int, int]:
    """A tree whose boxes hold at most ``most`` rows (or equal ones); boxes are numbered from ``first``."""
    cut = _best_cut(counts) if len(counts) > most else None
    if cut is None:
        return first, first + 1
    low_side = counts[:, cut[0]] <= cut[1]
    low, first = plant(counts[low_side], most, first)
    high, first = plant(counts[~low_side], most, first)
    return Cut(*cut, low, high), first


def search(tree: Cut | int, asked: np.ndarray, lower: int) -> Iterator[tuple[int, np.ndarray]]:
    """Boxes that the balls of ``asked`` reach, with the rows that reach them.

    A ball allows one count to be higher by one and ``lower`` (0 or 1) others to be
    lower by one. A row may step over a cut only on its border, and only with a move it has
    not made yet.
    """

    def walk(node: Cut | int, rows: np.ndarray, up: np.ndarray, down: np.ndarray):
        if not len(rows):
            return
        if not isinstance(node, Cut):
            yield node, rows
            return
        own = asked[rows, node.letter]
        inside = own <= node.value
        step = (own == node.value + 1) & (down > 0)
        keep = inside | step
        yield from walk(node.low, rows[keep], up[keep], down[keep] - step[keep])
        step = (own == node.value) & (up > 0)
        keep = ~inside | step
        yield from walk(node.high, rows[keep], up[keep] - step[keep], down[keep])

    n = len(asked)
    yield from walk(tree, np.arange(n), np.ones(n, dtype=np.int8), np.full(n, lower, dtype=np.int8))


def home(tree: Cut | int, counts: np.ndarray) -> np.ndarray:
    """The box of every row."""
    out = np.zeros(len(counts), dtype=np.int64)

    def walk(node: Cut | int, rows: np.ndarray) -> None:
        if not isinstance(node, Cut):
            out[rows] = node
        elif len(rows):
            low = counts[rows, node.letter] <= node.value
            walk(node.low, rows[low])
            walk(node.high, rows[~low])

    walk(tree, np.arange(len(counts)))
    return out


# --- letter order ------------------------------------------------------------------------


def one_replaced(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which rows of equal length differ in exactly one place."""
    return (a != b).sum(axis=1) == 1


def one_inserted(short: np.ndarray, long: np.ndarray) -> np.ndarray:
    """Which rows of ``long`` are those of ``short`` with one letter put in."""
    n = short.shape[1]
    before, after = short != long[:, :-1], short != long[:, 1:]
    first = np.where(before.any(axis=1), before.argmax(axis=1), n)  # the insertion is at or before this place
    last = np.where(after.any(axis=1), n - after[:, ::-1].argmax(axis=1), 0)  # and not before this one
    return last <= first


def near_pairs(tree: Cut | int, boxes: list[np.ndarray], letters: np.ndarray, counts: np.ndarray, asked: np.ndarray, asked_counts: np.ndarray, longer: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs (question, member) at one edit; ``longer``: members have one letter more."""
    wanted = 1 if longer else 2
    for box, rows in search(tree, asked_counts, 0 if longer else 1):
        members = boxes[box]
        step = max(1, PAIRS // max(len(members), 1))
        for at in range(0, len(rows), step):
            part = rows[at : at + step]
            for cut in range(0, len(members), PAIRS):
                some = members[cut : cut + PAIRS]
                apart = np.zeros((len(part), len(some)), dtype=np.int32)
                for column in np.flatnonzero(counts[some].any(axis=0) | asked_counts[part].any(axis=0)):
                    apart += np.abs(asked_counts[part, column, None] - counts[None, some, column])
                q, m = np.nonzero(apart == wanted)
                q, m = part[q], some[m]
                good = (one_inserted if longer else one_replaced)(asked[q], letters[m])
                if good.any():
                    yield q[good], m[good]


# --- groups ------------------------------------------------------------------------------

_NEAR = "word string, n_near bigint, form_n bigint, form string"


def _best(own: np.ndarray, other: np.ndarray, n: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each of ``own``: how many others it has, and the one of largest n (ties: the first by rank)."""
    order = np.lexsort((rank[other], -n[other], own))
    own, other = own[order], other[order]
    start = np.flatnonzero(np.append(True, own[1:] != own[:-1]))
    return own[start], np.diff(np.append(start, len(own))), other[start]


def _answers(members: list[str], member_n: np.ndarray, asked: list[str], asked_n: np.ndarray, fine, longer: bool, same_box: np.ndarray) -> Iterator[pa.RecordBatch]:
    tree, boxes, letters, counts = fine
    rows = letters_of(asked)
    found = list(near_pairs(tree, boxes, letters, counts, rows, counts_of(rows), longer))
    if not found:
        return
    q, m = (np.concatenate(x) for x in zip(*found))
    if not longer:  # inside a box both words ask: the smaller one's question counts
        keep = np.array([not same_box[a] or asked[a] < members[b] for a, b in zip(q.tolist(), m.tolist())], dtype=bool)
        q, m = q[keep], m[keep]
    if not len(q):
        return
    for own, names, other, others, n in ((q, asked, m, members, member_n), (m, members, q, asked, asked_n)):
        rank = np.empty(len(others), dtype=np.int64)
        rank[sorted(range(len(others)), key=others.__getitem__)] = np.arange(len(others))
        who, many, best = _best(own, other, n, rank)
        yield pa.record_batch(
            [pa.array([names[i] for i in who.tolist()], pa.string()), pa.array(many, pa.int64()), pa.array(n[best], pa.int64()), pa.array([others[i] for i in best.tolist()], pa.string())],
            names=["word", "n_near", "form_n", "form"],
        )


def _search_group(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows ``slot, role, home, word, n`` in order of slot and role: a group's members, then its questions."""
    now, names, ns, fine = None, [], [], None
    for batch in batches:
        slots, roles, homes, words, n = (c.to_pylist() for c in batch.columns)
        at = 0
        while at < len(slots):
            end = at
            while end < len(slots) and (slots[end], roles[end]) == (slots[at], roles[at]):
                end += 1
            if slots[at] != now:
                now, names, ns, fine = slots[at], [], [], None
            if roles[at] == 0:
                names += words[at:end]
                ns += n[at:end]
            elif names:
                if fine is None:
                    letters = letters_of(names)
                    counts = counts_of(letters)
                    tree, many = plant(counts, LEAF)
                    place = home(tree, counts)
                    order = np.argsort(place, kind="stable")
                    fine = (tree, np.split(order, np.searchsorted(place[order], np.arange(1, many))), letters, counts)
                own = np.array(homes[at:end], dtype=bool)
                yield from _answers(names, np.array(ns), words[at:end], np.array(n[at:end]), fine, roles[at] == 2, own)
            at = end


def _coarse_trees(vocabulary: DataFrame) -> dict[int, tuple[Cut | int, int, int]]:
    """Per length: its tree, the number of its first box, and how many there are.

    Lengths come from one row per length, words from a sample of about ``SAMPLE`` words (all, if
    there are no more), those of lowest hash.
    """
    lengths = {r["size"]: r["n"] for r in vocabulary.groupBy(F.length("word").alias("size")).agg(F.count(F.lit(1)).alias("n")).collect()}
    by_size: dict[int, list[str]] = {}
    share = min(1.0, SAMPLE / max(sum(lengths.values()), 1))
    lowest = F.pmod(F.xxhash64("word"), F.lit(1 << 40)) < int(share * (1 << 40))
    for r in vocabulary.where(lowest).select("word").collect():
        by_size.setdefault(len(r["word"]), []).append(r["word"])
    out, first = {}, 0
    for size in sorted(lengths):
        words = by_size.get(size, [])
        most = max(SAMPLE_BOX, len(words) * BOX // lengths[size])
        tree, end = plant(counts_of(letters_of(words)), most, first) if words else (first, first + 1)
        out[size] = (tree, first, end - first)
        first = end
    return out


def near_words(vocabulary: DataFrame) -> DataFrame:
    """``word, n_near, form_n, form`` of every word of ``vocabulary(word, n)`` that has a near word.

    ``vocabulary`` holds each word once. ``form`` is the near word of largest n
    (ties: the smallest), ``form_n`` its n.
    """
    trees = _coarse_trees(vocabulary)

    def of_length(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, list[str]]]:
        words = batch.column(0).to_pylist()
        by: dict[int, list[int]] = {}
        for i, w in enumerate(words):
            by.setdefault(len(w), []).append(i)
        for size, rows in by.items():
            yield size, np.array(rows), [words[i] for i in rows]

    def count_homes(batches):
        for batch in batches:
            for size, _, words in of_length(batch):
                box, many = np.unique(home(trees[size][0], counts_of(letters_of(words))), return_counts=True)
                yield pa.record_batch([pa.array(box), pa.array(many, pa.int64())], names=["box", "n"])

    held = vocabulary.select("word").mapInArrow(count_homes, "box bigint, n bigint").groupBy("box").agg(F.sum("n").alias("n"))
    parts = {r["box"]: -(-r["n"] // MOST) for r in held.collect()}  # one row per box

    def deal(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows ``box, part, role, home, word, n``."""
        for batch in batches:
            for size, rows, words in of_length(batch):
                letters = letters_of(words)
                counts = counts_of(letters)
                own = home(trees[size][0], counts)
                crcs = np.array([zlib.crc32(w.encode()) for w in words])
                sent = [(rows, own, crcs % np.array([parts[b] for b in own.tolist()]), 0, False)]
                for role, tree in ((1, trees.get(size)), (2, trees.get(size + 1))):
                    for box, who in search(tree[0], counts, 2 - role) if tree else ():
                        who = who[own[who] <= box] if role == 1 else who
                        for part in range(parts.get(box, 0)):
                            sent.append((rows[who], np.full(len(who), box), np.full(len(who), part), role, own[who] == box))
                for at, box, part, role, same in sent:
                    if len(at):
                        taken = batch.take(pa.array(at))
                        kept = pa.array(np.broadcast_to(same, len(at)))
                        columns = [pa.array(box, pa.int64()), pa.array(part, pa.int64()), pa.array(np.full(len(at), role), pa.int32()), kept]
                        yield pa.record_batch([*columns, *taken.columns], names=["box", "part", "role", "home", "word", "n"])

    dealt = vocabulary.select("word", "n").mapInArrow(deal, "box bigint, part bigint, role int, home boolean, word string, n bigint")
    slot = F.concat_ws("/", "box", "part")
    groups = dealt.select(slot.alias("slot"), "role", "home", "word", "n")
    groups = groups.repartition("slot").sortWithinPartitions("slot", "role")
    found = groups.mapInArrow(_search_group, _NEAR)
    best = F.min(F.struct((-F.col("form_n")).alias("less"), F.col("form").alias("form")))
    found = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("best"))
    return found.select("word", "n_near", (-F.col("best.less")).alias("form_n"), F.col("best.form").alias("form"))


def roots(forms: DataFrame) -> DataFrame:
    """``word, root`` of ``forms(word, form)``: forms followed to the last, by doubling.

    A form's n is a multiple of its word's, so chains are short; the number of rounds is the
    logarithm of the longest one. A common root is one key on the side with many
    rows only, which Spark's skew join may cut.
    """
    now = stored(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        next_ = now.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = now.join(next_, "root", "left")
        now = stored(moved.select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "spelling-roots")
        if now.where("moved").isEmpty():
            return now.select("word", "root")
        now = now.select("word", "root")


def spelling_variants(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = 6, min_count: int = 5, ratio: int = 5, drop_every: int | None = None
) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for every word of the texts.

    Words are lower-cased runs of letters with at least ``least`` letters and
    ``min_count`` occurrences in all texts. Words are near if one letter is put in,
    taken out or replaced. ``form`` is the near word of largest n (ties: the smallest), if
    that is at least ``ratio`` times the word's n; ``root`` follows forms to the last.
    Null and empty texts have no words, repeated rows count each, ids matter to
    ``drop_every`` only (a null id is empty there), and other columns are not read. An
    empty table gives an empty table.
    """
    bounded_batches(df.sparkSession)
    vocabulary = stored(word_counts(df, id_col, text_col, least, min_count, drop_every), "spelling-words")
    near = near_words(vocabulary)
    joined = vocabulary.join(near, "word", "left")
    good = F.col("form_n") >= ratio * F.col("n")
    words = stored(
        joined.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(good, F.col("form")).alias("form"), F.when(good, F.col("form_n")).alias("form_n")),
        "spelling-forms",
    )
    last = roots(words.where("form is not null"))
    out = words.join(last, "word", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")

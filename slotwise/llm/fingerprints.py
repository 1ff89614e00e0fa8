"""Operator 12: document fingerprints by context-triggered piecewise hashing.

Method. A hash of the last seven bytes rolls over the UTF-8 text; where it hits
a multiple of the block size the text is cut. As the cut depends on the bytes around
it alone, an edit changes the pieces it touches and no others. Every piece is
hashed to two letters; the letters of all pieces are the signature. Block sizes are
3 * 2^k, and each cut of a block size is a cut of the smaller ones too. A text takes the
smallest block size that gives at most 64 cuts, and carries the signature of the next
larger one as well, so that texts whose block sizes differ by one step can
still be compared. Two signatures of one block size are compared by their edit distance
(pieces inserted and deleted): likeness = 1 - distance / (pieces of both).

A fingerprint reads ``block size:signature:signature at twice the block size``.
Nothing is cut off: every byte belongs to a piece of either signature.

Neighbours. ``fingerprint_edits`` compares each document with an edited form that
ends in the start of the next document by id. Documents are dealt to contiguous id
ranges of about equal bytes, whose borders come from a pass over ids and sizes. The first
document of a range is also sent to the range before, so each task sees the
successor of its last document. Whole texts move once.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotwise.llm.common import bounded_batches, quoted, stored, with_fields

WINDOW = 7
SMALLEST = 3
MOST_CUTS = 64
LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
#: Ranges of ids looked at for each range that is made of them.
FINE = 8

_ROLL = np.array([pow(0x01000193, k, 1 << 32) for k in range(WINDOW)], dtype=np.uint32)
_BASE = 0x9E3779B97F4A7C15 | 1
_BACK = pow(_BASE, -1, 1 << 64)
_PAIRS = [a + b for a in LETTERS for b in LETTERS]
_NUMBERS = {p: i for i, p in enumerate(_PAIRS)}


class _Powers:
    """Powers of the piece hash's base and of its inverse modulo 2^64, grown as texts need them."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def upto(self, n: int) -> None:
        while len(self.up) <= n:
            k = len(self.up)
            self.up = np.concatenate([self.up, self.up * np.uint64(pow(_BASE, k, 1 << 64))])
            self.down = np.concatenate([self.down, self.down * np.uint64(pow(_BACK, k, 1 << 64))])


_POWERS = _Powers()


class Fingerprint(NamedTuple):
    """Block size and the pieces' letters (as numbers below 4096) at it and at its double."""

    block: int
    fine: tuple[int, ...]
    coarse: tuple[int, ...]

    def text(self) -> str:
        return f"{self.block}:{''.join(_PAIRS[x] for x in self.fine)}:{''.join(_PAIRS[x] for x in self.coarse)}"


def _cuts(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where pieces may end (exclusive), and for each the largest k whose block size cuts there."""
    n = len(data)
    rolled = data * _ROLL[0]
    for k in range(1, min(WINDOW, n)):
        rolled[k:] += data[: n - k] * _ROLL[k]
    rolled ^= rolled >> np.uint32(15)  # the high bits take part in the remainder
    rolled *= np.uint32(0x2C1B3C6D)
    rolled ^= rolled >> np.uint32(12)
    at = np.flatnonzero(rolled % np.uint32(SMALLEST) == 0)
    steps = rolled[at] // np.uint32(SMALLEST)
    low = (steps & (~steps + np.uint32(1))).astype(np.float64)
    return at + 1, np.where(steps == 0, 32, np.log2(np.maximum(low, 1.0))).astype(np.int8)


def _pieces(sums: np.ndarray, ends: np.ndarray) -> tuple[int, ...]:
    n = len(sums) - 1
    ends = np.append(ends, n) if not len(ends) or ends[-1] != n else ends
    starts = np.concatenate([[0], ends[:-1]])
    value = (sums[ends] - sums[starts]) * _POWERS.down[starts]
    value ^= value >> np.uint64(32)
    value *= np.uint64(0xD6E8FEB86659FD93)
    return tuple((value >> np.uint64(52)).tolist())


def fingerprint(text: str) -> Fingerprint:
    """The fingerprint of a whole text; the empty text has no pieces."""
    raw = text.encode("utf-8", "surrogatepass")
    if not raw:
        return Fingerprint(SMALLEST, (), ())
    data = np.frombuffer(raw, dtype=np.uint8).astype(np.uint32) + np.uint32(1)
    ends, levels = _cuts(data)
    counts = np.bincount(levels, minlength=34)[::-1].cumsum()[::-1]  # cuts at each level
    level = int(np.argmax(counts <= MOST_CUTS))
    _POWERS.upto(len(data))
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(data.astype(np.uint64) * _POWERS.up[: len(data)], out=sums[1:])
    return Fingerprint(SMALLEST << level, _pieces(sums, ends[levels >= level]), _pieces(sums, ends[levels > level]))


def edit_distance(a: tuple[int, ...], b: tuple[int, ...]) -> int:
    """Insertions and deletions that turn ``a`` into ``b`` (one bit a piece of ``a``)."""
    places: dict[int, int] = {}
    for i, x in enumerate(a):
        places[x] = places.get(x, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for x in b:
        hit = row & places.get(x, 0)
        row = (row + hit | row - hit) & full
    return len(a) + len(b) - 2 * (len(a) - row.bit_count())


def _alike(a: tuple[int, ...], b: tuple[int, ...]) -> float:
    return 1.0 - edit_distance(a, b) / (len(a) + len(b)) if a or b else 1.0


def likeness(a: Fingerprint, b: Fingerprint) -> float:
    """The better likeness of signatures of one block size; 0 if they share none, 1 for equal ones."""
    if a == b:
        return 1.0
    known = {b.block: b.fine, 2 * b.block: b.coarse}
    return max((_alike(x, known[size]) for size, x in ((a.block, a.fine), (2 * a.block, a.coarse)) if size in known), default=0.0)


def parse(text: str) -> Fingerprint:
    """A fingerprint from its text."""
    block, *parts = text.split(":")
    return Fingerprint(int(block), *(tuple(_NUMBERS[p[i : i + 2]] for i in range(0, len(p), 2)) for p in parts))


# --- documents and their successors ------------------------------------------------------


def _borders(docs: DataFrame, parts: int) -> list[tuple]:
    """First keys of at most ``parts`` contiguous id ranges of about equal bytes.

    Spark lays ids, hashes and sizes (no texts) out in ``FINE * parts`` ranges and
    reports the first key and the bytes of each; whole ranges are then put together.
    """
    keys = docs.select("id", "h", (F.octet_length("text") + 64).cast("long").alias("size"))
    laid = stored(keys.repartitionByRange(FINE * parts, F.col("id").asc_nulls_first(), "h").withColumn("part", F.spark_partition_id()), "finger-keys")
    # a struct of a null flag first: null ids come first, as in the order of the documents
    first = F.min(F.struct(F.col("id").isNotNull().alias("given"), "id", "h")).alias("first")
    found = laid.groupBy("part").agg(first, F.sum("size").alias("size")).orderBy("part").collect()  # FINE * parts rows
    total, done, out = sum(r["size"] for r in found), 0, []
    for r in found:
        if len(out) * total <= done * parts:  # this many ranges' worth of bytes lie before
            out.append(tuple(r["first"]))
        done += r["size"]
    return out


def fingerprint_edits(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", parts: int | None = None) -> DataFrame:
    """``id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next`` for every document.

    The edited text is the text whose last floor(n_chars / 4) code points are
    replaced by the first as many (or all) of the next document: ascending id, nulls
    first, equal ids in the order of their texts' hashes; the last is followed by the
    first, a single document by itself. A null text is an empty one. Repeated rows have
    a result each; rows equal in id and text follow each other, in one task. An empty table
    gives an empty table. ``parts`` id ranges are made, by default as many as
    shuffle partitions.
    """
    spark = df.sparkSession
    bounded_batches(spark)
    parts = parts or max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    text = F.coalesce(quoted(text_col), F.lit(""))
    docs = df.select(quoted(id_col).alias("id"), F.xxhash64(text).alias("h"), text.alias("text"))
    borders = _borders(docs, parts)
    made = with_fields(
        docs.select("id"), "n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    )

    @F.arrow_udf("array<struct<part: int, ahead: boolean>>")
    def places(ids: pa.Array, hashes: pa.Array) -> pa.Array:
        """Each row's range; the first key of a range also goes, marked, to the range before."""
        out = []
        for i, h in zip(ids.to_pylist(), hashes.to_pylist()):
            key = (i is not None, i, h)
            here = bisect_right(borders, key) - 1
            out.append([{"part": here, "ahead": False}])
            if key == borders[here]:
                out[-1].append({"part": (here or len(borders)) - 1, "ahead": True})
        return pa.array(out, pa.list_(pa.struct([("part", pa.int32()), ("ahead", pa.bool_())])))

    @F.arrow_udf("string")
    def sign(texts: pa.Array) -> pa.Array:
        return pa.array([fingerprint(t.as_py()).text() for t in texts], pa.string())

    def edit(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows of a range in order; a row is finished when its successor is seen."""
        held = None
        for batch in batches:
            out = []
            for row in range(batch.num_rows):  # one text at a time
                i, text, ahead, own = (c[row].as_py() for c in batch.columns)
                if held:
                    out.append(_finished(*held, text, own))
                held = None if ahead else (i, text, own)
            columns = list(zip(*out)) or [()] * len(made.names)
            kinds = [batch.schema.field(0).type, pa.int64(), *[pa.string()] * 3, *[pa.float64()] * 2]
            yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, kinds)], names=made.names)

    dealt = docs.select("*", sign("text").alias("fingerprint"), F.explode(places("id", "h")).alias("place"))
    dealt = dealt.select("id", "h", "text", "fingerprint", "place.part", "place.ahead")
    ranges = dealt.repartitionById(max(len(borders), 1), "part")
    ranges = ranges.sortWithinPartitions("part", "ahead", F.col("id").asc_nulls_first(), "h")
    return ranges.select("id", "text", "ahead", "fingerprint").mapInArrow(edit, made)


def _finished(i, text: str, sign: str, after: str, after_sign: str) -> tuple:
    k = len(text) // 4
    edited = text[: len(text) - k] + after[:k]
    own, other = parse(sign), fingerprint(edited)
    digest = hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest()
    return i, len(text), digest, sign, other.text(), likeness(own, other), likeness(own, parse(after_sign))

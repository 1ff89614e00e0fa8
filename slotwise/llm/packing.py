"""Operator 7: pack token sequences into as few bins as possible.

Bin packing with the linear grouping scheme, on the histogram of lengths. The
histogram has at most ``capacity`` rows whatever the corpus, and the whole plan is
made on it; documents meet the plan again by their rank among equal lengths.

1. Pieces longer than ``small`` of the capacity are *large*. Sorted, they are cut
   into ``groups`` groups of equal cardinality; every length is rounded up to its
   group's largest, which leaves few sizes.
2. A linear programme over the configurations (multisets of those sizes that fit
   a bin) covers every group with the fewest bins; its columns are generated one
   by one with a knapsack. The counts are rounded down.
3. Actual lengths take the rounded places of their group, the longest first.
   Large pieces that the rounding down left over go to new or open bins by best fit.
4. Small pieces, longest first, go by best fit into what is left.

Bins that hold the same lengths are kept as one *batch* with a range of bin
numbers, so the plan's size follows the histogram, not the corpus.
"""

from __future__ import annotations

import bisect
import zlib
from collections import defaultdict

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slotwise.llm.common import free_names, quoted, stored
from slotwise.llm.tokens import chunk_ids, default_vocabulary, packed_ids

CAPACITY = 4096
END_ID = 1

PIECES = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("piece", T.IntegerType()),
        T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()),
        T.StructField("ids_crc32", T.LongType()),
    ]
)


def token_pieces(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    vocabulary: str | None = None,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    with_ids: bool = False,
) -> DataFrame:
    """Every document as pieces of at most ``capacity`` ids: ``doc_id, piece, start, length, ids_crc32`` (and ``ids``).

    Null texts are empty; an empty document is its end id alone. Rows that repeat
    an id give their pieces again. Other columns are ignored. One row after the
    other is encoded, and pieces leave in batches of bounded size.
    """
    path = vocabulary or default_vocabulary()
    schema = T.StructType([*PIECES.fields, *([T.StructField("ids", T.ArrayType(T.LongType()))] if with_ids else [])])
    types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), *([pa.list_(pa.int64())] if with_ids else [])]

    def run(batches):
        ids, end = chunk_ids(path), int(end_id).to_bytes(4, "little")
        cut = 4 * capacity

        def ready(rows):
            return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=schema.names)

        for batch in batches:
            rows, held = [], 0
            for i in range(batch.num_rows):
                packed = packed_ids(batch.column(1)[i].as_py() or "", ids) + end
                for k, at in enumerate(range(0, len(packed), cut)):
                    part = packed[at : at + cut]
                    row = [batch.column(0)[i].as_py(), k, at // 4, len(part) // 4, zlib.crc32(part)]
                    rows.append([*row, np.frombuffer(part, "<u4")] if with_ids else row)
                    held += len(part) if with_ids else 64
                if held > 1 << 22:
                    yield ready(rows)
                    rows, held = [], 0
            if rows:
                yield ready(rows)

    return docs.select(quoted(id_col).cast("bigint"), quoted(text_col)).mapInArrow(run, schema)


# --- the plan on the histogram ---------------------------------------------------------


def best_configuration(sizes: list[int], worth: np.ndarray, capacity: int) -> list[int]:
    """The counts per size that fit one bin and are worth most (knapsack, one more piece per layer)."""
    value, took = np.zeros(capacity + 1), []
    for _ in range(capacity // min(sizes)):
        more, which = value.copy(), np.full(capacity + 1, -1)
        for g, size in enumerate(sizes):
            if worth[g] > 1e-12:
                with_it = worth[g] + value[:-size]
                better = with_it > more[size:] + 1e-12
                more[size:][better] = with_it[better]
                which[size:][better] = g
        if not (which >= 0).any():
            break
        took.append(which)
        value = more
    counts, room = [0] * len(sizes), capacity
    for which in reversed(took):
        if which[room] >= 0:
            counts[which[room]] += 1
            room -= sizes[which[room]]
    return counts


def cover(sizes: list[int], need: list[int], capacity: int) -> dict[tuple[int, ...], int]:
    """Fewest bins that cover ``need`` pieces of each size; counts rounded down.

    The linear programme over all configurations, by the revised simplex: it
    starts with bins of one size each and brings in the configuration that is
    worth most at the current prices, until none is worth more than a bin.
    """
    k, need_v = len(need), np.array(need, float)
    base = np.diag([float(capacity // s) for s in sizes])
    for _ in range(30 * k):
        inv = np.linalg.inv(base)
        worth = np.ones(k) @ inv
        column = np.array(best_configuration(sizes, worth, capacity), float)
        if worth @ column <= 1 + 1e-6:
            break
        x, d = inv @ need_v, inv @ column
        ratio = np.where(d > 1e-9, x / np.maximum(d, 1e-9), np.inf)
        base[:, int(np.argmin(ratio))] = column
    x = np.linalg.inv(base) @ need_v
    used: dict[tuple[int, ...], int] = defaultdict(int)
    for r in range(k):
        used[tuple(int(round(v)) for v in base[:, r])] += int(max(x[r], 0) + 1e-9)
    return dict(used)


class Bins:
    """Open bins as batches ``(first bin, count)`` under the room left, and the runs placed so far.

    A run ``(length, rank, count, bin, offset)`` puts pieces ``rank .. rank+count-1``
    of a length at ``offset`` of bins ``bin .. bin+count-1``.
    """

    def __init__(self, capacity: int):
        self.capacity, self.made = capacity, 0
        self.rooms: list[int] = []  # sorted keys of open
        self.open: dict[int, list[tuple[int, int]]] = {}
        self.runs: list[tuple[int, int, int, int, int]] = []
        self.ranks: dict[int, int] = defaultdict(int)

    def add(self, room: int, first: int, count: int) -> None:
        if room not in self.open:
            bisect.insort(self.rooms, room)
            self.open[room] = []
        self.open[room].append((first, count))

    def put(self, length: int, count: int, first: int, room: int) -> None:
        self.runs.append((length, self.ranks[length], count, first, self.capacity - room))
        self.ranks[length] += count

    def new(self, count: int) -> int:
        self.made += count
        return self.made - count

    def best_fit(self, length: int, count: int) -> None:
        while count:
            at = bisect.bisect_left(self.rooms, length)
            if at == len(self.rooms):
                each = self.capacity // length
                n = -(-count // each)  # new bins for all that remain, filled one layer after the other
                first, room = self.new(n), self.capacity
                while count:
                    m = min(n, count)
                    self.put(length, m, first, room)
                    if m < n and room:
                        self.add(room, first + m, n - m)
                    n, count, room = m, count - m, room - length
                if room:
                    self.add(room, first, n)
                return
            room = self.rooms[at]
            first, n = self.open[room].pop()
            m = min(n, count)
            if m < n:
                self.open[room].append((first + m, n - m))
            elif not self.open[room]:
                del self.open[room]
                self.rooms.pop(at)
            self.put(length, m, first, room)
            count -= m
            if room > length:
                self.add(room - length, first, m)


def plan(histogram: dict[int, int], capacity: int = CAPACITY, groups: int = 90, small: float = 0.3) -> Bins:
    """The runs that place every piece of a histogram ``length -> count``."""
    bins = Bins(capacity)
    full = histogram.get(capacity, 0)
    if full:
        bins.put(capacity, full, bins.new(full), capacity)
    large = sorted((x for x in histogram.items() if small * capacity < x[0] < capacity), reverse=True)
    queues = _groups(large, groups)
    if queues:
        sizes = [q[0][0] for q in queues]
        need = [sum(n for _, n in q) for q in queues]
        chosen = cover(sizes, need, capacity)
        for config in sorted(chosen, reverse=True):
            _substitute(bins, queues, config, chosen[config])
    rest = defaultdict(int, {k: n for k, n in histogram.items() if k <= small * capacity and k < capacity})
    for q in queues:
        for length, n in q:
            rest[length] += n
    for length in sorted(rest, reverse=True):
        bins.best_fit(length, rest[length])
    return bins


#: Plans that are made and compared: the share of the capacity up to which lengths are small (1: best fit alone), and the groups.
PLANS = ((0.3, 90), (0.2, 90), (1.0, 1))


def best_plan(histogram: dict[int, int], capacity: int = CAPACITY) -> Bins:
    """The plan with the fewest sequences; ties and a plan that reaches the volume's bound end the search at the first."""
    bound = -(-sum(k * n for k, n in histogram.items()) // capacity)
    best = None
    for small, groups in PLANS:
        bins = plan(histogram, capacity, groups, small)
        if best is None or bins.made < best.made:
            best = bins
        if best.made <= bound:
            break
    return best


def _groups(large: list[tuple[int, int]], groups: int) -> list[list[list[int]]]:
    """Runs ``[length, count]``, longest first, dealt into groups of about equal cardinality.

    Copies of one length stay together; a length that alone exceeds a group's share is a group of its own.
    """
    share, out, held = sum(n for _, n in large) / groups, [], 0
    for length, n in large:
        if not out or held >= share or held + n > 1.5 * share:
            out.append([])
            held = 0
        out[-1].append([length, n])
        held += n
    return out


def _substitute(bins: Bins, queues: list[list[list[int]]], config: tuple[int, ...], times: int) -> None:
    """Fill ``times`` bins of one configuration with actual lengths, equal bins at once."""
    places = [g for g, n in enumerate(config) for _ in range(n)]
    while times and places:
        if any(sum(n for _, n in queues[g]) < places.count(g) for g in set(places)):
            return  # what is left of a group goes by best fit
        taken, m = [], times
        for g in set(places):  # the longest of a group share its places
            left = places.count(g)
            for length, n in queues[g]:
                k = min(left, n)
                taken.append((g, length, k))
                left -= k
                if not left:
                    break
        for g, length, k in taken:
            have = next(n for x, n in queues[g] if x == length)
            m = min(m, have // k)
        first, room = bins.new(m), bins.capacity
        for g, length, k in taken:
            for _ in range(k):
                bins.put(length, m, first, room)
                room -= length
            entry = next(e for e in queues[g] if e[0] == length)
            entry[1] -= m * k
            if not entry[1]:
                queues[g].remove(entry)
        if room:
            bins.add(room, first, m)
        times -= m


# --- documents and the plan --------------------------------------------------------------


def pack(pieces: DataFrame, length_col: str = "length", capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` plus ``sequence_id`` and ``offset``; offsets leave no gap in a sequence.

    Lengths lie in 1 .. capacity. Pieces of equal length are interchangeable: the
    plan fixes how many go where, their hash decides which. Columns of those two
    names in the input are replaced; an empty table stays empty.
    """
    spark = pieces.sparkSession
    pieces = pieces.drop(*[c for c in pieces.columns if c.lower() in ("sequence_id", "offset")])
    length, key, salt, n, before, rank, spot = free_names(pieces, "length_", "key", "salt", "n", "before", "rank", "spot")
    salts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    # a salt splits a length that many pieces share; ranks run on over its salts
    salted = pieces.withColumns(
        {
            length: quoted(length_col).cast("bigint"),
            key: F.xxhash64(*[quoted(c) for c in pieces.columns if not isinstance(pieces.schema[c].dataType, T.ArrayType)]),
        }
    ).withColumn(salt, F.pmod(F.col(key), F.lit(salts)).cast("int"))
    counts = stored(salted.groupBy(length, salt).agg(F.count(F.lit(1)).alias(n)), "pack-counts")
    histogram = {r[0]: r[1] for r in counts.groupBy(length).agg(F.sum(n)).collect()}  # at most `capacity` rows
    runs = best_plan(histogram, capacity).runs
    earlier = W.partitionBy(length).orderBy(salt).rowsBetween(W.unboundedPreceding, -1)
    starts = counts.select(length, salt, F.coalesce(F.sum(n).over(earlier), F.lit(0)).alias(before))
    ranked = salted.withColumn(rank, F.row_number().over(W.partitionBy(length, salt).orderBy(key)) - 1)
    placed = ranked.join(starts, [length, salt]).withColumn(rank, F.col(rank) + F.col(before))
    placed = placed.withColumn(spot, _lookup(runs)(F.col(length), F.col(rank)))
    return placed.select(
        *[quoted(c) for c in pieces.columns],
        F.col(spot)["sequence_id"].alias("sequence_id"),
        F.col(spot)["offset"].alias("offset"),
    )


def _lookup(runs: list[tuple[int, int, int, int, int]]):
    """A column function ``(length, rank) -> (sequence_id, offset)`` over the plan's runs."""
    order = sorted(runs)
    table = np.array(order, np.int64).reshape(-1, 5)
    step = 1 << 44  # ranks stay below it
    keys = table[:, 0] * step + table[:, 1]

    @F.pandas_udf("sequence_id long, offset long")
    def find(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        at = np.searchsorted(keys, length.to_numpy() * step + rank.to_numpy(), "right") - 1
        run = table[at]
        return pd.DataFrame({"sequence_id": run[:, 3] + rank.to_numpy() - run[:, 1], "offset": run[:, 4]})

    return find


def pack_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str | None = None) -> DataFrame:
    """Tokenise, cut and pack whole documents; the pieces are stored once between the two steps."""
    pieces = token_pieces(docs, id_col, text_col, vocabulary)
    return pack(stored(pieces, "token-pieces"))

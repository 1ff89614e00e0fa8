"""Operator 2: n-gram Jaccard self-join by the chosen-path method.

Documents are sets of hashed shingles of five words (lower case, ASCII
punctuation read as space). Texts with equal words are one *node* and are never compared.

1. Each node gets a sketch of ``COORDS`` minimum hashes: a set of that many
   tokens (coordinate, value), of which two sets share about their Jaccard part.
   Only the low ``SKETCH_BITS`` of a value travel (b-bit minwise hashing): equal
   values stay equal, and unequal ones meet by chance once in 256.
2. Chosen paths: the root samples ``ROOTS`` coordinates and puts every node into
   the bucket of its whole token at each; the runs of the method are these independent
   samples. A bucket that is too large samples ``FAN`` more coordinates, the same
   for all its nodes, and splits again. Two sets of similarity s meet in a given
   run with probability p = 1 - (1 - s p)^FAN or more, 0.94 at s = 0.8, so all
   runs miss such a pair with probability (1 - 0.8 * 0.94)^ROOTS, about 1e-6.
3. Small buckets are compared by brute force on the sketches, with a threshold
   five deviations below 0.8 (missed at 0.8: 3e-7). A bucket that keeps at least ``DENSE``
   of its parent's nodes holds mostly similar sets, which no path takes apart: its sketches
   are compared in blocks of pairs of parts. Texts that share less, a common
   passage say, are split on until they stand apart.
4. Only nodes whose sketches agree are joined to candidates. Their connected components are
   compared exactly on whole shingle sets, in blocks, where every pair of a component meets
   once. Only each node's link count and one edge per node leave a block, never the pairs.
5. Audit: the links of a sample of rows are found by comparing them with every text, in the pass that makes
   the sketches. Runs are repeated with other samples until the recall of
   these links reaches ``TARGET``.

Links are exact pairs with Jaccard >= 0.8; a class is a connected component of links.
"""

from __future__ import annotations

import hashlib
import logging
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotwise.llm.common import bounded_batches, free_names, quoted, runs_of, stored
from slotwise.llm.graph import components, copies_of, linked_rows

WORDS = 5
THRESHOLD = 0.8
COORDS = 128
SKETCH_BITS = 8
ROOTS = 10
FAN = 2
LEAF = 128
DENSE = 0.75
#: Levels of paths; buckets that are still large then are compared in blocks, like dense ones.
LEVELS = 40
#: Sketch share below which a pair is not a candidate: 0.8 less five deviations of a mean of 128.
MAYBE = THRESHOLD - 5 * (THRESHOLD * (1 - THRESHOLD) / COORDS) ** 0.5
#: Nodes of a part of a dense bucket, nodes and shingles of a block in the exact comparison (sizes of work, not limits).
PART_NODES, BLOCK_NODES, BLOCK_SHINGLES = 2000, 400, 400_000
#: Recall wanted, rounds of runs at most, rows that are audited (about), and their shingles (at most).
TARGET, ROUNDS = 0.95, 4
AUDIT_ROWS, AUDIT_SHINGLES = 1000, 400_000
#: Coordinates that make a root bucket of the later rounds, as sketches hold 8 bits of each.
ROOT_WIDTH = 4
#: Most candidate nodes that are broadcast to fetch their texts (8 MB).
BROADCAST_MEMBERS = 200_000
CACHE_WORDS = 300_000

_SPACED = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))
_MASK = (1 << 64) - 1


def words_of(text: str | None) -> list[bytes]:
    return (text or "").lower().encode("utf-8").translate(_SPACED).split()


class WordCodes(dict):
    """``word -> 64-bit hash``, remembered."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        code = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
        if len(word) <= 64:
            self[word] = code
        return code


_CODES = WordCodes()


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit integers (xor-shifts and odd multipliers)."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x7FB5D329728EA185)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def shingles(words: list[bytes]) -> np.ndarray:
    """Sorted distinct hashes of all runs of ``WORDS`` words; fewer words make one run, none an empty set."""
    if not words:
        return np.zeros(0, np.uint64)
    codes = np.fromiter(map(_CODES.__getitem__, words), np.uint64, len(words))
    n = max(len(words) - WORDS + 1, 1)
    h = np.full(n, len(words) if len(words) < WORDS else 0, np.uint64)
    for i in range(min(WORDS, len(words))):
        h = mix(h + codes[i : i + n])
    return np.unique(h)


_RANDOM = np.random.default_rng(20240229)
_MULTIPLY = _RANDOM.integers(1, 1 << 63, COORDS, np.uint64) * np.uint64(2) + np.uint64(1)


#: Coordinates that the runs sample at the root, distinct for the runs.
_ROOT_COORDS = (np.arange(ROOTS) * COORDS) // ROOTS


def sketch(sets: np.ndarray) -> np.ndarray:
    """``COORDS`` minimum hashes (upper halves of multiplied, scrambled shingles)."""
    out = np.full(COORDS, 0xFFFFFFFF, np.uint64)
    for at in range(0, len(sets), 2048):
        part = sets[at : at + 2048]
        out = np.minimum(out, ((part[None, :] * _MULTIPLY[:, None]) >> np.uint64(32)).min(1))
    return out.astype("<u4")


def _root_buckets(minima: np.ndarray) -> np.ndarray:
    """The node's bucket in every run, from the whole values at the root coordinates."""
    run = mix(np.arange(1000, 1000 + ROOTS, dtype=np.uint64))
    return mix(run ^ mix(minima[_ROOT_COORDS].astype(np.uint64) + _ROOT_COORDS.astype(np.uint64) * np.uint64(1 << 33))).view(np.int64)


def node_of(words: list[bytes]) -> int | None:
    """The text's words as a signed 64-bit hash; null without words."""
    if not words:
        return None
    return int.from_bytes(hashlib.blake2b(b" ".join(words), digest_size=8).digest(), "little", signed=True)


@dataclass(frozen=True)
class Audit:
    """A sample of rows with their shingles, inverted: ``values`` sorted, their owners from ``start`` on."""

    ids: list[int]
    nodes: np.ndarray
    sizes: np.ndarray
    values: np.ndarray
    start: np.ndarray
    owners: np.ndarray

    def linked(self, found: np.ndarray) -> np.ndarray:
        """Sampled rows whose sets link with ``found`` (equal sets too)."""
        at = np.searchsorted(self.values, found)
        at = at[at < len(self.values)] if len(self.values) else at[:0]
        at = at[self.values[at] == found[: len(at)]]
        if not len(at):
            return at
        owners = np.concatenate([self.owners[a:b] for a, b in zip(self.start[at], self.start[at + 1])])
        common = np.bincount(owners, minlength=len(self.ids))
        return np.flatnonzero((common > 0) & (common >= THRESHOLD * (self.sizes + len(found) - common) - 1e-9))


def audit_of(rows: list[tuple[int, str | None]]) -> Audit:
    """The audit of rows ``(id, text)`` of distinct ids, as many as ``AUDIT_SHINGLES`` allow; texts without words are left out."""
    ids, nodes, sets, total = [], [], [], 0
    for id_, text in rows:
        words = words_of(text)
        found = shingles(words)
        if len(found) and total + len(found) <= AUDIT_SHINGLES:
            total += len(found)
            ids.append(id_)
            nodes.append(node_of(words))
            sets.append(found)
    sizes = np.array([len(x) for x in sets], dtype=np.int64)
    every = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
    order = np.argsort(every, kind="stable")
    values, start = np.unique(every[order], return_index=True)
    owners = np.repeat(np.arange(len(sets)), sizes)[order]
    return Audit(ids, np.array(nodes, dtype=np.int64), sizes, values, np.append(start, len(every)), owners)


def _sampled(texts: DataFrame) -> list[tuple[int, str | None]]:
    """About ``AUDIT_ROWS`` rows of lowest id hash, whose ids do not repeat; their number does not grow with the table."""
    n = texts.count()
    lowest = F.pmod(F.xxhash64("id"), F.lit(1 << 40)) < int(min(1.0, AUDIT_ROWS / max(n, 1)) * (1 << 40))
    each = texts.where("id is not null").where(lowest).groupBy("id").agg(F.count(F.lit(1)).alias("n"), F.first("text").alias("text"))
    rows = each.where("n = 1").select("id", F.xxhash64("id").alias("h"), "text").collect()
    return [(r["id"], r["text"]) for r in sorted(rows, key=lambda r: (r["h"], r["id"]))]


def _signatures(docs: DataFrame, audit: Audit) -> DataFrame:
    """``id, node, n_shingles, sketch, roots, audited`` of every row; ``node`` null without words or without an id.

    ``audited`` lists the audit's rows that link with this one, null without any.
    """

    def run(batches):
        for batch in batches:
            rows = [], [], [], [], [], []
            for i in range(batch.num_rows):
                words = words_of(batch.column(1)[i].as_py())
                id_ = batch.column(0)[i].as_py()
                node = None if id_ is None else node_of(words)
                values = id_, node, 0, None, None, None
                if node is not None:
                    found = shingles(words)
                    minima = sketch(found)
                    links = audit.linked(found)
                    values = id_, node, len(found), minima.astype("<u1").tobytes(), _root_buckets(minima), links.tolist() or None
                for column, value in zip(rows, values):
                    column.append(value)
            types = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int32()))
            yield pa.record_batch(
                [pa.array(c, t) for c, t in zip(rows, types)], names=["id", "node", "n_shingles", "sketch", "roots", "audited"]
            )

    return docs.mapInArrow(run, "id long, node long, n_shingles long, sketch binary, roots array<long>, audited array<int>")


def _later_roots(nodes: DataFrame, round_: int) -> DataFrame:
    """``node, sketch, roots`` for a further round: root buckets of ``ROOT_WIDTH`` sampled coordinates each."""
    chosen = np.random.default_rng(1000 + round_).integers(0, COORDS, (ROOTS, ROOT_WIDTH))

    def run(batches):
        for batch in batches:
            n = batch.num_rows
            table = np.frombuffer(b"".join(batch.column(1).to_pylist()), "<u1").reshape(n, COORDS)
            out = np.empty((n, ROOTS), np.int64)
            for r in range(ROOTS):
                code = np.full(n, round_ * 1000 + r, np.uint64)
                for c in chosen[r]:
                    code = mix(code * np.uint64(257) + table[:, c].astype(np.uint64))
                out[:, r] = code.view(np.int64)
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(list(out), pa.list_(pa.int64()))], names=["node", "sketch", "roots"])

    return nodes.select("node", "sketch").mapInArrow(run, "node long, sketch binary, roots array<long>")


def _buckets(rows: DataFrame) -> DataFrame:
    """``bucket, node, within`` one level further down the paths.

    Input ``bucket, node, within, sketch``: the bucket's hash chooses the
    coordinates, so all its nodes choose alike. ``within`` is the size of the
    bucket that is split.
    """

    def run(batches):
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            bucket = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            table = np.frombuffer(b"".join(batch.column(3).to_pylist()), "<u1").reshape(n, COORDS)
            out = []
            for p in range(FAN):
                coord = (mix(bucket + np.uint64(p + 1)) % np.uint64(COORDS)).astype(np.int64)
                value = table[np.arange(n), coord].astype(np.uint64)
                out.append(mix(mix(bucket + np.uint64(1000 + p)) ^ mix(value + coord.astype(np.uint64) * np.uint64(1 << 33))).view(np.int64))
            node = batch.column(1).to_numpy(zero_copy_only=False)
            within = batch.column(2).to_numpy(zero_copy_only=False)
            columns = [np.concatenate(out), np.tile(node, FAN), np.tile(within, FAN)]
            yield pa.record_batch([pa.array(c, pa.int64()) for c in columns], names=["bucket", "node", "within"])

    return rows.select("bucket", "node", "within", "sketch").mapInArrow(run, "bucket long, node long, within long")


def _leaf_edges(leaves: DataFrame) -> DataFrame:
    """Candidate edges ``a, b`` of small buckets (``leaf, node, sketch``): a spanning forest of similar sketches."""

    def run(batches):
        for _, nodes, sketches in runs_of(batches, 1):
            table = np.frombuffer(b"".join(sketches), "<u1").reshape(len(nodes), COORDS)
            a, b = forest(len(nodes), lambda i: (table[i + 1 :] == table[i]).mean(1) >= MAYBE)
            if a:
                ids = np.array(nodes)
                yield pa.record_batch([pa.array(ids[a]), pa.array(ids[b])], names=["a", "b"])

    ordered = leaves.repartition("leaf").sortWithinPartitions("leaf").select("leaf", "node", "sketch")
    return ordered.mapInArrow(run, "a long, b long")


def forest(n: int, row) -> tuple[list[int], list[int]]:
    """Edges that span the graph whose row ``i`` marks the neighbours behind ``i``; at most ``n - 1``."""
    root = np.arange(n)
    a, b = [], []
    for i in range(n - 1):
        others = np.flatnonzero(row(i)) + i + 1
        while len(others := others[root[others] != root[i]]):
            j = int(others[0])
            a.append(i)
            b.append(j)
            root[root == root[j]] = root[i]
    return a, b


def _dense_edges(rows: DataFrame) -> DataFrame:
    """Candidate edges ``a, b`` of large buckets (``bucket, node, size, sketch``): sketches compared part by part.

    Nodes are dealt to parts of about ``PART_NODES``; each pair of parts is one group, so a
    bucket of any size is spread over tasks.
    """

    def run(batches):
        for _, x, y, nodes, part, sketches in runs_of(batches, 3):
            table = np.frombuffer(b"".join(sketches), "<u1").reshape(len(nodes), COORDS)
            side, across = np.array(part), x[0] != y[0]

            def row(i):
                near = (table[i + 1 :] == table[i]).mean(1) >= MAYBE
                return near & (side[i + 1 :] != side[i]) if across else near

            a, b = forest(len(nodes), row)
            if a:
                ids = np.array(nodes)
                yield pa.record_batch([pa.array(ids[a]), pa.array(ids[b])], names=["a", "b"])

    parts = F.ceil(F.col("size") / F.lit(PART_NODES))
    dealt = rows.withColumn("part", F.pmod(F.xxhash64("node"), parts))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1)))
    dealt = dealt.withColumns({"x": F.least("part", "other"), "y": F.greatest("part", "other")})
    ordered = dealt.repartition("bucket", "x", "y").sortWithinPartitions("bucket", "x", "y")
    return ordered.select("bucket", "x", "y", "node", "part", "sketch").mapInArrow(run, "a long, b long")


def candidates(nodes: DataFrame) -> DataFrame:
    """Candidate edges ``a, b`` among ``node, sketch, roots``: the chosen paths down to small or dense buckets.

    Each level is stored with its bucket sizes; small and dense buckets fetch their
    sketches once, after the last level.
    """
    total = nodes.count()
    made = nodes.select(F.explode("roots").alias("bucket"), "node", F.lit(total).cast("long").alias("within"))
    nodes = nodes.select("node", "sketch")
    small, thick = [], []
    for level in range(LEVELS):
        sizes = made.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
        level_rows = stored(made.join(sizes, "bucket"), f"jaccard-level{level}")
        if not level:  # from here on only nodes that share a bucket matter, so only their sketches move again
            nodes = stored(nodes.join(level_rows.select("node").distinct(), "node"), "jaccard-live")
        # buckets over LEAF nodes that lost few: their nodes stay together
        dense = (F.col("size") >= F.lit(DENSE) * F.col("within")) if level < LEVELS - 1 else F.lit(True)
        small.append(level_rows.where(F.col("size") <= LEAF).groupBy("bucket").agg(F.sort_array(F.collect_set("node")).alias("nodes")).select("nodes"))
        thick.append(level_rows.where((F.col("size") > LEAF) & dense).select("bucket", "node", "size"))
        large = level_rows.where((F.col("size") > LEAF) & ~dense)
        if large.isEmpty():
            break
        rows = large.select("bucket", "node", F.col("size").alias("within")).join(nodes, "node")
        made = stored(_buckets(rows), f"jaccard-split{level}")
    lists, rest = small[0], thick[0]
    for more in small[1:]:
        lists = lists.union(more)  # lists are at most LEAF long
    for more in thick[1:]:
        rest = rest.union(more)
    lists = lists.distinct().select(F.xxhash64("nodes").alias("leaf"), "nodes")
    leaves = lists.select("leaf", F.explode("nodes").alias("node")).join(nodes, "node")
    return stored(_leaf_edges(leaves).union(_dense_edges(rest.join(nodes, "node"))), "jaccard-edges")


def _sets(texts: DataFrame) -> DataFrame:
    """``node, component, blocks, weight, sets`` of candidate rows ``id, text, node, component, blocks, weight``."""

    def run(batches):
        for batch in batches:
            out = [], [], [], [], []
            for i in range(batch.num_rows):
                words = words_of(batch.column(1)[i].as_py())
                node = batch.column(2)[i].as_py()
                if node_of(words) != node:  # another text under the same id
                    continue
                values = (node, *(batch.column(k)[i].as_py() for k in (3, 4, 5)), shingles(words).tobytes())
                for column, value in zip(out, values):
                    column.append(value)
            types = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
            yield pa.record_batch([pa.array(c, t) for c, t in zip(out, types)], names=["node", "component", "blocks", "weight", "sets"])

    return texts.mapInArrow(run, "node long, component long, blocks long, weight long, sets binary")


def intersections(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all pairwise intersections, by products of slices of the membership matrix."""
    n = len(sets)
    if n == 2:
        common = len(np.intersect1d(sets[0], sets[1], assume_unique=True))
        return np.array([[len(sets[0]), common], [common, len(sets[1])]])
    every, inverse, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(n), [len(s) for s in sets])
    shared = counts > 1  # a shingle of one set alone is in no intersection
    number = np.cumsum(shared) - 1
    use = shared[inverse]
    column, owner = number[inverse[use]], owner[use]
    order = np.argsort(column, kind="stable")
    column, owner = column[order], owner[order]
    out = np.zeros((n, n), np.float64)
    width = max(1, (1 << 22) // n)
    for at in range(0, int(shared.sum()), width):
        a, b = np.searchsorted(column, (at, at + width))
        part = np.zeros((n, width), np.float32)
        part[owner[a:b], column[a:b] - at] = 1
        out += part @ part.T
    return out


def _block_links(pairs: DataFrame) -> DataFrame:
    """Exact links within blocks: ``node, links, a`` (weighted count, and a node that spans its links).

    Rows ``component, x, y, node, block, weight, sets``; with x < y only pairs
    across the two blocks count, as those within have their own group x = y.
    """

    def run(batches):
        for component, x, y, nodes, block, weight, packed in runs_of(batches, 3):
            if len(nodes) < 2:
                continue
            sets = [np.frombuffer(s, "<u8") for s in packed]
            size = np.array([len(s) for s in sets], float)
            common = intersections(sets)
            linked = common >= THRESHOLD * (size[:, None] + size[None, :] - common) - 1e-9
            np.fill_diagonal(linked, False)
            side = np.array(block)
            if x[0] != y[0]:
                linked &= side[:, None] != side[None, :]
            counts = linked @ np.array(weight, np.int64)
            a, b = forest(len(nodes), lambda i: linked[i, i + 1 :])
            ids = np.array(nodes)
            columns = [np.concatenate([ids, ids[b]]) if b else ids, np.concatenate([counts, np.zeros(len(b), np.int64)]), np.concatenate([ids, ids[a]]) if a else ids]
            yield pa.record_batch([pa.array(c, pa.int64()) for c in columns], names=["node", "links", "a"])

    ordered = pairs.repartition("component", "x", "y").sortWithinPartitions("component", "x", "y")
    return ordered.select("component", "x", "y", "node", "block", "weight", "sets").mapInArrow(run, "node long, links long, a long")


def jaccard_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row: id, ``class_id`` (smallest id of its class), ``n_links`` and ``kept`` (id = class_id).

    ``n_links`` counts the other rows linked directly, copies of the same words
    included. Texts without a word (null, empty, punctuation) and rows with a
    null id link with nothing; a text of fewer than five words is one shingle.
    Rows that repeat an id are one document, so their texts share a class. Other
    columns are ignored; an empty table gives an empty one. The recall that the audit measured is logged.
    """
    bounded_batches(docs.sparkSession)
    texts = docs.select(quoted(id_col).cast("long").alias("id"), quoted(text_col).alias("text"))
    audit = audit_of(_sampled(texts))
    seen = stored(_signatures(texts, audit), "jaccard-signatures")
    nodes = seen.where("node is not null").select("node", "sketch", "roots").dropDuplicates(["node"])  # equal nodes, equal sketches
    nodes = stored(nodes, "jaccard-nodes")
    edges = candidates(nodes)
    for round_ in range(1, ROUNDS + 1):
        found = stored(_linked(texts, seen, edges), "jaccard-linked")
        recall, n = _recall(seen, found, audit)
        logging.getLogger(__name__).info("round %d: recall %.4f of %d audited rows with links", round_, recall, n)
        if recall >= TARGET or round_ == ROUNDS:
            break
        edges = edges.union(candidates(_later_roots(nodes, round_)))
    return found.select(F.col("id").alias(id_col), "class_id", "n_links", (F.col("class_id") == F.col("id")).alias("kept"))


def _recall(seen: DataFrame, found: DataFrame, audit: Audit) -> tuple[float, int]:
    """Mean share of their links to other texts that the audited rows have in ``found``, and how many have any."""
    if not audit.ids:
        return 1.0, 0
    spark = seen.sparkSession
    # one row per audited row and kind of link reaches the driver
    hits = seen.where("audited is not null").select("node", F.explode("audited").alias("i"))
    own = spark.createDataFrame([(i, id_, int(node)) for i, (id_, node) in enumerate(zip(audit.ids, audit.nodes))], "i int, id long, own long")
    true = hits.join(F.broadcast(own), "i").groupBy("i", "id").agg(F.count(F.lit(1)).alias("every"), F.count_if(F.col("node") != F.col("own")).alias("others"))
    got = true.where("others > 0").join(found.select("id", "n_links"), "id").select("every", "others", "n_links").collect()
    shares = [1 - max(r["every"] - 1 - r["n_links"], 0) / r["others"] for r in got]
    return (sum(shares) / len(shares), len(shares)) if shares else (1.0, 0)


def _linked(texts: DataFrame, seen: DataFrame, edges: DataFrame) -> DataFrame:
    """``id, node, class_id, n_links`` of every row, from candidate edges, by exact comparison."""
    known, copies = seen.where("node is not null"), copies_of(seen)
    near = components(edges, "jaccard-candidates").withColumnRenamed("id", "node")
    sizes = known.select("node", "n_shingles").dropDuplicates(["node"])
    member = near.join(copies, "node").join(sizes, "node")
    load = member.groupBy("component").agg(F.count(F.lit(1)).alias("n"), F.sum("n_shingles").alias("s"))
    blocks = F.greatest(F.ceil(F.col("n") / F.lit(BLOCK_NODES)), F.ceil(F.col("s") / F.lit(BLOCK_SHINGLES)))
    member = stored(member.join(load.select("component", blocks.alias("blocks")), "component"), "jaccard-members")
    wanted = member.select("id", "node", "component", "blocks", "weight")
    if member.count() <= BROADCAST_MEMBERS:  # five numbers a row; with more, texts are joined by a shuffle
        wanted = F.broadcast(wanted)
    rows = texts.join(wanted, "id")
    sets = _sets(rows.select("id", "text", "node", "component", "blocks", "weight")).dropDuplicates(["node"])
    block = F.pmod(F.xxhash64("node"), F.col("blocks"))
    paired = sets.withColumn("block", block).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    paired = paired.withColumns({"x": F.least("block", "other"), "y": F.greatest("block", "other")})
    links = stored(_block_links(paired), "jaccard-links")
    edges = links.where("node <> a").select("a", F.col("node").alias("b"))
    return linked_rows(seen.select("id", "node"), links, edges, "jaccard-classes")


def keep_one_per_class(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose id names its class; rows equal in all columns stay once.

    Rows with a null id stay. All columns stay as they are.
    """
    (name,) = free_names(docs, "gone")
    gone = jaccard_classes(docs, id_col, text_col).where("not kept").select(quoted(id_col).alias(name)).distinct()
    kept = docs.join(gone, quoted(id_col) == F.col(name), "left_anti")
    return kept.dropDuplicates()

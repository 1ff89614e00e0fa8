"""Operator 1: near-duplicate vectors of equal label by NN-descent.

Equal vectors of one label are one *node*. Every node keeps a list of its nearest
neighbours so far.

1. Start: random hyperplanes put the nodes of a label into buckets, so many times
   that two nodes at ``LINK`` share one with probability ``MEET`` at every size;
   inside a bucket every node takes its nearest others.
2. Refine: a node's *locals* are the nodes on its list and a sample of those that
   list it. All locals of a node are neighbours of neighbours; each learns of the
   others that beat the end of its own list. Rounds go on until few lists change.
3. Enlarge: a list that is full of links (cosine >= ``LINK`` to its very end) may hide
   more, so its capacity doubles, up to ``MOST``.
4. Lists that hold nothing but links when the rounds end belong to dense nodes. Links between two
   dense nodes are found exactly, in blocks of all dense nodes of a label; a link
   with any other node is on that node's list.
5. Audit: a sample of nodes outside the dense set is compared with all nodes of its
   label, and every one that has links weighs the same. If the mean share of a
   node's links that was found is below ``RECALL``, the search starts again from
   other hyperplanes and keeps the lists it has; a sample with fewer than
   ``AUDIT_LINKED`` linked nodes says little, so two starts are made then. If
   ``ATTEMPTS`` starts do not reach ``RECALL``, all nodes are linked exactly, in
   blocks (quadratic in the nodes of a label).

Lists are searched in single precision; links are decided in double precision.
"""

from __future__ import annotations

import hashlib
import logging
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from slotwise.llm.common import quoted, runs_of, stored
from slotwise.llm.graph import copies_of, linked_rows

LINK = 0.93
FIRST, MOST = 8, 64
BACK = 8  # how many of those that list a node are sampled as locals in a round
MEET, BUCKET, SPLIT = 0.99, 32, 512
ROUNDS = 8
SETTLED = 0.01  # rounds end when fewer than this share of lists changed and none was enlarged
DENSE_BLOCK = 512
AUDIT_NODES, AUDIT_MOST, AUDIT_LINKED = 500, 4000, 100  # sampled at first, at most, and linked ones wanted among them
RECALL, ATTEMPTS = 0.99, 3
SLACK = 1e-5  # single precision may be off by less

LISTS = "node long, near array<long>, sims array<float>, room int, changed boolean"


def _nodes(vectors: DataFrame) -> DataFrame:
    """``id, label, node, dim, unit`` per row; ``node`` null where the vector or label links with nothing."""

    def run(batches):
        for batch in batches:
            out = [], [], [], [], []
            for id_, vector, label in zip(*(batch.column(i).to_pylist() for i in range(3))):
                node = unit = None
                x = np.array(vector, float) if vector and None not in vector else np.zeros(1)
                norm = float(np.linalg.norm(x / m)) * m if (m := float(np.abs(x).max())) and np.isfinite(x).all() else 0.0
                if norm and id_ is not None and label is not None:
                    unit = ((x / m) / np.linalg.norm(x / m) + 0.0).astype("<f8").tobytes()
                    node = int.from_bytes(hashlib.blake2b(f"{label}:".encode() + unit, digest_size=8).digest(), "little", signed=True)
                for column, value in zip(out, (id_, label, node, len(x), unit)):
                    column.append(value)
            types = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.binary())
            yield pa.record_batch([pa.array(c, t) for c, t in zip(out, types)], names=["id", "label", "node", "dim", "unit"])

    return vectors.mapInArrow(run, "id long, label string, node long, dim long, unit binary")


def _matrix(units: list[bytes], kind=np.float32) -> np.ndarray:
    return np.frombuffer(b"".join(units), "<f8").reshape(len(units), -1).astype(kind)


def tables(bits: int) -> int:
    """How many times nodes are put into buckets of ``bits`` hyperplanes, for two at ``LINK`` to meet with probability ``MEET``."""
    together = (1 - math.acos(LINK) / math.pi) ** bits
    return 1 if together >= MEET else math.ceil(math.log(1 - MEET) / math.log(1 - together))


def _hyperplanes(nodes: DataFrame, sizes: DataFrame, seed: int) -> DataFrame:
    """``bucket, node, unit``: every node in ``tables`` buckets of about ``BUCKET`` nodes of its label."""

    def run(batches):
        planes: dict[tuple, np.ndarray] = {}
        for batch in batches:
            nodes_, units, dims, bits, spaces = (batch.column(i).to_pylist() for i in range(5))
            buckets, owners = [], []
            for i, (node, unit, dim, b, space) in enumerate(zip(nodes_, units, dims, bits, spaces)):
                if (dim, b) not in planes:
                    planes[dim, b] = np.random.default_rng([seed, dim, b]).standard_normal((tables(b), b, dim))
                signs = planes[dim, b] @ np.frombuffer(unit, "<f8") > 0
                for t in range(len(signs)):
                    code = int("1" + "".join("01"[int(s)] for s in signs[t]), 2)
                    buckets.append(hash((space, t, code)) & (1 << 63) - 1)
                    owners.append(i)
            columns = [pa.array(buckets, pa.int64()), pa.array([nodes_[i] for i in owners], pa.int64()), pa.array([units[i] for i in owners], pa.binary())]
            yield pa.record_batch(columns, names=["bucket", "node", "unit"])

    bits = F.least(F.greatest(F.ceil(F.log2(F.col("n") / F.lit(BUCKET))), F.lit(0)), F.lit(40)).cast("int")
    rows = nodes.join(sizes, ["label", "dim"]).select("node", "unit", "dim", bits.alias("bits"), F.xxhash64("label", "dim").alias("space"))
    placed = rows.mapInArrow(run, "bucket long, node long, unit binary")
    placed = stored(placed, "vectors-buckets")
    # a crowded bucket is dealt into parts; the rounds find what that separates
    parts = placed.groupBy("bucket").agg(F.ceil(F.count(F.lit(1)) / F.lit(SPLIT)).cast("int").alias("parts"))
    split = placed.join(parts, "bucket").withColumn("part", F.pmod(F.xxhash64("node", "bucket"), F.col("parts")).cast("int"))
    return split.repartition("bucket", "part").sortWithinPartitions("bucket", "part").select("bucket", "part", "node", "unit")


def _best(ids: np.ndarray, sims: np.ndarray, room: int, floor: float) -> tuple[np.ndarray, np.ndarray]:
    """The ``room`` nearest above ``floor``, nearest first, ties to the smaller id."""
    use = np.flatnonzero(sims > floor)
    use = use[np.lexsort((ids[use], -sims[use]))][:room]
    return ids[use], sims[use]


def _learned(rows: list[tuple]) -> pa.RecordBatch:
    names = ["node", "near", "sims", "room", "changed"]
    types = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.float32()), pa.int32(), pa.bool_()]
    return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)


def _start(buckets: DataFrame) -> DataFrame:
    """Lists from the buckets: offers ``node, near, sims`` with ``room`` ``FIRST``."""

    def run(batches):
        rows = []
        for _, _, nodes, units in runs_of(batches, 2):
            if len(nodes) < 2:
                continue
            ids, m = np.array(nodes), _matrix(units)
            sims = m @ m.T
            np.fill_diagonal(sims, -2)
            for i, node in enumerate(nodes):
                near, best = _best(ids, sims[i], FIRST, -1.5)
                rows.append((node, near, best, FIRST, True))
            if len(rows) > 5000:
                yield _learned(rows)
                rows = []
        if rows:
            yield _learned(rows)

    return buckets.mapInArrow(run, LISTS)


def _merge(offers: DataFrame) -> DataFrame:
    """One list per node out of its old list (``changed`` false) and all offers; enlarges lists full of links."""

    def run(batches):
        rows = []
        for nodes, nears, sims, rooms, news in runs_of(batches, 1):
            ids, values = np.concatenate(nears), np.concatenate(sims)
            ids, first = np.unique(ids, return_index=True)
            room = max(rooms)
            near, best = _best(ids, values[first], room, -1.5)
            old = next((n for n, new in zip(nears, news) if not new), None)
            changed = old is None or set(old) != set(near.tolist())
            if len(near) == room and best[-1] >= LINK - SLACK and room < MOST:
                room, changed = 2 * room, True
            rows.append((nodes[0], near, best, room, changed))
            if len(rows) > 5000:
                yield _learned(rows)
                rows = []
        if rows:
            yield _learned(rows)

    return offers.repartition("node").sortWithinPartitions("node").mapInArrow(run, LISTS)


def _refine(lists: DataFrame, nodes: DataFrame, step: int) -> DataFrame:
    """Offers from one round of neighbours-of-neighbours joins around every centre with something new."""
    forward = lists.select(F.col("node").alias("centre"), F.explode("near").alias("member"), "changed")
    order = W.partitionBy("centre").orderBy(F.xxhash64("member", F.lit(step)), "member")
    back = forward.select(F.col("member").alias("centre"), F.col("centre").alias("member"), "changed")
    back = back.withColumn("n", F.row_number().over(order)).where(F.col("n") <= BACK).drop("n")
    own = lists.select(F.col("node").alias("centre"), F.col("node").alias("member"), "changed")
    locals_ = forward.union(back).union(own).groupBy("centre", "member").agg(F.max("changed").alias("changed"))
    ends = lists.select(
        F.col("node").alias("member"),
        "room",
        F.when(F.size("near") < F.col("room"), F.lit(-1.5)).otherwise(F.array_min("sims")).alias("floor"),
    )
    rows = locals_.join(ends, "member").join(nodes.select(F.col("node").alias("member"), "unit"), "member")

    def run(batches):
        out = []
        for _, members, changed, rooms, floors, units in runs_of(batches, 1):
            if not any(changed) or len(members) < 2:
                continue
            ids, m, new = np.array(members), _matrix(units), np.array(changed)
            sims = m @ m.T
            np.fill_diagonal(sims, -2)
            for i, node in enumerate(members):
                row = sims[i] if new[i] else np.where(new, sims[i], -2)
                near, best = _best(ids, row, rooms[i], floors[i])
                if len(near):
                    out.append((node, near, best, rooms[i], True))
            if len(out) > 5000:
                yield _learned(out)
                out = []
        if out:
            yield _learned(out)

    grouped = rows.repartition("centre").sortWithinPartitions("centre")
    return grouped.select("centre", "member", "changed", "room", "floor", "unit").mapInArrow(run, LISTS)


def neighbour_lists(nodes: DataFrame, sizes: DataFrame, seed: int, known: DataFrame | None) -> DataFrame:
    """The refined lists of all nodes that share a label with another."""
    offers = _start(_hyperplanes(nodes, sizes, seed))
    if known is not None:
        offers = offers.union(known.withColumn("changed", F.lit(False)))
    lists = stored(_merge(offers), "vectors-lists")
    for step in range(ROUNDS):
        n, moved = lists.agg(F.count(F.lit(1)), F.count_if("changed")).first()
        if moved <= SETTLED * n:
            break
        offers = _refine(lists, nodes, step).union(lists.withColumn("changed", F.lit(False)))
        lists = stored(_merge(offers), "vectors-lists")
    return lists


def _listed_links(lists: DataFrame, nodes: DataFrame, dense: DataFrame) -> DataFrame:
    """Links ``a, b`` (a < b) on lists, decided in double precision, except between two dense nodes."""
    shown = lists.select("node", F.explode(F.arrays_zip("near", "sims")).alias("x")).where(F.col("x.sims") >= LINK - SLACK)
    pairs = shown.select(F.least("node", "x.near").alias("a"), F.greatest("node", "x.near").alias("b")).distinct()
    heavy = dense.select(F.col("node").alias("h"), F.lit(True).alias("heavy"))
    pairs = pairs.join(heavy.select(F.col("h").alias("a"), F.col("heavy").alias("ha")), "a", "left")
    pairs = pairs.join(heavy.select(F.col("h").alias("b"), F.col("heavy").alias("hb")), "b", "left").where("ha is null or hb is null")
    unit = nodes.select(F.col("node").alias("n"), "unit")
    pairs = pairs.select("a", "b").join(unit.select(F.col("n").alias("a"), F.col("unit").alias("ua")), "a")
    pairs = pairs.join(unit.select(F.col("n").alias("b"), F.col("unit").alias("ub")), "b").select("a", "b", "ua", "ub")

    def run(batches):
        for batch in batches:
            a, b, ua, ub = (batch.column(i).to_pylist() for i in range(4))
            keep = [i for i in range(len(a)) if np.frombuffer(ua[i], "<f8") @ np.frombuffer(ub[i], "<f8") >= LINK]
            yield pa.record_batch([pa.array([c[i] for i in keep], pa.int64()) for c in (a, b)], names=["a", "b"])

    return pairs.mapInArrow(run, "a long, b long")


def _dense_links(dense: DataFrame) -> DataFrame:
    """``node, links, a`` of links between dense nodes (``label, dim, node, unit, weight``), by blocks.

    Every pair of a label's dense nodes meets in one block pair. Out come weighted
    counts per node and edges that span the links, not the pairs.
    """
    many = dense.groupBy("label", "dim").agg(F.ceil(F.count(F.lit(1)) / F.lit(DENSE_BLOCK)).alias("blocks"))
    rows = dense.join(many, ["label", "dim"]).withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    rows = rows.select(F.xxhash64("label", "dim").alias("space"), F.least("block", "other").alias("x"), F.greatest("block", "other").alias("y"), "node", "block", "weight", "unit")

    def run(batches):
        for _, x, y, nodes, block, weight, units in runs_of(batches, 3):
            m, side = _matrix(units, float), np.array(block)
            linked = m @ m.T >= LINK
            np.fill_diagonal(linked, False)
            if x[0] != y[0]:
                linked &= side[:, None] != side[None, :]
            counts = linked @ np.array(weight, np.int64)
            ids, root = np.array(nodes), np.arange(len(nodes))
            a, b = [], []
            for i in range(len(nodes)):
                fresh = np.unique(root[i + 1 :][linked[i, i + 1 :]])
                for r in fresh[fresh != root[i]]:
                    j = i + 1 + int(np.flatnonzero(linked[i, i + 1 :] & (root[i + 1 :] == r))[0])
                    a.append(i)
                    b.append(j)
                    root[root == r] = root[i]
            columns = [np.concatenate([ids, ids[b]]), np.concatenate([counts, np.zeros(len(b), np.int64)]), np.concatenate([ids, ids[a]])] if b else [ids, counts, ids]
            yield pa.record_batch([pa.array(c, pa.int64()) for c in columns], names=["node", "links", "a"])

    ordered = rows.repartition("space", "x", "y").sortWithinPartitions("space", "x", "y")
    return ordered.mapInArrow(run, "node long, links long, a long")


def _true_degrees(nodes: DataFrame, sample: list) -> dict[int, int]:
    """How many nodes every sampled node links with, each compared with all nodes of its label."""
    spaces: dict = {}
    for r in sample:
        spaces.setdefault((r["label"], r["dim"]), []).append(r)
    known = {k: (np.array([r["node"] for r in v]), _matrix([bytes(r["unit"]) for r in v], float)) for k, v in spaces.items()}

    def run(batches):
        for batch in batches:
            out: dict = {}
            groups: dict = {}
            for label, dim, node, unit in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if (label, dim) in known:
                    groups.setdefault((label, dim), ([], []))
                    for column, value in zip(groups[label, dim], (node, unit)):
                        column.append(value)
            for key, (ids, units) in groups.items():
                own, m = known[key]
                for at in range(0, len(ids), DENSE_BLOCK):
                    part = slice(at, at + DENSE_BLOCK)
                    linked = (_matrix(units[part], float) @ m.T >= LINK) & (np.array(ids[part])[:, None] != own[None, :])
                    for q, n in zip(own.tolist(), linked.sum(axis=0).tolist()):
                        out[q] = out.get(q, 0) + n
            yield pa.record_batch([pa.array(list(out), pa.int64()), pa.array(list(out.values()), pa.int64())], names=["node", "links"])

    counts = nodes.select("label", "dim", "node", "unit").mapInArrow(run, "node long, links long").groupBy("node").agg(F.sum("links").alias("links"))
    return {r["node"]: r["links"] for r in counts.where("links > 0").collect()}  # bounded by AUDIT_MOST


def _audit(nodes: DataFrame, dense: DataFrame, both: DataFrame) -> tuple[float, int, bool]:
    """Mean share of its links that a linked node outside the dense set found; the linked nodes sampled; whether they suffice.

    ``both`` holds the found links in both directions. Without a linked node in the sample the share is 1.
    """
    rest = nodes.join(dense.select("node"), "node", "left_anti")
    for size in (AUDIT_NODES, AUDIT_MOST):
        sample = rest.select("label", "dim", "node", "unit").orderBy(F.xxhash64("node"), "node").limit(size).collect()
        truth = _true_degrees(nodes, sample) if sample else {}
        enough = len(truth) >= AUDIT_LINKED or len(sample) < size
        if enough:
            break
    if not truth:
        return 1.0, 0, enough
    wanted = nodes.sparkSession.createDataFrame(list(truth.items()), "a long, links long")
    found = both.join(F.broadcast(wanted.select("a")), "a").groupBy("a").agg(F.count(F.lit(1)).alias("found"))  # at most AUDIT_MOST nodes
    share = F.coalesce("found", F.lit(0)) / F.col("links")
    return wanted.join(found, "a", "left").agg(F.avg(share)).first()[0], len(truth), enough


def link_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """One row per vector: id, ``n_links``, ``component_id`` and ``kept`` (id = component_id).

    Vectors that are null, empty, zero or hold null or non-finite parts, and rows
    with a null label or id, link with nothing. Vectors of different lengths are
    never compared. Rows that repeat an id are one vector, so their components
    join. Other columns are ignored; an empty table gives an empty one.
    """
    read = vectors.select(quoted(id_col).cast("long").alias("id"), quoted(vector_col).alias("vector"), quoted(label_col).cast("string").alias("label"))
    seen = stored(_nodes(read), "vectors-seen")
    copies = copies_of(seen)
    nodes = seen.where("node is not null").dropDuplicates(["node"]).select("node", "label", "dim", "unit")
    nodes = stored(nodes.join(copies.select("node", "weight"), "node"), "vectors-nodes")
    sizes = nodes.groupBy("label", "dim").agg(F.count(F.lit(1)).alias("n"))
    known = None
    for attempt in range(ATTEMPTS):
        known = neighbour_lists(nodes, sizes, attempt, known)
        full = (F.size("near") >= FIRST) & (F.array_min("sims") >= LINK - SLACK)
        dense = stored(known.where(full).select("node").join(nodes, "node"), "vectors-dense")
        pairs = stored(_listed_links(known, nodes, dense), "vectors-pairs")
        both = pairs.union(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        recall, linked, enough = _audit(nodes, dense, both)
        logging.getLogger(__name__).info("attempt %d: recall %.4f of %d linked nodes in the audit", attempt, recall, linked)
        if recall >= RECALL and (enough or attempt):
            break
    else:
        logging.getLogger(__name__).warning("recall %.4f after %d attempts: all nodes are linked in blocks", recall, ATTEMPTS)
        dense, pairs, both = nodes, pairs.limit(0), both.limit(0)
    thick = stored(_dense_links(dense), "vectors-thick")
    listed = both.join(nodes.select(F.col("node").alias("b"), "weight"), "b").groupBy(F.col("a").alias("node")).agg(F.sum("weight").alias("links"))
    links = stored(listed.union(thick.select("node", "links")), "vectors-links")
    edges = pairs.union(thick.where("node <> a").select("a", F.col("node").alias("b")))
    out = linked_rows(seen.select("id", "node"), links, edges, "vectors-classes")
    return out.select(F.col("id").alias(id_col), "n_links", F.col("class_id").alias("component_id"), (F.col("class_id") == F.col("id")).alias("kept"))

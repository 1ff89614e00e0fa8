"""Connected components of an edge table, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotwise.llm.common import stored


#: A node with more than this share of all edges is a hub; there are at most twice its inverse.
HUB_SHARE = 1 / 1000


def _meet(rows: DataFrame, info: DataFrame, key: str, total: int) -> DataFrame:
    """``rows`` joined with one row ``key, ..., n`` per key; ``n`` is the key's number of rows.

    The rows of hubs are not gathered by their key: hubs are few, whatever the size of
    the table, and go to all tasks; every other key has a bounded share of the rows.
    """
    hub = F.col("n") > HUB_SHARE * total
    hubs = F.broadcast(info.where(hub).drop("n"))
    return rows.join(hubs, key).union(rows.join(hubs.select(key), key, "left_anti").join(info.where(~hub).drop("n"), key))


def components(edges: DataFrame, name: str) -> DataFrame:
    """``id, component`` for every node of ``edges(a, b)``; a component is named by its smallest node.

    Each round links every node's larger neighbours to its smallest neighbour
    (large star), then the smaller ones (small star). Rounds end when nothing
    changes; their number grows with the logarithm of a component's size. Every
    round is a stored table, and only a count and a checksum reach the driver.
    Loops are ignored; an empty table has no components.
    """
    hi, lo = F.greatest("a", "b"), F.least("a", "b")
    now = stored(edges.where("a <> b").select(hi.alias("hi"), lo.alias("lo")).distinct(), f"{name}-edges")
    mark = _mark(now)
    while mark[0]:
        total = 2 * mark[0]
        both = now.select(F.col("hi").alias("u"), F.col("lo").alias("v")).union(now.select(F.col("lo").alias("u"), F.col("hi").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"), F.count(F.lit(1)).alias("n"))
        large = _meet(both.where("v > u"), least, "u", total).select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct()
        large = stored(large, f"{name}-large")
        roots = stored(large.groupBy("hi").agg(F.min("lo").alias("root"), F.count(F.lit(1)).alias("n")), f"{name}-roots")
        small = _meet(large, roots, "hi", total).where("lo > root").select(F.col("lo").alias("hi"), F.col("root").alias("lo"))
        now = stored(small.union(roots.select("hi", F.col("root").alias("lo"))).distinct(), f"{name}-round")
        before, mark = mark, _mark(now)
        if mark == before:
            break
    own = now.select(F.col("lo").alias("id"), F.col("lo").alias("component")).distinct()
    return now.select(F.col("hi").alias("id"), F.col("lo").alias("component")).union(own)


def _mark(edges: DataFrame) -> tuple:
    total = F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))
    return tuple(edges.agg(F.count(F.lit(1)), total).first())


def copies_of(seen: DataFrame) -> DataFrame:
    """``node, id, weight`` of ``seen(id, node)``: the smallest id and the number of rows of every node."""
    return seen.where("node is not null").groupBy("node").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("weight"))


def linked_rows(seen: DataFrame, links: DataFrame, edges: DataFrame, name: str) -> DataFrame:
    """``id, node, class_id, n_links`` for every row of ``seen(id, node)``.

    A node stands for equal contents, so its rows link with each other.
    ``links(node, links)`` counts rows of other nodes, to be added up; ``edges(a, b)``
    span the links between nodes. Nodes that share an id are joined as well. Rows
    without a node are classes of their own.
    """
    known, copies = seen.where("node is not null"), copies_of(seen)
    ids = known.groupBy("id").agg(F.min("node").alias("a"), F.max("node").alias("b")).where("a <> b").select("id", "a")
    same = known.join(ids, "id").where("node <> a").select("a", F.col("node").alias("b"))
    classes = components(edges.select("a", "b").union(same), name).withColumnRenamed("id", "node")
    counts = links.groupBy("node").agg(F.sum("links").alias("links"))
    info = copies.join(counts, "node", "left").join(classes, "node", "left")
    n_links = F.col("weight") - 1 + F.coalesce("links", F.lit(0))
    info = info.select("node", "id", n_links.alias("n_links"), F.coalesce("component", "node").alias("class"), "weight")
    info = stored(info, f"{name}-nodes")
    named = info.groupBy("class").agg(F.min("id").alias("class_id"))
    # nodes of one row without a link need no entry
    info = info.join(named, "class").where("n_links > 0 or class_id <> id or weight > 1").select("node", "n_links", "class_id")
    out = seen.select("id", "node").join(info, "node", "left")
    return out.select("id", "node", F.coalesce("class_id", "id").alias("class_id"), F.coalesce("n_links", F.lit(0)).alias("n_links"))

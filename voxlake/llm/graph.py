"""Connected components by alternating large-star and small-star steps (Kiveris et al., 2014), and pairs by hubs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxlake.llm.common import materialise, small_side


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select("v", "u")).distinct()
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")
    return moved.union(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame, rounds: int = 50) -> DataFrame:
    """(node, component) for every node of an undirected edge table (u, v); component is the least node reachable.

    Each round writes its edges to the shared folder; the loop ends when they are stars: every node points to one node, and
    that one to none.
    """
    now = materialise(edges.filter("u <> v").select("u", "v").distinct(), "edges")
    for _ in range(rounds):
        now = materialise(_small_star(_large_star(now)), "edges")
        ends = now.select(F.col("u").alias("x"), F.lit(1).alias("out"), F.lit(0).alias("back")).union(now.select("v", F.lit(0), F.lit(1)))
        if ends.groupBy("x").agg(F.sum("out").alias("out"), F.max("back").alias("back")).filter("out > 1 OR out = 1 AND back = 1").isEmpty():
            break
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    stars = now.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("component"))
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return stars.union(roots)


def contracted(comp: DataFrame, links: DataFrame) -> DataFrame:
    """comp (node, component, ...) after links (u, v) between its nodes. Only components that a link joins are worked on, so
    the tables shrink from one call to the next."""
    if links.isEmpty():
        return comp
    ends = links.join(comp.select(F.col("node").alias("u"), F.col("component").alias("a")), "u").join(comp.select(F.col("node").alias("v"), F.col("component").alias("b")), "v")
    joined = materialise(components(ends.select(F.col("a").alias("u"), F.col("b").alias("v"))), "joined").select(F.col("node").alias("component"), F.col("component").alias("root"))
    rest = [c for c in comp.columns if c != "component"]
    return materialise(comp.join(small_side(joined), "component", "left").select(*rest, F.coalesce("root", "component").alias("component")), "components")


def within_lists(members: DataFrame, keys: list[str], extra: list[str] = (), condition: Column | None = None) -> DataFrame:
    """Pairs (hub, node) of one list that are in different components, hub < node, one row for each list; members: (*keys, node, component, *extra).

    One of a pair is outside the list's largest component, so only members outside it are joined with all. condition may
    use the extra columns of both, those of the other one as hub_...
    """
    sizes = members.groupBy(*keys, "component").agg(F.count("*").alias("k"))
    major = sizes.groupBy(*keys).agg(F.max_by("component", F.struct("k", "component")).alias("major"), F.count("*").alias("kinds")).filter("kinds > 1").select(*keys, "major")
    mixed = materialise(members.select(*keys, "node", "component", *extra).join(small_side(materialise(major, "major")), keys), "mixed")
    minor = mixed.filter("component <> major").select(*keys, F.col("node").alias("hub"), F.col("component").alias("hub_component"), *[F.col(c).alias(f"hub_{c}") for c in extra])
    # two members outside meet once
    apart = (F.col("component") != F.col("hub_component")) & ((F.col("component") == F.col("major")) | (F.col("hub") < F.col("node")))
    pairs = mixed.join(minor, keys).filter(apart if condition is None else apart & condition)
    return pairs.select(F.least("hub", "node").alias("hub"), F.greatest("hub", "node").alias("node"))


#: Members that are compared with one hub in one block.
BLOCK = 64


def in_blocks(pairs: DataFrame) -> DataFrame:
    """pairs (hub, node) with block: the partners of a hub that has many are dealt to blocks of about BLOCK, so that no
    join by hub brings them together."""
    many = materialise(pairs.groupBy("hub").agg(F.count("*").alias("of")).filter(F.col("of") > BLOCK).select(F.col("hub").alias("many"), "of"), "many")
    # at most one row for each BLOCK pairs
    sized = pairs.join(small_side(many), F.col("hub") == F.col("many"), "left")
    blocks = F.ceil(F.coalesce("of", F.lit(1)) / BLOCK).cast("long")
    return sized.select("hub", F.pmod(F.xxhash64("node"), blocks).alias("block"), "node")


def hub_rows(dealt: DataFrame, rows: DataFrame) -> DataFrame:
    """(hub, block, columns of rows): each hub's row (of rows by node) once for each of its blocks."""
    return dealt.select("hub", "block").distinct().join(rows.withColumnRenamed("node", "hub"), "hub")


def by_hub(dealt: DataFrame, payload: DataFrame) -> DataFrame:
    """Rows (hub, block, own, node, payload) for pairs (hub, block, node), dealt and sorted so that a streaming function
    meets a hub's own row (own = 0) before each block of its partners; payload: (node, payload), one row for each node."""
    ones = dealt.join(payload, "node").select("hub", "block", F.lit(1).alias("own"), "node", "payload")
    hubs = hub_rows(dealt, payload).select("hub", "block", F.lit(0).alias("own"), F.col("hub").alias("node"), "payload")
    return ones.union(hubs).repartition("hub", "block").sortWithinPartitions("hub", "block", "own")

"""Verified links within blocks, and the connected components they make, without all pairs of a block.

A node has an array of keys; the nodes that share a key are a block. Blocks are found by partial aggregation: the smallest
and the largest member and the number of members. A block of two is a pair at once. In a larger one every member first meets the
smallest and the largest; what is verified joins components. In rounds, those outside the largest component of their block then meet one more
member of it, as long as that joins many. Last, all members of a block that still lie in different components meet. So every pair of a block is either verified, or refused, or lies in one component already: no link between
components is lost, while a block of many alike members costs a multiple of its size. A key with a third of all nodes is one
row after partial aggregation; the joins by key, node and component are plain ones that AQE splits where they are skewed.

Each step is a table in the shared folder; components never pass the driver.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import Scratch

#: Rows of 8 to 32 bytes that may be broadcast, after a count; beyond it the join shuffles.
BROADCAST_ROWS = 100_000
#: Blocks meet further members of their largest components while the pairs left are more than ENOUGH for each member, and as long as a
#: round leaves no more than FALL of them.
ENOUGH, FALL = 8, 0.8


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """df with a hint to broadcast it if a count shows at most that many rows. df: a saved table of narrow rows."""
    return F.broadcast(df) if df.count() <= rows else df


def components(scratch: Scratch, edges: DataFrame, name: str) -> DataFrame:
    """(node, comp): comp is the smallest node of node's component. edges: (a, b), any order. A round ties all smaller
    neighbours of a node to the smallest, then takes each lower end's own smallest in its place, until the edges are stars.
    Edges point from the larger node to the smaller, so the many leaves of a hub are many groups, not one."""

    def oriented(df: DataFrame) -> DataFrame:
        return df.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()

    def round_(e: DataFrame) -> DataFrame:
        told = e.withColumn("m", F.min("b").over(Window.partitionBy("a")))
        ends = F.when(F.col("b") == F.col("m"), F.array("a")).otherwise(F.array("a", "b"))
        tied = told.select(F.explode(ends).alias("a"), F.col("m").alias("b")).distinct()
        up = tied.groupBy(F.col("a").alias("_a")).agg(F.min("b").alias("_m"))
        return tied.join(up, F.col("b") == F.col("_a"), "left").select("a", F.coalesce("_m", "b").alias("b")).distinct()

    state = lambda e: tuple(e.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.bit_xor(F.xxhash64("b", "a", F.lit(1)))).first())
    held = scratch.save(oriented(edges), f"{name}-edges0")
    before, step = state(held), 0
    while before[0]:
        step += 1
        held = scratch.save(round_(held), f"{name}-edges{step}")
        scratch.drop(f"{name}-edges{step - 1}")
        now = state(held)
        if now == before:
            break
        before = now
    leaves = held.select(F.col("a").alias("node"), F.col("b").alias("comp"))
    return leaves.unionByName(held.select(F.col("b").alias("node"), F.col("b").alias("comp")).distinct())


def link(scratch: Scratch, keyed: DataFrame, signatures: DataFrame, near: Callable[[str, str], Column], verify: Callable[[DataFrame, str], DataFrame], common: Callable[[str, str], Column] | None = None, earliest: Callable[[str, str, str], Column] | None = None) -> DataFrame:
    """(node, comp) of every node with a verified link. keyed: (node, keys), keys being an array of longs that aren't another of
    the node's; signatures: (node, further columns); both saved tables, keyed under that name: it is dropped once it is read. near(x, y): whether two rows under these aliases may link by their signatures;
    verify(pairs of a and b, name): those that link. common(x, y): how many keys two members that still lie apart must share to
    meet; one if it isn't given. earliest(key, x, y): whether a common key is the one under which the two are to meet, so that a pair is made
    once, not in each of its blocks."""
    keyed = keyed.select("node", F.explode("keys").alias("key"))
    blocks = keyed.groupBy("key").agg(F.min("node").alias("lo"), F.max("node").alias("hi"), F.count("*").alias("members")).filter("members > 1")
    blocks = scratch.save(blocks, "blocks")
    large = blocks.filter("members > 2")
    members = scratch.save(keyed.join(small(large), "key").select("key", "node", "lo", "hi"), "members")
    scratch.drop("keyed")
    pairs = blocks.filter("members = 2").select(F.col("hi").alias("a"), F.col("lo").alias("b"))
    return resolve(scratch, pairs, members, signatures, near, verify, common, earliest)


def resolve(scratch: Scratch, two: DataFrame, members: DataFrame, signatures: DataFrame, near: Callable[[str, str], Column], verify: Callable[[DataFrame, str], DataFrame], common: Callable[[str, str], Column] | None = None, earliest: Callable[[str, str, str], Column] | None = None, last: Callable[[str, str], Column] | None = None) -> DataFrame:
    """link, for blocks that are found already. two: (a, b), a > b, the blocks of two members; members: (key, node, lo, hi) of larger ones, a saved table.
    last(x, y): a costlier near for the pairs that still lie apart, which are many and mostly unlike, before they become rows."""
    ends = members.select("node", F.explode(F.array("lo", "hi")).alias("leader")).filter("node != leader")
    first = two.unionByName(ends.select(F.greatest("node", "leader").alias("a"), F.least("node", "leader").alias("b"))).distinct()
    first = scratch.save(_near(first, signatures, near), "first")
    links = scratch.save(verify(first, "first"), "links1")
    known = components(scratch, links, "first")
    done, left, before = first, None, None
    for step in itertools.count(1):
        own = members.select("key", "node").join(known, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
        parts = own.groupBy("key", "comp").agg(F.count("*").alias("n"), F.min_by("node", F.xxhash64("node", F.lit(step))).alias("leader"))
        # of each block: its pairs whose components differ, and its largest component with a member of it
        blocks_ = parts.groupBy("key").agg(F.count("*").alias("comps"), F.sum("n").alias("all"), F.sum(F.col("n") * F.col("n")).alias("within"), F.max_by(F.struct("comp", "leader"), F.struct("n", "comp")).alias("top"))
        # the members that still lie apart; the two of a block of two have met
        apart = scratch.save(blocks_.filter("comps > 1").select("key", "top", ((F.col("all") * F.col("all") - F.col("within")) / 2).alias("pairs"), "all"), f"blocks{step}")
        pairs, all_ = apart.agg(F.coalesce(F.sum("pairs"), F.lit(0.0)), F.coalesce(F.sum("all"), F.lit(0))).first()
        if pairs <= ENOUGH * all_ or (before is not None and pairs > FALL * before):
            left = own.join(apart.select("key"), "key", "left_semi")
            break
        before = pairs
        meet = own.join(small(apart).select("key", "top"), "key").filter("comp != top.comp").select(F.greatest("node", "top.leader").alias("a"), F.least("node", "top.leader").alias("b")).distinct()
        meet = scratch.save(_near(meet.join(done, ["a", "b"], "left_anti"), signatures, near), f"met{step}")
        done = done.unionByName(meet)
        links = links.unionByName(scratch.save(verify(meet, f"met{step}"), f"more{step}"))
        known = components(scratch, links, f"round{step}")
    left = scratch.save(left.join(signatures, "node"), "apart")
    if left.isEmpty():
        return scratch.save(known, "components")
    x, y = left.alias("x"), left.alias("y")
    meet = (F.col("x.key") == F.col("y.key")) & (F.col("x.node") > F.col("y.node")) & (F.col("x.comp") != F.col("y.comp")) & near("x", "y")
    meet = meet & last("x", "y") if last else meet
    pairs = x.join(y, meet & earliest("x.key", "x", "y") if earliest else meet)
    least = common("x", "y") if common else F.lit(1)
    pairs = pairs.groupBy(F.col("x.node").alias("a"), F.col("y.node").alias("b")).agg(F.count("*").alias("_n"), F.first(least).alias("_least")).filter("_n >= _least").select("a", "b")
    pairs = pairs.join(done, ["a", "b"], "left_anti")
    more = scratch.save(verify(scratch.save(pairs, "second"), "second"), "links2")
    return scratch.save(components(scratch, links.unionByName(more), "all"), "components")


def _near(pairs: DataFrame, signatures: DataFrame, near: Callable[[str, str], Column]) -> DataFrame:
    x, y = signatures.alias("x"), signatures.alias("y")
    return pairs.join(x, F.col("a") == F.col("x.node")).join(y, F.col("b") == F.col("y.node")).filter(near("x", "y")).select("a", "b")

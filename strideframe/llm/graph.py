"""Connected components and grouped linking without all-pairs output."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strideframe.llm.common import reliable_checkpoint


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, root): for every node of ``edges`` (a, b) the smallest node it
    reaches, by alternating large-star and small-star rounds (each node's
    neighbours move to its smallest neighbour) until nothing changes.  Minima
    are combined before the shuffle and neighbours are joined, not gathered,
    so a node with many neighbours never fills one task.  Each round is
    written to the shared folder."""
    e = reliable_checkpoint(edges.select("a", "b").filter("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    mark = None
    for _ in range(max_rounds):
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = (both.filter("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                     .filter("a <> b").distinct())
        e = reliable_checkpoint(large, "edges")
        low = e.groupBy("a").agg(F.min("b").alias("m"))
        joined = e.join(low, "a")
        small = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            low.select("a", F.col("m").alias("b"))).filter("a <> b").distinct()
        e = reliable_checkpoint(small, "edges")
        new = e.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()
        if mark == (new.n, new.s):
            break
        mark = (new.n, new.s)
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return e.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        e.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def linked_components(groups: DataFrame, confirm: Callable[[DataFrame], DataFrame], stars: int = 2,
                      rest: Callable[[DataFrame], DataFrame] | None = None, carry: Sequence[str] = (),
                      fits: Callable[[str, str], Column] | None = None) -> DataFrame:
    """(node, root) of the graph whose edges are the confirmed pairs of nodes
    that share a group; nodes without any edge are left out.

    ``groups`` (g, node, and the columns ``carry``) holds the memberships of
    groups with two nodes or more; ``confirm`` keeps the true links of
    candidate pairs (a, b), ``fits`` is a cheap necessary condition on the
    carried columns of a pair, named with the two prefixes it gets.  Pairs
    are not enumerated within a group: each of the ``stars`` rounds compares
    the members outside the component of the group's first node, or (later)
    of its first node outside that, with that node only.  Groups that then
    still hold several components are compared across components, so no link
    between two components is lost, and members of one component, which need
    no further link, make no pair.  ``rest`` may give those last candidates by
    a sharper join: it gets (g, node, r), r the component so far, and returns
    pairs (a, b) that hold every link between components.
    """
    groups = groups.select("g", "node", *carry)
    done = edges = root = None

    def placed() -> DataFrame:
        if root is None:
            return groups.withColumn("r", F.col("node"))
        return groups.join(root, "node", "left").withColumn("r", F.coalesce("root", "node")).drop("root")

    for turn in range(stars + 1):
        at = placed()
        span = at.groupBy("g").agg(F.min("r").alias("lo"), F.max("r").alias("hi")).filter("lo < hi").select("g", "lo")
        several = at.join(span, "g")
        if turn == stars:
            several = reliable_checkpoint(several, "several")
            if several.isEmpty():
                break
        if turn == stars and rest is not None:
            pairs = rest(several.select("g", "node", "r"))
        else:
            lead = several.filter("r <> lo" if turn else "r = lo")
            if turn < stars:
                lead = lead.groupBy("g").agg(F.min(F.struct("node", "r", *carry)).alias("x")).select("g", "x.*")
            # of each pair across components at least one is outside the group's smallest component
            pairs = (_prefixed(several.drop("lo"), "b").join(_prefixed(lead.select("g", "node", "r", *carry), "a"), "g")
                     .filter("a <> b AND a_r <> b_r").filter(fits("a_", "b_") if fits else F.lit(True)))
        pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        if done is not None:
            pairs = pairs.join(done, ["a", "b"], "left_anti")
        pairs = reliable_checkpoint(pairs, "pairs")
        if pairs.isEmpty():
            continue
        found = reliable_checkpoint(confirm(pairs).select("a", "b"), "links")
        done = pairs if done is None else done.unionByName(pairs)
        edges = found if edges is None else edges.unionByName(found)
        root = reliable_checkpoint(components(edges), "components")
    if root is None:
        return groups.select("node", F.col("node").alias("root")).limit(0)
    return root


def _prefixed(df: DataFrame, name: str) -> DataFrame:
    """Columns of ``df`` but g with a prefix; the node is called ``name``."""
    return df.select("g", *[F.col(c).alias(name if c == "node" else f"{name}_{c}") for c in df.columns if c != "g"])

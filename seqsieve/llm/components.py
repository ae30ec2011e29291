"""Connected components of any number of links, without bringing links to the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import free_names, rewritten


#: Rows of one key that are one task's work in any case, and most keys that may have more.
HOT_ROWS, HOT_KEYS = 1000, 10_000


def split_join(rows: DataFrame, sums: DataFrame, key: str, by: str, total: int) -> DataFrame:
    """rows joined to sums by key, for sums with one row for each key and n, the number of its rows. Rows of a key with
    many of them are dealt by column `by` to as many tasks as it needs. total: the number of rows, which bounds the
    broadcast list of such keys by HOT_KEYS."""
    limit = max(HOT_ROWS, total // HOT_KEYS)
    splits, salt = free_names(rows, "__splits", "__salt")
    sums = sums.withColumn(splits, F.ceil(F.col("n") / limit).cast("int"))
    hot = F.broadcast(sums.filter(F.col(splits) > 1).select(key, splits))
    dealt = rows.join(hot, key, "left").withColumn(salt, F.pmod(F.xxhash64(by), F.coalesce(splits, F.lit(1)))).drop(splits)
    spread = sums.withColumn(salt, F.explode(F.sequence(F.lit(0).cast("long"), F.col(splits).cast("long") - 1))).drop(splits)
    return dealt.join(spread, [key, salt]).drop(salt)


def _smallest(edges: DataFrame, total: int) -> DataFrame:
    """Joins to each row its node a's smallest neighbour m."""
    return split_join(edges, edges.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("n")), "a", "b", total).drop("n")


def _round(edges: DataFrame, total: int) -> DataFrame:
    """A large-star, then a small-star step; edges run from the larger node a to the smaller node b."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    large = _smallest(both, 2 * total).filter("b > a").select(F.col("b").alias("a"), F.least("a", "m").alias("b")).distinct()
    small = _smallest(large, total)
    ends = F.explode(F.array(F.struct(F.col("a"), F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b"))))
    return small.select(ends.alias("e")).select("e.a", "e.b").filter("a > b").distinct()


def connected_components(links: DataFrame) -> DataFrame:
    """node and root (the smallest node it is linked with) for links with long columns a and b. Only nodes that have a
    link to another node are returned. Each round is a written table that replaces the last
    one; rounds grow with the logarithm of the size."""
    edges = links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges, path = rewritten(edges, "links", None)
    seen = None
    while True:
        state = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        if state == seen or state[0] == 0:
            break
        seen = state
        edges, path = rewritten(_round(edges, state[0]), "links", path)
    stars = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return stars.unionByName(stars.select(F.col("root").alias("node"), "root").distinct())


def blocks(members: DataFrame, size: int) -> DataFrame:
    """Adds to members (node, root) the number n_blocks of blocks of about `size` nodes in its component, and block."""
    sizes = members.groupBy("root").agg(F.ceil(F.count("*") / size).cast("int").alias("n_blocks"))
    joined = members.join(sizes, "root")
    return joined.withColumn("block", F.pmod(F.xxhash64("node"), F.col("n_blocks")).cast("int"))


def block_pairs(items: DataFrame, groups: int, by: str = "root") -> DataFrame:
    """A row for each pair of blocks that an item (by, block, n_blocks) takes part in. The columns part and pair tell
    a task's group: whole small components share one of `groups` parts, a pair of blocks of a large one stands alone.
    side is 0 inside a block, and 1 or 2 in a pair of two blocks, of which one may have no items."""
    others = F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1)).alias("other")
    rows = items.select("*", others)
    pair = F.least("block", "other").cast("long") * F.col("n_blocks") + F.greatest("block", "other")
    small = F.col("n_blocks") == 1
    part = F.when(small, F.pmod(F.xxhash64(by), F.lit(groups))).otherwise(F.col(by))
    side = F.when(F.col("block") == F.col("other"), 0).when(F.col("block") < F.col("other"), 1).otherwise(2)
    return rows.withColumn("part", part).withColumn("side", side).withColumn("pair", F.when(small, F.lit(-1).cast("long")).otherwise(pair)).drop("other")

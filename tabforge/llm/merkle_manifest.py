"""Merkle manifest of a table: one tree per group, one tree over the groups' roots.

Leaves are digests of the rows.  Every level is one equijoin of the level's nodes with
themselves on the computed index of the sibling (index XOR 1 for binary trees, slot
offsets inside the run of ``arity`` otherwise); the rows of slot zero then emit the
parents.  A last, shorter run is hashed too, even a run of one node.  Proofs come from a
second pass down the stored levels: a node's path is its own siblings followed by the path of
its parent, so all levels together move about twice the leaves, not leaves x height.

Leaf positions inside a group need no window over the group: rows are range-partitioned
by (group, key), numbered inside their partition, and shifted by the totals of the
partitions before (a table of partitions + groups rows).  A group with a third of all rows
(few languages, say) is spread like any other.

Levels are written to the shared scratch folder.  Joins of a level with at most ``SMALL``
nodes are broadcast, by a count that was taken; larger ones are shuffled.

Defined results: a NULL column enters its leaf as ``-``; a NULL group is a group of its own and
comes first; NULL keys come first; rows with equal keys are ordered by their leaf digests, equal
rows are leaves each; an empty table has no rows and no root.  Texts enter whole.  Columns
beyond the named ones, whatever their names, take no part.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise

COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
SMALL = 4096
CUT = 4       # small levels joined in one plan on the way down
ROWS = 20_000  # leaves in a range partition, as long as the session's number of partitions allows


def field(value: Column) -> Column:
    """``-`` for NULL, else byte count, colon, value."""
    s = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-"))


def digest(*parts: Column) -> Column:
    """SHA-256 of the concatenation, as 32 bytes."""
    return F.unhex(F.sha2(F.concat(*parts).cast("binary"), 256))


def hexa(h: Column) -> Column:
    return F.lower(F.hex(h))


def positions(leaves: DataFrame, order: list[str], total: int) -> DataFrame:
    """``leaves`` (g, ..., ``total`` rows) with ``idx``, the place inside the group by
    ``order``, and ``n``, the group's number of leaves."""
    spark = leaves.sparkSession
    parts = min(int(spark.conf.get("spark.sql.shuffle.partitions", "200")), 1 + total // ROWS)
    ranged = materialise(
        leaves.withColumn("u", F.monotonically_increasing_id())  # splits a hot key among partitions
        .repartitionByRange(parts, "g", *order, "u").sortWithinPartitions("g", *order, "u").drop("u")
        .withColumn("at", F.monotonically_increasing_id()).withColumn("part", F.spark_partition_id()), "merkle-leaves")
    per = ranged.groupBy("g", "part").agg(F.min("at").alias("first"), F.count("*").alias("c"))
    w = Window.partitionBy("g")
    before = F.sum("c").over(w.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    per = materialise(per.select("g", "part", (F.col("first") - F.coalesce(before, F.lit(0))).alias("base"),
                                 F.sum("c").over(w).alias("n")), "merkle-offsets")
    return ranged.join(per, ["g", "part"]).withColumn("idx", F.col("at") - F.col("base")).drop("part", "at", "base")


def siblings(nodes: DataFrame, arity: int, small: bool) -> DataFrame:
    """``nodes`` (g, idx, h, ...) with ``slot`` and ``sibs``, the digests of the other nodes
    of the run from left to right."""
    slot = F.pmod(F.col("idx"), F.lit(arity)).cast("int")
    out = nodes.withColumn("slot", slot)
    names = []
    for o in range(1, arity):
        if arity == 2:
            index = F.col("idx").bitwiseXOR(F.lit(1).cast("long"))
        else:  # the node o slots further on, cyclically inside its run, asks for this one
            index = F.col("idx") - slot + F.pmod(slot - o, F.lit(arity))
        other = nodes.select("g", index.alias("idx"), F.col("h").alias(f"s{o}"))
        out = out.join(F.broadcast(other) if small else other, ["g", "idx"], "left")
        names.append(f"s{o}")
    # Left of the node stand the slots reached last (offsets arity - slot ...), then those to its right.
    ring = F.array(*names)
    by_slot = F.concat(F.slice(ring, F.lit(arity) - F.col("slot"), F.col("slot")),
                       F.slice(ring, F.lit(1), F.lit(arity - 1) - F.col("slot")))
    return out.withColumn("sibs", F.filter(by_slot, lambda s: s.isNotNull())).drop(*names)


def fold(start: Column, path: Column) -> Column:
    """Root (hex) from a leaf (hex) and its path of (slot, sibs)."""
    def step(acc, e):
        sibs = F.transform(e["sibs"], hexa)
        left = F.array_join(F.slice(sibs, F.lit(1), e["slot"]), "")
        right = F.array_join(F.slice(sibs, e["slot"] + 1, F.greatest(F.size(sibs) - e["slot"], F.lit(0))), "")
        return F.sha2(F.concat(left, acc, right).cast("binary"), 256)
    return F.aggregate(path, start, step)


def heights(leaves: DataFrame, arity: int) -> list[int]:
    """Number of nodes of every level of the trees over ``leaves``, from the groups' sizes."""
    n, powers = F.col("n"), [1]
    while powers[-1] < 1 << 62 // arity:
        powers.append(powers[-1] * arity)
    at = [F.ceil(n / F.lit(p)) if p < 1 << 50 else F.lit(1) for p in powers]
    sums = [F.sum(at[0])] + [F.sum(F.when(below > 1, here)) for below, here in zip(at, at[1:])]
    found = leaves.where("idx = 0").agg(*[s.cast("long").alias(f"l{i}") for i, s in enumerate(sums)]).first()
    return [x for x in found if x]


def tree(leaves: DataFrame, arity: int = 2) -> tuple[list[tuple[DataFrame, bool]], DataFrame]:
    """(levels, roots) of the trees over ``leaves`` (g, idx, n, h, ...): a level is (table
    with slot and sibs, whether it is small); roots are (g, root)."""
    levels, cur = [], leaves
    for total in heights(leaves, arity) or [0]:
        small = total <= SMALL
        level = siblings(cur, arity, small)
        level = materialise(level.coalesce(1) if small else level, "merkle-level")
        levels.append((level, small))
        runs = F.array_join(F.transform(F.col("sibs"), hexa), "")
        cur = level.where("n > 1 and slot = 0").select(
            "g", F.expr(f"idx div {arity}").alias("idx"), F.expr(f"(n + {arity - 1}) div {arity}").alias("n"),
            digest(hexa(F.col("h")), runs).alias("h"))
    done = [level.where("n = 1").select("g", F.col("h").alias("root")) for level, _ in levels]
    return levels, materialise(reduce(DataFrame.unionByName, done), "merkle-roots")


def paths(levels: list[tuple[DataFrame, bool]], tops: DataFrame, arity: int = 2) -> DataFrame:
    """The leaves' rows with ``path`` (arrays of (slot, sibs) from the leaf up); ``tops``
    is (g, root, path), what comes above a group's root."""
    own = F.array(F.struct("slot", "sibs"))
    up = None
    for i, (level, small) in reversed(list(enumerate(levels))):
        keep = ["g", "idx"] if i else level.columns
        out = level.where("n = 1").join(tops, "g").select(*keep, "root", "path")
        if up is not None:
            above = up.select("g", F.col("idx").alias("above"), "root", F.col("path").alias("rest"))
            kids = level.where("n > 1").withColumn("above", F.expr(f"idx div {arity}"))
            kids = kids.join(F.broadcast(above) if small else above, ["g", "above"])
            out = out.unionByName(kids.select(*keep, "root", F.concat(own, "rest").alias("path")))
        up = out
        if i and (not small or i % CUT == 0):
            up = materialise(up.coalesce(1) if small else up, "merkle-paths")
    return up


def merkle_manifest(rows: DataFrame, columns=COLUMNS, group: str = "lang", key: str = "doc_id",
                    tampered: dict[str, Column] | None = None, arity: int = 2) -> DataFrame:
    """One row per row of ``rows``: the key, ``leaf``, ``subroot``, ``root`` (hex), ``path``
    (array of (slot, sibs), leaf first) and ``claimed``, the leaf of the row with the columns of
    ``tampered`` in place of the stored ones (the leaf itself when nothing is tampered with)."""
    changed = tampered or {}
    leaf = digest(*[field(F.col(c)) for c in columns])
    claimed = digest(*[field(changed.get(c, F.col(c))) for c in columns])
    g = F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit(""))  # NULL sorts before any value
    total = rows.count()
    leaves = positions(rows.select(g.alias("g"), F.col(key).alias("key"), leaf.alias("h"), claimed.alias("claimed")),
                       ["key", "h"], total)
    levels, subroots = tree(leaves, arity)
    groups = subroots.count()
    over = positions(subroots.select(F.lit("").alias("g"), F.col("g").alias("key"), F.col("root").alias("h")), ["key"],
                     groups)
    top_levels, top = tree(over, arity)
    none = F.array().cast("array<struct<slot:int,sibs:array<binary>>>")
    tops = paths(top_levels, top.withColumn("path", none), arity).select(
        F.col("key").alias("g"), F.struct(F.col("h").alias("sub"), F.col("root").alias("top")).alias("root"), "path")
    out = paths(levels, materialise(tops, "merkle-tops"), arity)
    return out.select(F.col("key").alias(key), hexa(F.col("h")).alias("leaf"), hexa(F.col("root.sub")).alias("subroot"),
                      hexa(F.col("root.top")).alias("root"), "path", hexa(F.col("claimed")).alias("claimed"))


def verified(manifest: DataFrame) -> DataFrame:
    """``manifest`` with ``proof_sha256``, the root folded from the claimed leaf, and
    whether it is the manifest's root."""
    sibs = F.flatten(F.transform("path", lambda e: F.transform(e["sibs"], hexa)))
    out = manifest.withColumn("proof_sha256", F.sha2(F.array_join(sibs, "").cast("binary"), 256))
    out = out.withColumn("folded_root", fold(F.col("claimed"), F.col("path")))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))

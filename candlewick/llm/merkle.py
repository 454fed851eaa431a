"""Merkle manifest of a dataset, and proofs by descent.

Leaves are numbered within their source by one range sort of the whole table, so a hot source is spread over as many tasks as
it needs.  A level is a grouping of at most ``FANOUT`` nodes by the leading digits of their numbers, until each source has one
node; the sources' nodes are leaves of a tree of their own, whose top is the root.

What is stored of each level is content-addressed: records from a digest to the digests of its children.  Leaf requests
descend from the root: requests that share the leading digits of their number travel as one row, are joined to the record of
their node by its digest, and choose the child that their next digit names; the others are its siblings.  The path of a leaf
is collected from the root down and reversed at the end.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlewick.sources.scratch import materialise

from .ranking import ranked

FANOUT = 16
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def digest(*parts: Column) -> Column:
    """Lower-case hex SHA-256 of the parts joined."""
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def field_text(c: Column) -> Column:
    """``-`` for null, else the number of UTF-8 bytes, a colon and the value."""
    text = c.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(fields: Sequence[Column]) -> Column:
    return digest(*[field_text(c) for c in fields])


def lower_ascii(c: Column) -> Column:
    return F.translate(c, _UPPER, _LOWER)


def _joined(nodes: Column) -> Column:
    return F.array_join(nodes, "")


class Tree:
    """Levels of one Merkle tree per ``tree``, from the leaves (``tree``, ``number``, ``digest``) up.

    ``tops`` has the one node that each tree ends in, and its height; a tree of one leaf ends in that leaf.  ``records`` has
    a table for each level: a digest and those of its children.
    """

    def __init__(self, leaves: DataFrame, fanout: int = FANOUT) -> None:
        self.fanout = fanout
        sizes = materialise(leaves.groupBy("tree").agg(F.count(F.lit(1)).alias("__n")), "merkle-sizes")
        most, height = sizes.agg(F.max("__n")).first()[0] or 0, 0
        while fanout**height < most:
            height += 1
        own = sum((F.when(F.col("__n") > fanout**h, 1).otherwise(0) for h in range(height)), F.lit(0))
        nodes = leaves.select("tree", "number", "digest").join(sizes.select("tree", own.alias("height")), "tree")
        tops, self.records = [], []
        for h in range(height + 1):
            tops.append(nodes.filter(F.col("height") == h).select("tree", "digest", "height"))
            if h < height:
                # A tree that has ended goes no further: its lone node is not hashed again.
                nodes = self._level_above(nodes.filter(F.col("height") > h))
        self.tops = materialise(reduce(DataFrame.unionByName, tops), "merkle-tops")

    def _run(self, number: str = "number") -> Column:
        return F.expr(f"{number} div {self.fanout}")

    def _level_above(self, nodes: DataFrame) -> DataFrame:
        members = F.array_sort(F.collect_list(F.struct("number", "digest")))
        runs = nodes.groupBy("tree", "height", self._run().alias("__up")).agg(members.alias("__members"))
        children = F.transform("__members", lambda m: m["digest"])
        level = runs.select(
            "tree", "height", F.col("__up").alias("number"), digest(_joined(children)).alias("digest"), children.alias("children")
        )
        level = materialise(level, "merkle-level")
        # Equal nodes share a record.  Digests of nodes are as good as distinct, so no group is large.
        self.records.append(level.groupBy("digest").agg(F.first("children").alias("children")))
        return level.drop("children")

    def descend(self, requests: DataFrame, above: DataFrame) -> DataFrame:
        """``requests`` (``tree``, ``number`` and other columns) with ``digest`` and ``path`` of each leaf asked for.

        ``above`` has ``tree`` and the path above its top.  A step of a path is the siblings left and right of the way, joined;
        steps come from the root down.
        """
        asked = [requests.select("tree", self._run().alias("number")).distinct()]
        for _ in self.records[1:]:
            up = asked[-1].select("tree", self._run().alias("number")).distinct()
            asked[-1:] = [materialise(asked[-1], "merkle-requests"), up]
        tops = self.tops.join(above, "tree").withColumn("number", F.lit(0).cast("bigint"))
        lone = tops.filter("height = 0").select("tree", "number", F.array("digest").alias("children"), "path", F.lit(True).alias("lone"))
        parts, frontier = [lone], None
        for h in range(len(self.records), 0, -1):
            entering = tops.filter(F.col("height") == h).select("tree", "number", "digest", "path")
            frontier = entering if frontier is None else frontier.unionByName(entering)
            # Where every node of a level is asked for, this keeps all.
            met = frontier.join(asked[h - 1], ["tree", "number"], "left_semi").join(self.records[h - 1], "digest")
            met = met.select("tree", "number", "children", "path")
            if h == 1:
                parts.append(met.withColumn("lone", F.lit(False)))
            else:
                digits = met.select("*", F.explode(F.sequence(F.lit(0), F.size("children") - 1)).alias("digit"))
                frontier = digits.select(
                    "tree",
                    (F.col("number") * self.fanout + F.col("digit")).alias("number"),
                    F.get("children", F.col("digit")).alias("digest"),
                    F.array_append("path", self._step(F.col("digit"))).alias("path"),
                )
                frontier = materialise(frontier, "merkle-frontier")
        # Paths are long: up to here one row has them for a whole run, and from here on nothing is shuffled.
        runs = materialise(reduce(DataFrame.unionByName, parts).withColumnRenamed("number", "__run"), "merkle-runs")
        found = requests.withColumn("__run", self._run()).join(runs, ["tree", "__run"])
        digit = F.expr(f"int(number % {self.fanout})")
        longer = F.array_append("path", self._step(digit))
        return found.withColumns(
            {"digest": F.get("children", digit), "path": F.when(F.col("lone"), F.col("path")).otherwise(longer)}
        ).drop("__run", "children", "lone")

    @staticmethod
    def _step(digit: Column) -> Column:
        rest = F.greatest(F.size("children") - digit - 1, F.lit(0))
        left, right = F.slice("children", F.lit(1), digit), F.slice("children", digit + 2, rest)
        return F.struct(_joined(left).alias("left"), _joined(right).alias("right"))


def fold(leaf: Column, path: Column) -> Column:
    """Root that a leaf and the steps from it up give."""
    return F.aggregate(path, leaf, lambda done, step: digest(step["left"], done, step["right"]))


def siblings_digest(path: Column) -> Column:
    return digest(F.array_join(F.transform(path, lambda step: F.concat(step["left"], step["right"])), ""))


class Manifest:
    """Merkle trees of the rows of each source, and one over the sources.

    A leaf is the digest of ``fields``.  Within a source, leaves are ordered by ``order`` and then by digest, nulls first, so
    repeated rows are leaves of their own; sources are ordered bytewise, null first.  ``keep`` columns stay with the leaves;
    ones that clash with ``leaf`` or begin with two underscores are left out.  An empty table has no leaf and no root.
    """

    def __init__(
        self,
        docs: DataFrame,
        fields: Sequence[str] = FIELDS,
        source: str = "source",
        order: str = "doc_id",
        keep: Sequence[str] = (),
        extra: dict[str, Column] | None = None,
        fanout: int = FANOUT,
    ) -> None:
        kept = [c for c in keep if c.lower() not in ("leaf", "tree", "number") and not c.startswith("__")]
        self.kept = [*kept, *(extra or {})]
        leaves = docs.select(
            F.col(source).isNotNull().alias("__known"),
            F.col(source).alias("__source"),
            F.col(order).isNotNull().alias("__placed"),
            F.col(order).alias("__order"),
            leaf_digest([F.col(c) for c in fields]).alias("leaf"),
            *kept,
            *[c.alias(name) for name, c in (extra or {}).items()],
        )
        leaves = materialise(leaves, "merkle-leaves")
        placed = ranked(leaves, "__known", "__source", "__placed", "__order", "leaf")
        firsts = placed.groupBy(F.col("__known").alias("__k"), F.col("__source").alias("__s")).agg(F.min("__rank").alias("__first"))
        numbered = ranked(materialise(firsts, "merkle-sources"), "__k", "__s")
        sources = materialise(numbered.select("__k", "__s", "__first", F.col("__rank").alias("tree")), "merkle-source-numbers")
        rows = placed.join(sources, F.col("__source").eqNullSafe(F.col("__s"))).select(
            "tree", (F.col("__rank") - F.col("__first")).alias("number"), "leaf", *self.kept
        )
        self.leaves = materialise(rows, "merkle-numbered")
        self.trees = Tree(self.leaves.select("tree", "number", F.col("leaf").alias("digest")), fanout)
        of_sources = self.trees.tops.select(F.lit(0).cast("bigint").alias("tree"), F.col("tree").alias("number"), "digest")
        self.top = Tree(of_sources, fanout)

    def root(self) -> Column:
        return self.top.tops.select("digest").scalar()

    def proofs(self, requests: DataFrame | None = None) -> DataFrame:
        """Leaves with ``subroot``, ``root`` and ``path``, the steps from the leaf up to the root.

        ``requests`` (``tree``, ``number``) picks leaves; by default all of them are asked for.
        """
        asked = self.leaves
        if requests is not None:
            asked = asked.join(requests.select("tree", "number").distinct(), ["tree", "number"], "left_semi")
        zero, nothing = F.lit(0).cast("bigint"), F.array().cast("array<struct<left:string,right:string>>")
        sources = asked.select(zero.alias("tree"), F.col("tree").alias("number")).distinct()
        above = self.top.descend(sources, sources.select("tree").distinct().withColumn("path", nothing))
        above = materialise(above.select(F.col("number").alias("tree"), F.col("digest").alias("subroot"), "path"), "merkle-source-paths")
        found = self.trees.descend(asked, above.drop("subroot")).withColumn("path", F.reverse("path"))
        return found.drop("digest").join(above.select("tree", "subroot"), "tree").withColumn("root", self.root())

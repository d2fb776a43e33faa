"""Candidate lists whose members are not all in one component: the pairs across components that may still be alike.

A list (a bucket, or the holders of one token combination) may hold any share of all nodes, most of them in one component.
Pairs inside a component need no comparison, so members are never paired as such. Of each list the component with the
most members there is its *main* one; the other members are *outside*. What has to be looked at is

* outside members with the main component. The same pair would come up in every list the two share, so where the lists
  together hold more members of the main component than it has, the outside node is compared with the component itself, once;
* the rest list by list: outside members with the main members there, and with each other.

Lists and components are cut into cells of bounded size, and a cell is one key of a join, so no task holds a list whole.
Sizes and folded parity sketches are compared inside the joins; what cannot be alike never leaves them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from giniflow.llm.common import stored

#: Members of a cell.
CELL = 1000


def _cells(size: Column | str) -> Column:
    size = F.col(size) if isinstance(size, str) else size
    return F.ceil(size / CELL).cast("int")


def _cell_of(node: str, cells: Column) -> Column:
    return F.pmod(F.xxhash64(node), cells).cast("int")


def _to_all(cells: Column) -> Column:
    return F.explode(F.sequence(F.lit(0), cells - 1))


def across(members: DataFrame, roots: DataFrame, sketches: DataFrame, may_be_alike: Callable[[str, str], Column],
           may_meet: Callable[[str, str], Column] | None = None) -> DataFrame:
    """(a, b), a < b, of different components that share a list and may be alike.

    ``members``: (sig, node, ...); ``roots``: (node, root) of the nodes that have links; ``sketches``: (node, n, s0, s1, ...);
    ``may_be_alike(x, y)`` compares two prefixes of columns; ``may_meet(x, y)`` is a further condition on members of one list."""
    n_members = members.count()
    rooted = members.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    per = rooted.groupBy("sig", "root").agg(F.count(F.lit(1)).alias("c"))
    lists = per.groupBy("sig").agg(F.max(F.struct("c", "root")).alias("top"), F.sum("c").alias("total"), F.count(F.lit(1)).alias("k"))
    # stored, so that Spark can split a long list in the join with its members
    lists = stored(lists.where("k > 1").select("sig", F.col("top.root").alias("main"), F.col("top.c").alias("main_c"),
                                               (F.col("total") - F.col("top.c")).alias("out_c")),
                   "lists", few=True, rows=n_members // 2)
    both = [c for c in sketches.columns if c in members.columns and c != "node"]
    rooted = stored(rooted.drop(*both).join(lists, "sig").join(sketches, "node"), "straddling", few=True, rows=2 * n_members)
    if not rooted.limit(1).count():
        return rooted.select(F.col("node").alias("a"), F.col("node").alias("b")).limit(0)
    outside, inside = rooted.where("root <> main"), rooted.where("root = main")
    alike = may_be_alike("x.", "y.")
    meet = alike & may_meet("x", "y") if may_meet else alike
    pair = [F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b")]

    # outside nodes with a whole main component
    sizes = roots.groupBy(F.col("root").alias("main")).agg(F.count(F.lit(1)).alias("size"))
    cost = outside.groupBy("node", "main").agg(F.sum("main_c").alias("cost")).join(sizes, "main", "left")
    direct = stored(cost.withColumn("size", F.coalesce("size", F.lit(1))).where("cost > size").select("node", "main", "size"), "direct", few=True, rows=n_members)
    heads = direct.select("main", "size").distinct()
    own = roots.select("node", F.col("root").alias("main")).join(heads, "main").unionByName(
        heads.join(roots.select(F.col("root").alias("main")).distinct(), "main", "left_anti").withColumn("node", F.col("main")))
    x = direct.join(sketches, "node").withColumn("cell", _to_all(_cells("size")))
    y = own.join(sketches, "node").withColumn("cell", _cell_of("node", _cells("size")))
    whole = x.alias("x").join(y.alias("y"), (F.col("x.main") == F.col("y.main")) & (F.col("x.cell") == F.col("y.cell")) & alike)

    # the others, list by list
    listed = outside.join(direct.select("node", "main"), ["node", "main"], "left_anti").withColumn("cell", _to_all(_cells("main_c")))
    y = inside.withColumn("cell", _cell_of("node", _cells("main_c")))
    mixed = listed.alias("x").join(y.alias("y"), (F.col("x.sig") == F.col("y.sig")) & (F.col("x.cell") == F.col("y.cell")) & meet)
    x, y = outside.withColumn("cell", _to_all(_cells("out_c"))), outside.withColumn("cell", _cell_of("node", _cells("out_c")))
    apart = x.alias("x").join(y.alias("y"), (F.col("x.sig") == F.col("y.sig")) & (F.col("x.cell") == F.col("y.cell"))
                              & (F.col("x.root") < F.col("y.root")) & meet)
    return whole.select(*pair).unionByName(mixed.select(*pair)).unionByName(apart.select(*pair)).distinct()

"""Connected components of a table of links, by contraction.

Each round every node takes the smallest of itself and its neighbours as parent, chains of parents are
followed to their roots, and the links are rewritten between roots. Links inside a group vanish, so a
group of copies around one document is done after one round and a chain halves at least. Only counts
reach the driver; every table a round needs is written, so a lost executor costs no earlier round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from plumbline.llm.common import saved


def _roots(parents: DataFrame) -> DataFrame:
    """Follow parents (node, parent; no cycles) until each node points to a root."""
    while True:
        up = parents.select(F.col("node").alias("parent"), F.col("parent").alias("above"))
        jumped = saved(
            parents.join(up, "parent", "left")
            .select("node", F.coalesce("above", "parent").alias("parent"),
                    (F.col("above") != F.col("parent")).alias("moved")), "parents")
        parents = jumped.select("node", "parent")
        if jumped.filter("moved").isEmpty():
            return parents


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of the links (a, b): the smallest node reachable. Loops count as nodes."""
    links = saved(
        links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
    labels = None
    while True:
        both = links.select(F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))).alias("x"))
        parents = both.groupBy(F.col("x.a").alias("node")).agg(F.min(F.least("x.a", "x.b")).alias("parent"))
        parents = _roots(saved(parents, "parents"))
        if labels is None:
            labels = parents.withColumnRenamed("parent", "component")
        else:
            up = parents.select(F.col("node").alias("component"), "parent")
            labels = saved(
                labels.join(up, "component", "left").select("node", F.coalesce("parent", "component").alias("component")),
                "components")
        pa = parents.select(F.col("node").alias("a"), F.col("parent").alias("ra"))
        pb = parents.select(F.col("node").alias("b"), F.col("parent").alias("rb"))
        rest = links.join(pa, "a").join(pb, "b").filter("ra <> rb")
        links = saved(
            rest.select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct(), "links")
        if links.isEmpty():
            return labels

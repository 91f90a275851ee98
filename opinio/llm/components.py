"""Connected components of a link table by min-neighbour hooking, pointer jumping and contraction.

Every round hooks each node to its smallest neighbour, jumps along the hooks until they end at a root,
and relabels the links by these roots; links inside one root vanish.  Each round at least halves the
nodes that still have links, so the number of rounds is logarithmic in the largest component.  Nodes,
links and labels stay in tables; the driver sees row counts only.  A hub shared by very many links is
combined map-side in the aggregate, and the joins that look it up are split by the adaptive skew join.
"""

from __future__ import annotations

from typing import Optional

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opinio.llm.common import discard, materialise


def _simple(links: DataFrame, a: str, b: str) -> DataFrame:
    return (links.select(F.least(a, b).alias("lo"), F.greatest(a, b).alias("hi"))
            .where(F.col("lo").isNotNull() & (F.col("lo") != F.col("hi"))).distinct())


def _roots(links: DataFrame) -> DataFrame:
    """``(node, root)`` for each node of ``links``: the end of its chain of smallest neighbours."""
    ends = links.select(F.explode(F.array(F.struct(F.col("lo").alias("node"), F.col("hi").alias("near")),
                                          F.struct(F.col("hi").alias("node"), F.col("lo").alias("near")))).alias("e"))
    hooks = (ends.select("e.*").groupBy("node").agg(F.min("near").alias("near"))
             .select("node", F.least("node", "near").alias("root")))
    hooks = materialise(hooks, "hooks")
    while True:
        next_ = hooks.select(F.col("node").alias("root"), F.col("root").alias("further"))
        jumped = materialise(hooks.join(next_, "root").select(
            "node", F.col("further").alias("root"), (F.col("further") != F.col("root")).alias("moved")), "hooks")
        still = jumped.where("moved").limit(1).count()
        discard(hooks)
        if not still:
            return jumped
        hooks = jumped


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, component)`` for every node that has a link to another one; ``component`` is the smallest
    node reachable.  Null ends, self links and repeated links add nothing; no links give no rows."""
    links = materialise(_simple(links, a, b), "links")
    labels: Optional[DataFrame] = None
    while links.limit(1).count():
        roots = _roots(links)
        lo = roots.select(F.col("node").alias("lo"), F.col("root").alias("a"))
        hi = roots.select(F.col("node").alias("hi"), F.col("root").alias("b"))
        contracted = materialise(_simple(links.join(lo, "lo").join(hi, "hi"), "a", "b"), "links")
        found = roots.select("node", F.col("root").alias("component"))
        if labels is None:
            labels = found
        else:
            step = found.select(F.col("node").alias("component"), F.col("component").alias("_next"))
            merged = materialise(labels.join(step, "component", "left").select(
                "node", F.coalesce("_next", "component").alias("component")), "labels")
            labels = merged
        discard(links)
        links = contracted
    if labels is None:
        labels = links.select(F.col("lo").alias("node"), F.col("lo").alias("component"))
    return labels

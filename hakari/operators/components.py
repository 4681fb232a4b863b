"""Connected components of a link table, without collecting links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut


def components(links: DataFrame, a: str = "a", b: str = "b", rounds: int = 60) -> DataFrame:
    """(node, component): each node of a link and the smallest node it is connected to.

    Every node takes the smallest of itself and its neighbours as label, then the links are contracted to links
    between unlike labels; that is repeated on what is left, which after the first round is only what chains of
    links leave over. At last the labels are followed back. Labels are made by min() under partial aggregation: a
    node with very many links is combined before the shuffle. Each round is written to the checkpoint folder.
    Empty links give an empty table; null ends and links to itself say nothing and are dropped. Raises if
    `rounds` don't suffice, rather than return parts.
    """
    pair = lambda x, y: [F.least(x, y).alias("u"), F.greatest(x, y).alias("v")]
    e = cut(links.where(F.col(a).isNotNull() & F.col(b).isNotNull()).select(*pair(F.col(a), F.col(b))).where("u < v").distinct(), forget=True)
    labels = []
    while e.limit(1).count():
        if len(labels) == rounds:
            raise RuntimeError(f"components did not settle in {rounds} rounds")
        near = e.unionAll(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        label = cut(near.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("c")).select("node", F.least("node", "c").alias("c")))
        labels.append(label)
        one = lambda k: label.select(F.col("node").alias(k), F.col("c").alias(f"c{k}")).hint("merge")  # noqa: B023, E731
        e = cut(e.join(one("u"), "u").join(one("v"), "v").where("cu <> cv").select(*pair(F.col("cu"), F.col("cv"))).distinct(), forget=True)
    if not labels:
        return e.select(F.col("u").alias("node"), F.col("v").alias("component"))
    done = labels.pop().select("node", F.col("c").alias("component"))
    for label in reversed(labels):
        then = done.select(F.col("node").alias("c"), "component")
        done = label.join(then, "c", "left").select("node", F.coalesce("component", "c").alias("component"))
    return done

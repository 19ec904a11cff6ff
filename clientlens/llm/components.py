"""Connected components of a link table, by alternating large and small stars.

Every round is a pair of grouped minima and joins on the links; hubs are
pre-aggregated in the map tasks and split by the adaptive skew join. Links stay
in the shared folder between rounds; the driver sees only two numbers a round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from clientlens.llm.shared import written


def _star(links: DataFrame, large: bool) -> DataFrame:
    """``links`` holds (u, v). Large: hang every larger neighbour of u on the
    least of u and its neighbours. Small: the same for the neighbours not
    larger than u, and for u itself."""
    if large:
        both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        both = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("u2"), F.least("u", "m").alias("m"))
    hung = both.join(least, F.col("u") == F.col("u2"))
    if large:
        out = hung.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = hung.select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select(F.col("u2").alias("u"), F.col("m").alias("v")))
    return out.filter("u <> v").distinct()


def connected_components(links: DataFrame) -> DataFrame:
    """``links`` (u, v) of ids -> (u, component): every id that has a link to
    another one, with the least id of its component. Null ids, loops and
    repeated links are ignored."""
    links = written(links.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v"))
                    .filter("u is not null and v is not null and u <> v").distinct(), "links")
    state = None
    while True:
        links = written(_star(_star(links, large=True), large=False), "links")
        now = links.agg(F.count(F.lit(1)), F.sum(F.pmod(F.xxhash64("u", "v"), F.lit(1 << 40)))).first()
        if now == state:
            return links.select("u", F.col("v").alias("component"))
        state = now

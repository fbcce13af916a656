"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from routepulse.session import stage


def components(links: DataFrame) -> DataFrame:
    """node, component (its smallest node) for every node of ``links`` (a, b).

    Links may repeat and stand in either direction; NULLs and loops are left out. Every
    step is written to the staging folder; only two numbers per step reach the driver.
    """
    a, b = F.col("a"), F.col("b")
    edges = links.where(a != b).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()
    edges = stage(edges, "links")
    before = None
    while True:
        # large-star: every node hands the smallest node around it to its larger neighbours
        both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("m", "u").alias("m"))
        stars = both.join(least, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # small-star: every node joins its smaller neighbours, and itself, to the smallest
        least = stars.groupBy("u").agg(F.min("v").alias("m"))
        ends = F.array(F.struct(F.col("u")), F.struct(F.col("v").alias("u")))
        joined = stars.join(least, "u").select(F.explode(ends).alias("e"), "m").select(F.col("e.u").alias("u"), F.col("m").alias("v"))
        edges = stage(joined.where(F.col("u") != F.col("v")).distinct(), "links")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(roots)

"""Connected components of a table of links, by repeated contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepool.llm.common import materialize


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b: long); equal roots mean connected.

    Each round every node joins the neighbour (or itself) that comes first in an order drawn anew by
    round, and links are rewritten between the joined nodes; chains and stars shrink by a constant factor at
    least, on average. Rounds go through tables in the shared folder; nothing reaches the driver but
    the number of links left.
    """
    links = materialize(links.select("a", "b").filter("a <> b").distinct(), "links")
    roots = links.select(F.explode(F.array("a", "b")).alias("node")).distinct().withColumn("root", F.col("node"))
    turn = 0
    while links.limit(1).count():
        turn += 1
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))

        def drawn(c: str, turn=turn):
            return F.struct(F.xxhash64(F.lit(turn), F.col(c)).alias("h"), F.col(c).alias("n"))

        joins = both.groupBy(F.col("a").alias("_n")).agg(F.min(drawn("b")).alias("_best"))
        joins = joins.select("_n", F.least("_best", drawn("_n"))["n"].alias("_to"))
        joins = materialize(joins, "joins")
        left, right = (joins.select(F.col("_n").alias(f"_{c}"), F.col("_to").alias(f"_to_{c}")) for c in "ab")
        links = links.join(left, F.col("a") == F.col("_a")).join(right, F.col("b") == F.col("_b"))
        links = links.select(F.col("_to_a").alias("a"), F.col("_to_b").alias("b")).filter("a <> b").distinct()
        links = materialize(links, "links")
        roots = roots.join(joins, F.col("root") == F.col("_n"), "left")
        roots = materialize(roots.select("node", F.coalesce("_to", "root").alias("root")), "roots")
    return roots

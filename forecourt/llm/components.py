"""Connected components by alternating large-star and small-star steps.

Each step is a minimum per node, joined back: map-side combined, spillable, and
a hub's rows are an ordinary skewed join side that AQE can split.  Every round
is written to the shared folder, so a lost executor costs one round at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forecourt.llm.common import staged
from forecourt.session import drop_path


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("src", "dst").unionAll(edges.select(F.col("dst"), F.col("src")))
    least = both.groupBy(F.col("src").alias("u")).agg(F.min("dst").alias("m"))
    least = least.select("u", F.least("u", "m").alias("m"))
    return (both.join(least, both.src == least.u).filter("dst > src")
            .select(F.col("dst").alias("src"), F.col("m").alias("dst")))


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy(F.col("src").alias("u")).agg(F.min("dst").alias("m"))
    return (edges.join(least, edges.src == least.u)
            .select(F.explode(F.array(F.struct("dst", "m"), F.struct(F.col("src").alias("dst"), "m")))
                    .alias("e")).select(F.col("e.dst").alias("src"), F.col("e.m").alias("dst")))


def _clean(edges: DataFrame) -> DataFrame:
    """Each edge once, from its larger to its smaller node."""
    return (edges.select(F.greatest("src", "dst").alias("src"), F.least("src", "dst").alias("dst"))
            .filter("src <> dst").distinct())


def _stars_only(edges: DataFrame) -> bool:
    """Whether every node names one smaller node at most, and none that does is named:
    then what they name is the smallest node of their component."""
    ends = edges.select(F.explode(F.array(
        F.struct(F.col("src").alias("node"), F.lit(1).alias("names"), F.lit(0).alias("named")),
        F.struct(F.col("dst").alias("node"), F.lit(0).alias("names"), F.lit(1).alias("named")))).alias("e")).select("e.*")
    both = ends.groupBy("node").agg(F.sum("names").alias("names"), F.max("named").alias("named"))
    return both.filter("names > 1 or (names = 1 and named = 1)").isEmpty()


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst",
                         max_rounds: int = 60) -> DataFrame:
    """``node, component`` (smallest node reachable) for every node of ``edges``
    that has another one in its component.

    Null ends, loops and repeated edges are ignored; a node without an edge to
    another node gets no row (it is its own component).  Raises if the rounds
    run out, rather than return components that are not final.
    """
    now, path = staged(_clean(edges.select(F.col(src).cast("long").alias("src"),
                                           F.col(dst).cast("long").alias("dst")).dropna()), "edges")
    for _ in range(max_rounds):
        if _stars_only(now):
            return now.select(F.col("src").alias("node"), F.col("dst").alias("component")).unionAll(
                now.select("dst", "dst").distinct())
        after, new_path = staged(_clean(_small_star(_large_star(now))), "edges")
        drop_path(now.sparkSession, path)
        now, path = after, new_path
    raise RuntimeError("connected components did not settle")

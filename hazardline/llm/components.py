"""Connected components of links by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazardline.llm.common import join_counted, stage


def _renamed(reps: DataFrame, end: str) -> DataFrame:
    return reps.select(F.col("id").alias(end), F.col("rep").alias(f"{end}_rep"), "cnt")


def components(links: DataFrame) -> DataFrame:
    """(id, component): for every id in ``links`` (columns a, b) the smallest id reachable from it.

    In each round every id is represented by the first of itself and its neighbours in some order, and the links
    become links between different representatives.  The first order is that of the ids, which settles stars at once;
    the later ones are hashes, another each round, so chains of any order shrink by a constant factor a round.  At the
    end, representatives are followed back through the rounds.  All of it stays in tables: neither links nor
    components come to the driver.
    """
    edges, rounds = links.where("a <> b").select("a", "b"), []
    while not rounds or not edges.isEmpty():
        rank = (lambda c, i=len(rounds): F.xxhash64(F.lit(i), c) if i else F.col(c))
        ends = edges.union(edges.select("b", "a")).toDF("id", "x")
        reps = ends.groupBy("id").agg(F.min_by("x", rank("x")).alias("x"), F.count(F.lit(1)).alias("cnt"))
        reps = stage(reps.select("id", F.when(rank("x") < rank("id"), F.col("x")).otherwise(F.col("id")).alias("rep"), "cnt"),
                     "representatives")
        rounds.append(reps)
        moved = join_counted(edges, _renamed(reps, "a"), "a", ["a_rep"], "cnt", F.col("b"))
        moved = join_counted(moved, _renamed(reps, "b"), "b", ["b_rep"], "cnt", F.col("a")).where("a_rep <> b_rep")
        edges = stage(moved.select(F.least("a_rep", "b_rep").alias("a"), F.greatest("a_rep", "b_rep").alias("b")).distinct(),
                      "contracted")
    out = rounds[-1].select("id", "rep")
    for reps in rounds[-2::-1]:
        later = out.toDF("rep", "last")
        out = reps.join(later, "rep", "left").select("id", F.coalesce("last", "rep").alias("rep"))
    if len(rounds) == 1:     # in the order of the ids, and nothing left: the representatives are the smallest
        return out.toDF("id", "component")
    out = stage(out, "followed")
    least = stage(out.groupBy("rep").agg(F.min("id").alias("component"), F.count(F.lit(1)).alias("cnt")), "smallest")
    return join_counted(out, least, "rep", ["component"], "cnt", F.col("id")).select("id", "component")

"""Next-page walk."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lotledger.session import Scratch, scratch_dir, written


def _hop(front: DataFrame, links: DataFrame) -> DataFrame:
    """(url): pages one link ahead of the frontier. Of links of one page the smallest counts; no other page's links move."""
    ahead = front.join(links, front["url"] == links["src"]).groupBy("src").agg(F.min("dst").alias("dst"))
    return ahead.select(F.col("dst").alias("url")).distinct()


def walk_chain(
    pages: DataFrame, seeds: DataFrame, max_rounds: int = 40, url: str = "url", next_url: str = "next_url", near: int = 6
) -> DataFrame:
    """(url, step): pages reached from the seeds by following `next_url` until null.

    A page has one next link: of captures that differ, the smallest link counts, so
    that paths never multiply. The first `near` steps expand only the pages that
    the step before found. The frontier meets the narrow written links, so
    with a frontier that Spark broadcasts no link is shuffled, whatever
    their number. Chains that go on double their stride from there: the links of pages
    that are not settled yet are squared round by round, so n further pages take about log2(n) rounds.
    A walk ends once a step finds nothing new, which also ends cycles. Each round
    is written to the shared folder, so the plan stays short and a lost executor
    costs one round; when the walk is over, only its result stays there.
    Running out of rounds with pages still open is an error, not a cut result.
    """
    spark = pages.sparkSession
    links = pages.where(F.col(next_url).isNotNull()).select(F.col(url).alias("src"), F.col(next_url).alias("dst"))
    starts = seeds.select(F.col(url).alias("url")).where(F.col("url").isNotNull()).distinct()
    with Scratch(spark, "chain") as scratch:
        links = scratch.keep(links)
        front = scratch.keep(starts.withColumn("step", F.lit(0).cast("bigint")))
        reached = front
        for step in range(1, near + 1):
            ahead = _hop(front, links).join(reached.select("url"), "url", "left_anti")
            front = scratch.keep(ahead.withColumn("step", F.lit(step).cast("bigint")))
            if front.isEmpty():
                return written(reached, scratch_dir(spark, "walked"))
            reached = reached.unionByName(front)
        settled = reached.where(F.col("step") < near).select(F.col("url").alias("src"))
        single = links.groupBy("src").agg(F.min("dst").alias("dst"))
        jump = scratch.keep(single.join(settled, "src", "left_anti"))
        reached = scratch.keep(reached)
        count = reached.count()
        for k in range(max_rounds):
            # Pages before the frontier have no jump, so they are never expanded again.
            ahead = reached.join(jump, reached["url"] == jump["src"]).select(
                F.col("dst").alias("url"), (F.col("step") + (1 << k)).alias("step")
            )
            reached = scratch.keep(reached.unionByName(ahead).groupBy("url").agg(F.min("step").alias("step")))
            before, count = count, reached.count()
            if count == before:
                return written(reached, scratch_dir(spark, "walked"))
            on = jump.select(F.col("src").alias("mid"), F.col("dst").alias("end"))
            jump = scratch.keep(jump.join(on, F.col("dst") == F.col("mid")).select("src", F.col("end").alias("dst")))
    raise RuntimeError(f"chain still open after {max_rounds} rounds")

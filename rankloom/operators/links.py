"""Link resolution and edge tables that stay balanced when one page has most of the links."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

EDGES_PER_SLICE = 1_000_000
#: Edges that are worth a task of their own in each round.
EDGES_PER_TASK = 50_000


def resolve_links(pages: DataFrame, titles: DataFrame) -> DataFrame:
    """(src, dst, pos): out-link titles turned into document ids, unknown titles dropped."""
    wanted = pages.select(F.col("doc_id").alias("src"), F.posexplode("out_links").alias("pos", "title"))
    return wanted.join(titles.select(F.col("doc_id").alias("dst"), "title"), "title").select("src", "dst", "pos")


def adjacency(links: DataFrame) -> DataFrame:
    """(id, links): targets in link order; a list never exceeds the links of one page."""
    ordered = F.array_sort(F.collect_list(F.struct("pos", "dst")))
    return links.groupBy(F.col("src").alias("id")).agg(F.transform(ordered, lambda e: e["dst"]).alias("links"))


@dataclass
class SlicedEdges:
    """Edges co-partitioned by (src, slice); sources with many links own several slices.

    ``sources`` is (src, out_degree, slices). A per-source value is joined by ``scatter`` after
    being repeated once per slice, so no task holds more than one slice of a source.
    """

    sources: DataFrame
    edges: DataFrame
    tasks: int

    @classmethod
    def build(cls, links: DataFrame, edges_per_slice: int = EDGES_PER_SLICE) -> SlicedEdges:
        """Cut the edges; they are kept in memory or on executor disks and can be recomputed."""
        spark = links.sparkSession
        sources = links.groupBy("src").agg(F.count("*").alias("out_degree")).withColumn(
            "slices", F.ceil(F.col("out_degree") / edges_per_slice).cast("int")
        )
        split = sources.filter(F.col("slices") > 1).select("src", "slices")
        # As many tasks as the edges need: rounds over few edges would spend their time on starting empty ones.
        tasks = max(1, min(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-links.count() // EDGES_PER_TASK)))
        edges = (
            links.join(split, "src", "left")
            .select("src", "dst", F.coalesce(
                F.pmod(F.xxhash64("dst"), F.col("slices")).cast("int"), F.lit(0)).alias("slice"))
            .repartition(tasks, "src", "slice").persist()
        )
        return cls(sources, edges, tasks)

    def scatter(self, values: DataFrame) -> DataFrame:
        """Join ``values`` (src, slices, ...) with their edges."""
        repeated = values.withColumn("slice", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)))
        return repeated.join(self.edges, ["src", "slice"])

    def beside(self, table: DataFrame) -> DataFrame:
        """``table`` in one partition if the edges are, so that joining them needs no shuffle."""
        return table.coalesce(1) if self.tasks == 1 else table

    def release(self) -> None:
        self.edges.unpersist()

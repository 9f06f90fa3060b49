"""Link graph, PageRank and breadth-first crawl order.

PageRank is a DataFrame loop over two tables bucketed alike by (source, salt): the edges with their weights 1/outdeg,
written once, and the ranks, written by every step.  A step joins them bucket by bucket, so neither is exchanged;
only the sums per target cross the network.  A source with very many links is split over several buckets (salted by
target).  One aggregate per step gives the largest change and the dangling mass.  The tables are dropped when the
ranks are written.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.session import reliable_checkpoint, remove_path, scratch_path, tasks_for


def link_graph(nodes: DataFrame, links: DataFrame, keep_self_links: bool = False) -> tuple[DataFrame, DataFrame]:
    """GRF-1 / JN-8 / SET-3: every node kept; edges distinct, target known, self-links dropped.

    ``nodes`` has ``id``; ``links`` has ``src``, ``dst``.
    """
    node_ids = nodes.select("id").distinct()
    edges = links.select("src", "dst")
    if not keep_self_links:
        edges = edges.where(F.col("src") != F.col("dst"))
    # Links are made distinct first, by as many tasks as they need; the joins then stream them past hash tables of nodes,
    # so no task sorts its links or gathers them in an aggregate that grows with the input.
    edges = reliable_checkpoint(edges, "links")
    if tasks := tasks_for(edges.sparkSession, edges.count()):
        edges = edges.repartition(tasks, "src", "dst")
    edges = edges.distinct()
    for end in ("src", "dst"):
        edges = edges.join(node_ids.withColumnRenamed("id", end).hint("shuffle_hash"), end, "left_semi")
    return node_ids, edges.select("src", "dst")


# Links of one source in one bucket; a source with more is split.
LINKS_PER_BUCKET = 100_000


@dataclass
class BucketedTable:
    """A written table of the session's catalog, bucketed by (src, salt), that lives until it is dropped."""

    spark: SparkSession
    name: str
    path: str

    @classmethod
    def write(cls, df: DataFrame, kind: str, buckets: int) -> BucketedTable:
        spark = df.sparkSession
        made = cls(spark, f"quarry_{kind}_{uuid.uuid4().hex[:12]}", scratch_path(spark, kind))
        try:
            df.write.format("parquet").bucketBy(buckets, "src", "salt").option("path", made.path).saveAsTable(made.name)
        except BaseException:
            made.drop()
            raise
        return made

    @property
    def frame(self) -> DataFrame:
        return self.spark.table(self.name)

    def drop(self) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")
        remove_path(self.spark, self.path)


def _parts(outdeg: str) -> F.Column:
    """Buckets' keys of a source: 0 without links."""
    return F.coalesce(F.ceil(F.col(outdeg) / LINKS_PER_BUCKET), F.lit(0).cast("long"))


def _salts(parts: str) -> F.Column:
    return F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.col(parts), F.lit(1).cast("long")) - 1)).alias("salt")


def bucketed_edges(edges: DataFrame, outdeg: DataFrame, buckets: int) -> BucketedTable:
    """src, salt, dst, wt (1/outdeg), dst_parts (keys that the target stands under), bucketed by (src, salt)."""
    outdeg = outdeg.hint("shuffle_hash")       # its rows are nodes; the links stream past and are not sorted
    weighted = (edges.join(outdeg, "src")
                .select("src", F.pmod(F.xxhash64("dst"), _parts("outdeg")).alias("salt"), "dst", (1.0 / F.col("outdeg")).alias("wt"))
                .join(outdeg.select(F.col("src").alias("dst"), _parts("outdeg").alias("dst_parts")), "dst", "left")
                .select("src", "salt", "dst", "wt", F.coalesce("dst_parts", F.lit(0).cast("long")).alias("dst_parts")))
    return BucketedTable.write(weighted.repartition(buckets, "src", "salt"), "edges", buckets)


def first_ranks(node_ids: DataFrame, outdeg: DataFrame, n: int, buckets: int) -> BucketedTable:
    """src (a page), salt, parts, dangling, prev, rank = 1/N: a page stands once under each of its keys."""
    state = (node_ids.withColumnRenamed("id", "src").join(outdeg, "src", "left")
             .select("src", F.col("outdeg").isNull().alias("dangling"), _parts("outdeg").alias("parts"),
                     F.lit(None).cast("double").alias("prev"), F.lit(1.0 / n).alias("rank"))
             .select("src", _salts("parts"), "parts", "dangling", "prev", "rank"))
    return BucketedTable.write(state.repartition(buckets, "src", "salt"), "ranks", buckets)


def rank_step(edges: DataFrame, state: DataFrame, decay: float, share: float, base: float) -> DataFrame:
    """The next ranks: decay * (sum over in-links + ``share`` of the dangling mass) + ``base``."""
    sent = edges.join(state.select("src", "salt", "rank"), ["src", "salt"])
    sums = sent.groupBy("dst").agg(F.sum(F.col("rank") * F.col("wt")).alias("c"), F.max("dst_parts").alias("dst_parts"))
    received = sums.select(F.col("dst").alias("src"), _salts("dst_parts"), "c")
    return (state.select("src", "salt", "parts", "dangling", F.col("rank").alias("prev")).join(received, ["src", "salt"], "left")
            .select("src", "salt", "parts", "dangling", "prev",
                    (F.lit(decay) * (F.coalesce("c", F.lit(0.0)) + F.lit(share)) + F.lit(base)).alias("rank")))


def pagerank(nodes: DataFrame, edges: DataFrame, decay: float = 0.85, epsilon: float = 1e-4, limit: int = 200) -> DataFrame:
    """GRF-2: (id, rank).

    new(p) = decay * (sum over q->p of old(q)/outdeg(q) + dangling/N) + (1 - decay)/N.
    Stops when every |new - old| <= epsilon and then returns the ranks from *before* that step;
    after ``limit`` steps returns the latest ranks; limit 0 returns 1/N.  Ranks shrink with the number
    of pages, so pass an epsilon that is a share of 1/N for large graphs.
    """
    spark = nodes.sparkSession
    node_ids = reliable_checkpoint(nodes.select("id").distinct(), "nodes")
    n = node_ids.count()
    if n == 0:
        return node_ids.withColumn("rank", F.lit(0.0))
    edges = reliable_checkpoint(edges, "links")
    # A bucket is one task of every step: their number follows the links.
    buckets = tasks_for(spark, edges.count()) or int(spark.conf.get("spark.sql.shuffle.partitions"))
    outdeg = reliable_checkpoint(edges.groupBy("src").agg(F.count(F.lit(1)).alias("outdeg")), "outdeg")
    tables = [bucketed_edges(edges, outdeg, buckets)]
    try:
        tables.append(first_ranks(node_ids, outdeg, n, buckets))
        one = F.col("salt") == 0               # a page's first row; its others repeat the rank
        mass = F.coalesce(F.sum(F.when(one & F.col("dangling"), F.col("rank"))), F.lit(0.0)).alias("dm")
        dangling = tables[-1].frame.agg(mass).first()["dm"]
        answer = "rank"
        for _ in range(limit):
            step = rank_step(tables[0].frame, tables[-1].frame, decay, dangling / n, (1.0 - decay) / n)
            tables.append(BucketedTable.write(step, "ranks", buckets))
            tables.pop(1).drop()
            stats = tables[-1].frame.agg(F.max(F.abs(F.col("rank") - F.col("prev"))).alias("delta"), mass).first()
            if stats["delta"] <= epsilon:
                answer = "prev"
                break
            dangling = stats["dm"]
        return reliable_checkpoint(tables[-1].frame.where(one).select(F.col("src").alias("id"), F.col(answer).alias("rank")), "pagerank")
    finally:
        for table in tables:
            table.drop()


def rank_of(ranks: DataFrame, ids: DataFrame) -> DataFrame:
    """GRF-3: rank lookup; an unknown id raises."""
    return (ids.select("id").join(ranks, "id", "left")
            .select("id", F.when(F.col("rank").isNull(), F.raise_error(F.lit("unknown page")))
                    .otherwise(F.col("rank")).alias("rank")))


def bfs_order(edges: DataFrame, seeds: DataFrame, limit: int, allow=None, visited: DataFrame | None = None) -> DataFrame:
    """GRF-4 / JN-9 / LIM-1 / SRT-7: visit order by (distance, id), at most ``limit`` nodes.

    Level-synchronous breadth-first search: each level joins the frontier to the edges, drops
    nodes already reached (anti join with every earlier level) and keeps the smallest distance per
    node.  ``allow`` filters candidates: a Column predicate on ``id``, or a function from a frame with
    ``id`` to the rows that may be fetched (host whitelist, robots and extension filters are joins);
    nodes that fail it are neither visited, counted nor expanded.  ``visited`` (column ``id``) holds
    nodes fetched in an earlier run; they are skipped.  Each level is written once.  Stops as soon
    as the visited count reaches ``limit`` or the frontier is empty.
    """
    if limit < 0:
        raise ValueError("limit must be non-negative")

    def admitted(level: DataFrame) -> DataFrame:
        if visited is not None:
            level = level.join(visited.select("id"), "id", "left_anti")
        if allow is not None:
            level = allow(level) if callable(allow) else level.where(allow)
        return level.select("id")

    levels = [reliable_checkpoint(admitted(seeds.select("id").distinct()).withColumn("distance", F.lit(0)), "level")]
    count = size = levels[0].count()
    reached = levels[0]
    while count < limit and size:
        nxt = (edges.join(levels[-1].select(F.col("id").alias("src")), "src")
               .select(F.col("dst").alias("id")).distinct()
               .join(reached.select("id"), "id", "left_anti"))
        levels.append(reliable_checkpoint(admitted(nxt).withColumn("distance", F.lit(len(levels))), "level"))
        reached = reached.unionByName(levels[-1])
        size = levels[-1].count()
        count += size
    return reached.orderBy("distance", "id").limit(limit)

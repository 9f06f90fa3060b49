"""GRF-4 / JN-9 / LIM-1 / SRT-7 / SRC-9 / SNK-4 / Q-12: a breadth-first crawl over a stored link table that can stop and resume.

Every level is a written table under the state folder, and a level counts when its write was completed.  A run
reads the completed levels, goes on from the last one, and stops when enough URIs are admitted or none is left; run again,
with a larger limit or after a fault, it does not repeat a level.  URIs are normalised before anything else, so each is
admitted, counted and expanded once whatever its spellings.  Admission is made of tables: allowed hosts, robots rules
by host, visited URIs of an earlier crawl, and a list of file extensions.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions.urls import normalised
from quarry.operators import web
from quarry.operators.ordinals import with_ordinal
from quarry.sources.files import _exists

LEVEL = "uri string, distance int"


@dataclass(frozen=True)
class Admission:
    """What may be fetched; None admits all.  ``hosts``: host; ``robots``: host, kind, pattern; ``visited``: id."""

    hosts: DataFrame | None = None
    robots: DataFrame | None = None
    extensions: Sequence[str] | None = None
    visited: DataFrame | None = None

    def of(self, uris: DataFrame) -> DataFrame:
        if self.visited is not None:
            earlier = self.visited.select(normalised("id").alias("uri")).where("uri IS NOT NULL")
            uris = uris.join(earlier, "uri", "left_anti")
        if self.extensions is not None:
            uris = uris.where(~web.urls.url_subject("uri").rlike(web.extension_pattern(list(self.extensions))))
        if self.hosts is not None:
            uris = web.host_allowed(uris, self.hosts, "uri")
        if self.robots is not None:
            uris = web.robots_filter(uris, self.robots, "uri", keep=True)
        return uris.select("uri")


def _level(state: str, n: int) -> str:
    return f"{state}/level-{n:06d}"


def completed_levels(spark: SparkSession, state: str) -> int:
    """Levels whose write was completed, from 0 on without a gap."""
    n = 0
    while _exists(spark, f"{_level(state.rstrip('/'), n)}/_SUCCESS"):
        n += 1
    return n


def reached(spark: SparkSession, state: str, levels: int) -> DataFrame:
    """uri, distance of the first ``levels`` levels: the log of what was visited."""
    if not levels:
        return spark.createDataFrame([], LEVEL)
    return spark.read.schema(LEVEL).parquet(*[_level(state.rstrip("/"), n) for n in range(levels)])


def crawl(links: DataFrame, seeds: DataFrame, state: str, limit: int, admission: Admission = Admission()) -> DataFrame:
    """uri, distance, pos: at most ``limit`` admitted URIs by (distance, uri).

    ``links``: src_uri, dst_uri; ``seeds``: uri.  Links and seeds are those of the first run on a state folder: the
    normalised links are kept in it.  URIs that are null or not absolute are nowhere.
    """
    if limit < 0:
        raise ValueError("limit must be non-negative")
    spark, state = links.sparkSession, state.rstrip("/")
    if not _exists(spark, f"{state}/links/_SUCCESS"):
        pairs = links.select(normalised("src_uri").alias("src"), normalised("dst_uri").alias("dst"))
        pairs.where("src IS NOT NULL AND dst IS NOT NULL").distinct().write.mode("overwrite").parquet(f"{state}/links")
    edges = spark.read.schema("src string, dst string").parquet(f"{state}/links")

    def write(uris: DataFrame, n: int) -> None:
        admission.of(uris).withColumn("distance", F.lit(n)).write.mode("overwrite").parquet(_level(state, n))

    done = completed_levels(spark, state)
    if not done:
        write(seeds.select(normalised("uri").alias("uri")).where("uri IS NOT NULL").distinct(), 0)
        done = 1
    count = reached(spark, state, done).count()
    size = spark.read.schema(LEVEL).parquet(_level(state, done - 1)).count()
    while count < limit and size:
        last = spark.read.schema(LEVEL).parquet(_level(state, done - 1)).select(F.col("uri").alias("src"))
        found = (edges.join(last, "src").select(F.col("dst").alias("uri")).distinct()
                 .join(reached(spark, state, done).select("uri"), "uri", "left_anti"))
        write(found, done)
        size = spark.read.schema(LEVEL).parquet(_level(state, done)).count()
        count, done = count + size, done + 1
    first = reached(spark, state, done).orderBy("distance", "uri").limit(limit)
    return with_ordinal(first, ["distance", "uri"], "pos").select("uri", "distance", "pos")

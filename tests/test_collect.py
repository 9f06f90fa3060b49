"""User-defined aggregates against built-in ones, with a hot group, nulls and empty tables."""

import json
import struct

import pytest
from pyspark.sql import functions as F

from quarry.operators import collect as c

SPREAD = c.Collector(
    start=lambda: struct.pack("<qq", 0, 0),
    add=lambda s, vs: struct.pack("<qq", *(a + b for a, b in zip(struct.unpack("<qq", s), (len(vs), sum(v or 0 for v in vs)), strict=True))),
    merge=lambda a, b: struct.pack("<qq", *(x + y for x, y in zip(struct.unpack("<qq", a), struct.unpack("<qq", b), strict=True))),
    finish=lambda s: dict(zip(("n", "total"), struct.unpack("<qq", s), strict=True)), result="n long, total long")
AS_SET = c.Collector(
    start=lambda: b"[]", add=lambda s, vs: json.dumps(sorted(set(json.loads(s)) | set(vs))).encode(),
    merge=lambda a, b: json.dumps(sorted(set(json.loads(a)) | set(json.loads(b)))).encode(),
    finish=lambda s: {"items": json.loads(s)}, result="items array<long>")


@pytest.fixture(scope="module")
def table(spark):
    key = F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 50 == 1, F.lit(None)).otherwise(F.concat(F.lit("k"), F.col("id") % 40))
    return spark.range(30_000).select(key.alias("k"), (F.col("id") % 2).alias("j"), F.when(F.col("id") % 7 != 0, F.col("id") % 100).alias("v")).repartition(6)


@pytest.mark.parametrize("salts", [1, 5])
def test_equal_to_built_in_aggregates(spark, table, salts):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    try:
        got = sorted(map(tuple, c.collect(table, ["k", "j"], "v", SPREAD, salts).collect()), key=repr)
        sets = {r.k: r["items"] for r in c.collect(table.where("v IS NOT NULL"), ["k"], "v", AS_SET, salts).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    want = table.groupBy("k", "j").agg(F.count(F.lit(1)), F.sum(F.coalesce("v", F.lit(0)))).collect()
    assert got == sorted(map(tuple, want), key=repr)
    assert sets == {r.k: r.s for r in table.where("v IS NOT NULL").groupBy("k").agg(F.sort_array(F.collect_set("v")).alias("s")).collect()}


def test_a_hot_group_is_split_before_it_is_merged(table):
    plan = c.collect(table, ["k"], "v", SPREAD)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 3 and "hashpartitioning(k" in plan and "_salt" in plan
    assert c.collect(table.limit(0), ["k"], "v", SPREAD).count() == 0

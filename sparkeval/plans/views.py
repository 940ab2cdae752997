"""The same evaluation views as DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkeval.functions.vectors import cosine
from sparkeval.session import table


def line(spark: SparkSession, sf: str) -> DataFrame:
    """Line items, one per (order, line): the smallest row wins.

    A map-side combining minimum, so a hot order never lands whole in one task.
    """
    rest = ["l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_discount", "l_tax", "l_shipdate",
            "l_returnflag", "l_linestatus"]
    keys = ["l_orderkey", "l_linenumber"]
    return table(spark, sf, "lineitem").groupBy(*keys).agg(F.min(F.struct(*rest)).alias("r")).select(*keys, "r.*")


def det_gt(spark: SparkSession, sf: str) -> DataFrame:
    return line(spark, sf).selectExpr(
        "l_orderkey AS image_id", "l_linenumber AS gt_idx", "l_returnflag AS label",
        "CAST(l_partkey % 40 AS DOUBLE) AS x1", "CAST(l_suppkey % 40 AS DOUBLE) AS y1",
        "CAST(l_partkey % 40 AS DOUBLE) + 10 + l_quantity AS x2",
        "CAST(l_suppkey % 40 AS DOUBLE) + 10 + l_quantity AS y2",
        "l_partkey % 11 = 0 AS is_ignored", "l_linestatus AS stratum",
    )


def det_inf(spark: SparkSession, sf: str, gt: DataFrame | None = None) -> DataFrame:
    """Inferences around the ground truths, which a caller that has written them passes in."""
    gt = det_gt(spark, sf) if gt is None else gt
    shifted = gt.where("(CAST(y1 AS INT) + gt_idx) % 9 <> 0").selectExpr(
        "image_id", "gt_idx * 10 AS inf_idx",
        "CASE WHEN (gt_idx + CAST(x1 AS INT)) % 6 = 0 THEN CASE label WHEN 'A' THEN 'N' WHEN 'N' THEN 'R' ELSE 'A' END"
        " ELSE label END AS label",
        "x1 + gt_idx % 4 AS x1", "y1 + gt_idx % 3 AS y1", "x2 + gt_idx % 4 AS x2", "y2 + gt_idx % 3 AS y2",
        "CAST((image_id * 31 + gt_idx * 17 + CAST(x1 AS INT) * 7) % 1000 AS DOUBLE) / 1000 AS score", "stratum",
    )
    spurious = gt.where("CAST(x1 AS INT) % 5 = 0").selectExpr(
        "image_id", "gt_idx * 10 + 1 AS inf_idx", "label", "x1 + 2 AS x1", "y1 + 60 AS y1", "x2 + 2 AS x2",
        "y2 + 60 AS y2", "CAST((image_id * 13 + gt_idx * 29) % 1000 AS DOUBLE) / 1000 AS score", "stratum",
    )
    return shifted.unionByName(spurious)


def cls(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").selectExpr(
        "l_orderkey AS order_id", "l_linenumber AS line", "l_returnflag AS gt",
        "CASE l_partkey % 5 WHEN 0 THEN 'A' WHEN 1 THEN 'N' WHEN 2 THEN 'R' ELSE l_returnflag END AS pred",
        "CAST((l_orderkey * 7 + l_linenumber * 13) % 100 AS DOUBLE) / 100 AS score", "l_linestatus AS stratum",
    )


def binary(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "n_chars", "lang")
    return table(spark, sf, "labels").join(docs, "doc_id").selectExpr(
        "doc_id", "quality = 1 AS gt", "CAST((n_chars * 7 + quality * 400) % 1000 AS DOUBLE) / 1000 AS score",
        "lang AS stratum",
    )


def reg(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").selectExpr(
        "l_orderkey AS order_id", "l_linenumber AS line", "l_extendedprice AS gt",
        "l_extendedprice * 0.9D + l_quantity * 10 - l_discount * 100 AS pred", "l_quantity AS weight",
        "l_returnflag AS stratum",
    )


def dp(spark: SparkSession, sf: str) -> DataFrame:
    customers = table(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderpriority", "o_totalprice")
    return orders.join(customers, F.expr("o_custkey = c_custkey")).selectExpr(
        "o_orderkey AS id", "c_mktsegment AS segment", "o_orderpriority AS priority", "o_totalprice AS price"
    )


def res(spark: SparkSession, sf: str) -> DataFrame:
    points = dp(spark, sf)
    a = points.selectExpr("'a' AS model", "CAST(NULL AS STRING) AS eval_config", "id",
                          "CAST(id % 97 AS DOUBLE) / 97 AS score", "id % 3 AS tp", "id % 2 AS fp", "id % 5 AS fn")
    b = points.where("id % 3 <> 0").selectExpr(
        "'b' AS model", "'{\"threshold\": 0.5}' AS eval_config", "id", "CAST(id % 89 AS DOUBLE) / 89 AS score",
        "(id + 1) % 3 AS tp", "(id + 1) % 2 AS fp", "(id + 2) % 5 AS fn",
    )
    return a.unionByName(b)


def ver(spark: SparkSession, sf: str, version: int) -> DataFrame:
    """Datapoints of one dataset version."""
    points = dp(spark, sf).select("id", "segment", "price")
    if version == 1:
        return points.where("id % 4 <> 0")
    if version == 2:
        return points.where("id % 4 <> 1").withColumn("price", F.expr("CASE WHEN id % 10 = 1 THEN price + 1 ELSE price END"))
    return points.where("id % 4 <> 2")


def txt(spark: SparkSession, sf: str) -> DataFrame:
    turns = table(spark, sf, "conversations").select("conv_id", "turn", "text")
    answer = turns.selectExpr("conv_id", "turn - 1 AS turn", "lower(text) AS cand")
    return turns.selectExpr("conv_id", "turn", "lower(text) AS ref").join(answer, ["conv_id", "turn"])


def seg(spark: SparkSession, sf: str, side: str | None = None) -> DataFrame:
    events = table(spark, sf, "events").select("event_id", "user_id", "event_type", "value")
    ref = events.selectExpr("'ref' AS side", "user_id AS recording", "event_type AS speaker", "event_id",
                            "CAST(event_id % 500 AS DOUBLE) AS s", "event_id % 500 + 1 + value / 20 AS e")
    hyp = events.where("event_id % 11 <> 0").selectExpr(
        "'hyp' AS side", "user_id AS recording", "CASE WHEN event_id % 7 = 0 THEN 'view' ELSE event_type END AS speaker",
        "event_id", "event_id % 500 + CAST(event_id % 3 AS DOUBLE) / 4 AS s",
        "event_id % 500 + 1 + value / 20 + CAST(event_id % 4 AS DOUBLE) / 4 AS e",
    )
    return {"ref": ref, "hyp": hyp}[side] if side else ref.unionByName(hyp)


def vectors(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "embeddings").withColumn("embedding", F.col("embedding").cast("array<double>"))


def mask(spark: SparkSession, sf: str) -> DataFrame:
    """One row per image: ground-truth mask, probabilities and intensities as arrays."""
    v = vectors(spark, sf)
    nxt = v.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("nxt"))
    one = F.lit(1.0)
    return v.join(nxt, "vec_id", "left").select(
        F.col("vec_id").alias("image_id"),
        F.transform("embedding", lambda x: x > 0).alias("gt"),
        F.transform("nxt", lambda x: F.least(one, F.greatest(F.lit(0.0), 0.5 + 2 * x))).alias("prob"),
        F.transform("embedding", lambda x: F.least(F.lit(255.0), F.greatest(F.lit(0.0), 128 + 512 * x))).alias("intensity"),
    )


def pair(spark: SparkSession, sf: str, reach: int = 20) -> DataFrame:
    """Vector pairs at most ``reach`` ids apart: an equi-join on the shifted id."""
    v = vectors(spark, sf)
    left = v.select("vec_id", F.col("label").alias("la"), F.col("embedding").alias("ea"),
                    F.explode(F.sequence(F.lit(1), F.lit(reach))).alias("step"))
    left = left.select(F.col("vec_id").alias("a"), (F.col("vec_id") + F.col("step")).alias("b"), "la", "ea")
    right = v.select(F.col("vec_id").alias("b"), F.col("label").alias("lb"), F.col("embedding").alias("eb"))
    return left.join(right, "b").select("a", "b", F.expr("la = lb").alias("is_match"), cosine("ea", "eb").alias("similarity"))

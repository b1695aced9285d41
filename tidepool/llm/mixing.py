"""Mixing sources to target weights along a time-varying curriculum.

Each source has a weight schedule over training time 0 .. 1, linear between knots. Its integral
up to t, scaled to the source's target, is the number of words the source has to have delivered
by t. Documents queue up in a fixed random order per source (around again when the target
exceeds the source); a document's copy is placed at the time at which the cumulative demand
reaches the middle of its words. Sorting all copies by that time gives the training order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidepool.llm.common import WORD, hash60, running_before, text_of

WEIGHTS = (5.0, 2.0, 1.0)
TOTAL = 1.5
CAP = 2.0
#: Weight schedules at t = 0, 0.5, 1, by place in WEIGHTS: heavy sources early, light ones late.
KNOTS = (0.0, 0.5, 1.0)
SCHEDULES = ((1.5, 1.0, 0.5), (1.0, 1.0, 1.0), (0.5, 1.0, 1.5))


def n_words(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def targets(sizes: DataFrame, weights=WEIGHTS, total: float = TOTAL, cap: float = CAP) -> DataFrame:
    """``sizes`` (source, source_size; one row per source) plus place and target.

    Sources by code point, null last, take the weights in turn. They share total x all sizes by
    weight; a target stops at cap x its source and the excess is reshared until none is above:
    target = least(cap size, level weight) for the one level that spends the total.

    The windows see one row per source, the aggregate of its documents.
    """
    w = F.array(*map(F.lit, map(float, weights)))
    rows = sizes.withColumn("place", F.pmod(F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1,
                                            F.lit(len(weights))).cast("int"))
    rows = rows.withColumn("_w", F.get(w, F.col("place"))).withColumn("_cap", cap * F.col("source_size"))
    by_ratio = Window.orderBy(F.col("_cap") / F.col("_w"), F.col("source").asc_nulls_last())
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_ratio.rowsBetween(0, Window.unboundedFollowing)
    all_rows = Window.partitionBy()
    rows = rows.withColumn("_level", (total * F.sum("source_size").over(all_rows)
                                      - F.coalesce(F.sum("_cap").over(before), F.lit(0.0))) / F.sum("_w").over(onward))
    # The first source (by ratio) that the level does not fill sets it; if all are filled, their caps hold.
    level = F.min(F.when(F.col("_cap") >= F.col("_level") * F.col("_w"), F.struct(F.col("_cap") / F.col("_w"), "_level"))
                  ).over(all_rows)["_level"]
    return rows.withColumn("target", F.coalesce(F.least(F.col("_cap"), level * F.col("_w")), F.col("_cap"))).select(
        "source", "source_size", "place", "target")


def demand_time(share: Column, schedule: Column, knots=KNOTS) -> Column:
    """The time at which the scaled integral of a schedule reaches ``share`` (0 .. 1)."""
    segments = range(len(knots) - 1)
    at = [F.get(schedule, F.lit(k)) for k in range(len(knots))]
    area = [(at[k] + at[k + 1]) / 2.0 * (knots[k + 1] - knots[k]) for k in segments]
    upto = [F.lit(0.0)]
    for a in area:
        upto.append(upto[-1] + a)
    want = share * upto[-1]
    out = None
    for k in reversed(segments):
        width = knots[k + 1] - knots[k]
        need = F.greatest(want - upto[k], F.lit(0.0))
        slope = (at[k + 1] - at[k]) / width
        # slope x^2 / 2 + at x = need, in the form that holds for slope 0
        root = F.sqrt(F.greatest(at[k] * at[k] + 2.0 * slope * need, F.lit(0.0)))
        x = F.lit(knots[k]) + F.least(F.lit(width), F.when(at[k] + root > 0, 2.0 * need / (at[k] + root)).otherwise(0.0))
        out = x if out is None else F.when(want < upto[k + 1], x).otherwise(out)
    return out


def mix(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", weights=WEIGHTS,
        total: float = TOTAL, cap: float = CAP, schedules=SCHEDULES, knots=KNOTS, seed: int = 0) -> DataFrame:
    """One row per document: key, size, text_crc32, source, source_size, target, copies, taken
    (copies x size), positions (training times of the copies, ascending).

    A copy is taken if the middle of its words comes before the target, so a source is off its
    target by half a document at most and no document is taken more than ``cap`` times, rounded up.
    The queue is ordered by a hash of key and seed, then key and text: reruns agree. Null and empty
    texts have size 0 (they queue, but bring no words); null sources are one source; a source without
    words has target 0 and no copies. Repeated rows queue one after the other.
    """
    body = text_of(text)
    light = docs.select(F.col(key).alias("_key"), n_words(body).alias("size"), F.col(source).alias("_source"),
                        F.crc32(body.cast("binary")).alias("text_crc32"),
                        hash60(F.col(key), F.lit(seed)).alias("_draw"))
    queue = running_before(light, ["_source"], ["_draw", "_key", "text_crc32"], {"_ahead": "size"})
    sizes = queue.groupBy(F.col("_source").alias("source")).agg(F.sum("size").alias("source_size"))
    plan = targets(sizes, weights, total, cap)
    plan = plan.withColumn("_schedule", F.get(F.array(*(F.array(*map(F.lit, map(float, s))) for s in schedules)),
                                              F.pmod(F.col("place"), F.lit(len(schedules)))))
    rows = queue.join(plan, F.col("_source").eqNullSafe(F.col("source")))
    middle = F.col("_ahead") + F.col("size") / 2.0
    copies = F.when(F.col("source_size") > 0, F.greatest(
        F.lit(0), F.ceil(F.try_divide(F.col("target") - middle, F.col("source_size"))))).otherwise(0).cast("int")
    rows = rows.withColumn("copies", copies).withColumn("_middle", middle)
    place = F.transform(F.sequence(F.lit(0), F.col("copies") - 1), lambda k: demand_time(
        F.try_divide(k * F.col("source_size") + F.col("_middle"), F.col("target")), F.col("_schedule"), knots))
    rows = rows.withColumn("positions", F.when(F.col("copies") > 0, place).otherwise(F.array().cast("array<double>")))
    return rows.select(F.col("_key").alias(key), "size", "text_crc32", F.col("_source").alias(source), "source_size",
                       "target", "copies", (F.col("copies") * F.col("size")).alias("taken"), "positions")


def training_order(docs: DataFrame, mixed: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents' rows, each as often as it was taken, range-sorted by training position.

    Rows are matched by key and text hash; rows repeated in ``docs`` deal their positions among
    themselves, so every position comes out once.
    """
    plan = mixed.groupBy(F.col(key).alias("_key"), F.col("text_crc32").alias("_crc")).agg(
        F.sort_array(F.flatten(F.collect_list("positions"))).alias("_all"), F.count("*").alias("_same"))
    # The row travels as one column, so that no column of it can clash.
    rows = docs.select(F.struct(*docs.columns).alias("_row"), F.col(key).alias("_of"),
                       F.crc32(text_of(text).cast("binary")).alias("_crc_of"))
    rows = rows.join(plan, F.col("_of").eqNullSafe(F.col("_key")) & (F.col("_crc_of") == F.col("_crc")))
    nth = F.row_number().over(Window.partitionBy("_key", "_crc").orderBy("_same")) - 1
    rows = rows.withColumn("_nth", nth)
    mine = F.filter("_all", lambda x, i: F.pmod(i, F.col("_same")) == F.col("_nth"))
    rows = rows.withColumn("_position", F.explode(mine))
    rows = rows.repartitionByRange("_position", "_key").sortWithinPartitions("_position", "_key")
    return rows.select("_row.*")

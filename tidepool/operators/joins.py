"""Two-input operators: interval, window, equi, control-stream and reconciliation joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepool.functions.timecols import bucket_index, epoch_micros
from tidepool.operators.running import Running, range_bucket, running, with_range_buckets


def _shift(ts: Column, us: int) -> Column:
    return F.timestamp_add("MICROSECOND", F.lit(int(us)), ts)


def interval_join(left: DataFrame, right: DataFrame, left_key: str, right_key: str,
                  left_ts: str, right_ts: str, lower_us: int, upper_us: int,
                  bucket_us: int | None = None) -> DataFrame:
    """Inner join where ``right_ts`` lies in ``[left_ts + lower, left_ts + upper]``.

    The key equality makes this a hash/sort-merge join with a range filter
    (AQE splits skewed key partitions).  ``bucket_us`` additionally spreads a
    hot key over time buckets: the left row lives in one bucket, the right row
    is copied to every bucket a partner could be in, so each pair meets once.
    """
    lt, rt = F.col(left_ts), F.col(right_ts)
    cond = ((left[left_key] == right[right_key]) & (rt >= _shift(lt, lower_us))
            & (rt <= _shift(lt, upper_us)))
    if bucket_us is None:
        return left.join(right, cond, "inner")
    lb = left.withColumn("_ib", bucket_index(left_ts, bucket_us))
    first = F.floor((epoch_micros(right_ts) - upper_us) / bucket_us).cast("bigint")
    last = F.floor((epoch_micros(right_ts) - lower_us) / bucket_us).cast("bigint")
    rb = right.withColumn("_rb", F.explode(F.sequence(first, last)))
    cond = ((lb[left_key] == rb[right_key]) & (lb["_ib"] == rb["_rb"])
            & (rt >= _shift(lt, lower_us)) & (rt <= _shift(lt, upper_us)))
    return lb.join(rb, cond, "inner").drop("_ib", "_rb")


def window_join_counts(left: DataFrame, right: DataFrame, key: str, ts: str,
                       size_us: int) -> DataFrame:
    """Window join in factorised form: per (key, tumbling window) the sizes of
    both sides and the number of joined pairs.

    The pairs of a window join are the cross product of the two sides of each
    (key, window) group; a hot group would make that quadratic.  Both sides
    are counted first and the two count tables are joined instead, so work
    and output stay linear in the input.
    """
    w = F.window(ts, f"{size_us // 1_000_000} seconds")

    def side(df: DataFrame, name: str) -> DataFrame:
        return (df.groupBy(key, w.alias("w")).agg(F.count(F.lit(1)).alias(name))
                .select(key, F.col("w.start").alias("window_start"),
                        F.col("w.end").alias("window_end"), name))

    joined = side(left, "n_left").join(side(right, "n_right"),
                                       on=[key, "window_start", "window_end"], how="inner")
    return joined.withColumn("n_pairs", F.col("n_left") * F.col("n_right"))


def latest_control_filter(data: DataFrame, control: DataFrame, ts: str, tiebreak: str,
                          value: str, control_value: str,
                          num_buckets: int | None = None) -> DataFrame:
    """Keep data rows whose ``value`` equals the latest control value at their time.

    An as-of lookup without a range join: both inputs are unioned into one
    event-time ordered stream (control first on equal timestamps), and the
    last non-null control value is carried forward with the two-level running
    scan over balanced ranges of that order.  No control value yet means
    nothing matches, and so does a row without a time.
    ``control`` needs ``ts``, ``tiebreak`` and ``control_value`` columns.
    """
    d = data.select(*data.columns, F.lit(None).cast("string").alias("_ctl"),
                    F.lit(1).alias("_prio"))
    c = control.select(
        *[(F.col(name) if name in (ts, tiebreak)
           else F.lit(None).cast(data.schema[name].dataType)).alias(name) for name in data.columns],
        F.col(control_value).cast("string").alias("_ctl"), F.lit(0).alias("_prio"))
    order = [ts, "_prio", tiebreak]
    both = with_range_buckets(d.unionByName(c).filter(F.col(ts).isNotNull()), order, num_buckets)
    carried = running(both, order, [Running("_latest", "last", "_ctl")], bucket=range_bucket())
    return (carried.filter((F.col("_prio") == 1) & (F.col(value) == F.col("_latest")))
            .select(*data.columns))


def reconcile(orders: DataFrame, payments: DataFrame, key: str, order_ts: str, pay_ts: str,
              within_us: int) -> DataFrame:
    """Match each order with its payment within ``within_us`` of each other.

    Both inputs must have one row per key (aggregate first).  A full outer
    join on the key gives every case at once: ``matched``, ``no_payment``,
    ``no_order``, or ``timed_out`` when both exist but too far apart (each
    side's timer fires before its partner arrives).
    """
    o = orders.select(F.col(key).alias("_k"), F.col(order_ts).alias("order_ts"))
    p = payments.select(F.col(key).alias("_k"), F.col(pay_ts).alias("pay_ts"))
    j = o.join(p, on="_k", how="full_outer")
    gap = F.abs(epoch_micros("pay_ts") - epoch_micros("order_ts"))
    status = (F.when(F.col("pay_ts").isNull(), "no_payment")
              .when(F.col("order_ts").isNull(), "no_order")
              .when(gap <= within_us, "matched")
              .otherwise("timed_out"))
    return j.select(F.col("_k").alias(key), "order_ts", "pay_ts", status.alias("status"))

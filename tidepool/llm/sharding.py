"""Rendezvous hashing of stable record keys over weighted shards.

Each record draws one score per shard from (key, shard) alone and goes to the shard with the
best score, so a shard that is added takes rows only into itself and one that is removed gives
up only its own. With weights, the score is -weight / ln(u): a shard's expected share is its
weight's share.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepool.llm.common import hash60, running_before, text_of


def rendezvous(key: Column, weights: list[float]) -> Column:
    """The shard (index into ``weights``) that a key goes to.

    A null key is a key like any other. Equal weights are compared by the 60-bit hash itself,
    without logarithms. Ties go to the higher shard number.
    """
    if not weights or any(not w > 0 or math.isinf(w) for w in weights):
        raise ValueError("shard weights must be positive and finite")
    equal = len(set(weights)) == 1

    def score(k: int) -> Column:
        h = hash60(key, F.lit(k))
        return h if equal else -F.lit(float(weights[k])) / F.log((h.cast("double") + 0.5) / F.lit(float(1 << 60)))

    drawn = F.array(*(F.struct(score(k).alias("score"), F.lit(k).alias("shard")) for k in range(len(weights))))
    return F.array_max(drawn)["shard"]


def assign(docs: DataFrame, key: str, text: str, weights: list[float], added: float | None = None) -> DataFrame:
    """One row per record: key, size (UTF-8 bytes of the text plus 8), text_crc32, shard, slot,
    grown_shard (the shard if one of weight ``added`` joins; null if ``added`` is None).

    slot numbers a shard's rows from 0 without gaps, in ascending key order (null last; rows with
    the same key by text hash). A null or empty text has no bytes: size 8, crc 0. Repeated rows get
    a slot each. Other columns of ``docs`` are not read. An empty table gives an empty result.
    """
    body = text_of(text)
    light = docs.select(
        F.col(key), (F.octet_length(body) + 8).cast("long").alias("size"),
        F.crc32(body.cast("binary")).alias("text_crc32"),
        rendezvous(F.col(key), weights).cast("int").alias("shard"),
        (F.lit(None) if added is None else rendezvous(F.col(key), [*weights, added])).cast("int").alias("grown_shard"),
    )
    return running_before(light, ["shard"], [key, "text_crc32"], {"slot": None})

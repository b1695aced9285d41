"""Jaccard join on word 5-grams by chosen paths.

Texts are embedded as tokens (place, smallest hash), of which two texts share a part that
equals their sets' similarity, up to chance. A run draws a place; texts with the same token there share a path. Paths
that many texts share are split again: each draws a place by a hash of the path, and texts go on
with their token there. Small buckets, and those that tokens no longer split, are compared by brute force.

Each split lowers the chance to meet, so runs are counted per text: after a run whose path was split d times, a
pair at the threshold has met with chance (share of equal tokens)^(d + 1). A text takes part in runs until
what is left over all its runs, on average over the share that ``PLACES`` tokens have, is at most 1 - recall.
Of a pair, the text that is done first has had all its runs with the other one still there.

What met is only a candidate: candidates' connected groups are then compared in full on their exact sets,
so every link is counted once, whatever runs found it. Groups over ``BLOCK`` texts are dealt out as
pairs of blocks. Copies (same words in a row) are one node from the start. No pair is ever a row:
tasks return a node's number of links and a spanning forest of them.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepool.llm.common import giving_back, materialize, text_of
from tidepool.llm.components import components
from tidepool.llm.wordhash import Words, grams

SHINGLE = 5
THRESHOLD = (4, 5)      # similarity, as a fraction
COORDINATES = 96        # bytes of a sketch, one per hash
PLACES = 48             # hashes that paths are drawn from, kept whole
SLACK = 0.2             # sketches may differ from sets by this much (five standard deviations)
RECALL = 0.9999
LEAF = 48               # buckets up to this size are not split
DEPTH = 6               # levels of splitting at most; what is larger then is compared in blocks
DENSE = 0.7             # a bucket that keeps this share of the one above is not split on
FIRST_RUNS = 3
BLOCK = 1024
GROUP_ROWS = 4096       # rows of small buckets that go to a task together
SLICE_BYTES = 1 << 21

_draw = np.random.Generator(np.random.PCG64(77))
_XOR = _draw.integers(0, 2**32, COORDINATES, dtype=np.uint32)
_MUL = _draw.integers(0, 2**32, COORDINATES, dtype=np.uint32) | np.uint32(1)


#: Of a pair at the threshold: how likely k of the places have equal tokens (k from 0 on).
_SHARE = [math.comb(PLACES, k) * THRESHOLD[0]**k * (THRESHOLD[1] - THRESHOLD[0])**(PLACES - k) / THRESHOLD[1]**PLACES
          for k in range(PLACES + 1)]


def _apart(equal: int, splits: int) -> float:
    """Log of the chance that a pair with so many equal tokens does not meet in a run with so many splits."""
    meet = (equal / PLACES)**(splits + 1)
    return math.log(1 - meet) if meet < 1 else -1e3


def runs_for(recall: float, splits: int) -> int:
    """Runs with so many splits each after which a pair at the threshold has met with chance ``recall``."""
    runs = 1
    while sum(w * math.exp(runs * _apart(k, splits)) for k, w in enumerate(_SHARE)) > 1 - recall:
        runs += 1
    return runs


def _left(runs: list[Column]) -> Column:
    """The chance that a pair at the threshold has not met after so many runs with 0, 1, ... splits."""
    by_share = F.array(*(F.struct(F.lit(w).alias("w"), F.array(*(F.lit(_apart(k, d)) for d in range(len(runs)))).alias("apart"))
                         for k, w in enumerate(_SHARE)))

    def one(total: Column, x: Column) -> Column:
        logs = F.zip_with(x["apart"], F.array(*runs), lambda a, n: a * n)
        return total + x["w"] * F.exp(F.aggregate(logs, F.lit(0.0), lambda a, b: a + b))

    return F.aggregate(by_share, F.lit(0.0), one)


def _slices(texts: list[bytes]) -> Iterator[tuple[int, int]]:
    begin = 0
    while begin < len(texts):
        end, size = begin + 1, len(texts[begin])
        while end < len(texts) and size + len(texts[end]) <= SLICE_BYTES:
            size += len(texts[end])
            end += 1
        yield begin, end
        begin = end


def shingles(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hashes of all texts' 5-grams, first of each text, number of each text); a text of fewer words
    has one, the hash of them all; a text without words none."""
    one = words.hashes()
    five = grams(one, SHINGLE)
    number = np.where(words.count >= SHINGLE, words.count - SHINGLE + 1, (words.count > 0).astype(np.int64))
    first = np.cumsum(number) - number
    at = np.repeat(words.first[:-1] - first, number) + np.arange(int(number.sum()))
    out = five[np.minimum(at, max(0, len(five) - 1))] if len(five) else np.zeros(len(at), np.uint64)
    for k in np.flatnonzero((words.count > 0) & (words.count < SHINGLE)).tolist():
        out[first[k]] = xxhash.xxh3_64_intdigest(one[words.first[k]:words.first[k + 1]].tobytes())
    return out, first, number


def _sketch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        texts = [bytes(t) for t in batch["text"]]
        for begin, end in _slices(texts):
            words = Words(texts[begin:end])
            one = words.hashes()
            hashes, first, number = shingles(words)
            some = number > 0
            sketch, tokens = np.zeros((len(number), COORDINATES), np.uint8), np.zeros((len(number), PLACES), "<u4")
            if some.any():
                high = (hashes >> np.uint64(32)).astype(np.uint32)
                for k in range(COORDINATES):
                    least = np.minimum.reduceat((high ^ _XOR[k]) * _MUL[k], first[some])
                    sketch[some, k] = ((least * np.uint32(0x9E3779B1)) >> np.uint32(24)).astype(np.uint8)
                    if k < PLACES:
                        tokens[some, k] = least
            same = [xxhash.xxh3_128_digest(one[a:b].tobytes()) if b > a else None
                    for a, b in zip(words.first[:-1].tolist(), words.first[1:].tolist())]
            yield pd.DataFrame({
                "key": batch["key"].iloc[begin:end].astype("Int64").array, "tie": batch["tie"].iloc[begin:end].array,
                "node": pd.array([None if s is None else int.from_bytes(s[:8], "little", signed=True) for s in same], "Int64"),
                "also": pd.array([None if s is None else int.from_bytes(s[8:], "little", signed=True) for s in same], "Int64"),
                "sketch": [r.tobytes() for r in sketch], "tokens": [r.tobytes() for r in tokens]})


SKETCH_SCHEMA = "key bigint, tie bigint, node bigint, also bigint, sketch binary, tokens binary"


def _token(tokens, place):
    """The token at a drawn place: place and value."""
    return F.concat(place.cast("string"), F.lit(":"), F.hex(F.substring(tokens, place * 4 + 1, 4)))


def _place(*salt):
    return F.pmod(F.xxhash64(*salt), F.lit(PLACES)).cast("int")


def _paths(nodes: DataFrame, runs: tuple[int, int], leaf: int, depth: int) -> tuple[DataFrame, list[DataFrame]]:
    """(path, node, n): the leaves of the runs that hold nodes of two or more roots; and per split the nodes that
    went through it, once per run.

    A bucket within one root has nothing to add and is dropped. One that its last token hardly split is of
    texts alike throughout, which more tokens would not tell apart: it is a leaf, whatever its size.
    """
    place = F.pmod(F.col("run"), F.lit(PLACES)).cast("int")  # no place twice while there are others
    level = nodes.select("node", "root", "tokens", F.explode(F.sequence(F.lit(runs[0]), F.lit(runs[1]))).alias("run"))
    level = level.select("node", "root", F.lit(0).cast("long").alias("above"),
                         F.xxhash64("run", _token(F.col("tokens"), place)).alias("path"))
    leaves, split = None, []
    for d in range(depth + 1):
        level = materialize(level, "paths")
        if d:
            split.append(level.select("node"))
        sizes = level.groupBy(F.col("path").alias("_p")).agg(
            F.count("*").alias("n"), F.min("root").alias("_low"), F.max("root").alias("_high"))
        sizes = sizes.filter("_low < _high").select("_p", "n")
        level = materialize(level.join(sizes, F.col("path") == F.col("_p")).drop("_p"), "buckets")
        small = (F.col("n") <= leaf) | (F.col("n") >= DENSE * F.col("above")) & (F.col("above") > 0)
        done = level if d == depth else level.filter(small)
        done = done.select("path", "node", "n")
        leaves = done if leaves is None else leaves.unionByName(done)
        rest = level.filter(~small)
        if d == depth or not rest.limit(1).count():
            break
        rest = rest.join(nodes.select(F.col("node").alias("_n"), "tokens"), F.col("node") == F.col("_n"))
        level = rest.select("node", "root", F.col("n").alias("above"), F.xxhash64("path", _token(
            F.col("tokens"), _place(F.col("path")))).alias("path"))
    return leaves, split


def _candidates(nodes: DataFrame, runs: tuple[int, int], leaf: int, depth: int) -> tuple[DataFrame, list[DataFrame]]:
    """Links that connect the nodes whose sketches are alike and that meet in a leaf of the runs; and the nodes
    by split, as ``_paths`` has them."""
    leaves, split = _paths(nodes, runs, leaf, depth)
    leaves = _dealt(leaves, "path", "n", "node", BLOCK)
    met = leaves.join(nodes.select(F.col("node").alias("_n"), "sketch"), F.col("node") == F.col("_n"))
    met = met.select("task", "side", "path", "node", "sketch")
    return materialize(met.groupBy("task").applyInPandas(_meet, "a bigint, b bigint"), "met"), split


def _counted(nodes: DataFrame, split: list[DataFrame], runs: int, depth: int) -> DataFrame:
    """``nodes`` with ``runs`` more runs added to ``_runs``: how many had 0, 1, ... ``depth`` splits."""
    for d, level in enumerate(split, 1):
        went = level.groupBy(F.col("node").alias("_n")).agg(F.count("*").alias(f"_w{d}"))
        nodes = nodes.join(went, F.col("node") == F.col("_n"), "left").drop("_n")
    through = [F.lit(runs), *(F.coalesce(f"_w{d}", F.lit(0)) for d in range(1, len(split) + 1))]
    through += [F.lit(0)] * (depth + 2 - len(through))
    more = [(a - b).cast("int") for a, b in zip(through, through[1:])]
    nodes = nodes.withColumn("_runs", F.array(*(F.get("_runs", F.lit(d)) + n for d, n in enumerate(more))))
    return nodes.drop(*(f"_w{d}" for d in range(1, len(split) + 1)))


def _dealt(rows: DataFrame, group: str, number: str, key: str, whole: int) -> DataFrame:
    """``rows`` with ``task``, ``side``: small groups share a task by hash; each pair of blocks of a large one is a
    task (side 0 and 1, or 2 for a block with itself), so a row goes to as many tasks as its group has blocks."""
    spread = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    small = rows.filter(F.col(number) <= whole)
    shares = max(spread, -(-small.count() // GROUP_ROWS))
    small = small.withColumn("task", F.concat(F.lit("s"), F.pmod(F.xxhash64(group), F.lit(shares)).cast("string")))
    small = small.withColumn("side", F.lit(2))
    large = rows.filter(F.col(number) > whole)
    large = large.withColumn("_blocks", F.ceil(F.col(number) / BLOCK).cast("long"))
    large = large.withColumn("_mine", F.pmod(F.xxhash64(F.lit("block"), key), F.col("_blocks")))
    large = large.withColumn("_other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_blocks") - 1)))
    large = large.withColumn("task", F.concat_ws("-", F.col(group).cast("string"), F.least("_mine", "_other").cast("string"),
                                                 F.greatest("_mine", "_other").cast("string")))
    large = large.withColumn("side", F.when(F.col("_mine") == F.col("_other"), 2).when(
        F.col("_mine") < F.col("_other"), 0).otherwise(1))
    return small.unionByName(large.drop("_blocks", "_mine", "_other"))


class _Forest:
    """Union-find over 0 .. n-1 that keeps the links that joined two trees."""

    def __init__(self, n: int):
        self.up, self.links = list(range(n)), []

    def root(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, a: int, others: list[int]) -> None:
        top = self.root(a)
        for b in others:
            other = self.root(b)
            if other != top:
                self.up[other] = top
                self.links.append((a, b))


def _sides(side: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows to compare with which: a block's rows with all of it, or one block's with the other's."""
    if (side == 2).all():
        every = np.arange(len(side))
        return every, every
    return np.flatnonzero(side == 0), np.flatnonzero(side == 1)


def _meet(rows: pd.DataFrame) -> pd.DataFrame:
    """Links (a spanning forest) between the texts of each bucket whose sketches are alike."""
    found = []
    for _, bucket in rows.groupby("path", sort=False):
        node = bucket["node"].to_numpy()
        sketch = np.frombuffer(b"".join(bucket["sketch"]), np.uint8).reshape(len(node), -1)
        left, right = _sides(bucket["side"].to_numpy())
        need = (THRESHOLD[0] / THRESHOLD[1] - SLACK) * COORDINATES
        forest = _Forest(len(node))
        for a in left.tolist():
            forest.join(a, right[(sketch[right] == sketch[a]).sum(axis=1) >= need].tolist())
        found += [(int(node[a]), int(node[b])) for a, b in forest.links]
    return pd.DataFrame(found, columns=["a", "b"]).astype({"a": "int64", "b": "int64"})


def _link(rows: pd.DataFrame) -> pd.DataFrame:
    """Per group: each node's links (weighted by copies), and a spanning forest of the links."""
    out = []
    for _, group in rows.groupby("root", sort=False):
        node, copies = group["node"].to_numpy(), group["copies"].to_numpy()
        sets = [np.frombuffer(s, np.uint64) for s in group["shingles"]]
        size = np.array([len(s) for s in sets])
        left, right = _sides(group["side"].to_numpy())
        # Inverted lists: which rows of the right side have a shingle.
        owner = np.repeat(np.arange(len(right)), size[right])
        every = np.concatenate([sets[r] for r in right.tolist()]) if len(right) else np.empty(0, np.uint64)
        order = np.argsort(every, kind="stable")
        every, owner = every[order], owner[order]
        forest, links = _Forest(len(node)), np.zeros(len(node), np.int64)
        same = left is right
        for a in left.tolist():
            begin, end = np.searchsorted(every, sets[a], "left"), np.searchsorted(every, sets[a], "right")
            number = end - begin
            at = np.repeat(begin - (np.cumsum(number) - number), number) + np.arange(int(number.sum()))
            common = np.bincount(owner[at], minlength=len(right))
            # common / (x + y - common) >= p / q
            linked = right[(THRESHOLD[0] + THRESHOLD[1]) * common >= THRESHOLD[0] * (size[a] + size[right])]
            linked = linked[linked != a]
            links[a] += copies[linked].sum()
            if not same:
                links[linked] += copies[a]
            forest.join(a, linked.tolist())
        out += [(int(n), None, int(k)) for n, k in zip(node, links) if k]
        out += [(int(node[a]), int(node[b]), 0) for a, b in forest.links]
    a, b, number = zip(*out) if out else ((), (), ())
    return pd.DataFrame({"a": pd.array(a, "Int64"), "b": pd.array(b, "Int64"), "links": pd.array(number, "Int64")})


def _sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        texts = [bytes(t) for t in batch.pop("text")]
        out: list[bytes] = []
        for begin, end in _slices(texts):
            hashes, first, number = shingles(Words(texts[begin:end]))
            out += [np.unique(hashes[a:a + n]).tobytes() for a, n in zip(first.tolist(), number.tolist())]
        batch["shingles"] = out
        yield batch


def near_join(docs: DataFrame, key: str = "doc_id", text: str = "text", recall: float = RECALL, leaf: int = LEAF,
              depth: int = DEPTH) -> DataFrame:
    """One row per document: key, class_id, n_links, copy_id, text_hash.

    Two documents are linked if the Jaccard similarity of their sets of 5-word shingles is 0.8 or more (texts
    of fewer words have one shingle, all their words). n_links counts the other documents linked to this
    one, copies included. class_id is the least key among the documents that links connect; copy_id the
    least key of those with the same words in the same order; text_hash tells rows of one key apart. Texts without words (null, empty, blank) are
    linked to none and their own class. Null keys take part and are never a class id unless the class has
    no other. Repeated rows are copies. Other columns are not read.
    """
    return _classes(docs, key, text, recall, leaf, depth).drop("_root")


def _classes(docs: DataFrame, key: str, text: str, recall: float = RECALL, leaf: int = LEAF, depth: int = DEPTH) -> DataFrame:
    """The rows of ``near_join`` plus _root, which tells classes apart also where keys repeat; null without words."""
    rows = docs.select(F.col(key).cast("long").alias("key"), text_of(text).cast("binary").alias("text"))
    rows = rows.withColumn("tie", F.xxhash64("text"))
    sketched = materialize(rows.mapInPandas(lambda b: giving_back(_sketch(b)), SKETCH_SCHEMA), "sketches")
    with_words = sketched.filter("node is not null")
    # Copies: one node each, 128 bits decide; the first of them stands for all.
    copies = with_words.groupBy("node", "also").agg(
        F.min("key").alias("copy_id"), F.count("*").alias("copies"),
        F.min(F.struct(F.col("key").isNull().alias("none"), "key", "tie")).alias("first"))
    copies = materialize(copies, "copies")
    first = copies.select(F.col("node").alias("_n"), F.col("first.key").alias("_k"), F.col("first.tie").alias("_t"))
    standing = with_words.join(first, (F.col("node") == F.col("_n")) & (F.col("tie") == F.col("_t"))
                               & F.col("key").eqNullSafe(F.col("_k"))).select("node", "key", "tie", "sketch", "tokens")
    standing = materialize(standing.dropDuplicates(["node"]), "standing")

    # The first runs connect most of what is alike; later ones look only where that could still grow, and
    # only at texts whose runs so far may have missed more than recall allows.
    nodes = standing.withColumn("root", F.col("node")).withColumn("_runs", F.array(*[F.lit(0)] * (depth + 1)))
    met, done = None, 0
    for upto in [FIRST_RUNS, *(runs_for(recall, d) for d in range(depth + 1) if d < 2 or (depth - d) % 2 == 0)]:
        if upto <= done:
            continue
        links, split = _candidates(nodes, (done + 1, upto), leaf, depth)
        nodes = _counted(nodes, split, upto - done, depth)
        if met is None:
            found = components(links).withColumnRenamed("node", "_n").withColumnRenamed("root", "_root")
            nodes = nodes.join(found, F.col("node") == F.col("_n"), "left").withColumn("root", F.coalesce("_root", "root")).drop("_n", "_root")
        met, done = links if met is None else met.unionByName(links), upto
        nodes = materialize(nodes.filter(_left([F.get("_runs", F.lit(d)) for d in range(depth + 1)]) > 1 - recall), "unmet")
        if not nodes.limit(1).count():
            break
    groups = components(met)
    sizes = groups.groupBy(F.col("root").alias("_r")).agg(F.count("*").alias("n"))
    groups = groups.join(sizes, F.col("root") == F.col("_r")).drop("_r")
    groups = groups.join(standing.select(F.col("node").alias("_n"), "key", "tie"), F.col("node") == F.col("_n")).drop("_n")
    groups = materialize(groups, "groups")

    # Exact sets, of the grouped texts only.
    wanted = groups.select("node", F.col("key").alias("_k"), F.col("tie").alias("_t"))
    # What is wanted grows with the input: the join is planned alike at every size.
    texts = rows.hint("merge").join(wanted, (F.col("tie") == F.col("_t")) & F.col("key").eqNullSafe(F.col("_k")))
    sets = texts.select("node", "text").dropDuplicates(["node"]).mapInPandas(lambda b: giving_back(_sets(b)), "node bigint, shingles binary")
    sets = materialize(sets, "sets")
    weights = copies.select(F.col("node").alias("_c"), "copies")
    dealt = _dealt(groups.select("node", "root", "n"), "root", "n", "node", BLOCK)
    dealt = dealt.join(weights, F.col("node") == F.col("_c")).drop("_c")
    dealt = dealt.join(sets.withColumnRenamed("node", "_s"), F.col("node") == F.col("_s")).drop("_s")
    linked = dealt.select("task", "side", "root", "node", "copies", "shingles").groupBy("task").applyInPandas(
        _link, "a bigint, b bigint, links bigint")
    linked = materialize(linked, "linked")
    links = linked.filter("b is null").groupBy(F.col("a").alias("_l")).agg(F.sum("links").alias("links"))
    classes = components(linked.filter("b is not null").select("a", "b"))

    nodes = copies.select("node", "also", "copies", "copy_id")
    nodes = nodes.join(links, F.col("node") == F.col("_l"), "left")
    nodes = nodes.join(classes.select(F.col("node").alias("_c"), "root"), F.col("node") == F.col("_c"), "left")
    nodes = nodes.withColumn("root", F.coalesce("root", "node"))
    least = nodes.groupBy(F.col("root").alias("_r")).agg(F.min("copy_id").alias("class_id"))
    nodes = nodes.join(least, F.col("root") == F.col("_r"))
    nodes = nodes.select(F.col("node").alias("_n"), F.col("also").alias("_a"), F.col("root").alias("_root"), "class_id", "copy_id",
                         (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    out = sketched.select("key", "tie", "node", "also").join(
        nodes, (F.col("node") == F.col("_n")) & (F.col("also") == F.col("_a")), "left")
    none = F.col("node").isNull()
    return out.select(F.col("key").alias(key), F.when(none, F.col("key")).otherwise(F.col("class_id")).alias("class_id"),
                      F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                      F.when(none, F.col("key")).otherwise(F.col("copy_id")).alias("copy_id"),
                      F.col("tie").alias("text_hash"), "_root")


def first_of_class(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of ``docs`` per class of ``near_join``: the one of least key (nulls last), of those the one
    of least text hash, of equal rows any. Rows without words are classes of their own and all stay.
    """
    classes = _classes(docs, key, text)
    empty = F.length(F.translate(text_of(text), " \t\n\x0b\x0c\r", "")) == 0
    # The row travels as one column, so that no column of it can clash.
    rows = docs.select(F.struct(*docs.columns).alias("_row"), F.col(key).cast("long").alias("_key"),
                       F.xxhash64(text_of(text).cast("binary")).alias("_tie"), empty.alias("_empty"))
    first = classes.filter("_root is not null").groupBy("_root").agg(
        F.min(F.struct(F.col(key).isNull().alias("none"), F.col(key).alias("id"), F.col("text_hash").alias("hash"))).alias("_first"))
    first = first.select("_root", F.col("_first.id").alias("_id"), F.col("_first.hash").alias("_hash"))
    kept = rows.filter(~F.col("_empty")).join(first, F.col("_key").eqNullSafe(F.col("_id")) & (F.col("_tie") == F.col("_hash")))
    kept = kept.dropDuplicates(["_root"])
    return kept.select("_row").unionByName(rows.filter("_empty").select("_row")).select("_row.*")

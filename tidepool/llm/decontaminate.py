"""Benchmark decontamination by an index of each training shard.

A task takes its documents shard by shard (a bounded number of words), builds an FM-index of the shard
and searches it for all phrases of the benchmark. Only words that occur in the benchmark are letters
of the index's alphabet; any other word ends a run, and runs shorter than the shortest phrase cannot hold
one and are left out. Occurrences are located by sampled suffix positions and merged to spans.
Documents never move: there is no shuffle. With one block of phrases, the spans are cut in the task that finds
them (``scan`` with ``clean``), so a task has one Python worker and its texts reach it once.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidepool.llm.common import giving_back, materialize, text_of
from tidepool.llm.fmindex import FMIndex

WINDOW = 10
SHARD_WORDS = 1 << 19
#: Bytes of text that a task looks at together (one text may be longer).
SLICE_BYTES = 1 << 22
MOST_PHRASES = 200_000
#: ASCII other than letters and digits separates words; A-Z count as a-z.
FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))
#: The words of a text as it is written: what FOLD keeps, in either case.
WORD_BYTES = re.compile(rb"[0-9A-Za-z\x80-\xFF]+")
WORD_SQL = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
FOUND = T.StructType([T.StructField("n_words", T.LongType()), T.StructField("n_hit", T.LongType()),
                      T.StructField("items", T.ArrayType(T.StringType())),
                      T.StructField("spans", T.ArrayType(T.StructType([T.StructField("begin", T.LongType()),
                                                                       T.StructField("end", T.LongType())])))])


def phrases(items: DataFrame, key: str, text: str, window: int = WINDOW) -> DataFrame:
    """Distinct (phrase, item): each ``window`` consecutive words of an item, all its words if it has
    fewer. Null or wordless texts give none; an item of null key hits words but is not named."""
    folded = F.translate(text_of(text), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = items.select(F.col(key).cast("string").alias("item"), F.regexp_extract_all(folded, F.lit(WORD_SQL), F.lit(0)).alias("w"))
    words = words.filter(F.size("w") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - window + 1, F.lit(1)))
    return words.select("item", F.explode(F.transform(
        starts, lambda i: F.array_join(F.slice("w", i, F.lit(window)), " "))).alias("phrase")).distinct()


class Phrases:
    """A block of phrases as ids over their own vocabulary."""

    def __init__(self, rows: list[tuple[str, str | None]]):
        self.texts = sorted({p for p, _ in rows})
        self.items = sorted({i for _, i in rows if i is not None})
        place, name = {p: k for k, p in enumerate(self.texts)}, {i: k for k, i in enumerate(self.items)}
        links = sorted((place[p], name[i]) for p, i in rows if i is not None)
        self.link_phrase = np.array([a for a, _ in links], np.int64)
        self.link_item = np.array([b for _, b in links], np.int64)
        split = [p.encode().split(b" ") for p in self.texts]
        self.vocabulary = {w: k + 1 for k, w in enumerate(sorted({w for p in split for w in p}))}
        self.lengths = np.array([len(p) for p in split], np.int64)
        self.ids = np.zeros((len(split), max(map(len, split), default=1)), np.int64)
        for k, p in enumerate(split):
            self.ids[k, self.ids.shape[1] - len(p):] = [self.vocabulary[w] for w in p]


def _runs(ids: np.ndarray, shortest: int) -> list[tuple[int, int]]:
    """[begin, end) of the runs of vocabulary words that are long enough."""
    edge = np.flatnonzero(np.diff(np.concatenate([[0], (ids > 0).view(np.int8), [0]])))
    begin, end = edge[::2], edge[1::2]
    long = end - begin >= shortest
    return list(zip(begin[long].tolist(), end[long].tolist()))


def search_shard(held: list[tuple[int, int, np.ndarray]], known: Phrases) -> dict[int, tuple[int, list, list]]:
    """document -> (words hit, items, spans) for runs (document, first word, ids)."""
    index = FMIndex([ids for _, _, ids in held])
    low, high = index.search(known.ids)
    which, at = index.locate(low, high)
    if not len(which):
        return {}
    cover = np.zeros(index.n + 1, np.int64)
    np.add.at(cover, at, 1)
    np.add.at(cover, at + known.lengths[which], -1)
    covered = np.cumsum(cover)[:-1] > 0
    lengths = np.array([len(ids) for _, _, ids in held]) + 1
    starts = np.cumsum(lengths) - lengths
    run_of = np.repeat(np.arange(len(held)), lengths)
    doc_of = np.array([d for d, _, _ in held], np.int64)
    first_of = np.array([f for _, f, _ in held], np.int64)
    edge = np.flatnonzero(np.diff(np.concatenate([[0], covered.view(np.int8), [0]])))
    out: dict[int, tuple[int, list, list]] = {}
    for begin, end in zip(edge[::2].tolist(), edge[1::2].tolist()):
        run = run_of[begin]
        hit, items, spans = out.get(int(doc_of[run]), (0, [], []))
        word = int(begin - starts[run] + first_of[run])
        spans.append((word, word + end - begin))
        out[int(doc_of[run])] = (hit + end - begin, items, spans)
    # Distinct (document, phrase) first, then the items of each phrase.
    pairs = np.unique(doc_of[run_of[at]] * len(known.texts) + which)
    docs, found = np.divmod(pairs, len(known.texts))
    left, right = (np.searchsorted(known.link_phrase, found, side=s) for s in ("left", "right"))
    number = right - left
    links = np.arange(int(number.sum())) + np.repeat(left - (np.cumsum(number) - number), number)
    named = np.unique(np.repeat(docs, number) * max(1, len(known.items)) + known.link_item[links])
    for doc, item in zip(*(x.tolist() for x in np.divmod(named, max(1, len(known.items))))):
        out[doc][1].append(known.items[item])
    return out


def _slices(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """The batches in pieces of at most ``most`` bytes of ``_fm_text``, or of one row."""
    for batch in batches:
        upto = np.cumsum(pc.binary_length(batch.column("_fm_text")).to_numpy(zero_copy_only=False), dtype=np.int64)
        begin = 0
        while begin < batch.num_rows:
            before = int(upto[begin - 1]) if begin else 0
            stop = max(begin + 1, int(np.searchsorted(upto, before + most, side="right")))
            yield batch.slice(begin, stop - begin)
            begin = stop


def _without(text: bytes, spans: Iterable[tuple[int, int]]) -> str:
    """The text without the words of the spans and what stands between them."""
    if spans:
        at = [m.span() for m in WORD_BYTES.finditer(text)]
        pieces, end = [], 0
        for first, last in spans:
            pieces.append(text[end:at[first][0]])
            end = at[last - 1][1]
        text = b"".join([*pieces, text[end:]])
    return text.decode()


def _scan(batches: Iterator[pa.RecordBatch], known: Phrases, kind: pa.DataType, shard_words: int,
          clean: bool = False) -> Iterator[pa.RecordBatch]:
    shortest = int(known.lengths.min()) if len(known.lengths) else 1 << 62
    word_id = known.vocabulary.get
    for batch in _slices(batches, SLICE_BYTES):
        texts = batch.column("_fm_text")
        counts, found, held, size = [], {}, [], 0
        for doc in range(batch.num_rows):
            words = texts[doc].as_py().translate(FOLD).split()
            counts.append(len(words))
            if len(words) < shortest:
                continue
            ids = np.fromiter((word_id(w, 0) for w in words), np.int32, len(words))
            for begin, end in _runs(ids, shortest):
                held.append((doc, begin, ids[begin:end].copy()))
                size += end - begin + 1
            if size >= shard_words:
                found |= search_shard(held, known)
                held, size = [], 0
        if held:
            found |= search_shard(held, known)
        del held
        rows = [{"n_words": n, "n_hit": hit, "items": items, "spans": [{"begin": b, "end": e} for b, e in spans]}
                for n, (hit, items, spans) in ((n, found.get(doc, (0, [], []))) for doc, n in enumerate(counts))]
        out = {c: batch.column(c) for c in batch.schema.names if c != "_fm_text"} | {"_found": pa.array(rows, kind)}
        if clean:
            out["_clean"] = pa.array((_without(texts[doc].as_py(), found.get(doc, (0, [], []))[2]) for doc in range(batch.num_rows)),
                                     pa.string())
        yield pa.RecordBatch.from_arrays(list(out.values()), list(out))


def scan(docs: DataFrame, items: DataFrame, text: str = "text", item_key: str = "item_id", item_text: str = "text",
         window: int = WINDOW, shard_words: int = SHARD_WORDS, most_phrases: int = MOST_PHRASES,
         keep: list[str] | None = None, clean: bool = False) -> DataFrame:
    """The columns ``keep`` of ``docs`` (None: all) plus ``_found``: n_words, n_hit, items (names of items with occurring phrases, sorted),
    spans ([begin, end) word numbers, merged). ``clean`` adds ``_clean`` as ``cut`` does; ``keep`` need not have the text for it.

    Null texts have no words. Repeated rows are each searched. The phrases go to the tasks in blocks of
    about ``most_phrases`` (by hash of the phrase); with more than one block, each block passes over the
    documents and the blocks' spans are merged per row. No items, no hits. Columns ``_found`` and (``clean``) ``_clean`` of ``docs`` are replaced.
    """
    spark = docs.sparkSession
    made = ["_found", "_clean"] if clean else ["_found"]
    keep = [c for c in (docs.columns if keep is None else keep) if c not in made]
    sought = phrases(items, item_key, item_text, window)
    blocks = max(1, -(-sought.count() // most_phrases))
    if blocks > 1:
        sought = materialize(sought, "phrases")
        docs = materialize(docs.withColumn("_pass_row", F.monotonically_increasing_id()), "documents")
        keep = [*keep, "_pass_row"]
        if clean:
            docs, keep = docs.withColumn("_cut_text", F.col(text)), [*keep, "_cut_text"]
    with_text = docs.select(*keep, text_of(text).cast("binary").alias("_fm_text"))
    here = clean and blocks == 1  # blocks' spans are merged before anything is cut
    schema = T.StructType([*(f for f in with_text.schema.fields if f.name != "_fm_text"), T.StructField("_found", FOUND),
                           *([T.StructField("_clean", T.StringType())] if here else [])])
    kind = pa.struct([("n_words", pa.int64()), ("n_hit", pa.int64()), ("items", pa.list_(pa.string())),
                      ("spans", pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())])))])
    passes = []
    for k in range(blocks):
        block = sought.filter(F.pmod(F.xxhash64("phrase"), F.lit(blocks)) == k) if blocks > 1 else sought
        known = spark.sparkContext.broadcast([(r["phrase"], r["item"]) for r in block.collect()])
        passes.append(with_text.mapInArrow(lambda b, known=known: giving_back(
            _scan(b, Phrases(known.value), kind, shard_words, here)), schema))
    if blocks == 1:
        return passes[0]
    hits = None
    for one in passes:
        part = one.filter("_found.n_hit > 0").select("_pass_row", "_found.items", "_found.spans")
        hits = part if hits is None else hits.unionByName(part)
    hits = hits.groupBy(F.col("_pass_row").alias("_r")).agg(
        F.sort_array(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
        F.sort_array(F.flatten(F.collect_list("spans"))).alias("_spans"))
    # Blocks' spans may overlap or touch: a span is grown while the next one starts within it.
    hits = hits.withColumn("spans", F.aggregate(
        "_spans", F.expr("cast(array() as array<struct<begin:bigint,end:bigint>>)"),
        lambda done, x: F.when(
            F.get(done, F.size(done) - 1)["end"] >= x["begin"],
            F.concat(F.slice(done, F.lit(1), F.size(done) - 1), F.array(F.struct(
                F.get(done, F.size(done) - 1)["begin"].alias("begin"),
                F.greatest(F.get(done, F.size(done) - 1)["end"], x["end"]).alias("end")))),
        ).otherwise(F.concat(done, F.array(x)))))
    hits = hits.withColumn("n_hit", F.aggregate("spans", F.lit(0).cast("long"), lambda a, x: a + x["end"] - x["begin"]))
    out = passes[0].join(hits, F.col("_pass_row") == F.col("_r"), "left")
    found = F.struct(F.col("_found.n_words").alias("n_words"), F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
                     F.coalesce("items", F.col("_found.items")).alias("items"),
                     F.coalesce("spans", F.col("_found.spans")).alias("spans"))
    kept = [f.name for f in schema.fields if f.name not in ("_pass_row", "_found")]
    out = out.select(*kept, found.alias("_found"))
    return cut(out, "_cut_text").drop("_cut_text") if clean else out


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in _slices(batches, SLICE_BYTES):
        out = pa.array((_without(text.as_py(), [(s["begin"], s["end"]) for s in found.as_py()["spans"]])
                        for text, found in zip(batch.column("_fm_text"), batch.column("_found"))), pa.string())
        kept = [c for c in batch.schema.names if c != "_fm_text"]
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), out], [*kept, "_clean"])


def cut(scanned: DataFrame, text: str = "text") -> DataFrame:
    """``scanned`` (of ``scan``) plus ``_clean``: the text without the hit words and what stands between
    the words of a span. Texts without hits stay as they are (null: empty)."""
    schema = T.StructType([*scanned.schema.fields, T.StructField("_clean", T.StringType())])
    return scanned.withColumn("_fm_text", text_of(text).cast("binary")).mapInArrow(lambda b: giving_back(_cut(b)), schema)

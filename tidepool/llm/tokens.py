"""Token ids in Simple-8b blocks.

``encode`` turns texts into token ids and packs them; ``decode`` reads the files back.

File format. A folder of Parquet files, one row per block of whole documents, committed by Spark's
writer (a lost task leaves nothing behind). A block has

* shard, block: its place; shards and blocks ascend in document order;
* doc_ids, n_tokens: its documents, in order, and how many ids each has;
* words: little-endian unsigned 64-bit words. The top 4 bits of a word select how many ids it
  holds and how wide they are (``SELECTORS``), the other 60 hold the ids, first id lowest;
* offsets: index of the word that starts each lane of ``LANE`` ids, so that a lane can be decoded alone;
* escapes: ids of 2^60 and more, 8 bytes each; selector 0 stands for one of them, by its index.
"""

from __future__ import annotations

import gc
import json
import re
import unicodedata
import zlib
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidepool.llm.common import give_back, giving_back, text_of
from tidepool.session import scratch_path

LANE = 1024
BLOCK_IDS = 1 << 18
#: Bytes of remembered pieces of words of a Python worker, about; there may be as much again of older ones.
WORD_MEMORY = 240 << 20
#: Selector -> (ids per word, bits per id); selector 0 is an escape, 15 a run of zeros.
SELECTORS = {1: (60, 1), 2: (30, 2), 3: (20, 3), 4: (15, 4), 5: (12, 5), 6: (10, 6), 7: (8, 7), 8: (7, 8),
             9: (6, 10), 10: (5, 12), 11: (4, 15), 12: (3, 20), 13: (2, 30), 14: (1, 60), 15: (120, 0)}
BLOCK_SCHEMA = ("shard int, block int, doc_ids array<bigint>, n_tokens array<bigint>, n_ids bigint, "
                "words binary, offsets binary, escapes binary")
BLOCK_NAMES = ["shard", "block", "doc_ids", "n_tokens", "n_ids", "words", "offsets", "escapes"]
DOC_SCHEMA = "shard int, block int, seq int, doc_id bigint, within bigint, n_tokens bigint, ids_crc32 bigint"

_POWERS = np.uint64(1) << np.arange(61, dtype=np.uint64)
_WIDTH = np.searchsorted(_POWERS, np.arange(1 << 16, dtype=np.uint64), side="right").astype(np.uint8)
_COUNT = np.ones(16, np.int64)
for _s, (_n, _) in SELECTORS.items():
    _COUNT[_s] = _n


def pack(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(words, offsets, escapes) of unsigned 64-bit ids.

    Each word takes as many ids as fit (greedy). All lanes are packed in step: what a word that starts
    at a place would take is computed for every place at once, then one pass over the words of the
    longest lane follows the chain in each lane.
    """
    ids = np.ascontiguousarray(ids, np.uint64)
    n = len(ids)
    if n == 0:
        return np.empty(0, np.uint64), np.empty(0, np.uint32), np.empty(0, np.uint64)
    lanes = -(-n // LANE)
    widest = 120
    bits = np.full((lanes, LANE + widest), 255, np.uint8)
    flat = np.full(lanes * LANE, 255, np.uint8)
    flat[:n] = _WIDTH[ids] if ids.max() < len(_WIDTH) else np.searchsorted(_POWERS, ids, side="right")
    bits[:, :LANE] = flat.reshape(lanes, LANE)
    best = np.where(bits[:, :LANE] > 60, 0, 14).astype(np.uint8)
    span, top = 1, bits  # top[i]: widest of the span ids from i on
    for s in sorted((s for s in SELECTORS if s != 14), key=lambda s: SELECTORS[s][0]):
        count, width = SELECTORS[s]
        while span < count:
            step = min(span, count - span)
            wider = top.copy()
            wider[:, :-step] = np.maximum(top[:, :-step], top[:, step:])
            wider[:, -step:] = 255
            top, span = wider, span + step
        best[top[:, :LANE] <= width] = s
    length = np.full(lanes, LANE)
    length[-1] = n - (lanes - 1) * LANE
    place, row, steps = np.zeros(lanes, np.int64), np.arange(lanes), []
    while len(row):
        steps.append((row, row * LANE + place))
        place = place + _COUNT[best[row, place]]
        more = place < length[row]
        row, place = row[more], place[more]
    rows, starts = (np.concatenate(x) for x in zip(*steps))
    order = np.argsort(starts, kind="stable")
    rows, starts = rows[order], starts[order]
    chosen = best.reshape(-1)[starts]
    words = chosen.astype(np.uint64) << np.uint64(60)
    for s in np.unique(chosen):
        if s in (0, 15):
            continue
        count, width = SELECTORS[int(s)]
        at = np.flatnonzero(chosen == s)
        for k in range(count):
            words[at] |= ids[starts[at] + k] << np.uint64(k * width)
    raw = np.flatnonzero(chosen == 0)
    words[raw] |= np.arange(len(raw), dtype=np.uint64)
    offsets = np.searchsorted(rows, np.arange(lanes)).astype(np.uint32)
    return words, offsets, ids[starts[raw]]


def unpack(words: np.ndarray, escapes: np.ndarray) -> np.ndarray:
    """The ids of a run of words (a whole block, or one lane of it)."""
    chosen = (words >> np.uint64(60)).astype(np.int64)
    count = _COUNT[chosen]
    start = np.cumsum(count) - count
    out = np.zeros(int(count.sum()), np.uint64)
    body = words & np.uint64((1 << 60) - 1)
    for s in np.unique(chosen):
        at = np.flatnonzero(chosen == s)
        if s == 0:
            out[start[at]] = escapes[body[at].astype(np.int64)]
        elif s != 15:
            number, width = SELECTORS[int(s)]
            for k in range(number):
                out[start[at] + k] = (body[at] >> np.uint64(k * width)) & np.uint64((1 << width) - 1)
    return out


def _rules(part, steps: str) -> list[dict]:
    """The steps of a tokenizer's normalizer or splitter, as its file has them."""
    said = json.loads(part.__getstate__()) if part is not None else {}
    return said.get(steps, [said])


class PieceNumbers(dict):
    """Number of each piece met, and by number its ids: those of piece n are ``pool[ends[n]:ends[n + 1]]``.

    Number 0 is the line break, which ends a part and has no ids. A piece not met is looked up in the memory
    ``before``, if there is one, and then worked out by ``ids_of``.
    """

    #: Bytes that a piece takes besides its characters and ids (a string, a dictionary entry, a number, an end).
    ENTRY = 200

    def __init__(self, ids_of: Callable[[str], list[int]], before: PieceNumbers | None = None):
        super().__init__({"\n": 0})
        self.ids_of, self.before = ids_of, before
        self.pool, self.ends, self.chars = array("I"), array("q", [0, 0]), 0

    def __missing__(self, piece: str) -> int:
        old = None if self.before is None else self.before.get(piece)
        if old is None:
            self.pool.extend(self.ids_of(piece))
        else:
            self.pool += self.before.pool[self.before.ends[old]:self.before.ends[old + 1]]
        self.ends.append(len(self.pool))
        self.chars += len(piece)
        self[piece] = number = len(self)
        return number

    def held(self) -> int:
        """Bytes, about."""
        return self.ENTRY * len(self) + self.chars + 4 * len(self.pool)


def _ranges(begin: np.ndarray, number: np.ndarray, upto: np.ndarray) -> np.ndarray:
    """The places of ranges, one range after the other; ``upto``: running sum of ``number``."""
    return np.repeat(begin - (upto - number), number) + np.arange(int(upto[-1]) if len(upto) else 0)


def _new_ids(whole, byte: list[str]) -> Callable[[str], list[int]]:
    """Gives the ids of a piece, or of a whole part with a line break before it; ``byte``: how the model reads each byte."""
    model = whole.model

    def ids_of(piece: str) -> list[int]:
        if piece[0] == "\n":
            return whole.encode(piece[1:], add_special_tokens=False).ids
        written = piece if piece.isascii() and piece.isalnum() else "".join(map(byte.__getitem__, piece.encode()))
        return [t.id for t in model.tokenize(written)]

    return ids_of


class WordIds:
    """Ids of texts by the tokenizer's own rules, each distinct piece worked out once.

    The tokenizer drops white space and no piece spans it, so the ids of a text are those of its
    parts between blanks, one after the other. The distinct parts of the texts of a call are split together, by the
    tokenizer's own pattern with the letters, digits and blanks below U+0250 spelt out. Their pieces are looked up, a new
    one goes through the tokenizer's model. Parts with other characters, or with what may be a special token, are looked
    up whole, a new one goes through the whole tokenizer. What is remembered is bounded: after
    ``memory`` bytes, about, a new memory begins, and of those before only the last ``older`` (0 or 1) is still looked up.
    A tokenizer file with other rules than these (``by_words`` is false) encodes whole texts, nothing remembered.
    """

    #: Fixed value: the tokenizer file's split pattern, with the letters, digits and blanks below U+0250 spelt out.
    PIECE = "'s|'t|'re|'ve|'m|'ll|'d|[{0}]+|[{1}]|[^{2}{0}{1}]+"
    LATIN_END = "\u0250"
    #: The normalizer and the splitter of the tokenizer files that may be read by words.
    NORMALIZER = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]
    SPLITTER = [{"type": "Split", "pattern": {"Regex": PIECE.format("\\p{L}", "\\p{N}", "\\s")}, "behavior": "Removed", "invert": True},
                {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]

    def __init__(self, path: str, memory: int = WORD_MEMORY, older: int = 1):
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.memory, self.older = memory, older
        self.by_words = (_rules(self.whole.normalizer, "normalizers") == self.NORMALIZER
                         and _rules(self.whole.pre_tokenizer, "pretokenizers") == self.SPLITTER
                         and all("<|" in t.content for t in self.whole.get_added_tokens_decoder().values()))
        if self.by_words and not older:
            # The model's own memory of words outlives the model, one for each task; new pieces gain nothing by it.
            getattr(self.whole.model, "_resize_cache", int)(0)
        latin = [chr(c) for c in range(ord(self.LATIN_END))]
        kind = {c: unicodedata.category(c)[0] for c in latin}
        blank = [c for c in latin if c.isspace() and not "\x1c" <= c <= "\x1f"]
        classes = [[c for c in latin if kind[c] == "L"], [c for c in latin if kind[c] == "N"], blank]
        # A line break ends a part.
        self.pieces = re.compile(self.PIECE.format(*(re.escape("".join(c)) for c in classes)) + "|\n").findall
        # Arrow's pattern of the parts that are looked up whole; some Latin capitals have small letters from U+0250 on.
        leave = "".join(c for c in latin if max(c.lower()) >= self.LATIN_END)
        self.odd = f"<\\||[^\\x00-\\x{{{ord(self.LATIN_END) - 1:x}}}]|[{leave}]"
        # A byte without a printable Latin-1 character of its own is written as 256 + its rank among those.
        own = {*range(33, 127), *range(161, 173), *range(174, 256)}
        rest = [b for b in range(256) if b not in own]
        byte = [chr(b) if b in own else chr(256 + rest.index(b)) for b in range(256)]
        # The memory does not refer to this object: both are freed as soon as they are given up.
        self.known = PieceNumbers(_new_ids(self.whole, byte))

    def reset(self) -> None:
        """Begin a new memory; the one before is still asked if ``older`` says so, the one before that is given up."""
        self.known.before = None
        self.known = PieceNumbers(self.known.ids_of, self.known if self.older else None)

    def parts(self, distinct: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids of parts, where each part's ids begin, how many they are)."""
        odd = pc.match_substring_regex(distinct, self.odd)
        is_odd, plain = odd.to_numpy(zero_copy_only=False), distinct.filter(pc.invert(odd))
        lines = pc.binary_join(pa.ListArray.from_arrays([0, len(plain)], plain), pa.scalar("\n", plain.type))[0].as_py()
        found = self.pieces(f"{lines}\n".lower()) if len(plain) else []
        found += ["\n" + part for part in distinct.filter(odd).to_pylist()]
        at = np.fromiter(map(self.known.__getitem__, found), np.int64, len(found))
        last = at == 0
        last[len(found) - int(is_odd.sum()):] = True
        end, pool = np.frombuffer(self.known.ends, np.int64), np.frombuffer(self.known.pool or b"", np.uint32)
        begin, number = end[at], end[at + 1] - end[at]
        upto = np.cumsum(number)
        ids = pool[_ranges(begin, number, upto)]
        ends = np.empty(len(distinct) + 1, np.int64)
        ends[0], ends[1:] = 0, upto[last]
        place = np.empty(len(distinct), np.int64)  # those looked up whole come last
        place[np.concatenate([np.flatnonzero(~is_odd), np.flatnonzero(is_odd)])] = np.arange(len(distinct))
        return ids, ends[place], ends[place + 1] - ends[place]

    def __call__(self, texts: list[str] | pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after the other, number of ids of each)."""
        texts = pa.array(texts, pa.large_string()) if isinstance(texts, list) else texts.cast(pa.large_string())
        if not self.by_words:
            each = [np.array(self.whole.encode(t, add_special_tokens=False).ids, np.uint32) for t in texts.to_pylist()]
            return np.concatenate([np.zeros(0, np.uint32), *each]), np.array([len(e) for e in each], np.int64)
        if self.known.held() > self.memory:
            self.reset()
        lists = pc.split_pattern(pc.replace_substring(texts, "\n", " "), " ")
        count = np.diff(lists.offsets.to_numpy())
        coded = lists.flatten().dictionary_encode()
        at = coded.indices.to_numpy()
        ids, begin, number = self.parts(coded.dictionary)
        begin, number = begin[at], number[at]
        upto = np.cumsum(number)
        ids = ids[_ranges(begin, number, upto)]
        sums = np.concatenate([[0], upto])[np.cumsum(count)].astype(np.int64)
        return ids, np.diff(np.concatenate([[0], sums]))


def _encoder(path: str, memory: int, older: int) -> WordIds:
    """The Python worker's encoder, kept for its next tasks."""
    import tokenizers

    held = tokenizers.__dict__.setdefault("_tidepool_word_ids", {})
    key = (path, memory, older)
    if key not in held:
        held[key] = WordIds(*key)
    return held[key]


def _blocks(batches: Iterator[pa.RecordBatch], path: str, end_id: int, block_ids: int, slice_chars: int, memory: int, keep: bool):
    """The block rows of a task. Cyclic collection is off meanwhile (many small objects, none in cycles)."""
    # Without keeping, neither the words nor the tokenizer outlive the task.
    ids_of = _encoder(path, memory, 1) if keep else WordIds(path, memory, 0)
    collects = gc.isenabled()
    gc.disable()
    try:
        yield from _task_blocks(batches, ids_of, end_id, block_ids, slice_chars)
    finally:
        if collects:
            gc.enable()
        if not keep:
            del ids_of
            give_back()


def _task_blocks(batches: Iterator[pa.RecordBatch], ids_of: WordIds, end_id: int, block_ids: int, slice_chars: int):
    shard, block = TaskContext.get().partitionId(), 0
    keys, counts, ids, size = [], [], [], 0

    def row():
        words, offsets, escapes = pack(np.concatenate(ids))
        return pa.RecordBatch.from_arrays([
            pa.array([shard], pa.int32()), pa.array([block], pa.int32()), _listed(pa.concat_arrays(keys)),
            _listed(pa.array(np.concatenate(counts))), pa.array([size], pa.int64()), pa.array([words.astype("<u8").tobytes()], pa.binary()),
            pa.array([offsets.astype("<u4").tobytes()], pa.binary()), pa.array([escapes.astype("<u8").tobytes()], pa.binary())], BLOCK_NAMES)

    for batch in batches:
        upto_char = np.concatenate([[0], np.cumsum(pc.utf8_length(batch["text"]).to_numpy(), dtype=np.int64)])
        begin = 0
        while begin < len(batch):
            # Texts of a bounded length together, one at least.
            end = max(begin + 1, int(np.searchsorted(upto_char, upto_char[begin] + slice_chars, side="right")) - 1)
            found, number = ids_of(batch["text"][begin:end])
            found, number = np.insert(found, np.cumsum(number), end_id), number + 1
            upto = np.concatenate([[0], np.cumsum(number)])
            first = 0
            while first < len(number):
                # Documents up to the one that fills the block.
                last = min(int(np.searchsorted(upto[1:], upto[first] + block_ids - size)) + 1, len(number))
                keys.append(batch["doc_id"][begin + first:begin + last])
                counts.append(number[first:last])
                ids.append(found[upto[first]:upto[last]])
                size += len(ids[-1])
                first = last
                if size >= block_ids:
                    yield row()
                    keys, counts, ids, size, block = [], [], [], 0, block + 1
            begin = end
    if size:
        yield row()


def _listed(values: pa.Array) -> pa.Array:
    """The values as one list."""
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def as_written(name: str = "_metadata") -> list[Column]:
    """The order in which a table of Parquet files was written: Spark numbers the files by task, rows are in order."""
    file, row = F.col(f"{name}.file_name"), F.col(f"{name}.row_index")
    return [F.regexp_extract(file, r"part-(\d+)", 1).try_cast("long"), file, row]


def encode(docs: DataFrame, path: str, end_id: int, key: str = "doc_id", text: str = "text",
           out: str | None = None, block_ids: int = BLOCK_IDS, order: list[Column] | None = None,
           word_memory: int = WORD_MEMORY, keep_memory: bool = True, slice_chars: int = 1 << 22) -> str:
    """Write the ids of all documents in ascending key order, or by ``order`` if given; returns the folder.

    Null texts are empty: a document of the end id alone. Null keys come first; documents of the same key
    are ordered by text hash, repeated rows are all written. Other columns are not read but for ``order``. A text is
    never split between blocks. An empty table writes no block.

    A task remembers the ids of pieces of words it has met: ``word_memory`` bytes, about, and as much again of the memory before. With ``keep_memory`` the Python
    worker keeps it for its next task; without, one memory is held and given up at the task's end (where other stages need the workers).
    """
    spark = docs.sparkSession
    out = out or scratch_path(spark, "simple8b")
    body = text_of(text)
    order = [F.col(key).cast("long"), F.xxhash64(body)] if order is None else order
    places = [f"_by{k}" for k in range(len(order))]
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), body.alias("text"),
                       *(c.alias(p) for c, p in zip(order, places)))
    rows = rows.repartitionByRange(*places).sortWithinPartitions(*places).drop(*places)
    blocks = rows.mapInArrow(lambda b: _blocks(b, path, end_id, block_ids, slice_chars, word_memory, keep_memory), BLOCK_SCHEMA)
    blocks.write.option("compression", "zstd").parquet(out)
    return out


def _documents(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for b in batch.itertuples():
            ids = unpack(np.frombuffer(b.words, "<u8"), np.frombuffer(b.escapes, "<u8")).astype("<u4")
            ends = np.cumsum(np.asarray(b.n_tokens, np.int64))
            within = ends - b.n_tokens
            yield pd.DataFrame({
                "shard": b.shard, "block": b.block, "seq": np.arange(len(ends)),
                "doc_id": pd.array(list(b.doc_ids), "Int64"), "within": within, "n_tokens": b.n_tokens,
                "ids_crc32": [zlib.crc32(ids[x:y].tobytes()) for x, y in zip(within, ends)]})


def decode(spark: SparkSession, folder: str) -> DataFrame:
    """One row per document of the files: doc_id, start, n_tokens, ids_crc32, shard, block.

    start counts the ids of all documents before it; ids_crc32 is taken over the decoded ids as
    little-endian unsigned 32-bit integers.
    """
    files = spark.read.schema(BLOCK_SCHEMA).parquet(folder)
    heads = files.select("shard", "block", "n_ids")
    before = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    # One row per shard: as many as the writing job had tasks.
    shards = heads.groupBy(F.col("shard").alias("_shard")).agg(F.sum("n_ids").alias("_n"))
    shards = shards.select("_shard", F.coalesce(F.sum("_n").over(
        Window.orderBy("_shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_base"))
    heads = heads.withColumn("_in", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))
    heads = heads.join(shards, F.col("shard") == F.col("_shard")).select(
        F.col("shard").alias("_s"), F.col("block").alias("_b"), (F.col("_in") + F.col("_base")).alias("_first"))
    docs = files.select("shard", "block", "doc_ids", "n_tokens", "words", "escapes").mapInPandas(lambda b: giving_back(_documents(b)), DOC_SCHEMA)
    rows = docs.join(heads, (F.col("shard") == F.col("_s")) & (F.col("block") == F.col("_b")))
    return rows.select("doc_id", (F.col("_first") + F.col("within")).alias("start"), "n_tokens", "ids_crc32", "shard", "block")

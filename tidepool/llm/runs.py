"""Periodic runs: stretches of a text that repeat themselves, word for word.

A run is a stretch of words with smallest period q (words q apart are the same) that no neighbouring word extends and
that is at least ``max(MIN_WORDS, MIN_TIMES * q)`` words long.

Online diagonal dynamic program over the words of a text: a word whose earlier occurrence lies q words back extends the
match of lag q that ended at the word before it, or begins one; a diagonal that ends is given out at once
if its match was long enough. It is sparse: only occurrences are looked at, never all lags of a word.

All earlier occurrences of a frequent word would be quadratic in a long text. So a word is looked up together with the words that follow
it, and only its nearest earlier occurrence counts. For a context of ``width`` words, q <= width <= 3 q,
that loses nothing and finds nothing else (Fine and Wilf): inside a run of smallest period q a context of q words or more
cannot come again sooner than q words later, and the matching words of a run, 3 q at least, hold such a context. A few widths,
each about three times the one before, cover all periods; a context is only looked at if the shorter ones at its
two ends came up more than once, so plain prose is done after the first width. Time is n log n
in the words of a text, whatever they are; texts never meet, so nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepool.llm.common import text_of
from tidepool.llm.wordhash import U, Words, mix, pair

MIN_WORDS = 6
MIN_TIMES = 4
#: Widths of contexts: the first serves periods 1 to 5 (their runs have 5 matching words or more).
FIRST_WIDTH = 5
SLICE_BYTES = 1 << 21
_TEXT_MARK = U(0x9E3779B97F4A7C15)
RUN = "struct<start:bigint,length:bigint,period:bigint>"


def _widen(grams: np.ndarray, have: int, width: int) -> np.ndarray:
    """Hashes of the contexts of ``width`` words from those of ``have``; one per place that has so many words after it."""
    while have < width:
        step = min(have, width - have)
        grams = pair(grams[:-step], grams[step:]) if len(grams) > step else grams[:0]
        have += step
    return grams


def _diagonals(at: np.ndarray, lag: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first place, lag, places) of each diagonal: places one after the other whose earlier occurrence has the same lag."""
    if not len(at):
        return at, lag, at
    new = np.ones(len(at), bool)
    new[1:] = (at[1:] != at[:-1] + 1) | (lag[1:] != lag[:-1])
    first = np.flatnonzero(new)
    return at[first], lag[first], np.diff(np.append(first, len(at)))


def find(one: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, start, length, period) of all runs, by text, start and period.

    ``one`` has the hashes of the words of all texts, one text after the other, ``count`` how many words each has.
    """
    end = np.cumsum(count)
    text = np.repeat(np.arange(len(count)), count)
    place = np.arange(len(one))
    left = end[text] - place if len(one) else place
    # Words of different texts are different words, so that no match leaves its text.
    grams = mix(one ^ (text.astype(np.uint64) * _TEXT_MARK))
    have, width, below = 1, FIRST_WIDTH, 0
    alive = np.ones(len(one), bool)
    found = []
    while len(grams):
        grams = _widen(grams, have, width)
        n = len(grams)
        ok = left[:n] >= width
        ok &= alive[:n] & alive[width - have:width - have + n] if have > 1 else True
        here = np.flatnonzero(ok)
        if not len(here):
            break
        # Equal contexts side by side, in the order of the text: the one before is the nearest earlier occurrence.
        order = here[np.argsort(grams[here], kind="stable")]
        same = grams[order[1:]] == grams[order[:-1]]
        later, lag = order[1:][same], (order[1:] - order[:-1])[same]
        alive = np.zeros(n, bool)
        alive[later] = True
        alive[order[:-1][same]] = True
        mine = (lag > below) & (lag <= width)
        later, lag = later[mine], lag[mine]
        by = np.argsort(later, kind="stable")
        first, period, places = _diagonals(later[by], lag[by])
        match = places + width - 1
        long = match + period >= np.maximum(MIN_WORDS, MIN_TIMES * period)
        at = place[first[long]]
        found.append((at - period[long], match[long] + period[long], period[long]))
        # The next periods are above this width: texts without a repeated context, or shorter than four periods, are done.
        below, have, width = width, width, 3 * (width + 1)
        texts = np.unique(text[:n][alive])
        texts = texts[count[texts] >= MIN_TIMES * (below + 1)]
        keep = np.zeros(len(count), bool)
        keep[texts] = True
        kept = np.flatnonzero(keep[text[:n]])
        grams, alive, place, left, text = grams[kept], alive[kept], place[kept], left[kept], text[kept]
    if not found:
        return (np.empty(0, np.int64),) * 4
    start, length, period = (np.concatenate(x) for x in zip(*found))
    order = np.lexsort([period, start])
    start, length, period = start[order], length[order], period[order]
    owner = np.searchsorted(end, start, side="right")
    return owner, start - (end - count)[owner], length, period


def _slices(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """Rows of a bounded number of text bytes together, one at least."""
    for batch in batches:
        upto = np.cumsum(pc.binary_length(batch.column("_text")).to_numpy(zero_copy_only=False))
        begin = 0
        while begin < batch.num_rows:
            done = upto[begin - 1] if begin else 0
            stop = max(begin + 1, int(np.searchsorted(upto, done + most, side="right")))
            yield batch.slice(begin, stop - begin)
            begin = stop


def _collapse(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    for rows in _slices(batches, most):
        texts = rows.column("_text").to_pylist()
        words = Words(texts)
        text, start, length, period = find(words.hashes(), words.count)
        edges = np.searchsorted(text, np.arange(len(texts) + 1))
        runs = pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.StructArray.from_arrays(
            [pa.array(start), pa.array(length), pa.array(period)], ["start", "length", "period"]))
        bounds, runs_of = edges.tolist(), list(zip(start.tolist(), length.tolist(), period.tolist()))
        kept = []
        for k, body in enumerate(texts):
            parts, mine = body.split(), runs_of[bounds[k]:bounds[k + 1]]
            if mine:
                stays = np.ones(len(parts), bool)
                for s, n, q in mine:
                    stays[s + q:s + n] = False
                parts = compress(parts, stays.tolist())
            kept.append(b" ".join(parts))
        yield pa.RecordBatch.from_arrays(
            [rows.column("_row"), pa.array(words.count), runs, pa.array(kept, pa.binary()).cast(pa.string())],
            ["_row", "n_words", "runs", "kept"])


def collapse(docs: DataFrame, text: str | Column = "text", keep: list[str] | None = None,
             slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """The columns ``keep`` (all if None) as the struct ``_row``, and n_words, runs, kept.

    runs has (start, length, period) of every periodic run, word numbers from 0, by start and period; kept is the text
    without the words that any run contains after its first period, the others joined by one space. Words are runs of
    characters other than ASCII white space, told apart by 64-bit hashes. Null and empty texts have no words and no runs.
    A row's result depends on its text alone: ties, repeated rows and other columns do not matter, the latter travel in a struct and
    so cannot clash. An empty table gives an empty result.
    """
    body = text_of(text) if isinstance(text, str) else F.coalesce(text.cast("string"), F.lit(""))
    columns = docs.columns if keep is None else keep
    # The columns travel as one value that Python hands back unread.
    rows = docs.select(F.struct(*(F.col(c) for c in columns)).alias("_row"), body.cast("binary").alias("_text"))
    kind = rows.schema["_row"].dataType.simpleString()
    return rows.mapInArrow(lambda b: _collapse(b, slice_bytes), f"_row {kind}, n_words bigint, runs array<{RUN}>, kept string")


def strongest(runs: Column) -> Column:
    """The run of greatest length / period, of those the first, of those the shortest period; null if there is none.

    Quotients of word numbers below 10^8 are told apart by doubles."""
    ranked = F.array_max(F.transform(runs, lambda r: F.struct(
        (r["length"] / r["period"]).alias("times"), (-r["start"]).alias("start"), (-r["period"]).alias("period"), r["length"].alias("length"))))
    return F.when(ranked.isNotNull(), F.struct((-ranked["start"]).alias("start"), ranked["length"].alias("length"),
                                               (-ranked["period"]).alias("period")))

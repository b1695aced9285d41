"""Language identification by prediction by partial matching.

Per language a tree of byte contexts of variable order is learned: for each context (the bytes before, up
to ``ORDER``, never beyond the start of the word) how often each byte followed. A byte costs
-log2 of its share in the longest context that knows it, plus the escapes from the longer contexts
that do not (escape share: distinct followers over followers + distinct followers; below the empty context all 257
symbols are alike). The statistics are frozen after learning. A text is in the language whose
tree gives it the shortest code.

Contexts start at the word, so a word's code length depends on the word alone, and each distinct word
is coded once per task and language.

Byte strings are numbers (``key_of``), so a model is sorted arrays, as long as the languages' own strings together.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepool.llm.common import text_of

ORDER = 5
END = b"\n"  # follows the last byte of a word
LEARN_ROWS = 2_000      # labelled documents learned from, per language, about
DRAWS = 1 << 62
MEMORY = 300_000        # distinct words a task remembers, about
MEMORY_BYTES = 64 << 20  # and bytes of their code lengths
SLICE_CHARS = 1 << 21
CELLS = 1 << 21         # bytes x languages looked at together
UNKNOWN = math.log2(257)

Model = dict[str, tuple[np.ndarray, np.ndarray]]  # language -> (keys, ascending; counts)
LETTERS = re.compile(r"[^\W\d_]+").findall


def _words(text: str) -> list[str]:
    return LETTERS(text.lower())


def key_of(gram: bytes) -> int:
    """A byte string of ORDER + 1 bytes at most as a number: its length, then its bytes."""
    return len(gram) << 48 | int.from_bytes(gram, "big")


def _contexts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        seen: dict[str, Counter] = {}
        for lang, text in zip(batch["lang"], batch["text"]):
            seen.setdefault(lang, Counter()).update(_words(text))
        for lang, words in seen.items():
            counts: Counter = Counter()
            for word, n in words.items():
                code = word.encode("utf-8", "surrogatepass") + END
                for i in range(len(code)):
                    for k in range(min(i, ORDER) + 1):
                        counts[code[i - k:i + 1]] += n
            yield pd.DataFrame({"lang": lang, "gram": [key_of(g) for g in counts], "n": list(counts.values())})


def learn(docs: DataFrame, labelled: Column, lang: str = "lang", text: str = "text", key: str = "doc_id",
          rows: int = LEARN_ROWS) -> Model:
    """The counts of byte strings by language, from the rows where ``labelled`` and the label is not null.

    Bounded sample: about ``rows`` documents of each language (all, if there are no more), those whose hash of key and text is
    below the language's share; whole texts, repeated rows once. No task gets a language's rows: only documents
    of the sample are shuffled. The model's size is bounded by that sample, summed over the languages.
    """
    known = docs.filter(labelled & F.col(lang).isNotNull())
    name = F.col(lang).cast("string")
    share = known.groupBy(name.alias("_lang")).agg((F.lit(rows) / F.count("*")).alias("_share"))
    drawn = known.select(name.alias("lang"), text_of(text).alias("text"),
                         F.shiftrightunsigned(F.xxhash64(key, text), 2).alias("_draw"))
    # One row per language, less than the model that the driver gets. Without the hint the texts would be shuffled by language.
    sample = drawn.join(F.broadcast(share), F.col("lang") == F.col("_lang")).filter(F.col("_draw") <= F.col("_share") * F.lit(float(DRAWS)))
    sample = sample.groupBy("lang", "_draw").agg(F.first("text").alias("text")).select("lang", "text")
    grams = sample.mapInPandas(_contexts, "lang string, gram bigint, n bigint").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    table = grams.toArrow()
    langs = table["lang"].combine_chunks().dictionary_encode()
    of, keys, n = langs.indices.to_numpy(), table["gram"].to_numpy(), table["n"].to_numpy()
    order = np.lexsort((keys, of))
    ends = np.cumsum(np.bincount(of, minlength=len(langs.dictionary)))
    parts = np.split(order, ends[:-1]) if len(ends) else []
    return {x: (keys[at], n[at]) for x, at in zip(langs.dictionary.to_pylist(), parts)}


class Lists(NamedTuple):
    """key -> (language, bits) of the languages that know it."""

    keys: np.ndarray
    starts: np.ndarray
    lang: np.ndarray
    bits: np.ndarray

    @staticmethod
    def of(parts: list[tuple[np.ndarray, np.ndarray]]) -> Lists:
        """From (keys, bits) of each language."""
        every = np.concatenate([keys for keys, _ in parts]) if parts else np.empty(0, np.int64)
        lang = np.repeat(np.arange(len(parts), dtype=np.int32), [len(keys) for keys, _ in parts])
        bits = np.concatenate([b for _, b in parts]) if parts else np.empty(0)
        order = np.argsort(every, kind="stable")
        keys, first = np.unique(every[order], return_index=True)
        return Lists(keys, np.append(first, len(every)), lang[order], bits[order])

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(place in ``keys``, language, bits) of all that is known."""
        at = np.searchsorted(self.keys, keys)
        place = np.flatnonzero(at < len(self.keys))
        place = place[self.keys[at[place]] == keys[place]]
        begin, length = self.starts[at[place]], np.diff(self.starts)[at[place]]
        flat = np.arange(length.sum()) + np.repeat(begin - np.cumsum(length) + length, length)
        return np.repeat(place, length), self.lang[flat], self.bits[flat]


def code_table(model: Model) -> tuple[list[str], Lists, Lists]:
    """(languages, bits of a string's last byte after the bytes before it, bits of the escape from a context)."""
    langs, grams, contexts = sorted(model), [], []
    for lang in langs:
        keys, n = model[lang]
        before, at = np.unique(((keys >> 48) - 1) << 48 | (keys & ((1 << 48) - 1)) >> 8, return_inverse=True)
        total, distinct = np.bincount(at, n), np.bincount(at)
        grams.append((keys, -np.log2(n / (total + distinct)[at])))
        contexts.append((before, -np.log2(distinct / (total + distinct))))
    return langs, Lists.of(grams), Lists.of(contexts)


class Coder:
    """Code lengths of words under all languages' frozen statistics."""

    def __init__(self, table: tuple[list[str], Lists, Lists]):
        self.langs, self.grams, self.contexts = table

    def bits(self, words: list[str]) -> np.ndarray:
        """Bits by word and language."""
        codes = [w.encode("utf-8", "surrogatepass") + END for w in words]
        out, begin = [np.empty((0, len(self.langs)))], 0
        while begin < len(codes):
            end, size = begin + 1, len(codes[begin])
            while end < len(codes) and (size + len(codes[end])) * len(self.langs) <= CELLS:
                size += len(codes[end])
                end += 1
            out.append(self._bits(codes[begin:end]))
            begin = end
        return np.concatenate(out)

    def _bits(self, codes: list[bytes]) -> np.ndarray:
        data = np.frombuffer(b"".join(codes), np.uint8).astype(np.int64)
        lengths = np.array([len(c) for c in codes])
        first = np.cumsum(lengths) - lengths
        place = np.arange(len(data)) - np.repeat(first, lengths)
        length = np.minimum(place, ORDER) + 1
        ending = data.copy()  # the last bytes at each place, ORDER + 1 at most, within the word
        for k in range(1, ORDER + 1):
            ending[k:] |= np.where(place[k:] >= k, data[:-k] << (8 * k), 0) if k < len(data) else 0
        # What a byte costs depends on these bytes alone.
        distinct, at = np.unique(length << 48 | ending, return_inverse=True)
        length, ending = distinct >> 48, distinct & ((1 << 48) - 1)
        bits = np.full((len(distinct), len(self.langs)), UNKNOWN)
        for k in range(ORDER + 1):  # k bytes before: a language knows the string, or escapes to the shorter one
            mine = np.flatnonzero(length > k)
            gram = ending[mine] & ((1 << (8 * k + 8)) - 1)
            row, lang, escape = self.contexts.find(k << 48 | gram >> 8)
            bits[mine[row], lang] += escape
            row, lang, known = self.grams.find((k + 1) << 48 | gram)
            bits[mine[row], lang] = known
        return np.add.reduceat(bits[at], first, axis=0)


def _predict(batches: Iterator[pd.DataFrame], coder: Coder, memory: int) -> Iterator[pd.DataFrame]:
    memory = min(memory, MEMORY_BYTES // (8 * max(1, len(coder.langs))))
    known: dict[str, int] = {}
    table = np.empty((0, len(coder.langs)))
    for batch in batches:
        texts = list(batch.pop("_langid_text"))
        langs, scores = ["und"] * len(texts), [0.0] * len(texts)
        begin = 0
        while begin < len(texts) and coder.langs:
            # Texts of a bounded length together, one at least.
            end, size = begin + 1, len(texts[begin])
            while end < len(texts) and size + len(texts[end]) <= SLICE_CHARS:
                size += len(texts[end])
                end += 1
            words = [_words(t) for t in texts[begin:end]]
            if len(known) > memory:
                known, table = {}, table[:0]
            new = list(set().union(*words).difference(known))
            if new:
                known.update(zip(new, range(len(known), len(known) + len(new))))
                table = np.concatenate([table, coder.bits(new)])
            for k, mine in enumerate(words, begin):
                if mine:
                    bits = table[np.fromiter(map(known.__getitem__, mine), np.int64, len(mine))].sum(axis=0)
                    best = int(bits.argmin())
                    langs[k] = coder.langs[best]
                    scores[k] = float(1.0 / np.exp2(np.minimum(bits[best] - bits, 0.0)).sum())
            begin = end
        batch["lang_pred"], batch["score"] = langs, scores
        yield batch


def predict(docs: DataFrame, model: Model, text: str = "text", keep: list[str] | None = None,
            memory: int = MEMORY) -> DataFrame:
    """The columns ``keep`` of ``docs`` (None: all) plus lang_pred and score.

    ``und`` with score 0 if the text is null or has no letter, or if no language was learned. The score
    is the language's share of 2^-code length over all languages. Ties go to the language that sorts
    first. Only the text enters a prediction; columns of the result's names are replaced.
    """
    keep = [c for c in (docs.columns if keep is None else keep) if c not in ("lang_pred", "score")]
    coder = docs.sparkSession.sparkContext.broadcast(code_table(model))  # sum over the languages of a bounded sample
    rows = docs.select(*keep, text_of(text).alias("_langid_text"))
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields if f.name != "_langid_text"),
                        "lang_pred string", "score double"])
    return rows.mapInPandas(lambda b: _predict(b, Coder(coder.value), memory), schema)

import gc
import itertools
import os
import subprocess
import sys
import weakref
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tests.conftest import SF_SMALL
from tidepool.llm import common, tokens
from tidepool.llm.queries import END_ID, QUERIES, tokenizer_path


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 1), st.integers(0, 60000), st.integers(0, 2**64 - 1)), max_size=3000))
def test_pack_round_trip(ids):
    ids = np.array(ids, np.uint64)
    words, offsets, escapes = tokens.pack(ids)
    assert (tokens.unpack(words, escapes) == ids).all()
    for lane, begin in enumerate(offsets):
        end = offsets[lane + 1] if lane + 1 < len(offsets) else len(words)
        assert (tokens.unpack(words[begin:end], escapes) == ids[lane * tokens.LANE:(lane + 1) * tokens.LANE]).all()


def test_pack_runs_of_one_width():
    for width in (0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60, 63):
        ids = np.full(5000, (1 << width) - 1, np.uint64)
        words, _, escapes = tokens.pack(ids)
        assert (tokens.unpack(words, escapes) == ids).all()
    assert len(tokens.pack(np.zeros(1024, np.uint64))[0]) < 20


TEXTS = ["", " ", "\n\n", "don't STOP 's 're123 x\ty\x0bz\x85w  end", "Éà é ÇA İstanbul ΣΑΣ ß ﬁ", "a<|endoftext|>b <|startoftext|>",
         "​　日本語 テスト\x1c\x1d", "###$$$ a.b,c;d'll'd", "x" * 5000, "́ ́a", "naïve café don’t"]


@pytest.fixture(scope="module")
def whole():
    return Tokenizer.from_file(tokenizer_path())


def test_word_ids_equal_whole_text_ids(whole):
    ids, counts = tokens.WordIds(tokenizer_path())(TEXTS)
    want = [e.ids for e in whole.encode_batch(TEXTS, add_special_tokens=False)]
    assert counts.tolist() == [len(w) for w in want]
    assert ids.tolist() == [i for w in want for i in w]


@settings(max_examples=200, deadline=None)
@given(text=st.text(max_size=60))
def test_word_ids_equal_on_any_text(whole, text):
    ids, _ = tokens.WordIds(tokenizer_path())([text])
    assert ids.tolist() == whole.encode(text, add_special_tokens=False).ids


def brute(whole, rows):
    out, start = [], 0
    for key, text in rows:
        ids = whole.encode(text or "", add_special_tokens=False).ids + [END_ID]
        out.append((key, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_query_equals_brute_force(spark, whole):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    got = QUERIES["op1_simple8b"](spark, SF_SMALL).select("doc_id", "start", "n_tokens", "ids_crc32").collect()
    assert sorted(map(tuple, got)) == brute(whole, [tuple(r) for r in docs])


def test_nulls_ties_and_empty(spark, whole):
    rows = [(3, "b b"), (None, "n"), (1, None), (2, ""), (3, "b b"), (4, "<|endoftext|> é")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS shard", "2 AS n_tokens")
    got = tokens.decode(spark, tokens.encode(docs, tokenizer_path(), END_ID, block_ids=3))
    got = [tuple(r) for r in got.select("doc_id", "start", "n_tokens", "ids_crc32").orderBy("start").collect()]
    assert got == brute(whole, sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)))
    none = tokens.decode(spark, tokens.encode(docs.limit(0), tokenizer_path(), END_ID))
    assert none.count() == 0


def test_a_tokenizer_of_other_rules_encodes_whole_texts():
    folder = os.path.dirname(tokenizer_path())
    assert tokens.WordIds(tokenizer_path()).by_words
    path = os.path.join(folder, "byte_bpe_50k.json")
    other, ids_of = Tokenizer.from_file(path), tokens.WordIds(path)
    assert not ids_of.by_words
    texts = [*TEXTS, "A plain English sentence, with words."]
    ids, number = ids_of(texts)
    want = [other.encode(t, add_special_tokens=False).ids for t in texts]
    assert ids.tolist() == [i for w in want for i in w] and number.tolist() == [len(w) for w in want]
    assert [len(x) for x in ids_of([])] == [0, 0]


def test_words_of_known_pieces_need_no_call_each():
    """The work of a call goes with new pieces; words that are put together from known ones are split and looked up together."""
    ids_of = tokens.WordIds(tokenizer_path())
    pieces, marks = [f"{a}{b}" for a, b in itertools.product("bcdfgh", ["ao", "eu"])], [",", ".", "!?", "-", ")", "'s"]
    ids_of([" ".join(pieces + marks)])
    text = " ".join(a + b + c for a, b, c in itertools.product(pieces, marks, [p.upper() for p in pieces]))
    want = Tokenizer.from_file(tokenizer_path()).encode(text, add_special_tokens=False).ids
    calls = []
    sys.setprofile(lambda frame, event, arg: calls.append(frame) if event == "call" else None)
    try:
        ids, number = ids_of([text])
    finally:
        sys.setprofile(None)
    assert ids.tolist() == want and number.tolist() == [len(want)]
    assert len(calls) < 100 < len(text.split()) / 8


@pytest.mark.parametrize("older", [0, 1])
def test_a_new_memory_gives_the_same_ids(whole, older):
    ids_of = tokens.WordIds(tokenizer_path(), memory=0, older=older)
    for k in range(4):
        texts = [*TEXTS, "", "only Latin ones", f"n{k} \u023a\u023e\u0130 \u01c5\u00b5\u1e9e H\u0331 a\u0301"] * (1 + k % 2)
        ids, counts = ids_of(texts)
        want = [whole.encode(t, add_special_tokens=False).ids for t in texts]
        assert counts.tolist() == [len(w) for w in want]
        assert ids.tolist() == [i for w in want for i in w]
        assert (ids_of.known.before is not None) == bool(older)
        assert older == 0 or ids_of.known.before.before is None


def test_a_memory_given_up_is_freed_without_collection():
    gc.disable()
    try:
        ids_of = tokens.WordIds(tokenizer_path())
        ids_of(["some words"])
        known = weakref.ref(ids_of.known)
        del ids_of
        assert known() is None
    finally:
        gc.enable()


def test_blocks_hold_whole_documents(spark, whole):
    rows = [(k, " ".join(f"w{k}x{i}" for i in range(k % 7 * 3))) for k in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    folder = tokens.encode(docs, tokenizer_path(), END_ID, block_ids=40, slice_chars=50)
    got = tokens.decode(spark, folder).select("doc_id", "start", "n_tokens", "ids_crc32").orderBy("start").collect()
    assert [tuple(r) for r in got] == brute(whole, rows)
    for r in spark.read.schema(tokens.BLOCK_SCHEMA).parquet(folder).collect():
        assert sum(r.n_tokens) == r.n_ids and sum(r.n_tokens[:-1]) < 40


#: Runs in a process of its own, prints the MB that it has grown by.
GROWS = """
import re
from pathlib import Path
import pyarrow as pa
from tidepool.llm import tokens
from tidepool.llm.common import give_back
from tidepool.llm.queries import tokenizer_path

def held():
    return sum(map(int, re.findall(r"Anonymous:\\s+(\\d+)", Path("/proc/self/smaps_rollup").read_text()))) / 1024

for k in range(9):
    words = tokens.WordIds(tokenizer_path(), 32 << 20, 0)
    words([" ".join("".join(chr(97 + int(d)) for d in f"{j * 7919 + k:012d}") * 2 for j in range(20_000))])
    del words
    give_back()
    if k == 0:
        first = held()
print(held() - first)
"""


def test_tasks_that_keep_nothing_leave_no_words_behind():
    grown = subprocess.run([sys.executable, "-c", GROWS], capture_output=True, text=True, check=True, cwd=os.path.dirname(common.__file__) + "/../..").stdout
    assert float(grown) < 12


def test_a_task_ends_by_giving_memory_back(monkeypatch):
    calls = []
    monkeypatch.setattr(common, "give_back", lambda: calls.append(1))
    rows = common.giving_back(iter([1, 2]))
    assert next(rows) == 1 and not calls
    assert list(rows) == [2] and calls == [1]

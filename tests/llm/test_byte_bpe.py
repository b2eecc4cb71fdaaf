import base64
import hashlib
import random

import corpus
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from local import frame

from lapsewise.llm import byte_bpe
from lapsewise.llm.common import forget_others, map_arrow

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")
with open(PATH, "rb") as file:
    CONTENT = file.read()
ENCODER, DECODER = byte_bpe.coders(CONTENT, public_tokenizers.PATTERN)
LIBRARY = tiktoken.Encoding(
    "own",
    pat_str=public_tokenizers.PATTERN,
    mergeable_ranks={base64.b64decode(a): int(b) for a, b in map(bytes.split, CONTENT.splitlines())},
    special_tokens={},
)
PARTS = ["the", "ing", " ", "  ", "\n", "é", "ß", "中", "😀", "1", "23", "'s", "'ll", "!", "...", "‍", "א", "\x00", "AAAA", "=====", "ab", "th"]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(PARTS), max_size=40).map("".join))
def test_parts_as_the_library(text):
    ids = ENCODER.encode(text).tolist()
    assert ids == LIBRARY.encode_ordinary(text)
    assert DECODER.decode(ids) == text.encode()


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=80))
def test_any_text_as_the_library(text):
    assert ENCODER.encode(text).tolist() == LIBRARY.encode_ordinary(text)


def test_long_pieces_as_the_library():
    draw = random.Random(1)
    for alphabet in ("a", "ab", "aeinorst", "=", "ßé", "01"):
        text = "".join(draw.choices(alphabet, k=3000))
        assert ENCODER.encode(text).tolist() == LIBRARY.encode_ordinary(text)


def test_bounds_change_no_result():
    small = byte_bpe.Encoder(CONTENT, public_tokenizers.PATTERN, max_states=20, max_pieces=5)
    for text in corpus.shaken(3, PARTS + ["tokenizer", "Anticonstitution"], 60):
        assert small.encode(text).tolist() == LIBRARY.encode_ordinary(text)
    assert len(small.states) <= 21 and len(small.known) <= 6


def test_tokens_come_out_before_the_end():
    state, out = ENCODER.start, []
    for byte in b"internationalization" * 3:
        state, made = state.next.get(byte) or ENCODER._step(state, byte)
        out += made
    assert len(out) > 3 and len(b"".join(ENCODER.merges.tokens[t] for t in state.live[-1][2])) < 30


@settings(max_examples=300, deadline=None)
@given(st.lists(st.binary(max_size=5), max_size=8))
def test_incremental_utf8(parts):
    held, text = b"", ""
    for part in parts:
        made, held = byte_bpe.advance(held, part)
        text += made
    assert text + ("�" if held else "") == b"".join(parts).decode("utf-8", "replace")


@pytest.mark.parametrize("seed", range(3))
def test_any_ids_decode(seed):
    ids = random.Random(seed).choices(range(50_256), k=400)
    small = byte_bpe.Decoder(DECODER.tokens, max_steps=10)
    want = b"".join(DECODER.tokens[i] for i in ids).decode("utf-8", "replace")
    assert DECODER.decode(ids).decode() == small.decode(ids).decode() == want


def expected(text):
    ids = LIBRARY.encode_ordinary(text or "")
    return len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()


def check(df):
    got = byte_bpe.digests(byte_bpe.round_trip(df)).collect()
    want = [(r["doc_id"], *expected(r["text"])) for r in df.collect()]
    assert sorted((tuple(r) for r in got), key=str) == sorted(want, key=str)


def test_awkward_rows(spark):
    check(corpus.awkward(spark))


def test_given_documents(spark):
    check(spark.read.parquet(f"{corpus.SMALL}/documents.parquet"))


def test_empty_table(spark):
    assert byte_bpe.digests(byte_bpe.round_trip(corpus.empty(spark))).count() == 0


def test_encode_then_decode(spark):
    df = frame(spark, corpus.rows(["héllo wörld", None, ""]), corpus.DDL)
    decoded = byte_bpe.decode(byte_bpe.encode(df)).collect()
    assert sorted((r["doc_id"], bytes(r["decoded"]).decode()) for r in decoded) == [(0, "héllo wörld"), (1, ""), (2, "")]


def test_other_work_drops_the_coders(spark):
    documents = frame(spark, corpus.rows(["one text", "two texts"] * 8), corpus.DDL).repartition(4)
    held = lambda batch: {"n": [byte_bpe.coders.cache_info().currsize] * batch.num_rows}
    assert byte_bpe.round_trip(documents).count() == 16
    assert {r["n"] for r in map_arrow(documents.select("doc_id"), held, "n long").collect()} == {0}
    byte_bpe.coders(CONTENT, public_tokenizers.PATTERN)
    forget_others(byte_bpe.__name__)
    assert byte_bpe.coders.cache_info().currsize > 0
    forget_others()
    assert byte_bpe.coders.cache_info().currsize == 0

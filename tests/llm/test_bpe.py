import hashlib
import struct

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from quern.llm.bpe import BytePairs, ByteReader, decode_column, encode_column, encode_digests, lookahead
from tests.llm.data import TEXTS, documents

PATH = public_tokenizers.path("word_bpe_49k.json")
OWN, KNOWN = BytePairs(PATH), Tokenizer.from_file(PATH)
AWKWARD = [
    "", "a<|endoftext|>b", "<|startoftext|><|ENDOFTEXT|> <|endoftext", "ΑΣ ΑΣ. ſ İ x\x1cy\x85z   ½ ²x ٣",
    "'s't'll don't 'LL I'VE", "\x00\x01é́ é ﬁ Å 日本語 한국어 \U0001d4b3", "!!! — … ​﻿", "   \n\t ",
    "aaaa" * 900, "the" * 900 + "ing" * 700, "!?" * 1500, "exhilarating" * 300,
]


def known_ids(text):
    return KNOWN.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("text", AWKWARD + [t for _, t in TEXTS if t])
def test_same_ids_and_decoded_text(text):
    ids = list(OWN.encode(text))
    assert ids == known_ids(text)
    assert OWN.decode(ids) == KNOWN.decode(ids, skip_special_tokens=False)


@settings(max_examples=200, deadline=None)
@given(st.text(st.characters(exclude_categories=("Cs", "Cn")), max_size=60))
def test_any_text(text):
    assert list(OWN.encode(text)) == known_ids(text)


def test_smallest_window_gives_the_same():
    """Streaming emits only what is final, even with no room beyond the lookahead."""
    tight = BytePairs(PATH)
    tight.window = tight.lookahead + 1
    for text in AWKWARD:
        assert list(tight.encode(text)) == known_ids(text)


def test_streaming_holds_a_window_only():
    longest = 0

    class Watched(BytePairs):
        def merge(self, ids):
            nonlocal longest
            longest = max(longest, len(ids))
            return super().merge(ids)

    pairs = Watched(PATH)
    ids = list(pairs.encode("abcdefghij" * 3000))
    assert ids == known_ids("abcdefghij" * 3000) and longest <= pairs.window


def test_lookahead_of_small_lists():
    assert lookahead([("a", "b")], len) == 1
    # After a, "bc" can still take its b: the boundary moves over b, and then over a.
    assert lookahead([("b", "c"), ("a", "bc")], len) == 2
    assert lookahead([("a", "b"), ("c", "d")], len) == 1


def test_forgetting_changes_nothing():
    small = BytePairs(PATH, limit=2)
    for _, text in TEXTS:
        if text and len(text) < 5000:
            packed = b"".join(p for c in small.chunks(text) for _, p, _ in small.measured(c))
            assert packed == struct.pack(f"<{len(known_ids(text))}I", *known_ids(text))


def test_reader_spells_the_text():
    for text in ("Héllo wörld 日本 \U0001d4b3!", "a<|endoftext|>b", "don't"):
        reader = ByteReader(OWN)
        said = "".join([*map(reader.feed, OWN.encode(text)), reader.finish()])
        assert said.replace(" ", "") == text.lower().replace(" ", "")
    reader = ByteReader(OWN)
    half = OWN.symbols["é".encode()[0]]
    assert reader.feed(half) == "" and reader.finish() == "�"


def test_awkward_documents(spark):
    rows = encode_digests(documents(spark, extra="1 AS N_tokens"), PATH).collect()
    got = sorted((r.doc_id is None, r.doc_id or 0, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in rows)
    want = []
    for i, text in TEXTS:
        ids = known_ids(text or "")
        said = KNOWN.decode(ids, skip_special_tokens=False)
        packed = struct.pack(f"<{len(ids)}I", *ids)
        want.append(
            (i is None, i or 0, len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256(said.encode()).hexdigest())
        )
    assert got == sorted(want)
    assert encode_digests(documents(spark, []), PATH).count() == 0


def test_ids_and_back(spark):
    rows = [(1, "Plain words, twice."), (2, None), (3, "")]
    back = decode_column(encode_column(documents(spark, rows), PATH), PATH).orderBy("doc_id").collect()
    assert [r.decoded for r in back] == ["plain words , twice .", "", ""]
    assert [list(r.token_ids) for r in back] == [known_ids(t or "") for _, t in rows]

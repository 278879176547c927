from __future__ import annotations

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from supplylens.llm import piece_codec, word_tokens
from supplylens.llm.vocabularies import vocabulary

spm = pytest.importorskip("sentencepiece")
PATH = vocabulary("piece_bpe_32k.model")
WORDS = vocabulary("word_bpe_49k.json")
LIBRARY = spm.SentencePieceProcessor(model_file=PATH)
OWN = piece_codec.codec(PATH)
TEXT = st.text(alphabet="aabbeett  \n\t.,'!<>0159ÉéñßİΣ漢😀▁\x00|#", max_size=60)


@settings(max_examples=400, deadline=None)
@given(TEXT)
def test_ids_and_text_equal_the_library(text):
    ids = LIBRARY.encode(text)
    assert OWN.encode(text) == ids
    assert OWN.encode_and_decode(text)[1] == LIBRARY.decode(ids) == OWN.decode(ids)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(259, 31_999), max_size=8))
def test_joined_pieces_equal_the_library(ids):
    text = "".join(OWN.pieces[i] for i in ids).replace("▁", " ")
    assert OWN.encode(text) == LIBRARY.encode(text)


def test_long_runs_of_blanks_and_words():
    for n in range(1, 70):
        for text in (" " * n, " " * n + "the", "a" + " " * n + "b", "x" * n, "ab" * n):
            assert OWN.encode(text) == LIBRARY.encode(text)


def test_rows(awkward, nothing):
    found = piece_codec.encode_and_decode(awkward, PATH).collect()
    want = sorted((r.doc_id is None, r.doc_id or 0, LIBRARY.encode(r.text or "")) for r in awkward.collect())
    assert sorted((r.doc_id is None, r.doc_id or 0, r.ids) for r in found) == want
    assert all(r.decoded == LIBRARY.decode(r.ids) for r in found)
    assert piece_codec.encode_and_decode(nothing, PATH).count() == 0


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet="aAeEtTsS'’<|>dlmrv 09.,!Éé́漢İΣς\n\x85\x1c", max_size=40), max_size=6))
def test_word_tokens_equal_the_library(texts):
    own = word_tokens.word_tokens(WORDS)
    texts = [*texts, "<|endoftext|>x", "<|ENDOFTEXT|>", "it's they'LL '''s"]
    ids, offsets = own.encode_rows(pa.array(texts))
    for k, text in enumerate(texts):
        assert ids[offsets[k] : offsets[k + 1]].tolist() == own.tokenizer.encode(text, add_special_tokens=False).ids

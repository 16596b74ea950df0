"""Packing reads added tokens as the tokenizer does as loaded."""

import functools
import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from gaugeline.llm import packing
from gaugeline.llm.queries import tokenizer_path
from test_first import docs

END = "<|endoftext|>"
TEXTS = [f"hello {END} world", END, f"{END}{END}", f"a  {END}\n\n b {END}", f"<|endoftext{END}|>", "<|endoftext|", f" x{END} {END}y", f"a b {END} c " * 2000]


@functools.cache
def loaded():
    return Tokenizer.from_file(tokenizer_path()), packing.Encoder(tokenizer_path(), memory=50)


def loaded_ids(texts):
    return [e.ids for e in loaded()[0].encode_batch(texts, add_special_tokens=False)]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.just(END), st.text(alphabet=st.sampled_from(" \n\t\u00a0ab's1.<|>é"), max_size=8)), max_size=8))
def test_encoder_equals_tokenizer_as_loaded(parts):
    enc = loaded()[1]
    texts = ["".join(parts), *TEXTS[:-1]]
    for text, want in zip(texts, loaded_ids(texts), strict=True):
        assert np.frombuffer(enc.whole_ids(text), "<u4").tolist() == want, text


def test_packed_ids_of_added_tokens(spark):
    assert loaded_ids(TEXTS[:1]) == [[31373, 220, 50256, 995]]
    got = {}
    for r in packing.pack_documents(docs(spark, TEXTS), tokenizer_path(), with_ids=True).collect():
        got.setdefault(r["doc_id"], []).append(r)
    for doc, want in enumerate(loaded_ids(TEXTS)):
        pieces = sorted(got[doc], key=lambda r: r["start"])
        assert [i for r in pieces for i in r["ids"]] == [*want, 0]
        assert all(zlib.crc32(np.asarray(r["ids"], "<u4").tobytes()) == r["ids_crc32"] and len(r["ids"]) == r["length"] for r in pieces)

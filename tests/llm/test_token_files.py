import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from watchmill.llm import token_files as token_files_module
from watchmill.llm.token_files import EliasFano, Encoder, TokenFile, token_files, write_token_files
from watchmill.session import fresh_path

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)
ENCODER = Encoder(PATH)
PIECES = st.sampled_from([*"abcXYZ ,.'!\n\t0é", "É", "ß", "İ", "K", "½", "中", "\x00", "\x1c", "\x85", "́", "<|endoftext|>", "'ll", "ﬁ", "Don't,"])


@settings(max_examples=300, deadline=None)
@given(st.lists(PIECES, max_size=15).map("".join))
def test_ids_are_those_of_the_whole_text(text):
    assert np.frombuffer(ENCODER.encode([text])[0], np.uint32).tolist() == LIBRARY.encode(text, add_special_tokens=False).ids


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 1 << 40), max_size=400))
def test_elias_fano(values):
    values.sort()
    again = EliasFano.from_bytes(EliasFano.of(np.array(values, np.uint64)).to_bytes())
    assert again.values().tolist() == values
    assert [again.select(i) for i in range(len(values))] == values
    with pytest.raises(IndexError):
        again.select(len(values))


def test_elias_fano_is_small():
    ends = np.cumsum(np.random.default_rng(1).integers(1, 2000, 10_000)).astype(np.uint64)
    assert len(EliasFano.of(ends).to_bytes()) * 8 < 10_000 * (2.1 + np.log2(ends[-1] / 10_000))


def brute(rows):
    out, at = [], 0
    for doc, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = [*LIBRARY.encode(text or "", add_special_tokens=False).ids, 2]
        out.append((doc, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    return out


def test_round_trip(odd_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    for shard in (1 << 20, 1000):
        got = [tuple(r) for r in token_files(odd_docs, PATH, shard_bytes=shard).collect()]
        assert sorted(got, key=str) == sorted(brute(rows), key=str)


def test_one_document_by_select(spark, odd_docs):
    folder = fresh_path(spark, "tokens-test")
    write_token_files(odd_docs.filter("doc_id > 3"), folder, PATH)
    blobs = spark.read.format("binaryFile").option("pathGlobFilter", "*.tok").load(folder).collect()
    files = sorted(blobs, key=lambda r: r.path)
    texts = {r.doc_id: r.text for r in odd_docs.collect()}
    seen = []
    for f in map(lambda r: TokenFile(r.content), files):
        for i, doc in enumerate(f.doc_ids()):
            assert f.document(i).tolist() == [*LIBRARY.encode(texts[doc] or "", add_special_tokens=False).ids, 2]
            seen.append(doc)
    assert seen == [4, 5, 6, 7, 8, 9]


def test_empty(no_docs):
    assert token_files(no_docs, PATH).collect() == []


def test_frequent_words_stay_known(monkeypatch):
    """A full memory of words loses those that came last, not all of them."""
    monkeypatch.setattr(token_files_module, "CACHED_WORDS", 8)
    encoder = Encoder(PATH)
    encoder.encode(["the and of"])
    texts = [" ".join(f"the {chr(97 + i)}{chr(97 + j)}q, of" for j in range(10)) for i in range(6)]
    for text in texts:
        assert np.frombuffer(encoder.encode([text])[0], np.uint32).tolist() == LIBRARY.encode(text, add_special_tokens=False).ids
    encoder.encode(["the"])
    assert {"the", "and", "of"} <= set(encoder.known) and len(encoder.known) <= 20

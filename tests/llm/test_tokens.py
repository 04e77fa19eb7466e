import hashlib
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from llm_fixtures import SF, clashing, empty, labels, odd, workers_find_the_package  # noqa: F401
from hypothesis import given, settings
from hypothesis import strategies as st

from topicweave.llm import bpe, token_counts, token_files
from topicweave.llm.pieces import Remembered, parts

MULTI, PATTERN = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
RANKS = bpe.read_ranks(MULTI)
TIKTOKEN = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=RANKS, special_tokens={})
VOCABULARY = bpe.vocabulary(MULTI, PATTERN)
TEXT = st.text(st.sampled_from("ab \n\t  'srevtdlmReéß漢🙂\u00a0\u2003\x1c\x8512!?.TheING"), max_size=40)


def ids(data):
    return list(memoryview(data).cast("I"))


@settings(max_examples=1500, deadline=None)
@given(TEXT)
def test_same_ids_as_the_library(text):
    assert ids(VOCABULARY.encode(text)) == TIKTOKEN.encode_ordinary(text)
    assert VOCABULARY.decode(VOCABULARY.encode(text)) == text.encode() and " ".join([parts(text)[0], *parts(text)[1]]) == text


@settings(max_examples=800, deadline=None)
@given(TEXT, TEXT)
def test_append(text, more):
    assert VOCABULARY.append(text, VOCABULARY.encode(text), more) == VOCABULARY.encode(text + more)


@settings(max_examples=500, deadline=None)
@given(st.binary(max_size=25), st.integers(0, 25), st.integers(0, 25), st.binary(max_size=6))
def test_pieces_under_change(data, start, end, new):
    piece = bpe.Piece(VOCABULARY.encoder, data)
    piece.append(new)
    assert piece.ids() == VOCABULARY.encoder.encode(data + new)
    start, end = sorted((min(start, len(data)), min(end, len(data))))
    piece.replace(start, end, new)
    assert piece.ids() == VOCABULARY.encoder.encode(data[:start] + new + data[end:] + new)


def test_small_caches_change_nothing():
    small = bpe.Vocabulary(RANKS, PATTERN, cached=3)
    for text in ("the cat sat on the mat the cat", "a b c a b c d e f"):
        assert ids(small.encode(text)) == TIKTOKEN.encode_ordinary(text)
    calls = Remembered(lambda x: x, 2)
    assert [calls[i] for i in (1, 2, 3, 1, 4, 5)] == [1, 2, 3, 1, 4, 5] and len(calls) + len(calls.old) <= 4


@pytest.mark.parametrize("name", ["odd", "clashing", "real"])
def test_encoded_table(spark, request, name):
    docs = spark.read.parquet(f"{SF}/documents.parquet") if name == "real" else request.getfixturevalue(name)
    def row(doc_id, text):
        data = np.array(TIKTOKEN.encode_ordinary(text or ""), "<u4").tobytes()
        return str(doc_id), len(data) // 4, hashlib.sha256(data).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()

    want = sorted(row(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect())
    assert sorted((str(r[0]).removesuffix(".0"), *r[1:]) for r in bpe.encode_table(docs, MULTI, PATTERN).collect()) == want


@pytest.mark.parametrize("name", ["odd", "clashing", "real"])
def test_token_files(spark, request, name):
    from tokenizers import Tokenizer

    docs = spark.read.parquet(f"{SF}/documents.parquet") if name == "real" else request.getfixturevalue(name)
    path = public_tokenizers.path("byte_bpe_50k.json")
    tokenizer = Tokenizer.from_file(path)
    files = token_files.write(docs, path, 50_257, files=3)
    got = sorted(token_files.read(files).collect(), key=lambda r: r["start"])
    want, start = [], 0
    for r in sorted(docs.select("doc_id", "text").collect(), key=lambda r: -1 if r["doc_id"] is None else r["doc_id"]):
        found = [*tokenizer.encode(r["text"] or "", add_special_tokens=False).ids, 0]
        want.append((r["doc_id"], start, len(found), zlib.crc32(np.array(found, "<u4").tobytes())))
        start += len(found)
    assert [tuple(r) for r in got] == want
    assert files.agg({"tokens": "sum"}).collect()[0][0] == start


def test_token_files_of_nothing(empty):
    assert token_files.read(token_files.write(empty, public_tokenizers.path("byte_bpe_50k.json"), 50_257)).count() == 0
    with pytest.raises(ValueError):
        token_files.mounted("s3://bucket/folder")


def test_section_counts(odd, clashing, empty):
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    encoding = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=bpe.read_ranks(path), special_tokens={})
    texts = [(r["doc_id"], r["text"] or "") for r in odd.collect()]
    want = []
    for doc_id, text in texts:
        lines = text.splitlines(keepends=True) if set(text) <= set("\n abcdefghijklmnopqrstuvwxyz0123456789") else None
        lines = lines or [x + "\n" for x in text.split("\n")[:-1]] + [text.split("\n")[-1]] * bool(text.split("\n")[-1] or not text.strip("\n"))
        lines = [x for x in lines if x] or [""]
        bounds = np.cumsum([0] + [len(x.encode()) for x in lines])
        counts, at = [0] * len(lines), 0
        for token in encoding.encode_ordinary(text):
            size = len(encoding.decode_single_token_bytes(token))
            overlap = [min(at + size, bounds[k + 1]) - max(at, bounds[k]) for k in range(len(lines))]
            counts[int(np.argmax(overlap))] += 1
            at += size
        want += [(doc_id, k, sum(map(len, lines[:k])), sum(map(len, lines[:k + 1])), n) for k, n in enumerate(counts)]
    key = lambda r: (r[0] is None, r[0], r[1])
    for docs in (odd, clashing):
        got = token_counts.section_counts(docs, path, PATTERN).collect()
        assert sorted((tuple(r)[:5] for r in got), key=str) == sorted(want, key=str), key
        per_doc = token_counts.document_counts(docs, path, PATTERN).collect()
        assert sorted((str(r["doc_id"]), r["n_tokens"]) for r in per_doc) == sorted((str(d), len(encoding.encode_ordinary(t))) for d, t in texts)
    assert token_counts.section_counts(empty, path, PATTERN).count() == token_counts.document_counts(empty, path, PATTERN).count() == 0


def test_crossing_tokens_go_to_the_larger_side():
    owner, crossing = token_counts.attribute(np.array([3, 8, 10]), np.array([0, 4, 9]))
    assert owner.tolist() == [0, 1, 1] and crossing.tolist() == [False, True, True]


def test_query_returns_every_section(spark):
    from topicweave.llm import queries

    got = queries.op8_token_counts(spark, SF)
    want = sum(max(1, len(token_counts.line_starts((r["text"] or "").encode()))) for r in spark.read.parquet(f"{SF}/documents.parquet").collect())
    assert got.columns == ["doc_id", "section", "start", "end", "n_tokens", "n_crossing"] and got.count() == want


def test_known_parts_are_looked_through_once_a_batch(monkeypatch):
    import pyarrow as pa
    import pyarrow.compute as pc

    from topicweave.llm import token_files

    encoder = token_files.PartEncoder(public_tokenizers.path("byte_bpe_50k.json"), "<u2", known=6)
    whole = token_files.PartEncoder(public_tokenizers.path("byte_bpe_50k.json"), "<u2")
    looked, find = [], pc.index_in
    monkeypatch.setattr(pc, "index_in", lambda *a, **k: (looked.append(1), find(*a, **k))[1])
    batches = [["a b c d", "a b"], ["c e f g", "b"], ["h i j k l", "g e"], ["g e a", ""], ["m n o p q r s t", "g"]]
    for batch in batches:
        ids, lengths = encoder.encode(pa.array(batch), 0)
        at = len(looked)
        want = [whole.tokenizer.encode(t, add_special_tokens=False).ids + [0] for t in batch]
        assert ids.tolist() == [i for x in want for i in x] and lengths.tolist() == [len(x) for x in want] and at == len(looked)
    assert len(looked) == len(batches)

"""Token files: what is written is read back, and equals plain encoding by the library."""

import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

import public_tokenizers
from tests.conftest import SMALL
from tests.llm.fixtures import ODD_TEXTS, documents
from velotrace.llm import token_files
from velotrace.llm.elias_fano import EliasFano
from velotrace.llm.token_query import op11_token_files
from tokenizers import Tokenizer

PATH = public_tokenizers.path("word_bpe_49k.json")
plain = Tokenizer.from_file(PATH)


def by_library(text, path=PATH, end=2):
    tokenizer = plain if path == PATH else Tokenizer.from_file(path)
    return tokenizer.encode(text or "", add_special_tokens=False).ids + [end]


@given(st.lists(st.integers(-(2**63), 2**63 - 1), max_size=700), st.booleans())
@settings(max_examples=60, deadline=None)
def test_elias_fano_round_trip(values, close):
    values = np.sort(np.array([v % 1000 if close else v for v in values], dtype=np.int64))
    code, end = EliasFano.read(b"xx" + EliasFano.of(values).to_bytes() + b"y", 2)
    assert code.values().tolist() == values.tolist()
    assert [code.select(i) for i in range(len(values))] == values.tolist()
    assert end == len(EliasFano.of(values).to_bytes()) + 2
    with pytest.raises(IndexError):
        code.select(len(values))


def test_boundaries_are_near_minimal():
    ends = np.cumsum(np.random.default_rng(1).integers(1, 1000, 50_000))
    bits = 8 * len(EliasFano.of(ends).to_bytes()) / len(ends)
    assert bits < 2 + np.log2(ends[-1] / len(ends)) + 0.5


ODD = ODD_TEXTS + [
    "Á H̱, Åx İ. it's IT'S, don't. a,b ..., ,, x., 1234 n0t <|endoftext|> <|ENDOFTEXT|>x a<|startoftext|>.",
    "é.́ ok.̸ #, a.,!  em　wide \u0085 \x1c\x1d\x00z ​ zero",
    "Σίσυφος ΣΑΣ ΣΑΣ. ǅ ß ﬁ",
    "漢字" * 3000 + " " + "x" * 5000 + " " + "word, " * 4000,
]


@given(st.text(max_size=60))
@settings(max_examples=300, deadline=None)
def test_word_by_word_is_the_same(text):
    ids = np.frombuffer(token_files.encoder(PATH)(text), "<u2").tolist()
    assert ids + [2] == by_library(text)


def test_every_letter_of_the_short_way():
    encode = token_files.encoder(PATH)
    letters = [chr(c) for c in range(0x21, 0x260) if not 0x7F <= c <= 0xA0]
    for x in letters:
        for text in (x, f"a{x}", f"{x}b.", f"{x},", f"A{x}É..", f"{x.upper()}{x}"):
            assert np.frombuffer(encode(text), "<u2").tolist() == by_library(text)[:-1], text


@pytest.mark.parametrize("path", [PATH, public_tokenizers.path("byte_bpe_50k.json")])
def test_files_hold_what_the_library_gives(spark, frame, path, monkeypatch):
    rows = [(i * 10**15 - 10**17, t) for i, t in enumerate(ODD)]
    rows += [(None, "no id"), (None, None), (5, "same"), (5, "same"), (5, "other")]
    rows += [(7, "copy")] * 300 + [(1000 + i, "copy") for i in range(300)]
    folder = token_files.new_token_folder(spark)
    token_files.write_tokens(documents(frame, rows, extra=True), folder, path, 2, file_bytes=700)
    got = token_files.read_tokens(spark, folder, with_ids=True).orderBy("start").collect()
    assert [r.doc_id for r in got] == sorted((r[0] for r in rows), key=lambda d: (d is not None, d))
    at = 0
    for r in got:
        assert (r.start, r.n_tokens) == (at, len(r.ids))
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        at += r.n_tokens
    known = {t: by_library(t, path) for t in {r[1] for r in rows}}
    want = sorted(((d is not None, d or 0, known[t]) for d, t in rows))
    assert sorted((r.doc_id is not None, r.doc_id or 0, r.ids) for r in got) == want
    files = token_files.token_files(spark, folder).collect()
    assert len(files) > 10
    index = {(r.part, r.file): r for r in spark.read.parquet(f"{folder}/{token_files.INDEX}").collect()}
    assert len(index) == len(files)
    for file in files:
        data = bytes(file.content)
        place, ids, ends, array = token_files.parse(data)
        first = index[place].start
        assert (index[place].docs, index[place].ids) == (len(ids), len(array))
        one = [r.ids for r in got if first <= r.start < first + len(array)]
        assert [token_files.document(data, i).tolist() for i in range(len(ids))] == one


def test_no_rows(spark, frame):
    folder = token_files.new_token_folder(spark)
    token_files.write_tokens(documents(frame, []), folder, PATH, 2)
    assert token_files.read_tokens(spark, folder).count() == 0


def test_query(spark):
    texts = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    got = {r.doc_id: r for r in op11_token_files(spark, SMALL).collect()}
    assert len(got) == len(texts)
    at = 0
    for doc_id, text in texts:
        ids = np.array(by_library(text), "<u4")
        assert tuple(got[doc_id]) == (doc_id, at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)

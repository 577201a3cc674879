from __future__ import annotations

import json
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from cloakframe.llm import token_files
from cloakframe.llm.common import new_dir
from cloakframe.llm.queries import QUERIES
from cloakframe.sources.tables import load_table

PATH = public_tokenizers.path("word_bpe_49k.json")
TOKENIZER = Tokenizer.from_file(PATH)


def whole(text: str | None) -> np.ndarray:
    return np.array([*TOKENIZER.encode(text or "", add_special_tokens=False).ids, 1], "<u4")


def test_words_encode_like_whole_texts():
    random.seed(3)
    signs = "aBß'İΣς 0\n\t\x0b\x1c\x85\xa0é́̈ ²½한하한.,!?<|>endoftxs're ’😀"
    encoder = token_files.Encoder(open(PATH, encoding="utf-8").read())
    texts = ["".join(random.choices(signs, k=random.randint(0, 60))) for _ in range(400)]
    marks = "aBçÇïĞǅǰŉſİIK.,;:!?'<|>²\u0307\u030c\u0301 ΣςJ"
    texts += ["".join(random.choices(marks, k=random.randint(0, 30))) for _ in range(3000)]
    texts += ["<|ENDOFTEXT|>, <|endoftext|>. x<|startoftext|>y! ... ?! It's, J\u030c. ÀÉ, Straße: ŒUVRE;", "A.B. A.. 'S. 'T,"]
    texts += ["a<|endoftext|>b <|endoftext|> c", "we're 'S 'ſ", " e ́ ", "ΣΑΣ ΣΑΣ.", "x" * 5000]
    for text, data in zip(texts, encoder.encode(texts), strict=True):
        assert np.frombuffer(data, "<u4").tolist() == TOKENIZER.encode(text, add_special_tokens=False).ids, repr(text)


@pytest.mark.parametrize("change", [None, "normalizer", "pre_tokenizer", "added_tokens"])
def test_other_tokenizers_encode_whole_texts(change):
    """Another vocabulary, or this one with a part that words apart would get wrong."""
    definition = json.loads(open(public_tokenizers.path("byte_bpe_50k.json") if change is None else PATH, encoding="utf-8").read())
    if change == "added_tokens":
        definition[change].append({**definition[change][0], "id": 49408, "content": "two words", "normalized": False})
    elif change:
        definition[change] = {"type": "NFC"} if change == "normalizer" else {"type": "Whitespace"}
    text = json.dumps(definition)
    whole, encoder = Tokenizer.from_str(text), token_files.Encoder(text)
    assert not token_files.is_wordwise(text) and token_files.is_wordwise(open(PATH, encoding="utf-8").read())
    texts = ["Hello world, this is a Test.", "", " two words\n\n twice  two words", "É é\u0301 1234 it's <|endoftext|> x"]
    for t, data in zip(texts, encoder.encode(texts), strict=True):
        assert np.frombuffer(data, "<u4").tolist() == whole.encode(t, add_special_tokens=False).ids


def test_forgetting_changes_nothing(monkeypatch):
    monkeypatch.setattr(token_files, "REMEMBERED", 3)
    monkeypatch.setattr(token_files, "REMEMBERED_STEMS", 3)
    encoder = token_files.Encoder(open(PATH, encoding="utf-8").read())
    texts = ["one two three four", "five six", "one two"]
    for _ in range(2):
        got = encoder.encode(texts)
        assert [len(x) for x in got] == [4 * (len(whole(t)) - 1) for t in texts]


def test_query_against_brute_force(spark, data_dir):
    rows = {r.doc_id: r for r in QUERIES["op4_token_files"](spark, data_dir).collect()}
    docs = load_table(spark, data_dir, "documents").orderBy("doc_id").collect()
    assert len(rows) == len(docs)
    start = 0
    for d in docs:
        ids = whole(d.text)
        got = rows[d.doc_id]
        assert (got.start, got.n_tokens, got.ids_crc32) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(
        [(5, "b a", 1), (5, None, 2), (None, "x", 3), (-7, "", 4), (2**62, "y " * 3000, 5), (None, "w", 6), (5, "b a", 7)],
        "doc_id long, text string, start long",
    )


def test_odd_rows(spark, odd):
    manifest = token_files.write_token_files(odd, new_dir(spark, "t"), PATH)
    got = token_files.read_token_files(manifest, with_ids=True).orderBy("start").collect()
    assert [r.doc_id for r in got] == [None, None, -7, 5, 5, 5, 2**62]
    assert [r.n_tokens for r in got] == [len(whole(t)) for t in ("w", "x", "", None, "b a", "b a", "y " * 3000)]
    assert [r.start for r in got] == [0, 2, 4, 5, 6, 9, 12]
    assert got[2].ids == [1]


def test_empty_table(spark, odd):
    manifest = token_files.write_token_files(odd.limit(0), new_dir(spark, "t"), PATH)
    assert token_files.read_token_files(manifest).collect() == []


def test_only_wanted_frames_are_read(spark, odd):
    manifest = token_files.write_token_files(odd.where("doc_id is not null"), new_dir(spark, "t"), PATH).collect()
    found = {}
    for row in manifest:
        found |= token_files.read_documents(row.path, {-7, 2**62, 99})
    assert {k: v.tolist() for k, v in found.items()} == {-7: [1], 2**62: whole("y " * 3000).tolist()}


def test_a_changed_byte_is_noticed(spark, odd):
    row = token_files.write_token_files(odd.where("doc_id > 10"), new_dir(spark, "t"), PATH).first()
    path = row.path.removeprefix("file://")
    data = bytearray(open(path, "rb").read())
    names, nulls, entries = token_files.read_index(token_files.file_system(row.path)[0].open_input_file(path))
    data[int(entries[0][0]) // 2] ^= 1
    open(path, "wb").write(data)
    with pytest.raises(Exception, match="checksum|corrupt|decompress"):
        token_files.read_documents(row.path, {2**62})


def test_frames_are_public_format(spark, odd):
    import zstandard

    row = token_files.write_token_files(odd, new_dir(spark, "t"), PATH).orderBy(F.col("part")).first()
    raw = open(row.path.removeprefix("file://"), "rb")
    plain = zstandard.ZstdDecompressor().stream_reader(raw, read_across_frames=True).read()
    assert len(plain) == 4 * row.units


def test_words_met_again_are_not_learned_again(monkeypatch):
    """When a worker's memory is full, words that come again stay in it."""
    monkeypatch.setattr(token_files, "REMEMBERED", 4)
    monkeypatch.setattr(token_files, "REMEMBERED_STEMS", 4)
    encoder, learned, learn = token_files.Encoder(open(PATH, encoding="utf-8").read()), [], token_files.Encoder._learn
    monkeypatch.setattr(token_files.Encoder, "_learn", lambda self, words: (learned.extend(words), learn(self, words))[1])
    for k in range(30):
        text = f"often, usual x{k} y{k}!"
        data, = encoder.encode([text])
        assert np.frombuffer(data, "<u4").tolist() == TOKENIZER.encode(text, add_special_tokens=False).ids
    assert learned.count(b"often,") == learned.count(b"usual") == 1 and len(encoder.ids) <= 4

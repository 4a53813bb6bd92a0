"""Token output against the tokenizer's own encode of whole texts."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from readloom.llm import token_output

public = pytest.importorskip("public_tokenizers")
PATH = public.path("byte_bpe_50k.json")
ALPHABET = [" ", "  ", "\n", "\t", "a", "B", "é", "漢", "1", ".", "'s", "<|endoftext|>", "\x1c", "\xa0", "\x00", "<|", "fox", "-", "ñ", "\r\n", "", " "]


def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(PATH)


def test_pieces_give_the_ids_of_whole_texts():
    tok, encoder, r = tokenizer(), token_output.Encoder(PATH), random.Random(3)
    for n in (0, 1, 4000):
        texts = ["".join(r.choices(ALPHABET, k=r.randrange(14))) for _ in range(n)] + ([None, ""] if n else [])
        ids, lengths = encoder.encode(pa.array(texts, pa.string()))
        at = np.concatenate([[0], np.cumsum(lengths)])
        assert len(lengths) == len(texts)
        for i, t in enumerate(texts):
            assert ids[at[i] : at[i + 1]].tolist() == tok.encode(t or "", add_special_tokens=False).ids, repr(t)


class Counting:
    """A tokenizer, and how many characters it was given."""

    def __init__(self, inner):
        self.inner, self.given = inner, 0

    def __getattr__(self, name):
        method = getattr(self.inner, name)

        def call(texts, **kw):
            self.given += sum(map(len, texts))
            return method(texts, **kw)

        return call


def test_words_are_encoded_once_whatever_stands_beside_them():
    tok, encoder, r = tokenizer(), token_output.Encoder(PATH), random.Random(5)
    encoder.tokenizer = used = Counting(encoder.tokenizer)
    if hasattr(encoder, "model"):
        encoder.model = other = Counting(encoder.model)
    words = ["".join(r.choices("abcdeéßñ", k=20)) for _ in range(50)]
    text = " ".join(f"{w}{mark}{v}" for w in words for v, mark in zip(r.choices(words, k=20), r.choices([".", ",\n", "&&", "7", "\n", "-"], k=20)))
    assert encoder.encode(pa.array([text]))[0].tolist() == tok.encode(text, add_special_tokens=False).ids
    assert used.given + (other.given if hasattr(encoder, "model") else 0) < 6000 < len(text) / 4


def test_every_latin_character_in_words():
    tok, encoder = tokenizer(), token_output.Encoder(PATH)
    texts = [f"a{chr(c)}b {chr(c)}{chr(c)}1 x.{chr(c)}\n{chr(c)} 9{chr(c)}" for c in range(0x21, 0x260) if not 0x7F <= c < 0xA0] + ["it's 's's\n\nb\n c\n", "1²½ aªº"]
    ids, lengths = encoder.encode(pa.array(texts))
    for t, x in zip(texts, np.split(ids, np.cumsum(lengths)[:-1])):
        assert x.tolist() == tok.encode(t, add_special_tokens=False).ids, repr(t)


def test_pieces_of_one_hash(monkeypatch):
    monkeypatch.setattr(token_output, "_hashes", lambda data, at: np.full(len(at) - 1, 7, np.uint64), raising=False)
    tok, encoder = tokenizer(), token_output.Encoder(PATH)
    for text in ("one two two three", "two one, four", "ten one two tea"):
        assert encoder.encode(pa.array([text]))[0].tolist() == tok.encode(text, add_special_tokens=False).ids


def test_memory_is_bounded(monkeypatch):
    monkeypatch.setattr(token_output, "REMEMBERED", 10)
    tok, encoder = tokenizer(), token_output.Encoder(PATH)
    for k in range(6):
        text = " ".join(f"w{k}{i}" for i in range(30))
        assert encoder.encode(pa.array([text]))[0].tolist() == tok.encode(text, add_special_tokens=False).ids
        assert len(encoder.known) <= 31


def test_other_tokenizers_are_given_whole_texts():
    path = public.path("word_bpe_49k.json")
    encoder = token_output.Encoder(path)
    from tokenizers import Tokenizer

    text = "some  words here\nand There"
    assert encoder.encode(pa.array([text]))[0].tolist() == Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids


def test_files_hold_every_row(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(token_output, "SEGMENT_IDS", 50)
    rows = [(None, "a null id"), (None, "another null id"), (None, "a null id"), (7, "x <|endoftext|> y"), (7, "x <|endoftext|> y"), (7, "same id, other text"), (3, None), (4, ""), (9, "long " * 4000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("part", F.lit("clash")).withColumn("key", F.lit(1)).withColumn("n", F.lit(None).cast("string"))
    path = str(tmp_path / "tokens")
    token_output.write(docs, path, PATH)
    stored = spark.read.parquet(path)
    got = [tuple(r) for r in token_output.read(stored).orderBy("start").select("doc_id", "start", "n_tokens", "ids_crc32").collect()]
    tok, want = tokenizer(), []
    for i, t in rows:
        ids = np.array(tok.encode(t or "", add_special_tokens=False).ids + [2], "<u4")
        want.append((i, len(ids), zlib.crc32(ids.tobytes())))
    assert sorted(((a, n, c) for a, _, n, c in got), key=str) == sorted(want, key=str)
    assert [s for _, s, _, _ in got] == [0, *np.cumsum([n for _, _, n, _ in got])[:-1].tolist()]
    ids = [-1 if a is None else a for a, *_ in got]
    assert ids == sorted(ids) and stored.count() > 1


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    assert token_output.query(spark, str(tmp_path)).count() == 0

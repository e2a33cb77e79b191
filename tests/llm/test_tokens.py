"""Token output against the library, text by text: the query's whole table, special tokens' strings, a cache that overflows."""

import base64
import random
import zlib

import numpy as np
import pytest

from zonepulse.llm import tokens
from zonepulse.llm.queries import QUERIES, vocabulary

NAME = "word_bpe_49k.json"


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(vocabulary(NAME))


def encoder(**options):
    with open(vocabulary(NAME), encoding="utf-8") as file:
        return tokens.Encoder(file.read(), **options)


def test_token_query(spark, sf_dir, library):
    got = {r.doc_id: r for r in QUERIES["op3_token_output"](spark, sf_dir).collect()}
    start = 0
    for d in spark.read.parquet(f"{sf_dir}/documents.parquet").orderBy("doc_id").collect():
        ids = np.array(library.encode(d.text or "", add_special_tokens=False).ids + [tokens.END_ID], "<u4")
        r = got.pop(d.doc_id)
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    assert not got


def test_words_are_those_of_the_library(library, monkeypatch):
    monkeypatch.setattr(tokens, "CACHE", 50)
    rng, coder = random.Random(8), encoder()
    parts = ["a", "Word", "don't", "x1", "é", "é", "日本", "😀", "<|endoftext|>", "<|startoftext|>", "<|EndOfText|>", "<|endof", "!!", "...", "'s",
             " ", "  ", "\t", "\n", "\x0b", "\x1c", " ", " ", "\u0085", "ß", "İ", "ﬁ", "_", "##", "%$"]
    for _ in range(150):
        texts = ["".join(rng.choices(parts, k=rng.randint(0, 9))) for _ in range(10)]
        ids, counts = coder.encode([t.encode() for t in texts])
        expected = [library.encode(t, add_special_tokens=False).ids + [tokens.END_ID] for t in texts]
        assert counts.tolist() == [len(e) for e in expected] and ids.tolist() == [i for e in expected for i in e], texts
    assert len(coder.codes.hashes) < 200 and len(coder.older.hashes) < 200


def test_special_tokens_are_ids_unless_literal():
    assert encoder().encode([b"<|endoftext|> a"])[0].tolist() == [49407, 320, tokens.END_ID]
    assert 49407 not in encoder(literal_special=True).encode([b"<|endoftext|> a"])[0].tolist()


def test_workers_forget_what_other_operators_keep(monkeypatch):
    from zonepulse.llm import bpe, workers

    monkeypatch.setattr(workers, "_KEPT", {})
    monkeypatch.setattr(bpe, "_VOCABULARIES", {})
    content = b"\n".join(base64.b64encode(bytes([i])) + b" %d" % i for i in range(256))
    assert list(workers.tidied(lambda batches: iter([len(bpe.vocabulary(content).lengths)]), owner=bpe.__name__)([])) == [256]
    assert list(workers.tidied(lambda batches: iter([len(bpe._VOCABULARIES)]), owner=bpe.__name__)([])) == [1]     # its own tasks find it
    assert list(workers.tidied(lambda batches: iter([len(bpe._VOCABULARIES)]))([])) == [0]
    assert len(bpe.vocabulary(content).lengths) == 256

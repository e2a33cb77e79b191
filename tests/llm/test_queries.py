"""The registered queries and the pipeline on the smallest tables: against SQL where there is some, else brute force."""

import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline
import oracle
from test_texts import WORD, brute_components, shingles
from zonepulse.llm import bpe
from zonepulse.llm.queries import BPE_RANKS, ORACLES, QUERIES, source_weights, vocabulary


@pytest.fixture(scope="module")
def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet").orderBy("doc_id").collect()


def by_id(df):
    rows = df.collect()
    found = {r.doc_id: r for r in rows}
    assert len(found) == len(rows)
    return found


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, sf_dir, name):
    assert oracle.differences(QUERIES[name](spark, sf_dir), oracle.connect(sf_dir), ORACLES[name]) == ""


def test_fingerprint_query(spark, sf_dir, documents):
    got = by_id(QUERIES["op9_document_fingerprints"](spark, sf_dir))
    off = []
    for d, after in zip(documents, documents[1:] + documents[:1]):
        cut = len(d.text) // 4
        edited = d.text[:len(d.text) - cut] + after.text[:cut]
        r, a, b = got[d.doc_id], shingles(d.text), shingles(edited)
        assert (r.n_chars, r.edited_sha256) == (len(d.text), hashlib.sha256(edited.encode()).hexdigest())
        off.append(abs(r.near_edited - len(a & b) / max(1, len(a | b))))
    assert np.mean(off) < 0.04 and len({got[d.doc_id].fingerprint for d in documents}) <= len({d.text for d in documents})


def test_sharding_query(spark, sf_dir, documents):
    got = by_id(QUERIES["op10_sharding"](spark, sf_dir))
    for d in documents:
        r, data = got[d.doc_id], d.text.encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(data) + 8, zlib.crc32(data), "rows", None)
    counts = Counter(r.shard for r in got.values())
    assert set(counts) == set(range(24)) and max(counts.values()) - min(counts.values()) <= 1


def test_mixing_query(spark, sf_dir, documents):
    got = by_id(QUERIES["op4_source_mixing"](spark, sf_dir))
    sizes, taken = Counter(), Counter()
    for d in documents:
        r = got[d.doc_id]
        assert r.size == len(WORD.findall(d.text)) and r.taken <= 3 * r.size
        sizes[d.source] += r.size
        taken[d.source] += r.taken
    weights = dict(zip(sorted(sizes), source_weights(sorted(sizes))))
    total = sum(sizes.values())
    for d in documents:
        r = got[d.doc_id]
        assert r.source_size == sizes[d.source] and r.target <= 3 * r.source_size + 1e-6
        if r.target < 3 * r.source_size - 1:
            assert r.target >= weights[d.source] / sum(weights.values()) * total - 1e-6
            assert abs(taken[d.source] - r.target) <= 0.1 * r.target
    assert sum({d.source: got[d.doc_id].target for d in documents}.values()) == pytest.approx(total)


def test_pipeline_stages(spark, sf_dir, documents):
    import public_tokenizers
    import tiktoken
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = {r.doc_id: r for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    given = [(d.doc_id, d.text) for d in documents]
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["toxicity", "quality rules", "near copies", "source mix", "byte bpe"]

    clean = stages["toxicity"](spark, docs, sf_dir)
    assert tuple(clean.columns) == corpus_pipeline.COLUMNS
    kept = {r.doc_id for r in clean.collect()}
    known = [i for i, _ in given if i in labels]
    assert sum((i in kept) == (labels[i].toxic == 0) for i in known) >= 0.9 * len(known)

    good = stages["quality rules"](spark, docs, sf_dir).collect()
    kept = {r.doc_id for r in good}
    assert all(i in kept for i in known if labels[i].quality == 1 and len(WORD.findall(dict(given)[i])) >= 60)

    unique = stages["near copies"](spark, docs, sf_dir).collect()
    expected, _ = brute_components(given)
    assert sorted(r.doc_id for r in unique) == sorted(k for k, v in expected.items() if k == v)

    mixed = stages["source mix"](spark, docs, sf_dir).collect()
    per = Counter(r.doc_id for r in mixed)
    assert 0 < len(per) < len(given) and max(per.values()) <= 3
    query = by_id(QUERIES["op4_source_mixing"](spark, sf_dir))
    for source in {d.source for d in documents}:
        words = sum(len(WORD.findall(r.text)) for r in mixed if r.source == source)
        target = next(query[d.doc_id].target for d in documents if d.source == source)
        assert abs(words - target) <= 0.1 * target

    vocab = bpe.vocabulary(bpe.read_ranks(vocabulary(BPE_RANKS)))
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=vocab.ranks, special_tokens={})
    for r in stages["byte bpe"](spark, docs, sf_dir).collect():
        text = dict(given)[r.doc_id]
        ids = np.array(library.encode_ordinary(text), "<u4")
        assert (r.n_tokens, bytes(r.ids)) == (len(ids), ids.tobytes())
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
    assert re.fullmatch("[0-9a-f]{64}", r.ids_sha256)

"""Token alignment: merge pieces against a plain merge, links and counts against the libraries' tokens read one by one."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from test_texts import LONG, ODD
from zonepulse.llm import alignment
from zonepulse.llm.queries import QUERIES, vocabulary

A, B = "byte_bpe_50k.json", "piece_bpe_32k.model"


@pytest.fixture(scope="module")
def libraries():
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer
    a = Tokenizer.from_file(vocabulary(A))
    a.encode_special_tokens = True
    return a, SentencePieceProcessor(model_file=vocabulary(B))


def plain_alignment(text, libraries):
    """(groups of (A ids, B ids)), or nothing."""
    a, b = libraries
    code, table = a.encode(f" {text or ''}", add_special_tokens=False), alignment.byte_of()
    left = [(i, len(bytes(table[c] for c in t))) for i, t in zip(code.ids, code.tokens)]
    pieces = b.encode(text or "")
    data = [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode() for i, p in zip(pieces, b.id_to_piece(pieces))]
    if not text or b"".join(data) != f" {text}".encode():
        return []
    right, groups = list(zip(pieces, map(len, data))), []
    while left:
        (i, x), (j, y) = left.pop(0), right.pop(0)
        group = [i], [j]
        while x != y:
            if x < y:
                i, n = left.pop(0)
                group[0].append(i)
                x += n
            else:
                j, n = right.pop(0)
                group[1].append(j)
                y += n
        groups.append(group)
    assert not right
    return groups


def expected_rows(texts, libraries):
    """Rows of the query for (key, text) pairs."""
    aligned = [(key, plain_alignment(text, libraries)) for key, text in texts]
    counts = Counter((a[-1], b[-1]) for _, groups in aligned for a, b in groups)
    highest = Counter()
    for (_, b), n in counts.items():
        highest[b] = max(highest[b], n)
    out = []
    for key, groups in aligned:
        links = [(a[-1], b[-1]) for a, b in groups]
        digest = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)
        out.append((key, sum(len(a) for a, _ in groups), sum(len(b) for _, b in groups), len(groups), len(links),
                    sum(counts[p] == highest[p[1]] for p in links), sum(counts[p] for p in links),
                    hashlib.sha256(digest.encode()).hexdigest() if groups else ""))
    return sorted(out, key=repr)


@pytest.mark.parametrize("piece", [1, 2, 3, 7, 1000])
def test_pieces_equal_plain_merge(piece):
    rng = random.Random(piece)
    for _ in range(100):
        n = rng.randint(1, 60)
        a, b = (np.array(sorted({*rng.sample(range(1, n + 1), rng.randint(0, n)), n})) for _ in range(2))
        parts = list(alignment.pieces(a, b, piece))
        got = [tuple(map(int, row)) for part in parts for row in zip(*part)]
        ends = sorted({*a.tolist(), *b.tolist()})
        assert got == [(int(np.searchsorted(a, e)), int(np.searchsorted(b, e)), before, e, int(e in a and e in b))
                       for before, e in zip([0, *ends], ends)]
        cuts = [e for e in ends if e in a and e in b]
        assert [x.tolist() for x in alignment.stitched(parts)] == [[v.tolist().index(c) + 1 for c in cuts] for v in (a, b)]
        # Pieces are of equal work: as many ends of both lists, but for one end that stays with its twin.
        i, j = alignment.crossings(a, b, piece)
        assert all(abs(s - piece) <= 1 for s in np.diff(i + j)[:-1])


def test_digits():
    digits = alignment.Digits(50257)
    ids = np.array([0, 9, 10, 99, 100, 12345, 50256])
    assert digits.written(ids, np.frombuffer(b",|;,|;.", np.uint8)) == b"0,9|10;99,100|12345;50256."


TEXTS = ODD + [(10, "<|endoftext|> a <s> b </s>"), (11, "▁ the mark itself"), (12, "日本語テキスト, مرحبا‍!"), (13, "\x00\x07\u0085 \r\n"),
               (14, "   spaces   and\t\ttabs  "), (15, "x" * 5000)]


def test_words_give_the_ids_of_whole_texts(spark, sf_dir):
    """Encoding word by word, with a cache that overflows, gives what encoding whole texts gives."""
    with open(vocabulary(A), encoding="utf-8") as a, open(vocabulary(B), "rb") as b:
        coder = alignment.Encoder(a.read(), b.read())
    assert coder.by_word
    rng = random.Random(9)
    parts = ["a", "The", "ab1", "don't", "1,234", " ", "  ", "\t", "\n", "\u00a0", "\u2003", "\x1c", "\x85", "\u3000", "▁", "é", "e\u0301", "\u0301", "日本",
             "😀", "\u200d", "\ufeff", "\x00", "<s>", "</s>", "<unk>", "<0x41>", "<|endoftext|>", "'s", "'", "’ll", "...", "_", "ß", "ﬁ", "½", "\u1680"]
    texts = ["".join(rng.choice(parts) + rng.choice(["", " "]) for _ in range(rng.randint(1, 12))) for _ in range(4000)]
    texts += [r.text or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    def used(codes):
        return [code if code[2] else None for code in codes]        # ids of texts that can't be aligned don't count

    for at in range(0, len(texts), 500):
        assert used(coder.encode(texts[at:at + 500])) == used(coder.whole(texts[at:at + 500]))


def test_cache_of_words_is_bounded(monkeypatch):
    monkeypatch.setattr(alignment, "CACHE", 40)
    with open(vocabulary(A), encoding="utf-8") as a, open(vocabulary(B), "rb") as b:
        coder = alignment.Encoder(a.read(), b.read())
    rng = random.Random(3)
    for _ in range(60):
        texts = [" ".join(str(rng.randint(0, 60)) for _ in range(12))]
        assert coder.encode(texts) == coder.whole(texts)
        assert len(coder.known) <= 52 and len(coder.older) <= 52


@pytest.mark.parametrize("hot", [alignment.HOT, 5, 0])
def test_link_counts_of_odd_texts(rows, libraries, monkeypatch, hot):
    monkeypatch.setattr(alignment.most_frequent, "__defaults__", (hot,))       # all pairs sent, a few, none
    got = alignment.link_counts(rows(TEXTS), vocabulary(A), vocabulary(B))
    assert sorted(map(tuple, got.collect()), key=repr) == expected_rows(TEXTS, libraries)
    assert alignment.link_counts(rows([]), vocabulary(A), vocabulary(B)).count() == 0


def test_overlaps(rows, libraries):
    got = alignment.align_texts(rows([*TEXTS, (16, LONG)]), vocabulary(A), vocabulary(B)).collect()
    assert len(got) == len(TEXTS) + 1 and got[0]["label"] == "mine"
    for r in got:
        groups = plain_alignment(r.text, libraries)
        assert r.a_ids == [i for a, _ in groups for i in a] and r.b_ids == [i for _, b in groups for i in b]
        assert r.a_groups == np.cumsum([len(a) for a, _ in groups]).tolist()
        assert r.b_groups == np.cumsum([len(b) for _, b in groups]).tolist()
        assert sum(r.overlap_bytes) == (len(r.text.encode()) + 1 if groups else 0)
        steps = list(zip(r.overlap_a, r.overlap_b))
        assert steps == sorted(set(steps)) and (not steps or (steps[0], steps[-1]) == ((0, 0), (len(r.a_ids) - 1, len(r.b_ids) - 1)))


def test_alignment_query(spark, sf_dir, libraries):
    got = QUERIES["op12_token_alignment"](spark, sf_dir)
    texts = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted(map(tuple, got.collect()), key=repr) == expected_rows(texts, libraries)


def test_codes_of_many_words_are_made_together(monkeypatch):
    """Arrays are made for all words at once, not for each; a part that isn't a word stays none after it stood alone."""
    with open(vocabulary(A), encoding="utf-8") as a, open(vocabulary(B), "rb") as b:
        coder = alignment.Encoder(a.read(), b.read())
    words, made, array = [f"w{i}x" for i in range(300)] + ["\x00", "<s>"], [], np.array
    expected = [coder.whole([w])[0] for w in words]
    monkeypatch.setattr(alignment.np, "array", lambda *args, **kw: made.append(1) or array(*args, **kw))
    assert coder.whole(words) == expected and coder.whole([]) == []
    assert len(made) < 20
    for texts in (["", "\n", "a"], ["a  b", "a \n b", "", " a"]):
        assert coder.encode(texts) == [coder.whole([t])[0] for t in texts]

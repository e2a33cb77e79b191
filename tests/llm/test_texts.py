"""Each operator against brute force on small rows: nulls, empty and long texts, ties, repeats, clashing names."""

import hashlib
import random
import re
import sys
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from zonepulse.llm import (bpe, chat, components, fingerprints, jaccard_join, licenses, mixing, quality, sharding, tokens,
                           toxicity)
from zonepulse.llm.queries import BPE_RANKS, vocabulary
from zonepulse.llm.workers import tidied
from zonepulse.session import scratch_dir

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LONG = "alpha beta\tgamma " * 3000 + "omega"
ODD = [(1, None), (2, ""), (3, " \n\t"), (4, "one"), (5, "one two three four five"), (5, "one two three four five"),
       (None, "no key here at all, it says"), (6, LONG), (7, "Ünïcode 😀 „quoted“ don't x")]


def shingles(text, size=5):
    words = WORD.findall(text or "")
    return ({tuple(words[i:i + size]) for i in range(len(words) - size + 1)} if len(words) >= size
            else {tuple(words)} if words else set())


def ascii_lower(text):
    return (text or "").encode().lower().decode()


def test_license_scan(rows):
    mit, long_one = licenses.TEMPLATES[0][1], licenses.TEMPLATES[5][1]
    texts = ODD + [(10, f"bla bla\n{mit}\nmore"), (11, mit.upper()), (12, "Released under no License."),
                   (13, "x " * 500 + long_one + " y" * 500), (14, " ".join(long_one.split()[:30]))]
    got = {(r.doc_id, r.license): r.containment for r in licenses.scan(rows(texts)).collect()}
    assert got == {(10, "MIT"): 1.0, (11, "MIT"): 1.0, (13, "MIT-text"): 1.0}
    assert licenses.scan(rows(texts), templates=[("short", "two words")]).count() == 0
    assert licenses.scan(rows([])).count() == 0


def test_license_scan_counts_every_part(rows):
    texts = {t[0]: t[1] for t in licenses.TEMPLATES}
    mit = texts["MIT-text"].replace("sell copies", "vend copies").replace("permit persons", "allow persons").replace(
        "is furnished", "was furnished")
    gpl = texts["GPL-header"].replace("version 3", "version 2").replace("any later", "any newer")
    few = texts["MIT-text"].replace("merge, publish", "a b c").replace("sublicense", "d").replace("permit persons", "e f").replace(
        "is furnished", "g").replace("associated documentation", "h")
    data = [(1, mit), (2, "z " * 77 + gpl), (3, few)]
    got = {(r.doc_id, r.license): (r.containment, r.window_start) for r in licenses.scan(rows(data)).collect()}
    assert got == {(1, "MIT-text"): (pytest.approx(56 / 65), 0), (2, "GPL-header"): (pytest.approx(35 / 40), 64)}


def test_quality_counts_equal_brute_force(rows):
    rng = random.Random(5)
    data = ODD + [(20 + i, "\n".join(" ".join(rng.choice("a b c #d |e| f").split() and rng.choices(
        ["a", "b", "c", "#d", "|e|", "the"], k=rng.randint(0, 9))) for _ in range(rng.randint(1, 8)))) for i in range(60)]
    got = quality.judge(rows(data).withColumn("lang", F.when(F.col("doc_id") % 2 == 0, "en"))).collect()
    assert len(got) == len(data)
    by_id = {r.doc_id: r for r in got}
    for key, text in data:
        words, r = WORD.findall(text or ""), by_id[key]
        windows = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
        often = Counter(windows)
        covered = {j for i, w in enumerate(windows) if often[w] > 1 for j in range(i, i + 5)}
        lines = [x for x in (text or "").split("\n") if WORD.search(x)]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (
            len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)),
            len(covered)), text
        assert r.base_failed == (len(words) < 10 or 100 * len(covered) > 20 * len(words))
        assert not (r.kept and r.base_failed)
    assert quality.judge(rows([]).withColumn("lang", F.lit("en"))).count() == 0


def test_quality_divergence_equals_formula(spark):
    p, q = [0.5, 0.5, 0.0], [0.1, 0.4, 0.5]
    got = spark.range(1).select(quality.divergence(F.array(*map(F.lit, p)), F.array(*map(F.lit, q)))).first()[0]
    m = (np.array(p) + q) / 2
    kl = lambda a: sum(x * np.log2(x / y) for x, y in zip(a, m) if x)
    assert got == pytest.approx(np.sqrt((kl(p) + kl(q)) / 2))


def quality_by_hand(data, limits):
    """doc_id -> (char_distance, word_distance, kept) of (doc_id, text, lang) rows of ASCII texts."""
    def shares(counts):
        return np.array(counts) / sum(counts) if sum(counts) else None

    def distance(p, q):
        m = (p + q) / 2
        kl = lambda a: sum(x * np.log2(x / y) for x, y in zip(a, m) if x)
        return np.sqrt(max(0.0, (kl(p) + kl(q)) / 2))

    docs = []
    for key, text, lang in data:
        text, words = text or "", WORD.findall(text or "")
        often = Counter(tuple(words[i:i + 5]) for i in range(len(words) - 4))
        covered = {j for i in range(len(words) - 4) if often[tuple(words[i:i + 5])] > 1 for j in range(i, i + 5)}
        classes = [len(re.findall(c, text)) for c in (
            "[a-z]", "[A-Z]", "[0-9]", r"[\x20\x09-\x0D]", r"[.,;:'\"()-]", "[!?]", r"[#*$%&|<>]")]
        classes.append(len(text) - sum(classes))
        common = limits.common_words.get(lang or "")
        if common is not None:
            signs = sum(len(w) <= 3 and not re.search("[A-Za-z0-9]", w) for w in words)
            common = [words.count(w) for w in common] + [signs]
            common.append(len(words) - sum(common))
        bad = len(words) < limits.min_words or 100 * len(covered) > limits.max_repeat_percent * len(words)
        docs.append((key, lang or "", len(words), bad, shares(classes), common and shares(common)))
    good = [d for d in docs if not d[3] and d[2] >= limits.judged_words]
    enough = lambda ds: len(ds) >= limits.reference_docs
    result = {}
    for key, lang, n, bad, chars, common in docs:
        own = [d for d in good if d[1] == lang]
        ref, c, w = own if enough(own) else good, None, None
        if n >= limits.judged_words and enough(ref):
            c = distance(chars, np.mean([d[4] for d in ref], axis=0))
            if enough(own) and common is not None:
                w = distance(common, np.mean([d[5] for d in own], axis=0))
        odd = (c is not None and c > limits.char_limit + limits.char_slack / np.sqrt(n)
               or w is not None and w > limits.word_limit + limits.word_slack / np.sqrt(n))
        result[key] = c, w, not bad and not odd
    return result


def test_quality_verdict_equals_brute_force(rows):
    """A language with references, one without a word list, one with too few documents, none at all; odd documents in each."""
    rng = random.Random(8)
    usual = ["the", "of", "and", "Cat", "house", "river,", "stone.", "seven", "light", "7", "-", "walks", "over", "under"]
    limits = quality.Limits(reference_docs=12)
    data = []
    for i in range(90):
        lang = ("en", "xx", "fi", None)[0 if i < 40 else 1 if i < 75 else 2 if i < 82 else 3]
        n = rng.choice([5, 15, 60, 200])
        words = [str(rng.randint(0, 10 ** 6)) if i % 9 == 0 else "!?!?" if i % 13 == 0 else rng.choice(usual) for _ in range(n)]
        data.append((i, "\n".join(" ".join(words[j:j + 8]) for j in range(0, n, 8)), lang))
    want = quality_by_hand(data, limits)
    got = {r.doc_id: r for r in quality.judge(rows(data, "doc_id long, text string, lang string"), limits).collect()}
    assert {k: v[2] for k, v in want.items()} == {k: r.kept for k, r in got.items()}
    for key, (chars, words, _) in want.items():
        assert got[key].char_distance == (None if chars is None else pytest.approx(chars)), key
        assert got[key].word_distance == (None if words is None else pytest.approx(words)), key
    few = [key for key, _, lang in data if lang == "fi"]
    assert any(want[k][0] is not None for k in few) and {want[k][2] for k in few} == {True, False}
    alone = quality.judge(rows(data[75:82], "doc_id long, text string, lang string"), limits).collect()
    assert all(r.char_distance is None for r in alone)          # too few good documents in all


def test_fingerprints_exact_below_k_and_mergeable(rows):
    data = [r for r in ODD if r[0] != 5] + [(5, "one two three four five")]
    got = fingerprints.with_next(rows(data))
    got = fingerprints.sketch(got, "text", "own").select(
        "doc_id", "text", "next_start", F.size("own").alias("size"),
        fingerprints.resemblance(F.col("own"), F.col("next_sketch")).alias("near")).collect()
    ordered = sorted(data, key=lambda r: (r[0] is not None, r[0] or 0))
    assert len(got) == len(data)
    by_id = {r.doc_id: r for r in got}
    for (key, text), (_, after) in zip(ordered, ordered[1:] + ordered[:1]):
        r, text, after = by_id[key], text or "", after or ""
        a, b = shingles(text), shingles(after)
        assert (r.text, r.next_start, r.size) == (text, after[:len(text) // 4], min(len(a), 128))
        assert r.near == pytest.approx(len(a & b) / len(a | b) if a | b else 1.0)
    parts = fingerprints.sketch(rows([(1, "a b c d e f g"), (1, "x y z u v"), (2, None)]), "text", "sketch")
    merged = {r.doc_id: r.sketch for r in fingerprints.merge_groups(parts, "doc_id").collect()}
    both = fingerprints.sketch(rows([(1, "a b c d e f g"), (2, "x y z u v")]), "text", "sketch")
    assert sorted(h for r in both.collect() for h in r.sketch) == merged[1]
    assert fingerprints.with_next(rows([])).count() == 0


def test_sharding_permutes(spark, rows):
    for n in (1, 2, 7, 100):
        df = spark.range(n).select("id", sharding.permuted(F.col("id"), n).alias("p"))
        back = df.select("id", sharding.permuted(F.col("p"), n, forward=False).alias("b"), "p").collect()
        assert sorted(r.p for r in back) == list(range(n)) and all(r.b == r.id for r in back)
    got = sharding.shard_rows(rows(ODD), 4, "doc_id", "text").collect()
    assert sorted(Counter(r.shard for r in got).values()) == [2, 2, 2, 3]
    for shard in range(4):
        slots = sorted(r.slot for r in got if r.shard == shard)
        assert slots == list(range(len(slots)))
    again = sharding.shard_rows(rows(ODD[::-1]), 4, "doc_id", "text").collect()
    key = lambda r: (str(r.doc_id), r.text or "", r.shard, r.slot)
    assert sorted(map(key, got)) == sorted(map(key, again))
    assert sharding.shard_rows(rows([]), 4, "doc_id", "text").count() == 0


def test_bpe_equals_the_library(rows):
    import public_tokenizers
    import tiktoken
    path = vocabulary(BPE_RANKS)
    vocab = bpe.vocabulary(bpe.read_ranks(path))
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=vocab.ranks, special_tokens={})
    rng = random.Random(3)
    alphabet = [*"aabst'rvelmd  \n\t1é９中!?. 　\x85\x1f😀", "'ll", "'re", " 's", "\r\n"]
    for _ in range(400):
        texts = ["".join(rng.choices(alphabet, k=rng.randint(0, 30))) for _ in range(4)]
        assert [x.tolist() for x in bpe.encode_texts([t.encode() for t in texts], vocab)] == [
            library.encode_ordinary(t) for t in texts]
    for text in ("ab" * 2000, " " * 500, "'s" * 100):
        assert bpe.encode_texts([text.encode()], vocab)[0].tolist() == library.encode_ordinary(text)
    every = [c for c in range(sys.maxunicode + 1) if c not in bpe.SURROGATES]
    for at in range(0, len(every), 1 << 15):
        text = "".join(f"a{chr(c)}7{chr(c)} {chr(c)}." for c in every[at:at + (1 << 15)])
        assert bpe.encode_texts([text.encode()], vocab)[0].tolist() == library.encode_ordinary(text), hex(at)
    coded = bpe.encode(rows(ODD), path)
    for r in bpe.decode(coded.withColumn("keep", F.col("ids")), path).collect():
        text = next(t or "" for k, t in ODD if k == r.doc_id)
        assert bytes(r.decoded).decode() == text and r.keep == library.encode_ordinary(text)
    assert bpe.encode(rows([]), path).count() == 0


def test_token_files_read_back(spark, rows):
    from tokenizers import Tokenizer
    path = scratch_dir(spark, "test-tokens")
    tokens.write_tokens(rows(ODD), path, vocabulary("word_bpe_49k.json"))
    library = Tokenizer.from_file(vocabulary("word_bpe_49k.json"))
    got = tokens.with_crc32(tokens.read_tokens(spark, path, "doc_id", "n_tokens", "ids")).orderBy("start").collect()
    assert [r.doc_id for r in got] == [None, 1, 2, 3, 4, 5, 5, 6, 7]
    at = 0
    for r in got:
        text = next(t or "" for k, t in ODD if k == r.doc_id)
        ids = np.array(library.encode(text, add_special_tokens=False).ids + [tokens.END_ID], "<u4")
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)
    scan = tokens.read_tokens(spark, path, "doc_id", "n_tokens")._jdf.queryExecution().toString()
    assert "ids" not in scan.split("ReadSchema")[1].split("\n")[0]
    empty = scratch_dir(spark, "test-empty")
    tokens.write_tokens(rows([]), empty, vocabulary("word_bpe_49k.json"))
    assert tokens.read_tokens(spark, empty).count() == 0


def test_chat_round_trip(rows):
    rng = random.Random(9)
    pieces = ["\\", "### Assistant: ", "</turn>", "\n", "### a: ", "### ", " ", "x", "é", ":", "</", "turn>"]
    for _ in range(3000):
        turns = [(rng.choice(["user", "assistant", "", "a b:%", "%", "r" * 65, "%" * 17, "system </turn> ### a: \n" * 5]), "".join(rng.choices(pieces, k=rng.randint(0, 7))))
                 for _ in range(3)]
        formatted = [chat.format_turn(*t)[0] for t in turns]
        assert [t[:2] for t in chat.parse("".join(formatted))] == turns
    assert chat.format_turn("user", "plain text")[0] == "### user: plain text\n</turn>\n"
    with pytest.raises(chat.FormatError):
        chat.parse("### user: never ends")
    assert chat.format_turn("r" * 64, "x")[0] == f"### {'r' * 64}: x\n</turn>\n"
    for broken in ("### %: role", "### %: role\n", "### %: role\nx</turn>"):
        with pytest.raises(chat.FormatError):
            chat.parse(broken)
    slashes = "\\" * 300_000                  # one pass over them
    assert chat.parse(chat.format_turn("user", slashes)[0])[0][1] == slashes
    long = [(2, 0, "x" * 65, "a"), (2, 1, "assistant" * 9, "not trained on"), (2, 2, "assistant", "b")]
    got = chat.digests(chat.format_turns(rows(long, "conv_id long, turn long, role string, text string"))).first()
    assert got.turns_sha256 == hashlib.sha256("".join(f"{r}\n{t}\n" for _, _, r, t in long).encode()).hexdigest()
    assert got.loss_sha256 == hashlib.sha256(b"b").hexdigest()
    data = [(1, 1, "assistant", "b </turn>"), (1, 0, "user", None), (1, 1, "assistant", "b </turn>"), (None, 0, None, "x")]
    got = chat.digests(chat.format_turns(rows(data, "conv_id long, turn long, role string, text string"))).collect()
    by_id = {r.conv_id: r for r in got}
    assert by_id[1].n_turns == 3 and by_id[1].loss_sha256 == hashlib.sha256(b"b </turn>b </turn>").hexdigest()
    assert by_id[1].turns_sha256 == hashlib.sha256(b"user\n\n" + b"assistant\nb </turn>\n" * 2).hexdigest()
    assert by_id[None].turns_sha256 == hashlib.sha256(b"\nx\n").hexdigest() and by_id[None].loss_chars == 0
    assert chat.digests(chat.format_turns(rows([], "conv_id long, turn long, role string, text string"))).count() == 0


def brute_components(data, percent=80):
    sets = [(k, shingles(ascii_lower(t))) for k, t in data]
    label = {k: k for k, _ in sets}
    for _ in sets:
        for i, s in sets:
            for j, t in sets:
                if i is not None and j is not None and s and t and 100 * len(s & t) >= percent * len(s | t):
                    label[i] = label[j] = min(label[i], label[j])
    return {k: label[k] for k, _ in sets}, {(k, len(s)) for k, s in sets}


def test_jaccard_join_equals_brute_force(rows):
    rng = random.Random(4)
    vocabulary_ = [f"w{i}" for i in range(400)]
    data = list(ODD)
    for group in range(6):
        base = rng.choices(vocabulary_, k=rng.choice([6, 12, 40, 150]))
        for copy in range(9):
            text = list(base)
            for _ in range(rng.randint(0, max(1, len(base) // 12))):
                text[rng.randrange(len(text))] = rng.choice(vocabulary_)
            data.append((100 + 10 * group + copy, " ".join(text).upper() if copy == 3 else " ".join(text)))
    got = jaccard_join.link_components(rows(data)).collect()
    expected, sizes = brute_components(data)
    assert len(got) == len(data)
    assert {r.doc_id: r.component_id for r in got} == expected
    assert {(r.doc_id, r.n_shingles) for r in got} == sizes
    kept = jaccard_join.keep_representatives(rows(data)).collect()
    assert Counter(r.doc_id for r in kept) == Counter({k for k, v in expected.items() if k == v})
    assert jaccard_join.link_components(rows([])).count() == 0


def test_sketch_keys_lose_no_pair():
    rng = np.random.default_rng(8)
    for n in (1, 2, 3, 5, 9, 17, 60, 130, 255, 256, 500):
        for _ in range(30):
            a = np.unique(rng.integers(0, 1 << 63, n, np.uint64))
            for gone, new in ((0, n // 4), (n // 5, 0), (n // 9, n // 9)):
                b = np.unique(np.concatenate([a[gone:], rng.integers(0, 1 << 63, new, np.uint64)]))
                both = len(np.intersect1d(a, b))
                if len(b) and 100 * both >= 80 * (len(a) + len(b) - both):
                    common = np.sort(a[::2])
                    for c in (None, common):
                        assert len(np.intersect1d(jaccard_join.sketch_keys(a, common=c), jaccard_join.sketch_keys(b, common=c)))
                    assert jaccard_join.apart_at_least(
                        jaccard_join.parity_bits(a), jaccard_join.parity_bits(b)) <= len(a) + len(b) - 2 * both


def test_block_comparison_finds_all_pairs_within_the_bounds(monkeypatch):
    monkeypatch.setattr(jaccard_join, "NEAR_BLOCK", 50, raising=False)
    rng = np.random.default_rng(5)
    for words in (1, 4, 1030):
        count = 40 if words > 1000 else 260
        bits = rng.integers(0, 2 ** 63, (count, words)).astype(np.uint64)
        bits[1::2] = bits[::2]
        for r in range(0, count, 3):
            bits[r, rng.integers(words)] ^= np.uint64(1 << int(rng.integers(40)))
        n, label, minor = np.sort(rng.integers(1, 40, count) * words), rng.integers(0, 9, count), rng.random(count) < 0.5
        rows = np.arange(count)
        found = [(int(a), int(b)) for x, y in jaccard_join._near(rows[minor], bits[minor], rows[~minor], bits[~minor], label, n, 80)
                 for a, b in zip(x, y)]
        apart = np.bitwise_count(bits[:, None] ^ bits[None]).sum(axis=2, dtype=np.int64)
        expected = [(a, b) for a in rows[minor].tolist() for b in rows[~minor].tolist() if label[a] != label[b]
                    and 180 * apart[a, b] <= 20 * (n[a] + n[b]) and 100 * min(n[a], n[b]) >= 80 * max(n[a], n[b])]
        assert sorted(found) == expected and expected


def test_small_blocks_are_compared_together(spark):
    draw = np.random.default_rng(5)
    base = [np.unique(draw.integers(0, 1 << 62, 60 + 30 * (i % 4), dtype=np.uint64)) for i in range(40)]
    sets = [np.unique(np.append(draw.choice(base[i % 40], int(len(base[i % 40]) * .93), replace=False),
                                draw.integers(0, 1 << 62, 3, dtype=np.uint64))) for i in range(400)]
    bits, n, label = [jaccard_join.parity_bits(s) for s in sets], [len(s) for s in sets], [i // 2 for i in range(400)]
    # Many buckets of a few documents and one of 120.
    keys = [(k, d) for k in range(90) for d in draw.choice(400, int(draw.integers(2, 9)), replace=False).tolist()] + [(900, d) for d in range(120)]
    expected = set()
    for key in {k for k, _ in keys}:
        docs = [d for k, d in keys if k == key]
        for x in (d for d in docs if label[d] != min(label[e] for e in docs)):
            expected |= {(x, y) for y in docs if label[x] != label[y] and 10 * min(n[x], n[y]) >= 8 * max(n[x], n[y])
                         and 9 * jaccard_join.apart_at_least(bits[x], bits[y]) <= n[x] + n[y]}
    frame = spark.createDataFrame([(k, d, label[d]) for k, d in keys], "key long, doc long, label long")
    known = spark.createDataFrame([(d, n[d], bits[d]) for d in range(400)], "doc long, n long, bits binary")
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(setting)
    try:
        for batch in (7, 10_000):
            spark.conf.set(setting, batch)
            assert {(r.x, r.y) for r in jaccard_join.near_in_buckets(frame, known, 80).collect()} == expected
    finally:
        spark.conf.set(setting, before)
    assert len(expected) > 20
    # Without a call for each block.
    rows = [(d, of) for of in range(60) for d in (of, of + 40, of + 41)]
    table = pa.table({"minor": [d != of for d, of in rows] + [False] * 120, "doc": [d for d, _ in rows] + [of + k for of in range(60) for k in (40, 41)],
                      "label": [label[d] for d, _ in rows] + [label[of + k] for of in range(60) for k in (40, 41)],
                      "n": [n[d] for d, _ in rows] + [n[of + k] for of in range(60) for k in (40, 41)],
                      "bits": [bits[d] for d, _ in rows] + [bits[of + k] for of in range(60) for k in (40, 41)]})
    of = np.array([of for _, of in rows] + [of for of in range(60) for _ in range(2)])
    order = np.argsort(of, kind="stable")
    found = {(int(a), int(b)) for x, y in jaccard_join._near_in_small(table.take(pa.array(order)), of[order], 80) for a, b in zip(x, y)}
    near = {(x, y) for of in range(60) for x in (of + 40, of + 41) for y in (of, of + 40, of + 41) if label[x] != label[y]
            and 10 * min(n[x], n[y]) >= 8 * max(n[x], n[y]) and 9 * jaccard_join.apart_at_least(bits[x], bits[y]) <= n[x] + n[y]}
    assert found == near and near


def test_workers_keep_no_freed_memory():
    given = []
    assert list(tidied(iter, lambda: given.append(True))([1, 2])) == [1, 2] and given == [True]


def test_decoding_alone_builds_no_merges():
    vocab = bpe.Vocabulary({b"a": 0, b"b": 1, b"ab": 2})
    assert vocab.decode(np.array([2, 0]), np.array([0, 2])) == b"aba" and "pairs" not in vars(vocab)
    assert bpe.encode_texts([b"aba"], vocab)[0].tolist() == [2, 0] and "pairs" in vars(vocab)


def test_components(spark):
    chain = [(i, i + 1) for i in range(1, 20)] + [(30, 40), (40, 30), (50, 50)]
    got = {r.node: r.component for r in components.components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {**{i: 1 for i in range(1, 21)}, 30: 30, 40: 30}


def test_components_end_at_stars(spark, monkeypatch):
    stored, materialize = [], components.materialize
    monkeypatch.setattr(components, "materialize", lambda df, name: stored.append(name) or materialize(df, name))
    links = [(1, i) for i in range(2, 9)] * 2 + [(20, 21), (22, 20)]
    got = {r.node: r.component for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 1 for i in range(1, 9)}, 20: 20, 21: 20, 22: 20}
    assert stored.count("stars") == 1
    # Known components stand for their links.
    first = jaccard_join._labels(spark.createDataFrame([(1, 2), (3, 4)], "a long, b long"))
    assert jaccard_join._labels(spark.createDataFrame([], "a long, b long"), first) is first
    more = jaccard_join._labels(spark.createDataFrame([(2, 4), (5, 6)], "a long, b long"), first)
    assert {r.node: r.component for r in more.collect()} == {1: 1, 2: 1, 3: 1, 4: 1, 5: 5, 6: 5}


def test_mixing_targets_flow_and_selection(rows):
    assert mixing.capped_targets({"a": 100, "b": 10, "c": 50}, {"a": 5, "b": 2, "c": 1}, 160) == pytest.approx(
        {"a": 650 / 6, "b": 30, "c": 130 / 6})
    flow = mixing.route({("a",): 100.0, ("a", "b"): 50.0, ("b",): 5.0}, {"a": 60.0, "b": 95.0})
    assert sum(v for (_, s), v in flow.items() if s == "a") == pytest.approx(60)
    assert sum(v for (_, s), v in flow.items() if s == "b") == pytest.approx(95)
    assert flow[("a",), "a"] == pytest.approx(60)       # b needs all that both could give
    rng = random.Random(1)
    data = [(i, rng.choice(["x", "y", "z", None]), rng.randint(0, 30)) for i in range(400)] + [(7, "x", 5), (None, "y", None)]
    frame = rows(data, "doc_id long, source string, size long")
    mixed, targets, sizes = mixing.mix(frame, F.array("source"), "size", lambda names: [5.0, 2.0, 1.0, 5.0])
    got = mixed.collect()
    assert len(got) == len(data) and max(r.repeats for r in got) <= 3
    for source in ("x", "y", "z", None):
        taken = sum(r.repeats * r.size for r in got if r.source == source)
        assert abs(taken - targets[source]) <= 5, source
    again = mixing.mix(frame.repartition(3), F.array("source"), "size", lambda names: [5.0, 2.0, 1.0, 5.0])[0].collect()
    key = lambda r: (str(r.doc_id), str(r.source), r.size, r.repeats)
    assert sorted(map(key, got)) == sorted(map(key, again))
    assert mixing.mix(rows([], "doc_id long, source string, size long"), F.array("source"), "size", lambda n: [])[0].count() == 0


def test_toxicity_held_out(spark, sf_dir):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    model = toxicity.fit(docs, labels.where(~toxicity.held_out(F.col("doc_id"))))
    held = toxicity.score(docs, model).join(labels, "doc_id").where(toxicity.held_out(F.col("doc_id"))).collect()
    right = sum((r.score >= 0.5) == (r.toxic == 1) for r in held)
    assert len(held) > 50 and right / len(held) >= 0.95
    odd = toxicity.score(spark.createDataFrame(ODD, "doc_id long, text string"), model).collect()
    assert len(odd) == len(ODD) and all(0 <= r.score < 0.5 for r in odd if not (r.text or "").strip())
    none = toxicity.fit(docs, labels.where("toxic = 0"))
    assert none.score("idiot") < 0.01


def test_toxicity_counts_all_labelled_rows(spark, monkeypatch):
    data = [(i, f"quiet river w{i % 7} {'vexgrub' if i % 2 else 'meadow'} garden", i % 2) for i in range(80)]
    data += [(1000 + i, f"quiet river w{i % 7} {'zorblat' if i % 2 else 'lantern'} garden", i % 2) for i in range(80)]
    frame = spark.createDataFrame(data, "doc_id long, text string, toxic int")
    keys = [r.doc_id for r in toxicity.labelled(frame, "doc_id", "toxic").orderBy("_order").collect()]
    first = {c: [k for k in keys if k % 2 == c][:20] for c in (0, 1)}       # these rows never hold the second word
    swap = frame.select("doc_id", F.when(F.col("doc_id").isin(*first[1]), F.regexp_replace("text", "zorblat", "vexgrub"))
                        .otherwise(F.col("text")).alias("text"), "toxic")
    model = toxicity.fit(swap.select("doc_id", "text"), swap.select("doc_id", "toxic"), rows=20)
    texts = spark.createDataFrame([(1, "quiet zorblat garden"), (2, "quiet lantern garden"), (3, "quiet zorblat garden")],
                                  "id long, text string")
    got = {r.id: r.score for r in toxicity.score(texts, model).collect()}
    assert got[1] > 0.5 > got[2]
    monkeypatch.setattr(toxicity, "COMMON", 1)          # all but one word are joined
    again = {r.id: r.score for r in toxicity.score(texts, model).collect()}
    assert again == pytest.approx(got) and again[1] == again[3]

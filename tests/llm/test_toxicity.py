"""Spelling models against Kneser-Ney counts in plain dictionaries."""

import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from zonepulse.llm import toxicity
from zonepulse.llm.toxicity import BOTH, COUNTS, KINDS, MODELS


def kind(char):
    return 0 if char == "^" else int(toxicity.kind_of(np.array([ord(char)]))[0])


def plain_ratios(words, asked):
    """Log ratios of (model, word), by the definition: ``words`` maps a word to its four counts."""
    nodes = {}
    for word, counts in words.items():
        for i in range(1, len(word) + 2):
            node = (word + "$")[:i]
            nodes[node] = [a + b for a, b in zip(nodes.get(node, [0] * 4), counts)]

    def n(node, model, klass):
        counts = nodes.get(node) if node else [sum(c) for c in zip(*words.values())]
        return sum(counts[i] for i in MODELS[model] if i % 2 == klass) if counts else 0

    def children(node):
        return [m for m in nodes if len(m) == len(node) + 1 and m.startswith(node)]

    taken = []
    for klass in (0, 1):
        of = Counter(n(node, BOTH, klass) for node in nodes if len(node) >= 2)
        taken.append(toxicity.discounts(np.array([of[i] for i in (1, 2, 3, 4)], float)))
    three = Counter(tuple(map(kind, ("^^" + node)[-3:])) for node in nodes)
    two = Counter(k[1:] for k in three)
    one = Counter(k[1:] for k in two)

    def back(a, b, c):
        lowest = (one[c,] + 1) / (sum(one.values()) + KINDS)
        after = sum(v for k, v in two.items() if k[0] == b)
        seen = sum(k[0] == b for k in two)
        lower = (max(two[b, c] - .75, 0) + .75 * seen * lowest) / after if after else lowest
        after = sum(v for k, v in three.items() if k[:2] == (a, b))
        seen = sum(k[:2] == (a, b) for k in three)
        return (max(three[a, b, c] - .75, 0) + .75 * seen * lower) / after if after else lower

    def take(klass, count):
        return taken[klass][min(count, 3)]

    out = {}
    for model, word in asked:
        total = 0.0
        for i in range(len(word) + 1):
            context, node = word[:i], (word + "$")[:i + 1]
            if context and context not in nodes:
                break
            chance = []
            for klass in (0, 1):
                whole = n(context, model, klass)
                left = sum(take(klass, n(c, model, klass)) for c in children(context)) / whole if whole else 1.0
                own = (n(node, model, klass) - take(klass, n(node, model, klass))) / whole if whole else 0.0
                chance.append((max(own, 0) + left * back(*map(kind, ("^^" + node)[-3:])), left))
            if node in nodes:
                total += math.log(chance[1][0] / chance[0][0])
            else:
                total += math.log(chance[1][1] / chance[0][1])
                break
        out[model, word] = total
    return out


def test_word_ratios_equal_plain_counts(spark):
    rng = random.Random(6)
    letters = "abé漢1_"
    words = {"".join(rng.choices(letters, k=rng.randint(1, 7))): [rng.choice((0, 0, 1, 2, 5)) for _ in range(4)] for _ in range(120)}
    words = {w: c for w, c in words.items() if any(c)} | {"gardenerbadword": [0, 3, 0, 4], "gardenergoodone": [4, 0, 3, 0], "z": [1, 0, 0, 0]}
    asked = sorted({(m, w) for w in [*words, "gardenerbad", "gardener", "q", "qab", "zz", "a" * 40, "漢q", "gardenerbadwords"]
                    for m in (0, 1, BOTH)} | {(BOTH, "".join(rng.choices(letters + "q", k=rng.randint(1, 9)))) for _ in range(150)})
    frame = spark.createDataFrame([(w, *c) for w, c in words.items()], "word string, " + ", ".join(f"{c} long" for c in COUNTS))
    rows = spark.createDataFrame([(m, w, 1) for m, w in asked], "model long, word string, n long")
    spelling = toxicity.learn(frame)
    got = {(r.model, r.word): r.ratio for r in toxicity.word_ratios(rows, spelling).collect()}
    expected = plain_ratios(words, asked)
    assert got.keys() == expected.keys()
    for key, value in expected.items():
        assert got[key] == pytest.approx(value, abs=1e-9), key
    whole = [w for m, w in asked if m == BOTH]
    sizes = []
    for most in (toxicity.NODES, 250, 0):       # beginnings that every task gets: all, some, first characters alone
        found = toxicity.shallow(spelling, most).ratios(whole)
        sizes.append(len(found))
        for word, value in found.items():
            assert value == pytest.approx(expected[BOTH, word], abs=1e-9), (most, word)
    assert sizes[0] == len(set(whole)) > sizes[1] > sizes[2] > 0


def test_fewer_beginnings_score_alike(spark, monkeypatch):
    """Words that are walked as rows and those that aren't add up to the same scores."""
    rng = random.Random(3)
    parts = ["ba", "vex", "grub", "mea", "dow", "ri", "ver"]
    data = [(i, " ".join("".join(rng.choices(parts, k=rng.randint(1, 3))) for _ in range(12)) + (" vexgrub" if i % 2 else ""), i % 2) for i in range(80)]
    frame = spark.createDataFrame(data + data[:3], "doc_id long, text string, toxic int")
    model = toxicity.fit(frame.select("doc_id", "text"), frame.select("doc_id", "toxic"))
    new = spark.createDataFrame([(i, " ".join("".join(rng.choices(parts + ["q"], k=3)) for _ in range(9))) for i in range(40)] * 2, "doc_id long, text string")
    whole = {(r.doc_id, r.score) for r in toxicity.score(new, model).collect()}
    monkeypatch.setattr(toxicity, "COMMON", 5)
    monkeypatch.setattr(toxicity.shallow, "__defaults__", (30,))
    part = toxicity.score(new, model, keep_text=False)
    assert part.columns == ["doc_id", "score"] and part.count() == 80
    assert dict(whole) == pytest.approx({r.doc_id: r.score for r in part.collect()}) and len(whole) == 40


def test_words_are_read_to_their_end(spark):
    """Two words that differ behind their eighth character alone score apart."""
    rng = random.Random(1)
    plain = ["river", "meadow", "lantern", "garden", "window", "autumn"]
    data = [(i, " ".join(rng.choices(plain, k=8) + ["gardenerbadword" if i % 3 == 0 else "gardenergoodone"]), int(i % 3 == 0)) for i in range(120)]
    frame = spark.createDataFrame(data, "doc_id long, text string, toxic int")
    model = toxicity.fit(frame.select("doc_id", "text"), frame.select("doc_id", "toxic"))
    bad, good = model.score("river gardenerbadword meadow"), model.score("river gardenergoodone meadow")
    assert bad > 0.5 > good


def test_odd_texts_and_clashing_columns(spark, rows):
    data = [(i, f"quiet river w{i % 7} {'vexgrub' if i % 2 else 'meadow'} garden") for i in range(60)]
    odd = [(100, None), (101, ""), (102, " \n"), (103, "🙂 😀"), (104, "vexgrub " * 30000), (104, "vexgrub " * 30000), (None, "vexgrub"),
           (105, "\x00 ﬁn x" + "y" * 5000)]
    docs = rows(data + odd).withColumns({c: F.lit(9) for c in ("_sums", "_a", "_b", "_total", "_leaning", "score", "word", "model")})
    labels = rows([(i, None) for i, _ in data]).select("doc_id", F.lit(1).alias("_half"), (F.col("doc_id") % 2).cast("int").alias("toxic"))
    model = toxicity.fit(docs, labels)
    got = toxicity.score(docs, model)
    assert got.columns == [c for c in docs.columns if not c.startswith("_") and c != "score"] + ["score"]
    found = got.collect()
    assert len(found) == len(data) + len(odd) and all(0 <= r.score <= 1 for r in found)
    by_text = {}
    for r in found:
        by_text.setdefault(r.text, set()).add(r.score)
    assert all(len(s) == 1 for s in by_text.values()) and max(by_text[None] | by_text[""]) < 0.5 < min(by_text["vexgrub " * 30000])
    assert toxicity.score(rows([]), model).count() == 0
    assert toxicity.fit(rows([]), labels).score("vexgrub") < 0.01


def test_pairs_of_words_are_counted_once_and_travel_packed(spark, tmp_path):
    draw = random.Random(3)
    words = ["the", "of", "ünder", "a", "日本", "x_1", "stop", "Go"] + [f"w{i}" for i in range(300)]
    texts = [(draw.randrange(2), draw.randrange(2), draw.choice([" ", "\n", ", "]).join(draw.choices(words, k=draw.randrange(60))))
             for _ in range(900)] + [(0, 1, None), (1, 0, ""), (1, 1, "stop stop  stop"), (1, 1, "stop")]
    expected = {}
    for half, toxic, text in texts:
        found = toxicity.found_words(text)
        for before, word in zip(["", *found], found):
            expected.setdefault(word, [set() for _ in COUNTS])[2 * half + toxic].add(before)
    train = spark.createDataFrame(texts, "_half int, _toxic int, text string")
    counted = toxicity.count_words(train.repartition(3), "text")
    assert {r.word: [r[c] for c in COUNTS] for r in counted.collect()} == {w: [len(x) for x in s] for w, s in expected.items()}
    # A row for each list, not for each pair.
    plan = counted._jdf.queryExecution().optimizedPlan().toString()
    assert "explode" not in plan.lower() and counted.where("word is null").count() == 0


def test_tasks_get_shared_chances_once_and_packed(spark):
    import pickle

    words = spark.createDataFrame([(w, i % 3, 1, 0, i % 2) for i, w in enumerate(["stop", "stoop", "top", "日本", "x_1"])],
                                  "word string, " + ", ".join(f"{c} long" for c in COUNTS))
    spelling = toxicity.learn(words)
    assert spelling.sent is spelling.sent
    sent = toxicity.Shared(spelling.top, spelling.shared, spelling.discount)
    data = pickle.dumps(sent)
    assert len(data) < spelling.shared.nbytes / 20
    top, chances, discount = pickle.loads(data)
    assert np.array_equal(chances, spelling.shared) and np.array_equal(discount, spelling.discount)
    assert np.array_equal(top.chars, spelling.top.chars) and np.array_equal(top.kinds, spelling.top.kinds)


def test_bitmap_needs_no_byte_for_each_bit(spark):
    import tracemalloc

    from zonepulse.llm import jaccard_join

    docs = spark.range(0, 5_000_000, 7_001).withColumnRenamed("id", "doc")
    tracemalloc.start()
    bits = jaccard_join.bitmap_of(docs)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    places = np.array([r[0] for r in docs.select(jaccard_join.place("doc")).collect()])
    assert jaccard_join.passed(bits, places).all() and int(np.bitwise_count(bits).sum()) == len(np.unique(places))
    assert most < 48 << 20


def test_stored_frames_leave_no_shuffle_files(tmp_path):
    import subprocess
    import sys
    import textwrap
    code = f"""
        import time
        from pathlib import Path
        from pyspark.sql import functions as F
        from zonepulse.session import CLEANUP, build_session, materialize
        spark = build_session("stored", "local[2]", **{{"spark.ui.enabled": "false", "spark.local.dir": "{tmp_path}/local",
                              "spark.checkpoint.dir": "{tmp_path}/shared", "spark.sql.shuffle.partitions": "4"}})
        before = spark.conf.get(CLEANUP)
        frame = spark.range(100000).groupBy((F.col("id") % 1000).alias("k")).count()
        stored = materialize(frame, "one")
        assert stored.count() == materialize(frame.join(stored.drop("count"), "k"), "two").count() == frame.count() == 1000
        del frame
        stored = materialize(spark.range(100000).repartition(4, "id"), "three")
        until = time.time() + 20
        count = lambda: sum(p.stat().st_size for p in Path("{tmp_path}/local").rglob("shuffle_*.data"))
        while count() > 200_000 and time.time() < until:
            time.sleep(0.2)
        assert count() < 200_000, count()
        assert spark.conf.get(CLEANUP) == before
    """
    run = subprocess.run([sys.executable, "-c", textwrap.dedent(code)], capture_output=True, text=True, timeout=120)
    assert run.returncode == 0, run.stderr[-2000:]


def test_lists_of_a_task_share_a_row_for_each_bucket(spark):
    """Rows made follow tasks and buckets: at most one for both, however many halves and classes there are."""
    words = [f"{a}{b}{c}" for a in "abcdefgh" for b in "klmn" for c in "rstu"]
    texts = [(h, t, " ".join(random.Random(i).sample(words, 60))) for i, (h, t) in enumerate([(0, 0), (0, 1), (1, 0), (1, 1)] * 20)]
    train = spark.createDataFrame(texts, "_half int, _toxic int, text string").coalesce(1)
    plan, made = toxicity.partial_counts(train, "text")._jdf.queryExecution().optimizedPlan(), []
    while plan.children().size():
        if plan.nodeName() == "MapInArrow":
            made.append([plan.output().apply(i).name() for i in range(plan.output().size())])
        plan = plan.children().apply(0)
    assert made[-1] == ["bucket", "size", "pairs"]
    # A word's counts come in a bounded number of parts.
    parts = toxicity.partial_counts(train, "text").groupBy("word").count()
    assert 1 < parts.agg(F.max("count")).first()[0] <= toxicity.SPREAD


def test_labelled_words_are_stored_packed_and_walked_without_a_shuffle(spark):
    rng = random.Random(5)
    words = [("".join(rng.choices("abé漢1_", k=rng.randint(1, 6))), *(rng.randint(0, 2) for _ in COUNTS)) for _ in range(400)]
    spelling = toxicity.learn(spark.createDataFrame(words, toxicity.COUNTED).repartition(5))
    expected = {}
    for word, *counts in words:
        expected[word] = [a + b for a, b in zip(expected.get(word, [0] * 4), counts)]
    assert {r.word: [r[c] for c in COUNTS] for r in spelling.words.collect()} == expected
    stored = spelling.packed.collect()
    assert len({r.bucket for r in stored}) == len(stored) < len(expected) and sum(r.n for r in stored) == len(expected)
    assert {r.bucket for r in stored} == {toxicity.bucket_of(w, spelling.buckets) for w in expected}
    assert "Exchange" not in spelling.words._jdf.queryExecution().executedPlan().toString()
    ratios = {(r.word): r.ratio for r in toxicity.word_ratios(
        spark.createDataFrame([(BOTH, w, 1) for w in expected], "model long, word string, n long"), spelling).collect()}
    assert toxicity.frequent(spelling) == pytest.approx(ratios)


def test_other_words_travel_packed_and_come_back_to_their_texts(spark, monkeypatch):
    """Texts in chunks of a few, whose other words are asked for by bucket, score as they do together; other columns stay theirs."""
    rng = random.Random(9)
    parts = ["ba", "vex", "grub", "mea", "dow", "ri", "漢", "ver"]
    data = [(i, " ".join("".join(rng.choices(parts, k=rng.randint(1, 3))) for _ in range(12)) + (" vexgrub" if i % 2 else ""), i % 2) for i in range(80)]
    frame = spark.createDataFrame(data, "doc_id long, text string, toxic int")
    model = toxicity.fit(frame.select("doc_id", "text"), frame.select("doc_id", "toxic"))
    texts = [(i, None if i % 9 == 0 else " ".join("".join(rng.choices(parts + ["q"], k=3)) for _ in range(i % 13)), [i, None]) for i in range(60)]
    new = spark.createDataFrame(texts + texts[:7], "doc_id long, text string, list array<long>").repartition(3)
    whole = sorted((r.doc_id, r.score) for r in toxicity.score(new, model).collect())
    monkeypatch.setattr(toxicity, "COMMON", 3)
    monkeypatch.setattr(toxicity, "ASKED", 100)
    monkeypatch.setattr(toxicity, "SLICE", 50)
    monkeypatch.setattr(toxicity, "WALKED", 5)
    monkeypatch.setattr(toxicity.shallow, "__defaults__", (0,))
    scored = toxicity.score(new, model)
    got = scored.collect()
    assert [x for x, _ in whole] == sorted(r.doc_id for r in got) and all(r.list == [r.doc_id, None] for r in got)
    assert [s for _, s in whole] == pytest.approx([s for _, s in sorted((r.doc_id, r.score) for r in got)])
    assert {(r.doc_id, r.text) for r in got} == {t[:2] for t in texts}
    by_text = {}
    for r in got:
        by_text.setdefault(r.text, set()).add(r.score)
    assert all(len(s) == 1 for s in by_text.values())
    assert "explode" not in scored._jdf.queryExecution().optimizedPlan().toString().lower()


def test_a_text_that_is_kept_is_sent_to_python_once(spark):
    data = [(i, f"quiet river w{i % 7} {'vexgrub' if i % 2 else 'meadow'}", i % 2) for i in range(40)]
    frame = spark.createDataFrame(data, "doc_id long, text string, toxic int")
    model = toxicity.fit(frame.select("doc_id", "text"), frame.select("doc_id", "toxic"))
    common = spark.sparkContext.broadcast((toxicity.frequent(model.spelling), None))
    for kept in (["doc_id", "text"], ["doc_id"], ["text", "doc_id"]):
        asking = toxicity._asking(frame.select("doc_id", "text"), kept, "text", common, model.spelling.buckets)
        assert asking._jdf.queryExecution().optimizedPlan().children().apply(0).output().size() == 2
        assert asking.where("_bucket is null").selectExpr("sum(_n)").first()[0] == 160

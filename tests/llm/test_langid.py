import math
import random

import numpy as np
import pytest

from tonality.llm import langid as L

from conftest import SF_SMALL


def brute(training, probe):
    """Code length by walking the byte context tree with exclusion, one byte at a time."""
    tree = {}
    for text in training:
        t = b"   " + text.translate(L.FOLD)
        for i in range(3, len(t)):
            for k in range(4):
                node = tree.setdefault(t[i - k:i], {})
                node[t[i]] = node.get(t[i], 0) + 1

    def dist(ctx):
        below = dist(ctx[1:]) if ctx else [1 / 256] * 256
        c = tree.get(ctx)
        if not c:
            return below
        total, kinds = sum(c.values()), len(c)
        if kinds == 256:
            return [c[s] / total for s in range(256)]
        rest = 1 - sum(below[s] for s in c)
        return [c[s] / (total + kinds) if s in c else kinds / (total + kinds) * below[s] / rest for s in range(256)]

    t = b"   " + probe.translate(L.FOLD)
    return sum(-math.log2(dist(t[i - 3:i])[t[i]]) for i in range(3, len(t)))


def model_of(**training):
    return L.Model({k: L.merged(*np.unique(np.concatenate([L.grams(b"   " + t.translate(L.FOLD)) for t in texts]), return_counts=True)) for k, texts in training.items()})


def test_code_lengths_match_a_tree_walk(monkeypatch):
    r = random.Random(2)
    training = {"x": ["".join(r.choice("aab bc d") for _ in range(400)).encode(), b"", "Привет, мир".encode()],
                "y": ["".join(r.choice("我们的世界 ") for _ in range(90)).encode(), bytes(range(256))]}
    m = model_of(**{k: [t for t in v if t] for k, v in training.items()})
    probes = [b"abcdABacadabzz dd", "世界мир".encode(), b"", b"\x00\xff", b"a", bytes(r.randrange(256) for _ in range(50))]
    want = [[brute([t for t in training[k] if t], p) for k in m.langs] for p in probes]
    for chunk in (1 << 20, 5, 1):
        monkeypatch.setattr(L, "CHUNK", chunk)
        assert L.code_lengths(m, probes) == pytest.approx(np.array(want), rel=1e-5)


def test_a_byte_that_never_came_in_any_context_costs_the_escapes():
    full = model_of(x=[bytes(range(256)) * 3])
    assert L.code_lengths(full, [b"\x07"])[0, 0] == pytest.approx(brute([bytes(range(256)) * 3], b"\x07"), rel=1e-5)


def test_memory_goes_with_the_strings_seen_not_with_languages_times_bytes():
    r = random.Random(9)
    scripts = [[chr(0x400 + 40 * k + j) for j in range(30)] for k in range(100)]
    m = model_of(**{f"l{k:03}": [" ".join("".join(r.choice(s) for _ in range(5)) for _ in range(300)).encode()] for k, s in enumerate(scripts)})
    size = sum(t.nbytes for t in m.trees())
    assert size < 20 * sum(len(keys) for keys, _ in m.counts.values()) * (L.ORDER + 1)
    got = L.code_lengths(m, [" ".join("".join(r.choice(s) for _ in range(5)) for _ in range(6)).encode() for s in scripts])
    assert [int(k) for k in got.argmin(axis=1)] == list(range(100))


def test_scripts_without_latin_letters(spark):
    r = random.Random(4)
    words = {"ru": "мир труд год слово дело день рука раз глаз жизнь".split(), "uk": "світ праця рік слово діло день рука раз око життя".split(),
             "zh": "我们 世界 时间 工作 生活 问题 国家 社会".split(), "ja": "わたし せかい 時間 しごと 生活 もんだい くに 社会".split(), "en": "the world time work life question land people".split()}
    lines = [(i, " ".join(r.choices(words[k], k=8)), k) for i in range(400) for k in words]
    df = spark.createDataFrame([(5 * i + j, t, k) for j, name in enumerate(words) for i, t, k in lines if k == name], "doc_id long, text string, lang string")
    out = L.identify(df).join(df, "doc_id").where("held_out").collect()
    right = {k: [x.lang_pred == x.lang for x in out if x.lang == k] for k in words}
    assert all(sum(v) / len(v) > 0.95 for v in right.values()), {k: sum(v) / len(v) for k, v in right.items()}


def test_a_group_of_copies_teaches_once(spark):
    rows = [(i, "la copia de una misma cosa", "es") for i in range(500)] + [(1000 + i, f"the other text number {i} of the list", "en") for i in range(40)]
    m = L.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"), fit_rows=30)
    assert m.counts["es"][1].sum() == len("la copia de una misma cosa")
    assert m.langs == ["en", "es"] and m.counts["en"][1].sum() < 45 * 40


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    out = L.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in out if r.held_out]
    assert len(out) == docs.count() and held
    assert sum(r.lang_pred == r.lang for r in held) / len(held) > 0.95
    assert all(0 <= r.score <= 1 for r in out)


def test_defined_cases(spark):
    rows = [(1, "the quick fox and the dog", "en", "s"), (3, "der schnelle fuchs und der hund", "de", None), (4, None, "en", "s"),
            (5, "", None, "s"), (6, "123 !!", "en", "s"), (None, "the dog", "en", "s"), (8, "THE DOG and the fox", None, "s"), (8, "THE DOG and the fox", None, "s")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, score string")
    out = L.identify(df).collect()
    assert len(out) == len(rows)
    by = {r.doc_id: r for r in out}
    assert [by[i].lang_pred for i in (4, 5, 6)] == ["und"] * 3 and by[8].lang_pred == "en" and by[None].lang_pred == "en"
    assert L.identify(df.limit(0)).collect() == []
    assert {r.lang_pred for r in L.identify(df.withColumn("lang", df.lang.cast("string").substr(9, 1)).replace("", None, "lang")).collect()} == {"und"}

import random
import re

import pytest

from tonality.llm import quality as Q

from conftest import SF_CHECK


def brute(text):
    t = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", t)
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    wins = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    seen = {}
    for w in wins:
        seen[w] = seen.get(w, 0) + 1
    covered = {j for i, w in enumerate(wins) if seen[w] > 1 for j in range(i, i + 8)}
    return len(words), sum(map(len, words)), sum(t.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered)


def texts():
    r = random.Random(6)
    out = [None, "", " \n\t\n ", "one", "a b c d e f g h", "a " * 16, "a b c d e f g h " * 2, "x\x0by\fz\r\nq  # é", "l\nl\nl \n\n m"]
    for _ in range(60):
        v = [r.choice(["a", "bb", "é#", "|", "日本"]) for _ in range(r.randint(1, 3))]
        out.append("".join(r.choice(v) + r.choice([" ", "\n", "  ", "\t"]) for _ in range(r.randint(1, 120))))
    return out


def test_counts_match_brute_force(spark):
    rows = [(i if i else None, t, "en", 1) for i, t in enumerate(texts())] + [(3, "one", "en", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, words string, n_words int")
    got = Q.text_counts(df).select("doc_id", *Q.COUNTS).collect()
    assert len(got) == len(rows)
    want = {r[0]: brute(r[1]) for r in rows}
    for g in got:
        assert tuple(g)[1:] == want[g.doc_id], rows[g.doc_id or 0]
    assert Q.judge(df.limit(0), spark.createDataFrame([], "doc_id long, quality int")).collect() == []


def test_learned_rules_find_the_planted_thresholds(spark):
    r = random.Random(1)
    rows = [(x, y, x > 0.7 and y <= 0.4 or x <= 0.1) for x, y in ((r.random(), r.random()) for _ in range(6000))]
    df = spark.createDataFrame(rows, "x double, y double, bad boolean")
    rules = Q.learn(df, features=("x", "y"))
    assert 2 <= len(rules) <= 6
    cover = [any(all((v[n] <= at) if up else (v[n] > at) for n, up, at in rule.conditions) for rule in rules) for v in ({"x": x, "y": y} for x, y, _ in rows)]
    assert sum(c == b for c, (_, _, b) in zip(cover, rows)) / len(rows) > 0.97
    assert Q.learn(df.withColumn("bad", df.x < -1), features=("x", "y")) == []


def test_held_out_accuracy_and_defined_cases(spark):
    docs = spark.read.parquet(f"{SF_CHECK}/documents.parquet")
    labels = spark.read.parquet(f"{SF_CHECK}/labels.parquet")
    teach = labels.where("doc_id % 2 = 0")
    out = {r.doc_id: r for r in Q.judge(docs, teach).collect()}
    held = labels.where("doc_id % 2 = 1").collect()
    ok = [out[r.doc_id].kept == (r.quality == 1) for r in held]
    assert len(out) == docs.count() and sum(ok) / len(ok) > 0.9
    good = [out[r.doc_id].kept for r in held if r.quality == 1]
    assert sum(good) / len(good) > 0.95
    bare = Q.judge(docs, labels.limit(0))
    assert bare.where("kept = base_failed").count() == 0

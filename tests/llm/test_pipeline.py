"""Every stage of the pipeline against a plain version on its own input."""

import hashlib
import struct

import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline as P
from tonality.llm import decontam, ordinal
from tonality.llm.common import held_out, materialise

from conftest import SF_SMALL
from test_decontam import brute as brute_leaks
from test_linededup import distance
from test_simhash import brute_components, brute_fp


def test_stages(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    columns, kept, frames = docs.columns, [], {"": docs}
    for name, stage in P.STAGES:
        docs = materialise(stage(spark, docs, SF_SMALL), "test-stage")
        frames[name] = docs
        kept.append(docs.count())
        if name != P.STAGES[-1][0]:
            assert docs.columns == columns
    one, two, three, four, five = ([tuple(r) for r in frames[n].orderBy("doc_id").collect()] for n, _ in P.STAGES)
    start = [tuple(r) for r in frames[""].orderBy("doc_id").collect()]

    labels = spark.read.parquet(f"{SF_SMALL}/labels.parquet")
    model = ordinal.fit(frames[""], ordinal.ratings(labels).where(~held_out()))
    assert one == [r for r in start if model.tail(r[1])[1] >= 0.5]
    good = {r.doc_id for r in labels.where("quality = 1").collect()}
    assert len({r[0] for r in one} & good) / len(good & {r[0] for r in start}) > 0.95

    # lines: classes by plain comparison of all different long lines
    places = [(d, i, x) for d, t, *_ in one for i, x in enumerate(t.split("\n"))]
    texts = sorted({x for *_, x in places if len(x) >= 20}, key=lambda x: (len(x), x))
    first = {}
    for d, i, x in places:
        first[x] = min(first.get(x, (d, i)), (d, i))
    near = {x: set() for x in texts}
    for i, x in enumerate(texts):
        for y in texts[i + 1:]:
            if len(y) - len(x) > 2:
                break
            if sum(a != b for a, b in zip(x, y)) <= 2 or x[:len(x) // 3] == y[:len(x) // 3] or x[-(len(x) // 3):] == y[-(len(x) // 3):] or x[len(x) // 3:len(x) // 2] in y:
                if distance(x, y) <= 2:
                    near[x].add(y)
                    near[y].add(x)
    named = {}
    for x in texts:
        todo, seen = [x], {x}
        while todo:
            for y in near[todo.pop()] - seen:
                seen.add(y)
                todo.append(y)
        named[x] = min(first[z] for z in seen)
    want = [(d, "\n".join(x for i, x in enumerate(t.split("\n")) if len(x) < 20 or named[x] == (d, i)), *rest) for d, t, *rest in one]
    assert two == want

    comp = {d: c for d, _, c in brute_components([(r[0], brute_fp(r[1])) for r in two])}
    assert three == [r for r in two if comp[r[0]] == r[0]]

    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    leaks = {d for d, _ in brute_leaks(bench, three)}
    assert four == [r for r in three if r[0] not in leaks]
    assert leaks == {r.doc_id for r in decontam.leaks(frames["SimHash near-dedup"], spark.read.parquet(f"{SF_SMALL}/benchmark.parquet")).collect()}

    lib = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for r, (doc_id, n, ids, text) in zip(four, five):
        got = lib.encode(r[1], add_special_tokens=False).ids
        assert (doc_id, n, ids, text) == (r[0], len(got), hashlib.sha256(struct.pack(f"<{len(got)}I", *got)).hexdigest(), hashlib.sha256(r[1].encode()).hexdigest())
    assert len(four) == len(five)
    assert [r[0] for r in five] == sorted(r.doc_id for r in P.run(spark, SF_SMALL).collect())
    assert start and kept[0] > kept[2] >= kept[3] == kept[4] > 0 and kept[0] == kept[1]


def test_defined_cases_run_through(spark, tmp_path):
    docs = spark.createDataFrame([(1, None, None, None, None), (1, None, None, None, None), (None, "x", "en", "s", 1), (3, "", "en", "s", 0), (4, "some words " * 30, "en", "s", 9)],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{SF_SMALL}/{name}.parquet").limit(0).write.parquet(str(tmp_path / f"{name}.parquet"))
    for rows in (docs, docs.limit(0)):
        out = rows
        for _, stage in P.STAGES:
            out = materialise(stage(spark, out, str(tmp_path)), "test-cases")
        got = sorted(r.doc_id or 0 for r in out.collect())
        assert got == ([0, 1, 1, 4] if rows is docs else [])


def test_stages_send_small_batches_on_any_session(spark):
    own = spark.conf.get(P.ROWS)
    docs = spark.createDataFrame([(1, "a b c d " * 30, "en", "web", 240), (2, None, None, None, None)], "doc_id long, text string, lang string, source string, n_chars long")
    try:
        for name, stage in P.STAGES:
            spark.conf.set(P.ROWS, "10000")
            stage(spark, docs, SF_SMALL)
            assert spark.conf.get(P.ROWS) == "2000", name
    finally:
        spark.conf.set(P.ROWS, own)

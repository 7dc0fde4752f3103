import random

import numpy as np

from tonality.llm import decontam as D


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b, 1):
            new.append(row[j - 1] + 1 if x == y else max(row[j], new[-1]))
        row = new
    return row[-1]


def test_bit_parallel_lcs():
    r = random.Random(1)
    for _ in range(500):
        a, b = ([r.choice([b"a", b"b", b"c", b"d"]) for _ in range(r.randint(0, 90))] for _ in range(2))
        assert D.lcs(D.places(a), len(a), b) == lcs(a, b)


def corpus(r, n=500):
    vocab = [f"w{i}" for i in range(3000)] + ["the", "of", "and", "to"] * 200
    items = [(i, " ".join(r.choice(vocab) for _ in range(r.randint(12, 60)))) for i in range(30)]
    docs, planted = [], set()
    for d in range(n):
        ws = [r.choice(vocab) for _ in range(r.randint(1, 400))]
        if r.random() < 0.4:
            k, t = r.choice(items)
            part = t.split()
            if r.random() < 0.5:  # paraphrase: a quarter of the words before the answer replaced or dropped
                head = [w if r.random() > 0.25 else r.choice(vocab) for w in part[:-8] if r.random() > 0.05]
                part = head + part[-8:]
            at = r.randrange(len(ws) + 1)
            ws[at:at] = [w.upper() if r.random() < 0.1 else w for w in part]
            planted.add((d, k))
        docs.append((d, " ".join(ws), "x"))
    return items, docs, planted


def brute(items, docs):
    """Every item against every window of every document, by the same verification and no candidate search."""
    limits = D.Limits(-2, 0.8, 0.6, 0.8, 8)
    out = set()
    for k, t in items:
        it = D.Item(k, D.words(t), 8)
        for d, text, *_ in docs:
            ws = D.words(text)
            size = len(it.words) + 2 * D.BLOCK
            if any(D.verify(it, ws[a:a + size], set(ws[a:a + size]), limits) for a in range(0, max(1, len(ws)), D.BLOCK // 2)):
                out.add((d, k))
    return out


def test_planted_leaks_are_found_and_clean_documents_left(spark):
    items, docs, planted = corpus(random.Random(3))
    extra = [(None, items[0][1], "x"), (900, None, "x"), (901, "", "x"), (7, docs[7][1], "x")]
    df = spark.createDataFrame(docs + extra, "doc_id long, text string, item_id string")
    bench = spark.createDataFrame([(k, t, 1) for k, t in items] + [(None, "x", 1), (77, None, 1), (78, "", 1)], "item_id long, text string, doc_id int")
    rows = D.leaks(df, bench).collect()
    got = {(r.doc_id, r.item_id) for r in rows if r.doc_id is not None}
    want = brute(items, docs)
    assert len(got & want) >= 0.9 * len(want) and len(got & planted) >= 0.95 * len(planted & want)
    assert not {d for d, _ in got} - {d for d, _ in want | planted}
    assert len(rows) == len({(r.doc_id, r.item_id) for r in rows}) and (None, items[0][0]) in {(r.doc_id, r.item_id) for r in rows}
    kept = {r.doc_id for r in D.clean(df, bench).collect()}
    assert kept == ({d for d, *_ in docs} | {900, 901}) - {d for d, _ in got}


def test_short_items_and_empty_tables(spark):
    df = spark.createDataFrame([(1, "one two three four"), (2, "two one four"), (3, "zz Two Three yy")], "doc_id long, text string")
    bench = spark.createDataFrame([(1, "two three")], "item_id long, text string")
    assert {(r.doc_id, r.item_id) for r in D.leaks(df, bench, cosine=0.3).collect()} == {(1, 1), (3, 1)}
    assert D.leaks(df.limit(0), bench).collect() == [] and D.leaks(df, bench.limit(0)).collect() == []
    assert D.clean(df, bench.limit(0)).count() == 3


def test_block_sums_and_passages():
    rows = np.arange(12, dtype=np.float32).reshape(6, 2)
    at, ids = np.array([0, 3, 17, 40]), np.array([1, 1, 5, 2])
    b = D.block_sums(at, ids, 50, rows)
    assert b.tolist() == [[4, 6], [10, 11], [4, 5], [0, 0]]
    assert D.passages(b, 2).tolist() == [[14, 17], [14, 16], [4, 5]] and len(D.passages(b[:1], 2)) == 1


def planted_copies(r, per_length=5):
    """Items of 1 to 24 words, and documents of other benchmark words in which each stands: whole, or from 12 words on with one word changed."""
    vocab = [f"w{i}" for i in range(1500)]
    items = [(n * 100 + k, [r.choice(vocab) for _ in range(n)]) for n in range(1, 25) for k in range(per_length)]
    foreign = [w for _, ws in items for w in ws if len(ws) >= 8]
    docs, altered = [], set()
    for k, ws in items:
        for change in (False, True):
            part = list(ws)
            if change:
                if len(ws) < 12:
                    continue
                part[r.randrange(len(ws) - 8)] = "changed"
                altered.add((len(docs), k))
            host = [r.choice(foreign) for _ in range(r.randint(60, 300))]
            at = r.randrange(len(host) + 1)
            docs.append((len(docs), " ".join(host[:at] + part + host[at:])))
    return [(k, " ".join(ws)) for k, ws in items], docs, altered


def test_short_items_within_foreign_benchmark_words(spark):
    items, docs, altered = planted_copies(random.Random(11))
    df, bench = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id): r for r in D.leaks(df, bench).collect()}
    copies = {(d, k) for d, t in docs for k, x in items if f" {x} " in f" {t} "}
    assert copies <= set(got) and all(got[p].kind == "verbatim" and got[p].lcs_share == 1 for p in copies)
    assert len(altered & set(got)) >= 0.95 * len(altered)
    size = {k: len(x.split()) for k, x in items}
    assert {p for p in got if size[p[1]] < 8} == {p for p in copies if size[p[1]] < 8}


def test_clean_judges_each_row_by_its_own_text(spark):
    leak, rest = "alpha beta gamma delta epsilon zeta eta theta iota kappa", "some other words that stand in no item at all"
    rows = [(None, leak), (None, rest), (None, None), (1, leak), (1, rest), (1, rest), (2, rest)]
    df, bench = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame([(5, leak)], "item_id long, text string")
    key = lambda r: (r[0] or 0, r[1] or "")
    assert sorted((tuple(r) for r in D.clean(df, bench).collect()), key=key) == sorted((r for r in rows if r[1] != leak), key=key)


def test_one_word_items_empty_no_corpus_and_items_need_no_id(spark):
    rows = [(1, "the cat sat on the mat"), (2, "alpha beta gamma delta epsilon zeta eta theta iota kappa and the rest"), (3, "no article here")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame([(1, "the"), (None, "alpha beta gamma delta epsilon zeta eta theta iota kappa")], "item_id long, text string")
    assert {(r.doc_id, r.item_id) for r in D.leaks(df, bench).collect()} == {(1, 1), (2, 1), (2, None)}
    assert sorted(r.doc_id for r in D.clean(df, bench).collect()) == [1, 3]
    assert sorted(r.doc_id for r in D.clean(df, bench, least_words=1).collect()) == [3]


def test_passes_are_bounded_by_words_and_lose_no_item(spark, monkeypatch):
    items, docs, _ = planted_copies(random.Random(5), per_length=2)
    df, bench = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    monkeypatch.setattr(D, "VOCABULARY", 250)
    spaces = list(D._spaces(df.limit(5), bench, 8, 16, 50))
    assert len(spaces) > 1 and all(len(s.vocab) <= 250 for s in spaces)
    assert sorted(it.id for s in spaces for it in s.items) == sorted(k for k, _ in items)
    long = D.Space([D.Item(1, [b"%d" % i for i in range(100_000)], 8)])  # memory grows with the words, not with items x vocabulary
    long.set_frequencies(np.ones(len(long.vocab)), 1000)
    assert len(long.item_vectors()[0][0]) == 100_000 and long.project(np.ones((100_000, 2), dtype=np.float32)).shape == (1, 2)


def test_item_vectors_equal_a_dense_matrix():
    r = random.Random(2)
    s = D.Space([D.Item(k, [b"%d" % r.randrange(30) for _ in range(r.randint(0, 40))], 8) for k in range(20)])
    s.set_frequencies([r.randint(1, 50) for _ in s.vocab], 5000)
    dense = np.zeros((20, len(s.vocab)))
    for k, it in enumerate(s.items):
        for w in it.words:
            dense[k, s.vocab[w]] += s.weight[s.vocab[w]]
    q = np.random.default_rng(1).standard_normal((len(s.vocab), 5)).astype(np.float32)
    assert np.allclose(s.project(q), dense @ q, atol=1e-3)


def test_space_is_fitted_on_the_passages_of_every_document(spark):
    r = random.Random(11)
    pool = [f"word{i}" for i in range(40)]
    items = [D.Item(i, D.words(" ".join(r.sample(pool, 12))), 8) for i in range(20)]
    texts = [" ".join(r.sample(pool, 3) + [f"x{i}"] * 4) for i in range(10000)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    s = D.Space(items)
    s.set_frequencies(*D.frequencies(docs, s))
    D.fit(docs, s, rank=len(s.vocab))
    a = np.zeros((len(texts), len(s.vocab)))
    for row, t in zip(a, texts):
        for w in D.words(t):
            if w in s.vocab:
                row[s.vocab[w]] += s.weight[s.vocab[w]]
    own = np.zeros((len(items), len(s.vocab)))
    for row, (ids, x) in zip(own, s.item_vectors()):
        row[ids] = x
    whole = a.T @ a + (a ** 2).sum() / (own ** 2).sum() * (own.T @ own)
    got = s.basis.T.astype(float) @ whole @ s.basis
    assert np.abs(got - np.diag(np.diag(got))).max() < 1e-4 * got.max()


def test_texts_are_read_and_split_once_a_pass(spark):
    read = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            read.add(b.num_rows)
            yield b

    docs = spark.createDataFrame([(i, f"alpha beta gamma delta epsilon zeta eta theta w{i}") for i in range(300)], "doc_id long, text string").mapInArrow(count, "doc_id long, text string")
    bench = spark.createDataFrame([(1, "alpha beta gamma delta epsilon zeta eta theta")], "item_id long, text string")
    assert len(D.leaks(docs, bench).collect()) == 300
    assert read.value == 300


ODD = ["", None, "  ,. ", "one", " One\tTWO\n\x00three ", "Ärger ΣΑΣ İ ñ 漢字 Ärger", "x " * 40, "a b c d e f g h i j k l m n o p", "q r one two " * 30, " nbsp one two"]


def odd_space():
    s = D.Space([D.Item(k, D.words(t), 8) for k, t in enumerate(["one two three", "ärger σας 漢字", "p q r", "x a b c d e f g h i j k l m", "i̇ ñ", ""])])
    s.set_frequencies([3 + k % 5 for k in range(len(s.vocab))], 5000)
    return s


def test_codes_are_the_words_in_whole_blocks():
    s = odd_space()
    for texts in (ODD, ODD[:3], [], ODD * 40):
        flat, sizes = s.code(texts, s.words())
        want = [[s.vocab.get(w, len(s.vocab)) for w in D.words(t)] for t in texts]
        assert sizes.tolist() == [-(-len(ws) // D.BLOCK) for ws in want]
        padded = [x for ws, n in zip(want, sizes.tolist()) for x in ws + [len(s.vocab) + 1] * (n * D.BLOCK - len(ws))]
        assert flat.tolist() == padded


def test_copies_end_with_their_text():
    s = odd_space()
    plain = [D.words(t) for t in ODD]  # one text ends in "p" on a block's end, the next begins with "q r"
    want = {(d, k): i for d, ws in enumerate(plain) for k, it in enumerate(s.items) if it.words for i in reversed(range(len(ws))) if ws[i:i + len(it.words)] == it.words}
    got = s.copies(*s.code(ODD, s.words()))
    assert len(plain[7]) == D.BLOCK and len(got) == len(want) and {(d, k): i for d, k, i in got} == want


def test_group_sums_passages_and_their_transpose():
    r = np.random.default_rng(4)
    rows = r.standard_normal((50, 3)).astype(np.float32)
    counts = np.array([0, 1, 700, 16, 17, 0, 33, 2])
    at = r.integers(0, 50, counts.sum())
    ends = np.cumsum(counts)
    assert np.allclose(D.sums(rows, at, counts), [rows[at[e - n:e]].sum(axis=0) for e, n in zip(ends, counts)], atol=1e-3)
    sizes = np.array([1, 0, 2, 5, 1, 3])
    for span in (1, 2, 3):
        blocks = r.standard_normal((sizes.sum(), 3)).astype(np.float32)
        own = [D.passages(b, span) for b in np.split(blocks, np.cumsum(sizes)[:-1])]
        z = D.passages(blocks, span, sizes)
        assert np.allclose(z, np.concatenate(own), atol=1e-5) and len(z) == D.windows(sizes, span).sum()
        y = r.standard_normal(z.shape).astype(np.float32)
        assert np.isclose((z * y).sum(), (blocks * D.spread(y, span, sizes)).sum(), atol=1e-3)


def test_frequencies_count_blocks_that_hold_a_word(spark):
    s = odd_space()
    df, n = D.frequencies(spark.createDataFrame(list(enumerate(ODD)), "doc_id long, text string"), s)
    blocks = [ws[a:a + D.BLOCK] for ws in map(D.words, ODD) for a in range(0, len(ws), D.BLOCK)]
    assert n == len(blocks) and df.tolist() == [sum(w in b for b in blocks) for w in s.vocab]


def test_a_text_has_the_same_leaks_whatever_texts_are_worked_on_with_it():
    items, docs, _ = planted_copies(random.Random(8), per_length=2)
    s = D.Space([D.Item(k, D.words(t), 8) for k, t in items])
    s.set_frequencies(np.random.default_rng(2).integers(1, 60, len(s.vocab)), 5000)
    s.set_basis(np.linalg.qr(np.random.default_rng(3).standard_normal((len(s.vocab), 40)))[0])
    texts, limits = [t for _, t in docs] + ODD, D.Limits(0.4, 0.8, 0.6, 0.8, 8)
    at_once = list(D.search(s, *s.code(texts, s.words()), limits))
    alone = [(d, *x) for d, t in enumerate(texts) for _, *x in D.search(s, *s.code([t], s.words()), limits)]
    assert len(alone) > 50 and sorted(at_once, key=str) == sorted(alone, key=str)

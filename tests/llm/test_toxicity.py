import random

from tonality.llm import toxicity as T
from tonality.llm.common import held_out

SF_BENCH = "/root/testdata/sf0.1"


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = _next(row, i, x, b)
    return row[-1]


def _next(row, i, x, b):
    out = [i]
    for j, y in enumerate(b, 1):
        out.append(min(row[j] + 1, out[-1] + 1, row[j - 1] + (x != y)))
    return out


def test_automaton_matches_brute_force():
    r = random.Random(7)
    terms = ["".join(r.choice("abcé") for _ in range(r.randint(2, 10))) for _ in range(40)]
    auto = T.TrieAutomaton(terms, limit=200)
    for _ in range(3000):
        w = list(r.choice(terms)) if r.random() < 0.7 else [r.choice("abcé") for _ in range(r.randint(0, 9))]
        for _ in range(r.randint(0, 3)):
            k = r.randrange(len(w) + 1)
            w[k:k + r.randint(0, 1)] = [r.choice("abcz")] if r.random() < 0.6 else []
        w = "".join(w)
        want = sorted((distance(w, t), t) for t in set(terms) if distance(w, t) <= T.allowed(t))
        assert auto.match(w) == ((want[0][1], want[0][0]) if want else None), w


def test_context_separates_quotation_from_abuse():
    m = T.Scorer({"idiot": (5.0, 3.0), "moron": (5.0, 3.0)})
    quote = m.matches('The report said the word "idiot" was used in the letter of the court')[0]
    abuse = m.matches("you are such an idi0t and a moron")
    assert quote[3] > 0.9 and quote[4] < 0.3
    assert [x[:3] for x in abuse] == [("idiot", 1, "idi0t"), ("moron", 0, "moron")] and all(x[3] == 0 and x[4] >= 0.3 for x in abuse)


def test_held_out_accuracy(spark):
    # sf0.1: the smallest tables whose labels show the toxic words of every language
    docs = spark.read.parquet(f"{SF_BENCH}/documents.parquet")
    labels = spark.read.parquet(f"{SF_BENCH}/labels.parquet")
    out = T.detect(docs.join(labels.select("doc_id"), "doc_id", "left_semi"), labels).cache()
    rows = out.where(held_out()).join(labels, "doc_id").collect()
    assert out.count() == labels.count()
    hit = sum(r.predicted == r.toxic for r in rows) / len(rows)
    assert hit > 0.95 and all(0 <= r.score <= 1 for r in out.collect())


def test_defined_cases(spark):
    docs = spark.createDataFrame([(1, None, 1), (2, "", 0), (None, "you idiot", 1), (4, "fine day", 0), (4, "fine day", 0)], "doc_id long, text string, toxic int")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert [r.score for r in T.detect(docs, none).collect()] == [0.0] * 5
    same = spark.createDataFrame([(1, 1), (2, 1), (None, 0), (4, None)], "doc_id long, toxic int")
    assert {r.predicted for r in T.detect(docs, same).collect()} == {0}
    assert T.detect(docs.limit(0), none).collect() == []
    # copies teach once: too few different texts give no term, and every score is 0
    copies = spark.createDataFrame([(i, "you total idiot " if i % 2 else "a fine day ", i) for i in range(400)], "doc_id long, text string, n int")
    assert {r.score for r in T.detect(copies, copies.selectExpr("doc_id", "doc_id % 2 as toxic")).collect()} == {0.0}
    r = random.Random(5)
    filler = lambda: " ".join(f"w{r.randrange(500)}" for _ in range(12))
    many = spark.createDataFrame([(i, ("you total idiot " if i % 2 else "a fine day ") + filler(), i) for i in range(400)], "doc_id long, text string, n int")
    lab = many.selectExpr("doc_id", "doc_id % 2 as toxic")
    out = T.detect(many.union(spark.createDataFrame([(1000, "what an idoit, idi0t", 1), (1001, None, 1)], many.schema)), lab)
    by = {r.doc_id: r for r in out.collect()}
    assert by[1000].predicted == 1 and by[1001].predicted == 0 and by[1].score > 0.5 > by[2].score


def test_counts_cover_all_labelled_rows_and_every_text_of_a_shared_passage(spark):
    r = random.Random(6)
    filler = lambda n: " ".join(f"w{r.randrange(4000)}" for _ in range(n))
    rows = [(i, f"{filler(6)} {'grubwort' if i % 2 else 'fine'} {filler(6)}", i % 2) for i in range(2000)]
    rows += [(3000 + i, f"{filler(5)} raretoxin {filler(5)}", 1) for i in range(30)]  # a sample of 50 a class shows it once or twice
    rows += [(4000 + i, "the very same passage opens all of these texts " * 3 + filler(10) + (" sharedbad" if i % 2 else ""), i % 2) for i in range(60)]
    df = spark.createDataFrame([(a, b) for a, b, _ in rows], "doc_id long, text string")
    lab = spark.createDataFrame([(a, c) for a, _, c in rows], "doc_id long, toxic int")
    want = T.learn(df, lab, fit_rows=50)
    assert {"grubwort", "raretoxin"} <= set(want.lexicon)
    texts = T._labelled(df, lab, 10).collect()  # the shuffle join
    assert sorted((x.doc_id, x.toxic, x.text) for x in texts) == sorted((a, c, b) for a, b, c in rows)
    held = {}
    for x in texts:
        for w in set(T.WORD.findall(x.text.lower())):
            held.setdefault(w, (set(), set()))[x.toxic].add(x.h)
    got = {x.word: (x.good, x.bad) for x in T._by_class(T._labelled(df, lab, 10 ** 6), lambda t: set(T.WORD.findall(t.lower()))).collect()}
    assert got == {w: (len(g), len(b)) for w, (g, b) in held.items()}


def test_context_words_are_learned(spark):
    r = random.Random(8)
    filler = lambda: " ".join(f"w{r.randrange(3000)}" for _ in range(8))
    rows = []
    for i in range(1200):
        kind = i % 12
        if kind < 6:  # abuse
            rows.append((i, f"{filler()} zorga grubwort {filler()}", 1))
        elif kind == 6 and i % 48 == 6:  # report of it, in words that no list holds
            rows.append((i, f"{filler()} velku grubwort {filler()}", 0))
        else:
            rows.append((i, f"{filler()} {filler()}", 0))
    df = spark.createDataFrame([(a, b) for a, b, _ in rows], "doc_id long, text string")
    m = T.learn(df, spark.createDataFrame([(a, c) for a, _, c in rows], "doc_id long, toxic int"), evidence=15.0)
    assert "grubwort" in m.lexicon and m.context["velku"] < -0.5 and m.context.get("zorga", 0) >= 0
    assert m.score("a b c zorga grubwort d e f") > 0.5 > m.score("a b c velku grubwort d e f")


def test_very_long_and_clashing(spark):
    m = T.Scorer({"grubwort": (5.0, 3.0)}, ([1.0] * 5, -3.0, [0.0] * 5, [1.0] * 5))
    long = "fine day " * 200_000 + "grubwort" + " fine day" * 200_000 + " " + "x" * 1_000_000
    df = spark.createDataFrame([(1, long, 1.0, 7), (2, None, 0.0, 7)], "doc_id long, text string, score double, predicted int").withColumn("h", __import__("pyspark.sql.functions").sql.functions.lit(1))
    got = {r.doc_id: r for r in T.score(df, m).collect()}
    assert got[1].predicted == 1 and got[2].predicted == 0
    assert [x[0] for x in m.matches(long)] == ["grubwort"]

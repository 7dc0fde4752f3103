"""Scalar text functions: edge rows and property checks against Python's
own string semantics (the behaviour being reproduced)."""

import re
import urllib.parse

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tonality.functions import html as H
from tonality.functions import labels as L
from tonality.functions import prompts as P
from tonality.functions import text as T


def col_values(spark, values, fn, schema="s string"):
    df = spark.createDataFrame([(v,) for v in values], schema)
    return [r[0] for r in df.select(fn(F.col("s"))).collect()]


# ---------------------------------------------------------------- reference
def py_clean_query(q):
    c = q.lower()
    c = re.sub(r"\$[A-Z]{1,5}", "", c)
    c = re.sub(r"\b[A-Z]{1,5}\b", "", c)
    c = re.sub(r"[^\w\s.,!?-]", "", c)
    return re.sub(r"\s+", " ", c).strip()


def py_tickers(t):
    return re.sub(r"\b[A-Z]{1,5}\b", "", re.sub(r"\$[A-Z]{1,5}", "", t))


ALPHABET = st.sampled_from(list("ABCXYZabcxyz019 _$.,!?-@\t\n  éÉ½·'\"#%/~*+") + ["́", "Ω", "ß"])
TEXTS = st.lists(ALPHABET, max_size=40).map("".join)


@settings(max_examples=60, deadline=None)
@given(st.lists(TEXTS, min_size=1, max_size=20))
def test_clean_functions_match_python(spark, texts):
    assert col_values(spark, texts, T.clean_tickers) == [py_tickers(t) for t in texts]
    assert col_values(spark, texts, T.clean_query_text) == [py_clean_query(t) for t in texts]
    assert col_values(spark, texts, T.ustrip) == [t.strip() for t in texts]
    assert col_values(spark, texts, T.collapse_ws) == [re.sub(r"\s+", " ", t).strip() for t in texts]
    assert col_values(spark, texts, lambda c: F.array_sort(T.token_set(c))) == [
        sorted(set(t.lower().split())) for t in texts]
    assert col_values(spark, texts, T.percent_encode) == [urllib.parse.quote(t) for t in texts]


def test_whitespace_set_is_pythons():
    assert set(T.WS_CHARS) == {chr(c) for c in range(0x110000) if chr(c).isspace()}



def test_clean_query_edge_rows(spark):
    df = spark.createDataFrame([("$ACAD under $2 today?",)], "q string")
    r = df.select(T.clean_query("q").alias("c")).first()["c"]
    assert r["cleaned"] == "acad under 2 today?" and r["window_days"] == 0
    # zero window adds no date clause
    s = df.select(T.search_string(F.lit(r["cleaned"]), F.lit(0), F.lit("after"), "2024-01-31")).first()[0]
    assert s == "acad under 2 today?"
    s = df.select(T.search_string(F.lit("x"), F.lit(7), F.lit("since"), "2024-01-31")).first()[0]
    assert s == "x since:2024-01-24"
    # tickers first (raw case) does remove them
    r2 = df.select(T.clean_query("q", tickers_first=True).alias("c")).first()["c"]
    assert r2["cleaned"] == "under 2 today?"


@pytest.mark.parametrize("text,days", [
    ("3 weeks ago and 2 days ago", 2), ("5m ago", 150), ("todays", 0), ("last week", 7),
    ("last  month", 30), ("last year", 365), ("yesterday", 1), ("2 years ago", 730), ("10 w ago", 70),
    ("99999999999999 days ago", None), ("nothing here", None), ("in 2 daysago", 2),
])
def test_time_window(spark, text, days):
    assert col_values(spark, [text], T.time_window) == [days]


def test_unicode_edges(spark):
    composed, decomposed = "café", "café"
    assert col_values(spark, [composed, decomposed, "½", "\t x "], T.clean_special) == [
        composed, "cafe", "½", "\t x "]
    assert col_values(spark, ["\t x "], T.ustrip) == ["x"]


def test_rsplit(spark):
    vals = ["a@b@positive", "no at sign", "  x @ neutral  "]
    assert col_values(spark, vals, T.rsplit_text) == ["a@b", "no at sign", "x"]
    assert col_values(spark, vals, T.rsplit_label) == ["positive", None, "neutral"]


def test_overlap_edges(spark):
    rows = [("", ""), ("a", ""), ("a b c d e", "a b c d x"), ("a b c d e f", "a b c d e z"), ("a a a b", "a b")]
    df = spark.createDataFrame(rows, "a string, b string")
    got = df.select(T.overlap_coefficient(T.token_set("a"), T.token_set("b")).alias("o"),
                    T.similarity_score(T.token_set("a"), T.token_set("b")).alias("s")).collect()
    assert [r["o"] for r in got] == [0.0, 0.0, 0.8, pytest.approx(5 / 6), 1.0]
    assert not got[2]["o"] > 0.8  # 4 of 5 shared is not a match
    assert got[3]["s"] == pytest.approx(5 / (6 + 1e-6))


def test_truncation_and_titles(spark):
    assert col_values(spark, ["x" * 1500, None], T.truncate_text) == ["x" * 1000, ""]
    assert col_values(spark, ["abc"], T.post_title) == ["abc..."]
    assert col_values(spark, ["/a", "https://b"], lambda c: T.absolutize(c, F.lit("https://site"))) == [
        "https://site/a", "https://b"]


# ---------------------------------------------------------------- labels
@pytest.mark.parametrize("raw,expected", [
    (None, "unknown"), ("", "unknown"), ("2", "positive"), ("12", "unknown"), ("0", "negative"), ("1", "neutral"),
    ("not positive but negative", "positive"), ("POSITIVE", "positive"), ("Moderately Negative", "negative"),
    ("n/a", "unknown"),
])
def test_normalize_label(spark, raw, expected):
    assert col_values(spark, [raw], L.normalize_label) == [expected]


def test_numeric_label_and_dispatch(spark):
    df = spark.createDataFrame([(0, "numeric"), (2, "numeric"), (9, "numeric"), (1, "text")], "l int, t string")
    got = [r[0] for r in df.select(L.label_dispatch(F.col("l"), F.col("t"))).collect()]
    assert got == ["negative", "positive", None, "neutral"]


@pytest.mark.parametrize("out,label", [
    ("negative or POSITIVE", "positive"), ("Neutral.", "neutral"), ("n/a", "unknown"),
    ("neutral then negative", "negative"), (None, "unknown")])
def test_parse_prediction(spark, out, label):
    assert col_values(spark, [out], L.parse_prediction) == [label]


def test_prompt_echo_and_last_segment(spark):
    df = spark.createDataFrame([("hi",)], "i string")
    p = P.infer_prompt("i")
    row = df.select(p.alias("p"), L.strip_prompt_echo(F.concat(p, F.lit(" Sentiment: x "), p), p).alias("e"),
                    L.last_segment(F.concat(p, F.lit("  positive \n"))).alias("l"),
                    L.last_segment(F.lit("no marker ")).alias("n")).first()
    assert row["p"] == "Human: hi\nAssistant:"
    assert row["e"] == "Sentiment: x"
    assert row["l"] == "positive" and row["n"] == "no marker"


# ---------------------------------------------------------------- prompts
def test_prompts(spark):
    df = spark.createDataFrame([("  text  ",)], "t string")
    r = df.select(P.instruction("t").alias("i"), P.rag_prompt(F.lit(""), F.lit("Q")).alias("r"),
                  P.train_prompt(F.lit("I"), F.lit("O")).alias("tp")).first()
    assert r["i"] == ("What is the sentiment of the financial text? Please choose an answer from "
                      "{negative/neutral/positive}:   text")
    assert r["r"] == "Context: \n\nHuman: Q\nAssistant:"
    assert r["tp"] == "Human: I\nAssistant: O"


def test_pad_truncate(spark):
    df = spark.createDataFrame([(" ".join(f"w{i}" for i in range(600)),), ("a b",)], "t string")
    rows = df.select(P.pad_truncate("t").alias("h"), P.pad_truncate("t", side="left", keep="tail").alias("t")).collect()
    long_h, long_t = rows[0]["h"], rows[0]["t"]
    assert len(long_h["tokens"]) == 512 and long_h["tokens"][0] == "w0" and long_h["n_tokens"] == 512
    assert long_t["tokens"][0] == "w88" and long_t["tokens"][-1] == "w599"
    short = rows[1]["t"]
    assert short["tokens"][-2:] == ["a", "b"] and short["tokens"][0] == P.PAD_TOKEN
    assert sum(short["attention_mask"]) == 2 and short["attention_mask"][-1] == 1
    assert rows[1]["h"]["labels"] == rows[1]["h"]["tokens"]


# ---------------------------------------------------------------- html
PAGE = ('<html><head><title>T &amp; co</title><script>var t="</p>";</script><style>p{}</style></head><body>'
        '<!-- <p>hidden</p> --><div class="article-content"><p>In scope</p></div>'
        '<p><b>Bold &amp;amp; more</b><br><p> Second </p><p class="article__body">Body &quot;x&quot;</p>'
        '<a href="/rel">Rel <i>link</i></a><a class="c" href="https://abs/x">Abs</a></body></html>')


def test_article_text_routing(spark):
    urls = ["https://seekingalpha.com/a", "https://www.marketwatch.com/a", "https://other.example/a"]
    df = spark.createDataFrame([(PAGE, u) for u in urls], "html string, url string")
    got = [r[0] for r in df.select(H.article_text("html", "url")).collect()]
    assert got[0] == "In scope"
    assert got[1] == 'Body "x"'
    assert got[2] == 'In scope Bold &amp; more Second Body "x"'
    no_p = spark.createDataFrame([("<div>none</div>", "https://seekingalpha.com/")], "html string, url string")
    assert no_p.select(H.article_text("html", "url")).first()[0] == ""


def test_scopes_follow_nesting_and_class_tokens(spark):
    pages = [
        ('<div class="article-content"><div class="ad">x</div><p>one</p><p>two</p></div><p>footer</p>', "https://seekingalpha.com/a", "one two"),
        ('<div class="article-content-related"><p>junk</p></div><div class="a article-content"><div><div><p>in</p></div></div><p>too</div><p>out</p>', "https://seekingalpha.com/a", "in too"),
        ("<div class='article-content'><p>a</p></div><p>b</p><div class=article-content><p>c</p></div>", "https://seekingalpha.com/a", "a c"),
        ('<p class="x article__body">a</p><p class="article__body-x">b</p><p class=article__body>c</p>', "https://marketwatch.com/a", "a c"),
        ('<p>plain</p><div>no scope</div>', "https://seekingalpha.com/a", "plain"),
    ]
    df = spark.createDataFrame(pages, "html string, url string, want string")
    for r in df.withColumn("got", H.article_text("html", "url")).collect():
        assert r["got"] == r["want"], r["html"]


def test_entities_match_the_standard_library(spark):
    import html as std
    texts = ["&#8217;&mdash;&euro;", "&amp;lt; &lt;b&gt; &nosuch; & &;", "&#x1F600; &#65;&#0; &hellip;x&copy", "no entity", "a & b && c", "&AMP; &notin; &#x110000;"]
    want = [std.unescape(t) if "\x00" not in t else t for t in texts]
    got = col_values(spark, texts, H.decode_entities)
    assert got[:2] == ["’—€", "&lt; <b> &nosuch; & &;"] and got[3:5] == want[3:5]
    assert got[2] == "😀 A&#0; …x&copy" and got[5] == "& ∉ &#x110000;"


def test_anchor_notations(spark):
    import html.parser as hp

    class Links(hp.HTMLParser):
        def __init__(self):
            super().__init__()
            self.found = []

        def handle_starttag(self, tag, attrs):
            if tag == "a" and dict(attrs).get("href") is not None:
                self.found.append(dict(attrs)["href"])

    page = """<a href='x'>1</a><a href="y">2</a><a class=k href=z>3</a><a data-href="no" href=/w id=1>4</a><a name="n">5</a>"""
    std = Links()
    std.feed(page)
    r = spark.createDataFrame([(page,)], "html string").select(H.anchors("html").alias("a")).first()["a"]
    assert [a["link"] for a in r] == std.found == ["x", "y", "z", "/w"] and [a["title"] for a in r] == ["1", "2", "3", "4"]


def test_title_and_links(spark):
    df = spark.createDataFrame([(PAGE,)], "html string")
    r = df.select(H.page_title("html").alias("t"), H.anchors("html").alias("a")).first()
    assert r["t"] == "T & co"
    assert [(a["pos"], a["title"], a["link"]) for a in r["a"]] == [(1, "Rel link", "/rel"), (2, "Abs", "https://abs/x")]


def test_unicode_whitespace_explicit(spark):
    assert col_values(spark, ["\t x ", " 　y "], T.ustrip) == ["x", "y"]
    assert col_values(spark, ["a  b\tc\x1c"], T.collapse_ws) == ["a b c"]
    assert col_values(spark, ["A b c"], lambda c: F.array_sort(T.token_set(c))) == [["a", "b", "c"]]


@settings(max_examples=30, deadline=None)
@given(st.lists(st.lists(st.sampled_from(["a", "B", " ", " ", " ", "　", "\x1c", "́", "$", "X"]),
                         max_size=20).map("".join), min_size=1, max_size=10))
def test_exotic_whitespace_properties(spark, texts):
    assert col_values(spark, texts, T.ustrip) == [t.strip() for t in texts]
    assert col_values(spark, texts, T.clean_query_text) == [py_clean_query(t) for t in texts]
    assert col_values(spark, texts, lambda c: F.array_sort(T.token_set(c))) == [
        sorted(set(t.lower().split())) for t in texts]


def test_time_window_takes_digits_of_any_script(spark):
    assert col_values(spark, ["５ days ago", "٣ weeks ago", "2 d ago", "x"], T.time_window) == [5, 21, 2, None]


def test_prompt_echo_parity(spark):
    from tonality.functions import labels as L
    prompt = "Context: Text: a\nSentiment: positive\n\nHuman: q\nAssistant:"
    df = spark.createDataFrame([(prompt + " negative", prompt)], "o string, p string")
    assert df.select(L.strip_prompt_echo("o", "p"), L.strip_prompt_echo("o", "p", parity=True)).first() == (
        "negative", "Context: Text: a\nSentiment: positive\n\n negative")

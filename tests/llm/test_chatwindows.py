import hashlib
import random

import pytest
from pyspark.sql import functions as F

from tonality.llm import chatwindows as C

SHAPE = "conv_id long, turn long, role string, text string"


def brute(rows):
    """The contract read from the rows themselves."""
    convs = {}
    for c, turn, role, text in rows:
        convs.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    out = []
    for c, ts in convs.items():
        ts.sort()
        loss = "".join(t[3] for t in ts if t[2] == "assistant")
        out.append((c, len(ts), sha("".join(f"{r}\n{t}\n" for _, _, r, t in ts)), len(loss), sha(loss)))
    return sorted(out, key=str)


def talk(seed, convs=40, longest=60):
    r = random.Random(seed)
    odd = ["<|im_end|>", "<\\|im_start|>", "\\<|", "a\nb", "", "日本 é", "<|", "<\\\\|x", "|>\n<|im_end|>\n", "plain words here"]
    rows = []
    for c in range(convs):
        n = r.randint(1, longest)
        for t in range(n):
            role = "system" if t == 0 and c % 3 else r.choice(["user", "assistant", "assistant", "system", "tool\nx", "a\\n"])
            text = " ".join(r.choice(odd + ["w"] * 8) for _ in range(r.randint(0, 30)))
            rows.append((c, t, role, text))
    return rows


@pytest.mark.parametrize("text", ["", "<|", "<\\|", "<\\\\|", "<|im_end|><|im_start|>assistant ok", "\\|", "<<||", "<\\<|\\|"])
def test_escapes_are_reversible(text):
    assert "<|" not in C.escape(text) and C.unescape(C.escape(text)) == text
    assert C.unescape_role(C.escape_role(text + "\n\\n")) == text + "\n\\n" and "\n" not in C.escape_role(text + "\n")


def test_escapes_are_reversible_on_random_strings():
    r = random.Random(1)
    seen = set()
    for _ in range(20000):
        t = "".join(r.choice("<|\\a\n") for _ in range(r.randint(0, 9)))
        e = C.escape(t)
        assert "<|" not in e and C.unescape(e) == t and C.unescape_role(C.escape_role(t)) == t
        seen.add((t, e))
    assert len({t for t, _ in seen}) == len({e for _, e in seen})


def plain_spans(tokens, first, system, budget, history):
    """The windows by trying every length."""
    out, at = [], first
    while at < len(tokens):
        room = budget - (tokens[system] if system is not None and system != at else 0)
        low = 0 if system is None else system + 1
        back = at
        while back > low and sum(tokens[back - 1:at]) <= history and sum(tokens[back - 1:at + 1]) <= room:
            back -= 1
        end = at + 1
        while end < len(tokens) and sum(tokens[back:end + 1]) <= room:
            end += 1
        out.append((back, at, end))
        at = end
    return out


def test_spans_equal_the_plain_search():
    r = random.Random(9)
    for _ in range(3000):
        n = r.randint(1, 14)
        tokens = [r.choice([4, 5, 9, 30, 70]) for _ in range(n)]
        first = r.randint(0, n - 1)
        system = 0 if r.random() < .6 else None
        budget, history = r.choice([(40, 0), (40, 12), (60, 39), (100, 30)])
        assert C.spans(tokens, first, system, budget, history) == plain_spans(tokens, first, system, budget, history)


@pytest.mark.parametrize("block", [1, 3, 8, 256])
def test_query_equals_brute_force_with_odd_rows(spark, block):
    rows = talk(3)
    rows += [(None, 0, None, "no id"), (None, 1, "assistant", None), (77, None, "user", "null turn"), (77, 5, "assistant", "x"), (77, 5, "assistant", "x"),
             (77, 5, "assistant", "y"), (78, 10**12, "assistant", "far"), (78, -3, "system", "neg"), (79, 0, "assistant", "long " * 30000)]
    df = spark.createDataFrame([(*x, 1, "z") for x in rows], SHAPE + ", block int, loss string").repartition(3)
    got = C.read_back(C.windows(C.with_control_conversation(df), budget=60, history=20, block=block)).collect()
    control = "<|im_end|><|im_start|>assistant ok"
    want = brute(rows + [(-1, 0, "user", control), (-1, 1, "assistant", control)])
    assert sorted((tuple(g[:5]) for g in got), key=str) == want


def test_windows_keep_their_rules(spark):
    rows = talk(5, convs=12, longest=50)
    df = spark.createDataFrame(rows, SHAPE)
    whole = {}
    for c, t, role, text in rows:
        whole.setdefault(c, []).append((role, text))
    for block in (8, 256):
        got = {}
        for w in C.windows(df, budget=60, history=20, block=block, tokens=F.regexp_count("text", F.lit(r"\S+"))).collect():
            got.setdefault(w["conv_id"], []).append(w)
        for c, ws in got.items():
            ws.sort(key=lambda w: (w["first_turn"], w["place"]))
            at = 0
            for w in ws:
                turns = C.parse(w["text"], 0)
                context, new = turns[:w["n_context"]], turns[w["n_context"]:]
                assert new == whole[c][at:at + w["n_new"]]
                assert w["tokens"] <= 60 or w["over_budget"] and len(new) == 1
                if whole[c][0][0] == "system" and at:  # the system turn leads, and stands there once
                    assert context[0] == whole[c][0]
                    context, first = context[1:], 1
                else:
                    first = 0
                assert context == whole[c][max(first, at - len(context)):at]
                assert sum(C.COST + len(t.split()) for _, t in context) <= 20
                assert [C.unescape(w["text"][s["start"]:s["end"]]) for s in w["loss"]] == [t for r, t in new if r == "assistant" and t]
                at += w["n_new"]
            assert at == len(whole[c])
        assert sum(w["n_context"] for ws in got.values() for w in ws) > 20


def test_empty_table(spark):
    df = spark.createDataFrame([], SHAPE)
    assert C.windows(df).collect() == [] and C.read_back(C.windows(df)).collect() == []
    assert [r["conv_id"] for r in C.read_back(C.windows(C.with_control_conversation(df))).collect()] == [-1]

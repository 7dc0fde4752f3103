"""DuckDB SQL for the correctness oracle.

Expression builders mirror the column functions one by one and reuse their
regex constants, and the fixture CTEs mirror :mod:`tonality.plans.fixtures`.
This is test scaffolding for ``oracle_sql()``; the engine never runs it.
"""

from __future__ import annotations

from tonality import registry as R
from tonality.functions import html as H
from tonality.functions import text as T
from tonality.plans import fixtures as FIX


def q(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


def rx_replace(x: str, pat: str, rep: str = "") -> str:
    return f"regexp_replace({x}, {q(pat)}, {q(rep)}, 'g')"


def ustrip(x): return rx_replace(x, T.STRIP_RE)
def collapse_ws(x): return ustrip(rx_replace(x, T.WS_RUN_RE, " "))
def clean_special(x): return rx_replace(x, T.SPECIAL_RE)
def r6(x): return f"round({x}, 6)"


def clean_tickers(x):
    t = rx_replace(x, T.DOLLAR_TICKER_RE)
    t = rx_replace(t, T.CAPS_WORD_RE, r"\1\2")
    return rx_replace(t, T.CAPS_WORD_RE, r"\1\2")


def clean_query_text(x):
    return collapse_ws(clean_special(clean_tickers(f"lower({x})")))


def _days(s, per_unit):
    n = f"CAST(TRY_CAST({s} AS INTEGER) AS BIGINT) * {per_unit}"
    return f"CASE WHEN {n} <= 2147483647 THEN CAST({n} AS INTEGER) END"


def time_window(t, lower=True):
    t = f"lower({t})" if lower else t
    parts = []
    for pat, per_unit, fixed in R.TIME_PATTERNS:
        p = T.time_pattern(pat)
        v = f"CAST({fixed} AS INTEGER)" if per_unit is None else _days(f"regexp_extract({t}, {q(p)}, 1)", per_unit)
        parts.append(f"WHEN regexp_matches({t}, {q(p)}) THEN {v}")
    return "CASE " + " ".join(parts) + " END"


def tokens(x): return f"list_filter(string_split_regex(lower({x}), {q(T.WS_RUN_RE)}), lambda t: t <> '')"
def token_set(x): return f"list_distinct({tokens(x)})"
def n_shared(a, b): return f"len(list_intersect({a}, {b}))"


def overlap(a, b):
    m = f"least(len({a}), len({b}))"
    return f"CASE WHEN {m} > 0 THEN {n_shared(a, b)} / {m} ELSE 0.0 END"


def similarity(a, b):
    return f"{n_shared(a, b)} / (least(len({a}), len({b})) + 1e-6)"


def normalize_label(x):
    s = f"lower(coalesce(CAST({x} AS VARCHAR), 'none'))"
    return (f"CASE WHEN contains({s}, 'positive') OR {s} = '2' THEN 'positive' "
            f"WHEN contains({s}, 'negative') OR {s} = '0' THEN 'negative' "
            f"WHEN contains({s}, 'neutral') OR {s} = '1' THEN 'neutral' ELSE 'unknown' END")


def map_numeric(x):
    cases = " ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in sorted(R.NUMERIC_LABEL_MAP.items()))
    return f"CASE CAST({x} AS VARCHAR) {cases} END"


def parse_prediction(x):
    s = f"lower(coalesce({x}, ''))"
    return (f"CASE WHEN contains({s}, 'positive') THEN 'positive' WHEN contains({s}, 'negative') THEN 'negative' "
            f"WHEN contains({s}, 'neutral') THEN 'neutral' ELSE 'unknown' END")


def instruction(x): return ustrip(f"({q(R.INSTRUCTION_PREFIX)} || {x})")
def infer_prompt(i): return f"('Human: ' || {i} || {q(chr(10) + 'Assistant:')})"
def train_prompt(i, o): return f"('Human: ' || {i} || {q(chr(10) + 'Assistant: ')} || {o})"
def context_entry(t, s): return f"('Text: ' || {t} || {q(chr(10) + 'Sentiment: ')} || {s})"
def rag_prompt(c, i): return f"('Context: ' || {c} || {q(chr(10) * 2 + 'Human: ')} || {i} || {q(chr(10) + 'Assistant:')})"


def chat_template(i, inp, o):
    s = R.CHAT_START
    return (f"({q(f'{s}system' + chr(10) + R.SYSTEM_PROMPT + chr(10) * 2 + f'{s}user' + chr(10))} || {i} || "
            f"{q(chr(10) * 2 + 'Input: ')} || {inp} || {q(chr(10) * 2 + f'{s}assistant' + chr(10))} || {o} || "
            f"{q(R.CHAT_END)})")


def percent_encode(x): return f"replace(url_encode({x}), '%2F', '/')"


def rsplit_text(x):
    s = ustrip(x)
    return ustrip(f"CASE WHEN contains({s}, '@') THEN regexp_extract({s}, {q(T.LAST_AT_RE)}, 1) ELSE {s} END")


def rsplit_label(x):
    s = ustrip(x)
    return f"CASE WHEN contains({s}, '@') THEN {ustrip(f'regexp_extract({s}, {q(T.LAST_AT_RE)}, 2)')} END"


def decode_entities(x):
    for ent, ch in R.HTML_ENTITIES:
        x = f"replace({x}, {q(ent)}, {q(ch)})"
    return x


def inner_text(x): return ustrip(decode_entities(rx_replace(x, H.TAG_RE)))


def clean_html(x): return rx_replace(rx_replace(x, H.NOISE_RE), H.P_OPEN_RE, r"</p>\1")


def paragraphs(x, pattern=H.PARA_RE):
    return f"list_transform(regexp_extract_all({clean_html(x)}, {q(pattern)}, 1), lambda p: {inner_text('p')})"


def article_text(html, limit=1000):
    return f"coalesce(substring(array_to_string({paragraphs(html)}, ' '), 1, {limit}), '')"


def fx_article_text(limit=1000):
    """Expected article text of ``fx_pages``, from the original page and what the fixture added to it."""
    inside = article_text(f"{q('<p>promo</p>')} || html0 || '</p>'", limit)
    return f"CASE WHEN source = 'Seeking Alpha' THEN {inside} WHEN source = 'MarketWatch' THEN {q(FIX.SCOPED_TEXT)} ELSE {article_text('html0', limit)} END"


LINK_SQL_RE = r'(?is)<a\s[^>]*?href\s*=\s*"([^"]*)"[^>]*>(.*?)</a\s*>'  # the given pages quote every target twice


def fx_links(group: int):
    """Expected links (1) or raw titles (2) of ``fx_pages``."""
    added = ", ".join(q(x[2 - group]) for x in FIX.ADDED_LINKS)
    return (f"regexp_extract_all({rx_replace('html0', H.NOISE_RE)}, {q(LINK_SQL_RE)}, {group}) || "
            f"CASE WHEN source = 'MarketWatch' THEN [{added}] ELSE [] END")


def page_title(html): return inner_text(f"regexp_extract({html}, {q(H.TITLE_RE)}, 1)")


def pct(n, total, d):
    s = 10 ** d
    return f"CASE WHEN {total} > 0 THEN CAST(floor(({n} * {200 * s} + {total}) / (2 * {total})) AS DOUBLE) / {float(s)} END"


def md5key(x): return f"md5('{R.SEED}:' || CAST({x} AS VARCHAR))"


def sources_values():
    rows = ", ".join(
        f"({s.order}, {q(s.name)}, CAST({s.threshold} AS DOUBLE), {q(s.date_op) if s.date_op else 'CAST(NULL AS VARCHAR)'}, "
        f"{q(s.base_url)}, {q(s.search_url)})" for s in R.SOURCES)
    return (f"(SELECT * FROM (VALUES {rows}) t(source_order, source, threshold, date_op, base_url, url_template))")


def sq_l2(a, b, dims=64):
    return (f"list_sum(list_transform(range(1, {dims} + 1), "
            f"lambda i: (CAST({a}[i] AS DOUBLE) - CAST({b}[i] AS DOUBLE)) * (CAST({a}[i] AS DOUBLE) - CAST({b}[i] AS DOUBLE))))")


# --------------------------------------------------------------------------
# fixture CTEs
# --------------------------------------------------------------------------

def _sent(t="l.toxic", qq="l.quality"):
    return f"CASE WHEN {t} = 1 THEN 'negative' WHEN {qq} = 1 THEN 'positive' ELSE 'neutral' END"


FX: dict[str, tuple[tuple[str, ...], str]] = {
    "fx_text": ((), "SELECT d.doc_id AS id, d.text, CASE WHEN d.doc_id % 11 = 0 THEN 'n/a' "
                    "WHEN l.toxic = 1 THEN 'Moderately Negative' WHEN l.quality = 1 THEN 'strong POSITIVE' "
                    "ELSE 'neutral' END AS label FROM documents d JOIN labels l ON d.doc_id = l.doc_id"),
    "fx_num": ((), "SELECT d.doc_id AS id, d.text, CASE WHEN d.doc_id % 13 = 0 THEN 9 WHEN l.toxic = 1 THEN 0 "
                   "WHEN l.quality = 1 THEN 2 ELSE 1 END AS label FROM documents d JOIN labels l ON d.doc_id = l.doc_id"),
    "fx_pred0": ((), f"SELECT l.doc_id AS id, {instruction('d.text')} AS instruction, {_sent()} AS expected_output, "
                     f"CASE WHEN l.doc_id % 7 <= 3 THEN 'Sentiment: ' || ({_sent()}) WHEN l.doc_id % 7 = 4 THEN "
                     f"'negative or POSITIVE' WHEN l.doc_id % 7 = 5 THEN 'Neutral.' ELSE 'n/a' END AS model_output "
                     f"FROM labels l JOIN documents d ON l.doc_id = d.doc_id"),
    "fx_pred": (("fx_pred0",), f"SELECT *, {infer_prompt('instruction')} || ' ' || model_output AS raw_output, "
                               f"{parse_prediction('model_output')} AS predicted_label FROM fx_pred0"),
    "fx_kb": ((), f"SELECT d.doc_id AS ctx_id, d.text, {_sent()} AS sentiment FROM documents d "
                  f"JOIN labels l ON d.doc_id = l.doc_id"),
    "fx_query": ((), f"SELECT item_id AS qid, text, {instruction('text')} AS instruction FROM benchmark"),
    "fx_vec": ((), "SELECT vec_id, embedding, ['negative', 'neutral', 'positive'][label % 3 + 1] AS sentiment "
                   "FROM embeddings"),
    "fx_rag0": (("fx_vec",), f"SELECT v.vec_id AS id, d.text, {instruction('d.text')} AS instruction, v.embedding, "
                             f"v.sentiment FROM fx_vec v JOIN documents d ON v.vec_id = d.doc_id"),
    "fx_rag": (("fx_rag0",), "SELECT *, CASE WHEN row_number() OVER (ORDER BY md5('42:' || CAST(id AS VARCHAR)), id) "
                             "<= floor(count(*) OVER () * CAST(0.8 AS DOUBLE)) THEN 'train' ELSE 'test' END AS split "
                             "FROM fx_rag0"),
    "fx_time": ((), "SELECT event_id, CASE WHEN event_id % 5 = 0 THEN "
                    "['today', 'yesterday', 'last week', 'last month', 'last year', event_type || ' flat']"
                    "[CAST(floor(event_id / 5) AS BIGINT) % 6 + 1] ELSE event_type || ' ' || CAST(user_id % 40 AS VARCHAR) "
                    "|| ' ' || ['days', 'd', 'weeks', 'w', 'months', 'm', 'years', 'y'][event_id % 8 + 1] || ' ago' END "
                    "AS phrase FROM events"),
    "fx_ticker": ((), "SELECT CAST(r_regionkey AS BIGINT) AS id, '$' || substring(r_name, 1, 4) || ' ' || r_name || "
                      "' rose #1 (x)' AS phrase FROM region"),
    "fx_pages": ((), "SELECT p.page_id, CASE WHEN s.source = 'Seeking Alpha' THEN 'https://seekingalpha.com/article/' || p.page_id "
                     "WHEN s.source = 'MarketWatch' THEN 'https://www.marketwatch.com/story/' || p.page_id ELSE p.url END AS url, "
                     f"CASE WHEN s.source = 'Seeking Alpha' THEN {q(FIX.CONTAINER_OPEN)} || p.html || {q(FIX.CONTAINER_END)} "
                     f"WHEN s.source = 'MarketWatch' THEN p.html || {q(FIX.SCOPED_PARAS)} ELSE p.html END AS html, p.html AS html0, "
                     "s.source_order, s.source, s.threshold, s.base_url "
                     f"FROM pages p JOIN {sources_values()} s ON s.source_order = p.page_id % 9 + 1"),
    "fx_lines": (("fx_kb",), "SELECT ctx_id * 2 AS line_id, replace(text, chr(10), ' ') || '@' || sentiment AS line "
                             "FROM fx_kb UNION ALL SELECT ctx_id * 2 + 1 AS line_id, ' ' || chr(9) || ' ' AS line "
                             "FROM fx_kb"),
    "fx_chat": ((), "SELECT u.conv_id, u.turn, u.text AS user_text, a.text AS assistant_text "
                    "FROM conversations u JOIN conversations a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1 "
                    "AND a.role = 'assistant' WHERE u.role = 'user'"),
    "page_titles": (("fx_pages",), f"SELECT page_id, url, source_order, source, threshold, base_url, "
                                   f"{page_title('html')} AS title FROM fx_pages"),
    "cq0": (("fx_query",), f"SELECT qid, text AS query, {clean_query_text('text')} AS cleaned_query FROM fx_query"),
    "cleaned_queries": (("cq0",), f"SELECT *, {time_window('cleaned_query', lower=False)} AS window_days FROM cq0"),
}


def with_(*names: str) -> str:
    """``WITH`` clause defining the named fixtures and their dependencies."""
    order: list[str] = []

    def visit(n):
        if n in order:
            return
        for dep in FX[n][0]:
            visit(dep)
        order.append(n)

    for n in names:
        visit(n)
    return "WITH " + ",\n".join(f"{n} AS ({FX[n][1]})" for n in order) + "\n"

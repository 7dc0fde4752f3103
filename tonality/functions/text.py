"""String, date and URL column functions (Column -> Column).

All patterns are written in the subset shared by Java regex (Spark) and RE2
(DuckDB, used as the oracle): explicit code-point classes instead of ``\\s``,
``\\w`` and ``\\b``, and ``\\A``/``\\z`` instead of ``^``/``$``. The classes
follow Python's Unicode semantics, which is what the original scripts used:

* ``WS``   — every code point for which ``str.isspace()`` is true
* ``WORD`` — letters, numbers and ``_`` (Python's ``\\w`` on ``str``)
"""

from __future__ import annotations

import sys
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

from tonality import registry as R

WS = (r"\x{9}-\x{D}\x{1C}-\x{20}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
      r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}")
WORD = r"\p{L}\p{N}_"

STRIP_RE = rf"\A[{WS}]+|[{WS}]+\z"
WS_RUN_RE = rf"[{WS}]+"
DOLLAR_TICKER_RE = r"\$[A-Z]{1,5}"
# An upper-case word of 1-5 letters with its (kept) boundary characters.
CAPS_WORD_RE = rf"(\A|[^{WORD}])[A-Z]{{1,5}}(\z|[^{WORD}])"
SPECIAL_RE = rf"[^{WORD}{WS}.,!?-]"
LAST_AT_RE = r"(?s)\A(.*)@([^@]*)\z"

INT_MAX = 2147483647

# The same whitespace set as single characters, for ``translate``.
WS_CHARS = "".join(chr(c) for c in (*range(0x9, 0xE), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680,
                                    *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000))


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def time_pattern(p: str) -> str:
    """Expand the ``[WS]`` placeholder of the fixed time patterns."""
    return p.replace("[WS]", f"[{WS}]")


# --------------------------------------------------------------------------
# whitespace
# --------------------------------------------------------------------------

def ustrip(c) -> Column:
    """``str.strip()``: remove Unicode whitespace at both ends (Spark ``trim``
    only removes spaces)."""
    return F.regexp_replace(_c(c), STRIP_RE, "")


def collapse_ws(c) -> Column:
    """Every whitespace run becomes one space, then strip."""
    return ustrip(F.regexp_replace(_c(c), WS_RUN_RE, " "))


# --------------------------------------------------------------------------
# query cleaning
# --------------------------------------------------------------------------

def clean_tickers(c) -> Column:
    """Delete ``$TICK`` symbols, then whole upper-case words of 1-5 letters.

    The word rule keeps the boundary characters it consumed; a second pass
    picks up words whose left boundary was consumed by the previous match,
    which makes the result equal to a single pass with zero-width ``\\b``.
    """
    t = F.regexp_replace(_c(c), DOLLAR_TICKER_RE, "")
    t = F.regexp_replace(t, CAPS_WORD_RE, "$1$2")
    return F.regexp_replace(t, CAPS_WORD_RE, "$1$2")


def clean_special(c) -> Column:
    """Keep word characters, whitespace and ``. , ! ? -``."""
    return F.regexp_replace(_c(c), SPECIAL_RE, "")


def _days(num: Column, per_unit: int) -> Column:
    n = num.try_cast("int").cast("bigint") * F.lit(per_unit)
    return F.when(n <= INT_MAX, n.cast("int"))


# Every decimal digit of Unicode and its ASCII digit (a number may be written in any script).
_DIGITS = [chr(c) for c in range(128, sys.maxunicode + 1) if unicodedata.category(chr(c)) == "Nd"]
DIGIT_CHARS, DIGIT_VALUES = "".join(_DIGITS), "".join(str(unicodedata.decimal(c)) for c in _DIGITS)


def time_window(c, lower: bool = True) -> Column:
    """C4: window in days from the first matching phrase, in pattern order.

    ``N days|weeks|months|years ago`` (also ``d w m y``) give N×1/7/30/365;
    ``today`` 0, ``yesterday`` 1, ``last week|month|year`` 7/30/365; a number
    that does not fit an int gives null; no phrase gives null.
    """
    t = F.lower(_c(c)) if lower else _c(c)
    t = F.translate(t, DIGIT_CHARS, DIGIT_VALUES)
    out = None
    for pat, per_unit, fixed in R.TIME_PATTERNS:
        p = time_pattern(pat)
        value = F.lit(fixed).cast("int") if per_unit is None else _days(F.regexp_extract(t, p, 1), per_unit)
        out = F.when(t.rlike(p), value) if out is None else out.when(t.rlike(p), value)
    return out


def clean_query_text(c, tickers_first: bool = False) -> Column:
    """C5 text part: lower -> tickers -> special chars -> whitespace.

    With the default order the ticker rule sees lower-cased text and never
    fires, exactly like the original; ``tickers_first=True`` runs it on the
    raw case.
    """
    t = _c(c)
    t = F.lower(clean_tickers(t)) if tickers_first else clean_tickers(F.lower(t))
    return collapse_ws(clean_special(t))


def clean_query(c, tickers_first: bool = False) -> Column:
    """struct(cleaned string, window_days int)."""
    cleaned = clean_query_text(c, tickers_first)
    return F.struct(cleaned.alias("cleaned"), time_window(cleaned, lower=False).alias("window_days"))


# --------------------------------------------------------------------------
# token sets and similarity
# --------------------------------------------------------------------------

def tokens(c, lower: bool = True) -> Column:
    """Whitespace tokens (``str.split()``), optionally lower-cased.

    Every Unicode whitespace character is first mapped to a space with
    ``translate`` (a character map, no regex), then the text is split on
    spaces and empty pieces are dropped.
    """
    t = F.lower(_c(c)) if lower else _c(c)
    t = F.translate(t, WS_CHARS, " " * len(WS_CHARS))
    return F.filter(F.split(t, " "), lambda x: x != F.lit(""))


def token_set(c) -> Column:
    """``set(text.lower().split())`` as a distinct array."""
    return F.array_distinct(tokens(c))


def token_intersection(a, b) -> Column:
    """Number of distinct shared tokens of two token-set columns."""
    return F.size(F.array_intersect(_c(a), _c(b)))


def overlap_coefficient(a, b) -> Column:
    """C7 on two token-set columns: |A∩B| / min(|A|,|B|); 0 when one is empty."""
    m = F.least(F.size(_c(a)), F.size(_c(b)))
    return F.when(m > 0, token_intersection(a, b) / m).otherwise(F.lit(0.0))


def similarity_score(a, b) -> Column:
    """C6 on two token-set columns: |A∩B| / (min(|A|,|B|) + 1e-6)."""
    m = F.least(F.size(_c(a)), F.size(_c(b)))
    return token_intersection(a, b) / (m + F.lit(1e-6))


# --------------------------------------------------------------------------
# dates and URLs
# --------------------------------------------------------------------------

def cutoff_date(window_days, as_of) -> Column:
    """``as_of - window`` as ``yyyy-MM-dd``; ``as_of`` is a parameter."""
    d = F.to_date(F.lit(as_of)) if isinstance(as_of, str) else _c(as_of)
    return F.date_format(F.date_sub(d, _c(window_days)), "yyyy-MM-dd")


def search_string(cleaned, window_days, date_op, as_of) -> Column:
    """Append `` after:DATE`` / `` since:DATE`` when the source takes a
    date and the window is positive (a zero window adds nothing)."""
    w = _c(window_days)
    op = _c(date_op)
    return F.when(w.isNotNull() & (w > 0) & op.isNotNull(),
                  F.concat(_c(cleaned), F.lit(" "), op, F.lit(":"), cutoff_date(w, as_of))
                  ).otherwise(_c(cleaned))


def percent_encode(c) -> Column:
    """``urllib.parse.quote(s)``: UTF-8 percent-encoding, ``/`` and ``-_.~``
    kept, space as ``%20`` (Spark's form encoder differs in four places)."""
    e = F.url_encode(_c(c))
    for a, b in (("+", "%20"), ("%2F", "/"), ("%7E", "~"), ("*", "%2A")):
        e = F.replace(e, F.lit(a), F.lit(b))
    return e


def search_url(template, query) -> Column:
    """C11: put the percent-encoded query into the source's URL template."""
    return F.replace(_c(template), F.lit("{q}"), percent_encode(query))


def absolutize(link, base) -> Column:
    """Links not starting with ``http`` get the source's base URL."""
    return F.when(_c(link).startswith("http"), _c(link)).otherwise(F.concat(_c(base), _c(link)))


# --------------------------------------------------------------------------
# slicing (P19-P21)
# --------------------------------------------------------------------------

def rsplit_text(c) -> Column:
    """P19 text part: everything before the last ``@``, stripped (whole
    stripped line when there is no ``@``)."""
    s = ustrip(c)
    return ustrip(F.when(s.contains("@"), F.regexp_extract(s, LAST_AT_RE, 1)).otherwise(s))


def rsplit_label(c) -> Column:
    """P19 label part: after the last ``@``, stripped; null without ``@``."""
    s = ustrip(c)
    return F.when(s.contains("@"), ustrip(F.regexp_extract(s, LAST_AT_RE, 2)))


def truncate_text(c, n: int = 1000) -> Column:
    """P20: first ``n`` code points; null becomes ``""``."""
    return F.coalesce(F.substring(_c(c), 1, n), F.lit(""))


def post_title(c, n: int = 100) -> Column:
    """First ``n`` code points plus ``...`` (always appended)."""
    return F.concat(F.substring(_c(c), 1, n), F.lit("..."))

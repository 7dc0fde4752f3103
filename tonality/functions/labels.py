"""Label normalisation and prediction parsing (Column -> Column)."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from tonality import registry as R
from tonality.functions.text import ustrip


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def normalize_label(c) -> Column:
    """Ordered substring tests on the lower-cased string form.

    contains ``positive`` or equals ``2`` -> positive; else ``negative``/``0``
    -> negative; else ``neutral``/``1`` -> neutral; else unknown. Null is read
    as the string ``none`` (unknown).
    """
    s = F.lower(F.coalesce(_c(c).cast("string"), F.lit("none")))
    return (F.when(s.contains("positive") | (s == "2"), F.lit("positive"))
            .when(s.contains("negative") | (s == "0"), F.lit("negative"))
            .when(s.contains("neutral") | (s == "1"), F.lit("neutral"))
            .otherwise(F.lit(R.UNKNOWN)))


def map_numeric_label(c, mapping: dict | None = None) -> Column:
    """Look the string form of a numeric label up in ``mapping``;
    unmapped codes give null (routed to the quarantine by the caller)."""
    mapping = mapping or R.NUMERIC_LABEL_MAP
    m = F.create_map(*[F.lit(x) for x in chain.from_iterable(sorted(mapping.items()))])
    return F.try_element_at(m, _c(c).cast("string"))


def label_dispatch(label, label_type, mapping: dict | None = None) -> Column:
    """Numeric datasets use the mapping, text datasets the normaliser."""
    return F.when(_c(label_type) == "numeric", map_numeric_label(label, mapping)).otherwise(normalize_label(label))


def parse_prediction(c) -> Column:
    """First of positive > negative > neutral found anywhere in the
    lower-cased output (priority, not position), else unknown."""
    s = F.lower(F.coalesce(_c(c), F.lit("")))
    return (F.when(s.contains("positive"), F.lit("positive"))
            .when(s.contains("negative"), F.lit("negative"))
            .when(s.contains("neutral"), F.lit("neutral"))
            .otherwise(F.lit(R.UNKNOWN)))


def last_segment(c, marker: str = "Assistant:") -> Column:
    """Text after the last ``marker`` (whole text without one), stripped."""
    return ustrip(F.substring_index(_c(c), marker, -1))


def strip_prompt_echo(output, prompt, parity: bool = False) -> Column:
    """Remove every occurrence of the prompt from the output, strip.

    With ``parity`` only the part of a retrieval prompt after its context is
    removed, as in the original, so the context's own lines stay in the output
    and can decide the parsed label."""
    p = _c(prompt)
    if parity:
        at = F.instr(p, "\n\nHuman: ")
        p = F.when(p.startswith("Context: ") & (at > 0), F.substr(p, at + 2)).otherwise(p)
    return ustrip(F.replace(_c(output), p, F.lit("")))

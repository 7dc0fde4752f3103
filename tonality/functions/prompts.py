"""Prompt rendering and fixed-length sequences (Column -> Column)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tonality import registry as R
from tonality.functions.text import WS_RUN_RE, ustrip

PAD_TOKEN = "<pad>"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def instruction(text) -> Column:
    """P5: fixed prefix + text, stripped."""
    return ustrip(F.concat(F.lit(R.INSTRUCTION_PREFIX), _c(text)))


def strip_template(instr) -> Column:
    """Remove every occurrence of the fixed prefix."""
    return F.replace(_c(instr), F.lit(R.INSTRUCTION_PREFIX), F.lit(""))


def chat_template(instr, input_text, output) -> Column:
    """System / user / assistant layout."""
    s = R.CHAT_START
    return F.concat(
        F.lit(f"{s}system\n{R.SYSTEM_PROMPT}\n\n{s}user\n"), _c(instr),
        F.lit("\n\nInput: "), _c(input_text),
        F.lit(f"\n\n{s}assistant\n"), _c(output), F.lit(R.CHAT_END))


def train_prompt(instr, output) -> Column:
    """``Human: {i}\\nAssistant: {o}``."""
    return F.concat(F.lit("Human: "), _c(instr), F.lit("\nAssistant: "), _c(output))


def infer_prompt(instr) -> Column:
    """``Human: {i}\\nAssistant:``."""
    return F.concat(F.lit("Human: "), _c(instr), F.lit("\nAssistant:"))


def context_entry(text, sentiment) -> Column:
    """One retrieved context: ``Text: {t}\\nSentiment: {s}``."""
    return F.concat(F.lit("Text: "), _c(text), F.lit("\nSentiment: "), _c(sentiment))


def rag_prompt(context, instr) -> Column:
    """P10: ``Context: {ctx}\\n\\nHuman: {i}\\nAssistant:`` (empty context kept)."""
    return F.concat(F.lit("Context: "), F.coalesce(_c(context), F.lit("")),
                    F.lit("\n\nHuman: "), _c(instr), F.lit("\nAssistant:"))


def pad_truncate(text, max_len: int = R.MAX_TOKENS, side: str = "right",
                 keep: str = "head", pad: str = PAD_TOKEN) -> Column:
    """Whitespace tokens cut to ``max_len`` and padded to exactly
    ``max_len``; struct(tokens, attention_mask, labels, n_tokens).

    ``keep='head'`` keeps the first tokens (the original behaviour),
    ``'tail'`` the last; ``side`` is where the padding goes.
    """
    toks = F.filter(F.split(_c(text), WS_RUN_RE), lambda x: x != F.lit(""))
    n_all = F.size(toks)
    if keep == "head":
        kept = F.slice(toks, 1, max_len)
    else:
        kept = F.slice(toks, F.greatest(n_all - max_len + 1, F.lit(1)), max_len)
    n = F.size(kept)
    pads = F.array_repeat(F.lit(pad), F.lit(max_len) - n)
    ones = F.array_repeat(F.lit(1), n)
    zeros = F.array_repeat(F.lit(0), F.lit(max_len) - n)
    if side == "right":
        seq, mask = F.concat(kept, pads), F.concat(ones, zeros)
    else:
        seq, mask = F.concat(pads, kept), F.concat(zeros, ones)
    return F.struct(seq.alias("tokens"), mask.alias("attention_mask"),
                    seq.alias("labels"), n.alias("n_tokens"))


def round_up(n, multiple: int = R.PAD_MULTIPLE) -> Column:
    """P23 helper: smallest multiple of ``multiple`` that is >= n."""
    return (F.ceil(_c(n) / F.lit(multiple)) * F.lit(multiple)).cast("int")

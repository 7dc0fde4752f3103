"""Article text and link extraction from already-fetched HTML.

A regex pipeline over the HTML column replaces the tree parser: scripts,
styles and comments are deleted, every ``<p`` closes the paragraph before it
(unclosed paragraphs end at the next one), paragraph bodies are pulled with
``regexp_extract_all``, tags are stripped and entities decoded. All of it is
built-in expressions, so it runs inside whole-stage code generation.
"""

from __future__ import annotations

from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from tonality import registry as R
from tonality.functions.text import ustrip

NOISE_RE = (r"(?is)<script(?:[\s/][^>]*)?>.*?</script\s*>"
            r"|<style(?:[\s/][^>]*)?>.*?</style\s*>|<!--.*?-->")
P_OPEN_RE = r"(?i)(<p(?:[\s/][^>]*)?>)"
PARA_RE = r"(?is)<p(?:[\s/][^>]*)?>(.*?)</p\s*>"
TAG_RE = r"<[^>]*>"
TITLE_RE = r"(?is)<title(?:[\s/][^>]*)?>(.*?)</title\s*>"
# groups 1-3: the target in double quotes, in single quotes, bare; group 4: the content
ANCHOR_RE = (r"""(?is)<a\s(?:[^>]*?\s)?href\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))[^>]*>(.*?)</a\s*>""")
ENTITY_RE = r"^(#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]{1,31});"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _class_attr(cls: str) -> str:
    """An attribute part of a start tag whose class list has ``cls`` as a whole token."""
    in_list = lambda quote: f"{quote}(?:[^{quote}]*\\s)?{cls}(?:\\s[^{quote}]*)?{quote}"
    return r"(?:[^>]*?\s)?class\s*=\s*(?:" + in_list('"') + "|" + in_list("'") + "|" + cls + r")(?:\s[^>]*)?>"


def class_para_re(cls: str) -> str:
    return r"(?is)<p\s" + _class_attr(cls) + r"(.*?)</p\s*>"


def container_text(c, cls: str) -> Column:
    """Content of every ``<div>`` whose class list has ``cls``, up to its own end tag.

    The page is cut before every ``<div`` and ``</div``; a fold over the pieces
    tracks the nesting depth inside a container (0: outside).
    """
    pieces = F.split(_c(c), r"(?i)(?=<div[\s/>])|(?=</div\s*>)", -1)
    opens, starts, ends = r"(?is)^<div[\s/>]", r"(?is)^<div\s" + _class_attr(cls), r"(?is)^</div\s*>"

    def step(s, x):
        depth = (F.when((s["depth"] > 0) & x.rlike(opens), s["depth"] + 1).when((s["depth"] > 0) & x.rlike(ends), s["depth"] - 1)
                 .when((s["depth"] == 0) & x.rlike(starts), F.lit(1)).otherwise(s["depth"]))
        # an unclosed paragraph ends with the container
        closed = F.when((s["depth"] == 1) & x.rlike(ends), F.lit("</p>")).otherwise(F.lit(""))
        return F.struct(depth.alias("depth"), F.concat(s["text"], F.when(depth > 0, x).otherwise(closed)).alias("text"))

    return F.aggregate(pieces, F.struct(F.lit(0).alias("depth"), F.lit("").alias("text")), step, lambda s: s["text"])


def _rare_names() -> str:
    """Every HTML 5 name that is not among the frequent ones, as one text to search: U+0001 name U+0002 characters U+0001 ..."""
    frequent = {ent[1:-1] for ent, _ in R.HTML_ENTITIES}
    return "\x01" + "\x01".join(f"{k[:-1]}\x02{v}" for k, v in html5.items() if k.endswith(";") and k[:-1] not in frequent) + "\x01"


def _named(name: Column) -> Column:
    """The characters of a reference's name: the frequent names by comparison, the others by one search; null if there is none."""
    table = F.lit(_rare_names())
    at = F.instr(table, F.concat(F.lit("\x01"), name, F.lit("\x02")))
    found = F.substring_index(F.substr(table, at + F.length(name) + 2), "\x01", 1)
    out = F.when(F.lit(False), F.lit(""))
    for ent, ch in R.HTML_ENTITIES:
        out = out.when(name == ent[1:-1], F.lit(ch))
    return out.otherwise(F.when(at > 0, found))


def decode_entities(c) -> Column:
    """Decode named (HTML 5, with semicolon) and numeric character references in one pass."""
    def one(x, i):
        name = F.regexp_extract(x, ENTITY_RE, 1)
        code = F.when(name.rlike("^#[xX]"), F.conv(F.substr(name, F.lit(3)), 16, 10)).when(name.startswith("#"), F.substr(name, F.lit(2))).cast("int")
        valid = (code > 0) & (code < 0x110000) & ~code.between(0xD800, 0xDFFF)
        char = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
        text = F.when(name.startswith("#"), F.when(valid, char)).otherwise(_named(name))
        return F.when((i == 0) | (name == "") | text.isNull(), F.concat(F.when(i == 0, "").otherwise("&"), x)).otherwise(F.concat(text, F.substr(x, F.length(name) + 2)))

    t = _c(c)
    return F.when(t.contains("&"), F.array_join(F.transform(F.split(t, "&", -1), one), "")).otherwise(t)


def inner_text(c) -> Column:
    """Tag-free, entity-decoded, stripped text of an HTML fragment."""
    return ustrip(decode_entities(F.regexp_replace(_c(c), TAG_RE, "")))


def clean_html(c) -> Column:
    """Drop script/style/comment blocks and close paragraphs before each ``<p``."""
    return F.regexp_replace(F.regexp_replace(_c(c), NOISE_RE, ""), P_OPEN_RE, "</p>$1")


def _bodies(cleaned: Column, pattern: str = PARA_RE) -> Column:
    return F.regexp_extract_all(cleaned, F.lit(pattern), 1)


def paragraphs(c, pattern: str = PARA_RE) -> Column:
    """Array of paragraph texts (C12 step)."""
    return F.transform(_bodies(clean_html(c), pattern), inner_text)


def article_text(html, url=None, limit: int = 1000) -> Column:
    """Paragraphs routed by site (scoped container, class-scoped, or
    all), falling back to all paragraphs when the scope finds none; stripped
    paragraphs joined by a space, first ``limit`` characters.

    The cleaned page and a scope's paragraphs are bound once (a one-element array), and entities are decoded
    after the choice, so neither the regexes nor the table of names stand in the plan once a branch.
    """
    def chosen(cleaned):
        out = _bodies(cleaned)
        for fragment, kind, cls in reversed(R.ARTICLE_SCOPES):
            scoped = _bodies(cleaned, class_para_re(cls)) if kind == "class" else _bodies(container_text(cleaned, cls))
            scoped = F.transform(F.array(scoped), lambda s: F.when(F.size(s) > 0, s).otherwise(_bodies(cleaned)))[0]
            out = F.when(_c(url).contains(fragment), scoped).otherwise(out)
        return out

    bodies = _bodies(clean_html(html)) if url is None else F.transform(F.array(clean_html(html)), chosen)[0]
    return F.coalesce(F.substring(F.array_join(F.transform(bodies, inner_text), " "), 1, limit), F.lit(""))


def page_title(html) -> Column:
    """``<title>`` text, tags stripped, entities decoded, stripped."""
    return inner_text(F.regexp_extract(_c(html), TITLE_RE, 1))


def anchors(html) -> Column:
    """array<struct<pos, title, link>> of all anchors with an href."""
    h = F.regexp_replace(_c(html), NOISE_RE, "")
    group = lambda k: F.regexp_extract_all(h, F.lit(ANCHOR_RE), k)
    return F.transform(F.arrays_zip(group(1).alias("a"), group(2).alias("b"), group(3).alias("c"), group(4).alias("title")),
                       lambda s, i: F.struct((i + 1).alias("pos"),
                                             inner_text(s["title"]).alias("title"),
                                             F.concat(s["a"], s["b"], s["c"]).alias("link")))

"""License scans: ordered signature rules over normalised words.

A text is lower-cased (A-Z), cut into words and joined with single spaces; every
rule is a regex over that string. One pass of a keyword automaton selects the
rules whose keyword occurs; only those run. Detections are resolved by priority:
one whose interval lies inside the interval of a detection of higher priority
(or of equal priority and greater length) is suppressed.

Defined results
  null or empty text: no words, no labels, score 0; ties between rules: table
  order; repeated rows and null ids keep their own rows; an empty table gives no
  rows. Only the id and text columns are read, so other columns may have any name.
"""

from __future__ import annotations

import re
from functools import lru_cache

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tonality.llm.license_texts import SIGNATURES

LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
WORDS = bytes(32 if b <= 0x2F or 0x3A <= b <= 0x60 or 0x7B <= b <= 0x7F else b for b in LOWER)

# The phrases and labels that every result carries.
BASE = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))

V2, V3 = r"(?: version)? ?v?2(?: 0)?", r"(?: version)? ?v?3(?: 0)?"
LIC = r" licen[cs]e"
# label; keywords of the prefilter (every spelling of the name holds one); the name as written in notices; the short identifier as words; page of the terms
LICENSES = (
    ("agpl-3.0", "agpl|affero", rf"(?:gnu )?affero general public{LIC}(?:{V3})?|(?:gnu )?agpl ?(?:v ?)?3?", r"agpl 3 0(?: only| or later)?", r"gnu org licenses agpl"),
    ("lgpl-3.0", "lgpl|lesser", rf"(?:gnu )?lesser general public{LIC}{V3}|lgpl ?v?3(?: 0)?", r"lgpl 3 0(?: only| or later)?", r"gnu org licenses lgpl 3 0"),
    ("lgpl-2.1", "lgpl|lesser", rf"(?:gnu )?lesser general public{LIC}(?: version)? ?v?2 1|lgpl ?v?2 1", r"lgpl 2 1(?: only| or later)?", r"gnu org licenses (?:old licenses )?lgpl 2 1"),
    ("lgpl-2.0", "lgpl|library general", rf"(?:gnu )?library general public{LIC}(?:{V2})?|lgpl ?v?2(?: 0)?", r"lgpl 2 0(?: only| or later)?", r"gnu org licenses old licenses lgpl 2 0"),
    ("gpl-3.0", "general public|gpl", rf"(?:gnu )?general public{LIC}{V3}|(?:gnu )?gpl ?v?3(?: 0)?", r"gpl 3 0(?: only| or later)?", r"gnu org licenses gpl 3 0"),
    ("gpl-2.0", "general public|gpl", rf"(?:gnu )?general public{LIC}{V2}|(?:gnu )?gpl ?v?2(?: 0)?", r"gpl 2 0(?: only| or later)?", r"gnu org licenses (?:old licenses )?gpl 2 0"),
    ("gfdl", "documentation licen|gfdl", rf"(?:gnu )?free documentation{LIC}", r"gfdl 1 \d(?: only| or later)?", r"gnu org licenses fdl"),
    ("apache-2.0", "apache", rf"apache(?: software)?{LIC}{V2}|apache{V2}{LIC}", r"apache 2 0", r"apache org licenses license 2 0"),
    ("apache-1.1", "apache", rf"apache(?: software)?{LIC}(?: version)? 1 1", r"apache 1 1", r"apache org licenses license 1 1"),
    ("mit", "mit licen|mit style|mit x11|x11 licen|x11 style|expat", rf"(?:mit|expat|mit x11|x11)(?: style)?{LIC}", r"mit", r"opensource org licenses mit"),
    ("mit-0", "mit no|mit 0", rf"mit no attribution{LIC}|mit 0{LIC}", r"mit 0", r"opensource org licenses mit 0"),
    ("bsd-4-clause", "bsd", rf"(?:original|4 clause|four clause) bsd{LIC}", r"bsd 4 clause", r"spdx org licenses bsd 4 clause"),
    ("bsd-3-clause", "bsd", rf"(?:new|modified|revised|3 clause|three clause) bsd{LIC}|bsd (?:3|three) clause{LIC}", r"bsd 3 clause", r"opensource org licenses bsd 3 clause"),
    ("bsd-2-clause", "bsd", rf"(?:simplified|freebsd|2 clause|two clause) bsd{LIC}|bsd (?:2|two) clause{LIC}", r"bsd 2 clause", r"opensource org licenses bsd 2 clause"),
    ("0bsd", "bsd", rf"(?:zero clause|0) ?bsd{LIC}", r"0bsd", r"opensource org licenses 0bsd"),
    ("bsd", "bsd|berkeley", rf"bsd(?: style)?{LIC}|berkeley software distribution{LIC}", r"bsd", r"linfo org bsdlicense"),
    ("mpl-2.0", "mozilla|mpl", rf"mozilla public{LIC}{V2}|mpl ?v?2(?: 0)?", r"mpl 2 0", r"mozilla org (?:en us )?mpl 2 0"),
    ("mpl-1.1", "mozilla|mpl", rf"mozilla public{LIC}(?: version)? ?v?1 1|mpl ?v?1 1", r"mpl 1 1", r"mozilla org mpl 1 1"),
    ("epl-2.0", "eclipse public", rf"eclipse public{LIC}{V2}", r"epl 2 0", r"eclipse org legal epl 2 0"),
    ("epl-1.0", "eclipse public", rf"eclipse public{LIC}(?: version)? ?v?1(?: 0)?", r"epl 1 0", r"eclipse org legal epl v10"),
    ("cddl-1.0", "cddl|common development", rf"common development and distribution{LIC}", r"cddl 1 [01]", r"opensource org licenses cddl"),
    ("cpl-1.0", "common public", rf"common public{LIC}(?: version)?(?: 1 0)?", r"cpl 1 0", r"opensource org licenses cpl1"),
    ("eupl-1.2", "eupl|european union", rf"european union public{LIC}", r"eupl 1 2", r"joinup ec europa eu eupl"),
    ("artistic-2.0", "artistic", rf"artistic{LIC}{V2}", r"artistic 2 0", r"opensource org licenses artistic 2 0"),
    ("artistic-1.0", "artistic", rf"artistic{LIC}(?: version)? ?1(?: 0)?", r"artistic 1 0", r"opensource org licenses artistic 1 0"),
    ("bsl-1.0", "boost", rf"boost software{LIC}", r"bsl 1 0", r"boost org license 1 0"),
    ("busl-1.1", "business source", rf"business source{LIC}", r"busl 1 1", r"mariadb com bsl11"),
    ("isc", "isc licen|isc licence", rf"isc{LIC}", r"isc", r"opensource org licenses isc"),
    ("zlib", "zlib licen|zlib libpng", rf"zlib(?: libpng)?{LIC}", r"zlib", r"zlib net zlib license"),
    ("unlicense", "the unlicense", r"the unlicense", r"unlicense", r"unlicense org"),
    ("wtfpl", "wtfpl|what the fuck", rf"wtfpl|do what the fuck you want to public{LIC}", r"wtfpl", r"wtfpl net"),
    ("psf-2.0", "python software|psf licen", rf"python software foundation{LIC}|psf{LIC}", r"psf 2 0|python 2 0", r"docs python org 3 license"),
    ("php-3.01", "php licen", rf"php{LIC}", r"php 3 01", r"php net license"),
    ("ruby", "ruby licen", rf"ruby{LIC}", r"ruby", r"ruby lang org en about license"),
    ("postgresql", "postgresql", rf"postgresql{LIC}", r"postgresql", r"postgresql org about licence"),
    ("openssl", "openssl", rf"openssl{LIC}", r"openssl", r"openssl org source license"),
    ("ofl-1.1", "open font", rf"(?:sil )?open font{LIC}", r"ofl 1 1", r"scripts sil org ofl"),
    ("odbl-1.0", "odbl|open database", rf"open database{LIC}", r"odbl 1 0", r"opendatacommons org licenses odbl"),
    ("odc-by-1.0", "odc|open data commons", rf"open data commons attribution{LIC}", r"odc by 1 0", r"opendatacommons org licenses by"),
    ("pddl-1.0", "pddl|public domain dedication", rf"(?:open data commons )?public domain dedication(?: and)?{LIC}", r"pddl 1 0", r"opendatacommons org licenses pddl"),
    ("cc0-1.0", "cc0|creative commons", r"cc0(?: 1 0)?(?: universal)?|creative commons zero", r"cc0 1 0", r"creativecommons org publicdomain zero"),
    ("cc-by-nc-sa", "cc by|creative commons|creativecommons", r"cc by nc sa(?: \d \d)?|creative commons attribution non ?commercial share ?alike(?: \d \d)?", r"cc by nc sa \d \d", r"creativecommons org licenses by nc sa"),
    ("cc-by-nc-nd", "cc by|creative commons|creativecommons", r"cc by nc nd(?: \d \d)?|creative commons attribution non ?commercial no ?deriv\w+(?: \d \d)?", r"cc by nc nd \d \d", r"creativecommons org licenses by nc nd"),
    ("cc-by-nc", "cc by|creative commons|creativecommons", r"cc by nc(?: \d \d)?|creative commons attribution non ?commercial(?: \d \d)?", r"cc by nc \d \d", r"creativecommons org licenses by nc"),
    ("cc-by-nd", "cc by|creative commons|creativecommons", r"cc by nd(?: \d \d)?|creative commons attribution no ?deriv\w+(?: \d \d)?", r"cc by nd \d \d", r"creativecommons org licenses by nd"),
    ("cc-by-sa", "cc by|creative commons|creativecommons", r"cc by sa(?: \d \d)?|creative commons attribution share ?alike(?: \d \d)?", r"cc by sa \d \d", r"creativecommons org licenses by sa"),
    ("cc-by", "cc by|creative commons|creativecommons", r"cc by(?: \d \d)?|creative commons attribution(?: \d \d)?", r"cc by \d \d", r"creativecommons org licenses by"),
    ("public-domain", "public domain", r"(?:placed |released )?in(?:to)? the public domain", r"public domain", r"creativecommons org publicdomain mark"),
    ("proprietary", "all rights|proprietary|confidential", r"all rights reserved|proprietary and confidential", r"licenseref proprietary", r"no license granted"),
)

# Ways to state a license, strongest first: kind, weight, regex around {id}, {name} or {url}.
GRANT = r"(?:licensed|released|distributed|published|made available|available|provided|covered)"
FORMS = (
    ("identifier", 0.99, r"spdx license identifier {id}"),
    ("grant", 0.95, GRANT + r" (?:under|by|according to)(?: the)?(?: terms(?: and conditions)? of)?(?: the)? {name}"),
    ("terms", 0.9, r"(?:under|subject to|governed by|see|accept) the (?:terms(?: and conditions)? of the )?{name}"),
    ("page", 0.85, r"(?:https? )?(?:www )?{url}(?: \w+)?"),
    ("field", 0.8, r"licen[cs]e(?: is| type| name)? {id}"),
    ("name", 0.7, r"{name}"),
)
# Weights of the signatures, which come right after identifiers; shared disclaimers come last of all.
TEXTS = {"notice": 0.97, "wording": 0.96, "disclaimer": 0.5}


class Rule:
    def __init__(self, order: int, label: str, kind: str, weight: float, pattern: str, gates: tuple):
        self.order, self.label, self.kind, self.weight, self.gates = order, label, kind, weight, gates
        self.find = re.compile(rf"(?<![^ ])(?:{pattern})(?![^ ])").finditer  # words end at a space, whatever bytes they hold


@lru_cache(maxsize=1)
def rules() -> list[Rule]:
    """Every way of stating every license, and every signature, in order of priority: by form, then by table order."""
    out = []

    def texts(*kinds: str) -> None:
        for label, kind, gate, pattern in SIGNATURES:
            if kind in kinds:
                out.append(Rule(len(out), label, kind, TEXTS[kind], pattern, (gate,)))

    for kind, weight, form in FORMS:
        if kind == "grant":
            texts("notice", "wording")
        for label, gates, name, ident, url in LICENSES:
            fill = {"id": f"(?:{ident})", "name": f"(?:{name})", "url": f"(?:{url})"}
            key = "{id}" if "{id}" in form else "{url}" if "{url}" in form else "{name}"
            need = tuple(gates.split("|"))
            if key == "{id}":
                need = ("spdx license",) if kind == "identifier" else ("license ", "licence ")
            elif key == "{url}":
                need = (url[:8],)
            out.append(Rule(len(out), label, kind, weight, form.replace(key, fill[key[1:-1]]), need))
    texts("disclaimer")
    return out


@lru_cache(maxsize=1)
def _gate():
    import ahocorasick

    by: dict[str, list[int]] = {}
    for r in rules():
        for k in r.gates:
            by.setdefault(k, []).append(r.order)
    for k, _ in BASE:
        by.setdefault(k, [])
    a = ahocorasick.Automaton()
    for k, who in by.items():
        a.add_word(k, (k, tuple(who)))
    a.make_automaton()
    return a


def normalise(text: str | None) -> str:
    """Words of a text joined by single spaces, one character a byte."""
    return b" ".join((text or "").encode("utf-8", "replace").translate(WORDS).split()).decode("latin-1")


def base_places(norm: str) -> list[tuple[int, str]]:
    """(start, label) of every base phrase standing on whole words."""
    out = []
    for phrase, label in BASE:
        at = norm.find(phrase)
        while at >= 0:
            end = at + len(phrase)
            if (at == 0 or norm[at - 1] == " ") and (end == len(norm) or norm[end] == " "):
                out.append((at, label))
            at = norm.find(phrase, at + 1)
    return sorted(out)


def detect(norm: str, may_run: set[int]) -> list[tuple[int, int, Rule]]:
    """Kept detections (start, end, rule) by place, after suppression by priority."""
    found = sorted(((m.start(), m.end(), r) for r in map(rules().__getitem__, sorted(may_run)) for m in r.find(norm)),
                   key=lambda d: (d[2].order, d[0] - d[1], d[0]))
    kept: list[tuple[int, int, Rule]] = []
    if len(found) < 50:
        for d in found:
            if not any(k[0] <= d[0] and d[1] <= k[1] for k in kept):
                kept.append(d)
        return sorted(kept, key=lambda d: d[:2])
    # Among kept intervals not inside one another, ends rise with starts: the last that starts
    # at or before a new one reaches furthest.
    from bisect import bisect_left, bisect_right

    starts: list[int] = []
    ends: list[int] = []
    for d in found:
        k = bisect_right(starts, d[0])
        if k and ends[k - 1] >= d[1]:
            continue
        kept.append(d)
        lo = bisect_left(starts, d[0])
        drop = max(lo, bisect_right(ends, d[1]))  # kept intervals inside this one need no more comparisons
        starts[lo:drop], ends[lo:drop] = [d[0]], [d[1]]
    return sorted(kept, key=lambda d: d[:2])


def scan_text(text: str | None) -> dict:
    norm = normalise(text)
    hits = [v for _, v in _gate().iter(norm)]
    out = {"n_words": norm.count(" ") + 1 if norm else 0, "n_base": 0, "first_word": None, "last_word": None, "base_labels": "", "labels": "", "score": 0.0, "found": []}
    if not hits:
        return out
    base = base_places(norm) if any(k in dict(BASE) for k, _ in hits) else []
    if base:
        word = lambda at: norm.count(" ", 0, at)
        out |= {"n_base": len(base), "first_word": word(base[0][0]), "last_word": word(base[-1][0]), "base_labels": ",".join(sorted({x for _, x in base}))}
    found = detect(norm, {i for _, who in hits for i in who})
    miss = 1.0
    for weight in [r.weight for _, _, r in found] + [0.7] * len(base):
        miss *= 1 - weight
    words = [(r.label, r.kind, r.weight, norm.count(" ", 0, a), norm.count(" ", 0, b), norm[a:b]) for a, b, r in found]
    return out | {"labels": ",".join(sorted({x for _, x in base} | {r.label for _, _, r in found})), "score": 1 - miss, "found": words}


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


DIGEST = "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double"


def scan(docs: DataFrame) -> DataFrame:
    """One row a document: word count, base places and labels, all labels, score; no shuffle."""
    def run(batches):
        import pyarrow as pa

        for b in batches:
            got = [scan_text(t.as_py()) for t in b.column(1)]
            ints = [pa.array([g[k] for g in got], pa.int64()) for k in ("n_words", "n_base", "first_word", "last_word")]
            strs = [pa.array([g[k] for g in got], pa.string()) for k in ("base_labels", "labels")]
            yield pa.RecordBatch.from_arrays([b.column(0), *ints, *strs, pa.array([g["score"] for g in got], pa.float64())],
                                             names=["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"])

    return _texts(docs).mapInArrow(run, DIGEST)


def detections(docs: DataFrame) -> DataFrame:
    """One row a kept detection: label, form, weight, its first word and last word, and the matched words."""
    def run(batches):
        import pyarrow as pa

        for b in batches:
            rows = [(i, *d) for i, t in zip(b.column(0).to_pylist(), b.column(1)) for d in scan_text(t.as_py())["found"]]
            cols = list(zip(*rows)) or [()] * 7
            kinds = (pa.int64(), pa.string(), pa.string(), pa.float64(), pa.int64(), pa.int64(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(cols, kinds)], names=["doc_id", "label", "form", "weight", "first_word", "last_word", "words"])

    return _texts(docs).mapInArrow(run, "doc_id long, label string, form string, weight double, first_word long, last_word long, words string")

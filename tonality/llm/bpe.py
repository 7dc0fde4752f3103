"""Byte-level BPE as a bounded-lookahead streaming transducer, and its streaming decoder.

Encoding rests on two facts about a merge list. A sequence of tokens is the
encoding of its bytes exactly if every token is reachable and every adjacent pair
is stable (no merge across the boundary fires before both neighbours are
complete). So the encoding of each prefix is the encoding of a shorter prefix plus
one token, and the encodings of all prefixes form a tree. Only the last
``longest`` positions can be extended; what all of them have in common is final
and is emitted at once. ``lookahead`` bounds how far behind the input that can be. Of a short word
only the part of the tree is built that leads to its end.

Defined results
  null text: as the empty text, no token, both digests of nothing; very long texts
  and very long words run in constant memory beyond the text itself; repeated rows
  and null ids keep their own rows; an empty table gives no rows. Only the id and
  text columns are read, so other columns may have any name.
"""

from __future__ import annotations

import codecs
import hashlib
import json
from array import array
from functools import lru_cache

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tonality.llm.common import hold

SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
STRETCH = 1 << 16  # characters encoded at a time
SHORT = 64  # bytes of a word whose tree is walked from the root
CACHE = 100_000  # words remembered by each of two generations (about 15 MB each when full)
PAIRS = 1 << 18  # stable pairs remembered (about 20 MB when full)
EDGES = 1 << 16  # first and last three bytes whose token lengths are remembered


def byte_letters() -> dict[str, int]:
    """Byte-level alphabet: printable Latin-1 bytes stand for themselves, the rest follow from U+0100."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class Bpe:
    def __init__(self, path: str):
        import regex

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters = byte_letters()
        raw = lambda s: bytes(letters[c] for c in s)
        self.ids = {raw(s): i for s, i in spec["model"]["vocab"].items()}
        self.bytes = {i: b for b, i in self.ids.items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.bytes |= {i: s.encode() for s, i in self.special.items()}
        merges = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        self.rank, self.parts = {}, {}
        for n, (a, b) in enumerate(merges):
            a, b = raw(a), raw(b)
            pair, whole = (self.ids[a], self.ids[b]), self.ids[a + b]
            self.rank.setdefault(pair, n)
            self.parts.setdefault(whole, (*pair, n))
        self.longest = max(map(len, self.ids))
        self.lookahead = self._lookahead()
        reached = self._reached()
        self.ids = {b: i for b, i in self.ids.items() if i in reached}
        self._ending: dict[bytes, set[int]] = {}
        self._starting: dict[bytes, set[int]] = {}
        for b in self.ids:
            self._ending.setdefault(b[-3:], set()).add(len(b))
            self._starting.setdefault(b[:3], set()).add(len(b))
        self._tails: dict[bytes, list[int]] = {}
        self._heads: dict[bytes, list[int]] = {}
        self._base = max(self.bytes) + 1
        self._stable: dict[int, bool] = {}  # by a * _base + b
        self._split = regex.compile(SPLIT)
        self._cut = regex.compile(r"(?<=\S) (?=\S)").search
        self._marks = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None
        self._young: dict[str, bytes] = {}
        self._old: dict[str, bytes] = {}

    def _lookahead(self) -> int:
        """Sufficient lookahead of the merge list, in bytes.

        A change at the right end moves a boundary further left only through a merge
        of higher rank than the one that moved the boundary to its right, and that
        merge's right part begins where the other's left part began. So the longest
        chain of merges by rising rank whose parts meet in their first two bytes,
        plus one token, bounds the reach.
        """
        two, one = {}, {}  # best chain whose left part begins with these two bytes, or is that one byte
        any2 = {}          # the best of ``two`` by first byte
        top = 0
        for (a, b), _ in sorted(self.rank.items(), key=lambda x: x[1]):
            left, right = self.bytes[a], self.bytes[b]
            past = max(two.get(right[:2], 0), one.get(right[0], 0)) if len(right) > 1 else max(any2.get(right[0], 0), one.get(right[0], 0))
            reach = past + len(left)
            top = max(top, reach)
            if len(left) > 1:
                two[left[:2]] = max(two.get(left[:2], 0), reach)
                any2[left[0]] = max(any2.get(left[0], 0), reach)
            else:
                one[left[0]] = max(one.get(left[0], 0), reach)
        return top + self.longest

    def stable(self, a: int, b: int) -> bool:
        """No merge joins a piece of ``a``'s right edge to one of ``b``'s left edge while both exist."""
        pair = a * self._base + b
        known = self._stable.get(pair)
        if known is None:
            if len(self._stable) >= PAIRS:
                self._stable.clear()
            known = self._stable[pair] = self._meet(a, b)
        return known

    def _meet(self, a: int, b: int, own: bool = False) -> bool:
        """No merge crosses between ``a`` and ``b`` before both are complete, nor after unless ``own`` allows it."""
        # Undo, latest first, the merges that made the two edge pieces; between two such
        # merges the same two pieces meet at the boundary until the later merge's rank.
        left, right, until = a, b, float("inf")
        while True:
            if self.rank.get((left, right), until) < until and not (own and (left, right) == (a, b)):
                return False
            made_l, made_r = self.parts.get(left), self.parts.get(right)
            if made_l is None and made_r is None:
                return True
            # on equal ranks the leftmost pair merges first, so the right piece's own merge comes later
            if made_r is None or made_l is not None and made_l[2] > made_r[2]:
                left, until = made_l[1], made_l[2]
            else:
                right, until = made_r[0], made_r[2] + 0.5

    def _reached(self) -> set[int]:
        """Tokens that merging their own bytes gives: both parts are, and no other merge crosses between the parts first."""
        out = {i for i, b in self.bytes.items() if len(b) == 1}
        for whole, (a, b, n) in sorted(self.parts.items(), key=lambda x: x[1][2]):
            if a in out and b in out and self.rank[a, b] == n and self._meet(a, b, own=True):
                out.add(whole)
        return out

    def _tail(self, tail: bytes) -> list[int]:
        """Lengths, longest first, of the tokens that may end in these last three bytes (fewer at a word's start)."""
        return self._sizes(self._tails, tail, [self._ending.get(k, ()) for k in (tail[-1:], tail[-2:], tail)])

    def _head(self, head: bytes) -> list[int]:
        """Lengths, longest first, of the tokens that may begin with these three bytes (fewer at a word's end)."""
        return self._sizes(self._heads, head, [self._starting.get(k, ()) for k in (head[:1], head[:2], head)])

    def _sizes(self, known: dict, edge: bytes, found: list) -> list[int]:
        if len(known) >= EDGES:
            known.clear()
        known[edge] = sorted(set().union(*found), reverse=True)
        return known[edge]

    def word(self, w: bytes):
        """Tokens of one split word, each yielded once it is final."""
        get, tails, known, longest, size, many = self.ids.get, self._tails.get, self._stable.get, self.longest, self.bytes, self._base
        base, ends, check = 0, [None], 4 * longest  # ends[k]: last token of the prefix up to base + k
        for i in range(1, len(w) + 1):
            tail = w[i - 3:i] if i > 2 else w[:i]
            for n in tails(tail) or self._tail(tail):
                if n > i - base:
                    continue
                t = get(w[i - n:i])
                if t is not None:
                    before = ends[i - n - base]
                    if before is not None:
                        ok = known(before * many + t)
                        if not (self.stable(before, t) if ok is None else ok):
                            continue
                    ends.append(t)
                    break
            if len(ends) > check:
                live = set(range(len(ends) - longest, len(ends)))
                while len(live) > 1:
                    k = max(live)
                    live.remove(k)
                    live.add(k - len(size[ends[k]]))
                k = live.pop()
                yield from self._back(ends, k)
                base, ends = base + k, ends[k:]
                check = len(ends) + 2 * longest
        yield from self._back(ends, len(ends) - 1)

    def _back(self, ends: list, k: int) -> list[int]:
        out = []
        while k > 0:
            out.append(ends[k])
            k -= len(self.bytes[ends[k]])
        return out[::-1]

    def short(self, w: bytes) -> list[int]:
        """Tokens of one split word, by the same tree walked from its root: the longest stable token first, back from dead ends.

        A prefix has one encoding, so what can follow it does not depend on how it was come to, and no prefix is entered twice in vain.
        """
        get, heads, known, many, end = self.ids.get, self._heads.get, self._stable.get, self._base, len(w)
        path, at, dead = [], 0, set()
        while at < end:
            head = w[at:at + 3]
            for n in heads(head) or self._head(head):
                to = at + n
                if to > end or to in dead:
                    continue
                t = get(w[at:to])
                if t is not None:
                    if path:
                        ok = known(path[-1] * many + t)
                        if not (self.stable(path[-1], t) if ok is None else ok):
                            continue
                    path.append(t)
                    at = to
                    break
            else:
                dead.add(at)
                at -= len(self.bytes[path.pop()])
        return path

    def _packed(self, w: str) -> bytes:
        """A word's tokens as little-endian 32-bit ids, remembered in two generations of bounded size."""
        got = self._old.get(w)
        if got is None:
            raw = w.encode()
            ids = array("I", self.short(raw) if len(raw) <= SHORT else self.word(raw))
            if ids.itemsize != 4 or array("H", [1]).tobytes()[0] != 1:
                raise RuntimeError("needs little-endian 32-bit integers")
            got = ids.tobytes()
        if len(w) <= 64:
            if len(self._young) >= CACHE:
                self._old, self._young = self._young, {}
            self._young[w] = got
        return got

    def pieces(self, text: str):
        """Packed ids of a text, a stretch of words at a time."""
        at = 0
        for m in self._marks.finditer(text) if self._marks else ():
            yield from self._plain(text[at:m.start()])
            yield self.special[m.group()].to_bytes(4, "little")
            at = m.end()
        yield from self._plain(text[at:] if at else text)

    def _plain(self, text: str):
        """Between special tokens. A single space between two others always starts a word, so stretches end there."""
        at = 0
        while at < len(text):
            cut = self._cut(text, at + STRETCH)
            to = cut.start() if cut else len(text)
            words = self._split.findall(text, at, to) if to == len(text) else self._split.findall(text[at:to])
            packed = list(map(self._young.get, words))
            if None in packed:
                packed = [p or self._packed(w) for p, w in zip(packed, words)]
            yield b"".join(packed)
            at = to

    def encode(self, text: str) -> array:
        return array("I", b"".join(self.pieces(text)))

    def forget(self) -> None:
        """Empty the caches (see ``common.hold``)."""
        for cache in (self._old, self._young, self._stable, self._tails, self._heads):
            cache.clear()


class ByteText:
    """Incremental byte-to-text machine: feeds token bytes, holds at most one unfinished character."""

    def __init__(self, tokens: dict[int, bytes]):
        self.tokens, self.state = tokens, codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, ids) -> str:
        return self.state.decode(b"".join(map(self.tokens.__getitem__, ids)))

    def end(self) -> str:
        return self.state.decode(b"", True)


@lru_cache(maxsize=2)
def load(path: str) -> Bpe:
    return Bpe(path)


def digest(bpe: Bpe, text: str | None) -> tuple[int, str, str]:
    """(tokens, SHA-256 of the ids, SHA-256 of the decoded text); ids are held for one stretch of words only."""
    n, of_ids, of_text, out = 0, hashlib.sha256(), hashlib.sha256(), ByteText(bpe.bytes)
    for packed in bpe.pieces(text or ""):
        n += len(packed) // 4
        of_ids.update(packed)
        of_text.update(out.feed(array("I", packed)).encode())
    of_text.update(out.end().encode())
    return n, of_ids.hexdigest(), of_text.hexdigest()


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def digests(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every document; no shuffle."""
    def run(batches):
        import pyarrow as pa

        bpe = load(path)
        hold("bpe", bpe.forget)
        for b in batches:
            got = [digest(bpe, t.as_py()) for t in b.column(1)]
            n, ids, texts = zip(*got) if got else ((), (), ())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(texts, pa.string())],
                                             names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return _texts(docs).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def encode(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids array<int>)."""
    def run(batches):
        import pyarrow as pa

        bpe = load(path)
        hold("bpe", bpe.forget)
        for b in batches:
            ids = [bpe.encode(t.as_py() or "").tolist() for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(ids, pa.list_(pa.int32()))], names=["doc_id", "ids"])

    return _texts(docs).mapInArrow(run, "doc_id long, ids array<int>")


def decode(tokens: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids) -> (doc_id, text); null ids decode to the empty text."""
    def run(batches):
        import pyarrow as pa

        bpe = load(path)
        for b in batches:
            texts = []
            for ids in b.column(1):
                out = ByteText(bpe.bytes)
                texts.append(out.feed(ids.as_py() or ()) + out.end())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return tokens.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")

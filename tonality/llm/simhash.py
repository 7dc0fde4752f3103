"""SimHash near-duplicates: fingerprints, pigeonhole blocks, Hamming check, components.

Defined results
  null or empty text, or text without a word: fingerprint 0, linked like any other;
  fewer words than a shingle: the whole word sequence is the one shingle;
  repeated rows and equal ids: each row keeps its own output row;
  null ids: the row is kept; its component is the smallest non-null id reachable;
  empty table: no rows. Only the id and text columns are read, so other columns
  may have any name.
"""

from __future__ import annotations

from itertools import accumulate, combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tonality.llm.common import connected_components, materialise

LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
PIECE = 1 << 15  # shingles counted at a time


def fingerprint(text: str | None, words: int = 3, seed: int = 42) -> int:
    """Unsigned 64-bit SimHash of a text's word shingles (repeats count)."""
    import numpy as np
    from xxhash import xxh64_intdigest as h

    toks = (text or "").encode("utf-8", "replace").translate(LOWER).split()
    if not toks:
        return 0
    if len(toks) < words:
        return h(b" ".join(toks), seed)
    ends = list(accumulate(toks, lambda at, t: at + 1 + len(t), initial=-1))
    s, n = b" ".join(toks), len(toks) - words + 1
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, n, PIECE):
        top = min(n, at + PIECE)
        hs = np.array([h(s[a + 1:b], seed) for a, b in zip(ends[at:top], ends[at + words:top + words])], dtype="<u8")
        ones += np.unpackbits(hs.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, words: int = 3, seed: int = 42) -> DataFrame:
    """(doc_id, fp) with the fingerprint as a signed long; no shuffle."""
    def run(batches):
        import numpy as np
        import pyarrow as pa

        for b in batches:
            fps = np.array([fingerprint(t.as_py(), words, seed) for t in b.column(1)], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps.view(np.int64))], names=["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")) \
               .mapInArrow(run, "doc_id long, fp long")


def _masks(max_bits: int, blocks: int) -> list[int]:
    """Signed masks, one for each choice of blocks that a close pair must agree on."""
    cuts = [64 * i // blocks for i in range(blocks + 1)]
    one = [((1 << (b - a)) - 1) << a for a, b in zip(cuts, cuts[1:])]
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    return [signed(sum(c)) for c in combinations(one, blocks - max_bits)]


def links(fps: DataFrame, max_bits: int = 2, blocks: int = 5, hot: int = 64) -> DataFrame:
    """All links between distinct fingerprints (column ``fp``) that differ in at most ``max_bits`` bits.

    With ``blocks`` blocks, a pair that differs in ``max_bits`` bits agrees on
    ``blocks - max_bits`` of them. Each choice of that many blocks gives a key;
    pairs of one key are verified by Hamming distance. A key with more than
    ``hot`` fingerprints is not paired off: members at two bits or fewer have a
    common neighbour at one bit or fewer from each, so grouping by the neighbours
    (at most 65 members each) yields the same links. ``max_bits`` is 0, 1 or 2.
    """
    if not 0 <= max_bits <= 2:
        raise ValueError("max_bits must be 0, 1 or 2")
    masks = _masks(max_bits, blocks)
    keyed = fps.select("fp", F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(m)) for m in masks])).alias("k", "key"))
    n = keyed.groupBy("k", "key").agg(F.count("*").alias("n")).where("n > 1")
    rows = materialise(keyed.join(n, ["k", "key"]), "simhash-blocks")
    cool = rows.where(F.col("n") <= hot).select("k", "key", "fp")
    near = lambda a, b: F.bit_count(F.col(a).bitwiseXOR(F.col(b))) <= max_bits
    pairs = (cool.withColumnRenamed("fp", "a").join(cool.withColumnRenamed("fp", "b"), ["k", "key"])
             .where((F.col("a") < F.col("b")) & near("a", "b")).select("a", "b"))
    large = rows.where(F.col("n") > hot).select("fp").distinct()
    bits = [1 << i if i < 63 else -(1 << 63) for i in range(64)]
    around = large.select("fp", F.explode(F.array(F.col("fp"), *[F.col("fp").bitwiseXOR(F.lit(b)) for b in bits])).alias("by"))
    group = around.groupBy("by").agg(F.sort_array(F.collect_set("fp")).alias("g")).where(F.size("g") > 1)
    more = (group.select(F.posexplode("g").alias("i", "a"), "g")
            .select("a", F.explode(F.expr("slice(g, i + 2, greatest(size(g) - i - 1, 0))")).alias("b")).where(near("a", "b")))
    return pairs.unionByName(more).distinct()


def near_duplicates(docs: DataFrame, words: int = 3, max_bits: int = 2, seed: int = 42) -> DataFrame:
    """(doc_id, fingerprint hex, component_id): components of documents linked by close fingerprints.

    Equal fingerprints are folded into one node before any join, so copies cost
    one row each and are never paired.
    """
    rows = materialise(fingerprints(docs, words, seed), "simhash")
    nodes = materialise(rows.groupBy("fp").agg(F.min("doc_id").alias("first")), "simhash-nodes")
    comp = connected_components(links(nodes, max_bits), "simhash-cc").withColumnRenamed("node", "fp")
    lone = nodes.join(comp, "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    first = lone.groupBy("component").agg(F.min("first").alias("component_id"))
    ids = lone.join(first, "component").select("fp", "component_id")
    return rows.join(ids, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, words: int = 3, max_bits: int = 2) -> DataFrame:
    """The documents without those whose component has a smaller id; every column stays.

    Rows of one id stay or go together; rows with a null id stay.
    """
    found = near_duplicates(docs, words, max_bits).where("doc_id is not null")
    gone = found.groupBy("doc_id").agg(F.min("component_id").alias("c")).where("c < doc_id").select(F.col("doc_id").alias("gone_id"))
    return docs.join(gone, docs["doc_id"].cast("long") == gone["gone_id"], "left_anti")

"""Line dedup: exact copies, and an edit join by segment partition, all in DataFrame functions.

A line of l characters is cut into ``edits`` + 1 even segments, which are indexed by
(l, segment number, text). A line within ``edits`` edits of it contains one of the
segments unchanged, near its place: it probes the index of every length it may
match with the substrings at those places (shift limited from the left and from
the right). Candidate pairs are verified by a banded bit-parallel edit distance:
the band's 2 x edits + 1 cells of a column are bits of one long.

Lines are compared by content, first by a 128-bit hash: copies are one entry
whatever their number. Links between different lines join them into classes; of
a class, the first line by (doc_id, line_no) is kept.

Defined results
  null or empty text: one empty line; lines of every length, empty ones too, are
  classed and counted with their exact copies; lines shorter than ``min_chars``
  have no other links and are all kept, copies too: list marks, headings and
  names stand often with good reason, and ``n_copies`` shows them; lines of rows with a null id are
  classed and counted like all others, name a class only if no other id has it, and are all kept; rows with equal ids share line places, and a place that
  is a class's first is kept in all of them; equal places with different lines
  are separate entries, and each row loses its own lines only; an empty table gives no rows. Only the id and text
  columns are read for the decision, so other columns may have any name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tonality.llm.common import connected_components, materialise

BROADCAST_ROWS = 1_000_000  # longs sent to every executor; beyond it the join shuffles


def line_hash(line: Column) -> tuple[Column, Column]:
    """128 bits of a line's content."""
    return F.xxhash64(line), F.xxhash64(F.lit("2"), line)


def lines(docs: DataFrame) -> DataFrame:
    """(doc_id, line_no, line, a, b): every line that is compared, with its 128-bit content hash."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.posexplode(F.split(text, "\n", -1)).alias("line_no", "line"))
    return rows.select("*", *(h.alias(n) for h, n in zip(line_hash(F.col("line")), "ab")))


def keys(entries: DataFrame, edits: int) -> DataFrame:
    """(key, a, indexed): keys of every line's own segments (indexed) and of its probes of other places and lengths."""
    n = edits + 1
    probes = []
    for short in range(n):  # the indexed line may be that much shorter
        for i in range(n):
            low, high = max(-i, short - (edits - i)), min(i, short + (edits - i))
            probes += [F.struct(F.lit(short).alias("short"), F.lit(i).alias("i"), F.lit(shift).alias("shift")) for shift in range(low, high + 1)]
    # four bytes a character, so that a substring is one copy wherever it starts
    rows = entries.select("a", F.encode("line", "UTF-32").alias("wide")).select("a", "wide", F.inline(F.array(*probes)))
    rows = rows.select("*", (F.shiftright(F.octet_length("wide"), 2) - F.col("short")).alias("size"))
    # the first segments are the shorter ones: the last size % n have one character more
    rows = rows.select("*", F.expr(f"cast(size div {n} as int)").alias("even"), F.expr(f"{n} - size % {n}").alias("longer"))
    rows = rows.select("*", F.expr("even + if(i >= longer, 1, 0)").alias("width"), F.expr("1 + shift + i * even + greatest(0, i - longer)").alias("at"))
    rows = rows.where("at >= 1 and width >= 1 and at + width - 1 <= size + short")
    return rows.select(F.expr("xxhash64(i, size, substring(wide, 4 * at - 3, 4 * width))").alias("key"), "a", F.expr("short = 0 and shift = 0").alias("indexed"))


def within(a: str, b: str, edits: int) -> Column:
    """Whether the strings in columns ``a`` and ``b`` (lengths at most ``edits`` apart) are within ``edits`` edits.

    Common ends are cut off first (found by bisection over prefix equality); the rest is
    compared by the bit-parallel recurrence over a band of 2 x edits + 1 diagonals, held
    in one long: bit k of column i stands for row i - edits + k.
    """
    if not 0 < edits <= 20:
        raise ValueError("edits must be from 1 to 20")
    width = 2 * edits + 1
    mask, top = (1 << width) - 1, 1 << (width - 1)

    def common(x: str, y: str, most: str, cut) -> str:
        # largest m <= most whose m first (last) characters agree
        step = f"(s, k) -> if(s + shiftleft(1, 30 - k) <= {most} and {cut(x, 's + shiftleft(1, 30 - k)')} = {cut(y, 's + shiftleft(1, 30 - k)')}, s + shiftleft(1, 30 - k), s)"
        return f"aggregate(sequence(greatest(0, 29 - length(bin({most}))), 30), 0, {step})"

    left = common(a, b, f"least(length({a}), length({b}))", lambda x, m: f"left({x}, {m})")
    strip = f"transform(array({left}), p -> struct(substring({a}, p + 1) as x, substring({b}, p + 1) as y))[0]"
    right = common("t.x", "t.y", "least(length(t.x), length(t.y))", lambda x, m: f"right({x}, {m})")
    cutoff = f"transform(array({right}), q -> struct(left(t.x, length(t.x) - q) as x, left(t.y, length(t.y) - q) as y))[0]"
    chars = "if(length(u.x) >= length(u.y), struct(split(u.x, '') as p, split(u.y, '') as t, length(u.x) as n, length(u.y) as m), struct(split(u.y, '') as p, split(u.x, '') as t, length(u.y) as n, length(u.x) as m))"
    hits = " | ".join(f"if(get(v.p, i - {edits} + {k}) = v.t[i], {1 << k}L, 0L)" for k in range(width))
    d0 = f"((((({hits}) & s.vp) + s.vp) ^ s.vp) | ({hits}) | s.vn) & {mask}L"
    # beyond this distance the last rows cannot bring it back: the rest of the walk is skipped
    step = (f"(s, i) -> if(s.dist > {2 * edits} + v.m - v.n, s, transform(array({d0}), d -> transform(array(struct((s.vn | ~(d | s.vp)) & {mask}L as hp, d & s.vp as hn)), h -> struct("
            f"(h.hn | ~(shiftright(d, 1) | h.hp)) & {mask}L as vp, shiftright(d, 1) & h.hp as vn,"
            f" if(i < v.n - {edits}, s.dist + if(d & {top}L = 0, 1, 0), s.dist + if(h.hp & s.row != 0, 1, 0) - if(h.hn & s.row != 0, 1, 0)) as dist,"
            f" if(i < v.n - {edits}, s.row, shiftright(s.row, 1)) as row))[0])[0])")
    start = f"struct({mask & ~((1 << edits) - 1)}L as vp, 0L as vn, {edits} as dist, {top >> 1}L as row)"
    walk = f"aggregate(sequence(0, v.m - 1), {start}, {step}, s -> s.dist <= {edits})"
    whole = f"transform(array({chars}), v -> if(v.n <= {edits}, true, if(v.m = 0, false, {walk})))[0]"
    return F.expr(f"transform(array({strip}), t -> transform(array({cutoff}), u -> {whole})[0])[0]")


def _sized(hashes: DataFrame) -> DataFrame:
    """A one-column frame of longs, marked for broadcast if its counted rows are few; else Spark shuffles the join."""
    return F.broadcast(hashes) if hashes.count() <= BROADCAST_ROWS else hashes


def marks(parts: Column) -> Column:
    """64 bits, each the parity of the parts that hash to it."""
    return F.aggregate(parts, F.lit(0).cast("long"), lambda s, x: s.bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(F.hash(x), F.lit(64)))))


def _alike(edits: int) -> Column:
    """Necessary for few edits: an edit changes the parity of at most three words, two characters and four pairs of neighbours."""
    differ = lambda m: F.bit_count(F.col(f"{m}1").bitwiseXOR(F.col(f"{m}2")))
    return (differ("w") <= 3 * edits) & (differ("c") <= 2 * edits) & (differ("g") <= 4 * edits)


def links(rows: DataFrame, edits: int, min_chars: int) -> DataFrame:
    """(a1, b1, a2, b2): links between different lines within ``edits`` edits, each once."""
    long = rows.where(F.length("line") >= min_chars)
    made = keys(long, edits)
    # copies of a line give equal keys, which the partial aggregation folds before the one shuffle of keys
    shared = materialise(made.groupBy("key").agg(F.max("indexed").alias("hit"), F.min("a").alias("lo"), F.max("a").alias("hi"))
                         .where("hit and lo <> hi").select("key"), "line-shared")
    hits = materialise(made.join(_sized(shared), "key", "left_semi").distinct(), "line-hits")
    need = materialise(hits.select("a").distinct(), "line-need")
    texts = long.select("a", "b", "line").join(_sized(need), "a", "left_semi").groupBy("a", "b").agg(F.first("line").alias("line"))
    neighbours = F.expr("transform(array(split(line, '')), x -> zip_with(slice(x, 1, size(x) - 1), slice(x, 2, size(x) - 1), (p, q) -> concat(p, q)))[0]")
    texts = materialise(texts.withColumn("w", marks(F.split("line", " ", -1))).withColumn("c", marks(F.split("line", ""))).withColumn("g", marks(neighbours)), "line-texts")
    marked = hits.join(texts.drop("line"), "a")
    left = marked.where("indexed").select("key", *[F.col(x).alias(x + "1") for x in "abwcg"])
    right = marked.select("key", *[F.col(x).alias(x + "2") for x in "abwcg"])
    pairs = (left.join(right, "key").where(((F.col("a1") != F.col("a2")) | (F.col("b1") != F.col("b2"))) & _alike(edits))
             .select(*[F.when(F.struct("a1", "b1") < F.struct("a2", "b2"), F.col(x)).otherwise(F.col(y)).alias(n)
                       for n, x, y in (("a1", "a1", "a2"), ("b1", "b1", "b2"), ("a2", "a2", "a1"), ("b2", "b2", "b1"))]).distinct())
    one, two = (texts.select(F.col("a").alias(f"a{k}"), F.col("b").alias(f"b{k}"), F.col("line").alias(f"t{k}")) for k in (1, 2))
    near = pairs.join(one, ["a1", "b1"]).join(two, ["a2", "b2"])
    return materialise(near.where(within("t1", "t2", edits)).select("a1", "b1", "a2", "b2"), "line-links")


def classes(docs: DataFrame, edits: int = 2, min_chars: int = 20) -> DataFrame:
    """(doc_id, line_no, class_doc_id, class_line_no, n_copies, n_links, kept) of every line.

    The class is named by its first line; n_copies counts the places of the same
    line, n_links the different lines linked to it. Lines under ``min_chars`` are
    all kept.
    """
    return _judged(docs, edits, min_chars).drop("a", "b")


def _judged(docs: DataFrame, edits: int, min_chars: int) -> DataFrame:
    """The rows of ``classes`` with the hash of their line."""
    rows = lines(docs)
    slim = materialise(rows.select("doc_id", "line_no", "a", "b", (F.length("line") >= min_chars).alias("long")), "line-places")
    near = links(rows, edits, min_chars)
    # a null id comes last
    place = F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "line_no")
    first = slim.groupBy("a", "b").agg(F.min(place).alias("first"), F.count("*").alias("n_copies"))
    ends = near.select("a1", "b1").unionByName(near.select(F.col("a2").alias("a1"), F.col("b2").alias("b1")))
    # nodes of the link graph are the first hash alone; lines that agree in it only would have to collide in 64 bits
    comp = connected_components(near.select(F.col("a1").alias("a"), F.col("a2").alias("b")), "line-cc")
    linked = (ends.groupBy("a1", "b1").agg(F.count("*").alias("n_links")).select(F.col("a1").alias("a"), F.col("b1").alias("b"), "n_links")
              .join(comp.withColumnRenamed("node", "a"), "a"))
    named = materialise(first.join(linked, ["a", "b"], "left"), "line-classes")
    of_class = named.where("component is not null").groupBy("component").agg(F.min("first").alias("class_first"))
    named = named.join(of_class, "component", "left").select("a", "b", "n_copies", F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("class_first", "first").alias("c"))
    stays = ~F.col("long") | F.col("doc_id").isNull() | (place == F.col("c"))
    return slim.join(named, ["a", "b"]).select(
        "doc_id", "line_no", F.col("c.doc_id").alias("class_doc_id"), F.col("c.line_no").alias("class_line_no"), "n_copies", "n_links", stays.alias("kept"), "a", "b")


def dedup(docs: DataFrame, edits: int = 2, min_chars: int = 20) -> DataFrame:
    """The documents with the lines taken out that ``classes`` does not keep; every row and column stays."""
    def named(line_no: Column, a: Column, b: Column) -> Column:
        return F.concat_ws(":", line_no, a, b)

    # a place and its line: another row of the same id may have another line there
    gone = (_judged(docs, edits, min_chars).where("not kept").groupBy("doc_id")
            .agg(F.collect_set(named(F.col("line_no"), F.col("a"), F.col("b"))).alias("gone")))
    gone = gone.select(F.col("doc_id").alias("gone_id"), "gone")
    out = docs.join(gone, docs["doc_id"].cast("long") == gone["gone_id"], "left")
    split = F.split(docs["text"].cast("string"), "\n", -1)
    # columns are taken from their own frame: ``docs`` may have columns of the same names
    stay = F.array_except(F.transform(split, lambda x, i: named(i, *line_hash(x))), gone["gone"])
    kept = F.array_join(F.transform(stay, lambda x: F.get(split, F.substring_index(x, ":", 1).cast("int"))), "\n")
    return out.select(*[F.when(gone["gone"].isNull(), docs["text"]).otherwise(kept).alias("text") if c == "text" else docs[c] for c in docs.columns])

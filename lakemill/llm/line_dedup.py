"""Fuzzy line dedup by MinHash.

A line is the set of its character shingles: the WIDTH characters from every character on, or
the whole of a shorter line. Its signature has the least of the shingles' hashes under FUNCTIONS
multiply-add functions. The first BANDS * ROWS make bands of ROWS values; one bit of each value makes a
sketch that goes along. Splitting, grouping, joins and components are DataFrame operations;
signatures and the exact similarity are formed on Arrow batches, as DataFrame functions alone took
over four times the processor time allowed.

Lines that share a band are first linked to the first and the one before it in the order of
their ids. Links whose sketches differ more than those of similar lines do are dropped (a line
pair at the threshold has 1 chance in 2,000 to be), the others are verified by the exact Jaccard
similarity of the shingle sets, and verified links go into distributed connected components.
Then every pair of a band that is still in two components is verified in the same way: in bands
of over CROWD lines only pairs that share one of their rarest shingles, which no similar pair
lacks. Lines of one component never meet there, so a large family that is joined already costs
its lines, not its pairs. Of each component the first line stays: the smallest document id, then position.

Equal lines have one id, a 64-bit hash, and are one line up to the components, so a line that a
third of all documents hold is counted, not compared. Texts are shuffled once: signatures and
the texts of lines with a common band come from the same exchange.

Defined cases: a null or empty text is one blank line; blank lines always stay; a very long line
is one line, whose hashes one task holds; rows that repeat id and text are one document, and of those that
repeat an id alone the order is that of a text hash; null ids come last; an empty table gives
no rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lakemill.llm.common import components, cut, fresh, stored, table

WIDTH = 7
BANDS, ROWS = 11, 4
FUNCTIONS = 64
#: Lines of a band up to which the sketches of all its pairs are compared, so at most so many for a
#: line and band; beyond, pairs are sought by their rarest shingles.
CROWD = 1024
NOT_BLANK = r"[^\x20\x09-\x0D]"
#: Bytes of lines that are hashed together, so that their hashes stay in the processor's cache.
TILE = 1 << 17
HELD = 500_000
_random = np.random.default_rng(20)
FACTORS = _random.integers(1 << 31, size=FUNCTIONS, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
OFFSETS = _random.integers(1 << 32, size=FUNCTIONS, dtype=np.uint32)


def shingle_set(line: bytes) -> set[str]:
    text = line.decode("utf-8", "replace")
    return {text[i : i + WIDTH] for i in range(max(1, len(text) - WIDTH + 1))}


class Sets:
    """Shingle sets of lines by id, with those met last kept: two generations of about HELD shingles each."""

    def __init__(self):
        self.now, self.older, self.held = {}, {}, 0

    def of(self, i: int, line: bytes) -> set[str]:
        found = self.now.get(i)
        if found is None:
            found = self.older.get(i) or shingle_set(line)
            if self.held > HELD:
                self.now, self.older, self.held = {}, self.now, 0
            self.now[i] = found
            self.held += len(found)
        return found


def shingle_hashes(lines: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """32-bit hashes of the shingles of lines that are neither empty nor hold newlines, and where those of each line start."""
    gap = b"\n" * (WIDTH - 1)
    codes = np.frombuffer((gap.join(lines) + gap).decode("utf-8", "replace").encode("utf-32-le"), "<u4")
    inside = np.pad((codes != 10).astype(np.int8), 1)
    edge = np.diff(inside)
    first, last = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    counts = np.maximum(1, last - first - (WIDTH - 1))
    h = np.zeros(len(codes) - WIDTH + 1, np.uint64)
    for i in range(WIDTH):
        h = h * np.uint64(0x9E3779B97F4A7C15) + codes[i : len(h) + i]
    h = (h ^ h >> np.uint64(32)) * np.uint64(0xD6E8FEB86659FD93)
    starts = np.cumsum(counts) - counts
    at = np.repeat(first - starts, counts) + np.arange(int(counts.sum()))
    return (h >> np.uint64(32)).astype(np.uint32)[at], starts


def signatures(lines: list[bytes]) -> np.ndarray:
    """A row of FUNCTIONS least values for each line."""
    h, starts = shingle_hashes(lines)
    out, some = np.empty((FUNCTIONS, len(lines)), np.uint32), np.empty_like(h)
    for j, (factor, offset) in enumerate(zip(FACTORS, OFFSETS, strict=True)):
        np.multiply(h, factor, out=some)
        some += offset
        out[j] = np.minimum.reduceat(some, starts)
    return out.T


def tiles(lines: list[bytes]) -> Iterator[list[bytes]]:
    own, held = [], 0
    for line in lines:
        own.append(line)
        held += len(line)
        if held >= TILE:
            yield own
            own, held = [], 0
    if own:
        yield own


def alike(a, b, similarity: float):
    """Whether sketches a and b agree in as many places as those of similar lines do, but for 1 pair in 2,000."""
    n, p = FUNCTIONS, (1 + similarity) / 2
    tail = [sum(math.comb(n, k) * p**k * (1 - p) ** (n - k) for k in range(least)) for least in range(n + 1)]
    least = max(i for i, t in enumerate(tail) if t <= 1 / 2000)
    return F.bit_count(a.bitwiseXOR(b)) <= n - least


def whole_text():
    return F.coalesce(F.col("text").cast("string"), F.lit(""))


def lines_of(docs: DataFrame) -> DataFrame:
    """(doc_id, text_key, pos, line, id) of the lines that aren't blank."""
    lines = docs.select("doc_id", F.xxhash64(whole_text()).alias("text_key"), F.posexplode(F.split(whole_text(), "\n", -1)).alias("pos", "line"))
    return lines.where(F.col("line").rlike(NOT_BLANK)).withColumn("id", F.xxhash64("line"))


def band_keys(once: DataFrame) -> DataFrame:
    """(id, key, sketch): the band keys of distinct lines (id, line)."""

    def signed(batches):
        for batch in batches:
            mins = np.concatenate([signatures(x) for x in tiles(batch.column("line").to_pylist())] or [np.zeros((0, FUNCTIONS), np.uint32)])
            sketch = np.ascontiguousarray(np.packbits((mins & 1).astype(bool), axis=1)).view("<i8").ravel()
            keys = np.tile(np.arange(BANDS, dtype=np.uint64), (len(mins), 1))
            for r in range(ROWS):
                keys = (keys + mins[:, r : BANDS * ROWS : ROWS]) * np.uint64(0xD6E8FEB86659FD93)
                keys ^= keys >> np.uint64(29)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(mins) + 1) * BANDS, pa.int32()), pa.array(keys.view(np.int64).ravel()))
            yield pa.RecordBatch.from_arrays([batch.column("id"), lists, pa.array(sketch)], ["id", "keys", "sketch"])

    rows = once.select("id", F.col("line").cast("binary").alias("line")).mapInArrow(signed, "id long, keys array<long>, sketch long")
    return rows.select("id", F.explode("keys").alias("key"), "sketch")


def bands_and_texts(lines: DataFrame, similarity: float) -> tuple[DataFrame, DataFrame]:
    """Bands of two lines or more (id, key, sketch, n, near: ids of alike lines), and the texts (id, line) of the lines to compare."""
    once = lines.groupBy("id").agg(F.first("line").alias("line"))
    order = W.partitionBy("key").orderBy("id")
    own = F.struct("id", "sketch")
    bands = band_keys(once)
    for name, x in (("before", F.lag(own)), ("after", F.lead(own)), ("first", F.first(own))):
        bands = bands.withColumn(name, x.over(order))
    bands = bands.withColumn("n", F.count("*").over(W.partitionBy("key"))).where("n > 1")
    other = lambda c: F.when((F.col("id") != F.col(f"{c}.id")) & alike(F.col("sketch"), F.col(f"{c}.sketch"), similarity), F.col(f"{c}.id"))
    near = F.array_distinct(F.array_compact(F.array(other("before"), other("first"))))
    met = (F.col("n") > 3) | (F.size("near") > 0) | other("after").isNotNull() | (F.col("before").isNull() & (F.col("n") == 3))
    of = bands.withColumn("near", near).withColumn("met", met).groupBy("id").agg(F.first("sketch").alias("sketch"), F.collect_list(F.struct("key", "n", "near")).alias("bands"), F.max("met").alias("met"))  # BANDS at most
    found = stored(of.join(once, "id").select("id", "sketch", "bands", F.when(F.col("met"), F.col("line")).alias("line")), "bands")
    return found.select("id", "sketch", F.inline("bands")), found.where("line is not null").select("id", "line")


def between_roots(rows: DataFrame, group: list[str]) -> DataFrame:
    """(a, ka, b, kb): each pair of rows (id, sketch, root) of a group that have different roots, once; those of one root never meet.

    The roots of a group are numbered. Two numbers differ first in one binary digit, below which
    they have nothing in common and above which all: rows meet on the group, that digit's place and
    what stands above it, those with a 0 on one side and those with a 1 on the other.
    """
    roots = rows.select(*group, "root").distinct()
    numbers = roots.withColumn("number", F.row_number().over(W.partitionBy(*group).orderBy("root")) - 1).withColumn("most", F.count("*").over(W.partitionBy(*group)) - 1)
    own = rows.join(numbers.where("most > 0"), [*group, "root"])
    places = F.sequence(F.lit(0), F.floor(F.log2(F.col("most"))).cast("int"))
    at = own.withColumn("place", F.explode(places)).select("*", F.expr("shiftright(number, place + 1)").alias("above"), F.expr("shiftright(number, place) & 1").alias("digit"))
    side = lambda digit, i, k: at.where(F.col("digit") == digit).select(*group, "place", "above", F.col("id").alias(i), F.col("sketch").alias(k))
    return side(0, "a", "ka").join(side(1, "b", "kb"), [*group, "place", "above"]).select("a", "ka", "b", "kb")


def apart(bands: DataFrame, texts: DataFrame, roots: DataFrame, similarity: float) -> DataFrame:
    """(a, b): the pairs of lines with a common band and different roots that can have the similarity."""
    of = W.partitionBy("key")
    own = bands.join(roots, F.col("id") == F.col("node"), "left").select("id", "key", "sketch", "n", F.coalesce("root", "id").alias("root"))
    own = stored(own.withColumn("low", F.min("root").over(of)).withColumn("high", F.max("root").over(of)).where("low <> high").drop("low", "high"), "apart")
    few = between_roots(own.where(F.col("n") <= CROWD).select("id", "key", "sketch", "root"), ["key"])
    many = own.where(F.col("n") > CROWD).drop("n")

    def in_sets(batches):
        for batch in batches:
            for i, line in zip(batch.column("id").to_pylist(), batch.column("line").to_pylist(), strict=True):
                own = shingle_set(line)
                yield pa.RecordBatch.from_arrays([pa.array([i] * len(own), pa.int64()), pa.array([len(own)] * len(own), pa.int32()), pa.array(list(own), pa.string())], ["id", "size", "t"])

    crowded = many.select("id").distinct().join(texts, "id").select("id", F.col("line").cast("binary").alias("line"))
    tokens = crowded.mapInArrow(in_sets, "id long, size int, t string")
    rarity = tokens.groupBy("t").agg(F.count("*").alias("c"))
    # similar sets share `similarity` of each, so one of the others and one more, rarest first
    wanted = (F.col("size") - F.ceil(F.col("size") * similarity - 1e-9) + 1).cast("int")
    rarest = tokens.join(rarity, "t").groupBy("id", "size").agg(F.array_sort(F.collect_list(F.struct("c", "t"))).alias("by")).select("id", F.explode(F.slice("by", 1, wanted)).alias("x"))
    keyed = many.join(rarest, "id").select("id", "key", "x.t", "sketch", "root")
    either = few.union(between_roots(keyed, ["key", "t"]))
    return either.where(alike(F.col("ka"), F.col("kb"), similarity)).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def line_classes(docs: DataFrame, similarity: float = 0.8) -> tuple[DataFrame, DataFrame]:
    """Occurrences (doc_id, text_key, pos, id) of the lines that aren't blank, and classes (node, root) of the ids that have links."""
    lines = lines_of(docs)
    bands, texts = bands_and_texts(lines, similarity)

    def similar(batches):
        sets = Sets()
        for batch in batches:
            keep = []
            for a, b, x, y in zip(*(batch.column(c).to_pylist() for c in ("a", "b", "la", "lb")), strict=True):
                own, other = sets.of(b, y), sets.of(a, x)
                both = len(own & other)
                keep.append(both + 1e-9 >= similarity * (len(own) + len(other) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    def verified(links: DataFrame) -> DataFrame:
        lines = texts.select("id", F.col("line").cast("binary").alias("line"))
        pairs = links.join(lines.toDF("a", "la"), "a").join(lines.toDF("b", "lb"), "b")
        return stored(pairs.select("a", "b", "la", "lb").mapInArrow(similar, "a long, b long"), "links")

    links = verified(bands.select(F.col("id").alias("a"), F.explode("near").alias("b")).distinct())
    roots = cut(components(links))
    more = verified(apart(bands.where("n > 3").select("id", "key", "sketch", "n"), texts, roots, similarity))
    if not more.isEmpty():
        roots = components(roots.toDF("a", "b").union(more))
    return lines.select("doc_id", "text_key", "pos", "id"), roots


def removed_lines(docs: DataFrame, similarity: float = 0.8) -> DataFrame:
    """Per document with removed lines: doc_id, text_key, removed (ascending positions, from 0, of lines that an earlier line stands for)."""
    at, roots = line_classes(docs, similarity)
    labelled = stored(at.join(roots, at.id == roots.node, "left").select("doc_id", "text_key", "pos", F.coalesce("root", "id").alias("root")), "lines")
    place = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "text_key", "pos")
    firsts = labelled.groupBy("root").agg(F.min(place).alias("kept"), F.count("*").alias("n")).where("n > 1").select("root", "kept")
    gone = labelled.join(firsts, "root").where(~place.eqNullSafe(F.col("kept")))
    return gone.groupBy("doc_id", "text_key").agg(F.array_sort(F.collect_set("pos")).alias("removed"))


def without_repeated_lines(docs: DataFrame, similarity: float = 0.8) -> DataFrame:
    """docs with one line of each component, n_chars (where docs has it) that of the new text."""
    k = fresh(docs, "gone")
    gone = removed_lines(docs, similarity).select(F.struct("doc_id", "text_key", "removed").alias(k))
    removed = F.col(f"{k}.removed")
    kept = F.array_join(F.filter(F.split("text", "\n", -1), lambda x, i: ~F.array_contains(removed, i)), "\n")
    out = docs.join(gone, F.col("doc_id").eqNullSafe(F.col(f"{k}.doc_id")) & (F.xxhash64(whole_text()) == F.col(f"{k}.text_key")), "left").withColumn("text", F.when(removed.isNull(), F.col("text")).otherwise(kept))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(dict(docs.dtypes)["n_chars"]))
    return out.select(docs.columns)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: doc_id, n_lines, n_removed, removed (positions of the removed lines)."""
    docs = table(spark, sf_dir, "documents")
    counts = docs.select("doc_id", F.xxhash64(whole_text()).alias("text_key"), F.size(F.split(whole_text(), "\n", -1)).cast("long").alias("n_lines")).distinct()
    gone = removed_lines(docs).select(F.struct("doc_id", "text_key", "removed").alias("gone"))
    removed = F.coalesce("gone.removed", F.array().cast("array<int>"))
    return counts.join(gone, F.col("doc_id").eqNullSafe(F.col("gone.doc_id")) & (F.col("text_key") == F.col("gone.text_key")), "left").select("doc_id", "n_lines", F.size(removed).cast("long").alias("n_removed"), removed.alias("removed"))

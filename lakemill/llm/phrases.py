"""Phrase collocations from a depth-truncated suffix tree over words, built by vertical partitioning.

Tasks read texts into chunks: the words of one language in order, as codes of the chunk's own
dictionary, with breaks between pieces. Dictionaries are counted over all chunks; words that are
frequent enough for a candidate are numbered by descending frequency, and runs of them whose
frequencies fill a budget are groups. Each chunk gets the numbers of its own words back by a
join, so no task holds the vocabulary. Every place where a frequent word and another stand is a
suffix of up to three words; a chunk adds up its equal suffixes and sends them to the group of
their first word. A group sorts its suffixes, which is the subtree below its prefixes cut at
depth three, and reads the counts of phrases from totals of leaves, independently of others.

A word over the budget is a group of several parts: its leaves are dealt by all three words, and
its two-word prefixes, added up in each chunk, by both words. So a word, a pair or a triple that
holds any share of the corpus is spread, one row a chunk at most for each.

Phrases with a rarer word than the threshold, or a rarer part, can't reach it, so what is pruned
by the counts of words has no effect on the result. All counts are exact.

Defined cases: a null or empty text has no words; a null language is `und`; ids aren't read, and
repeated rows count as often as they come; very long texts are whole; other columns are not read;
an empty table gives an empty result.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lakemill.llm.common import shuffle_partitions, stored, table

#: Bytes of text that a task gathers into chunks at a time (a longer document is a chunk by itself).
GATHERED = 12 << 20
#: Occurrences of first words in a group.
BUDGET = 1 << 20
#: Suffixes that a group gathers before it adds up equal ones.
HELD = 2 << 20
SPACE, BREAK = 32, 10
#: What lower-cases, what parts words and what parts pieces.
LOWERED = bytes.maketrans(bytes(range(65, 91)) + b"\t.,;:!?\x0b\x0c\r", bytes(range(97, 123)) + b" " + b"\n" * 9)
CHUNK = "chunk long, lang string, n_words long, codes binary, pos int, word string, n long"
CHUNK_FIELDS = [("chunk", pa.int64()), ("lang", pa.string()), ("n_words", pa.int64()), ("codes", pa.binary()), ("pos", pa.int32()), ("word", pa.string()), ("n", pa.int64())]


def batch_of(fields: list[tuple], values: dict, n: int) -> pa.RecordBatch:
    """A batch of n rows; fields without values are null."""
    return pa.RecordBatch.from_arrays([values[c] if isinstance(values.get(c), pa.Array) else pa.array(values[c], kind) if c in values else pa.nulls(n, kind) for c, kind in fields], [c for c, _ in fields])


def words_of(text: bytes) -> tuple[pa.Array, np.ndarray]:
    """The distinct words of a text, and their places in it as int32 codes with -1 between pieces."""
    octets = np.frombuffer(text.translate(LOWERED), np.uint8)
    inside = (octets != SPACE) & (octets != BREAK)
    edge = np.diff(inside.astype(np.int8), prepend=0, append=0)
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    if not len(starts):
        return pa.array([], pa.large_string()), np.empty(0, np.int32)
    piece = np.cumsum(octets == BREAK, dtype=np.int32)[starts]
    offsets = np.concatenate([[0], np.cumsum(ends - starts)])
    found = pa.Array.from_buffers(pa.large_string(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(octets[inside])]).dictionary_encode()
    codes = found.indices.to_numpy()
    return found.dictionary, np.insert(codes, np.flatnonzero(np.diff(piece)) + 1, -1)


def _chunks(batches):
    held: dict[str, list[bytes]] = {}
    size, number, task = 0, 0, TaskContext.get().partitionId()
    press = zstandard.ZstdCompressor(level=1)

    def flush():
        nonlocal number
        for lang, texts in held.items():
            words, codes = words_of(b"\n".join(texts))
            if not len(words):
                continue
            chunk, k = task << 32 | number, len(words)
            number += 1
            n = np.bincount(codes[codes >= 0], minlength=k)
            yield batch_of(CHUNK_FIELDS, {"chunk": np.full(k, chunk), "lang": pa.array([lang]).take(pa.array(np.zeros(k, np.int32))), "pos": np.arange(k, dtype=np.int32), "word": words.cast(pa.string()), "n": n}, k)
            yield batch_of(CHUNK_FIELDS, {"chunk": [chunk], "lang": [lang], "n_words": [int(n.sum())], "codes": [press.compress(codes.tobytes())]}, 1)
        held.clear()

    for batch in batches:
        for i in range(0, batch.num_rows, 500):
            some = batch.slice(i, 500)
            for lang, text in zip(some.column("lang").to_pylist(), some.column("text").to_pylist(), strict=True):
                held.setdefault(lang, []).append(text)
                size += len(text) + 1
                if size >= GATHERED:
                    yield from flush()
                    size = 0
    yield from flush()


def _numbered(batches):
    """Rows of a task with how many rows, and how many occurrences, come before them in it."""
    rows, seen = 0, 0
    for batch in batches:
        f = batch.column("f").to_numpy()
        ends = seen + np.cumsum(f)
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(rows + np.arange(len(f))), pa.array(ends - f)], [*batch.schema.names, "row", "start"])
        rows, seen = rows + len(f), int(ends[-1]) if len(f) else seen


def vocabulary(words: DataFrame, least: int, budget: int) -> DataFrame:
    """The words (lang, word) of at least `least` occurrences f: id (by descending f), grp (the first group) and parts of it."""
    spark = words.sparkSession
    counts = words.groupBy("lang", "word").agg(F.sum("n").alias("f")).where(F.col("f") >= least)
    order = [F.desc("f"), "lang", "word"]
    dealt = counts.repartitionByRange(shuffle_partitions(spark), *order).sortWithinPartitions(*order)
    found = stored(dealt.select("lang", "word", "f", F.spark_partition_id().alias("part")).mapInArrow(_numbered, "lang string, word string, f long, part int, row long, start long"), "vocabulary")
    parts = found.groupBy("part").agg(F.count("*").alias("m"), F.sum("f").alias("s"))
    upto = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)  # one row a part
    bases = parts.select("part", F.coalesce(F.sum("m").over(upto), F.lit(0)).alias("rows_before"), F.coalesce(F.sum("s").over(upto), F.lit(0)).alias("sum_before"))
    start = F.col("sum_before") + F.col("start")
    return found.join(F.broadcast(bases), "part").select("lang", "word", "f", (F.col("rows_before") + F.col("row")).alias("id"), F.floor(start / budget).alias("grp"), F.ceil(F.col("f") / budget).alias("parts"))


def added_up(columns: list[np.ndarray], n: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Distinct rows of columns (-1 or more) in ascending order, with the sum of their n."""
    if not len(n):
        return columns, n
    sizes = [int(c.max()) + 2 for c in columns]
    if np.prod([float(s) for s in sizes]) < 2**62:
        key = np.zeros(len(n), np.int64)
        for c, s in zip(columns, sizes, strict=True):
            key *= s
            key += c + 1
        if (n == 1).all():
            key.sort()
            first = np.flatnonzero(np.diff(key, prepend=key[0] - 1))
            key, total = key[first], np.diff(np.append(first, len(n)))
        else:
            order = np.argsort(key, kind="stable")
            key = key[order]
            first = np.flatnonzero(np.diff(key, prepend=key[0] - 1))
            key, total = key[first], np.add.reduceat(n[order], first)
        out = []
        for s in reversed(sizes):
            key, rest = np.divmod(key, s)
            out.append(rest - 1)
        return out[::-1], total
    order = np.lexsort(columns[::-1])
    columns = [c[order] for c in columns]
    new = np.ones(len(n), bool)
    new[1:] = np.any([c[1:] != c[:-1] for c in columns], axis=0)
    first = np.flatnonzero(new)
    return [c[first] for c in columns], np.add.reduceat(n[order], first)


#: Kinds of blocks: all suffixes of words within the budget; of words over it, the pairs, and the triples.
WHOLE, PAIRS, TRIPLES = range(3)
BLOCK_FIELDS = [("grp", pa.int64()), ("kind", pa.int32()), ("data", pa.binary())]


def suffixes(codes: np.ndarray, ids: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """The distinct suffixes of two or three words that start at each place, and how often they come; ids by code, -1: too rare."""
    known = np.unique(ids)
    known = known[known >= 0]
    local = np.append(np.where(ids >= 0, np.searchsorted(known, ids), -1), [-1]).astype(np.int32)  # the code -1 is a break
    at = np.append(local[codes], np.full(2, -1, np.int32))
    a, b, c = at[:-2], at[1:-1], at[2:]
    there = (a >= 0) & (b >= 0)
    rows, n = added_up([a[there], b[there], c[there]], np.ones(int(there.sum()), np.int64))
    known = np.append(known, -1)
    return [known[x] for x in rows], n


def dealt(rows: list[np.ndarray], n: np.ndarray, grp: np.ndarray, parts: np.ndarray):
    """(group, kind, rows, n) of the blocks that suffixes with their first word's group and parts are cut into."""
    mixed = lambda x: ((x * np.int64(-7046029254386353131)) >> np.int64(33)) & np.int64((1 << 31) - 1)
    a, b, c = rows
    large = parts > 1
    leaf = large & (c >= 0)
    (pa_, pb), pn = added_up([a[large], b[large]], n[large])
    own = np.searchsorted(a[large], pa_)
    with np.errstate(over="ignore"):
        kinds = [
            (WHOLE, [x[~large] for x in rows], n[~large], grp[~large]),
            (PAIRS, [pa_, pb, np.full(len(pn), -1)], pn, grp[large][own] + mixed(pb + mixed(pa_)) % parts[large][own]),
            (TRIPLES, [x[leaf] for x in rows], n[leaf], grp[leaf] + mixed(c[leaf] + mixed(b[leaf] + mixed(a[leaf]))) % parts[leaf]),
        ]
    for kind, columns, counts, key in kinds:
        order = np.argsort(key, kind="stable")
        key = key[order]
        edges = [*np.flatnonzero(np.diff(key, prepend=-1)).tolist(), len(key)]
        columns, counts = [x[order] for x in columns], counts[order]
        for i, j in zip(edges[:-1], edges[1:], strict=True):
            yield int(key[i]), kind, [x[i:j] for x in columns], counts[i:j]


def _blocks(batches):
    """Blocks of suffixes from each chunk's numbered words followed by its codes."""
    press, expand = zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()
    own: list[tuple] = []
    for batch in batches:
        ends = [*np.flatnonzero(batch.column("codes").is_valid().to_numpy(zero_copy_only=False)).tolist(), batch.num_rows]
        first = 0
        for end in ends:
            if end > first:
                own.append(tuple(batch.column(c).slice(first, end - first).to_numpy() for c in ("pos", "id", "grp", "parts")))
            first = end + 1
            if end == batch.num_rows:
                continue
            codes = np.frombuffer(expand.decompress(batch.column("codes")[end].as_py()), np.int32)
            if own:
                pos, ids, grp, parts = (np.concatenate(x) for x in zip(*own, strict=True))
                by_code = np.full(int(codes.max()) + 1, -1, np.int64)
                by_code[pos] = ids
                order = np.argsort(ids)
                ids, grp, parts = ids[order], grp[order], parts[order]
                rows, n = suffixes(codes, by_code)
                at = np.searchsorted(ids, rows[0])
                out = [(key, kind, press.compress(np.stack([*columns, counts]).tobytes())) for key, kind, columns, counts in dealt(rows, n, grp[at], parts[at])]
                if out:
                    yield batch_of(BLOCK_FIELDS, {c: [x[i] for x in out] for i, (c, _) in enumerate(BLOCK_FIELDS)}, len(out))
            own = []


NODE = "w1 long, w2 long, w3 long, a long"


def _subtrees(least: int):
    """Nodes of at least `least` occurrences from the blocks of each group, group by group."""

    def run(batches):
        expand = zstandard.ZstdDecompressor()
        key, kind, own, held = None, None, [], 0

        def leaves():
            return added_up([np.concatenate([x[i] for x in own]) for i in range(3)], np.concatenate([x[3] for x in own]))

        def nodes():
            (a, b, c), n = leaves()
            if kind != TRIPLES:
                first = np.flatnonzero((np.diff(a, prepend=-1) != 0) | (np.diff(b, prepend=-1) != 0))
                total = np.add.reduceat(n, first)
                first, total = first[total >= least], total[total >= least]
                yield pa.RecordBatch.from_arrays([pa.array(a[first]), pa.array(b[first]), pa.nulls(len(first), pa.int64()), pa.array(total)], ["w1", "w2", "w3", "a"])
            if kind != PAIRS:
                often = (c >= 0) & (n >= least)
                yield pa.RecordBatch.from_arrays([pa.array(x[often]) for x in (a, b, c, n)], ["w1", "w2", "w3", "a"])

        for batch in batches:
            for row in range(batch.num_rows):
                now = batch.column("grp")[row].as_py(), batch.column("kind")[row].as_py()
                if now != (key, kind):
                    if own:
                        yield from nodes()
                    (key, kind), own, held = now, [], 0
                block = np.frombuffer(expand.decompress(batch.column("data")[row].as_py()), np.int64).reshape(4, -1)
                own.append(list(block))
                held += block.shape[1]
                if held > HELD:
                    columns, n = leaves()
                    own, held = [[*columns, n]], len(n) // 2  # so that it is done again when the number has about doubled
        if own:
            yield from nodes()

    return run


def counted_phrases(docs: DataFrame, least: int = 10, budget: int = BUDGET) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Words (lang, word, f, id), frequent phrases (w1, w2, w3 or null, a) by those ids, and words in all (lang, n)."""
    spark = docs.sparkSession
    n = shuffle_partitions(spark)
    texts = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("text"))
    chunks = stored(texts.mapInArrow(_chunks, CHUNK), "chunks")
    words = vocabulary(chunks.where("pos is not null").select("lang", "word", "n"), least, budget)
    mine = chunks.where("pos is not null").select("chunk", "pos", "lang", "word").join(words, ["lang", "word"]).select("chunk", "pos", "id", "grp", "parts", F.lit(None).cast("binary").alias("codes"))
    whole = chunks.where("codes is not null").select("chunk", F.lit(None).cast("int").alias("pos"), *[F.lit(None).cast("long").alias(c) for c in ("id", "grp", "parts")], "codes")
    by_chunk = mine.unionByName(whole).repartition(n, "chunk").sortWithinPartitions("chunk", F.col("codes").isNotNull())
    blocks = by_chunk.mapInArrow(_blocks, "grp long, kind int, data binary").repartition(n, "grp", "kind").sortWithinPartitions("grp", "kind")
    totals = chunks.where("codes is not null").groupBy("lang").agg(F.sum("n_words").alias("n"))
    return words, stored(blocks.mapInArrow(_subtrees(least), NODE), "nodes"), totals


def _score(a: str, l: str, r: str):
    """floor(1000000 a a / (l r)), with products of up to 38 digits."""
    wide = lambda c: f"cast({c} as decimal(19,0))"
    return F.expr(f"(({wide(a)} * {wide(a)}) * cast(1000000 as decimal(7,0))) div ({wide(l)} * {wide(r)})")


def collocations(docs: DataFrame, least: int = 10, share: int = 50, top: int = 2000, budget: int = BUDGET) -> DataFrame:
    """The first `top` phrases of each language: lang, rank, phrase, a, l, r, n, score.

    A phrase of `least` or more occurrences is a candidate; one that lies in a longer candidate of
    share % or more of its occurrences is dropped.
    """
    n = shuffle_partitions(docs.sparkSession)
    words, nodes, totals = counted_phrases(docs, least, budget)
    one = words.select(F.col("id").alias("w1"), "lang", F.col("word").alias("first"), F.col("f").alias("f1"))
    two = words.select(F.col("id").alias("w2"), F.col("word").alias("second"), F.col("f").alias("f2"))
    pairs = stored(nodes.where("w3 is null").drop("w3").join(one, "w1").join(two, "w2"), "pairs")
    front = pairs.select("w1", "w2", "lang", F.concat_ws(" ", "first", "second").alias("begun"), "f1", F.col("a").alias("a12"))
    back = pairs.select(F.col("w1").alias("w2"), F.col("w2").alias("w3"), F.col("second").alias("third"), F.col("a").alias("a23"), F.col("f2").alias("f3"))
    triples = stored(nodes.where("w3 is not null").join(front, ["w1", "w2"]).join(back, ["w2", "w3"]), "triples")
    inner = triples.select("w1", "w2", "a").unionAll(triples.select("w2", "w3", "a")).groupBy("w1", "w2").agg(F.max("a").alias("longest"))
    kept = pairs.join(inner, ["w1", "w2"], "left").where(F.col("longest").isNull() | (100 * F.col("longest") < share * F.col("a")))
    columns = ["lang", "phrase", "a", "l", "r", "score"]
    short = kept.select("lang", F.concat_ws(" ", "first", "second").alias("phrase"), "a", F.col("f1").alias("l"), F.col("f2").alias("r"), _score("a", "f1", "f2").alias("score"))
    cuts = triples.withColumn("s1", _score("a", "f1", "a23")).withColumn("s2", _score("a", "a12", "f3"))
    early = F.col("s1") <= F.col("s2")
    long = cuts.select("lang", F.concat_ws(" ", "begun", "third").alias("phrase"), "a", F.when(early, F.col("f1")).otherwise(F.col("a12")).alias("l"), F.when(early, F.col("a23")).otherwise(F.col("f3")).alias("r"), F.least("s1", "s2").alias("score"))
    order = [F.desc("score"), F.desc("a"), F.col("phrase")]
    scored = short.select(columns).unionAll(long.select(columns)).withColumn("_salt", F.pmod(F.xxhash64("phrase"), F.lit(n)))
    some = scored
    for salts in (n, math.isqrt(n)):  # the last step then sees at most `top` rows of each of the root of n salts
        some = some.withColumn("_salt", F.col("_salt") % salts).withColumn("_rank", F.row_number().over(W.partitionBy("lang", "_salt").orderBy(*order))).where(F.col("_rank") <= top)
    best = some.withColumn("rank", F.row_number().over(W.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    return best.join(totals, "lang").select("lang", *[F.col(c).cast("long").alias(c) for c in ("rank",)], "phrase", *[F.col(c).cast("long").alias(c) for c in ("a", "l", "r", "n", "score")])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ORACLE = rf"""
WITH pieces AS (SELECT lang, row_number() OVER () AS p, piece FROM (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents)),
split AS (SELECT lang, p, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM (SELECT lang, p, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM pieces)),
places AS (SELECT lang, w AS w1, lead(w, 1) OVER o AS w2, lead(w, 2) OVER o AS w3 FROM split WINDOW o AS (PARTITION BY p ORDER BY i)),
counts AS (SELECT lang, 1 AS k, w1 AS phrase, count(*) AS f FROM places GROUP BY ALL
  UNION ALL SELECT lang, 2, w1 || ' ' || w2, count(*) FROM places WHERE w2 IS NOT NULL GROUP BY ALL
  UNION ALL SELECT lang, 3, w1 || ' ' || w2 || ' ' || w3, count(*) FROM places WHERE w3 IS NOT NULL GROUP BY ALL),
totals AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM counts WHERE k = 1 GROUP BY lang),
candidates AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS ws FROM counts WHERE k >= 2 AND f >= 10),
cuts AS (SELECT lang, phrase, a, c, array_to_string(ws[1:c], ' ') AS front, array_to_string(ws[c+1:], ' ') AS back FROM candidates, (VALUES (1), (2)) AS t(c) WHERE c < k),
scored AS (SELECT cuts.lang, cuts.phrase, a, c, x.f AS l, y.f AS r, CAST(1000000::HUGEINT * a * a // (x.f::HUGEINT * y.f) AS BIGINT) AS score
  FROM cuts JOIN counts x ON x.lang = cuts.lang AND x.phrase = front JOIN counts y ON y.lang = cuts.lang AND y.phrase = back),
lowest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, c) AS o FROM scored) WHERE o = 1),
longer AS (SELECT lang, part, max(a) AS longest FROM (SELECT lang, a, unnest([array_to_string(ws[1:2], ' '), array_to_string(ws[2:3], ' ')]) AS part FROM candidates WHERE k = 3) GROUP BY ALL),
kept AS (SELECT lowest.* FROM lowest LEFT JOIN longer ON longer.lang = lowest.lang AND part = phrase WHERE longest IS NULL OR 100 * longest < 50 * a),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000"""

"""SimHash near-dedup by meet-in-the-middle ball hashing.

Two fingerprints within `radius` bits share a variant that is within radius / 2 bits of both.
Every distinct fingerprint therefore emits all its variants within half the radius; the shuffle
is on the upper bits of the variant, and the task that receives them forms the rest of each
variant, so that only the variants' upper halves travel. All fingerprints that emit one variant
are within the radius of each other (triangle inequality), so linking each to the first of them
loses no connection and makes no pairs within a group; each such link is verified by counting
bits. Links are reduced to a forest in the task and go into distributed connected components.

Defined cases: a null or empty text, or one without words, has fingerprint zero, which links
like any other; very long texts are whole, their shingles hashed run by run; ties don't arise, as a
component's id is the smallest; rows with the same id are one document for `drop_near_copies`;
repeated rows are given once each; null ids are ignored by component_id unless all are null; extra
columns, whatever their names, are not read by `near_copies` and stay in `drop_near_copies`; an
empty table gives no rows.
"""

from __future__ import annotations

import itertools
import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemill.llm.common import components, cut, forest, fresh, stored, table, text_bytes, word_runs

BITS = 64
#: Variants that one task forms at a time, about.
VARIANTS = 1 << 21


def fingerprint(text: bytes, width: int = 4, seed: int = 42) -> int:
    """Bit i is 1 if it is set in over half of the XXH64 hashes of the text's word shingles."""
    ones, n, carry = np.zeros(BITS, np.int64), 0, []
    for run in word_runs(text.lower()):
        words = carry + run
        if len(words) >= width:
            line = b" ".join(words)
            ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
            starts = [0, *(ends[: len(words) - width] + 1).tolist()]
            hashes = np.array([xxhash.xxh64_intdigest(line[a:b], seed) for a, b in zip(starts, ends[width - 1 :].tolist(), strict=True)], np.uint64)
            ones += np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
            n += len(hashes)
        carry = words[-(width - 1) :]
    if not n and carry:
        return xxhash.xxh64_intdigest(b" ".join(carry), seed)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def _fingerprints(batches):
    for batch in batches:
        found = np.array([fingerprint(x) for x in batch.column("text").to_pylist()], np.uint64).view(np.int64)
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, pa.int64())], ["doc_id", "fp"])


def _flips(bits: int, offset: int, most: int) -> list[np.ndarray]:
    """For 0, 1 ... most flips: the masks that flip so many of the bits from offset on."""
    one = [1 << (offset + i) for i in range(bits)]
    return [np.array([sum(c) for c in itertools.combinations(one, k)], np.uint64) for k in range(most + 1)]


def links_below(x: np.ndarray, used: np.ndarray, bits: int, half: int, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Verified links between fingerprints x that share a variant within half flips, where used flips have gone into the bits above the lowest `bits`.

    Variants are formed about VARIANTS at a time: if there are more, those of each value of the next
    four bits are formed by themselves, so a group of any number of close fingerprints needs the
    memory of its fingerprints and of one such part.
    """
    ball = np.array([sum(math.comb(bits, k) for k in range(half - u + 1)) for u in range(half + 1)])
    if ball[used].sum() > VARIANTS and bits > 4 and len(x) > 1:
        found = []
        for v in range(16):
            more = used + np.bitwise_count((x >> np.uint64(bits - 4)) & np.uint64(15) ^ np.uint64(v))
            near = more <= half
            if near.sum() > 1:
                found.append(forest(*links_below(x[near], more[near], bits - 4, half, radius)))
        return tuple(np.concatenate([np.empty(0, np.int64), *(f[i] for f in found)]) for i in (0, 1))
    below, masks = np.uint64((1 << bits) - 1), _flips(bits, 0, half)
    variants, owner = [], []
    for u in range(half + 1):
        rows, own = np.flatnonzero(used == u), np.concatenate(masks[: half - u + 1])
        variants.append(((x[rows] & below)[:, None] ^ own[None, :]).ravel())
        owner.append(np.repeat(rows, len(own)))
    v, who = np.concatenate(variants), np.concatenate(owner)
    order = np.argsort(v)
    v, who = v[order], who[order]
    new = np.diff(v, prepend=v[:1]) != 0
    if len(new):
        new[0] = True
    lead = who[np.flatnonzero(new)[np.cumsum(new) - 1]]
    a, b = x[who[who != lead]], x[lead[who != lead]]
    near = np.bitwise_count(a ^ b) <= radius
    return a[near].view(np.int64), b[near].view(np.int64)


def variant_links(fps: DataFrame, radius: int, n: int) -> DataFrame:
    """Verified links (a, b) between fingerprints within radius bits, enough to connect all that such links connect."""
    half = radius // 2
    ball = sum(math.comb(BITS, k) for k in range(half + 1))
    upper = min(32, max(8, math.ceil(math.log2(max(1, n * ball / VARIANTS)))))
    lower = BITS - upper

    def emit(batches):
        masks = np.concatenate(_flips(upper, lower, half))
        for batch in batches:
            x = batch.column("fp").to_numpy().view(np.uint64)
            if not len(x):
                continue
            keys = ((x[:, None] ^ masks[None, :]) >> np.uint64(lower)).astype(np.int64).ravel()
            order = np.argsort(keys, kind="stable")
            keys, from_ = keys[order], np.repeat(x, len(masks))[order]
            first = np.flatnonzero(np.diff(keys, prepend=-1))
            ends = [*first[1:].tolist(), len(keys)]
            yield pa.RecordBatch.from_arrays([pa.array(keys[first], pa.int64()), pa.array([from_[a:b].astype("<u8").tobytes() for a, b in zip(first.tolist(), ends, strict=True)], pa.binary())], ["upper", "fps"])

    def meet(key, group):
        x = np.unique(np.frombuffer(b"".join(group.column("fps").to_pylist()), "<u8").astype(np.uint64))
        top = np.uint64(key[0].as_py()) << np.uint64(lower)
        used = np.bitwise_count((x ^ top) >> np.uint64(lower)).astype(int)
        a, b = forest(*links_below(x, used, lower, half, radius))
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    sent = fps.select("fp").mapInArrow(emit, "upper long, fps binary")
    return sent.groupBy("upper").applyInArrow(meet, "a long, b long")


def near_copies(docs: DataFrame, radius: int = 4) -> DataFrame:
    """Per row: doc_id, fp (fingerprint as a signed long), component_id (smallest doc_id that links reach)."""
    rows = stored(docs.select("doc_id", text_bytes().alias("text")).mapInArrow(_fingerprints, "doc_id long, fp long"), "fingerprints")
    fps = cut(rows.groupBy("fp").agg(F.min("doc_id").alias("least")))
    roots = components(variant_links(fps, radius, fps.count()))
    labelled = fps.join(roots, fps.fp == roots.node, "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    best = labelled.groupBy("root").agg(F.min("least").alias("component_id"))
    label = labelled.join(best, "root").select("fp", "component_id")
    return rows.join(label, "fp").select("doc_id", "fp", "component_id")


def drop_near_copies(docs: DataFrame, radius: int = 4) -> DataFrame:
    """docs with one document, that of the smallest id, for each group of linked fingerprints."""
    k = fresh(docs, "kept")
    kept = near_copies(docs, radius).where(F.col("doc_id").eqNullSafe(F.col("component_id"))).select(F.struct("doc_id").alias(k)).distinct()
    return docs.join(kept, F.col("doc_id").eqNullSafe(F.col(f"{k}.doc_id")), "left_semi")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_copies(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")

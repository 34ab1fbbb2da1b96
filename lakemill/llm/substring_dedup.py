"""Substring dedup: a depth-limited radix sort of all byte windows, distributed.

Every window of `window` bytes is ordered by most-significant digits, and only through its own
length. The first digit is the window's least-hashed substring of DIGIT bytes (its anchor),
which equal windows share at the same place; it decides which task orders the window. Groups
that hold one document leave after this digit: of most text only 6 bytes an anchor have
travelled. For the rest the bytes around the anchor follow, once for each distinct context and
block of documents, and the further digits, 8 bytes each, are sorted pass by pass; a group with
one row left is finished, and groups that are still together at full depth are exactly the
repeated windows. Each block of documents then hears which of its windows start in a document
with a smaller id, and removes the bytes that they cover.

Documents are dealt into blocks by a hash of the id. Keys and contexts are made distinct within
a block before they are sent, so a passage that a third of all documents share arrives once a
block, not once a document; the answer to a block is one bit a window, as a block needs only to
know whether a smaller id than its own least exists elsewhere.

Defined cases: a null or empty text has no bytes; texts shorter than a window lose nothing; rows
that repeat an id don't remove each other's bytes; a null id counts as larger than all others;
an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemill.llm.common import shuffle_partitions, table, text_bytes

WINDOW = 50
DIGIT = 24
TILE = 1 << 17
BASE = 0x9E3779B97F4A7C15
LAST = np.iinfo(np.int64).max
RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"


def _mixed(h: np.ndarray, factor: int) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(factor)
    return h ^ (h >> np.uint64(29))


def _digit_hashes(octets: np.ndarray) -> np.ndarray:
    """A hash of the DIGIT bytes from each place on."""
    h = {1: octets.astype(np.uint64) + np.uint64(1)}
    for k in (1, 2, 4, 8):
        h[2 * k] = h[k][:-k] * np.uint64(pow(BASE, k, 1 << 64)) + h[k][k:]
    long = h[16][: len(h[8]) - 16] * np.uint64(pow(BASE, 8, 1 << 64)) + h[8][16:]
    return np.clip(_mixed(long, 0xD6E8FEB86659FD93), 1, np.uint64(2**64 - 2))


def _extreme(h: np.ndarray, width: int, pick) -> np.ndarray:
    """pick (np.minimum or np.maximum) over each `width` consecutive values."""
    done = 1
    while 2 * done <= width:
        h = pick(h[:-done], h[done:])
        done *= 2
    return pick(h[: len(h) - (width - done)], h[width - done :]) if done < width else h


class Block:
    """The texts of a block end to end, with their anchors."""

    def __init__(self, doc_ids: list, texts: list[bytes], window: int):
        self.window, self.span = window, window - DIGIT
        self.data = np.frombuffer(b"".join(texts), np.uint8)
        self.lengths = np.array([len(x) for x in texts], np.int64)
        self.ends = np.cumsum(self.lengths)
        self.starts = self.ends - self.lengths
        self.ids = np.array([LAST if x is None else x for x in doc_ids], np.int64)
        found = [self._tile(s, min(len(self.data), s + TILE)) for s in range(0, len(self.data), TILE)]
        self.pos = np.concatenate([p for p, _ in found]) if found else np.zeros(0, np.int64)
        self.keys = np.concatenate([k for _, k in found]) if found else np.zeros(0, np.uint64)
        self.doc = np.searchsorted(self.ends, self.pos, side="right")

    def _tile(self, s: int, e: int) -> tuple[np.ndarray, np.ndarray]:
        span, lo = self.span, max(0, s - self.span)
        hi = min(len(self.data), e + span)
        octets = self.data[lo : hi + DIGIT - 1]
        octets = np.pad(octets, (0, hi - lo + DIGIT - 1 - len(octets)))
        h = _digit_hashes(octets)
        first, last = np.searchsorted(self.ends, lo, side="right"), np.searchsorted(self.starts, hi, side="left")
        a, b = np.maximum(self.starts[first:last], lo), np.minimum(self.ends[first:last], hi)
        room = np.repeat(self.ends[first:last], np.maximum(b - a, 0)) - np.arange(lo, hi)
        h[room < DIGIT] = 2**64 - 1
        least = _extreme(np.pad(h, (0, span), constant_values=2**64 - 1), span + 1, np.minimum)
        least[room < self.window] = 0
        chosen = (_extreme(np.pad(least, (span, 0)), span + 1, np.maximum) == h) & (room >= DIGIT)
        at = np.flatnonzero(chosen[s - lo : e - lo]) + (s - lo)
        return at + lo, _mixed(h[at], 0xA24BAED4963EE407)

    def shared_here(self) -> tuple[np.ndarray, np.ndarray]:
        """The distinct keys, ascending, and whether two ids of the block have them."""
        order = np.argsort(self.keys, kind="stable")
        keys, ids = self.keys[order], self.ids[self.doc[order]]
        first = np.flatnonzero(np.diff(keys, prepend=~keys[:1]) != 0)
        if not len(first):
            return keys, np.zeros(0, bool)
        return keys[first], np.minimum.reduceat(ids, first) != np.maximum.reduceat(ids, first)

    def contexts(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For some anchors: rows of the bytes around them, zero outside the document, then the bytes valid before and from the anchor on; and hashes of the rows."""
        span, window = self.span, self.window
        padded = np.pad(self.data, (span, window))
        pos, doc = self.pos[which], self.doc[which]
        out = np.empty((len(pos), span + window + 2), np.uint8)
        out[:, : span + window] = np.lib.stride_tricks.sliding_window_view(padded, span + window)[pos]
        left, right = np.minimum(pos - self.starts[doc], span), np.minimum(self.ends[doc] - pos, window)
        edge = np.flatnonzero((left < span) | (right < window))
        column = np.arange(span + window)
        out[edge, : span + window] *= (column >= span - left[edge, None]) & (column < span + right[edge, None])
        out[:, -2], out[:, -1] = left, right
        return out, row_hashes(out)


def row_hashes(rows: np.ndarray) -> np.ndarray:
    words = np.pad(rows, ((0, 0), (0, -rows.shape[1] % 8))).view("<u8")
    h = np.zeros(len(rows), np.uint64)
    for j in range(words.shape[1]):
        h = _mixed(h + words[:, j], 0xD6E8FEB86659FD93 + 2 * j)
    return h


def _short(keys: np.ndarray) -> bytes:
    """48 bits of each key; the bucket has the rest."""
    return keys.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def _long(raw: bytes) -> np.ndarray:
    out = np.zeros((len(raw) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(raw, np.uint8).reshape(-1, 6)
    return out.view("<u8").ravel()


def _among(x: np.ndarray, ascending: np.ndarray) -> np.ndarray:
    """Which of x are among the ascending values."""
    if not len(ascending):
        return np.zeros(len(x), bool)
    return ascending[np.minimum(np.searchsorted(ascending, x), len(ascending) - 1)] == x


def in_several(lists: list[np.ndarray], twice: list[np.ndarray]) -> list[np.ndarray]:
    """Which keys of each list another list has, or any list marks as twice.

    One sort of all keys: a search of all shared keys for each list would take the square of the lists.
    """
    every = np.concatenate(lists)
    order = np.argsort(every)
    first = np.flatnonzero(np.diff(every[order], prepend=~every[order][:1]) != 0)
    n = np.diff(first, append=len(every))
    several = np.empty(len(every), bool)
    several[order] = np.repeat((n > 1) | np.logical_or.reduceat(np.concatenate(twice)[order], first), n)
    return np.split(several, np.cumsum([len(k) for k in lists])[:-1])


LOW = np.uint64((1 << 48) - 1)


def _by_bucket(keys: np.ndarray, buckets: int) -> list[tuple[int, np.ndarray]]:
    """(bucket, places of its keys in keys)."""
    bucket = ((keys >> np.uint64(48)) % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    edges = np.searchsorted(bucket[order], np.arange(buckets + 1))
    return [(b, order[edges[b] : edges[b + 1]]) for b in range(buckets) if edges[b] < edges[b + 1]]


def _refined(group: np.ndarray, digit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One pass: an order by (group, digit) and the new groups' numbers in that order."""
    order = np.lexsort((digit, group))
    g, d = group[order], digit[order]
    return order, np.cumsum((np.diff(g, prepend=g[:1]) != 0) | (np.diff(d, prepend=d[:1]) != 0))


def least_ids(rows: np.ndarray, least: np.ndarray, window: int) -> np.ndarray:
    """For distinct contexts and the least id of each: the least id that has each of their windows (LAST where there is none), by digit passes."""
    span = window - DIGIT
    left, right = rows[:, -2].astype(int), rows[:, -1].astype(int)
    offset = np.arange(span + 1)
    valid = (left[:, None] >= span - offset) & (right[:, None] >= DIGIT + offset)
    out = np.where(valid, least[:, None], LAST)
    anchor = np.ascontiguousarray(rows[:, span : span + DIGIT]).view(">u8")
    group = np.zeros(len(rows), np.int64)
    for j in range(anchor.shape[1]):
        order, new = _refined(group, anchor[:, j])
        group[order] = new
    alive = np.bincount(group, minlength=1)[group] > 1 if len(rows) else np.zeros(0, bool)
    for r in range(span + 1):
        at = np.flatnonzero(alive & valid[:, r])
        digits = np.zeros((len(at), -(-span // 8) * 8), np.uint8)
        digits[:, : span - r], digits[:, span - r : span] = rows[at, r:span], rows[at, span + DIGIT : span + DIGIT + r]
        words, own = digits.view(">u8"), group[at]
        for j in range(words.shape[1] + 1):
            keep = np.bincount(own, minlength=1)[own] > 1 if len(own) else np.zeros(0, bool)
            at, words, own = at[keep], words[keep], own[keep]
            if j == words.shape[1] or not len(at):
                break
            order, own = _refined(own, words[:, j])
            at, words = at[order], words[order]
        if len(at):
            order = np.argsort(own, kind="stable")
            first = np.flatnonzero(np.diff(own[order], prepend=-1) != 0)
            out[at[order], r] = np.repeat(np.minimum.reduceat(least[at[order]], first), np.diff(first, append=len(at)))
    return out


def remove_repeats(docs: DataFrame, window: int = WINDOW, with_text: bool = True) -> DataFrame:
    """Per row of docs: doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept (the remaining bytes; null unless with_text)."""
    n = shuffle_partitions(docs.sparkSession)
    blocks, buckets, span = 4 * n, n, window - DIGIT
    texts = docs.select("doc_id", text_bytes().alias("text"), F.pmod(F.xxhash64("doc_id"), F.lit(blocks)).cast("int").alias("block"))

    def load(group) -> Block:
        return Block(group.column("doc_id").to_pylist(), group.column("text").to_pylist(), window)

    def anchors(key, group):
        keys, twice = load(group).shared_here()
        own = _by_bucket(keys, buckets)
        return pa.table({"bucket": pa.array([b for b, _ in own], pa.int32()), "block": pa.array([key[0].as_py()] * len(own), pa.int32()), "keys": pa.array([_short(keys[at]) for _, at in own], pa.binary()), "twice": pa.array([np.packbits(twice[at]).tobytes() for _, at in own], pa.binary())})

    def shared(key, group):
        lists = [_long(x) for x in group.column("keys").to_pylist()]
        twice = [np.unpackbits(np.frombuffer(x, np.uint8), count=len(k)).astype(bool) for x, k in zip(group.column("twice").to_pylist(), lists, strict=True)]
        return pa.table({"block": group.column("block"), "keys": pa.array([_short(k[x]) for k, x in zip(lists, in_several(lists, twice), strict=True)], pa.binary())})

    def contexts(key, group, told):
        block = load(group)
        several = np.unique(_long(b"".join(told.column("keys").to_pylist())))
        which = np.flatnonzero(np.isin(block.keys & LOW, several))
        rows, hashes = block.contexts(which)
        order = np.argsort(hashes, kind="stable")
        first = np.flatnonzero(np.diff(hashes[order], prepend=~hashes[order][:1]) != 0)
        least = np.minimum.reduceat(block.ids[block.doc[which[order]]], first) if len(first) else np.zeros(0, np.int64)
        rows, keys = rows[order[first]], block.keys[which[order[first]]]
        own, press = _by_bucket(keys, buckets), zstandard.ZstdCompressor(level=1)
        fields = {"bucket": pa.array([b for b, _ in own], pa.int32()), "block": pa.array([key[0].as_py()] * len(own), pa.int32())}
        fields["rows"] = pa.array([press.compress(rows[at].tobytes()) for _, at in own], pa.binary())
        fields["keys"] = pa.array([_short(keys[at]) for _, at in own], pa.binary())
        fields["least"] = pa.array([least[at].astype("<i8").tobytes() for _, at in own], pa.binary())
        return pa.table(fields)

    def order_windows(key, group):
        expand = zstandard.ZstdDecompressor()
        parts = [np.frombuffer(expand.decompress(x), np.uint8).reshape(-1, span + window + 2) for x in group.column("rows").to_pylist()]
        rows, least = np.concatenate(parts), np.frombuffer(b"".join(group.column("least").to_pylist()), "<i8")
        hashes = row_hashes(rows)
        order = np.argsort(hashes, kind="stable")
        new = np.diff(hashes[order], prepend=~hashes[order][:1]) != 0
        first, which = np.flatnonzero(new), np.empty(len(rows), np.int64)
        which[order] = np.cumsum(new) - 1
        found = least_ids(rows[order[first]], np.minimum.reduceat(least[order], first), window)
        lengths, at, answers = [len(x) for x in parts], 0, []
        for n_rows, keys in zip(lengths, group.column("keys").to_pylist(), strict=True):
            own = slice(at, at + n_rows)
            smaller = found[which[own]] < least[own][:, None]
            some = np.flatnonzero(smaller.any(axis=1))
            answers.append((hashes[own][some].astype("<u8").tobytes(), _short(_long(keys)[some]), np.packbits(smaller[some], axis=1).tobytes()))
            at += n_rows
        return pa.table({"block": group.column("block"), **{name: pa.array([x[i] for x in answers], pa.binary()) for i, name in enumerate(("hashes", "keys", "smaller"))}})

    def cut_out(key, group, told):
        block = load(group)
        told_keys = np.unique(_long(b"".join(told.column("keys").to_pylist())))
        hashes = np.frombuffer(b"".join(told.column("hashes").to_pylist()), "<u8")
        width = -(-(span + 1) // 8)
        bits = np.unpackbits(np.frombuffer(b"".join(told.column("smaller").to_pylist()), np.uint8).reshape(-1, width), axis=1, count=span + 1).astype(bool)
        order = np.argsort(hashes)
        hashes, bits = hashes[order], bits[order]
        keys, twice = block.shared_here()
        which = np.flatnonzero(np.isin(block.keys, keys[twice]) | np.isin(block.keys & LOW, told_keys))
        starts = np.zeros(len(block.data) + 1, bool)
        if len(which):
            rows, own = block.contexts(which)
            ids = block.ids[block.doc[which]]
            group_order = np.argsort(own, kind="stable")
            new = np.diff(own[group_order], prepend=~own[group_order][:1]) != 0
            least = np.empty(len(own), np.int64)
            least[group_order] = np.minimum.reduceat(ids[group_order], np.flatnonzero(new))[np.cumsum(new) - 1]
            gone = np.repeat((ids > least)[:, None], span + 1, axis=1)
            if len(hashes):
                at = np.minimum(np.searchsorted(hashes, own), len(hashes) - 1)
                gone |= (hashes[at] == own)[:, None] & bits[at]
            offset = np.arange(span + 1)
            gone &= (rows[:, -2].astype(int)[:, None] >= span - offset) & (rows[:, -1].astype(int)[:, None] >= DIGIT + offset)
            for r in range(span + 1):
                starts[block.pos[which[gone[:, r]]] - span + r] = True
        change = starts.astype(np.int32)
        change[window:] -= starts[: len(starts) - window] if len(starts) > window else 0
        removed = np.cumsum(change, dtype=np.int32)[:-1] > 0
        out = {name: [] for name in ("n_bytes", "n_removed", "n_spans", "kept_sha256", "kept")}
        for s, e in zip(block.starts.tolist(), block.ends.tolist(), strict=True):
            off = removed[s:e]
            kept = block.data[s:e][~off].tobytes()
            out["n_bytes"].append(e - s)
            out["n_removed"].append(e - s - len(kept))
            out["n_spans"].append(int(np.count_nonzero(off[1:] & ~off[:-1])) + int(off[:1].any()))
            out["kept_sha256"].append(hashlib.sha256(kept).hexdigest())
            out["kept"].append(kept if with_text else None)
        return pa.table([group.column("doc_id").cast(pa.int64()), *[pa.array(out[n], k) for n, k in (("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string()), ("kept", pa.binary()))]], names=["doc_id", *out])

    sent = texts.groupBy("block").applyInArrow(anchors, "bucket int, block int, keys binary, twice binary")
    told = sent.groupBy("bucket").applyInArrow(shared, "block int, keys binary")
    around = texts.groupBy("block").cogroup(told.groupBy("block")).applyInArrow(contexts, "bucket int, block int, rows binary, keys binary, least binary")
    answers = around.groupBy("bucket").applyInArrow(order_windows, "block int, hashes binary, keys binary, smaller binary")
    return texts.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(cut_out, RESULT)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"), with_text=False).drop("kept")

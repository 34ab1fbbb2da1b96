"""Near-duplicate passages by compact windows.

A text is the sequence of its five-word shingles. Under a hash function, a compact window
(l, c, r) stands for all passages within [l, r] that contain c, whose least hash is at c: the
node of c in the Cartesian tree over the hashes. Only windows of at least `least` shingles are
formed, about 2 / least of the places. Passages that are near copies share their least hash
under most functions, so windows are grouped by function and hash value.

Blocks of documents first send the distinct shingles of each, 4 bytes and a bucket, and hear which of
them several documents hold. A passage can lack at most 20 % of its shingles in its near copy, so it has a stretch
of `least` to twice as many places of whose distinct shingles at most 20 % are held by one document alone; documents without
such a stretch leave, and only windows around one go on. A shingle that one document holds is never a least hash.

In a group each window is first linked to the group's first document by id and to its first by a hash
of the id, within the block first, so that a block sends two windows a group at most. Links of a pair of
documents are joined where their intervals overlap, across all functions, and each joined region is
verified: the best-matching stretches of both sides must have `least` shingles and the given Jaccard
similarity, as sets of 32-bit shingle hashes. First each document's longest link is verified, then all
links that are left between different connected components: a link within a component would not
change it. Then blocks of documents send their shingles again, with the components that hold them: a passage with a
near copy in another component has a stretch of which at most 20 % are held by its own component alone, so only
windows around such a stretch stay, not those of a phrase that many texts hold. All pairs of these windows of a
group that are in different components are met: those
pairs of documents that two functions bring together are verified too (near copies at the threshold
share their least hash under two of six functions with probability 0.998, a common phrase seldom does).
Of windows of a group and component with the same content one goes into pairs, so copies cost no pairs.

`passage_links` gives the places of the verified passages, `passage_classes` the classes.

Defined cases: a very long text is one document, whose shingles one task holds; null, empty and short texts (fewer than least + 4 words) have no passages and
are alone; rows that repeat an id are one document; null ids are alone with a null class; equal
hashes within a window are cut at the first of them; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemill.llm.common import components, cut, shuffle_partitions, stored, table, text_bytes
from lakemill.llm.line_dedup import between_roots
from lakemill.llm.substring_dedup import _by_bucket, _extreme, _mixed

WIDTH = 5
#: In place of the hash of a shingle that one document holds.
VOID = np.uint64(2**64 - 1)
#: A window that a block sends.
SENT = np.dtype([("key", "<u8"), ("id", "<i8"), ("l", "<i4"), ("r", "<i4")])
#: A window of a document; windows of equal content hold the same shingles.
OWN = np.dtype([("key", "<u8"), ("content", "<u8"), ("l", "<i4"), ("r", "<i4"), ("f", "<i4")])
LINK = [("doc", pa.int64()), ("l", pa.int32()), ("r", pa.int32()), ("lead", pa.int64()), ("ll", pa.int32()), ("lr", pa.int32())]
HELD = "bucket int, block int, keys binary, low binary, high binary, roots binary"
HELD_NONE = pa.table([pa.array([], pa.int32())] * 2 + [pa.array([], pa.binary())] * 4, names=[x.split()[0] for x in HELD.split(", ")])
LINK_SCHEMA = "doc long, l int, r int, lead long, ll int, lr int"


def shingles(text: bytes) -> np.ndarray:
    """Hashes of the five-word shingles of a text."""
    words = np.fromiter(map(zlib.crc32, text.split()), np.uint64)
    if len(words) < WIDTH:
        return np.zeros(0, np.uint64)
    h = np.zeros(len(words) - WIDTH + 1, np.uint64)
    for i in range(WIDTH):
        h = _mixed(h + words[i : len(words) - WIDTH + 1 + i], 0x9FB21C651E98DF25)
    return h


def compact_windows(values: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(c, l, r) of the compact windows of at least `least` places in values, where zeros separate texts and VOID is never a least value.

    c is the least of some window of that width. l and r reach to the next smaller such place,
    which may be a few places beyond the next smaller value; verification decides anyway.
    """
    if len(values) < least:
        return (np.zeros(0, np.int64),) * 3
    low = _extreme(values, least, np.minimum)
    chosen = (_extreme(np.pad(low, least - 1), least, np.maximum) == values) & (values != VOID)
    at = np.flatnonzero(chosen | (values == 0))
    v = values[at]
    before = _smaller(v, equal=True)
    after = len(v) - 1 - _smaller(v[::-1], equal=False)[::-1]
    real = v > 0
    left = np.where(before < 0, -1, at[before])
    right = np.where(after >= len(v), len(values), at[np.minimum(after, len(v) - 1)])
    return at[real], left[real] + 1, right[real] - 1


def _smaller(v: np.ndarray, equal: bool) -> np.ndarray:
    """For each place the nearest one before it of a smaller value (with equal: or the same), -1 where there is none."""
    out = np.arange(len(v)) - 1
    todo = np.arange(len(v))
    while len(todo):
        j = out[todo]
        more = (j >= 0) & ((v[j] > v[todo]) if equal else (v[j] >= v[todo]))
        todo, j = todo[more], j[more]
        out[todo] = out[j]
    return out


def earlier(seq: np.ndarray) -> np.ndarray:
    """The nearest place before each that holds the same, -1 where there is none."""
    order = np.argsort(seq, kind="stable")
    before = np.full(len(seq), -1)
    before[order[1:]] = np.where(seq[order[1:]] == seq[order[:-1]], order[:-1], -1)
    return before


def stretches(missing: np.ndarray, gap: np.ndarray, least: int, similarity: float, before: np.ndarray | None = None) -> np.ndarray:
    """How many stretches begin before each place: of `least` places or more, less than twice as many and no gap, with at most 1 - similarity as many missing as distinct shingles.

    A passage of `least` places or more that lacks at most that share of its distinct shingles, missing marking the
    first place of a shingle in a document, is cut into such lengths. What its parts miss adds up to what it misses at most, their
    distinct shingles to its own at least, so one of its parts is such a stretch. Without before (as of `earlier`) all places
    count as distinct, which keeps more stretches.
    """
    n = len(missing)
    begins = np.zeros(n + 1, np.int64)
    if n >= least:
        total = np.concatenate([[0], np.cumsum(np.where(gap, 4 * least, missing))])
        over = total - (1 - similarity) * np.arange(n + 1)
        lowest = _extreme(np.concatenate([over[least:], np.full(least - 1, np.inf)]), least, np.minimum)
        begins[1 : n - least + 2] = lowest <= over[: n - least + 1] + 1e-6  # as if no shingle came twice in a stretch
        if before is None:
            return np.cumsum(begins)
        nearest = _extreme(np.pad(before, (0, 2 * least - 2), constant_values=-1), 2 * least - 1, np.maximum)
        at = np.flatnonzero((begins[1:] > 0) & (nearest >= np.arange(n)))
        begins[1 + at], count = 0, np.zeros(len(at), np.int64)
        for size in range(1, 2 * least):
            inside = at + size <= n
            if not inside.all():
                at, count = at[inside], count[inside]
            count += before[at + size - 1] < at
            if size >= least:
                found = total[at + size] - total[at] <= (1 - similarity) * count + 1e-6
                begins[1 + at[found]] = 1
                at, count = at[~found], count[~found]
    return np.cumsum(begins)


def first_places(seq: np.ndarray) -> np.ndarray:
    """Which places of a sequence hold what no place before them holds."""
    return earlier(seq) < 0


def distinct(seq: np.ndarray, least: int) -> np.ndarray:
    """How many distinct shingles each `least` consecutive places of a sequence have."""
    return distinct_by(earlier(seq), least)


def distinct_by(before: np.ndarray, least: int) -> np.ndarray:
    """The same from the result of `earlier`."""
    n = len(before)
    if n < least:
        return np.zeros(0, np.int64)
    # a place counts in the stretches that begin behind the last one of the same shingle
    at = np.arange(n)
    first = np.maximum(before + 1, at - least + 1).clip(0)
    count = np.cumsum(np.bincount(first, minlength=n + 1) - np.bincount(at + 1, minlength=n + 1))
    return count[: n - least + 1]


def room_for(seq: np.ndarray, held: np.ndarray, least: int, similarity: float, before: np.ndarray | None = None) -> bool:
    """Whether a sequence may have a passage of `least` places or more of whose distinct shingles that share is held.

    It has no more distinct shingles than what is held allows, so it lies where none of its stretches of
    `least` places has more, and what is held must be there.
    """
    before = earlier(seq) if before is None else before
    count = distinct_by(before, least)
    few = np.concatenate([[0], (count * similarity <= np.count_nonzero(held & (before < 0)) + 1e-9).astype(np.int8), [0]])
    for a, b in zip(np.flatnonzero(np.diff(few) == 1).tolist(), np.flatnonzero(np.diff(few) == -1).tolist(), strict=True):
        here = slice(a, b + least - 1)
        if np.count_nonzero(held[here] & (before[here] < a)) >= similarity * count[a:b].min() - 1e-9:
            return True
    return False


class Block:
    """The shingles of a block of documents end to end, with a gap behind each document."""

    def __init__(self, doc_ids: list, texts: list[bytes], least: int):
        seqs = [shingles(x) for x in texts]
        long = [i for i, s in enumerate(seqs) if len(s) >= least and doc_ids[i] is not None]
        self.least = least
        self.ids = np.array([doc_ids[i] for i in long], np.int64)
        self.seqs = [seqs[i] for i in long]
        self.sizes = np.array([len(s) for s in self.seqs], np.int64)
        self.starts = np.cumsum(self.sizes + 1) - self.sizes
        self.flat = np.zeros(int(self.sizes.sum()) + len(long) + 1, np.uint64)
        self.gap = np.ones(len(self.flat), bool)
        for s, seq in zip(self.starts.tolist(), self.seqs, strict=True):
            self.flat[s : s + len(seq)] = seq
            self.gap[s : s + len(seq)] = False
        places = np.flatnonzero(~self.gap)
        self.order = places[np.argsort(self.flat[places], kind="stable")]
        new = np.diff(self.flat[self.order], prepend=~self.flat[self.order][:1]) != 0
        self.first = np.flatnonzero(new)
        self.number = np.cumsum(new) - 1
        self.keys = self.flat[self.order[self.first]]
        self.doc = np.repeat(np.arange(len(long)), self.sizes + 1)[self.order]

    def twice(self) -> np.ndarray:
        """Which of the distinct shingles several documents of the block hold."""
        if not len(self.first):
            return np.zeros(0, bool)
        ids = self.ids[self.doc]
        return np.minimum.reduceat(ids, self.first) != np.maximum.reduceat(ids, self.first)

    def windows(self, several: np.ndarray, similarity: float, functions: int) -> tuple[np.ndarray, ...]:
        """(document, function, key, l, r) of the windows that may hold a passage, where `several` tells which distinct shingles other documents hold too.

        Those without a stretch that other documents hold at that share hold none.
        """
        shared = np.zeros(len(self.flat), bool)
        shared[self.order] = several[self.number]
        before = np.full(len(self.flat), -1)  # the nearest place of its document in front that holds the same
        before[self.order[1:]] = np.where((self.number[1:] == self.number[:-1]) & (self.doc[1:] == self.doc[:-1]), self.order[:-1], -1)
        begins = stretches(~shared & ~self.gap & (before < 0), self.gap, self.least, similarity, before)
        some = np.flatnonzero(begins[self.starts + self.sizes] > begins[self.starts])
        sizes = self.sizes[some] + 1
        new = np.cumsum(sizes) - sizes
        at = np.repeat(self.starts[some] - new, sizes) + np.arange(int(sizes.sum()))  # those documents' places and the gaps behind them
        values, void, gap = self.flat[at], ~shared[at], self.gap[at]
        out = []
        for j in range(functions if len(some) else 0):
            v = np.clip(_mixed(values ^ np.uint64(0x9E3779B97F4A7C15 * (j + 1) % (1 << 64)), 0xD6E8FEB86659FD93), np.uint64(1), VOID - np.uint64(1))
            v[void] = VOID
            v[gap] = 0
            c, low, high = compact_windows(v, self.least)
            where = np.searchsorted(new, c, side="right") - 1
            doc, shift = some[where], self.starts[some][where] - new[where]
            held = begins[np.maximum(high + shift - self.least + 2, low + shift)] > begins[low + shift]
            key = _mixed(v[c] + np.uint64(j), 0xA24BAED4963EE407)
            out.append([x[held] for x in (doc, np.full(len(c), j), key, low - new[where], high - new[where])])
        return tuple(np.concatenate(x) for x in zip(*out, strict=True)) if out else (*(np.zeros(0, np.int64),) * 2, np.zeros(0, np.uint64), *(np.zeros(0, np.int64),) * 2)


def stars(keys: np.ndarray, ids: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, pa.Table]:
    """In each group of equal keys: the places of its first window by id and by a hash of the id, and links of every window to both."""
    heads, links = [], []
    for rank in (ids, _mixed(ids.view(np.uint64), 0xD6E8FEB86659FD93)):
        order = np.lexsort((low, rank, keys))
        first = np.flatnonzero(np.diff(keys[order], prepend=~keys[order][:1]) != 0)
        head = np.empty(len(keys), np.int64)
        head[order] = np.repeat(order[first], np.diff(first, append=len(keys)))
        other = ids != ids[head]
        heads.append(order[first])
        links.append([x[y][other] for x in (ids, low, high) for y in (np.arange(len(keys)), head)])
    i, j, a, b, c, d = (np.concatenate(x) for x in zip(*links, strict=True))
    turn = i < j  # the smaller id leads
    pick = lambda x, y: (np.where(turn, y, x), np.where(turn, x, y))
    (doc, lead), (l, ll), (r, lr) = pick(i, j), pick(a, b), pick(c, d)
    return np.unique(np.concatenate(heads)), joined(doc, l, r, lead, ll, lr)


def joined(doc, low, high, lead, lead_low, lead_high) -> pa.Table:
    """Links of a pair of documents joined where the intervals overlap on both sides."""
    order = np.lexsort((lead_low, low, lead, doc))
    out, now = [], None
    for d, l, r, e, ll, lr in zip(*(x[order].tolist() for x in (doc, low, high, lead, lead_low, lead_high)), strict=True):
        if now and now[0] == d and now[3] == e and l <= now[2] and ll <= now[5] and lr >= now[4]:
            now[2], now[4], now[5] = max(now[2], r), min(now[4], ll), max(now[5], lr)
        else:
            now = [d, l, r, e, ll, lr]
            out.append(now)
    return pa.table([pa.array([x[i] for x in out], kind) for i, (_, kind) in enumerate(LINK)], names=[n for n, _ in LINK])


def _held(seq: list, other: set) -> np.ndarray:
    """Which places of seq hold members of other."""
    return np.fromiter(map(other.__contains__, seq), bool, len(seq))


def _stretch(seq: list, other: set, miss: float) -> tuple[int, int]:
    """The stretch [a, b) of seq of largest sum, where members of other count 1 and others -miss."""
    total = np.concatenate([[0], np.cumsum(np.where(_held(seq, other), 1, -miss))])
    lowest = np.minimum.accumulate(total)
    b = int(np.argmax(total - lowest))
    return (int(np.flatnonzero(total[:b] == lowest[b])[-1]), b) if b else (0, 0)


def similar(a: bytes, b: bytes, least: int, similarity: float) -> tuple[int, int, int, int] | None:
    """Where a and b (32-bit shingle hashes) hold stretches of at least `least` shingles with that Jaccard similarity, if they do.

    (start in a, end in a, start in b, end in b), ends exclusive.

    Where what they have in common comes in the same order on both sides, without repeats, the longest run of it is tried. Else
    stretches are sought that hold few shingles the other side lacks, with falling weights of
    such misses, from those that end at an edit to those that span several or lie beside one, and at last ones that lack none.
    Shorter ones are extended to `least` shingles to the left, to the right or to both sides.
    """
    if a == b:
        n = len(a) // 4
        return (0, n, 0, n) if n >= least else None
    u, v = np.frombuffer(a, "<u4"), np.frombuffer(b, "<u4")
    x, y = u.tolist(), v.tolist()
    of_x, of_y = set(x), set(y)
    both, plain = of_x & of_y, len(of_x) == len(x) and len(of_y) == len(y)
    if not both or (plain and len(both) * (1 + similarity) < 2 * least * similarity - 1e-9):
        return None  # without repeats, two stretches of that similarity have so many in common
    if plain and (in_order := places_in_order(x, y, both)):
        ends = longest_common(*in_order, least, similarity)
        if not ends:
            return None
        if found := _widened(x, y, *ends, least, similarity):
            return found
    sides = [(own, _held(seq, both), earlier(own)) for own, seq in ((u, x), (v, y))]
    for own, held, before in sides:  # each of the two lacks at most that share
        if not stretches((before < 0) & ~held, np.zeros(len(own), bool), least, similarity)[-1]:
            return None
    if not all(room_for(own, held, least, similarity, before) for own, held, before in sides):
        return None
    for miss in (8, 4, 2, 1, 1 / 2, 1 / 4, 1 / 8, 64):
        i, j = _stretch(x, of_y, miss)
        k, m = _stretch(y, set(x[i:j]), miss)
        i, j = _stretch(x, set(y[k:m]), miss)
        if found := _widened(x, y, i, j, k, m, least, similarity):
            return found
    return None


def places_in_order(x: list, y: list, both: set) -> tuple[np.ndarray, np.ndarray] | None:
    """The places of what two sequences without repeats have in common, if it comes in the same order in both."""
    where = {s: i for i, s in enumerate(y) if s in both}
    at = [i for i, s in enumerate(x) if s in both]
    there = np.array([where[x[i]] for i in at])
    return (np.array(at), there) if (there[1:] > there[:-1]).all() else None


def longest_common(at: np.ndarray, there: np.ndarray, least: int, similarity: float) -> tuple[int, int, int, int] | None:
    """Ends of the longest run of common places with that similarity and as many as two stretches of `least` must have in common; None if none exists.

    Two stretches of that similarity, cut to their first and last common places, lose none of these, so they hold such a run.
    """
    n, i = int(np.ceil(2 * least * similarity / (1 + similarity) - 1e-9)), np.arange(len(at))
    if len(at) < n:
        return None
    share = 1 / similarity - 1
    lack = at + there - 2 * i - share * i  # of one side only, less what so many common ones allow
    lowest = np.minimum.accumulate(lack[::-1])[::-1]
    last = np.searchsorted(lowest, lack + share + 1e-6, side="right") - 1
    best = int(np.argmax(last - i))
    if last[best] - best + 1 < n:
        return None
    return int(at[best]), int(at[last[best]]) + 1, int(there[best]), int(there[last[best]]) + 1


def _widened(x: list, y: list, i: int, j: int, k: int, m: int, least: int, similarity: float) -> tuple[int, int, int, int] | None:
    """x[i:j] and y[k:m], extended to `least` places, if they have the similarity then."""
    for side in (0, 1, 2) if min(j - i, m - k) < least else (0,):
        (e, f), (g, h) = _extended(i, j, len(x), least, side), _extended(k, m, len(y), least, side)
        if f - e >= least and h - g >= least:
            p, q = set(x[e:f]), set(y[g:h])
            both = len(p & q)
            if both >= similarity * (len(p) + len(q) - both):
                return e, f, g, h
    return None


def _extended(a: int, b: int, n: int, least: int, side: int) -> tuple[int, int]:
    """[a, b) of n places extended to `least` of them to the left (0), the right (1) or both sides (2), as far as they go."""
    lack = max(0, least - (b - a))
    a = max(0, a - (lack, 0, lack // 2)[side])
    b = min(n, max(b, a + least if lack else b))
    return max(0, min(a, b - least)) if lack else a, b


LINKED = "a long, b long, a_word int, a_words int, b_word int, b_words int"


def passage_links(docs: DataFrame, least_words: int = 50, similarity: float = 0.8, functions: int = 6) -> DataFrame:
    """Verified near copies of passages, enough to connect all documents that they connect.

    a, b (document ids), a_word, a_words, b_word, b_words (first word, from 0, and number of words of the passage in each).
    """
    n, least = shuffle_partitions(docs.sparkSession), least_words - WIDTH + 1
    blocks, buckets = 4 * n, n
    texts = docs.select("doc_id", text_bytes().alias("text"), F.pmod(F.xxhash64("doc_id"), F.lit(blocks)).cast("int").alias("block"))

    def load(group) -> Block:
        return Block(group.column("doc_id").to_pylist(), group.column("text").to_pylist(), least)

    def keys_of(key, group):
        block = load(group)
        low, twice, own = block.keys.astype("<u4"), block.twice(), _by_bucket(block.keys, buckets)
        return pa.table({"bucket": pa.array([b for b, _ in own], pa.int32()), "block": pa.array([key[0].as_py()] * len(own), pa.int32()), "keys": pa.array([low[at].tobytes() for _, at in own], pa.binary()), "twice": pa.array([np.packbits(twice[at]).tobytes() for _, at in own], pa.binary())})

    def shared(key, group):
        lists = [np.frombuffer(x, "<u4") for x in group.column("keys").to_pylist()]
        twice = [np.unpackbits(np.frombuffer(x, np.uint8), count=len(k)).astype(bool) for x, k in zip(group.column("twice").to_pylist(), lists, strict=True)]
        every = np.concatenate(lists)
        order = np.argsort(every)
        first = np.flatnonzero(np.diff(every[order], prepend=~every[order][:1]) != 0)
        n = np.diff(first, append=len(every))
        several = np.empty(len(every), bool)
        several[order] = np.repeat((n > 1) | np.logical_or.reduceat(np.concatenate(twice)[order], first), n)
        bits = [np.packbits(x).tobytes() for x in np.split(several, np.cumsum([len(k) for k in lists])[:-1])]
        return pa.table({"block": group.column("block"), "bucket": group.column("bucket"), "bits": pa.array(bits, pa.binary())})

    sides = [("bucket", pa.int32()), ("windows", pa.binary()), ("seq", pa.binary()), ("own", pa.binary())]

    def windows_of(key, group, told):
        block = load(group)
        bits = dict(zip(told.column("bucket").to_pylist(), told.column("bits").to_pylist(), strict=True))
        several = np.zeros(len(block.keys), bool)
        for bucket, at in _by_bucket(block.keys, buckets):
            several[at] = np.unpackbits(np.frombuffer(bits[bucket], np.uint8), count=len(at))
        doc, function, keys, low, high = block.windows(several, similarity, functions)
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_mixed(block.flat, 0x9FB21C651E98DF25))])
        content = total[block.starts[doc] + high + 1] - total[block.starts[doc] + low]
        for which in (0, 1):  # of windows of one value up to the next smaller one the first holds the others; equal contents need one place
            x = (high, content)[which]
            order = np.lexsort((low, x, keys, doc))
            once = order[np.any([np.diff(y[order], prepend=~y[order][:1]) != 0 for y in (doc, keys, x)], axis=0)]
            doc, function, keys, low, high, content = (y[once] for y in (doc, function, keys, low, high, content))
        ids = block.ids[doc]
        edge, links = stars(keys, ids, low, high)
        rows = np.empty(len(edge), SENT)
        rows["key"], rows["id"], rows["l"], rows["r"] = keys[edge], ids[edge], low[edge], high[edge]
        own = _by_bucket(keys[edge], buckets)
        sent = pa.table({"bucket": pa.array([b for b, _ in own], pa.int32()), "windows": pa.array([rows[at].tobytes() for _, at in own], pa.binary())})
        first = np.flatnonzero(np.diff(doc, prepend=-1))
        every = np.empty(len(doc), OWN)
        every["key"], every["content"], every["l"], every["r"], every["f"] = keys, content, low, high, function
        docs = doc[first].tolist()
        seqs = pa.table({"seq": pa.array([block.seqs[i].astype("<u4").tobytes() for i in docs], pa.binary()), "own": pa.array([every[a:b].tobytes() for a, b in zip(first.tolist(), [*first[1:].tolist(), len(doc)], strict=False)], pa.binary()), "doc": pa.array(block.ids[docs] if docs else [], pa.int64())})
        schema = pa.schema([*sides, *LINK])
        return pa.concat_tables([pa.table([t.column(f.name) if f.name in t.column_names else pa.nulls(len(t), f.type) for f in schema], schema=schema) for t in (sent, seqs, links)])

    def across(key, group):
        rows = np.frombuffer(b"".join(group.column("windows").to_pylist()), SENT)
        return stars(rows["key"].astype(np.uint64), rows["id"].astype(np.int64), rows["l"].astype(np.int64), rows["r"].astype(np.int64))[1]

    def regions(batches):
        for batch in batches:
            rows = [(r["doc"], x["l"], x["r"], r["lead"], x["ll"], x["lr"]) for r in batch.to_pylist() for x in r["links"]]
            if rows:
                yield from joined(*(np.array(x, np.int64) for x in zip(*rows, strict=True))).to_batches()

    def rooted(group, roots) -> tuple:
        """The documents of a block, their components, shingles end to end, the document (place in the block) of each, and the distinct shingles with the place of each in them."""
        of = dict(zip(roots.column("node").to_pylist(), roots.column("root").to_pylist(), strict=True))
        docs = group.column("doc").to_pylist()
        seqs = [np.frombuffer(x, "<u4") for x in group.column("seq").to_pylist()]
        flat = np.concatenate(seqs)
        return docs, np.array([of.get(d, d) for d in docs], np.int64), flat, np.repeat(np.arange(len(docs)), [len(x) for x in seqs]), *np.unique(flat, return_inverse=True)

    def held_by(key, group, roots):
        docs, root, flat, doc, keys, number = rooted(group, roots)
        every, place = np.unique(root, return_inverse=True)
        order = np.argsort(number, kind="stable")
        first = np.searchsorted(number[order], np.arange(len(keys)))
        low, high = (pick.reduceat(place[doc[order]], first).astype("<u4") for pick in (np.minimum, np.maximum))
        own = _by_bucket(_mixed(keys.astype(np.uint64), 0x9FB21C651E98DF25), buckets)
        parts = [np.unique(np.stack([low[at], high[at]]), return_inverse=True) for _, at in own]  # a row has the components of its own shingles only
        columns = {"keys": [keys[at] for _, at in own], **{c: [p.reshape(2, -1)[i].astype("<u4") for _, p in parts] for i, c in enumerate(("low", "high"))}, "roots": [every[r].astype("<i8") for r, _ in parts]}
        return pa.table({"bucket": pa.array([b for b, _ in own], pa.int32()), "block": pa.array([key[0].as_py()] * len(own), pa.int32()), **{c: pa.array([x.tobytes() for x in v], pa.binary()) for c, v in columns.items()}})

    def shared_by_roots(key, group):
        lists = [np.frombuffer(x, "<u4") for x in group.column("keys").to_pylist()]
        low, high = (np.concatenate([np.frombuffer(r, "<i8")[np.frombuffer(x, "<u4")] for x, r in zip(group.column(c).to_pylist(), group.column("roots").to_pylist(), strict=True)]) for c in ("low", "high"))
        every = np.concatenate(lists)
        order = np.argsort(every)
        first = np.flatnonzero(np.diff(every[order], prepend=~every[order][:1]) != 0)
        several = np.empty(len(every), bool)
        several[order] = np.repeat(np.minimum.reduceat(low[order], first) != np.maximum.reduceat(high[order], first), np.diff(first, append=len(every)))
        bits = [np.packbits(x).tobytes() for x in np.split(several, np.cumsum([len(k) for k in lists])[:-1])]
        return pa.table({"block": group.column("block"), "bucket": group.column("bucket"), "bits": pa.array(bits, pa.binary())})

    def opened(key, group, told):
        """The windows of a block around a stretch that other components hold at the similarity's share."""
        bits = told.filter(pc.is_valid(told.column("bucket")))
        bits = dict(zip(bits.column("bucket").to_pylist(), bits.column("bits").to_pylist(), strict=True))
        kinds = [("key", pa.int64()), ("root", pa.int64()), ("content", pa.int64()), ("doc", pa.int64()), ("l", pa.int32()), ("r", pa.int32()), ("f", pa.int32())]
        if not len(group):
            return pa.table([pa.array([], k) for _, k in kinds], names=[n for n, _ in kinds])
        docs, root, flat, doc, keys, number = rooted(group, told.filter(pc.is_valid(told.column("node"))))
        several = np.zeros(len(keys), bool)
        for bucket, at in _by_bucket(_mixed(keys.astype(np.uint64), 0x9FB21C651E98DF25), buckets):
            several[at] = np.unpackbits(np.frombuffer(bits[bucket], np.uint8), count=len(at))
        sizes, whose = np.bincount(doc, minlength=len(docs)), doc
        at = np.arange(len(flat)) + doc  # places end to end, with a gap behind each document
        starts, total = np.cumsum(sizes + 1) - sizes - 1, len(flat) + len(docs)
        gap, held, before = np.ones(total, bool), np.zeros(total, bool), np.full(total, -1)
        gap[at], held[at] = False, several[number]
        order = np.lexsort((number, whose))  # stable, so in the order of places
        again = (np.diff(number[order], prepend=-1) == 0) & (np.diff(whose[order], prepend=-1) == 0)
        before[at[order[1:]]] = np.where(again[1:], at[order[:-1]], -1)
        first = (before < 0) & ~gap
        begins = stretches(~held & first, gap, least, similarity, before)
        windows = [np.frombuffer(x, OWN) for x in group.column("own").to_pylist()]
        rows, doc = np.concatenate(windows), np.repeat(np.arange(len(docs)), [len(x) for x in windows])
        low, high = rows["l"].astype(np.int64) + starts[doc], rows["r"].astype(np.int64) + starts[doc]
        count = np.concatenate([[0], np.cumsum(held)])
        fewest = np.minimum.reduceat(np.append(distinct_by(before, least), 0), np.stack([low, high - least + 2], axis=1).ravel())[::2] if len(rows) else low
        in_doc = np.bincount(whose, weights=(held & first)[at], minlength=len(docs))
        enough = np.minimum(count[high + 1] - count[low], in_doc[doc]) >= similarity * fewest - 1e-9
        some = enough & (begins[np.maximum(high - least + 2, low)] > begins[low])
        rows, root, doc = rows[some], root[doc[some]], np.array(docs, np.int64)[doc[some]]
        columns = {"root": root, "doc": doc, **{c: np.ascontiguousarray(rows[c]) for c in ("l", "r", "f")}, **{c: np.ascontiguousarray(rows[c]).view(np.int64) for c in ("key", "content")}}
        return pa.table([pa.array(columns[n], k) for n, k in kinds], names=[n for n, _ in kinds])

    def verified(batches):
        for batch in batches:
            found = [similar(x, y, least, similarity) for x, y in zip(batch.column("seq").to_pylist(), batch.column("lead_seq").to_pylist(), strict=True)]
            rows = [(r["a"], r["b"], r["l"] + x[0], x[1] - x[0] + WIDTH - 1, r["ll"] + x[2], x[3] - x[2] + WIDTH - 1) for r, x in zip(batch.select(["a", "b", "l", "ll"]).to_pylist(), found, strict=True) if x]
            schema = pa.schema([(x.split()[0], pa.int64() if x.endswith("long") else pa.int32()) for x in LINKED.split(", ")])
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(schema)], schema=schema)

    sent = texts.groupBy("block").applyInArrow(keys_of, "bucket int, block int, keys binary, twice binary")
    told = sent.groupBy("bucket").applyInArrow(shared, "block int, bucket int, bits binary")
    found = stored(texts.groupBy("block").cogroup(told.groupBy("block")).applyInArrow(windows_of, f"bucket int, windows binary, seq binary, own binary, {LINK_SCHEMA}"), "windows")
    links = found.where("lead is not null").drop("bucket", "windows", "seq", "own").union(found.where("bucket is not null").select("bucket", "windows").groupBy("bucket").applyInArrow(across, LINK_SCHEMA))
    pairs = links.groupBy("doc", "lead").agg(F.collect_list(F.struct("l", "r", "ll", "lr")).alias("links"))
    links = stored(pairs.mapInArrow(regions, LINK_SCHEMA), "links")

    def pair_regions(met: DataFrame) -> DataFrame:
        """Regions of pairs of windows (structs a, b) that two functions support."""
        rows = met.select(F.when(F.col("a.doc") < F.col("b.doc"), F.struct("b", "a")).otherwise(F.struct(F.col("a").alias("b"), F.col("b").alias("a"))).alias("x"))
        at = F.struct(F.col("x.b.l").alias("l"), F.col("x.b.r").alias("r"), F.col("x.a.l").alias("ll"), F.col("x.a.r").alias("lr"))
        two = rows.groupBy(F.col("x.b.doc").alias("doc"), F.col("x.a.doc").alias("lead")).agg(F.collect_set(at).alias("links"), F.expr("bit_or(shiftleft(1, x.a.f))").alias("functions"))
        return stored(two.where(F.bit_count("functions") >= min(2, functions)).drop("functions").mapInArrow(regions, LINK_SCHEMA), "pairs")

    seqs = found.where("seq is not null").select("doc", "seq")
    part = lambda l, r: F.substring("seq", 4 * F.col(l) + 1, 4 * (F.col(r) - F.col(l) + 1))

    def checked(some: DataFrame) -> DataFrame:
        own = some.join(seqs, "doc").select("doc", "lead", "l", "ll", "lr", part("l", "r").alias("own_seq"))
        leads = some.select(F.col("lead").alias("doc"), "ll", "lr").distinct().join(seqs, "doc").select(F.col("doc").alias("lead"), "ll", "lr", part("ll", "lr").alias("lead_seq"))
        both = own.join(leads, ["lead", "ll", "lr"]).select(F.col("doc").alias("a"), F.col("lead").alias("b"), "l", "ll", F.col("own_seq").alias("seq"), "lead_seq")
        return stored(both.mapInArrow(verified, LINKED), "verified")

    def apart(links: DataFrame, roots: DataFrame) -> DataFrame:
        lead_root = roots.toDF("lead", "lead_root")
        return links.join(roots.withColumnRenamed("node", "doc"), "doc", "left").join(lead_root, "lead", "left").where(F.coalesce("root", "doc") != F.coalesce("lead_root", "lead")).drop("root", "lead_root")

    longest = links.groupBy("doc").agg(F.max_by(F.struct("l", "r", "lead", "ll", "lr"), F.struct(F.col("r") - F.col("l"), "lead", "l", "ll")).alias("x")).select("doc", "x.*")
    edges = checked(longest)
    edges = edges.union(checked(apart(links, components(edges.select("a", "b")))))
    roots = cut(components(edges.select("a", "b")))
    block = lambda c: F.pmod(F.xxhash64(c), F.lit(blocks)).cast("int").alias("block")
    own, roots = found.where("own is not null").select("doc", "seq", "own", block("doc")), roots.select("node", "root", block("node"))
    held = own.drop("own").groupBy("block").cogroup(roots.groupBy("block")).applyInArrow(lambda key, x, y: held_by(key, x, y) if len(x) else HELD_NONE, HELD)
    told = held.groupBy("bucket").applyInArrow(shared_by_roots, "block int, bucket int, bits binary").unionByName(roots, allowMissingColumns=True)
    windows = own.groupBy("block").cogroup(told.groupBy("block")).applyInArrow(opened, "key long, root long, content long, doc long, l int, r int, f int")
    mixed = windows.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high").select("key")
    once = windows.join(mixed, "key").groupBy("key", "root", "content").agg(F.min(F.struct("doc", "l", "r", "f")).alias("id"))
    met = between_roots(stored(once.select("key", "root", "id", F.lit(0).alias("sketch")), "mixed"), ["key"])
    return edges.union(checked(pair_regions(met)))


def passage_classes(docs: DataFrame, least_words: int = 50, similarity: float = 0.8, functions: int = 6) -> DataFrame:
    """Per document id: doc_id, component_id (smallest id reachable over verified links), n_docs (documents of the component)."""
    roots = components(passage_links(docs, least_words, similarity, functions).select("a", "b"))
    ids = docs.select("doc_id").distinct()
    found = ids.join(roots, ids.doc_id == roots.node, "left").select("doc_id", F.coalesce("root", "doc_id").alias("component_id"))
    sizes = found.groupBy("component_id").agg(F.count("*").alias("n_docs")).withColumnRenamed("component_id", "of")
    return found.join(sizes, F.col("component_id") == F.col("of"), "left").select("doc_id", "component_id", F.coalesce("n_docs", F.lit(1)).cast("long").alias("n_docs"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passage_classes(table(spark, sf_dir, "documents"))

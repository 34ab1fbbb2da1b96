"""Packing by lexical retrieval.

Texts are encoded once, and the document frequencies of all token ids are counted over the whole
table. A document's lexical keys are its heaviest BM25 terms among those of at least a shard's
documents, of an eighth of them, and of two. Documents are sorted by these keys over the
whole table, ties by a hash, and each run of `shard_docs` documents, or of `shard_tokens` ids if
that is less, is a shard: documents that share heavy terms come into one shard, and as the hash parts
equal keys, a term or a copy that a third of all rows hold fills many shards.

A shard has its own BM25 inverted index over token ids. A seed document opens a window of `size`
ids; its best unused neighbours, by BM25 with all of the seed's terms as query (or its heaviest
`query_terms`, if that is given), fill the window greedily. A document that doesn't fit is cut and its rest is the next seed. A window that a
shard leaves open goes on in the task's next shard; the last of a task is cut into powers of
two, which need no padding.

A task holds one shard at a time, and a number for each two of its documents. Documents are dealt into tasks by sampled ranges of the keys, so
reruns may cut elsewhere; a task that is redone repeats its rows.

Defined cases: a null or empty text is its end id alone and has no keys; a very long text is held
whole by one task, in a shard that ends with it; documents without common terms follow in the shard's order; equal scores
go to the first in that order; rows that repeat an id are packed separately; null ids are ids like others; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemill.llm.common import shuffle_partitions, stored, table
from lakemill.llm.tokens import default_path, encoder

SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
KEYED = "doc_id long, ids binary, tie long, key array<int>"
K1, B = 1.2, 0.75
#: Documents whose terms are weighed together.
TOGETHER = 500
#: Bytes of texts that are encoded together (one document is never cut), so that most pieces of a call are met in it before.
ENCODED = 8 << 20
#: Posting lists that hold one document in LONG, or more, are added up as matrix products, for all seeds at once.
LONG = 8


class Index:
    """BM25 over the documents of a shard, given as arrays of ids; queries have all their terms, or the heaviest `terms` of them.

    Holds a number for each two documents of the shard, and the posting lists.
    """

    def __init__(self, docs: list[np.ndarray], k1: float = K1, b: float = B, terms: int | None = None):
        n = self.n = len(docs)
        lengths = np.array([len(x) for x in docs])
        key, tf = np.unique(np.concatenate(docs).astype(np.int64) * n + np.repeat(np.arange(n), lengths), return_counts=True)
        term, doc = np.divmod(key, n)
        starts = np.flatnonzero(np.diff(term, prepend=-1))
        df = np.diff(starts, append=len(term))
        shared = np.repeat((df > 1) & (df < n), df)  # a term of one document retrieves no other, one of all tells none apart
        idf = np.repeat(np.log1p((n - df + 0.5) / (df + 0.5)), df)
        weight = idf * tf * (k1 + 1) / (tf + k1 * (1 - b + b * lengths[doc] / max(1.0, lengths.mean())))
        doc, weight = doc[shared], weight[shared]
        starts = np.flatnonzero(np.diff(term[shared], prepend=-1))
        held = np.diff(starts, append=len(doc))
        posting = np.repeat(np.arange(len(starts)), held)
        order = np.argsort(doc - weight / (weight.max(initial=0) + 1))  # by document, heaviest term first
        if terms is not None:
            before = np.searchsorted(doc[order], np.arange(n))
            order = order[np.arange(len(order)) - before[doc[order]] < terms]
        self.query = np.split(posting[order], np.searchsorted(doc[order], np.arange(1, n)))
        long = held * LONG >= n
        self.near = self._long_lists(np.flatnonzero(long), posting, doc, weight, doc[order], posting[order])
        short = order[~long[posting[order]]]
        self.short = np.split(posting[short], np.searchsorted(doc[short], np.arange(1, n)))
        kept = ~long[posting]
        self.doc, self.weight, self.held = doc[kept], weight[kept], np.where(long, 0, held)
        self.first = np.cumsum(self.held) - self.held

    def _long_lists(self, lists: np.ndarray, posting: np.ndarray, doc: np.ndarray, weight: np.ndarray, seed: np.ndarray, asked: np.ndarray) -> np.ndarray:
        """What the long lists add to the score of each document (column) for each seed (row), some lists at a time; seed has asked as a term."""
        out = np.zeros((self.n, self.n))
        for i in range(0, len(lists), TOGETHER):
            some = lists[i : i + TOGETHER]
            place = np.full(posting.max() + 1, -1)
            place[some] = np.arange(len(some))
            own, query = place[posting] >= 0, place[asked] >= 0
            weights, queries = np.zeros((len(some), self.n)), np.zeros((self.n, len(some)))
            weights[place[posting[own]], doc[own]] = weight[own]
            queries[seed[query], place[asked[query]]] = 1
            out += queries @ weights
        return out

    def against(self, seed: int) -> np.ndarray:
        """The score of every document for the terms of one as query, to nine decimals, so that equal documents get equal ones."""
        own = self.short[seed]
        held = self.held[own]
        at = np.repeat(self.first[own] - np.cumsum(held) + held, held) + np.arange(held.sum())
        return np.round(self.near[seed] + np.bincount(self.doc[at], self.weight[at], minlength=self.n), 9)

    def keep(self, unused: np.ndarray) -> None:
        """Drops the short lists' postings of documents that aren't unused any more; the scores of the others stay as they are."""
        live = unused[self.doc]
        before = np.concatenate([[0], np.cumsum(live)])
        self.doc, self.weight = self.doc[live], self.weight[live]
        self.held = before[self.first + self.held] - before[self.first]
        self.first = before[self.first]


def document_frequencies(batches: Iterable[list[np.ndarray]]) -> np.ndarray:
    """Number of documents that hold each id, over lists of documents given as arrays of ids."""
    found = np.zeros(0, np.int64)
    for docs in batches:
        every = np.concatenate([np.unique(x) for x in docs]) if docs else np.zeros(0, np.int64)
        counts = np.bincount(every, minlength=len(found))
        counts[: len(found)] += found
        found = counts
    return found


def lexical_keys(docs: list[np.ndarray], df: np.ndarray, n: int, mean: float, levels: tuple[int, ...]) -> np.ndarray:
    """A row for each document: for each level its heaviest term by BM25 among those of at least so many documents, -1 where there is none.

    df: documents that hold each id, of n of mean length. Of terms of one weight the least id.
    """
    out = np.full((len(docs), len(levels)), -1, np.int32)
    lengths = np.array([len(x) for x in docs], np.int64)
    if not lengths.sum():
        return out
    key, tf = np.unique(np.concatenate(docs).astype(np.int64) + np.repeat(np.arange(len(docs)) * len(df), lengths), return_counts=True)
    doc, term = np.divmod(key, len(df))
    weight = np.log1p((n - df[term] + 0.5) / (df[term] + 0.5)) * tf * (K1 + 1) / (tf + K1 * (1 - B + B * lengths[doc] / mean))
    starts = np.flatnonzero(np.diff(doc, prepend=-1))
    rank = np.repeat(np.arange(len(starts)), np.diff(starts, append=len(doc)))
    for i, least in enumerate(levels):
        own = np.where(df[term] >= least, weight, 0)
        best = np.flatnonzero((own == np.maximum.reduceat(own, starts)[rank]) & (own > 0))[::-1]
        out[doc[best], i] = term[best]
    return out


def windows(docs: list[np.ndarray], size: int, room: int | None = None, query_terms: int | None = None) -> list[list[tuple[int, int, int]]]:
    """Windows of pieces (document, start, length); all but the last are full. The first holds `room` ids, if that is given."""
    index, unused, following = Index([x[:-1] for x in docs], terms=query_terms) if len(docs) > 1 else None, np.ones(len(docs), bool), 0
    out, now, room, seed, at, scores = [], [], room or size, -1, 0, None
    left = indexed = len(docs)
    opener = -1
    while True:
        if seed < 0:
            if not left:
                break
            seed, at = -1, 0
            if now:  # the window has room: the opener's best unused neighbour
                if scores is None:
                    if left < 0.8 * indexed:
                        index.keep(unused)
                        indexed = left
                    scores = index.against(opener)
                    scores[~unused] = -1
                seed = int(scores.argmax())
                if scores[seed] <= 0:
                    seed = -1
            if seed < 0:
                while not unused[following]:
                    following += 1
                seed = following
            unused[seed] = False
            if scores is not None:
                scores[seed] = -1
            left -= 1
        if not now:
            opener, scores = seed, None
        take = min(room, len(docs[seed]) - at)
        now.append((seed, at, take))
        at, room = at + take, room - take
        if at == len(docs[seed]):
            seed = -1
        if not room:
            out.append(now)
            now, room = [], size
    return [*out, now] if now else out


def powers(window: list[tuple[int, int, int]]) -> list[list[tuple[int, int, int]]]:
    """A window cut into windows whose lengths are powers of two, longest first."""
    total = sum(n for _, _, n in window)
    out, rest = [], list(window)
    for bit in reversed(range(total.bit_length())):
        if not total >> bit & 1:
            continue
        room, now = 1 << bit, []
        while room:
            doc, start, n = rest.pop(0)
            now.append((doc, start, min(n, room)))
            if n > room:
                rest.insert(0, (doc, start + room, n - room))
            room -= min(n, room)
        out.append(now)
    return out


def id_kind(tokenizer: str | None, end_id: int = 0) -> str:
    """The narrowest kind of integer that holds end_id and the ids of a tokenizer."""
    return "<u2" if max(end_id, len(encoder(tokenizer or default_path()).n_bytes) - 1) < 1 << 16 else "<u4"


def by_size(column: pa.Array, most: int) -> Iterator[tuple[int, int]]:
    """(first, number) of the runs of texts that hold about `most` bytes each."""
    run = np.cumsum(pc.binary_length(column).to_numpy(zero_copy_only=False), dtype=np.int64) // most
    edges = np.flatnonzero(np.diff(run, prepend=-1, append=-1)).tolist()
    return ((a, b - a) for a, b in zip(edges, edges[1:], strict=False))


def encoded(docs: DataFrame, end_id: int, tokenizer: str | None) -> DataFrame:
    """(doc_id, ids: those of the whole text and end_id, in the kind id_kind gives), written to the shared folder."""
    path, kind, end = tokenizer or default_path(), id_kind(tokenizer, end_id), np.array([end_id], "<u4").tobytes()

    def ids(batches):
        for batch in batches:
            for i, n in by_size(batch.column("text"), ENCODED):
                some = batch.slice(i, n)
                raw = [np.frombuffer(x + end, "<u4").astype(kind).tobytes() for x in encoder(path).encode(some.column("text").to_pylist())]
                yield pa.RecordBatch.from_arrays([some.column("doc_id"), pa.array(raw, pa.binary())], ["doc_id", "ids"])

    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return stored(rows.mapInArrow(ids, "doc_id long, ids binary"), "token-ids")


def in_lexical_order(ids: DataFrame, shard_docs: int, kind: str) -> DataFrame:
    """ids (doc_id, ids of that kind) with lexical keys, sorted by them over the whole table."""
    width = np.dtype(kind).itemsize

    def terms(batch) -> Iterator[list[np.ndarray]]:
        for i in range(0, batch.num_rows, TOGETHER):
            yield [np.frombuffer(x, kind)[:-1] for x in batch.column("ids").slice(i, TOGETHER).to_pylist()]

    def counted(batches):
        df = document_frequencies(docs for batch in batches for docs in terms(batch))
        held = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(held, pa.int32()), pa.array(df[held], pa.int64())], ["term", "docs"])

    n, total = ids.agg(F.count("*"), F.sum(F.length("ids") / width - 1)).first()
    mean = max(1.0, float(total or 0) / max(1, n))
    rows = ids.mapInArrow(counted, "term int, docs long").groupBy("term").agg(F.sum("docs").alias("docs")).collect()  # as many as the vocabulary has
    df = np.zeros(1 + max((r.term for r in rows), default=0), np.int64)
    df[[r.term for r in rows]] = [r.docs for r in rows]
    levels = (max(2, shard_docs), max(2, shard_docs // 8), 2)

    def keyed(batches):
        for batch in batches:
            found = [lexical_keys(docs, df, n, mean, levels) for docs in terms(batch)]
            keys = pa.array([x for some in found for x in some.tolist()], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([*batch.columns, keys], [*batch.schema.names, "key"])

    own = ids.select("doc_id", "ids", F.xxhash64("doc_id", "ids").alias("tie"))
    order = ["key", "tie", "doc_id"]
    return own.mapInArrow(keyed, KEYED).repartitionByRange(shuffle_partitions(ids.sparkSession), *order).sortWithinPartitions(*order)


def pack(docs: DataFrame, size: int = 1024, shard_docs: int = 1024, shard_tokens: int = 1 << 20, end_id: int = 0, tokenizer: str | None = None, query_terms: int | None = None) -> DataFrame:
    """Pieces of documents in sequences of at most size ids: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""

    kind = id_kind(tokenizer, end_id)
    width = np.dtype(kind).itemsize

    def shards(batches):
        own, held = [], 0
        for batch in batches:
            for doc_id, part, ids in zip(batch.column("doc_id").to_pylist(), batch.column("part").to_pylist(), batch.column("ids").to_pylist(), strict=True):
                own.append((doc_id, part, np.frombuffer(ids, kind)))
                held += len(ids) // width
                if len(own) >= shard_docs or held >= shard_tokens:
                    yield own
                    own, held = [], 0
        if own:
            yield own

    def pieces(batches):
        made, open_, part = 0, [], 0

        def rows(done):
            nonlocal made
            out = []
            for window in done:
                offset = 0
                for doc_id, ids, start, n in window:
                    out.append((doc_id, start, n, zlib.crc32(ids[start : start + n].astype("<u4")), len(ids), (part << 40) + made, offset))
                    offset += n
                made += 1
            return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*out, strict=True)], [x.split()[0] for x in SCHEMA.split(", ")])

        for shard in shards(batches):
            part = shard[0][1]
            filled = windows([ids for _, _, ids in shard], size, size - sum(x[3] for x in open_), query_terms)
            done = [[(shard[d][0], shard[d][2], start, n) for d, start, n in window] for window in filled]
            done[0] = open_ + done[0]
            open_ = done.pop() if sum(x[3] for x in done[-1]) < size else []
            if done:
                yield rows(done)
        if open_:
            yield rows([[(*open_[d][:2], open_[d][2] + start, n) for d, start, n in window] for window in powers([(d, 0, x[3]) for d, x in enumerate(open_)])])

    ordered = in_lexical_order(encoded(docs, end_id, tokenizer), shard_docs, kind)
    return ordered.select("doc_id", "ids", F.spark_partition_id().cast("long").alias("part")).mapInArrow(pieces, SCHEMA)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))

"""Token counts of whole texts by byte-pair merging, without any ids.

A text is cut into pieces, distinct ones are merged once and looked up afterwards. Merging
keeps a piece's symbols in a linked list and its mergeable neighbours in a heap by rank: the
lowest rank is popped and merged until none is left, and the count is the symbols at first less
the merges. So a piece of n bytes takes n log n steps, however long it is.

Pieces come from the tokenizer's own pre-tokenisation. Texts are first cut where that never
joins characters (see `tokens`), so that it runs on the distinct parts only; texts with other
white space go to it whole. An added token in a text counts as one and separates what stands
around it, as in the library.

Defined cases: a null or empty text has no bytes and no tokens; null ids, repeated ids and
repeated rows each give their own row; very long texts are whole; other columns are not read;
an empty table gives an empty result.
"""

from __future__ import annotations

import heapq
import json
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemill.llm.common import table
from lakemill.llm.tokens import MARKS, ODD, default_path

#: Parts in a generation of the cache (there are two), and the longest part that it takes.
CACHED = 700_000
SHORT = 64
#: Parts and texts that are taken together.
TOGETHER = 512


class PairMerges:
    """count(word): the tokens of one pre-tokenised word, given with a character for each byte."""

    def __init__(self, model: dict):
        if model["type"] != "BPE" or any(model.get(x) for x in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges")):
            raise ValueError("only plain byte-level byte-pair models can be counted")
        self.ids = model["vocab"]
        self.rank: dict[tuple[int, int], int] = {}
        self.made: list[int] = []
        for pair in model["merges"]:
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            self.rank[self.ids[a], self.ids[b]] = len(self.made)
            self.made.append(self.ids[a + b])

    def count(self, word: str) -> int:
        ids, rank, made = self.ids, self.rank, self.made
        symbols = [ids[c] for c in word]
        n = len(symbols)
        places = n.bit_length()
        heap = [r << places | i for i, pair in enumerate(zip(symbols, symbols[1:])) if (r := rank.get(pair)) is not None]  # noqa: B905
        if not heap:
            return n
        heapq.heapify(heap)
        after, before, left, mask = list(range(1, n + 1)), list(range(-1, n - 1)), n, (1 << places) - 1
        while heap:
            least = heapq.heappop(heap)
            i = least & mask
            j = after[i]
            if j >= n or (a := symbols[i]) < 0:
                continue
            r, now = least >> places, rank.get((a, symbols[j]))
            if now != r and (now is None or made[now] != made[r]):  # the entry is of symbols that were merged since
                continue
            symbols[i], symbols[j], left = (a := made[r]), -1, left - 1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                if (r := rank.get((a, symbols[k]))) is not None:
                    heapq.heappush(heap, r << places | i)
            if (k := before[i]) >= 0 and (r := rank.get((symbols[k], a))) is not None:
                heapq.heappush(heap, r << places | k)
        return left


def byte_letters(cut) -> dict[str, str]:
    """The character that pre-tokenisation puts for each byte of letters below U+0800, by the byte's latin-1 character."""
    found = {}
    for c in [*map(chr, range(128)), *map(chr, range(0x80, 0x800))]:
        shown = "".join(w for w, _ in cut(c))
        found |= dict(zip(c.encode().decode("latin-1"), shown, strict=True))
    return found


class TokenCounter:
    """counts(texts): the number of tokens of each text."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        tokenizer = Tokenizer.from_file(path)
        if tokenizer.normalizer is not None:
            raise ValueError("the tokenizer must not change texts")
        self.cut = tokenizer.pre_tokenizer.pre_tokenize_str
        self.merges = PairMerges(model)
        self.added = sorted((x.content for x in tokenizer.get_added_tokens_decoder().values()), key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, self.added)) or r"(?!)")
        self.letters = str.maketrans(byte_letters(self.cut))
        self.space = " ".translate(self.letters)
        self.marks = {x: self.whole(x) for x in MARKS}
        self.parts: dict[str, int] = {}
        self.older: dict[str, int] = {}

    def whole(self, text: str) -> int:
        """The tokens of a text, added tokens included."""
        plain = self.special.split(text)
        return len(plain) - 1 + sum(self.merges.count(w) for x in plain if x for w, _ in self.cut(x))

    def learn(self, parts: list[str]) -> list[int]:
        """The counts of parts, each taken after a space unless it begins with a newline; all are cut in one call."""
        some = [x if x[:1] == "\n" else " " + x for x in parts]
        ends = np.cumsum([len(x.encode()) for x in some])
        words = [w for w, _ in self.cut("".join(some))]
        reached = np.cumsum([len(w) for w in words])
        last = np.searchsorted(reached, ends)
        if not np.array_equal(reached[last], ends):
            raise ValueError("a word crosses a space")
        total = np.concatenate([[0], np.cumsum([self.merges.count(w) for w in words])])
        return np.diff(total[np.concatenate([[0], last + 1])]).tolist()

    def of_parts(self, parts: list[str]) -> np.ndarray:
        """The counts of distinct parts. A mark after a letter is a word of its own, and a part of letters is one word."""
        if len(self.parts) > CACHED:
            self.parts, self.older = {}, self.parts
        known, older, letters, space, count = self.parts, self.older, self.letters, self.space, self.merges.count
        out, other = [0] * len(parts), []
        for i, x in enumerate(parts):
            mark = 0
            if x[-1:] in self.marks and len(x) > 1 and x[-2].isalpha() and x[-2] < "ɐ":
                mark, x = self.marks[x[-1]], x[:-1]
            n = known.get(x)
            if n is None:
                n = older.get(x)
                if n is None:
                    if not x.isalpha() or max(x) >= "ɐ":
                        other.append((i, x, mark))
                        continue
                    n = count(space + (x if x.isascii() else x.encode().decode("latin-1").translate(letters)))
                if len(x) <= SHORT:
                    known[x] = n
            out[i] = n + mark
        for k in range(0, len(other), TOGETHER):
            some = other[k : k + TOGETHER]
            for (i, x, mark), n in zip(some, self.learn([x for _, x, _ in some]), strict=True):
                out[i] = n + mark
                if len(x) <= SHORT:
                    known[x] = n
        return np.array(out, np.int64)

    def counts(self, texts: pa.Array) -> np.ndarray:
        """texts: large strings without nulls."""
        odd = pc.or_(pc.match_substring_regex(texts, ODD), pc.equal(pc.binary_length(texts), 0))
        for token in self.added:
            odd = pc.or_(odd, pc.match_substring(texts, token))
        odd = odd.to_numpy(zero_copy_only=False)
        out = np.zeros(len(texts), np.int64)
        for i in np.flatnonzero(odd).tolist():
            out[i] = self.whole(texts[i].as_py())
        plain = np.flatnonzero(~odd)
        if len(plain):
            # A newline in front of each text makes its first part like others; it is one token that is taken off again.
            spaced = pc.replace_substring(pc.binary_join_element_wise(pa.scalar("\n", pa.large_string()), texts.take(pa.array(plain)), pa.scalar("", pa.large_string())), "\n", " \n")
            cut = pc.split_pattern(pc.utf8_slice_codeunits(spaced, 1), " ")
            coded = cut.values.dictionary_encode()
            n = self.of_parts(coded.dictionary.to_pylist())[coded.indices.to_numpy()]
            total = np.concatenate([[0], np.cumsum(n)])
            out[plain] = np.diff(total[cut.offsets.to_numpy()]) - 1
        return out


_counters: dict[str, TokenCounter] = {}


def counter(path: str) -> TokenCounter:
    """The counter for a tokenizer file; a worker keeps it, with its cache, for its later tasks."""
    if path not in _counters:
        _counters[path] = TokenCounter(path)
    return _counters[path]


def token_counts(docs: DataFrame, tokenizer: str | None = None, limit: int = 1024) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit (more than limit tokens) for each row of docs."""
    path = tokenizer or default_path()

    def count(batches):
        for batch in batches:
            for i in range(0, batch.num_rows, TOGETHER):
                some = batch.slice(i, TOGETHER)
                texts = some.column("text").cast(pa.large_string())
                n = counter(path).counts(texts)
                yield pa.RecordBatch.from_arrays([some.column("doc_id"), pc.binary_length(texts).cast(pa.int64()), pa.array(n), pa.array(n > limit)], ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return rows.mapInArrow(count, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"))

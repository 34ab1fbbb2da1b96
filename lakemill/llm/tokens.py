"""Token ids by a public byte-level BPE, fast enough for whole corpora.

Pre-tokenisation never joins characters across a space or newline that stands between two
characters that are no white space, nor a letter with a comma or full stop after it. So a text
is the sequence of its pieces cut before such spaces and newlines, and a piece that ends in a
letter and a mark is its stem and the mark. Pieces that were seen before come from a bounded
cache; the others are encoded together, in one call for many, and told apart by the byte lengths
of their ids. A text with other white space around spaces or newlines goes to the tokenizer whole,
as does one that spells an added token of the vocabulary, such as an end mark. The tokenizer makes
that token of it, unless special_as_text asks for the ids of its characters.
"""

from __future__ import annotations

import os

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

#: The characters that \\s matches in the tokenizer's pattern, and four more that Python counts as such.
SPACES = r"\x{9}-\x{d}\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
ODD = rf"\A[{SPACES}]|[{SPACES}]\z|[{SPACES}][ \n]"
#: Pieces in a generation of the cache; there are two.
CACHED = 450_000
MARKS = ",.;:!?"
TOGETHER = 256


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


class Encoder:
    """encode(texts): for each text its ids as little-endian unsigned 32-bit integers."""

    def __init__(self, path: str, special_as_text: bool = False):
        from tokenizers import Tokenizer

        self.plain = Tokenizer.from_file(path)
        self.plain.encode_special_tokens = True
        self.tokenizer = self.plain if special_as_text else Tokenizer.from_file(path)
        self.added = [] if special_as_text else sorted(x.content for x in self.tokenizer.get_added_tokens_decoder().values())
        vocabulary = self.plain.get_vocab(with_added_tokens=True)
        self.n_bytes = np.zeros(max(vocabulary.values()) + 1, np.int64)
        for token, i in vocabulary.items():
            self.n_bytes[i] = len(token)  # a byte-level token has one character for each byte
        self.cache: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.marks = dict(zip(MARKS, self.whole(list(MARKS), self.plain), strict=True))

    @staticmethod
    def whole(texts: list[str], tokenizer) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def learn(self, pieces: list[str]) -> None:
        """Puts the ids of pieces, each taken after a space unless it begins with a newline, into the cache."""
        for i in range(0, len(pieces), TOGETHER):
            some = [x if x[0] == "\n" else " " + x for x in pieces[i : i + TOGETHER]]
            ids = self.whole(["".join(some)], self.plain)[0]
            reached = np.cumsum(self.n_bytes[np.frombuffer(ids, "<u4")])
            ends = np.cumsum([len(x.encode()) for x in some])
            cuts = np.searchsorted(reached, ends)
            if not np.array_equal(reached[cuts], ends):
                raise ValueError("a token crosses a space")
            a = 0
            for piece, b in zip(pieces[i : i + TOGETHER], ((cuts + 1) * 4).tolist(), strict=True):
                self.cache[piece] = ids[a:b]
                a = b

    def ids_of(self, pieces: list[str]) -> list[bytes]:
        """The ids of distinct pieces."""
        if len(self.cache) > CACHED:
            self.cache, self.older = {}, self.cache
        cache, older, new, marked = self.cache, self.older, set(), []
        for piece in [x for x in pieces if x not in cache]:
            if piece in older:
                cache[piece] = older[piece]
            elif piece[-1] in MARKS and len(piece) > 1 and piece[-2].isalpha() and piece[-2] < "ɐ":
                marked.append(piece)
                new.add(piece[:-1])
            else:
                new.add(piece)
        self.learn([x for x in new if x not in cache])
        for piece in marked:
            cache[piece] = cache[piece[:-1]] + self.marks[piece[-1]]
        return [cache[x] for x in pieces]

    def encode(self, texts: list[str]) -> list[bytes]:
        out: list[bytes] = [b""] * len(texts)
        column = pa.array(texts, pa.large_string())
        found = pc.match_substring_regex(column, ODD)
        for token in self.added:
            found = pc.or_(found, pc.match_substring(column, token))
        whole = found.to_pylist()
        odd = [i for i, x in enumerate(whole) if x]
        plain = [i for i, x in enumerate(whole) if not x and texts[i]]
        for i, ids in zip(odd, self.whole([texts[i] for i in odd], self.tokenizer), strict=True):
            out[i] = ids
        if not plain:
            return out
        # Each text gets a newline in front, one id that is taken off again, so that its first piece is like others.
        cut = pc.split_pattern(pa.array([("\n" + texts[i]).replace("\n", " \n")[1:] for i in plain], pa.large_string()), " ")
        coded = cut.values.dictionary_encode()
        known = self.ids_of(coded.dictionary.to_pylist())
        size = np.fromiter(map(len, known), np.int64, len(known)) // 4
        flat, at = np.frombuffer(b"".join(known), "<u4"), np.cumsum(size) - size
        which = coded.indices.to_numpy()
        n = size[which]
        ends = np.cumsum(n)
        ids = flat[np.repeat(at[which] - ends + n, n) + np.arange(int(ends[-1]))]
        edges = np.concatenate([[0], ends])[cut.offsets.to_numpy()].tolist()
        for i, a, b in zip(plain, edges[:-1], edges[1:], strict=True):
            out[i] = ids[a + 1 : b].tobytes()
        return out


_encoders: dict[tuple, Encoder] = {}


def encoder(path: str, special_as_text: bool = False) -> Encoder:
    """The encoder for a tokenizer file; a worker keeps it, with its cache, for its later tasks."""
    key = (path, special_as_text)
    if key not in _encoders:
        _encoders[key] = Encoder(*key)
    return _encoders[key]

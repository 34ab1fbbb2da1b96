"""Phrase collocations against brute force."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from lakemill.llm import phrases

from .fixtures import SCHEMA, texts

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_force(docs, least=10, share=50, top=2000):
    f, n = defaultdict(Counter), Counter()
    for lang, text in docs:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
            w = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in (1, 2, 3):
                f[lang].update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, counts in f.items():
        often = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        inside = Counter()
        for p, a in often.items():
            if len(p) == 3:
                for part in (p[:2], p[1:]):
                    inside[part] = max(inside[part], a)
        rows = []
        for p, a in often.items():
            if p in inside and 100 * inside[p] >= share * a:
                continue
            score, _, l, r = min((1000000 * a * a // (counts[p[:k]] * counts[p[k:]]), k, counts[p[:k]], counts[p[k:]]) for k in range(1, len(p)))
            rows.append((-score, -a, " ".join(p).encode(), l, r))
        for i, (score, a, p, l, r) in enumerate(sorted(rows)[:top]):
            out.append((lang, i + 1, p.decode(), -a, l, r, n[lang], -score))
    return sorted(out)


def made(seed=4):
    """(lang, text) with hot words, pairs and triples, a hot language, nulls, empties, and a very long text and piece."""
    rng = random.Random(seed)
    some = ["the", "of", "Stone", "river", "light", "É", "漢字", "\xa0x", "a\x1cb", "garden", "winter", "market", "ÀB", "z"]
    docs = [(rng.choice(["en", "en", "en", "fr", None, "und"]), " ".join(rng.choice(some[: rng.randint(2, 14)]) + rng.choice(["", "", "", ".", ",", "\n", ";", "\t", " "]) for _ in range(rng.randint(0, 60)))) for _ in range(150)]
    docs += [("en", "hot pair " * 400), ("en", "same same same " * 300), ("en", " ".join(f"lead to {rng.choice(some)}" for _ in range(300)))]
    docs += [("xx", None), (None, ""), ("fr", " ,.\n\t "), ("yy", "one"), ("en", "x" * 40_000), ("en", " ".join(f"w{rng.randint(0, 3000)}" for _ in range(20_000)))]
    return docs + [(lang, t) for (_, t, _), lang in zip(texts(), ["en", "de"] * 100)]  # noqa: B905


def as_table(spark, docs):
    return spark.createDataFrame([(i % 7 or None, t, "s", lang, None, 3, "id", None, i, 1, "big", None, 5) for i, (lang, t) in enumerate(docs)], SCHEMA)


@pytest.mark.parametrize(("least", "top", "budget"), [(10, 2000, 1 << 20), (10, 25, 300), (2, 60, 40)])
def test_phrases_equal_brute_force(spark, least, top, budget):
    docs = made()
    found = phrases.collocations(as_table(spark, docs).repartition(5), least=least, top=top, budget=budget)
    assert found.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(map(tuple, found.collect())) == brute_force(docs, least, top=top)


def test_phrases_do_not_depend_on_chunks(monkeypatch):
    """Blocks of small chunks, added up group by group in small steps, give the counts of all places."""
    import pyarrow as pa
    import zstandard

    rng = random.Random(6)
    budget, least = 50, 3
    chunks = [np.where(rng_row < 0.1, -1, 0) for rng_row in np.random.default_rng(1).random((6, 400))]
    chunks = [np.where(x < 0, -1, np.array([min(int(rng.expovariate(0.3)), 20) for _ in x])).astype(np.int32) for x in chunks]
    f = Counter(int(v) for x in chunks for v in x if v >= 0)
    ids = {w: i for i, (w, _) in enumerate(f.most_common())}
    starts = dict(zip(ids, np.cumsum([0, *[f[w] for w in ids]])[:-1].tolist()))  # noqa: B905
    grp, parts = {i: starts[w] // budget for w, i in ids.items()}, {i: -(-f[w] // budget) for w, i in ids.items()}
    assert max(parts.values()) > 3 and min(parts.values()) == 1
    blocks = defaultdict(list)
    for x in chunks:
        rows, n = phrases.suffixes(x, np.array([ids.get(w, -1) for w in range(int(x.max()) + 1)], np.int64))
        first = rows[0].tolist()
        for g, kind, columns, counts in phrases.dealt(rows, n, np.array([grp[i] for i in first]), np.array([parts[i] for i in first])):
            blocks[g, kind].append(zstandard.ZstdCompressor().compress(np.stack([*columns, counts]).tobytes()))
    monkeypatch.setattr(phrases, "HELD", 30)
    batches = [pa.RecordBatch.from_arrays([pa.array([g] * len(v), pa.int64()), pa.array([k] * len(v), pa.int32()), pa.array(v, pa.binary())], ["grp", "kind", "data"]) for (g, k), v in sorted(blocks.items())]
    found = Counter()
    for b in phrases._subtrees(least)(batches):
        for r in b.to_pylist():
            key = (r["w1"], r["w2"]) if r["w3"] is None else (r["w1"], r["w2"], r["w3"])
            assert key not in found
            found[key] = r["a"]
    wanted = Counter()
    for x in chunks:
        s = [ids[int(v)] if v >= 0 else None for v in x]
        for k in (2, 3):
            wanted.update(tuple(s[i : i + k]) for i in range(len(s) - k + 1) if None not in s[i : i + k])
    assert found == {p: a for p, a in wanted.items() if a >= least}


def test_rows_add_up_alike_whether_or_not_they_fit_a_key():
    rng = np.random.default_rng(3)
    small = [rng.integers(-1, 9, 500) for _ in range(3)]
    n = rng.integers(1, 5, 500)
    large = [np.where(x < 0, -1, x * (1 << 58)) for x in small]
    rows, total = phrases.added_up(small, n)
    more, again = phrases.added_up(large, n)
    wanted = Counter()
    for *key, k in zip(*(x.tolist() for x in small), n.tolist(), strict=True):
        wanted[tuple(key)] += k
    assert sorted(wanted.items()) == [(tuple(k), t) for *k, t in zip(*(x.tolist() for x in rows), total.tolist(), strict=True)]
    assert all((np.where(a < 0, -1, a * (1 << 58)) == b).all() for a, b in zip(rows, more, strict=True)) and (total == again).all()


def test_words_of_a_text():
    words, codes = phrases.words_of("A b. c\tÉ\x1cx\n\n,a  B".encode())
    assert words.to_pylist() == ["a", "b", "c", "É\x1cx"] and codes.tolist() == [0, 1, -1, 2, 3, -1, 0, 1]
    assert [len(x) for x in phrases.words_of(b" .\n")] == [0, 0]


def test_scores_are_exact_beyond_64_bits(spark):
    from pyspark.sql import functions as F

    a, l, r = 3_000_000_019, 9_000_000_011, 7_000_000_027
    assert spark.createDataFrame([(a, l, r)], "a long, l long, r long").select(phrases._score("a", "l", "r").alias("s")).select(F.col("s").cast("long")).first()[0] == 1000000 * a * a // (l * r)


def test_no_phrases(spark):
    assert phrases.collocations(spark.createDataFrame([], SCHEMA)).count() == 0
    assert phrases.collocations(as_table(spark, [("en", "a b c"), (None, None)])).count() == 0

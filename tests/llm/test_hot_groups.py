"""Hot groups, many chunks, null ids and the whole pipeline."""

import hashlib
import itertools
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from lakemill.llm import exact_dedup, line_dedup, mixing, quality, simhash, substring_dedup, token_store, tokens

from .fixtures import SCHEMA, frame, prose, root_of, same, texts
from .test_operators import plain_fingerprint

SF = "/root/testdata/sf0.001"

# 3: lines


def test_rows_of_different_roots_meet_once(spark):
    rng = random.Random(1)
    rows = [(i, f"g{rng.randint(0, 5)}", i * 7, rng.choice([-5, 1, 1, 1, 2, 3, rng.randint(4, 90)])) for i in range(400)]
    found = line_dedup.between_roots(spark.createDataFrame(rows, "id long, g string, sketch long, root long"), ["g"]).collect()
    wanted = Counter((a[0], b[0]) for a, b in itertools.combinations(rows, 2) if a[1] == b[1] and a[3] != b[3])
    assert Counter((min(r.a, r.b), max(r.a, r.b)) for r in found) == wanted
    assert all(r.ka == 7 * r.a and r.kb == 7 * r.b for r in found)


def test_a_large_family_that_is_joined_meets_strangers_only(spark, monkeypatch):
    """Lines that differ by a number are one family; of their pairs with lines that only resemble them none is lost, and none of their own is formed."""
    monkeypatch.setattr(line_dedup, "CROWD", 50)
    met = []
    plain = line_dedup.between_roots
    monkeypatch.setattr(line_dedup, "between_roots", lambda *a: met.append(plain(*a)) or met[-1])
    template = "the river of stone is crossed by a silver bridge near the harbour in the winter morning light"
    rng = random.Random(2)
    rows = [(i, f"{template} number {i:05d}", "s") for i in range(1500)]
    rows += [(2000 + i, " ".join(w if rng.random() < 0.72 else prose(rng, 1) for w in rows[0][1].split()), "s") for i in range(20)]
    _, roots = line_dedup.line_classes(frame(spark, rows, extra=False))
    ids = {r.id: r.doc_id for r in line_dedup.lines_of(frame(spark, rows, extra=False)).collect()}
    classes = {ids[r.node]: r.root for r in roots.collect()}
    w = line_dedup.WIDTH
    sets = {d: {t[i : i + w] for i in range(len(t) - w + 1)} for d, t, _ in rows}
    assert len({classes[d] for d in range(1500)}) == 1
    for d in range(2000, 2020):
        close = any(len(sets[d] & sets[x]) >= 0.8 * len(sets[d] | sets[x]) for x in range(1500))
        assert (classes.get(d) == classes[0]) == close
    assert sum(m.count() for m in met) < 1500 * 200


# 5: SimHash


def test_a_group_of_many_close_fingerprints_is_met_in_parts(spark, monkeypatch):
    rng = random.Random(3)
    centre = rng.getrandbits(64)
    points = {centre ^ sum(1 << b for b in rng.sample(range(20), rng.randint(0, 9))) for _ in range(500)}  # all in one upper value
    points |= {rng.getrandbits(64) for _ in range(100)}
    points |= {p ^ (1 << rng.randrange(64)) for p in list(points)[:50]}
    points = sorted(points)
    wanted = root_of([(a, b) for i, a in enumerate(points) for b in points[:i] if (a ^ b).bit_count() <= 4], points)
    x = np.array(points, np.uint64)
    largest = []
    flips = simhash._flips
    for most in (1 << 21, 3000, 200):
        monkeypatch.setattr(simhash, "VARIANTS", most)
        monkeypatch.setattr(simhash, "_flips", lambda *a: largest.append(a[0]) or flips(*a))
        a, b = simhash.links_below(x, np.zeros(len(x), int), 64, 2, 4)
        found = root_of(zip(a.view(np.uint64).tolist(), b.view(np.uint64).tolist(), strict=True), points)
        assert found == wanted
    assert max(largest) == 64 and min(largest) < 40


# 7: exact dedup


def test_texts_of_a_few_chunks_keep_them_behind_an_edit(spark):
    rows = [(prose(random.Random(i), 150),) for i in range(120)]
    cut = spark.createDataFrame(rows, "t string").select(exact_dedup.chunks(F.col("t")).alias("c"), exact_dedup.chunks(F.concat(F.lit("An edit. "), "t")).alias("d")).collect()
    cut = [(r.c, r.d) for r in cut if 2 <= len(r.c) <= 5]
    assert len(cut) > 60
    kept = sum(len(set(c) & set(d)) for c, d in cut) / sum(len(c) - 1 for c, d in cut)  # the first chunk holds the edit
    assert kept > 0.9


# 2: token store


def test_parts_of_many_chunks_read_back(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(token_store, "CHUNK", 300)
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokens.default_path())
    rows = [(i, prose(random.Random(i), i % 90), "s") for i in range(200)]
    token_store.write_ids(frame(spark, rows), f"{tmp_path}/ids")
    assert spark.read.parquet(f"{tmp_path}/ids").groupBy("part").count().agg(F.min("count")).first()[0] > 3
    at = 0
    for r, (d, t, _) in zip(token_store.read_ids(spark, f"{tmp_path}/ids").orderBy("start").collect(), rows, strict=True):
        ids = [*tokenizer.encode(t, add_special_tokens=False).ids, 2]
        assert (r.doc_id, r.start, r.n_tokens, bytes(r.ids)) == (d, at, len(ids), np.array(ids, "<u4").tobytes())
        at += len(ids)


# 1: substrings


def test_a_null_id_is_later_than_all_others(spark):
    shared, own = "x".join(f"{i}shared" for i in range(20)), "y".join(f"{i}own" for i in range(20))
    rows = [(None, shared + own, "s"), (5, own + own, "s"), (9, shared, "s"), (None, None, "s")]
    found = substring_dedup.remove_repeats(frame(spark, rows)).collect()
    gone = lambda kept, n: (n - len(kept.encode()), hashlib.sha256(kept.encode()).hexdigest())
    wanted = [(None, *gone("", len(shared + own))), (5, *gone(own + own, 2 * len(own))), (9, *gone(shared, len(shared))), (None, *gone("", 0))]
    assert same([(r.doc_id, r.n_removed, r.kept_sha256) for r in found], wanted)


# the pipeline


def test_the_pipeline_equals_its_stages_by_brute_force(spark):
    found = corpus_pipeline.run(spark, SF).collect()
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    rated = {r.doc_id for r in quality.quality_scores(docs, labels).where("predicted = 1").collect()}
    text = {r.doc_id: r.text or "" for r in docs.collect() if r.doc_id in rated}
    once = {t: max(d for d, x in text.items() if x == t) for t in text.values()}
    prints = {d: plain_fingerprint(text[d]) for d in once.values()}
    root = root_of([(a, b) for a in prints for b in prints if a < b and (prints[a] ^ prints[b]).bit_count() <= 4], prints)
    kept = docs.where(F.col("doc_id").isin(list(set(root.values()))))
    mix = Counter((r.doc_id, r.text) for r in mixing.mixed_documents(kept).collect())
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokens.default_path())
    wanted = Counter()
    for (d, t), n in mix.items():
        wanted[d] += n * (len(tokenizer.encode(t or "", add_special_tokens=False).ids) + 1)
    got, sequences = Counter(), defaultdict(list)
    for r in found:
        got[r.doc_id] += r.length
        sequences[r.sequence_id].append((r.offset, r.length))
    assert got == wanted and len(wanted) > 50
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 1024


def test_the_pipeline_of_an_empty_table(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    docs.limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{SF}/labels.parquet").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


@pytest.mark.parametrize("n", [3])
def test_simhash_of_texts_and_extra_columns(spark, n):
    rows = [r for r in texts() if r[1] is None or len(r[1]) < 3000] * n
    found = simhash.near_copies(spark.createDataFrame([(d, t, s, None, None, 7, "x", None, 1, 1, "b", None, None) for d, t, s in rows], SCHEMA)).collect()
    assert len(found) == len(rows) and all(r.fp % (1 << 64) == plain_fingerprint(t) for (d, t, _) in rows[:20] for r in found if r.doc_id == d and Counter(x for x, _, _ in rows)[d] == n)

"""Each operator against a brute-force version, on documents with every awkward case."""

import hashlib
import random
import re
import time
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import duckdb
import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from lakemill.llm import common, exact_dedup, line_dedup, mixing, neighbours, packing, passage_dedup, quality, queries, simhash, substring_dedup, token_store, tokens

from .fixtures import SCHEMA, frame, prose, root_of, same, texts, words

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def plain_encode():
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokens.default_path())
    return lambda text, end: np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, end], "<u4")


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


# 7: exact dedup


def test_exact_groups_equal_brute_force(spark):
    by_text = defaultdict(list)
    for d, t, _ in texts():
        by_text[t or ""].append(d)
    wanted = []
    for d, t, _ in texts():
        group = by_text[t or ""]
        keep = max((x for x in group if x is not None), default=None)
        wanted.append((d, keep, len(group), d == keep, hashlib.sha256((t or "").encode()).hexdigest()))
    assert same(map(tuple, exact_dedup.exact_groups(frame(spark)).collect()), wanted)
    assert exact_dedup.exact_groups(empty(spark)).count() == 0


def test_exact_identifiers_that_clash_are_replaced(spark):
    weak = lambda chunk: F.length(chunk).cast("long")
    strong = lambda chunk: F.sha2(chunk, 256)
    t = spark.createDataFrame([("ab",), ("cd",)], "text string")
    assert exact_dedup.verified_identifier(t, (weak, strong)) is strong
    with pytest.raises(ValueError):
        exact_dedup.verified_identifier(t, (weak,))


def test_chunks_join_to_the_text(spark):
    rng = random.Random(7)
    scripts = ["".join(rng.choice(alphabet) for _ in range(9000)) for alphabet in ("漢字仮名交文日本語中国", "กขคงจฉชซ", "абвгдежзик ", "🙂🙃😀x")]
    t = frame(spark).select(F.coalesce("text", F.lit("")).alias("t")).union(spark.createDataFrame([(x,) for x in scripts], "t string"))
    cuts = exact_dedup.chunks(F.col("t"))
    assert t.where(F.array_join(cuts, "") != F.col("t")).isEmpty()
    sizes = [(len(r.t), [len(x) for x in r.c]) for r in t.select("t", cuts.alias("c")).collect()]
    for n, own in sizes:
        assert all(exact_dedup.LEAST <= x <= exact_dedup.MOST for x in own[:-1]) and max(own, default=0) <= exact_dedup.MOST
        assert n < 2000 or len(own) > 2


def test_chunks_are_the_same_behind_an_edit(spark):
    text = prose(random.Random(5), 6000)
    rows = spark.createDataFrame([(text,), ("An edit. " + text,), (text[:9000] + "another" + text[9000:],)], "t string").select(exact_dedup.chunks(F.col("t")).alias("c")).collect()
    for r in rows[1:]:
        assert len(set(r.c) & set(rows[0].c)) > 0.7 * len(rows[0].c)


def test_exact_copies_are_dropped_once(spark):
    docs = frame(spark)
    out = exact_dedup.drop_exact_copies(docs)
    assert out.columns == docs.columns
    found = [(r.doc_id, r.text or "") for r in out.collect()]
    best = {}
    for d, t, _ in texts():
        best.setdefault(t or "", []).append(d)
    assert same(found, [(max((x for x in ds if x is not None), default=None), t) for t, ds in best.items()])


# 5: SimHash


def plain_fingerprint(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = words(lower)
    if not w:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(w[i : i + 4]).encode(), 42) for i in range(max(1, len(w) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints_of_long_texts_join_their_runs(monkeypatch):
    text = prose(random.Random(3), 3000).encode()
    whole = simhash.fingerprint(text)
    monkeypatch.setattr(simhash, "word_runs", lambda t: common.word_runs(t, 50))
    assert simhash.fingerprint(text) == whole == plain_fingerprint(text.decode())


def test_simhash_components_equal_brute_force(spark):
    rng = random.Random(5)
    rows = [(d, t, s) for d, t, s in texts() if t is None or len(t) < 20_000]
    prints = [plain_fingerprint(t) for _, t, _ in rows]
    links = [(i, j) for i in range(len(rows)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 4]
    root = root_of(links, range(len(rows)))
    least = {}
    for i, (d, _, _) in enumerate(rows):
        if d is not None:
            least[root[i]] = min(d, least.get(root[i], d))
    rng.shuffle(rows_and := list(enumerate(rows)))
    found = simhash.near_copies(frame(spark, [r for _, r in rows_and])).collect()
    assert same([(r.doc_id, r.fp % (1 << 64), r.component_id) for r in found], [(d, prints[i], least.get(root[i])) for i, (d, _, _) in enumerate(rows)])
    assert simhash.near_copies(empty(spark)).count() == 0


@pytest.mark.parametrize("n", [100, 10**8])
def test_variants_link_what_lies_within_the_radius(spark, n):
    rng = random.Random(n)
    points = [rng.getrandbits(64) for _ in range(60)]
    for p in points[:40]:
        points += [p ^ sum(1 << b for b in rng.sample(range(64), k)) for k in (1, 2, 3, 4, 5)]
    points = sorted(set(points))
    links = [(a, b) for i, a in enumerate(points) for b in points[:i] if (a ^ b).bit_count() <= 4]
    fps = spark.createDataFrame([(p - (1 << 64) if p >> 63 else p,) for p in points], "fp long")
    found = [(r.a % (1 << 64), r.b % (1 << 64)) for r in simhash.variant_links(fps, 4, n).collect()]
    assert all((a ^ b).bit_count() <= 20 for a, b in found)
    assert root_of(found, points) == root_of(links, points)


def test_near_copies_leave_one_document(spark):
    docs = frame(spark)
    out = simhash.drop_near_copies(docs)
    labels = {r.component_id for r in simhash.near_copies(docs).collect()}
    assert out.columns == docs.columns and {r.doc_id for r in out.collect()} == labels


# 4: mixing


def test_mix_meets_its_targets(spark):
    docs = frame(spark)
    out = mixing.mix(docs, block_words=64)
    taken = out["taken"].collect()
    assert same([(r.doc_id, r.size) for r in taken], [(d, len(words(t))) for d, t, _ in texts()])
    assert all(0 <= r.taken <= 3 * r.size for r in taken)
    sources = {r.source: r for r in out["sources"].collect()}
    assert [r.source for r in sorted(sources.values(), key=lambda r: r.s)] == ["B", "a", "b", "hot", "é", None]
    total = sum(r.size for r in taken)
    assert abs(sum(r.target for r in sources.values()) - total) < 1e-6 * total
    by_target = Counter()
    for r in taken:
        by_target[r.target, r.source_size] += r.taken
    for r in sources.values():
        assert r.target <= 3 * r.source_size and abs(by_target[r.target, r.source_size] - r.target) <= 1
    plan = Counter()
    for r in out["schedule"].collect():
        plan[r.s] += r.words
    assert plan == Counter({r.s: r.words for r in sources.values() if r.words})
    again = mixing.mix(docs.repartition(3), block_words=64)["taken"].collect()
    assert same([tuple(r) for r in taken], [tuple(r) for r in again])


def test_schedule_keeps_shares_all_along(spark):
    rows = [(i, "w " * 50, f"s{i % 3}") for i in range(300)]
    out = mixing.mix(frame(spark, rows, extra=False), block_words=10)
    order = [r.s for r in out["schedule"].groupBy("slot").agg(F.first("s").alias("s")).orderBy("slot").collect()]
    for a in range(0, len(order) - 300, 100):
        part = Counter(order[a : a + 300])
        for s, share in ((1, 1 / 6), (2, 2 / 6), (3, 3 / 6)):
            assert abs(part[s] / 300 - share) < 0.02


def test_rows_of_the_mix_and_their_slots_keep_shares_all_along(spark):
    rows = [(i, f"w{i} " * 50, f"s{i % 3}") for i in range(600)]
    docs = frame(spark, rows, extra=False)
    taken = {r.doc_id: r for r in mixing.mix(docs)["taken"].collect()}
    assert all((r.first_slot is None) == (r.taken == 0) and (r.taken == 0 or r.first_slot <= r.last_slot) for r in taken.values())
    order = [r.doc_id % 3 for r in sorted(taken.values(), key=lambda r: (r.first_slot is None, r.first_slot or 0, r.doc_id)) if r.taken]
    mixed = [int(r.text.split()[0][1:]) % 3 for r in mixing.mixed_documents(docs).collect()]
    words_of = Counter()
    for r in mixing.mixed_documents(docs).collect():
        words_of[r.doc_id] += len(words(r.text))
    assert words_of == Counter({d: r.taken for d, r in taken.items() if r.taken}) and len(order) <= len(mixed)
    for a in range(0, len(mixed) - 180, 60):
        part = Counter(mixed[a : a + 180])
        for s, share in ((0, 1 / 6), (1, 2 / 6), (2, 3 / 6)):
            assert abs(part[s] / 180 - share) < 0.13, (a, part)


def test_repeated_rows_of_the_mix_take_no_more_than_the_target(spark):
    rows = [(1, "a b c d e", "x")] * 5 + [(2, "f g h", "y"), (2, "f g h", "z"), (3, "i j", None)]
    docs = frame(spark, rows)
    taken = sum(r.taken for r in mixing.mix(docs)["taken"].collect())
    assert sum(len(words(r.text)) for r in mixing.mixed_documents(docs).collect()) == taken


def test_mix_of_nothing(spark):
    assert mixing.mix(empty(spark))["taken"].count() == 0
    out = mixing.mix(frame(spark, [(1, None, "a"), (2, " ", None)]))["taken"].collect()
    assert same([(r.doc_id, r.target, r.taken, r.first_slot) for r in out], [(1, 0.0, 0, None), (2, 0.0, 0, None)])


def test_mixed_documents_hold_the_words_taken(spark):
    docs = frame(spark)
    taken = Counter()
    for r in mixing.mix(docs)["taken"].collect():
        taken[r.doc_id] += r.taken
    out = mixing.mixed_documents(docs)
    found = Counter()
    for r in out.collect():
        found[r.doc_id] += len(words(r.text))
        assert r.n_chars == len(r.text)
    single = {d for d, n in Counter(d for d, _, _ in texts()).items() if n == 1}
    assert out.columns == docs.columns and all(found[d] == taken[d] for d in single)


# 8 and 2: packing, token store


def test_cached_encoding_equals_the_tokenizer(plain_encode):
    rng = random.Random(9)
    alphabet = list("ab  \n\t\r.,'0é漢  \x1c\x85") + ["the ", " 's", "<|endoftext|>"]
    made = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 40))) for _ in range(3000)] + [t or "" for _, t, _ in texts()]
    coder = tokens.Encoder(tokens.default_path())
    for text, raw in zip(made + made[:50], coder.encode(made) + coder.encode(made[:50]), strict=True):
        assert raw + b"\0\0\0\0" == plain_encode(text, 0).tobytes(), repr(text)


def test_special_tokens_in_texts_are_a_choice(plain_encode):
    text = "an <|endoftext|> inside"
    as_token, as_text = (np.frombuffer(tokens.encoder(tokens.default_path(), x).encode([text])[0], "<u4").tolist() for x in (False, True))
    assert 50256 in as_token and as_token == plain_encode(text, 0).tolist()[:-1]
    assert 50256 not in as_text and tokens.encoder(tokens.default_path()).plain.decode(as_text) == text


def test_packing_places_each_id_once(spark, plain_encode):
    rows = packing.pack(frame(spark), shard_docs=16).collect()
    ids = defaultdict(list)
    for d, t, _ in texts():
        ids[d].append(plain_encode(t, 0))
    lengths, pieces = defaultdict(int), defaultdict(list)
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == lengths[r.sequence_id] and r.length > 0
        lengths[r.sequence_id] += r.length
        pieces[r.doc_id, r.doc_tokens].append(r)
    assert sum(lengths.values()) == sum(len(x) for xs in ids.values() for x in xs)
    assert all(n <= 1024 and n & (n - 1) == 0 for n in lengths.values() if n != 1024)
    for d, xs in ids.items():
        if len(xs) == 1:
            at = 0
            for r in sorted(pieces[d, len(xs[0])], key=lambda r: r.start):
                assert r.start == at and r.ids_crc32 == zlib.crc32(xs[0][at : at + r.length].tobytes())
                at += r.length
            assert at == len(xs[0])
    assert packing.pack(empty(spark)).count() == 0


def test_packing_puts_like_documents_together():
    rng = np.random.default_rng(2)
    topics = [rng.integers(1000 * k, 1000 * k + 60, (10, 100)) for k in range(1, 5)]
    docs = [np.append(topics[i % 4][i // 4], 0).astype("<u4") for i in range(40)]
    made = packing.windows(docs, 404)
    together = [len({d % 4 for d, _, _ in w}) for w in made]
    assert np.mean(together) < 2


def plain_bm25(docs, seed, terms=None):
    n, mean = len(docs), np.mean([len(d) for d in docs])
    df = {t: sum(t in d for d in docs) for t in {t for d in docs for t in d}}

    def weight(t, d):
        tf = d.count(t)
        return np.log1p((n - df[t] + 0.5) / (df[t] + 0.5)) * tf * (packing.K1 + 1) / (tf + packing.K1 * (1 - packing.B + packing.B * len(d) / mean))

    own = sorted((t for t in set(docs[seed]) if 1 < df[t] < n), key=lambda t: -weight(t, docs[seed]))[:terms]
    return [sum(weight(t, d) for t in own if t in d) for d in docs]


def test_packing_queries_have_all_terms():
    rng = np.random.default_rng(6)
    docs = [rng.zipf(1.3, rng.integers(1, 200)).clip(max=400).tolist() for _ in range(40)] + [[], [5], [1, 2, 3] * 400]
    index = packing.Index([np.array(d, "<u4") for d in docs])
    assert max(len(q) for q in index.query) > 40
    unused = np.ones(len(docs), bool)
    for gone in ([], [0, 3, 17, 41], list(range(20, 30)), [42]):
        unused[gone] = False
        index.keep(unused)
        for seed in np.flatnonzero(unused):
            assert np.allclose(index.against(seed)[unused], np.array(plain_bm25(docs, seed))[unused])
    few = packing.Index([np.array([1, 2, 3], "<u4"), np.array([1], "<u4"), np.array([2, 2], "<u4"), np.array([3, 9], "<u4"), np.array([9], "<u4")], terms=1)
    assert len(few.query[0]) == 1


@pytest.mark.parametrize("terms", [None, 5])
def test_packing_adds_long_and_short_lists_alike(monkeypatch, terms):
    rng = np.random.default_rng(9)
    docs = [rng.zipf(1.3, rng.integers(1, 300)).clip(max=400) for _ in range(60)] + [np.arange(1, 40)] * 9 + [np.zeros(0, int)]
    found = []
    for long, together in ((0.5, 500), (8, 7), (1000, 3)):  # no list is long, some are, all are
        monkeypatch.setattr(packing, "LONG", long)
        monkeypatch.setattr(packing, "TOGETHER", together)
        index = packing.Index([d.astype("<u4") for d in docs], terms=terms)
        found.append(np.array([index.against(i) for i in range(len(docs))]))
        assert all(len(set(row[60:69].tolist())) == 1 for row in found[-1])
    assert np.allclose(found[0], found[1]) and np.allclose(found[0], found[2])
    assert found[0].any() and not found[0][69].any()


def test_packing_fills_windows_greedily_whatever_was_dropped():
    rng = np.random.default_rng(8)
    docs = [rng.zipf(1.4, rng.integers(5, 60)).clip(max=300).tolist() for _ in range(120)]
    made = packing.windows([np.array([*d, 0], "<u4") for d in docs], 200)
    unused = set(range(len(docs)))
    for window in made:
        opener = window[0][0]
        unused.discard(opener)
        scores = plain_bm25(docs, opener)
        for d, start, _ in window[1:]:
            best = max((scores[x] for x in unused), default=0)
            assert start == 0 and (scores[d] >= best - 1e-9 if best > 0 else d == min(unused))
            unused.discard(d)
    assert not unused


def test_packing_encodes_by_bytes_not_by_rows():
    sizes = [3, 0, 0, 50, 7, 12_000, 1, 0, 30] * 200
    texts_ = ["x" * n for n in sizes]
    runs = list(packing.by_size(pa.array(texts_), 10_000))
    assert [i for a, n in runs for i in range(a, a + n)] == list(range(len(sizes))) and all(n for _, n in runs)
    assert all(sum(sizes[a : a + n - 1]) < 22_000 for a, n in runs)
    assert [n for _, n in packing.by_size(pa.array(["a short text"] * 3000), packing.ENCODED)] == [3000]
    assert list(packing.by_size(pa.array([], pa.string()), 10)) == [] and list(packing.by_size(pa.array(["", ""]), 10)) == [(0, 2)]


def test_packing_deals_by_content(spark):
    rng = np.random.default_rng(4)
    words = [[f"w{k}x{i}" for i in range(40)] for k in range(8)]
    rows = [(i, " ".join(rng.choice(words[i % 8], 60)), "s") for i in range(320)] + [(1000 + i, "hot copy " * 30, "s") for i in range(160)]
    ordered = packing.in_lexical_order(packing.encoded(frame(spark, rows), 0, None), 40, packing.id_kind(None))
    tasks = [r.ids for r in ordered.groupBy(F.spark_partition_id().alias("p")).agg(F.collect_list("doc_id").alias("ids")).collect()]
    runs = [x[i : i + 20] for x in tasks for i in range(0, len(x), 20)]
    assert np.mean([len({d % 8 if d < 1000 else 8 for d in x}) for x in runs]) < 4  # dealt at random nearly all nine
    assert max(sum(d >= 1000 for d in x) for x in tasks) < 160  # copies fill several tasks
    docs = [np.array(x, np.uint32) for x in ([1, 1, 2], [1, 3], [], [2, 2, 3])]
    df = packing.document_frequencies([docs[:2], docs[2:]])
    assert df.tolist() == [0, 2, 2, 2]
    assert packing.lexical_keys(docs, df, 4, 2.0, (2, 3)).tolist() == [[1, -1], [1, -1], [-1, -1], [2, -1]]


def test_packing_bounds_shards_by_ids(spark):
    few = packing.pack(frame(spark), shard_docs=16, shard_tokens=1).collect()
    assert same([(r.doc_id, r.doc_tokens) for r in few if r.start == 0], [(r.doc_id, r.doc_tokens) for r in packing.pack(frame(spark)).collect() if r.start == 0])
    lengths = defaultdict(int)
    for r in few:
        lengths[r.sequence_id] += r.length
    short = [n for n in lengths.values() if n != 1024]
    assert all(n & (n - 1) == 0 for n in short) and len(short) <= 10 * 8


def test_token_store_round_trip(spark, plain_encode, tmp_path):
    for ids in ([], [0], [50256] * 70_000, list(range(70_000)), [2**32 - 1, 0]):
        raw = np.array(ids, "<u4").tobytes()
        assert token_store.from_planes(token_store.to_planes(raw)) == raw
    token_store.write_ids(frame(spark), f"{tmp_path}/ids")
    found = token_store.read_ids(spark, f"{tmp_path}/ids").orderBy("start").collect()
    keys = [(r.doc_id is not None, r.doc_id or 0) for r in found]
    assert keys == sorted(keys)
    at = 0
    for r in found:
        assert r.start == at and r.n_tokens == len(r.ids) // 4
        at += r.n_tokens
    assert same([(r.doc_id, bytes(r.ids)) for r in found], [(d, plain_encode(t, 2).tobytes()) for d, t, _ in texts()])
    token_store.write_ids(empty(spark), f"{tmp_path}/none")
    assert token_store.read_ids(spark, f"{tmp_path}/none").count() == 0


def test_token_chunks_hold_whole_documents(spark, tmp_path, monkeypatch):
    token_store.write_ids(frame(spark), f"{tmp_path}/ids")
    store = spark.read.parquet(f"{tmp_path}/ids")
    assert store.where("n_ids <> aggregate(doc_tokens, 0L, (a, x) -> a + x)").isEmpty()
    assert store.where(F.size("planes") != 4 * F.ceil(F.col("n_ids") / token_store.BLOCK)).isEmpty()


# 1: substrings


def test_substrings_equal_brute_force(spark):
    rows = [(d, t, s) for d, t, s in texts() if d is not None]
    order = sorted({d for d, _, _ in rows})
    seen, wanted = set(), []
    for d in order:
        own = set()
        for _, t, _ in (r for r in rows if r[0] == d):
            raw = (t or "").encode()
            gone = np.zeros(len(raw), bool)
            for i in range(len(raw) - 49):
                if raw[i : i + 50] in seen:
                    gone[i : i + 50] = True
                own.add(raw[i : i + 50])
            kept = bytes(np.frombuffer(raw, np.uint8)[~gone])
            wanted.append((d, len(raw), int(gone.sum()), int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum()), hashlib.sha256(kept).hexdigest(), kept))
        seen |= own
    found = substring_dedup.remove_repeats(frame(spark, rows)).collect()
    assert same([(*r[:5], bytes(r.kept)) for r in found], wanted)
    assert substring_dedup.remove_repeats(empty(spark)).count() == 0


def test_keys_of_many_blocks_are_compared_in_one_sort():
    rng = np.random.default_rng(5)
    for size, n, of in ((0, 3, 9), (4, 6, 20), (7, 5, 200)):
        lists = [np.sort(rng.choice(of, size, replace=False)).astype(np.uint64) for _ in range(n)]
        twice = [rng.random(size) < 0.2 for _ in lists]
        lists[1], twice[1] = lists[1][:0], twice[1][:0]
        count = Counter(k for x in lists for k in x.tolist())
        marked = {k for x, t in zip(lists, twice, strict=True) for k in x[t].tolist()}
        wanted = [[count[k] > 1 or k in marked for k in x.tolist()] for x in lists]
        assert [x.tolist() for x in substring_dedup.in_several(lists, twice)] == wanted
    lists = [rng.integers(0, 1 << 22, 320).astype(np.uint64) for _ in range(2400)]  # a bucket as of 6 GB
    began = time.process_time()
    substring_dedup.in_several(lists, [np.zeros(320, bool)] * len(lists))
    assert time.process_time() - began < 5  # a search of all shared keys for each list takes far longer


def test_substrings_across_tiles(spark, monkeypatch):
    rng = random.Random(4)
    shared = "".join(rng.choice("abcdef") for _ in range(50))
    block = lambda: substring_dedup.Block([0, 1], [("x" * 3 + shared + "y").encode() * 30, (shared * 2).encode()], 50)
    whole = block()
    monkeypatch.setattr(substring_dedup, "TILE", 17)
    tiled = block()
    assert whole.pos.tolist() == tiled.pos.tolist() and whole.keys.tolist() == tiled.keys.tolist()


# 3: lines


def test_lines_equal_brute_force(spark):
    rows = [(d, t, s) for d, t, s in dict.fromkeys(texts()) if d is not None and (d, t) not in {(410, texts()[5][1])}]
    rows = list({(d, t): (d, t, s) for d, t, s in rows}.values())
    once = [r for r in rows if Counter(d for d, _, _ in rows)[r[0]] == 1]
    lines = [(d, i, x) for d, t, _ in sorted(once, key=lambda r: r[0]) for i, x in enumerate((t or "").split("\n")) if words(x)]
    distinct = list(dict.fromkeys(x for _, _, x in lines))
    w = line_dedup.WIDTH
    sets = [{x[i : i + w] for i in range(max(1, len(x) - w + 1))} for x in distinct]
    links = [(i, j) for i in range(len(sets)) for j in range(i) if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])]
    root, place, kept, gone = root_of(links, range(len(sets))), {x: i for i, x in enumerate(distinct)}, set(), defaultdict(list)
    for d, i, x in lines:
        if root[place[x]] in kept:
            gone[d].append(i)
        kept.add(root[place[x]])
    found = {r.doc_id: r.removed for r in line_dedup.removed_lines(frame(spark, once)).collect()}
    assert found == dict(gone)
    assert line_dedup.removed_lines(empty(spark)).count() == 0


def test_lines_are_taken_out_of_texts(spark):
    rows = [(1, "a first line of it\n\nanother line altogether", "s"), (2, "head of this one\na first line of it\n", "s"), (2, "another line altogether", "s"), (None, "head of this one", "s")]
    docs = frame(spark, rows)
    out = line_dedup.without_repeated_lines(docs)
    assert out.columns == docs.columns
    assert same([(r.doc_id, r.text) for r in out.collect()], [(1, rows[0][1]), (2, "head of this one\n"), (2, ""), (None, "")])


@pytest.mark.parametrize(("clusters", "crowd"), [(8, 1024), (60, 32)])
def test_lines_of_a_crowded_band_meet_their_like(spark, monkeypatch, clusters, crowd):
    """All lines share one band; clusters are chains whose ends aren't similar."""
    monkeypatch.setattr(line_dedup, "CROWD", crowd)
    of = line_dedup.band_keys
    monkeypatch.setattr(line_dedup, "band_keys", lambda once: of(once).select("id", F.lit(7).alias("key"), "sketch").distinct())
    rng = random.Random(3)
    rows = []
    for c in range(clusters):
        line = [f"{c}w{rng.randrange(10**6)}" for _ in range(40)]
        for i in range(3):
            rows.append((len(rows), " ".join(line), "s"))
            line[12 * i] = "changed"
            line[12 * i + 5] = "altered"
    found = {r.doc_id for r in line_dedup.removed_lines(frame(spark, rows, extra=False)).collect()}
    assert found == {d for d, _, _ in rows if d % 3}


def test_lines_of_large_families_keep_their_links(spark):
    """40 families of 60 lines from one template each, most pairs of which aren't similar."""
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(2, 9)))
    w, rows, links, pairs = line_dedup.WIDTH, [], [], 0
    for _ in range(40):
        template = [word() for _ in range(40)]
        own = []
        for _ in range(60):
            line = list(template)
            for at in rng.sample(range(40), rng.randint(1, 4)):
                line[at] = word()
            t = " ".join(line)
            own.append((len(rows), {t[i : i + w] for i in range(len(t) - w + 1)}))
            rows.append((len(rows), t, "s"))
        links += [(a, b) for i, (b, y) in enumerate(own) for a, x in own[:i] if len(x & y) >= 0.8 * len(x | y)]
    root = root_of(links, range(len(rows)))
    _, found = line_dedup.line_classes(frame(spark, rows, extra=False))
    ids = {r.id: r.doc_id for r in line_dedup.lines_of(frame(spark, rows, extra=False)).collect()}
    classes = {ids[r.node]: r.root for r in found.collect()}
    joined = sum(classes.get(a, a) == classes.get(b, b) for a, b in links)
    assert len(links) > 500 and joined >= 0.99 * len(links), (joined, len(links))
    removed = sum(len(r.removed) for r in line_dedup.removed_lines(frame(spark, rows, extra=False)).collect())
    assert removed <= sum(root[d] != d for d in root) <= removed + 5
    print("pairs", len(links), "joined", joined, "removed", removed)


def test_lines_with_one_changed_character_equal_brute_force(spark, tmp_path):
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(2, 9)))
    rows = [(0, "short", "s"), (1, "é🙂🙂", "s")]
    for i in range(150):
        line = " ".join(word() for _ in range(rng.choice([8, 12, 16, 25])))
        at = rng.randrange(len(line))
        rows += [(2 * i + 2, line, "s"), (2 * i + 3, line[:at] + "#" + line[at + 1 :], "s")]
    rows.append((500, "x" + "0123456789abcdefghijklmnopqrstuvwxyz" * 4, "s"))
    rows.append((501, "y" + "0123456789abcdefghijklmnopqrstuvwxyz" * 4, "s"))
    w = line_dedup.WIDTH
    sets = [{t[i : i + w] for i in range(max(1, len(t) - w + 1))} for _, t, _ in rows]
    links = [(rows[j][0], rows[i][0]) for i in range(len(rows)) for j in range(i) if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])]
    assert len(links) > 100
    root = root_of(links, [d for d, _, _ in rows])
    frame(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    found = {r.doc_id: r.n_removed for r in line_dedup.query(spark, str(tmp_path)).collect()}
    wanted = {d: int(root[d] != d) for d, _, _ in rows}
    missed = sum(found[d] != n for d, n in wanted.items())
    assert missed <= 2 and all(found[d] <= n for d, n in wanted.items())  # a pair at 0.8 has a common band with 0.997


# 6: passages


def test_passages_of_over_fifty_words_link_documents(spark):
    rows = [(d, t, s) for d, t, s in dict.fromkeys(texts()) if d != 409]
    seen = defaultdict(set)
    for d, t, _ in rows:
        w = words(t)
        for i in range(len(w) - 49):
            if d is not None:
                seen[tuple(w[i : i + 50])].add(d)
    links = [(min(g), x) for g in seen.values() for x in g]
    root = root_of(links, {d for d, _, _ in rows if d is not None})
    found = {r.doc_id: r.component_id for r in passage_dedup.passage_classes(frame(spark, rows)).collect()}
    assert set(found) == {d for d, _, _ in rows}
    for d, r in root.items():
        assert found[d] == found[r]
    assert found[400] == 400 and found[403] == 403 and found[None] is None
    assert passage_dedup.passage_classes(empty(spark)).count() == 0


def test_passages_find_near_copies_and_leave_others(spark):
    rng = random.Random(8)
    vocabulary = [f"w{i}" for i in range(3000)]
    text = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    rows, expected = [], []
    for i in range(60):
        passage = text(120)
        near = list(passage)
        near[rng.randrange(20)] = "changed"
        near.insert(60, "inserted")
        rows += [(2 * i, " ".join(text(80) + passage + text(40)), "s"), (2 * i + 1, " ".join(text(30) + near + text(100)), "s")]
        expected.append((2 * i, 2 * i + 1))
    found = {r.doc_id: r.component_id for r in passage_dedup.passage_classes(frame(spark, rows, extra=False)).collect()}
    hit = sum(found[b] == a for a, b in expected)
    assert hit >= 59 and len(set(found.values())) == 120 - hit  # nothing else is linked
    text_of = {d: t.split() for d, t, _ in rows}
    for r in passage_dedup.passage_links(frame(spark, rows, extra=False)).collect():
        x, y = text_of[r.a][r.a_word : r.a_word + r.a_words], text_of[r.b][r.b_word : r.b_word + r.b_words]
        p, q = (set(zip(*(w[i:] for i in range(5)))) for w in (x, y))
        assert min(len(x), len(y)) >= 50 and len(p & q) >= 0.8 * len(p | q)


def test_passages_of_two_that_share_most_of_it_with_many_others(spark):
    rng = random.Random(21)
    text = lambda n: [f"w{rng.randrange(10**7)}" for _ in range(n)]
    common, rows = text(40), []
    for i in range(40):  # 52 words in common; with the others 40, of a similarity of 0.6
        passage = common + text(12)
        rows += [(d, " ".join(text(60) + passage + text(60)), "s") for d in (i, 1000 - i)]
    found = {r.doc_id: r.component_id for r in passage_dedup.passage_classes(frame(spark, rows, extra=False)).collect()}
    assert found == {d: min(d, 1000 - d) for d, _, _ in rows}


def test_passages_of_joined_families_do_not_meet_on_a_common_phrase(spark, monkeypatch):
    met = []
    plain = passage_dedup.between_roots
    monkeypatch.setattr(passage_dedup, "between_roots", lambda *a: met.append(plain(*a)) or met[-1])
    rng = random.Random(22)
    text = lambda n: [f"w{rng.randrange(10**7)}" for _ in range(n)]
    phrase, rows = text(13), []
    for i in range(30):
        own = text(50) + phrase + text(50)
        rows += [(3 * i + k, " ".join(text(20) + own + text(20)), "s") for k in range(3)]
    found = {r.doc_id: r.component_id for r in passage_dedup.passage_classes(frame(spark, rows, extra=False)).collect()}
    assert found == {d: d // 3 * 3 for d, _, _ in rows}
    assert sum(m.count() for m in met) == 0


@pytest.mark.parametrize("kinds", [5, 15, 40])
def test_passages_that_lack_little_are_never_refused(kinds):
    rng = np.random.default_rng(kinds)
    for _ in range(150):
        n, least = int(rng.integers(1, 60)), int(rng.integers(2, 12))
        seq, others = rng.integers(0, kinds, n).astype("<u4"), rng.choice(40, rng.integers(0, 40), replace=False)
        parts = lambda x, y, least=least, seq=seq: [set(seq[i:j].tolist()) for i in range(x, y) for j in range(i + least, y + 1)]
        held = np.isin(seq, others)
        assert passage_dedup.distinct(seq, least).tolist() == [len(set(seq[i : i + least].tolist())) for i in range(n - least + 1)]
        if any(len(p & set(others.tolist())) >= 0.8 * len(p) for p in parts(0, n)):
            assert passage_dedup.room_for(seq, held, least, 0.8)
            assert passage_dedup.stretches(passage_dedup.first_places(seq) & ~held, np.zeros(n, bool), least, 0.8)[-1] > 0


@pytest.mark.parametrize("kinds", [3, 6, 30])
def test_stretches_count_distinct_shingles(kinds):
    rng = np.random.default_rng(kinds)
    for _ in range(60):
        n, least = int(rng.integers(1, 40)), int(rng.integers(2, 7))
        seq, missing, gap = rng.integers(0, kinds, n), rng.random(n) < 0.2, rng.random(n) < 0.05
        missing &= ~gap
        before = passage_dedup.earlier(seq)
        assert before.tolist() == [max((j for j in range(i) if seq[j] == seq[i]), default=-1) for i in range(n)]
        fits = lambda a, b: b <= n and not gap[a:b].any() and missing[a:b].sum() <= 0.2 * len(set(seq[a:b].tolist())) + 1e-9  # noqa: B023, E731
        wanted = [any(fits(a, a + size) for size in range(least, 2 * least)) for a in range(n)]
        assert np.diff(passage_dedup.stretches(missing, gap, least, 0.8, before)).tolist() == wanted


def test_runs_of_common_words_open_no_windows():
    rng = random.Random(31)
    kinds = [f"k{i}" for i in range(30)]
    texts = [" ".join(w for _ in range(12) for w in [rng.choice(kinds) + f" x{rng.randrange(10**9)}"] for w in [w.split()[0]] * 18 + [w.split()[1]]) for _ in range(40)]
    block = passage_dedup.Block(list(range(40)), [t.encode() for t in texts], 46)
    assert not len(block.windows(block.twice(), 0.8, 6)[0])  # other documents hold the runs, not what lies between them


def test_passage_beside_longer_runs_of_common_words_is_verified():
    code = lambda *runs: passage_dedup.shingles(" ".join(" ".join([w] * n) for w, n in runs).encode()).astype("<u4").tobytes()
    one = code(("le", 135), ("sur", 135), ("de", 135), ("la", 135), ("et", 1), ("de", 1), ("au", 1))
    other = code(("ra", 37), ("de", 37), ("la", 37), ("de", 37), ("ue", 37), ("de", 37))
    e, f, g, h = passage_dedup.similar(one, other, 46, 0.8)
    a, b = (set(np.frombuffer(x, "<u4")[i:j].tolist()) for x, i, j in ((one, e, f), (other, g, h)))
    assert min(f - e, h - g) >= 46 and len(a & b) >= 0.8 * len(a | b)


@pytest.mark.parametrize("seed", range(4))
def test_passages_in_order_are_verified_exactly(seed):
    rng, least = random.Random(seed), 12
    verdicts = Counter()
    for _ in range(60):
        a = list(range(45))
        b = [rng.randrange(1000, 10**6) if rng.random() < 0.18 else x for x in a if rng.random() > 0.03]
        u, v = (np.array(x, "<u4") for x in (a, b))
        alike = lambda p, q: len(p & q) >= 0.8 * len(p | q)
        wanted = any(alike(set(a[i:j]), set(b[k:m])) for i in range(45) for j in range(i + least, 46) for k in range(max(0, i - 6), min(len(b), i + 7)) for m in range(k + least, min(len(b), k + (j - i) * 5 // 4 + 1) + 1))
        found = passage_dedup.similar(u.tobytes(), v.tobytes(), least, 0.8)
        verdicts[wanted] += 1
        if found:
            e, f, g, h = found
            assert min(f - e, h - g) >= least and alike(set(a[e:f]), set(b[g:h]))
        else:
            assert not wanted
    assert min(verdicts[True], verdicts[False]) > 3


def test_passage_of_a_very_long_text_links_it(spark):
    rng = random.Random(12)
    word = lambda: f"w{rng.randrange(10**7)}"
    long, other = [word() for _ in range(20_000)], [word() for _ in range(300)]
    rows = [(1, " ".join(long), "s"), (2, " ".join(other), "s"), (3, " ".join(other[:100] + long[12_000:12_060] + other[100:110]), "s"), (4, " ".join(word() for _ in range(400)), "s")]
    found = {r.doc_id: r.component_id for r in passage_dedup.passage_classes(frame(spark, rows, extra=False)).collect()}
    assert found == {1: 1, 2: 1, 3: 1, 4: 4}  # the 100 words of 2 in 3 are a passage too


@pytest.mark.parametrize("n", [50, 55, 60, 70])
def test_an_edit_at_any_place_of_a_short_passage_is_verified(n):
    rng = random.Random(n)
    word = lambda: f"w{rng.randrange(10**9)}"
    code = lambda w: passage_dedup.shingles(" ".join(w).encode()).astype("<u4").tobytes()
    least = 46
    for at in range(n):
        passage = [word() for _ in range(n)]
        near = [*passage[:at], "changed", *passage[at + 1 :]]
        a, b = set(zip(*(passage[i:] for i in range(5)))), set(zip(*(near[i:] for i in range(5))))
        assert len(a & b) >= 0.8 * len(a | b)
        one, two = ([word() for _ in range(30)] + p + [word() for _ in range(20)] for p in (passage, near))
        assert passage_dedup.similar(code(one), code(two), least, 0.8) is not None, at
    assert not passage_dedup.similar(code([word() for _ in range(90)]), code([word() for _ in range(90)]), least, 0.8)


# 9: neighbours


def vectors(n=1200, d=16):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(n, d)).astype(np.float32) * rng.uniform(0.5, 2, (n, 1)).astype(np.float32)
    x[300:700] = x[300]  # a hot vector
    rows = [(i, x[i].tolist()) for i in range(n)]
    rows[10], rows[20], rows[30], rows[40] = (10, None), (20, [0.0] * d), (30, [None, *[1.0] * (d - 1)]), (40, [float("nan"), *[1.0] * (d - 1)])
    return [*rows, (50, [float("inf")] * d), (60, [1.0, 2.0]), rows[80]], x


def test_neighbours_recall_and_ties(spark):
    rows, x = vectors()
    found = neighbours.nearest(spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<float>, item int"), F.col("vec_id") % 20 == 0).collect()
    live = [i for i in range(1200) if i not in (10, 20, 30, 40)]
    hits = total = 0
    got = defaultdict(list)
    for r in sorted(found, key=lambda r: (r.query_id, r.rank)):
        assert abs(r.score - float(x[r.query_id].astype(float) @ x[r.vec_id].astype(float))) < 1e-9
        got[r.query_id].append((-r.score, r.vec_id))
    assert set(got) == {i for i in live if i % 20 == 0}
    for q, own in got.items():
        assert own == sorted(own) and len(own) == 20 and q not in {v for _, v in own}
        best = sorted((-float(x[q].astype(float) @ x[i].astype(float)), i) for i in live if i != q)[:20]
        hits, total = hits + len({v for _, v in own} & {v for _, v in best}), total + 20
    assert hits / total >= 0.9
    assert [v for _, v in got[300]] == list(range(301, 321)) or got[300][0][0] < -float(x[300].astype(float) @ x[300].astype(float))


def test_neighbours_of_few_vectors(spark):
    schema = "vec_id long, embedding array<float>"
    q = F.col("vec_id") % 20 == 0
    assert neighbours.nearest(spark.createDataFrame([], schema), q).count() == 0
    assert neighbours.nearest(spark.createDataFrame([(0, None)], schema), q).count() == 0
    found = neighbours.nearest(spark.createDataFrame([(0, [1.0, 0.0]), (3, [1.0, 1.0]), (2, [1.0, 1.0])], schema), q).collect()
    assert [(r.query_id, r.rank, r.vec_id, r.score) for r in sorted(found, key=lambda r: r.rank)] == [(0, 1, 2, 1.0), (0, 2, 3, 1.0)]


def test_neighbours_in_small_lists_get_all_their_rows(spark):
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(60, 16))
    x = np.repeat(centres / np.linalg.norm(centres, axis=1)[:, None], 5, axis=0) + rng.normal(size=(300, 16)) * 1e-4
    t = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    found = neighbours.nearest(t, F.col("vec_id") % 20 == 0, list_size=4).groupBy("query_id").count().collect()
    assert {r.query_id: r["count"] for r in found} == {i: 20 for i in range(0, 300, 20)}


# 10: quality


def test_quality_on_held_out_rows(spark):
    base = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{base}/{t}.parquet") for t in ("documents", "labels"))
    out = quality.quality_scores(docs, labels)
    rows = out.join(labels, "doc_id").collect()
    assert out.count() == docs.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    held = [r for r in rows if r.held_out]
    ones, zeros = [r.score for r in held if r.quality], [r.score for r in held if not r.quality]
    area = np.mean([[(a > b) + 0.5 * (a == b) for b in zeros] for a in ones])
    assert area > 0.95 and np.mean([r.predicted == r.quality for r in held]) > 0.95


def test_quality_scores_every_row(spark):
    docs = frame(spark)
    schema = "doc_id long, quality int, stats int"
    none = quality.quality_scores(docs, spark.createDataFrame([], schema)).collect()
    assert len(none) == len(texts()) and all(r.score == 0.5 for r in none)
    labels = spark.createDataFrame([(d, None if i % 7 == 3 else i % 2, 0) for i, (d, _, _) in enumerate(texts())], schema)
    assert all(0 <= r.score <= 1 for r in quality.quality_scores(docs, labels).collect())
    assert quality.quality_scores(empty(spark), labels).count() == 0
    assert quality.keep_quality(docs, labels).columns == docs.columns


def test_quality_of_null_ids(spark):
    labels = spark.createDataFrame([(d, i % 2) for i, (d, _, _) in enumerate(texts())], "doc_id long, quality int")
    found = quality.quality_scores(frame(spark), labels).collect()
    assert sum(r.doc_id is None for r in found) == 2 and all(r.held_out is False for r in found if r.doc_id is None)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in found if r.doc_id is not None)


def test_quality_fit_equals_one_machine(spark):
    base = "/root/testdata/sf0.001"
    docs, labels = (spark.read.parquet(f"{base}/{t}.parquet").repartition(5) for t in ("documents", "labels"))
    model = quality.fit(docs, labels)
    rows = quality.training_rows(docs, labels).collect()
    stats, y, fold = (np.array([r[i] for r in rows], float) for i in range(3))
    assert np.allclose(model.mean, stats.mean(axis=0)) and np.allclose(model.scale, np.where(stats.std(axis=0) > 1e-9, stats.std(axis=0), 1))
    z = model.features(stats)
    solve = lambda some: np.linalg.lstsq(np.vstack([z[some], np.sqrt(0.5) * np.eye(z.shape[1])]), np.append(y[some], np.zeros(z.shape[1])), rcond=None)[0]
    assert np.allclose(model.weights, solve(np.ones(len(y), bool)), atol=1e-6)
    raw = np.array([z[i] @ solve(fold != fold[i]) for i in range(len(y))])
    at = np.clip((raw + 0.5) / 2 * quality.BINS, 0, quality.BINS - 1).astype(int)
    bins = np.unique(at)
    level = quality.isotonic(np.array([y[at == b].sum() for b in bins]), np.array([(at == b).sum() for b in bins], float))
    assert np.allclose(model.knots[0], (bins + 0.5) / quality.BINS * 2 - 0.5) and np.allclose(model.knots[1], level)
    # the features' inner products approximate the kernel exp(-|x - y|^2 / number of statistics)
    x = np.clip((stats - model.mean) / model.scale, -6, 6)
    kernel = np.exp(-((x[:, None] - x[None, :]) ** 2).sum(axis=2) / quality.N_STATS)
    f = z[:, : len(model.phases)]
    assert np.abs(f @ f.T - kernel).mean() < 0.1


def test_quality_trains_on_a_bounded_sample(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("some text").alias("text"))
    labels = docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("quality"))
    n = quality.training_rows(docs, labels, max_rows=500).count()
    assert 400 < n < 600 and 2200 < quality.training_rows(docs, labels).count() < 2600


def test_isotonic_is_the_nearest_monotone_fit():
    level = quality.isotonic(np.array([0, 2, 1, 3.0]), np.array([2, 2, 2, 3.0]))
    assert level.tolist() == [0, 0.75, 0.75, 1]


def test_labels_of_held_out_rows_and_bound_do_not_train(spark):
    base = "/root/testdata/sf0.001"
    docs, labels = (spark.read.parquet(f"{base}/{t}.parquet") for t in ("documents", "labels"))
    flipped = labels.withColumn("quality", F.when(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = (sorted(map(tuple, quality.quality_scores(docs, x).collect())) for x in (labels, flipped))
    assert a == b


# components, pipeline, queries


def test_components_equal_union_find(spark):
    rng = random.Random(6)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(330)] + [(1000 + i, 1001 + i) for i in range(40)] + [(2000, 2001 + i) for i in range(50)]
    nodes = {x for a, b in edges if a != b for x in (a, b)}
    root = root_of(edges, nodes)
    found = common.components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert same([(r.node, r.root) for r in found], root.items())


def test_forest_connects_the_same():
    rng = np.random.default_rng(3)
    a, b = rng.integers(0, 300, 250), rng.integers(0, 300, 250)
    x, y = common.forest(a, b)
    nodes = set(a.tolist()) | set(b.tolist())
    assert len(x) < len(nodes) and root_of(zip(x.tolist(), y.tolist(), strict=True), nodes) == root_of(zip(a.tolist(), b.tolist(), strict=True), nodes)


def test_stages_take_and_give_documents(spark):
    docs = frame(spark)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns, name
        docs = common.stored(out, name)
    assert {"doc_id", "sequence_id"} <= set(corpus_pipeline.STAGES[-1][1](spark, docs, SF).columns)
    assert len(corpus_pipeline.STAGES) == 5


def test_first_stages_keep_what_their_operators_say(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    (_, rate), (_, once), (_, near) = corpus_pipeline.STAGES[:3]
    kept = rate(spark, docs, SF)
    said = {r.doc_id for r in quality.quality_scores(docs, labels).where("predicted = 1").collect()}
    assert {r.doc_id for r in kept.collect()} == said and len(said) > 100
    texts_of = {r.doc_id: r.text for r in kept.collect()}
    best = {t: max(d for d, x in texts_of.items() if x == t) for t in texts_of.values()}
    unique = once(spark, kept, SF)
    assert {r.doc_id for r in unique.collect()} == set(best.values())
    prints = {d: plain_fingerprint(texts_of[d]) for d in best.values()}
    root = root_of([(a, b) for a in prints for b in prints if a < b and (prints[a] ^ prints[b]).bit_count() <= 4], prints)
    assert {r.doc_id for r in near(spark, unique, SF).collect()} == set(root.values())


def test_stages_of_an_empty_table(spark):
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty(spark), SF).count() == 0, name


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_gives_what_sql_gives(spark, name):
    con = duckdb.connect()
    for p in Path(SF).glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM read_parquet('{p}')")
    rel = con.execute(queries.ORACLE[name])
    columns = sorted(d[0] for d in rel.description)
    wanted = con.execute(f"SELECT {', '.join(columns)} FROM ({queries.ORACLE[name]})").fetchall()
    found = queries.QUERIES[name](spark, SF).select(*columns).collect()
    assert same([tuple(r) for r in found], wanted)

"""Token counts and conversation repair against the library and brute force."""

import functools
import hashlib
import random
import re
import zlib
from collections import defaultdict

import pyarrow as pa
import pytest

from lakemill.llm import conversations, queries, token_counts, tokens

from .fixtures import SCHEMA, frame, texts

# 13: token counts


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokens.default_path())
    return lambda text: len(tokenizer.encode(text or "", add_special_tokens=False).ids)


def test_token_counts_equal_the_library(spark, library):
    found = token_counts.token_counts(frame(spark), limit=1000).collect()
    wanted = [(d, len((t or "").encode()), library(t), library(t) > 1000) for d, t, _ in texts()]
    assert sorted(map(repr, map(tuple, found))) == sorted(map(repr, wanted))
    assert token_counts.token_counts(spark.createDataFrame([], SCHEMA)).count() == 0
    assert {r.over_limit for r in found} == {True, False}


def test_token_counts_of_odd_texts_equal_the_library(library):
    rng = random.Random(5)
    bits = ["a", "the", "The", " ", "  ", "\n", "\r\n", "\t", "é", "ß", "漢", "🙂", " ", "\xa0", "\x1c", "\x85", "1", "23", "²", "'s", "'ll", ".", ",", "!", "...", "<|endoftext|>", "<|endof", "Ġ", "\x00", "x" * 30, "ab" * 40, "̀", "ʼ"]
    made = ["".join(rng.choice(bits) for _ in range(rng.randint(0, 40))) for _ in range(4000)]
    found = token_counts.TokenCounter(tokens.default_path()).counts(pa.array(made, pa.large_string()))
    assert [x for x, n in zip(made, found, strict=True) if n != library(x)] == []


@pytest.mark.parametrize("text", ["a" * 60_000, "ab" * 30_000, " " * 40_000, "\n" * 9_000, "é" * 20_000, "word " * 20_000])
def test_token_counts_of_very_long_words_equal_the_library(library, text):
    assert token_counts.TokenCounter(tokens.default_path()).counts(pa.array([text], pa.large_string())).tolist() == [library(text)]


def test_token_counts_survive_a_small_cache(library, monkeypatch):
    monkeypatch.setattr(token_counts, "CACHED", 20)
    made = [t or "" for _, t, _ in texts()]
    counter = token_counts.TokenCounter(tokens.default_path())
    for _ in range(2):
        assert [n for t in made for n in counter.counts(pa.array([t], pa.large_string()))] == [library(t) for t in made]
    assert len(counter.older) > 0


def test_stale_entries_of_the_heap_are_passed_over():
    model = {"type": "BPE", "vocab": {x: i for i, x in enumerate(["a", "b", "c", "ab", "bc", "abc"])}, "merges": [["a", "b"], ["b", "c"], ["a", "bc"], ["ab", "c"]]}
    merges = token_counts.PairMerges(model)
    assert [merges.count(x) for x in ("abc", "bc", "abab", "abcbc", "ca", "c")] == [1, 1, 2, 2, 2, 1]
    with pytest.raises(ValueError):
        token_counts.PairMerges(model | {"ignore_merges": True})


# 11: conversation repair

SPACE = " \t\n\x0b\x0c\r"


def brute_force(rows):
    """The report of one conversation's rows after damage, in order, by trying all edits."""
    seen, faults = set(), []
    for _, role, text in rows:
        bare = text.strip(SPACE)
        faults.append("blank" if not bare else "duplicate" if (role, text) in seen else "" if bare[-1] in ".!?" else "truncated")
        seen.add((role, text))

    def closed(i, last, depth=3):
        """Least (cost, letters) from row i on, where last is the initial of what stands before; up to depth insertions first."""
        found = [inner(i, last)]
        if depth:
            cost, audit = closed(i, "a" if last == "u" else "u", depth - 1)
            found.append((cost + 5, "I" + audit))
        return min(found)

    @functools.cache
    def inner(i, last):
        found = [(10**9, "")]
        if i == len(rows):
            if last in ("", "a"):
                found.append((0, ""))
        else:
            cost, audit = closed(i + 1, last)
            found.append((cost + 2, "D" + audit))
            if faults[i] not in ("blank", "duplicate"):
                more = 5 if faults[i] else 0
                initial = rows[i][1][:1]
                if initial and initial in {"": "su", "s": "u", "u": "a", "a": "u"}[last]:
                    cost, audit = closed(i + 1, initial)
                    found.append((cost + more, "K" + audit))
                cost, audit = closed(i + 1, "a" if last == "u" else "u")
                found.append((cost + more + 1, "R" + audit))
        return min(found)

    cost, audit = closed(0, "")
    lines, last, i = [], "", 0
    for letter in audit:
        if letter != "I":
            _, role, text = rows[i]
            i += 1
        if letter == "D":
            continue
        if letter == "K":
            last = role[:1]
            lines.append(f"{role}:{text}")
        else:
            last = "a" if last == "u" else "u"
            lines.append(f"{ {'u': 'user', 'a': 'assistant'}[last] }:{'' if letter == 'I' else text}")
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))  # noqa: B905
    return gaps, *(faults.count(x) for x in ("blank", "duplicate", "truncated")), illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()


def after_damage(rows):
    out = defaultdict(list)
    for conv, turn, role, text in rows:
        out[conv]
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out[conv] += [(turn, "user" if kind == 4 else role, text)] * {0: 0, 3: 2}.get(kind, 1)
    return {c: sorted(v, key=lambda x: (x[0] is not None, x[0] or 0, x[1].encode(), x[2].encode())) for c, v in out.items()}


def made_rows():
    rng = random.Random(3)
    say = ["Hello there.", "What is it?", "Fine!", "cut off", "half a", "", " \n\t", None, "Yes.  ", "yes", "a.b", "漢字。", "ends ! ", "x" * 3000 + "."]
    rows = []
    for conv in [*range(160), None]:
        for turn in range(rng.randint(1, 9)):
            role = rng.choice(["user", "assistant"]) if rng.random() < 0.3 else ["user", "assistant"][turn % 2]
            role = rng.choice(["system", "tool", "", None, "unknown", "User"]) if rng.random() < 0.1 else "system" if not turn and rng.random() < 0.4 else role
            own = (conv, None if rng.random() < 0.05 else turn * rng.choice([1, 1, 1, 2]), role, rng.choice(say) if rng.random() < 0.6 else f"Turn {turn} of {conv}.")
            rows += [own] * (3 if rng.random() < 0.04 else 1)
    rows += [(900, 4, "user", "only.")] if zlib.crc32(b"900:4") % 20 == 0 else []
    return rows


SHAPE = "conv_id long, turn long, role string, text string, kind int, piece string, n long, fault string"


def as_table(spark, rows):
    return spark.createDataFrame([(*r, i, "p", 9, None) for i, r in enumerate(rows)], SHAPE)


def test_repaired_conversations_equal_brute_force(spark):
    rows = made_rows()
    rows += [(c, t, "user", "gone.") for c in range(1000, 1200) for t in [0] if zlib.crc32(f"{c}:{t}".encode()) % 20 == 0]
    found = {r.conv_id: tuple(r)[1:] for r in conversations.repaired(as_table(spark, rows)).collect()}
    wanted = {c: brute_force(v) for c, v in after_damage(rows).items()}
    assert found == wanted
    assert any(not v for v in after_damage(rows).values())
    assert {x for v in wanted.values() for x in v[6]} == set("DKR")  # a deletion is always cheaper than an insertion


def test_a_hot_conversation_equals_brute_force_over_many_tasks(spark):
    rng = random.Random(8)
    rows = [(1, t, rng.choice(["user", "assistant", "assistant", "system"]), rng.choice([f"Text {t}.", f"text {t}", "Common.", ""])) for t in range(300)]
    rows += [(2, 5, "user", "The same.")] * 200 + [(3, 1, "assistant", "One.")]
    spark.conf.set("spark.sql.shuffle.partitions", "9")
    try:
        found = {r.conv_id: tuple(r)[1:] for r in conversations.repaired(as_table(spark, rows)).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert found == {c: brute_force(v) for c, v in after_damage(rows).items()}


def test_runs_give_what_rows_give():
    rng = random.Random(2)
    for _ in range(300):
        runs = [(rng.choice("suaoSUAOx"), rng.randint(1, 6)) for _ in range(rng.randint(0, 6))]
        kinds = {"s": "system", "u": "user", "a": "assistant", "o": "tool"}
        rows, i = [], 0
        for symbol, n in runs:
            for _ in range(n):
                i += 1
                rows.append((i, "user", " ") if symbol == "x" else (i, kinds[symbol.lower()], f"{i}" + ("" if symbol.isupper() else ".")))
        assert conversations.repair(runs) == brute_force(rows)[5:7]


def test_very_long_runs_are_advanced_by_powers(monkeypatch):
    monkeypatch.setattr(conversations, "BLOCK", 7)
    for symbol in "suaoSUAOx":
        costs = conversations.END
        for n in range(1, 40):
            costs = conversations.before(symbol, 1, costs)
            assert conversations.before(symbol, n, conversations.END) == costs
    cost, audit = conversations.repair([("u", 1), ("x", 100_000), ("a", 1)])
    assert (cost, audit) == (200_000, "K" + "D" * 100_000 + "K")


def test_no_conversations(spark):
    assert conversations.repaired(spark.createDataFrame([], SHAPE)).count() == 0


def test_queries_are_registered():
    assert {"op11_conversations", "op13_token_counts"} <= set(queries.QUERIES)

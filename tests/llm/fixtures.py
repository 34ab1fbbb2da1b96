"""Documents that hold every awkward case, and plain versions of what the operators compute."""

import random
import re

WORDS = "the of and to in that stone river light garden winter market letter bridge silver copper morning evening forest island harbour engine window paper signal castle meadow lantern thunder shadow mirror basket".split()
SCHEMA = "doc_id long, text string, source string, lang string, n_chars long, fp long, id string, kept boolean, key int, block int, size string, s string, count long"


def prose(rng, n):
    out = []
    while len(out) < n:
        k = min(rng.randint(6, 14), n - len(out))
        line = " ".join(rng.choice(WORDS) + rng.choice(["", "", "", "s", "ly", ","]) for _ in range(k))
        out += line.split()
        if rng.random() < 0.4 and out:
            out[-1] += ".\n"
    return " ".join(out).replace("\n ", "\n")


def edited(rng, text, n):
    words = text.split(" ")
    for _ in range(n):
        words[rng.randrange(len(words))] = rng.choice(WORDS) + "x"
    return " ".join(words)


def texts(seed=1):
    """(doc_id, text, source): copies, near copies, shared passages, repeated ids and rows, nulls, empties, a very long text."""
    rng = random.Random(seed)
    base = [prose(rng, rng.randint(20, 240)) for _ in range(30)]
    passage = prose(rng, 60)
    out = list(enumerate(base))
    out += [(100 + i, base[i % 3]) for i in range(12)]  # a hot group of copies
    out += [(200 + i, edited(rng, base[i % 6], 1)) for i in range(12)]
    out += [(300 + i, prose(rng, 30) + " " + passage + " " + prose(rng, 30)) for i in range(6)]
    out += [(400, None), (401, ""), (402, " \n\t "), (403, "word"), (404, "a\x1cb  c  d \n\n e"), (405, "é ü 漢字かな漢字かな 🙂🙂  x"), (406, "Word"), (407, "x" * 5000), (408, "ab " * 3000), (None, base[4]), (None, None)]
    out += [(409, prose(rng, 20_000)), (410, base[5]), (410, base[5]), (410, base[6] + " more"), (0, base[0])]
    out += [(411, "<|endoftext|> is text"), (412, "\n".join(["same line of words here"] * 4 + [""] * 3))]
    names = ["b", "a", None, "é", "B", "hot", "hot", "hot"]
    return [(d, t, names[i % len(names)]) for i, (d, t) in enumerate(out)]


def frame(spark, rows=None, extra=True):
    """The rows as a table; extra columns have names that the operators use themselves."""
    rows = texts() if rows is None else rows
    if not extra:
        return spark.createDataFrame([(d, t, s) for d, t, s in rows], "doc_id long, text string, source string")
    return spark.createDataFrame([(d, t, s, None, None if t is None else len(t), 7, "id", None, i, 1, "big", None, None) for i, (d, t, s) in enumerate(rows)], SCHEMA)


def root_of(links, nodes):
    """The least node of each node's component."""
    parent = {x: x for x in nodes}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {x: find(x) for x in nodes}


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def same(a, b):
    """Whether two lists hold the same rows."""
    return sorted(map(repr, a)) == sorted(map(repr, b))

"""Quality classifier: random Fourier features, ridge regression, isotonic calibration.

Statistics of each whole text (lengths, character classes, repetition) are mapped by random
Fourier features, whose inner products approximate a Gaussian kernel. Each partition sums its
part of the normal equations by fold, the parts are added on the executors, and the driver gets
a matrix of fixed size to solve. Scores of rows left out of a fit are counted in fixed bins, and
a monotone step function through the bins turns scores into probabilities.

Defined cases: a null text is empty and scored like any text; without training rows every score
is 0.5; with labels of one kind only every score is that label's share; repeated rows count as
often as they occur; null labels and null ids don't train, and a null id counts as not held out;
very long texts are read in runs of a megabyte; equal statistics get equal scores; an empty table
gives no rows; other columns of documents and labels are ignored, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemill.llm.common import stored, table, text_bytes, word_runs

CLASSES = [b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz", b"0123456789", b" ", b"\n", b".", b",", b"!?", b"|", b"#$%&*+<=>@\\^_`{}~[]", b"\"'()-/:;", bytes(range(128, 256))]
N_STATS = len(CLASSES) + 11
FOLDS, BINS = 4, 1024


def _class_matrix() -> np.ndarray:
    m = np.zeros((256, len(CLASSES)))
    for j, c in enumerate(CLASSES):
        m[list(c), j] = 1
    return m


CLASS_MATRIX = _class_matrix()


def statistics(text: bytes) -> np.ndarray:
    """The statistics of one text."""
    counts = np.zeros(256, np.int64)
    for i in range(0, len(text), 1 << 20):
        counts += np.bincount(np.frombuffer(text, np.uint8, min(1 << 20, len(text) - i), i), minlength=256)
    n_words = twins = 0
    last, seen, letters = None, set(), 0
    for words in word_runs(text):
        n_words += len(words)
        seen.update(words)
        twins += sum(map(bytes.__eq__, words[1:], words[:-1])) + (last == words[0] if words else 0)
        last = words[-1] if words else last
        letters += sum(map(bytes.isalpha, words))
    lines = text.split(b"\n")
    n, p = max(1, len(text)), counts[counts > 0] / max(1, len(text))
    more = [
        np.log1p(len(text)), np.log1p(n_words), len(text) / max(1, n_words), len(seen) / max(1, n_words), twins / max(1, n_words),
        letters / max(1, n_words), np.log1p(len(lines)), len(set(lines)) / len(lines), np.log1p(max(map(len, lines))), float(-(p * np.log(p)).sum()), np.log1p(len(seen)),
    ]
    return np.concatenate([counts @ CLASS_MATRIX / n, more])


def _with_statistics(batches):
    """text, the first column, becomes stats; the other columns stay."""
    for batch in batches:
        rows = [statistics(x) for x in batch.column(0).to_pylist()]
        flat = pa.array(np.concatenate(rows) if rows else np.zeros(0), pa.float64())
        offsets = pa.array(np.arange(len(rows) + 1, dtype=np.int32) * N_STATS)
        yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(offsets, flat), *batch.columns[1:]], ["stats", *batch.schema.names[1:]])


@dataclass
class Model:
    """Scores statistics: features, ridge weights, then calibration."""

    mean: np.ndarray
    scale: np.ndarray
    directions: np.ndarray
    phases: np.ndarray
    weights: np.ndarray | None = None
    knots: tuple[np.ndarray, np.ndarray] | None = None
    constant: float | None = None

    def features(self, stats: np.ndarray) -> np.ndarray:
        x = np.clip((stats - self.mean) / self.scale, -6, 6)
        z = np.cos(x @ self.directions + self.phases) * np.sqrt(2 / len(self.phases))
        return np.hstack([z, x / 10, np.ones((len(x), 1))])

    def score(self, stats: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(stats), self.constant)
        return np.interp(self.features(stats) @ self.weights, *self.knots)


def isotonic(ones: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The non-decreasing shares nearest to ones / counts, by pooling adjacent violators."""
    blocks: list[list[float]] = []
    for a, n in zip(ones, counts, strict=True):
        blocks.append([a, n, 1])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            a2, n2, k2 = blocks.pop()
            blocks[-1] = [blocks[-1][0] + a2, blocks[-1][1] + n2, blocks[-1][2] + k2]
    return np.concatenate([np.full(int(k), a / n) for a, n, k in blocks])


def _stack(column) -> np.ndarray:
    return column.flatten().to_numpy().reshape(len(column), -1)


def training_rows(docs: DataFrame, labels: DataFrame, max_rows: int = 200_000, seed: int = 7) -> DataFrame:
    """(stats, y, fold) of the documents that train.

    Rows with crc32(doc_id as text) mod 5 = 0 never do. At most about max_rows labelled rows
    do, picked by a hash of the id; this bounds the broadcast side of the join, 20 bytes a row.
    """
    crc = F.crc32(F.col("doc_id").cast("string"))
    known = labels.where("quality is not null and doc_id is not null").where(crc % 5 != 0).select("doc_id", F.col("quality").cast("double").alias("y"))
    n = known.count()
    known = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int(min(1.0, max_rows / max(1, n)) * (1 << 30)))
    fold = F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(FOLDS)).cast("int")
    rows = docs.select("doc_id", text_bytes().alias("text")).join(F.broadcast(known), "doc_id").select("text", "y", fold.alias("fold"))
    return rows.mapInArrow(_with_statistics, "stats array<double>, y double, fold int")


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = 200_000, n_features: int = 256, ridge: float = 0.5, seed: int = 7) -> Model:
    """A model of labels (doc_id, quality) from documents (doc_id, text); see `training_rows` for max_rows."""
    train = stored(training_rows(docs, labels, max_rows, seed), "training")
    found = train.agg(F.count("*"), F.avg("y"), F.min("y"), F.max("y"), *[F.avg(F.col("stats")[i]) for i in range(N_STATS)], *[F.stddev_pop(F.col("stats")[i]) for i in range(N_STATS)]).first()
    rng = np.random.default_rng(seed)
    directions, phases = rng.normal(0, np.sqrt(2 / N_STATS), (N_STATS, n_features)), rng.uniform(0, 2 * np.pi, n_features)
    if not found[0] or found[2] == found[3]:
        return Model(np.zeros(N_STATS), np.ones(N_STATS), directions, phases, constant=0.5 if not found[0] else float(found[1]))
    mean, scale = np.array(found[4 : 4 + N_STATS], float), np.array(found[4 + N_STATS :], float)
    model = Model(mean, np.where(scale > 1e-9, scale, 1.0), directions, phases)

    def partial(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            z, y, fold = model.features(_stack(batch.column("stats"))), batch.column("y").to_numpy(), batch.column("fold").to_numpy()
            for k in np.unique(fold).tolist():
                own = z[fold == k]
                sums[k] = sums.get(k, 0) + own.T @ np.column_stack([own, y[fold == k]])
        for k, m in sums.items():
            yield pa.RecordBatch.from_pydict({"fold": [k] * len(m), "i": list(range(len(m))), "row": list(m)}, pa.schema([("fold", pa.int32()), ("i", pa.int32()), ("row", pa.list_(pa.float64()))]))

    def added(key, group):
        return pa.table({"fold": [key[0].as_py()], "i": [key[1].as_py()], "row": [_stack(group.column("row").combine_chunks()).sum(axis=0)]}, schema=pa.schema([("fold", pa.int32()), ("i", pa.int32()), ("row", pa.list_(pa.float64()))]))

    shape = "fold int, i int, row array<double>"
    parts = train.mapInArrow(partial, shape).groupBy("fold", "i").applyInArrow(added, shape).collect()
    size = n_features + N_STATS + 1
    sums = np.zeros((FOLDS, size, size + 1))
    for row in parts:
        sums[row.fold, row.i] = row.row

    def solve(m: np.ndarray) -> np.ndarray:
        return np.linalg.solve(m[:, :-1] + ridge * np.eye(size), m[:, -1])

    total = sums.sum(axis=0)
    left_out = [solve(total - m) for m in sums]
    model.weights = solve(total)

    def binned(batches):
        ones, counts = np.zeros(BINS), np.zeros(BINS)
        for batch in batches:
            if not batch.num_rows:
                continue
            z, y, fold = model.features(_stack(batch.column("stats"))), batch.column("y").to_numpy(), batch.column("fold").to_numpy()
            raw = np.einsum("ij,ij->i", z, np.array(left_out)[fold])
            at = np.clip((raw + 0.5) / 2 * BINS, 0, BINS - 1).astype(int)
            ones += np.bincount(at, y, BINS)
            counts += np.bincount(at, minlength=BINS)
        some = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(ones[some]), pa.array(counts[some])], ["bin", "ones", "counts"])

    bins = sorted(tuple(x) for x in train.mapInArrow(binned, "bin long, ones double, counts double").groupBy("bin").agg(F.sum("ones"), F.sum("counts")).collect())
    at, ones, counts = (np.array(x, float) for x in zip(*bins, strict=True))
    level = isotonic(ones, counts)
    model.knots = ((at + 0.5) / BINS * 2 - 0.5, level)
    return model


def _scorer(model: Model):
    @F.pandas_udf("double")
    def score(s: pd.Series) -> pd.Series:
        return pd.Series(model.score(np.stack([statistics(x) for x in s])) if len(s) else [], dtype=float)

    return score(text_bytes())


def quality_scores(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """Per row: doc_id, held_out (not trained on by its id), score, predicted (score at least the threshold)."""
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))
    scored = docs.select("doc_id", held_out.alias("held_out"), _scorer(fit(docs, labels)).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def keep_quality(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """docs without the rows that the classifier scores below the threshold; texts don't move."""
    return docs.where(_scorer(fit(docs, labels)) >= threshold)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))

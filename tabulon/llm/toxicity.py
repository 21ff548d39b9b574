"""Toxicity by non-negative positive-unlabelled learning.

A linear classifier over hashed word and word-beginning features is trained from
confirmed toxic texts and from unlabelled ones. The unlabelled texts stand for the
negative class after the class prior's share of positive risk is taken off; where that
difference falls below zero the step goes against it, so the classifier cannot win by
calling toxic texts in the unlabelled set negative. Features are made in the tasks; one
task trains on a bounded sample with numpy; scoring runs over all texts in the tasks.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from tabulon.llm.common import Recent, small_batches, table, unit_hash

#: Hash space of the features.
DIMENSIONS = 1 << 20
#: Most texts that training reads: confirmed toxic ones, and unlabelled ones.
POSITIVES, UNLABELLED = 2_500, 7_500
#: Lengths of word beginnings that are features beside the word itself.
BEGINNINGS = (4, 5, 6)
THRESHOLD = 0.7
CACHED_WORDS = 50_000
_WORD = re.compile(r"[^\W\d_]+")


class Features:
    """Texts -> sorted distinct feature numbers."""

    def __init__(self):
        self.cache = Recent(CACHED_WORDS)  # word -> feature numbers

    def _of(self, word: str) -> tuple[int, ...]:
        parts = {"=" + word} | {word[:n] for n in BEGINNINGS if len(word) > n}
        return self.cache.put(word, tuple(zlib.crc32(p.encode()) % DIMENSIONS for p in parts))

    def __call__(self, text: str | None) -> np.ndarray:
        cache, found = self.cache, set()
        for word in set(_WORD.findall((text or "").lower())):
            found.update(cache[word] or self._of(word))
        return np.sort(np.fromiter(found, np.int32, len(found)))


def _flat(rows: Sequence[np.ndarray], column: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows as one index array over the chosen features, row numbers, and row lengths."""
    kept = [column[r] for r in rows]
    kept = [k[k >= 0] for k in kept]
    sizes = np.array([len(k) for k in kept])
    return (np.concatenate(kept) if kept else np.zeros(0, np.int64)), np.repeat(np.arange(len(kept)), sizes), sizes


def _texts_with(rows: Sequence[np.ndarray]) -> np.ndarray:
    """For every feature the number of rows that have it."""
    n = np.zeros(DIMENSIONS, np.int32)
    for at in range(0, len(rows), 512):
        n += np.bincount(np.concatenate(rows[at:at + 512]), minlength=DIMENSIONS).astype(np.int32)
    return n


def train(positive: Sequence[np.ndarray], unlabelled: Sequence[np.ndarray], prior: float, rounds: int = 200,
          rate: float = 0.05, shrink: float = 2e-4, least: int = 3, sure: float = 5.0) -> tuple[np.ndarray, float]:
    """Weights over the hash space and a bias, by full-batch Adam on the non-negative risk
    prior * E_p[l(+)] + max(0, E_u[l(-)] - prior * E_p[l(-)]) with the logistic loss l, and
    an absolute penalty on the weights. Features of fewer than ``least`` positives are
    left out, and those whose rate among the positives is within ``sure`` standard errors
    of their rate in the unlabelled set. Without positives or unlabelled texts the bias alone says the prior."""
    weights = np.zeros(DIMENSIONS, np.float32)
    prior = min(max(prior, 1e-3), 0.999)
    bias = float(np.log(prior / (1 - prior)))
    if not len(positive) or not len(unlabelled):
        return weights, bias
    n_p, n_u = len(positive), len(unlabelled)
    in_p, in_u = _texts_with(positive), _texts_with(unlabelled)
    usual = (in_p + in_u + 1) / (n_p + n_u + 2)
    used = (in_p >= least) & (np.abs(in_p / n_p - in_u / n_u) > sure * np.sqrt(usual * (1 - usual) / n_p))
    column = np.full(DIMENSIONS, -1, np.int64)
    column[used] = np.arange(int(used.sum()))
    k = int(used.sum())
    (pi, pr, _), (ui, ur, _) = _flat(positive, column), _flat(unlabelled, column)
    w = np.zeros(k + 1)
    w[k] = bias
    m, v = np.zeros(k + 1), np.zeros(k + 1)

    def gradient(index, row, pull):
        g = np.bincount(index, pull[row], k + 1)
        g[k] = pull.sum()
        return g

    for t in range(1, rounds + 1):
        zp = np.bincount(pr, w[pi], n_p) + w[k]
        zu = np.bincount(ur, w[ui], n_u) + w[k]
        sp, su = 1 / (1 + np.exp(-np.clip(zp, -50, 50))), 1 / (1 + np.exp(-np.clip(zu, -50, 50)))
        negative = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
        toward = gradient(pi, pr, prior * (sp - 1) / n_p)
        away = gradient(ui, ur, su / n_u) - gradient(pi, pr, prior * sp / n_p)
        g = toward + away if negative >= 0 else -away
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        step = rate * np.sqrt(1 - 0.999 ** t) / (1 - 0.9 ** t) * m / (np.sqrt(v) + 1e-8)
        w -= step
        w[:k] = np.sign(w[:k]) * np.maximum(np.abs(w[:k]) - shrink, 0)
    weights[used] = w[:k]
    return weights, float(w[k])


def in_held_out(id_col: str) -> Column:
    """crc32 of the id as text leaves 1 modulo 3; false for a NULL id."""
    return F.coalesce(F.crc32(F.col(f"`{id_col}`").cast("string").cast("binary")) % 3 == 1, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
        seed: int = 3) -> tuple[np.ndarray, float]:
    """Train on at most POSITIVES confirmed toxic and UNLABELLED other texts, those of the
    least hash of their id, from the rows that are not held out, in one task; only the
    weights that are not zero come back. The class prior is the share of toxic ones among
    all labels outside the held-out rows."""
    known = (labels.where(~in_held_out(id_col)).where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
             .groupBy(F.col(id_col).alias("id")).agg(F.max(label_col).alias("y")))
    share = known.agg(F.avg(F.col("y").cast("double"))).first()[0]
    turn = unit_hash(F.col("id"), seed=seed)
    ids = docs.where(~in_held_out(id_col)).select(F.col(f"`{id_col}`").alias("id")).where("id is not null")
    pos = ids.join(known.where("y = 1").select("id"), "id", "left_semi").distinct().orderBy(turn, "id").limit(POSITIVES)
    unl = ids.distinct().orderBy(turn, "id").limit(UNLABELLED)
    chosen = (pos.select("id", F.lit(1).alias("p"), F.lit(0).alias("u"))
              .union(unl.select("id", F.lit(0).alias("p"), F.lit(1).alias("u")))
              .groupBy("id").agg(F.max("p").alias("p"), F.max("u").alias("u")))
    small_batches(docs.sparkSession)
    texts = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text")) \
        .join(F.broadcast(chosen), "id").select("id", "p", "u", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features()
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                found = [features(t).tobytes() for t in part.column(3).to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns[:3], pa.array(found, pa.binary())],
                                                 names=["id", "p", "u", "f"])

    prior = share if share is not None else 0.0

    def trained(group: pa.Table) -> pa.Table:
        group = group.sort_by("id")  # sums of doubles depend on the order
        rows = [np.frombuffer(f.as_buffer(), np.int32) for f in group["f"]]
        pos = [r for r, p in zip(rows, group["p"].to_pylist()) if p]
        unl = [r for r, u in zip(rows, group["u"].to_pylist()) if u]
        weights, bias = train(pos, unl, prior)
        at = np.flatnonzero(weights).astype(np.int32)
        return pa.table({"at": pa.array([at.tobytes()], pa.binary()),
                         "w": pa.array([weights[at].tobytes()], pa.binary()), "bias": pa.array([bias], pa.float64())})

    # an id that comes more than once gives its first text only; the group is the bounded sample
    got = texts.mapInArrow(run, f"id {texts.schema['id'].dataType.simpleString()}, p int, u int, f binary")
    model = (got.groupBy("id", "p", "u").agg(F.min("f").alias("f")).withColumn("all", F.lit(0))
             .groupBy("all").applyInArrow(trained, "at binary, w binary, bias double").first())
    if model is None:
        return train([], [], prior)
    weights = np.zeros(DIMENSIONS, np.float32)
    weights[np.frombuffer(bytes(model["at"]), np.int32)] = np.frombuffer(bytes(model["w"]), np.float32)
    return weights, model["bias"]


def score(docs: DataFrame, model: tuple[np.ndarray, float], text_col: str = "text",
          keep: Sequence[str] | None = None, score_col: str = "score") -> DataFrame:
    """``docs`` (its ``keep`` columns, all by default) with the toxicity score, 0 to 1, of
    every whole text; NULL counts as empty, and an empty text gets the bias's score. A
    column named like the score is replaced."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    keep = [c for c in (docs.columns if keep is None else keep) if c != score_col]
    src = docs.select(*[F.col(f"`{c}`") for c in keep])
    if text_col in keep and isinstance(src.schema[text_col].dataType, StringType):
        at_text = keep.index(text_col)  # texts that are kept travel once
    else:
        src, at_text = docs.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text_col}`").cast("string").alias("__text")), len(keep)
    schema = StructType([*src.schema.fields[:len(keep)], StructField(score_col, DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, bias = shared.value
        features = Features()
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                z = np.array([weights[features(t)].sum(dtype=np.float64) + bias
                              for t in part.column(at_text).to_pylist()])
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:len(keep)], pa.array(1 / (1 + np.exp(-np.clip(z, -500, 500))))],
                    names=[*keep, score_col])

    return src.mapInArrow(run, schema)


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit(docs, table(spark, sf_dir, "labels"))
    return score(docs, model, keep=["doc_id"]).select(
        "doc_id", in_held_out("doc_id").alias("held_out"), "score",
        F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"))

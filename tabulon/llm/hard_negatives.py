"""Hard negatives by Kronecker-packed products.

Components are integers. Those of several candidates, biased so that none is negative, lie
side by side in separated fields of one wide integer. Multiplied by a component of the
anchor and summed over the dimensions, every field holds one candidate's inner product,
exactly, since the fields are wide enough for the largest sum: one multiplication serves
all candidates of the word. Fields of up to 64 bits share machine words; wider ones share
Python integers of any length.

All anchors meet all rows, in blocks: a task holds a block of anchors and a block of
candidates and hands on a few rows for each of its anchors. One pass finds the positives,
a second one the negatives, whose range of scores the positives have set.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tabulon.llm.common import stored, table

#: Rows of a block.
ANCHORS, CANDIDATES = 4096, 4096
#: Candidates whose scores a task holds for all its anchors at once.
AT_ONCE = 512
#: Fields of a Python integer, where a field is wider than a machine word.
FIELDS = 16
LONG = 2 ** 63 - 1


def integer_rows(rows: DataFrame, id_col: str, vector_col: str, label_col: str, scale: int, shift: int,
                 labels: int) -> DataFrame:
    """(id, label, vector) of the rows that take part: floor(scale * x) of every component,
    as doubles without a fraction; the labels of ids divisible by ``shift`` are moved on."""
    x = F.col(f"`{vector_col}`").cast("array<double>")
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    label = F.col(f"`{label_col}`").cast("long")
    moved = F.when(F.col(f"`{id_col}`") % shift == 0, (label + 1) % labels).otherwise(label)
    # the product of doubles, then its floor: floor() itself would make a bigint of it
    return (rows.where(F.col(f"`{label_col}`").isNotNull() & x.isNotNull() & ~F.coalesce(bad, F.lit(True)))
            .select(F.col(f"`{id_col}`").cast("long").alias("id"), moved.alias("label"),
                    F.transform(x, lambda v: v * F.lit(float(scale))).alias("vector"))
            .dropDuplicates(["id", "label", "vector"]))


def matrix(vectors: list[list[float]], dim: int) -> np.ndarray:
    """Rows of integers; shorter vectors are filled up with 0. int64 where squares
    sum up to less than 63 bits, else Python integers."""
    out = np.zeros((len(vectors), dim))
    for i, v in enumerate(vectors):
        out[i, :len(v)] = v
    out = np.floor(out)
    if out.size and np.abs(out).max() >= 2.0 ** 24:
        return np.array([[int(x) for x in row] for row in out], object).reshape(out.shape)
    return out.astype(np.int64)


class Packed:
    """Candidates packed for products with anchors.

    ``most`` is a bound of all scores' absolute values. A field is as wide as twice that
    and as a biased component need; a word is a machine word or, where a field does not
    fit, a Python integer of ``FIELDS`` fields.
    """

    def __init__(self, candidates: np.ndarray, most: int):
        self.n, dim = candidates.shape
        self.most = int(most)
        self.bias = -int(min(0, candidates.min())) if candidates.size else 0
        largest = int(candidates.max()) + self.bias if candidates.size else 0
        self.width = max((2 * self.most).bit_length(), largest.bit_length(), 1)
        self.wide = self.width > 63 or candidates.dtype == object
        self.fields = FIELDS if self.wide else 64 // self.width
        self.kind = object if self.wide else np.uint64
        words = -(-self.n // self.fields)
        biased = np.zeros((words * self.fields, dim), object if self.wide else np.int64)
        biased[:self.n] = candidates + self.bias
        # field j of word w is candidate w + j * words: unpacking a field gives a run of them
        self.words = np.zeros((words, dim), self.kind)
        for j in range(self.fields):
            part = biased[j * words:(j + 1) * words].astype(self.kind)
            self.words += part << self._shift(j)
        self.ones = sum(1 << (j * self.width) for j in range(self.fields))

    def _shift(self, j: int):
        return j * self.width if self.wide else np.uint64(j * self.width)

    def scores(self, anchors: np.ndarray) -> np.ndarray:
        """The exact inner products, a row for each anchor."""
        # a field holds score + bias * (sum of the anchor) + what makes that score + most
        level = [(self.most - self.bias * int(s)) * self.ones for s in anchors.sum(axis=1)]
        if self.wide:
            total = anchors.astype(object) @ self.words.T + np.array(level, object)[:, None]
            mask = (1 << self.width) - 1
        else:  # modulo 2**64, which the sum of all fields stays below
            total = anchors.astype(np.int64).view(np.uint64) @ self.words.T
            total += np.array([x % 2 ** 64 for x in level], np.uint64)[:, None]
            mask = np.uint64((1 << self.width) - 1)
        out = [(total >> self._shift(j)) & mask for j in range(self.fields)]
        out = np.concatenate(out, axis=1)[:, :self.n]
        return out - self.most if self.wide else out.astype(np.int64) - self.most


def norm_bound(a: np.ndarray, b: np.ndarray) -> int:
    """No inner product of a row of ``a`` and a row of ``b`` is larger (Cauchy-Schwarz)."""
    if not a.size or not b.size:
        return 0
    longest = [max(int(x) for x in (m.astype(object) ** 2).sum(axis=1)) if m.dtype == object
               else int((m ** 2).sum(axis=1).max()) for m in (a, b)]
    return int(longest[0] ** 0.5 * longest[1] ** 0.5 * 1.001) + 2


def best_first(scores: np.ndarray, most: int) -> np.ndarray:
    """Places of the ``most`` highest scores, highest first; of equals the first."""
    if len(scores) > 4 * most and scores.dtype != object:
        bar = np.partition(scores, len(scores) - most)[len(scores) - most]
        at = np.flatnonzero(scores >= bar)
        return at[np.argsort(-scores[at], kind="stable")[:most]]
    return np.array(sorted(range(len(scores)), key=lambda i: -scores[i])[:most], np.int64)


def _saturated(x: int) -> int:
    return max(-LONG - 1, min(LONG, int(x)))


def _block(group: pa.Table, found):
    """Runs ``found`` on every slice of a block's candidates: the anchors' rows and
    matrix, the candidates' rows in the order of their ids (NULL last), and the scores."""
    rows = group.to_pylist()
    anchors = [r for r in rows if r["anchor"]]
    others = sorted((r for r in rows if not r["anchor"]), key=lambda r: (r["id"] is None, r["id"] or 0))
    dim = max((len(r["vector"]) for r in rows), default=0)
    a, c = (matrix([r["vector"] for r in part], dim) for part in (anchors, others))
    most = norm_bound(a, c)
    step = max(1, min(CANDIDATES, AT_ONCE * ANCHORS // max(1, len(anchors))))
    for at in range(0, len(others), step):
        part = others[at:at + step]
        yield from found(anchors, part, Packed(c[at:at + step], most).scores(a))


def in_blocks(anchors: DataFrame, rows: DataFrame, found, fields: str, n_anchors: int, n_rows: int) -> DataFrame:
    """``found`` over every block of anchors with every block of rows. ``anchors`` and
    ``rows`` have the same columns: own, id, label, vector and bars."""
    i, j = max(1, -(-n_anchors // ANCHORS)), max(1, -(-n_rows // CANDIDATES))
    def dealt(df, mine, other, swap):
        mine_part, copies = F.pmod(F.col("own"), F.lit(mine)).cast("int"), F.explode(F.sequence(F.lit(0), F.lit(other - 1)))
        part = df.withColumn("mine", mine_part).withColumn("theirs", copies)
        names = ("theirs", "mine") if swap else ("mine", "theirs")
        return part.select(F.col(names[0]).alias("x"), F.col(names[1]).alias("y"), F.lit(not swap).alias("anchor"),
                           "own", "id", "label", "vector", "bars")

    both = dealt(anchors, i, j, False).unionByName(dealt(rows, j, i, True))
    names = [f.split(" ")[0] for f in fields.split(", ")]

    def run(group: pa.Table) -> pa.Table:
        out = list(_block(group, found))
        kinds = [pa.list_(pa.int64()) if "array" in f else pa.int64() for f in fields.split(", ")]
        return pa.table({n: pa.array([r[k] for r in out], t) for k, (n, t) in enumerate(zip(names, kinds))})

    return both.groupBy("x", "y").applyInArrow(run, fields)


def hard_negatives(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
                   anchor_every: int = 100, positives: int = 5, negatives: int = 5, low_percent: int = 80,
                   scale: int = 256, shift: int = 7, labels: int = 10) -> DataFrame:
    """Rows anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Rows with a NULL label, a NULL vector or a NULL or non-finite component take no part.
    Rows equal in id, label and vector are one; a NULL id is no anchor and comes after all
    others among equal scores; two rows with the same id are not each other's partners.
    Vectors of different lengths are filled up with 0. Anchors are the ids divisible by
    ``anchor_every``; an anchor's positives are its ``positives`` best other rows of its
    label; for each, the ``negatives`` best rows of other labels with a score from
    ``low_percent`` percent of the positive's up to the positive's. Scores are exact at any
    size; one that no long can hold is returned as the nearest that it can. An empty
    table, or one without anchors, gives no rows.
    """
    whole = stored(integer_rows(rows, id_col, vector_col, label_col, scale, shift, labels)
                   .withColumns({"own": F.xxhash64("id", "label", "vector"), "bars": F.lit(None).cast("array<long>")}),
                   "hn_rows")
    anchors = whole.where(F.col("id") % anchor_every == 0)
    n_rows, n_anchors = whole.agg(F.count(F.lit(1)), F.count_if(F.col("id") % anchor_every == 0)).first()

    def positive(anchors_, others, scores) -> Iterator[tuple]:
        label = np.array([r["label"] for r in others], np.int64)
        ids = np.array([r["id"] if r["id"] is not None else -1 for r in others], np.int64)
        given = np.array([r["id"] is not None for r in others], bool)
        for r, score in zip(anchors_, scores):
            at = np.flatnonzero((label == r["label"]) & ~(given & (ids == r["id"])))
            for k in at[best_first(score[at], positives)]:
                yield r["own"], others[k]["id"], _saturated(score[k])

    def negative(anchors_, others, scores) -> Iterator[tuple]:
        label = np.array([r["label"] for r in others], np.int64)
        for r, score in zip(anchors_, scores):
            bars = sorted(set(r["bars"]))
            low = min((b for b in bars if b >= 0), default=None)
            if low is None:
                continue  # no score is both 80 percent of a negative number and below it
            at = np.flatnonzero((label != r["label"]) & (score <= bars[-1]) & (score >= -(-low_percent * low // 100)))
            for b in (b for b in bars if b >= 0):
                fits = at[(score[at] <= b) & (score[at] >= -(-low_percent * b // 100))]
                for k in fits[best_first(score[fits], negatives)]:
                    yield r["own"], b, others[k]["id"], _saturated(score[k])

    found = in_blocks(anchors, whole, positive, "own bigint, positive_id bigint, positive_score bigint", n_anchors, n_rows)
    best = Window.partitionBy("own").orderBy(F.desc("positive_score"), F.asc_nulls_last("positive_id"))
    chosen = stored(found.withColumn("place", F.row_number().over(best)).where(F.col("place") <= positives), "hn_positives")
    bars = chosen.groupBy("own").agg(F.collect_set("positive_score").alias("bars"))
    asking = anchors.drop("bars").join(bars, "own").select(*whole.columns)
    found = in_blocks(asking, whole, negative, "own bigint, positive_score bigint, negative_id bigint, negative_score bigint",
                      n_anchors, n_rows)
    best = Window.partitionBy("own", "positive_score").orderBy(F.desc("negative_score"), F.asc_nulls_last("negative_id"))
    hard = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= negatives)
    return (chosen.join(hard, ["own", "positive_score"]).join(anchors.select("own", F.col("id").alias("anchor_id")), "own")
            .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives(table(spark, sf_dir, "embeddings"))


OP13_SQL = """
with v as (
  select vec_id, case when vec_id % 7 = 0 then (label::bigint + 1) % 10 else label end as label,
         list_transform(embedding, lambda x : floor(256 * x::double)) as e
  from embeddings
  where label is not null and embedding is not null
    and len(list_filter(embedding, lambda x : x is null or not isfinite(x))) = 0),
s as (
  select a.vec_id as anchor_id, b.vec_id as other, a.label = b.label as same,
         list_inner_product(a.e, b.e)::bigint as score
  from v a join v b on a.vec_id != b.vec_id where a.vec_id % 100 = 0),
p as (
  select * from s where same
  qualify row_number() over (partition by anchor_id order by score desc, other) <= 5)
select p.anchor_id, p.other as positive_id,
       row_number() over (partition by p.anchor_id, p.other order by n.score desc, n.other)::int as rank,
       n.other as negative_id, p.score as positive_score, n.score as negative_score
from p join s n on n.anchor_id = p.anchor_id and not n.same
     and 80 * p.score <= 100 * n.score and 100 * n.score <= 100 * p.score
qualify rank <= 5
"""

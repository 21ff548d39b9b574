"""Recipes of the stages that ``features`` builds, fitted from a few numbers and read as expressions.

An indexer learns the order of its labels and a min-max scaler two numbers a column, so the
fits of all folds need a few passes over the table together (``Summary``), not two for each fold; the
fitted stages are MLlib's, fitted on a few rows that have the same order and the same ends.
``vector_slots`` has a fitted recipe's vector as expressions over the raw columns, by the same
arithmetic, for learners that need the values and not the vector. Other stages, or
values on which a fit would fail, are left to MLlib.
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import (MinMaxScaler, MinMaxScalerModel, OneHotEncoder, OneHotEncoderModel, StringIndexer,
                                StringIndexerModel, VectorAssembler)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, StringType

#: Most labels of a column whose order is told by a few rows.
MAX_LABELS = 40


def _names(stage, several: str, one: str) -> list[str]:
    return list(stage.getOrDefault(several)) if stage.isSet(several) else [stage.getOrDefault(one)]


class Summary:
    """What recipes learn from the rows of each value of ``by`` (all rows without it); ``fit``
    fits on any of these values together. ``known`` is false where MLlib has to fit."""

    def __init__(self, recipe: Pipeline, df: DataFrame, by: str | None = None):
        self.recipe, self.spark, self.known = recipe, df.sparkSession, False
        self.labels, self.numbers, made = [], [], set()
        for stage in recipe.getStages():
            if isinstance(stage, StringIndexer):
                if stage.getOrDefault("stringOrderType") != "frequencyDesc":
                    return
                self.labels += _names(stage, "inputCols", "inputCol")
                made |= set(_names(stage, "outputCols", "outputCol"))
            elif isinstance(stage, OneHotEncoder):
                made |= set(_names(stage, "outputCols", "outputCol"))
            elif isinstance(stage, VectorAssembler):
                self.numbers += [c for c in stage.getInputCols() if c not in made and c not in self.numbers]
                made.add(stage.getOutputCol())
            elif isinstance(stage, MinMaxScaler):
                made.add(stage.getOutputCol())
            else:
                return
        fields = {f.name: f.dataType for f in df.schema.fields}
        if made & set(fields) or any(not isinstance(fields.get(c), StringType) for c in self.labels) \
                or any(not isinstance(fields.get(c), NumericType) for c in self.numbers):
            return
        self.schema = df.select(*[F.col(f"`{c}`") for c in [*self.labels, *self.numbers]]).schema
        key = F.col(f"`{by}`") if by else F.lit("all")
        odd = [F.count_if(F.col(f"`{c}`").isNull() | F.isnan(F.col(f"`{c}`").cast("double"))) for c in self.numbers]
        ends = [f(F.col(f"`{c}`")) for c in self.numbers for f in (F.min, F.max)]
        self.ends, self.counts = {}, {c: {} for c in self.labels}
        for r in df.groupBy(key).agg(F.count(F.lit(1)), *odd, *ends).collect():
            if any(r[2:2 + len(odd)]):
                return
            self.ends[r[0]] = (r[1], r[2 + len(odd):])
        for c in self.labels:
            rows = df.where(F.col(f"`{c}`").isNotNull()).groupBy(key, F.col(f"`{c}`")).count()
            rows = rows.limit(MAX_LABELS * max(1, len(self.ends)) + 1).collect()
            for k, value, n in rows:
                self.counts[c].setdefault(k, {})[value] = n
            if not rows or len(rows) > MAX_LABELS * len(self.ends):
                return
        self.known = True

    def fit(self, without=None) -> PipelineModel | None:
        """The recipe fitted on all rows, or on those of all other values than ``without``; None
        where MLlib has to fit."""
        keys = [k for k in self.ends if without is None or k is not None and k != without] if self.known else []
        if not keys:
            return None
        columns = []
        for c in self.labels:
            total = {}
            for k in keys:
                for value, n in self.counts[c].get(k, {}).items():
                    total[value] = total.get(value, 0) + n
            if not 0 < len(total) <= MAX_LABELS:
                return None
            order = sorted(total, key=lambda v: (-total[v], v.encode("utf-16-be")))
            columns.append([v for i, v in enumerate(order) for _ in range(len(order) - i)])
        for i in range(len(self.numbers)):
            columns.append([min(self.ends[k][1][2 * i] for k in keys), max(self.ends[k][1][2 * i + 1] for k in keys)])
        rows = max(map(len, columns), default=0)
        if not rows:
            return None
        # labels are not repeated, so that their counts stay in order; ends may be
        padded = [c + [None] * (rows - len(c)) if i < len(self.labels) else (c * rows)[:max(rows, 2)] for i, c in enumerate(columns)]
        rows = max(map(len, padded))
        padded = [c + [None] * (rows - len(c)) for c in padded]
        return self.recipe.fit(self.spark.createDataFrame(list(zip(*padded)), self.schema).coalesce(1))


def fitted_on(recipe: Pipeline, df: DataFrame) -> PipelineModel:
    """``recipe.fit(df)``, from a summary where that says it all."""
    return Summary(recipe, df).fit() or recipe.fit(df)


def vector_slots(fitted: PipelineModel, raw: DataFrame, features: str):
    """(columns, slots): the vector ``features`` of a fitted recipe as expressions. ``columns``: name
    and expression of what is worked out first, from ``raw``; ``slots``: for every slot the name of
    such a column and, for a slot of a one-hot block, the place that it stands for, else None.
    Values are those of the vector; NULL or NaN in it gives NULL. None if a stage is not known here."""
    fields = {f.name: f.dataType for f in raw.schema.fields}
    columns, made = {}, {}  # made: of a column of the recipe its slots, as returned

    def number(c):
        if c not in fields or not isinstance(fields[c], NumericType):
            return None
        columns[f"__n_{c}"] = F.nanvl(F.col(f"`{c}`").cast("double"), F.lit(None))
        return [(f"__n_{c}", None)]

    for stage in fitted.stages:
        if isinstance(stage, StringIndexerModel):
            if stage.getOrDefault("handleInvalid") not in ("error", "keep"):
                return None
            keep = stage.getOrDefault("handleInvalid") == "keep"
            for a, b, labels in zip(_names(stage, "inputCols", "inputCol"), _names(stage, "outputCols", "outputCol"), stage.labelsArray):
                if not isinstance(fields.get(a), StringType) or not 0 < len(labels) <= MAX_LABELS:
                    return None
                place = F
                for i, v in enumerate(labels):
                    place = place.when(F.col(f"`{a}`") == F.lit(v), F.lit(float(i)))
                columns[f"__i_{b}"] = place.otherwise(F.lit(float(len(labels)) if keep else None))
                made[b] = [(f"__i_{b}", None)]
        elif isinstance(stage, OneHotEncoderModel):
            if stage.getOrDefault("handleInvalid") != "error":
                return None
            for a, b, n in zip(_names(stage, "inputCols", "inputCol"), _names(stage, "outputCols", "outputCol"), stage.categorySizes):
                if len(made.get(a, ())) != 1:
                    return None
                made[b] = [(made[a][0][0], j) for j in range(int(n) - bool(stage.getOrDefault("dropLast")))]
        elif isinstance(stage, VectorAssembler):
            if stage.getOrDefault("handleInvalid") != "error":
                return None
            parts = [made.get(c) or number(c) for c in stage.getInputCols()]
            if None in parts:
                return None
            made[stage.getOutputCol()] = [x for part in parts for x in part]
        elif isinstance(stage, MinMaxScalerModel):
            source = made.get(stage.getInputCol(), ())
            low, high = stage.originalMin.toArray(), stage.originalMax.toArray()
            floor, top = stage.getOrDefault("min"), stage.getOrDefault("max")
            if len(source) != len(low) or any(place is not None or not name.startswith("__n_") for name, place in source):
                return None
            own = []
            for i, (name, _) in enumerate(source):
                x = columns[name]
                scaled = (x - F.lit(float(low[i]))) * F.lit((top - floor) / (high[i] - low[i])) + F.lit(floor) \
                    if high[i] != low[i] else F.when(x.isNotNull(), F.lit((floor + top) / 2))
                columns[f"__s_{stage.getOutputCol()}_{i}"] = scaled
                own.append((f"__s_{stage.getOutputCol()}_{i}", None))
            made[stage.getOutputCol()] = own
        else:
            return None
    if features not in made or set(made) & set(fields):
        return None
    return {name: columns[name] for name, _ in made[features]}, made[features]

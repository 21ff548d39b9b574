"""Random forests grown from counted bins.

MLlib's forest keeps every row as an object with a number for each tree and walks all rows
through all trees at every level. A forest on histograms needs less: rows whose values fall
into the same bins (a cell) go the same way in every tree, so a tree needs of a cell the sum
of its drawn weights and of its weighted labels only. The estimators here are MLlib's with
another way to grow the trees:

* bins, thresholds, bootstrap (a Poisson weight for every row and tree), columns tried at a
  node, gain, the bounds on nodes, and the merging of siblings that predict the same are MLlib's
  rules, and the result is MLlib's model;
* rows become codes of their bins, one after the other in numpy; rows of one code and label
  are one row with a count, whose weight is drawn at once (a sum of n Poisson numbers is one
  of n times the mean);
* parts are hash buckets of the codes, as many as the rows need, and draws depend on seed, part
  and tree, so the forest depends neither on cores nor on how the table is dealt;
* at every level the parts add up their histograms tree by tree; a task for each tree sums
  them and splits its nodes. Histograms and the chosen splits are all that travels.

Nothing depends on values repeating: where no two rows share a cell, a cell is a row.
What is not covered (more than two classes, weights, entropy, no bootstrap, trees deeper than
``MAX_DEPTH``) is fitted by MLlib's own code, and so are tables of under ``LEAST_ROWS`` rows, dealt
and sorted by their content.
"""

from __future__ import annotations

import json
from contextlib import nullcontext
from math import ceil, exp, sqrt

import numpy as np
import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.ml.regression import RandomForestRegressionModel, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabulon.operators.recipes import vector_slots
from tabulon.session import kept, shared_path

#: Deepest trees that are grown here: a level's histograms have up to 2 ** depth nodes a tree.
MAX_DEPTH = 12
#: Values (rows x slots) of a part, and its least number of rows.
VALUES_A_PART, LEAST_ROWS_A_PART = 16_000_000, 50_000
MOST_ROWS_A_PART = 1_000_000
#: Fewer rows are left to MLlib, which is faster there: a level here is a job of its own.
LEAST_ROWS = 200_000
#: Least number of parts, so that small tables are grown by more than one task.
LEAST_PARTS = 8
#: Rows from which the thresholds are taken, as in MLlib.
SAMPLE = 10_000
#: A cell with more than this share of the sample is dealt over several parts.
HOT_SHARE = 0.01
#: Bytes of drawn sums that are kept between the levels; beyond it they are drawn again.
KEPT_BYTES, KEPT_BYTES_A_PART = 1 << 30, 1 << 26


def remember_raw(prepared: DataFrame, fitted: PipelineModel, raw: DataFrame, some: DataFrame | None = None) -> DataFrame:
    """``prepared``, knowing that it is ``fitted`` applied to ``raw``: a sample of it is then
    taken before the rows are prepared, or is ``some`` of the raw rows."""
    prepared._raw_side = (fitted, raw, some)
    return prepared


def hashed_share(df: DataFrame, share: float, seed: int) -> DataFrame:
    """About that share of the rows, chosen by a hash of all their columns: the same rows
    however the table is dealt."""
    if share >= 1:
        return df
    values = [vector_to_array(F.col(f"`{f.name}`")) if isinstance(f.dataType, VectorUDT) else F.col(f"`{f.name}`")
              for f in df.schema.fields]
    return df.where(F.pmod(F.xxhash64(*values, F.lit(seed)), F.lit(1 << 40)) < F.lit(int(share * (1 << 40))))


def sample_rows(df: DataFrame, rows: int = SAMPLE + SAMPLE // 2) -> DataFrame:
    """About so many rows (all of a small table), brought to the driver."""
    some = hashed_share(df, rows / max(1, df.count()), 0)
    return df.sparkSession.createDataFrame(some.collect(), df.schema)


def thresholds(values: np.ndarray, splits: int) -> np.ndarray:
    """MLlib's thresholds of a column: midpoints between neighbouring values, all of them where
    they are few, else those nearest to equal shares of the rows."""
    v, n = np.unique(values[~np.isnan(values)], return_counts=True)
    middle = (v[:-1] + v[1:]) / 2
    if len(v) - 1 <= splits:
        return middle
    out, stride = [], n.sum() / (splits + 1)
    upto, target = np.cumsum(n), stride
    for i in range(1, len(v)):
        if abs(upto[i - 1] - target) < abs(upto[i] - target):
            out.append(middle[i - 1])
            target += stride
    return np.array(out)


def arities(field) -> dict[int, int] | None:
    """Slots of a vector column that are categories, with how many; None if that is not known."""
    attrs = field.metadata.get("ml_attr", {}).get("attrs", {})
    out = {a["idx"]: 2 for a in attrs.get("binary", [])}
    for a in attrs.get("nominal", []):
        n = len(a["vals"]) if "vals" in a else a.get("num_vals")
        if not n:
            return None
        out[a["idx"]] = n
    return out


def _tried(strategy: str, slots: int, regression: bool, trees: int) -> int | None:
    """Columns tried at a node."""
    if strategy == "auto":
        strategy = "all" if trees == 1 else "onethird" if regression else "sqrt"
    return {"all": slots, "sqrt": ceil(sqrt(slots)), "onethird": ceil(slots / 3),
            "log2": max(1, ceil(np.log2(slots)))}.get(strategy)


class _Bins:
    """How vectors become codes: for every slot its thresholds or its number of categories;
    runs of slots share a whole number of 62 bits."""

    def __init__(self, limits: list, arity: dict[int, int]):
        self.limits, self.arity = limits, arity
        self.sizes = [arity.get(f, len(limits[f]) + 1) for f in range(len(limits))]
        self.runs, product = [[]], 1
        for f, n in enumerate(self.sizes):
            if product * n >= 1 << 62:
                self.runs.append([])
                product = 1
            self.runs[-1].append(f)
            product *= n

    def coder(self):
        limits, arity, sizes, runs = self.limits, self.arity, self.sizes, self.runs

        def code(x: np.ndarray) -> list[np.ndarray]:
            out = []
            for run in runs:
                total = np.zeros(len(x), np.int64)
                for f in run:
                    if f in arity:
                        b = x[:, f].astype(np.int64)
                        if len(b) and (b.min() < 0 or b.max() >= arity[f]):
                            raise ValueError(f"slot {f} has categories beyond {arity[f]}")
                    else:
                        b = np.searchsorted(limits[f], x[:, f], side="left")
                    total = total * sizes[f] + b
                out.append(total)
            return out

        return code

    def decoder(self):
        sizes, runs = self.sizes, self.runs

        def decode(codes: list[np.ndarray]) -> np.ndarray:
            out = np.empty((len(sizes), len(codes[0])), np.uint8)
            for run, total in zip(runs, codes):
                for f in reversed(run):
                    total, out[f] = np.divmod(total, sizes[f])
            return out

        return decode


def _coded_in_python(dataset: DataFrame, label: str, features: str, bins: _Bins, names: list[str]) -> DataFrame:
    """(k0, k1 ..., y) of vectors, batch by batch."""
    code = bins.coder()
    src = dataset.select(F.col(f"`{label}`").cast("double").alias("y"), vector_to_array(F.col(features)).alias("v"))

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                x = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
                yield pa.RecordBatch.from_arrays([*[pa.array(c) for c in code(x)], batch.column(0)], names=[*names, "y"])

    return src.mapInArrow(run, ", ".join(f"{k} bigint" for k in names) + ", y double")


def _coded_in_sql(raw: DataFrame, label: str, slots: tuple, bins: _Bins, names: list[str]) -> DataFrame:
    """The same from the raw columns by expressions (``recipes.vector_slots``), without a vector."""
    columns, places = slots

    def steps(x, limits, first=0):  # how many limits lie below x: a search by halves
        if not len(limits):
            return F.lit(first)
        m = len(limits) // 2
        return F.when(x <= F.lit(float(limits[m])), steps(x, limits[:m], first)).otherwise(
            steps(x, limits[m + 1:], first + m + 1))

    first = raw.select(F.col(f"`{label}`").cast("double").alias("y"), *[e.alias(n) for n, e in columns.items()])
    none = F.lit(False)
    for n in columns:
        none = none | F.col(f"`{n}`").isNull()
    out = []
    for name, run in zip(names, bins.runs):
        total = F.lit(0).cast("long")
        for f in run:
            column, place = places[f]
            x = F.col(f"`{column}`")
            b = (x == F.lit(float(place))).cast("long") if place is not None else \
                x.cast("long") if f in bins.arity else steps(x, bins.limits[f]).cast("long")
            total = total * F.lit(bins.sizes[f]) + b
        out.append(F.when(none, F.raise_error(F.lit("NULL, NaN or an unseen value among the features")).cast("long"))
                   .otherwise(total).alias(name))
    return first.select(*out, "y")


def coded_rows(coded: DataFrame, names: list[str], parts: int, hot: list, grouped: bool) -> DataFrame:
    """(k0, k1 ..., y, n): codes, label and how many rows are like that, dealt over ``parts``
    by a hash of the codes; where labels are many (not ``grouped``) a row each, and those of the
    ``hot`` codes by their label too."""
    if grouped:  # counted in the tasks that read, then by part
        some = coded.groupBy(*names, "y").agg(F.count(F.lit(1)).alias("n"))
        return some.repartition(parts, *names)
    salt = F.lit(0)
    for h in hot:
        here = F.lit(True)
        for k, value in zip(names, h):
            here = here & (F.col(k) == F.lit(int(value)))
        salt = F.when(here, F.pmod(F.xxhash64("y"), F.lit(64)).cast("int")).otherwise(salt)
    return coded.withColumns({"n": F.lit(1).cast("long"), "s": salt}).repartition(parts, *names, "s").drop("s")


def drawer(bins: _Bins, seed: int, trees: int, rate: float, third: bool):
    """A function from the batches of a part to its cells' bins (slots x cells) and, tree by
    tree, (tree, weights, weighted labels, weighted squares) of the cells."""
    decode, several = bins.decoder(), len(bins.runs)
    p, upto, values = exp(-rate), 0.0, []
    for k in range(64):  # chances of at most k
        upto += p
        values.append(upto)
        p *= rate / (k + 1)
    chances = np.array(values)
    # of 65,536 equal steps, the first that lies wholly above each chance, and those that hold one
    steps = np.ceil(chances * 65536)
    edge = np.unique(np.floor(chances[chances * 65536 < 65536] * 65536).astype(np.uint16))
    above = steps[steps < 65536].astype(np.uint16)

    def read(batches, part):
        got = [[c.to_numpy(zero_copy_only=False) for c in b.columns] for b in batches if b.num_rows]
        if not got:
            return None
        columns = [np.concatenate([g[i] for g in got]) for i in range(several + 2)]
        del got
        order = np.lexsort((columns[several], *columns[:several]))
        columns = [c[order] for c in columns]
        codes, y, n = columns[:several], columns[several], columns[several + 1]
        new = np.zeros(len(y), bool)
        new[:1] = True
        for c in codes:
            new[1:] |= c[1:] != c[:-1]
        cell = np.flatnonzero(new)
        new[1:] |= y[1:] != y[:-1]
        row = np.flatnonzero(new)
        n, y = np.add.reduceat(n, row), y[row]
        cells, start = decode([c[cell] for c in codes]), np.searchsorted(row, cell)
        many, own = np.flatnonzero(n > 1), np.flatnonzero(n == 1)
        square = y * y

        def each():
            for tree in range(trees):
                rng = np.random.Generator(np.random.SFC64([seed & 0xFFFFFFFF, part, tree]))
                w = np.empty(len(y))
                if len(own):
                    u = rng.bit_generator.random_raw(-(-len(own) // 4)).view(np.uint16)[:len(own)]
                    drawn = np.zeros(len(own), np.uint8)
                    for a in above:
                        drawn += u >= a
                    unsure = np.flatnonzero(np.isin(u, edge)) if len(edge) else []
                    if len(unsure):  # a step that holds a chance is told by a finer draw
                        drawn[unsure] = np.searchsorted(chances, (u[unsure] + rng.random(len(unsure))) / 65536, side="right")
                    w[own] = drawn
                if len(many):
                    w[many] = rng.poisson(n[many] * rate)
                wy = w * y
                yield (tree, np.add.reduceat(w, start), np.add.reduceat(wy, start),
                       np.add.reduceat(w * square, start) if third else None)

        return cells, each()

    return read


def grow(own: BinnedRows, trees: int, depth: int, seed: int, rate: float, tried: int, min_rows: int,
         min_gain: float) -> list[dict]:
    """The trees of a forest: for each a dict from a node's number (the root is 1, the children
    of i are 2i and 2i + 1) to (weight, label sum, square sum, gain, slot, bin, left
    categories); slot is -1 in a leaf."""
    rows, bins, regression = own.rows, own.bins, own.regression
    spark = rows.sparkSession
    sizes, arity = bins.sizes, bins.arity
    third, slots = regression, len(bins.sizes)
    starts = np.concatenate(([0], np.cumsum(sizes))).astype(np.int64)
    widest, width = max(sizes), int(starts[-1])
    draw = drawer(bins, seed, trees, rate, third)

    def drawn(batches):
        from pyspark import TaskContext

        found = draw(batches, TaskContext.get().partitionId())
        if found is None:
            return
        cells, each = found
        yield pa.RecordBatch.from_arrays([pa.array([-1], pa.int32()), pa.array([cells.tobytes()], pa.binary()),
                                          pa.array([b""], pa.binary()), pa.array([b""], pa.binary())], names=["t", "w", "a", "b"])
        for t, w, wy, wyy in each:
            yield pa.RecordBatch.from_arrays(
                [pa.array([t], pa.int32()), pa.array([w.astype(np.float32).tobytes() if w.max() < 1 << 24 else w.tobytes()], pa.binary()),
                 pa.array([wy.tobytes()], pa.binary()), pa.array([wyy.tobytes() if third else b""], pa.binary())],
                names=["t", "w", "a", "b"])

    def again(batches, part):
        def rows_of():
            for b in batches:
                for r in range(b.num_rows):
                    yield [c[r].as_py() if i == 0 else c[r].as_buffer() for i, c in enumerate(b.columns)]
        it = rows_of()
        head = next(it, None)
        if head is None:
            return None
        cells = np.frombuffer(head[1], np.uint8).reshape(slots, -1)
        n = cells.shape[1]

        def each():
            for t, w, a, b in it:
                w = np.frombuffer(w, np.float32 if w.size == 4 * n else np.float64).astype(float)
                yield t, w, np.frombuffer(a), np.frombuffer(b) if third else None
        return cells, each()

    def level(source, state, rounds):
        def run(batches):
            from pyspark import TaskContext

            part = TaskContext.get().partitionId()
            found = source(batches, part)
            if found is None:
                return
            slot, goes, place, many = state.value
            cells, each = found
            here = np.arange(cells.shape[1])
            for t, w, wy, wyy in each:
                if not many[t]:
                    continue
                at = np.ones(len(here), np.int64)
                for _ in range(rounds):
                    s = slot[t][at]
                    at = np.where(s < 0, 0, 2 * at + 1 - goes[t][at, cells[np.maximum(s, 0), here]])
                o = place[t][at]
                sel = np.flatnonzero((o >= 0) & (w > 0))
                if not len(sel):
                    continue
                base, sums = o[sel] * width, [x[sel] for x in ((w, wy, wyy) if third else (w, wy))]
                hist = np.zeros((many[t] * width, len(sums)))
                for f in range(slots):
                    if sizes[f] < 2 and f:
                        continue
                    idx = o[sel] * sizes[f] + cells[f, sel]
                    for k, x in enumerate(sums):
                        hist.reshape(many[t], width, -1)[:, starts[f]:starts[f + 1], k] = np.bincount(
                            idx, x, many[t] * sizes[f]).reshape(many[t], -1)
                yield pa.RecordBatch.from_arrays([pa.array([t], pa.int32()), pa.array([part], pa.int32()),
                                                  pa.array([hist.tobytes()], pa.binary())], names=["t", "part", "hist"])
        return run

    def chooser(state, mine):
        def best(table: pa.Table) -> pa.Table:
            t = table.column("t")[0].as_py()
            order = np.argsort(table.column("part").to_numpy())
            hists, total = table.column("hist"), None
            for i in order:  # always in the same order, as sums of doubles depend on it
                h = np.frombuffer(hists[int(i)].as_buffer())
                total = h.copy() if total is None else total + h
            many = state.value[3][t]
            total = total.reshape(many, width, -1)
            heaps = mine.value[t]
            out = []

            def impurity(x):
                w, a, b = x[..., 0], x[..., 1], x[..., -1]
                with np.errstate(divide="ignore", invalid="ignore"):
                    return (b - a * a / w) / w if regression else 2 * (a / w) * (1 - a / w)

            for i in range(many):
                node = total[i, starts[0]:starts[1]].sum(axis=0)
                w, found = node[0], None
                whole = impurity(node) if w else 0.0
                heap, allowed = heaps[i]
                for f in allowed:
                    if sizes[f] < 2 or not w:
                        continue
                    h, sort = total[i, starts[f]:starts[f + 1]], None
                    if f in arity:
                        with np.errstate(divide="ignore", invalid="ignore"):
                            middle = np.where(h[:, 0] > 0, h[:, 1] / h[:, 0], np.inf)
                        sort = np.argsort(middle, kind="stable")
                        h = h[sort]
                    left = np.cumsum(h, axis=0)[:-1]
                    right = node - left
                    ok = (left[:, 0] >= max(min_rows, 1)) & (right[:, 0] >= max(min_rows, 1))
                    if not ok.any():
                        continue
                    with np.errstate(invalid="ignore"):
                        gain = whole - left[:, 0] / w * impurity(left) - right[:, 0] / w * impurity(right)
                    gain = np.where(ok & (gain >= min_gain), gain, -np.inf)
                    b = int(np.argmax(gain))
                    if np.isfinite(gain[b]) and (found is None or gain[b] > found[0]):
                        found = (float(gain[b]), f, b, left[b], right[b], [int(c) for c in sort[:b + 1]] if sort is not None else [])
                full = lambda x: [float(x[0]), float(x[1]), float(x[-1])]
                if found is None or found[0] <= 0:
                    out.append(dict(t=t, heap=heap, slot=-1, bin=0, gain=-1.0, cats=[], own=full(node), l=[], r=[]))
                else:
                    out.append(dict(t=t, heap=heap, slot=found[1], bin=found[2], gain=found[0], cats=found[5],
                                    own=full(node), l=full(found[3]), r=full(found[4])))
            return pa.Table.from_pylist(out, schema=answer)
        return best

    answer = pa.schema([("t", pa.int32()), ("heap", pa.int32()), ("slot", pa.int32()), ("bin", pa.int32()), ("gain", pa.float64()),
                        ("cats", pa.list_(pa.int32())), ("own", pa.list_(pa.float64())), ("l", pa.list_(pa.float64())),
                        ("r", pa.list_(pa.float64()))])
    ddl = "t int, heap int, slot int, bin int, gain double, cats array<int>, own array<double>, l array<double>, r array<double>"
    tables = [{} for _ in range(trees)]
    slot = np.full((trees, 1 << depth), -1, np.int64)
    goes = np.zeros((trees, 1 << depth, widest), np.int64)
    opened = [[1] for _ in range(trees)]
    drawn_bytes = own.cells() * trees * (20 if third else 12)
    large = drawn_bytes > min(KEPT_BYTES, own.parts * KEPT_BYTES_A_PART)

    def tried_at(t, heap):
        if tried >= slots:
            return list(range(slots))
        rng = np.random.Generator(np.random.SFC64([seed & 0xFFFFFFFF, 1 << 40, t, heap]))
        return [int(f) for f in rng.choice(slots, tried, replace=False)]

    def grown_level(source, src, d):
        place = np.full((trees, 1 << (d + 1)), -1, np.int64)
        many = np.array([len(o) for o in opened])
        for t, o in enumerate(opened):
            place[t, o] = np.arange(len(o))
        state = spark.sparkContext.broadcast((slot, goes, place, many))
        mine = spark.sparkContext.broadcast({t: [(h, tried_at(t, h)) for h in o] for t, o in enumerate(opened) if o})
        hists = src.mapInArrow(level(source, state, d), "t int, part int, hist binary")
        found = hists.groupBy("t").applyInArrow(chooser(state, mine), ddl).collect()
        state.unpersist()
        mine.unpersist()
        nxt = [[] for _ in range(trees)]
        for r in found:
            t, h = r["t"], r["heap"]
            tables[t][h] = (*r["own"], r["gain"], r["slot"], r["bin"], list(r["cats"]))
            if r["slot"] < 0:
                continue
            f = r["slot"]
            slot[t, h] = f
            if f in arity:
                goes[t, h, list(r["cats"])] = 1
            else:
                goes[t, h, :r["bin"] + 1] = 1
            for child, stats in ((2 * h, r["l"]), (2 * h + 1, r["r"])):
                w, a, b = stats
                impurity = (b - a * a / w) / w if regression else 2 * (a / w) * (1 - a / w)
                tables[t][child] = (w, a, b, -1.0, -1, 0, [])
                if d + 1 < depth and abs(impurity) >= 2.220446049250313e-16:
                    nxt[t].append(child)
        return [sorted(o) for o in nxt]

    with nullcontext(rows) if large else kept(rows.mapInArrow(drawn, "t int, w binary, a binary, b binary")) as src:
        for d in range(depth):
            if any(opened):
                opened = grown_level(draw if large else again, src, d)
    return tables


NODES = pa.struct([("id", pa.int32()), ("prediction", pa.float64()), ("impurity", pa.float64()),
                   ("impurityStats", pa.list_(pa.float64())), ("rawCount", pa.int64()), ("gain", pa.float64()),
                   ("leftChild", pa.int32()), ("rightChild", pa.int32()),
                   ("split", pa.struct([("featureIndex", pa.int32()), ("leftCategoriesOrThreshold", pa.list_(pa.float64())),
                                        ("numCategories", pa.int32())]))])


def tree_rows(number: int, tree: dict, bins: _Bins, regression: bool) -> list[dict]:
    """The rows of MLlib's node table, numbered in preorder; sibling leaves that predict the
    same are one leaf."""
    def predicts(h):
        w, a = tree[h][:2]
        return a / w if regression and w else 1.0 if not regression and a > w - a else 0.0

    leaf = {h: v[4] < 0 for h, v in tree.items()}
    for h in sorted(tree, reverse=True):  # children before their parents
        if not leaf[h] and leaf[2 * h] and leaf[2 * h + 1] and predicts(2 * h) == predicts(2 * h + 1):
            leaf[h] = True
    order, todo = [], [1]
    while todo:
        h = todo.pop()
        order.append(h)
        if not leaf[h]:
            todo += [2 * h + 1, 2 * h]
    ids, out = {h: i for i, h in enumerate(order)}, []
    for h in order:
        w, a, b, gain, slot, at, cats = tree[h]
        if regression:
            stats, impurity = [w, a, b], (b - a * a / w) / w if w else 0.0
        else:
            stats, impurity = [w - a, a], 2 * (a / w) * (1 - a / w) if w else 0.0
        if leaf[h]:
            split = {"featureIndex": -1, "leftCategoriesOrThreshold": [], "numCategories": -1}
        elif slot in bins.arity:
            split = {"featureIndex": slot, "leftCategoriesOrThreshold": [float(c) for c in sorted(cats)], "numCategories": bins.arity[slot]}
        else:
            split = {"featureIndex": slot, "leftCategoriesOrThreshold": [float(bins.limits[slot][at])], "numCategories": -1}
        out.append({"treeID": number, "nodeData": {
            "id": ids[h], "prediction": predicts(h), "impurity": impurity, "impurityStats": stats, "rawCount": int(round(w)),
            "gain": -1.0 if leaf[h] else gain, "leftChild": -1 if leaf[h] else ids[2 * h],
            "rightChild": -1 if leaf[h] else ids[2 * h + 1], "split": split}})
    return out


def _saved(estimator, spark, tables: list[dict], bins: _Bins, regression: bool):
    """MLlib's model of these trees: its own files, written and loaded."""
    about_path, out = (shared_path(spark, "models", "forest", unique=True) for _ in range(2))
    estimator.write().save(about_path)
    about = json.loads(spark.read.text(f"{about_path}/metadata").first()[0])
    kind = "Regression" if regression else "Classification"
    family = "regression" if regression else "classification"
    about["class"] = f"org.apache.spark.ml.{family}.RandomForest{kind}Model"
    about |= {"numFeatures": len(bins.sizes), "numTrees": len(tables)} | ({} if regression else {"numClasses": 2})
    alone = about | {"class": f"org.apache.spark.ml.{family}.DecisionTree{kind}Model"}
    for key in ("paramMap", "defaultParamMap"):
        alone[key] = {k: v for k, v in about[key].items() if k not in ("numTrees", "featureSubsetStrategy", "subsamplingRate", "bootstrap")}
    nodes = [r for i, tree in enumerate(tables) for r in tree_rows(i, tree, bins, regression)]
    schema = pa.schema([("treeID", pa.int32()), ("nodeData", NODES)])
    spark.createDataFrame(pa.Table.from_pylist(nodes, schema=schema)).coalesce(1).write.parquet(f"{out}/data")
    each = [(i, json.dumps(alone | {"uid": f"{estimator.uid}_{i}"}), 1.0) for i in range(len(tables))]
    spark.createDataFrame(each, "_1 int, _2 string, _3 double").coalesce(1).write.parquet(f"{out}/treesMetadata")
    spark.createDataFrame([(json.dumps(about),)], "value string").coalesce(1).write.text(f"{out}/metadata")
    return (RandomForestRegressionModel if regression else RandomForestClassificationModel).load(out)


class BinnedRows:
    """The coded training rows of an estimator, which fits with other seeds or sizes share."""

    def __init__(self, estimator, dataset: DataFrame):
        self.regression = isinstance(estimator, RandomForestRegressor)
        get = lambda p: estimator.getOrDefault(p)
        label, features = get("labelCol"), get("featuresCol")
        self.rows = self.bins = None
        arity = arities(dataset.schema[features])
        y = F.col(f"`{label}`").cast("double")
        fitted, raw, some = getattr(dataset, "_raw_side", (None, dataset, None))
        if label not in raw.columns:
            fitted, raw, some = None, dataset, None
        n, lo, hi, missing, odd = raw.agg(F.count(F.lit(1)), F.min(y), F.max(y), F.count_if(y.isNull() | F.isnan(y)),
                                          F.count_if(~y.isin(0.0, 1.0))).first()
        if arity is None or n < max(1, LEAST_ROWS) or missing or not self.regression and (odd or hi != 1):
            return
        if some is None:
            some = hashed_share(raw, max(get("maxBins") ** 2, SAMPLE) / n, get("seed"))
        some = fitted.transform(some) if fitted is not None else some
        x = np.array([r[0] for r in some.select(vector_to_array(F.col(features))).collect()], float)
        if not len(x):
            return
        most = min(get("maxBins"), n)
        if any(a > most for a in arity.values()):
            return  # MLlib says so
        limits = [np.empty(0) if f in arity else thresholds(x[:, f], most - 1) for f in range(x.shape[1])]
        self.bins = _Bins(limits, arity)
        in_part = min(MOST_ROWS_A_PART, max(LEAST_ROWS_A_PART, VALUES_A_PART // x.shape[1]))
        parts = max(LEAST_PARTS, -(-n // in_part))
        codes, times = np.unique(np.array(self.bins.coder()(x)), axis=1, return_counts=True)
        hot = [tuple(c) for c in codes.T[times > max(HOT_SHARE * len(x), 1)]]
        self.parts, self._cells = parts, None
        self.names = [f"k{i}" for i in range(len(self.bins.runs))]
        slots = vector_slots(fitted, raw, features) if fitted is not None else None
        coded = (_coded_in_sql(raw, label, slots, self.bins, self.names) if slots else
                 _coded_in_python(dataset, label, features, self.bins, self.names))
        self.rows = coded_rows(coded, self.names, parts, hot, not self.regression)

    def cells(self) -> int:
        """Different codes among the rows."""
        if self._cells is None:
            self._cells = self.rows.select(*self.names).distinct().count()
        return self._cells


def covers(estimator) -> bool:
    """Whether the estimator grows its trees here, if its labels are what they should be."""
    if not isinstance(estimator, _Binned):
        return False
    get = estimator.getOrDefault
    weighted = estimator.isDefined("weightCol") and bool(get("weightCol"))
    return (not weighted and get("bootstrap") and 1 <= get("maxDepth") <= MAX_DEPTH and get("maxBins") <= 256
            and get("minWeightFractionPerNode") == 0 and get("impurity") in ("gini", "variance")
            and not (estimator.hasParam("thresholds") and estimator.isDefined("thresholds")))


class _Binned:
    #: The coded rows to grow from, where they are shared (``models.fit_forest``).
    shared_rows: BinnedRows | None = None

    def _fit(self, dataset):
        own = self.shared_rows or (BinnedRows(self, dataset) if covers(self) else None)
        get = self.getOrDefault
        tried = own is not None and own.rows is not None and _tried(
            get("featureSubsetStrategy"), len(own.bins.sizes), own.regression, get("numTrees"))
        if not tried and own is None:
            return super()._fit(dataset)
        if not tried:
            label, features = get("labelCol"), get("featuresCol")
            dealt = dataset.select(label, features, vector_to_array(F.col(features)).alias("__v"))
            dealt = dealt.repartition(16, "__v", label).sortWithinPartitions("__v", label)
            with kept(dealt.select(label, features)) as dealt:
                return super()._fit(dealt)
        with nullcontext() if self.shared_rows else kept(own.rows):
            tables = grow(own, get("numTrees"), get("maxDepth"), get("seed"), get("subsamplingRate"), tried,
                          get("minInstancesPerNode"), get("minInfoGain"))
        return _saved(self, dataset.sparkSession, tables, own.bins, own.regression)


class BinnedForestClassifier(_Binned, RandomForestClassifier):
    """MLlib's random forest of two classes, grown from counted bins."""


class BinnedForestRegressor(_Binned, RandomForestRegressor):
    """MLlib's random forest regression, grown from counted bins."""

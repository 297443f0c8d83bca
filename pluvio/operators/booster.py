"""Boosted regression trees grown level by level from histograms that Spark adds up.

Every column is cut into at most 255 parts; a null or NaN is a part of its own, and each split learns the side on which it goes. A level of a tree is one job
of one stage: as many tasks as run at once count gradients and rows by (lane, node, column, part), and the driver, which gets lanes x nodes x columns x 256 counts
a task at most whatever the number of rows, adds them up and picks the splits. An exchange between would cost such small jobs more than the counting. Lanes are models that grow side by side in the same jobs: lane f leaves out the rows of fold f, and the last lane leaves out none,
so folds cost no fits of their own and out-of-fold predictions are the margins that the rows already carry.

Labels and gradients are whole numbers of a unit that follows from the greatest label, so that their sums are exact: the same rows give the same trees in any order and partitioning.
Rows and columns of a tree are drawn by keyed hash. Rows whose label is null or not finite are left out; without rows the model predicts 0.
"""

from __future__ import annotations

import json
import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import stored
from ..workers import portable
from . import sampling

MISSING, PARTS, LEAF = 255, 256, -1
CUT_ROWS = 20_000  # cuts are quantiles of so many rows, those with the least keyed hashes
SNAPSHOT = 8  # trees after which the margins are written
UNIT_BITS, LEAST_GAIN = 24, 1e-6


@dataclass(frozen=True)
class Settings:
    trees: int = 400
    depth: int = 6
    rate: float = 0.05
    rows: float = 0.8  # share of the rows that a tree sees
    columns: float = 0.8  # share of the columns that a tree may split
    least_rows: int = 5  # in each child
    ridge: float = 1.0
    seed: int = 0


@dataclass
class Trees:
    """Of each tree and node (children of i: 2i + 1 and 2i + 2) the split column or LEAF, the last part that goes left, the side of nulls, and the value of a row that ends there."""

    column: np.ndarray
    part: np.ndarray
    null_left: np.ndarray
    value: np.ndarray

    @staticmethod
    def blank(count: int, depth: int) -> Trees:
        shape = (count, 2 ** (depth + 1) - 1)
        return Trees(np.full(shape, LEAF, np.int16), np.zeros(shape, np.uint8), np.zeros(shape, bool), np.zeros(shape))

    def end(self, i: int, parts: np.ndarray, depth: int) -> np.ndarray:
        """The node that each row of parts reaches in tree i within so many steps."""
        node, row = np.zeros(len(parts), np.int64), np.arange(len(parts))
        for _ in range(depth):
            column = self.column[i][node]
            inner = column != LEAF
            if not inner.any():
                break
            part = parts[row, np.maximum(column, 0)]
            left = np.where(part == MISSING, self.null_left[i][node], part <= self.part[i][node])
            node = np.where(inner, 2 * node + 2 - left, node)
        return node


@dataclass
class Model:
    columns: tuple[str, ...]
    cuts: list[list[float]]
    base: float
    unit: float
    depth: int
    trees: Trees

    def predict(self, parts: np.ndarray) -> np.ndarray:
        out = np.full(len(parts), self.base)
        for i in range(len(self.trees.column)):
            out += self.trees.value[i][self.trees.end(i, parts, self.depth)]
        return out * self.unit


def parts_of(values: list[np.ndarray], cuts: list[list[float]]) -> np.ndarray:
    """Rows x columns: the number of cuts below each value, MISSING for NaN."""
    out = np.empty((len(values[0]), len(cuts)), np.uint8)
    for j, (x, c) in enumerate(zip(values, cuts)):
        out[:, j] = np.where(np.isnan(x), MISSING, np.searchsorted(np.asarray(c), x, "left"))
    return out


def cuts_of(values: np.ndarray) -> list[float]:
    """All values but the greatest if there are up to 255 different ones, else 254 quantiles that occur."""
    x = np.sort(values[np.isfinite(values)])
    different = np.unique(x)
    if len(different) > MISSING:
        different = np.append(np.unique(x[(np.arange(1, MISSING) * len(x)) // MISSING]), x[-1])
        different = np.unique(different)
    return [float(v) for v in different[:-1]]


def draws(h: np.ndarray, seed: int, tree: int, lane: int) -> np.ndarray:
    """A number from 0 to 1 of each key's hash for this tree and lane."""
    mask = (1 << 64) - 1
    x = h.astype(np.int64).view(np.uint64) ^ np.uint64((seed * 0x9E3779B97F4A7C15 + tree * 0xBF58476D1CE4E5B9 + lane * 0x94D049BB133111EB) & mask)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return ((x ^ (x >> np.uint64(31))) >> np.uint64(11)) / float(1 << 53)


def chosen(settings: Settings, n_columns: int, tree: int, lane: int) -> list[int]:
    """The columns that a tree may split, at least one."""
    order = np.argsort(draws(np.arange(1, n_columns + 1), settings.seed + 1, tree, lane), kind="stable")
    return sorted(int(c) for c in order[: max(1, math.floor(settings.columns * n_columns))])


def best_splits(g: np.ndarray, n: np.ndarray, settings: Settings, unit: float) -> list[tuple | None]:
    """Of each node, whose gradients and rows are given by (node, column, part): (column, part, null_left, gradient and rows of the left and of the right) or
    None. Ties go to the first column, the lowest part and nulls on the right."""
    known_g, known_n = np.cumsum(g[:, :, :MISSING], 2), np.cumsum(n[:, :, :MISSING], 2)
    all_g, all_n = known_g[:, :, -1:] + g[:, :, MISSING:], known_n[:, :, -1:] + n[:, :, MISSING:]
    left_g, left_n = np.stack([known_g, known_g + g[:, :, MISSING:]], 3), np.stack([known_n, known_n + n[:, :, MISSING:]], 3)
    right_g, right_n = all_g[..., None] - left_g, all_n[..., None] - left_n
    worth = lambda a, b: a.astype(float) ** 2 / np.maximum(b + settings.ridge, 1e-12)
    gain = worth(left_g, left_n) + worth(right_g, right_n) - worth(all_g, all_n)[..., None]
    gain[(left_n < max(1, settings.least_rows)) | (right_n < max(1, settings.least_rows))] = -np.inf
    out: list[tuple | None] = []
    for i, best in enumerate(gain.reshape(len(g), -1).argmax(1)):
        j, p, null_left = np.unravel_index(best, gain.shape[1:])
        at = (i, j, p, null_left)
        out.append((int(j), int(p), bool(null_left), left_g[at], left_n[at], right_g[at], right_n[at]) if gain[at] * unit * unit > LEAST_GAIN else None)
    return out


def _rows(batch: pa.RecordBatch, lanes: int) -> tuple[np.ndarray, ...]:
    parts = np.frombuffer(b"".join(batch.column("parts").to_pylist()), np.uint8).reshape(batch.num_rows, -1)
    margins = batch.column("margins").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, lanes)
    return batch.column("h").to_numpy(), batch.column("fold").to_numpy(), parts, batch.column("q").to_numpy(), margins


def moved(margins: np.ndarray, parts: np.ndarray, recent: list[Trees], depth: int) -> np.ndarray:
    """Margins after the trees since the last snapshot, one of each lane a step."""
    out = margins.copy()
    for trees in recent:
        for lane in range(out.shape[1]):
            out[:, lane] += trees.value[lane][trees.end(lane, parts, depth)]
    return out


def _count(settings: Settings, lanes: int, n_columns: int, number: int, level: int, recent: list[Trees], growing: Trees):
    """Of each batch, gradients and rows of the level's nodes; a task returns the cells that are not empty."""
    width, first = 2**level, 2**level - 1
    columns = [chosen(settings, n_columns, number, lane) for lane in range(lanes)]

    def run(batches):
        g, n = np.zeros((lanes, width, n_columns, PARTS)), np.zeros((lanes, width, n_columns, PARTS), np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            h, fold, parts, q, margins = _rows(batch, lanes)
            margins = moved(margins, parts, recent, settings.depth)
            for lane in range(lanes):
                node = growing.end(lane, parts, level) - first
                use = (node >= 0) & (fold != lane) & (draws(h, settings.seed, number, lane) < settings.rows)
                at, slope = node[use] * PARTS, np.rint(margins[use, lane] - q[use])
                for j in columns[lane]:
                    cell = at + parts[use, j]
                    g[lane, :, j] += np.bincount(cell, slope, width * PARTS).reshape(width, PARTS)
                    n[lane, :, j] += np.bincount(cell, minlength=width * PARTS).reshape(width, PARTS)
        cells = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(cells), pa.array(g.ravel()[cells].astype(np.int64)), pa.array(n.ravel()[cells])], ["cell", "g", "n"])

    return run


def _move(lanes: int, depth: int, recent: list[Trees]):
    def run(batches):
        for batch in batches:
            if batch.num_rows:
                h, fold, parts, q, margins = _rows(batch, lanes)
                flat = pa.array(moved(margins, parts, recent, depth).ravel())
                lists = pa.ListArray.from_arrays(pa.array(np.arange(0, len(flat) + 1, lanes, dtype=np.int32)), flat)
                yield pa.RecordBatch.from_arrays([batch.column(c) for c in ("h", "fold", "parts", "q")] + [lists], ["h", "fold", "parts", "q", "margins"])

    return run


def prepared(df: DataFrame, columns: tuple[str, ...], label: str, keys: list[str], fold: Column | None = None, seed: int = 0) -> tuple[DataFrame, list[list[float]]]:
    """h, fold, parts and y of every row whose label is finite, and the cuts. ``fold`` is null or below 0 for rows that every lane learns from."""
    number = F.coalesce(F.lit(-1) if fold is None else fold.cast("int"), F.lit(-1))
    rows = df.select(sampling.lane(keys, seed).alias("h"), number.alias("fold"), F.col(label).cast("double").alias("y"), *(F.col(c).cast("double").alias(f"x{j}") for j, c in enumerate(columns)))
    rows = stored.stored(rows.where(F.col("y").isNotNull() & ~F.isnan("y") & (F.abs("y") < float("inf"))), "booster_rows")
    names = [f"x{j}" for j in range(len(columns))]
    seen = sampling.bottom_k(rows, ["h"], CUT_ROWS, seed).select(*names).toPandas()
    cuts = [cuts_of(seen[c].to_numpy(float)) for c in names]

    def run(batches):
        for batch in batches:
            values = [batch.column(c).to_numpy(zero_copy_only=False).astype(float) for c in names]
            parts = [row.tobytes() for row in parts_of(values, cuts)]
            yield pa.RecordBatch.from_arrays([batch.column("h"), batch.column("fold"), pa.array(parts, pa.binary()), batch.column("y")], ["h", "fold", "parts", "y"])

    return rows.mapInArrow(portable(run), "h long, fold int, parts binary, y double"), cuts


def boost(rows: DataFrame, columns: tuple[str, ...], cuts: list[list[float]], folds: int = 0, settings: Settings | None = None) -> tuple[list[Model], DataFrame]:
    """The models of lanes 0 to ``folds``, the last of which learns from all rows, and the rows (h, fold, parts, y) with ``margins``: what each lane predicts for them."""
    settings, lanes = settings or Settings(), folds + 1
    table, held = stored.keep(rows, "booster_labels")
    most = table.agg(F.max(F.abs("y"))).first()[0] or 0.0
    unit = 2.0 ** (math.frexp(most)[1] - UNIT_BITS) if most else 2.0**-UNIT_BITS
    state = table.select("h", "fold", "parts", F.rint(F.col("y") / unit).cast("long").alias("q"))
    sums = {r.fold: (r.q, r.n) for r in state.groupBy("fold").agg(F.sum("q").alias("q"), F.count(F.lit(1)).alias("n")).collect()}
    base = []
    for lane in range(lanes):
        q, n = (sum(v[i] for f, v in sums.items() if f != lane) for i in (0, 1))
        base.append(q / n if n else 0.0)
    state = state.withColumn("margins", F.array(*map(F.lit, base)))
    grown: list[Trees] = []
    recent: list[Trees] = []
    tasks = table.sparkSession.sparkContext.defaultParallelism
    for number in range(settings.trees if sums else 0):
        tree = Trees.blank(lanes, settings.depth)
        for level in range(settings.depth):
            width, first = 2**level, 2**level - 1
            kernel = portable(_count(settings, lanes, len(columns), number, level, recent, tree))
            told = state.coalesce(tasks).mapInArrow(kernel, "cell long, g long, n long").toArrow()
            g, n = np.zeros(lanes * width * len(columns) * PARTS, np.int64), np.zeros(lanes * width * len(columns) * PARTS, np.int64)
            for counts, name in ((g, "g"), (n, "n")):
                np.add.at(counts, told["cell"].to_numpy(), told[name].to_numpy())
            splits = best_splits(g.reshape(lanes * width, len(columns), PARTS), n.reshape(lanes * width, len(columns), PARTS), settings, unit)
            for i, split in enumerate(splits):
                if level == 0:
                    j = chosen(settings, len(columns), number, i)[0]
                    here_g, here_n = g.reshape(lanes, len(columns), PARTS)[i, j].sum(), n.reshape(lanes, len(columns), PARTS)[i, j].sum()
                    tree.value[i, 0] = -settings.rate * here_g / (here_n + settings.ridge) if here_n else 0.0
                if split:
                    lane, node = i // width, first + i % width
                    j, part, null_left, left_g, left_n, right_g, right_n = split
                    tree.column[lane, node], tree.part[lane, node], tree.null_left[lane, node] = j, part, null_left
                    tree.value[lane, 2 * node + 1] = -settings.rate * left_g / (left_n + settings.ridge)
                    tree.value[lane, 2 * node + 2] = -settings.rate * right_g / (right_n + settings.ridge)
            if not any(splits):
                break
        grown.append(tree)
        recent.append(tree)
        if len(recent) == SNAPSHOT or number == settings.trees - 1:
            state, before = _snapshot(state, lanes, settings.depth, recent), held
            state, held = state
            before.release()
            recent = []
    models = [Model(tuple(columns), cuts, base[lane], unit, settings.depth, _lane(grown, lane, settings.depth)) for lane in range(lanes)]
    return models, state.select("h", "fold", "parts", (F.col("q") * unit).alias("y"), F.transform("margins", lambda m: m * unit).alias("margins"))


def _snapshot(state: DataFrame, lanes: int, depth: int, recent: list[Trees]) -> tuple[DataFrame, stored.Kept]:
    return stored.keep(state.mapInArrow(portable(_move(lanes, depth, recent)), "h long, fold int, parts binary, q long, margins array<double>"), "booster_margins")


def _lane(grown: list[Trees], lane: int, depth: int) -> Trees:
    if not grown:
        return Trees.blank(0, depth)
    return Trees(*(np.stack([getattr(t, name)[lane] for t in grown]) for name in ("column", "part", "null_left", "value")))


def predict(model: Model) -> Column:
    """What the model expects from its columns; nulls are allowed in all of them."""

    def run(*values: pd.Series) -> pd.Series:
        return pd.Series(model.predict(parts_of([v.to_numpy(float) for v in values], model.cuts)))

    return F.pandas_udf(portable(run), "double")(*(F.col(c).cast("double") for c in model.columns))


def save(model: Model, path: str) -> None:
    """Nodes as a table, cuts and units beside it."""
    spark, t = SparkSession.getActiveSession(), model.trees
    tree, node = np.indices(t.column.shape)
    nodes = pd.DataFrame({"tree": tree.ravel(), "node": node.ravel(), "column": t.column.ravel().astype(int), "part": t.part.ravel().astype(int), "null_left": t.null_left.ravel(), "value": t.value.ravel()})
    spark.createDataFrame(nodes, "tree int, node int, column int, part int, null_left boolean, value double").coalesce(1).write.mode("overwrite").parquet(f"{path}/nodes")
    facts = {"columns": model.columns, "cuts": model.cuts, "base": model.base, "unit": model.unit, "depth": model.depth, "trees": len(t.column)}
    spark.createDataFrame([(json.dumps(facts),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/facts")


def load(spark: SparkSession, path: str) -> Model:
    facts = json.loads(spark.read.text(f"{path}/facts").first().value)
    nodes = spark.read.parquet(f"{path}/nodes").toPandas().sort_values(["tree", "node"])
    shape = (facts["trees"], 2 ** (facts["depth"] + 1) - 1)
    trees = Trees(*(nodes[c].to_numpy(kind).reshape(shape) for c, kind in (("column", np.int16), ("part", np.uint8), ("null_left", bool), ("value", float))))
    return Model(tuple(facts["columns"]), facts["cuts"], facts["base"], facts["unit"], facts["depth"], trees)

"""Trees grown from histograms, many of them at once: decision trees, forests, boosted trees.

Every row has a gradient g and a weight h. A node holds G = sum(g), H = sum(h) and n rows; its value is G / (H + l2) and a
split is worth GL^2 / (HL + l2) + GR^2 / (HR + l2) - G^2 / (H + l2). With g = weight * label and h = weight that is the fall
of the weighted Gini impurity and the value is the share of class 1; with the derivatives of the log loss it is
second-order boosting. One grower serves both.

Growing goes in waves, and a wave is one Spark job whatever the number of trees: tasks count the sums by (node, feature, bin)
of all nodes that wait in all trees, a shuffle adds them up bucket by bucket, and each node's best split comes
to the driver. Sums are whole numbers (of 2^-20), so results do not depend on how rows are dealt to tasks.

Once a node of a tree without boosting or a limit of leaves has at most ``ALONE`` rows, they are sent together, and a task grows
all that is below the node from them. So deep levels cost one pass of the rows instead of one for each level. In the same way a
boosted model whose first root has at most ``WHOLE`` rows gets them sent once, and a task grows its rounds one after the other.

A tree takes the splits of largest bottleneck, the smallest gain on the way from the root: that is the order in
which always splitting the best leaf takes them. A limit of leaves keeps the first ones; without a limit the tree grows level by
level.
"""

from __future__ import annotations

import json
import sys
from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import asdict, dataclass, field, replace
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tenura.functions import tables
from tenura.functions.tables import literal_table, materialize, release
from tenura.operators import ordered

# executors run the task functions below without having the package installed
for module in (sys.modules[__name__], tables):
    cloudpickle.register_pickle_by_value(module)

#: Sums are whole multiples of 1 / SCALE.
SCALE = 1 << 20
BINS = 128
#: Bounds of a wave: cells counted, (row, tree) pairs held at once in a task, trees that grow side by side.
CELLS, PAIRS, LANES = 1 << 23, 1 << 21, 512
#: Cells that are added up in a bucket.
CELLS_PER_BUCKET = 1 << 17
#: Cells of features that are counted as one.
JOINT = 128
#: Rows of a node that one task grows on alone, rows of such nodes that travel together, and (row, tree) pairs sent at once.
ALONE, TOGETHER, SENT = 1 << 16, 1 << 17, 1 << 28
#: Rows of a boosted model whose rounds one task grows alone, such models that it grows, and rows that it counts at once.
WHOLE, ABREAST, COUNTED = 1 << 20, 4, 1 << 15
#: Nodes of a search's models that are on the driver at once, and nodes that come to it from a job.
HELD = 1 << 19
#: Nodes of the models that a task scores with at once.
NODES = 1 << 23
#: Rows, or bytes of them with their margins, that a task counts together.
ROWS, BYTES = 1 << 17, 1 << 26
#: Boosting rounds after which the rows' margins are written anew. Until then every wave asks the rounds' trees again.
ROUNDS_KEPT = 1
LEAST_GAIN = 1e-9
NO_LIMIT = 1 << 30


@dataclass(frozen=True)
class Setting:
    """How to grow one model. ``left_out`` is the fold that it does not see (-1: it sees all)."""

    boosted: bool = False
    trees: int = 1
    max_depth: int = NO_LIMIT
    leaves: int = NO_LIMIT
    min_split: int = 2
    min_leaf: int = 1
    min_weight: float = 0.0
    l2: float = 0.0
    rate: float = 1.0
    row_share: float = 1.0
    bootstrap: bool = False
    column_share: float = 1.0
    node_columns: int = 0
    weights: tuple[float, float] = (1.0, 1.0)
    left_out: int = -1
    seed: int = 42


@dataclass
class Model:
    """A grown model. Node arrays hold all trees; ``roots`` says where each begins, ``feature`` is -1 at a leaf.

    A row goes left if its feature's bin is at most ``cut``; bin b ends at the feature's b-th cut point.
    """

    setting: Setting
    cuts: list[list[float]]
    features: list[str] = field(default_factory=list)
    roots: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    nodes: dict[str, np.ndarray] = field(default_factory=dict)

    def bins(self, x: np.ndarray) -> np.ndarray:
        return to_bins(x, self.cuts)

    def table(self, spark: SparkSession) -> DataFrame:
        """One row for each node that can be reached: tree, node, feature, cut point, gain, rows, value."""
        rows = []
        tree = np.repeat(np.arange(len(self.roots)), np.diff(np.append(self.roots, len(self.nodes["feature"]))))
        for i, t in enumerate(tree):
            f, c = int(self.nodes["feature"][i]), int(self.nodes["cut"][i])
            name = self.features[f] if f >= 0 and self.features else (str(f) if f >= 0 else None)
            rows.append((int(t), i - int(self.roots[t]), name, float(self.cuts[f][c]) if f >= 0 else None,
                         float(self.nodes["gain"][i]) if f >= 0 else None, int(self.nodes["n"][i]), float(self.nodes["value"][i])))
        return literal_table(spark, rows, ["tree", "node", "feature", "cut", "gain", "rows", "value"])

    def save(self, spark: SparkSession, path: str) -> None:
        """A table of one row for each tree, with the setting and the cut points."""
        ends = np.append(self.roots, len(self.nodes["feature"]))
        rows = [(i, {k: v[a:b].astype(float).tolist() for k, v in self.nodes.items()})
                for i, (a, b) in enumerate(zip(ends, ends[1:]))]
        spark.createDataFrame(rows, "tree int, nodes map<string, array<double>>").write.mode("overwrite").parquet(f"{path}/trees")
        about = json.dumps({"setting": asdict(self.setting), "cuts": self.cuts, "features": self.features})
        spark.createDataFrame([(about,)], "about string").write.mode("overwrite").parquet(f"{path}/about")

    @staticmethod
    def load(spark: SparkSession, path: str) -> Model:
        about = json.loads(spark.read.parquet(f"{path}/about").first()["about"])
        setting = Setting(**{**about["setting"], "weights": tuple(about["setting"]["weights"])})
        model = Model(setting, about["cuts"], about["features"])
        for r in spark.read.parquet(f"{path}/trees").orderBy("tree").collect():
            _append(model, {k: np.array(v).astype(_KINDS[k]) for k, v in r["nodes"].items()}, offset=False)
        return model


_KINDS = {"feature": np.int16, "cut": np.int16, "left": np.int64, "right": np.int64, "depth": np.int32, "n": np.int64,
          "gain": np.float64, "value": np.float64}


def _append(model: Model, tree: dict[str, np.ndarray], offset: bool = True) -> None:
    at = len(model.nodes["feature"]) if model.nodes else 0
    if offset:
        tree = tree | {"left": tree["left"] + at, "right": tree["right"] + at}
    model.roots = np.append(model.roots, at)
    model.nodes = {k: np.concatenate([model.nodes[k], v]) if model.nodes else v for k, v in tree.items()}


def _shared(df: DataFrame, value):
    """A broadcast that tasks read with ``_read``; its classes travel with it."""
    return df.sparkSession.sparkContext.broadcast(cloudpickle.dumps(value))


def _read(shared):
    return cloudpickle.loads(shared.value)


# binned rows

def to_bins(x: np.ndarray, cuts: Sequence[Sequence[float]]) -> np.ndarray:
    """Bin of each value: how many cut points lie below it."""
    out = np.zeros(x.shape, np.uint8)
    for i, c in enumerate(cuts):
        out[:, i] = np.searchsorted(np.asarray(c, np.float64), x[:, i], "left")
    return out


def cut_points(rows: DataFrame, n_features: int, bins: int = BINS) -> list[list[float]]:
    """The upper ends of all bins but the last, for each place of the array column ``x``.

    A feature of at most ``bins`` different values has a bin for each; otherwise a value's bin is its share of smaller
    rows, in ``bins`` equal parts. Counted over distinct values, exactly.
    """
    if not 2 <= bins <= 256:
        raise ValueError("between 2 and 256 bins")
    long = rows.select(F.posexplode("x").alias("feature", "value"))
    counts = ordered.ordered_counts(long, "value", ["feature"])
    distinct = F.count(F.lit(1)).over(Window.partitionBy("feature"))
    part = F.floor(F.col("before") * bins / F.col("total"))
    # of few values each is its own part
    keyed = counts.withColumn("part", F.when(distinct <= bins, F.col("value")).otherwise(part.cast("double")))
    ends = keyed.groupBy("feature", "part").agg(F.max("value").alias("cut"))
    cuts: list[list[float]] = [[] for _ in range(n_features)]
    for r in ends.collect():
        cuts[r["feature"]].append(r["cut"])
    return [sorted(c)[:-1] for c in cuts]


def binned(ready: DataFrame, cuts: Sequence[Sequence[float]], features: str = "features", label: str = "label") -> DataFrame:
    """``label`` (-1: none) and ``fold`` (-2: none, so that no model leaves it out), ``row`` (a hash for sampling) and ``bins``, written once.

    There are as many parts as tasks can run at once at least, as every wave passes over all of them.
    """
    key = [c for c in ready.columns if c not in (features, label, "fold", "split")]
    x = vector_to_array(features)
    row = F.xxhash64(*[F.col(f"`{c}`") for c in key]) if key else F.xxhash64(x)
    fold = F.coalesce("fold", F.lit(-2)) if "fold" in ready.columns else F.lit(-2)
    rows = ready.select(F.coalesce(label, F.lit(-1)).cast("int").alias("label"), fold.cast("int").alias("fold"),
                        row.alias("row"), x.alias("x"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column("x"), len(cuts))
            made = [b.tobytes() for b in to_bins(x, cuts)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("label"), batch.column("fold"), batch.column("row"), pa.array(made, pa.binary())],
                ["label", "fold", "row", "bins"])

    made = rows.mapInArrow(run, "label int, fold int, row bigint, bins binary")
    least = ready.sparkSession.sparkContext.defaultParallelism
    table = materialize(made)
    return table if table.rdd.getNumPartitions() >= least else materialize(table.repartition(least, "row"))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), width)


def _bytes(column: pa.Array, kind, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(len(column), width)


# routing and scoring

def _descend(bins: np.ndarray, nodes: Mapping[str, np.ndarray], root: int, rows: np.ndarray | None = None) -> np.ndarray:
    """The node at which each row ends in the tree below ``root``; a tree at a time, so that its nodes stay in the cache."""
    feature, cut, left, right = (nodes[k] for k in ("feature", "cut", "left", "right"))
    n = len(bins) if rows is None else len(rows)
    out = np.full(n, root, np.int64)
    if feature[root] < 0 or not n:
        return out
    place, at, row = None, out, np.arange(n) if rows is None else rows
    flat, width = bins.reshape(-1), bins.shape[1]
    row = row * width
    f = feature.take(at)
    while True:
        at = np.where(flat.take(row + f) > cut.take(at), right.take(at), left.take(at))
        f = feature.take(at)
        on = np.flatnonzero(f >= 0)
        if len(on) < len(at):
            if place is None:
                out = at
                place = on
            else:
                out[place] = at
                place = place[on]
            if not len(on):
                return out
            at, row, f = at[on], row[on], f[on]


def leaves_of(bins: np.ndarray, nodes: Mapping[str, np.ndarray], start: np.ndarray, stop: np.ndarray | None = None) -> np.ndarray:
    """The node at which each row (first axis) of each tree (second) ends. ``stop`` marks nodes that count as leaves."""
    if stop is not None:
        nodes = {**nodes, "feature": np.where(stop, -1, nodes["feature"])}
    bins = np.ascontiguousarray(bins)
    out = np.empty((len(start), len(bins)), np.int64)
    for t, root in enumerate(start):
        out[t] = _descend(bins, nodes, int(root))
    return out.T


def _parts(n: int, width: int) -> Iterator[tuple[int, int]]:
    step = max(1, PAIRS // max(1, width))
    for a in range(0, n, step):
        yield a, min(a + step, n)


def probabilities(bins: np.ndarray, model: Model, trees: Sequence[int] = (), depth: int = NO_LIMIT,
                  min_split: int = 0) -> np.ndarray:
    """Class-1 probability of each row (first axis) by the first so many trees (second; all of them unless given).

    ``depth`` and ``min_split`` cut the trees back to what a smaller limit would have grown. That holds for trees without a
    limit of leaves.
    """
    trees = list(trees) or [len(model.roots)]
    stop = None
    if depth < NO_LIMIT or min_split:
        stop = (model.nodes["depth"] >= depth) | (model.nodes["n"] < min_split)
    out = np.zeros((len(bins), len(trees)))
    for a, b in _parts(len(bins), len(model.roots)):
        values = model.nodes["value"][leaves_of(bins[a:b], model.nodes, model.roots, stop)]
        sums = np.cumsum(values, 1)[:, np.array(trees) - 1]
        out[a:b] = 1 / (1 + np.exp(-sums)) if model.setting.boosted else sums / np.array(trees)
    return out


def scored(df: DataFrame, models: Mapping[str, Model], features: str = "features", keep: Sequence[str] = ()) -> DataFrame:
    """``keep`` and an array column ``probabilities``, in the order of ``models``; one pass for all of them."""
    asked = ("feature", "cut", "left", "right", "value")
    shared = _shared(df, [replace(m, nodes={k: m.nodes[k] for k in asked}) for m in models.values()])
    rows = df.select(*[F.col(f"`{c}`") for c in keep], vector_to_array(features).alias("__x"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        models = _read(shared)
        for batch in batches:
            found = []
            for model in models:
                x = _matrix(batch.column("__x"), len(model.cuts))
                found.append(probabilities(model.bins(x), model)[:, 0])
            made = pa.array(list(np.stack(found, 1)) if batch.num_rows else [], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in keep] + [made], [*keep, "probabilities"])

    fields = [rows.schema[c] for c in keep] + [T.StructField("probabilities", T.ArrayType(T.DoubleType()))]
    return rows.mapInArrow(run, T.StructType(fields))


@dataclass(frozen=True)
class Variant:
    """A candidate: a part of a grown model."""

    candidate: int
    model: int
    trees: int
    depth: int = NO_LIMIT
    min_split: int = 0


def held_out(table: DataFrame, models: Sequence[Model]) -> DataFrame:
    """``label``, ``fold``, ``probability`` of each row by the model that has not seen its fold."""
    shared = _shared(table, list(models))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        models = _read(shared)
        for batch in batches:
            fold = batch.column("fold").to_numpy()
            bins = _bytes(batch.column("bins"), np.uint8, len(models[0].cuts))
            chance, known = np.zeros(len(fold)), np.zeros(len(fold), bool)
            for model in models:
                out = fold == model.setting.left_out
                chance[out] = probabilities(bins[out], model)[:, 0]
                known |= out
            made = pa.RecordBatch.from_arrays([batch.column("label"), batch.column("fold"), pa.array(chance)],
                                              ["label", "fold", "probability"])
            yield made.filter(pa.array(known & (batch.column("label").to_numpy() >= 0)))

    return table.mapInArrow(run, "label int, fold int, probability double")


def tally(table: DataFrame, models: Sequence[Model], variants: Sequence[Variant]) -> DataFrame:
    """``candidate``, ``fold``, ``tn``, ``fp``, ``fn``, ``tp`` over the rows that each model has not seen: four numbers a fit.

    Models of more than ``NODES`` nodes together are asked in several passes, so that a task does not hold them all.
    """
    parts: list[list[int]] = []
    held = NODES
    for m, model in enumerate(models):
        size = len(model.nodes["feature"])
        if held + size > NODES:
            parts.append([])
            held = 0
        parts[-1].append(m)
        held += size
    cells = []
    for part in parts:
        at = {m: i for i, m in enumerate(part)}
        mine = [replace(v, model=at[v.model]) for v in variants if v.model in at]
        if mine:
            cells.append(_tally(table, [models[m] for m in part], mine))
    return reduce(DataFrame.unionByName, cells)


def _tally(table: DataFrame, models: Sequence[Model], variants: Sequence[Variant]) -> DataFrame:
    shared = _shared(table, (list(models), list(variants)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        models, variants = _read(shared)
        cells = np.zeros((len(variants), 4), np.int64)
        groups: dict[tuple, list[int]] = {}
        for i, v in enumerate(variants):
            groups.setdefault((v.model, v.depth, v.min_split), []).append(i)
        for batch in batches:
            label, fold = (batch.column(c).to_numpy() for c in ("label", "fold"))
            bins = _bytes(batch.column("bins"), np.uint8, len(models[0].cuts))
            for (m, depth, least), some in groups.items():
                out = (fold == models[m].setting.left_out) & (label >= 0)
                chance = probabilities(bins[out], models[m], [variants[i].trees for i in some], depth, least)
                for i, hit in zip(some, (chance > 0.5).T):
                    cells[i] += np.bincount(2 * label[out] + hit, minlength=4)
        folds = [models[v.model].setting.left_out for v in variants]
        yield pa.RecordBatch.from_arrays(
            [pa.array([v.candidate for v in variants], pa.int32()), pa.array(folds, pa.int32()), *map(pa.array, cells.T)],
            ["candidate", "fold", "tn", "fp", "fn", "tp"])

    parts = table.mapInArrow(run, "candidate int, fold int, tn bigint, fp bigint, fn bigint, tp bigint")
    return parts.groupBy("candidate", "fold").agg(*[F.sum(c).alias(c) for c in ("tn", "fp", "fn", "tp")])


def _ways(bins: np.ndarray, nodes: Mapping[str, np.ndarray], start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The leaf of each row and tree, and a set of the features met on the way (bit: number modulo 64)."""
    at = np.broadcast_to(start, (len(bins), len(start))).copy()
    met = np.zeros(at.shape, np.uint64)
    row, tree = np.nonzero(nodes["feature"][at] >= 0)
    while len(row):
        here = at[row, tree]
        f = nodes["feature"][here]
        met[row, tree] |= np.uint64(1) << (f % 64).astype(np.uint64)
        below = np.where(bins[row, f] > nodes["cut"][here], nodes["right"][here], nodes["left"][here])
        at[row, tree] = below
        on = nodes["feature"][below] >= 0
        row, tree = row[on], tree[on]
    return at, met


def _swapped_leaves(own, donor, row, slot: int, at: np.ndarray, nodes: Mapping[str, np.ndarray]) -> np.ndarray:
    """The leaf of (row, tree) pairs if the feature ``slot`` has the donor's value; ``at`` holds their roots."""
    on = np.flatnonzero(nodes["feature"][at] >= 0)
    while len(on):
        here, r = at[on], row[on]
        f = nodes["feature"][here]
        value = np.where(f == slot, donor[r, slot], own[r, f])
        at[on] = np.where(value > nodes["cut"][here], nodes["right"][here], nodes["left"][here])
        on = on[nodes["feature"][at[on]] >= 0]
    return at


def rescored(df: DataFrame, model: Model, keep: Sequence[str]) -> DataFrame:
    """``keep``, ``slot``, ``probability``: each row scored with one feature at a time taken from its donor.

    ``df`` has the arrays ``own`` and ``donor``. A tree is asked anew only for the rows that meet the feature on their way
    and whose bin changes; the other votes are kept. Sums are taken as in ``probabilities``.
    """
    shared = _shared(df, model)
    rows = df.select(*[F.col(f"`{c}`") for c in keep], F.col("own").alias("__own"), F.col("donor").alias("__donor"))
    count = len(model.cuts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _read(shared)
        nodes, trees = model.nodes, len(model.roots)

        def chance(values):
            sums = np.cumsum(values, 1)[:, -1]
            return 1 / (1 + np.exp(-sums)) if model.setting.boosted else sums / trees

        for batch in batches:
            own, donor = (model.bins(_matrix(batch.column(c), count)) for c in ("__own", "__donor"))
            for a, b in _parts(len(own), trees):
                x, y = own[a:b], donor[a:b]
                at, met = _ways(x, nodes, model.roots)
                values = nodes["value"][at]
                base = chance(values)
                for j in range(count):
                    asked = (met >> np.uint64(j % 64) & np.uint64(1)).astype(bool) & (x[:, j] != y[:, j])[:, None]
                    r, t = np.nonzero(asked)
                    out = base
                    if len(r):
                        some, place = np.unique(r, return_inverse=True)
                        mine = values[some]
                        mine[place, t] = nodes["value"][_swapped_leaves(x, y, r, j, model.roots[t], nodes)]
                        out = base.copy()
                        out[some] = chance(mine)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(c).slice(a, b - a) for c in keep] + [pa.array(np.full(b - a, j), pa.int32()), pa.array(out)],
                        [*keep, "slot", "probability"])

    fields = [rows.schema[c] for c in keep] + [T.StructField("slot", T.IntegerType()), T.StructField("probability", T.DoubleType())]
    return rows.mapInArrow(run, T.StructType(fields))


# a wave's job

@dataclass
class Wave:
    """What the tasks of a wave need: the trees as far as they have grown, and the nodes that wait."""

    offsets: np.ndarray  # where each feature's cells begin in a node's cells; last: how many there are
    nodes: dict[str, np.ndarray]  # of all partial trees
    roots: np.ndarray  # [lane]
    number: np.ndarray  # [node] the waiting node's number, or -1
    columns: np.ndarray  # [waiting, place] features to try, -1: none
    lanes: dict[str, np.ndarray]
    least: dict[str, np.ndarray]  # [waiting] l2, min_leaf, min_weight
    margin_of: np.ndarray  # [lane] column among the margins, -1: not boosted
    width: int  # margins of a row
    done: dict[str, np.ndarray]  # nodes of the trees finished since the margins were written
    done_root: np.ndarray
    done_margin: np.ndarray
    buckets: int


def _uniform(row: np.ndarray, seed: np.ndarray) -> np.ndarray:
    """A number in [0, 1) for each row and seed; with a row of seeds for each row, for those."""
    with np.errstate(over="ignore"):
        x = row.view(np.uint64)[:, None] + np.atleast_2d(seed).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        for s, m in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            x = (x ^ (x >> np.uint64(s))) * np.uint64(m)
        x ^= x >> np.uint64(31)
    return (x >> np.uint64(11)).astype(np.float64) / (1 << 53)


#: Chances of drawing a row at most 0, 1, 2 ... times, with a mean of one.
POISSON = np.cumsum(np.exp(-1.0) / np.cumprod(np.concatenate([[1.0], np.arange(1.0, 12.0)])))


def _add_finished(margins: np.ndarray, bins: np.ndarray, wave: Wave) -> np.ndarray:
    margins = margins.copy()
    for root, place in zip(wave.done_root, wave.done_margin):
        margins[:, place] += wave.done["value"][_descend(bins, wave.done, int(root))]
    return margins


def _summed(parts: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, ...]:
    """Keys in order, each once, and the sums of the other columns. Each part has that form already."""
    if len(parts) == 1:
        return parts[0]
    filled = [p for p in parts if len(p[0])]
    low = min((int(p[0][0]) for p in filled), default=0)
    space = max((int(p[0][-1]) + 1 for p in filled), default=0) - low
    if space <= 4 * sum(len(p[0]) for p in filled):
        # a part has each key once, so that it can be added at one go; the last column counts rows and is never 0
        dense = [np.zeros(space, np.int64) for _ in parts[0][1:]]
        for keys, *sums in filled:
            for total, v in zip(dense, sums):
                total[keys - low] += v
        some = np.flatnonzero(dense[-1])
        return some + low, *(total[some] for total in dense)
    keys, *sums = (np.concatenate(x) for x in zip(*parts))
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], *(np.add.reduceat(s[order], first) if len(keys) else s for s in sums)


def _drawn(lanes: Mapping[str, np.ndarray], t: int, seen: Mapping[int, np.ndarray], row: np.ndarray,
           chance: dict[int, np.ndarray]) -> tuple[np.ndarray, np.ndarray | None]:
    """The rows that a tree sees and, if it draws some of them more than once, how often. ``chance`` keeps the last numbers
    drawn, as the trees of a round share them."""
    r = seen[int(lanes["left_out"][t])]
    if not lanes["bootstrap"][t] and lanes["row_share"][t] >= 1:
        return r, None
    seed = int(lanes["seed"][t])
    if seed not in chance:
        if len(chance) >= 8:
            chance.clear()
        chance[seed] = _uniform(row, lanes["seed"][t:t + 1])[:, 0]
    u = chance[seed][r]
    if not lanes["bootstrap"][t]:
        return r[u < lanes["row_share"][t]], None
    times = np.searchsorted(POISSON, u, "right")
    drawn = times > 0
    return r[drawn], times[drawn].astype(np.float64)


def _groups(sizes: np.ndarray) -> list[list[int]]:
    """Features whose combinations of bins are at most ``JOINT``, the small ones first; each feature is in one group."""
    groups: list[list[int]] = []
    cells = JOINT + 1
    for f in np.argsort(sizes, kind="stable").tolist():
        if cells * int(sizes[f]) > JOINT:
            groups.append([])
            cells = 1
        groups[-1].append(f)
        cells *= int(sizes[f])
    return groups


def _counted_jointly(node, count: int, r, g, h, bins, joint: dict, groups, tried: set[int],
                     offsets) -> tuple[np.ndarray, ...]:
    """Dense g, h and n sums of ``count`` nodes that all try the same features. Features of few bins are counted as one, whose
    sums are then added up for each."""
    sizes = np.diff(offsets)
    out = np.zeros((3, count, int(offsets[-1])))
    for j, group in enumerate(groups):
        if tried.isdisjoint(group):
            continue
        space = int(np.prod(sizes[group]))
        if j not in joint:
            made = np.zeros(len(bins), np.int64)
            for f in group:
                made = made * sizes[f] + bins[:, f]
            joint[j] = made
        keys = joint[j].take(r)
        if count > 1:
            keys += node * space
        # sums of whole numbers below 2^53 are exact
        found = np.stack([np.bincount(keys, v, count * space) for v in (g, h)] + [np.bincount(keys, minlength=count * space)])
        found = found.reshape(3, count, space)
        if len(group) == 1:
            out[:, :, offsets[group[0]]:offsets[group[0] + 1]] = found
            continue
        if (j, "parts") not in joint:
            below, cells, parts = space, [], []
            for f in group:
                below //= int(sizes[f])
                cells.append(np.arange(offsets[f], offsets[f + 1]))
                parts.append(np.arange(space)[:, None] // below % sizes[f] == np.arange(sizes[f]))
            joint[j, "parts"] = np.concatenate(cells), np.concatenate(parts, 1).astype(np.float64)
        cells, parts = joint[j, "parts"]
        out[:, :, cells] = (found.reshape(-1, space) @ parts).reshape(3, count, -1)
    for f in range(len(sizes)):
        if f not in tried:
            out[:, :, offsets[f]:offsets[f + 1]] = 0
    return tuple(out.astype(np.int64).reshape(3, -1))


def _count(wave: Wave, label, fold, row, bins, margins, joint: dict | None = None) -> Iterator[tuple[np.ndarray, ...]]:
    """(cell, g, h, n) sums of some rows, a tree at a time. A tree's waiting nodes are numbered one after the other, so what
    the trees give is in order. ``joint`` keeps the features counted as one for further waves over the same rows."""
    width = int(wave.offsets[-1])
    lanes = wave.lanes
    seen = {f: np.flatnonzero((label >= 0) & (fold != f)) for f in set(lanes["left_out"].tolist())}
    # a model's margins side by side, as one is asked at a time
    margins = None if margins is None else np.ascontiguousarray(margins.T)
    bins = np.ascontiguousarray(bins)
    flat, each = bins.reshape(-1), bins.shape[1]
    offsets = np.asarray(wave.offsets, np.int64)
    groups, joint = _groups(np.diff(offsets)), {} if joint is None else joint
    chance: dict[int, np.ndarray] = {}
    for t, root in enumerate(wave.roots):
        r, times = _drawn(lanes, t, seen, row, chance)
        node = wave.number[_descend(bins, wave.nodes, int(root), r)]
        waits = node >= 0
        if not waits.all():
            r, node, times = r[waits], node[waits], None if times is None else times[waits]
        if not len(r):
            continue
        y = label[r]
        weight = np.where(y == 1, lanes["weight_1"][t], lanes["weight_0"][t])
        if times is not None:
            weight = weight * times
        place = int(wave.margin_of[t])
        if place >= 0:
            p = 1 / (1 + np.exp(-margins[place].take(r)))
            g, h = weight * (y - p), weight * p * (1 - p)
        else:
            g, h = weight * y, weight
        g, h = np.rint(g * SCALE), np.rint(h * SCALE)
        first, last = int(node.min()), int(node.max())
        base, tried = (node - first) * width, wave.columns[first:last + 1]
        # where all nodes try the same column, as in trees that are not a forest's, it is looked up once
        same = (tried == tried[0]).all(0)
        space = (last - first + 1) * width
        if same.all() and space <= 4 * tried.shape[1] * len(r):
            asked = {int(f) for f in tried[0] if f >= 0}
            *sums, n = _counted_jointly(node - first, last - first + 1, r, g, h, bins, joint, groups, asked, offsets)
            some = np.flatnonzero(n)
            yield some + first * width, *(v[some] for v in sums), n[some]
            continue
        keys, places = [], []
        for k in range(tried.shape[1]):
            if same[k]:
                f = int(tried[0, k])
                if f >= 0:
                    keys.append(base + (offsets[f] + bins[r, f]))
                    places.append(None)
                continue
            f = tried[node - first, k]
            on = None if (f >= 0).all() else np.flatnonzero(f >= 0)
            if on is None:
                keys.append(base + offsets[f] + flat[r * each + f])
            else:
                keys.append(base[on] + offsets[f[on]] + flat[r[on] * each + f[on]])
            places.append(on)

        def laid(v):
            return np.concatenate([v if on is None else v[on] for on in places])

        keys = np.concatenate(keys)
        if space <= 8 * len(keys):
            n = np.bincount(keys, minlength=space)
            some = np.flatnonzero(n)
            # sums of whole numbers below 2^53 are exact
            yield some + first * width, *(np.bincount(keys, laid(v), space)[some].astype(np.int64) for v in (g, h)), n[some]
        else:
            some, group = np.unique(keys, return_inverse=True)
            yield some + first * width, *(np.bincount(group, laid(v)).astype(np.int64) for v in (g, h)), np.bincount(group)


def _best(wave: Wave, keys, g, h, n) -> dict[str, np.ndarray]:
    return _best_of(wave.offsets, wave.least, keys, g, h, n)


def _best_of(offsets: np.ndarray, least: Mapping[str, np.ndarray], keys, g, h, n) -> dict[str, np.ndarray]:
    """The best split of each node among the summed cells (all of a node's are there), and the node's totals."""
    width = int(offsets[-1])
    node, cell = keys // width, keys % width
    feature = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))[cell]
    new = np.concatenate([[True], (node[1:] != node[:-1]) | (feature[1:] != feature[:-1])])
    first = np.flatnonzero(new)
    group = np.cumsum(new) - 1
    left, total = [], []
    for v in (g, h, n):
        run = np.cumsum(v)
        left.append(run - (run[first] - v[first])[group])
        total.append(np.add.reduceat(v, first)[group])
    (gl, hl, nl), (gt, ht, nt) = left, total
    l2, min_leaf, min_weight = (least[k][node] for k in ("l2", "min_leaf", "min_weight"))

    def worth(a, b):
        b = b / SCALE + l2
        return np.where(b > 0, (a / SCALE) ** 2 / np.where(b > 0, b, 1), 0)

    gain = worth(gl, hl) + worth(gt - gl, ht - hl) - worth(gt, ht)
    allowed = (nl < nt) & (nl >= min_leaf) & (nt - nl >= min_leaf)
    allowed &= (hl >= min_weight * SCALE) & (ht - hl >= min_weight * SCALE)
    gain = np.where(allowed & (gain > LEAST_GAIN), gain, 0.0)
    begin = np.flatnonzero(np.concatenate([[True], node[1:] != node[:-1]]))
    most = np.maximum.reduceat(gain, begin)
    hit = np.flatnonzero(gain == np.repeat(most, np.diff(np.append(begin, len(keys)))))
    at = hit[np.searchsorted(hit, begin)]  # of equal gains the first cell's
    split = gain[at] > 0
    return {"number": node[at], "feature": np.where(split, feature[at], -1), "cut": cell[at] - offsets[feature[at]],
            "gain": gain[at], "gl": gl[at], "hl": hl[at], "nl": nl[at], "g": gt[at], "h": ht[at], "n": nt[at]}


_RESULT = "number bigint, feature bigint, cut bigint, gain double, gl bigint, hl bigint, nl bigint, g bigint, h bigint, n bigint"


def best_splits(table: DataFrame, wave: Wave) -> dict[str, np.ndarray]:
    """The job of a wave: cells counted in tasks, added up by buckets of neighbouring nodes, one best split a node."""
    shared = _shared(table, wave)
    each = -(-len(wave.columns) // wave.buckets) * int(wave.offsets[-1])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wave = _read(shared)
        held: list[tuple] = []
        for batch in _together(batches):
            label, fold, row = (batch.column(c).to_numpy() for c in ("label", "fold", "row"))
            bins = _bytes(batch.column("bins"), np.uint8, len(wave.offsets) - 1)
            margins = None
            if wave.width:
                margins = _add_finished(_margins(batch, wave.width), bins, wave)
            mine = list(_count(wave, label, fold, row, bins, margins))
            if mine:
                held.append(tuple(np.concatenate(x) for x in zip(*mine)))
            if sum(len(p[0]) for p in held[1:]) > CELLS:
                held = [_summed(held)]
        if held:
            keys, *sums = _summed(held)
            cuts = np.searchsorted(keys, np.arange(wave.buckets + 1) * each)
            some = [i for i in range(wave.buckets) if cuts[i] < cuts[i + 1]]
            columns = [pa.array([v[cuts[i]:cuts[i + 1]].astype(np.int64).tobytes() for i in some], pa.binary()) for v in (keys, *sums)]
            yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), *columns], ["bucket", "cell", "g", "h", "n"])

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wave = _read(shared)
        held: dict[int, list[tuple]] = {}
        for batch in batches:
            for i, *parts in zip(*(c.to_pylist() for c in batch.columns)):
                mine = held.setdefault(i, [])
                mine.append(tuple(np.frombuffer(p, np.int64) for p in parts))
                if sum(len(p[0]) for p in mine[1:]) > CELLS // wave.buckets:
                    held[i] = [_summed(mine)]
        for parts in held.values():
            found = _best(wave, *_summed(parts))
            yield pa.RecordBatch.from_arrays([pa.array(v) for v in found.values()], list(found))

    parts = table.mapInArrow(count, "bucket int, cell binary, g binary, h binary, n binary")
    try:
        rows = parts.repartition(wave.buckets, "bucket").mapInArrow(choose, _RESULT).toArrow()
    finally:
        shared.unpersist()
    return {c: rows.column(c).to_numpy() for c in rows.column_names}


def _together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches of a task in larger ones of about ``ROWS`` rows or ``BYTES`` bytes, so that cells are added up less often."""
    def joined():
        return pa.Table.from_batches(held).combine_chunks().to_batches()

    held, rows, size = [], 0, 0
    for batch in batches:
        held.append(batch)
        rows, size = rows + batch.num_rows, size + batch.nbytes
        if rows >= ROWS or size >= BYTES:
            yield from joined()
            held, rows, size = [], 0, 0
    if rows:
        yield from joined()


def _margins(batch: pa.RecordBatch, width: int) -> np.ndarray:
    if "margins" not in batch.schema.names:
        return np.zeros((batch.num_rows, width))
    return _bytes(batch.column("margins"), np.float64, width)


def with_margins(table: DataFrame, wave: Wave) -> DataFrame:
    """The table with the finished trees added to the margins, written anew."""
    shared = _shared(table, wave)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wave = _read(shared)
        for batch in batches:
            bins = _bytes(batch.column("bins"), np.uint8, len(wave.offsets) - 1)
            margins = _add_finished(_margins(batch, wave.width), bins, wave)
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in ("label", "fold", "row", "bins")] + [pa.array([m.tobytes() for m in margins], pa.binary())],
                ["label", "fold", "row", "bins", "margins"])

    return materialize(table.mapInArrow(run, "label int, fold int, row bigint, bins binary, margins binary"))


# nodes that a task grows alone

@dataclass
class Below:
    """What the tasks need to grow on below nodes of few rows: the trees so far, the nodes and how their trees grow."""

    offsets: np.ndarray
    nodes: dict[str, np.ndarray]
    roots: np.ndarray  # [lane]
    number: np.ndarray  # [node] number of the node to grow on at, or -1
    lanes: dict[str, np.ndarray]
    lane: np.ndarray  # [number]
    path: np.ndarray  # [number]
    depth: np.ndarray  # [number]
    bucket: np.ndarray  # [number], never falling


def _packed(bins: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Features of two bins as bits, the others as bytes."""
    return np.concatenate([np.packbits(bins[:, sizes <= 2], 1), bins[:, sizes > 2]], 1)


def _unpacked(rows: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    few = int((sizes <= 2).sum())
    out = np.empty((len(rows), len(sizes)), np.uint8)
    out[:, sizes <= 2] = np.unpackbits(rows[:, : -(-few // 8)], 1, count=few)
    out[:, sizes > 2] = rows[:, -(-few // 8):]
    return out


def _sent(below: Below, label, fold, row, bins) -> Iterator[tuple[int, bytes, bytes]]:
    """By bucket: the numbers of nodes, counted from the bucket's first one, and the rows that reach them."""
    lanes = below.lanes
    sizes = np.diff(below.offsets)
    seen = {f: np.flatnonzero((label >= 0) & (fold != f)) for f in set(lanes["left_out"].tolist())}
    bins = np.ascontiguousarray(bins)
    packed = _packed(bins, sizes)
    start = np.searchsorted(below.bucket, np.arange(int(below.bucket[-1]) + 1))
    chance: dict[int, np.ndarray] = {}
    for t, root in enumerate(below.roots):
        r, times = _drawn(lanes, t, seen, row, chance)
        node = below.number[_descend(bins, below.nodes, int(root), r)]
        here = node >= 0
        node, r = node[here], r[here]
        if not len(r):
            continue
        # a row of label 1 drawn twice is 5
        drawn = label[r].astype(np.uint8) + 2 * (times[here].astype(np.uint8) if times is not None else np.uint8(1))
        rows = np.concatenate([drawn[:, None], packed[r]], 1)
        bucket = below.bucket[node]
        for b in range(int(bucket.min()), int(bucket.max()) + 1):
            mine = bucket == b
            if mine.any():
                yield b, (node[mine] - start[b]).astype(np.uint16).tobytes(), rows[mine].tobytes()


def _grown_on(below: Below, first: int, last: int, at: np.ndarray, drawn: np.ndarray, bins: np.ndarray) -> dict[str, np.ndarray]:
    """The nodes from number ``first`` to before ``last`` and all below them, grown level by level as in waves.

    ``at`` says at which of them each row is. Children come after their parents; ``lane`` is the tree's."""
    lanes, offsets = below.lanes, np.asarray(below.offsets, np.int64)
    width, sizes, count = int(offsets[-1]), np.diff(offsets), len(offsets) - 1
    label, times = drawn & 1, (drawn >> 1).astype(np.float64)
    of = below.lane[first:last]
    weight = np.where(label == 1, lanes["weight_1"][of[at]], lanes["weight_0"][of[at]]) * times
    g, h = np.rint(weight * label * SCALE), np.rint(weight * SCALE)
    # one level: its nodes and, for each row still on the way, its node's place among them
    level = {"lane": of, "path": below.path[first:last], "depth": below.depth[first:last]}
    level |= {k: np.zeros(len(of), np.int64) for k in ("g", "h", "n")}
    waits, kept, total = np.ones(len(of), bool), [], len(of)
    flat, row = bins.reshape(-1), np.arange(len(at))
    while True:
        size = len(level["lane"])
        made = {**level, "feature": np.full(size, -1), "cut": np.zeros(size, np.int64), "left": np.zeros(size, np.int64),
                "right": np.zeros(size, np.int64), "gain": np.zeros(size)}
        kept.append(made)
        number = np.cumsum(waits) - 1
        on = waits[at]
        row, at = row[on], number[at[on]]
        if not len(row):
            break
        active = np.flatnonzero(waits)
        lane = level["lane"][active]
        tried = _to_try(lanes, lane, level["path"][active], count)
        each = np.where(tried >= 0, sizes[tried], 0)
        begin = np.concatenate([[0], np.cumsum(each.reshape(-1))[:-1]]).reshape(each.shape)
        keys, mine = [], []
        for k in range(tried.shape[1]):
            f = tried[at, k]
            good = slice(None) if (f >= 0).all() else np.flatnonzero(f >= 0)
            keys.append(begin[at[good], k] + flat[row[good] * count + f[good]])
            mine.append(row[good])
        keys, mine = np.concatenate(keys), np.concatenate(mine)
        n = np.bincount(keys, minlength=int(each.sum()))
        some = np.flatnonzero(n)
        sums = [np.bincount(keys, v[mine], len(n))[some].astype(np.int64) for v in (g, h)]
        shift = np.arange(len(active))[:, None] * width + offsets[tried] - begin
        cells = some + np.repeat(shift.reshape(-1), each.reshape(-1))[some]
        found = _best_of(offsets, {k: lanes[k][lane] for k in ("l2", "min_leaf", "min_weight")}, cells, *sums, n[some])
        split = found["feature"] >= 0
        parent = active[split]
        children = total + 2 * np.arange(len(parent))
        made["gain"][active] = found["gain"]
        made["feature"][parent], made["cut"][parent] = found["feature"][split], found["cut"][split]
        made["left"][parent], made["right"][parent] = children, children + 1
        total += 2 * len(parent)
        stays = split[at]
        row, at = row[stays], at[stays]
        right = flat[row * count + found["feature"][at]] > found["cut"][at]
        at = 2 * (np.cumsum(split) - 1)[at] + right

        def both(left, right):
            return np.stack([left, right], 1).reshape(-1)

        level = {"lane": np.repeat(level["lane"][parent], 2), "path": _ways_on(level["path"][parent]),
                 "depth": np.repeat(level["depth"][parent] + 1, 2)}
        level |= {k: both(found[k + "l"][split], (found[k] - found[k + "l"])[split]) for k in ("g", "h", "n")}
        waits = (level["depth"] < lanes["max_depth"][level["lane"]]) & (level["n"] >= lanes["least"][level["lane"]])
        waits &= (level["g"] != 0) & (level["g"] != level["h"])  # of one class
    return {k: np.concatenate([m[k] for m in kept]) for k in kept[0]}


def _to_try(lanes: Mapping[str, np.ndarray], lane: np.ndarray, path: np.ndarray, count: int) -> np.ndarray:
    """As ``Growing.to_try`` for nodes of several trees, in order; -1 where a node tries fewer than the others."""
    wanted = lanes["node_columns"][lane]
    every = np.arange(count)
    if (wanted >= count).all():
        return np.broadcast_to(every, (len(lane), count))
    tried = np.argsort(_uniform(path, lanes["column_seed"][lane][:, None] + every), 1)[:, : int(wanted.max())]
    return np.sort(np.where(np.arange(tried.shape[1]) < wanted[:, None], tried, -1), 1)


def _ways_on(path: np.ndarray) -> np.ndarray:
    """The numbers of the ways to both children of some nodes."""
    with np.errstate(over="ignore"):
        way = path * np.int64(0x9E3779B97F4A7C1)
        return np.stack([way + 1, way + 2], 1).reshape(-1)


_BELOW = {"lane": np.int32, "feature": np.int16, "cut": np.int16, "left": np.int32, "right": np.int32, "depth": np.int32,
          "n": np.int32, "g": np.int64, "h": np.int64, "gain": np.float64}


def grown_below(table: DataFrame, below: Below) -> Iterator[tuple[int, dict[str, np.ndarray]]]:
    """The job that grows on below small nodes: each bucket's first number, and its nodes with all below them."""
    shared = _shared(table, below)
    buckets = int(below.bucket[-1]) + 1
    parts = max(1, min(buckets, max(2 * table.sparkSession.sparkContext.defaultParallelism, buckets // 8)))

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        below = _read(shared)
        for batch in _together(batches):
            label, fold, row = (batch.column(c).to_numpy() for c in ("label", "fold", "row"))
            bins = _bytes(batch.column("bins"), np.uint8, len(below.offsets) - 1)
            held, size = [], 0
            for sent in _sent(below, label, fold, row, bins):
                held.append(sent)
                size += len(sent[2])
                if size >= BYTES // 2:
                    yield laid(held)
                    held, size = [], 0
            if held:
                yield laid(held)

    def laid(held):
        b, at, rows = zip(*held)
        return pa.RecordBatch.from_arrays([pa.array(b, pa.int32()), pa.array(at, pa.binary()), pa.array(rows, pa.binary())],
                                          ["bucket", "at", "rows"])

    def grow_on(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        below = _read(shared)
        sizes = np.diff(below.offsets)
        held: dict[int, list[tuple]] = {}
        for batch in batches:
            for b, at, rows in zip(*(c.to_pylist() for c in batch.columns)):
                held.setdefault(b, []).append((at, rows))
        for b in sorted(held):
            at, rows = (b"".join(x) for x in zip(*held.pop(b)))
            at = np.frombuffer(at, np.uint16).astype(np.int64)
            rows = np.frombuffer(rows, np.uint8).reshape(len(at), -1)
            first, last = (int(x) for x in np.searchsorted(below.bucket, [b, b + 1]))
            found = _grown_on(below, first, last, at, rows[:, 0], np.ascontiguousarray(_unpacked(rows[:, 1:], sizes)))
            yield pa.RecordBatch.from_arrays(
                [pa.array([first], pa.int32()), *(pa.array([found[k].astype(kind).tobytes()], pa.binary()) for k, kind in _BELOW.items())],
                ["first", *_BELOW])

    sent = table.mapInArrow(send, "bucket int, at binary, rows binary").repartition(parts, "bucket")
    try:
        rows = sent.mapInArrow(grow_on, "first int, " + ", ".join(f"{k} binary" for k in _BELOW)).toArrow()
    finally:
        shared.unpersist()
    for batch in rows.to_batches():
        for i in range(batch.num_rows):
            yield batch.column("first")[i].as_py(), {k: np.frombuffer(batch.column(k)[i].as_py(), kind) for k, kind in _BELOW.items()}


# growing

class Growing:
    """One tree while it grows."""

    def __init__(self, model: Model, tree: int):
        s = model.setting
        self.model, self.tree, self.setting = model, tree, s
        self.nodes = {"feature": np.full(1, -1), "cut": np.zeros(1, np.int64), "left": np.zeros(1, np.int64),
                      "right": np.zeros(1, np.int64), "depth": np.zeros(1, np.int64), "g": np.zeros(1, np.int64),
                      "h": np.zeros(1, np.int64), "n": np.zeros(1, np.int64), "gain": np.zeros(1),
                      "bottleneck": np.full(1, np.inf), "best": np.full(1, -1), "best_cut": np.zeros(1, np.int64),
                      "gl": np.zeros(1, np.int64), "hl": np.zeros(1, np.int64), "nl": np.zeros(1, np.int64),
                      "path": np.ones(1, np.int64)}  # a number for the way to a node
        self.waiting = np.zeros(1, np.int64)
        self.alone = np.zeros(0, np.int64)  # nodes that a task grows on by itself
        columns = np.arange(len(model.cuts))
        if s.column_share < 1:
            rng = np.random.default_rng([s.seed, tree, 1])
            columns = np.sort(rng.choice(columns, max(1, int(s.column_share * len(columns))), replace=False))
        self.columns = columns

    def to_try(self, nodes: np.ndarray) -> np.ndarray:
        """The features that each of the nodes tries. They depend on the seed, the tree and the node alone."""
        s = self.setting
        if not s.node_columns or s.node_columns >= len(self.columns):
            return np.broadcast_to(self.columns, (len(nodes), len(self.columns)))
        seeds = ((s.seed << 40) + (self.tree << 16) + self.columns).astype(np.int64)
        order = np.argsort(_uniform(self.nodes["path"][nodes], seeds), 1)
        return self.columns[order[:, :s.node_columns]]

    def learn(self, node: np.ndarray, found: dict[str, np.ndarray]) -> None:
        """Take in the best splits of waiting nodes; then go on with the splits of largest bottleneck."""
        v = self.nodes
        # the root waits in any case, for its sums
        fit = (v["depth"][node] < self.setting.max_depth) & (found["n"] >= self._least())
        v["best"][node], v["best_cut"][node], v["gain"][node] = np.where(fit, found["feature"], -1), found["cut"], found["gain"]
        v["bottleneck"][node] = np.minimum(v["bottleneck"][node], found["gain"])
        for k in ("gl", "hl", "nl"):
            v[k][node] = found[k]
        if 0 in node:
            for k in ("g", "h", "n"):
                v[k][0] = found[k][list(node).index(0)]
        self.waiting = np.setdiff1d(self.waiting, node)
        if not len(self.waiting):
            self._go_on()

    def _least(self) -> int:
        return max(self.setting.min_split, 2 * self.setting.min_leaf)

    def _first(self) -> np.ndarray:
        can = np.flatnonzero(self.nodes["best"] >= 0)
        order = np.lexsort((can, -self.nodes["bottleneck"][can]))
        return can[order[: self.setting.leaves - 1]]

    def _go_on(self) -> None:
        v, s = self.nodes, self.setting
        while True:
            first = self._first()
            new = first[v["feature"][first] < 0]
            if not len(new):
                return
            at = len(v["feature"]) + 2 * np.arange(len(new))
            v["feature"][new], v["cut"][new], v["left"][new], v["right"][new] = v["best"][new], v["best_cut"][new], at, at + 1

            def both(left, right):
                return np.stack([left, right], 1).reshape(-1)

            sums = {k: both(v[k + "l"][new], v[k][new] - v[k + "l"][new]) for k in ("g", "h", "n")}
            more = {"depth": np.repeat(v["depth"][new] + 1, 2), "bottleneck": np.repeat(v["bottleneck"][new], 2), **sums}
            more["path"] = _ways_on(v["path"][new])
            blank = {"feature": -1, "best": -1}
            for k in v:
                v[k] = np.concatenate([v[k], more[k] if k in more else np.full(2 * len(new), blank.get(k, 0), v[k].dtype)])
            child = both(at, at + 1)
            fit = (v["depth"][child] < s.max_depth) & (v["n"][child] >= self._least())
            self.waiting = child[fit]
            if not s.boosted and s.leaves == NO_LIMIT:
                few = v["n"][self.waiting] <= ALONE
                self.alone = np.concatenate([self.alone, self.waiting[few]])
                self.waiting = self.waiting[~few]
            if len(self.waiting):
                return

    def take(self, parts: list[tuple[np.ndarray, dict[str, np.ndarray]]]) -> None:
        """Take in what tasks have grown: for each part the nodes here that its first nodes are, and all its nodes. Only what
        ``finish`` asks for is kept."""
        v = {k: self.nodes[k] for k in ("feature", "cut", "left", "right", "depth", "g", "h", "n", "gain")}
        more: dict[str, list[np.ndarray]] = {k: [] for k in v}
        at = len(v["feature"])
        for top, found in parts:
            new = len(found["feature"]) - len(top)
            number = np.concatenate([top, at + np.arange(new)])
            inner = found["feature"] >= 0
            known = {k: np.where(inner, number[found[k]], 0) for k in ("left", "right")}
            known |= {k: found[k] for k in ("feature", "cut", "gain")}
            for k, x in known.items():
                v[k][top] = x[: len(top)]
            known |= {k: found[k] for k in ("depth", "g", "h", "n")}
            for k in v:
                more[k].append(known[k][len(top):].astype(v[k].dtype))
            at += new
        self.nodes = {k: np.concatenate([x, *more[k]]) for k, x in v.items()}
        self.alone = self.alone[:0]

    def finish(self) -> dict[str, np.ndarray]:
        """The nodes of the grown tree: splits that are not among the first are taken back. ``place`` says then where in it
        the rows of each node are."""
        v, s = self.nodes, self.setting
        feature, reached = v["feature"], np.ones(len(v["feature"]), bool)
        if s.leaves < NO_LIMIT:
            kept = np.zeros(len(feature), bool)
            kept[self._first()] = True
            feature = np.where(kept, feature, -1)
            reached[1:] = False
            for i in np.flatnonzero(kept):  # a kept split's parents are kept, and come before it
                reached[[v["left"][i], v["right"][i]]] = True
        number = np.cumsum(reached) - 1
        self.place = number
        if not reached.all():
            self.place, parent = number.copy(), np.zeros(len(number), np.int64)
            inner = np.flatnonzero(v["feature"] >= 0)
            parent[v["left"][inner]] = parent[v["right"][inner]] = inner
            for i in np.flatnonzero(~reached):
                self.place[i] = self.place[parent[i]]
        weight = v["h"] / SCALE + s.l2
        value = np.where(weight > 0, v["g"] / SCALE / np.where(weight > 0, weight, 1), 0.0) * s.rate
        out = {"feature": feature, "cut": v["cut"], "left": number[v["left"]], "right": number[v["right"]], "depth": v["depth"],
               "n": v["n"], "gain": np.where(feature >= 0, v["gain"], 0.0), "value": value}
        return {k: x[reached].astype(_KINDS[k]) for k, x in out.items()}


def _joined(trees: Sequence[dict[str, np.ndarray]], names: Sequence[str]) -> tuple[dict[str, np.ndarray], np.ndarray]:
    """The nodes of several trees one after the other, and where each begins."""
    sizes = [len(t["feature"]) for t in trees]
    roots = np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(np.int64) if trees else np.zeros(0, np.int64)
    shift = np.repeat(roots, sizes) if trees else roots
    nodes = {k: np.concatenate([t[k] for t in trees]) if trees else np.zeros(0, np.int64) for k in names}
    for k in ("left", "right"):
        nodes[k] = nodes[k].astype(np.int64) + shift
    return nodes, roots


class Grower:
    """Grows models side by side on one binned table; ``waves`` counts the jobs. Of ``trees`` only those are grown, without boosting."""

    def __init__(self, table: DataFrame, cuts: Sequence[Sequence[float]], settings: Sequence[Setting], features: Sequence[str] = (),
                 trees: range | None = None):
        self.table, self.waves = table, 0
        self.cuts = [list(map(float, c)) for c in cuts]
        self.offsets = np.concatenate([[0], np.cumsum([len(c) + 1 for c in self.cuts])])
        self.models = [Model(s, self.cuts, list(features)) for s in settings]
        self.boosted = [i for i, s in enumerate(settings) if s.boosted]
        self.finished: list[list[dict]] = [[] for _ in settings]
        self.unwritten: list[tuple[int, dict]] = []
        self.open: list[tuple[int, Growing]] = []
        self.ripe: list[tuple[int, Growing]] = []  # trees of which only nodes to grow alone are left
        self.small: list[int] = []  # boosted models whose rounds a task grows alone
        # trees that wait for a lane, the last one first; boosting begins first, as its rounds follow one another
        order = sorted(range(len(settings)), key=lambda i: not settings[i].boosted)
        numbers = [[0] if s.boosted else [t for t in range(s.trees) if trees is None or t in trees] for s in settings]
        self.next = [(i, t) for i in order for t in numbers[i]][::-1]
        self.fill = 1.0  # of the nodes that small nodes could grow to, how many there were

    def _begin(self) -> None:
        while self.next and len(self.open) < LANES:
            i, t = self.next.pop()
            self.open.append((i, Growing(self.models[i], t)))

    def _wave(self) -> tuple[Wave, list[tuple[Growing, np.ndarray]]]:
        asked, cells = [], 0
        columns, lanes = [], []
        for i, g in self.open:
            if cells > CELLS:
                break
            s = g.setting
            each = int(self.offsets[-1]) * (s.node_columns or len(self.cuts)) // len(self.cuts) + 1
            nodes = g.waiting[: max(1, (CELLS - cells) // each)]
            cells += len(nodes) * each
            columns.append(g.to_try(nodes))
            asked.append((g, nodes))
            lanes.append(i)
        names = ("feature", "cut", "left", "right")
        nodes, roots = _joined([g.nodes for g, _ in asked], names)
        number = np.full(len(nodes["feature"]), -1, np.int64)
        count = 0
        for root, (_, some) in zip(roots, asked):
            number[root + some] = np.arange(count, count + len(some))
            count += len(some)
        most = max(c.shape[1] for c in columns)
        tried = np.full((count, most), -1, np.int64)
        at = 0
        for c in columns:
            tried[at:at + len(c), : c.shape[1]] = c
            at += len(c)
        sets = [self.models[i].setting for i in lanes]
        of_lane = self._lanes([(i, g) for i, (g, _) in zip(lanes, asked)])
        per = [len(some) for _, some in asked]
        least = {k: np.repeat(np.array([float(getattr(s, k)) for s in sets]), per) for k in ("l2", "min_leaf", "min_weight")}
        place = {m: j for j, m in enumerate(self.boosted)}
        done, done_root = _joined([t for _, t in self.unwritten], (*names, "value"))
        buckets = max(1, min(count, cells // CELLS_PER_BUCKET + 1))
        return Wave(self.offsets, nodes, roots, number, tried, of_lane, least, np.array([place.get(i, -1) for i in lanes]),
                    len(self.boosted) if len(self.small) < len(self.boosted) else 0, done, done_root, np.array([place[i] for i, _ in self.unwritten], np.int64), buckets), asked

    def _lanes(self, grown: Sequence[tuple[int, Growing]]) -> dict[str, np.ndarray]:
        """How each of some trees draws its rows."""
        sets = [self.models[i].setting for i, _ in grown]
        return {
            "left_out": np.array([s.left_out for s in sets]), "row_share": np.array([s.row_share for s in sets]),
            "bootstrap": np.array([s.bootstrap for s in sets]), "weight_0": np.array([s.weights[0] for s in sets]),
            "weight_1": np.array([s.weights[1] for s in sets]),
            "seed": np.array([(s.seed << 20) + g.tree for s, (_, g) in zip(sets, grown)]),
        }

    def _grow_alone(self) -> None:
        """One job for the small nodes of ripe trees, as many as bring about ``HELD`` nodes to the driver."""
        bounds = [self._most_below(g) for _, g in self.ripe]
        last = max(1, int(np.searchsorted(np.cumsum(bounds) * self.fill, HELD, "right")))
        ripe, self.ripe = self.ripe[:last], self.ripe[last:]
        before = sum(len(g.nodes["feature"]) for _, g in ripe)
        sets = [g.setting for _, g in ripe]
        nodes, roots = _joined([g.nodes for _, g in ripe], ("feature", "cut", "left", "right"))
        per = [len(g.alone) for _, g in ripe]
        every = np.concatenate([root + g.alone for root, (_, g) in zip(roots, ripe)])
        number = np.full(len(nodes["feature"]), -1, np.int64)
        number[every] = np.arange(len(every))
        known = {k: np.concatenate([g.nodes[k][g.alone] for _, g in ripe]) for k in ("path", "depth", "n")}
        # neighbouring nodes travel together; their numbers fit 16 bits
        bucket = (np.cumsum(known["n"]) - known["n"]) // TOGETHER + np.arange(len(every)) // (1 << 15)
        bucket = np.unique(bucket, return_inverse=True)[1]
        lanes = self._lanes(ripe) | {
            "max_depth": np.array([s.max_depth for s in sets]), "least": np.array([g._least() for _, g in ripe]),
            "node_columns": np.array([s.node_columns or len(self.cuts) for s in sets]),
            "column_seed": np.array([(s.seed << 40) + (g.tree << 16) for s, (_, g) in zip(sets, ripe)], np.int64),
            **{k: np.array([float(getattr(s, k)) for s in sets]) for k in ("l2", "min_leaf", "min_weight")}}
        lane = np.repeat(np.arange(len(ripe)), per)
        below = Below(self.offsets, nodes, roots, number, lanes, lane, known["path"], known["depth"], bucket)
        grown: list[list[tuple]] = [[] for _ in ripe]
        for first, found in grown_below(self.table.select("label", "fold", "row", "bins"), below):
            order = np.argsort(found["lane"], kind="stable")
            place = np.empty(len(order), np.int64)
            ends = np.searchsorted(found["lane"][order], np.arange(found["lane"].min(), found["lane"].max() + 2))
            for t, a, b in zip(range(int(found["lane"].min()), len(ripe)), ends, ends[1:]):
                mine = order[a:b]
                place[mine] = np.arange(len(mine))
                some = {k: v[mine] for k, v in found.items()}
                inner = some["feature"] >= 0
                some |= {k: np.where(inner, place[np.where(inner, some[k], mine)], 0) for k in ("left", "right")}
                # the small nodes of a bucket come first, in the order of their numbers
                begin, end = np.searchsorted(lane, [t, t + 1])
                low = max(first, int(begin))
                high = min(int(np.searchsorted(bucket, bucket[first], "right")), int(end))
                grown[t].append((ripe[t][1].alone[low - begin:high - begin], some))
        for (_, g), parts in zip(ripe, grown):
            g.take(parts)
        new = sum(len(g.nodes["feature"]) for _, g in ripe) - before
        self.fill = min(1.0, 0.01 + 1.25 * new / sum(bounds[:last]))
        self.waves += 1
        self.open += ripe
        self._close()

    @staticmethod
    def _most_below(growing: Growing) -> int:
        """No more nodes grow below a tree's small nodes."""
        v, some = growing.nodes, growing.alone
        left = np.minimum(growing.setting.max_depth - v["depth"][some], 40)
        return int(2 * np.minimum(v["n"][some] * (2 if growing.setting.bootstrap else 1), 1 << left).sum())

    def _close(self) -> None:
        still = []
        for i, g in self.open:
            if g.setting.boosted and g.tree == 0 and 0 < g.nodes["n"][0] <= WHOLE * g.setting.row_share:
                self.small.append(i)
                continue
            if len(g.waiting):
                still.append((i, g))
                continue
            if len(g.alone):
                self.ripe.append((i, g))
                continue
            tree = g.finish()
            self.finished[i].append((g.tree, tree))
            if g.setting.boosted:
                self.unwritten.append((i, tree))
                if g.tree + 1 < g.setting.trees:
                    self.next.append((i, g.tree + 1))
        self.open = still

    def _boost_on(self) -> None:
        """One job for all rounds of the small boosted models."""
        rows = self.table.select("label", "fold", "row", "bins")
        for i, roots, nodes in boosted_alone(rows, self.cuts, {i: self.models[i].setting for i in self.small}):
            ends = np.append(roots, len(nodes["feature"]))
            for t, (a, b) in enumerate(zip(ends, ends[1:])):
                tree = {k: v[a:b] for k, v in nodes.items()}
                self.finished[i].append((t, tree | {k: tree[k] - a for k in ("left", "right")}))
        self.waves += 1

    def _splits(self, wave: Wave) -> dict[str, np.ndarray]:
        return best_splits(self.table, wave)

    def _keep_margins(self) -> None:
        by_waves = len(self.boosted) - len(self.small)
        if by_waves and len(self.unwritten) >= ROUNDS_KEPT * by_waves and self.open:
            self.table = with_margins(self.table, self._wave()[0])
            self.unwritten = []

    def grow(self) -> list[Model]:
        self._begin()
        while self.open or self.ripe:
            pairs = sum(int(g.nodes["n"][g.alone].sum()) for _, g in self.ripe)
            if self.ripe and (not self.open or pairs > SENT):
                self._grow_alone()
                self._begin()
                continue
            wave, asked = self._wave()
            found = self._splits(wave)
            self.waves += 1
            at = np.full(len(wave.columns), -1)
            at[found["number"]] = np.arange(len(found["number"]))
            begin = 0
            for g, nodes in asked:
                mine = at[begin:begin + len(nodes)]
                begin += len(nodes)
                # a node without rows has no cells and no split
                g.learn(nodes, {k: np.where(mine >= 0, found[k][mine] if len(found[k]) else 0, -1 if k == "feature" else 0)
                                for k in ("feature", "cut", "gain", "gl", "hl", "nl", "g", "h", "n")})
            self._close()
            self._begin()
            self._keep_margins()
        if self.small:
            self._boost_on()
        for i, model in enumerate(self.models):
            trees = [t for _, t in sorted(self.finished[i], key=lambda x: x[0])]
            self.finished[i] = []
            sizes = [len(t["feature"]) for t in trees]
            model.roots = np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(np.int64) if trees else np.zeros(0, np.int64)
            for k, kind in _KINDS.items():  # the trees' own arrays go as the model's are made
                model.nodes[k] = np.concatenate([np.zeros(0, kind), *(t.pop(k) for t in trees)], dtype=kind, casting="unsafe")
            for k in ("left", "right"):
                model.nodes[k] += np.repeat(model.roots, sizes)
        return self.models


class InTask:
    """Grows boosted models on rows that a task holds, round after round. They see all of these rows.

    The features are counted in groups as in ``_counted_jointly``. Of two children only the smaller one is counted, the other
    one is what is left of their parent. Sums are whole numbers, so the trees are those of waves.
    """

    def __init__(self, label: np.ndarray, row: np.ndarray, bins: np.ndarray, cuts: Sequence[Sequence[float]]):
        self.label, self.row, self.bins = label, row, np.ascontiguousarray(bins)
        self.cuts = [list(map(float, c)) for c in cuts]
        sizes = np.array([len(c) + 1 for c in self.cuts])
        self.offsets = np.concatenate([[0], np.cumsum(sizes)])
        self.feature = np.repeat(np.arange(len(sizes)), sizes)
        groups = _groups(sizes)
        self.begin = np.concatenate([[0], np.cumsum([int(np.prod(sizes[g])) for g in groups])])
        self.cells = np.empty((len(label), len(groups)), np.int32)
        self.parts = []  # for each group its cells, those of its features, and which of them add up to which
        for j, group in enumerate(groups):
            made, space = np.zeros(len(label), np.int32), int(self.begin[j + 1] - self.begin[j])
            below, places, shares = space, [], []
            for f in group:
                made = made * sizes[f] + self.bins[:, f]
                below //= int(sizes[f])
                places.append(np.arange(self.offsets[f], self.offsets[f + 1]))
                shares.append(np.arange(space)[:, None] // below % sizes[f] == np.arange(sizes[f]))
            self.cells[:, j] = made + self.begin[j]
            share = np.concatenate(shares, 1).astype(np.float64) if len(group) > 1 else None
            self.parts.append((slice(self.begin[j], self.begin[j + 1]), np.concatenate(places), share))

    def grow(self, setting: Setting) -> Iterator[dict[str, np.ndarray]]:
        """The finished trees, one for each round."""
        model = Model(setting, self.cuts)
        margin = np.zeros(len(self.label))
        weights = np.where(self.label == 1, setting.weights[1], setting.weights[0])
        every = np.arange(len(self.label))
        for t in range(setting.trees):
            if setting.row_share < 1:
                drawn = _uniform(self.row, np.array([(setting.seed << 20) + t]))[:, 0] < setting.row_share
                r, others = np.flatnonzero(drawn), np.flatnonzero(~drawn)
            else:
                r, others = every, every[:0]
            growing = Growing(model, t)
            at = self._grown(growing, r, margin, weights)
            tree = growing.finish()
            margin[r] += tree["value"][growing.place[at]]
            if len(others):
                margin[others] += tree["value"][_descend(self.bins, tree, 0, others)]
            yield tree

    def _grown(self, growing: Growing, r: np.ndarray, margin: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """Grows a tree on the rows ``r`` and returns the node at which each of them is."""
        weight, p = weights[r], 1 / (1 + np.exp(-margin[r]))
        g, h = np.rint(weight * (self.label[r] - p) * SCALE), np.rint(weight * p * (1 - p) * SCALE)
        # weights and rows are counted as one number where its sums stay below 2^53
        unit = float(1 << int(h.sum()).bit_length())
        sums = (g, h + unit) if unit * (len(r) + 1) < 1 << 53 else (g, h, np.ones(len(r)))
        tried = np.isin(self.feature, growing.columns)
        at, on = np.zeros(len(r), np.int64), np.arange(len(r))
        flat, count = self.bins.reshape(-1), self.bins.shape[1]
        waiting, held = growing.waiting, self._counted(r, np.zeros(len(r), np.int64), 1, sums, unit)
        while True:
            before = len(growing.nodes["feature"])
            growing.learn(waiting, self._best(growing.setting, held, tried))
            v = growing.nodes
            last, waiting = waiting, growing.waiting
            if len(v["feature"]) == before:
                return at
            # the rows of the nodes that were split go on
            here = at[on]
            moves = v["left"][here] >= before
            on, here = on[moves], here[moves]
            here = v["left"][here] + (flat[r[on] * count + v["feature"][here]] > v["cut"][here])
            at[on] = here
            if not len(waiting):
                return at
            pair = np.unique((waiting - before) // 2)
            first = before + 2 * pair
            small = first + (v["n"][first + 1] < v["n"][first])
            known = np.full(len(v["feature"]), -1)
            known[small] = np.arange(len(small))
            number = known[here]
            asked = number >= 0
            some = on[asked]
            found = self._counted(r[some], number[asked], len(small), [x[some] for x in sums], unit)
            parent = np.flatnonzero(v["left"] >= before)
            parent = parent[np.argsort(v["left"][parent])][pair]
            rest = held[np.searchsorted(last, parent)] - found
            of = np.searchsorted(pair, (waiting - before) // 2)
            held = np.where((waiting == small[of])[:, None, None], found[of], rest[of])
            known[:] = -1
            known[waiting] = 0
            on = on[known[here] >= 0]

    def _counted(self, rows: np.ndarray, number: np.ndarray, count: int, sums: Sequence[np.ndarray], unit: float) -> np.ndarray:
        """The g, h and n sums of ``count`` nodes by cell; ``number`` says at which of them each row is."""
        space, groups = int(self.begin[-1]), self.cells.shape[1]
        out = np.zeros((len(sums), count * space))
        for a in range(0, len(rows), COUNTED):
            b = a + COUNTED
            keys = (self.cells.take(rows[a:b], 0) + (number[a:b] * space)[:, None]).reshape(-1)
            for total, v in zip(out, sums):
                total += np.bincount(keys, np.repeat(v[a:b], groups), count * space)
        out = out.reshape(len(sums), count, space)
        found = np.empty((count, len(sums), int(self.offsets[-1])))
        for cells, places, share in self.parts:
            part = out[:, :, cells] if share is None else out[:, :, cells] @ share
            found[:, :, places] = part.transpose(1, 0, 2)
        if len(sums) == 3:
            return found
        n = np.floor(found[:, 1] / unit)
        return np.stack([found[:, 0], found[:, 1] - n * unit, n], 1)

    def _best(self, s: Setting, held: np.ndarray, tried: np.ndarray) -> dict[str, np.ndarray]:
        """As ``_best_of``, for all cells of some nodes; an empty cell is never the first of equal gains."""
        run = held.cumsum(2)
        before = np.concatenate([np.zeros((*held.shape[:2], 1)), run[:, :, self.offsets[1:-1] - 1]], 2)
        left = run - before[:, :, self.feature]
        total = run[:, :, self.offsets[1] - 1, None]
        (gl, hl, nl), (gt, ht, nt) = left.transpose(1, 0, 2), total.transpose(1, 0, 2)

        def worth(a, b):
            b = b / SCALE + s.l2
            return np.where(b > 0, (a / SCALE) ** 2 / np.where(b > 0, b, 1), 0)

        gain = worth(gl, hl) + worth(gt - gl, ht - hl) - worth(gt, ht)
        allowed = (nl < nt) & (nl >= max(1, s.min_leaf)) & (nt - nl >= s.min_leaf) & tried
        allowed &= (hl >= s.min_weight * SCALE) & (ht - hl >= s.min_weight * SCALE)
        gain = np.where(allowed & (gain > LEAST_GAIN), gain, 0.0)
        at, node = gain.argmax(1), np.arange(len(held))
        most = gain[node, at]
        found = {k: v.astype(np.int64) for k, v in zip(("gl", "hl", "nl"), left[node, :, at].T)}
        found |= {k: v.astype(np.int64) for k, v in zip(("g", "h", "n"), total[node, :, 0].T)}
        return found | {"gain": most, "feature": np.where(most > 0, self.feature[at], -1), "cut": at - self.offsets[self.feature[at]]}


def boosted_alone(table: DataFrame, cuts: Sequence[Sequence[float]],
                  settings: Mapping[int, Setting]) -> Iterator[tuple[int, np.ndarray, dict[str, np.ndarray]]]:
    """The job that grows all rounds of boosted models of few rows: each model's number, roots and nodes."""

    def made(task: InTask, setting: Setting, i: int, label: np.ndarray, bins: np.ndarray) -> list[np.ndarray]:
        nodes, roots = _joined(list(task.grow(setting)), list(_KINDS))
        return [roots.astype(np.int64), *(nodes[k].astype(kind) for k, kind in _KINDS.items())]

    for i, (roots, *nodes) in _in_tasks(table, cuts, settings, made):
        yield i, np.frombuffer(roots, np.int64), {k: np.frombuffer(x, kind) for x, (k, kind) in zip(nodes, _KINDS.items())}


def boosted_cells(table: DataFrame, cuts: Sequence[Sequence[float]], settings: Mapping[int, Setting],
                  rounds: Mapping[int, Sequence[int]]) -> Iterator[tuple[int, int, list[int]]]:
    """The same job where only the four cells over the rows that a model has not seen are asked for, after so many rounds:
    the trees stay in the task. Yields number, rounds and cells."""

    def made(task: InTask, setting: Setting, i: int, label: np.ndarray, bins: np.ndarray) -> list[np.ndarray]:
        margin, cells = np.zeros(len(label)), []
        for t, tree in enumerate(task.grow(setting), 1):
            margin += tree["value"][_descend(bins, tree, 0)]
            if t in rounds[i]:
                hit = 1 / (1 + np.exp(-margin)) > 0.5
                cells.append([t, *np.bincount(2 * label + hit, minlength=4)])
        return [np.array(cells, np.int64)]

    for i, (cells,) in _in_tasks(table, cuts, settings, made):
        for t, *four in np.frombuffer(cells, np.int64).reshape(-1, 5).tolist():
            yield i, t, four


def _in_tasks(table: DataFrame, cuts: Sequence[Sequence[float]], settings: Mapping[int, Setting],
              made: Callable[..., list[np.ndarray]]) -> Iterator[tuple[int, list[bytes]]]:
    """Each model's number and what ``made`` makes of it in a task, from the rows that it sees and those of its left out fold.

    A task gets the rows once for up to ``ABREAST`` models that leave out one fold.
    """
    buckets: list[list[int]] = []
    for fold in sorted({s.left_out for s in settings.values()}):
        mine = [i for i, s in settings.items() if s.left_out == fold]
        parts = -(-len(mine) // ABREAST)
        buckets += [mine[k::parts] for k in range(parts)]
    shared = _shared(table, ([list(map(float, c)) for c in cuts], [{i: settings[i] for i in b} for b in buckets]))
    sizes = np.array([len(c) + 1 for c in cuts])

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left_out = [next(iter(b.values())).left_out for b in _read(shared)[1]]
        for batch in _together(batches):
            label, fold, row = (batch.column(c).to_numpy() for c in ("label", "fold", "row"))
            r = np.flatnonzero(label >= 0)
            if not len(r):
                continue
            keys, packed = row[r].tobytes(), _packed(_bytes(batch.column("bins"), np.uint8, len(sizes)), sizes)[r]
            for f in sorted(set(left_out)):
                # a row of label 1 that is left out is 3
                kind = (label[r] + 2 * (fold[r] == f)).astype(np.uint8)
                rows = np.concatenate([kind[:, None], packed], 1).tobytes()
                for b in np.flatnonzero(np.array(left_out) == f):
                    yield pa.RecordBatch.from_arrays([pa.array([b], pa.int32()), pa.array([keys], pa.binary()), pa.array([rows], pa.binary())],
                                                     ["bucket", "row", "rows"])

    def boost(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cuts, buckets = _read(shared)
        held: dict[int, list[tuple]] = {}
        for batch in batches:
            for b, *parts in zip(*(c.to_pylist() for c in batch.columns)):
                held.setdefault(b, []).append(parts)
        for b in sorted(held):
            keys, rows = (b"".join(x) for x in zip(*held.pop(b)))
            row = np.frombuffer(keys, np.int64)
            rows = np.frombuffer(rows, np.uint8).reshape(len(row), -1)
            label, out = (rows[:, 0] & 1).astype(np.int64), rows[:, 0] > 1
            bins = _unpacked(rows[:, 1:], sizes)
            task = InTask(label[~out], row[~out], bins[~out], cuts)
            label, bins = label[out], np.ascontiguousarray(bins[out])
            for i, setting in buckets[b].items():
                found = [v.tobytes() for v in made(task, setting, i, label, bins)]
                yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([found], pa.list_(pa.binary()))], ["number", "found"])

    sent = table.mapInArrow(send, "bucket int, row binary, rows binary").repartitionById(len(buckets), "bucket")
    try:
        found = sent.mapInArrow(boost, "number int, found array<binary>").toArrow()
    finally:
        shared.unpersist()
    for r in found.to_pylist():
        yield r["number"], r["found"]


# searching

def search(table: DataFrame, cuts: Sequence[Sequence[float]], settings: Sequence[Setting],
           variants: Sequence[Variant]) -> list[tuple[int, ...]]:
    """(candidate, fold, tn, fp, fn, tp) of all variants over the rows that each model has not seen.

    No more than about ``HELD`` nodes of the models are on the driver at a time: small boosted models are scored in the tasks
    that grow them, larger ones some at a time; of forests some trees at a time are grown and added to the rows' votes.
    """
    seen = {r["fold"]: r["count"] for r in table.filter("label >= 0").groupBy("fold").count().collect()}
    cells = {(v.model, v.trees, v.depth, v.min_split): [0] * 4 for v in variants}
    rows = [sum(n for f, n in seen.items() if f != s.left_out) for s in settings]
    small = {i: s for i, s in enumerate(settings) if s.boosted and 0 < rows[i] <= WHOLE}
    if small:
        rounds = {i: sorted({v.trees for v in variants if v.model == i}) for i in small}
        for i, t, four in boosted_cells(table.select("label", "fold", "row", "bins"), cuts, small, rounds):
            for key in [k for k in cells if k[:2] == (i, t)]:
                cells[key] = four
    large = [i for i, s in enumerate(settings) if s.boosted and i not in small]
    while large:
        some, size = [], 0
        while large and (not some or size <= HELD):
            some.append(large.pop(0))
            size += settings[some[-1]].trees * most_nodes(settings[some[-1]], rows[some[-1]])
        at = {m: i for i, m in enumerate(some)}
        mine = [v for v in cells if v[0] in at]
        grown = Grower(table, cuts, [settings[m] for m in some]).grow()
        for r in tally(table, grown, [Variant(c, at[m], *of) for c, (m, *of) in enumerate(mine)]).collect():
            cells[mine[r["candidate"]]] = [r[k] for k in ("tn", "fp", "fn", "tp")]
    forests = {i: s for i, s in enumerate(settings) if not s.boosted}
    if forests:
        bounds = {i: most_nodes(s, rows[i]) for i, s in forests.items()}
        cells |= _forest_cells(table, cuts, forests, bounds, [k for k in cells if k[0] in forests])
    return [(v.candidate, settings[v.model].left_out, *map(int, cells[v.model, v.trees, v.depth, v.min_split])) for v in variants]


def most_nodes(s: Setting, rows: int) -> int:
    """No tree of the setting on so many rows has more nodes."""
    leaves = min(s.leaves, max(1, 2 * rows if s.bootstrap else rows), 1 << min(s.max_depth, 40))
    return 2 * leaves - 1


def _forest_cells(table: DataFrame, cuts: Sequence[Sequence[float]], settings: Mapping[int, Setting], bounds: dict[int, int],
                  asked: Sequence[tuple]) -> dict[tuple, list[int]]:
    """The cells of (model, trees, depth, split minimum). Each row keeps the sum of the votes so far of every part asked for of
    the model that has not seen it; votes are added tree by tree, so that sums are those of ``probabilities``."""
    slots: dict[int, list[tuple]] = {}
    for m, _, *of in asked:
        mine = slots.setdefault(settings[m].left_out, [])
        if (m, *of) not in mine:
            mine.append((m, *of))
    ends = sorted({k[1] for k in asked})
    rows = table.filter(F.col("label").between(0, 1) & F.col("fold").isin(sorted(slots))).select("label", "fold", "bins")
    found: dict[tuple, list[int]] = {}
    bounds, done = dict(bounds), 0
    while done < ends[-1]:
        some = [m for m in settings if settings[m].trees > done]
        last = min(done + max(1, HELD // sum(bounds[m] for m in some)), min(e for e in ends if e > done))
        grown = dict(zip(some, Grower(table, cuts, [settings[m] for m in some], trees=range(done, last)).grow()))
        for m, model in grown.items():
            # the trees that come are much like those before
            bounds[m] = min(bounds[m], 1 + 5 * len(model.nodes["feature"]) // (4 * len(model.roots)))
        rows = _with_votes(rows, grown, slots, len(cuts))
        del grown
        release(table.sparkSession)
        done = last
        if done in ends:
            found |= _vote_cells(rows, slots, [k for k in asked if k[1] == done])
    return found


def _with_votes(rows: DataFrame, models: Mapping[int, Model], slots: Mapping[int, Sequence[tuple]], width: int) -> DataFrame:
    """The rows with the models' votes added to ``votes``, written anew."""
    shared = _shared(rows, (dict(models), dict(slots)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        models, slots = _read(shared)
        for batch in batches:
            fold = batch.column("fold").to_numpy()
            bins = np.ascontiguousarray(_bytes(batch.column("bins"), np.uint8, width))
            votes = batch.column("votes").to_pylist() if "votes" in batch.schema.names else None
            out: list[bytes] = [b""] * len(fold)
            for f in np.unique(fold).tolist():
                mine = np.flatnonzero(fold == f)
                sums = np.zeros((len(slots[f]), len(mine)))
                if votes is not None:
                    sums = np.frombuffer(b"".join([votes[i] for i in mine]), np.float64).reshape(len(mine), -1).T.copy()
                for j, (m, depth, least) in enumerate(slots[f]):
                    if m in models:
                        v = models[m].nodes
                        stop = (v["depth"] >= depth) | (v["n"] < least)
                        nodes = {**v, "feature": np.where(stop, -1, v["feature"])}
                        for root in models[m].roots:
                            sums[j] += v["value"][_descend(bins, nodes, int(root), mine)]
                for i, x in zip(mine.tolist(), np.ascontiguousarray(sums.T)):
                    out[i] = x.tobytes()
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in ("label", "fold", "bins")] + [pa.array(out, pa.binary())],
                                             ["label", "fold", "bins", "votes"])

    try:
        return materialize(rows.mapInArrow(run, "label int, fold int, bins binary, votes binary"))
    finally:
        shared.unpersist()


def _vote_cells(rows: DataFrame, slots: Mapping[int, Sequence[tuple]], asked: Sequence[tuple]) -> dict[tuple, list[int]]:
    """The cells of models of as many trees as have voted so far."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = np.zeros((len(asked), 4), np.int64)
        for batch in batches:
            label, fold = (batch.column(c).to_numpy() for c in ("label", "fold"))
            votes = batch.column("votes").to_pylist()
            for f, parts in slots.items():
                mine = np.flatnonzero(fold == f)
                if not len(mine):
                    continue
                sums = np.frombuffer(b"".join([votes[i] for i in mine]), np.float64).reshape(len(mine), -1)
                for i, (m, trees, *of) in enumerate(asked):
                    if (m, *of) in parts:
                        hit = sums[:, parts.index((m, *of))] / trees > 0.5
                        cells[i] += np.bincount(2 * label[mine] + hit, minlength=4)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(asked)), pa.int32()), *map(pa.array, cells.T)], ["at", "tn", "fp", "fn", "tp"])

    parts = rows.select("label", "fold", "votes").mapInArrow(run, "at int, tn bigint, fp bigint, fn bigint, tp bigint")
    sums = parts.groupBy("at").agg(*[F.sum(c).alias(c) for c in ("tn", "fp", "fn", "tp")]).collect()
    return {asked[r["at"]]: list(r)[1:] for r in sums}


def grow(table: DataFrame, cuts: Sequence[Sequence[float]], settings: Sequence[Setting], features: Sequence[str] = (),
         variants: Sequence[Variant] | None = None) -> list:
    """The models of all settings, grown side by side on a ``binned`` table; if ``variants`` are given, what ``search`` finds for them."""
    if variants is not None:
        return search(table, cuts, settings, variants)
    return Grower(table, cuts, settings, features).grow()

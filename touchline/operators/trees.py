"""Boosted regression trees whose rows are read once.

Spark's ``GBTRegressor`` starts a job per level of every tree, 2,400 for 400 trees of depth 6, and each reads all rows.
Here rows are cut into bins once and dealt to the tasks of one barrier job. A task keeps its rows, the tasks show each
other the histograms of a level, and all of them grow the same trees. Bins, gains, leaves, residuals and the order of
categories are those of Spark's trees, and the result is Spark's own model.

A barrier's own exchange takes a second, so histograms go through small files of the shared scratch folder. Where that is
no mounted folder, or tasks find that they don't share it, Spark trains.
"""

from __future__ import annotations

import json
import math
import os
import sys
import time
import uuid
import zlib
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import BarrierTaskContext, cloudpickle
from pyspark.ml import regression
from pyspark.ml.functions import vector_to_array
from pyspark.ml.util import Identifiable
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchline.session import scratch_base, scratch_path

#: Rows worth a task of their own, and tasks at most: each gets the histograms of all others.
ROWS, MOST_TASKS = 200_000, 32
#: Seconds until a task gives up on another one: at first, and later.
PATIENCE = (10, 600)
#: Rows handled at once; cells of a histogram that several features share.
BLOCK, CELLS = 1 << 16, 4096
NODES = (
    "treeID int, nodeData struct<id: int, prediction: double, impurity: double, impurityStats: array<double>, rawCount: bigint, "
    "gain: double, leftChild: int, rightChild: int, split: struct<featureIndex: int, leftCategoriesOrThreshold: array<double>, numCategories: int>>"
)
# Functions that run in tasks travel with the job, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


class GBTRegressor(regression.GBTRegressor):
    """Spark's estimator, trained as above; settings that `covered` leaves out are trained by Spark."""

    def covered(self) -> bool:
        plain = self.getLossType() == "squared" and self.getFeatureSubsetStrategy() in ("all", "1.0") and self.getMinWeightFractionPerNode() == 0
        return plain and not any(self.isDefined(p) and self.getOrDefault(p) for p in (self.weightCol, self.validationIndicatorCol))

    def _fit(self, dataset: DataFrame) -> regression.GBTRegressionModel:
        spark = dataset.sparkSession
        label = F.col(self.getLabelCol()).cast("double")
        usable = label.isNotNull() & ~F.isnan(label) & (F.abs(label) < float("inf"))
        seen = dataset.agg(
            F.count("*").alias("n"), F.count(F.when(usable, 1)).alias("usable"), F.max(F.when(usable, F.abs(label))).alias("most")
        ).first()
        # What Spark refuses is refused by Spark.
        if not self.covered() or not seen.n or seen.usable < seen.n:
            return super()._fit(dataset)
        n_tasks, folder = -(-seen.n // ROWS), None
        if n_tasks > 1:
            slots, folder = slots_of(spark), mounted(spark)
            if not slots or not folder:
                return super()._fit(dataset)
            n_tasks = min(n_tasks, slots, MOST_TASKS)
        plain = [f"`{c.name}`" for c in dataset.schema if isinstance(c.dataType, T.AtomicType)]
        rows = dataset.select(
            label.alias("label"), vector_to_array(F.col(self.getFeaturesCol())).alias("features"), F.xxhash64(*plain).alias("key")
        )
        categories = categories_of(dataset, self.getFeaturesCol())
        most_bins = min(self.getMaxBins(), seen.n)
        if max(categories.values(), default=0) > most_bins:
            return super()._fit(dataset)
        edges = thresholds(rows, seen.n, most_bins, categories)
        n_features = len(edges)
        sizes = [categories.get(f, len(edges[f]) + 1) for f in range(n_features)]
        rate = self.getSubsamplingRate()
        settings = dict(
            folder=folder if n_tasks > 1 else None, sizes=sizes, categorical=sorted(categories), trees=self.getMaxIter(), depth=self.getMaxDepth(), step=self.getStepSize(),
            least_rows=self.getMinInstancesPerNode(), least_gain=self.getMinInfoGain(), rate=rate, seed=self.getSeed() & (1 << 64) - 1,
            # Residuals are multiples of a power of two that is so large that sums are exact, whatever their order.
            unit=2.0 ** (math.ceil(math.log2(4 * (seen.most or 1.0) * seen.n)) - 52), edges=edges,
        )
        kind = np.dtype(np.uint8 if max(sizes) <= 1 << 8 else np.uint16 if max(sizes) <= 1 << 16 else np.uint32)
        # A draw is by a row's key, so equal keys meet in a task; else rows are dealt evenly.
        keyed = rows if rate < 1 else rows.withColumn("key", F.lit(0).cast("bigint"))
        coded = keyed.mapInArrow(lambda batches: in_bins(batches, edges, categories, kind), "label double, key bigint, bins binary")
        dealt = coded.repartition(n_tasks, *(["key"] if rate < 1 else []))
        nodes = dealt.mapInArrow(lambda batches: boosted(batches, kind, settings), NODES, barrier=n_tasks > 1)
        path = scratch_path(spark, "trees")
        nodes.write.parquet(f"{path}/data")
        if n_tasks > 1 and spark.read.schema(NODES).parquet(f"{path}/data").isEmpty():
            return super()._fit(dataset)
        return self._copyValues(self._read(spark, path, n_features))

    def _read(self, spark: SparkSession, path: str, n_features: int) -> regression.GBTRegressionModel:
        """The model of the nodes at ``path``, with what else Spark stores."""

        def described(kind: str, uid: str, left_out: Sequence[str], **more: object) -> str:
            told, defaults = ({p.name: v for p, v in m.items() if p.name not in left_out} for m in (self._paramMap, self._defaultParamMap))
            return json.dumps({
                "class": f"org.apache.spark.ml.regression.{kind}", "timestamp": int(time.time() * 1000), "sparkVersion": spark.version,
                "uid": uid, "paramMap": told, "defaultParamMap": defaults, **more,
            })

        n_trees, of_boosting = self.getMaxIter(), ("lossType", "maxIter", "stepSize", "validationTol", "validationIndicatorCol", "subsamplingRate", "featureSubsetStrategy")
        trees = [
            (k, described("DecisionTreeRegressionModel", f"dtr_{Identifiable._randomUID().rsplit('_', 1)[-1]}", of_boosting), 1.0 if k == 0 else self.getStepSize())
            for k in range(n_trees)
        ]
        spark.createDataFrame(trees, "_1 int, _2 string, _3 double").coalesce(1).write.parquet(f"{path}/treesMetadata")
        whole = described("GBTRegressionModel", self.uid, (), numFeatures=n_features, numTrees=n_trees)
        spark.createDataFrame([(whole,)], "value string").coalesce(1).write.text(f"{path}/metadata")
        return regression.GBTRegressionModel.load(path)


def slots_of(spark: SparkSession) -> int:
    """Tasks that run at once; 0 where executors come and go, which barrier jobs don't allow."""
    if spark.sparkContext.getConf().get("spark.dynamicAllocation.enabled", "false").lower() == "true":
        return 0
    context = spark.sparkContext._jsc.sc()
    return context.maxNumConcurrentTasks(context.resourceProfileManager().defaultResourceProfile())


def mounted(spark: SparkSession) -> str | None:
    """The scratch folder's path for tasks, if files can be opened there."""
    path = spark._jvm.org.apache.hadoop.fs.Path(scratch_base(spark))
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return system.makeQualified(path).toUri().getPath() if system.getUri().getScheme() == "file" else None


def categories_of(dataset: DataFrame, column: str) -> dict[int, int]:
    """Features that are categories, with how many there are."""
    attrs = dataset.schema[column].metadata.get("ml_attr", {}).get("attrs", {})
    nominal = {a["idx"]: len(a["vals"]) if "vals" in a else a["num_vals"] for a in attrs.get("nominal", []) if "vals" in a or "num_vals" in a}
    return nominal | {a["idx"]: 2 for a in attrs.get("binary", [])}


def thresholds(rows: DataFrame, n_rows: int, most_bins: int, categories: dict[int, int]) -> list[np.ndarray]:
    """Spark's thresholds of each feature: from all rows, or about max(most_bins squared, 10,000) of them, which Spark takes too."""
    wanted = max(most_bins * most_bins, 10_000)
    if n_rows > wanted:
        # Another hash than the one that draws rows for a tree.
        rows = rows.filter(F.pmod(F.xxhash64("key", F.lit("thresholds")), F.lit(1 << 40)) < int((1 << 40) * wanted / n_rows))
    values = rows.select(F.posexplode("features").alias("feature", "value")).groupBy("feature", "value").agg(F.count("*").alias("n"))

    def of_feature(table: pa.Table) -> pa.Table:
        feature = table["feature"][0].as_py()
        found = [] if feature in categories else edges_of(table["value"].to_numpy(), table["n"].to_numpy(), most_bins).tolist()
        return pa.table({"feature": pa.array([feature], pa.int32()), "edges": pa.array([found], pa.list_(pa.float64()))})

    found = {r.feature: np.array(r.edges, float) for r in values.groupBy("feature").applyInArrow(of_feature, "feature int, edges array<double>").collect()}
    return [found[f] for f in range(len(found))]


def edges_of(values: np.ndarray, counts: np.ndarray, most_bins: int) -> np.ndarray:
    """Between all neighbours if they are few, else where the running count comes nearest to equal shares."""
    order = np.argsort(values)
    values, counts = values[order], counts[order].astype(float)
    between = (values[:-1] + values[1:]) / 2
    if len(between) <= most_bins - 1:
        return between
    stride, upto = counts.sum() / most_bins, np.cumsum(counts)
    target, found = stride, []
    for k, (previous, current) in enumerate(zip(upto[:-1].tolist(), upto[1:].tolist())):
        if abs(previous - target) < abs(current - target):
            found.append(between[k])
            target += stride
    return np.array(found)


def in_bins(
    batches: Iterator[pa.RecordBatch], edges: Sequence[np.ndarray], categories: dict[int, int], kind: np.dtype
) -> Iterator[pa.RecordBatch]:
    """``label``, ``key`` and a row's bins as bytes. Categories are their own bins."""
    for batch in batches:
        n = batch.num_rows
        values = batch.column("features").flatten().to_numpy().reshape(n, len(edges))
        bins = np.empty((n, len(edges)), kind)
        for f, at in enumerate(edges):
            bins[:, f] = values[:, f] if f in categories else np.searchsorted(at, values[:, f], side="left")
        data, width = bins.tobytes(), len(edges) * kind.itemsize
        offsets = np.arange(n + 1, dtype=np.int32) * width
        packed = pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(offsets), pa.py_buffer(data)])
        yield pa.RecordBatch.from_arrays([batch.column("label"), batch.column("key"), packed], names=["label", "key", "bins"])


class Rows:
    """A task's rows: bins by feature, and codes of groups of features whose bins make one histogram."""

    def __init__(self, bins: np.ndarray, sizes: Sequence[int]):
        self.bins, self.sizes, self.n = bins, sizes, bins.shape[1]
        self.starts = np.concatenate([[0], np.cumsum(sizes)])
        groups: list[list[int]] = []
        for f in sorted(range(len(sizes)), key=lambda f: -sizes[f]):
            room = next((g for g in groups if math.prod(sizes[x] for x in g) * sizes[f] <= CELLS), None)
            room.append(f) if room is not None else groups.append([f])
        self.groups = [(g, [sizes[f] for f in g]) for g in groups]
        self.codes = []
        for g, shape in self.groups:
            cells = math.prod(shape)
            code = np.zeros(self.n, np.uint16 if cells <= 1 << 16 else np.uint32)
            for f in g:
                code *= sizes[f]
                code += bins[f].astype(code.dtype)
            self.codes.append(code)

    def histogram(self, rows: np.ndarray, g: np.ndarray) -> np.ndarray:
        """Sums of ``g`` and counts of the given rows, in every bin of every feature."""
        cells = [math.prod(shape) for _, shape in self.groups]
        sums, counts = [np.zeros(c) for c in cells], [np.zeros(c, np.int64) for c in cells]
        for k in range(0, len(rows), BLOCK):
            part = rows[k:k + BLOCK]
            # Nothing is out of range; "clip" spares the check.
            weights = g.take(part, mode="clip")
            for j, code in enumerate(self.codes):
                at = code.take(part, mode="clip").astype(np.intp)
                sums[j] += np.bincount(at, weights, cells[j])
                counts[j] += np.bincount(at, minlength=cells[j])
        found = np.empty((2, self.starts[-1]))
        for j, (group, shape) in enumerate(self.groups):
            for axis, f in enumerate(group):
                others = tuple(a for a in range(len(group)) if a != axis)
                for side, table in enumerate((sums[j], counts[j])):
                    found[side, self.starts[f]:self.starts[f + 1]] = table.reshape(shape).sum(axis=others)
        return found

    def parted(self, rows: np.ndarray, feature: int, left: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        goes = left.take(self.bins[feature].take(rows, mode="clip"), mode="clip")
        return rows.compress(goes), rows.compress(~goes)


def best_splits(tables: np.ndarray, starts: np.ndarray, categorical: Sequence[int], least_rows: int, least_gain: float) -> list[tuple | None]:
    """For each node the gain, feature, bins that go left, and both sides' sum and count; nothing where no split gains.

    ``tables``: nodes, sum and count, bins of all features. Categories stand by their mean; of equal gains the first counts.
    """
    tables, orders = tables.copy(), {}
    for f in categorical:
        part = slice(starts[f], starts[f + 1])
        sums, counts = tables[:, 0, part], tables[:, 1, part]
        means = np.where(counts > 0, sums / np.maximum(counts, 1), np.inf)
        orders[f] = np.argsort(means, axis=1, kind="stable")
        tables[:, :, part] = np.take_along_axis(tables[:, :, part], orders[f][:, None, :], axis=2)
    total = tables[:, :, :starts[1]].sum(axis=2)
    upto = np.cumsum(tables, axis=2)
    before = np.concatenate([np.zeros((len(tables), 2, 1)), upto], axis=2)[:, :, starts[:-1]]
    left = upto - np.repeat(before, np.diff(starts), axis=2)
    right = total[:, :, None] - left
    (sum_left, n_left), (sum_right, n_right), n = left.transpose(1, 0, 2), right.transpose(1, 0, 2), total[:, 1]
    # The drop of the variance. Means of equal values are equal, so a pure node gains exactly nothing.
    apart = sum_left / np.maximum(n_left, 1) - sum_right / np.maximum(n_right, 1)
    share = np.maximum(n, 1)[:, None]
    gains = (n_left / share) * (n_right / share) * apart * apart
    gains[(n_left < least_rows) | (n_right < least_rows) | (gains < least_gain)] = -1
    # All bins are no side.
    gains[:, starts[1:] - 1] = -1
    found: list[tuple | None] = []
    for k, at in enumerate(gains.argmax(axis=1)):
        if gains[k, at] <= 0:
            found.append(None)
            continue
        f = int(np.searchsorted(starts, at, side="right")) - 1
        goes = np.zeros(starts[f + 1] - starts[f], bool)
        upto_here = at - starts[f] + 1
        goes[orders[f][k][:upto_here] if f in orders else slice(0, upto_here)] = True
        found.append((gains[k, at], f, goes, left[k, :, at], right[k, :, at]))
    return found


class Node:
    """A node of the tree, with the rows of this task that reach it."""

    def __init__(self, total: Sequence[float], rows: np.ndarray):
        self.sum, self.n, self.rows = float(total[0]), int(total[1]), rows
        self.squares, self.gain, self.split, self.children = 0.0, -1.0, None, ()

    @property
    def value(self) -> float:
        return self.sum / self.n if self.n else 0.0


def grow(data: Rows, rows: np.ndarray, g: np.ndarray, settings: dict, together: Callable[[np.ndarray], np.ndarray]) -> tuple[Node, list[Node]]:
    """A tree on ``g``, and its leaves. ``together`` adds up what all tasks have.

    Of two children the smaller one is counted; the other is what is left of its parent, exactly, as sums are exact.
    """
    table = together(data.histogram(rows, g)[None])
    root = Node(table[0][:, :data.starts[1]].sum(axis=1), rows)
    level, leaves = [root], []
    for depth in range(settings["depth"]):
        found = best_splits(table, data.starts, settings["categorical"], settings["least_rows"], settings["least_gain"])
        parents = [(k, node, split) for k, (node, split) in enumerate(zip(level, found)) if split]
        leaves += [node for node, split in zip(level, found) if not split]
        for _, node, (gain, feature, goes, left, right) in parents:
            node.gain, node.split = float(gain), (feature, goes)
            node.children = tuple(map(Node, (left, right), data.parted(node.rows, feature, goes)))
        level = [child for _, node, _ in parents for child in node.children]
        if not level or depth + 1 == settings["depth"]:
            break
        fewer = [int(node.children[1].n < node.children[0].n) for _, node, _ in parents]
        counted = together(np.stack([data.histogram(node.children[side].rows, g) for (_, node, _), side in zip(parents, fewer)]))
        rest = table[[k for k, _, _ in parents]] - counted
        table = np.stack([x for side, c, r in zip(fewer, counted, rest) for x in ((r, c) if side else (c, r))])
    return root, leaves + level


class Together:
    """Adds up arrays of all tasks of a barrier job; without a folder there is one task.

    Each task has two files that it writes in turn. Whoever writes the second time after an array has seen everyone's array
    in between, so nobody still waits for what is overwritten.
    """

    def __init__(self, folder: str | None):
        self.rank, self.tasks, self.shared, self.turn = 0, 1, True, 0
        if folder is None:
            return
        context = BarrierTaskContext.get()
        self.rank, self.tasks = context.partitionId(), len(context.getTaskInfos())
        self.folder = f"{folder}/touchline/together-{context.allGather(uuid.uuid4().hex)[0]}"
        try:
            os.makedirs(self.folder, exist_ok=True)
            seen = self(np.ones(1), PATIENCE[0])[0] == self.tasks
        except OSError:
            seen = False
        self.shared = all(x == "True" for x in context.allGather(str(seen)))

    def __call__(self, mine: np.ndarray, patience: float = PATIENCE[1]) -> np.ndarray:
        if self.tasks == 1:
            return mine
        self.turn += 1
        data = np.ascontiguousarray(mine).tobytes()
        with open(self.at(self.rank), "wb") as file:
            file.write(self.mark(data) + data)
        return sum(np.frombuffer(self.read(rank, patience)).reshape(mine.shape) for rank in range(self.tasks))

    def at(self, rank: int) -> str:
        return f"{self.folder}/{rank}-{self.turn % 2}"

    def mark(self, data: bytes) -> bytes:
        return self.turn.to_bytes(8, "little") + zlib.crc32(data).to_bytes(4, "little")

    def read(self, rank: int, patience: float) -> bytes:
        until = time.monotonic() + patience
        while True:
            try:
                with open(self.at(rank), "rb") as file:
                    found = file.read()
            except FileNotFoundError:
                found = b""
            # A file that is being written has another mark than its content.
            if found[:12] == self.mark(found[12:]) and len(found) > 12:
                return found[12:]
            if time.monotonic() > until:
                raise TimeoutError(f"no array {self.turn} of task {rank} after {patience} s")
            time.sleep(0.0005)


def boosted(batches: Iterator[pa.RecordBatch], kind: np.dtype, settings: dict) -> Iterator[pa.RecordBatch]:
    """The nodes of all trees, from the first task; each task has a part of the rows."""
    sizes, unit, rate = settings["sizes"], settings["unit"], settings["rate"]
    labels, keys, bins = [np.empty(0)], [np.empty(0, np.int64)], [np.empty((len(sizes), 0), kind)]
    for batch in batches:
        labels.append(batch.column("label").to_numpy())
        if rate < 1:
            keys.append(batch.column("key").to_numpy())
        bins.append(np.frombuffer(b"".join(batch.column("bins").to_pylist()), kind).reshape(-1, len(sizes)).T)
    y, key, data = np.concatenate(labels), np.concatenate(keys), Rows(np.concatenate(bins, axis=1), sizes)
    del labels, keys, bins
    together = Together(settings["folder"])
    if not together.shared:
        return
    every, rest, trees = np.arange(data.n), y.copy(), []
    draws = numbered_keys(key) if rate < 1 else None
    for t in range(settings["trees"]):
        g = np.rint((rest if t == 0 else 2 * rest) / unit) * unit
        kept = drawn(draws, settings["seed"], t, rate) if rate < 1 else None
        root, leaves = grow(data, every if kept is None else every[kept], g, settings, together)
        step = 1.0 if t == 0 else settings["step"]
        for leaf in leaves:
            rest[leaf.rows] -= step * leaf.value
            leaf.squares = float(np.dot(g[leaf.rows], g[leaf.rows]))
        if kept is not None:
            lower(data, root, every[~kept], rest, step)
        for node, squares in zip(leaves, together(np.array([leaf.squares for leaf in leaves]))):
            node.squares = float(squares)
        for node in inner(root):
            node.rows = None
        trees.append(root)
    if together.rank == 0:
        for t, root in enumerate(trees):
            yield described_nodes(t, root, settings)


def inner(node: Node) -> Iterator[Node]:
    """All nodes, parents first."""
    yield node
    for child in node.children:
        yield from inner(child)


def lower(data: Rows, node: Node, rows: np.ndarray, rest: np.ndarray, step: float) -> None:
    """Take a tree's values off ``rest`` for rows it did not learn from."""
    if not node.children:
        rest[rows] -= step * node.value
        return
    for child, part in zip(node.children, data.parted(rows, *node.split)):
        lower(data, child, part, rest, step)


def mixed(x: np.ndarray) -> np.ndarray:
    """Hashes of 64 bits (the finalizer of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def numbered_keys(key: np.ndarray) -> np.ndarray:
    """Keys, different for repeated rows, whatever the order of rows."""
    order = np.argsort(key, kind="stable")
    new = np.concatenate([[True], np.diff(key[order]) != 0])[:len(key)]
    place = np.arange(len(key))
    number = np.empty(len(key), np.uint64)
    number[order] = place - np.maximum.accumulate(np.where(new, place, 0))
    return mixed(key.view(np.uint64) + number * np.uint64(0x9E3779B97F4A7C15))


def drawn(keys: np.ndarray, seed: int, tree: int, rate: float) -> np.ndarray:
    """Rows that a tree learns from."""
    salt = mixed(mixed(np.array([seed], np.uint64)) + np.uint64(tree + 1))
    return mixed(keys ^ salt) < np.uint64(int(rate * 2.0 ** 64))


def described_nodes(tree: int, root: Node, settings: dict) -> pa.RecordBatch:
    """A tree as Spark stores it; leaves of one parent that predict the same are one."""
    for node in reversed(list(inner(root))):
        if node.children:
            node.squares = sum(child.squares for child in node.children)
            if not any(child.children for child in node.children) and len({child.value for child in node.children}) == 1:
                node.children, node.gain = (), -1.0
    nodes = list(inner(root))
    numbers = {id(node): k for k, node in enumerate(nodes)}

    def split(node: Node) -> dict:
        if not node.children:
            return {"featureIndex": -1, "leftCategoriesOrThreshold": [], "numCategories": -1}
        feature, goes = node.split
        if feature in settings["categorical"]:
            return {"featureIndex": feature, "leftCategoriesOrThreshold": np.flatnonzero(goes).astype(float).tolist(), "numCategories": len(goes)}
        return {"featureIndex": feature, "leftCategoriesOrThreshold": [float(settings["edges"][feature][goes.sum() - 1])], "numCategories": -1}

    rows = [{
        "id": numbers[id(node)], "prediction": node.value, "impurity": max(0.0, node.squares - node.sum * node.value) / max(node.n, 1),
        "impurityStats": [float(node.n), node.sum, node.squares], "rawCount": node.n, "gain": node.gain,
        "leftChild": numbers[id(node.children[0])] if node.children else -1, "rightChild": numbers[id(node.children[1])] if node.children else -1,
        "split": split(node),
    } for node in nodes]
    kind = pa.struct([
        ("id", pa.int32()), ("prediction", pa.float64()), ("impurity", pa.float64()), ("impurityStats", pa.list_(pa.float64())),
        ("rawCount", pa.int64()), ("gain", pa.float64()), ("leftChild", pa.int32()), ("rightChild", pa.int32()),
        ("split", pa.struct([("featureIndex", pa.int32()), ("leftCategoriesOrThreshold", pa.list_(pa.float64())), ("numCategories", pa.int32())])),
    ])
    return pa.RecordBatch.from_arrays([pa.array([tree] * len(rows), pa.int32()), pa.array(rows, kind)], names=["treeID", "nodeData"])


#: A lone bit times this has another number in its top six bits for each place of the bit.
DE_BRUIJN = np.uint64(0x03F79D71B4CB0A89)


class Scorer:
    """Predictions of rows, and of rows with one feature's value from elsewhere, for all features together.

    A tree of up to 64 leaves is a table per feature that has, for each bin, the leaves that its splits leave open. All
    features' tables leave one leaf as the first, so a feature's exchange costs one look-up per tree, not a walk.
    """

    def __init__(self, nodes: Sequence, weights: Sequence[float], n_features: int):
        trees: dict[int, dict[int, object]] = {}
        for r in nodes:
            trees.setdefault(r.treeID, {})[r.nodeData.id] = r.nodeData
        edges, self.categories = [set() for _ in range(n_features)], {}
        for split in (n.split for tree in trees.values() for n in tree.values() if n.leftChild >= 0):
            if split.numCategories >= 0:
                self.categories[split.featureIndex] = split.numCategories
            else:
                edges[split.featureIndex].add(split.leftCategoriesOrThreshold[0])
        self.edges = [np.array(sorted(e)) for e in edges]
        self.trees = [self._tables(trees[t], weight) for t, weight in enumerate(weights)]
        self.used = sorted({f for tables, _ in self.trees for f in tables})

    def _tables(self, tree: dict[int, object], weight: float) -> tuple[dict[int, np.ndarray], np.ndarray]:
        tables: dict[int, np.ndarray] = {}
        values: list[float] = []

        def walk(node) -> None:
            if node.leftChild < 0:
                values.append(node.prediction * weight)
                return
            f, first = node.split.featureIndex, len(values)
            walk(tree[node.leftChild])
            closed = np.uint64(~(((1 << (len(values) - first)) - 1) << first) & (1 << 64) - 1)
            walk(tree[node.rightChild])
            told = node.split.leftCategoriesOrThreshold
            if f in self.categories:
                table = tables.setdefault(f, np.full(self.categories[f], ~np.uint64(0)))
                table[np.isin(np.arange(len(table)), told, invert=True)] &= closed
            else:
                table = tables.setdefault(f, np.full(len(self.edges[f]) + 1, ~np.uint64(0)))
                table[np.searchsorted(self.edges[f], told[0]) + 1:] &= closed

        walk(tree[0])
        bits = np.uint64(1) << np.arange(len(values), dtype=np.uint64)
        by_hash = np.zeros(64)
        by_hash[((bits * DE_BRUIJN) >> np.uint64(58)).view(np.intp)] = values
        return tables, by_hash

    def bins(self, values: np.ndarray) -> list[np.ndarray]:
        return [
            values[:, f].astype(np.intp) if f in self.categories else np.searchsorted(self.edges[f], values[:, f], side="left")
            for f in range(values.shape[1])
        ]

    def scored(self, own: np.ndarray, other: np.ndarray) -> tuple[np.ndarray, dict[int, np.ndarray]]:
        """Predictions, and for each used feature those with its value from ``other``."""
        n, own, other = len(own), self.bins(own), self.bins(other)
        whole, each = np.zeros(n), {f: np.zeros(n) for f in self.used}
        for tables, values in self.trees:
            def valued(leaves: np.ndarray) -> np.ndarray:
                return values.take((((leaves & -leaves) * DE_BRUIJN) >> np.uint64(58)).view(np.intp), mode="clip")

            masks = [table.take(own[f]) for f, table in tables.items()]
            after = [np.full(n, ~np.uint64(0))]
            for mask in reversed(masks):
                after.append(after[-1] & mask)
            found = valued(after.pop())
            whole += found
            before = None
            for (f, table), mask in zip(tables.items(), masks):
                others = after.pop() if before is None else before & after.pop()
                each[f] += valued(others & table.take(other[f]))
                before = mask if before is None else before & mask
            for f in each.keys() - tables.keys():
                each[f] += found
        return whole, each


def scorer_of(model: regression.GBTRegressionModel) -> Scorer | None:
    """None for trees of more than 64 leaves."""
    spark = SparkSession.active()
    path = scratch_path(spark, "scorer")
    model.write().save(path)
    nodes = spark.read.parquet(f"{path}/data").collect()
    leaves: dict[int, int] = {}
    for r in nodes:
        leaves[r.treeID] = leaves.get(r.treeID, 0) + (r.nodeData.leftChild < 0)
    return Scorer(nodes, model.treeWeights, model.numFeatures) if max(leaves.values()) <= 64 else None


def errors_with_others(rows: DataFrame, scorer: Scorer, n_features: int) -> DataFrame:
    """``e0``: the error of each row of ``label``, ``own`` and ``other``; ``e1`` on: with the first feature's other value, and so on."""
    names = [f"e{k}" for k in range(n_features + 1)]

    def errors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            y = batch.column("label").to_numpy()
            own, other = (batch.column(c).flatten().to_numpy().reshape(len(y), n_features) for c in ("own", "other"))
            whole, each = scorer.scored(own, other)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.abs(p - y)) for p in (whole, *[each.get(f, whole) for f in range(n_features)])], names=names
            )

    return rows.mapInArrow(errors, ", ".join(f"{c} double" for c in names))

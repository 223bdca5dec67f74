"""Forests of many shallow trees over many rows (MLT-02, MLT-09).

Spark's own fit holds a count per row and tree and walks every row down every tree
one by one; the model scores the same way.  Here the rows become blocks of bin
numbers once.  Each pass over the blocks counts the classes per tree, open node,
feature and bin; the counts are shuffled by tree and summed, and every tree's group
picks its splits.  A row's leaf is the bit that all its bins leave over.  What is
grown is the same: every tree on all rows with Poisson(1) counts, a random choice of
features for each node, Spark's candidate thresholds, gini gains and pruning, saved
and loaded as a ``RandomForestClassificationModel``.  The draws are others than Spark's.
"""

from __future__ import annotations

import json
import math
import time
from collections.abc import Iterator
from itertools import batched, combinations

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel, TaskContext
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import IndexToString
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path, ship_package

MIN_PAIRS = 2 ** 26  # rows x trees; up to that Spark's own fit holds 256 MB of counts
MIN_TREES = 32       # smaller forests are scored by Spark's model
MAX_LEAVES = 32      # of a tree, one bit each
BLOCK = 16384        # rows of a block at least
TREES = 16           # that are counted together
TASK_ROWS = 2 ** 20  # rows of a task at most, on the average

_CLASS = "org.apache.spark.ml.classification.{}"
_NODES = ("treeID int, nodeData struct<id: int, prediction: double, impurity: double, impurityStats: array<double>, "
          "rawCount: bigint, gain: double, leftChild: int, rightChild: int, "
          "split: struct<featureIndex: int, leftCategoriesOrThreshold: array<double>, numCategories: int>>")
_SPLITS = ("tree int, node int, feature int, gain double, goes_left array<int>, "
           "own array<bigint>, on_left array<bigint>")


def bounded_rows(df: DataFrame, most: int) -> list[dict]:
    """The rows of a small result on the driver; more than ``most`` are an error."""
    table = df.limit(most + 1).toArrow()
    if table.num_rows > most:
        raise ValueError(f"more than {most} rows for the driver")
    return table.to_pylist()


# --- leaves as bits ----------------------------------------------------------

_MULTIPLIER = np.uint32(0x077CB531)  # a de Bruijn sequence: every single bit gets a place of its own
_PLACES = ((np.uint32(1) << np.arange(MAX_LEAVES, dtype=np.uint32)) * _MULTIPLIER) >> np.uint32(27)


def _leaf_bits(splits: dict, root: int, offsets: np.ndarray, numbers: dict) -> np.ndarray:
    """For every bin of every feature the leaves that it leaves open.  ``splits`` has
    (feature, left side by bin, left child, right child) of the inner nodes."""
    open_ = np.full(offsets[-1], 0xFFFFFFFF, np.uint32)

    def below(node: int) -> int:
        if node not in splits:
            return 1 << numbers[node]
        f, goes_left, left, right = splits[node]
        on_left, on_right = below(left), below(right)
        open_[offsets[f]:offsets[f + 1]] &= ~np.where(goes_left, on_right, on_left).astype(np.uint32)
        return on_left | on_right

    open_ &= np.uint32(below(root))
    return open_


class _Room:
    """Arrays for one block's work, so that its steps do not ask for new memory each."""

    def __init__(self, n: int):
        self.bits, self.one = np.empty(n, np.uint32), np.empty(n, np.uint32)
        self.leaf, self.at, self.place = np.empty(n, np.intp), np.empty(n, np.intp), np.empty(n, np.intp)
        self.weights = np.empty(n)


def _leaves(bits: list, codes, room: _Room) -> np.ndarray:
    """The place of every row's leaf, from the bits per feature and the rows' bins."""
    bits[0].take(codes[0], out=room.bits, mode="clip")
    for b, c in zip(bits[1:], codes[1:], strict=True):
        if b is not None:
            room.bits &= b.take(c, out=room.one, mode="clip")
    room.bits *= _MULTIPLIER
    room.bits >>= np.uint32(27)
    room.leaf[:] = room.bits
    return room.leaf


def _by_feature(bits: np.ndarray, offsets: np.ndarray, repeats: int = 1) -> list:
    """The bits of each feature; None for a later feature that no split asks for."""
    parts = [bits[a:b] for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
    whole = np.bitwise_or.reduce(bits)
    return [np.repeat(p, repeats) if k == 0 or (p != whole).any() else None for k, p in enumerate(parts)]


# --- growing -----------------------------------------------------------------

_CUTS = np.cumsum([math.exp(-1) / math.factorial(k) for k in range(20)])  # Poisson(1)
_BORDER = 255  # of 256 cells five have a cut inside, the last one several
_DRAWS = bytes(_BORDER if (_CUTS * 256).astype(int).clip(0, 255).tolist().count(c) else int((_CUTS * 256 < c).sum()) for c in range(256))


def bootstrap_counts(key: list[int], n: int) -> np.ndarray:
    """How often each of ``n`` rows is drawn: Poisson with mean 1, the same for the same
    key.  8 random bits are enough for most rows, those in a border's cell get 53 more."""
    random = np.random.Generator(np.random.SFC64(key))
    cells = random.bit_generator.random_raw(-(-n // 8)).tobytes()[:n]
    out = np.frombuffer(bytearray(cells.translate(_DRAWS)), np.uint8)
    near = np.flatnonzero(out == _BORDER)
    out[near] = np.searchsorted(_CUTS, (np.frombuffer(cells, np.uint8)[near] + random.random(len(near))) / 256, side="right")
    return out


def gini(counts: np.ndarray) -> np.ndarray:
    n = counts.sum(axis=-1, keepdims=True)
    return np.where(n[..., 0] > 0, 1.0 - ((counts / np.maximum(n, 1)) ** 2).sum(axis=-1), 0.0)


def thresholds(data: DataFrame, rows: int, features: list[int], bins: int, seed: int) -> dict[int, np.ndarray]:
    """Spark's candidate thresholds of the numeric features: of its sample of max(bins^2,
    10000) rows, the midpoints of neighbouring values nearest to equal shares."""
    need = max(bins * bins, 10000)
    sample = data if rows <= need else data.sample(False, need / rows, seed)
    values = sample.select(F.posexplode("x").alias("feature", "value")).where(F.col("feature").isin(features))

    def pick(table: pa.Table) -> pa.Table:
        table = table.sort_by("value")
        v, n = table["value"].to_numpy(), table["n"].to_numpy()
        middle = v[:-1] + (v[1:] - v[:-1]) / 2
        if len(middle) >= bins:
            stride = n.sum() / bins
            kept, target, so_far = [], stride, n[0]
            for i in range(1, len(v)):
                before, so_far = so_far, so_far + n[i]
                if abs(before - target) < abs(so_far - target):
                    kept.append(i - 1)
                    target += stride
            middle = middle[kept]
        return pa.table({"feature": pa.array([table["feature"][0].as_py()], pa.int32()), "at": pa.array([middle.tolist()], pa.list_(pa.float64()))})

    picked = values.groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n")).groupBy("feature").applyInArrow(pick, "feature int, at array<double>")
    found = {r["feature"]: np.array(r["at"], float) for r in bounded_rows(picked, len(features))} if features else {}
    return {f: found.get(f, np.empty(0)) for f in features}


def _blocks(data: DataFrame, edges: dict, arity: dict, classes: int, block: int) -> DataFrame:
    """One row per block: its number, its rows, their bins feature by feature, their classes."""
    width = len(edges) + len(arity)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, held = TaskContext.get().partitionId(), 0, []

        def flush() -> pa.RecordBatch:
            x, y = (np.concatenate(z) for z in zip(*held, strict=True))
            if not np.isfinite(x).all():  # as Spark's own fit
                raise ValueError("a feature is NaN or infinite")
            bins = np.empty((width, len(y)), np.uint16)
            for f in range(width):
                v = x[:, f]
                if f in arity and not ((v >= 0) & (v < arity[f]) & (v == np.floor(v))).all():
                    raise ValueError(f"feature {f} has a value that is none of its {arity[f]} categories")
                bins[f] = v if f in arity else np.searchsorted(edges[f], v, side="left")
            if not ((y >= 0) & (y < classes) & (y == np.floor(y))).all():
                raise ValueError(f"a label is none of the {classes} classes")
            return pa.record_batch({"part": [part], "number": [number], "n": [len(y)], "bins": [bins.tobytes()], "y": [y.astype(np.uint16).tobytes()]},
                                   schema=pa.schema([("part", pa.int64()), ("number", pa.int64()), ("n", pa.int64()), ("bins", pa.binary()), ("y", pa.binary())]))

        for batch in batches:
            if batch.num_rows:
                x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
                held.append((x, batch.column("y").to_numpy(zero_copy_only=False)))
            if sum(len(y) for _, y in held) >= block:
                yield flush()
                number, held = number + 1, []
        if held:
            yield flush()

    return data.mapInArrow(cut, "part bigint, number bigint, n bigint, bins binary, y binary")


def _counts(blocks: DataFrame, trees: dict, offsets: np.ndarray, classes: int, seed: int) -> DataFrame:
    """Class counts per tree: by feature, open node, bin and class.  ``trees`` has the
    leaf bits, the number of open nodes (bits 0, 1, ...) and the features they ask for."""
    widths = np.diff(offsets) * classes

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []
        for batch in batches:
            for part, number, n, bins, y in zip(*(batch.column(c).to_pylist() for c in ("part", "number", "n", "bins", "y")), strict=True):
                bins = np.frombuffer(bins, np.uint16).reshape(-1, n).astype(np.intp)
                held.append((part, number, bins * classes + np.frombuffer(y, np.uint16)))
        rooms = {n: _Room(n) for n in {codes.shape[1] for _, _, codes in held}}

        for some in batched(trees if held else (), TREES):  # a block is read once for so many trees
            work = []
            for t in some:
                bits, opened, asked = trees[t]
                slot = np.full(MAX_LEAVES, opened, np.intp)  # closed leaves count in a last slot that is dropped
                slot[_PLACES[:opened]] = np.arange(opened)
                work.append((t, _by_feature(bits, offsets, classes), slot, {f: np.zeros((opened + 1) * widths[f]) for f in asked}))
            for part, number, codes in held:
                room = rooms[codes.shape[1]]
                for t, bits, slot, found in work:
                    room.weights[:] = bootstrap_counts([seed, part, number, t], codes.shape[1])
                    slot.take(_leaves(bits, codes, room), out=room.at, mode="clip")
                    for f, sums in found.items():
                        np.multiply(room.at, widths[f], out=room.place)
                        room.place += codes[f]
                        sums += np.bincount(room.place, room.weights, len(sums))
            out = [np.concatenate([sums[:-widths[f]] for f, sums in found.items()]).astype(np.int32).tobytes() for *_, found in work]
            yield pa.record_batch({"tree": pa.array(some, pa.int32()), "counts": pa.array(out, pa.binary())})

    return blocks.mapInArrow(count, "tree int, counts binary")


def _candidates(h: np.ndarray, categories: int | None, subsets: int) -> tuple[np.ndarray, list]:
    """Class counts of the left side of every candidate split, and the bins on it."""
    if categories is not None and categories <= subsets:  # few categories, many classes: every subset
        left = [s for k in range(1, categories // 2 + 1) for s in combinations(range(categories), k) if 2 * k < categories or 0 in s]
        return np.array([h[list(s)].sum(axis=0) for s in left]).reshape(-1, h.shape[1]), left
    order = np.arange(len(h))
    if categories is not None:
        n = h.sum(axis=1)
        centre = gini(h) if h.shape[1] > 2 else h[:, -1] / np.maximum(n, 1)
        order = np.argsort(np.where(n > 0, centre, np.inf), kind="stable")
    return np.cumsum(h[order], axis=0)[:-1], [order[:k + 1] for k in range(len(h) - 1)]


def _best_splits(counts: DataFrame, trees: dict, offsets: np.ndarray, arity: dict, classes: int, subsets: int, least: int, least_gain: float) -> DataFrame:
    """The split of every open node; feature -1 where none gains.  ``trees`` has the open
    nodes with their features, and the features of any of them."""
    widths = np.diff(offsets)

    def best(table: pa.Table) -> pa.Table:
        t = table["tree"][0].as_py()
        nodes, asked = trees[t]
        total = sum(np.frombuffer(b.as_buffer(), np.int32).astype(np.int64) for b in table["counts"])
        cuts = np.cumsum([len(nodes) * widths[f] * classes for f in asked])[:-1]
        found = {f: part.reshape(len(nodes), widths[f], classes) for f, part in zip(asked, np.split(total, cuts), strict=True)}
        out = []
        for k, (node, features) in enumerate(nodes):
            own = found[features[0]][k].sum(axis=0)
            row = {"tree": t, "node": node, "feature": -1, "gain": 0.0, "goes_left": [], "own": own.tolist(), "on_left": []}
            for f in features:
                left, sides = _candidates(found[f][k], arity.get(f), subsets)
                if not len(left):
                    continue
                right = own - left
                n, r = left.sum(axis=1), right.sum(axis=1)
                gain = gini(own) - n / max(n[0] + r[0], 1) * gini(left) - r / max(n[0] + r[0], 1) * gini(right)
                gain[(n < least) | (r < least) | (gain < least_gain)] = -1.0
                i = int(gain.argmax())
                if gain[i] > row["gain"]:
                    row |= {"feature": f, "gain": float(gain[i]), "goes_left": [int(b) for b in sides[i]], "on_left": left[i].tolist()}
            out.append(row)
        types = {"tree": pa.int32(), "node": pa.int32(), "feature": pa.int32(), "gain": pa.float64(), "goes_left": pa.list_(pa.int32()), "own": pa.list_(pa.int64()), "on_left": pa.list_(pa.int64())}
        return pa.Table.from_pylist(out, schema=pa.schema(list(types.items())))

    return counts.groupBy("tree").applyInArrow(best, _SPLITS)


def _model_rows(tree: int, nodes: dict, edges: dict, arity: dict) -> list[tuple]:
    """A grown tree as the rows of Spark's saved forest: numbered from the root, left before
    right, siblings that predict the same merged.  ``nodes``: (counts, split or None) by place."""
    def merged(place: int):
        counts, split = nodes[place]
        if split is None:
            return counts, None
        left, right = merged(2 * place), merged(2 * place + 1)
        if left[1] is None and right[1] is None and np.argmax(left[0]) == np.argmax(right[0]):
            return counts, None
        return counts, (*split, left, right)

    rows = []

    def number(node) -> int:
        counts, split = node
        i = len(rows)
        rows.append(None)
        data = (i, float(np.argmax(counts)), float(gini(counts)), [float(c) for c in counts], int(counts.sum()))
        if split is None:
            rows[i] = (tree, (*data, -1.0, -1, -1, (-1, [], -1)))
        else:
            f, gain, goes_left, left, right = split
            at = [float(b) for b in goes_left] if f in arity else [float(edges[f][max(goes_left)])]
            rows[i] = (tree, (*data, gain, number(left), number(right), (f, at, arity.get(f, -1))))
        return i

    number(merged(1))
    return rows


class ManyTreesClassifier(RandomForestClassifier):
    """Spark's random forest; forests of many (row, tree) pairs are grown by blocks of rows."""

    def _by_blocks(self) -> bool:
        return (self.getMaxDepth() <= 5 and self.getNumTrees() > 1 and self.getImpurity() == "gini" and self.getBootstrap()
                and self.getSubsamplingRate() == 1.0 and self.getMinWeightFractionPerNode() == 0.0 and self.getMaxBins() < 65536
                and self.getFeatureSubsetStrategy() in ("auto", "sqrt") and not self.isSet(self.weightCol) and not self.isSet(self.thresholds))

    def _fit(self, dataset: DataFrame):
        if not self._by_blocks():
            return super()._fit(dataset)
        rows = bounded_rows(dataset.agg(F.count(F.lit(1)).alias("n")), 1)[0]["n"]
        if rows * self.getNumTrees() < MIN_PAIRS:
            return super()._fit(dataset)
        attrs = dataset.schema[self.getFeaturesCol()].metadata.get("ml_attr", {})
        nominal = attrs.get("attrs", {}).get("nominal", []) + attrs.get("attrs", {}).get("binary", [])
        arity = {a["idx"]: len(a["vals"]) if "vals" in a else a.get("num_vals", 2) for a in nominal}
        arity = {f: n for f, n in arity.items() if n > 1}
        if max(arity.values(), default=0) > self.getMaxBins():  # Spark's error
            return super()._fit(dataset)
        return self._copyValues(self._grown(dataset, rows, arity))

    def _grown(self, dataset: DataFrame, rows: int, arity: dict) -> RandomForestClassificationModel:
        spark, seed = dataset.sparkSession, self.getSeed() % 2 ** 63
        ship_package(spark)
        label = self.getLabelCol()
        names = dataset.schema[label].metadata.get("ml_attr", {}).get("vals")
        data = dataset.select(vector_to_array(self.getFeaturesCol()).alias("x"), F.col(label).cast("double").alias("y"))
        sizes = bounded_rows(data.agg(F.max(F.size("x")).alias("width"), F.max("y").alias("label")), 1)[0]
        width, classes = sizes["width"], max(2, len(names) if names is not None else int(sizes["label"]) + 1)
        bins = min(self.getMaxBins(), rows)
        edges = thresholds(data, rows, [f for f in range(width) if f not in arity], bins, seed % 2 ** 31)
        offsets = np.cumsum([0, *(arity[f] if f in arity else len(edges[f]) + 1 for f in range(width))])
        subsets = int(math.log2(bins // 2 + 1) + 1) if classes > 2 else 0
        chosen = math.ceil(math.sqrt(width))

        # the blocks are written once: every pass draws the same counts for the same rows
        path = scratch_path(spark, "forest-rows")
        _blocks(data, edges, arity, classes, max(BLOCK, int(offsets[-1]) * classes)).write.parquet(path)
        tasks = max(4 * spark.sparkContext.defaultParallelism, -(-rows // TASK_ROWS))
        blocks = spark.read.parquet(path).repartition(tasks).persist(StorageLevel.MEMORY_AND_DISK)

        trees = {t: {} for t in range(self.getNumTrees())}  # by place: root 1, children 2i and 2i + 1
        opened = {t: [1] for t in trees}
        for depth in range(self.getMaxDepth()):
            work, ask = {}, {}
            for t, places in opened.items():
                pick = [(p, [int(f) for f in np.random.Generator(np.random.SFC64([seed, t, p])).permutation(width)[:chosen]]) for p in places]
                inner = {p: (s[0], np.isin(np.arange(offsets[s[0] + 1] - offsets[s[0]]), s[2]), 2 * p, 2 * p + 1) for p, (_, s) in trees[t].items() if s}
                closed = [p for p, (_, s) in trees[t].items() if not s and p not in places]
                asked = sorted({f for _, fs in pick for f in fs})
                work[t] = (_leaf_bits(inner, 1, offsets, {p: i for i, p in enumerate([*places, *closed])}), len(places), asked)
                ask[t] = (pick, asked)
            if not work:
                break
            found = _best_splits(_counts(blocks, work, offsets, classes, seed), ask, offsets, arity, classes, subsets,
                                 self.getMinInstancesPerNode(), self.getMinInfoGain())
            most, opened = sum(map(len, opened.values())), {}
            for r in bounded_rows(found, most):  # one row an open node
                t, p, own = r["tree"], r["node"], np.array(r["own"])
                if r["feature"] < 0:
                    trees[t][p] = (own, None)
                    continue
                trees[t][p] = (own, (r["feature"], r["gain"], r["goes_left"]))
                left = np.array(r["on_left"])
                for child, counts in ((2 * p, left), (2 * p + 1, own - left)):
                    trees[t][child] = (counts, None)
                    if depth + 1 < self.getMaxDepth() and gini(counts) >= 2.220446049250313e-16:
                        opened.setdefault(t, []).append(child)
        blocks.unpersist()
        return self._loaded(spark, [row for t, nodes in trees.items() for row in _model_rows(t, nodes, edges, arity)], width, classes)

    def _loaded(self, spark, rows: list[tuple], width: int, classes: int) -> RandomForestClassificationModel:
        """The grown forest, by way of the files of Spark's model format."""
        def described(kind: str, uid: str, skip: tuple = (), **more) -> str:
            own, defaults = ({p.name: v for p, v in m.items() if p.name not in skip} for m in (self._paramMap, self._defaultParamMap))
            return json.dumps({"class": _CLASS.format(kind), "timestamp": int(time.time() * 1000), "sparkVersion": spark.version,
                               "uid": uid, "paramMap": own, "defaultParamMap": defaults, **more})

        path = scratch_path(spark, "forest")
        forest_only = ("numTrees", "featureSubsetStrategy", "subsamplingRate", "bootstrap")
        head = described("RandomForestClassificationModel", self.uid, numFeatures=width, numClasses=classes, numTrees=self.getNumTrees())
        spark.createDataFrame([(head,)], "value string").coalesce(1).write.text(f"{path}/metadata")
        spark.createDataFrame([(t, described("DecisionTreeClassificationModel", f"{self.uid}_{t}", forest_only), 1.0) for t in range(self.getNumTrees())],
                              "_1 int, _2 string, _3 double").coalesce(1).write.parquet(f"{path}/treesMetadata")
        spark.createDataFrame(rows, _NODES).coalesce(1).write.parquet(f"{path}/data")
        return RandomForestClassificationModel.load(path)


# --- scoring -----------------------------------------------------------------

def forest_tables(model: RandomForestClassificationModel, spark) -> tuple | None:
    """What scoring by leaf bits needs, from the model's saved nodes; None for forests of
    few trees, or with a tree of more leaves than there are bits."""
    nodes = model.totalNumNodes
    if model.getNumTrees < MIN_TREES or nodes > model.getNumTrees * (2 * MAX_LEAVES - 1) or any(w != 1.0 for w in model.treeWeights):
        return None
    path = scratch_path(spark, "forest")
    model.write().save(path)
    trees: dict[int, dict] = {}
    for r in bounded_rows(spark.read.parquet(f"{path}/data"), nodes):
        trees.setdefault(r["treeID"], {})[r["nodeData"]["id"]] = r["nodeData"]
    if max(sum(n["leftChild"] < 0 for n in t.values()) for t in trees.values()) > MAX_LEAVES:
        return None
    at: dict[int, set] = {}
    arity: dict[int, int] = {}
    for n in (n for t in trees.values() for n in t.values() if n["leftChild"] >= 0):
        s = n["split"]
        if s["numCategories"] >= 0:
            arity[s["featureIndex"]] = s["numCategories"]
        else:
            at.setdefault(s["featureIndex"], set()).update(s["leftCategoriesOrThreshold"])
    edges = {f: np.array(sorted(v)) for f, v in at.items()}
    # a categorical feature has a last bin for whatever is no category
    offsets = np.cumsum([0, *(arity[f] + 1 if f in arity else len(edges.get(f, ())) + 1 for f in range(model.numFeatures))])
    bits, shares = [], []
    for _, nodes in sorted(trees.items()):
        splits, leaves, votes = {}, {}, np.zeros((MAX_LEAVES, model.numClasses))
        for i, n in nodes.items():
            if n["leftChild"] < 0:
                leaves[i] = len(leaves)
                counts = np.array(n["impurityStats"])
                votes[_PLACES[leaves[i]]] = counts / counts.sum() if counts.sum() else 0.0
                continue
            f, values = n["split"]["featureIndex"], n["split"]["leftCategoriesOrThreshold"]
            if f in arity:  # Spark keeps the smaller side's categories and sends any other value to the larger
                goes_left = np.isin(np.arange(arity[f] + 1), np.array(values, int))
                goes_left[-1] = len(values) > arity[f] // 2
            else:
                goes_left = np.arange(len(edges[f]) + 1) <= np.searchsorted(edges[f], values[0])
            splits[i] = (f, goes_left, n["leftChild"], n["rightChild"])
        bits.append(_leaf_bits(splits, 0, offsets, leaves))
        shares.append(votes)
    return edges, arity, offsets, bits, shares


def with_forest_prediction(df: DataFrame, features: str, prediction: str, tables: tuple) -> DataFrame:
    """``df`` with the class of most votes, the first of equal ones, as the model gives it:
    each tree's leaf adds its class shares, tree after tree."""
    ship_package(df.sparkSession)
    edges, arity, offsets, bits, shares = tables

    @F.arrow_udf("double")
    def best(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        by_feature = [_by_feature(b, offsets) for b in bits]
        for batch in batches:
            x = batch.flatten().to_numpy(zero_copy_only=False).reshape(len(batch), -1)
            codes = []
            for f in range(len(offsets) - 1):
                v = x[:, f]
                if f in arity:
                    known = (v >= 0) & (v < arity[f]) & (v == np.floor(v))
                    codes.append(np.where(known, v, arity[f]).astype(np.intp))
                else:
                    codes.append(np.searchsorted(edges[f], v, side="left") if f in edges else np.zeros(len(v), np.intp))
            room, votes = _Room(len(batch)), np.zeros((len(batch), shares[0].shape[1]))
            one = np.empty_like(votes)
            for b, s in zip(by_feature, shares, strict=True):
                votes += s.take(_leaves(b, codes, room), axis=0, out=one, mode="clip")
            yield pa.array(votes.argmax(axis=1).astype(float))

    return df.withColumn(prediction, best(vector_to_array(features)))


def predicted(stages: list, spark):
    """A function that runs the fitted stages over a frame; forests of many shallow trees
    give their prediction by leaf bits, without the columns of votes and probabilities."""
    def only_texts_after(k: int) -> bool:  # a later stage may ask for votes or probabilities
        return all(isinstance(s, IndexToString) for s in stages[k + 1:])

    tables = [forest_tables(s, spark) if isinstance(s, RandomForestClassificationModel) and not s.isSet(s.thresholds) and only_texts_after(k)
              else None for k, s in enumerate(stages)]

    def run(df: DataFrame) -> DataFrame:
        for stage, table in zip(stages, tables, strict=True):
            df = stage.transform(df) if table is None else with_forest_prediction(df, stage.getFeaturesCol(), stage.getPredictionCol(), table)
        return df

    return run

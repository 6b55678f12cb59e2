"""Boosted trees by second-order gain over histograms (Chen and Guestrin, 2016; Ke et al., 2017).

Features are cut into bins once. A round fits one tree to the gradients and hessians of the rows
so far: tasks add both up by (node, feature, bin), one aggregate sums the tasks' histograms for
all nodes that are waiting, and the driver, which only sees histograms, picks the splits. Trees
grow by the best leaf, level by level, or symmetrically with one split for a whole level.
Best-leaf growth looks ahead: it splits what the present histograms favour and asks for all new
children at once, until the order of splits that strict best-first growth would take is known.

Gradients are whole multiples of a unit, so sums do not depend on their order: a frame boosted
over many tasks and the same one in a single task give the same trees, to the bit.
"""

import json
import sys
from collections.abc import Callable, Iterator
from dataclasses import asdict, dataclass, field, fields

import numpy as np
import pandas as pd
from pyspark import cloudpickle, keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasSeed, HasWeightCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyloom import constants as C
from skyloom.operators.drift import quantile_edges
from skyloom.sources.lake import staged

# Executors get this module's functions with the task, not from an installed package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

SCALE = 1 << 20
#: Frames up to this many binned values are boosted in one task.
TASK_CELLS = 4_000_000
#: Rounds whose trees are applied again in each pass before scores are stored.
KEPT_TREES = 10
#: Nodes of one feature whose histograms meet in one group.
GROUP_NODES = 16
#: Rows stored together as one block of bytes: passing rows one by one to Python takes longer than counting them.
BLOCK_ROWS = 1 << 16


@dataclass(frozen=True)
class Settings:
    """``kind`` is logistic or squared, ``growth`` leaf, level or symmetric. ``rows`` and
    ``features`` are the shares a round draws; ``temperature`` weights rows at random (Bayesian
    bootstrap); ``positive`` weights label 1."""

    kind: str = "logistic"
    growth: str = "leaf"
    rounds: int = 20
    rate: float = 0.1
    depth: int = 6
    leaves: int = 31
    bins: int = 64
    min_rows: int = 1
    min_hessian: float = 1e-3
    l2: float = 1.0
    l1: float = 0.0
    gamma: float = 0.0
    rows: float = 1.0
    features: float = 1.0
    temperature: float = 0.0
    positive: float = 1.0
    seed: int = C.SEED


@dataclass
class Tree:
    """Nodes as parallel lists; a leaf has feature -1. Rows whose bin of ``feature`` is ``bin`` or
    less go left. ``value`` is what a leaf adds, ``cover`` the rows that reached a node."""

    feature: list = field(default_factory=list)
    bin: list = field(default_factory=list)
    left: list = field(default_factory=list)
    right: list = field(default_factory=list)
    value: list = field(default_factory=list)
    cover: list = field(default_factory=list)
    gain: list = field(default_factory=list)

    def add(self, value: float = 0.0, cover: int = 0) -> int:
        for name, start in (("feature", -1), ("bin", 0), ("left", 0), ("right", 0), ("value", value), ("cover", cover), ("gain", 0.0)):
            getattr(self, name).append(start)
        return len(self.feature) - 1

    def split(self, node: int, feature: int, bin: int, gain: float) -> tuple[int, int]:
        self.feature[node], self.bin[node], self.gain[node] = feature, bin, gain
        self.left[node], self.right[node] = self.add(), self.add()
        return self.left[node], self.right[node]


def leaf_of(tree: Tree, x: np.ndarray) -> np.ndarray:
    """Node each column of bins ``x`` (features x rows) ends in. Rows are dealt down the tree, so a
    row costs one comparison a level."""
    out = np.zeros(x.shape[1], np.int64)
    held = [(0, np.arange(x.shape[1]))]
    while held:
        node, rows = held.pop()
        if tree.feature[node] < 0:
            out[rows] = node
        elif len(rows):
            lower = x[tree.feature[node]].take(rows) <= tree.bin[node]
            held += [(tree.left[node], rows[lower]), (tree.right[node], rows[~lower])]
    return out


def bins_of(x: np.ndarray, edges: list[list[float]]) -> np.ndarray:
    """Bins (features x rows) of values (rows x features): 0 for missing, else one more than the
    number of edges below the value."""
    out = np.empty(x.T.shape, np.int16)
    for j, cuts in enumerate(edges):
        column = x[:, j]
        out[j] = np.where(np.isnan(column), 0, np.searchsorted(np.array(cuts), column, side="left") + 1)
    return out


def draw(keys: np.ndarray, salt: int) -> np.ndarray:
    """A number in (0, 1) for each 64-bit key."""
    z = keys.view(np.uint64) + np.uint64((salt * 0x9E3779B97F4A7C15) & (2**64 - 1))
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return ((z ^ (z >> np.uint64(31))) >> np.uint64(11)).astype(float) * 2.0**-53 + 2.0**-54


def gradients(raw, y, w, keys, settings: Settings, round: int, unit: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First and second derivatives as multiples of unit / SCALE and 1 / SCALE, and whether the
    row is drawn in this round."""
    drawn = np.ones(len(raw), bool)
    if settings.rows < 1:
        drawn = draw(keys, 2 * round + settings.seed) < settings.rows
    if settings.temperature > 0:
        w = w * (-np.log(draw(keys, 2 * round + 1 + settings.seed))) ** settings.temperature
    if settings.kind == "logistic":
        w = np.where(y > 0.5, w * settings.positive, w)
        p = 1.0 / (1.0 + np.exp(-raw))
        g, h = (p - y) * w, p * (1.0 - p) * w
    else:
        g, h = (raw - y) * w, w
    return np.rint(g / unit * SCALE), np.rint(h * SCALE), drawn


def histograms(x, g, h, slot, slots: int, bins: int, features: list[int]) -> np.ndarray:
    """Sums of g, h and rows (features x 3 x slots x bins) of rows with a slot."""
    kept = np.flatnonzero(slot >= 0)
    x, g, h, slot = x[:, kept], g[kept], h[kept], slot[kept]
    out = np.empty((len(features), 3, slots, bins))
    for k, j in enumerate(features):
        place = slot * bins + x[j]
        for part, weights in enumerate((g, h, None)):
            out[k, part] = np.bincount(place, weights, slots * bins).reshape(slots, bins)
    return out


def soft(g, l1: float):
    return np.sign(g) * np.maximum(np.abs(g) - l1, 0.0)


def leaf_value(g: float, h: float, settings: Settings) -> float:
    return float(-soft(g, settings.l1) / (h + settings.l2) * settings.rate) if h + settings.l2 > 0 else 0.0


def gains(hist: np.ndarray, settings: Settings, unit: float) -> tuple[np.ndarray, np.ndarray]:
    """Gain (slots x features x cuts; -inf where a side is too small) and the left sums (slots x
    features x 3 x cuts) of histograms (features x 3 x slots x bins)."""
    left = hist.cumsum(axis=3).transpose(2, 0, 1, 3)
    total, left = left[..., -1:], left[..., :-1]
    right = total - left

    def score(sums):
        weight = sums[:, :, 1] / SCALE + settings.l2
        g = soft(sums[:, :, 0] / SCALE * unit, settings.l1)
        return np.divide(g * g, weight, out=np.zeros_like(g), where=weight > 0)

    gain = 0.5 * (score(left) + score(right) - score(total)) - settings.gamma
    small = [(s[:, :, 2] < settings.min_rows) | (s[:, :, 1] / SCALE < settings.min_hessian) for s in (left, right)]
    gain[small[0] | small[1]] = -np.inf
    return gain, left


def grown(evaluate: Callable, settings: Settings, features: list[int], unit: float) -> Tree:
    """A tree from ``evaluate(tree, nodes)``: histograms (features x 3 x nodes x bins)."""
    tree = Tree()
    tree.add()
    sums, path, depth, best = {}, {0: 1}, {0: 0}, {}
    waiting = [0]

    def value(node):
        g, h, _ = sums[node]
        return leaf_value(g / SCALE * unit, h / SCALE, settings)

    def put(node, feature, bin, gain, left):
        a, b = tree.split(node, feature, bin, gain)
        sums[a], sums[b] = left, tuple(t - s for t, s in zip(sums[node], left))
        for child, step in ((a, 0), (b, 1)):
            path[child], depth[child] = 2 * path[node] + step, depth[node] + 1
        return [a, b]

    def order() -> list[int]:
        """Nodes to split: the best leaf first while there may be more leaves, or all."""
        chosen, open_ = [], [0]
        while open_ and (settings.growth != "leaf" or len(chosen) < settings.leaves - 1):
            open_ = [n for n in open_ if n in best and best[n][0] > 0]
            if not open_:
                break
            node = min(open_, key=lambda n: (-best[n][0], path[n]))
            open_.remove(node)
            chosen.append(node)
            if tree.feature[node] >= 0:
                open_ += [tree.left[node], tree.right[node]]
        return chosen

    chosen = []
    while waiting:
        hist = evaluate(tree, waiting)
        if 0 not in sums:
            sums[0] = tuple(hist[0, :, 0].sum(axis=1).tolist())
        gain, left = gains(hist, settings, unit)
        cuts, fresh = gain.shape[2], []
        if settings.growth == "symmetric":
            total = np.where(np.isfinite(gain), gain, 0.0).sum(axis=0).ravel()
            at = int(total.argmax())
            if total[at] <= 0:
                break
            for k, node in enumerate(waiting):
                f, cut = divmod(at, cuts)
                fresh += put(node, features[f], cut, max(0.0, float(gain[k, f, cut])), tuple(left[k, f, :, cut].tolist()))
        else:
            for k, node in enumerate(waiting):
                f, cut = divmod(int(gain[k].argmax()), cuts)
                best[node] = float(gain[k, f, cut]), features[f], cut, tuple(left[k, f, :, cut].tolist())
            chosen = order()
            for node in chosen:
                if tree.feature[node] < 0:
                    fresh += put(node, *best[node][1:3], best[node][0], best[node][3])
        waiting = [n for n in fresh if depth[n] < settings.depth]
    if settings.growth == "symmetric":
        chosen = [n for n in range(len(tree.feature)) if tree.feature[n] >= 0]
    return pruned(tree, set(chosen), {n: (value(n), int(sums[n][2])) for n in sums})


def pruned(tree: Tree, chosen: set[int], ends: dict) -> Tree:
    """Only the ``chosen`` splits, with values and covers."""
    out = Tree()

    def copy(node: int) -> int:
        value, cover = ends[node]
        own = out.add(value, cover)
        if node in chosen:
            out.feature[own], out.bin[own], out.gain[own] = tree.feature[node], tree.bin[node], tree.gain[node]
            out.left[own] = copy(tree.left[node])
            out.right[own] = copy(tree.right[node])
        return own

    copy(0)
    return out


def drawn_features(settings: Settings, count: int, round: int) -> list[int]:
    many = max(1, int(np.ceil(settings.features * count)))
    return sorted(np.random.default_rng([settings.seed, round]).permutation(count)[:many].tolist())


def boosted(x: np.ndarray, y, w, keys, settings: Settings, base: float, unit: float, bins: int) -> list[Tree]:
    """All rounds over binned rows in memory."""
    raw, trees = np.full(len(y), base), []
    for round in range(settings.rounds):
        g, h, drawn = gradients(raw, y, w, keys, settings, round, unit)
        features = drawn_features(settings, len(x), round)

        def evaluate(tree, nodes):
            slot = slots_of(tree, nodes)[leaf_of(tree, x)]
            return histograms(x, g, h, np.where(drawn, slot, -1), len(nodes), bins, features)

        trees.append(grown(evaluate, settings, features, unit))
        raw = raw + np.array(trees[-1].value)[leaf_of(trees[-1], x)]
    return trees


def slots_of(tree: Tree, nodes: list[int]) -> np.ndarray:
    out = np.full(len(tree.feature), -1)
    out[nodes] = np.arange(len(nodes))
    return out


#: A block of rows: bins (features x rows, 16 bits), label, weight, key and, once trees were applied, score.
KINDS = {"x": np.int16, "y": np.float64, "w": np.float64, "k": np.int64, "raw": np.float64}
BLOCKS = "x binary, y binary, w binary, k binary, raw binary"


def blocks(batches: Iterator[pd.DataFrame], edges: list[list[float]]) -> Iterator[pd.DataFrame]:
    """Rows (x, y, w, k) with their bins, BLOCK_ROWS or a few more at a time; without score yet."""
    held, size = [], 0

    def block() -> pd.DataFrame:
        x, *rest = (np.concatenate(parts, axis=-1) for parts in zip(*held))
        held.clear()
        return pd.DataFrame([(x.tobytes(), *(r.tobytes() for r in rest), None)], columns=list(KINDS))

    for batch in batches:
        x = np.array([np.asarray(v, float) for v in batch["x"]]).reshape(-1, len(edges))
        held.append((bins_of(x, edges), *(batch[c].to_numpy(KINDS[c]) for c in "ywk")))
        size += len(batch)
        if size >= BLOCK_ROWS:
            yield block()
            size = 0
    if size:
        yield block()


def opened(batch: pd.DataFrame, count: int, base: float) -> Iterator[dict[str, np.ndarray]]:
    """Columns of each block; the score is ``base`` where there is none."""
    for values in zip(*(batch[c] for c in KINDS)):
        out = {c: np.frombuffer(v, KINDS[c]) for c, v in zip(KINDS, values) if v is not None}
        out["x"] = out["x"].reshape(count, -1)
        yield {"raw": np.full(len(out["y"]), base)} | out


def spread(rows: DataFrame, count: int, settings: Settings, base: float, unit: float, bins: int) -> list[Tree]:
    """All rounds over stored blocks, one aggregate for each set of nodes that wait."""
    trees, kept = [], []

    def scores(block, kept):
        raw = block["raw"]
        for tree in kept:
            raw = raw + np.array(tree.value)[leaf_of(tree, block["x"])]
        return raw

    for round in range(settings.rounds):
        features = drawn_features(settings, count, round)
        before = list(kept)

        def evaluate(tree, nodes):
            slots = slots_of(tree, nodes)
            groups = [range(a, min(a + GROUP_NODES, len(nodes))) for a in range(0, len(nodes), GROUP_NODES)]

            def task(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
                total = 0.0
                for block in (block for batch in batches for block in opened(batch, count, base)):
                    x, raw = block["x"], scores(block, before)
                    g, h, drawn = gradients(raw, *(block[c] for c in "ywk"), settings, round, unit)
                    slot = np.where(drawn, slots[leaf_of(tree, x)], -1)
                    total = total + histograms(x, g, h, slot, len(nodes), bins, features)
                if isinstance(total, np.ndarray):
                    out = [
                        (f, i, total[f][:, group].astype("<i8").tobytes())
                        for f in range(len(features)) for i, group in enumerate(groups)
                    ]
                    yield pd.DataFrame(out, columns=["f", "part", "sums"])

            def merge(part: pd.DataFrame) -> pd.DataFrame:
                sums = np.sum([np.frombuffer(s, "<i8") for s in part["sums"]], axis=0)
                return part[["f", "part"]].iloc[:1].assign(sums=[sums.astype("<i8").tobytes()])

            schema = "f int, part int, sums binary"
            out = np.zeros((len(features), 3, len(nodes), bins))
            for row in rows.mapInPandas(task, schema).groupBy("f", "part").applyInPandas(merge, schema).collect():
                group = groups[row.part]
                out[row.f][:, group] = np.frombuffer(row.sums, "<i8").reshape(3, len(group), bins)
            return out

        trees.append(grown(evaluate, settings, features, unit))
        kept.append(trees[-1])
        if len(kept) == KEPT_TREES and round + 1 < settings.rounds:
            done = list(kept)

            def advance(batches: Iterator[pd.DataFrame], done=done) -> Iterator[pd.DataFrame]:
                for batch in batches:
                    yield batch.assign(raw=[scores(block, done).tobytes() for block in opened(batch, count, base)])

            rows, kept = staged(rows.mapInPandas(advance, BLOCKS), "boosted_rows"), []
    return trees


@dataclass
class Ensemble:
    """Trees over thresholds: a value above the threshold goes right, missing values left."""

    settings: Settings
    edges: list[list[float]]
    base: float
    trees: list[Tree]

    def raw(self, x: np.ndarray) -> np.ndarray:
        bins = bins_of(x, self.edges)
        out = np.full(len(x), self.base)
        for tree in self.trees:
            out = out + np.array(tree.value)[leaf_of(tree, bins)]
        return out

    def importances(self) -> np.ndarray:
        """Share of the gain by feature."""
        out = np.zeros(len(self.edges))
        for tree in self.trees:
            for f, gain in zip(tree.feature, tree.gain):
                if f >= 0:
                    out[f] += gain
        return out / out.sum() if out.sum() > 0 else out

    def dumps(self) -> str:
        return json.dumps({"settings": asdict(self.settings), "edges": self.edges, "base": self.base, "trees": [asdict(t) for t in self.trees]})

    @staticmethod
    def loads(text: str) -> "Ensemble":
        d = json.loads(text)
        return Ensemble(Settings(**d["settings"]), d["edges"], d["base"], [Tree(**t) for t in d["trees"]])


def start(rows: DataFrame, settings: Settings) -> tuple[float, float]:
    """The score before the first tree and the unit of gradients, a power of two."""
    if settings.kind == "logistic":
        weight = F.col("w") * F.when(F.col("y") > 0.5, settings.positive).otherwise(1.0)
        found = rows.agg(F.sum(F.when(F.col("y") > 0.5, weight)).alias("a"), F.sum(weight).alias("b"), F.max("w").alias("most")).first()
        share = min(max((found.a or 0.0) / found.b, 1e-9), 1 - 1e-9)
        most = found.most * settings.positive
        return round(float(np.log(share / (1 - share))), 9), float(2.0 ** np.ceil(np.log2(max(most, 1.0))))
    found = rows.agg((F.sum(F.col("y") * F.col("w")) / F.sum("w")).alias("mean"), F.min("y").alias("low"), F.max("y").alias("high"), F.max("w").alias("most")).first()
    base = round(float(found.mean), 9)
    most = max(abs(found.low - base), abs(found.high - base)) * found.most
    return base, float(2.0 ** np.ceil(np.log2(most))) if most > 0 else 1.0


def fit(df: DataFrame, settings: Settings, edges: list[list[float]] | None = None) -> Ensemble:
    """An ensemble over ``df``: ``x`` (array<double>; NaN and null are missing), ``y``, ``w``
    (weight) and ``k`` (a 64-bit number by which rows are drawn). ``edges`` are the cuts of each
    feature; by default quantiles. Rows without y or w do not count; none at all is an error."""
    df = staged(df.filter("y is not null and w > 0"), "boost_rows")
    extent = df.agg(F.count("*").alias("n"), F.max(F.size("x")).alias("features")).first()
    if not extent.n:
        raise ValueError("no rows to learn from")
    count = extent.features
    if edges is None:
        flat = df.select(*[F.col("x")[j].alias(f"x{j}") for j in range(count)])
        edges = list(quantile_edges(flat, flat.columns, settings.bins).values())
    bins = max(len(cuts) for cuts in edges) + 2
    plain = df.select("x", *[F.col(c).cast("long" if c == "k" else "double").alias(c) for c in "ywk"])
    rows = staged(plain.mapInPandas(lambda batches: blocks(batches, edges), BLOCKS), "boost_bins")
    base, unit = start(plain, settings)
    if extent.n * count > TASK_CELLS:
        return Ensemble(settings, edges, base, spread(rows, count, settings, base, unit, bins))

    def whole(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = [block for batch in batches for block in opened(batch, count, base)]
        trees = boosted(*(np.concatenate([block[c] for block in held], axis=-1) for c in "xywk"), settings, base, unit, bins)
        yield pd.DataFrame({"model": [Ensemble(settings, edges, base, trees).dumps()]})

    found = rows.coalesce(1).mapInPandas(whole, "model string").first()
    return Ensemble.loads(found.model)


def raw_scores(df: DataFrame, ensemble: Ensemble, vector: str, into: str) -> DataFrame:
    """``df`` plus ``into``: the sum of the trees for the array column ``vector``."""
    text = ensemble.dumps()

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = Ensemble.loads(text)
        for batch in batches:
            x = np.array([np.asarray(v, float) for v in batch]).reshape(len(batch), -1)
            yield pd.Series(own.raw(x)) if len(batch) else pd.Series([], dtype=float)

    return df.withColumn(into, score(F.col(vector)))


class _Boosting(HasFeaturesCol, HasLabelCol, HasWeightCol, HasSeed):
    growth = Param(Params._dummy(), "growth", "leaf, level or symmetric", TypeConverters.toString)
    maxIter = Param(Params._dummy(), "maxIter", "rounds", TypeConverters.toInt)
    stepSize = Param(Params._dummy(), "stepSize", "share of each tree that is added", TypeConverters.toFloat)
    maxDepth = Param(Params._dummy(), "maxDepth", "levels of splits", TypeConverters.toInt)
    maxLeaves = Param(Params._dummy(), "maxLeaves", "leaves of a best-first tree", TypeConverters.toInt)
    maxBins = Param(Params._dummy(), "maxBins", "bins of a feature", TypeConverters.toInt)
    minInstancesPerNode = Param(Params._dummy(), "minInstancesPerNode", "least rows of a node", TypeConverters.toInt)
    minChildWeight = Param(Params._dummy(), "minChildWeight", "least hessian of a node", TypeConverters.toFloat)
    regLambda = Param(Params._dummy(), "regLambda", "squared penalty of leaf values", TypeConverters.toFloat)
    regAlpha = Param(Params._dummy(), "regAlpha", "absolute penalty of leaf values", TypeConverters.toFloat)
    minSplitGain = Param(Params._dummy(), "minSplitGain", "gain that a split must exceed", TypeConverters.toFloat)
    subsamplingRate = Param(Params._dummy(), "subsamplingRate", "rows drawn in a round", TypeConverters.toFloat)
    featureRate = Param(Params._dummy(), "featureRate", "features drawn in a round", TypeConverters.toFloat)
    baggingTemperature = Param(Params._dummy(), "baggingTemperature", "spread of random row weights", TypeConverters.toFloat)
    positiveWeight = Param(Params._dummy(), "positiveWeight", "weight of label 1", TypeConverters.toFloat)


#: Param -> field of Settings.
FIELDS = {
    "growth": "growth", "maxIter": "rounds", "stepSize": "rate", "maxDepth": "depth", "maxLeaves": "leaves", "maxBins": "bins",
    "minInstancesPerNode": "min_rows", "minChildWeight": "min_hessian", "regLambda": "l2", "regAlpha": "l1", "minSplitGain": "gamma",
    "subsamplingRate": "rows", "featureRate": "features", "baggingTemperature": "temperature", "positiveWeight": "positive", "seed": "seed",
}


class HistogramBoosting(Estimator, _Boosting):
    """The estimator for pipelines; ``kind`` is set by the subclass."""

    kind = "squared"

    @keyword_only
    def __init__(self, *, featuresCol="features", labelCol="label", growth="leaf"):
        super().__init__()
        self._setDefault(**{p: f.default for p, name in FIELDS.items() for f in fields(Settings) if f.name == name})
        self._set(featuresCol=featuresCol, labelCol=labelCol, growth=growth)

    def setParams(self, **params):
        return self._set(**params)

    def setWeightCol(self, value):
        return self._set(weightCol=value)

    def _fit(self, dataset: DataFrame) -> "BoostedModel":
        weight = F.col(self.getWeightCol()) if self.isSet("weightCol") else F.lit(1.0)
        rows = dataset.select(
            vector_to_array(F.col(self.getFeaturesCol())).alias("x"),
            F.col(self.getLabelCol()).cast("double").alias("y"),
            weight.cast("double").alias("w"),
            F.xxhash64(*[c for c, kind in dataset.dtypes if kind != "vector"]).alias("k"),
        )
        settings = Settings(self.kind, **{name: self.getOrDefault(p) for p, name in FIELDS.items()})
        model = BoostedModel()._set(ensemble=fit(rows, settings).dumps(), featuresCol=self.getFeaturesCol())
        return model


class BoostedClassifier(HistogramBoosting):
    kind = "logistic"


class BoostedRegressor(HistogramBoosting):
    kind = "squared"


class BoostedModel(Model, HasFeaturesCol, DefaultParamsReadable, DefaultParamsWritable):
    """Adds ``probability`` (a classifier) or ``prediction``."""

    ensemble = Param(Params._dummy(), "ensemble", "the trees, as JSON", TypeConverters.toString)

    @property
    def trees(self) -> Ensemble:
        return Ensemble.loads(self.getOrDefault("ensemble"))

    @property
    def featureImportances(self):
        return Vectors.dense(self.trees.importances())

    def _transform(self, dataset: DataFrame) -> DataFrame:
        found = self.trees
        rows = dataset.withColumn("_x", vector_to_array(F.col(self.getFeaturesCol())))
        if found.settings.kind == "squared":
            return raw_scores(rows, found, "_x", "prediction").drop("_x")
        p = 1.0 / (1.0 + F.exp(-F.col("_raw")))
        rows = raw_scores(rows, found, "_x", "_raw")
        return rows.withColumn("probability", array_to_vector(F.array(1.0 - p, p))).drop("_x", "_raw")

"""The dashboard's three models on Spark."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, functions as F

from ..operators import ordered
from ..sources.staging import stage

# fixed values: model settings
CLUSTER_FEATURES = ("total_revenue", "total_orders", "days_since_last_order", "predicted_clv_2year")
CLUSTERS = 4
FOREST_FEATURES = ("quantity", "order_performance_score", "seasonal_avg_order_value")
FOREST_TREES = 100
FOREST_BINS = 32
TRAIN_SHARE = 0.8
OUTLIER_FEATURES = ("order_amount", "quantity", "order_performance_score")
OUTLIER_TREES = 100
OUTLIER_SAMPLE = 256
DEEPEST = 30  # the deepest tree that MLlib grows
CONTAMINATION = 0.1
SEED = 42


def _numbers(df: DataFrame, names) -> DataFrame:
    return df.select("*", *[F.col(c).cast("double").alias(f"__{c}") for c in names]).dropna(
        subset=[f"__{c}" for c in names]
    )


def _vectors(df: DataFrame, names) -> DataFrame:
    return VectorAssembler(inputCols=[f"__{c}" for c in names], outputCol="__features").transform(_numbers(df, names))


def customer_clusters(customers: DataFrame, k: int = CLUSTERS, seed: int = SEED) -> DataFrame:
    """Customers with their K-means cluster (unscaled features)."""
    data = _vectors(stage(customers, "customers"), CLUSTER_FEATURES)
    model = KMeans(k=k, seed=seed, featuresCol="__features", predictionCol="cluster").fit(data)
    return model.transform(data).drop("__features", *[f"__{c}" for c in CLUSTER_FEATURES])


def cluster_facts(customers: DataFrame, k: int = CLUSTERS, seed: int = SEED) -> DataFrame:
    """Customers in the fit, and those whose cluster is not that of the nearest centre (there should be none)."""
    data = _vectors(stage(customers, "customers"), CLUSTER_FEATURES)
    model = KMeans(k=k, seed=seed, featuresCol="__features", predictionCol="cluster").fit(data)
    far = [
        sum(((F.col(f"__{c}") - F.lit(float(x))) ** 2 for c, x in zip(CLUSTER_FEATURES, centre)), F.lit(0.0))
        for centre in model.clusterCenters()
    ]
    own = F.element_at(F.array(*far), F.col("cluster") + 1)
    # MLlib compares distances through an expanded square: allow its rounding
    misplaced = own > F.array_min(F.array(*far)) * (1 + 1e-6) + 1e-6
    return model.transform(data).agg(
        F.count(F.lit(1)).alias("customers"), F.count_if(misplaced).alias("misplaced"), F.count_if(F.col("cluster") >= k).alias("beyond_k"))


def train_split(df: DataFrame, key: str, seed: int = SEED) -> Column:
    """True for the training share of rows, drawn by a hash of the key and the seed."""
    cut = f"{round(TRAIN_SHARE * 16**4):04x}"
    return F.substring(F.md5(F.concat_ws("|", F.lit(str(seed)), F.coalesce(F.col(key), F.lit("")))), 1, 4) < cut


def _cuts(train: DataFrame, name: str, bins: int) -> list[float]:
    """Split points of a feature: between its values if they are few, else near-quantiles."""
    few = sorted(r[0] for r in train.select(name).distinct().limit(bins + 1).collect())
    if len(few) <= bins:
        return [(a + b) / 2 for a, b in zip(few, few[1:])]
    found = train.approxQuantile(name, [i / bins for i in range(1, bins)], 1 / (bins * 100))
    return sorted(set(found))


def _poisson(u: Column) -> Column:
    """Draw of a Poisson distribution with mean 1 from a uniform number."""
    below, term, draw = math.exp(-1), math.exp(-1), F.when(u < math.exp(-1), 0)
    for k in range(1, 12):
        term /= k
        below += term
        draw = draw.when(u < below, k)
    return draw.otherwise(12)


def _regression_tree(
    bins: np.ndarray, w: np.ndarray, s: np.ndarray, scored: np.ndarray, rng: np.random.Generator, depth: int, tried: int,
) -> tuple[np.ndarray, np.ndarray]:
    """Predictions for the ``scored`` cells, and the gain of each feature, of a tree grown on cells with weights and label sums."""
    gains, predicted = np.zeros(bins.shape[1]), np.zeros(len(scored))
    stack = [(np.arange(len(bins)), np.arange(len(scored)), 0)]
    while stack:
        at, to, level = stack.pop()
        n, total = w[at].sum(), s[at].sum()
        best = (0.0, -1, 0)
        if level < depth and len(at) > 1:
            for f in rng.permutation(bins.shape[1])[:tried]:
                wl = np.cumsum(np.bincount(bins[at, f], w[at], FOREST_BINS))[:-1]
                sl = np.cumsum(np.bincount(bins[at, f], s[at], FOREST_BINS))[:-1]
                wr = n - wl
                ok = (wl > 0) & (wr > 0)
                gain = np.where(ok, sl**2 / np.where(ok, wl, 1) + (total - sl) ** 2 / np.where(ok, wr, 1) - total**2 / n, 0.0)
                if gain.max(initial=0.0) > max(best[0], 1e-12 * (1 + total**2 / n)):
                    best = (float(gain.max()), int(f), int(gain.argmax()))
        gain, f, cut = best
        if f < 0:
            predicted[to] = total / n
            continue
        gains[f] += gain
        left, goes = bins[at, f] <= cut, scored[to, f] <= cut
        stack.append((at[~left], to[~goes], level + 1))
        stack.append((at[left], to[goes], level + 1))
    return predicted, gains


def revenue_forest(
    sales: DataFrame, key: str = "order_item_key", trees: int = FOREST_TREES, depth: int = DEEPEST, seed: int = SEED,
) -> DataFrame:
    """Feature importances with the fit's R² and RMSE on the held-out fifth, and the size of both parts.

    The split is by a hash of the row's key, so it does not change when a task is rerun.

    As in MLlib's forest, a feature has at most FOREST_BINS bins, every tree takes each row a Poisson number of times, a node tries a third
    of the features, and a split is the one that lowers the variance most.  A tree sees of the rows only the sums of each cell of bins, so
    one pass draws the rows for all trees (by a hash of the row and the tree) and adds them up by tree and cell; after it
    no step grows with the table.
    """
    used = sales.select(key, "order_amount", *FOREST_FEATURES)
    data = stage(_numbers(used, ("order_amount", *FOREST_FEATURES)).withColumn("__train", train_split(used, key, seed)), "forest")
    names = [f"__{c}" for c in FOREST_FEATURES]
    y, train = F.col("__order_amount"), data.filter("__train")
    cuts = [_cuts(train, name, FOREST_BINS) for name in names]
    cell = F.lit(0)
    for name, points in zip(names, cuts):
        cell = cell * FOREST_BINS + sum(((F.col(name) > p).cast("int") for p in points), F.lit(0))
    # labels around their mean: sums of squares lose no digits
    middle = train.agg(F.avg(y)).first()[0]
    if middle is None:
        raise ValueError("no rows to fit")
    row = F.xxhash64(F.lit(seed), key, y, *names)
    drawn = train.select(cell.alias("cell"), (y - F.lit(middle)).alias("y"), row.alias("row")).select(
        "cell", "y", "row", F.explode(F.sequence(F.lit(0), F.lit(trees - 1))).alias("tree"))
    # rows that a tree does not draw go before anything else is computed
    u = F.pmod(F.xxhash64("row", "tree"), F.lit(1 << 30)) / float(1 << 30)
    drawn = drawn.select("tree", "cell", "y", u.alias("u")).filter(F.col("u") >= math.exp(-1))
    drawn = drawn.select("tree", "cell", "y", _poisson(F.col("u")).alias("times"))
    grown_on = drawn.groupBy("tree", "cell").agg(F.sum("times").cast("double").alias("w"), F.sum(F.col("y") * F.col("times")).alias("s"))
    held = stage(data.filter("not __train").groupBy(cell.alias("cell")).agg(
        F.count(F.lit(1)).alias("n"), F.avg(y - F.lit(middle)).alias("mean"), F.var_pop(y).alias("spread")), "held_out")
    cells = np.array([r.cell for r in held.select("cell").collect()], int)  # at most FOREST_BINS ** 3
    tried = max(1, math.ceil(len(names) / 3))

    def digits(x: np.ndarray) -> np.ndarray:
        return np.column_stack([x // FOREST_BINS**i % FOREST_BINS for i in range(len(names) - 1, -1, -1)])

    def grow(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("cell")
        rng = np.random.default_rng([seed, int(pdf["tree"].iloc[0])])
        at = digits(pdf["cell"].to_numpy(int))
        predicted, gains = _regression_tree(at, pdf["w"].to_numpy(), pdf["s"].to_numpy(), digits(cells), rng, depth, tried)
        shares = gains / gains.sum() if gains.sum() > 0 else gains
        # a negative cell is a feature's share of the gain
        return pd.DataFrame({"cell": np.r_[cells, -1 - np.arange(len(shares))], "value": np.r_[predicted, shares]})

    found = stage(grown_on.groupBy("tree").applyInPandas(grow, "cell int, value double").groupBy("cell").agg(F.avg("value").alias("value")), "forest")
    shares = {r.cell: r.value for r in found.filter("cell < 0").collect()}
    n, mean = F.col("n"), F.col("mean")
    whole = held.agg(F.sum("n").alias("n"), F.try_divide(F.sum(n * mean), F.sum("n")).alias("mean")).first()
    off = held.join(found, "cell").agg(
        F.sum(n * (F.col("spread") + (mean - F.col("value")) ** 2)).alias("error"),
        F.sum(n * (F.col("spread") + (mean - F.lit(whole["mean"])) ** 2)).alias("total")).first()
    tested = whole["n"] or 0
    r2 = 1 - off["error"] / off["total"] if tested and off["total"] else math.nan
    rmse = math.sqrt(off["error"] / tested) if tested else math.nan
    sizes, all_shares = (train.count(), tested), sum(shares.values())
    rows = [(f, shares[-1 - i] / all_shares if all_shares else 0.0, r2, rmse, *sizes) for i, f in enumerate(FOREST_FEATURES)]
    return sales.sparkSession.createDataFrame(
        rows, "feature string, importance double, r2 double, rmse double, train_rows long, test_rows long")


def _path_adjustment(n: np.ndarray) -> np.ndarray:
    """Average path length of an unsuccessful search in a binary tree of n points."""
    n = np.asarray(n, float)
    big = np.maximum(n, 3)
    h = np.log(big - 1) + 0.5772156649015329
    return np.where(n <= 1, 0.0, np.where(n <= 2, 1.0, 2 * h - 2 * (big - 1) / big))


def _grow(x: np.ndarray, rng: np.random.Generator, max_depth: int) -> list[tuple]:
    """Isolation tree as rows (node, feature, cut, left, right, path); a leaf has feature -1."""
    nodes: list[list] = []
    stack = [(x, 0, -1, False)]
    while stack:
        part, depth, parent, is_right = stack.pop()
        at = len(nodes)
        if parent >= 0:
            nodes[parent][4 if is_right else 3] = at
        low, high = part.min(axis=0), part.max(axis=0)
        varied = np.flatnonzero(high > low)
        if depth >= max_depth or len(part) <= 1 or len(varied) == 0:
            nodes.append([at, -1, 0.0, -1, -1, float(depth + _path_adjustment(len(part)))])
            continue
        f = int(rng.choice(varied))
        cut = float(rng.uniform(low[f], high[f]))
        nodes.append([at, f, cut, -1, -1, 0.0])
        goes_left = part[:, f] <= cut
        stack.append((part[~goes_left], depth + 1, at, True))
        stack.append((part[goes_left], depth + 1, at, False))
    return [tuple(n) for n in nodes]


def _leaf_masks(
    feature: np.ndarray, cut: np.ndarray, left: np.ndarray, right: np.ndarray, path: np.ndarray, places: list[np.ndarray],
) -> tuple[list[np.ndarray], list[np.ndarray], np.ndarray]:
    """A tree as bits of its leaves, left to right: per feature the leaves that the row's cuts leave open, and the leaves' paths.

    A row beyond the cut of a node cannot end left of that node, so of the leaves that no node closes it ends in the first.  The first
    list leads from a place among all cuts of a feature (``places``) to one among the tree's own, the second from there to the open leaves.
    """
    leaves: list[int] = []
    under: dict[int, tuple[int, int]] = {}
    stack = [(0, False)]
    while stack:
        node, done = stack.pop()
        if feature[node] < 0:
            under[node] = (len(leaves), len(leaves) + 1)
            leaves.append(node)
        elif done:
            under[node] = (under[left[node]][0], under[right[node]][1])
        else:
            stack += [(node, True), (right[node], False), (left[node], False)]
    words = -(-len(leaves) // 64)
    own, masks = [], []
    for f, cuts in enumerate(places):
        nodes = np.flatnonzero(feature == f)
        nodes = nodes[np.argsort(cut[nodes], kind="stable")]
        mask = np.ones((len(nodes) + 1, words * 64), bool)
        for i, node in enumerate(nodes):
            mask[i + 1 :, slice(*under[left[node]])] = False
        # of place p the cuts before it are passed
        own.append(np.searchsorted(cut[nodes], np.append(-np.inf, cuts), side="right").astype(np.int32))
        masks.append(np.packbits(mask, axis=1, bitorder="little").view("<u8"))
    return own, masks, path[leaves]


def _path_lengths(cells: list[np.ndarray], own: list[np.ndarray], masks: list[np.ndarray], path: np.ndarray) -> np.ndarray:
    """Path length of each row in one tree, from its places among all cuts of each feature."""
    rows = [table[cell] for table, cell in zip(own, cells)]
    leaf = np.full(len(cells[0]), -1)
    for word in reversed(range(masks[0].shape[1])):
        open_ = masks[0][:, word][rows[0]]
        for mask, row in zip(masks[1:], rows[1:]):
            open_ &= mask[:, word][row]
        # the place of the lowest bit is the number of bits below it
        first = np.bitwise_count((open_ & -open_) - np.uint64(1)).astype(np.int64) + 64 * word
        leaf = np.where(open_ != 0, first, leaf)
    return path[leaf]


def isolation_forest(
    sales: DataFrame, trees: int = OUTLIER_TREES, sample: int = OUTLIER_SAMPLE,
    contamination: float = CONTAMINATION, seed: int = SEED, key: str = "order_item_key",
) -> DataFrame:
    """Rows with anomaly score and flag (the ``contamination`` share with the highest scores).

    Every tree grows from its own sample of at most ``sample`` rows, one small group per
    tree.  A row goes to trees that a hash of its key and the seed draws, about 1.5 x sample rows a tree at any
    table size, so the layout of the table doesn't matter; the finished forest (bounded by trees x sample) goes to the executors, which
    score all rows in Arrow batches.
    """
    names = [f"__{c}" for c in OUTLIER_FEATURES]
    data = stage(_numbers(sales, OUTLIER_FEATURES), "outliers")
    rows = data.count()
    # mean number of trees that a row is drawn for: its whole part for every row, one more by hash
    draws = min(float(trees), 1.5 * trees * sample / max(rows, 1))
    part = F.pmod(F.xxhash64(F.lit(seed), key), F.lit(1 << 30)) / float(1 << 30)
    times = F.lit(math.floor(draws)) + (part < draws - math.floor(draws)).cast("int")
    drawn = data.withColumn("__times", times).filter("__times > 0")
    drawn = drawn.withColumn("__draw", F.explode(F.sequence(F.lit(1), F.col("__times"))))
    drawn = drawn.select(*names, F.pmod(F.xxhash64(F.lit(seed), key, "__draw"), F.lit(trees)).cast("int").alias("tree"))
    depth = max(1, math.ceil(math.log2(max(2, min(sample, rows)))))

    def grow(pdf: pd.DataFrame) -> pd.DataFrame:
        tree = int(pdf["tree"].iloc[0])
        rng = np.random.default_rng(seed + tree)
        x = pdf[names].to_numpy(float)
        x = x[np.lexsort(x.T)]  # order of rows must not matter
        if len(x) > sample:
            x = x[rng.choice(len(x), sample, replace=False)]
        out = pd.DataFrame(_grow(x, rng, depth), columns=["node", "feature", "cut", "left", "right", "path"])
        return out.assign(tree=tree, size=len(x))

    forest = drawn.groupBy("tree").applyInPandas(
        grow, "node int, feature int, cut double, left int, right int, path double, tree int, size int"
    ).toPandas()  # at most trees x 2 x sample rows
    places = [np.unique(forest["cut"][forest["feature"] == f]) for f in range(len(names))]
    packed = []
    for _, t in forest.sort_values(["tree", "node"]).groupby("tree"):
        packed.append(_leaf_masks(*(t[c].to_numpy() for c in ("feature", "cut", "left", "right", "path")), places))
    scale = float(_path_adjustment(forest["size"].mean()))
    shared = sales.sparkSession.sparkContext.broadcast((packed, places, scale))

    @F.pandas_udf("double")
    def score(a: pd.Series, b: pd.Series, c: pd.Series) -> pd.Series:
        model, at, norm = shared.value
        # a row's place among all cuts of a feature, found once for all trees
        cells = [np.searchsorted(cuts, x.to_numpy(float)) for cuts, x in zip(at, (a, b, c))]
        total = np.zeros(len(a))
        for tree in model:
            total += _path_lengths(cells, *tree)
        return pd.Series(np.power(2.0, -(total / len(model)) / norm))

    scored = stage(data.withColumn("anomaly_score", F.round(score(*names), 9)).drop(*names), "scores")
    cut = ordered.exact_percentiles(scored, [], "anomaly_score", {"cut": 1 - contamination}).first()["cut"]
    return scored.withColumn("is_anomaly", F.col("anomaly_score") > F.lit(cut))

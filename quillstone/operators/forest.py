"""Isolation forest: grown in numpy on a bounded seeded sample, sent to the executors, scored in Arrow batches."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillstone.operators.peers import FOREST_FEATURES, flags, forest_features, inject
from quillstone.plans.registry import query
from quillstone.plans.store import scored

TREES, SAMPLE, SEED, CONTAMINATION = 200, 512, 20260921, 0.005
#: Rows of a price type that the forest is fitted on, at most: the smallest by a seeded hash of their id.
TRAIN_ROWS = 20_000
FOREST_TYPES = ("negotiated", "cash")


def average_path(n: np.ndarray | float) -> np.ndarray:
    """Mean path length of an unsuccessful search among n points."""
    n = np.asarray(n, float)
    with np.errstate(divide="ignore", invalid="ignore"):
        c = 2 * (np.log(n - 1) + np.euler_gamma) - 2 * (n - 1) / n
    return np.where(n > 2, c, np.where(n == 2, 1.0, 0.0))


@dataclass
class Tree:
    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    right: np.ndarray
    depth: np.ndarray  # depth of a node plus what its points would add


def grow(points: np.ndarray, rng: np.random.Generator, limit: int) -> Tree:
    feature, cut, left, right, depth = [], [], [], [], []
    stack = [(np.arange(len(points)), 0, -1, False)]
    while stack:
        rows, level, parent, is_right = stack.pop()
        node = len(feature)
        if parent >= 0:
            (right if is_right else left)[parent] = node
        feature.append(-1), cut.append(0.0), left.append(-1), right.append(-1), depth.append(level + float(average_path(len(rows))))
        if level >= limit or len(rows) <= 1:
            continue
        low, high = points[rows].min(0), points[rows].max(0)
        free = np.flatnonzero(high > low)
        if not len(free):
            continue
        f = int(rng.choice(free))
        c = float(rng.uniform(low[f], high[f]))
        below = points[rows, f] < c
        feature[node], cut[node] = f, c
        stack += [(rows[~below], level + 1, node, True), (rows[below], level + 1, node, False)]
    return Tree(*map(np.array, (feature, cut, left, right, depth)))


@dataclass
class Forest:
    trees: list[Tree]
    sample: int
    threshold: float = 0.0

    def score(self, points: np.ndarray) -> np.ndarray:
        """0.5 minus the anomaly score: negative for outliers."""
        total = np.zeros(len(points))
        for t in self.trees:
            node = np.zeros(len(points), int)
            inner = t.feature[node] >= 0
            while inner.any():
                at = node[inner]
                below = points[inner, t.feature[at]] < t.cut[at]
                node[inner] = np.where(below, t.left[at], t.right[at])
                inner = t.feature[node] >= 0
            total += t.depth[node]
        return 0.5 - 2.0 ** (-total / len(self.trees) / max(float(average_path(self.sample)), 1e-9))


def fit(points: np.ndarray, trees: int = TREES, sample: int = SAMPLE, seed: int = SEED, contamination: float = CONTAMINATION) -> Forest:
    rng, size = np.random.default_rng(seed), min(sample, len(points))
    limit = int(np.ceil(np.log2(max(size, 2))))
    forest = Forest([grow(points[rng.choice(len(points), size, replace=False)], rng, limit) for _ in range(trees)], size)
    forest.threshold = float(np.quantile(forest.score(points), contamination))
    return forest


def feature_columns(kind: str) -> list[str]:
    return [n for n in FOREST_FEATURES if kind == "negotiated" or n not in ("f_min", "f_max")]


def train_share(n: int, rows: int = TRAIN_ROWS) -> float:
    """Half of the rows at most, so that some are left to be evaluated on."""
    return min(0.5, rows / max(n, 1))


def train_unit() -> Column:
    """A seeded number in [0, 1) from a row's id; the training rows are those below their type's share."""
    return F.pmod(F.xxhash64("row_id", F.lit(SEED)), F.lit(1 << 40)) / F.lit(float(1 << 40))


@dataclass
class Trained:
    """The forests by price type and the share of each type's rows that they were fitted on."""

    forests: dict[str, Forest]
    shares: dict[str, float]

    def is_train_row(self) -> Column:
        share = F.lit(0.0)
        for kind, s in self.shares.items():
            share = F.when(F.col("price_type") == kind, F.lit(s)).otherwise(share)
        return train_unit() < share


def train(scored_rows: DataFrame, rows: int = TRAIN_ROWS) -> Trained:
    """A forest of each price type that has rows, fitted on about rows of them."""
    counts = {r["price_type"]: r["n"] for r in scored_rows.where(F.col("price_type").isin(*FOREST_TYPES)).groupBy("price_type").agg(F.count("*").alias("n")).collect()}
    shares = {kind: train_share(n, rows) for kind, n in counts.items()}
    forests = {}
    for kind, share in sorted(shares.items()):
        pool = scored_rows.where((F.col("price_type") == kind) & (train_unit() < share))
        sample = pool.select("row_id", *[forest_features()[c].alias(c) for c in feature_columns(kind)]).toPandas().sort_values("row_id")
        if len(sample):
            forests[kind] = fit(sample.drop(columns="row_id").to_numpy(float))
    return Trained(forests, shares)


def with_forest(scored_rows: DataFrame, trained: Trained) -> DataFrame:
    """scored_rows with the rules, if_score (null for other price types), if_flag (strictly under the threshold) and any_flag."""
    sent = scored_rows.sparkSession.sparkContext.broadcast(trained.forests)
    # plain positions for the workers: columns can only be built on the driver
    places = {kind: [FOREST_FEATURES.index(c) for c in feature_columns(kind)] for kind in trained.forests}

    @F.pandas_udf("double")
    def score(kind: pd.Series, *columns: pd.Series) -> pd.Series:
        out, matrix = np.full(len(kind), np.nan), np.column_stack([c.to_numpy(float) for c in columns])
        for k, forest in sent.value.items():
            rows = (kind == k).to_numpy()
            if rows.any():
                out[rows] = forest.score(matrix[rows][:, places[k]])
        return pd.Series(out)

    limit = F.lit(None).cast("double")
    for k, forest in trained.forests.items():
        limit = F.when(F.col("price_type") == k, F.lit(forest.threshold)).otherwise(limit)
    named = flags(scored_rows).withColumn("if_score", F.nanvl(score(F.col("price_type"), *[forest_features()[c] for c in FOREST_FEATURES]), F.lit(None).cast("double")))
    flagged = named.withColumn("if_flag", F.coalesce(F.col("if_score") < limit, F.lit(False)))
    return flagged.withColumn("any_flag", F.col("any_rule") | F.col("if_flag"))


@query("isolation_forest")
def isolation_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = scored(spark, sf_dir)
    return with_forest(rows, train(rows)).select("row_id", "price_type", "if_score", "if_flag", "any_rule", "any_flag")


@query("anomaly_flags_all")
def anomaly_flags_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and flagged rows of each hospital, code and price type, by rules, by the forest and by either."""
    rows = scored(spark, sf_dir)
    flagged = with_forest(rows, train(rows))
    return flagged.groupBy("hospital_slug", "code", "price_type").agg(F.count("*").alias("n"), *[F.count_if(c).alias(f"n_{c}") for c in ("any_rule", "if_flag", "any_flag")])


INJECTED = 6000  # rows that each corruption gets, at most


def injection_report(scored_rows: DataFrame, trained: Trained, per_type: int = INJECTED, seed: str = "injection") -> DataFrame:
    """inj_type, context (all, with_item_context, no_item_context), n and the shares found by r1, the rules, the forest and either.

    Of each corruption's pool, the negotiated and cash rows that the forest was not trained on and that have the context it needs, per_type rows are
    drawn by a seeded hash: the feature of the operator is a sample. The row inj_type 'none' is the natural flag rate of all pool rows.
    """
    pool = scored_rows.where(F.col("price_type").isin(*FOREST_TYPES) & ~trained.is_train_row())
    made = inject(pool)
    sizes = {r["inj_type"]: r["n"] for r in made.groupBy("inj_type").agg(F.count("*").alias("n")).collect()}
    unit = F.pmod(F.xxhash64("row_id", "inj_type", F.lit(seed)), F.lit(1 << 40)) / F.lit(float(1 << 40))
    share = F.lit(0.0)
    for kind, n in sizes.items():
        share = F.when(F.col("inj_type") == kind, F.lit(min(1.0, per_type / n))).otherwise(share)
    drawn = made.where(unit < share)
    clean = pool.withColumn("inj_type", F.lit("none"))
    judged = with_forest(drawn.unionByName(clean.select(*drawn.columns)), trained)
    has_context = F.col("item_gross").isNotNull() | F.col("item_min").isNotNull() | F.col("item_max").isNotNull()
    split = judged.withColumn("context", F.explode(F.array(F.lit("all"), F.when(has_context, "with_item_context").otherwise("no_item_context"))))
    rate = lambda c, name: F.round(F.avg(F.col(c).cast("int")), 4).alias(name)
    return split.groupBy("inj_type", "context").agg(F.count("*").alias("n"), rate("r1_robust_z", "peer_only"), rate("any_rule", "rules"), rate("if_flag", "forest"), rate("any_flag", "combined"))


@query("injection_report")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = scored(spark, sf_dir)
    return injection_report(rows, train(rows))

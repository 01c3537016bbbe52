"""Tree-ensemble scoring and ensemble statistics.

A tree is a nested tuple ``(feature, threshold, left, right)`` with numbers as leaves; a row goes left
if its value is <= the threshold, and right if it is missing.  A split may add ``(..., missing, default_left)``:

* ``nan``: a missing value goes the default way;
* ``zero``: a missing value or one of about 0 goes the default way;
* ``none``: a missing value counts as 0.

Features are cast to float first, because that decides borderline splits; thresholds stay double.
Small trees compile to a Column (stays in generated code); large ensembles are
walked by a vectorised pandas UDF.
"""

from __future__ import annotations

import json
import re

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelforge.functions.nulls import cv_ratio, finite

Tree = tuple | float


def feature_matrix(df: DataFrame, features: list[str], allow_missing: bool = False) -> DataFrame:
    """The features as float, infinities as NULL; an absent one is an error, or NULL if allowed."""
    missing = [f for f in features if f not in df.columns]
    if missing and not allow_missing:
        raise ValueError(f"missing features: {missing}")
    return df.withColumns({f: finite(F.col(f).try_cast("double")).cast("float") if f in df.columns else F.lit(None).cast("float") for f in features})


#: Values of at most this size are zero to a split whose missing kind is zero.
ZERO = 1e-35
MISSING = ("none", "zero", "nan")


def tree_column(tree: Tree) -> Column:
    """One tree as a nested CASE."""
    if not isinstance(tree, tuple):
        return F.lit(float(tree))
    name, threshold, left, right, *rule = tree
    missing, default_left = rule or ("nan", False)
    x = F.col(name).cast("float").cast("double")
    x = F.when(~F.isnan(x), x)
    if missing == "nan":
        go_left = F.coalesce(x <= F.lit(float(threshold)), F.lit(default_left))
    else:
        y = F.coalesce(x, F.lit(0.0))
        go_left = y <= F.lit(float(threshold))
        if missing == "zero":
            go_left = F.when(F.abs(y) <= ZERO, F.lit(default_left)).otherwise(go_left)
    return F.when(go_left, tree_column(left)).otherwise(tree_column(right))


def ensemble_column(trees: list[Tree], sigmoid: bool = True) -> Column:
    total = sum((tree_column(t) for t in trees[1:]), tree_column(trees[0]))
    return 1 / (1 + F.exp(-total)) if sigmoid else total


class FlatEnsemble:
    """Trees as arrays, walked level by level for a whole batch."""

    def __init__(self, trees: list[Tree], features: list[str], sigmoid: bool = True):
        self.features, self.sigmoid = features, sigmoid
        at = {f: i for i, f in enumerate(features)}
        feature, threshold, left, right, roots, missing, default = [], [], [], [], [], [], []

        def add(t: Tree) -> int:
            i = len(feature)
            feature.append(-1)
            threshold.append(0.0)
            left.append(i)
            right.append(i)
            missing.append(2)
            default.append(False)
            if isinstance(t, tuple):
                feature[i], threshold[i] = at[t[0]], float(t[1])
                if len(t) > 4:
                    missing[i], default[i] = MISSING.index(t[4]), bool(t[5])
                left[i], right[i] = add(t[2]), add(t[3])
            else:
                threshold[i] = float(t)
            return i

        for t in trees:
            roots.append(add(t))
        self.feature, self.threshold = np.array(feature), np.array(threshold)
        self.left, self.right, self.roots = np.array(left), np.array(right), roots
        self.missing, self.default = np.array(missing), np.array(default)

    def predict(self, x: np.ndarray) -> np.ndarray:
        total = np.zeros(len(x))
        for root in self.roots:
            node = np.full(len(x), root)
            while True:
                f = self.feature[node]
                inner = f >= 0
                if not inner.any():
                    break
                v = x[np.arange(len(x)), np.maximum(f, 0)].astype(np.float64)
                kind, absent = self.missing[node], np.isnan(v)
                v = np.where(absent & (kind != 2), 0.0, v)
                by_default = np.where(kind == 2, absent, (kind == 1) & (np.abs(v) <= ZERO))
                step = np.where(np.where(by_default, self.default[node], v <= self.threshold[node]), self.left[node], self.right[node])
                node = np.where(inner, step, node)
            total += self.threshold[node]
        return 1 / (1 + np.exp(-total)) if self.sigmoid else total


def predict(df: DataFrame, model: FlatEnsemble, name: str) -> DataFrame:
    """Adds the model's score, computed in Arrow batches."""

    @F.pandas_udf("double")
    def score(*cols: pd.Series) -> pd.Series:
        return pd.Series(model.predict(np.column_stack([c.to_numpy(np.float32) for c in cols])))

    return df.withColumn(name, score(*[F.col(f).cast("float") for f in model.features]))


def parse_text_model(text: str) -> tuple[list[Tree], list[str]]:
    """Trees and feature names of a boosted-tree model in the common key=value text layout.

    ``decision_type`` holds the default direction (bit 1) and the kind of missing values (bits 2 and 3) of
    each split; splits on categories (bit 0, or ``num_cat``) are refused.
    """
    names = re.search(r"^feature_names=(.*)$", text, re.M)
    features = names[1].split() if names else []
    trees: list[Tree] = []
    for block in re.split(r"^Tree=\d+$", text, flags=re.M)[1:]:
        field = dict(re.findall(r"^(\w+)=(.*)$", block.split("\n\n\n")[0], re.M))
        if int(field.get("num_cat", 0)):
            raise ValueError("splits on categories are not supported")
        leaves = [float(v) for v in field["leaf_value"].split()]
        if "split_feature" not in field or not field["split_feature"].strip():
            trees.append(leaves[0])
            continue
        split, cut = [int(v) for v in field["split_feature"].split()], [float(v) for v in field["threshold"].split()]
        low, high = [int(v) for v in field["left_child"].split()], [int(v) for v in field["right_child"].split()]
        kinds = [int(v) for v in field.get("decision_type", "").split()] or [8] * len(split)
        if any(k & 1 for k in kinds):
            raise ValueError("splits on categories are not supported")

        def build(i: int) -> Tree:
            return leaves[~i] if i < 0 else (features[split[i]], cut[i], build(low[i]), build(high[i]), MISSING[kinds[i] >> 2 & 3], bool(kinds[i] & 2))  # noqa: B023

        trees.append(build(0))
    return trees, features


def load_bundle(model_text: str, meta_json: str) -> FlatEnsemble:
    """A model with the feature list its metadata names; refuses a list that does not match."""
    trees, features = parse_text_model(model_text)
    meta = json.loads(meta_json)
    wanted = meta.get("features", features)
    if set(wanted) != set(features):
        raise ValueError("features of the model and of its metadata differ")
    return FlatEnsemble(trees[: meta.get("best_iteration") or None], list(wanted))


def read_bundle(spark: SparkSession, folder: str, model: str = "model.txt", meta: str = "meta.json") -> FlatEnsemble:
    """A bundle from a folder that Spark can read."""
    text = {n: spark.read.text(f"{folder}/{n}", wholetext=True).first()[0] for n in (model, meta)}
    return load_bundle(text[model], text[meta])


def file_digests(spark: SparkSession, path: str) -> DataFrame:
    """name, size and SHA-256 of files."""
    return spark.read.format("binaryFile").load(path).select(F.element_at(F.split("path", "/"), -1).alias("name"), F.col("length").alias("size"), F.sha2("content", 256).alias("sha256"))


def row_mean(cols: list[str]) -> Column:
    """Mean over columns, missing ones left out."""
    n = sum((F.col(c).isNotNull().cast("int") for c in cols), F.lit(0))
    return sum((F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in cols), F.lit(0.0)) / F.nullif(n, F.lit(0))


def row_std(cols: list[str]) -> Column:
    """Population deviation over columns."""
    m = row_mean(cols)
    n = sum((F.col(c).isNotNull().cast("int") for c in cols), F.lit(0))
    return F.sqrt(sum((F.coalesce(F.pow(F.col(c) - m, 2), F.lit(0.0)) for c in cols), F.lit(0.0)) / F.nullif(n, F.lit(0)))


def ensemble_stats(df: DataFrame, preds: list[str], date: str, tie: str) -> DataFrame:
    """Ranks of each score by date, and mean, deviation, CV, extremes, mean rank and the rank of the mean."""
    from .crosssec import rank_first

    out = df.withColumns({f"rank_{p}": rank_first(p, tie, date) for p in preds})
    ranks = [f"rank_{p}" for p in preds]
    out = out.withColumns({"avg_pred": row_mean(preds), "pred_std": row_std(preds), "pred_min": F.least(*preds), "pred_max": F.greatest(*preds), "avg_rank_raw": row_mean(ranks)})
    return out.withColumns({"pred_cv": cv_ratio("pred_std", "avg_pred"), "avg_pred_rank": rank_first("avg_pred", tie, date), "avg_rank": rank_first("avg_rank_raw", tie, date, descending=False)})

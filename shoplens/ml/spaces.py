"""Search spaces of the tuning operators, in Spark's parameters.

Two names are ours: ``C`` (inverse penalty; ``regParam = 1 / (C * rows)``) and
``penalty`` (l1 / l2 / elasticnet; with ``l1_ratio`` it becomes
``elasticNetParam``).  A depth without limit is Spark's largest, 30.
"""

from __future__ import annotations

import hashlib
import heapq
import math
import random

# ---------------------------------------------------------------------------
# The grids of the baseline and of the regularised search.
# ---------------------------------------------------------------------------
SPACES: dict[str, dict[str, list]] = {
    "logistic_regression": {"C": [0.001, 0.01, 0.1, 1.0, 10.0], "penalty": ["l1", "l2"]},
    "random_forest": {
        "numTrees": [100, 200, 300, 500], "maxDepth": [5, 8, 10, 15, 30], "minInstancesPerNode": [1, 2, 4],
        "featureSubsetStrategy": ["sqrt", "log2"],
    },
    "boosted_leaves": {
        "maxIter": [100, 200, 300, 500], "stepSize": [0.01, 0.03, 0.05, 0.1], "maxDepth": [3, 5, 6, 8, 30],
        "minInstancesPerNode": [10, 20, 30, 50], "subsamplingRate": [0.7, 0.8, 0.9, 1.0],
        "featureSubsetStrategy": ["0.7", "0.8", "0.9", "1.0"],
    },
    "boosted_depth": {
        "maxIter": [100, 200, 300, 500], "stepSize": [0.01, 0.03, 0.05, 0.1], "maxDepth": [3, 4, 5, 6, 8],
        "subsamplingRate": [0.7, 0.8, 0.9, 1.0], "featureSubsetStrategy": ["0.7", "0.8", "0.9", "1.0"],
        "minInstancesPerNode": [1, 3, 5, 10], "minInfoGain": [0.0, 0.1, 0.2, 0.5],
    },
}
ADVANCED_SPACES: dict[str, dict[str, list]] = {
    "logistic_l1_l2": {"C": [0.001, 0.01, 0.1, 1.0, 10.0, 100.0], "penalty": ["l1", "l2"]},
    "logistic_elasticnet": {"C": [0.001, 0.01, 0.1, 1.0, 10.0], "penalty": ["elasticnet"], "l1_ratio": [0.1, 0.3, 0.5, 0.7, 0.9]},
    "random_forest": SPACES["random_forest"] | {
        "minInstancesPerNode": [5, 10, 20], "featureSubsetStrategy": ["sqrt", "log2", "0.5"]},
    "boosted_depth": SPACES["boosted_depth"] | {"minInstancesPerNode": [3, 5, 7, 10], "minInfoGain": [0.0, 0.1, 0.5, 1.0]},
    "boosted_leaves": SPACES["boosted_leaves"] | {"minInstancesPerNode": [10, 20, 30, 50], "minInfoGain": [0.0, 0.1, 0.5]},
    "boosted_shallow": {"maxIter": [100, 200, 300], "stepSize": [0.01, 0.05, 0.1], "maxDepth": [4, 6, 8], "maxBins": [32, 64, 128]},
}
# ---------------------------------------------------------------------------

ELASTIC = {"l1": 1.0, "l2": 0.0}


def draw(space: dict[str, list], n_iter: int, seed: int = 42) -> list[dict]:
    """``n_iter`` distinct points of a grid (all, if it has fewer), seeded."""
    size = grid_size(space)
    return [point_at(space, k) for k in random.Random(seed).sample(range(size), min(n_iter, size))]


def grid_size(space: dict[str, list]) -> int:
    return math.prod(len(v) for v in space.values())


def point_at(space: dict[str, list], k: int) -> dict:
    """Point ``k`` of the grid; the first name changes fastest."""
    point = {}
    for name, values in space.items():
        k, at = divmod(k, len(values))
        point[name] = values[at]
    return point


def hash_draw(space: dict[str, list], n_iter: int, seed: int = 42) -> list[tuple[int, dict]]:
    """``n_iter`` numbered points of a grid, those of least md5 of "<seed>|point|<number>",
    so that SQL and any other program draw the same."""
    order = lambda k: hashlib.md5(f"{seed}|point|{k}".encode()).hexdigest()
    return [(k, point_at(space, k)) for k in heapq.nsmallest(n_iter, range(grid_size(space)), key=order)]


def param_map(stage, point: dict, n_rows: int) -> dict:
    """A drawn point as a Spark param map of the estimator ``stage``."""
    values = dict(point)
    if "C" in values:
        values["regParam"] = 1.0 / (values.pop("C") * max(n_rows, 1))
    if "penalty" in values:
        penalty, ratio = values.pop("penalty"), values.pop("l1_ratio", 0.5)
        values["elasticNetParam"] = ELASTIC.get(penalty, ratio)
    return {stage.getParam(k): v for k, v in values.items()}

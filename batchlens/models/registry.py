"""Model registry (L10, S18, S19): versioned model folders plus an append-only registry table.

A model folder is written first and is inert; it becomes visible only through a registry row whose run is
committed in the ledger, so a crash between the two leaves nothing half-published.
"""

from __future__ import annotations

import json
from dataclasses import dataclass
from typing import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from batchlens.models.mlp import MLPModel, search_mlp
from batchlens.models.trees import BoostModel, TreeModel, search_boost, search_tree
from batchlens.sources.store import REGISTRY, Store
from batchlens.spec import TableSpec


@dataclass(frozen=True)
class Entry:
    key: str
    display_name: str
    model_type: str
    cls: type
    search: Callable


def build_model_registry() -> dict[str, Entry]:
    """Candidate models in training order."""
    return {
        "boost": Entry("boost", "GBTRegressor", "boost", BoostModel, search_boost),
        "tree": Entry("tree", "DecisionTreeRegressor", "tree", TreeModel, search_tree),
        "mlp": Entry("mlp", "MLPRegressor", "mlp", MLPModel, search_mlp),
    }


_KINDS = {"boost": BoostModel, "tree": TreeModel, "mlp": MLPModel}


def load_model(path: str, model_type: str, spec: TableSpec):
    return _KINDS[model_type].load(path, spec)


def committed(store: Store) -> DataFrame:
    """Registry rows of committed runs only."""
    return store.committed_log(REGISTRY)


def current_row(store: Store, key: str):
    """Newest committed version of ``key``."""
    r = committed(store).where(F.col("model_key") == key)
    return r.agg(F.max_by(F.struct(*r.columns), F.struct("created_at", "ordinal")).alias("r")).first()["r"]


def best_row(store: Store):
    r = committed(store).where(F.col("is_best"))
    return r.agg(F.max_by(F.struct(*r.columns), F.struct("created_at", "ordinal")).alias("r")).first()["r"]


def load_row(row, spec: TableSpec):
    if row is None:
        raise FileNotFoundError("the registry has no such model")
    return load_model(row["path"], row["model_type"], spec)


def params_json(p: dict) -> str:
    return json.dumps({k: (list(v) if isinstance(v, tuple) else v) for k, v in p.items()}, sort_keys=True)

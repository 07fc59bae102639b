"""Named preprocessing steps an event type can ask for before its rules run."""

from __future__ import annotations

import logging
from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F

log = logging.getLogger(__name__)

Preprocess = Callable[[DataFrame], DataFrame]
_PREPROCESS: dict[str, Preprocess] = {}

# Flattened name -> key inside the post-match objects.
_FLATTENED = {
    "coin_balance": "coin-balance-after-match",
    "level": "level-after-match",
    "device": "device",
    "platform_orig": "platform",
}


def register_preprocess(name: str, function: Preprocess) -> None:
    _PREPROCESS[name] = function


def get_preprocess(name: str | None) -> Preprocess | None:
    """The named step; an unknown name is logged and ignored."""
    if name and name not in _PREPROCESS:
        log.warning("unknown preprocessing %r ignored, available: %s", name, list(_PREPROCESS))
    return _PREPROCESS.get(name) if name else None


def flatten_match(df: DataFrame) -> DataFrame:
    """Lift both players' post-match objects into top-level columns."""
    return df.withColumns(
        {
            f"user_{side}_{name}": F.col(f"`user-{side}-postmatch-info`.`{key}`")
            for side in ("a", "b")
            for name, key in _FLATTENED.items()
        }
    )


register_preprocess("flatten_match_fields", flatten_match)

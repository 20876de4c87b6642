"""Settings with dotted keys: defaults, overlaid by a nested mapping or a JSON file."""

from __future__ import annotations

import json
from collections.abc import Mapping
from pathlib import Path
from typing import Any

DEFAULTS: dict[str, Any] = {
    "detection": {"minWidth": 200, "minHeight": 150, "threshold": 0.70, "neighbours": 10, "weights": {"centroid": 0.6, "neighbours": 0.4}},
    "output": {"most": 250},
}


class Settings:
    def __init__(self, values: Mapping[str, Any] | None = None):
        self._values = _overlaid(DEFAULTS, values or {})

    @classmethod
    def load(cls, path: str, spark=None) -> Settings:
        """From a JSON file; with a session from any store that Spark reads."""
        raw = Path(path).read_text() if spark is None else spark.read.text(path, wholetext=True).first()[0]
        return cls(json.loads(raw))

    def get(self, key: str, default: Any = None) -> Any:
        """The value under a dotted key, ``default`` where any part of it is missing."""
        at: Any = self._values
        for part in key.split("."):
            if not isinstance(at, Mapping) or part not in at:
                return default
            at = at[part]
        return at


def _overlaid(below: Mapping[str, Any], above: Mapping[str, Any]) -> dict[str, Any]:
    out = dict(below)
    for k, v in above.items():
        out[k] = _overlaid(out[k], v) if isinstance(v, Mapping) and isinstance(out.get(k), Mapping) else v
    return out

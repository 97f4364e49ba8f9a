"""Parameters of a run and the maps of models, markers and indexes, checked before anything is read."""

from __future__ import annotations

import json
import re
from dataclasses import dataclass, fields
from typing import ClassVar

from sedimark.operators.integrity import IntegrityError
from sedimark.sources.text import IDENTIFIER

MARKERS = ("16S", "18S")
LEGACY_PROFILE = "curated"


def strict_json(text: str) -> object:
    """JSON in which no object has a key twice."""
    def unique(pairs: list[tuple[str, object]]) -> dict:
        twice = sorted({k for k, _ in pairs if sum(k == other for other, _ in pairs) > 1})
        if twice:
            raise IntegrityError(f"duplicate keys: {twice}")
        return dict(pairs)

    try:
        return json.loads(text, object_pairs_hook=unique)
    except json.JSONDecodeError as error:
        raise IntegrityError(f"invalid JSON: {error}") from error


def marker_map(text: str, override: str | None = None) -> dict[str, str]:
    """Marker of every model; entries of ``override`` come in place of the first file's."""
    merged: dict[str, str] = {}
    for one in (text, override):
        if one is None:
            continue
        value = strict_json(one)
        if not isinstance(value, dict) or value.get("schema_version") != 1 or not isinstance(value.get("models"), dict):
            raise IntegrityError("a marker map needs schema_version 1 and models")
        for model, marker in value["models"].items():
            if not re.match(IDENTIFIER.replace(r"\z", r"\Z"), model) or marker not in MARKERS:
                raise IntegrityError(f"model {model!r} with marker {marker!r}")
        merged |= value["models"]
    return merged


def tree_models(markers: dict[str, str]) -> dict[str, str]:
    """The one model of each marker, as trees need it."""
    of = {m: sorted(k for k, v in markers.items() if v == m) for m in MARKERS}
    wrong = {m: len(models) for m, models in of.items() if len(models) != 1}
    if wrong:
        raise IntegrityError(f"models per marker: {wrong}")
    return {m: models[0] for m, models in of.items()}


def index_of(model: str, markers: dict[str, str], profile: str, installed: dict[str, dict[str, str]], legacy: str | None = None) -> str:
    """Index to search for a model: its marker's in the installed profile; an index without profiles stands in for the curated one only."""
    if model not in markers:
        raise IntegrityError(f"unknown model {model!r}")
    if profile in installed:
        if markers[model] not in installed[profile]:
            raise IntegrityError(f"profile {profile!r} has no index of {markers[model]}")
        return installed[profile][markers[model]]
    if profile == LEGACY_PROFILE and legacy is not None:
        return legacy
    raise IntegrityError(f"profile {profile!r} is not installed")


@dataclass(frozen=True)
class Parameters:
    """Parameters of a run; every value is checked when they are made."""

    minimum_length: int = 500
    max_targets: int = 500
    top_hits: int = 5
    tree_classification: bool = False
    tree_references: int = 100
    tree_neighbours: int = 5
    tree_gap_fraction: float = 0.9
    database_profile: str = "curated"

    LEAST: ClassVar[dict[str, int]] = {"minimum_length": 0, "max_targets": 1, "top_hits": 1, "tree_references": 3, "tree_neighbours": 1}

    def __post_init__(self) -> None:
        for name, least in self.LEAST.items():
            value = getattr(self, name)
            if type(value) is not int or value < least:
                raise IntegrityError(f"{name} must be an integer of at least {least}, not {value!r}")
        if type(self.tree_classification) is not bool:
            raise IntegrityError("tree_classification must be a boolean")
        if not isinstance(self.tree_gap_fraction, (int, float)) or isinstance(self.tree_gap_fraction, bool) or not 0 <= self.tree_gap_fraction < 1:
            raise IntegrityError("tree_gap_fraction must be at least 0 and less than 1")
        if not re.match(IDENTIFIER.replace(r"\z", r"\Z"), self.database_profile):
            raise IntegrityError(f"invalid profile {self.database_profile!r}")

    @classmethod
    def read(cls, values: dict[str, object]) -> Parameters:
        """Parameters from a mapping; names that are none are an error."""
        unknown = sorted(set(values) - {f.name for f in fields(cls)})
        if unknown:
            raise IntegrityError(f"unknown parameters: {unknown}")
        return cls(**values)

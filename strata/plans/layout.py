"""Where the layers of one flow are written."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import SparkSession

from strata.sources.sinks import SinkSpec, ensure_schemas


@dataclass(frozen=True)
class LayerLayout:
    """Path targets ``<root>/<layer>/<name>`` in one format.

    ``overrides`` maps ``"<layer>/<name>"`` to an explicit path (for layer
    paths given by a config file).
    """

    root: str
    format: str = "parquet"
    overrides: Mapping[str, str] = field(default_factory=dict)

    def spec(self, layer: str, name: str) -> SinkSpec:
        path = self.overrides.get(f"{layer}/{name}") or f"{self.root.rstrip('/')}/{layer}/{name}"
        return SinkSpec(path, "path", self.format, "overwrite")

    def has_override(self, layer: str, name: str) -> bool:
        return f"{layer}/{name}" in self.overrides


@dataclass(frozen=True)
class TableLayout:
    """Catalog targets: ``schemas`` says which schema (``catalog.schema`` too) holds each layer's tables.

    ``location_root`` puts the schemas that `create` makes into one shared
    folder; without it they are where the catalog's warehouse is.
    """

    schemas: Mapping[str, str]
    format: str = "parquet"
    location_root: str | None = None

    def spec(self, layer: str, name: str) -> SinkSpec:
        return SinkSpec(f"{self.schemas[layer]}.{name}", "table", self.format, "overwrite")

    def create(self, spark: SparkSession) -> None:
        ensure_schemas(spark, list(dict.fromkeys(self.schemas.values())), self.location_root, comment="layer schema")

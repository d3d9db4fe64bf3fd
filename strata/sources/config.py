"""Config files of the layered flows: sources, default output and layer paths.

Reads the JSON shape the flows are configured with — ``file_paths`` (format →
relative path), ``output`` (path, format, mode) and optionally
``medallion_paths`` (layer name → relative path). Connection and credential
sections are environment setup (cluster or session configuration), not data
operations, and are ignored here.
"""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import dataclass, field
from pathlib import Path

from strata.sources.sinks import SinkSpec


@dataclass(frozen=True)
class IOConfig:
    base: str
    file_paths: Mapping[str, str] = field(default_factory=dict)
    output: SinkSpec | None = None
    layer_paths: Mapping[str, str] = field(default_factory=dict)

    def path(self, relative: str) -> str:
        """Full path of a configured relative path."""
        return f"{self.base.rstrip('/')}/{relative.lstrip('/')}" if relative else self.base

    def sources(self) -> dict[str, str]:
        """Format → full path of every configured source."""
        return {fmt: self.path(p) for fmt, p in self.file_paths.items()}

    def layer(self, name: str) -> str:
        return self.path(self.layer_paths[name])

    @classmethod
    def from_json(cls, config: str | Mapping, base: str) -> IOConfig:
        """Parse a config file (path or already-loaded dict) against a base URI."""
        cfg = json.loads(Path(config).read_text()) if isinstance(config, str) else dict(config)
        out = cfg.get("output")
        base = base.rstrip("/")
        output = SinkSpec(f"{base}/{out['path']}", "path", out.get("format", "parquet"),
                          out.get("mode", "overwrite")) if out else None
        return cls(base, dict(cfg.get("file_paths", {})), output, dict(cfg.get("medallion_paths", {})))

"""Settings, all of which are honoured. Values come from a YAML file or from keyword arguments."""

from __future__ import annotations

from dataclasses import dataclass, field, fields, is_dataclass
from typing import Any


@dataclass
class SourceSettings:
    path: str = ""
    format: str = "parquet"
    filter: dict[str, Any] = field(default_factory=lambda: {"kingdom": "Plantae"})


@dataclass
class StoreSettings:
    path: str = "entities"


@dataclass
class ProcessingSettings:
    batch_size: int = 10_000
    max_records: int | None = None
    resume: bool = False
    #: Key of a registered named-entity recogniser, or of none to have the library's own; null for no recogniser at all.
    recogniser: str | None = "perceptron"


@dataclass
class AlgorithmSettings:
    similarity_threshold: float = 0.70
    levenshtein_weight: float = 0.4
    jaro_winkler_weight: float = 0.4
    phonetic_weight: float = 0.2
    clustering: str = "leader"


@dataclass
class OutputSettings:
    report_path: str = "report.tsv"
    deduplicated: bool = True


@dataclass
class Settings:
    source: SourceSettings = field(default_factory=SourceSettings)
    store: StoreSettings = field(default_factory=StoreSettings)
    processing: ProcessingSettings = field(default_factory=ProcessingSettings)
    algorithms: AlgorithmSettings = field(default_factory=AlgorithmSettings)
    output: OutputSettings = field(default_factory=OutputSettings)

    @classmethod
    def from_dict(cls, values: dict[str, Any] | None) -> Settings:
        return _filled(cls, values or {})

    @classmethod
    def from_yaml(cls, path: str) -> Settings:
        """Read a YAML file; needs PyYAML."""
        try:
            import yaml
        except ModuleNotFoundError as e:
            raise RuntimeError("reading YAML needs PyYAML; use Settings.from_dict") from e
        with open(path, encoding="utf-8") as f:
            return cls.from_dict(yaml.safe_load(f))


def _filled(kind: type, values: dict[str, Any]) -> Any:
    known = {f.name: f for f in fields(kind)}
    if wrong := values.keys() - known.keys():
        raise ValueError(f"unknown settings: {', '.join(sorted(wrong))}")
    defaults = kind()
    made = {}
    for name, value in values.items():
        own = getattr(defaults, name)
        made[name] = _filled(type(own), value or {}) if is_dataclass(own) else value
    return kind(**made)

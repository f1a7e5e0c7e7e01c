"""Settings of a run, from YAML and the command line. Every one of them is read by a command."""

from __future__ import annotations

from dataclasses import asdict, dataclass, fields, replace


@dataclass(frozen=True)
class Place:
    """Where a catalogue lies and how it is cut into cells."""

    root: str = "catalog"
    grid: str = "latlon"
    resolution: int = 1
    regions: str | None = None
    region_id: str = "id"


@dataclass(frozen=True)
class Reading:
    """How item documents are fetched."""

    concurrency: int = 64
    retries: int = 3
    wait: float = 0.5
    chunk_rows: int = 100_000


@dataclass(frozen=True)
class Writing:
    """How data files are written, and which of repeated ids stays."""

    rows_per_file: int = 1_000_000
    codec: str = "zstd"
    keep: str = "updated"


@dataclass(frozen=True)
class Settings:
    place: Place = Place()
    reading: Reading = Reading()
    writing: Writing = Writing()

    def fetch_options(self) -> dict:
        return {k: v for k, v in asdict(self.reading).items() if k != "chunk_rows"}

    def write_options(self) -> dict:
        return {"rows_per_file": self.writing.rows_per_file, "codec": self.writing.codec}


def read(data: dict | None, base: Settings = Settings()) -> Settings:
    """Settings from nested dictionaries; an unknown group or name is an error."""
    groups = {f.name for f in fields(Settings)}
    changed = {}
    for group, values in (data or {}).items():
        if group not in groups:
            raise ValueError(f"no such group of settings: {group}")
        now = getattr(base, group)
        unknown = set(values or {}) - {f.name for f in fields(now)}
        if unknown:
            raise ValueError(f"no such settings in {group}: {', '.join(sorted(unknown))}")
        changed[group] = replace(now, **(values or {}))
    return replace(base, **changed)


def load(path: str) -> Settings:
    import yaml

    with open(path, encoding="utf-8") as f:
        return read(yaml.safe_load(f))

"""Settings: defaults, YAML file, command line; the command line wins."""

from __future__ import annotations

import logging
from dataclasses import asdict, dataclass, field, fields, is_dataclass
from pathlib import Path
from typing import Any

from isoforge.errors import InvalidValueError, MissingFieldError

log = logging.getLogger(__name__)
VERSION = "1.0"


# The names and defaults of the settings.
@dataclass
class Storage:
    input_path: str | None = None
    fasta_sidecar_path: str | None = None
    output_path: str = "data/parquet/entries.parquet"
    temp_dir: str = "data/tmp"


@dataclass
class Performance:
    batch_size: int = 10_000
    thread_count: int = 1
    channel_capacity: int = 8
    zstd_level: int = 3
    max_row_group_size: int = 100_000
    buffer_size: int = 262_144


@dataclass
class Logging:
    log_level: str = "info"
    metrics_interval_secs: int = 5


@dataclass
class Runs:
    runs_dir: str = "runs"
    keep_runs: int = 10


@dataclass
class Settings:
    version: str = VERSION
    storage: Storage = field(default_factory=Storage)
    performance: Performance = field(default_factory=Performance)
    logging: Logging = field(default_factory=Logging)
    runs: Runs = field(default_factory=Runs)

    def with_arguments(self, input_path: str | None = None, output_path: str | None = None, batch_size: int | None = None, fasta_sidecar: str | None = None) -> Settings:
        """What is given wins over the file."""
        if input_path is not None:
            self.storage.input_path = input_path
        if output_path is not None:
            self.storage.output_path = output_path
        if batch_size is not None:
            self.performance.batch_size = batch_size
        if fasta_sidecar is not None:
            self.storage.fasta_sidecar_path = fasta_sidecar
        return self

    def resolved(self, root: str | Path | None = None) -> Settings:
        """Relative paths are under root (the working directory)."""
        base = Path(root or Path.cwd())
        place = lambda p: p if p is None or "://" in p else str(base / p)
        s = self.storage
        s.input_path, s.fasta_sidecar_path, s.output_path, s.temp_dir = map(place, (s.input_path, s.fasta_sidecar_path, s.output_path, s.temp_dir))
        self.runs.runs_dir = place(self.runs.runs_dir)
        return self

    def input(self) -> str:
        if not self.storage.input_path:
            raise MissingFieldError("storage.input_path is not set")
        return self.storage.input_path

    def save(self, path: str | Path) -> None:
        Path(path).write_text(to_yaml(asdict(self)))


def _fill(target: Any, given: Any, where: str) -> None:
    if not isinstance(given, dict):
        raise InvalidValueError(f"{where or 'settings'}: a mapping is expected")
    known = {f.name for f in fields(target)}
    for key, value in given.items():
        if key not in known:
            continue
        own = getattr(target, key)
        if is_dataclass(own):
            _fill(own, value or {}, f"{where}{key}.")
        elif isinstance(own, int) and not isinstance(value, int):
            raise InvalidValueError(f"{where}{key}: a number is expected")
        else:
            setattr(target, key, value)


def load_settings(path: str | Path | None) -> Settings:
    """A missing file gives the defaults; a malformed one is an error; another version is only warned of."""
    out = Settings()
    if path is None or not Path(path).exists():
        return out
    given = from_yaml(Path(path).read_text())
    _fill(out, {} if given is None else given, "")
    out.version = str(out.version)
    if out.version != VERSION:
        log.warning("settings have version %s, not %s", out.version, VERSION)
    return out


def from_yaml(text: str) -> Any:
    try:
        import yaml
    except ImportError as e:
        raise MissingFieldError("PyYAML is needed to read settings") from e
    try:
        return yaml.safe_load(text)
    except yaml.YAMLError as e:
        raise InvalidValueError(f"settings aren't YAML: {e}") from e


def to_yaml(value: Any) -> str:
    try:
        import yaml

        return yaml.safe_dump(value, sort_keys=False)
    except ImportError:  # JSON is YAML, too
        import json

        return json.dumps(value, indent=2) + "\n"

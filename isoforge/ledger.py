"""The execution ledger: a folder for each run with its settings, log and report; retention; resource samples."""

from __future__ import annotations

import logging
import os
import platform
import re
import shutil
import sys
import threading
import time
from collections.abc import Callable
from dataclasses import asdict, dataclass, field
from datetime import UTC, datetime
from pathlib import Path

from isoforge.config import to_yaml
from isoforge.errors import InvalidValueError, IoError

PREFIX = "run_"
PROFILES = "profiles"
# Names of a run's files, and thresholds of the diagnosis.
REPORT, LOG, SNAPSHOT = "report.yaml", "etl.log", "config_snapshot.yaml"
CPU_HIGH, CPU_LOW = 0.7, 0.3
LEVELS = {"trace": logging.DEBUG, "debug": logging.DEBUG, "info": logging.INFO, "warn": logging.WARNING, "error": logging.ERROR}


def checked_run_id(raw: str) -> str:
    """A run's name: letters, digits, '_' and '-' after run_, no path."""
    name = raw.strip()
    if not name:
        raise InvalidValueError("a run id can't be empty")
    if "/" in name or "\\" in name or ".." in name:
        raise InvalidValueError(f"a run id can't be a path: {raw!r}")
    name = name if name.startswith(PREFIX) else PREFIX + name
    if not re.fullmatch(r"[A-Za-z0-9_-]+", name):
        raise InvalidValueError(f"a run id is letters, digits, '_' and '-': {raw!r}")
    return name


class RunContext:
    """The folder of one run. A name given by the caller may reuse a folder that is empty or holds only profiles."""

    def __init__(self, runs_dir: str | Path, run_id: str | None = None, now: datetime | None = None):
        self.started = now or datetime.now(UTC)
        self.run_id = checked_run_id(run_id) if run_id is not None else f"{PREFIX}{self.started:%Y%m%d_%H%M%S}"
        self.path = Path(runs_dir) / self.run_id
        if self.path.exists() and not (run_id is not None and self._reusable()):
            raise IoError(f"run {self.run_id} exists")
        self.path.mkdir(parents=True, exist_ok=True)

    def _reusable(self) -> bool:
        return self.path.is_dir() and {p.name for p in self.path.iterdir()} <= {PROFILES}

    @property
    def report_path(self) -> Path:
        return self.path / REPORT

    @property
    def log_path(self) -> Path:
        return self.path / LOG

    @property
    def snapshot_path(self) -> Path:
        return self.path / SNAPSHOT


def clean_up(runs_dir: str | Path, keep: int) -> list[str]:
    """Deletes all but the last keep runs, by name; returns the deleted."""
    folder = Path(runs_dir)
    runs = sorted(p for p in folder.iterdir() if p.is_dir() and p.name.startswith(PREFIX)) if folder.is_dir() else []
    gone = runs[: max(0, len(runs) - keep)]
    for p in gone:
        shutil.rmtree(p)
    return [p.name for p in gone]


def tee_logger(path: Path, name: str = "isoforge.run", level: str = "info") -> logging.Logger:
    """To standard error and to the run's log, flushed line by line."""
    out = logging.getLogger(f"{name}.{path.parent.name}")
    out.setLevel(LEVELS.get(level.lower(), logging.INFO))
    out.propagate = False
    for handler in (logging.StreamHandler(sys.stderr), logging.FileHandler(path)):
        handler.setFormatter(logging.Formatter("%(message)s"))
        out.addHandler(handler)
    return out


@dataclass
class Sample:
    cpu: float
    rss_mb: float
    at: float


class ResourceSampler:
    """Samples the driver's CPU and memory once an interval, from /proc; nothing where that isn't there."""

    def __init__(self, interval: float = 1.0):
        self.interval = interval
        self.samples: list[Sample] = []
        self._stop = threading.Event()
        self._thread: threading.Thread | None = None

    def start(self) -> ResourceSampler:
        self._thread = threading.Thread(target=self._run, daemon=True)
        self._thread.start()
        return self

    def _run(self) -> None:
        last_cpu, last = time.process_time(), time.monotonic()
        while not self._stop.wait(self.interval):
            cpu, now = time.process_time(), time.monotonic()
            self.samples.append(Sample((cpu - last_cpu) / max(1e-9, now - last), rss_mb(), time.time()))
            last_cpu, last = cpu, now

    def stop(self) -> None:
        self._stop.set()
        if self._thread:
            self._thread.join(timeout=5)

    def high_water_marks(self) -> dict[str, float]:
        if not self.samples:
            return {"max_cpu": 0.0, "mean_cpu": 0.0, "max_rss_mb": 0.0}
        return {"max_cpu": max(s.cpu for s in self.samples), "mean_cpu": sum(s.cpu for s in self.samples) / len(self.samples), "max_rss_mb": max(s.rss_mb for s in self.samples)}


def rss_mb() -> float:
    try:
        pages = int(Path("/proc/self/statm").read_text().split()[1])
        return pages * os.sysconf("SC_PAGE_SIZE") / 1e6
    except (OSError, ValueError, IndexError):
        return 0.0


def cpu_share(spark) -> float | None:
    """The share of the time of the application's tasks in which they were on a core, by Spark's stage metrics; None before any."""
    store = spark.sparkContext._jsc.sc().statusStore()
    stages = store.stageList(None, False, False, spark.sparkContext._gateway.new_array(spark.sparkContext._jvm.double, 0), None)
    run = cpu = 0
    for i in range(stages.size()):
        run += stages.apply(i).executorRunTime()  # milliseconds
        cpu += stages.apply(i).executorCpuTime()  # nanoseconds
    return cpu / 1e6 / run if run else None


def diagnose(cpu: float | None) -> dict[str, object]:
    """Which side holds a run up, by the share of their time in which tasks are on a core: parsing is work for cores, reading and writing waits."""
    if cpu is None:
        return {"bottleneck": "Unknown", "confidence": 0.0}
    if cpu > CPU_HIGH:
        return {"bottleneck": "Parser", "confidence": 0.7}
    if cpu < CPU_LOW:
        return {"bottleneck": "Writer", "confidence": 0.7}
    return {"bottleneck": "Balanced", "confidence": 0.5}


class Progress:
    """Logs how far the running stages are, once an interval, while a run goes on."""

    def __init__(self, spark, log: logging.Logger, interval: float):
        self.tracker, self.log, self.interval = spark.sparkContext.statusTracker(), log, interval
        self._stop = threading.Event()
        self._thread = threading.Thread(target=self._run, daemon=True)

    def lines(self) -> list[str]:
        found = ((s, self.tracker.getStageInfo(s)) for s in self.tracker.getActiveStageIds())
        return [f"stage {s}: {i.numCompletedTasks} of {i.numTasks} tasks, {i.numActiveTasks} running, {i.numFailedTasks} failed" for s, i in found if i]

    def _run(self) -> None:
        while not self._stop.wait(self.interval):
            for line in self.lines():
                self.log.info(line)

    def __enter__(self) -> Progress:
        self._thread.start()
        return self

    def __exit__(self, *_: object) -> None:
        self._stop.set()
        self._thread.join(timeout=5)


def environment() -> dict[str, object]:
    return {"os": platform.system(), "arch": platform.machine(), "cpus": os.cpu_count(), "hostname": platform.node(), "python": platform.python_version()}


@dataclass
class RunReport:
    run_id: str
    status: str
    started: str
    finished: str
    error: str | None = None
    environment: dict = field(default_factory=environment)
    performance: dict = field(default_factory=dict)
    resources: dict = field(default_factory=dict)
    bottleneck: dict = field(default_factory=dict)
    counters: dict = field(default_factory=dict)
    failures: dict = field(default_factory=dict)

    def save(self, path: str | Path) -> None:
        Path(path).write_text(to_yaml(asdict(self)))


def make_report(run: RunContext, counters: dict[str, int], sampler: ResourceSampler, error: str | None = None, failures: dict[str, str] | None = None, cpu: float | None = None) -> RunReport:
    now = datetime.now(UTC)
    seconds = (now - run.started).total_seconds()
    marks = sampler.high_water_marks()
    rate = counters.get("entries", 0) / seconds if seconds > 0 else 0.0
    return RunReport(run.run_id, "Error" if error else "Success", run.started.isoformat(), now.isoformat(), error, performance={"elapsed_seconds": seconds, "entries_per_second": rate}, resources=marks, bottleneck=diagnose(cpu), counters=counters, failures=failures or {})


def summary_lines(counters: dict[str, int], seconds: float) -> list[str]:
    """A run in a few lines, for console and log."""
    lines = [f"elapsed: {seconds:.1f} s"] + [f"{k}: {v}" for k, v in counters.items()]
    if counters.get("ptm_attempted"):
        lines.append(f"modifications mapped: {100 * counters['ptm_mapped'] / counters['ptm_attempted']:.1f} %")
    return lines


def recorded(run: RunContext, work: Callable[[], dict[str, int]], on_log: logging.Logger | None = None, cpu: Callable[[], float | None] = lambda: None) -> dict[str, int]:
    """Runs work and writes the report, whether work succeeds or not."""
    sampler = ResourceSampler().start()
    counters: dict[str, int] = {}
    error = None
    try:
        counters = work()
        return counters
    except Exception as e:
        error = f"{type(e).__name__}: {e}".splitlines()[0][:2000]
        raise
    finally:
        sampler.stop()
        report = make_report(run, counters, sampler, error, cpu=cpu())
        report.save(run.report_path)
        for line in summary_lines(counters, report.performance["elapsed_seconds"]) if on_log else []:
            on_log.info(line)

"""Runs, retention, settings, diagnosis."""

import pytest

from isoforge.config import Settings, load_settings
from isoforge.errors import InvalidValueError, IoError, MissingFieldError
from isoforge.ledger import Progress, ResourceSampler, RunContext, checked_run_id, clean_up, cpu_share, diagnose, make_report


def test_run_ids():
    assert checked_run_id(" a-1 ") == "run_a-1" and checked_run_id("run_b") == "run_b"
    for bad in ("", "  ", "a/b", "a\\b", "..", "a b"):
        with pytest.raises(InvalidValueError):
            checked_run_id(bad)


def test_run_folder(tmp_path):
    r = RunContext(tmp_path)
    assert r.run_id.startswith("run_") and r.path.is_dir()
    assert (r.report_path.name, r.log_path.name, r.snapshot_path.name) == ("report.yaml", "etl.log", "config_snapshot.yaml")
    with pytest.raises(IoError):
        RunContext(tmp_path, now=r.started)
    (tmp_path / "run_x" / "profiles").mkdir(parents=True)
    assert RunContext(tmp_path, "x").run_id == "run_x"
    (tmp_path / "run_x" / "report.yaml").write_text("")
    with pytest.raises(IoError):
        RunContext(tmp_path, "x")


def test_retention(tmp_path):
    for i in range(5):
        (tmp_path / f"run_{i}").mkdir()
    (tmp_path / "other").mkdir()
    assert clean_up(tmp_path, 2) == ["run_0", "run_1", "run_2"]
    assert sorted(p.name for p in tmp_path.iterdir()) == ["other", "run_3", "run_4"]
    assert clean_up(tmp_path / "none", 2) == []


def test_diagnosis(spark):
    assert [diagnose(x)["bottleneck"] for x in (0.8, 0.2, 0.5, None)] == ["Parser", "Writer", "Balanced", "Unknown"]
    spark.range(100_000).selectExpr("sum(sqrt(id))").collect()
    assert 0 < cpu_share(spark) < 1.5


def test_progress(spark):
    import logging
    import time

    class Held(logging.Handler):
        lines: list[str] = []

        def emit(self, record):
            self.lines.append(record.getMessage())

    log = logging.getLogger("progress")
    log.setLevel(logging.INFO)
    log.addHandler(Held())
    with Progress(spark, log, 0.02):
        spark.sparkContext.parallelize(range(4), 4).foreach(lambda _: time.sleep(0.5))
    assert any("of 4 tasks" in x for x in Held.lines)


def test_sampler_and_report(tmp_path):
    s = ResourceSampler(0.01).start()
    sum(range(3_000_000))
    s.stop()
    assert s.samples and s.high_water_marks()["max_rss_mb"] > 0
    r = make_report(RunContext(tmp_path), {"entries": 5}, s, "it broke")
    r.save(tmp_path / "r.yaml")
    text = (tmp_path / "r.yaml").read_text()
    assert "status: Error" in text and "it broke" in text


def test_settings(tmp_path):
    assert load_settings(tmp_path / "none.yaml").performance.batch_size == 10_000
    with pytest.raises(MissingFieldError):
        Settings().input()
    p = tmp_path / "c.yaml"
    p.write_text("version: '1.0'\nstorage:\n  input_path: in.xml\nperformance:\n  zstd_level: 9\nunknown: 1\n")
    s = load_settings(p).with_arguments(output_path="o.parquet", batch_size=5).resolved("/base")
    assert (s.storage.input_path, s.storage.output_path, s.performance.zstd_level, s.performance.batch_size, s.runs.keep_runs) == ("/base/in.xml", "/base/o.parquet", 9, 5, 10)
    s.save(tmp_path / "snapshot.yaml")
    assert load_settings(tmp_path / "snapshot.yaml").performance.zstd_level == 9
    p.write_text("storage: [")
    with pytest.raises(InvalidValueError):
        load_settings(p)
    p.write_text("version: '9'\n")
    assert load_settings(p).version == "9"

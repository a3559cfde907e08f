"""python -m isoforge.cli: one recorded run."""

from __future__ import annotations

import argparse

from pyspark import SparkConf
from pyspark.sql import SparkSession

from isoforge.config import Settings, load_settings
from isoforge.plans.etl import run


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="isoforge", description="XML protein entries to one nested Parquet table")
    p.add_argument("-c", "--config")
    p.add_argument("-i", "--input")
    p.add_argument("-o", "--output")
    p.add_argument("-b", "--batch-size", type=int)
    p.add_argument("--fasta-sidecar")
    p.add_argument("--run-id")
    return p


def main(argv: list[str] | None = None) -> dict[str, int]:
    a = parser().parse_args(argv)
    settings = load_settings(a.config).with_arguments(a.input, a.output, a.batch_size, a.fasta_sidecar).resolved()
    return run(session(settings), settings, a.run_id)


def session(settings: Settings) -> SparkSession:
    """A session by the settings: what spark-submit sets wins over threads and folders given here."""
    p, s = settings.performance, settings.storage
    conf = SparkConf()
    given = {"spark.local.dir": s.temp_dir, "spark.hadoop.io.file.buffer.size": str(p.buffer_size), "spark.reducer.maxReqsInFlight": str(p.channel_capacity)}
    if p.thread_count > 1:
        given["spark.master"] = f"local[{p.thread_count}]"
    for key, value in given.items():
        if not conf.contains(key):
            conf.set(key, value)
    return SparkSession.builder.appName("isoforge").config(conf=conf).getOrCreate()


if __name__ == "__main__":
    main()

"""Generic profile job: CSV or JSON in -> audit columns -> same format out."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from ledgerline.operators.profile import profile_csv_frame, profile_json_frame
from ledgerline.session import build_session
from ledgerline.sinks.writers import write_any
from ledgerline.sources.files import read_any


def profile_frame(spark: SparkSession, input_path: str, fmt: str = "csv",
                  processed_at=None):
    fmt = fmt.lower()
    df = read_any(spark, input_path, fmt)
    if fmt == "json":
        return profile_json_frame(df, processed_at)
    return profile_csv_frame(df, processed_at)


def run_profile(spark: SparkSession, input_path: str, output_path: str,
                fmt: str = "csv", processed_at=None, files: int | None = None) -> None:
    """Profile ``input_path`` and overwrite ``output_path`` in the same format.

    ``files`` squeezes the output to that many files on request only.
    """
    out = profile_frame(spark, input_path, fmt, processed_at)
    write_any(out, output_path, fmt.lower(), files)


def main(argv: list[str] | None = None) -> None:
    """``profile_job INPUT OUTPUT [csv|json]``."""
    args = argparse.ArgumentParser(prog="profile_job")
    args.add_argument("input")
    args.add_argument("output")
    args.add_argument("fmt", nargs="?", default="csv", type=str.lower)
    a = args.parse_args(argv)
    run_profile(build_session(app_name="profile"), a.input, a.output, a.fmt)


if __name__ == "__main__":
    main()

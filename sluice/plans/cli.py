"""Command line of the health job, for ``spark-submit``."""

from __future__ import annotations

import argparse
import shlex
import sys
from collections.abc import Sequence

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from sluice.context import Run, resolve_business_date
from sluice.domains import vehicles as domain
from sluice.plans.health import MAX_REJECT_RATE, RawTables, Result, run_health, staging_folder
from sluice.sinks.files import FORMAT_OPTIONS, WRITE_MODES, remove_folder, stage
from sluice.sources.archives import check_archives, list_members, read_archived_csv
from sluice.sources.files import input_path, join_path, read_raw_csv, stored_bytes


def parse_args(argv: Sequence[str] | None = None) -> argparse.Namespace:
    """The job's arguments; one quoted string holding all of them works too."""
    words = list(sys.argv[1:] if argv is None else argv)
    if len(words) == 1 and words[0].strip().startswith("-"):
        words = shlex.split(words[0])
    parser = argparse.ArgumentParser(description="Curate one date of vehicle health data.")
    parser.add_argument(
        "--input", required=True, help="zip file or glob, or a folder of CSV files, or <root>/{date} for the archive of the date"
    )
    parser.add_argument("--output", required=True, help="root folder of the published tables")
    parser.add_argument("--business-date", type=resolve_business_date, help="default: today in UTC")
    parser.add_argument("--run-id", help="name of the run; a repeated append of the same run takes the place of its first try")
    parser.add_argument("--write-format", choices=sorted(FORMAT_OPTIONS), default="parquet")
    parser.add_argument("--write-mode", choices=WRITE_MODES, default="overwrite")
    parser.add_argument("--csv-delimiter", default=",")
    parser.add_argument("--max-reject-rate", type=float, default=MAX_REJECT_RATE)
    parser.add_argument("--database", help="catalog database to register the tables in")
    parser.add_argument(
        "--publish-failed-report", action="store_true", help="write the report of a failed run"
    )
    parser.add_argument(
        "--check-header", action="store_true", help="stop at a header that differs from the declared columns"
    )
    parser.add_argument("--keep-staged", action="store_true", help="leave the run's intermediate tables")
    return parser.parse_args(words)


def open_inputs(
    spark: SparkSession, path: str, sep: str, business_date: str, check_header: bool = False, folder: str | None = None
) -> RawTables:
    """The four raw tables out of archives or a folder of CSV files.

    ``{date}`` at the end of a path stands for the archive of the run's date.  With a ``folder`` the
    tables of contents are read once and staged there.
    """
    specs = {
        "telemetry": domain.TELEMETRY,
        "service": domain.SERVICE,
        "vehicles": domain.VEHICLES,
        "dealers": domain.DEALERS,
    }
    if path.endswith("{date}"):
        path = input_path(path[: -len("{date}")], business_date)
    if path.lower().endswith(".zip"):
        # A few rows per archive, asked for several times.
        members = list_members(spark, path)
        if folder is not None:
            members = stage(members, folder, "members")
        check_archives(members, [s.file_name for s in specs.values()])
        frames = {
            name: read_archived_csv(spark, members, s.file_name, s.columns, sep, check_header)
            for name, s in specs.items()
        }
        return RawTables(
            **frames,
            order_by=dict.fromkeys(specs, ("source_zip", "line_no")),
            input_bytes=members.agg(F.sum("bytes")).first()[0],
        )
    frames = {
        name: read_raw_csv(spark, join_path(path, s.file_name), s.columns, s.file_name, sep, check_header)
        for name, s in specs.items()
    }
    files = [join_path(path, s.file_name) for s in specs.values()]
    return RawTables(**frames, input_bytes=stored_bytes(spark, files))


def main(argv: Sequence[str] | None = None) -> Result:
    args = parse_args(argv)
    spark = SparkSession.builder.appName("sluice-health").getOrCreate()
    source = args.input.rstrip("/").rsplit("/", 1)[-1]
    run = Run.start(args.business_date, source, args.run_id)
    folder = staging_folder(spark, run)
    # What a run of the same name left behind when it failed.
    remove_folder(spark, folder)
    raw = open_inputs(spark, args.input, args.csv_delimiter, run.business_date, args.check_header, folder)
    result = run_health(
        spark,
        raw,
        args.output,
        run,
        args.write_mode,
        args.write_format,
        args.max_reject_rate,
        args.database,
        args.publish_failed_report,
        keep_staged=args.keep_staged,
    )
    for name, value in result.counts.items():
        print(f"{name}: {value}")
    print(f"published {run.business_date} to {result.output}")
    return result


if __name__ == "__main__":
    main()

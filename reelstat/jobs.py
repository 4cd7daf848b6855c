"""Jobs for ``spark-submit`` or ``python -m reelstat.jobs``: curate, report, ingest."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from reelstat import schemas, sinks, sources
from reelstat.plans.curate import curate
from reelstat.plans.reports import write_reports
from reelstat.session import build_session, clear_scratch, sized_conf
from reelstat.streaming import ingest_landing


def run_curate(
    spark: SparkSession,
    landing: list[str],
    table: str,
    wide: bool = False,
    provider: str = "parquet",
    mode: str = "append",
) -> None:
    """Documents of all landing paths into the curated table, in one job and one commit."""
    write = {
        "append": sinks.append_curated,
        "partitions": sinks.overwrite_partitions,
        "reload": sinks.reload_curated,
    }[mode]
    sinks.create_curated(spark, table, wide, provider)
    docs = sources.read_landing(spark, landing, schemas.landing_for_curate())
    write(curate(docs, wide), table)


def run_report(spark: SparkSession, table: str, prefix: str = "") -> dict[str, str]:
    """The four report tables from the curated table."""
    return write_reports(spark.table(table), prefix)


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="reelstat.jobs")
    parser.add_argument("--conf", action="append", default=[], metavar="KEY=VALUE")
    parser.add_argument("--input-gb", type=float, help="size of the input, to set partitions by")
    parser.add_argument("--cores", type=int, default=200, help="cores of the cluster")
    jobs = parser.add_subparsers(dest="job", required=True)

    job = jobs.add_parser("curate", help="landing documents to the curated table")
    job.add_argument("--landing", nargs="+", required=True)
    job.add_argument("--table", required=True)
    job.add_argument("--wide", action="store_true")
    job.add_argument("--provider", default="parquet")
    job.add_argument("--mode", choices=["append", "partitions", "reload"], default="append")

    job = jobs.add_parser("report", help="curated table to the report tables")
    job.add_argument("--table", required=True)
    job.add_argument("--prefix", default="")

    job = jobs.add_parser("ingest", help="files landed since the last run to the curated table")
    for name in ["landing", "table", "checkpoint"]:
        job.add_argument(f"--{name}", required=True)
    cleaning = job.add_mutually_exclusive_group()
    cleaning.add_argument("--archive")
    cleaning.add_argument("--delete", action="store_true")
    job.add_argument("--quarantine", help="folder for lines that are no documents")
    job.add_argument("--wide", action="store_true")
    return parser


def main(argv: list[str] | None = None) -> None:
    options = vars(_parser().parse_args(argv))
    conf = dict(pair.split("=", 1) for pair in options.pop("conf"))
    input_gb, cores = options.pop("input_gb"), options.pop("cores")
    if input_gb:
        conf = {**sized_conf(int(input_gb * 1e9), cores), **conf}
    job = options.pop("job")
    spark = build_session(f"reelstat-{job}", conf=conf)
    if job == "curate":
        run_curate(spark, **options)
    elif job == "report":
        run_report(spark, **options)
    else:
        ingest_landing(spark, **options)


if __name__ == "__main__":
    main()
    clear_scratch(SparkSession.active())

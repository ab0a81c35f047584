"""Job to hand to spark-submit: compare the tables of a manifest and write report and results."""

import argparse

from pyspark.sql import SparkSession

from countersign.plans.report import write_report
from countersign.plans.run import TIMEOUT_S, WORKERS, run
from countersign.sources.catalog import table_metadata
from countersign.sources.manifest import read_manifest


def main() -> None:
    parser = argparse.ArgumentParser(prog="countersign", description=__doc__)
    parser.add_argument("--manifest", required=True, help="text with one table name per line")
    parser.add_argument("--output", required=True, help="folder for report and result tables")
    parser.add_argument("--left-catalog", required=True, help="catalog that knows the left copies' locations")
    parser.add_argument("--left-format", default="parquet", help="storage format of the left copies")
    parser.add_argument("--workers", type=int, default=WORKERS, help="tables compared at a time")
    parser.add_argument("--timeout", type=float, default=TIMEOUT_S, help="seconds per table")
    parser.add_argument("--pt-start", help="first partition, included")
    parser.add_argument("--pt-end", help="last partition, included")
    parser.add_argument("--run-id", help="a name for the run; a second job of that name and output resumes it")
    parser.add_argument("--together-below", type=int, default=0, help="tables of fewer bytes share jobs")
    args = parser.parse_args()

    spark = SparkSession.builder.appName("countersign").getOrCreate()

    def lookup(session: SparkSession, name: str):
        return table_metadata(session, ".".join([args.left_catalog, *name.split(".")[-2:]]))

    result = run(
        spark, read_manifest(spark, args.manifest), lookup=lookup, left_format=args.left_format, workers=args.workers,
        timeout_s=args.timeout, start=args.pt_start, end=args.pt_end, out=args.output,
        run_id=args.run_id, together_below=args.together_below,
    )
    write_report(result, f"{args.output.rstrip('/')}/report")
    verdicts = result.tables.orderBy("line_no").select("table_name", "status", "n_diffs", "elapsed_s")
    verdicts.show(max(verdicts.count(), 1), truncate=False)  # a short row per manifest line
    result.runs.show(truncate=False)
    spark.stop()


if __name__ == "__main__":
    main()

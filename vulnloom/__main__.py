"""The jobs, for spark-submit or ``python -m vulnloom``.

    index    listing pages to the sorted id list
    collect  ids and pages to new rows of the dataset
    stream   page files to new rows of the dataset, as they arrive
    import   a CSV dataset to go on from
    export   the dataset as CSV
    report   the analytics tables of the dataset
"""

import argparse

from vulnloom import schema
from vulnloom.operators import analytics
from vulnloom.operators.typed import typed
from vulnloom.plans.build_index import build_index
from vulnloom.plans.collect import collect, export_csv, import_csv, read_advisories
from vulnloom.session import build_session
from vulnloom.sources.id_list import read_id_list
from vulnloom.sources.pages import read_listing_pages, read_page_files, read_pages
from vulnloom.streaming.ingest import ingest, page_file_stream, page_stream


def index(spark, args):
    run = build_index(
        read_listing_pages(spark, args.listing), args.ids, args.target, args.first_year,
        args.last_year, args.prefix,
    )
    for name in ("years", "totals", "preview"):
        getattr(run, name).show(50, truncate=False)


def collect_pages(spark, args):
    read = read_page_files if args.files else read_pages
    ids, pages = read_id_list(spark, args.ids), read(spark, args.pages)
    collect(ids, pages, args.lake, args.run, args.target).show(truncate=False)


def stream(spark, args):
    read = page_file_stream if args.files else page_stream
    trigger = {"processingTime": args.every} if args.every else {}
    pages = read(spark, args.pages, maxFilesPerTrigger=args.files_per_batch)
    ingest(pages, args.lake, args.checkpoint, **trigger).awaitTermination()


def import_(spark, args):
    import_csv(spark, args.csv, args.lake, args.keep_bad)


def export(spark, args):
    export_csv(spark, args.lake, args.csv)


def report(spark, args):
    raw = read_advisories(spark, args.lake)
    view = typed(raw)
    tables = {
        "profile": analytics.profile(raw, approximate=args.approximate),
        "severity": analytics.severity_distribution(view),
        "scores_by_version": analytics.score_summary(view, "cvss_version"),
        "scores_by_ecosystem": analytics.score_summary(view, "ecosystem"),
        "score_histogram": analytics.score_histogram(view),
        "weaknesses": analytics.top_weaknesses(view, args.top),
        "ecosystems": analytics.ecosystem_counts(view),
        "packages": analytics.top_packages(view, args.top),
        "trend": analytics.monthly_trend(view),
        "vector_metrics": analytics.metric_counts(view),
        "fixes": analytics.fix_share(view),
    }
    for name, table in tables.items():
        table.write.mode("overwrite").parquet(f"{args.out}/{name}")


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(
        prog="vulnloom", description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter
    )
    p.add_argument("--master", help="left to spark-submit unless given")
    jobs = p.add_subparsers(required=True)

    def job(name, run, *paths):
        sub = jobs.add_parser(name)
        sub.set_defaults(job=run)
        for path in paths:
            sub.add_argument(f"--{path}", required=True)
        return sub

    sub = job("index", index, "listing", "ids")
    sub.add_argument("--target", type=int, help="stop at this many ids; no limit unless given")
    sub.add_argument("--first-year", type=int, default=schema.FIRST_YEAR)
    sub.add_argument("--last-year", type=int, default=schema.LAST_YEAR)
    sub.add_argument("--prefix", default=schema.LISTING_PREFIX)

    sub = job("collect", collect_pages, "ids", "pages", "lake")
    sub.add_argument("--run", type=int, required=True, help="number of this run")
    sub.add_argument("--target", type=int, help="stop at this many rows; no limit unless given")
    sub.add_argument("--files", action="store_true", help="pages are HTML files, not Parquet")

    sub = job("stream", stream, "pages", "lake", "checkpoint")
    sub.add_argument("--every", help="a trigger interval; land what is there and end unless given")
    sub.add_argument("--files", action="store_true", help="pages are HTML files, not Parquet")
    sub.add_argument("--files-per-batch", type=int, default=10_000)

    sub = job("import", import_, "csv", "lake")
    sub.add_argument("--keep-bad", action="store_true", help="set records that do not fit aside instead of stopping")
    job("export", export, "lake", "csv")

    sub = job("report", report, "lake", "out")
    sub.add_argument("--top", type=int, default=10)
    sub.add_argument("--approximate", action="store_true", help="estimate distinct values")
    return p


def main(argv=None):
    args = parser().parse_args(argv)
    args.job(build_session(master=args.master), args)


if __name__ == "__main__":
    main()

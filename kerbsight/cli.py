"""Command line: ``python -m kerbsight.cli survey|preview``.  Exit code 2 on errors."""

from __future__ import annotations

import argparse
import sys

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession

from . import schemas
from .operators import preview, shortlist, survey
from .sources import documents, http, recorded


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="kerbsight")
    sub = top.add_subparsers(dest="command", required=True)
    s = sub.add_parser("survey", help="candidates around a target")
    s.add_argument("--site")
    s.add_argument("--lat", type=float)
    s.add_argument("--lon", type=float)
    s.add_argument("--radius-m", type=float, default=500.0)
    s.add_argument("--limit", type=int, default=2000)
    s.add_argument("--endpoint", default=schemas.ENDPOINT)
    s.add_argument("--pages", help="recorded search pages instead of the network")
    s.add_argument("--output")
    p = sub.add_parser("preview", help="thumbnails of a shortlist")
    p.add_argument("--survey", required=True)
    p.add_argument("--output-dir", required=True)
    p.add_argument("--max", dest="max_items", type=int, default=shortlist.MAX_ITEMS)
    p.add_argument("--per-sequence", type=int, default=shortlist.PER_SEQUENCE)
    p.add_argument("--timeout-s", type=float, default=30.0)
    return top


def run_survey(spark: SparkSession, args: argparse.Namespace) -> tuple[DataFrame, dict]:
    """Ordered candidates, stored for the passes over them, and the head of their document."""
    latitude, longitude = recorded.target_of(args.lat, args.lon, args.site)
    target = survey.Target(latitude, longitude, args.radius_m)
    survey.positive(limit=args.limit)
    license_id = license_url = None
    if args.pages:
        pages = recorded.pages(spark, args.pages)
    else:
        texts = http.provider_documents(http.client, args.endpoint)
        row = spark.createDataFrame([texts], "conf string, landing string")
        license_id, license_url = row.select(survey.licenses(row.conf, row.landing).alias("x")).select("x.*").first()
        spark.dataSource.register(http.SearchSource)
        pages = spark.read.format("picture_search").options(latitude=latitude, longitude=longitude, radius_m=args.radius_m, limit=args.limit, endpoint=args.endpoint).load()
    rows = survey.survey(pages, target, limit=args.limit, endpoint=args.endpoint, license_id=license_id, license_url=license_url)
    rows = rows.cache()
    return rows, documents.survey_head(rows, target, endpoint=args.endpoint, license_id=license_id, license_url=license_url)


def run_preview(spark: SparkSession, args: argparse.Namespace) -> dict:
    found = recorded.survey_document(spark, args.survey)
    top = shortlist.shortlist(found, max_items=args.max_items, per_sequence=args.per_sequence)
    top = spark.createDataFrame(top.collect(), top.schema)  # fetched once, at most max_items rows
    answers = http.fetch(top, timeout=args.timeout_s).cache()
    return documents.write_preview(preview.judge(top, answers), args.output_dir, source=args.survey, max_items=args.max_items, per_sequence=args.per_sequence)


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    spark = SparkSession.builder.appName("kerbsight").getOrCreate()
    try:
        if args.command == "survey":
            rows, head = run_survey(spark, args)
            text = documents.survey_text(rows, head)
            if args.output:
                documents.write_text(args.output, text)
                told, classes = head["summary"], head["summary"]["view_class_counts"]
                views = f"{classes['front']} front views, {classes['panoramic']} panoramas, target in view in {told['target_in_fov_counts']['true']}"
                print(f"{args.output}: {head['candidate_count']} candidates in {told['sequence_count']} sequences; {views}")
            else:
                sys.stdout.writelines(text)
            rows.unpersist()
        else:
            m = run_preview(spark, args)
            print(f"{args.output_dir}: {m['downloaded_count']} of {m['selected_count']} thumbnails")
    except (OSError, ValueError, http.ProviderError, PySparkException) as exc:
        print(f"kerbsight {args.command} failed: {exc}", file=sys.stderr)
        return 2
    return 0


if __name__ == "__main__":
    raise SystemExit(main())

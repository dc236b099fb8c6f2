"""Command line for the scheduled jobs (use with spark-submit or python -m).

  python -m gazette clean  --in LANDING --out CLEANED --scorecard JSON_DIR [--run-ts TS]
  python -m gazette hourly --lake ROOT --source PARQUET [--ts TS]
  python -m gazette marts  --lake ROOT [--as-of TS] [--blocking CHECK[:MODEL.COLUMN] ...]
  python -m gazette snapshot --lake ROOT [--ts TS]
  python -m gazette report --lake ROOT --ts TS --out JSON_DIR
  python -m gazette scrape --lake ROOT --pages PARQUET
  python -m gazette delete --lake ROOT --ids PARQUET [--ts TS]

The master and resources come from spark-submit; the shared folder for
intermediate tables is read from ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json

from pyspark.sql import functions as F

from gazette import schemas as S
from gazette.plans import jobs
from gazette.plans.publish import write_audit_publish
from gazette.session import get_session
from gazette.sources import tables as TB


def _ts(text: str | None) -> dt.datetime:
    return dt.datetime.fromisoformat(text) if text else dt.datetime.now(dt.UTC).replace(tzinfo=None)


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="gazette")
    sub = ap.add_subparsers(dest="cmd", required=True)
    c = sub.add_parser("clean", help="clean one landed batch and score it")
    c.add_argument("--in", dest="input_path", required=True)
    c.add_argument("--out", dest="output_path", required=True)
    c.add_argument("--scorecard", dest="scorecard_path", required=True)
    c.add_argument("--run-ts")
    h = sub.add_parser("hourly", help="one incremental ingestion run")
    h.add_argument("--lake", required=True)
    h.add_argument("--source", required=True)
    h.add_argument("--ts")
    m = sub.add_parser("marts", help="build, audit and publish the marts")
    m.add_argument("--lake", required=True)
    m.add_argument("--as-of")
    m.add_argument("--blocking", nargs="*", help="checks whose failure stops the publish (default: all of severity error)")
    n = sub.add_parser("snapshot", help="one Type 2 snapshot of the deduplicated model")
    n.add_argument("--lake", required=True)
    n.add_argument("--ts")
    r = sub.add_parser("report", help="one run's rows per category next to the totals")
    r.add_argument("--lake", required=True)
    r.add_argument("--ts", required=True)
    r.add_argument("--out", dest="output_path", required=True)
    f = sub.add_parser("scrape", help="upsert feed pages (feed_id, page, payload) into the source")
    f.add_argument("--lake", required=True)
    f.add_argument("--pages", required=True)
    d = sub.add_parser("delete", help="hard-delete ids and log them")
    d.add_argument("--lake", required=True)
    d.add_argument("--ids", required=True)
    d.add_argument("--ts")
    args = ap.parse_args(argv)

    spark = get_session(app=f"gazette-{args.cmd}")
    if args.cmd == "clean":
        run_ts = _ts(args.run_ts)
        landed = TB.read_loose(spark, args.input_path, S.ARTICLE)
        cleaned, sc = jobs.run_clean(spark, landed, args.output_path, run_ts)
        TB.write_json(sc, args.scorecard_path)
        print(json.dumps(sc.first().asDict(), default=str))      # one row
    elif args.cmd == "hourly":
        lake = jobs.Lake(args.lake)
        res = jobs.hourly_run(spark, lake, TB.read_parquet(spark, args.source, S.ARTICLE), _ts(args.ts))
        if res.loaded:
            jobs.snapshot_run(spark, lake, jobs.build_models(spark, lake).deduped, res.loaded[-1])
        print(json.dumps({"landed": res.landed, "since": str(res.since), "loaded": [str(t) for t in res.loaded]}))
    else:
        lake = jobs.Lake(args.lake)
        if args.cmd == "marts":
            res = write_audit_publish(jobs.build_models(spark, lake), lake.marts, F.lit(_ts(args.as_of)).cast("timestamp_ntz"),
                                      set(args.blocking) if args.blocking is not None else None)
            print(json.dumps({"published": res.published}))
        elif args.cmd == "snapshot":
            history = jobs.snapshot_run(spark, lake, jobs.build_models(spark, lake).deduped, _ts(args.ts))
            print(json.dumps({"history": history.count()}))
        elif args.cmd == "report":
            TB.write_json(jobs.report_run(spark, lake, _ts(args.ts)), args.output_path)
        elif args.cmd == "scrape":
            print(json.dumps({"upserted": jobs.scrape_run(spark, lake, spark.read.parquet(args.pages))}))
        else:
            jobs.delete_articles(spark, lake, spark.read.parquet(args.ids), _ts(args.ts))


if __name__ == "__main__":
    main()

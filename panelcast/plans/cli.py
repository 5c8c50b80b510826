"""Command-line entry over the jobs (for ``spark-submit`` or ``python -m``).

    python -m panelcast.plans.cli preprocess --root R --sales S.csv --products P.csv --towns T.csv
    python -m panelcast.plans.cli train      --root R [--val-week 9] [--rounds 1500] [--weeks-per-job K]
    python -m panelcast.plans.cli evaluate   --root R [--val-week 9]
    python -m panelcast.plans.cli infer      --root R --requests TEST.csv --out SUBMISSION_DIR

``train`` exits with status 1 when the boosted model does not beat the
lag-1 baseline on the validation week (the acceptance rule). Cluster
settings come from ``spark-submit``; nothing here sets a master.
"""

from __future__ import annotations

import argparse
import json
import sys

from ..config import GBM_NUM_ROUNDS, VAL_WEEK
from ..operators import summaries
from ..session import build_session
from ..sources import files
from . import jobs


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="panelcast")
    sub = p.add_subparsers(dest="cmd", required=True)
    pre = sub.add_parser("preprocess")
    pre.add_argument("--root", required=True)
    pre.add_argument("--sales", required=True)
    pre.add_argument("--products", required=True)
    pre.add_argument("--towns", required=True)
    tr = sub.add_parser("train")
    tr.add_argument("--root", required=True)
    tr.add_argument("--val-week", type=int, default=VAL_WEEK)
    tr.add_argument("--rounds", type=int, default=GBM_NUM_ROUNDS)
    tr.add_argument("--no-quantiles", action="store_true")
    tr.add_argument("--weeks-per-job", type=int, default=None)
    ev = sub.add_parser("evaluate")
    ev.add_argument("--root", required=True)
    ev.add_argument("--val-week", type=int, default=VAL_WEEK)
    inf = sub.add_parser("infer")
    inf.add_argument("--root", required=True)
    inf.add_argument("--requests", required=True)
    inf.add_argument("--out", required=True)
    for s in (pre, tr, ev, inf):
        s.add_argument("--master", default=None, help="only for local runs")
    return p


def main(argv: list[str] | None = None) -> int:
    args = _parser().parse_args(argv)
    spark = build_session(args.master)
    art = jobs.Artifacts(args.root)
    if args.cmd == "preprocess":
        sales = files.load_sales_csv(spark, args.sales)
        products, towns, _ = files.load_dimensions(spark, args.products, args.towns)
        jobs.run_preprocess(sales, products, towns, art)
        print(json.dumps({"store": art.store}))
        return 0
    if args.cmd == "train":
        res = jobs.run_training(spark, art, val_week=args.val_week, num_rounds=args.rounds,
                                with_quantiles=not args.no_quantiles,
                                weeks_per_job=args.weeks_per_job)
        print(json.dumps({k: v for k, v in res.items() if k != "feature_cols"}, default=float))
        return 0 if res["accepted"] else 1
    if args.cmd == "evaluate":
        print(json.dumps(jobs.run_evaluation(spark, art, val_week=args.val_week), default=float))
        return 0
    if args.cmd == "infer":
        sub = jobs.run_inference(spark, art, files.load_score_csv(spark, args.requests), args.out)
        summary = summaries.prediction_summary(sub).first().asDict()
        print(json.dumps({"rows": sub.count(), "out": args.out, **summary}, default=float))
        return 0
    return 2


if __name__ == "__main__":
    sys.exit(main())

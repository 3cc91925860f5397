"""Command line: ``python -m clickloom <job> [--option value ...]``; options are the arguments of the job."""

from __future__ import annotations

import argparse
import inspect
import json
import sys
from dataclasses import fields

from pyspark.sql import SparkSession

from clickloom.operators.train import BoostParams
from clickloom.plans import jobs
from clickloom.sources.tables import check_data, data_paths

JOBS = {
    "preprocess": jobs.preprocess,
    "day7-features": jobs.day7_features,
    "seq-bucket-delta": jobs.seq_bucket_delta,
    "history-features": jobs.history_features,
    "day7-flags": jobs.day7_flags,
    "downsample": jobs.downsample,
    "baseline": jobs.baseline,
    "train": jobs.train_and_calibrate,
    "tune": jobs.tune,
    "score": jobs.score_table,
    "eda-report": jobs.eda_report,
}


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="clickloom", description=__doc__)
    sub = top.add_subparsers(dest="job", required=True)
    sub.add_parser("check-data", help="rows and columns of the configured tables")
    for name, job in JOBS.items():
        options = sub.add_parser(name, help=(job.__doc__ or "").splitlines()[0])
        for p in list(inspect.signature(job).parameters.values())[1:]:
            kind = str(p.annotation)
            if kind.startswith("PreprocessConfig"):
                continue
            if kind.startswith("BoostParams"):
                boost = options.add_argument_group("boosting", "options that are left out keep the job's defaults")
                for f in fields(BoostParams):
                    boost.add_argument("--" + f.name.replace("_", "-"), type=type(f.default), dest=f"{p.name}.{f.name}")
                continue
            flag = "--" + p.name.replace("_", "-")
            convert = int if kind.startswith("int") else float if kind.startswith("float") else str
            if kind.startswith("Sequence"):
                options.add_argument(flag, nargs="*", default=p.default)
            elif p.default is inspect.Parameter.empty:
                options.add_argument(flag, type=convert, required=True)
            else:
                options.add_argument(flag, type=convert, default=p.default)
    return top


def job_arguments(args: dict) -> dict:
    """Options as arguments of the job; those of the boosting group become one :class:`BoostParams`."""
    plain = {k: v for k, v in args.items() if "." not in k}
    boost = {k: v for k, v in args.items() if "." in k and v is not None}
    for k, v in boost.items():
        group, name = k.split(".")
        plain.setdefault(group, {})[name] = v
    return {k: BoostParams(**v) if isinstance(v, dict) else v for k, v in plain.items()}


def main(argv: list[str] | None = None) -> None:
    args = vars(parser().parse_args(argv))
    job = args.pop("job")
    spark = SparkSession.builder.appName(f"clickloom-{job}").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    if job == "check-data":
        check_data(spark, data_paths()).show(truncate=False)
        return
    result = JOBS[job](spark, **job_arguments(args))
    if isinstance(result, dict):
        print(json.dumps(result, indent=2, default=str))
    elif result is not None:
        print(result)


if __name__ == "__main__":
    main(sys.argv[1:])

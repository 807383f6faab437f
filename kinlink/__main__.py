"""Command line: python -m kinlink block | train | predict | validate. Sources and results are tab-separated files."""

from __future__ import annotations

import argparse
import sys
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from kinlink import config
from kinlink.operators import matching, validate
from kinlink.plans import linkage
from kinlink.sources import tables


def parser() -> argparse.ArgumentParser:
    out = argparse.ArgumentParser(prog="kinlink", description=__doc__)
    jobs = out.add_subparsers(dest="job", required=True)
    for name, what in (("block", "candidates of every S1 record and their metrics"), ("train", "a model and its threshold"), ("predict", "both result files"), ("validate", "checks of result files; exit code 1 if there are errors")):
        job = jobs.add_parser(name, help=what)
        needed = name != "validate"
        job.add_argument("--s1", required=needed, help="the S1 source")
        job.add_argument("--pool", nargs="+", required=needed, help="the other sources")
        if needed:
            job.add_argument("--out", required=True, help="folder for the results")
        if name in ("block", "train"):
            job.add_argument("--truth", required=True, help="the true matches")
        if name == "block":
            job.add_argument("--config", choices=["A", "B", "C"], default="A")
        if name == "train":
            job.add_argument("--validation", required=True, help="S1 ids, one a line, that choose the threshold")
            job.add_argument("--trees", type=int, default=350)
        if name == "predict":
            job.add_argument("--model", help="a trained model; without it a fixed linear score")
            job.add_argument("--threshold", type=float, help="that of the model, or 0.5")
        if name == "validate":
            job.add_argument("matching")
            job.add_argument("--candidates")
    return out


def union(spark: SparkSession, paths: list[str]) -> DataFrame:
    return reduce(DataFrame.unionByName, (tables.read_source(spark, p) for p in paths))


def block(spark: SparkSession, args: argparse.Namespace) -> int:
    s1, pool = linkage.prepared(tables.read_source(spark, args.s1), union(spark, args.pool))
    truth, _ = tables.read_truth(spark, args.truth)
    found = linkage.block(s1, pool, getattr(config, f"CONFIG_{args.config}"), truth, pool.count())
    tables.write_tsv(matching.id_lists(s1, found.pairs, "cand_pos", "candidate_entity_ids"), f"{args.out}/candidate_pairs.tsv")
    tables.write_report([("Blocking", found.metrics)], f"{args.out}/report", spark)
    return 0


def train(spark: SparkSession, args: argparse.Namespace) -> int:
    s1, pool = linkage.prepared(tables.read_source(spark, args.s1), union(spark, args.pool))
    truth, _ = tables.read_truth(spark, args.truth)
    model, threshold, curve = linkage.train(s1, pool, truth, tables.read_id_list(spark, args.validation), args.trees)
    matching.save(model, args.out, threshold)
    tables.write_report([("Thresholds", curve.orderBy("tau"))], f"{args.out}/report", spark)
    return 0


def predict(spark: SparkSession, args: argparse.Namespace) -> int:
    model, said = matching.load(args.model) if args.model else (None, {"optimal_threshold": 0.5})
    source = tables.read_source(spark, args.s1)
    found = linkage.infer(*linkage.prepared(source, union(spark, args.pool)), model, said["optimal_threshold"] if args.threshold is None else args.threshold)
    tables.write_results(tables.with_position(source), *found, args.out)
    return 0


def check(spark: SparkSession, args: argparse.Namespace) -> int:
    s1 = tables.read_ids(spark, args.s1) if args.s1 else None
    known = reduce(DataFrame.unionByName, (tables.read_ids(spark, p) for p in args.pool)) if args.pool else None
    report = validate.validate(spark, args.matching, args.candidates, s1, known)
    for kind, said in (("error", report.errors), ("warning", report.warnings), ("info", [f"{k} {v}" for k, v in report.info.items()])):
        for x in said:
            print(f"{kind}: {x}")
    return 0 if report.ok else 1


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    spark = SparkSession.builder.appName("kinlink").getOrCreate()
    return {"block": block, "train": train, "predict": predict, "validate": check}[args.job](spark, args)


if __name__ == "__main__":
    sys.exit(main())

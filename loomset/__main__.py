"""Command line: ``spark-submit`` this module, or ``python -m loomset <command>``."""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from loomset.functions.templates import template_names
from loomset.operators.compare import RESULT_SCHEMA, evaluation_summaries
from loomset.operators.unify import FORMATS
from loomset.operators.validate import MAX_LENGTH, MIN_LENGTH, report_summary
from loomset.plans.evaluate import compare_models, evaluate_model
from loomset.plans.prepare import Prepared, prepare_dataset, prepare_training_set, split_sizes_of
from loomset.session import build_session
from loomset.sources.readers import load, read_split


def _source(spark: SparkSession, args: argparse.Namespace) -> str | DataFrame:
    """A path, or one split of a named table given as ``<root>/<name>``."""
    if not args.split:
        return args.source
    root, _, name = args.source.rstrip("/").rpartition("/")
    return read_split(spark, root or ".", name, args.split)


def _reader_options(args: argparse.Namespace) -> dict:
    """What was asked of the reader of ``--source``; a split of a table has no options."""
    given = {"schema": args.schema, "quarantine": args.quarantine or None, "multi_line": False if args.plain_csv else None}
    options = {k: v for k, v in given.items() if v is not None}
    if options and args.split:
        raise SystemExit("--split takes no reader options")
    return options


def _show(job: Prepared) -> None:
    for name, value in job.stats.first().asDict().items():
        print(f"{name}: {value}")
    print(report_summary(job.reasons).first()["summary"])
    for row in split_sizes_of(job.rows).orderBy("split").collect():
        print(f"{row['split']}: {row['n']} samples")
    job.release()


def _prepare(spark: SparkSession, args: argparse.Namespace) -> None:
    options = _reader_options(args)
    _show(
        prepare_dataset(
            spark,
            _source(spark, args),
            reader_options=options,
            layout=args.format,
            template=args.template or "alpaca",
            min_len=args.min_len,
            max_len=args.max_len,
            ratios=(args.train_ratio, args.val_ratio, args.test_ratio),
            seed=args.seed,
            stratify=args.stratify,
            out=args.output_dir,
        )
    )


def _training(spark: SparkSession, args: argparse.Namespace) -> None:
    options = _reader_options(args)
    _show(prepare_training_set(spark, _source(spark, args), reader_options=options, template=args.template, out=args.output_dir))


def _evaluate(spark: SparkSession, args: argparse.Namespace) -> None:
    rows = evaluate_model(
        load(spark, args.dataset),
        load(spark, args.scored),
        model_name=args.model,
        dataset_name=args.dataset_name or args.dataset,
        pairs=load(spark, args.pairs) if args.pairs else None,
        answers=load(spark, args.answers) if args.answers else None,
        out=args.output_dir,
    )
    print(evaluation_summaries(rows).first()["summary"])


def _compare(spark: SparkSession, args: argparse.Namespace) -> None:
    results = [spark.read.schema(RESULT_SCHEMA).json(path) for path in args.results]
    job = compare_models(*results, dataset_name=args.dataset_name)
    for row in job.summary.orderBy("part", "pos", "no").toLocalIterator():
        print(row["line"])


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="loomset", description=__doc__)
    commands = top.add_subparsers(dest="command", required=True)

    def source_command(name: str, run) -> argparse.ArgumentParser:
        command = commands.add_parser(name)
        command.set_defaults(run=run)
        command.add_argument("--source", required=True, help="JSON list, JSON Lines, CSV or parquet")
        command.add_argument("--split", help="read this split of a table partitioned by split")
        command.add_argument("--schema", help="fields of JSON, e.g. 'instruction string, output string'; found in the files by default")
        command.add_argument("--quarantine", action="store_true", help="leave broken JSON out instead of failing")
        command.add_argument("--plain-csv", action="store_true", help="cells of the CSV hold no line breaks")
        command.add_argument("--template", choices=template_names())
        command.add_argument("--output-dir", default="data/processed")
        return command

    prepare = source_command("prepare", _prepare)
    prepare.add_argument("--format", choices=FORMATS, help="layout; detected from the columns by default")
    prepare.add_argument("--train-ratio", type=float, default=0.9)
    prepare.add_argument("--val-ratio", type=float, default=0.05)
    prepare.add_argument("--test-ratio", type=float, default=0.05)
    prepare.add_argument("--min-len", type=int, default=MIN_LENGTH)
    prepare.add_argument("--max-len", type=int, default=MAX_LENGTH)
    prepare.add_argument("--seed", type=int, default=42)
    prepare.add_argument("--stratify", help="column whose shares every split keeps")
    source_command("training-set", _training)

    evaluate = commands.add_parser("evaluate")
    evaluate.set_defaults(run=_evaluate)
    evaluate.add_argument("--model", required=True, help="name to report")
    evaluate.add_argument("--dataset", required=True)
    evaluate.add_argument("--dataset-name", default="")
    evaluate.add_argument("--scored", required=True, help="table of (loss, num_tokens)")
    evaluate.add_argument("--pairs", help="table of (prediction, reference)")
    evaluate.add_argument("--answers", help="table of (generated_text, expected)")
    evaluate.add_argument("--output-dir", default="outputs/eval")

    compare = commands.add_parser("compare")
    compare.set_defaults(run=_compare)
    compare.add_argument("results", nargs="+", help="eval_results folders, the base model first")
    compare.add_argument("--dataset-name", default="")
    return top


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    args = parser().parse_args(argv)
    args.run(spark or build_session(), args)


if __name__ == "__main__":
    main()

"""Search learning rate and momentum on a labelled Parquet table: ``python -m kilnwork.cli.search --data ...``."""

from __future__ import annotations

import argparse
import json

from pyspark.sql import functions as F

from kilnwork.operators import async_halving, sampling, search, training
from kilnwork.session import build_session
from kilnwork.sources import tables


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.ArgumentDefaultsHelpFormatter)
    p.add_argument("--data", required=True, help="Parquet table with a key, a feature array and a label")
    p.add_argument("--key", default="id")
    p.add_argument("--features", default="features")
    p.add_argument("--label", default="label")
    p.add_argument("--model", default="conv", choices=("conv", "linear"))
    p.add_argument("--mode", default="minibatch", choices=("minibatch", "full"))
    p.add_argument("--scheduler", default="sync", choices=("sync", "async"), help="whether trials wait for the others at a rung")
    p.add_argument("--checkpoint-path")
    p.add_argument("--resume", action="store_true")
    p.add_argument("--smoke-test", action="store_true", help="one trial, five iterations")
    return p


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    spark = build_session("search")
    rows = tables.parquet(spark, args.data).select(args.key, args.features, args.label)
    shape = rows.agg(F.max(args.label).alias("k"), F.max(F.size(args.features)).alias("d")).first()
    classes = shape["k"] + 1
    if args.model == "conv":
        trainable: training.Trainable = training.ConvClassifier(side=round(shape["d"] ** 0.5), classes=classes)
    else:
        trainable = training.SoftmaxRegression(shape["d"], classes)
    result = search.run_search(
        sampling.split_train_test(rows, args.key),
        search.param_space(spark, search.SMOKE_TRIALS if args.smoke_test else search.NUM_TRIALS),
        trainable,
        key=args.key,
        features=args.features,
        label=args.label,
        mode=args.mode,
        max_iterations=search.SMOKE_ITERATIONS if args.smoke_test else search.MAX_ITERATIONS,
        checkpoint_path=args.checkpoint_path,
        resume=args.resume,
        rule=async_halving.arrival_rule() if args.scheduler == "async" else None,
    )
    best = result.best.first()
    print(json.dumps({"best": best.asDict() if best else None}))
    result.check_errors()


if __name__ == "__main__":
    main()

"""Score a tree of image files: ``python -m kilnwork.cli.predict --uri s3a://bucket/images/ --models-dir ...``."""

from __future__ import annotations

import argparse
import json

from pyspark.sql import DataFrame, SparkSession, functions as F

from kilnwork.functions import text
from kilnwork.operators import batches, images, models, rollups, scoring
from kilnwork.session import build_session
from kilnwork.sinks import predictions as sink
from kilnwork.sources import files

SMOKE_BATCH = 4


def effective_batch_size(batch_size: int, smoke_test: bool) -> int:
    return min(batch_size, SMOKE_BATCH) if smoke_test else batch_size


def predict_images(
    spark: SparkSession,
    uri: str,
    registry: models.ModelRegistry,
    model_name: str = "resnet50",
    batch_size: int = 32,
    num_gpus: float = 1.0,
    access_key: str | None = None,
    secret_key: str | None = None,
    session_token: str | None = None,
    endpoint: str | None = None,
    on_error: str = "zero",
) -> DataFrame:
    """Predictions for every image file below ``uri``."""
    loader = registry.loader(model_name)  # an unknown name fails before anything is read
    uri, anonymous = files.resolve_uri(uri)
    store = None
    if uri.startswith("s3a://"):
        store = files.s3a_options(access_key, secret_key, session_token, endpoint, anonymous)
    # Spark plans at least one split for each core, so compressed files are dealt out and pixels stay where they are.
    return scoring.score(
        images.flatten_images(files.scan_images(spark, uri, store)),
        loader,
        images.image_features(),
        batch_size=batch_size,
        on_error=on_error,
        profile=batches.gpu_profile(num_gpus),
    )


def sample_rows(rows: DataFrame, n: int = 5) -> DataFrame:
    """A few predictions, with scores as text of four decimals."""
    return rows.limit(n).select(
        text.basename(F.col("file_path")).alias("name"),
        F.col("predicted_class").alias("best"),
        text.fixed4(F.col("confidence_score")).alias("score"),
        F.col("top_5_classes").alias("ranked"),
        F.transform("top_5_scores", text.fixed4).alias("ranked_scores"),
    )


def parser() -> argparse.ArgumentParser:
    # The names and defaults of the options are the interface.
    p = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.ArgumentDefaultsHelpFormatter)
    p.add_argument("--uri", required=True, help="folder of image files, on any file system Spark reads")
    p.add_argument("--models-dir", required=True, help="folder with one <model name>.onnx file per model")
    p.add_argument("--model-name", default="resnet50", choices=models.IMAGE_MODELS)
    p.add_argument("--access-key")
    p.add_argument("--secret-key")
    p.add_argument("--session-token")
    p.add_argument("--endpoint")
    p.add_argument("--batch-size", type=int, default=64)
    p.add_argument("--num-gpus", type=float, default=0.0)
    p.add_argument("--output-path", default="./predictions", help="a .csv, .json or .parquet path, or a folder")
    p.add_argument("--write-mode", default="errorifexists", choices=("errorifexists", "overwrite", "append"))
    p.add_argument("--sample-size", type=int, default=5)
    p.add_argument("--smoke-test", action="store_true", help="use small batches")
    return p


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    spark = build_session("predict")
    registry = models.ModelRegistry()
    path, anonymous = files.resolve_uri(f"{args.models_dir.rstrip('/')}/{args.model_name}.onnx")
    registry.register(args.model_name, models.onnx_loader(spark, path, _store(args, path, anonymous)))
    rows = predict_images(
        spark,
        args.uri,
        registry,
        args.model_name,
        effective_batch_size(args.batch_size, args.smoke_test),
        args.num_gpus,
        args.access_key,
        args.secret_key,
        args.session_token,
        args.endpoint,
    )
    # Written once; the count and the sample come from what was written, not from scoring again.
    sink.write_predictions(rows, args.output_path, args.write_mode)
    written = sink.read_predictions(spark, args.output_path, rows.schema)
    tree, anonymous = files.resolve_uri(args.uri)
    found = files.inventory(spark, tree, _store(args, tree, anonymous))  # metadata only
    counts = rollups.stage_counts(found, text.is_image(F.col("key")), written)
    failed = written.agg(F.count("error").alias("unreadable"))
    print(json.dumps(counts.first().asDict() | failed.first().asDict()))
    for line in sample_rows(written, args.sample_size).toJSON().collect():
        print(line)


def _store(args: argparse.Namespace, path: str, anonymous: bool) -> dict[str, str] | None:
    if not path.startswith("s3a://"):
        return None
    return files.s3a_options(args.access_key, args.secret_key, args.session_token, args.endpoint, anonymous)


if __name__ == "__main__":
    main()

"""Scoring, evaluation, tensor functions and sinks."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F

from kilnwork.functions import tensor, text
from kilnwork.operators import batches, blocked, evaluation, images, models, sampling, scoring, training
from kilnwork.plans.inputs import samples, table
from kilnwork.session import scratch_path
from kilnwork.sinks import predictions

_BATCH = 4096


def mean_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One mean vector per label, as the weights of a linear model."""
    return scoring.class_means(samples(spark, sf_dir), "embedding", "label")


def mean_model(spark: SparkSession, sf_dir: str) -> models.LinearModel:
    return models.linear_model(mean_weights(spark, sf_dir))


def with_path(rows: DataFrame) -> DataFrame:
    return rows.withColumn("path", F.concat(F.lit("vectors/"), F.col("vec_id").cast("string")))


def _scored(spark: SparkSession, sf_dir: str, *keep: str, rows: DataFrame | None = None) -> DataFrame:
    """Scores by the mean vectors."""
    rows = samples(spark, sf_dir) if rows is None else rows
    return scoring.score_linear(
        with_path(rows).select("vec_id", "path", "embedding", *keep),
        mean_weights(spark, sf_dir),
        features="embedding",
        keep=["vec_id", *keep],
    )


def flat_predictions(df: DataFrame, *extra: str) -> DataFrame:
    """Predictions with one column per rank, as the oracle returns them."""
    return df.select(
        "vec_id",
        *extra,
        "predicted_class",
        F.round("confidence_score", 4).alias("confidence_score"),
        F.array_join(F.col("top_5_classes").cast("array<string>"), ",").alias("top_5_classes"),
        *[F.round(F.get("top_5_scores", F.lit(i)), 4).alias(f"score_{i + 1}") for i in range(5)],
        "file_path",
    )


def batch_inference(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flat_predictions(_scored(spark, sf_dir))


def score_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = samples(spark, sf_dir)
    weights = mean_weights(spark, sf_dir)
    scored = scoring.score_linear(rows, weights, features="embedding", path=None, keep=["vec_id"])
    ranked = scored.select("vec_id", F.posexplode(F.arrays_zip("top_5_classes", "top_5_scores")).alias("at", "top"))
    return ranked.select(
        "vec_id",
        (F.col("at") + 1).alias("position"),
        F.col("top.top_5_classes").alias("class_id"),
        F.round("top.top_5_scores", 4).alias("score"),
    )


def score_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same scores by a join of rows and weights, in blocks of three classes and sixteen positions."""
    rows = with_path(samples(spark, sf_dir)).select("vec_id", "path", "embedding")
    scored = blocked.score_join(
        rows, mean_weights(spark, sf_dir), features="embedding", keep=["vec_id"], block_rows=500, block_classes=3, block_positions=16
    )
    return flat_predictions(scored)


def score_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same scores where the weights of only three classes fit a broadcast."""
    width = samples(spark, sf_dir).select(F.size("embedding").alias("d")).first()["d"]
    with models.broadcast_limit(3 * 8 * (width + 1)):
        return batch_inference(spark, sf_dir)


def softmax(spark: SparkSession, sf_dir: str) -> DataFrame:
    probs = samples(spark, sf_dir).select("vec_id", F.posexplode(tensor.softmax(F.col("embedding"))))
    return probs.select("vec_id", F.col("pos").alias("class_id"), F.round("col", 6).alias("probability"))


def top5(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranked = samples(spark, sf_dir).select("vec_id", F.posexplode(tensor.top_k(tensor.softmax(F.col("embedding")))))
    return ranked.select(
        "vec_id", (F.col("pos") + 1).alias("position"), "col.class_id", F.round("col.score", 6).alias("score")
    )


def argmax_conf(spark: SparkSession, sf_dir: str) -> DataFrame:
    probs = tensor.softmax(F.col("embedding"))
    return (
        samples(spark, sf_dir)
        .select("vec_id", tensor.let(probs, lambda p: F.struct(tensor.argmax(p), F.array_max(p))).alias("best"))
        .select(
            "vec_id",
            F.col("best.col1").alias("predicted_class"),
            F.round("best.col2", 6).alias("confidence_score"),
        )
    )


def sample_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Inputs are cut to the sample before scoring, so only the sampled rows are scored.
    first = samples(spark, sf_dir).orderBy("vec_id").limit(5)
    scored = _scored(spark, sf_dir, rows=first)
    return scored.select(
        text.basename(F.col("file_path")).alias("file_name"),
        "predicted_class",
        text.fixed4(F.col("confidence_score")).alias("confidence"),
        F.array_join(F.col("top_5_classes").cast("array<string>"), ", ").alias("top_5_classes"),
        F.array_join(F.transform("top_5_scores", text.fixed4), ", ").alias("top_5_scores"),
    )


def error_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    broken = samples(spark, sf_dir).withColumn("embedding", F.when(F.col("vec_id") % 50 != 0, F.col("embedding")))
    scored = _scored(spark, sf_dir, rows=broken)
    return scored.select(
        "vec_id",
        "predicted_class",
        F.round("confidence_score", 4).alias("confidence_score"),
        F.col("error").isNotNull().alias("failed"),
    )


def model_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two models from the registry over the same rows in one pass."""
    plain = mean_model(spark, sf_dir)
    nearest = models.LinearModel(plain.weights, -0.5 * (plain.weights**2).sum(axis=1))
    registry = models.ModelRegistry(declared=())
    registry.register("means", models.broadcast_loader(spark, plain))
    registry.register("nearest", models.broadcast_loader(spark, nearest))
    scored = scoring.score_variants(
        samples(spark, sf_dir).select("vec_id", "embedding"),
        {name: registry.loader(name) for name in ("means", "nearest")},
        scoring.vector_features("embedding", plain.weights.shape[1]),
        keep=["vec_id"],
        batch_size=_BATCH,
    )
    return scored.select(
        "model_name", "vec_id", "predicted_class", F.round("confidence_score", 4).alias("confidence_score")
    )


def eval_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = _scored(spark, sf_dir, "label")
    return evaluation.accuracy(scored).withColumn("accuracy", F.round("accuracy", 6))


def eval_accuracy_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    targets = samples(spark, sf_dir).select("vec_id", "label")
    paired = evaluation.pair_with_targets(_scored(spark, sf_dir), targets, "vec_id")
    return evaluation.accuracy(paired).withColumn("accuracy", F.round("accuracy", 6))


def nll_loss(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = mean_model(spark, sf_dir)
    rows = scoring.score_logits(
        samples(spark, sf_dir).select("label", "embedding"),
        models.broadcast_loader(spark, model),
        scoring.vector_features("embedding", model.weights.shape[1]),
        keep=["label"],
    )
    return evaluation.mean_nll(rows, "logits").withColumn("mean_nll", F.round("mean_nll", 6))


def linear_layer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The linear layer and its log-softmax as column expressions."""
    model = mean_model(spark, sf_dir)
    logits = tensor.linear(F.col("embedding"), model.weights.tolist(), model.bias.tolist())
    logs = samples(spark, sf_dir).select("vec_id", F.posexplode(tensor.log_softmax(logits)))
    return logs.select("vec_id", F.col("pos").alias("class_id"), F.round("col", 6).alias("log_probability"))


def relu_norm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embeddings as four channels of sixteen values."""
    mean, std = (0.01, 0.02, -0.01, 0.0), (0.1, 0.2, 0.25, 0.5)
    values = F.arrays_zip(
        tensor.relu(F.col("embedding")).alias("relu"),
        tensor.normalise(F.col("embedding"), mean, std, plane=16).alias("norm"),
        tensor.normalise(F.col("embedding"), [0.1307], [0.3081]).alias("norm_one"),
    )
    rows = samples(spark, sf_dir).select("vec_id", F.posexplode(values).alias("pos", "v"))
    return rows.select(
        "vec_id",
        "pos",
        F.round("v.relu", 6).alias("relu"),
        F.round("v.norm", 6).alias("norm"),
        F.round("v.norm_one", 6).alias("norm_one"),
    )


def _roundtrip(suffix: str):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        path = scratch_path(spark, "predictions") + suffix
        scored = _scored(spark, sf_dir)
        predictions.write_predictions(scored, path)
        return flat_predictions(predictions.read_predictions(spark, path, scored.schema))

    return run


def text_sizes(batch: pa.RecordBatch) -> pa.RecordBatch:
    texts = batch.column("text")
    return pa.RecordBatch.from_arrays(
        [batch.column("doc_id"), pc.utf8_length(texts), pc.binary_length(texts)],
        names=["doc_id", "characters", "utf8_bytes"],
    )


def etl_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    path = scratch_path(spark, "etl") + "/"
    sizes = batches.map_batches(docs, text_sizes, "doc_id long, characters int, utf8_bytes int")
    predictions.write_predictions(sizes, path)
    return spark.read.schema(sizes.schema).parquet(path)


def greeting(role: str, turn: int) -> str:
    return f"hello {role} {turn}"


def fanout(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    return batches.fanout(turns, greeting, "role", "turn").select("conv_id", "turn", "result")


def image_inference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as gray rasters 64 pixels wide, resized, normalised and scored on their channel means."""
    html = F.encode("html", "UTF-8")
    height = F.ceil(F.octet_length(html) / 64).cast("int")
    rasters = table(spark, sf_dir, "pages").select(
        "page_id",
        F.col("url").alias("path"),
        height.alias("height"),
        F.lit(64).alias("width"),
        F.lit(1).alias("channels"),
        F.rpad(html, height * 64, F.lit(b"\0")).alias("data"),
    )
    rasters = batches.spread(rasters)
    scored = scoring.score(rasters, ChannelMeans, images.image_features(), keep=["page_id"], batch_size=32)
    return scored.select(
        "page_id",
        "predicted_class",
        F.round("confidence_score", 4).alias("confidence_score"),
        "file_path",
        F.col("error").isNotNull().alias("failed"),
    )


class ChannelMeans:
    """Brightness of each channel as its logit."""

    def logits(self, batch):
        return batch.mean(axis=(2, 3), dtype=np.float64)


_CONV = training.ConvClassifier(side=8)


def conv_inference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embeddings as 8x8 inputs of the small convolutional network."""
    scored = scoring.score(
        samples(spark, sf_dir).select("vec_id", "embedding"),
        models.broadcast_loader(spark, _CONV.model(_CONV.initial([0])[0])),
        scoring.vector_features("embedding", 64),
        keep=["vec_id"],
        batch_size=_BATCH,
    )
    return scored.select("vec_id", "predicted_class", F.round("confidence_score", 4).alias("confidence_score"))


def split_train_test(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sampling.split_train_test(samples(spark, sf_dir).select("vec_id", "label"), "vec_id")
    return sampling.shuffle_rows(rows, "vec_id", seed="order").select("vec_id", "label", "is_test")


def _epoch(name: str, key: str, cap: int):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = table(spark, sf_dir, name).select(key)
        return sampling.epoch_sample(rows, key, cap)

    return run


QUERIES = {
    "batch_inference": batch_inference,
    "score_sql": score_sql,
    "score_blocks": score_blocks,
    "score_join": score_join,
    "softmax": softmax,
    "top5": top5,
    "argmax_conf": argmax_conf,
    "sample_predictions": sample_predictions,
    "error_fallback": error_fallback,
    "model_variants": model_variants,
    "eval_accuracy": eval_accuracy,
    "eval_accuracy_join": eval_accuracy_join,
    "nll_loss": nll_loss,
    "linear_layer": linear_layer,
    "relu_norm": relu_norm,
    "sink_parquet_roundtrip": _roundtrip(".parquet"),
    "sink_json_roundtrip": _roundtrip(".json"),
    "sink_csv_roundtrip": _roundtrip(".csv"),
    "etl_map": etl_map,
    "fanout": fanout,
    "image_inference": image_inference,
    "conv_inference": conv_inference,
    "split_train_test": split_train_test,
    "epoch_sample": _epoch("embeddings", "vec_id", sampling.EPOCH_CAP),
    "epoch_sample_test_pass": _epoch("documents", "doc_id", sampling.TEST_CAP),
}

_LOGITS = """
x AS (SELECT vec_id, label, unnest(embedding)::DOUBLE AS v, unnest(range(len(embedding))) AS pos FROM embeddings),
w AS (SELECT label AS class_id, pos, avg(v) AS weight FROM x GROUP BY 1, 2),
z AS (SELECT x.vec_id, x.label, w.class_id, sum(x.v * w.weight) AS logit FROM x JOIN w USING (pos) GROUP BY 1, 2, 3)
"""
_RANKED = """
e AS (SELECT *, exp(logit - max(logit) OVER (PARTITION BY {key})) AS power FROM z),
s AS (SELECT *, power / sum(power) OVER (PARTITION BY {key}) AS score FROM e),
r AS (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY score DESC, class_id) AS position FROM s)
"""
_BY_VEC = _RANKED.format(key="vec_id")
_SOFTMAX = """
z AS (SELECT vec_id, unnest(embedding)::DOUBLE AS logit, unnest(range(len(embedding)))::INT AS class_id FROM embeddings)
"""
PREDICTIONS_SQL = f"""
WITH {_LOGITS}, {_BY_VEC}
SELECT vec_id,
       max(CASE WHEN position = 1 THEN class_id END) AS predicted_class,
       round(max(score), 4) AS confidence_score,
       string_agg(class_id::VARCHAR, ',' ORDER BY position) AS top_5_classes,
       {', '.join(f"round(max(CASE WHEN position = {i} THEN score END), 4) AS score_{i}" for i in range(1, 6))},
       'vectors/' || vec_id AS file_path
FROM r WHERE position <= 5 GROUP BY vec_id
"""
_ACCURACY = f"""
WITH {_LOGITS}, {_BY_VEC}
SELECT count(*) FILTER (class_id = label) AS correct, count(*) AS total,
       round(count(*) FILTER (class_id = label) / count(*), 6) AS accuracy
FROM r WHERE position = 1
"""


def _epoch_sql(name: str, key: str, rows: int) -> str:
    return f"""
    WITH o AS (SELECT {key}, row_number() OVER (ORDER BY md5('epoch-' || {key}), {key}) - 1 AS n FROM {name})
    SELECT {key}, (n // {sampling.BATCH_SIZE})::INT AS batch_index FROM o WHERE n < {rows}
    """


def _conv_sql() -> str:
    """The network with its parameters as a list: 3x9 kernels, 3 biases, 10x12 weights, 10 biases."""
    flat = ", ".join(repr(float(v)) for v in _CONV.initial([0])[0])
    return f"""
    WITH p AS (SELECT '[{flat}]'::DOUBLE[] AS p),
    x AS (SELECT vec_id, unnest(embedding)::DOUBLE AS v, unnest(range(64)) AS pos FROM embeddings),
    k AS (SELECT f, a, b, p[f * 9 + a * 3 + b + 1] AS w FROM p, range(3) t(f), range(3) u(a), range(3) v(b)),
    m AS (SELECT vec_id, f, pos // 8 - a AS i, pos % 8 - b AS j, sum(v * w) AS m FROM x, k
          WHERE pos // 8 - a BETWEEN 0 AND 5 AND pos % 8 - b BETWEEN 0 AND 5 GROUP BY 1, 2, 3, 4),
    h AS (SELECT vec_id, f * 4 + (i // 3) * 2 + j // 3 AS hidden, greatest(max(m) + any_value(p[28 + f]), 0.0) AS h
          FROM m, p GROUP BY vec_id, f, i // 3, j // 3),
    z AS (SELECT vec_id, class_id::INT AS class_id, sum(h * p[30 + class_id * 12 + hidden + 1])
                 + any_value(p[150 + class_id + 1]) AS logit FROM h, p, range(10) c(class_id) GROUP BY 1, 2),
    {_BY_VEC}
    SELECT vec_id, class_id AS predicted_class, round(score, 4) AS confidence_score FROM r WHERE position = 1
    """


# Pages as rasters: both directions are enlarged, so every pixel has two sources (the same one at an edge).
_IMAGE = f"""
WITH g AS (SELECT page_id, url, hex(encode(html)) AS bytes, ceil(octet_length(encode(html)) / 64)::INT AS height FROM pages),
d AS (SELECT *, CASE WHEN height <= 64 THEN 256 ELSE 256 * height // 64 END AS rows_out,
             CASE WHEN height <= 64 THEN 256 * 64 // height ELSE 256 END AS columns_out FROM g),
q AS (SELECT height AS size, rows_out AS target FROM d UNION SELECT 64, columns_out FROM d),
c AS (SELECT *, (round_even((target - 224) / 2, 0) + o + 0.5) * size / target AS centre, o FROM q, range(224) t(o)),
a AS (SELECT *, greatest(floor(centre - 0.5), 0)::INT AS s0, least(floor(centre + 0.5), size - 1)::INT AS s1 FROM c),
w AS (SELECT size, target, o, s0, s1, CASE WHEN s0 = s1 THEN 1.0 ELSE 1 - abs(s0 + 0.5 - centre) END AS w0,
             CASE WHEN s0 = s1 THEN 0.0 ELSE 1 - abs(s1 + 0.5 - centre) END AS w1 FROM a),
u AS (SELECT size, target, min(s0) AS low, max(s1) AS high FROM w GROUP BY 1, 2),
b AS (SELECT page_id, r, [coalesce(try_cast('0x' || bytes[(r * 64 + x) * 2 + 1 : (r * 64 + x) * 2 + 2] AS INT), 0)
                          FOR x IN range(64)] AS line
      FROM (SELECT page_id, bytes, unnest(range(low, high + 1)) AS r FROM d JOIN u ON size = height AND target = rows_out)),
h AS (SELECT page_id, o, list(floor(line[s0 + 1] * w0 + line[s1 + 1] * w1 + 0.5) ORDER BY r) AS line
      FROM b JOIN d USING (page_id) JOIN w ON size = 64 AND target = columns_out GROUP BY 1, 2),
m AS (SELECT page_id, avg(floor(line[s0 - low + 1] * w0 + line[s1 - low + 1] * w1 + 0.5)) / 255 AS mean
      FROM h JOIN d USING (page_id) JOIN w ON size = height AND target = rows_out JOIN u USING (size, target) GROUP BY 1),
z AS (SELECT page_id, class_id::INT AS class_id,
             (mean - ({list(images.CHANNEL_MEAN)})[class_id + 1]) / ({list(images.CHANNEL_STD)})[class_id + 1] AS logit
      FROM m, range(3) t(class_id)),
{_RANKED.format(key="page_id")}
SELECT page_id, class_id AS predicted_class, round(score, 4) AS confidence_score, url AS file_path, false AS failed
FROM r JOIN g USING (page_id) WHERE position = 1
"""

ORACLES = {
    "image_inference": _IMAGE,
    "conv_inference": _conv_sql(),
    "batch_inference": PREDICTIONS_SQL,
    "sink_parquet_roundtrip": PREDICTIONS_SQL,
    "sink_json_roundtrip": PREDICTIONS_SQL,
    "sink_csv_roundtrip": PREDICTIONS_SQL,
    "score_blocks": PREDICTIONS_SQL,
    "score_join": PREDICTIONS_SQL,
    "score_sql": f"""
        WITH {_LOGITS}, {_BY_VEC}
        SELECT vec_id, position::INT AS position, class_id, round(score, 4) AS score FROM r WHERE position <= 5
    """,
    "softmax": f"WITH {_SOFTMAX}, {_BY_VEC} SELECT vec_id, class_id, round(score, 6) AS probability FROM r",
    "top5": f"""
        WITH {_SOFTMAX}, {_BY_VEC}
        SELECT vec_id, position::INT AS position, class_id, round(score, 6) AS score FROM r WHERE position <= 5
    """,
    "argmax_conf": f"""
        WITH {_SOFTMAX}, {_BY_VEC}
        SELECT vec_id, class_id AS predicted_class, round(score, 6) AS confidence_score FROM r WHERE position = 1
    """,
    "sample_predictions": f"""
        WITH {_LOGITS}, {_BY_VEC}
        SELECT vec_id::VARCHAR AS file_name,
               max(CASE WHEN position = 1 THEN class_id END) AS predicted_class,
               printf('%.4f', max(score)) AS confidence,
               string_agg(class_id::VARCHAR, ', ' ORDER BY position) AS top_5_classes,
               string_agg(printf('%.4f', score), ', ' ORDER BY position) AS top_5_scores
        FROM r WHERE position <= 5 AND vec_id IN (SELECT vec_id FROM embeddings ORDER BY vec_id LIMIT 5)
        GROUP BY vec_id
    """,
    "error_fallback": f"""
        WITH {_LOGITS.replace("z AS", "z0 AS")},
        z AS (SELECT vec_id, class_id, CASE WHEN vec_id % 50 = 0 THEN 0.0 ELSE logit END AS logit FROM z0), {_BY_VEC}
        SELECT vec_id, class_id AS predicted_class, round(score, 4) AS confidence_score, vec_id % 50 = 0 AS failed
        FROM r WHERE position = 1
    """,
    "model_variants": f"""
        WITH {_LOGITS.replace("z AS", "z0 AS")},
        b AS (SELECT class_id, -0.5 * sum(weight * weight) AS bias FROM w GROUP BY 1),
        z AS (SELECT 'means' AS model_name, vec_id, class_id, logit FROM z0 UNION ALL
              SELECT 'nearest', vec_id, class_id, logit + bias FROM z0 JOIN b USING (class_id)),
        {_RANKED.format(key="model_name, vec_id")}
        SELECT model_name, vec_id, class_id AS predicted_class, round(score, 4) AS confidence_score
        FROM r WHERE position = 1
    """,
    "eval_accuracy": _ACCURACY,
    "eval_accuracy_join": _ACCURACY,
    "nll_loss": f"""
        WITH {_LOGITS}, {_BY_VEC}
        SELECT round(avg(-ln(score)), 6) AS mean_nll, count(*) AS rows FROM r WHERE class_id = label
    """,
    "linear_layer": f"""
        WITH {_LOGITS}, {_BY_VEC} SELECT vec_id, class_id, round(ln(score), 6) AS log_probability FROM r
    """,
    "relu_norm": """
        WITH x AS (SELECT vec_id, unnest(embedding)::DOUBLE AS v, unnest(range(len(embedding)))::INT AS pos
                   FROM embeddings)
        SELECT vec_id, pos, round(greatest(v, 0.0), 6) AS relu,
               round((v - ([0.01, 0.02, -0.01, 0.0]::DOUBLE[])[pos // 16 + 1])
                     / ([0.1, 0.2, 0.25, 0.5]::DOUBLE[])[pos // 16 + 1], 6) AS norm,
               round((v - 0.1307::DOUBLE) / 0.3081::DOUBLE, 6) AS norm_one
        FROM x
    """,
    "etl_map": """
        SELECT doc_id, length(text)::INT AS characters, octet_length(encode(text))::INT AS utf8_bytes FROM documents
    """,
    "fanout": "SELECT conv_id, turn, 'hello ' || role || ' ' || turn AS result FROM conversations",
    "split_train_test": "SELECT vec_id, label, left(md5('split-' || vec_id), 8) < '33333333' AS is_test FROM embeddings",
    "epoch_sample": _epoch_sql("embeddings", "vec_id", 576),
    "epoch_sample_test_pass": _epoch_sql("documents", "doc_id", 320),
}

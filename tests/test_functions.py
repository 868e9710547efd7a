import math

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from kilnwork.functions import draws, status, tensor, text
from kilnwork.operators import scoring


def one(spark, row, schema, column):
    return spark.createDataFrame([row], schema).select(column.alias("v")).first()["v"]


def test_softmax_and_log_softmax(spark):
    z = [1.0, 2.0, 3.0]
    p = one(spark, (z,), "z array<double>", tensor.softmax(F.col("z")))
    want = np.exp(z) / np.exp(z).sum()
    assert np.allclose(p, want)
    logs = one(spark, (z,), "z array<double>", tensor.log_softmax(F.col("z")))
    assert np.allclose(logs, np.log(want))


def test_softmax_does_not_overflow(spark):
    p = one(spark, ([1000.0, 0.0],), "z array<float>", tensor.softmax(F.col("z")))
    assert p == [1.0, 0.0]


def test_softmax_of_one_class(spark):
    assert one(spark, ([5.0],), "z array<float>", tensor.softmax(F.col("z"))) == [1.0]


def test_linear(spark):
    got = one(spark, ([1.0, 2.0],), "x array<float>", tensor.linear(F.col("x"), [[1, 2], [3, 4]], [0.5, -1]))
    assert got == [5.5, 10.0]


def test_relu_and_normalise(spark):
    assert one(spark, ([-1.0, 0.0, 2.0],), "x array<float>", tensor.relu(F.col("x"))) == [0.0, 0.0, 2.0]
    got = one(spark, ([1.0, 2.0, 3.0, 4.0],), "x array<double>", tensor.normalise(F.col("x"), [1, 3], [1, 2], plane=2))
    assert got == [0.0, 1.0, 0.0, 0.5]
    with pytest.raises(ValueError):
        tensor.normalise(F.col("x"), [1, 3], [1, 2])


def test_ties_go_to_the_lowest_class(spark):
    p = [0.2, 0.4, 0.4]
    assert one(spark, (p,), "p array<double>", tensor.argmax(F.col("p"))) == 1
    top = one(spark, (p,), "p array<double>", tensor.top_k(F.col("p"), 2))
    assert [(r["class_id"], r["score"]) for r in top] == [(1, 0.4), (2, 0.4)]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.lists(st.floats(-50, 50), min_size=6, max_size=6), min_size=1, max_size=8))
def test_probabilities_hold_together(logits):
    p = scoring.probabilities(np.array(logits))
    assert np.allclose(p.sum(axis=1), 1.0)
    assert (p >= 0).all()


@pytest.mark.parametrize(
    "path,image,kind",
    [
        ("a/b.jpg", True, "image"),
        ("a/b.JPEG", True, "none"),
        ("a/b.tiff", True, "none"),
        ("a/b.tif", False, "none"),
        ("a/b.gif", False, "none"),
        ("a/b.webp", True, "none"),
        ("a/b.txt", False, "text"),
        ("a/b.TXT", False, "none"),
        ("a/b.jpg\n", False, "none"),
        ("a/bjpg", False, "none"),
        (".png", True, "image"),
        ("", False, "none"),
    ],
)
def test_suffixes(spark, path, image, kind):
    assert one(spark, (path,), "p string", text.is_image(F.col("p"))) is image
    assert one(spark, (path,), "p string", text.preview_kind(F.col("p"))) == kind


def test_names_and_sizes(spark):
    assert one(spark, ("s3a://b/x/y.png",), "p string", text.basename(F.col("p"))) == "y.png"
    for size in (0, 1, 256, 768, 1024, 1100, 123456789):
        assert one(spark, (size,), "n long", text.size_kb(F.col("n"))) == f"{size / 1024:.1f} KB"
    for value in (0.0, 0.12344, 0.99999, 1.0):
        assert one(spark, (value,), "v double", text.fixed4(F.col("v"))) == f"{value:.4f}"


def test_preview_is_strict_utf8_and_counts_characters(spark):
    assert one(spark, (bytearray("é" * 600, "utf-8"),), "b binary", text.text_preview(F.col("b"))) == "é" * 500
    assert one(spark, (bytearray(b"ok \xff"),), "b binary", text.text_preview(F.col("b"))) is None


def test_log_tail(spark):
    log = "".join(chr(97 + i % 26) for i in range(3000))
    assert one(spark, (log,), "s string", text.log_tail(F.col("s"))) == log[-1024:]
    assert one(spark, ("short",), "s string", text.log_tail(F.col("s"))) == "short"
    assert one(spark, ("",), "s string", text.log_tail(F.col("s"))) == ""


def test_draws_stay_in_range_and_spread(spark):
    rows = spark.range(2000).select(
        draws.log_uniform(F.col("id"), 1e-4, 1e-2, "lr").alias("lr"), draws.uniform(F.col("id"), 0.1, 0.9, "m").alias("m")
    ).toPandas()
    assert rows["lr"].between(1e-4, 1e-2).all() and rows["m"].between(0.1, 0.9).all()
    assert abs(np.log10(rows["lr"]).mean() + 3) < 0.05
    assert abs(rows["m"].mean() - 0.5) < 0.02


def test_draw_of_known_hash(spark):
    import hashlib

    u = int(hashlib.md5(b"lr-7").hexdigest()[:8], 16) / 2**32
    want = math.exp(math.log(1e-4) + u * (math.log(1e-2) - math.log(1e-4)))
    assert math.isclose(one(spark, (7,), "id long", draws.log_uniform(F.col("id"), 1e-4, 1e-2, "lr")), want)


@pytest.mark.parametrize(
    "value,terminal,outcome",
    [("SUCCEEDED", True, "success"), ("FAILED", True, "failure"), ("STOPPED", True, "failure"), ("RUNNING", False, "pending")],
)
def test_status(spark, value, terminal, outcome):
    assert one(spark, (value,), "s string", status.is_terminal(F.col("s"))) is terminal
    assert one(spark, (value,), "s string", status.outcome(F.col("s"))) == outcome

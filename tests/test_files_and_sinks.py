import pytest
from pyspark.sql import functions as F, types as T

from kilnwork.session import materialise, scratch_path
from kilnwork.sinks import predictions
from kilnwork.sources import files

SCHEMA = T.StructType(
    [
        T.StructField("predicted_class", T.IntegerType()),
        T.StructField("confidence_score", T.DoubleType()),
        T.StructField("top_5_classes", T.ArrayType(T.IntegerType())),
        T.StructField("top_5_scores", T.ArrayType(T.DoubleType())),
        T.StructField("file_path", T.StringType()),
    ]
)


@pytest.mark.parametrize(
    "path,fmt",
    [
        ("x.parquet", "parquet"),
        ("x/", "parquet"),
        ("x.json/", "parquet"),
        ("x.json", "json"),
        ("x.csv", "csv"),
        ("x.CSV", "parquet"),
        ("x", "parquet"),
        ("csv", "parquet"),
    ],
)
def test_format_of_a_path(path, fmt):
    assert predictions.output_format(path) == fmt


@pytest.mark.parametrize("name", ["p.parquet", "p.json", "p.csv", "p/", "p"])
def test_roundtrip(spark, tmp_path, name):
    rows = [
        (1, 0.5, [1, 2], [0.5, 0.25], 'dir/a "quoted", name.png'),
        (2, 1e-17, [], [], "back\\slash"),
        (None, None, None, None, None),
        (3, 1.0, [7], [1.0], "ünï"),
    ]
    df = spark.createDataFrame(rows, SCHEMA).coalesce(1)
    path = str(tmp_path) + "/" + name
    predictions.write_predictions(df, path)
    got = predictions.read_predictions(spark, path, SCHEMA)
    assert sorted(map(repr, got.collect())) == sorted(map(repr, df.collect()))
    with pytest.raises(Exception, match="already exists"):
        predictions.write_predictions(df, path)
    predictions.write_predictions(df, path, mode="append")
    assert predictions.read_predictions(spark, path, SCHEMA).count() == 8


def make_tree(root):
    (root / "sub").mkdir()
    (root / "a.txt").write_bytes("é".encode() * 600)
    (root / "sub" / "b.json").write_bytes(b'{"x": 1}')
    (root / "sub" / "bad.csv").write_bytes(b"\xff\xfe")
    (root / "c.bin").write_bytes(bytes(range(256)))


def test_binary_scan_and_inventory(spark, tmp_path):
    make_tree(tmp_path)
    rows = {r["path"].rsplit("/", 1)[-1]: bytes(r["bytes"]) for r in files.scan_binary(spark, str(tmp_path)).collect()}
    assert set(rows) == {"a.txt", "b.json", "bad.csv", "c.bin"} and rows["c.bin"] == bytes(range(256))
    listing = files.describe_objects(files.inventory(spark, str(tmp_path)))
    found = {r["name"]: (r["size"], r["size_kb"], r["preview_kind"]) for r in listing.collect()}
    assert found == {
        "a.txt": (1200, "1.2 KB", "text"),
        "b.json": (8, "0.0 KB", "text"),
        "bad.csv": (2, "0.0 KB", "text"),
        "c.bin": (256, "0.2 KB", "none"),
    }


def test_inventory_does_not_read_contents(spark, tmp_path):
    make_tree(tmp_path)
    plan = files.inventory(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan.split("ReadSchema")[1]


def test_previews(spark, tmp_path):
    make_tree(tmp_path)
    got = {r["key"].rsplit("/", 1)[-1]: r["preview"] for r in files.preview_texts(spark, str(tmp_path)).collect()}
    assert got == {"a.txt": "é" * 500, "b.json": '{"x": 1}', "bad.csv": None}


def test_missing_path(spark):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        files.scan_binary(spark, "/no/such/path").count()


def test_store_options():
    assert files.s3a_options() == {}
    key = files.s3a_options("k", "s", "t", endpoint="http://host:9000")
    prefix = "spark.hadoop.fs.s3a."
    assert key[prefix + "session.token"] == "t" and key[prefix + "path.style.access"] == "true"
    assert key[prefix + "aws.credentials.provider"].endswith("TemporaryAWSCredentialsProvider")
    assert files.s3a_options("k", "s")[prefix + "aws.credentials.provider"].endswith("SimpleAWSCredentialsProvider")
    assert files.s3a_options(anonymous=True)[prefix + "aws.credentials.provider"].endswith("AnonymousAWSCredentialsProvider")
    for bad in ({"session_token": "t"}, {"access_key": "k"}, {"access_key": "k", "secret_key": "s", "anonymous": True}):
        with pytest.raises(ValueError):
            files.s3a_options(**bad)


def test_store_options_reach_one_read_only(spark, tmp_path):
    make_tree(tmp_path)
    # A made-up scheme is known to the read that defines it, and to no other.
    store = {"spark.hadoop.fs.made.impl": "org.apache.hadoop.fs.LocalFileSystem"}
    with pytest.raises(Exception, match="No FileSystem for scheme"):
        files.scan_binary(spark, f"made://{tmp_path}").count()
    with pytest.raises(Exception) as failure:
        files.scan_binary(spark, f"made://{tmp_path}", store=store).count()
    assert "No FileSystem for scheme" not in str(failure.value)
    assert files.scan_binary(spark, str(tmp_path), store=files.s3a_options("k", "s")).count() == 4


def test_uris():
    assert files.resolve_uri("s3://anonymous@bucket/a/") == ("s3a://bucket/a/", True)
    assert files.resolve_uri("s3://bucket/a") == ("s3a://bucket/a", False)
    assert files.resolve_uri("/local/a") == ("/local/a", False)


def test_scratch_space(spark):
    first, second = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert first != second and first.startswith(spark.conf.get("spark.checkpoint.dir"))
    df = materialise(spark.range(5).withColumn("v", F.lit("a")), "t")
    assert df.count() == 5 and df.columns == ["id", "v"]


def test_csv_keeps_every_string(spark, tmp_path):
    odd = [" lead.jpg ", "", None, 'quo"te', "a,b", "line\nbreak", "\r\n", "\\N", "back\\slash\\n", "\t", '""', "#x", "null"]
    df = spark.createDataFrame([(i, s, [0.5, None] if i % 2 else None) for i, s in enumerate(odd)], "i int, path string, v array<double>")
    path = str(tmp_path / "odd.csv")
    predictions.write_predictions(df.repartition(3), path)
    back = {r["i"]: (r["path"], r["v"]) for r in predictions.read_predictions(spark, path, df.schema).collect()}
    assert back == {i: (s, [0.5, None] if i % 2 else None) for i, s in enumerate(odd)}

import json
import numpy as np
import pytest

from kilnwork.cli import predict
from kilnwork.operators import images, models, scoring
from kilnwork.sources import files

from makers import bmp, onnx_channel_means, png


def tree(root):
    """Images of several kinds, a broken one, and files that are not images."""
    rng = np.random.default_rng(1)
    rgb = rng.integers(0, 256, (40, 60, 3), dtype=np.uint8)
    gray = rng.integers(0, 256, (300, 280), dtype=np.uint8)
    rgba = rng.integers(0, 256, (50, 50, 4), dtype=np.uint8)
    (root / "deep" / "er").mkdir(parents=True)
    (root / "a.PNG").write_bytes(png(rgb))
    (root / "deep" / "b.png").write_bytes(png(gray))
    (root / "deep" / "er" / "c.png").write_bytes(png(rgba))
    (root / "deep" / "d.bmp").write_bytes(bmp(rgb))
    (root / "broken.jpg").write_bytes(b"not an image")
    (root / "notes.txt").write_bytes(b"hello")
    (root / "e.tif").write_bytes(png(rgb))
    return rgb, gray, rgba


def test_decoding_and_suffixes(spark, tmp_path):
    rgb, gray, rgba = tree(tmp_path)
    rows = images.flatten_images(files.scan_images(spark, str(tmp_path))).collect()
    by_name = {r["path"].rsplit("/", 1)[-1]: r for r in rows}
    assert set(by_name) == {"a.PNG", "b.png", "c.png", "d.bmp", "broken.jpg"}
    assert by_name["broken.jpg"]["height"] == -1

    def pixels(name):
        r = by_name[name]
        return images.to_rgb(bytes(r["data"]), r["height"], r["width"], r["channels"])

    assert np.array_equal(pixels("a.PNG"), rgb)
    assert np.array_equal(pixels("d.bmp"), rgb)
    assert np.array_equal(pixels("b.png"), gray[:, :, None])
    three = images.preprocess(np.repeat(gray[:, :, None], 3, axis=2))
    assert np.array_equal(images.preprocess(pixels("b.png")), three)
    assert np.array_equal(pixels("c.png"), rgba[:, :, :3])


@pytest.mark.parametrize("suffix,kind", [("jpg", "jpg"), ("JPEG", "jpg"), ("tiff", "tiff")])
def test_other_formats_decode(spark, tmp_path, suffix, kind):
    flat = np.full((30, 40, 3), (200, 100, 50), dtype=np.uint8)
    (tmp_path / "flat.png").write_bytes(png(flat))
    java = spark.sparkContext._jvm.java.io.File
    picture = spark.sparkContext._jvm.javax.imageio.ImageIO.read(java(str(tmp_path / "flat.png")))
    target = tmp_path / "out" / f"x.{suffix}"
    target.parent.mkdir()
    assert spark.sparkContext._jvm.javax.imageio.ImageIO.write(picture, kind, java(str(target)))
    r = images.flatten_images(files.scan_images(spark, str(target.parent))).first()
    got = images.to_rgb(bytes(r["data"]), r["height"], r["width"], r["channels"])
    assert got.shape == (30, 40, 3) and np.abs(got.astype(int) - flat).max() <= 4


def resize(pixels, height, width):
    return images.resize_window(pixels, (height, width), 0, 0, height, width)


def test_resize_keeps_a_flat_image_flat():
    flat = np.full((31, 77, 3), 200, dtype=np.uint8)
    assert (resize(flat, 256, 300) == 200).all()
    assert (resize(flat, 8, 9) == 200).all()


@pytest.mark.parametrize("size", [(50, 90), (31, 120), (40, 77), (31, 77)])
def test_a_window_equals_the_part_of_the_whole(size):
    pixels = np.random.default_rng(5).integers(0, 256, (31, 77, 3), dtype=np.uint8)
    whole = resize(pixels, *size)
    part = images.resize_window(pixels, size, 3, 11, 20, 30)
    assert np.array_equal(part, whole[:, 3:23, 11:41])


def test_resize_by_hand():
    row = np.array([[[0], [100], [200], [60]]], dtype=np.uint8)
    # Halving: triangles two pixels wide around 1.0 and 3.0, weights 3/7 3/7 1/7 and the mirror image.
    assert resize(row, 1, 2).ravel().tolist() == [round((0 * 3 + 100 * 3 + 200) / 7), round((100 + 200 * 3 + 60 * 3) / 7)]
    # Doubling: each new pixel lies a quarter from an old one.
    assert resize(row[:, :2], 1, 4).ravel().tolist() == [0, 25, 75, 100]


@pytest.mark.parametrize("height,width", [(300, 500), (500, 300), (256, 256), (10, 11), (700, 256)])
def test_preprocess_shape_and_range(height, width):
    rng = np.random.default_rng(2)
    out = images.preprocess(rng.integers(0, 256, (height, width, 3), dtype=np.uint8))
    assert out.shape == (3, 224, 224) and out.dtype == np.float32
    low = (0 - np.array(images.CHANNEL_MEAN)) / images.CHANNEL_STD
    high = (1 - np.array(images.CHANNEL_MEAN)) / images.CHANNEL_STD
    assert (out.min(axis=(1, 2)) >= low - 1e-5).all() and (out.max(axis=(1, 2)) <= high + 1e-5).all()


def test_preprocess_crops_the_centre():
    image = np.zeros((256, 276, 3), dtype=np.uint8)
    image[16:240, 26:250] = 255
    out = images.preprocess(image)
    want = (1 - np.float32(images.CHANNEL_MEAN)) / np.float32(images.CHANNEL_STD)
    assert np.allclose(out, want[:, None, None])


def test_onnx_inference_over_a_tree(spark, tmp_path):
    photos, networks = tmp_path / "photos", tmp_path / "models"
    photos.mkdir()
    networks.mkdir()
    rgb, _, _ = tree(photos)
    weights = np.random.default_rng(3).normal(size=(3, 10)).astype(np.float32)
    (networks / "resnet18.onnx").write_bytes(onnx_channel_means(weights))
    registry = models.ModelRegistry()
    registry.register("resnet18", models.onnx_loader(spark, str(networks / "resnet18.onnx")))
    rows = predict.predict_images(spark, str(photos), registry, "resnet18", batch_size=2, num_gpus=0).collect()
    by_name = {r["file_path"].rsplit("/", 1)[-1]: r for r in rows}
    assert len(by_name) == 5
    want = scoring.probabilities(images.preprocess(rgb).mean(axis=(1, 2))[None].astype(float) @ weights)[0]
    got = by_name["a.PNG"]
    assert got["predicted_class"] == want.argmax() and np.allclose(got["top_5_scores"], np.sort(want)[::-1][:5], atol=1e-5)
    assert got["error"] is None and by_name["d.bmp"]["top_5_classes"] == got["top_5_classes"]
    assert "not a readable image" in by_name["broken.jpg"]["error"]
    assert np.isclose(by_name["broken.jpg"]["confidence_score"], 0.1)
    with pytest.raises(ValueError, match="none of the declared models"):
        predict.predict_images(spark, str(photos), registry, "vgg")


def test_large_model_files_are_fetched_by_executors(spark, tmp_path, monkeypatch):
    weights = np.eye(3, dtype=np.float32)
    (tmp_path / "big.onnx").write_bytes(onnx_channel_means(weights))
    monkeypatch.setattr(models, "MAX_BROADCAST_BYTES", 10)
    loader = models.onnx_loader(spark, str(tmp_path / "big.onnx"))
    x = np.arange(3, dtype=np.float32)[None, :, None, None] * np.ones((2, 3, 4, 4), dtype=np.float32)
    assert np.allclose(loader().logits(x), [[0, 1, 2]] * 2)


def test_predict_command(spark, tmp_path, capsys):
    photos, networks = tmp_path / "photos", tmp_path / "models"
    photos.mkdir()
    networks.mkdir()
    tree(photos)
    weights = np.random.default_rng(3).normal(size=(3, 10)).astype(np.float32)
    (networks / "resnet50.onnx").write_bytes(onnx_channel_means(weights))
    out = str(tmp_path / "out.csv")
    predict.main(["--uri", str(photos), "--models-dir", str(networks), "--output-path", out, "--smoke-test"])
    printed = capsys.readouterr().out
    lines = [json.loads(line) for line in printed.splitlines() if line.startswith("{")]
    assert lines[0]["predictions"] == lines[0]["images"] == 5 < lines[0]["loaded"] and lines[0]["unreadable"] == 1
    assert len(lines) == 6 and len(lines[1]["ranked"]) == 5


def test_smoke_batch():
    assert predict.effective_batch_size(64, True) == 4
    assert predict.effective_batch_size(2, True) == 2
    assert predict.effective_batch_size(64, False) == 64

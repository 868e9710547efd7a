"""Small image and network files made with the standard library."""

import struct
import zlib

import numpy as np


def png(pixels: np.ndarray) -> bytes:
    """8-bit gray [h, w], RGB [h, w, 3] or RGBA [h, w, 4]."""
    height, width = pixels.shape[:2]
    kind = {2: 0}.get(pixels.ndim) if pixels.ndim == 2 else {3: 2, 4: 6}[pixels.shape[2]]
    rows = b"".join(b"\0" + pixels[i].astype(np.uint8).tobytes() for i in range(height))

    def chunk(name: bytes, data: bytes) -> bytes:
        return struct.pack(">I", len(data)) + name + data + struct.pack(">I", zlib.crc32(name + data))

    header = struct.pack(">IIBBBBB", width, height, 8, kind, 0, 0, 0)
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", header) + chunk(b"IDAT", zlib.compress(rows)) + chunk(b"IEND", b"")


def bmp(pixels: np.ndarray) -> bytes:
    """24-bit RGB."""
    height, width = pixels.shape[:2]
    pad = b"\0" * (-width * 3 % 4)
    rows = b"".join(pixels[i, :, ::-1].astype(np.uint8).tobytes() + pad for i in reversed(range(height)))
    header = struct.pack("<2sIHHI", b"BM", 54 + len(rows), 0, 0, 54)
    return header + struct.pack("<IiiHHIIiiII", 40, width, height, 1, 24, 0, len(rows), 2835, 2835, 0, 0) + rows


def _varint(n: int) -> bytes:
    out = b""
    while n > 127:
        out += bytes([n & 127 | 128])
        n >>= 7
    return out + bytes([n])


def _field(number: int, value) -> bytes:
    if isinstance(value, int):
        return _varint(number << 3) + _varint(value)
    value = value.encode() if isinstance(value, str) else value
    return _varint(number << 3 | 2) + _varint(len(value)) + value


def onnx_channel_means(weights: np.ndarray) -> bytes:
    """Network: mean of each channel times ``weights`` [3, classes]."""

    def node(op: str, inputs: list[str], output: str) -> bytes:
        return _field(1, b"".join(_field(1, i) for i in inputs) + _field(2, output) + _field(4, op))

    def value(name: str, dims: list) -> bytes:
        shape = b"".join(_field(1, _field(2, d) if isinstance(d, str) else _field(1, d)) for d in dims)
        return _field(1, name) + _field(2, _field(1, _field(1, 1) + _field(2, shape)))

    tensor = b"".join(_field(1, d) for d in weights.shape) + _field(2, 1) + _field(8, "w")
    tensor += _field(9, weights.astype("<f4").tobytes())
    graph = node("GlobalAveragePool", ["x"], "pooled") + node("Flatten", ["pooled"], "flat")
    graph += node("MatMul", ["flat", "w"], "logits") + _field(2, "g") + _field(5, tensor)
    graph += _field(11, value("x", ["n", 3, "h", "v"])) + _field(12, value("logits", ["n", weights.shape[1]]))
    return _field(1, 8) + _field(7, graph) + _field(8, _field(1, "") + _field(2, 13))

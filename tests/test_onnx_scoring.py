"""M3 foreign-model path: a tiny ONNX graph (Sigmoid over an n x 2 input),
encoded by hand in protobuf wire format, scored in mapInPandas."""

import math

import pytest

ort = pytest.importorskip("onnxruntime")


def _varint(n):
    out = bytearray()
    while True:
        b = n & 0x7F
        n >>= 7
        out.append(b | (0x80 if n else 0))
        if not n:
            return bytes(out)


def _field(num, wire, payload):
    key = _varint((num << 3) | wire)
    if wire == 0:
        return key + _varint(payload)
    return key + _varint(len(payload)) + payload


def _str(num, s):
    return _field(num, 2, s.encode())


def _value_info(name, dims):
    shape = b"".join(_field(1, 2, _field(2, 2, d.encode()) if isinstance(d, str) else _field(1, 0, d)) for d in dims)
    tensor = _field(1, 0, 1) + _field(2, 2, shape)          # elem_type FLOAT, shape
    return _str(1, name) + _field(2, 2, _field(1, 2, tensor))


def sigmoid_model() -> bytes:
    node = _str(1, "X") + _str(2, "probabilities") + _str(4, "Sigmoid")
    graph = (_field(1, 2, node) + _str(2, "g") + _field(11, 2, _value_info("X", ["N", 2]))
             + _field(12, 2, _value_info("probabilities", ["N", 2])))
    opset = _field(2, 0, 13)
    return _field(1, 0, 7) + _field(7, 2, graph) + _field(8, 2, opset)


def test_score_onnx(spark):
    from tabspark.operators.score import score_onnx
    model = sigmoid_model()
    ort.InferenceSession(model, providers=["CPUExecutionProvider"])  # the bytes are a valid model
    df = spark.createDataFrame([(1, [0.0, 0.0]), (2, [0.0, 2.0]), (3, [5.0, -3.0])], "k long, features array<float>")
    out = {r["k"]: r for r in score_onnx(df, model, keep=["k"]).collect()}
    for k, x in ((1, 0.0), (2, 2.0), (3, -3.0)):
        assert out[k]["score"] == pytest.approx(1 / (1 + math.exp(-x)), abs=1e-6)
    assert out[2]["prediction"] == 1 and out[3]["prediction"] == 0

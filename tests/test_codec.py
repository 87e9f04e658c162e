"""Vectorised Avro codec against a plain per-record encoder written from the Avro spec."""

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lakeferry.functions import avro_codec as C
from lakeferry.schema import MESSAGE_AVRO_SCHEMA, avro_fields

FIELDS = avro_fields(MESSAGE_AVRO_SCHEMA)
STRUCT = pa.struct([("message_type", pa.string()), ("date", pa.string()),
                    ("message_id", pa.string()), ("creation_time", pa.int64())])


def varint(u):
    u &= (1 << 64) - 1
    out = bytearray()
    while True:
        b, u = u & 0x7F, u >> 7
        if u:
            out.append(b | 0x80)
        else:
            out.append(b)
            return bytes(out)


def zz(v):
    return (v << 1) ^ (v >> 63)


def spec_encode(rec):
    out = b""
    for name, typ in FIELDS:
        v = rec[name]
        if typ == "string":
            b = v.encode()
            out += varint(zz(len(b))) + b
        else:
            out += varint(zz(v))
    return out


EDGE = [
    {"message_type": "click", "date": "2024-01-01", "message_id": "x" * 64, "creation_time": -5},
    {"message_type": "ümlaut ✓ 日本", "date": "", "message_id": "id", "creation_time": 2**62},
    {"message_type": "a", "date": "b", "message_id": "c" * 300, "creation_time": -(2**63)},
    {"message_type": "", "date": "", "message_id": "", "creation_time": 2**63 - 1},
]


def test_encode_matches_spec_and_round_trips():
    arr = pa.array(EDGE, type=STRUCT)
    enc = C.encode(arr, FIELDS)
    assert enc.to_pylist() == [spec_encode(r) for r in EDGE]
    assert C.decode(enc, FIELDS).to_pylist() == EDGE


def test_nulls_and_slices():
    arr = pa.array([None] + EDGE, type=STRUCT).slice(0, 3)
    enc = C.encode(arr, FIELDS)
    assert enc.to_pylist()[0] is None
    assert C.decode(enc, FIELDS).to_pylist() == [None] + EDGE[:2]
    assert C.decode(enc.slice(1, 2), FIELDS).to_pylist() == EDGE[:2]


def test_truncated_fails_fast_or_nulls():
    bad = pa.array([spec_encode(EDGE[0])[:-2], spec_encode(EDGE[1]), b"", b"\xff" * 11],
                   type=pa.binary())
    with pytest.raises(C.MalformedRecord):
        C.decode(bad, FIELDS)
    assert C.decode(bad, FIELDS, failfast=False).to_pylist() == [None, EDGE[1], None, None]


def test_trailing_bytes_are_ignored():
    arr = pa.array([spec_encode(EDGE[0]) + b"extra"], type=pa.binary())
    assert C.decode(arr, FIELDS).to_pylist() == [EDGE[0]]


def test_required_field_null_raises():
    arr = pa.array([{"message_type": None, "date": "d", "message_id": "m", "creation_time": 1}],
                   type=STRUCT)
    with pytest.raises(C.MalformedRecord):
        C.encode(arr, FIELDS)


records = st.fixed_dictionaries({
    "message_type": st.text(max_size=80),
    "date": st.text(max_size=12),
    "message_id": st.text(max_size=200),
    "creation_time": st.integers(min_value=-(2**63), max_value=2**63 - 1),
})


@settings(max_examples=60, deadline=None)
@given(st.lists(records, max_size=40))
def test_property_round_trip(recs):
    arr = pa.array(recs, type=STRUCT)
    enc = C.encode(arr, FIELDS)
    assert enc.to_pylist() == [spec_encode(r) for r in recs]
    assert C.decode(enc, FIELDS).to_pylist() == recs


def test_a_length_near_the_top_of_int64_is_malformed_not_an_error():
    import numpy as np
    import pyarrow as pa
    import pytest

    from lakeferry.functions import avro_codec as C

    r = np.random.default_rng(8)
    huge = bytes([0xFE] + [0xFF] * 8 + [0x01])  # zigzag of 2^63 - 1
    noise = [r.integers(0, 256, int(n), dtype=np.uint8).tobytes() for n in r.integers(0, 40, 3000)]
    fields = [("a", "string"), ("b", "string"), ("c", "long")]
    values = pa.array([huge + b"xx", b"\x02a" + huge, *noise, None], pa.binary())
    out = C.decode(values, fields, failfast=False)
    assert len(out) == len(values) and not out[0].is_valid and not out[1].is_valid
    with pytest.raises(C.MalformedRecord):
        C.decode(values[:1], fields, failfast=True)

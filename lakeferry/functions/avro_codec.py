"""Vectorised Avro binary codec for flat records of string / int / long fields.

Runs inside Arrow-batched UDFs when Spark's Avro module is not loaded. Every step works
on whole columns of a batch with numpy (one cursor per row, advanced field by field);
there is no per-row Python loop. Layout (Avro spec, binary encoding): fields in schema
order, no header; int/long as zig-zag varints; string as a varint byte length followed
by UTF-8 bytes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_MAX_VARINT = 10  # a 64-bit value needs at most ten 7-bit groups
_U7 = np.uint64(7)
_LOW7 = np.uint64(0x7F)
_ONE = np.uint64(1)


class MalformedRecord(ValueError):
    """Raised in FAILFAST mode when a record cannot be decoded."""


def _zigzag(v: np.ndarray) -> np.ndarray:
    v = v.astype(np.int64, copy=False)
    return ((v << 1) ^ (v >> 63)).view(np.uint64)


def _unzigzag(u: np.ndarray) -> np.ndarray:
    return (u >> _ONE).view(np.int64) ^ -((u & _ONE).view(np.int64))


def _varint_len(u: np.ndarray) -> np.ndarray:
    n = np.ones(len(u), dtype=np.int64)
    for k in range(1, _MAX_VARINT):
        n += (u >> np.uint64(7 * k)) != 0
    return n


def _offsets_and_data(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Absolute start offsets (n+1, int64) and the whole data buffer of a var-width array."""
    bufs = arr.buffers()
    large = pa.types.is_large_string(arr.type) or pa.types.is_large_binary(arr.type)
    width = np.int64 if large else np.int32
    if bufs[1] is None:
        offs = np.zeros(len(arr) + 1, dtype=np.int64)
    else:
        raw = np.frombuffer(bufs[1], dtype=width)
        offs = raw[arr.offset : arr.offset + len(arr) + 1].astype(np.int64)
    buf = bufs[2]
    data = np.frombuffer(buf, dtype=np.uint8) if buf is not None else np.zeros(0, np.uint8)
    return offs, data


def _gather(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Concatenate data[starts[i] : starts[i] + lengths[i]] for all i."""
    total = int(lengths.sum())
    if total == 0:
        return np.zeros(0, dtype=np.uint8)
    out_starts = np.cumsum(lengths) - lengths
    idx = np.repeat(starts - out_starts, lengths) + np.arange(total, dtype=np.int64)
    return data[idx]


def _string_array(lengths: np.ndarray, payload: np.ndarray, binary: bool = False) -> pa.Array:
    offs = np.zeros(len(lengths) + 1, dtype=np.int64)
    np.cumsum(lengths, out=offs[1:])
    typ = pa.large_binary() if binary else pa.large_string()
    big = pa.Array.from_buffers(
        typ, len(lengths), [None, pa.py_buffer(offs), pa.py_buffer(payload.tobytes())]
    )
    return big.cast(pa.binary() if binary else pa.string())


# ---------------------------------------------------------------------------- decode


def _read_varint(data, pos, end, live, bad):
    """Read one varint per live row at ``pos``; returns values and advances ``pos``."""
    val = np.zeros(len(pos), dtype=np.uint64)
    active = live & ~bad
    for k in range(_MAX_VARINT):
        if not active.any():
            break
        inside = pos < end
        bad |= active & ~inside
        active &= inside
        b = np.zeros(len(pos), dtype=np.uint64)
        b[active] = data[pos[active]]
        val[active] |= (b[active] & _LOW7) << np.uint64(7 * k)
        pos[active] += 1
        active &= (b & np.uint64(0x80)) != 0
    bad |= active  # continuation bit still set after ten bytes
    return val


def decode(values: pa.Array, fields: list[tuple[str, str]], failfast: bool = True) -> pa.Array:
    """Decode a binary array into a struct array. Null input gives a null struct.

    FAILFAST raises :class:`MalformedRecord` on the first bad record; otherwise bad records
    become null structs. Bytes after the last field are ignored, as Spark's decoder does.
    """
    if isinstance(values, pa.ChunkedArray):
        values = values.combine_chunks()
    n = len(values)
    offs, data = _offsets_and_data(values)
    live = ~np.asarray(values.is_null().to_numpy(zero_copy_only=False), dtype=bool)
    pos = offs[:-1].copy()
    end = offs[1:]
    bad = np.zeros(n, dtype=bool)
    columns = []
    for name, typ in fields:
        raw = _read_varint(data, pos, end, live, bad)
        if typ == "string":
            ln = _unzigzag(raw)
            ok = live & ~bad
            bad |= ok & ((ln < 0) | (ln > end - pos))  # no sum: ln may be near 2^63
            ln = np.where(live & ~bad, ln, 0)
            columns.append((name, ln, pos.copy()))
            pos += ln
        else:
            v = _unzigzag(raw)
            if typ == "int":
                bad |= live & ~bad & ((v < -(2**31)) | (v >= 2**31))
            columns.append((name, v, None))
    if failfast and bad.any():
        first = int(np.flatnonzero(bad)[0])
        raise MalformedRecord(
            f"Malformed Avro record in batch row {first}: truncated or invalid bytes "
            "(use mode='PERMISSIVE' to turn bad records into nulls)"
        )
    good = live & ~bad
    arrays, names = [], []
    for name, a, starts in columns:
        if starts is not None:
            a = np.where(good, a, 0)
            arrays.append(_string_array(a, _gather(data, starts, a)))
        else:
            a = np.where(good, a, 0)
            t = pa.int32() if dict(fields)[name] == "int" else pa.int64()
            arrays.append(pa.array(a.astype(t.to_pandas_dtype()), type=t))
        names.append(name)
    return pa.StructArray.from_arrays(arrays, names=names, mask=pa.array(~good))


# ---------------------------------------------------------------------------- encode


def encode(records: pa.Array, fields: list[tuple[str, str]]) -> pa.Array:
    """Encode a struct array into Avro binary. A null struct gives a null value.

    Avro fields here are required, so a null field inside a non-null struct raises.
    """
    if isinstance(records, pa.ChunkedArray):
        records = records.combine_chunks()
    n = len(records)
    live = ~np.asarray(records.is_null().to_numpy(zero_copy_only=False), dtype=bool)
    parts = []  # (kind, varint values, payload starts, payload data)
    size = np.zeros(n, dtype=np.int64)
    for name, typ in fields:
        child = records.field(name)
        nulls = np.asarray(child.is_null().to_numpy(zero_copy_only=False), dtype=bool)
        if (nulls & live).any():
            raise MalformedRecord(f"null value for required Avro field {name!r}")
        if typ == "string":
            if pa.types.is_large_string(child.type) or pa.types.is_string(child.type):
                offs, data = _offsets_and_data(child)
            else:
                raise TypeError(f"field {name!r} must be a string column")
            ln = np.where(live, offs[1:] - offs[:-1], 0)
            u = _zigzag(ln)
            parts.append((u, offs[:-1], ln, data))
            size += _varint_len(u) + ln
        else:
            v = np.asarray(child.fill_null(0).to_numpy(zero_copy_only=False), dtype=np.int64)
            u = _zigzag(np.where(live, v, 0))
            parts.append((u, None, None, None))
            size += _varint_len(u)
    size = np.where(live, size, 0)
    out_offs = np.zeros(n + 1, dtype=np.int64)
    np.cumsum(size, out=out_offs[1:])
    out = np.zeros(int(out_offs[-1]), dtype=np.uint8)
    cursor = out_offs[:-1].copy()
    for u, starts, ln, data in parts:
        nb = _varint_len(u)
        for k in range(_MAX_VARINT):
            rows = live & (nb > k)
            if not rows.any():
                break
            byte = (u[rows] >> np.uint64(7 * k)) & _LOW7
            more = nb[rows] > k + 1
            out[cursor[rows] + k] = (byte | np.where(more, np.uint64(0x80), np.uint64(0))).astype(
                np.uint8
            )
        cursor += np.where(live, nb, 0)
        if starts is not None:
            payload = _gather(data, starts, ln)
            total = len(payload)
            if total:
                dst_starts = np.cumsum(ln) - ln
                idx = np.repeat(cursor - dst_starts, ln) + np.arange(total, dtype=np.int64)
                out[idx] = payload
            cursor += ln
    arr = _string_array(size, out, binary=True)
    if live.all():
        return arr
    return _mask(arr, live)


def _mask(arr: pa.Array, live: np.ndarray) -> pa.Array:
    """Set rows where ``live`` is False to null (values there are empty already)."""
    return pc.if_else(pa.array(live), arr, pa.scalar(None, type=arr.type))

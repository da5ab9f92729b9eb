"""Binary values of the wire format, Arrow batches at a time."""

from __future__ import annotations

from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udf

# The wire format's type codes.
FLOAT, ARRAY, DECIMAL, DOUBLE_LEAF, NULL_LEAF = 0x10, 0x0E, 0x17, 0x0A, 0x21
MOST_SCALE, MOST_BYTES = 76, 32


def twos_complement(value: int) -> bytes:
    """Big-endian two's complement; negative numbers below -1 have a whole sign byte in front."""
    if value in (0, -1):
        return bytes([value & 0xFF])
    size = value.bit_length() // 8 + 1 if value > 0 else -(-(-value - 1).bit_length() // 8) + 1
    return value.to_bytes(size, "big", signed=True)


def decimal_bytes(unscaled: int | bytes | None, scale: int) -> bytes:
    """The value of a decimal field; None is the null decimal."""
    if unscaled is None:
        return bytes([DECIMAL, 0, 0])
    if not 0 <= scale <= MOST_SCALE:
        raise ValueError(f"scale must be from 0 to {MOST_SCALE}")
    body = twos_complement(unscaled) if isinstance(unscaled, int) else bytes(unscaled)
    if len(body) > MOST_BYTES:
        raise ValueError(f"unscaled value must have at most {MOST_BYTES} bytes")
    return bytes([DECIMAL, scale, len(body)]) + body


def array_bytes(leaves: np.ndarray | None, shape: list[int]) -> bytes:
    """The value of an array field; None is the null array."""
    if leaves is None:
        return bytes([ARRAY, NULL_LEAF])
    head = bytes([ARRAY, DOUBLE_LEAF, len(shape)]) + np.array(shape, "<i4").tobytes()
    return head + np.asarray(leaves, "<f8").tobytes()


@arrow_udf(T.BinaryType())
def float_value(x: pa.Array) -> pa.Array:
    """0x10 and the little-endian double; null stays null."""
    data = np.asarray(x.fill_null(0.0).cast(pa.float64()), "<f8").tobytes()
    head = bytes([FLOAT])
    out = [head + data[i : i + 8] if ok else None for i, ok in zip(range(0, len(data), 8), x.is_valid().to_pylist(), strict=True)]
    return pa.array(out, pa.binary())


@arrow_udf(T.DoubleType())
def float_of(x: pa.Array) -> pa.Array:
    """The double of a ``float_value``."""
    return pa.array([None if v is None else float(np.frombuffer(v, "<f8", 1, 1)[0]) for v in x.to_pylist()], pa.float64())


@arrow_udf(T.BinaryType())
def array_value(shape: pa.Array, leaves: pa.Array) -> pa.Array:
    """An array value from its shape and its leaves; a null shape gives the null array."""
    out = []
    for s, v in zip(shape.to_pylist(), leaves, strict=True):
        out.append(array_bytes(None, []) if s is None else array_bytes(np.asarray(v.values, "<f8"), s))
    return pa.array(out, pa.binary())


@arrow_udf(T.BinaryType())
def decimal_value(x: pa.Array) -> pa.Array:
    """A decimal value from a decimal column, with the column's scale."""
    scale = x.type.scale
    out = [decimal_bytes(None if v is None else int(v.scaleb(scale, _wide())), scale) for v in x.to_pylist()]
    return pa.array(out, pa.binary())


def _wide():
    from decimal import Context

    return Context(prec=80)


def decimal_of(value: bytes) -> Decimal | None:
    """The number of a decimal value."""
    scale, size = value[1], value[2]
    if not size:
        return None
    return Decimal(int.from_bytes(value[3 : 3 + size], "big", signed=True)).scaleb(-scale, _wide())


def array_of(value: bytes) -> tuple[list[int], np.ndarray] | None:
    """Shape and leaves of an array value."""
    if value[1] == NULL_LEAF:
        return None
    n = value[2]
    shape = np.frombuffer(value, "<i4", n, 3)
    return shape.tolist(), np.frombuffer(value, "<f8", int(shape.prod()), 3 + 4 * n)

"""Column functions: Avro decode/encode."""

from lakeferry.functions.avro import decode_avro, encode_avro

__all__ = ["decode_avro", "encode_avro"]

"""Payload kinds, decoding of imported dumps, and column encryption with a key ring."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark import constants as K
from tidemark.functions.core import as_bytes


def payload_kind(df: DataFrame, col: str = "data") -> DataFrame:
    """Adds `payload_kind` from the payload's prefix: static, ephemeral, plain, undecodable or empty."""
    value = F.col(col)
    return df.withColumn(
        "payload_kind",
        F.when(value.isNull() | (value == ""), "empty")
        .when(value.startswith(K.STATIC_SALT_PREFIX), "static")
        .when(value.startswith(K.EPHEMERAL_SALT_PREFIX), "ephemeral")
        .when(~value.startswith("%"), "plain")
        .otherwise("undecodable"),
    )


def decode_payload(df: DataFrame, col: str = "data", encoding: str | None = None) -> DataFrame:
    """Turns a text payload of an imported dump into bytes.

    With no `encoding` named, rows with `is_binary` are base64 and all others UTF-8. A payload that
    is not valid base64 becomes null.
    """
    binary = F.try_to_binary(F.col(col), F.lit("base64"))
    text = as_bytes(col)
    if encoding == "base64":
        value = binary
    elif encoding == "utf8":
        value = text
    elif encoding is None:
        value = F.when(F.col("is_binary"), binary).otherwise(text)
    else:
        raise ValueError(f"unknown encoding {encoding!r}")
    return df.withColumn(col, value)


def encrypt_col(df: DataFrame, col: str, key: bytes) -> DataFrame:
    """Encrypts a column in place with AES-GCM under a 16, 24 or 32 byte key."""
    return df.withColumn(col, F.aes_encrypt(as_bytes(col), F.lit(key), F.lit("GCM")))


def decrypt_col(df: DataFrame, col: str, keys: Sequence[bytes]) -> DataFrame:
    """Decrypts a column in place: each distinct key is tried in order, the first that fits wins.

    The value is null where no key fits.
    """
    ring = list(dict.fromkeys(keys))
    if not ring:
        raise ValueError("at least one key is needed")
    tries = [F.try_aes_decrypt(F.col(col), F.lit(k), F.lit("GCM")) for k in ring]
    return df.withColumn(col, F.coalesce(*tries))

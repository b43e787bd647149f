"""Fernet tokens out of built-in functions, so that protecting a column stays inside the JVM.

A token is url-safe base64 of ``version, time, iv, ciphertext, mac`` as the public Fernet specification lays
it out: AES-128-CBC for the text, HMAC-SHA256 over all that precedes the mac.

Keys reach the plan as scalar subqueries of a one-row frame. Literals would be printed in plans and event logs.
"""

from __future__ import annotations

import base64
import binascii
import os
from collections.abc import Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed value: the environment variable that holds the key.
KEY_VARIABLE = "ENCRYPTION_KEY"

# Fixed values of the token format.
_VERSION = "80"
_BLOCK_BYTES = 64
_HEADER_BYTES = 9
_MAC_BYTES = 32
_SHORTEST_TOKEN_BYTES = 73

_CBC, _PKCS = "CBC", "PKCS"


@dataclass(frozen=True)
class TokenKeys:
    """Signing and encryption key, held in a one-row frame."""

    frame: DataFrame

    @classmethod
    def from_text(cls, spark: SparkSession, key: str) -> TokenKeys:
        """Split a url-safe base64 key of 32 bytes."""
        try:
            raw = base64.urlsafe_b64decode(key)
        except (binascii.Error, ValueError) as error:
            raise ValueError("the key must be url-safe base64") from error
        if len(raw) != 32:
            raise ValueError("the key must hold 32 bytes")
        signing = raw[:16].ljust(_BLOCK_BYTES, b"\0")
        row = {
            "inner_pad": [bytes(byte ^ 0x36 for byte in signing)],
            "outer_pad": [bytes(byte ^ 0x5C for byte in signing)],
            "aes_key": [raw[16:]],
        }
        return cls(spark.createDataFrame(pa.table(row, schema=pa.schema({name: pa.binary() for name in row}))))

    @classmethod
    def from_environment(cls, spark: SparkSession, variable: str = KEY_VARIABLE) -> TokenKeys:
        """The key that both jobs are given by the environment."""
        key = os.environ.get(variable)
        if not key:
            raise ValueError(f"{variable} is not set")
        return cls.from_text(spark, key)

    def __repr__(self) -> str:
        return "TokenKeys(...)"

    def __getitem__(self, name: str) -> Column:
        return self.frame.select(name).scalar()


def encrypt_columns(
    df: DataFrame, names: Sequence[str], keys: TokenKeys, iv: Column | None = None, seconds: Column | None = None
) -> DataFrame:
    """Replace text columns by tokens; null stays null.

    The random part is a column of its own that Spark knows to be non-deterministic, and all else is a pure
    function of it: the iv inside a token and the iv under its mac are the same, however the plan is rewritten.
    """
    columns = df.columns
    bodies = {name: f"_body_{name}" for name in names}
    ivs = {name: f"_iv_{name}" for name in names}
    if iv is None:
        df = df.withColumns({ivs[name]: F.uuid() for name in names})
        made = {name: _hidden_iv(F.col(ivs[name]), keys) for name in names}
    else:
        made = {name: iv for name in names}
    clock = F.unix_timestamp() if seconds is None else seconds
    header = F.concat(F.unhex(F.lit(_VERSION)), F.unhex(F.lpad(F.hex(clock), 16, "0")))
    df = df.withColumns(
        {
            # the built-in puts the iv in front of the ciphertext itself
            bodies[name]: F.concat(
                header, F.aes_encrypt(F.col(name), keys["aes_key"], F.lit(_CBC), F.lit(_PKCS), made[name])
            )
            for name in names
        }
    )
    tokens = {name: _to_base64(F.concat(bodies[name], _mac(F.col(bodies[name]), keys))) for name in names}
    return df.withColumns(tokens).select(*columns)


def with_token_check(df: DataFrame, name: str, keys: TokenKeys, text: str, valid: str) -> DataFrame:
    """Add the text of a token, null if the token is not valid, and whether it is valid; null for a null token."""
    raw, body, mac = f"_raw_{name}", f"_signed_{name}", f"_mac_{name}"
    columns = df.columns
    df = df.withColumn(raw, _from_base64(F.col(name)))
    size = F.length(raw)
    df = df.withColumns(
        {
            body: F.col(raw).substr(F.lit(1), size - _MAC_BYTES),
            mac: F.col(raw).substr(size - _MAC_BYTES + 1, F.lit(_MAC_BYTES)),
        }
    )
    signed = (
        (size >= _SHORTEST_TOKEN_BYTES)
        & (F.substring(raw, 1, 1) == F.unhex(F.lit(_VERSION)))
        & (F.col(mac) == _mac(F.col(body), keys))
    )
    df = df.withColumn(valid, F.when(F.col(name).isNotNull(), F.coalesce(signed, F.lit(False))))
    ciphertext = F.substring(body, _HEADER_BYTES + 1, 2**31 - 1)
    plain = F.aes_decrypt(ciphertext, keys["aes_key"], F.lit(_CBC), F.lit(_PKCS))
    df = df.withColumn(text, F.when(F.col(valid), F.decode(plain, "UTF-8")))
    return df.select(*[column for column in columns if column not in (text, valid)], text, valid)


def decrypt_columns(df: DataFrame, names: Sequence[str], keys: TokenKeys) -> DataFrame:
    """Replace token columns by their text; null stays null, and a token that is not valid fails the job."""
    columns = df.columns
    for name in names:
        text, valid = f"_text_{name}", f"_valid_{name}"
        df = with_token_check(df, name, keys, text, valid)
        refused = F.raise_error(F.lit(f"column {name} holds a token that is not valid")).cast("string")
        df = df.withColumn(name, F.when(~F.col(valid), refused).otherwise(F.col(text))).drop(text, valid)
    return df.select(*columns)


def _hidden_iv(nonce: Column, keys: TokenKeys) -> Column:
    """Sixteen bytes that nobody without the key can foresee."""
    keyed = F.sha2(F.concat(keys["inner_pad"], F.encode(nonce, "UTF-8")), 256)
    return F.substring(F.unhex(keyed), 1, 16)


def _mac(body: Column, keys: TokenKeys) -> Column:
    inner = F.unhex(F.sha2(F.concat(keys["inner_pad"], body), 256))
    return F.unhex(F.sha2(F.concat(keys["outer_pad"], inner), 256))


def _to_base64(raw: Column) -> Column:
    """Url-safe base64 without the line breaks of the built-in."""
    text = F.replace(F.base64(raw), F.lit("\r\n"), F.lit(""))
    return F.replace(F.replace(text, F.lit("+"), F.lit("-")), F.lit("/"), F.lit("_"))


def _from_base64(token: Column) -> Column:
    text = F.replace(F.replace(token, F.lit("-"), F.lit("+")), F.lit("_"), F.lit("/"))
    return F.try_to_binary(text, F.lit("base64"))

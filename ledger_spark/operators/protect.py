"""Protection of personal columns.

Keys and peppers are arguments, taken by the caller from its secret store.
They become literals of the plan: do not log plans of these jobs.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledger_spark.operators.spread import lookup_join

PERSONAL_COLUMNS = ["dni", "email", "telefono"]


def digest(value: Column, pepper: str) -> Column:
    """Hex SHA-256 of the peppered value: equal values stay joinable. NULL stays NULL."""
    return F.sha2(F.concat(F.lit(pepper), value.cast("string")), 256)


def protected_owners(
    people: DataFrame,
    audience: str,
    clear_audiences: list[str],
    pepper: str,
    columns: list[str] = PERSONAL_COLUMNS,
) -> DataFrame:
    """People as the audience may see them: digests unless it has clear access."""
    if audience in clear_audiences:
        return people
    return people.withColumns({c: digest(F.col(c), pepper) for c in columns})


def encrypt_columns(df: DataFrame, columns: list[str], key: str) -> DataFrame:
    """Reversible AES-GCM form (base64 text) of the columns; key of 16, 24 or 32 characters."""
    return df.withColumns(
        {c: F.base64(F.aes_encrypt(F.col(c).cast("string"), F.lit(key))) for c in columns}
    )


def decrypt_columns(df: DataFrame, columns: list[str], key: str) -> DataFrame:
    return df.withColumns(
        {c: F.aes_decrypt(F.unbase64(F.col(c)), F.lit(key)).cast("string") for c in columns}
    )


# Bytes of a block of SHA-256.
BLOCK = 64
KEY_NUMBER = "clave"


def keyed_digest(value: Column, key: str) -> Column:
    """Hex HMAC-SHA-256 of the value under a key of any length. NULL stays NULL.

    Unlike a pepper in front of the value, no part of the key can pass for a part of the value.
    """
    secret = key.encode()
    if len(secret) > BLOCK:
        secret = hashlib.sha256(secret).digest()
    inner, outer = (
        F.lit(bytearray(b ^ mask for b in secret.ljust(BLOCK, b"\0"))) for mask in (0x36, 0x5C)
    )
    within = F.unhex(F.sha2(F.concat(inner, F.encode(value.cast("string"), "UTF-8")), 256))
    return F.sha2(F.concat(outer, within), 256)


def keyed_columns(df: DataFrame, columns: list[str], keys: dict[int, str], number: int) -> DataFrame:
    """The columns as digests under the key of that number, which stands beside them, so that rows
    of different keys are never taken for one another."""
    hidden = {c: keyed_digest(F.col(c), keys[number]) for c in columns}
    return df.withColumns({**hidden, KEY_NUMBER: F.lit(number)})


def key_bridge(values: DataFrame, column: str, keys: dict[int, str], old: int, new: int) -> DataFrame:
    """(old key, old digest, new key, new digest) of every value, from the rows that hold it in the
    clear: what whoever may see both writes once, when the key is changed. NULL has none."""
    known = values.where(F.col(column).isNotNull()).select(column).distinct()
    return known.select(
        F.lit(old).alias(KEY_NUMBER),
        keyed_digest(F.col(column), keys[old]).alias(column),
        F.lit(new).alias("clave_nueva"),
        keyed_digest(F.col(column), keys[new]).alias("valor_nuevo"),
    )


def under_new_key(rows: DataFrame, column: str, bridge: DataFrame) -> DataFrame:
    """Rows under several keys as one view: digests that the bridge knows are replaced by those under
    the new key, with its number; others, NULL among them, stay under their own.

    Nothing is decrypted, and no key is needed. A bridge has one row per old key and digest; a digest
    that a third of the rows hold is split over the tasks.
    """
    at = F.struct(F.col(KEY_NUMBER).alias("k"), F.col(column).alias("v"))
    found = bridge.select(at.alias("_at"), "clave_nueva", "valor_nuevo")
    moved = lookup_join(rows.withColumn("_at", at), found, "_at", "left")
    renewed = {
        KEY_NUMBER: F.coalesce("clave_nueva", KEY_NUMBER),
        column: F.coalesce("valor_nuevo", column),
    }
    return moved.withColumns(renewed).select(rows.columns)

"""Surrogate keys, the change sequencer and commit-number decoding, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Fixed values that stored keys depend on.
SEPARATOR = "#$%^#"
NULL_KEY = "_._--NULL--_._"


def key_text(col: Column | str, kind: T.DataType) -> Column:
    """One key part as text: equal numbers agree whatever their type, bytes are base64, times are epoch seconds."""
    c = F.col(col) if isinstance(col, str) else col
    if isinstance(kind, T.StringType):
        return c
    if isinstance(kind, T.IntegralType):
        return c.cast("string")
    if isinstance(kind, (T.DecimalType, T.FractionalType)):
        plain = c.cast("string") if isinstance(kind, T.DecimalType) else c.cast("decimal(38,18)").cast("string")
        return F.regexp_replace(F.regexp_replace(plain, r"(\.\d*?)0+$", "$1"), r"\.$", "")
    if isinstance(kind, T.BinaryType):
        return F.base64(c)
    if isinstance(kind, T.BooleanType):
        return c.cast("string")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        micros = F.unix_micros(c.cast("timestamp"))
        return key_text((micros.cast("decimal(38,6)") / F.lit(1_000_000)).cast("decimal(38,6)"), T.DecimalType(38, 6))
    raise TypeError(f"no key text for {kind.simpleString()}")


def surrogate_key(schema: T.StructType, columns: list[str]) -> Column:
    """md5 of the key parts joined by the separator; a null part has a text of its own."""
    parts = [F.coalesce(key_text(F.col(c), schema[c].dataType), F.lit(NULL_KEY)) for c in columns]
    return F.md5(F.concat_ws(SEPARATOR, *parts).cast("binary"))


def sequencer(csn: Column | str, pos: Column | str, is_pk_change: Column | None = None, op: Column | str = "op_type") -> Column:
    """struct(csn, pos, is_pk_change), compared field by field. Of a key change the delete precedes the insert.

    A null commit number or position is an error: its order cannot be known.
    """
    number = lambda x, name: F.when((F.col(x) if isinstance(x, str) else x).isNull(), F.raise_error(F.lit(f"{name} is null"))).otherwise((F.col(x) if isinstance(x, str) else x).cast("decimal(38,0)"))
    rank = F.lit(0)
    if is_pk_change is not None:
        rank = F.when(is_pk_change & ((F.col(op) if isinstance(op, str) else op) == "I"), 1).otherwise(0)
    return F.struct(number(csn, "csn").alias("csn"), number(pos, "pos").alias("pos"), rank.cast("bigint").alias("is_pk_change"))


def _hex(c: Column) -> Column:
    return F.conv(c, 16, 10).cast("decimal(38,0)")


_UUID = r"^[0-9a-fA-F]{8}-([0-9a-fA-F]{4}-){3}[0-9a-fA-F]{12}$"


def decode_csn(text: Column | str, database: str) -> Column:
    """Commit number text of a source database as decimal(38,0); malformed or zero values raise.

    oracle: digits. postgres: hex/hex, high and low 32 bits. mysql: file:offset the same way, or number:uuid:number whose
    last part counts. sqlserver: two equal halves of hex 8:8:4, 80 bits. Leading zeros do not count; ranges do.
    """
    t = F.col(text) if isinstance(text, str) else text
    two32 = F.lit(1 << 32).cast("decimal(38,0)")
    bad = lambda why: F.raise_error(F.concat(F.lit(f"{database} commit number {why}: "), F.coalesce(t, F.lit("null")))).cast("decimal(38,0)")
    digits = lambda c: c.rlike("^[0-9]{1,38}$")
    if database == "oracle":
        value = F.when(digits(t), t.cast("decimal(38,0)")).otherwise(bad("is not a number"))
    elif database == "postgres":
        p = F.split(t, "/")
        ok = t.rlike("^0*[0-9A-Fa-f]{1,8}/0*[0-9A-Fa-f]{1,8}$")
        value = F.when(ok, (_hex(F.get(p, F.lit(0))) * two32 + _hex(F.get(p, F.lit(1)))).cast("decimal(38,0)")).otherwise(bad("is not hex/hex"))
    elif database == "mysql":
        p = F.split(t, ":")
        part = lambda i: F.get(p, F.lit(i))
        low = lambda c: c.cast("decimal(38,0)") < two32
        two = (F.size(p) == 2) & digits(part(0)) & digits(part(1)) & low(part(0)) & low(part(1))
        three = (F.size(p) == 3) & digits(part(0)) & part(1).rlike(_UUID) & digits(part(2))
        value = F.when(two, (part(0).cast("decimal(38,0)") * two32 + part(1).cast("decimal(38,0)")).cast("decimal(38,0)")).when(three, part(2).cast("decimal(38,0)")).otherwise(bad("is neither file:offset nor number:uuid:number"))
    elif database == "sqlserver":
        part = lambda at, n: _hex(F.substring(t, at, n))
        whole = ((part(1, 8) * two32 + part(10, 8)).cast("decimal(38,0)") * F.lit(1 << 16).cast("decimal(38,0)") + part(19, 4)).cast("decimal(38,0)")
        ok = t.rlike(r"^([0-9a-fA-F]{8}:[0-9a-fA-F]{8}:[0-9a-fA-F]{4})\1$")
        return F.when(ok & t.rlike("[1-9a-fA-F]"), whole).when(ok, bad("is zero")).otherwise(bad("is not two equal halves"))
    else:
        raise ValueError(f"unknown database {database}")
    return F.when(value == 0, bad("is zero")).otherwise(value)

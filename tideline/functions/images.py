"""Row images: JSON texts of strings turned into typed columns, and repairs on them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Text that a source writes for a large value that did not change.
UNCHANGED = "unchanged-toast-datum"
_EPOCH_DATABASES = ("postgres", "mysql", "sqlserver")


def _fail(value: Column, kind: str, why: str) -> Column:
    return F.raise_error(F.concat(F.lit(f"{why}: "), value)).cast(kind)


def typed_value(text: Column, kind: T.DataType, database: str) -> Column:
    """One value of a row image, by the rules of its type and source database; null stays null, misfits raise."""
    name = kind.simpleString()
    if isinstance(kind, T.StringType):
        return text
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        seconds = F.expr("try_cast(0 as decimal(38,6))") if text is None else text.try_cast("decimal(32,6)")
        micros = (seconds * F.lit(1_000_000)).cast("long")
        epoch = F.when(micros.isNull(), _fail(text, "timestamp_ntz", "not epoch seconds")).otherwise(F.timestamp_micros(micros).cast("timestamp_ntz"))
        if database not in _EPOCH_DATABASES:
            return F.when(text.isNotNull(), epoch)
        written = ~text.rlike(r"^[0-9.]+$") & ~text.startswith("-")
        return F.when(text.isNull(), None).when(written, F.to_date(text, "yyyy-MM-dd").cast("timestamp_ntz")).otherwise(epoch)
    if isinstance(kind, T.BinaryType):
        return F.encode(text, "UTF-8") if database == "mysql" else F.unbase64(text)
    if isinstance(kind, T.DecimalType):
        digits = F.length(F.regexp_replace(F.regexp_replace(text, r"^[-+]?0*", ""), r"\.", ""))
        scale = F.length(F.regexp_extract(text, r"\.(\d*)$", 1))
        fits = text.rlike(r"^[-+]?\d*\.?\d*$") & (digits <= kind.precision) & (scale <= kind.scale)
        value = text.try_cast(name)
        return F.when(text.isNull(), None).when(fits & value.isNotNull(), value).otherwise(_fail(text, name, f"does not fit {name}"))
    if isinstance(kind, T.NumericType):
        value = text.try_cast(name)
        return F.when(text.isNull() | value.isNotNull(), value).otherwise(_fail(text, name, f"not {name}"))
    if isinstance(kind, T.BooleanType):
        if database not in ("postgres", "sqlserver"):
            return F.when(text.isNotNull(), _fail(text, "boolean", f"no boolean in {database}"))
        return F.when(text.isNull(), None).when(text == "AQ==", True).when(text == "AA==", False).otherwise(_fail(text, "boolean", "not one byte 0 or 1"))
    raise TypeError(f"row images hold no {name}")


def typed_image(image: Column | str, schema: T.StructType, database: str) -> Column:
    """Struct of typed columns from a JSON text of strings; a null image gives a null struct."""
    c = F.col(image) if isinstance(image, str) else image
    raw = F.from_json(c, T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields]))
    # the lambda's argument is computed once, however often the rules of a type look at a value
    typed = F.transform(F.array(raw), lambda r: F.struct(*[typed_value(r[f.name], f.dataType, database).alias(f.name) for f in schema.fields]))
    return F.when(c.isNotNull(), F.element_at(typed, 1))


def repair_unchanged(before: Column | str, after: Column | str) -> Column:
    """The after image (JSON text of strings) with unchanged marks replaced from the before image; empty values stay null."""
    kind = "map<string,string>"
    b, a = F.from_json(before, kind), F.from_json(after, kind)
    return F.when(a.isNotNull(), F.to_json(F.transform_values(a, lambda k, v: F.when(v == UNCHANGED, F.element_at(b, k)).otherwise(v))))


#: Types that a registered field may have, besides decimals; others are taken as text.
KINDS = ("string", "tinyint", "smallint", "int", "bigint", "float", "double", "boolean", "date", "timestamp")
DECIMAL = "decimal(38,18)"


def value_of_kind(text: Column, kind: Column) -> Column:
    """A text as a value of the type that `kind` names in this row; null where it is none. One branch for each type there is,
    whatever the number of schema versions."""
    out = F.when(kind.startswith("decimal"), text.try_cast(DECIMAL).cast("variant"))
    for k in KINDS[1:]:
        out = out.when(kind == k, text.try_cast(k).cast("variant"))
    return out.otherwise(text.cast("variant"))


def decoded_image(image: Column, fields: Column) -> Column:
    """Struct (image, bad) of an image text read by the row's own field list array<struct<name, type>>.

    The text is parsed once. image: an object (variant) with the listed fields the text has a value for, each of its type, whatever else the text
    holds; null if the text or the list is null or the text is no object. bad: names of fields whose text does not fit their type.
    """
    texts = F.try_variant_get(F.try_parse_json(image), "$", "map<string,string>")
    read = F.transform(fields, lambda f: F.struct(f["name"].alias("name"), F.element_at(texts, f["name"]).alias("text"), f["type"].alias("type")))
    typed = F.transform(F.filter(read, lambda r: r["text"].isNotNull()), lambda r: F.struct(r["name"].alias("key"), value_of_kind(r["text"], r["type"]).alias("value")))
    good = F.filter(typed, lambda r: r["value"].isNotNull())
    bad = F.transform(F.filter(typed, lambda r: r["value"].isNull()), lambda r: r["key"])
    known = texts.isNotNull() & fields.isNotNull()
    return F.when(known, F.struct(F.to_variant_object(F.map_from_entries(good)).alias("image"), bad.alias("bad")))

"""Column, key and flow specs from source catalogs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tideline import storage

#: Catalog types that become strings, doubles, bytes, and the default decimal.
STRINGS = ("NVARCHAR2", "CHAR", "NCHAR", "VARCHAR", "VARCHAR2", "LONG", "LONG VARCHAR", "CLOB", "NCLOB", "UROWID", "ROWID", "XMLTYPE", "CHAR VARYING", "CHARACTER VARYING", "CHARACTER", "NATIONAL CHAR VARYING", "NATIONAL CHARACTER VARYING", "NATIONAL CHAR", "NATIONAL CHARACTER")
DOUBLES = ("BINARY_FLOAT", "BINARY_DOUBLE", "REAL", "DOUBLE PRECISION")
BYTES = ("BLOB", "RAW", "LONG RAW", "BFILE")
WIDE_DECIMAL = "DECIMAL(38,6)"


def mapped_type(kind: Column, precision: Column, scale: Column) -> Column:
    """Column type for a catalog type; null where there is none."""
    number = kind == "NUMBER"
    return (
        F.when(kind.isin(*STRINGS) | kind.startswith("INTERVAL"), "STRING")
        .when(number & precision.isNotNull() & scale.isNotNull(), F.concat(F.lit("DECIMAL("), precision.cast("string"), F.lit(","), scale.cast("string"), F.lit(")")))
        .when((number & precision.isNull()) | kind.isin("DECIMAL", "FLOAT"), WIDE_DECIMAL)
        .when(kind.isin(*DOUBLES), "DOUBLE")
        .when(kind.startswith("TIMESTAMP") | (kind == "DATE"), "TIMESTAMP")
        .when(kind.isin(*BYTES), "BINARY")
    )


def is_large(kind: Column, length: Column) -> Column:
    """Is a catalog type a large object?"""
    k = F.lower(F.trim(kind))
    return (k.contains("char") & (length > 4000)) | ((k == "raw") & (length > 2000)) | k.contains("lob") | k.isin("bfile", "longraw", "long raw", "long", "xmltype")


def ordered_names(df: DataFrame, by: list[str], name: str, position: str, out: str = "names") -> DataFrame:
    """Names of each group in order of position."""
    return df.groupBy(*by).agg(F.transform(F.array_sort(F.collect_list(F.struct(F.col(position).alias("p"), F.col(name).alias("n")))), lambda x: x["n"]).alias(out))


def smallest_key(keys: DataFrame, by: list[str], columns: str, name: str) -> DataFrame:
    """The key with the fewest columns of each group; of equals the first by name."""
    return keys.groupBy(*by).agg(F.min_by(F.struct(name, columns), F.struct(F.size(columns), F.col(name))).alias("k")).select(*by, "k.*")


def choose_keys(columns: DataFrame, primary: DataFrame, unique: DataFrame, index: DataFrame, by: list[str]) -> DataFrame:
    """(by, key_type, key_columns): primary key, else unique constraint, else unique index, else all columns."""
    out = columns.join(primary, by, "left").join(unique, by, "left").join(index, by, "left")
    kind = F.when(F.col("pk").isNotNull(), "PRIMARY_KEY").when(F.col("uk").isNotNull(), "UNIQUE_KEY").when(F.col("ui").isNotNull(), "UNIQUE_INDEX").otherwise("ALL_COLUMNS")
    return out.select(*by, kind.alias("key_type"), F.coalesce("pk", "uk", "ui", "all_columns").alias("key_columns"))


def key_conflicts(keys: DataFrame, table: str, columns: str) -> DataFrame:
    """Tables whose schemas have different key columns."""
    return keys.groupBy(table).agg(F.collect_set(F.array_sort(columns)).alias("sets")).where(F.size("sets") > 1)


def numbered(df: DataFrame, order: str, name: str) -> DataFrame:
    """Add the row's place (from 1) in the order of a column, without gathering the rows in one task.

    Rows are range-partitioned into a written table; a row for each of its partitions is all that is summed in one place.
    """
    path = storage.fresh_dir(df.sparkSession, "numbered")
    cut = df.repartitionByRange(order).withColumn("__part", F.spark_partition_id())
    cut.write.parquet(path)
    rows = df.sparkSession.read.schema(cut.schema).parquet(path)
    sizes = rows.groupBy("__part").count()
    base = sizes.select("__part", (F.sum("count").over(Window.orderBy("__part")) - F.col("count")).alias("__base"))
    place = F.col("__base") + F.row_number().over(Window.partitionBy("__part").orderBy(order))
    return rows.join(base, "__part").withColumn(name, place).drop("__part", "__base")


def group_flows(flows: DataFrame, order: str, per_group: int) -> DataFrame:
    """Add group_number: `per_group` flows each in order of name."""
    return numbered(flows, order, "__n").withColumn("group_number", F.ceil(F.col("__n") / per_group).cast("long")).drop("__n")


def latest_snapshot(df: DataFrame, stamp: str = "created_at") -> DataFrame:
    """Rows of the latest snapshot."""
    last = df.agg(F.max(stamp).alias(stamp))
    return df.join(F.broadcast(last), stamp, "left_semi")  # one row


def union_sources(frames: list[DataFrame]) -> DataFrame:
    """Positional union of scans, columns in lower case."""
    out = frames[0].toDF(*[c.lower() for c in frames[0].columns])
    for f in frames[1:]:
        out = out.union(f.toDF(*[c.lower() for c in f.columns]))
    return out


def assign_ids(found: DataFrame, specs: DataFrame, keys: list[str], ids: Column | None = None) -> DataFrame:
    """Specs with a new id for each key not yet there; known ones keep theirs."""
    fresh = found.select(*keys).distinct().join(specs, keys, "left_anti").withColumn("schema_id", ids if ids is not None else F.expr("uuid()"))
    return specs.unionByName(fresh.select(*specs.columns))


def conserved_join(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Inner join that raises if a left row has no partner."""
    out = left.join(right.withColumn("__hit", F.lit(True)), keys, "left")
    lost = F.raise_error(F.concat(F.lit("no partner for "), F.concat_ws(",", *keys))).cast("boolean")
    return out.where(F.when(F.col("__hit").isNull(), lost).otherwise(True)).drop("__hit")


def _broken(specs: DataFrame, key: str, rules: dict[str, Column]) -> DataFrame:
    """(key, rule) of every rule whose condition holds."""
    each = F.array(*[F.when(F.coalesce(c, F.lit(True)), F.lit(name)) for name, c in rules.items()])
    return specs.select(key, F.explode(F.filter(each, lambda r: r.isNotNull())).alias("rule"))


def _repeated(specs: DataFrame, by: str, key: str, rule: str) -> DataFrame:
    return specs.groupBy(by).agg(F.count("*").alias("n")).where("n > 1").select(F.col(by).alias(key), F.lit(rule).alias("rule"))


#: Source databases, and kinds of initial load.
DATABASES = ("oracle", "postgres", "mysql", "sqlserver")
LOADS = ("delta", "dms")


def spec_violations(flows: DataFrame) -> DataFrame:
    """(flow_id, rule) of every rule that a flow spec breaks: an id that is not app_table, a target table that is not the source's
    with its dollar signs marked, no key, no partition, an inactive schema that is not db.schema, an id or a path used twice
    (there flow_id names the id or the path)."""
    rules = {
        "id_mismatch": F.col("flow_id") != F.concat_ws("_", "app", "src_table"),
        "target_mismatch": F.lower("target_table") != F.lower(F.replace("src_table", F.lit("$"), F.lit("__DOL"))),
        "no_key": F.size("key_columns") < 1,
        "no_partition": F.size("partition_columns") < 1,
        "schema_format": F.exists("inactive", lambda x: F.size(F.split(x, r"\.")) != 2),
    }
    return _broken(flows, "flow_id", rules).unionByName(_repeated(flows, "flow_id", "flow_id", "duplicate_id")).unionByName(_repeated(flows, "target_path", "flow_id", "duplicate_path"))


def app_violations(apps: DataFrame, flows: DataFrame) -> DataFrame:
    """(app, rule) of every rule that an app spec breaks: a database that is not supported, no topics, no flows."""
    with_flows = apps.join(flows.groupBy("app").agg(F.count("*").alias("n_flows")), "app", "left")
    rules = {"database": ~F.lower(F.trim("src_db_type")).isin(*DATABASES), "no_topics": F.size("cdc_topics") < 1, "no_flows": F.coalesce("n_flows", F.lit(0)) < 1}
    return _broken(with_flows, "app", rules)


def load_violations(specs: DataFrame) -> DataFrame:
    """(table_name, rule) of initial-load specs whose load_type is not known."""
    return _broken(specs, "table_name", {"load_type": ~F.lower(F.trim("load_type")).isin(*LOADS)})


def control_product(left: DataFrame, right: DataFrame, rows: int = 10_000) -> DataFrame:
    """Every row of one control table with every row of another: a cross join, by intent. Both are counted first, and more than
    `rows` of either is an error, so the product and what is broadcast have a bound."""
    for side in (left, right):
        n = side.limit(rows + 1).count()
        if n > rows:
            raise ValueError(f"a control table of more than {rows} rows")
    return left.crossJoin(F.broadcast(right))

"""Dictionary, manifests, registries and table tags."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed enums of a dataset manifest.
LAYERS = ("bronze", "silver", "gold")
CLASSIFICATIONS = ("Public", "Internal", "Confidential", "Restricted")
ASSET_TYPES = ("reference", "transactional", "master")
ASSET_FORMATS = ("csv", "parquet", "json")
REQUIRED = ("dataset", "domain", "layer", "owner", "classification", "data_assets")
ASSET_REQUIRED = ("name", "type", "format")
MANIFEST_SCHEMA = (
    "dataset string, domain string, layer string, owner string, steward string, classification string, "
    "retention_policy struct<raw_days: string, archive: string>, "
    "data_assets array<struct<name: string, type: string, format: string, quality_rules: array<string>>>"
)
DEFAULT_GOVERNANCE = {
    "sensitivity": "Internal",
    "owner": "DataEngineering",
    "steward": "DataEngineering",
    "retention": "730 days",
}
TODO_MEANING = "TODO: Add business meaning"
TODO_RULE = "TODO: Add quality rule"


def schema_rows(spark: SparkSession, tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table_name, position, column_name, data_type) from the schemas alone."""
    rows = [
        (table, i + 1, f.name, f.dataType.simpleString())
        for table, df in tables.items()
        for i, f in enumerate(df.schema.fields)
    ]
    return spark.createDataFrame(
        rows, "table_name string, position int, column_name string, data_type string"
    )


def data_dictionary(
    columns: DataFrame, entries: DataFrame, defaults: Mapping[str, str] = DEFAULT_GOVERNANCE
) -> DataFrame:
    """Columns joined with their entries (column_name, meaning, quality_rule); gaps marked TODO."""
    known = entries.select("column_name", "meaning", "quality_rule")
    return columns.join(known, "column_name", "left").select(
        *columns.columns,
        F.coalesce("meaning", F.lit(TODO_MEANING)).alias("meaning"),
        *[F.lit(v).alias(k) for k, v in defaults.items()],
        F.coalesce("quality_rule", F.lit(TODO_RULE)).alias("quality_rule"),
    )


def read_manifests(spark: SparkSession, path: str) -> DataFrame:
    return (
        spark.read.schema(MANIFEST_SCHEMA)
        .option("multiLine", True)
        .json(path)
        .select("*", F.col("_metadata.file_path").alias("manifest"))
    )


def manifest_violations(manifests: DataFrame, id_col: str = "manifest") -> DataFrame:
    """(id, field, problem) per violated rule of a manifest or of one of its assets."""

    def problem(bad, field, text):
        return F.when(F.coalesce(bad, F.lit(False)), F.struct(F.lit(field).alias("field"), F.lit(text).alias("problem")))

    top = [
        problem(F.col(c).isNull() | (F.size(c) == 0 if c == "data_assets" else F.lit(False)), c, "missing")
        for c in REQUIRED
    ]
    top.append(problem(~F.col("layer").isin(*LAYERS), "layer", "not_allowed"))
    top.append(problem(~F.col("classification").isin(*CLASSIFICATIONS), "classification", "not_allowed"))
    days = F.col("retention_policy.raw_days")
    top.append(
        problem(days.isNotNull() & F.coalesce(days.try_cast("int") < 0, F.lit(True)), "retention_policy.raw_days", "not_allowed")
    )
    main = manifests.select(F.col(id_col).alias("manifest"), F.explode(F.array_compact(F.array(*top))).alias("v"))
    asset = manifests.select(F.col(id_col).alias("manifest"), F.explode("data_assets").alias("a"))
    nested = [problem(F.col(f"a.{c}").isNull(), f"data_assets.{c}", "missing") for c in ASSET_REQUIRED]
    nested.append(problem(~F.col("a.type").isin(*ASSET_TYPES), "data_assets.type", "not_allowed"))
    nested.append(problem(~F.col("a.format").isin(*ASSET_FORMATS), "data_assets.format", "not_allowed"))
    inner = asset.select("manifest", F.explode(F.array_compact(F.array(*nested))).alias("v"))
    return main.unionByName(inner).select("manifest", "v.field", "v.problem")


def table_tags(tables: DataFrame, prefix: str, attributes: Mapping[str, str]) -> DataFrame:
    """(table_name, tag, value) for tables whose name starts with ``prefix``."""
    tags = F.create_map(*[F.lit(x) for item in attributes.items() for x in item])
    return tables.filter(F.col("table_name").startswith(prefix)).select(
        "table_name", F.explode(tags).alias("tag", "value")
    )


def apply_table_tags(spark: SparkSession, names: Sequence[str], prefix: str, attributes: Mapping[str, str]) -> None:
    """Set the tags as properties of catalog tables."""
    props = ", ".join(f"'{k}' = '{v}'" for k, v in attributes.items())
    for name in names:
        if name.startswith(prefix):
            spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ({props})")

"""Schemas of the stored tables, and reading and replacing them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMAS = {
    "raw_news": "id bigint, collected_at string, source string, title string, snippet string, url string, published string, search_rank int, raw_html_features string, publisher string, created_at timestamp",
    "processed_news": "id bigint, ref_raw_id bigint, published_at timestamp, source_normalized string, language string, search_rank int, is_kr boolean, is_re boolean, process_status string, updated_at timestamp, llm_decision string, llm_category string, llm_reason string",
    "topics": "id bigint, category string, topic_title string, news_ids array<bigint>, original_count int, created_at timestamp",
}


def create_tables(spark: SparkSession, database: str = "default", reset: bool = False) -> None:
    for name, schema in SCHEMAS.items():
        if reset:
            spark.sql(f"DROP TABLE IF EXISTS {database}.{name}")
        spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.{name} ({schema}) USING parquet")


def add_missing_columns(spark: SparkSession, table: str, columns: dict[str, str]) -> list[str]:
    """Adds columns that a table lacks; returns their names."""
    have = set(spark.table(table).columns)
    new = {c: t for c, t in columns.items() if c not in have}
    if new:
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({', '.join(f'{c} {t}' for c, t in new.items())})")
    return list(new)


def to_schema(df: DataFrame, schema: str) -> DataFrame:
    """Exactly the columns of ``schema``: missing ones NULL, others dropped."""
    out = []
    for field in schema_fields(df.sparkSession, schema):
        out.append((F.col(field.name) if field.name in df.columns else F.lit(None)).cast(field.dataType).alias(field.name))
    return df.select(*out)


def schema_fields(spark: SparkSession, schema: str):
    return spark.createDataFrame([], schema).schema.fields


def read_parquet(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """Foreign files may lack columns: they come out NULL."""
    return spark.read.schema(schema).parquet(path) if schema else spark.read.option("mergeSchema", True).parquet(path)


def read_jdbc(spark: SparkSession, url: str, table: str, partition_column: str | None = None, bounds: tuple[int, int] | None = None, partitions: int = 16, **options: str) -> DataFrame:
    """A table of a relational database, read in parallel ranges of a key if one is given."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table).options(**options)
    if partition_column and bounds:
        reader = reader.option("partitionColumn", partition_column).option("lowerBound", bounds[0]).option("upperBound", bounds[1]).option("numPartitions", partitions)
    return reader.load()


def write_days(df: DataFrame, path: str, day: str = "dt") -> None:
    """Replaces the days that ``df`` has and leaves the others."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(day).parquet(path)

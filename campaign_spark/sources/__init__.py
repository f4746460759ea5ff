"""Sources and sinks: CSV, Parquet, materialized stages, JDBC, SQL views."""

from campaign_spark.sources.files import (
    inferred_profile, load_csv_table, read_campaign_csvs, read_csv, read_csv_inferred, read_parquet,
    typed_ratings,
)
from campaign_spark.sources.jdbc import RangePartition, column_types_option, read_jdbc, write_jdbc
from campaign_spark.sources.ordered import first_rows, read_in_order, result_files, write_sorted_csv
from campaign_spark.sources.shapes import table_shapes
from campaign_spark.sources.sinks import write_csv, write_parquet
from campaign_spark.sources.sql import register, run_sql
from campaign_spark.sources.stages import materialize, stage_exists, stage_path

__all__ = [name for name in dir() if not name.startswith("_")]

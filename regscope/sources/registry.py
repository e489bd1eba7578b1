"""S7/S8: the table registry — name -> landed location — loaded as DataFrames
and registered as temporary views (the registry's "database")."""

from __future__ import annotations

from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

from regscope.sources.csv import read_collection_table, read_csv_union, snake_case_columns

# Registry table -> the folder group it is landed under.
COLLECTION_TABLES = ("source", "endpoint", "resource", "old-resource", "log")
PIPELINE_TABLES = ("column", "combine", "concat", "convert", "default", "default-value", "patch", "skip",
                   "transform", "filter", "lookup")
SPECIFICATION_TABLES = ("award", "collection", "theme", "typology", "dataset", "dataset-field", "field", "fund",
                        "datatype", "prefix", "severity", "issue-type", "attribution", "licence", "cohort",
                        "include-exclude", "role", "role-organisation", "role-organisation-rule", "project",
                        "project-organisation", "project-status", "provision", "provision-rule",
                        "provision-reason", "quality", "specification", "specification-status")


CACHE_TABLES = ("organisation",)
# Tables the earlier passes write, each under a folder of its own.
RESULT_TABLES = {"expectation": "expectation/", "issue": "issues/", "column-field": "column-field/",
                 "converted-resource": "converted-resource/"}


def registry_locations(collection_dir: str = "collection/", specification_dir: str = "specification/",
                       pipeline_dir: str = "pipeline/", cache_dir: str = "var/cache/",
                       results: Mapping[str, str] | None = None) -> dict[str, str]:
    """Every registry table (49) -> the folder it is landed under."""
    groups = ((COLLECTION_TABLES, collection_dir), (SPECIFICATION_TABLES, specification_dir),
              (PIPELINE_TABLES, pipeline_dir), (CACHE_TABLES, cache_dir))
    return {t: d for tables, d in groups for t in tables} | RESULT_TABLES | dict(results or {})


def view_name(table: str) -> str:
    return table.replace("-", "_")


def load_table(spark: SparkSession, location: str, table: str) -> DataFrame | None:
    """A registry table from ``location``: a folder of per-collection files
    (``<location>/<collection>/<table>.csv``) or a single ``<location>/<table>.csv``."""
    df = read_collection_table(spark, location, table)
    if df is None:
        df = read_csv_union(spark, f"{location.rstrip('/')}/{table}.csv")
    return df


def register_tables(spark: SparkSession, registry: Mapping[str, str | DataFrame], at_once: int = 8) -> dict[str, DataFrame]:
    """Load every registry entry, rename kebab-case columns to snake_case and
    register it as a temporary view named after the table (snake_case).
    Entries whose location holds no file are skipped. Most tables are small, so
    ``at_once`` of them are loaded side by side."""
    def load(entry):
        table, where = entry
        return table, where if isinstance(where, DataFrame) else load_table(spark, where, table)

    with ThreadPoolExecutor(at_once) as pool:
        loaded = list(pool.map(load, registry.items()))
    out: dict[str, DataFrame] = {}
    for table, df in loaded:
        if df is None:
            continue
        df = snake_case_columns(df)
        df.createOrReplaceTempView(view_name(table))
        out[view_name(table)] = df
    return out


def register_link_tables(tables: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """Register the link tables derived from ``;`` lists (source -> pipelines,
    resource -> endpoints, and through them resource -> organisations / datasets,
    specification -> datasets)."""
    from regscope.plans import catalogue as cat

    links: dict[str, DataFrame] = {}
    if "source" in tables:
        links["source_pipeline"] = cat.source_pipeline(tables["source"])
    if "resource" in tables:
        links["resource_endpoint"] = cat.resource_endpoint(tables["resource"])
        if "source" in tables:
            links["resource_organisation"] = cat.resource_organisation(tables["resource"], tables["source"])
            links["resource_dataset"] = cat.resource_dataset(tables["resource"], tables["source"])
    if "specification" in tables and "datasets" in tables["specification"].columns:
        links["specification_dataset"] = cat.specification_dataset(tables["specification"])
    for name, df in links.items():
        df.createOrReplaceTempView(name)
    return links


def save_registry(spark: SparkSession, registry: Mapping[str, str | DataFrame]) -> list[str]:
    """The registry database: every landed table and link table as a managed table
    (replaced as a whole). Returns the names written."""
    from regscope.sinks import save_replace

    tables = register_tables(spark, registry)
    tables |= register_link_tables(tables)
    return [save_replace(df, name) for name, df in tables.items()]

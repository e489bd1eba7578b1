"""End-to-end jobs: the three passes of a registry build, as Spark jobs.

* ``consolidate_collection`` / ``consolidate_pipeline``: landed per-collection
  CSVs -> one consolidated table each (R16).
* ``concat_issues`` / ``concat_column_fields`` / ``concat_converted_resources``:
  path-keyed partitions -> one table each (R17), with the path checks.
* ``build_registry`` (R1-R3, R18), ``build_reports`` (R4, R5) and
  ``build_performance_tables`` (R9, R11-R13): report tables written as Parquet.

Intermediates shared by several reports are written once to the shared
checkpoint folder (``sinks.materialize``), which cuts their lineage.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

from regscope.plans import performance as perf
from regscope.plans import registry as reg
from regscope.plans.consolidate import consolidate, consolidate_quarantine, path_mismatches
from regscope.sinks import materialize, save_replace, write_csv, write_parquet, write_strict
from regscope.sources.csv import (PATH_COLUMN, files_exist, read_collection_table, read_csv_typed, read_csv_union,
                                  read_partitioned_csv, surplus_cells, undeclared_columns)
from regscope.sources.registry import COLLECTION_TABLES, PIPELINE_TABLES

# Declared columns of the concatenated partition tables.
ISSUE_FIELDS = ["resource", "pipeline", "row-number", "field", "issue-type", "value", "message", "dataset",
                "entry-number", "line-number", "entity"]
OPERATIONAL_ISSUE_FIELDS = ["dataset", "resource", "line-number", "entry-number", "field", "issue-type", "value",
                            "message", "entry-date"]
COLUMN_FIELD_FIELDS = ["dataset", "resource", "column", "field", "entry-date", "end-date", "start-date"]
CONVERTED_RESOURCE_FIELDS = ["dataset", "resource", "elapsed", "status", "exception"]

# The ORDER BY of each written report (applied at the sink only).
REPORT_ORDER = {
    "reporting_historic_endpoints": ["organisation", "name", "dataset", "collection", "pipeline",
                                     "latest_log_entry_date desc"],
    "reporting_latest_endpoints": ["organisation", "name", "dataset", "collection", "pipeline",
                                   "endpoint_entry_date desc"],
    "provision_data": ["organisation"],
    "reporting_data": ["organisation", "collection"],
    "planning_authorities": ["organisation"],
    # the lookup columns the reference indexes: sorted Parquet lets row-group
    # min/max statistics prune reads by them
    "provision_summary": ["organisation", "organisation_name", "dataset"],
}


def consolidate_files(spark: SparkSession, table: str, fields: Sequence[str], paths: Sequence[str],
                      output_path: str, quarantine: str | None = None) -> str | None:
    """R16 for an explicit file list: ``paths`` of one table (headers may differ)
    -> one consolidated CSV with the declared ``fields``. A row with an unknown date or
    more cells than its header stops the pass, unless ``quarantine`` names a folder:
    then such rows go there (``dates.csv``, ``surplus.csv``), and the others on."""
    if quarantine is None:
        df = read_csv_union(spark, list(paths))
        return None if df is None else _write_table(consolidate(df, table, fields), fields, output_path)
    df = read_csv_union(spark, list(paths), surplus="quarantine")
    if df is None:
        return None
    good, bad = consolidate_quarantine(df, table, fields)
    base = quarantine.rstrip("/")
    write_csv(bad, bad.columns, f"{base}/dates.csv")
    wide = surplus_cells(spark, list(paths))
    write_csv(wide, wide.columns, f"{base}/surplus.csv")
    return _write_table(good, fields, output_path)


def _write_table(df: DataFrame, fields: Sequence[str], csv_path: str) -> str:
    """The consolidated CSV, and the same rows as Parquet beside it: later passes
    read that, which is split among tasks where quoted CSV is not."""
    rows = materialize(df, "consolidated")
    rows.select(*fields).write.mode("overwrite").parquet(csv_path.removesuffix(".csv") + ".parquet")
    return write_csv(rows, fields, csv_path)


def catalogue_from_collection(spark: SparkSession, input_dir: str) -> DataFrame:
    """R14 from a collection folder (``endpoint.csv``, ``source.csv``,
    ``resource.csv`` and optional ``old-resource.csv``): distinct
    (collection, pipeline, resource). File order is the position for
    "last row wins"."""
    from regscope.plans.catalogue import resource_catalogue
    from regscope.sources.csv import read_positioned_csv, snake_case_columns

    base = input_dir.rstrip("/")

    def table(name):
        return snake_case_columns(read_positioned_csv(spark, f"{base}/{name}.csv"))

    if files_exist(spark, f"{base}/old-resource.csv"):
        old = table("old-resource")
    else:
        old = spark.createDataFrame([], "old_resource string, resource string")
    return resource_catalogue(table("endpoint"), table("source"), table("resource"), old)


def consolidate_collection(spark: SparkSession, var_dir: str, out_dir: str,
                           schema_fields: Mapping[str, Sequence[str]],
                           tables: Sequence[str] = COLLECTION_TABLES, at_once: int = 4) -> dict[str, str]:
    """``var_dir/<collection>/<table>.csv`` -> ``out_dir/<table>.csv`` per table; most
    tables are small, so ``at_once`` of them are worked off side by side."""
    def one(t: str) -> str | None:
        df = read_collection_table(spark, var_dir, t)
        return None if df is None else _write_table(consolidate(df, t, schema_fields[t]), schema_fields[t], f"{out_dir}/{t}.csv")

    with ThreadPoolExecutor(at_once) as pool:
        written = dict(zip(tables, pool.map(one, tables), strict=True))
    return {t: path for t, path in written.items() if path is not None}


def consolidate_pipeline(spark: SparkSession, var_dir: str, out_dir: str,
                         schema_fields: Mapping[str, Sequence[str]],
                         tables: Sequence[str] = PIPELINE_TABLES) -> dict[str, str]:
    """Same for the pipeline configuration tables (zero-byte files skipped)."""
    return consolidate_collection(spark, var_dir, out_dir, schema_fields, tables)


def require_declared(spark: SparkSession, pattern: str, declared: Sequence[str], table: str) -> None:
    """K6: stop before anything is read or written if a landed file has a column that
    ``table`` does not declare; the error names some of the files and columns."""
    if not files_exist(spark, pattern):
        return
    found = undeclared_columns(spark, pattern, declared).limit(5).collect()
    if found:
        raise ValueError(f"{table} has undeclared columns: " + "; ".join(f"{r['column']} in {r['path']}" for r in found))


def concat_issues(spark: SparkSession, input_dir: str, out_dir: str) -> str | None:
    """``input_dir/<pipeline>/<resource>.csv`` -> issue table; path keys win;
    an undeclared column is an error."""
    require_declared(spark, f"{input_dir.rstrip('/')}/*/*.csv", ISSUE_FIELDS, "issue")
    df = read_partitioned_csv(spark, input_dir, "pipeline")
    if df is None:
        return None
    return write_strict(df, ISSUE_FIELDS, f"{out_dir}/issue.csv", "issue")


def concat_operational_issues(spark: SparkSession, operational_dir: str, out_dir: str) -> str | None:
    pattern = f"{operational_dir.rstrip('/')}/*/operational-issue.csv"
    require_declared(spark, pattern, OPERATIONAL_ISSUE_FIELDS, "operational-issue")
    df = read_csv_union(spark, pattern)
    if df is None:
        return None
    return write_strict(df, OPERATIONAL_ISSUE_FIELDS, f"{out_dir}/operational-issue.csv", "operational-issue")


def concat_column_fields(spark: SparkSession, input_dir: str, out_dir: str) -> str | None:
    """``input_dir/<dataset>/<resource>.csv`` -> column-field table; path keys win;
    an undeclared column is an error."""
    require_declared(spark, f"{input_dir.rstrip('/')}/*/*.csv", COLUMN_FIELD_FIELDS, "column-field")
    df = read_partitioned_csv(spark, input_dir, "dataset")
    if df is None:
        return None
    return write_strict(df, COLUMN_FIELD_FIELDS, f"{out_dir}/column-field.csv", "column-field")


def concat_converted_resources(spark: SparkSession, input_dir: str, out_dir: str):
    """``input_dir/<dataset>/<resource>.csv`` -> converted-resource table (rows as
    written; an undeclared column is an error) and the path/content mismatch report."""
    require_declared(spark, f"{input_dir.rstrip('/')}/*/*.csv", CONVERTED_RESOURCE_FIELDS, "converted-resource")
    df = read_csv_union(spark, f"{input_dir.rstrip('/')}/*/*.csv", with_path=True)
    if df is None:
        return None, None
    table = write_strict(df.drop(PATH_COLUMN), CONVERTED_RESOURCE_FIELDS, f"{out_dir}/converted-resource.csv", "converted-resource")
    return table, path_mismatches(df, "dataset", PATH_COLUMN)


def log_summary_once(tables: Mapping[str, DataFrame]) -> DataFrame:
    """The log summary every report of a pass reads, computed once."""
    return materialize(reg.log_summary(tables["log"]), "log_summary")


def _write_reports(frames: Mapping[str, DataFrame], out_dir: str, database: bool) -> dict[str, str]:
    out = {name: write_parquet(df, name, out_dir, sort_by=REPORT_ORDER.get(name)) for name, df in frames.items()}
    if database:
        for name, path in out.items():
            spark = frames[name].sparkSession
            save_replace(spark.read.parquet(path), name)
    return out


def build_registry(spark: SparkSession, tables: Mapping[str, DataFrame], out_dir: str, as_of: str,
                   operational_issue_csv: str | None = None, specification: DataFrame | None = None,
                   database: bool = False) -> dict[str, str]:
    """Second pass: most recent log, historic and latest endpoints (registry
    variants), the typed operational-issue table and the specification table,
    as Parquet, and with ``database`` as managed tables too."""
    summary = log_summary_once(tables)
    frames = {
        "reporting_most_recent_log": reg.most_recent_log(tables["log"], summary),
        "reporting_historic_endpoints": reg.historic_endpoints(tables, "registry", summary),
        "reporting_latest_endpoints": reg.latest_endpoints(tables, "registry", as_of=as_of, log_aggregate=summary),
    }
    if specification is not None:
        frames["specification"] = specification
    if operational_issue_csv:
        frames["operational_issue"] = read_csv_typed(spark, operational_issue_csv)
    return _write_reports(frames, out_dir, database)


def build_reports(tables: Mapping[str, DataFrame], out_dir: str, as_of: str, database: bool = False) -> dict[str, str]:
    """Third pass, part one: the reporting variants of historic/latest endpoints."""
    summary = log_summary_once(tables)
    return _write_reports({
        "reporting_historic_endpoints": reg.historic_endpoints(tables, "reporting", summary),
        "reporting_latest_endpoints": reg.latest_endpoints(tables, "reporting", as_of=as_of, log_aggregate=summary),
    }, out_dir, database)


def build_performance_tables(tables: Mapping[str, DataFrame], out_dir: str, as_of: str, historic: DataFrame | None = None,
                             database: bool = False) -> dict[str, str]:
    """Third pass, part two: the four performance tables. ``historic`` is the
    reporting historic endpoints table of part one, read back; without it that
    report is computed here, once."""
    if historic is None:
        historic = materialize(reg.historic_endpoints(tables, "reporting", log_summary_once(tables)), "reporting_historic_endpoints")
    provisions = perf.provision_data(tables["provision"], tables["organisation"])
    prov_rep = materialize(perf.provision_reporting(provisions, perf.reporting_data(historic)),
                           "provision_reporting")
    issues = materialize(perf.issue_counts(tables["issue"], tables["resource"], tables["issue_type"], as_of,
                                           restrict_to=prov_rep), "issue_counts")
    cf = perf.column_field_summary(tables["column_field"], tables["resource"], restrict_to=prov_rep)
    return _write_reports({
        "endpoint_dataset_summary": perf.endpoint_summary(historic),
        "endpoint_dataset_resource_summary": perf.resource_summary(prov_rep, cf),
        "endpoint_dataset_issue_type_summary": perf.issue_type_summary(prov_rep, issues),
        "provision_summary": perf.provision_summary(prov_rep, issues),
    }, out_dir, database)


def load_registry(spark: SparkSession, collection_dir: str, specification_dir: str, cache_dir: str,
                  issue_csv: str | None = None, column_field_csv: str | None = None) -> dict[str, DataFrame]:
    """The registry tables from consolidated CSV folders, with snake_case
    column names (``source_pipeline`` is derived from ``source.pipelines``)."""
    from regscope.functions.keys import explode_list
    from regscope.sources.csv import read_csv_text, snake_case_columns

    def csv(path):
        columnar = path.removesuffix(".csv") + ".parquet"  # written beside the CSV by the first pass
        if files_exist(spark, columnar):
            return snake_case_columns(spark.read.parquet(columnar))
        return snake_case_columns(read_csv_text(spark, path)) if files_exist(spark, path) else None

    base = {name: csv(f"{collection_dir.rstrip('/')}/{name}.csv")
            for name in ("source", "endpoint", "log", "resource", "old-resource")}
    tables = {k.replace("-", "_"): v for k, v in base.items() if v is not None}
    tables["organisation"] = csv(f"{cache_dir.rstrip('/')}/organisation.csv")
    for name in ("provision", "issue-type"):
        df = csv(f"{specification_dir.rstrip('/')}/{name}.csv")
        if df is not None:
            tables[name.replace("-", "_")] = df
    if issue_csv:
        tables["issue"] = csv(issue_csv)
    if column_field_csv:
        tables["column_field"] = csv(column_field_csv)
    src = tables["source"]
    lists = "pipelines" if "pipelines" in src.columns else "datasets"
    tables["source_pipeline"] = explode_list(src, lists, "pipeline", keep=["source"])
    return tables

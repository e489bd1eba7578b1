"""Command line: ``python -m regscope <command> ...`` — the registry passes as Spark jobs.

Each command builds (or joins) a Spark session; paths may be local or any
Hadoop-compatible URI.
"""

from __future__ import annotations

import argparse
import sys

from regscope.functions.dates import now
from regscope.plans import build
from regscope.session import build_session


def _fields_for(spark, schema_field_csv: str, table: str) -> list[str]:
    """Declared fields of ``table`` from the specification's schema-field table
    (a small specification file; its field list is needed on the driver to
    build the projection)."""
    from pyspark.sql import functions as F

    from regscope.sources.csv import read_csv_text

    sf = read_csv_text(spark, schema_field_csv).where(F.col("schema") == table)
    sf = sf.withColumn("__pos", F.monotonically_increasing_id())
    return [r["field"] for r in sf.orderBy("__pos").select("field").collect()]


def main(argv=None) -> int:
    ap = argparse.ArgumentParser(prog="regscope")
    sub = ap.add_subparsers(dest="cmd", required=True)

    c = sub.add_parser("consolidate", help="consolidate one table's landed CSV files")
    c.add_argument("table")
    c.add_argument("output_path")
    c.add_argument("paths", nargs="+")
    c.add_argument("--schema-field", default="specification/schema-field.csv")
    c.add_argument("--quarantine", default=None, help="folder for rows with unknown dates or surplus cells, instead of stopping at the first")

    c = sub.add_parser("concat-issues")
    c.add_argument("--issues-dir", default="issues/")
    c.add_argument("--operational-issue-dir", default="performance/operational_issue/")
    c.add_argument("--input-dir", default="var/issue/")

    c = sub.add_parser("concat-column-field")
    c.add_argument("--column-field-dir", default="column-field/")
    c.add_argument("--input-dir", default="var/column-field/")

    c = sub.add_parser("concat-converted-resource")
    c.add_argument("--input-dir", default="var/converted-resource/")
    c.add_argument("--output-dir", default="converted-resource/")

    c = sub.add_parser("expectations", help="expectation manifest + union of landed expectation Parquet files")
    c.add_argument("--spec-dir", default="specification")
    c.add_argument("--cache-dir", default="var/expectations")
    c.add_argument("--output-dir", default="expectation")
    c.add_argument("--as-of", default=None)

    c = sub.add_parser("duplicate-issues", help="issue rows repeating an earlier (row-number, field) in their file")
    c.add_argument("--input-dir", default="var/issue/")
    c.add_argument("--output", default="duplicate-issue.csv")

    c = sub.add_parser("groups", help="number the groups of a curated list whose groups are set apart by blank rows")
    c.add_argument("input")
    c.add_argument("output")

    c = sub.add_parser("append-landed", help="append path-keyed files that landed since the last run to a Parquet table")
    c.add_argument("table", choices=["issue", "column-field"])
    c.add_argument("--input-dir", default=None, help="default: var/<table>/")
    c.add_argument("--output", default=None, help="default: <table>.parquet")

    c = sub.add_parser("planning-authorities", help="organisations with a planning-authority prefix")
    c.add_argument("--source", default="collection/source.csv")
    c.add_argument("--output", default="planning-authorities.csv")

    c = sub.add_parser("slugs", help="organisation, category and geography slugs")
    c.add_argument("--cache-dir", default="var/cache")
    c.add_argument("--output", default="slugs.csv")

    c = sub.add_parser("sniff", help="classify landed files by their leading bytes")
    c.add_argument("pattern")
    c.add_argument("--output", default="filetypes.csv")

    c = sub.add_parser("resources", help="resource catalogue (collection, pipeline, resource) as CSV")
    c.add_argument("--input-dir", default="collection/")
    c.add_argument("--output", default="resources.csv")

    c = sub.add_parser("consolidate-all", help="consolidate every collection or pipeline table of all collections")
    c.add_argument("kind", choices=["collection", "pipeline"])
    c.add_argument("--var-dir", default=None, help="default: var/<kind>/")
    c.add_argument("--out-dir", default=None, help="default: <kind>/")
    c.add_argument("--schema-field", default="specification/schema-field.csv")

    c = sub.add_parser("manifest", help="what to download, as CSV (url, output_path)")
    c.add_argument("kind", choices=["issue", "column-field", "converted-resource", "resource", "collection-files", "pipeline-files",
                                    "expectation", "expectation-csv", "operational-issue"])
    c.add_argument("--input-dir", default="collection/")
    c.add_argument("--spec-dir", default="specification", help="where dataset.csv is, for the kinds that are by dataset")
    c.add_argument("--landed", default=None, help="CSV of output paths that are there already: they are left out")
    c.add_argument("--output", default="manifest.csv")
    c.add_argument("--as-of", default=None)

    c = sub.add_parser("load-registry", help="write every registry and link table as a managed table")
    c.add_argument("--collection-dir", default="collection/")
    c.add_argument("--specification-dir", default="specification/")
    c.add_argument("--pipeline-dir", default="pipeline/")
    c.add_argument("--cache-dir", default="var/cache/")

    for name in ("build-registry", "build-reports", "build-performance", "check-performance"):
        c = sub.add_parser(name)
        c.add_argument("--collection-dir", default="collection/")
        c.add_argument("--specification-dir", default="specification/")
        c.add_argument("--cache-dir", default="var/cache/")
        c.add_argument("--issue-csv", default="issues/issue.csv")
        c.add_argument("--column-field-csv", default="column-field/column-field.csv")
        c.add_argument("--operational-issue-csv", default=None)
        c.add_argument("--as-of", default=None, help="report date, ISO (default: now, UTC)")
        c.add_argument("--database", action="store_true", help="write managed tables as well")
        # the registry and the reporting variants share table names: folders of their own
        c.add_argument("--out", default="registry/" if name == "build-registry" else "dataset/")

    a = ap.parse_args(argv)
    spark = build_session()

    if a.cmd == "consolidate":
        fields = _fields_for(spark, a.schema_field, a.table)
        build.consolidate_files(spark, a.table, fields, a.paths, a.output_path, a.quarantine)
    elif a.cmd == "concat-issues":
        build.concat_issues(spark, a.input_dir, a.issues_dir)
        build.concat_operational_issues(spark, a.operational_issue_dir, a.operational_issue_dir)
    elif a.cmd == "concat-column-field":
        build.concat_column_fields(spark, a.input_dir, a.column_field_dir)
    elif a.cmd == "concat-converted-resource":
        _, mismatches = build.concat_converted_resources(spark, a.input_dir, a.output_dir)
        if mismatches is not None:
            from regscope.sinks import write_csv
            write_csv(mismatches, mismatches.columns, f"{a.output_dir.rstrip('/')}/mismatch.csv")
    elif a.cmd == "expectations":
        from regscope.plans.catalogue import dataset_manifest
        from regscope.sinks import write_csv
        from regscope.sources.csv import files_exist, read_csv_text, read_csv_union
        from regscope.sources.parquet import read_parquet_union
        out = a.output_dir.rstrip("/")
        datasets = read_csv_text(spark, f"{a.spec_dir.rstrip('/')}/dataset.csv").select("dataset", "collection")
        for kind, name in (("expectation", "manifest"), ("expectation-csv", "manifest-csv")):
            manifest = dataset_manifest(datasets, a.as_of or now(), kinds=(kind,))
            write_csv(manifest, manifest.columns, f"{out}/{name}.csv")
        pattern = f"{a.cache_dir.rstrip('/')}/*.parquet"
        if files_exist(spark, pattern):
            union = read_parquet_union(spark, pattern)
            write_csv(union, union.columns, f"{out}/expectation.csv")
        for part in ("result", "issue"):
            rows = read_csv_union(spark, f"{a.cache_dir.rstrip('/')}/*-expectation-{part}.csv")
            if rows is not None:
                write_csv(rows, rows.columns, f"{out}/expectation-{part}.csv")
    elif a.cmd == "duplicate-issues":
        from regscope.operators.windows import repeated_rows
        from regscope.sinks import write_csv
        from regscope.sources.csv import read_partitioned_csv
        issues = read_partitioned_csv(spark, a.input_dir, "pipeline", position="__pos")
        if issues is not None:
            dup = repeated_rows(issues, ["pipeline", "resource"], ["row-number", "field"], "__pos").drop("__pos")
            write_csv(dup, dup.columns, a.output)
    elif a.cmd == "groups":
        from regscope.sinks import write_csv
        from regscope.sources.csv import read_blank_delimited_groups
        groups = read_blank_delimited_groups(spark, a.input)
        write_csv(groups, [c for c in groups.columns if c != "pos"], a.output, sort_by=["pos"])
    elif a.cmd == "append-landed":
        from regscope.streaming.landing import append_landed
        fields, key = {"issue": (build.ISSUE_FIELDS, "pipeline"), "column-field": (build.COLUMN_FIELD_FIELDS, "dataset")}[a.table]
        append_landed(spark, a.input_dir or f"var/{a.table}/", a.output or f"{a.table}.parquet", fields, key).awaitTermination()
    elif a.cmd == "planning-authorities":
        from regscope.plans.catalogue import planning_authorities
        from regscope.sinks import write_csv
        from regscope.sources.csv import read_csv_text
        write_csv(planning_authorities(read_csv_text(spark, a.source)), ["organisation"], a.output,
                  sort_by=["organisation"])
    elif a.cmd == "slugs":
        from regscope.plans.catalogue import slug_inventory
        from regscope.sinks import write_csv
        from regscope.sources.csv import files_exist, read_csv_text
        base = a.cache_dir.rstrip("/")
        parts = {n: read_csv_text(spark, f"{base}/{n}.csv") if files_exist(spark, f"{base}/{n}.csv") else None
                 for n in ("organisation", "category", "geography")}
        write_csv(slug_inventory(parts["organisation"], parts["category"], parts["geography"]), ["slug", "kind"],
                  a.output)
    elif a.cmd == "sniff":
        from regscope.sinks import write_csv
        from regscope.sources.csv import sniff_files
        write_csv(sniff_files(spark, a.pattern), ["path", "filetype"], a.output)
    elif a.cmd == "consolidate-all":
        from regscope.sources.registry import COLLECTION_TABLES, PIPELINE_TABLES
        names = COLLECTION_TABLES if a.kind == "collection" else PIPELINE_TABLES
        fields = {t: _fields_for(spark, a.schema_field, t) for t in names}
        run = build.consolidate_collection if a.kind == "collection" else build.consolidate_pipeline
        run(spark, a.var_dir or f"var/{a.kind}/", (a.out_dir or f"{a.kind}/").rstrip("/"), fields)
    elif a.cmd == "manifest":
        from pyspark.sql import functions as F

        from regscope.plans import catalogue as cat
        from regscope.sinks import write_csv
        from regscope.sources.csv import read_csv_text
        if a.kind.endswith("-files"):
            source = read_csv_text(spark, f"{a.input_dir.rstrip('/')}/source.csv")
            manifest = cat.collection_file_manifest(source.where(F.col("collection") != ""), folder=a.kind.removesuffix("-files"))
        elif a.kind in cat.DATASET_TEMPLATES:
            datasets = read_csv_text(spark, f"{a.spec_dir.rstrip('/')}/dataset.csv").select("dataset", "collection")
            manifest = cat.dataset_manifest(datasets, a.as_of or now(), kinds=(a.kind,))
        else:
            manifest = cat.artifact_manifest(build.catalogue_from_collection(spark, a.input_dir), a.as_of or now(), kinds=(a.kind,))
        if a.landed:
            manifest = cat.pending_manifest(manifest, read_csv_text(spark, a.landed))
        write_csv(manifest, ["url", "output_path"], a.output)
    elif a.cmd == "load-registry":
        from regscope.sources.registry import registry_locations, save_registry
        for name in save_registry(spark, registry_locations(a.collection_dir, a.specification_dir, a.pipeline_dir, a.cache_dir)):
            print(name)
    elif a.cmd == "resources":
        from regscope.sinks import write_csv
        cat = build.catalogue_from_collection(spark, a.input_dir)
        write_csv(cat, ["collection", "pipeline", "resource"], a.output)
    else:
        tables = build.load_registry(spark, a.collection_dir, a.specification_dir, a.cache_dir,
                                     a.issue_csv, a.column_field_csv)
        as_of = a.as_of or now()
        if a.cmd == "build-registry":
            from regscope.sources.csv import files_exist, read_csv_text
            spec_csv = f"{a.specification_dir.rstrip('/')}/specification.csv"
            spec = read_csv_text(spark, spec_csv) if files_exist(spark, spec_csv) else None
            build.build_registry(spark, tables, a.out, as_of, a.operational_issue_csv, specification=spec, database=a.database)
        elif a.cmd == "build-reports":
            build.build_reports(tables, a.out, as_of, database=a.database)
        elif a.cmd == "build-performance":
            from regscope.sources.csv import files_exist
            report = f"{a.out.rstrip('/')}/reporting_historic_endpoints.parquet"
            historic = spark.read.parquet(report) if files_exist(spark, report) else None
            build.build_performance_tables(tables, a.out, as_of, historic=historic, database=a.database)
        else:
            from regscope.operators.quality import check_columns
            from regscope.plans.performance import EXPECTED_COLUMNS
            from regscope.sources.csv import files_exist
            paths = {name: f"{a.out.rstrip('/')}/{name}.parquet" for name in EXPECTED_COLUMNS}
            reports = {name: spark.read.parquet(p) for name, p in paths.items() if files_exist(spark, p)}
            try:
                check_columns(spark, reports, EXPECTED_COLUMNS)
            except ValueError as e:
                print(e, file=sys.stderr)
                return 1
    return 0


if __name__ == "__main__":
    sys.exit(main())

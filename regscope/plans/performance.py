"""Performance reports: provisions, issue counts, column mappings, endpoint
summaries, and the provision summary that combines them.

Plan notes
----------
* ``issue_counts`` aggregates the issue table (the largest input) *before*
  it meets the resource and issue-type dimensions; the joins multiply the
  per-group count by each dimension key's multiplicity, which is exactly the
  ``count(*)`` of the joined rows, without ever materialising the join.
* ``provision_summary`` never builds the provision x endpoint x issue frame:
  issue counts are first folded into six class sums per (resource, dataset),
  then joined to the provision/endpoint rows; the two distinct endpoint counts
  are a two-level aggregate (per group+endpoint flags, then sums), so there
  is no ``Expand`` and every level is a partial aggregate.
* ``restrict_to``: the issue and column-field aggregates feeding the
  provision-level reports can be restricted (null-safe semi join on the raw
  rows, before aggregating) to the (resource, dataset) pairs the
  provision/endpoint rows can match — only current resources, where the issue
  table holds every historic one. It pays when those rows are materialised
  (``plans.build`` does); inline, column pruning makes Spark recompute their
  log-side plan instead of reusing it, so single-query plans leave it off.
* pandas merge semantics are kept: left joins match NULL keys to NULL keys
  (``eqNullSafe``), ``groupby`` drops groups with a NULL key, ``!= ''`` is true
  for NULL.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regscope.functions.dates import report_date
from regscope.functions.keys import canonical_organisation, mapping_field, non_mapping_field
from regscope.operators.aggregates import distinct_list, drop_null_keys, top_by
from regscope.operators.joins import null_safe_left_join, null_safe_semi_join
from regscope.plans import registry as reg

Tables = Mapping[str, DataFrame]

# Severity x responsibility classes of the provision summary.
SEVERITIES = ("error", "warning", "notice")
RESPONSIBILITIES = ("internal", "external")
ISSUE_CLASSES = [(s, r) for s in SEVERITIES for r in RESPONSIBILITIES]

# Expected report columns (the column check's golden lists), in report order.
EXPECTED_COLUMNS = {
    "endpoint_dataset_issue_type_summary": [
        "organisation", "organisation_name", "cohort", "dataset", "collection", "pipeline", "endpoint",
        "endpoint_url", "resource", "resource_start_date", "resource_end_date", "latest_log_entry_date",
        "count_issues", "date", "issue_type", "severity", "responsibility", "field"],
    "endpoint_dataset_resource_summary": [
        "organisation", "organisation_name", "cohort", "dataset", "collection", "pipeline", "endpoint",
        "endpoint_url", "resource", "resource_start_date", "resource_end_date", "latest_log_entry_date",
        "mapping_field", "non_mapping_field"],
    "endpoint_dataset_summary": [
        "organisation", "dataset", "endpoint", "endpoint_url", "documentation_url", "resource", "latest_status",
        "latest_exception", "latest_log_entry_date", "entry_date", "end_date", "latest_resource_start_date",
        "resource_end_date"],
    "provision_summary": [
        "organisation", "organisation_name", "dataset", "provision_reason", "provision_end_date",
        "active_endpoint_count", "error_endpoint_count", "count_issue_error_internal",
        "count_issue_error_external", "count_issue_warning_internal", "count_issue_warning_external",
        "count_issue_notice_internal", "count_issue_notice_external"],
    "reporting_historic_endpoints": [
        "organisation", "name", "organisation_name", "dataset", "collection", "pipeline", "endpoint",
        "endpoint_url", "documentation_url", "licence", "latest_status", "latest_exception", "resource",
        "latest_log_entry_date", "endpoint_entry_date", "endpoint_end_date", "resource_start_date",
        "resource_end_date"],
    "reporting_latest_endpoints": [
        "organisation", "name", "organisation_name", "dataset", "collection", "pipeline", "endpoint",
        "endpoint_url", "licence", "latest_status", "days_since_200", "latest_exception", "resource",
        "latest_log_entry_date", "endpoint_entry_date", "endpoint_end_date", "resource_start_date",
        "resource_end_date", "rn"],
}

# Arg-max order over reporting_historic_endpoints rows: date, then every other
# column that can vary inside a group, all descending, NULLs last.
R4_TIE_ORDER = ["latest_log_entry_date", "resource", "latest_status", "latest_exception", "licence",
                "endpoint_url", "documentation_url", "collection", "pipeline", "dataset", "name",
                "organisation_name", "endpoint_entry_date", "endpoint_end_date", "resource_start_date",
                "resource_end_date"]


_RESOURCE_DATASET = [("resource", "resource"), ("dataset", "dataset")]


def _blank_or_null(c: str):
    return F.coalesce(F.col(c), F.lit("")) == ""


# -- R6 -----------------------------------------------------------------------
def provision_data(provision: DataFrame, organisation: DataFrame) -> DataFrame:
    o = organisation.select(F.col("organisation").alias("__org"), F.col("name").alias("organisation_name"))
    return (provision.join(o, provision["organisation"] == o["__org"])
            .select("organisation", "organisation_name", "cohort", "dataset", "provision_reason",
                    F.col("end_date").alias("provision_end_date")))


# -- R7 -----------------------------------------------------------------------
def issue_counts(issue: DataFrame, resource: DataFrame, issue_type: DataFrame,
                 as_of: str, restrict_to: DataFrame | None = None) -> DataFrame:
    """Issues of active resources per (dataset, resource, issue_type, field).

    ``restrict_to`` (frames with ``resource`` and ``dataset``, e.g. the
    provision/endpoint rows) keeps only issues a later join on those keys can
    match; the filter runs on the raw issue rows, before they are aggregated.
    """
    if restrict_to is not None:
        issue = null_safe_semi_join(issue, restrict_to, _RESOURCE_DATASET)
    counted = issue.groupBy("dataset", "resource", "issue_type", "field").agg(F.count(F.lit(1)).alias("__n"))
    active = resource.where(F.col("end_date") == "").groupBy("resource").agg(F.count(F.lit(1)).alias("__rm"))
    # one row of a repeated key gives both values: the greatest (severity, responsibility)
    types = (issue_type.groupBy("issue_type").agg(F.count(F.lit(1)).alias("__tm"),
                                                  F.max(F.struct("severity", "responsibility")).alias("__t"))
             .select("issue_type", "__tm", "__t.severity", "__t.responsibility"))
    return (counted.join(active.hint("merge"), "resource").join(types, "issue_type")
            .select((F.col("__n") * F.col("__rm") * F.col("__tm")).alias("count_issues"),
                    report_date(as_of).alias("date"), "issue_type", "severity", "responsibility",
                    "dataset", "resource", "field"))


# -- R8 -----------------------------------------------------------------------
def column_field_summary(column_field: DataFrame, resource: DataFrame,
                         restrict_to: DataFrame | None = None) -> DataFrame:
    """Per (resource, dataset) of active resources: fields that do / do not map
    their column header (sorted, ``;``-joined, NULL when none). ``restrict_to``
    as in ``issue_counts``."""
    active = resource.where(F.col("end_date") == "").select("resource")
    # as many as the registry has resources: never broadcast
    cf = column_field.join(active.hint("merge"), "resource", "left_semi")
    if restrict_to is not None:
        cf = null_safe_semi_join(cf, restrict_to, _RESOURCE_DATASET)
    tagged = cf.select("resource", "dataset",
                       mapping_field("column", "field").alias("__m"),
                       non_mapping_field("column", "field").alias("__n"))

    def joined(c):
        # comma-joined then commas -> ';' (a comma inside a field also becomes ';')
        return F.replace(distinct_list(c, ","), F.lit(","), F.lit(";"))

    return tagged.groupBy("resource", "dataset").agg(joined("__m").alias("mapping_field"),
                                                     joined("__n").alias("non_mapping_field"))


# -- R9 / R10 -------------------------------------------------------------------------
def endpoint_summary(historic: DataFrame) -> DataFrame:
    """Latest row per (organisation, dataset, endpoint) among active endpoints and resources."""
    f = historic.where(_blank_or_null("endpoint_end_date") & _blank_or_null("resource_end_date"))
    top = top_by(f, ["organisation", "dataset", "endpoint"], order=[c for c in R4_TIE_ORDER if c != "dataset"])
    return top.select("organisation", "dataset", "endpoint", "endpoint_url", "documentation_url", "resource",
                      "latest_status", "latest_exception", "latest_log_entry_date",
                      F.col("endpoint_entry_date").alias("entry_date"),
                      F.col("endpoint_end_date").alias("end_date"),
                      F.col("resource_start_date").alias("latest_resource_start_date"),
                      "resource_end_date")


def reporting_data(historic: DataFrame) -> DataFrame:
    """Latest row per (organisation, collection, pipeline, endpoint); organisation
    canonicalised *after* grouping (so canonical duplicates can remain)."""
    keys = ["organisation", "collection", "pipeline", "endpoint"]
    top = top_by(historic, keys, order=[c for c in R4_TIE_ORDER if c not in keys])
    return top.select(canonical_organisation("organisation").alias("organisation"), "collection", "pipeline",
                      "endpoint", "endpoint_url", "licence", "resource", "latest_status", "latest_exception",
                      "endpoint_entry_date", "endpoint_end_date", "resource_start_date", "resource_end_date",
                      "latest_log_entry_date")


# -- J6 / R11 / R12 -------------------------------------------------------------------
def provision_reporting(provisions: DataFrame, reporting: DataFrame) -> DataFrame:
    """Provisions left-joined to endpoint state on (organisation, dataset) = (organisation, pipeline)."""
    return null_safe_left_join(provisions, reporting, [("organisation", "organisation"), ("dataset", "pipeline")])


def _kept(df: DataFrame) -> DataFrame:
    # pandas: resource != "" keeps NULL; endpoint.notna()
    return df.where((F.col("resource").isNull() | (F.col("resource") != "")) & F.col("endpoint").isNotNull())


def resource_summary(prov_rep: DataFrame, cf_summary: DataFrame) -> DataFrame:
    # a row per resource and dataset, which file statistics make too small: never broadcast
    m = null_safe_left_join(prov_rep, cf_summary.hint("merge"), _RESOURCE_DATASET)
    return _kept(m).select(*EXPECTED_COLUMNS["endpoint_dataset_resource_summary"])


def issue_type_summary(prov_rep: DataFrame, issues: DataFrame) -> DataFrame:
    m = null_safe_left_join(prov_rep, issues.hint("merge"), _RESOURCE_DATASET)
    return _kept(m).select(*EXPECTED_COLUMNS["endpoint_dataset_issue_type_summary"])


# -- R13 ------------------------------------------------------------------------
def provision_summary(prov_rep: DataFrame, issues: DataFrame) -> DataFrame:
    """Per provision (organisation, name, dataset, reason, end date): active and
    erroring endpoint counts and issue counts by severity x responsibility,
    counting active endpoints only. Not filtered to non-blank resources.
    """
    keys = ["organisation", "organisation_name", "dataset", "provision_reason", "provision_end_date"]
    cls = {f"count_issue_{s}_{r}": (F.col("severity") == s) & (F.col("responsibility") == r)
           for s, r in ISSUE_CLASSES}
    per_resource = issues.groupBy("resource", "dataset").agg(
        *[F.sum(F.when(c, F.col("count_issues"))).alias(n) for n, c in cls.items()])
    rows = null_safe_left_join(drop_null_keys(prov_rep, keys), per_resource.hint("merge"),
                               [("resource", "resource"), ("dataset", "dataset")])
    active = _blank_or_null("endpoint_end_date")
    error = active & ~F.col("latest_status").eqNullSafe("200")
    per_endpoint = rows.groupBy(*keys, "endpoint").agg(
        F.max(active & F.col("endpoint").isNotNull()).alias("__a"),
        F.max(error & F.col("endpoint").isNotNull()).alias("__e"),
        *[F.sum(F.when(active, F.col(n))).alias(n) for n in cls])
    out = per_endpoint.groupBy(*keys).agg(
        F.count(F.when(F.col("__a"), F.lit(1))).alias("active_endpoint_count"),
        F.count(F.when(F.col("__e"), F.lit(1))).alias("error_endpoint_count"),
        *[F.coalesce(F.sum(n), F.lit(0)).cast("bigint").alias(n) for n in cls])
    return out.select(*EXPECTED_COLUMNS["provision_summary"])


# -- the whole third pass -----------------------------------------------------------------
def reporting_historic(tables: Tables, summary: DataFrame | None = None) -> DataFrame:
    """The rows of R4 that ``reporting_data`` can keep: those of each endpoint's latest log row."""
    latest = reg.latest_of_endpoints(tables["log"]) if summary is None else reg.latest_of_endpoints(summary, "latest")
    return reg.historic_endpoints(tables, "reporting", latest)


def active_historic(tables: Tables, summary: DataFrame | None = None) -> DataFrame:
    """The rows of R4 that ``endpoint_summary`` can keep: those of each endpoint's latest
    log row among resources that have not ended."""
    ended = reg.ended_resources(tables["resource"])
    latest = (reg.latest_of_endpoints(tables["log"], ended=ended) if summary is None
              else reg.latest_of_endpoints(summary, "latest", ended))
    return reg.historic_endpoints(tables, "reporting", latest)


def build_performance(tables: Tables, as_of: str, summary: DataFrame | None = None) -> dict[str, DataFrame]:
    """All performance tables from the registry tables, sharing intermediate plans.
    With the log's ``summary``, which R2 to R5 take too, the log is moved for all of them once."""
    provisions = provision_data(tables["provision"], tables["organisation"])
    prov_rep = provision_reporting(provisions, reporting_data(reporting_historic(tables, summary)))
    issues = issue_counts(tables["issue"], tables["resource"], tables["issue_type"], as_of)
    cf = column_field_summary(tables["column_field"], tables["resource"])
    return {
        "endpoint_dataset_summary": endpoint_summary(active_historic(tables, summary)),
        "endpoint_dataset_resource_summary": resource_summary(prov_rep, cf),
        "endpoint_dataset_issue_type_summary": issue_type_summary(prov_rep, issues),
        "provision_summary": provision_summary(prov_rep, issues),
    }

"""Reports in SQL over registered tables, read back by name (``spark.table``): what a
user writes who has the registry's views or managed tables, and no DataFrame at hand.

The texts name tables only; ``prefix`` puts a database or a prefix before each name.
They give the same rows as the DataFrame reports of ``plans.registry`` and
``plans.performance``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

REPORTS: dict[str, str] = {
    "reporting_historic_endpoints": """
WITH outcome AS (
  SELECT endpoint, status, exception, resource, max(entry_date) AS latest
  FROM {log} GROUP BY endpoint, status, exception, resource),
offer AS (
  SELECT DISTINCT s.endpoint, s.organisation, o.name, s.collection, p.pipeline, s.licence, s.documentation_url
  FROM {source} s JOIN {source_pipeline} p ON p.source = s.source
  JOIN {organisation} o ON o.organisation = replace(s.organisation, '-eng', '')),
place AS (
  SELECT endpoint, endpoint_url, max(struct(entry_date, end_date)) AS dates FROM {endpoint} GROUP BY endpoint, endpoint_url),
span AS (
  SELECT resource, max(struct(start_date, end_date)) AS dates FROM {resource} GROUP BY resource)
SELECT organisation, name, name AS organisation_name, pipeline AS dataset, collection, pipeline, outcome.endpoint, endpoint_url,
  documentation_url, licence, status AS latest_status, exception AS latest_exception, outcome.resource,
  substring(latest, 1, 10) AS latest_log_entry_date,
  substring(place.dates.entry_date, 1, 10) AS endpoint_entry_date, substring(place.dates.end_date, 1, 10) AS endpoint_end_date,
  substring(span.dates.start_date, 1, 10) AS resource_start_date, substring(span.dates.end_date, 1, 10) AS resource_end_date
FROM outcome JOIN offer ON offer.endpoint = outcome.endpoint JOIN place ON place.endpoint = outcome.endpoint
LEFT JOIN span ON span.resource = outcome.resource""",
    "provision_data": """
SELECT p.organisation, o.name AS organisation_name, p.cohort, p.dataset, p.provision_reason, p.end_date AS provision_end_date
FROM {provision} p JOIN {organisation} o ON o.organisation = p.organisation""",
    "active_resources": "SELECT * FROM {resource} WHERE end_date = ''",
}


class _Names(dict):
    def __init__(self, prefix: str):
        super().__init__()
        self.prefix = prefix

    def __missing__(self, table: str) -> str:
        return f"{self.prefix}{table}"


def report(spark: SparkSession, name: str, prefix: str = "") -> DataFrame:
    """The report ``name``, in SQL over tables of these names."""
    return spark.sql(REPORTS[name].format_map(_Names(prefix)))

"""DuckDB oracle statements, one per ``queries()`` key.

Each statement says what its key returns in plain SQL over the ``fx_*`` views;
``fx_with`` prefixes the views it needs. Tie orders for arg-max picks are spelled out
with ``NULLS LAST`` to match the Spark side's "greatest tuple" rule.
"""

from __future__ import annotations

from regscope.fixtures import FILE_HEADS, fx_with

AS_OF_SQL = "TIMESTAMP '2003-01-01 00:00:00'"


def _days_since(expr: str) -> str:
    return (f"CAST(trunc((epoch({AS_OF_SQL}) - epoch(TRY_CAST(substring({expr}, 1, 19) AS TIMESTAMP))) / 86400)"
            f" AS INTEGER)")


# The log in brief: its latest entry per outcome of an endpoint.
_BRIEF = "brief AS (SELECT endpoint, status, exception, resource, max(entry_date) AS log_date FROM fx_log GROUP BY ALL)"

_T2 = f"""t2 AS (SELECT endpoint, {_days_since('max(entry_date)')} AS days_since_200
FROM fx_log WHERE status = '200' GROUP BY endpoint)"""


def _lookups(columns: str, active: bool) -> str:
    """What a source offers for its endpoint (``columns``, each combination once), and
    the greatest pair of dates of each endpoint and of each resource."""
    where = "WHERE end_date = ''" if active else ""
    return f"""pipes AS (SELECT source, list_distinct(flatten(list(string_split(pipelines, ';')))) AS ps FROM fx_source GROUP BY source),
offer AS (
  SELECT DISTINCT endpoint, {columns}
  FROM (SELECT s.*, o.name, o.dataset AS org_dataset, unnest(ps) AS pipeline
        FROM fx_source s, pipes, fx_organisation o WHERE pipes.source = s.source AND o.organisation = replace(s.organisation, '-eng', ''))),
place AS (SELECT endpoint, endpoint_url, list_reverse_sort(list([entry_date, end_date]))[1] AS e FROM fx_endpoint {where} GROUP BY ALL),
span AS (SELECT resource, list_reverse_sort(list([start_date, end_date]))[1] AS r FROM fx_resource GROUP BY ALL)"""


def _historic(reporting: bool) -> str:
    own = "documentation_url" if reporting else "org_dataset"
    def cut(x):
        return f"substring({x}, 1, 10)" if reporting else x
    outcome = "status AS latest_status, exception AS latest_exception" if reporting else "status, exception"
    return f"""
WITH {_BRIEF},
{_lookups(f"organisation, name, collection, pipeline, licence, {own}", False)}
SELECT organisation, name, name AS organisation_name, {"pipeline" if reporting else "org_dataset"} AS dataset, collection, pipeline,
       endpoint, endpoint_url, {"documentation_url, " if reporting else ""}licence, {outcome}, resource,
       {cut("log_date")} AS latest_log_entry_date, {cut("e[1]")} AS endpoint_entry_date, {cut("e[2]")} AS endpoint_end_date,
       {cut("r[1]")} AS resource_start_date, {cut("r[2]")} AS resource_end_date
FROM brief JOIN place USING (endpoint) JOIN offer USING (endpoint) LEFT JOIN span USING (resource)"""


def _latest(reporting: bool) -> str:
    def cut(x):
        return f"substring({x}, 1, 10)" if reporting else x
    names = ("latest_status", "latest_exception") if reporting else ("status", "exception")
    order = ["e[1]", "log_date", "endpoint", "status", "exception", "collection", "licence", "name", "dataset", "endpoint_url",
             "days_since_200", "resource", "e[2]", "r[1]", "r[2]"]
    return f"""
WITH {_BRIEF},
{_T2},
{_lookups("organisation, name, collection, pipeline, licence" + ("" if reporting else ", org_dataset"), True)},
newest AS (SELECT endpoint, status, exception, list_reverse_sort(list([log_date, resource]))[1] AS n FROM brief GROUP BY ALL),
row_ AS (
  SELECT offer.*, {"pipeline" if reporting else "org_dataset"} AS dataset, endpoint_url, e, status, exception, n[1] AS log_date, n[2] AS resource,
         days_since_200, r
  FROM newest JOIN place USING (endpoint) JOIN offer USING (endpoint) LEFT JOIN t2 USING (endpoint) LEFT JOIN span ON span.resource = n[2])
SELECT organisation, name, name AS organisation_name, dataset, collection, pipeline, endpoint, endpoint_url, licence,
       status AS {names[0]}, days_since_200, exception AS {names[1]}, resource, {cut("log_date")} AS latest_log_entry_date,
       {cut("e[1]")} AS endpoint_entry_date, {cut("e[2]")} AS endpoint_end_date, {cut("r[1]")} AS resource_start_date,
       {cut("r[2]")} AS resource_end_date, CAST(1 AS BIGINT) AS rn
FROM row_
QUALIFY row_number() OVER (PARTITION BY organisation, pipeline ORDER BY {", ".join(x + " DESC NULLS LAST" for x in order)}) = 1"""


_R4 = _historic(True)

# Arg-max tie order over reporting_historic_endpoints rows.
_R4_ORDER = ("latest_log_entry_date DESC NULLS LAST, resource DESC NULLS LAST, latest_status DESC NULLS LAST, "
             "latest_exception DESC NULLS LAST, licence DESC NULLS LAST, endpoint_url DESC NULLS LAST, "
             "documentation_url DESC NULLS LAST, collection DESC NULLS LAST, pipeline DESC NULLS LAST, "
             "dataset DESC NULLS LAST, name DESC NULLS LAST, organisation_name DESC NULLS LAST, "
             "endpoint_entry_date DESC NULLS LAST, endpoint_end_date DESC NULLS LAST, "
             "resource_start_date DESC NULLS LAST, resource_end_date DESC NULLS LAST")

_SQL: dict[str, str] = {
    "most_recent_log": """
SELECT * EXCLUDE (d) FROM (SELECT *, TRY_CAST(left(entry_date, 10) AS DATE) AS d FROM fx_log)
QUALIFY d = max(d) OVER (PARTITION BY endpoint)""",
    "historic_endpoints_registry": _historic(False),
    "reporting_historic_endpoints": _R4,
    "latest_endpoints_registry": _latest(False),
    "reporting_latest_endpoints": _latest(True),
    "log_star": """
SELECT fx_log.*, offer.* EXCLUDE (at_), endpoint_url, ep.entry_date AS endpoint_entry_date, ep.end_date AS endpoint_end_date
FROM fx_log, fx_endpoint ep, (
  SELECT s.endpoint AS at_, s.organisation, o.name, o.dataset AS org_dataset, s.collection, pipeline, licence, documentation_url
  FROM fx_source s, fx_source_pipeline p, fx_organisation o
  WHERE p.source = s.source AND o.organisation = replace(s.organisation, '-eng', '')) offer
WHERE ep.endpoint = fx_log.endpoint AND offer.at_ = fx_log.endpoint""",
    "days_since_200": f"""
WITH {_T2}
SELECT e.endpoint, e.endpoint_url, t2.days_since_200 FROM fx_endpoint e LEFT JOIN t2 ON e.endpoint = t2.endpoint""",
    "latest_by_key": """
SELECT endpoint, entry_date, resource, status, exception FROM (
  SELECT *, row_number() OVER (PARTITION BY endpoint ORDER BY entry_date DESC NULLS LAST, resource DESC NULLS LAST,
                                status DESC NULLS LAST, exception DESC NULLS LAST) AS k FROM fx_log) WHERE k = 1""",
}


def _order(cols, exclude=()) -> str:
    return ", ".join(f"{c} DESC NULLS LAST" for c in cols if c not in exclude)


_R4_TIES = ["latest_log_entry_date", "resource", "latest_status", "latest_exception", "licence",
            "endpoint_url", "documentation_url", "collection", "pipeline", "dataset", "name",
            "organisation_name", "endpoint_entry_date", "endpoint_end_date", "resource_start_date",
            "resource_end_date"]

_RD_KEYS = ("organisation", "collection", "pipeline", "endpoint")

# Shared CTE items (each entry is "name AS (...)").
_CTE = {
    "rhe": f"rhe AS ({_R4})",
    "rd": f"""rd AS (
  SELECT replace(organisation, '-eng', '') AS organisation, collection, pipeline, endpoint, endpoint_url, licence,
         resource, latest_status, latest_exception, endpoint_entry_date, endpoint_end_date, resource_start_date,
         resource_end_date, latest_log_entry_date
  FROM (SELECT *, row_number() OVER (PARTITION BY organisation, collection, pipeline, endpoint
                                     ORDER BY {_order(_R4_TIES, _RD_KEYS)}) AS k FROM rhe) WHERE k = 1)""",
    "pd": """pd AS (
  SELECT p.organisation, o.name AS organisation_name, p.cohort, p.dataset, p.provision_reason,
         p.end_date AS provision_end_date
  FROM fx_provision p JOIN fx_organisation o ON o.organisation = p.organisation)""",
    "pr": """pr AS (
  SELECT pd.*, rd.collection, rd.pipeline, rd.endpoint, rd.endpoint_url, rd.licence, rd.resource,
         rd.latest_status, rd.latest_exception, rd.endpoint_entry_date, rd.endpoint_end_date,
         rd.resource_start_date, rd.resource_end_date, rd.latest_log_entry_date
  FROM pd LEFT JOIN rd ON pd.organisation IS NOT DISTINCT FROM rd.organisation
                      AND pd.dataset IS NOT DISTINCT FROM rd.pipeline)""",
    # issues counted first; then each count is taken as often as its resource is active,
    # with what its type is known for
    "ic": """seen AS (SELECT resource, dataset, issue_type, field, count(*) AS n FROM fx_issue GROUP BY ALL),
active AS (SELECT resource, count(*) AS times FROM fx_resource WHERE end_date = '' GROUP BY resource),
known AS (SELECT issue_type, max([severity, responsibility]) AS pair, count(*) AS times FROM fx_issue_type GROUP BY issue_type),
ic AS (
  SELECT CAST(seen.n * active.times * known.times AS BIGINT) AS count_issues, '01-01-2003' AS date, issue_type,
         pair[1] AS severity, pair[2] AS responsibility, dataset, resource, field
  FROM seen JOIN active USING (resource) JOIN known USING (issue_type))""",
    # a header in its canonical form decides what its field is; lists are sorted
    "cfs": """header AS (
  SELECT DISTINCT resource, dataset, field,
         list_contains(['geometry', 'point'], field) OR upper(field) = translate(upper(column_name), ' _', '--') AS mapped
  FROM fx_column_field SEMI JOIN (SELECT resource FROM fx_resource WHERE end_date = '') USING (resource)),
cfs AS (
  SELECT resource, dataset,
         nullif(array_to_string(list_sort(list(field) FILTER (mapped)), ';'), '') AS mapping_field,
         nullif(array_to_string(list_sort(list(field) FILTER (NOT mapped)), ';'), '') AS non_mapping_field
  FROM header GROUP BY resource, dataset)""",
}
_CTE_DEPS = {"rd": ["rhe"], "pr": ["pd", "rd"]}


def _with(names, body: str) -> str:
    order = ["rhe", "rd", "pd", "pr", "ic", "cfs"]
    need: set[str] = set()

    def add(n):
        if n not in need:
            need.add(n)
            for d in _CTE_DEPS.get(n, []):
                add(d)
    for n in names:
        add(n)
    return "WITH " + ",\n".join(_CTE[n] for n in order if n in need) + "\n" + body


_RS_COLS = ("organisation, organisation_name, cohort, dataset, collection, pipeline, endpoint, endpoint_url, "
            "resource, resource_start_date, resource_end_date, latest_log_entry_date")
_KEPT = "WHERE (resource IS NULL OR resource <> '') AND endpoint IS NOT NULL"
_ACTIVE = "coalesce(endpoint_end_date, '') = ''"


def _class_sum(sev: str, resp: str) -> str:
    return (f"CAST(coalesce(sum(CASE WHEN severity = '{sev}' AND responsibility = '{resp}' AND {_ACTIVE} "
            f"THEN count_issues END), 0) AS BIGINT) AS count_issue_{sev}_{resp}")


_SQL.update({
    "provision_data": _with(["pd"], "SELECT * FROM pd"),
    "issue_counts": _with(["ic"], "SELECT * FROM ic"),
    "column_field_summary": _with(["cfs"], "SELECT * FROM cfs"),
    "endpoint_summary": _with(["rhe"], f"""
SELECT organisation, dataset, endpoint, endpoint_url, documentation_url, resource, latest_status, latest_exception,
       latest_log_entry_date, endpoint_entry_date AS entry_date, endpoint_end_date AS end_date,
       resource_start_date AS latest_resource_start_date, resource_end_date
FROM (SELECT *, row_number() OVER (PARTITION BY organisation, dataset, endpoint
                                   ORDER BY {_order(_R4_TIES, ("dataset",))}) AS k
      FROM rhe WHERE (endpoint_end_date = '' OR endpoint_end_date IS NULL)
                 AND (resource_end_date = '' OR resource_end_date IS NULL))
WHERE k = 1"""),
    "reporting_data": _with(["rd"], "SELECT * FROM rd"),
    "provision_reporting": _with(["pr"], "SELECT * FROM pr"),
    "resource_summary": _with(["pr", "cfs"], f"""
SELECT {_RS_COLS}, mapping_field, non_mapping_field FROM (
  SELECT pr.*, cfs.mapping_field, cfs.non_mapping_field FROM pr
  LEFT JOIN cfs ON pr.resource IS NOT DISTINCT FROM cfs.resource AND pr.dataset IS NOT DISTINCT FROM cfs.dataset)
{_KEPT}"""),
    "issue_type_summary": _with(["pr", "ic"], f"""
SELECT {_RS_COLS}, count_issues, date, issue_type, severity, responsibility, field FROM (
  SELECT pr.*, ic.count_issues, ic.date, ic.issue_type, ic.severity, ic.responsibility, ic.field FROM pr
  LEFT JOIN ic ON pr.resource IS NOT DISTINCT FROM ic.resource AND pr.dataset IS NOT DISTINCT FROM ic.dataset)
{_KEPT}"""),
    "provision_summary": _with(["pr", "ic"], f"""
SELECT organisation, organisation_name, dataset, provision_reason, provision_end_date,
       count(DISTINCT CASE WHEN {_ACTIVE} THEN endpoint END) AS active_endpoint_count,
       count(DISTINCT CASE WHEN {_ACTIVE} AND latest_status IS DISTINCT FROM '200' THEN endpoint END)
           AS error_endpoint_count,
       {_class_sum('error', 'internal')}, {_class_sum('error', 'external')},
       {_class_sum('warning', 'internal')}, {_class_sum('warning', 'external')},
       {_class_sum('notice', 'internal')}, {_class_sum('notice', 'external')}
FROM (SELECT pr.*, ic.count_issues, ic.severity, ic.responsibility FROM pr
      LEFT JOIN ic ON pr.resource IS NOT DISTINCT FROM ic.resource AND pr.dataset IS NOT DISTINCT FROM ic.dataset)
WHERE organisation IS NOT NULL AND organisation_name IS NOT NULL AND dataset IS NOT NULL
  AND provision_reason IS NOT NULL AND provision_end_date IS NOT NULL
GROUP BY organisation, organisation_name, dataset, provision_reason, provision_end_date"""),
})


def oracle_sql() -> dict[str, str]:
    return {k: fx_with(v) for k, v in _SQL.items()}


# -- catalogue ------------------------------------------------------------------------
_CAT = """ep AS (SELECT DISTINCT endpoint FROM fx_endpoint),
src AS (SELECT * FROM fx_source WHERE coalesce(endpoint, '') <> '' AND endpoint IN (SELECT endpoint FROM ep)),
epc AS (SELECT ep.endpoint, coalesce(c.collection, ep.own) AS collection
        FROM (SELECT endpoint, arg_max(collection, pos) AS own FROM fx_endpoint GROUP BY endpoint) ep
        LEFT JOIN (SELECT endpoint, arg_max(coalesce(collection, ''), pos) AS collection FROM src GROUP BY endpoint) c
        ON ep.endpoint = c.endpoint),
epp AS (SELECT DISTINCT endpoint, pipeline FROM (SELECT endpoint, unnest(string_split(pipelines, ';')) AS pipeline
                                                FROM src)),
res AS (SELECT resource, arg_max(endpoints, pos) AS endpoints FROM fx_resource GROUP BY resource),
live AS (SELECT * FROM res WHERE resource NOT IN (SELECT old_resource FROM fx_old_resource)),
rep AS (SELECT resource, unnest(string_split(endpoints, ';')) AS endpoint,
               unnest(range(1, len(string_split(endpoints, ';')) + 1)) AS k FROM live),
matched AS (SELECT rep.resource, rep.endpoint, rep.k, epc.collection FROM rep JOIN epc ON rep.endpoint = epc.endpoint),
rc AS (SELECT resource, arg_max(collection, k) AS collection FROM matched GROUP BY resource),
rp AS (SELECT DISTINCT m.resource, p.pipeline FROM matched m JOIN epp p ON m.endpoint = p.endpoint),
cat AS (SELECT rc.collection, rp.pipeline, rp.resource FROM rp JOIN rc ON rp.resource = rc.resource)"""

_VERSION = "CAST(CAST(epoch(date_trunc('hour', TIMESTAMP '2003-01-01 00:00:00')) AS BIGINT) AS VARCHAR)"
_HOST = "https://files.example.org/"


def _manifest(kind: str, url_mid: str) -> str:
    return (f"SELECT DISTINCT '{kind}' AS kind, '{_HOST}' || collection || '-collection/{url_mid}/' || pipeline || '/' "
            f"|| resource || '.csv?version=' || {_VERSION} AS url, "
            f"'var/{kind}/' || pipeline || '/' || resource || '.csv' AS output_path FROM cat WHERE pipeline <> ''")


_P = "'/([a-zA-Z0-9_-]+)/([a-f0-9]+).csv$'"


def _norm_date_sql(c: str) -> str:
    return (f"CASE WHEN {c} IS NULL OR {c} = '' THEN '' "
            f"WHEN length({c}) = 10 THEN strftime(strptime({c}, '%Y-%m-%d'), '%Y-%m-%d') "
            f"WHEN length({c}) = 7 THEN strftime(strptime({c} || '-01', '%Y-%m-%d'), '%Y-%m-%d') "
            f"WHEN length({c}) = 4 THEN strftime(strptime({c} || '-01-01', '%Y-%m-%d'), '%Y-%m-%d') "
            f"ELSE error('bad date: ' || {c}) END")


def _norm_ts_sql(c: str) -> str:
    out = "'%Y-%m-%dT%H:%M:%SZ'"
    return (f"CASE WHEN {c} IS NULL OR {c} = '' THEN '' "
            f"WHEN length({c}) >= 20 THEN strftime(strptime(substring({c}, 1, 19), '%Y-%m-%dT%H:%M:%S'), {out}) "
            f"WHEN length({c}) = 10 THEN strftime(strptime({c}, '%Y-%m-%d'), {out}) "
            f"WHEN length({c}) = 7 THEN strftime(strptime({c} || '-01', '%Y-%m-%d'), {out}) "
            f"WHEN length({c}) = 4 THEN strftime(strptime({c} || '-01-01', '%Y-%m-%d'), {out}) "
            f"ELSE error('bad date: ' || {c}) END")


def _filetype_sql(c: str) -> str:
    head = f"lower(substring({c}, 1, 10))"
    excel = "chr(208) || chr(207) || chr(17) || chr(224) || chr(161) || chr(177) || chr(26) || chr(225)"
    workbook = " OR ".join(f"starts_with(substring({c}, 31, 20), '{n}')" for n in ("[Content_Types].xml", "_rels/.rels", "docProps/", "xl/"))
    return (f"CASE WHEN starts_with({c}, {excel}) THEN 'excel' "
            f"WHEN starts_with({c}, 'PK' || chr(3) || chr(4)) AND ({workbook}) THEN 'excel' "
            f"WHEN starts_with({c}, 'PK' || chr(3) || chr(4)) THEN 'zip' "
            f"WHEN starts_with({c}, 'SQLite format 3' || chr(0)) THEN 'sqlite' "
            f"WHEN starts_with({head}, '<!doctype ') THEN 'html' "
            f"WHEN starts_with({head}, '<?xml ') OR starts_with({head}, '<wfs:') THEN 'xml' "
            f"WHEN starts_with({head}, '{{') THEN 'json' ELSE 'csv' END")


_MAP = ("CASE WHEN upper(field) = upper(replace(replace(column_name, ' ', '-'), '_', '-')) "
        "OR field IN ('geometry', 'point') THEN field END")
_NONMAP = ("CASE WHEN upper(field) <> upper(replace(replace(column_name, ' ', '-'), '_', '-')) "
           "AND field NOT IN ('geometry', 'point') THEN field END")

_SQL.update({
    "resource_catalogue": f"WITH {_CAT}\nSELECT * FROM cat",
    "unmapped_resources": f"""WITH {_CAT},
flags AS (SELECT m.resource, bool_or(p.pipeline = '') AS blank FROM matched m JOIN epp p ON m.endpoint = p.endpoint
          GROUP BY m.resource)
SELECT * FROM (
  SELECT live.resource, rc.collection,
         CASE WHEN rc.collection IS NULL THEN 'no-endpoint' WHEN f.blank IS NULL THEN 'no-pipeline'
              WHEN f.blank THEN 'blank-pipeline' END AS reason
  FROM live LEFT JOIN rc ON live.resource = rc.resource LEFT JOIN flags f ON live.resource = f.resource)
WHERE reason IS NOT NULL""",
    "active_resources": "SELECT * FROM fx_resource WHERE end_date = ''",
    "live_resources": "SELECT * FROM fx_resource WHERE resource NOT IN (SELECT old_resource FROM fx_old_resource)",
    "planning_authorities": """
SELECT DISTINCT organisation FROM fx_source
WHERE starts_with(organisation, 'local-authority') OR starts_with(organisation, 'development-corporation')
   OR starts_with(organisation, 'national-park')""",
    "source_pipeline": "SELECT * FROM fx_source_pipeline",
    "resource_endpoint": """
SELECT DISTINCT resource, endpoint FROM (SELECT resource, unnest(string_split(endpoints, ';')) AS endpoint
                                         FROM fx_resource)""",
    "resource_organisation": """
WITH re AS (SELECT DISTINCT resource, unnest(string_split(endpoints, ';')) AS endpoint FROM fx_resource)
SELECT DISTINCT re.resource, s.organisation FROM re JOIN fx_source s ON s.endpoint = re.endpoint
WHERE coalesce(s.endpoint, '') <> ''""",
    "resource_dataset": """
WITH re AS (SELECT DISTINCT resource, unnest(string_split(endpoints, ';')) AS endpoint FROM fx_resource),
     sp AS (SELECT endpoint, unnest(string_split(pipelines, ';')) AS dataset FROM fx_source
            WHERE coalesce(endpoint, '') <> '')
SELECT DISTINCT re.resource, sp.dataset FROM re JOIN sp ON sp.endpoint = re.endpoint""",
    "canonical_organisation": """
SELECT s.source, s.organisation, o.organisation AS canonical_organisation, o.name AS organisation_name
FROM fx_source s JOIN fx_organisation o ON o.organisation = replace(s.organisation, '-eng', '')""",
    "organisation_datasets": """
WITH p AS (SELECT organisation, unnest(string_split(coalesce(pipelines, ''), ';')) AS dataset FROM fx_source)
SELECT organisation, string_agg(DISTINCT dataset, ';' ORDER BY dataset) AS datasets,
       count(DISTINCT dataset) AS dataset_count FROM p GROUP BY organisation""",
    "dataset_organisations": """
WITH p AS (SELECT organisation, unnest(string_split(coalesce(pipelines, ''), ';')) AS dataset FROM fx_source)
SELECT dataset, string_agg(DISTINCT organisation, ';' ORDER BY organisation) AS organisations,
       count(DISTINCT organisation) AS organisation_count FROM p GROUP BY dataset""",
    "datasets_of_collection": """
SELECT DISTINCT dataset FROM (SELECT collection, unnest(string_split(pipelines, ';')) AS dataset FROM fx_source)
WHERE collection = 'collection-1'""",
    "artifact_manifest": f"""WITH {_CAT}
{_manifest('issue', 'issue')}
UNION
{_manifest('column-field', 'var/column-field')}
UNION
{_manifest('converted-resource', 'var/converted-resource')}""",
    "dataset_manifest": f"""
WITH listed AS (SELECT DISTINCT dataset, collection FROM (
             SELECT collection, unnest(string_split(pipelines, ';')) AS dataset FROM fx_source)),
d AS (SELECT * FROM listed WHERE coalesce(collection, '') <> '')
SELECT DISTINCT 'expectation' AS kind,
       '{_HOST}log/expectation/dataset=' || dataset || '/' || dataset || '.parquet?version=' || {_VERSION} AS url,
       'var/expectations/' || dataset || '.parquet' AS output_path FROM d
UNION
SELECT 'expectation-csv', '{_HOST}' || collection || '-collection/dataset/' || dataset
       || '-expectation-result.csv?version=' || {_VERSION}, 'var/expectations/' || dataset || '-expectation-result.csv' FROM d
UNION
SELECT 'expectation-csv', '{_HOST}' || collection || '-collection/dataset/' || dataset
       || '-expectation-issue.csv?version=' || {_VERSION}, 'var/expectations/' || dataset || '-expectation-issue.csv' FROM d
UNION
SELECT 'operational-issue', '{_HOST}performance/operational_issue/' || dataset || '/operational-issue.csv?version='
       || {_VERSION}, 'performance/operational_issue/' || dataset || '/operational-issue.csv' FROM listed""",
    "collection_file_manifest": f"""
SELECT c.collection, f.file, '{_HOST}' || c.collection || '-collection/collection/' || f.file AS url,
       'var/collection/' || c.collection || '/' || f.file AS output_path
FROM (SELECT DISTINCT collection FROM fx_source WHERE coalesce(collection, '') <> '') c
CROSS JOIN (VALUES ('endpoint.csv'), ('source.csv'), ('log.csv'), ('resource.csv'), ('old-resource.csv')) f(file)""",
    "pending_manifest": f"""WITH {_CAT}
SELECT * FROM ({_manifest('issue', 'issue')}) m
WHERE output_path NOT IN (SELECT output_path FROM fx_landed)""",
    "slug_inventory": """
SELECT '/organisation/' || split_part(organisation, ':', 1) || '/' || split_part(organisation, ':', 2) AS slug,
       'organisation' AS kind FROM fx_organisation
UNION ALL SELECT replace(slug_id_label, chr(9), '') AS slug, 'category' AS kind FROM fx_geography
UNION ALL SELECT slug_id_label AS slug, 'geography' AS kind FROM fx_geography WHERE slug_id_label <> ''""",
    "column_mapping_flag": f"""
SELECT resource, dataset, column_name, field,
       upper(field) = upper(replace(replace(column_name, ' ', '-'), '_', '-')) AS header_match,
       {_MAP} AS mapping_field, {_NONMAP} AS non_mapping_field
FROM fx_column_field""",
    "normalise_date": f"""
SELECT source, start_date, {_norm_date_sql('start_date')} AS start_date_normalised FROM fx_raw_source""",
    "normalise_timestamp": f"""
SELECT source, entry_date, {_norm_ts_sql('entry_date')} AS entry_date_normalised FROM fx_raw_source""",
    "normalise_dates_table": f"""
SELECT source, collection, organisation, endpoint, dataset, pipeline, {_norm_ts_sql('entry_date')} AS entry_date,
       {_norm_date_sql('start_date')} AS start_date, undeclared FROM fx_raw_source""",
    "source_key": """
SELECT CASE WHEN coalesce(source, '') <> '' THEN md5(collection || '|' || organisation || '|' || endpoint)
            ELSE source END AS source, collection, organisation, endpoint FROM fx_raw_source""",
    "default_dataset": """
SELECT source, pipeline, CASE WHEN coalesce(dataset, '') = '' THEN coalesce(pipeline, '') ELSE dataset END AS dataset
FROM fx_raw_source""",
    "project_declared": """
SELECT source, collection, organisation, endpoint, '' AS licence, '' AS documentation_url, dataset, entry_date,
       start_date, '' AS end_date FROM fx_raw_source""",
    "consolidate_source": f"""
SELECT CASE WHEN coalesce(source, '') <> '' THEN md5(collection || '|' || organisation || '|' || endpoint)
            ELSE source END AS source, collection, organisation, endpoint, '' AS licence, '' AS documentation_url,
       CASE WHEN coalesce(dataset, '') = '' THEN coalesce(pipeline, '') ELSE dataset END AS dataset,
       {_norm_ts_sql('entry_date')} AS entry_date, {_norm_date_sql('start_date')} AS start_date, '' AS end_date
FROM fx_raw_source""",
    "hour_version": "SELECT event_id, CAST(epoch(date_trunc('hour', ts)) AS BIGINT) AS hour_version FROM events",
    "path_keys": f"""
SELECT path, regexp_extract(path, {_P}, 1) AS dataset, regexp_extract(path, {_P}, 2) AS resource, elapsed, status,
       exception FROM fx_converted""",
    "path_mismatch": f"""
SELECT path, 'dataset' AS field, regexp_extract(path, {_P}, 1) AS dir_value, dataset AS file_value FROM fx_converted
WHERE regexp_extract(path, {_P}, 1) IS DISTINCT FROM dataset
UNION ALL
SELECT path, 'resource' AS field, regexp_extract(path, {_P}, 2) AS dir_value, resource AS file_value FROM fx_converted
WHERE regexp_extract(path, {_P}, 2) IS DISTINCT FROM resource""",
    "sniff_filetype": f"""
SELECT 'pages' AS source_table, page_id AS id, {_filetype_sql('html')} AS filetype FROM pages
UNION ALL
SELECT 'documents' AS source_table, doc_id AS id, {_filetype_sql('content')} AS filetype FROM fx_file""",
    "duplicate_issues": """
SELECT resource, dataset, row_number, field, issue_type, value, line_number FROM (
  SELECT *, row_number() OVER (PARTITION BY dataset, resource, row_number, field ORDER BY line_number) AS k
  FROM fx_issue) WHERE k > 1""",
    "blank_delimited_groups": """
SELECT pos, slug, name, group_id FROM (
  SELECT *, CAST(sum(CASE WHEN coalesce(slug, '') = '' AND coalesce(name, '') = '' THEN 1 ELSE 0 END)
                 OVER (ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS group_id,
         (coalesce(slug, '') = '' AND coalesce(name, '') = '') AS b
  FROM fx_blank_list) WHERE NOT b""",
    "concat_tables": """
SELECT resource, dataset, row_number, field, issue_type, value, line_number, CAST(NULL AS BIGINT) AS entry_number, '' AS message, '' AS entry_date FROM fx_issue
UNION ALL BY NAME
SELECT *, '' AS row_number FROM fx_operational_issue""",
    "expectation_union": "SELECT * FROM fx_expectation_a UNION ALL BY NAME SELECT * FROM fx_expectation_b",
    "append_issues": """
SELECT dataset, resource, line_number, entry_number, field, issue_type, value, message, entry_date,
       '' AS row_number FROM fx_operational_issue
UNION ALL
SELECT dataset, resource, line_number, CAST(NULL AS BIGINT) AS entry_number, field, issue_type, value,
       '' AS message, '' AS entry_date, row_number FROM fx_issue""",
    "table_inventory": "\nUNION ALL\n".join(
        f"SELECT '{n}' AS table_name, count(*) AS row_count FROM fx_{n}" for n in (
            "source", "endpoint", "resource", "old_resource", "log", "organisation", "provision", "issue_type", "issue", "column_field",
            "source_pipeline")) + """
UNION ALL SELECT 'resource_endpoint', count(*) FROM (SELECT DISTINCT resource, unnest(string_split(endpoints, ';')) FROM fx_resource)
UNION ALL SELECT 'resource_organisation', count(*) FROM (
  SELECT DISTINCT r.resource, s.organisation FROM fx_source s JOIN (SELECT resource, unnest(string_split(endpoints, ';')) AS e FROM fx_resource) r
  ON s.endpoint = r.e WHERE s.endpoint <> '')
UNION ALL SELECT 'resource_dataset', count(*) FROM (
  SELECT DISTINCT r.resource, unnest(string_split(s.pipelines, ';')) FROM fx_source s
  JOIN (SELECT resource, unnest(string_split(endpoints, ';')) AS e FROM fx_resource) r ON s.endpoint = r.e WHERE s.endpoint <> '')""",
    "csv_round_trip": "SELECT * FROM fx_cell",
    "csv_union": """
SELECT resource, dataset, row_number, field, issue_type, CAST(line_number AS VARCHAR) AS line_number, '' AS entry_number, '' AS value, '' AS entry_date FROM fx_issue
UNION ALL BY NAME
SELECT resource, dataset, '' AS row_number, field, issue_type, CAST(line_number AS VARCHAR) AS line_number, CAST(entry_number AS VARCHAR) AS entry_number,
       value, entry_date FROM fx_operational_issue""",
    "csv_positions": """
SELECT CAST(pos AS VARCHAR) AS pos, slug, name, group_id FROM (
  SELECT *, CAST(count(*) FILTER (slug = '' AND name = '') OVER (ORDER BY pos) AS BIGINT) AS group_id FROM fx_blank_list) WHERE slug <> '' OR name <> ''""",
    "csv_typed": """
SELECT dataset, resource, CAST(line_number AS INTEGER) AS line_number, CAST(entry_number AS INTEGER) AS entry_number, field, issue_type,
       CAST(value AS DOUBLE) AS value, CAST(entry_date AS DATE) AS entry_date FROM fx_operational_issue""",
    "parquet_union": """
SELECT doc_id, CAST(quality AS BIGINT) AS n, CAST(NULL AS TIMESTAMP) AS "at", CAST(NULL AS BOOLEAN) AS flag FROM labels
UNION ALL SELECT o_orderkey, o_custkey, CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP), NULL FROM orders
UNION ALL SELECT o_orderkey, NULL, CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP), o_orderkey > 100 FROM orders""",
})


# Stated here, not taken from the implementation: the reports' columns.
_COLUMNS = {
    "endpoint_dataset_issue_type_summary": "organisation;organisation_name;cohort;dataset;collection;pipeline;endpoint;endpoint_url;resource;"
                                           "resource_start_date;resource_end_date;latest_log_entry_date;count_issues;date;issue_type;severity;"
                                           "responsibility;field",
    "endpoint_dataset_summary": "organisation;dataset;endpoint;endpoint_url;documentation_url;resource;latest_status;latest_exception;"
                                "latest_log_entry_date;entry_date;end_date;latest_resource_start_date;resource_end_date",
    "provision_summary": "organisation;organisation_name;dataset;provision_reason;provision_end_date;active_endpoint_count;error_endpoint_count;"
                         "count_issue_error_internal;count_issue_error_external;count_issue_warning_internal;count_issue_warning_external;"
                         "count_issue_notice_internal;count_issue_notice_external",
    "reporting_latest_endpoints": "organisation;name;organisation_name;dataset;collection;pipeline;endpoint;endpoint_url;licence;latest_status;"
                                  "days_since_200;latest_exception;resource;latest_log_entry_date;endpoint_entry_date;endpoint_end_date;"
                                  "resource_start_date;resource_end_date;rn;extra",
}
_COLUMNS["reporting_historic_endpoints"] = ("organisation;name;organisation_name;dataset;collection;pipeline;endpoint;endpoint_url;documentation_url;"
                                            "latest_status;latest_exception;resource;latest_log_entry_date;endpoint_entry_date;endpoint_end_date;"
                                            "resource_start_date;resource_end_date")
_FROM = {"endpoint_dataset_issue_type_summary": "issue_type_summary", "endpoint_dataset_summary": "endpoint_summary", "provision_summary": "provision_summary",
         "reporting_latest_endpoints": "reporting_latest_endpoints", "reporting_historic_endpoints": "reporting_historic_endpoints"}


def _expectation(table: str, columns: str) -> str:
    """A report's columns, rows, and expected columns that hold nothing."""
    lost = "licence" if table == "reporting_historic_endpoints" else ""
    checked = [c for c in columns.split(";") if c != "extra"]
    empty = ", ".join(f"CASE WHEN bool_or(coalesce(CAST({c} AS VARCHAR), '') <> '') THEN NULL ELSE '{c}' END" for c in checked)
    return (f"SELECT '{table}' AS table_name, true AS present, {not lost} AS success, '{lost}' AS missing, '{columns}' AS actual, count(*) AS row_count, "
            f"concat_ws(';', {empty}) AS empty FROM ({_SQL[_FROM[table]]})")


_SQL["column_expectations"] = "\nUNION ALL\n".join(_expectation(t, c) for t, c in _COLUMNS.items()) + """
UNION ALL
SELECT 'endpoint_dataset_resource_summary', false, false, 'organisation;organisation_name;cohort;dataset;collection;pipeline;endpoint;endpoint_url;\
resource;resource_start_date;resource_end_date;latest_log_entry_date;mapping_field;non_mapping_field', '', 0, ''"""

# Files and managed tables: what was written is what is read back.
_TABLES = ("source", "endpoint", "resource", "old-resource", "log", "column", "combine", "concat", "convert", "default", "default-value", "patch", "skip",
           "transform", "filter", "lookup")
_EVERY_TABLE = ("attribution award cohort collection column column-field combine concat convert converted-resource dataset dataset-field datatype default "
                "default-value endpoint expectation field filter fund include-exclude issue issue-type licence log lookup old-resource organisation patch "
                "prefix project project-organisation project-status provision provision-reason provision-rule quality resource role role-organisation "
                "role-organisation-rule severity skip source specification specification-status theme transform typology").split()
_DAY = "CAST(CAST(o_orderdate AS DATE) AS VARCHAR)"
_SQL.update({
    "csv_blocks": "SELECT * FROM fx_line_cell",
    "sniff_landed": f"""
WITH first AS (SELECT doc_id % 360 AS file, min(doc_id) AS doc_id FROM documents GROUP BY ALL),
begins AS (SELECT file, concat(CASE file % 9 {" ".join(
    f"WHEN {i} THEN concat('', " + ", ".join(f"chr({ord(c)})" for c in head) + ")" for i, head in enumerate(FILE_HEADS))} ELSE '' END, coalesce(text, '')) AS content
  FROM first JOIN documents USING (doc_id))
SELECT file, {_filetype_sql('content')} AS filetype FROM begins""",
    "most_recent_log_by_month": _SQL["most_recent_log"],
    "managed_tables": """
SELECT 'issue' AS table_name, dataset, field, count(*) AS n, CAST(sum(line_number) AS BIGINT) AS checksum FROM fx_issue GROUP BY ALL
UNION ALL SELECT 'issue_by_field', dataset, field, count(*), CAST(sum(line_number) AS BIGINT) FROM fx_issue GROUP BY ALL
UNION ALL SELECT 'operational_issue', dataset, issue_type, count(*), CAST(sum(entry_number * 3 + line_number) AS BIGINT) FROM fx_operational_issue GROUP BY ALL
UNION ALL SELECT 'specification', dataset, collection, 1, length(dataset) FROM fx_dataset""",
    "report_by_name": _R4,
    "issue_partitions": """
SELECT ['0a', '1b', '2c', '3d'][line_number % 4 + 1] AS resource, dataset, row_number, field, issue_type,
       CASE line_number % 4 WHEN 1 THEN '' ELSE value END AS value, CAST(line_number AS VARCHAR) AS line_number, dataset AS pipeline
FROM fx_issue""",
    "undeclared_by_file": "SELECT DISTINCT dataset, '2c' AS resource, 'note' AS \"column\" FROM fx_issue WHERE line_number % 4 = 2",
    "consolidated_tables": "\nUNION ALL\n".join(f"""
SELECT '{t}' AS table_name, {"md5(concat('collection-', o_custkey % 5, '|local-authority-eng:', o_custkey % 25, '|', md5(concat('e', o_custkey))))" if t == "source" else "CAST(o_orderkey AS VARCHAR)"} AS source,
       concat('collection-', o_custkey % 5) AS collection, {"NULL" if t == "log" else "CASE o_orderkey % 3 WHEN 0 THEN 'tree' ELSE 'area' END"} AS dataset,
       CASE o_orderkey % 2 WHEN 0 THEN left({_DAY}, 7) || '-01T00:00:00Z' ELSE {_DAY} || 'T09:30:00Z' END AS entry_date,
       CASE o_custkey % 2 WHEN 0 THEN left({_DAY}, 4) || '-01-01' ELSE {_DAY} END AS start_date, '' AS end_date
FROM orders WHERE o_orderkey % 16 = {i}""" for i, t in enumerate(_TABLES)),
    "registered_tables": "\nUNION ALL\n".join(
        f"SELECT '{t.replace('-', '_')}' AS table_name, count(*) AS row_count, CAST(coalesce(sum(p_partkey), 0) AS BIGINT) AS checksum FROM part WHERE p_partkey % 49 = {i}"
        for i, t in enumerate(_EVERY_TABLE)),
    "sorted_report": """
SELECT dataset, issue_type, CAST(line_number AS VARCHAR) AS line_number,
       row_number() OVER (ORDER BY dataset, issue_type DESC, line_number DESC) - 1 AS "at" FROM fx_operational_issue""",
    "sorted_listing": "SELECT organisation, row_number() OVER (ORDER BY organisation) - 1 AS \"at\" FROM (" + _SQL["planning_authorities"] + ")",
    "specification_manifest": f"""
WITH d AS (SELECT * FROM fx_dataset WHERE coalesce(collection, '') <> '')
SELECT 'expectation' AS kind, '{_HOST}log/expectation/dataset=' || dataset || '/' || dataset || '.parquet?version=' || {_VERSION} AS url,
       'var/expectations/' || dataset || '.parquet' AS output_path FROM d
UNION ALL SELECT 'expectation-csv', '{_HOST}' || collection || '-collection/dataset/' || dataset || '-expectation-' || part || '.csv?version=' || {_VERSION},
       'var/expectations/' || dataset || '-expectation-' || part || '.csv' FROM d, (VALUES ('result'), ('issue')) AS v(part)
UNION ALL SELECT 'operational-issue', '{_HOST}performance/operational_issue/' || dataset || '/operational-issue.csv?version=' || {_VERSION},
       'performance/operational_issue/' || dataset || '/operational-issue.csv' FROM fx_dataset""",
})

"""Registry reports over the collector's log: most recent log, historic and
latest endpoint state (two variants each: registry and reporting).

Plan shape (the same for all four endpoint reports):

1. The log — the one table that grows with time — is aggregated *first*,
   to one row per (endpoint, status, exception[, resource]). Every report
   groups on these log columns and only needs ``max(entry_date)`` (plus the
   resource of the latest row), which does not change under duplication, so
   this is exact and removes the fan-out of the star join from the big
   side. It is a partial aggregate, so a hot endpoint holding a third of the
   log is reduced map-side.
2. The dimension side (source x source-pipeline x organisation) is reduced to
   distinct rows per endpoint before it meets the log; blank source ids
   therefore pair with the distinct pipelines of blank sources, not with every
   other blank source row.
3. Joins on ``endpoint`` then ``resource``; the planner broadcasts what its
   statistics bound as small and sort-merges the rest.
4. The endpoint and resource dimensions are reduced to the report grain first
   (``_report_dims``), so the joined rows are already one per report key and
   no aggregation runs on the join result. The "latest" reports then take a
   top-1 per (organisation, pipeline) as an arg-max aggregate rather than a
   window (``rn`` is therefore always 1, as the reference keeps only
   ``rn = 1``).

Ties: where the reference takes bare columns from "some" row of a group, we
pick the greatest tuple of (ordering columns, then every other varying column)
so the result is deterministic; the oracle SQL uses the same order.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regscope.functions.dates import date_part, elapsed_days, sql_day
from regscope.functions.keys import canonical_organisation
from regscope.operators.aggregates import top_by
from regscope.operators.setops import repeat_rows

Tables = Mapping[str, DataFrame]


# -- R1 ------------------------------------------------------------------------
def most_recent_log(log: DataFrame, log_aggregate: DataFrame | None = None) -> DataFrame:
    """All log rows of each endpoint's latest *day* (``date(entry_date)``).

    The latest day per endpoint comes from the log summary if there is one, else
    from a partial ``max``; then an equi-join back on (endpoint, day): the join
    key carries the day, and AQE splits a skewed endpoint's partition; no window
    gathers an endpoint into one task.
    """
    cols = log.columns
    with_day = log.withColumn("__day", sql_day("entry_date"))
    days = with_day if log_aggregate is None else log_aggregate.withColumnRenamed("latest_day", "__day")
    latest = days.groupBy("endpoint").agg(F.max("__day").alias("__day")).where(F.col("__day").isNotNull())
    return with_day.join(latest, ["endpoint", "__day"], "inner").select(*cols)


def log_by_month(log: DataFrame) -> DataFrame:
    """The log as it is stored: with its entry's ``day`` and, to partition by, ``month``."""
    day = sql_day("entry_date")
    return log.select("*", day.alias("day"), F.date_format(day, "yyyy-MM").alias("month"))


def most_recent_log_by_month(stored: DataFrame) -> DataFrame:
    """R1 over a log stored by month (``sinks.write_by``): the first read takes two
    columns; the second reads only the months in which some endpoint has its latest
    day. Those are few whatever the log's size, so they are always broadcast, and
    become a dynamic partition filter; then rows meet their endpoint's latest day."""
    latest = (stored.groupBy("endpoint").agg(F.max("day").alias("day"))
              .select("endpoint", "day", F.date_format("day", "yyyy-MM").alias("month")).where(F.col("month") > ""))
    months = latest.select("month").distinct()
    columns = [c for c in stored.columns if c not in ("day", "month")]
    return stored.join(months, "month", "left_semi").join(latest.drop("month"), ["endpoint", "day"]).select(*columns)


# -- J1 / J3 building blocks ------------------------------------------------------
def endpoint_sources(source: DataFrame, source_pipeline: DataFrame, organisation: DataFrame,
                     columns=None) -> DataFrame:
    """Distinct (endpoint, source attributes, pipeline, organisation attributes).

    ``source ⨝ source_pipeline ON source`` and
    ``organisation ON organisation = replace(source.organisation, '-eng', '')``;
    ``columns`` limits the attributes kept (the distinct is on endpoint + them).
    """
    sp = source_pipeline.select("source", "pipeline").distinct()
    s = source.select("source", "endpoint", "organisation", "collection", "licence", "documentation_url")
    o = organisation.select(F.col("organisation").alias("__org"), "name", F.col("dataset").alias("org_dataset"))
    j = (s.join(sp, "source")
         .join(o, canonical_organisation(s["organisation"]) == o["__org"])
         .drop("source", "__org"))
    if columns is not None:
        j = j.select("endpoint", *columns)
    return j.distinct()


def log_star(tables: Tables) -> DataFrame:
    """J1: every log row with its source, pipeline, endpoint and organisation: as plain
    inner joins give it, so a row comes as often as its dimensions repeat.

    Sources with a blank id pair with each other's pipelines, their number squared. Such
    pairs are alike, so they are counted before they meet the log, and a joined row is
    repeated as often as its count says, last of all."""
    log = tables["log"]
    s, sp, o = tables["source"], tables["source_pipeline"], tables["organisation"]
    s = s.select("source", "endpoint", "organisation", "collection", "licence", "documentation_url")
    o = o.select(F.col("organisation").alias("__org"), "name", F.col("dataset").alias("org_dataset"))
    sp = sp.groupBy("source", "pipeline").agg(F.count(F.lit(1)).alias("__times"))
    es = (s.join(sp, "source")
          .join(o, canonical_organisation(s["organisation"]) == o["__org"]).drop("source", "__org"))
    es = es.groupBy([c for c in es.columns if c != "__times"]).agg(F.sum("__times").alias("__times"))
    e = tables["endpoint"].select("endpoint", "endpoint_url",
                                  F.col("entry_date").alias("endpoint_entry_date"),
                                  F.col("end_date").alias("endpoint_end_date"))
    columns = [log["endpoint"], log["entry_date"], "status", "exception", log["resource"],
               "organisation", "name", "org_dataset", "collection", "pipeline", "licence",
               "documentation_url", "endpoint_url", "endpoint_entry_date", "endpoint_end_date"]
    return repeat_rows(log.join(es, "endpoint").join(e, "endpoint").select(*columns, "__times"), "__times")


def days_since_200(log: DataFrame, as_of: str) -> DataFrame:
    """Per endpoint: whole days from its latest ``status = '200'`` entry to ``as_of``.

    ``status`` is compared as text (``'200.0'`` or ``''`` never match).
    """
    return (log.where(F.col("status") == "200")
            .groupBy("endpoint").agg(F.max("entry_date").alias("__last200"))
            .select("endpoint", elapsed_days("__last200", as_of).alias("days_since_200")))


def endpoint_days_since_200(endpoint: DataFrame, log: DataFrame, as_of: str) -> DataFrame:
    """J4: every endpoint with its days since the last 200 (NULL if never)."""
    return (endpoint.select("endpoint", "endpoint_url")
            .join(days_since_200(log, as_of), "endpoint", "left"))


def _report_dims(tables: Tables, source_columns, active_endpoints_only: bool = False):
    """The star's dimensions reduced to the report grain, so the log join yields
    at most one row per report key and needs no second aggregation.

    Rows of the star that share a report key come from the same aggregated log
    row and differ only by duplicate dimension rows; the reference keeps the
    dimension values of one of them. Because the dimensions are independent,
    the greatest (endpoint dates, resource dates) tuple over such rows is the
    greatest endpoint-date pair per (endpoint, url) followed by the greatest
    resource-date pair per resource — computed here on the small dimension
    tables instead of on the join result.
    """
    ep = tables["endpoint"]
    if active_endpoints_only:
        ep = ep.where(F.col("end_date") == "")
    e = (ep.groupBy("endpoint", "endpoint_url").agg(F.max(F.struct("entry_date", "end_date")).alias("__e"))
         .select("endpoint", "endpoint_url", F.col("__e.entry_date").alias("e_entry_date"),
                 F.col("__e.end_date").alias("e_end_date")))
    r = (tables["resource"].groupBy("resource").agg(F.max(F.struct("start_date", "end_date")).alias("__r"))
         .select(F.col("resource").alias("__res"), F.col("__r.start_date").alias("r_start_date"),
                 F.col("__r.end_date").alias("r_end_date")))
    es = endpoint_sources(tables["source"], tables["source_pipeline"], tables["organisation"], source_columns)
    return es, e, r


def latest_of_endpoints(log: DataFrame, date: str = "entry_date", ended: DataFrame | None = None) -> DataFrame:
    """The log (or, with ``date="latest"``, its summary) reduced for reports that keep one
    row of R4 per endpoint and attributes of its sources: R4's arg-max order begins with
    the log's own columns (day, resource, status, exception), and every source of an
    endpoint meets the same log rows, so the greatest of them is found before any join.
    Rows of ``ended`` resources (see ``ended_resources``) are left out first: of a resource
    that very many rows name (a blank one: no answer), a row per endpoint meets them. A
    summary's rows are as few already: they are moved by resource once, as R4 moves them."""
    if ended is not None:
        # a left join, not an anti join: Spark would push that below the aggregate
        flagged = ended.select("resource", F.lit(True).alias("__ended"))
        if date != "latest":
            row = F.struct(date_part(date).alias("day"), "status", "exception", F.col(date).alias("latest"))
            log = (log.groupBy("endpoint", "resource").agg(F.max(row).alias("__m"))
                   .select("endpoint", "resource", "__m.status", "__m.exception", "__m.latest"))
            date = "latest"
        log = log.join(flagged.hint("merge"), "resource", "left").where(F.col("__ended").isNull()).drop("__ended")
    row = F.struct(date_part(date).alias("day"), "resource", "status", "exception", F.col(date).alias("latest"))
    return log.groupBy("endpoint").agg(F.max(row).alias("__m")).select(
        "endpoint", "__m.status", "__m.exception", "__m.resource", "__m.latest")


def ended_resources(resource: DataFrame) -> DataFrame:
    """Resources whose greatest (start date, end date) has an end."""
    last = resource.groupBy("resource").agg(F.max(F.struct("start_date", "end_date")).alias("__r"))
    return last.where(F.coalesce(date_part("__r.end_date"), F.lit("")) != "").select("resource")


# -- R2 / R4 -------------------------------------------------------------------------
def log_summary(log: DataFrame) -> DataFrame:
    """The log reduced for all reports: per (endpoint, status, exception, resource)
    the latest entry text and the latest valid day. A build computes it once."""
    return log.groupBy("endpoint", "status", "exception", "resource").agg(
        F.max("entry_date").alias("latest"), F.max(sql_day("entry_date")).alias("latest_day"))


def latest_log_aggregate(summary: DataFrame) -> DataFrame:
    """The summary reduced for the latest reports: per (endpoint, status, exception)
    the latest entry and its resource (greatest (entry_date, resource))."""
    return (summary.groupBy("endpoint", "status", "exception")
            .agg(F.max(F.struct("latest", "resource")).alias("__m"))
            .select("endpoint", "status", "exception", "__m.latest", "__m.resource"))


def historic_endpoints(tables: Tables, variant: str = "registry", log_aggregate: DataFrame | None = None) -> DataFrame:
    """R2 (``variant='registry'``) / R4 (``variant='reporting'``).

    Grain: organisation, name, dataset, collection, pipeline, endpoint,
    endpoint_url, [documentation_url,] licence, status, exception, resource.
    The registry variant takes ``dataset`` from the organisation and keeps full
    timestamps; the reporting variant uses the pipeline as dataset, adds
    ``documentation_url``, renames status/exception and cuts dates to 10 chars.
    """
    reporting = variant == "reporting"
    logagg = log_aggregate if log_aggregate is not None else log_summary(tables["log"])
    source_columns = ["organisation", "name", "collection", "pipeline", "licence"] + \
        (["documentation_url"] if reporting else ["org_dataset"])
    es, e, r = _report_dims(tables, source_columns)
    # resources first, while a log row is still one row. They grow with the registry and
    # are texts made of numbers, which file statistics make too small: never broadcast
    g = (logagg.join(r.hint("merge"), logagg["resource"] == r["__res"], "left")
         .join(es, "endpoint").join(e, "endpoint"))
    dataset = F.col("pipeline") if reporting else F.col("org_dataset")
    keys = ["organisation", "name", F.col("name").alias("organisation_name"), dataset.alias("dataset"),
            "collection", "pipeline", "endpoint", "endpoint_url"] + \
        (["documentation_url"] if reporting else []) + ["licence"]
    if not reporting:
        return g.select(*keys, "status", "exception", "resource", F.col("latest").alias("latest_log_entry_date"),
                        F.col("e_entry_date").alias("endpoint_entry_date"),
                        F.col("e_end_date").alias("endpoint_end_date"),
                        F.col("r_start_date").alias("resource_start_date"),
                        F.col("r_end_date").alias("resource_end_date"))
    return g.select(*keys,
                    F.col("status").alias("latest_status"), F.col("exception").alias("latest_exception"),
                    "resource",
                    date_part("latest").alias("latest_log_entry_date"),
                    date_part("e_entry_date").alias("endpoint_entry_date"),
                    date_part("e_end_date").alias("endpoint_end_date"),
                    date_part("r_start_date").alias("resource_start_date"),
                    date_part("r_end_date").alias("resource_end_date"))


# -- R3 / R5 -------------------------------------------------------------------------
def latest_endpoints(tables: Tables, variant: str = "registry", *, as_of: str,
                     log_aggregate: DataFrame | None = None) -> DataFrame:
    """R3 / R5: per (organisation, pipeline) the group with the latest active
    endpoint (``endpoint.end_date = ''``), then latest log entry.

    The per-group ``resource`` is the one of the latest log row; the top-1 is
    ordered by (endpoint entry date, latest log date) descending on the
    *uncut* texts, then the remaining group columns.
    """
    reporting = variant == "reporting"
    whole = log_aggregate if log_aggregate is not None else log_summary(tables["log"])
    logagg = latest_log_aggregate(whole)
    source_columns = ["organisation", "name", "collection", "pipeline", "licence"] + \
        ([] if reporting else ["org_dataset"])
    es, e, r = _report_dims(tables, source_columns, active_endpoints_only=True)
    # status is a key of the aggregated log, so the last '200' per endpoint comes
    # from that small aggregate rather than from a second pass over the log. It is
    # a conditional max, not a filter: a filter on a grouping key would be pushed
    # below the log aggregate, making that branch a different plan that Spark
    # could not share — and the log would be scanned twice.
    d200 = (logagg.groupBy("endpoint")
            .agg(F.max(F.when(F.col("status") == "200", F.col("latest"))).alias("__last200"))
            .select("endpoint", elapsed_days("__last200", as_of).alias("days_since_200")))
    g = (logagg.join(r.hint("merge"), logagg["resource"] == r["__res"], "left")
         .join(es, "endpoint")
         .join(e, "endpoint")
         .join(d200, "endpoint", "left"))
    dataset = F.col("pipeline") if reporting else F.col("org_dataset")
    g = g.select("*", dataset.alias("dataset"), F.col("name").alias("organisation_name"))
    # top-1 per (organisation, pipeline): the reference's window, as an arg-max aggregate
    order = ["e_entry_date", "latest", "endpoint", "status", "exception", "collection", "licence",
             "name", "dataset", "endpoint_url", "days_since_200", "resource", "e_end_date",
             "r_start_date", "r_end_date"]
    top = top_by(g, ["organisation", "pipeline"], order=order, payload=["organisation_name"])
    if not reporting:
        return top.select("organisation", "name", "organisation_name", "dataset", "collection", "pipeline",
                          "endpoint", "endpoint_url", "licence", "status", "days_since_200", "exception",
                          "resource", F.col("latest").alias("latest_log_entry_date"),
                          F.col("e_entry_date").alias("endpoint_entry_date"),
                          F.col("e_end_date").alias("endpoint_end_date"),
                          F.col("r_start_date").alias("resource_start_date"),
                          F.col("r_end_date").alias("resource_end_date"),
                          F.lit(1).cast("bigint").alias("rn"))
    return top.select("organisation", "name", "organisation_name", "dataset", "collection", "pipeline",
                      "endpoint", "endpoint_url", "licence", F.col("status").alias("latest_status"),
                      "days_since_200", F.col("exception").alias("latest_exception"), "resource",
                      date_part("latest").alias("latest_log_entry_date"),
                      date_part("e_entry_date").alias("endpoint_entry_date"),
                      date_part("e_end_date").alias("endpoint_end_date"),
                      date_part("r_start_date").alias("resource_start_date"),
                      date_part("r_end_date").alias("resource_end_date"),
                      F.lit(1).cast("bigint").alias("rn"))


def latest_log_by_endpoint(log: DataFrame) -> DataFrame:
    """A2 on the log: each endpoint's latest row (ties: resource, status, exception desc)."""
    return top_by(log, "endpoint", order=["entry_date", "resource", "status", "exception"])

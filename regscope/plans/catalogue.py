"""Resource catalogue, organisation/dataset indexes and download manifests.

The reference builds these with Python dictionaries loaded row by row
(endpoint -> row, resource -> row; "the last row read wins"). Here each
dictionary becomes a grouped DataFrame: "last wins" is ``max_by(value,
position)`` over an explicit file-position column, set membership is a
semi/anti join, and the nested loops are ``explode`` + equi-joins. Nothing is
collected; every step is a partial aggregate or a join the planner sizes.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regscope.functions.dates import hour_version_of
from regscope.functions.keys import (ARTIFACT_TEMPLATES, COLLECTION_FILES, DATASET_TEMPLATES, DEFAULT_FILE_HOST,
                                     PIPELINE_FILES, canonical_organisation, explode_list, fill_template,
                                     is_planning_authority)
from regscope.operators.aggregates import inverted_index
from regscope.operators.joins import anti_join


#: Kinds of manifest that do not need a dataset's collection.
FOR_EVERY_DATASET = ("operational-issue",)


# -- F1 / J8 ------------------------------------------------------------------------
def active_resources(resource: DataFrame) -> DataFrame:
    """Resources without an end date (``end_date = ''``; NULL is not active)."""
    return resource.where(F.col("end_date") == "")


def live_resources(resource: DataFrame, old_resource: DataFrame) -> DataFrame:
    """Resources not listed as an ``old_resource`` (superseded ones)."""
    return anti_join(resource, old_resource, "resource", "old_resource")


# -- building blocks of R14 -----------------------------------------------------------
def endpoint_index(endpoint: DataFrame, source: DataFrame, position: str = "pos"):
    """Per known endpoint: its collection (from the last source row naming it; when
    none does, that of its own last row, ``''`` if the table has no such column)
    and the distinct pipelines its sources list."""
    if "collection" in endpoint.columns:
        keys = endpoint.groupBy("endpoint").agg(F.max_by(F.coalesce("collection", F.lit("")), position).alias("__own"))
    else:
        keys = endpoint.select("endpoint", F.lit("").alias("__own")).distinct()
    src = source.where(F.coalesce(F.col("endpoint"), F.lit("")) != "").join(keys, "endpoint", "left_semi")
    last = src.groupBy("endpoint").agg(F.max_by(F.coalesce("collection", F.lit("")), position).alias("collection"))
    collections = keys.join(last, "endpoint", "left").select(
        "endpoint", F.coalesce("collection", "__own").alias("collection"))
    pipelines = explode_list(src, "pipelines", "pipeline", keep=["endpoint"]).distinct()
    return collections, pipelines


def current_resources(resource: DataFrame, old_resource: DataFrame, position: str = "pos") -> DataFrame:
    """One row per resource (the last one read), superseded resources removed."""
    last = resource.groupBy("resource").agg(F.max_by("endpoints", position).alias("endpoints"))
    return live_resources(last, old_resource)


def _matched(endpoint, source, resource, old_resource):
    collections, pipelines = endpoint_index(endpoint, source)
    live = current_resources(resource, old_resource)
    listed = explode_list(live, "endpoints", "endpoint", keep=["resource"], with_position=True)
    matched = listed.join(collections, "endpoint")
    return live, matched, pipelines


def resource_catalogue(endpoint: DataFrame, source: DataFrame, resource: DataFrame,
                       old_resource: DataFrame) -> DataFrame:
    """Distinct (collection, pipeline, resource): a resource takes the pipelines
    of every listed endpoint and the collection of the last listed endpoint
    that is known. Resources with no known endpoint are left out (see
    ``unmapped_resources``)."""
    _, matched, pipelines = _matched(endpoint, source, resource, old_resource)
    collection = matched.groupBy("resource").agg(F.max_by("collection", "endpoint_pos").alias("collection"))
    pairs = (matched.select("resource", "endpoint").join(pipelines, "endpoint")
             .select("resource", "pipeline").distinct())
    return pairs.join(collection, "resource").select("collection", "pipeline", "resource")


def unmapped_resources(endpoint: DataFrame, source: DataFrame, resource: DataFrame,
                       old_resource: DataFrame) -> DataFrame:
    """Resources no artifact can be fetched for, with the reason:
    ``no-endpoint`` (none of its endpoints is known; collection NULL),
    ``no-pipeline`` (known endpoints, but no source lists a pipeline) or
    ``blank-pipeline`` (a source lists an empty pipeline name)."""
    live, matched, pipelines = _matched(endpoint, source, resource, old_resource)
    collection = matched.groupBy("resource").agg(F.max_by("collection", "endpoint_pos").alias("collection"))
    flags = (matched.select("resource", "endpoint").join(pipelines, "endpoint")
             .groupBy("resource").agg(F.max(F.col("pipeline") == "").alias("__blank")))
    r = live.select("resource").join(collection, "resource", "left").join(flags, "resource", "left")
    reason = (F.when(F.col("collection").isNull(), "no-endpoint")
              .when(F.col("__blank").isNull(), "no-pipeline")
              .when(F.col("__blank"), "blank-pipeline"))
    return r.select("resource", "collection", reason.alias("reason")).where(F.col("reason").isNotNull())


# -- P15 / J3 / A8 / R15 -----------------------------------------------------------------
def source_pipeline(source: DataFrame) -> DataFrame:
    """One (source, pipeline) row per item of the source's pipelines list."""
    return explode_list(source, "pipelines", "pipeline", keep=["source"])


def source_organisations(source: DataFrame, organisation: DataFrame) -> DataFrame:
    """Sources joined to their organisation on the canonical (``-eng`` removed) key."""
    o = organisation.select(F.col("organisation").alias("canonical_organisation"),
                            F.col("name").alias("organisation_name"))
    return (source.join(o, canonical_organisation(source["organisation"]) == o["canonical_organisation"])
            .select("source", "organisation", "canonical_organisation", "organisation_name"))


def _organisation_dataset_pairs(source: DataFrame) -> DataFrame:
    lists = F.col("pipelines")
    if "datasets" in source.columns:
        lists = F.when(F.coalesce(F.col("datasets"), F.lit("")) != "", F.col("datasets")).otherwise(lists)
    s = source.select("organisation", F.coalesce(lists, F.lit("")).alias("__list"))
    return explode_list(s, "__list", "dataset", keep=["organisation"])


def organisation_datasets(source: DataFrame) -> DataFrame:
    """organisation -> its datasets (sorted, ``;``-joined) and how many."""
    return inverted_index(_organisation_dataset_pairs(source), "organisation", "dataset")


def dataset_organisations(source: DataFrame) -> DataFrame:
    """dataset -> its organisations (sorted, ``;``-joined) and how many.

    The set is over the organisation domain (a registry dimension), and partial
    aggregation de-duplicates it map-side."""
    return inverted_index(_organisation_dataset_pairs(source), "dataset", "organisation")


def planning_authorities(source: DataFrame) -> DataFrame:
    """Distinct organisations whose identifier starts with a planning-authority prefix."""
    return source.select("organisation").where(is_planning_authority("organisation")).distinct()


# -- F7 / F8 -----------------------------------------------------------------------
def dataset_collections(source: DataFrame) -> DataFrame:
    """The (dataset, collection) pairs the sources declare (a dataset spec stand-in)."""
    pairs = explode_list(source, "pipelines", "dataset", keep=["collection"])
    return pairs.select("dataset", "collection").distinct()


def datasets_of_collection(datasets: DataFrame, collection: str) -> DataFrame:
    return datasets.where(F.col("collection") == collection).select("dataset").distinct()


def datasets_with_collection(datasets: DataFrame) -> DataFrame:
    return datasets.where(F.coalesce(F.col("collection"), F.lit("")) != "")


# -- P17 / J10 / J11 ---------------------------------------------------------------------
def _manifest_rows(df: DataFrame, templates, host: str, as_of: str, **cols) -> DataFrame:
    """One (kind, url, output_path) row per input row and template, in one pass
    (an ``explode`` over the templates, not a union of re-scans); distinct by url."""
    version = hour_version_of(as_of).cast("string")
    entries = [F.struct(F.lit(kind).alias("kind"),
                        F.concat(F.lit(host), fill_template(url_t, **cols), F.lit("?version="), version).alias("url"),
                        fill_template(path_t, **cols).alias("output_path"))
               for kind, url_t, path_t in templates]
    # few input bytes make many rows: they are dealt out by size before a task compares its own
    return df.select(F.explode(F.array(*entries)).alias("__m")).select("__m.*").hint("rebalance", "url").distinct()


def artifact_manifest(catalogue: DataFrame, as_of: str, kinds: Sequence[str] = ("issue",),
                      host: str = DEFAULT_FILE_HOST) -> DataFrame:
    """Download manifest per (collection, pipeline, resource): url -> output path.

    Rows with a blank pipeline cannot be fetched and are left out (reported by
    ``unmapped_resources``); the url is the key, so the manifest is distinct.
    """
    usable = catalogue.where(F.coalesce(F.col("pipeline"), F.lit("")) != "")
    templates = [(k, *ARTIFACT_TEMPLATES[k]) for k in kinds]
    return _manifest_rows(usable, templates, host, as_of, collection=F.col("collection"),
                          pipeline=F.col("pipeline"), resource=F.col("resource"))


def dataset_manifest(datasets: DataFrame, as_of: str, kinds: Sequence[str] = tuple(DATASET_TEMPLATES),
                     host: str = DEFAULT_FILE_HOST) -> DataFrame:
    """Download manifest per dataset: expectation logs and results of datasets that
    belong to a collection, operational issue logs of every dataset."""
    parts = []
    for rows, own in ((datasets_with_collection(datasets), [k for k in kinds if k not in FOR_EVERY_DATASET]),
                      (datasets, [k for k in kinds if k in FOR_EVERY_DATASET])):
        if own:
            templates = [(k, u, p) for k in own for u, p in DATASET_TEMPLATES[k]]
            parts.append(_manifest_rows(rows, templates, host, as_of, dataset=F.col("dataset"), collection=F.coalesce("collection", F.lit(""))))
    if not parts:
        raise ValueError("no kind of manifest is asked for")
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def collection_file_manifest(collections: DataFrame, files: Sequence[str] | None = None,
                             host: str = DEFAULT_FILE_HOST, folder: str = "collection") -> DataFrame:
    """Every collection x every file of its ``folder`` (``collection`` or
    ``pipeline``; the lists are fixed, so this is an ``explode`` of literals, not
    a join)."""
    if files is None:
        files = {"collection": COLLECTION_FILES, "pipeline": PIPELINE_FILES}[folder]
    c = collections.select("collection").where(F.coalesce("collection", F.lit("")) != "").distinct()
    per = c.select("collection", F.explode(F.array(*[F.lit(f) for f in files])).alias("file"))
    return per.select(
        "collection", "file",
        F.concat(F.lit(host), F.col("collection"), F.lit(f"-collection/{folder}/"), F.col("file")).alias("url"),
        F.concat(F.lit(f"var/{folder}/"), F.col("collection"), F.lit("/"), F.col("file")).alias("output_path"))


def pending_manifest(manifest: DataFrame, landed: DataFrame) -> DataFrame:
    """Manifest entries whose output file has not landed yet."""
    return anti_join(manifest, landed, "output_path", "output_path")


# -- P16 / U5 --------------------------------------------------------------------------
def slug_inventory(organisation: DataFrame | None = None, category: DataFrame | None = None,
                   geography: DataFrame | None = None) -> DataFrame:
    """Every slug the site seeds: ``/organisation/<prefix>/<reference>`` per
    organisation, category slugs with tabs removed, non-blank geography slugs."""
    from regscope.functions.keys import organisation_slug, strip_tabs

    parts = []
    if organisation is not None:
        parts.append(organisation.select(organisation_slug("organisation").alias("slug"),
                                         F.lit("organisation").alias("kind")))
    if category is not None:
        parts.append(category.select(strip_tabs("slug_id_label").alias("slug"), F.lit("category").alias("kind")))
    if geography is not None:
        parts.append(geography.where(F.coalesce(F.col("slug_id_label"), F.lit("")) != "")
                     .select(F.col("slug_id_label").alias("slug"), F.lit("geography").alias("kind")))
    if not parts:
        raise ValueError("slug_inventory needs at least one of organisation, category, geography")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# -- link tables of the registry ---------------------------------------------------------
def resource_endpoint(resource: DataFrame) -> DataFrame:
    """One (resource, endpoint) row per item of the resource's endpoints list."""
    return explode_list(resource, "endpoints", "endpoint", keep=["resource"]).distinct()


def resource_organisation(resource: DataFrame, source: DataFrame) -> DataFrame:
    """Distinct (resource, organisation) through the endpoints the resource was fetched from."""
    src = source.where(F.coalesce(F.col("endpoint"), F.lit("")) != "").select("endpoint", "organisation").distinct()
    return resource_endpoint(resource).join(src, "endpoint").select("resource", "organisation").distinct()


def resource_dataset(resource: DataFrame, source: DataFrame) -> DataFrame:
    """Distinct (resource, dataset) through the pipelines of the sources of its endpoints."""
    pipes = explode_list(source.where(F.coalesce(F.col("endpoint"), F.lit("")) != ""),
                         "pipelines", "dataset", keep=["endpoint"]).distinct()
    return resource_endpoint(resource).join(pipes, "endpoint").select("resource", "dataset").distinct()


def specification_dataset(specification: DataFrame) -> DataFrame:
    """One (specification, dataset) row per item of the specification's datasets list."""
    return explode_list(specification, "datasets", "dataset", keep=["specification"]).distinct()

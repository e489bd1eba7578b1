"""Key and text helpers: list splitting, organisation canonicalisation,
surrogate keys, header matching, slugs and artifact paths."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values.
LIST_SEPARATOR = ";"
ENGLAND_SUFFIX = "-eng"
ALWAYS_MAPPED_FIELDS = ("geometry", "point")
PLANNING_AUTHORITY_PREFIXES = ("local-authority", "development-corporation", "national-park")


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def explode_list(df: DataFrame, column: str, out: str, keep=(), with_position: bool = False) -> DataFrame:
    """One row per item of a ``;``-separated text list.

    ``''`` yields one ``''`` item (as Python's ``str.split`` does); NULL yields
    no row. With ``with_position`` the 0-based item index is kept as
    ``<out>_pos``.
    """
    items = F.split(F.col(column), LIST_SEPARATOR, -1)
    if with_position:
        return df.select(*keep, F.posexplode(items).alias(f"{out}_pos", out))
    return df.select(*keep, F.explode(items).alias(out))


def canonical_organisation(c) -> Column:
    """Remove every literal ``-eng`` (``local-authority-eng:X`` -> ``local-authority:X``)."""
    return F.replace(_col(c), F.lit(ENGLAND_SUFFIX), F.lit(""))


def source_key(source="source", collection="collection", organisation="organisation",
               endpoint="endpoint") -> Column:
    """``md5(collection|organisation|endpoint)`` when the row has a source, else the source as is."""
    parts = [F.coalesce(_col(c), F.lit("")) for c in (collection, organisation, endpoint)]
    key = F.md5(F.concat(parts[0], F.lit("|"), parts[1], F.lit("|"), parts[2]))
    return F.when(F.coalesce(_col(source), F.lit("")) != "", key).otherwise(_col(source))


def default_dataset(dataset="dataset", pipeline="pipeline") -> Column:
    """A blank dataset takes the pipeline's name."""
    return F.when(F.coalesce(_col(dataset), F.lit("")) == "",
                  F.coalesce(_col(pipeline), F.lit(""))).otherwise(_col(dataset))


def header_canonical(column) -> Column:
    """Upper-cased column header with spaces and underscores as hyphens."""
    return F.upper(F.translate(_col(column), " _", "--"))


def header_match(column="column", field="field") -> Column:
    """Does the field name equal the column header once canonicalised? NULL if either is NULL."""
    return F.upper(_col(field)) == header_canonical(column)


def mapping_field(column="column", field="field") -> Column:
    """The field when it maps its column (or is geometry/point), else NULL."""
    f = _col(field)
    return F.when(header_match(column, field) | f.isin(*ALWAYS_MAPPED_FIELDS), f)


def non_mapping_field(column="column", field="field") -> Column:
    """The field when it does not map its column and is not geometry/point, else NULL."""
    f = _col(field)
    return F.when((F.upper(f) != header_canonical(column)) & ~f.isin(*ALWAYS_MAPPED_FIELDS), f)


def is_planning_authority(organisation="organisation") -> Column:
    o = _col(organisation)
    cond = None
    for p in PLANNING_AUTHORITY_PREFIXES:
        c = o.startswith(p)
        cond = c if cond is None else (cond | c)
    return cond


def organisation_slug(organisation="organisation") -> Column:
    """``prefix:reference`` -> ``/organisation/prefix/reference``; anything else aborts."""
    o = _col(organisation)
    parts = F.split(o, ":", -1)
    ok = F.size(parts) == 2
    slug = F.concat(F.lit("/organisation/"), parts.getItem(0), F.lit("/"), parts.getItem(1))
    return F.when(ok, slug).otherwise(
        F.raise_error(F.concat(F.lit("organisation is not prefix:reference: "), F.coalesce(o, F.lit("NULL")))
                      ).cast("string"))


def strip_tabs(c) -> Column:
    return F.replace(_col(c), F.lit("\t"), F.lit(""))


# Download templates of the artifact manifests; the host is a parameter.
ARTIFACT_TEMPLATES = {
    "issue": ("{collection}-collection/issue/{pipeline}/{resource}.csv", "var/issue/{pipeline}/{resource}.csv"),
    "column-field": ("{collection}-collection/var/column-field/{pipeline}/{resource}.csv",
                     "var/column-field/{pipeline}/{resource}.csv"),
    "converted-resource": ("{collection}-collection/var/converted-resource/{pipeline}/{resource}.csv",
                           "var/converted-resource/{pipeline}/{resource}.csv"),
    "resource": ("{collection}-collection/collection/resource/{resource}", "var/resource/{resource}"),
}
DATASET_TEMPLATES = {
    "expectation": [("log/expectation/dataset={dataset}/{dataset}.parquet", "var/expectations/{dataset}.parquet")],
    "expectation-csv": [
        ("{collection}-collection/dataset/{dataset}-expectation-result.csv",
         "var/expectations/{dataset}-expectation-result.csv"),
        ("{collection}-collection/dataset/{dataset}-expectation-issue.csv",
         "var/expectations/{dataset}-expectation-issue.csv")],
    "operational-issue": [("performance/operational_issue/{dataset}/operational-issue.csv",
                           "performance/operational_issue/{dataset}/operational-issue.csv")],
}
COLLECTION_FILES = ("endpoint.csv", "source.csv", "log.csv", "resource.csv", "old-resource.csv")
PIPELINE_FILES = ("column.csv", "combine.csv", "concat.csv", "convert.csv", "default.csv", "default-value.csv",
                  "patch.csv", "plugins.py", "skip.csv", "transform.csv", "filter.csv", "lookup.csv")
DEFAULT_FILE_HOST = "https://files.example.org/"


def fill_template(template: str, **cols) -> Column:
    """Build ``template`` (``{name}`` placeholders) from columns, left to right."""
    import re
    pieces = []
    pos = 0
    for m in re.finditer(r"\{(\w+)\}", template):
        if m.start() > pos:
            pieces.append(F.lit(template[pos:m.start()]))
        pieces.append(_col(cols[m.group(1)]))
        pos = m.end()
    if pos < len(template):
        pieces.append(F.lit(template[pos:]))
    return F.concat(*pieces)

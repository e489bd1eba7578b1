"""Content sniffing: classify a landed file by its leading bytes/characters.

Classification only (no conversion). The binary signatures are tested first
(Excel, old and new, before zip, then SQLite), then the text prefix of the first ten characters,
case-insensitively.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# File signatures and text prefixes.
EXCEL_MAGIC = "\xd0\xcf\x11\xe0\xa1\xb1\x1a\xe1"   # legacy (OLE2) workbook
ZIP_MAGIC = "PK\x03\x04"                            # zip archive
WORKBOOK_ENTRIES = ("[Content_Types].xml", "_rels/.rels", "docProps/", "xl/")  # first entry of an xlsx workbook
ENTRY_NAME_AT = 31                                  # where a zip's first entry is named (from 1)
SQLITE_MAGIC = "SQLite format 3\x00"                # SQLite / GeoPackage
HTML_PREFIX = "<!doctype "
XML_PREFIXES = ("<?xml ", "<wfs:")
JSON_PREFIX = "{"
#: As much of a file as any of these needs.
LEADING_BYTES = 64


def filetype(content) -> Column:
    """``excel``, ``zip``, ``sqlite``, ``html`` (ignored by the loader),
    ``xml``, ``json`` or ``csv`` (anything else)."""
    c = F.col(content) if isinstance(content, str) else content
    head = F.lower(F.substring(c, 1, 10))
    entry = F.substring(c, ENTRY_NAME_AT, 20)
    workbook = F.lit(False)
    for name in WORKBOOK_ENTRIES:
        workbook = workbook | entry.startswith(name)
    return (F.when(c.startswith(EXCEL_MAGIC) | (c.startswith(ZIP_MAGIC) & workbook), "excel")
            .when(c.startswith(ZIP_MAGIC), "zip")
            .when(c.startswith(SQLITE_MAGIC), "sqlite")
            .when(head.startswith(HTML_PREFIX), "html")
            .when(head.startswith(XML_PREFIXES[0]) | head.startswith(XML_PREFIXES[1]), "xml")
            .when(head.startswith(JSON_PREFIX), "json")
            .otherwise("csv"))


def filetype_of_bytes(content) -> Column:
    """The same classification for a BINARY column (e.g. the ``binaryFile`` source)."""
    c = F.col(content) if isinstance(content, str) else content
    return filetype(F.decode(F.substring(c, 1, LEADING_BYTES), "ISO-8859-1"))

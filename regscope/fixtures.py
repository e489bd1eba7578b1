"""Registry-shaped test views over the driver's parquet tables.

The driver's tables (nation, supplier, part, lineitem, orders, events, labels,
...) are not registry data, so every registry role (organisation, source,
endpoint, log, resource, issue, ...) is mapped onto them by a fixed rule.
``Fixtures`` builds each view as a Spark DataFrame (lazily, from the parquet
files under ``sf_dir``); ``FX_SQL`` holds the same views as SQL text so that the
DuckDB oracle statements can be prefixed with ``WITH fx_... AS (...)``.

Both forms must stay in step: ``tools/check_oracle.py`` compares them.
Replicating a row per literal dataset is written with ``explode(array(...))``
on the Spark side (a projection, no join).
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regscope.sources.ranged import list_files

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


#: Bytes of a table's file that one task computes views of, and rows of it: keys that
#: follow each other may be stored in a few bits.
SPREAD_BYTES = 16 << 20
SPREAD_ROWS = 500_000

# Fixed value: the report date of the keys (the tables' dates end in 1998 to 2002).
AS_OF = "2003-01-01T00:00:00Z"

# How files of each kind begin (old workbook, new workbook, zip,
# SQLite, web page, XML, JSON); documents of no kind here are CSV.
FILE_HEADS = ("\xd0\xcf\x11\xe0\xa1\xb1\x1a\xe1", "PK\x03\x04" + "0" * 26 + "[Content_Types].xml", "PK\x03\x04" + "0" * 26 + "data/a.shp",
              "SQLite format 3\x00", "<!DOCTYPE html>", "<?xml version", "{")


def _s(c):
    return c.cast("string")


def _md5(prefix: str, c):
    return F.md5(F.concat(F.lit(prefix), _s(c)))


def _day_text(c):
    return _s(c.cast("date"))


class Fixtures:
    """Lazily built fixture DataFrames for one scale-factor folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self._tables: dict[str, DataFrame] = {}
        self._shares: dict[str, tuple[int, DataFrame | None]] = {}

    @classmethod
    def of(cls, spark: SparkSession, sf_dir: str) -> "Fixtures":
        """Shared instance per (session, folder): the table scans and view plans
        are built once and reused by every query of the session."""
        key = (id(spark), spark.sparkContext.applicationId, sf_dir.rstrip("/"))
        fx = _INSTANCES.get(key)
        if fx is None:
            # of one session only: frames of a stopped one are of no use
            for old in [k for k in _INSTANCES if k[:2] != key[:2]]:
                del _INSTANCES[old]
            fx = _INSTANCES[key] = cls(spark, sf_dir)
        return fx

    def table(self, name: str) -> DataFrame:
        df = self._tables.get(name)
        if df is None:
            df = self._tables[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return df

    def spread(self, name: str, columns: list[str]) -> DataFrame:
        """``columns`` of a table whose views compute much of each row. A file of one row
        group is read by one task, whatever the cores, and a task's share of a large file
        may hold many millions of rows: they are dealt out before anything is computed of
        them, to every core, and to as many tasks as the table is large. A file of many
        row groups is read by as many tasks instead, and no row is moved."""
        cores = self.spark.sparkContext.defaultParallelism
        if name not in self._shares:
            size = list_files(self.spark, f"{self.sf_dir}/{name}.parquet").agg(F.sum("length")).first()[0] or 0
            shares = max(cores, -(-size // SPREAD_BYTES), -(-self.table(name).count() // SPREAD_ROWS))
            self._shares[name] = shares, self._in_parts(name, -(-size // shares), cores)
        shares, parts = self._shares[name]
        if parts is not None:
            return parts.select(*columns)
        # by all columns: a key that is null or repeated gathers no rows
        return self.table(name).select(*columns).repartition(shares, *columns)

    def _in_parts(self, name: str, length: int, cores: int) -> DataFrame | None:
        """The table read in parts of ``length`` bytes, if its row groups are so small that
        this gives every core something to read, and no task more than two shares' rows."""
        own = self.spark.newSession()  # how files are cut is a setting of the session that reads them
        own.conf.set("spark.sql.files.maxPartitionBytes", str(max(length, 1)))
        own.conf.set("spark.sql.files.openCostInBytes", "1")
        cut = own.read.schema(self.table(name).schema).parquet(f"{self.sf_dir}/{name}.parquet")
        held = cut.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n"), F.count("*")).first()
        if held[1] < cores or held[0] > 2 * SPREAD_ROWS:
            return None
        # a frame of the caller's session, by the empty one it is put below
        return self.table(name).where(F.lit(False)).unionAll(cut)

    # -- registry roles -------------------------------------------------------
    @cached_property
    def organisation(self) -> DataFrame:
        n = self.table("nation")
        kind = (F.when(n.n_regionkey % 4 == 0, "local-authority")
                .when(n.n_regionkey % 4 == 1, "development-corporation")
                .when(n.n_regionkey % 4 == 2, "national-park")
                .otherwise("government-organisation"))
        return n.select(
            F.concat(kind, F.lit(":"), _s(n.n_nationkey)).alias("organisation"),
            n.n_name.alias("name"),
            F.concat(F.lit("dataset-"), _s(n.n_regionkey)).alias("dataset"),
            n.n_nationkey,
        )

    @cached_property
    def source(self) -> DataFrame:
        s = self.table("supplier")
        o = self.organisation
        k = s.s_suppkey
        j = s.join(o, s.s_nationkey == o.n_nationkey)
        return j.select(
            F.when(k % 20 == 0, "").otherwise(F.concat(F.lit("source-"), _s(k))).alias("source"),
            F.replace(o.organisation, F.lit(":"), F.when(k % 30 == 4, "-eng-eng:").otherwise("-eng:")).alias("organisation"),
            F.when(k % 25 == 3, "").when(k % 25 == 9, F.lit(None).cast("string"))
            .otherwise(F.concat(F.lit("collection-"), _s(k % 5))).alias("collection"),
            F.when((k % 15 == 7) | ((k - k % 2) % 22 == 0), "").otherwise(_md5("e", k - k % 2)).alias("endpoint"),
            F.when(k % 3 == 0, "ogl3").otherwise("").alias("licence"),
            F.concat(F.lit("https://docs.example.com/"), _s(k)).alias("documentation_url"),
            (F.when(k % 4 == 0, "tree").when(k % 4 == 1, "tree;tree-zone")
             .when(k % 4 == 2, "area;tree").otherwise("")).alias("pipelines"),
            k.alias("pos"),
        )

    @cached_property
    def endpoint(self) -> DataFrame:
        # some endpoints come twice, the second time with an earlier entry and a later end
        s = self.table("supplier")
        s = s.where(s.s_suppkey % 2 == 0).select("*", F.explode(
            F.when(s.s_suppkey % 18 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("again"))
        k, again = s.s_suppkey, F.col("again")
        return s.select(
            _md5("e", k).alias("endpoint"),
            F.concat(F.lit("https://data.example.com/"), _s(k)).alias("endpoint_url"),
            F.concat(_s(F.date_add(F.lit("2019-01-01").cast("date"), ((k % 90) - again * 5).cast("int"))),
                     F.lit("T00:00:00Z")).alias("entry_date"),
            F.when(again == 1, "2021-06-15").when(k % 14 == 0, "2021-06-01").otherwise("").alias("end_date"),
            F.when(k % 22 == 0, "collection-own").otherwise("").alias("collection"),
            (k * 2 + again).alias("pos"),
        )

    @cached_property
    def resource(self) -> DataFrame:
        # twenty parts a supplier; some resources come twice, some name an unknown
        # endpoint, some one that no source has
        p = self.spread("part", ["p_partkey", "p_size"])
        p = p.select("*", F.explode(
            F.when(p.p_partkey % 40 == 5, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("again"))
        k, again = p.p_partkey, F.col("again")
        j = F.floor(k / 20).cast("bigint")
        first, second = j - j % 2, j + 6 - (j + 6) % 2
        return p.select(
            _md5("r", k).alias("resource"),
            F.when(again == 1, "2019-12-01").otherwise(F.concat(F.lit("2020-01-"), F.lpad(_s(k % 28 + 1), 2, "0"))).alias("start_date"),
            F.when(again == 1, "2023-01-01").when(p.p_size % 10 == 0, "2022-01-01").otherwise("").alias("end_date"),
            F.when(k % 50 == 9, _md5("x", k)).when(k % 50 == 10, _md5("e", F.lit(22)))
            .otherwise(F.concat(_md5("e", first), F.lit(";"), _md5("e", second))).alias("endpoints"),
            (k * 2 + again).alias("pos"),
        )

    @cached_property
    def old_resource(self) -> DataFrame:
        p = self.table("part")
        k = p.p_partkey
        return p.where(k % 25 == 3).select(_md5("r", k).alias("old_resource"),
                                           _md5("r", k + 1).alias("resource"))

    @cached_property
    def log(self) -> DataFrame:
        # every row; some endpoints never answered 200, some have unreadable dates
        li = self.spread("lineitem", ["l_orderkey", "l_linenumber", "l_suppkey", "l_partkey", "l_shipdate", "l_returnflag"])
        ln = li.l_linenumber
        rf = li.l_returnflag
        e = li.l_suppkey - li.l_suppkey % 2
        return li.select(
            _md5("e", e).alias("endpoint"),
            F.when((e % 34 == 0) & (li.l_orderkey % 97 == 5), "not-a-date")
            .otherwise(F.concat(_day_text(li.l_shipdate), F.lit("T0"), _s(ln), F.lit(":00:00Z"))).alias("entry_date"),
            F.when((rf != "R") & (e % 26 != 0), "200").when(ln % 2 == 0, "404").otherwise("").alias("status"),
            F.when((rf == "R") & (ln % 2 == 1), "ConnectionError").otherwise("").alias("exception"),
            F.when(rf != "R", _md5("r", li.l_partkey)).otherwise("").alias("resource"),
        )

    @cached_property
    def issue_type(self) -> DataFrame:
        # The issue-type specification stand-in.
        # One type comes twice. As VALUES the planner knows its size.
        return self.spark.sql(_ISSUE_TYPES)

    @cached_property
    def issue(self) -> DataFrame:
        return self._issue(self.table("orders"))

    @cached_property
    def issue_dealt(self) -> DataFrame:
        # for reports that group it: nearly every row is a group of its own, which the
        # task that reads it holds
        return self._issue(self.spread("orders", ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
                                                  "o_orderpriority"]))

    @staticmethod
    def _issue(o: DataFrame) -> DataFrame:
        k = o.o_orderkey
        return o.select(
            _md5("r", o.o_custkey).alias("resource"),
            F.when(k % 3 == 0, "tree").when(k % 3 == 1, "area").otherwise("tree-zone").alias("dataset"),
            _s(k % 7).alias("row_number"),
            F.when(o.o_orderstatus == "F", "geometry").when(o.o_orderstatus == "O", "start-date")
            .otherwise("reference").alias("field"),
            o.o_orderpriority.alias("issue_type"),
            _s(o.o_totalprice).alias("value"),
            k.alias("line_number"),
        )

    @cached_property
    def provision(self) -> DataFrame:
        o = self.organisation
        n = o.n_nationkey
        return o.select(
            "organisation",
            F.explode(F.array(F.lit("tree"), F.lit("tree-zone"), F.lit("area"))).alias("dataset"),
            F.concat(F.lit("cohort-"), _s(n % 3)).alias("cohort"),
            F.when(n % 2 == 0, "statutory").otherwise("expected").alias("provision_reason"),
            F.when(n % 11 == 10, F.lit(None).cast("string")).when(n % 5 == 4, "2023-01-01")
            .otherwise("").alias("end_date"),
        )

    @cached_property
    def column_field(self) -> DataFrame:
        p = self.table("part")
        rep = p.select(
            "p_partkey", "p_name",
            F.explode(F.array(F.lit("tree"), F.lit("tree-zone"), F.lit("area"))).alias("dataset"),
        ).select("*", F.explode(F.array(*[F.lit(i) for i in range(4)])).alias("k"))
        k = rep.k
        return rep.where((rep.p_partkey + k) % 3 != 0).select(
            _md5("r", rep.p_partkey).alias("resource"),
            "dataset",
            F.when(k == 0, "Start_Date").when(k == 1, "WKT").when(k == 2, "ref no")
            .otherwise(rep.p_name).alias("column_name"),
            F.when(k == 0, "start-date").when(k == 1, "geometry").when(k == 2, "reference")
            .otherwise(F.replace(rep.p_name, F.lit(" "), F.lit("-"))).alias("field"),
        )

    @cached_property
    def raw_source(self) -> DataFrame:
        o = self.table("orders")
        k = o.o_orderkey
        day = _day_text(o.o_orderdate)
        return o.select(
            F.when(k % 9 == 0, "").otherwise(F.concat(F.lit("old-"), _s(k))).alias("source"),
            F.concat(F.lit("collection-"), _s(o.o_custkey % 5)).alias("collection"),
            F.concat(F.lit("local-authority-eng:"), _s(o.o_custkey % 25)).alias("organisation"),
            _md5("e", o.o_custkey).alias("endpoint"),
            F.when(k % 4 == 0, "tree").otherwise("").alias("dataset"),
            F.when(k % 3 == 0, "area").otherwise("tree-zone").alias("pipeline"),
            (F.when(k % 6 == 0, "")
             .when(k % 6 == 1, F.concat(day, F.lit("T09:30:00.123+01:00")))
             .when(k % 6 == 2, F.concat(day, F.lit("T09:30:00Z")))
             .when(k % 6 == 3, day)
             .when(k % 6 == 4, F.substring(day, 1, 7))
             .otherwise(F.substring(day, 1, 4))).alias("entry_date"),
            (F.when(k % 4 == 0, "").when(k % 4 == 1, day).when(k % 4 == 2, F.substring(day, 1, 7))
             .otherwise(F.substring(day, 1, 4))).alias("start_date"),
            o.o_orderstatus.alias("undeclared"),
        )

    @cached_property
    def converted(self) -> DataFrame:
        e = self.table("events")
        rid = F.md5(_s(e.event_id))
        return e.select(
            F.concat(F.lit("var/converted-resource/"), e.event_type, F.lit("/"), rid, F.lit(".csv")).alias("path"),
            F.when(e.user_id % 10 == 0, "other").otherwise(e.event_type).alias("dataset"),
            F.when(e.event_id % 13 == 0, F.md5(F.lit("wrong"))).otherwise(rid).alias("resource"),
            e.value.alias("elapsed"),
            F.when(e.event_type == "error", "failed").otherwise("done").alias("status"),
            F.lit("").alias("exception"),
        )

    @cached_property
    def landed(self) -> DataFrame:
        r = self.resource
        return r.where(r.start_date < "2020-01-10").select(
            F.concat(F.lit("var/issue/tree/"), r.resource, F.lit(".csv")).alias("output_path"))

    @cached_property
    def geography(self) -> DataFrame:
        p = self.table("part")
        return p.select(
            F.when(p.p_size % 12 == 0, "")
            .otherwise(F.concat(F.lit("/area/"), F.replace(p.p_name, F.lit(" "), F.lit("\t")),
                                F.lit("/"), _s(p.p_partkey))).alias("slug_id_label"))

    @cached_property
    def blank_list(self) -> DataFrame:
        p = self.table("part")
        k = p.p_partkey
        blank = (k % 7 == 0) | (k % 35 == 1)
        return p.select(
            k.alias("pos"),
            F.when(blank, "").otherwise(F.concat(F.lit("/area/"), _s(k))).alias("slug"),
            F.when(blank, "").otherwise(p.p_name).alias("name"),
        )

    @cached_property
    def expectation_a(self) -> DataFrame:
        lb = self.table("labels")
        return lb.select("doc_id", lb.quality.alias("passed"), F.lit("quality").alias("operation"))

    @cached_property
    def expectation_b(self) -> DataFrame:
        lb = self.table("labels")
        return lb.select("doc_id", lb.toxic.alias("failed"), F.lit("toxic").alias("operation"),
                         (lb.doc_id.cast("double") / 2).alias("score"))

    @cached_property
    def operational_issue(self) -> DataFrame:
        o = self.table("orders")
        k = o.o_orderkey
        return o.select(
            F.when(k % 3 == 0, "tree").when(k % 3 == 1, "area").otherwise("tree-zone").alias("dataset"),
            _md5("r", o.o_custkey).alias("resource"),
            k.alias("line_number"),
            k.alias("entry_number"),
            F.lit("reference").alias("field"),
            o.o_orderpriority.alias("issue_type"),
            _s(o.o_totalprice).alias("value"),
            F.lit("").alias("message"),
            _day_text(o.o_orderdate).alias("entry_date"),
        )

    @cached_property
    def source_pipeline(self) -> DataFrame:
        from regscope.functions.keys import explode_list
        return explode_list(self.source, "pipelines", "pipeline", keep=["source"])

    @cached_property
    def column_field_table(self) -> DataFrame:
        """``column_field`` under its registry column name (``column``)."""
        return self.column_field.withColumnRenamed("column_name", "column")

    @cached_property
    def cell(self) -> DataFrame:
        """Texts that a CSV file must bring back as they are: blanks at their ends,
        separators, quotes and line breaks."""
        p = self.table("part")
        k = p.p_partkey
        return p.select(
            _s(k).alias("key"), F.concat(F.lit("  "), p.p_name).alias("lead"), F.concat(p.p_name, F.lit(" \t")).alias("trail"),
            F.concat(F.lit('say "'), p.p_name, F.lit('", or\nnot')).alias("quoted"), F.when(k % 3 == 0, "").otherwise(" ").alias("blank"))

    @cached_property
    def file(self) -> DataFrame:
        """Landed files of every kind: the documents behind each kind's first characters."""
        d = self.table("documents")
        heads = F.lit("")
        for i, head in enumerate(FILE_HEADS):
            heads = F.when(d.doc_id % 9 == i, F.lit(head)).otherwise(heads)
        return d.select("doc_id", F.concat(heads, F.coalesce(d.text, F.lit(""))).alias("content"))

    @cached_property
    def line_cell(self) -> DataFrame:
        """Rows of a table whose cells hold line breaks, quotes and separators."""
        li = self.table("lineitem")
        k = li.l_orderkey
        note = (F.when(k % 5 == 0, F.concat(F.lit("first line\nsecond, \""), li.l_returnflag, F.lit('"')))
                .when(k % 5 == 1, F.concat(li.l_linestatus, F.lit("\n\n\n"))).when(k % 5 == 2, "").when(k % 5 == 3, '5" pipe').otherwise(li.l_returnflag))
        return li.select(_s(k).alias("order"), _s(li.l_linenumber).alias("line"), note.alias("note"), _day_text(li.l_shipdate).alias("day"),
                         F.concat(F.lit("part "), _s(li.l_partkey)).alias("part"))

    @cached_property
    def dataset(self) -> DataFrame:
        """The specification's datasets; some belong to no collection at all."""
        p = self.table("part")
        k = p.p_partkey
        return p.select(F.concat(F.lit("dataset-"), _s(k)).alias("dataset"),
                        F.when(k % 7 == 3, "").when(k % 7 == 5, F.lit(None).cast("string"))
                        .otherwise(F.concat(F.lit("collection-"), _s(k % 5))).alias("collection"))

    def raw_table(self, i: int, of: int) -> DataFrame:
        """The i-th of some raw tables, its columns named as in landed files."""
        o = self.table("orders")
        k = o.o_orderkey
        day = _day_text(o.o_orderdate)
        return o.where(k % of == i).select(
            _s(k).alias("source"), F.concat(F.lit("collection-"), _s(o.o_custkey % 5)).alias("collection"),
            F.concat(F.lit("local-authority-eng:"), _s(o.o_custkey % 25)).alias("organisation"), _md5("e", o.o_custkey).alias("endpoint"),
            F.when(k % 3 == 0, "tree").otherwise("").alias("dataset"), F.lit("area").alias("pipeline"),
            F.when(k % 2 == 0, F.substring(day, 1, 7)).otherwise(F.concat(day, F.lit("T09:30:00.5Z"))).alias("entry-date"),
            F.when(o.o_custkey % 2 == 0, F.substring(day, 1, 4)).otherwise(day).alias("start-date"), o.o_orderstatus.alias("undeclared"))

    def registry_tables(self) -> "RegistryTables":
        """The tables the registry reports read, keyed by registry name (built on first use)."""
        return RegistryTables(self)


class RegistryTables(Mapping):
    """Read-only ``name -> DataFrame`` view over a ``Fixtures`` instance."""

    _NAMES = {"log": "log", "source": "source", "endpoint": "endpoint", "organisation": "organisation",
              "resource": "resource", "source_pipeline": "source_pipeline", "provision": "provision",
              "issue": "issue_dealt", "issue_type": "issue_type", "column_field": "column_field_table",
              "old_resource": "old_resource"}

    def __init__(self, fx: Fixtures):
        self._fx = fx

    def __getitem__(self, name: str) -> DataFrame:
        return getattr(self._fx, self._NAMES[name])

    def __iter__(self):
        return iter(self._NAMES)

    def __len__(self) -> int:
        return len(self._NAMES)


_INSTANCES: dict = {}

_ISSUE_TYPES = ("SELECT * FROM VALUES ('1-URGENT','error','internal'), ('2-HIGH','error','external'), ('3-MEDIUM','warning','internal'), "
                "('4-NOT SPECIFIED','warning','external'), ('4-NOT SPECIFIED','notice','internal'), ('5-LOW','notice','external') "
                "AS t(issue_type, severity, responsibility)")


# --------------------------------------------------------------------------
# The same views as SQL text for the DuckDB oracle, in dependency order.
# --------------------------------------------------------------------------
FX_SQL: dict[str, str] = {
    "fx_organisation": """
SELECT concat(CASE n_regionkey % 4 WHEN 0 THEN 'local-authority' WHEN 1 THEN 'development-corporation' WHEN 2 THEN 'national-park' ELSE 'government-organisation' END, ':', CAST(n_nationkey AS STRING)) AS organisation,
       n_name AS name, concat('dataset-', CAST(n_regionkey AS STRING)) AS dataset, n_nationkey
FROM nation""",
    "fx_source": """
SELECT CASE WHEN s_suppkey % 20 = 0 THEN '' ELSE concat('source-', CAST(s_suppkey AS STRING)) END AS source,
       replace(o.organisation, ':', CASE WHEN s_suppkey % 30 = 4 THEN '-eng-eng:' ELSE '-eng:' END) AS organisation,
       CASE s_suppkey % 25 WHEN 3 THEN '' WHEN 9 THEN NULL ELSE concat('collection-', CAST(s_suppkey % 5 AS STRING)) END AS collection,
       CASE WHEN s_suppkey % 15 = 7 OR (s_suppkey - s_suppkey % 2) % 22 = 0 THEN '' ELSE md5(concat('e', CAST(s_suppkey - s_suppkey % 2 AS STRING))) END AS endpoint,
       CASE WHEN s_suppkey % 3 = 0 THEN 'ogl3' ELSE '' END AS licence,
       concat('https://docs.example.com/', CAST(s_suppkey AS STRING)) AS documentation_url,
       CASE s_suppkey % 4 WHEN 0 THEN 'tree' WHEN 1 THEN 'tree;tree-zone' WHEN 2 THEN 'area;tree' ELSE '' END AS pipelines,
       s_suppkey AS pos
FROM supplier JOIN fx_organisation o ON s_nationkey = o.n_nationkey""",
    "fx_endpoint": """
SELECT md5(concat('e', CAST(s_suppkey AS STRING))) AS endpoint,
       concat('https://data.example.com/', CAST(s_suppkey AS STRING)) AS endpoint_url,
       concat(CAST(DATE '2019-01-01' + CAST(s_suppkey % 90 - again * 5 AS INT) AS STRING), 'T00:00:00Z') AS entry_date,
       CASE WHEN again = 1 THEN '2021-06-15' WHEN s_suppkey % 14 = 0 THEN '2021-06-01' ELSE '' END AS end_date,
       CASE WHEN s_suppkey % 22 = 0 THEN 'collection-own' ELSE '' END AS collection, s_suppkey * 2 + again AS pos
FROM (SELECT *, unnest(CASE WHEN s_suppkey % 18 = 0 THEN [0, 1] ELSE [0] END) AS again FROM supplier) WHERE s_suppkey % 2 = 0""",
    "fx_resource": """
SELECT md5(concat('r', CAST(p_partkey AS STRING))) AS resource,
       CASE again WHEN 1 THEN '2019-12-01' ELSE concat('2020-01-', lpad(CAST(p_partkey % 28 + 1 AS STRING), 2, '0')) END AS start_date,
       CASE WHEN again = 1 THEN '2023-01-01' WHEN p_size % 10 = 0 THEN '2022-01-01' ELSE '' END AS end_date,
       CASE p_partkey % 50 WHEN 9 THEN md5(concat('x', CAST(p_partkey AS STRING))) WHEN 10 THEN md5('e22')
         ELSE concat(md5(concat('e', CAST(j - j % 2 AS STRING))), ';', md5(concat('e', CAST(j + 6 - (j + 6) % 2 AS STRING)))) END AS endpoints,
       p_partkey * 2 + again AS pos
FROM (SELECT *, p_partkey // 20 AS j, unnest(CASE WHEN p_partkey % 40 = 5 THEN [0, 1] ELSE [0] END) AS again FROM part)""",
    "fx_old_resource": """
SELECT md5(concat('r', CAST(p_partkey AS STRING))) AS old_resource, md5(concat('r', CAST(p_partkey + 1 AS STRING))) AS resource
FROM part WHERE p_partkey % 25 = 3""",
    "fx_log": """
SELECT md5(concat('e', CAST(l_suppkey - l_suppkey % 2 AS STRING))) AS endpoint,
       CASE WHEN (l_suppkey - l_suppkey % 2) % 34 = 0 AND l_orderkey % 97 = 5 THEN 'not-a-date'
            ELSE concat(CAST(CAST(l_shipdate AS DATE) AS STRING), 'T0', CAST(l_linenumber AS STRING), ':00:00Z') END AS entry_date,
       CASE WHEN l_returnflag <> 'R' AND (l_suppkey - l_suppkey % 2) % 26 <> 0 THEN '200' WHEN l_linenumber % 2 = 0 THEN '404' ELSE '' END AS status,
       CASE WHEN l_returnflag = 'R' AND l_linenumber % 2 = 1 THEN 'ConnectionError' ELSE '' END AS exception,
       CASE WHEN l_returnflag <> 'R' THEN md5(concat('r', CAST(l_partkey AS STRING))) ELSE '' END AS resource
FROM lineitem""",
    "fx_issue_type": """
SELECT * FROM (VALUES ('1-URGENT','error','internal'),('2-HIGH','error','external'),('3-MEDIUM','warning','internal'),('4-NOT SPECIFIED','warning','external'),('4-NOT SPECIFIED','notice','internal'),('5-LOW','notice','external')) AS t(issue_type, severity, responsibility)""",
    "fx_issue": """
SELECT md5(concat('r', CAST(o_custkey AS STRING))) AS resource, CASE o_orderkey % 3 WHEN 0 THEN 'tree' WHEN 1 THEN 'area' ELSE 'tree-zone' END AS dataset,
       CAST(o_orderkey % 7 AS STRING) AS row_number, CASE o_orderstatus WHEN 'F' THEN 'geometry' WHEN 'O' THEN 'start-date' ELSE 'reference' END AS field,
       o_orderpriority AS issue_type, CAST(o_totalprice AS STRING) AS value, o_orderkey AS line_number
FROM orders""",
    "fx_provision": """
SELECT organisation, d.dataset, concat('cohort-', CAST(n_nationkey % 3 AS STRING)) AS cohort,
       CASE WHEN n_nationkey % 2 = 0 THEN 'statutory' ELSE 'expected' END AS provision_reason,
       CASE WHEN n_nationkey % 11 = 10 THEN NULL WHEN n_nationkey % 5 = 4 THEN '2023-01-01' ELSE '' END AS end_date
FROM fx_organisation CROSS JOIN (SELECT * FROM (VALUES ('tree'),('tree-zone'),('area')) AS v(dataset)) d""",
    "fx_column_field": """
SELECT md5(concat('r', CAST(p_partkey AS STRING))) AS resource, d.dataset,
       CASE k WHEN 0 THEN 'Start_Date' WHEN 1 THEN 'WKT' WHEN 2 THEN 'ref no' ELSE p_name END AS column_name,
       CASE k WHEN 0 THEN 'start-date' WHEN 1 THEN 'geometry' WHEN 2 THEN 'reference' ELSE replace(p_name, ' ', '-') END AS field
FROM part CROSS JOIN (SELECT * FROM (VALUES ('tree'),('tree-zone'),('area')) AS v(dataset)) d CROSS JOIN (SELECT * FROM (VALUES (0),(1),(2),(3)) AS w(k)) w
WHERE (p_partkey + k) % 3 <> 0""",
    "fx_raw_source": """
SELECT CASE WHEN o_orderkey % 9 = 0 THEN '' ELSE concat('old-', CAST(o_orderkey AS STRING)) END AS source, concat('collection-', CAST(o_custkey % 5 AS STRING)) AS collection,
       concat('local-authority-eng:', CAST(o_custkey % 25 AS STRING)) AS organisation, md5(concat('e', CAST(o_custkey AS STRING))) AS endpoint,
       CASE WHEN o_orderkey % 4 = 0 THEN 'tree' ELSE '' END AS dataset, CASE WHEN o_orderkey % 3 = 0 THEN 'area' ELSE 'tree-zone' END AS pipeline,
       CASE o_orderkey % 6 WHEN 0 THEN '' WHEN 1 THEN concat(CAST(CAST(o_orderdate AS DATE) AS STRING), 'T09:30:00.123+01:00') WHEN 2 THEN concat(CAST(CAST(o_orderdate AS DATE) AS STRING), 'T09:30:00Z') WHEN 3 THEN CAST(CAST(o_orderdate AS DATE) AS STRING) WHEN 4 THEN substring(CAST(CAST(o_orderdate AS DATE) AS STRING), 1, 7) ELSE substring(CAST(CAST(o_orderdate AS DATE) AS STRING), 1, 4) END AS entry_date,
       CASE o_orderkey % 4 WHEN 0 THEN '' WHEN 1 THEN CAST(CAST(o_orderdate AS DATE) AS STRING) WHEN 2 THEN substring(CAST(CAST(o_orderdate AS DATE) AS STRING), 1, 7) ELSE substring(CAST(CAST(o_orderdate AS DATE) AS STRING), 1, 4) END AS start_date,
       o_orderstatus AS undeclared
FROM orders""",
    "fx_converted": """
SELECT concat('var/converted-resource/', event_type, '/', md5(CAST(event_id AS STRING)), '.csv') AS path,
       CASE WHEN user_id % 10 = 0 THEN 'other' ELSE event_type END AS dataset,
       CASE WHEN event_id % 13 = 0 THEN md5('wrong') ELSE md5(CAST(event_id AS STRING)) END AS resource, value AS elapsed, CASE WHEN event_type = 'error' THEN 'failed' ELSE 'done' END AS status, '' AS exception
FROM events""",
    "fx_landed": """
SELECT concat('var/issue/tree/', resource, '.csv') AS output_path FROM fx_resource WHERE start_date < '2020-01-10'""",
    "fx_geography": """
SELECT CASE WHEN p_size % 12 = 0 THEN '' ELSE concat('/area/', replace(p_name, ' ', chr(9)), '/', CAST(p_partkey AS STRING)) END AS slug_id_label FROM part""",
    "fx_blank_list": """
SELECT p_partkey AS pos, CASE WHEN p_partkey % 7 = 0 OR p_partkey % 35 = 1 THEN '' ELSE concat('/area/', CAST(p_partkey AS STRING)) END AS slug, CASE WHEN p_partkey % 7 = 0 OR p_partkey % 35 = 1 THEN '' ELSE p_name END AS name FROM part""",
    "fx_expectation_a": """
SELECT doc_id, quality AS passed, 'quality' AS operation FROM labels""",
    "fx_expectation_b": """
SELECT doc_id, toxic AS failed, 'toxic' AS operation, CAST(doc_id AS DOUBLE) / 2 AS score FROM labels""",
    "fx_operational_issue": """
SELECT CASE o_orderkey % 3 WHEN 0 THEN 'tree' WHEN 1 THEN 'area' ELSE 'tree-zone' END AS dataset, md5(concat('r', CAST(o_custkey AS STRING))) AS resource, o_orderkey AS line_number, o_orderkey AS entry_number,
       'reference' AS field, o_orderpriority AS issue_type, CAST(o_totalprice AS STRING) AS value, '' AS message, CAST(CAST(o_orderdate AS DATE) AS STRING) AS entry_date
FROM orders""",
}

FX_SQL["fx_cell"] = """
SELECT CAST(p_partkey AS STRING) AS "key", concat('  ', p_name) AS lead, concat(p_name, ' ', chr(9)) AS trail,
       concat('say "', p_name, '", or', chr(10), 'not') AS quoted, CASE WHEN p_partkey % 3 = 0 THEN '' ELSE ' ' END AS blank
FROM part"""
FX_SQL["fx_file"] = "SELECT doc_id, concat(CASE doc_id % 9 " + " ".join(
    f"WHEN {i} THEN concat('', " + ", ".join(f"chr({ord(c)})" for c in head) + ")" for i, head in enumerate(FILE_HEADS)) \
    + " ELSE '' END, coalesce(text, '')) AS content FROM documents"

FX_SQL["fx_line_cell"] = """
SELECT CAST(l_orderkey AS STRING) AS "order", CAST(l_linenumber AS STRING) AS line,
       CASE l_orderkey % 5 WHEN 0 THEN concat('first line', chr(10), 'second, "', l_returnflag, '"') WHEN 1 THEN concat(l_linestatus, chr(10), chr(10), chr(10))
         WHEN 2 THEN '' WHEN 3 THEN '5" pipe' ELSE l_returnflag END AS note,
       CAST(CAST(l_shipdate AS DATE) AS STRING) AS "day", concat('part ', CAST(l_partkey AS STRING)) AS part FROM lineitem"""
FX_SQL["fx_dataset"] = """
SELECT concat('dataset-', CAST(p_partkey AS STRING)) AS dataset,
       CASE p_partkey % 7 WHEN 3 THEN '' WHEN 5 THEN NULL ELSE concat('collection-', CAST(p_partkey % 5 AS STRING)) END AS collection FROM part"""

# Derived views the oracle statements share (also in dependency order).
FX_SQL.update({
    "fx_source_pipeline": """
SELECT source, unnest(string_split(pipelines, ';')) AS pipeline FROM fx_source""",
})


def fx_with(sql: str) -> str:
    """Prefix ``sql`` with the ``WITH`` items of every fx view it mentions.

    Dependencies are resolved by name, and the items keep ``FX_SQL`` order
    (later views refer only to earlier ones).
    """
    names = list(FX_SQL)
    needed: set[str] = set()

    def visit(text: str) -> None:
        for n in names:
            if n not in needed and _mentions(text, n):
                needed.add(n)
                visit(FX_SQL[n])

    visit(sql)
    if not needed:
        return sql
    items = ",\n".join(f"{n} AS ({FX_SQL[n].strip()})" for n in names if n in needed)
    body = sql.strip()
    if body.upper().startswith("WITH "):
        return f"WITH {items},\n{body[5:]}"
    return f"WITH {items}\n{body}"


def _mentions(text: str, name: str) -> bool:
    import re
    return re.search(rf"\b{re.escape(name)}\b", text) is not None

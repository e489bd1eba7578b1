"""Mixing sources to target weights by Sainte-Laguë apportionment.

Sizes are words. A source's documents are dealt to shards; a shard is a stream
of its words in seeded order, twice over (a document may be used twice), cut in
blocks of equal size. Blocks are allocated to sources by highest quotients
``target / (2 s + 1)``, and within a source to its shards the same way, giving
an integer quota per shard; a shard takes its first ``quota`` blocks.

The quotients are not listed block by block: a divisor method's seats are
``round(target / d)`` for some divisor ``d``. With ``d`` the mean block, the
rounded seats are themselves such an allocation, at most half a seat per
claimant from the wanted total; only that difference is then contested,
quotient by quotient.

Sources by code point weigh ``weights``, repeating; null is a source and comes
last. Null text has size 0. Sources without words get nothing. Rows that repeat
an id are separate rows. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from regscope.llm.common import WORD, row_id, stage

# Fixed values of the default mix.
WEIGHTS = (3, 1, 2)
SHARE = 1.5
EPOCHS = 2
BLOCK = 16
SHARD_ROWS = 1_000
SEED = "mix-1"


def with_sizes(docs: DataFrame, id_col: str, source_col: str, text_col: str) -> DataFrame:
    size = F.regexp_count(F.coalesce(F.col(text_col), F.lit("")), F.lit(WORD)).cast("long")
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).cast("string").alias("source"), size.alias("size"),
                       F.xxhash64(F.col(text_col)).alias("text_key"), F.md5(F.col(text_col).cast("binary")).alias("_text"))


def targets(sources: DataFrame, weights=WEIGHTS, share: float = SHARE, epochs: int = EPOCHS) -> DataFrame:
    """(source, source_size) to (.., weight, target): shares of the mix by weight,
    none above ``epochs`` times its source; the excess goes to the others. The
    level at which this holds is found in one pass over the sources in the order
    in which they fill up. One row per source: windows over it are small."""
    order = Window.orderBy(F.col("source").isNull(), F.col("source"))
    ws = F.array(*[F.lit(float(w)) for w in weights])
    s = sources.withColumn("weight", F.element_at(ws, (F.pmod(F.row_number().over(order) - 1, F.lit(len(weights))) + 1).cast("int")))
    s = s.withColumn("cap", F.lit(float(epochs)) * F.col("source_size"))
    fill = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").isNull(), F.col("source"))
    before, on = fill.rowsBetween(Window.unboundedPreceding, -1), fill.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy()
    s = s.withColumn("level", (F.lit(float(share)) * F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
                     / F.sum("weight").over(on))
    fits = F.col("level") * F.col("weight") <= F.col("cap")
    s = s.withColumn("level", F.coalesce(F.first(F.when(fits, F.col("level")), ignorenulls=True)
                                         .over(fill.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)), F.lit(float("inf"))))
    return s.withColumn("target", F.least("cap", F.col("level") * F.col("weight"))).select("source", "source_size", "weight", "target")


def apportion(claims: DataFrame, seats: str, claim: str, cap: str, out: str, by: list[str], tie: list[str]) -> DataFrame:
    """Adds ``out``: the Sainte-Laguë share of ``seats`` (a column, equal within
    ``by``) for each row's ``claim``, at most ``cap`` seats a row. ``tie`` orders
    equal quotients."""
    w = Window.partitionBy(*by)
    total = F.sum(claim).over(w)
    base = F.when(total > 0, F.least(F.col(cap), F.round(F.col(claim) * F.col(seats) / total).cast("long"))).otherwise(F.lit(0))
    due = F.when(total > 0, F.round(F.col(claim) * F.col(seats) / total))
    capped = F.sum(F.when(due > F.col(cap), 1).otherwise(0)).over(w)
    # Rounding leaves at most half a seat a claimant to contest, so in the end the divisor
    # has moved by n / (2 total) at most, and a claimant's seats by that times its claim, and
    # one. Twice that, and some, are listed: as many quotients as claimants, not their square.
    # Where caps took seats the divisor can move further: then every quotient is listed that
    # the caps leave room for.
    most = F.when(capped == 0, F.ceil(F.col(claim) * F.count(F.lit(1)).over(w) / F.greatest(total, F.lit(1))) + 4).otherwise(F.lit(1 << 62)).cast("long")
    c = claims.withColumn("_base", base.cast("long")).withColumn("_most", most).withColumn("_gap", F.col(seats) - F.sum("_base").over(w))
    # a gap above 0: the highest next quotients win a seat; below 0: the lowest last ones lose one
    wins = F.transform(F.sequence(F.lit(1).cast("long"), F.least(F.col("_gap"), F.col(cap) - F.col("_base"), F.col("_most"))),
                       lambda i: F.col(claim) / (2 * (F.col("_base") + i) - 1))
    lost = F.transform(F.sequence(F.lit(1).cast("long"), F.least(-F.col("_gap"), F.col("_base"), F.col("_most"))),
                       lambda i: -F.col(claim) / (2 * (F.col("_base") - i) + 1))
    room = F.when((F.col("_gap") > 0) & (F.col("_base") < F.col(cap)) & (F.col(claim) > 0), wins) \
        .when((F.col("_gap") < 0) & (F.col("_base") > 0), lost).otherwise(F.array().cast("array<double>"))
    contest = c.select(*by, *[t for t in tie if t not in by], "_gap", F.posexplode(room).alias("_i", "_q"))
    # of equal quotients the first by ``tie`` wins a seat, and the last loses one
    ties = [k for t in tie for k in (F.when(F.col("_gap") > 0, F.col(t)).asc_nulls_last(), F.when(F.col("_gap") < 0, F.col(t)).desc_nulls_first())]
    rank = Window.partitionBy(*by).orderBy(F.desc("_q"), *ties, "_i")
    won = contest.withColumn("_r", F.row_number().over(rank)).filter(F.col("_r") <= F.abs("_gap"))
    keys = list(dict.fromkeys([*by, *tie]))
    won = won.groupBy(*[F.col(k).alias(f"_k_{k}") for k in keys]).agg(F.sum(F.signum(F.col("_gap").cast("double"))).cast("long").alias("_change"))
    both = c.join(won, F.expr(" and ".join(f"{k} <=> _k_{k}" for k in keys)), "left")
    return both.select(*claims.columns, (F.col("_base") + F.coalesce("_change", F.lit(0))).alias(out))


def plan(sized: DataFrame, weights=WEIGHTS, share: float = SHARE, epochs: int = EPOCHS, block: int = BLOCK,
         shard_rows: int = SHARD_ROWS, seed: str = SEED) -> tuple[DataFrame, DataFrame]:
    """(rows with their shard and seeded order, quotas per shard)."""
    stats = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("_rows"))
    shards = F.ceil(F.col("_rows") / shard_rows).cast("long")
    src = targets(stats, weights, share, epochs)
    src = src.withColumn("_all", F.lit(1)).withColumn("_seats", F.round(F.sum("target").over(Window.partitionBy("_all")) / block).cast("long"))
    src = src.withColumn("_cap", F.ceil(F.col("source_size") * epochs / block).cast("long"))
    src = apportion(src, "_seats", "target", "_cap", "source_quota", ["_all"], ["source"])
    n = stats.select(F.col("source").alias("_s"), shards.alias("_shards"))
    order = F.md5(F.concat_ws("|", F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), F.coalesce("_text", F.lit("-"))))
    rows = sized.join(n, F.expr("source <=> _s")).withColumn("_order", order)
    rows = rows.withColumn("shard", F.pmod(F.conv(F.substring("_order", 1, 8), 16, 10).cast("long"), F.col("_shards"))) \
        .select("doc_id", "source", "size", "text_key", "shard", "_order")
    per = rows.groupBy("source", "shard").agg(F.sum("size").alias("shard_size"))
    per = per.withColumnRenamed("source", "_s").join(src, F.expr("_s <=> source"))
    per = per.withColumn("_cap", F.ceil(F.col("shard_size") * epochs / block).cast("long")).drop("_s")
    per = apportion(per.select("source", "source_size", "target", "source_quota", "shard", "shard_size", "_cap"),
                    "source_quota", "shard_size", "_cap", "quota", ["source"], ["shard"])
    return rows, per


def mix(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, epochs: int = EPOCHS, block: int = BLOCK,
        shard_rows: int = SHARD_ROWS, seed: str = SEED,
        id_col: str = "doc_id", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken, and the
    shard and block quota behind it. ``taken`` counts words, repeats included."""
    if epochs != 2:
        raise ValueError("a shard's stream is two passes over its documents")
    sized = stage(docs.sparkSession, with_sizes(docs, id_col, source_col, text_col), "mix-sizes")
    rows, per = plan(sized, weights, share, epochs, block, shard_rows, seed)
    p = per.select(F.col("source").alias("_s"), F.col("shard").alias("_h"), "source_size", "target", "shard_size", "quota")
    w = Window.partitionBy("source", "shard").orderBy("_order", "doc_id", "size", "text_key").rowsBetween(Window.unboundedPreceding, -1)
    r = rows.withColumn("_at", F.coalesce(F.sum("size").over(w), F.lit(0)))
    r = r.join(p, F.expr("source <=> _s and shard = _h"))
    upto = F.least(F.col("quota") * block, F.col("shard_size") * epochs)
    def within(at):
        return F.greatest(F.lit(0), F.least(F.col("size"), upto - at))
    return r.select("doc_id", "size", "source_size", "target",
                    (within(F.col("_at")) + within(F.col("_at") + F.col("shard_size"))).cast("long").alias("taken"), "source", "shard", "quota", "text_key")


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix itself, with the columns of ``docs``: a document of which the mix
    takes words comes once or twice, the one at a quota's end with the first
    words of its text only. Rows that repeat both id and text are one document
    that comes as often as the mix takes all of them."""
    taken = mix(docs, **options).withColumn("__llm_row", F.concat_ws("|", F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), F.col("text_key").cast("string")))
    taken = taken.groupBy("__llm_row", F.col("size").alias("__llm_size")).agg(F.sum("taken").alias("__llm_taken")).filter("__llm_taken > 0")
    d = docs.withColumn("__llm_row", row_id()).dropDuplicates(["__llm_row"]).join(taken, "__llm_row")
    parts = F.transform(F.sequence(F.lit(0).cast("long"), F.expr("(__llm_taken - 1) div __llm_size")), lambda i: F.least(F.col("__llm_size"), F.col("__llm_taken") - i * F.col("__llm_size")))
    d = d.withColumn("__llm_part", F.explode(parts))
    cut = F.array_join(F.slice(F.regexp_extract_all("text", F.lit(f"({WORD})"), F.lit(1)), 1, F.col("__llm_part").cast("int")), " ")
    d = d.withColumn("text", F.when(F.col("__llm_part") == F.col("__llm_size"), F.col("text")).otherwise(cut))
    if "n_chars" in docs.columns:
        d = d.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return d.select(*docs.columns)

"""Fill-in-the-middle: whole lines cut into prefix, middle and suffix.

A text is n units: lines with their line break, and a last line without one. Two
cuts between units are drawn from a digest of the id, so that reruns agree and no
state is kept. ``regexp_count`` gives n; a pattern of each row's own counts,
``unit{a}+`` and ``unit{b-a}+`` (possessive: a unit once taken is never given
back, so that matching is linear and needs no stack), captures prefix, middle and
suffix in one match, and the replacement puts marks between them. Lengths and the
original text are read back from the output alone.

Forms: ``psm`` is ``<P>``prefix``<S>``suffix``<M>``middle, ``spm`` is
``<S>``suffix``<P>``prefix``<M>``middle, ``plain`` is the text itself. A text that
is empty or holds a mark stays plain, so marks in an output are never the text's
own: a mark begins with ``<`` and has no other, thus none can straddle a cut.

Everything is a DataFrame function of one row: no shuffle, and rows that repeat an
id or a text are each cut (alike, if they share the id). Null text is empty. A
null id is digested as an empty string. A line of any length, or very many lines,
are one match. Other columns are left alone; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the contract: a unit, the marks, the digest's salt, rates of 100.
UNIT = r"[^\n]*\n|[^\n]+"
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SALT = "7:"
FIM_RATE = 100
SPM_RATE = 50

_CAPTURED = {"psm": r"$1<S>$3<M>$2", "spm": r"<S>$3<P>$1<M>$2"}
_READ_BACK = {
    "psm": (r"(?s)\A<P>(.*?)<S>(.*?)<M>(.*)\z", "$1$3$2"),
    "spm": (r"(?s)\A<S>(.*?)<P>(.*?)<M>(.*)\z", "$2$3$1"),
}


def units(text: Column) -> Column:
    """Number of lines, the last one without a line break included."""
    return F.regexp_count(text, F.lit(UNIT)).cast("long")


def draws(id_col: Column, salt: str = SALT) -> list[Column]:
    """Four unsigned 32-bit numbers from the digest of an id."""
    digest = F.sha2(F.concat(F.lit(salt), F.coalesce(id_col.cast("long").cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]


def fill_in_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salt: str = SALT,
                   fim_rate: int = FIM_RATE, spm_rate: int = SPM_RATE) -> DataFrame:
    """doc_id, text, n (units), form, output. ``fim_rate``: of 100 texts, how many
    are cut; ``spm_rate``: of 100 cut ones, how many have their suffix first."""
    row = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    h1, h2, h3, h4 = draws(F.col("doc_id"), salt)
    row = row.select("doc_id", "text", units(F.col("text")).alias("n"), h1.alias("h1"), h2.alias("h2"), h3.alias("h3"), h4.alias("h4"))
    marked = F.col("text") == ""
    for mark in (PREFIX, SUFFIX, MIDDLE):
        marked = marked | F.contains("text", F.lit(mark))
    form = F.when(marked | (F.col("h3") % 100 >= fim_rate), "plain").when(F.col("h4") % 100 < spm_rate, "spm").otherwise("psm")
    cuts = [F.col(h) % (F.col("n") + 1) for h in ("h1", "h2")]
    row = row.select("doc_id", "text", "n", form.alias("form"), F.least(*cuts).alias("a"), F.greatest(*cuts).alias("b"))
    counted = F.concat(F.lit(rf"(?s)\A((?:{UNIT}){{"), F.col("a").cast("string"), F.lit(rf"}}+)((?:{UNIT}){{"),
                       (F.col("b") - F.col("a")).cast("string"), F.lit(r"}+)(.*)\z"))
    marks = F.when(F.col("form") == "psm", PREFIX + _CAPTURED["psm"]).otherwise(_CAPTURED["spm"])
    cut = F.regexp_replace("text", counted, marks)
    return row.select("doc_id", "text", "n", "form", F.when(F.col("form") == "plain", F.col("text")).otherwise(cut).alias("output"))


def restore(output: Column, form: Column) -> Column:
    """The text, from an output and its form alone."""
    back = F.when(form == "plain", output)
    for name, (pattern, order) in _READ_BACK.items():
        back = back.when(form == name, F.regexp_replace(output, pattern, order))
    return back


def lengths(output: Column, form: Column) -> tuple[Column, Column]:
    """Code points of prefix and middle, from where the marks are; null if plain."""
    at = {m: F.instr(output, m).cast("long") for m in (PREFIX, SUFFIX, MIDDLE)}
    after = F.when(form == "psm", at[SUFFIX]).when(form == "spm", at[MIDDLE])  # the mark that ends the prefix
    prefix = after - at[PREFIX] - len(PREFIX)
    middle = F.when(form != "plain", F.char_length(output) - at[MIDDLE] - len(MIDDLE) + 1)
    return prefix.cast("long"), middle.cast("long")


def digest(cut: DataFrame) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256."""
    output, form = F.col("output"), F.col("form")
    prefix, middle = lengths(output, form)
    return cut.select("doc_id", "n", "form", prefix.alias("prefix_chars"), middle.alias("middle_chars"),
                      F.sha2(output, 256).alias("output_sha256"), F.sha2(restore(output, form), 256).alias("restored_sha256"))

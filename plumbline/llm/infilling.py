"""Fill-in-the-middle: a text is cut in three and its parts change places behind markers."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A line with its end, or what follows the last line end.
LINE = r"[^\n]*\n|[^\n]+"
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"


def draws(id: str, salt: str, n: int = 4) -> list[Column]:
    """Unsigned 32-bit numbers from the hash of salt and id; a null id counts as empty."""
    digest = F.sha2(F.concat(F.lit(salt), F.coalesce(F.col(id).cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("long") for i in range(n)]


def _three(a: Column, b: Column, unit: str) -> Column:
    """Pattern that captures ``a`` units, then ``b - a``, then the rest.

    The possessive counts make the engine run through the units in a loop instead of recursing, so
    texts of any number of lines match.
    """
    count = lambda n: F.concat(F.lit(f"((?:{unit}){{"), n.cast("string"), F.lit("}+)"))
    return F.concat(F.lit(r"(?s)\A"), count(a), count(b - a), F.lit(r"(.*)\z"))


def fill_in_middle(docs: DataFrame, id: str = "doc_id", text: str = "text", salt: str = "7:", unit: str = LINE,
                   rate: int = 100, suffix_first: int = 50) -> DataFrame:
    """Add ``n``, ``form``, ``output``, ``prefix_chars`` and ``middle_chars``, in place of ``text``.

    ``n`` is the number of units of the text; two draws by hash choose how many of them make up the
    prefix, and prefix and middle together. ``rate`` of 100 texts are rearranged, ``suffix_first`` of
    100 of those with the suffix in front ("spm"), the others with it behind the prefix ("psm"). One
    match of a pattern made for the row, with the counts in it, captures all three parts.

    Null texts count as empty. Empty texts and those that hold a marker stay as they are ("plain",
    with null lengths). Very long texts and any number of units work; equal ids draw alike, repeated
    rows stay, and an empty table gives none. Columns with the names of the result give way. Column
    expressions only, no shuffle.
    """
    added = ("n", "form", "output", "prefix_chars", "middle_chars")
    others = [c for c in docs.columns if c not in (text, *added)]
    rows = docs.select(F.struct(*others).alias("row"), F.coalesce(F.col(text), F.lit("")).alias("text"),
                       F.array(*draws(id, salt)).alias("h"))
    rows = rows.withColumn("n", F.coalesce(F.regexp_count("text", F.lit(unit)), F.lit(0)).cast("long"))
    h = [F.col("h")[i] for i in range(4)]
    first, second = (F.pmod(h[i], F.col("n") + 1) for i in (0, 1))
    marked = F.lit(False)
    for m in (PREFIX, SUFFIX, MIDDLE):
        marked = marked | F.contains("text", F.lit(m))
    plain = (F.col("text") == "") | marked | (F.pmod(h[2], F.lit(100)) >= rate)
    form = F.when(plain, "plain").when(F.pmod(h[3], F.lit(100)) < suffix_first, "spm").otherwise("psm")
    cut = rows.select("row", "text", "n", form.alias("form"),
                      _three(F.least(first, second), F.greatest(first, second), unit).alias("pattern"))
    order = F.when(F.col("form") == "spm", f"{SUFFIX}$3{PREFIX}$1{MIDDLE}$2").otherwise(f"{PREFIX}$1{SUFFIX}$3{MIDDLE}$2")
    moved = F.when(F.col("form") == "plain", F.col("text")).otherwise(F.regexp_replace("text", F.col("pattern"), order))
    done = cut.select("row", "n", "form", F.length("text").alias("length"), moved.alias("output"))
    # No text holds a marker, so each marker stands once and its place tells the lengths.
    at = {m: F.locate(m, F.col("output")) for m in (PREFIX, SUFFIX, MIDDLE)}
    gap = len(MIDDLE)
    prefix = F.when(F.col("form") == "psm", at[SUFFIX] - at[PREFIX] - gap).when(F.col("form") == "spm", at[MIDDLE] - at[PREFIX] - gap)
    middle = F.when(F.col("form") != "plain", F.length("output") - at[MIDDLE] - gap + 1)
    return done.select(*[F.col("row")[c].alias(c) for c in others], "n", "form", "output",
                       prefix.cast("long").alias("prefix_chars"), middle.cast("long").alias("middle_chars"))


def restored(output: str = "output", form: str = "form") -> Column:
    """The text from which ``fill_in_middle`` made an output of the given form."""
    part = "(.*)"
    psm = F.regexp_replace(output, rf"(?s)\A{PREFIX}{part}{SUFFIX}{part}{MIDDLE}{part}\z", "$1$3$2")
    spm = F.regexp_replace(output, rf"(?s)\A{SUFFIX}{part}{PREFIX}{part}{MIDDLE}{part}\z", "$2$3$1")
    return F.when(F.col(form) == "psm", psm).when(F.col(form) == "spm", spm).otherwise(F.col(output))

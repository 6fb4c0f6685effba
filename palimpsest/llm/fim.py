"""Fill-in-middle: a text is cut at two word borders and its parts are written in another order.

Units are words with the white space before them, and white space at the end of
the text.  ``regexp_count`` counts the n units; two hashes of the row's id choose
how many of them are prefix and middle.  A pattern made for the row, with the
possessive groups ``unit{a}`` and ``unit{b-a}``, matches the whole text once and
writes marks between its three parts.  Both alternatives of a unit are
possessive too and begin with different characters, so no match ever steps back
and time is linear in the text, without a stack that grows.

The form is ``plain`` (the text itself), ``psm`` (prefix, suffix, middle) or
``spm`` (suffix, prefix, middle), chosen by two more hashes.  A text that is
empty or holds a mark stays plain, so every mark in the output is one that was
written here and :func:`restored` gives back the exact text.

Null texts count as empty ones; a null id hashes as the empty text.  Rows with
equal ids are cut alike if their texts are equal.  Texts of any length that a
string holds are cut whole.  An empty table gives an empty result.  Columns of
the input that are named like added ones are replaced, all others pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from palimpsest.functions.expr import let

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: A unit; see above why each part is possessive.
UNIT = r"(?:[\x20\x09-\x0D]*+[^\x20\x09-\x0D]++|[\x20\x09-\x0D]++)"
SEED = 42
#: Percent of the texts that are cut, and of these the percent written as spm.
RATE, SPM_SHARE = 50, 80


def _hash_parts(id_col: str, seed: int) -> Column:
    """The first four groups of eight digits of the id's hash, as unsigned numbers."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")))
    return let(F.sha2(key.cast("binary"), 256), lambda h: F.array(
        *[F.conv(F.substring(h, 1 + 8 * i, 8), 16, 10).cast("bigint") for i in range(4)]))


def pattern(a: Column, b: Column) -> Column:
    """The row's pattern: ``a`` units, ``b - a`` units, the rest."""
    return F.concat(F.lit(rf"(?s)\A({UNIT}{{"), a.cast("string"), F.lit(rf"}}+)({UNIT}{{"), (b - a).cast("string"), F.lit(r"}+)(.*+)\z"))


def fill_in_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = SEED, rate: int = RATE,
                   spm_share: int = SPM_SHARE) -> DataFrame:
    """``docs`` with n, form, output and the prefix, middle and suffix of the texts that were cut (else null)."""
    added = ("n", "form", "output", "prefix", "middle", "suffix")
    kept = [F.col(f"`{c}`") for c in docs.columns if c.lower() not in added]
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    rows = docs.select(*kept, text.alias("_fim_text"), _hash_parts(id_col, seed).alias("_fim_h"),
                       F.regexp_count(text, F.lit(UNIT)).cast("bigint").alias("n"))
    t, h, n = F.col("_fim_text"), F.col("_fim_h"), F.col("n")
    marked = F.contains(t, F.lit(PREFIX)) | F.contains(t, F.lit(SUFFIX)) | F.contains(t, F.lit(MIDDLE))
    form = F.when((t == "") | marked | (h[2] % 100 >= rate), "plain").when(h[3] % 100 < spm_share, "spm").otherwise("psm")
    x, y = h[0] % (n + 1), h[1] % (n + 1)
    # One match cuts the text: a cut text holds no mark, so the marks written between its parts are the only ones.
    cut = F.when(F.col("form") != "plain", F.split(F.regexp_replace(
        t, pattern(F.least(x, y), F.greatest(x, y)), F.lit(f"$1{MIDDLE}$2{MIDDLE}$3")), MIDDLE, -1))
    names = [c for c in docs.columns if c.lower() not in added]
    own = [F.col(f"`{c}`") for c in names]
    rows = rows.withColumn("form", form).select(*own, "_fim_text", "n", "form", cut.alias("_fim_cut"))
    p, m, s = (F.col("_fim_cut")[i] for i in range(3))
    output = (F.when(F.col("form") == "psm", F.concat(F.lit(PREFIX), p, F.lit(SUFFIX), s, F.lit(MIDDLE), m))
              .when(F.col("form") == "spm", F.concat(F.lit(SUFFIX), s, F.lit(PREFIX), p, F.lit(MIDDLE), m)).otherwise(t))
    return rows.select(*own, "n", "form", output.alias("output"), p.alias("prefix"), m.alias("middle"), s.alias("suffix"))


def restored(output: Column, form: Column) -> Column:
    """The text that an output was made from."""
    def joined(parts):
        # psm: '', prefix, suffix, middle; spm: '', suffix, prefix, middle
        return F.when(form == "psm", F.concat(parts[1], parts[3], parts[2])).otherwise(F.concat(parts[2], parts[3], parts[1]))
    return F.when(form == "plain", output).otherwise(let(F.split(output, f"{PREFIX}|{SUFFIX}|{MIDDLE}", -1), joined))

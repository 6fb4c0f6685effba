"""Private terms from identity hints and folder names."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palimpsest import catalog
from palimpsest.functions.expr import any_of
from palimpsest.policy import Policy


def path_tokens(paths: DataFrame, col: str = "rel_path") -> DataFrame:
    """``term``: words of four and more letters or digits in the top folders of the paths."""
    folders = paths.where(F.contains(col, F.lit("/"))).select(F.substring_index(col, "/", 1).alias("folder")).distinct()
    words = folders.select(F.explode(F.split("folder", r"[^A-Za-z0-9]+")).alias("term"))
    return words.where(F.length("term") >= 4).distinct()


def _trimmed(terms: DataFrame) -> DataFrame:
    blank = F.regexp_replace("term", "^(?U)\\s+|(?U)\\s+$", "")
    return terms.select(F.trim(blank, F.lit("-_.")).alias("term"))


def keep_terms(terms: DataFrame, deny: list[str] = catalog.COMMON_WORDS) -> DataFrame:
    """Trimmed terms of three and more characters that are no everyday words."""
    low = F.lower("term")
    return _trimmed(terms).where((F.length("term") >= 3) & ~low.isin(*deny, "root")).distinct()


def expand_hints(hints: DataFrame) -> DataFrame:
    """``term`` candidates of ``identity_hints(kind, value)``.

    A full name gives itself, its parts and the parts run together; a mail
    address its local part, and its domain if that contains a known term of
    four and more characters; a host its first label; aliases with wildcards
    are left out.
    """
    value = F.col("value")
    def kind(*names):
        return hints.where(F.col("kind").isin(*names) & (F.length("value") > 0))
    parts = F.filter(F.split(value, r"[^A-Za-z0-9]+"), lambda p: F.length(p) >= 3)
    names = kind("full_name").select(value.alias("value"), parts.alias("parts"))
    known = keep_terms(
        kind("user", "home", "city").select(value.alias("term"))
        .unionByName(kind("host").select(F.substring_index("value", ".", 1).alias("term")))
        .unionByName(names.select(F.col("value").alias("term")))
        .unionByName(names.select(F.explode("parts").alias("term")))
        .unionByName(names.where(F.size("parts") >= 2).select(F.array_join("parts", "").alias("term")))
        .unionByName(kind("mail").select(F.substring_index("value", "@", 1).alias("term"))))
    domains = kind("mail").where(F.contains("value", F.lit("@"))).select(
        F.expr("substring(value, locate('@', value) + 1)").alias("domain"))
    # The identity of one machine: a handful of rows on either side.
    private = domains.join(F.broadcast(known), (F.length("term") >= 4) & F.contains(F.lower("domain"), F.lower("term")),
                           "left_semi").select(F.col("domain").alias("term"))
    aliases = kind("alias").where(~F.col("value").rlike(r"[*?]")).select(value.alias("term"))
    return known.unionByName(private).unionByName(aliases).distinct()


def derive_terms(paths: DataFrame, hints: DataFrame, extra: DataFrame | None = None) -> DataFrame:
    """``(term, n_chars)``: kept terms and user terms; order by ``n_chars desc, lower(term)``."""
    found = keep_terms(expand_hints(hints).unionByName(path_tokens(paths)))
    if extra is not None:
        found = found.unionByName(extra.select("term"))
    return found.distinct().select("term", F.length("term").alias("n_chars")).orderBy(
        F.desc("n_chars"), F.lower("term"), "term")


def embedded_terms(terms: DataFrame, policy: Policy) -> DataFrame:
    """Terms of four and more characters that contain, or lie in, the user's or home folder's name."""
    names = [n.lower() for n in (policy.user, policy.home_name) if n]
    low = F.lower("term")
    return terms.where((F.length("term") >= 4) & any_of(
        F.contains(low, F.lit(n)) | F.contains(F.lit(n), low) for n in names))

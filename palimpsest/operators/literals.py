"""Which literals of a file occur in which of its records.

A record can only hold a literal if one of its word runs (letters, digits,
``_``) holds the literal's *anchor*, its longest run.  So literals are looked
for among the distinct runs of a file, not in its records, and there by q-grams:
every anchor is posted under that of its q-grams which the fewest runs of the
file have, every run under all of its q-grams; pairs that meet are checked in full.
Then only records with a run that was found are joined, and checked in full again.
No large file costs the product of its records and literals; small ones, and literals of punctuation,
are searched directly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from palimpsest.operators.joins import is_small, maybe_in
from palimpsest.session import checkpointed

#: A run of word characters; possessive, it never gives one back.
RUN = r"[\p{L}\p{N}_]++"
#: Characters of an anchor that are looked for; any piece of a run is as necessary as the whole.
ANCHOR = 48
#: Lengths of q-grams, each for anchors of at least that length.
GRAMS = (3, 5, 8)
#: Longer runs are looked at in overlapping pieces.
PIECE = 1024
#: Literals per joined row.
CHUNK = 500
#: Files of so few literals, or of so few pairs of a record and a literal, are searched directly.
FEW, DIRECT_PAIRS = 32, 20_000_000
#: Buckets over which the records of one file are spread.
SALTS = 32
#: What a literal must look like to lie across the border of a placeholder.
_BRACKET = r"\[$|\[\p{Lu}|[\p{L}\p{N}_]\]|^\]"
#: What a literal inside a placeholder consists of.
_INNER = r"^[\p{L}\p{N}_:]+$"


def _pieces(run: Column) -> Column:
    """A run in pieces that share an anchor's length; mostly the run itself."""
    step = PIECE - ANCHOR
    last = F.greatest(F.ceil((F.length(run) - ANCHOR) / step) - 1, F.lit(0)).cast("int")
    return F.when(F.length(run) <= PIECE, F.array(run)).otherwise(
        F.transform(F.sequence(F.lit(0), last), lambda i: F.substring(run, i * step + 1, F.lit(PIECE))))


def runs(texts: Column) -> Column:
    """Distinct runs of a record's strings, long ones in pieces."""
    found = F.flatten(F.transform(texts, lambda t: F.coalesce(F.regexp_extract_all(t, F.lit(RUN), F.lit(0)), F.array().cast("array<string>"))))
    return F.array_distinct(F.flatten(F.transform(F.filter(F.array_distinct(found), lambda r: F.length(r) >= GRAMS[0]), _pieces)))


def _grams(text: Column, q: int) -> Column:
    return F.when(F.length(text) >= q, F.array_distinct(F.transform(
        F.sequence(F.lit(1), F.length(text) - (q - 1)), lambda i: F.substring(text, i, F.lit(q))))).otherwise(F.array().cast("array<string>"))


def anchored(literals: DataFrame) -> DataFrame:
    """Adds ``_anchor`` (null for literals without a run of three characters) and ``_q``."""
    longest = F.aggregate(F.regexp_extract_all("literal", F.lit(RUN), F.lit(0)), F.lit(""), lambda best, r: F.when(F.length(r) > F.length(best), r).otherwise(best))
    anchor = F.substring(longest, 1, ANCHOR)
    q = F.lit(None).cast("int")
    for n in GRAMS:
        q = F.when(F.length(anchor) >= n, F.lit(n)).otherwise(q)
    return literals.withColumn("_anchor", F.when(F.length(anchor) >= GRAMS[0], anchor)).withColumn("_q", q)


def anchor_pairs(vocabulary: DataFrame, literals: DataFrame, file: str) -> DataFrame:
    """``(file, run, no)``: runs of a file that hold the anchor of a literal; ``vocabulary`` has (file, run)."""
    posted = literals.where("_anchor IS NOT NULL").select(file, "no", "_anchor", "_q")
    lengths = sorted(r["_q"] for r in posted.select("_q").distinct().collect())         # at most three
    if not lengths:
        return vocabulary.select(file, "run", F.lit(0).cast("bigint").alias("no")).where("false")
    by_q = F.coalesce(*[F.when(F.col("_q") == q, _grams(F.col("_anchor"), q)) for q in lengths])
    wanted = checkpointed(posted.select(file, "no", "_anchor", F.explode(by_q).alias("gram"))
                          .withColumn("_key", F.xxhash64(file, "gram")))
    own = vocabulary.select(file, "run", F.explode(F.concat(*[_grams(F.col("run"), q) for q in lengths])).alias("gram"))
    # Grams that no literal has end here, before anything is shuffled.
    own = checkpointed(maybe_in(own.withColumn("_key", F.xxhash64(file, "gram")), wanted, "_key").drop("_key"))
    counts = own.join(wanted.select(file, "gram").distinct(), [file, "gram"]).groupBy(file, "gram").agg(F.count(F.lit(1)).alias("n_runs"))
    # A gram that no run has rules its literal out: every gram of the anchor must be counted.
    rarest = (wanted.join(counts, [file, "gram"], "left").groupBy(file, "no", "_anchor")
              .agg(F.min(F.struct(F.coalesce("n_runs", F.lit(0)).alias("n"), "gram")).alias("best"))
              .where("best.n > 0").select(file, "no", "_anchor", "best.gram"))
    return own.join(rarest, [file, "gram"]).where(F.contains("run", F.col("_anchor"))).select(file, "run", "no")


def candidates(records: DataFrame, ids: list[str], literals: DataFrame, texts: Column, file: str = "rel_path") -> DataFrame:
    """``(ids, no)``: records whose runs hold the anchor of a literal of their file."""
    slim = records.select(*[F.col(i).alias(f"_id{k}") for k, i in enumerate(ids)], F.col(file).alias(file), F.explode(runs(texts)).alias("run"))
    names = [f"_id{k}" for k in range(len(ids))]
    files = literals.select(file).distinct()
    if is_small(files):
        files = F.broadcast(files)
    slim = slim.join(files, file, "left_semi")
    pairs = checkpointed(anchor_pairs(slim.select(file, "run").distinct(), literals, file).withColumn("_key", F.xxhash64(file, "run")))
    near = maybe_in(slim.withColumn("_key", F.xxhash64(file, "run")), pairs, "_key").drop("_key")
    pairs = pairs.drop("_key")
    if is_small(pairs):
        found = near.join(F.broadcast(pairs), [file, "run"])
    else:
        # one run may be in every record of a file
        salt = F.pmod(F.xxhash64(*names), F.lit(SALTS))
        spread = pairs.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(SALTS - 1).cast("bigint"))))
        found = near.withColumn("_salt", salt).join(spread, [file, "run", "_salt"])
    return found.select(*[F.col(n).alias(i) for n, i in zip(names, ids)], "no").distinct()


def _loose(literals: DataFrame, file: str) -> DataFrame:
    """Literals that an earlier replacement may write: pieces of a placeholder, or such that lie across its border."""
    written = literals.select("placeholder").distinct()                                  # one per rule or category
    written = written.withColumnRenamed("placeholder", "_p")
    inner = literals.where(F.col("literal").rlike(_INNER)).join(
        F.broadcast(written) if is_small(written) else written, F.contains("_p", F.col("literal")), "left_semi")
    return inner.unionByName(literals.where(F.col("literal").rlike(_BRACKET))).distinct()


def literal_hits(records: DataFrame, ids: list[str], literals: DataFrame, texts: Column,
                 file: str = "rel_path") -> DataFrame:
    """``(ids, literals)``: per record the literals of its file that may apply.

    ``literals`` has ``file, no, literal, placeholder`` with unique numbers; ``texts`` is the array of a
    record's strings.  A record with a literal in it also gets those that the
    placeholders of others could write.

    Files of few literals, or of so few records that all pairs are less work than a join
    (:data:`DIRECT_PAIRS`), are searched directly; all others by q-grams.
    """
    entries = checkpointed(literals.select(file, F.col("no").cast("bigint").alias("no"), "literal", "placeholder"))
    loose = _loose(entries, file)
    # Of equal literals the first one leaves nothing to the others.
    firsts = entries.groupBy(file, "literal").agg(F.min(F.struct("no", "placeholder")).alias("f")).select(file, "f.no", "literal", "f.placeholder")
    sizes = firsts.groupBy(file).agg(F.count(F.lit(1)).alias("_n"))
    lines = records.groupBy(file).agg(F.count(F.lit(1)).alias("_lines"))
    ways = sizes.join(lines, file).select(file, ((F.col("_n") <= FEW) | (F.col("_n") * F.col("_lines") <= DIRECT_PAIRS)).alias("_few"))
    wanted = checkpointed(anchored(firsts.join(ways, file)).withColumn("_direct", F.col("_few") | F.col("_anchor").isNull()).drop("_few"))
    found = [_direct_hits(records, ids, wanted.where("_direct"), texts, file)]
    if not wanted.where("NOT _direct").isEmpty():
        found.append(joined_hits(records, ids, wanted.where("NOT _direct"), texts, file))
    hits = found[0] if len(found) == 1 else found[0].unionByName(found[1])
    firm = hits.groupBy(*ids).agg(F.flatten(F.collect_list("literals")).alias("literals"))
    if loose.isEmpty():
        return firm
    firm, loose = checkpointed(firm), checkpointed(loose)
    chunks = (loose.groupBy(file, (F.xxhash64("literal") % 64).alias("_part"), F.floor(F.col("no") / CHUNK).alias("_chunk"))
              .agg(F.collect_list(_entry()).alias("_more")).select(F.col(file).alias("_file"), "_more"))
    where = firm.join(records.select(*ids, F.col(file).alias("_file")), ids) if file not in ids else firm.withColumn("_file", F.col(file))
    if is_small(loose):
        more = where.select(*ids, "_file").join(F.broadcast(chunks), "_file")
    else:
        salted = chunks.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(SALTS - 1).cast("bigint"))))
        more = where.select(*ids, "_file", F.pmod(F.xxhash64(*ids), F.lit(SALTS)).alias("_salt")).join(salted, ["_file", "_salt"])
    more = more.groupBy(*ids).agg(F.flatten(F.collect_list("_more")).alias("_more"))
    return firm.join(more, ids, "left").select(*ids, F.when(F.col("_more").isNull(), F.col("literals")).otherwise(
        F.array_distinct(F.concat("literals", F.col("_more")))).alias("literals"))


def _entry() -> Column:
    """What is kept of a literal; the number comes first, it orders them."""
    return F.struct("no", "literal", "placeholder")


def joined_hits(records: DataFrame, ids: list[str], literals: DataFrame, texts: Column, file: str) -> DataFrame:
    """``(ids, literals)`` by way of the runs; candidates are checked in full where their text is."""
    near = candidates(records, ids, literals, texts, file)
    near = checkpointed(near.join(literals.select("no", "literal", "placeholder"), "no").withColumn("_key", F.xxhash64(*ids)))
    slim = maybe_in(records.withColumn("_key", F.xxhash64(*ids)), near, "_key").select(*ids, texts.alias("_texts"))
    return (near.drop("_key").join(slim, ids).where(F.exists("_texts", lambda t: F.contains(t, F.col("literal"))))
            .select(*ids, F.array(_entry()).alias("literals")))


def _direct_hits(records: DataFrame, ids: list[str], literals: DataFrame, texts: Column, file: str) -> DataFrame:
    """``(ids, literals)`` by searching a file's literals in its records, in chunks; a file's records are spread over salts."""
    chunks = (literals.groupBy(F.col(file).alias("_file"), (F.xxhash64("literal") % 64).alias("_part"), F.floor(F.col("no") / CHUNK).alias("_c"))
              .agg(F.collect_list(_entry()).alias("_chunk")).select("_file", "_chunk"))
    slim = records.select(*ids, F.col(file).alias("_file"), texts.alias("_texts"))
    if is_small(literals):
        joined = slim.join(F.broadcast(chunks), "_file")
    else:
        salted = chunks.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(SALTS - 1).cast("bigint"))))
        joined = slim.withColumn("_salt", F.pmod(F.xxhash64(*ids), F.lit(SALTS))).join(salted, ["_file", "_salt"])
    hit = F.filter("_chunk", lambda f: F.exists("_texts", lambda t: F.contains(t, f["literal"])))
    return joined.select(*ids, hit.alias("literals")).where(F.size("literals") > 0)


def replaced_in_order(text: Column, literals: Column) -> Column:
    """Replace literals (``array<struct<literal, placeholder, ..>>``) one after the other."""
    return F.aggregate(literals, text, lambda acc, f: F.replace(acc, f["literal"], f["placeholder"]))

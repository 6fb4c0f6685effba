"""One query per operator over its whole table, with SQL where SQL can express it."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from palimpsest.llm import (
    centroids, chat, exact_dedup, fim, fixity, hmm, minhash, mixing, pieces, placement, simhash, toxicity, vectors)
from palimpsest.llm.common import remainder, table
from palimpsest.session import materialized

QUERIES: dict = {}
ORACLE: dict = {}


def query(sql: str | None = None):
    def register(fn):
        QUERIES[fn.__name__] = fn
        if sql:
            ORACLE[fn.__name__] = sql
        return fn
    return register


_SPACES = r"[\x20\x09-\x0D]+"
_WORDS = r"[^\x20\x09-\x0D]+"


# --------------------------------------------------------------------------- 1 SentencePiece

#: Place of the vocabulary; a parameter, the file is not part of this repository.
MODEL = os.environ.get("PIECES_MODEL", "/opt/tokenizers/piece_bpe_32k.model")
SEGMENTATIONS = 4


@query()
def op1_nbest_pieces(spark: SparkSession, sf: str) -> DataFrame:
    vocabulary = pieces.load(MODEL)
    docs = table(spark, sf, "documents").select("doc_id", "text")
    rows = pieces.encode(docs, "text", vocabulary, SEGMENTATIONS)
    rows = rows.select("doc_id", "text", F.col("nbest")[0]["ids"].alias("ids"), F.xxhash64("nbest.ids").alias("ids_digest"),
                       F.col("nbest.score").alias("scores"))
    return pieces.decode(rows, "ids", vocabulary).select(
        "doc_id", F.size("ids").alias("n_pieces"), F.try_element_at("scores", F.lit(1)).alias("score"),
        F.size("scores").alias("n_segmentations"), F.try_element_at("scores", F.lit(-1)).alias("last_score"), "ids_digest",
        F.col("decoded").eqNullSafe(F.col("text")).alias("round_trip"))


# --------------------------------------------------------------------------- 2 chat formatting

#: Tools on offer: tool, parameter, type, required.
SCHEMAS = [("search", "query", "string", True), ("search", "limit", "integer", False),
           ("store", "value", "string", True), ("store", "key", "integer", True), ("store", "tags", "array", False)]


def tool_messages(conversations: DataFrame) -> DataFrame:
    """Messages with calls and results, from every turn and whole text of ``conversations``.

    Each assistant turn calls ``search`` with its text, then ``store``, which
    needs that search and the store of the assistant turn before; the user turn
    that follows answers them (a store only in every other one).
    """
    t = F.col("turn").cast("int")
    call = lambda kind, turn: F.concat(F.lit("c"), turn.cast("string"), F.lit(kind))
    limit = F.when(t % 6 == 3, F.lit('"many"')).otherwise(t.cast("string"))
    quoted = lambda c: F.regexp_extract(F.to_json(F.struct(F.coalesce(c.cast("string"), F.lit("")).alias("t"))), r'(?s)^\{"t":(.*)\}$', 1)
    text = F.col("text")
    search = F.concat(F.lit('{"id":"'), call("a", t), F.lit('","name":"search","arguments":{"query": '), quoted(text),
                      F.lit(', "limit":'), limit, F.lit("}}"))
    key = F.when(t % 4 == 1, F.concat(F.lit('"key":'), t.cast("string"), F.lit(","))).otherwise(F.lit(""))
    store = F.concat(F.lit('{"id":"'), call("b", t), F.lit('","name":"store","arguments":{'), key, F.lit('"value":'), quoted(F.col("role")),
                     F.lit('},"after":["'), call("b", t - 2), F.lit('","'), call("a", t), F.lit('"]}'))
    # the later call stands first, so the order in the text is not the order of needs
    assistant = F.concat(F.lit('{"content":null,"tool_calls":['), store, F.lit(","), search, F.lit("]}"))
    answer = lambda kind: F.concat(F.lit('{"tool_call_id":"'), call(kind, t - 1), F.lit('","content":'), quoted(text), F.lit("}"))
    answers = F.when((F.col("role") == "user") & (t > 0), F.when(t % 4 == 2, F.array(answer("a"), answer("b"))).otherwise(F.array(answer("a"))))
    plain = F.struct(F.col("role").alias("role"), F.when(F.col("role") == "assistant", assistant).otherwise(text).alias("text"))
    tools = F.transform(F.coalesce(answers, F.array().cast("array<string>")), lambda a: F.struct(F.lit("tool").alias("role"), a.alias("text")))
    return (conversations.select("conv_id", "turn", F.explode(F.concat(F.array(plain), tools)).alias("m"))
            .select("conv_id", "turn", "m.role", "m.text"))


@query("""
WITH a AS (SELECT conv_id, turn, coalesce(text, '') AS text, role, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS r
           FROM conversations WHERE role = 'assistant'),
chain AS (SELECT *, row_number() OVER (PARTITION BY conv_id, turn - 2 * r ORDER BY turn) AS steps FROM a),
u AS (SELECT conv_id, turn, coalesce(text, '') AS text FROM conversations WHERE role = 'user' AND turn > 0),
calls AS (
  SELECT conv_id, 'c' || turn || 'a' AS call_id, turn, CAST(1 AS BIGINT) AS place, CAST(0 AS BIGINT) AS level, 'search' AS name,
         CASE WHEN turn % 6 = 3 THEN 'type:limit' ELSE '' END AS errors,
         '{"limit":' || CASE WHEN turn % 6 = 3 THEN '"many"' ELSE CAST(turn AS VARCHAR) END || ',"query":' || CAST(to_json(text) AS VARCHAR) || '}' AS arguments,
         TRUE AS answered FROM chain
  UNION ALL
  SELECT conv_id, 'c' || turn || 'b', turn, 0, steps, 'store',
         concat_ws(',', CASE WHEN turn % 4 = 1 THEN NULL ELSE 'missing:key' END, CASE WHEN steps > 1 THEN NULL ELSE 'after:c' || (turn - 2) || 'b' END),
         '{' || CASE WHEN turn % 4 = 1 THEN '"key":' || turn || ',' ELSE '' END || '"value":' || CAST(to_json(role) AS VARCHAR) || '}',
         turn % 4 = 1 FROM chain),
answers AS (
  SELECT conv_id, 'c' || (turn - 1) || 'a' AS call_id, turn AS result_turn, text FROM u
  UNION ALL SELECT conv_id, 'c' || (turn - 1) || 'b', turn, text FROM u WHERE turn % 4 = 2)
SELECT coalesce(c.conv_id, r.conv_id) AS conv_id, coalesce(c.call_id, r.call_id) AS call_id, c.turn, c.place, c.level, c.name,
       CASE WHEN c.call_id IS NULL THEN 'orphan' WHEN r.call_id IS NULL THEN 'unanswered' ELSE 'linked' END AS status,
       coalesce(c.errors, '') AS errors, r.result_turn,
       '{"arguments":' || coalesce(c.arguments, 'null') || ',"id":"' || coalesce(c.call_id, r.call_id) || '","name":' ||
       coalesce('"' || c.name || '"', 'null') || ',"result":' || coalesce(CAST(to_json(r.text) AS VARCHAR), 'null') || '}' AS line
FROM calls c FULL JOIN answers r ON c.conv_id = r.conv_id AND c.call_id = r.call_id
""")
def op2_tool_call_linking(spark: SparkSession, sf: str) -> DataFrame:
    schemas = spark.createDataFrame(SCHEMAS, "tool string, parameter string, type string, required boolean")
    linked = chat.link(tool_messages(table(spark, sf, "conversations")), schemas)
    return linked.withColumn("errors", F.array_join("errors", ",")).withColumn("level", F.col("level").cast("bigint")).withColumn(
        "place", F.col("place").cast("bigint"))


# --------------------------------------------------------------------------- 3 toxicity

#: Scores from here on count as toxic.
TOXIC = 0.7


def toxicity_index(spark: SparkSession, docs: DataFrame, sf: str) -> toxicity.Index:
    """Learnt from the labels of two thirds of the ids; the rest is held out."""
    return toxicity.learn(docs, table(spark, sf, "labels"), remainder("doc_id", 3) != 1)


@query()
def op3_block_max_neighbours(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    scored = toxicity.scored(docs, toxicity_index(spark, docs, sf))
    return scored.select("doc_id", (remainder("doc_id", 3) == 1).alias("held_out"), "score",
                         (F.col("score") >= TOXIC).cast("int").alias("predicted"), F.size("labels").alias("n_neighbours"),
                         F.aggregate("labels", F.lit(0), lambda a, b: a + b).alias("n_toxic_neighbours"),
                         F.try_element_at("similarities", F.lit(1)).alias("nearest"))


# --------------------------------------------------------------------------- 4 exact dedup

@query(rf"""
WITH n AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '{_SPACES}', ' ', 'g')) AS text_sha256 FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = min(doc_id) OVER w AS kept, text_sha256
FROM n WINDOW w AS (PARTITION BY text_sha256)
""")
def op4_streaming_exact_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf, "documents")).select(
        "doc_id", "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256"))


# --------------------------------------------------------------------------- 5 language model

@query()
def op5_hidden_markov_scores(spark: SparkSession, sf: str) -> DataFrame:
    scored = hmm.language_model(table(spark, sf, "documents"), remainder("doc_id", 7) != 2)
    return scored.select("doc_id", (~F.col("train")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


# --------------------------------------------------------------------------- 6 WARC fixity

def damaged(records: DataFrame) -> DataFrame:
    """A replica with records of every kind of damage, and most of them intact."""
    i = F.col("page_id")
    rows = records.where(i % 97 != 5)                                             # lost
    rows = rows.withColumn("digest", F.when(i % 89 == 3, F.sha2(F.concat("digest", F.lit("!")).cast("binary"), 256)).otherwise(F.col("digest")))
    doubled = rows.where(i % 83 == 2)
    stray = rows.where(i % 79 == 1).withColumn("offset", F.col("offset") + (1 << 31))
    return rows.unionByName(doubled).unionByName(stray)


def _fixity_sql() -> str:
    line = "lpad(CAST(o AS VARCHAR), 19, '0') || ':' || length || ':' || digest"
    steps = [f"l0 AS (SELECT replica, archive, o // {fixity.RANGE} AS node, sha256(string_agg({line}, chr(10) ORDER BY {line})) AS hash FROM both_ GROUP BY ALL)"]
    for i in range(fixity.LEVELS):
        child = "lpad(CAST(node AS VARCHAR), 19, '0') || ':' || hash"
        steps.append(f"l{i + 1} AS (SELECT replica, archive, node // {fixity.FANOUT} AS up, sha256(string_agg({child}, chr(10) ORDER BY {child})) AS hash"
                     f" FROM (SELECT replica, archive, {'node' if i == 0 else 'up AS node'}, hash FROM l{i}) GROUP BY ALL)")
    top = fixity.RANGE * fixity.FANOUT ** fixity.LEVELS
    return f"""
WITH r AS (SELECT page_id // 1024 AS archive, page_id,
  'WARC/1.1' || chr(13) || chr(10) || 'WARC-Type: response' || chr(13) || chr(10) || 'WARC-Target-URI: ' || coalesce(url, '') || chr(13) || chr(10)
  || 'Content-Length: ' || strlen(coalesce(html, '')) || chr(13) || chr(10) || chr(13) || chr(10) || coalesce(html, '') || chr(13) || chr(10) || chr(13) || chr(10) AS record FROM pages),
p AS (SELECT archive, page_id, strlen(record) AS length, sha256(record) AS digest,
  CAST(coalesce(sum(strlen(record)) OVER (PARTITION BY archive ORDER BY page_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS o FROM r),
q AS (SELECT archive, page_id, length, CASE WHEN page_id % 89 = 3 THEN sha256(digest || '!') ELSE digest END AS digest, o FROM p WHERE page_id % 97 <> 5),
q3 AS (SELECT * FROM q UNION ALL SELECT * FROM q WHERE page_id % 83 = 2
       UNION ALL SELECT archive, page_id, length, digest, o + {1 << 31} FROM q WHERE page_id % 79 = 1),
both_ AS (SELECT 0 AS replica, * FROM p UNION ALL SELECT 1, * FROM q3),
{', '.join(steps)},
c AS (SELECT archive, o, coalesce(string_agg(length || ':' || digest, ',' ORDER BY length || ':' || digest) FILTER (replica = 0), '') AS a,
  coalesce(string_agg(length || ':' || digest, ',' ORDER BY length || ':' || digest) FILTER (replica = 1), '') AS b FROM both_ GROUP BY ALL)
SELECT c.archive, c.o AS "offset", c.o // {fixity.RANGE} AS range_no,
  CASE WHEN a = '' THEN 'extra' WHEN b = '' THEN 'missing' WHEN b = a || ',' || a THEN 'repeated' ELSE 'altered' END AS kind,
  a AS primary_record, b AS replica_record, x.hash AS primary_root, y.hash AS replica_root
FROM c LEFT JOIN l{fixity.LEVELS} x ON x.replica = 0 AND x.archive = c.archive AND x.up = c.o // {top}
LEFT JOIN l{fixity.LEVELS} y ON y.replica = 1 AND y.archive = c.archive AND y.up = c.o // {top}
WHERE a <> b
"""


@query(_fixity_sql())
def op6_merkle_fixity_audit(spark: SparkSession, sf: str) -> DataFrame:
    primary = fixity.lay_out(table(spark, sf, "pages"))
    return fixity.audit(primary, damaged(primary))


# --------------------------------------------------------------------------- 7 nearest neighbours

@query()
def op7_permutation_index(spark: SparkSession, sf: str) -> DataFrame:
    found = vectors.search(table(spark, sf, "embeddings"), F.col("id") % 20 == 0, 20)
    return found.withColumnRenamed("id", "vec_id")


# --------------------------------------------------------------------------- 8 near duplicates

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def near_sql(size: int, share: int, source: str = "documents") -> str:
    """All sets, all pairs that share a shingle, and what is reachable."""
    return rf"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{_WORDS}') AS w FROM {source}),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + {size - 1}], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, greatest(1, len(w) - {size - 1}) + 1)) AS i FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
c AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY 1, 2),
e AS (SELECT a, b FROM c JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * c >= {share} * (na.n + nb.n - c)),
r AS (SELECT doc_id AS a, doc_id AS b FROM w UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a),
m AS (SELECT a AS doc_id, min(b) AS component_id FROM r GROUP BY a)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, component_id, w.doc_id = component_id AS kept
FROM w LEFT JOIN n ON n.doc_id = w.doc_id JOIN m ON m.doc_id = w.doc_id
"""


@query(near_sql(2, 80))
def op8_signature_coordinate_join(spark: SparkSession, sf: str) -> DataFrame:
    found = minhash.near_duplicates(table(spark, sf, "documents"), size=2)
    return found.select("doc_id", "n_shingles", "component_id", (F.col("doc_id") == F.col("component_id")).alias("kept"))


# --------------------------------------------------------------------------- 9 mixing

def _mixing_sql() -> str:
    key = lambda *parts: "CAST('0x' || substr(md5(concat_ws('|', " + ", ".join(f"coalesce(CAST({p} AS VARCHAR), '')" for p in parts) + ")), 1, 15) AS BIGINT)"
    w = ", ".join(map(str, mixing.WEIGHTS))
    return rf"""
WITH d AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '{_WORDS}')) AS BIGINT) AS size, {key(mixing.SEED, 'doc_id', "md5(coalesce(text, ''))")} AS k FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
s1 AS (SELECT *, [{w}][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(mixing.WEIGHTS)} + 1] AS weight, source_size * {mixing.LIMIT} AS cap FROM s),
s2 AS (SELECT *, ((SELECT sum(source_size) FROM s) * CAST({mixing.RATIO} AS DOUBLE) - coalesce(sum(cap) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
   / sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS lvl,
   row_number() OVER (ORDER BY cap / weight, source NULLS LAST) AS p FROM s1),
f AS (SELECT min(p) AS fp, arg_min(lvl, p) AS fl FROM s2 WHERE cap > lvl * weight),
t AS (SELECT source, source_size, CASE WHEN fp IS NULL OR p < fp THEN CAST(cap AS DOUBLE) ELSE fl * weight END AS target,
   greatest(1, CAST(ceil(source_size / {mixing.BLOCK_WORDS}) AS BIGINT)) AS nb FROM s2, f),
r AS (SELECT d.*, t.source_size, t.target, k % nb AS block, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS passes
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
b AS (SELECT source, block, sum(size) AS words, any_value(target - passes * source_size) AS rest FROM r GROUP BY source, block),
b1 AS (SELECT *, sum(words) OVER (PARTITION BY source ORDER BY {key(mixing.SEED, "'block'", 'source', 'block')}, block) AS e FROM b),
u AS (SELECT source, k, sum(r.size) AS size FROM r GROUP BY source, block, k),
x AS (SELECT r.doc_id, r.size, r.source_size, r.target, r.passes, r.k, b1.e, b1.words, b1.rest,
        sum(r.size) OVER (PARTITION BY r.source, r.block ORDER BY r.k) AS de, sum(r.size) OVER (PARTITION BY r.source, r.block, r.k) AS ks
      FROM r JOIN b1 ON r.source IS NOT DISTINCT FROM b1.source AND r.block = b1.block)
SELECT doc_id, size, source_size, target,
  CAST(size * (passes + CASE WHEN e <= rest THEN 1 WHEN e - words < rest AND de - ks / 2 <= rest - (e - words) THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM x
"""


@query(_mixing_sql())
def op9_splitting_tree_mix(spark: SparkSession, sf: str) -> DataFrame:
    drawn = mixing.draws(table(spark, sf, "documents").select("doc_id", "text", "source"))
    rows = materialized(drawn.select("doc_id", "size", "source_size", "target", "shards", F.monotonically_increasing_id().alias("row")))
    # Words are counted over the copies in the shards of the mix.
    taken = mixing.dealt(rows, "row").groupBy("row").agg(F.sum("size").alias("taken"))
    return rows.join(taken, "row", "left").select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("bigint").alias("taken"))


# --------------------------------------------------------------------------- 10 sharding

#: 64 shards, every eighth of twice the weight.
SHARDS = {f"shard-{i:03d}": 2 if i % 8 == 0 else 1 for i in range(64)}


def op10_sql() -> str:
    owners = ",".join(f"'{s[6:]}'" for s in placement.fill(SHARDS))
    slot = f"CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT) % {placement.SLOTS}"
    return f"WITH t AS (SELECT [{owners}] AS o) SELECT doc_id, CAST({slot} AS INTEGER) AS slot, 'shard-' || o[{slot} + 1] AS shard FROM documents, t"


@query(op10_sql())
def op10_permutation_table_sharding(spark: SparkSession, sf: str) -> DataFrame:
    return placement.place(table(spark, sf, "documents").select("doc_id"), "doc_id", SHARDS)


# --------------------------------------------------------------------------- 11 fingerprints

@query()
def op11_covering_fingerprints(spark: SparkSession, sf: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf, "documents"))
    return found.select(F.col("id").alias("doc_id"), "fingerprint", "component_id")


# --------------------------------------------------------------------------- 12 clustering

def _cluster_sql() -> str:
    """All distances in every round; whole numbers below 2 ** 53, so doubles are exact."""
    inner = "list_inner_product"
    steps = [f"""
v AS (SELECT vec_id, list_transform(embedding, lambda x: floor({centroids.SCALE} * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE len(embedding) = {centroids.DIMS} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
c0 AS (SELECT row_number() OVER (ORDER BY h) - 1 AS c, v FROM (SELECT sha256('{centroids.SEED}:' || vec_id) AS h, v FROM v ORDER BY h LIMIT {centroids.K}))"""]
    for i in range(centroids.ROUNDS + 1):
        steps.append(f"""a{i} AS (SELECT vec_id, v.v AS v, min((CAST({inner}(v.v, v.v) - 2 * {inner}(v.v, k.v) + {inner}(k.v, k.v) AS BIGINT), k.c)) AS b
  FROM v, c{i} k GROUP BY ALL)""")
        if i < centroids.ROUNDS:
            steps.append(f"""s{i} AS (SELECT c, i, floor(sum(x) / count(*)) AS x FROM (SELECT b[2] AS c, unnest(range(1, {centroids.DIMS} + 1)) AS i, unnest(v) AS x FROM a{i}) GROUP BY c, i),
c{i + 1} AS (SELECT k.c, coalesce(m.v, k.v) AS v FROM c{i} k LEFT JOIN (SELECT c, list(x ORDER BY i) AS v FROM s{i} GROUP BY c) m ON m.c = k.c)""")
    last = centroids.ROUNDS
    return f"""WITH {', '.join(steps)}
SELECT vec_id, CAST(b[2] AS INTEGER) AS cluster, b[1] AS distance, CAST(sum(b[1]) OVER (PARTITION BY b[2]) AS BIGINT) AS cluster_inertia,
  CAST(sum(b[1]) OVER () AS BIGINT) AS inertia, sha256(array_to_string(list_transform(k.v, lambda x: CAST(CAST(x AS BIGINT) AS VARCHAR)), ',')) AS centroid_sha256
FROM a{last} JOIN c{last} k ON k.c = b[2]
"""


@query(_cluster_sql())
def op12_geometric_bounds_clustering(spark: SparkSession, sf: str) -> DataFrame:
    found = centroids.cluster(table(spark, sf, "embeddings"))
    return found.select(F.col("id").alias("vec_id"), "cluster", "distance", "cluster_inertia", "inertia",
                        centroids.centroid_digest(F.col("centroid")).alias("centroid_sha256"))


# --------------------------------------------------------------------------- 13 fill-in-middle

@query(rf"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS t, sha256('{fim.SEED}:' || doc_id) AS h FROM documents),
u AS (SELECT *, regexp_extract_all(t, '{_SPACES[:-1]}*{_WORDS}|{_SPACES}') AS u,
  [CAST('0x' || substr(h, 1 + 8 * CAST(i AS INTEGER), 8) AS BIGINT) FOR i IN range(4)] AS k FROM t),
f AS (SELECT *, len(u) AS n, CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR k[3] % 100 >= {fim.RATE} THEN 'plain'
  WHEN k[4] % 100 < {fim.SPM_SHARE} THEN 'spm' ELSE 'psm' END AS form FROM u),
g AS (SELECT *, least(k[1] % (n + 1), k[2] % (n + 1)) AS a, greatest(k[1] % (n + 1), k[2] % (n + 1)) AS b FROM f),
p AS (SELECT *, coalesce(array_to_string(u[1:a], ''), '') AS pre, coalesce(array_to_string(u[a + 1:b], ''), '') AS mid, coalesce(array_to_string(u[b + 1:], ''), '') AS suf FROM g)
SELECT doc_id, CAST(n AS BIGINT) AS n, form, CASE WHEN form <> 'plain' THEN CAST(length(pre) AS BIGINT) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN CAST(length(mid) AS BIGINT) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
  sha256(t) AS restored_sha256
FROM p
""")
def op13_counted_quantifier_infill(spark: SparkSession, sf: str) -> DataFrame:
    cut = fim.fill_in_middle(table(spark, sf, "documents").select("doc_id", "text"))
    digest = lambda c: F.sha2(c.cast("binary"), 256)
    return cut.select("doc_id", "n", "form", F.length("prefix").cast("bigint").alias("prefix_chars"),
                      F.length("middle").cast("bigint").alias("middle_chars"), digest(F.col("output")).alias("output_sha256"),
                      digest(fim.restored(F.col("output"), F.col("form"))).alias("restored_sha256"))

"""Every operator as a query over the given tables, with the same result in DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from palimpsest import catalog
from palimpsest.functions.expr import count_literal
from palimpsest.functions.fields import field_placeholder, is_sensitive_key, normalize_key, redact_field
from palimpsest.functions.redact import HITS_TYPE, digest, redacted_with_hits
from palimpsest.functions.urls import url_allowed, url_host
from palimpsest.operators import (
    frames, json_records, literals, pseudonyms, review, scan, secrets, spans, stats, tables, term_index, terms, text)
from palimpsest.operators.joins import ranked
from palimpsest.plans import sanitize as sanitize_plan
from palimpsest.policy import Policy
from palimpsest.session import dealt, materialized, new_folder, spread
from palimpsest.sources.logs import read_event_logs
from palimpsest.sources.tree import write_tree
from palimpsest.streaming import ordinals
from pyspark.sql import types as T
from workload.canaries import CANARIES, canary_text, planted_hits, planted_text
from workload.re2 import allowed_sql, chain, host_sql, placeholder_sql, quote, re2, weave_sql

POLICY = Policy("canuser", "/home/canuser", private_terms=("canuserlab",), private_domains=("corp.test",))
DOMAINS = ["example.com", "example.net"]
ALLOWING = Policy("canuser", "/home/canuser", allowed_domains=tuple(DOMAINS))

QUERIES: dict = {}
ORACLE: dict = {}


def query(sql: str | None = None):
    def register(fn):
        QUERIES[fn.__name__] = fn
        if sql:
            ORACLE[fn.__name__] = sql
        return fn
    return register


#: Tables whose rows are expensive to work on.
_TEXT_TABLES = {"documents", "pages", "conversations", "events", "orders", "customer"}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    df = spark.read.parquet(f"{sf}/{name}.parquet")
    return spread(df) if name in _TEXT_TABLES else df


def canaries(spark, sf, near_miss=False) -> DataFrame:
    return table(spark, sf, "events").select("event_id", F.expr(canary_text(near_miss)).alias("text"))


# --------------------------------------------------------------------------- text

@query(f"WITH {chain(POLICY, 'documents', 'doc_id', 'text')} SELECT doc_id, t AS text FROM red")
def redact_documents(spark, sf):
    return text.redact_text(table(spark, sf, "documents").select("doc_id", "text"), "text", POLICY)


@query(f"WITH {chain(POLICY, 'pages', 'page_id', 'url', name='u')},\n{chain(POLICY, 'pages', 'page_id', 'html', name='h')} "
       "SELECT u.page_id, u.t AS url, h.t AS html FROM u JOIN h ON u.page_id = h.page_id")
def redact_pages(spark, sf):
    pages = table(spark, sf, "pages").select("page_id", "url", "html")
    return text.redact_text(text.redact_text(pages, "url", POLICY), "html", POLICY)


@query(f"WITH {chain(POLICY, 'conversations', 'conv_id, turn', 'text')} SELECT conv_id, turn, t AS text FROM red")
def redact_conversations(spark, sf):
    return text.redact_text(table(spark, sf, "conversations").select("conv_id", "turn", "text"), "text", POLICY)


_CATEGORIES = [c for c, _, _ in catalog.REDACTION_RULES]


def _unpivot(source: str, keys: str, categories=None) -> str:
    return " UNION ALL ".join(
        f"SELECT {keys}, '{c}' AS category, CAST(n_{c} AS BIGINT) AS n FROM {source} WHERE n_{c} > 0"
        for c in categories or _CATEGORIES)


@query(f"WITH {chain(POLICY, 'documents', 'doc_id, source', 'text', counts=True)}, "
       f"hits AS ({_unpivot('red', 'doc_id, source')}) "
       "SELECT source, category, CAST(sum(n) AS BIGINT) AS n FROM hits GROUP BY ALL")
def detect_by_source(spark, sf):
    hits = text.detect(table(spark, sf, "documents"), ["source"], "text", POLICY)
    return hits.groupBy("source", "category").agg(F.sum("n").alias("n"))


@query(f"WITH {chain(POLICY, 'events', 'event_id', canary_text(), counts=True)}, "
       f"hits AS ({_unpivot('red', 'event_id')}) "
       "SELECT category, CAST(sum(n) AS BIGINT) AS n FROM hits GROUP BY ALL")
def category_counts(spark, sf):
    return text.category_counts(text.detect(canaries(spark, sf), ["event_id"], "text", POLICY))


@query(f"WITH {chain(POLICY, 'events', 'event_id', canary_text())} SELECT event_id, t AS text FROM red")
def canary_rules(spark, sf):
    return text.redact_text(canaries(spark, sf), "text", POLICY)


@query(f"WITH {chain(POLICY, 'events', 'event_id', canary_text(True))} SELECT event_id, t AS text FROM red")
def canary_near_misses(spark, sf):
    return text.redact_text(canaries(spark, sf, True), "text", POLICY)


def _matches_sql(sources, category):
    pattern = quote(re2(dict((c, p) for c, p, _ in catalog.REDACTION_RULES)[category]))
    return " UNION ALL ".join(
        f"SELECT '{name}' AS origin, id, CAST(i - 1 AS BIGINT) AS pos, v AS value FROM "
        f"(SELECT {key} AS id, unnest(regexp_extract_all({col}, {pattern})) AS v, "
        f"generate_subscripts(regexp_extract_all({col}, {pattern}), 1) AS i FROM {name})"
        for name, key, col in sources)


def _matches(spark, sf, sources, category):
    parts = [text.matches(table(spark, sf, name).select(F.lit(name).alias("origin"), F.col(key).alias("id"), col),
                          ["origin", "id"], col, POLICY, [category]).drop("category") for name, key, col in sources]
    return parts[0].unionByName(parts[1])


_TEXTS = [("documents", "doc_id", "text"), ("pages", "page_id", "html")]


@query(_matches_sql(_TEXTS, "email"))
def email_matches(spark, sf):
    return _matches(spark, sf, _TEXTS, "email")


@query(_matches_sql(_TEXTS, "ipv4"))
def ip_matches(spark, sf):
    return _matches(spark, sf, _TEXTS, "ipv4")


@query(f"WITH {chain(POLICY, 'documents', 'doc_id, text', 'text', name='one')},\n"
       f"{chain(POLICY, 'one', 'doc_id, t AS once', 't', name='two')} "
       "SELECT CAST(count(*) AS BIGINT) AS rows, CAST(count(*) FILTER (WHERE t <> once) AS BIGINT) AS changed FROM two")
def safety_repass(spark, sf):
    once = text.redact_text(table(spark, sf, "documents").select("doc_id", "text"), "text", POLICY)
    twice = text.redact_text(once, "text", POLICY, out="again")
    return twice.agg(F.count(F.lit(1)).alias("rows"), F.count(F.when(F.col("again") != F.col("text"), 1)).alias("changed"))


# A long list of terms: every long word of the benchmark items.
_LONG_WORD = "[A-Za-z0-9_]{9,}"
_TERM_LIST_SQL = (
    f"WITH terms AS (SELECT DISTINCT lower(unnest(regexp_extract_all(text, '{_LONG_WORD}'))) AS term FROM benchmark "
    "UNION SELECT unnest(['canuser', 'canuserlab'])), "
    "toks AS (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z0-9_]+|[^A-Za-z0-9_]')) AS tok, "
    "generate_subscripts(regexp_extract_all(text, '[A-Za-z0-9_]+|[^A-Za-z0-9_]'), 1) AS i FROM documents), "
    "new AS (SELECT doc_id, string_agg(CASE WHEN term IS NULL THEN tok ELSE '[PRIVATE_TERM]' END, '' ORDER BY i) AS t, count(term) AS n "
    "FROM toks LEFT JOIN terms ON term = lower(tok) GROUP BY doc_id) "
    "SELECT d.doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(t, '') END AS text, CAST(coalesce(n, 0) AS BIGINT) AS n_terms "
    "FROM documents d LEFT JOIN new ON new.doc_id = d.doc_id")


def _term_list(spark, sf):
    return table(spark, sf, "benchmark").select(F.explode(F.regexp_extract_all("text", F.lit(_LONG_WORD), F.lit(0))).alias("term")).distinct()


@query(_TERM_LIST_SQL)
def index_term_list(spark, sf):
    index = term_index.term_index(_term_list(spark, sf), POLICY)
    docs = table(spark, sf, "documents").select("doc_id", "text")
    found = docs.withColumn("found", term_index.replace_terms(F.array("text"), index))
    return found.select("doc_id", F.col("found")[0]["text"].alias("text"), F.col("found")[0]["n"].alias("n_terms"))


@query(_TERM_LIST_SQL)
def join_term_list(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return term_index.redact_terms_joined(docs, ["doc_id"], "text", _term_list(spark, sf), POLICY)


# --------------------------------------------------------------------------- urls and paths

@query(f"SELECT page_id, {host_sql('url')} AS host, {allowed_sql('url', DOMAINS)} AS allowed FROM pages")
def url_allowlist(spark, sf):
    return table(spark, sf, "pages").select("page_id", url_host(F.col("url")).alias("host"),
                                            url_allowed(F.col("url"), DOMAINS).alias("allowed"))


@query(f"WITH {chain(ALLOWING, 'pages', 'page_id', 'url', allowed=DOMAINS)} SELECT page_id, t AS url FROM red")
def redact_urls(spark, sf):
    return text.redact_text(table(spark, sf, "pages").select("page_id", "url"), "url", ALLOWING)


_PATH = ("concat('--home-u', cast(page_id as string), '-x--/canuser@box/', "
         "regexp_extract(url, '^https?://([^/]+/?[^?#]*)', 1), '/a\\\\b.jsonl')")
_PATH_SQL = ("concat('--home-u', cast(page_id as string), '-x--/canuser@box/', "
             "regexp_extract(url, '^https?://([^/]+/?[^?#]*)', 1), '/a\\b.jsonl')")


@query(f"WITH parts AS (SELECT page_id, unnest(string_split({_PATH_SQL}, '/')) AS part, "
       f"generate_subscripts(string_split({_PATH_SQL}, '/'), 1) AS i FROM pages), "
       f"{chain(POLICY, 'parts', 'page_id, i', 'part')} "
       "SELECT page_id, string_agg(replace(replace(t, '/', '_'), '\\', '_'), '/' ORDER BY i) AS path FROM red GROUP BY page_id")
def redact_paths(spark, sf):
    return text.redact_path(table(spark, sf, "pages").select("page_id", F.expr(_PATH).alias("path")), "path", POLICY)


# --------------------------------------------------------------------------- pseudonyms

@query(f"WITH h AS (SELECT page_id, {host_sql('url')} AS host FROM pages), "
       "f AS (SELECT host, min(page_id) AS first, count(*) AS n FROM h GROUP BY host) "
       "SELECT host, row_number() OVER (ORDER BY first) AS ordinal, substr(sha256(host), 1, 10) AS digest, "
       "CAST(n AS BIGINT) AS n FROM f")
def pseudonymize_hosts(spark, sf):
    hosts = table(spark, sf, "pages").select(F.lit("host").alias("category"), url_host(F.col("url")).alias("value"), "page_id")
    return pseudonyms.assign_ordinals(hosts, ["page_id"], keep_values=True).select(
        F.col("value").alias("host"), "ordinal", "digest", "n")


_STABLE = [c for c, _, r in catalog.REDACTION_RULES if r is None]
_FOUND = (r"unnest(regexp_extract_all(t, '\[[A-Z_]+:0000:[0-9a-f]{10}\]')) AS token, "
          r"generate_subscripts(regexp_extract_all(t, '\[[A-Z_]+:0000:[0-9a-f]{10}\]'), 1) AS i")
_DICTIONARY = (
    f"{chain(POLICY, 'events', 'event_id', canary_text())}, "
    f"toks AS (SELECT event_id, {_FOUND} FROM red), "
    "firsts AS (SELECT token, min((event_id, i)) AS first, count(*) AS n FROM toks GROUP BY token), "
    "dict AS (SELECT token, lower(regexp_extract(token, '^.([A-Z_]+)', 1)) AS category, "
    "regexp_extract(token, '([0-9a-f]{10})', 1) AS digest, CAST(n AS BIGINT) AS n, "
    "row_number() OVER (PARTITION BY regexp_extract(token, '^.([A-Z_]+)', 1) ORDER BY first) AS ordinal FROM firsts)")


def _canary_pass(spark, sf):
    """Redacted canaries with their hits, worked out once."""
    return materialized(text.redact_text(canaries(spark, sf), "text", POLICY, hits="hits"))


def _canary_dictionary(local):
    values = pseudonyms.stable_values(local, ["event_id"])
    return pseudonyms.assign_ordinals(values, ["event_id", "hit_no", "match_no"])


@query(f"WITH {_DICTIONARY} SELECT category, digest, ordinal, n FROM dict")
def assign_ordinals(spark, sf):
    return _canary_dictionary(_canary_pass(spark, sf)).select("category", "digest", "ordinal", "n")


@query(f"WITH {_DICTIONARY} SELECT category, digest, ordinal FROM dict")
def stream_ordinals(spark, sf):
    """Two runs of one stream, the second over what came later: the numbers are those of the whole."""
    source, folder = materialized(canaries(spark, sf)), new_folder(spark, "stream")
    middle = source.agg(F.avg("event_id")).first()[0] or 0
    for rows in (source.where(F.col("event_id") <= middle), source.where(F.col("event_id") > middle)):
        rows.write.mode("append").parquet(f"{folder}/in")
        stream = spark.readStream.schema(source.schema).parquet(f"{folder}/in")
        ordinals.number_stream(stream, "text", POLICY, ["event_id"], folder).awaitTermination()
    return ordinals.dictionary(spark, folder).select("category", "digest", "ordinal")


@query(f"WITH {_DICTIONARY} SELECT category, CAST(count(*) AS BIGINT) AS n FROM dict GROUP BY category")
def distinct_counts(spark, sf):
    return pseudonyms.distinct_counts(_canary_dictionary(_canary_pass(spark, sf)))


@query(f"WITH {_DICTIONARY}, "
       "named AS (SELECT event_id, any_value(token) AS token FROM toks GROUP BY event_id) "
       "SELECT r.event_id, CASE WHEN d.token IS NULL THEN r.t ELSE replace(r.t, d.token, "
       "replace(d.token, ':0000:', ':' || CASE WHEN d.ordinal < 10000 THEN lpad(CAST(d.ordinal AS VARCHAR), 4, '0') "
       "ELSE CAST(d.ordinal AS VARCHAR) END || ':')) END AS text "
       "FROM red r LEFT JOIN named k ON r.event_id = k.event_id LEFT JOIN dict d ON d.token = k.token")
def number_placeholders(spark, sf):
    local = _canary_pass(spark, sf)
    return pseudonyms.number_placeholders(local.drop("hits"), ["event_id"], "text", _canary_dictionary(local))


@query("SELECT c_custkey, substr(sha256(c_name), 1, 10) AS plain, substr(sha256('pepper' || c_name), 1, 10) AS salted FROM customer")
def digest_customers(spark, sf):
    return table(spark, sf, "customer").select(
        "c_custkey", digest(F.col("c_name")).alias("plain"), digest(F.col("c_name"), "pepper").alias("salted"))


# --------------------------------------------------------------------------- fields and frames

_KEYS = ["apiKey", "X-API-Key", "refresh_token", "Set-Cookie", "encryptedContent", "thinkingSignature", "share_url",
         "client_secret", "Encrypted_Content", "shareUrl", "token", "signature", "tokens", "max_tokens", "access_token",
         "cookies", "share", "name", "__private.key__", "user"]
_KEY = "element_at(array({}), cast(event_id % {} as int) + 1)".format(", ".join(f"'{k}'" for k in _KEYS), len(_KEYS))
_KEY_SQL = "([{}])[event_id % {} + 1]".format(", ".join(f"'{k}'" for k in _KEYS), len(_KEYS))
_NORMAL = "trim(regexp_replace(lower({k}), '[^a-z0-9]+', '_', 'g'), '_')"


def _sensitive_sql(k: str) -> str:
    n = _NORMAL.format(k=k)
    c = f"replace({n}, '_', '')"
    exact = ", ".join(quote(x) for x in catalog.SENSITIVE_KEYS)
    parts = " OR ".join(f"contains({n}, '{x}') OR contains({c}, '{x}')" for x in catalog.SENSITIVE_KEY_FRAGMENTS)
    return f"({n} IN ({exact}) OR {c} IN ({exact}) OR {parts})"


_PLACEHOLDER_SQL = ("CASE WHEN regexp_matches({k}, '(?i)encrypted|signature') THEN '[REDACTED:OPAQUE_PROVIDER_BLOB]' "
                    "WHEN regexp_matches({k}, '(?i)share') THEN '[REDACTED:SHARE_METADATA]' ELSE '[REDACTED:SENSITIVE_FIELD]' END")


@query(f"WITH k AS (SELECT event_id, {_KEY_SQL} AS key FROM events) SELECT event_id, key, {_NORMAL.format(k='key')} AS normalized, "
       f"{_sensitive_sql('key')} AS sensitive FROM k")
def sensitive_keys(spark, sf):
    keys = table(spark, sf, "events").select("event_id", F.expr(_KEY).alias("key"))
    return keys.select("event_id", "key", normalize_key(F.col("key")).alias("normalized"),
                       is_sensitive_key(F.col("key")).alias("sensitive"))


@query(f"WITH k AS (SELECT event_id, value, {_KEY_SQL} AS key, {canary_text()} AS v FROM events), "
       f"{chain(POLICY, 'k', 'event_id, key, value', 'v')} "
       f"SELECT event_id, key, CASE WHEN {_sensitive_sql('key')} THEN {_PLACEHOLDER_SQL.format(k='key')} ELSE t END AS text, "
       f"value AS number, NOT {_sensitive_sql('key')} AS kept_list FROM red")
def redact_fields(spark, sf):
    rows = table(spark, sf, "events").select("event_id", "value", F.expr(_KEY).alias("key"), F.expr(canary_text()).alias("v"))
    key = F.col("key")
    return rows.select(
        "event_id", "key",
        redact_field(key, F.col("v"), T.StringType(), lambda v: redacted_with_hits(v, POLICY)["text"]).alias("text"),
        redact_field(key, F.col("value"), T.DoubleType(), lambda v: v).alias("number"),
        redact_field(key, F.array("v"), T.ArrayType(T.StringType()), lambda v: v).isNotNull().alias("kept_list"))


@query(f"WITH k AS (SELECT {_KEY_SQL} AS key FROM events), s AS (SELECT key FROM k WHERE {_sensitive_sql('key')}) "
       f"SELECT {_NORMAL.format(k='key')} AS key, CAST(count(*) AS BIGINT) AS n FROM s GROUP BY 1")
def field_counts(spark, sf):
    return stats.field_counts(table(spark, sf, "events").select(F.expr(_KEY).alias("key")))


_MAIL = "concat('m', cast(c_custkey as string), '@example.org')"
_ADDRESS = "concat('10.0.', cast(c_custkey % 200 as string), '.', cast(o_orderkey % 250 as string))"


def _nested(spark, sf):
    orders, customer = (spark.read.parquet(f"{sf}/{name}.parquet") for name in ("orders", "customer"))
    # Dealt after the join: its own exchange knows bytes only, and short rows would end up in a few tasks.
    joined = dealt(orders.join(customer, F.col("o_custkey") == F.col("c_custkey")), orders.count())
    return joined.select(
        "o_orderkey", F.col("o_totalprice").alias("secret"), F.expr(_MAIL).alias("shareUrl"),
        F.struct(F.expr(_MAIL).alias("mail"), F.expr(_ADDRESS).alias("access_key"), F.col("c_acctbal").alias("token")).alias("customer"),
        F.array(F.expr(_ADDRESS), F.col("o_orderpriority")).alias("notes"),
        F.array("c_mktsegment").alias("passwords"),
        F.create_map(F.expr(_MAIL), F.lit("a"), F.expr(_ADDRESS), F.col("c_mktsegment"),
                     F.replace(F.expr(_ADDRESS), F.lit("10.0."), F.lit("10.1.")), F.expr(_MAIL), F.lit("api-key"), F.lit("x")).alias("extra"))


_MAILED = f"{placeholder_sql('EMAIL', _MAIL)}"


@query(f"WITH j AS (SELECT * FROM orders JOIN customer ON o_custkey = c_custkey) "
       f"SELECT o_orderkey, o_totalprice AS secret, '[REDACTED:SHARE_METADATA]' AS share_url, {_MAILED} AS mail, "
       f"'[REDACTED:SENSITIVE_FIELD]' AS access_key, c_acctbal AS token, '[PII:IP_ADDRESS]|' || o_orderpriority AS notes, "
       f"'[REDACTED:SENSITIVE_FIELD]' AS passwords, CAST(3 AS BIGINT) AS n_extra, "
       f"{_MAILED} AS by_address, '[REDACTED:SENSITIVE_FIELD]' AS by_key, 'a' AS by_mail FROM j")
def redact_frame(spark, sf):
    r = frames.redact_frame(_nested(spark, sf), POLICY)
    return r.select("o_orderkey", "secret", F.col("shareUrl").alias("share_url"), "customer.mail", "customer.access_key", "customer.token",
                    F.array_join("notes", "|").alias("notes"), "passwords", F.size("extra").cast("bigint").alias("n_extra"),
                    F.col("extra")["[PII:IP_ADDRESS]"].alias("by_address"), F.col("extra")["api-key"].alias("by_key"),
                    F.element_at(F.map_values(F.map_filter("extra", lambda k, v: F.startswith(k, F.lit("[EMAIL:")))), 1).alias("by_mail"))


def _exported(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", F.expr(_MAIL).alias("title"), F.col("c_name").alias("share_url"), F.col("c_mktsegment").alias("part"))
    o = table(spark, sf, "orders").select("o_orderkey", F.concat(F.lit("/home/canuser/"), "o_orderpriority").alias("directory"))
    return {"session": c, "message": o, "credential": c, "unknown": o}


@query(f"SELECT 'session' AS table_name, '{{\"c_custkey\":' || c_custkey || ',\"title\":\"' || {_MAILED} || '\",\"share_url\":\"[REDACTED:SHARE_METADATA]\",\"part\":\"' || c_mktsegment || '\"}}' AS json FROM customer "
       "UNION ALL SELECT 'message', '{\"o_orderkey\":' || o_orderkey || ',\"directory\":\"/home/[PRIVATE_TERM]/' || o_orderpriority || '\"}' FROM orders")
def export_tables(spark, sf):
    return tables.export_tables(_exported(spark, sf), POLICY)


@query("WITH available AS (SELECT 'session' AS t UNION SELECT 'message' UNION SELECT 'credential' UNION SELECT 'unknown'), "
       "n AS (SELECT 'session' AS t, (SELECT count(*) FROM customer) AS rows UNION ALL SELECT 'message', (SELECT count(*) FROM orders)) "
       "SELECT t AS table_name, CAST(rows AS BIGINT) AS rows, false AS skipped FROM n UNION ALL "
       f"SELECT a.t, 0, true FROM (SELECT unnest([{', '.join(quote(t) for t in catalog.TRACE_TABLES)}]) AS t) a WHERE a.t NOT IN (SELECT t FROM available)")
def table_stats(spark, sf):
    exported = _exported(spark, sf)
    available = spark.createDataFrame([(t,) for t in exported], "table_name string")
    keep, skipped = tables.apply_table_policy(available, tables.table_policy(spark, POLICY))
    done = tables.export_tables(exported, POLICY).join(F.broadcast(keep), "table_name", "left_semi")
    return stats.table_stats(done, skipped)


# --------------------------------------------------------------------------- JSON records

_BROKEN = ("case event_id % 5 when 0 then substr(props, 1, length(props) - 1) when 1 then '' when 2 then '  ' else props end")


def _records(spark, sf):
    return table(spark, sf, "events").select(
        F.col("event_type").alias("source"), F.concat("event_type", F.lit("/"), (F.col("user_id") % 50).cast("string"), F.lit(".jsonl")).alias("rel_path"),
        F.col("event_id").alias("line_no"), F.expr(_BROKEN).alias("raw"))


_RECORDS_SQL = (f"SELECT event_type AS source, event_type || '/' || CAST(user_id % 50 AS VARCHAR) || '.jsonl' AS rel_path, "
                f"event_id AS line_no, {_BROKEN} AS raw FROM events")


_TRAILING = ("case event_id % 6 when 0 then concat(props, ' x') when 1 then '[1] /home/a' when 2 then '12 y' when 3 then '1,2' "
             "when 4 then concat('[', props, ']] z') else props end")


@query(f"SELECT event_id, json_valid(raw) AS is_valid FROM (SELECT event_id, {_TRAILING} AS raw FROM events)")
def trailing_text(spark, sf):
    """Lines with text behind a complete value are malformed."""
    rows = table(spark, sf, "events").select("event_id", F.expr(_TRAILING).alias("raw"))
    return json_records.split_malformed(rows).select("event_id", "is_valid")


@query(f"WITH r AS ({_RECORDS_SQL}) SELECT line_no, trim(raw) = '' AS is_blank, trim(raw) <> '' AND json_valid(raw) AS is_valid FROM r")
def malformed_rows(spark, sf):
    return json_records.split_malformed(_records(spark, sf)).select("line_no", "is_blank", "is_valid")


@query(f"WITH r AS ({_RECORDS_SQL}) SELECT source, CAST(count(DISTINCT rel_path) AS BIGINT) AS files, CAST(count(*) AS BIGINT) AS lines, "
       "CAST(count(*) FILTER (WHERE trim(raw) <> '' AND NOT json_valid(raw)) AS BIGINT) AS invalid_lines FROM r GROUP BY source")
def source_stats(spark, sf):
    return stats.source_stats(json_records.split_malformed(_records(spark, sf)))


def _json_expr(text_expr: str) -> str:
    """SQL: a nested record around a text that needs no JSON escapes."""
    return ("concat('{\"type\": \"', event_type, '\", \"n\": 1.50, \"share_url\": \"x\", \"apiKey\": {\"a\": [1, \"b\"]}, "
            "\"token\": null, \"items\": [\"', " + text_expr + ", '\", true, {\"k\": ', props, '}]}')")


_PLAIN_CANARY = canary_text().replace("chr(10)", "' '").replace("'\"api_key\": \"abc\"'", "'api'").replace("'MY_TOKEN = \"', repeat('v', 10), '\"'", "'MY_TOKEN = ', repeat('v', 10)")


def _json_rows(spark, sf):
    return table(spark, sf, "events").select("event_id", F.expr(_json_expr(_PLAIN_CANARY)).alias("raw"))


@query(f"WITH {chain(POLICY, 'events', 'event_id, event_type, props', _PLAIN_CANARY)} "
       "SELECT event_id, '{\"type\":\"' || event_type || '\",\"n\":1.50,\"share_url\":\"[REDACTED:SHARE_METADATA]\",\"apiKey\":\"[REDACTED:SENSITIVE_FIELD]\","
       "\"token\":null,\"items\":[\"' || t || '\",true,{\"k\":' || replace(props, ' ', '') || '}]}' AS raw FROM red")
def redact_json(spark, sf):
    return json_records.redact_json(_json_rows(spark, sf), "raw", POLICY)


@query(f"WITH j AS (SELECT event_id, {_json_expr(_PLAIN_CANARY)} AS raw FROM events), "
       "l AS (SELECT event_id, x.fullkey AS path, x.key AS key, x.atom AS atom, x.type AS type, x.id AS id FROM j, json_tree(j.raw) x) "
       "SELECT event_id, CAST(row_number() OVER (PARTITION BY event_id ORDER BY id) - 1 AS INTEGER) AS leaf_no, path, atom->>'$' AS value "
       "FROM l WHERE type = 'VARCHAR'")
def json_leaves(spark, sf):
    return json_records.json_leaves(_json_rows(spark, sf), ["event_id"], "raw").drop("key")


_DUPLICATES = "SELECT text AS old, 'copy of ' || substr(sha256(text), 1, 10) AS new FROM documents GROUP BY text HAVING count(*) > 1"


@query(f"WITH m AS ({_DUPLICATES}) SELECT doc_id, coalesce(m.new, substr(sha256(d.text), 1, 10)) AS new_value, m.new IS NOT NULL AS changed "
       "FROM documents d LEFT JOIN m ON d.text = m.old")
def apply_mapping(spark, sf):
    documents = table(spark, sf, "documents").select("doc_id", "text")
    mapping = (documents.groupBy("text").count().where("count > 1")
               .select(F.col("text").alias("old"), F.concat(F.lit("copy of "), digest(F.col("text"))).alias("new")))
    done = json_records.apply_mapping(documents, mapping, "text")
    return done.select("doc_id", F.when(F.col("changed"), F.col("new_value")).otherwise(digest(F.col("text"))).alias("new_value"), "changed")


@query(f"WITH {chain(POLICY, 'events', 'event_id', _PLAIN_CANARY, counts=True)}, hits AS ({_unpivot('red', 'event_id')}) "
       "SELECT category, CAST(sum(n) AS BIGINT) AS n FROM hits GROUP BY ALL UNION ALL "
       "SELECT unnest(['sensitive_field_share_url', 'sensitive_field_apikey', 'sensitive_field_token']), (SELECT count(*) FROM events)")
def json_hits(spark, sf):
    found = json_records.redact_json(_json_rows(spark, sf), "raw", POLICY, hits="hits")
    # Outer: before an inner explode the optimizer filters by the hits, which works them out twice.
    return found.select(F.explode_outer("hits").alias("h")).where("h is not null").groupBy(F.col("h.category").alias("category")).agg(F.sum("h.n").alias("n"))


# --------------------------------------------------------------------------- terms

_HINTS_SQL = ("SELECT 'full_name' AS kind, c_mktsegment || ' ' || replace(c_name, '#', ' ') AS value FROM customer UNION "
              "SELECT 'mail', 'box.' || lower(c_mktsegment) || '@' || lower(c_mktsegment) || '.example' FROM customer UNION "
              "SELECT 'host', n_name || '.lan' FROM nation JOIN customer ON n_nationkey = c_nationkey UNION "
              "SELECT 'alias', '*' || c_mktsegment FROM customer")
_DENIED = ", ".join(quote(w) for w in [*catalog.COMMON_WORDS, "root"])
_TERMS_SQL = f"""
WITH hints AS ({_HINTS_SQL}),
names AS (SELECT value, list_filter(string_split_regex(value, '[^A-Za-z0-9]+'), lambda p: length(p) >= 3) AS parts FROM hints WHERE kind = 'full_name'),
raw AS (SELECT split_part(value, '.', 1) AS term FROM hints WHERE kind = 'host' UNION SELECT value FROM names
  UNION SELECT unnest(parts) FROM names UNION SELECT array_to_string(parts, '') FROM names WHERE len(parts) >= 2
  UNION SELECT split_part(value, '@', 1) FROM hints WHERE kind = 'mail'),
known AS (SELECT DISTINCT trim(trim(term), '-_.') AS term FROM raw WHERE length(trim(trim(term), '-_.')) >= 3 AND lower(trim(trim(term), '-_.')) NOT IN ({_DENIED})),
domains AS (SELECT DISTINCT split_part(value, '@', 2) AS term FROM hints WHERE kind = 'mail'),
private AS (SELECT term FROM domains d WHERE EXISTS (SELECT 1 FROM known k WHERE length(k.term) >= 4 AND contains(lower(d.term), lower(k.term)))),
folders AS (SELECT DISTINCT split_part(regexp_replace(url, '^https?://', ''), '/', 1) AS folder FROM pages WHERE contains(regexp_replace(url, '^https?://', ''), '/')),
tokens AS (SELECT t AS term FROM (SELECT unnest(string_split_regex(folder, '[^A-Za-z0-9]+')) AS t FROM folders) WHERE length(t) >= 4),
total AS (SELECT term FROM known UNION SELECT term FROM private UNION SELECT term FROM tokens)
SELECT DISTINCT term, CAST(length(term) AS INTEGER) AS n_chars FROM total WHERE length(term) >= 3 AND lower(term) NOT IN ({_DENIED})"""


def _terms(spark, sf):
    customer, nation = table(spark, sf, "customer"), table(spark, sf, "nation")
    segment = F.col("c_mktsegment")
    hints = (customer.select(F.lit("full_name").alias("kind"), F.concat(segment, F.lit(" "), F.replace("c_name", F.lit("#"), F.lit(" "))).alias("value"))
             .unionByName(customer.select(F.lit("mail").alias("kind"), F.concat(F.lit("box."), F.lower(segment), F.lit("@"), F.lower(segment), F.lit(".example")).alias("value")))
             .unionByName(nation.join(customer, F.col("n_nationkey") == F.col("c_nationkey")).select(F.lit("host").alias("kind"), F.concat("n_name", F.lit(".lan")).alias("value")))
             .unionByName(customer.select(F.lit("alias").alias("kind"), F.concat(F.lit("*"), segment).alias("value")))
             .distinct())
    paths = table(spark, sf, "pages").select(F.regexp_replace("url", "^https?://", "").alias("rel_path"))
    return terms.derive_terms(paths, hints)


@query(_TERMS_SQL)
def derive_terms(spark, sf):
    return _terms(spark, sf)


_IDENTITY = Policy("example", "/home/build")


@query(f"WITH all_terms AS ({_TERMS_SQL}) SELECT term FROM all_terms WHERE length(term) >= 4 AND "
       "(contains(lower(term), 'example') OR contains('example', lower(term)) OR contains(lower(term), 'build') OR contains('build', lower(term)))")
def embedded_terms(spark, sf):
    return terms.embedded_terms(_terms(spark, sf), _IDENTITY).select("term")


# --------------------------------------------------------------------------- spans

_CUE = re2(catalog.CUE_PATTERN)


@query(f"SELECT 'documents' AS origin, doc_id AS id FROM documents WHERE length(text) > 0 AND regexp_matches(text, {quote(_CUE)}) "
       f"UNION ALL SELECT 'conversations', conv_id * 1000 + turn FROM conversations WHERE length(text) > 0 AND regexp_matches(text, {quote(_CUE)}) "
       f"UNION ALL SELECT 'events', event_id FROM events WHERE regexp_matches({canary_text()}, {quote(_CUE)})")
def cue_candidates(spark, sf):
    d = spans.select_candidates(table(spark, sf, "documents"), "text").select(F.lit("documents").alias("origin"), F.col("doc_id").alias("id"))
    c = spans.select_candidates(table(spark, sf, "conversations"), "text").select(
        F.lit("conversations").alias("origin"), (F.col("conv_id") * 1000 + F.col("turn")).alias("id"))
    e = spans.select_candidates(canaries(spark, sf), "text").select(F.lit("events").alias("origin"), F.col("event_id").alias("id"))
    return d.unionByName(c).unionByName(e)


@query("SELECT DISTINCT sha256(text) AS text_id, CAST(length(text) AS INTEGER) AS n_chars FROM documents WHERE length(text) > 0")
def distinct_candidates(spark, sf):
    return spans.distinct_candidates(table(spark, sf, "documents"), "text", selective=False).select(
        "text_id", F.length("text").alias("n_chars"))


@query("WITH t AS (SELECT DISTINCT text FROM documents WHERE length(text) > 0), "
       "p AS (SELECT text, unnest(range(0, greatest(1, CAST(ceil((length(text) - 200) / 11800.0) AS BIGINT)))) AS i FROM t) "
       "SELECT sha256(text) AS text_id, CAST(i * 11800 AS INTEGER) AS \"offset\", md5(substr(text, i * 11800 + 1, 12000)) AS piece FROM p")
def detector_pieces(spark, sf):
    whole = spans.distinct_candidates(table(spark, sf, "documents"), "text", selective=False)
    return spans.detector_pieces(whole).select("text_id", "offset", F.md5("text").alias("piece"))


_SPANS_SQL = ("SELECT l_orderkey AS text_id, l_linenumber AS span_no, CAST((l_partkey * 7) % 180 AS INTEGER) AS start, "
              "CAST(CASE WHEN l_linenumber = 6 THEN NULL ELSE (l_partkey * 7) % 180 + l_suppkey % 30 - 2 END AS INTEGER) AS \"end\", "
              "CASE WHEN l_linestatus = 'O' THEN '' ELSE lower(l_returnflag) END AS label, l_discount * 10 + 0.55 AS score FROM lineitem")
_VALID_SQL = ("SELECT text_id, span_no, start, \"end\", CASE WHEN label = '' OR label IS NULL THEN 'PII' ELSE upper(label) END AS label, score "
              "FROM spans WHERE start IS NOT NULL AND \"end\" IS NOT NULL AND score >= 0.65 AND start < \"end\"")
_MERGED_SQL = (f"WITH spans AS ({_SPANS_SQL}), valid AS ({_VALID_SQL}), "
               "w AS (SELECT *, max(\"end\") OVER (PARTITION BY text_id ORDER BY start, \"end\", span_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM valid), "
               "g AS (SELECT *, sum(CASE WHEN start <= reach THEN 0 ELSE 1 END) OVER (PARTITION BY text_id ORDER BY start, \"end\", span_no) AS island FROM w), "
               "merged AS (SELECT text_id, min(start) AS start, max(\"end\") AS \"end\", arg_min(label, (start, \"end\", span_no, label)) AS label FROM g GROUP BY text_id, island)")


def _spans(spark, sf):
    start = ((F.col("l_partkey") * 7) % 180).cast("int")
    end = F.when(F.col("l_linenumber") != 6, (F.col("l_partkey") * 7) % 180 + F.col("l_suppkey") % 30 - 2).cast("int")
    return table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("text_id"), F.col("l_linenumber").alias("span_no"), start.alias("start"), end.alias("end"),
        F.when(F.col("l_linestatus") == "O", "").otherwise(F.lower("l_returnflag")).alias("label"),
        (F.col("l_discount") * 10 + 0.55).alias("score"))


@query(f"WITH spans AS ({_SPANS_SQL}) SELECT text_id, span_no, start, \"end\", label FROM ({_VALID_SQL})")
def valid_spans(spark, sf):
    return spans.valid_spans(_spans(spark, sf)).drop("score")


@query(f"{_MERGED_SQL} SELECT * FROM merged")
def merge_spans(spark, sf):
    return spans.merge_spans(spans.valid_spans(_spans(spark, sf)))


@query(f"{_MERGED_SQL} SELECT label, CAST(count(*) AS BIGINT) AS n FROM merged GROUP BY label")
def label_totals(spark, sf):
    return spans.label_totals(spans.merge_spans(spans.valid_spans(_spans(spark, sf))))


@query(f"{_MERGED_SQL}, p AS (SELECT m.text_id, d.text, start, \"end\", label, coalesce(lag(\"end\") OVER (PARTITION BY text_id ORDER BY start), 0) AS since "
       "FROM merged m JOIN documents d ON d.doc_id = m.text_id), "
       "r AS (SELECT text_id, string_agg(substr(text, since + 1, start - since) || '[PII_MODEL:' || label || ']', '' ORDER BY start) "
       "|| substr(any_value(text), max(\"end\") + 1) AS t FROM p GROUP BY text_id) "
       "SELECT d.doc_id, coalesce(r.t, d.text) AS text FROM documents d LEFT JOIN r ON r.text_id = d.doc_id")
def apply_spans(spark, sf):
    documents = table(spark, sf, "documents").select(F.col("doc_id").alias("text_id"), "text")
    merged = spans.merge_spans(spans.valid_spans(_spans(spark, sf)))
    return spans.apply_spans(documents, merged).select(F.col("text_id").alias("doc_id"), F.col("redacted").alias("text"))


_CUED = "concat('my name is ', role, ' ', cast(turn % 3 as string), ' ', replace(replace(replace(text, chr(92), ' '), '\"', ' '), chr(10), ' '))"


@query(f"WITH c AS (SELECT conv_id, turn, role, {_CUED} AS t FROM conversations) "
       "SELECT conv_id, turn, '{\"role\":\"' || role || '\",\"content\":[\"' || substr(t, 1, 11) || '[PII_MODEL:PERSON]' || substr(t, 12 + length(role)) || '\"],\"n\":1}' AS raw FROM c")
def model_pass(spark, sf):
    rows = table(spark, sf, "conversations").select("conv_id", "turn", "role", F.expr(_CUED).alias("t"))
    records = rows.select("conv_id", "turn", F.concat(F.lit('{"role": "'), "role", F.lit('", "content": ["'), "t", F.lit('"], "n": 1}')).alias("raw"))
    found = rows.select(spans.text_id(F.col("t")).alias("text_id"), F.lit(0).alias("span_no"), F.lit(11).alias("start"),
                        (F.length("role") + 11).alias("end"), F.lit("person").alias("label"), F.lit(0.9).alias("score"))
    return spans.model_pass(records, ["conv_id", "turn"], "raw", found, POLICY).drop("strings_changed")


# --------------------------------------------------------------------------- secret findings

_TOKEN = 'token = "([0-9a-f]{40})"'
_LOG_SQL = "SELECT source || '.jsonl' AS rel_path, doc_id AS line_no, text AS raw FROM documents"
_FOUND_SQL = (f"SELECT rel_path, line_no, s AS secret FROM (SELECT rel_path, line_no, unnest(regexp_extract_all(raw, '{_TOKEN}', 1)) AS s FROM log) "
              "UNION ALL SELECT 'gone.jsonl', line_no, 'x' || rel_path FROM log WHERE regexp_matches(raw, '@mail') "
              "UNION ALL SELECT rel_path, line_no, 'absent' || line_no FROM log WHERE regexp_matches(raw, '@mail')")
_FINDINGS_SQL = (f"log AS ({_LOG_SQL}), found AS ({_FOUND_SQL}), "
                 "findings AS (SELECT row_number() OVER (ORDER BY line_no, secret, rel_path) AS finding_no, rel_path, line_no, "
                 "CASE WHEN starts_with(secret, 'absent') THEN 'jwt-like' ELSE 'generic.api-key' END AS rule, secret FROM found), "
                 "scoped AS (SELECT * FROM findings WHERE rel_path IN (SELECT rel_path FROM log)), "
                 "firsts AS (SELECT rel_path, secret, min(finding_no) AS finding_no FROM scoped GROUP BY ALL), "
                 "occ AS (SELECT f.finding_no, sum(len(string_split(l.raw, f.secret)) - 1) AS n FROM firsts f JOIN log l ON l.rel_path = f.rel_path AND contains(l.raw, f.secret) GROUP BY 1), "
                 "outcomes AS (SELECT s.finding_no, s.rel_path, s.line_no, s.rule, CAST(coalesce(o.n, 0) AS BIGINT) AS replacements, o.n IS NULL AS tombstoned FROM scoped s LEFT JOIN occ o ON o.finding_no = s.finding_no)")


def _log(spark, sf):
    return table(spark, sf, "documents").select(
        F.concat("source", F.lit(".jsonl")).alias("rel_path"), F.col("doc_id").alias("line_no"), F.col("text").alias("raw"))


def _secret_findings(spark, sf):
    log = _log(spark, sf)
    mail = log.where(F.contains("raw", F.lit("@mail")))
    found = (log.select("rel_path", "line_no", F.explode(F.regexp_extract_all("raw", F.lit(_TOKEN), F.lit(1))).alias("secret"))
             .unionByName(mail.select(F.lit("gone.jsonl").alias("rel_path"), "line_no", F.concat(F.lit("x"), "rel_path").alias("secret")))
             .unionByName(mail.select("rel_path", "line_no", F.concat(F.lit("absent"), F.col("line_no").cast("string")).alias("secret"))))
    numbered = ranked(found.withColumn("_all", F.lit(0)), ["_all"], ["line_no", "secret", "rel_path"], "finding_no")
    return numbered.select("finding_no", "rel_path", "line_no", F.when(F.startswith("secret", F.lit("absent")), "jwt-like").otherwise("generic.api-key").alias("rule"), "secret")


_TOMB_SQL = ("'{\"type\":\"redacted_record\",\"redacted\":true,\"redaction_reason\":\"gitleaks_' || rule || '\"}'")


@query(f"WITH {_FINDINGS_SQL}, lists AS (SELECT rel_path, list(secret) AS secrets FROM firsts GROUP BY rel_path), "
       "tombs AS (SELECT rel_path, line_no, arg_max(rule, finding_no) AS rule FROM outcomes WHERE tombstoned GROUP BY ALL) "
       f"SELECT l.rel_path, l.line_no, CASE WHEN t.rule IS NOT NULL THEN {_TOMB_SQL} WHEN s.secrets IS NULL THEN l.raw ELSE "
       "list_reduce(list_prepend(l.raw, s.secrets), lambda a, x: replace(a, x, '[SECRET:GITLEAKS_GENERIC_API_KEY]')) END AS raw "
       "FROM log l LEFT JOIN lists s ON s.rel_path = l.rel_path LEFT JOIN tombs t ON t.rel_path = l.rel_path AND t.line_no = l.line_no")
def secret_findings(spark, sf):
    return secrets.apply_secret_findings(_log(spark, sf), _secret_findings(spark, sf))[0]


@query(f"WITH {_FINDINGS_SQL} SELECT * FROM outcomes")
def secret_outcomes(spark, sf):
    return secrets.apply_secret_findings(_log(spark, sf), _secret_findings(spark, sf))[1]


@query(f"WITH {_FINDINGS_SQL} SELECT rule, CAST(count(*) AS BIGINT) AS findings, CAST(sum(replacements) AS BIGINT) AS replacements, "
       "CAST(count(*) FILTER (WHERE tombstoned) AS BIGINT) AS tombstones, CAST(sum(replacements) + count(*) FILTER (WHERE tombstoned) AS BIGINT) AS hits FROM outcomes GROUP BY rule")
def findings_summary(spark, sf):
    return secrets.summary_by_rule(secrets.apply_secret_findings(_log(spark, sf), _secret_findings(spark, sf))[1])


# Every long word of the benchmark items, looked for in every log.
@query(f"WITH log AS ({_LOG_SQL}), w AS (SELECT DISTINCT unnest(regexp_extract_all(text, '{_LONG_WORD}')) AS literal FROM benchmark) "
       "SELECT rel_path, literal, CAST(count(*) AS BIGINT) AS n FROM log JOIN w ON contains(raw, literal) GROUP BY ALL")
def literal_join(spark, sf):
    log = _log(spark, sf)
    files = log.select("rel_path").distinct().crossJoin(_term_list(spark, sf).withColumnRenamed("term", "literal"))
    wanted = files.select("rel_path", F.abs(F.xxhash64("rel_path", "literal")).alias("no"), "literal", F.lit("[X]").alias("placeholder"))
    hits = literals.joined_hits(log, ["rel_path", "line_no"], literals.anchored(materialized(wanted)), F.array("raw"), "rel_path")
    return (hits.select("rel_path", "line_no", F.explode("literals.literal").alias("literal")).distinct()
            .groupBy("rel_path", "literal").agg(F.count(F.lit(1)).alias("n")))


@query(f"WITH {_FINDINGS_SQL} SELECT CASE WHEN count(*) = 0 THEN 'clean' ELSE 'findings_or_error' END AS status, CAST(count(*) AS BIGINT) AS findings FROM scoped")
def scan_status(spark, sf):
    return secrets.scan_status(secrets.scope_findings(_secret_findings(spark, sf), _log(spark, sf)))


@query("SELECT event_id AS line_no, '{\"type\":' || CASE WHEN event_id % 2 = 0 THEN '\"' || event_type || '\"' ELSE '\"redacted_record\"' END || "
       "',\"redacted\":true,\"redaction_reason\":\"gitleaks_' || event_type || '\"}' AS raw FROM events")
def tombstones(spark, sf):
    events = table(spark, sf, "events")
    records = events.select(F.lit("e.jsonl").alias("rel_path"), F.col("event_id").alias("line_no"), F.when(
        F.col("event_id") % 2 == 0, F.concat(F.lit('{"type": "'), "event_type", F.lit('"}'))).otherwise(F.col("event_type")).alias("raw"))
    findings = events.select(F.lit("e.jsonl").alias("rel_path"), F.col("event_id").alias("line_no"),
                             F.col("event_type").alias("rule"), F.col("event_id").alias("finding_no"))
    return secrets.tombstone(records, findings).select("line_no", "raw")


@query("SELECT doc_id, CAST(len(string_split(text, 'the ')) - 1 AS BIGINT) AS n FROM documents")
def count_literals(spark, sf):
    return table(spark, sf, "documents").select("doc_id", count_literal(F.col("text"), F.lit("the ")).alias("n"))


# --------------------------------------------------------------------------- review

_PATTERNS = review.review_patterns(extra=(r"(?i:\bentrepr)",), terms=("mail1.example.com",))
_PATTERNS_RE2 = [re2(p) for p in _PATTERNS if "(?<!" not in p] + [r"(^|[^A-Za-z0-9_-])--[A-Za-z0-9_.-]*[A-Za-z0-9][A-Za-z0-9_.-]*--"]


def _candidate_sql(column: str) -> str:
    return " OR ".join(f"regexp_matches({column}, {quote(p)})" for p in _PATTERNS_RE2)


@query(f"WITH r AS (SELECT conv_id, turn, text FROM conversations WHERE {_candidate_sql('text')} "
       f"UNION ALL SELECT event_id, -1, {canary_text()} FROM events WHERE {_candidate_sql(canary_text())}), "
       "p AS (SELECT *, unnest(range(0, greatest(1, CAST(ceil((length(text) - 20) / 60.0) AS BIGINT)))) AS i FROM r) "
       "SELECT conv_id, turn, CAST(i AS INTEGER) AS chunk_no, substr(text, i * 60 + 1, 80) AS chunk FROM p")
def review_chunks(spark, sf):
    rows = table(spark, sf, "conversations").select("conv_id", F.col("turn").cast("bigint").alias("turn"), "text").unionByName(
        canaries(spark, sf).select(F.col("event_id").alias("conv_id"), F.lit(-1).cast("bigint").alias("turn"), "text"))
    return review.review_chunks(rows, _PATTERNS, "text", 80, 20).select("conv_id", "turn", "chunk_no", "chunk")


_WINDOW = r"https?://[^\s'\"<>`)}\]]+|@mail"


@query("WITH p AS (SELECT page_id, html, string_split_regex(html, {p}) AS pieces, regexp_extract_all(html, {p}) AS ms FROM (SELECT page_id, url || ' ' || html AS html FROM pages)), "
       "e AS (SELECT page_id, html, unnest(range(1, len(ms) + 1)) AS i, pieces, ms FROM p), "
       "o AS (SELECT page_id, html, i, list_sum(list_transform(pieces[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(ms[1:i-1], lambda x: length(x))), 0) AS s, length(ms[i]) AS n FROM e) "
       "SELECT page_id, CAST(i - 1 AS INTEGER) AS chunk_no, html[CAST(greatest(0, s - 30) + 1 AS BIGINT):CAST(s + n + 30 AS BIGINT)] AS chunk FROM o".replace("{p}", quote(re2(_WINDOW))))
def review_windows(spark, sf):
    pages = table(spark, sf, "pages").select("page_id", F.concat("url", F.lit(" "), "html").alias("html"))
    return review.review_windows(pages, ["page_id"], "html", [_WINDOW], 60)


@query("WITH c AS (SELECT conv_id * 1000 + turn AS chunk_id, role || '/' || (conv_id % 7) || '.jsonl' AS rel_path, text FROM conversations) "
       "SELECT chunk_id, rel_path FROM c")
def limit_chunks(spark, sf):
    rows = table(spark, sf, "conversations").select(
        (F.col("conv_id") * 1000 + F.col("turn")).alias("chunk_id"),
        F.concat("role", F.lit("/"), (F.col("conv_id") % 7).cast("string"), F.lit(".jsonl")).alias("rel_path"), F.length("text").cast("bigint").alias("file_size"))
    return review.limit_chunks(review.limit_files(rows), ["rel_path", "chunk_id"]).select("chunk_id", "rel_path")


# Findings made from the texts: the first and the last word, with some that do not qualify.
_REVIEW_SQL = """
rec AS (SELECT role || '.jsonl' AS rel_path, conv_id * 1000 + turn AS line_no, '{"role":"' || role || '","text":"' || replace(replace(replace(text, chr(92), ' '), '"', ' '), chr(10), ' ') || '"}' AS raw FROM conversations),
chunks AS (SELECT line_no AS chunk_id, rel_path, raw AS chunk FROM rec),
words AS (SELECT line_no, rel_path, regexp_extract(raw, '"text":"([A-Za-z]+)', 1) AS w FROM rec),
raw_findings AS (SELECT line_no * 3 AS finding_no, line_no AS chunk_id, rel_path, ' ' || w || ' ' AS text, 'org name' AS category FROM words
  UNION ALL SELECT line_no * 3 + 1, line_no, rel_path, '[' || w || ']', 'x' FROM words
  UNION ALL SELECT line_no * 3 + 2, line_no, rel_path, 'nowhere' || w, 'y' FROM words),
valid AS (SELECT f.finding_no, f.chunk_id, f.rel_path, trim(f.text) AS text, regexp_replace(upper(category), '[^A-Z0-9_]', '_', 'g') AS category
  FROM raw_findings f JOIN chunks c ON c.chunk_id = f.chunk_id WHERE length(trim(f.text)) >= 3 AND NOT contains(f.text, '[') AND contains(c.chunk, trim(f.text)))"""


def _review(spark, sf):
    clean = F.replace(F.replace(F.replace("text", F.lit("\\"), F.lit(" ")), F.lit('"'), F.lit(" ")), F.lit("\n"), F.lit(" "))
    rec = table(spark, sf, "conversations").select(
        F.concat("role", F.lit(".jsonl")).alias("rel_path"), (F.col("conv_id") * 1000 + F.col("turn")).alias("line_no"),
        F.concat(F.lit('{"role":"'), "role", F.lit('","text":"'), clean, F.lit('"}')).alias("raw"))
    words = rec.select("line_no", "rel_path", F.regexp_extract("raw", '"text":"([A-Za-z]+)', 1).alias("w"))
    def found(k, value, category):
        return words.select((F.col("line_no") * 3 + k).alias("finding_no"), F.col("line_no").alias("chunk_id"), "rel_path",
                            value.alias("text"), F.lit(category).alias("category"))
    findings = (found(0, F.concat(F.lit(" "), "w", F.lit(" ")), "org name").unionByName(found(1, F.concat(F.lit("["), "w", F.lit("]")), "x"))
                .unionByName(found(2, F.concat(F.lit("nowhere"), "w"), "y")))
    chunks = rec.select(F.col("line_no").alias("chunk_id"), "rel_path", F.col("raw").alias("chunk"))
    return rec, chunks, review.valid_findings(findings, chunks)


@query(f"WITH {_REVIEW_SQL} SELECT * FROM valid")
def valid_findings(spark, sf):
    return _review(spark, sf)[2].select("finding_no", "chunk_id", "rel_path", "text", "category")


@query(f"WITH {_REVIEW_SQL} SELECT rel_path, text, arg_max(category, finding_no) AS category, min(finding_no) AS no FROM valid GROUP BY rel_path, text")
def dedupe_findings(spark, sf):
    return review.dedupe_findings(_review(spark, sf)[2])


_APPLIED_SQL = f"""WITH {_REVIEW_SQL},
lists AS (SELECT rel_path, list(text ORDER BY length(text) DESC, no) AS texts FROM (SELECT rel_path, text, min(finding_no) AS no FROM valid GROUP BY ALL) GROUP BY rel_path),
parts AS (SELECT r.rel_path, line_no, 'role' AS k1, regexp_extract(raw, '"role":"([^"]*)"', 1) AS v1, 'text' AS k2, regexp_extract(raw, '"text":"([^"]*)"', 1) AS v2, texts FROM rec r LEFT JOIN lists l ON l.rel_path = r.rel_path),
done AS (SELECT rel_path, line_no, {", ".join(f"list_reduce(list_prepend({c}, coalesce(texts, [])), lambda a, x: replace(a, x, '[LLM_PII:ORG_NAME]')) AS {c}" for c in ("k1", "v1", "k2", "v2"))} FROM parts)"""


@query(_APPLIED_SQL + " SELECT rel_path, line_no, '{\"' || k1 || '\":\"' || v1 || '\",\"' || k2 || '\":\"' || v2 || '\"}' AS raw FROM done")
def apply_review(spark, sf):
    rec, _, findings = _review(spark, sf)
    return review.apply_review_findings(rec, findings).drop("replacements")


@query(_APPLIED_SQL + ", n AS (SELECT rel_path, sum(len(regexp_extract_all(k1 || v1 || k2 || v2, 'LLM_PII:'))) AS n FROM done GROUP BY rel_path) "
       "SELECT (SELECT count(*) FROM chunks) AS chunks_reviewed, (SELECT count(DISTINCT rel_path) FROM valid) AS files_with_findings, "
       "CAST(count(*) FILTER (WHERE n > 0) AS BIGINT) AS files_changed, CAST(sum(n) AS BIGINT) AS replacements, false AS dry_run FROM n")
def review_summary(spark, sf):
    rec, chunks, findings = _review(spark, sf)
    return review.review_summary(chunks, findings, review.apply_review_findings(rec, findings))


@query(_APPLIED_SQL + " SELECT CAST(count(DISTINCT rel_path) AS BIGINT) AS files_scanned, CAST(count(DISTINCT rel_path) FILTER (WHERE "
       "contains(k1 || v1 || k2 || v2, '[LLM_PII:')) AS BIGINT) AS files_changed FROM done")
def pass_stats(spark, sf):
    rec, _, findings = _review(spark, sf)
    return stats.pass_stats(rec, review.apply_review_findings(rec, findings), ["rel_path", "line_no"], "raw")


# --------------------------------------------------------------------------- scan

_SCAN = {n: p for n, p in catalog.SCAN_RULES}
_MASKED = r"regexp_replace({t}, '\[[A-Z_]+(?::[^\[\]]*)?\]', chr(65532), 'g')"


def _scan_sql(rows: str) -> str:
    """Hits of the rules that the tables can trigger, with their filters."""
    def found(name, pattern, keep="true", group=0):
        p = quote(re2(pattern))
        return (f"SELECT rel_path, place, '{name}' AS name, m AS match FROM (SELECT rel_path, place, unnest(regexp_extract_all(t, {p}, {group})) AS m FROM masked) WHERE {keep}")
    parts = [
        found("url", _SCAN["url"], "m NOT IN ('http://', 'https://', 'http://\\', 'https://\\')"),
        found("ipv4", _SCAN["ipv4"], "NOT starts_with(m, '0.0.0.') AND m <> '127.0.0.1'"),
        found("email", r"\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}\b", "length(split_part(m, '@', 1)) > 1"),
        found("iban", _SCAN["iban"]), found("latlon_coordinates", _SCAN["latlon_coordinates"]),
        found("street_address", _SCAN["street_address"]), found("contextual_phone", _SCAN["contextual_phone"]),
        found("mac_address", _SCAN["mac_address"]), found("generic_home_path_content", r"(?:/home|home|/Users)/[A-Za-z0-9._-]+"),
    ]
    return f"rows AS ({rows}), masked AS (SELECT rel_path, place, {_MASKED.format(t='text')} AS t FROM rows), hits AS ({' UNION ALL '.join(parts)})"


_SCANNED_SQL = ("SELECT source || '/' || lang || '.txt' AS rel_path, 'content' AS place, text FROM documents UNION ALL "
                "SELECT 'pages/' || (page_id % 9) || '.html', 'content', url || ' ' || html FROM pages UNION ALL "
                "SELECT DISTINCT source || '/' || lang || '.txt', 'path', source || '/' || lang || '.txt' FROM documents")


def _scanned(spark, sf):
    d = table(spark, sf, "documents").select(F.concat("source", F.lit("/"), "lang", F.lit(".txt")).alias("rel_path"), F.col("text").alias("raw"))
    p = table(spark, sf, "pages").select(F.concat(F.lit("pages/"), (F.col("page_id") % 9).cast("string"), F.lit(".html")).alias("rel_path"),
                                         F.concat("url", F.lit(" "), "html").alias("raw"))
    return d.unionByName(p)


@query(f"WITH {_scan_sql(_SCANNED_SQL)} SELECT * FROM hits")
def scan_leftovers(spark, sf):
    return scan.scan(_scanned(spark, sf), POLICY)


@query(f"SELECT 'e' || (event_id % 7) || '.txt' AS rel_path, 'content' AS place, name, match FROM ({planted_hits()})")
def scan_planted(spark, sf):
    """The rules and filters that the tables' own texts do not reach, on values made from the event numbers."""
    rows = table(spark, sf, "events").select(
        F.concat(F.lit("e"), (F.col("event_id") % 7).cast("string"), F.lit(".txt")).alias("rel_path"), F.expr(planted_text()).alias("raw"))
    return scan.scan(rows, POLICY)


_SUMMARY_SQL = (f"per AS (SELECT name, rel_path, count(*) AS n, bool_or(place = 'path') AS in_path FROM hits GROUP BY ALL), "
                "rn AS (SELECT *, row_number() OVER (PARTITION BY name ORDER BY string_split(rel_path, '/')) AS rn FROM per), "
                "ex AS (SELECT name, string_agg(rel_path || CASE WHEN in_path THEN ' (path)' ELSE ' (content)' END, '; ' ORDER BY rn) AS examples FROM rn WHERE rn <= 5 GROUP BY name), "
                "tot AS (SELECT name, sum(n) AS matches, count(*) AS files FROM per GROUP BY name), "
                f"names AS (SELECT unnest([{', '.join(quote(n) for n, _ in catalog.SCAN_RULES)}]) AS name)")
_SUMMARY_OUT = ("SELECT n.name, CAST(coalesce(t.matches, 0) AS BIGINT) AS matches, CAST(coalesce(t.files, 0) AS BIGINT) AS files, coalesce(e.examples, '') AS examples "
                "FROM names n LEFT JOIN tot t ON t.name = n.name LEFT JOIN ex e ON e.name = n.name")


@query(f"WITH {_scan_sql(_SCANNED_SQL)}, {_SUMMARY_SQL} {_SUMMARY_OUT}")
def scan_summary(spark, sf):
    found = scan.scan_summary(scan.scan(_scanned(spark, sf), POLICY), POLICY)
    return found.withColumn("examples", F.array_join("examples", "; "))


@query(f"WITH {_scan_sql(_SCANNED_SQL)} SELECT count(*) > 0 AS failed FROM hits")
def gate(spark, sf):
    return scan.gate(scan.scan_summary(scan.scan(_scanned(spark, sf), POLICY), POLICY))


@query("SELECT unnest([{}]) AS name, CAST(0 AS BIGINT) AS matches, CAST((SELECT count(*) FROM documents WHERE text IS NULL) AS BIGINT) AS files".format(
    ", ".join(quote(n) for n, _ in catalog.SCAN_RULES)))
def scan_redacted(spark, sf):
    clean = text.redact_text(_scanned(spark, sf), "raw", POLICY)
    return scan.scan_summary(scan.scan(clean, POLICY), POLICY).drop("examples")


# --------------------------------------------------------------------------- files

_LINES_SQL = ("SELECT 'codex/sessions/' || source || '/' || lang || '.jsonl' AS rel_path, row_number() OVER (PARTITION BY source, lang ORDER BY doc_id) AS line_no, "
              "regexp_replace(text, '[\\r\\n]', ' ', 'g') AS raw FROM documents")


@query(_LINES_SQL)
def tree_round_trip(spark, sf):
    """Documents written as a tree of logs and read again."""
    numbered = ranked(table(spark, sf, "documents"), ["source", "lang"], ["doc_id"], "line_no")
    records = numbered.select(
        F.lit("codex_sessions").alias("source"), F.concat("source", F.lit("/"), "lang", F.lit(".jsonl")).alias("rel_path"), "line_no",
        F.regexp_replace("text", r"[\r\n]", " ").alias("raw"))
    out = new_folder(spark, "tree")
    write_tree(records, out)
    return read_event_logs(spark, out).select("rel_path", "line_no", "raw")


_ORDER_SQL = """
WITH found AS (SELECT 1 AS t, c_custkey AS k, 0 AS i, 'm' || (c_custkey * 7 % 400) || '@mail.example' AS v FROM customer
  UNION ALL SELECT 2, s_suppkey, 0, 'm' || s_suppkey || '@mail.example' FROM supplier),
firsts AS (SELECT v, min((t, k, i)) AS first, count(*) AS n FROM found GROUP BY v)
SELECT substr(sha256(v), 1, 10) AS digest, row_number() OVER (ORDER BY first) AS ordinal, CAST(n AS BIGINT) AS n FROM firsts"""


@query(_ORDER_SQL)
def table_ordinals(spark, sf):
    """Numbers of mail addresses in tables, whose rows come in no order."""
    names = [t for t in POLICY.allow_tables if t in ("session", "message")]
    mails = {names[0]: table(spark, sf, "customer").select(
        F.col("c_custkey").alias("id"), F.concat(F.lit("m"), (F.col("c_custkey") * 7 % 400).cast("string"), F.lit("@mail.example")).alias("title")),
        names[1]: table(spark, sf, "supplier").select(
            F.col("s_suppkey").alias("id"), F.concat(F.lit("m"), F.col("s_suppkey").cast("string"), F.lit("@mail.example")).alias("title"))}
    records = sanitize_plan.table_records({n: t.repartition(5, F.xxhash64("id")) for n, t in mails.items()}, POLICY)
    local = materialized(json_records.redact_json(records, "raw", POLICY, hits="hits"))
    files = local.select("source", "rel_path").distinct().withColumn("hits", F.array().cast(HITS_TYPE))
    dictionary = sanitize_plan.dictionary_of(local, files, POLICY)
    return dictionary.where("category = 'email'").select("digest", "ordinal", "n")


# --------------------------------------------------------------------------- jobs

@query(f"WITH r AS ({_RECORDS_SQL}), n AS (SELECT count(*) AS n FROM events), "
       "t AS (SELECT count(*) AS n FROM customer) "
       "SELECT 'files' AS metric, count(DISTINCT rel_path) + 1 AS n FROM r UNION ALL SELECT 'records', (SELECT n FROM n) + (SELECT n FROM t) UNION ALL "
       "SELECT 'invalid', count(*) FROM r WHERE trim(raw) <> '' AND NOT json_valid(raw) UNION ALL SELECT 'emails', (SELECT n FROM t) UNION ALL "
       "SELECT 'shared', (SELECT n FROM t) UNION ALL SELECT 'changed_again', 0")
def sanitize_report(spark, sf):
    result = sanitize_plan.sanitize(_records(spark, sf), POLICY, {"session": _exported(spark, sf)["session"]})
    def metric(name, df, value):
        return df.agg(F.coalesce(value, F.lit(0)).cast("bigint").alias("n")).select(F.lit(name).alias("metric"), "n")
    category = F.col("category")
    return (metric("files", result.safety, F.sum("files_scanned"))
            .unionByName(metric("records", result.records, F.count(F.lit(1))))
            .unionByName(metric("invalid", result.sources, F.sum("invalid_lines")))
            .unionByName(metric("emails", result.dictionary.where(category == "email"), F.max("ordinal")))
            .unionByName(metric("shared", result.counts.where(category == "sensitive_field_share_url"), F.sum("n")))
            .unionByName(metric("changed_again", result.safety, F.sum("files_changed"))))

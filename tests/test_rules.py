"""One positive and one near miss per redaction rule, plus rule order."""

import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from palimpsest import catalog
from palimpsest.functions.dialect import java_regex
from palimpsest.functions.redact import digest, redacted, redacted_with_hits
from palimpsest.functions.rules import _build, redaction_rules, scan_rules, shadowed_rules
from palimpsest.policy import Policy

# category -> (positive, redacted form or None for a stable placeholder, near miss)
CANARIES = {
    "private_key": ("-----BEGIN TEST PRI" "VATE KEY-----\n" + "A" * 40 + "\n-----END TEST PRI" "VATE KEY-----", "[SECRET:PRIVATE_KEY]", "-----BEGIN TEST PRI" "VATE KEY-----"),
    "pi_encoded_path_component": ("--home-u1-proj--", None, "--ab"),
    "authorization_bearer": ("Authorization: Bearer " + "k" * 12, "Authorization: Bearer [SECRET:BEARER_TOKEN]", "Authorization: Basic x"),
    "bearer_token": ("bearer " + "k" * 12, "bearer [SECRET:BEARER_TOKEN]", "bearer bond"),
    "env_secret_assignment": ("MY_TOKEN='" + "v" * 10 + "'", "MY_TOKEN=[SECRET:ENV_VALUE]", "MY_TOKEN=short"),
    "env_secret_default": ("DB_PASSWORD: $" "{DBP:-pppppp}", "DB_PASSWORD: $" "{DBP:-[SECRET:ENV_DEFAULT]}", "DB_HOST: x"),
    "env_secret_colon_default": ("DB_SECRET:-ssssss", "DB_SECRET:-[SECRET:ENV_DEFAULT]", "DB_NAME:-abc"),
    "openai_key": ("sk" "-" + "o" * 24, "[SECRET:OPENAI_API_KEY]", "sk-abc"),
    "short_sk_key": ("sk" "-" + "o" * 8, "[SECRET:API_KEY_FIELD]", "sk-abc"),
    "github_token": ("gh" "p_" + "g" * 24, "[SECRET:GITHUB_TOKEN]", "ghx_abc"),
    "huggingface_token": ("h" "f_" + "h" * 24, "[SECRET:HUGGINGFACE_TOKEN]", "hf_short"),
    "google_api_key": ("AI" "za" + "z" * 32, "[SECRET:GOOGLE_API_KEY]", "AIza1"),
    "aws_access_key": ("AK" "IA" + "Q" * 16, "[SECRET:AWS_ACCESS_KEY]", "AK" "IA" + "Q" * 15),
    "jwt": ("ey" "J" + "a" * 12 + "." + "b" * 12 + "." + "c" * 12, "[SECRET:JWT]", "ey" "J" + "a" * 12 + "." + "b" * 12),
    "password_hash": ("$2" "b$10$" + "x" * 53, "[SECRET:PASSWORD_HASH]", "$2" "b$10$" + "x" * 52),
    "ssh_public_key": ("ssh-" "rsa " + "A" * 44 + " me@box", "[SECRET:SSH_PUBLIC_KEY]", "ssh-" "rsa " + "A" * 39),
    "iban": ("ZZ00" + "7" * 16, "[PII:IBAN]", "ZZ00123"),
    "quicktime_location_iso6709": ("com.apple.quicktime.location.ISO6709: +10.1234+020.5678/", "com.apple.quicktime.location.ISO6709: [PII:GPS_COORDINATES]", "com.apple.quicktime.location.ISO6709:"),
    "quicktime_location_accuracy": ("com.apple.quicktime.location.accuracy.horizontal: 4.5", "com.apple.quicktime.location.accuracy.horizontal: [PII:LOCATION_ACCURACY]", "com.apple.quicktime.location.accuracy.horizontal:"),
    "iso6709_coordinates": ("+10.1234+020.5678/", "[PII:GPS_COORDINATES]", "+10.1234+020.5678"),
    "latlon_coordinates": ("10.12345, 20.12345", "[PII:GPS_COORDINATES]", "10.1234, 20.1234"),
    "street_address": ("12 Elm Tree Road", "[PII:STREET_ADDRESS]", "12 elm tree road"),
    "ipv6": ("2001:db8:1:2:3:4:5:6", "[PII:IPV6_ADDRESS]", "2001:db8::1"),
    "mac_address": ("0a-1b-2c-3d-4e-5f", "[HW:MAC_ADDRESS]", "0a-1b-2c"),
    "bluetooth_path": ("/org/bluez/hci0/x", "[HW:BLUETOOTH_PATH]", "/org/other"),
    "airpods_pro": ("AirPods Pro", "[HW:BLUETOOTH_DEVICE]", "AirPods"),
    "scarlett_solo": ("Scarlett Solo", "[HW:AUDIO_DEVICE]", "Scarlett"),
    "focusrite_device": ("Focusrite_USB, x", "[HW:AUDIO_DEVICE], x", "Focus rite"),
    "url_basic_auth": ("ftp://u:p@h", "ftp://[SECRET:BASIC_AUTH]", "ftp://h"),
    "database_url": ("redis://h/0", "[SECRET:DATABASE_URL]", "sqlite:x"),
    "opencode_share_url": ("https://opncd.ai/share/x1", "[PRIVATE_SHARE_URL]", "opncd.ai/share"),
    "private_url": ("http://192.168.1.2/a", "[PRIVATE_URL]", "192.168.1"),
    "url": ("https://h1.example.org/p", None, "example.org/p"),
    "api_key_json_field": ('"api_key": "abc"', '"api_key": "[SECRET:API_KEY_FIELD]"', '"api": "abc"'),
    "api_key_assignment": ("api_key = abc", "api_key=[SECRET:API_KEY_FIELD]", "api_key = ab"),
    "contextual_phone": ("phone: +99 000 000 0000", "phone: [PII:PHONE]", "+99 000 000 0000"),
    "email": ("m1@example.org", None, "m@localhost"),
    "user_at_host": ("canuser@box", "[PII:USER_AT_HOST]", "other@box"),
    "user_at_literal": ("canuser@ ", "[PII:USER_AT] ", "other@ "),
    "ipv4": ("10.0.0.7", "[PII:IP_ADDRESS]", "10.0.7"),
    "encoded_home_path": ("x--home-canuser-a--", None, "home-a"),
    "encoded_home_path_literal": ("--home-canuser", "[ENCODED_HOME_PATH]", "home-a"),
    "private_domain": ("a.corp.test", "[PRIVATE_DOMAIN]", "corp.test2"),
    "private_term_domain": ("x.canuserlab.test", "[PRIVATE_DOMAIN]", "x.lab.test"),
    "private_term": ("Canuser", "[PRIVATE_TERM]", "canvas"),
    "private_term_compound": ("my_canuser_dir", "[PRIVATE_TERM]", "my_can_dir"),
    "redacted_literal": ("REDACTED", "[OMITTED]", "REDACTEDX"),
    "generic_home_path": ("/home/other/a.txt", None, "/homes/"),
    "home_path": ("~/a", None, "/root"),
    "mac_home_path": ("/Users/other/a", None, "/Users"),
    "ssh_remote": ("box:team/repo.git", None, "box:team/repo"),
}


def run(spark, texts, policy, column=redacted):
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, t string").select("i", column(F.col("t"), policy).alias("r"))
    return [r["r"] for r in sorted(rows.collect(), key=lambda r: r["i"])]


def test_every_rule_has_a_canary():
    named = {c for c, _, _ in catalog.REDACTION_RULES}
    assert named - set(CANARIES) == {"anthropic_key", "private_user_name"}


def test_positives(spark, policy):
    names = list(CANARIES)
    got = run(spark, [f"row {CANARIES[n][0]} end" for n in names], policy, redacted_with_hits)
    for name, row in zip(names, got):
        positive, expected, _ = CANARIES[name]
        assert [(h["category"], h["n"]) for h in row["hits"]] == [(name, 1)], (name, row)
        if expected is None:
            import hashlib
            value = row["hits"][0]["values"][0]
            expected = positive.replace(value, f"[{name.upper()}:0000:{hashlib.sha256(value.encode()).hexdigest()[:10]}]")
        assert row["text"] == f"row {expected} end", name


def test_near_misses(spark, policy):
    names = list(CANARIES)
    texts = [f"row {CANARIES[n][2]} end" for n in names]
    for name, before, row in zip(names, texts, run(spark, texts, policy, redacted_with_hits)):
        assert name not in [h["category"] for h in row["hits"]], (name, row)
        if not row["hits"]:
            assert row["text"] == before


def test_order(spark, policy):
    cases = {
        "sk" "-ant-" + "n" * 24: "[SECRET:OPENAI_API_KEY]",       # the general key rule comes first
        "0a:1b:2c:3d:4e:5f": "[PII:IPV6_ADDRESS]",
        "api_key = " + "v" * 8: "api_key = [SECRET:ENV_VALUE]",
        "https://u:p@h.example/x": "https://[SECRET:BASIC_AUTH]",
        "/home/canuser/tail": "/home/[PRIVATE_TERM]/tail",
    }
    got = run(spark, list(cases), policy)
    want = list(cases.values())
    # the scheme with its placeholder is a URL again
    assert got[3].startswith("[URL:0000:") and got[3].endswith("]")
    assert [g for i, g in enumerate(got) if i != 3] == [w for i, w in enumerate(want) if i != 3]


def test_short_user_name(spark):
    assert run(spark, ["a zq b", "zqa"], Policy("zq", "/home/zq")) == ["a [PRIVATE_USER] b", "zqa"]


def test_compat_basic_auth(spark):
    got = run(spark, ["https://u:p@h.example/x"], Policy("zq", "/home/zq", compat=True))[0]
    assert re.fullmatch(r"\[URL:0000:[0-9a-f]{10}\]\]@h\.example/x", got)


def test_shadowed(policy):
    assert ("anthropic_key", "openai_key") in shadowed_rules(policy)


def test_allow_list(spark):
    p = Policy("zq", "/home/zq", allowed_domains=(".Example.org",), allow_public_urls=True)
    got = run(spark, ["https://a.EXAMPLE.org./x", "https://badexample.org/x", "http://github.com:8/x"], p)
    assert got[0] == "https://a.EXAMPLE.org./x" and got[1].startswith("[URL:") and got[2] == "http://github.com:8/x"


SNIPPETS = [p for p, _, n in CANARIES.values()] + [n for _, _, n in CANARIES.values()] + [
    "é", " ", "\r", "\n", " ", "²", "́", "ſ", "K", "TELÉ 12 345 67 890", "٣.٣.٣.٣", "API-KEY=", '"', "\x1c", "_", "-", "--", "@"]
texts = st.lists(st.sampled_from(SNIPPETS), min_size=1, max_size=6).map("".join)


def test_guards_are_necessary(spark, policy):
    """Leaving out the guards changes nothing."""
    from dataclasses import replace
    import random
    rng = random.Random(7)
    sample = ["".join(rng.choices(SNIPPETS, k=rng.randint(1, 6))) for _ in range(1500)]
    rules = redaction_rules(policy)
    open_rules = [replace(r, guard=()) for r in rules]
    df = spark.createDataFrame([(t,) for t in sample], "t string").select(
        "t", redacted(F.col("t"), policy, rules).alias("a"), redacted(F.col("t"), policy, open_rules).alias("b"))
    assert df.where("a <> b").count() == 0


def test_java_matches_like_python(spark, policy):
    """Every pattern finds the same strings in Spark as in Python's ``re``."""
    import random
    rng = random.Random(11)
    sample = ["".join(rng.choices(SNIPPETS, k=rng.randint(1, 5))) for _ in range(400)]
    df = spark.createDataFrame(list(enumerate(sample)), "i int, t string")
    rules = redaction_rules(policy) + scan_rules(policy)
    rows = df.select("i", *[F.regexp_extract_all("t", F.lit(r.pattern), F.lit(0)).alias(f"c{n}")
                            for n, r in enumerate(rules)]).collect()
    for row in rows:
        for n, r in enumerate(rules):
            want = [m.group(0) for m in re.finditer(r.source, sample[row["i"]])]
            assert row[f"c{n}"] == want, (r.category, sample[row["i"]])


def test_long_texts_need_no_stack(spark, policy):
    words = "Focusrite " + "ab " * 50_000
    blob = '{"encrypted_content": "' + "x\\n" * 50_000 + '"}'
    got = run(spark, [words, blob], policy)
    assert got[0] == "[HW:AUDIO_DEVICE] "
    from palimpsest.operators.scan import leftovers
    left = spark.createDataFrame([(blob,)], "t string").select(F.size(leftovers(F.col("t"), policy)).alias("n")).head()
    assert left["n"] == 1


def test_digest_salt(spark):
    import hashlib
    row = spark.range(1).select(digest(F.lit("é")).alias("a"), digest(F.lit("é"), "s").alias("b")).head()
    assert row["a"] == hashlib.sha256("é".encode()).hexdigest()[:10]
    assert row["b"] == hashlib.sha256("sé".encode()).hexdigest()[:10]


def test_idempotent(spark, policy):
    # A second pass may still find words that the first one wrote (secrets in
    # assignments keep their name), but must not change fixed placeholders.
    texts_ = [f"row {p} end" for p, _, _ in CANARIES.values()]
    once = run(spark, texts_, policy)
    twice = run(spark, once, policy)
    changed = [n for n, a, b in zip(CANARIES, once, twice) if a != b]
    # an API key assignment is an environment assignment once its value is long
    assert changed == ['api_key_assignment']

"""SQL building blocks for the DuckDB side: the catalog in RE2's dialect.

RE2 has no look-around and no back-references and its classes are ASCII, so
those rules are written out again; the others only need their classes spelled
out.
"""

from palimpsest import catalog
from palimpsest.functions.rules import _fill
from palimpsest.policy import Policy

_SPACE = (r"\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}")
_KEYS = r"(?:API[_-]?KEY|TOKEN|SECRET|PASSWORD|PASSWD|PRIVATE[_-]?KEY|ACCESS[_-]?KEY|CREDS[_-]?(?:KEY|IV))"
_NAME = rf"[A-Z0-9_]*{_KEYS}[A-Z0-9_]*"

# Rules that RE2 cannot take as they are: (pattern, replacement).
# ``\1`` before a stable placeholder keeps the character in front of it.
OVERRIDES = {
    "pi_encoded_path_component":
        (r"(^|[^A-Za-z0-9_-])(--[A-Za-z0-9_.-]*[A-Za-z0-9][A-Za-z0-9_.-]*--)", None),
    "bearer_token": (r"(?i)\b(Bearer\s+)(?:REDACTED|[A-Za-z0-9._~+/=-]{8,})", r"\1[SECRET:BEARER_TOKEN]"),
    "env_secret_assignment":
        (rf"(?i)\b({_NAME}\s*=\s*)(?:'(?:REDACTED|[^\s'\"\\]{{8,}})'|\"(?:REDACTED|[^\s'\"\\]{{8,}})\"|(?:REDACTED|[^\s'\"\\]{{8,}}))",
         r"\1[SECRET:ENV_VALUE]"),
    "env_secret_colon_default": (rf"(?i)(\b{_NAME}\s*:-)[^\s'\"\\}},]{{3,}}", r"\1[SECRET:ENV_DEFAULT]"),
    "iso6709_coordinates":
        (r"(^|[^A-Za-z0-9_.])[+-]\d{2,3}\.\d{3,}[+-]\d{2,3}\.\d{3,}(?:[+-]\d+(?:\.\d+)?)?/", r"\1[PII:GPS_COORDINATES]"),
    "url_basic_auth":
        (r"\b([a-z][a-z0-9+.-]*://)[^/\s:@]+:[^/\s:@]+@[^\s'\"<>`)}\]]*", r"\1[SECRET:BASIC_AUTH]"),
    "api_key_json_field":
        (r'(?i)((?:\\?")api[_-]?key(?:\\?")\s*:\s*(?:\\?"))[^\\"\[{][^\\"]*((?:\\?"))', r"\1[SECRET:API_KEY_FIELD]\2"),
    "api_key_assignment":
        (r"(?i)\b(api[_-]?key|apikey)\s*=\s*(?:'[^\s'\"\\\[{][^\s'\"\\]{2,}'|\"[^\s'\"\\\[{][^\s'\"\\]{2,}\"|[^\s'\"\\\[{][^\s'\"\\]{2,})",
         r"\1=[SECRET:API_KEY_FIELD]"),
    "private_term": (r"(?i)(^|[^A-Za-z0-9_])(?:<<terms>>)\b", r"\1[PRIVATE_TERM]"),
}


def re2(pattern: str) -> str:
    out, in_class, i = [], False, 0
    while i < len(pattern):
        c, pair = pattern[i], pattern[i:i + 2]
        if pair == r"\s":
            out.append(_SPACE if in_class else f"[{_SPACE}]")
        elif pair == r"\d":
            out.append(r"\p{Nd}")
        elif c == "\\":
            out.append(pair)
        else:
            in_class = (c == "[") or (in_class and c != "]")
            out.append(c)
        i += 2 if c == "\\" else 1
    return "".join(out)


def quote(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def placeholder_sql(tag: str, value: str) -> str:
    return f"'[{tag}:0000:' || substr(sha256({value}), 1, 10) || ']'"


def weave_sql(text: str, pattern: str, repl: str) -> str:
    """Replace every match by an expression over ``m[i]``."""
    p = quote(pattern)
    return (f"CASE WHEN regexp_matches({text}, {p}) THEN "
            f"array_to_string(list_transform(range(1, len(string_split_regex({text}, {p})) + 1), lambda i: "
            f"string_split_regex({text}, {p})[i] || CASE WHEN i <= len(regexp_extract_all({text}, {p})) "
            f"THEN {repl.replace('m[i]', f'regexp_extract_all({text}, {p})[i]')} ELSE '' END), '') ELSE {text} END")


def chain(policy: Policy, source: str, columns: str, text: str, allowed=None, name: str = "red",
          counts: bool = False) -> str:
    """CTEs that apply the catalog to ``text``; the last one is ``name``.

    With ``counts`` every rule adds a column ``n_<category>`` counted on the
    text as the rule sees it.
    """
    ctes, previous = [f"{name}_0 AS (SELECT {columns}, {text} AS t FROM {source})"], f"{name}_0"
    for number, (category, pattern, replacement) in enumerate(catalog.REDACTION_RULES, 1):
        pattern, replacement = OVERRIDES.get(category, (pattern, replacement))
        pattern = _fill(pattern, policy)
        if pattern is None:
            continue
        pattern = re2(pattern)
        if category == "pi_encoded_path_component":
            repl = (f"regexp_extract(m[i], {quote(pattern)}, 1) || "
                    + placeholder_sql(category.upper(), f"regexp_extract(m[i], {quote(pattern)}, 2)"))
            new = weave_sql("t", pattern, repl)
        elif replacement is None:
            repl = placeholder_sql(category.upper(), "m[i]")
            if category == "url" and allowed:
                repl = f"CASE WHEN {allowed_sql('m[i]', allowed)} THEN m[i] ELSE {repl} END"
            new = weave_sql("t", pattern, repl)
        else:
            new = f"regexp_replace(t, {quote(pattern)}, {quote(replacement)}, 'g')"
        extra = f", len(regexp_extract_all(t, {quote(pattern)})) AS n_{category}" if counts else ""
        ctes.append(f"{name}_{number} AS (SELECT * REPLACE ({new} AS t){extra} FROM {previous})")
        previous = f"{name}_{number}"
    ctes.append(f"{name} AS (SELECT * FROM {previous})")
    return ",\n".join(ctes)


def host_sql(url: str) -> str:
    return f"rtrim(lower(regexp_extract({url}, '(?i)^https?://([^/:?#]+)', 1)), '.')"


def allowed_sql(url: str, domains) -> str:
    h = host_sql(url)
    return "(" + " OR ".join(f"{h} = '{d}' OR ends_with({h}, '.{d}')" for d in domains) + ")"

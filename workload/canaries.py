"""Canary texts as SQL expressions over ``event_id``; the same strings in Spark and DuckDB.

Values are put together from pieces so that no file holds a secret-like text.
"""

ID = "cast(event_id as string)"

# category -> (positive, near miss)
CANARIES = {
    "private_key": ("concat('-----BEGIN TEST PRI', 'VATE KEY-----', chr(10), repeat('A', 40), chr(10), '-----END TEST PRI', 'VATE KEY-----')", "concat('-----BEGIN TEST PRI', 'VATE KEY-----')"),
    "pi_encoded_path_component": (f"concat('--home-u', {ID}, '-proj--')", "'--ab'"),
    "authorization_bearer": ("concat('Authorization: Bearer ', repeat('k', 12))", "'Authorization: Basic x'"),
    "bearer_token": ("concat('bearer ', repeat('k', 12))", "'bearer bond'"),
    "env_secret_assignment": ("concat('MY_TOKEN=', repeat('v', 10))", "'MY_TOKEN=short'"),
    "env_secret_quoted": ("concat('MY_TOKEN = \"', repeat('v', 10), '\"')", "'MY_TOKEN = \"v\"'"),
    "env_secret_default": ("concat('DB_PASSWORD: ', '$', '{DBP:-', repeat('p', 6), '}')", "'DB_HOST: x'"),
    "env_secret_colon_default": ("concat('DB_SECRET:-', repeat('s', 6))", "'DB_NAME:-abc'"),
    "openai_key": ("concat('sk', '-', repeat('o', 24))", "'sk-'"),
    "short_sk_key": ("concat('sk', '-', repeat('o', 8))", "'sk-abc'"),
    "anthropic_key": ("concat('sk', '-ant-', repeat('n', 24))", "'sk-ant'"),
    "github_token": ("concat('gh', 'p_', repeat('g', 24))", "'ghx_abc'"),
    "huggingface_token": ("concat('h', 'f_', repeat('h', 24))", "'hf_short'"),
    "google_api_key": ("concat('AI', 'za', repeat('z', 32))", "'AIza1'"),
    "aws_access_key": ("concat('AK', 'IA', repeat('Q', 16))", "concat('AK', 'IA', repeat('Q', 15))"),
    "jwt": ("concat('ey', 'J', repeat('a', 12), '.', repeat('b', 12), '.', repeat('c', 12))", "concat('ey', 'J', repeat('a', 12), '.', repeat('b', 12))"),
    "password_hash": ("concat('$2', 'b$10$', repeat('x', 53))", "concat('$2', 'b$10$', repeat('x', 52))"),
    "ssh_public_key": ("concat('ssh-', 'rsa ', repeat('A', 44), ' me@box')", "concat('ssh-', 'rsa ', repeat('A', 39))"),
    "iban": ("concat('ZZ', '00', repeat('7', 16))", "'ZZ00123'"),
    "quicktime_location_iso6709": ("'com.apple.quicktime.location.ISO6709: +10.1234+020.5678/'", "'com.apple.quicktime.location.ISO6709:'"),
    "quicktime_location_accuracy": ("'com.apple.quicktime.location.accuracy.horizontal: 4.5'", "'com.apple.quicktime.location.accuracy.horizontal:'"),
    "iso6709_coordinates": ("'+10.1234+020.5678/'", "'+10.1234+020.5678'"),
    "latlon_coordinates": ("'10.12345, 20.12345'", "'10.1234, 20.1234'"),
    "street_address": ("'12 Elm Tree Road'", "'12 elm tree road'"),
    "ipv6": ("'2001:db8:1:2:3:4:5:6'", "'2001:db8::1'"),
    "mac_address": ("'0a-1b-2c-3d-4e-5f'", "'0a-1b-2c'"),
    "bluetooth_path": ("'/org/bluez/hci0/x'", "'/org/other'"),
    "airpods_pro": ("'AirPods Pro'", "'AirPods'"),
    "scarlett_solo": ("'Scarlett Solo'", "'Scarlett'"),
    "focusrite_device": ("'Focusrite_USB,'", "'Focus rite'"),
    "url_basic_auth": ("'ftp://u:p@h'", "'ftp://h'"),
    "database_url": ("'redis://h/0'", "'sqlite:x'"),
    "opencode_share_url": ("'https://opncd.ai/share/x1'", "'opncd.ai/share'"),
    "private_url": ("'http://192.168.1.2/a'", "'192.168.1'"),
    "url": (f"concat('https://h', {ID}, '.example.org/p')", "'example.org/p'"),
    "api_key_json_field": ("'\"api_key\": \"abc\"'", "'\"api\": \"abc\"'"),
    "api_key_assignment": ("'api_key = abc'", "'api_key = ab'"),
    "contextual_phone": ("'phone: +99 000 000 0000'", "'+99 000 000 0000'"),
    "email": (f"concat('m', {ID}, '@example.org')", "'m@localhost'"),
    "user_at_host": ("'canuser@box'", "'other@box'"),
    "user_at_literal": ("'canuser@ '", "'other@ '"),
    "ipv4": ("'10.0.0.7'", "'10.0.7'"),
    "encoded_home_path": ("'x--home-canuser-a--'", "'home-a'"),
    "encoded_home_path_literal": ("'--home-canuser'", "'--home'"),
    "private_domain": ("'a.corp.test'", "'corp.test2'"),
    "private_term_domain": ("'x.canuserlab.test'", "'x.lab.test'"),
    "private_term": ("'Canuser'", "'canvas'"),
    "private_term_compound": ("'my_canuser_dir'", "'my_can_dir'"),
    "redacted_literal": ("'REDACTED'", "'REDACTEDX'"),
    "generic_home_path": (f"concat('/home/other/', {ID}, '.txt')", "'/homes/'"),
    "home_path": ("'~/a'", "'/root'"),
    "mac_home_path": ("'/Users/other/a'", "'/Users'"),
    "ssh_remote": (f"concat('box:team/repo', {ID}, '.git')", "'box:team/repo'"),
}

P = f"lpad({ID}, 8, '0')"

# (text, rules of the scan that find something in it, with what they find; None: the whole text)
PLANTS = [
    ("'~canuser'", {"home_path_content": None, "private_user_name": "'canuser'", "private_user_compound": "'canuser'"}),
    (f"concat('/home/u', {P})", {"generic_home_path_content": None}),
    ("'--home-canuser'", {"encoded_home_path_content": None, "private_user_name": "'canuser'", "private_user_compound": "'home-canuser'"}),
    (f"concat('--p-', {P}, '--')", {"generic_pi_encoded_path": None}),
    ("'canuser@box'", {"user_at_host": "'canuser@'", "private_user_name": "'canuser'", "private_user_compound": "'canuser'"}),
    (f"concat('my_canuser_', {P})", {"private_user_compound": None}),
    (f"concat('x', {P}, '.canuser.test')", {"private_user_domain": None, "private_user_compound": None, "private_user_name": "'canuser'"}),
    (f"concat('https://opncd.ai/share/', {P})", {"opencode_share_url": None, "url": None}),
    (f"concat('http://192.168.1.2/', {P})", {"private_rfc1918_url": None, "url": None, "ipv4": "'192.168.1.2'"}),
    (f"concat('2001:db8:', substr({P}, 5, 4), ':1:2:3:4:5')", {"ipv6": None}),
    (f"concat('/org/bluez/hci', {P})", {"bluetooth_path": None}),
    (f"concat('ssh-', 'rsa ', repeat('A', 40), {P})", {"ssh_public_key": None}),
    (f"concat('$2', 'b$10$', repeat('x', 45), {P})", {"password_hash": None}),
    (f"concat('sk', '-', repeat('o', 16), {P})", {"openai_key": None, "short_sk_key": None}),
    (f"concat('sk', '-', {P})", {"short_sk_key": None}),
    (f"concat('sk', '-ant-', repeat('n', 16), {P})", {"openai_key": None, "short_sk_key": None, "anthropic_key": None}),
    (f"concat('gh', 'p_', repeat('g', 16), {P})", {"github_token": None}),
    (f"concat('h', 'f_', repeat('h', 16), {P})", {"hf_token": None}),
    (f"concat('AI', 'za', repeat('z', 24), {P})", {"google_key": None}),
    (f"concat('AK', 'IA', repeat('Q', 8), {P})", {"aws_key": None}),
    (f"concat('BEGIN R', {P}, ' PRI', 'VATE KEY')", {"private_key": None}),
    (f"concat('Bearer ', repeat('k', 16), {P})", {"long_bearer": None}),
    (f"concat('m', {P}, '@example.org')", {"email": None}),
    (f"concat('api', '_key = ', repeat('k9-', 4), {P})", {"api_key_field_value": None}),
    (f"concat('\"encrypted_content\": \"', {P}, '\"')", {"encrypted_content_field": None}),
    (f"concat('\"thinkingSignature\": \"', {P}, '\"')", {"thinking_signature_field": None}),
    (f"concat('com.apple.quicktime.location.ISO6709: +10.', {P}, '+020.5678/')",
     {"quicktime_location_iso6709": None, "iso6709_coordinates": f"concat('+10.', {P}, '+020.5678/')"}),
    (f"concat('h', {P}, '.corp.test')", {"private_domain": None}),
    # What the filters leave out: names as keys, short names, code, placeholders, clock times, local addresses.
    ("'\"canuser\": 1'", {}),
    ("'x@example.org'", {}),
    (f"concat('m', {P}, '@app.example.org')", {}),
    ("'api_key = process_env_value'", {}),
    ("concat('api', '_key = ', repeat('k', 20))", {}),
    ("'\"encrypted_content\": \"[REDACTED:X]\"'", {}),
    ("'[PRIVATE_USER] [URL:0001:0123456789]'", {}),
    ("'10:20:30 and 1:2:3:4'", {}),
    ("'127.0.0.1 0.0.0.7'", {}),
]


def planted_text() -> str:
    """SQL: every event gets one plant, by its number."""
    branches = " ".join(f"when {i} then {text}" for i, (text, _) in enumerate(PLANTS))
    return f"concat('row ', {ID}, ' ', case event_id % {len(PLANTS)} {branches} end, ' end')"


def planted_hits() -> str:
    """SQL: (event_id, name, match) of what must be found."""
    return " UNION ALL ".join(
        f"SELECT event_id, '{name}' AS name, {found or text} AS match FROM events WHERE event_id % {len(PLANTS)} = {i}"
        for i, (text, hits) in enumerate(PLANTS) for name, found in hits.items())


def canary_text(near_miss: bool = False) -> str:
    """SQL: every event gets one canary, by its number."""
    values = [v[1 if near_miss else 0] for v in CANARIES.values()]
    branches = " ".join(f"when {i} then {v}" for i, v in enumerate(values))
    return f"concat('row ', {ID}, ' ', case event_id % {len(values)} {branches} end, ' end')"

"""Find, redact, pseudonymise and verify sensitive values with Spark."""

from palimpsest.operators.frames import redact_frame
from palimpsest.operators.json_records import json_leaves, redact_json
from palimpsest.operators.text import detect, matches, redact_path, redact_text
from palimpsest.plans.sanitize import sanitize
from palimpsest.plans.verify import verify
from palimpsest.policy import Policy

__all__ = ["Policy", "detect", "json_leaves", "matches", "redact_frame", "redact_json", "redact_path",
           "redact_text", "sanitize", "verify"]

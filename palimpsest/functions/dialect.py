"""Python regular-expression syntax to Java's, with Python's Unicode classes.

Java's ``\\b``, ``\\d`` and ``\\s`` are ASCII by default (and the boundary
changed between JDK releases), so the classes are spelled out: the same text
then matches on every JDK and as Python's ``re`` would match it.
"""

from __future__ import annotations

import re

WORD = r"[\p{L}\p{N}_]"
SPACE = r"\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
BOUNDARY = rf"(?:(?<={WORD})(?!{WORD})|(?<!{WORD})(?={WORD}))"

# Words only on the right-hand side, so that a boundary is "no word before".
_STARTS_WITH_WORD = re.compile(
    r"\\b(?=\(*(?:\?:\(*)?(?:[A-Za-z0-9]|\\d|\[(?:[A-Za-z0-9]-[A-Za-z0-9]|[A-Za-z0-9_]|\\d)+\]))"
)


def java_regex(pattern: str, trusted: bool = False) -> str:
    """Java form of a Python pattern.

    ``trusted`` patterns (the catalog's) may start an alternation right after
    a word boundary only with word characters, which allows a cheaper
    boundary test there.
    """
    if trusted:
        pattern = _STARTS_WITH_WORD.sub(lambda m: "\0", pattern)
    out, in_class, i = ["(?d)"], False, 0
    while i < len(pattern):
        c, pair = pattern[i], pattern[i:i + 2]
        if c == "\0":
            out.append(f"(?<!{WORD})")
        elif pair == r"\b" and not in_class:
            out.append(BOUNDARY)
        elif pair == r"\d":
            out.append(r"\p{Nd}")
        elif pair == r"\s":
            out.append(SPACE if in_class else f"[{SPACE}]")
        elif c == "\\":
            out.append(pair)
        elif c == "[" and in_class:
            out.append(r"\[")
        else:
            in_class = (c == "[") or (in_class and c != "]")
            out.append(c)
        i += 2 if c == "\\" else 1
    return "".join(out).replace("(?i)", "(?iu)").replace("(?i:", "(?iu:")


def java_replacement(replacement: str) -> str:
    """Group references as Java writes them."""
    return re.sub(r"\\(\d)", r"$\1", replacement)


def alternation(literals) -> str:
    return "|".join(re.escape(x) for x in literals)

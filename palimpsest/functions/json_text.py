"""Strings inside JSON text, without leaving the JVM.

In valid JSON every quote that is not escaped starts or ends a string, so one
regular expression cuts a record into structure (kept as it is, blanks
removed) and string literals (decoded, mapped, encoded again).  Records that
need a real parser - repeated keys, NaN, containers under a sensitive key -
go through a small vectorised helper first.
"""

from __future__ import annotations

import json
import sys

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from palimpsest.catalog import SENSITIVE_FIELD
from palimpsest.functions.expr import apply_sql, json_quote, let

# Executors get the helper's code with the task and need not have the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: One JSON string; possessive, so that long strings need no Java stack.
LITERAL = r'"[^"\\]*+(?:\\.[^"\\]*+)*+"'


def is_json(raw: Column) -> Column:
    """The whole text is one JSON value.

    The parser ignores what follows a value.  Inside an array, in front of a
    mark that the text cannot hold (its own digest), nothing may follow it.
    """
    mark = F.md5(raw.cast("binary"))
    held = F.try_parse_json(F.concat(F.lit("["), raw, F.lit(',"'), mark, F.lit('"]')))
    return F.coalesce(F.try_variant_get(held, "$[1]", "string") == mark, F.lit(False))


def json_tokens(raw: Column) -> Column:
    """``struct<gaps, strings, keys>`` of valid JSON text.

    ``gaps[i]`` is the structure before string ``i``; there is one more gap
    than strings.  ``keys[i]`` tells whether string ``i`` is an object key.
    """
    gaps = F.transform(F.split(raw, LITERAL, -1), lambda g: F.regexp_replace(g, r"[ \t\r\n]+", ""))
    literals = F.regexp_extract_all(raw, F.lit(LITERAL), F.lit(0))
    strings = F.from_json(F.concat(F.lit("["), F.array_join(literals, ","), F.lit("]")), "array<string>")
    return let(gaps, lambda g: F.struct(
        g.alias("gaps"), strings.alias("strings"),
        F.transform(F.slice(g, F.lit(2), F.size(g)), lambda x: F.startswith(x, F.lit(":"))).alias("keys")))


def join_tokens(gaps: Column, strings: Column) -> Column:
    return F.array_join(F.zip_with(gaps, F.transform(strings, json_quote),
                                   lambda g, s: F.concat(g, F.coalesce(s, F.lit("")))), "")


def key_before(tokens: Column) -> Column:
    """For every string: the key it is the direct value of, else null."""
    return F.transform(tokens["strings"], lambda s, i: F.when(
        (i > 0) & (~tokens["keys"][i]) & (F.get(tokens["gaps"], i) == ":"), F.get(tokens["strings"], i - 1)))


class _Number(str):
    """A number kept as it was written."""


def _read(raw, pairs):
    return json.loads(raw, parse_float=_Number, parse_int=_Number, parse_constant=_Number,
                      object_pairs_hook=pairs)


def _write(value) -> str:
    if isinstance(value, _Number):
        return str(value)
    if isinstance(value, dict):
        return "{" + ",".join(f"{_write(k)}:{_write(v)}" for k, v in value.items()) + "}"
    if isinstance(value, list):
        return "[" + ",".join(map(_write, value)) + "]"
    return json.dumps(value, ensure_ascii=False)


def canonical_json():
    """Vectorised helper: compact JSON, last repeated key wins, null if malformed.

    ``hidden`` lists the record's keys whose container values are replaced by
    the sensitive-field placeholder.
    """
    @F.pandas_udf(T.StringType())
    def canonical(raw: pd.Series, hidden: pd.Series) -> pd.Series:
        def one(text, keys):
            if text is None:
                return None
            keys = set() if keys is None else set(keys)
            def pairs(items):
                return {k: (_hidden(v) if k in keys else v) for k, v in items}
            def _hidden(v):
                return SENSITIVE_FIELD if isinstance(v, (dict, list)) else v
            try:
                return _write(_read(text, pairs))
            except (ValueError, RecursionError):
                return None
        return pd.Series([one(t, k) for t, k in zip(raw, hidden)], dtype=object)
    # Keeps the optimizer from copying the call into other expressions.
    return canonical.asNondeterministic()


_FRAME = "struct<obj:boolean,idx:int,key:string>"
_LEAF = "struct<at:int,path:string,key:string,value:string,named:boolean>"

# One structure character: containers open and close, a comma moves on inside an array.
_MARK = ("(st, c) -> CASE c WHEN '{' THEN concat(st, array(named_struct('obj', true, 'idx', 0, 'key', cast(null AS string)))) "
         "WHEN '[' THEN concat(st, array(named_struct('obj', false, 'idx', 0, 'key', cast(null AS string)))) "
         "WHEN ',' THEN if(size(st) = 0 OR element_at(st, -1).obj, st, concat(slice(st, 1, size(st) - 1), "
         "array(named_struct('obj', false, 'idx', element_at(st, -1).idx + 1, 'key', cast(null AS string))))) "
         "ELSE if(size(st) = 0, st, slice(st, 1, size(st) - 1)) END")
_PATH = "concat('$', array_join(transform(st, f -> if(f.obj, concat('.', coalesce(f.key, '')), concat('[', f.idx, ']'))), ''))"
# The key of the innermost object, also from inside its arrays.
_KEY = "try_element_at(filter(st, f -> f.obj), -1).key"
_STEP = (f"(acc, x) -> transform(array(aggregate(x.marks, acc.stack, {_MARK})), st -> if(x.named, "
         "transform(array(concat(slice(st, 1, size(st) - 1), array(named_struct('obj', true, 'idx', 0, 'key', x.text)))), st -> named_struct("
         f"'stack', st, 'found', concat(acc.found, array(named_struct('at', x.at, 'path', {_PATH}, 'key', x.text, 'value', x.text, 'named', true)))))[0], "
         f"named_struct('stack', st, 'found', concat(acc.found, array(named_struct('at', x.at, 'path', {_PATH}, 'key', {_KEY}, 'value', x.text, 'named', false))))))[0]")
_WALK = (f"v -> aggregate(v, named_struct('stack', cast(array() AS array<{_FRAME}>), 'found', cast(array() AS array<{_LEAF}>)), {_STEP}, acc -> acc.found)")


def is_json_structure(raw: Column) -> Column:
    """Like :func:`is_json`, and also with repeated keys and the numbers NaN and Infinity, as lenient parsers read them.

    The reader behind ``get_json_object`` builds no value, so keys may repeat; what it
    accepts beyond the standard (single quotes) is refused by a look at the structure.
    """
    mark = F.md5(raw.cast("binary"))
    plain = F.regexp_replace(raw, rf"({LITERAL})|(?<![\w.])-?Infinity(?!\w)|(?<!\w)NaN(?!\w)", "$1")
    # a number that was cut out leaves nothing behind: put a zero where a value is missing
    filled = F.regexp_replace(plain, r"([:\[,])([ \t\r\n]*)(?=[,\]}])", "$1$20")
    odd = F.when(raw.rlike("NaN|Infinity"), F.when(F.trim(plain) == "", F.lit("0")).otherwise(filled)).otherwise(raw)
    held = F.get_json_object(F.concat(F.lit("["), odd, F.lit(',"'), mark, F.lit('"]')), "$[1]")
    quoted = F.contains(F.array_join(F.split(raw, LITERAL, -1), " "), F.lit("'"))
    return F.coalesce((held == mark) & ~quoted, F.lit(False))


def json_leaf_array(raw: Column) -> Column:
    """``array<struct<path, key, value>>``: the string values of JSON text in text order; null if it is none.

    A fold over the structure between strings keeps the stack of open containers.  Of
    repeated keys the last one counts: what stands below an earlier one is left out.
    """
    valid = is_json(raw) | (~F.coalesce(F.trim(raw) == "", F.lit(True)) & is_json_structure(raw))

    def steps(t):
        return F.zip_with(F.arrays_zip(t["strings"].alias("text"), t["keys"].alias("named")),
                          F.transform(F.slice(t["gaps"], F.lit(1), F.size(t["strings"])), lambda g, i: F.struct(i.alias("at"), F.filter(
                              F.split(F.regexp_replace(g, r"[^\[\]{},]+", ""), ""), lambda c: c != "").alias("marks"))),
                          lambda x, g: F.struct(g["at"].alias("at"), g["marks"].alias("marks"), x["text"].alias("text"), x["named"].alias("named")))

    walked = apply_sql(F.when(valid, let(json_tokens(raw), steps)), _WALK)

    def leaves(found):
        values = F.filter(found, lambda x: ~x["named"])
        names = F.transform(F.filter(found, lambda x: x["named"]), lambda x: x["path"])
        later = F.filter(found, lambda x: x["named"])
        # a name that comes again: everything at or below its path before that place goes
        shown = F.filter(values, lambda x: ~F.exists(later, lambda k: (k["at"] > x["at"]) & (
            (k["path"] == x["path"]) | F.startswith(x["path"], F.concat(k["path"], F.lit("."))) | F.startswith(x["path"], F.concat(k["path"], F.lit("["))))))
        kept = F.when(F.size(F.array_distinct(names)) == F.size(names), values).otherwise(shown)
        return F.transform(kept, lambda x: F.struct(x["path"].alias("path"), x["key"].alias("key"), x["value"].alias("value")))
    return let(walked, leaves)

"""JSON value sequences.

The reference reads a file as a stream of JSON values with whitespace between
them; each must be an object (or ``null`` → an empty record). Spark's line
readers silently drop whatever follows the first value on a line, so:

* ``strict_object_line`` decides per line, JVM-side, whether the line is
  exactly one JSON object (or ``null``). Files whose lines all pass take the
  fast path (``from_json`` per line).
* ``split_values`` is the small per-file helper for the rest (values spanning
  lines, several values per line, duplicate keys): a decode loop that yields
  each value's compact text or raises for the whole file.
"""

from __future__ import annotations

import json
import math
import re

from pyspark.sql import Column
from pyspark.sql import functions as F

BIG_EXPONENT = r"[0-9][eE][+-]?[0-9]{3,}"
_WS = re.compile(r"[ \t\n\r]*")


def _sentinel(line: Column, nonce: str | None) -> Column:
    # a value the line itself cannot contain: a fresh random nonce, or the
    # line's own SHA-256 when none is given
    return F.lit(nonce) if nonce else F.sha2(line, 256)


def _wrapped(line: Column, nonce: str | None = None) -> Column:
    # '[' line ',"<sentinel>"]' parses as a 2-array only when line is one value
    return F.try_parse_json(F.concat(F.lit("["), line, F.lit(',"'), _sentinel(line, nonce), F.lit('"]')))


def strict_object_line(line: Column, nonce: str | None = None) -> Column:
    """True iff the line is exactly one JSON object or ``null`` (never null).

    With ``nonce`` (random per batch, unknown to whoever wrote the file) no
    per-line hash is needed; without it the line's SHA-256 is the sentinel.
    """
    p = _wrapped(line, nonce)
    one = F.try_variant_get(p, "$[1]", "string") == _sentinel(line, nonce)
    t = F.schema_of_variant(F.try_variant_get(p, "$[0]", "variant"))
    ok = one & (t.startswith("OBJECT") | (t == F.lit("VOID"))) & ~line.rlike(BIG_EXPONENT)
    return F.coalesce(ok, F.lit(False))


def line_record(line: Column) -> Column:
    """map<string,string> of a strict line; ``null`` gives an empty map."""
    empty = F.create_map().cast("map<string,string>")
    return F.coalesce(F.from_json(line, "map<string,string>"), empty)


def is_blank(line: Column) -> Column:
    return line.rlike(r"^[ \t\r\n]*$")


def _no_constant(name):
    raise ValueError(f"invalid JSON constant {name}")


def _finite_float(text):
    v = float(text)
    if math.isinf(v) or math.isnan(v):
        raise ValueError(f"number out of range: {text}")
    return v


def _last_wins(pairs):
    return dict(pairs)


def _decoder() -> json.JSONDecoder:
    # built per call: decoder objects do not pickle, functions here ship by value
    return json.JSONDecoder(parse_constant=_no_constant, parse_float=_finite_float,
                            object_pairs_hook=_last_wins)


def split_values(text: str) -> list[str]:
    """All values of a JSON text stream as compact JSON object texts.

    ``null`` gives ``{}``; any other non-object value, or any syntax error,
    raises ``ValueError`` (the whole file fails).
    """
    out = []
    dec = _decoder()
    pos = _WS.match(text, 0).end()
    n = len(text)
    while pos < n:
        try:
            v, end = dec.raw_decode(text, pos)
        except json.JSONDecodeError as e:
            raise ValueError(f"invalid JSON at offset {e.pos}: {e.msg}") from None
        if v is None:
            v = {}
        if not isinstance(v, dict):
            raise ValueError(f"top-level value is a {type(v).__name__}, not an object")
        out.append(json.dumps(v, separators=(",", ":"), ensure_ascii=False))
        pos = _WS.match(text, end).end()
    return out

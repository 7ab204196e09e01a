"""String-level column functions: exposition tokens, strict JSON, byte text."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Numeric literal accepted by Python's float(): optional sign, decimal or
# exponent form with single underscores between digits, or the words
# nan / inf / infinity in any case.  Java-style suffixes ("1.0d") and hex are
# rejected, which Spark's cast alone would not do.
_DIGITS = r"\d(?:_?\d)*"
FLOAT_PATTERN = (
    rf"^[+-]?(?:(?:{_DIGITS}(?:\.(?:{_DIGITS})?)?|\.{_DIGITS})(?:[eE][+-]?{_DIGITS})?"
    r"|(?i:nan|inf|infinity))$"
)


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value found once per row.  The optimizer prunes a
    parse for each field that is taken of it, and then parses once a field; it
    doesn't look behind the variable of a lambda."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def py_float(text: Column | str) -> Column:
    """``float(text)`` or NULL when Python would raise (S1 value parse)."""
    t = F.trim(_c(text))
    return F.when(t.rlike(FLOAT_PATTERN), F.replace(t, F.lit("_"), F.lit("")).try_cast("double"))


# What Python's str.strip() removes: every character that is white space to it.
PY_SPACE = "".join(c for c in map(chr, range(0x3001)) if c.isspace())


def strip(text: Column | str) -> Column:
    """``text.strip()``."""
    return F.trim(_c(text), F.lit(PY_SPACE))


def line_tokens(line: Column | str) -> Column:
    """Whitespace split of a line like Python's ``str.split()``."""
    t = strip(line)
    return F.when(t == "", F.array().cast("array<string>")).otherwise(F.split(t, r"\s+"))


def metric_name(first_token: Column) -> Column:
    """Metric name = first token up to the first ``{``."""
    return F.substring_index(first_token, "{", 1)


def utf8_repair(raw: Column | str) -> Column:
    """Bytes or text to valid UTF-8, invalid sequences replaced by U+FFFD."""
    return F.make_valid_utf8(_c(raw))


def truncate(text: Column | str, n: int = 200) -> Column:
    """First ``n`` characters (P25)."""
    return F.substring(_c(text), 1, n)


# Fixed unit names for byte formatting (must equal the reference's output).
BYTE_UNITS = ["B", "KB", "MB", "GB", "TB"]


def format_bytes(n: Column | str) -> Column:
    """Human-readable size of an integer byte count.

    Divide by 1024 while the value is >= 1024 (B, KB, MB, GB, TB, then PB) and
    print two decimals.  The rounding is exact round-half-even on the true
    quotient, done in integer arithmetic, so ties such as 1152 B = 1.125 KB
    print as ``1.12 KB`` exactly like Python's ``format`` and unlike Java's
    ``%.2f`` (half-up).
    """
    v = _c(n).cast("decimal(38,0)")
    unit_idx = F.lit(len(BYTE_UNITS))  # PB
    for i in reversed(range(len(BYTE_UNITS))):
        unit_idx = F.when(v < F.lit(1024 ** (i + 1)).cast("decimal(38,0)"), F.lit(i)).otherwise(unit_idx)
    units = F.array(*[F.lit(u) for u in BYTE_UNITS + ["PB"]])
    denom = F.pow(F.lit(1024), unit_idx).cast("decimal(38,0)")
    num = F.abs(v) * F.lit(100).cast("decimal(38,0)")
    r = num % denom
    q = ((num - r) / denom).cast("decimal(38,0)")  # exact: num - r is a multiple
    half_up = (r * 2 > denom) | ((r * 2 == denom) & (q % 2 == 1))
    cents = (q + F.when(half_up, 1).otherwise(0)).cast("decimal(38,0)")
    whole = ((cents - cents % 100) / 100).cast("decimal(38,0)").cast("string")
    frac = F.lpad((cents % 100).cast("int").cast("string"), 2, "0")
    sign = F.when(v < 0, F.lit("-")).otherwise(F.lit(""))
    return F.concat(sign, whole, F.lit("."), frac, F.lit(" "), F.element_at(units, unit_idx + 1))


def _sentinel(t: Column, probe: str, use: Callable[[Column, Column], Column]) -> Column:
    """``use(parsed, ok)`` of a parse of ``{"x":<t>,"__end":true}``, one a text.

    Spark's JSON reader accepts trailing text after a complete value; the
    sentinel field after the candidate turns that into a strict check.  With
    default options single quotes are accepted; with an options map trailing
    commas are accepted instead.  So the default parse decides, and only text
    that contains a single quote is parsed a second time with
    ``allowSingleQuotes=false``.  A parse that breaks inside a value goes on
    after it and says so in ``_corrupt_record``.
    """
    wrapped = F.concat(F.lit('{"x":'), t, F.lit(',"__end":true}'))
    strict = F.from_json(wrapped, "__end boolean", {"allowSingleQuotes": "false"})["__end"].isNotNull()

    def judged(a: Column) -> Column:
        ok = a["__end"].isNotNull() & a["_corrupt_record"].isNull()
        return use(a, ok & F.when(t.contains("'"), strict).otherwise(F.lit(True)))

    return bound(F.from_json(wrapped, f"{probe}__end boolean, _corrupt_record string"), judged)


def strict_json_object(text: Column | str) -> Column:
    """``MAP<STRING,STRING>`` when the *whole* text is one JSON object, else NULL
    (Python ``json.loads`` strictness; nested values kept as JSON text)."""
    t = _c(text)
    return F.when(t.startswith("{"), _sentinel(t, "x map<string,string>, ", lambda a, ok: F.when(ok, a["x"])))


def strict_json_value(text: Column | str) -> Column:
    """True when the whole text is exactly one JSON value of any kind."""
    t = _c(text)
    return F.coalesce((F.trim(t) != "") & _sentinel(t, "", lambda a, ok: ok), F.lit(False))

"""Tag / attribute predicates over span attributes and trace search results."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def tag_string_to_map(tags: Column | str) -> Column:
    """``"k=v k2=v2"`` to ``MAP<STRING,STRING>`` (P11 query form)."""
    return F.str_to_map(_c(tags), F.lit(" "), F.lit("="))


def tag_json_to_map(tags: Column | str) -> Column:
    """``'{"k":"v"}'`` to ``MAP<STRING,STRING>`` (P12 query form)."""
    return F.from_json(_c(tags), "map<string,string>")


def attrs_match(attrs: Column | str, wanted: Column | Mapping[str, str]) -> Column:
    """Every wanted key is present in ``attrs`` with the wanted value.

    With a literal mapping the result is a plain conjunction of equalities
    (NULL when a key is missing, which a filter treats as false), so Catalyst
    can fold map lookups and push the predicates into the scan.
    """
    a = _c(attrs)
    if isinstance(wanted, Mapping):
        cond = None
        for k, v in wanted.items():
            eq = a[k] == F.lit(v)
            cond = eq if cond is None else cond & eq
        return F.lit(True) if cond is None else cond
    return F.forall(F.map_entries(wanted), lambda e: F.coalesce(a[e["key"]] == e["value"], F.lit(False)))


def kv_array_has(tags: Column, key: str, value: str) -> Column:
    """An ``ARRAY<STRUCT<key,value>>`` holds the pair (used by P14)."""
    return F.exists(tags, lambda t: (t["key"] == F.lit(key)) & (t["value"] == F.lit(value)))


def any_process_has_both(processes: Column | str, a: tuple[str, str], b: tuple[str, str]) -> Column:
    """Nested EXISTS: some single process carries both tags.

    ``processes`` is ``MAP<STRING, STRUCT<tags: ARRAY<STRUCT<key,value>>>>`` as in
    a trace search response.  Both tags must be on the *same* process.
    """
    return F.exists(
        F.map_values(_c(processes)),
        lambda p: kv_array_has(p["tags"], *a) & kv_array_has(p["tags"], *b),
    )


def tags_with_key_containing(tags: Column | str, needle: str = "benchmark") -> Column:
    """Tags whose lower-cased key contains ``needle``."""
    return F.filter(_c(tags), lambda t: F.lower(t["key"]).contains(needle))

"""Series identity (P9) and label derivation (P10) as column expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def series_key(name: Column | str, labels: Column | str) -> Column:
    """Canonical ``name{k="v",...}`` with labels sorted by key.

    Sorting the map entries makes the key independent of map insertion order,
    so it is safe as a grouping / partitioning key.
    """
    name = F.col(name) if isinstance(name, str) else name
    labels = F.col(labels) if isinstance(labels, str) else labels
    pairs = F.transform(
        F.array_sort(F.map_entries(labels)),
        lambda e: F.concat(e["key"], F.lit('="'), e["value"], F.lit('"')),
    )
    return F.concat(name, F.lit("{"), F.array_join(pairs, ","), F.lit("}"))


def known_series_key(name: Column | str, labels: Mapping[str, Column | str]) -> Column:
    """``series_key`` where the label names are known: a plain concat, in the
    order of the names, that stays in generated code."""
    name = F.col(name) if isinstance(name, str) else name
    parts = [name, F.lit("{")]
    for i, (k, c) in enumerate(sorted(labels.items())):
        parts += [F.lit(("," if i else "") + k + '="'), F.col(c) if isinstance(c, str) else c, F.lit('"')]
    return F.concat(*parts, F.lit("}"))


def labels_map(columns: Mapping[str, Column | str]) -> Column:
    """Build a ``MAP<STRING,STRING>`` of labels from named columns."""
    parts: list[Column] = []
    for key, col in columns.items():
        c = F.col(col) if isinstance(col, str) else col
        parts += [F.lit(key), c.cast("string")]
    return F.create_map(*parts)


def label_filter(labels: Column | str, wanted: Mapping[str, str]) -> Column:
    """Conjunction of label equalities (P4), e.g. app AND run id."""
    labels = F.col(labels) if isinstance(labels, str) else labels
    cond = F.lit(True)
    for k, v in wanted.items():
        cond = cond & (labels[k] == F.lit(v))
    return cond


def modulo_label(index: Column | str, prefix: str, modulus: int) -> Column:
    """``prefix-{index % modulus}`` label (P10)."""
    index = F.col(index) if isinstance(index, str) else index
    return F.concat(F.lit(prefix), (index % modulus).cast("string"))


def pick_label(index: Column | str, choices: Sequence[str]) -> Column:
    """Pick ``choices[index % len(choices)]`` (P10)."""
    index = F.col(index) if isinstance(index, str) else index
    arr = F.array(*[F.lit(c) for c in choices])
    return F.element_at(arr, (index % len(choices) + 1).cast("int"))

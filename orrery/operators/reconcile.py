"""What is missing and what is too much, by name, from difference digests.

Each side's ids are added to an invertible Bloom lookup table: an id goes to three
cells, one in each third, and a cell keeps a count and the exclusive or of its
ids' hashes.  One side is subtracted from the other by adding it with the
opposite sign, in the same aggregate, so what is exchanged are cells, not ids;
equal ids cancel.  Cells that hold one id are peeled until none is left.  A tag's
ids are dealt to ranges by hash, a small table each; a range whose difference is
too large to peel is split again, by itself.  The hashes found are then looked up
among the ids.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orrery.session import materialize

#: Cells of a third of a table (a power of two); a table peels some 60 ids.
THIRD_BITS = 5
#: Ranges of a tag at first, and parts that a range is split into.
RANGES, FAN_OUT = 16, 64
ROUNDS = 8
_MASK = (1 << 64) - 1


def _keyed(ids: DataFrame, tag: str, name: str) -> DataFrame:
    """(tag, id, h, g): two independent 64-bit hashes of an id."""
    text = ids.select(F.col(tag).cast("string").alias("tag"), F.col(name).cast("string").alias("id"))
    return text.where(F.col("id").isNotNull()).select("tag", "id", F.xxhash64("id").alias("h"), F.xxhash64("id", F.lit(1)).alias("g"))


def _range(ranges: int) -> Column:
    return F.pmod("g", F.lit(ranges).cast("long"))


def _cells(ids: DataFrame, side: int, ranges: int) -> DataFrame:
    where = F.xxhash64("g", "h")
    third = 1 << THIRD_BITS
    places = F.array(*[F.lit(i * third) + F.shiftright(where, 8 * i).bitwiseAND(F.lit(third - 1).cast("long")) for i in range(3)])
    return ids.select("tag", _range(ranges).alias("range"), F.explode(places).alias("cell"), F.lit(side).cast("long").alias("n"), "h", "g",
                      F.xxhash64("h", "g").alias("check"))


def _chained(first: int, second: int) -> int:
    """Spark's ``xxhash64`` of two longs (given and returned unsigned)."""
    seed = xxhash.xxh64_intdigest(first.to_bytes(8, "little"), 42)
    return xxhash.xxh64_intdigest(second.to_bytes(8, "little"), seed)


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def peel(cells: dict[int, list[int]]) -> tuple[list[tuple[int, int, int]], bool]:
    """(h, g, side) of the ids in a subtracted table {place: [n, h, g, check]},
    numbers unsigned but for n; whether nothing is left."""
    third, found = 1 << THIRD_BITS, []
    todo = list(cells)
    while todo:
        n, h, g, check = cells.get(todo.pop(), (0, 0, 0, 0))
        if abs(n) != 1 or _chained(h, g) != check:
            continue
        found.append((h, g, n))
        where = _chained(g, h)
        for i in range(3):
            place = i * third + (where >> 8 * i & third - 1)
            cell = cells.setdefault(place, [0, 0, 0, 0])
            cells[place] = [cell[0] - n, cell[1] ^ h, cell[2] ^ g, cell[3] ^ check]
            todo.append(place)
    return found, all(c == [0, 0, 0, 0] for c in cells.values())


def _differences(expected: DataFrame, found: DataFrame, ranges: int) -> DataFrame:
    """(tag, range, h, g, side): ids that one side alone has; a row with side 0
    for a range that doesn't peel, and nothing else of that range."""
    both = _cells(expected, 1, ranges).unionByName(_cells(found, -1, ranges))
    cells = both.groupBy("tag", "range", "cell").agg(F.sum("n").alias("n"), *[F.bit_xor(c).alias(c) for c in ("h", "g", "check")])
    cells = cells.where("n <> 0 OR h <> 0 OR g <> 0 OR check <> 0")

    def peeled(group: pd.DataFrame) -> pd.DataFrame:
        tag, at = group["tag"].iloc[0], int(group["range"].iloc[0])
        table = {int(c): [int(n), int(h) & _MASK, int(g) & _MASK, int(k) & _MASK]
                 for c, n, h, g, k in zip(*(group[x] for x in ("cell", "n", "h", "g", "check")), strict=True)}
        rows, whole = peel(table)
        rows = [(tag, at, _signed(h), _signed(g), s) for h, g, s in rows] if whole else [(tag, at, 0, 0, 0)]
        return pd.DataFrame(rows, columns=["tag", "range", "h", "g", "side"])

    return cells.groupBy("tag", "range").applyInPandas(peeled, "tag string, range long, h long, g long, side long")


def lost_and_surplus(expected: DataFrame, found: DataFrame, tag: str, id_col: str, unique: bool = False, ranges: int = RANGES) -> DataFrame:
    """(tag, id, side): ids of ``expected`` that ``found`` lacks (``missing``) and
    the other way round (``surplus``), per tag, as text.

    Each side is a set of (tag, id): repeated rows are merged first unless
    ``unique`` says there are none, in which case nothing is shuffled but cells
    and the difference.  Null ids are on neither side; null tags are a tag.
    RuntimeError after ROUNDS splits, which only ids repeated against ``unique`` cause.
    """
    sides = [_keyed(x, tag, id_col) for x in (expected, found)]
    if not unique:
        sides = [x.distinct() for x in sides]
    parts, rest, done = [], sides, ranges
    for _ in range(ROUNDS):
        got = materialize(_differences(*rest, done), "difference")
        parts.append(got.where("side <> 0").select("tag", "h", "g", "side"))
        open_ = got.where("side = 0").select(F.col("tag").alias("_tag"), F.col("range").alias("_range"))
        if open_.isEmpty():
            break
        rest = [x.join(open_, x.tag.eqNullSafe(F.col("_tag")) & (_range(done) == F.col("_range")), "left_semi") for x in rest]
        done *= FAN_OUT
    else:
        raise RuntimeError("the difference doesn't peel: are ids repeated on a side?")
    differ = parts[0]
    for p in parts[1:]:
        differ = differ.unionByName(p)
    out = []
    for ids, sign, name in zip(sides, (1, -1), ("missing", "surplus"), strict=True):
        mine = differ.where(F.col("side") == sign).select(F.col("tag").alias("_tag"), F.col("h").alias("_h"), F.col("g").alias("_g"))
        same = (F.col("h") == F.col("_h")) & (F.col("g") == F.col("_g")) & F.col("tag").eqNullSafe(F.col("_tag"))
        out.append(ids.join(mine, same, "left_semi").select("tag", "id", F.lit(name).alias("side")))
    return out[0].unionByName(out[1])

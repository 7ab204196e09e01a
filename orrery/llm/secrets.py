"""Secret scans by a trigram inverted index, in DataFrame expressions alone.

Each rule's regular expression gives a Boolean query of trigrams it cannot match
without.  Documents are dealt to segments of a bounded number of ids; a segment's
index lists, for every trigram any rule asks for, the documents that hold it.
Queries intersect and unite those lists; only candidates are matched against the
expression, and rules that require no trigram are matched against every text.
"""

from __future__ import annotations

import functools
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orrery.llm import trigrams
from orrery.llm.util import narrow

#: Document ids of an index segment, about.
SEGMENT = 4096
#: Elements of an array that are scanned into a new one at a time.
RUN = 64


@dataclass(frozen=True)
class Rule:
    """A kind of secret: leftmost non-overlapping matches of ``pattern`` whose
    ``group`` has ``least`` characters or more."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1


BASE = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 16),
    # no trigram in it; matches of fewer characters would fail anyway, and a shorter run holds no longer one
    Rule("hex", r"[0-9a-f]{32,}+", 0, 32),
)
MORE = (
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[0-9A-Za-z_-]{35}"),
    Rule("stripe", r"[sr]k_live_[0-9A-Za-z]{16,}"),
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    # from the begin of a run only, or a run of many begins would be read from each of them
    Rule("jwt", r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{8,}+\.eyJ[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]+"),
)
RULES = BASE + MORE
SPAN = "array<struct<start:int,place:int,end:int,kind:string>>"


def _lists(index: Column, q: trigrams.Query) -> Column:
    """Ids of a segment that satisfy a query, from its map trigram -> ids."""
    if isinstance(q, str):
        return F.coalesce(F.try_element_at(index, F.lit(q)), F.array().cast("array<long>"))
    op = F.array_intersect if q[0] == "and" else F.array_union
    return functools.reduce(op, [_lists(index, p) for p in q[1]])


def candidates(rows: DataFrame, rules: tuple[Rule, ...], segment: int = SEGMENT) -> DataFrame:
    """(doc_id, kinds) of documents whose trigrams satisfy the query of a rule.

    ``rows`` has doc_id and text.  Ids that repeat are one entry of a list (what
    any of their texts holds); null ids are not listed.
    """
    queries = {r.kind: q for r in rules if (q := trigrams.query(r.pattern)) is not None}
    asked = sorted(set().union(*(trigrams.grams(q) for q in queries.values()), set()))
    if not asked:
        return rows.select("doc_id", F.array().cast("array<string>").alias("kinds")).limit(0)
    segments = F.lit(max(1, -(-rows.count() // segment)))
    low = rows.where("doc_id IS NOT NULL").select("doc_id", F.lower("text").alias("low"))
    there = low.select("doc_id", F.explode(F.array_compact(F.array(*[F.when(F.contains("low", F.lit(g)), F.lit(g)) for g in asked]))).alias("gram"))
    postings = there.groupBy(F.pmod(F.xxhash64("doc_id"), segments).alias("segment"), "gram").agg(F.collect_set("doc_id").alias("ids"))
    index = postings.groupBy("segment").agg(F.map_from_entries(F.collect_list(F.struct("gram", "ids"))).alias("index"))
    by_rule = F.array(*[F.struct(F.lit(k).alias("kind"), _lists(F.col("index"), q).alias("ids")) for k, q in queries.items()])
    found = index.select(F.explode(by_rule).alias("r")).select("r.kind", F.explode("r.ids").alias("doc_id"))
    return found.groupBy("doc_id").agg(F.collect_set("kind").alias("kinds"))


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)``, the value being found once, however often and wherever it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _before(values: Column, join: Callable[[Column, Column], Column], levels: int = 2) -> Column:
    """For each element of an array of integers what those before it come to
    under ``join`` (0 for none).  An array that grows by an element is copied, so
    runs of RUN are scanned each by itself, and then their totals in the same way."""
    zero = F.lit(0).cast("long")
    start = F.struct(zero.alias("at"), F.array().cast("array<long>").alias("out"))

    def short(run: Column) -> Column:
        return F.aggregate(run, start, lambda acc, v: F.struct(join(acc["at"], v).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out")),
                           lambda acc: acc["out"])

    def scanned(runs: Column) -> Column:
        totals = F.transform(runs, lambda r: F.aggregate(r, zero, join))
        ahead = short(totals) if levels == 1 else _before(totals, join, levels - 1)
        return F.flatten(F.zip_with(runs, ahead, lambda r, first: F.transform(short(r), lambda x: join(first, x))))

    def parted(a: Column) -> Column:
        each = F.sequence(F.lit(0), F.floor((F.size(a) - 1) / RUN).cast("int"))
        return F.when(F.size(a) > 0, _bound(F.transform(each, lambda i: F.slice(a, i * RUN + 1, F.lit(RUN))), scanned)).otherwise(
            F.array().cast("array<long>"))

    return _bound(values, parted)


def _spans(rule: Rule, place: int, matches: str, parts: str) -> Column:
    """Spans (code points, end exclusive) from the matches of a rule, the text
    between them being what splitting at the pattern leaves."""
    def placed(each: Column) -> Column:
        begins = _before(F.transform(each, lambda m: (m["gap"] + m["own"]).cast("long")), lambda a, b: a + b)
        spans = F.zip_with(each, begins, lambda m, at: F.struct(
            (at + m["gap"]).cast("int").alias("start"), F.lit(place).alias("place"), (at + m["gap"] + m["own"]).cast("int").alias("end"),
            F.lit(rule.kind).alias("kind"), m["part"].alias("part")))
        good = F.filter(spans, lambda x: x["part"] >= rule.least)
        return F.transform(good, lambda x: F.struct(*[x[c].alias(c) for c in ("start", "place", "end", "kind")]))

    lengths = F.zip_with(F.zip_with(matches, F.slice(f"_b_{rule.kind}", F.lit(1), F.size(matches)), lambda m, b: F.struct(
        F.length(b).alias("gap"), F.length(m).alias("own"))), parts, lambda x, p: F.struct(x["gap"].alias("gap"), x["own"].alias("own"), F.length(p).alias("part")))
    return F.when(F.size(matches) > 0, _bound(lengths, placed)).otherwise(F.array().cast(SPAN))


def with_spans(rows: DataFrame, rules: tuple[Rule, ...] = RULES, segment: int = SEGMENT) -> DataFrame:
    """``rows`` (doc_id, text and any others) with ``spans``: start, place of the
    kind among the rules, end, kind; by start, then place."""
    listed = candidates(rows.select("doc_id", F.coalesce("text", F.lit("")).alias("text")), rules, segment)
    listed = listed.select(F.col("doc_id").alias("_listed"), F.col("kinds").alias("_kinds"))
    at = rows.withColumn("text", F.coalesce("text", F.lit(""))).join(listed, F.col("doc_id") == F.col("_listed"), "left")
    at = at.withColumn("_open", F.col("doc_id").isNull())  # an id the index doesn't hold: all rules
    nothing = F.array().cast("array<string>")
    for r in rules:
        whole = trigrams.query(r.pattern) is None
        asked = F.lit(True) if whole else F.col("_open") | F.coalesce(F.array_contains("_kinds", r.kind), F.lit(False))
        at = at.withColumn(f"_m_{r.kind}", F.when(asked, F.regexp_extract_all("text", F.lit(r.pattern), F.lit(0))).otherwise(nothing))
    for r in rules:
        some = F.size(f"_m_{r.kind}") > 0
        part = F.col(f"_m_{r.kind}") if not r.group else F.when(
            some, F.regexp_extract_all("text", F.lit(r.pattern), F.lit(r.group))).otherwise(nothing)
        at = at.withColumns({f"_p_{r.kind}": part, f"_b_{r.kind}": F.when(some, F.split("text", r.pattern, -1)).otherwise(nothing)})
    spans = F.concat(*[_spans(r, i, f"_m_{r.kind}", f"_p_{r.kind}") for i, r in enumerate(rules)])
    return at.select(*rows.columns, F.array_sort(spans).alias("spans"))


def written(spans: Column) -> Column:
    """kind:start:end of spans, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(doc_id, spans) of every document.

    A null text is empty and has none.  Null ids can't be listed in the index, so
    their texts are matched against all rules; rows that repeat an id share its
    candidates and are matched each by itself.  Spans of different kinds may
    overlap, equal ones included.  An empty table gives an empty one.
    """
    return with_spans(narrow(docs, id_col, text_col), rules).select("doc_id", "spans")


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, rules: tuple[Rule, ...] = RULES,
           mark: str = "[secret]") -> DataFrame:
    """``docs``, all rows and columns, with ``mark`` for every secret of a text; a null text stays null."""
    text = docs[text_col].cast("string")
    held = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), docs[id_col].cast("long").alias("doc_id"), text.alias("text"))
    found = with_spans(held, rules)
    clean = F.when(F.col(f"row.`{text_col}`").isNotNull(), redacted(F.col("text"), F.col("spans"), mark))
    names = [F.col(f"row.`{c}`") if c != text_col else clean.alias(c) for c in docs.columns]
    return found.select(*names)


def redacted(text: Column, spans: Column, mark: str = "[secret]") -> Column:
    """The text with ``mark`` for every span; overlapping spans are one."""
    wide = "UTF-32"  # four bytes a code point, so that a piece is found without reading what is before it

    def piece(whole: Column, begin: Column, length: Column) -> Column:
        return F.decode(F.substr(whole, (begin * 4 + 1).cast("int"), (length * 4).cast("int")), wide)

    def pieces(all_: Column) -> Column:
        whole, each = all_["whole"], all_["spans"]
        reached = _before(F.transform(each, lambda s: s["end"].cast("long")), lambda a, b: F.greatest(a, b))
        apart = F.filter(F.zip_with(each, reached, lambda s, r: F.struct(s["start"].alias("start"), r.alias("reach"))), lambda x: x["start"] >= x["reach"])
        kept = F.transform(apart, lambda x: piece(whole, x["reach"], x["start"] - x["reach"]))
        last = F.aggregate(each, F.lit(0), lambda a, s: F.greatest(a, s["end"]))
        return F.array_join(F.concat(kept, F.array(piece(whole, last, F.length(whole) / 4 - last))), mark)

    both = F.struct(F.encode(text, wide).alias("whole"), spans.alias("spans"))
    return F.when(F.size(spans) > 0, _bound(both, pieces)).otherwise(text)

"""License scans: Aho-Corasick for notice phrases and identifier tags, and a
shunting-yard parser for the expressions after a tag.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Sequence

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

from orrery.llm.util import narrow

#: Phrase to label: those every scan reports places of.
BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
#: Further notices, which only add labels.
NOTICES = {
    "bsd license": "bsd", "isc license": "isc", "mozilla public license": "mpl", "eclipse public license": "epl",
    "lesser general public license": "lgpl", "affero general public license": "agpl", "creative commons": "cc",
    "cc by": "cc-by", "cc by sa": "cc-by-sa", "cc by nc": "cc-by-nc", "cc by nd": "cc-by-nd", "cc0": "cc0", "unlicense": "unlicense",
    "boost software license": "bsl", "artistic license": "artistic", "all rights reserved": "reserved",
}
TAG = "spdx license identifier"
#: Identifiers (lower case) that the expression of a tag may rest on to be allowed.
ALLOWED = frozenset(("mit", "isc", "0bsd", "bsd-2-clause", "bsd-3-clause", "apache-2.0", "zlib", "unlicense", "cc0-1.0",
                     "cc-by-4.0", "bsl-1.0", "python-2.0"))

_TO_WORDS = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b > 127 else 32 for b in range(256))
_TAGGED = re.compile(r"spdx-license-identifier[ \t]*:[ \t]*([^\r\n]*)", re.IGNORECASE)
_TOKEN = re.compile(r"[ \t]*([()]|[A-Za-z0-9][A-Za-z0-9.+:-]*)")
_BINDS = {"or": 1, "and": 2, "with": 3}


def words(text: str) -> list[bytes]:
    """A-Z lower-cased; runs of 0-9, a-z and everything beyond ASCII."""
    return text.encode().translate(_TO_WORDS).split()


def postfix(line: str) -> list[str] | None:
    """The expression a line begins with, operators after their operands; None if
    it begins with none.  What follows a complete expression (a comment's end, a
    sentence) is left alone."""
    out: list[str] = []
    held: list[str] = []
    at, operand_next, depth = 0, True, 0
    while found := _TOKEN.match(line, at):
        token = found[1].lower()
        if token in _BINDS:
            if operand_next:
                return None
            while held and held[-1] != "(" and _BINDS[held[-1]] >= _BINDS[token]:
                out.append(held.pop())
            held.append(token)
            operand_next = True
        elif token == "(":
            if not operand_next:
                break
            held.append(token)
            depth += 1
        elif token == ")":
            if operand_next or not depth:
                break
            while held[-1] != "(":
                out.append(held.pop())
            held.pop()
            depth -= 1
        else:
            if not operand_next:
                break
            out.append(token.rstrip(".:-"))
            operand_next = False
        at = found.end()
    if operand_next or depth:
        return None
    return out + held[::-1]


def evaluate(expression: Sequence[str], allowed: frozenset[str] = ALLOWED) -> tuple[bool, set[str]]:
    """Whether the expression can be met with allowed licenses alone, and its
    license identifiers.  An exception after WITH only adds permissions, so it
    doesn't change the license's verdict."""
    stack: list[tuple[bool, set[str]]] = []
    for token in expression:
        if token in _BINDS:
            (right, more), (left, ids) = stack.pop(), stack.pop()
            if token == "with":
                stack.append((left, ids))
            else:
                stack.append((left or right if token == "or" else left and right, ids | more))
        else:
            stack.append((token.rstrip("+") in allowed, {token}))
    return stack[0]


def scanner(base: dict[str, str] = BASE, notices: dict[str, str] = NOTICES, allowed: frozenset[str] = ALLOWED) -> Callable[[str], tuple]:
    """text -> (n_words, places, last phrase of each place, labels, verdict, score)."""
    automaton = ahocorasick.Automaton()
    for phrase in {**base, **notices, TAG: ""}:
        automaton.add_word(f" {phrase} ", phrase)
    automaton.make_automaton()

    def scan(text: str) -> tuple:
        found = words(text)
        line = (b" " + b" ".join(found) + b" ").decode()
        places: list[tuple[int, str]] = []
        labels: set[str] = set()
        tagged, notes = False, 0
        for end, phrase in automaton.iter(line):
            if phrase in base:
                places.append((end - len(phrase) - 1, base[phrase]))
            elif phrase == TAG:
                tagged = True
            else:
                labels.add(notices[phrase])
                notes += 1
        at, before, starts = 0, 0, []
        for place, _ in sorted(places):  # the words before a place are the spaces up to it
            before += line.count(" ", at, place)
            at = place
            starts.append(before)
        verdict = None
        for tag in _TAGGED.findall(text) if tagged else ():
            expression = postfix(tag)
            if expression is None:
                labels.add("spdx:invalid")
                continue
            ok, ids = evaluate(expression, allowed)
            verdict = ok if verdict is None else verdict and ok
            labels |= {f"spdx:{i}" for i in ids}
        based = {label for _, label in places}
        hits = len(places) + notes
        score = 1.0 if verdict is not None else hits / (hits + 1)
        return (len(found), len(places), starts[0] if starts else None, starts[-1] if starts else None,
                ",".join(sorted(based)), ",".join(sorted(based | labels)), score, verdict)

    return scan


RESULT = ("doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
          "score double, allowed boolean")
_TYPES = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64(), pa.bool_())


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, base: dict[str, str] = BASE,
                  notices: dict[str, str] = NOTICES, allowed: frozenset[str] = ALLOWED) -> DataFrame:
    """One row per document: doc_id, n_words, n_base (places of base phrases),
    first_word and last_word (their smallest and largest start; null without
    one), base_labels, labels, score, allowed.

    A place is where a phrase's words stand one after another; equal places of
    different phrases count each.  ``score`` is 1 with a valid tag, else n / (n + 1)
    for n places and notices.  ``allowed`` says whether all tags' expressions can
    be met with allowed licenses; null without a valid tag.  A null or empty text
    has no words and no labels.  Null ids and repeated rows are kept; an empty
    table gives an empty one.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scan = scanner(base, notices, allowed)
        for batch in batches:
            rows = [scan(t.as_py() or "") for t in batch.column("text")]
            columns = [pa.array([r[i] for r in rows], t) for i, t in enumerate(_TYPES)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], names=[c.split()[0] for c in RESULT.split(", ")])

    return narrow(docs, id_col, text_col).mapInArrow(run, RESULT)

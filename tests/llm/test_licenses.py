import random
import re

import pytest

from orrery.llm import licenses, queries
from tests.conftest import SF_ORACLE
from tests.llm.common import documents, empty, table

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def base(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    places = [(i, label) for phrase, label in licenses.BASE.items() for i in range(len(words)) if words[i : i + len(phrase.split())] == phrase.split()]
    at = [i for i, _ in places]
    return len(words), len(at), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in places}))


def test_base_equals_brute_force(spark):
    rnd = random.Random(2)
    parts = ["MIT", "license", "License.", "mit-license", "Apache", "LICENSE", "General", "public", "GPL", "é", "x1", "İ", " ", "--", "\x7f", "mit license", "a\x00b"]
    rows = [(i, " ".join(rnd.choice(parts) for _ in range(rnd.randrange(12)))) for i in range(400)]
    rows += [(500, None), (501, ""), (502, "mit license " * 20_000), (None, "Apache License"), (500, "mit  license")]
    got = licenses.scan_licenses(table(spark, rows)).collect()
    assert sorted(map(str, ((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in got))) == sorted(
        str((i, *base(t))) for i, t in rows)
    assert all(0 <= r.score <= 1 and set(r.base_labels.split(",")) <= set(r.labels.split(",")) for r in got if r.base_labels)
    assert licenses.scan_licenses(empty(spark)).count() == 0


def test_registered_query(spark):
    want = {i: base(t) for i, t in documents(spark, SF_ORACLE)}
    got = queries.op9_license_scan(spark, SF_ORACLE).collect()
    assert {r.doc_id: (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in got} == want


@pytest.mark.parametrize(("line", "allowed", "ids"), [
    ("MIT", True, {"mit"}), ("GPL-2.0-only", False, {"gpl-2.0-only"}), ("MIT OR GPL-2.0-only", True, {"mit", "gpl-2.0-only"}),
    ("MIT AND GPL-2.0-only", False, {"mit", "gpl-2.0-only"}), ("mit or gpl-2.0 and bsl-1.0", True, {"mit", "gpl-2.0", "bsl-1.0"}),
    ("(MIT OR GPL-2.0) AND GPL-3.0", False, {"mit", "gpl-2.0", "gpl-3.0"}), ("GPL-2.0-only WITH Classpath-exception-2.0 OR ISC */", True, {"gpl-2.0-only", "isc"}),
    ("Apache-2.0 WITH LLVM-exception", True, {"apache-2.0"}), ("Apache-2.0+ -->", True, {"apache-2.0+"}), ("((MIT))", True, {"mit"}),
])
def test_expressions(line, allowed, ids):
    expression = licenses.postfix(line)
    assert licenses.evaluate(expression) == (allowed, ids)


@pytest.mark.parametrize("line", ["", "OR MIT", "MIT AND", "(MIT", "( )", "*/"])
def test_lines_without_an_expression(line):
    assert licenses.postfix(line) is None


def test_random_expressions_against_python(spark):
    rnd = random.Random(1)

    def build(depth):
        if not depth or rnd.random() < 0.3:
            name = rnd.choice(["MIT", "ISC", "GPL-2.0", "LGPL-2.1"])
            return name, name in ("MIT", "ISC")
        (a, x), (b, y) = build(depth - 1), build(depth - 1)
        return (f"({a} OR {b})", x or y) if rnd.random() < 0.5 else (f"({a} AND {b})", x and y)

    for _ in range(200):
        text, want = build(4)
        assert licenses.evaluate(licenses.postfix(text))[0] == want


def test_tags_add_labels_and_a_verdict(spark):
    rows = [(1, "// SPDX-License-Identifier: MIT OR GPL-2.0-only\ncode"), (2, "spdx-license-identifier: (MIT"), (3, "# SPDX-License-Identifier:GPL-3.0\n# SPDX-License-Identifier: MIT"),
            (4, "Licensed under CC BY-NC 4.0."), (5, "nothing")]
    got = {r.doc_id: (r.labels, r.allowed, r.score) for r in licenses.scan_licenses(table(spark, rows)).collect()}
    assert got[1] == ("spdx:gpl-2.0-only,spdx:mit", True, 1.0) and got[2][:2] == ("spdx:invalid", None)
    assert got[3][:2] == ("spdx:gpl-3.0,spdx:mit", False) and got[4] == ("cc-by,cc-by-nc", None, 2 / 3) and got[5] == ("", None, 0.0)

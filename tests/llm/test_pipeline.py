import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from orrery.llm import langid
from tests.conftest import SF_ORACLE
from tests.llm.common import shingle_components
from tests.llm.test_quotient import exact
from tests.llm.test_secrets import PATTERNS


def redact(text):
    found = sorted((m.start(), m.end()) for _, p, g, n in PATTERNS for m in p.finditer(text) if len(m[g]) >= n)
    out, at = "", 0
    for a, b in found:
        if a >= at:
            out += text[at:a] + "[secret]"
        at = max(at, b)
    return out + text[at:]


def test_stages_and_run_against_brute_force(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_ORACLE}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["language", "exact", "near", "secrets", "packing"] and corpus_pipeline.ORACLE_SQL is None
    results, now = {}, docs
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, now, SF_ORACLE).write.parquet(str(tmp_path / name))
        now = spark.read.parquet(str(tmp_path / name))
        results[name] = now.collect()
        if name != "packing":
            assert now.dtypes == docs.dtypes

    known = {r.doc_id for r in langid.classify(docs, langid.fit(docs)).where("not rejected").collect()}
    assert {r.doc_id for r in results["language"]} == known and len(known) > 0.98 * docs.count()
    first = {keep for _, keep, _, _ in exact([(r.doc_id, r.text) for r in results["language"]])}
    assert {r.doc_id for r in results["exact"]} == first and len(results["exact"]) == len(first)
    components = shingle_components([(r.doc_id, r.text) for r in results["exact"]], 5, 80)
    assert {r.doc_id for r in results["near"]} == {i for i, (_, c) in components.items() if i == c}
    texts = {r.doc_id: redact(r.text) for r in results["near"]}
    assert {r.doc_id: r.text for r in results["secrets"]} == texts
    assert all(r.n_chars == len(r.text) for r in results["secrets"]) and "[secret]" in "".join(texts.values())

    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = {i: [*library.encode(t, add_special_tokens=False).ids, 1] for i, t in texts.items()}
    for rows in (results["packing"], corpus_pipeline.run(spark, SF_ORACLE).collect()):
        seen = defaultdict(int)
        for r in rows:
            part = np.array(want[r.doc_id][r.start : r.start + r.length], "<u4").tobytes()
            assert zlib.crc32(part) == zlib.crc32(bytes(r.ids))
            seen[r.doc_id] += r.length
        assert dict(seen) == {i: len(x) for i, x in want.items()}


def test_empty_documents(spark):
    docs = spark.read.parquet(f"{SF_ORACLE}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF_ORACLE).count() == 0

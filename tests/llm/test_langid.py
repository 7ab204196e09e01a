import random
import zlib

import pytest
import zstandard
from pyspark.sql import functions as F

from orrery.llm import langid, queries
from tests.conftest import SF_ORACLE
from tests.llm.common import empty, table

EN = "the cat and the dog went to the house with the man that was there and then "
DE = "der hund und die katze gehen mit dem mann in das haus und dann sind sie da "


@pytest.fixture(scope="module")
def training(spark):
    rows = [(i, (EN if i % 2 else DE) * (1 + i % 3) + str(i), "en" if i % 2 else "de") for i in range(400)]
    return spark.createDataFrame([*rows, (1001, None, "en"), (1002, "12 34", "xx"), (None, EN, "yy"), (1003, EN, None)],
                                 "doc_id long, text string, lang string")


def test_learns_from_rows_that_are_not_held_out(spark, training):
    d = langid.fit(training, passages=50, passage_chars=60)
    assert set(d) == {"de", "en"} and all(0 < len(x) <= 50 * 61 for x in d.values())
    out = training.where(langid.held_out(F.col("doc_id"))).count()
    assert out == sum(zlib.crc32(str(i).encode()) % 3 == 1 for i in [*range(400), 1001, 1002, 1003])
    # what a held-out row says changes nothing
    other = training.withColumn("lang", F.when(langid.held_out(F.col("doc_id")), F.lit("zz")).otherwise(F.col("lang")))
    assert langid.fit(other, passages=50, passage_chars=60) == d


def test_smallest_output_wins(spark, training):
    d = langid.fit(training)
    rows = [(1, "the man with the dog"), (2, "DIE KATZE UND DER MANN"), (3, None), (4, ""), (5, "123 !!"), (None, EN), (1, "the man with the dog"),
            (6, EN * 3000)]
    got = langid.classify(table(spark, rows), d).collect()
    assert len(got) == len(rows)
    by_id = {r.doc_id: r for r in got}
    assert by_id[1].lang_pred == by_id[6].lang_pred == by_id[None].lang_pred == "en" and by_id[2].lang_pred == "de"
    assert all(by_id[i].lang_pred == "und" and by_id[i].score == 0 and by_id[i].rejected for i in (3, 4, 5))
    assert by_id[None].held_out is False and all(0 <= r.score <= 1 for r in got)
    kept = langid.keep_known(table(spark, rows), d)
    assert kept.columns == table(spark, rows).columns and {r.doc_id for r in kept.collect()} == {1, 2, 6, None}
    # the sizes are those of plain compression with each dictionary
    level = 6
    sizes = {}
    for k, x in d.items():
        c = zstandard.ZstdCompressor(level=level, dict_data=zstandard.ZstdCompressionDict(x, dict_type=zstandard.DICT_TYPE_RAWCONTENT),
                                     write_content_size=False, write_checksum=False, write_dict_id=False)
        sizes[k] = len(c.compress((EN * 3000).encode()))
    assert sizes["en"] <= by_id[6].bytes_best + 2


def test_numerals_are_no_letters(spark):
    d = {"de": DE.encode(), "en": EN.encode()}
    rows = [(1, "½ ² 3"), (2, "① Ⅷ"), (3, "² " * 50_000), (4, "½ " + EN)]
    got = {r.doc_id: r.lang_pred for r in langid.classify(table(spark, rows), d).collect()}
    assert got == {1: "und", 2: "und", 3: "und", 4: "en"}


def test_long_texts_keep_their_margin(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text", "lang")
    d = langid.fit(docs)
    # English that taught nothing, no text of it twice
    taught = [x for x in d["en"].decode().split("\n") if len(x) > 100]
    english = dict.fromkeys(r.text for r in docs.where("lang = 'en'").orderBy("doc_id").collect())
    english = "\n".join(t for t in english if not any(x in t.lower() for x in taught))
    draw = random.Random(3)
    numbers = " ".join(str(draw.randrange(10**6)) for _ in range(700_000))
    some = [english[:1_000], english[:100_000], english[:1_000_000], english[:10_000_000]]
    assert len(some[3]) == 10_000_000 and len(numbers) > 4_000_000
    # numbers after letters, before them, and with a letter here and there
    mixed = [english[:150_000] + numbers, numbers + english[:150_000], english[:300_000] + numbers.replace(" 1234", " x 1234")]
    rows = list(enumerate([*some, *mixed, numbers]))
    got = {r.doc_id: r for r in langid.classify(table(spark, rows).repartition(4), d).collect()}
    assert all(got[i].lang_pred == "en" and not got[i].rejected and got[i].score > 0.02 for i in range(7)), got
    assert got[3].score > 0.5 * got[1].score and got[3].bytes_best < got[3].bytes_next
    assert got[7].lang_pred == "und" and got[7].rejected
    # a text of one piece is one output
    assert got[0].score == 1 - got[0].bytes_best / got[0].bytes_next
    assert {r.doc_id for r in langid.keep_known(table(spark, rows), d).select("doc_id").collect()} == set(range(7))


def test_without_training_or_rows(spark, training):
    none = langid.fit(training.limit(0))
    assert none == {}
    assert [r.lang_pred for r in langid.classify(table(spark, [(1, EN)]), none).collect()] == ["und"]
    assert langid.classify(empty(spark), langid.fit(training)).count() == 0
    one = langid.classify(table(spark, [(1, EN)]), {"en": EN.encode()}).first()
    assert (one.lang_pred, one.score, one.rejected) == ("en", 1.0, False)


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF_ORACLE}/documents.parquet").select("doc_id", "lang")
    got = queries.op2_language_id(spark, SF_ORACLE).where("held_out").join(docs, "doc_id")
    n, right, rejected = got.agg(F.count(F.lit(1)), F.count_if(F.col("lang") == F.col("lang_pred")), F.count_if("rejected")).first()
    assert right / n > 0.97 and rejected / n < 0.01


def by_hand(text, coders):
    """(language, score, rejected) of a text, piece by piece, without the operator's helpers."""
    if text is None or not any(c.isalpha() for c in text):
        return "und", 0.0, True
    raw, parts = text.lower().encode(), []
    if len(raw) <= 65536:
        parts = [(1.0, raw)]
    else:
        rest = text.lower()
        while rest:
            part = rest[:65536].encode()[:65536].decode("utf-8", "ignore")
            rest = rest[len(part) :]
            parts.append((sum(c.isalpha() for c in part) / len(part), part.encode()))
    for level in (6, 12):
        sizes = sorted((sum(w * len(c(p)) for w, p in parts if w), lang) for lang, c in coders[level].items())
        if sizes[0][0] <= 0.98 * sizes[1][0]:
            break
    score = 1 - sizes[0][0] / sizes[1][0]
    return sizes[0][1], score, score < 0.003


def hand_coders(dictionaries):
    def coder(data, level):
        d = zstandard.ZstdCompressionDict(data, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        d.precompute_compress(level=level)
        return zstandard.ZstdCompressor(level=level, dict_data=d, write_content_size=False, write_checksum=False, write_dict_id=False).compress

    return {level: {lang: coder(d, level) for lang, d in dictionaries.items()} for level in (6, 12)}


def agrees(row, want):
    return (row.lang_pred, row.rejected) == (want[0], want[2]) and abs(row.score - want[1]) < 1e-12


def test_every_row_of_the_registered_query_by_hand(spark):
    docs = spark.read.parquet(f"{SF_ORACLE}/documents.parquet")
    coders = hand_coders(langid.fit(docs))
    texts = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    rows = queries.op2_language_id(spark, SF_ORACLE).collect()
    assert len(rows) == len(texts)
    wrong = [r for r in rows if not agrees(r, by_hand(texts[r.doc_id], coders))]
    assert not wrong, wrong[:3]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)


def test_cuts_part_no_character(spark, training):
    """The only letters of a text lie where a cut falls."""
    d = langid.fit(training)
    coders = hand_coders(d)
    rng = random.Random(4)
    texts = ["1" * 65535 + "é" + "1" * 2000, "1" * 65534 + "日" + "1" * 70000, "日" * 30000]
    for _ in range(1000):
        texts.append("7" * (65536 - rng.randrange(8)) + rng.choice("éßж日🄰") * rng.randrange(1, 4) + rng.choice(["", "5" * 100, "5" * 65530 + "é"]))
    got = langid.classify(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), d).collect()
    assert len(got) == len(texts)
    for r in got:
        assert agrees(r, by_hand(texts[r.doc_id], coders)), r
    assert all(sum(len(p) for p in (x for _, x in langid._pieces(t))) <= len(t.lower().encode()) for t in texts)

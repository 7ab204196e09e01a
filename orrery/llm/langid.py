"""Language identification by compression.

Every language gets a zstandard raw-content dictionary of its own texts; a text
is compressed with each dictionary and takes the language whose output is
smallest.  Where the two smallest outputs are close, a higher level is tried;
where they stay close, the text is rejected.  Case says nothing about the
language, so both dictionaries and texts are lower-cased.

What a dictionary saves is bounded in bytes, and a text also learns from itself,
so over one long output the margin would fall with length.  A text is therefore
compressed in consecutive pieces of ``PIECE`` bytes or, so as to part no
character, up to three fewer, all of them, each from the dictionary anew.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orrery.llm.util import letters, narrow, portions

UNKNOWN = "und"
#: Times the passages wanted of a language that are looked at for them.
SPARE = 20
#: Bytes of a text that are compressed at a time.
PIECE = 1 << 16
PREDICTION = "lang_pred string, score double, rejected boolean, bytes_best long, bytes_next long"


def held_out(doc_id: Column) -> Column:
    """crc32(doc_id as text) mod 3 is 1; a null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", *,
        passages: int = 400, passage_chars: int = 400) -> dict[str, bytes]:
    """A dictionary per non-null language from rows that are not held out.

    The sample is bounded by its two parameters: ``passages`` rows a language,
    those of smallest id hash, one passage of at most ``passage_chars``
    characters from a hashed place of each.  Rows are counted by language first,
    and only those whose hash is small enough for ``SPARE`` times ``passages`` of
    their language to be expected go on, so no task gets more than about so many
    of a language, however many rows or tasks there are.  Null ids, texts and
    languages, and texts without a letter, teach nothing; an empty table gives no
    dictionary.  The driver holds a count and a dictionary per language, so
    ``lang`` has to be a column of languages, not of ids.
    """
    rows = narrow(docs, id_col, text_col, lang=docs[lang_col].cast("string"))
    rows = rows.where(F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & ~held_out(F.col("doc_id")))
    sizes = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    if not sizes:
        return {}
    share = F.create_map(*[F.lit(x) for k, n in sizes.items() for x in (k, min(1.0, SPARE * passages / n))])
    h = F.xxhash64("doc_id")
    rows = rows.where((h.cast("double") / 2.0**64 + 0.5 <= share[F.col("lang")]) & F.col("text").rlike(r"\p{L}"))
    start = F.pmod(F.xxhash64(F.col("doc_id"), F.lit(1)), F.greatest(F.length("text") - passage_chars + 1, F.lit(1)))
    rows = rows.select("lang", "doc_id", h.alias("h"),
                       F.substr("text", (start + 1).cast("int"), F.lit(passage_chars)).alias("passage"))
    first = Window.partitionBy("lang").orderBy("h", "doc_id", "passage")
    chosen = rows.withColumn("n", F.row_number().over(first)).where(F.col("n") <= passages)
    found: dict[str, list[bytes]] = {}
    for r in chosen.select("lang", "n", "passage").orderBy("lang", "n").collect():
        found.setdefault(r.lang, []).append(r.passage.lower().encode())
    return {k: b"\n".join(v) for k, v in sorted(found.items())}


def _coders(dictionaries: dict[str, bytes], level: int) -> list[tuple[str, Callable[[bytes], bytes]]]:
    out = []
    for lang in sorted(dictionaries):
        d = zstandard.ZstdCompressionDict(dictionaries[lang], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        d.precompute_compress(level=level)
        out.append((lang, zstandard.ZstdCompressor(level=level, dict_data=d, write_content_size=False,
                                                   write_checksum=False, write_dict_id=False).compress))
    return out


def _pieces(text: str) -> list[tuple[float, bytes]]:
    """The consecutive pieces of a lower-cased text that have letters, each with
    the share of its characters that are letters; a text of one piece weighs 1."""
    raw = text.lower().encode()
    if len(raw) <= PIECE:
        return [(1.0, raw)]
    out, begin = [], 0
    while begin < len(raw):
        end = min(begin + PIECE, len(raw))
        while end < len(raw) and raw[end] & 0xC0 == 0x80:
            end -= 1  # a character is in one piece
        chars = raw[begin:end].decode()
        if n := letters(chars):
            out.append((n / len(chars), raw[begin:end]))
        begin = end
    return out


def _sizes(pieces: list[tuple[float, bytes]],
           coders: list[tuple[str, Callable[[bytes], bytes]]]) -> list[tuple[float, str, int]]:
    """(output weighted by letters, language, output in bytes), smallest first."""
    out = []
    for k, c in coders:
        sizes = [len(c(raw)) for _, raw in pieces]
        out.append((sum(w * n for (w, _), n in zip(pieces, sizes, strict=True)), k, sum(sizes)))
    return sorted(out)


def predictor(dictionaries: dict[str, bytes], *, levels: tuple[int, int] = (6, 12), close: float = 0.02,
              min_margin: float = 0.003) -> Callable[[Column], Column]:
    """A column function text -> struct(lang_pred, score, rejected, bytes_best, bytes_next); see ``classify``."""

    @F.arrow_udf(PREDICTION)
    def predict(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        first, second = (_coders(dictionaries, level) for level in levels)
        for texts in portions(batches):
            rows = []
            for text in texts.to_pylist():
                if not dictionaries or text is None or not any(map(str.isalpha, text)):
                    rows.append((UNKNOWN, 0.0, True, None, None))
                    continue
                pieces = _pieces(text)
                sizes = _sizes(pieces, first)
                if len(sizes) == 1:
                    rows.append((sizes[0][1], 1.0, False, sizes[0][2], None))
                    continue
                if sizes[0][0] > (1 - close) * sizes[1][0]:
                    sizes = _sizes(pieces, second)
                score = 1 - sizes[0][0] / sizes[1][0]
                rows.append((sizes[0][1], score, score < min_margin, sizes[0][2], sizes[1][2]))
            kinds = (pa.string(), pa.float64(), pa.bool_(), pa.int64(), pa.int64())
            yield pa.StructArray.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)],
                                             ["lang_pred", "score", "rejected", "bytes_best", "bytes_next"])

    return predict


def classify(docs: DataFrame, dictionaries: dict[str, bytes], id_col: str = "doc_id", text_col: str = "text", *,
             min_margin: float = 0.003) -> DataFrame:
    """Language of every whole text, one row per document.

    ``score`` is the margin 1 - smallest / second smallest output.  The output of
    a text of more than ``PIECE`` bytes is the sum over its pieces, each weighed by
    the share of letters among its characters, so that neither length nor a long
    part of numbers makes the margin small; ``bytes_best`` and ``bytes_next`` are
    the plain sums over the pieces that have letters.  Equal outputs go to the
    alphabetically first language.  ``rejected`` marks a margin
    below ``min_margin`` and unknown texts.  A text that is null, empty or
    without a letter is ``und`` with score 0, and so is every text if there is no
    dictionary; with a single dictionary the score is 1.  Repeated rows and null
    ids are kept as they are.
    """
    predict = predictor(dictionaries, min_margin=min_margin)
    rows = narrow(docs, id_col, text_col)
    return rows.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), predict("text").alias("p")).select(
        "doc_id", "held_out", "p.*")


def keep_known(docs: DataFrame, dictionaries: dict[str, bytes], text_col: str = "text", *,
               min_margin: float = 0.003) -> DataFrame:
    """The rows of ``docs``, with all their columns, that are not rejected."""
    return docs.where(~predictor(dictionaries, min_margin=min_margin)(docs[text_col])["rejected"])

"""Language identification by compression.

For every language a raw-content zstandard dictionary is made from a bounded
sample of labelled texts. A text is encoded once with each dictionary; the
language whose dictionary gives the smallest result is the prediction, and
the relative lead over the second smallest is its score. Narrow leads are
marked as rejected.

Texts are lower-cased and everything but letters becomes one space before
encoding, so symbols, digits, markup and capitals do not count. A text is
encoded in blocks of ``block_bytes``, all of them, so that the dictionary
matters as much at the end of a long text as at its start.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillcast.llm.common import pieces, text_buffers

#: Bounds of the fit: sampled texts for each language, bytes read from each, bytes of a dictionary, languages.
SAMPLE_ROWS, SAMPLE_BYTES, DICT_BYTES, MAX_LANGS = 200, 16_384, 32_768, 1_000
LEVEL, BLOCK_BYTES = 5, 4_096
#: The second look at short texts: effort, passages of a dictionary and their bytes.
CLOSE_LEVEL, PASSAGES, PASSAGE_BYTES = 19, 16, 128
#: Leads below this share of the second smallest size are narrow.
MIN_MARGIN = 0.002
UNDETERMINED = "und"

_SCHEMA = "doc_id long, lang_pred string, score double, rejected boolean"


def letters(texts: pa.Array) -> pa.Array:
    """Lower case, runs of anything but letters as one space; null as empty."""
    return pc.replace_substring_regex(pc.utf8_lower(pc.fill_null(texts, "")), r"[^\pL]+", " ")


def fit(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id",
        sample_rows: int = SAMPLE_ROWS, sample_bytes: int = SAMPLE_BYTES, dict_bytes: int = DICT_BYTES,
        max_langs: int = MAX_LANGS) -> dict[str, bytes]:
    """A dictionary for every language of the rows with text and language (the ``max_langs`` most frequent).

    Which rows are sampled depends on a hash of id and text, so rows that
    share an id, or have none, are sampled like others. Rows are thinned to a
    few times ``sample_rows`` by that hash before anything is shuffled, so no
    language, however frequent, meets in one task; the driver receives at most
    max_langs x sample_rows texts of sample_bytes each. Every distinct sampled
    text gets the same room in its language's dictionary; what short ones
    leave goes to the others.
    """
    rows = labelled.where(F.col(text_col).isNotNull() & F.col(lang_col).isNotNull())
    counts = {r[0]: r[1] for r in rows.groupBy(F.col(lang_col).cast("string")).count()
              .orderBy(F.desc("count"), lang_col).limit(max_langs).collect()}
    if not counts:
        return {}
    place = F.pmod(F.xxhash64(F.lit("langid"), F.col(id_col), F.col(text_col)), F.lit(1 << 30))
    shares = {k: min(1 << 30, int((1 << 30) * 4 * sample_rows / n) + 1) for k, n in counts.items()}
    spark = labelled.sparkSession
    share = spark.createDataFrame([(k, v) for k, v in shares.items()], "__lang string, __share long")
    picked = (rows.select(F.col(lang_col).cast("string").alias("__lang"), place.alias("__place"), F.col(id_col).alias("__id"),
                          F.substring(F.col(text_col).cast("string"), 1, sample_bytes).alias("__text"))
              .join(F.broadcast(share), "__lang").where(F.col("__place") < F.col("__share")))
    order = Window.partitionBy("__lang").orderBy("__place", "__id", "__text")
    sample = (picked.withColumn("__n", F.row_number().over(order)).where(F.col("__n") <= sample_rows)
              .select("__lang", "__n", "__text").collect())
    out: dict[str, bytes] = {}
    for lang in sorted({r[0] for r in sample}):
        texts = dict.fromkeys(r[2] for r in sorted((r for r in sample if r[0] == lang), key=lambda r: r[1]))
        joined = shared_room([t.encode() for t in letters(pa.array(list(texts), pa.string())).to_pylist()], dict_bytes)
        if joined.strip():
            out[lang] = joined
    return out


def shared_room(texts: list[bytes], room: int) -> bytes:
    """The starts of all texts, in order, of equal length where they are long enough, together at most ``room`` bytes."""
    length = [0] * len(texts)
    for done, k in enumerate(sorted(range(len(texts)), key=lambda k: len(texts[k]))):
        length[k] = min(len(texts[k]), room // (len(texts) - done))
        room -= length[k]
    return b"".join(t[:n] for t, n in zip(texts, length, strict=True))


class Encoders:
    """The dictionaries' encoders, in alphabetical order of the languages.

    A text of a few words is too short to be encoded smaller at all. Where
    the sizes leave a narrow lead, the blocks of the text are encoded once more
    behind short passages of each dictionary, at the highest effort, and what
    they add to them is summed: a text of one block behind every passage,
    the blocks of a longer one behind as many in turn as make up that number.
    """

    def __init__(self, dicts: dict[str, bytes]):
        self.dicts = dict(sorted(dicts.items()))
        self.names = list(self.dicts)
        self.first = [self._make(raw, LEVEL) for raw in self.dicts.values()]
        self.close: list[tuple] = []

    @staticmethod
    def _make(raw: bytes, level: int, **settings):
        import zstandard as z

        d = z.ZstdCompressionDict(raw, dict_type=z.DICT_TYPE_RAWCONTENT)
        p = z.ZstdCompressionParameters.from_level(level, source_size=BLOCK_BYTES, dict_size=len(raw), write_content_size=0, **settings)
        d.precompute_compress(compression_params=p)
        return z.ZstdCompressor(compression_params=p, dict_data=d)

    def sizes(self, text: memoryview) -> list[int]:
        """Encoded bytes of the whole text with each dictionary."""
        cuts = [text[i:i + BLOCK_BYTES] for i in range(0, len(text), BLOCK_BYTES)]
        return [sum(len(e.compress(c)) for c in cuts) for e in self.first]

    def added(self, text: memoryview) -> list[int]:
        """Bytes that the blocks of a text add to passages of each dictionary."""
        if not self.close:
            for raw in self.dicts.values():
                e = self._make(raw, CLOSE_LEVEL, min_match=3)
                step = max(1, len(raw) // PASSAGES)
                parts = [raw[i * step:i * step + PASSAGE_BYTES] for i in range(PASSAGES)]
                self.close.append((e, [(x + b" ", len(e.compress(x))) for x in parts]))
        cuts = [bytes(text[i:i + BLOCK_BYTES]) for i in range(0, len(text), BLOCK_BYTES)]
        turns = -(-PASSAGES // len(cuts))
        pairs = [(c, (k * turns + j) % PASSAGES) for k, c in enumerate(cuts) for j in range(turns)]
        return [sum(len(e.compress(parts[j][0] + c)) - parts[j][1] for c, j in pairs) for e, parts in self.close]

    def best(self, text: memoryview, min_margin: float) -> tuple[int, float]:
        """(which language, its lead over the second); (-1, 0) for a text without letters or without languages."""
        if len(text) < 2 and bytes(text) in (b"", b" ") or not self.names:
            return -1, 0.0
        if len(self.names) == 1:
            return 0, 1.0
        found = _lead(self.sizes(text))
        if found[1] < min_margin:
            found = _lead(self.added(text))
        return found


def _lead(sizes: list[int]) -> tuple[int, float]:
    best = int(np.argmin(sizes))
    second = min(sizes[:best] + sizes[best + 1:])
    return best, (second - sizes[best]) / second if second > 0 else 0.0


def predict(docs: DataFrame, dicts: dict[str, bytes], text_col: str = "text", id_col: str = "doc_id",
            min_margin: float = MIN_MARGIN) -> DataFrame:
    """(doc_id, lang_pred, score, rejected), one row per row; reads the text only.

    ``und`` with score 0, rejected, where the text is null, empty or without a
    letter, or no language was learned. Equal sizes go to the first language
    in alphabetical order, with score 0 and rejected. With one language
    learned the score is 1. Nothing is shuffled; the dictionaries
    (languages x DICT_BYTES) are broadcast.
    """
    shared = docs.sparkSession.sparkContext.broadcast(dicts)

    def score(batches):
        encoders = Encoders(shared.value)
        for piece in pieces(batches, 1):
            offsets, raw = text_buffers(letters(piece.column(1)))
            view = memoryview(raw)
            found = [encoders.best(view[a:b], min_margin) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
            langs = [encoders.names[k] if k >= 0 else UNDETERMINED for k, _ in found]
            yield pa.RecordBatch.from_arrays(
                [piece.column(0), pa.array(langs, pa.string()), pa.array([x for _, x in found], pa.float64()),
                 pa.array([x < min_margin for _, x in found], pa.bool_())], names=["doc_id", "lang_pred", "score", "rejected"])

    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return src.mapInArrow(score, _SCHEMA)


def held_out(id_col: str = "doc_id"):
    """Rows that no fit sees: crc32 of the id's digits, modulo 3, is 1."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def query(docs: DataFrame) -> DataFrame:
    dicts = fit(docs.where(~held_out()))
    return predict(docs, dicts).withColumn("held_out", held_out())


def accepted(docs: DataFrame, dicts: dict[str, bytes], text_col: str = "text", min_margin: float = MIN_MARGIN) -> DataFrame:
    """The rows of ``docs`` whose language is not rejected, all columns unchanged, in one pass without a shuffle.

    Null and empty texts and those without a letter go. Where no language was
    learned nothing can be rejected: every text with a letter stays.
    """
    names = docs.columns
    at = names.index(text_col)
    shared = docs.sparkSession.sparkContext.broadcast(dicts)

    def keep(batches):
        encoders = Encoders(shared.value)
        for piece in pieces(batches, at):
            offsets, raw = text_buffers(letters(piece.column(at)))
            view = memoryview(raw)
            each = [view[a:b] for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
            mask = [encoders.best(t, min_margin)[1] >= min_margin if encoders.names else bytes(t) not in (b"", b" ") for t in each]
            yield piece.filter(pa.array(mask, pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)

"""Language identification by compression."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Training sample: about this many documents of a language, this many characters of each, and bytes of dictionary.
SAMPLE_DOCS, SAMPLE_CHARS, DICT_BYTES = 240, 480, 96 << 10
#: Bytes of all dictionaries together: the driver and every task hold them. With more languages each has less.
ALL_BYTES = 64 << 20
#: Texts are compressed in pieces of this many bytes, each against the bare dictionary.
PIECE = 8 << 10
#: Share of the second-best size by which the best must be smaller.
MARGIN = 0.01
LEVEL = 3


class Compressors:
    """One zstandard raw-content dictionary for each language."""

    def __init__(self, dictionaries: dict[str, bytes]):
        import zstandard as z

        self.langs = list(dictionaries)
        self.made = []
        for lang in self.langs:
            d = z.ZstdCompressionDict(dictionaries[lang], dict_type=z.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(level=LEVEL)
            self.made.append(z.ZstdCompressor(level=LEVEL, dict_data=d, write_content_size=False, write_checksum=False, write_dict_id=False))

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """The language, a score, and whether the margin was too narrow to trust."""
        if not text or not any(map(str.isalpha, text)) or not self.made:
            return "und", 0.0, True
        data = text.encode()
        pieces = [data[k : k + PIECE] for k in range(0, len(data), PIECE)]
        sizes = [sum(len(c.compress(p)) for p in pieces) for c in self.made]
        if len(sizes) == 1:
            return self.langs[0], 1.0, False
        best, second = sorted(sizes)[:2]
        margin = 1 - best / second
        return self.langs[sizes.index(best)], margin / (margin + MARGIN), margin < MARGIN


def learn(docs: DataFrame, lang_col: str = "lang", sample_docs: int = SAMPLE_DOCS) -> dict[str, bytes]:
    """Dictionaries from labelled rows (doc_id, text, lang); the most frequent language first.

    Every label of a text with a letter is learnt, however few or short its
    texts are. The sample is bounded: of each language about ``sample_docs`` documents by
    the hash of their id, SAMPLE_CHARS characters of each from their middle
    on, and at most DICT_BYTES, or an equal share of ALL_BYTES. Rows without a
    label or text teach nothing; repeated rows count once. An empty table
    gives no dictionary.
    """
    rows = docs.where(F.col(lang_col).isNotNull() & F.col("text").rlike(r"\p{L}"))
    counts = rows.groupBy(lang_col).count().orderBy(F.desc("count"), lang_col).collect()  # a row for each label: the model has a dictionary for each
    if not counts:
        return {}
    share = min(DICT_BYTES, ALL_BYTES // len(counts))
    some = max(1, min(sample_docs, 2 * share // SAMPLE_CHARS + 1))
    # a row for each label, as the model has a dictionary for each; not a map in the plan
    every = rows.groupBy(lang_col).agg(F.greatest(F.lit(1), F.floor(F.count(F.lit(1)) / some)).cast("long").alias("_every"))
    cut = F.substring(F.col("text"), F.greatest(F.lit(1), F.floor(F.length("text") / 2 - SAMPLE_CHARS / 2)).cast("int"), F.lit(SAMPLE_CHARS))
    picked = rows.join(F.broadcast(every), lang_col).where(F.pmod(F.xxhash64("doc_id"), F.col("_every")) == 0).select(lang_col, F.xxhash64("doc_id", F.lit(1)).alias("h"), cut.alias("text"))
    # a language of which the hash picks no row gives its first one
    first = rows.groupBy(lang_col).agg(F.min(F.struct(F.xxhash64("doc_id", F.lit(1)).alias("h"), cut.alias("text"))).alias("x")).select(lang_col, "x.*")
    seen: dict[str, set] = {r[0]: set() for r in counts}
    for lang, h, text in picked.unionByName(first).toLocalIterator():
        seen[lang].add((h, text))
    return {lang: "\n".join(t for _, t in sorted(found)).encode()[-share:] for lang, found in seen.items() if found}


def identify(docs: DataFrame, dictionaries: dict[str, bytes], text_col: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns, lang_pred, score (0 to 1) and rejected.

    A text goes through every dictionary, whole, in pieces; the language of
    the smallest sum is predicted. The score is m / (m + MARGIN) of the
    relative margin m to the next, and ``rejected`` says that the margin is
    under MARGIN, as for very short or foreign texts; the prediction stands,
    with its low score. Null text and text without a letter are `und`, score
    0, rejected, as is every text where no dictionary was learnt. Equal sizes
    go to the more frequent language. Repeated rows return repeated rows. A
    very long text is compressed in pieces. Columns of ``docs`` named as the
    results are not returned, so rename them to keep them. An empty table
    gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(dictionaries)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = Compressors(shared.value)
        for b in batches:
            out = b[list(keep)].reset_index(drop=True)
            out[["lang_pred", "score", "rejected"]] = [model.predict(t) for t in b[text_col]]
            yield out

    schema = ", ".join(f"`{c}` {t}" for c in keep for n, t in docs.dtypes if n == c)
    return docs.select(*keep, text_col).mapInPandas(run, f"{schema}, lang_pred string, score double, rejected boolean")


def held_out(doc_id: str, k: int, r: int):
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string")), F.lit(k)) == r, F.lit(False))

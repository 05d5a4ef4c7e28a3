"""Language identification by compression.

Each language has a zstandard raw-content dictionary made of passages of its
texts.  A text, lower-cased and without digits, is cut into chunks, every chunk is compressed with every
dictionary, and the language with the fewest bytes in all wins.  The score is
the margin: how much larger the runner-up is, relative to itself.  Texts with
a narrow margin are rejected, which marks them and changes no prediction.

Training uses a bounded sample: per language ``BUCKETS`` passages of ``PASSAGE``
characters.  Candidates fall into buckets by a hash of their text, the
smallest second hash of each bucket wins, so any labelled row of any size of
table may be drawn, a third of all rows in one language does not matter, and
the aggregate holds at most one row per language and bucket.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trendstrata.llm.common import slices, small_batches, table, text_sizes

UNKNOWN = "und"
BUCKETS = 256  # passages per language
PASSAGE = 400  # characters of one
CHUNK = 2048  # bytes compressed at a time
LEVEL = 6
NARROW = 0.002  # margins below this are rejected
SLICE = 1 << 22

_NOISE = re.compile(r"[\W\d_]+")


def held_out(doc_id: str = "doc_id") -> Column:
    """Documents kept from training: crc32 of the id as text leaves 2 when divided by 4; a NULL id counts as empty."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 4 == 2


def sample(docs: DataFrame, buckets: int = BUCKETS, passage: int = PASSAGE) -> DataFrame:
    """``lang, passage``: at most ``buckets`` per language, from anywhere in the texts."""
    labelled = docs.filter(F.col("lang").isNotNull() & (F.length("text") > 0)).select("text", "lang")
    hashed = labelled.withColumns(
        {"_order": F.xxhash64("text", F.lit(1)), "_bucket": F.pmod(F.xxhash64("text", F.lit(2)), F.lit(buckets))}
    )
    drawn = hashed.groupBy("lang", "_bucket").agg(F.min("_order").alias("_order"))
    begin = F.pmod(F.xxhash64("text", F.lit(3)), F.greatest(F.length("text") - passage + 1, F.lit(1))) + 1
    part = F.substring("text", begin.cast("int"), F.lit(passage))
    # `drawn` holds at most languages x buckets rows of two numbers; copies of a text give one passage.
    return (
        hashed.join(F.broadcast(drawn), ["lang", "_bucket", "_order"])
        .groupBy("lang", "_bucket")
        .agg(F.min(part).alias("passage"))
        .select("lang", "passage")
    )


def cleaned(text: str) -> str:
    return _NOISE.sub(" ", text.lower())


def dictionaries(passages: DataFrame) -> dict[str, bytes]:
    """One raw-content dictionary per language; the sample's bound is the bound of what is collected."""
    found: dict[str, list[str]] = {}
    for lang, passage in sorted(map(tuple, passages.collect())):
        found.setdefault(lang, []).append(cleaned(passage))
    return {lang: " ".join(parts).encode("utf-8", "replace") for lang, parts in found.items()}


class Classifier:
    def __init__(self, content: Mapping[str, bytes]):
        import zstandard

        self.langs = sorted(content)
        self._coders = []
        for lang in self.langs:
            words = zstandard.ZstdCompressionDict(content[lang], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            words.precompute_compress(level=LEVEL)
            self._coders.append(
                zstandard.ZstdCompressor(
                    dict_data=words, level=LEVEL, write_content_size=False, write_checksum=False, write_dict_id=False
                )
            )

    def __call__(self, text: str | None) -> tuple[str, float, bool]:
        """Language, margin, rejected."""
        plain = cleaned(text or "").strip()
        if not plain or not self.langs:
            return UNKNOWN, 0.0, True
        data = memoryview(plain.encode("utf-8", "replace"))
        chunks = [data[i : i + CHUNK] for i in range(0, len(data), CHUNK)]
        sizes = [sum(len(coder.compress(c)) for c in chunks) for coder in self._coders]
        best = int(np.argmin(sizes))  # ties: the first language by name
        if len(sizes) == 1:
            return self.langs[0], 1.0, False
        second = min(s for i, s in enumerate(sizes) if i != best)
        margin = (second - sizes[best]) / second
        return self.langs[best], margin, margin < NARROW


@lru_cache(maxsize=2)
def _classifier(content: tuple[tuple[str, bytes], ...]) -> Classifier:
    return Classifier(dict(content))


def _predictor(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classify = _classifier(shared.value)
        for whole in batches:
            texts = whole.column(whole.schema.get_field_index("text"))
            for batch in slices(whole, text_sizes(texts), SLICE):
                texts = batch.column(batch.schema.get_field_index("text"))
                rows = [classify(t.as_py()) for t in texts]
                out = [pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.float64()),
                       pa.array([r[2] for r in rows], pa.bool_())]
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, *out], [*batch.schema.names, "lang_pred", "score", "rejected"]
                )

    return run


def predict(docs: DataFrame, content: Mapping[str, bytes]) -> DataFrame:
    """``docs`` with ``lang_pred, score, rejected``, in no more than one pass and without a shuffle.

    Only ``text`` is looked at.  A NULL text, one without a letter, or a model
    without languages gives ``und`` with score 0, rejected.  Columns of the
    three names in ``docs`` are replaced.
    """
    small_batches(docs.sparkSession)
    rows = docs.drop("lang_pred", "score", "rejected")
    shared = docs.sparkSession.sparkContext.broadcast(tuple(sorted(content.items())))
    fields = [f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in rows.schema.fields]
    return rows.mapInArrow(_predictor(shared), ", ".join([*fields, "lang_pred string", "score double", "rejected boolean"]))


def trained(docs: DataFrame) -> dict[str, bytes]:
    """Dictionaries from the labelled documents that are not held out."""
    return dictionaries(sample(docs.filter(~held_out())))


def op5_language(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    rows = docs.select("doc_id", held_out().alias("held_out"), "text")
    return predict(rows, trained(docs)).drop("text")

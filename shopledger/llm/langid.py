"""Language identification by compression.

A language is a zstandard raw-content dictionary made of text in it. A text is cut
into blocks, every block is compressed with each dictionary, and the language with
the smallest total wins. Blocks are compressed alone, so that a long text is measured
against the dictionaries and not against its own beginning; all of it counts.
"""

from __future__ import annotations

import re
from collections.abc import Mapping
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopledger.llm.batches import Fields, keyed_texts, slices, texts_of

UNDETERMINED = "und"


@dataclass(frozen=True)
class Settings:
    """Bounds of the fitted sample and of the classifier.

    From each language ``sample_texts`` hash buckets give one text each, of which
    ``excerpt_chars`` go into a dictionary of at most ``dictionary_bytes``. More than
    ``max_languages`` labels are an error, so the model sent to tasks is bounded.
    A text is accepted if the runner-up needs ``min_margin`` more bytes, relatively.
    """

    sample_texts: int = 256
    excerpt_chars: int = 512
    dictionary_bytes: int = 1 << 16
    max_languages: int = 64
    block_bytes: int = 1 << 11
    level: int = 9
    min_margin: float = 0.002


_NOT_LETTERS = re.compile(r"[\W\d_]+")


def normalised(text: str) -> bytes:
    """Lower-case letters with single spaces between words."""
    return _NOT_LETTERS.sub(" ", text.lower()).strip().encode("utf-8", "surrogatepass")


def fit(
    labelled: DataFrame, fields: Fields = Fields(), label: str = "lang", settings: Settings = Settings()
) -> dict[str, bytes]:
    """A dictionary for every non-null label of ``labelled``.

    The sample is the text with the least key hash in each bucket of a label; the
    aggregate holds one long per bucket, and only sampled texts reach the driver.
    Null keys and texts are not sampled; an empty table gives no dictionary.
    """
    rows = labelled.select(
        F.col(label).alias("label"), F.col(fields.key).alias("key"), F.col(fields.text).alias("text")
    ).filter("label is not null and key is not null and text is not null")
    hashed = rows.withColumn("hash", F.xxhash64("key"))
    bucket = F.pmod("hash", F.lit(settings.sample_texts))
    least = hashed.groupBy("label", bucket).agg(F.min("hash").alias("hash")).select("label", "hash")
    labels = least.select("label").distinct().limit(settings.max_languages + 1).count()
    if labels > settings.max_languages:
        raise ValueError(f"more than {settings.max_languages} languages")
    # At most max_languages * sample_texts small rows: small enough to broadcast.
    sampled = hashed.join(F.broadcast(least), ["label", "hash"]).select(
        "label", "hash", F.substring("text", 1, settings.excerpt_chars).alias("text")
    )
    chosen = sampled.groupBy("label", "hash").agg(F.min("text").alias("text")).collect()
    texts: dict[str, list[bytes]] = {}
    for row in sorted(chosen, key=lambda row: (row["label"], row["hash"])):
        texts.setdefault(row["label"], []).append(normalised(row["text"]))
    # The end of a raw dictionary is the cheapest to refer to; order does not matter else.
    return {k: (b" ".join(v) + b" ")[-settings.dictionary_bytes :] for k, v in texts.items()}


class Classifier:
    """Compresses with every dictionary; made once per task."""

    def __init__(self, dictionaries: Mapping[str, bytes], settings: Settings):
        self.settings = settings
        self.labels = sorted(dictionaries)
        self.compressors = []
        for label in self.labels:
            content = zstandard.ZstdCompressionDict(
                dictionaries[label], dict_type=zstandard.DICT_TYPE_RAWCONTENT
            )
            content.precompute_compress(level=settings.level)
            self.compressors.append(
                zstandard.ZstdCompressor(
                    level=settings.level,
                    dict_data=content,
                    write_content_size=False,
                    write_checksum=False,
                    write_dict_id=False,
                )
            )

    def _sizes(self, text: bytes) -> list[int]:
        step = self.settings.block_bytes
        blocks = [text[i : i + step] for i in range(0, len(text), step)]
        return [sum(map(len, map(c.compress, blocks))) for c in self.compressors]

    def __call__(self, text: str) -> tuple[str, float, float]:
        """(label, score, margin); ties go to the first label in order.

        The margin is how much more the runner-up needs, relatively; the score maps
        it to 0..1 and is 1 if there is one language only.
        """
        clean = normalised(text)
        if not clean or not self.labels:
            return UNDETERMINED, 0.0, 0.0
        # A frame's fixed cost says nothing about the language.
        sizes = [size - 4 for size in self._sizes(clean)]
        best = int(np.argmin(sizes))
        rest = sizes[:best] + sizes[best + 1 :]
        if not rest:
            return self.labels[best], 1.0, 1.0
        margin = (min(rest) - sizes[best]) / max(1, min(rest))
        return self.labels[best], margin / (margin + 0.05), margin


def predict(
    docs: DataFrame,
    dictionaries: Mapping[str, bytes],
    fields: Fields = Fields(),
    settings: Settings = Settings(),
) -> DataFrame:
    """(key, lang_pred, score, margin, accepted) of every row, by its text alone.

    ``lang_pred`` is ``und`` for null texts and texts without a letter, which are not
    accepted. Repeated rows stay; other columns are ignored.
    """
    source = keyed_texts(docs, fields)
    kind = source.schema["key"].dataType.simpleString()

    def run(batches):
        classify = Classifier(dictionaries, settings)
        for batch in batches:
            for part in slices(batch, "text"):
                found = [classify(text) for text in texts_of(part)]
                labels, scores, margins = zip(*found)
                accepted = [
                    label != UNDETERMINED and margin >= settings.min_margin
                    for label, _, margin in found
                ]
                yield pa.RecordBatch.from_arrays(
                    [part.column("key"), pa.array(labels), pa.array(scores), pa.array(margins),
                     pa.array(accepted)],
                    ["key", "lang_pred", "score", "margin", "accepted"],
                )

    return source.mapInArrow(
        run, f"key {kind}, lang_pred string, score double, margin double, accepted boolean"
    )


def keep_accepted(
    docs: DataFrame,
    dictionaries: Mapping[str, bytes],
    fields: Fields = Fields(),
    settings: Settings = Settings(),
) -> DataFrame:
    """The rows of ``docs``, all columns unchanged, whose language is accepted. No shuffle."""

    def run(batches):
        classify = Classifier(dictionaries, settings)
        for batch in batches:
            for part in slices(batch, fields.text):
                found = [classify(text) for text in texts_of(part, fields.text)]
                yield part.filter(
                    pa.array(
                        [label != UNDETERMINED and margin >= settings.min_margin
                         for label, _, margin in found],
                        pa.bool_(),
                    )
                )

    return docs.mapInArrow(run, docs.schema)

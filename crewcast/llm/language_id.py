"""Language identification by compression.

Each language has a zstandard raw-content dictionary of labelled text. A text is compressed with each of
them, and the language whose dictionary gives the fewest bytes wins. Before that, a text is reduced to its distinct
words in lower case, in order of appearance, so that repetition, numbers and marks do not hide the language.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from crewcast.llm.samples import SLICES
from crewcast.llm.storage import stored

#: Runs of letters, and of the few number forms that count as word characters.
WORD = re.compile(r"[^\W\d_]+")
UNKNOWN = "und"


@dataclass(frozen=True)
class Settings:
    """Training takes at most ``sample_docs`` distinct texts of a language, and of those as many as fill its dictionary.

    Of the distinct words of a text, whatever its length, the first ``sample_chars`` characters go into the dictionary.
    """

    sample_docs: int = 400
    sample_chars: int = 20_000
    dictionary_bytes: int = 100_000
    level: int = 12
    #: A margin below this share of the smallest size is narrow.
    narrow: float = 0.02
    #: Bytes by which one language must win for the odds to change by e.
    scale: float = 3.0
    most_languages: int = 300


def reduced(text: str | None) -> str:
    """Distinct lower-case words by first appearance; empty for a text without letters."""
    words = dict.fromkeys(WORD.findall((text or "").lower()))
    return " ".join(words) if any(c.isalpha() for w in words for c in w) else ""


@dataclass
class Model:
    """Dictionary content by language, most frequent language first; that order breaks ties."""

    contents: dict[str, bytes]
    settings: Settings
    _ready: list = field(default_factory=list, repr=False)

    def __getstate__(self):
        return {"contents": self.contents, "settings": self.settings, "_ready": []}

    def compressors(self) -> list:
        if not self._ready:
            import zstandard as z

            level = z.ZstdCompressionParameters.from_level(
                self.settings.level, format=z.FORMAT_ZSTD1_MAGICLESS, write_content_size=False, write_checksum=False, write_dict_id=False)
            for language, content in self.contents.items():
                prepared = z.ZstdCompressionDict(content, dict_type=z.DICT_TYPE_RAWCONTENT)
                prepared.precompute_compress(compression_params=level)
                self._ready.append((language, z.ZstdCompressor(dict_data=prepared, compression_params=level)))
        return self._ready

    def predict(self, text: str | None) -> tuple[str, float, int, bool]:
        """(language, score from 0 to 1, margin in bytes, narrow); ``und`` without letters."""
        data = reduced(text).encode()
        if not data or not self.contents:
            return UNKNOWN, 0.0, 0, True
        sizes = [len(c.compress(data)) for _, c in self.compressors()]
        least = min(sizes)
        best = sizes.index(least)
        margin = min((s for i, s in enumerate(sizes) if i != best), default=least * 2) - least
        score = 1 / sum(math.exp(min(0.0, (least - s) / self.settings.scale)) for s in sizes)
        return self.compressors()[best][0], score, margin, margin < self.settings.narrow * least


def learn(rows: DataFrame, settings: Settings = Settings(), text_col: str = "text", lang_col: str = "lang") -> Model:
    """Dictionaries from labelled rows; rows without a language or without text are left out.

    The sample is bounded per language and chosen by the hash of the text. Copies are one row before places are counted;
    places are counted on hashes, in slices of a language first, and only the texts in the sample are moved. Tasks reduce
    them, and only as many as fill a dictionary reach the driver. More than ``most_languages`` languages raise ValueError.
    """
    text, language = F.col(text_col), F.col(lang_col)
    usable = rows.filter(language.isNotNull() & (F.length(text) > 0))
    usable = usable.select(language.alias("lang"), text.alias("text"), F.xxhash64(text).alias("hash"))
    place = lambda *by: F.row_number().over(Window.partitionBy(*by).orderBy("hash"))
    first = usable.select("lang", "hash").distinct().withColumn("slice", F.pmod("hash", F.lit(SLICES)))
    first = first.withColumn("place", place("lang", "slice")).filter(F.col("place") <= settings.sample_docs)
    chosen = first.withColumn("place", place("lang")).filter(F.col("place") <= settings.sample_docs).drop("slice")
    sample = usable.join(F.broadcast(chosen), ["lang", "hash"]).groupBy("lang", "place").agg(F.min("text").alias("text"))
    words = F.pandas_udf(lambda texts: pd.Series([reduced(t)[: settings.sample_chars] for t in texts], dtype=object), "string")
    sample = stored(sample.select("lang", "place", words("text").alias("words")))
    before = F.sum(F.octet_length("words")).over(Window.partitionBy("lang").orderBy("place").rowsBetween(Window.unboundedPreceding, -1))
    sample = sample.withColumn("before", F.coalesce(before, F.lit(0))).filter(F.col("before") < settings.dictionary_bytes)
    sizes = Counter({r["lang"]: r["count"] for r in usable.groupBy("lang").count().limit(settings.most_languages + 1).collect()})
    if len(sizes) > settings.most_languages:
        raise ValueError(f"more than {settings.most_languages} languages")
    texts: dict[str, list[str]] = {}
    for row in sorted(sample.collect(), key=lambda r: (r["lang"], r["place"])):
        texts.setdefault(row["lang"], []).append(row["words"])
    order = sorted(texts, key=lambda name: (-sizes[name], name))
    return Model({name: (" " + " ".join(dict.fromkeys(texts[name]))).encode()[: settings.dictionary_bytes] for name in order}, settings)


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", **more: Column) -> DataFrame:
    """One row per document: id, ``more`` columns, lang_pred, score, margin_bytes, rejected.

    ``rejected`` marks a narrow margin; the best language is still given. A null text or one without letters is ``und``
    with score 0 and rejected. Equal sizes go to the language with more training rows. Whole texts are used. Every row is
    judged for itself: a null id stays, repeated rows each get one.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)  # at most dictionary_bytes per language

    def run(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in parts:
            yield pd.DataFrame([shared.value.predict(t) for t in texts], columns=["lang_pred", "score", "margin_bytes", "rejected"])

    found = F.pandas_udf(run, "lang_pred string, score double, margin_bytes long, rejected boolean")(F.col("text"))
    rows = docs.select(docs[id_col].alias("id"), *[c.alias(name) for name, c in more.items()], docs[text_col].alias("text"))
    return rows.select("id", *more, found.alias("found")).select(F.col("id").alias(id_col), *more, "found.*")

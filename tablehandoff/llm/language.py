"""Language of a text: the language whose sample helps most to compress it.

A language is learned as a raw-content zstandard dictionary: a bounded sample of its texts.
A text is encoded with each dictionary in independent blocks, so that the dictionary counts
alike in all of a long text, and the smallest sum of sizes wins. Texts are compared by their
letters: other characters become one blank, capitals small letters.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablehandoff.llm.frames import col, numbered, unpacked

# Bounds of the sample a language is learned from.
SAMPLE_TEXTS = 64
SAMPLE_CHARS = 4096
DICTIONARY_BYTES = 112_640
MAX_LANGUAGES = 256

LEVEL = 5
BLOCK = 16_384
# A text is rejected if the second smallest encoding is larger by a smaller part than this.
MARGIN = 0.01
UNKNOWN = "und"


def letters(text: Column) -> Column:
    return F.lower(F.regexp_replace(F.coalesce(text, F.lit("")), r"\P{L}+", " "))


def learn(labelled: DataFrame, text: str = "text", lang: str = "lang") -> dict[str, bytes]:
    """A dictionary for each language, the most frequent language first.

    SAMPLE_TEXTS texts of a language, or all if it has fewer, are drawn by a hash of the text, so
    that the same texts are drawn however the rows are partitioned; equal texts count once. Of
    each the first SAMPLE_CHARS characters are used, fewer of the longest ones if all together
    do not fit in DICTIONARY_BYTES. Rows without text, letter or language teach
    nothing. More than MAX_LANGUAGES languages are an error.
    """
    slim = labelled.select(col(lang).cast("string").alias("lang"), letters(col(text)).alias("sample")).where(
        F.col("lang").isNotNull() & F.col("sample").rlike(r"\p{L}")
    )
    keyed = slim.withColumn("key", F.xxhash64("sample"))
    copies = keyed.groupBy("lang", "key").agg(F.count(F.lit(1)).alias("n"))
    counts = (
        copies.groupBy("lang").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("texts"))
        .limit(MAX_LANGUAGES + 1).collect()
    )
    if len(counts) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    if not counts:
        return {}
    # The part of all hashes that is drawn of each language.
    drawn = F.lit(False)
    for r in counts:
        part = min(1.0, 2 * SAMPLE_TEXTS / r.texts)
        chance = F.col("key").bitwiseAND(F.lit((1 << 53) - 1)) / F.lit(float(1 << 53))
        drawn = drawn | ((F.col("lang") == r.lang) & (chance <= part))
    samples = (
        keyed.where(drawn).groupBy("lang", "key")
        .agg(F.min(F.substring("sample", 1, SAMPLE_CHARS)).alias("sample")).collect()
    )
    by_lang: dict[str, list[tuple[int, str]]] = {r.lang: [] for r in sorted(counts, key=lambda r: (-r.n, r.lang))}
    for r in samples:
        by_lang[r.lang].append((r.key & ((1 << 53) - 1), r.sample))
    out = {}
    for name, texts in by_lang.items():
        out[name] = b"\n".join(fitted([t.encode() for _, t in sorted(texts)[:SAMPLE_TEXTS]], DICTIONARY_BYTES))
    return out


def fitted(texts: list[bytes], room: int) -> list[bytes]:
    """The texts, the longest cut to one length so that all joined by a byte fit in ``room``."""
    left, most = room - len(texts) + 1, 0
    for i, size in enumerate(sorted(map(len, texts))):
        most = left // (len(texts) - i)
        if size > most:
            break
        left -= size
    else:
        return texts
    return [t[:most].decode(errors="ignore").encode() for t in texts]


def _compressors(dictionaries: dict[str, bytes]) -> list[tuple[str, zstandard.ZstdCompressor]]:
    out = []
    for name, content in dictionaries.items():
        made = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        made.precompute_compress(level=LEVEL)
        out.append((name, zstandard.ZstdCompressor(dict_data=made, level=LEVEL)))
    return out


def classify(data: bytes, compressors: list[tuple[str, zstandard.ZstdCompressor]], margin: float) -> tuple[str, float, bool]:
    """(language, how much larger the second best encoding is as a part of it, rejected).

    Of equal encodings the language learned first wins. A text too short for any dictionary
    to shorten gives no evidence; it takes the first language with score 0 and stays.
    """
    blocks = [data[i : i + BLOCK] for i in range(0, len(data), BLOCK)]
    sizes = [sum(len(c.compress(b)) for b in blocks) for _, c in compressors]
    best = min(sizes)
    name = compressors[sizes.index(best)][0]
    rest = sorted(sizes)[1:]
    score = (rest[0] - best) / rest[0] if rest else 1.0
    return name, score, score < margin and best < len(data)


def _rows(dictionaries: dict[str, bytes], margin: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compressors = _compressors(dictionaries)
        for batch in batches:
            found = [
                classify(v.as_py().encode(), compressors, margin) if known and compressors else (UNKNOWN, 0.0, True)
                for v, known in zip(batch.column("letters"), batch.column("known").to_pylist())
            ]
            langs, scores, rejected = zip(*found) if found else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column("text"), batch.column("rest"), pa.array(langs, pa.string()),
                 pa.array(scores, pa.float64()), pa.array(rejected, pa.bool_())],
                ["text", "rest", "lang_pred", "score", "rejected"],
            )

    return run


def identify(
    docs: DataFrame, dictionaries: dict[str, bytes], text: str = "text", margin: float = MARGIN,
    keep_text: bool = True,
) -> DataFrame:
    """The columns of ``docs`` and ``lang_pred``, ``score`` (0 to 1) and ``rejected``.

    A null text and one without a letter is ``und``, score 0, rejected; so is every text if no
    language was learned. With one language every text with a letter is in it, score 1. Equal
    texts get equal results. ``keep_text=False`` leaves the text out. A column of ``docs``
    named like a result gives way to it.
    """
    source = numbered(docs, text)
    plain = letters(F.col("text"))
    shown = F.col("text") if keep_text else F.lit(None).cast("string")
    prepared = source.select(shown.alias("text"), "rest", plain.alias("letters")).withColumn(
        "known", F.col("letters").rlike(r"\p{L}")
    )
    schema = prepared.select("text", "rest").schema
    for name, kind in (("lang_pred", "string"), ("score", "double"), ("rejected", "boolean")):
        schema = schema.add(name, kind)
    done = prepared.mapInArrow(_rows(dictionaries, margin), schema)
    names = docs.columns if keep_text else [c for c in docs.columns if c != text]
    return unpacked(done, names, text, ["lang_pred", "score", "rejected"])

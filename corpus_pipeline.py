"""Training pieces from raw documents, stage by stage; each stage is written and read again.

Every stage works on all rows that the one before kept. All but the last return the columns
of ``documents``; the last returns sampled piece ids.

Rows are judged by their text alone, so nulls in other columns change nothing, and further
columns come through as they are, whatever they are called. Repeated rows are rows of their
own until near-dedup keeps one of them. An empty table gives an empty result. A null or empty
text has no language and goes in the first stage; given to a later one it stays, as it is. A
text of any length is taken whole; no stage holds more than one such text besides its batch.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablehandoff import session
from tablehandoff.llm import language, pieces
from tablehandoff.llm.decontaminate import contaminated
from tablehandoff.llm.frames import col, numbered, stored
from tablehandoff.llm.neardup import without_copies
from tablehandoff.llm.queries import PIECES
from tablehandoff.llm.repeats import remove_repeats


# Holds all columns but the text while an operator adds its own.
DOCUMENT = "_document"


def wrapped(docs: DataFrame) -> DataFrame:
    """The text and one struct of the other columns, so that no name clashes with a result."""
    others = [col(c).alias(c) for c in docs.columns if c != "text"]
    return docs.select(F.struct(*(others or [F.lit(0).alias("_")])).alias(DOCUMENT), "text")


def opened(df: DataFrame, columns: Sequence[str], changed: Mapping[str, Column]) -> DataFrame:
    """The columns again, some of them changed."""
    held = {c: F.col("text") if c == "text" else F.col(DOCUMENT).getField(c) for c in columns} | {
        c: value for c, value in changed.items() if c in columns
    }
    return df.select(*[held[c].alias(c) for c in columns])


def identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents whose language is rejected: no letters, or a narrow margin."""
    session.configure(spark)
    learned = language.learn(docs)
    return opened(language.identify(wrapped(docs), learned).where(~F.col("rejected")), docs.columns, {})


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each class of near copies."""
    session.configure(spark)
    return without_copies(docs)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes words out that repeat in long runs; a text without any stays as it is."""
    session.configure(spark)
    text = F.when(F.col("n_removed") > 0, F.col("kept_text")).otherwise(F.col("text"))
    changed = {"text": text, "n_chars": F.length(text).cast("long")}
    return opened(remove_repeats(wrapped(docs)), docs.columns, changed)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold an item of the benchmark."""
    session.configure(spark)
    items = spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet")
    rows = numbered(docs, "text")
    found = stored(contaminated(rows.select("row", "text"), items, doc_id="row").select(F.col("doc_id").alias("row")).distinct(), "contaminated")
    kept = rows.join(found, "row", "left_anti")
    return kept.select(*[F.col("text") if c == "text" else F.col("rest").getField(c).alias(c) for c in docs.columns])


def segmented(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Two sampled segmentations of each document, and whether they decode to its text."""
    session.configure(spark)
    kept = [c for c in ("doc_id", "lang", "source", "text") if c in docs.columns]
    made = pieces.sample_segmentations(docs.select(kept), pieces.load(PIECES), k=2)
    return made.drop("perturbed")


STAGES = [
    ("language ID", identified),
    ("near-dedup", without_near_copies),
    ("substring dedup", without_repeats),
    ("decontamination", decontaminated),
    ("pieces", segmented),
]

# Stages learn from the texts and sample by hash, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages on ``documents``; every result is written before the next stage reads it."""
    folder = session.work_folder(session.configure(spark), "pipeline")
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{number}")
        docs = spark.read.parquet(f"{folder}/{number}")
    return docs

"""One query for each operator, with production parameters, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablehandoff import session
from tablehandoff.llm import archive, language, licences, pieces, quality, urls
from tablehandoff.llm.alignment import align
from tablehandoff.llm.decontaminate import contaminated
from tablehandoff.llm.neardup import near_duplicates
from tablehandoff.llm.packing import pack
from tablehandoff.llm.repeats import remove_repeats
from tablehandoff.llm.sharding import assign
from tablehandoff.llm.whitening import whiten

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return session.configure(spark).read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return cut.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


@query
def op6_sampled_splitters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assign(table(spark, sf_dir, "documents"), shards=24)


@query
def op7_simhash_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each document and benchmark item found in it."""
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op4_compression_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) == 0
    learned = language.learn(docs.where(~F.coalesce(held_out, F.lit(True)) & F.col("lang").isNotNull()))
    found = language.identify(docs.select("doc_id", "text"), learned, keep_text=False)
    return found.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "lang_pred", "score", "rejected")


@query
def op2_zip_packaged_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    packages = archive.write_packages(pages, session.work_folder(spark, "warc"))
    return archive.read_packages(packages).select(
        F.col("id").cast("long").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        F.col("refers_to").cast("long").alias("refers_to"),
    )


ORACLES["op2_zip_packaged_warc"] = """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (
  SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest) END AS first FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN first <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN first <> page_id THEN first END AS refers_to
FROM f"""


@query
def op5_bagminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The class of each document."""
    return near_duplicates(table(spark, sf_dir, "documents"))


# Public vocabularies; the paths are parameters of the operators.
PIECES = "/opt/tokenizers/piece_bpe_32k.model"
BYTES = "/opt/tokenizers/byte_bpe_50k.json"


@query
def op8_gumbel_segmentations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two segmentations of each document, decoded again and compared with it."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    made = pieces.sample_segmentations(docs, pieces.load(PIECES), k=2)
    return made.select(
        "doc_id", "rank", "n_pieces", "log_prob", "perturbed", "log_inclusion", F.xxhash64("ids").alias("ids_hash"), "round_trip"
    )


# The rules of the contract: host, path, verdict.
URL_RULES = [
    ("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"), ("net", "/fr/", "block"),
]


@query
def op1_url_ngrams(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    weights = urls.train(urls.labelled_urls(spark))
    return urls.judge_urls(pages, URL_RULES, weights)


@query
def op9_licence_tfidf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as files: source, language and hundreds of ids are the directories; every
    hundredth id is the licence file of its directory."""
    docs = table(spark, sf_dir, "documents")
    id, name = F.col("doc_id"), F.lit("LICENSE")
    folder = F.concat_ws("/", F.coalesce("source", F.lit("none")), F.coalesce("lang", F.lit("none")), F.floor(id / 100).cast("string"))
    leaf = F.when(F.pmod(id, F.lit(100)) == 0, name).otherwise(F.concat(id.cast("string"), F.lit(".txt")))
    return licences.scan(docs.select("doc_id", F.concat_ws("/", folder, leaf).alias("path"), "text"))


@query
def op10_line_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents"))


ORACLES["op10_line_frequency"] = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(source, '') AS host, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM d),
g AS (SELECT r, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS tri
      FROM (SELECT r, ws, unnest(range(1, len(ws) - 1)) AS i FROM w WHERE len(ws) >= 3)),
rep AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, tri) AS c FROM g) WHERE c > 1),
cov AS (SELECT r, count(DISTINCT j) AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS j FROM rep) GROUP BY r),
l AS (SELECT r, host, l FROM (SELECT r, host, unnest(string_split(t, chr(10))) AS l FROM d) WHERE regexp_matches(l, '[^\x20\x09-\x0D]')),
dup AS (SELECT r, count(*) - count(DISTINCT l) AS n FROM l GROUP BY r),
n AS (SELECT r, host, trim(regexp_replace(l, '[\x20\x09-\x0D]+', ' ', 'g')) AS s FROM l),
often AS (SELECT host, lower(s) AS s FROM n GROUP BY 1, 2 HAVING count(DISTINCT r) > {quality.LINE_DOCUMENTS}),
gone AS (SELECT r, sum(len(s) - len(replace(s, ' ', '')) + 1) AS n FROM n WHERE (host, lower(s)) IN (SELECT (host, s) FROM often) GROUP BY r),
m AS (
  SELECT doc_id, len(ws)::BIGINT AS n_words, len(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
         (len(t) - len(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
         coalesce(dup.n, 0)::BIGINT AS n_dup_lines, coalesce(cov.n, 0)::BIGINT AS n_repeat_words, coalesce(gone.n, 0)::BIGINT AS n_line_words
  FROM w LEFT JOIN cov USING (r) LEFT JOIN dup USING (r) LEFT JOIN gone USING (r))
SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND n_words - n_line_words >= {quality.LEAST_KEPT} * n_words AS kept
FROM m"""


@query
def op11_block_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings"))


@query
def op12_diagonal_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align(table(spark, sf_dir, "documents"), BYTES, PIECES)


@query
def op13_cutting_stock(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), BYTES)

"""Queries over whole texts: documents, pages and conversations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablehandoff.functions import text
from tablehandoff.operators import contract, rows, sections, sensitive
from tablehandoff.registry.base import SQL_JOB, Tables, job_name, query, sql_strip
from tablehandoff.sinks import report
from tablehandoff.sources import files

LINE_BREAK = r"\r\n|[\n-\r\x{1c}-\x{1e}\x{85}\x{2028}\x{2029}]"
LINES = f"""l AS (SELECT doc_id, CASE WHEN p[-1] = '' THEN p[:-2] ELSE p END AS p
  FROM (SELECT doc_id, string_split_regex(text, '{LINE_BREAK}') AS p FROM documents))"""


@query(rf"""WITH {LINES} SELECT doc_id, len(p)::INT AS total, len(p) > 20 AS truncated,
  CASE WHEN len(p) > 20 THEN array_to_string(p[1:20], chr(10)) || chr(10)
      || '[truncated: showing first 20 of ' || len(p) || ' rows]'
    ELSE array_to_string(p, chr(10)) END AS head FROM l""")
def sample_head(t: Tables) -> DataFrame:
    return text.sample_head(t.documents, "text").select("doc_id", "total", "truncated", "head")


@query("""SELECT doc_id, 'doc ' || doc_id || ': content is ' || length(text)
  || ' chars, over the 8000-char cap' AS problem FROM documents WHERE length(text) > 8000""")
def over_cap(t: Tables) -> DataFrame:
    name = F.concat(F.lit("doc "), F.col("doc_id").cast("string"))
    checked = t.documents.select("doc_id", contract.cap_problem(name, F.col("text")).alias("problem"))
    return checked.where(F.col("problem").isNotNull())


@query(f"SELECT doc_id, right({sql_strip('text')}, 6000) AS tail FROM documents")
def tail_chars(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", text.tail_chars(F.col("text")).alias("tail"))


@query("""SELECT c_custkey, '| ' || c_custkey || ' | ' || c_name || ' | '
  || CASE WHEN c_mktsegment = 'MACHINERY' THEN '' ELSE c_mktsegment END || ' |' AS line FROM customer""")
def markdown_rows(t: Tables) -> DataFrame:
    cells = t.customer.withColumn("c_mktsegment", F.nullif("c_mktsegment", F.lit("MACHINERY")))
    lines = rows.markdown_rows(cells, ["c_custkey", "c_name", "c_mktsegment"])
    return lines.select("c_custkey", "line")


@query("""SELECT -2::BIGINT + i AS seq, CASE i WHEN 0 THEN '### Sheet: nations' WHEN 1
  THEN '| n_nationkey | n_name |' ELSE '|---|---|' END AS line FROM range(0, 3) r(i)
UNION ALL SELECT n_nationkey + 1, '| ' || n_nationkey || ' | ' || n_name || ' |' FROM nation""")
def markdown_table(t: Tables) -> DataFrame:
    numbered = t.nation.withColumn("seq", F.col("n_nationkey") + 1)
    return rows.markdown_table(numbered, "nations", ["n_nationkey", "n_name"], "seq")


@query(r"""SELECT page_id, lower(regexp_extract(url, '[^/](\.[^./]+)$', 1)) AS suffix,
  NULL::VARCHAR AS kind FROM pages""")
def file_kind(t: Tables) -> DataFrame:
    """Pages end in .html or nothing, neither of which is a kind that can be read."""
    url = F.col("url")
    return t.pages.select("page_id", text.suffix(url).alias("suffix"), text.file_kind(url).alias("kind"))


@query("""SELECT doc_id, CASE lang WHEN 'en' THEN '.txt' WHEN 'fr' THEN '.docx' WHEN 'de' THEN '.sql'
    ELSE '.exe' END AS suffix,
  CASE lang WHEN 'en' THEN 'sample' WHEN 'fr' THEN 'document' WHEN 'de' THEN 'verbatim' END AS kind
FROM documents""")
def file_kind_documents(t: Tables) -> DataFrame:
    ending = {"en": ".TXT", "fr": ".docx", "de": ".Sql", "es": ".exe"}
    endings = F.create_map(*[F.lit(x) for pair in ending.items() for x in pair])
    path = F.concat(F.lit("job.v1/"), F.col("doc_id").cast("string"), endings[F.col("lang")])
    return t.documents.select("doc_id", text.suffix(path).alias("suffix"), text.file_kind(path).alias("kind"))


@query(rf"""WITH w AS (SELECT doc_id, CASE WHEN lang = 'fr' THEN text ELSE '---' || chr(10) || 'lang: ' || lang
    || chr(10) || '---' || chr(10) || text END AS t FROM documents),
m AS (SELECT doc_id, t, regexp_matches(t, '{text.FRONT_MATTER}') AS ok FROM w)
SELECT doc_id, CASE WHEN ok THEN regexp_extract(t, '{text.FRONT_MATTER}', 1) END AS header,
  CASE WHEN ok THEN {sql_strip(f"regexp_extract(t, '{text.FRONT_MATTER}', 2)")} END AS body,
  CASE WHEN NOT ok THEN 'no front-matter block' END AS problem FROM m""")
def front_matter(t: Tables) -> DataFrame:
    """Documents under a header block; French ones have none and are reported."""
    wrapped = F.when(F.col("lang") == "fr", F.col("text")).otherwise(
        F.concat(F.lit("---\nlang: "), "lang", F.lit("\n---\n"), "text")
    )
    c = F.col("t")
    return t.documents.select("doc_id", wrapped.alias("t")).select(
        "doc_id",
        text.front_matter_header(c).alias("header"),
        text.front_matter_body(c).alias("body"),
        F.when(~text.has_front_matter(c), "no front-matter block").alias("problem"),
    )


@query(rf"""WITH w AS (SELECT doc_id, CASE WHEN lang = 'en' THEN ' ```sql' || chr(10) || text || chr(10) || '```' || chr(10)
    ELSE text END AS t FROM documents)
SELECT doc_id, CASE WHEN regexp_matches({sql_strip('t')}, '{text.FENCE}')
  THEN regexp_extract({sql_strip('t')}, '{text.FENCE}', 1) ELSE t END AS text FROM w""")
def strip_fences(t: Tables) -> DataFrame:
    fenced = F.when(
        F.col("lang") == "en", F.concat(F.lit(" ```sql\n"), "text", F.lit("\n```\n"))
    ).otherwise(F.col("text"))
    return t.documents.select("doc_id", text.strip_fences(fenced).alias("text"))


@query("""SELECT doc_id, CASE WHEN lang = 'fr' THEN 'unknown' ELSE left(sha256(text), 8) END AS id,
  CASE WHEN lang = 'en' THEN 'local' ELSE source END AS run FROM documents""")
def short_id(t: Tables) -> DataFrame:
    stored = F.when(F.col("lang") != "fr", F.sha2("text", 256)).otherwise("")
    run = F.when(F.col("lang") != "en", F.col("source"))
    return t.documents.select(
        "doc_id", text.short_id(stored).alias("id"), text.run_label(run).alias("run")
    )


@query(f"""SELECT conv_id, 0::BIGINT AS part, count(*) AS blocks,
  string_agg('### ' || role || '/' || turn || chr(10) || chr(10) || {sql_strip('text')},
    chr(10) || chr(10) ORDER BY turn) AS text
FROM conversations WHERE {sql_strip('text')} <> '' GROUP BY conv_id""")
def concat_corpus(t: Tables) -> DataFrame:
    turns = t.conversations.withColumn(
        "path", F.concat("role", F.lit("/"), F.col("turn").cast("string"))
    )
    return sections.concat_corpus(turns, ["conv_id"], "path", "text", ["turn"], part_chars=1_000_000)


@query(f"""WITH c AS (SELECT conv_id, turn, '### ' || role || '/' || turn || chr(10) || chr(10)
    || {sql_strip('text')} AS b FROM conversations WHERE {sql_strip('text')} <> ''),
r AS (SELECT *, coalesce(sum(length(b)) OVER (PARTITION BY conv_id ORDER BY turn
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
    sum(length(b)) OVER (PARTITION BY conv_id) AS total FROM c)
SELECT conv_id, CASE WHEN total > 2000 THEN before // 2000 ELSE 0 END::BIGINT AS part, count(*) AS blocks,
  string_agg(b, chr(10) || chr(10) ORDER BY turn) AS text FROM r GROUP BY ALL""")
def concat_corpus_parts(t: Tables) -> DataFrame:
    """The same in parts of 2,000 characters."""
    turns = t.conversations.withColumn(
        "path", F.concat("role", F.lit("/"), F.col("turn").cast("string"))
    )
    return sections.concat_corpus(turns, ["conv_id"], "path", "text", ["turn"], part_chars=2_000)


@query(f"""WITH s AS (SELECT {SQL_JOB} AS job, doc_id, quality IS NOT NULL AS labelled,
    chr(10) || '## doc ' || d.doc_id || chr(10) || '```' || chr(10) || text || chr(10) || '```' AS b
  FROM documents d LEFT JOIN labels l USING (doc_id)),
a AS (SELECT job, count(*) AS sections, (sum(length(b) + 1) - 1)::BIGINT AS chars,
    string_agg(b, chr(10) ORDER BY labelled DESC, doc_id) AS text FROM s GROUP BY ALL)
SELECT job, sections, chars, CASE WHEN chars <= 48000 THEN text END AS text,
  CASE WHEN chars > 48000 THEN 'assembled text is ' || chars || ' chars, over the 48000-char cap' END AS problem
FROM a""")
def group_sections(t: Tables) -> DataFrame:
    """Labelled documents as load files, the others as specs, per job."""
    known = t.labels.select("doc_id", F.lit("sql").alias("kind"))
    docs = t.documents.select("doc_id", job_name().alias("job"), "text").join(known, "doc_id", "left")
    titled = docs.withColumns({
        "kind": F.coalesce("kind", F.lit("specs")),
        "title": F.concat(F.lit("doc "), F.col("doc_id").cast("string")),
    })
    return sections.group_sections(titled, ["job"], "kind", "doc_id", "title", "text")


def hits(t: Tables) -> DataFrame:
    return sensitive.sensitive_scan(t.documents, "doc_id", "text", t.benchmark, "item_id", "text")


@query("""SELECT doc_id, item_id FROM documents d JOIN benchmark b ON contains(d.text, b.text)""")
def sensitive_scan(t: Tables) -> DataFrame:
    return hits(t)


@query("""WITH h AS (SELECT doc_id, d.text, list(DISTINCT b.text) AS v
  FROM documents d JOIN benchmark b ON contains(d.text, b.text) GROUP BY doc_id, d.text)
SELECT doc_id, len(v) AS n, list_reduce(
  [text] || list_transform(list_sort(list_transform(v, lambda x: {'n': -length(x), 'x': x})), lambda s: s.x),
  lambda acc, x: replace(acc, x, '***')) AS redacted FROM h""")
def redact(t: Tables) -> DataFrame:
    """Every found value masked in the texts that hold it."""
    values = t.benchmark.select("item_id", F.col("text").alias("value"))
    per_text = (
        hits(t).join(values, "item_id")
        .groupBy("doc_id").agg(F.collect_set("value").alias("values"))
    )
    return t.documents.join(per_text, "doc_id").select(
        "doc_id",
        F.size("values").cast("long").alias("n"),
        text.redact_all(F.col("text"), F.col("values")).alias("redacted"),
    )


@query(f"""WITH j AS (SELECT source AS job, bool_and(length(text) <= 8000) AS passed, bool_or(lang = 'es') AS confident
  FROM documents GROUP BY 1)
SELECT job, 0 AS section, 0::BIGINT AS seq, '# Run report — ' || job AS line FROM j
UNION ALL SELECT job, 0, 1, '' FROM j
UNION ALL SELECT job, 1, 0, '{report.LOW_CONFIDENCE}' FROM j WHERE NOT confident
UNION ALL SELECT job, 1, 1, '' FROM j WHERE NOT confident
UNION ALL SELECT job, 2, 0, CASE WHEN passed THEN '{report.PASS_LINE}' ELSE '{report.FAIL_LINE}' END FROM j
UNION ALL SELECT job, 2, 1, '' FROM j
UNION ALL SELECT job, 2, 2, '## Artifacts' FROM j
UNION ALL SELECT source, 3, doc_id, '- doc: `' || source || '/' || doc_id || '` (generated ' || lang || ')'
  FROM documents
UNION ALL SELECT DISTINCT source, 4, i, CASE i WHEN 0 THEN '' ELSE '## Validation warnings' END
  FROM documents, range(0, 2) r(i) WHERE length(text) > 8000
UNION ALL SELECT source, 5, doc_id, '- ⚠ doc ' || doc_id || ': content is ' || length(text)
  || ' chars, over the 8000-char cap' FROM documents WHERE length(text) > 8000
UNION ALL SELECT source, 6, i, CASE i WHEN 0 THEN '' WHEN 1 THEN '## Test output' WHEN 3
  THEN right({sql_strip('t')}, 6000) ELSE '```' END
  FROM (SELECT source, arg_max(text, doc_id) AS t FROM documents GROUP BY 1), range(0, 5) r(i)""")
def report_lines(t: Tables) -> DataFrame:
    """One report per source: its documents are the items, the longest ones warnings, the
    last one the output."""
    docs = t.documents.withColumnRenamed("source", "job")
    jobs = docs.groupBy("job").agg(
        F.bool_and(~text.over_cap(F.col("text"))).alias("passed"),
        F.bool_or(F.col("lang") == "es").alias("confident"),
    )
    key = F.col("doc_id").cast("string")
    items = docs.select(
        "job", F.col("doc_id").alias("seq"), F.lit("doc").alias("item"),
        F.concat("job", F.lit("/"), key).alias("path"), F.col("lang").alias("generated_at"),
    )
    problem = contract.cap_problem(F.concat(F.lit("doc "), key), F.col("text"))
    warnings = docs.select("job", F.col("doc_id").alias("seq"), problem.alias("message")).where(
        F.col("message").isNotNull()
    )
    last = docs.groupBy("job").agg(F.max("doc_id").alias("doc_id"))
    output = docs.join(last, ["job", "doc_id"], "left_semi").select("job", "text")
    return report.report_lines(jobs, items, warnings, output)


@query("""WITH w AS (SELECT source AS job, doc_id AS seq, '- ⚠ doc ' || doc_id || ': content is ' || length(text)
    || ' chars, over the 8000-char cap' AS line FROM documents WHERE length(text) > 8000)
SELECT job, 1 AS section, seq, line FROM w
UNION ALL SELECT DISTINCT job, 0, i, if(i = 0, '# Validation warnings', '') FROM w, range(0, 2) r(i)""")
def warning_report(t: Tables) -> DataFrame:
    """The long documents of each source as its report of warnings."""
    problem = contract.cap_problem(F.concat(F.lit("doc "), F.col("doc_id").cast("string")), F.col("text"))
    warnings = t.documents.select(F.col("source").alias("job"), F.col("doc_id").alias("seq"), problem.alias("message"))
    return report.warning_report(warnings.where(F.col("message").isNotNull()))


KINDS = ", ".join(sorted(text.FILE_KINDS))
KINDS_SQL = ", ".join(f"'{k}'" for k in text.FILE_KINDS)


@query(rf"""WITH p AS (SELECT page_id, url, lower(regexp_extract(url, '[^/](\.[^./]+)$', 1)) AS s FROM pages)
SELECT page_id, str_split(url, '/')[-1] || ': files of type ''' || s || ''' cannot be read, only {KINDS}' AS message
FROM p WHERE s NOT IN ({KINDS_SQL})""")
def unsupported_files(t: Tables) -> DataFrame:
    """Pages whose name has no kind that can be read."""
    problem = text.file_kind_problem(F.col("url")).alias("message")
    return t.pages.select("page_id", problem).where(F.col("message").isNotNull())


@query("""WITH n AS (SELECT source || '_' || lang || '_' || doc_id || '.csv' AS name FROM documents),
w AS (SELECT DISTINCT source || '_' AS prefix FROM documents UNION SELECT source || '_' || lang || '_1' FROM documents
  UNION SELECT DISTINCT source || '_xx_' FROM documents)
SELECT prefix, min(name) AS name FROM w LEFT JOIN n ON starts_with(name, prefix) GROUP BY prefix""")
def landing_lookup(t: Tables) -> DataFrame:
    """The first file for each of many prefixes; some prefixes have none."""
    source, lang = F.col("source"), F.col("lang")
    names = t.documents.select(F.concat(source, F.lit("_"), lang, F.lit("_"), F.col("doc_id").cast("string"), F.lit(".csv")).alias("name"))
    prefixes = F.array(F.concat(source, F.lit("_")), F.concat(source, F.lit("_"), lang, F.lit("_1")), F.concat(source, F.lit("_xx_")))
    return files.first_matches(names, t.documents.select(F.explode(prefixes).alias("prefix")))

"""Text expressions: Column in, Column out, all inside generated code."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# What Python's str.strip() removes and str.splitlines() splits on.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
WHITESPACE_CLASS = (
    r"[\t-\r\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)
LINE_BREAKS = "\r\x0b\x0c\x1c\x1d\x1e\x85\u2028\u2029"

# Limits of the contract.
FILE_CHAR_CAP = 8_000
TOTAL_CHAR_CAP = 48_000
SAMPLE_LINES = 20
REPORT_TAIL_CHARS = 6_000

# Name rule, hash prefix, mask and fallbacks.
NAME_PATTERN = r"^[a-z][a-z0-9_]{2,40}$"
HASH_PREFIX = "sha256:"
MASK = "***"
NO_ID = "unknown"
LOCAL_RUN = "local"

# File kinds that can be read, by suffix.
FILE_KINDS = {
    ".sql": "verbatim",
    ".docx": "document",
    ".pdf": "document",
    ".xlsx": "sheet",
    ".csv": "sample",
    ".dat": "sample",
    ".txt": "sample",
}

# Patterns of a header block, a fenced text and the last suffix of a name.
FRONT_MATTER = (
    rf"(?s)\A---{WHITESPACE_CLASS}*\n(.*?)\n---{WHITESPACE_CLASS}*\n?(.*)\z"
)
FENCE = r"(?s)\A```[a-zA-Z0-9_-]*\n(.*)\n```\z"
SUFFIX = r"[^/](\.[^./]+)$"


def strip(c: Column) -> Column:
    """Both ends without white space of any kind (``trim`` removes spaces only)."""
    return F.btrim(c, F.lit(WHITESPACE))


def content_hash(c: Column) -> Column:
    return F.concat(F.lit(HASH_PREFIX), F.sha2(c, 256))


def normalize_name(c: Column) -> Column:
    return F.translate(F.lower(strip(c)), "-", "_")


def valid_name(c: Column) -> Column:
    # ``$`` alone would accept a trailing line break.
    return c.rlike(NAME_PATTERN) & ~F.contains(c, F.lit("\n"))


def staging_table(job: Column) -> Column:
    return F.concat(F.lit("STG_"), F.upper(job))


def dashed_name(job: Column, prefix: str) -> Column:
    return F.concat(F.lit(prefix), F.translate(job, "_", "-"))


def branch_name(job: Column, prefix: str) -> Column:
    return F.concat(F.lit(prefix), job)


def endpoint_path(job: Column, base: str) -> Column:
    return F.concat(F.lit(base), job, F.lit("/"))


def output_path(job: Column, template: str) -> Column:
    """``template`` holds one ``{job}``, e.g. ``generated/tests/test_{job}.py``."""
    head, tail = template.split("{job}")
    return F.concat(F.lit(head), job, F.lit(tail))


def has_front_matter(c: Column) -> Column:
    return c.rlike(FRONT_MATTER)


def front_matter_header(c: Column) -> Column:
    return F.when(has_front_matter(c), F.regexp_extract(c, FRONT_MATTER, 1))


def front_matter_body(c: Column) -> Column:
    return F.when(has_front_matter(c), strip(F.regexp_extract(c, FRONT_MATTER, 2)))


def strip_fences(c: Column) -> Column:
    """The inside of one enclosing fence; other text as it is, not even stripped."""
    inner = strip(c)
    return F.when(inner.rlike(FENCE), F.regexp_extract(inner, FENCE, 1)).otherwise(c)


def redact(c: Column, value: Column) -> Column:
    return F.when(F.coalesce(value, F.lit("")) == "", c).otherwise(
        F.replace(c, value, F.lit(MASK))
    )


def redact_all(c: Column, values: Column) -> Column:
    """Masks an array of values; longer ones first, so no value hides a longer one."""
    longest_first = F.array_sort(
        values,
        lambda a, b: F.when(F.length(a) != F.length(b), F.length(b) - F.length(a))
        .when(a < b, F.lit(-1))
        .when(a > b, F.lit(1))
        .otherwise(F.lit(0)),
    )
    return F.aggregate(longest_first, c, redact)


def over_cap(c: Column, cap: int = FILE_CHAR_CAP) -> Column:
    return F.length(c) > cap


def suffix(path: Column) -> Column:
    return F.lower(F.regexp_extract(path, SUFFIX, 1))


def file_kind(path: Column) -> Column:
    """How a file is read; null for a kind that is not supported."""
    kinds = F.create_map(*[F.lit(x) for pair in FILE_KINDS.items() for x in pair])
    return F.element_at(kinds, suffix(path))


def file_kind_problem(path: Column) -> Column:
    """What is wrong with the kind of a file; null if it can be read."""
    name = F.element_at(F.split(path, "/"), -1)
    message = F.format_string(f"%s: files of type '%s' cannot be read, only {', '.join(sorted(FILE_KINDS))}", name, suffix(path))
    return F.when(file_kind(path).isNull(), message)


def lines(c: Column) -> Column:
    # Splitting on a single character needs no regular expression; the unusual separators
    # are searched first because replacing them costs far more than finding none.
    unusual = reduce(lambda a, b: a | b, [F.contains(c, F.lit(b)) for b in LINE_BREAKS])
    even = F.when(
        unusual,
        F.translate(
            F.replace(c, F.lit("\r\n"), F.lit("\n")), LINE_BREAKS, "\n" * len(LINE_BREAKS)
        ),
    ).otherwise(c)
    parts = F.split(even, "\n", -1)
    return F.when(F.element_at(parts, -1) == "", F.slice(parts, 1, F.size(parts) - 1)).otherwise(
        parts
    )


# Fixed value: the wording of the note.
def truncation_note(total: Column, n: int) -> Column:
    return F.concat(
        F.lit(f"[truncated: showing first {n} of "), total.cast("string"), F.lit(" rows]")
    )


def sample_head(df: DataFrame, content: str, n: int = SAMPLE_LINES) -> DataFrame:
    """Adds ``total``, ``truncated`` and ``head``: the first ``n`` lines of every text, with
    a note of the total when there are more."""
    every, total = F.col("_lines"), F.size("_lines")
    head = F.array_join(F.slice(every, 1, n), "\n")
    return (
        df.withColumn("_lines", lines(F.col(content)))
        .withColumns({
            "total": total,
            "truncated": total > n,
            "head": F.when(
                total > n, F.concat_ws("\n", head, truncation_note(total, n))
            ).otherwise(head),
        })
        .drop("_lines")
    )


def tail_chars(c: Column, n: int = REPORT_TAIL_CHARS) -> Column:
    return F.right(strip(c), F.lit(n))


def markdown_row(cells: list[Column]) -> Column:
    texts = [F.coalesce(c.cast("string"), F.lit("")) for c in cells]
    return F.concat(F.lit("| "), F.concat_ws(" | ", *texts), F.lit(" |"))


def change_status(line: Column) -> Column:
    return F.left(line, F.lit(1))


def change_path(line: Column) -> Column:
    """The path after the change; for a rename that is the new one."""
    return F.element_at(F.split(line, "\t"), -1)


def change_old_path(line: Column) -> Column:
    """The path before a rename, else null."""
    fields = F.split(line, "\t")
    return F.when(F.size(fields) > 2, F.element_at(fields, 2))


def short_id(c: Column) -> Column:
    return F.coalesce(F.nullif(F.left(c, F.lit(8)), F.lit("")), F.lit(NO_ID))


def run_label(c: Column) -> Column:
    return F.coalesce(F.nullif(c, F.lit("")), F.lit(LOCAL_RUN))


def match_prefix(c: Column, prefix: str) -> Column:
    return F.startswith(c, F.lit(prefix))

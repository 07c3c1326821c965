"""URLs allowed or blocked: rules first, then a logistic regression on hashed character n-grams.

The model is trained from a small labelled table inside one DataFrame expression (full-batch
gradient steps over its arrays) and applied as an expression with its weights as a literal.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablehandoff.llm.expressions import let
from tablehandoff.llm.frames import col

BUCKETS = 4096
GRAMS = (3, 4, 5)
STEPS = 150
RATE = 0.5
DECAY = 1e-3
# Rows that a labelled table may have.
MAX_LABELLED = 2_000

# Words of the labelled table (fixed values): what blocked sites are about, what lures to them;
# what allowed sites are about, which ones they are; syllables of names that mean nothing.
BLOCKED = (
    "casino bets betting poker slots lottery jackpot roulette pills viagra pharma steroids dieting adult porn xxx sex escort "
    "ads adserver tracking tracker clicks popup banner spam phishing malware warez keygen crack scam loans payday prizes "
    "winner followers giveaway"
).split()
LURES = "free cheap win best online royal hub club zone world shop deals vip tube".split()
ALLOWED = (
    "news library weather garden university museum council docs software recipes travel health science history school "
    "hospital orchestra forum wiki photos books archive sports music theatre kitchen rivers maps trains bakery castle harbour "
    "village market letters poems physics chemistry gallery cinema railway cathedral"
).split()
SIDES = "city old town open public green north south river local young blue".split()
SYLLABLES = "ba ne li ro tu ma se ko vi da ther ing ent ion ste wal han tor".split()
NAMES = 160

# (host, path, verdict); the longest that fits decides.
Rule = tuple[str, str, str]


def labelled_hosts() -> list[tuple[str, float]]:
    """(host, 1 for blocked): every word with some of its companions, and made-up names."""
    out = []
    for i, word in enumerate(BLOCKED):
        for j in range(5):
            lure = LURES[(3 * i + 5 * j + 3) % len(LURES)]
            out.append((f"{lure}-{word}" if (i + j) % 2 else f"{word}-{lure}", 1.0))
        out.append((word + LURES[(i + 2) % len(LURES)], 1.0))
    for i, word in enumerate(ALLOWED):
        for j in range(3):
            side = SIDES[(5 * i + 7 * j) % len(SIDES)]
            out.append((f"{side}-{word}" if (i + j) % 2 else f"{word}-{side}", 0.0))
        out += [(word, 0.0), (word + SIDES[i % len(SIDES)], 0.0)]
    n = len(SYLLABLES)
    for i in range(NAMES):
        out.append(("".join(SYLLABLES[(7 * i + j * (5 + i // n) + i // 3) % n] for j in range(2 + i % 3)), 0.0))
    return out


def labelled_urls(spark: SparkSession) -> DataFrame:
    """The labelled table: blocked and allowed hosts under the same domains and paths."""
    before, domains = ["", "www.", "m.", "blog."], ["example.com", "example.net", "example.org"]
    paths = ["", "/en/{}", "/de/{}", "/es/{}", "/fr/{}", "/index", "/page/{}?a=1"]
    rows = [
        (f"https://{before[n % 4]}{host}.{domains[n % 3]}{paths[n % 7].format(n % 97)}", label)
        for n, (host, label) in enumerate(labelled_hosts())
    ]
    return spark.createDataFrame(rows, "url string, blocked double")


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; else empty."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """A struct (rule, verdict) of the longest rule whose host is ``host`` or a domain above it
    and whose path begins ``path``; null if none fits. Of equally long ones the first wins."""
    ordered = sorted(rules, key=lambda r: -len(r[0] + r[1]))
    fitting = [
        F.when(
            ((host == r[0]) | host.endswith("." + r[0])) & path.startswith(r[1]),
            F.struct(F.lit(r[0] + r[1]).alias("rule"), F.lit(r[2]).alias("verdict")),
        )
        for r in ordered
    ]
    return F.coalesce(*fitting) if fitting else F.lit(None).cast("struct<rule:string,verdict:string>")


def buckets(host: Column, path: Column) -> Column:
    """The distinct hashed n-grams of host and path; digits count as one digit."""

    def of_size(kind: str, n: int, marked: Column) -> Column:
        # One gram, shorter, of a text of fewer than n characters.
        starts = F.sequence(F.lit(1), F.greatest(F.length(marked) - n + 1, F.lit(1)))
        hashed = lambda i: F.xxhash64(F.concat(F.lit(f"{kind}{n}:"), F.substring(marked, i, F.lit(n))))
        return F.transform(starts, lambda i: F.pmod(hashed(i), F.lit(BUCKETS)).cast("int"))

    def grams(kind: str, text: Column) -> Column:
        marked = F.concat(F.lit("^"), F.regexp_replace(F.lower(text), "[0-9]", "0"), F.lit("$"))
        return let(marked, lambda m: F.flatten(F.array(*[of_size(kind, n, m) for n in GRAMS])))

    return F.array_sort(F.array_distinct(F.concat(grams("h", host), grams("p", path))))


def train(labelled: DataFrame, url: str = "url", blocked: str = "blocked") -> list[float]:
    """Weights of the buckets and, last, the bias. Rows without a label teach nothing; without
    rows all weights are 0. More than MAX_LABELLED rows are an error."""
    found = labelled.where(col(blocked).isNotNull()).select(
        buckets(host_of(col(url)), path_of(col(url))).alias("f"), col(blocked).cast("double").alias("y")
    )
    n = found.limit(MAX_LABELLED + 1).count()
    if n > MAX_LABELLED:
        raise ValueError(f"more than {MAX_LABELLED} labelled urls")
    if not n:
        return [0.0] * (BUCKETS + 1)
    # All rows as one array, the last feature of each being the bias.
    rows = found.agg(
        F.array_sort(F.collect_list(F.struct(F.array_append("f", F.lit(BUCKETS)).alias("f"), "y"))).alias("rows")
    )
    postings = (
        rows.select(F.posexplode("rows").alias("at", "r")).select("at", F.explode("r.f").alias("b"))
        .groupBy("b").agg(F.array_sort(F.collect_list("at")).alias("at"))
        .agg(F.map_from_entries(F.collect_list(F.struct("b", "at"))).alias("of"))
    )
    every = F.transform(
        F.sequence(F.lit(0), F.lit(BUCKETS)),
        lambda b: F.coalesce(F.try_element_at("of", b), F.array().cast("array<int>")),
    )
    # Both tables have one row.
    data = rows.join(F.broadcast(postings.select(every.alias("of"))), F.lit(True))
    scale = lambda r: F.sqrt(F.size(r["f"]).cast("double"))

    def step(w: Column, _: Column) -> Column:
        def miss(r: Column) -> Column:
            margin = F.aggregate(r["f"], F.lit(0.0), lambda a, b: a + F.get(w, b)) / scale(r)
            return (r["y"] - 1 / (1 + F.exp(-margin))) / scale(r)

        return let(
            F.transform("rows", miss),
            lambda m: F.transform(
                F.col("of"),
                lambda at, b: F.get(w, b) * (1 - RATE * DECAY)
                + RATE * F.aggregate(at, F.lit(0.0), lambda a, r: a + F.get(m, r)),
            ),
        )

    zeros = F.array_repeat(F.lit(0.0), BUCKETS + 1)
    return list(data.select(F.aggregate(F.sequence(F.lit(1), F.lit(STEPS)), zeros, step).alias("w")).first().w)


def chance_blocked(host: Column, path: Column, weights: Sequence[float]) -> Column:
    table = F.split(F.lit(",".join(map(repr, weights))), ",").cast("array<double>")
    return let(
        F.array_append(buckets(host, path), F.lit(BUCKETS)),
        lambda f: 1 / (1 + F.exp(-F.aggregate(f, F.lit(0.0), lambda a, b: a + F.get(table, b)) / F.sqrt(F.size(f).cast("double")))),
    )


def judge_urls(
    pages: DataFrame, rules: Sequence[Rule], weights: Sequence[float], id: str = "page_id", url: str = "url",
    threshold: float = 0.5,
) -> DataFrame:
    """``page_id``, ``host``, ``path``, ``rule`` (the one that decided, else null), ``verdict`` (allow or
    block) and ``score``, the model's chance that the url is to be blocked.

    A null url, or one without ``://``, has an empty host and path and is judged by the model
    like others. Rows are judged one by one; repeated rows get equal results, an empty table
    gives an empty result. Other columns are not read.
    """
    parts = pages.select(col(id).alias("page_id"), host_of(col(url).cast("string")).alias("host"), path_of(col(url).cast("string")).alias("path"))
    judged = parts.withColumn("found", rule_of(F.col("host"), F.col("path"), rules)).withColumn(
        "score", chance_blocked(F.col("host"), F.col("path"), weights)
    )
    own = F.when(F.col("score") >= threshold, F.lit("block")).otherwise(F.lit("allow"))
    return judged.select(
        "page_id", "host", "path", F.col("found.rule").alias("rule"), F.coalesce("found.verdict", own).alias("verdict"), "score"
    )

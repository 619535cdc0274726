"""Secret scans over every version of every text, with a ledger of what has been scanned.

A text is addressed by its content, the SHA-256 digest: all paths and versions that hold the same text share one blob. The ledger is a
Parquet folder with a row for each blob and rule version scanned so far and the spans found, also where there are none. A scan takes the
blobs, or the rule versions of known blobs, that the ledger lacks, appends them in one write, and joins the ledger's findings back to all paths.
So a history costs its different texts once, and a changed rule costs that rule only.

DataFrame functions only. Where a pattern matches, the text is split at the matches: the lengths of the gaps and matches, summed up in order,
are the places, in code points. Copies are merged where they are read, before the shuffle, and rows meet their blob's findings in SALTS
parts, so a text that holds much of the table is spread over tasks.

Defined cases: a null text is empty; rows of equal or null paths are each returned; texts without findings have empty spans; columns of
any other name are kept out of the way by reading only the path and the text. A match that is too short is dropped; the search goes on behind it.
One writer at a time may append; a pair that was appended twice all the same counts once.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallycast.session import scratch_path

SALTS = 32
LEDGER = "blob binary, rule string, version int, spans array<struct<start: bigint, end: bigint>>"


@dataclass(frozen=True)
class Rule:
    """A pattern that Java and RE2 read alike; ``least`` code points must be in ``group`` (0: the whole match)."""

    name: str
    pattern: str
    version: int = 1
    group: int = 0
    least: int = 1

    @property
    def id(self) -> str:
        return f"{self.name}@{self.version}"


def either_case(word: str) -> str:
    """Letters A-Z in either case, and no others that a case-insensitive search would add."""
    return "".join(f"[{x}{x.upper()}]" if x.isalpha() else x for x in word)


# The words before an assigned secret, and the forms of keys and digests.
NAMES = ("password", "passwd", "secret", "token", "api_?key")
BASE = (
    Rule(
        "assign",
        f"({'|'.join(map(either_case, NAMES))})[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
        group=2,
        least=8,
    ),
    Rule("access", "AKIA[A-Z0-9]{12,}"),
    Rule("hex", "[0-9a-f]{32,}"),
)
# Forms of further keys, as their issuers describe them.
FURTHER = (
    Rule("github", "gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("google", "AIza[A-Za-z0-9_-]{35,}"),
    Rule("slack", "xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("private_key", "-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----"),
)
RULES = BASE + FURTHER


def blob_of(text: str) -> Column:
    return F.unhex(F.sha2(F.coalesce(F.col(text), F.lit("")), 256))


def _ledger(spark: SparkSession, folder: str) -> DataFrame:
    """The ledger's rows; an empty ledger is made where there is none."""
    spark.createDataFrame([], LEDGER).write.mode("ignore").parquet(folder)
    return spark.read.schema(LEDGER).parquet(folder)


def _cut_lengths(text: Column, rule: Rule) -> Column:
    """For each match the code points before it (since the match before), in it, and in its group; one gap more ends the list."""
    pattern = F.lit(rule.pattern)
    sizes = lambda parts: F.transform(parts, lambda x: F.length(x))
    cut = F.arrays_zip(
        sizes(F.split(text, rule.pattern, -1)).alias("gap"),
        sizes(F.regexp_extract_all(text, pattern, F.lit(0))).alias("match"),
        sizes(F.regexp_extract_all(text, pattern, F.lit(rule.group))).alias("part"),
    )
    return F.when(F.regexp_like(text, pattern), cut)


def scanned(texts: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """Ledger rows of ``(blob, text, missing)`` rows, one per blob: each is scanned by the rules that ``missing`` names."""
    tried = [
        F.struct(
            F.lit(rule.name).alias("rule"),
            F.lit(rule.version).alias("version"),
            F.lit(rule.least).alias("least"),
            F.array_contains("missing", rule.id).alias("wanted"),
            F.when(F.array_contains("missing", rule.id), _cut_lengths(F.col("text"), rule)).alias("cut"),
        )
        for rule in rules
    ]
    each = texts.select("blob", F.explode(F.array(*tried)).alias("tried")).select("blob", "tried.*").filter("wanted")
    parts = each.select("blob", "rule", "version", "least", F.posexplode_outer("cut").alias("place", "at"))
    so_far = W.partitionBy("blob", "rule").orderBy("place").rowsBetween(W.unboundedPreceding, W.currentRow)
    until = F.sum((F.col("at.gap") + F.col("at.match")).cast("bigint")).over(so_far)
    kept = F.col("at.part") >= F.col("least")
    span = F.struct((F.col("until") - F.col("at.match")).alias("start"), F.col("until").alias("end"))
    return (
        parts.withColumn("until", until)
        .groupBy("blob", "rule", "version")
        .agg(F.sort_array(F.collect_list(F.when(kept, span))).alias("spans"))
    )


def scan_unseen(
    versions: DataFrame, folder: str, rules: tuple[Rule, ...] = RULES, text: str = "text"
) -> None:
    """Scan the blobs of ``versions`` by the rule versions that the ledger in ``folder`` has no row for, and append these.

    Runs Spark jobs. The texts of blobs that the ledger knows for all rules are neither scanned nor shuffled for it.
    """
    spark = versions.sparkSession
    ledger = _ledger(spark, folder)
    wanted = [rule.id for rule in rules]
    texts = versions.select(blob_of(text).alias("blob"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    if ledger.isEmpty():
        fresh = texts.dropDuplicates(["blob"]).withColumn("missing", F.array(*map(F.lit, wanted)))
    else:
        done = ledger.groupBy("blob").agg(F.collect_set(F.concat_ws("@", "rule", "version")).alias("done"))
        missing = F.array_except(F.array(*map(F.lit, wanted)), F.coalesce("done", F.array().cast("array<string>")))
        unseen = (
            texts.select("blob").distinct().join(done, "blob", "left").select("blob", missing.alias("missing")).filter(F.size("missing") > 0)
        )
        some = texts.join(unseen.select("blob"), "blob", "left_semi").dropDuplicates(["blob"])
        fresh = some.join(unseen, "blob")
    scanned(fresh, rules).select("blob", "rule", F.col("version").cast("int"), "spans").write.mode("append").parquet(folder)


def blob_findings(spark: SparkSession, folder: str, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """What the rules' present versions found, by blob: (blob, rule, spans), only where there is something."""
    ledger = _ledger(spark, folder)
    current = F.concat_ws("@", "rule", "version").isin([rule.id for rule in rules])
    return ledger.filter(current & (F.size("spans") > 0)).dropDuplicates(["blob", "rule"]).select("blob", "rule", "spans")


def to_paths(versions: DataFrame, by_blob: DataFrame, path: str, text: str = "text") -> DataFrame:
    """Every row's path with its blob's columns of ``by_blob`` (one row per blob), null where it has none."""
    salted = by_blob.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salt = F.pmod(F.xxhash64(path), F.lit(SALTS)).cast("int")
    return versions.select(F.col(path).alias("path"), blob_of(text).alias("blob"), salt.alias("salt")).join(
        salted, ["blob", "salt"], "left"
    ).drop("salt")


def findings(
    versions: DataFrame, folder: str, rules: tuple[Rule, ...] = RULES, path: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Scan what is new and return a row per path and finding: the path, rule, start, end and the blob's address."""
    scan_unseen(versions, folder, rules, text)
    by_blob = blob_findings(versions.sparkSession, folder, rules)
    lists = by_blob.groupBy("blob").agg(F.collect_list(F.struct("rule", "spans")).alias("found"))
    rows = to_paths(versions, lists, path, text).select("path", "blob", F.explode("found").alias("one"))
    spans = rows.select("path", "blob", F.col("one.rule").alias("rule"), F.explode("one.spans").alias("span"))
    return spans.select(
        F.col("path").alias(path), "rule", "span.start", "span.end", F.lower(F.hex("blob")).alias("blob_sha256")
    )


def secret_digests(docs: DataFrame, folder: str | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """A row per document: the key, n_assign, n_access, n_hex, base_sha256 and the list of all spans.

    ``folder`` is the ledger's; without one the scan starts from an empty ledger.
    """
    spark = docs.sparkSession
    folder = folder or scratch_path(spark, "ledger")
    scan_unseen(docs, folder, RULES, text)
    order = F.create_map(*(F.lit(x) for i, rule in enumerate(RULES) for x in (rule.name, i)))
    one = lambda s: F.struct(s["start"].alias("start"), order[F.col("rule")].alias("order"), s["end"].alias("end"))
    name = lambda s: F.element_at(F.array(*(F.lit(rule.name) for rule in RULES)), s["order"] + 1)
    written = lambda spans: F.concat_ws(
        ",", F.transform(spans, lambda s: F.concat_ws(":", name(s), s["start"].cast("string"), s["end"].cast("string")))
    )
    count = lambda rule: F.sum(F.when(F.col("rule") == rule.name, F.size("spans")).otherwise(0)).alias(f"n_{rule.name}")
    by_blob = (
        blob_findings(spark, folder)
        .groupBy("blob")
        .agg(*map(count, BASE), F.sort_array(F.flatten(F.collect_list(F.transform("spans", one)))).alias("all"))
        .withColumn("base", written(F.filter("all", lambda s: s["order"] < len(BASE))))
        .withColumn("spans", written(F.col("all")))
        .drop("all")
    )
    numbers = [F.coalesce(f"n_{rule.name}", F.lit(0)).cast("bigint").alias(f"n_{rule.name}") for rule in BASE]
    base = F.sha2(F.coalesce("base", F.lit("")), 256).alias("base_sha256")
    return to_paths(docs, by_blob, key, text).select(
        F.col("path").alias(key), *numbers, base, F.coalesce("spans", F.lit("")).alias("spans")
    )


def _rule_sql(order: int, rule: Rule) -> str:
    pattern = "'" + rule.pattern.replace("'", "''") + "'"
    return f"""SELECT row, '{rule.name}' AS kind, {order} AS ord, {rule.least} AS least,
        unnest(range(len(string_split_regex(text, {pattern})))) AS place, unnest(string_split_regex(text, {pattern})) AS gap,
        unnest(regexp_extract_all(text, {pattern}, 0)) AS hit, unnest(regexp_extract_all(text, {pattern}, {rule.group})) AS part
    FROM docs WHERE regexp_matches(text, {pattern})"""


_WRITTEN = "string_agg(kind || ':' || (stop - length(hit)) || ':' || stop, ',' ORDER BY stop - length(hit), ord)"
SQL = f"""
WITH docs AS (SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS text FROM documents),
cut AS ({" UNION ALL ".join(_rule_sql(i, rule) for i, rule in enumerate(RULES))}),
placed AS (SELECT *, sum(length(gap) + length(hit)) OVER (PARTITION BY row, kind ORDER BY place) AS stop FROM cut),
kept AS (SELECT * FROM placed WHERE length(part) >= least),
found AS (SELECT row, {", ".join(f"count(*) FILTER (kind = '{rule.name}') AS n_{rule.name}" for rule in BASE)},
    {_WRITTEN} FILTER (ord < {len(BASE)}) AS base, {_WRITTEN} AS spans FROM kept GROUP BY row)
SELECT doc_id, {", ".join(f"coalesce(n_{rule.name}, 0) AS n_{rule.name}" for rule in BASE)},
    sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM docs LEFT JOIN found USING (row)
"""

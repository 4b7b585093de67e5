"""Secret scans over an incremental blob ledger (operator 6, native).

Every text is a blob, named by the SHA-256 of its bytes. A ledger table holds
the (blob, rule version) pairs that were scanned and what they gave. A run
scans only pairs that the ledger lacks, once per blob however many rows hold
it, appends the findings, and joins them back to all rows (paths). All of it
is built-in expressions.

A match's place is found by marking: a rule's matches are wrapped in two
private-use characters, the text is split at the first, and lengths are
summed. A text that holds these characters gets a third one in their place
first, one for one; no rule can match any of the three.

Rows: null text counts as the empty blob (no finding); repeated rows and
copies share one scan; null ids are kept; an empty table gives an empty
result. Findings are code point spans, end exclusive, ordered by start, then
by rule as listed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ferry.plans.sizing import materialize
from ferry.session import new_run_dir

# The rules, in the order in which ties are listed.
BASE_RULES = (
    ("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    ("access", r"AKIA[A-Z0-9]+", 0, 18),
    ("hex", r"[0-9a-f]+", 0, 16),
)
MORE_RULES = (
    ("key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 0),
    ("web", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+", 0, 0),
)
RULES = BASE_RULES + MORE_RULES
RULE_VERSION = "2"
OPEN, CLOSE, STAND_IN = "\ue000", "\ue001", "\ue002"
MASK = "[SECRET]"
SPAN = "struct<start:int,rule:int,end:int>"


def _matches(text: Column, order: int, pattern: str, group: int, least: int) -> Column:
    """Spans of one rule. Runs of one character class are cut at the least
    length by the pattern itself, where that finds the same matches."""
    quick = group == 0 and pattern.endswith("]+") and least > 0
    if quick:
        fixed = 4 if pattern.startswith("AKIA") else 0
        pattern = pattern[:-1] + "{%d,}" % (least - fixed)
    marked = F.regexp_replace(text, F.lit(pattern), F.lit(f"{OPEN}$0{CLOSE}"))
    parts = F.split(marked, OPEN, -1)

    def step(acc, part):
        inner = F.substring_index(part, CLOSE, 1)
        start = acc["at"]
        end = start + F.length(inner)
        good = F.lit(True) if quick or not least else \
            F.length(F.regexp_extract(inner, pattern, group)) >= least
        span = F.struct(start.alias("start"), F.lit(order).alias("rule"), end.alias("end"))
        return F.struct((start + F.length(part) - 1).alias("at"),
                        F.when(good, F.concat(acc["spans"], F.array(span))).otherwise(acc["spans"]).alias("spans"))

    first = F.struct(F.length(F.element_at(parts, 1)).alias("at"), F.array().cast(f"array<{SPAN}>").alias("spans"))
    found = F.aggregate(F.slice(parts, 2, F.size(parts)), first, step)["spans"]
    return F.when(F.regexp_like(text, F.lit(pattern)), found).otherwise(F.array().cast(f"array<{SPAN}>"))


def scan_spans(text: Column) -> Column:
    """All findings of one text: an array of (start, rule, end), sorted."""
    plain = F.translate(text, OPEN + CLOSE, STAND_IN * 2)
    each = [_matches(plain, i, *rule[1:]) for i, rule in enumerate(RULES)]
    return F.array_sort(F.concat(*each))


def blob_id(text: Column) -> Column:
    return F.sha2(F.encode(F.coalesce(text, F.lit("")), "UTF-8"), 256)


def scan_ledger(docs: DataFrame, text_col: str = "text", ledger_path: str | None = None,
                version: str = RULE_VERSION) -> DataFrame:
    """The ledger's findings after a run over ``docs``: ``(blob, rule_version,
    spans)``, one row per blob scanned under ``version``."""
    spark = docs.sparkSession
    path = ledger_path or new_run_dir(spark, "blob-ledger")
    blobs = (docs.select(blob_id(docs[text_col]).alias("blob"), docs[text_col].alias("text"))
             .filter(F.col("text").isNotNull()))
    old = _read_ledger(spark, path)
    if old is not None:
        blobs = blobs.join(old.filter(F.col("rule_version") == version).select("blob"), "blob", "left_anti")
    fresh = (blobs.dropDuplicates(["blob"])
             .select("blob", F.lit(version).alias("rule_version"), scan_spans(F.col("text")).alias("spans")))
    fresh.write.mode("append").parquet(path)
    return spark.read.parquet(path).filter(F.col("rule_version") == version)


def _read_ledger(spark, path: str) -> DataFrame | None:
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(spark._jvm.org.apache.hadoop.fs.Path(path, "_SUCCESS")):
        return None
    return spark.read.parquet(path)


def secret_findings(docs: DataFrame, columns: list[str], text_col: str = "text",
                    ledger_path: str | None = None) -> DataFrame:
    """``columns`` of every row and its ``spans`` (empty where there is none)."""
    found = scan_ledger(docs, text_col, ledger_path).filter(F.size("spans") > 0)
    rows = docs.select(F.struct(*[docs[c] for c in columns]).alias("row"),
                       blob_id(docs[text_col]).alias("blob"))
    return (rows.join(found.select("blob", "spans"), "blob", "left")
            .select("row", F.coalesce("spans", F.array().cast(f"array<{SPAN}>")).alias("spans")))


def _listed(spans: Column) -> Column:
    names = F.array(*[F.lit(r[0]) for r in RULES])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", names[s["rule"]], s["start"].cast("string"), s["end"].cast("string"))), ",")


def _count_of(rule: int) -> Column:
    return F.size(F.filter("spans", lambda s: s["rule"] == rule)).cast("long")


def secret_digest(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts, the digest of the base spans and all spans of every row."""
    found = secret_findings(docs, [id_col], text_col)
    base = F.filter("spans", lambda s: s["rule"] < len(BASE_RULES))
    counts = [_count_of(i).alias(f"n_{r[0]}") for i, r in enumerate(BASE_RULES)]
    return found.select(F.col("row")[id_col].alias(id_col), *counts,
                        F.sha2(_listed(base), 256).alias("base_sha256"), _listed(F.col("spans")).alias("spans"))


def mask_secrets(docs: DataFrame, text_col: str = "text", length_col: str | None = "n_chars") -> DataFrame:
    """``docs`` with every finding replaced by a mark; other rows unchanged.
    ``length_col``, where the table has it, follows the new text."""
    columns = docs.columns
    found = secret_findings(docs, columns, text_col)
    text = F.col("row")[text_col]

    def step(acc, s):
        cut = s["start"] >= acc["at"]
        piece = F.when(cut, F.concat(F.substring(text, acc["at"] + 1, s["start"] - acc["at"]), F.lit(MASK))).otherwise("")
        return F.struct(F.concat(acc["out"], piece).alias("out"), F.greatest(acc["at"], s["end"]).alias("at"))

    first = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))
    walked = F.aggregate("spans", first, step)
    masked = F.concat(walked["out"], F.substring(text, walked["at"] + 1, F.length(text)))
    hit = F.size("spans") > 0
    out = found.select("row", F.when(hit, masked).otherwise(text).alias("masked"), hit.alias("hit"))
    cols = []
    for c in columns:
        col = F.col("row")[c]
        if c == text_col:
            col = F.col("masked")
        elif c == length_col:
            col = F.when(F.col("hit"), F.length("masked").cast(docs.schema[c].dataType)).otherwise(col)
        cols.append(col.alias(c))
    return out.select(*cols)

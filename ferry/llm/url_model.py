"""URL filter by a character language-model ratio (operator 1, native).

Two variable-order Markov models over characters are learned, one from the
URLs that an allow rule accepts and one from those that a block rule rejects.
Probabilities interpolate from order 0 up by Witten-Bell smoothing: the
longer context counts for as much as it was seen with few different
followers. A URL's score is its mean log-likelihood difference by character.
The threshold is calibrated on labelled URLs that training left out: the cut
that separates them best (balanced accuracy).

Characters map to an alphabet of at most 48 symbols (letters, one digit
class, URL punctuation, one class for the rest) and contexts have up to two
characters, so the model has at most 48^3 entries a class, whatever the
corpus: that is the proven bound of its broadcast. Training counts and
calibration cover all rows.

Rows: a null URL or one without ``://`` has an empty host and path, fits no
rule, and is scored as its text (null: as empty, allowed by default); ties go to
allow; repeated URLs are scored once and joined back; without labelled URLs
of both classes every verdict of the method is allow.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ferry.plans.sizing import materialize

# The rules of the query.
RULES = (("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"),
         ("block", "net/es/"), ("block", "net/fr/"))
ORDER = 3
START = "^"
PUNCTUATION = "./-_?=&#%:~+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
HOLD_OUT = 5
BINS_PER_UNIT = 200


def host_and_path(url: Column) -> tuple[Column, Column]:
    has = F.coalesce(F.instr(url, "://") > 0, F.lit(False))
    parts = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    host = F.translate(F.regexp_extract(url, parts, 1), UPPER, LOWER)
    path = F.regexp_extract(url, parts, 2)
    return F.when(has, host).otherwise(""), F.when(has, path).otherwise("")


def match_rule(host: Column, path: Column, rules=RULES) -> Column:
    """The longest rule that fits, as a struct (verdict, rule), or null."""
    cases = None
    for verdict, rule in sorted(rules, key=lambda r: -len(r[1])):
        name, slash, tail = rule.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(slash + tail)
        value = F.struct(F.lit(verdict).alias("verdict"), F.lit(rule).alias("rule"))
        cases = F.when(fits, value) if cases is None else cases.when(fits, value)
    return cases


def symbols(url: Column) -> Column:
    """The URL in the model's alphabet, without its scheme's colon."""
    low = F.translate(F.coalesce(url, F.lit("")), UPPER, LOWER)
    low = F.regexp_replace(low, "[0-9]", "0")
    return F.concat(F.lit(START * (ORDER - 1)), F.regexp_replace(low, r"[^a-z0./\-_?=&#%:~+]", "!"))


def _grams(rows: DataFrame, *keep: str) -> DataFrame:
    """One row per character: the character with its ORDER - 1 predecessors.
    The text is cut once into characters and the array's neighbours are put
    together, so the work is linear in a url's length and no row of a
    character carries the url."""
    chars = F.split("text", "")
    n = F.greatest(F.length("text") - (ORDER - 1), F.lit(0))
    grams = F.slice("c", 1, n)
    for k in range(1, ORDER):
        grams = F.zip_with(grams, F.slice("c", F.lit(k + 1), n), lambda g, c: F.concat(g, c))
    cut = rows.select(*keep, "text", chars.alias("c")).select(*keep, grams.alias("grams"))
    return cut.select(*keep, F.explode("grams").alias("gram"))


def train(labelled: DataFrame) -> DataFrame:
    """Log-probability ratio of every known gram: ``(gram, ratio)``.

    ``labelled`` has (label, text, times). Witten-Bell: with context h seen
    n(h) times with t(h) different followers, p(c|h) = (n(hc) + t(h) p(c|h'))
    / (n(h) + t(h)), down to a uniform order -1."""
    table = _grams(labelled, "label", "times").groupBy("label", "gram").agg(F.sum("times").alias("n"))
    table = materialize(table, "url-grams")  # at most 2 * 48^3 rows, read for every order
    size = 28 + len(PUNCTUATION)
    # every gram known to either class is scored under both
    all_grams = table.select("gram").distinct()
    labels = F.array(F.lit("allow"), F.lit("block"))
    wanted = all_grams.select(F.explode(labels).alias("label"), "gram")
    current = wanted.select("label", "gram", F.lit(1.0 / size).alias("p"))
    for k in range(1, ORDER + 1):
        c = table.groupBy("label", F.expr(f"right(gram, {k})").alias("g")).agg(F.sum("n").alias("n"))
        h = (c.groupBy("label", F.expr(f"left(g, {k - 1})").alias("h"))
             .agg(F.sum("n").alias("nh"), F.count(F.lit(1)).alias("th")))
        current = (current.withColumn("g", F.expr(f"right(gram, {k})"))
                   .withColumn("h", F.expr("left(g, length(g) - 1)"))
                   .join(c, ["label", "g"], "left").join(h, ["label", "h"], "left")
                   .select("label", "gram",
                           F.when(F.col("nh").isNull(), F.col("p"))
                           .otherwise((F.coalesce("n", F.lit(0)) + F.col("th") * F.col("p"))
                                      / (F.col("nh") + F.col("th"))).alias("p")))
    prob = current.groupBy("gram").agg(F.sum(F.when(F.col("label") == "allow", F.log("p"))).alias("a"),
                                       F.sum(F.when(F.col("label") == "block", F.log("p"))).alias("b"))
    return prob.select("gram", (F.col("a") - F.col("b")).alias("ratio"))


def score(urls: DataFrame, model: DataFrame, *keep: str) -> DataFrame:
    """Mean ratio by character of every URL (0 for unknown grams). ``model``
    has at most 48^3 rows by its alphabet, so it is broadcast."""
    return (_grams(urls, "uid", *keep).join(F.broadcast(model), "gram", "left")
            .groupBy("uid", *keep).agg(F.avg(F.coalesce("ratio", F.lit(0.0))).alias("score")))


def _threshold(scored: DataFrame) -> float | None:
    """The cut with the best balanced accuracy on held-out URLs, by
    bins of 1 / BINS_PER_UNIT; scores are means of bounded logs, so the bins
    are few. None without held-out URLs of both classes."""
    bins = (scored.groupBy(F.floor(F.col("score") * BINS_PER_UNIT).alias("bin"))
            .agg(F.sum(F.when(F.col("label") == "allow", F.col("times")).otherwise(0)).alias("a"),
                 F.sum(F.when(F.col("label") == "block", F.col("times")).otherwise(0)).alias("b")))
    cells = F.array_sort(F.collect_list(F.struct("bin", "a", "b")))
    one = bins.agg(cells.alias("cells"), F.sum("a").alias("ta"), F.sum("b").alias("tb"))
    first = F.struct(F.lit(None).cast("double").alias("cut"), F.lit(-1.0).alias("best"),
                     F.lit(0.0).alias("below_a"), F.lit(0.0).alias("below_b"),
                     F.lit(None).cast("double").alias("last"))

    def step(acc, cell):
        good = ((F.col("ta") - acc["below_a"]) / F.greatest(F.col("ta"), F.lit(1))
                + acc["below_b"] / F.greatest(F.col("tb"), F.lit(1)))
        better = good > acc["best"]
        here = cell["bin"].cast("double")
        middle = (here + F.coalesce(acc["last"] + 1, here)) / 2 / BINS_PER_UNIT  # of the gap below
        return F.struct(F.when(better, middle).otherwise(acc["cut"]).alias("cut"),
                        F.greatest(good, acc["best"]).alias("best"),
                        (acc["below_a"] + cell["a"]).alias("below_a"),
                        (acc["below_b"] + cell["b"]).alias("below_b"), here.alias("last"))

    both = (F.coalesce(F.col("ta"), F.lit(0)) > 0) & (F.coalesce(F.col("tb"), F.lit(0)) > 0)
    return one.select(F.when(both, F.aggregate("cells", first, step)["cut"]).alias("cut")).first()["cut"]


def judge_urls(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", rules=RULES) -> DataFrame:
    """``(id, host, path, rule, verdict, score)`` of every row."""
    url = pages[url_col]
    host, path = host_and_path(url)
    rows = pages.select(pages[id_col].alias("id"), host.alias("host"), path.alias("path"),
                        F.coalesce(url, F.lit("")).alias("key")) \
        .withColumn("hit", match_rule(F.col("host"), F.col("path"), rules))
    # Distinct URLs with their counts: a URL that fills a third of the table is one row.
    urls = materialize(rows.groupBy("key").agg(F.first("hit").alias("hit"), F.count(F.lit(1)).alias("times"))
                       .select("key", F.col("hit.verdict").alias("label"), "times",
                               symbols(F.col("key")).alias("text"), F.monotonically_increasing_id().alias("uid"),
                               (F.pmod(F.xxhash64("key"), F.lit(HOLD_OUT)) == 0).alias("held")), "url-distinct")
    known = urls.filter(F.col("label").isNotNull())
    model = materialize(train(known.filter(~F.col("held"))), "url-model")
    scored = materialize(score(urls, model, "label", "times", "held"), "url-scores")
    cut = _threshold(scored.filter(F.col("label").isNotNull() & F.col("held")))
    judged = urls.select("key", "uid").join(scored, "uid").select("key", "score", F.when(F.col("score") < F.lit(cut).cast("double"), "block")
                           .otherwise("allow").alias("by_model"))
    return rows.join(judged, "key", "left").select(
        F.col("id").alias(id_col), "host", "path", F.col("hit.rule").alias("rule"),
        F.coalesce("hit.verdict", "by_model", F.lit("allow")).alias("verdict"),
        F.coalesce("score", F.lit(0.0)).alias("score"))

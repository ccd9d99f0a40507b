"""URL filters: rules first, then the ratio of two character language models.

A rule names a host and the beginning of a path; the longest fitting one decides.
The URLs that rules accept and reject train two Markov models over characters.
Each predicts a character from the longest context of up to two characters it
has seen, smoothed towards shorter ones (Witten-Bell). A URL no rule fits is
judged by the difference of its log-likelihoods per character. The threshold is
calibrated with models of one half of those URLs on the other half, which these
models have not seen; the models that judge are then fitted on all of them.

Only DataFrame functions are used. Counts cover all rows. The model has at most
``SIZE`` cubed entries whatever the input, so it goes to the tasks as one array.

Defined results: a null url, or one without ``://``, has an empty host and path.
If the rules decide no URL one way, every other URL is allowed. A difference
equal to the threshold allows. Repeated rows count as often as they occur and
get equal verdicts. URLs are read whole. Result columns replace columns of the
same name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quayside.llm.common import kept

#: Verdict, host and beginning of the path.
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
#: Known characters; any other counts as one more, and one stands for the beginning.
ALPHABET = "abcdefghijklmnopqrstuvwxyz0123456789.-_/:?=&#%"
SIZE = len(ALPHABET) + 2
#: The threshold lies at a multiple of this, and the calibration counts scores beyond the farthest as the farthest.
STEP, FARTHEST = 0.01, 4.0


def host_of(url: Column) -> Column:
    """Between the first ``://`` and the next ``/``, ``?``, ``#`` or the end, with A-Z in lower case."""
    found = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(found, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    """From the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules) -> Column:
    """The longest rule that fits, as a struct of rule and verdict, or null; of equally long ones the first by text."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, name, start in sorted(rules, key=lambda r: (len(r[1] + r[2]), r[1] + r[2])):
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(start)
        found = F.when(fits, F.struct(F.lit(name + start).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found




def with_triples(frame: DataFrame, url: str) -> DataFrame:
    """With ``triples``: for every character of the url in lower case, the number of itself after the two before it."""
    chars = F.filter(F.split(F.lower(F.coalesce(F.col(url), F.lit(""))), ""), lambda c: c != "")
    codes = F.transform(chars, lambda c: F.position(c, F.lit(ALPHABET)) + 1)
    frame = frame.withColumn("_codes", F.concat(F.array(F.lit(0), F.lit(0)), codes))
    triples = F.transform(
        F.slice("_codes", F.lit(3), F.greatest(F.size("_codes") - 2, F.lit(0))),
        lambda code, i: (F.get("_codes", i) * SIZE + F.get("_codes", i + 1)) * SIZE + code,
    )
    return frame.withColumn("triples", triples).drop("_codes")


def counts_of(decided: DataFrame) -> DataFrame:
    """How often each triple is in accepted and rejected URLs (``triples``, ``accepted``), by whether they are set ``apart``."""
    counts = decided.select(F.explode("triples").alias("triple"), "accepted", "apart").groupBy("triple", "apart")
    return counts.agg(F.count_if("accepted").alias("n_true"), F.count_if(~F.col("accepted")).alias("n_false"))


def model_of(counts: DataFrame) -> DataFrame:
    """One row: for every triple, the log of its probability among accepted over that among rejected URLs.

    The table below holds every triple there can be, whatever the input.
    """
    counts = counts.groupBy("triple").agg(F.sum("n_true").alias("n_true"), F.sum("n_false").alias("n_false"))
    every = counts.sparkSession.range(SIZE**3).withColumnRenamed("id", "triple")
    table = every.join(counts, "triple", "left").na.fill(0, ["n_true", "n_false"])
    a, b, c = F.expr(f"triple div {SIZE * SIZE}"), F.expr(f"triple div {SIZE} % {SIZE}"), F.expr(f"triple % {SIZE}")
    table = table.withColumns({"a": a, "b": b, "c": c})
    for side in ("true", "false"):
        n = f"n_{side}"
        table = table.withColumn("n_c", F.sum(n).over(Window.partitionBy("c")))
        table = table.withColumn("n_bc", F.sum(n).over(Window.partitionBy("b", "c")))
        middle = Window.partitionBy("b")
        table = table.withColumn("n_b", F.sum(n).over(middle))
        table = table.withColumn("t_b", F.size(F.collect_set(F.when(F.col("n_bc") > 0, F.col("c"))).over(middle)))
        before = Window.partitionBy("a", "b")
        table = table.withColumn("n_ab", F.sum(n).over(before)).withColumn("t_ab", F.count_if(F.col(n) > 0).over(before))
        table = table.withColumn("n_all", F.sum(n).over(Window.partitionBy(F.lit(0))))
        p = (F.col("n_c") + 1) / (F.col("n_all") + SIZE)
        for count, total, kinds in (("n_bc", "n_b", "t_b"), (n, "n_ab", "t_ab")):
            longer = (F.col(count) + F.col(kinds) * p) / (F.col(total) + F.col(kinds))
            p = F.when(F.col(total) > 0, longer).otherwise(p)
        table = table.withColumn(f"log_{side}", F.log(p)).drop("n_c", "n_bc", "n_b", "t_b", "n_ab", "t_ab", "n_all")
    pair = F.struct("triple", (F.col("log_true") - F.col("log_false")).cast("float").alias("ratio"))
    return table.agg(F.transform(F.sort_array(F.collect_list(pair)), lambda x: x["ratio"]).alias("ratios"))


def with_score(frame: DataFrame, model: DataFrame) -> DataFrame:
    """With ``score``, the mean log ratio over the characters; 0 for no characters."""
    frame = frame.withColumn("_ratios", model.scalar())
    total = F.aggregate("triples", F.lit(0.0), lambda s, t: s + F.element_at("_ratios", (t + 1).cast("int")))
    return frame.withColumn("score", total / F.greatest(F.size("triples"), F.lit(1))).drop("_ratios")


def threshold_of(scored: DataFrame) -> DataFrame:
    """One row: the threshold that keeps most accepted and blocks most rejected URLs, by shares; null if a side is empty."""
    step = F.round(F.greatest(F.least(F.col("score"), F.lit(FARTHEST)), F.lit(-FARTHEST)) / STEP).cast("int").alias("step")
    bins = scored.select(step, "accepted").groupBy("step")
    bins = bins.agg(F.count_if("accepted").alias("yes"), F.count_if(~F.col("accepted")).alias("no"))
    below = Window.partitionBy(F.lit(0)).orderBy("step").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(F.lit(0))
    lost = F.coalesce(F.sum("yes").over(below), F.lit(0)) / F.nullif(F.sum("yes").over(whole), F.lit(0))
    caught = F.coalesce(F.sum("no").over(below), F.lit(0)) / F.nullif(F.sum("no").over(whole), F.lit(0))
    best = bins.select("step", (caught - lost).alias("gain"))
    return best.agg(F.max_by((F.col("step") - 0.5) * STEP, F.struct("gain", -F.col("step"))).alias("threshold"), F.max("gain").alias("gain")).select(
        F.when(F.col("gain").isNotNull(), F.col("threshold")).alias("threshold")
    )


def judged(pages: DataFrame, url: str = "url", rules=RULES) -> DataFrame:
    """The rows with host, path, rule (null where none fits), verdict and the score that decides without a rule."""
    rows = pages.drop("host", "path", "rule", "verdict", "score")
    rows = rows.withColumns({"host": host_of(F.col(url)), "path": path_of(F.col(url))})
    rows = with_triples(rows.withColumn("_rule", rule_of(F.col("host"), F.col("path"), rules)), url)
    decided = rows.where(F.col("_rule").isNotNull())
    accepted, apart = F.col("_rule.verdict") == "allow", F.crc32(F.col(url)) % 2 == 1
    decided = decided.select("triples", accepted.alias("accepted"), apart.alias("apart"))
    counts = kept(counts_of(decided), "url-counts")
    half = kept(model_of(counts.where("not apart")), "url-model")
    threshold = kept(threshold_of(with_score(decided.where("apart"), half)), "url-threshold")
    rows = with_score(rows, kept(model_of(counts), "url-model"))
    by_model = F.when(F.col("score") < threshold.scalar(), "block").otherwise("allow")
    rows = rows.withColumns({"rule": F.col("_rule.rule"), "verdict": F.coalesce("_rule.verdict", by_model)})
    return rows.drop("_rule", "triples")


def op2_url_filters(spark, folder: str) -> DataFrame:
    pages = spark.read.parquet(f"{folder}/pages.parquet")
    return judged(pages.select("page_id", "url")).select("page_id", "host", "path", "rule", "verdict", "score")

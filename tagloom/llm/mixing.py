"""Temperature mixing of sources.

Shares of the sources' tokens are raised to an exponent and normalised. The exponent is the smallest of the steps between
0 (all sources alike) and 1 (natural shares) at which no source is repeated more often than allowed and the entropy is not
above its target; each bisection round halves the bracket six times at once in one aggregate over the per-source totals,
so any number of sources can take part. The weights become token budgets: whole passes over a source, each in an order of
its own, and a last pass that ends where the budget does.

Running sums over a source's order are taken in hash-range blocks of bounded size, so a source with a third of all rows is
spread over many tasks.

A null source counts as the source ''. Documents without tokens (null or blank text) are never drawn. Equal places in an
order go by id; repeated rows are drawn as rows of their own. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from tagloom.functions.scale import settle

ENTROPY = 0.95
REPEATS = 4.0
STEP_BITS = 6
ROUNDS = 5
BLOCK_ROWS = 2_000
SEED = "mix"


def token_counts(documents: DataFrame) -> DataFrame:
    tokens = F.regexp_count(F.coalesce("text", F.lit("")), F.lit("[^ \\t\\n\\x0B\\f\\r]+")).cast("long")
    return documents.select("doc_id", F.coalesce("source", F.lit("")).alias("source"), tokens.alias("n_tokens")).filter("n_tokens > 0")


def solve_exponent(totals: DataFrame, budget: int, entropy: float | None, repeats: float | None) -> float:
    """totals: source, n. The entropy target is a part of the entropy of equal weights; None leaves a limit out."""
    whole = totals.agg(F.sum("n").alias("n"), F.count("*").alias("k")).first()
    if not whole["n"]:
        return 1.0
    share = F.col("n") / F.lit(whole["n"])
    low, width = 0, 1 << (STEP_BITS * ROUNDS)
    top = width
    for _ in range(ROUNDS):
        width >>= STEP_BITS
        steps = F.explode(F.sequence(F.lit(low), F.lit(low + width * ((1 << STEP_BITS) - 1)), F.lit(width)))
        raised = totals.select(share.alias("p"), steps.alias("step")).withColumn("x", F.pow("p", F.col("step") / F.lit(top)))
        sums = raised.groupBy("step").agg(
            F.sum("x").alias("z"), F.sum(F.col("x") * F.ln("p")).alias("l"), F.max(F.col("x") / F.col("p")).alias("most")
        )
        fits = F.lit(True)
        if entropy is not None:
            level = F.ln("z") - F.col("step") / F.lit(top) * F.col("l") / F.col("z")
            fits &= level <= F.lit(entropy) * F.ln(F.lit(float(whole["k"])))
        if repeats is not None:
            fits &= F.col("most") / F.col("z") * F.lit(budget / whole["n"]) <= F.lit(repeats)
        ok = sums.filter(fits).agg(F.min("step").alias("s")).first()["s"]
        if ok is None:
            low += width * ((1 << STEP_BITS) - 1)
        elif ok == low:
            return low / top
        else:
            low = ok - width
    return (low + width) / top


def budgets(totals: DataFrame, budget: int, exponent: float) -> DataFrame:
    """totals with weight (in billionths) and budget in tokens."""
    whole = totals.agg(F.sum("n").alias("n")).first()["n"] or 1
    raised = totals.withColumn("x", F.pow(F.col("n") / F.lit(whole), F.lit(exponent)))
    z = raised.agg(F.sum("x").alias("z")).first()["z"] or 1.0
    weight = F.round(F.col("x") / F.lit(z) * 1e9).cast("long")
    exact = (weight.cast("decimal(20,0)") * F.lit(budget).cast("decimal(18,0)") / F.lit(1_000_000_000)).cast("decimal(38,6)")
    return raised.withColumn("weight", weight).withColumn("budget", F.floor(exact).cast("long")).drop("x")


def place(epoch: Column, doc_id: Column) -> Column:
    """A document's place in the order of a pass: 60 bits of a digest."""
    text = F.concat_ws(":", F.lit(SEED), epoch.cast("string"), F.coalesce(doc_id.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("long")


def mix_sources(
    documents: DataFrame, budget: int | None = None, entropy: float | None = ENTROPY, repeats: float | None = REPEATS
) -> DataFrame:
    """One row per document and pass: doc_id, source, epoch, start (tokens of the pass before it) and n_tokens.

    budget: tokens of the mixture, by default as many as the documents have.
    """
    counted = settle(token_counts(documents))
    totals = settle(counted.groupBy("source").agg(F.sum("n_tokens").alias("n"), F.count("*").alias("docs")))
    if budget is None:
        budget = totals.agg(F.sum("n").alias("n")).first()["n"] or 0
    plan = budgets(totals, budget, solve_exponent(totals, budget, entropy, repeats)).select(
        "source", F.expr("budget div n").alias("passes"), (F.col("budget") % F.col("n")).alias("rest"),
        F.ceil(F.col("docs") / BLOCK_ROWS).alias("blocks"),
    )
    last = F.col("passes") - F.when(F.col("rest") > 0, 0).otherwise(1)
    epochs = F.explode(F.when(last >= 0, F.sequence(F.lit(0).cast("long"), last)))
    drawn = counted.join(plan, "source").select("doc_id", "source", "n_tokens", "passes", "rest", "blocks", epochs.alias("epoch"))
    drawn = drawn.withColumn("place", place(F.col("epoch"), F.col("doc_id")))
    drawn = drawn.withColumn("block", F.floor(F.col("place") / F.lit(float(1 << 60)) * F.col("blocks")))
    sums = drawn.groupBy("source", "epoch", "block").agg(F.sum("n_tokens").alias("tokens"))
    order = Window.partitionBy("source", "epoch").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    before = sums.select("source", "epoch", "block", F.coalesce(F.sum("tokens").over(order), F.lit(0)).alias("before"))
    order = Window.partitionBy("source", "epoch", "block").orderBy("place", "doc_id").rowsBetween(Window.unboundedPreceding, -1)
    inner = drawn.withColumn("within", F.coalesce(F.sum("n_tokens").over(order), F.lit(0)))
    rows = inner.join(before, ["source", "epoch", "block"]).withColumn("start", F.col("before") + F.col("within"))
    kept = (F.col("epoch") < F.col("passes")) | (F.col("start") < F.col("rest"))
    return rows.filter(kept).select("doc_id", "source", "epoch", "start", "n_tokens")


ORACLE = r"""
WITH RECURSIVE c AS (SELECT doc_id, coalesce(source, '') AS source, len(regexp_extract_all(coalesce(text, ''), '[^ \t\n\x0B\f\r]+')) AS n_tokens FROM documents),
d AS (SELECT doc_id, source, CAST(n_tokens AS BIGINT) AS n_tokens FROM c WHERE n_tokens > 0),
t AS (SELECT source, CAST(sum(n_tokens) AS BIGINT) AS n FROM d GROUP BY source),
w AS (SELECT sum(n) AS n, count(*) AS k FROM t),
s AS (SELECT source, t.n, CAST(t.n AS DOUBLE) / w.n AS p FROM t, w),
bis AS (
  SELECT 0 AS i, CAST(-1 AS BIGINT) AS lo, CAST(1073741824 AS BIGINT) AS hi
  UNION ALL
  SELECT i + 1, CASE WHEN ok THEN lo ELSE mid END, CASE WHEN ok THEN mid ELSE hi END FROM (
    SELECT i, lo, hi, (lo + hi) // 2 AS mid, (SELECT ln(z) - a * l / z <= 0.95 * ln(CAST(k AS DOUBLE)) AND m / z <= 4.0 FROM
      (SELECT sum(pow(p, a)) AS z, sum(pow(p, a) * ln(p)) AS l, max(pow(p, a) / p) AS m FROM s, (SELECT ((lo + hi) // 2) / 1073741824.0 AS a)),
      (SELECT ((lo + hi) // 2) / 1073741824.0 AS a), (SELECT k FROM w)) AS ok
    FROM bis WHERE hi - lo > 1)),
e AS (SELECT min(hi) / 1073741824.0 AS a FROM bis),
z AS (SELECT sum(pow(p, a)) AS z FROM s, e),
b AS (SELECT source, s.n, CAST(floor(CAST(round(pow(p, a) / z.z * 1e9) AS HUGEINT) * w.n // 1000000000) AS BIGINT) AS budget FROM s, e, z, w),
x AS (SELECT doc_id, d.source, n_tokens, budget // n AS passes, budget % n AS rest, unnest(range(0, budget // n + CASE WHEN budget % n > 0 THEN 1 ELSE 0 END)) AS epoch FROM d JOIN b USING (source)),
r AS (SELECT *, CAST(coalesce(sum(n_tokens) OVER (PARTITION BY source, epoch ORDER BY substr(md5('mix:' || epoch || ':' || doc_id), 1, 15), doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start FROM x)
SELECT doc_id, source, epoch, start, n_tokens FROM r WHERE epoch < passes OR start < rest
"""

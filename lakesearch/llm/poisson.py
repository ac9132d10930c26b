"""Mixing sources to target weights by Poisson replication.

A source with share w of the target and n of all N documents is repeated w * budget / n
times on average. Each document's count is the inverse of that Poisson distribution at a
uniform number hashed from seed, id, text and the row's number among equal rows, so reruns and
lost executors give the same rows, and rows that share an id, or have none, are drawn one by one.
Rates above RATE_STEP are a sum of independent draws, each with a rate up to RATE_STEP.
Documents are exploded by their counts and dealt out by a hash of seed, row and copy, in the
order of which they lie within each partition: a global shuffle.

Equal rows are numbered by grouping them: one row with their count, which is then repeated. A row
that many copies share is added up where they are read.

Defined results: a null source counts as the empty name; sources without a target get none;
a null id hashes as empty, a null text as the empty text; equal rows (in all columns) are
numbered from 1; columns `copy` and `n_copies` of the caller give way to the result's, all other
columns stay, whatever their names; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakesearch.functions.once import once

#: Largest rate that one draw stands for, and terms of its distribution function.
RATE_STEP = 16
TERMS = 80


def uniform(*parts: Column) -> Column:
    """A number in [0, 1) with 52 bits, hashed from the parts."""
    text = F.concat_ws("|", *[p.cast("string") for p in parts])
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10).cast("long") / F.lit(float(1 << 52))


def rates(docs: DataFrame, by: str, targets: dict[str, float] | None = None, budget: int | None = None) -> DataFrame:
    """(name, rate): mean repetitions for each source. Without targets all sources weigh the same."""
    counts = docs.groupBy(F.coalesce(F.col(by), F.lit("")).alias("name")).agg(F.count("*").alias("n"))
    if targets is None:
        shares = counts.withColumn("weight", F.lit(1.0))
    else:
        weights = docs.sparkSession.createDataFrame(list(targets.items()), "name string, weight double")
        shares = counts.join(weights, "name")
    total = counts.agg(F.sum("n")).first()[0]
    weights = shares.agg(F.sum("weight")).first()[0]
    goal = budget if budget is not None else total or 0
    return shares.select("name", (F.col("weight") / F.lit(float(weights or 1)) * F.lit(float(goal)) / F.col("n")).alias("rate"))


def _distribution(rate: Column) -> Column:
    """P(count <= k) for k = 0, 1, ... TERMS as an array."""
    state = F.struct(F.exp(-rate).alias("p"), F.array(F.exp(-rate)).alias("f"))

    def step(s: Column, k: Column) -> Column:
        p = s["p"] * rate / k
        return F.struct(p.alias("p"), F.concat(s["f"], F.array(F.element_at(s["f"], -1) + p)).alias("f"))

    return F.aggregate(F.sequence(F.lit(1), F.lit(TERMS)), state, step)["f"]


#: Prefix of the columns in between.
_OWN = "__mix_"


def numbered(docs: DataFrame) -> DataFrame:
    """The rows with their number among rows equal in all columns, from 1."""
    number = _OWN + "number"
    key = F.md5(F.to_json(F.struct(*docs.columns), {"ignoreNullFields": "false"}).cast("binary"))
    if docs.groupBy(key.alias("key")).count().where("count > 1").isEmpty():
        return docs.withColumn(number, F.lit(1).cast("long"))
    groups = docs.groupBy(*docs.columns).agg(F.count("*").alias(_OWN + "n"))
    return groups.withColumn(number, F.explode(F.sequence(F.lit(1).cast("long"), F.col(_OWN + "n")))).drop(_OWN + "n")


def replicate(docs: DataFrame, by: str, source_rates: DataFrame, seed: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents, each `n_copies` times, numbered by `copy` from 1, globally shuffled."""
    draws = F.greatest(F.ceil(F.col("rate") / RATE_STEP), F.lit(1)).cast("int")
    name, n_draws, f_, row, draws_, place = (_OWN + c for c in ("name", "n_draws", "f", "row", "draws", "place"))
    table = source_rates.select(F.col("name").alias(name), draws.alias(n_draws), _distribution(F.col("rate") / draws).alias(f_))
    rows = numbered(docs.drop("copy", "n_copies")).withColumn(name, F.coalesce(F.col(by), F.lit(""))).join(table, name)
    digest = F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary"))
    rows = once(rows, **{row: F.concat_ws("|", F.coalesce(F.col(key).cast("string"), F.lit("")), digest, F.col(_OWN + "number").cast("string"))})
    # A row's numbers first, as an array, so that each is hashed once and not for every term.
    rows = once(rows, **{draws_: F.transform(F.sequence(F.lit(1), F.col(n_draws)), lambda i: uniform(F.lit(seed), F.col(row), i))})
    n = F.aggregate(draws_, F.lit(0), lambda s, u: s + F.size(F.filter(f_, lambda f: f <= u)))
    rows = once(rows, n_copies=n).where("n_copies > 0")
    rows = rows.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("n_copies"))))
    rows = rows.withColumn(place, F.md5(F.concat_ws("|", F.lit(f"{seed}#place"), F.col(row), F.col("copy").cast("string")).cast("binary")))
    kept = [*(c for c in docs.columns if c not in ("copy", "n_copies")), "n_copies", "copy"]
    return rows.select(*kept, place).repartition(place).sortWithinPartitions(place).drop(place)

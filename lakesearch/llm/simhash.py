"""SimHash fingerprints of 64 bits, and a search within a Hamming radius by block tables.

Terms are runs of five words (a shorter text is one term); each occurrence votes, so a
term's weight is its count. Bit b of the fingerprint is set if more than half of the votes
have bit b of their hash set. Votes are summed two bits to a column: bits b and b + 32 of
a hash stay apart in the lower and upper half of a long.

For the search, 64 bits are cut into radius + 2 blocks. Two fingerprints within the
radius differ in at most `radius` blocks, so they agree in two at least: there is a table
for each pair of blocks, keyed by those, and a join per table finds every pair.

Defined results: null text counts as empty; a text without words has fingerprint 0; a null
id comes first in the order of ids; rows alike in id and text are computed once and give a row each; an empty
table gives no rows; columns other than id and text are not looked at.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakesearch.llm.common import ranged, whole_text, within_part
from lakesearch.session import written

WORDS = 5
BITS = 64
#: Repeated rows are given back in runs of so many.
RUN = 4096
#: Stands for a null id in joins.
NO_ID = -(1 << 63)


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def fingerprints(rows: DataFrame, keys: list[str], text: str) -> DataFrame:
    """(keys, fp long): one vote an occurrence of a term, summed for each combination of the keys."""
    words = rows.select(*keys, F.filter(F.split(F.col(text), r"\s+"), lambda w: w != "").alias("w0"))
    n = F.size("w0")
    for i in range(1, WORDS):
        words = words.withColumn(f"w{i}", F.slice("w0", i + 1, F.greatest(n, F.lit(1))))
    runs = F.slice(F.arrays_zip(*[f"w{i}" for i in range(WORDS)]), 1, F.greatest(n - (WORDS - 1), F.lit(1)))
    each = words.select(*keys, F.explode_outer(runs).alias("t"))
    hashed = each.select(*keys, F.when(F.col("t").isNotNull(), F.xxhash64(*[F.col("t")[f"w{i}"] for i in range(WORDS)])).alias("h"))
    both = F.lit((1 << 32) | 1)
    sums = [F.sum(F.shiftrightunsigned("h", b).bitwiseAND(both)).alias(f"s{b}") for b in range(BITS // 2)]
    voted = hashed.groupBy(*keys).agg(F.count("h").alias("n"), *sums)
    fp = F.lit(0).cast("long")
    for b in range(BITS):
        half = F.col(f"s{b}").bitwiseAND(F.lit((1 << 32) - 1)) if b < 32 else F.shiftrightunsigned(f"s{b - 32}", 32)
        fp = fp.bitwiseOR(F.when(half * 2 > F.col("n"), F.lit(_signed(1 << b))).otherwise(F.lit(0).cast("long")))
    return voted.select(*keys, fp.alias("fp"))


def distance(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def likeness(a: Column, b: Column) -> Column:
    """Share of equal bits."""
    return (F.lit(BITS) - distance(a, b)) / F.lit(float(BITS))


def table_masks(radius: int) -> list[int]:
    """The bits that each table is keyed by."""
    n = radius + 2
    edges = [BITS * i // n for i in range(n + 1)]
    blocks = [(1 << edges[i + 1]) - (1 << edges[i]) for i in range(n)]
    return [_signed(a | b) for a, b in combinations(blocks, 2)]


def block_tables(fps: DataFrame, fp: str, radius: int) -> DataFrame:
    """The rows once for each table, with `table` and the `block` they are joined by."""
    tables = [F.struct(F.lit(t).alias("table"), F.col(fp).bitwiseAND(F.lit(m)).alias("block")) for t, m in enumerate(table_masks(radius))]
    return fps.withColumn("_t", F.explode(F.array(*tables))).select(*fps.columns, "_t.table", "_t.block")


def within_radius(queries: DataFrame, fps: DataFrame, radius: int = 3) -> DataFrame:
    """(query, fp, bits): every fingerprint within `radius` bits of each query fingerprint.

    Both sides are made distinct first (column `fp`), so copies cost nothing; a pair that
    agrees in several tables is given by the first of them only.
    """
    left = block_tables(queries.select(F.col("fp").alias("query")).distinct(), "query", radius)
    right = block_tables(fps.select("fp").distinct(), "fp", radius)
    query, fp = F.col("query"), F.col("fp")
    first = F.lit(-1)
    for t, m in reversed(list(enumerate(table_masks(radius)))):
        first = F.when(query.bitwiseXOR(fp).bitwiseAND(F.lit(m)) == 0, F.lit(t)).otherwise(first)
    found = left.join(right, ["table", "block"]).where(distance(query, fp) <= radius).where(F.col("table") == first)
    return found.select("query", "fp", distance(query, fp).alias("bits"))


def _texts(docs: DataFrame) -> DataFrame:
    """(id, th, text), one row for rows alike in id and text."""
    rows = docs.select(F.coalesce("doc_id", F.lit(NO_ID)).alias("id"), F.xxhash64(whole_text()).alias("th"), whole_text().alias("text"))
    return rows.dropDuplicates(["id", "th"])


def neighbours(docs: DataFrame) -> DataFrame:
    """(id, th, n_chars, copies, next_id, next_th): who follows by (id, th); after the last, the first."""
    text = whole_text()
    ids = docs.select(F.coalesce("doc_id", F.lit(NO_ID)).alias("id"), F.xxhash64(text).alias("th"), F.length(text).cast("long").alias("n_chars"))
    ids = ids.groupBy("id", "th", "n_chars").agg(F.count("*").alias("copies"))
    parts = ranged(ids, ["id", "th"])
    over = Window.orderBy("part")  # one row a range
    everything = over.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    firsts = parts.groupBy("part").agg(F.min(F.struct("id", "th")).alias("own"))
    firsts = firsts.select("part", F.coalesce(F.lead("own").over(over), F.first("own").over(everything)).alias("next_own"))
    after = F.coalesce(F.lead(F.struct("id", "th")).over(within_part(["id", "th"])), F.col("next_own"))
    rows = parts.join(firsts, "part").select("id", "th", "n_chars", "copies", after.alias("after"))
    return written(rows.select("id", "th", "n_chars", "copies", F.col("after.id").alias("next_id"), F.col("after.th").alias("next_th")))


def edited(docs: DataFrame, order: DataFrame) -> DataFrame:
    """(id, th, text, edited): the last quarter replaced by as much of the next document's start."""
    texts = _texts(docs)
    takes = F.floor(F.col("n_chars") / 4).cast("int")
    wanted = order.select(F.col("id").alias("for_id"), F.col("th").alias("for_th"), "n_chars", takes.alias("take"), F.col("next_id").alias("id"), F.col("next_th").alias("th"))
    heads = texts.join(wanted, ["id", "th"]).select(F.col("for_id").alias("id"), F.col("for_th").alias("th"), "n_chars", "take", F.expr("left(text, take)").alias("head"))
    kept = F.expr("left(text, cast(n_chars as int) - take)")
    return texts.join(heads, ["id", "th"]).select("id", "th", "text", F.concat(kept, F.col("head")).alias("edited"))


def edit_study(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and its edited text, and how alike they are."""
    order = neighbours(docs)
    pairs = edited(docs, order).select("id", "th", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"), F.explode(F.array(F.struct(F.lit(0).alias("kind"), F.col("text").alias("of")), F.struct(F.lit(1).alias("kind"), F.col("edited").alias("of")))).alias("v"))
    votes = fingerprints(pairs.select("id", "th", "edited_sha256", "v.kind", "v.of"), ["id", "th", "edited_sha256", "kind"], "of")
    one = written(
        votes.groupBy("id", "th", "edited_sha256").agg(F.max(F.when(F.col("kind") == 0, F.col("fp"))).alias("fp"), F.max(F.when(F.col("kind") == 1, F.col("fp"))).alias("edited_fp"))
    )
    following = one.select(F.col("id").alias("next_id"), F.col("th").alias("next_th"), F.col("fp").alias("next_fp"))
    rows = one.join(order, ["id", "th"]).join(following, ["next_id", "next_th"])
    rows = rows.withColumn("run", F.explode(F.expr(f"sequence(0, (copies - 1) div {RUN})")))
    rows = rows.withColumn("copy", F.explode(F.expr(f"sequence(1, least({RUN}, copies - run * {RUN}))")))

    def shown(fp: str) -> Column:
        return F.lower(F.lpad(F.hex(fp), 16, "0"))

    return rows.select(
        F.when(F.col("id") != NO_ID, F.col("id")).alias("doc_id"),
        "n_chars",
        "edited_sha256",
        shown("fp").alias("fingerprint"),
        shown("edited_fp").alias("edited_fingerprint"),
        likeness(F.col("fp"), F.col("edited_fp")).alias("near_edited"),
        likeness(F.col("fp"), F.col("next_fp")).alias("near_next"),
    )

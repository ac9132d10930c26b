"""Language of web pages and documents by Bayesian fusion of four kinds of evidence.

- the text: hashed byte trigrams under one model a language, tempered because overlapping
  trigrams are not independent; one more class, `und`, spreads evenly over all trigrams and
  wins where no language fits;
- the declared language (markup or metadata): P(declared | language) from grouped sums of
  the text posteriors over all rows;
- the address suffix: P(suffix | language), likewise;
- the host: a prior smoothed towards its registered domain, and that towards all rows.

The models are fitted on a bounded sample of labelled texts of every language (LANGUAGE_TEXTS
distinct ones each, their first SAMPLE_CHARS characters, in the order of a hash of the text), so that
a rare language has a model too. All counts cover all rows.

Defined results: null text, host or declared language give no evidence of that kind; a
text without letters is decided by the rest and has `n_grams` 0; ties go to the language first
in the alphabet; repeated rows give repeated rows; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakesearch.llm.bpe import in_slices
from lakesearch.session import written

BUCKETS = 1 << 16
UND = "und"
LANGUAGE_TEXTS = 500
#: Languages that get a model: those with the most texts. A model takes 256 kB; all other codes are `other`.
MAX_LANGUAGES = 100
SALTS = 32
SAMPLE_CHARS = 100_000
#: Weight of one trigram: it shares two bytes with each neighbour.
TEMPER = 1 / 3
#: Pseudo-rows: of a host's domain in its prior, of all rows in the domain's, and of each cell elsewhere.
HOST_ROWS = 20.0
DOMAIN_ROWS = 20.0
CELL_ROWS = 1.0

#: Bytes as the models see them: letters and bytes of other scripts stay, the rest is blank.
_SEEN = np.full(256, 32, np.uint8)
_SEEN[97:123] = np.arange(97, 123)
_SEEN[128:] = np.arange(128, 256)


def trigrams(text: str) -> np.ndarray:
    """Hashed trigrams of the lower-cased text, without those that begin or stay in a gap."""
    b = _SEEN[np.frombuffer(f" {text.lower()} ".encode("utf-8", "replace"), np.uint8)]
    keep = np.ones(len(b), bool)
    keep[1:] = (b[1:] != 32) | (b[:-1] != 32)
    b = b[keep].astype(np.uint32)
    if len(b) < 3:
        return np.empty(0, np.int64)
    code = (b[:-2] * 65536 + b[1:-1] * 256 + b[2:]) * np.uint32(2654435761)
    return (code >> np.uint32(16)).astype(np.int64)


class Model:
    """Log-likelihoods of hashed trigrams, a column a class; the last class is `und`."""

    def __init__(self, languages: list[str], counts: np.ndarray):
        self.classes = [*languages, UND]
        p = (counts + 0.1) / (counts.sum(axis=1, keepdims=True) + 0.1 * BUCKETS)
        self.log_p = np.vstack([np.log(p), np.full((1, BUCKETS), -np.log(BUCKETS))]).T.astype(np.float32)

    def score(self, text: str) -> tuple[int, np.ndarray]:
        grams = trigrams(text)
        if not len(grams):
            return 0, np.zeros(len(self.classes))
        step = 1 << 20
        total = sum(self.log_p[grams[i : i + step]].sum(axis=0, dtype=np.float64) for i in range(0, len(grams), step))
        return len(grams), total * TEMPER


def language_code(declared: Column) -> Column:
    """The primary code of a declared language, in lower case; empty without one."""
    return F.lower(F.regexp_extract(F.coalesce(declared, F.lit("")), "^[A-Za-z]+", 0))


def fit(labelled: DataFrame, text: str = "text", lang: str = "lang") -> Model:
    """Models from a bounded sample of each language, counted in the tasks: one array a language returns."""
    rows = labelled.select(F.substring(F.col(text), 1, SAMPLE_CHARS).alias("text"), language_code(F.col(lang)).alias("lang")).where(f"text is not null and lang not in ('', '{UND}')")
    rows = rows.withColumn("h", F.xxhash64("text", "lang"))
    # The hashes are chosen first, so that no more texts than those of the sample are moved.
    hashes = rows.select("lang", "h").distinct()
    languages = hashes.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(MAX_LANGUAGES).select("lang")
    # In two steps, so that no task ranks all texts of a frequent language.
    chosen = hashes.join(F.broadcast(languages), "lang").withColumn("salt", F.pmod("h", F.lit(SALTS)))
    for by in (["lang", "salt"], ["lang"]):
        first = Window.partitionBy(*by).orderBy("h")
        chosen = chosen.withColumn("n", F.row_number().over(first)).where(F.col("n") <= LANGUAGE_TEXTS).drop("n")
    chosen = chosen.drop("salt")
    sample = rows.join(F.broadcast(chosen), ["lang", "h"]).dropDuplicates(["lang", "h"])

    def count(texts: pd.DataFrame) -> pd.DataFrame:
        counts = sum(np.bincount(trigrams(t), minlength=BUCKETS) for t in texts["text"])
        return pd.DataFrame({"lang": [texts["lang"].iloc[0]], "counts": [counts.astype("<i4").tobytes()]})

    found = sorted(sample.select("lang", "text").groupBy("lang").applyInPandas(count, "lang string, counts binary").collect())
    counts = np.array([np.frombuffer(r["counts"], "<i4") for r in found], float).reshape(len(found), BUCKETS)
    return Model([r["lang"] for r in found], counts)


def address_parts(host: Column) -> dict[str, Column]:
    labels = F.split(F.lower(F.coalesce(host, F.lit(""))), r"\.")
    n = F.size(labels)
    return {
        "host": F.array_join(labels, "."),
        "domain": F.array_join(F.slice(labels, F.greatest(n - 1, F.lit(1)), F.lit(2)), "."),
        "suffix": F.element_at(labels, -1),
    }


def _evidence(rows: DataFrame, model: Model, keys: list[str]) -> DataFrame:
    """The keys, address parts, declared class, n_grams, and ll_i, post_i for each class."""
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    k = len(model.classes)
    kept = [*keys, "host", "domain", "suffix", "declared"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in in_slices(whole, whole.schema.get_field_index("text"))):
            scored = [model.score(t or "") for t in batch.column("text").to_pylist()]
            ll = np.array([s for _, s in scored]).reshape(len(scored), k)
            post = np.exp(ll - ll.max(axis=1, keepdims=True))
            post /= post.sum(axis=1, keepdims=True)
            columns = [batch.column(c) for c in kept] + [pa.array([n for n, _ in scored], pa.int64())]
            columns += [pa.array(ll[:, i]) for i in range(k)] + [pa.array(post[:, i]) for i in range(k)]
            names = [*kept, "n_grams", *[f"ll_{i}" for i in range(k)], *[f"post_{i}" for i in range(k)]]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = ", ".join(f"`{c}` {kinds[c]}" for c in kept) + ", n_grams long"
    schema += "".join(f", ll_{i} double" for i in range(k)) + "".join(f", post_{i} double" for i in range(k))
    return rows.mapInArrow(run, schema)


def identify(rows: DataFrame, keys: list[str], text: Column, declared: Column, host: Column, model: Model) -> DataFrame:
    """(keys, lang, confidence, text_lang, declared, n_grams): the class with the highest posterior."""
    classes, k = model.classes, len(model.classes)
    said = language_code(declared)
    said = F.when(said.isin(classes[:-1]), said).when(said == "", F.lit("")).otherwise(F.lit("other"))
    renamed = [F.col(c).alias(f"key_{i}") for i, c in enumerate(keys)]
    inputs = rows.select(*renamed, F.coalesce(text, F.lit("")).alias("text"), said.alias("declared"), *[c.alias(n) for n, c in address_parts(host).items()])
    # A written table of short rows: the sums below and the last join start from it.
    seen = written(_evidence(inputs, model, [f"key_{i}" for i in range(len(keys))]))

    # Sums of the text posteriors; rows without letters say nothing about their group.
    posts = [F.sum(f"post_{i}").alias(f"n_{i}") for i in range(k)]
    hosts = written(seen.where("n_grams > 0").groupBy("host", "domain", "suffix").agg(*posts))
    add = [F.sum(f"n_{i}").alias(f"n_{i}") for i in range(k)]
    everywhere = [x or 0.0 for x in hosts.agg(*add).first()]
    total = sum(everywhere)
    base = [(x + CELL_ROWS) / (total + CELL_ROWS * k) for x in everywhere]

    # At most len(classes) + 2 rows.
    said_rows = {r["declared"]: [r[f"n_{i}"] for i in range(k)] for r in seen.where("n_grams > 0 and declared <> ''").groupBy("declared").agg(*posts).collect()}
    n_said = [sum(v[i] for v in said_rows.values()) for i in range(k)]
    names = [*classes[:-1], "other"]

    def log_declared(i: int) -> Column:
        found = F.lit(0.0)
        for name in names:
            p = (said_rows.get(name, [0.0] * k)[i] + CELL_ROWS) / (n_said[i] + CELL_ROWS * len(names))
            found = F.when(F.col("declared") == name, F.lit(float(np.log(p)))).otherwise(found)
        return found

    sums = [f"n_{i}" for i in range(k)]
    domains = hosts.groupBy("domain", "suffix").agg(*add)
    suffixes = domains.groupBy("suffix").agg(*[F.sum(c).alias(f"s_{i}") for i, c in enumerate(sums)])
    n_domain, n_host = (sum((F.col(f"{x}_{i}") for i in range(1, k)), F.col(f"{x}_0")) for x in ("d", "n"))
    priors = hosts.join(domains.select("domain", "suffix", *[F.col(c).alias(f"d_{i}") for i, c in enumerate(sums)]), ["domain", "suffix"]).join(suffixes, "suffix")
    of_domain = [(F.col(f"d_{i}") + DOMAIN_ROWS * base[i]) / (n_domain + DOMAIN_ROWS) for i in range(k)]
    of_host = [(F.col(f"n_{i}") + HOST_ROWS * of_domain[i]) / (n_host + HOST_ROWS) for i in range(k)]
    of_suffix = [(F.col(f"s_{i}") + CELL_ROWS) / F.lit(everywhere[i] + CELL_ROWS) for i in range(k)]
    address = priors.select("host", *[(F.log(of_host[i]) + F.when(F.col("host") != "", F.log(of_suffix[i])).otherwise(0.0)).alias(f"a_{i}") for i in range(k)])

    joined = seen.join(address, "host", "left")
    logs = [F.col(f"ll_{i}") + log_declared(i) + F.coalesce(F.col(f"a_{i}"), F.lit(float(np.log(base[i])))) for i in range(k)]
    joined = joined.select("*", *[x.alias(f"l_{i}") for i, x in enumerate(logs)])
    joined = joined.withColumns({"top": F.greatest(*[F.col(f"l_{i}") for i in range(k)], F.col("l_0")), "top_ll": F.greatest(*[F.col(f"ll_{i}") for i in range(k)], F.col("ll_0"))})

    def first_with(prefix: str, top: str) -> Column:
        return F.coalesce(*[F.when(F.col(f"{prefix}_{i}") == F.col(top), F.lit(classes[i])) for i in range(k)])

    rest = sum((F.exp(F.col(f"l_{i}") - F.col("top")) for i in range(1, k)), F.exp(F.col("l_0") - F.col("top")))
    return joined.select(
        *[F.col(f"key_{i}").alias(c) for i, c in enumerate(keys)],
        first_with("l", "top").alias("lang"),
        (1 / rest).alias("confidence"),
        F.when(F.col("n_grams") > 0, first_with("ll", "top_ll")).alias("text_lang"),
        F.when(F.col("declared") != "", F.col("declared")).alias("declared"),
        "n_grams",
    )


def visible_text(html: Column) -> Column:
    """Markup to blanks: scripts, styles, comments and tags."""
    return F.regexp_replace(F.coalesce(html, F.lit("")), r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>", " ")


def declared_in(html: Column) -> Column:
    """The lang attribute of the html element, or null."""
    found = F.regexp_extract(html, r"(?i)<html[^>]*?\slang\s*=\s*[\"']?\s*([A-Za-z]+)", 1)
    return F.when(found != "", found)


def host_of(url: Column) -> Column:
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?i)^(?:[a-z][a-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1)
    return F.when(found != "", found)

"""Near-duplicate classes by DartMinHash over weighted shingle sets.

A document is the multiset of its runs of WORDS words (see `words`); a text with fewer words is one run. Darts are thrown, by hashes alone, into the
plane of weight and rank of every shingle, region by region; a dart hits a document if it
lies under the shingle's weight, and the document looks at ranks up to a bound that fits
its total weight. The earliest dart at each of K coordinates is the signature; two documents
agree in a coordinate with the probability of their weighted Jaccard similarity.

Signatures are cut into BANDS; documents that share a band's hash are candidates. Equal
texts are one node. Each bucket links its members to one centre, so a bucket of m documents
gives m - 1 pairs, and every pair is verified on the exact multisets. Verified pairs give
components. Members of a bucket that are still in different components are tried
against other centres, and at last against one another: no candidate pair is left that is
neither in one component nor tested. Small buckets are joined for that; in large ones
documents outside the main component are compared with the rest in blocks of fixed size.

Defined results: null text counts as empty; texts without a word are alike only if equal;
a null id has a null class; rows that share an id share a class; a class is named by its
smallest id; an empty table gives no rows; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakesearch.llm.bpe import in_slices
from lakesearch.llm.common import whole_text
from lakesearch.llm.words import word_hashes
from lakesearch.session import written

WORDS = 5
SIMILARITY = 0.8
ROWS = 7
BANDS = 34
K = ROWS * BANDS
#: Documents whose darts are thrown at once.
DOCS_AT_ONCE = 256
#: Rounds with other centres before the rest of a bucket is compared pair by pair.
CENTRE_ROUNDS = 2
#: Buckets of up to this many members are then joined with themselves, larger ones compared in blocks.
SMALL_BUCKET = 16
#: Documents of the two sides of a block.
FEW, MANY = 64, 512

GOLD = np.uint64(0x9E3779B97F4A7C15)
FIRST_RANK = 1 / 16


def mix(x: np.ndarray) -> np.ndarray:
    """Finalizer of splitmix64, on unsigned 64-bit integers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def unit(x: np.ndarray) -> np.ndarray:
    return (x >> np.uint64(11)) * 2.0**-53


def _rolled(h: np.ndarray, words: int) -> np.ndarray:
    """Hash of each run of `words` words."""
    n = len(h) - words + 1
    run = np.full(n, words, np.uint64)
    for i in range(words):
        run = mix(run * GOLD + h[i : i + n])
    return run


def _multiset(runs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    runs = np.sort(runs)
    first = np.flatnonzero(np.concatenate([[True], runs[1:] != runs[:-1]])[: len(runs)])
    return runs[first], np.diff(np.append(first, len(runs))).astype(np.uint32)


def shingle_sets(texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each text the hashes of its distinct shingles, sorted, and how often each occurs."""
    (h,), sizes = word_hashes(texts)
    h = mix(h)
    run = _rolled(h, WORDS) if len(h) >= WORDS else h[:0]
    out, start = [], 0
    for n in sizes.tolist():
        own = run[start : start + n - WORDS + 1] if n >= WORDS else _rolled(h[start : start + n], n) if n else h[:0]
        out.append(_multiset(own))
        start += n
    return out


def shingles(text: str) -> tuple[np.ndarray, np.ndarray]:
    return shingle_sets([text])[0]


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard similarity of two sorted multisets."""
    total = int(a[1].sum(dtype=np.int64)) + int(b[1].sum(dtype=np.int64))
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    shared = int(np.minimum(a[1][i], b[1][j]).sum(dtype=np.int64))
    return shared / (total - shared) if total else 0.0


_poisson: dict[float, np.ndarray] = {}


def poisson_cdf(mean: float) -> np.ndarray:
    """Distribution function, far enough into the tail."""
    if mean not in _poisson:
        k = np.arange(int(mean + 12 * np.sqrt(mean) + 24))
        log_factorial = np.concatenate([[0.0], np.cumsum(np.log(k[1:]))])
        _poisson[mean] = np.cumsum(np.exp(k * np.log(mean) - mean - log_factorial))
    return _poisson[mean]


def throw(elements: np.ndarray, weights: np.ndarray, owner: np.ndarray, bound: np.ndarray):
    """(owner, coordinate, rank, dart) of all darts that hit, up to each owner's rank bound."""
    found, nu = [], 0
    while True:
        w_low, w_size = (0.0, 1.0) if nu == 0 else (2.0 ** (nu - 1),) * 2
        deep = np.flatnonzero(weights > w_low)
        if not len(deep):
            break
        rho = 0
        while True:
            r_low, r_size = (0.0, FIRST_RANK) if rho == 0 else (FIRST_RANK * 2.0 ** (rho - 1),) * 2
            deep = deep[bound[owner[deep]] > r_low]
            if not len(deep):
                break
            region = mix(elements[deep] + np.array([nu * 64 + rho + 1], np.uint64) * GOLD)
            n = np.searchsorted(poisson_cdf(w_size * r_size), unit(region), "right")
            hit = np.flatnonzero(n)
            n = n[hit]
            at = np.repeat(hit, n)
            number = np.arange(len(at), dtype=np.uint64) - np.repeat(np.cumsum(n) - n, n).astype(np.uint64)
            dart = mix(region[at] + (number + np.uint64(1)) * GOLD)
            place = mix(dart + GOLD)
            rank = r_low + r_size * unit(place)
            e = deep[at]
            ok = (w_low + w_size * unit(dart) < weights[e]) & (rank < bound[owner[e]])
            dart, rank, e, place = dart[ok], rank[ok], e[ok], place[ok]
            coordinate = ((mix(place + GOLD) >> np.uint64(32)) * np.uint64(K) >> np.uint64(32)).astype(np.int64)
            found.append((owner[e], coordinate, rank, dart))
            rho += 1
        nu += 1
    return [np.concatenate(x) for x in zip(*found)]


def signatures(sets: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """A row of K darts for each non-empty multiset."""
    out = np.zeros((len(sets), K), np.uint64)
    bound = np.array([K * (np.log(K) + 3) / w.sum(dtype=np.float64) for _, w in sets])
    todo = np.arange(len(sets))
    while len(todo):
        owner = np.repeat(np.arange(len(todo)), [len(sets[i][0]) for i in todo])
        elements = np.concatenate([sets[i][0] for i in todo])
        weights = np.concatenate([sets[i][1] for i in todo]).astype(np.float64)
        who, coordinate, rank, dart = throw(elements, weights, owner, bound[todo])
        cell = who * K + coordinate
        earliest = np.full(len(todo) * K, np.inf)
        np.minimum.at(earliest, cell, rank)
        first = rank == earliest[cell]
        rows = np.zeros((len(todo), K), np.uint64)
        rows.flat[cell[first]] = dart[first]
        done = np.isfinite(earliest).reshape(-1, K).all(axis=1)
        out[todo[done]] = rows[done]
        todo = todo[~done]
        bound[todo] *= 2  # an empty coordinate: look at later ranks as well
    return out


def bands(signature: np.ndarray) -> np.ndarray:
    """Bucket numbers: one a band, different for different bands."""
    parts = signature.reshape(len(signature), BANDS, ROWS)
    key = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64) * GOLD, (len(signature), BANDS))
    for i in range(ROWS):
        key = mix(key * GOLD + parts[:, :, i])
    return key.view(np.int64)


def _bands_of(docs: DataFrame) -> DataFrame:
    """(id, keys array<long>) of the documents with words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for part in in_slices(whole, 1):
                for start in range(0, len(part), DOCS_AT_ONCE):
                    batch = part.slice(start, DOCS_AT_ONCE)
                    sets = shingle_sets(batch.column(1).to_pylist())
                    full = [i for i, s in enumerate(sets) if len(s[0])]
                    if full:
                        keys = bands(signatures([sets[i] for i in full]))
                        flat = pa.array(np.ascontiguousarray(keys).reshape(-1))
                        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(full) + 1, dtype=np.int32) * BANDS), flat)
                        yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(full)), lists], names=["id", "keys"])

    return docs.mapInArrow(run, "id long, keys array<long>")


def _shingles_of(docs: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in in_slices(whole, 1):
                sets = shingle_sets(batch.column(1).to_pylist())
                columns = [batch.column(0), pa.array([h.tobytes() for h, _ in sets], pa.binary()), pa.array([c.tobytes() for _, c in sets], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["id", "h", "c"])

    return docs.mapInArrow(run, "id long, h binary, c binary")


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) that are alike."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            alike, last, one = [], None, None
            views = [batch.column(i) for i in range(2, 6)]
            for r, a in enumerate(batch.column(0).to_pylist()):
                ha, ca, hb, cb = (np.frombuffer(v[r].as_buffer(), t) for v, t in zip(views, (np.uint64, np.uint32) * 2))
                alike.append(similarity((ha, ca), (hb, cb)) >= SIMILARITY)
            keep = batch.select([0, 1]).filter(pa.array(alike, pa.bool_()))
            yield pa.RecordBatch.from_arrays(keep.columns, names=["a", "b"])

    second = sets.select(F.col("id").alias("b"), F.col("h").alias("hb"), F.col("c").alias("cb"))
    first = sets.select(F.col("id").alias("a"), F.col("h").alias("ha"), F.col("c").alias("ca"))
    both = pairs.join(second, "b").join(first, "a").select("a", "b", "ha", "ca", "hb", "cb")
    return both.mapInArrow(run, "a long, b long")


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(id, label) of every node of the edges (a, b): the smallest node of its component.

    Large-star and small-star steps in turn, each a join with one row a node, until
    nothing changes; every round is a written table.
    """
    edges = written(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct())
    state = _state(edges)
    while state[0]:
        both = edges.union(edges.select("b", "a")).toDF("u", "v")
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()
        down = written(large.where("a <> b"))
        least = down.groupBy("a").agg(F.min("b").alias("m"))
        small = down.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b")))
        edges = written(small.distinct())
        new = _state(edges)
        if new == state:
            break
        state = new
    return edges.select(F.col("a").alias("id"), F.col("b").alias("label")).union(edges.select(F.col("b").alias("id"), F.col("b").alias("label"))).distinct()


def _merged(labels: DataFrame | None, links: DataFrame) -> DataFrame:
    """Labels after more links."""
    if labels is None:
        return written(components(links))
    a, b = (labels.select(F.col("id").alias(x), F.col("label").alias(f"l{x}")) for x in "ab")
    between = links.join(a, "a", "left").join(b, "b", "left").select(F.coalesce("la", "a").alias("a"), F.coalesce("lb", "b").alias("b"))
    more = components(between.where("a <> b")).toDF("label", "to")
    old = labels.join(more, "label", "left").select("id", F.coalesce("to", "label").alias("label"))
    new = more.select(F.col("label").alias("id"), F.col("to").alias("label")).join(labels.select("id"), "id", "left_anti")
    return written(old.union(new))


def _split(members: DataFrame, labels: DataFrame, number: int) -> tuple[DataFrame, DataFrame]:
    """The members with labels; the buckets that hold several, each with a centre that depends on `number`."""
    labelled = members.select("key", "id").join(labels, "id", "left").select("key", "id", F.coalesce("label", "id").alias("label"))
    centre = F.min(F.struct(F.xxhash64("id", F.lit(number)).alias("o"), "id", "label")).alias("c")
    sums = labelled.groupBy("key").agg(F.min("label").alias("x"), F.max("label").alias("y"), F.count("*").alias("n"), centre)
    return labelled, sums.where("x < y").select("key", "n", "c")


def _ordered(found: DataFrame) -> DataFrame:
    return found.select(F.least("id", "other").alias("a"), F.greatest("id", "other").alias("b")).distinct()


def _flat(rows: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All shingles of the rows, their counts, and where each row begins."""
    h = [np.frombuffer(x, np.uint64) for x in rows["h"]]
    first = np.cumsum([0] + [len(x) for x in h[:-1]])
    return np.concatenate(h), np.concatenate([np.frombuffer(x, np.uint32) for x in rows["c"]]).astype(np.int64), first


def block_links(few: pd.DataFrame, many: pd.DataFrame) -> pd.DataFrame:
    """(a, b) of the pairs that share a bucket, differ in label and are alike."""
    found: list[tuple[int, int]] = []
    if len(few) and len(many):
        h, c, first = _flat(many)
        weight = np.add.reduceat(c, first)
        keys, ids, labels = np.array(many["keys"].tolist()), many["id"].to_numpy(), many["label"].to_numpy()
        order = np.argsort(h, kind="stable")
        ranked = h[order]
        for row in few.itertuples():
            own, own_counts = np.frombuffer(row.h, np.uint64), np.frombuffer(row.c, np.uint32).astype(np.int64)
            left, right = np.searchsorted(ranked, own, "left"), np.searchsorted(ranked, own, "right")
            n = right - left
            at = order[np.repeat(left - (np.cumsum(n) - n), n) + np.arange(n.sum())]
            shared = np.zeros(len(many), np.int64)
            np.add.at(shared, np.searchsorted(first, at, "right") - 1, np.minimum(c[at], np.repeat(own_counts, n)))
            alike = shared >= SIMILARITY * (weight + own_counts.sum() - shared)
            alike &= (labels != row.label) & (keys == np.array(row.keys)).any(axis=1)
            found += [(row.id, int(i)) for i in ids[alike]]
    return pd.DataFrame(found, columns=["a", "b"]).astype("int64")


def _crowd_links(crowded: DataFrame, signed: DataFrame, sets: DataFrame) -> DataFrame:
    """Links (a, b) between labels in buckets with many members.

    Buckets that share members form a family, whose documents are taken once. Those outside
    the family's largest label are compared with all of it, block by block in the tasks;
    only links come out.
    """
    families = components(crowded.join(crowded.groupBy("key").agg(F.min("id").alias("a")), "key").select("a", F.col("id").alias("b")))
    rows = written(families.toDF("id", "family").join(crowded.select("id", "label").distinct(), "id"))
    sizes = rows.groupBy("family", "label").agg(F.count("*").alias("n")).groupBy("family").agg(F.max(F.struct("n", "label")).alias("top"), F.sum("n").alias("all"))
    plan = sizes.select(
        "family",
        F.col("top.label").alias("main"),
        F.ceil((F.col("all") - F.col("top.n")) / FEW).cast("int").alias("few_blocks"),
        F.ceil(F.col("all") / MANY).cast("int").alias("many_blocks"),
    ).where("few_blocks > 0")
    full = rows.join(plan, "family").join(signed.select("id", "keys").dropDuplicates(["id"]), "id").join(sets, "id")

    def side(df: DataFrame, own: str, other: str) -> DataFrame:
        block = F.pmod(F.xxhash64("id"), F.col(f"{own}_blocks")).cast("int")
        blocks = F.explode(F.sequence(F.lit(0), F.col(f"{other}_blocks") - 1))
        kept = [F.col(c).alias(c) for c in ("family", "id", "label", "keys", "h", "c")]  # columns of its own on each side
        return df.select(*kept, block.alias(own), blocks.alias(other))

    few, many = side(full.where("label <> main"), "few", "many"), side(full, "many", "few")
    on = ["family", "few", "many"]
    return few.groupBy(*on).cogroup(many.select(few.columns).groupBy(*on)).applyInPandas(block_links, "a long, b long")


def near_classes(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, class_id) of every row: documents linked by similarity, directly or through others."""
    rows = docs.select(F.col(key).cast("long").alias("id"), whole_text(text).alias("text"))
    base = written(rows.select("id", F.md5(F.col("text").cast("binary")).alias("digest")))
    nodes = base.groupBy("digest").agg(F.min("id").alias("node"))
    kept = nodes.where("node is not null").select(F.col("node").alias("id"))
    signed = written(_bands_of(rows.where("id is not null")).join(kept, "id", "left_semi"))
    inside = signed.select("id", F.explode("keys").alias("key"))
    centres = inside.groupBy("key").agg(F.min("id").alias("centre"), F.max("id").alias("other")).where("centre < other").select("key", "centre")
    members = written(inside.join(centres, "key"))
    sets = written(_shingles_of(rows.join(members.select("id").distinct(), "id", "left_semi").dropDuplicates(["id"])))

    pairs = tested = written(members.where("id <> centre").select(F.col("centre").alias("a"), F.col("id").alias("b")).distinct())
    labels = _merged(None, written(_verified(pairs, sets)))
    for number in range(CENTRE_ROUNDS):
        labelled, split = _split(members, labels, number)
        if split.isEmpty():
            break
        found = labelled.join(split, "key").where("label <> c.label").select("id", F.col("c.id").alias("other"))
        pairs = written(_ordered(found).join(tested, ["a", "b"], "left_anti"))
        labels = _merged(labels, written(_verified(pairs, sets)))
        tested = tested.union(pairs)
    else:
        labelled, split = _split(members, labels, CENTRE_ROUNDS)
        split = written(split)
        rest = labelled.join(split.where(f"n <= {SMALL_BUCKET}").select("key"), "key", "left_semi")
        other = rest.select("key", F.col("id").alias("other"), F.col("label").alias("other_label"))
        pairs = _ordered(rest.join(other, "key").where("label < other_label").select("id", "other"))
        links = written(_verified(written(pairs.join(tested, ["a", "b"], "left_anti")), sets))
        crowded = labelled.join(split.where(f"n > {SMALL_BUCKET}").select("key"), "key", "left_semi")
        labels = _merged(labels, written(links.union(_crowd_links(written(crowded), signed, sets))))

    named = nodes.join(labels.withColumnRenamed("id", "node"), "node", "left").select("digest", F.coalesce("label", "node").alias("class_id"))
    return base.join(named, "digest").select(F.col("id").alias(key), F.when(F.col("id").isNotNull(), F.col("class_id")).alias("class_id"))

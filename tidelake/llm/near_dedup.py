"""Near-duplicate documents: order MinHash for candidates, banded alignment for the decision.

A document is its sequence of shingles of five words (ASCII letters, digits and all beyond ASCII;
A-Z in lower case), each labelled with its occurrence number, so that no two are alike. An order
MinHash sketch keeps the SAMPLE least labelled shingles under one hash and lists them in text
order: two texts share it with a probability that falls with shingles that differ and with moves.
Texts of few shingles, for which sketches are unsafe, use an exact prefix filter instead.
A pair is linked if the shingles that a banded alignment puts in a common order make up 0.8 or
more of all shingles of the two. Classes are the connected components of the links.

Texts with equal words are one class at once and stand in the search as one text. Candidates
within a bucket are compared with its most connected text and with one drawn by a hash first (a
different one in each of the text's buckets); only texts that are then still in different classes
are compared with each other.

Null and empty texts are alone in their class; other texts without a word are linked to equal
texts only; a text of one to four words is one shingle. Rows without doc_id get no class. Each row
gets a row: repeated rows have one class, rows of one doc_id with different texts the class of each
text. Texts are known by 64 bits of the digest of their words (two of a billion texts are taken for
one with a probability of 3 %)."""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .components import components
from .shared import Steps, free_name, slices, table
from .tokens import LETTERS, Words, grams, mix, words

SHINGLE = 5
SIMILAR = 0.8
#: Shingles in a sketch and sketches: a pair at 0.8 shares one of them in all but 1 of 15,000 cases.
SAMPLE, SKETCHES = 6, 32
#: Pairs of texts of at most so many shingles are found by prefixes; of more, by sketches.
FEW = 30
#: Cells of the 4-bit summary that spares far pairs the alignment; a pair at 0.8 falls below
#: 0.8 less SLACK standard deviations in about 1 of 30,000 cases.
CELLS, SLACK = 512, 4.0
#: Tasks that the copies of one text, and the texts of one class, are dealt to.
SALTS = 16

_U = np.uint64
_MULTIPLIERS = np.random.default_rng(7).integers(1, 1 << 62, SKETCHES, dtype=np.int64).astype(_U) * _U(2) + _U(1)
_SALTS = np.random.default_rng(8).integers(1, 1 << 62, SKETCHES, dtype=np.int64).astype(_U)


def labelled(shingles: np.ndarray, text: np.ndarray) -> np.ndarray:
    """Shingle hashes with the number of their occurrence within their text mixed in."""
    if not len(shingles):
        return shingles
    key = mix(shingles ^ (text.astype(_U) * _U(0x9E3779B97F4A7C15)))
    order = np.argsort(key, kind="stable")
    new = np.empty(len(key), bool)
    new[0] = True
    new[1:] = key[order][1:] != key[order][:-1]
    place = np.arange(len(key))
    seen = np.empty(len(key), np.int64)
    seen[order] = place - np.maximum.accumulate(np.where(new, place, 0))
    return mix(shingles + seen.astype(_U) * _U(0xD1B54A32D192ED03))


def shingled(w: Words) -> tuple[np.ndarray, np.ndarray]:
    """Labelled shingles of all texts in text order, and the text of each."""
    hashes, at = grams(w, SHINGLE)
    text = w.text[at]
    short = np.flatnonzero((w.counts > 0) & (w.counts < SHINGLE))
    if len(short):
        whole = np.array([mix(np.bitwise_xor.reduce(mix(w.hash[w.first[i] : w.first[i + 1]] + np.arange(w.counts[i]).astype(_U)), keepdims=True))[0] for i in short], _U)
        text = np.concatenate([text, short])
        order = np.argsort(text, kind="stable")
        hashes, text = np.concatenate([hashes, whole])[order], text[order]
    return labelled(hashes, text), text


def sketches(shingles: np.ndarray, text: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """A row of SKETCHES hashes for each text: the SAMPLE least shingles in text order."""
    out = np.zeros((len(counts), SKETCHES), np.int64)
    share = np.minimum(1.0, 22 / np.maximum(counts, 1))
    for s in range(SKETCHES):
        x = (shingles ^ _SALTS[s]) * _MULTIPLIERS[s]
        x ^= x >> _U(29)
        limit = np.where(share >= 1, np.iinfo(np.uint64).max, (np.minimum(share, 0.99) * 2.0**64).astype(_U))
        while True:
            near = np.flatnonzero(x <= limit[text])
            got = np.bincount(text[near], minlength=len(counts))
            if not len(lacking := np.flatnonzero(got < np.minimum(SAMPLE, counts))):
                break
            limit[lacking] = np.iinfo(np.uint64).max
        order = near[np.lexsort((x[near], text[near]))]
        starts = np.concatenate(([0], np.cumsum(got)[:-1]))
        rank = np.arange(len(order)) - starts[text[order]]
        least = np.sort(order[rank < SAMPLE])  # in text order again
        kept = np.minimum(got, SAMPLE)
        starts = np.concatenate(([0], np.cumsum(kept)[:-1]))
        rank = np.arange(len(least)) - starts[text[least]]
        acc = np.full(len(counts), s + 1, _U)
        for r in range(SAMPLE):
            some = least[rank == r]
            acc[text[some]] = mix(acc[text[some]] * _U(31) + shingles[some])
        out[:, s] = acc.view(np.int64)
    return out


def summary(shingles: np.ndarray, text: np.ndarray, texts: int) -> np.ndarray:
    """For each text CELLS values of 4 bits: of the least shingle in each cell, 1 to 15; 0 where a
    cell is empty. As longs: those with the lowest bits of all cells first, and so on."""
    cell = text * CELLS + (shingles & _U(CELLS - 1)).astype(np.int64)
    order = np.lexsort((shingles, cell))
    first = np.ones(len(order), bool)
    first[1:] = cell[order][1:] != cell[order][:-1]
    values = np.zeros(texts * CELLS, np.uint8)
    chosen = order[first]
    values[cell[chosen]] = (shingles[chosen] >> _U(40)) % _U(15) + _U(1)
    bits = (values.reshape(texts, 1, CELLS) >> np.arange(4, dtype=np.uint8)[:, None]) & np.uint8(1)
    return np.packbits(bits, axis=2).view(np.int64).reshape(texts, CELLS // 16)


_LONGS = pa.list_(pa.int64())


def _lists(rows: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.arange(0, rows.size + 1, rows.shape[1]), pa.int32()), pa.array(rows.ravel()))


def _keys(w: Words, texts: int) -> list[int | None]:
    """What a text is known by: 64 bits of a digest of its words, or of all of it where it has none;
    null for empty texts."""
    out: list[int | None] = []
    for i, (a, b) in enumerate(zip(w.first[:-1].tolist(), w.first[1:].tolist(), strict=True)):
        raw = w.hash[a:b].tobytes() or w.data[w.offsets[i] : w.offsets[i + 1]].tobytes()
        out.append(int.from_bytes(hashlib.blake2b(raw, digest_size=8).digest(), "little", signed=True) if raw else None)
    return out


def _profile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in slices(whole, "text"):
            w = words(batch.column("text"), LETTERS)
            n = batch.num_rows
            shingles, text = shingled(w)
            counts = np.bincount(text, minlength=n)
            keys = _keys(w, n)
            bands = sketches(shingles, text, counts)
            few = [shingles[a:b].view(np.int64).tolist() if 0 < b - a <= FEW / SIMILAR else None for a, b in zip(*(lambda f: (f[:-1].tolist(), f[1:].tolist()))(np.searchsorted(text, np.arange(n + 1))), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(keys, pa.int64()),
                    pa.array(counts, pa.int32()),
                    _lists(bands).filter(pa.array(np.ones(n, bool))),
                    pa.array(few, _LONGS),
                    _lists(summary(shingles, text, n)),
                ],
                names=["doc_id", "key", "n", "bands", "few", "cells"],
            )


def _sequences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in slices(whole, "text"):
            w = words(batch.column("text"), LETTERS)
            hashes = (w.hash & _U(0xFFFFFFFF)).astype(np.uint32)
            rows = [hashes[a:b].tobytes() for a, b in zip(w.first[:-1].tolist(), w.first[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(_keys(w, batch.num_rows), pa.int64()), pa.array(rows, pa.binary())], names=["text_id", "sequence"])


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Shingles that an alignment of the two texts' word hashes puts in a common order, as a share
    of all shingles of the two. Shingles differ within a text, so the alignment is the longest
    increasing run of places; places further apart than the band can't belong to a linked pair."""
    sides = []
    for side in (a, b):
        n = len(side)
        if n < SHINGLE:
            sides.append(labelled(np.array([hash(side.tobytes()) & 0x7FFFFFFFFFFFFFFF], np.int64).astype(_U), np.zeros(1, np.int64)) if n else np.zeros(0, _U))
            continue
        x = side.astype(_U)
        g = np.zeros(n - SHINGLE + 1, _U)
        for i in range(SHINGLE):
            g = g * _U(0x9E3779B97F4A7C15) + x[i : n - SHINGLE + 1 + i]
        sides.append(labelled(mix(g), np.zeros(len(g), np.int64)))
    x, y = sides
    if not len(x) or not len(y):
        return 0.0
    _, i, j = np.intersect1d(x, y, assume_unique=True, return_indices=True)
    band = (1 - SIMILAR) * max(len(x), len(y)) + abs(len(x) - len(y)) + 1
    near = np.abs(i - j) <= band
    i, j = i[near], j[near]
    if len(i) < SIMILAR / (1 + SIMILAR) * (len(x) + len(y)) - 1e-9:
        return 0.0
    run = j[np.argsort(i)]
    if (np.diff(run) > 0).all():
        aligned = len(run)
    else:
        tails: list[int] = []
        for v in run.tolist():
            k = bisect_left(tails, v)
            tails[k : k + 1] = [v]
        aligned = len(tails)
    return aligned / (len(x) + len(y) - aligned)


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sides = [batch.column(c).to_pylist() for c in ("sequence_u", "sequence_v")]
        got = [similarity(np.frombuffer(a, np.uint32), np.frombuffer(b, np.uint32)) for a, b in zip(*sides, strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column("u"), batch.column("v"), pa.array(got, pa.float64())], names=["u", "v", "similarity"])


def _could_link() -> F.Column:
    """What the sizes and the summaries of two texts allow: a condition inside the joins, so that
    far pairs don't become rows."""
    equal = blank = F.lit(0)
    for i in range(CELLS // 64):
        differ = some = F.lit(0).cast("long")
        for at in range(i, CELLS // 16, CELLS // 64):
            a, b = F.col("a.cells")[at], F.col("b.cells")[at]
            differ, some = differ.bitwiseOR(a.bitwiseXOR(b)), some.bitwiseOR(a).bitwiseOR(b)
        if i == 0:  # most far pairs end here, at 64 cells; of pairs at 0.8 less than 1 of a million
            early = F.bit_count(differ) <= (1 - SIMILAR) * 14 / 15 * F.bit_count(some) + (SLACK + 1) * F.sqrt(SIMILAR * (1 - SIMILAR) * F.bit_count(some)) + 1
        equal, blank = equal + 64 - F.bit_count(differ), blank + 64 - F.bit_count(some)
    full = F.lit(CELLS) - blank
    union = (F.col("a.n") + F.col("b.n")) / (1 + SIMILAR)  # of a pair at the limit
    deviation = F.sqrt(SIMILAR * (1 - SIMILAR) * full * F.greatest(F.lit(0.0), 1 - full / union))  # each cell draws one of the union's shingles, without replacement
    return (F.least("a.n", "b.n") >= SIMILAR * F.greatest("a.n", "b.n") - 1e-9) & early & ((equal - blank) >= (SIMILAR + (1 - SIMILAR) / 15) * full - SLACK * deviation - 1)


def _linked(pairs: DataFrame, rows: DataFrame, alike: DataFrame, steps: Steps) -> DataFrame:
    """The pairs (u, v) whose texts align. Only texts of some pair are cut into words again, from the
    rows of their least doc_id."""
    # written first: Spark then knows its size, and broadcasts it only below its own threshold
    wanted = steps.cut(pairs.select(F.col("u").alias("text_id")).unionByName(pairs.select(F.col("v").alias("text_id"))).distinct().join(alike, "text_id").select("text_id", F.col("least").alias("doc_id")), "wanted")
    again = rows.join(wanted.select("doc_id").distinct(), "doc_id", "left_semi").mapInArrow(_sequences, "text_id long, sequence binary")
    texts = steps.cut(again.join(wanted, "text_id", "left_semi").groupBy("text_id").agg(F.first("sequence").alias("sequence")), "sequences")
    side = lambda c: texts.select(F.col("text_id").alias(c), F.col("sequence").alias(f"sequence_{c}"))
    found = pairs.join(side("v"), "v").join(side("u"), "u").select("u", "v", "sequence_u", "sequence_v").mapInArrow(_verify, "u long, v long, similarity double")
    return found.filter(F.col("similarity") >= SIMILAR - 1e-9).select("u", "v").distinct()


def _prefixes(profiles: DataFrame) -> DataFrame:
    """Of the texts with few shingles, the rarest ones that any linked text must share one of."""
    rows = profiles.filter("few is not null").select("doc_id", "n", F.explode("few").alias("shingle"))
    often = rows.groupBy("shingle").agg(F.count(F.lit(1)).alias("often")).filter("often > 1")
    ranked = rows.join(often, "shingle", "left").groupBy("doc_id", "n").agg(F.array_sort(F.collect_list(F.struct(F.coalesce("often", F.lit(1)).alias("often"), "shingle"))).alias("all"))
    length = (F.col("n") - F.ceil(SIMILAR * F.col("n") - 1e-9) + 1).cast("int")
    return ranked.select("doc_id", F.explode(F.slice("all", F.lit(1), length)).alias("x")).filter("x.often > 1").select("doc_id", F.xxhash64(F.lit("few"), "x.shingle").alias("key"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, class_id (the least doc_id of the class) of every row with a doc_id."""
    return _classes(docs, id_col, text_col).select("doc_id", "class_id")


def _classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text_id (null for empty texts) and class_id of every row with a doc_id."""
    steps = Steps(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).filter("doc_id is not null")
    profiles = steps.cut(rows.mapInArrow(_profile, "doc_id long, key long, n int, bands array<long>, few array<long>, cells array<long>"), "profiles")
    of_text = steps.cut(profiles.select("doc_id", F.col("key").alias("text_id")), "copies")
    known = profiles.filter(F.col("key").isNotNull() & (F.col("n") > 0))
    alike = steps.cut(of_text.filter("text_id is not null").groupBy("text_id").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("copies")), "alike")
    # inside the search doc_id is that of a text, and the row with the least doc_id stands for it
    texts = steps.cut(known.groupBy(F.col("key").alias("doc_id")).agg(F.first(F.struct("n", "bands", "few", "cells")).alias("x")).select("doc_id", "x.*"), "texts")
    steps.drop("profiles")
    keys = texts.filter(F.col("n") >= int(SIMILAR * FEW)).select("doc_id", F.explode("bands").alias("key")).unionByName(_prefixes(texts))
    shared = keys.groupBy("key").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    met = steps.cut(keys.join(shared, "key"), "buckets")
    degree = met.groupBy("doc_id").agg(F.sum("size").alias("degree"))
    members = met.select("key", "doc_id")
    best, any_one = F.max(F.struct("degree", (-F.col("doc_id")).alias("minus"))).alias("best"), F.min(F.struct(F.xxhash64("key", "doc_id").alias("place"), "doc_id")).alias("any_one")
    head = members.join(degree, "doc_id").groupBy("key").agg(best, any_one).select("key", F.explode(F.array_distinct(F.array(-F.col("best.minus"), F.col("any_one.doc_id")))).alias("head"))
    brief = texts.select("doc_id", "n", "cells")
    # summaries join the pairs once each, not each of the up to SKETCHES buckets that a pair shares
    near = members.join(head, "key").filter("doc_id <> head").select(F.least("doc_id", "head").alias("u"), F.greatest("doc_id", "head").alias("v")).distinct()
    a, b = brief.alias("a"), brief.alias("b")
    first = steps.cut(near.join(a, F.col("v") == F.col("a.doc_id")).join(b, (F.col("u") == F.col("b.doc_id")) & _could_link()).select("u", "v"), "pairs")
    links = steps.cut(_linked(first, rows, alike, steps), "links")
    steps.drop("sequences", "wanted")
    parts = components(links)
    apart = members.join(parts, members["doc_id"] == parts["node"], "left").select("key", "doc_id", F.coalesce("class", "doc_id").alias("class"))
    mixed = apart.groupBy("key").agg(F.min("class").alias("x"), F.max("class").alias("y")).filter("x <> y").select("key")
    left = steps.cut(apart.join(mixed, "key", "left_semi"), "apart")
    rest = steps.cut(left.join(left.groupBy("doc_id").agg(F.collect_set("key").alias("keys")), "doc_id").join(brief, "doc_id"), "rest")  # 40 keys at most
    steps.drop("buckets", "apart")
    once = F.col("a.key") == F.array_min(F.array_intersect("a.keys", "b.keys"))  # two texts meet in one of their common buckets only
    a, b = rest.alias("a"), rest.alias("b")
    second = a.join(b, (F.col("a.key") == F.col("b.key")) & (F.col("a.doc_id") < F.col("b.doc_id")) & (F.col("a.class") != F.col("b.class")) & _could_link() & once).select(F.col("a.doc_id").alias("u"), F.col("b.doc_id").alias("v"))
    second = steps.cut(second.join(first, ["u", "v"], "left_anti"), "more_pairs")
    steps.drop("rest", "texts")
    # the classes found so far stand for their links
    links = steps.cut(parts.select(F.col("node").alias("u"), F.col("class").alias("v")).filter("u <> v").unionByName(_linked(second, rows, alike, steps)), "links")
    steps.drop("sequences", "wanted", "pairs", "more_pairs")
    parts = components(links)
    classes = _spread(parts.join(alike, parts["node"] == alike["text_id"]).select("text_id", "class", "least"), alike)
    return _with_class(of_text, classes)


def _spread(linked: DataFrame, alike: DataFrame) -> DataFrame:
    """text_id, class_id of the texts that have a link or copies."""
    salt = F.pmod(F.xxhash64("text_id"), F.lit(SALTS)).cast("int").alias("salt")
    least = linked.groupBy("class").agg(F.min("least").alias("class_id")).select("class", "class_id", F.explode(F.array(*[F.lit(i) for i in range(SALTS)])).alias("salt"))
    tied = linked.select("text_id", "class", salt).join(least, ["class", "salt"]).select("text_id", "class_id")
    copies = alike.filter("copies > 1").select("text_id", F.col("least").alias("class_id"))
    return tied.unionByName(copies).groupBy("text_id").agg(F.min("class_id").alias("class_id"))


def _with_class(of_text: DataFrame, classes: DataFrame) -> DataFrame:
    """Each row with its class; copies of a text go to SALTS tasks, rows of texts alone to any."""
    salted = classes.select("text_id", "class_id", F.explode(F.array(*[F.lit(i) for i in range(SALTS)])).alias("salt"))
    rows = of_text.withColumn("salt", F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int"))
    lookup = rows.filter("text_id is not null").join(salted, ["text_id", "salt"], "left")
    out = lookup.select("doc_id", "text_id", F.coalesce("class_id", "doc_id").alias("class_id"))
    return out.unionByName(rows.filter("text_id is null").select("doc_id", "text_id", F.col("doc_id").alias("class_id")))


def keep_one(docs: DataFrame) -> DataFrame:
    """documents without all but the one of each class that has the least doc_id; repeated rows
    are copies as well. Rows without doc_id stay, and so do rows of a doc_id whose texts are of
    different classes, one for each text."""
    digest = free_name(docs.columns, "digest")
    keepers = near_duplicates(docs).filter("doc_id = class_id").select("doc_id").distinct()
    kept = docs.join(keepers, "doc_id", "left_semi").withColumn(digest, F.sha2("text", 256)).dropDuplicates(["doc_id", digest]).drop(digest)
    return kept.unionByName(docs.filter("doc_id is null")).select(*[F.col(f"`{c}`") for c in docs.columns])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate classes of all documents."""
    return near_duplicates(table(spark, sf_dir, "documents"))

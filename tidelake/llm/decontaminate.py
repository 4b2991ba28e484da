"""Benchmark decontamination with a generalised suffix automaton.

The words of the benchmark items become one automaton (several, built and applied in turn, when
the items are too many for one broadcast). Documents stream through it: after each word the
automaton holds the longest run of words up to there that occurs in an item. A run of `window`
words or more, or a whole item that is shorter, marks those words as hit.

Documents: null or empty texts have no words and no hits; repeated rows give repeated results.
Items: null and wordless ones are left out; repeated ones count once for each item_id."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import cut, free_name, slices, table
from .tokens import LETTERS, Words, mix, words

WINDOW = 13
#: Words of benchmark text in one automaton; a state takes about 400 bytes, so 100 MB at most.
AUTOMATON_WORDS = 120_000


class Automaton:
    """Suffix automaton of several word sequences, with the items at its states."""

    def __init__(self, items: list[tuple[str, list[int]]], window: int):
        self.window = window
        self.next: list[dict[int, int]] = [{}]
        self.link, self.len = [-1], [0]
        for _, ids in items:
            last = 0
            for c in ids:
                last = self._extend(last, c)
        self._name(items)

    def _extend(self, last: int, c: int) -> int:
        if (q := self.next[last].get(c)) is not None:
            return q if self.len[q] == self.len[last] + 1 else self._clone(last, c, q)
        new = self._state(self.len[last] + 1, {})
        p = last
        while p >= 0 and c not in self.next[p]:
            self.next[p][c] = new
            p = self.link[p]
        if p < 0:
            self.link[new] = 0
        else:
            q = self.next[p][c]
            self.link[new] = q if self.len[q] == self.len[p] + 1 else self._clone(p, c, q)
        return new

    def _state(self, length: int, edges: dict[int, int]) -> int:
        self.next.append(edges)
        self.link.append(0)
        self.len.append(length)
        return len(self.len) - 1

    def _clone(self, p: int, c: int, q: int) -> int:
        copy = self._state(self.len[p] + 1, dict(self.next[q]))
        self.link[copy] = self.link[q]
        self.link[q] = copy
        while p >= 0 and self.next[p].get(c) == q:
            self.next[p][c] = copy
            p = self.link[p]
        return copy

    def _name(self, items: list[tuple[str, list[int]]]) -> None:
        """items_at: of states that stand for a window, the items it is in; short_at: of states
        that stand for a whole short item, its length and ids; and the nearest of each by links."""
        self.items_at: dict[int, set[str]] = {}
        self.short_at: dict[int, list[tuple[int, str]]] = {}
        n = len(self.len)
        self.of_window = [-1] * n
        order = sorted(range(1, n), key=self.len.__getitem__)
        for v in order:
            up = self.link[v]
            self.of_window[v] = v if self.len[v] >= self.window > self.len[up] else self.of_window[up] if up > 0 else -1
        for name, ids in items:
            v = 0
            for i, c in enumerate(ids):
                v = self.next[v][c]
                if i + 1 >= self.window:
                    self.items_at.setdefault(self.of_window[v], set()).add(name)
            if len(ids) < self.window:
                self.short_at.setdefault(v, []).append((len(ids), name))
        self.nearest_short = [-1] * n
        for v in order:
            self.nearest_short[v] = v if v in self.short_at else self.nearest_short[self.link[v]]

    def scan(self, ids: list[int], hit: np.ndarray, base: int, found: set[str]) -> None:
        """Marks in hit, from base on, what the words match, and adds the items to found."""
        follow, link, length, window = self.next, self.link, self.len, self.window
        v = matched = 0
        for i, c in enumerate(ids):
            while v and c not in follow[v]:
                v = link[v]
                matched = length[v]
            if c in follow[v]:
                v = follow[v][c]
                matched += 1
            if matched >= window:
                hit[base + i - window + 1 : base + i + 1] = True
                found |= self.items_at[self.of_window[v]]
            s = self.nearest_short[v]
            while s >= 0:
                for n, name in self.short_at[s]:
                    if n <= matched:
                        hit[base + i - n + 1 : base + i + 1] = True
                        found.add(name)
                s = self.nearest_short[link[s]] if link[s] > 0 else -1


class Matcher:
    """An automaton over word hashes. Only stretches of a text in which each two neighbours also
    are neighbours in an item can match, so the automaton reads those alone."""

    def __init__(self, names: list[str], texts: list[str], window: int = WINDOW):
        w = words(pa.array(texts, pa.large_string()), LETTERS)
        self.vocabulary = np.unique(w.hash)
        ids = np.searchsorted(self.vocabulary, w.hash)
        pairs = np.flatnonzero(w.text[1:] == w.text[:-1]) if len(w.hash) else np.zeros(0, int)
        self.pairs = np.unique(ids[pairs] * len(self.vocabulary) + ids[pairs + 1])
        items = [(name, ids[a:b].tolist()) for name, a, b in zip(names, w.first[:-1], w.first[1:], strict=True) if b > a]
        self.least = min([window, *(len(x) for _, x in items)])
        self.automaton = Automaton(items, window)

    def match(self, w: Words) -> tuple[np.ndarray, dict[int, set[str]]]:
        """Which words are hit, and by text the items found."""
        hit, found = np.zeros(len(w.hash), bool), {}
        if not len(self.vocabulary) or not len(w.hash):
            return hit, found
        at = np.searchsorted(self.vocabulary, w.hash)
        at[at == len(self.vocabulary)] = 0
        known = self.vocabulary[at] == w.hash
        joined = np.zeros(len(known) + 1, bool)  # word i and the one before it are neighbours in an item
        both = np.flatnonzero(known[1:] & known[:-1] & (w.text[1:] == w.text[:-1]))
        if len(self.pairs):
            pair = at[both] * len(self.vocabulary) + at[both + 1]
            place = np.minimum(np.searchsorted(self.pairs, pair), len(self.pairs) - 1)
            joined[both[self.pairs[place] == pair] + 1] = True
        begins = np.flatnonzero(known & ~joined[:-1])
        ends = np.flatnonzero(known & ~joined[1:]) + 1
        for a, b in zip(begins[ends - begins >= self.least].tolist(), ends[ends - begins >= self.least].tolist(), strict=True):
            names: set[str] = set()
            self.automaton.scan(at[a:b].tolist(), hit, a, names)
            if names:
                found.setdefault(int(w.text[a]), set()).update(names)
        return hit, found


_SPANS = "array<struct<start:int,end:int>>"


def _matched(matcher, id_col: str, text_col: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = matcher.value
        for whole in batches:
            for batch in slices(whole, text_col):
                w = words(batch.column(text_col), LETTERS)
                hit, found = m.match(w)
                hits = np.add.reduceat(np.append(hit, False).astype(np.int64), w.first[:-1]) * (w.counts > 0) if len(w.first) > 1 else []
                spans: list[list[dict]] = [[] for _ in range(batch.num_rows)]
                edges = np.flatnonzero(np.diff(np.concatenate(([False], hit, [False])).astype(np.int8)))
                for a, b in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
                    for row in range(w.text[a], w.text[b - 1] + 1):  # a run may go on in the next text
                        x, y = max(a, w.first[row]), min(b, w.first[row + 1])
                        if x < y:
                            begin = len(w.data[w.offsets[row] : w.start[x]].tobytes().decode("utf-8", "replace"))
                            spans[row].append({"start": begin, "end": begin + len(w.data[w.start[x] : w.end[y - 1]].tobytes().decode("utf-8", "replace"))})
                yield pa.RecordBatch.from_arrays(
                    [
                        *batch.columns,
                        pa.array(w.counts, pa.int64()),
                        pa.array(hits, pa.int64()),
                        pa.array([sorted(found.get(i, ())) for i in range(batch.num_rows)], pa.list_(pa.string())),
                        pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
                    ],
                    names=[*batch.schema.names, "n_words", "n_hit", "items", "spans"],
                )

    return run


def match_benchmark(docs: DataFrame, items: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id_col, text_col, n_words, n_hit, items (ids as strings) and spans (code points, end
    exclusive) of every document. One pass without a shuffle for items of up to AUTOMATON_WORDS
    words; beyond that the items are dealt to as many automata as it takes, one pass each."""
    spark = docs.sparkSession
    items = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"), "text").filter("text is not null")
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    parts = max(1, -(-total // (2 * AUTOMATON_WORDS)))  # a word and the space after it have two characters at least
    out = docs.select(F.col(id_col).alias(id_col), F.col(text_col).alias(text_col))
    kind = T.StructType([*out.schema, *T.StructType.fromDDL(f"n_words long, n_hit long, items array<string>, spans {_SPANS}")])
    results = []
    for part in range(parts):
        rows = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == part).collect()
        matcher = spark.sparkContext.broadcast(Matcher([r[0] for r in rows], [r[1] for r in rows], window))
        results.append(out.mapInArrow(_matched(matcher, id_col, text_col), kind))
    return results[0] if parts == 1 else _merged(out, results, id_col, text_col)


def _merged(docs: DataFrame, results: list[DataFrame], id_col: str, text_col: str) -> DataFrame:
    """Hits of several automata over the same documents, by document and text: the words hit by any."""
    none = F.concat(F.lit("none "), F.monotonically_increasing_id().cast("string"))  # wordless texts don't meet
    key = F.when(F.col("n_words") > 0, F.sha2(F.col(text_col), 256)).otherwise(none)
    found = [r.filter("n_hit > 0").select(key.alias("key"), "items", "spans").dropDuplicates(["key"]) for r in results]
    every = found[0]
    for more in found[1:]:
        every = every.unionByName(more)
    gathered = cut(every.groupBy("key").agg(F.array_distinct(F.flatten(F.collect_list("items"))).alias("more_items"), F.array_distinct(F.flatten(F.collect_list("spans"))).alias("more_spans")), "hits")
    joined = results[0].withColumn("key", key).join(gathered, "key", "left")
    empty = F.array().cast("array<string>")
    return joined.select(id_col, text_col, "n_words", F.array_sort(F.coalesce("more_items", empty)).alias("items"), F.coalesce("more_spans", F.array().cast(_SPANS)).alias("spans")).mapInArrow(_counted(text_col), results[0].schema)


def _counted(text_col: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_pylist()
            for r in rows:
                spans: list[dict] = []
                for s in sorted(r["spans"], key=lambda s: (s["start"], s["end"])):
                    if spans and s["start"] <= spans[-1]["end"]:
                        spans[-1]["end"] = max(spans[-1]["end"], s["end"])
                    else:
                        spans.append(dict(s))
                r["spans"] = spans
                r["n_hit"] = int(sum(words(pa.array([r[text_col][s["start"] : s["end"]] for s in spans]), LETTERS).counts)) if spans else 0
            names = [*batch.schema.names[:3], "n_hit", "items", "spans"]
            kinds = {f.name: f.type for f in batch.schema} | {"n_hit": pa.int64()}
            yield pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], kinds[n]) for n in names], names=names)

    return run


#: A document is contaminated if it has a hit and at least this share of its words is hit.
LIMIT = 20


def is_contaminated() -> F.Column:
    return (F.col("n_hit") > 0) & (LIMIT * F.col("n_hit") >= F.col("n_words"))


def decontaminate(docs: DataFrame, items: DataFrame) -> DataFrame:
    """documents without the contaminated ones; what a benchmark window hits in the others is cut
    out of their texts (n_chars follows). Any further columns stay as they are."""
    names, was_cut = docs.columns, free_name(docs.columns, "was_cut")
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in names if c != "text"]).alias("rest"), "text")
    found = match_benchmark(packed, items, id_col="rest").filter(~is_contaminated())
    cuts = F.reverse(F.array_sort("spans"))
    text = F.when(F.size("spans") == 0, F.col("text")).otherwise(F.aggregate(cuts, F.col("text"), lambda t, s: F.concat(F.substring(t, F.lit(1), s["start"]), F.substring(t, s["end"] + 1, F.length(t)))))
    out = found.select("rest.*", text.alias("text"), (F.size("spans") > 0).alias(was_cut))
    if "n_chars" in names:
        out = out.withColumn("n_chars", F.when(F.col(was_cut), F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return out.select(*[F.col(f"`{c}`") for c in names])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold benchmark passages."""
    found = match_benchmark(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        is_contaminated().alias("contaminated"),
    )

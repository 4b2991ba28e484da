"""Language-model scores from a hashed maximum-entropy model with a class-factored softmax.

Classes of tokens form a tree of three levels of 16 branches. Its 4096 leaves are the end of a text,
the TOP most frequent training words one by one, and REST classes of all other words, all in order of
the words' last two bytes. log P(token | context) is the sum of the three branches' log
probabilities, each from a softmax over hashed features of the context, and, within a REST class, of
the word's smoothed share of the class's training tokens. Features: the word before, the groups (of
16 leaves) of the two words before, and of the two words that a skip of one reaches, each alone at
the first branch; the word before and its group with the branch taken at the second; the word before
with both branches at the third. The number of hashed rows follows the number of training words up to 2**20.

Training: each task moves its own copy of the weights by minibatch gradients over all its training
documents; the copies are then averaged, row by row, by how often each task used the row. ROUNDS of
this make the model. It is scored in sparse numpy batches.

Counts of all distinct words stay distributed: documents are written once in files of bounded size;
each file asks for the counts of its own distinct words by a join and is read and scored by the task
that has its answers. Words are known by 64-bit hashes (two of a billion words collide with a
probability of 3 %).

Null and empty texts have the end token alone; rows without doc_id count as doc_id 0 for the split;
repeated rows are scored, and counted, for each row. Without training documents every score is the
uniform one over the branches and one unknown token."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import cut, new_path, slices, table
from .tokens import SPACED, words

BRANCHES = 16
LEAVES = BRANCHES**3
REST = 1024
TOP = LEAVES - 1 - REST
#: Bits of the number of rows of weights: at least, and at most.
BITS = (14, 20)
ROUNDS = 1
#: Of each gradient step; added to counts.
STEP, SMOOTH = 0.25, 0.5
#: Weights are at most so far from 0.
MOST = 20.0
#: Documents of one file, which one task scores.
FILE_ROWS = 1 << 17
#: The end of a text, among word hashes.
END = np.uint64(0)
_BATCH = 1 << 13
_BLOCK = 256
_U = np.uint64


def held_out(doc_id: str = "doc_id") -> F.Column:
    return F.pmod(F.crc32(F.coalesce(F.col(doc_id), F.lit(0)).cast("string").cast("binary")), F.lit(5)) == 1


class Tokens:
    """All tokens of some texts, an end after the words of each: hashes, text numbers, and the
    ending of each word (its last two bytes)."""

    def __init__(self, column: pa.Array):
        w = words(column, SPACED)
        n = len(w.counts)
        place = np.arange(len(w.hash)) + w.text
        ends = w.first[1:] + np.arange(n)
        total = len(w.hash) + n
        self.hash, self.text, self.ending = np.empty(total, _U), np.empty(total, np.int64), np.zeros(total, np.int64)
        self.hash[place], self.hash[ends] = np.maximum(w.hash, _U(1)), END
        self.text[place], self.text[ends] = w.text, np.arange(n)
        last = w.data[w.end - 1].astype(np.int64)
        other = np.where(w.end - w.start > 1, w.data[np.maximum(w.end - 2, 0)], 0).astype(np.int64)
        self.ending[place] = last * 256 + other
        self.first = ends + 1 - (w.counts + 1)
        self.ends = ends

    def rows(self, leaf: np.ndarray, bits: int) -> np.ndarray:
        """The rows of weights of each token: three for the first branch, two for the second, one
        for the third. Before a text's first word stand ends."""
        n = len(leaf)
        since = np.arange(n) - self.first[self.text]
        back = lambda values, k: np.where(since >= k, np.concatenate([np.zeros(k, values.dtype), values[: n - k]])[:n], 0).astype(_U)
        group = leaf // BRANCHES
        one, near, skip = back(self.hash, 1), back(group, 1), back(group, 2)
        pair, skips = near * _U(4099) + skip, skip * _U(4099) + back(group, 3)
        first, second = (leaf // BRANCHES**2).astype(_U) + _U(1), group.astype(_U) + _U(1 + BRANCHES)
        out = np.empty((6, n), np.int32)
        for k, (context, at) in enumerate(((one, 0), (pair, 0), (skips, 0), (one, first), (near, first), (one, second))):
            x = (context + _U((k + 1) << 40)) * _U(0x9E3779B97F4A7C15)
            if k > 2:
                x += at * _U(0xC2B2AE3D27D4EB4F)
            x = (x ^ (x >> _U(31))) * _U(0xD6E8FEB86659FD93)
            out[k] = (x >> _U(64 - bits)).astype(np.int32)
        return out


@dataclass
class Classes:
    """Leaves of the tree, in order of word endings: top words (hashes in ascending order) and their
    leaves; of each ending its rest class; of each rest class its leaf."""

    top: np.ndarray
    top_leaf: np.ndarray
    rest: np.ndarray
    rest_leaf: np.ndarray

    def leaves(self, t: Tokens) -> np.ndarray:
        out = self.rest_leaf[self.rest[t.ending]]
        if len(self.top):
            at = np.minimum(np.searchsorted(self.top, t.hash), len(self.top) - 1)
            out = np.where(self.top[at] == t.hash, self.top_leaf[at], out)
        out[t.ends] = 0
        return out


def classes(hashes: np.ndarray, endings: np.ndarray, tokens: np.ndarray) -> Classes:
    """hashes, endings: of the top words. tokens: of each ending, the tokens of its other words;
    endings in a row that have about the same number of tokens together are a rest class."""
    mass = np.cumsum(tokens + 1e-6)
    rest = np.minimum((mass - tokens / 2) / mass[-1] * REST, REST - 1).astype(np.int64)
    begins = np.searchsorted(rest, np.arange(REST))
    place = np.lexsort((np.arange(REST + len(hashes)), np.concatenate([begins, endings])))
    leaf = np.empty(len(place), np.int64)
    leaf[place] = 1 + np.arange(len(place))
    order = np.argsort(hashes)
    return Classes(hashes[order], leaf[REST:][order], rest, leaf[:REST])


class Tree:
    """The softmax of the three branches. bias: logarithms of the branches' shares of all tokens."""

    def __init__(self, leaf_tokens: np.ndarray):
        n = leaf_tokens.reshape(BRANCHES, BRANCHES, BRANCHES) + 1e-3
        share = lambda x: np.log(x / x.sum(-1, keepdims=True)).astype(np.float32)
        self.bias = (share(n.sum((1, 2)).reshape(1, -1)), share(n.sum(2)), share(n.reshape(-1, BRANCHES)))

    def softmax(self, weights: np.ndarray, rows: np.ndarray, leaf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Unscaled probabilities of all 16 branches, of all tokens at the first level, then at the
        second, then at the third; and their sums."""
        n = len(leaf)
        z = np.empty((3 * n, BRANCHES), np.float32)
        for level, own in enumerate(((0, 1, 2), (3, 4), (5,))):
            part = z[level * n : (level + 1) * n]
            np.take(weights, rows[own[0]], 0, out=part)
            for k in own[1:]:
                part += weights[rows[k]]
            part += self.bias[level][leaf // BRANCHES ** (3 - level)]
        np.exp(z, out=z)
        return z, z @ np.ones(BRANCHES, np.float32)

    def log_probability(self, weights: np.ndarray, rows: np.ndarray, leaf: np.ndarray) -> np.ndarray:
        """Of each token's leaf."""
        z, total = self.softmax(weights, rows, leaf)
        chosen = z[np.arange(len(z)), np.concatenate(branches(leaf))]
        return np.log(chosen / total).reshape(3, -1).sum(0)


def branches(leaf: np.ndarray) -> tuple[np.ndarray, ...]:
    return leaf // BRANCHES**2, leaf // BRANCHES % BRANCHES, leaf % BRANCHES


def learn(tree: Tree, weights: np.ndarray, squares: np.ndarray, used: np.ndarray, rows: np.ndarray, leaf: np.ndarray) -> None:
    """One minibatch: moves the weights of the rows in use against the gradient, each by its own
    step, which shrinks with the squares of the gradients that it has seen."""
    n = len(leaf)
    gradient, total = tree.softmax(weights, rows, leaf)
    gradient /= total[:, None]
    gradient[np.arange(3 * n), np.concatenate(branches(leaf))] -= 1
    keys = rows.ravel()
    source = np.concatenate([np.arange(n)] * 3 + [np.arange(n, 2 * n)] * 2 + [np.arange(2 * n, 3 * n)])
    order = np.argsort(keys)
    ranked = keys[order]
    starts = np.flatnonzero(np.concatenate(([True], ranked[1:] != ranked[:-1])))
    times = np.diff(np.append(starts, len(keys)))
    at, source = ranked[starts], source[order]
    total = gradient[source[starts]]
    twice, often = np.flatnonzero(times == 2), np.flatnonzero(times > 2)
    total[twice] += gradient[source[starts[twice] + 1]]
    if len(often):
        begins = np.cumsum(times[often]) - times[often]
        total[often] = np.add.reduceat(gradient[source[np.repeat(times > 2, times)]], begins, axis=0)
    seen = squares[at]
    seen += total * total
    squares[at] = seen
    seen += 1
    total /= np.sqrt(seen, out=seen)
    total *= STEP
    weights[at] -= total
    used[at] += times


def _vocabulary(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each file its distinct words with their number among training tokens; the end of texts,
    which every file has, carries the file's path."""
    held: list[tuple[np.ndarray, ...]] = []
    now: tuple | None = None

    def merged() -> tuple[np.ndarray, ...]:
        h, ending, n = (np.concatenate(x) for x in zip(*held, strict=True))
        h, at, back = np.unique(h, return_index=True, return_inverse=True)
        return h, ending[at], np.bincount(back, n, len(h)).astype(np.int64)

    def rows() -> Iterator[pa.RecordBatch]:
        h, ending, n = merged()
        for a in range(0, len(h), 1 << 16):
            b = min(a + (1 << 16), len(h))
            path = pa.array([now[1] if x else None for x in (h[a:b] == END).tolist()], pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(np.full(b - a, now[0])), pa.array(h[a:b].view(np.int64)), pa.array(ending[a:b], pa.int32()), pa.array(n[a:b]), path], names=["file", "hash", "ending", "n", "path"])
        held.clear()

    for whole in batches:
        for batch in slices(whole, "text"):
            files = batch.column("file").to_numpy()
            for a, b in zip(*_stretches(files), strict=True):
                if held and now[0] != files[a]:
                    yield from rows()
                now = (int(files[a]), batch.column("path")[int(a)].as_py())
                part = batch.slice(a, b - a)
                t = Tokens(part.column("text"))
                coded = pa.array(t.hash).dictionary_encode()
                which, h = coded.indices.to_numpy(), coded.dictionary.to_numpy()
                ending = np.zeros(len(h), np.int64)
                ending[which] = t.ending
                learns = ~part.column("held_out").to_numpy(zero_copy_only=False)[t.text]
                held.append((h, ending, np.bincount(which, learns, len(h)).astype(np.int64)))
                if len(held) > 8 and sum(len(x[0]) for x in held) > 1_000_000 + 2 * len(held[0][0]):
                    held[:] = [merged()]
    if held:
        yield from rows()


def _stretches(values: np.ndarray) -> tuple[list[int], list[int]]:
    """First and last (exclusive) places of equal neighbours."""
    edges = np.flatnonzero(values[1:] != values[:-1]) + 1
    return [0, *edges.tolist()], [*edges.tolist(), len(values)]


def _trained(model):
    """A task's weights after all its documents, in blocks of rows, and how often it used each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, tree, bits, start = model.value
        weights = np.zeros((1 << bits, BRANCHES), np.float32) if start is None else start.copy()
        squares, used = np.zeros((1 << bits, BRANCHES), np.float32), np.zeros(1 << bits, np.float32)
        for whole in batches:
            for batch in slices(whole, "text"):
                t = Tokens(batch.column("text"))
                leaf = own.leaves(t)
                rows = t.rows(leaf, bits)
                for a in range(0, len(leaf), _BATCH):
                    learn(tree, weights, squares, used, rows[:, a : a + _BATCH], leaf[a : a + _BATCH])
        kept = [i for i in range(0, 1 << bits, _BLOCK) if used[i : i + _BLOCK].any()]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([i // _BLOCK for i in kept], pa.int32()),
                pa.array([weights[i : i + _BLOCK].astype(np.float16).tobytes() for i in kept], pa.binary()),
                pa.array([used[i : i + _BLOCK].tobytes() for i in kept], pa.binary()),
            ],
            names=["at", "weights", "used"],
        )

    return run


_MEANS = "at int, weights binary, used binary"


def _mean(key: tuple, rows: pa.Table) -> pa.Table:
    """The mean of some copies of a block, by the use of each row."""
    total, used = np.zeros((_BLOCK, BRANCHES)), np.zeros(_BLOCK)
    for w, u in zip(rows.column("weights"), rows.column("used"), strict=True):
        n = np.frombuffer(u.as_buffer(), np.float32)
        total += np.frombuffer(w.as_buffer(), np.float16).reshape(_BLOCK, BRANCHES) * n[:, None]
        used += n
    mean = total / np.maximum(used, 1)[:, None]
    return pa.table({"at": pa.array([key[0].as_py()], pa.int32()), "weights": pa.array([mean.astype(np.float16).tobytes()], pa.binary()), "used": pa.array([used.astype(np.float32).tobytes()], pa.binary())})


def train(docs: DataFrame, own: Classes, tree: Tree, bits: int, tasks: int) -> np.ndarray:
    """Weights from all rows of docs, which so many tasks or so read."""
    spark = docs.sparkSession
    weights = None
    for _ in range(ROUNDS):
        model = spark.sparkContext.broadcast((own, tree, bits, weights))
        copies = docs.select("text").mapInArrow(_trained(model), _MEANS)
        if tasks > 512:  # means of means, so that no group grows with the number of tasks
            copies = copies.withColumn("part", F.pmod(F.spark_partition_id(), F.lit(tasks // 512 + 1))).groupBy("at", "part").applyInArrow(_mean, _MEANS)
        weights = np.zeros((1 << bits, BRANCHES), np.float32) if weights is None else weights
        for r in copies.groupBy("at").applyInArrow(_mean, _MEANS).select("at", "weights").toLocalIterator():  # 32 MB at most
            weights[r["at"] * _BLOCK : (r["at"] + 1) * _BLOCK] = np.frombuffer(r["weights"], np.float16).reshape(_BLOCK, BRANCHES)
        np.clip(weights, -MOST, MOST, out=weights)  # of sums of three the exponentials stay finite
        model.unpersist()
    return weights


def _score(model):
    def run(key: tuple, answers: pa.Table) -> pa.Table:
        own, tree, bits, weights, shares, all_tokens, all_words = model.value
        hashes, path = answers.column("hash").to_numpy().view(_U), next(p.as_py() for p in answers.column("path") if p.is_valid)
        order = np.argsort(hashes)
        hashes, counts = hashes[order], answers.column("n").to_numpy()[order]
        out: list[list[np.ndarray]] = []
        fs, place = pafs.FileSystem.from_uri(path)
        with fs.open_input_file(place) as source:
            for whole in pq.ParquetFile(source).iter_batches(batch_size=4096, columns=["doc_id", "held_out", "text"], use_threads=False):
                for batch in slices(whole, "text"):
                    t = Tokens(batch.column("text"))
                    n = batch.num_rows
                    c = counts[np.searchsorted(hashes, t.hash)]
                    leaf = own.leaves(t)
                    rows = t.rows(leaf, bits)
                    logp = np.where(np.isnan(shares[leaf]), 0.0, np.log(c + SMOOTH) - shares[leaf])
                    for a in range(0, len(leaf), _BATCH):
                        logp[a : a + _BATCH] += tree.log_probability(weights, rows[:, a : a + _BATCH], leaf[a : a + _BATCH])
                    base = np.bincount(t.text, np.log10((c + SMOOTH) / (all_tokens + SMOOTH * (all_words + 1))), n)
                    out.append([batch.column("doc_id"), batch.column("held_out"), pa.array(t.ends - t.first + 1), pa.array(np.bincount(t.text, c > 0, n).astype(np.int64)), pa.array(base), pa.array(np.bincount(t.text, logp, n) / np.log(10))])
        return pa.table([pa.chunked_array(x) for x in zip(*out, strict=True)], names=["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score"])

    return run


def score(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row."""
    spark = docs.sparkSession
    folder = new_path(spark, "texts")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"), held_out().alias("held_out"))
    rows.write.option("maxRecordsPerFile", FILE_ROWS).parquet(folder)
    rows = spark.read.schema(rows.schema).parquet(folder)
    path = F.col("_metadata.file_path")
    vocabulary = cut(rows.select("text", "held_out", F.xxhash64(path).alias("file"), path.alias("path")).mapInArrow(_vocabulary, "file long, hash long, ending int, n long, path string"), "vocabulary")
    counts = cut(vocabulary.groupBy("hash").agg(F.min("ending").alias("ending"), F.sum("n").alias("n")), "counts")
    known = counts.filter("n > 0")
    n_tokens, n_words = known.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    best = known.filter("hash <> 0").orderBy(F.desc("n"), "hash").limit(TOP).collect()
    hashes, endings, times = (np.array([r[c] for r in best], np.int64) for c in ("hash", "ending", "n"))
    other, distinct = np.zeros(1 << 16), np.zeros(1 << 16)
    for r in known.filter("hash <> 0").groupBy("ending").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("words")).collect():  # 65,536 rows at most
        other[r["ending"]], distinct[r["ending"]] = r["n"], r["words"]
    np.subtract.at(other, endings, times)
    np.subtract.at(distinct, endings, 1)
    own = classes(hashes.view(_U), endings, other)
    leaf_tokens = np.zeros(LEAVES)
    leaf_tokens[0] = n_tokens - times.sum() - other.sum()
    leaf_tokens[own.top_leaf] = times[np.argsort(hashes.view(_U))]
    leaf_tokens[own.rest_leaf] = np.bincount(own.rest, other, REST)
    shares = np.full(LEAVES, np.nan)
    shares[own.rest_leaf] = np.log(leaf_tokens[own.rest_leaf] + SMOOTH * (np.bincount(own.rest, distinct, REST) + 1))
    tree, bits = Tree(leaf_tokens), int(np.clip(n_words.bit_length() - 4, *BITS))
    weights = train(rows.filter("not held_out"), own, tree, bits, vocabulary.filter("path is not null").count())
    answers = vocabulary.select("file", "hash", "path").join(counts.select("hash", "n"), "hash").select("file", "hash", "n", "path")
    model = spark.sparkContext.broadcast((own, tree, bits, weights, shares, n_tokens, n_words))
    scored = answers.groupBy("file").applyInArrow(_score(model), "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double")
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(int(n_tokens)).cast("long").alias("train_tokens"), "base_score", "score")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents."""
    return score(table(spark, sf_dir, "documents"))

"""Best-fit packing of token sequences by patterns.

Documents become token ids (a public byte-level BPE, end token added); texts of more than LENGTH
tokens are cut into pieces, the first of which takes the remainder. The histogram of piece lengths,
of LENGTH numbers whatever the input, goes to the driver: patterns of at most three lengths that
fill a sequence exactly are fitted to it by non-negative least squares, repeat counts rounded down,
and what is left over packed best-fit, longest first, in bulk. The plan is a list of ranks by
length; each piece finds its place by its own rank among the pieces of its length, counted in
salted buckets, so no length meets in one task.

Null texts count as empty: one piece of one token. Repeated rows are packed once for each row,
under the same doc_id."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .shared import cut, slices, table
from .tokens import run_hashes, text_bytes

LENGTH = 1024
END = 2
VOCABULARY = "byte_bpe_50k.json"
#: What a worker keeps of stretches that it has met: so many stretches and ids, about 40 MB.
STRETCHES, IDS = 600_000, 4_000_000
#: White space beyond ASCII in UTF-8 by its first bytes; more is listed than is white space.
_WIDE = {0xC2: ((0x85,), (0xA0,)), 0xE1: ((0x9A,),), 0xE2: (*((0x80, x) for x in (*range(0x80, 0x8B), 0xA8, 0xA9, 0xAF)), (0x81, 0x9F)), 0xE3: ((0x80, 0x80),)}
# kinds of bytes: of unknown use, letters, digits, apostrophes, other signs, line ends, spaces
_OTHER, _LETTER, _DIGIT, _QUOTE, _SIGN, _LINE, _SPACE = range(7)
_KIND = np.zeros(256, np.uint8)
_KIND[0x21:0x7F] = _SIGN
_KIND[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = _LETTER
_KIND[0x30:0x3A] = _DIGIT
_KIND[[0x27, 0x0A, 0x20]] = _QUOTE, _LINE, _SPACE
#: Where a token ends for sure between two bytes of these kinds.
_ENDS = np.zeros((7, 7), bool)
for _a, _bs in {_LETTER: (_DIGIT, _QUOTE, _SIGN, _LINE), _DIGIT: (_LETTER, _QUOTE, _SIGN, _LINE), _SIGN: (_LETTER, _DIGIT, _LINE), _QUOTE: (_LINE,)}.items():
    _ENDS[_a, list(_bs)] = True


class Encoder:
    """Ids of whole texts. GPT-2's split rule begins a token before every space that something other
    than white space follows, whatever stands before it, and between letters, digits, signs and line
    ends; there each text falls apart into stretches (see stretches). They repeat: their ids are
    kept by hash, and only new ones are encoded, those of Latin letters with the tokenizer's own
    model, which spares its bookkeeping of offsets."""

    def __init__(self, vocabulary: str):
        import public_tokenizers
        import regex
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(public_tokenizers.path(vocabulary))
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.marks = [s.encode() for s in self.special]
        self.split = regex.compile(public_tokenizers.PATTERN).findall
        # bytes as the byte-level vocabulary writes them: printable ones as themselves, the others from 256 on
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        self.letters = {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in plain)}
        self._forget()

    def _forget(self) -> None:
        self.known = np.zeros(0, np.uint64)  # hashes in order, and where the ids of each are
        self.begin = self.size = np.zeros(0, np.int64)
        self.ids, self.used = np.zeros(1 << 16, "<u4"), 0

    def _encode(self, stretches: list[str]) -> list[list[int]]:
        out: list[list[int]] = []
        rest: list[int] = []
        split, tokenize, letters = self.split, self.tokenizer.model.tokenize, self.letters
        for x in stretches:
            if (x.isascii() or max(x) <= "\u024f") and not any(s in x for s in self.special):
                out.append([t.id for word in split(x) for t in tokenize(word.encode().decode("latin-1").translate(letters))])
            else:
                rest.append(len(out))
                out.append([])
        if rest:
            for i, e in zip(rest, self.tokenizer.encode_batch_fast([stretches[i] for i in rest], add_special_tokens=False), strict=True):
                out[i] = e.ids
        return out

    def _learn(self, hashes: np.ndarray, stretches: list[str]) -> None:
        found = self._encode(stretches)
        size = np.array([len(x) for x in found], np.int64)
        total = int(size.sum())
        if self.used + total > len(self.ids):
            self.ids = np.concatenate([self.ids[: self.used], np.zeros(total + self.used, "<u4")])
        self.ids[self.used : self.used + total] = np.fromiter(chain.from_iterable(found), np.uint32, total)
        begin = self.used + np.cumsum(size) - size
        self.used += total
        order = np.argsort(hashes)
        at = np.searchsorted(self.known, hashes[order])
        self.known, self.begin, self.size = (np.insert(x, at, y[order]) for x, y in ((self.known, hashes), (self.begin, begin), (self.size, size)))

    def __call__(self, column: pa.Array, end: int = END) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, `end` after each, and where each text's begin; null counts as empty."""
        if len(self.known) > STRETCHES or self.used > IDS:
            self._forget()
        data, offsets = text_bytes(column)
        start, stop = stretches(data, offsets, self.marks)
        text = np.searchsorted(offsets, start, "right") - 1
        coded = pa.array(run_hashes(data, start, stop)).dictionary_encode()
        which, hashes = coded.indices.to_numpy(), coded.dictionary.to_numpy()
        at = np.searchsorted(self.known, hashes)
        new = np.flatnonzero(self.known[np.minimum(at, len(self.known) - 1)] != hashes) if len(self.known) else np.arange(len(hashes))
        if len(new):
            first = np.empty(len(hashes), np.int64)
            first[which[::-1]] = np.arange(len(which) - 1, -1, -1)
            raw = data.tobytes()
            self._learn(hashes[new], [raw[a:b].decode() for a, b in zip(start[first[new]].tolist(), stop[first[new]].tolist(), strict=True)])
            at = np.searchsorted(self.known, hashes)
        size, begin = self.size[at][which], self.begin[at][which]
        total = int(size.sum())
        before = np.cumsum(size) - size
        out = np.full(total + len(offsets) - 1, end, "<u4")
        places = np.arange(total)
        out[places + np.repeat(text, size)] = self.ids[places + np.repeat(begin - before, size)]
        per_text = np.bincount(text, size, len(offsets) - 1).astype(np.int64) + 1
        return out, np.concatenate(([0], np.cumsum(per_text)))


def stretches(data: np.ndarray, offsets: np.ndarray, special: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of each stretch, in bytes. No token of the split rule reaches over a begin, and
    a stretch alone is split like it is in its text."""
    n = len(data)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    kind = _KIND[data]
    latin = np.flatnonzero(data == 0xC3)  # first bytes of the letters from U+00C0 on, and of two signs
    latin = latin[(data[latin + 1] != 0x97) & (data[latin + 1] != 0xB7)]
    kind[latin] = kind[latin + 1] = _LETTER
    begins = np.zeros(n + 1, bool)
    space = np.flatnonzero((kind[:-1] == _SPACE) & (data[1:] > 0x20))
    wide = np.flatnonzero((data[space + 1] >= 0xC2) & (data[space + 1] <= 0xE3) & (data[space + 1] != 0xC3))
    begins[space] = True
    if len(wide):
        lead, second, third = (data[np.minimum(space[wide] + k, n - 1)] for k in (1, 2, 3))
        for byte, rests in _WIDE.items():
            for rest in rests:
                begins[space[wide[(lead == byte) & (second == rest[0]) & (third == rest[1] if len(rest) > 1 else True)]]] = False
    begins[np.maximum(offsets[1:], 1) - 1] = False  # a text's last space
    begins[1:n] |= _ENDS[kind[:-1], kind[1:]]
    line = np.flatnonzero(kind[1:-1] == _LINE) + 1  # a line end alone between others
    begins[line[_ENDS[kind[line - 1], _LINE] & (kind[line + 1] >= _LETTER) & (kind[line + 1] <= _SIGN)] + 1] = True
    for mark in special:  # stay whole
        for i in np.flatnonzero((data[:-1] == mark[0]) & (data[1:] == mark[1])).tolist():
            begins[i + 1 : i + len(mark)] = False
    begins[n] = False
    begins[offsets[:-1][np.diff(offsets) > 0]] = True
    start = np.flatnonzero(begins)
    return start, np.append(start[1:], n)


_encoders: dict[str, Encoder] = {}


def encoder(vocabulary: str) -> Encoder:
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has a task on each core already
    if vocabulary not in _encoders:
        _encoders[vocabulary] = Encoder(vocabulary)
    return _encoders[vocabulary]


_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def _cut_up(vocabulary: str, length: int, end: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary)
        for whole in batches:
            for batch in slices(whole, "text"):
                ids, first = encode(batch.column("text"), end)
                tokens = np.diff(first)
                count = -(-tokens // length)
                row = np.repeat(np.arange(len(tokens)), count)
                piece = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
                remainder = tokens - (count - 1) * length  # of the first piece
                start = np.where(piece == 0, 0, remainder[row] + (piece - 1) * length)
                size = np.where(piece == 0, remainder[row], length)
                raw = memoryview(ids.view(np.uint8))
                checks = [crc32(raw[a:b]) for a, b in zip((4 * (first[row] + start)).tolist(), (4 * (first[row] + start + size)).tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(pa.array(row)), pa.array(piece, pa.int32()), pa.array(start), pa.array(size), pa.array(checks, pa.int64())], names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return run


def pieces(docs: DataFrame, vocabulary: str = VOCABULARY, length: int = LENGTH, end: int = END) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every piece; no shuffle."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text")).mapInArrow(_cut_up(vocabulary, length, end), _PIECES)


def patterns(length: int, present: np.ndarray) -> np.ndarray:
    """Rows of three lengths, descending, 0 for none, that add up to the sequence length."""
    first, second = np.meshgrid(np.arange(length + 1), np.arange(length + 1), indexing="ij")
    third = length - first - second
    rows = np.stack([first, second, third], 2)[(first >= second) & (second >= third) & (third >= 0)]
    return rows[present[rows].all(1)]


def fit(histogram: np.ndarray, rows: np.ndarray, rounds: int = 400) -> np.ndarray:
    """Repeat counts of the patterns, at least 0, that come nearest to the histogram in least
    squares: accelerated projected gradient; a pattern's column holds its three lengths."""
    size = len(histogram)
    apply = lambda x: sum(np.bincount(rows[:, k], x, size) for k in range(3)) * real
    real = np.ones(size)
    real[0] = 0
    back = lambda r: (r * real)[rows].sum(1)
    v = np.ones(len(rows))
    for _ in range(12):  # the largest eigenvalue, for the step
        v = back(apply(v))
        norm = np.linalg.norm(v)
        v /= norm
    step = 0.95 / norm
    x = y = np.zeros(len(rows))
    t = 1.0
    for _ in range(rounds):
        new = np.maximum(0, y - step * back(apply(y) - histogram))
        t_new = (1 + (1 + 4 * t * t) ** 0.5) / 2
        y = new + (t - 1) / t_new * (new - x)
        x, t = new, t_new
    return x


def plan(histogram: np.ndarray, length: int = LENGTH) -> list[tuple[tuple[int, ...], int]]:
    """(lengths in a sequence, number of such sequences), using every piece of the histogram."""
    left = histogram.astype(np.int64).copy()
    out: list[tuple[tuple[int, ...], int]] = []
    if left[length]:
        out.append(((length,), int(left[length])))
        left[length] = 0
    present = left > 0
    present[0] = True
    rows = patterns(length, present)
    if len(rows) and left.any():
        times = np.floor(fit(left.astype(float), rows) + 1e-6).astype(np.int64)
        for k in np.argsort(-times):
            if not times[k]:
                break
            lengths = [int(x) for x in rows[k] if x]
            need = np.bincount(lengths, minlength=length + 1)
            n = min(int(times[k]), *(int(left[x] // need[x]) for x in lengths))
            if n > 0:
                out.append((tuple(lengths), n))
                left -= n * need
    while left.any():  # the longest left, then again and again the longest that still fits
        room, lengths, used = length, [], np.zeros(length + 1, np.int64)
        while (fits := np.flatnonzero((left - used)[1 : room + 1] > 0)).size:
            x = int(fits[-1]) + 1
            lengths.append(x)
            used[x] += 1
            room -= x
        n = min(int(left[x] // used[x]) for x in set(lengths))
        out.append((tuple(lengths), n))
        left -= n * used
    return out


def places(steps: list[tuple[tuple[int, ...], int]]) -> list[tuple[int, int, int, int]]:
    """(length, first rank, first sequence, offset): pieces of a length from that rank on stand in
    the sequences from that one on, at that offset."""
    rank: dict[int, int] = {}
    out, sequence = [], 0
    for lengths, n in steps:
        offset = 0
        for x in lengths:
            out.append((x, rank.get(x, 0), sequence, offset))
            rank[x] = rank.get(x, 0) + n
            offset += x
        sequence += n
    return sorted(out)


def _placed(plan_of):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, sequence, offset, first, most = plan_of.value
        for batch in batches:
            length, rank = (batch.column(c).to_numpy() for c in ("length", "rank"))
            at = np.searchsorted(keys, length * most + rank, "right") - 1
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")), pa.array(sequence[at] + rank - first[at], pa.int64()), pa.array(offset[at], pa.int64())],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
            )

    return run


def pack(docs: DataFrame, vocabulary: str = VOCABULARY, length: int = LENGTH, end: int = END) -> DataFrame:
    """Every piece with its sequence_id and its offset there. The plan that is broadcast has at most
    some lines for each pattern in use, a number bounded by the sequence length alone."""
    spark = docs.sparkSession
    cut_up = cut(pieces(docs, vocabulary, length, end), "pieces")
    counts = cut_up.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()  # at most `length` rows
    histogram = np.zeros(length + 1, np.int64)
    for r in counts:
        histogram[r["length"]] = r["n"]
    buckets = max(8, int(histogram.sum() // 200_000))
    salt = F.pmod(F.xxhash64("doc_id", "piece"), F.lit(buckets)).alias("bucket")
    salted = cut_up.select("*", salt)
    before = salted.groupBy("length", "bucket").agg(F.count(F.lit(1)).alias("n"))
    before = before.withColumn("before", F.sum("n").over(Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1))).select("length", "bucket", F.coalesce("before", F.lit(0)).alias("before"))
    within = F.row_number().over(Window.partitionBy("length", "bucket").orderBy("doc_id", "piece", "ids_crc32")) - 1
    ranked = salted.withColumn("within", within).join(before, ["length", "bucket"]).withColumn("rank", (F.col("before") + F.col("within")).cast("long"))
    lines = np.array(places(plan(histogram, length)) or [(0, 0, 0, 0)], np.int64)
    most = int(histogram.sum()) + 1
    found = spark.sparkContext.broadcast((lines[:, 0] * most + lines[:, 1], lines[:, 2], lines[:, 3], lines[:, 1], most))
    return ranked.select("doc_id", "piece", "start", "length", "ids_crc32", "rank").mapInArrow(_placed(found), _PIECES + ", sequence_id long, offset long")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 1024 tokens."""
    return pack(table(spark, sf_dir, "documents"))

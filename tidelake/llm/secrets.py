"""Secret scans with a ledger of blobs.

A text is known by its SHA-256 (its blob), whichever paths and versions hold it. The ledger is a
table that only grows: a row for each blob and scan, with the rules tried (name and version) and the
spans found. A scan hashes all texts, leaves out the pairs of blob and rule that the ledger has, and
reads of each unseen blob one text, where it lies, with the rules that it lacks. Findings of all
scans are then joined back to every path.

Spans are in code points, end exclusive. Null texts count as empty and share one blob; repeated
rows give repeated results; rows without an id are scanned like others."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import cut, free_name, new_path, table


@dataclass(frozen=True)
class Rule:
    """group and least: the part of a match that must have so many characters. signs: a text with a
    match holds one of them (in any case, if folded)."""

    name: str
    version: int
    pattern: str
    group: int = 0
    least: int = 1
    signs: tuple[str, ...] = ()
    folded: bool = False


#: Base rules first; their order is that of equal starts.
RULES = (
    Rule("assign", 1, r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8, ("password", "passwd", "secret", "token", "apikey", "api_key"), True),
    Rule("access", 1, r"AKIA[A-Z0-9]+", 0, 16, ("AKIA",)),
    Rule("hex", 1, r"[0-9a-f]+", 0, 32),
    Rule("pem", 1, r"-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----[A-Za-z0-9+/=\s]*-----END (?:[A-Z]+ )*PRIVATE KEY-----", 0, 1, ("PRIVATE KEY-----",)),
    Rule("github", 1, r"(?<![A-Za-z0-9_])(?:gh[pousr]_[A-Za-z0-9]{36,}|github_pat_[A-Za-z0-9_]{40,})", 0, 1, ("ghp_", "gho_", "ghu_", "ghs_", "ghr_", "github_pat_")),
    Rule("slack", 1, r"(?<![A-Za-z0-9])xox[abposr]-[A-Za-z0-9-]{20,}", 0, 1, ("xox",)),
    Rule("jwt", 1, r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", 0, 1, (".eyJ",)),
    Rule("login", 1, r"[a-z][a-z0-9+.-]{1,20}://[^\s:/@]+:[^\s/@]{3,}@[A-Za-z0-9.-]+", 0, 1, ("://",)),
)
BASE = 3
#: Findings of one blob are dealt to so many tasks with the paths that hold it.
SALTS = 16
_SPANS = "array<struct<start:int,rule:string,version:int,end:int>>"
_SPAN_TYPE = pa.list_(pa.struct([("start", pa.int32()), ("rule", pa.string()), ("version", pa.int32()), ("end", pa.int32())]))


def key(rule: Rule) -> str:
    return f"{rule.name}@{rule.version}"


def find(text: str, rules: tuple[Rule, ...]) -> list[dict]:
    """Matches of each rule, leftmost and without overlap within a rule, those too short dropped."""
    out: list[dict] = []
    lower = text.lower() if any(r.folded for r in rules) else text
    for rule in rules:
        if rule.signs and not any(s in (lower if rule.folded else text) for s in rule.signs):
            continue
        pattern = f"[0-9a-f]{{{rule.least},}}" if rule.pattern == "[0-9a-f]+" else rule.pattern  # a run is as long as it gets
        out += ({"start": m.start(), "rule": rule.name, "version": rule.version, "end": m.end()} for m in re.finditer(pattern, text, re.ASCII) if len(m.group(rule.group)) >= rule.least)
    return out


def store(versions: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Writes all texts once and returns id, blob, file and row of each."""
    spark, folder = versions.sparkSession, new_path(versions.sparkSession, "texts")
    rows = versions.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows.write.option("maxRecordsPerFile", 1 << 17).parquet(folder)
    written = spark.read.schema(rows.schema).parquet(folder)
    return cut(written.select("id", F.sha2("text", 256).alias("blob"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row")), "paths")


def _scanned(rules: tuple[Rule, ...]):
    by_key = {key(r): r for r in rules}

    def run(group: tuple, unseen: pa.Table) -> Iterator[pa.RecordBatch]:
        """The unseen texts of one file, by the rules that each lacks."""
        todo = {r["row"]: r for r in unseen.to_pylist()}
        fs, path = pafs.FileSystem.from_uri(group[0].as_py())
        out: list[tuple] = []
        with fs.open_input_file(path) as source:
            file, at = pq.ParquetFile(source), 0
            for batch in file.iter_batches(batch_size=1024, columns=["text"], use_threads=False):
                some = [i for i in range(batch.num_rows) if at + i in todo]
                for i, text in zip(some, batch.column("text").take(pa.array(some, pa.int64())).to_pylist(), strict=True):
                    r = todo[at + i]
                    out.append((r["blob"], r["todo"], find(text, tuple(by_key[k] for k in r["todo"]))))
                at += batch.num_rows
        blobs, tried, spans = zip(*out, strict=True)
        return pa.table({"blob": pa.array(blobs), "scanned": pa.array(tried, pa.list_(pa.string())), "spans": pa.array(spans, _SPAN_TYPE)})

    return run


class Ledger:
    """What was scanned, in a folder: blob, scanned (keys of rules) and spans, a row for each scan
    of a blob. Scans append to it; none is ever rewritten."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def rows(self) -> DataFrame:
        schema = f"blob string, scanned array<string>, spans {_SPANS}"
        try:
            return self.spark.read.schema(schema).parquet(self.path)
        except Exception as e:  # noqa: BLE001
            if "PATH_NOT_FOUND" not in str(e):
                raise
            return self.spark.createDataFrame([], schema)

    def scan(self, paths: DataFrame, rules: tuple[Rule, ...] = RULES) -> None:
        """Scans what paths (see store) holds and the ledger lacks."""
        every = F.array(*[F.lit(key(r)) for r in rules])
        one = paths.groupBy("blob").agg(F.min(F.struct("file", "row")).alias("at"))
        old = self.rows().groupBy("blob").agg(F.flatten(F.collect_list("scanned")).alias("scanned"))
        todo = F.array_except(every, F.coalesce("scanned", F.array().cast("array<string>")))
        unseen = one.join(old, "blob", "left").select("blob", "at.file", "at.row", todo.alias("todo")).filter(F.size("todo") > 0)
        found = unseen.groupBy("file").applyInArrow(_scanned(rules), f"blob string, scanned array<string>, spans {_SPANS}")
        found.write.mode("append").parquet(self.path)

    def findings(self, rules: tuple[Rule, ...] = RULES) -> DataFrame:
        """blob and spans by these rules, in order of their starts and of the rules; blobs without a
        span are left out. Each span has its rule's rank."""
        rank = F.create_map(*[x for k, r in enumerate(rules) for x in (F.lit(key(r)), F.lit(k))])
        spans = F.transform("spans", lambda s: F.struct(s["start"].alias("start"), F.try_element_at(rank, F.concat_ws("@", s["rule"], s["version"].cast("string"))).alias("rank"), s["rule"].alias("rule"), s["end"].alias("end")))
        own = self.rows().filter(F.size("spans") > 0).select("blob", F.filter(spans, lambda s: s["rank"].isNotNull()).alias("spans"))
        return own.groupBy("blob").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("spans")))).alias("spans")).filter(F.size("spans") > 0)


def joined_back(rows: DataFrame, found: DataFrame, blob: str, spans: str) -> DataFrame:
    """rows with the findings of their blob: few blobs have any, and each goes to SALTS tasks."""
    salt = free_name(rows.columns, "salt")
    spread = found.select(F.col("blob").alias(blob), F.col("spans").alias(spans), F.explode(F.array(*[F.lit(i) for i in range(SALTS)])).alias(salt))
    return rows.withColumn(salt, F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int")).join(spread, [blob, salt], "left").drop(salt)


def findings(paths: DataFrame, ledger: Ledger, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """id and spans of every row of paths, from what the ledger has."""
    found = joined_back(paths.select("id", "blob"), ledger.findings(rules), "blob", "spans")
    return found.select("id", F.coalesce("spans", F.array().cast("array<struct<start:int,rank:int,rule:string,end:int>>")).alias("spans"))


MARK = "[SECRET]"


def _may_hold(text, rules: tuple[Rule, ...]):
    """Whether a text has the signs of any rule; cheap, and in the JVM."""
    any_of = F.lit(False)
    for r in rules:
        hit = F.lit(False)
        for s in r.signs:
            hit = hit | F.contains(F.lower(text) if r.folded else text, F.lit(s))
        any_of = any_of | (hit if r.signs else text.rlike(f"[0-9a-f]{{{r.least}}}" if r.pattern == "[0-9a-f]+" else r.pattern))
    return any_of


def redact(docs: DataFrame, rules: tuple[Rule, ...] = RULES, ledger: Ledger | None = None) -> DataFrame:
    """documents with MARK in place of every span (of overlapping ones, in place of what they
    cover together); n_chars follows. All else stays. Only texts with a sign of a secret are hashed,
    scanned and shuffled."""
    spark = docs.sparkSession
    ledger = ledger or Ledger(spark, new_path(spark, "ledger"))
    blob, spans = free_name(docs.columns, "blob"), free_name(docs.columns, "spans")
    marked = cut(docs.withColumn(blob, F.when(F.coalesce(_may_hold(F.col("text"), rules), F.lit(False)), F.sha2("text", 256))), "marked")
    maybe = marked.filter(F.col(f"`{blob}`").isNotNull())
    ledger.scan(store(maybe, blob, "text"), rules)
    joined = joined_back(maybe, ledger.findings(rules), blob, spans)
    none = F.array().cast("array<struct<start:int,end:int>>")
    # spans are in order of their starts: one that begins within the last one kept widens it
    last = lambda acc: F.element_at(acc, -1)
    merged = F.aggregate(spans, none, lambda acc, s: F.when((F.size(acc) > 0) & (s["start"] < F.coalesce(F.get(acc, F.size(acc) - 1)["end"], F.lit(-1))), F.concat(F.slice(acc, F.lit(1), F.greatest(F.size(acc) - 1, F.lit(0))), F.array(F.struct(last(acc)["start"].alias("start"), F.greatest(last(acc)["end"], s["end"]).alias("end"))))).otherwise(F.concat(acc, F.array(F.struct(s["start"].alias("start"), s["end"].alias("end"))))))
    text = F.aggregate(F.reverse(merged), F.col("text"), lambda t, s: F.concat(F.substring(t, F.lit(1), s["start"]), F.lit(MARK), F.substring(t, s["end"] + 1, F.length(t))))
    out = joined.withColumn("text", F.when(F.col(spans).isNull(), F.col("text")).otherwise(text))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col(spans).isNull(), F.col("n_chars")).otherwise(F.length("text").cast("long")))
    columns = [F.col(f"`{c}`") for c in docs.columns]
    return marked.filter(F.col(f"`{blob}`").isNull()).select(*columns).unionByName(out.select(*columns))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in all documents: a scan by the base rules, then one by all rules, which tries only
    the pairs that the ledger lacks."""
    paths, ledger = store(table(spark, sf_dir, "documents")), Ledger(spark, new_path(spark, "ledger"))
    ledger.scan(paths, RULES[:BASE])
    ledger.scan(paths, RULES)
    named = F.transform("spans", lambda s: F.concat_ws(":", s["rule"], s["start"].cast("string"), s["end"].cast("string")))
    base = F.filter("spans", lambda s: s["rank"] < BASE)
    count = lambda rule: F.size(F.filter("spans", lambda s: s["rule"] == rule)).cast("long").alias(f"n_{rule}")
    found = findings(paths, ledger)
    return found.select(
        F.col("id").alias("doc_id"), count("assign"), count("access"), count("hex"),
        F.sha2(F.array_join(F.transform(base, lambda s: F.concat_ws(":", s["rule"], s["start"].cast("string"), s["end"].cast("string"))), ","), 256).alias("base_sha256"),
        F.array_join(named, ",").alias("spans"),
    )

"""Token count rollups kept by deltas.

A batch of changes (insert, revise, delete) is turned into signed rows: what a document counted so far is
taken back, what it counts now is added. Signed rows are summed by source, language and tokenizer version
and stored beside the batch's document log; totals are the sums of all committed batches. A batch costs its
own size and the lookup of its documents, never a recount: the log is laid out in buckets by the hash of the
document, and a batch reads those buckets that it touches. Every ``compact_every`` batches the logs are folded
into one state of the documents that are alive, and the sums into one table; later lookups read the state and the
logs since then, so they don't grow with the number of batches.

Commits are idempotent: a batch writes into folders of its own attempt and then creates one empty file in
``commits`` that names number, batch and attempt. Only named attempts are read; a batch id that is
committed is not applied again, and what a failed attempt left is never seen. A compaction counts once its own
empty file is there; it removes what the compaction before it had replaced. One writer at a time.

Defined results: of several changes of a document and version in a batch that with the largest ``seq``
holds, then a delete before others, then the largest count; an insert of a known document replaces it, a
delete of an unknown one does nothing, a revision of an unknown one inserts; a null count is 0; null
source, language and version are groups of their own; rows with a null doc_id cannot be looked up:
inserts add, deletes subtract what they state, revisions do nothing. Repeated rows of a document count
once. An empty batch commits nothing but its name. Other columns are ignored.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabspark.llm import bpe

KEY = ("doc_id", "version")
GROUP = ("source", "lang", "version")
# Tokenizer versions that a pattern defines: its matches are counted.
PATTERNS = {"words.v1": r"[^\x20\x09-\x0D]+", "pieces.v1": r"[A-Za-z0-9]+|[^A-Za-z0-9\x20\x09-\x0D]"}


def counted(documents: DataFrame, text: str = "text", patterns: dict[str, str] = PATTERNS) -> DataFrame:
    """Per document and tokenizer version: doc_id, source, lang, version, n_tokens (null text: 0)."""
    body = F.coalesce(F.col(text), F.lit(""))
    each = F.array(*[F.struct(F.lit(v).alias("version"), F.regexp_count(body, F.lit(p)).cast("long").alias("n_tokens")) for v, p in patterns.items()])
    return documents.select("doc_id", "source", "lang", F.inline(each))


def counted_ids(documents: DataFrame, version: str = "byte_bpe_multi_50k", text: str = "text", **encoder: str) -> DataFrame:
    """``counted`` for the byte-level BPE of ``bpe.encode`` (``encoder``: its vocabulary and pattern)."""
    named = F.struct("doc_id", "source", "lang").alias("named")
    ids = bpe.encode(documents.select(named, F.col(text).alias("text")), key="named", ids=False, **encoder)
    return ids.select("named.*", F.lit(version).alias("version"), "n_tokens")


class Rollup:
    """A rollup stored under ``root`` (a folder that all executors share). ``buckets`` holds for the life of the
    folder, and so does ``doc_id``, the type of document ids; ``compact_every`` is in batches, 0 for never."""

    def __init__(self, spark: SparkSession, root: str, buckets: int = 16, compact_every: int = 16, doc_id: str = "bigint") -> None:
        self.spark, self.root, self.buckets, self.compact_every, self.doc_id = spark, root, buckets, compact_every, doc_id
        self.schema = f"doc_id {doc_id}, version string, source string, lang string, n_tokens long, alive boolean, number int, bucket int"
        self.path = spark._jvm.org.apache.hadoop.fs.Path
        self.fs = self.path(root).getFileSystem(spark._jsc.hadoopConfiguration())
        for folder in ("commits", "compactions"):
            self.fs.mkdirs(self.path(f"{root}/{folder}"))

    def commits(self) -> list[tuple[int, str, str]]:
        """(number, batch, attempt) in order."""
        names = [s.getPath().getName() for s in self.fs.listStatus(self.path(f"{self.root}/commits"))]
        return sorted((int(m[1]), m[2], m[3]) for m in (re.fullmatch(r"(\d+)=(.*)=([0-9a-f]{32})", x) for x in names) if m)

    def compactions(self) -> list[tuple[int, str]]:
        """(number of the last batch that it holds, attempt) in order."""
        names = [s.getPath().getName() for s in self.fs.listStatus(self.path(f"{self.root}/compactions"))]
        return sorted((int(m[1]), m[2]) for m in (re.fullmatch(r"(\d+)=([0-9a-f]{32})", x) for x in names) if m)

    def _read(self, kind: str, schema: str) -> DataFrame:
        """What the last compaction holds and the batches since then."""
        folded = self.compactions()[-1:]
        last = folded[0][0] if folded else -1
        parts = [f"{self.root}/folded_{kind}/{attempt}" for _, attempt in folded]
        parts += [f"{self.root}/{kind}/{attempt}" for number, _, attempt in self.commits() if number > last]
        out = self.spark.createDataFrame([], schema)
        for path in parts:   # a folder each, so that their buckets are partitions
            out = out.unionByName(self.spark.read.schema(schema).parquet(path))
        return out

    def _write_log(self, rows: DataFrame, path: str) -> None:
        """By bucket; a few tasks share each, so that a bucket of many documents has more than one."""
        bucket, share = F.pmod(F.xxhash64("doc_id"), F.lit(self.buckets)).cast("int"), F.pmod(F.hash("doc_id"), F.lit(4))
        rows.withColumn("bucket", bucket).repartition("bucket", share).write.partitionBy("bucket").parquet(path)

    def compact(self) -> bool:
        """Folds all committed batches into one; False if there is none since the last time."""
        done, earlier = self.commits(), self.compactions()
        last = done[-1][0] if done else -1
        if last < 0 or (earlier and earlier[-1][0] >= last):
            return False
        attempt = uuid.uuid4().hex
        log = self._read("log", self.schema)
        state = log.groupBy(*KEY).agg(F.max_by(F.struct("source", "lang", "n_tokens", "alive"), "number").alias("now")).select(*KEY, "now.*").where("alive")
        self._write_log(state.withColumn("number", F.lit(last)), f"{self.root}/folded_log/{attempt}")
        self._sums().write.parquet(f"{self.root}/folded_delta/{attempt}")
        self.fs.create(self.path(f"{self.root}/compactions/{last}={attempt}"), False).close()
        gone = range(earlier[-2][0] + 1 if len(earlier) > 1 else 0, earlier[-1][0] + 1 if earlier else 0)
        for old in [f"{k}/{a}" for n, _, a in done if n in gone for k in ("log", "delta")] + [f"folded_{k}/{a}" for _, a in earlier[-2:-1] for k in ("log", "delta")]:
            self.fs.delete(self.path(f"{self.root}/{old}"), True)
        return True

    def commit(self, batch: str, changes: DataFrame) -> bool:
        """Applies changes (op, doc_id, source, lang, version, n_tokens, seq); False if already applied."""
        if not re.fullmatch(r"[\w.-]+", batch):
            raise ValueError(f"batch name {batch!r}")
        done = self.commits()
        if any(b == batch for _, b, _ in done):
            return False
        if (kind := changes.schema["doc_id"].dataType.simpleString()) != self.doc_id:
            raise ValueError(f"document ids of {kind} in a rollup of {self.doc_id}")
        number, attempt = (done[-1][0] + 1 if done else 0), uuid.uuid4().hex
        rows = changes.select("op", "doc_id", "source", "lang", "version", F.coalesce("n_tokens", F.lit(0)).cast("long").alias("n_tokens"), "seq")
        value = F.struct("source", "lang", "n_tokens", (F.col("op") != "delete").alias("alive"))
        order = F.struct("seq", (F.col("op") == "delete").alias("gone"), "n_tokens", "source", "lang")
        last = rows.where("doc_id is not null").groupBy(*KEY).agg(F.max_by(value, order).alias("now"))
        log = f"{self.root}/log/{attempt}"
        self._write_log(last.select(*KEY, "now.*", F.lit(number).alias("number")), log)
        now = self.spark.read.schema(self.schema).parquet(log)
        touched = [r[0] for r in now.select("bucket").distinct().collect()]   # at most ``buckets``
        old = self._read("log", self.schema).where(F.col("bucket").isin(touched))
        same = (F.col("o.doc_id") == F.col("n.doc_id")) & F.col("o.version").eqNullSafe(F.col("n.version"))
        before = old.alias("o").join(now.alias("n"), same, "left_semi").groupBy(*KEY).agg(F.max_by(F.struct("source", "lang", "n_tokens", "alive"), "number").alias("was")).select(*KEY, "was.*")
        signed = before.where("alive").select(*GROUP, F.lit(-1).alias("sign"), "n_tokens").union(now.where("alive").select(*GROUP, F.lit(1), "n_tokens"))
        loose = rows.where("doc_id is null and op in ('insert', 'delete')").select(*GROUP, F.when(F.col("op") == "insert", 1).otherwise(-1), "n_tokens")
        delta = signed.union(loose).groupBy(*GROUP).agg(F.sum("sign").cast("long").alias("docs"), F.sum(F.col("sign") * F.col("n_tokens")).cast("long").alias("tokens"))
        delta.write.parquet(f"{self.root}/delta/{attempt}")
        self.fs.create(self.path(f"{self.root}/commits/{number}={batch}={attempt}"), False).close()
        if self.compact_every and number - max((n for n, _ in self.compactions()), default=-1) >= self.compact_every:
            self.compact()
        return True

    def _sums(self) -> DataFrame:
        deltas = self._read("delta", "source string, lang string, version string, docs long, tokens long")
        return deltas.groupBy(*GROUP).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens")).where("docs <> 0 or tokens <> 0")

    def totals(self) -> DataFrame:
        """docs and tokens by source, lang and version."""
        return self._sums()

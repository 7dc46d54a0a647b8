"""WARC archives: records with revisits for equal payloads, and an index merged from sorted runs.

``write`` makes WARC 1.1 files of one gzip member a record, so that a record is read by seeking to its place
in the packed file. Tasks pack the records and number files by the bytes written (``FILE_BYTES``); Spark's
text writer stores the members, so files go to any file system that Spark knows and appear only when a task
commits. The writer wants a separator between its lines: an empty gzip member, which unpacks to nothing. Of
records with equal payloads that with the largest id is the response, the others are revisits without
payload. ``read_runs`` reads the archives back record by record; the captures of a file, sorted by URL key,
timestamp and id, are a run. ``merge`` deals the runs out by ranges of that order (ranges split a frequent
key too; their number follows the number of captures) and merges what each range has of the runs with a
loser tree. Ranges and rows in them are numbered, which is the global order. ``offset`` and ``length`` of a
capture are those of its member in ``file``, a path under the folder of the archives.

Defined results: a null payload counts as empty; null or odd URLs give the URL itself as key (null: empty);
line breaks in a URL are written as %0D and %0A; rows that share an id and payload are records of one
kind; a null id is never a response that others refer to unless all ids are null; an empty table gives
no files and an empty index. Only the named columns are read.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import uuid
import zlib
from collections.abc import Iterator
from itertools import islice
from urllib.parse import urlsplit

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabspark.llm.common import text_slices, written
from tabspark.session import scratch_path

END = "\r\n\r\n"
SALT = 16
FILE_BYTES = 64 << 20  # a file holds less than this and one record more
RANGE_ROWS = 100_000   # captures a range should hold, which a task merges at a time
NO_MEMBER = gzip.compress(b"", mtime=0)
FIELDS = "page_id {kind}, url string, captured string, record_type string, refers_to {kind}, payload_bytes long, payload_digest string, file string, offset long, length long, url_key string"


def digest(payload: Column) -> Column:
    """Upper-case base32 of the SHA-1: each 20 bits are four base32 digits."""
    hexed = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(hexed, i, 5), 16, 32), 4, "0") for i in range(1, 41, 5)]
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def records(pages: DataFrame, key: str, url: str, payload: str, captured: Column) -> DataFrame:
    """One WARC record per row, as text without the blank lines that end it."""
    body = F.encode(F.col("payload"), "UTF-8")
    rows = pages.select(F.col(key).alias("id"), F.coalesce(F.col(url), F.lit("")).alias("url"), F.coalesce(F.col(payload), F.lit("")).alias("payload"), captured.alias("at")).withColumn("digest", digest(body))
    shared = rows.groupBy("digest").agg(F.max("id").alias("first"), F.count("*").alias("n")).where("n > 1 and first is not null")
    # written, so that Spark knows its size: a small table is broadcast and no payload is shuffled for the join;
    # else a payload that very many rows share is dealt out over SALT keys
    shared = written(shared, "shared").select("digest", "first", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))).alias("salt"))
    rows = rows.withColumn("salt", F.coalesce(F.pmod(F.hash("id"), F.lit(SALT)), F.lit(0))).join(shared, ["digest", "salt"], "left")
    revisit = F.col("first").isNotNull() & ~F.col("id").eqNullSafe(F.col("first"))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.octet_length("payload").cast("string"), F.lit(END))
    block = F.concat(http, F.when(revisit, "").otherwise(F.col("payload")))
    name = lambda c: F.concat(F.lit("<urn:x-capture:"), F.coalesce(c.cast("string"), F.lit("")), F.lit(">"))
    safe = F.replace(F.replace(F.col("url"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    head = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: "), F.when(revisit, "revisit").otherwise("response"),
        F.lit("\r\nWARC-Record-ID: "), name(F.col("id")), F.lit("\r\nWARC-Target-URI: "), safe,
        F.lit("\r\nWARC-Date: "), F.date_format("at", "yyyy-MM-dd'T'HH:mm:ss'Z'"), F.lit("\r\nWARC-Payload-Digest: sha1:"), F.col("digest"),
        F.when(revisit, F.concat(F.lit("\r\nWARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest\r\nWARC-Refers-To: "), name(F.col("first")))).otherwise(""),
        F.lit("\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: "), F.octet_length(block).cast("string"), F.lit(END))
    return rows.select(F.concat(head, block).alias("value"))


def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Records as gzip members, with the number of the file they belong to."""
    held = roll = 0
    for batch in batches:
        texts = batch["value"].tolist()
        for part in text_slices(texts):
            rolls, out = [], []
            for text in texts[part]:
                out.append(gzip.compress((text + END).encode("utf-8", "surrogatepass"), 6, mtime=0))
                rolls.append(roll)
                held += len(out[-1]) + len(NO_MEMBER)
                if held >= FILE_BYTES:
                    held, roll = 0, roll + 1
            yield pd.DataFrame({"roll": rolls, "value": pd.Series(out, dtype=object)})


def write(pages: DataFrame, path: str, captured: Column, key: str = "page_id", url: str = "url", payload: str = "html") -> None:
    """WARC files under ``path``; ``captured`` is each row's time."""
    members = records(pages, key, url, payload, captured).mapInPandas(pack, "roll int, value binary")
    # the cast keeps the bytes as they are
    lines = members.select("roll", F.col("value").cast("string").alias("value"))
    lines.write.partitionBy("roll").option("encoding", "ISO-8859-1").option("lineSep", NO_MEMBER.decode("latin-1")).text(path)


def url_key(url: str) -> str:
    """Host labels turned round, then path and query: captures of a site sort together."""
    try:
        parts = urlsplit(url.strip())
        host = (parts.hostname or "").removeprefix("www.")
        if not host:
            return url
        port = f":{parts.port}" if parts.port not in (None, 80, 443) else ""
        query = "?" + "&".join(sorted(parts.query.split("&"))) if parts.query else ""
        return f"{','.join(reversed(host.split('.')))}{port}){parts.path.rstrip('/') or '/'}{query}".lower()
    except ValueError:
        return url


def members(content: bytes, step: int = 1 << 14) -> Iterator[tuple[int, int, bytes]]:
    """Gzip members of a packed file: offset, length and unpacked bytes of those that hold any."""
    at = 0
    while at < len(content):
        unpack, start, out = zlib.decompressobj(31), at, []
        while not unpack.eof:
            if at >= len(content):
                raise ValueError(f"member at {start} is cut short")
            out.append(unpack.decompress(content[at:at + step]))
            at = min(at + step, len(content))
        at -= len(unpack.unused_data)
        if data := b"".join(out):
            yield start, at - start, data


def parse(stream) -> Iterator[tuple[dict[str, str], str, int]]:
    """Records of an unpacked stream: headers, payload digest, payload bytes. The payload of a response is read
    and its digest made anew; a revisit's are those of its headers."""
    while line := stream.readline():
        if line in (b"\r\n", b"\n"):
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no WARC record: {line[:40]!r}")
        head = {}
        while (line := stream.readline()) not in (b"\r\n", b""):
            name, _, value = line.decode("utf-8").partition(":")
            head[name.lower()] = value.strip()
        block = stream.read(int(head["content-length"]))
        if len(block) != int(head["content-length"]):
            raise ValueError("a record is cut short")
        http, _, payload = block.partition(b"\r\n\r\n")
        if head["warc-type"] == "response":
            yield head, base64.b32encode(hashlib.sha1(payload).digest()).decode(), len(payload)
        else:
            length = next((int(x.split(b":")[1]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:")), 0)
            yield head, head.get("warc-payload-digest", "").removeprefix("sha1:"), length


def read_runs(spark: SparkSession, path: str, kind: str = "long") -> DataFrame:
    """Captures of the archives under ``path``, those of each file as a sorted run. A task holds one file,
    which ``FILE_BYTES`` bounds, and unpacks a record at a time."""
    number = (lambda x: int(x) if x else None) if kind in ("long", "bigint", "int") else (lambda x: x or None)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [f.split(" ")[0] for f in FIELDS.split(", ")]
        for batch in batches:
            for file, content in zip(batch["path"], batch["content"], strict=True):
                rows, under = [], "/".join(file.split("/")[-2:])
                for offset, length, data in members(content):
                    for head, found, size in parse(io.BytesIO(data)):
                        id_, refers = (number(head.get(h, "").removeprefix("<urn:x-capture:").removesuffix(">")) for h in ("warc-record-id", "warc-refers-to"))
                        url = head["warc-target-uri"]
                        rows.append((id_, url, head["warc-date"], head["warc-type"], refers, size, found, under, offset, length, url_key(url)))
                rows.sort(key=order_of)
                yield pd.DataFrame(rows, columns=names, dtype=object)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("path", "content")
    return files.mapInPandas(run, FIELDS.format(kind=kind))


def order_of(row: tuple) -> tuple:
    return row[10], row[2], row[0] is not None, row[0]


class LoserTree:
    """Merges k sorted lists: inner nodes hold the loser of their match, so that the next least row takes
    one match on each level."""

    def __init__(self, runs: list[list], key) -> None:
        self.runs, self.key, self.at, k = runs, key, [0] * len(runs), len(runs)
        self.keys = [key(r[0]) if r else None for r in runs]
        self.tree = [-1] * k
        for i in range(k):
            self._play(i)

    def _less(self, a: int, b: int) -> bool:
        x, y = self.keys[a], self.keys[b]
        return x is not None and (y is None or (x, a) < (y, b))

    def _play(self, i: int) -> None:
        node = (i + len(self.runs)) // 2
        while node:
            other = self.tree[node]
            if other < 0:  # the first to come waits for its opponent
                self.tree[node] = i
                return
            if self._less(other, i):
                self.tree[node], i = i, other
            node //= 2
        self.tree[0] = i

    def __iter__(self) -> Iterator:
        while self.runs and self.keys[w := self.tree[0]] is not None:
            yield self.runs[w][self.at[w]]
            self.at[w] += 1
            self.keys[w] = self.key(self.runs[w][self.at[w]]) if self.at[w] < len(self.runs[w]) else None
            self._play(w)


def merge(runs: DataFrame, range_rows: int = RANGE_ROWS) -> DataFrame:
    """The runs in global order: ``merge_part`` numbers the range, ``merge_row`` the row in it. A task holds the
    index rows of one range (no payloads), about ``range_rows`` of them however many captures there are."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        by_run: dict[str, list[tuple]] = {}
        names: list[str] = []
        for batch in batches:
            names = list(batch.columns)
            for row in zip(*(batch[c].astype(object).where(batch[c].notna(), None).tolist() for c in names), strict=True):
                by_run.setdefault(row[7], []).append(row)
        merged = iter(LoserTree([sorted(r, key=order_of) for _, r in sorted(by_run.items())], order_of))  # sorted() of a sorted run is one pass
        at = 0
        while rows := list(islice(merged, 10_000)):
            out = pd.DataFrame(rows, columns=names, dtype=object)
            yield out.assign(merge_part=TaskContext.get().partitionId(), merge_row=range(at, at + len(rows)))
            at += len(rows)

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in runs.schema)
    order = ("url_key", "captured", "page_id")
    wanted = -(-runs.count() // range_rows)
    usual = int(runs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = runs.repartitionByRange(wanted, *order) if wanted > usual else runs.repartitionByRange(*order)
    return ranged.mapInPandas(run, f"{schema}, merge_part int, merge_row long")


def histories(pages: DataFrame, captured: Column, key: str = "page_id", url: str = "url", payload: str = "html") -> DataFrame:
    """Archives pages into the shared folder, reads them back and gives the merged index."""
    spark, path = pages.sparkSession, scratch_path(pages.sparkSession, f"warc-{uuid.uuid4().hex}")
    write(pages, path, captured, key, url, payload)
    return merge(written(read_runs(spark, path, pages.schema[key].dataType.simpleString()), "runs"))

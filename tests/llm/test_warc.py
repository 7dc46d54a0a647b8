import base64
import glob
import gzip
import hashlib
import os
import random

import pytest
from pyspark.sql import functions as F

from tabspark.llm import warc


def test_loser_tree_is_a_sorted_merge():
    r = random.Random(1)
    for k in (0, 1, 2, 3, 7, 16, 33):
        runs = [sorted(r.choices(range(50), k=r.randint(0, 30))) for _ in range(k)]
        assert list(warc.LoserTree([list(x) for x in runs], lambda x: x)) == sorted(x for run in runs for x in run)


def test_url_keys():
    assert warc.url_key("https://www.Blog.Example.com:8080/A/?b=2&a=1") == "com,example,blog:8080)/a?a=1&b=2"
    assert [warc.url_key(u) for u in ("", "not a url", "http://[x")] == ["", "not a url", "http://[x"]


def test_members_of_a_packed_file():
    r = random.Random(3)
    texts = [bytes(r.choices(b"abc\r\n", k=r.choice([1, 30, 5_000, 200_000]))) for _ in range(40)]
    packed = b"".join(gzip.compress(t, mtime=0) + warc.NO_MEMBER for t in texts)
    for step in (1 << 14, 100, 1 << 20):
        got = list(warc.members(packed, step))
        assert [d for _, _, d in got] == texts
        assert [gzip.decompress(packed[o:o + n]) for o, n, _ in got] == texts
    with pytest.raises(ValueError):
        list(warc.members(packed[:-25]))
    assert list(warc.members(b"")) == []


def test_records_are_fetched_by_their_place_and_files_roll_by_bytes(spark, tmp_path, monkeypatch):
    r = random.Random(4)
    rows = [(i, f"http://h{i % 3}.org/{i}", "".join(r.choices("abcdefgh \u00e9<>", k=3_000)) if i % 4 else "same") for i in range(60)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(2)
    monkeypatch.setattr(warc, "FILE_BYTES", 10_000)
    path, pack = str(tmp_path / "archives"), warc.pack

    def small(batches):   # the bound goes with the function to the tasks
        warc.FILE_BYTES = 10_000
        yield from pack(batches)

    monkeypatch.setattr(warc, "pack", small)
    warc.write(df, path, F.timestamp_seconds(F.col("page_id")))
    files = glob.glob(f"{path}/roll=*/part-*")
    assert len(files) > 6 and max(map(os.path.getsize, files)) < 10_000 + 6_000
    index = warc.merge(warc.read_runs(spark, path), range_rows=5).collect()
    assert len(index) == 60 and len({x.merge_part for x in index}) > spark.sparkContext.defaultParallelism
    for x in index:
        with open(f"{path}/{x.file}", "rb") as f:
            f.seek(x.offset)
            record = gzip.decompress(f.read(x.length)).decode()
        assert f"<urn:x-capture:{x.page_id}>" in record and record.endswith("\r\n\r\n")
        if x.record_type == "response":
            assert record.endswith("\r\n\r\n" + rows[x.page_id][2] + "\r\n\r\n")
    index.sort(key=lambda x: (x.merge_part, x.merge_row))
    assert [x.url_key for x in index] == sorted(x.url_key for x in index)


def test_round_trip(spark):
    r = random.Random(2)
    rows = [(i, f"http://h{i % 3}.org/{r.randrange(9)}", r.choice(["<p>é</p>\r\n\r\nWARC/1.1\r\n", "", None, "x" * 50_000, f"<b>{i}</b>\n"]), i) for i in range(200)]
    rows += [(7, "http://h.org", "same", 0), (7, "http://h.org", "same", 0), (None, None, "only null", 1), (None, "a\r\nb", "<b>1</b>\n", 1), (900, "http://h.org", "\0 ퟿😀", 1)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, offset long").repartition(5)
    got = warc.histories(df, F.timestamp_seconds(F.lit(1_600_000_000) + F.coalesce("page_id", F.lit(0)))).collect()
    best = {}
    for i, _, h, _ in rows:
        best[h or ""] = max(best.get(h or "", -1), -1 if i is None else i)
    many = {h for h in best if sum((x[2] or "") == h for x in rows) > 1}
    want = []
    for i, u, h, _ in rows:
        raw, top = (h or "").encode(), best[h or ""]
        revisit = (h or "") in many and top >= 0 and i != top
        want.append((-1 if i is None else i, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), "revisit" if revisit else "response", top if revisit else -1))
    back = lambda x: -1 if x is None else x
    assert sorted((back(g.page_id), g.payload_bytes, g.payload_digest, g.record_type, back(g.refers_to)) for g in got) == sorted(want)
    got.sort(key=lambda g: (g.merge_part, g.merge_row))
    keys = [(g.url_key, g.captured, back(g.page_id)) for g in got]
    assert keys == sorted(keys)
    assert warc.histories(df.limit(0), F.current_timestamp()).count() == 0

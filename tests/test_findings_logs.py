import json

from tabspark.operators import findings as fi
from tabspark.sources import logs as lg


def test_reports_rollup(spark, tmp_dir):
    vulns = [{"VulnerabilityID": f"CVE-{i:03d}", "PkgName": f"p{i}", "InstalledVersion": "1.0",
              "FixedVersion": None if i % 2 else "1.1", "Severity": "high" if i % 3 else "CRITICAL", "Title": "t"}
             for i in range(8)]
    reports = [
        {"Results": [{"Target": "img-a", "Vulnerabilities": vulns},
                     {"Target": "img-b", "Vulnerabilities": [{"VulnerabilityID": "CVE-900", "Severity": "LOW"}]},
                     {"Target": None, "Vulnerabilities": None}]},
        {"Results": None},
    ]
    for i, r in enumerate(reports):
        with open(f"{tmp_dir}/report{i}.json", "w") as fh:
            json.dump(r, fh, indent=2)
    flat = fi.flatten_reports(lg.read_reports(spark, tmp_dir))
    roll = {r["Target"]: r for r in fi.rollup(flat).collect()}
    assert set(roll) == {"img-a"}
    a = roll["img-a"]
    assert (a["findings"], a["critical"], a["high"], a["listed"], a["remaining"], a["failed"]) == (8, 3, 5, 5, 3, True)
    listed = fi.listed(flat).orderBy("rank").collect()
    assert [r["VulnerabilityID"] for r in listed] == ["CVE-000", "CVE-001", "CVE-002", "CVE-003", "CVE-004"]
    assert listed[1]["FixedVersion"] == "unfixed"


def test_log_parsing(spark):
    lines = spark.createDataFrame([
        ('{"timestamp": "2024-01-01T00:00:00+00:00", "level": "INFO", "logger": "a", "message": "m", '
         '"request_id": "r1", "status_code": 200, "duration_ms": 1.5}',),
        ('{"timestamp": "2024-01-01T00:00:01+00:00", "level": "error", "logger": "a", "message": "x", '
         '"exception": "Traceback ..."}',),
        ("Traceback (most recent call last):",),
        ('{"timestamp": "yesterday", "level": "WARNING", "logger": "a", "message": "bad time"}',),
    ], "value string")
    rec = lg.parse_logs(lines)
    rows = rec.collect()
    assert [r["corrupt"] for r in rows] == [False, False, True, False]
    assert rows[3]["timestamp"] is None and rows[0]["timestamp"] is not None
    assert rows[0]["status_code"] == 200 and rows[0]["duration_ms"] == 1.5
    counts = {r["level"]: r["lines"] for r in lg.level_counts(rec).collect()}
    assert counts == {"INFO": 1, "ERROR": 1, "WARNING": 1, None: 1}


def test_log_extras_and_corrupt_text_are_kept(spark):
    lines = spark.createDataFrame([('{"level": "INFO", "message": "m", "run_id": "r7", "n": 3}',), ("not json",), (None,)], "value string")
    a, b, c = lg.parse_logs(lines).collect()
    assert a["extra"] == {"run_id": "r7", "n": "3"} and a["raw_line"] is None and not a["corrupt"]
    assert b["raw_line"] == "not json" and b["extra"] is None and b["corrupt"]
    assert c["corrupt"] and c["raw_line"] is None

from tabspark.operators import findings as fi
from tabspark.operators import score as sc


def test_null_score_is_no_agreement(spark):
    a = spark.createDataFrame([(1, None), (2, 0.5)], "k long, score double")
    b = spark.createDataFrame([(1, 0.9), (2, 0.5)], "k long, score double")
    r = sc.score_parity(a, b, "k").first()
    assert r["nonfinite"] == 1 and not r["passed"]
    assert sc.score_parity(b, b, "k").first()["passed"]


def test_listed_findings_keep_report_order(spark):
    ids = [9, 1, 8, 2, 7, 3]
    v = [(f"CVE-{i}", "p", "1", "2", "high", f"t{i}") for i in ids]
    kind = "array<struct<VulnerabilityID:string,PkgName:string,InstalledVersion:string,FixedVersion:string,Severity:string,Title:string>>"
    reports = spark.createDataFrame([([("img", v)],)], f"Results array<struct<Target:string,Vulnerabilities:{kind}>>")
    got = fi.listed(fi.flatten_reports(reports)).collect()
    assert {r["VulnerabilityID"] for r in got} == {f"CVE-{i}" for i in ids[:5]}
    assert {r["Title"] for r in got} == {f"t{i}" for i in ids[:5]}

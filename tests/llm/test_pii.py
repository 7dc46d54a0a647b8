import hashlib
import random
import re

from tabspark.llm import pii

PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(d):
    return sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(d))) % 10 == 0


def ok(kind, m):
    d = re.sub("[^0-9]", "", m)
    return {"email": True, "ip": all(int(p) <= 255 for p in m.split(".")) if kind == "ip" else 0, "card": 12 <= len(d) <= 19 and luhn(d), "phone": 9 <= len(d) <= 15}[kind]


def brute(text):
    return sorted((m.start(), k, m.end()) for k, (n, p) in enumerate(PATTERNS.items()) for m in re.finditer(p, text or "") if ok(n, m.group()))


def texts():
    r = random.Random(9)
    out = [None, "", "é a.b+c@x-y.co.uk, 10.0.0.255 10.0.0.256 1.2.3.4.5.6.7.8", "a@b.c_d@e.f a@b c@d.e..f", "4111 1111 1111 1111 +1 (415) 555-0100", "😀 4111-1111-1111-1111x", "000.01.2.0003 +49 30 12345678-", "1" * 4000, "a" * 4000 + "@", "1 " * 3000, "x.y" * 2000 + "@z.com", "a@" + "b." * 3000 + "c", "+" * 50 + "1", "+1" + "." * 2000]
    for _ in range(400):
        out.append("".join(r.choice(["1", "23", "4", ".", "@", "a", "b", " ", "-", "+", "(", ")", "é", "255", "a@b.c", "4111 1111 1111 1111"]) for _ in range(r.randint(1, 60))))
    return out


def test_base_spans_match_brute_force(spark):
    data = list(enumerate(texts()))
    got = {r.doc_id: r for r in pii.digest(pii.find(spark.createDataFrame(data, "doc_id long, text string"))).collect()}
    for i, t in data:
        want = brute(t)
        joined = ",".join(f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in want)
        assert got[i].base_sha256 == hashlib.sha256(joined.encode()).hexdigest(), (t, joined, got[i].spans)
        assert [got[i].n_email, got[i].n_ip, got[i].n_card, got[i].n_phone] == [sum(k == j for _, k, _ in want) for j in range(4)]
        assert [s for s in got[i].spans.split(",") if s.split(":")[0] in pii.BASE] == [s for s in joined.split(",") if s] or not joined


def test_checksums_and_context(spark):
    rows = [(1, "IBAN DE89 3704 0044 0532 0130 00."), (2, "IBAN DE88 3704 0044 0532 0130 00."), (3, "GB82WEST12345698765432"), (4, "my ssn is 123-45-6789"), (5, "part 123-45-6789"), (6, "call (415) 555-0100"), (7, "order 415 555 0100")]
    got = {r.doc_id: r.spans for r in pii.digest(pii.find(spark.createDataFrame(rows, "doc_id long, text string"))).collect()}
    assert got == {1: "iban:5:32", 2: "", 3: "iban:0:22", 4: "ssn:10:21", 5: "", 6: "phone_local:5:19", 7: ""}


def test_redact(spark):
    rows = [(1, "é me@x.org 10.0.0.1!", "k"), (2, None, "k"), (None, "plain", None), (3, "+1 415 555 0100 1111", "k"), (3, "+1 415 555 0100 1111", "k")]
    df = spark.createDataFrame(rows, "doc_id long, text string, spans string")
    out = pii.redact(df)
    assert out.columns == df.columns
    assert sorted((r.doc_id or 0, r.text or "") for r in out.collect()) == [(0, "plain"), (1, "é [EMAIL] [IP]!"), (2, ""), (3, "[PHONE]"), (3, "[PHONE]")]
    assert pii.find(df.limit(0)).count() == 0


def test_redact_leaves_columns_of_clashing_names(spark):
    rows = [(1, "to a@b.cd and 10.0.0.1", "MINE", "t", 7, "g")]
    df = spark.createDataFrame(rows, "doc_id long, text string, _spans string, `__spans_text` string, _Pieces int, `a.b` string")
    out = pii.redact(df)
    assert out.dtypes == df.dtypes
    assert tuple(out.first()) == (1, "to [EMAIL] and [IP]", "MINE", "t", 7, "g")


def test_many_spans_of_one_text(spark):
    import time
    part = "mail user{0}@host{0}.example.org or 10.{1}.0.1 é. "
    text = "".join(part.format(k, k % 256) for k in range(6_000))
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    start = time.time()
    got = pii.digest(pii.find(df)).first()
    assert (got.n_email, got.n_ip) == (6_000, 6_000)
    want = ",".join(f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in brute(text))
    assert got.base_sha256 == hashlib.sha256(want.encode()).hexdigest()
    assert pii.redact(df).first().text == "mail [EMAIL] or [IP] é. " * 6_000
    assert time.time() - start < 120


def test_context_words_across_short_pieces(spark):
    """The words around a match are those of the text, also where many matches and gaps lie between."""
    r = random.Random(4)
    rows = [(k, "".join(r.choice(["ssn ", "call", " 12 ", "3", " x ", "123-45-6789 ", "(415) 555-0100 ", "1.2.3.4 ", "é", "y" * 30, "99"]) for _ in range(r.randint(5, 60)))) for k in range(200)]
    found = pii.find(spark.createDataFrame(rows, "doc_id long, text string"))
    texts_ = dict(rows)
    seen = 0
    for row in found.collect():
        t, got = texts_[row.doc_id], {(s.start, s.end): s.score for s in row.spans if s.kind == "ssn"}
        for m in re.finditer(pii.RULES["ssn"][1], t):
            near = t[max(0, m.start() - 40):m.start()] + " " + t[m.end():m.end() + 40]
            raised = bool(re.search(pii.RULES["ssn"][3], near, re.I))
            assert ((m.start(), m.end()) in got) == raised
            seen += raised
    assert seen > 20

"""Personal data: regular expressions propose spans, checksums confirm them, nearby words adjust scores.

DataFrame functions only. Matches come from ``regexp_extract_all``, their places from the lengths of what
``split`` leaves between them. The patterns are possessive and start only where a run of their first
class starts (or the last match ended), so that they take time in proportion to the text and no stack.

Base kinds, always kept: email, ip (parts at most 255), card (12 to 19 digits, Luhn), phone (9 to 15
digits). Added kinds, kept from score 0.7: iban (mod-97), ssn and phone_local (only with a context word
within 40 characters).

Defined results: null text counts as empty and has no spans; repeated rows give the same spans; spans of
different kinds may overlap; spans are ordered by start, then kind. Only key and text are read by
``find``; ``redact`` passes other columns through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "iban", "ssn", "phone_local")
CONTEXT, MIN_SCORE = 40, 0.7
RUN, PIECE = 64, 256  # elements of a run of partial sums, code points of a piece of text
_PART = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"

# kind: (a text without this has no match, pattern, score, words that raise it)
RULES = {
    "email": ("@", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", 0.9, "mail|contact|write"),
    "ip": (".", r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}", 0.8, r"\bip\b|address|host|server"),
    "card": (None, r"[0-9](?:[\x20-]?[0-9])++", 0.85, "card|visa|master|amex|pay"),
    "phone": ("+", r"\+[0-9][\x20().0-9-]+[0-9]", 0.75, "tel|phone|call|fax|mobile"),
    "iban": (None, r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,3})?)(?![A-Za-z0-9])", 0.9, "iban|account|bank"),
    "ssn": ("-", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", 0.4, r"\bssn\b|social security"),
    "phone_local": (None, r"(?<![0-9+])\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9])", 0.4, "tel|phone|call|fax|mobile"),
}
_RAISE = 0.4


def luhn(digits: Column) -> Column:
    """Whether 12 to 19 digits pass Luhn's check (every second from the right doubled)."""
    wide = F.lpad(digits, 20, "0")
    terms = [F.substring(wide if i % 2 == 0 else F.translate(wide, "0123456789", "0246813579"), i, 1).cast("int") for i in range(1, 21)]
    return sum(terms[1:], terms[0]) % 10 == 0


def mod97(iban: Column) -> Column:
    """Whether letters and digits without spaces pass the mod-97 check."""
    moved = F.concat(F.substr(iban, F.lit(5)), F.substring(iban, 1, 4))
    digit = lambda i: F.instr(F.lit("0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ"), F.substr(moved, i, F.lit(1))) - 1
    return F.aggregate(F.sequence(F.lit(1), F.length(moved)), F.lit(0), lambda a, i: (a * F.when(digit(i) > 9, 100).otherwise(10) + digit(i)) % 97) == 1


def _valid(kind: str, match: Column) -> Column:
    digits = F.regexp_replace(match, "[^0-9]", "")
    if kind == "ip":
        return match.rlike(rf"^{_PART}\.{_PART}\.{_PART}\.{_PART}$")
    if kind == "card":
        return F.when(F.length(digits).between(12, 19), luhn(digits)).otherwise(False)
    if kind == "phone":
        return F.length(digits).between(9, 15)
    if kind == "iban":
        return mod97(F.replace(match, F.lit(" "), F.lit("")))
    return F.lit(True)


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once, however often the body's lambdas read it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def before(values: Column, combine, zero: Column) -> Column:
    """For each element of an array of numbers, all elements before it combined (a running sum or maximum).
    Taken in runs of RUN elements, so that the steps grow little faster than the array."""
    fold = lambda x: F.aggregate(x, zero, combine)
    indices = lambda n: F.when(n > 0, F.sequence(F.lit(1), n)).otherwise(F.array().cast("array<int>"))
    runs = lambda v: F.transform(indices(F.ceil(F.size(v) / RUN).cast("int")), lambda c: F.slice(v, (c - 1) * RUN + 1, F.lit(RUN)))
    starts = lambda t: F.transform(indices(F.size(t)), lambda c: fold(F.slice(t, F.lit(1), c - 1)))
    inside = lambda s, x: F.transform(indices(F.size(x)), lambda i: combine(s, fold(F.slice(x, F.lit(1), i - 1))))
    return let(values, lambda v: let(runs(v), lambda r: F.flatten(let(F.transform(r, fold), lambda t: F.zip_with(starts(t), r, inside)))))


def _spans(kind: str, matches: Column, gaps: Column) -> Column:
    """Valid matches as structs. A match starts after the gaps and matches before it; the words around it are
    read from the pieces next to it, so that no match walks through the whole text."""
    _, _, score, words = RULES[kind]
    none = F.lit("")
    pieces = F.flatten(F.zip_with(gaps, matches, lambda g, m: F.array(F.coalesce(g, none), F.coalesce(m, none))))

    def near(s: Column, heads: Column, tails: Column) -> Column:  # a gap and a match have 2 characters or more
        ahead = F.array_join(F.slice(tails, F.greatest(s["at"] - 2 * CONTEXT, F.lit(1)), F.least(s["at"] - 1, F.lit(2 * CONTEXT))), "")
        after = F.array_join(F.slice(heads, s["at"] + 1, F.lit(2 * CONTEXT)), "")
        return F.concat(F.right(ahead, F.lit(CONTEXT)), F.lit(" "), F.left(after, F.lit(CONTEXT)))

    def scored(valid: Column, heads: Column, tails: Column) -> Column:
        raised = lambda s: F.when(near(s, heads, tails).rlike(f"(?i){words}"), _RAISE).otherwise(0.0)
        return F.transform(valid, lambda s: F.struct(
            s["start"].alias("start"), F.lit(KINDS.index(kind)).alias("rank"), (s["start"] + F.length(s["match"])).alias("end"), F.lit(kind).alias("kind"),
            s["match"].alias("match"), F.least(F.lit(1.0), F.lit(score) + raised(s)).alias("score")))

    def placed(p: Column) -> Column:
        starts = before(F.transform(p, F.length), lambda a, x: a + x, F.lit(0))
        each = F.zip_with(F.sequence(F.lit(1), F.size(p)), F.arrays_zip(p.alias("match"), starts.alias("start")), lambda k, x: F.struct(k.alias("at"), x["match"].alias("match"), x["start"].alias("start")))
        return F.filter(each, lambda s: (s["at"] % 2 == 0) & (s["match"] != "") & _valid(kind, s["match"]))

    cut = lambda p, f: F.transform(p, lambda x: f(x, F.lit(CONTEXT)))
    return let(pieces, lambda p: let(placed(p), lambda valid: let(cut(p, F.left), lambda heads: let(cut(p, F.right), lambda tails: scored(valid, heads, tails)))))


def unused(df: DataFrame, name: str) -> str:
    """``name``, with as many underscores before it as no column of ``df`` has (upper and lower case alike)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def _with_spans(df: DataFrame, text: str, out: str) -> DataFrame:
    """``df`` with ``out``: array of spans (start, rank, end, kind, match, score), places in code points."""
    own = [unused(df, f"{out}_{x}") for x in ("text", "match", "gap")]
    matches, gaps = [], []
    for kind, (needs, pattern, _, _) in RULES.items():
        body = F.col(own[0])
        may = F.contains(body, F.lit(needs)) if needs else body.rlike("[0-9]")
        matches.append(F.when(may, F.regexp_extract_all(body, F.lit(pattern), F.lit(0))).otherwise(F.array().cast("array<string>")).alias(kind))
        gaps.append(F.when(F.size(F.col(own[1])[kind]) > 0, F.split(body, pattern, -1)).otherwise(F.array().cast("array<string>")).alias(kind))
    found = [F.when(F.size(F.col(own[1])[k]) > 0, _spans(k, F.col(own[1])[k], F.col(own[2])[k])) for k in KINDS]
    kind_of = "array<struct<start:int,rank:int,end:int,kind:string,match:string,score:double>>"
    all_ = F.concat(*[F.coalesce(x.cast(kind_of), F.array().cast(kind_of)) for x in found])
    kept = F.filter(all_, lambda s: (s["rank"] < len(BASE)) | (s["score"] >= MIN_SCORE))
    df = df.withColumn(own[0], F.coalesce(F.col(text), F.lit(""))).withColumn(own[1], F.struct(*matches)).withColumn(own[2], F.struct(*gaps))
    return df.withColumn(out, F.array_sort(kept)).drop(*own)


def find(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: the key and spans, array of (start, rank, end, kind, match, score) by start, then kind."""
    return _with_spans(df.select(F.col(key).alias(key), F.col(text).alias("_body")), "_body", "spans").select(key, "spans")


def redact(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with every span of ``text`` replaced by its kind in brackets, of overlapping spans the first
    (the rest of the others goes with it); null text stays null; other columns stay as they are, whatever
    their names. The text is cut into pieces of PIECE code points once, so that each span reads only those
    around it."""
    name = unused(df, "_spans")
    spans, body = F.col(name), F.col(text)

    def part(pieces: Column, start: Column, end: Column) -> Column:
        first = F.floor(start / PIECE).cast("int")
        some = F.array_join(F.slice(pieces, first + 1, F.floor((end - 1) / PIECE).cast("int") - first + 1), "")
        return F.when(end > start, F.substring(some, start - first * PIECE + 1, end - start)).otherwise("")

    ends = F.transform(spans, lambda s: s["end"])
    reached = before(ends, lambda a, x: F.greatest(a, x), F.lit(0))  # by the spans before each
    steps = F.filter(F.zip_with(spans, reached, lambda s, at: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), at.alias("at"))), lambda s: s["start"] >= s["at"])
    shown = lambda p: F.transform(steps, lambda s: F.concat(part(p, s["at"], s["start"]), F.lit("["), F.upper(s["kind"]), F.lit("]")))
    pieces = F.regexp_extract_all(body, F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0))
    clean = let(pieces, lambda p: F.concat(F.array_join(shown(p), ""), part(p, F.array_max(ends), F.length(body))))
    out = _with_spans(df, text, name)
    return out.withColumn(text, F.when(F.size(spans) > 0, clean).otherwise(body)).select(*[F.col(f"`{c}`") for c in df.columns])


def digest(found: DataFrame, key: str = "doc_id") -> DataFrame:
    """Counts of the base kinds, the hash of their places, and all spans as text."""
    place = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    base = F.filter("spans", lambda s: s["rank"] < len(BASE))
    of = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    joined = lambda a: F.array_join(F.transform(a, place), ",")
    return found.select(key, *[of(k) for k in BASE], F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))

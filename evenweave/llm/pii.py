"""Personal data: expressions propose spans, checksums confirm them, words nearby adjust their score.

Built from DataFrame functions only. Kinds and their base rules (leftmost, non-overlapping per kind; offsets in
code points, end exclusive; a match that fails its validator is dropped and not tried again):

    email  [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+
    ip     four dotted numbers, each at most 255
    card   digits with single spaces or hyphens between, 14 to 19 digits, Luhn
    phone  + and digits with spaces, dots, brackets, hyphens, 10 to 15 digits
    iban   two letters, two digits, then groups of four or 11 to 30 letters or digits, mod-97; of groups the most that pass
    ssn    ddd-dd-dddd in valid ranges
    secret 20 or more characters of a key or token in one run, at least ``LEAST_ENTROPY`` bits a character

Every span has a score: a start value by kind, plus the gain of a checksum or of entropy, plus a gain for words that go
with the kind within ``CONTEXT`` code points before it. Spans of the four base kinds stay whatever their score; the
others need ``THRESHOLD``, so a secret needs a word such as "token" before it.

Null or empty texts have no spans. The expressions are possessive and anchored at the start of their run, so
that a long run of digits or letters costs linear time and no stack.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evenweave.functions.columns import let
from evenweave.llm.common import id_and_text

CONTEXT = 40
THRESHOLD = 0.5
BASE_KINDS = ["email", "ip", "card", "phone"]
KINDS = [*BASE_KINDS, "iban", "ssn", "secret"]
LEAST_ENTROPY = 3.1

_LOCAL = "[A-Za-z0-9._%+-]"
# A match starts at the first character of its run, or where the match before it ended.
PATTERNS = {
    "email": rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++(?:\.[0-9]++)(?:\.[0-9]++)(?:\.[0-9]++)",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9](?:[\x20().-]*+[0-9])++",
    "iban": r"\b[A-Z]{2}[0-9]{2}(?:(?:\x20[A-Z0-9]{4}){2,7}(?:\x20[A-Z0-9]{1,3})?|[A-Z0-9]{11,30})\b",
    "ssn": r"\b[0-9]{3}-[0-9]{2}-[0-9]{4}\b",
    "secret": r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}+={0,2}",
}
# What a text must hold for the expression to be worth trying.
NEEDS = {"email": "@", "ip": ".", "card": None, "phone": "+", "iban": None, "ssn": "-", "secret": None}
START = {"email": 0.8, "ip": 0.6, "card": 0.4, "phone": 0.6, "iban": 0.4, "ssn": 0.3, "secret": 0.1}
CHECKSUM_GAIN = {"card": 0.4, "iban": 0.5, "secret": 0.2}
CONTEXT_GAIN = 0.3
CONTEXT_WORDS = {
    "email": ["mail", "contact", "write to"],
    "ip": ["ip", "address", "host", "server"],
    "card": ["card", "visa", "credit", "payment", "karte", "tarjeta", "carte"],
    "phone": ["phone", "call", "tel", "mobile", "fax"],
    "iban": ["iban", "account", "bank", "konto", "cuenta", "compte"],
    "ssn": ["ssn", "social security", "tax id"],
    "secret": ["token", "secret", "password", "passwd", "api key", "api_key", "apikey", "access key", "bearer", "credential"],
}


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    def doubled(c: Column, i: Column) -> Column:
        d = c.cast("int")
        twice = F.when(d > 4, d * 2 - 9).otherwise(d * 2)
        return F.when(i % 2 == 1, twice).otherwise(d)

    each = F.transform(F.split(F.reverse(digits), ""), doubled)
    return F.aggregate(each, F.lit(0), lambda a, x: a + F.coalesce(x, F.lit(0))) % 10 == 0


def mod_97(iban: Column) -> Column:
    """Whether an IBAN without spaces has remainder 1."""
    turned = F.concat(F.substr(iban, F.lit(5)), F.substr(iban, F.lit(1), F.lit(4)))

    def step(a: Column, c: Column) -> Column:
        code = F.ascii(c)
        return F.when(code < 58, a * 10 + code - 48).otherwise(a * 100 + code - 55) % 97

    return F.aggregate(F.split(turned, ""), F.lit(0), lambda a, c: F.when(c == "", a).otherwise(step(a, c))) == 1


def _only_digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def entropy_bits(text: Column) -> Column:
    """Entropy of a text's characters in bits."""
    n = F.length(text)

    def part(c: Column) -> Column:
        share = (n - F.length(F.replace(text, c, F.lit("")))) / n
        return -share * F.log2(share)

    return F.aggregate(F.array_distinct(F.split(text, "")), F.lit(0.0), lambda a, c: F.when(c == "", a).otherwise(a + part(c)))


def _valid_length(kind: str, match: Column) -> Column:
    """Code points of a match that its validator confirms; null if none."""
    if kind != "iban":
        return F.when(_valid(kind, match), F.length(match))

    def longest(groups: Column) -> Column:
        ends = F.sequence(F.size(groups), F.least(F.size(groups), F.lit(3)), F.lit(-1))
        texts = F.transform(ends, lambda k: F.array_join(F.slice(groups, 1, k), " "))
        return F.length(F.try_element_at(F.filter(texts, lambda t: _valid(kind, t)), F.lit(1)))

    return let(F.split(match, " "), longest)


def _valid(kind: str, match: Column) -> Column:
    if kind == "ip":
        return F.forall(F.split(match, r"\."), lambda p: F.length(F.ltrim(p, F.lit("0"))) < 4) & F.forall(
            F.split(match, r"\."), lambda p: F.coalesce(p.try_cast("int"), F.lit(0)) <= 255
        )
    if kind == "card":
        return let(_only_digits(match), lambda d: F.when(F.length(d).between(14, 19), luhn(d)).otherwise(False))
    if kind == "phone":
        return F.length(_only_digits(match)).between(10, 15)
    if kind == "secret":
        return match.rlike("[0-9]") & match.rlike("[A-Za-z]") & (entropy_bits(match) >= LEAST_ENTROPY)
    if kind == "iban":
        return mod_97(F.replace(match, F.lit(" "), F.lit("")))
    if kind == "ssn":
        area = F.substr(match, F.lit(1), F.lit(3))
        return ~area.isin("000", "666") & (area < "900") & (F.substr(match, F.lit(5), F.lit(2)) != "00") & (
            F.substr(match, F.lit(8)) != "0000"
        )
    return F.lit(True)


def _score(kind: str, text: Column, start: Column) -> Column:
    context_start = F.greatest(start - CONTEXT, F.lit(0))
    nearby = F.lower(F.substr(text, context_start + 1, start - context_start))
    gain = F.when(nearby.rlike(rf"\b({'|'.join(CONTEXT_WORDS[kind])})\b"), CONTEXT_GAIN).otherwise(0.0)
    return F.lit(START[kind] + CHECKSUM_GAIN.get(kind, 0.0)) + gain


_SPAN = "array<struct<start:int,ord:int,end:int,kind:string,score:double>>"


def kind_spans(kind: str, text: Column) -> Column:
    """Valid spans of one kind in order. The stretches between matches give the offsets."""
    matches = F.regexp_extract_all(text, F.lit(PATTERNS[kind]), F.lit(0))
    none = F.array().cast(_SPAN)

    def located(found: Column) -> Column:
        steps = F.arrays_zip(F.split(text, PATTERNS[kind], -1).alias("gap"), found.alias("match"))
        start = F.struct(F.lit(0).alias("pos"), none.alias("spans"))

        def step(acc: Column, x: Column) -> Column:
            begin = acc["pos"] + F.length(x["gap"])
            end = begin + F.coalesce(F.length(x["match"]), F.lit(0))

            def noted(length: Column) -> Column:
                span = F.struct(
                    begin.alias("start"), F.lit(KINDS.index(kind)).alias("ord"), (begin + length).alias("end"),
                    F.lit(kind).alias("kind"), _score(kind, text, begin).alias("score"),
                )
                spans = F.when(length.isNotNull(), F.concat(acc["spans"], F.array(span))).otherwise(acc["spans"])
                return F.struct(end.alias("pos"), spans.alias("spans"))

            return let(F.when(x["match"].isNotNull(), _valid_length(kind, x["match"])), noted)

        return F.aggregate(steps, start, step, lambda acc: acc["spans"])

    found = let(matches, lambda m: F.when(F.size(m) > 0, located(m)).otherwise(none))
    if kind not in BASE_KINDS:
        found = F.filter(found, lambda s: s["score"] >= THRESHOLD)
    return F.when(F.contains(text, F.lit(NEEDS[kind])), found).otherwise(none) if NEEDS[kind] else found


def find_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text, spans (start, ord, end, kind, score), sorted by start, then kind as listed."""
    base = id_and_text(docs, id_col, text_col)
    return base.withColumn("spans", spans_of(F.col("text")))


def spans_of(text: Column) -> Column:
    return F.array_sort(F.concat(*(kind_spans(k, text) for k in KINDS)))


def redact(text: Column, spans: Column) -> Column:
    """The text with every span, overlapping ones together, replaced by the name of its kind in brackets."""
    start = F.struct(F.lit(0).alias("pos"), F.array().cast("array<string>").alias("parts"))

    def step(acc: Column, s: Column) -> Column:
        fresh = s["start"] >= acc["pos"]
        part = F.concat(F.substr(text, acc["pos"] + 1, s["start"] - acc["pos"]), F.lit("["), F.upper(s["kind"]), F.lit("]"))
        return F.struct(
            F.greatest(acc["pos"], s["end"]).alias("pos"),
            F.when(fresh, F.concat(acc["parts"], F.array(part))).otherwise(acc["parts"]).alias("parts"),
        )

    def finish(acc: Column) -> Column:
        return F.concat(F.array_join(acc["parts"], ""), F.substr(text, acc["pos"] + 1))

    return F.when(F.size(spans) > 0, F.aggregate(spans, start, step, finish)).otherwise(text)


def _joined(spans: Column) -> Column:
    one = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.transform(spans, one), ",")


def digest(found: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans."""
    spans = F.col("spans")
    base = F.filter(spans, lambda s: s["ord"] < len(BASE_KINDS))
    count = lambda k: F.size(F.filter(spans, lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    return found.select(
        "doc_id", *(count(k) for k in BASE_KINDS), F.sha2(_joined(base), 256).alias("base_sha256"),
        _joined(spans).alias("spans"),
    )


def redacted_documents(docs: DataFrame, text_col: str = "text", length_col: str = "n_chars") -> DataFrame:
    """All rows and columns as they are, but for the text, redacted, and its length. A null text stays null."""
    text = F.col(text_col).cast("string")
    clean = F.when(text.isNotNull(), let(F.coalesce(text, F.lit("")), lambda t: redact(t, spans_of(t))))
    out = docs.withColumn(text_col, clean)
    return out.withColumn(length_col, F.length(text_col).cast(docs.schema[length_col].dataType)) if length_col in docs.columns else out

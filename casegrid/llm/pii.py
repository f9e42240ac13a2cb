"""Personal data, found with DataFrame functions alone.

Regular expressions propose spans; validators confirm them: Luhn for card
numbers, mod-97 for bank accounts (IBAN), digit counts for phone numbers, parts
of at most 255 for IP addresses, length and entropy for credentials (a value
that is assigned to a key, token, secret or password).  Words near a span raise
or lower its score.

Texts of any length are searched without recursion, and in time in proportion
to their length: the patterns that Spark runs are possessive and start only
where a run of their signs starts.  The words near a span are looked up in the
text, which takes time in proportion to spans times length.

Spark has no function for the positions of matches.  ``spans_of`` gets them
from the matches and from the pieces between: the n-th match starts after the
first n pieces and n - 1 matches.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casegrid.llm.common import keyed

#: The base patterns, in the order in which kinds are listed.
EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+"
IP = r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)"
CARD_RUN = r"[0-9][\x20\x2d0-9]*[0-9]"
CARD_BREAK = r"[\x20\x2d]{2,}"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
IBAN = r"[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}"
CREDENTIAL_VALUE = r"[A-Za-z0-9+/_-]{16,}={0,2}"
CREDENTIAL = (r"(?i:key|secret|token|password|passwd|credential)[\x22\x27]?\x20{0,3}[:=]\x20{0,3}[\x22\x27]?"
              + CREDENTIAL_VALUE)
KINDS = ("email", "ip", "card", "phone", "iban", "credential")
#: The same matches as ``EMAIL`` and ``IP``.  A match starts where a run of its
#: first signs starts, or where the match before ended inside that run.
EMAIL_SAFE = (r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
IP_SAFE = r"(?<![0-9])[0-9]++(?:\.[0-9]++)(?:\.[0-9]++)(?:\.[0-9]++)"
IP_SIGNS = r"[0-9]\.[0-9]++\.[0-9]++\.[0-9]"
#: Bits per sign that a credential's value has at least.
ENTROPY = 3.0
#: Words before a span that speak for its kind, or against any.
CONTEXT = {
    "email": "mail|contact|write|reach",
    "ip": "host|server|address|login|ip",
    "card": "card|visa|credit|payment|pay",
    "phone": "phone|call|tel|mobile|fax",
    "iban": "iban|bank|account|transfer",
    "credential": "key|secret|token|password|passwd|credential",
}
AGAINST = "example|sample|dummy|test|version|isbn|order"
CONTEXT_CHARS = 40
#: What may stand before a context word; the against words also end there.
EDGE = "(?:^|[^a-z0-9])"
PRIOR = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.7, "iban": 0.9, "credential": 0.8}
STEP_UP, STEP_DOWN = 0.1, 0.2


_SPANS = "array<struct<start:int,stop:int,match:string>>"
#: Spans are added up in blocks: a list that grows one by one is copied each time.
BLOCK = 512


def _placed(parts: Column) -> Column:
    """Spans of the parts ``(before, m, after)`` of a text in turn: ``m`` lies
    after ``before`` code points and is followed by ``after``; a null ``m`` is
    no span."""
    none = F.array().cast(_SPANS)

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + x["before"]
        stop = start + F.coalesce(F.length(x["m"]), F.lit(0))
        span = F.struct(start.alias("start"), stop.alias("stop"), x["m"].alias("match"))
        return F.struct((stop + x["after"]).alias("at"),
                        F.when(x["m"].isNull(), acc["out"]).otherwise(F.concat(acc["out"], F.array(span))).alias("out"))

    def joined(acc: Column, block: Column) -> Column:
        moved = F.transform(block["out"], lambda x: F.struct(
            (x["start"] + acc["at"]).alias("start"), (x["stop"] + acc["at"]).alias("stop"), x["match"].alias("match")))
        return F.struct((acc["at"] + block["at"]).alias("at"), F.concat(acc["out"], moved).alias("out"))

    zero = F.struct(F.lit(0).alias("at"), none.alias("out"))
    blocks = F.transform(F.array(parts), lambda p: F.transform(  # the array binds p, so that it is evaluated once
        F.sequence(F.lit(0), F.floor((F.size(p) - 1) / BLOCK).cast("int")),
        lambda b: F.aggregate(F.slice(p, b * BLOCK + 1, F.lit(BLOCK)), zero, step)))[0]
    return F.aggregate(blocks, zero, joined)["out"]


def spans_of(text: Column, pattern: str) -> Column:
    """``array<struct<start, stop, match>>`` of the leftmost matches that do
    not overlap, in code points; ``stop`` is exclusive."""
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pieces = F.split(text, pattern, -1)
    return _placed(F.transform(F.arrays_zip(pieces.alias("p"), matches.alias("m")), lambda x: F.struct(
        F.length(x["p"]).alias("before"), x["m"].alias("m"), F.lit(0).alias("after"))))


def digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def mod97(match: Column) -> Column:
    """Remainder of an account number: its first four signs moved to the end,
    letters as 10 to 35."""
    plain = F.regexp_replace(match, " ", "")
    moved = F.split(F.concat(F.substring(plain, F.lit(5), F.length(plain)), F.substring(plain, 1, 4)), "")
    return F.aggregate(
        F.filter(moved, lambda c: c != ""), F.lit(0),
        lambda r, c: F.when(c.between("0", "9"), (r * 10 + F.ascii(c) - 48) % 97)
        .otherwise((r * 100 + F.ascii(c) - 55) % 97))


def entropy(value: Column) -> Column:
    """Bits per sign, from how often each sign occurs."""
    signs = F.filter(F.split(value, ""), lambda c: c != "")
    n = F.length(value).cast("double")
    return F.aggregate(F.array_distinct(signs), F.lit(0.0), lambda acc, c: acc + F.transform(
        F.array((n - F.length(F.replace(value, c, F.lit("")))) / n), lambda p: -p * F.log2(p))[0])


def confirmed(kind: str, match: Column, before: Column, after: Column) -> Column:
    """Whether a match is valid; ``before`` and ``after`` are the signs beside
    it (empty at either end of the text)."""
    if kind == "ip":
        def small(x: Column) -> Column:
            value = F.regexp_replace(x, "^0+", "")
            return (F.length(value) <= 3) & (F.coalesce(value.try_cast("int"), F.lit(0)) <= 255)

        return F.forall(F.split(match, r"\."), small)
    if kind == "card":
        return F.length(digits(match)).between(12, 19) & F.call_function("luhn_check", digits(match))
    if kind == "phone":
        return F.length(digits(match)).between(9, 15)
    if kind == "iban":
        free = ~before.rlike("[A-Za-z0-9]") & ~after.rlike("[A-Za-z0-9]")
        return free & F.length(F.regexp_replace(match, " ", "")).between(15, 34) & (mod97(match) == 1)
    if kind == "credential":
        value = F.regexp_extract(match, CREDENTIAL_VALUE + "$", 0)
        mixed = value.rlike("[0-9]") & value.rlike("[A-Za-z]")
        return ~before.rlike("[A-Za-z0-9]") & mixed & (entropy(value) >= ENTROPY)
    return F.lit(True)


def proposals(text: Column, kind: str) -> Column:
    """Spans that the kind's pattern proposes; texts without the signs that a
    match needs are not searched."""
    none = F.array().cast(_SPANS)
    if kind == "email":
        return F.when(F.contains(text, F.lit("@")), spans_of(text, EMAIL_SAFE)).otherwise(none)
    if kind == "ip":
        return F.when(text.rlike(IP_SIGNS), spans_of(text, IP_SAFE)).otherwise(none)
    if kind == "credential":
        return F.when(text.rlike(CREDENTIAL), spans_of(text, CREDENTIAL)).otherwise(none)
    if kind == "phone":
        return F.when(text.rlike(r"\+[0-9]"), spans_of(text, PHONE)).otherwise(none)
    if kind == "iban":
        return F.when(text.rlike(IBAN), spans_of(text, IBAN)).otherwise(none)
    # card: runs of digits and separators, cut where two separators meet;
    # plain character classes, so a run of any length needs no recursion
    runs = F.filter(spans_of(text, CARD_RUN), lambda x: x["stop"] - x["start"] >= 12)
    parts = F.flatten(F.transform(runs, lambda x: F.transform(
        _between(x["match"], CARD_BREAK), lambda y: F.struct(
            (x["start"] + y["start"]).alias("start"), (x["start"] + y["stop"]).alias("stop"),
            y["match"].alias("match")))))
    return F.when(text.rlike(r"[0-9](?:[\x20\x2d]?[0-9]){11}"), parts).otherwise(none)


def _between(text: Column, pattern: str) -> Column:
    """The pieces of a text between matches, with their places."""
    gaps = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    return _placed(F.transform(F.arrays_zip(F.split(text, pattern, -1).alias("p"), gaps.alias("g")), lambda x: F.struct(
        F.lit(0).alias("before"), x["p"].alias("m"), F.coalesce(F.length(x["g"]), F.lit(0)).alias("after"))))


def find_pii(docs: DataFrame) -> DataFrame:
    """``(id, digest, text, spans)`` per row; ``spans`` is an array of
    ``(start, kind_no, stop, kind, match, score)`` by start and kind.

    Defined cases: a null text counts as empty and has no spans; very long
    texts are searched whole; spans of different kinds may overlap; a
    credential's span is its value alone; a match that its validator rejects is
    dropped and its characters are not searched again; rows that repeat give
    equal rows; an empty table gives no rows.
    """
    rows = keyed(docs).select("id", "digest", F.coalesce(F.col("row.text").cast("string"), F.lit("")).alias("text"))
    proposed = rows.select("id", "digest", "text", *[proposals(F.col("text"), k).alias(k) for k in KINDS])

    def beside(x: Column) -> tuple[Column, Column]:
        before = F.when(x["start"] > 0, F.substring(F.col("text"), x["start"], F.lit(1))).otherwise("")
        return before, F.substring(F.col("text"), x["stop"] + 1, F.lit(1))

    def sure(n: int, kind: str) -> Column:
        def named(x: Column) -> Column:
            match = F.regexp_extract(x["match"], CREDENTIAL_VALUE + "$", 0) if kind == "credential" else x["match"]
            return F.struct((x["stop"] - F.length(match)).alias("start"), F.lit(n).alias("kind_no"),
                            x["stop"].alias("stop"), F.lit(kind).alias("kind"), match.alias("match"))

        return F.transform(F.filter(kind, lambda x: confirmed(kind, x["match"], *beside(x))), named)

    found = proposed.select("id", "digest", "text", F.flatten(F.array(*[sure(n, k) for n, k in enumerate(KINDS)])).alias("found"))

    def scored(x: Column) -> Column:
        low = F.greatest(x["start"] - CONTEXT_CHARS, F.lit(0))
        near = F.lower(F.substring(F.col("text"), low + 1, x["start"] - low))
        score = sum((F.when(x["kind"] == k, F.lit(PRIOR[k]) + F.when(
            near.rlike(f"{EDGE}(?:{CONTEXT[k]})"), STEP_UP).otherwise(0.0)).otherwise(0.0) for k in KINDS), F.lit(0.0))
        score = score - F.when(near.rlike(f"{EDGE}(?:{AGAINST})(?:$|[^a-z0-9])"), STEP_DOWN).otherwise(0.0)
        return F.struct(x["start"], x["kind_no"], x["stop"], x["kind"], x["match"], F.round(score, 2).alias("score"))

    return found.select("id", "digest", "text",
                        F.array_sort(F.transform("found", scored)).alias("spans"))


def span_text(spans: Column) -> Column:
    """``kind:start:stop``, joined by commas in the order given."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(
        ":", x["kind"], x["start"].cast("string"), x["stop"].cast("string"))), ",")


def masked(found: DataFrame) -> DataFrame:
    """``(id, digest, text)`` with every span replaced by its kind in angle
    brackets; of spans that overlap the first one counts."""
    acc = F.aggregate(
        "spans", F.struct(F.lit(0).alias("at"), F.lit("").alias("out")),
        lambda a, x: F.when(x["start"] < a["at"], a).otherwise(F.struct(
            x["stop"].alias("at"),
            F.concat(a["out"], F.substring(F.col("text"), a["at"] + 1, x["start"] - a["at"]),
                     F.lit("<"), x["kind"], F.lit(">")).alias("out"))))
    return found.select("id", "digest", acc.alias("a"), "text").select(
        "id", "digest", F.concat("a.out", F.substring("text", F.col("a.at") + 1, F.length("text"))).alias("text"))

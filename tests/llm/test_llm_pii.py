import hashlib
import re

import pytest

from casegrid.llm import pii as P

#: The base patterns as the task states them.
BASE = [("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
        ("card", r"[0-9]([\x20-]?[0-9])+"),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]")]
ODD = ["", None, "a@b.c..d@e.f x@y", "1.2.3.4.5.6.7.8 999.1.1.1 0000001.2.3.255 1.2.3.256",
       "4111 1111 1111 1111  4111-1111-1111-1111 4111  1111", "\U0001F600é 4111111111111111 +1 (555) 123-4567 +12 3",
       "1 " * 3000 + "4111111111111111", "7" * 20000, "++1 2345678 9", "1.2.3.4\n+1 2 3 4 5 6 7 8 9 a.b@c.d.e-f",
       "é" * 10 + "a@b.co,x@y.zz", "12345678901234567890123", "0.0.0.0", "1-2-3-4-5-6-7-8-9-0-1-2-3-4-5-6",
       "+1-23456789-", "99999999999999999999.1.1.1", "4111 1111 1111 1111" * 2, "+123456789 +1234567890123456", "1.2.3.4@x.yz", "a+1 555 123 4567@b.c 1.1.1.1",
       "a@b.c_d@e.f.g-h@i.j", "a@b@c.d.", "x.y@z.w.v@u.t", "@a.b c@.d e@f. g@h", "1.2.3.4.5 11.22.33.44.5.6.7.8"]


def luhn(text):
    total = 0
    for k, c in enumerate(reversed(text)):
        d = int(c) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def base_spans(text):
    out = []
    for n, (kind, pattern) in enumerate(BASE):
        for m in re.finditer(pattern, text or ""):
            d = re.sub("[^0-9]", "", m.group())
            if kind == "ip" and any(int(x) > 255 for x in m.group().split(".")) or kind == "card" and not (
                    12 <= len(d) <= 19 and luhn(d)) or kind == "phone" and not 9 <= len(d) <= 15:
                continue
            out.append((m.start(), n, kind, m.end()))
    return [f"{k}:{s}:{e}" for s, _, k, e in sorted(out)]


def spans(row):
    return [f"{x['kind']}:{x['start']}:{x['stop']}" for x in row["spans"]]


def test_base_spans_equal_definition(spark, edge_docs, no_docs):
    docs = spark.createDataFrame(list(enumerate(ODD)), "doc_id long, text string")
    for frame in (docs, edge_docs.withColumn("match", edge_docs["id"])):
        rows = P.find_pii(frame).collect()
        assert len(rows) == frame.count()
        for r in rows:
            assert [x for x in spans(r) if not x.startswith(("iban", "cred"))] == base_spans(r["text"])
            for x in r["spans"]:
                assert r["text"][x["start"]:x["stop"]] == x["match"]
    assert P.find_pii(no_docs).count() == 0


@pytest.mark.parametrize("text,want", [
    ("DE89 3704 0044 0532 0130 00", ["iban:0:27"]), ("DE89370400440532013001", []),
    ("xGB82WEST12345698765432", []), ("GB82WEST12345698765432.", ["iban:0:22"])])
def test_account_numbers_need_mod_97(spark, text, want):
    row = P.find_pii(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert [x for x in spans(row) if x.startswith("iban")] == want


@pytest.mark.parametrize("text,want", [
    ('token = "04dbebab91ab85687d33eeaaf9ac699e1188f962" on', ["credential:9:49"]),
    ("API_KEY:AbCd0123456789xyzAB==;", ["credential:8:29"]), ("my Password='c0rrect-h0rse-battery'", ["credential:13:34"]),
    ("monkey = 04dbebab91ab85687d33", []), ("key = abcdefghijklmnopqrst", []), ("key = 01234567890123456789", []),
    ("secret = a1a1a1a1a1a1a1a1a1a1", []), ("token = short1", []), ("token = 04dbebab91ab85687d33.", ["credential:8:28"])])
def test_credentials_need_an_assignment_and_entropy(spark, text, want):
    row = P.find_pii(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert [x for x in spans(row) if x.startswith("cred")] == want


#: One million signs without many spans, and many spans in fewer signs.
LONG = ["a@b" + ".c" * 500_000, "a" * 1_000_000 + " @ x@y.z", "7" * 1_000_000 + " 1.2.3.4", "ab@" * 330_000,
        "12 x " * 200_000, "token=" + "aB3" * 330_000, "a@b.c " * 3_000, "1.2.3." * 3_000 + "\U0001F600"]


def test_very_long_texts(spark):
    """No crash, and no time that grows with the square of a run."""
    docs = spark.createDataFrame(list(enumerate(LONG)), "doc_id long, text string")
    got = {r["id"]: [x for x in spans(r) if not x.startswith(("iban", "cred"))] for r in P.find_pii(docs).collect()}
    assert got.pop(0) == [f"email:0:{len(LONG[0])}"]
    assert got.pop(1) == [f"email:{len(LONG[1]) - 5}:{len(LONG[1])}"]
    assert got.pop(2) == [f"ip:{len(LONG[2]) - 7}:{len(LONG[2])}"]
    assert got.pop(3) == got.pop(4) == got.pop(5) == []
    assert got == {k: base_spans(LONG[k]) for k in got} and len(got) == 2


def test_credentials_of_the_documents(spark):
    """Every assignment of 40 hex digits in the documents is found."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    want = {r["doc_id"]: {f"credential:{m.start(1)}:{m.end(1)}" for m in re.finditer(
        r'(?i)token = "([0-9a-f]{40})"', r["text"] or "")} for r in docs.collect()}
    got = {r["id"]: {x for x in spans(r) if x.startswith("cred")} for r in P.find_pii(docs).collect()}
    assert got == want and sum(map(len, want.values())) > 5


def test_context_moves_the_score(spark):
    near = ["call me: +1 555 123 4567", "+1 555 123 4567", "version +1 555 123 4567"]
    docs = spark.createDataFrame(list(enumerate(near)), "doc_id long, text string")
    score = {r["id"]: r["spans"][0]["score"] for r in P.find_pii(docs).collect()}
    assert score[0] > score[1] > score[2]


def test_masking(spark):
    docs = spark.createDataFrame([(1, "mail a@b.co now"), (2, ""), (3, "é 1.2.3.4")], "doc_id long, text string")
    assert {r["id"]: r["text"] for r in P.masked(P.find_pii(docs)).collect()} == {
        1: "mail <email> now", 2: "", 3: "é <ip>"}


def test_main_path_runs_no_python(edge_docs):
    plan = P.find_pii(edge_docs)._jdf.queryExecution().optimizedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


def test_query(spark):
    from casegrid.llm.queries import op8_pii
    sf = "/root/testdata/sf0.001"
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    for r in op8_pii(spark, sf).collect():
        want = base_spans(texts[r["doc_id"]])
        assert r["base_sha256"] == hashlib.sha256(",".join(want).encode()).hexdigest()
        for kind in ("email", "ip", "card", "phone"):
            assert r[f"n_{kind}"] == sum(x.startswith(kind + ":") for x in want)
        assert set(want) <= set(r["spans"].split(","))

from __future__ import annotations

import re

from tillstream.llm import secrets_ledger as ledger
from tillstream.llm.queries import read

KEY = "AKIA" + "Q" * 16
HEX = "0123456789abcdef" * 2
TEXT = f"password=token:abcdefgh é {KEY}x API-KEY='short' Secret : \"{HEX}\" {HEX[:23]} AKIAX \U0001F600 token==abcde"


def brute(text):
    text = text or ""
    rules = [("assign", re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A),
              lambda m: len(m[2]) >= 6), ("access", re.compile(r"AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 20),
             ("hex", re.compile(r"[0-9a-f]+"), lambda m: len(m[0]) >= 24)]
    found = [(m.start(), k, kind, m.end()) for k, (kind, p, ok) in enumerate(rules) for m in p.finditer(text) if ok(m)]
    return [(kind, s, e) for s, _, kind, e in sorted(found)]


def spans(row):
    return [(f.kind, f.start, f.end) for f in row.found or []]


def test_spans_equal_brute_force(spark, make_docs, odd_rows):
    rows = [*odd_rows, (20, TEXT), (21, TEXT), (22, f"{HEX}{HEX}\n{KEY}"), (23, "password=" + "a" * 5 + " passwd = 'x.y=z/+'")]
    found, _, _ = ledger.scan(make_docs(rows), "doc_id", ledger.BASE_RULES)
    got = sorted((str(r.row.doc_id), spans(r)) for r in found.collect())
    assert got == sorted((str(d), brute(t)) for d, t in rows)


def test_whole_table_equals_brute_force(spark, sf):
    found, _, _ = ledger.scan(read(spark, sf, "documents"), "doc_id", ledger.BASE_RULES)
    for r in found.collect():
        assert spans(r) == brute(r.row.text)


def test_only_unseen_blobs_and_rules_are_scanned(spark, make_docs):
    first = make_docs([(1, f"x {KEY}"), (2, "nothing here")])
    _, done, findings = ledger.scan(first, "doc_id", ledger.BASE_RULES)
    assert done.count() == 2 * 3 and findings.count() == 1
    second = make_docs([(3, f"x {KEY}"), (4, f"new {HEX}")])
    # A finding of the old scan comes back although its text is not scanned again.
    planted = findings.withColumn("end", findings["end"] - 1)
    found, done, findings = ledger.scan(second, "doc_id", ledger.BASE_RULES, done, planted)
    assert {r.row.doc_id: spans(r) for r in found.collect()} == {3: [("access", 2, 21)], 4: [("hex", 4, 36)]}
    assert done.count() == 9
    newer = (*ledger.BASE_RULES[:1], ledger.Rule("access", r"AKIA[A-Z0-9]+", 20, version=2), *ledger.BASE_RULES[2:])
    found, done, findings = ledger.scan(second, "doc_id", newer, done, findings)
    assert {r.row.doc_id: spans(r) for r in found.collect()}[3] == [("access", 2, 22)]
    assert done.where("version = 2").count() == 2


def test_further_rules_and_masking(spark, make_docs):
    text = f"-----BEGIN RSA PRIVATE KEY----- https://user:pass9@host token={HEX} end"
    found, _, _ = ledger.scan(make_docs([(1, text), (2, None)]), "doc_id")
    kinds = {r.row.doc_id: [f.kind for f in r.found or []] for r in found.collect()}
    assert kinds == {1: ["private_key", "url_login", "assign", "hex"], 2: []}
    shown = found.selectExpr("row.doc_id as doc_id", "row.text as text", "found as spans").withColumn(
        "text", ledger.masked("text", "spans"))
    assert {r.doc_id: r.text for r in shown.collect()} == {1: "[secret] [secret]host [secret] end", 2: None}


def test_empty_table(spark, make_docs):
    found, done, findings = ledger.scan(make_docs([]), "doc_id")
    assert found.count() == done.count() == findings.count() == 0


def test_no_line_of_a_key_is_left(spark, make_docs):
    lines = ["MIIEow" + "aB3+/" * 11 + "xyz", "Q" * 64, "r7" * 32, "Zk9=="]
    body = "\n".join(lines)
    head, end = "-----BEGIN RSA PRIVATE KEY-----", "-----END RSA PRIVATE KEY-----"
    fields = "Proc-Type: 4,ENCRYPTED\nDEK-Info: AES-128-CBC,AB12\n\n"
    big = "\n".join(["mN" * 32] * 20_000)
    keys = [f"{head}\n{body}\n{end}", f"{head}\r\n{fields}{body}\n{end}", f"{head} {' '.join(lines)} {end}", f"{head}\n{body}",
            f"{head}\n{fields}{body}", f"{head}\\n" + "\\n".join(lines), f"{head}\n{big}\n{end}", f"{head}\n{big}"]
    docs = [(i, f"before\n{key}\nplain words after") for i, key in enumerate(keys)]
    two = f"{head} is named first, then\n{head}\n{body}\n{end} and {head}\n{body}\n{end} out"
    login = f"x https://{'u' * 90}:{'p' * 500}@host y"
    found, _, _ = ledger.scan(make_docs([*docs, (50, two), (51, login)]), "doc_id")
    shown = found.selectExpr("row.doc_id as doc_id", "row.text as text", "found as spans").withColumn(
        "text", ledger.masked("text", "spans"))
    got = {r.doc_id: r.text for r in shown.collect()}
    assert {got.pop(50)} == {"[secret] is named first, then\n[secret] and [secret] out"}
    assert got.pop(51) == "x [secret]host y"
    assert set(got.values()) == {"before\n[secret]\nplain words after"}


def test_repeated_rows_are_scanned_once(spark, make_docs, monkeypatch):
    rows, scanned = [(1, f"x {KEY}")] * 1000 + [(None, f"x {KEY}")] * 5 + [(2, TEXT)] * 7, []
    whole = ledger.findings_of
    monkeypatch.setattr(ledger, "findings_of", lambda blobs, rules: scanned.append(blobs.count()) or whole(blobs, rules))
    found, _, findings = ledger.scan(make_docs(rows), "doc_id", ledger.BASE_RULES)
    assert scanned == [2] and findings.count() == 1 + len(brute(TEXT))
    got = sorted((str(r.row.doc_id), spans(r)) for r in found.collect())
    assert got == sorted((str(d), brute(t)) for d, t in rows)

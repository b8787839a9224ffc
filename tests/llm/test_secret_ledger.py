import dataclasses
import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from martwright.llm import secret_ledger as S

BASE = {
    "assign": (r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    "access": ("AKIA[A-Z0-9]+", 0, 20),
    "hex": ("[0-9a-f]+", 0, 24),
}


def brute(text):
    """Matches as the contract words them; a match that fails is dropped, and the search goes on behind it."""
    found = []
    for k, (kind, (pattern, group, least)) in enumerate(BASE.items()):
        for m in re.compile(pattern, re.ASCII).finditer(text or ""):
            if len(m.group(group)) >= least:
                found.append((m.start(), k, kind, m.end()))
    return [(kind, start, end) for start, _, kind, end in sorted(found)]


HARD = [
    None, "", " ", "token = abc", 'Token="abcdef"', "secret=token: abcdef", "token=token=abcdef", "password:  'x.y/z+w=='", "API_KEY=\n123456",
    "apikey:abc_-. api_key==abcdef", "tokentoken:123456", "toKen=123456 paſsword=123456", "é" * 3 + "😀 passwd='ünï' passwd=😀abcdef passwd=abcdef",
    "a" * 23, "a" * 24, "G" + "0f" * 30 + "g" + "0" * 24, "AKIA" + "A" * 15, "AKIA" + "Z9" * 8, "xAKIAAKIA" + "0" * 40 + "a", "AKIA" * 3 + " AKIA" * 9,
    "token=" + "a1" * 20000, "token= \ttoken=abcdef", "secret='" + "f" * 24 + "' " * 300, ",".join(["token=abcdef"] * 500),
]


def fuzzy(g, n):
    bits = ["token", "SECRET", "api_key", "=", ":", " ", '"', "'", "abc", "abcdef", "é", "😀", "\n", "AKIA", "Z" * 16, "0a1b" * 6, "f", "x", "."]
    return ["".join(g.choice(bits) for _ in range(g.randrange(1, 60))) for _ in range(n)]


@pytest.fixture
def ledger(spark, tmp_path):
    return S.Ledger(spark, f"{tmp_path}/ledger")


def test_base_spans_equal_brute_force(documents, ledger):
    texts = HARD + fuzzy(random.Random(6), 300)
    rows = S.find_secrets(documents(dict(enumerate(texts))), ledger, rules=S.BASE_RULES).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert [tuple(f) for f in r.findings] == brute(texts[r.doc_id]), r.text
        assert r.blob == hashlib.sha256((texts[r.doc_id] or "").encode()).hexdigest()


def test_further_formats(documents, ledger):
    found = {
        "key_block": "-----BEGIN RSA PRIVATE KEY-----", "login": "://user:pa55@", "signed": "eyJhbGciOiJI.eyJzdWIiOiIx.c2lnbmF0dXJl",
        "forge": "ghp_" + "a1B2" * 9, "chat": "xoxb-1234567890-abc", "cloud": "AIza" + "x" * 35,
    }
    texts = {k: f"é before {t} after" for k, t in enumerate(found.values())} | {99: "eyJ.a.b ghp_short https://host:8080/path xoxb- AIza-"}
    rows = {r.doc_id: r.findings for r in S.find_secrets(documents(texts), ledger).collect()}
    assert rows.pop(99) == []
    for k, (kind, t) in enumerate(found.items()):
        assert (kind, 9, 9 + len(t)) in [tuple(f) for f in rows[k]]
        assert all(f.kind in (kind, "assign", "access", "hex") for f in rows[k])


def scans(ledger):
    return sorted((bytes(r.blob).hex()[:8], rule) for r in ledger.read().collect() for rule in r.rules)


def test_only_unseen_pairs_are_scanned(documents, ledger):
    """Equal texts, earlier versions and earlier rules are scanned once, and their findings reach all paths."""
    blob = lambda t: hashlib.sha256((t or "").encode()).hexdigest()[:8]
    rules = S.BASE_RULES[:1]
    first = {1: "token=abcdef", 2: "token=abcdef", 3: "clean", 4: None, 5: ""}
    assert [len(r.findings) for r in S.find_secrets(documents(first), ledger, rules=rules).orderBy("doc_id").collect()] == [1, 1, 0, 0, 0]
    one = sorted((blob(t), "assign@1") for t in {"token=abcdef", "clean", ""})
    assert scans(ledger) == one
    second = {**first, 3: "now secret: abcdef", 6: "token=abcdef"}
    rows = {r.doc_id: len(r.findings) for r in S.find_secrets(documents(second), ledger, rules=rules).collect()}
    assert rows == {1: 1, 2: 1, 3: 1, 4: 0, 5: 0, 6: 1}
    two = sorted([*one, (blob("now secret: abcdef"), "assign@1")])
    assert scans(ledger) == two
    changed = (dataclasses.replace(rules[0], least=7, version=2), S.BASE_RULES[2])
    rows = {r.doc_id: len(r.findings) for r in S.find_secrets(documents(second), ledger, rules=changed).collect()}
    assert not any(rows.values())
    seen = {"token=abcdef", "", "now secret: abcdef"}
    assert scans(ledger) == sorted([*two, *((blob(t), n) for t in seen for n in ("assign@2", "hex@1"))])
    again = {r.doc_id: len(r.findings) for r in S.find_secrets(documents(first), ledger, rules=rules).collect()}
    assert again == {1: 1, 2: 1, 3: 0, 4: 0, 5: 0} and len(scans(ledger)) == 10


def test_half_done_and_double_commits(documents, ledger):
    texts = {k: f"token=abcdef{k}" for k in range(20)}
    docs = documents(texts)
    half = docs.filter("doc_id < 9").select(F.unhex(F.sha2("text", 256)).alias("blob"), "text", F.array(F.lit("assign@1")).alias("missing"))
    for _ in range(2):
        ledger.commit(S.scan(half, S.BASE_RULES))
    rows = S.find_secrets(docs, ledger, rules=S.BASE_RULES[:1]).collect()
    assert sorted((r.doc_id, len(r.findings)) for r in rows) == [(k, 1) for k in range(20)]
    assert len(scans(ledger)) == 29
    # The whole rule set scans the blobs of the half for the other rules alone.
    S.find_secrets(docs, ledger, rules=S.BASE_RULES)
    assert sum(rule == "assign@1" for _, rule in scans(ledger)) == 29


def test_hot_blob_clashes_and_empty_table(documents, ledger):
    docs = documents([(k % 7, "token=abcdef") for k in range(300)] + [(None, "x")])
    docs = docs.withColumn("BLOB", F.lit(1)).withColumn("k0", F.col("source")).withColumn("hits", F.lit(2)).withColumn("rules", F.lit(3))
    found = S.find_secrets(docs, ledger)
    assert [c for c in found.columns if c.lower() == "blob"] == ["blob"]
    rows = found.collect()
    assert len(rows) == 301 and sum(len(r.findings) for r in rows) == 300 and all((r.k0, r.hits, r.rules) == ("s", 2, 3) for r in rows)
    assert ledger.read().count() == 2
    assert S.find_secrets(docs.limit(0), ledger).count() == 0
    with pytest.raises(ValueError):
        S.find_secrets(docs, ledger, rules=(*S.RULES, S.RULES[0]))


def test_plans_are_native(documents, ledger):
    docs = documents({1: "token=abcdef"})
    found = S.find_secrets(docs, ledger)
    blobs = docs.select(F.unhex(F.sha2("text", 256)).alias("blob"), "text", F.array(F.lit("assign@1")).alias("missing"))
    for df in (found, S.scan(blobs, S.RULES)):
        plan = df._jdf.queryExecution().toString()
        assert not any(word in plan for word in ("Python", "Arrow", "Pandas", "CartesianProduct", "NestedLoop"))

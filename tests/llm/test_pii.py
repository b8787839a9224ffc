import re

import pytest
from pyspark.sql import functions as F

from martwright.llm import pii
from martwright.llm.pii import KINDS, base_entities, find_pii, learn_patterns, redact, spans_text

PATTERNS = (
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    r"[0-9]([\x20-]?[0-9])+",
    r"\+[0-9][\x20().0-9-]+[0-9]",
)


def luhn(digits):
    d = [int(c) for c in digits][::-1]
    return (sum(d[::2]) + sum(sum(divmod(2 * x, 10)) for x in d[1::2])) % 10 == 0


def brute_force(text):
    out = []
    for k, pattern in enumerate(PATTERNS):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            if (
                k == 0
                or (k == 1 and all(int(p) <= 255 for p in m[0].split(".")))
                or (k == 2 and 16 <= len(digits) <= 19 and luhn(digits))
                or (k == 3 and 8 <= len(digits) <= 15)
            ):
                out.append((k, m.start(), m.end()))
    return out


HARD = [
    "", "@", "a@b", "a@b.c", "a@b.c@d.e", "x@y@z.com", "a@b.c+d@e.f", "..@-.-", "é1.2.3.4é", "1.2.3.4.5.6.7.8.9", "1.2.3.256 1.2.3.255",
    "001.02.3.0", "0000000001.2.3.4", "1..2.3.4.5", "4111111111111111", "4111 1111-1111 1111", "4111  1111 1111 1111", "41111111111111111111",
    "4111111111111112", "+4111 1111 1111 1111", "+1 (555) 555-0100", "+1", "+12", "+1 2", "+1234567", "+12345678", "++1 234 567 89 0.", "+1.2.3.4.5.6.7.8)",
    "mail:jo@x.de, tel:+49 30 1234567.", "1" * 400 + ".2.3.4", "9 " * 300, "a" * 500 + "@" + "b" * 500 + ".c", "१२३.४.५.६ ١@x.y", "+1234567890123456",
]


@pytest.mark.parametrize("text", HARD)
def test_base_entities(text):
    good, bad = base_entities(text)
    assert sorted(good) == sorted(brute_force(text))
    assert not set(good) & set(bad)


def test_joined_hard_texts():
    for glue in ("", " ", ".", "-", "+", "@"):
        text = glue.join(HARD)
        assert sorted(base_entities(text)[0]) == sorted(brute_force(text))


def mails(n):
    return {k: f"Please write to user{k}@mail{k}.example.com soon. Nothing else {k} here." for k in range(n)}


def test_bootstrapping_finds_what_stands_in_the_same_place(documents):
    texts = {**mails(12), 100: "Please write to jo(at)site7 soon.", 101: "A note on jo(at)site7 only.", 102: "Give 77 to them"}
    docs = documents(texts)
    accepted = {r.pattern: r.kind for r in learn_patterns(docs).collect()}
    assert accepted.get("write to") == "email"
    rows = {r.doc_id: r for r in find_pii(docs).collect()}
    text = texts[100]
    assert [(s.kind, text[s.start : s.end]) for s in rows[100].added_spans] == [("email", "jo(at)site7")]
    assert not rows[101].added_spans and not rows[3].added_spans
    assert all(len(rows[k].base_spans) == 1 for k in range(12))


def test_patterns_of_mixed_followers_are_not_accepted(documents):
    texts = {**mails(12), **{200 + k: f"Please write to box-{k} now" for k in range(12)}}
    assert "write to" not in {r.pattern for r in learn_patterns(documents(texts)).collect()}


def chained():
    """Addresses behind one context, unlisted forms behind it and a second, others behind the second and a third."""
    texts = {k: f"Please write to user{k}@mail{k}.example.com soon" for k in range(40)}
    texts |= {100 + k: f"please write to jo(at)site{k} soon" for k in range(6)}
    texts |= {200 + k: f"they ping on jo(at)site{k} often" for k in range(6)} | {210: "they ping on zed(at)nowhere9 often"}
    return texts


def test_discovered_instances_seed_further_patterns(documents):
    texts = chained()
    rows = {r.doc_id: r for r in find_pii(documents(texts)).collect()}
    for k in [*range(100, 106), *range(200, 206), 210]:
        assert [(s.kind, texts[k][s.start : s.end]) for s in rows[k].added_spans] == [("email", texts[k].split()[-2])]


def test_discoveries_do_not_drift_to_mixed_followers(documents):
    texts = chained() | {300 + k: f"items numbered from jo(at)site{k} up" for k in range(6)}
    texts |= {400 + k: f"items numbered from {k}th up" for k in range(20)}
    rows = {r.doc_id: r for r in find_pii(documents(texts)).collect()}
    assert not any(rows[k].added_spans for k in range(400, 420))
    assert "numbered from" not in {r.pattern for r in learn_patterns(documents(texts)).collect()}


def plain_confidences(texts):
    """(pattern, kind) -> (confidence, seeds, backed) by loops over sets."""
    seeds, others, members = {}, set(), {}
    for text in texts:
        good, bad = base_entities(text)
        places = [(KINDS[k], a, b) for k, a, b in good] + [("", a, b) for _, a, b in bad]
        places += [(None, a, b) for a, b in pii._identifiers(text, good + bad)]
        for kind, a, b in places:
            for p in filter(None, pii._patterns(text, a)):
                name = text[a:b].lower()
                members.setdefault(p, set()).add(name)
                if kind:
                    seeds.setdefault((p, kind), set()).add(name)
                elif kind is None:
                    others.add((p, name))
    family = lambda p: p.split(" ")[-1]
    of = {}
    for p, name in others:
        of.setdefault(name, set()).add(family(p))
    score = {(p, k): len(s) / (len(members[p]) + 1) for (p, k), s in seeds.items()}
    while True:
        own = {}
        for p, name in others:
            for kind in KINDS:
                key = name, kind, family(p)
                own[key] = max(own.get(key, 0.0), score.get((p, kind), 0.0))
        after, backed = {}, {}
        for p in members:
            for kind in KINDS:
                worth = [
                    sum(own[n, kind, f] for f in of[n] if f != family(p)) / (len(of[n]) - 1)
                    for q, n in others
                    if q == p and len(of[n]) > 1
                ]
                after[p, kind] = (len(seeds.get((p, kind), ())) + sum(worth)) / (len(members[p]) + 1)
                backed[p, kind] = sum(w >= pii.BACKED for w in worth)
        done = all(after[key] <= score.get(key, 0.0) + pii.LEAST_GAIN for key in after)
        score = after
        if done:
            return {key: (score[key], len(seeds.get(key, ())), backed[key]) for key in score}


def test_confidences_equal_plain_loop(documents):
    texts = list(chained().values()) + [f"host at 10.0.0.{k} or host at box{k % 3}" for k in range(9)] + ["jump to box1 or box2"]
    want = {
        key: v for key, v in plain_confidences(texts).items() if v[0] >= pii.CONFIDENCE and v[1] + v[2] >= pii.LEAST_SEEDS
    }
    got = {(r.pattern, r.kind): (r.confidence, r.seeds, r.backed) for r in learn_patterns(documents(dict(enumerate(texts)))).collect()}
    assert {("ping on", "email"), ("write to", "email")} <= set(got) == set(want)
    assert all(got[key] == pytest.approx(want[key]) for key in want)


def test_rejected_matches_are_never_added(documents):
    texts = {k: f"card no 4111 1111 1111 {1111 + 0 * k} a{k}" for k in range(3)}
    texts |= {10 + k: f"host is 10.0.{k}.1 ok" for k in range(12)} | {50: "host is 10.0.0.999 ok"}
    rows = {r.doc_id: r for r in find_pii(documents(texts)).collect()}
    assert not rows[50].base_spans and not rows[50].added_spans


def test_hard_rows_clashing_columns_and_blocks(documents):
    texts = [(k, t) for k, t in enumerate(HARD)] + [(500, None), (0, HARD[20]), (None, HARD[20])] + list(mails(12).items())
    docs = documents(texts).withColumn("BASE_SPANS", F.lit(1)).withColumn("state", F.lit("s"))
    for block in (1000, 1):
        found = find_pii(docs, block=block)
        assert "BASE_SPANS" not in found.columns and "state" in found.columns
        rows = found.select("doc_id", "text", spans_text(F.col("base_spans")).alias("s")).collect()
        assert len(rows) == len(texts)
        for r in rows:
            assert r.s == ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in sorted(brute_force(r.text or "")))
    assert find_pii(docs.limit(0)).count() == 0


def test_redact(documents):
    docs = documents({1: "é mail a@b.de, ip 1.2.3.4", 2: None, 3: "none", 4: "+4111 1111 1111 1111"})
    got = {r.doc_id: r.text for r in redact(docs).collect()}
    assert got == {1: "é mail <email>, ip <ip>", 2: None, 3: "none", 4: "+<card>"}
    assert redact(docs).columns == docs.columns

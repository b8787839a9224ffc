import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from martwright.llm.decontaminate import find_contamination, items_digest


def words(text):
    folded = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", folded)


def brute_force(docs, items, window=13):
    windows = {}
    for name, text in items:
        w = words(text)
        if w and name is not None:
            windows.setdefault(str(name), set()).update(tuple(w[i : i + window]) for i in range(max(len(w) - window, 0) + 1))
    out = []
    for key, text in docs:
        w = words(text)
        hit, found = set(), set()
        for name, several in windows.items():
            for one in several:
                for i in range(len(w) - len(one) + 1):
                    if tuple(w[i : i + len(one)]) == one:
                        hit |= set(range(i, i + len(one)))
                        found.add(name)
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((key, len(w), len(hit), len(found), digest, bool(hit) and 20 * len(hit) >= len(w)))
    return out


def text_of(g, n, vocabulary):
    marks = [" ", "  ", ", ", ".\n", "-", " | "]
    return "".join(g.choice(vocabulary) + g.choice(marks) for _ in range(n))


@pytest.mark.parametrize("block", [1 << 20, 300])
def test_equals_brute_force(frame, block):
    g = random.Random(4)
    vocabulary = ["a", "The", "of", "étude", "日本", "x1", "wordy", "longerword", "ÉCOLE", "zz"]
    items = [(k, text_of(g, n, vocabulary)) for k, n in enumerate([1, 2, 5, 12, 13, 14, 20, 40, 60])]
    items += [(3, items[6][1]), (100, None), (101, ""), (102, " .,"), (None, items[7][1]), (10, items[4][1])]
    docs = [(k, text_of(g, g.choice([0, 1, 3, 30, 200]), vocabulary)) for k in range(40)]
    docs += [(50, None), (51, ""), (52, "x " * 3000 + items[8][1] + " y" * 3000), (53, items[7][1]), (53, items[7][1])]
    docs += [(54, (items[5][1] + " ") * 50), (None, items[4][1] + "q")]
    docs = [(k, t, "extra", -1) for k, t in docs]
    found = find_contamination(
        frame("doc_id long, text string, N_HIT string, other int", docs), frame("item_id long, text string", items), block_bytes=block
    )
    assert found.columns == ["doc_id", "text", "other", "n_words", "n_hit", "hit_spans", "hit_items", "contaminated"]
    rows = found.select(
        "doc_id", "n_words", "n_hit", F.size("hit_items"), items_digest(F.col("hit_items")), "contaminated", "hit_spans"
    ).collect()
    order = lambda r: (r[0] is None, r[0] or 0)
    assert sorted([tuple(r)[:6] for r in rows], key=order) == sorted(brute_force([d[:2] for d in docs], items), key=order)
    assert all(sum(s.end_word - s.first_word for s in r.hit_spans) == r.n_hit for r in rows)


def test_rows_without_an_id_hit_as_in_the_sql(spark, frame, documents, tmp_path):
    import duckdb
    from oracle_check import compare

    from martwright.llm.queries import queries
    from martwright.llm.sql import oracle_sql

    long = " ".join(f"word{k}" for k in range(30))
    items = [(None, long), (None, "lone phrase"), (7, long + " more"), (8, "other words"), (9, None)]
    docs = [(1, "a lone phrase here"), (2, long), (3, "other words, lone phrase"), (4, "nothing"), (5, None), (6, "other words")]
    documents(docs).write.parquet(f"{tmp_path}/documents.parquet")
    frame("item_id long, text string", items).write.parquet(f"{tmp_path}/benchmark.parquet")
    db = duckdb.connect()
    for name in ("documents", "benchmark"):
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/{name}.parquet/*.parquet'")
    got = queries()["op2_decontamination"](spark, str(tmp_path))
    assert compare(got, db, oracle_sql()["op2_decontamination"]) is None
    rows = {r.doc_id: (r.n_items, r.contaminated) for r in got.collect()}
    assert rows == {1: (1, True), 2: (2, True), 3: (2, True), 4: (0, False), 5: (0, False), 6: (1, True)}
    blocks = find_contamination(documents(docs), frame("item_id long, text string", items), block_bytes=40, unnamed="U")
    assert {r.doc_id for r in blocks.collect() if r.U} == {1, 2, 3}


def test_empty_tables(frame):
    none = frame("item_id long, text string", [])
    docs = frame("doc_id long, text string", [(1, "a b c"), (2, None)])
    assert [(r.n_words, r.n_hit, r.contaminated) for r in find_contamination(docs, none).collect()] == [(3, 0, False), (0, 0, False)]
    assert find_contamination(docs.limit(0), docs.withColumnRenamed("doc_id", "item_id")).count() == 0

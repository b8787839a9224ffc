"""The pipeline against a brute-force version of its decisions."""

import corpus_pipeline
import pytest
from test_decontaminate import brute_force as contaminated
from test_jaccard_join import brute_force as groups
from test_pii import brute_force as entities

from martwright.llm.textkit import stage

PROSE = {
    "en": "the of and to in that is was for it with as his on be at by had not are but from they which one you were all her she",
    "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er hat dass sie",
}


@pytest.fixture
def folder(spark, frame, tmp_path):
    import random

    g = random.Random(6)
    text = lambda lang, n: " ".join(g.choice(PROSE[lang].split()) + g.choice(["", "", "a", "en"]) for _ in range(n))
    rows = [(k, text("en" if k % 3 else "de", 60), "en" if k % 3 else "de") for k in range(90)]
    item = text("en", 30)
    rows += [(200, rows[1][1], "en"), (201, rows[1][1] + " more", None), (202, None, "en"), (203, "123 .", "en"), (204, "", "de")]
    rows += [(205, item + " " + text("en", 20), "en"), (206, "Write to a.b@c.de or 10.0.0.1 please " + text("en", 20), "en")]
    rows += [(4, rows[4][1], "en"), (None, text("de", 40), "de")]
    docs = frame("doc_id long, text string, lang string, source string, n_chars long", [(k, t, x, "s", len(t or "")) for k, t, x in rows])
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    frame("item_id long, text string", [(1, item), (2, None)]).write.parquet(f"{tmp_path}/benchmark.parquet")
    return str(tmp_path), rows, [(1, item)]


def test_stages(spark, folder):
    path, rows, items = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    columns, kept = docs.columns, {}
    for name, step in corpus_pipeline.STAGES:
        docs = stage(step(spark, docs, path), name)
        kept[name] = docs.collect()
        assert name == "pack" or docs.columns == columns
    known = [(k, t) for k, t, _ in rows if t and any(c.isalpha() for c in t)]
    sort = lambda x: sorted(x, key=lambda r: (r[0] is not None, r[0] or 0, *r[1:]))
    assert sort((r.doc_id, r.text) for r in kept["language_id"]) == sort(known)
    assert all(r.lang for r in kept["language_id"])
    single = [x for k, x in enumerate(known) if x not in known[:k]]
    heads = {r[1] for r in groups(single)}
    assert sort((r.doc_id, r.text) for r in kept["near_duplicates"]) == sort(x for x in single if x[0] in heads)
    bad = {r[0] for r in contaminated([(r.doc_id, r.text) for r in kept["near_duplicates"]], items) if r[-1]}
    assert bad == {205}
    assert {r.doc_id for r in kept["decontaminate"]} == {r.doc_id for r in kept["near_duplicates"]} - bad
    before = {r.doc_id: r.text for r in kept["decontaminate"]}
    for r in kept["pii"]:
        assert not entities(r.text) and r.n_chars == len(r.text)
        assert (r.text == before[r.doc_id]) == (not entities(before[r.doc_id]))
    pieces = kept["pack"]
    assert {r.doc_id for r in pieces} == {r.doc_id for r in kept["pii"]}
    for key in {r.doc_id for r in pieces}:
        mine = [r for r in pieces if r.doc_id == key]
        assert sum(r.length for r in mine) == mine[0].doc_tokens


@pytest.mark.parametrize("n_languages", [2, 4])
def test_letters_in_no_language_go(spark, documents, n_languages):
    import random

    g = random.Random(8)
    prose = PROSE | {"fr": "le la et les des est une dans pour pas que qui sur avec ce", "es": "el los las una con por para como pero su al lo más"}
    text = lambda lang, n: " ".join(g.choice(prose[lang].split()) for _ in range(n))
    languages = list(prose)[:n_languages]
    docs, clean = None, set()
    for k, lang in enumerate(languages):
        rows = {1000 * k + i: text(lang, 60 if i else 6) for i in range(40)}
        clean |= set(rows)
        docs = documents(rows, lang) if docs is None else docs.unionByName(documents(rows, lang))
    mixed = " ".join(text(lang, 1) for _ in range(60) for lang in languages)
    docs = docs.unionByName(documents({9000: mixed, 9001: "12 34"}, None))
    kept = {r.doc_id: r.lang for r in corpus_pipeline.keep_known_languages(spark, docs, "").collect()}
    assert set(kept) == clean and all(kept[1000 * k] == lang for k, lang in enumerate(languages))


def test_run_on_empty_tables(spark, folder, tmp_path):
    path, _, _ = folder
    empty = tmp_path / "empty"
    for name in ("documents", "benchmark"):
        spark.read.parquet(f"{path}/{name}.parquet").limit(0).write.parquet(f"{empty}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(empty)).count() == 0


def test_no_sql_is_claimed():
    assert corpus_pipeline.ORACLE_SQL is None
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "near_duplicates", "decontaminate", "pii", "pack"]

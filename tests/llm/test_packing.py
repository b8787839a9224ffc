from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from martwright.llm import packing
from martwright.llm.packing import hilbert_key, pack

HARD = {
    0: None, 1: "", 2: "a", 3: " two  spaces   three\n\n four \t x ", 4: "<|endoftext|>a <|endoftext|> b", 5: "it's 's we'll x ² é́",
    6: "word " * 3000, 7: "x" * 5000, 8: "日本 \U0001f600 \x1c\x85 end ", 9: "same text", 10: "same text",
}


@pytest.mark.parametrize("dims, bits", [(2, 4), (3, 3), (4, 2)])
def test_hilbert_curve_is_a_walk_through_all_cells(dims, bits):
    cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims), axis=-1).reshape(-1, dims)
    key = hilbert_key(cells, bits)
    assert sorted(key) == list(range(len(cells)))
    walk = cells[np.argsort(key)]
    assert (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()


def check(rows, texts, full):
    want = {k: (full.encode(t, add_special_tokens=False).ids if t else []) + [0] for k, t in texts.items()}
    docs, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        docs[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    for key, ids in want.items():
        at = 0
        for r in sorted(docs.pop(key), key=lambda r: r.start):
            assert (r.start, r.doc_tokens) == (at, len(ids))
            assert r.ids == np.array(ids[at : at + r.length], "<u4").tobytes()
            at += r.length
        assert at == len(ids)
    assert not docs
    for pieces in sequences.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 1024 and at & (at - 1) == 0


def test_round_trip(documents, monkeypatch):
    monkeypatch.setattr(packing, "REMEMBERED", 5)
    full = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    check(pack(documents(HARD).withColumnRenamed("n_chars", "LENGTH")).collect(), HARD, full)


def test_sample_documents(spark, sf_dir):
    full = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    check(pack(docs).collect(), {r.doc_id: r.text for r in docs.collect()}, full)


def test_copies_are_neighbours_and_repeated_rows_are_all_packed(documents):
    docs = documents([(k, "same text here") for k in (1, 2, 3)] + [(1, "same text here"), (None, "lost")])
    rows = pack(docs).collect()
    copies = [r for r in rows if r.doc_id is not None]
    assert sum(r.length for r in copies) == 4 * copies[0].doc_tokens
    assert {r.doc_id for r in rows} == {1, 2, 3, None}


def test_empty_table(documents):
    assert pack(documents({})).count() == 0

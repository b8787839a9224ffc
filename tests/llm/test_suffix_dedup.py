import random
import re

import numpy as np

from martwright.llm import suffix_dedup as S
from martwright.llm.textkit import words_of


def brute_force(docs):
    windows, tokens = {}, {}
    for key, text in docs:
        folded = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        tokens[key] = w = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", folded)
        for i in range(len(w) - 49):
            windows.setdefault(tuple(w[i : i + 50]), set()).add(key)
    rank = lambda k: (k is not None, k or 0)
    out = []
    for key, w in tokens.items():
        hits = [(i, min(windows[t], key=rank)) for i in range(len(w) - 49) if len(windows[t := tuple(w[i : i + 50])]) > 1]
        run = []
        for i, low in hits:
            if run and i <= run[-1][0] + 50:
                run.append((i, low))
            else:
                if run:
                    out.append((key, run[0][0], run[-1][0] + 50, min((x for _, x in run), key=rank)))
                run = [(i, low)]
        if run:
            out.append((key, run[0][0], run[-1][0] + 50, min((x for _, x in run), key=rank)))
    return sorted(out, key=lambda r: (rank(r[0]), r[1]))


def corpus():
    g = random.Random(2)
    vocabulary = [f"w{k}" for k in range(300)]
    prose = lambda n: [g.choice(vocabulary) for _ in range(n)]
    shared = [prose(n) for n in (49, 50, 51, 60, 90, 200)]
    docs = []
    for k in range(40):
        text = prose(g.choice([0, 10, 80]))
        for _ in range(g.choice([0, 1, 2])):
            passage = g.choice(shared)
            cut = g.choice([0, 0, 1, 7])
            text += passage[cut:] + prose(g.choice([0, 5, 40]))
        docs.append((k, " ".join(text)))
    docs += [(100, None), (101, ""), (102, "same " * 300), (103, "same " * 70), (104, " ".join(shared[2] + shared[2]))]
    docs += [(105, docs[3][1]), (None, " ".join(shared[3])), (106, " ".join(prose(2000) + shared[5] + prose(2000)))]
    return docs


def test_equals_brute_force(frame):
    docs = corpus()
    rows = S.repeated_passages(frame("doc_id long, text string, HEAD int, doc string", [(*d, 1, "x") for d in docs])).collect()
    rank = lambda k: (k is not None, k or 0)
    assert sorted(map(tuple, rows), key=lambda r: (rank(r[0]), r[1])) == brute_force(docs)


def test_repeated_rows_of_one_id_are_one_document(documents):
    text = " ".join(f"w{k}" for k in range(80))
    assert S.repeated_passages(documents([(1, text), (1, text)])).count() == 0
    assert {tuple(r) for r in S.repeated_passages(documents([(2, text), (1, text), (2, text)])).collect()} == {(1, 0, 80, 1), (2, 0, 80, 1)}


def test_empty_table(documents):
    assert S.repeated_passages(documents({})).count() == 0


def test_hashes_depend_on_words_alone():
    """The same run of words has one hash wherever it stands in a batch."""
    run = " ".join(f"w{k}" for k in range(60)).encode()
    found = set()
    for before in (b"", b"some words before ", b"x " * 1000):
        raw = np.frombuffer(before + run, np.uint8)
        words = words_of(raw, np.array([0, len(raw)]))
        found.add(S._runs(words.hashes(), 50)[-11:].tobytes())
    assert len(found) == 1

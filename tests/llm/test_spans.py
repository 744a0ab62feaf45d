import random

import numpy as np
import pandas as pd
import pytest

from strataflux.llm import spans

SCHEMA = "doc_id bigint, text string, keys string, pos int, n_chars bigint"


def brute(rows, length):
    """{doc_id: shared characters} by hashing every window of every text."""
    where, texts = {}, {}
    for doc, text, *_ in rows:
        if doc is None or text is None:
            continue
        texts.setdefault(doc, []).append(text)
        for i in range(len(text) - length + 1):
            where.setdefault(text[i : i + length], set()).add(doc)
    out = {}
    for doc, versions in texts.items():
        if len(versions) > 1:
            continue
        covered = set()
        for i in range(len(versions[0]) - length + 1):
            if len(where[versions[0][i : i + length]]) > 1:
                covered.update(range(i, i + length))
        out[doc] = len(covered)
    return out


def corpus(seed):
    rnd = random.Random(seed)
    word = lambda n: "".join(rnd.choice("abcdeé😀 \n") for _ in range(n))
    pieces = [word(n) for n in (30, 39, 40, 41, 45, 59, 60, 90, 300)]
    notice = word(35)
    rows = []
    for i in range(60):
        text = "".join(rnd.choice([word(rnd.randint(0, 50)), rnd.choice(pieces), rnd.choice(pieces)[rnd.randint(0, 9) :]]) for _ in range(4))
        rows.append((i, text + notice))
    rows += [(100, rows[3][1]), (101, rows[3][1]), (102, ""), (103, None), (None, rows[5][1]), (104, word(39)), (105, word(2000) + rows[7][1][-41:])]
    rows += [(106, rows[104 - 44][1]), (106, rows[104 - 44][1])]  # the same record twice shares nothing with itself
    return [(*r, "k", 1, 0) for r in rows]


@pytest.mark.parametrize("seed", [1, 2])
def test_spans_equal_brute_force(spark, seed):
    rows = corpus(seed)
    want = brute(rows, 40)
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    found = {r.doc_id for r in spans.records_with_shared_spans(docs, 40).collect()}
    assert {d for d in found if d in want} == {d for d, n in want.items() if n}
    shares = {r.doc_id: r.n_shared for r in spans.shared_shares(docs, 40).collect()}
    assert {d: shares[d] for d in want} == want and 103 in shares


def test_no_documents(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert spans.records_with_shared_spans(docs, 40).count() == 0 and spans.shared_shares(docs, 40).count() == 0


def test_hot_notice_and_very_long_text(spark):
    rnd = random.Random(5)
    notice = "".join(rnd.choice("abcdefgh") for _ in range(400))
    own = lambda n: "".join(rnd.choice("ijklmnop") for _ in range(n))
    rows = [(i, own(50) + (notice if i % 3 == 0 else own(400)), "k", 1, 0) for i in range(300)] + [(1000, own(700_000) + notice[:300], "k", 1, 0), (1001, notice[101:], "k", 1, 0)]
    found = {r.doc_id for r in spans.records_with_shared_spans(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert found == {i for i in range(300) if i % 3 == 0} | {1000}


def test_covers_hold_every_difference():
    for period, cover in spans.DIFFERENCE_COVERS.items():
        assert {(a - b) % period for a in cover for b in cover} == set(range(period))
    assert spans.cover_for(300)[0] == 133 and spans.cover_for(40)[0] == 13 and spans.cover_for(1)[0] == 1


def test_places_met_over_tasks_equal_places_met_at_once():
    rng = np.random.default_rng(3)
    n = 4_000
    window, docs, at = rng.integers(0, 900, n), rng.integers(0, 60, n), np.arange(n)
    window[: n // 3] = 7  # a third of all places are one window
    bucket = window % 5
    sent = pd.concat([spans._send_places(bucket[i::8], window[i::8], docs[i::8], at[i::8], 5) for i in range(8)])
    travels = sent[sent["bucket"] >= 0]
    assert sum((w == 7).sum() for w in travels["window"]) == 8
    met = pd.concat([spans._places_in_bucket(g) for _, g in sent.groupby("bucket")])
    found = sorted(p for a, b in zip(met["pos"], met["last"]) for p in range(a, b + 1))
    holders = pd.DataFrame({"w": window, "d": docs}).groupby("w")["d"].nunique()
    assert found == [i for i in range(n) if holders[window[i]] > 1]

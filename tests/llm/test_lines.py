"""Template lines against a brute-force version of the definition."""

from __future__ import annotations

import random
from collections import Counter, defaultdict

import pytest

from silvermill.llm import bindings, lines
from silvermill.llm.lines import FIELD, LEADING, MIN_DOCS, MIN_FIXED, MIN_TOKENS, drop_recurring_lines, tokens
from tests.llm.conftest import SF


def brute(texts, min_docs=MIN_DOCS, min_tokens=MIN_TOKENS, min_fixed=MIN_FIXED):
    """(n_lines, n_dropped, text) of every text."""
    docs = [[tuple(tokens(line)) for line in (t or "").split("\n")] for t in texts]
    path = lambda found: (len(found), *found[:LEADING])
    reached = Counter(leaf for doc in docs for leaf in {path(f) for f in doc if len(f) >= min_tokens})
    support: Counter = Counter()
    own = [{f for f in doc if len(f) >= min_tokens and reached[path(f)] >= min_docs} for doc in docs]
    for doc in own:
        for found in doc:
            support.update((path(found), place, token) for place, token in enumerate(found))

    def template(found):
        fixed = [t if t != FIELD and support[path(found), i, t] >= min_docs else FIELD for i, t in enumerate(found)]
        share = sum(t != FIELD for t in fixed) / len(fixed)
        return (path(found), tuple(fixed)) if share >= min_fixed else found

    held = defaultdict(set)
    for i, doc in enumerate(own):
        for found in doc:
            held[template(found)].add(i)
    out = []
    for i, text in enumerate(texts):
        parts = (text or "").split("\n")
        kept = [p for p, f in zip(parts, docs[i]) if f not in own[i] or len(held[template(f)]) < min_docs]
        out.append((len(parts), len(parts) - len(kept), "\n".join(kept)))
    return out


def found(df):
    return {r.doc_id: (r.n_lines, r.n_dropped, r.text) for r in df.collect()}


def corpus(seed):
    rng = random.Random(seed)
    words = [f"{a}{b}" for a in "abcdefg" for b in "xyz"]
    texts = []
    for i in range(120):
        lines = [" ".join(rng.choices(words, k=rng.randint(0, 9))) for _ in range(rng.randint(0, 4))]
        if rng.random() < 0.4:
            lines.append(f"Posted by user {rng.choice(['ann', 'bob', 'eve', words[i % 21]])} on day {i} of 2024")
        if rng.random() < 0.3:
            lines.append("All rights reserved by their owners")
        if rng.random() < 0.3:
            lines += ["go home", "", f"visit https://x.org/{i} or mail me@x.org today  please"]
        if i == 7:
            lines += [f"only here in one document {w}" for w in words]
        rng.shuffle(lines)
        texts.append("\n".join(lines))
    return texts


@pytest.mark.parametrize("seed,least,broadcast", [(0, 10, 500), (1, 4, 0), (2, 2, 0), (2, 2, 500)])
def test_templates_of_a_small_corpus(spark, monkeypatch, seed, least, broadcast):
    monkeypatch.setattr(lines, "BROADCAST_LINES", broadcast)
    texts = corpus(seed)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(6)
    want = brute(texts, min_docs=least)
    assert found(drop_recurring_lines(df, min_docs=least)) == dict(enumerate(want))
    assert any("Posted by" in t for t in texts) and not any("Posted by" in w[2] for w in want)
    assert "go home" in "".join(w[2] for w in want)


def test_lines_of_one_document_do_not_recur(spark):
    texts = ["\n".join(f"name of the person {x}" for x in "abcdefghijklmnop"), "something else is said here"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r.n_dropped for r in drop_recurring_lines(df).collect()} == {0}


def test_op6_query(spark, documents):
    want = brute([t for _, t in documents])
    got = found(bindings.QUERIES["op6_line_dedup"](spark, SF))
    assert got == {d: w for (d, _), w in zip(documents, want)}
    assert sum(w[1] for w in want) > 0


def test_odd_rows(spark, odd, empty):
    rows = [(r.doc_id, r.text) for r in odd.select("doc_id", "text").collect()]
    want = brute([t for _, t in rows], min_docs=3)
    got = drop_recurring_lines(odd, min_docs=3).collect()
    assert sorted((str(r.doc_id), r.n_lines, r.n_dropped, r.text) for r in got) == sorted(
        (str(d), *w) for (d, _), w in zip(rows, want))
    assert {r.n_dropped for r in got if r.doc_id in (1, 7)} == {1}  # the same line in three documents
    assert drop_recurring_lines(empty).count() == 0


@pytest.mark.parametrize("broadcast", [500, 0])
def test_lines_of_few_fixed_tokens_stand_for_themselves(spark, monkeypatch, broadcast):
    monkeypatch.setattr(lines, "BROADCAST_LINES", broadcast)
    # Ten documents of different figures; one row of figures, and the fields' own sign, are in ten others each.
    rows = [f"{i} {i + 3}.5 {7 * i} 1{i}\n{i} 8 {i} 9" for i in range(10)]
    rows += [f"20 30.5 40 50\n2{i} 0 0 1" for i in range(10)] + [f"<*> <*> <*> <*>\n3{i} 1 1 0" for i in range(10)]
    df = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string").repartition(4)
    want = {i: (2, int(i >= 10), r if i < 10 else r.split("\n")[1]) for i, r in enumerate(rows)}
    assert found(drop_recurring_lines(df)) == want


@pytest.mark.parametrize("broadcast", [500, 0])
def test_short_lines_and_lines_without_spaces_recur(spark, monkeypatch, broadcast):
    monkeypatch.setattr(lines, "BROADCAST_LINES", broadcast)
    long = "版权所有未经许可不得转载本网站的任何内容"
    rows = [f"All rights  reserved.\n{long}\n\nPage {i}\nonly {long}{i}" for i in range(10)]
    rows += ["All rights reserved.\nsome words" for _ in range(9)]
    df = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string").repartition(4)
    want = {i: (5, 2, f"\nPage {i}\nonly {long}{i}") for i in range(10)} | {i: (2, 1, "some words") for i in range(10, 19)}
    assert found(drop_recurring_lines(df, short_lines=True)) == want
    assert {r.n_dropped for r in drop_recurring_lines(df).collect()} == {0}


def test_op6_query_drops_short_lines(spark):
    larger = "/root/testdata/sf0.1"
    got = bindings.QUERIES["op6_line_dedup"](spark, larger).select("text").collect()
    assert not any(line.strip() == "All rights reserved." for r in got for line in r.text.split("\n"))

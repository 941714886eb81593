"""The pipeline against its stages done by brute force."""

from __future__ import annotations

import public_tokenizers
from tokenizers import Tokenizer

import __spark_entry__ as catalog
import corpus_pipeline
from silvermill.llm import quality, toxicity
from silvermill.llm.common import table
from tests.llm.conftest import SF
from tests.llm.test_dedup import brute
from tests.llm.test_tokens import check_packing


def test_pipeline(spark, documents):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    good = {r.doc_id for r in quality.score(docs, quality.train(docs, labels)).filter("predicted = 1").collect()}
    first = docs.filter(docs.doc_id.isin(*good))
    grammar = toxicity.train(first, labels)
    clean = {r.doc_id for r in toxicity.score(first, grammar).filter("predicted = 0").collect()}
    newest: dict = {}
    for doc_id, text in documents:
        if doc_id in clean:
            newest[text] = max(doc_id, newest.get(text, -1))
    rows = [(d, t) for t, d in newest.items()]
    kept = {int(d) for d, c, _ in brute(rows) if d == c}
    whole = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = {d: [*whole.encode(t, add_special_tokens=False).ids, 1] for d, t in rows if d in kept}
    assert 0 < len(want) < len(rows) <= len(clean) < len(good) < len(documents)
    check_packing(catalog.queries()["pipeline"](spark, SF).collect(), want, 2048)


def test_stages_keep_the_columns(spark, odd):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "toxicity", "exact_dedup", "near_dedup", "packing"]
    docs = odd
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF)
        assert docs.columns == odd.columns and docs.count() > 0


def test_stages_of_an_empty_table(spark, empty):
    docs = empty
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF)
        assert docs.columns == empty.columns and docs.count() == 0
    assert corpus_pipeline.pack(spark, docs, SF).count() == 0


def test_texts_are_judged_once_whatever_their_ids(spark):
    """Rows that repeat an id or a text, ties and null ids: one row of each text stays, of the last id."""
    text = "The committee met on Tuesday and agreed to publish the minutes of the spring session before the summer."
    other = "Two rivers meet below the old mill, where the road turns north and the orchards give way to open fields."
    rows = [(1, text, "a"), (3, text, "b"), (3, text, "c"), (None, text, "d"), (None, other, "e"), (None, other, "f")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, kept string")
    for name, stage in corpus_pipeline.STAGES[2:-1]:
        docs = stage(spark, docs, SF)
        assert sorted(r.text for r in docs.collect()) == sorted([text, other])
    assert {r.doc_id for r in docs.collect()} == {3, None} and docs.columns == ["doc_id", "text", "kept"]

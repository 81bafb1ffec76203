"""The registered text queries against their SQL, and the pipeline against a walk through the documents."""

from zlib import crc32

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from compare import connect, differences
from duolect.llm import queries as text
from duolect.llm.exact_dedup import exact_dedup
from duolect.llm.language_id import predict_languages
from duolect.llm.line_dedup import cut, units
from duolect.llm.common import packed
from duolect.llm.simhash import near_duplicates

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(text.ORACLES))
def test_query_matches_sql(spark, name):
    assert differences(entry.queries()[name](spark, SMALL), connect(SMALL), entry.oracle_sql()[name]) is None


def test_every_operator_and_the_pipeline_are_registered():
    assert {n.split("_")[0] for n in entry.queries() if n.startswith("op")} == {f"op{i}" for i in range(1, 14)}
    assert "pipeline" in entry.queries() and [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "exact_dedup", "simhash", "line_dedup", "packing"]


def test_stages_follow_from_each_other(spark, odd):
    """Each stage keeps what its operator says of its own input, with the columns of documents."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").unionByName(odd.select("doc_id", "text", "lang", "source", "n_chars").where("doc_id > 7").withColumn("doc_id", odd.doc_id + 10_000))
    steps = dict(corpus_pipeline.STAGES)

    def ids(df):
        return sorted(r.doc_id for r in df.select("doc_id").collect())

    named = steps["language_id"](spark, docs, SMALL)
    assert ids(named) == ids(predict_languages(docs).where("lang_pred <> 'und'")) and 10_008 not in ids(named)
    single = steps["exact_dedup"](spark, named, SMALL)
    assert ids(single) == ids(exact_dedup(named).where("kept"))
    apart = steps["simhash"](spark, single, SMALL)
    assert ids(apart) == ids(near_duplicates(single).where("doc_id = component_id")) and len(ids(apart)) < len(ids(single))
    rest = steps["line_dedup"](spark, apart, SMALL)
    assert named.columns == single.columns == apart.columns == rest.columns == docs.columns
    seen, want = set(), {}
    for row in sorted(apart.select("doc_id", "text").collect()):
        gone = []
        for a, b, key in units(row.text):
            if key in seen:
                gone.append((a, b))
            seen.add(key) if key else None
        left = cut(row.text, [a for a, _ in gone], [b for _, b in gone])
        if left.strip(" \t\n\r\x0b\x0c") or not gone:
            want[row.doc_id] = left
    assert {r.doc_id: r.text for r in rest.collect()} == want
    assert all(r.n_chars == len(r.text) for r in rest.collect())
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    pieces = sorted((r.doc_id, r.start, r.length, r.ids_crc32) for r in steps["packing"](spark, rest, SMALL).collect())
    ids = {doc: [*tokenizer.encode(text, add_special_tokens=False).ids, 1] for doc, text in want.items()}
    assert pieces == sorted((doc, at, len(own[at:at + 2048]), crc32(packed(own[at:at + 2048]))) for doc, own in ids.items() for at in range(0, len(own), 2048))


def test_run_packs_every_document_that_stays(spark):
    rows = corpus_pipeline.run(spark, SMALL).collect()
    whole = {}
    for r in rows:
        whole[r.doc_id] = whole.get(r.doc_id, 0) + r.length
    assert whole and all(whole[r.doc_id] == r.doc_tokens for r in rows)

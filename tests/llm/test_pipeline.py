"""The pipeline against its operators applied by hand, and the guard of the entry file."""

import hashlib
from collections import Counter

import corpus_pipeline
import pytest
from sentencepiece import SentencePieceProcessor
from test_decontaminate import brute as brute_hits
from test_jaccard_join import brute_classes

from helpers_llm import CLASHING, docs, odd_rows, prose

from larder.llm import language_id, toxicity
from larder.llm.queries import ORACLE_SQL, PIECES, QUERIES

SF = "/root/testdata/sf0.001"


def test_stages_keep_what_their_operators_keep(spark):
    docs, labels, bench = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels", "benchmark"))
    rows = {r.doc_id: r for r in docs.collect()}
    bad = {r.doc_id for r in toxicity.score(docs, toxicity.fit(docs, labels)).collect() if r.predicted}
    left = docs.where(~docs.doc_id.isin(list(bad))) if bad else docs
    no = {r.doc_id for r in language_id.identify(left, language_id.fit(left)).collect() if r.rejected}
    kept = [(i, r.text) for i, r in rows.items() if i not in bad | no]
    classes = brute_classes(kept)
    kept = [(i, t) for i, t in kept if classes[i] == i]
    hits = {r[0] for r in brute_hits(kept, [tuple(r) for r in bench.select("item_id", "text").collect()]) if r[5]}
    sp = SentencePieceProcessor(model_file=PIECES)
    want = {}
    for i, t in kept:
        if i not in hits:
            ids = [*sp.encode(t), 2]
            want[i] = (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest())
    got = {r.doc_id: (r.n_tokens, r.ids_sha256) for r in corpus_pipeline.run(spark, SF).collect()}
    assert got == want


def test_stages_return_the_columns_of_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF).schema.fieldNames() == docs.columns


def test_queries_are_registered():
    import __spark_entry__ as entry

    names = set(entry.queries())
    assert set(QUERIES) | {"pipeline"} <= names and set(ORACLE_SQL) <= set(entry.oracle_sql())
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


def odd_table(spark):
    """Rows that learn a language, odd rows, and columns that operators might name."""
    rows = [(1000 + i, prose(50 + i, 60), "en", "a", 1) for i in range(40)]
    return docs(spark, rows + odd_rows())


def key(row):
    return repr((row.doc_id, row.text, row.lang, row.source))


@pytest.mark.parametrize("name", ["toxicity", "language_id", "jaccard_join", "decontamination"])
def test_odd_rows_pass_each_filter_whole_or_go(spark, name):
    stage = dict(corpus_pipeline.STAGES)[name]
    table = odd_table(spark)
    got = stage(spark, table, SF)
    assert got.columns == table.columns
    kept, all_rows = Counter(map(key, got.collect())), Counter(map(key, table.collect()))
    assert not kept - all_rows
    gone = all_rows - kept
    lost = {eval(k)[0] for k in gone}  # noqa: S307 - our own repr
    if name == "toxicity":
        assert not gone
    elif name == "language_id":  # null and letterless texts are in no language, others here are far from the prose
        assert {1, 2, 3} <= lost <= {1, 2, 3, 4, 8, 9, 10, 11, None}
    elif name == "jaccard_join":  # of the equal texts of ids 5, 5 and 6 one stays
        assert lost == {5, 6} and sum(gone.values()) == 2
    else:
        assert not gone
    assert all(r[c] == f"own {c}" for r in got.collect() for c in CLASHING)
    assert stage(spark, table.limit(0), SF).count() == 0


def test_odd_rows_through_the_last_stage(spark):
    out = dict(corpus_pipeline.STAGES)["sentencepiece"](spark, odd_table(spark), SF)
    assert out.count() == odd_table(spark).count()
    assert dict(corpus_pipeline.STAGES)["sentencepiece"](spark, odd_table(spark).limit(0), SF).collect() == []


def test_a_worker_keeps_the_tables_of_one_operator(spark):
    def run(batches):
        import pyarrow as pa

        from larder.llm import common, sentencepiece_codec

        sentencepiece_codec.codec(PIECES)
        assert sentencepiece_codec.codec(PIECES) is sentencepiece_codec.codec(PIECES)
        common.held_by("jaccard_join")["x"] = 1
        assert common.held_by("jaccard_join") == {"x": 1}
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([len(common._HELD)] * batch.num_rows, pa.int64())], ["n"])

    assert spark.range(1).mapInArrow(run, "n long").collect()[0].n == 1

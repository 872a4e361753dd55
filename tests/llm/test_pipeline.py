"""The registered queries and the pipeline, on the driver's smallest tables."""

import hashlib
import struct

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from lakeingest.llm.exchange import stage
from lakeingest.llm.queries import ORACLES, QUERIES
from scripts.compare import TABLES, digest

from .fixtures import tokens
from .test_near_duplicates import brute_classes, brute_passages

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_registry():
    names = set(entry.queries())
    assert set(QUERIES) | {"pipeline"} <= names
    for n in range(1, 11):
        assert sum(q.startswith(f"op{n}_") for q in names) == 1
    assert {q.split("_")[0] for q in ORACLES} == {"op2", "op7", "op10", "op11", "op12", "op13"}
    assert [q for q, _ in corpus_pipeline.STAGES] == ["toxicity", "ngram_jaccard_join", "suffix_array_dedup", "pfair_mix",
                                                      "bpe_encode_decode"]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF)
    cols, rows = df.columns, [tuple(r) for r in df.collect()]
    res = duck.execute(ORACLES[name])
    ocols, orows = [d[0] for d in res.description], res.fetchall()
    assert sorted(cols) == sorted(ocols) and len(rows) == len(orows)
    assert digest(cols, rows)[0] == digest(ocols, orows)[0]


def test_pipeline_stage_by_stage(spark):
    tokenizers = pytest.importorskip("tokenizers")
    from lakeingest.llm.queries import tokenizer_path
    docs, outputs = spark.read.parquet(f"{SF}/documents.parquet"), {}
    before = {"toxicity": docs.collect()}
    for name, fn in corpus_pipeline.STAGES:
        docs = stage(fn(spark, docs, SF), f"test-{name}")
        outputs[name] = docs.collect()
        if name != "bpe_encode_decode":
            assert docs.columns == COLUMNS
    toxic, near, cut, mixed, ids = outputs.values()

    source = {r.doc_id: tuple(r) for r in before["toxicity"]}
    assert all(tuple(r) == source[r.doc_id] for r in toxic) and len(toxic) == len({r.doc_id for r in toxic})
    assert 0.75 * len(source) < len(toxic) < len(source)

    assert {r.doc_id for r in near} == {d for d, _, c in brute_classes([tuple(r) for r in toxic]) if d == c}
    assert all(tuple(r) == source[r.doc_id] for r in near)

    want = {d: left for d, _, later, left in brute_passages([tuple(r) for r in near]) if left or not later}
    assert {r.doc_id: tokens(r.text) for r in cut} == want
    assert all(r.n_chars == len(r.text) for r in cut)

    assert sorted(map(tuple, mixed)) == sorted(map(tuple, cut))
    assert [r.doc_id for r in mixed] != sorted(r.doc_id for r in mixed)

    library = tokenizers.Tokenizer.from_file(tokenizer_path())
    texts = {r.doc_id: r.text for r in mixed}
    assert len(ids) == len(texts)
    for r in ids:
        own = library.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert (r.n_tokens, list(r.ids)) == (len(own), own)
        assert r.ids_sha256 == hashlib.sha256(struct.pack(f"<{len(own)}I", *own)).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()
    assert sorted(map(tuple, corpus_pipeline.run(spark, SF).select("doc_id", "n_tokens").collect())) == sorted(
        (r.doc_id, r.n_tokens) for r in ids)


def test_the_mix_reaches_the_rows_of_run(spark, monkeypatch):
    """The last two stages: every row has its place in the mix, and the part files are written in that order."""
    from lakeingest.llm.pfair_mix import scheduled
    monkeypatch.setattr(corpus_pipeline, "STAGES", corpus_pipeline.STAGES[3:])
    want = {r.doc_id: (r.slot, r.in_block) for r in scheduled(spark.read.parquet(f"{SF}/documents.parquet")).select(
        "doc_id", "mix.slot", "mix.in_block").collect()}
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")    # several part files
    try:
        result = corpus_pipeline.run(spark, SF)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    got = result.collect()
    assert len(got) == len(want) and {r.doc_id: (r.slot, r.in_block) for r in got} == want
    assert len({(r.slot, r.in_block) for r in got}) == len(got)
    files = {}
    for r in result.select("slot", "in_block", F.input_file_name().alias("file")).collect():
        files.setdefault(r.file.rsplit("/", 1)[1], []).append((r.slot, r.in_block))
    assert len(files) > 1
    written = [x for name in sorted(files) for x in files[name]]
    assert written == sorted(want.values())

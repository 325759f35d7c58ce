"""The pipeline against plain versions of its stages, on the smallest tables."""

import corpus_pipeline
import public_tokenizers
from broadsheet.llm import mixing, toxicity
from broadsheet.llm.scratch import written
from pyspark.sql import functions as F
from test_minhash import plain
from test_mixing_packing import check_packing
from test_repeats import plain_removed

DATA = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages(spark, small_docs):
    names = [name for name, _ in corpus_pipeline.STAGES]
    stages = dict(corpus_pipeline.STAGES)
    assert names == ["toxicity", "near_duplicates", "repeated_strings", "mix", "pack"]

    def stage(name, docs):
        out = written(stages[name](spark, docs, DATA), name)
        assert name == "pack" or out.columns == COLUMNS
        return out

    clean = stage("toxicity", small_docs)
    model = toxicity.train(small_docs, spark.read.parquet(f"{DATA}/labels.parquet"))
    toxic = {r["doc_id"] for r in toxicity.severities(small_docs, model).where("is_toxic").collect()}
    before = {r["doc_id"]: r for r in small_docs.collect()}
    assert {r["doc_id"]: r for r in clean.collect()} == {d: r for d, r in before.items() if d not in toxic}

    single = stage("near_duplicates", clean)
    groups = plain({r["doc_id"]: r["text"] for r in clean.collect()}, 5)
    assert {r["doc_id"] for r in single.collect()} == {d for d, g in groups.items() if g[2]}

    short = stage("repeated_strings", single)
    raw = {r["doc_id"]: r["text"].encode() for r in single.collect()}
    marks = plain_removed(raw, 100)
    for r in short.collect():
        kept = bytes(b for b, gone in zip(raw[r["doc_id"]], marks[r["doc_id"]]) if not gone)
        assert r["text"].encode().decode(errors="ignore") == r["text"] and r["n_chars"] == len(r["text"])
        assert 0 <= len(r["text"].encode()) - len(kept) <= 8 * (len(raw[r["doc_id"]]) != len(kept)) * 100
    assert short.count() == single.count()

    mix = stage("mix", short)
    order = mixing.mix_order(short).orderBy("slot", "place").collect()
    rows = mix.select("doc_id", F.struct(*corpus_pipeline._row_order(mix)).alias("at")).orderBy("at")
    assert [r["doc_id"] for r in rows.collect()] == [r["doc_id"] for r in order]

    packed = corpus_pipeline.pack_sequences(spark, mix, DATA).collect()
    assert check_packing(mix, packed) < 0.02
    place = {r["doc_id"]: i for i, r in enumerate(order)}
    by_length = {}
    for r in sorted(packed, key=lambda r: (r["length"], place[r["doc_id"]], r["start"])):
        by_length.setdefault(r["length"], []).append(r["sequence_id"])
    assert all(ids == sorted(ids) for ids in by_length.values())
    assert public_tokenizers.path(corpus_pipeline.tokenizer_path().rsplit("/", 1)[1])


def test_run_without_files(spark, odd_docs):
    assert corpus_pipeline._row_order(odd_docs) == []
    rows = corpus_pipeline.pack_sequences(spark, odd_docs.select(*COLUMNS), DATA)
    assert rows.count() >= odd_docs.count()

import corpus_pipeline
import public_tokenizers

from lagline.llm import bpe, decontamination, personal

MIDDLE = "/root/testdata/sf0.01"


def test_stages_one_by_one(spark, tmp_path):
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == [
        "toxicity", "near_duplicates", "decontamination", "personal_data", "byte_bpe",
    ]
    docs = spark.read.parquet(f"{MIDDLE}/documents.parquet")
    columns, tables = docs.columns, {"": docs}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, MIDDLE).write.parquet(f"{tmp_path}/{name}")
        docs = tables[name] = spark.read.parquet(f"{tmp_path}/{name}")
        if name != "byte_bpe":
            assert docs.columns == columns
    ids = {name: {r.doc_id for r in t.select("doc_id").collect()} for name, t in tables.items()}
    assert ids["near_duplicates"] < ids["toxicity"] < ids[""]
    assert ids["byte_bpe"] == ids["personal_data"] == ids["near_duplicates"]
    items = [tuple(r) for r in spark.read.parquet(f"{MIDDLE}/benchmark.parquet").collect()]
    automaton = decontamination.build(items, 10)
    encoding = bpe.make_encoding(
        bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken")),
        public_tokenizers.PATTERN,
    )
    for row in tables["byte_bpe"].collect():
        words = decontamination.normal_words(row.text)
        assert decontamination.find(automaton, words)[0] == []
        assert personal.base_spans(row.text or "") == []
        assert row.tokens == encoding.encode_ordinary(row.text or "")
        assert row.n_tokens == len(row.tokens)


def test_run_gives_the_last_stage(spark):
    made = corpus_pipeline.run(spark, MIDDLE)
    assert made.columns[-2:] == ["n_tokens", "tokens"] and made.count() > 100

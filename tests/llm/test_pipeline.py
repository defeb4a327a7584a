from pathlib import Path

import pyarrow as pa
from tokenizers import Tokenizer

import corpus_pipeline
from flowloom.llm import common, decontaminate, language_id, near_dedup, toxicity


def test_stages_follow_each_other(spark, sf):
    docs = common.table(spark, sf, "documents")
    columns, before = docs.columns, {r.doc_id: r for r in docs.collect()}
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["language_id", "toxicity", "near_dedup", "decontaminate", "bpe"]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, sf)
        assert kept.columns == columns
        rows = {r.doc_id: r for r in kept.collect()}
        assert all(before[i] == r for i, r in rows.items())
        if name == "language_id":
            want = {r.doc_id for r in language_id.predict_languages(docs, language_id.learn(docs)).collect() if r.lang_pred != "und" and r.score >= 0.5}
        elif name == "toxicity":
            want = {r.doc_id for r in toxicity.score_texts(docs, toxicity.learn(docs, common.table(spark, sf, "labels"))).collect() if r.score < 0.3}
        elif name == "near_dedup":
            want = {r.class_id for r in near_dedup.near_duplicates(docs).collect()}
        else:
            want = set(before) - {r.doc_id for r in decontaminate.find_leaks(docs, common.table(spark, sf, "benchmark")).collect()}
        assert set(rows) == want and want
        docs = spark.createDataFrame(list(rows.values()), docs.schema)
        before = rows
    library = Tokenizer.from_file(common.tokenizer_file())
    for r in corpus_pipeline.STAGES[-1][1](spark, docs, sf).collect():
        assert r.token_ids == library.encode(before[r.doc_id].text, add_special_tokens=False).ids and r.n_tokens == len(r.token_ids)


def test_whole_run_gives_the_stages_rows(spark, sf):
    got = corpus_pipeline.run(spark, sf)
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "token_ids"]
    n = got.count()
    assert 0.5 * common.table(spark, sf, "documents").count() < n == got.select("doc_id").distinct().count()


def test_nulls_repeats_and_empty_tables(spark, sf, tmp_path):
    from pyspark.sql import functions as F

    docs = common.table(spark, sf, "documents")
    plain = docs.filter("lang = 'en'").orderBy("doc_id").limit(1)
    text = "the people of the city said that they would have been there for all of the time"
    odd = [plain.withColumn("doc_id", F.lit(i).cast("long")).withColumn("text", F.lit(t)) for i, t in ((None, text), (-2, None), (-3, ""), (-4, text), (-4, text))]
    for part in odd:
        docs = docs.unionByName(part.select(docs.columns))
    for folder, rows in (("odd", docs), ("none", docs.limit(0))):
        rows.write.parquet(f"{tmp_path}/{folder}/documents.parquet")
        for name in ("labels", "benchmark"):
            common.table(spark, sf, name).write.parquet(f"{tmp_path}/{folder}/{name}.parquet")
    size = spark.conf.get(corpus_pipeline.BATCH[0])
    got = [r.doc_id for r in corpus_pipeline.run(spark, f"{tmp_path}/odd").select("doc_id").collect()]
    assert -2 not in got and -3 not in got and got.count(-4) + got.count(None) == 1  # one of each group of copies
    assert corpus_pipeline.run(spark, f"{tmp_path}/none").count() == 0
    assert spark.conf.get(corpus_pipeline.BATCH[0]) == size


def test_every_stage_by_itself_sends_small_batches(spark, sf):
    docs = common.table(spark, sf, "documents").limit(50)
    before = spark.conf.get(corpus_pipeline.BATCH[0])
    try:
        for _, stage in corpus_pipeline.STAGES:
            spark.conf.set(corpus_pipeline.BATCH[0], "10000")
            stage(spark, docs, sf)
            sizes = spark.range(0, 5000, 1, 1).mapInArrow(lambda batches: (pa.RecordBatch.from_pydict({"n": [b.num_rows]}) for b in batches), "n long")
            assert max(r.n for r in sizes.collect()) == 1000
    finally:
        spark.conf.set(corpus_pipeline.BATCH[0], before)


def test_workers_return_unused_memory():
    def anonymous_mb():
        return sum(int(line.split()[1]) for line in Path("/proc/self/smaps_rollup").read_text().splitlines() if line.startswith("Anonymous:")) / 1024

    held = []

    def run(batches):
        for batch in batches:
            texts = [bytes(2000) for _ in range(50_000)]
            held.extend(texts[::1000])  # a few that stay keep the memory around them from being returned by itself
            held.append(anonymous_mb())
            yield batch

    batch = pa.RecordBatch.from_pydict({"n": [1]})
    assert [b.num_rows for b in common.tidy(run)(iter([batch]))] == [1]
    assert held[-1] - anonymous_mb() > 60

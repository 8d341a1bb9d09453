"""The stages of the pipeline, each on its own input."""

import re

import corpus_pipeline
from tradepanel.llm import near_dedup, quality


def test_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = docs
    for name, stage in corpus_pipeline.STAGES:
        after = corpus_pipeline.stored(stage(spark, before, sf_dir), "test")
        ids = {r.doc_id for r in before.select("doc_id").collect()}
        assert {r.doc_id for r in after.select("doc_id").collect()} <= ids, name
        if name != corpus_pipeline.STAGES[-1][0]:
            assert after.columns == docs.columns
            assert after.dtypes == docs.dtypes
        if name == "near-duplicates":
            sets = [set(near_dedup.shingle_set(r.text).tolist()) for r in after.collect()]
            sets = [s for s in sets if s]
            assert not any(100 * len(a & b) >= 80 * len(a | b) for i, a in enumerate(sets) for b in sets[:i])
        before = after
    assert after.count() > 0


def test_documents_without_labels_stay(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    spark.read.parquet(f"{sf_dir}/labels.parquet").where("false").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.good_documents(spark, docs, str(tmp_path)).count() == docs.count()
    assert quality.THRESHOLD == 0.3


def test_line_dedup_takes_short_copies(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    after = corpus_pipeline.distinct_lines(spark, docs, sf_dir).collect()
    lines = [tuple(w for w in re.split(r"[ \t-\r]+", x.lower()) if w) for r in after if r.text for x in r.text.split("\n")]
    lines = [x for x in lines if x]
    assert len(lines) == len(set(lines))
    rows = [(1, "All rights reserved.\n\nfirst"), (2, "all  RIGHTS reserved.\n\nsecond"), (3, "All rights kept."), (4, "First")]
    small = docs.limit(0).unionByName(
        spark.createDataFrame(rows, "doc_id bigint, text string"), allowMissingColumns=True
    )
    found = {r.doc_id: r.text for r in corpus_pipeline.distinct_lines(spark, small, sf_dir).collect()}
    assert found == {1: rows[0][1], 2: "\nsecond", 3: "All rights kept."}


def test_near_documents_from_four_fifths_go(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    words = [f"w{i}" for i in range(104)]
    near = words[:10] + ["x"] + words[11:60] + ["y"] + words[61:]  # 90 of 110 shingles shared
    far = words[:10] + ["x"] + words[11:40] + ["y"] + words[41:70] + ["z"] + words[71:]  # 85 of 115
    rows = [(1, " ".join(words)), (2, " ".join(near)), (3, " ".join(far).replace("w", "v")), (4, " ".join(words).replace("w", "v"))]
    small = docs.limit(0).unionByName(spark.createDataFrame(rows, "doc_id bigint, text string"), allowMissingColumns=True)
    after = corpus_pipeline.distinct_documents(spark, docs, sf_dir)
    sets = [set(near_dedup.shingle_set(r.text).tolist()) for r in after.collect()]
    sets = [s for s in sets if s]
    assert not any(100 * len(a & b) >= 80 * len(a | b) for i, a in enumerate(sets) for b in sets[:i])
    found = corpus_pipeline.distinct_documents(spark, small, sf_dir).collect()
    assert sorted(r.doc_id for r in found) == [1, 3, 4]


def test_repeated_rows_and_rows_without_id(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    text, other = (" ".join(f"{x}{i}" for i in range(30)) for x in "ab")
    rows = [(1, text, "en"), (1, text, "de"), (1, text, "de"), (2, text, "en"), (None, text, "en"), (None, text.upper(), "en")]
    rows += [(None, other, "fr"), (None, other, "de"), (None, "", "en"), (None, None, "en"), (5, "c d e", "en"), (5, "f g h", "en")]
    small = docs.limit(0).unionByName(
        spark.createDataFrame(rows, "doc_id bigint, text string, lang string"), allowMissingColumns=True
    )
    after = corpus_pipeline.distinct_documents(spark, small, sf_dir)
    assert after.dtypes == docs.dtypes
    found = sorted(((r.doc_id, r.text, r.lang) for r in after.collect()), key=repr)
    wanted = [(1, text, "de"), (None, other, "de"), (None, "", "en"), (None, None, "en"), (5, "c d e", "en"), (5, "f g h", "en")]
    assert found == sorted(wanted, key=repr)


def of_texts(docs, spark, rows):
    small = spark.createDataFrame(rows, "doc_id bigint, text string")
    return docs.limit(0).unionByName(small, allowMissingColumns=True)


def test_stages_on_no_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        assert corpus_pipeline.stored(stage(spark, docs, sf_dir), "empty").count() == 0, name


def test_leaked_items_go_and_clean_documents_stay(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    items = [r.text for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect() if len(r.text.split()) > 12]
    rows = [(1, "before " + items[0].upper() + " after"), (2, "nothing of the kind"), (3, None), (4, ""), (5, " ".join(items[1].split()[:5]))]
    after = corpus_pipeline.clean_documents(spark, of_texts(docs, spark, rows), sf_dir)
    assert after.dtypes == docs.dtypes
    assert sorted(r.doc_id for r in after.collect()) == [2, 3, 4, 5]


def test_encoded_texts(spark, sf_dir):
    import hashlib

    from tokenizers import Tokenizer

    library = Tokenizer.from_file(corpus_pipeline.WORD_BPE)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [(1, "A  text, isn't it?"), (1, "A  text, isn't it?"), (2, None), (3, "")]
    found = corpus_pipeline.encoded_documents(spark, of_texts(docs, spark, rows), sf_dir).collect()
    assert sorted(r.doc_id for r in found) == [1, 1, 2, 3]
    for row in found:
        ids = library.encode(dict(rows)[row.doc_id] or "", add_special_tokens=False).ids
        assert (row.ids, row.n_tokens) == (ids, len(ids))
        assert row.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()

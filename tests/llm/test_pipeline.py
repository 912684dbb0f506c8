import corpus_pipeline
from cases import documents, edge_texts, empty, words
from test_ngram_join import family

HEX = "d48fd8e940a86f41832370bc4dd81bc9d95bf72b"


def write(spark, folder, docs):
    docs.write.parquet(f"{folder}/documents.parquet")
    bench = words(900, 40)
    spark.createDataFrame([(0, bench)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return bench


def test_stages_take_effect(spark, tmp_path):
    import random
    copies = family(40, 6, 100, 2, random.Random(2))
    texts = edge_texts() + copies + [words(50, 60) + " " + words(900, 40), words(51, 50) + f" token={HEX} " + words(52, 9),
                                     "you idiot, you moron, you stupid idiot " + words(53, 20), words(54, 5000)]
    docs = documents(spark, texts, clash=False)
    write(spark, str(tmp_path), docs)
    now, seen = spark.read.parquet(f"{tmp_path}/documents.parquet"), {}
    for k, (name, step) in enumerate(corpus_pipeline.STAGES):
        now = step(spark, now, str(tmp_path))
        if k < 4:
            assert now.columns == docs.columns
        path = f"{tmp_path}/{name}"
        now.write.parquet(path)
        now = spark.read.parquet(path)
        seen[name] = now.collect()
    ids = {name: {r["doc_id"] for r in rows} for name, rows in seen.items()}
    n = len(edge_texts())
    toxic, leak, secret, long = n + 8, n + 6, n + 7, n + 9
    assert ids["toxicity"] == set(range(len(texts))) - {toxic}
    assert ids["ngram_join"] == ids["toxicity"] - {4, 6} - set(range(n + 1, n + 6))
    assert ids["decontamination"] == ids["ngram_join"] - {leak}
    by = {r["doc_id"]: r for r in seen["secret_scan"]}
    assert set(by) == ids["decontamination"] and HEX not in by[secret]["text"] and by[long]["text"] == texts[long]
    assert by[secret]["n_chars"] == len(by[secret]["text"])
    assert ids["packing"] == ids["decontamination"]


def test_clashing_columns_and_repeated_ids(spark, tmp_path):
    """Extra columns go through, an id with several texts loses only what is to go."""
    extra = [(3, words(60, 50)), (3, words(61, 50)), (4, words(61, 50)), (5, words(62, 50)), (5, words(62, 50)), (None, words(60, 50)), (None, None),
             (6, words(63, 30) + f" token={HEX}"), (6, words(64, 30) + " " + words(900, 40)), (7, None), (8, "")]
    docs = documents(spark, [])
    fields = [f.name for f in docs.schema]
    rows = [tuple({"doc_id": i, "text": t, "lang": "en", "source": "s", "n_chars": len(t or "")}.get(f, "x") for f in fields) for i, t in extra]
    docs = spark.createDataFrame(rows, docs.schema).selectExpr("*", "'x' as _id", "'x' as _of_id", "'x' as comp", "'x' as hub", "'x' as _base")
    write(spark, str(tmp_path), docs.repartition(3))
    now = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for k, (name, step) in enumerate(corpus_pipeline.STAGES):
        now = step(spark, now, str(tmp_path))
        if k < 4:
            assert now.columns == docs.columns
            now.write.parquet(f"{tmp_path}/{name}")
            now = spark.read.parquet(f"{tmp_path}/{name}")
        if name == "secret_scan":
            kept = now.select("doc_id", "text").collect()
    got = sorted(((r["doc_id"], r["text"]) for r in kept), key=str)
    secret = next(t for i, t in got if i == 6)
    assert HEX not in secret and secret.startswith(words(63, 30))
    assert got == sorted([(3, words(60, 50)), (3, words(61, 50)), (5, words(62, 50)), (None, words(60, 50)), (None, None), (6, secret), (7, None), (8, "")], key=str)
    assert now.count() >= len(got)


def test_documents_without_n_chars(spark):
    docs = spark.createDataFrame([(1, f"x token={HEX}")], "doc_id long, text string")
    out = corpus_pipeline.hide_secrets(spark, docs, "").collect()
    assert len(out) == 1 and HEX not in out[0]["text"]


def test_run_on_an_empty_table(spark, tmp_path):
    write(spark, str(tmp_path), empty(spark))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_stage_names():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "ngram_join", "decontamination", "secret_scan", "packing"]

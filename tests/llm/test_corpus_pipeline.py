"""The pipeline's stages on a small table: what goes, what stays, and the columns."""

import corpus_pipeline
from delivery_lake.llm import op2_secrets, op4_fm_index, op5_simhash, op7_langid


def test_stages_and_run(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "language_id", "simhash_near_dedup", "benchmark_decontamination", "secret_scan", "sentencepiece"]
    out = corpus_pipeline.run(spark, sf_small).cache()
    assert out.columns[:5] == docs.columns and set(out.columns[5:]) == {"token_ids", "n_tokens", "lossless"}
    assert out.where("not lossless").count() == 0
    # brute force: language, then the smallest id of every group, then cut and masked texts
    langs, prototypes = op7_langid.train(docs, op7_langid.training_rows())
    known = {r.doc_id for r in op7_langid.predict(docs, langs, prototypes, ["doc_id"]).collect()
             if r.lang_pred != "und" and r.score >= op7_langid.LEAST_SCORE}
    texts = {r.doc_id: r.text for r in docs.collect() if r.doc_id in known}
    prints = {d: op5_simhash.fingerprint(t.encode()) for d, t in texts.items()}
    root = {p: p for p in prints.values()}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p

    for a in root:
        for b in root:
            if (a ^ b).bit_count() <= 3:
                root[find(a)] = find(b)
    least = {}
    for d, p in prints.items():
        least[find(p)] = min(least.get(find(p), d), d)
    got = {r.doc_id: r for r in out.collect()}
    assert set(got) == set(least.values())
    hits = {r.doc_id: r.spans for r in op4_fm_index.find_hits(docs, spark.read.parquet(f"{sf_small}/benchmark.parquet")).collect()}
    for d, r in got.items():
        want = op2_secrets.masked(op4_fm_index.without_words(texts[d], hits[d]))
        assert r.text == want and r.n_chars == len(want) and r.n_tokens == len(r.token_ids)


def test_empty_documents(spark, sf_small, tmp_path):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    docs.limit(0).write.parquet(str(tmp_path / "documents.parquet"))
    spark.read.parquet(f"{sf_small}/benchmark.parquet").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_odd_rows_by_what_was_planted(spark, tmp_path):
    """Null, repeated and clashing ids, null and long texts, ties, extra columns with clashing names: what
    must go and what must stay is known from how the rows are made, not from the operators."""
    import random

    rng = random.Random(17)
    words = "the river and a stone of green water walks over under never again to every house in town".split()
    prose = lambda n=70: " ".join(rng.choice(words) + rng.choice(["", "", "s", "ly", "ing"]) for _ in range(n))
    plain = [prose() for _ in range(40)]
    phrase = "which benchmark phrase of exactly twelve words is hidden in this text"
    secret = "token = Zk3Jq9Xw7Lr2Tn8Vb4Hc"
    rows = [(i, t, "en") for i, t in enumerate(plain)]
    rows += [(1000 + i, plain[i], "en") for i in range(5)]  # copies with larger ids go
    rows += [(7, prose(), "en"), (8, None, "en"), (50, "", None), (51, "123 456 !?", "en")]  # a clashing id stays, letterless go
    rows += [(None, plain[3], "en"), (None, plain[3], "en"), (None, None, "en")]  # without an id, with a letter: stay
    rows += [(60, f"{plain[20][:120]} {phrase} {prose(40)}", "en"), (61, f"{prose(30)} {secret} {prose(30)}", "en"), (62, prose(40_000), "en")]
    rows += [rows[0], rows[0]]  # repeated rows are copies
    docs = spark.createDataFrame([r + ("s", len(r[1] or ""), "x", "y", "z", 1.0) for r in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long, row string, spans string, fp string, score double")
    docs.repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, phrase), (2, None), (3, "")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    found = corpus_pipeline.run(spark, str(tmp_path)).collect()
    got = sorted(((r.doc_id, r.text) for r in found), key=repr)
    cut = {60: rows[-5][1].replace(" " + phrase, ""), 61: rows[-4][1].replace(secret, "[SECRET]")}
    assert rows[-5][0] == 60 and rows[-4][0] == 61
    want = [(i, t) for i, t in enumerate(plain)] + [(7, rows[45][1]), (60, cut[60]), (61, cut[61]), (62, rows[-3][1]), (None, plain[3]), (None, plain[3])]
    clean = lambda x: sorted(((d, " ".join(t.split())) for d, t in x), key=repr)
    assert clean(got) == clean(want)
    assert all(r.lossless and r.n_chars == len(r.text) and r.row == "x" and r.score == 1.0 for r in found)

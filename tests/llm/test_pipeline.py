import corpus_pipeline
from helpers_llm import no_documents, odd_documents
from pyspark.sql import functions as F

from layerwise.llm import decontamination, language, packing, simhash, toxicity
from layerwise.llm.common import table


def test_stages_name_their_operators():
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "language_id", "toxicity", "simhash_near_dedup", "benchmark_decontamination", "best_fit_packing",
    ]


def test_pipeline_against_its_operators(spark, sf_dir):
    """Each stage on what the one before kept, decided again row by row on the driver."""
    docs = table(spark, sf_dir, "documents")
    profiles = language.learn(docs)
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    scores = {r[0]: r[1] for r in docs.select("doc_id", model.score(docs["text"])).collect()}
    kept = {r["doc_id"]: r["text"] for r in docs.collect()}
    kept = {i: t for i, t in kept.items() if profiles.nearest(t)[0] != "und" and profiles.nearest(t)[1] >= 0.3}
    kept = {i: t for i, t in kept.items() if scores[i] < 0.5}
    prints = {i: simhash.fingerprint(t) for i, t in kept.items()}
    label = {f: f for f in prints.values()}

    def root(f):
        while label[f] != f:
            f = label[f]
        return f

    distinct = list(label)
    for k, a in enumerate(distinct):
        for b in distinct[k + 1 :]:
            if (a ^ b).bit_count() <= 4:
                label[root(a)] = root(b)
    groups = {}
    for i, f in prints.items():
        groups.setdefault(root(f), []).append(i)
    kept = {min(g): kept[min(g)] for g in groups.values()}
    items = [(str(i), t) for i, t in table(spark, sf_dir, "benchmark").select("item_id", "text").collect()]
    phrases = decontamination.Phrases(items, decontamination.WINDOW)
    rows = corpus_pipeline.run(spark, sf_dir).collect()
    assert {r["doc_id"] for r in rows} == set(kept)
    clean = {i for i, t in kept.items() if not decontamination.search_shard([t], phrases)[0][1]}
    packed = {(r["doc_id"], r["piece"], r["ids_crc32"]) for r in rows}
    expected = packing.token_pieces(docs, 2048).collect()
    for r in expected:
        if r["doc_id"] in clean:
            assert (r["doc_id"], r["piece"], r["ids_crc32"]) in packed
    assert len(kept) < docs.count() and len(clean) < len(kept)


def test_stages_bear_odd_documents(spark, sf_dir):
    columns = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    rows = [(1, "The cat is on the mat.", "en", "s", 22), (2, None, None, None, None), (None, "", "en", "s", 0), (3, "???", "en", "s", 3), (4, "mot " * 50_000, "fr", "s", 1), (1, "The cat is on the mat.", "en", "s", 22)]
    for docs in (spark.createDataFrame(rows, columns), spark.createDataFrame([], columns)):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, sf_dir)
            if name != corpus_pipeline.STAGES[-1][0]:
                assert out.columns == docs.columns
            found = out.collect()
            if name == "language_id" and docs.count():
                assert {r["doc_id"] for r in found} == {1, 4}
    assert no_documents(spark).count() == 0


def test_stages_bear_any_column_names(spark, sf_dir):
    names = ["__id", "__fp", "__root", "__rows", "__found", "__score", "__clean", "found", "score", "fp", "root", "component_id"]
    docs = odd_documents(spark).select("doc_id", "text", *[F.lit(i).alias(c) for i, c in enumerate(names)])
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf_dir)
        assert out.columns == docs.columns
        assert all(list(r)[2:] == list(range(len(names))) for r in out.collect())

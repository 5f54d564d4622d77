"""The pipeline and the registered queries."""

import random

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from tests.llm.test_python import plain_components, plain_fingerprint, plain_overlap


def test_every_operator_is_registered():
    names = [n for n in queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14)) and "pipeline" in queries()
    assert {"op1_curriculum_mix", "op3_line_chunks", "op7_winnowing", "op11_prefix_trie"} <= set(oracle_sql())


def test_stages_against_plain_python(spark, tmp_path, documents, labels):
    draw = random.Random(12)
    words = lambda n: ["w%d" % draw.randrange(10**6) for _ in range(n)]
    item = " ".join(words(15))
    texts = {}
    for i in range(120):
        own = words(draw.randrange(10, 80))
        if i % 10 == 3:
            own[5:5] = item.split()
        texts[i] = " ".join(own)
        if i % 7 == 6:
            texts[i] = texts[i - 1] if i % 2 else texts[i - 1].upper()
    texts[120], texts[121] = None, "x y " * 100
    folder = str(tmp_path)
    docs = documents(*((i, t, "src%d" % (i % 3)) for i, t in texts.items()))
    docs.write.parquet(f"{folder}/documents.parquet")
    labels((0, 1, 0)).write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    stage, got = spark.read.parquet(f"{folder}/documents.parquet"), {}
    for name, function in corpus_pipeline.STAGES:
        stage = function(spark, stage, folder)
        stage.write.parquet(f"{folder}/out-{name}")
        stage = spark.read.parquet(f"{folder}/out-{name}")
        got[name] = stage
    ids = lambda name: sorted(r.doc_id for r in got[name].select("doc_id").collect())
    kept = [i for i, t in texts.items() if t and len(t.split()) >= 20 and i != 121]
    assert ids("quality_rules") == kept
    prints = {i: plain_fingerprint(texts[i]) for i in kept}
    root, chosen = plain_components(set(prints.values())), {}
    for i in kept:
        chosen.setdefault(root[prints[i]], i)
    assert ids("near_duplicates") == sorted(chosen.values())
    clean = [i for i in sorted(chosen.values()) if not plain_overlap(texts[i], [(1, item)])[4]]
    assert ids("benchmark_decontamination") == clean and len(clean) < len(chosen)
    mixed = got["source_mix"]
    assert mixed.columns == docs.columns and set(ids("source_mix")) <= set(clean)
    total = sum(len(texts[i].split()) for i in clean)
    assert abs(sum(len(r.text.split()) for r in mixed.collect()) - 1.5 * total) <= 3 * 40
    final = got["shards"].collect()
    assert sorted(r.doc_id for r in final) == ids("source_mix")
    sizes = [sum(r.shard == s for r in final) for s in range(40)]
    assert max(sizes) - min(sizes) <= 1
    again = corpus_pipeline.run(spark, folder)
    assert sorted((r.doc_id, r.shard, r.slot) for r in again.collect()) == sorted((r.doc_id, r.shard, r.slot) for r in final)

"""Stages that carry whole rows send each text to the workers once."""

import corpus_pipeline
from gnomon.llm import op3_language, op7_decontaminate


def test_a_text_inside_a_row_gives_what_one_beside_it_gives(spark, tmp_path, monkeypatch):
    prose = [" ".join(f"{w}{k % 7}word" for k in range(30)) for w in ("der", "the")]
    rows = [(i, prose[i % 2] if i % 5 else None, ("de", "en")[i % 2]) for i in range(40)] + [(40, "", None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").coalesce(1)
    items = spark.createDataFrame([(1, " ".join(prose[1].split()[3:15]))], "item_id bigint, text string")
    whole, model = corpus_pipeline.rows_of(docs), op3_language.fit(docs)
    key = lambda r: (r["row"]["doc_id"], *(str(x) for x in r[1:]))
    for find in (lambda d, **k: op3_language.identify(d, model, keys=("row",), **k), lambda d, **k: op7_decontaminate.find(d, items, keys=("row",), **k)):
        inside, beside = find(whole, within="row"), find(whole.select("row", "row.text"))
        assert inside.columns == beside.columns
        assert sorted(map(key, inside.collect())) == sorted(map(key, beside.collect()))
    items.write.parquet(f"{tmp_path}/benchmark.parquet")
    asked = []
    for module, name in ((op3_language, "identify"), (op7_decontaminate, "find")):
        plain = getattr(module, name)
        monkeypatch.setattr(module, name, lambda d, *a, _plain=plain, **k: (asked.append(d.columns), _plain(d, *a, **k))[1])
    for stage in (corpus_pipeline.language, corpus_pipeline.decontaminate):
        stage(spark, docs, str(tmp_path)).count()
    assert asked == [["row"], ["row"]]

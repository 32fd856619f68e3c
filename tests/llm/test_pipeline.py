import corpus_pipeline
from tempestry.llm import mixing, packing, quality, secret_scan, simhash
from tests.llm.cases import SF, awkward, empty
from tests.llm.test_quality import slow_base
from tests.llm.test_simhash import slow_components


def test_stages_over_the_tables(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    good = corpus_pipeline.quality_rules(spark, docs, SF).cache()
    assert good.columns == columns
    assert {r.doc_id for r in good.collect()} <= {r.doc_id for r in docs.collect() if not slow_base(r.text)[-1]}
    single = corpus_pipeline.near_dedup(spark, good, SF).cache()
    rows = [(r.doc_id, r.text) for r in good.collect()]
    assert sorted(r.doc_id for r in single.collect()) == sorted({c for _, _, c in slow_components(rows)})
    clean = corpus_pipeline.secret_scans(spark, single, SF).cache()
    assert {r.doc_id: r.text for r in clean.collect()} == {r.doc_id: secret_scan.redact(r.text) for r in single.collect()}
    mix = corpus_pipeline.source_mix(spark, clean, SF).cache()
    taken = sum(r.taken for r in mixing.mix_sources(clean).collect())
    assert sum(len(r.text.encode().split()) for r in mix.collect()) == taken
    assert single.columns == clean.columns == mix.columns == columns
    pieces = corpus_pipeline.sequence_packing(spark, mix, SF).collect()
    final = corpus_pipeline.run(spark, SF).collect()
    part = lambda rows: sorted(tuple(r)[:5] for r in rows)
    assert part(pieces) == part(final) and len(final) >= mix.count()


def test_stages_take_awkward_and_empty_tables(spark):
    for docs in (awkward(spark), empty(spark)):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            after = stage(spark, docs, SF)
            assert after.columns == docs.columns, name
            after.collect()
        corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()


def test_stages_are_the_operators():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "near_dedup", "secret_scans", "source_mix", "sequence_packing"]
    assert all(m.__doc__ for m in (mixing, packing, quality, secret_scan, simhash))

import pytest

import corpus_pipeline
from agencylens.llm import decontaminate, mixing, toxicity
from agencylens.llm.shared import stored, table
from tests.llm.test_similar import survivors


def test_stages_and_their_columns():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "near duplicates", "decontamination", "mixing", "sharding"]


def test_run_equals_the_decisions_one_by_one(spark, small):
    docs = table(spark, small, "documents")
    ids = lambda df: sorted(r["doc_id"] for r in df.select("doc_id").collect())
    rejected = {r["doc_id"] for r in toxicity.toxicity_report(docs, table(spark, small, "labels")).filter("predicted = 1").collect()}
    kept = stored(corpus_pipeline.reject_toxic(spark, docs, small))
    assert kept.columns == docs.columns and ids(kept) == [i for i in ids(docs) if i not in rejected]
    single = stored(corpus_pipeline.drop_near_duplicates(spark, kept, small))
    assert single.columns == docs.columns and ids(single) == survivors([(r["doc_id"], r["text"]) for r in kept.collect()])
    report = decontaminate.decontamination_report(single, table(spark, small, "benchmark")).collect()
    clean = stored(corpus_pipeline.decontaminated(spark, single, small))
    assert clean.columns == docs.columns and ids(clean) == sorted(r["doc_id"] for r in report if not r["contaminated"])
    mix = stored(corpus_pipeline.mix_sources(spark, clean, small))
    copies = {r["doc_id"]: r["taken"] // r["size"] for r in mixing.mixing_report(clean).collect() if r["size"]}
    assert mix.columns == docs.columns and [i for i in ids(mix) if i in copies] == sorted(i for i, n in copies.items() for _ in range(n))
    assert ids(corpus_pipeline.shard(spark, mix, small)) == ids(mix) == ids(corpus_pipeline.run(spark, small))


def test_stages_of_empty_tables(spark, small):
    none = table(spark, small, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, none, small).collect() == []


def test_a_cluster_must_name_its_shared_folder(monkeypatch):
    from agencylens.llm import shared

    class Empty:
        def isEmpty(self):
            return True

    class Session:
        class sparkContext:
            master = "spark://somewhere"

            class _jsc:
                @staticmethod
                def sc():
                    class Context:
                        getCheckpointDir = staticmethod(Empty)

                    return Context()

        class conf:
            @staticmethod
            def get(_, default):
                return default

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared.shared_folder(Session)

import corpus_pipeline
from tripmart.llm import catalog
from tripmart.llm.decontaminate import words_of
from tripmart.llm.toxicity import Matcher, learn

from .test_exact_dedup import brute as equal_groups
from .test_packing import checked
from .test_simhash import roots_of, slow_fingerprint


def test_stages_equal_brute_force(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, texts = docs.columns, {r.doc_id: r.text for r in docs.collect()}
    steps = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = spark.createDataFrame(stage(spark, docs, sf).collect(), docs.schema)
        assert docs.columns == columns
        steps.append({r.doc_id for r in docs.collect()})
    matcher = Matcher(learn(spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")))
    clean = {i for i, t in texts.items() if matcher.lexicon.curve(matcher.level(t)[0]) < 0.7}
    assert steps[0] == clean and 0.8 * len(texts) < len(clean) < len(texts)

    unique = {min(g)[2] for g in equal_groups([(i, texts[i]) for i in sorted(clean)]).values()}
    assert steps[1] == unique < clean

    fps = {i: slow_fingerprint(texts[i]) for i in sorted(unique)}
    assert steps[2] == set(roots_of(sorted(fps), lambda a, b: (fps[a] ^ fps[b]).bit_count() <= 2).values())

    items = [b" ".join(words_of(r.text)) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    holds = {i for i in steps[2] if any(b" %b " % x in b" %b " % b" ".join(words_of(texts[i])) for x in items)}
    assert holds and not holds & steps[3]
    # beyond verbatim passages only near ones go, and there are few
    assert len(steps[2] - holds - steps[3]) <= 0.01 * len(steps[2])

    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, sf).collect()
    assert checked(pieces, [(i, texts[i]) for i in steps[3]], 4096) < 0.02


def test_run_and_registry(spark):
    import __spark_entry__ as entry

    names = set(entry.queries())
    assert set(catalog.QUERIES) | {"pipeline"} <= names and len(catalog.QUERIES) == 13
    assert {"op3_substring_dedup", "op7_exact_dedup", "op11_hard_negatives", "op12_conversation_repair"} <= set(entry.oracle_sql()) and "pipeline" not in entry.oracle_sql()
    rows = corpus_pipeline.run(spark, "/root/testdata/sf0.001").collect()
    assert rows and {r.doc_id for r in rows}


def test_stages_on_empty_and_odd_tables(spark, docs, edge_texts):
    """Nulls, empty and very long texts, repeated rows and clashing columns go through every stage, as does an empty table."""
    sf = "/root/testdata/sf0.001"
    for texts in ([], edge_texts):
        table = docs(texts)
        for name, stage in corpus_pipeline.STAGES[:-1]:
            kept = stage(spark, table, sf)
            assert kept.columns == docs(texts).columns
            table = spark.createDataFrame(kept.collect(), kept.schema)
        pieces = corpus_pipeline.STAGES[-1][1](spark, table, sf).collect()
        assert checked(pieces, [(r.doc_id, r.text) for r in table.collect()], 4096) <= 1 if texts else pieces == []

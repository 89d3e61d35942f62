import random

import corpus_pipeline
from helpers import words
from kinweld.llm import queries


def test_stages_in_turn(spark, tmp_path):
    from helpers import documents

    rng = random.Random(1)
    prose = lambda: words(rng, 150, 5000)
    base = prose()
    near = [*base[:-3], "other", "last", "words"]
    rows = [(1, " ".join(base)), (2, "  ".join(base)), (3, " ".join(near)), (4, "spam " * 400), (5, None)]
    rows += [(10 + k, " ".join(prose()), "en", f"s{k % 4}") for k in range(40)]
    docs = documents(spark, rows)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    held = spark.read.parquet(f"{tmp_path}/documents.parquet")
    seen = []
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        held = stage(spark, held, str(tmp_path))
        if k < len(corpus_pipeline.STAGES) - 1:
            assert held.columns == docs.columns, name
        held.write.parquet(f"{tmp_path}/{k}")
        held = spark.read.parquet(f"{tmp_path}/{k}")
        seen.append({r["doc_id"] for r in held.select("doc_id").collect()})
    clean = {10 + k for k in range(40)}
    assert seen[0] == clean | {1, 2, 3}
    assert seen[1] == clean | {2, 3}
    assert seen[2] == clean | {2}
    assert seen[3] == seen[4] and len(seen[3]) > 20
    assert sorted(map(tuple, corpus_pipeline.run(spark, str(tmp_path)).collect())) == sorted(map(tuple, held.collect()))


def test_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))
    assert set(queries.ORACLE_SQL) <= set(queries.QUERIES)

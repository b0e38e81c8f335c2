import pytest

import corpus_pipeline
from llm.common import stored
from llm.queries import ORACLES, QUERIES
from sample_texts import prose


@pytest.fixture(scope="module")
def world(spark, tmp_path_factory):
    """A folder of tables with planted cases: ids 0-9 toxic, 20-29 near copies, 40-44 benchmark passages, the rest clean."""
    item = prose(777, 60)
    rows = []
    for i in range(160):
        text = prose(i, 80)
        if i < 60 and i % 3 == 0 or i < 10:
            text += f" vile{i % 3} vile{(i + 1) % 3}"
        if 20 <= i < 30:
            text = prose(20, 120) + f" tail{i}"
        if 40 <= i < 45:
            text += "\n" + item
        rows.append((i, text + ("\nShared footer of the site" if i % 2 else ""), "en", f"s{i % 2}", len(text)))
    rows += [(None, None, None, None, None), (500, "", "en", "s0", 0), (501, prose(20, 120), None, None, 1)]
    labels = [(i, 1, int("vile" in r[1])) for i, r in enumerate(rows[:160])]
    folder = str(tmp_path_factory.mktemp("tables"))
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder


def test_stages_take_effect_and_keep_clean_documents(spark, world):
    docs = spark.read.parquet(f"{world}/documents.parquet")
    columns, seen = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stored(stage(spark, docs, world), "stage")
        assert docs.columns == columns
        seen[name] = {r.doc_id: r.text for r in docs.collect()}
    toxic = {i for i in range(160) if (i < 60 and i % 3 == 0 or i < 10) and not 20 <= i < 30}
    assert len(toxic & set(seen["toxicity"])) <= 2
    assert set(range(60, 160)) | {None, 500, 501} <= set(seen["toxicity"])
    assert set(seen["line_dedup"]) == set(seen["toxicity"])
    assert not any(t and "Shared footer" in t for t in seen["line_dedup"].values())
    assert set(seen["jaccard_join"]) & set(range(20, 30)) == {20} and 501 not in seen["jaccard_join"]
    assert set(seen["line_dedup"]) - set(seen["jaccard_join"]) <= {*range(21, 30), 501}
    assert set(seen["decontamination"]) == set(seen["jaccard_join"])
    for i, t in seen["decontamination"].items():
        assert (t != seen["jaccard_join"][i]) == (i in range(40, 45))


@pytest.mark.parametrize("empty", ["labels", "benchmark", "documents"])
def test_empty_tables(spark, world, tmp_path, empty):
    """Without labels or benchmark the stage keeps all; without documents there is nothing to pack."""
    for name in ("documents", "labels", "benchmark"):
        table = spark.read.parquet(f"{world}/{name}.parquet")
        (table.limit(0) if name == empty else table).write.parquet(f"{tmp_path}/{name}.parquet")
    ids = {r.doc_id for r in corpus_pipeline.run(spark, str(tmp_path)).select("doc_id").distinct().collect()}
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    gone = {r.doc_id for r in docs.select("doc_id").collect()} - ids
    if empty == "documents":
        assert ids == set()
    elif empty == "labels":
        assert gone == {*range(21, 30), 501}
    else:
        assert {*range(21, 30), 501} <= gone and not gone & set(range(60, 160))


def test_run_packs_all_that_is_left(spark, world):
    out = corpus_pipeline.run(spark, world)
    ids = {r.doc_id for r in out.select("doc_id").distinct().collect()}
    assert {60, 159, None, 500} <= ids and not {21, 29, 501} & ids


def test_registration():
    assert {f"op{n}_" for n in range(1, 14)} <= {q.split("_")[0] + "_" for q in QUERIES if q != "pipeline"}
    assert QUERIES["pipeline"] is corpus_pipeline.run and corpus_pipeline.ORACLE_SQL is None
    assert set(ORACLES) <= set(QUERIES)
    assert len(corpus_pipeline.STAGES) == 5

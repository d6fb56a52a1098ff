import json
import math

import pytest
from pyspark.sql import functions as F

from gristmill.operators import boards, evaluation, patterns, runlogs


def records(spark, *objects):
    return spark.createDataFrame([(f"p{i}", json.dumps(o) if not isinstance(o, str) else o)
                                  for i, o in enumerate(objects)], "directory string, pattern string")


def read(spark, *objects):
    return patterns.normalize_pattern(records(spark, *objects), keep=("directory",))


def test_pattern_order(spark):
    rows = read(spark, {"name": "1", "final_score": 0.4},
                {"name": "2", "final_score": None, "scores": {"b": {"mean": 0.9}, "a": {"mean": 1}}},
                {"name": "3", "final_score": None}, {"name": "4", "final_score": 0.7},
                {"name": "5", "final_score": "n/a", "scores": {"x": {"mean": None},
                                                               "y": {"mean": 0.4}}},
                {"name": "6", "final_score": "0.8"})
    ranked = patterns.pattern_order(rows, "directory").orderBy("rank").collect()
    assert [r["name"] for r in ranked] == ["2", "6", "4", "1", "5", "3"]
    assert boards.best_row(patterns.pattern_order(rows, "directory")).first()["name"] == "2"


def test_three_layouts(spark):
    chunking = {"method": "fixed", "chunk_size": 10, "chunk_overlap": 1}
    legacy = {"rag_pattern": {"name": "old", "settings": {
        "chunking": chunking, "embedding": {"model_id": "e"}, "method": "window",
        "number_of_chunks": 3, "generation": {"model_id": "g"}}}}
    flat = {"name": "new", "settings": {
        "chunking": chunking, "embedding": {"model_id": "e"}, "generation": {},
        "foundation_model": "g", "retrieval": {"method": "simple", "number_of_chunks": 4,
                                               "ranker_strategy": "", "search_mode": "hybrid"}}}
    split = {"pattern_name": "split", "indexing_params": {
        "chunking": {"method": "x", "chunk_size": 5}, "embedding_model": "first",
        "retrieval.method": "flat key"},
        "rag_params": {"chunking": {"method": "y"}, "embedding": {"model_id": "e"},
                       "foundation_model": "g", "retrieval": {"ranker_strategy": {"b": 1, "a": 2}}}}
    empty = {"rag_pattern": {"settings": {}}, "settings": {}}
    rows = {r["name"]: r for r in read(spark, legacy, flat, split, empty, "not json").collect()}
    assert set(rows) == {"old", "new", "split", "—"}
    old, new, third = rows["old"], rows["new"], rows["split"]
    assert old["chunking.chunk_size"] == new["chunking.chunk_size"] == "10"
    for row in (old, new, third):
        assert row["generation.model_id"] == "g"
    assert old["embeddings.model_id"] == new["embeddings.model_id"] == "e"
    assert (old["retrieval.method"], old["retrieval.number_of_chunks"]) == ("window", "3")
    assert old["retrieval.search_mode"] is None and new["retrieval.search_mode"] == "hybrid"
    assert third["chunking.method"] == "y" and third["chunking.chunk_size"] is None
    assert third["embeddings.model_id"] == "first" and third["retrieval.method"] == "flat key"
    assert json.loads(third["retrieval.ranker_strategy"]) == {"a": 2, "b": 1}


def test_table_cells(spark):
    rows = read(spark, {"name": "a", "final_score": 0.5, "scores": {
        "zeta": {"mean": 0.12345}, "faithfulness": {"mean": 0.49755}},
        "settings": {"chunking": {"chunk_size": 7}}},
        {"name": "b", "final_score": 0.9, "scores": {"scores": {
            "context_correctness": {"mean": 1}, "zeta": {}}},
         "settings": {"retrieval": {"ranker_strategy": "rrf"}}})
    table = patterns.leaderboard_table(patterns.pattern_order(rows, "directory"), "zeta")
    assert table.columns == ["rank", "Pattern_Name", "mean_zeta", "mean_faithfulness",
                             "mean_context_correctness", *patterns.CONFIG_COLUMNS]
    first, second = table.orderBy("rank").collect()
    assert (first["Pattern_Name"], first["mean_zeta"], first["mean_context_correctness"]) == (
        "b", "", "1.0000")
    assert first["retrieval.ranker_strategy"] == "rrf"
    assert (second["mean_zeta"], second["mean_faithfulness"]) == ("%.4f" % 0.12345, "%.4f" % 0.49755)
    assert second["retrieval.ranker_strategy"] == "-" and second["chunking.chunk_size"] == "7"


def test_built_patterns_read_back(spark):
    df = spark.createDataFrame([("p", 512, "hybrid")], "name string, chunk_size int, search_mode string")
    built = json.loads(df.select(F.to_json(patterns.build_pattern(df)).alias("j")).first()["j"])
    settings = built["settings"]
    assert settings["chunking"] == {"method": "recursive", "chunk_size": 512, "chunk_overlap": 256}
    assert settings["retrieval"] == {"method": "simple", "number_of_chunks": 5,
                                     "search_mode": "hybrid"}
    assert settings["embedding"]["embedding_params"] == {"embedding_dimension": 768}
    assert settings["vector_store"]["datasource_type"] == "ls_milvus"
    back = read(spark, built).first()
    assert (back["name"], back["chunking.chunk_size"], back["retrieval.search_mode"]) == (
        "p", "512", "hybrid")


def test_leaderboard_directions(spark):
    df = spark.createDataFrame([("m1", 0.8), ("m2", 0.3), ("m3", 0.5), ("m4", None)],
                               "model string, e double")
    down = [r["model"] for r in boards.leaderboard(df, "e", "model").orderBy("rank").collect()]
    up = [r["model"] for r in boards.leaderboard(df, "e", "model", False).orderBy("rank").collect()]
    assert down == ["m1", "m3", "m2", "m4"] and up == ["m2", "m3", "m1", "m4"]
    assert [r["model"] for r in boards.top_n(df, "e", "model", 2).collect()] == ["m1", "m3"]


def test_model_board_paths(spark):
    models = spark.createDataFrame([("Model1", "s3://b/x/")], "model string, uri string")
    metrics = spark.createDataFrame([("Model1", 0.5)], "model string, r2 double")
    row = boards.model_board(models, metrics, "model", "uri").first()
    assert row["predictor"] == "s3://b/x/Model1/predictor/predictor.pkl"


def test_flatten_metrics(spark):
    results = {"custom_holdout_eval": {"alias": "x", "exact_match,none": 0.5, "name": "text"},
               "arc": {"alias": "ARC easy/hard", "acc,none": 1, "flag": True}, "bare": {"v": 2}}
    df = spark.createDataFrame([(json.dumps(results),)], "results string")
    rows = {r["metric"]: r["value"] for r in boards.flatten_metrics(df, "results").collect()}
    assert rows == {"holdout_exact_match,none": 0.5, "ARC_easy_hard_acc,none": 1.0,
                    "ARC_easy_hard_flag": 1.0, "bare_v": 2.0}


def test_run_metadata(spark):
    schema = "run string, metric string, value double"
    train = spark.createDataFrame([("r", "lr", 0.1), ("r", "display_name", 1.0)], schema)
    score = spark.createDataFrame([("r", "acc", 0.5)], schema)
    rows = {r["key"]: r["value"] for r in boards.merge_run_metadata(
        train, score, "run", {"pipeline_name": "p"}).collect()}
    assert rows == {"training_lr": "0.1", "eval_acc": "0.5", "pipeline_name": "p"}


def test_best_metric(spark):
    rows = [("r", 0, "a_acc,none", "0.5"), ("r", 1, "b_acc_norm,none", "0.5"),
            ("r", 2, "c_acc,stderr", "9"), ("r", 3, "d_acc,none", "text"), ("r", 4, "loss", "7"),
            ("s", 0, "z_acc,none", "text")]
    df = spark.createDataFrame(rows, "run string, place int, metric string, value string")
    got = {r["run"]: (r["eval_best_metric"], r["eval_best_score"])
           for r in boards.best_metric(df, "run", "place").collect()}
    assert got == {"r": ("a_acc,none", "0.5"), "s": ("z_acc,none", "text")}


def log(spark, *lines):
    return spark.createDataFrame([("r", i, t) for i, t in enumerate(lines)],
                                 "run string, line int, text string").repartition(3)


def test_training_summary(spark):
    row = runlogs.training_summary(log(
        spark, '{"loss":0,"avg_loss":2}', "", "bad{", '{"avg_loss":"1.5","lr":"x"}',
        '{"lr":0.25,"gradnorm":3,"step":7}', "[1]")).first()
    assert row["loss"] == 0 and row["final_loss"] == 1.5 and row["min_loss"] == 1.5
    assert row["steps"] == 2 and row["final_perplexity"] == pytest.approx(math.exp(1.5))
    assert (row["learning_rate"], row["grad_norm"], row["step"], row["epoch"]) == (0.25, 3, 7, None)


def test_loss_series_rules(spark):
    curve = runlogs.loss_curve(log(
        spark, '{"loss":"abc","avg_loss":4}', '{"loss":"0"}', '{"loss":null,"avg_loss":3}',
        '{"loss":"","avg_loss":2}', '{"loss":0.0}', '{"loss":false,"avg_loss":1}', '{"loss":1}'))
    assert [(r["step"], r["loss"]) for r in curve.orderBy("step").collect()] == [
        (1, 0.0), (2, 3.0), (3, 2.0), (4, 1.0), (5, 1.0)]
    low = runlogs.lowest_point(curve.filter("loss > 0")).first()
    assert (low["min_loss"], low["min_step"], low["steps"]) == (1.0, 4, 5)


def test_empty_log_and_cap(spark):
    row = runlogs.training_summary(log(spark, "nothing")).first()
    assert row["final_loss"] is None and row["final_perplexity"] is None
    row = runlogs.training_summary(log(spark, '{"loss":50}')).first()
    assert row["final_perplexity"] == pytest.approx(math.exp(10))


def test_evaluation_joins(spark):
    evaluations = spark.createDataFrame([(1,), (2,)], "question_id int")
    scored = spark.createDataFrame([(1, "b", 0.5), (1, "a", 0.25)],
                                   "question_id int, metric string, value double")
    rows = {r["question_id"]: r["scores"] for r in evaluation.attach_scores(
        evaluations, scored).collect()}
    assert rows == {1: {"a": 0.25, "b": 0.5}, 2: {}}
    found = evaluation.pattern_results(
        spark.createDataFrame([(1,), (2,)], "pattern_id int"),
        spark.createDataFrame([(1, "x")], "pattern_id int, answer string"))
    assert {(r[0], r[1]) for r in found.collect()} == {(1, "x"), (2, None)}

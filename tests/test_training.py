from eventide.plans import training
from eventide.sources.artifacts import load_pipeline_model, load_threshold

from conftest import SF_SMALL


def test_train_save_load_score(spark, tmp_dir):
    model, threshold, mpath, tpath, _ = training.train_from_tables(spark, SF_SMALL)
    assert threshold > 0
    assert load_threshold(spark, tpath) == threshold
    assert load_pipeline_model(spark, mpath) is not None
    scored = training.kmeans_train_score(spark, SF_SMALL)
    assert scored.filter("score <= threshold").count() == 0


def test_missing_model_means_no_model(spark, tmp_dir):
    assert load_pipeline_model(spark, f"{tmp_dir}/nope") is None
    assert load_threshold(spark, f"{tmp_dir}/nope") is None

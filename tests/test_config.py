import pytest

from eventide.config import EngineConfig, check_window, interval_seconds


@pytest.mark.parametrize("text,secs", [("5 seconds", 5), ("1 minute", 60), ("2 minutes", 120),
                                       ("1 hour", 3600), ("1 day", 86400),
                                       ("1 minute 30 seconds", 90), ("500 milliseconds", 0.5)])
def test_interval_seconds(text, secs):
    assert interval_seconds(text) == secs


def test_bad_intervals_and_windows():
    with pytest.raises(ValueError):
        interval_seconds("soon")
    with pytest.raises(ValueError):
        interval_seconds("3 fortnights")
    with pytest.raises(ValueError):
        check_window("0 seconds", None)
    check_window("1 minute", "5 seconds")
    check_window("5 seconds", None)


def test_config_validation_and_env():
    with pytest.raises(ValueError):
        EngineConfig(count_input="everything")
    cfg = EngineConfig.from_env({"WINDOW_SLIDE": "1 second", "MAX_LOCATION_LEN": "50",
                                 "ANOMALY_THRESHOLD": "7", "KAFKA_TOPIC": "t"})
    assert (cfg.window_slide, cfg.max_location_len, cfg.count_threshold, cfg.events_topic) == \
        ("1 second", 50, 7, "t")
    with pytest.raises(ValueError):       # slide longer than the 5 s window
        EngineConfig.from_env({"WINDOW_SLIDE": "30 seconds"})
    assert EngineConfig().with_(z_threshold=3.0).z_threshold == 3.0


def test_offsets_cap_is_off_unless_asked_for():
    assert EngineConfig().max_offsets_per_trigger is None
    assert EngineConfig.from_env({"MAX_OFFSETS_PER_TRIGGER": "500"}).max_offsets_per_trigger == 500


def test_a_cluster_needs_a_shared_folder():
    from types import SimpleNamespace

    import pytest

    from eventide.session import ensure_checkpoint_dir
    conf = SimpleNamespace(get=lambda *_: None)
    for master in ("yarn", "spark://host:7077", "local-cluster[2,1,1024]"):
        sc = SimpleNamespace(getCheckpointDir=lambda: None, getConf=lambda: conf, master=master)
        with pytest.raises(ValueError):
            ensure_checkpoint_dir(SimpleNamespace(sparkContext=sc, conf=conf))

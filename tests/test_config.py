import pytest

from duolect.config import JobConfig


def make(**changes):
    return JobConfig(**{"data_root": "/d", "output_root": "/o", "lang": "ru", "direction": "ruen", **changes})


def test_defaults_follow_the_settings_that_are_absent():
    cfg = JobConfig.from_mapping({"data_root": "/d", "output_root": "/o"}, "ru", "ruen")
    assert (cfg.min_duration, cfg.max_duration, cfg.tiers, cfg.use_manifest_text) == (0.0, 1e9, None, False)
    assert (cfg.exaggeration, cfg.target_bandwidth, cfg.text_column) == (0.9, 6.0, "text")


def test_settings_mapping_is_read():
    cfg = JobConfig.from_mapping(
        {"data_root": "/d", "output_root": "/o", "manifests": {"en": "/m.csv"},
         "pipeline": {"min_duration": 3, "max_duration": 150.0, "tier": "Gold", "use_manifest_text": True},
         "encodec": {"target_bandwidth": 3}}, "en", "enru", num_shards=4, shard_idx=1, max_samples=5)
    assert cfg.tiers == ("Gold",) and cfg.min_duration == 3.0 and cfg.target_bandwidth == 3.0
    assert cfg.manifests["en"] == "/m.csv" and cfg.is_debug_run and cfg.tgt_lang == "ru"


@pytest.mark.parametrize("changes", [
    {"lang": "en"}, {"lang": "de"}, {"languages": ("ru", "eng")}, {"direction": "rude"}, {"direction": "ruru"},
    {"num_shards": 2, "shard_idx": 2}, {"num_shards": 2, "shard_idx": -1}, {"max_samples": -1}])
def test_bad_settings_are_refused(changes):
    with pytest.raises(ValueError):
        make(**changes)

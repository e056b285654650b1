from __future__ import annotations

import pytest

from pairloom.config import ConfigError, PipelineConfig, load_config, merged


def test_defaults_are_consistent():
    c = PipelineConfig.from_dict({})
    assert c == PipelineConfig() and c.to_dict()["image"]["target_size"] == (384, 384)


def test_layers_and_lists(tmp_path):
    p = tmp_path / "c.yaml"
    p.write_text("seed: 7\nimage: {target_size: [2, 3], unknown: 1}\nshard: {max_samples_per_shard: 10}\n")
    c = load_config(str(p), {"shard": {"compression": "lz4"}})
    assert c.seed == 7 and c.image.target_size == (2, 3) and c.shard.max_samples_per_shard == 10 and c.shard.compression == "lz4"
    assert merged({"a": {"b": 1, "c": 2}}, {"a": {"b": 3}}) == {"a": {"b": 3, "c": 2}}


@pytest.mark.parametrize(
    "bad",
    [
        {"shuffling": "some"}, {"log_level": "LOUD"}, {"streaming_chunk_size": 0}, {"image": {"resize_strategy": "x"}}, {"image": {"interpolation": "x"}}, {"image": {"color_space": "CMYK"}}, {"image": {"pad_value": 256}},
        {"image": {"target_size": [0, 1]}}, {"tokenizer": {"max_length": 0}}, {"shard": {"compression": "zstd"}}, {"shard": {"alignment_bytes": 48}}, {"shard": {"format_version": 3}}, {"shard": {"format_version": 1}},
        {"image": {"storage_dtype": "float32"}}, {"shard": {"shard_size_mb": 0}}, {"shard": {"max_samples_per_shard": 0}}, {"image": 5}, {"seed": "x"}, {"num_workers": -1}, {"progress_interval": 0}, {"tokenizer": {"padding": "left"}}, {"tokenizer": {"truncation": "yes"}}, {"tokenizer": {"padding": "longest"}},
        {"shard": {"format_version": 1}, "image": {"storage_dtype": "float32", "dynamic_padding": False, "color_space": "L"}},
    ],
)
def test_rejected(bad):
    with pytest.raises(ConfigError):
        PipelineConfig.from_dict(bad)


def test_bad_files(tmp_path):
    with pytest.raises(ConfigError):
        load_config(str(tmp_path / "none.yaml"))
    for text in ("a: [", "- 1\n- 2\n", ""):
        p = tmp_path / "c.yaml"
        p.write_text(text)
        with pytest.raises(ConfigError):
            load_config(str(p))


def test_names_of_other_files():
    """Settings under the names that other tools use for them."""
    c = PipelineConfig.from_dict(
        {
            "dataset": {"hf_dataset_id": "/data/vqa/", "hf_config_name": "preview", "split": "train", "streaming": False}, "log_level": "info", "num_workers": 4, "progress_interval": 50,
            "image": {"resize_strategy": "resize"}, "tokenizer": {"model_name_or_path": "tok.json", "padding": "max_length", "truncation": True, "trust_remote_code": True, "add_special_tokens": False},
        }
    )
    assert c.dataset.location() == "/data/vqa/preview/train" and c.log_level == "INFO" and c.tokenizer.name == "tok.json" and not c.tokenizer.add_special_tokens
    assert PipelineConfig.from_dict({"dataset": {"path": "/"}}).dataset.location() == "/"

"""Settings: frozen, read from YAML, checked as a whole."""

from __future__ import annotations

import dataclasses
from dataclasses import dataclass, field
from typing import Any

SHUFFLES = ("none", "local", "global")
STRATEGIES = ("resize_and_pad", "center_crop", "resize")
INTERPOLATIONS = ("nearest", "bilinear", "bicubic", "lanczos")
COLOURS = ("RGB", "BGR", "L")
DTYPES = ("float32", "uint8")
COMPRESSIONS = (None, "none", "lz4")
PADDINGS = ("max_length", "longest", "do_not_pad")
LOG_LEVELS = ("DEBUG", "INFO", "WARNING", "ERROR", "CRITICAL")


class ConfigError(ValueError):
    """A setting that is missing, unknown or out of range."""


def merged(base: dict[str, Any], over: dict[str, Any]) -> dict[str, Any]:
    """``base`` with the entries of ``over``; dictionaries are merged inside, other values replaced."""
    out = dict(base)
    for k, v in over.items():
        out[k] = merged(out[k], v) if isinstance(v, dict) and isinstance(out.get(k), dict) else v
    return out


@dataclass(frozen=True)
class DatasetConfig:
    path: str = ""
    format: str = "parquet"
    name: str = "dataset"
    column_mapping: dict[str, str] = field(default_factory=dict)
    max_samples: int | None = None
    fallbacks: tuple[str, ...] = ()
    config_name: str | None = None
    split: str | None = None

    def location(self) -> str:
        """Where the rows are: the path, and below it the configuration and the split if they are named."""
        return "/".join(x for x in (self.path.rstrip("/") if self.path != "/" else self.path, self.config_name, self.split) if x)


@dataclass(frozen=True)
class ImageConfig:
    target_size: tuple[int, int] = (384, 384)
    resize_strategy: str = "resize_and_pad"
    color_space: str = "RGB"
    normalization_mean: tuple[float, ...] = (0.485, 0.456, 0.406)
    normalization_std: tuple[float, ...] = (0.229, 0.224, 0.225)
    interpolation: str = "bicubic"
    pad_value: int = 0
    max_image_dim: int = 384
    storage_dtype: str = "uint8"
    dynamic_padding: bool = True


@dataclass(frozen=True)
class TokenizerConfig:
    name: str = "hash"
    max_length: int = 512
    padding: str = "max_length"
    truncation: bool = True
    add_special_tokens: bool = True
    dynamic_text_padding: bool = False
    folder: str = "/opt/tokenizers"


@dataclass(frozen=True)
class ShardConfig:
    output_dir: str = "shards"
    shard_size_mb: int = 256
    max_samples_per_shard: int | None = None
    compression: str | None = None
    alignment_bytes: int = 64
    format_version: int = 2
    manifest_path: str | None = None


@dataclass(frozen=True)
class PipelineConfig:
    dataset: DatasetConfig = field(default_factory=DatasetConfig)
    image: ImageConfig = field(default_factory=ImageConfig)
    tokenizer: TokenizerConfig = field(default_factory=TokenizerConfig)
    shard: ShardConfig = field(default_factory=ShardConfig)
    shuffling: str = "none"
    num_workers: int = 4
    seed: int = 42
    log_level: str = "INFO"
    progress_interval: int = 50
    streaming_chunk_size: int = 500
    fail_fast: bool = False

    @staticmethod
    def from_dict(data: dict[str, Any]) -> PipelineConfig:
        """Unknown keys are passed over, lists become tuples; values are checked."""
        made = _build(PipelineConfig, data)
        check(made)
        return made

    def to_dict(self) -> dict[str, Any]:
        return dataclasses.asdict(self)


# Other names of settings.
_ALIASES = {"hf_dataset_id": "path", "hf_config_name": "config_name", "model_name_or_path": "name"}
_PARTS = {"dataset": DatasetConfig, "image": ImageConfig, "tokenizer": TokenizerConfig, "shard": ShardConfig}


def _build(kind: type, data: Any) -> Any:
    if not isinstance(data, dict):
        raise ConfigError(f"{kind.__name__} needs a mapping, not {type(data).__name__}")
    known = {f.name for f in dataclasses.fields(kind)}
    values = {}
    for k, v in data.items():
        k = _ALIASES.get(k, k)
        v = v.upper() if k == "log_level" and isinstance(v, str) else v
        if k in known:
            values[k] = _build(_PARTS[k], v) if kind is PipelineConfig and k in _PARTS else tuple(v) if isinstance(v, list) else v
    try:
        return kind(**values)
    except TypeError as why:
        raise ConfigError(str(why)) from why


def check(c: PipelineConfig) -> None:
    """Raises ConfigError with the first setting that cannot be used."""
    whole = lambda x: isinstance(x, int) and not isinstance(x, bool)
    rules = [
        (c.shuffling in SHUFFLES, f"shuffling must be one of {SHUFFLES}"),
        (c.log_level in LOG_LEVELS, f"log_level must be one of {LOG_LEVELS}"),
        (whole(c.num_workers) and c.num_workers >= 0, "num_workers must be 0 at least"),
        (whole(c.progress_interval) and c.progress_interval >= 1, "progress_interval must be 1 at least"),
        (c.tokenizer.padding in PADDINGS, f"tokenizer.padding must be one of {PADDINGS}"),
        (c.tokenizer.padding == "max_length" or c.tokenizer.dynamic_text_padding is True, "records are padded to max_length; another tokenizer.padding needs dynamic_text_padding"),
        (all(isinstance(x, bool) for x in (c.tokenizer.truncation, c.tokenizer.add_special_tokens, c.tokenizer.dynamic_text_padding, c.fail_fast)), "switches must be true or false"),
        (whole(c.seed), "seed must be a whole number"),
        (whole(c.streaming_chunk_size) and c.streaming_chunk_size >= 1, "streaming_chunk_size must be 1 at least"),
        (c.dataset.max_samples is None or (whole(c.dataset.max_samples) and c.dataset.max_samples >= 1), "dataset.max_samples must be 1 at least"),
        (c.image.resize_strategy in STRATEGIES, f"image.resize_strategy must be one of {STRATEGIES}"),
        (c.image.interpolation in INTERPOLATIONS, f"image.interpolation must be one of {INTERPOLATIONS}"),
        (c.image.color_space in COLOURS, f"image.color_space must be one of {COLOURS}"),
        (c.image.storage_dtype in DTYPES, f"image.storage_dtype must be one of {DTYPES}"),
        (len(c.image.target_size) == 2 and all(whole(x) and x >= 1 for x in c.image.target_size), "image.target_size must be two positive whole numbers"),
        (whole(c.image.max_image_dim) and c.image.max_image_dim >= 1, "image.max_image_dim must be 1 at least"),
        (whole(c.image.pad_value) and 0 <= c.image.pad_value <= 255, "image.pad_value must be 0 to 255"),
        (whole(c.tokenizer.max_length) and c.tokenizer.max_length >= 1, "tokenizer.max_length must be 1 at least"),
        (c.shard.compression in COMPRESSIONS, f"shard.compression must be one of {COMPRESSIONS}"),
        (c.shard.format_version in (1, 2), "shard.format_version must be 1 or 2"),
        (whole(c.shard.alignment_bytes) and c.shard.alignment_bytes > 0 and not c.shard.alignment_bytes & (c.shard.alignment_bytes - 1), "shard.alignment_bytes must be a power of 2"),
        (whole(c.shard.shard_size_mb) and c.shard.shard_size_mb >= 1, "shard.shard_size_mb must be 1 at least"),
        (c.shard.max_samples_per_shard is None or (whole(c.shard.max_samples_per_shard) and c.shard.max_samples_per_shard >= 1), "shard.max_samples_per_shard must be 1 at least"),
        (
            (c.shard.format_version, c.image.storage_dtype, c.image.dynamic_padding) in ((1, "float32", False), (2, "uint8", True)),
            "format 1 stores float32 of one size, format 2 uint8 of each sample's size; other combinations cannot be read back",
        ),
        (not (c.shard.format_version == 1 and c.shard.compression == "lz4"), "format 1 has no compression"),
    ]
    for ok, message in rules:
        if not ok:
            raise ConfigError(message)
    channels = 1 if c.image.color_space == "L" else 3
    if c.shard.format_version == 1 and not len(c.image.normalization_mean) == len(c.image.normalization_std) == channels:
        raise ConfigError(f"normalization_mean and normalization_std must have {channels} values for {c.image.color_space}")


def load_config(path: str, overrides: dict[str, Any] | None = None) -> PipelineConfig:
    """Settings of a YAML file, with ``overrides`` on top. ConfigError for a missing or unreadable file."""
    import yaml

    try:
        with open(path, encoding="utf-8") as lines:
            data = yaml.safe_load(lines)
    except OSError as why:
        raise ConfigError(f"cannot read {path}: {why}") from why
    except yaml.YAMLError as why:
        raise ConfigError(f"{path} is not YAML: {why}") from why
    if not isinstance(data, dict):
        raise ConfigError(f"{path} must hold a mapping")
    return PipelineConfig.from_dict(merged(data, overrides or {}))

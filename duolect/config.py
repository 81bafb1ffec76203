"""Job settings, validated once on the driver."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from typing import Any

# Rates every stage and output file agrees on, in Hz.
SOURCE_RATE = 16000
TARGET_RATE = 24000
# Rows handled, handed back and stored at a time: audio is large, so its chunks stay small.
AUDIO_ROWS = 16


@dataclass(frozen=True)
class JobConfig:
    """One run: a source language, a direction, and which rows of it to build.

    ``shard_idx=None`` builds every shard in a single job; ``max_samples=0``
    means no per-shard limit; ``tiers=None`` leaves the tier filter off. Model stages
    get a task for every ``rows_per_task`` rows, and every ``rows_per_commit`` rows are
    committed by themselves. A model with a batch method gets at most ``audio_budget``
    samples or ``text_budget`` characters in one call. ``translator_name`` names the
    translator and its version: under that name translations are kept and used again. ``shuffle_seed`` shuffles the manifest before it is dealt
    out, and ``summary_files`` sets the number of files of a debug summary.
    """

    data_root: str
    output_root: str
    lang: str
    direction: str
    manifests: Mapping[str, str] = field(default_factory=dict)
    debug_manifest: str | None = None
    languages: tuple[str, ...] = ("ru", "en")
    synth_codes: tuple[tuple[str, str], ...] = (("ru", "RU"), ("en", "EN"))
    min_duration: float = 0.0
    max_duration: float = 1e9
    tiers: tuple[str, ...] | None = None
    use_manifest_text: bool = False
    text_column: str = "text"
    num_shards: int = 1
    shard_idx: int | None = None
    max_samples: int = 0
    # The defaults of the synthesis and codec settings.
    exaggeration: float = 0.9
    target_bandwidth: float = 6.0
    duration_tolerance: float | None = None
    inference_partitions: int | None = None
    rows_per_task: int = 512
    rows_per_commit: int = 200_000
    audio_budget: int = 16 * 30 * SOURCE_RATE
    text_budget: int = 1 << 16
    translator_name: str | None = None
    min_token_frames: int = 1
    multi_line: bool = True
    shuffle_seed: int | None = None
    summary_files: int | None = None

    def __post_init__(self) -> None:
        if any(len(code) != 2 for code in self.languages):
            raise ValueError("languages are two-letter codes")
        if self.lang not in self.languages:
            raise ValueError(f"lang {self.lang!r} is not one of {self.languages}")
        known = {a + b for a in self.languages for b in self.languages if a != b}
        if self.direction not in known:
            raise ValueError(f"direction {self.direction!r} is not one of {sorted(known)}")
        if not self.direction.startswith(self.lang):
            raise ValueError(f"direction {self.direction!r} does not start from {self.lang!r}")
        if self.shard_idx is not None and not 0 <= self.shard_idx < max(self.num_shards, 1):
            raise ValueError(f"shard_idx {self.shard_idx} is outside 0..{self.num_shards - 1}")
        if min(self.rows_per_task, self.rows_per_commit, self.audio_budget, self.text_budget) < 1:
            raise ValueError("rows_per_task, rows_per_commit and the budgets must be positive")
        if self.max_samples < 0:
            raise ValueError("max_samples must be 0 (off) or positive")

    @property
    def src_lang(self) -> str:
        return self.lang

    @property
    def tgt_lang(self) -> str:
        return self.direction[len(self.lang):]

    @property
    def is_debug_run(self) -> bool:
        """Only runs on an override manifest or with a limit write a summary file."""
        return self.debug_manifest is not None or self.max_samples > 0

    @classmethod
    def from_mapping(cls, settings: Mapping[str, Any], lang: str, direction: str,
                     **run: Any) -> JobConfig:
        """Build from the nested settings mapping (as parsed from YAML) plus run options."""
        pipe = settings.get("pipeline", {})
        tiers = pipe.get("tier")
        values = {
            "data_root": settings["data_root"],
            "output_root": settings["output_root"],
            "manifests": dict(settings.get("manifests", {})),
            "min_duration": float(pipe.get("min_duration", 0.0)),
            "max_duration": float(pipe.get("max_duration", 1e9)),
            "tiers": None if tiers is None else (tiers,) if isinstance(tiers, str) else tuple(tiers),
            "use_manifest_text": bool(pipe.get("use_manifest_text", False)),
            "text_column": pipe.get("text_column", "text"),
            "exaggeration": float(settings.get("tts", {}).get("exaggeration", 0.9)),
            "target_bandwidth": float(settings.get("encodec", {}).get("target_bandwidth", 6.0)),
        }
        return cls(lang=lang, direction=direction, **{**values, **run})

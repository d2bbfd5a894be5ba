"""Settings: a frozen dataclass read from YAML, with secrets from the environment only."""

from __future__ import annotations

import os
from dataclasses import dataclass, field, fields


@dataclass(frozen=True)
class PdfSettings:
    dpi: int = 300
    language: str = "chi_sim+eng"
    tesseract_path: str = ""


@dataclass(frozen=True)
class CaptionSettings:
    model_name: str = ""
    device: str = "cpu"
    max_length: int = 50


@dataclass(frozen=True)
class OutputSettings:
    output_dir: str = "output"


@dataclass(frozen=True)
class CorrectionSettings:
    enable: bool = False
    model_name: str = ""
    endpoint: str = ""
    batch_size: int = 1000
    max_retries: int = 3
    retry_delay: float = 2
    pause: float = 0.5


@dataclass(frozen=True)
class PairSettings:
    model_name: str = ""
    endpoint: str = ""
    max_segment_length: int = 8000
    overlap_length: int = 1000
    max_retries: int = 3
    retry_delay: float = 2
    #: seconds between two calls of the whole cluster, and calls side by side
    pause: float = 0.5
    lanes: int = 8


@dataclass(frozen=True)
class Settings:
    pdf_processing: PdfSettings = field(default_factory=PdfSettings)
    image_captioning: CaptionSettings = field(default_factory=CaptionSettings)
    output: OutputSettings = field(default_factory=OutputSettings)
    text_correction: CorrectionSettings = field(default_factory=CorrectionSettings)
    qa_generation: PairSettings = field(default_factory=PairSettings)


def load(path: str) -> Settings:
    """Settings of a YAML file; keys that no setting has are ignored, secrets among them."""
    import yaml

    with open(path, encoding="utf-8") as f:
        given = yaml.safe_load(f) or {}
    parts = {}
    for part in fields(Settings):
        kind = part.default_factory
        own = given.get(part.name) or {}
        parts[part.name] = kind(**{f.name: own[f.name] for f in fields(kind) if f.name in own})
    return Settings(**parts)


def secret(name: str) -> str:
    """A secret of the environment; an error names what is missing, and is never logged with a value."""
    if not (value := os.environ.get(name)):
        raise KeyError(f"the environment variable {name} is not set")
    return value

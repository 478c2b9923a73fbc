"""Configuration: frozen dataclasses with the defaults, loading and checking of YAML files."""

from __future__ import annotations

from dataclasses import dataclass, field, fields, is_dataclass
from pathlib import Path
from typing import Any


@dataclass(frozen=True)
class Chunking:
    words: int = 512
    overlap_words: int = 50
    chars: int = 1500
    overlap_chars: int = 150
    threshold: float = 0.6
    merge_similarity: float = 0.8
    single_chunk_coherence: float = 0.0


@dataclass(frozen=True)
class Quality:
    min_question_words: int = 10
    max_question_words: int = 50
    min_answer_words: int = 5
    max_answer_words: int = 100
    min_instruction_length: int = 15
    duplicate_similarity: float = 0.85
    answer_support: float = 0.8
    relevance: float = 0.6
    judge_threshold: float = 0.7
    content_filters: tuple[str, ...] = ("profanity", "personal_info", "code_snippets")


@dataclass(frozen=True)
class Extraction:
    min_answer_length: int = 3
    max_answer_length: int = 100
    min_answer_score: float = 0.6
    max_answers: int = 50
    min_qa_score: float = 0.6
    max_questions: int = 50
    object_confidence: float = 0.7


@dataclass(frozen=True)
class Cleaning:
    min_chars: int = 10
    max_chars: int = 100_000
    remove_whitespace: bool = True
    remove_urls: bool = False
    keep_paragraphs: bool = False


@dataclass(frozen=True)
class Config:
    chunking: Chunking = field(default_factory=Chunking)
    quality: Quality = field(default_factory=Quality)
    extraction: Extraction = field(default_factory=Extraction)
    cleaning: Cleaning = field(default_factory=Cleaning)
    text_suffixes: tuple[str, ...] = (".txt", ".md", ".pdf", ".doc", ".docx", ".ppt", ".pptx", ".xls", ".xlsx")
    image_suffixes: tuple[str, ...] = (".jpg", ".jpeg", ".png", ".gif", ".bmp")


def load_yaml(path: str | Path) -> dict[str, Any]:
    """A YAML mapping. Missing files raise ``FileNotFoundError``, bad YAML ``yaml.YAMLError``, other content ``ValueError``."""
    import yaml

    with open(path, encoding="utf-8") as h:
        data = yaml.safe_load(h)
    if not isinstance(data, dict):
        raise ValueError(f"{path} holds no mapping")
    return data


def build(kind: type, data: dict[str, Any]) -> Any:
    """An instance of a config dataclass from a nested mapping; unknown keys raise ``ValueError``."""
    known = {f.name: f for f in fields(kind)}
    if unknown := set(data) - set(known):
        raise ValueError(f"unknown settings for {kind.__name__}: {sorted(unknown)}")
    given = {}
    for k, v in data.items():
        default = known[k].default_factory() if callable(known[k].default_factory) else known[k].default
        given[k] = build(type(default), v) if is_dataclass(default) else tuple(v) if isinstance(default, tuple) else v
    return kind(**given)


AGENT_SECTIONS = ("input_processing", "instruction_generation", "quality_control", "document_processing")
MODEL_SECTIONS = ("llm_models", "serving", "document_understanding", "image_processing")


def validate(config: dict[str, Any], kind: str) -> list[str]:
    """What is wrong with an ``agent`` or ``models`` configuration; an empty list if nothing is."""
    wrong = []
    body = config.get(kind, config)
    for name in AGENT_SECTIONS if kind == "agent" else MODEL_SECTIONS:
        if not isinstance(body.get(name), dict):
            wrong.append(f"missing section {name}")
    if kind == "agent":
        for section, name, types in (("quality_control", "min_quality_score", (int, float)), ("quality_control", "duplicate_threshold", (int, float)), ("input_processing", "max_workers", int), ("input_processing", "batch_size", int)):
            value = (body.get(section) or {}).get(name)
            if value is not None and (isinstance(value, bool) or not isinstance(value, types)):
                wrong.append(f"{section}.{name} has the wrong type")
    else:
        for name, model in (body.get("llm_models") or {}).items():
            for key in ("name", "type", "model_path"):
                if not isinstance(model, dict) or not model.get(key):
                    wrong.append(f"model {name} lacks {key}")
    return wrong

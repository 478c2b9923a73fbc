import pytest
import yaml

from siltstone.config import Config, build, load_yaml, validate

AGENT = {"agent": {"input_processing": {"max_workers": 4, "batch_size": 100}, "instruction_generation": {}, "quality_control": {"min_quality_score": 0.7, "duplicate_threshold": 0.85}, "document_processing": {}}}
MODELS = {"models": {"llm_models": {"m": {"name": "m", "type": "served", "model_path": "x"}}, "serving": {}, "document_understanding": {}, "image_processing": {}}}


def test_yaml(tmp_path):
    p = tmp_path / "c.yaml"
    p.write_text(yaml.safe_dump(AGENT))
    assert load_yaml(p) == AGENT
    with pytest.raises(FileNotFoundError):
        load_yaml(tmp_path / "none.yaml")
    p.write_text("a: [1")
    with pytest.raises(yaml.YAMLError):
        load_yaml(p)
    p.write_text("- 1")
    with pytest.raises(ValueError):
        load_yaml(p)


def test_validate():
    assert validate(AGENT, "agent") == [] and validate(MODELS, "models") == []
    assert validate({"agent": {"input_processing": {}}}, "agent")
    bad = {"models": {**MODELS["models"], "llm_models": {"m": {"name": "m"}}}}
    assert validate(bad, "models") == ["model m lacks type", "model m lacks model_path"]
    wrong = {"agent": {**AGENT["agent"], "quality_control": {"min_quality_score": "high"}}}
    assert validate(wrong, "agent") == ["quality_control.min_quality_score has the wrong type"]


def test_build():
    c = build(Config, {"chunking": {"chars": 100}, "quality": {"content_filters": ["profanity"]}})
    assert c.chunking.chars == 100 and c.chunking.words == 512 and c.quality.content_filters == ("profanity",)
    with pytest.raises(ValueError):
        build(Config, {"nothing": 1})

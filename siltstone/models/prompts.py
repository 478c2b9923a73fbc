"""Prompt templates in our own words, with named places to fill."""

from __future__ import annotations

import string

from siltstone.functions.parse import TRIPLET_END, TRIPLET_START

TEMPLATES = {
    "triplets": "GENERATE between three and five exercises that can be solved with the text alone. Put each between "
    + TRIPLET_START + " and " + TRIPLET_END + ", on lines that begin with QUESTION:, ANSWER: and INSTRUCTION:.\nText: {text}",
    "density": "RATE how much information the text holds with one number from 0 to 1.\nText: {text}",
    "judge": "JUDGE the exercise by the text. Reply in JSON with valid, scores (answer_validity, question_quality, instruction_quality from 0 to 1), issues and improvements.\nQuestion: {question}\nAnswer: {answer}\nInstruction: {instruction}\nText: {text}",
    "self_instruct": "Here are examples:\n{examples}\nWrite {count} more on lines that begin with Q: and A:.\nText: {text}",
    "answers": "FIND what could be asked about in the text. For each finding write lines that begin with Answer:, Reasoning:, Confidence: (0 to 1) and Type:, and a blank line.\nText: {text}",
    "questions": "ASK for this answer ({kind}): {answer}\nWrite between three and five questions that the text alone can settle, each on lines that begin with Question Type:, Question:, Verification: and Complexity: (0 to 1), and a blank line.\nText: {text}",
    "refine": "REVISE these questions for the answer: {answer}\n{questions}\nFor each write lines that begin with Original:, Improved:, Reasoning: and Keep/Replace:, and a blank line.",
    "variation": "Say the same in other words, on lines that begin with Q: and A:.\nQ: {question}\nA: {answer}\nText: {text}",
}


class Prompts:
    """A registry of templates; unknown names and missing variables raise ``KeyError``."""

    def __init__(self, templates: dict[str, str] | None = None):
        self.templates = dict(TEMPLATES if templates is None else templates)

    @classmethod
    def load(cls, path: str) -> Prompts:
        """Templates of a YAML mapping of names to texts."""
        from siltstone.config import load_yaml

        return cls({str(k): str(v) for k, v in load_yaml(path).items()})

    def save(self, path: str) -> None:
        import yaml

        with open(path, "w", encoding="utf-8") as h:
            yaml.safe_dump(self.templates, h, allow_unicode=True, sort_keys=False)

    def add(self, name: str, template: str) -> None:
        self.templates[name] = template

    def variables(self, name: str) -> list[str]:
        return [v for _, v, _, _ in string.Formatter().parse(self.templates[name]) if v]

    def fill(self, name: str, **values: object) -> str:
        return self.templates[name].format(**values)

    def column(self, name: str, **columns):
        """The filled template as a column expression; values are columns."""
        from pyspark.sql import functions as F

        out = F.lit(self.templates[name])
        for v in self.variables(name):
            out = F.replace(out, F.lit("{" + v + "}"), F.coalesce(columns[v].cast("string"), F.lit("")))
        return out


def format_examples(pairs: list[tuple[str, str]]) -> str:
    return "\n\n".join(f"Q: {q}\nA: {a}" for q, a in pairs)

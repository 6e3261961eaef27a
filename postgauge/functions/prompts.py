"""Prompt text for zero-shot and few-shot classification."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Length limits, instruction, headings and example answers of the prompts.
POST_LIMIT = 6_000
EXAMPLE_LIMIT = 1_800
TASK = """You are evaluating an academic NLP benchmark for suicidal ideation detection.
Classify whether the {which} contains suicidal ideation or suicidal risk.

Return only valid JSON with this exact schema:
{{
  "label": "yes" or "no",
  "score": number from 0.0 to 1.0,
  "evidence": ["short quoted or paraphrased evidence"],
  "justification": "brief explanation"
}}

Rules:
- Use "yes" when the post expresses suicidal ideation, intent, planning,
  self-harm intent, or explicit desire not to live.
- Use "no" for depression, stress, sadness, or support-seeking without suicidal
  ideation or self-harm intent.
- The score is confidence for the "yes" class.
- Do not provide clinical advice. Do not add text outside the JSON.

"""
POST_HEADING = "Reddit post"
FINAL_HEADING = "Final Reddit post"
FINAL_POST = "final Reddit post"
EXAMPLES_HEADING = "Few-shot examples:\n"
EXAMPLE_ANSWER = (
    'Expected JSON:\n{{"label":"{label}","score":{score},"evidence":[],'
    '"justification":"Labeled training example."}}'
)
EXAMPLE_SCORE = {"yes": "0.90", "no": "0.10"}
QUOTE = '"""'


def _quoted(heading: str, text: str) -> str:
    return f"{heading}:\n{QUOTE}{text}{QUOTE}"


def _around(opening: str, heading: str, text: Column) -> Column:
    """Constant text on both sides of the post, which is cut to its limit."""
    return F.concat(
        F.lit(f"{opening}{heading}:\n{QUOTE}"),
        F.substring(text, 1, POST_LIMIT),
        F.lit(QUOTE),
    )


def zero_shot_prompt(text: Column) -> Column:
    return _around(TASK.format(which=POST_HEADING), POST_HEADING, text)


def few_shot_opening(examples: Sequence[tuple[str, str]]) -> str:
    """Everything before the final post; ``examples`` holds (label, text) pairs."""
    if not examples:
        raise ValueError("few_shot needs training examples")
    blocks = [
        "\n".join(
            (
                f"Example {number}",
                _quoted(POST_HEADING, text[:EXAMPLE_LIMIT]),
                EXAMPLE_ANSWER.format(label=label, score=EXAMPLE_SCORE[label]),
            )
        )
        for number, (label, text) in enumerate(examples, start=1)
    ]
    task = TASK.format(which=FINAL_POST)
    return task + EXAMPLES_HEADING + "\n\n".join(blocks) + "\n\n"


def few_shot_prompt(text: Column, examples: Sequence[tuple[str, str]]) -> Column:
    return _around(few_shot_opening(examples), FINAL_HEADING, text)


def prompt_for(mode: str, text: Column, examples: Sequence[tuple[str, str]] = ()) -> Column:
    if mode == "zero_shot":
        return zero_shot_prompt(text)
    if mode == "few_shot":
        return few_shot_prompt(text, examples)
    raise ValueError(f"unknown prompt mode: {mode}")

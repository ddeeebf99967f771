"""Prompt templates and their rendering."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

SLOT = "{tweet}"

# The prompt texts, word for word.
TEMPLATES = {
    "zero_shot": (
        'Here is the tweet. "{tweet}"  Please just give the final classification as '
        '"in-favor", "against", or "neutral-or-unclear".'
    ),
    "instruction": (
        "Classify the stance of the following tweet as in-favor, against, or "
        "neutral-or-unclear.\n\nTweet:\n{tweet}\n\nAnswer:"
    ),
    "assistant": (
        "You are a helpful assistant that can classify tweets with respect to COVID-19 vaccine "
        'into three categories: "in-favor", "against", or "neutral-or-unclear".'
        'Here is the tweet. "{tweet}"  Please just give the final classification as '
        '"in-favor", "against", or "neutral-or-unclear".'
    ),
    "one_word": (
        "What is the stance of the following tweet with respect to COVID-19 vaccine? "
        'Here is the tweet. "{tweet}"  Please use exactly one word from the following 3 '
        'categories to label it: "in-favor", "against", "neutral-or-unclear".'
    ),
}


def render_prompt(text: Column, template: str = "zero_shot") -> Column:
    """Put the text into the slot of a named template (or of a template text)."""
    body = TEMPLATES.get(template, template)
    if body.count(SLOT) != 1:
        raise ValueError(f"the template must hold {SLOT} exactly once")
    before, after = body.split(SLOT)
    return F.concat(F.lit(before), text, F.lit(after))

"""A deterministic stand-in for a language model."""

from __future__ import annotations


def echo_factory():
    """Repeats the prompt behind a fixed word; counts its whitespace tokens."""

    def generate(prompts: list[str], options: dict) -> list[tuple[str, int]]:
        texts = [f"Answer: {p}" for p in prompts]
        return [(t, len(t.split())) for t in texts]

    return generate


def length_loss_factory():
    """Loss of a batch from its text lengths alone."""

    def score(texts: list[str], max_length: int) -> tuple[float, int]:
        counts = [min(len(t.split()), max_length) for t in texts]
        return float(sum(len(t) % 7 for t in texts)) / len(texts), sum(counts)

    return score

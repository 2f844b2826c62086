"""Models behind a command (X1), the prompts they get (F31), and what taggers and extractors make of them.

A model is a function from a prompt to an answer. It runs on executors in Arrow batches (see `ai`) or
on the driver for the few prompts of a report. Nothing here calls a network by itself.
"""

from __future__ import annotations

import json
import os
import shlex
import subprocess
import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from chatloom import config
from chatloom.operators.ai import TOPICS, Extractor, Tagger, parse_topics

Model = Callable[[str], str]


class ModelError(RuntimeError):
    """A command that failed, or took too long, on every try."""


@dataclass(frozen=True)
class Command:
    """A model behind a command line, which gets the prompt as its last argument or on standard input.

    A call that fails or takes longer than `timeout` seconds is repeated up to `retries` times, after a
    pause that doubles.
    """

    command: str
    timeout: float = 180
    retries: int = 2
    stdin: bool = False
    model: str | None = None
    pause: float = 1.0

    def __call__(self, prompt: str) -> str:
        words = shlex.split(self.command) + (["--model", self.model] if self.model else []) + ([] if self.stdin else [prompt])
        why = ""
        for k in range(self.retries + 1):
            if k:
                time.sleep(self.pause * 2 ** (k - 1))
            try:
                return subprocess.run(words, input=prompt if self.stdin else None, capture_output=True, text=True, timeout=self.timeout, check=True).stdout.strip()
            except subprocess.TimeoutExpired:
                why = "TIMEOUT"
            except (subprocess.CalledProcessError, OSError) as e:
                why = f"ERROR: {(getattr(e, 'stderr', '') or str(e))[:200]}"
        raise ModelError(why)


def from_environment(strong: bool = False) -> Model:
    """The model of LLM_COMMAND (LLM_STDIN for standard input; LLM_MODEL, or LLM_MODEL_PRO for the strong
    one), else the offline one."""
    command = os.environ.get("LLM_COMMAND", "").strip()
    if not command:
        return offline
    name = os.environ.get("LLM_MODEL_PRO", os.environ.get("LLM_MODEL")) if strong else os.environ.get("LLM_MODEL")
    return Command(command, 600 if strong else 180, stdin=os.environ.get("LLM_STDIN", "").strip() in ("1", "true", "yes"), model=name)


def offline(prompt: str) -> str:
    """The default: says what it was asked, in one deterministic line."""
    head = prompt.strip().split("\n", 1)[0][:120]
    return f"(no model is set; {len(prompt)} characters asked: {head})"


# --- topics and facts ---------------------------------------------------------------------------

# What each topic means, for a model.
_MEANING = {
    "install_help": "asks how to install or deploy something", "install_report": "tells of an installation, a fix or an error in one", "provider_config": "is about setting up a provider or a key",
    "messaging_adapter": "is about a link to a messaging platform", "feature_usage": "is about using the product's features", "model_discussion": "compares models or benchmarks",
    "community_meta": "announces, links elsewhere, or plans a meeting", "brand_identity": "asks whether a site or group is official", "bug_report": "reports a fault that can be repeated",
    "feature_request": "wishes for a feature", "success_story": "shows what somebody made", "general_discussion": "is anything else",
}


def topic_prompt(batch: Sequence[tuple[str, str]], language: str | None = None) -> str:
    """asks for the topic of each (id, text)."""
    listed = config.numbered([f"{t}: {_MEANING[t]}" for t in TOPICS])
    spoken = f"in {language} and English" if language else "in any language"
    items = json.dumps([{"id": i, "text": t} for i, t in batch], ensure_ascii=False)
    return (
        f"Sort messages of a product's community chat, {spoken}, into these topics:\n{listed}\n\n"
        f'Answer with a JSON array alone, one element a message, in order: {{"id": "...", "topic": "..."}}.\n\n{len(batch)} messages:\n{items}\n'
    )


def topic_tagger(model: Model, language: str | None = None) -> Tagger:
    """A tagger that asks a model for a batch of texts; ValueError unless every text is answered, so
    that `ai.tagged` asks for each by itself."""

    def tag(texts: Sequence[str]) -> list[str]:
        ids = [f"m{k}" for k in range(len(texts))]
        found = parse_topics(model(topic_prompt(list(zip(ids, texts)), language)), ids)
        if found is None:
            raise ValueError("not every message was answered")
        return [found[i] for i in ids]

    return tag


def fact_extractor(model: Model, language: str = "English", schema: dict | None = None) -> Extractor:
    """An extractor that asks a model for the facts of a chunk by the configured schema."""
    opening = config.extraction_prompt(config.fact_schema() if schema is None else schema, language)
    return lambda text: model(opening + text)

"""Bounded verify-and-refine search over a pluggable model, in Arrow batches.

A ModelClient answers prompts; tests and offline runs use a rule-based one. The search keeps one row's state in plain
values, so a batch of rows is worked on by one Python worker and the result is written before it is used again: model
answers are not repeatable.
"""

from __future__ import annotations

import base64
import json
import mimetypes
import urllib.request
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curatrix.session import materialize

Client = Callable[[str], str]
#: The strategies in the order in which attempts take them.
STRATEGIES = ["Backtracking", "Exploring New Paths", "Verification", "Correction"]
RESULT = "process_id string, question string, ground_truth string, response string, found_correct_answer boolean, guided boolean, query_history array<string>, response_history array<string>, strategies_used array<string>, status string, error string"
SAMPLE = RESULT + ", complex_cot string, extracted_answer string"


@dataclass
class Search:
    """Settings: prompts by name have the placeholders {question}, {previous} and {truth}; an empty prompt is skipped."""

    prompts: dict[str, str]
    extract: Callable[[str], str]
    accept: Callable[[str], bool]
    attempts: int = 3
    depth: int = 2
    most_strategies: int = 3
    efficient: bool = True
    names: list[str] = field(default_factory=lambda: list(STRATEGIES))

    def ask(self, client: Client, name: str, row: dict, previous: str, log: dict) -> str:
        prompt = self.prompts[name].format(question=row["question"], previous=previous, truth=row["ground_truth"])
        log["query_history"].append(prompt)
        answer = client(prompt)
        log["response_history"].append(answer)
        return answer

    def verified(self, client: Client, row: dict, answer: str, log: dict) -> bool:
        return bool(row["ground_truth"]) and self.accept(self.ask(client, "verify", row, self.extract(answer), log))

    def run(self, client: Client, row: dict) -> dict:
        """One row's search. A failing first answer gives status 'error'; failing strategies leave the answer as it was."""
        log: dict = {"query_history": [], "response_history": [], "strategies_used": []}
        out = {"process_id": row["process_id"], "question": row["question"], "ground_truth": row["ground_truth"], "response": None, "found_correct_answer": False, "guided": False, "status": "success", "error": None, **log}
        try:
            current = self.ask(client, "initial", row, "", log)
            found = self.verified(client, row, current, log)
            if found:
                log["strategies_used"].append("Initial response was correct")
            tried = 0
            while not found and tried < self.attempts:
                name = self.names[tried % len(self.names)]
                for level in range(self.depth):
                    if len(log["strategies_used"]) >= self.most_strategies:
                        break
                    if not self.prompts.get(name):
                        continue
                    try:
                        better = self.extract(self.ask(client, name, row, current, log))
                    except (KeyError, IndexError):
                        log["strategies_used"].append(f"Failed: {name}")
                        continue
                    except Exception:
                        continue
                    if better != current:
                        current = better
                        log["strategies_used"].append(f"Attempt {tried + 1}-{level + 1}: {name}")
                        found = self.verified(client, row, current, log)
                        if found:
                            break
                tried += 1
            if not found and self.efficient and row["ground_truth"] and self.prompts.get("guided"):
                # the prompt holds the truth, so its answer counts as right without a check, and is marked as guided; an
                # error or an empty answer leaves the last one
                try:
                    answer = self.ask(client, "guided", row, current, log)
                    if answer:
                        current, found = answer, True
                        out["guided"] = True
                        log["strategies_used"].append("Guided Analysis")
                except Exception:
                    pass
            out |= {"response": current, "found_correct_answer": found}
        except Exception as problem:
            out |= {"status": "error", "error": str(problem)[:1000]}
        return out


NO_STEPS = "No reasoning steps provided."


def natural_reasoning(client: Client, template: str, steps: list[str], question: str) -> str:
    """The steps as running text by a model; a fixed sentence without steps, the steps themselves where the model fails.

    The template has {reasoning_steps} and {question}, or two places {} for them.
    """
    if not len(steps):
        return NO_STEPS
    joined = "\n---\n".join(steps)
    named = "{reasoning_steps}" in template and "{question}" in template
    try:
        return client(template.format(reasoning_steps=joined, question=question) if named else template.format(joined, question))
    except Exception:
        return f"Could not synthesize natural reasoning. Raw history: {joined}"


def final_response(client: Client, template: str, reasoning: str, question: str) -> str:
    """The answer that follows from the reasoning; an empty template and the model's errors are errors."""
    if not template:
        raise ValueError("no template for the final response")
    return client(template.format(reasoning, question))


def ground_truth(client: Client, prompts: dict[str, str], case: dict) -> dict:
    """{'text', 'error', 'requires_manual_review'}: a model's account of a case; where it fails, what the case says itself.

    prompts by modality, '' for all others; their places are the case's fields.
    """
    modality = str(case.get("modality") or "")
    try:
        return {"text": client((prompts.get(modality) or prompts[""]).format(**case)), "error": None, "requires_manual_review": False}
    except Exception as problem:
        told = [case.get(k) for k in ("presentation", "caption", "case_discussion")]
        return {"text": "\n".join(t for t in told if t), "error": str(problem)[:1000], "requires_manual_review": True}


@dataclass
class Pipeline:
    """A whole sample: the search, the reasoning as running text, and the final response. An error gives a row of status 'error'."""

    search: Search
    reasoning_template: str
    final_template: str

    def run(self, client: Client, row: dict) -> dict:
        out = self.search.run(client, row) | {"complex_cot": None, "extracted_answer": None}
        if out["status"] == "error":
            return out
        try:
            out["extracted_answer"] = self.search.extract(out["response"])
            out["complex_cot"] = natural_reasoning(client, self.reasoning_template, out["response_history"], row["question"])
            out["response"] = final_response(client, self.final_template, out["complex_cot"], row["question"])
        except Exception as problem:
            out |= {"status": "error", "error": str(problem)[:1000]}
        return out


def text_client(send: Callable[..., str], **settings) -> Client:
    """A client of a function that takes a prompt and settings (model, temperature, tokens)."""
    return lambda prompt: send(prompt, **settings)


def content_parts(prompt: str, images: list[str]) -> list[dict]:
    """A prompt and its images as parts of a message: addresses as they are, files of this machine in base64; files that are
    not there are an error.
    """
    parts: list[dict] = [{"type": "text", "text": prompt}]
    for image in images:
        if not image.startswith(("http://", "https://", "data:")):
            with open(image, "rb") as source:
                kind = mimetypes.guess_type(image)[0] or "image/jpeg"
                image = f"data:{kind};base64,{base64.b64encode(source.read()).decode()}"
        parts.append({"type": "image_url", "image_url": {"url": image}})
    return parts


def rest_client(url: str, make: Callable[[str], dict], read: Callable[[dict], str], headers: dict[str, str] | None = None, timeout: float = 60.0) -> Client:
    """A client of a service that takes and gives JSON: make the request of a prompt, read the answer's text."""

    def ask(prompt: str) -> str:
        body = json.dumps(make(prompt)).encode()
        request = urllib.request.Request(url, body, {"Content-Type": "application/json", **(headers or {})})
        with urllib.request.urlopen(request, timeout=timeout) as answer:
            return read(json.loads(answer.read()))

    return ask


def ask_all(client: Client, prompts: list[str], at_once: int = 5) -> list[str | Exception]:
    """The answers to all prompts in their order, ``at_once`` asked at a time; an error stands in its prompt's place."""

    def one(prompt: str) -> str | Exception:
        try:
            return client(prompt)
        except Exception as problem:
            return problem

    with ThreadPoolExecutor(at_once) as pool:
        return list(pool.map(one, prompts))


def search(rows: DataFrame, make_client: Callable[[], Client], settings: Search | Pipeline) -> DataFrame:
    """RESULT rows of rows (process_id, question, ground_truth), written once to the shared folder; of a Pipeline, SAMPLE rows.

    make_client is called once a batch stream, on the worker. Rows are spread evenly first: a row takes many calls.
    """

    schema = SAMPLE if isinstance(settings, Pipeline) else RESULT

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        client = make_client()
        for frame in frames:
            clean = frame.astype(object).where(frame.notna(), "")
            yield pd.DataFrame([settings.run(client, row) for row in clean.to_dict("records")], columns=[c.split()[0] for c in schema.split(", ")])

    return materialize(rows.select(F.col("process_id").cast("string"), "question", "ground_truth").mapInPandas(work, schema), "search")


def with_retry(client: Client, tries: int = 2) -> Client:
    """A client that asks again after an error, at most ``tries`` times in all; an empty answer is an error."""

    def ask(prompt: str) -> str:
        for left in range(tries - 1, -1, -1):
            try:
                answer = client(prompt)
                if not answer:
                    raise ValueError("empty answer")
                return answer
            except Exception:
                if not left:
                    raise
        raise AssertionError

    return ask

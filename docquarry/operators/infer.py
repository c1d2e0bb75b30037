"""Inference: requests to replies, through a backend, in Arrow batches.

Each partition keeps a bounded number of requests in flight, over the borders of
batches, and pulls no more than it can send, so there is no queue to fill.
Retries happen at once and cover failures of any kind, unreadable replies
included; a task that Spark runs again asks again, so sinks leave out what is
there already.  A reply of any shape is a row: what can't be read is a failure.
"""

from __future__ import annotations

import json
import time
import urllib.error
import urllib.request
from collections.abc import Iterator
from concurrent.futures import Future, ThreadPoolExecutor
from dataclasses import dataclass
from queue import SimpleQueue
from threading import Semaphore
from typing import Protocol

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..arrow import ready
from ..functions.strict_json import first_object, parse_replies

#: Attempts for a pair, seconds for one of them.
ATTEMPTS, TIMEOUT = 4, 300

REPLIES = "custom_id string, content string, reasoning_content string, error string, has_response boolean, has_choices boolean, attempts int, elapsed_sec double"


class Backend(Protocol):
    def ask(self, body: str) -> dict:
        """The server's reply to a request body; raises on transport errors."""
        ...


@dataclass(frozen=True)
class Http:
    """An OpenAI-style chat server."""

    url: str
    timeout: float = TIMEOUT

    def ask(self, body: str) -> dict:
        request = urllib.request.Request(self.url.rstrip("/") + "/v1/chat/completions", body.encode(), {"Content-Type": "application/json"}, method="POST")
        with urllib.request.urlopen(request, timeout=self.timeout) as reply:
            return json.loads(reply.read().decode())


@dataclass(frozen=True)
class Rules:
    """A deterministic stand-in for a model: lines of the document that hold a quoted term of the instructions.

    Two lines or more are a yes, one is a maybe.
    """

    def ask(self, body: str) -> dict:
        from ..functions.text import terms_of_prompt
        from .pairs import PROMPT_DOCUMENT, PROMPT_HEAD, PROMPT_TAIL

        user = json.loads(body)["messages"][1]["content"]
        prompt, _, rest = user[len(PROMPT_HEAD) :].partition(PROMPT_DOCUMENT)
        terms = terms_of_prompt(prompt)
        lines = [x.strip() for x in rest[: len(rest) - len(PROMPT_TAIL)].split("\n")]
        hits = [x for x in lines if any(t in x.lower() for t in terms)]
        verdict = "yes" if len(hits) > 1 else "maybe" if hits else "no"
        text = f"{len(hits)} lines hold a term. " + json.dumps({"match": verdict, "blockquotes": hits}, ensure_ascii=False)
        return {"choices": [{"message": {"content": text}}]}


def attempt(backend: Backend, custom_id: str, body: str) -> tuple:
    """One reply as a row of ``REPLIES`` without its attempts."""
    start = time.monotonic()
    try:
        told = (*read_reply(backend.ask(body)),)
    except Exception as e:  # noqa: BLE001  any failure of a backend, or of its reply's form, is a failed attempt
        told = None, None, _failure(e), False, False
    return custom_id, *told, time.monotonic() - start


def _failure(e: Exception) -> str:
    """How a failure is told, by its kind."""
    match e:
        case urllib.error.HTTPError():
            return f"HTTPError {e.code}: {e.reason}"
        case urllib.error.URLError():
            return f"URLError: {e.reason}"
    return f"Exception: {e!r}"


def read_reply(reply: object) -> tuple:
    """``content, reasoning_content, error, has_response, has_choices`` of a server's reply; raises for forms that no chat server gives."""
    if reply is None:
        return None, None, None, False, False
    choices = reply.get("choices") or [] if isinstance(reply, dict) else None
    if choices == []:
        return None, None, None, True, False
    first = choices[0] if isinstance(choices, list) else None
    message = first.get("message") or {} if isinstance(first, dict) else None
    texts = [message.get(k) for k in ("content", "reasoning_content")] if isinstance(message, dict) else [message, first]
    if message is None or not all(t is None or isinstance(t, str) for t in texts):
        raise TypeError(f"a reply of another form: {json.dumps(reply)[:200]}")
    return *texts, None, True, True


def _usable(row: tuple) -> bool:
    found = first_object(row[1]) if row[1] and not row[3] else None
    return found is not None and "match" in found


def ask_all(backend: Backend, attempts: int = ATTEMPTS):
    def one(custom_id: str, body: str) -> tuple:
        spent = 0.0
        for k in range(1, attempts + 1):
            row = attempt(backend, custom_id, body)
            spent += row[6]
            if _usable(row):
                break
        return (*row[:6], k, spent)

    return one


def infer(requests: DataFrame, backend: Backend, *, concurrency: int = 8, attempts: int = ATTEMPTS) -> DataFrame:
    """Replies to ``requests`` (custom_id, body), at most ``2 * concurrency`` of each partition in flight, as they come.

    Bodies stay in the partitions that made them (``pairs.requests`` deals out the pairs' ids).
    """
    ready(requests.sparkSession)
    narrow = requests.select("custom_id", "body")
    names = [x.split(" ")[0] for x in REPLIES.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        one = ask_all(backend, attempts)
        with ThreadPoolExecutor(concurrency) as pool:
            room, ended, asked = Semaphore(2 * concurrency), SimpleQueue(), 0

            def end(reply: Future) -> None:
                ended.put(reply)
                room.release()

            for batch in batches:
                for custom_id, body in zip(batch["custom_id"], batch["body"]):
                    room.acquire()  # whichever ends first makes room
                    pool.submit(one, custom_id, body).add_done_callback(end)
                asked += len(batch)
                rows = [ended.get().result() for _ in range(ended.qsize())]
                asked -= len(rows)
                yield pd.DataFrame(rows, columns=names)
            yield pd.DataFrame([ended.get().result() for _ in range(asked)], columns=names)

    return narrow.mapInPandas(run, REPLIES)


def outcomes(replies: DataFrame, completed: DataFrame) -> DataFrame:
    """Parsed replies with ``outcome``: saved, skipped (completed before) or failed."""
    parsed = parse_replies(replies)
    known = completed.select("result_id", "category_id").distinct().withColumn("known", F.lit(True))
    parsed = parsed.join(known, ["result_id", "category_id"], "left")
    return parsed.withColumn("outcome", F.when(F.col("failure").isNotNull(), "failed").when(F.col("known"), "skipped").otherwise("saved")).drop("known")


#: Columns of a run's tallies.
TALLIES = ("processed", "saved", "skipped", "failed", "processing_seconds")


def run_tallies(rows: DataFrame) -> DataFrame:
    """Processed, saved, skipped and failed pairs, and the seconds spent on requests."""
    count = lambda name: F.count_if(F.col("outcome") == name).alias(name)
    return rows.agg(F.count("*").alias("processed"), count("saved"), count("skipped"), count("failed"), F.coalesce(F.sum("elapsed_sec"), F.lit(0.0)).alias("processing_seconds"))


def request_times(replies: DataFrame) -> DataFrame:
    """Mean, least and most seconds of requests as texts; nulls if there are none."""
    shown = lambda c: F.when(c.isNotNull(), F.format_string("%.2fs", c))
    return replies.agg(*(shown(f("elapsed_sec")).alias(f"request_time_{n}") for n, f in (("avg", F.avg), ("min", F.min), ("max", F.max))))

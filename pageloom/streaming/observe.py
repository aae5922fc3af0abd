"""Observation of books by a model: one request a scan, in order, with what the earlier scans showed; resumable.

The client is a plug-in: any object with complete(payload) -> dict. Books run side by side, the scans of a book one after
the other, since each request holds a summary of those before.
"""

from __future__ import annotations

import json
import random
import time
from collections.abc import Callable
from dataclasses import dataclass, field
from typing import Any

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pageloom.sources.inventory import worklist

#: HTTP statuses that are tried again, first and longest wait in seconds.
RETRIED, FIRST_WAIT, LONGEST_WAIT = (408, 409, 429), 2.0, 60.0
OBSERVATIONS = "book_id string, scan_id string, scan_index int, observation string, call_id string"
CALLS = "book_id string, scan_id string, call_id string, stage string, attempt int, status string, prompt_tokens bigint, completion_tokens bigint, cost_usd double, latency_s double, served_model string, error string"


class InvalidReply(ValueError):
    """A reply that can't be used: refused, cut off, empty or off its schema."""


class HttpFailure(RuntimeError):
    def __init__(self, status: int, retry_after: float | None = None):
        super().__init__(f"HTTP {status}")
        self.status, self.retry_after = status, retry_after


class RequestFailed(RuntimeError):
    """All attempts failed; `calls` has a record of each."""

    def __init__(self, message: str, calls: list[dict]):
        super().__init__(message)
        self.calls = calls


@dataclass
class Reply:
    value: Any
    calls: list[dict]


def wait(attempt: int, retry_after: float | None = None, rng: Callable[[], float] = random.random) -> float:
    """Seconds before the next attempt: doubled each time up to a bound, with a random half, or what the server asks for."""
    if retry_after is not None:
        return min(retry_after, LONGEST_WAIT)
    return min(LONGEST_WAIT, FIRST_WAIT * 2 ** (attempt - 1)) * (0.5 + 0.5 * rng())


#: What makes the first choice of a reply unusable, by name; the first that applies is reported.
FAULTS: list[tuple[str, Callable[[dict], bool]]] = [
    ("refused", lambda c: bool(c.get("refusal"))),
    ("cut off by the output limit", lambda c: c.get("finish_reason") == "length"),
    ("empty", lambda c: not c.get("content")),
]


def parse_reply(raw: dict, check: Callable[[Any], Any]) -> Any:
    """The checked value of a reply, or InvalidReply."""
    first = next(iter(raw.get("choices") or []), None)
    fault = "no choices" if first is None else next((name for name, has in FAULTS if has(first)), None)
    if fault:
        raise InvalidReply(fault)
    try:
        return check(json.loads(first["content"]))
    except (ValueError, KeyError, TypeError) as exc:
        raise InvalidReply(f"not of its schema: {exc}") from None


def build_payload(model: str, system: str, user: str, image_url: str | None = None, schema: dict | None = None, most: int = 4000, extra: dict | None = None) -> dict:
    content: list[dict] = [{"type": "text", "text": user}]
    if image_url:
        content.append({"type": "image_url", "image_url": {"url": image_url}})
    body = {"model": model, "max_completion_tokens": most, "messages": [{"role": "system", "content": system}, {"role": "user", "content": content}]}
    if schema:
        body["response_format"] = {"type": "json_schema", "json_schema": {"name": "reply", "strict": True, "schema": schema}}
    return body | (extra or {})


@dataclass
class Requests:
    """Requests with retries; one record an attempt."""

    client: Any
    max_retries: int = 3
    sleep: Callable[[float], None] = time.sleep
    clock: Callable[[], float] = time.monotonic
    rng: Callable[[], float] = field(default=random.random)

    def send(self, payload: dict, check: Callable[[Any], Any], prefix: str, stage: str) -> Reply:
        calls: list[dict] = []
        for attempt in range(1, self.max_retries + 2):
            began, after = self.clock(), None
            record = {"call_id": f"{prefix}-{attempt}", "stage": stage, "attempt": attempt, "status": "ok"}
            try:
                raw = self.client.complete(payload)
                use = raw.get("usage") or {}
                record |= {k: use.get(k) for k in ("prompt_tokens", "completion_tokens", "cost_usd")} | {"served_model": raw.get("model")}
                value = parse_reply(raw, check)
                calls.append(record | {"latency_s": self.clock() - began})
                return Reply(value, calls)
            except InvalidReply as exc:
                record |= {"status": "invalid_response", "error": str(exc)}
                again = True
            except HttpFailure as exc:
                record |= {"status": "http_error", "error": str(exc)}
                again, after = exc.status in RETRIED or exc.status >= 500, exc.retry_after
            except ConnectionError as exc:
                record |= {"status": "connection_error", "error": str(exc)}
                again = True
            calls.append(record | {"latency_s": self.clock() - began})
            if not again or attempt > self.max_retries:
                raise RequestFailed(record["error"], calls)
            self.sleep(wait(attempt, after, self.rng))
        raise AssertionError


class FixtureClient:
    """Answers from a table of recorded replies by prompt; deterministic, without a network."""

    def __init__(self, answer: Callable[[dict], dict]):
        self.answer = answer

    def complete(self, payload: dict) -> dict:
        return self.answer(payload)


def observe_books(scans: DataFrame, client: Callable[[], Any], payload: Callable[[dict, list[dict]], dict], check: Callable[[Any], Any] = lambda x: x, max_retries: int = 3, sleep: Callable[[float], None] = time.sleep) -> DataFrame:
    """One row a scan: OBSERVATIONS and its calls as JSON. A scan whose request fails has no observation, and the book goes on.

    payload(scan, earlier) builds the request from the scan's row and the earlier observations of its book. The fold needs a
    book's scans together; a book is the unit that a task holds. Between attempts a task waits as wait() says. Rows with
    `asked` False are history: they are passed to later scans but neither requested nor returned.
    """

    def run(f: pd.DataFrame) -> pd.DataFrame:
        requests, earlier, out = Requests(client(), max_retries, sleep=sleep), [], []
        for row in f.sort_values("scan_index").to_dict("records"):
            done, calls = row.get("observation"), []
            call, asked = row.get("call_id"), bool(row.pop("asked", True))
            if done is None and asked:
                try:
                    reply = requests.send(payload(row, earlier), check, f"{row['book_id']}/{row['scan_id']}", "observe")
                    done, calls, call = json.dumps(reply.value, ensure_ascii=False), reply.calls, reply.calls[-1]["call_id"]
                except RequestFailed as exc:
                    calls, call = exc.calls, None
            earlier.append({"scan_index": row["scan_index"], "observation": json.loads(done) if done else None})
            if asked:
                out.append((row["book_id"], row["scan_id"], row["scan_index"], done, call, json.dumps(calls)))
        return pd.DataFrame(out, columns=["book_id", "scan_id", "scan_index", "observation", "call_id", "calls"])

    return scans.groupBy("book_id").applyInPandas(run, OBSERVATIONS + ", calls string")


def observe_in_rounds(scans: DataFrame, store: str, client: Callable[[], Any], payload: Callable[[dict, list[dict]], dict], check: Callable[[Any], Any] = lambda x: x, max_retries: int = 3, per_round: int = 1, sleep: Callable[[float], None] = time.sleep) -> DataFrame:
    """Observes all books, storing results after each round in the folder `store`, and returns the latest row of each scan.

    A round requests the next per_round scans of every book side by side and appends their rows; what a lost executor repeats
    is one round's requests of its books at most. A later run over the same store requests only scans that have no
    observation yet, those that failed before included. Rounds end when each open scan has been asked once.
    """
    spark = scans.sparkSession
    fields = OBSERVATIONS + ", calls string"

    def stored() -> DataFrame:
        try:
            d = spark.read.schema(fields + ", round int").parquet(store)
            d.isEmpty()
            return d
        except AnalysisException:
            return spark.createDataFrame([], fields + ", round int")

    first = (stored().agg(F.max("round")).first()[0] or 0) + 1
    k = first
    while True:
        d = stored()
        seen = latest(d).where("observation is not null").select("book_id", "scan_id", "observation", "call_id")
        tried = d.where(F.col("round") >= first).select("book_id", "scan_id").distinct().withColumn("tried", F.lit(True))
        rows = scans.join(seen, ["book_id", "scan_id"], "left").join(tried, ["book_id", "scan_id"], "left")
        rows = rows.withColumn("open", F.col("observation").isNull() & F.col("tried").isNull())
        nth = F.sum(F.col("open").cast("int")).over(Window.partitionBy("book_id").orderBy("scan_index").rowsBetween(Window.unboundedPreceding, 0))
        rows = rows.withColumn("nth", nth).withColumn("asked", F.col("open") & (F.col("nth") <= per_round))
        books = rows.where("asked").select("book_id").distinct()
        if books.isEmpty():
            return latest(d)
        # history up to the last scan that is asked for; books without open scans are not read again
        rows = rows.where("asked or not open").join(books, "book_id", "left_semi").drop("tried", "open", "nth")
        out = observe_books(rows, client, payload, check, max_retries, sleep)
        out.withColumn("round", F.lit(k)).write.mode("append").parquet(store)
        k += 1


def latest(stored: DataFrame) -> DataFrame:
    """The last row of each scan, one with an observation before one without."""
    best = Window.partitionBy("book_id", "scan_id").orderBy(F.col("observation").isNull(), F.desc("round"))
    return stored.withColumn("_n", F.row_number().over(best)).where("_n = 1").drop("_n")


def call_table(observed: DataFrame) -> DataFrame:
    """The calls as a table, for the usage operators."""
    one = "struct<call_id:string,stage:string,attempt:int,status:string,prompt_tokens:bigint,completion_tokens:bigint,cost_usd:double,latency_s:double,served_model:string,error:string>"
    d = observed.select("book_id", "scan_id", F.explode(F.from_json("calls", f"array<{one}>")).alias("c"))
    return d.select("book_id", "scan_id", "c.*")


def resume(scans: DataFrame, stored: DataFrame) -> DataFrame:
    """scans with the observations stored so far; only books with work left come back, whole, since later scans build on earlier ones."""
    open_books = worklist(scans, stored.where("observation is not null")).select("book_id").distinct()
    return scans.join(open_books, "book_id", "left_semi").join(stored.select("book_id", "scan_id", "observation", "call_id"), ["book_id", "scan_id"], "left")

"""Remote services and language models behind protocols: what they return lands in tables, and rules work on those.

A fetcher or a client is made once per Python worker and used for batches of distinct requests, so a service is asked once
for a key however many events share it. The file-backed ones serve tests and repeated runs.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from typing import Protocol

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Answers after which a request is tried again.
RETRIED = (429, 502, 503, 504)


class Fetcher(Protocol):
    def fetch(self, request: str) -> tuple[int, str]:
        """Status and body for a request (JSON text)."""


class Client(Protocol):
    def ask(self, prompts: list[str]) -> list[str]:
        """An answer for each prompt."""


class Landed:
    """Answers that are on file already: a mapping of requests to bodies."""

    def __init__(self, bodies: dict[str, str]):
        self.bodies = bodies

    def fetch(self, request: str) -> tuple[int, str]:
        return (200, self.bodies[request]) if request in self.bodies else (404, "")

    def ask(self, prompts: list[str]) -> list[str]:
        return [self.bodies.get(p, "") for p in prompts]


def with_retries(fetch: Callable[[], tuple[int, str]], retries: int = 3, wait: Callable[[int], float] = lambda n: 3.0 * (n + 1), sleep: Callable[[float], None] = time.sleep) -> tuple[int, str]:
    for n in range(retries + 1):
        status, body = fetch()
        if status not in RETRIED or n == retries:
            return status, body
        sleep(wait(n))
    raise AssertionError


def fetched(requests: DataFrame, column: str, make: Callable[[], Fetcher], retries: int = 3) -> DataFrame:
    """request, status, body for each distinct request."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fetcher = make()
        for batch in batches:
            got = [with_retries(lambda r=r: fetcher.fetch(r), retries) for r in batch["request"]]
            yield pd.DataFrame({"request": batch["request"], "status": [s for s, _ in got], "body": [b for _, b in got]})

    return requests.select(F.col(column).alias("request")).distinct().mapInPandas(run, "request string, status int, body string")


def answered(prompts: DataFrame, column: str, make: Callable[[], Client], batch: int = 16) -> DataFrame:
    """The rows with ``answer``; prompts go to the client in small batches."""
    schema = ", ".join(f"`{n}` {k}" for n, k in prompts.dtypes) + ", answer string"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        client = make()
        for rows in batches:
            texts = rows[column].tolist()
            answers = [a for i in range(0, len(texts), batch) for a in client.ask(texts[i : i + batch])]
            yield rows.assign(answer=answers)

    return prompts.mapInPandas(run, schema)


def search_results(xml: str = "body"):
    """(title, url, published) of the items of a news feed; titles without their outlet, of eight characters at least."""
    part = lambda item, tag: F.trim(F.regexp_replace(F.regexp_extract(item, rf"(?is)<{tag}[^>]*>(?:<!\[CDATA\[)?(.*?)(?:\]\]>)?</{tag}>", 1), "<[^>]+>", ""))
    items = F.regexp_extract_all(F.col(xml), F.lit(r"(?is)<item\b[^>]*>(.*?)</item>"), F.lit(1))
    rows = F.transform(items, lambda i: F.struct(F.regexp_replace(part(i, "title"), r"\s+-\s+[^-]{2,60}$", "").alias("title"), part(i, "link").alias("url"), part(i, "pubDate").alias("published")))
    return F.filter(rows, lambda r: F.length(r["title"]) >= 8)

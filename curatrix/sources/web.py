"""Fetching addresses from the workers, politely and with a bounded number of tries.

Answers are not repeatable, so callers write what they get before they use it twice.
"""

from __future__ import annotations

import time
import urllib.error
import urllib.request
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curatrix.session import arrow_safe, materialize

FETCHED = "url string, status int, content_type string, body binary, tries int, error string"
# How files of the usual image formats begin.
MAGIC = {"jpg": "FFD8FF", "png": "89504E470D0A1A0A", "gif": "47494638", "bmp": "424D", "webp": "52494646", "tiff": "49492A00", "tiff_big_endian": "4D4D002A"}


@dataclass
class Fetcher:
    """Settings of a worker's requests: an answer of the server's own fault and a lost connection are tried again after a pause."""

    tries: int = 3
    timeout: float = 10.0
    pause: float = 1.0
    most_bytes: int = 50_000_000
    at_once: int = 1
    agent: str = "Mozilla/5.0"

    def fetch(self, url: str | None) -> dict:
        row = {"url": url, "status": None, "content_type": None, "body": None, "tries": 0, "error": None}
        if not url or not url.startswith(("http://", "https://")):
            return row | {"error": "no address"}
        for attempt in range(1, self.tries + 1):
            row |= {"tries": attempt, "error": None}
            try:
                with urllib.request.urlopen(urllib.request.Request(url, headers={"User-Agent": self.agent}), timeout=self.timeout) as answer:
                    body = answer.read(self.most_bytes + 1)
                    row |= {"status": answer.status, "content_type": answer.headers.get_content_type()}
                    return row | ({"error": "too long"} if len(body) > self.most_bytes else {"body": body})
            except urllib.error.HTTPError as problem:
                row |= {"status": problem.code, "error": str(problem)}
                if problem.code < 500 and problem.code != 429:
                    return row
            except (OSError, ValueError) as problem:
                row["error"] = str(problem)
            if attempt < self.tries:
                time.sleep(self.pause * 2 ** (attempt - 1))
        return row

    def run(self, frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        with ThreadPoolExecutor(self.at_once) as pool:
            for frame in frames:
                yield arrow_safe(pd.DataFrame(list(pool.map(self.fetch, frame["url"])), columns=[c.split()[0] for c in FETCHED.split(", ")]).astype({"status": "Int32", "tries": "int32"}))


def fetched(urls: DataFrame, settings: Fetcher | None = None) -> DataFrame:
    """FETCHED rows of the distinct addresses (a column url), written once to the shared folder. An address that fails keeps
    its row, with the error.
    """
    return materialize(urls.select("url").distinct().mapInPandas((settings or Fetcher()).run, FETCHED), "fetched")


def is_image(body: Column, content_type: Column) -> Column:
    """Whether an answer is an image: its type says so, or nothing, and its first bytes are those of a usual format."""
    start = F.hex(F.substring(body, 1, 8))
    known = F.lit(False)
    for magic in MAGIC.values():
        known = known | F.startswith(start, F.lit(magic))
    said = F.coalesce(content_type, F.lit("application/octet-stream"))
    return F.coalesce(known & (F.startswith(said, F.lit("image/")) | said.isin("application/octet-stream", "text/plain")), F.lit(False))


def valid_images(answers: DataFrame, least_bytes: int = 100) -> DataFrame:
    """(url, body) of the answers that are images of at least so many bytes."""
    return answers.where((F.col("status") == 200) & (F.octet_length("body") >= least_bytes) & is_image(F.col("body"), F.col("content_type"))).select("url", "body")

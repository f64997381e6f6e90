"""Fetching over HTTP, list files, and bulk downloads."""

from __future__ import annotations

import hashlib
import os
import ssl
import sys
import time
import urllib.error
import urllib.request
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmill.functions.urls import retry_after


@dataclass
class Client:
    """Requests with retries after 429, 5xx and network errors; waits double up to ``longest`` seconds."""

    retries: int = 3
    wait: float = 0.5
    longest: float = 30.0
    timeout: float = 30.0
    network_wait: float = 0.0
    """The shortest wait after a network error, as far as ``longest`` allows it."""
    verify: bool = True
    """Off: certificates aren't checked."""
    sleep = staticmethod(time.sleep)

    def _context(self) -> ssl.SSLContext | None:
        return None if self.verify else ssl._create_unverified_context()

    def get(self, url: str) -> tuple[int, bytes, int]:
        return self.request(url)

    def post(self, url: str, data: bytes, kind: str = "application/octet-stream") -> tuple[int, bytes, int]:
        return self.request(url, method="POST", data=data, headers={"Content-Type": kind})

    def put(self, url: str, data: bytes, kind: str = "application/octet-stream") -> tuple[int, bytes, int]:
        return self.request(url, method="PUT", data=data, headers={"Content-Type": kind})

    def request(self, url: str, first: int | None = None, method: str = "GET", data: bytes | None = None, headers: dict[str, str] | None = None) -> tuple[int, bytes, int]:
        """(status, body, attempts); ``first``: only so many bytes."""
        attempt = 0
        while True:
            attempt += 1
            head = dict(headers or {}) | ({"Range": f"bytes=0-{first - 1}"} if first else {})
            pause = None
            try:
                with urllib.request.urlopen(urllib.request.Request(url, data=data, headers=head, method=method), timeout=self.timeout, context=self._context() if url.startswith("https") else None) as r:
                    return getattr(r, "status", None) or 200, r.read(first) if first else r.read(), attempt
            except urllib.error.HTTPError as e:
                status, body = e.code, e.read(4096)
                pause = retry_after(e.headers.get("Retry-After", "")) if e.headers else None
                if status != 429 and status < 500:
                    return status, body, attempt
            except (urllib.error.URLError, OSError) as e:
                status, body = 0, str(e).encode()
            if attempt > self.retries:
                return status, body, attempt
            wait = pause if pause is not None else self.wait * 2 ** (attempt - 1)
            self.sleep(min(self.longest, max(wait, self.network_wait) if status == 0 else wait))


def first_bytes(source: str, n: int = 20_000) -> bytes:
    """The first bytes of a URL, a file, or (-) the standard input."""
    if source == "-":
        return sys.stdin.buffer.read(n)
    if "://" in source:
        return Client().request(source, n)[1][:n]
    with open(source, "rb") as f:
        return f.read(n)


def read_list(spark: SparkSession, path: str) -> DataFrame:
    """The lines of a list file that aren't blank and don't begin with #."""
    line = F.trim("value")
    return spark.read.text(path).where((line != "") & ~line.startswith("#")).select(line.alias("line"))


ATTEMPTS = "url string, status int, attempts int, bytes long, file string, ok boolean, error string"


def download(urls: DataFrame, folder: str, client: Client | None = None, partitions: int = 16, fail_fast: bool = False) -> DataFrame:
    """Fetch every URL once; bodies go to ``folder`` (shared by all machines) under the sha1 of their URL, by a renamed temporary file. A 404 counts as done; ``fail_fast``: any other failure ends the job."""
    client = client or Client(wait=2.0, longest=60.0, network_wait=10.0)

    def run(frames):
        for frame in frames:
            out = []
            for url in frame["url"]:
                status, body, tries = client.request(url)
                name = hashlib.sha1(url.encode()).hexdigest()
                good = 200 <= status < 300
                if fail_fast and not good and status != 404:
                    raise RuntimeError(f"{url}: {status} after {tries} attempts")
                if good:
                    os.makedirs(folder, exist_ok=True)
                    temp = os.path.join(folder, f".{name}.{os.getpid()}")
                    with open(temp, "wb") as f:
                        f.write(body)
                    os.replace(temp, os.path.join(folder, name))
                out.append((url, status, tries, len(body) if good else 0, name if good else None, good or status == 404, None if good else body[:200].decode("utf-8", "replace")))
            yield pd.DataFrame(out, columns=[x.split()[0] for x in ATTEMPTS.split(", ")])

    return urls.select("url").distinct().repartition(partitions, "url").mapInPandas(run, ATTEMPTS)

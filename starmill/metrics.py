"""Run metrics: counters and durations by label, buffered, flushed to a sink."""

from __future__ import annotations

import json
import time
from collections import defaultdict
from collections.abc import Callable, Iterable

Series = dict[str, object]


def nearest_rank(values: list[float], p: float) -> float:
    s = sorted(values)
    return s[int(p / 100 * (len(s) - 1) + 0.5)]


class Metrics:
    """Counters and histograms; ``flush`` gives them to the sink and forgets them, even if the sink fails."""

    COUNTERS = ("etl.step.total", "etl.records.total", "etl.batches.total", "etl.http.total")
    TIMES = ("etl.step.duration_seconds", "etl.http.duration_seconds")

    def __init__(self, sink: Callable[[list[Series]], None], every: float = 60.0, now: Callable[[], float] = time.time):
        self.sink, self.every, self.now, self.last = sink, every, now, now()
        self._reset()

    def _reset(self) -> None:
        self.counts: dict[tuple, float] = defaultdict(float)
        self.times: dict[tuple, list[float]] = defaultdict(list)

    def count(self, name: str, n: float = 1, **labels: str) -> None:
        if name in self.COUNTERS and n > 0:
            self.counts[name, tuple(sorted(labels.items()))] += n
        self._maybe()

    def observe(self, name: str, seconds: float, **labels: str) -> None:
        if name in self.TIMES:
            self.times[name, tuple(sorted(labels.items()))].append(seconds)
        self._maybe()

    def step(self, job: str, step: str, seconds: float, ok: bool = True) -> None:
        self.count("etl.step.total", job=job, step=step, status="ok" if ok else "error")
        self.observe("etl.step.duration_seconds", seconds, job=job, step=step)

    def rows(self, job: str, kind: str, n: int) -> None:
        self.count("etl.records.total", n, job=job, kind=kind)

    def batches(self, job: str, n: int) -> None:
        self.count("etl.batches.total", n, job=job)

    def http(self, method: str, status: int, seconds: float) -> None:
        self.count("etl.http.total", method=method, status=str(status))
        self.observe("etl.http.duration_seconds", seconds, method=method, status=str(status))

    def run(self, job: str, stats) -> None:
        for _, kind, value in stats.rows(job):
            if kind.startswith("step:"):
                self.step(job, kind[5:], value)
            else:
                self.rows(job, kind, int(value))

    def _maybe(self) -> None:
        if self.now() - self.last >= self.every:
            self.flush()

    def flush(self) -> None:
        out: list[Series] = [{"metric": n, "labels": dict(l), "value": v} for (n, l), v in sorted(self.counts.items())]
        for (n, l), values in sorted(self.times.items()):
            for p in (50, 90, 95, 99):
                out.append({"metric": f"{n}.p{p}", "labels": dict(l), "value": nearest_rank(values, p)})
            out += [{"metric": f"{n}.max", "labels": dict(l), "value": max(values)}, {"metric": f"{n}.count", "labels": dict(l), "value": len(values)}]
        self._reset()
        self.last = self.now()
        if out:
            self.sink(out)

    close = flush


def http_series(url: str, headers: dict[str, str] | None = None, client=None, now: Callable[[], float] = time.time) -> Callable[[list[Series]], None]:
    """A sink that posts each flush as one JSON body {"series": [{metric, points, tags}]}; a refusal raises."""
    from starmill.sources.web import Client

    client = client or Client()

    def send(series: list[Series]) -> None:
        at = int(now())
        body = {"series": [{"metric": s["metric"], "points": [[at, s["value"]]], "tags": [f"{k}:{v}" for k, v in sorted(s["labels"].items())]} for s in series]}
        status, told, _ = client.request(url, method="POST", data=json.dumps(body).encode(), headers={"Content-Type": "application/json", **(headers or {})})
        if not 200 <= status < 300:
            raise RuntimeError(f"{url}: {status} {told[:200]!r}")

    return send


def json_lines(path: str) -> Callable[[Iterable[Series]], None]:
    def write(series: Iterable[Series]) -> None:
        with open(path, "a", encoding="utf-8") as f:
            f.writelines(json.dumps(s, sort_keys=True) + "\n" for s in series)

    return write

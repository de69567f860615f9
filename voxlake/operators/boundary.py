"""Narrow interfaces to what lies outside the engine: a paid transcriber with quotas, a speech detector, a downloader.

The control flow (pacing, retries, failover between keys and models, deadlines) runs on the driver over plain objects;
data goes in and out as DataFrames (see state.fill_cache)."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field
from typing import Protocol

import numpy as np


class QuotaExhausted(Exception):
    """The day's allowance of one key and model is spent."""


class AccessDenied(Exception):
    """A key is refused, whatever the model."""


class Busy(Exception):
    """Try again later; `delay` is the server's own wish in seconds, if it has one."""

    def __init__(self, delay: float | None = None):
        super().__init__(f"busy, {delay}")
        self.delay = delay


class Transcriber(Protocol):
    def __call__(self, audio: bytes, key: str, model: str) -> list[dict]: ...


class RegionDetector(Protocol):
    def __call__(self, samples: np.ndarray, rate: int) -> list[tuple[float, float]]: ...


def paced(call: Callable[[], list], *, attempts: int = 8, step: float = 15.0, sleep: Callable[[float], None] = time.sleep) -> list:
    """call, again and again while it is busy: the n-th wait is the server's wish or n times `step`, whichever is longer."""
    for n in range(attempts):
        try:
            return call()
        except Busy as e:
            if n + 1 == attempts:
                raise
            sleep(max(e.delay or 0.0, step * (n + 1)))
    raise AssertionError


@dataclass
class Failover:
    """Walks keys (outer) and models (inner); spent pairs and refused keys are retired. `stop` says why it gave up: denied,
    quota or session."""

    keys: list[str]
    models: list[str]
    call: Transcriber
    deadline: float = float("inf")
    poll: float = 0.0  # seconds to wait for new allowance; 0: do not wait
    clock: Callable[[], float] = time.time
    sleep: Callable[[float], None] = time.sleep
    spent: set = field(default_factory=set)
    refused: set = field(default_factory=set)
    requests: int = 0
    waits: int = 0
    stop: str | None = None

    def pairs(self) -> Iterable[tuple[int, str]]:
        for k in range(len(self.keys)):
            for m in self.models:
                if k not in self.refused and (k, m) not in self.spent:
                    yield k, m

    def transcribe(self, audio: bytes) -> list[dict] | None:
        while True:
            for k, m in self.pairs():
                if k in self.refused:
                    continue
                try:
                    out = self.call(audio, self.keys[k], m)
                    self.requests += 1
                    return out
                except QuotaExhausted:
                    self.spent.add((k, m))
                except AccessDenied:
                    self.refused.add(k)
            if len(self.refused) >= len(self.keys):
                self.stop = "denied"
            elif not self.poll:
                self.stop = "quota"
            elif self.deadline - self.clock() < self.poll:
                self.stop = "session"
            else:
                self.waits += 1
                self.sleep(self.poll)
                self.spent.clear()
                continue
            return None


@dataclass
class EnergyDetector:
    """A stand-in for a neural voice detector: stretches of frames louder than a share of the loudest, at least `least` long."""

    share: float = 0.1
    frame: float = 0.02
    least: float = 0.2
    bridge: float = 0.1

    def __call__(self, samples: np.ndarray, rate: int) -> list[tuple[float, float]]:
        n = max(1, int(self.frame * rate))
        frames = np.asarray(samples, float)[: len(samples) // n * n].reshape(-1, n)
        if not len(frames):
            return []
        loud = np.sqrt((frames**2).mean(1))
        on = loud > self.share * max(loud.max(), 1e-9)
        edge = np.flatnonzero(np.diff(np.concatenate(([0], on.astype(int), [0]))))
        spans = [(a * n / rate, b * n / rate) for a, b in zip(edge[::2], edge[1::2], strict=True)]
        joined: list[tuple[float, float]] = []
        for a, b in spans:
            if joined and a - joined[-1][1] <= self.bridge:
                joined[-1] = (joined[-1][0], b)
            else:
                joined.append((a, b))
        return [(a, b) for a, b in joined if b - a >= self.least]


def resample(samples: np.ndarray, rate: int, target: int) -> np.ndarray:
    """Linear interpolation at the target rate, with a moving average before it when the rate goes down."""
    x = np.asarray(samples, np.float32)
    if rate == target or not len(x):
        return x
    if target < rate:
        n = max(1, round(rate / target))
        x = np.convolve(x, np.ones(n, np.float32) / n, mode="same")
    at = np.arange(int(len(x) * target / rate)) * rate / target
    return np.interp(at, np.arange(len(x)), x).astype(np.float32)


def detect_regions(audio, detector: RegionDetector, key: str = "episode"):
    """(key, start, end) of speech in rows (key, samples array<float>, rate)."""

    def work(batches):
        import pandas as pd

        for pdf in batches:
            rows = [(k, a, b) for k, s, r in zip(pdf[key], pdf["samples"], pdf["rate"], strict=True) for a, b in detector(np.asarray(s if s is not None else [], np.float32), int(r))]
            yield pd.DataFrame(rows, columns=[key, "start", "end"])

    return audio.select(key, "samples", "rate").mapInPandas(work, f"{key} string, start double, end double")

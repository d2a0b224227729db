"""Models behind the pipelines: what they must offer, offline stand-ins, and retries.

A provider is a plain picklable object; it runs in ``mapInPandas`` on the
executors.  Whatever fails for good becomes a null result, never a failed job.
"""

from __future__ import annotations

import hashlib
import json
import random
import threading
import time
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from typing import Protocol, TypeVar

R = TypeVar("R")
X = TypeVar("X")


class RateLimited(Exception):
    """The provider asks to wait."""


class HttpError(Exception):
    """An answer of a server with its status."""

    def __init__(self, status: int, message: str = ""):
        super().__init__(f"{status} {message}".strip())
        self.status = status


#: Statuses of servers that are worth another try.
RETRIED = frozenset({429, 500, 502, 503, 504})


def retried(error: Exception) -> bool:
    return isinstance(error, RateLimited) or (isinstance(error, HttpError) and error.status in RETRIED)


class Embedder(Protocol):
    name: str

    def embed(self, texts: list[str]) -> list[list[float] | None]: ...


class Model(Protocol):
    name: str

    def complete(self, prompt: str) -> str | None: ...


def with_retries(
    call: Callable[[], R], tries: int = 6, wait: float = 10.0, factor: float = 2.0, jitter: float = 0.2,
    sleep: Callable[[float], None] = time.sleep, limited: Callable[[], None] | None = None,
) -> R:
    """Call again after a growing, jittered wait while the provider limits the rate or a server fails for now; any other error and the last one go on."""
    for attempt in range(tries):
        try:
            return call()
        except Exception as error:
            if not retried(error) or attempt == tries - 1:
                raise
            if limited and attempt == 0:
                limited()
            sleep(wait * (1 + random.uniform(-jitter, jitter)))
            wait *= factor
    raise AssertionError("unreachable")


class Pool:
    """Keeps several calls of one task open, as many as the provider bears.

    The number grows by ``step`` after every ``streak`` calls that went well
    and shrinks by as much when the rate is limited, between ``least`` and
    ``most``.  A task has one pool; a provider that serves ``n`` tasks at once
    is to be given an ``n``-th of its limit.
    """

    def __init__(self, least: int = 4, most: int = 32, step: int = 4, streak: int = 50):
        self.least, self.most, self.step, self.streak = least, most, step, streak
        self.open = least
        self.well = 0
        self.running = 0
        self.turn = threading.Condition()

    def limited(self) -> None:
        with self.turn:
            self.open = max(self.least, self.open - self.step)
            self.well = 0

    def _run(self, call: Callable[[], R]) -> R:
        with self.turn:
            self.turn.wait_for(lambda: self.running < self.open)
            self.running += 1
        try:
            out = call()
            with self.turn:
                self.well += 1
                if self.well >= self.streak:
                    self.well, self.open = 0, min(self.most, self.open + self.step)
            return out
        finally:
            with self.turn:
                self.running -= 1
                self.turn.notify_all()

    def map(self, work: Callable[[X], R], items: Sequence[X]) -> list[R]:
        """The results in the order of the items; the first error goes on."""
        with ThreadPoolExecutor(self.most) as threads:
            return list(threads.map(lambda x: self._run(lambda: work(x)), items))


@dataclass
class HashEmbedder:
    """A stand-in: hashed bags of words, of unit length; the same text always gives the same vector."""

    dims: int = 64
    name: str = "hashed-words-1"

    def embed(self, texts: list[str]) -> list[list[float] | None]:
        out: list[list[float] | None] = []
        for text in texts:
            v = [0.0] * self.dims
            for word in (text or "").lower().split():
                h = int.from_bytes(hashlib.md5(word.encode()).digest()[:8], "big")
                v[h % self.dims] += 1.0 if h >> 63 else -1.0
            length = sum(x * x for x in v) ** 0.5
            out.append([x / length for x in v] if length else None)
        return out


@dataclass
class ScriptedModel:
    """A stand-in that answers each kind of prompt by rule, as JSON where a form is asked for."""

    name: str = "scripted-1"

    def complete(self, prompt: str) -> str | None:
        kind, _, body = prompt.partition("\n")
        digest = hashlib.md5(body.encode()).hexdigest()
        if kind == "TASK: question":
            return json.dumps({"question": f"What links the articles {digest[:6]}?", "answer": self._answer(body), "strict": True})
        if kind == "TASK: rubric":
            asked = hashlib.md5(body.rpartition("\nQUESTION: ")[2].encode()).hexdigest()
            score = 3 + int(asked[0], 16) % 3
            return json.dumps({"difficulty": ("high school", "graduate", "phd")[int(asked[1], 16) % 3], "askability": score, "synthesizability": score, "abstractiveness": 4, "conflict_synthesis": 4, "strict": True})
        if kind == "TASK: judge":
            given, _, expected = body.partition("\nRESPONSE: ")[2].partition("\nEXPECTED: ")
            same = " ".join(given.lower().split()) == " ".join(expected.lower().split())
            return json.dumps({"extracted_final_answer": given or "None", "reasoning": "compared", "correct": "yes" if same else "no", "strict": True})
        if kind == "TASK: answer with context":
            return self._answer(body.rpartition("\nQUESTION: ")[0])
        return f"I hold it for {digest[:4]}."

    @staticmethod
    def _answer(context: str) -> str:
        """What the stand-in makes of a context, whatever the question."""
        return f"Their subject {hashlib.md5(context.encode()).hexdigest()[6:12]}."

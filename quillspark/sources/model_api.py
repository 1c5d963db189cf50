"""The boundary to a hosted model: one call with retries, and asynchronous batch jobs with durable state.

The transport is a function (method, url, headers, body) -> (status, bytes), so tests and other
providers need no network. Used on the driver for batch jobs, and within partitions by
plans.runs.answered() for single calls, whose responses are to be written before they are used.
"""

from __future__ import annotations

import json
import os
import random
import time
import urllib.error
import urllib.request
import uuid
from collections.abc import Callable

import pandas as pd

Transport = Callable[[str, str, dict[str, str], bytes | None], tuple[int, bytes]]
#: Statuses worth another try, tries, and the longest wait in seconds.
RETRY_ON, TRIES, LONGEST_WAIT, TIMEOUT = frozenset({408, 409, 429, 500, 502, 503, 504}), 5, 20.0, 240


class ModelError(RuntimeError):
    """A call that failed for good; status is the last one seen, 0 if none came."""

    def __init__(self, status: int, text: str):
        super().__init__(f"model call failed with {status}: {text[:300]}")
        self.status = status


def over_http(method: str, url: str, headers: dict[str, str], body: bytes | None) -> tuple[int, bytes]:
    request = urllib.request.Request(url, data=body, headers=headers, method=method)
    try:
        with urllib.request.urlopen(request, timeout=TIMEOUT) as reply:
            return reply.status, reply.read()
    except urllib.error.HTTPError as e:
        return e.code, e.read()


def call(transport: Transport, method: str, url: str, headers: dict[str, str], body: bytes | None = None, sleep: Callable[[float], None] = time.sleep) -> bytes:
    """The body of a successful reply. Waits double from one second, with up to a second and a half of jitter."""
    status, data = 0, b""
    for k in range(TRIES):
        try:
            status, data = transport(method, url, headers, body)
        except OSError as e:
            status, data = 0, str(e).encode()
        if 200 <= status < 300:
            return data
        if status and status not in RETRY_ON:
            break
        if k + 1 < TRIES:
            sleep(min(2.0**k, LONGEST_WAIT) + random.uniform(0, 1.5))
    raise ModelError(status, data.decode("utf-8", "replace"))


def chat_client(url: str, key: str, transport: Transport = over_http) -> Callable[[pd.DataFrame], pd.DataFrame]:
    """A client for plans.runs.answered(): requests have doc_id, stage and body (JSON); input tokens come net of cached ones."""

    def client(requests: pd.DataFrame) -> pd.DataFrame:
        rows = []
        for doc, stage, body in zip(requests["doc_id"], requests["stage"], requests["body"]):
            began = time.monotonic()
            reply = json.loads(call(transport, "POST", url, {"Authorization": f"Bearer {key}", "Content-Type": "application/json"}, body.encode()))
            usage = reply.get("usage") or {}
            cached = (usage.get("prompt_tokens_details") or {}).get("cached_tokens") or 0
            text = reply["choices"][0]["message"]["content"]
            rows.append((doc, stage, text, (usage.get("prompt_tokens") or 0) - cached, usage.get("completion_tokens") or 0, 0, cached, time.monotonic() - began))
        return pd.DataFrame(rows, columns=["doc_id", "stage", "text", "input_tokens", "output_tokens", "cache_write_tokens", "cache_read_tokens", "latency_s"])

    return client


class BatchJobs:
    """Submit files of JSON lines as 24-hour jobs, and collect their results; state is one small JSON file per job."""

    def __init__(self, base: str, key: str, transport: Transport = over_http):
        self.base, self.transport = base.rstrip("/"), transport
        self.headers = {"Authorization": f"Bearer {key}"}

    def _json(self, method: str, path: str, body: dict | None = None) -> dict:
        data = None if body is None else json.dumps(body).encode()
        return json.loads(call(self.transport, method, self.base + path, self.headers | {"Content-Type": "application/json"}, data))

    def upload(self, lines: bytes, name: str = "requests.jsonl") -> str:
        mark = uuid.uuid4().hex
        part = lambda head, content: f"--{mark}\r\nContent-Disposition: form-data; {head}\r\n\r\n".encode() + content + b"\r\n"
        body = part('name="purpose"', b"batch") + part(f'name="file"; filename="{name}"', lines) + f"--{mark}--\r\n".encode()
        reply = call(self.transport, "POST", self.base + "/v1/files", self.headers | {"Content-Type": f"multipart/form-data; boundary={mark}"}, body)
        return json.loads(reply)["id"]

    def submit(self, lines: bytes, state: str) -> dict:
        """Upload and start a job, and keep its id in the file `state` before anything else can fail."""
        job = self._json("POST", "/v1/batches", {"input_file_id": self.upload(lines), "endpoint": "/v1/chat/completions", "completion_window": "24h"})
        kept = {"id": job["id"], "status": job.get("status", "validating")}
        with open(f"{state}.new", "w", encoding="utf-8") as out:
            json.dump(kept, out)
        os.replace(f"{state}.new", state)
        return kept

    def collect(self, state: str, to: str) -> str:
        """The job's status; the results are written to `to` only when it is completed."""
        with open(state, encoding="utf-8") as kept:
            job = self._json("GET", f"/v1/batches/{json.load(kept)['id']}")
        if job["status"] == "completed" and job.get("output_file_id"):
            data = call(self.transport, "GET", f"{self.base}/v1/files/{job['output_file_id']}/content", self.headers)
            with open(f"{to}.new", "wb") as out:
                out.write(data)
            os.replace(f"{to}.new", to)
        return job["status"]

import json

import pandas as pd
import pytest

from quillspark.sources import model_api


def scripted(*replies):
    left, seen = list(replies), []

    def transport(method, url, headers, body):
        seen.append((method, url, body))
        reply = left.pop(0)
        if isinstance(reply, Exception):
            raise reply
        return reply

    return transport, seen


def test_retries_then_succeeds():
    waits = []
    transport, seen = scripted((429, b""), OSError("reset"), (503, b""), (200, b"ok"))
    assert model_api.call(transport, "GET", "u", {}, sleep=waits.append) == b"ok"
    assert len(seen) == 4 and len(waits) == 3 and all(2**k <= w <= 2**k + 1.5 for k, w in enumerate(waits))


def test_gives_up():
    transport, seen = scripted((400, b"bad"))
    with pytest.raises(model_api.ModelError) as e:
        model_api.call(transport, "GET", "u", {}, sleep=lambda _: None)
    assert e.value.status == 400 and len(seen) == 1
    transport, seen = scripted(*[(500, b"")] * 5)
    with pytest.raises(model_api.ModelError):
        model_api.call(transport, "GET", "u", {}, sleep=lambda _: None)
    assert len(seen) == 5


def test_client_counts_tokens_net_of_cached():
    reply = {"choices": [{"message": {"content": "{}"}}], "usage": {"prompt_tokens": 10, "completion_tokens": 3, "prompt_tokens_details": {"cached_tokens": 4}}}
    transport, _ = scripted((200, json.dumps(reply).encode()))
    out = model_api.chat_client("u", "k", transport)(pd.DataFrame({"doc_id": ["a"], "stage": ["route"], "body": ["{}"]}))
    assert out.iloc[0][["text", "input_tokens", "output_tokens", "cache_read_tokens"]].tolist() == ["{}", 6, 3, 4]


def test_batch_job(tmp_path):
    state, to = str(tmp_path / "state.json"), str(tmp_path / "out.jsonl")
    transport, seen = scripted((200, b'{"id": "f1"}'), (200, b'{"id": "b1", "status": "validating"}'), (200, b'{"status": "in_progress"}'), (200, b'{"status": "completed", "output_file_id": "f2"}'), (200, b"line\n"))
    jobs = model_api.BatchJobs("http://host/", "k", transport)
    assert jobs.submit(b"{}\n", state) == {"id": "b1", "status": "validating"}
    assert b'name="purpose"' in seen[0][2] and json.loads(seen[1][2])["input_file_id"] == "f1"
    assert jobs.collect(state, to) == "in_progress" and not (tmp_path / "out.jsonl").exists()
    assert jobs.collect(state, to) == "completed" and (tmp_path / "out.jsonl").read_bytes() == b"line\n"

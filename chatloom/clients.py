"""Chat and embedding services over HTTP, in two dialects."""

from __future__ import annotations

import json
import os
import time
import urllib.error
import urllib.request
from dataclasses import dataclass

from chatloom.config import Service

TIMEOUT = 180
TRIES = 3


class ServiceError(RuntimeError):
    """A service refused a request or gave no answer."""


@dataclass
class Client:
    """Made once per partition; ``remote`` must be allowed to leave this machine."""

    service: Service
    allow_remote: bool = False

    def __post_init__(self):
        host = self.service.api_base.split("://")[-1].split("/")[0].rsplit(":", 1)[0]
        if not self.allow_remote and host not in ("localhost", "127.0.0.1", "[::1]"):
            raise ServiceError(f"{host} is not local: private text is only sent there with allow_remote=True")
        self.base = self.service.api_base.rstrip("/")
        self.ollama = self.service.api_style == "ollama"
        self.key = os.environ.get(self.service.api_key_env, "") if self.service.api_key_env else ""

    def post(self, path: str, body: dict) -> dict:
        headers = {"Content-Type": "application/json"} | ({"Authorization": f"Bearer {self.key}"} if self.key else {})
        for left in range(TRIES - 1, -1, -1):
            try:
                request = urllib.request.Request(self.base + path, json.dumps(body).encode(), headers)
                with urllib.request.urlopen(request, timeout=TIMEOUT) as answer:
                    return json.load(answer)
            except urllib.error.HTTPError as e:
                if not left or e.code < 500 and e.code != 429:
                    raise ServiceError(f"{e.code}: {e.read().decode(errors='replace')[:500]}") from e
            except urllib.error.URLError as e:
                if not left:
                    raise ServiceError(str(e.reason)) from e
            time.sleep(2.0 ** (TRIES - 1 - left) / 4)
        raise AssertionError

    def generate(self, instruction: str, content: str) -> str:
        turns = [{"role": "system", "content": instruction}, {"role": "user", "content": content}]
        body = {"model": self.service.model, "messages": turns}
        if self.ollama:
            body |= {"stream": False, "think": False, "options": {"temperature": self.service.temperature}}
            return self.checked(self.post("/api/chat", body))["message"]["content"]
        answer = self.checked(self.post("/chat/completions", body | {"temperature": self.service.temperature}))
        if not answer.get("choices"):
            raise ServiceError("no choices")
        return answer["choices"][0]["message"]["content"]

    def embed(self, text: str) -> list[float]:
        if self.ollama:
            found = self.checked(self.post("/api/embeddings", {"model": self.service.model, "prompt": text})).get("embedding")
        else:
            data = self.checked(self.post("/embeddings", {"model": self.service.model, "input": text})).get("data")
            found = data[0]["embedding"] if data else None
        if not found and (self.ollama or found is None):
            raise ServiceError("no embedding")
        return found

    @staticmethod
    def checked(answer: dict) -> dict:
        if answer.get("error"):
            error = answer["error"]
            raise ServiceError(error.get("message", str(error)) if isinstance(error, dict) else str(error))
        return answer

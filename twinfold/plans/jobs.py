"""Runs as jobs, one at a time, and an HTTP service for them."""

from __future__ import annotations

import json
import threading
import uuid
from collections.abc import Callable
from dataclasses import asdict, dataclass, field, replace
from datetime import datetime, timezone
from enum import Enum
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

from twinfold.plans.config import Config


class Status(str, Enum):
    QUEUED = "queued"
    RUNNING = "running"
    SUCCEEDED = "succeeded"
    FAILED = "failed"


class Busy(Exception):
    """Another run is active."""


@dataclass
class Overrides:
    sparql_endpoint: str | None = None
    sparql_update_endpoint: str | None = None
    dedup_graph: str | None = None
    cluster_k: int | None = None
    cluster_threshold: float | None = None
    cluster_name_similarity_penalty: float | None = None

    def given(self) -> dict:
        return {k: v for k, v in asdict(self).items() if v is not None}


def _now() -> str:
    return datetime.now(timezone.utc).isoformat()


@dataclass
class Job:
    job_id: str
    overrides: Overrides
    status: Status = Status.QUEUED
    created_at: str = field(default_factory=_now)
    started_at: str | None = None
    finished_at: str | None = None
    result: dict | None = None
    error: str | None = None

    def as_dict(self) -> dict:
        return asdict(self) | {"status": self.status.value}


class JobManager:
    """Jobs live in memory; each run writes its own four files under root/jobs/<id>; the embedding cache is shared."""

    def __init__(self, config: Config, run: Callable[[Config], dict], root: str):
        self.config, self.run, self.root = config, run, root
        self.jobs: dict[str, Job] = {}
        self.active = threading.Lock()

    def submit(self, overrides: Overrides) -> Job:
        if not self.active.acquire(blocking=False):
            raise Busy("a run is already in progress")
        try:
            job = Job(str(uuid.uuid4()), overrides)
            self.jobs[job.job_id] = job
            threading.Thread(target=self._execute, args=(job,), daemon=True).start()
        except BaseException:
            self.active.release()
            raise
        return job

    def _execute(self, job: Job) -> None:
        try:
            job.status, job.started_at = Status.RUNNING, _now()
            folder = f"{self.root.rstrip('/')}/jobs/{job.job_id}"
            paths = {f"{name}_path": f"{folder}/{name.removesuffix('_log')}.jsonl" for name in ("audit_log", "sparql_log", "llm_log", "persons_cache")}
            job.result = self.run(replace(self.config, run_id=job.job_id, **job.overrides.given(), **paths))
            job.status = Status.SUCCEEDED
        except Exception as e:  # noqa: BLE001  the job carries it
            job.status, job.error = Status.FAILED, f"{type(e).__name__}: {e}"
        finally:
            job.finished_at = _now()
            self.active.release()

    def get(self, job_id: str) -> Job | None:
        return self.jobs.get(job_id)


def serve(manager: JobManager, port: int = 8000, host: str = "0.0.0.0") -> ThreadingHTTPServer:
    """POST /runs (202 or 409), GET /runs/<id> (200 or 404), GET /health."""

    class Handler(BaseHTTPRequestHandler):
        def _answer(self, code: int, body: dict) -> None:
            data = json.dumps(body).encode()
            self.send_response(code)
            self.send_header("Content-Type", "application/json")
            self.send_header("Content-Length", str(len(data)))
            self.end_headers()
            self.wfile.write(data)

        def do_POST(self) -> None:  # noqa: N802
            if self.path != "/runs":
                return self._answer(404, {"detail": "not found"})
            try:
                body = json.loads(self.rfile.read(int(self.headers.get("Content-Length") or 0)) or b"{}")
                overrides = Overrides(**{k: v for k, v in body.items() if k in Overrides.__dataclass_fields__})
            except (ValueError, AttributeError) as e:
                return self._answer(422, {"detail": str(e)})
            try:
                self._answer(202, manager.submit(overrides).as_dict())
            except Busy as e:
                self._answer(409, {"detail": str(e)})

        def do_GET(self) -> None:  # noqa: N802
            if self.path == "/health":
                self._answer(200, {"status": "ok"})
            elif self.path.startswith("/runs/") and (job := manager.get(self.path.removeprefix("/runs/"))):
                self._answer(200, job.as_dict())
            else:
                self._answer(404, {"detail": "unknown job id"})

        def log_message(self, *_) -> None:
            pass

    return ThreadingHTTPServer((host, port), Handler)

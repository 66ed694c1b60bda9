"""Sync state and repository facts, read and written by the driver."""

from __future__ import annotations

import json
import os
import subprocess
import time
import uuid
from dataclasses import dataclass, field


@dataclass
class SyncState:
    commit_sha: str = ""
    indexed_hashes: set[str] = field(default_factory=set)
    total_vectors: int = 0
    last_synced: str = ""


def load_state(path: str) -> SyncState:
    """Empty if the file is missing; a file that is not JSON is set aside; other errors are raised."""
    try:
        with open(path, encoding="utf-8") as f:
            raw = json.load(f)
    except FileNotFoundError:
        return SyncState()
    except ValueError:
        os.rename(path, f"{path}.corrupt.{int(time.time() * 1000)}.{uuid.uuid4().hex[:8]}")
        return SyncState()
    return SyncState(raw.get("commit_sha", ""), set(raw.get("indexed_hashes", [])), raw.get("total_vectors", 0), raw.get("last_synced", ""))


def save_state(path: str, state: SyncState) -> None:
    """Written beside the file and moved over it."""
    draft = f"{path}.{uuid.uuid4().hex[:8]}.tmp"
    with open(draft, "w", encoding="utf-8") as f:
        json.dump(vars(state) | {"indexed_hashes": sorted(state.indexed_hashes)}, f, indent=2)
    os.replace(draft, path)


def git_facts(folder: str) -> dict[str, str]:
    """commit_sha, remote_url, repo_name, branch; `unknown` where git cannot say."""

    def ask(*args: str) -> str:
        try:
            return subprocess.run(["git", "-C", folder, *args], capture_output=True, text=True, timeout=10, check=True).stdout.strip() or "unknown"
        except (OSError, subprocess.SubprocessError):
            return "unknown"

    remote = ask("remote", "get-url", "origin")
    bare = remote.removesuffix(".git")
    if bare.startswith("git@"):
        name = bare.partition(":")[2] or "unknown"
    elif bare.startswith("http") and bare.count("/") >= 4:
        name = "/".join(bare.split("/")[-2:])
    else:
        name = "unknown"
    return {"commit_sha": ask("rev-parse", "HEAD"), "remote_url": remote, "repo_name": name, "branch": ask("rev-parse", "--abbrev-ref", "HEAD")}

"""Idempotent downloads: signatures, checksums, atomic files; and mapping addresses."""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Callable, Iterable, Mapping
from pathlib import Path


def signature(headers: Mapping[str, str]) -> str | None:
    """ETag of a response, else Last-Modified and length; None if it has neither."""
    low = {k.lower(): v for k, v in headers.items()}
    if low.get("etag"):
        return low["etag"].removeprefix("W/").strip('"')
    if low.get("last-modified"):
        return f"{low['last-modified']}|{low.get('content-length', '')}"
    return None


def is_current(target: Path, now: str | None) -> bool:
    """Whether the file is there and its sidecar holds the signature."""
    side = target.with_name(target.name + ".sig")
    return now is not None and target.exists() and side.exists() and json.loads(side.read_text())["signature"] == now


def store(target: Path, chunks: Iterable[bytes], sign: str | None, md5: str | None = None) -> Path:
    """Writes beside the target and renames at the end; a wrong checksum leaves nothing behind."""
    part, digest = target.with_name(target.name + ".part"), hashlib.md5(usedforsecurity=False)
    target.parent.mkdir(parents=True, exist_ok=True)
    try:
        with part.open("wb") as f:
            for c in chunks:
                digest.update(c)
                f.write(c)
        if md5 and digest.hexdigest() != md5.lower():
            raise ValueError(f"{target.name}: checksum {digest.hexdigest()}, expected {md5}")
        os.replace(part, target)
    finally:
        part.unlink(missing_ok=True)
    target.with_name(target.name + ".sig").write_text(json.dumps({"signature": sign}))
    return target


def fetch(target: Path, head: Callable[[], Mapping[str, str]], get: Callable[[], Iterable[bytes]], md5: str | None = None) -> bool:
    """Downloads unless the signature is the known one; whether anything was fetched.  The transport is passed in."""
    now = signature(head())
    if is_current(target, now):
        return False
    store(target, get(), now, md5)
    return True


def checksum_of(listing: str, name: str) -> str | None:
    """The checksum of a file in a ``sum  name`` listing."""
    for line in listing.splitlines():
        parts = line.split()
        if len(parts) >= 2 and parts[-1].lstrip("*").rsplit("/", 1)[-1] == name:
            return parts[0].lower()
    return None


def mapping_address(base: str, a: int, b: int) -> str:
    """Address of the mapping between two sources; the smaller id comes first, so either order gives one file."""
    if a == b:
        raise ValueError("a source isn't mapped to itself")
    lo, hi = sorted((a, b))
    return f"{base.rstrip('/')}/src_id{lo}/src{lo}src{hi}.txt.gz"


def backup(path: Path) -> Path | None:
    """Copies a file before it is overwritten; an existing backup stays."""
    if not path.exists():
        return None
    n, to = 0, path.with_name(path.name + ".bak")
    while to.exists():
        n, to = n + 1, path.with_name(f"{path.name}.bak{n + 1}")
    to.write_bytes(path.read_bytes())
    return to

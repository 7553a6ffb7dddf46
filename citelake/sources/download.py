"""Keeping a local copy of release files: what to do with each is a pure function, transports are a web folder or a mirror on disk."""

from __future__ import annotations

import hashlib
import logging
import re
import shutil
import urllib.request
from collections.abc import Callable, Iterable
from dataclasses import dataclass
from pathlib import Path

from ..functions.ids import checksum_of

log = logging.getLogger(__name__)


# Where the release stands, by kind, and the journal overview.
SOURCES = {"baseline": "https://ftp.ncbi.nlm.nih.gov/pubmed/baseline", "update": "https://ftp.ncbi.nlm.nih.gov/pubmed/updatefiles"}
OVERVIEW = "https://ftp.ncbi.nlm.nih.gov/pubmed/J_Entrez.txt"
FOLDERS = {"baseline": "baseline", "update": "updatefiles"}


class Web:
    """Release files in a folder that a web server lists."""

    def __init__(self, url: str, open_url=urllib.request.urlopen) -> None:
        self.url, self._open = url.rstrip("/"), open_url

    def listing(self) -> list[str]:
        """Names of release files, newest first."""
        with self._open(f"{self.url}/", timeout=60) as r:
            page = r.read().decode("utf-8", "replace")
        return sorted({n for n in re.findall(r'href="([^"/]+)"', page) if n.endswith(".xml.gz")}, reverse=True)

    def sidecar(self, name: str) -> str:
        with self._open(f"{self.url}/{name}.md5", timeout=60) as r:
            return r.read().decode("utf-8", "replace")

    def fetch(self, name: str, to: Path) -> None:
        """Written beside the target and renamed, so a download that breaks off leaves nothing to load."""
        part = to.with_name(to.name + ".part")
        with self._open(f"{self.url}/{name}", timeout=600) as r, part.open("wb") as f:
            shutil.copyfileobj(r, f, 1 << 20)
        part.replace(to)


class Mirror:
    """Release files in a folder on disk."""

    def __init__(self, folder: Path) -> None:
        self.folder = folder

    def listing(self) -> list[str]:
        return sorted((p.name for p in self.folder.glob("*.xml.gz")), reverse=True)

    def sidecar(self, name: str) -> str:
        return (self.folder / f"{name}.md5").read_text()

    def fetch(self, name: str, to: Path) -> None:
        shutil.copyfile(self.folder / name, to)


@dataclass(frozen=True)
class Decision:
    published: str | None  # checksum to register
    changed: bool  # new, or its checksum moved: to be loaded again
    refetch: bool  # the local copy is of an older publication
    verify: bool  # hash the local file after fetching


def decide(known: bool, prior: str | None, sidecar: str | None, local_exists: bool) -> Decision:
    """What a listed file needs.

    ``sidecar`` is the published checksum or None if it can't be had; then the last known one stands and nothing is called changed.  A known
    file with an unknown checksum isn't new.  Only a moved checksum discards the local copy; only fetched or moved files are hashed.
    """
    published = prior if sidecar is None else sidecar
    changed = not known or prior != published
    refetch = local_exists and prior is not None and published is not None and prior != published
    return Decision(published, changed, refetch, published is not None and (changed or refetch or not local_exists))


def file_md5(path: Path) -> str:
    with path.open("rb") as f:
        return hashlib.file_digest(f, "md5").hexdigest()


@dataclass(frozen=True)
class Synced:
    file_name: str
    kind: str
    published_md5: str | None
    changed: bool


def sync_kind(
    listing: Iterable[str], kind: str, folder: Path, registry: dict[str, str | None], sidecar: Callable[[str], str], fetch: Callable[[str, Path], None],
    limit: int | None = None, verify: bool = True,
) -> list[Synced]:
    """Fetch what is missing or moved of a newest-first listing, at most ``limit`` files.

    ``sidecar(name)`` gives the checksum file's text and ``fetch(name, path)`` the file; either may raise.  A file that is corrupt twice is deleted
    and not registered.
    """
    folder.mkdir(parents=True, exist_ok=True)
    out = []
    for name in list(listing)[:limit]:
        try:
            published = checksum_of(sidecar(name))
        except Exception as e:  # noqa: BLE001 - the last known checksum stands
            log.warning("no checksum of %s: %s", name, e)
            published = None
        path = folder / name
        d = decide(name in registry, registry.get(name), published, path.exists())
        changed = d.changed
        if d.refetch:
            path.unlink()
        if not path.exists():
            fetch(name, path)
        if verify and d.verify and file_md5(path) != d.published:
            log.warning("%s is corrupt; fetching it again", name)
            path.unlink()
            fetch(name, path)
            changed = True
            if file_md5(path) != d.published:
                log.error("%s is corrupt again; discarded", name)
                path.unlink()
                continue
        out.append(Synced(name, kind, d.published, changed))
    return out

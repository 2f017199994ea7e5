"""Fetching archives: a chain of places, resumable downloads, directory listings. Plain Python, outside Spark."""

from __future__ import annotations

import os
import shutil
import time
import urllib.request
import xml.etree.ElementTree as ET
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

#: Takes a url and a first byte; gives (status, length of the rest or None, readable).
Opener = Callable[[str, int], tuple[int, int | None, object]]


def open_url(url: str, start: int):
    request = urllib.request.Request(url, headers={"Range": f"bytes={start}-"} if start else {})
    reply = urllib.request.urlopen(request, timeout=60)
    length = reply.headers.get("Content-Length")
    return reply.status, int(length) if length else None, reply


def download(url: str, target: str, *, opener: Opener = open_url, attempts: int = 6, wait: Callable[[float], None] = time.sleep) -> str:
    """``target``, downloaded. A partial file is resumed; a server that ignores the range starts over; waits double up to 60 s."""
    part = target + ".part"
    for attempt in range(attempts):
        start = os.path.getsize(part) if os.path.exists(part) else 0
        try:
            status, length, body = opener(url, start)
            if status not in (200, 206):
                raise OSError(f"{url}: status {status}")
            if start and status == 200:
                start = 0
            with open(part, "ab" if start else "wb") as f:
                shutil.copyfileobj(body, f)
            if length is not None and os.path.getsize(part) != start + length:
                raise OSError(f"{url}: {os.path.getsize(part)} bytes of {start + length}")
            os.replace(part, target)
            return target
        except OSError:
            if attempt + 1 == attempts:
                raise
            wait(min(60.0, 2.0**attempt))
    raise AssertionError


@dataclass
class Place:
    """One step of the chain: ``find`` gives a local path, or None if the place lacks the file."""

    name: str
    find: Callable[[str], str | None]


def local_place(folder: str) -> Place:
    def find(name: str) -> str | None:
        path = os.path.join(folder, name)
        return path if os.path.isfile(path) and os.path.getsize(path) else None

    return Place("local", find)


def remote_place(name: str, base_url: str, folder: str, **how) -> Place:
    def find(file: str) -> str | None:
        try:
            return download(f"{base_url.rstrip('/')}/{file}", os.path.join(folder, file), **how)
        except OSError:
            return None

    return Place(name, find)


class Chain:
    """The first place that has a file provides it."""

    def __init__(self, places: Iterable[Place]):
        self.places = list(places)

    def get(self, file: str) -> tuple[str, str]:
        for place in self.places:
            if path := place.find(file):
                return path, place.name
        raise FileNotFoundError(f"{file}: in none of {[p.name for p in self.places]}")

    def get_all(self, files: Iterable[str], *, workers: int = 4) -> dict[str, tuple[str, str]]:
        files = list(files)
        with ThreadPoolExecutor(workers) as pool:
            return dict(zip(files, pool.map(self.get, files)))


def parse_listing(xml: str) -> list[tuple[str, int | None, bool]]:
    """(name, size, is folder) of the entries of a WebDAV PROPFIND reply, the folder itself left out."""
    space = "{DAV:}"
    out = []
    for reply in ET.fromstring(xml).iter(f"{space}response"):
        href = (reply.findtext(f"{space}href") or "").strip()
        folder = next(reply.iter(f"{space}collection"), None) is not None
        size = next(reply.iter(f"{space}getcontentlength"), None)
        out.append((href.rstrip("/").rpartition("/")[2], int(size.text) if size is not None and size.text else None, folder))
    return out[1:]


def listed_months(xml: str) -> list[str]:
    from .landing import is_valid_month

    return sorted(name for name, _, folder in parse_listing(xml) if folder and is_valid_month(name))

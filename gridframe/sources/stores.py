"""Access to a store's files: local folders, HTTP, S3, and what pyarrow's file systems reach."""

from __future__ import annotations

import contextlib
import http.client
import os
import threading
import time
import urllib.error
import urllib.parse
import urllib.request
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

from gridframe.plans.metadata import StoreError


@dataclass
class Blob:
    """An open file: its size, and ranges of its bytes."""

    size: int
    read: Callable[[int, int], bytes]

    def whole(self) -> bytes:
        return self.read(0, self.size)

    def edge(self, length: int, at_start: bool) -> bytes:
        """The first or last bytes of the file, fewer where it is shorter."""
        length = min(length, self.size)
        return self.read(0 if at_start else self.size - length, length)


class _Opening:
    """Ways of reading that every store has; one whose requests are dear does better.

    shares: names are so cheap to list that several tasks may list a folder, each for a share of its files.
    """

    shares = False

    def get(self, path: str) -> bytes | None:
        """A whole file; None for an absent one."""
        blob = self.open(path)
        return None if blob is None else blob.whole()

    def edge(self, path: str, length: int, at_start: bool) -> tuple[bytes, Blob] | None:
        """The file's first or last bytes, and the file."""
        blob = self.open(path)
        return None if blob is None else (blob.edge(length, at_start), blob)


class LocalStore(_Opening):
    """A folder of this machine, or one that all machines mount."""

    lists = pages = shares = True

    def __init__(self, root: str) -> None:
        self.root = root

    def _at(self, path: str) -> str:
        return os.path.join(self.root, path) if path else self.root

    def open(self, path: str) -> Blob | None:
        try:
            handle = os.open(self._at(path), os.O_RDONLY)
            raw = os.fdopen(handle, "rb")
        except (FileNotFoundError, IsADirectoryError, NotADirectoryError):
            return None

        def read(offset: int, length: int) -> bytes:
            return os.pread(raw.fileno(), length, offset)

        return Blob(os.fstat(handle).st_size, read)

    def size(self, path: str) -> int | None:
        at = self._at(path)
        return os.stat(at).st_size if os.path.isfile(at) else None

    def folders(self, path: str) -> list[str]:
        try:
            with os.scandir(self._at(path)) as entries:
                return sorted(e.name for e in entries if e.is_dir() and not e.name.startswith("."))
        except (FileNotFoundError, NotADirectoryError):
            return []

    def names(self, path: str) -> Iterator[str]:
        """All files below a folder."""
        todo, top = [self._at(path)], os.path.join(self.root, "")
        while todo:
            with contextlib.suppress(FileNotFoundError, NotADirectoryError), os.scandir(todo.pop()) as entries:
                for e in entries:
                    if not e.is_dir():
                        yield e.path[len(top) :]
                    elif not e.is_symlink():
                        todo.append(e.path)

    def files(self, path: str, chosen: Callable[[str], bool] = lambda path: True) -> Iterator[tuple[str, int]]:
        """All files below a folder whose path is chosen, with their sizes; others are listed, but not looked at."""
        for name in self.names(path):
            if chosen(name):
                with contextlib.suppress(FileNotFoundError):
                    yield name, os.stat(self._at(name)).st_size

    def write(self, path: str, data: bytes) -> None:
        """Replaces a file at once: readers and repeated tasks never see a part of it."""
        at = self._at(path)
        part = f"{at}.{uuid.uuid4().hex}.part"
        try:
            f = open(part, "wb")
        except FileNotFoundError:
            os.makedirs(os.path.dirname(at), exist_ok=True)
            f = open(part, "wb")
        with f:
            f.write(data)
        os.replace(part, at)


#: Statuses of a server that may do better soon, and how often and how long (seconds, doubled each time) it is given.
_BUSY = (408, 425, 429, 500, 502, 503, 504)
TRIES, PAUSE = 5, 0.5


_MOVED, _HOPS = (301, 302, 303, 307, 308), 5


class HttpStore(_Opening):
    """Files below a URL. Folders can't be listed.

    A task keeps its connection to the server. A whole file, or the part of a file that says
    where the rest lies, is one request: nobody asks first whether there is one. Only 404 and 410
    mean that a file is absent. A server that forbids a file raises: taking it for absent would
    turn chunks into fill values. Busy servers and broken connections are tried again, as often
    as `TRIES` says. Where the machine names a proxy, each request has a connection of its own.
    """

    lists = pages = False

    def __init__(self, root: str) -> None:
        self.root = root
        self._kept = threading.local()

    def __getstate__(self) -> dict:
        return {"root": self.root}

    def __setstate__(self, state: dict) -> None:
        self.__init__(state["root"])

    def _once(self, url: str, method: str, headers: dict) -> tuple[int, bytes, dict]:
        """One answer: status, body and headers by lower-case name."""
        parts = urllib.parse.urlsplit(url)
        if parts.scheme in urllib.request.getproxies():
            try:
                with urllib.request.urlopen(urllib.request.Request(url, method=method, headers=headers), timeout=60) as answer:
                    return answer.status, answer.read(), {k.lower(): v for k, v in answer.headers.items()}
            except urllib.error.HTTPError as e:
                return e.code, b"", {}
        place = (parts.scheme, parts.netloc)
        if getattr(self._kept, "place", None) != place:
            kind = http.client.HTTPSConnection if parts.scheme == "https" else http.client.HTTPConnection
            self._kept.place, self._kept.connection = place, kind(parts.netloc, timeout=60)
        connection = self._kept.connection
        try:
            connection.request(method, parts.path + (f"?{parts.query}" if parts.query else ""), headers=headers)
            answer = connection.getresponse()
            return answer.status, answer.read(), {k.lower(): v for k, v in answer.getheaders()}
        except (http.client.HTTPException, OSError):
            connection.close()
            raise

    def _ask(self, path: str, method: str = "GET", headers: dict | None = None) -> tuple[int, bytes, dict] | None:
        """The status, the body and the headers; None for an absent file."""
        url, tries, hops = urllib.parse.quote(f"{self.root}/{path}", safe="%/:=&?~#+!$,;'@()*[]"), 0, 0
        while True:
            try:
                status, body, answered = self._once(url, method, headers or {})
            except (urllib.error.URLError, http.client.HTTPException, OSError) as e:
                tries += 1
                if tries == TRIES:
                    raise StoreError(f"Failed to read {self.root}/{path}: {e}") from None
                time.sleep(PAUSE * 2 ** (tries - 1))
                continue
            if status in (200, 206, 416):
                return status, body, answered
            if status in _MOVED and hops < _HOPS and answered.get("location"):
                url, hops = urllib.parse.urljoin(url, answered["location"]), hops + 1
                continue
            if status in (404, 410):
                return None
            if status in (401, 403):
                raise StoreError(f"No access to {self.root}/{path}: HTTP status {status}")
            tries += 1
            if status not in _BUSY or tries == TRIES:
                raise StoreError(f"Failed to read {self.root}/{path}: HTTP status {status}")
            time.sleep(PAUSE * 2 ** (tries - 1))

    def size(self, path: str) -> int | None:
        answer = self._ask(path, "HEAD")
        return None if answer is None else int(answer[2].get("content-length") or 0)

    def get(self, path: str) -> bytes | None:
        answer = self._ask(path)
        return None if answer is None else answer[1]

    def _blob(self, path: str, n: int) -> Blob:
        def read(offset: int, length: int) -> bytes:
            if not length:
                return b""
            headers = {} if (offset, length) == (0, n) else {"Range": f"bytes={offset}-{offset + length - 1}"}
            answer = self._ask(path, headers=headers)
            if answer is None:
                raise StoreError(f"{self.root}/{path} has gone while it was read")
            # A server that knows no ranges sends the whole file.
            return answer[1] if answer[0] == 206 else answer[1][offset : offset + length]

        return Blob(n, read)

    def open(self, path: str) -> Blob | None:
        n = self.size(path)
        return None if n is None else self._blob(path, n)

    def edge(self, path: str, length: int, at_start: bool) -> tuple[bytes, Blob] | None:
        answer = self._ask(path, headers={"Range": f"bytes=0-{length - 1}" if at_start else f"bytes=-{length}"})
        if answer is None:
            return None
        status, body, headers = answer
        if status == 206:
            total = headers.get("content-range", "").rpartition("/")[2]
            return body, self._blob(path, int(total)) if total.isdigit() else self.open(path)
        if status == 416:
            return b"", Blob(0, lambda offset, n: b"")
        whole = Blob(len(body), lambda offset, n: body[offset : offset + n])
        return whole.edge(length, at_start), whole

    def folders(self, path: str) -> list[str]:
        raise StoreError("folders can't be listed over HTTP")


class ArrowStore(_Opening):
    """A folder of a file system that pyarrow reaches.

    lists: whether groups and arrays are found by walking its folders. Chunk files are listed in any
    case: an object store gives them by prefix and page by page, in proportion to the files.
    """

    pages = True

    def __init__(self, uri: str, lists: bool) -> None:
        self.uri, self.lists = uri, lists
        self._connected = None

    def _fs(self):
        if self._connected is None:
            from pyarrow import fs

            try:
                self._connected = fs.FileSystem.from_uri(self.uri)
            except Exception as e:
                raise StoreError(f"pyarrow can't open the file system of {self.uri}: {e}") from None
        return self._connected

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_connected": None}

    def _info(self, path: str):
        files, root = self._fs()
        return files.get_file_info(f"{root}/{path}" if path else root)

    def size(self, path: str) -> int | None:
        info = self._info(path)
        return info.size if info.is_file else None

    def open(self, path: str) -> Blob | None:
        files, root = self._fs()
        try:
            raw = files.open_input_file(f"{root}/{path}" if path else root)
            size = raw.size()
        except (FileNotFoundError, IsADirectoryError, NotADirectoryError):
            return None
        except OSError:
            # Some file systems say of a folder only that it can't be opened.
            if self._info(path).is_file:
                raise
            return None
        return Blob(size, lambda offset, length: raw.read_at(length, offset))

    def write(self, path: str, data: bytes) -> None:
        files, root = self._fs()
        at = f"{root}/{path}"
        files.create_dir(os.path.dirname(at), recursive=True)
        part = f"{at}.{uuid.uuid4().hex}.part"
        with files.open_output_stream(part) as f:
            f.write(data)
        files.move(part, at)

    def folders(self, path: str) -> list[str]:
        from pyarrow import fs

        files, root = self._fs()
        selector = fs.FileSelector(f"{root}/{path}" if path else root, allow_not_found=True)
        return sorted(i.base_name for i in files.get_file_info(selector) if i.type == fs.FileType.Directory and not i.base_name.startswith("."))

    def files(self, path: str) -> Iterator[tuple[str, int]]:
        from pyarrow import fs

        files, root = self._fs()
        for i in files.get_file_info(fs.FileSelector(f"{root}/{path}" if path else root, allow_not_found=True, recursive=True)):
            if i.type == fs.FileType.File:
                yield os.path.relpath(i.path, root), i.size


Store = LocalStore | HttpStore | ArrowStore


def normalised(path: str) -> str:
    """A store path without a trailing slash; local ones with the home folder filled in."""
    path = path.removeprefix("file://") if path.startswith("file:///") else path.removeprefix("file:") if path.startswith("file:/") else path
    path = path if "://" in path else os.path.expanduser(path)
    return path.rstrip("/") or "/"


def open_store(path: str) -> Store:
    path = normalised(path)
    scheme = path.partition("://")[0] if "://" in path else ""
    if scheme in ("http", "https"):
        return HttpStore(path)
    if scheme in ("s3", "s3a", "s3n"):
        return ArrowStore("s3://" + path.partition("://")[2], lists=False)
    if scheme:
        return ArrowStore(path, lists=True)
    return LocalStore(path)

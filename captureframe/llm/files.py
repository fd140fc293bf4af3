"""Files in the shared folder, written and range-read by executors through the store's own file system."""

from __future__ import annotations

import pickle
import posixpath

import zstandard
from pyarrow import fs


def _at(uri: str) -> tuple[fs.FileSystem, str]:
    if uri.startswith("file:/"):
        return fs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    return fs.FileSystem.from_uri(uri)


def put(uri: str, parts: list[bytes], attempt: int) -> int:
    """Write ``parts`` to ``uri``; a retried or doubled task replaces whole files only. Returns the size."""
    store, path = _at(uri)
    store.create_dir(posixpath.dirname(path), recursive=True)
    early = f"{path}.{attempt}.part"
    with store.open_output_stream(early) as out:
        for x in parts:
            out.write(x)
    store.move(early, path)
    return sum(map(len, parts))


def opened(uri: str):
    """A seekable file of ``uri``."""
    store, path = _at(uri)
    return store.open_input_file(path)


def whole(uri: str) -> bytes:
    with opened(uri) as f:
        return f.read()


def put_object(uri: str, value, attempt: int = 0) -> None:
    put(uri, [zstandard.ZstdCompressor(level=1).compress(pickle.dumps(value, protocol=5))], attempt)


def get_object(uri: str):
    return pickle.loads(zstandard.ZstdDecompressor().decompress(whole(uri)))  # noqa: S301 (a file that the operators wrote)


class Sent:
    """A value for all tasks, kept once in the shared folder; a worker process reads it once and holds the last few."""

    HELD = 3
    _cache: dict = {}

    def __init__(self, uri: str, value):
        self.uri = uri
        put_object(uri, value)

    @property
    def value(self):
        cache = Sent._cache
        if self.uri not in cache:
            while len(cache) >= Sent.HELD:
                cache.pop(next(iter(cache)))
            cache[self.uri] = get_object(self.uri)
        return cache[self.uri]

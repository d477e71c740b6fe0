"""What remote reads cost: requests and connections are counted at local servers."""

import http.server
import threading
import urllib.parse

import numpy as np
import pytest

from gridframe.plans.metadata import StoreError
from gridframe.sources import codecs, datasource, discovery, scan
from gridframe.sources import stores as stores_of
from gridframe.sources import writer as w
from gridframe.sources.windows import WindowReader


class Counted(http.server.BaseHTTPRequestHandler):
    """Files below a folder, with ranges, over connections that stay open."""

    protocol_version = "HTTP/1.1"
    folder, asked, connections, ranges = None, [], set(), True

    def do_GET(self):
        type(self).connections.add(self.client_address)
        type(self).asked.append((self.command, self.path, self.headers.get("Range")))
        path = urllib.parse.unquote(self.path)
        if path.startswith("/moved/"):
            self.send_response(302)
            self.send_header("Location", path.replace("/moved/", "/"))
            self.send_header("Content-Length", "0")
            self.end_headers()
            return
        at = self.folder / path.lstrip("/")
        data, status, extra = (at.read_bytes(), 200, None) if at.is_file() else (b"", 404, None)
        if status == 200 and "Range" in self.headers and self.ranges:
            first, _, last = self.headers["Range"].removeprefix("bytes=").partition("-")
            a, b = (max(0, len(data) - int(last)), len(data)) if not first else (int(first), min(len(data), int(last) + 1))
            status, extra, data = (206, f"bytes {a}-{b - 1}/{len(data)}", data[a:b]) if a < len(data) else (416, None, b"")
        self.send_response(status)
        if extra:
            self.send_header("Content-Range", extra)
        self.send_header("Content-Length", str(len(data)))
        self.end_headers()
        if self.command == "GET":
            self.wfile.write(data)

    do_HEAD = do_GET

    def log_message(self, *_):
        pass


@pytest.fixture
def counted(tmp_path):
    Counted.folder, Counted.asked, Counted.connections, Counted.ranges = tmp_path, [], set(), True
    server = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Counted)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    yield Counted, f"http://127.0.0.1:{server.server_port}"
    server.shutdown()


@pytest.fixture
def sharded(counted):
    """One array of four shards, each of 64 inner chunks, stored without groups."""
    server, url = counted
    path = str(server.folder / "s.zarr")
    values = np.random.default_rng(3).integers(0, 10**6, (64, 64)).astype("<i8")
    w.v3_array(path, "", (64, 64), (32, 32), "int64", [w.sharding((4, 4), [w.BYTES])], fill=0)
    w.write_values(path, "", values)
    return f"{url}/s.zarr", values


def table(found):
    return sorted(r for b in found.read(0, len(found.parts)) for r in zip(*(c.to_pylist() for c in b.columns), strict=True))


def test_requests_of_a_shard(counted, sharded):
    server, _ = counted
    url, values = sharded
    found = scan.cell_scan(discovery.discover(url, "v3"), "")
    server.asked.clear(), server.connections.clear()
    assert table(found) == [(x, y, values[x, y]) for x in range(64) for y in range(64)]
    # The index, and all inner chunks at once, of each shard; nobody asks whether there is a file.
    assert len(server.asked) == 8 and {m for m, _, _ in server.asked} == {"GET"} and len(server.connections) == 1
    server.asked.clear()
    few = scan.cell_scan(discovery.discover(url, "v3"), "", None, '{"0": [[0, 3]], "1": [[0, 11]]}')
    server.asked.clear()
    assert table(few) == [(x, y, values[x, y]) for x in range(4) for y in range(12)]
    assert len(server.asked) == 2 and server.asked[1][2].startswith("bytes=")
    a, b = map(int, server.asked[1][2].removeprefix("bytes=").split("-"))
    assert b - a + 1 == 3 * 16 * 8


def test_distant_inner_chunks_are_read_apart(counted, sharded, monkeypatch):
    server, _ = counted
    url, values = sharded
    monkeypatch.setattr(codecs, "GAP", 100)
    found = scan.cell_scan(discovery.discover(url, "v3"), "", None, '{"0": [[0, 3], [28, 31]], "1": [[0, 7]]}')
    server.asked.clear()
    assert len(table(found)) == 64 and len(server.asked) == 1 + 2
    monkeypatch.setattr(codecs, "GAP", 1 << 20)
    monkeypatch.setattr(codecs, "SPAN", 130)
    server.asked.clear()
    assert len(table(found)) == 64 and len(server.asked) == 1 + 4


def test_windows_read_neighbours_at_once(counted, sharded):
    server, _ = counted
    url, values = sharded
    reader = WindowReader(url, discovery.discover(url, "v3").array(""))
    server.asked.clear()
    got, there = reader.read((2, 2), (20, 20))
    assert there is None and (got == values[2:22, 2:22]).all() and len(server.asked) == 2


def test_whole_files_are_one_request(counted):
    server, url = counted
    path = str(server.folder / "a b.zarr")
    w.v3_array(path, "", (10,), (2,), "int32", [w.BYTES], fill=7)
    w.write_values(path, "", np.arange(10), skip={(1,), (4,)})
    found = scan.cell_scan(discovery.discover(f"{url}/a b.zarr", "v3"), "")
    server.asked.clear()
    assert [v for _, v in table(found)] == [0, 1, 7, 7, 4, 5, 6, 7, 7, 7] and len(server.asked) == 5


def test_servers_without_ranges_and_with_detours(counted, sharded):
    server, base = counted
    url, values = sharded
    server.ranges = False
    assert len(table(scan.cell_scan(discovery.discover(url, "v3"), ""))) == 64 * 64
    server.ranges = True
    moved = f"{base}/moved/s.zarr"
    assert len(table(scan.cell_scan(discovery.discover(moved, "v3"), ""))) == 64 * 64
    (server.folder / "empty").write_bytes(b"")
    store = stores_of.HttpStore(base)
    assert store.edge("empty", 8, False)[0] == b"" and store.edge("none", 8, True) is None and store.get("none") is None
    (server.folder / "s.zarr/c/0/0").write_bytes(b"short")
    with pytest.raises(StoreError, match="is shorter"):
        table(scan.cell_scan(discovery.discover(url, "v3"), ""))


class Bucket(http.server.BaseHTTPRequestHandler):
    """An object store that lists two keys a page."""

    keys, pages = {}, []

    def do_GET(self):
        parts = urllib.parse.urlsplit(self.path)
        asked = dict(urllib.parse.parse_qsl(parts.query, keep_blank_values=True))
        if "list-type" in asked:
            prefix, delimiter, after = asked.get("prefix", ""), asked.get("delimiter", ""), asked.get("continuation-token", "")
            type(self).pages.append(prefix)
            entries = sorted({k if not delimiter or delimiter not in k[len(prefix) :] else prefix + k[len(prefix) :].partition(delimiter)[0] + delimiter for k in self.keys if k.startswith(prefix)})
            entries = [e for e in entries if e > after]
            page, more = entries[:2], len(entries) > 2
            body = "".join(f"<Contents><Key>{k}</Key><Size>{self.keys[k]}</Size><LastModified>2024-01-01T00:00:00.000Z</LastModified></Contents>" if k in self.keys else f"<CommonPrefixes><Prefix>{k}</Prefix></CommonPrefixes>" for k in page)
            data = f'<?xml version="1.0"?><ListBucketResult><Name>bucket</Name><Prefix>{prefix}</Prefix><KeyCount>{len(page)}</KeyCount><IsTruncated>{str(more).lower()}</IsTruncated>{f"<NextContinuationToken>{page[-1]}</NextContinuationToken>" if more else ""}{body}</ListBucketResult>'.encode()
            self.send_response(200)
            self.send_header("Content-Type", "application/xml")
        else:
            data = b""
            size = self.keys.get(parts.path.removeprefix("/bucket/"))
            self.send_response(404 if size is None else 200)
        self.send_header("Content-Length", str(len(data)))
        self.end_headers()
        if self.command == "GET":
            self.wfile.write(data)

    do_HEAD = do_GET

    def log_message(self, *_):
        pass


def test_object_stores_list_by_prefix(monkeypatch):
    """A vast grid on an object store: pages in proportion to its files, by folders that several tasks share."""
    from pyarrow import fs

    monkeypatch.setenv("AWS_ACCESS_KEY_ID", "x")
    monkeypatch.setenv("AWS_SECRET_ACCESS_KEY", "y")
    monkeypatch.setenv("AWS_EC2_METADATA_DISABLED", "true")
    server = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Bucket)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    coords = [(k, k % 1000 + j) for k in (0, 5, 10**7) for j in range(3)]
    Bucket.keys, Bucket.pages = {"s.zarr/a/.zarray": 9} | {f"s.zarr/a/{x}/{y}": 400 for x, y in coords}, []
    store = stores_of.ArrowStore("s3://bucket/s.zarr", lists=False)
    store._connected = fs.FileSystem.from_uri(f"s3://bucket/s.zarr?endpoint_override=127.0.0.1:{server.server_port}&scheme=http&region=us-east-1")
    doc = {"zarr_format": 2, "shape": [10**9, 10**8], "chunks": [10, 10], "dtype": "<i4", "order": "C", "compressor": None, "fill_value": 0, "dimension_separator": "/"}
    listing = discovery.Listing("s3://bucket/s.zarr", (), (discovery.metadata.v2_array(doc, "a", "x"),))
    for module in (datasource, scan):
        monkeypatch.setattr(module, "open_store", lambda path: store)
    reader = datasource.MetadataReader("chunks", listing, 4)
    partitions = reader.partitions()
    assert len(partitions) == 3 and not any(isinstance(p, datasource.Run) for p in partitions)
    found = sorted(tuple(r[3]) for p in partitions for r in reader.read(p))
    assert found == coords and len(Bucket.pages) < 20
    assert not store.lists
    server.shutdown()

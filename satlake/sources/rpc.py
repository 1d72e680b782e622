"""Blocks of a node over JSON-RPC, as a Python data source for batch and streams.

    spark.dataSource.register(RpcBlocks)
    spark.read.format("rpc_blocks").options(url=..., user=..., password=..., start=0, end=99).load()
    spark.readStream.format("rpc_blocks").options(url=..., start=0, batch=100, confirmations=10).load()

Rows: height int, block string (verbosity 2). Heights are dealt over partitions, so executors fetch in parallel. A stream's batches end at the tip less
`confirmations` at most and have `batch` heights at most; a batch without heights is an empty one. The tip is asked for at most every `tip_seconds` (5); if the
node then doesn't answer, the stream goes on up to the tip it knows and asks again after `wait_seconds` (15). Offsets are in Spark's checkpoint, so a
failed batch is read again and a restart goes on where it ended. The user and password may stand in the URL. Instead of a node, `url` may be `file:` and a folder with `<height>.json` files and
`tip` (a number), for tests and archives.
"""

from __future__ import annotations

import base64
import json
import os
import time
import urllib.error
import urllib.request
from collections.abc import Iterator
from urllib.parse import unquote, urlsplit, urlunsplit

from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

ATTEMPTS = 5
TIMEOUT = 300


class RpcError(RuntimeError):
    """The node answered with an error."""


class Client:
    def __init__(self, url: str, user: str = "", password: str = "", attempts: int = ATTEMPTS, wait: float = 1.0):
        parts = urlsplit(url)
        if parts.username is not None:
            user, password = user or unquote(parts.username), password or unquote(parts.password or "")
            url = urlunsplit(parts._replace(netloc=parts.netloc.rpartition("@")[2]))
        self.url, self.attempts, self.wait = url, attempts, wait
        self.auth = "Basic " + base64.b64encode(f"{user}:{password}".encode()).decode() if user or password else None

    def call(self, method: str, *params):
        """The result. Network errors and answers that aren't 200 are tried again, a little later each time."""
        body = json.dumps({"jsonrpc": "1.0", "id": "satlake", "method": method, "params": params}).encode()
        for n in range(1, self.attempts + 1):
            request = urllib.request.Request(self.url, body, {"Content-Type": "application/json"} | ({"Authorization": self.auth} if self.auth else {}))
            try:
                with urllib.request.urlopen(request, timeout=TIMEOUT) as r:
                    answer = r.read().decode()
                break
            except (urllib.error.URLError, TimeoutError, ConnectionError):
                if n == self.attempts:
                    raise
                time.sleep(self.wait * n)
        decoded = json.loads(answer)
        if decoded.get("error"):
            raise RpcError(f"{method}: {decoded['error']}")
        return answer if method == "getblock" else decoded["result"]

    def block_count(self) -> int:
        return int(self.call("getblockcount"))

    def block_hash(self, height: int) -> str:
        return self.call("getblockhash", height)

    def block(self, height: int) -> str:
        """The block's JSON text, numbers as the node wrote them."""
        return inner_result(self.call("getblock", self.block_hash(height), 2))

    def chain(self) -> dict:
        return self.call("getblockchaininfo")

    def tip(self) -> int:
        """The highest block that the node has validated."""
        return int(self.chain()["blocks"])


def inner_result(answer: str) -> str:
    """The text of `result` in a JSON-RPC answer, untouched: amounts aren't passed through floating point."""
    at = answer.index('"result"') + len('"result"')
    at = answer.index(":", at) + 1
    _, end = json.JSONDecoder().raw_decode(answer, at + len(answer[at:]) - len(answer[at:].lstrip()))
    return answer[at:end].strip()


class FileClient:
    """The same from a folder."""

    def __init__(self, folder: str):
        self.folder = folder

    def block(self, height: int) -> str:
        with open(os.path.join(self.folder, f"{height}.json")) as f:
            return f.read()

    def tip(self) -> int:
        with open(os.path.join(self.folder, "tip")) as f:
            return int(f.read())

    block_count = tip


def client(options) -> Client | FileClient:
    url = options["url"]
    return FileClient(url.removeprefix("file:")) if url.startswith("file:") else Client(url, options.get("user", ""), options.get("password", ""))


def safe_tip(tip: int, confirmations: int) -> int:
    return max(tip - confirmations, 0)


class Heights(InputPartition):
    def __init__(self, first: int, last: int):
        self.first, self.last = first, last


def deal(first: int, last: int, parts: int) -> list[Heights]:
    """first to last, both inclusive, in up to `parts` runs of about equal length."""
    n = last - first + 1
    if n <= 0:
        return []
    step = -(-n // parts)
    return [Heights(a, min(a + step - 1, last)) for a in range(first, last + 1, step)]


class _Fetch:
    def __init__(self, options):
        self.options = dict(options)
        self.parts = int(options.get("partitions", "10"))

    def read(self, partition: Heights) -> Iterator[tuple[int, str]]:
        c = client(self.options)
        for h in range(partition.first, partition.last + 1):
            yield h, c.block(h)


class RpcReader(_Fetch, DataSourceReader):
    def partitions(self) -> list[Heights]:
        o = self.options
        end = int(o["end"]) if "end" in o else safe_tip(client(o).tip(), int(o.get("confirmations", "10")))
        return deal(int(o.get("start", "0")), end, self.parts) or [Heights(0, -1)]


class RpcStream(_Fetch, DataSourceStreamReader):
    """Offsets {"next": the first height not read yet}."""

    def __init__(self, options, clock=time.monotonic):
        super().__init__(options)
        self.next = None
        self.clock = clock
        self.tip, self.ask_at = None, 0.0

    def known_tip(self) -> int:
        """The node's tip, asked for no more often than the options say. The first answer must come; later the last one holds while the node is silent."""
        if self.tip is None or self.clock() >= self.ask_at:
            wait = float(self.options.get("tip_seconds", "5"))
            try:
                self.tip = client(self.options).tip()
            except (OSError, RpcError, ValueError):
                if self.tip is None:
                    raise
                wait = float(self.options.get("wait_seconds", "15"))
            self.ask_at = self.clock() + wait
        return self.tip

    def initialOffset(self) -> dict:  # noqa: N802
        return {"next": int(self.options.get("start", "0"))}

    def latestOffset(self) -> dict:  # noqa: N802
        """At most `batch` heights beyond the last offset given out, and none beyond the safe tip."""
        if self.next is None:
            self.next = self.initialOffset()["next"]
        end = safe_tip(self.known_tip(), int(self.options.get("confirmations", "10"))) + 1
        self.next = max(self.next, min(self.next + int(self.options.get("batch", "100")), end))
        return {"next": self.next}

    def partitions(self, start: dict, end: dict) -> list[Heights]:
        self.next = max(self.next or 0, end["next"])
        return deal(start["next"], end["next"] - 1, self.parts)

    def commit(self, end: dict) -> None:
        self.next = max(self.next or 0, end["next"])


class RpcBlocks(DataSource):
    @classmethod
    def name(cls) -> str:
        return "rpc_blocks"

    def schema(self) -> str:
        return "height int, block string"

    def reader(self, schema) -> RpcReader:
        return RpcReader(self.options)

    def streamReader(self, schema) -> RpcStream:  # noqa: N802
        return RpcStream(self.options)

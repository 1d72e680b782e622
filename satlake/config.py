"""Settings: defaults, then a YAML file, then the environment. A number that can't be read is passed over."""

from __future__ import annotations

import dataclasses
import os
from collections.abc import Mapping
from dataclasses import dataclass


def read_flat_yaml(text: str) -> dict[str, str]:
    """`key: value` lines, nested maps joined with dots; comments and quotes are taken off. No lists, no anchors."""
    out: dict[str, str] = {}
    path: list[tuple[int, str]] = []
    for line in text.splitlines():
        body = line.split(" #")[0].rstrip()
        if not body.strip() or body.lstrip().startswith("#") or ":" not in body:
            continue
        indent = len(body) - len(body.lstrip())
        key, _, value = body.strip().partition(":")
        while path and path[-1][0] >= indent:
            path.pop()
        path.append((indent, key.strip()))
        if value.strip():
            out[".".join(k for _, k in path)] = value.strip().strip("\"'")
    return out


_BOOLS = {w: b for b, words in ((True, ("1", "t", "true", "yes", "on")), (False, ("0", "f", "false", "no", "off"))) for w in words}


def _coerce(kind: type, value: str):
    if kind is bool:
        if (word := value.strip().lower()) not in _BOOLS:
            raise ValueError(value)
        return _BOOLS[word]
    return kind(value)


def overlay(base, values: Mapping[str, str], aliases: Mapping[str, str] = {}):
    """A copy of the dataclass with fields of `values` set; fields that can't be read keep their value."""
    kinds = {f.name: type(getattr(base, f.name)) for f in dataclasses.fields(base)}
    found = {}
    for k, v in values.items():
        name = aliases.get(k, k)
        if name in kinds:
            try:
                found[name] = _coerce(kinds[name], v)
            except ValueError:
                continue
    return dataclasses.replace(base, **found)


@dataclass(frozen=True)
class IngestConfig:
    """start_height 0: from the store's last height on. store_url (also DATABASE_URL): the store's folder, in any file system that Spark can open."""

    store_url: str = "satlake-store"
    rpc_url: str = "http://127.0.0.1:8332"
    rpc_user: str = ""
    rpc_password: str = ""
    workers: int = 10
    batch_size: int = 100
    start_height: int = 0
    port: int = 8080
    confirmations: int = 10
    historical_sync: bool = True

    @classmethod
    def load(cls, path: str | None = None, env: Mapping[str, str] | None = None) -> IngestConfig:
        """Of the environment, names as in the YAML file in capitals; those with SATLAKE_ before them come first."""
        cfg = cls()
        if path and os.path.exists(path):
            with open(path) as f:
                cfg = overlay(cfg, read_flat_yaml(f.read()), STORE)
        env = os.environ if env is None else env
        cfg = overlay(cfg, {k.lower(): v for k, v in env.items() if k.isupper() and v}, STORE)
        return overlay(cfg, {k.lower().removeprefix("satlake_"): v for k, v in env.items() if k.startswith("SATLAKE_")}, STORE)


@dataclass(frozen=True)
class BackfillConfig:
    """end_height -1: up to the highest block. `skip_spend` and `skip_spend_state` are one flag. batch_size (heights derived at once; 0: all) bounds what a commit holds."""

    store_url: str = "satlake-store"
    start_height: int = 0
    end_height: int = -1
    batch_size: int = 0
    workers: int = 4
    skip_spend: bool = False
    skip_receivers: bool = False
    skip_senders: bool = False
    skip_balances: bool = False
    skip_utxo_counts: bool = False

    @classmethod
    def load(cls, path: str) -> BackfillConfig:
        with open(path) as f:
            return overlay(cls(), read_flat_yaml(f.read()), STORE | {"skip_spend_state": "skip_spend"})

    def skipped(self) -> frozenset[str]:
        return frozenset(s for s in ("spend", "receivers", "senders", "balances", "utxo_counts") if getattr(self, f"skip_{s}"))


STORE = {"database_url": "store_url"}
